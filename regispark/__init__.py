"""regispark — company-registry analytics as lazy Spark DataFrame operators.

Layout:
  functions/  Column -> Column helpers (decoding, text, contact data, dates, privacy)
  operators/  DataFrame -> DataFrame operators (projection, filters, joins, profiles,
              quality checks, feature selection, statistical tests)
  sources/    readers (typed delimited drops, mixed encodings, archives, seeds) and sinks
  plans/      composite flows (establishments, companies, partners, phones, modelling
              table, SQL models, EDA question set) and the driver query catalogue
"""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions that run in Spark's Python workers travel by value: the workers need no copy
# of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""DataFrame -> DataFrame operators."""

from .filters import (between_excl, keep_in, known, only_person_ids, phone_shape, require, sample_rows,
                      split_train_test)
from .joins import (attach, fits_broadcast, join_companies, lookup, lookup_ranges, lookup_roles, maybe_broadcast,
                    ratio_to_reference, salted_join)
from .profile import (corr_matrix, dedupe, dedupe_on, describe_long, duplicate_audit, filtered_mean, five_number,
                      freq, group_profile, histogram, missing_table, quantiles, share, summary_long, top_k,
                      union_all, variance)
from .projection import (decimal_comma, derive, drop_cols, drop_ml_columns, enforce_schema, rename, row_id,
                         select_as, split_columns)
from .quality import check_not_null, check_unique, domain_audit

__all__ = [n for n in dir() if not n.startswith("_")]

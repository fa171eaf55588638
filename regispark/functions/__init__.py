"""Column -> Column helpers. Everything here is a built-in Spark expression (codegen, no Python)."""

from .contact import (email_provider, email_valid, mobile_prefix5, phone_class, phone_class_final,
                      rewrite_words)
from .dates import safe_date, year_month
from .decode import (AGE_BAND, BRANCH_TYPE, COMPANY_SIZE, MODEL_PROVIDERS, PARTNER_TYPE, REGISTRATION_STATUS,
                     STATE_NAME_TO_CODE, STREET_TYPES, decode, literal_map, map_table, replace_values,
                     typo_dictionary, whitelist)
from .nulls import fallback, fill_constants, override_when
from .privacy import person_id_flag, tokenize_id
from .text import (address_concat, address_ws, digits, explode_alternatives, first_token, fold_accents, prefix,
                   street_type, strip_decimal)

__all__ = [n for n in dir() if not n.startswith("_")]

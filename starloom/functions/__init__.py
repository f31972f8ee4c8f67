"""Column -> Column building blocks. All are native Spark expressions."""

from .age import age_band, age_from_text, age_label, age_text_label, strip_year_words
from .calendar import calendar_columns, epi_week, two_digits
from .casts import col_of, to_date, to_double, to_float, to_int, to_long
from .codes import KEEP, bucketize, first_present, letter_flag, recode, sex_code, swapped_race_code
from .text import (
    clean,
    clean_upper,
    code_prefix,
    decimal_comma,
    first_char,
    hash_key,
    none_as_zero,
    split_max,
)

__all__ = [
    "KEEP", "age_band", "age_from_text", "age_label", "age_text_label", "bucketize",
    "calendar_columns", "clean", "clean_upper", "code_prefix", "col_of", "decimal_comma",
    "epi_week", "first_char", "first_present", "hash_key", "letter_flag", "none_as_zero",
    "recode", "sex_code", "split_max", "strip_year_words", "swapped_race_code", "to_date",
    "to_double", "to_float", "to_int", "to_long", "two_digits",
]

from cubeloom.functions.numbers import exact_sum, from_units, parse_number, safe_ratio, units
from cubeloom.functions.text import (
    blank_to_label,
    blank_to_null,
    clean_sector_code,
    comparable_text,
    strip,
    strip_defensive_decimal,
    tokens_to_null,
)

__all__ = [
    "blank_to_label",
    "blank_to_null",
    "clean_sector_code",
    "comparable_text",
    "exact_sum",
    "from_units",
    "parse_number",
    "safe_ratio",
    "strip",
    "strip_defensive_decimal",
    "tokens_to_null",
    "units",
]

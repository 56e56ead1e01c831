from orderlake.functions.cleaning import (
    normalize_blank_strings,
    parse_dates,
    parsed_name,
    text_name,
    type_numbers,
)
from orderlake.functions.numeric import dax_divide, delivery_days, line_revenue, safe_divide

__all__ = [
    "dax_divide",
    "delivery_days",
    "line_revenue",
    "normalize_blank_strings",
    "parse_dates",
    "parsed_name",
    "safe_divide",
    "text_name",
    "type_numbers",
]

"""Column -> Column expressions: cleaning (C1-C14) and the fiscal calendar."""

from ledgerline.functions.calendar import (date_key, fiscal_quarter, fiscal_year, half_year,
                                           month_name, quarter_name)
from ledgerline.functions.cleaning import (NA_TOKENS, is_rounded, null_tokens, normalize_supplier, parse_amount,
                                           parse_uk_date, refund_flag, split_group, strip_ws,
                                           title_case)

__all__ = [
    "NA_TOKENS", "date_key", "fiscal_quarter", "fiscal_year", "half_year", "is_rounded", "month_name",
    "normalize_supplier", "null_tokens", "parse_amount", "parse_uk_date", "quarter_name",
    "refund_flag", "split_group", "strip_ws", "title_case",
]

"""Column -> Column helpers (the reference's row functions, natively)."""

from .text import (clean_text, clean_text_keep_inner, normalize_id, standard_name,  # noqa: F401
                   catalog_value, collapse_ws, normalize_header, compare_name,
                   cell_for_line, strip_marks)
from .ruc import extract_ruc, ruc_from, validate_ruc  # noqa: F401
from .numbers import parse_number, to_number  # noqa: F401
from .dates import parse_date, date_key, period_key, calendar_columns, zero_pad_month  # noqa: F401
from .keys import (pipe_key, hash_input, org_key, location_key, currency_key,  # noqa: F401
                   category_key, method_key, row_hash, amount_text, timestamp_text,
                   full_row_hash)

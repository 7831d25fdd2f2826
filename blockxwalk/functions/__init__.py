"""Column-level functions: text/number rules, domain keys, planar geometry."""

from .keys import bbl_from_number, bbl_key, segid_key  # noqa: F401
from .text import (  # noqa: F401
    digits, extract_or_null, feet_to_miles, int_text, is_finite, label, na_text,
    not_blank, not_in_keep_null, pad_left, paste_na, plain_digits, row_max, row_min,
    to_double, trim_ws, truncate,
)

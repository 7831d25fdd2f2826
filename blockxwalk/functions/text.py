"""String and number helpers with the missing-value rules the pipelines rely on.

All return Columns built from JVM-side expressions, so they stay inside
whole-stage codegen.  Rules that differ from Spark's defaults are spelled out
per function (NULL renders as ``NA`` when pasted, trimming removes every kind
of whitespace, padding never truncates, lenient number parsing).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

NA_TEXT = "NA"
# Whitespace class: ASCII whitespace plus Unicode separators (NBSP etc.).
_WS = r"[\s\p{Z}]"
# Text that already is a plain integer.
_PLAIN = r"^-?[0-9]+$"


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: ColumnOrName) -> Column:
    """Trim leading/trailing whitespace of any kind (``trim`` only strips spaces)."""
    return F.regexp_replace(col(c), f"^{_WS}+|{_WS}+$", "")


def not_blank(c: ColumnOrName) -> Column:
    """True when the value is non-NULL and non-empty after trimming."""
    return col(c).isNotNull() & (trim_ws(c) != F.lit(""))


def pad_left(c: ColumnOrName, width: int, pad: str = "0") -> Column:
    """Left-pad to ``width`` without truncating longer values (``lpad`` truncates)."""
    s = col(c)
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), pad)


def digits(c: ColumnOrName) -> Column:
    """Strip every non-digit character."""
    return F.regexp_replace(col(c), r"\D", "")


def extract_or_null(c: ColumnOrName, pattern: str) -> Column:
    """First match of ``pattern``; NULL when there is no match (Spark gives '')."""
    s = col(c)
    return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 0))


def truncate(c: ColumnOrName, width: int = 40, ellipsis: str = "...") -> Column:
    """Cut to ``width`` characters, the tail replaced by ``ellipsis``."""
    s = col(c)
    keep = width - len(ellipsis)
    return F.when(F.length(s) > width, F.concat(F.substring(s, 1, keep), F.lit(ellipsis))).otherwise(s)


def int_text(c: ColumnOrName) -> Column:
    """Number as text: integral values of any size print without fraction or exponent (``100``, not ``100.0``)."""
    x = col(c)
    d, s = x.cast("double"), x.cast("string")
    return F.when(s.rlike(_PLAIN), s).when(F.rint(d) == d, F.format_string("%.0f", d)).otherwise(s)


def na_text(c: ColumnOrName) -> Column:
    """Text form with NULL rendered as ``NA`` (what pasting a missing value prints)."""
    return F.coalesce(col(c).cast("string"), F.lit(NA_TEXT))


def paste_na(*cols: ColumnOrName, sep: str = " ") -> Column:
    """Concatenate with ``sep``; NULL pieces print as ``NA`` (Spark concat gives NULL)."""
    return F.concat_ws(sep, *[na_text(c) for c in cols])


def label(template: str, *cols: ColumnOrName) -> Column:
    """``format_string`` with ``%s`` slots; NULL values print as ``NA``."""
    return F.format_string(template, *[na_text(c) for c in cols])


# Lenient number syntax: decimal / scientific and inf/infinity.  (Hexadecimal
# literals are not accepted: they give NULL.)
_NUM = r"^(?i)[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)$"


def to_double(c: ColumnOrName, trimmed: bool = False) -> Column:
    """Lenient text -> double; unparsable text gives NULL instead of an error.

    Surrounding whitespace is ignored (pass ``trimmed=True`` when the input is
    already trimmed).  ``NaN`` counts as missing, which is how the downstream
    row-wise min/max (missing values skipped) treats it.  Guarded by a syntax
    regex because a bare cast also accepts e.g. ``12d``.
    """
    s = col(c) if trimmed else trim_ws(c)
    return F.when(s.rlike(_NUM), s.try_cast("double"))


def is_finite(c: ColumnOrName) -> Column:
    """Non-NULL, not NaN, not +-Infinity."""
    x = col(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def row_min(*cols: ColumnOrName) -> Column:
    """Row-wise minimum skipping NULLs (NULL only if all are NULL)."""
    return F.least(*[col(c) for c in cols])


def row_max(*cols: ColumnOrName) -> Column:
    return F.greatest(*[col(c) for c in cols])


def plain_digits(c: ColumnOrName) -> Column:
    """Number -> integer digits without exponent notation (``1000120007``, not ``1.000120007E9``), of any size."""
    s, d = col(c).cast("string"), col(c).try_cast("double")
    return F.when(s.rlike(_PLAIN), s).when(d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), F.format_string("%.0f", d))


def feet_to_miles(c: ColumnOrName) -> Column:
    return col(c) / F.lit(5280.0)


def not_in_keep_null(c: ColumnOrName, values) -> Column:
    """Exclusion filter that *keeps* NULL (``NOT IN`` in SQL would drop it)."""
    return ~F.coalesce(col(c).isin(list(values)), F.lit(False))

"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")

# Plain decimal / scientific number, after trimming.
NUMBER_RE = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
# Infinity spellings accepted as numbers.
INF_TOKENS = ("inf", "+inf", "-inf", "infinity", "+infinity", "-infinity")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c) -> Column:
    c = col_(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INF))


def is_inf(c) -> Column:
    c = col_(c)
    return c.isNotNull() & (F.abs(c) == F.lit(INF))


def finite_or_null(c) -> Column:
    """Keep finite values; NaN and +-Inf become NULL."""
    c = col_(c)
    return F.when(is_finite(c), c)


def strip(c) -> Column:
    """Strip leading/trailing whitespace (tabs and newlines too, unlike trim)."""
    return F.regexp_replace(col_(c), r"^\s+|\s+$", "")


def blank_to_null(c) -> Column:
    s = strip(c)
    return F.when(s != F.lit(""), s)


def coerce_double(c, dtype: str) -> Column:
    """Numeric coercion: bad text becomes NULL; numbers pass through.

    Strings are accepted when they look like a plain decimal/scientific number
    or an infinity token (after trimming spaces); Spark's own cast would also
    accept forms like '1d' or '1f', so the pattern is checked first.
    """
    c = col_(c)
    if dtype != "string":
        return c.cast("double")
    t = F.trim(c)
    ok = t.rlike(NUMBER_RE) | F.lower(t).isin(*INF_TOKENS)
    return F.when(ok, t.try_cast("double"))


def attach_scalars(df, one_row):
    """Attach the columns of a one-row aggregate to every row as typed literals.

    The aggregate is evaluated once (a single row reaches the driver), so the
    plan has no join at all -- in particular no nested-loop/cross join.
    """
    r = one_row.first()
    types = dict(one_row.dtypes)
    return df.select("*", *[F.lit(r[c]).cast(types[c]).alias(c) for c in one_row.columns])


# Largest table (bytes, estimated from its rows and types) the library hints as a
# broadcast side; beyond it the join is left to the planner (shuffle join).
BROADCAST_BYTE_LIMIT = 32 << 20
NUMBER_BYTES, OTHER_BYTES = 8, 256


def row_bytes(df) -> int:
    """Width of a row: 8 bytes a number, 256 for any other field (names and labels)."""
    kinds = [t for _, t in df.dtypes]
    return 16 + sum(OTHER_BYTES if t.startswith(("string", "binary", "array", "map", "struct", "variant")) else NUMBER_BYTES for t in kinds)


def broadcast_if_small(df, rows: int, limit: int = BROADCAST_BYTE_LIMIT):
    """Broadcast hint only for a side whose size (its row count is known on the driver) is bounded."""
    return F.broadcast(df) if rows * row_bytes(df) <= limit else df

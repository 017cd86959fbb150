"""Column expressions (all built-ins, so they stay inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.strip() removes (all Unicode whitespace).
UNICODE_SPACES = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def trim_unicode(c: Column | str) -> Column:
    """Strip leading/trailing Unicode whitespace (NBSP, tabs, ...), like str.strip.

    ``btrim`` with an explicit character set is a plain codegen'd scan;
    a Unicode-aware regex costs several times more per row.
    """
    return F.btrim(col(c), F.lit(UNICODE_SPACES))


def coerce_number(c: Column | str, dtype: str = "decimal(18,4)") -> Column:
    """Parse a number; unparseable or missing becomes 0."""
    x = trim_unicode(col(c).cast("string"))
    return F.coalesce(x.try_cast(dtype), F.lit(0).cast(dtype))


# Day-first formats tried in order; the first that parses wins.
DAY_FIRST_FORMATS = ("d/M/yyyy", "d/M/yyyy H:m", "d/M/yyyy H:m:s", "d-M-yyyy", "d.M.yyyy",
                     "yyyy-M-d", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy/M/d",
                     "yyyy-M-d H:m:s.SSSSSS", "yyyy-M-d'T'H:m:s.SSSSSS", "yyyy-M-d'T'H:m:s[.SSSSSS]XXX",
                     "d/M/yy", "d/M/yyyy h:m:s a", "d/M/yyyy K:m:s a")


def parse_day_first(c: Column | str, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Text to date, day first; unparseable gives null. Date-typed input passes."""
    x = trim_unicode(col(c).cast("string"))
    return F.to_date(F.coalesce(*[F.try_to_timestamp(x, F.lit(f)) for f in formats]))


def leading_letters(c: Column | str) -> Column:
    """The whole leading run of letters (Unicode aware) after trimming."""
    return F.regexp_extract(trim_unicode(col(c)), r"^(\p{L}+)", 1)


def safe_ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num/den as double; ``default`` when den is 0 or null (ANSI safe)."""
    r = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return r if default is None else F.coalesce(r, F.lit(default))


def date_key(c: Column | str) -> Column:
    """yyyyMMdd as int."""
    d = col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM")


def is_weekend(c: Column | str) -> Column:
    """Saturday or Sunday (dayofweek: 1 = Sunday, 7 = Saturday)."""
    return F.dayofweek(col(c)).isin(1, 7)

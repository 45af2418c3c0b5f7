"""Text, number, date and vote expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space code points.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Unit words that may stand around a displayed number.
NUMBER_WORDS = ["karma", "followers", "following", "points", "members"]

_DIGITS = r"\d+(?:_\d+)*"
DECIMAL_PATTERN = (
    rf"^[+-]?(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
)
INTEGER_PATTERN = rf"^[+-]?{_DIGITS}$"
DAY_SECONDS = 86400
FIRST_SECOND = -62135596800  # 0001-01-01, the earliest date that can be shown


def trim_ws(column: Column) -> Column:
    """Strip Unicode white space from both ends (plain ``trim`` only strips blanks)."""
    return F.trim(column, F.lit(WHITE_SPACE))


def cast_default(column: Column, kind: str = "bigint", default=0, lenient: bool = False) -> Column:
    """Cast with a default for null; bad text raises unless ``lenient``."""
    cast = column.try_cast(kind) if lenient else column.cast(kind)
    return F.coalesce(cast, F.lit(default).cast(kind))


def parse_human_number(text: Column) -> Column:
    """``5.2K karma`` -> 5200; anything that is not a number -> 0."""
    bare = F.lower(trim_ws(text))
    for word in NUMBER_WORDS:
        bare = trim_ws(F.replace(bare, F.lit(word), F.lit("")))
    factor = F.when(bare.endswith("k"), 1000.0).when(bare.endswith("m"), 1000000.0).otherwise(1.0)
    number = trim_ws(F.regexp_replace(bare, "[km]$", ""))
    value = F.when(
        number.rlike(DECIMAL_PATTERN), F.replace(number, F.lit("_"), F.lit("")).try_cast("double")
    )
    return F.coalesce((value * factor).try_cast("bigint"), F.lit(0).cast("bigint"))


def safe_int(text: Column) -> Column:
    """Whole number in ``text``, else 0."""
    bare = trim_ws(text)
    digits = F.replace(bare, F.lit("_"), F.lit(""))
    value = F.when(bare.rlike(INTEGER_PATTERN), digits.try_cast("bigint"))
    return F.coalesce(value, F.lit(0).cast("bigint"))


def relative_date(text: Column, now: Column, strict: bool = False) -> Column:
    """``9d ago`` -> date ``yyyy-MM-dd`` before ``now``; no age found -> the day of ``now``.

    The unit is taken by containment in the order d, h, m, w. ``strict`` reads
    months, seconds and a blank before the unit as a person would.
    """
    low = F.lower(text)
    pattern = r"(\d+)\s*([a-z]+)" if strict else r"(\d+)([a-z]+)"
    amount = F.regexp_extract(low, pattern, 1).try_cast("bigint")
    unit = F.regexp_extract(low, pattern, 2)
    if strict:
        seconds = (
            F.when(unit.startswith("mo"), 30 * DAY_SECONDS)
            .when(unit.startswith("s"), 1)
            .when(unit.startswith("d"), DAY_SECONDS)
            .when(unit.startswith("h"), 3600)
            .when(unit.startswith("m"), 60)
            .when(unit.startswith("w"), 7 * DAY_SECONDS)
            .otherwise(0)
        )
    else:
        seconds = (
            F.when(unit.contains("d"), DAY_SECONDS)
            .when(unit.contains("h"), 3600)
            .when(unit.contains("m"), 60)
            .when(unit.contains("w"), 7 * DAY_SECONDS)
            .otherwise(0)
        )
    start = F.unix_seconds(now.cast("timestamp"))
    moved = start - F.when(amount < 10**12, amount * seconds)
    moment = F.when(moved >= FIRST_SECOND, moved).otherwise(start)
    return F.date_format(F.timestamp_seconds(moment), "yyyy-MM-dd")


def word_count(text: Column) -> Column:
    """Parts between single blanks; null text counts 0."""
    return F.coalesce(F.size(F.split(text, " ")), F.lit(0))


def follower_ratio(followers: Column, following: Column) -> Column:
    return F.try_divide(followers.cast("double"), following + 1)


def net_votes(up: Column, down: Column) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.coalesce(up, zero) - F.coalesce(down, zero)


def iso_prefix_date(text: Column) -> Column:
    """Day part of an ISO time stamp; empty text -> null."""
    return F.nullif(F.substring(text, 1, 10), F.lit(""))


def log_target(column: Column) -> Column:
    return F.log1p(column.cast("double"))


def back_transform(column: Column) -> Column:
    """From log scale to points, never below zero."""
    return F.greatest(F.expm1(column), F.lit(0.0))


def clip_low(column: Column, low: float = 0.0) -> Column:
    return F.greatest(column.cast("double"), F.lit(low))


def first_match(text: Column, patterns: list[str]) -> Column:
    """First group of the first pattern that matches, else null."""
    return F.coalesce(
        *[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns]
    )


def all_matches(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), group)


def author_name(text: Column) -> Column:
    """Displayed author without the ``u/`` mark."""
    return F.replace(trim_ws(text), F.lit("u/"), F.lit(""))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, null for a constant column (``corr`` raises there)."""
    x, y = x.cast("double"), y.cast("double")
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))

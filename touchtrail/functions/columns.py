"""Cleaning, date, key and ratio expressions. All are JVM-side Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchtrail.config import CHANNEL_ALIASES

MONEY = "decimal(18,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(key: Column | str, table: dict[str, str], default: Column | None = None) -> Column:
    """Value of a small constant table, or ``default`` (NULL) for an unlisted key."""
    key = _col(key)
    result = None
    for name, value in table.items():
        condition = key == F.lit(name)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    if result is None:
        return default if default is not None else F.lit(None).cast("string")
    return result.otherwise(default) if default is not None else result


def sql_text(value: object) -> str:
    """SQL literal of a text, number or boolean, for generated expressions."""
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value).lower()


# -- cleaning ------------------------------------------------------------------


def blank_to_null(c: Column | str) -> Column:
    """Trim spaces; an empty text becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True when the text is NULL or only spaces. Never NULL itself."""
    return blank_to_null(c).isNull()


def clean_id(c: Column | str) -> Column:
    return F.upper(blank_to_null(c))


def lower_label(c: Column | str) -> Column:
    return F.lower(blank_to_null(c))


def canonical_channel(c: Column | str, aliases: dict[str, str] = CHANNEL_ALIASES) -> Column:
    """Lower-case channel with alias spellings folded to one key."""
    label = F.lower(F.trim(_col(c)))
    pairs = [F.lit(text) for pair in aliases.items() for text in pair]
    folded = F.coalesce(F.try_element_at(F.create_map(*pairs), label), label) if pairs else label
    return F.nullif(folded, F.lit(""))


def slugify(c: Column | str) -> Column:
    """Lower-case, every run of other characters becomes one ``_``, none at the ends."""
    runs = F.regexp_replace(F.lower(F.trim(_col(c))), "[^a-z0-9]+", "_")
    return F.nullif(F.btrim(runs, F.lit("_")), F.lit(""))


# -- dates ---------------------------------------------------------------------

# A full year-month-day date with one kind of separator, and optionally a time.
_DATE_SHAPE = r"^(\d{4,}([-/ \\])\d{1,2}\2\d{1,2})(?: \d{1,2}:\d{2}.*)?$"


def safe_date(c: Column | str) -> Column:
    """Date of a text, or NULL when it is not a full calendar date.

    Spark alone would also accept ``2024`` and ``2024-01`` and reject
    ``2024/01/05``; the shape match and the separator swap undo both.
    """
    text = _col(c)
    # The common form skips the regular expression: ten characters, dashes in place.
    plain = (
        (F.length(text) == 10) & (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    )
    day = F.translate(F.regexp_extract(F.trim(text), _DATE_SHAPE, 1), "/ \\", "---")
    return F.when(plain, text.try_cast("date")).otherwise(day.try_cast("date"))


def safe_month(c: Column | str) -> Column:
    """First day of a ``year-month`` text, or NULL."""
    return F.to_date(F.try_to_timestamp(blank_to_null(c), F.lit("yyyy-M")))


def month_start(c: Column | str) -> Column:
    return F.trunc(_col(c), "month")


def date_key(c: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    d = _col(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def month_key(c: Column | str) -> Column:
    """YYYYMM as an integer."""
    d = _col(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


# -- numbers -------------------------------------------------------------------


def round_half_away(x: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back (double arithmetic)."""
    factor = float(10**digits)
    return F.round(x.cast("double") * factor) / factor


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; NULL when the denominator is zero or NULL."""
    top = _col(numerator).cast("double")
    bottom = _col(denominator).cast("double")
    return top / F.nullif(bottom, F.lit(0.0))


def safe_ratio(numerator: Column | str, denominator: Column | str, digits: int) -> Column:
    return round_half_away(ratio(numerator, denominator), digits)


def zero_if_null(c: Column | str) -> Column:
    c = _col(c)
    return F.coalesce(c, F.lit(0))


# -- keys ----------------------------------------------------------------------


def compound_key(*parts: Column | str, separator: str = "|") -> Column:
    """md5 over the parts and separators; a NULL part adds no characters."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(separator))
        pieces.append(_col(part).cast("string"))
    return F.md5(F.concat_ws("", *pieces))

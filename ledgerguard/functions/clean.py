"""Column helpers for permissive text staging: Column in, Column out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values. Java's `$` also matches before a final newline, so every pattern ends in \z.
NNI = r"^[0-9]{10}\z"
PHONE = r"^\+222[0-9]{8}\z"
DIGITS = r"^[0-9]+\z"
# The parsing patterns allow white space around the text, so that a cell is trimmed once.
NUMBER = r"(?iU)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*\z"
SPECIAL_NUMBER = r"(?iU)^\s*([+-]?inf(inity)?|nan)\s*\z"
INTEGER = r"(?U)^\s*[+-]?[0-9]+\s*\z"
ISO_TIME = (
    r"(?U)^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"( [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?"
    r"|T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2}))?\s*\z"
)
DAY_FIRST = r"(?U)^\s*[0-9]{2}/[0-9]{2}/[0-9]{4}\s*\z"
STARTS_WITH_DAY = r"^[0-9]{4,}-[0-9]{1,2}-[0-9]{1,2}"
CLOCK = r"^([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9](\.[0-9]+)?)?\z"

# The characters with Unicode's white space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

MONEY = "decimal(14,2)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- presence and trimming ---------------------------------------------------------

def squeeze(c: Column | str) -> Column:
    """Trim Unicode white space (not only blanks) at both ends. Text that begins and ends
    with a visible ASCII character, which is nearly all of it, passes as it is."""
    c = _col(c)
    visible = F.ascii(c).between(33, 126) & F.ascii(F.right(c, F.lit(1))).between(33, 126)
    return F.when(visible, c).otherwise(F.btrim(c, F.lit(WHITE_SPACE)))


def present(c: Column | str) -> Column:
    """Neither NULL nor the empty string."""
    c = _col(c)
    return c.isNotNull() & (c != "")


def blank(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | (c == "")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def matches(c: Column | str, pattern: str) -> Column:
    return _col(c).rlike(pattern)


# -- casts --------------------------------------------------------------------------

def clean_cast(c: Column | str, dtype: str, strict: bool = False) -> Column:
    """Empty text to NULL, then a typed cast.

    A malformed value gives NULL and is counted by the constraint report; with
    ``strict`` it raises and stops the job. Dates and timestamps must name a day:
    Spark would read a bare ``2024`` as the first of January.
    """
    text = F.nullif(F.trim(_col(c)), F.lit(""))
    if dtype == "time":
        time = clean_time(c)
        if not strict:
            return time
        bad = F.raise_error(F.concat(F.lit("malformed time: "), text)).cast("string")
        return F.when(text.isNotNull() & time.isNull(), bad).otherwise(time)
    cast = text.cast(dtype) if strict else text.try_cast(dtype)
    if dtype in ("date", "timestamp", "timestamp_ntz") and not strict:
        cast = F.when(text.rlike(STARTS_WITH_DAY), cast)
    return cast


def clean_time(c: Column | str) -> Column:
    """A valid clock time as ``HH:mm:ss`` text, else NULL."""
    text = F.trim(_col(c))
    return F.when(
        text.rlike(CLOCK),
        F.when(F.length(text) == 5, F.concat(text, F.lit(":00"))).otherwise(text),
    )


def cast_failed(c: Column | str, dtype: str) -> Column:
    """Text is there but does not convert."""
    return present(F.trim(_col(c))) & clean_cast(c, dtype).isNull()


def clean_or(c: Column | str, default) -> Column:
    """The value, or a default where it is NULL or empty."""
    c = _col(c)
    value = empty_to_null(c) if isinstance(default, str) else c
    return F.coalesce(value, F.lit(default))


def to_bool(c: Column | str) -> Column:
    """``true`` is true; everything else, NULL too, is false."""
    return F.coalesce(_col(c) == "true", F.lit(False))


def to_number(c: Column | str) -> Column:
    """Text as a double. Guarded, because Spark also takes type suffixes such as ``1.0d``;
    a finite literal beyond the double range counts as malformed."""
    c = _col(c)
    value = squeeze(c).try_cast("double")
    finite = F.nullif(F.nullif(value, F.lit(float("inf"))), F.lit(float("-inf")))
    return F.when(c.rlike(NUMBER), finite).when(c.rlike(SPECIAL_NUMBER), value)


def to_integer(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.rlike(INTEGER), squeeze(c).try_cast("bigint"))


def to_time(c: Column | str, day_first: bool = True) -> Column:
    """Text as a timestamp if it has one of the accepted layouts: zoned ISO, day, or
    seconds with an optional fraction; ``day_first`` adds ``dd/MM/yyyy``."""
    c = _col(c)
    iso = F.when(c.rlike(ISO_TIME), squeeze(c).try_cast("timestamp"))
    if not day_first:
        return iso
    return iso.when(c.rlike(DAY_FIRST), F.try_to_timestamp(squeeze(c), F.lit("dd/MM/yyyy")))


# -- derived values -----------------------------------------------------------------

def month_of(c: Column | str) -> Column:
    return F.date_trunc("month", _col(c)).cast("date")


def week_of(c: Column | str) -> Column:
    """The Monday of the week."""
    return F.date_trunc("week", _col(c)).cast("date")


def hour_of(clock: Column | str) -> Column:
    """Hour of ``HH:mm:ss`` text; for a timestamp use Spark's ``hour``."""
    return F.substring(clean_time(clock), 1, 2).try_cast("bigint")


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1e6)


def discrepancy(before, amount, fee, after) -> Column:
    """How far the closing balance is from opening balance - amount - fee."""
    return F.abs(_col(after) - (_col(before) - _col(amount) - _col(fee)))


def conflict_group_id(key: Column | str) -> Column:
    return F.concat(F.lit("idem_"), _col(key))


def fix_prefix(name: Column | str, replacement: Column, bad: str) -> Column:
    """Replace a bad prefix by a looked-up one, only where the name starts with it.
    All occurrences in such a name are replaced; an unknown category drops the prefix."""
    name = _col(name)
    return F.when(
        name.startswith(bad),
        F.replace(name, F.lit(bad), F.coalesce(replacement, F.lit(""))),
    ).otherwise(name)


def lookup(key: Column | str, values: Mapping[str, str]) -> Column:
    """Map a key through a small fixed dictionary; NULL where it has no entry."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), _col(key))


def label_by(key: Column | str, labels: Mapping[str, str], default: str = "") -> Column:
    return F.coalesce(lookup(key, labels), F.lit(default))


def allowed(c: Column | str, values: Sequence[str]) -> Column:
    return _col(c).isin(list(values))


def first_existing(df: DataFrame, *names: str) -> str | None:
    """The first of the names that the frame has. Looks at the schema only."""
    return next((n for n in names if n in df.columns), None)

"""Column expressions: strict numbers, timestamps, names, ids and limits. All are built in, none raises on bad input."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted timestamp formats, in order of trial.
TIMESTAMP_FORMATS = [
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "yyyy/MM/dd HH:mm:ss",
    "dd.MM.yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
]
_NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
#: Fixed value: name space of file ids.
FILE_NAMESPACE = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"


#: Characters that names of files don't take, and what no unit-free header cell holds.
_NOT_IN_NAMES = r'[<>:"/\\|?*()\[\] ]'
_UNIT_LIKE = r"[^a-zA-Z0-9\s.,_-]"


def num(c: Column) -> Column:
    """A string as double if it is wholly a number, else null."""
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def text_if_not_number(c: Column) -> Column:
    """The string where ``num`` finds no number in it, else null."""
    return F.when(c.isNotNull() & num(c).isNull(), c)


def parse_ts(c: Column, formats: list[str] | None = None) -> Column:
    """Timestamp by the first format that fits, then by Spark's default parser; null if none does."""
    tries = [F.try_to_timestamp(c, F.lit(f)) for f in formats or TIMESTAMP_FORMATS]
    return F.coalesce(*tries, F.try_to_timestamp(c))


def time_bin(seconds: Column, size: int) -> Column:
    """Beginning of the bin of ``size`` seconds, rounded down for negative times too."""
    return (F.floor(seconds / F.lit(size)) * F.lit(size)).cast("long")


def finite(c: Column) -> Column:
    """NaN and infinite values as null."""
    return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)


def clip_percent(c: Column) -> Column:
    """Values limited to 0 ... 100; NaN becomes null."""
    return F.when(F.isnan(c), F.lit(None).cast("double")).when(c < 0, F.lit(0.0)).when(c > 100, F.lit(100.0)).otherwise(c)


def file_uuid(path: Column, namespace: str = FILE_NAMESPACE) -> Column:
    """Version-5 UUID of a path's UTF-8 bytes in a name space."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(path, "UTF-8")))
    variant = F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)
    return F.lower(
        F.concat_ws(
            "-",
            F.substring(digest, 1, 8),
            F.substring(digest, 9, 4),
            F.concat(F.lit("5"), F.substring(digest, 14, 3)),
            F.concat(F.hex(variant), F.substring(digest, 18, 3)),
            F.substring(digest, 21, 12),
        )
    )


def sanitize_name(c: Column) -> Column:
    """Characters that file names don't take, and blanks, become one underscore; none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, _NOT_IN_NAMES, "_"), "_+", "_"), F.lit("_"))


def is_unit_cell(c: Column) -> Column:
    """Whether a header cell looks like a unit: one character, or one outside letters, digits, blanks and ``.,_-``. Blank is not."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return (t != "") & ((F.length(t) == 1) | t.rlike(_UNIT_LIKE))


def series_from_path(path: Column) -> Column:
    """Name of the folder that holds a file; null if the path has none."""
    parts = F.filter(F.transform(F.split(F.replace(path, F.lit("\\"), F.lit("/")), "/"), lambda x: F.trim(x)), lambda x: x != "")  # a bare F.trim would take the index as what to trim
    return F.when(F.size(parts) >= 2, F.element_at(parts, -2))


def extension(path: Column) -> Column:
    return F.lower(F.element_at(F.split(path, r"\."), -1))


def channel_norm(c: Column) -> Column:
    """Name for comparison: trimmed, lower case, underscores as blanks."""
    return F.lower(F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("_"), F.lit(" "))))


"""Access-log lines: one regular-expression pass per line."""

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("ip", "time", "method", "path", "protocol", "status", "bytes", "referer", "agent")

# One group per field of FIELDS. The path is taken without its leading slash, which a
# request target must have; a quoted referer may hold blanks.
LOG_PATTERN = (
    r'^(\S+) \S+ \S+ \[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} [+-]\d{4})\] '
    r'"(\S+) /(\S*)(?: +(\S+))? *" (\d{3}) (\S+) ("[^"]*"|\S+) (.*)$'
)

# Fixed value: the bracketed time, once read without its brackets.
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Servers escape control characters, so a raw one marks a malformed line; that makes
# this one safe to put between the captured fields.
_SEP = "\x01"


def stamp(line: Column) -> Column:
    """The bracketed time of a log line; NULL for any other line. One pass of the pattern."""
    found = F.regexp_extract(line, LOG_PATTERN, FIELDS.index("time") + 1)
    return F.when(~has_separator(line), F.nullif(found, F.lit("")))


def log_fields(line: Column) -> Column:
    """An array of the line's fields in one array, or an empty array for another line.

    ``regexp_extract`` would run the pattern once per field. Replacing the whole line by
    its groups and splitting runs it once, and exploding the result keeps the optimizer
    from repeating it for every field that is read.
    """
    groups = _SEP.join(f"${i}" for i in range(1, len(FIELDS) + 1))
    parts = F.split(F.regexp_replace(line, LOG_PATTERN, groups), _SEP, -1)
    return F.filter(F.array(parts), lambda p: F.size(p) == len(FIELDS))


def has_separator(line: Column) -> Column:
    return F.contains(line, F.lit(_SEP))


def category(path: Column) -> Column:
    """First part of a path, lower-cased."""
    return F.lower(F.split_part(path, F.lit("/"), F.lit(1)))

"""Whitespace tokens."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the delimiters between tokens (space, tab, newline, return, form feed).
DELIMITER = r"[ \t\n\r\f]"


def pieces(line: Column) -> Column:
    """Lower-case text between delimiters; neighbouring delimiters leave empty pieces.

    Dropping those after ``explode`` is cheaper than matching runs of delimiters.
    """
    return F.split(F.lower(line), DELIMITER)

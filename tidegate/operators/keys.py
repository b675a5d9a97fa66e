"""Keys as an operator compares them: as they are, or under a collation.

A database whose collation ignores case and trailing blanks takes ``ab`` and ``AB `` for one key.
A configuration may name one of ``COLLATIONS``; grouping, joining and merging then use Spark's
collated strings, while the stored values stay as they came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.text import quoted
from tidegate.operators.projection import by_name

# those whose equality ``hashable`` can follow
COLLATIONS = ("UTF8_LCASE", "UTF8_LCASE_RTRIM", "UTF8_BINARY_RTRIM")


def key_column(df: DataFrame, key: str, collation: str | None = None, of: Column | None = None) -> Column:
    """The key as it is compared; a collation only concerns text. ``of`` is a struct that holds it."""
    column = F.col(quoted(key)) if of is None else of[key]
    if collation is None or not isinstance(by_name(df.schema)[key.lower()].dataType, T.StringType):
        return column
    return F.collate(column, collation)


def hashable(key: Column, collation: str | None) -> Column:
    """A binary value that is the same for equal keys, to hash it: Spark's hashes do not heed collations."""
    if collation is None:
        return key
    plain = F.collate(key.cast("string"), "UTF8_BINARY")
    if collation.endswith("_RTRIM"):
        plain = F.rtrim(plain)
    if collation.startswith("UTF8_LCASE"):
        # lower-casing writes a sigma at the end of a word in a way of its own; the collation does not
        plain = F.translate(F.lower(plain), "\u03c2", "\u03c3")
    return plain

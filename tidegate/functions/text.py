"""Text helpers with the null and quoting rules of the audit model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def quoted(name: str) -> str:
    """A column or table name as one identifier, whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"


def quotename(name: Column | str) -> Column:
    """``[name]`` with every closing bracket doubled; NULL stays NULL."""
    return F.concat(F.lit("["), F.replace(_col(name), F.lit("]"), F.lit("]]")), F.lit("]"))


def concat0(*parts: Column | str) -> Column:
    """Concatenate, reading NULL as the empty text (Spark's own concat returns NULL)."""
    return F.concat(*[F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts])


def object_name(schema: Column | str, table: Column | str) -> Column:
    """``[schema].[table]``; an unmatched outer row renders as ``.``."""
    return concat0(quotename(schema), F.lit("."), quotename(table))


def sha256_hex(text: Column | str, charset: str = "UTF-8") -> Column:
    """64 upper-case hex digits; pass ``UTF-16LE`` to hash wide-character text."""
    return F.upper(F.sha2(F.encode(_col(text), charset), 256))

"""Digests of rows and tables that don't depend on the order of rows.

A row is written as text, column by column: the number of bytes of the value's
text, a colon and the text, or a dash for null.  A table's digest is made of the
number of rows and the sums of both halves of the rows' MD5, which are 64-bit
numbers.  Any engine that can do MD5 and add numbers of 38 digits gets the same.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain(c: Column, kind: T.DataType) -> Column:
    """The value's text: times as microseconds, doubles by their shortest digits to
    18 places, arrays by their elements' texts."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("string")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        wide = c.cast("double").cast("string")
        return F.coalesce(wide.try_cast("decimal(38,12)").cast("string"), wide)
    if isinstance(kind, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: F.coalesce(plain(x, kind.elementType), F.lit("-"))), ","), F.lit("]"))
    if isinstance(kind, T.BinaryType):
        return F.lower(F.hex(c))
    return c.cast("string")


def row_text(columns: list[Column]) -> Column:
    """columns: texts."""
    return F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns])


def row_parts(columns: list[Column]) -> list[Column]:
    """Both halves of a row's MD5 as numbers; columns: texts."""
    md5 = F.md5(row_text(columns).cast("binary"))
    return [F.conv(F.substring(md5, at, 16), 16, 10).cast("decimal(20,0)").cast("decimal(38,0)") for at in (1, 17)]


def digest_of(n: int, sums: list) -> str:
    return hashlib.sha256("|".join(str(int(x or 0)) for x in (n, *sums)).encode()).hexdigest()


def table_digest(df: DataFrame, *by: str) -> DataFrame:
    """by, n_rows and digest: one distributed pass of partial sums."""
    texts = [plain(F.col(f"`{f.name}`"), f.dataType) for f in df.schema if f.name not in by]
    one, two = row_parts(texts)
    sums = df.groupBy(*by).agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(one), F.lit(0)).alias("_one"), F.coalesce(F.sum(two), F.lit(0)).alias("_two"))
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in ("n_rows", "_one", "_two")])
    return sums.select(*by, "n_rows", F.sha2(text.cast("binary"), 256).alias("digest"))


def sql_text(name: str, kind: T.DataType) -> str:
    """``plain`` of a column in DuckDB's SQL."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return f"epoch_us({name})::VARCHAR"
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return f"coalesce(TRY_CAST({name}::DOUBLE::VARCHAR AS DECIMAL(38,12))::VARCHAR, {name}::VARCHAR)"
    if isinstance(kind, T.ArrayType):
        return f"'[' || array_to_string(list_transform({name}, lambda x: coalesce({sql_text('x', kind.elementType)}, '-')), ',') || ']'"
    return f"{name}::VARCHAR"

"""Fixed-length binary records: key bytes then value bytes, no header, no separator.

``text_records`` cuts whole texts into records; the file source and sink
(``fixedrec``) live in ``strata.sources.fixedrec``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: record layout of the sorted files
KEY_LEN = 10
VALUE_LEN = 90
RECORD_LEN = KEY_LEN + VALUE_LEN

BLOCK_RECORDS = 64


def _numbers(data: Column, size: int) -> Column:
    """0, 1, ... for each piece of ``size`` bytes; none for an empty value."""
    n = F.ceil(F.octet_length(data) / size).cast("int")
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def text_records(df: DataFrame, id_col: str, text_col: str, key_len: int = KEY_LEN,
                 value_len: int = VALUE_LEN) -> DataFrame:
    """Cut each whole UTF-8 text into consecutive fixed records.

    Record ``chunk`` holds bytes ``[chunk*len, (chunk+1)*len)``; the last one
    is padded with zero bytes. Every byte of every text lands in exactly one
    record. Output: ``id_col, chunk, key binary(key_len), value binary(value_len)``.
    """
    rec_len = key_len + value_len
    block = BLOCK_RECORDS * rec_len
    b = F.encode(F.col(text_col), "UTF-8")
    # a generator copies the whole row for every row it makes: texts are cut into blocks first, blocks into records
    blocks = (df.where(F.col(text_col).isNotNull())
                .select(id_col, b.alias("_bytes"), F.posexplode(_numbers(b, block)).alias("_i", "_block"))
                .select(id_col, "_block", F.expr(f"substring(_bytes, _block * {block} + 1, {block})").alias("_part")))
    part = F.col("_part")
    exploded = (blocks.select(id_col, "_block", "_part", F.posexplode(_numbers(part, rec_len)).alias("_j", "_at"))
                .withColumn("chunk", F.col("_block").cast("long") * BLOCK_RECORDS + F.col("_at")))
    rec = F.expr(f"rpad(substring(_part, _at * {rec_len} + 1, {rec_len}), {rec_len}, x'00')")
    return exploded.select(
        id_col,
        "chunk",
        F.substring(rec, 1, key_len).alias("key"),
        F.substring(rec, key_len + 1, value_len).alias("value"),
    )

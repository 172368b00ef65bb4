"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.session import checkpoint_root

#: A word is a maximal run of characters other than blank, tab, newline, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, codec: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and read it back.

    Lineage ends at the written table, so a lost executor costs no more than the
    tasks that were reading it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/kpiflow-llm/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Words of the text as long; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus 1."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(1)


def text_crc(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; null as the empty text."""
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def unit_hash(*cols: Column, seed: str) -> Column:
    """A repeatable number in (0, 1) from the columns: 52 bits of MD5; null is told from the empty text."""
    key = F.concat_ws("|", F.lit(seed), *[F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols])
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)

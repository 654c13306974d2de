"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir

#: white space that separates words: space, tab, LF, VT, FF, CR
SPACES = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for NULL, empty and blank texts."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RE))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n."""
    return (F.crc32(doc_id.cast("string")) % n).cast("int")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder for this run in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder once and read back: later stages and retries
    after a lost executor start from the files, not from the texts."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Entity-grain tables stored bucketed and sorted by their key.

Feature frames (one row per entity) written with the same key and number of
buckets are joined without an exchange: each task reads the same bucket of
every table. Only frames of one row per key belong here; a history with a hot
entity would put all its rows in one bucket, so it is rolled up first.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def store_by_key(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` buckets of ``key``, one file
    each, and read it back. Rows with a NULL key are kept, in one bucket."""
    name = f"stored_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").mode("errorifexists")
     .bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def open_by_key(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """A table that ``store_by_key`` wrote in an earlier session."""
    name = f"stored_{uuid.uuid4().hex}"
    cols = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet CLUSTERED BY ({_quoted(key)}) "
              f"SORTED BY ({_quoted(key)}) INTO {buckets} BUCKETS LOCATION '{where}'")
    return spark.table(name)

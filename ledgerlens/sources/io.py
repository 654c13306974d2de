"""Readers and writers.

CSV is read with an explicit schema and with ``inf`` / ``-inf`` spelled as
infinities (the default reads them as NULL). Parquet is the default format.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True) -> DataFrame:
    r = (spark.read.option("header", header)
         .option("positiveInf", "inf").option("negativeInf", "-inf")
         .option("nanValue", "nan").option("mode", "FAILFAST"))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: StructType | str | None = None) -> DataFrame:
    if fmt == "csv":
        return read_csv(spark, path, schema)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    return r.load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def score_frame(df: DataFrame, id_col: str, score_col: str,
                out_id: str = "id", out_score: str = "score") -> DataFrame:
    """(id, score) output keyed by id, never by row position."""
    return df.select(df[id_col].alias(out_id), df[score_col].cast("double").alias(out_score))


def write_scores(df: DataFrame, id_col: str, score_col: str, path: str, fmt: str = "csv") -> None:
    write_table(score_frame(df, id_col, score_col), path, fmt)


def table_shape(df: DataFrame, name: str) -> DataFrame:
    """One row (table, n_rows, n_cols)."""
    from pyspark.sql import functions as F
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("long").alias("n_cols"))


def summary_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    """Run-summary report (section, key, value) — metadata sized."""
    return spark.createDataFrame(rows, "section string, key string, value string")


def name_list(spark: SparkSession, names, col: str = "feature") -> DataFrame:
    """Feature-name / selected-feature list as a table (metadata sized)."""
    return spark.createDataFrame([(n,) for n in names], f"{col} string")


def write_params(spark: SparkSession, params: dict, path: str) -> None:
    """Parameter document sink: one JSON row."""
    import json
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def read_params(spark: SparkSession, path: str) -> dict:
    import json
    return json.loads(spark.read.text(path).first()["value"])


def write_ranked(df: DataFrame, path: str, by: list, fmt: str = "csv") -> None:
    """Ranked-result sink (importance, weight grid, trials): rows in order."""
    write_table(df.orderBy(*by), path, fmt)


def write_report(spark: SparkSession, rows: list[tuple[str, str, str]], path: str) -> None:
    """Run-summary sink: (section, key, value) rows as CSV, in the order given."""
    write_csv(summary_frame(spark, rows).coalesce(1), path)


TRIALS = "trial int, params string, mean_auc double"


def write_trials(spark: SparkSession, trials: list[tuple], path: str) -> None:
    """Trial table of a search: (trial, parameters, mean AUC)."""
    import json
    rows = [(t, json.dumps(p, sort_keys=True), a) for t, p, a in trials]
    write_table(spark.createDataFrame(rows, TRIALS), path)


def read_trials(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """The trial table and the parameters of its best trial (ties: the first)."""
    import json
    from pyspark.sql import functions as F
    t = read_table(spark, path)
    best = t.orderBy(F.desc("mean_auc"), "trial").first()
    return t, json.loads(best["params"]) if best else {}

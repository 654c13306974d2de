"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, label) for every end of an edge; label is the smallest id that can
    be reached.  Every round is written to the shared folder; the number of
    rounds grows with the logarithm of the longest chain of labels."""
    e = written(edges.select(F.col(a).alias("src"), F.col(b).alias("dst"))
                .unionByName(edges.select(F.col(b).alias("src"), F.col(a).alias("dst"))).distinct(), "edges")
    labels = written(e.groupBy("src").agg(F.least(F.col("src"), F.min("dst")).alias("label"))
                     .withColumnRenamed("src", "id"), "labels")
    while True:
        near = (e.join(labels, e["dst"] == labels["id"]).groupBy("src").agg(F.min("label").alias("m")))
        low = (labels.join(near, labels["id"] == near["src"])
               .select("id", F.col("label").alias("old"), F.least("label", "m").alias("label")))
        low = written(low, "labels")
        up = low.select(F.col("id").alias("up"), F.col("label").alias("top"))
        nxt = written(low.join(up, low["label"] == up["up"]).select("id", "old", F.least("label", "top").alias("label")), "labels")
        if nxt.filter("label <> old").isEmpty():
            return nxt.select("id", "label")
        labels = nxt.select("id", "label")

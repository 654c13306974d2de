"""ledgerlens: Spark-native entity feature rollups, ordered per-entity analytics,
profiling, feature selection and score evaluation.

Everything is expressed with the DataFrame API so that Catalyst can prune,
push down and plan the work; no Python UDF sits in a hot path.
"""

from ledgerlens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]

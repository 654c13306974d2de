"""The full query catalogue (importing the parts registers their queries)."""

from ledgerlens.plans import q_eval, q_features, q_index, q_model, q_ordered, q_pack, q_rollup, q_temporal, q_useragg  # noqa: F401
from ledgerlens.plans.registry import ORACLE, QUERIES  # noqa: F401

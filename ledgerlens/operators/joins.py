"""Joins: spine assembly, two-hop key lookup, outer feature merge.

All feature frames are one row per entity, so every join is an equi-join on
the entity key. Spark hash-partitions each side on the key (sort-merge or
shuffled hash); AQE may turn a side into a broadcast after measuring it at
run time, so no size-unchecked broadcast hint is placed here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_columns(df: DataFrame, key: str | Sequence[str], prefix: str) -> DataFrame:
    """Collision-safe names: every non-key column gets the source prefix."""
    keys = {key} if isinstance(key, str) else set(key)
    return df.select(*[F.col(c) if c in keys else F.col(c).alias(f"{prefix}{c}") for c in df.columns])


def spine_join(spine: DataFrame, features: Sequence[DataFrame], key: str,
               fill: Mapping[int, float] | float | None = None) -> DataFrame:
    """Left-join feature frames onto the spine (spine grain preserved).

    ``fill`` replaces NULL in the joined feature columns: a number for all
    frames, or ``{frame_index: value}``.
    """
    out = spine
    seen = set(spine.columns)
    for i, f in enumerate(features):
        clash = (set(f.columns) - {key}) & seen
        if clash:
            raise ValueError(f"feature frame {i} repeats columns {sorted(clash)}; prefix them first")
        seen |= set(f.columns)
        out = out.join(f, key, "left")
        v = fill.get(i) if isinstance(fill, Mapping) else fill
        if v is not None:
            out = out.fillna(v, subset=[c for c in f.columns if c != key])
    return out


def attach_key(child: DataFrame, parent: DataFrame, child_key: str, entity_key: str) -> DataFrame:
    """Two-hop lookup: bring the entity key from the parent onto child rows.

    Children whose parent is unknown get a NULL entity and are dropped, as a
    pandas groupby on the merged key drops them.
    """
    p = parent.select(F.col(child_key), F.col(entity_key)).filter(F.col(entity_key).isNotNull())
    return child.join(p, child_key, "inner")


def merge_features(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer merge of entity-grain frames with a coalesced key."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, key, "full")
    return out


def check_parity(a: DataFrame, b: DataFrame, cols: Sequence[str] | None = None) -> None:
    """Train/test schema parity by name and type (raises on mismatch), of
    ``cols`` or of all columns. What is fitted on one frame and applied to
    another passes here first: imputers, vocabularies, boosted models."""
    def of(df):
        return {f.name: f.dataType.simpleString() for f in df.schema.fields if cols is None or f.name in cols}
    sa, sb = of(a), of(b)
    missing = sorted(set(cols or ()) - set(sa) | set(cols or ()) - set(sb))
    if sa != sb or missing:
        diff = sorted(set(sa.items()) ^ set(sb.items()), key=str)
        raise ValueError(f"schema mismatch: {diff[:10] or missing[:10]}")

"""Aggregates that a user writes: init, update, merge, finish.

Where the built-in aggregates can't say it, a callback over an entity's whole history
(``groupBy().applyInPandas``) brings all rows of a hot entity into one task. Here each task
sorts the rows it has by entity and folds them into one small state each, before the shuffle; only pickled states
move, and the states of an entity are merged and finished where they meet. An entity with a
third of all rows is read by all tasks and arrives as one state from each.

``update`` gets the state and numpy arrays of this entity's rows in one Arrow batch; rows come in
any order and any split, so ``merge`` must give the same for every order. A state has to stay
small: bounded (k latest rows, moments, a sketch), not a list of all rows.

Rows with a NULL key are dropped; NULL inputs arrive as pandas has them (NaN or None); an
empty table gives no rows. Only the named columns are read, under names of their own.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_STATES = 50_000        # states that leave a task at once


@dataclass(frozen=True)
class UserAggregate:
    inputs: Sequence[str]
    init: Callable[[], Any]
    update: Callable[..., Any]          # (state, *arrays) -> state
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]
    type: str                           # Spark type of what finish returns


def aggregate(df: DataFrame, key: str | Sequence[str], aggs: Mapping[str, UserAggregate],
              most_states: int = MOST_STATES) -> DataFrame:
    """One row per entity: the key columns and one column per aggregate."""
    keys = [key] if isinstance(key, str) else list(key)
    if set(keys) & set(aggs):
        raise ValueError("an aggregate has the name of a key")
    inputs = list(dict.fromkeys(c for a in aggs.values() for c in a.inputs))
    own = [f"k{i}" for i in range(len(keys))]
    column = {c: f"v{i}" for i, c in enumerate(inputs)}
    d = df.dropna(subset=keys).select(*[F.col(c).alias(o) for c, o in zip(keys, own)],
                                      *[F.col(c).alias(v) for c, v in column.items()])
    key_fields = [T.StructField(o, d.schema[o].dataType) for o in own]
    plan = [(a, [column[c] for c in a.inputs]) for a in aggs.values()]

    def runs(b):
        """(key, first row, row after the last) of neighbouring rows with one key."""
        keys_of = [b[o].to_numpy() for o in own]
        new = np.ones(len(b), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys_of], axis=0)
        at = np.flatnonzero(new)
        return zip(zip(*[k[at].tolist() if k.dtype == object else b[o].iloc[at].tolist() for k, o in zip(keys_of, own)]), at.tolist(), [*at[1:].tolist(), len(b)])

    def partial(batches):
        done, now, s = [], None, None

        def leave():
            rows = pd.DataFrame(done, columns=[*own, "state"])
            done.clear()
            return rows

        for b in batches:
            arrays = [[b[v].to_numpy() for v in vs] for _, vs in plan]
            for k, i, j in runs(b):
                if k != now:
                    if now is not None:
                        done.append((*now, pickle.dumps(s)))
                        if len(done) > most_states:
                            yield leave()
                    now, s = k, [a.init() for a, _ in plan]
                s = [a.update(x, *[v[i:j] for v in vs]) for x, (a, _), vs in zip(s, plan, arrays)]
        if now is not None:
            done.append((*now, pickle.dumps(s)))
            yield leave()

    def meet(batches):
        now, total = None, None

        def finished(done):
            return pd.DataFrame([(*k, *[a.finish(x) for x, (a, _) in zip(s, plan)]) for k, s in done],
                                columns=[*own, *[f"o{i}" for i in range(len(plan))]], dtype=object)

        for b in batches:
            done = []
            states = b["state"].to_numpy()
            for k, i, j in runs(b):
                for raw in states[i:j]:
                    s = pickle.loads(raw)
                    if k != now:
                        if now is not None:
                            done.append((now, total))
                        now, total = k, s
                    else:
                        total = [a.merge(x, y) for x, y, (a, _) in zip(total, s, plan)]
            if done:
                yield finished(done)
        if now is not None:
            yield finished([(now, total)])

    out = T.StructType(key_fields + [T.StructField(f"o{i}", T._parse_datatype_string(a.type)) for i, (a, _) in enumerate(plan)])
    part = T.StructType(key_fields + [T.StructField("state", T.BinaryType())])
    # rows, then states of an entity lie next to each other, so each is folded in one stream, not in a call of its own
    states = d.sortWithinPartitions(*own).mapInPandas(partial, part)
    res = states.repartition(*own).sortWithinPartitions(*own).mapInPandas(meet, out)
    return res.select(*[F.col(o).alias(c) for c, o in zip(keys, own)],
                      *[F.col(f"o{i}").alias(n) for i, n in enumerate(aggs)])


# ---------------------------------------------------------------- aggregates of entity histories

def last_k_share(time: str, tiebreak: str, flag: str, k: int) -> UserAggregate:
    """Share of rows with ``flag`` among the k latest by (time, tiebreak, flag); rows without a time don't count."""
    def keep(rows):
        return sorted(rows, reverse=True)[:k]
    return UserAggregate(
        (time, tiebreak, flag), list,
        lambda s, t, u, f: keep(s + [(a, b, bool(c)) for a, b, c in zip(t, u, f) if a == a and a is not None]),
        lambda a, b: keep(a + b), lambda s: sum(r[2] for r in s) / len(s) if s else None, "double")


def mean_gap(time: str) -> UserAggregate:
    """Mean distance of neighbouring times: (last - first) / (rows - 1)."""
    def update(s, t):
        t = t[~pd.isna(t)]
        return (min(s[0], t.min()), max(s[1], t.max()), s[2] + len(t)) if len(t) else s
    return UserAggregate((time,), lambda: (float("inf"), -float("inf"), 0), update,
                         lambda a, b: (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]),
                         lambda s: float(s[1] - s[0]) / (s[2] - 1) if s[2] > 1 else None, "double")


def variation(value: str) -> UserAggregate:
    """Sample deviation over mean, from counts, means and squared distances that merge; NULL where the mean is 0."""
    def merge(a, b):
        n = a[0] + b[0]
        if not n:
            return a
        gap = b[1] - a[1]
        return n, a[1] + gap * b[0] / n, a[2] + b[2] + gap * gap * a[0] * b[0] / n

    def update(s, v):
        v = v[~pd.isna(v)].astype(float)
        return merge(s, (len(v), v.mean(), ((v - v.mean()) ** 2).sum())) if len(v) else s
    return UserAggregate((value,), lambda: (0, 0.0, 0.0), update, merge,
                         lambda s: float((s[2] / (s[0] - 1)) ** 0.5 / s[1]) if s[0] > 1 and s[1] else None, "double")

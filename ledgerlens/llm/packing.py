"""Packing documents into sequences by their length histogram.

Documents are encoded and cut into pieces of ``size`` ids and one shorter
rest.  Only the histogram of piece lengths, at most ``size`` rows, goes to the
driver, where whole numbers of pieces are placed at once: lengths are taken
from the longest to the shortest, and each goes to the packs with the most
space left (the shortest packs) or, where none has room, to new ones.  Packs
of the same content are one pattern with a count; placing a length changes or
splits patterns, so the work grows with the histogram, not with the documents.

Patterns are joined back to pieces by rank: the pieces of a length are
numbered 0, 1, ..., a pattern's slots take a range of those numbers, and the
place of a number in its range names the sequence.  Numbers come from counts
of each (task, length), without a shuffle or sort of the pieces, so that a
length that a third of all documents share is no single task's work.

Sequences are padded to ``size`` unless they hold a power of two of ids;
``sequences`` puts them together.

Defined results: NULL and empty texts are the end id alone; a NULL key is kept
as it is; rows that share a key are packed each, and ``start`` tells a
document's pieces apart; an empty table gives no pieces.  Only key and text
are read, so other columns may have any name.  Whole texts are encoded.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import written
from ledgerlens.llm.token_store import WordEncoder


def shortest_pack_first(histogram: Mapping[int, int], size: int) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns (count of packs, ((length, times), ...) in order of placement)
    of ``histogram`` (pieces by length, 1 to ``size``)."""
    packs: dict[int, list[tuple[int, tuple]]] = {}      # by space left
    spaces: list[int] = []                              # heap of -space

    def add(n: int, content: tuple, space: int):
        if n:
            if not packs.get(space):
                packs[space] = []
                heapq.heappush(spaces, -space)
            packs[space].append((n, content))
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while spaces and not packs[-spaces[0]]:
                heapq.heappop(spaces)
            space = -spaces[0] if spaces else 0
            if space < length:      # as many to a new pack as it holds, before the next is opened
                each = size // length
                add(left // each, ((length, each),), size - each * length)
                rest = left % each
                if rest:
                    add(1, ((length, rest),), size - rest * length)
                break
            n, content = packs[space].pop()
            take = min(n, left)
            if n > take:
                packs[space].append((n - take, content))
            last, times = content[-1]
            content = content[:-1] + ((length, times + 1),) if last == length else content + ((length, 1),)
            add(take, content, space - length)
            left -= take
    return [p for space in sorted(packs) for p in packs[space]]


def slots(patterns) -> dict[str, np.ndarray]:
    """For each (pattern, length): the first number of its range of that
    length's pieces, times a pack holds it, first sequence, first offset;
    sorted by length and number."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, content in patterns:
        offset = 0
        for length, times in content:
            first = used.get(length, 0)
            rows.append((length, first, times, sequence, offset))
            used[length] = first + count * times
            offset += length * times
        sequence += count
    a = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "times", "sequence", "offset"), a.T))


def _pieces(tokenizer: str, end_id: int, size: int, names: list[str], batch_bytes: int):
    """Pieces of the texts of a task, each numbered among those of its length in it."""
    def run(batches):
        enc = WordEncoder.of_worker(tokenizer)
        seen = np.zeros(size + 1, np.int64)
        for b in batches:
            step = max(1, b.num_rows * batch_bytes // max(b.nbytes, 1))
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                ids, at = enc.encode(part.column("text"))
                ids = np.insert(ids, at[1:], end_id)             # the end id after each text
                at = at + np.arange(len(at))
                n = np.diff(at)
                k = -(-n // size)                                # pieces of each document
                doc = np.repeat(np.arange(len(n)), k)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(k) - k, k)) * size
                length = np.minimum(n[doc] - start, size)
                first = at[:-1][doc] + start
                four = memoryview(ids.astype("<u4")).cast("B")
                raw = memoryview(ids.astype(enc.kind)).cast("B")
                ends = (first + length).tolist()
                spans = list(zip(first.tolist(), ends))
                w = enc.width
                rank = np.empty(len(length), np.int64)
                for j, x in enumerate(length.tolist()):
                    rank[j] = seen[x]
                    seen[x] += 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(doc)), part.column("task").take(pa.array(doc)), pa.array(start), pa.array(length),
                     pa.array([zlib.crc32(four[4 * x:4 * y]) for x, y in spans], pa.int64()), pa.array(n[doc]), pa.array(rank),
                     pa.array(np.full(len(doc), w), pa.int32()), pa.array([raw[w * x:w * y] for x, y in spans], pa.binary())], names=names)
        enc.rest()
    return run


def cut(df: DataFrame, key: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
        size: int = 2048, batch_bytes: int = 8 << 20) -> DataFrame:
    """The pieces of all documents, written: key, task, start, length,
    ids_crc32, doc_tokens, nth (among the task's pieces of that length), and
    the ids as raw little-endian integers of ``width`` bytes."""
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField("key", kind), T.StructField("task", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in (
        "start", "length", "ids_crc32", "doc_tokens", "nth")], T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())])
    src = df.select(F.col(key).alias("key"), F.spark_partition_id().alias("task"), F.col(text).alias("text"))
    return written(src.mapInArrow(_pieces(tokenizer, end_id, size, schema.names, batch_bytes), schema), "pack-pieces")


def place(pieces: DataFrame, size: int = 2048, ids: bool = False) -> DataFrame:
    """The pieces (without ``ids`` unless asked for) with sequence_id and offset."""
    spark = pieces.sparkSession
    counts = written(pieces.groupBy("length", "task").agg(F.count("*").alias("c")), "pack-counts")
    histogram = {r["length"]: r["c"] for r in counts.groupBy("length").agg(F.sum("c").alias("c")).collect()}      # at most `size` rows
    shared = spark.sparkContext.broadcast(slots(shortest_pack_first(histogram, size)))      # bounded by the histogram
    # one row per (length, task): the numbers that a task's pieces of a length begin at
    w = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("length", "task", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("before"))
    keep = ["key", "start", "length", "ids_crc32", "doc_tokens", *(["width", "ids"] if ids else [])]
    numbered = pieces.join(before, ["length", "task"]).select(*keep, (F.col("before") + F.col("nth")).alias("rank"))
    out = T.StructType([*[f for c in keep for f in numbered.schema.fields if f.name == c],
                        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches):
        s = shared.value
        first = s["length"] << 50 | s["first"]          # a length has fewer than 2**50 pieces
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            j = np.searchsorted(first, length << 50 | rank, side="right") - 1
            nth, times = rank - s["first"][j], s["times"][j]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(s["sequence"][j] + nth // times), pa.array(s["offset"][j] + nth % times * length)],
                names=out.names)
    return numbered.mapInArrow(run, out)


def pack(df: DataFrame, key: str = "doc_id", size: int = 2048, ids: bool = False, **kw) -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    out = place(cut(df, key=key, size=size, **kw), size, ids)
    return out.withColumnRenamed("key", key)


def sequences(placed: DataFrame, size: int = 2048, pad_id: int = 0) -> DataFrame:
    """sequence_id, n_tokens and the ids (padded to ``size`` unless their number
    is a power of two) of the placed pieces with their ids.  A sequence is at
    most ``size`` pieces."""
    def run(batches):
        for b in batches:
            ids = []
            for width, raw in zip(b["width"], b["raw"]):
                a = np.frombuffer(raw, f"<u{width}").astype(np.int64)
                pad = 0 if len(a) & (len(a) - 1) == 0 else size - len(a)
                ids.append(np.concatenate([a, np.full(pad, pad_id, np.int64)]))
            b = b.assign(ids=ids)
            yield b[["sequence_id", "n_tokens", "ids"]]
    g = (placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.max("width").alias("width"),
                                           F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
         .select("sequence_id", "n_tokens", "width", F.aggregate("p", F.lit(b""), lambda x, y: F.concat(x, y["ids"])).alias("raw")))
    return g.mapInPandas(run, "sequence_id long, n_tokens long, ids array<long>")

"""Token ids as raw payloads with a minimal perfect hash index.

A store is three Parquet tables in one folder of the shared file system:

``payload``  one row per block: the ids of a run of documents in ascending key
             order as raw little-endian integers (2 bytes if the vocabulary
             fits, else 4), with the length of each document;
``blocks``   per block the number of documents and ids before it in the store;
``index``    one row per hash segment of keys: a minimal perfect hash (bucket
             displacements), and per slot a fingerprint of the key, the number
             of its first document, its copies, and where its ids start.

A key is found in constant time: hash to a segment, read one displacement,
look at one slot, compare the fingerprint.  Segments hold a bounded number of
keys, so building and probing never gather more than that in one task.

Texts are encoded piece by piece with a bounded cache per worker: the
tokenizer's pattern never joins characters across white space, so the ids of a
text are the ids of its space- and line-separated pieces in order.

Defined results: NULL and empty texts are the end id alone; a NULL key is a
key of its own and comes first; rows that share a key are all stored, next to
one another, and a lookup returns each of them; an empty table gives an empty
store.  Only key and text are read, so other columns may have any name.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import shared_path, written

FINGERPRINT_BITS = 32


def encode_pieces(tok, pieces: list[str], ends: np.ndarray | None = None, kind: str = "<u4", chunk: int = 256) -> list[bytes]:
    """Ids of each piece (no white space inside) as raw integers.  Pieces are
    encoded many at a time, joined by spaces.  Where every piece is one run of
    letters, the ids that end a word tell the pieces apart (``ends``, by id);
    otherwise, or if their number differs, the character offsets do."""
    out: list[bytes] = []
    width = np.dtype(kind).itemsize
    parts = [pieces[i:i + chunk] for i in range(0, len(pieces), chunk)]
    encode = tok.encode_batch if ends is None else tok.encode_batch_fast
    for part, e in zip(parts, encode([" ".join(p) for p in parts], add_special_tokens=False)):
        ids = np.array(e.ids, kind)
        cut = np.flatnonzero(ends[ids]) + 1 if ends is not None else ()
        if len(cut) != len(part):
            e = tok.encode(" ".join(part), add_special_tokens=False) if ends is not None else e
            at = np.array([o[0] for o in e.offsets], np.int64)
            cut = np.searchsorted(at, np.cumsum([len(p) + 1 for p in part]))
        raw, first = ids.tobytes(), 0
        for c in (cut * width).tolist():
            out.append(raw[first:c])
            first = c
    return out


def word_ends(tok) -> np.ndarray | None:
    """Which ids end a word, if the vocabulary marks them."""
    vocab = tok.get_vocab(with_added_tokens=False)
    out = np.zeros(tok.get_vocab_size() + 1, bool)
    for t, i in vocab.items():
        out[i] = t.endswith("</w>")
    return out if out.any() else None


def one_run_of_letters(piece: str) -> bool:
    """Lowering keeps it a run of letters, so it is one word to the tokenizer."""
    return piece.isalpha() and piece.lower().isalpha()


def load_tokenizer(name: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(_tokenizer_file(name))


MARKS = ".,;:!?"


def _stems_and_marks(pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Pieces (ASCII in lower case) in two, whose ids follow one another:
    sentence marks after an ASCII letter or digit are tokens of their own.
    Other pieces stay whole."""
    cut = pc.match_substring_regex(pieces, f"[a-z0-9][{MARKS}]+$")
    stems = pc.if_else(cut, pc.utf8_rtrim(pieces, MARKS), pieces)
    marks = pc.if_else(cut, pc.replace_substring_regex(pieces, f"(?s)^.*[^{MARKS}]([{MARKS}]+)$", r"\1"), "")
    return stems, marks


class WordEncoder:
    """Ids of texts.  A batch of texts is lowered (ASCII, as the tokenizer
    does), split at spaces and line ends and reduced to its different pieces by
    Arrow; their stems are encoded once and cached in two generations of a
    bounded size, so that what is in use survives."""

    def __init__(self, tokenizer: str, max_stems: int = 300_000):
        self.tok = load_tokenizer(tokenizer)
        self.ends = word_ends(self.tok)
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.max_stems = max_stems
        self.cache: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}

    @classmethod
    def of_worker(cls, tokenizer: str) -> "WordEncoder":
        """One per worker process, whose tasks share its cache."""
        if tokenizer not in _ENCODERS:
            _ENCODERS[tokenizer] = cls(tokenizer)
        return _ENCODERS[tokenizer]

    def rest(self):
        """Between tasks only the younger generation stays in the worker."""
        self.old = {}
        pa.default_memory_pool().release_unused()

    def _learn(self, stems: set[str]):
        seen = stems & self.old.keys()
        self.cache.update((p, self.old[p]) for p in seen)
        words, others = [], []
        for p in stems - seen:
            (words if one_run_of_letters(p) else others).append(p)
        for group, ends in ((words, self.ends), (others, None)):
            for i in range(0, len(group), 20_000):
                part = group[i:i + 20_000]
                self.cache.update(zip(part, encode_pieces(self.tok, part, ends, self.kind)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text's ids begin (and the end)."""
        # a copy that begins at offset 0: ascii_lower reads beside the texts of a slice
        texts = texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts), dtype=np.int64)))
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, "<|")       # a special token's name in capitals must stay as it is
        low = pc.if_else(special, texts, pc.ascii_lower(texts))
        lists = pc.split_pattern(pc.replace_substring(low, "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        stems, marks = _stems_and_marks(words.dictionary)
        stems, marks = stems.dictionary_encode(), marks.dictionary_encode()
        known, ends = stems.dictionary.to_pylist(), marks.dictionary.to_pylist()
        if len(self.cache) > self.max_stems:
            self.old, self.cache = self.cache, {"": b""}
        new = set(known).union(ends).difference(self.cache)
        if new:
            self._learn(new)
        get = self.cache.__getitem__
        pieces = pc.binary_join_element_wise(pa.array(map(get, known), pa.large_binary()).take(stems.indices),
                                             pa.array(map(get, ends), pa.large_binary()).take(marks.indices),
                                             pa.scalar(b"", pa.large_binary()))
        raw = pieces.take(words.indices)
        upto = np.frombuffer(raw.buffers()[1], np.int64, len(raw) + 1, 8 * raw.offset) // self.width
        data = raw.buffers()[2]
        out = np.frombuffer(data, self.kind, int(upto[-1])) if data is not None and len(data) else np.empty(0, self.kind)
        return out, upto[lists.offsets.to_numpy()]


_ENCODERS: dict[str, WordEncoder] = {}


def _tokenizer_file(name: str) -> str:
    if os.path.sep in name:
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


PAYLOAD = ("shard int, block int, width int, lens array<int>, n_tokens long, keys array<string>, payload binary")


def _blocks(tokenizer: str, end_id: int, block_ids: int, batch_bytes: int = 8 << 20):
    def run(batches):
        enc = WordEncoder.of_worker(tokenizer)
        end = np.array([end_id], enc.kind).tobytes()
        shard, block, keys, parts, size = -1, 0, [], [], 0

        def row():
            lens = [len(p) // enc.width for p in parts]
            return pa.RecordBatch.from_pydict({"shard": [shard], "block": [block], "width": [enc.width], "lens": [lens],
                                               "n_tokens": [sum(lens)], "keys": [keys], "payload": [b"".join(parts)]}, schema=_ARROW)
        for b in batches:
            step = max(1, b.num_rows * batch_bytes // max(b.nbytes, 1))
            for i in range(0, b.num_rows, step):
                part = b.slice(i, step)
                ids, at = enc.encode(part.column("text"))
                for s, k, x, y in zip(part.column("shard").to_pylist(), part.column("key").to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                    shard, raw = s, ids[x:y].tobytes() + end
                    if parts and size + len(raw) > block_ids * enc.width:
                        yield row()
                        block, keys, parts, size = block + 1, [], [], 0
                    keys.append(k)
                    parts.append(raw)
                    size += len(raw)
        if parts:
            yield row()
        enc.rest()
    return run


_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("lens", pa.list_(pa.int32())),
                    ("n_tokens", pa.int64()), ("keys", pa.list_(pa.string())), ("payload", pa.binary())])


def write(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str = "word_bpe_49k.json",
          end_id: int = 1, block_ids: int = 1 << 19, keys_per_segment: int = 20_000, batch_bytes: int = 8 << 20) -> str:
    """Write the store; returns ``path``."""
    spark = df.sparkSession
    src = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    n = src.count()
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # ascending keys: range partitions, each sorted; NULL first; the text orders equal keys
    ordered = (src.repartitionByRange(shards, F.col("key").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("text"))
               .select(F.spark_partition_id().alias("shard"), F.col("key").cast("string").alias("key"), "text"))
    ordered.mapInArrow(_blocks(tokenizer, end_id, block_ids, batch_bytes), PAYLOAD).write.parquet(f"{path}/payload")
    payload = spark.read.parquet(f"{path}/payload")

    sizes = payload.select("shard", "block", F.size("lens").cast("long").alias("docs"), "n_tokens")
    per_shard = sizes.groupBy("shard").agg(F.sum("docs").alias("d"), F.sum("n_tokens").alias("t"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_shard.select("shard", F.coalesce(F.sum("d").over(before), F.lit(0)).alias("d0"),
                            F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"))
    (sizes.join(base, "shard")
     .select("shard", "block", "docs", "n_tokens",
             (F.col("d0") + F.coalesce(F.sum("docs").over(in_shard), F.lit(0))).alias("first_doc"),
             (F.col("t0") + F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0))).alias("first_token"))
     .write.parquet(f"{path}/blocks"))

    entries = _entries(payload, spark.read.parquet(f"{path}/blocks"))
    segments = max(1, -(-n // keys_per_segment))
    # one entry per key; equal keys are neighbours, so the first place and a count say all
    one = (entries.groupBy("key").agg(F.min(F.struct("doc", "start", "shard", "block")).alias("p"), F.count("*").alias("copies"))
           .select(*_hashes(F.col("key"), segments), "p.*", "copies"))
    (one.groupBy("segment").applyInPandas(_build_segment, INDEX)
     .withColumn("segments", F.lit(segments)).write.parquet(f"{path}/index"))
    return path


def _entries(payload: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row per stored document: key, its number, where its ids start."""
    def run(batches):
        for b in batches:
            out = []
            for s, k, lens, keys, d0, t0 in zip(b["shard"], b["block"], b["lens"], b["keys"], b["first_doc"], b["first_token"]):
                lens = np.asarray(lens, np.int64)
                out.append(pd.DataFrame({"key": list(keys), "doc": d0 + np.arange(len(lens)),
                                         "start": t0 + np.cumsum(lens) - lens, "shard": s, "block": k}))
            if out:
                yield pd.concat(out)
    j = payload.select("shard", "block", "lens", "keys").join(blocks.select("shard", "block", "first_doc", "first_token"),
                                                              ["shard", "block"])
    return j.mapInPandas(run, "key string, doc long, start long, shard int, block int")


def _hashes(key: Column, segments: int) -> list[Column]:
    """Segment, two hashes that place a key in it, and the fingerprint."""
    k = F.coalesce(key, F.lit("\0null"))
    h1, h2 = F.xxhash64(k, F.lit(1)), F.xxhash64(k, F.lit(2))
    return [F.pmod(F.xxhash64(k, F.lit(0)), F.lit(segments)).cast("int").alias("segment"), h1.alias("h1"), h2.alias("h2"),
            F.xxhash64(k, F.lit(3)).bitwiseAND((1 << FINGERPRINT_BITS) - 1).alias("fp")]


INDEX = ("segment int, n_keys int, n_buckets int, seeds binary, fps binary, docs binary, copies binary, starts binary, "
         "shards binary, blocks binary")


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _slots(h1: np.ndarray, h2: np.ndarray, seed: np.ndarray, m: int) -> np.ndarray:
    """Slot of a key under a displacement; a negative one names the slot itself."""
    s = np.asarray(seed, np.int64)
    hashed = _mix(h1 + _mix(h2 + s.astype(np.uint64))) % np.uint64(m)
    return np.where(s < 0, -s - 1, hashed.astype(np.int64))


def perfect_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements by bucket and the slot of each key: a bijection onto
    0..m-1.  Large buckets are placed first by trying displacements; buckets of
    one key take the slots that are left and store them directly."""
    m = len(h1)
    nb = max(1, -(-m // 4))
    bucket = (h2 % np.uint64(nb)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    count = np.bincount(bucket, minlength=nb)
    first = np.cumsum(count) - count
    seeds, slots, used = np.zeros(nb, np.int64), np.full(m, -1, np.int64), np.zeros(m, bool)
    singles = []
    for b in np.argsort(-count, kind="stable"):
        c = count[b]
        if c == 0:
            break
        ks = order[first[b]:first[b] + c]
        if c == 1:
            singles.append((b, ks[0]))
            continue
        d = 0
        while True:
            tries = np.arange(d, d + 32)
            s = np.sort(_slots(h1[ks][None, :], h2[ks][None, :], tries[:, None], m), axis=1)
            ok = ~used[s].any(axis=1) & (np.diff(s, axis=1) > 0).all(axis=1)
            if ok.any():
                seeds[b] = tries[ok.argmax()]
                slots[ks] = _slots(h1[ks], h2[ks], np.full(c, seeds[b]), m)
                used[slots[ks]] = True
                break
            d += 32
    for (b, k), free in zip(singles, np.flatnonzero(~used)):
        seeds[b], slots[k] = -free - 1, free
    return seeds, slots


def _build_segment(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = pdf["h1"].to_numpy().astype(np.uint64), pdf["h2"].to_numpy().astype(np.uint64)
    with np.errstate(over="ignore"):
        seeds, slots = perfect_hash(h1, h2)

    def by_slot(col, kind):
        out = np.empty(len(pdf), kind)
        out[slots] = pdf[col].to_numpy()
        return out.tobytes()
    return pd.DataFrame({"segment": [int(pdf["segment"].iloc[0])], "n_keys": [len(pdf)], "n_buckets": [len(seeds)],
                         "seeds": [seeds.astype("<i8").tobytes()], "fps": [by_slot("fp", "<u4")],
                         "docs": [by_slot("doc", "<i8")], "copies": [by_slot("copies", "<i8")],
                         "starts": [by_slot("start", "<i8")], "shards": [by_slot("shard", "<i4")],
                         "blocks": [by_slot("block", "<i4")]})


def _probe(keys: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    cols = ["key", "doc", "copies", "start", "shard", "block"]
    if keys.empty or index.empty:
        return pd.DataFrame({c: pd.Series(dtype="object" if c == "key" else "int64") for c in cols})
    ix = index.iloc[0]
    m, nb = int(ix["n_keys"]), int(ix["n_buckets"])
    h1, h2 = keys["h1"].to_numpy().astype(np.uint64), keys["h2"].to_numpy().astype(np.uint64)
    seeds = np.frombuffer(ix["seeds"], "<i8")
    with np.errstate(over="ignore"):
        slot = _slots(h1, h2, seeds[(h2 % np.uint64(nb)).astype(np.int64)], m)
    hit = np.frombuffer(ix["fps"], "<u4")[slot] == keys["fp"].to_numpy().astype(np.uint32)
    at = slot[hit]
    return pd.DataFrame({"key": keys["key"].to_numpy()[hit], "doc": np.frombuffer(ix["docs"], "<i8")[at],
                         "copies": np.frombuffer(ix["copies"], "<i8")[at], "start": np.frombuffer(ix["starts"], "<i8")[at],
                         "shard": np.frombuffer(ix["shards"], "<i4")[at], "block": np.frombuffer(ix["blocks"], "<i4")[at]})


def lookup(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """key (string), doc, copies, start, shard, block of every asked key whose
    fingerprint matches (a strange key passes with probability 2**-32)."""
    index = spark.read.parquet(f"{path}/index")
    row = index.select("segments").limit(1).collect()
    segments = row[0][0] if row else 1
    asked = keys.select(F.col(key).cast("string").alias("key")).distinct()
    asked = asked.select("key", *_hashes(F.col("key"), segments))
    return (asked.groupBy("segment").cogroup(index.groupBy("segment"))
            .applyInPandas(_probe, "key string, doc long, copies long, start long, shard int, block int"))


def read_payload(spark: SparkSession, path: str, ids: bool = False, blocks: DataFrame | None = None) -> DataFrame:
    """One row per stored document, in storage: doc, start, n_tokens,
    ids_crc32 and, if asked for, the ids; ``blocks`` limits the blocks read."""
    def run(batches):
        for b in batches:
            for s, k, w, lens, raw in zip(b["shard"], b["block"], b["width"], b["lens"], b["payload"]):
                lens = np.asarray(lens, np.int64)
                ends = np.cumsum(lens)
                starts = ends - lens
                a = np.frombuffer(raw, f"<u{w}").astype("<u4")
                out = {"shard": s, "block": k, "i": np.arange(len(lens)), "at": starts, "n_tokens": lens,
                       "ids_crc32": [zlib.crc32(a[x:y]) for x, y in zip(starts, ends)]}
                if ids:
                    out["ids"] = [a[x:y].astype(np.int64) for x, y in zip(starts, ends)]
                yield pd.DataFrame(out)
    p = spark.read.parquet(f"{path}/payload").select("shard", "block", "width", "lens", "payload")
    if blocks is not None:
        p = p.join(blocks.select("shard", "block").distinct(), ["shard", "block"], "left_semi")
    schema = "shard int, block int, i long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if ids else "")
    at = spark.read.parquet(f"{path}/blocks").select("shard", "block", "first_doc", "first_token")
    # the raw payloads stay where they are read; what was read off them is joined
    return (p.mapInPandas(run, schema).join(at, ["shard", "block"])
            .select((F.col("first_doc") + F.col("i")).alias("doc"), (F.col("first_token") + F.col("at")).alias("start"),
                    "n_tokens", "ids_crc32", *(["ids"] if ids else [])))


def _blocks_of(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """shard, block of every block that holds a document of ``found``: the block
    that the index names, and for a key of several copies those after it up to
    its last copy (counted through the block sizes, shard by shard)."""
    at = spark.read.parquet(f"{path}/blocks").select("shard", "block", "first_doc", (F.col("first_doc") + F.col("docs")).alias("end_doc"))
    upto = (F.col("doc") + F.col("copies")).alias("upto")
    many = found.filter("copies > 1").select("doc", upto, F.col("shard").alias("s0"))
    last = at.groupBy("shard").agg(F.max("end_doc").alias("shard_end"), F.min("first_doc").alias("shard_first"))
    # shards in order; a key's copies run on from its first shard
    shards = many.select("doc", "upto", F.explode(F.sequence(F.col("s0"), F.lit(_last_shard(at)))).alias("shard"))
    shards = shards.join(last, "shard").filter("shard_first < upto AND shard_end > doc").select("doc", "upto", "shard")
    more = shards.join(at, "shard").filter("first_doc < upto AND end_doc > doc").select("shard", "block")
    return found.select("shard", "block").unionByName(more).distinct()


def _last_shard(at: DataFrame) -> int:
    return at.agg(F.max("shard")).first()[0] or 0


def fetch(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id", ids: bool = False, whole: bool = False) -> DataFrame:
    """The stored documents of the asked keys: the index gives the places, the
    payload files what stands there.  Only blocks that hold an asked key are
    decoded.  A place where the payload has no document that starts as the index
    says is an error."""
    found = lookup(spark, path, keys, key)
    if not whole:
        found = written(found, "token-places")
    places = found.select("key", F.explode(F.sequence(F.col("doc"), F.col("doc") + F.col("copies") - 1)).alias("doc"),
                          F.col("doc").alias("first"), F.col("start").alias("index_start"))
    got = places.join(read_payload(spark, path, ids=ids, blocks=None if whole else _blocks_of(spark, path, found)), "doc", "left")
    wrong = (F.col("doc") == F.col("first")) & (F.col("start").isNull() | (F.col("start") != F.col("index_start")))
    start = F.when(wrong, F.raise_error(F.concat(F.lit("index and payload disagree at document "), F.col("doc").cast("string")))
                   .cast("long")).otherwise(F.col("start"))
    return got.select("key", start.alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))


def encode_documents(df: DataFrame, key: str = "doc_id", path: str | None = None, **kw) -> DataFrame:
    """Write a store of ``df`` and read every document back through its index."""
    spark = df.sparkSession
    path = write(df, path or shared_path(spark, "tokens"), key=key, **kw)
    kind = df.schema[key].dataType
    return fetch(spark, path, df.select(key), key, whole=True).select(F.col("key").cast(kind).alias(key), "start", "n_tokens", "ids_crc32")

"""Shared pieces of the text operators: word shingles, MinHash, collision
stars, connected components and bounded comparison blocks.

Words are the runs of bytes outside ``\\x20 \\x09-\\x0D`` of the UTF-8 text with
A-Z lower-cased, which is exactly ``bytes.lower().split()``.
"""

from __future__ import annotations

import gc
import os

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from mediamart.session import materialize

SHINGLE_WORDS = 5
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_WORD_CACHE = 1 << 18
_CHUNK_ENTRIES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by Spark's own reader (any store Spark can reach)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package wherever the session was started."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    return spark


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now: it
    does so when their plans are collected as garbage, which may take long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_buckets(spark: SparkSession) -> int:
    """The session's shuffle width: how many parts the input is dealt into."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------- words, shingles

class _WordHash(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASH = _WordHash()


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the word."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASH.__getitem__, words), np.uint64, len(words))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                                  0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
_CHUNK_BYTES = 1 << 18


def _turned(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _read(raw: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n bytes (4 or 8) from each place, the first byte lowest."""
    x = raw[at].astype(np.uint64)
    for j in range(1, n):
        x |= raw[at + j].astype(np.uint64) << np.uint64(8 * j)
    return x


def _hashes_of_size(raw: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """xxh64 (seed 0) of the ``size`` bytes (below 32) from each place."""
    h, j = np.full(len(at), _P5 + np.uint64(size)), 0
    while size - j >= 8:
        h, j = _turned(h ^ (_turned(_read(raw, at + j, 8) * _P2, 31) * _P1), 27) * _P1 + _P4, j + 8
    if size - j >= 4:
        h, j = _turned(h ^ (_read(raw, at + j, 4) * _P1), 23) * _P2 + _P3, j + 4
    while j < size:
        h, j = _turned(h ^ (raw[at + j].astype(np.uint64) * _P5), 11) * _P1, j + 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def words_in(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, hashes) of the words of a text whose A-Z are lower-cased, the
    hashes as ``word_hashes`` gives them; all words of one length at once."""
    raw = np.frombuffer(b"".join((b" ", text, b" ")), np.uint8)
    space = _SPACE[raw]
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    sizes = np.minimum(ends - starts, 32).astype(np.uint8)
    order = np.argsort(sizes, kind="stable")
    upto, hashes = np.cumsum(np.bincount(sizes, minlength=33)), np.empty(len(starts), np.uint64)
    for size in range(1, 32):
        these = order[upto[size - 1]:upto[size]]
        if len(these):
            hashes[these] = _hashes_of_size(raw, starts[these] + 1, size)
    for i in order[upto[31]:].tolist():
        hashes[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]])
    return starts, ends, hashes


def text_chunks(batches, *columns: str):
    """(values of the columns..., texts) of some rows at a time: as many as have
    _CHUNK_BYTES of text, or one."""
    for batch in batches:
        texts = texts_of(batch)
        others = [batch.column(x).to_pylist() for x in columns]
        a = held = 0
        for b, text in enumerate(texts, 1):
            held += len(text or b"")
            if held >= _CHUNK_BYTES or b == len(texts):
                yield *(x[a:b] for x in others), texts[a:b]
                a, held = b, 0


def shingle_hashes(w: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of the k-word shingles in order; of fewer words, one for all."""
    n = len(w)
    if n == 0:
        return w
    k = min(k, n)
    h = w[: n - k + 1] + np.uint64(k)
    for j in range(1, k):
        h = h * _FOLD + w[j: n - k + 1 + j]
    return mix(h)


def shingle_set(text: bytes | None, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(shingle_hashes(word_hashes(words_of(text)), k))


def sequence_key(words: list[bytes]) -> bytes:
    """128-bit key of a word sequence: equal sequences have equal shingles."""
    return xxhash.xxh3_128_digest(b" ".join(words))


# ---------------------------------------------------------------- MinHash

class MinHash:
    """``bands * rows`` minimum hashes of a shingle set and their band keys."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        self.bands, self.rows = bands, rows
        rng = np.random.default_rng(seed)
        n = bands * rows
        self._a = (rng.integers(0, 1 << 32, n, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
        self._b = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)[:, None]

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        x = (shingles >> np.uint64(32)).astype(np.uint32)[None, :]
        low = (self._a * x[:, :256] + self._b).min(1)
        for i in range(256, x.shape[1], 256):
            np.minimum(low, (self._a * x[:, i:i + 256] + self._b).min(1), out=low)
        return low

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """(n, bands) keys; equal keys mean equal rows of the same band."""
        s = signatures.reshape(-1, self.bands, self.rows).astype(np.uint64)
        h = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), s.shape[:2]).copy()
        for j in range(self.rows):
            h = h * _FOLD + s[:, :, j]
        return mix(h).view(np.int64)


# ---------------------------------------------------------------- Arrow helpers

def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def sliced(batches, rows: int = 256):
    """The batches in smaller ones, for work that holds all words of a batch."""
    for batch in batches:
        for a in range(0, batch.num_rows, rows):
            yield batch.slice(a, rows)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(fn, schema)


def record(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def groups(batches, keys: list[str]):
    """Consecutive rows with equal ``keys`` from sorted batches, as lists of
    row dicts. Used only where a group's size has a bound."""
    current, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if key != current and rows:
                yield current, rows
                rows = []
            current = key
            rows.append(row)
    if rows:
        yield current, rows


# ---------------------------------------------------------------- hot keys

LEAST_HOT_ROWS, MOST_HOT_KEYS = 1_000, 20_000


def hot_key_join(rows: DataFrame, small: DataFrame, key: str, how: str = "inner", counted: str | None = None) -> DataFrame:
    """``rows.join(small, key, how)`` (inner or left) where ``small`` has one row a key and
    a key may hold a third of all ``rows``, a written table. ``counted`` names the column of
    ``small``, then a written table too, that tells how many rows have the key; else they
    are counted here.

    Keys of more than LEAST_HOT_ROWS rows, and of more than 1 / MOST_HOT_KEYS of them,
    are MOST_HOT_KEYS at most: their rows stay where they lie and meet a broadcast
    of those keys. All others are joined by a shuffle, in which no key is hot.
    """
    least = max(LEAST_HOT_ROWS, rows.count() // MOST_HOT_KEYS)
    if counted:
        hot = small.where(F.col(counted) > least).select(key)
    else:
        hot = materialize(rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > least).select(key), "hot_keys")
    if hot.isEmpty():
        return rows.join(small, key, how)
    hot = F.broadcast(hot)
    here = F.broadcast(small.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(here, key, how).unionByName(rows.join(hot, key, "left_anti").join(small, key, how))


# ---------------------------------------------------------------- collisions

def _stars(keys: np.ndarray, nodes: np.ndarray):
    """Per key the smallest node; and an edge from every other node to it."""
    order = np.lexsort((nodes, keys))
    k, v = keys[order], nodes[order]
    first = np.r_[True, k[1:] != k[:-1]]
    low = v[first][np.cumsum(first) - 1]
    other = v != low
    edges = np.unique(np.stack([v[other], low[other]], 1), axis=0) if other.any() else np.empty((0, 2), np.int64)
    return k[first], v[first], edges


_BLOB = pa.schema([("bucket", pa.int32()), ("is_edge", pa.bool_()), ("blob", pa.binary())])
_EDGE = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def collision_edges(df: DataFrame) -> DataFrame:
    """Edges (u, v) that connect all nodes sharing a key.

    ``df`` has ``node`` long and ``keys`` binary (packed int64 keys). Each task
    first links its own nodes to the smallest one per key and passes on only
    that one, so a key that a third of all rows carry sends one entry per task;
    entries travel packed by bucket. No pairs within a group are formed.
    """
    buckets = shuffle_buckets(df.sparkSession)

    def local(batches):
        def flush(nodes, blobs):
            v = np.concatenate(nodes)
            keys = np.frombuffer(b"".join(blobs), np.int64)
            per_row = np.array([len(b) // 8 for b in blobs])
            k, low, edges = _stars(keys, np.repeat(v, per_row))
            bucket = ((k.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            k, low, bucket = k[order], low[order], bucket[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            parts = [(int(bucket[a]), False, k[a:b].tobytes() + low[a:b].tobytes())
                     for a, b in zip(cuts, np.r_[cuts[1:], len(k)])]
            for a in range(0, len(edges), 65536):
                parts.append((int(edges[a, 0] % buckets), True, edges[a:a + 65536].tobytes()))
            return record(_BLOB, list(zip(*parts)))

        nodes, blobs, held = [], [], 0
        for batch in batches:
            ks = batch.column("keys").to_pylist()
            nodes.append(batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64))
            blobs += ks
            held += sum(map(len, ks)) // 8
            if held >= _CHUNK_ENTRIES:
                yield flush(nodes, blobs)
                nodes, blobs, held = [], [], 0
        if held:
            yield flush(nodes, blobs)

    def meet(batches):
        def joined(blobs):
            ks, vs = zip(*((x[: len(x) // 2], x[len(x) // 2:]) for x in blobs))
            return _stars(np.frombuffer(b"".join(ks), np.int64), np.frombuffer(b"".join(vs), np.int64))[2]

        current, blobs = None, []
        for batch in batches:
            for bucket, is_edge, blob in zip(*(c.to_pylist() for c in batch.columns)):
                if is_edge:
                    e = np.frombuffer(blob, np.int64).reshape(-1, 2)
                    yield record(_EDGE, [e[:, 0], e[:, 1]])
                    continue
                if bucket != current and blobs:
                    e = joined(blobs)
                    yield record(_EDGE, [e[:, 0], e[:, 1]])
                    blobs = []
                current = bucket
                blobs.append(blob)
        if blobs:
            e = joined(blobs)
            yield record(_EDGE, [e[:, 0], e[:, 1]])

    dealt = (map_arrow(df.select("node", "keys"), local, "bucket int, is_edge boolean, blob binary")
             .repartition(buckets, "bucket").sortWithinPartitions("bucket"))
    return map_arrow(dealt, meet, "u long, v long")


# ---------------------------------------------------------------- components

def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable over edges
    (u, v). Nodes without an edge to another node do not appear.

    Every round each node moves to the neighbour (or itself) with the smallest
    seeded hash and edges are contracted, so the number of nodes shrinks
    geometrically whatever the shape (a chain included). Each round is a table
    in the shared folder; only "is an edge left" reaches the driver.
    """
    pair = edges.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    current = materialize(pair.distinct(), "edges")
    levels = []
    while not current.isEmpty():
        seed = F.lit(len(levels))
        order = lambda c: F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("id"))
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        parent = materialize(
            both.groupBy("u").agg(F.min(order("v")).alias("n"))
            .select(F.col("u").alias("node"), F.least(F.col("n"), order("u"))["id"].alias("parent")), "parents")
        levels.append(parent)
        pu = parent.select(F.col("node").alias("u"), F.col("parent").alias("pu"))
        pv = parent.select(F.col("node").alias("v"), F.col("parent").alias("pv"))
        moved = current.join(pu, "u").join(pv, "v").where("pu <> pv")
        current = materialize(
            moved.select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "edges")
    if not levels:
        return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    found = levels[0].select("node", F.col("parent").alias("at"))
    for parent in levels[1:]:
        nxt = parent.select(F.col("node").alias("at"), F.col("parent").alias("to"))
        found = found.join(nxt, "at", "left").select("node", F.coalesce("to", "at").alias("at"))
    found = materialize(found, "roots")
    low = found.groupBy("at").agg(F.min("node").alias("component"))
    return found.join(low, "at").select("node", "component")


# ---------------------------------------------------------------- blocks

BLOCK_ROWS = 256
BLOCK_BYTES = 16 << 20


def comparison_blocks(members: DataFrame) -> DataFrame:
    """Deal the ``members`` (node, cluster, body binary, ...) of every cluster
    into tasks that together see every pair of a cluster exactly once.

    A cluster of any size is cut into blocks of about BLOCK_ROWS rows and
    BLOCK_BYTES bytes; a task holds two blocks (or one with itself). Adds
    ``block``, ``left`` and ``right``; rows come sorted by task.
    """
    size = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum(F.length("body")) / BLOCK_BYTES), F.lit(1))
        .cast("int").alias("blocks"))
    cut = members.join(size, "cluster").withColumn("block", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
    task = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = (task.withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
            .drop("other", "blocks"))
    return (task.repartition("cluster", "left", "right")
            .sortWithinPartitions("cluster", "left", "right", "block", "node"))


def task_pairs(blocks: np.ndarray, left: int, right: int):
    """Row index ranges of the two sides a task compares."""
    a = np.flatnonzero(blocks == left)
    return (a, a) if left == right else (a, np.flatnonzero(blocks == right))


def intersections(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray, span: int = 1 << 13) -> np.ndarray:
    """Exact sizes of the intersections of ``sets[rows] x sets[cols]``.

    A shingle of one set only cannot meet another, so only shared ones become
    columns of a 0/1 matrix, taken ``span`` at a time to bound memory.
    """
    ids, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    out = np.zeros((len(rows), len(cols)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for lo in range(0, width, span):
        a, b = np.searchsorted(column, [lo, lo + span])
        m = np.zeros((len(sets), min(span, width - lo)), np.float32)
        m[owner[a:b], column[a:b] - lo] = 1
        out += m[rows] @ m[cols].T
    return np.rint(out).astype(np.int64)


def forest(pairs: np.ndarray, n: int) -> np.ndarray:
    """A spanning forest of the given links: as many as connect the same rows."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in pairs.tolist():
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[ra] = rb
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)

"""Substring dedup by paragraphs: MinHash banding, exact Jaccard, components.

A paragraph is a line of MIN_WORDS words or more. Equal word sequences are one
paragraph class. Classes that collide in a band are connected (no pairs are
formed), the components are cut into bounded blocks, and banded pairs in a block
are verified by the exact Jaccard similarity of their five-word shingle sets.
Of every component of verified links the first paragraph by (doc_id, position)
stays; the others are removals.

Bands are tuned for recall: 16 bands of 4 rows miss a pair at similarity 0.8 with
probability (1 - 0.8**4)**16 = 2e-4, at 0.9 with 1e-7. Class ids are 64-bit hashes;
that two of n different paragraphs share one has probability n**2 / 2**65.

A passage is PASSAGE_WORDS consecutive words anywhere in a text, lines or not. A
text's passages are chosen by content: of every SHARED_WORDS - PASSAGE_WORDS + 1
consecutive ones the one with the smallest hash. So two texts that share a run of
SHARED_WORDS words share a chosen passage, wherever the run lies in them. Colliding
passages are verified by what surrounds them: a band key for each run of
SHARED_WORDS words that holds the passage joins those that lie in a shared run of
that length, and only those; removals are clustered by components again. One changed
word in such a run costs five of its 46 shingles: parts of a changed run are found
where they reach SHARED_WORDS between changes (or, as whole lines, at 0.8).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c
from mediamart.session import materialize

MIN_WORDS = 10
PASSAGE_WORDS, SHARED_WORDS = 20, 50
BANDS, ROWS = 16, 4
_SEEN = 1 << 17
_FOLD = 0xD6E8FEB86659FD93
_PARAGRAPHS = pa.schema([("doc_id", pa.int64()), ("paragraph", pa.int32()), ("n_words", pa.int32()),
                         ("node", pa.int64()), ("keys", pa.binary())])


def long_lines(text: bytes | None, min_words: int):
    """(position, line, words) of every line with enough words."""
    for i, line in enumerate((text or b"").split(b"\n")):
        words = line.lower().split()
        if len(words) >= min_words:
            yield i, line, words


def class_id(words: list[bytes]) -> int:
    h = xxhash.xxh3_64_intdigest(b" ".join(words))
    return h - (1 << 64) if h >> 63 else h


def line_signatures(hasher: c.MinHash, lines: list[list[bytes]]) -> np.ndarray:
    """MinHash signatures of many lines (each of five words or more) at once."""
    return _signatures(hasher, c.word_hashes([w for words in lines for w in words]), np.array([len(w) for w in lines]))


def _signatures(hasher: c.MinHash, hashed: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The same from the hashes of all words and the number of words of each line."""
    k = c.SHINGLE_WORDS
    ends = np.cumsum(counts)
    inside = np.ones(len(hashed), bool)  # shingles that do not run into the next line
    for j in range(1, k):
        inside[ends - j] = False
    x = (c.shingle_hashes(hashed, k)[inside[: len(hashed) - k + 1]] >> np.uint64(32)).astype(np.uint32)
    starts = np.r_[0, np.cumsum(counts - k + 1)]
    out, a = np.empty((len(counts), len(hasher._a)), np.uint32), 0
    while a < len(counts):  # some 4096 shingles at a time
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + 4096)) - 1)
        part = hasher._a * x[None, starts[a]:starts[b]] + hasher._b
        out[a:b] = np.minimum.reduceat(part, starts[a:b] - starts[a], axis=1).T
        a = b
    return out


def _lines_of(texts: list[bytes | None], min_words: int):
    """Of all lines with enough words: (text number, position, words, node, all words'
    hashes, number of the first one)."""
    whole = b"\n".join(t or b"" for t in texts).lower()
    starts, ends, hashed = c.words_in(whole)
    breaks = np.flatnonzero(np.frombuffer(whole, np.uint8) == 10)
    first = np.searchsorted(starts, np.r_[0, breaks])
    counts = np.diff(np.r_[first, len(starts)])
    opening = np.cumsum([0, *(1 + (t or b"").count(b"\n") for t in texts)])  # the first line of each text
    line = np.flatnonzero(counts >= min_words)
    text, first, counts = np.searchsorted(opening, line, "right") - 1, first[line], counts[line]
    raw, plain = np.frombuffer(whole, np.uint8), np.ones(len(starts), np.int64)  # one blank before the word
    plain[1:] = (starts[1:] - ends[:-1] == 1) & (raw[ends[:-1]] == 32)
    plain = np.r_[0, np.cumsum(plain)]
    even = plain[first + counts] - plain[first + 1] == counts - 1
    nodes = []
    for a, b, is_even in zip(starts[first].tolist(), ends[first + counts - 1].tolist(), even.tolist()):
        nodes.append(class_id([whole[a:b]] if is_even else whole[a:b].split()))
    return text, line - opening[text], counts, nodes, hashed, first


def _paragraphs(docs: DataFrame, min_words: int) -> DataFrame:
    def run(batches):
        hasher, seen = c.MinHash(BANDS, ROWS), set()
        for ids, texts in c.text_chunks(batches, "doc_id"):
            text, at, counts, nodes, hashed, first = _lines_of(texts, min_words)
            fresh = []
            for i, node in enumerate(nodes):
                if node not in seen:  # a class needs its keys once; this task forgets after a while
                    seen.add(node)
                    fresh.append(i)
            if len(seen) > _SEEN:
                seen.clear()
            if nodes:
                keys = [None] * len(nodes)
                if fresh:
                    words = np.concatenate([hashed[a:b] for a, b in zip(first[fresh].tolist(), (first + counts)[fresh].tolist())])
                    for i, key in zip(fresh, hasher.band_keys(_signatures(hasher, words, counts[fresh]))):
                        keys[i] = key.tobytes()
                yield c.record(_PARAGRAPHS, [np.array(ids, np.int64)[text], at.astype(np.int32), counts.astype(np.int32), nodes, keys])

    return c.map_arrow(docs.select("doc_id", "text"), run, "doc_id long, paragraph int, n_words int, node long, keys binary")


_BODIES = pa.schema([("cluster", pa.int64()), ("node", pa.int64()), ("body", pa.binary())])


def _bodies(docs: DataFrame, wanted: DataFrame, min_words: int) -> DataFrame:
    """(cluster, node, body): the text of one paragraph of each class in a cluster."""
    lists = wanted.groupBy("doc_id").agg(F.collect_list(F.struct("paragraph", "node", "cluster")).alias("wanted"))
    joined = docs.select("doc_id", "text").join(lists, "doc_id").select("text", "wanted")

    def run(batches):
        for batch in batches:
            out = []
            for text, wanted_here in zip(c.texts_of(batch), batch.column("wanted").to_pylist()):
                lines = {i: (line, words) for i, line, words in long_lines(text, min_words)}
                for w in wanted_here:
                    line, words = lines.get(w["paragraph"], (None, None))
                    if line is not None and class_id(words) == w["node"]:
                        out.append((w["cluster"], w["node"], line))
            if out:
                yield c.record(_BODIES, list(zip(*out)))

    return c.map_arrow(joined, run, "cluster long, node long, body binary")


def _links(tasks: DataFrame, percent: int) -> DataFrame:
    def found(items, left, right, hasher):
        sets = [c.shingle_set(r["body"]) for r in items]
        a, b = c.task_pairs(np.array([r["block"] for r in items]), left, right)
        keys = hasher.band_keys(np.array([hasher.signature(s) for s in sets]))
        live = np.zeros((len(a), len(b)), bool)
        for j in range(BANDS):
            live |= keys[a, j][:, None] == keys[b, j][None, :]
        if left == right:
            live &= np.triu(np.ones(live.shape, bool), 1)
        if not live.any():
            return None
        both = c.intersections(sets, a, b)
        sizes = np.array([len(s) for s in sets])
        i, j = np.nonzero(live & (100 * both >= percent * (sizes[a][:, None] + sizes[b][None, :] - both)))
        pairs = c.forest(np.stack([a[i], b[j]], 1), len(sets))
        node = np.array([r["node"] for r in items], np.int64)
        return c.record(c._EDGE, [node[pairs[:, 0]], node[pairs[:, 1]]])

    def run(batches):
        hasher = c.MinHash(BANDS, ROWS)
        for (_, left, right), items in c.groups(batches, ["cluster", "left", "right"]):
            edges = found(items, left, right, hasher)
            if edges is not None:
                yield edges

    return c.map_arrow(tasks.select("cluster", "left", "right", "block", "node", "body"), run, "u long, v long")


def repeated_paragraphs(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """Every paragraph that has an equal or near-equal one (100 * intersection >=
    percent * union of shingle sets, transitively): doc_id, paragraph (line number
    from 0), n_words, first_doc_id and first_paragraph (the one that stays),
    n_copies (paragraphs of the component) and removed.

    Needs doc_id and text; other columns are ignored. ``min_words`` is five or
    more. Null texts and shorter lines take no part, nor do rows whose doc_id is
    null. Rows that repeat a doc_id are one document, whose lines may repeat. An empty
    table gives no rows.
    """
    if min_words < c.SHINGLE_WORDS:
        raise ValueError(f"min_words must be {c.SHINGLE_WORDS} or more")
    docs = docs.where("doc_id is not null")
    paragraphs = materialize(_paragraphs(docs, min_words), "paragraphs")
    clusters = c.connected_components(c.collision_edges(paragraphs.where("keys is not null").select("node", "keys")))
    places = paragraphs.drop("keys")
    chosen = (places.groupBy("node").agg(F.min(F.struct("doc_id", "paragraph")).alias("at")).join(clusters, "node")
              .select("node", F.col("component").alias("cluster"), "at.doc_id", "at.paragraph"))
    links = _links(c.comparison_blocks(_bodies(docs, chosen, min_words).distinct()), percent)
    components = c.connected_components(links)
    owned = c.hot_key_join(places, components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    owned = materialize(owned.select("doc_id", "paragraph", "n_words", "component"), "owned")
    repeated = owned.groupBy("component").agg(F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "paragraph")).alias("first")).where("n_copies > 1")
    out = c.hot_key_join(owned, materialize(repeated, "repeated"), "component", counted="n_copies").select(
        "doc_id", "paragraph", "n_words", F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.paragraph").alias("first_paragraph"), "n_copies")
    return out.withColumn("removed", (F.col("doc_id") != F.col("first_doc_id")) | (F.col("paragraph") != F.col("first_paragraph")))


_PASSAGES = pa.schema([("doc_id", pa.int64()), ("word", pa.int32()), ("passage", pa.int64()), ("node", pa.int64())])
_KEYED = pa.schema([("node", pa.int64()), ("keys", pa.binary())])


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k`` words from each place on, from word hashes (``k`` or more).

    Sums of words[i + j] * _FOLD ** (k - 1 - j), doubled and lengthened by the bits of k:
    some 2 log2(k) steps instead of k."""
    n, h, width = len(words), words, 1
    for bit in bin(k)[3:]:
        h, width = h[:n - 2 * width + 1] * np.uint64(pow(_FOLD, width, 1 << 64)) + h[width:], 2 * width
        if bit == "1":
            h, width = h[:n - width] * np.uint64(_FOLD) + words[width:], width + 1
    return c.mix(h)


def _sliding(x: np.ndarray, span: int, low) -> np.ndarray:
    """``low`` (minimum or maximum) of every ``span`` consecutive values."""
    width = 1
    while 2 * width <= span:
        x, width = low(x[:-width], x[width:]), 2 * width
    rest = span - width
    return low(x[:len(x) - rest], x[rest:]) if rest else x


def chosen_passages(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first words, ids) of the passages that a text's content chooses, from its word hashes."""
    if len(words) < PASSAGE_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    ids = run_hashes(words, PASSAGE_WORDS)
    return _chosen(ids, min(SHARED_WORDS - PASSAGE_WORDS + 1, len(ids)))


def _chosen(ids: np.ndarray, span: int, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The passages with the smallest hash of any ``span`` consecutive ones (of those
    that are ``inside``, by their first one)."""
    order = c.mix(ids ^ np.uint64(0x5851F42D4C957F2D))  # another hash than the id, whose bits stay even
    lows = _sliding(order, span, np.minimum)
    if inside is not None:
        lows = np.where(inside, lows, np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.r_[edge, lows, edge], span, np.maximum) == order)
    return at, ids[at].view(np.int64)


def _chosen_of_all(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, first words, passages, contexts) as ``chosen_passages`` and
    ``contexts_of`` give them for each of many texts (of SHARED_WORDS words or more), whose
    words follow one another."""
    ends = np.cumsum(counts)
    inside = np.ones(len(words) - SHARED_WORDS + 1, bool)  # runs that do not go on into the next text
    for j in range(1, SHARED_WORDS):
        inside[ends[:-1] - j] = False
    at, passage = _chosen(run_hashes(words, PASSAGE_WORDS), SHARED_WORDS - PASSAGE_WORDS + 1, inside)
    text = np.searchsorted(ends, at, "right")
    whole = at <= ends[text] - PASSAGE_WORDS
    at, passage, text = at[whole], passage[whole], text[whole]
    begin = ends - counts
    node = _context_ids(run_hashes(words, SHARED_WORDS), at, begin[text], ends[text] - SHARED_WORDS)[0]
    return text, at - begin[text], passage, node


def passages_of(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """(first words, ids) of the passages of a text that its content chooses."""
    return chosen_passages(c.word_hashes(c.words_of(text)))


def contexts_of(words: np.ndarray, at: np.ndarray, with_keys: bool = False) -> tuple[np.ndarray, list]:
    """(ids, keys) of the passages at word numbers ``at`` with what surrounds them, in a
    text of SHARED_WORDS words or more: a key for each run of SHARED_WORDS words that
    holds the passage, by its words and its place around it (only if asked for). Two
    passages share a key where they lie in a shared run, and an id where all their
    runs are equal."""
    runs = run_hashes(words, SHARED_WORDS)
    ids, first, last = _context_ids(runs, at, 0, len(runs) - 1)
    keys = []
    if with_keys:
        each = last - first + 1
        ends = np.cumsum(each)
        run = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - each, each) + np.repeat(first, each)
        place = (np.repeat(at, each) - run).astype(np.uint64)
        flat = c.mix(runs[run] + place * np.uint64(0x9E3779B97F4A7C15)).tobytes()
        keys = [flat[8 * (b - n):8 * b] for b, n in zip(ends.tolist(), each.tolist())]
    return ids, keys


def _context_ids(runs: np.ndarray, at: np.ndarray, low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, first, last): the first and the last run, of those from ``low`` to ``high``, that
    holds the passage, and an id of both."""
    first, last = np.maximum(low, at - SHARED_WORDS + PASSAGE_WORDS), np.minimum(at, high)
    ids = c.mix(c.mix(runs[first] + (at - first).astype(np.uint64)) + runs[last] * np.uint64(5) + (at - last).astype(np.uint64))
    return ids.view(np.int64), first, last


def _hashed_texts(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, number of the first word of each text and of the end)."""
    lower = [(t or b"").lower() for t in texts]
    starts, _, hashed = c.words_in(b" ".join(lower))
    return hashed, np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in lower)]))


def _passages(docs: DataFrame) -> DataFrame:
    """(doc_id, word, passage, node): every chosen passage and the id of its context.
    A text of fewer than SHARED_WORDS words shares no run of that length."""
    def run(batches):
        for ids, texts in c.text_chunks(batches, "doc_id"):
            hashed, first = _hashed_texts(texts)
            counts = np.diff(first)
            long = np.flatnonzero(counts >= SHARED_WORDS)
            if len(long):
                words = hashed if len(long) == len(texts) else hashed[np.repeat(counts >= SHARED_WORDS, counts)]
                text, at, passage, node = _chosen_of_all(words, counts[long])
                yield c.record(_PASSAGES, [np.array(ids, np.int64)[long[text]], at.astype(np.int32), passage, node])

    return c.map_arrow(docs.select("doc_id", "text"), run, "doc_id long, word int, passage long, node long")


def _keyed(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(node, keys) of the contexts at ``places`` (doc_id, word, passage, node)."""
    wanted = places.groupBy("doc_id").agg(F.collect_set(F.struct("word", "passage", "node")).alias("wanted"))
    joined = docs.select("doc_id", "text").join(wanted, "doc_id").select("text", "wanted")

    def run(batches):
        for batch in c.sliced(batches, 64):
            asked = batch.column("wanted")
            ends = asked.offsets.to_numpy()
            numbers, passages, nodes = (asked.values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            out, keys = [], []
            texts = c.texts_of(batch)
            hashed, starts = _hashed_texts(texts)
            for i in range(len(texts)):
                words = hashed[starts[i]:starts[i + 1]]
                if len(words) < SHARED_WORDS:  # another row of this doc_id
                    continue
                own = run_hashes(words, PASSAGE_WORDS).view(np.int64)
                here = slice(ends[i], ends[i + 1])
                at, passage, node = numbers[here].astype(np.int64), passages[here], nodes[here]
                on = np.flatnonzero(at < len(own))  # another row of this doc_id may be shorter, or other
                on = on[own[at[on]] == passage[on]]
                ids, found = contexts_of(words, at[on], True)
                same = ids == node[on]
                out.append(ids[same])
                keys += [k for k, ok in zip(found, same.tolist()) if ok]
            if keys:
                yield c.record(_KEYED, [np.concatenate(out), pa.array(keys, pa.binary())])

    return c.map_arrow(joined, run, "node long, keys binary")


def _repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, word, passage, first_doc_id, first_word, n_copies, removed)."""
    spark, docs = docs.sparkSession, docs.where("doc_id is not null")
    places = materialize(_passages(docs), "passages")
    # Passages whose places all have one context need no keys; of the others, one place of each context has them.
    ids = materialize(places.groupBy("passage").agg(F.count("*").alias("n"), (F.min("node") < F.max("node")).alias("several"))
                      .where("n > 1"), "repeated_ids")
    contexts = materialize(c.hot_key_join(places, ids, "passage", counted="n").drop("n"), "contexts")
    c.release(spark)
    mixed, plain = materialize(contexts.where("several"), "mixed"), contexts.where("not several")
    kinds = mixed.groupBy("passage", "node").agg(F.min(F.struct("doc_id", "word")).alias("at"))
    keyed = _keyed(docs, kinds.select("at.*", "passage", "node"))
    components = c.connected_components(c.collision_edges(keyed))
    c.release(spark)
    owned = c.hot_key_join(mixed, components, "node", "left").select("doc_id", "word", "passage", F.coalesce("component", "node").alias("component"))
    owned = materialize(owned.union(plain.select("doc_id", "word", "passage", "node")), "owned_passages")
    repeated = (owned.groupBy("component").agg(F.count("*").alias("n_copies"), F.min(F.struct("doc_id", "word")).alias("first"))
                .where("n_copies > 1"))
    return c.hot_key_join(owned, materialize(repeated, "repeated_passages"), "component", counted="n_copies").select(
        "doc_id", "word", "passage", F.col("first.doc_id").alias("first_doc_id"), F.col("first.word").alias("first_word"), "n_copies",
        ((F.col("doc_id") != F.col("first.doc_id")) | (F.col("word") != F.col("first.word"))).alias("removed"))


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Every chosen passage that lies in a run of SHARED_WORDS words or more which
    another place has too, wherever it lies in its line or over lines: the columns of ``repeated_paragraphs``, where paragraph is the
    number of its first word in the text (from 0).

    Every run of SHARED_WORDS words or more that two places share holds such a
    passage, and no shorter run does. Null texts, null doc_ids, repeated doc_ids and empty tables are taken
    as in ``repeated_paragraphs``.
    """
    return _repeated_passages(docs).select(
        "doc_id", F.col("word").alias("paragraph"), F.lit(PASSAGE_WORDS).alias("n_words"), "first_doc_id",
        F.col("first_word").alias("first_paragraph"), "n_copies", "removed")


def repeated_units(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """The repeated paragraphs (``unit`` is line) and the repeated passages of the
    whole texts (``unit`` is passage)."""
    lines = repeated_paragraphs(docs, percent, min_words).withColumn("unit", F.lit("line"))
    return lines.unionByName(repeated_passages(docs).withColumn("unit", F.lit("passage")))


def drop_repeated_paragraphs(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the removed paragraphs cut out of ``text``; columns unchanged.
    Passages stay; ``drop_repeated_units`` cuts them too."""
    cut = (repeated_paragraphs(docs, percent, min_words).where("removed")
           .groupBy(F.col("doc_id").alias("cut_id")).agg(F.collect_set("paragraph").alias("cut")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text").join(cut, F.col("doc_id") == F.col("cut_id"), "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.concat_ws("\n", F.filter(lines, lambda _, i: ~F.array_contains("cut", i)))
    clean = F.when(F.col("cut").isNull(), F.col("text")).otherwise(kept)
    return rows.select(*[clean.alias("text") if x == "text" else F.col("row")[x].alias(x) for x in docs.columns])


_WORD = re.compile(rb"[^ \t-\r]+")


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans (first, end) and the blanks after them."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, end in spans:
        stop = words[end - 1][1]
        while text[stop:stop + 1] in (b" ", b"\t"):
            stop += 1
        out.append(text[at:words[first][0]])
        at = stop
    return b"".join([*out, text[at:]])


def cut_passages(text: bytes, marked: list[tuple[int, int, bool]]) -> bytes:
    """The text without its removed passages (word, node, removed); the words of
    those that stay are kept, also where a removed one overlaps them."""
    words = c.words_of(text)
    ids = run_hashes(c.word_hashes(words), PASSAGE_WORDS).view(np.int64) if len(words) >= PASSAGE_WORDS else []
    cut = np.zeros(len(words) + 1, bool)
    for goes in (True, False):
        for word, node, removed in marked:
            if removed == goes and word < len(ids) and ids[word] == node:
                cut[word:word + PASSAGE_WORDS] = goes
    edges = np.flatnonzero(np.diff(np.r_[False, cut].astype(np.int8)))
    return _without(text, [tuple(x) for x in edges.reshape(-1, 2).tolist()])


def drop_repeated_units(docs: DataFrame, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the removed paragraphs, then the removed passages of what is
    left, cut out of ``text``; columns unchanged."""
    docs = materialize(drop_repeated_paragraphs(docs, percent, min_words), "without_lines")
    marked = (_repeated_passages(docs).groupBy(F.col("doc_id").alias("cut_id"))
              .agg(F.collect_set(F.struct("word", "passage", "removed")).alias("marked")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text").join(marked, F.col("doc_id") == F.col("cut_id"), "left")

    def run(batches):
        for batch in batches:
            texts = []
            for text, places in zip(c.texts_of(batch), batch.column("marked").to_pylist()):
                places = [(p["word"], p["passage"], p["removed"]) for p in places or []]
                texts.append((cut_passages(text, places) if places and text else text))
            row = batch.column("row")
            columns = {f.name: row.field(i) for i, f in enumerate(row.type)}
            columns["text"] = pa.array([t if t is None else t.decode() for t in texts], pa.string())
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return c.map_arrow(rows.select("row", "text", "marked"), run, docs.schema)

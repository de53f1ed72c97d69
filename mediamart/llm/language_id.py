"""Language identification by prediction by partial matching.

Per language, a byte context tree of order 3 to 0 with frozen counts. In a
context seen T times with d different symbols, a symbol seen n times has
probability n / (T + d); the escape to the next shorter context has d / (T + d)
and shares itself among the symbols not seen there (method C with exclusion; the
last level is uniform). So every context's probabilities sum to one and
-log2 of their product is the exact length of a text's code. The language with the
shortest code wins; the score is its posterior under equal priors.

Symbols are bytes, all 256 of them, folded: A-Z lower-cased, white space as one
blank, digits as one digit. The tree is kept sparse: a language costs as much
memory as it has contexts, whatever the other languages' scripts are.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c

ORDER = 3  # with the symbol itself a context fits 32 bits
HELD_OUT = 2
LONG_BYTES = 200  # texts that tell how many bits a byte are usual
SPREAD, LEAST_SPREAD, SHORT_BITS = 16.0, 1.5, 32.0
PIECE_CELLS = 1 << 24  # cells times languages that a worker holds code lengths of at once
_FLUSH = 1 << 23


def _fold_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    t[65:91] += 32
    t[[9, 10, 11, 12, 13]] = 32
    t[48:58] = 48
    return t


FOLD = _fold_table()


def held_out() -> "F.Column":
    """True where crc32 of the doc_id's decimal text is 2 modulo 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == HELD_OUT, F.lit(False))


def codes(text: bytes) -> np.ndarray:
    """Every position's symbol (lowest byte) with the ORDER symbols before it; a
    text starts after blanks."""
    s = np.full(len(text) + ORDER, 32, np.uint32)
    s[ORDER:] = FOLD[np.frombuffer(text, np.uint8)]
    return s[:-3] << np.uint32(24) | s[1:-2] << np.uint32(16) | s[2:-1] << np.uint32(8) | s[3:]


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of ``n`` over them."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


@dataclass
class Tree:
    """One language: the counts of its contexts of full order, and what follows from
    them: -log2 of the probability of each symbol seen in a context of order 3 and 2,
    of the escape from each such context, and of every symbol after every byte."""
    cells: np.ndarray
    counts: np.ndarray

    def grow(self) -> Tree:
        n = self.counts.astype(np.float64)
        cells2, n2 = _sums(self.cells & np.uint32(0xFFFFFF), n)
        cells1, n1 = _sums(cells2 & np.uint32(0xFFFF), n2)
        p = np.full(256, 1 / 256)
        p = _level(_dense(*_sums(cells1 & np.uint32(0xFF), n1), 256)[None, :], p[None, :])
        first = _level(_dense(cells1, n1, 65536).reshape(256, 256), np.broadcast_to(p, (256, 256)))
        p2, self.contexts2, self.escape2 = _sparse(cells2, n2, first.reshape(-1)[cells2 & np.uint32(0xFFFF)])
        below = p2[np.searchsorted(cells2, self.cells & np.uint32(0xFFFFFF))]
        p3, self.contexts3, self.escape3 = _sparse(self.cells, n, below)
        self.cells2, self.bits2, self.bits3 = cells2, -np.log2(p2), -np.log2(p3)
        self.bits1 = -np.log2(first.reshape(-1))
        return self

    def bits(self, asked: np.ndarray) -> np.ndarray:
        """Code lengths of symbols in contexts of full order, as given by ``codes``."""
        out = self.bits1[asked & np.uint32(0xFFFF)]
        for cells, bits, contexts, escape, mask in ((self.cells2, self.bits2, self.contexts2, self.escape2, 0xFFFFFF),
                                                    (self.cells, self.bits3, self.contexts3, self.escape3, 0xFFFFFFFF)):
            key = asked & np.uint32(mask)
            out = out + _at(contexts, escape, key >> np.uint32(8), 0.0)  # unseen contexts: straight to the shorter one
            out = _at(cells, bits, key, out)
        return out


def _dense(keys: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size)
    out[keys] = n
    return out


def _level(n: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities (contexts, 256) of a dense level over those of the one below."""
    seen = n > 0
    d, total = seen.sum(1, keepdims=True), n.sum(1, keepdims=True)
    rest = np.where(seen, 0, lower)
    left = rest.sum(1, keepdims=True)
    escape = np.where(left > 0, d, 0)
    out = n / np.maximum(total + escape, 1) + escape / np.maximum(total + escape, 1) * rest / np.where(left > 0, left, 1)
    return np.where(d > 0, out, lower)


def _sparse(cells: np.ndarray, n: np.ndarray, lower: np.ndarray):
    """Probabilities of the symbols seen in each context; the contexts, and -log2 of
    what the escape multiplies a lower level's probability of an unseen symbol by."""
    contexts, inverse = np.unique(cells >> np.uint32(8), return_inverse=True)
    total, d = np.bincount(inverse, n), np.bincount(inverse)
    left = 1 - np.bincount(inverse, lower)
    escape = np.where((d < 256) & (left > 1e-12), d, 0)
    p = n / (total + escape)[inverse]
    factor = np.maximum(escape, 1e-12) / (total + escape) / np.maximum(left, 1e-12)
    return p, contexts, -np.log2(factor)


def _at(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, otherwise) -> np.ndarray:
    """values[i] where keys[i] is asked for, else ``otherwise``."""
    if not len(keys):
        return np.broadcast_to(otherwise, asked.shape).astype(np.float64)
    i = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return np.where(keys[i] == asked, values[i], otherwise)


class Model:
    """Sparse counts of contexts with symbol, by language."""

    def __init__(self, trees: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages = sorted(trees)
        self.counts = [trees[x] for x in self.languages]
        self.key = hashlib.sha256(b"".join(p.tobytes() for x in self.counts for p in x) + "|".join(self.languages).encode()).hexdigest()


class _Lookup:
    """A worker's code lengths: per known cell and language, as many languages at
    once as fit PIECE_CELLS. Cells that no language knows are worked out apart."""

    def __init__(self, model: Model):
        self.key = model.key
        self.trees = [Tree(*x).grow() for x in model.counts]
        self.cells = np.unique(np.concatenate([t.cells for t in self.trees]))
        self.step = max(1, PIECE_CELLS // max(1, len(self.cells)))
        self.held: tuple[int, np.ndarray] | None = None

    def piece(self, a: int) -> np.ndarray:
        if self.held is None or self.held[0] != a:
            table = np.stack([t.bits(self.cells) for t in self.trees[a:a + self.step]], 1).astype(np.float32)
            self.held = (a, table)
        return self.held[1]

    def totals(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) bits of whole texts."""
        out = np.zeros((len(texts), len(self.trees)))
        parts, owner = [], []
        for i, raw in enumerate(texts):  # very long texts, piece by piece
            for a in range(0, len(raw), 1 << 16):
                lead = min(a, ORDER)
                parts.append(codes(raw[a - lead: a + (1 << 16)])[lead:])
                owner.append(i)
        at = [np.minimum(np.searchsorted(self.cells, p), len(self.cells) - 1) for p in parts]
        new = [np.flatnonzero(self.cells[i] != p) for i, p in zip(at, parts)]
        for a in range(0, len(self.trees), self.step):
            table = self.piece(a)
            for i, idx, asked, odd in zip(owner, at, parts, new):
                bits = table[idx]
                if len(odd):
                    bits[odd] = np.stack([t.bits(asked[odd]) for t in self.trees[a:a + self.step]], 1)
                out[i, a:a + self.step] += bits.sum(0, dtype=np.float64)
        return out


class _Worker:
    lookup: _Lookup | None = None


def _lookup(model: Model) -> _Lookup:
    """One lookup per Python worker."""
    if _Worker.lookup is None or _Worker.lookup.key != model.key:
        _Worker.lookup = _Lookup(model)
    return _Worker.lookup


_CELLS = pa.schema([("lang", pa.string()), ("cell", pa.int64()), ("n", pa.int64())])


def _learned(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out()).select("text", "lang")


def learn(docs: DataFrame) -> Model:
    """Counts over the whole texts of all rows with a language outside the held-out
    part, added up in Spark; the model is the distinct contexts of each language."""
    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def flush():
            for lang, parts in held.items():
                cells, n = np.unique(np.concatenate(parts), return_counts=True)
                for a in range(0, len(cells), 65536):
                    m = len(cells[a:a + 65536])
                    yield c.record(_CELLS, [pa.array([lang] * m), cells[a:a + 65536].astype(np.int64), n[a:a + 65536]])
            held.clear()

        for batch in batches:
            for t, lang in zip(c.texts_of(batch), batch.column("lang").to_pylist()):
                if t:
                    held.setdefault(lang, []).append(codes(t))
                    size += len(t)
                if size >= _FLUSH:
                    yield from flush()
                    size = 0
        yield from flush()

    counted = (c.map_arrow(_learned(docs), count, "lang string, cell long, n long")
               .groupBy("lang", "cell").agg(F.sum("n").alias("n")).toArrow())
    names = counted.column("lang").combine_chunks().dictionary_encode()
    cell, n = counted.column("cell").to_numpy().astype(np.uint32), counted.column("n").to_numpy().astype(np.float64)
    trees = {}
    if counted.num_rows:
        if isinstance(names, pa.ChunkedArray):
            names = names.combine_chunks()
        code = names.indices.to_numpy()
        for i, lang in enumerate(names.dictionary.to_pylist()):
            of = np.flatnonzero(code == i)
            of = of[np.argsort(cell[of], kind="stable")]
            trees[lang] = (cell[of], n[of])
    return Model(trees)


def posterior(bits: np.ndarray) -> np.ndarray:
    p = np.exp2(-(bits - bits.min(-1, keepdims=True)))
    return p / p.sum(-1, keepdims=True)


def classify(texts: list[str | None], model: Model) -> tuple[list, list, list]:
    """Language, score and bits a byte of each text; of equal code lengths the first
    language in name order wins. A null text, one without a letter, or a model
    without languages gives ``und``, 0 and null."""
    pred, score, bits = ["und"] * len(texts), [0.0] * len(texts), [None] * len(texts)
    at = [i for i, t in enumerate(texts) if model.languages and t and any(map(str.isalpha, t))]
    if at:
        raw = [texts[i].encode() for i in at]
        totals = _lookup(model).totals(raw)
        best = totals.argmin(1)
        likely = posterior(totals)
        for k, i in enumerate(at):
            pred[i], score[i] = model.languages[best[k]], float(likely[k, best[k]])
            bits[i] = float(totals[k, best[k]] / len(raw[k]))
    return pred, score, bits


_PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                        ("score", pa.float64()), ("bits", pa.float64())])


def identify(docs: DataFrame) -> DataFrame:
    """Learn from ``docs`` and predict all of them: doc_id, held_out, lang_pred,
    score (0 to 1), bits (code length a byte). Needs doc_id, text and lang;
    other columns are ignored. A null doc_id is not held out; repeated rows count
    and are predicted each; an empty table gives no rows. A text of any length is
    read whole, some 64 kB at a time."""
    model = learn(docs)

    def run(batches):
        for batch in c.sliced(batches):
            yield c.record(_PREDICTED, [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"),
                                        *classify(batch.column("text").to_pylist(), model)])

    return c.map_arrow(docs.select("doc_id", "text", held_out().alias("held_out")), run,
                       "doc_id long, held_out boolean, lang_pred string, score double, bits double")


def usual_bits(docs: DataFrame, model: Model, of: int = LONG_BYTES) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation, by language, of the bits a byte that the learned-from
    texts of ``of`` bytes or more take in their own language (of all, where a
    language has none so long). Added up in Spark; a row a language comes back."""
    number = {lang: i for i, lang in enumerate(model.languages)}

    def run(batches):
        for batch in c.sliced(batches):
            rows = [(t, lang) for t, lang in zip(c.texts_of(batch), batch.column("lang").to_pylist()) if t and lang in number]
            if rows:
                totals = _lookup(model).totals([t for t, _ in rows])
                yield c.record(_BITS, [[lang for _, lang in rows], [len(t) >= of for t, _ in rows],
                                       [totals[i, number[lang]] / len(t) for i, (t, lang) in enumerate(rows)]])

    bits = c.map_arrow(_learned(docs), run, "lang string, long_text boolean, bits double")
    found = bits.groupBy("lang", "long_text").agg(F.avg("bits").alias("mean"), F.stddev_pop("bits").alias("sd")).collect()
    return {r["lang"]: (r["mean"], r["sd"]) for r in sorted(found, key=lambda r: r["long_text"])}


_BITS = pa.schema([("lang", pa.string()), ("long_text", pa.bool_()), ("bits", pa.float64())])


def reject_unknown(docs: DataFrame, least: float = 0.5, spread: float = SPREAD) -> DataFrame:
    """The documents in a language that ``docs`` teach; columns unchanged.

    One goes whose predicted language is ``und``, whose score is under ``least``
    (too short or mixed to tell), or whose code takes more bits a byte than texts of
    that language do: over ``spread`` standard deviations (at least LEAST_SPREAD
    bits) above their mean, and SHORT_BITS bits more for the whole text, which
    count where it is short. So noise and languages nobody taught go. Null and
    empty texts go; repeated rows are judged each; an empty table stays empty.
    """
    model = learn(docs)
    limit = {lang: mean + max(spread * sd, LEAST_SPREAD) for lang, (mean, sd) in usual_bits(docs, model).items()}

    def run(batches):
        for batch in c.sliced(batches):
            texts = batch.column("text").to_pylist()
            rows = zip(texts, *classify(texts, model))
            yield batch.filter(pa.array([p != "und" and s >= least and b <= limit[p] + SHORT_BITS / len(t.encode())
                                         for t, p, s, b in rows], pa.bool_()))

    return c.map_arrow(docs, run, docs.schema)

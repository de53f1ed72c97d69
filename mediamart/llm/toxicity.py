"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives P; texts drawn regardless of any label
are the unlabelled set U, toxic ones among them. With class prior p and logistic
loss l, the risk of a linear scorer g over the words a text contains is

    p E_P[l(g)] + max(0, E_U[l(-g)] - p E_P[l(-g)])

The second term estimates the loss on clean texts from U corrected by the prior; it
cannot be negative for the true law, so when an overfitting scorer drives it below
zero, steps go back up its slope instead.

The words it looks at are those most associated with the positives: counted over
all positive and all unlabelled documents, added up in the tasks first. Their
weights are fitted in numpy on bounded samples (``max_positive`` and
``max_unlabelled`` documents, the smallest by a seeded hash of doc_id); the scorer then
scores every whole text where it lies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c
from mediamart.llm.language_id import held_out
from mediamart.session import materialize

MAX_POSITIVE, MAX_UNLABELLED = 4000, 16_000
FEATURE_BITS = 22
MAX_FEATURES, MIN_ASSOCIATION = 4096, 20.0  # features kept: the most associated, by log-likelihood ratio
PREFIX_BYTES = 5
THRESHOLD = 0.3
STEPS, RATE, DECAY = 300, 0.05, 1e-3
_BREAKS = bytes.maketrans(bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)), b" " * 32)


def features(text: str | None) -> np.ndarray:
    """Distinct hashed words (lower case, without ASCII punctuation) of a whole
    text, and the beginnings of its longer words."""
    words = list(set((text or "").lower().encode().translate(_BREAKS).split()))
    words += {w[:PREFIX_BYTES] + b"*" for w in words if len(w) > PREFIX_BYTES}
    return np.unique(c.word_hashes(words) >> np.uint64(64 - FEATURE_BITS)).astype(np.int32)


_COUNTS = pa.schema([("feature", pa.int32()), ("n", pa.int64())])
_FLUSH = 1 << 20
_ROWS = -1  # the "feature" that every document has: their number


def feature_counts(docs: DataFrame) -> DataFrame:
    """(feature, n): how many documents have each feature, and under _ROWS how many
    there are. At most 2 ** FEATURE_BITS + 1 rows, whatever the table."""
    def run(batches):
        total = np.zeros((1 << FEATURE_BITS) + 1, np.int64)  # the last one counts documents
        held, n = [], 0

        def add():
            np.add(total, np.bincount(np.concatenate(held), minlength=len(total)), out=total)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                held.append(features(text))
                n += len(held[-1])
                if n >= _FLUSH:
                    add()
                    held, n = [], 0
            total[-1] += batch.num_rows
        if n:
            add()
        seen = np.flatnonzero(total)
        yield c.record(_COUNTS, [np.where(seen == len(total) - 1, _ROWS, seen).astype(np.int32), total[seen]])

    return c.map_arrow(docs.select("text"), run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def associated(positive: DataFrame, unlabelled: DataFrame, max_features: int = MAX_FEATURES) -> np.ndarray:
    """The ``max_features`` features whose share among the positive documents differs
    most from that among the unlabelled, by the log-likelihood ratio of the two-by-two
    table over all of them (ties: the smaller feature), in ascending order."""
    def part(k, n):  # k of n have it
        p = k / n
        return k * F.log(F.greatest(p, F.lit(1e-12))) + (n - k) * F.log(F.greatest(1 - p, F.lit(1e-12)))

    a, b = (materialize(feature_counts(docs), name) for docs, name in ((positive, "positive_counts"), (unlabelled, "counts")))
    n, m = (sum(r["n"] for r in x.where(F.col("feature") == _ROWS).collect()) for x in (a, b))
    both = (a.withColumnRenamed("n", "a").join(b.withColumnRenamed("n", "b"), "feature", "full").fillna(0)
            .where(F.col("feature") != _ROWS))
    ratio = 2 * (part(F.col("a"), F.lit(n)) + part(F.col("b"), F.lit(m)) - part(F.col("a") + F.col("b"), F.lit(n + m)))
    best = (both.select("feature", ratio.alias("ratio")).where(F.col("ratio") >= MIN_ASSOCIATION)
            .orderBy(F.desc("ratio"), "feature").limit(max_features))
    return np.array(sorted(r["feature"] for r in best.collect()), np.int32)


class Examples:
    """Feature lists of many texts, over the columns of ``known`` features."""

    def __init__(self, rows: list[np.ndarray], known: np.ndarray):
        flat = np.concatenate(rows) if rows else np.empty(0, np.int32)
        owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        at = np.minimum(np.searchsorted(known, flat), max(0, len(known) - 1))
        ok = known[at] == flat if len(known) else np.zeros(len(flat), bool)
        self.n, self.owner, self.column = len(rows), owner[ok], at[ok]

    def scores(self, w: np.ndarray, b: float) -> np.ndarray:
        return np.bincount(self.owner, w[self.column], self.n) + b

    def gradient(self, per_text: np.ndarray, columns: int) -> tuple[np.ndarray, float]:
        return np.bincount(self.column, per_text[self.owner], columns), float(per_text.sum())


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(known: np.ndarray, positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, float]:
    """(weights, bias) over the ``known`` features that minimise the non-negative risk, by Adam."""
    p, u = Examples(positive, known), Examples(unlabelled, known)
    x, m, v = np.zeros(len(known) + 1), 0.0, 0.0
    x[-1] = np.log(prior / (1 - prior))
    for step in range(1, STEPS + 1):
        gp, gu = p.scores(x[:-1], x[-1]), u.scores(x[:-1], x[-1])
        clean = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        du, dp = _sigmoid(gu) / u.n, prior * _sigmoid(gp) / p.n  # slopes of the clean term's two parts
        if clean >= 0:
            on_p, on_u = -prior * _sigmoid(-gp) / p.n - dp, du
        else:
            on_p, on_u = dp, -du
        wp, bp = p.gradient(on_p, len(known))
        wu, bu = u.gradient(on_u, len(known))
        g = np.r_[wp + wu + DECAY / len(gu) * x[:-1], bp + bu]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return x[:-1], float(x[-1])


def _sample(docs: DataFrame, ids: DataFrame, bound: int, seed: int) -> list[np.ndarray]:
    """Features of at most ``bound`` of the documents with the given ids."""
    chosen = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(bound)

    def run(batches):
        for batch in batches:
            yield pa.record_batch({"f": pa.array([features(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary())})

    rows = c.map_arrow(docs.join(chosen, "doc_id", "left_semi").select("text"), run, "f binary").toArrow()
    found = [np.frombuffer(x, np.int32) for x in rows.column("f").to_pylist()]
    return sorted(found, key=lambda f: f.tobytes())  # the order of rows must not matter to sums


class Scorer:
    """A fitted linear scorer; scores lie in 0 to 1."""

    def __init__(self, known: np.ndarray, weights: np.ndarray, bias: float):
        self.known, self.weights, self.bias = known, weights.astype(np.float32), bias
        self._table = None

    def __getstate__(self):
        return self.__dict__ | {"_table": None}

    def __call__(self, text: str | None) -> float:
        if self._table is None:
            self._table = np.zeros(1 << FEATURE_BITS, np.float32)
            self._table[self.known] = self.weights
        return float(_sigmoid(self._table[features(text)].sum(dtype=np.float64) + self.bias))


def learn(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> Scorer:
    """Fit on rows outside the held-out part; labels are read only there. The bounds
    hold for the fit of the weights and the size of the model; features are counted over all rows.

    Without a positive or without other texts every score is 0."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out())
    marked = labels.select("doc_id", "toxic").where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    prior = marked.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"] or 0.0
    toxic = materialize(marked.where("toxic = 1").select("doc_id").distinct(), "toxic_ids")  # a table: the planner sees its size
    positive = _sample(docs, toxic, max_positive, 1)
    unlabelled = _sample(docs, docs.select("doc_id"), max_unlabelled, 2)
    if not positive or not unlabelled:
        return Scorer(np.empty(0, np.int32), np.empty(0), -40.0)
    known = associated(docs.join(toxic, "doc_id", "left_semi"), docs, max_features)
    return Scorer(known, *fit(known, positive, unlabelled, min(max(prior, 1e-4), 0.9)))


_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_positive: int = MAX_POSITIVE,
                   max_unlabelled: int = MAX_UNLABELLED, max_features: int = MAX_FEATURES) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score (0 to 1), predicted.
    For the bounds see ``learn``.

    Needs doc_id and text of ``docs``, doc_id and toxic of ``labels``; other
    columns are ignored. A null text counts as empty, whose score is the bias
    alone. A null doc_id is not held out and not learned from; labels that are
    null or lack a document are ignored. Rows that repeat a doc_id are learned from
    and scored each; equal texts have equal scores. A very long text counts each of
    its words once. An empty table gives no rows.
    """
    scorer = learn(docs, labels, max_positive, max_unlabelled, max_features)

    def run(batches):
        for batch in batches:
            scores = [scorer(t) for t in batch.column("text").to_pylist()]
            yield c.record(_SCORES, [batch.column("doc_id").cast(pa.int64()), batch.column("held_out"), scores,
                                     [int(s >= threshold) for s in scores]])

    return c.map_arrow(docs.select("doc_id", "text", held_out().alias("held_out")), run,
                       "doc_id long, held_out boolean, score double, predicted int")

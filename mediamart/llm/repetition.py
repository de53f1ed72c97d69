"""Periodic runs: stretches of a document whose words repeat with a period.

The runs of a word sequence are found by longest common extensions on the suffix
trees of the document and of its reversal, from Lyndon roots (``suffix_tree``).

Words that cannot lie in a run are left out of the trees first, losslessly: of a
run of at least m words and twice its period, each word lies in ceil(m / 2) words
in a row that occur again one period before or after, inside the run. Between
the stretches that remain stands a mark of its own, which no run can contain.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from mediamart.llm import common as c
from mediamart.llm.suffix_tree import periodic_runs

LEAST_WORDS = 12


def repeating_stretches(words: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of stretches that together hold every run, from word hashes.

    A gram stays while its nearest equal gram is at most half its stretch away,
    which holds for every gram of a run and its period, whatever else goes."""
    n, k = len(words), (least + 1) // 2
    if n < least:
        return []
    gram = c.shingle_hashes(words, k)
    order = np.argsort(gram, kind="stable")
    equal = np.flatnonzero(gram[order][1:] == gram[order][:-1])
    if not len(equal):
        return []
    a, b = order[equal], order[equal + 1]  # a before b: the sort is stable
    near = np.full(len(gram), n, np.int64)
    near[a] = b - a
    near[b] = np.minimum(near[b], b - a)
    alive = np.flatnonzero(2 * near <= n)
    while len(alive):
        # A stretch ends where the next gram starts behind the last one's end.
        cut = np.flatnonzero(np.diff(alive) > k)
        first, last = alive[np.r_[0, cut + 1]], alive[np.r_[cut, len(alive) - 1]] + k
        length = np.repeat(last - first, np.diff(np.r_[0, cut + 1, len(alive)]))
        stay = (2 * near[alive] <= length) & (length >= least)
        if stay.all():
            return list(zip(first.tolist(), last.tolist()))
        alive = alive[stay]
    return []


def document_runs(words: list[bytes], least: int = LEAST_WORDS) -> np.ndarray:
    """All (start, length, period) of a document's runs, by start, then period."""
    if len(words) < least:
        return np.empty((0, 3), np.int64)
    stretches = repeating_stretches(c.word_hashes(words), least)
    if not stretches:
        return np.empty((0, 3), np.int64)
    symbols: dict[bytes, int] = {}
    text, place = [], []
    for mark, (a, b) in enumerate(stretches):
        if text:
            text.append(-mark)
            place.append(-1)
        text += [symbols.setdefault(w, len(symbols) + 1) for w in words[a:b]]
        place += range(a, b)
    text = [x if x > 0 else len(symbols) - x for x in text]
    found = periodic_runs(text, least)
    found[:, 0] = np.array(place)[found[:, 0]]
    return found


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run repeats: of every run, only its first period stays."""
    if not len(runs):
        return words
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()]


RUN_TYPE = "array<struct<start: long, length: long, period: long>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("text", pa.string())])


def find_runs(docs: DataFrame, least: int = LEAST_WORDS) -> DataFrame:
    """Periodic runs of every whole text, one row per input row: doc_id, n_words,
    runs (start, length, period in words, by start, then period) and text (the
    words left when every run keeps its first period only, joined by one blank).

    A run is a stretch of at least ``least`` words and twice its smallest period
    that no neighbouring word extends; runs may overlap. A null or empty text has
    no words, no runs and an empty text. Equal texts have equal runs, repeated
    rows are read each, doc_id may be null, other columns are ignored, and an
    empty table gives no rows. No shuffle: a text is read where it lies, in memory
    in proportion to the words of the one document at hand that repeat.
    """
    if least < 2:
        raise ValueError("a run has two words at least")

    def run(batches):
        for batch in c.sliced(batches):
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), c.texts_of(batch)):
                words = text.split() if text else []
                found = document_runs(words, least)
                out.append((doc_id, len(words),
                            [{"start": a, "length": b, "period": p} for a, b, p in found.tolist()],
                            b" ".join(collapsed(words, found)).decode()))
            if out:
                yield c.record(_OUT, list(zip(*out)))

    return c.map_arrow(docs.select("doc_id", "text"), run, f"doc_id long, n_words long, runs {RUN_TYPE}, text string")

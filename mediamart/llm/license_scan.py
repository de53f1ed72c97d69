"""Licence scan: notice phrases and identifier tags by Aho-Corasick, expressions
after tags by a shunting-yard parser.

Words are lower-cased runs of letters, digits and bytes beyond ASCII; a phrase is
found where its words stand one after another, whatever separates them. One pass
of one automaton over a text's words finds all phrases and tags at once.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mediamart.llm import common as c
from mediamart.llm.license_expression import DUTY, evaluate, postfix

# The base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Names and first words of further notices.
NOTICES = {
    "gnu general public licence": "gpl", "gnu gpl": "gpl", "apache licence": "apache", "mit licence": "mit",
    "gnu lesser general public license": "lgpl", "gnu library general public license": "lgpl", "gnu lgpl": "lgpl",
    "gnu affero general public license": "agpl", "gnu agpl": "agpl", "mozilla public license": "mpl",
    "eclipse public license": "epl", "common development and distribution license": "cddl",
    "european union public licence": "eupl", "boost software license": "bsl", "zlib license": "zlib",
    "isc license": "isc", "bsd license": "bsd", "2 clause bsd": "bsd", "3 clause bsd": "bsd", "bsd 2 clause": "bsd",
    "bsd 3 clause": "bsd", "python software foundation license": "psf", "sil open font license": "ofl",
    "permission is hereby granted free of charge": "mit", "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa", "cc0": "cc0",
    "creative commons attribution noncommercial": "cc-by-nc", "creative commons attribution non commercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa", "creative commons attribution share alike": "cc-by-sa",
    "creative commons attribution noderivs": "cc-by-nd", "creative commons attribution noderivatives": "cc-by-nd",
    "released into the public domain": "public-domain", "dedicated to the public domain": "public-domain",
    "all rights reserved": "proprietary",
}
# Tags an expression may follow, and what stands between.
TAGS = {
    "spdx license identifier": re.compile(r"[\"']?[ \t]*:[ \t]*[\"']?"),
    "license": re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?"), "licence": re.compile(r"[\"']?[ \t]*[:=][ \t]*[\"']?"),
    "licensed under": re.compile(r"[ \t]+(?:the[ \t]+)?"), "released under": re.compile(r"[ \t]+(?:the[ \t]+)?"),
}
#: How sure a finding of each kind makes one that the text is under its licence.
WEIGHT = {"tag": 0.95, "base": 0.8, "notice": 0.7}

_FOLD = bytes(x + 32 if 65 <= x <= 90 else x for x in range(256))
_WORDS = bytes(x if x >= 128 or chr(x).isalnum() else 32 for x in _FOLD)


def _automaton():
    found = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICES), ("tag", TAGS), ("base", BASE)):
        for phrase in phrases:
            found.add_word(f" {phrase} ", (kind, phrase, len(phrase) + 1))
    found.make_automaton()
    return found


class _Worker:
    """The automaton, made once per Python worker."""
    automaton = None


def scan(text: bytes) -> tuple[int, list[tuple[int, str, str]], list[tuple[int, str, int]]]:
    """Words of a text; its matches (word, kind, label) by word; and its
    expressions (word of the tag, postfix form, duty)."""
    if _Worker.automaton is None:
        _Worker.automaton = _automaton()
    spread = text.translate(_WORDS)
    words = spread.split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    matches, expressions, starts, lower = [], [], None, None
    counted = word = 0
    hits = sorted((end - size, kind, phrase) for end, (kind, phrase, size) in _Worker.automaton.iter(line))
    for start, kind, phrase in hits:
        word += line.count(" ", counted, start)
        counted = start
        if kind != "tag":
            matches.append((word, kind, BASE[phrase] if kind == "base" else NOTICES[phrase]))
            continue
        if starts is None:
            inside = np.frombuffer(spread, np.uint8) != 32
            starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
            lower = text.translate(_FOLD).decode("latin-1")
        last = word + phrase.count(" ")
        between = TAGS[phrase].match(lower, int(starts[last]) + len(words[last]))
        tokens = postfix(lower, between.end())[0] if between else []
        if terms := evaluate(tokens):
            expressions.append((word, " ".join(tokens), terms.duty))
            matches += [(word, kind, x) for x in sorted(terms.families)]
    return len(words), matches, expressions


def certainty(matches) -> float:
    """1 - the product over labels of the doubt their surest finding leaves."""
    surest: dict[str, float] = {}
    for _, kind, label in matches:
        surest[label] = max(surest.get(label, 0.0), WEIGHT[kind])
    doubt = 1.0
    for label in sorted(surest):
        doubt *= 1 - surest[label]
    return 1 - doubt


_MATCH = pa.struct([("word", pa.int64()), ("kind", pa.string()), ("label", pa.string())])
_EXPRESSION = pa.struct([("word", pa.int64()), ("postfix", pa.string()), ("duty", pa.int32())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("matches", pa.list_(_MATCH)),
                  ("expressions", pa.list_(_EXPRESSION)), ("duty", pa.int32()), ("score", pa.float64())])
_COLUMNS = ("doc_id long, n_words long, matches array<struct<word: long, kind: string, label: string>>, "
            "expressions array<struct<word: long, postfix: string, duty: int>>, duty int, score double")


def _read(text: bytes | None) -> tuple:
    n, matches, expressions = scan(text or b"")
    duties = [d for _, _, d in expressions] + [DUTY[label] for _, kind, label in matches if kind != "tag"]
    return (n, [dict(zip(("word", "kind", "label"), m)) for m in matches],
            [dict(zip(("word", "postfix", "duty"), e)) for e in expressions],
            max(duties, default=None), certainty(matches))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licence notices of every whole text, one row per input row: doc_id, n_words,
    matches (first word from 0, kind ``base``, ``notice`` or ``tag``, label; by
    word), expressions after tags (in postfix form, with their duty), duty (the
    heaviest of all findings, see ``license_expression.DUTY``; null without any)
    and score (0 to 1, how sure a licence is named).

    All places count, overlapping ones too. A null or empty text has no words and
    no findings; repeated rows are read each, other columns are ignored, and an
    empty table gives no rows. No shuffle, and a text of any length is read once,
    in memory in proportion to the one text at hand.
    """
    def run(batches):
        for batch in c.sliced(batches):
            if batch.num_rows:
                rows = [_read(t) for t in c.texts_of(batch)]
                yield c.record(_OUT, [batch.column("doc_id").cast(pa.int64()), *zip(*rows)])

    return c.map_arrow(docs.select("doc_id", "text"), run, _COLUMNS)


def keep_free(docs: DataFrame, most: int = 1) -> DataFrame:
    """``docs`` without those whose findings ask more than ``most`` of a reader
    (0 nothing to 4 no free use); texts without findings, null ones too, stay.
    All columns are kept as they are, and each row is judged by its own text."""
    def run(batches):
        for batch in c.sliced(batches):
            duties = [_read(t)[3] for t in c.texts_of(batch)]
            yield batch.filter(pa.array([d is None or d <= most for d in duties], pa.bool_()))

    return c.map_arrow(docs, run, docs.schema)


def labels_of(matches, kind: str | None = None):
    """Column expression: the distinct labels (of one kind), sorted."""
    found = F.filter(matches, lambda m: m["kind"] == kind) if kind else matches
    return F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"])))

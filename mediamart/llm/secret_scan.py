"""Secret scan: fixed patterns plus a token-efficiency test.

Text that a byte-pair vocabulary has seen packs many characters into a token;
random strings do not. A run of key-like characters is reported when it has few
characters per token under a tiktoken vocabulary, unless it has the shape of a
known digest, UUID or number. Grouped and dotted keys are judged by their parts
together; parts that may be words of a name are judged by their letters under a
stricter limit.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from mediamart.llm import common as c

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KINDS = ("assign", "access", "hex", "token")
MIN_LENGTH = 16
CHARS_PER_TOKEN = 2.2
WORD_CHARS_PER_TOKEN = 2.05
_CACHE = 1 << 16

# The base patterns and their least lengths.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20

# Fixed value: the splitting pattern the vocabulary was made with.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Runs of key-like characters; a dot counts inside one.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
# Shapes that look random and are no secrets: digests (32, 40, 56, 64, 96 or 128
# hex digits), UUIDs and plain numbers, times and versions.
KNOWN = re.compile(
    r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z"
    r"|[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}\Z"
    r"|[0-9/_=+.-]+\Z", re.I | re.A)
BETWEEN = re.compile(r"[/_=+.-]+")
NAME = re.compile(r"([A-Za-z]+)[0-9]{0,4}\Z", re.A)  # a part that may be a word with a number
LEAST_PART, LEAST_JUDGED = 3, 12  # shorter parts tell nothing: any is a token or two


class TokenEfficiency:
    """Characters per token of short strings, remembered for a bounded number."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        self._known: dict[str, float] = {}

    def __call__(self, s: str) -> float:
        if s not in self._known:
            if len(self._known) >= _CACHE:
                self._known.clear()
            # Long runs are read in pieces: pair merging takes the square of a piece.
            tokens = sum(len(self._encoding.encode_ordinary(s[i:i + 512])) for i in range(0, len(s), 512))
            self._known[s] = len(s) / tokens
        return self._known[s]


_LOADED: dict[str, TokenEfficiency] = {}


def efficiency(vocabulary: str) -> TokenEfficiency:
    """One loaded vocabulary per Python worker."""
    key = os.path.realpath(vocabulary)
    if key not in _LOADED:
        _LOADED[key] = TokenEfficiency(vocabulary)
    return _LOADED[key]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def is_random(run: str, packed: TokenEfficiency, below: float) -> bool:
    """Whether the tokens of the run's parts (between separators) are too many for
    their characters: at least one for every ``below`` of them, or for every
    WORD_CHARS_PER_TOKEN letters of a part that may be a word. Numbers and parts under
    LEAST_PART characters are not counted, and under LEAST_JUDGED in all tell nothing."""
    judged, allowed = 0, 0.0
    for part in BETWEEN.split(run):
        limit = below
        if name := NAME.match(part):
            part, limit = name[1], min(below, WORD_CHARS_PER_TOKEN)
        if len(part) >= LEAST_PART and not part.isdigit():
            judged += len(part)
            allowed += limit * len(part) / packed(part)
    return judged >= LEAST_JUDGED and judged < allowed


def token_spans(text: str, packed: TokenEfficiency, base: list[tuple[int, int, int]],
                below: float = CHARS_PER_TOKEN) -> list[tuple[int, int, int]]:
    """Spans of key-like runs whose characters per token lie under ``below``
    and which no base span covers already."""
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if len(run) < MIN_LENGTH or any(start <= m.start() and m.end() <= end for start, _, end in base):
            continue
        if not KNOWN.match(run) and is_random(run, packed, below):
            found.append((m.start(), 3, m.end()))
    return found


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_SPANS = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()),
                    ("base_sha256", pa.string()), ("spans", pa.string()), ("n_token", pa.int64())])


def scan_secrets(docs: DataFrame, vocabulary: str = TOKENIZER, below: float = CHARS_PER_TOKEN) -> DataFrame:
    """Spans of secrets in every whole text, one row per input row: doc_id,
    n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all,
    kind:start:end in code points, end exclusive) and n_token.

    A null text is empty; an empty list of spans is the empty string. Other
    columns are ignored, repeated rows are scanned each, and an empty table
    gives no rows. No shuffle: every row is read where it lies, whole, however
    long; a long run is read in pieces of 512 characters.
    """
    def run(batches):
        packed = efficiency(vocabulary)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                base = base_spans(text or "")
                extra = token_spans(text or "", packed, base, below)
                kinds = [k for _, k, _ in base]
                out.append((doc_id, kinds.count(0), kinds.count(1), kinds.count(2),
                            hashlib.sha256(spell(base).encode()).hexdigest(), spell(sorted(base + extra)), len(extra)))
            if out:
                yield c.record(_SPANS, list(zip(*out)))

    return c.map_arrow(docs.select("doc_id", "text"), run, "doc_id long, n_assign long, n_access long, n_hex long, "
                       "base_sha256 string, spans string, n_token long")


def mask_secrets(docs: DataFrame, vocabulary: str = TOKENIZER, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mark``; of overlapping
    spans the cover is. Null and empty texts stay; other columns and rows are kept."""
    def run(batches):
        packed = efficiency(vocabulary)
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                if text:
                    base = base_spans(text)
                    spans = sorted(base + token_spans(text, packed, base))
                    clean, at = [], 0
                    for start, _, end in spans:
                        if start >= at:
                            clean += [text[at:start], mark]
                        at = max(at, end)
                    text = "".join(clean) + text[at:]
                out.append(text)
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(out, batch.schema.field(i).type))

    return c.map_arrow(docs, run, docs.schema)

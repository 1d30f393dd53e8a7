"""Secret scan: three fixed patterns, and character Markov models that tell random strings from ordinary identifiers.

Both models hold log-probabilities of a character after another, and are trained from labelled samples. Ordinary are the long words of a sample of
documents outside the patterns, and identifiers: neighbouring words of these documents and common words of programs, joined as programs
join them (camelCase, snake_case, CONSTANTS, paths). Random are the values that the patterns find there and generated keys of
each usual alphabet. The sample holds ``sample`` documents or about so, chosen by hash; its
counts are at most two alphabets squared, whatever the corpus. A long word is a secret of kind ``random`` if its
log-likelihood ratio and its mean per character pass both thresholds, a higher mean for letters of one case. Not judged are numbers,
UUIDs, words of few different characters or of characters in order, and words of three or more parts that are each short or letters with a
number after them, as in names of platforms and in dates. Pattern spans always stay.

Defined results: a null or empty text has no spans; null ids and repeated rows are scanned each; further columns are
ignored; an empty table gives no rows. Texts are read whole, one at a time in memory.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Patterns and least lengths (fixed by the contract).
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

#: Long words that the models judge.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Words that identifiers are made of, and how many words of a sampled text become identifiers.
PARTS = (
    "get set add put new is has on to by id all max min map key log run url api app xml http json html css sql usr var lib bin etc opt src tmp dev log home local share include version "
    "name type value index count size list item node element class object model view user group role file path data date time text line page form field table row column query result "
    "request response client server session service handler factory manager builder parser reader writer buffer stream event state status error message option config default custom "
    "create update delete remove insert select search find load save open close start stop read write send receive parse format convert validate check test build make init create "
    "first last next previous current total number string array integer float double boolean null empty valid enabled visible active python java script module package function method "
    "national international organization development management information technology university government application environment communication administration program project"
).split()
WORDS_OF_A_TEXT = 40
#: Characters of the models; place 0 stands for all others and for the start.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_PLACE = {c: i + 1 for i, c in enumerate(LETTERS)}
_SIZE = len(LETTERS) + 1

Span = tuple[int, int, int]


def pattern_spans(text: str) -> list[Span]:
    """(start, kind, end) of the fixed patterns, sorted."""
    found: list[Span] = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


_WORD = re.compile(r"[A-Za-z]{2,12}")


def _pairs(word: str) -> Iterator[int]:
    last = 0
    for c in word:
        now = _PLACE.get(c, 0)
        yield last * _SIZE + now
        last = now


class _Covered:
    """Which stretches of a text the given spans, in order of their starts, touch."""

    def __init__(self, spans: Sequence[Span]) -> None:
        self.starts = [s[0] for s in spans]
        self.ends = list(accumulate((s[2] for s in spans), max))

    def touches(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


def identifier(words: Sequence[str], style: int) -> str:
    """The words joined as programs join them."""
    lower = [w.lower() for w in words]
    if style == 0:
        return lower[0] + "".join(w.capitalize() for w in lower[1:])
    if style == 1:
        return "".join(w.capitalize() for w in lower)
    if style == 2:
        return "".join(w.upper() if len(w) < 4 else w.capitalize() for w in lower)
    number, at = str(sum(map(len, lower))), len(lower[-1]) % len(lower)
    numbered = "".join(w.capitalize() + number * (k == at) for k, w in enumerate(lower))
    return ("_".join(lower), "_".join(lower).upper(), "-".join(lower), "/" + "/".join(lower), numbered)[style - 3]


STYLES = 8
#: Alphabets of generated keys.
ALPHABETS = ("0123456789abcdef", "0123456789ABCDEF", LETTERS[26:62], LETTERS[:26] + LETTERS[52:62], LETTERS[:62], LETTERS[:64], LETTERS[:62] + "_-", LETTERS[26:52])


def train(documents: DataFrame, sample: int = 2000, generated: int = 8000) -> list[float]:
    """Log-likelihood ratio, random against ordinary, of each pair of characters."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[tuple[int, int]] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = text or ""
                spans = pattern_spans(text)
                covered = _Covered(spans)
                for m in TOKEN.finditer(text):
                    if not covered.touches(m.start(), m.end()):
                        seen.update((0, p) for p in _pairs(m[0]))
                words = [m[0] for m, _ in zip(_WORD.finditer(text), range(WORDS_OF_A_TEXT), strict=False)]
                for k in range(0, len(words) - 3, 4):
                    seen.update((0, p) for p in _pairs(identifier(words[k : k + 4], k // 4 % STYLES)))
                for start, _, end in spans:
                    for m in TOKEN.finditer(text, start, end):
                        seen.update((1, p) for p in _pairs(m[0]))
        yield pa.RecordBatch.from_pydict(
            {"random": pa.array([k[0] for k in seen], pa.int32()), "pair": pa.array([k[1] for k in seen], pa.int32()), "n": pa.array(list(seen.values()), pa.int64())}
        )

    n = documents.count()
    chosen = documents.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, sample / max(n, 1)))))
    rows = chosen.select("text").mapInArrow(count, "random int, pair int, n long").groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()
    counts = [[0.0] * (_SIZE * _SIZE) for _ in range(2)]
    for r in rows:
        counts[r["random"]][r["pair"]] += r["n"]
    draw = random.Random(7)
    for k in range(generated):
        for p in _pairs("".join(draw.choices(ALPHABETS[k % len(ALPHABETS)], k=32))):
            counts[1][p] += 1
        digits = str(draw.randint(0, 99)) if k % 5 == 0 else ""
        for p in _pairs(identifier(draw.choices(PARTS, k=draw.randint(2, 5)), k % STYLES) + digits):
            counts[0][p] += 1
    logs = []
    for own in counts:
        single = [sum(own[now::_SIZE]) + 0.5 for now in range(_SIZE)]
        share = [x / sum(single) for x in single]
        model = []
        for last in range(_SIZE):
            # a pair seen once is taken as not seen, so that no word vouches for itself; the rest goes by single characters
            row = [max(0.0, x - 1) for x in own[last * _SIZE : (last + 1) * _SIZE]]
            model += [math.log((x + 5 * p) / (sum(row) + 5)) for x, p in zip(row, share, strict=True)]
        logs.append(model)
    return [b - a for a, b in zip(*logs, strict=True)]


_UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_PARTS = re.compile(r"[-_/=+]+")
_PLAIN = re.compile(r"[A-Za-z]?[a-z]*[0-9]{0,4}|[A-Z]+[0-9]{0,4}|.{0,5}")
#: Different characters that a secret has at least; parts of a word that are enough to tell a name by.
LEAST_DIFFERENT, NAME_PARTS = 7, 3


def ordinary(word: str) -> bool:
    """Whether a long word is no key by its shape alone."""
    if len(set(word)) < LEAST_DIFFERENT or _UUID.fullmatch(word):
        return True
    steps = [ord(b) - ord(a) for a, b in zip(word, word[1:], strict=False)]
    if 2 * max(steps.count(1), steps.count(-1)) >= len(steps):
        return True
    parts = [p for p in _PARTS.split(word) if p]
    return len(parts) >= NAME_PARTS and all(_PLAIN.fullmatch(p) for p in parts)


def random_spans(text: str, spans: list[Span], ratio: list[float], least: float, least_mean: float, least_plain: float) -> list[Span]:
    """Spans of kind ``random`` outside the given ones: words with letters whose ratio passes the thresholds."""
    found, covered = [], _Covered(spans)
    for m in TOKEN.finditer(text):
        word = m[0]
        score = sum(map(ratio.__getitem__, _pairs(word)))
        if score < least or score < least_mean * len(word) or not any(c.isalpha() for c in word) or ordinary(word):
            continue
        mixed = any(c.isdigit() for c in word) or word[1:].lower() != word[1:] != word[1:].upper()
        if (mixed or score >= least_plain * len(word)) and not covered.touches(m.start(), m.end()):
            found.append((m.start(), 3, m.end()))
    return found


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(documents: DataFrame, sample: int = 2000, least: float = 10.0, least_mean: float = 0.45, least_plain: float = 0.8) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    ratio = documents.sparkSession.sparkContext.broadcast(train(documents, sample))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = ratio.value
        for batch in batches:
            base = [pattern_spans(t or "") for t in batch.column(1).to_pylist()]
            every = [sorted(b + random_spans(t or "", b, model, least, least_mean, least_plain)) for t, b in zip(batch.column(1).to_pylist(), base, strict=True)]
            counts = [pa.array([sum(s[1] == k for s in b) for b in base], pa.int64()) for k in range(3)]
            digests = pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, digests, pa.array([joined(s) for s in every], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        spans, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact(text: str, spans: str, mark: str = "[secret]") -> str:
    """The text with each span, as ``scan`` joins them, replaced by a mark; overlapping spans share one."""
    out, at = [], 0
    for span in filter(None, spans.split(",")):
        start, end = map(int, span.split(":")[1:])
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])

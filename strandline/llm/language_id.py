"""Language identification as inference of a mixture.

Each language is a distribution of letter trigrams, learned from labelled documents. A document is a mixture of
languages: every word comes from one of them with a probability given by its trigrams, and expectation-maximisation
estimates the document's proportions. Which languages take part is chosen by penalised likelihood: from the best
single language on, another one joins as long as it raises the log-likelihood by more than its penalty,
``penalty`` * log(words). The language with the largest proportion is predicted; its proportion is the score.

Letters, lower-casing and word limits come from tables over all code points, and trigrams are hashed to
``buckets``, so whole texts are handled in array operations. The trigram counts are fitted on ``sample`` labelled
documents of each language or about so, chosen by hash; the model has a number for each bucket and language, whatever the corpus.

Defined results: null texts and texts without letters are ``und`` with score 0, and so are all if nothing is labelled; a
null id is labelled like others but belongs to no fold; repeated rows are predicted each; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    """Lower-cased code point of each letter; 0 for all other code points."""
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0x20
    chars = points.view("<U1")
    lower = np.char.lower(chars).astype("<U1").view(np.uint32)
    return np.where(np.char.isalpha(chars), np.where(lower == 0, points, lower), 0).astype(np.uint32)


def trigrams(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the trigram at each letter of the text and after each word, and where words begin among them.

    A word is a run of letters; before and after it stands a limit that takes part in trigrams.
    """
    letters = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    own = np.concatenate([[0, 0], letters, [0]]).astype(np.uint64)
    a, b, c = own[:-2], own[1:-1], own[2:]
    keep = (b > 0) | (c > 0)
    begins = ((b == 0) & (c > 0))[keep]
    a, b, c = a[keep], b[keep], c[keep]
    a = np.where(b == 0, 0, a)
    mixed = (a * np.uint64(0x9E3779B1) + b) * np.uint64(0x85EBCA77) + c
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), np.flatnonzero(begins)


def _stretches(text: str, size: int = 1 << 20) -> Iterator[str]:
    """The text in stretches of about ``size``, cut after a space where there is one."""
    low = 0
    while len(text) - low > size:
        high = text.rfind(" ", low, low + size) + 1 or low + size
        yield text[low:high]
        low = high
    yield text[low:]


def word_likelihoods(text: str, model: np.ndarray) -> np.ndarray:
    """Log-likelihood of each word (rows) under each language (columns)."""
    out = [np.zeros((0, model.shape[1]))]
    for stretch in _stretches(text):
        found, begins = trigrams(stretch, len(model))
        for low in range(0, len(begins), 1 << 14):
            part = begins[low : low + (1 << 14)]
            end = begins[low + (1 << 14)] if low + (1 << 14) < len(begins) else len(found)
            out.append(np.add.reduceat(model[found[part[0] : end]], part - part[0], axis=0))
    return np.concatenate(out)


def _proportions(likelihood: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions of the columns by expectation-maximisation, and the log-likelihood."""
    top = likelihood.max(axis=1, keepdims=True)
    scaled = np.exp(likelihood - top)
    share = np.full(likelihood.shape[1], 1.0 / likelihood.shape[1])
    for _ in range(rounds):
        joint = scaled * share
        share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, float((np.log((scaled * share).sum(axis=1)) + top[:, 0]).sum())


def infer(likelihood: np.ndarray, penalty: float, rounds: int) -> dict[int, float]:
    """Proportion of each language that takes part."""
    sums = likelihood.sum(axis=0)
    chosen, share, best, cost = [int(sums.argmax())], np.ones(1), float(sums.max()), penalty * np.log(len(likelihood) + 1)
    while len(chosen) < likelihood.shape[1]:
        have = likelihood[:, chosen]
        most = np.maximum(likelihood - (have + np.log(share)).max(axis=1, keepdims=True), 0).sum(axis=0)  # no more can be gained
        most[chosen] = 0
        found = None
        for k in np.argsort(-most):
            if most[k] <= cost or found and most[k] <= found[0] - best:
                break
            shares, total = _proportions(likelihood[:, [*chosen, int(k)]], rounds)
            if total - best > cost and (found is None or total > found[0]):
                found = (total, int(k), shares)
        if found is None:
            break
        best, share = found[0], np.maximum(found[2], 1e-12)
        chosen.append(found[1])
    return dict(zip(chosen, share.tolist(), strict=True))


def train(labelled: DataFrame, buckets: int = 1 << 16, sample: int = 400) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each trigram bucket in each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found, _ = trigrams(text, buckets)
                seen[lang] = seen.get(lang, 0) + np.bincount(found, minlength=buckets)
        for lang, n in seen.items():
            bucket = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(bucket), pa.string()), "bucket": pa.array(bucket), "n": pa.array(n[bucket].astype(np.int64))})

    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((buckets, 0), np.float32)
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, int((1 << 30) * min(1.0, sample / sizes[lang])))))
    chosen = labelled.where(F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30)) < F.element_at(share, F.col("lang")))
    rows = chosen.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((buckets, len(langs)))
    np.add.at(counts, (rows["bucket"].to_numpy(), rows["lang"].map({x: k for k, x in enumerate(langs)}).to_numpy(dtype=int)), rows["n"].to_numpy())
    smooth = 0.5 * (counts.any(axis=1).sum() + 1) / buckets
    return langs, np.log((counts + smooth) / (counts + smooth).sum(axis=0)).astype(np.float32)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether the document is in the fold that is never learned from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def identify(documents: DataFrame, penalty: float = 3.0, rounds: int = 12, sample: int = 400) -> DataFrame:
    """doc_id, held_out, lang_pred, score, and the proportions of all languages that take part, as a map."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held_out(F.col("doc_id").cast("long")).alias("held_out"))
    langs, model = train(rows.where(~F.col("held_out")).select("doc_id", "lang", "text"), sample=sample)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            mixes = []
            for text in batch.column(1).to_pylist():
                likelihood = word_likelihoods(text or "", model)
                mixes.append(infer(likelihood, penalty, rounds) if len(likelihood) and langs else {})
            best = [max(m, key=lambda k: (m[k], -k)) if m else None for m in mixes]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([UNKNOWN if k is None else langs[k] for k in best], pa.string()),
                    pa.array([0.0 if k is None else min(1.0, m[k]) for k, m in zip(best, mixes, strict=True)], pa.float64()),
                    pa.array([[(langs[k], p) for k, p in sorted(m.items())] for m in mixes], pa.map_(pa.string(), pa.float64())),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "proportions"],
            )

    return rows.select("doc_id", "text", "held_out").mapInArrow(
        predict, "doc_id long, held_out boolean, lang_pred string, score double, proportions map<string,double>"
    )

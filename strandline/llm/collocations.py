"""Phrase collocations by pivot partitioning: every phrase is counted where the rarest of its words is.

Words are ordered by how frequent they are in their language; a phrase belongs to its rarest word, the leftmost of
equally rare ones. Each occurrence of a word makes a fragment of itself and up to two words on either side, in which
rarer words, and all beyond them, are blank; fragments are routed to their word, and only phrases that the word owns are mined
from them. So each occurrence of a phrase is counted once, in one place, and only phrases frequent enough leave it. Frequent
words, which occur most, have few words around them that are more frequent still, so their fragments are few different ones, and equal
fragments are counted before they move.

The order has to be the same everywhere, not exact: it comes from a sketch of the words' counts, whose size is a parameter.
A cell holds the level (a logarithm) of the most frequent word that falls into it; words of a level are ordered by hash.
Words in cells without any frequent word are infrequent, and so are all phrases with them: they are blank at once.

Fragments travel in bundles, one for each language and bin of pivots, with the words that they use; the number of bins follows
from the number of words. A bin is counted in bounded memory: if it holds more phrases than a bound, partial counts go out
and are added up by a later sum, which finds nothing to add otherwise.

Defined results: null and empty texts have no words; a null language is ``und``, as is the language of that name; null ids
and repeated rows count like others; further columns are ignored; an empty table, or one without frequent phrases, gives
no rows. Long texts are cut into blocks with two words of context on either side, so no phrase is lost between them.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import keep, modest_batches

#: Between pieces: a byte that UTF-8 never has.
BREAK = b"\xff"
#: A-Z in lower case, tabs as spaces, and the characters that end a piece (fixed by the contract) as breaks.
_TABLE = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz " + BREAK * 10
)
#: Cells of the sketch, to base 2; words that a block of fragments is made from at once; phrases that a bin counts at once.
SKETCH_BITS, BLOCK, PHRASES = 20, 1 << 21, 1 << 21
_U = np.uint64
#: Words are numbered in 21 bits, so that three fit a key.
_BITS = 21


def tokens(text: bytes | None) -> list[bytes]:
    """The words of a text, with breaks between its pieces."""
    return (text or b"").translate(_TABLE).replace(BREAK, b" " + BREAK + b" ").split()


def _whole(documents: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return modest_batches(documents).select(lang.alias("lang"), F.col("text").cast("binary").alias("text"))


def word_counts(documents: DataFrame, most: int = 1 << 18) -> DataFrame:
    """lang, word, f: all occurrences of each word. A task counts up to ``most`` words at once, then sends them on."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)

        def sent() -> Iterator[pa.RecordBatch]:
            for lang, words in found.items():
                del words[BREAK]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), pa.array(list(words), pa.binary()).cast(pa.string()), pa.array(list(words.values()), pa.int64())], ["lang", "word", "f"]
                )
            found.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[lang].update(tokens(text))
            if sum(map(len, found.values())) > most:
                yield from sent()
        yield from sent()

    return _whole(documents).mapInArrow(work, "lang string, word string, f long").groupBy("lang", "word").agg(F.sum("f").alias("f"))


def levels(words: DataFrame, least: int, bits: int = SKETCH_BITS) -> np.ndarray:
    """The sketch: for each cell the level of its most frequent word, 0 if all are infrequent; at most 2 ** ``bits`` rows."""
    cell = F.pmod(F.xxhash64("lang", "word"), F.lit(1 << bits)).cast("int")
    level = F.least(F.lit(255), 1 + F.floor(8 * F.log2(F.col("f") / least))).cast("int")
    rows = words.where(F.col("f") >= least).groupBy(cell.alias("cell")).agg(F.max(level).cast("short").alias("level")).toArrow()
    sketch = np.zeros(1 << bits, np.uint8)
    sketch[rows["cell"].to_numpy()] = rows["level"].to_numpy()
    return sketch


def owned(ids: np.ndarray, core: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """Fragments as columns (pivot, its left and second left word, its right and second right one) of word numbers, blank: 0.

    ``rank`` of a number grows with rarity and is 0 for words that no frequent phrase has; ``core`` marks words that may be pivots.
    """
    padded = np.concatenate([[0, 0], ids, [0, 0]])
    r = rank[padded]
    own = r[2:-2]
    left, right = (r[1:-3] > 0) & (r[1:-3] < own), (r[3:-1] > 0) & (r[3:-1] <= own)
    at = np.flatnonzero(core & (own > 0) & (left | right))
    left, right, own = left[at], right[at], own[at]
    second_left = left & (r[at] > 0) & (r[at] < own)
    second_right = right & (r[at + 4] > 0) & (r[at + 4] <= own)
    return tuple(np.where(used, padded[at + k], 0) for used, k in ((own > 0, 2), (left, 1), (second_left, 0), (right, 3), (second_right, 4)))


def fragments(documents: DataFrame, sketch: np.ndarray, bins: int, block: int = BLOCK) -> DataFrame:
    """bin, lang, words (joined by spaces), codes (five numbers a fragment, 0 or a word's place from 1 on) and how often each occurs."""
    mask = len(sketch) - 1

    def bundled(lang: str, table: dict[bytes, int], parts: list[np.ndarray], cores: list[np.ndarray]) -> Iterator[tuple]:
        names, seed = list(table), xxhash.xxh64_intdigest(lang.encode(), 42)
        hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in names), np.uint64, len(names))
        level = sketch[(hashes & _U(mask)).astype(np.int64)].astype(np.uint64)
        rank = np.where(level > 0, (_U(256) - level) << _U(55) | hashes >> _U(9), _U(0))
        rank[0] = 0
        pivot, l1, l2, r1, r2 = (x.astype(np.uint64) for x in owned(np.concatenate(parts), np.concatenate(cores), rank))
        if not len(pivot):
            return
        own_bin = (hashes >> _U(24)) % _U(bins)
        high, low = own_bin[pivot.astype(np.int64)] << _U(2 * _BITS) | pivot << _U(_BITS) | l1, l2 << _U(2 * _BITS) | r1 << _U(_BITS) | r2
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        first = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        often = np.diff(first, append=len(high)).astype("<u4")
        high, low, part = high[first], low[first], _U((1 << _BITS) - 1)
        columns = np.stack([high >> _U(_BITS) & part, high & part, low >> _U(2 * _BITS), low >> _U(_BITS) & part, low & part], axis=1).astype(np.int64)
        starts = np.flatnonzero(np.diff(high >> _U(2 * _BITS), prepend=_U(bins)))
        for a, b in zip(starts, np.append(starts[1:], len(high)), strict=True):
            used, codes = np.unique(np.append(columns[a:b].ravel(), 0), return_inverse=True)
            yield int(high[a] >> _U(2 * _BITS)), lang, b" ".join([names[k] for k in used[1:]]), codes[:-1].astype("<u4").tobytes(), often[a:b].tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple] = {}
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            kinds = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
            for lang, (table, parts, cores) in held.items():
                rows: list[tuple] = []
                for row in bundled(lang, table, parts, cores):
                    rows.append(row)
                    if len(rows) == 64:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _BUNDLE)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], _BUNDLE)
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = tokens(text)
                for low in range(0, len(words), block):
                    if lang not in held:
                        held[lang] = (_numbers(), [], [])
                    table, parts, cores = held[lang]
                    some = words[max(0, low - 2) : low + block + 2] + [BREAK]
                    parts.append(np.fromiter(map(table.__getitem__, some), np.int32, len(some)))
                    core = np.ones(len(some), bool)
                    core[: low - max(0, low - 2)] = False
                    core[min(low, 2) + block :] = False
                    cores.append(core)
                    size += len(some)
                    if size >= block:
                        yield from sent()
                        size = 0
        yield from sent()

    return _whole(documents).mapInArrow(work, "bin int, lang string, words binary, codes binary, often binary")


_BUNDLE = ["bin", "lang", "words", "codes", "often"]


def _numbers() -> defaultdict[bytes, int]:
    """Numbers words as they come; the break has 0."""
    table: defaultdict[bytes, int] = defaultdict(count().__next__)
    table[BREAK]
    return table


def owned_phrases(codes: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of three words (0: none), and counts, of the phrases that the fragments' pivots own."""
    pivot, l1, l2, r1, r2 = (codes[:, k] for k in range(5))
    none = np.zeros(len(codes), np.uint64)
    phrases = ((l1, pivot, none, l1 > 0), (pivot, r1, none, r1 > 0), (l2, l1, pivot, l2 > 0), (l1, pivot, r1, (l1 > 0) & (r1 > 0)), (pivot, r1, r2, r2 > 0))
    keys = [(a << _U(2 * _BITS) | b << _U(_BITS) | c)[some] for a, b, c, some in phrases]
    return np.concatenate(keys), np.concatenate([often[some] for *_, some in phrases])


def _added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with the sum of its counts."""
    every, own = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every, own = every[order], own[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(own, first) if len(first) else own


def phrases(bundles: DataFrame, least: int, bins: int, most: int = PHRASES) -> DataFrame:
    """lang, first, second, third (null in phrases of two words) and a: all contiguous phrases that occur at least ``least`` times."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, table, keys, counts, size, parted = None, _numbers(), [], [], 0, False

        def sent(least_now: int) -> Iterator[pa.RecordBatch]:
            key, n = _added(keys, counts)
            key, n = key[n >= least_now], n[n >= least_now]
            names = pa.array([None, *list(table)[1:]], pa.binary()).cast(pa.string())
            for low in range(0, len(key), 10_000):
                own, part = key[low : low + 10_000], _U((1 << _BITS) - 1)
                words = [names.take(pa.array((own >> _U(s) & part).astype(np.int64))) for s in (2 * _BITS, _BITS, 0)]
                yield pa.RecordBatch.from_arrays([pa.array([group[1]] * len(own)), *words, pa.array(n[low : low + 10_000])], _PHRASE)

        for batch in batches:
            for number, lang, words, codes, often in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != (number, lang):
                    if keys:
                        yield from sent(1 if parted else least)
                    group, table, keys, counts, size, parted = (number, lang), _numbers(), [], [], 0, False
                some = words.split(b" ")
                if len(table) + len(some) >= 1 << _BITS:  # the numbers would not fit
                    yield from sent(1)
                    table, keys, counts, size, parted = _numbers(), [], [], 0, True
                own = np.concatenate([[0], np.fromiter(map(table.__getitem__, some), np.uint64, len(some))]).astype(np.uint64)
                key, n = owned_phrases(own[np.frombuffer(codes, "<u4")].reshape(-1, 5), np.frombuffer(often, "<u4").astype(np.int64))
                keys.append(key)
                counts.append(n)
                size += len(key)
                if size > 2 * most:
                    key, n = _added(keys, counts)
                    keys, counts, size = [key], [n], len(key)
                    if size > most:
                        yield from sent(1)
                        table, keys, counts, size, parted = _numbers(), [], [], 0, True
        if keys:
            yield from sent(1 if parted else least)

    routed = bundles.repartitionById(bins, "bin").sortWithinPartitions("bin", "lang")  # one bin a task
    mined = modest_batches(routed, 100).mapInArrow(work, "lang string, first string, second string, third string, a long")
    return mined.groupBy("lang", "first", "second", "third").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


_PHRASE = ["lang", "first", "second", "third", "a"]


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in exact decimals."""
    exact = {n: f"cast({n} AS decimal(19, 0))" for n in (a, left, right)}
    return F.expr(f"(1000000BD * {exact[a]} * {exact[a]}) div ({exact[left]} * {exact[right]})")


def scored(found: DataFrame, words: DataFrame) -> DataFrame:
    """lang, first, second, third, a, l, r, score: each phrase at its lowest-scoring cut, the earliest of equal ones."""
    pairs, triples = found.where("third IS NULL").drop("third"), found.where("third IS NOT NULL")

    def counted(table: DataFrame, names: tuple[str, ...], of: tuple[str, ...], f: str) -> DataFrame:
        """``table`` with the count ``f`` of the word or pair in its columns ``of``."""
        return table.join(names_of[len(names)].toDF("lang", *of, f), ["lang", *of])

    names_of = {1: words.select("lang", "word", "f"), 2: pairs.select("lang", "first", "second", "a")}
    two = counted(counted(pairs, ("word",), ("first",), "l"), ("word",), ("second",), "r").withColumn("third", F.lit(None).cast("string"))
    three = counted(counted(triples, ("word",), ("first",), "l1"), ("word",), ("third",), "r2")
    three = counted(counted(three, ("first", "second"), ("first", "second"), "l2"), ("first", "second"), ("second", "third"), "r1")
    cuts = three.withColumn("s1", score("a", "l1", "r1")).withColumn("s2", score("a", "l2", "r2"))
    early = F.col("s1") <= F.col("s2")
    three = cuts.select("lang", "first", "second", "third", "a", F.when(early, F.col("l1")).otherwise(F.col("l2")).alias("l"), F.when(early, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"))
    return two.select("lang", "first", "second", "third", "a", "l", "r", score("a", "l", "r").alias("score")).unionByName(three)


def mine(documents: DataFrame, least: int = 10, top: int = 2000, inside_percent: int = 50, block: int = BLOCK, most: int = PHRASES, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language that don't lie mostly inside longer ones."""
    spark = documents.sparkSession
    words = keep(word_counts(documents), "phrase-words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    size = totals.agg(F.sum("n")).first()[0] or 0
    bins = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // block + 1)
    frequent = words.where(F.col("f") >= least)
    found = keep(phrases(fragments(documents, levels(words, least, sketch_bits), bins, block), least, bins, most), "phrases")
    inner = found.where("third IS NOT NULL").select("lang", "a", F.inline(F.array(F.struct(F.col("first").alias("first"), F.col("second").alias("second")), F.struct(F.col("second").alias("first"), F.col("third").alias("second")))))
    around = inner.groupBy("lang", "first", "second").agg(F.max("a").alias("around"))
    ranked = scored(found, frequent).join(around, ["lang", "first", "second"], "left")
    inside = F.col("third").isNull() & (100 * F.coalesce("around", F.lit(0)) >= inside_percent * F.col("a"))
    phrase = F.concat_ws(" ", "first", "second", "third")
    kept = keep(ranked.where(~inside).select("lang", phrase.alias("phrase"), "a", "l", "r", "score"), "phrases-kept")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the first of each of 64 parts of a language hold its first ones
    some = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""The filter audit, SimHash groups and phrases against plain loops."""

from __future__ import annotations

import collections
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strandline.llm import collocations, filter_audit, simhash

DOCS = "doc_id long, text string, source string, lang string"
ODD = [(1, None, "a", None), (2, "", None, "en"), (3, " \t\n", "", "en"), (4, "x" * 30_000, "b", "en"), (5, "a b " * 20_000, "a", "und"), (None, "one two", "b", "en"), (None, "one two", "b", "en"), (7, "same text #", "a", "fr"), (7, "same text #", "a", "fr"), (8, "same text #", None, "fr"), (9, "SAME TEXT #", "c", "fr")]
CLASH = ("mask", "digest", "part", "n", "fp", "root", "key", "words", "word", "f", "bin", "first", "rank", "filter", "row", "document")


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, DOCS)
    for name in CLASH:
        rows = rows.withColumn(name, F.lit("x"))
    return rows


def plain_audit(docs, labels):
    marks = collections.defaultdict(lambda: [False, False])
    for i, quality, toxic in labels:
        marks[i][0] |= quality == 1
        marks[i][1] |= toxic == 1
    least, failed = {}, []
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, text, source, _ in docs:
        t, own = text or "", set()
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own |= {"A"} if len(words) < 200 else set()
        own |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        own |= {"D"} if re.search("[#$%&*|]", t) else set()
        own |= {"E"} if i is not None and i > least[t] else set()
        failed.append((source or "", own, *(marks[i] if i is not None else (False, False))))
    rows, total = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {s for s, *_ in failed}:
            left = [x for x in failed if x[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                out = [x for x in left if f in x[1]]
                rows[part, order, step] = [
                    len(left) - len(out), len(out), sum(f in x[1] for x in gone), sum(x[0] == part and x[1] == {f} for x in failed), sum(x[2] for x in out), sum(x[3] for x in out)
                ]
                total[part, f] += len(out)
                left, gone = [x for x in left if f not in x[1]], gone + out
    return {(part, order, step, *r, total[part, order[step - 1]]) for (part, order, step), r in rows.items()}


def test_filter_audit_equals_plain_orders(spark):
    rng, docs = random.Random(3), []
    for i in range(150):
        words = rng.choices([f"w{k}" for k in range(rng.choice((30, 400)))], k=rng.choice((20, 199, 200, 260)))
        text = " ".join(words).replace("w1 ", rng.choice(("w1 ", "W1 WW ", "# ", "w1 ")))
        docs.append((rng.randrange(100), rng.choice((text, docs[-1][1] if docs else text)), rng.choice(("a", "b", None, "")), None))
    docs += [docs[0], (None, docs[5][1], "a", None), (None, docs[5][1], "a", None)]
    labels = [(i, rng.choice((0, 1, None)), rng.choice((0, 1, None))) for i in rng.choices(range(120), k=90)]
    found = filter_audit.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    rows = list(map(tuple, found.collect()))
    assert len(rows) == len(set(rows)) == 600 * 3 and set(rows) == plain_audit(docs, labels)


def test_filter_audit_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(7, 1, 0), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int").withColumn("part", F.lit(1)).withColumn("mask", F.lit(1))
    assert set(map(tuple, filter_audit.audit(odd, labels).collect())) == plain_audit(ODD, [(7, 1, 0), (99, 1, 1)])
    assert filter_audit.audit(odd.limit(0), labels).count() == 0
    assert {r["good_lost"] + r["toxic_lost"] for r in filter_audit.audit(odd, labels.limit(0)).collect()} == {0}


def plain_fingerprint(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})))
    size = min(size, len(words))
    hashes = [xxhash.xxh64(" ".join(words[k : k + size]).encode(), seed=42).intdigest() for k in range(len(words) - size + 1)] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance):
    """Each place's group over links, by a search from each place that has none yet."""
    group = [None] * len(prints)
    for k in range(len(prints)):
        if group[k] is None:
            todo = [k]
            while todo:
                x = todo.pop()
                group[x] = k
                todo += [y for y in range(len(prints)) if group[y] is None and (prints[x] ^ prints[y]).bit_count() <= distance]
    return group


def test_fingerprints_equal_plain_ones(spark, odd):
    rng = random.Random(5)
    texts = [t for _, t, *_ in ODD] + [" ".join(rng.choices(["a", "Bé", "c\xa0d", "É", "x" * 40, "日本"], k=rng.randint(0, 30))) for _ in range(60)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = dict(map(tuple, simhash.fingerprints(rows).collect()))
    assert [found[k] % 2**64 for k in range(len(texts))] == [plain_fingerprint(t) for t in texts]
    one = rows.where("doc_id < 60").select(F.xxhash64(F.lit("of the same words")).alias("h")).first()["h"]
    assert plain_fingerprint("Of the  SAME\nwords") == one % 2**64
    long = [(" ".join(rng.choices("abcdefgh", k=simhash.AT_ONCE + 5))).encode(), b"a b c d e f"]
    assert simhash.fingerprints_of([simhash.shingle_hashes(t, 4) for t in long]).tolist() == [plain_fingerprint(t.decode()) for t in long]


@pytest.mark.parametrize(("segments", "distance"), [(None, 4), (2, 4), (3, 4), (4, 4), (3, 3), (2, 2)])
def test_balls_miss_no_link(spark, segments, distance):
    """Chains of fingerprints just within the distance and just beyond it, clusters, and their neighbours."""
    rng, prints = random.Random(7), {0, 1, (1 << 64) - 1}
    for base in [rng.getrandbits(64) for _ in range(12)]:
        chain = base
        for step in range(6):
            chain ^= sum(1 << b for b in rng.sample(range(64), distance + step % 2))
            prints.add(chain)
        prints |= {base ^ sum(1 << b for b in rng.sample(range(20, 32), rng.randint(0, 6))) for _ in range(25)} | {base}
    prints = sorted(prints)
    classes = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    roots = {r["fp"] % 2**64: r["root"] for r in simhash.grouped(classes, distance, segments).collect()}
    want = plain_groups(prints, distance)
    assert len(roots) == len(prints) and len(set(want)) > 5
    assert len(set(zip(want, (roots[p] for p in prints), strict=True))) == len(set(want)) == len(set(roots.values()))


def test_every_difference_is_looked_up():
    for distance, segments in ((4, 2), (4, 3), (4, 4), (3, 2), (1, 2)):
        balls, sizes, shift = [], simhash.widths(segments), 0
        for width, radius in zip(sizes, simhash.radii(distance, segments), strict=True):
            balls.append(({m << shift for m in simhash.masks(width, radius)}, ((1 << width) - 1) << shift))
            shift += width
        assert shift == 64
        rng = random.Random(1)
        for _ in range(3000):
            xor = sum(1 << b for b in rng.sample(range(64), rng.randint(0, distance)))
            assert any(xor & whole in ball for ball, whole in balls)


def test_simhash_groups(spark, odd):
    rng = random.Random(11)
    docs = [(int(i), " ".join(rng.choices([f"w{k}" for k in range(500)], k=120))) for i in rng.sample(range(10_000), 40)]
    docs += [(20_000 + k, docs[k % 5][1] if k % 2 else docs[k % 5][1].replace(" ", " extra ", 1)) for k in range(30)]
    docs += [(30_000, None), (29_999, " "), (None, docs[0][1])]
    found = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in simhash.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    prints = [plain_fingerprint(t) for _, t in docs]
    group = plain_groups(prints, 4)
    for k, (i, _) in enumerate(docs):
        assert found[i, f"{prints[k]:016x}"] == min(docs[j][0] for j in range(len(docs)) if group[j] == group[k] and docs[j][0] is not None)
    rows = simhash.groups(odd).collect()
    assert len(rows) == len(ODD) and {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16} == {1} and {r["component_id"] for r in rows if r["doc_id"] is None} == {None}
    assert {r["component_id"] for r in rows if r["doc_id"] in (7, 8, 9)} == {7}
    assert simhash.groups(odd.limit(0)).count() == 0


def test_many_near_copies_make_few_pairs(spark):
    """A cluster in which a few bits are set in all ways is joined by its buckets' smallest members, so no pairs are left."""
    rng = random.Random(2)
    base = rng.getrandbits(62)
    prints = {base ^ sum(1 << b for b in some) for n in range(4) for some in itertools.combinations(range(10, 20), n)} | {rng.getrandbits(62) for _ in range(200)}
    rooted = simhash.grouped(spark.createDataFrame([(p,) for p in prints], "fp long"), 4, 3).collect()
    assert collections.Counter(r["root"] for r in rooted).most_common(2)[0][1] == 176 and len({r["root"] for r in rooted}) == 201


def plain_phrases(docs, least=10, top=2000):
    grams, total = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, _, lang in docs:
        lower = (text or "").translate(str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}))
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for n in (1, 2, 3):
                grams[lang or "und"].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    rows = []
    for lang, f in grams.items():
        often = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in often.items():
            if any(len(h) > len(g) and 100 * b >= 50 * a and any(h[k : k + len(g)] == g for k in range(len(h) - len(g) + 1)) for h, b in often.items()):
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        rows += [(lang, rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return rows


def phrase_texts():
    rng, docs = random.Random(17), []
    common = [f"w{k}" for k in range(12)] + ["the", "the", "The", "é", "日本", "x|y", "#"]
    for i in range(120):
        lang = rng.choice(("en", "en", "en", None, "und", "fr"))
        words = [rng.choice(common) if rng.random() < 0.9 else f"rare{rng.randrange(2000)}" for _ in range(rng.randint(0, 160))]
        docs.append((i, "".join(w + rng.choice((" ", " ", " ", "\t", ", ", ".", " \n", "  ")) for w in words), "s", lang))
    docs += [(500 + k, "a fixed line of words that all of them hold", "s", "en") for k in range(40)] + [(600, "go go go go go go go go go go go go go go", "s", "en")]
    return docs


@pytest.mark.parametrize(("block", "most", "bits"), [(1 << 21, 1 << 21, 20), (50, 1 << 21, 12), (7, 20, 3), (300, 60, 1)])
def test_phrases_equal_plain_ones(spark, block, most, bits):
    """Also with texts cut into blocks, bins that overflow, and sketches in which almost all words look alike."""
    docs = phrase_texts()
    found = collocations.mine(spark.createDataFrame(docs, DOCS).repartition(3), block=block, most=most, sketch_bits=bits)
    assert sorted(map(tuple, found.collect())) == sorted(plain_phrases(docs))


def test_first_phrases_and_other_counts(spark):
    docs = phrase_texts()
    found = collocations.mine(spark.createDataFrame(docs, DOCS), least=3, top=25)
    assert sorted(map(tuple, found.collect())) == sorted(plain_phrases(docs, 3, 25))


def test_phrases_of_odd_rows(spark, odd):
    assert sorted(map(tuple, collocations.mine(odd).collect())) == sorted(plain_phrases(ODD))
    assert collocations.mine(odd.limit(0)).count() == 0 and collocations.mine(odd.where("doc_id < 4")).count() == 0


def test_scores_pass_64_bits(spark):
    rows = [(10**12, 10**12 + 7, 3 * 10**12), (4_000_000_000, 4_000_000_000, 4_000_000_001), (10, 11, 12)]
    found = spark.createDataFrame(rows, "a long, l long, r long").select(collocations.score("a", "l", "r")).collect()
    assert [r[0] for r in found] == [1_000_000 * a * a // (x * y) for a, x, y in rows]


def test_each_phrase_has_one_owner():
    """Fragments own every phrase of frequent words once, whatever the ranks."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        rank = np.concatenate([[0], rng.integers(0, 4, 9)]).astype(np.uint64)
        ids = rng.integers(0, 10, 60)
        codes = np.stack(collocations.owned(ids, np.ones(60, bool), rank), axis=1).astype(np.uint64)
        keys, counts = collocations._added(*([x] for x in collocations.owned_phrases(codes, np.ones(len(codes), np.int64))))
        want = collections.Counter(tuple(ids[k : k + n]) for n in (2, 3) for k in range(61 - n) if (rank[ids[k : k + n]] > 0).all())
        assert {(int(k) >> 42, int(k) >> 21 & 0x1FFFFF, int(k) & 0x1FFFFF): n for k, n in zip(keys, counts, strict=True)} == {tuple(map(int, (*g, 0)[:3])): n for g, n in want.items()}

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import exact_dedup, mixing, near_dedup, packing, token_output
from strandline.llm.queries import vocabulary
from strandline.llm.tokens import Encoder

DOCS = "doc_id long, text string, source string"
ODD = [(1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "x" * 30_000, "b"), (5, "a b " * 20_000, "a"), (None, "one two", "b"), (7, "same text", "a"), (7, "same text", "a"), (8, "sam etext", None)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, DOCS)
    return rows.withColumn("row", F.lit("x")).withColumn("kept", F.lit(1)).withColumn("part", F.lit(1)).withColumn("hash", F.lit(1)).withColumn("id", F.lit(1))


def test_encoder_equals_the_library():
    tokenizer, encoder, rng = Tokenizer.from_file(vocabulary()), Encoder(vocabulary(), most=50), random.Random(1)
    bits = [" ", "  ", "\n", "a", "B", "é", "12", ".", ",", "'s", "\t", "\xa0", "　", "$", "<|endoftext|>", "word", "ß", "\x1c", "!", "٣", "日本", "\r\n", "\U0001f600"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 9))) for _ in range(6000)] + ["x" * 3000]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_lines_and_runs_of_signs_are_encoded_without_a_pattern(monkeypatch):
    """op10 and op2: such pieces are common; each was cut by a regular expression, at several times the cost of a word."""
    from strandline.llm import tokens

    class Cut:
        def __init__(self):
            self.seen = []

        def findall(self, text, found=tokens._WORD.findall):
            self.seen.append(text)
            return found(text)

    cut = Cut()
    monkeypatch.setattr(tokens, "_WORD", cut)
    tokenizer, rng = Tokenizer.from_file(vocabulary()), random.Random(2)
    plain = ["then said.\nThe next", "so much### for *that*\nLine", "a über,\nÉté!! b", "one's don't it'\n's"]
    bits = ["ab", "Zé", "'", "'s", ".", "$$", "_", "7", "²", "\n", "\n\n", "\t", "\xa0", " ", "ɐ", "ª"]
    mixed = ["x " + "".join(rng.choices(bits, k=rng.randint(1, 7))) for _ in range(6000)]
    for texts in (plain[:3], plain + mixed):
        for text, ids in zip(texts, Encoder(vocabulary(), most=60).encode(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        if texts == plain[:3]:
            assert cut.seen == [" *that*"]


def test_frequent_words_outlast_rare_ones_in_the_memo():
    encoder, merged = Encoder(vocabulary(), most=40), collections.Counter()
    model = encoder.words.model

    class Counting:
        def tokenize(self, letters):
            merged[letters] += 1
            return model.tokenize(letters)

    encoder.words.model = Counting()
    letters = "abcdefghijklmnop"
    for k in range(200):
        rare = letters[k % 16] + "q" + letters[k // 16] + "x"
        list(encoder.encode([f"the often {rare}"]))
    assert merged["\u0120often"] == 1 and merged["\u0120aqax"] == 1


def test_token_files_round_trip(spark, odd):
    tokenizer = Tokenizer.from_file(vocabulary())
    folder = token_output.write(odd, vocabulary())
    found = token_output.checksums(token_output.read(spark, folder, ("doc_id", "ids"))).orderBy("start").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda x: (x is not None, x)) and len(found) == len(ODD)
    texts, start = collections.defaultdict(list), 0
    for i, t, _ in ODD:
        texts[i].append(t or "")
    for r in found:
        want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids + [2], "<u4").tobytes() for t in texts[r["doc_id"]]]
        assert r["start"] == start and (r["n_tokens"], r["ids_crc32"]) in [(len(w) // 4, zlib.crc32(w)) for w in want]
        start += r["n_tokens"]
    assert token_output.checksums(token_output.read(spark, token_output.write(odd.limit(0), vocabulary()), ("doc_id", "ids"))).count() == 0


def test_token_files_can_be_read_in_part(spark):
    """Delta-coded numbers, dictionary-coded ids, page indexes, bounded row groups; a read of metadata leaves the ids on disk."""
    import glob

    import pyarrow.parquet as pq

    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("some words of text "), F.col("id")).alias("text"))
    folder = token_output.write(docs, vocabulary(), layout={"parquet.block.size": str(8 << 10)})
    files = [pq.ParquetFile(f).metadata for f in glob.glob(f"{folder.removeprefix('file://')}/*.parquet")]
    groups = [m.row_group(k) for m in files for k in range(m.num_row_groups)]
    assert len(groups) > len(files)
    for group in groups:
        columns = {c.path_in_schema: c for c in (group.column(k) for k in range(group.num_columns))}
        ids = next(c for n, c in columns.items() if n.startswith("ids"))
        assert any("DICTIONARY" in e for e in ids.encodings) and any("DELTA" in e for e in columns["doc_id"].encodings)
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
    part = token_output.read(spark, folder, ("doc_id", "n_tokens"))
    scans = [x for x in part._jdf.queryExecution().executedPlan().toString().split("ReadSchema: ")[1:]]
    assert scans and all("ids" not in x.splitlines()[0] for x in scans) and part.count() == 3000
    one = token_output.read(spark, folder).where("doc_id = 77")
    assert "PushedFilters" in one._jdf.queryExecution().executedPlan().toString() and one.first()["n_tokens"] == len(one.first()["ids"])


def plain_best_fit(lengths, capacity):
    bins = []
    for length in sorted(lengths, reverse=True):
        room = min((b for b in bins if b >= length), default=None)
        if room is None:
            bins.append(capacity - length)
        else:
            bins[bins.index(room)] -= length
    return len(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 100])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 300))]
    rows = packing.plan(collections.Counter(lengths), capacity)
    placed = collections.defaultdict(list)
    for length, count in collections.Counter(lengths).items():
        own = sorted(r for r in rows if r[0] == length)
        for rank in range(count):
            r = [x for x in own if x[1] <= rank][-1]
            ahead = rank - r[1]
            placed[r[3] + ahead // r[2]].append((r[4] + ahead % r[2] * length, length))
    for items in placed.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(placed) == plain_best_fit(lengths, capacity)


def test_packing(spark, odd):
    found = packing.pack(odd, vocabulary(), capacity=64).toPandas().sort_values(["sequence_id", "offset"])
    before = found.groupby("sequence_id")["length"].cumsum() - found["length"]
    assert (before == found["offset"]).all() and found.groupby("sequence_id")["length"].sum().max() <= 64
    assert ((found["piece"] == 0) | (found["length"] == 64)).all() and found["doc_id"].isna().any()
    assert packing.pack(odd.limit(0), vocabulary()).count() == 0


def strip(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize(("block", "bits"), [(2048, 64), (3, 64), (3, 2)])
def test_exact_dedup(spark, odd, block, bits):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("ab", k=rng.randint(0, 12))), "s") for i in range(80)]
    df = spark.createDataFrame(rows, DOCS)
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[strip(t)].append((-len(t), i))
    found = {r["doc_id"]: r for r in exact_dedup.dedup(df, block, bits).collect()}
    for i, t, _ in rows:
        own = groups[strip(t)]
        assert (found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (min(own)[1], len(own), min(own)[1] == i)
        assert found[i]["text_sha256"] == hashlib.sha256(strip(t).encode()).hexdigest()


def test_exact_dedup_of_odd_rows(spark, odd):
    found = exact_dedup.dedup(odd)
    assert found.count() == len(ODD) and found.where("kept").count() == len({strip(t) for _, t, _ in ODD})
    kept = exact_dedup.survivors(odd)
    assert kept.columns == odd.columns and kept.count() == len({strip(t) for _, t, _ in ODD})
    assert exact_dedup.dedup(odd.limit(0)).count() == 0


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(size, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    groups = collections.defaultdict(list)
    for i, (k, _) in enumerate(rows):
        groups[find(i)].append(k)
    return {k: (len(sets[i]), min(groups[find(i)])) for i, (k, _) in enumerate(rows)}


def test_near_dedup_equals_brute_force(spark):
    rng = random.Random(6)
    vocabulary_ = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary_, k=40)
    rows = []
    for _ in range(25):
        base = rng.choices(vocabulary_, k=rng.randint(1, 60)) + (passage if rng.random() < 0.5 else [])
        for _ in range(rng.choice([1, 1, 4])):
            copy = [w.upper() if rng.random() < 0.1 else rng.choice(vocabulary_) if rng.random() < 0.03 else w for w in base]
            rows.append((len(rows), " ".join(copy)))
    found = near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 4).collect()
    want = brute_components(rows, 4, 80)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


@pytest.mark.parametrize("percent", [50, 65])
def test_near_dedup_at_other_similarities(spark, percent):
    rng = random.Random(percent)
    rows = []
    for _ in range(30):
        base = [f"w{rng.randint(0, 10**6)}" for _ in range(103)]
        cut = rng.randint(0, 40)
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(base[cut:] + [f"v{rng.randint(0, 10**6)}" for _ in range(cut // 2)]))]
    found = near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 4, percent).collect()
    want = brute_components(rows, 4, percent)
    assert {r["doc_id"]: r["component_id"] for r in found} == {k: c for k, (_, c) in want.items()}
    assert 10 < len({c for _, c in want.values()}) < 60


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(7)
    pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    a, b = np.sort(pool[:300]), np.sort(pool[100:])
    one, two = near_dedup.signatures([a, b], 200)
    assert abs((one == two).mean() - 0.5) < 0.12
    assert (near_dedup.signatures([a], 200) == near_dedup.signatures([b, a], 200)[1]).all()
    sets = [np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (1, 40, 7, 100, 33, 250, 2)]
    assert (near_dedup.signatures(sets, 50, most=32) == near_dedup.signatures(sets, 50)).all()
    short = near_dedup.signatures([pool[:1]], 200)[0]
    assert len(set((short >> np.uint64(56)).tolist())) == 200  # one element takes every rank once


def test_near_dedup_of_odd_rows(spark, odd):
    found = near_dedup.groups(odd)
    assert found.count() == len(ODD) and near_dedup.groups(odd.limit(0)).count() == 0
    assert {(r["n_shingles"], r["component_id"]) for r in found.where("doc_id = 7").collect()} == {(1, 7)}
    assert near_dedup.distinct(odd).columns == odd.columns


def test_groups_around_the_similarity(spark):
    """Copies of one text with two words changed each are about 66 to 100 percent alike: chains of a few links among very many near misses."""
    rng = random.Random(180)
    base, rows = [f"w{k}" for k in range(103)], []
    for k in range(150):
        copy = list(base)
        for at in rng.sample(range(103), 2):
            copy[at] = f"x{rng.randrange(10**9)}"
        rows.append((k, " ".join(copy)))
    want = {k: c for k, (_, c) in brute_components(rows, 5, 80).items()}
    found = near_dedup.groups(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want and 10 < len(set(want.values())) < 150


def test_mixing_targets_and_takes(spark, odd):
    rng = random.Random(8)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(400)]
    df = spark.createDataFrame(rows, DOCS)
    found = mixing.mix(df, block_words=4).toPandas()
    sizes = collections.Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, left = {}, set(order), sum(sizes.values())
    while free:
        unit = left / sum(weight[s] for s in free)
        full = {s for s in free if unit * weight[s] > 3 * sizes[s]}
        target |= {s: 3 * sizes[s] for s in full} if full else {s: unit * weight[s] for s in free}
        left, free = left - sum(3 * sizes[s] for s in full), free - full if full else set()
    for s in order:
        own = found[found["source"].isna()] if s is None else found[found["source"] == s]
        assert (own["target"] - target[s]).abs().max() < 1e-6 and own["source_size"].iloc[0] == sizes[s]
        assert abs(own["taken"].sum() - target[s]) <= 0.5
    assert (found["taken"] <= 3 * found["size"]).all()
    again = mixing.mix(df.repartition(7), block_words=4).toPandas()
    key = lambda x: x.sort_values("doc_id")[["doc_id", "taken"]].to_numpy().tolist()
    assert key(found) == key(again)
    assert mixing.mix(odd).count() == len(ODD) and mixing.mix(odd.limit(0)).count() == 0
    assert mixing.copies(df).columns == df.columns


def plain_schedule(slots):
    """Sources of the slots in order: van der Corput points through the numbers of slots laid end to end."""
    total = sum(slots)
    bits = max(1, (total - 1).bit_length())
    out = []
    for i in range(1 << bits):
        point = int(format(i, f"0{bits}b")[::-1], 2)
        if point < total:
            out.append(next(k for k in range(len(slots)) if point < sum(slots[: k + 1])))
    return out


@pytest.mark.parametrize("slots", [[1000, 600, 400], [1], [0, 5, 0, 2], [3, 3, 3, 3, 3], [1, 64], []])
def test_schedule_equals_plain_one_and_is_even(spark, slots):
    lows = [sum(slots[:k]) for k in range(len(slots))]
    shared = spark.createDataFrame(list(zip(range(len(slots)), slots, lows)), "k long, slots long, low long")
    found = mixing.schedule(spark, shared).orderBy("place").collect()
    want = plain_schedule(slots)
    assert [r["place"] for r in found] == list(range(sum(slots))) and [r["k"] for r in found] == want
    seen = collections.Counter()
    for r in found:
        assert r["rank"] == seen[r["k"]]
        seen[r["k"]] += 1
    for n in range(0, len(want), 37):
        assert all(abs(want[:n].count(k) - n * c / len(want)) <= 2 * len(bin(len(want))) / 3 for k, c in enumerate(slots))


def test_mix_equals_plain_one(spark):
    """taken and the order of copies against the schedule walked slot by slot over each source's stream."""
    rng = random.Random(9)
    rows = [(i // 2, "w " * rng.choice([0, 1, 5, 30]), rng.choice(["a", "a", "b", None])) for i in range(60)]
    df = spark.createDataFrame(rows, DOCS).coalesce(1)
    turns = df.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size")).withColumn("turn", mixing._turn()).collect()
    block, found = 7, mixing.mix(df, block_words=7).orderBy("row").collect()
    order = sorted({r["source"] for r in turns}, key=lambda s: (s is None, s or ""))
    target = {r["source"]: round(r["target"]) for r in found}
    slots = [-(-target[s] // block) for s in order]
    streams = {s: [(row, c) for row in sorted((k for k, r in enumerate(turns) if r["source"] == s), key=lambda k: (turns[k]["turn"], k)) for c in range(turns[row]["size"])] for s in order}
    taken, mixed, done = collections.Counter(), [], collections.Counter()
    for k in plain_schedule(slots):
        s = order[k]
        words = [(streams[s][x % len(streams[s])], x // len(streams[s])) for x in range(done[s], min(done[s] + block, target[s]))]
        done[s] += block
        for (row, c), turn in words:
            taken[row, turn] += 1
            mixed += [(row, turn)] if c == 0 else []
    assert [r["taken"] for r in found] == [sum(taken[row, t] for t in range(3)) for row in range(len(rows))]
    want = [rows[row] for row, t in mixed if 2 * taken[row, t] >= turns[row]["size"]]
    assert [tuple(r) for r in mixing.copies(df, block_words=7).collect()] == want


def test_running_sums(spark):
    rng = random.Random(10)
    rows = [(rng.randint(0, 3), k, rng.randint(0, 9)) for k in range(5000)]
    got = {r["k"]: r["sum"] for r in mixing.running(spark.createDataFrame(rows, "g long, k long, v long").repartition(3), ["g", "k"], {"sum": F.col("v")}).collect()}
    total = 0
    for g, k, v in sorted(rows):
        assert got[k] == total
        total += v


def test_columns_that_clash(spark, odd):
    """Names that operators might use themselves stay as they are."""
    clash = odd.withColumn("__row", F.lit("r")).withColumn("__id", F.lit("i")).withColumn("__hash", F.lit("h")).withColumn("__times", F.lit("t")).withColumn("place", F.lit("p")).withColumn("document", F.lit("d"))
    for kept in (exact_dedup.survivors(clash), near_dedup.distinct(clash), mixing.copies(clash, block_words=8)):
        assert kept.columns == clash.columns
        assert {(r["__row"], r["__id"], r["__hash"], r["__times"], r["place"], r["document"]) for r in kept.collect()} == {("r", "i", "h", "t", "p", "d")}


def test_pipeline_stages_against_plain_ones(spark, tmp_path):
    """Each stage on what its predecessor wrote, by brute force on its own input."""
    import corpus_pipeline
    from strandline.llm import quality

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("__row", F.lit("x")).withColumn("row", F.lit(1))
    columns = docs.columns
    stages = iter(corpus_pipeline.STAGES)

    def step(before):
        name, stage = next(stages)
        path = f"{tmp_path}/{name}"
        stage(spark, before, "/root/testdata/sf0.001").write.parquet(path)
        return spark.read.parquet(path)

    rows = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}

    kept = step(docs)
    verdicts = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert kept.columns == columns and set(rows(kept)) == {k for k, v in verdicts.items() if v} and 0 < kept.count() < docs.count()

    single = step(kept)
    groups = collections.defaultdict(list)
    for k, t in rows(kept).items():
        groups[strip(t)].append((-len(t), k))
    assert single.columns == columns and set(rows(single)) == {min(g)[1] for g in groups.values()} and single.count() < kept.count()

    apart = step(single)
    plain = brute_components(list(rows(single).items()), 5, 80)
    assert apart.columns == columns and set(rows(apart)) == {k for k, (_, component) in plain.items() if k == component} and 0 < apart.count()

    mixed = step(apart)
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in mixing.mix(apart).collect()}
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    assert mixed.columns == columns
    assert times == {k: n for k, (size, t) in taken.items() for n in [(2 * t + size) // (2 * size) if size else 0] if n}

    packed = step(mixed)
    tokenizer = Tokenizer.from_file(vocabulary())
    lengths, texts = [], {k: t for k, t in rows(mixed).items()}
    coded = {k: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for k, t in texts.items()}
    for k, n in times.items():
        lengths += ([(len(coded[k]) - 1) % 2048 + 1] + [2048] * ((len(coded[k]) - 1) // 2048)) * n
    found = packed.collect()
    assert sorted(r["length"] for r in found) == sorted(lengths)
    for r in found:
        ids = np.array(coded[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(ids.tobytes()) == r["ids_crc32"]
    assert len({r["sequence_id"] for r in found}) == plain_best_fit(lengths, 2048)
    at = collections.defaultdict(list)
    for r in found:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048


def test_pipeline_of_odd_rows(spark, odd):
    import corpus_pipeline

    long = odd.unionByName(odd.where("doc_id = 7").withColumn("text", F.lit("A sentence of some words, and more of them here. " * 3 + "And other words that are not the same as these, so that it is long enough to stay in the corpus for the test of all stages, in one piece of text.")))
    for docs in (long, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == odd.columns, name
            docs = out.sparkSession.createDataFrame(out.collect(), out.schema)
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == docs.count()

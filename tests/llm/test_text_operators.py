from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.llm import html_text, language_id, pii, quality, secrets, weak_supervision

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "x" * 50_000), (5, "a b " * 20_000), (None, "one two"), (7, "same"), (7, "same"), (8, "\U0001f600 é ß")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names operators use themselves."""
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.withColumn("source", F.lit(None).cast("string")).withColumn("lang", F.lit("en")).withColumn("kept", F.lit(1)).withColumn("row", F.lit(2)).withColumn("size", F.lit("s")).withColumn("words", F.lit("w"))


def test_language_id(spark, odd):
    rng = random.Random(1)
    words = {"en": "the and of to with from this that house".split(), "de": "der und von zu mit aus dieser das haus".split()}
    rows = [(i, " ".join(rng.choices(words[lang], k=30)), lang) for i in range(200) for lang in (("en", "de")[i % 2],)]
    rows += [(900, None, "en"), (901, "123 !!", "de"), (902, " ".join(rng.choices(words["en"], k=30) + rng.choices(words["de"], k=20)), None)]
    found = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i]["lang_pred"] == ("en", "de")[i % 2] for i in range(200))
    assert found[900]["lang_pred"] == found[901]["lang_pred"] == "und" and found[900]["score"] == 0
    assert set(found[902]["proportions"]) == {"en", "de"} and found[902]["lang_pred"] == "en" and 0.5 < found[902]["score"] < 0.7
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled).collect()} == {"und"}
    assert language_id.identify(odd).count() == len(ODD) and language_id.identify(odd.limit(0)).count() == 0


def test_language_mixtures_equal_brute_force(spark):
    """Trigrams as strings, expectation-maximisation to the end, and every set of languages: the set of the best penalised likelihood."""
    import itertools
    import math
    import zlib

    rng = random.Random(12)
    langs = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(60)] for lang, letters in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "ghijka"))}
    text = lambda lang, n: " ".join(rng.choices(langs[lang], k=n))
    rows = [(i, text(lang, 40), lang) for i, lang in enumerate(list(langs) * 30)]
    rows += [(1000 + i, text(a, 30) + " " + text(b, 20), None) for i, (a, b) in enumerate(list(itertools.permutations(langs, 2)) * 2)] + [(2000, " ".join(text(x, 25) for x in langs), None)]
    grams = lambda word: [f"  {word} "[k : k + 3] if k else f" {word} "[0:2] for k in range(len(word) + 1)]
    counts = {lang: collections.Counter() for lang in langs}
    for i, t, lang in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            for word in t.split():
                counts[lang].update(grams(word))
    buckets = 1 << 16
    smooth = 0.5 * (len(set().union(*counts.values())) + 1) / buckets
    total = {lang: sum(c.values()) + smooth * buckets for lang, c in counts.items()}
    score = lambda lang, word: sum(math.log((counts[lang][g] + smooth) / total[lang]) for g in grams(word))
    found = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    for i, t, _ in rows[::9] + rows[90:]:
        words = t.split()
        table = np.array([[score(lang, word) for lang in langs] for word in words])
        best = None
        for n in (1, 2, 3):
            for chosen in itertools.combinations(range(3), n):
                part, share = table[:, chosen], np.full(n, 1 / n)
                for _ in range(200):
                    joint = np.exp(part - part.max(axis=1, keepdims=True)) * share
                    share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
                value = (np.log((np.exp(part - part.max(axis=1, keepdims=True)) * share).sum(axis=1)) + part.max(axis=1)).sum() - (n - 1) * 3.0 * math.log(len(words) + 1)
                if best is None or value > best[0]:
                    best = (value, dict(zip([list(langs)[k] for k in chosen], share, strict=True)))
        want = best[1]
        assert set(found[i]["proportions"]) == set(want) and found[i]["lang_pred"] == max(want, key=want.get)
        assert all(abs(found[i]["proportions"][k] - p) < 0.05 for k, p in want.items())


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs).where("held_out").join(docs.select("doc_id", "lang", "text"), "doc_id").where("lang IS NOT NULL AND text rlike '[a-z]{3}'")
    assert found.where("lang_pred = lang").count() >= 0.99 * found.count() > 100


def test_trigrams_do_not_depend_on_stretches():
    model = np.random.default_rng(0).standard_normal((1 << 10, 3)).astype(np.float32)
    text = "Ein Haus am See " * 80_000
    assert language_id.word_likelihoods(text, model).shape == (4 * 80_000, 3)


def base_secrets(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24])


def test_secrets(spark, odd):
    rng = random.Random(2)
    bits = ["token=", "secret: ", "AKIA", "ABCDEFGH12345678", "0f" * 12, " ", "\n", "abcdef", "é", "\U0001f600", "apikey='", "x", "Password =", "-"]
    rows = [(i, "".join(rng.choices(bits, k=12))) for i in range(400)]
    found = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        base = base_secrets(t)
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert found[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(found[i]["spans"].split(","))
    words = ["internationalisation", "understandingofthis", "responsibilities", "communication-channel", "relationshipbuilding"]
    rows = [(i, " ".join(rng.choices(words, k=20))) for i in range(100)] + [(1000, "plain words and aKey9Zx2Qw7Lm4Vt8Rb1Ny6Hj3Kd5 here")]
    found = {r["doc_id"]: r["spans"] for r in secrets.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found.pop(1000) == "random:16:45" and set(found.values()) == {""}
    assert secrets.redact(rows[-1][1], "random:16:45") == "plain words and [secret] here"
    assert secrets.scan(odd).count() == len(ODD) and secrets.scan(odd.limit(0)).count() == 0


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_pii(t):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


def test_personal_data(spark, odd):
    rng = random.Random(3)
    bits = ["a", "b.", ".", "@", "x.com", "-", "1", "23", "256", ".9", " ", "+", "(", ")", "é", "\U0001f600", "", "4111111111111111", "+1 (974) 555-3436", "a@b.co", "_", "%", "\n"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 25)))) for i in range(600)] + [(2000, "1." * 30_000), (2001, "x@" + "a." * 20_000 + "b"), (2002, None)]
    found = {r["doc_id"]: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        base = base_pii(t or "")
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert found[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), t
        assert [found[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[1] == k for b in base) for k in range(4)]
    assert pii.find(odd).count() == len(ODD) and pii.find(odd.limit(0)).count() == 0


def test_personal_data_beyond_the_base_patterns(spark):
    """Recall and precision of the spans that the method adds, on labelled documents."""
    rng = random.Random(31)
    name = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 9)))
    number = lambda sep: f"{rng.randint(200, 999)}{sep}{rng.randint(200, 999)}{sep}{rng.randint(1000, 9999)}"
    rows, want = [], {}
    for i in range(900):
        kind = i % 9
        before, value, after, personal = [
            ("Write an email to ", f"{name()} (at) {name()} (dot) {rng.choice(['com', 'org', 'de', 'fr', 'se'])}", ", please.", True),
            ("Contact: ", f"{name()}[at]{name()}.{rng.choice(['com', 'net', 'br'])}", " or us.", True),
            ("Call ", number("-"), " now.", True),
            ("phone: (212) ", number("-")[4:], " at night.", True),
            ("see part ", number("."), "x of it.", False),
            ("the invoice ", number("-"), " is open.", False),
            ("mail ", f"{name()}@{name()}.com", " for it.", None),
            ("call ", f"+1 ({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}", " for it.", None),
            ("as said ", f"{name()} [at] {name()}.{rng.choice(['zzz', 'qqx', 'noneof'])}", "3 there.", False),
        ][kind]
        rows.append((i, f"{name()} {before}{value}{after} {name()}."))
        if personal is not None:
            want[i] = personal
    found = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hits = {i for i in want if found[i]}
    true = {i for i, personal in want.items() if personal}
    assert len(hits & true) >= 0.9 * len(true) and len(hits - true) <= 0.05 * len(hits)


def test_many_matches_in_one_text(spark):
    text = "1.2.3.4 a@b.co " * 5_000
    found = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]
    assert (found["n_ip"], found["n_email"]) == (5_000, 5_000)
    assert secrets.scan(spark.createDataFrame([(1, "token=abcdef " * 20_000)], "doc_id long, text string")).collect()[0]["n_assign"] == 20_000


#: Words of identifiers that the models are not trained on.
HELD_OUT = (
    "abstract account address agent amount anchor animation argument asset attribute author balance binding block border branch browser cache calendar callback camera channel chart child cluster "
    "command comment component connection constant container content context controller counter country currency cursor customer decimal delegate dependency device dialog digest directory"
).split()


def test_secret_models_on_held_out_samples(spark):
    """Recall on keys of each alphabet, and false alarms on identifiers of words held out."""
    rng = random.Random(77)
    ratio = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    hit = lambda word: bool(secrets.random_spans(word, [], ratio, 10.0, 0.45, 0.8))
    for letters in secrets.ALPHABETS:
        assert sum(hit("".join(rng.choices(letters, k=rng.randint(20, 40)))) for _ in range(300)) >= 0.95 * 300, letters
    words = [secrets.identifier(rng.choices(HELD_OUT, k=rng.randint(2, 4)), k % secrets.STYLES) for k in range(1600)]
    words = [w for w in words if len(w) >= 16]
    assert len(words) > 800 and sum(map(hit, words)) <= 0.03 * len(words)
    assert not any(map(hit, ["getElementByIdAndClassName", "XMLHttpRequestFactory", "/usr/local/lib/python3", "COVID19VaccinationProgram", "4111111111111111", "2024-01-31T12-30-00Z"]))


def test_rules_agree_with_brute_force(spark, odd):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices(["a ", "b ", "c ", "#", "\n", "a b c ", "\t", "é"], k=40))) for i in range(150)]
    for r in quality.features(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        t = rows[r["doc_id"]][1]
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), t.count("#"), len(lines) - len(set(lines)), len(covered))
    assert quality.judge(odd).count() == len(ODD) and quality.judge(odd.limit(0)).count() == 0


def test_quality_separates_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    joined = quality.judge(docs).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("NOT base_failed")
    counts = {(r["quality"], r["kept"]): r["count"] for r in joined.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) <= 0.01 * counts[1, True] and counts.get((0, True), 0) <= 0.05 * counts[0, False]
    # unlike a filter in which all rules must pass, documents with a bad vote stay, and good ones are among them
    votes = quality.keep(quality._voted(quality.features(docs)), "votes").withColumn("digits", F.conv("pattern", 10, 3)).withColumn("bad", F.lpad("digits", len(quality.rules()), "0").contains("0"))
    assert joined.join(votes.select("doc_id", "bad"), "doc_id").where("bad AND kept AND quality = 1").count() > 0
    kept = quality.accepted(docs)
    assert kept.columns == docs.columns and kept.count() == quality.judge(docs).where("kept").count()


def test_posteriors_follow_plain_em(spark):
    patterns = {0: 30, 4: 50, 8: 90, 2: 5, 6: 3}
    got = {r["pattern"]: r["posterior"] for r in weak_supervision.posteriors(spark.createDataFrame(list(patterns.items()), "pattern long, n long"), 2, rounds=7).collect()}
    yes0, no0 = (0.02, 0.48, 0.5), (0.35, 0.6, 0.05)
    prior, yes, no = 0.8, [yes0, yes0], [no0, no0]
    votes = {p: (p % 3, p // 3) for p in patterns}
    post = lambda p: prior * yes[0][votes[p][0]] * yes[1][votes[p][1]] / (prior * yes[0][votes[p][0]] * yes[1][votes[p][1]] + (1 - prior) * no[0][votes[p][0]] * no[1][votes[p][1]])
    for _ in range(7):
        w = {p: n * post(p) for p, n in patterns.items()}
        total, good = sum(patterns.values()), sum(w.values())
        yes, no = (
            [tuple((2 * start[v] + sum(x[p] for p in patterns if votes[p][j] == v)) / (2 + sum(x.values())) for v in range(3)) for j in range(2)]
            for start, x in ((yes0, w), (no0, {p: patterns[p] - w[p] for p in patterns}))
        )
        prior = (1 + good) / (2 + total)
    assert all(abs(got[p] - post(p)) < 1e-9 for p in patterns)


def test_pages(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>"
        "<div class='cookie-notice'>We use cookies, a lot of them, everywhere.</div><article><h1>Head &amp; line</h1><p>First, a sentence.<p>Second <b>bold</b>\n text, here.</article>"
        "<div id=comments><p>Nice post, really nice, thank you.</p></div><form>Name <input></form><footer>&copy; x</footer>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (None, "u", "plain, text"), (5, "u", "<p>a<p>b<"), (6, "u", "<div>" * 3000 + "deep, text." + "</div>" * 3000), (6, "u", "<")]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))).collect()
    assert found[0]["text"] == "Head & line\n\nFirst, a sentence.\n\nSecond bold text, here."
    assert [r["text"] for r in found[1:]] == ["", "", "plain, text", "a\n\nb<", "deep, text.", "<"]
    assert all(r["n_chars"] == len(r["text"]) for r in found)


LONG = " ".join(["A sentence of the article, of some length, with marks."] * 12)
AROUND = "<html><body><nav><a>Home</a></nav>{}<footer>End, of page.</footer></body></html>"


@pytest.mark.parametrize(
    ("markup", "parts"),
    [
        (f"<article><h1>Head</h1><p>The lead, short.</p><div><p>{LONG}</p><p>{LONG}</p></div></article>", ["Head", "The lead, short.", LONG, LONG]),
        (f"<div><p>Before, this.</p><ul><li>{LONG}</li><li>{LONG}</li></ul></div>", ["Before, this.", LONG, LONG]),
        (f"<div><h1>Head</h1><p>Intro.</p><section><p>{LONG}</p></section></div>", ["Head", "Intro.", LONG]),
        (f"<div><p>Intro.</p><table><tr><td>{LONG}</td></tr></table><p>After, that.</p></div>", ["Intro.", LONG, "After, that."]),
        (f"<div><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{LONG}</p></div></div>", [LONG] * 6),
        (f"<main><article><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article><article><p>{LONG}</p></article></main>", [LONG] * 6),
        (f"<div><p>{LONG[:200]}</p></div><article><h1>Head</h1><p>{LONG}</p><p>{LONG}</p></article>", ["Head", LONG, LONG]),
        (f"<div><a>One</a></div><div><h1>Head</h1><div><p>{LONG}</p></div></div>", ["Head", LONG]),
    ],
)
def test_articles_with_nested_containers_are_whole(markup, parts):
    assert html_text.main_text(AROUND.format(markup)).split("\n\n") == parts


@pytest.mark.parametrize(
    ("markup", "parts"),
    [
        # boilerplate that no name or tag gives away
        (f"<div>Read more of our offers</div><div><h1>Head</h1><p>{LONG}</p><p>Short, this.</p><p>{LONG}</p></div><div>All of it at half the price</div>", ["Head", LONG, "Short, this.", LONG]),
        (f"<ul><li><a href=a>First of them</a><li><a href=b>Second of them</a></ul><div><p>{LONG}</p><p>{LONG}</p></div>", [LONG, LONG]),
        (f"<div><p>{LONG}</p><p>{LONG}</p><ul><li><a href=x>Another page to see</a><li><a href=x>And one more page</a><li><a href=x>The last of the pages</a></ul></div>", [LONG, LONG]),
        # names are weights only
        (f'<div class="content has-sidebar"><p>{LONG}</p><p>{LONG}</p></div>', [LONG, LONG]),
        (f'<div id="page" class="layout right-sidebar"><article><h1>H</h1><p>{LONG}</p></article></div>', ["H", LONG]),
        (f'<div id="page" class="layout right-sidebar"><h1>H</h1><p>{LONG}</p><div class="sidebar"><p>Elsewhere, this.</p></div></div>', ["H", LONG]),
        (f"<article><h1>H</h1><p>{LONG}</p><section class=comments><article><p>{LONG}</p></article><article><p>Nice.</p></article></section></article>", ["H", LONG]),
        # a short article against a long notice
        ("<div class=ad>A long notice of many words, with commas, and stops. And more of it, and more.</div><article><h1>Tiny</h1><p>A text.</p></article>", ["Tiny", "A text."]),
        # nothing else is cut
        (f"<article><p>{LONG}</p><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> and <svg><text>two</text></svg>.</p><p><select><option>One<option>Two</select></p></article>", [LONG, "Let x=2 and two.", "One", "Two"]),
        (f"<article><p>{LONG}</p><textarea>a &lt; b</textarea><object>shown <b>here</b></object></article>", [LONG, "a < bshown here"]),
        (f"<article><p>{LONG}</p><p>a &am<b>p;</b> &amp;lt; b<span hidden>no <span>no</span> no</span>, c</p></article>", [LONG, "a &amp; &lt; b, c".replace("&amp;", "&amp;"[:3] + "p;")]),
    ],
)
def test_path_scores_select_the_nodes(markup, parts):
    assert html_text.main_text(AROUND.format(markup)).split("\n\n") == parts


def test_path_scores_equal_plain_ones(spark):
    """Scores by the formula, from the paths as lists of elements, without shared sums."""
    for (page,) in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").limit(20).collect():
        found = html_text.blocks(page)
        html_text.weigh(found)
        chains = [[id(e) for e in html_text._upwards(b.element)][::-1] for b in found]
        names = [tuple(e.tag + "!" * (e.weight < 1) for e in html_text._upwards(b.element)) for b in found]

        def mean(values, name):
            own = [v for v, n in zip(values, names, strict=True) if n == name]
            return sum(own) / len(own)

        chars, marks = [len(b.text) - 0.9 * b.linked for b in found], [len(re.findall("[.,;:!?]", b.text)) for b in found]
        x, y = [mean(chars, n) for n in names], [mean(marks, n) + 1 / names.count(n) for n in names]
        nodes = []
        for i in range(len(found)):
            kernel = {}
            for j in range(max(0, i - 2), min(len(found), i + 3)):
                shared = sum(a == b for a, b in zip(chains[i], chains[j]))
                kernel[j] = np.exp(-((i - j) ** 2) / 2) * 0.5 ** max(0, len(chains[i]) + len(chains[j]) - 2 * shared - 2)
            u, v = (sum(k * s[j] for j, k in kernel.items()) / sum(kernel.values()) for s in (x, y))
            nodes.append(found[i].element.weight * (x[i] * u * y[i] * v) ** 0.25)
        score = [mean(nodes, n) for n in names]
        weights = [c * b.element.weight for c, b in zip(chars, found, strict=True)]
        level = sum(s * w for s, w in zip(score, weights, strict=True)) / sum(weights)
        got = html_text.path_scores(found)
        assert np.allclose([got[b.element.path] for b in found], [s / level for s in score])


def test_pages_give_their_articles(spark):
    """On whole table ``pages``: the blocks of the article element, and without help from names or from article tags nearly so."""
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    alone = 0
    for page in pages:
        article = re.search("<article>.*</article>", page, re.DOTALL)
        want = "\n\n".join(b.text for b in html_text.blocks(article[0] if article else page))
        found = html_text.blocks(page)
        assert html_text.main_text(page) == want and want != "\n\n".join(b.text for b in found)
        html_text.weigh(found, named=1.0, article=1.0)
        alone += "\n\n".join(b.text for b in html_text.select(found)) == want
    assert alone >= 0.7 * len(pages)


def test_secrets_of_unseen_shapes(spark):
    """Names, stamps and identifiers of shapes that the training doesn't make, and keys of a generator of its own."""
    import base64
    import uuid

    rng = random.Random(77)
    ratio = secrets.train(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    hit = lambda word: bool(secrets.random_spans(word, [], ratio, 10.0, 0.45, 0.8))
    quiet = ["sha512-x86_64-linux-gnu", "aarch64-unknown-linux-gnu", "A" * 20, "x" * 20, "abab" * 6, "=" * 30, "-" * 40, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnop", "2024-01-31T10-20-30Z", "v1_2_3-beta4_build567", "0123456789abcdef0123"]
    quiet += [str(uuid.UUID(int=rng.getrandbits(128))) for _ in range(40)] + [str(uuid.UUID(int=rng.getrandbits(128))).upper() for _ in range(40)]
    assert [w for w in quiet if hit(w)] == []
    raw = [rng.randbytes(rng.randint(18, 40)) for _ in range(300)]
    keys = [base64.b64encode(r).decode() for r in raw] + [base64.urlsafe_b64encode(r).decode() for r in raw] + [base64.b32encode(r).decode() for r in raw] + ["sk_live_" + r.hex().upper() for r in raw]
    assert sum(map(hit, keys)) >= 0.95 * len(keys)


COMMENT = "<div class=c><p>I think, for one, that number {} is great.</p></div>"


@pytest.mark.parametrize(
    ("markup", "parts"),
    [
        (f"<article><h1>T</h1><p>{LONG}</p><table class='widget'><tr><td>One cell, of it</td></tr></table><figure class='banner'><p>A figure, too.</p></figure></article>", ["T", LONG, "One cell, of it", "A figure, too."]),
        (f"<article><h1>T</h1><p>{LONG}</p><div class='alert'><p>A notice, of the site.</p></div></article>", ["T", LONG]),
        (f"<article><h1>T</h1><p>{LONG}</p><section class='discussion'><h2>Discussion</h2>{''.join(COMMENT.format(k) for k in range(15))}</section></article>", ["T", LONG]),
        (f"<article><h1>T</h1><p>{LONG}</p><section id='discussion'><h2>Discussion</h2><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></section></article>", ["T", LONG, "Discussion", LONG, LONG, LONG]),
        (f"<article><h1>T</h1><p>{LONG}</p><section>{''.join(f'<div><span class=author>U{k}</span><p>I think so, too, and {k}.</p></div>' for k in range(4))}</section></article>", ["T", LONG]),
        (f"<article><h1>T</h1><p>{LONG}</p><p>Press <button>OK</button> to go on.</p><p><button>Subscribe</button></p></article>", ["T", LONG, "Press OK to go on."]),
        (f"<div><h1>T</h1><p>{LONG}</p><p>Second, short.</p></div><div><p>About this site, and who makes it.</p><p>Copyright 2020 X, all rights reserved.</p></div>", ["T", LONG, "Second, short."]),
        ("<div><h1>T</h1><p>One line, of it.</p><p>Another line, of it.</p></div><div><p>Copyright 2020 by the owner of this site, and of others, of which there are many; all rights reserved, here and there.</p></div>", ["T", "One line, of it.", "Another line, of it."]),
        (f"<article><h1>T</h1><p>{LONG}</p><p>Copyright is a right, of authors.</p></article>", ["T", LONG, "Copyright is a right, of authors."]),
    ],
)
def test_what_belongs_to_an_article(markup, parts):
    assert html_text.main_text(AROUND.format(markup)).split("\n\n") == parts


def plain_select(found):
    """``select`` with the container and what lies in it found by climbing from each block."""
    scores = html_text.path_scores(found)
    strong = [b for b in found if scores[b.element.path] >= html_text.STRONG]
    up = lambda b: list(html_text._upwards(b.element))
    holds = lambda e: [b for b in found if any(x is e for x in up(b))]
    whole = next(e for e in up(strong[0]) if all(any(x is e for x in up(b)) for b in strong) and e.tag not in html_text.PARTS)
    articles = [e for e in html_text._upwards(whole) if e.tag in ("article", "main")]
    if articles:
        whole = articles[-1]
    elif whole.tag not in ("body", "html", "#root") and not any(e.tag == "h1" for b in holds(whole) for e in up(b)):
        whole = next((e for e in html_text._upwards(whole) if holds(e)[0].element.tag == "h1"), whole)
    at = [k for k, b in enumerate(found) if b in strong]
    lead = at[0]
    loose = whole.tag in ("body", "html", "#root")
    while loose and lead > 0 and found[lead - 1].element.tag in html_text.HEADINGS:
        lead -= 1
    full = lambda e: e.tag in ("article", "main") and any(b in strong for b in holds(e))
    out = []
    for k, b in enumerate(found):
        inside = scores[b.element.path] >= html_text.WEAK and any(e is whole for e in up(b))
        if b in strong or inside and (not loose or lead <= k <= at[-1] or any(full(e) for e in up(b))):
            out.append(b.text)
    return out


def test_selection_equals_a_plain_one(spark):
    rng = random.Random(3)
    pages = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").limit(15).collect()]
    tags = ["div", "section", "article", "ul", "main", "div class=widget", "h1", "p", "p", "p", "h2", "li"]

    def tree(depth):
        tag = rng.choice(tags)
        text = "Some words, of a text. " * rng.choice((1, 1, 5, 20)) if rng.random() < 0.6 else ""
        inner = "".join(tree(depth - 1) for _ in range(rng.randint(0, 4))) if depth and tag.split()[0] not in ("p", "h1", "h2") else text or "x"
        return f"<{tag}>{text}{inner}</{tag.split()[0]}>"

    for page in pages + [f"<html><body>{''.join(tree(4) for _ in range(3))}</body></html>" for _ in range(150)]:
        found = html_text.blocks(page)
        html_text.weigh(found)
        if found:
            assert [b.text for b in html_text.select(found)] == plain_select(found)


def test_deep_pages_take_time_in_proportion():
    import time

    spent = []
    for n in (1000, 4000):
        began = time.process_time()
        html_text.main_text("<div>a, b." * n + "</div>c, d." * n)
        spent.append(time.process_time() - began)
    assert spent[1] < 10 * spent[0] + 0.5


def test_broken_markup_takes_time_in_proportion():
    for bit in ("<noscript>a", "<textarea>", "<div>a", "<b hidden>a", "<a", "</p>x", "<p>x", "<li>y", "<template>z"):
        assert isinstance(html_text.main_text(bit * 3_000), str)

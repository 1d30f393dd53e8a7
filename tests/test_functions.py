from __future__ import annotations

import math
import re
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import casts, ids, similarity, text


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_normalize_arabic(spark):
    rows = [("أَبُو هُريرة",), ("  a ـb c ",), (None,)]
    assert one(spark, rows, "t string", text.normalize_arabic(F.col("t"))) == [("ابو هريره",), ("a b c",), (None,)]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",)), max_size=30), min_size=1, max_size=40))
def test_normalization_is_idempotent(spark, texts):
    once = text.normalize_arabic(F.col("t"))
    rows = one(spark, [(t.replace("\0", ""),) for t in texts], "t string", once, text.normalize_arabic(once))
    assert all(a == b for a, b in rows)


def test_match_spans_and_phrases(spark):
    t = "\U0001f600 حدثنا محمد عن علي"
    (spans,) = one(spark, [(t,)], "t string", text.transmission_phrases(F.col("t")))
    assert [(s["start"], s["end"], s["label"]) for s in spans[0]] == [(t.index("حدثنا"), t.index("حدثنا") + 5, "haddathana"), (t.index(" عن ") + 1, t.index(" عن ") + 3, "an")]


def test_tags_html_and_names(spark):
    row = "<SANAD><NAR>A</NAR> from <NAR>B</NAR></SANAD><MATN> m </MATN>"
    out = one(spark, [(row,)], "t string", text.tag_body(F.col("t"), "MATN"), text.tag_bodies(F.col("t"), "NAR"), text.between_tags(text.tag_body(F.col("t"), "SANAD"), "NAR"))
    assert out == [("m", ["A", "B"], ["", "from"])]
    assert one(spark, [("<b>x</b>&nbsp;",), ("<i></i>",), (" A. (),",), ("...",)], "t string", text.strip_html(F.col("t")), text.clean_name(F.col("t")))[1][0] is None
    assert one(spark, [(" A b.!",), ("...",)], "t string", text.clean_name(F.col("t"))) == [("A b",), (None,)]


def test_grades_and_sects(spark):
    rows = [("Sahih li ghayrihi",), ("Da'if (weak)",), ("صحيح",), ("حَسَن",), ("",), (None,), ("other",)]
    assert [r[0] for r in one(spark, rows, "t string", text.normalize_grade(F.col("t")))] == ["sahih_li_ghayrihi", "daif", "sahih", "hasan", "unknown", "unknown", "unknown"]
    assert [r[0] for r in one(spark, [("eng-alkafi",), ("eng-bukhari",)], "t string", text.detect_sect(F.col("t")))] == ["shia", "sunni"]


def test_safe_casts(spark):
    rows = [(" 12.9 ",), ("-3",), ("x",), ("",), ("inf",), ("99999999999",), (None,)]
    assert [r[0] for r in one(spark, rows, "t string", casts.safe_int(F.col("t")))] == [12, -3, None, None, None, None, None]
    assert [r[0] for r in one(spark, [(" NaN ",), ("None",), (" a ",)], "t string", casts.safe_str(F.col("t")))] == [None, None, "a"]
    assert one(spark, [([None, "x"],), (["a", "b"],), ([],)], "t array<string>", casts.json_or_scalar(F.col("t"))) == [("x",), ('["a","b"]',), (None,)]


def test_ids(spark):
    rows = [("sunnah:sunnah:bukhari:1",), ("hdt:lk:a:1",), ("x:x:1",)]
    assert [r[0] for r in one(spark, rows, "t string", ids.hadith_id(F.col("t")))] == ["hdt:sunnah:bukhari:1", "hdt:lk:a:1", "hdt:x:x:1"]
    names = ["ابو هريره", "", "Supplier#1"]
    want = [f"nar:{uuid.uuid5(uuid.UUID(ids.NAMESPACE), n)}" for n in names]
    assert [r[0] for r in one(spark, [(n,) for n in names], "t string", ids.canonical_id(F.col("t")))] == want
    assert want[0] == "nar:18238b22-abe0-59d6-b054-22f92fd313a7"
    problems = one(spark, [("lk:b:1",), ("q",), ("lk:lk::1",), ("",)], "t string", ids.source_id_problems(F.col("t")))
    assert [len(p[0]) for p in problems] == [0, 2, 2, 1]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b, 1):
            row[j] = old[j - 1] + 1 if x == y else max(old[j], row[j - 1])
    return row[-1]


def test_similarity(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("a", ""), ("", "b"), ("ابو", "ابي"), ("abcdef", "azced")]
    got = one(spark, pairs, "a string, b string", similarity.indel_ratio(F.col("a"), F.col("b")), similarity.ratio_bound(F.col("a"), F.col("b")))
    for (a, b), (ratio, bound) in zip(pairs, got, strict=True):
        want = 100.0 if not a + b else 200 * _lcs(a, b) / (len(a) + len(b))
        assert math.isclose(ratio, want) and (bound >= ratio or not a + b)
    assert [r[0] for r in one(spark, [(0.9,), (0.89,), (0.8,), (0.79,)], "s double", similarity.tier(F.col("s")))] == ["verbatim", "close_paraphrase", "close_paraphrase", "thematic"]
    cross = one(spark, [("sunnah", "thaqalayn"), ("sunnah", "lk"), ("muhaddithat", "thaqalayn")], "a string, b string", similarity.cross_sect(F.col("a"), F.col("b")))
    assert [r[0] for r in cross] == [True, False, False]
    assert one(spark, [(93, 59), (60, 59)], "a int, b int", similarity.plausible_gap(F.col("a"), F.col("b"))) == [(True,), (False,)]
    assert one(spark, [(10,)], "y int", *similarity.year_window(F.col("y"))) == [(1, 40)]


def test_whitespace_is_unicode(spark):
    assert re.sub(r"\s+", " ", "a \x1cb") == "a b"
    assert one(spark, [("a \x1cb",)], "t string", text.clean_whitespace(F.col("t"))) == [("a b",)]


def test_batched_ratio_equals_the_fold(spark):
    import random

    rng = random.Random(3)
    words = ["".join(rng.choices("abcé ", k=rng.randint(0, 12))) for _ in range(60)]
    pairs = spark.createDataFrame([(a, b) for a in words[:20] for b in words[20:]], "a string, b string")
    both = pairs.select(similarity.indel_ratio(F.col("a"), F.col("b")).alias("x"), similarity.indel_ratio_batched(F.col("a"), F.col("b")).alias("y"))
    assert both.where("abs(x - y) > 1e-9").isEmpty()


def test_many_matches_in_one_text(spark):
    spans = spark.createDataFrame([("ab " * 3000,)], "t string").select(F.explode(text.match_spans(F.col("t"), "ab")).alias("m")).select("m.*").collect()
    assert [(r["start"], r["end"]) for r in spans] == [(3 * k, 3 * k + 2) for k in range(3000)]

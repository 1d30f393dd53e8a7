from __future__ import annotations

import json
from collections import defaultdict

from strandline.operators import graph
from strandline.plans import catalog


def stored(spark, folder, **tables):
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


NATIONS = [(0, "FRANCE"), (1, "GERMANY"), (2, "PERU"), (3, "CHINA")]


def resolved(lines):
    """People by plain loops: a name that ends in X is a fuzzy match, which the year of the member before may rule out."""
    years, names = {n: 20 * k + 40 for k, n in NATIONS}, [n for _, n in NATIONS]
    chains_, people = defaultdict(list), {}
    for order, line, supplier in sorted(lines):
        chains_[order].append((line, names[supplier % 4]))
    for order in sorted(chains_):
        before = None
        for line, name in chains_[order]:
            near = line % 3 == 0
            if near and before is not None and not 15 <= abs(years[name] - before) <= 80:
                before = None
                continue
            before = years[name]
            aliases, count = people.get(name, (set(), 0))
            people[name] = (aliases | ({f"{name}X"} if near and count else set()), count + 1)
    return {(name, len(aliases), 1, count) for name, (aliases, count) in people.items()}


def test_disambiguate_full_resolves_every_chain(spark, tmp_path):
    lines = [(o, k, (o * 7 + k * k * 5) % 8) for o in range(1, 30) for k in range(1, 2 + o % 6)]
    at = stored(
        spark, tmp_path,
        nation=(NATIONS, "n_nationkey int, n_name string"),
        supplier=([(s, s % 4) for s in range(8)], "s_suppkey long, s_nationkey int"),
        lineitem=([(o, k, s, 1, "1995-01-01", 1.0) for o, k, s in lines], "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_shipdate string, l_extendedprice double"),
    )
    found = catalog.disambiguate_full(spark, at).collect()
    assert {(r["name_ar"], r["n_aliases"], r["n_sources"], r["mention_count"]) for r in found} == resolved(lines)


LINES = "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_shipdate string, l_extendedprice double"


def test_chain_integrity_finds_long_cycles_of_the_whole_graph(spark, tmp_path):
    around = [3, 45, 7, 92, 11, 300, 5, 41]
    pairs = list(zip(around, around[1:] + around[:1], strict=True)) + [(41, 1000), (1000, 2000)]
    lines = [(o, k + 1, s, 1, "1995-01-01", 1.0) for o, pair in enumerate(pairs) for k, s in enumerate(pair)]
    found = catalog.chain_integrity(spark, stored(spark, tmp_path, lineitem=(lines, LINES))).collect()
    assert [(r["id"], r["length"]) for r in found] == [(s, 8) for s in sorted(around)]


def test_cycles_stop_at_the_limit_without_a_loss(spark):
    edges = spark.createDataFrame([(a, b) for a in range(3) for b in range(3) if a != b], "src_id int, dst_id int")
    every = sorted((r["length"], r["start"], r["trail"]) for r in graph.cycles(edges, limit=None).collect())
    assert len(every) > 20
    for limit in (1, 6, 7, 20, len(every) + 1):
        assert [(r["length"], r["start"], r["trail"]) for r in graph.cycles(edges, limit=limit).collect()] == every[:limit]


def test_fan_out_reads_chains_to_their_end(spark, tmp_path):
    text = "Narrated by " + "Abd al-Rahman ibn " * 8 + "Awf from Umar ibn al-Khattab from Abu Hurairah"
    assert text.index("Awf") > 120
    at = stored(spark, tmp_path, conversations=([(1, 0, "user", text)], "conv_id long, turn int, role string, text string"))
    nodes, edges = catalog.fan_out_nodes(spark, at).collect(), catalog.fan_out_edges(spark, at).collect()
    names = {json.loads(r["props"])["name_en"] for r in nodes if r["label"] == "Narrator"}
    assert names == {"by " + "Abd al-Rahman ibn " * 8 + "Awf", "Umar ibn al-Khattab", "Abu Hurairah"}
    assert sorted(json.loads(r["props"])["position_in_chain"] for r in edges if r["label"] == "TRANSMITTED_TO") == [0, 1]


def test_every_english_text_gives_names(spark, tmp_path):
    rows = [(1, "en", "A from B."), (2, "en", "Narrated Umar, reported by Zayd"), (3, "en", "Malik on the authority of Nafi"), (4, "en", "Only one"), (5, "en", " "), (6, "en", None), (7, "fr", "X from Y")]
    found = catalog.en_chain_extract(spark, stored(spark, tmp_path, documents=(rows, "doc_id long, lang string, text string"))).collect()
    assert sorted(map(tuple, found)) == [(1, 0, "A"), (1, 1, "B"), (2, 1, "Umar"), (2, 2, "Zayd"), (3, 0, "Malik"), (3, 1, "Nafi"), (4, 0, "Only one")]

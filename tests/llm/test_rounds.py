"""Rounds of the n-gram Jaccard join, and components by contraction and in one task."""

import random

import pytest

from commentscope.llm import components, jaccard


def brute_components(links):
    group = {n: n for link in links for n in link}
    for a, b in links:
        old, new = max(group[a], group[b]), min(group[a], group[b])
        group = {n: new if g == old else g for n, g in group.items()}
    return group


@pytest.mark.parametrize("few", [0, 7, 1 << 16])
def test_components_by_either_way(spark, few):
    draw = random.Random(few)
    links = [(f"n{draw.randrange(60)}", f"n{draw.randrange(60)}") for _ in range(45)]
    links += [(f"c{k}", f"c{k + 1}") for k in range(20)] + links[:5]
    df = spark.createDataFrame(links, "a string, b string")
    got = {r["node"]: r["component"] for r in components.connected_components(df, few=few).collect()}
    wanted = brute_components([(a, b) for a, b in links if a != b])
    assert set(got) == set(wanted)
    assert len(set(zip(got.values(), (wanted[n] for n in got)))) == len(set(wanted.values())) == len(set(got.values()))


def test_components_of_no_links(spark):
    none = spark.createDataFrame([], "a string, b string")
    assert components.connected_components(none).count() == 0
    loops = spark.createDataFrame([("x", "x")], "a string, b string")
    assert components.connected_components(loops).count() == 0


def test_many_unlinked_nodes_of_a_group(spark, monkeypatch):
    """A passage that many texts share, most of them not similar enough, in many small rounds."""
    monkeypatch.setattr(jaccard, "ASKED", 3)
    monkeypatch.setattr(jaccard, "GROUP_ROWS", 4)
    draw = random.Random(1)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for k in range(40):
        # Tails of five words or more part texts from each other, shorter ones do not.
        tail = [f"t{k}-{i}" for i in range(draw.choice([2, 5, 9, 14]))]
        rows.append((k, " ".join(passage + tail)))
        if k % 8 == 0:
            rows.append((100 + k, " ".join(passage + tail[:-1])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicate_groups(df, frequent=2).collect()}

    def shingles(text):
        words = text.split()
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    sets = {k: shingles(t) for k, t in rows}
    links = [(a, b) for a in sets for b in sets if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert got == brute_components(links)
    assert len(set(got.values())) > 5


def test_nodes_travel_to_their_signatures_once(spark, tmp_path):
    kind = "node binary, text string, size bigint, sketch array<bigint>, signatures array<bigint>"
    rows = [(n, "t", 3, [0], s) for n, s in [(b"a", [1, 2, 5]), (b"b", [1, 2]), (b"b", [1, 2]), (b"c", [2, 3])]]
    spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/signed")
    signed = spark.read.schema(kind).parquet(f"{tmp_path}/signed")
    fixed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in fixed}
    try:
        for name, value in fixed.items():
            spark.conf.set(name, value)
        groups = jaccard._groups(signed)
        plan = groups._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    own = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert sum("REPARTITION_BY_COL" in line for line in own) == 1
    assert sum("hashpartitioning(node#" in line for line in own) == 1
    found = sorted((r.sign, bytes(r.leader), bytes(r.node), r["size"]) for r in groups.collect())
    assert found == [(1, b"a", b"b", 3), (2, b"a", b"b", 3), (2, b"a", b"c", 3)]

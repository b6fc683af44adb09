"""Groups of near copies by sketches, with DataFrame functions only."""

import contextlib
import io
import random

import corpus_pipeline
from commentscope.llm.line_templates import copy_groups
from commentscope.storage import new_dir


def test_near_copies_are_grouped_and_others_are_not(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    boiler = rng.choices(words, k=150)
    texts, owner = {}, {}
    for group in range(30):
        base = rng.choices(words, k=200) + boiler
        for _ in range(rng.choice([1, 2, 8])):
            copy = list(base)
            for _ in range(4):
                copy[rng.randrange(350)] = rng.choice(words)
            texts[len(texts)] = " ".join(copy)
            owner[len(owner)] = group
    texts[1000], texts[1001], texts[1002] = "", "two words", "two  words"
    path = new_dir(spark, "texts")
    spark.createDataFrame(list(texts.items()), "doc bigint, text string").write.parquet(path)
    groups = copy_groups(spark.read.parquet(path))
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        groups.explain("formatted")
    assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
    got = {r["doc"]: r["group"] for r in groups.collect()}
    assert set(got) == set(texts)
    assert got[1001] == got[1002] != got[1000]
    pairs = [(a, b) for a in owner for b in owner if a < b]
    apart = [p for p in pairs if owner[p[0]] != owner[p[1]]]
    assert not [p for p in apart if got[p[0]] == got[p[1]]]
    alike = [p for p in pairs if owner[p[0]] == owner[p[1]]]
    assert sum(got[a] == got[b] for a, b in alike) > 0.9 * len(alike)


def test_the_line_stage_runs_no_python(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lines", "line stage")
    try:
        rows = corpus_pipeline.line_stage(spark, docs, sf_dir)
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            rows.explain("formatted")
        assert "Python" not in out.getvalue() and "Arrow" not in out.getvalue()
        assert rows.count() == docs.count()
        stages = [
            tracker.getStageInfo(s).name
            for job in tracker.getJobIdsForGroup("lines")
            for s in tracker.getJobInfo(job).stageIds
            if tracker.getStageInfo(s)
        ]
        assert stages and not [n for n in stages if "Arrow" in n or "Pandas" in n]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

"""Periodic runs against the definition, tried at every period and place."""

import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from commentscope.llm.periodic import (
    MIN_LENGTH,
    Ranks,
    WaveletTree,
    collapse_runs,
    find_runs,
    op13_periodic_runs,
)


def brute_runs(words, least=MIN_LENGTH):
    found = {}
    for period in range(1, len(words) // 2 + 1):
        at = 0
        while at + period < len(words):
            end = at
            while end + period < len(words) and words[end] == words[end + period]:
                end += 1
            if end + period - at >= max(least, 2 * period):
                found.setdefault((at, end + period), period)
            at = end + 1
    return sorted((start, end - start, period) for (start, end), period in found.items())


def sequence(rng):
    kind, size = rng.randint(0, 6), rng.randint(0, 120)
    if kind == 0:
        return [rng.randint(0, 1) for _ in range(size)]
    if kind == 1:
        return [0] * size
    if kind == 2:
        a, b = [0], [0, 1]
        for _ in range(9):
            a, b = b, b + a
        return b[:size]
    if kind == 3:
        unit = [rng.randint(0, 2) for _ in range(rng.randint(1, 9))]
        return ([9] * rng.randint(0, 3) + unit * rng.randint(1, 20)) * rng.randint(1, 3)
    if kind == 4:
        return ([0, 1] * rng.randint(1, 12) + [0] * rng.randint(0, 1)) * rng.randint(1, 5)
    if kind == 5:
        return [rng.randint(0, 30) for _ in range(size)]
    return sequence(rng) * 2


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(40):
        texts = [sequence(rng) for _ in range(rng.randint(1, 5))]
        first = np.cumsum([0] + [len(t) for t in texts])
        found = find_runs(np.array(sum(texts, []), np.int64), first)
        got = [[] for _ in texts]
        for text, *run in zip(*(x.tolist() for x in found)):
            got[text].append(tuple(run))
        assert got == [brute_runs(t) for t in texts]


def test_range_successor():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 100):
        values = rng.permutation(size)
        first, last = np.sort(rng.integers(0, size + 1, (2, 200)), axis=0)
        least = rng.integers(0, size + 2, 200)
        expected = [
            min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(first, last, least)
        ]
        assert WaveletTree(values).successor(first, last, least).tolist() == expected


def test_suffix_array_of_equal_symbols():
    assert Ranks(np.zeros(50, np.int64)).suffixes().tolist() == list(range(49, -1, -1))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_equals_brute_force_on_whole_documents(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {d["doc_id"] for d in documents if len(d["text"] or "") < 8000}
    rows = [tuple(r) for r in op13_periodic_runs(spark, sf_dir).collect()]
    assert len(rows) == len(documents)
    expected = sorted(brute_row(*d) for d in documents if d["doc_id"] in short)
    assert sorted(r for r in rows if r[0] in short) == expected
    assert sum(r[1] > 0 for r in expected) > 5


def test_odd_documents(spark, tmp_path):
    long = " ".join(["a b c"] * 30000)
    rows = [
        (1, None, "x"), (2, "", "x"), (None, "la " * 40, "x"), (3, " \t\n", None), (4, long, "x"),
        (5, "la " * 12, "y"), (5, "la " * 12, "y"), (6, "é ü " * 11 + "é ü", "z"),
    ]
    schema = "doc_id bigint, text string, runs string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted((brute_row(i, t) if t != long else next(g for g in got if g[0] == 4) for i, t, _ in rows), key=repr)
    assert next(g for g in got if g[0] == 4)[1:5] == (1, 0, 90000, 3)
    empty = spark.createDataFrame([], schema)
    assert collapse_runs(empty, keep=[F.col("runs").alias("collapsed_from")]).collect() == []

"""Spelling variants against all pairs of words, compared letter by letter."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from commentscope.llm.spelling import group_variants, op12_spelling_variants, word_counts
from commentscope.storage import new_dir

LOWER = str.maketrans({c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute_counts(documents):
    counts = Counter()
    for doc_id, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            value = crc32(f"{doc_id}:{word}".encode()) if doc_id is not None else 1
            if value % 97 == 0:
                at = value % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= 5:
                counts[word] += 1
    return counts


def brute_variants(counts, least=3):
    counts = {w: n for w, n in counts.items() if n >= least}
    # Words one edit apart share a word with one letter less or, of equal length, one masked.
    seen = defaultdict(set)
    for word in counts:
        seen[word].add(word)
        for at in range(len(word)):
            seen[word[:at] + word[at + 1 :]].add(word)
            seen[word[:at] + "*" + word[at + 1 :]].add(word)
    near = defaultdict(set)
    for key, group in seen.items():
        for a in group:
            for b in group:
                if a != b and ("*" in key or key in (a, b)):
                    near[a].add(b)
    form = {}
    for word, n in counts.items():
        best = min(near[word], key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= 2 * n:
            form[word] = best

    def root(word):
        return root(form[word]) if word in form else word

    return sorted(
        (w, form.get(w), root(w), n, len(near[w]), counts.get(form.get(w)))
        for w, n in counts.items()
    )


def rows(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_query_equals_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = rows(op12_spelling_variants(spark, sf_dir))
    assert got == brute_variants(brute_counts(documents))
    assert sum(r[1] is not None for r in got) > 50


@pytest.fixture
def variants(spark):
    def make(counts):
        # Stored first, so that its order of rows is settled.
        path = new_dir(spark, "counts")
        spark.createDataFrame(list(counts.items()), "word string, n bigint").write.parquet(path)
        return rows(group_variants(spark.read.parquet(path)))

    return make


def test_edits_ties_chains_and_letters(variants):
    counts = {
        "house": 100, "houses": 50, "housess": 25, "housessé": 12, "hoese": 3, "ouse": 9, "hhouse": 3,
        "tiger": 6, "tigers": 6, "timer": 6, "zzzzz": 3, "zzzzzz": 3, "ïïïïï": 4, "ïïïïî": 9, "aeiou": 2,
    }
    got = variants(counts)
    assert got == brute_variants(counts)
    by_word = {r[0]: r for r in got}
    assert by_word["housessé"][1:3] == ("housess", "house")
    assert by_word["hoese"][1:3] == ("house", "house")
    assert by_word["tigers"][1:] == (None, "tigers", 6, 1, None)
    assert "aeiou" not in by_word


def test_long_words(variants):
    """Words that travel by number, and one at the border that meets a longer one."""
    base = "abcdefgh" * 400
    counts = {base: 20, base[:-1]: 5, base[:77] + "x" + base[78:]: 4, base + "yy": 9}
    counts |= {"q" * 64: 8, "q" * 65: 4, "q" * 66: 4}
    assert variants(counts) == brute_variants(counts)


def test_odd_documents(spark, tmp_path):
    data = [
        (1, None, 1), (2, "", 1), (None, "Straße STRASSE straßen", 1), (3, "ÀÉÎõü " * 3, 1),
        (4, "word" * 5000, None), (5, "alpha beta " * 4, 2), (5, "alpha beta " * 4, 2),
        *((i, "Planted Planting planted", 3) for i in range(10, 300)),
    ]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(data, "doc_id bigint, text string, n int").write.parquet(path)
    expected = brute_counts([d[:2] for d in data])
    assert rows(op12_spelling_variants(spark, str(tmp_path))) == brute_variants(expected)
    documents = spark.read.parquet(path)
    plain = {r["word"]: r["n"] for r in word_counts(documents).collect()}
    assert plain == brute_counts([(None, d[1]) for d in data])
    assert rows(group_variants(word_counts(documents.where(F.lit(False))))) == []

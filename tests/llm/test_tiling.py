"""Benchmark decontamination against plain greedy string tiling, and in many blocks."""

import contextlib
import io
import re

from commentscope.llm import decontaminate
from commentscope.llm.common import table

SIZE = decontaminate.MIN_MATCH


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain_tiles(item, text):
    """Covered words and tiles: the longest unmarked matches are marked again and again."""
    item, text = list(item), list(text)
    covered = n_tiles = 0
    while True:
        matches, best = [], SIZE
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and item[i + k] is not None and item[i + k] == text[j + k]:
                    k += 1
                if k > best:
                    matches, best = [], k
                if k == best:
                    matches.append((i, j))
        for i, j in matches:
            if None not in item[i : i + best] and None not in text[j : j + best]:
                item[i : i + best] = text[j : j + best] = [None] * best
                covered, n_tiles = covered + best, n_tiles + 1
        if not matches:
            return covered, n_tiles


def plain_leaks(documents, benchmark):
    found = set()
    items = [(k, words_of(t)) for k, t in benchmark]
    grams = lambda words: {tuple(words[i : i + SIZE]) for i in range(len(words) - SIZE + 1)}
    items = [(k, w, grams(w)) for k, w in items if len(w) >= SIZE]
    for doc, text in documents:
        words = words_of(text)
        own = grams(words)
        for key, item, seeds in items:
            shared = own & seeds
            # Words in no shared seed are in no match.
            kept = [None] * len(words)
            for i in range(len(words) - SIZE + 1) if shared else ():
                if tuple(words[i : i + SIZE]) in shared:
                    kept[i : i + SIZE] = words[i : i + SIZE]
            kept = [w for w, before in zip(kept, [0] + kept) if w is not None or before is not None]
            if len(kept) >= 0.8 * len(item):
                covered, n_tiles = plain_tiles(item, kept)
                if covered >= 0.8 * len(item):
                    found.add((doc, key, len(item), covered, n_tiles))
    return found


def rows_of(marked):
    return {
        (r["doc_id"], x["item"], x["item_words"], x["covered"], x["tiles"])
        for r in marked.collect()
        for x in r["leaks"]
    }


def test_leaks_agree_with_plain_tiling(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    wanted = plain_leaks(documents.select("doc_id", "text").collect(), benchmark.select("item_id", "text").collect())
    assert wanted
    assert rows_of(decontaminate.mark_leaks(documents, benchmark, keep=["doc_id"])) == wanted


def test_one_step_in_python_however_many_blocks(spark, sf_dir):
    documents, benchmark = table(spark, sf_dir, "documents").limit(200), table(spark, sf_dir, "benchmark")
    size = benchmark.selectExpr("sum(octet_length(text) + 64)").first()[0]
    blocks = decontaminate.mark_leaks(documents, benchmark, keep=["doc_id"], block_bytes=size // 3)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        blocks.explain()
    assert out.getvalue().count("MapInArrow") == 1
    assert rows_of(blocks) == rows_of(decontaminate.mark_leaks(documents, benchmark, keep=["doc_id"]))

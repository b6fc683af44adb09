"""Repeated strings: which pieces are compared, and what travels for it."""

import random
import re

import numpy as np

from commentscope.llm import suffix_dedup


def test_short_common_strings_bring_no_windows_together():
    """Texts of the same few long words share strings of 16 to 40 bytes, but no window."""
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghijklmnop", k=20)) for _ in range(60)]
    texts = [" ".join(draw.choices(words, k=200)).encode() for _ in range(40)]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = suffix_dedup.pieces_of(data, offsets, suffix_dedup.LENGTH)
    assert len(found["anchor"]) > 500
    _, times = np.unique(found["anchor"], return_counts=True)
    assert np.mean(times > 1) < 0.01


def test_bytes_of_parts_are_shuffled_once(spark):
    """Only the shards of suffix arrays receive bytes; groups and copies are told without them."""
    draw = random.Random(9)
    shared = "".join(draw.choices("abcdefgh", k=90))
    texts = ["".join(draw.choices("abcdefgh", k=30)) + shared[k:] for k in range(0, 40, 4)] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    plan = suffix_dedup.repeated_spans(df, length=40)._jdf.queryExecution().sparkPlan().toString()
    joined = [line for line in plan.splitlines() if re.search(r"Join \[group#", line)]
    assert any("LeftAnti" in line for line in joined)
    inner = [line for line in joined if "Inner" in line]
    assert inner
    lines = plan.splitlines()
    for line in inner:
        at, column = lines.index(line), line.index(next(w for w in line.split() if "Join" in w))
        under = [x for x in lines[at + 1 :] if x[column : column + 3] in (":- ", "+- ")][:2]
        assert all(not re.search(r"(?<!octet_length\()bytes#", x) for x in under)

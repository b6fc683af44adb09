"""The gated recurrent language model: counts by brute force, gradients by differences,
probabilities that add up, and held-out texts."""

import math
import re
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

from commentscope.llm import gated_lm as lm
from commentscope.llm.common import steps_by_size


def words(text):
    """Tokens of a text; None is its end."""
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower() if (text or "").isascii() else "".join(
        c.lower() if c < "\x80" else c for c in text
    )) + [None]


@pytest.fixture(scope="module")
def scored(spark, sf_dir):
    return lm.op11_lm_scoring(spark, sf_dir).toArrow().to_pylist()


def test_base_equals_brute_force(spark, sf_dir, scored):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    held = {d["doc_id"] for d in documents if crc32(str(d["doc_id"]).encode()) % 7 == 2}
    counts = Counter(w for d in documents if d["doc_id"] not in held for w in words(d["text"]))
    total, kinds = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in scored}
    assert len(scored) == len(documents)
    for doc_id, text in documents:
        row, own = rows[doc_id], words(text)
        assert row["held_out"] == (doc_id in held)
        assert (row["n_tokens"], row["train_tokens"]) == (len(own), total)
        assert row["n_known"] == sum(w in counts for w in own)
        expected = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        assert row["base_score"] == pytest.approx(expected, rel=1e-9)


def test_model_beats_counts_on_held_out_texts(scored):
    held = [r for r in scored if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in scored)


TEXTS = ["the cat saw the dog", "a dog, a cat", "", "the the the", None, "x1 y2 the zebra"] * 3


@pytest.fixture
def network():
    codes, _, distinct = lm.tokens(pa.array(TEXTS))
    times = np.bincount(codes, minlength=len(distinct))
    order = np.argsort(-times, kind="stable")
    shape = lm.shapes(distinct)
    mass = np.ones(lm.SHAPES)
    inner = order[:6]
    np.add.at(mass, shape, times + 1.0)
    np.subtract.at(mass, shape[inner], times[inner] + 1.0)
    known = lm.Lexicon(
        int(times.sum()), len(times), distinct.take(pa.array(order)), times[order], shape[order], mass
    )
    return known




def test_probabilities_add_up(network, monkeypatch):
    """Over all words and an unseen one of each shape, after any words before."""
    monkeypatch.setattr(lm, "NETWORK_WORDS", 6)
    network.__post_init__()
    net = lm.Network(network)
    lm.train(net, iter([pa.record_batch([pa.array(TEXTS * 20)], ["text"])]))
    listed, symbol, group = network.look_up(network.listed)
    state = np.random.default_rng(1).normal(0, 0.5, (1, lm.UNITS)).astype(np.float32)
    logs = net.output(np.repeat(state, len(symbol), axis=0), symbol, group)
    inside = listed < network.network
    shares = np.where(inside, 1, (network.counts + 1) / network.mass[network.shape])
    known = (np.exp(logs) * shares).sum()
    groups = len(network.begins) + np.arange(lm.SHAPES)
    unseen = net.output(np.repeat(state, lm.SHAPES, axis=0), network.network + np.arange(lm.SHAPES), groups)
    assert known + (np.exp(unseen) / network.mass).sum() == pytest.approx(1, abs=1e-5)


def test_gradients_are_those_of_differences(network, monkeypatch):
    monkeypatch.setattr(lm, "NETWORK_WORDS", 6)
    network.__post_init__()
    net = lm.Network(network)
    rng = np.random.default_rng(2)
    for name in net.NAMES:
        old = getattr(net, name).astype(np.float64)
        setattr(net, name, old + rng.normal(0, 0.3, old.shape))
    symbols = rng.integers(0, 8, (5, 3))
    groups = np.where(symbols < 6, network.frequency_class[np.minimum(symbols, 5)], len(network.begins) + symbols - 6)
    opens = rng.random((5, 3)) < 0.2
    start = np.zeros((3, lm.UNITS))

    def value():
        before, _ = net.read(symbols, opens, start)
        return net.output(before.reshape(-1, lm.UNITS), symbols.ravel(), groups.ravel()).sum()

    trace = []
    before, _ = net.read(symbols, opens, start, trace)
    _, found, back = net.output(before.reshape(-1, lm.UNITS), symbols.ravel(), groups.ravel(), learn=True)
    found |= net.back_through(symbols, opens, before, trace, back.reshape(before.shape))
    at, sums = found["inputs"]
    found["inputs"] = np.zeros_like(net.inputs)
    found["inputs"][at] = sums
    for name in net.NAMES:
        weights = getattr(net, name)
        for _ in range(6):
            place = tuple(rng.integers(0, s) for s in weights.shape)
            kept = weights[place]
            weights[place] = kept + 1e-2
            up = value()
            weights[place] = kept - 1e-2
            down = value()
            weights[place] = kept
            assert found[name][place] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=0.01)


def test_lanes_hold_each_token_once_and_texts_in_order(monkeypatch):
    monkeypatch.setattr(lm, "LANES", 3)
    first = np.cumsum([0, 5, 1, 40, 7, 1, 90, 2])
    seen = np.concatenate([place[held] for place, _, held in lm.lanes(first)])
    assert sorted(seen.tolist()) == list(range(first[-1]))
    by_lane = {}
    for place, opens, held in lm.lanes(first):
        for t, lane in zip(*np.nonzero(held)):
            at = place[t, lane]
            assert opens[t, lane] == (at in first[:-1])
            if not opens[t, lane]:
                assert by_lane[lane] == at - 1
            by_lane[lane] = at


def test_one_sequence_however_cut(network, monkeypatch):
    """A document's score does not depend on the window or on what stands beside it."""
    monkeypatch.setattr(lm, "NETWORK_WORDS", 6)
    network.__post_init__()
    net = lm.Network(network)
    lm.train(net, iter([pa.record_batch([pa.array(TEXTS * 5)], ["text"])]))

    def score(texts):
        codes, first, distinct = lm.tokens(pa.array(texts))
        _, symbol, group = network.look_up(distinct)
        logs, state = np.zeros(len(codes)), np.zeros((lm.LANES, lm.UNITS), np.float32)
        for place, opens, held in lm.lanes(first):
            state = state[: place.shape[1]]
            at = place[held]
            before, state = net.read(symbol[codes[place]], opens, state)
            logs[at] = net.output(before[held], symbol[codes[at]], group[codes[at]])
        return np.add.reduceat(logs, first[:-1])

    texts = ["the cat saw a dog, " * 9, "a zebra", "the"]
    whole = score(texts)
    monkeypatch.setattr(lm, "WINDOW", 3)
    monkeypatch.setattr(lm, "LANES", 1)
    assert score(texts) == pytest.approx(whole, rel=1e-4)
    assert score(texts[:1])[0] == pytest.approx(whole[0], rel=1e-4)


def test_odd_documents(spark, tmp_path):
    rows = [
        (1, None, 0.0), (2, "", 0.0), (None, "Alpha beta", 0.0), (4, "alpha " * 60000, None),
        (5, "same same", 1.0), (5, "same same", 1.0), (6, " \t\x0b ", 1.0), (7, "É é Z", 1.0),
    ]
    schema = "doc_id bigint, text string, score double"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    got = lm.op11_lm_scoring(spark, str(tmp_path)).toArrow().to_pylist()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 3, 3, 3, 4, 60001]
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    same = [r for r in got if r["doc_id"] == 5]
    assert len(same) == 2 and same[0] == same[1]
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert lm.op11_lm_scoring(spark, f"{tmp_path}/none").collect() == []


def test_scoring_steps_are_even_and_of_like_length():
    sizes = np.random.default_rng(5).integers(0, 400, 500)
    texts = ["ab " * n for n in sizes.tolist()] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(501)), pa.array(texts)], ["key", "text"])
    parts = [b.to_pylist() for b in steps_by_size(iter([batch]), "text", 60_000)]
    filled = [sum(len(r["text"] or "") for r in part) for part in parts]
    assert sorted(r["key"] for part in parts for r in part) == list(range(501))
    # A rest of a few texts takes a step of the network for each word of the longest one.
    assert len(parts) == 5 and min(filled) > 0.9 * max(filled)
    longest = [[len(r["text"] or "") for r in part] for part in parts]
    assert all(min(a) >= max(b) for a, b in zip(longest, longest[1:]))
    assert [b.num_rows for b in steps_by_size(iter([batch]), "text", 1 << 20)] == [501]
    assert list(steps_by_size(iter([batch.slice(0, 0)]), "text", 10))[0].num_rows == 0


def test_tokens_hold_few_bytes_a_byte_of_text():
    draw = np.random.default_rng(6)
    texts = pa.array([" ".join(f"w{k}" for k in draw.integers(0, 3000, 2000)) for _ in range(600)])
    tracemalloc.start()
    try:
        codes, first, distinct = lm.tokens(texts)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 7 * texts.nbytes
    back = distinct.take(pa.array(codes)).to_pylist()
    assert b" ".join(back[first[7] : first[8] - 1]).decode() == texts[7].as_py()
    assert len(codes) == 600 * 2001 and set(codes[first[1:] - 1]) == {len(distinct) - 1}


def test_tokens_of_texts_without_words():
    for texts in ([], [None], ["", " "], ["", "a B  a", None]):
        codes, first, distinct = lm.tokens(pa.array(texts, pa.string()))
        assert first.tolist() == np.append(0, np.cumsum([len(words(t)) for t in texts])).tolist()
        assert [distinct[c].as_py() for c in codes.tolist()] == [
            lm.END if w is None else w.encode() for t in texts for w in words(t)
        ]

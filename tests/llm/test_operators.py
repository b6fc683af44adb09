"""The training-data operators against brute force, and on odd input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from commentscope.llm import (
    decontaminate,
    jaccard,
    language,
    line_templates,
    packing,
    pii,
    quality,
    secrets,
    suffix_dedup,
    url_filter,
)
from commentscope.llm.queries import ORACLES, QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return {k: t or "" for k, t in duck.sql("SELECT doc_id, text FROM documents").fetchall()}


ODD_TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t \n"),
    (4, "One two\nthree"),
    (4, "One two\nthree"),
    (None, "a null key and a text of some words"),
    (5, "0123 --- ***"),
    (6, "word  and\u00a0 two\r\n\n\n spaces\u2003 " * 40),
    (7, "x" * 300_000),
    (8, "the same nine words stand here and here again\n" * 2000),
    (None, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and names that operators use."""
    clash = ["key", "row", "spans", "leaks", "entities", "n_lines", "ids", "node", "_text", "label"]
    columns = ", ".join(f"{c} string" for c in clash)
    return spark.createDataFrame(
        [(k, t, None, *["c"] * len(clash)) for k, t in ODD_TEXTS],
        f"doc_id bigint, text string, lang string, {columns}",
    )


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


@pytest.mark.parametrize("name", ORACLES)
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    got, wanted = QUERIES[name](spark, sf_dir), duck.sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    order = [wanted.columns.index(c) for c in columns]
    expected = sorted(repr([row[i] for i in order]) for row in wanted.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in got.collect()) == expected


# --- 1 -------------------------------------------------------------------------------------

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("example.org", "", "allow"), ("a.example.org", "/en/12/x", "block"), ("net", "", "block"),
    ("example.net", "/a", "allow"), ("example.net", "/a", "block"), (None, "/", "block"),
]
URLS = [
    "http://example.org/en/1", "https://A.example.ORG/en/12/xy?q#f", "x://b.example.org/en/2",
    "http://example.org?x=/es/", "http://example.net/ab", "http://x.example.net", "no url", None,
    "http://", "http://org/es/", "http://notexample.org/es/", "a://b://example.org/", "",
]


def best_rule(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
    fitting = [
        (len(h.split(".")), len(p), v, h + p)
        for h, p, v in RULES
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *((lambda r: (r[3], r[2]))(max(fitting)) if fitting else (None, "allow")))


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_url_rules_by_trie_and_join(spark, bound):
    rules = spark.createDataFrame(RULES, url_filter.RULES_SCHEMA)
    pages = spark.createDataFrame(
        [(i, u, "x") for i, u in enumerate(URLS + URLS)], "page_id int, url string, host string"
    )
    rows = url_filter.filter_urls(pages, rules, max_trie_bytes=bound).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}
    assert got == {i: best_rule(u) for i, u in enumerate(URLS + URLS)}
    assert url_filter.filter_urls(pages.limit(0), rules, max_trie_bytes=bound).count() == 0


# --- 2 -------------------------------------------------------------------------------------


def check_packed(rows, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for key, text in texts:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = [r for r in pieces[key] if r["doc_tokens"] == len(ids)]
        starts = Counter(r["start"] for r in own)
        assert sorted(starts) == list(range(0, len(ids), 2048))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert len(part) == r["length"]
            assert zlib.crc32(part.tobytes()) == r["ids_crc32"]
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r["length"] for r in rows) / (2048 * len(sequences))


def test_packing(spark, sf_dir, texts):
    assert check_packed(QUERIES["op2_packing"](spark, sf_dir).collect(), texts.items()) > 0.97


def test_packing_odd(spark, odd, none):
    rows = packing.pack_documents(spark, odd).collect()
    check_packed(rows, [x for x in ODD_TEXTS if x[0]])
    assert sum(r["start"] == 0 for r in rows) == len(ODD_TEXTS)
    assert packing.pack_documents(spark, none).count() == 0


def test_pieces_have_the_ids_of_the_whole_text():
    fast = packing.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    slow = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    draw = random.Random(5)
    parts = ["the", "It's", "a.", "b,", " ", "  ", "\n", "\n\n", "\t", "\u00a0", "\u3000", "é", "ß?", "12",
             "x1", "<|endoftext|>", "'s", "'", "...", "日本", "\r\n", "\x1f", "!", "don't", "ſ", "²"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) + draw.choice(["", " ", " "]) for _ in range(12))
        ids = slow.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == ids, text


def test_added_tokens_have_their_ids():
    path = public_tokenizers.path("byte_bpe_50k.json")
    fast = packing.PieceTokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), packing.added_tokens(path))
    slow = Tokenizer.from_file(path)
    draw = random.Random(7)
    parts = ["<|endoftext|>", "a", " b", "It's", " ", "  ", "\n", "\n\n", "\t", "\u3000", ".", "12", "<|", "endoftext|>"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", ""]
    texts += ["".join(draw.choices(parts, k=10)) for _ in range(3000)]
    for text in texts:
        ids = slow.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == ids, text


def test_packed_documents_hold_added_tokens(spark):
    text = "a <|endoftext|> b"
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    (row,) = packing.pack_documents(spark, df).collect()
    assert (row["doc_tokens"], row["ids_crc32"]) == (len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes()))


def test_best_fit_takes_the_tightest_window():
    draw = random.Random(1)
    lengths = np.array(sorted((draw.randint(1, 64) for _ in range(500)), reverse=True))
    number, offset = packing.best_fit_decreasing(lengths, 64)
    rest: list[int] = []
    for n, at, length in zip(number, offset, lengths):
        fitting = [r for r in rest if r >= length]
        room = min(fitting) if fitting else 64
        if not fitting:
            rest.append(64)
        assert (rest[n], at) == (room, 64 - room)
        rest[n] -= length


# --- 3 -------------------------------------------------------------------------------------


def test_quality_odd(odd, none):
    rows = quality.judge_quality(odd).collect()
    assert len(rows) == len(ODD_TEXTS)
    got = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [got[k]["n_words"] for k in (1, 2, 3, 4, 7)] == [0, 0, 0, 3, 1]
    assert got[5]["n_symbols"] == 3
    assert got[8]["n_words"] == got[8]["n_repeat_words"] == 18_000
    assert got[8]["n_dup_lines"] == 1999
    assert not any(r["kept"] for r in rows)
    assert quality.judge_quality(none).count() == 0


# --- 4 -------------------------------------------------------------------------------------


def shingles(text):
    words = WORDS.findall((text or "").translate(LOWER))
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    return frozenset(runs) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute_groups(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b) and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {}
    for g, (k, _) in zip(group, sets):
        least[g] = min([x for x in (least.get(g), k) if x is not None], default=None)
    return sorted(
        repr((k, len(s), least[g] if s else k)) for g, (k, s) in zip(group, sets)
    )


def as_rows(df):
    return sorted(repr((r["doc_id"], r["n_shingles"], r["component_id"])) for r in df.collect())


def test_jaccard_groups(spark, sf_dir, texts):
    assert as_rows(QUERIES["op4_ngram_jaccard_join"](spark, sf_dir)) == brute_groups(texts.items())


@pytest.mark.parametrize("frequent", [1, 3, 1000])
def test_jaccard_chains_of_edits(spark, frequent):
    """Copies with a few words changed, at and around the bound, where leaders do not link all."""
    draw = random.Random(frequent)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(6):
        words = draw.choices(vocabulary, k=draw.choice([6, 30, 120]))
        for _ in range(14):
            words = list(words)
            for _ in range(draw.randint(0, max(1, len(words) // 40))):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert as_rows(jaccard.near_duplicate_groups(df, frequent=frequent)) == brute_groups(rows)


def test_jaccard_odd(odd, none):
    assert as_rows(jaccard.near_duplicate_groups(odd)) == brute_groups(ODD_TEXTS)
    assert jaccard.near_duplicate_groups(none).count() == 0


def test_signatures_meet():
    """Sets with enough in common share a signature, whatever the classes."""
    draw = np.random.default_rng(2)
    for _ in range(600):
        n = int(draw.integers(1, 90))
        a = np.unique(draw.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        drop = draw.random(len(a)) > draw.uniform(0, 0.25)
        b = np.unique(np.append(a[drop], draw.integers(0, 2**63, int(draw.integers(0, 4)), dtype=np.uint64)))
        common = len(np.intersect1d(a, b))
        if not common or 100 * common < 80 * (len(a) + len(b) - common) or set(a) == set(b):
            continue
        share = draw.random()

        def classes(tokens):
            return np.where(jaccard.mix(tokens) % np.uint64(100) < np.uint64(100 * share), jaccard.COMMON, jaccard.RARE)

        one, two = (jaccard.signatures(x, classes(x)) for x in (a, b))
        assert len(np.intersect1d(one, two)), (len(a), len(b), common)


# --- 5 -------------------------------------------------------------------------------------


def test_leaks(spark, sf_dir, duck, texts):
    items = dict(duck.sql("SELECT item_id, text FROM benchmark").fetchall())
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_benchmark_decontamination"](spark, sf_dir).collect()}
    whole = {
        (k, i)
        for k, t in texts.items()
        for i, item in items.items()
        if " ".join(WORDS.findall(item.translate(LOWER))) in " ".join(WORDS.findall(t.translate(LOWER)))
    }
    assert whole and whole <= got
    grams = {i: shingles(t) for i, t in items.items()}
    assert all(len(grams[i] & shingles(texts[k])) >= 0.6 * len(grams[i]) for k, i in got)


def test_reordered_and_partial_passages(spark, odd):
    item = [f"q{i}" for i in range(30)]
    halves = ["filler"] * 9 + item[15:] + ["between"] * 3 + item[:15]
    some = ["filler"] * 9 + item[:20]
    documents = spark.createDataFrame(
        [(1, " ".join(halves)), (2, " ".join(some)), (3, " ".join(item[::-1])), (4, None), (5, "")],
        "doc_id bigint, text string",
    )
    benchmark = spark.createDataFrame(
        [(7, " ".join(item)), (8, "q1 q2"), (9, None), (10, "")], "item_id bigint, text string"
    )
    for block in (1 << 20, 150):
        rows = decontaminate.mark_leaks(documents, benchmark, keep=["doc_id"], block_bytes=block)
        got = {r["doc_id"]: [(x["item"], x["covered"], x["tiles"]) for x in r["leaks"]] for r in rows.collect()}
        assert got == {1: [(7, 30, 2)], 2: [], 3: [], 4: [], 5: []}
    empty = decontaminate.mark_leaks(odd, benchmark.limit(0), keep=["doc_id", "leaks"])
    assert empty.where("size(leaks) = 0").count() == len(ODD_TEXTS)


def test_leaks_in_some_batches_only(spark):
    item = " ".join(f"q{i}" for i in range(20))
    rows = [(k, "filler words " * 100_000 + (item if k % 2 else "")) for k in range(6)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    benchmark = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    marked = decontaminate.mark_leaks(documents, benchmark, keep=["doc_id"]).collect()
    assert {r["doc_id"]: len(r["leaks"]) for r in marked} == {k: k % 2 for k, _ in rows}


def test_tiles_are_greedy():
    assert decontaminate.tiles([1, 2, 3, 4, 5], [3, 4, 5, 9, 1, 2, 3, 4], 2) == [(0, 4, 4)]
    assert decontaminate.tiles([1, 2, 3, 4], [3, 4, 0, 1, 2], 2) == [(0, 3, 2), (2, 0, 2)]


# --- 6 -------------------------------------------------------------------------------------


def test_language(spark, sf_dir, duck):
    langs = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op6_language_id"](spark, sf_dir).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {k for k in langs if zlib.crc32(str(k).encode()) % 5 == 0}
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_costs_are_a_code():
    """In each context the symbols' probabilities sum to one."""
    counts = np.random.default_rng(0).poisson(0.3, (4, 4, 4))
    bits = language.compile_costs(counts).reshape(4, 4, 4)
    assert np.allclose(np.exp2(-bits).sum(-1), 1)


def test_language_odd(spark, odd, none):
    labelled = spark.createDataFrame(
        [("abc abd abe", "x"), ("xyz xyy zzy", "y"), (None, "x"), ("q", None)], "text string, lang string"
    )
    for model in (language.fit(labelled), language.fit(none)):
        rows = language.identify(odd, model, keep=["doc_id", "label"]).collect()
        got = {r["doc_id"]: r["lang_pred"] for r in rows}
        assert len(rows) == len(ODD_TEXTS)
        assert [got[k] for k in (1, 2, 3, 5)] == ["und"] * 4
    assert language.identify(none, model, keep=["doc_id"]).count() == 0


def test_unlearned_languages_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    foreign = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. ",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. ",
        "xq zvkw jjqp wxz qqk vvbz kxj zpqw ",
    ]
    rows = [(-1 - k, t * n, None) for k, (t, n) in enumerate((t, n) for t in foreign for n in (2, 40))]
    known = docs.where("length(text) > 400").orderBy("doc_id").limit(40).collect()
    rows += [(-100 - r["doc_id"], r["text"][:60], None) for r in known]
    more = docs.unionByName(spark.createDataFrame(rows, docs.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language_stage(spark, more, sf_dir).collect()}
    assert {k for k in kept if k < 0} == {k for k, *_ in rows if k <= -100}


# --- 7 -------------------------------------------------------------------------------------


def test_secrets():
    text = 'Token: "abcdef12" pass\nAKIA' + "A" * 16 + " é " + "0" * 24 + " secret=x AKIA12"
    base = secrets.base_spans(text)
    assert secrets.written(base) == f"assign:0:{text.index('12') + 2},access:23:43,hex:46:70"
    weak = "aB3dE6gH9jK2mN5pQ8sT1vW4"
    assert secrets.linked_spans(weak, []) == []
    near = f"client_id: me42\n{weak}\nhttps://api.example.com/v1"
    kinds = [secrets.KINDS[s.kind] for s in sorted(secrets.linked_spans(near, []))]
    assert kinds == ["identifier", "weak_secret", "endpoint"]
    assert secrets.linked_spans("client_id: me42\n" + "far \n" * 200 + weak, []) == []


@pytest.mark.parametrize("length", [24, 128, 129, 400, 5000])
def test_long_tokens_are_candidates(length):
    token = ("aB3dE6gH9jK2mN5pQ8sT1vW4" * length)[:length]
    near = f"client_id: me42\n{token}\nhttps://api.example.com/v1"
    found = {secrets.KINDS[s.kind]: near[s.start : s.end] for s in secrets.linked_spans(near, [])}
    assert found["weak_secret"] == token and set(found) == {"identifier", "weak_secret", "endpoint"}
    assert secrets.linked_spans(token, []) == []


def test_secrets_odd(odd, none):
    rows = secrets.scan_secrets(odd).collect()
    assert len(rows) == len(ODD_TEXTS) and not any(r["spans"] for r in rows)
    assert secrets.scan_secrets(none).count() == 0


# --- 8 -------------------------------------------------------------------------------------


def brute_removal(rows, length):
    held = [(k, (t or "").encode()) for k, t in rows]
    seen = Counter(b[i : i + length] for _, b in held for i in range(len(b) - length + 1))
    out = []
    for key, b in held:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("kinds", [1, 4, 256])
def test_suffix_dedup(spark, kinds):
    draw = random.Random(kinds)
    passages = ["".join(draw.choices("abcdé \n", k=draw.randint(20, 200))) for _ in range(12)]
    rows = [(0, None), (1, ""), (2, "ab" * 300), (3, "short"), (4, passages[0]), (4, passages[0])]
    for k in range(5, 60):
        parts = [draw.choice(passages)[draw.randint(0, 9) :] + draw.choice("xyz") for _ in range(4)]
        rows.append((k, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = suffix_dedup.remove_repeats(df, length=40, max_kinds=kinds).collect()
    found = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got]
    assert sorted(found, key=repr) == brute_removal(rows, 40)


def test_suffix_dedup_query(spark, sf_dir, texts):
    rows = QUERIES["op8_suffix_array_dedup"](spark, sf_dir).collect()
    wanted = {
        k: (n, gone, runs, hashlib.sha256(kept).hexdigest())
        for k, n, gone, runs, kept in brute_removal(texts.items(), 400)
    }
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == wanted


def test_suffix_dedup_odd(odd, none):
    rows = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(odd).collect()}
    assert rows[7]["n_removed"] == 300_000 and bytes(rows[7]["kept"]) == b""
    assert rows[1]["n_bytes"] == rows[2]["n_bytes"] == 0
    assert suffix_dedup.remove_repeats(none).count() == 0


# --- 9 -------------------------------------------------------------------------------------


def test_templates_with_variable_fields(spark):
    rows = [
        (k, f"user {n} logged in from host {k}.example at night time\n{' '.join(n + c for c in 'abcdefghijklmnop')}\nOr.")
        for k, n in enumerate(["ann", "bob", "cid", "dan", "eve", "fay"])
    ] + [(6, None), (7, ""), (8, "user ann logged in from host 0.example at night time")]
    df = spark.createDataFrame(
        [(k, t, "c") for k, t in rows], "doc_id bigint, text string, n_lines string"
    )
    lines = line_templates.drop_recurring_lines(df, depth=1, max_loss=0.6).collect()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in lines}
    assert got[6] == (None, 0, 0) and got[7] == ("", 1, 0)
    assert got[8][2] == 0  # it would lose everything
    assert [got[k][2] for k in range(6)] == [1] * 6
    assert all(got[k][0].startswith(rows[k][1].split("\n")[1]) for k in range(6))


def test_two_templates_in_a_leaf(spark):
    """At production parameters: a line of the same length and start is held by more texts."""
    names = ["ann", "bob", "cid", "dan", "eve", "fay"]
    lines = [f"This article was written by {n} for the Gazette" for n in names]
    other = "This article was never meant to be read aloud"
    rows = [(k, line, "other") for k, line in enumerate(lines)] + [(7, other, "x"), (8, other, "y")]
    df = spark.createDataFrame(
        [(k, f"{line}\n{' '.join(f'{c}{a}' + chr(97 + k) for a in 'abcdefghijklm')}") for k, line, c in rows],
        "doc_id bigint, text string",
    )
    got = {r["doc_id"]: r["n_dropped"] for r in line_templates.drop_recurring_lines(df).collect()}
    assert got == {k: int(k < 6) for k, *_ in rows}


def test_short_lines_and_carriers_in_the_pipeline(spark, sf_dir):
    """Short lines of many texts go, boilerplate goes from texts that it fills, and of such texts
    only lines that near copies hold stay."""
    notice = "This notice stands at the end of all pages of the house"

    def prose(name, n):
        return " ".join(f"{name}{chr(97 + a)}{chr(97 + b)}" for a in range(n) for b in range(5))

    rows = [f"{prose(f'own{chr(97 + k)}', 1)}\n{notice}\n\nShare this page" for k in range(12)]
    copied = [prose(c, 4) for c in ("kilo", "lima", "mike")]
    rows += ["\n".join([*copied, prose(f"end{chr(97 + k)}", 1)]) for k in range(6)]
    rows += [prose("rare", 2) + "\nSay it twice", prose("seldom", 2) + "\nSay it twice"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string")
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, df, sf_dir).collect()}
    wanted = [f"{rows[k].split(chr(10))[0]}\n" for k in range(12)] + rows[12:]
    assert got == dict(enumerate(wanted))


def test_line_dedup_odd(odd, none):
    assert line_templates.drop_recurring_lines(odd).count() == len(ODD_TEXTS)
    assert line_templates.drop_recurring_lines(none).count() == 0


# --- 10 ------------------------------------------------------------------------------------


def test_surrogates_are_distinct_and_keep_their_format():
    s = pii.Surrogates(b"key")
    assert len({s.permuted(v, 12, 34, "t") for v in range(12 * 34)}) == 12 * 34
    phones = [f"+1 (555) 0{i:02d}-0000" for i in range(100)]
    assert len({s.phone(p) for p in phones}) == 100
    assert all(re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", s.phone(p)) for p in phones)
    card = s.card("4111 1111 1111 1111")
    assert card != "4111 1111 1111 1111" and pii._luhn(card[:-1]) == int(card[-1])
    assert pii._iban_check(s.iban("DE89370400440532013000")) == int(s.iban("DE89370400440532013000")[2:4])
    names = s.name("Anna Muster", "f"), s.name("Muster", "")
    assert names[0].split(" ")[0] in pii.GIVEN_NAMES["f", "latin"]
    assert names[0].split(" ")[1] == names[1]
    assert re.fullmatch("[А-Я][а-я]+ [А-ЯЁ][а-яё]+", s.name("Иван Петров", "m"))
    given = pii.GIVEN_NAMES["m", "latin"]
    assert len({s.name(f"{g} X", "m") for g in given}) == len(given)


def test_names_by_gender_and_without_title(spark):
    texts = [
        "Dr Anna Keller came. Keller said that Anna was late; Kellerman was not. Call Mrs Keller.",
        "Ms Brigitte Keller wrote, and Brigitte Keller signed. Dr Brigitte Keller agreed.",
        "Mr Brigitte Keller wrote.", "Dr Brigitte Keller wrote.", "Mr Anna Keller wrote.", "Г Господин Жан Петров",
        "Dr Ζήνων Παππάς", "Ms Ζήνων Παππάς",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    new = {r["doc_id"]: r["text"] for r in pii.replace_personal_data(df, key=b"key").collect()}
    given, family = re.match(r"Dr (\S+) (\S+) came", new[0]).groups()
    assert given in pii.GIVEN_NAMES["f", "latin"]
    assert new[0] == f"Dr {given} {family} came. {family} said that {given} was late; Kellerman was not. Call Mrs {family}."
    first, last = re.match(r"Ms (\S+) (\S+) wrote", new[1]).groups()
    assert last == family and first.split("-")[0] in pii.GIVEN_NAMES["f", "latin"]
    assert new[1] == f"Ms {first} {last} wrote, and {first} {last} signed. Dr {first} {last} agreed."
    assert all(new[k].split(" ")[1].split("-")[0] in pii.GIVEN_NAMES["m", "latin"] for k in (2, 4))
    assert new[5].split(" ")[2].split("-")[0] in pii.GIVEN_NAMES["m", "cyrillic"]


@pytest.mark.parametrize(
    "kind, written",
    [
        ("phone", ["+1 (555) 010-2345", "+1 555 010 2345", "+15550102345"]),
        ("phone", ["030 123 4567", "030-123-4567"]),
        ("card", ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"]),
        ("iban", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"]),
    ],
)
def test_numbers_have_one_surrogate_however_written(spark, kind, written):
    s = pii.Surrogates(b"key")
    new = [s.of(kind, w) for w in written]
    assert len({pii.normal(kind, n) for n in new}) == 1
    assert [re.sub("[0-9A-Z]", "x", n) for n in new] == [re.sub("[0-9A-Z]", "x", w) for w in written]
    df = spark.createDataFrame([(f"at {w} now",) for w in written], "text string")
    assert pii.replace_personal_data(df, key=b"key").where("size(entities) = 1").count() == len(written)


def test_personal_data_is_gone(spark, sf_dir, texts):
    rows = QUERIES["op10_pii"](spark, sf_dir).collect()
    found = 0
    for r in rows:
        old = texts[r["doc_id"]]
        for e in r["entities"]:
            entity = old[e["start"] : e["end"]]
            assert e["surrogate"] != entity and entity not in r["text"]
            found += 1
        if not r["entities"]:
            assert r["text"] == old
    assert found == sum(r["n_entities"] for r in rows) > 0


def test_collisions_are_seen(spark):
    rows = [("name", "a", "x"), ("name", "b", "x"), ("ip", "c", "y"), ("ip", "c", "z"), ("ip", "d", "w")]
    table = spark.createDataFrame(rows, "type string, entity string, surrogate string")
    assert {r["value"] for r in pii.collisions(table).collect()} == {"x", "c"}


def test_personal_data_odd(odd, none):
    rows = pii.replace_personal_data(odd, key=b"key").collect()
    assert sorted(repr(r["text"]) for r in rows) == sorted(repr(t) for _, t in ODD_TEXTS)
    assert pii.replace_personal_data(none, key=b"key").count() == 0


# --- pipeline ------------------------------------------------------------------------------


def test_pipeline_stages(spark, sf_dir, texts):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.dtypes
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.dtypes == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    letters = {k for k, t in texts.items() if any(c.isalpha() for c in t)}
    assert set(kept["language_id"]) == set(kept["line_dedup"]) == letters
    lines = kept["line_dedup"]
    assert all(set(lines[k].split("\n")) <= set(texts[k].split("\n")) for k in lines)
    groups = [eval(r) for r in brute_groups(lines.items())]
    assert set(kept["ngram_jaccard_join"]) == {k for k, _, c in groups if k == c}
    leaked = set(kept["ngram_jaccard_join"]) - set(kept["benchmark_decontamination"])
    assert 0 < len(leaked) < 0.1 * len(texts)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_packed(packed, kept["benchmark_decontamination"].items())


def test_pipeline_odd(spark, odd, none, sf_dir):
    labelled = spark.createDataFrame([(99, "a text of words", "en")], "doc_id bigint, text string, lang string")
    for docs in (odd.unionByName(labelled, allowMissingColumns=True), none):
        names = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
            assert docs.columns == names
        corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count()


def test_a_place_of_a_repeated_piece_is_joined_once(spark):
    """Copies of a text must not multiply with the ranges of its pieces."""
    rng = random.Random(31)
    shared = "".join(rng.choices("abcdefgh", k=90))
    texts = ["".join(rng.choices("abcdefgh", k=30)) + shared[k:] for k in range(0, 40, 4)] * 5
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    spans = suffix_dedup.repeated_spans(df, length=40, max_kinds=2)
    plan = spans._jdf.queryExecution().optimizedPlan().toString().splitlines()
    (join,) = [i for i, line in enumerate(plan) if "Join Inner, ((anchor#" in line]
    column = plan[join].index("Join")
    sides = [line for line in plan[join + 1 :] if line[column : column + 3] in (":- ", "+- ")][:2]
    assert len(sides) == 2 and all(line[column + 3 :].startswith("Aggregate [anchor#") or
                                   line[column + 3 :].startswith("Aggregate [id#") for line in sides)
    assert spans.count() == len(set(texts))

"""Templates of a leaf are taken together, with the rows that taking one after the other gives."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from commentscope.llm import line_templates
from commentscope.llm.line_templates import line_table, recurring_lines
from commentscope.storage import new_dir


def table_of(spark, texts):
    path = new_dir(spark, "line-table")
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    line_table(df).write.parquet(path)
    return spark.read.parquet(path)


def one_by_one(texts, least=5, similarity=80):
    """Recurring lines and their model, None for a line that enough texts hold as it is."""
    holders = defaultdict(set)
    for text in texts:
        for line in text.split("\n"):
            holders[line].add(text)
    leaves = defaultdict(list)
    for line in holders:
        words = line.split(" ")
        leaves[len(words), *words[:3]].append(line)
    found = {(line, None) for line in holders if len(holders[line]) >= least}
    for rest in leaves.values():
        rest.sort(key=lambda line: (-len(holders[line]), line))
        while rest:
            model = rest[0].split(" ")
            like = [
                line
                for line in rest
                if 100 * sum(a == b for a, b in zip(line.split(" "), model)) >= similarity * len(model)
            ]
            if len(set().union(*[holders[line] for line in like])) >= least:
                found |= {(line, rest[0]) for line in like}
            rest = [line for line in rest if line not in like]
    return found


def texts_with_templates(seed=7, templates=40):
    pick = random.Random(seed)
    words = [a + b for a in "klmn" for b in "aeiou"]
    heads = [" ".join(pick.choices(words[:12], k=7)) for _ in range(templates)]
    texts = []
    for k in range(300):
        lines = []
        for _ in range(4):
            head = pick.choice(heads).split(" ")
            if pick.random() < 0.7:
                head[pick.randrange(7)] = pick.choice(words)
            lines.append(" ".join(["these", "three", "lead", *head]))
        texts.append("\n".join(lines))
    return texts


@pytest.mark.parametrize("batch, broadcast", [(None, None), (3, None), (4, 0)])
def test_models_in_batches_are_those_taken_one_by_one(spark, monkeypatch, batch, broadcast):
    if batch:
        monkeypatch.setattr(line_templates, "BATCH_LINES", batch)
    if broadcast is not None:
        monkeypatch.setattr(line_templates, "MAX_BROADCAST_BYTES", broadcast)
    texts = texts_with_templates(templates=40 if batch is None else 12)
    lines = table_of(spark, texts)
    hashed = lines.select("masked", "line", "leaf").distinct().collect()
    line = {r["masked"]: r["line"] for r in hashed}
    models = spark.createDataFrame([(r["masked"], r["leaf"]) for r in hashed], "m string, leaf bigint")
    unit = {r["m"]: r["u"] for r in models.select("m", F.xxhash64("leaf", "m").alias("u")).collect()}
    got = Counter((r["line"], r["unit"]) for r in recurring_lines(lines).collect())
    wanted = {(line[a], line[a] if m is None else unit[m]) for a, m in one_by_one(texts)}
    assert len(wanted) > 50 and got == Counter(wanted)


def test_many_templates_of_a_leaf_take_one_round(spark, monkeypatch):
    purposes = []
    stored = line_templates.stored
    monkeypatch.setattr(
        line_templates, "stored", lambda df, name: purposes.append(name) or stored(df, name)
    )
    texts = [f"these three lead {' '.join(f'{a}{k % 30}x{k % 30}'.translate(DIGITS) for a in 'abcdefg')}\nown {k}" for k in range(150)]
    lines = table_of(spark, texts)
    assert recurring_lines(lines).select("unit").distinct().count() >= 30
    assert purposes.count("judged-lines") == 1


# A token with a digit is a variable field.
DIGITS = str.maketrans("0123456789", "qrstuvwxyz")


def test_words_of_a_text_stand_beside_its_lines(spark):
    texts = [" a\tb  c 1d e \n\n\x0b f g h i\r\nj k l m n 5 \n ", "one two three four five", " \n", ""]
    got = {(r["words"], r["tokens"], r["masked"]) for r in table_of(spark, texts).collect()}
    assert got == {
        (15, 5, "a b c <*> e"),
        (15, 6, "j k l m n <*>"),
        (5, 5, "one two three four five"),
    }


def test_sketches_hash_runs_of_a_text_without_list_functions(spark, monkeypatch):
    """The same sketch as hashing each slice of five words, for any number of words."""
    kept = {}
    stored = line_templates.stored
    monkeypatch.setattr(
        line_templates,
        "stored",
        lambda df, name: kept.update({name: (stored(df, name), df)}) or kept[name][0],
    )
    texts = [" ".join(f"w{k * k % 31}" for k in range(n)) for n in (0, 1, 3, 5, 6, 9, 80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc bigint, text string")
    line_templates.copy_groups(docs)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))),
        lambda at: F.xxhash64(F.slice("words", at, 5)),
    )
    words = F.filter(F.split("text", " "), lambda w: w != "")
    wanted = defaultdict(dict)
    for r in docs.withColumn("words", words).select("doc", F.explode(runs).alias("run")).collect():
        part = r["run"] % line_templates.SKETCH
        wanted[r["doc"]][part] = min(r["run"], wanted[r["doc"]].get(part, r["run"]))
    sketches, plan = kept["sketches"]
    got = {r["doc"]: {k: v for k, v in enumerate(r["sketch"]) if v is not None} for r in sketches.collect()}
    assert got == wanted
    assert "transform(" not in plan._jdf.queryExecution().optimizedPlan().toString()

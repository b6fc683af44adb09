"""What the line stage of the pipeline shuffles: texts twice at most, and sketches once a pair."""

import contextlib
import io
import re

import corpus_pipeline
from commentscope.llm import line_templates
from commentscope.storage import new_dir


def exchanges(df):
    """Columns of each shuffle in the plan of `df`."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]\n", out.getvalue())


def test_line_stage_shuffles_texts_twice_and_sketches_without_keys(spark, monkeypatch):
    boiler = [f"all of these words stand in every text {k}" for k in "abcdef"]
    # One document in two is boilerplate for the most part, so that copies are judged.
    texts = ["\n".join([*boiler, *["own " * (i + 3) + "line"] * (i % 2 * 40)]) for i in range(12)]
    rows = [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)]
    path = new_dir(spark, "documents")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(path)
    docs = spark.read.parquet(path)
    found, packed = [], []
    stored, drop = line_templates.stored, corpus_pipeline.drop_recurring_lines
    monkeypatch.setattr(
        line_templates, "stored", lambda df, name: found.extend(exchanges(df)) or stored(df, name)
    )
    monkeypatch.setattr(
        corpus_pipeline,
        "drop_recurring_lines",
        lambda df, **options: packed.append(df.schema) or drop(df, **options),
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cleaned = corpus_pipeline.line_stage(spark, docs, "")
        found += exchanges(cleaned)
        got = {r["doc_id"]: r for r in cleaned.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "text" not in packed[0]["row"].dataType.fieldNames()
    assert 1 <= sum("text#" in columns for columns in found) <= 2
    assert any("sketch#" in columns for columns in found)
    assert not [c for c in found if "key#" in c and "sketch#" in c]
    assert cleaned.columns == docs.columns and len(got) == 12
    assert boiler[0] not in got[1]["text"] and "own own line" in got[1]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())

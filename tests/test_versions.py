"""Versioned tables, views that stay, and ids that stay the same."""

import random

import pytest
from pyspark.sql import functions as F

from commentscope import operators as O
from commentscope import schemas
from commentscope.operators.numbering import numbered
from commentscope.sinks import live_versions, publish_results, publish_table, publish_version, version_writer

TABLE = "distribucion_sentiment_score"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{random.getrandbits(40):x}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


@pytest.fixture
def cells(spark):
    def make(*labels):
        rows = [(label, "x", n) for n, label in enumerate(labels)]
        return spark.createDataFrame(rows, schemas.RESULTS[TABLE].columns)

    return make


def labels(spark, name):
    return sorted(r["rango_score"] for r in spark.table(name).collect())


def test_a_run_has_its_rows_once(spark, database, cells):
    name = f"{database}.t"
    publish_version(cells("a", "b"), name, "it's \\ run/1", replace=False)
    publish_version(cells("c"), name, "2", replace=False)
    assert labels(spark, name) == ["a", "b", "c"]
    publish_version(cells("d"), name, "it's \\ run/1", replace=False)
    assert labels(spark, name) == ["c", "d"]
    publish_version(cells("e"), name, "3", replace=True)
    assert labels(spark, name) == ["e"]
    assert set(live_versions(spark, name)) == {"3"}
    assert spark.table(name).columns == schemas.RESULTS[TABLE].columns.fieldNames()


def test_a_failing_publishing_shows_nothing(spark, database, cells):
    name = f"{database}.t"
    publish_version(cells("a"), name, "1", replace=True)
    broken = cells("b", "c").withColumn(
        "rango_score", F.when(F.col("cantidad") < 1, F.col("rango_score")).otherwise(F.raise_error(F.lit("no")))
    )
    with pytest.raises(Exception, match="no"):
        publish_version(broken, name, "1", replace=True)
    assert labels(spark, name) == ["a"]
    assert labels(spark.newSession(), name) == ["a"]


def test_a_reader_at_work_keeps_its_rows(spark, database, cells):
    name = f"{database}.t"
    publish_version(cells("a"), name, "1", replace=True)
    reading = spark.table(name)
    reading.schema
    publish_version(cells("b"), name, "1", replace=True)
    assert [r["rango_score"] for r in reading.collect()] == ["a"]
    versions = {r[0].split("/")[1] for r in spark.sql(f"SHOW PARTITIONS {name}__versions").collect()}
    publish_version(cells("c"), name, "1", replace=True)
    assert len(versions) == spark.sql(f"SHOW PARTITIONS {name}__versions").count() == 2
    assert labels(spark, name) == ["c"]


def test_other_tables_are_not_taken_over(spark, database, cells):
    cells("a").write.saveAsTable(f"{database}.t")
    with pytest.raises(ValueError, match="not published in versions"):
        publish_version(cells("b"), f"{database}.t", "1", replace=True)
    assert labels(spark, f"{database}.t") == ["a"]


def test_views_stay_and_follow_their_tables(spark, database, make_comments):
    def publish(rows, run):
        df = make_comments(rows)
        results = {"patrones_horarios": O.hourly_pattern(df), "comparativa_subreddits": O.community_comparison(df)}
        return publish_results(spark, results, version_writer(database, run)).collect()

    hour = [{"created_utc": 3600 * h, "sentiment": 0.5, "subreddit_name": "big"} for h in range(60)]
    publish(hour, "1")
    assert O.create_views(spark, database) == [
        f"{database}.view_heatmap_semanal", f"{database}.view_ranking_subreddits",
    ]
    other = spark.newSession()
    assert other.table(f"{database}.view_heatmap_semanal").count() == 60
    (row,) = other.table(f"{database}.view_ranking_subreddits").collect()
    assert (row["subreddit_name"], row["etiqueta_sentimiento"]) == ("big", "Positivo")
    publish(hour[:3] + [{"created_utc": None}], "2")
    heat = other.table(f"{database}.view_heatmap_semanal").collect()
    assert sorted((r["dia_nombre"] or "", r["hora"] is None) for r in heat) == [("", True)] + [("Jueves", False)] * 3
    assert other.table(f"{database}.view_ranking_subreddits").count() == 0


@pytest.mark.parametrize("partitions", [1, 3, 8])
def test_numbers_do_not_depend_on_partitions(spark, partitions):
    rows = [(i % 7, f"{i * 37 % 100:02d}", None if i % 5 else 1.0) for i in range(100)] + [(3, "dup", 1.0)] * 4
    df = spark.createDataFrame(random.Random(partitions).sample(rows, len(rows)), "a int, `b.c` string, _block double")
    got = numbered(df.repartition(5), ["a", "b.c", "_block"], "n", partitions=partitions).collect()
    assert sorted(r["n"] for r in got) == list(range(1, 105))
    by_number = [tuple(r)[:3] for r in sorted(got, key=lambda r: r["n"])]
    assert by_number == sorted(rows, key=lambda r: (r[0], r[1], r[2] is not None, r[2] or 0))
    assert numbered(df.limit(0), ["a"], "n").collect() == []


def test_ids_stay_the_same_in_every_load(spark, database, cells):
    df = cells(*[f"{i:03d}" for i in range(40)]).repartition(7)

    def ids():
        rows = spark.table(f"{database}.{TABLE}").collect()
        return {r["row_id"]: r["rango_score"] for r in rows}

    write = version_writer(database, "r1")
    counts = publish_table(df, TABLE, write, surrogate_id=True, run_name="r1")
    assert counts["rows"] == 40
    first = ids()
    publish_table(df.repartition(2), TABLE, write, mode="append", surrogate_id=True, run_name="r1")
    assert ids() == first and len(first) == 40
    assert first["r1-1"] == "000" and first["r1-40"] == "039"
    publish_table(df, TABLE, version_writer(database, "r2"), mode="append", surrogate_id=True, run_name="r2")
    assert len(ids()) == 80

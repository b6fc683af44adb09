import gzip
import random

import pytest
from pyspark.sql import functions as F

from commentscope import operators as O
from commentscope import schemas
from commentscope.sinks import (
    clean_for_serving,
    publish_results,
    publish_table,
    table_writer,
    write_result,
)
from commentscope.sources import (
    land_raw,
    read_comments_csv,
    read_result,
)

HEADER = ",".join(schemas.RAW_HEADER)


def write_csv(path, text):
    path.write_bytes(text.encode())
    return str(path)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_quotes_line_breaks_and_bad_values(spark, tmp_path):
    path = write_csv(
        tmp_path / "c.csv",
        f"{HEADER}\n"
        'comment,e1,7,news,false,1704067200,/c/1,"he said ""hi"",\nbye",-0.31,-1\n'
        "comment,e2,7,news,maybe,soon,/c/2,,x,xx\n"
        'comment,e3,7,news,true,5,/c/3,"",0.5,2\n',
    )
    first, second, third = sorted(read_comments_csv(spark, path).collect(), key=lambda r: r["id"])
    assert tuple(first) == (
        "comment", "e1", "7", "news", False, 1704067200, "/c/1", 'he said "hi",\nbye', -0.31, -1,
    )
    assert tuple(second)[4:] == (None, None, "/c/2", None, None, None)
    assert third["body"] is None and third["subreddit_nsfw"] is True


def test_wrong_header_is_refused(spark, tmp_path):
    swapped = HEADER.replace("sentiment,score", "score,sentiment")
    path = write_csv(tmp_path / "c.csv", f"{swapped}\ncomment,a,,,,,,,1,0.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_comments_csv(spark, path).collect()


STRAY_QUOTE = 'comment,a,,,,,,a 5" pipe,,1\ncomment,b,,,,,,hi,,2\ncomment,c,,,,,,7" and 9",,3\n'


def test_landing_keeps_rows_of_a_file_with_a_stray_quote(spark, tmp_path):
    path = write_csv(tmp_path / "c.csv", f"{HEADER}\n{STRAY_QUOTE}")
    landed = land_raw(spark, path, str(tmp_path / "bronze"))
    assert sorted(r["id"] for r in landed.collect()) == ["a", "b", "c"]


def test_landing_takes_a_whole_dataset(spark, tmp_path):
    """Folders below folders, compressed files, and names that stand in two folders."""
    for folder, name in [("x", "c.csv"), ("y", "c.csv"), ("y/z", "d.csv")]:
        (tmp_path / "raw" / folder).mkdir(parents=True, exist_ok=True)
        write_csv(tmp_path / "raw" / folder / name, f"{HEADER}\ncomment,{folder},,,,,,hi,,1\n")
    packed = gzip.compress(f"{HEADER}\ncomment,gz,,,,,,hi,,1\n".encode())
    (tmp_path / "raw" / "e.csv.gz").write_bytes(packed)
    raw, target = str(tmp_path / "raw"), str(tmp_path / "bronze")
    landed = land_raw(spark, raw, target)
    assert sorted(r["id"] for r in landed.collect()) == ["gz", "x", "y", "y/z"]
    for name, expected in [("d.csv", "y/z"), ("e.csv.gz", "gz")]:
        one = land_raw(spark, raw, target, file_name=name)
        assert [r["id"] for r in one.collect()] == [expected]
    with pytest.raises(ValueError, match="more than once"):
        land_raw(spark, raw, target, file_name="c.csv")


def test_landing(spark, fixture_comments, tmp_path):
    raw = str(tmp_path / "raw")
    write_result(fixture_comments.toDF(*schemas.RAW_HEADER), raw, fmt="csv")
    landed = land_raw(spark, raw, str(tmp_path / "bronze"))
    assert landed.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.COMMENTS]
    assert rows_of(landed) == rows_of(fixture_comments)


def test_landing_picks_one_file_of_a_dataset(spark, tmp_path):
    write_csv(tmp_path / "comments.csv", f"{HEADER}\ncomment,a,,,,,,hi,,1\n")
    write_csv(tmp_path / "posts.csv", "other\n1\n")
    target = str(tmp_path / "out")
    landed = land_raw(spark, str(tmp_path), target, file_name="comments.csv")
    assert [r["id"] for r in landed.collect()] == ["a"]
    with pytest.raises(FileNotFoundError, match="posts.csv"):
        land_raw(spark, str(tmp_path), target, file_name="missing.csv")


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc"])
def test_result_round_trip(spark, tmp_path, fmt):
    schema = schemas.RESULTS["comentarios_extremos"].columns
    rows = [
        ("1", "n", 5, 1, 0.5, "t", 'say "hi", \\ you\nand\r\nme '),
        ("2", "", None, None, None, None, " padded "),
        ("3", None, 5, -1, -0.5, "t", ""),
        ("4", "n", 5, -1, -0.5, "t", None),
    ]
    path = str(tmp_path / "r")
    write_result(spark.createDataFrame(rows, schema), path, fmt=fmt, single_file=True)
    assert rows_of(read_result(spark, path, "comentarios_extremos", fmt)) == sorted(rows, key=repr)


def test_overwrite_and_append(spark, tmp_path):
    path = str(tmp_path / "r")
    df = spark.createDataFrame([("a", "b", 1)], schemas.RESULTS["distribucion_sentiment_score"].columns)
    for mode, count in [("overwrite", 1), ("append", 2), ("overwrite", 1)]:
        write_result(df, path, mode=mode)
        assert read_result(spark, path, "distribucion_sentiment_score").count() == count


def test_cleaning_for_serving(spark):
    df = spark.createDataFrame(
        [("0", "2024-01-07 00:00:00", "60", "x"), ("1", "never", "later", "y")],
        ["Unnamed: 0", "periodo", "created_utc", "kept"],
    )
    cleaned = clean_for_serving(df)
    assert cleaned.dtypes == [("periodo", "timestamp"), ("created_utc", "bigint"), ("kept", "string")]
    assert [r["created_utc"] for r in cleaned.collect()] == [60, None]
    stamped = clean_for_serving(df, unix_as_timestamp=True)
    assert dict(stamped.dtypes)["created_utc"] == "timestamp"
    assert [r["periodo"] is None for r in stamped.collect()] == [False, True]


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{random.getrandbits(40):x}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    return name


def test_a_failing_table_leaves_the_others_alone(spark, database, make_comments):
    df = make_comments([{"created_utc": 0, "sentiment": 0.5}, {"created_utc": None}])

    def unreadable():
        return spark.read.parquet("/nowhere/at/all")

    status = publish_results(
        spark,
        {
            "tendencias_diarias": O.daily_trend(df),
            "patrones_horarios": unreadable,
            "validacion_sentimiento": O.sentiment_check(df),
            "distribucion_sentiment_score": df,
        },
        table_writer(database),
    )
    rows = {r["table"]: r for r in status.collect()}
    assert rows["tendencias_diarias"]["status"] == "published"
    assert rows["tendencias_diarias"]["rows"] == 2
    assert rows["tendencias_diarias"]["violations"] == '{"periodo_not_null": 1}'
    assert rows["patrones_horarios"]["status"] == "failed"
    assert "nowhere" in rows["patrones_horarios"]["error"]
    assert rows["validacion_sentimiento"]["violations"] == "{}"
    assert "columns missing" in rows["distribucion_sentiment_score"]["error"]
    assert spark.table(f"{database}.tendencias_diarias").count() == 2
    assert not spark.catalog.tableExists(f"{database}.patrones_horarios")


def test_modes_of_publishing(spark, database, make_comments):
    results = {"validacion_sentimiento": O.sentiment_check(make_comments([{"score": 1}]))}
    write = table_writer(database)
    for mode, count in [("overwrite", 1), ("append", 2), ("overwrite", 1)]:
        publish_results(spark, results, write, modes={"validacion_sentimiento": mode})
        assert spark.table(f"{database}.validacion_sentimiento").count() == count


def test_rejecting_rows_that_break_a_rule(spark, database):
    schema = schemas.RESULTS["patrones_horarios"].columns
    bad = spark.createDataFrame([(1, 24, "Domingo", 0.0, 1, 0.0), (1, 23, None, 0.0, 1, 0.0)], schema)
    with pytest.raises(ValueError, match="hora_in_day"):
        publish_table(bad, "patrones_horarios", table_writer(database), reject_violations=True)
    assert not spark.catalog.tableExists(f"{database}.patrones_horarios")
    counts = publish_table(bad, "patrones_horarios", table_writer(database))
    assert (counts["rows"], counts["hora_in_day"], counts["nombre_dia_not_null"]) == (2, 1, 1)


def test_surrogate_ids_are_unique(spark, database):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("rango_score"),
        F.lit("x").alias("rango_sentiment"),
        F.col("id").alias("cantidad"),
    )
    table = "distribucion_sentiment_score"
    for mode, run in (("overwrite", "first"), ("append", "second")):
        publish_table(
            df, table, table_writer(database), mode=mode, surrogate_id=True, run_name=run
        )
    stored = spark.table(f"{database}.{table}")
    assert stored.select("row_id").distinct().count() == stored.count() == 200


def test_surrogate_ids_of_published_results(spark, database, make_comments):
    results = {"validacion_sentimiento": O.sentiment_check(make_comments([{"score": 1}]))}
    publish_results(spark, results, table_writer(database), surrogate_id=True)
    assert spark.table(f"{database}.validacion_sentimiento").columns[0] == "row_id"


@pytest.mark.parametrize("name", ["csv_scan_split", "bronze_landing"])
def test_large_datasets_are_many_files(spark, sf_dir, monkeypatch, name):
    import __spark_entry__ as entry

    folders = []
    raw = entry._raw_csv
    monkeypatch.setattr(entry, "_raw_csv", lambda *a: folders.append(raw(*a)) or folders[-1])
    assert entry.queries()[name](spark, sf_dir).count() > 0
    assert len(spark.read.text(folders[0]).inputFiles()) > 1

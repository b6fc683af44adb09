"""Files of large raw datasets: bounded, written without a shuffle, and whole."""

import glob

import pytest

import __spark_entry__ as entry
from commentscope import schemas
from commentscope.sinks import write_result
from commentscope.sources import land_checked, land_raw, read_comments_csv


@pytest.fixture
def comments(make_comments):
    return make_comments([{"id": str(i), "body": f'"{i}",\nx', "score": i} for i in range(25)])


@pytest.fixture
def tables(spark, tmp_path):
    """Test tables of their own: 400 events on 40 documents."""
    spark.sql("SET spark.sql.session.timeZone=UTC")
    spark.range(400).selectExpr(
        "id AS event_id",
        "CAST(TIMESTAMP_SECONDS(1704067200 + id * 60) AS timestamp_ntz) AS ts",
        "id % 30 AS user_id",
        "'click' AS event_type",
    ).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(40).selectExpr("id AS doc_id", "concat('a, \"b\"\\n', id) AS text").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.range(0, 40, 3).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    return str(tmp_path)


def _records(spark, folder):
    """Records of each file, by reading it alone."""
    files = spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()
    return [read_comments_csv(spark, f).count() for f in files]


def test_a_task_begins_a_new_file_after_so_many_rows(spark, comments, tmp_path):
    raw = str(tmp_path / "raw")
    rows = comments.coalesce(1).toDF(*schemas.RAW_HEADER)
    write_result(rows, raw, fmt="csv", rows_per_file=10, compression="gzip")
    assert len(glob.glob(f"{raw}/*.csv.gz")) == 3
    assert sorted(_records(spark, raw)) == [5, 10, 10]
    landed = land_raw(spark, raw, str(tmp_path / "bronze"))
    assert sorted(landed.collect()) == sorted(comments.collect())
    checked = land_checked(spark, raw, str(tmp_path / "checked"))
    assert sorted(checked.comments.collect()) == sorted(comments.collect())
    for folder in ("bronze", "checked/*"):
        files = glob.glob(f"{tmp_path}/{folder}/*.parquet")
        assert files and all(f.endswith(".zstd.parquet") for f in files)


@pytest.mark.parametrize("name", ["csv_scan", "csv_scan_split", "bronze_landing", "dataset_landing"])
def test_no_raw_file_grows_with_the_dataset(spark, tables, monkeypatch, name):
    written = []
    write = entry._write_raw
    monkeypatch.setattr(entry, "RAW_FILE_ROWS", 7)
    monkeypatch.setattr(
        entry, "_write_raw", lambda rows, path, n=7: (written.append(path), write(rows, path, n))
    )
    whole = sorted(entry.queries()[name](spark, tables).collect())
    records = [n for path in written for n in _records(spark, path)]
    assert sum(records) == 400 and max(records) <= 7
    monkeypatch.setattr(entry, "RAW_FILE_ROWS", 1000)
    assert sorted(entry.queries()[name](spark, tables).collect()) == whole


def test_defects_beside_files_without_sorting(spark, tables, monkeypatch):
    query = entry.queries()["landing_rejects"]
    in_sorted_files = sorted(query(spark, tables).collect())
    monkeypatch.setattr(entry, "DEFECT_RECORDS", 3)
    monkeypatch.setattr(entry, "RAW_FILE_ROWS", 7)
    assert sorted(query(spark, tables).collect()) == in_sorted_files
    raw = entry._raw_csv_with_defects(spark, tables)
    files = spark.read.text(f"{raw}/others").inputFiles()
    assert max(read_comments_csv(spark, f).count() for f in files) <= 7
    assert sum(read_comments_csv(spark, f).count() for f in files) == 400 - 16 * 3

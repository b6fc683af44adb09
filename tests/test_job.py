"""The whole job on raw CSV, through landing, reports, tables and views."""

import random

import pytest

from commentscope import schemas
from commentscope.job import arguments, run_job
from commentscope.plans.full_run import publish_run, run_reports
from commentscope.session import create_session
from commentscope.sinks import table_writer, write_result


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_job(spark, fixture_comments, tmp_path, fmt):
    raw = str(tmp_path / "raw")
    write_result(fixture_comments.toDF(*schemas.RAW_HEADER), raw, fmt="csv")
    database = f"job_{random.getrandbits(40):x}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    base = ["--base", f"{tmp_path}/out", "--database", database, "--format", fmt]

    status = run_job(spark, arguments([*base, "--raw", raw])).collect()
    assert {r["status"] for r in status} == {"published"}
    assert len(status) == 9
    counts = {r["table"]: r["rows"] for r in status}
    assert counts["top_palabras_sentimiento"] == 150

    def in_table(name):
        return spark.newSession().table(f"{database}.{name}").count()

    # Another session reads the views, which follow their tables.
    assert in_table("view_heatmap_semanal") == counts["patrones_horarios"] == in_table("patrones_horarios")
    assert in_table("view_alertas_recientes") == counts["anomalias"] > 0

    # The same run again has its rows once, in tables that grow too; another run adds its own.
    for run, times in [("comments", 1), ("more", 2)]:
        more = ["--append", "anomalias", "--run", run]
        landed = ["--raw", raw] if run == "more" else []
        again = run_job(spark, arguments([*base, *more, *landed])).collect()
        assert {r["status"] for r in again} == {"published"}
        assert in_table("anomalias") == times * counts["anomalias"] == in_table("view_alertas_recientes")
        assert in_table("patrones_horarios") == counts["patrones_horarios"]


def test_publishing_a_named_run(spark, tmp_path):
    """Without paths, results are looked for where the named run stores them."""
    status = publish_run(spark, table_writer(), base_path=f"{tmp_path}/empty", run_name="r").collect()
    assert {r["status"] for r in status} == {"failed"}
    assert all(f"{tmp_path}/empty" in r["error"] for r in status)


def test_session_settings(spark):
    session = create_session(extra={"spark.sql.shuffle.partitions": "8"}, s3a_endpoint="http://s:1")
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("spark.sql.adaptive.enabled") == "true"
    assert session.conf.get("spark.sql.shuffle.partitions") == "8"
    assert session.conf.get("spark.hadoop.fs.s3a.path.style.access") == "true"
    assert session.conf.get("spark.hadoop.fs.s3a.connection.ssl.enabled") == "false"


def test_topics_join_the_run(spark, stored_comments, tmp_path):
    topics = {"seed": 3, "min_documents": 0.05, "max_iter": 2}
    with pytest.raises(ValueError, match="CSV"):
        run_reports(stored_comments, str(tmp_path), "t", fmt="csv", topics=topics)
    paths = run_reports(stored_comments, str(tmp_path), "t", topics=topics)
    assert spark.read.parquet(paths["temas_lda"]).count() == 5

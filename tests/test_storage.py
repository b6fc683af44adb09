"""Scratch tables go with their scope."""

from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark import inheritable_thread_target

from commentscope.plans.full_run import run_reports
from commentscope.storage import new_dir, scratch, shared_dir, stored
from commentscope.sinks.tables import with_surrogate_id


def folders(spark):
    root = Path(shared_dir(spark).removeprefix("file:")) / "commentscope"
    return {p.name for p in root.iterdir()} if root.is_dir() else set()


def test_scope_removes_its_tables_only(spark):
    outside = stored(spark.range(3), "outside")
    before = folders(spark)
    with scratch(spark):
        within = stored(spark.range(5), "within")
        with scratch(spark):
            stored(spark.range(2), "inner")
        assert within.count() == 5  # the inner scope has ended
        with ThreadPoolExecutor(1) as pool:  # threads of a job are part of its scope
            pool.submit(inheritable_thread_target(spark)(lambda: stored(spark.range(4), "thread"))).result()
        assert len(folders(spark) - before) == 1
    assert folders(spark) == before
    assert outside.count() == 3
    assert "scope-" not in new_dir(spark, "after")


def test_scope_ends_by_an_error(spark):
    before = folders(spark)
    with pytest.raises(KeyError), scratch(spark):
        stored(spark.range(5), "within")
        raise KeyError
    assert folders(spark) == before


def test_numbering_and_topics_leave_nothing(spark, stored_comments, tmp_path):
    before = folders(spark)
    with scratch(spark):
        assert with_surrogate_id(spark.range(9), "run").count() == 9
        paths = run_reports(
            stored_comments, str(tmp_path), "r", topics={"seed": 1, "min_documents": 0.05, "max_iter": 1}
        )
        assert folders(spark) - before
    assert folders(spark) == before
    assert spark.read.parquet(paths["temas_lda"]).count() == 5

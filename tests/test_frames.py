"""Trailing frames in blocks equal those of one task."""

import contextlib
import io

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from commentscope import operators as O
from commentscope.operators.frames import trailing
from commentscope.plans import summary as S


def measures():
    return {"mean": F.avg("v"), "spread": F.stddev_samp("v"), "seen": F.count("v")}


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def series(spark):
    """Uneven steps, missing values, and a missing time."""
    rows = [(None if i == 0 else i * i, None if i % 11 == 5 else float(i * 37 % 101)) for i in range(200)]
    return spark.createDataFrame(rows, "t bigint, v double").repartition(7)


@pytest.mark.parametrize("rows", [0, 1, 24])
@pytest.mark.parametrize("block_rows", [1, 7, 24, 25, 199, 5000])
def test_any_number_of_blocks(series, rows, block_rows):
    frame = Window.orderBy("t").rowsBetween(-rows, 0)
    expected = series.select("*", *[m.over(frame).alias(n) for n, m in measures().items()])
    got = trailing(series, ["t"], rows, measures(), block_rows=block_rows)
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_empty_and_bad_arguments(series):
    assert trailing(series.limit(0), ["t"], 3, measures(), block_rows=5).collect() == []
    with pytest.raises(ValueError):
        trailing(series, ["t"], -1, measures(), block_rows=5)
    with pytest.raises(ValueError):
        trailing(series, ["t"], 1, measures(), block_rows=0)


def test_anomalies_in_blocks(stored_comments):
    hours = S.by_hour(stored_comments)
    expected = O.activity_anomalies(hours, threshold=1).collect()
    assert len(expected) > 10
    for block_rows in (10, 100):
        got = O.activity_anomalies(hours, threshold=1, block_rows=block_rows)
        assert "SinglePartition" not in plan(got)
        assert got.collect() == expected

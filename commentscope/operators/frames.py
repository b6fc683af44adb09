"""Trailing frames over all rows in an order, without one task that sees them all."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered

PLACE, BLOCK = "trailing_place", "trailing_block"


def trailing(
    df: DataFrame, order: list[str], rows: int, measures: Mapping[str, Column], *, block_rows: int
) -> DataFrame:
    """`df` with `measures` over each row and the `rows` rows before it in the order of `order`.

    Rows are numbered (`numbered` stores them), and numbers cut into blocks of `block_rows`. A row
    goes to its own block and to the later ones whose frames reach back to it, so that each block
    is a window partition of at most `block_rows + rows` rows. The result does not depend on
    `block_rows` if `order` tells all rows apart.
    """
    if rows < 0 or block_rows < 1:
        raise ValueError("a frame needs rows >= 0 and block_rows >= 1")
    number = F.col(PLACE) - 1
    first, last = F.floor(number / block_rows), F.floor((number + rows) / block_rows)
    dealt = numbered(df, order, PLACE).withColumn(BLOCK, F.explode(F.sequence(first, last)))
    frame = Window.partitionBy(BLOCK).orderBy(PLACE).rowsBetween(-rows, Window.currentRow)
    measured = dealt.select("*", *[m.over(frame).alias(name) for name, m in measures.items()])
    return measured.where(F.col(BLOCK) == first).drop(PLACE, BLOCK)

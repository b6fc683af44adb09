"""A training corpus from raw documents: five stages, each one operator of `commentscope.llm`.

Every stage gets the documents that the one before it kept, as a stored table, and returns the
columns of `documents`; the last one returns packed sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commentscope.llm.common import stored, table
from commentscope.llm.decontaminate import mark_leaks
from commentscope.llm.jaccard import near_duplicate_groups
from commentscope.llm.language import UNKNOWN, bit_limits, fit, identify, within_limits
from commentscope.llm.line_templates import SHORT_DOCUMENTS, drop_recurring_lines
from commentscope.llm.packing import pack_documents
from commentscope.llm.queries import with_package

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A language whose share is less than this is not told apart from the others.
MIN_SCORE = 0.5


def _packed(docs: DataFrame) -> DataFrame:
    """Documents as one column, whose names cannot meet those of an operator, and the text."""
    return docs.select(F.struct("*").alias("row"), "text")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the labelled ones. Texts without a letter go, and texts that cost
    clearly more bits a symbol than all labelled texts of their length."""
    model = fit(docs)
    judged = identify(_packed(docs), model, keep=["row"], bits="bits")
    clear = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= MIN_SCORE)
    limits = F.broadcast(bit_limits(docs, model))
    return (
        judged.where(clear)
        .join(limits, "lang_pred", "left")
        .where(within_limits("row.text", "bits"))
        .select("row.*")
    )


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without their recurring lines; `n_chars` follows the text."""
    # The other columns are one, whose name cannot meet those of the operator; the text, which is
    # shuffled with them, is not repeated in it.
    others = [n for n in docs.columns if n.lower() != "text"]
    packed = docs.select(F.struct(*[F.col(f"`{n}`") for n in others]).alias("row"), "text")
    cleaned = drop_recurring_lines(packed, short_documents=SHORT_DOCUMENTS, judge_copies=True)
    row = F.col("row")
    if "n_chars" in others:
        chars = F.length("text").cast(dict(docs.dtypes)["n_chars"])
        row = F.when(F.col("n_dropped") > 0, row.withField("n_chars", chars)).otherwise(row)
    return cleaned.select(row.alias("row"), "text").select(
        *[F.col("row")[n].alias(n) if n in others else F.col("text").alias(n) for n in docs.columns]
    )


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least key of each group. Of rows that repeat each other, key and
    text, one stays."""
    groups = stored(near_duplicate_groups(docs), "groups")
    first = groups.where(F.col("component_id").eqNullSafe(F.col("doc_id")))
    kept = first.select(F.col("doc_id").alias("kept_id")).distinct()
    least = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    repeated = first.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    return least if repeated.isEmpty() else least.dropDuplicates(["doc_id", "text"])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    marked = mark_leaks(_packed(docs), table(spark, sf_dir, "benchmark"), keep=["row"])
    return marked.where(F.size("leaks") == 0).select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return pack_documents(spark, docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# Models, packing and string tiling are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs

"""Comments derived from the driver's test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import COMMENTS


# Declared, so that a read needs no job to look at file footers.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "documents": "doc_id bigint, text string",
    "labels": "doc_id bigint, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, column: str) -> DataFrame:
    """Give every core a share of an input too small to have that many splits."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, column) if df.rdd.getNumPartitions() < cores else df


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comment per event, with the text of a document and the toxicity label as NSFW flag.

    The number of documents enters as a literal: as a joined value it would turn the join with
    the documents into a nested loop as soon as the text is filtered.
    """
    documents = table(spark, sf_dir, "documents")
    n_documents = documents.count()
    number = F.col("event_id")
    events = table(spark, sf_dir, "events").withColumn("doc_id", number % n_documents)

    columns = {
        "type": F.lit("comment"),
        "id": number.cast("string"),
        "subreddit_id": (F.col("user_id") % 20).cast("string"),
        "subreddit_name": F.col("event_type"),
        "subreddit_nsfw": F.col("toxic") == 1,
        "created_utc": F.unix_timestamp(F.col("ts").cast("timestamp")),
        "permalink": F.concat(F.lit("/c/"), number.cast("string")),
        "body": F.when(number % 101 != 0, F.col("text")),
        "sentiment": F.when(
            number % 97 != 0, ((number * 37) % 201 - 100).cast("double") / F.lit(100)
        ),
        "score": F.when(number % 89 != 0, (number * 53) % 307 - 100),
    }
    return (
        spread(events, "doc_id")
        .join(spread(documents, "doc_id"), "doc_id")
        .join(table(spark, sf_dir, "labels"), "doc_id", "left")
        .select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in COMMENTS])
    )

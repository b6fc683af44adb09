"""Landing with an account of bad rows: what does not fit the declared columns is kept apart."""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import COMMENTS, RAW_COMMENTS
from .comments import CSV_OPTIONS, RECURSIVE, STORED, _one_file

# What can be wrong with a record; the first that applies counts.
UNCLOSED_QUOTE = "unclosed_quote"
SHORT_ROW = "short_row"
LONG_ROW = "long_row"
BAD_VALUE = "bad_value"
KINDS = (UNCLOSED_QUOTE, SHORT_ROW, LONG_ROW, BAD_VALUE)

ACCEPTED, REJECTED = "accepted", "rejected"

RECORD = "_record"

# A rejected record: its comment as far as it parses, what is wrong, in which columns, and where.
REJECTS = T.StructType(
    [
        *COMMENTS.fields,
        T.StructField("kind", T.StringType()),
        T.StructField("bad_columns", T.ArrayType(T.StringType())),
        T.StructField("record", T.StringType()),
        T.StructField("file", T.StringType()),
    ]
)


@dataclass(frozen=True)
class Landing:
    """Stored comments, and the records that were rejected."""

    comments: DataFrame
    rejects: DataFrame

    def account(self) -> DataFrame:
        """`kind`, `records`: how many records were accepted, and rejected of each kind."""
        accepted = self.comments.agg(F.lit(ACCEPTED).alias("kind"), F.count("*").alias("records"))
        return accepted.unionByName(
            self.rejects.groupBy("kind").agg(F.count("*").alias("records"))
        )


def _kind(record: Column) -> Column:
    """What is wrong with a record that did not parse. Commas within quotes part no fields;
    a doubled quote within a field closes one pair and opens the next."""

    def times(text: Column, sign: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))

    commas = times(F.regexp_replace(record, '"[^"]*"', ""), ",") + 1
    return (
        F.when(times(record, '"') % 2 == 1, UNCLOSED_QUOTE)
        .when(commas < len(COMMENTS), SHORT_ROW)
        .when(commas > len(COMMENTS), LONG_ROW)
        .otherwise(BAD_VALUE)
    )


def read_checked(spark: SparkSession, path: str) -> DataFrame:
    """All records of comment CSV with the columns of a reject. `kind` is NULL for good ones.

    `bad_columns` names the columns whose text gives no value of the declared type.
    """
    schema = T.StructType([*RAW_COMMENTS.fields, T.StructField(RECORD, T.StringType())])
    read = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, columnNameOfCorruptRecord=RECORD)
        .options(mode="PERMISSIVE", **CSV_OPTIONS, **RECURSIVE)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("file"))
        .toDF(*COMMENTS.fieldNames(), "record", "file")
    )
    # The record once more, as text, shows which values were given and lost.
    as_text = ", ".join(f"{name} string" for name in COMMENTS.fieldNames())
    given = F.from_csv("record", as_text, CSV_OPTIONS)
    lost = F.array_compact(
        F.array(
            *[
                F.when((given[f.name] != "") & F.col(f.name).isNull(), f.name)
                for f in COMMENTS
                if f.dataType != T.StringType()
            ]
        )
    )
    bad = F.col("record").isNotNull()
    return read.select(
        *COMMENTS.fieldNames(),
        F.when(bad, _kind(F.col("record"))).alias("kind"),
        F.when(bad, lost).alias("bad_columns"),
        "record",
        F.when(bad, F.col("file")).alias("file"),
    )


def land_checked(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    file_name: str | None = None,
    reject: Collection[str] = KINDS,
) -> Landing:
    """Store comment CSV as Parquet below `target`: comments, and apart from them the records with
    a defect that `reject` lists. Other defects are accepted, with NULL for what does not parse.

    The CSV is parsed once: one write deals all records to a folder each for accepted and rejected
    ones, so accepted and rejected records together are all records. Files as in `land_raw`.
    """
    if unknown := set(reject) - set(KINDS):
        raise ValueError(f"no such defect: {', '.join(sorted(unknown))}")
    if file_name is not None:
        source = _one_file(spark, source, file_name)
    rejected = F.coalesce(F.col("kind").isin(*reject), F.lit(False)) if reject else F.lit(False)
    (
        read_checked(spark, source)
        .withColumn("outcome", F.when(rejected, REJECTED).otherwise(ACCEPTED))
        .write.mode("overwrite")
        .partitionBy("outcome")
        .options(**STORED)
        .parquet(target)
    )
    return landed(spark, target)


def landed(spark: SparkSession, target: str) -> Landing:
    """What an earlier `land_checked` stored at `target`."""
    stored = spark.read.schema(T.StructType([*REJECTS.fields, T.StructField("outcome", T.StringType())]))
    rows = stored.parquet(target)
    return Landing(
        rows.where(F.col("outcome") == ACCEPTED).select(*COMMENTS.fieldNames()),
        rows.where(F.col("outcome") == REJECTED).drop("outcome"),
    )

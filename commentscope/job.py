"""The whole job for spark-submit: land raw comments, run the reports, publish tables and views.

Tables in a catalog are published in versions: running the job again for the same --run replaces
its rows, also in tables that grow by --append. Views for dashboards stay in the catalog.

    spark-submit --py-files commentscope.zip commentscope/job.py \\
        --raw s3a://bucket/raw --file comments.csv --base s3a://bucket/out --database serving

Without --raw, the comments landed by an earlier run are used again.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from commentscope import schemas
from commentscope.operators import create_views
from commentscope.plans.full_run import publish_run, register_result_views, run_reports
from commentscope.session import create_session
from commentscope.sinks import jdbc_writer, version_writer
from commentscope.sources import land_checked, land_raw, landed
from commentscope.storage import scratch


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Comment reports from raw CSV to tables")
    parser.add_argument("--base", required=True, help="folder of landed comments and results")
    parser.add_argument("--run", default="comments", help="name of the run, part of every path")
    parser.add_argument("--raw", help="raw CSV file, folder or dataset to land first")
    parser.add_argument("--file", help="name of the one file of the dataset to land")
    parser.add_argument("--check-rows", action="store_true", help="keep bad rows apart, and count them")
    parser.add_argument("--format", default="parquet", help="format of the stored results")
    parser.add_argument("--database", help="catalog database to publish into")
    parser.add_argument("--jdbc-url", help="database address to publish into, instead of a catalog")
    parser.add_argument("--append", nargs="*", default=[], help="tables that grow by appending")
    parser.add_argument("--surrogate-id", action="store_true", help="number the published rows")
    parser.add_argument("--topics-seed", type=int, help="also fit topics, with this seed")
    parser.add_argument("--shuffle-partitions", type=int, default=400)
    parser.add_argument("--s3a-endpoint")
    return parser.parse_args(argv)


def run_job(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    """Run the job; returns the publishing status where tables were asked for. Scratch tables of
    the job are gone when it returns."""
    with scratch(spark):
        return _run_job(spark, args)


def _run_job(spark: SparkSession, args: argparse.Namespace) -> DataFrame | None:
    base = args.base.rstrip("/")
    landed_at = f"{base}/bronze/{args.run}"
    if args.check_rows:
        if args.raw:
            landing = land_checked(spark, args.raw, landed_at, file_name=args.file)
        else:
            landing = landed(spark, landed_at)
        landing.account().show(truncate=False)
        comments = landing.comments
    elif args.raw:
        comments = land_raw(spark, args.raw, landed_at, file_name=args.file)
    else:
        comments = spark.read.schema(schemas.COMMENTS).parquet(landed_at)

    topics = None if args.topics_seed is None else {"seed": args.topics_seed}
    paths = run_reports(comments, base, args.run, fmt=args.format, topics=topics)
    if args.jdbc_url:
        write = jdbc_writer(args.jdbc_url)
    elif args.database:
        write = version_writer(args.database, args.run)
    else:
        register_result_views(spark, paths, args.format)
        return None
    modes = {table: "append" for table in args.append}
    status = publish_run(
        spark, write, paths=paths, run_name=args.run, fmt=args.format, modes=modes,
        surrogate_id=args.surrogate_id,
    )
    if args.database and not args.jdbc_url:
        create_views(spark, args.database)
    return status


def main() -> None:
    args = arguments()
    spark = create_session(
        shuffle_partitions=args.shuffle_partitions, s3a_endpoint=args.s3a_endpoint
    )
    status = run_job(spark, args)
    if status is not None:
        status.show(truncate=False)
        if status.where("status = 'failed'").count():
            raise SystemExit(1)


if __name__ == "__main__":
    main()

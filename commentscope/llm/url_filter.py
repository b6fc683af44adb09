"""Op 1, URL filters: block and allow entries for hosts and path prefixes, longest match first.

Method: a trie over reversed host labels, and below each host over path segments, is broadcast
and walked once per URL. An entry fits its host and all its subdomains if the URL's path starts
with the entry's path. Of the entries that fit, the one with the most host labels wins, then the
one with the longest path; where the same entry is both allowed and blocked, block wins.

Entry lists whose text is larger than `MAX_TRIE_BYTES` are not broadcast: the same match is then
a join on (host suffix, path directory).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MAX_TRIE_BYTES = 16 << 20

# Copies of each entry in the join; the URLs of one host are dealt over them.
SALTS = 16

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    """An entry: `host` without a trailing dot, `path` empty or starting with a slash."""

    host: str
    path: str
    verdict: str


RULES_SCHEMA = "host string, path string, verdict string"


def url_host(url: Column) -> Column:
    """What follows the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


class Trie:
    """Entries by reversed host labels, then by path directories and the rest behind the last
    slash, which may be a part of a segment."""

    def __init__(self, rules: list[Rule]):
        self._hosts: dict = {}
        for rule in rules:
            node = self._hosts
            for label in reversed(rule.host.split(".")):
                node = node.setdefault(("label", label), {})
            *directories, rest = rule.path.split("/")
            for name in directories:
                node = node.setdefault(("directory", name), {})
            known = node.setdefault("rests", {}).get(rest)
            if known is None or rule.verdict == "block":
                node["rests"][rest] = rule
            node["lengths"] = sorted({len(r) for r in node["rests"]}, reverse=True)

    def _by_path(self, node: dict, path: str) -> Rule | None:
        """The entry below a host with the longest path that `path` starts with."""
        best, at = None, 0
        while node is not None:
            rests = node.get("rests", {})
            for length in node.get("lengths", ()):
                rule = rests.get(path[at : at + length])
                if rule is not None and at + length <= len(path):
                    best = rule
                    break
            slash = path.find("/", at)
            if slash < 0:
                break
            node = node.get(("directory", path[at:slash]))
            at = slash + 1
        return best

    def match(self, host: str, path: str) -> Rule | None:
        best, node = None, self._hosts
        for label in reversed(host.split(".")):
            node = node.get(("label", label))
            if node is None:
                break
            best = self._by_path(node, path) or best
        return best


def _checked(rules: DataFrame) -> DataFrame:
    """Entries ready to match: nulls out, hosts lowered, the right form asserted."""
    host = F.translate("host", UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    right = (
        (host != "")
        & F.col("verdict").isin("allow", "block")
        & ((path == "") | path.startswith("/"))
    )
    broken = F.raise_error(F.concat(F.lit("not an entry: "), F.to_json(F.struct("*"))))
    return rules.where(F.col("host").isNotNull()).select(
        F.when(F.coalesce(right, F.lit(False)), host).otherwise(broken).alias("host"),
        path.alias("path"),
        "verdict",
    )


def _with_trie(urls: DataFrame, rules: list[Rule], default: str) -> DataFrame:
    trie = urls.sparkSession.sparkContext.broadcast(Trie(rules))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            found = [trie.value.match(h, p) for h, p in zip(hosts, paths)]
            rule = pa.array([r and r.host + r.path for r in found], pa.string())
            verdict = pa.array([r.verdict if r else default for r in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("host"), batch.column("path"), rule, verdict],
                ["key", "host", "path", "rule", "verdict"],
            )

    kind = dict(urls.dtypes)["key"]
    return urls.mapInArrow(
        judge, f"key {kind}, host string, path string, rule string, verdict string"
    )


def _with_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same match for entry lists of any size. A URL asks for each of its host suffixes and
    path directories; entries are keyed by host and directory, and the rest is compared."""
    entries = (
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block is behind allow
        .select(
            F.col("host").alias("suffix"),
            F.regexp_extract("path", r"(?s)^(.*/)?", 1).alias("directory"),
            "path",
            "verdict",
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
        )
        .withColumnRenamed("path", "entry")
    )
    labels = F.split("host", r"\.")
    asked = (
        urls.withColumn("row", F.monotonically_increasing_id())
        .withColumn("salt", (F.col("row") % SALTS).cast("int"))
        .withColumn("labels", labels)
        .withColumn(
            "suffix",
            F.explode(
                F.transform(
                    F.sequence(F.lit(1), F.size("labels")),
                    lambda i: F.array_join(
                        F.slice(F.col("labels"), i, F.size("labels") - i + 1), "."
                    ),
                )
            ),
        )
        .withColumn("parts", F.split("path", "/"))
        .withColumn(
            "directory",
            F.explode(
                F.transform(
                    F.sequence(F.lit(0), F.size("parts") - 1),
                    lambda i: F.when(i == 0, F.lit("")).otherwise(
                        F.concat(F.array_join(F.slice(F.col("parts"), F.lit(1), i), "/"), F.lit("/"))
                    ),
                )
            ),
        )
        .drop("labels", "parts")
    )
    fits = F.col("path").startswith(F.col("entry"))
    best = F.max_by(
        F.when(fits, F.struct(F.concat("suffix", "entry").alias("rule"), "verdict")),
        F.when(fits, F.struct(F.size(F.split("suffix", r"\.")), F.length("entry"))),
    )
    return (
        asked.join(entries, ["suffix", "directory", "salt"], "left")
        .groupBy("row", "key", "host", "path")
        .agg(best.alias("best"))
        .select(
            "key",
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
    max_trie_bytes: int = MAX_TRIE_BYTES,
) -> DataFrame:
    """Host, path, winning entry and verdict of every row: `key`, `host`, `path`, `rule`, `verdict`.

    `rules` has `host`, `path` and `verdict` (allow or block). Rows are kept as they are, repeated
    ones too. A null URL, or one without `://`, has an empty host and path. Where no entry fits,
    `rule` is null and the verdict is `default`. Entries without a host are passed over; others
    that are not of this form raise. Other columns of `pages` are not read.
    """
    urls = pages.select(
        F.col(key).alias("key"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    rules = _checked(rules)
    size = rules.agg(
        F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 100), F.lit(0))
    ).first()[0]
    if size <= max_trie_bytes:
        judged = _with_trie(urls, [Rule(*row) for row in rules.collect()], default)
    else:
        judged = _with_join(urls, rules, default)
    return judged.withColumnRenamed("key", key)


# The entries that the query's contract states.
QUERY_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(QUERY_RULES, RULES_SCHEMA)
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = """
WITH rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), urls AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), fitting AS (
  SELECT u.*, r.rule_host || r.rule_path AS rule, r.verdict,
         row_number() OVER (PARTITION BY u.page_id, u.host, u.path
                            ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC) AS place
  FROM urls u LEFT JOIN rules r
    ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host))
   AND starts_with(u.path, r.rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM fitting WHERE place = 1
"""

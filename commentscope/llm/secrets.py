"""Op 7, secret scans: sure patterns, and weak candidates that complementary parts confirm.

Method: multipart credential linking. Besides the sure patterns, a text is scanned for weak parts:
access identifiers (`client_id: x`), secrets (long mixed tokens) and endpoints (URLs). Within
scopes, stretches of a few lines, an interval join pairs the parts. A weak secret is
reported only where an identifier or an endpoint stands in its scope, and the weak identifiers and
endpoints only beside a secret there, sure or weak.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, table

# The sure patterns, as the query's contract states them. Letters of the keyword
# are in either case, ASCII only.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")

# Weak parts.
IDENTIFIER = re.compile(
    r"""\b(?:user(?:_?name)?|login|client_?id|account(?:_?id)?|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@+/_.-]{3,})""",
    re.IGNORECASE | re.ASCII,
)
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]*://[^\s\"'<>]+", re.ASCII)
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
WEAK_KINDS = ("identifier", "weak_secret", "endpoint")
KINDS = BASE_KINDS + WEAK_KINDS

# Parts belong together if no more than this many characters and line breaks stand between them.
SCOPE_CHARS = 400
SCOPE_LINES = 5


class Span(NamedTuple):
    start: int
    kind: int  # place in KINDS
    end: int


def base_spans(text: str) -> list[Span]:
    """Sure secrets, leftmost and non-overlapping per kind."""
    found = []
    for kind, pattern in enumerate((ASSIGN, ACCESS, HEX)):
        for m in pattern.finditer(text):
            if (kind == 0 and len(m[2]) < 6) or (kind == 1 and len(m[0]) < 20):
                continue
            found.append(Span(m.start(), kind, m.end()))
    return sorted(found)


def _is_mixed(token: str) -> bool:
    return (
        any(c.isdigit() for c in token)
        and any(c.islower() for c in token)
        and any(c.isupper() for c in token)
    )


class _Scopes:
    """Interval join: which spans of one list stand near a span of another."""

    def __init__(self, text: str):
        self._breaks = [m.start() for m in re.finditer("\n", text)]

    def near(self, a: Span, b: Span) -> bool:
        first, second = (a, b) if a.start <= b.start else (b, a)
        gap = second.start - first.end
        lines = bisect_left(self._breaks, second.start) - bisect_left(self._breaks, first.end)
        return gap <= SCOPE_CHARS and lines <= SCOPE_LINES

    def joined(self, left: list[Span], right: list[Span]) -> list[Span]:
        """Spans of `left` with a near span in `right`, which is sorted. The closest ones decide:
        of those that start before, the one that reaches farthest, and the first behind."""
        starts = [s.start for s in right]
        reaching = list(accumulate(right, lambda a, b: b if b.end > a.end else a))
        kept = []
        for span in left:
            at = bisect_right(starts, span.start)
            closest = reaching[at - 1 : at] + right[at : at + 1] if at else right[:1]
            if any(self.near(span, other) for other in closest):
                kept.append(span)
        return kept


class _Taken:
    """Whether a place is free of some spans, which may hold one another."""

    def __init__(self, spans: list[Span]):
        self._starts = [s.start for s in spans]
        self._reach = list(accumulate((s.end for s in spans), max))

    def free(self, start: int, end: int) -> bool:
        before = bisect_left(self._starts, end)
        return not before or self._reach[before - 1] <= start


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that complementary parts confirm. `base` is sorted, as `base_spans` gives it."""
    taken = _Taken(base)
    identifiers = [
        Span(m.start(), 3, m.end()) for m in IDENTIFIER.finditer(text) if taken.free(*m.span())
    ]
    access = [s for s in base if s.kind == 1]
    endpoints = (
        [Span(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)] if "://" in text else []
    )
    if not identifiers and not access and not endpoints:
        return []
    scopes, inside = _Scopes(text), _Taken(endpoints)
    weak = [
        Span(m.start(), 4, m.end())
        for m in MIXED.finditer(text)
        if _is_mixed(m[0]) and taken.free(*m.span()) and inside.free(*m.span())
    ]
    partners = [identifiers, access, endpoints]
    secrets = sorted({s for p in partners if p for s in scopes.joined(weak, p)})
    sure = [s for s in base if s.kind in (0, 2)]
    found = list(secrets)
    for parts in (identifiers, endpoints):
        confirmed = {s for other in (secrets, sure) if other for s in scopes.joined(parts, other)}
        found += sorted(confirmed)
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in sorted(spans))


def scan_secrets(documents: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row with the spans of its secrets: `key`, `base` and `spans`, arrays of
    (kind, start, end) by start, then kind. Places are code points, the end is exclusive.

    Null texts are empty and have no spans. Rows are kept as they are, repeated ones too; other
    columns of `documents` are not read.
    """
    kind = documents.select(key).dtypes[0][1]
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def rows(spans: list[Span]) -> list[dict]:
        return [{"kind": KINDS[s.kind], "start": s.start, "end": s.end} for s in sorted(spans)]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            base, every = [], []
            for value in batch.column("text").to_pylist():
                sure = base_spans(value or "")
                base.append(rows(sure))
                every.append(rows(sure + linked_spans(value or "", sure)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(base, span), pa.array(every, span)],
                ["key", "base", "spans"],
            )

    spans = "array<struct<kind: string, start: bigint, end: bigint>>"
    return (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(scan, f"key {kind}, base {spans}, spans {spans}")
        .withColumnRenamed("key", key)
    )


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def joined(spans: str):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE_KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )

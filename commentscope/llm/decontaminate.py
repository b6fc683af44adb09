"""Op 5, benchmark decontamination by greedy string tiling.

Method: documents and benchmark items are joined on shared seeds, hashes of `min_match` words in a
row. For each pair with enough shared seeds, the longest matches that overlap no earlier one are
marked again and again, found by running Karp-Rabin hashes; a mark is a tile. An item leaks into a
document if its tiles cover the share `coverage` of its words, in whatever order they stand there.

The benchmark is the stated query set: its seeds are broadcast in blocks of at most `BLOCK_BYTES`
of text, one pass over the documents per block, so no side is shuffled. Between two passes the
documents are stored, so executors hold one block at a time, however large the benchmark is.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, steps, stored, table

MIN_MATCH = 5
COVERAGE = 0.8
BLOCK_BYTES = 16 << 20

_PRIME = (1 << 61) - 1
_BASE = 0x1F3D5B79


def running_hashes(words: list[int], size: int) -> list[int]:
    """Karp-Rabin hashes of all windows of `size` words, each from the one before it."""
    if len(words) < size:
        return []
    top = pow(_BASE, size - 1, _PRIME)
    value = 0
    for word in words[:size]:
        value = (value * _BASE + word) % _PRIME
    hashes = [value]
    for old, new in zip(words, words[size:]):
        value = ((value - old * top) * _BASE + new) % _PRIME
        hashes.append(value)
    return hashes


def tiles(item: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (place in item, place in text, length), longest first.

    Of matches of one length, the first in the item, then in the text, is marked first.
    """
    marked_item, marked_text = [False] * len(item), [False] * len(text)
    found: list[tuple[int, int, int]] = []

    def length(i: int, j: int) -> int:
        k = 0
        while (
            i + k < len(item)
            and j + k < len(text)
            and item[i + k] == text[j + k]
            and not marked_item[i + k]
            and not marked_text[j + k]
        ):
            k += 1
        return k

    def matches(size: int) -> list[tuple[int, int, int]]:
        at: dict[int, list[int]] = defaultdict(list)
        for j, value in enumerate(running_hashes(text, size)):
            if not marked_text[j]:
                at[value].append(j)
        some = []
        for i, value in enumerate(running_hashes(item, size)):
            if marked_item[i]:
                continue
            for j in at.get(value, ()):
                k = length(i, j)
                if k >= size:
                    some.append((-k, i, j))
        return sorted(some)

    size = max(len(item), min_match)
    while True:
        some = matches(size)
        for k, i, j in some:
            # A longer tile may have marked a part of it; the next scan finds what is left.
            if length(i, j) >= -k:
                found.append((i, j, -k))
                marked_item[i : i - k] = [True] * -k
                marked_text[j : j - k] = [True] * -k
        if some:
            continue
        if size == min_match:
            return found
        size = max(size // 2, min_match)


class Seeds:
    """Benchmark items of a block: their words, and which items hold each seed."""

    def __init__(self, ids: list, texts: list[str], min_match: int):
        words = Words(pa.array(texts, pa.string()))
        self.ids = ids
        self.items = [words.hashes[a:b].tolist() for a, b in zip(words.first, words.first[1:])]
        hashes, first = words.shingles(min_match)
        owner = np.repeat(np.arange(len(ids)), np.diff(first))
        long = np.array([len(i) >= min_match for i in self.items], bool)[owner]
        hashes, owner = hashes[long], owner[long]
        order = np.argsort(hashes, kind="stable")
        self.hashes, start = np.unique(hashes[order], return_index=True)
        self.owners = np.split(owner[order], start[1:])
        self._may = np.zeros(1 << 20, bool)
        self._may[self.hashes >> np.uint64(44)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the hashes that are seeds, and which seeds they are."""
        at = np.flatnonzero(self._may[hashes >> np.uint64(44)])
        if not len(at) or not len(self.hashes):
            return at[:0], at[:0]
        seed = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        same = self.hashes[seed] == hashes[at]
        return at[same], seed[same]


def leaks_of(words: np.ndarray, at: np.ndarray, seed: np.ndarray, seeds: Seeds, min_match: int, coverage: float) -> list[dict]:
    """Items that leak into a text with these words, whose seeds stand at `at`."""
    places: dict[int, list[int]] = defaultdict(list)
    for place, which in zip(at.tolist(), seed.tolist()):
        for owner in np.unique(seeds.owners[which]).tolist():
            places[owner].append(place)
    found = []
    for owner, starts in sorted(places.items()):
        item = seeds.items[owner]
        # All matches lie where the item's seeds are; gaps become words that match nothing.
        text: list[int] = []
        end = -1
        for place in starts:
            if end >= 0 and place > end:
                text.append(-1 - len(text))
            text.extend(words[max(place, end) : place + min_match].tolist())
            end = place + min_match
        if len(text) < coverage * len(item):
            continue
        marked = tiles(item, text, min_match)
        covered = sum(k for _, _, k in marked)
        if covered >= coverage * len(item):
            found.append(
                {
                    "item": seeds.ids[owner],
                    "item_words": len(item),
                    "covered": covered,
                    "tiles": len(marked),
                }
            )
    return found


def mark_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    keep: list[str],
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns `keep` of every row with `leaks`, an array of the items that leak into it:
    (item, item_words, covered, tiles).

    Items with a null text or fewer than `min_match` words never leak; null and empty texts hold
    no leaks. Repeated items count one by one, repeated documents each on their own. A kept column
    `leaks` is replaced. Texts of any length are tiled whole; of matches of one length, the one that
    starts first in the item is marked first, then the one that starts first in the text.
    """
    items = benchmark.where(F.col(item_text).isNotNull()).select(
        F.col(item_key).alias("id"), F.col(item_text).alias("text")
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = -(-size // block_bytes)
    id_type = dict(items.dtypes)["id"]
    leak = f"array<struct<item: {id_type}, item_words: bigint, covered: bigint, tiles: bigint>>"
    # What is kept travels as one column, so that no name meets another.
    marked = documents.select(
        F.struct(*keep).alias("kept"),
        F.col(text).alias("text"),
        F.array().cast(leak).alias("leaks"),
    )
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block)
        rows = own.orderBy("id", "text").collect()
        seeds = documents.sparkSession.sparkContext.broadcast(
            Seeds([r["id"] for r in rows], [r["text"] for r in rows], min_match)
        )
        marked = _mark_block(marked, seeds, min_match, coverage)
        if block < blocks - 1:
            marked = stored(marked, "marked")
            seeds.unpersist()
    return marked.select(
        *[F.col("kept")[name].alias(name) for name in keep if name != "leaks"], "leaks"
    )


def _mark_block(documents: DataFrame, shared: Broadcast, min_match: int, coverage: float) -> DataFrame:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            words = Words(batch.column("text"))
            hashes, first = words.shingles(min_match)
            at, seed = shared.value.hits(hashes)
            column = batch.schema.get_field_index("leaks")
            if not len(at):
                yield batch
                continue
            leaks = batch.column(column).to_pylist()
            owner = np.searchsorted(first, at, "right") - 1
            for row in np.unique(owner).tolist():
                own = owner == row
                leaks[row] += leaks_of(
                    words.hashes[words.first[row] : words.first[row + 1]],
                    at[own] - first[row], seed[own], shared.value, min_match, coverage,
                )
            field = batch.schema.field(column)
            yield batch.set_column(column, field, pa.array(leaks, field.type))

    schema = ", ".join(f"`{n}` {t}" for n, t in documents.dtypes)
    return documents.mapInArrow(mark, schema)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a document and a benchmark item that leaks into it."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return (
        mark_leaks(documents, benchmark, keep=["doc_id"])
        .select("doc_id", F.explode("leaks").alias("leak"))
        .select(
            "doc_id",
            F.col("leak.item").alias("item_id"),
            F.col("leak.item_words").alias("item_words"),
            F.col("leak.covered").alias("covered_words"),
            F.col("leak.tiles").alias("n_tiles"),
            (F.col("leak.covered") / F.col("leak.item_words")).alias("coverage"),
        )
    )

"""Op 13, periodic runs of words, by internal pattern matching.

Method: the words of a few texts are one sequence in which each text has an alphabet of its own.
Doubling gives each place a rank for the 2**k words from it; the last ranks are the suffix array,
in which the places of equal blocks are neighbours, and the ranks of all orders compare two places
by binary descent. A run of period q holds a dyadic block in its first q words whose copy stands q
words later, so every block asks for its copies in the window of distances that its order is in
charge of: a range successor query on a wavelet tree over the suffix array. Copies that overlap by
half are a progression, whose difference is the period of the block; its members are listed by
arithmetic up to the end of the run they stand in. Each distance so found is a candidate period,
extended to both sides as far as it holds; equal runs count once, under their smallest period.

A text is one unit of work: tasks hold the words of about `STEP_BYTES` of text at once, or of one
longer text, with a few hundred bytes a word. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, table, words_of

# Runs shorter than this do not count, whatever their period.
MIN_LENGTH = 12

# Words of the smallest blocks, which stand at every second word; larger ones stand side by side.
SMALLEST = 4

# Candidates that are extended at once.
CHUNK = 1 << 20

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"

# Given the keys of a few texts and where the words of each start, the word that each becomes.
Rewrite = Callable[[list, np.ndarray], np.ndarray]


class Ranks:
    """Rank of the 2**k symbols from each place, for each k while two of them are equal."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        held = symbols[order]
        new = np.append(True, held[1:] != held[:-1])
        heads = np.flatnonzero(new)
        sizes = np.diff(np.append(heads, n))
        rank = np.empty(n, np.int32)
        rank[order] = np.repeat(heads, sizes)
        self.size, self.orders = n, [rank]
        open_ = order[np.repeat(sizes > 1, sizes)]
        step = 1
        while len(open_):
            rank = self.orders[-1]
            follows = np.zeros(len(open_), np.int64)
            has = open_ + step < n
            follows[has] = rank[open_[has] + step] + 1
            key = rank[open_] * np.int64(n + 1) + follows
            order = np.argsort(key, kind="stable")
            open_, key = open_[order], key[order]
            old = rank[open_]
            places = np.arange(len(open_))
            new = np.append(True, key[1:] != key[:-1])
            heads = np.flatnonzero(new)
            sizes = np.diff(np.append(heads, len(open_)))
            first_of_old = np.maximum.accumulate(
                np.where(np.append(True, old[1:] != old[:-1]), places, 0)
            )
            rank = rank.copy()
            rank[open_] = old + (np.repeat(heads, sizes) - first_of_old)
            self.orders.append(rank)
            open_ = open_[np.repeat(sizes > 1, sizes)]
            step *= 2

    def suffixes(self) -> np.ndarray:
        array = np.empty(self.size, np.int64)
        array[self.orders[-1]] = np.arange(self.size)
        return array

    def common_right(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Equal symbols from `left` and from `right` on, where left < right."""
        at, length = right.copy(), np.zeros(len(right), np.int64)
        for k in range(len(self.orders) - 1, -1, -1):
            rank, step = self.orders[k], 1 << k
            same = at + step <= self.size
            place = np.where(same, at, 0)
            same &= rank[place] == rank[np.where(same, left + length, 0)]
            same &= place != 0
            at += step * same
            length += step * same
        return length

    def common_left(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Equal symbols before `left` and before `right`, where left < right."""
        length = np.zeros(len(right), np.int64)
        for k in range(len(self.orders) - 1, -1, -1):
            rank, step = self.orders[k], 1 << k
            begin = left - length - step
            same = begin >= 0
            same &= rank[np.where(same, begin, 0)] == rank[np.where(same, right - length - step, 1)]
            length += step * same
        return length


class WaveletTree:
    """Range successor queries over an array of the numbers 0 to n - 1."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros = []
        for bit in range(self.bits - 1, -1, -1):
            low = (values >> bit & 1) == 0
            counted = np.zeros(len(values) + 1, np.int32)
            np.cumsum(low, out=counted[1:])
            self.zeros.append(counted)
            values = np.concatenate([values[low], values[~low]])

    def successor(self, first: np.ndarray, last: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest number of at least `least` in values[first:last]; -1 where there is none."""
        low, high, below = first.copy(), last.copy(), np.zeros(len(first), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            one = (least >> bit & 1).astype(bool)
            a, b = zeros[low], zeros[high]
            below += np.where(one, b - a, 0)
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
        some = (below < last - first) & (least < 1 << self.bits)
        low, high, left = first.copy(), last.copy(), np.where(some, below, 0)
        found = np.zeros(len(first), np.int64)
        for zeros, bit in zip(self.zeros, range(self.bits - 1, -1, -1)):
            a, b = zeros[low], zeros[high]
            one = left >= b - a
            left -= np.where(one, b - a, 0)
            low = np.where(one, zeros[-1] + low - a, a)
            high = np.where(one, zeros[-1] + high - b, b)
            found |= one.astype(np.int64) << bit
        return np.where(some, found, -1)


def _candidates(ranks: Ranks, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and distances to copies of the blocks there."""
    n, tree = ranks.size, None
    for k in range(2, len(ranks.orders)):
        block = 1 << k
        nearest = 1 if block == SMALLEST else 2 * block - 1
        farthest = 4 * block - 2
        if 2 * nearest > longest:
            return
        rank = ranks.orders[k]
        sizes = np.bincount(rank, minlength=n)
        place = np.arange(0, n - block + 1, SMALLEST // 2 if block == SMALLEST else block)
        place = place[sizes[rank[place]] > 1]
        first = rank[place].astype(np.int64)
        last = first + sizes[first]
        ask, end = place + nearest, place + farthest
        if len(place) and tree is None:
            tree = WaveletTree(ranks.suffixes())
        while len(place):
            copy = tree.successor(first, last, ask)
            more = (copy >= 0) & (copy <= end)
            place, first, last, end, copy = (x[more] for x in (place, first, last, end, copy))
            if not len(place):
                break
            second = tree.successor(first, last, copy + 1)
            gap = second - copy
            periodic = (second >= 0) & (gap <= block // 2)
            yield place[~periodic], (copy - place)[~periodic]
            ask = copy + 1
            if periodic.any():
                at, step, its_copy = place[periodic], gap[periodic], copy[periodic]
                run_end = its_copy + step + ranks.common_right(its_copy, its_copy + step)
                members = (np.minimum(run_end - block, end[periodic]) - its_copy) // step + 1
                # Copies within the block's own run repeat by its period and by nothing shorter.
                own = at + step + ranks.common_right(at, at + step) == run_end
                yield at[own], step[own]
                alone = np.flatnonzero(~own)
                done = 0
                while done < len(alone):
                    total = np.cumsum(members[alone[done:]])
                    take = alone[done : done + max(1, int(np.searchsorted(total, CHUNK, "right")))]
                    times = members[take]
                    number = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    distance = np.repeat(its_copy[take] - at[take], times)
                    yield np.repeat(at[take], times), distance + number * np.repeat(step[take], times)
                    done += len(take)
                ask[periodic] = its_copy + (members - 1) * step + 1


def find_runs(
    symbols: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and smallest period of all runs, by text, start and period. `first`
    says where the symbols of each text start and the last one ends. A run has at least
    `min_length` symbols, 12 or more, and two periods."""
    if min_length < MIN_LENGTH:
        raise ValueError(f"blocks do not reach runs of under {MIN_LENGTH} words")
    none = np.zeros(0, np.int64)
    lengths = np.diff(first)
    longest = int(lengths.max(initial=0))
    if longest < min_length:
        return none, none, none, none
    texts = np.repeat(np.arange(len(lengths)), lengths)
    ranks = Ranks(texts * np.int64(symbols.max() + 1) + symbols)
    found = [np.zeros((0, 3), np.int64)]
    for place, distance in _candidates(ranks, longest):
        for at in range(0, len(place), CHUNK):
            left, period = place[at : at + CHUNK], distance[at : at + CHUNK]
            begin = left - ranks.common_left(left, left + period)
            end = left + period + ranks.common_right(left, left + period)
            long = end - begin >= np.maximum(min_length, 2 * period)
            found.append(np.unique(np.stack([begin, end, period], axis=1)[long], axis=0))
    runs = np.unique(np.concatenate(found), axis=0)
    # Rows are sorted, so the smallest period of equal ranges comes first.
    runs = runs[np.append(True, (runs[1:, :2] != runs[:-1, :2]).any(axis=1))[: len(runs)]]
    begin, end, period = runs.T
    text = texts[begin]
    order = np.lexsort((period, begin))
    begin, end, period, text = begin[order], end[order], period[order], text[order]
    return text, begin - first[text], end - begin, period


def collapse_runs(
    documents: DataFrame,
    *,
    text: str = "text",
    keep: list[str | Column],
    key: str | None = None,
    rewrite: Rewrite | None = None,
    min_length: int = MIN_LENGTH,
) -> DataFrame:
    """The columns `keep` of every row, `runs`, all periodic runs of its words by start and period
    (word number from 0, words, words a period), and `collapsed`, its words without those that a
    run repeats, joined by one space.

    A word goes where any run holds it after that run's first period. Texts that are null, empty
    or without a word have no runs and an empty `collapsed`. Whole texts are read however long.
    Rows are judged one by one, repeated ones too; no row is dropped, an empty table stays empty,
    and other columns, whatever their names, play no part. `rewrite` changes the words first: it
    gets the values of the column `key`.
    """
    rows = documents.select(
        F.struct(*keep).alias("kept"),
        F.col(text).alias("text"),
        (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
    )

    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            spans = words_of(batch.column("text"))
            codes, _ = spans.coded()
            first, source = spans.first, np.arange(len(spans))
            if rewrite is not None:
                source = rewrite(batch.column("key").to_pylist(), first)
                codes = codes[source]
            owner, start, length, period = find_runs(codes, first, min_length)
            covered = np.zeros(len(spans) + 1, np.int64)
            np.add.at(covered, first[owner] + start + period, 1)
            np.add.at(covered, first[owner] + start + length, -1)
            stays = np.cumsum(covered)[:-1] == 0
            ends = np.append(0, np.cumsum(stays))[first]
            words = spans.array().take(pa.array(source[stays]))
            joined = pc.binary_join(
                pa.LargeListArray.from_arrays(ends, words), pa.scalar(b" ", pa.large_binary())
            )
            in_text = np.append(0, np.cumsum(np.bincount(owner, minlength=batch.num_rows)))
            runs = pa.StructArray.from_arrays(
                [pa.array(x) for x in (start, length, period)], ["start", "length", "period"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("kept"),
                    pa.ListArray.from_arrays(pa.array(in_text, pa.int32()), runs),
                    joined.cast(pa.large_string()).cast(pa.string()),
                ],
                ["kept", "runs", "collapsed"],
            )

    kept = rows.schema["kept"].dataType.simpleString()
    found = rows.mapInArrow(collapse, f"kept {kept}, runs {RUNS}, collapsed string")
    return found.select("kept.*", "runs", "collapsed")


def repeat_words(keys: list, first: np.ndarray) -> np.ndarray:
    """The contract's planted repeats: in one text of ten, words repeat from some word on. Texts
    without a key have none."""
    source = np.arange(first[-1])
    for key, begin, end in zip(keys, first[:-1].tolist(), first[1:].tolist()):
        if key is None or begin == end:
            continue
        rest, kind = divmod(crc32(str(key).encode()), 10)
        if kind == 0:
            size = end - begin
            start = rest % size
            period = 1 + (size - start) // (3 + rest % 8)
            source[begin + start : end] = begin + start + np.arange(size - start) % period
    return source


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the greatest one by length, start and period, and digests of all
    runs and of the words that stay. A null key plants no repeats."""
    found = collapse_runs(
        table(spark, sf_dir, "documents"), keep=["doc_id"], key="doc_id", rewrite=repeat_words
    )
    best = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less")
            ),
        )
    )
    lines = F.transform(
        "runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    )
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.less")).alias("period"),
        F.expr("best.length * 1000 div -best.less").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

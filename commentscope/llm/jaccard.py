"""Op 4, n-gram Jaccard join: near-duplicate groups by exact similarity of word shingles.

Method: token-combination prefixes. Documents with overlap o in n shingles share a signature if
their prefixes, in one global order of all shingles, are taken long enough. Shingles have classes
by how many documents hold them: unshared and rare ones come first and are signatures one by one;
frequent ones come last, are cut into sub-classes, and only pairs within a sub-class are
signatures. A sub-class with m shingles in a prefix gives m - 1 toward its length, for two
documents that share no pair of it share at most one of its shingles; so the prefix is extended by
one shingle for each sub-class. Candidates that share a signature are verified on their texts.

Candidates are not all pairs of a group: every document is first compared with the least document
of its signature's group (the leader). Those linked to the leader need no comparison with each
other, and neither do any that links have joined to one component by then. What is left is asked in
rounds. In each one, a group's nodes outside its largest component are odd; some of them, 16 times
as many as in the round before, are compared with the nodes of the group's other components, and
components are joined by what is found. A group is done when all its odd nodes have been asked in
one round, or when it has one component. Sizes, the triangle inequality of the Jaccard distance by
the known distances to the leader, and sketches that differ in more bits than linked sets can
differ in members rule a link out before. So no link between components is lost, a group of copies
costs about as many comparisons as it has members, and rounds grow with the logarithm of the
largest number of odd nodes. Large groups are dealt to several tasks.

Documents with equal shingle sets are one node from the start. The classes only steer how long
prefixes are and never decide a link: they come from a table of fixed-width cells, where a
shingle has the class of its cell's most frequent one, of at most 2**28 cells (64 MB).
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, constants, mix, shuffle_partitions, steps, stored, table
from .components import connected_components

SHINGLE = 5
SIMILARITY = 80  # percent

# A shingle in more documents than this is frequent.
FREQUENT = 32

# Shingles that a sub-class of frequent ones holds on average, at the lower end of a size band.
SUBCLASS = 4
BAND = 1.3  # more than 1 / similarity, so linked documents are in the same or the next band

UNSHARED, RARE, COMMON = 0, 1, 2
MIN_CELL_BITS, MAX_CELL_BITS = 16, 28
BUCKET_TOKENS = 1 << 20
FLUSH_TOKENS = 4 << 20

_PAIR = constants(3, 0xFACE)


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    hashes, first = Words(texts).shingles(SHINGLE)
    return [np.unique(hashes[a:b]) for a, b in zip(first, first[1:])]


def set_digest(tokens: np.ndarray) -> bytes | None:
    """128 bits of a set; None for an empty one."""
    if not len(tokens):
        return None
    halves = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ _PAIR[2]).sum(dtype=np.uint64)
    return b"".join(int(h).to_bytes(8, "big") for h in halves)


SKETCH_WORDS = 16

# Least signatures that a node carries into the join of nodes that share one.
FIRST_SIGNS = 16

# Odd nodes of a group that the first round asks, and by how many times more each further round
# asks; nodes of a group that one task holds against the odd ones.
ASKED = 16
GROUP_ROWS = 1024


def parity_sketch(tokens: np.ndarray) -> np.ndarray:
    """Bits that tell whether an odd number of the set's hashes falls on them. Two sets differ in
    at least as many members as their sketches do in bits."""
    odd = np.bincount((tokens & np.uint64(64 * SKETCH_WORDS - 1)).astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


# --- classes -------------------------------------------------------------------------------


def _packed(tokens: np.ndarray) -> bytes:
    """The upper 48 bits of sorted hashes as differences, byte plane by byte plane: the upper
    planes are zeros, which the shuffle's compression takes away."""
    upper = tokens >> np.uint64(16)
    steps_ = np.diff(upper, prepend=np.uint64(0))
    return np.ascontiguousarray(steps_.view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(6, -1)
    whole = np.zeros((planes.shape[1], 8), np.uint8)
    whole[:, :6] = planes.T
    return np.cumsum(whole.view(np.uint64).ravel(), dtype=np.uint64)


class Classes:
    """Class of each shingle by cell: the upper `bits` of its hash, two bits a cell."""

    def __init__(self, bits: int, cells: bytes):
        self._shift = np.uint64(64 - bits)
        self._cells = np.frombuffer(cells, np.uint8)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        cell = tokens >> self._shift
        return (self._cells[cell >> np.uint64(2)] >> (2 * (cell & np.uint64(3))).astype(np.uint8)) & 3


def shingle_classes(documents: DataFrame, total: int, frequent: int) -> Classes:
    """Classes by the number of documents that hold a shingle, counted over all texts (`text`).

    Hashes are dealt by their upper bits and counted exactly, as sorted runs that each task
    merges; `total`, the number of shingles, sets how many buckets and cells there are.
    """
    bucket_bits = max(6, ceil(log(max(total / BUCKET_TOKENS, 1), 2)))
    bits = min(max(ceil(log(max(total / 2, 1), 2)), MIN_CELL_BITS, bucket_bits + 2), MAX_CELL_BITS)
    borders = np.arange(1 << bucket_bits, dtype=np.uint64) << np.uint64(64 - bucket_bits)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flushed() -> pa.RecordBatch:
            tokens = np.sort(np.concatenate(held))
            cut = np.append(np.searchsorted(tokens, borders), len(tokens))
            some = np.flatnonzero(np.diff(cut))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int64()),
                    pa.array([_packed(tokens[cut[k] : cut[k + 1]]) for k in some], pa.binary()),
                ],
                ["bucket", "run"],
            )

        for batch in steps(batches, "text"):
            # Copies within a step count once.
            sets = {set_digest(s): s for s in shingle_sets(batch.column("text")) if len(s)}
            held += sets.values()
            size += sum(map(len, sets.values()))
            if size >= FLUSH_TOKENS:
                yield flushed()
                held, size = [], 0
        if size:
            yield flushed()

    def classed(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tokens = np.sort(np.concatenate([_unpacked(r) for r in frame["run"]]))
        start = np.flatnonzero(np.diff(tokens, prepend=tokens[0] + np.uint64(1)) != 0)
        count = np.diff(np.append(start, len(tokens)))
        shared = count > 1
        cells = np.zeros(1 << (bits - bucket_bits), np.uint8)
        cell = (tokens[start][shared] >> np.uint64(48 - bits)) & np.uint64(len(cells) - 1)
        np.maximum.at(cells, cell, np.where(count[shared] > frequent, COMMON, RARE).astype(np.uint8))
        four = cells.reshape(-1, 4)
        packed = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
        return pd.DataFrame({"bucket": [key[0]], "cells": [packed.astype(np.uint8).tobytes()]})

    rows = (
        documents.select("text")
        .mapInArrow(runs, "bucket bigint, run binary")
        .groupBy("bucket")
        .applyInPandas(classed, "bucket bigint, cells binary")
        .collect()  # 2**bits / 4 bytes
    )
    size = 1 << (bits - bucket_bits - 2)
    by_bucket = {r["bucket"]: bytes(r["cells"]) for r in rows}
    whole = b"".join(by_bucket.get(k, bytes(size)) for k in range(1 << bucket_bits))
    return Classes(bits, whole)


# --- signatures ----------------------------------------------------------------------------


def signatures(tokens: np.ndarray, classes: np.ndarray, similarity: int = SIMILARITY) -> np.ndarray:
    """Signatures of a document with these sorted shingle hashes."""
    n = len(tokens)
    need = n - -(-similarity * n // 100) + 1
    unshared = int((classes == UNSHARED).sum())
    if unshared >= need:
        return tokens[:0]
    rare = tokens[classes == RARE][: need - unshared]
    need -= unshared + len(rare)
    if need <= 0:
        return rare
    common = tokens[classes == COMMON]
    found = [rare]
    band = int(log(n, BAND))
    for key in (band - 1, band):
        sub_classes = ceil(BAND**key / SUBCLASS)
        # Sub-classes are ranges of the hash, so prefixes take them one after another.
        which = (common >> np.uint64(32)) * np.uint64(sub_classes) >> np.uint64(32)
        start = np.flatnonzero(np.diff(which, prepend=which[0] + np.uint64(1)) != 0)
        end = np.append(start[1:], len(common))
        gained = np.cumsum(end - start - 1)
        last = int(np.searchsorted(gained, need))
        salt = mix(np.array([key + 7], np.uint64))[0]
        for a, b in zip(start[: last + 1], end[: last + 1]):
            i, j = np.triu_indices(b - a, 1)
            found.append(mix(common[a + i] * _PAIR[0] + common[a + j] * _PAIR[1] + salt))
    return np.unique(np.concatenate(found))


def signature_table(documents: DataFrame, classes: Classes, similarity: int) -> DataFrame:
    """`node` (digest of the set), `size` and `sketch` (of the set), `text` and `signatures` of
    documents that have any. Copies in one step are one row."""
    shared = documents.sparkSession.sparkContext.broadcast(classes)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            rows: dict[bytes, tuple[int, int, np.ndarray, np.ndarray]] = {}
            for at, tokens in enumerate(shingle_sets(batch.column("text"))):
                node = set_digest(tokens)
                if node is None or node in rows:
                    continue
                signs = signatures(tokens, shared.value.of(tokens), similarity)
                if len(signs):
                    rows[node] = at, len(tokens), parity_sketch(tokens), signs.view(np.int64)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(rows), pa.binary()),
                        batch.column("text").take(pa.array([row[0] for row in rows.values()])),
                        pa.array([row[1] for row in rows.values()], pa.int64()),
                        pa.array([row[2] for row in rows.values()], pa.list_(pa.int64())),
                        pa.array([row[3] for row in rows.values()], pa.list_(pa.int64())),
                    ],
                    ["node", "text", "size", "sketch", "signatures"],
                )

    return documents.select("text").mapInArrow(
        sign, "node binary, text string, size bigint, sketch array<bigint>, signatures array<bigint>"
    )


# --- verification --------------------------------------------------------------------------


def compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """`pairs` (`a`, `b`) with `common`, `n_a` and `n_b`, from `texts` (`node`, `text`)."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")

    def sets_of(batch: pa.RecordBatch, side: str) -> tuple[np.ndarray, list[np.ndarray]]:
        """A number for each row's node, and the shingles of each node by number."""
        number = batch.column(side).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        first = np.unique(number, return_index=True)[1]
        return number, shingle_sets(batch.column(f"text_{side}").take(pa.array(first)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text_b"):
            (a, a_sets), (b, b_sets) = sets_of(batch, "a"), sets_of(batch, "b")
            counts = np.array(
                [
                    (len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
                    for x, y in zip(map(a_sets.__getitem__, a), map(b_sets.__getitem__, b))
                ],
                np.int64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), *map(pa.array, counts.T)],
                ["a", "b", "common", "n_a", "n_b"],
            )

    return joined.mapInArrow(compare, "a binary, b binary, common bigint, n_a bigint, n_b bigint")


def _groups(signed: DataFrame) -> DataFrame:
    """`sign`, `leader`, `node`, `size`: who shares a signature, without the leader, the least.

    Signatures that the same nodes share are one: counts and two 64-bit sums of hashes tell. Nodes
    travel to their signatures once, for the groups and for the join with them.
    """
    held = (
        signed.groupBy("node")
        .agg(F.min("size").alias("size"), F.min("signatures").alias("signatures"))
        .select("node", "size", F.explode("signatures").alias("sign"))
        # The join below asks for these too; asked for here, both its sides are one shuffle.
        .where("sign IS NOT NULL AND node IS NOT NULL")
        .repartition("sign")
    )
    groups = (
        held.groupBy("sign")
        .agg(
            F.min(F.struct("node", "size")).alias("leader"),
            F.count("*").alias("n"),
            F.bit_xor(F.xxhash64("node")).alias("one"),
            F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("two"),
        )
        .where("n > 1")
        .groupBy("leader", "n", "one", "two")
        .agg(F.min("sign").alias("sign"))
        .select("sign", F.col("leader.node").alias("leader"), F.col("leader.size").alias("leader_size"))
    )
    return held.join(groups, "sign").where("node != leader")


def links_between(signed: DataFrame, similarity: int) -> DataFrame:
    """`a`, `b`: links that connect the same nodes as all links do."""
    union = F.col("n_a") + F.col("n_b") - F.col("common")
    linked = 100 * F.col("common") >= similarity * union
    texts = signed.select("node", "text")

    def fit(one: str, two: str):
        """Whether sets of these sizes can be similar enough at all."""
        return 100 * F.least(one, two) >= similarity * F.greatest(one, two)

    def one_text(pairs: DataFrame) -> DataFrame:
        asked = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        return stored(texts.join(asked, "node").dropDuplicates(["node"]), "candidates")

    members = stored(_groups(signed), "members")
    stars = stored(
        members.where(fit("leader_size", "size"))
        .select(F.col("leader").alias("a"), F.col("node").alias("b"))
        .distinct(),
        "stars",
    )
    first = stored(
        compared(stars, one_text(stars)).select(
            F.col("a").alias("leader"),
            F.col("b").alias("node"),
            linked.alias("linked"),
            (1 - F.col("common") / union).alias("distance"),
        ),
        "compared",
    )
    found = first.where("linked").select(F.col("leader").alias("a"), F.col("node").alias("b"))

    # What is left: groups with nodes of several components.
    parts = stored(connected_components(found), "parts")
    left = _parted(
        members.join(first, ["leader", "node"], "left").select("sign", "node", "size", "distance"), parts
    )
    # A node has no more signatures here than its row of `signed` lists.
    first_signs = left.groupBy("node").agg(
        F.slice(F.sort_array(F.collect_list("sign")), 1, FIRST_SIGNS).alias("first_signs")
    )
    sketches = signed.select("node", "sketch").dropDuplicates(["node"])
    open_ = stored(left.join(first_signs, "node").join(sketches, "node"), "open")
    asked = ASKED
    while not open_.isEmpty():
        rest = stored(_asked(open_, asked, similarity).where(fit("odd_size", "size")).select("a", "b").distinct(), "rest")
        second = compared(rest, one_text(rest)).where(linked).select("a", "b")
        found = stored(found.unionByName(second), "found")
        more = open_.where(F.col("n_odd") > asked).drop("component", "own", "n_odd", "n")
        if more.isEmpty():
            break
        parts = stored(connected_components(found), "parts")
        open_ = stored(_parted(more, parts), "open")
        asked *= ASKED
    return found


def _parted(members: DataFrame, parts: DataFrame) -> DataFrame:
    """`members` of groups (`sign`, `node`) whose nodes are in several components, with the node's
    `component`, the largest one of its group (`own`), and how many nodes the group has (`n`) and
    how many of them are outside `own` (`n_odd`)."""
    placed = members.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = (
        placed.groupBy("sign", "component")
        .agg(F.count("*").alias("held"))
        .groupBy("sign")
        .agg(
            F.max(F.struct("held", "component")).alias("largest"),
            F.sum("held").alias("n"),
            F.count("*").alias("components"),
        )
        .where("components > 1")
        .select("sign", "n", F.col("largest.component").alias("own"), (F.col("n") - F.col("largest.held")).alias("n_odd"))
    )
    return placed.join(split, "sign")


def _asked(open_: DataFrame, asked: int, similarity: int) -> DataFrame:
    """Pairs `a`, `b` of an odd node and a node of another component in one of its groups that may
    be linked, with their sizes. Of `n_odd` odd nodes about `asked` are in pairs, or all if there
    are no more; any pair of two components has an odd node."""
    tasks = shuffle_partitions(open_.sparkSession)
    # The same nodes come first in all groups, so that groups of alike nodes ask alike pairs.
    place = F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    shards = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    odd = (
        open_.where((F.col("component") != F.col("own")) & (place * F.col("n_odd") < asked))
        .select(
            "sign",
            F.explode(F.sequence(F.lit(0), shards - 1)).alias("shard"),
            F.col("node").alias("odd"),
            F.col("size").alias("odd_size"),
            F.col("distance").alias("odd_distance"),
            F.col("component").alias("odd_component"),
            F.col("sketch").alias("odd_sketch"),
            F.col("first_signs").alias("odd_first_signs"),
        )
        .repartition(tasks, "sign", "shard")
    )
    dealt = open_.withColumn("shard", F.pmod(F.xxhash64("node"), shards).cast("int"))
    # Sets that are similar enough differ in few members, and so do their sketches in bits.
    bits = sum(
        F.bit_count(F.get("sketch", F.lit(k)).bitwiseXOR(F.get("odd_sketch", F.lit(k))))
        for k in range(SKETCH_WORDS)
    )
    few = (100 + similarity) * bits <= (100 - similarity) * (F.col("size") + F.col("odd_size"))
    reach = 1 - similarity / 100 + 1e-9
    near = F.coalesce(F.abs(F.col("odd_distance") - F.col("distance")) <= reach, F.lit(True))
    # Each group that two nodes share tells of them, with the same outcome; of those among the
    # first signatures of both, the least does, in this round or another. So alike nodes are one
    # pair, not one a group.
    first, odd_first = F.get("first_signs", F.lit(0)), F.get("odd_first_signs", F.lit(0))
    least_shared = F.array_min(F.array_intersect("first_signs", "odd_first_signs"))
    told_here = F.when(first == odd_first, first == F.col("sign")).otherwise(
        F.coalesce(least_shared >= F.col("sign"), F.lit(True))
    )
    return (
        dealt.repartition(tasks, "sign", "shard")
        .join(odd, ["sign", "shard"])
        .where(F.col("odd_component") != F.col("component"))
        .where(near & few & told_here)
        .select(F.least("odd", "node").alias("a"), F.greatest("odd", "node").alias("b"), "size", "odd_size")
    )


def near_duplicate_groups(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    similarity: int = SIMILARITY,
    frequent: int = FREQUENT,
) -> DataFrame:
    """`key`, `n_shingles` and `component_id` of every row: the least key of all rows that links
    reach. Two rows link if `similarity` percent of the shingles in either are in both.

    Words are compared with A-Z lowered. Null texts and texts without words have no shingles, no
    links, and their own key as component. Rows with equal texts link, repeated rows too. A null
    key is never the least one unless all keys of a component are null. Other columns of
    `documents` are not read.
    """
    rows = documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["key"]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            sets = shingle_sets(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                ],
                ["key", "node", "n_shingles"],
            )

    nodes = stored(
        rows.mapInArrow(measure, f"key {kind}, node binary, n_shingles bigint"), "nodes"
    )
    total = nodes.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    classes = shingle_classes(rows, total, frequent)
    signed = stored(signature_table(rows, classes, similarity), "signed")
    components = connected_components(links_between(signed, similarity))
    placed = (
        nodes.where(F.col("node").isNotNull())
        .join(components, "node", "left")
        .select("key", "n_shingles", F.coalesce("component", "node").alias("component"))
    )
    least = placed.groupBy("component").agg(F.min("key").alias("component_id"))
    alone = nodes.where(F.col("node").isNull())
    return (
        placed.join(least, "component")
        .select("key", "n_shingles", "component_id")
        .unionByName(alone.select("key", "n_shingles", F.col("key").alias("component_id")))
        .withColumnRenamed("key", key)
    )


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))

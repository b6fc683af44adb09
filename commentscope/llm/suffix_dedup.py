"""Op 8, suffix-array dedup: bytes in repeated strings of at least `length` bytes are removed.

Method: per-shard suffix arrays by Larsson-Sadakane refinement in numpy and Kasai common prefixes.
There is no merge of suffix arrays across shards by binary search: anchors, which bring all equal
windows into one shard beforehand, and halving, where an anchor is too large for one, replace it.
A merge would need the suffixes of all bytes in sorted shards; so only pieces that differ around an
equal anchor are sorted at all, and pieces that are equal by their hashes are not.

* Every window of `length` bytes belongs to its anchor, the leftmost of its shingles of
  `anchor_size` bytes with the least hash. Short shingles recur by chance, and the more so the more
  texts there are; so they are as long as leaves the windows some hundreds of places for one. Windows in a row with the same anchor are a piece. Equal
  windows have equal anchors, so pieces meet by the hash of their anchor, each byte of a text in
  few pieces, and no window is a row.
* Anchors that occur once need nothing more; where all pieces of an anchor are equal, all their
  windows repeat. Only pieces of other anchors are fetched and sorted: shards of whole anchors
  build the suffix array of those pieces that agree with another one on the bytes around the
  anchor that a common window needs, and neighbours with a common prefix of `length` bytes or
  more are repeated windows.
* An anchor with very many different pieces is not sorted in one shard. The range of places that
  its anchor has in the windows is halved, and halves are grouped anew by the bytes that all
  windows of a half have in common. So the border up to which pieces agree is found by binary
  search, and pieces that have come to differ part; halves of one window are decided by counting.

Hashes are 64 bit, and pieces are only compared where the hashes of anchors are equal too.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Rolling, mix, steps, stored, table, text_bytes

LENGTH = 400
ANCHOR = 64

# Bits of a packed number that hold a place within a step; the others order anchors.
PLACE_BITS = 28

# Different pieces of one anchor that a shard sorts; with more, the range is halved.
MAX_KINDS = 256
SHARD_BYTES = 1 << 20

# Ranges of places of an anchor for which pieces are compared before they are sorted.
ANCHOR_RANGES = 4

_ONE, _TWO = Rolling(0xA11CE), Rolling(0xB0B)


def anchor_size(length: int) -> int:
    """Bytes of an anchor in windows of `length` bytes."""
    return max(1, min(ANCHOR, 2 * length // 5))


# --- pieces --------------------------------------------------------------------------------


def _least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Minimum of each `size` numbers in a row, by running minima of blocks from both sides."""
    count = len(values) - size + 1
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    table_ = padded.reshape(blocks, size)
    left = np.minimum.accumulate(table_, axis=1).ravel()
    right = np.minimum.accumulate(table_[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:count], left[size - 1 : size - 1 + count])


def pieces_of(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Pieces of texts that lie one after another: `row`, `start` in the text, `windows`, `at`
    (the anchor from the start), `anchor` and `piece` (hashes)."""
    count = len(data) - length + 1
    if count <= 0:
        return {}
    prefix = _ONE.prefix(data)
    size = anchor_size(length)
    places = np.arange(len(data) - size + 1)
    anchors = mix(_ONE.slices(prefix, places, places + size))
    low = np.uint64((1 << PLACE_BITS) - 1)
    packed = (anchors & ~low) | places.astype(np.uint64)
    owner = (_least_in_windows(packed, length - size + 1) & low).astype(np.int64)
    steps_ = np.zeros(count + 1, np.int64)
    rows = np.flatnonzero(np.diff(offsets) >= length)
    steps_[offsets[:-1][rows]] += 1
    steps_[offsets[1:][rows] - length + 1] -= 1
    inside = np.cumsum(steps_[:count]) > 0
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (owner[1:] != owner[:-1])
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | new[1:]
    start, end = np.flatnonzero(new), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    # Empty texts share their place with the next one; the last text at a place is meant.
    stop = end + length - 1
    piece = mix(
        _ONE.slices(prefix, start, stop) ^ mix(_TWO.slices(_TWO.prefix(data), start, stop))
    )
    return {
        "row": row,
        "start": start - offsets[row],
        "windows": end - start,
        "at": owner[start] - start,
        "anchor": anchors[owner[start]].view(np.int64),
        "piece": piece.view(np.int64),
    }


def piece_table(texts: DataFrame, length: int) -> DataFrame:
    """`id`, `start`, `windows`, `at`, `anchor`, `piece` of all pieces of `texts` (`id`, `text`)."""
    names = ["start", "windows", "at", "anchor", "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            found = pieces_of(*text_bytes(batch.column("text")), length)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(found["row"]))]
                    + [pa.array(found[n]) for n in names],
                    ["id", *names],
                )

    return texts.mapInArrow(
        cut, "id binary, start bigint, windows bigint, at bigint, anchor bigint, piece bigint"
    )


# --- suffix arrays -------------------------------------------------------------------------


def suffix_array(data: np.ndarray, left: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Places by their suffixes. Each piece ends with a byte 0xFF, `left` is the number of bytes
    up to it, and suffixes that are equal up to there go by piece."""
    size = len(data)
    first = 7
    key = np.zeros(size, np.uint64)
    reach = np.minimum(left + 1, first)
    padded = np.append(data, np.zeros(first, np.uint8)).astype(np.uint64)
    for k in range(first):
        key = key << np.uint64(8) | np.where(k < reach, padded[k : k + size], 0).astype(np.uint64)
    ends = np.where(left < first, piece + 1, 0)
    order = np.lexsort((ends, key))
    same = np.zeros(size, bool)
    same[1:] = (key[order][1:] == key[order][:-1]) & (ends[order][1:] == ends[order][:-1])

    # A group's rank is the place of its first member; sorted places leave the work.
    heads = np.maximum.accumulate(np.where(same, 0, np.arange(size)))
    rank = np.empty(size, np.int64)
    rank[order] = heads
    open_ = np.flatnonzero(same | np.append(same[1:], False))
    depth = first
    while len(open_):
        members = order[open_]
        # Suffixes that end before the depth have been told apart by their piece.
        behind = rank[np.minimum(members + depth, size - 1)]
        by = np.lexsort((behind, heads[open_]))
        members, behind, group = members[by], behind[by], heads[open_][by]
        order[open_] = members
        again = np.zeros(len(open_), bool)
        again[1:] = (group[1:] == group[:-1]) & (behind[1:] == behind[:-1])
        heads[open_] = np.maximum.accumulate(np.where(again, 0, open_))
        rank[members] = heads[open_]
        open_ = open_[again | np.append(again[1:], False)]
        depth *= 2
    return order


def common_prefixes(data: np.ndarray, left: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix with the one before it in the order, by place in the order.

    Kasai's rule: going through places from left to right, a common prefix is at least the one
    before it less one, and is exactly that where the bytes before both suffixes are equal. The
    other ones are compared; they are few, and all at a time.
    """
    size = len(data)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    place = np.flatnonzero(before >= 0)
    other = before[place]
    known = (place > 0) & (other > 0)
    known &= data[place - 1] == data[other - 1]
    known &= (data[place - 1] != 0xFF) & (before[place - 1] == other - 1)
    p, q = place[~known], other[~known]
    limit = np.minimum(left[p], left[q])
    words = np.zeros(size + 8, np.uint64)
    padded = np.append(data, np.zeros(16, np.uint8)).astype(np.uint64)
    for k in range(8):
        words |= padded[k : k + size + 8] << np.uint64(8 * k)
    found = np.zeros(len(p), np.int64)
    active = np.arange(len(p))
    while len(active):
        at = found[active]
        differ = words[p[active] + at] ^ words[q[active] + at]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.log2(np.maximum(low, 1).astype(np.float64)) // 8)
        found[active] = np.minimum(at + equal.astype(np.int64), limit[active])
        active = active[(equal == 8) & (found[active] < limit[active])]
    # Value plus place stays the same from a compared place on, until the next compared one.
    sums = np.full(size, -1, np.int64)
    sums[p] = found + p
    carried = np.where(sums >= 0, np.arange(size), 0)
    carried = np.maximum.accumulate(carried)
    by_place = np.maximum(sums[carried] - np.arange(size), 0)
    by_place[before < 0] = 0
    return by_place[order]


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each piece, which of its windows also starts at another place of the pieces."""
    data = np.frombuffer(b"\xff".join([*texts, b""]), np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes + 1) - 1
    piece = np.repeat(np.arange(len(texts)), sizes + 1)
    left = ends[piece] - np.arange(len(data))
    order = suffix_array(data, left, piece)
    prefix = common_prefixes(data, left, order)
    long = prefix >= length
    repeats = np.zeros(len(data), bool)
    repeats[order] = long | np.append(long[1:], False)
    return [repeats[e - s : e - length + 1] for s, e in zip(sizes, ends)]


def can_repeat(
    groups: list[int], places: list[int], texts: list[bytes], length: int
) -> np.ndarray:
    """Which pieces can share a window with another one of their group.

    Equal windows have the anchor at the same place, in one of `ANCHOR_RANGES` ranges, and agree
    on the bytes that all windows with the anchor in that range have. A piece whose bytes no other
    piece has, range by range, has no repeated window; within a piece no window repeats.
    """
    last = length - anchor_size(length)
    width = -(-(last + 1) // ANCHOR_RANGES)
    held: list[list[tuple[int, int, bytes]]] = []
    for group, at, text in zip(groups, places, texts):
        own = []
        for low in range(0, last + 1, width):
            high = min(low + width - 1, last)
            # Only windows within the piece count, so the bytes they share lie in it too.
            if at >= low and at - high + length <= len(text):
                own.append((group, low, text[at - low : at - high + length]))
        held.append(own)
    counts = Counter(part for own in held for part in own)
    return np.array([any(counts[part] > 1 for part in own) for own in held], bool)


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


# --- Spark ---------------------------------------------------------------------------------

# `at` is the anchor's place in the part's first window; windows of a part have it in the range of
# `size` places from `bottom` on.
_PART = """group bigint, anchor bigint, piece bigint, copies bigint, at bigint, bottom bigint,
           size bigint, begin bigint, kind bigint, bytes binary"""


def _halves(parts: DataFrame, length: int) -> DataFrame:
    """Parts cut in two by the anchor's place in the window, grouped by what windows share."""

    def hashed(data: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)

    def halve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                body, half = row["bytes"], row["size"] // 2
                highest = row["at"]
                lowest = highest - (len(body) - length)
                for bottom in (row["bottom"], row["bottom"] + half):
                    top = min(bottom + half - 1, length - anchor_size(length))
                    low, high = max(lowest, bottom), min(highest, top)
                    if low > high:
                        continue
                    first = highest - high
                    text = body[first : first + high - low + length]
                    shared = text[high - bottom : high - top + length]
                    name = b"%d %d %d " % (row["group"], bottom, half)
                    rows.append(
                        {**row, "group": hashed(name + shared), "at": high, "bottom": bottom,
                         "size": half, "begin": row["begin"] + first, "bytes": text,
                         "kind": hashed(b"%d " % high + text)}
                    )
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    return parts.mapInArrow(halve, _PART)


def _repeats_in_parts(parts: DataFrame, length: int, max_kinds: int) -> DataFrame:
    """`anchor`, `piece`, `begin`, `end`: ranges of repeated windows in stored `parts`."""
    found: list[DataFrame] = []
    shape = "anchor bigint, piece bigint, begin bigint, end bigint"
    end = F.col("begin") + F.octet_length("bytes") - length + 1
    while True:
        groups = stored(
            parts.groupBy("group", "kind")
            .agg(F.sum("copies").alias("copies"), F.max("size").alias("size"))
            .groupBy("group")
            .agg(F.count("*").alias("kinds"), F.sum("copies").alias("n"), F.max("size").alias("cell"))
            .where("n > 1"),
            "piece-groups",
        )
        # Equal parts repeat as a whole, and so do copies of a part. Bytes stay out of this join.
        placed = parts.select("group", "anchor", "piece", "copies", "begin", end.alias("end"))
        found.append(
            placed.join(groups, "group")
            .where("kinds = 1 or copies > 1")
            .select("anchor", "piece", "begin", "end")
        )
        # Groups with so many kinds are at most one in `max_kinds` parts, so their names are sent.
        beyond = groups.where(F.col("kinds") > max_kinds)
        small = parts.join(F.broadcast(beyond.select("group")), "group", "left_anti")
        found.append(_sorted_shards(small, length, shape))
        halved = beyond.where(F.col("cell") > 1).select("group")
        large = parts.join(F.broadcast(halved), "group", "left_semi")
        parts = stored(_halves(large.select(*parts.columns), length), "halves")
        if parts.isEmpty():
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _sorted_shards(parts: DataFrame, length: int, shape: str) -> DataFrame:
    size = parts.agg(F.coalesce(F.sum(F.octet_length("bytes")), F.lit(0))).first()[0]
    shards = max(1, -(-size // SHARD_BYTES))

    def sort(frame: pd.DataFrame) -> pd.DataFrame:
        rows = []
        frame = frame[
            can_repeat(
                frame["group"].tolist(), frame["at"].tolist(), frame["bytes"].tolist(), length
            )
        ]
        flags = repeated_windows(frame["bytes"].tolist(), length) if len(frame) else []
        for anchor, piece, begin, own in zip(frame["anchor"], frame["piece"], frame["begin"], flags):
            rows += [(anchor, piece, begin + a, begin + b) for a, b in _runs(own)]
        return pd.DataFrame(rows, columns=["anchor", "piece", "begin", "end"]).astype("int64")

    return (
        parts.select("group", "anchor", "piece", "begin", "at", "bytes")
        .withColumn("shard", F.pmod(F.xxhash64("group"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(sort, shape)
    )


def repeated_spans(
    documents: DataFrame, *, text: str = "text", length: int = LENGTH, max_kinds: int = MAX_KINDS
) -> DataFrame:
    """`id` (MD5 of the text) and `spans`, the byte ranges (start, end) that repeated strings cover
    in the texts that have any; ranges may overlap."""
    texts = documents.where(F.octet_length(text) >= length).select(
        F.unhex(F.md5(text)).alias("id"), F.col(text).alias("text")
    )
    pieces = stored(piece_table(texts, length), "pieces")
    # Stored, so that the join below is not bound to the aggregation's partitions and the rows of
    # one very frequent anchor can be split.
    shared = stored(
        pieces.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("piece").alias("least"), F.max("piece").alias("most"))
        .where("n > 1")
        .select("anchor", (F.col("least") != F.col("most")).alias("mixed")),
        "shared-anchors",
    )
    # Shuffled whatever the size: shuffle and disk of a small run then tell those of a large one.
    placed = stored(pieces.join(shared.hint("merge"), "anchor"), "shared-pieces")
    # A span counts once per text, however many rows hold the text.
    whole = placed.where("not mixed").select(
        "id",
        F.array(
            F.struct("start", (F.col("start") + F.col("windows") + length - 1).alias("end"))
        ).alias("spans"),
    )
    mixed = placed.where("mixed")
    wanted = (
        mixed.groupBy("anchor", "piece")
        .agg(
            F.count("*").alias("copies"),
            F.min(F.struct("id", "start", "windows", "at")).alias("one"),
        )
        .select("anchor", "piece", "copies", "one.*")
        .groupBy("id")
        .agg(F.collect_list(F.struct("anchor", "piece", "copies", "start", "windows", "at")).alias("wanted"))
    )
    cut = F.transform(
        "wanted",
        lambda p: F.struct(
            p["anchor"].alias("group"), p["anchor"].alias("anchor"), p["piece"].alias("piece"),
            p["copies"].alias("copies"), p["at"].alias("at"), F.lit(0).cast("long").alias("bottom"),
            F.lit(1 << (length - 1).bit_length()).cast("long").alias("size"),
            F.lit(0).cast("long").alias("begin"),
            p["piece"].alias("kind"),
            F.substring(
                F.col("text").cast("binary"), (p["start"] + 1).cast("int"),
                (p["windows"] + (length - 1)).cast("int"),
            ).alias("bytes"),
        ),
    )
    # Copies of a text go ahead of the join, so that no piece is cut twice and none is shuffled.
    parts = stored(
        texts.groupBy("id")
        .agg(F.first("text").alias("text"))
        .join(wanted, "id")
        .select(F.explode(cut).alias("part"))
        .select("part.*"),
        "parts",
    )
    found = _repeats_in_parts(parts, length, max_kinds)
    # A piece holds all its ranges, so that no place of it is joined more than once.
    ranges = found.groupBy("anchor", "piece").agg(
        F.collect_set(F.struct("begin", "end")).alias("ranges")
    )
    partly = (
        mixed.select("id", "start", "anchor", "piece")
        .distinct()
        .join(ranges, ["anchor", "piece"])
        .select(
            "id",
            F.transform(
                "ranges",
                lambda r: F.struct(
                    (F.col("start") + r["begin"]).alias("start"),
                    (F.col("start") + r["end"] + length - 1).alias("end"),
                ),
            ).alias("spans"),
        )
    )
    return (
        whole.distinct()
        .unionByName(partly)
        .groupBy("id")
        .agg(F.flatten(F.collect_list("spans")).alias("spans"))
    )


def remove_repeats(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    max_kinds: int = MAX_KINDS,
) -> DataFrame:
    """Every row with what is left of its text as UTF-8 bytes: `key`, `kept` (binary), `n_bytes`,
    `n_removed` and `n_spans`, the number of maximal removed runs.

    Null and empty texts have no bytes. What is left may not be valid UTF-8, for strings are
    compared as bytes. Repeated rows repeat each other; other columns are not read.
    """
    spans = repeated_spans(documents, text=text, length=length, max_kinds=max_kinds)
    kind = documents.select(key).dtypes[0][1]
    rows = (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .withColumn("id", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
        .join(spans.hint("merge"), "id", "left")
        .select("key", "text", "spans.start", "spans.end")
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text"):
            kept, sizes, removed, runs = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for body, starts, ends in zip(
                texts, batch.column("start").to_pylist(), batch.column("end").to_pylist()
            ):
                body = body or b""
                parts, done, lost, count, reach = [], 0, 0, 0, -1
                for start, end in sorted(zip(starts or (), ends or ())):
                    if start > reach:
                        count += 1
                    if end > done:
                        parts.append(body[done:start])
                        lost += end - max(start, done)
                        done = end
                    reach = max(reach, end)
                kept.append(b"".join([*parts, body[done:]]) if lost else body)
                sizes.append(len(body))
                removed.append(lost)
                runs.append(count)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(kept, pa.binary())]
                + [pa.array(x, pa.int64()) for x in (sizes, removed, runs)],
                ["key", "kept", "n_bytes", "n_removed", "n_spans"],
            )

    return rows.mapInArrow(
        remove, f"key {kind}, kept binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    ).withColumnRenamed("key", key)


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

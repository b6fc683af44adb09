"""Helpers shared by the operators: tables, scratch storage, and words as arrays of hashes.

Words are runs of bytes other than space and 0x09-0x0D. Hashes are 64 bit and the same in every
process, so they can be grouped and joined across executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..storage import new_dir

# What stands between words, as the contracts of the queries write it.
SPACES = r"\x20\x09-\x0D"

# Text bytes that one vectorised step takes; a longer text is a step of its own.
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """`df` as a table in the folder all executors share: lineage ends here."""
    path = new_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- Arrow ---------------------------------------------------------------------------------


def steps(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts fill about `limit` bytes, or that hold one row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            done = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def even_steps(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Like `steps`, but a batch is cut into parts of about equal size, none much over `limit`."""
    for batch in batches:
        size = pc.sum(pc.binary_length(batch.column(column))).as_py() or 1
        yield from steps(iter([batch]), column, size // -(-size // limit) + 1)


def steps_by_size(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Like `steps`, but a larger batch is taken from its longest texts to its shortest ones, in
    parts of about equal size."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        lengths = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        parts = -(-int(lengths.sum()) // limit)
        if parts < 2:
            yield batch
            continue
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths[order])
        # A text is of the part in which its last byte lies, so no part is a rest of a few texts.
        part = np.maximum(ends - 1, 0) * parts // ends[-1]
        for rows in np.split(order, np.flatnonzero(np.diff(part)) + 1):
            yield batch.take(pa.array(rows))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, one text after another, and where each text starts and the
    last one ends. Null texts are empty."""
    binary = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[
        binary.offset : binary.offset + len(binary) + 1
    ]
    data = binary.buffers()[2]
    if data is None or not len(binary):
        return np.zeros(0, np.uint8), np.zeros(len(binary) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


# --- hashes --------------------------------------------------------------------------------


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose result bits depend on all bits (splitmix64's end)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def constants(count: int, seed: int) -> np.ndarray:
    """Fixed odd 64-bit numbers."""
    golden = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        walk = np.arange(1, count + 1, dtype=np.uint64) * golden + np.uint64(seed)
        return mix(walk) | np.uint64(1)


class Rolling:
    """Polynomial hashes modulo 2**64 of any slices of a byte array, from prefix sums."""

    def __init__(self, seed: int):
        base = int(constants(1, seed)[0])
        self._base, self._inverse = base, pow(base, -1, 1 << 64)
        self._letters = constants(256, seed + 1)
        self._powers = self._inverses = np.ones(1, np.uint64)

    def _grown(self, powers: np.ndarray, base: int, size: int) -> np.ndarray:
        while len(powers) < size:
            step = np.uint64(pow(base, len(powers), 1 << 64))
            powers = np.concatenate([powers, powers * step])
        return powers

    def prefix(self, data: np.ndarray) -> np.ndarray:
        size = len(data) + 1
        self._powers = self._grown(self._powers, self._base, size)
        self._inverses = self._grown(self._inverses, self._inverse, size)
        sums = np.zeros(size, np.uint64)
        np.cumsum(self._letters[data] * self._powers[: size - 1], out=sums[1:])
        return sums

    def slices(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (prefix[ends] - prefix[starts]) * self._inverses[starts]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_ROLLING = Rolling(0x5EED)


class Words:
    """The words of a few texts: hashes of the words with A-Z lowered, and `first`, where the
    words of each text start in them, with the number of all words at the end."""

    def __init__(self, texts: pa.Array):
        data, offsets = text_bytes(texts)
        if not len(data):
            self.hashes = np.zeros(0, np.uint64)
            self.first = np.zeros(len(offsets), np.int64)
            return
        data = _LOWER[data]
        inside = ~_IS_SPACE[data]
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1] | border[1:-1]
        ends[:-1] &= ~inside[1:] | border[1:-1]
        counted = np.zeros(len(data) + 1, np.int64)
        np.cumsum(starts, out=counted[1:])
        self.first = counted[offsets]
        begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        prefix = _ROLLING.prefix(data)
        self.hashes = mix(_ROLLING.slices(prefix, begin, end) + (end - begin).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.first) - 1

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of `size` words and where those of each text start. A text with
        fewer words, but one at least, has one hash, of all its words."""
        counts = np.diff(self.first)
        n = len(self.hashes)
        weights = constants(size, 0xC0DE)
        runs = np.zeros(max(n - size + 1, 0), np.uint64)
        for k in range(size if len(runs) else 0):
            runs += self.hashes[k : k + len(runs)] * weights[k]
        runs = mix(runs)
        kept = np.ones(len(runs), bool)
        # A run that starts among the last words of a text reaches into the next one.
        for back in range(1, size):
            at = self.first[1:] - back
            at = at[(at >= self.first[:-1]) & (at < len(runs))]
            kept[at] = False
        per_text = np.maximum(counts - size + 1, 0)
        short = np.flatnonzero((counts > 0) & (counts < size))
        if not len(short):
            return runs[kept], np.concatenate([[0], np.cumsum(per_text)])
        first = np.concatenate([[0], np.cumsum(per_text)])
        whole = np.zeros(len(short), np.uint64)
        for k in range(size - 1):
            held = counts[short] > k
            whole[held] += self.hashes[self.first[short[held]] + k] * weights[k]
        whole = mix(whole + counts[short].astype(np.uint64))
        merged = np.insert(runs[kept], first[short], whole)
        per_text[short] = 1
        return merged, np.concatenate([[0], np.cumsum(per_text)])


# --- exact words -----------------------------------------------------------------------------


class Spans:
    """Words of a few texts, kept as they are: `bytes` of all words without what parts them,
    `offsets` where each word starts in it, and `first`, where the words of each text start, with
    the number of all words at the end. `inside` marks the bytes that belong to words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        border = np.zeros(len(data) + 1, bool)
        border[offsets] = True
        outside = np.append(True, ~inside) | border
        starts = np.flatnonzero(inside & outside[:-1])
        outside[:-1] = ~inside
        outside[-1] = True
        ends = np.flatnonzero(inside & (outside | border)[1:])
        self.first = np.searchsorted(starts, offsets)
        self.bytes = data[inside]
        self.offsets = np.append(0, np.cumsum(ends + 1 - starts))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def array(self) -> pa.Array:
        """The words as byte strings."""
        return pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(self), [None, pa.py_buffer(self.offsets), pa.py_buffer(self.bytes)]
        )

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, equal for equal words, and the distinct words by number."""
        coded = self.array().dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def words_of(texts: pa.Array, *, lower: bool = False) -> Spans:
    """Runs of bytes other than space and 0x09-0x0D; `lower` lowers A-Z. Null texts are empty."""
    data, offsets = text_bytes(texts)
    if lower:
        data = _LOWER[data]
    return Spans(data, offsets, ~_IS_SPACE[data])


def letters_of(texts: pa.Array) -> Spans:
    """Runs of A-Z, a-z and U+00C0 to U+00FF with A-Z lowered. Null texts have none."""
    data, offsets = text_bytes(texts)
    data = _LOWER[data]
    # In UTF-8, U+00C0 to U+00FF are the byte C3 and any byte that may follow it.
    leads = data == 0xC3
    inside = (data >= ord("a")) & (data <= ord("z")) | leads
    inside[1:] |= leads[:-1]
    return Spans(data, offsets, inside)


def code_points(words: pa.Array) -> np.ndarray:
    """Code points of each of some non-empty words, given as byte strings."""
    if not len(words):
        return np.zeros(0, np.int64)
    data, offsets = text_bytes_of_binary(words)
    return np.add.reduceat(((data & 0xC0) != 0x80).astype(np.int64), offsets[:-1])


def text_bytes_of_binary(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of large byte strings, and where each starts and the last one ends."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]

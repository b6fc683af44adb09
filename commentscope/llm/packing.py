"""Op 2, packing: token sequences of a fixed window, filled best-fit decreasing.

Method: a document longer than the window is first cut into full windows, which are sequences of
their own, and a rest. The rests are placed by falling length, each into the open window with the
least capacity that still holds it; a segment tree indexed by remaining capacity finds it.

Full windows need no packing and are not shuffled. The rests carry only their lengths and keys
into the packing, which is done in shards of some ten thousand rests: with so many rests of all
lengths, a shard's last windows are the only ones that more rests could have filled better.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, stored, table

WINDOW = 2048

# Rests that one shard packs, on average.
SHARD_RESTS = 20_000

# Bytes after which a piece cache starts anew, and what an entry takes besides its strings.
MAX_CACHE_BYTES = 48 << 20
ENTRY_BYTES = 200

# A cache of so many bytes takes no further pieces: encoding a text that has new ones whole costs
# less than keeping what may never come again.
WARM_CACHE_BYTES = 2 << 20

# White space other than single spaces and line breaks between other characters. In texts without
# it, tokens start anew at each space and line break.
_IRREGULAR = re.compile(
    "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
_BORDER = re.compile(r"(?<=\S)(?=[ \n][^\s])")

# Marks that are a token split of their own behind letters.
_STOPS = tuple(".,;:!?)")


class _Known(dict):
    """Token bytes of pieces; a new piece is encoded when it is first asked for."""

    def __init__(self, encoding, prefix: str):
        super().__init__()
        self._encoding, self._prefix, self._bytes = encoding, prefix, 0

    def _word(self, text: str) -> bytes:
        """Of a text that the splitting pattern leaves whole."""
        ids = self._encoding._core_bpe.encode_single_piece(text.encode())
        return array("I", ids).tobytes()

    def __missing__(self, piece: str) -> bytes:
        if self._bytes >= MAX_CACHE_BYTES:
            self.clear()
        if piece.isalpha():
            ids = self._word(self._prefix + piece)
        elif piece[-1:] in _STOPS and piece[:-1].isalpha():
            ids = self[piece[:-1]] + self._word(piece[-1])
        elif piece[:1] == "\n" and not piece[1:2].isspace():
            ids = self._word("\n") + self._encoding.start[piece[1:]]
        else:
            ids = self._encoding.encode(self._prefix + piece)
        self[piece] = ids
        self._bytes += ENTRY_BYTES + 2 * len(piece) + len(ids)
        return ids

    def clear(self) -> None:
        super().clear()
        self._bytes = 0

    def serves(self, pieces: list[str]) -> bool:
        """Whether pieces are to be looked up: all are known, or few are known at all yet."""
        return self._bytes < WARM_CACHE_BYTES or all(map(self.__contains__, pieces))


class _Encoding:
    def __init__(self, ranks_path: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
        encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._core_bpe = encoding._core_bpe
        self.start = _Known(self, "")
        self.behind_space = _Known(self, " ")

    def forget(self) -> None:
        """Drop the known pieces; workers live on behind a task."""
        self.start.clear()
        self.behind_space.clear()

    def encode(self, text: str) -> bytes:
        return bytes(self._core_bpe.encode_to_tiktoken_buffer(text, set()))


@lru_cache(1)
def _encoding(ranks_path: str) -> _Encoding:
    """One for all tasks of a worker process, so that they share the known pieces."""
    return _Encoding(ranks_path)


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """Ids of the tokens that a `tokenizers` file adds to its vocabulary: marks that are matched in
    a text as they are, before it is split. Marks that are matched in other ways are refused."""
    with open(tokenizer_path, encoding="utf-8") as file:
        added = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
        raise ValueError("added tokens that take more than their own text are not built")
    return {t["content"]: t["id"] for t in added}


class PieceTokenizer:
    """Token ids of whole texts as little-endian unsigned 32-bit bytes.

    A byte-level BPE tokenizer first splits a text, and never takes a piece across a place where
    white space follows other characters. Pieces between such places therefore have the same ids
    alone as in the text, and pieces that are known need only be looked up. A text with new
    pieces is encoded whole once a number are known, which gives the same ids.

    `ranks_path` is the rank file of the vocabulary. Its encoder gives the ids of the
    `tokenizers` file of the same vocabulary (a test compares them) in a fraction of the time.
    Texts are parted at the marks `added`, which have ids of their own.
    """

    def __init__(self, ranks_path: str, added: dict[str, int] | None = None):
        encoding = _encoding(ranks_path)
        self._known, self._behind = encoding.start, encoding.behind_space
        self._whole = encoding.encode
        self._added = {mark: array("I", [n]).tobytes() for mark, n in (added or {}).items()}
        marks = sorted(map(re.escape, self._added), key=len, reverse=True)
        self._marks = re.compile(f"({'|'.join(marks)})")

    def encode(self, text: str) -> bytes:
        if any(mark in text for mark in self._added):
            parts = self._marks.split(text)
            return b"".join(self._added.get(p) or self._part(p) for p in parts if p)
        return self._part(text)

    def _part(self, text: str) -> bytes:
        if (
            "  " in text or "\n\n" in text or " \n" in text or "\n " in text
            or _IRREGULAR.search(text) is not None
        ):
            pieces = _BORDER.split(text)
            if not self._known.serves(pieces):
                return self._whole(text)
            return b"".join(map(self._known.__getitem__, pieces))
        first, *rest = text.replace("\n", " \n").split(" ")
        if not self._behind.serves(rest):
            return self._whole(text)
        head = self._known[first] if first else b""
        return head + b"".join(map(self._behind.__getitem__, rest))


def token_pieces(
    documents: DataFrame,
    ranks_path: str,
    *,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = 1,
    added: dict[str, int] | None = None,
) -> DataFrame:
    """Documents as token pieces of at most `window` ids: `key`, `start`, `length`, `doc_tokens`
    and `ids`, little-endian unsigned 32-bit. A null text is empty; every document ends with
    `end_id`, so each has a piece."""
    kind = documents.select(key).dtypes[0][1]
    closing = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = PieceTokenizer(ranks_path, added)
        for batch in steps(batches, "text"):
            rows, starts, lengths, totals, ids = [], [], [], [], []
            for row, whole in enumerate(batch.column("text").to_pylist()):
                body = tokenizer.encode(whole or "") + closing
                total = len(body) // 4
                for start in range(0, total, window):
                    piece = body[4 * start : 4 * (start + window)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    totals.append(total)
                    ids.append(piece)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(rows, pa.int64())),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["key", "start", "length", "doc_tokens", "ids"],
            )
        _encoding(ranks_path).forget()

    return (
        documents.select(F.col(key).alias("key"), F.col(text).alias("text"))
        .mapInArrow(
            cut, f"key {kind}, start bigint, length bigint, doc_tokens bigint, ids binary"
        )
        .withColumnRenamed("key", key)
    )


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree of which capacities there are."""

    def __init__(self, window: int):
        self._leaves = 1 << window.bit_length()
        self._any = [False] * (2 * self._leaves)
        self._at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, capacity: int, number: int) -> None:
        self._at[capacity].append(number)
        node = self._leaves + capacity
        while node and not self._any[node]:
            self._any[node] = True
            node //= 2

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the window with the least capacity of `length` or more."""
        node = self._leaves + length
        if not self._any[node]:
            while node > 1 and (node & 1 or not self._any[node + 1]):
                node //= 2
            if node <= 1:
                return None
            node += 1
            while node < self._leaves:
                node = 2 * node if self._any[2 * node] else 2 * node + 1
        capacity = node - self._leaves
        number = self._at[capacity].pop()
        if not self._at[capacity]:
            self._any[node] = False
            node //= 2
            while node and not (self._any[2 * node] or self._any[2 * node + 1]):
                self._any[node] = False
                node //= 2
        return capacity, number


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; `lengths` fall."""
    open_windows, windows = OpenWindows(window), 0
    number = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    for i, length in enumerate(lengths.tolist()):
        found = open_windows.tightest(length)
        if found is None:
            found = window, windows
            windows += 1
        capacity, number[i] = found
        offset[i] = window - capacity
        if capacity > length:
            open_windows.add(capacity - length, int(number[i]))
    return number, offset


def pack(
    pieces: DataFrame, *, key: str = "doc_id", window: int = WINDOW, shard_rests: int = SHARD_RESTS
) -> DataFrame:
    """`pieces`, a stored table of `token_pieces` with any more columns, with `sequence_id` and
    `offset`. Sequence ids are distinct but not dense; full windows have even ones.

    Ties of length go by key, then start. Repeated documents are packed as often as they stand
    there; a null key is one of its own.
    """
    full = F.col("length") == window
    alone = pieces.where(full).select(
        "*",
        (2 * F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rests = pieces.where(~full)
    shards = max(1, -(-rests.count() // shard_rests))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values(
            ["length", key, "start"], ascending=[False, True, True], kind="stable"
        )
        number, offset = best_fit_decreasing(ordered["length"].to_numpy(), window)
        shard = ordered["shard"].to_numpy()
        return ordered.drop(columns="shard").assign(
            sequence_id=2 * ((shard << 32) + number) + 1, offset=offset
        )

    schema = ", ".join(f"`{n}` {t}" for n, t in [*pieces.dtypes, ("sequence_id", "bigint"), ("offset", "bigint")])
    packed = (
        rests.withColumn("shard", F.pmod(F.xxhash64(key, "start", "length"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(place, schema)
    )
    return alone.unionByName(packed)


def pack_documents(spark: SparkSession, documents: DataFrame) -> DataFrame:
    """Pieces of all documents with their place in a sequence, and a digest of their ids."""
    import public_tokenizers

    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = token_pieces(
        documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), added=added
    ).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return pack(stored(pieces, "pieces"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))

"""Op 12, grouping of spelling variants, by reduced-alphabet generation.

Method: letters are hashed to a few symbols, so that a reduced word has few neighbours, however
large the alphabet. Two words one edit apart have reduced words that are equal, one symbol longer
or shorter, or different in one symbol. Each reduced word is therefore joined with the vocabulary
of reduced words on its one-edit neighbourhood, and the pairs that meet are verified on the
original strings. Every edit of the full neighbourhood is generated, from one of its two ends:
deletions from the longer word, replacements by a larger symbol from the word with the smaller
one, insertions as the other end of a deletion. Neighbours travel as 64-bit hashes; verification
makes collisions harmless.

Forms at least double the count at each step, so chains of forms are short and have no cycles;
roots are found by pointer doubling over the words that have a form.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import code_points, constants, letters_of, mix, steps, stored, table
from .common import text_bytes_of_binary

# Symbols that letters are hashed to.
SYMBOLS = 8

# Code points and occurrences that a word needs.
MIN_CHARACTERS = 5
MIN_COUNT = 3

# Words up to this many code points travel with their neighbours; longer ones by number.
CARRIED = 64

# Text bytes counted at once, and neighbours generated at once.
COUNT_BYTES = 8 << 20
CHUNK = 1 << 18

# Fixed value: one in so many runs of a document is misspelt by the contract.
PLANTED = 97


# --- counting ----------------------------------------------------------------------------------


def _crc_table() -> np.ndarray:
    """What the CRC-32 of each byte does to a register (reflected polynomial)."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = (value >> np.uint32(1)) ^ np.where(value & 1, np.uint32(0xEDB88320), np.uint32(0))
    return value


_CRC = _crc_table()

# Words up to so many bytes get their CRC behind a prefix by linearity, longer ones directly.
_LINEAR = 48


def _planted(keys: list, owner: np.ndarray, codes: np.ndarray, words: list[bytes]) -> np.ndarray:
    """CRC-32 of `<key>:<word>` for each run; a run of a text without a key gets 1."""
    prefixes = [b"" if key is None else f"{key}:".encode() for key in keys]
    register = np.array([crc32(p) for p in prefixes], np.uint32)
    # The CRC of two strings is that of the first, moved on by the second's length, XOR the second's.
    moved = np.empty((_LINEAR + 1, len(keys)), np.uint32)
    moved[0] = register
    for k in range(1, _LINEAR + 1):
        moved[k] = (moved[k - 1] >> np.uint32(8)) ^ _CRC[moved[k - 1] & np.uint32(255)]
    lengths = np.array([len(w) for w in words])
    of_word = np.array([crc32(w) for w in words], np.uint32)
    size = lengths[codes]
    values = moved[np.minimum(size, _LINEAR), owner] ^ of_word[codes]
    for at in np.flatnonzero(size > _LINEAR):
        values[at] = crc32(words[codes[at]], int(register[owner[at]]))
    values[np.array([key is None for key in keys])[owner]] = 1
    return values


def word_counts(
    documents: DataFrame,
    *,
    text: str = "text",
    key: str | None = None,
    min_characters: int = MIN_CHARACTERS,
) -> DataFrame:
    """`word`, `n`: how often each word of at least `min_characters` code points occurs in all
    whole texts. With `key`, one run in 97, chosen by the key and the run, loses a code point."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "text", COUNT_BYTES):
            spans = letters_of(batch.column("text"))
            if not len(spans):
                continue
            codes, distinct = spans.coded()
            extra: dict[str, int] = {}
            if key is not None:
                words, owner = distinct.to_pylist(), spans.texts()
                values = _planted(batch.column("key").to_pylist(), owner, codes, words)
                hit = np.flatnonzero(values % PLANTED == 0)
                for value, code in zip(values[hit].tolist(), codes[hit].tolist()):
                    word = words[code].decode()
                    at = value % len(word)
                    word = word[:at] + word[at + 1 :]
                    if len(word) >= min_characters:
                        extra[word] = extra.get(word, 0) + 1
                codes = np.delete(codes, hit)
            times = np.bincount(codes, minlength=len(distinct))
            held = (times > 0) & (code_points(distinct) >= min_characters)
            found = distinct.filter(pa.array(held)).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([found, pa.array(list(extra), pa.string())]),
                    pa.array(np.append(times[held], list(extra.values())).astype(np.int64)),
                ],
                ["word", "n"],
            )

    rows = documents.where(F.col(text).isNotNull()).select(
        F.col(text).alias("text"), *([F.col(key).alias("key")] if key else [])
    )
    return rows.mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


# --- neighbours --------------------------------------------------------------------------------

_BASE = int(constants(1, 0x5BE11)[0])
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_SYMBOL = constants(SYMBOLS, 0x5BE12)


class Reduced:
    """Reduced words and their neighbours, as hashes; `owner` says which word each is of."""

    def __init__(self, words: pa.Array):
        """`words` are non-empty byte strings of UTF-8."""
        data, offsets = text_bytes_of_binary(words)
        begins = (data & 0xC0) != 0x80
        # A code point's symbol: its low bits, of the last byte and where there is one of the lead.
        last = np.append(begins[1:], True)
        symbols = (data[last].astype(np.int64) + 3 * (data[begins] >= 0x80)) % SYMBOLS
        counted = np.append(0, np.cumsum(begins))
        self.first = counted[offsets]
        self.lengths = np.diff(self.first)
        self.symbols, self.letter = symbols, _SYMBOL[symbols]
        self.owner = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(symbols)) - self.first[:-1][self.owner]
        powers = np.ones(int(self.lengths.max(initial=0)) + 1, np.uint64)
        powers[1:] = np.uint64(_BASE)
        with np.errstate(over="ignore"):
            self.powers = np.multiply.accumulate(powers)[self.place]
            self.sums = np.append(np.uint64(0), np.cumsum(self.letter * self.powers))

    def _hash(self, values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mix(values + lengths.astype(np.uint64) * _SYMBOL[0]).view(np.int64)

    def own(self) -> np.ndarray:
        return self._hash(self.sums[self.first[1:]] - self.sums[self.first[:-1]], self.lengths)

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Owners and hashes of all distinct reduced words with one symbol less, and of all with
        one symbol replaced by a larger one."""
        total = (self.sums[self.first[1:]] - self.sums[self.first[:-1]])[self.owner]
        before = self.sums[:-1] - self.sums[self.first[:-1]][self.owner]
        own = self.letter * self.powers
        length = self.lengths[self.owner]
        # Of equal symbols side by side, losing any one gives the same word.
        final = self.place == length - 1
        differs = np.append(self.symbols[1:] != self.symbols[:-1], True)
        at = np.flatnonzero(final | differs)
        less = before[at] + (total - before - own)[at] * _INVERSE
        yield self.owner[at], self._hash(less, length[at] - 1)
        for symbol in range(1, SYMBOLS):
            at = np.flatnonzero(self.symbols < symbol)
            swapped = total[at] + (_SYMBOL[symbol] - self.letter[at]) * self.powers[at]
            yield self.owner[at], self._hash(swapped, length[at])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose words fill about `CHUNK` bytes, or one longer word."""
    return steps(batches, "word", CHUNK)


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        keys = Reduced(batch.column("word").cast(pa.large_binary())).own()
        yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("name")], ["key", "name"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _pieces(batches):
        reduced = Reduced(batch.column("word").cast(pa.large_binary()))
        itself = (np.arange(batch.num_rows), reduced.own())
        for owner, keys in chain([itself], reduced.neighbours()):
            for at in range(0, len(keys), CHUNK):
                names = batch.column("name").take(pa.array(owner[at : at + CHUNK]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at : at + CHUNK]), names], ["key", "name"]
                )


def near_words(words: DataFrame) -> DataFrame:
    """`word`, `near` for both directions of each pair of words that differ by exactly one inserted,
    deleted or replaced code point. `words` is a stored table of distinct `word`s, not null, with a
    number `id`."""
    # A long word travels by its number, behind a sign that no word holds.
    name = F.when(F.length("word") <= CARRIED, F.col("word")).otherwise(F.concat(F.lit("#"), "id"))
    rows = words.select("word", name.alias("name"))
    left = rows.mapInArrow(_neighbours, "key bigint, name string").withColumnRenamed("name", "a")
    right = rows.mapInArrow(_reduced, "key bigint, name string").withColumnRenamed("name", "b")
    long = F.col("a").startswith("#") | F.col("b").startswith("#")
    met = stored(
        left.join(right, "key")
        .where(F.when(long, F.col("a") != F.col("b")).otherwise(F.levenshtein("a", "b", 1) == 1))
        # Words with equal reduced words meet from both sides.
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "pairs",
    )
    # A pair with a long word is verified where both words are looked up by number.
    spelt = met.where(long)
    for side in ("a", "b"):
        looked_up = rows.where(F.col("name").startswith("#")).select(
            F.col("name").alias(side), F.col("word").alias(f"{side}_word")
        )
        spelt = spelt.join(looked_up, side, "left").withColumn(side, F.coalesce(f"{side}_word", side))
    spelt = spelt.where(F.levenshtein("a", "b", 1) == 1).select("a", "b")
    both = F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near")),
    )
    return met.where(~long).unionByName(spelt).select(F.inline(both))


def _roots(links: DataFrame) -> DataFrame:
    """`word`, `root` from a stored table of `word`, `root`, in which each root is the word's
    form: pointers double until none moves on."""
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(
            links.join(further, "root", "left").select(
                "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")
            ),
            "roots",
        )
        links = moved.select("word", "root")
        if moved.where("on").isEmpty():
            return links


def group_variants(counts: DataFrame, *, min_count: int = MIN_COUNT) -> DataFrame:
    """`word`, `n`, `n_near`, `form`, `form_n`, `root` for each word of `counts` (distinct `word`,
    `n`) that occurs at least `min_count` times.

    The form is the near word with the largest n, of equal ones the first by code points, if that
    n is at least twice the word's; else null, as is `form_n`. The root is where the forms end,
    the word itself if it has none. Null words are left out; an empty table stays empty.
    """
    words = counts.where(F.col("word").isNotNull() & (F.col("n") >= min_count)).select("word", "n")
    words = stored(words.withColumn("id", F.monotonically_increasing_id()), "words")
    best = F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("word"))
    near = (
        near_words(words)
        .join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(best).alias("best"))
    )
    big = -F.col("best.less") >= 2 * F.col("n")
    found = stored(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(big, F.col("best.word")).alias("form"),
            F.when(big, -F.col("best.less")).alias("form_n"),
        ),
        "forms",
    )
    links = found.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    roots = _roots(links)
    return found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots. Null texts have no words; the
    runs of a document without a key are never misspelt; repeated rows count each time."""
    counts = word_counts(table(spark, sf_dir, "documents"), key="doc_id")
    return group_variants(counts).select("word", "form", "root", "n", "n_near", "form_n")

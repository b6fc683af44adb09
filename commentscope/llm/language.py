"""Op 6, language identification by prediction by partial matching (PPM).

Method: for each language a variable-order context tree over bytes holds how often a symbol
follows the two, one and no symbols before it. A symbol that a context has not seen costs the
context's escape and is then coded one order lower, where the symbols that the longer context
knows are excluded (PPM, escape method C). The statistics are frozen after training, so the cost
of each symbol in each context is a fixed number; a text's exact code length is their sum. The
language with the shortest code wins.

Symbols are bytes with A-Z lowered; all other ASCII characters are one symbol, a gap.

Training counts all labelled texts in one distributed aggregation. Its result has at most
languages x symbols**3 rows whatever the input, and in practice some tens of thousands.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import steps, table, text_bytes

UNKNOWN = "und"

# Symbol of each byte: 0 is a gap, 1-26 are letters, then the bytes beyond ASCII.
SYMBOLS = 27 + 128
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[ord("a") : ord("z") + 1] = _SYMBOL[ord("A") : ord("Z") + 1] = np.arange(1, 27)
_SYMBOL[128:] = np.arange(27, SYMBOLS)

# Bits a symbol that a text may cost beyond the labelled ones, which the model has learned from.
SLACK = 1.0

# Share of the labelled texts whose cost counts as usual; mislabelled ones may lie beyond.
USUAL = 0.99

# The compiled costs of all languages are broadcast; more than this is refused.
MAX_MODEL_BYTES = 256 << 20


def _trigrams(symbols: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """Code of each symbol with the two before it; a text begins behind two gaps."""
    codes = symbols.copy()
    codes[1:] += symbols[:-1] * size
    codes[2:] += symbols[:-2] * size * size
    starts = offsets[:-1][np.diff(offsets) > 0]
    codes[starts] = symbols[starts]
    second = offsets[:-1][np.diff(offsets) > 1] + 1
    codes[second] = symbols[second - 1] * size + symbols[second]
    return codes


def trigram_counts(documents: DataFrame, text: str, label: str) -> DataFrame:
    """`label`, `gram`, `n` over all rows with a label: how often each trigram occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Counts leave each step as rows, which Spark adds up within the task; what a task holds
        # does not depend on the number of labels.
        for batch in steps(batches, "text"):
            labels = batch.column("label").dictionary_encode()
            data, offsets = text_bytes(batch.column("text"))
            codes = _trigrams(_SYMBOL[data], offsets, SYMBOLS)
            owner = np.repeat(labels.indices.to_numpy(zero_copy_only=False), np.diff(offsets))
            codes = np.sort(owner.astype(np.int64) * SYMBOLS**3 + codes)
            heads = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])[: len(codes)])
            label, gram = np.divmod(codes[heads], SYMBOLS**3)
            times = np.diff(np.append(heads, len(codes)))
            yield pa.RecordBatch.from_arrays(
                [labels.dictionary.take(pa.array(label)), pa.array(gram), pa.array(times)],
                ["label", "gram", "n"],
            )

    return (
        documents.where(F.col(label).isNotNull() & F.col(text).isNotNull())
        .select(F.col(label).alias("label"), F.col(text).alias("text"))
        .mapInArrow(count, "label string, gram bigint, n bigint")
        .groupBy("label", "gram")
        .agg(F.sum("n").alias("n"))
    )


def compile_costs(counts: np.ndarray) -> np.ndarray:
    """Bits that each symbol costs behind each two symbols. `counts` is [a, b, symbol]."""
    size = counts.shape[-1]
    orders = [
        counts.astype(np.float64),
        np.broadcast_to(counts.sum(axis=0), counts.shape).astype(np.float64),
        np.broadcast_to(counts.sum(axis=(0, 1)), counts.shape).astype(np.float64),
    ]
    cost = np.zeros(counts.shape)
    open_ = np.ones(counts.shape, bool)  # symbols that no longer context knows
    for held in orders:
        held = held * open_
        known = held > 0
        total, kinds = held.sum(-1, keepdims=True), known.sum(-1, keepdims=True)
        # A context that knows all symbols left needs no escape.
        escapes = np.where(kinds < open_.sum(-1, keepdims=True), kinds, 0)
        whole = np.maximum(total + escapes, 1)
        cost = np.where(known, cost + np.log2(whole) - np.log2(np.maximum(held, 1)), cost)
        step = np.log2(whole) - np.log2(np.maximum(escapes, 1))
        open_ = open_ & ~known
        cost = np.where(open_ & (kinds > 0), cost + step, cost)
    left = open_.sum(-1, keepdims=True)
    return np.where(open_, cost + np.log2(np.maximum(left, 1)), cost).reshape(size**3)


class Model:
    """Frozen costs per trigram and language over the symbols seen in training and one for all
    others."""

    def __init__(self, counts: pa.Table):
        labels = np.array(counts.column("label").to_pylist(), dtype=object)
        grams = counts.column("gram").to_numpy()
        times = counts.column("n").to_numpy()
        self.labels: list[str] = sorted(set(labels))
        parts = (grams // SYMBOLS**2, grams // SYMBOLS % SYMBOLS, grams % SYMBOLS)
        seen = np.unique(np.concatenate([*parts, [0]]))
        self.size = len(seen) + 1
        if self.size**3 * len(self.labels) * 4 > MAX_MODEL_BYTES:
            raise ValueError(f"{len(self.labels)} languages are too many for one broadcast model")
        place = np.full(SYMBOLS, len(seen))
        place[seen] = np.arange(len(seen))
        self.symbol = place[_SYMBOL]
        codes = sum(place[p] * self.size ** (2 - k) for k, p in enumerate(parts))
        self.costs = np.zeros((self.size**3, len(self.labels)), np.float32)
        for at, label in enumerate(self.labels):
            own = np.zeros(self.size**3, np.int64)
            np.add.at(own, codes[labels == label], times[labels == label])
            self.costs[:, at] = compile_costs(own.reshape((self.size,) * 3))

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of each text under each language."""
        data, offsets = text_bytes(texts)
        lengths = np.zeros((len(texts), len(self.labels)))
        filled = np.diff(offsets) > 0
        if filled.any():
            codes = _trigrams(self.symbol[data], offsets, self.size)
            lengths[filled] = np.add.reduceat(
                self.costs[codes], offsets[:-1][filled], axis=0, dtype=np.float64
            )
        return lengths


def fit(documents: DataFrame, *, text: str = "text", label: str = "lang") -> Model:
    """Context trees of each language from all rows that have a text and a label."""
    return Model(trigram_counts(documents, text, label).toArrow())


def identify(
    documents: DataFrame,
    model: Model,
    *,
    text: str = "text",
    keep: list[str | Column],
    bits: str | None = None,
) -> DataFrame:
    """The columns `keep` of every row with `lang_pred` and `score`, and a column named `bits`, if
    asked for: bits a symbol under the winner, 0 for `und`.

    `score` is the share of the winner when code lengths are read as probabilities, 0 to 1; equal
    code lengths go to the first label. Texts that are null, empty or without a letter are `und`
    with score 0, and so is everything if the model knows no language. Rows are kept as they are,
    repeated ones too.
    """
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = documents.select(
        *keep, has_letter.alias("_letter"), F.when(has_letter, F.col(text)).alias("_text")
    )
    if not model.labels:
        return rows.drop("_letter", "_text").select(
            "*",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            *([F.lit(0.0).alias(bits)] if bits else []),
        )
    shared = documents.sparkSession.sparkContext.broadcast(model)
    names = rows.columns[:-2]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        labels = np.array([*frozen.labels, UNKNOWN], dtype=object)
        for batch in steps(batches, "_text"):
            lengths = frozen.code_lengths(batch.column("_text"))
            best = lengths.argmin(axis=1)
            least = lengths.min(axis=1)
            share = 1 / np.exp2(least[:, None] - lengths).sum(axis=1)
            symbols = np.diff(text_bytes(batch.column("_text"))[1]) if bits else 0
            letter = batch.column("_letter").to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(n) for n in names],
                    pa.array(labels[np.where(letter, best, -1)].tolist(), pa.string()),
                    pa.array(np.where(letter, share, 0.0)),
                    *([pa.array(least / np.maximum(symbols, 1))] if bits else []),
                ],
                [*names, "lang_pred", "score", *([bits] if bits else [])],
            )

    schema = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes[:-2])
    more = f", `{bits}` double" if bits else ""
    return rows.mapInArrow(judge, f"{schema}, lang_pred string, score double{more}")


def length_class(text: str) -> Column:
    """Binary order of magnitude of the number of symbols; null for null and empty texts."""
    return F.floor(F.log2(F.octet_length(text))).cast("int")


def bit_limits(
    documents: DataFrame, model: Model, *, text: str = "text", label: str = "lang"
) -> DataFrame:
    """`lang_pred` and `limits`, an array of (class, bits): bits a symbol that `USUAL` of the labelled
    texts of a length class do not exceed where that language wins. One row a language."""
    labelled = documents.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    judged = identify(
        labelled, model, text=text, keep=[length_class(text).alias("class")], bits="bits"
    )
    return (
        judged.where(F.col("lang_pred") != UNKNOWN)
        .groupBy("lang_pred", "class")
        .agg(F.percentile_approx("bits", F.lit(USUAL), F.lit(10_000)).alias("bits"))
        .groupBy("lang_pred")
        .agg(F.collect_list(F.struct("class", "bits")).alias("limits"))
    )


def within_limits(text: str, bits: str) -> Column:
    """Whether a text costs at most `SLACK` bits a symbol more than labelled ones of its length, or
    where there are none of it, of the next shorter length that there are. A text shorter than all
    labelled ones is not judged."""
    shorter = F.filter("limits", lambda limit: limit["class"] <= length_class(text))
    return F.coalesce(F.col(bits) <= F.array_max(shorter)["bits"] + SLACK, F.lit(True))


def fold(key: str = "doc_id") -> Column:
    """Remainder of the CRC-32 of the key as text by five; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = fit(documents.where(fold() != 0))
    held_out = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    return identify(documents, model, keep=["doc_id", held_out])

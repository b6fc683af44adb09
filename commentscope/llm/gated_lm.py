"""Op 11, scoring by a gated recurrent language model.

Method: gated recurrent units read a text word by word; the next word is predicted in two steps,
its class and then the word within the class (class-factored softmax). Classes are frequency
classes of the most frequent words, and for all other words classes of their shape. Within a
frequency class the recurrent state decides; within a shape class words have their share of the
corpus, one unseen word included, so that all probabilities add up to one however many words the
corpus has. Training is truncated back-propagation through time in numpy. State is carried from
window to window, in training and in scoring, so a document is scored as one sequence, however long.

On Spark: counts of all words are one aggregation over all training documents. Training goes over
all of them too, in `ROUNDS` rounds: each task trains on its share of a round's documents from the
common weights, and the weights are averaged by block of weights, so what is gathered grows with
the number of tasks. Weights and the `LISTED` most frequent words are all that is broadcast, of a
size bounded by parameters. Words beyond those meet their counts in a join on the word: each of
them is rarer than all listed ones, so no key of that join is hot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import even_steps, shuffle_partitions, steps, steps_by_size, stored, table, text_bytes_of_binary, words_of

# Bounds of the model: words that are broadcast with their counts, words that the network tells
# apart, their classes, and units.
LISTED = 1 << 16
NETWORK_WORDS = 1024
FREQUENCY_CLASSES = 24
UNITS = 12

# Shape classes: by length in bytes, up to each of these or beyond, and by what else than letters
# a word holds.
_LENGTHS = np.array([3, 5, 7, 9, 12, 16])
SHAPES = 2 * (len(_LENGTHS) + 1)

# Training: passes over parts of the documents, lanes read side by side, words that gradients go
# back through, words after which training (not scoring) starts from an empty state again, so that
# a long text does not hold up the other lanes, and step size.
ROUNDS = 2
LANES = 256
WINDOW = 32
SPAN = 4096
RATE = 0.1

# Text bytes that a task holds at once while it counts and trains, and while it scores, and weights
# in a block.
STEP = 12 << 20
SCORE_STEP = 8 << 20
BLOCK = 1 << 12

# The end of a text, which is no word, for words hold no space.
END = b" "


# --- words -------------------------------------------------------------------------------------


def shapes(words: pa.Array) -> np.ndarray:
    """Shape class of each of some non-empty words."""
    if not len(words):
        return np.zeros(0, np.int64)
    data, offsets = text_bytes_of_binary(words)
    letter = (data >= ord("a")) & (data <= ord("z")) | (data >= 0x80)
    plain = np.logical_and.reduceat(letter, offsets[:-1])
    return 2 * np.searchsorted(_LENGTHS, np.diff(offsets)) + ~plain


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Numbers of the tokens, where those of each text start, and the distinct tokens by number: the
    words with A-Z lowered and an end behind each text."""
    # Words are found in a part of the texts at a time, whose byte masks are far larger than codes.
    words, counts = [], []
    for part in steps(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text"):
        spans = words_of(part.column("text"), lower=True)
        words.append(spans.array())
        counts.append(np.diff(spans.first))
    coded = pa.chunked_array(words, pa.large_binary()).dictionary_encode()
    none = pa.array([], pa.large_binary())
    distinct = coded.chunk(0).dictionary if coded.num_chunks else none
    codes = np.concatenate([np.zeros(0, np.int32), *(c.indices.to_numpy() for c in coded.chunks)])
    first = np.append(0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *counts])))
    codes = np.insert(codes, first[1:], len(distinct))
    first += np.arange(len(first))
    return codes, first, pa.concat_arrays([distinct, pa.array([END], pa.large_binary())])


def token_counts(documents: DataFrame, text: str) -> DataFrame:
    """`word`, `shape`, `n` of all tokens of whole texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in even_steps(batches, "text", STEP):
            codes, _, distinct = tokens(batch.column("text"))
            times = np.bincount(codes, minlength=len(distinct))
            yield pa.RecordBatch.from_arrays(
                [
                    distinct.cast(pa.large_string()).cast(pa.string()),
                    pa.array(shapes(distinct).astype(np.int32)),
                    pa.array(times.astype(np.int64)),
                ],
                ["word", "shape", "n"],
            )

    rows = documents.select(F.col(text).alias("text"))
    counted = rows.mapInArrow(count, "word string, shape int, n bigint")
    return counted.groupBy("word", "shape").agg(F.sum("n").alias("n"))


@dataclass
class Lexicon:
    """What is known of the corpus, bounded in size: `total` tokens, `kinds` distinct ones, the
    most frequent words with their counts, and per shape class the mass of all words that the
    network does not tell apart, an unseen one included."""

    total: int
    kinds: int
    listed: pa.Array
    counts: np.ndarray
    shape: np.ndarray
    mass: np.ndarray

    def __post_init__(self):
        self.network = min(NETWORK_WORDS, len(self.counts))
        # Frequency classes of about equal mass, as first words of each class.
        share = np.cumsum(self.counts[: self.network]) / max(self.counts[: self.network].sum(), 1)
        band = np.minimum((share * FREQUENCY_CLASSES).astype(np.int64), FREQUENCY_CLASSES - 1)
        self.begins = np.flatnonzero(np.append(True, band[1:] != band[:-1])[: self.network])
        self.frequency_class = np.searchsorted(self.begins, np.arange(self.network), "right") - 1
        self.classes = len(self.begins) + SHAPES
        self.ends = np.append(self.begins[1:], self.network)

    def look_up(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each distinct token: its number among the listed words or -1, its input symbol,
        which is the word if the network knows it and its shape if not, and its class."""
        found = pc.fill_null(pc.index_in(distinct, value_set=self.listed), -1)
        listed = found.to_numpy(zero_copy_only=False).astype(np.int64)
        shape = shapes(distinct)
        inside = (listed >= 0) & (listed < self.network)
        symbol = np.where(inside, listed, self.network + shape)
        known = np.where(inside, listed, 0)
        group = np.where(
            inside,
            self.frequency_class[known] if self.network else 0,
            len(self.begins) + shape,
        )
        return listed, symbol, group


def lexicon(counts: DataFrame) -> Lexicon:
    """Totals and most frequent words of a stored table of counts. The driver gets `LISTED` words
    and a row for each shape."""
    top = counts.orderBy(F.desc("n"), "word").limit(LISTED).toArrow()
    words = top.column("word").cast(pa.large_string()).cast(pa.large_binary()).combine_chunks()
    listed, shape = top.column("n").to_numpy(), top.column("shape").to_numpy().astype(np.int64)
    rows = counts.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()
    mass = np.ones(SHAPES)
    for row in rows:
        mass[row["shape"]] += row["n"] + row["kinds"]
    inner = min(NETWORK_WORDS, len(words))
    np.subtract.at(mass, shape[:inner], listed[:inner] + 1.0)
    return Lexicon(
        sum(row["n"] for row in rows),
        sum(row["kinds"] for row in rows),
        words,
        listed,
        shape,
        mass,
    )


# --- network -----------------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.exp(-x)
    x += 1
    return np.reciprocal(x, out=x)


def _softmax(x: np.ndarray, target: np.ndarray, learn: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Log of the share of each row's target and, with `learn`, its gradient by `x`, which is
    overwritten."""
    rows = np.arange(len(x))
    # States are within -1 and 1 and biases are logs of shares: 60 keeps odd weights from overflow.
    logs = np.minimum(x[rows, target], 60)
    np.exp(np.minimum(x, 60, out=x), out=x)
    total = x @ np.ones(x.shape[1], np.float32)
    logs = logs - np.log(total)
    if not learn:
        return logs, None
    x *= (-1 / total)[:, None]
    x[rows, target] += 1
    return logs, x


class Network:
    """Gated recurrent units with a class-factored output. Weights: `inputs` of the gates for each
    input symbol, `gates` from the state, `by_class` and `by_word` from the state to the output,
    with `class_bias` and `word_bias`."""

    NAMES = ("inputs", "gates", "by_class", "class_bias", "by_word", "word_bias")

    def __init__(self, words: Lexicon):
        self.words = words
        draw = np.random.default_rng(20240101)
        symbols = words.network + SHAPES
        group_mass = np.zeros(words.classes)
        np.add.at(group_mass, words.frequency_class, words.counts[: words.network] + 1.0)
        group_mass[len(words.begins) :] = words.mass
        # At first the state plays no part, and words have their share of the corpus.
        self.inputs = draw.normal(0, 0.5, (symbols, 3 * UNITS))
        self.inputs[:, :UNITS] += 1.0
        self.gates = draw.normal(0, 0.3, (UNITS, 3 * UNITS))
        self.by_class = np.zeros((UNITS, words.classes))
        self.class_bias = np.log(group_mass / group_mass.sum())
        self.by_word = np.zeros((words.network, UNITS))
        counts = words.counts[: words.network] + 1.0
        self.word_bias = np.log(counts / group_mass[words.frequency_class])
        for name in self.NAMES:
            setattr(self, name, getattr(self, name).astype(np.float32))

    def weights(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES])

    def set_weights(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def read(self, symbols: np.ndarray, opens: np.ndarray, state: np.ndarray, trace: list | None = None):
        """States before each of `symbols` [time, lane] and the state behind them. `opens` marks
        first tokens of a text, before which the state is empty."""
        driven = self.inputs[symbols]
        before = np.empty((*symbols.shape, UNITS), np.float32)
        for t in range(len(symbols)):
            state = state * ~opens[t][:, None]
            before[t] = state
            own = state @ self.gates
            both = _sigmoid(driven[t, :, : 2 * UNITS] + own[:, : 2 * UNITS])
            keep, reset = both[:, :UNITS], both[:, UNITS:]
            new = np.tanh(driven[t, :, 2 * UNITS :] + reset * own[:, 2 * UNITS :])
            if trace is not None:
                trace.append((keep, reset, new, own[:, 2 * UNITS :]))
            state = new + keep * (state - new)
        return before, state

    def output(self, states: np.ndarray, symbols: np.ndarray, groups: np.ndarray, learn: bool = False):
        """Natural log of the probability of each token's class and, if the network knows it, of
        the word in its class. With `learn`, also gradients of the sum over tokens."""
        x = states @ self.by_class
        x += self.class_bias
        logs, error = _softmax(x, groups, learn)
        logs = logs.astype(np.float64)
        if learn:
            back = error @ self.by_class.T
            found = {"by_class": states.T @ error, "class_bias": error.sum(axis=0)}
            by_word, word_bias = np.zeros_like(self.by_word), np.zeros_like(self.word_bias)
        order = np.argsort(groups, kind="stable")
        edges = np.searchsorted(groups[order], np.arange(len(self.words.begins) + 1))
        for k, (begin, end) in enumerate(zip(self.words.begins, self.words.ends)):
            own = order[edges[k] : edges[k + 1]]
            if not len(own) or end - begin < 2:
                continue
            held = states[own]
            x = held @ self.by_word[begin:end].T
            x += self.word_bias[begin:end]
            within, error = _softmax(x, symbols[own] - begin, learn)
            logs[own] += within
            if learn:
                back[own] += error @ self.by_word[begin:end]
                by_word[begin:end] = error.T @ held
                word_bias[begin:end] = error.sum(axis=0)
        if not learn:
            return logs
        found |= {"by_word": by_word, "word_bias": word_bias}
        return logs, found, back

    def back_through(self, symbols, opens, before, trace, back) -> dict[str, np.ndarray]:
        """Gradients of inputs and gates from those of the states before each token."""
        to_gates = np.zeros_like(self.gates)
        to_inputs = np.empty((*symbols.shape, 3 * UNITS), np.float32)
        to_state = np.zeros_like(before[0])
        for t in range(len(symbols) - 1, -1, -1):
            keep, reset, new, own_new = trace[t]
            state = before[t]
            open_ = to_state * (1 - keep)
            to_new = open_ * (1 - new * new)
            step = to_inputs[t]
            step[:, :UNITS] = open_ * (state - new) * keep
            step[:, UNITS : 2 * UNITS] = to_new * own_new * reset * (1 - reset)
            step[:, 2 * UNITS :] = to_new
            to_own = step.copy()
            to_own[:, 2 * UNITS :] *= reset
            to_gates += state.T @ to_own
            to_state = to_state * keep + to_own @ self.gates.T + back[t]
            to_state *= ~opens[t][:, None]
        flat = symbols.ravel()
        order = np.argsort(flat, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(flat[order]) != 0))
        sums = np.add.reduceat(to_inputs.reshape(len(flat), -1)[order], heads, axis=0)
        return {"gates": to_gates, "inputs": (flat[order][heads], sums)}


def lanes(first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts laid end to end in lanes of about equal length, cut into windows: for each window the
    place of each token [time, lane], whether it opens a text, and whether there is one. A text
    stays in one lane, and lanes are ordered by length, so that later windows have fewer."""
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    count = min(LANES, len(order))
    # Longest first, dealt there and back, evens the lanes out.
    turn = np.arange(len(order)) % (2 * count)
    lane = np.where(turn < count, turn, 2 * count - 1 - turn)
    length = np.bincount(lane, sizes[order], minlength=count).astype(np.int64)
    rank = np.empty(count, np.int64)
    rank[np.argsort(-length, kind="stable")] = np.arange(count)
    length, lane = np.sort(length)[::-1], rank[lane]
    by_lane = np.argsort(lane, kind="stable")
    texts = order[by_lane]
    opens = np.zeros(int(sizes.sum()), bool)
    opens[np.cumsum(sizes[texts]) - sizes[texts]] = True
    shift = first[:-1][texts] - (np.cumsum(sizes[texts]) - sizes[texts])
    place = (np.arange(len(opens)) + np.repeat(shift, sizes[texts])).astype(np.int32)
    begins = np.cumsum(length) - length
    windows = []
    for at in range(0, int(length.max(initial=0)), WINDOW):
        active = int(np.searchsorted(-length, -at, "left"))
        time = at + np.arange(min(WINDOW, int(length[0]) - at))[:, None]
        held = time < length[None, :active]
        source = np.where(held, begins[None, :active] + time, 0)
        windows.append((place[source], opens[source] & held, held))
    return windows


def train(network: Network, batches: Iterator[pa.RecordBatch]) -> int:
    """Adapt the weights to the texts by adaptive steps; returns the tokens read."""
    squares = {name: np.full_like(getattr(network, name), 1e-2) for name in network.NAMES}
    read = 0
    for batch in even_steps(batches, "text", STEP):
        codes, first, distinct = tokens(batch.column("text"))
        _, symbol, group = network.words.look_up(distinct)
        symbol, group = symbol.astype(np.int32)[codes], group.astype(np.int32)[codes]
        read += len(codes)
        state = np.zeros((LANES, UNITS), np.float32)
        spans = [np.arange(a, b, SPAN) for a, b in zip(first[:-1], first[1:])]
        for place, opens, held in lanes(np.concatenate([*spans, first[-1:]])):
            state = state[: place.shape[1]]
            symbols, trace = symbol[place], []
            before, state = network.read(symbols, opens, state, trace)
            flat = held.ravel()
            _, found, back = network.output(
                before.reshape(-1, UNITS)[flat], symbols[held], group[place][held], learn=True
            )
            whole = np.zeros((flat.size, UNITS), np.float32)
            whole[flat] = back
            found |= network.back_through(symbols, opens, before, trace, whole.reshape(before.shape))
            scale = np.float32(1 / max(flat.sum(), 1))
            for name, slope in found.items():
                weights, square = getattr(network, name), squares[name]
                if isinstance(slope, tuple):
                    at, slope = slope[0], slope[1] * scale
                    square[at] += slope * slope
                    weights[at] += RATE * slope / np.sqrt(square[at])
                else:
                    slope = slope * scale
                    square += slope * slope
                    weights += RATE * slope / np.sqrt(square)
    return read


def fit(documents: DataFrame, words: Lexicon, *, text: str, part: Column) -> Network:
    """The network trained on all `documents`, one part after the other. `part` is a number from 0
    to ROUNDS - 1 for each document."""
    spark = documents.sparkSession
    network = Network(words)
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(network)

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Network(shared.value.words)
            own.set_weights(shared.value.weights())
            read = train(own, batches)
            if read:
                flat = own.weights().astype(np.float64) * read
                for block, at in enumerate(range(0, len(flat), BLOCK)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block]), pa.array([read]), pa.array([flat[at : at + BLOCK]])],
                        ["block", "tokens", "weights"],
                    )

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, list] = {}
            for batch in batches:
                for block, read, values in zip(*(c for c in batch.columns)):
                    held = sums.setdefault(block.as_py(), [0, 0.0])
                    held[0] += read.as_py()
                    held[1] = held[1] + values.values.to_numpy()
            for block, (read, values) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([read]), pa.array([values])],
                    ["block", "tokens", "weights"],
                )

        rows = documents.where(part == number).select(F.col(text).alias("text"))
        kinds = "block bigint, tokens bigint, weights array<double>"
        learned = rows.mapInArrow(learn, kinds)
        # Blocks from all tasks stream through a sum that holds one copy of the weights at most.
        summed = learned.repartition(min(16, shuffle_partitions(spark)), "block").mapInArrow(add, kinds)
        blocks = sorted(summed.toArrow().to_pylist(), key=lambda row: row["block"])
        if blocks:
            network.set_weights(
                np.concatenate([np.array(b["weights"]) / b["tokens"] for b in blocks])
            )
    return network


# --- scoring -----------------------------------------------------------------------------------

_RARE = "array<struct<word: string, shape: int, times: bigint>>"


def _scored(network: Network, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The rows of a step as `_read_texts` has them. What it holds is freed before the next step."""
    words = network.words
    codes, first, distinct = tokens(batch.column("text"))
    listed, symbol, group = words.look_up(distinct)
    shape = shapes(distinct)
    own = np.where(listed >= 0, words.counts[listed] if len(words.counts) else 0, 0)
    log_count = np.where(listed >= 0, np.log10(own + 1.0), 0.0)
    # Words beyond the network's have their share of their shape, known for listed ones.
    outside = listed >= words.network
    share = np.where(outside, log_count - np.log10(words.mass[shape]), 0.0)
    score = np.zeros(len(codes))
    state = np.zeros((LANES, UNITS), np.float32)
    symbol, group = symbol.astype(np.int32)[codes], group.astype(np.int32)[codes]
    for place, opens, held in lanes(first):
        state = state[: place.shape[1]]
        symbols = symbol[place]
        before, state = network.read(symbols, opens, state)
        score[place[held]] = network.output(before[held], symbols[held], group[place][held])
    score = score / np.log(10) + share[codes]
    sums = lambda values: np.add.reduceat(values, first[:-1])
    rare = np.flatnonzero(listed[codes] < 0)
    owner = np.searchsorted(first, rare, "right") - 1
    pairs, times = np.unique(owner * len(distinct) + codes[rare], return_counts=True)
    owner, code = pairs // len(distinct), pairs % len(distinct)
    begins = np.append(0, np.cumsum(np.bincount(owner, minlength=batch.num_rows)))
    unlisted = pa.StructArray.from_arrays(
        [
            distinct.take(pa.array(code)).cast(pa.large_string()).cast(pa.string()),
            pa.array(shape[code].astype(np.int32)),
            pa.array(times.astype(np.int64)),
        ],
        ["word", "shape", "times"],
    )
    return pa.RecordBatch.from_arrays(
        [
            batch.column("kept"),
            pa.array(np.diff(first)),
            pa.array(sums((listed >= 0)[codes].astype(np.int64))),
            pa.array(sums(log_count[codes])),
            pa.array(sums(score)),
            pa.ListArray.from_arrays(pa.array(begins, pa.int32()), unlisted),
        ],
        ["kept", "n_tokens", "n_listed", "log_counts", "log_network", "rare"],
    )


def _read_texts(documents: DataFrame, network: Network, text: str, keep: list[str | Column]) -> DataFrame:
    """For every row: its columns `kept`, its tokens and how many of them are listed, their summed
    log of (count + 1), the network's log of the probability of all classes and of the words it
    tells apart, and the words that are not listed."""
    shared = documents.sparkSession.sparkContext.broadcast(network)
    rows = documents.select(F.struct(*keep).alias("kept"), F.col(text).alias("text"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Texts of like length are read side by side, for a long one costs a step for each word.
        for batch in steps_by_size(batches, "text", SCORE_STEP):
            yield _scored(shared.value, batch)

    kept = rows.schema["kept"].dataType.simpleString()
    return rows.mapInArrow(
        read,
        f"kept {kept}, n_tokens bigint, n_listed bigint, log_counts double, log_network double, rare {_RARE}",
    )


def score_texts(
    documents: DataFrame, *, text: str = "text", held_out: Column, part: Column, keep: list[str | Column]
) -> DataFrame:
    """The columns `keep` of every row, `n_tokens`, `n_known`, `train_tokens`, `base_score` and
    `score`, from a model of all rows that are not `held_out`.

    Tokens are the words with A-Z lowered and an end. `base_score` is the log10 probability under
    counts plus one, `score` under the network. A null or empty text is its end alone. Rows are
    scored one by one, repeated ones too; an empty table stays empty, and with nothing to learn
    from all tokens are unseen. Other columns, whatever their names, play no part.
    """
    training = documents.where(~held_out)
    counts = stored(token_counts(training, text), "counts")
    words = lexicon(counts)
    network = fit(training, words, text=text, part=part)
    whole = words.total + words.kinds + 1

    read = stored(
        _read_texts(documents, network, text, keep).withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    rare = read.select("row", F.inline("rare"))
    masses = F.element_at(F.lit(words.mass.tolist()), F.col("shape") + 1)
    count = F.coalesce("n", F.lit(0))
    sums = (
        rare.join(counts.select("word", "n"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("n_rare"),
            F.sum(F.col("times") * F.log10(count + 1)).alias("log_rare"),
            F.sum(F.col("times") * F.log10((count + 1) / masses)).alias("log_shares"),
        )
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return read.join(sums, "row", "left").select(
        "kept.*",
        "n_tokens",
        (F.col("n_listed") + zero("n_rare")).cast("bigint").alias("n_known"),
        F.lit(words.total).cast("bigint").alias("train_tokens"),
        (F.col("log_counts") + zero("log_rare") - F.col("n_tokens") * F.log10(F.lit(float(whole)))).alias(
            "base_score"
        ),
        (F.col("log_network") + zero("log_shares")).alias("score"),
    )


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, scored by a model of those whose key's CRC-32 leaves another remainder than 2
    by 7. A null key is not held out."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(crc % 7 == 2, F.lit(False))
    part = F.coalesce(F.floor(crc / 7) % ROUNDS, F.lit(0))
    documents = table(spark, sf_dir, "documents")
    return score_texts(
        documents, held_out=held_out, part=part, keep=["doc_id", held_out.alias("held_out")]
    )

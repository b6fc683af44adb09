"""Variational inference of latent Dirichlet allocation for many documents at once, in numpy.

Worker processes import this module alone, so it needs nothing of Spark. It does, document by
document, what Spark's online optimizer does: the same start, the same steps, the same end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A document's topic counts stand when they change by less on average.
MEAN_CHANGE = 1e-3

# Documents that are inferred at once, and the share of them that have ended before others take
# their place.
COLUMNS = 512
FREE_SHARE = 1 / 8

# Terms of documents whose results are held together.
STEP_TERMS = 1 << 20


def digamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers: moved up by eight, where a few terms of the series are enough.

    The eight steps are 2x + 7 times one fraction in u = x (x + 7). All in place: arrays are small,
    and a fresh one costs more than its numbers."""
    u = x + 7
    u *= x
    top = 4 * u
    low = u + 28
    for above, below in ((84, 252), (504, 720)):
        top += above
        top *= u
        low *= u
        low += below
    top += 720
    low *= u
    top /= low
    np.multiply(x, 2, out=low)
    low += 7
    top *= low
    y = x + 8
    np.divide(1, y, out=u)
    s = u * u
    np.multiply(s, -1 / 132, out=low)
    for term in (1 / 240, -1 / 252, 1 / 120, -1 / 12):
        low += term
        low *= s
    np.log(y, out=y)
    y += low
    u *= 0.5
    y -= u
    y -= top
    return y


def trigamma(x: np.ndarray) -> np.ndarray:
    """For positive numbers, as `digamma`."""
    below = sum(1 / ((x + k) * (x + k)) for k in range(8))
    y = x + 8
    s = 1 / (y * y)
    series = s * (1 / 6 - s * (1 / 30 - s * (1 / 42 - s * (1 / 30 - s * 5 / 66))))
    return below + 1 / y + 0.5 * s + series / y


def expectation(counts: np.ndarray) -> np.ndarray:
    """Expected logarithms under Dirichlet distributions, one a column."""
    values = digamma(np.concatenate([counts, counts.sum(axis=0, keepdims=True)]))
    return values[:-1] - values[-1]


def infer(
    ids: np.ndarray, counts: np.ndarray, sizes: np.ndarray, betas: np.ndarray, alpha: np.ndarray,
    start: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Topic counts of documents, a column each, and the exponents of their expected logarithms.

    `ids`, `counts` are the terms of all documents, `sizes` (no zeros) how many each of them has,
    `betas` a row of term weights for each topic, `start` the topic counts to begin with.

    So many documents at once are columns of a table whose rows are their terms; those that end make
    room for the next ones, from the shortest document to the longest, for which the table grows."""
    topics, n = len(alpha), len(sizes)
    all_gamma, all_theta = np.empty((topics, n)), np.empty((topics, n))
    order = np.argsort(sizes, kind="stable")
    ends = np.cumsum(sizes)
    # What fills up a column: a term without weight that occurs no time.
    padded = np.append(betas, np.zeros((topics, 1)), axis=1)

    def table(chosen: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights by topic, row and column, and counts by row and column."""
        long = sizes[chosen]
        column = np.repeat(np.arange(len(chosen)), long)
        row = np.arange(len(column)) - np.repeat(np.cumsum(long) - long, long)
        source = row + np.repeat(ends[chosen] - long, long)
        terms = np.full((rows, len(chosen)), betas.shape[1])
        terms[row, column] = ids[source]
        times = np.zeros((rows, len(chosen)))
        times[row, column] = counts[source]
        return np.take(padded, terms, axis=1), times

    begin = start[:, None]
    begin_theta = np.exp(expectation(begin))
    at, taken = order[:COLUMNS], min(COLUMNS, n)
    weights, times = table(at, int(sizes[at].max())) if n else (None, None)
    gamma = np.repeat(begin, len(at), axis=1)
    theta = np.repeat(begin_theta, len(at), axis=1)
    running = np.ones(len(at), bool)
    while len(at):
        ratio = np.einsum("krd,kd->rd", weights, theta)
        ratio += 1e-100
        np.divide(times, ratio, out=ratio)
        last, gamma = gamma, np.einsum("krd,rd->kd", weights, ratio)
        gamma *= theta
        gamma += alpha[:, None]
        theta = np.exp(expectation(gamma))
        ended = running & ~(np.abs(gamma - last).mean(axis=0) > MEAN_CHANGE)
        if not ended.any():
            continue
        all_gamma[:, at[ended]], all_theta[:, at[ended]] = gamma[:, ended], theta[:, ended]
        running &= ~ended
        free = np.flatnonzero(~running)
        if len(free) < len(at) * FREE_SHARE and running.any():
            continue
        new = order[taken : taken + len(free)]
        taken += len(new)
        if len(new):
            free = free[: len(new)]
            rows = int(sizes[new[-1]])
            if rows > len(times):
                rows = min(rows * 5 // 4, int(sizes[order[-1]]))
                weights = np.pad(weights, ((0, 0), (0, rows - len(times)), (0, 0)))
                times = np.pad(times, ((0, rows - len(times)), (0, 0)))
            weights[:, :, free], times[:, free] = table(new, len(times))
            at = at.copy()
            at[free] = new
            gamma[:, free], theta[:, free] = begin, begin_theta
            running[free] = True
        else:
            rows = int(sizes[at[running]].max()) if running.any() else 0
            weights, times = weights[:, :rows, running].copy(), times[:rows, running].copy()
            gamma, theta = gamma[:, running], theta[:, running]
            at, running = at[running], running[running]
    return all_gamma, all_theta


def statistics(
    batches: Iterator[pa.RecordBatch], betas: np.ndarray, alpha: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over all documents of batches with columns `row`, `ids` and `counts`: how much of each
    term goes to each topic, before the terms' weights are applied, the expected logarithms of the
    topics' shares, and the documents with terms.

    Documents that follow each other with the same `row` are one that was drawn several times."""
    topics, size = betas.shape
    sums, logs, documents = np.zeros((topics, size)), np.zeros(topics), 0
    for batch in batches:
        row = batch.column("row").to_numpy(zero_copy_only=False)
        new = np.append(True, row[1:] != row[:-1])[: len(row)]
        places = np.flatnonzero(new)
        times = np.diff(np.append(places, len(row)))
        batch = batch.take(pa.array(places))
        lists, values = batch.column("ids"), batch.column("counts")
        ends = np.cumsum(np.asarray(lists.value_lengths()).astype(np.int64))
        ids, counts = lists.flatten().to_numpy(), values.flatten().to_numpy()
        done = 0
        while done < len(ends):
            low = ends[done - 1] if done else 0
            upto = max(done + 1, int(np.searchsorted(ends, low + STEP_TERMS, "right")))
            sizes = np.diff(np.append(low, ends[done:upto]))
            held = sizes > 0
            sizes, drawn = sizes[held], times[done:upto][held].astype(float)
            part = slice(low, ends[upto - 1])
            if len(sizes):
                gamma, theta = infer(ids[part], counts[part], sizes, betas, alpha, start)
                ratio = np.full(len(ids[part]), 1e-100)
                for k in range(topics):
                    ratio += np.repeat(theta[k], sizes) * betas[k][ids[part]]
                ratio = np.repeat(drawn, sizes) * counts[part] / ratio
                for k in range(topics):
                    sums[k] += np.bincount(
                        ids[part], weights=np.repeat(theta[k], sizes) * ratio, minlength=size
                    )
                logs += (expectation(gamma) * drawn).sum(axis=1)
                documents += int(drawn.sum())
            done = upto
    return sums, logs, documents

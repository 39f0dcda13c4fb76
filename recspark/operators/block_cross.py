"""All pairs of packed blocks of rows, without a shuffle of the rows.

A block is one record: its rows' ids and numbers as arrays or bytes.  The
written table of blocks is crossed with itself (``shuffle_replicate_nl``): each
task reads two runs of blocks from the files, so no row is replicated into a
shuffle, however many blocks there are.  ``Best`` keeps the k best candidates of
each row of the blocks that a task has met; they leave the task at its end, or
when there are more than ``HELD`` of them (the bars stay, so few follow), so memory
does not grow with the run.  What is shuffled is some k records a row and run of blocks, and
the number of runs follows the cores, not the pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scores are compared after rounding to 9 decimals; bounds leave room for that.
SLACK = 1e-8
#: Candidates that a task holds, about.
HELD = 1 << 21


def crossed(blocks: DataFrame, condition) -> DataFrame:
    """Pairs of blocks, columns named ``l_...`` and ``r_...``; ``condition`` takes the two sides as functions of a name.

    The condition must hold no plain equality, which would make a shuffled join of this.
    """
    sides = [blocks.select(*[F.col(c).alias(f"{side}_{c}") for c in blocks.columns]) for side in "lr"]

    def of(side: str):
        def column(name: str) -> Column:
            return F.col(f"{side}_{name}")
        return column
    return sides[0].join(sides[1].hint("shuffle_replicate_nl"), condition(of("l"), of("r")))


def best_of_rows(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the ``k`` highest scores of each row, ties by the lower column; -inf takes no part."""
    if not scores.size:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = max(0, scores.shape[1] - k)
    bar = np.partition(scores, at, axis=1)[:, at]
    i, j = np.nonzero((scores >= bar[:, None]) & (scores > -np.inf))
    order = np.lexsort((j, -scores[i, j], i))
    i, j = i[order], j[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    return i[place < k], j[place < k]


class Best:
    """The ``k`` best candidates of each row of several blocks: rounded score descending, then the other id ascending."""

    def __init__(self, k: int):
        self.k = k
        self._blocks: dict = {}
        self._held = 0

    def bars(self, key, ids: np.ndarray, start) -> np.ndarray:
        """The score that a candidate of each row has to reach; ``start`` at first, infinite for a row that does not ask."""
        if key not in self._blocks:
            self._blocks[key] = [ids, np.array(start, dtype=np.float64), [], 0]
        return self._blocks[key][1]

    def offer(self, key, rows: np.ndarray, scores: np.ndarray, others: np.ndarray) -> None:
        """Scores of some rows (their places) of a block against ``others``, which ascend; -inf takes no part."""
        block = self._blocks[key]
        bar = block[1][rows]
        i, j = np.nonzero(scores >= (bar - SLACK)[:, None])
        if len(i) > 4 * self.k * len(scores):
            asks = np.flatnonzero(bar < np.inf)
            i, j = best_of_rows(np.round(scores[asks], 9), self.k)
            i = asks[i]
        self.add(key, rows[i], others[j], scores[i, j])

    def add(self, key, rows: np.ndarray, others: np.ndarray, scores: np.ndarray) -> None:
        """Single candidates: a row (its place), the other id and the score of each."""
        block = self._blocks[key]
        block[2].append((rows, others, scores))
        block[3] += len(rows)
        self._held += len(rows)
        if block[3] > max(1 << 16, 4 * self.k * len(block[0])):
            self._reduce(block)

    def _reduce(self, block) -> None:
        row, other, score = (np.concatenate(x) for x in zip(*block[2]))
        keep = score > -np.inf
        row, other, score = row[keep], other[keep], score[keep]
        order = np.lexsort((np.unique(other, return_inverse=True)[1], -np.round(score, 9), row))
        row, other, score = row[order], other[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        full = place == self.k - 1
        block[1][row[full]] = np.maximum(block[1][row[full]], score[full])
        keep = place < self.k
        self._held -= sum(len(x[0]) for x in block[2]) - int(keep.sum())
        block[2], block[3] = [(row[keep], other[keep], score[keep])], 0

    def overflow(self):
        """As ``rows``, where more than ``HELD`` candidates are held; the blocks keep their bars and go on."""
        if self._held <= HELD:
            return
        for block in self._blocks.values():
            if block[2]:
                self._reduce(block)
        if self._held <= HELD // 2:
            return
        for key, block in self._blocks.items():
            if block[2]:
                row, other, score = block[2][0]
                block[2] = []
                yield key, block[0][row], other, score
        self._held = 0

    def rows(self):
        """(key, ids, others, scores) of each block; the blocks are given up."""
        while self._blocks:
            key, block = self._blocks.popitem()
            if block[2]:
                self._reduce(block)
                row, other, score = block[2][0]
                yield key, block[0][row], other, score


def ids_at(column: pa.Array, i: int) -> np.ndarray:
    """The ids of block ``i``, as pandas gives them."""
    return column[i].values.to_pandas().to_numpy()


def numbers_at(column: pa.Array, i: int, dtype=np.float64) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), dtype=dtype)

"""Numpy work of one task on a block of queries and a block of passages.

Scores of a block come from matrix products of unit vectors, first in single precision. A product has a rounding error,
so it only narrows the search: every passage within twice that error of the best goes on. Queries left with many
passages are narrowed again in double precision, and what remains is scored from left to right, as the column expression
``functions.vectors.cosine`` does. The best passage is then exact, the same for any partitioning, and equal scores are
decided by the order of the passages alone.

The error: a product of n numbers, added in any order at precision u, is off by at most n u / (1 - n u) times the product
of the norms, and rounding both vectors to precision u adds 2 u. Twice that is below 4 (n + 8) u while n u is below a
half, which the slack below allows; longer vectors start in double precision.

Vectors of floats stay floats (they are widened where sums are formed), so they take half the memory of doubles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

TILE_CELLS = 2_000_000
#: Bytes of vectors that are turned into a matrix at once.
BATCH_BYTES = 8 * 1024 * 1024
# Norms in this range can be divided out without overflow or underflow; other rows are always scored directly.
_SAFE_NORMS = (1e-140, 1e140)
#: Longest vectors whose products are formed in single precision, and passages of a query that need no second narrowing.
SINGLE_WIDTH = 1 << 20
FEW_CANDIDATES = 16
#: Queries whose winners travel in one row.
CHUNK_QUERIES = 16_384


def small_batches(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a matrix as wide as their longest vector takes ``limit`` bytes, one row at least."""
    for batch in batches:
        lengths = np.diff(batch.column("embedding").offsets.to_numpy())
        rows = max(1, limit // (8 * max(1, int(lengths.max(initial=1)))))
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def matrix_of(column: pa.Array) -> np.ndarray:
    """A list column as rows of doubles (floats if it has floats), shorter vectors filled with zeros, a null vector as NaN."""
    lengths = np.diff(column.offsets.to_numpy())
    valid = np.asarray(column.is_valid())
    lengths = np.where(valid, lengths, 0)
    values = column.values.to_numpy(zero_copy_only=False)
    values = values.astype(np.float32 if values.dtype == np.float32 else np.float64, copy=False)
    starts = column.offsets.to_numpy()[:-1]
    width = int(lengths.max()) if len(lengths) else 0
    if len(lengths) and (lengths == width).all():
        first = int(starts[0])
        matrix = values[first : first + width * len(lengths)].reshape(len(lengths), width)
    else:
        matrix = np.zeros((len(lengths), width), dtype=values.dtype)
        filled = np.arange(width)[None, :] < lengths[:, None]
        matrix[filled] = values[(starts[:, None] + np.arange(width)[None, :])[filled]]
    if not valid.all():
        matrix = np.array(matrix) if width else np.zeros((len(lengths), 1), dtype=values.dtype)
        matrix[~valid] = np.nan
    return matrix


def numbers_of(table: pa.Table | pa.RecordBatch, names: list[str]) -> np.ndarray:
    """Integer columns as the rows of one array."""
    return np.stack([np.asarray(table.column(name).to_numpy(zero_copy_only=False), dtype=np.int64) for name in names])


def widened(matrix: np.ndarray, width: int) -> np.ndarray:
    if matrix.shape[1] == width:
        return matrix
    wide = np.zeros((len(matrix), width), dtype=matrix.dtype)
    wide[:, : matrix.shape[1]] = matrix
    return wide


class Block:
    """Vectors with what the search needs of them: columns, norms, unit vectors of single precision, and the order of the rows."""

    def __init__(self, matrix: np.ndarray, order: np.ndarray | None = None):
        self.matrix = matrix
        self.columns = np.ascontiguousarray(matrix.T)
        squares = np.zeros(len(matrix))
        with np.errstate(all="ignore"):
            for column in self.columns:
                wide = column.astype(np.float64, copy=False)
                squares += wide * wide
            self.norms = np.sqrt(squares)
            self.safe = (self.norms > _SAFE_NORMS[0]) & (self.norms < _SAFE_NORMS[1])
            self.single = np.empty(matrix.shape, dtype=np.float32)
            step = max(1, TILE_CELLS // max(1, matrix.shape[1]))
            for first in range(0, len(matrix), step):
                rows = slice(first, first + step)
                self.single[rows] = self.unit_rows(rows)
        # A zero vector has no score with anything.
        self.odd = ~self.safe & ~(self.norms == 0.0)
        # Rank of each row among its block, the last in input order highest.
        self.rank = np.arange(len(matrix)) if order is None else _ranks(order)

    def __len__(self) -> int:
        return len(self.matrix)

    def unit_rows(self, rows: slice | np.ndarray) -> np.ndarray:
        """Unit vectors of double precision; zeros for rows whose norm cannot be divided out."""
        safe = self.safe[rows]
        with np.errstate(all="ignore"):
            return np.where(safe[:, None], self.matrix[rows] / np.where(safe, self.norms[rows], 1.0)[:, None], 0.0)

    @property
    def unit(self) -> np.ndarray:
        return self.unit_rows(slice(None))

    def take(self, rows: np.ndarray) -> Block:
        part = object.__new__(Block)
        part.matrix = self.matrix[rows]
        part.columns = np.ascontiguousarray(part.matrix.T)
        part.norms, part.safe, part.single = self.norms[rows], self.safe[rows], self.single[rows]
        part.odd, part.rank = self.odd[rows], self.rank[rows]
        return part


class BestSoFar:
    """The best passage of each of n queries so far, with the numbers that decide between equal scores."""

    def __init__(self, n: int, orders: int):
        self.score = np.full(n, -np.inf)
        self.found = np.zeros(n, dtype=bool)
        self.winner = np.zeros((orders + 1, n), dtype=np.int64)

    def take(self, q: np.ndarray, columns: np.ndarray, value: np.ndarray) -> None:
        """``columns`` (id and order) and ``value`` of one passage for each of the queries ``q``, each at most once."""
        better = ~self.found[q] | (value > self.score[q])
        undecided = self.found[q] & (value == self.score[q])
        for row in range(1, len(columns)):
            better |= undecided & (columns[row] > self.winner[row][q])
            undecided &= columns[row] == self.winner[row][q]
        q = q[better]
        self.found[q], self.score[q] = True, value[better]
        self.winner[:, q] = columns[:, better]


def winner_row(chunk: int, part: int, q: np.ndarray, columns: np.ndarray, score: np.ndarray, names: list[str]) -> pa.RecordBatch:
    """Winners of queries of one chunk as arrays of one row; ``q`` counts from the chunk's first query."""
    lists = [q, *columns, score]
    arrays = [pa.ListArray.from_arrays(pa.array([0, len(q)], pa.int32()), pa.array(numbers)) for numbers in lists]
    return pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([part]), *arrays], names=names)


def merged_winners(batches: Iterator[pa.RecordBatch], size: int, orders: int) -> Iterator[tuple[int, int, BestSoFar]]:
    """(chunk, part, winners) of the rows of each chunk and part, which come one after the other."""
    at, best = None, BestSoFar(0, orders)
    for batch in batches:
        chunks, parts = (batch.column(i).to_pylist() for i in (0, 1))
        for row, key in enumerate(zip(chunks, parts)):
            if key != at:
                if at is not None:
                    yield *at, best
                at, best = key, BestSoFar(size, orders)
            q, *columns, score = (batch.column(i)[row].values.to_numpy() for i in range(2, batch.num_columns))
            best.take(q, np.stack(columns), score)
    if at is not None:
        yield *at, best


def _ranks(order: np.ndarray) -> np.ndarray:
    """Ranks of rows sorted by the columns of ``order``, first column first."""
    ranks = np.empty(order.shape[1], dtype=np.int64)
    ranks[np.lexsort(order[::-1])] = np.arange(order.shape[1])
    return ranks


def exact_scores(queries: Block, passages: Block, q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Cosine of the given pairs, summed from left to right; NaN where there is none."""
    total = np.zeros(len(q))
    with np.errstate(all="ignore"):
        for x, y in zip(queries.columns, passages.columns):
            total += x[q].astype(np.float64, copy=False) * y[p]
        norms = queries.norms[q] * passages.norms[p]
        return np.where(norms == 0.0, np.nan, total / np.where(norms == 0.0, 1.0, norms))


def all_scores(queries: Block, passages: Block) -> np.ndarray:
    """Cosine of all pairs of two blocks, summed from left to right."""
    total = np.zeros((len(queries), len(passages)))
    with np.errstate(all="ignore"):
        for x, y in zip(queries.columns, passages.columns):
            total += x[:, None].astype(np.float64, copy=False) * y[None, :]
        norms = queries.norms[:, None] * passages.norms[None, :]
        return np.where(norms == 0.0, np.nan, total / np.where(norms == 0.0, 1.0, norms))


def best_of(queries: Block, passages: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each query the row of its best passage (-1 for none) and the exact score."""
    best = np.full(len(queries), -1, dtype=np.int64)
    score = np.full(len(queries), np.nan)
    if not len(passages) or not len(queries):
        return best, score
    passage_step = min(len(passages), TILE_CELLS)
    query_step = max(1, TILE_CELLS // passage_step)
    for p0 in range(0, len(passages), passage_step):
        tile_rows = np.arange(p0, min(p0 + passage_step, len(passages)))
        tile = passages if len(tile_rows) == len(passages) else passages.take(tile_rows)
        for q0 in range(0, len(queries), query_step):
            q1 = min(q0 + query_step, len(queries))
            part = queries if q1 - q0 == len(queries) else queries.take(np.arange(q0, q1))
            q, p, value = _candidates(part, tile)
            q, p = q + q0, p + p0
            keep = ~np.isnan(value)
            q, p, value = q[keep], p[keep], value[keep]
            old = np.unique(q)
            old = old[best[old] >= 0]
            q = np.concatenate([q, old])
            p = np.concatenate([p, best[old]])
            value = np.concatenate([value, score[old]])
            by_query = np.lexsort((passages.rank[p], value, q))
            last = by_query[np.flatnonzero(np.append(np.diff(q[by_query]) != 0, True))] if len(q) else by_query
            best[q[last]], score[q[last]] = p[last], value[last]
    return best, score


def _near(queries: Block, passages: Block, rows: np.ndarray | None = None) -> np.ndarray:
    """Which passages may be the best of a query, by a product in single precision, or in double for some ``rows``."""
    width = queries.matrix.shape[1]
    single = rows is None and width <= SINGLE_WIDTH
    rows = np.arange(len(queries)) if rows is None else rows
    one, two = (queries.single, passages.single) if single else (queries.unit_rows(rows), passages.unit)
    slack = (2.0 if single else 8.0) * (width + 8) * np.finfo(one.dtype).eps
    near = one @ two.T
    safe, odd = queries.safe[rows], queries.odd[rows]
    regular = bool(safe.all() and passages.safe.all())
    if not regular:
        near[:, ~passages.safe] = -np.inf
    near = near >= near.max(axis=1, keepdims=True) - near.dtype.type(slack)
    if not regular:
        near &= safe[:, None] & passages.safe[None, :]
        near |= odd[:, None] | passages.odd[None, :]
    return near


def _candidates(queries: Block, passages: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = None
    while True:
        near = _near(queries, passages)
        many = np.flatnonzero(near.sum(axis=1) > FEW_CANDIDATES)
        if len(many):
            near[many] = _near(queries, passages, many)
        q, p = np.nonzero(near)
        if rows is not None or len(q) <= 4 * len(queries) + 1024:
            break
        # Many passages share the best score. Of equal vectors only the last in order can win: drop the others.
        rows = _last_of_equal(passages)
        passages = passages.take(rows)
    value = exact_scores(queries, passages, q, p)
    return q, p if rows is None else rows[p], value


def _last_of_equal(block: Block) -> np.ndarray:
    by_rank = np.argsort(block.rank)[::-1]
    raw = np.ascontiguousarray(block.matrix[by_rank])
    if not raw.shape[1]:
        return by_rank[:1]
    keys = raw.view(np.dtype((np.void, raw.dtype.itemsize * raw.shape[1]))).ravel()
    _, first = np.unique(keys, return_index=True)
    return by_rank[np.sort(first)]

"""The numpy block that keeps the best k rows per query while vectors stream through a task."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

BLOCK_CELLS = 4_000_000
BLOCK_ROWS = 16_384
# Relative error allowed to the matrix product that only preselects rows.
TOLERANCE = 1e-12


def to_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """An Arrow list column as a float32 matrix, without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten()
    if column.null_count or flat.null_count:
        raise ValueError("null in an embedding")
    sizes = np.diff(column.offsets.to_numpy()) if pa.types.is_list(column.type) else None
    if sizes is None:
        sizes = np.array([len(v) for v in column])
    bad = np.flatnonzero(sizes != dim)
    if bad.size:
        raise ValueError(f"embedding dimension mismatch: expected {dim}, got {sizes[bad[0]]}")
    return flat.to_numpy(zero_copy_only=False).astype(np.float32, copy=False).reshape(-1, dim)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length in double precision; zero rows stay zero."""
    wide = matrix.astype(np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]
    return wide / np.where(norms == 0.0, 1.0, norms)


def drop_far_copies(matrix: np.ndarray, ids: np.ndarray, keep: int) -> np.ndarray:
    """Positions to score. Copies of one vector tie everywhere and ties go to the smaller id, so
    beyond the ``keep`` smallest ids no copy can enter a result."""
    n = len(ids)
    if n <= keep:
        return np.arange(n)
    bits = np.ascontiguousarray(matrix).view(np.uint32)
    odd = np.arange(bits.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    mix = (bits.astype(np.uint64) * odd).sum(axis=1)
    order = np.lexsort((ids, mix))
    if not (mix[order[keep:]] == mix[order[:-keep]]).any():
        return np.arange(n)
    ordered = bits[order]
    starts = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
    nth_copy = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
    return np.sort(order[nth_copy < keep])


def row_blocks(n_rows: int, width: int) -> range:
    """Starts of row blocks that keep a block of ``width`` columns within ``BLOCK_CELLS``."""
    return range(0, n_rows, max(1, BLOCK_CELLS // max(1, width)))


class BestRows:
    """Best k (score down, id up) per query, as flat arrays.

    A matrix product preselects; what survives is scored pair by pair in double precision, so a score
    depends on its two vectors only and ranking needs no rounding. For ``ip`` the score is the inner
    product itself.

    Candidates gather in ``pending`` and are merged once they are as many as the rows held, so that
    sorting stays proportional to the number of candidates for any number of queries.
    """

    def __init__(self, queries: np.ndarray, own: np.ndarray | None, k: int, metric: str):
        self.metric, self.k, self.own = metric, k, own
        self.raw = queries.astype(np.float64)
        self.queries = unit_rows(queries) if metric == "cosine" else self.raw
        self.squares = np.einsum("ij,ij->i", self.raw, self.raw)
        self.floor = np.full(len(queries), -np.inf)
        self.floor_id = np.full(len(queries), np.iinfo(np.int64).max)
        self.row = np.empty(0, np.int64)
        self.score = np.empty(0)
        self.id = np.empty(0, np.int64)
        self.pending: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray | None = None) -> None:
        """Score ``vectors`` against the queries in ``rows`` (default: all)."""
        if rows is None:
            rows = np.arange(len(self.queries))
        if not len(ids) or not len(rows):
            return
        spare = self.k + (self.own is not None)
        chosen = drop_far_copies(vectors, ids, spare)
        for lo in range(0, len(chosen), BLOCK_ROWS):
            part = chosen[lo : lo + BLOCK_ROWS]
            some, some_ids = vectors[part], ids[part]
            wide = some.astype(np.float64)
            starts = row_blocks(len(rows), len(part))
            for start in starts:
                self._add_block(wide, some_ids, rows[start : start + starts.step], spare)
                if self.waiting > max(len(self.row), BLOCK_CELLS):
                    self._merge()
            if self.waiting >= len(self.row):
                self._merge()

    def _add_block(self, wide: np.ndarray, ids: np.ndarray, rows: np.ndarray, spare: int) -> None:
        squares = np.einsum("ij,ij->i", wide, wide)
        grid = self.queries[rows] @ (unit_rows(wide) if self.metric == "cosine" else wide).T
        slack = TOLERANCE
        if self.metric == "ip":
            slack *= math.sqrt(squares.max() * self.squares[rows].max())
        elif self.metric == "l2":
            grid *= 2.0
            grid -= squares
            grid -= self.squares[rows][:, None]
            slack *= squares.max() + self.squares[rows].max()
        floor = self.floor[rows]
        if len(ids) > spare and np.isneginf(floor).any():
            at = len(ids) - spare
            floor = np.maximum(floor, np.partition(grid, at, axis=1)[:, at] - slack)
        hit = np.flatnonzero(grid >= (floor - slack)[:, None])
        query, at = np.divmod(hit, len(ids))
        row, found = rows[query], ids[at]
        if self.metric == "l2":
            gap = self.raw[row] - wide[at]
            score = -np.einsum("ij,ij->i", gap, gap)
        else:
            score = np.einsum("ij,ij->i", self.raw[row], wide[at])
            if self.metric == "cosine":
                length = np.sqrt(self.squares[row]) * np.sqrt(squares[at])
                score = np.divide(score, length, out=np.zeros_like(score), where=length != 0.0)
        score = score + 0.0
        # Many rows may tie with the k-th best; only a smaller id still gets in.
        floor, floor_id = self.floor[row], self.floor_id[row]
        enters = (score > floor) | ((score == floor) & (found < floor_id))
        if self.own is not None:
            enters &= found != self.own[row]
        self.pending.append((row[enters], score[enters], found[enters]))
        self.waiting += int(enters.sum())

    def _merge(self) -> None:
        row, score, ids = (
            np.concatenate(parts)
            for parts in zip((self.row, self.score, self.id), *self.pending)
        )
        self.pending, self.waiting = [], 0
        if not len(row):
            return
        order = np.lexsort((ids, -score, row))
        row, score, ids = row[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        best = place < self.k
        self.row, self.score, self.id = row[best], score[best], ids[best]
        last = place[best] == self.k - 1
        self.floor[self.row[last]] = self.score[last]
        self.floor_id[self.row[last]] = self.id[last]

    def to_arrow(self, query_ids: pa.Array, schema: pa.Schema) -> pa.RecordBatch:
        self._merge()
        columns = [query_ids.take(pa.array(self.row)), pa.array(self.id), pa.array(self.score)]
        return pa.RecordBatch.from_arrays(
            [c.cast(f.type) for c, f in zip(columns, schema)], schema=schema
        )

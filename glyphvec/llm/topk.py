"""Exact top-k inner products by block-at-a-time pruning.

The index cuts the vectors into ranges (blocks) and stores, per block, a forward index (the vectors) and
the largest and smallest value of every component. A component is a term, and a query's weight times
the better of the two is the most that term can add in the block; their sum bounds every score of the
block. A query takes blocks in the order of that bound, until it lies below its k-th score.

Neighbouring rows are first ordered within a range by repeated halving along the widest component, which
makes blocks narrow and bounds low.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glyphvec.llm.common import table
from glyphvec.session import materialise

SCALE = 1024
BLOCK = 256
#: Components that a task holds at a time, when it builds and when it searches.
RANGE_VALUES = 4_000_000
#: Bytes of queries that are broadcast at a time.
QUERY_BYTES = 16 << 20
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)
LEAST = np.iinfo(np.int64).min


def clean(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, embedding as doubles) of the rows that take part.

    Rows with a null id, and vectors that are null, empty or hold null or non-finite components, do not.
    """
    value = F.col(f"`{embedding}`").cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    takes_part = F.col(f"`{vec_id}`").isNotNull() & (F.size(value) > 0) & finite
    return vectors.filter(takes_part).select(
        F.col(f"`{vec_id}`").cast("bigint").alias("vec_id"), value.alias("embedding")
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and scaled whole-number components of the rows of each length."""
    ids = batch.column("vec_id").to_numpy()
    lists = batch.column("embedding")
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    sizes = np.diff(offsets)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield ids[rows], np.floor(SCALE * values[offsets[rows][:, None] + np.arange(dim)])


def _halved(matrix: np.ndarray, rows: np.ndarray) -> Iterator[np.ndarray]:
    """Blocks of rows that lie close together."""
    stack = [rows]
    while stack:
        part = stack.pop()
        if len(part) <= BLOCK:
            yield np.sort(part)
            continue
        values = matrix[part]
        widest = int((values.max(axis=0) - values.min(axis=0)).argmax())
        half = (len(part) // 2 + BLOCK - 1) // BLOCK * BLOCK
        order = np.argpartition(values[:, widest], half - 1) if half < len(part) else np.arange(len(part))
        half = min(half, len(part) - 1)
        stack += [part[order[half:]], part[order[:half]]]


def build_index(vectors: DataFrame) -> DataFrame:
    """(dim, ids, highest, lowest, forward): one row for each block of at most 256 vectors.

    No shuffle: ranges are what a task reads. ``forward`` holds the block's whole-number components,
    row by row.
    """

    def blocks(ids: np.ndarray, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = list(_halved(matrix, np.arange(len(ids))))
        rows = {
            "dim": pa.array([matrix.shape[1]] * len(parts), pa.int32()),
            "ids": pa.array([ids[p] for p in parts], pa.list_(pa.int64())),
            "highest": pa.array([matrix[p].max(axis=0) for p in parts], pa.list_(pa.float64())),
            "lowest": pa.array([matrix[p].min(axis=0) for p in parts], pa.list_(pa.float64())),
            "forward": pa.array([matrix[p].astype("<f8").tobytes() for p in parts], pa.binary()),
        }
        for k in range(0, len(parts), 64):
            yield pa.RecordBatch.from_pydict({name: column[k : k + 64] for name, column in rows.items()})

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        for batch in batches:
            for ids, matrix in _matrices(batch):
                own = waiting.setdefault(matrix.shape[1], [])
                own.append((ids, matrix))
                if sum(m.size for _, m in own) >= RANGE_VALUES:
                    yield from blocks(np.concatenate([i for i, _ in own]), np.concatenate([m for _, m in own]))
                    own.clear()
        for own in waiting.values():
            if own:
                yield from blocks(np.concatenate([i for i, _ in own]), np.concatenate([m for _, m in own]))

    schema = "dim int, ids array<bigint>, highest array<double>, lowest array<double>, forward binary"
    return vectors.mapInArrow(build, schema)


class Searcher:
    """The best rows seen so far for a batch of queries of one length."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.ids, self.queries, self.k = ids, queries, k
        self.positive, self.negative = np.maximum(queries, 0), np.minimum(queries, 0)
        self.scores = np.full((len(ids), k), LEAST)
        self.found = np.full((len(ids), k), -1)

    def _product(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whole-number products; beyond doubles in exact arithmetic, held to 64 bits."""
        if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < EXACT:
            return (a @ b.T).astype(np.int64)
        exact = np.array([[int(x) for x in row] for row in a], object) @ np.array(
            [[int(x) for x in row] for row in b], object
        ).T
        return np.clip(exact, LEAST + 1, -(LEAST + 1)).astype(np.int64)

    def add(self, highest: np.ndarray, lowest: np.ndarray, blocks: list[tuple[np.ndarray, np.ndarray]]) -> int:
        """Takes in the blocks; returns how many (query, block) pairs were scored."""
        bound = self.positive @ highest.T + self.negative @ lowest.T
        slack = np.abs(bound) * 1e-9 + 1
        bound = bound + slack if np.abs(bound).max(initial=0) >= EXACT else bound
        order = np.argsort(-bound, axis=1, kind="stable")
        active, scored = np.arange(len(self.ids)), 0
        for r in range(len(blocks)):
            at = order[active, r]
            alive = bound[active, at] >= self.scores[active, -1]
            active, at = active[alive], at[alive]
            if not len(active):
                break
            scored += len(active)
            by_block = np.argsort(at, kind="stable")
            for own in np.split(by_block, np.flatnonzero(np.diff(at[by_block])) + 1):
                self._score(active[own], *blocks[at[own[0]]])
        return scored

    def _score(self, rows: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
        scores = self._product(self.queries[rows], matrix)
        wanted = (scores >= self.scores[rows, -1][:, None]) & (ids[None, :] != self.ids[rows][:, None])
        q, column = np.nonzero(wanted)
        if not len(q):
            return
        changed = np.unique(q)
        k = self.k
        owner = np.concatenate([np.repeat(changed, k), q])
        score = np.concatenate([self.scores[rows[changed]].ravel(), scores[q, column]])
        name = np.concatenate([self.found[rows[changed]].ravel(), ids[column]])
        order = np.lexsort((name, -(score + 1), owner))
        owner, score, name = owner[order], score[order], name[order]
        first = np.searchsorted(owner, changed)
        take = first[:, None] + np.arange(k)
        self.scores[rows[changed]], self.found[rows[changed]] = score[take], name[take]

    def results(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.scores > LEAST)
        return pa.RecordBatch.from_pydict(
            {
                "query_id": pa.array(self.ids[row]),
                "vec_id": pa.array(self.found[row, place]),
                "score": pa.array(self.scores[row, place]),
            }
        )


def _search(index: DataFrame, queries: pa.Table, k: int) -> DataFrame:
    """Each task's best k rows for each of the queries, which are broadcast."""
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searchers = {
            matrix.shape[1]: Searcher(ids, matrix, k)
            for batch in shared.value.combine_chunks().to_batches()
            for ids, matrix in _matrices(batch)
        }
        waiting: dict[int, list[dict]] = {dim: [] for dim in searchers}
        for batch in batches:
            for row in batch.to_pylist():
                own = waiting.get(row["dim"])
                if own is None:
                    continue
                own.append(row)
                if len(own) * BLOCK * row["dim"] >= RANGE_VALUES:
                    _take_in(searchers[row["dim"]], own)
                    own.clear()
        for dim, own in waiting.items():
            if own:
                _take_in(searchers[dim], own)
        for searcher in searchers.values():
            yield searcher.results()

    return index.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def _take_in(searcher: Searcher, rows: list[dict]) -> None:
    blocks = [
        (np.array(r["ids"], np.int64), np.frombuffer(r["forward"], "<f8").reshape(len(r["ids"]), r["dim"]))
        for r in rows
    ]
    searcher.add(np.array([r["highest"] for r in rows]), np.array([r["lowest"] for r in rows]), blocks)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``vectors`` for each row of ``queries``.

    Both as ``clean`` returns them. Rows with the query's own id are no candidates, rows of another
    length neither. Of queries that share an id the smallest vector counts; repeated candidate rows
    count once each. Ties go to the smaller id. The index is written once; a batch of queries is read
    from its table, bounded in bytes, and runs past it. Scores beyond 64 bits are held to 64 bits.
    """
    index = materialise(build_index(vectors), "blocks")
    asked = materialise(queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    size = asked.agg(F.sum(16 + 8 * F.size("embedding"))).first()[0] or 0
    batches = 1 + int(size) // QUERY_BYTES
    if batches == 1:
        return _ranked(_search(index, asked.toArrow(), k), k)
    best = None
    for b in range(batches):
        # All candidates of a query are in its batch: it is ranked and written before the next one starts.
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(batches)) == b)
        done = materialise(_ranked(_search(index, own.toArrow(), k), k), "best")
        best = done if best is None else best.unionByName(done)
    return best


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", order).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best rows for every hundredth vector."""
    vectors = clean(table(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

QUERIES = {"op10_exact_top_k": op10_exact_top_k}
SQL = {"op10_exact_top_k": OP10_SQL}

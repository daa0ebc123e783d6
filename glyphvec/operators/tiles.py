"""Exact k-nearest-neighbour join of two large tables, tile by tile.

The corpus is dealt to cells around pivots, which are some of its own rows; a cell's radius is the largest
distance of its rows to the pivot. For a query, pivot and radius bound every score of a cell from above
(by the triangle inequality for distances, by Cauchy-Schwarz for products). The k-th best score among a
sample of the corpus is a score that k rows reach for certain, so cells whose bound falls below it cannot
hold one of the k best: the query is not sent there.

Queries near one pivot form blocks. A tile is a block of queries and a part of a cell, both bounded in
bytes, and a cogroup brings the two together: no query passes the driver, and neither side is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glyphvec.operators.topk import BestRows, row_blocks, to_matrix, unit_rows
from glyphvec.session import materialise

#: Corpus rows that give the certain score, and cells; both are broadcast.
SAMPLE_ROWS, SAMPLE_BYTES = 2048, 16 * 1024 * 1024
MAX_CELLS = 1024
#: Cells per block of the corpus: more cells are narrower, fewer make fewer tiles.
CELLS_PER_BLOCK = 4
#: Far above what rounding can add to a score and, by a difference of squares, to a distance.
SLACK, GAP_SLACK = 1e-9, 1e-7


@dataclass
class Cells:
    """Pivots with radii and rows of their cells, and the sample that gives certain scores."""

    pivots: np.ndarray
    sample: np.ndarray
    sample_ids: np.ndarray
    metric: str
    radius: np.ndarray | None = None
    #: Parts of each cell, numbered through all cells.
    counts: np.ndarray | None = None

    @property
    def first_part(self) -> np.ndarray:
        return np.cumsum(self.counts) - self.counts

    @property
    def longest(self) -> float:
        """Length of the longest sampled row, pivots among them."""
        return float(np.sqrt((self.points(self.sample) ** 2).sum(axis=1).max(initial=0.0)))

    def points(self, rows: np.ndarray) -> np.ndarray:
        """Rows in the space where bounds hold: of unit length for cosine scores."""
        return unit_rows(rows) if self.metric == "cosine" else rows.astype(np.float64)

    def gaps(self, points: np.ndarray) -> np.ndarray:
        """Distance of each row of ``points`` to each pivot."""
        squares = (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1)[None, :]
        return np.sqrt(np.maximum(squares - 2.0 * (points @ self.pivots.T), 0.0))

    def certain(self, rows: np.ndarray, own: np.ndarray | None, k: int) -> np.ndarray:
        """A score that at least k rows of the corpus reach, for each query."""
        points, sample = self.points(rows), self.points(self.sample)
        scores = points @ sample.T
        if self.metric == "l2":
            scores = 2.0 * scores - (points**2).sum(axis=1)[:, None] - (sample**2).sum(axis=1)[None, :]
        if own is not None:
            scores[own[:, None] == self.sample_ids[None, :]] = -np.inf
        if scores.shape[1] < k:
            return np.full(len(rows), -np.inf)
        return np.partition(scores, -k, axis=1)[:, -k]

    def reached(self, rows: np.ndarray, own: np.ndarray | None, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot of each query, and which cells may hold one of its k best."""
        points, certain = self.points(rows), self.certain(rows, own, k)
        gaps = self.gaps(points)
        lengths = np.sqrt((points**2).sum(axis=1))[:, None]
        if self.metric == "l2":
            most = -(np.maximum(gaps - self.radius[None, :], 0.0) ** 2)
            scale = (gaps + self.radius[None, :] + lengths + self.longest) ** 2
        else:
            most = points @ self.pivots.T + lengths * self.radius[None, :]
            scale = lengths * (self.radius[None, :] + self.longest)
        # Where fewer than k rows are sampled no score is certain, and every cell is reached.
        return gaps.argmin(axis=1), most + SLACK * scale >= certain[:, None]


def _place(rows: DataFrame, cells: Cells, dim: int) -> DataFrame:
    """(index_id, embedding, cell, gap, part): cell, distance to its pivot, part of the cell; no shuffle.

    Parts are by a hash of the ordinal; before they are counted there is one part.
    """
    shared = rows.sparkSession.sparkContext.broadcast(cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            vectors = to_matrix(batch.column("embedding"), dim)
            cell, gap = np.empty(len(vectors), np.int32), np.empty(len(vectors))
            starts = row_blocks(len(vectors), len(own.pivots))
            for lo in starts:
                some = slice(lo, lo + starts.step)
                gaps = own.gaps(own.points(vectors[some]))
                cell[some], gap[some] = gaps.argmin(axis=1), gaps.min(axis=1)
            part = cell
            if own.counts is not None:
                mixed = batch.column("index_id").to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                shift = (mixed >> np.uint64(33)).astype(np.int64) % np.maximum(own.counts[cell], 1)
                part = (own.first_part[cell] + shift).astype(np.int32)
            columns = [batch.column("index_id"), batch.column("embedding"), *map(pa.array, (cell, gap, part))]
            yield pa.RecordBatch.from_arrays(columns, names=["index_id", "embedding", "cell", "gap", "part"])

    schema = "index_id BIGINT, embedding ARRAY<FLOAT>, cell INT, gap DOUBLE, part INT"
    return rows.mapInArrow(run, schema)


def _route(asked: DataFrame, cells: Cells, dim: int, k: int) -> DataFrame:
    """``home`` (nearest pivot) and ``parts`` of cells that each query has to meet; no shuffle."""
    shared = asked.sparkSession.sparkContext.broadcast(cells)
    has_own = "own_id" in asked.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        side = shared.value
        owner = np.repeat(np.arange(len(side.counts)), side.counts)
        for batch in batches:
            vectors = to_matrix(batch.column("embedding"), dim)
            own = batch.column("own_id").to_numpy(zero_copy_only=False) if has_own else None
            homes, lists, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int32)], [np.empty(0, np.int64)]
            starts = row_blocks(len(vectors), len(side.sample) + len(side.pivots) + len(owner))
            for lo in starts:
                some = slice(lo, lo + starts.step)
                home, meets = side.reached(vectors[some], None if own is None else own[some], k)
                meets = meets[:, owner]
                homes.append(home.astype(np.int32))
                sizes.append(meets.sum(axis=1))
                lists.append(np.nonzero(meets)[1].astype(np.int32))
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
            parts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lists)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(homes)), parts], names=[*batch.schema.names, "home", "parts"]
            )

    kind = T.ArrayType(T.IntegerType())
    fields = [*asked.schema.fields, T.StructField("home", T.IntegerType()), T.StructField("parts", kind)]
    return asked.mapInArrow(run, T.StructType(fields))


def make_cells(rows: DataFrame, n_rows: int, dim: int, metric: str, part_rows: int) -> Cells:
    """Cells of the corpus. The driver gets a bounded sample and one row for each cell."""
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (dim * 8)))
    drawn = rows.orderBy(F.xxhash64("index_id"), "index_id").limit(most).toArrow()
    sample = to_matrix(drawn["embedding"], dim)
    wanted = max(1, min(MAX_CELLS, len(sample), -(-CELLS_PER_BLOCK * n_rows // part_rows)))
    cells = Cells(np.empty((0, dim)), sample, drawn["index_id"].to_numpy(), metric)
    cells.pivots = np.unique(cells.points(sample[:wanted]), axis=0)
    found = _place(rows, cells, dim).groupBy("cell").agg(F.max("gap").alias("radius"), F.count("*").alias("n"))
    radius, counts = np.zeros(len(cells.pivots)), np.zeros(len(cells.pivots), np.int64)
    for row in found.collect():
        radius[row["cell"]], counts[row["cell"]] = row["radius"], -(-row["n"] // part_rows)
    cells.radius = radius * (1 + GAP_SLACK) + GAP_SLACK * cells.longest
    cells.counts = counts
    return cells


def meet_in_tiles(queries: DataFrame, vectors: DataFrame, dim: int, k: int, metric: str, schema: T.StructType) -> DataFrame:
    """Candidates of ``queries(block, part, query_id, embedding[, own_id][, clusters])`` among the
    ``vectors(block, part, index_id, embedding[, cluster_id])`` of the same block and part, or only those of
    the query's clusters.

    Both sides of a tile go to one task, so callers bound them.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    result = to_arrow_schema(schema)
    has_own, has_clusters = "own_id" in queries.columns, "clusters" in queries.columns

    def search(asked: pa.Table, rows: pa.Table) -> pa.Table:
        if not asked.num_rows or not rows.num_rows:
            return result.empty_table()
        own = asked["own_id"].to_numpy() if has_own else None
        best = BestRows(to_matrix(asked["embedding"], dim), own, k, metric)
        matrix, ids = to_matrix(rows["embedding"], dim), rows["index_id"].to_numpy()
        if has_clusters:
            for some, askers in _meetings(asked["clusters"].combine_chunks(), rows["cluster_id"].to_numpy()):
                best.add(matrix[some], ids[some], askers)
        else:
            best.add(matrix, ids)
        return pa.Table.from_batches([best.to_arrow(asked["query_id"].combine_chunks(), result)])

    # Names of their own: both sides may stem from one table.
    renamed = [F.col("block").alias("of_block"), F.col("part").alias("of_part")]
    kept = ("index_id", "embedding", "cluster_id") if has_clusters else ("index_id", "embedding")
    sides = vectors.select(*renamed, *[F.col(c).alias(c) for c in kept])
    rows = sides.groupBy("of_block", "of_part")
    return queries.groupBy("block", "part").cogroup(rows).applyInArrow(search, schema)


def _meetings(lists: pa.ListArray, cluster: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the rows of each cluster, and of the queries that name it."""
    probed = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    order = probed.argsort(kind="stable")
    probed, owner = probed[order], owner[order]
    order = cluster.argsort(kind="stable")
    names, starts = np.unique(cluster[order], return_index=True)
    for name, some in zip(names, np.split(order, starts[1:])):
        first, last = np.searchsorted(probed, [name, name + 1])
        yield some, owner[first:last]


def tile_join(
    asked: DataFrame,
    rows: DataFrame,
    n_rows: int,
    dim: int,
    k: int,
    metric: str,
    block_rows: int,
    part_rows: int,
    schema: T.StructType,
) -> DataFrame:
    """Candidates for the k best rows of each of the ``asked(query_id, embedding[, own_id])`` among
    ``rows(index_id, embedding)``, both written tables.

    Blocks hold about ``block_rows`` queries and parts about ``part_rows`` rows. A query goes to the parts
    it has to meet, a part to the blocks that have to meet it: where nothing can be pruned that is every
    one of them, and the shuffle moves (blocks x rows + parts x queries), each of them about a block's
    size less than the pairs that are compared.
    """
    cells = make_cells(rows, n_rows, dim, metric, part_rows)
    routed = materialise(_route(asked, cells, dim, k), "routed")
    # One row for each cell.
    homes = routed.groupBy("home").agg(F.ceil(F.count("*") / block_rows).alias("n"))
    block = F.xxhash64("home", F.pmod(F.xxhash64("query_id"), F.col("n"))).alias("block")
    sent = routed.join(F.broadcast(homes), "home").select(*asked.columns, block, F.explode("parts").alias("part"))
    tiles = sent.select("block", "part").distinct()
    placed = _place(rows, cells, dim).select("index_id", "embedding", "part")
    return meet_in_tiles(sent, placed.join(tiles, "part"), dim, k, metric, schema)

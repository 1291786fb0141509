"""Exact top-k inner products, with bounds from segment statistics that go from coarse to fine."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import written

#: Queries held by a task at once, as components; more queries are searched in further passes.
QUERY_COMPONENTS = 4_000_000
#: Rows, and their components at most, from which the axes and the first k-th best scores come. They only set where the bounds start: results are exact whatever they are.
SAMPLE, SAMPLE_COMPONENTS = 4096, 1_000_000
#: Candidates compared at once; the k-th best score of each query rises between blocks.
BLOCK = 256
OUT = "query int, query_id long, vec_id long, score long"
_NONE = np.iinfo(np.int64).max


def quantised(vector: str, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a double; null for vectors that are null, empty or hold null or non-finite components."""
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def segments(dim: int) -> list[np.ndarray]:
    """First components of the segments of each level, coarse to fine. Axes stand by falling variance, so single components come first."""
    doubling = [0, *(1 << k for k in range(dim.bit_length()) if 1 << k < dim)]
    quarter, half = dim // 4, dim // 2
    levels = [[0], doubling, [*range(quarter), *range(quarter, dim, 4)], [*range(half), *range(half, dim, 2)]]
    return [np.array(x) for k, x in enumerate(levels) if k == 0 or x != levels[k - 1]]


def axes(sample: np.ndarray) -> np.ndarray:
    """Orthonormal axes of the sample by falling variance: inner products stay, and the first axes carry most of them."""
    double = sample.astype(np.float64)
    scale = max(1.0, float(np.abs(double).max(initial=0)))
    return np.linalg.eigh(double.T @ double / scale**2)[1][:, ::-1]


class _Summary:
    """Means and deviations of the segments of some turned vectors, for each level."""

    def __init__(self, vectors: np.ndarray):
        self.levels = []
        dim = vectors.shape[1]
        for cuts in segments(dim):
            width = np.diff(np.r_[cuts, dim]).astype(np.float64)
            mean = np.add.reduceat(vectors, cuts, axis=1) / width
            wide = width > 1  # a single component has no deviation
            square = np.add.reduceat(vectors * vectors, cuts, axis=1)[:, wide] / width[wide]
            deviation = np.sqrt(np.maximum(square - mean[:, wide] ** 2, 0))
            self.levels.append(np.hstack([mean * np.sqrt(width), deviation * np.sqrt(width[wide])]))
        self.norm2 = (vectors * vectors).sum(axis=1)


class Search:
    """The best k candidates of each query so far, fed by blocks of candidates.

    `seen` counts pairs of a query and a candidate, `multiplied` those whose exact product was taken.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, turn: np.ndarray, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.k, self.turn = ids, vectors, k, turn
        self.double = vectors.astype(np.float64)
        self.summary = _Summary(self.double @ turn)
        self.largest = int(np.abs(vectors).max(initial=0))
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.of = np.full((len(ids), k), _NONE)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor.astype(np.float64)
        self.seen = self.multiplied = 0

    def feed(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        highest = self.largest * int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
        double = vectors.astype(np.float64)
        # a squared distance is at least sum over segments of width * ((mean difference)^2 + (deviation difference)^2),
        # so an inner product is at most the product of the summaries; a candidate survives while that reaches the k-th best
        rows, columns = self._survivors(_Summary(double @ self.turn), len(ids), highest < 1 << 62)
        self.seen += len(self.ids) * len(ids)
        self.multiplied += len(rows)
        keep = self.ids[rows] != ids[columns]
        rows, columns = rows[keep], columns[keep]
        if not len(rows):
            return
        if highest >= 1 << 53:
            scores = np.einsum("ij,ij->i", self.vectors[rows], vectors[columns])
        elif len(rows) < 0.2 * len(self.ids) * len(ids):
            scores = np.einsum("ij,ij->i", self.double[rows], double[columns]).astype(np.int64)
        else:
            scores = (self.double @ double.T)[rows, columns].astype(np.int64)
        self._merge(rows, ids[columns], scores)

    def _survivors(self, summary: _Summary, n: int, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
        if not bounded:  # scores may wrap: no bound holds
            return tuple(x.ravel() for x in np.indices((len(self.ids), n)))
        least = self.floor[:, None] - 1e-9 * np.sqrt(np.outer(self.summary.norm2, summary.norm2)) - 1e-6
        rows, columns = np.nonzero(self.summary.levels[0] @ summary.levels[0].T >= least)
        for mine, theirs in zip(self.summary.levels[1:], summary.levels[1:], strict=True):
            if len(rows) > 0.05 * least.size:  # so many are left that one product of all is cheaper
                bound = (mine @ theirs.T)[rows, columns]
            else:
                bound = np.einsum("ij,ij->i", mine[rows], theirs[columns])
            keep = bound >= least[rows, columns]
            rows, columns = rows[keep], columns[keep]
        return rows, columns

    def _merge(self, rows: np.ndarray, of: np.ndarray, scores: np.ndarray) -> None:
        touched = np.unique(rows)
        old = np.repeat(touched, self.k)
        rows, of, scores = np.r_[old, rows], np.r_[self.of[touched].ravel(), of], np.r_[self.score[touched].ravel(), scores]
        order = np.lexsort((of, ~scores, rows))
        rows, of, scores = rows[order], of[order], scores[order]
        begin = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        place = np.arange(len(rows)) - np.repeat(begin, np.diff(np.r_[begin, len(rows)]))
        best = place < self.k
        self.score[rows[best], place[best]], self.of[rows[best], place[best]] = scores[best], of[best]
        full = touched[self.of[touched, -1] != _NONE]
        self.floor[full] = np.maximum(self.floor[full], self.score[full, -1])


def first_floor(ids: np.ndarray, vectors: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """A score that k rows of the sample reach for each query, less what rounding can add: the k-th best of all is no lower."""
    out = np.full(len(ids), -np.inf)
    if len(sample) <= k or int(np.abs(vectors).max(initial=0)) * int(np.abs(sample).max(initial=0)) * vectors.shape[1] >= 1 << 53:
        return out
    theirs = sample.astype(np.float64).T
    for a in range(0, len(ids), 256):
        scores = vectors[a : a + 256].astype(np.float64) @ theirs
        scores[ids[a : a + 256, None] == sample_ids[None, :]] = -np.inf
        out[a : a + 256] = np.partition(scores, -k, axis=1)[:, -k]
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.int64).reshape(-1, dim)


def _held(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of a bounded table, by id and then by vector."""
    found = rows.select("vec_id", "v").toArrow().combine_chunks()
    ids = np.asarray(found.column("vec_id").to_numpy(), np.int64)
    vectors = _matrix(found.column("v").combine_chunks(), dim) if len(ids) else np.zeros((0, dim), np.int64)
    order = np.lexsort((*vectors.T[::-1], ids))
    return ids[order], vectors[order]


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, query_components: int = QUERY_COMPONENTS) -> DataFrame:
    """Columns query_id, rank, vec_id, score: for each row whose vec_id is divisible by `every`, its k best other rows.

    `vectors` has vec_id and embedding; further columns, whatever their names, are not read. Vectors that are null or
    empty, or hold null or non-finite components, take no part, nor do rows without a vec_id; a query meets candidates
    of its own number of components only, and none of its own vec_id. Each row is a query: where a vec_id stands
    twice, both rows have their results. Ties go to the smaller vec_id; repeated rows are candidates of their own.
    An empty table gives an empty result. Scores beyond 64 bits wrap.

    The stated queries are searched in blocks of bounded size against one scan of all rows each, one block after
    the other. A task sends k rows for each query, which meet in one window by query.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", quantised("embedding").alias("v")).where("vec_id is not null and v is not null")
    queries = rows.where(F.col("vec_id") % every == 0).select("vec_id", F.size("v").alias("dim"), "v")
    found = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    for dim, n in sorted((r["dim"], r["n"]) for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect()):
        mine = rows.where(F.size("v") == dim)
        sample_ids, sample = _held(mine.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(max(1, min(SAMPLE, SAMPLE_COMPONENTS // dim))), dim)
        turn = axes(sample)
        blocks = -(-n * dim // query_components)
        for b in range(blocks):
            ids, held = _held(queries.where((F.col("dim") == dim) & (F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)) == b)), dim)
            if not len(ids):
                continue
            shared = spark.sparkContext.broadcast((ids, held, k, turn, first_floor(ids, held, sample_ids, sample, k)))
            best = mine.mapInArrow(_searcher(shared, dim), OUT)
            rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
            best = best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
            if blocks == 1:
                found = found.union(best)
            else:  # written, so that no two blocks of queries are held at once
                found = found.union(written(best, "topk"))
                shared.destroy()
    return found


def _searcher(shared, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = None
        for batch in batches:
            if search is None:
                search = Search(*shared.value)
            ids = np.asarray(batch.column("vec_id").to_numpy(zero_copy_only=False), np.int64)
            held = _matrix(batch.column("v"), dim)
            for a in range(0, len(ids), BLOCK):
                search.feed(ids[a : a + BLOCK], held[a : a + BLOCK])
        if search is not None:
            rows, place = np.nonzero(search.of != _NONE)
            columns = [pa.array(rows.astype(np.int32)), pa.array(search.ids[rows]), pa.array(search.of[rows, place]), pa.array(search.score[rows, place])]
            yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "vec_id", "score"])

    return run

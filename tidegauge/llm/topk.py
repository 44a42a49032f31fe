"""Exact top-k search by inner product, over vector-approximation files.

Components are made integers, floor(scale * x), so scores are exact. Approximation files
are written once: in each block of vectors every dimension is cut into equal cells over
the block's own range, a vector is the list of its cells, a byte each, and the exact
vectors stand beside them. Cells bound a query's score from above and below. A first scan
multiplies the cells, in single precision, and keeps the vectors whose upper bound reaches
the k-th exact score so far (or the k-th best lower bound); then exact vectors are read in
order of falling upper bound until the next upper bound is less than the k-th exact score,
which makes the k results certain.

Scale: every task meets its blocks of vectors with one block of queries and returns at
most k rows a query. Queries are a stated set; they go out in blocks of bounded size, one
pass over the files each, and a pass is written before the next begins.

Defined results: vectors that are null, empty, or hold a null or non-finite component
take no part, nor do rows without an id; a vector is compared with queries of its own
dimension only; a query leaves out every row with its own id; of query rows with equal
id the least vector asks; of candidate rows with equal id each is a candidate; ties go
to the smaller id; scores beyond the range of a long are cut to it; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.session import materialise, ship

SCALE = 1024
TOP = 10
CELLS = 64
#: Bytes of a block of queries, as broadcast.
QUERY_BYTES = 16 << 20
#: Vectors of an approximation file.
BLOCK = 4096
#: Bounds held at once.
BOUNDS = 1 << 21
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def usable(vector: Column) -> Column:
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def scaled(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64))


def inner_products(vectors: np.ndarray, query: np.ndarray) -> list[int]:
    """Exact, whatever the size of the components."""
    if np.abs(vectors).max(initial=0) * np.abs(query).max(initial=0) * max(1, len(query)) < EXACT:
        return (vectors @ query).astype(np.int64).tolist()
    exact = [int(x) for x in query.tolist()]
    return [max(-LONG - 1, min(LONG, sum(int(a) * b for a, b in zip(row, exact, strict=True)))) for row in vectors.tolist()]


class ApproximationFile:
    """One block of integer vectors: the cells that bound scores, and the exact vectors in as few bytes as hold them."""

    def __init__(self, ids: np.ndarray, low: np.ndarray, width: np.ndarray, cells: np.ndarray, exact: np.ndarray):
        self.ids, self.low, self.width, self.cells, self.exact = ids, low, width, cells, exact

    @classmethod
    def of(cls, ids: np.ndarray, vectors: np.ndarray) -> ApproximationFile:
        low = vectors.min(axis=0)
        width = np.maximum(1.0, np.ceil((vectors.max(axis=0) - low + 1) / CELLS))
        cells = np.minimum((vectors - low) // width, CELLS - 1).astype(np.uint8)
        most = np.abs(vectors).max(initial=0)
        return cls(ids, low, width, cells, vectors.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"))

    def row(self) -> list:
        return [self.cells.shape[1], self.exact.dtype.str, *(np.ascontiguousarray(x).tobytes() for x in (self.ids, self.low, self.width, self.cells, self.exact))]

    @classmethod
    def from_row(cls, d: int, kind: str, ids: bytes, low: bytes, width: bytes, cells: bytes, exact: bytes) -> ApproximationFile:
        return cls(np.frombuffer(ids, "<i8"), np.frombuffer(low, "<f8"), np.frombuffer(width, "<f8"), np.frombuffer(cells, np.uint8).reshape(-1, d), np.frombuffer(exact, kind).reshape(-1, d))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[query, vector]: the centre of each cell's scores, and [query]: how far they go to either side.

        The cells themselves are multiplied, in single precision; the second value allows for its rounding.
        """
        weights = queries * self.width
        base = queries @ (self.low + (self.width - 1) / 2)
        most = np.abs(weights).sum(axis=1) * CELLS + np.abs(base)
        kind, eps = (np.float32, 1.2e-7) if most.max(initial=0) < 1e30 else (np.float64, 2.3e-16)
        centre = weights.astype(kind) @ self.cells.T.astype(kind) + base.astype(kind)[:, None]
        return centre, np.abs(queries) @ ((self.width - 1) / 2) + eps * (queries.shape[1] + 8) * most + 1


class Best:
    """The k best (score, id) of one query so far."""

    def __init__(self, k: int):
        self.k, self.found = k, []

    def offer(self, scores: list[int], ids: list[int]) -> None:
        self.found = sorted([*self.found, *((-s, i) for s, i in zip(scores, ids, strict=True))])[: self.k]

    @property
    def least(self) -> float:
        return -self.found[-1][0] if len(self.found) == self.k else -np.inf


class Asked:
    """Queries of one dimension with the best found for each so far. exact_reads: exact vectors looked at, over all queries."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.best = [Best(k) for _ in ids]
        self.least = np.full(len(ids), -np.inf)
        self.exact_reads = 0

    def search(self, file: ApproximationFile) -> None:
        """Improve `best` by one block of vectors."""
        n = len(file.ids)
        step = max(1, BOUNDS // n)
        for first in range(0, len(self.ids), step):
            span = slice(first, first + step)
            centre, reach = file.bounds(self.queries[span])
            own = self.ids[span, None] == file.ids[None, :]
            if own.any():
                centre[own] = -np.inf
            least = self.least[span].copy()
            unsure = np.flatnonzero(np.isneginf(least)) if n >= 2 * self.k else []
            for j in unsure:  # the k-th best lower bound, where no k exact scores are known yet
                kth = np.partition(centre[j], n - self.k)[n - self.k]
                least[j] = kth - reach[j] if kth > -np.inf else -np.inf
            hit = (centre >= (least - reach)[:, None]) & (centre > -np.inf)
            for j in np.flatnonzero(hit.any(axis=1)).tolist():
                self._read(first + j, np.flatnonzero(hit[j]), centre[j], reach[j], file)

    def _read(self, q: int, candidates: np.ndarray, centre: np.ndarray, reach: float, file: ApproximationFile) -> None:
        """Exact vectors in order of falling bound, until the next can't be among the best."""
        best = self.best[q]
        candidates = candidates[np.argsort(-centre[candidates], kind="stable")]
        at, size = 0, 4 * self.k
        while at < len(candidates) and centre[candidates[at]] + reach >= best.least:
            some = candidates[at : at + size]
            best.offer(inner_products(file.exact[some].astype(np.float64), self.queries[q]), file.ids[some].tolist())
            self.exact_reads += len(some)
            at, size = at + size, 2 * size
        self.least[q] = best.least


FILE = "d int, kind string, ids binary, low binary, width binary, cells binary, exact binary"


def _build(scale: int):
    """Rows (id, vector) to approximation files, a row each."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            offsets = lists.offsets.to_numpy()
            lengths, starts = np.diff(offsets), offsets[:-1]
            values = lists.values.to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == d)
                for at in range(0, len(rows), BLOCK):
                    own = rows[at : at + BLOCK]
                    row = ApproximationFile.of(ids[own], scaled(values[starts[own][:, None] + np.arange(d)], scale)).row()
                    kinds = [pa.int32(), pa.string(), *[pa.binary()] * 5]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=["d", "kind", "ids", "low", "width", "cells", "exact"])

    return run


def _search(shared, k: int):
    def run(batches):
        by_dimension = {d: Asked(ids, rows, k) for d, (ids, rows) in shared.value.items()}
        for batch in batches:
            for i in range(batch.num_rows):
                asked = by_dimension.get(batch.column(0)[i].as_py())
                if asked is not None:
                    asked.search(ApproximationFile.from_row(*(c[i].as_py() for c in batch.columns)))
        out = [(q, i, -s) for asked in by_dimension.values() for q, own in zip(asked.ids.tolist(), asked.best, strict=True) for s, i in own.found]
        columns = list(zip(*out, strict=True)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = TOP, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """Per query: query_id, rank from 1, vec_id and score of its k best rows of `vectors`. Both tables have long ids and arrays of numbers."""
    spark = vectors.sparkSession
    ship(spark)

    def rows(table: DataFrame) -> DataFrame:
        return table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.col("id").isNotNull() & usable(F.col("vector")))

    asked = rows(queries).groupBy("id").agg(F.min("vector").alias("vector")).toLocalIterator()
    files = materialise(rows(vectors).mapInArrow(_build(scale), FILE), "approximation")
    passes = []
    while block := _next_block(asked, query_bytes):
        by_dimension: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for d in {len(r["vector"]) for r in block}:
            own = [r for r in block if len(r["vector"]) == d]
            by_dimension[d] = (np.array([r["id"] for r in own], np.int64), scaled(np.array([r["vector"] for r in own]), scale))
        found = files.mapInArrow(_search(spark.sparkContext.broadcast(by_dimension), k), "query_id long, vec_id long, score long")
        ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
        passes.append(materialise(ranked.select("query_id", "rank", "vec_id", "score"), "pass"))
    if not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return spark.read.schema(passes[0].schema).parquet(*(f for p in passes for f in p.inputFiles())) if len(passes) > 1 else passes[0]


def _next_block(rows, query_bytes: int) -> list:
    """As many queries as fit, at least one."""
    first = list(islice(rows, 1))
    return first + list(islice(rows, max(0, query_bytes // (8 * len(first[0]["vector"])) - 1))) if first else []

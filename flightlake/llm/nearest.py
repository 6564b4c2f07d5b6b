"""Nearest vectors of a query set: int8 product tiles with error bounds, survivors recomputed in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import materialise, work_folder

#: Candidates and queries of one tile, and survivors that are recomputed at a time.
CANDIDATES = 8192
QUERIES = 256
PAIRS = 1 << 16
#: Longest run of dimensions whose int8 products add up exactly in single precision (127 * 127 * 1024 < 2**24).
EXACT_DIMS = 1024
#: One candidate in so many is searched first, for a score that a query's best are known to reach.
FIRST_SHARE = 64
#: What rounding in double precision may add to a bound.
ROUNDING = 1e-9

CODED = "row long, id long, dims int, vector binary, code binary, scale double, rest double"


def coded(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Rows that take part, quantised: (row, id, dims, vector, code, scale, rest).

    The unit vector is scale * code, off by a vector of length rest. Vectors that are
    null, empty, zero or hold null or non-finite numbers are gone.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    number, stored = ("float", "<f4") if single else ("double", "<f8")
    rows = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast(f"array<{number}>").alias("vector"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_dims: dict[int, list[tuple[int, np.ndarray]]] = {}
            for i, value in enumerate(batch.column("vector")):
                if value.is_valid and len(value) and not value.values.null_count:
                    found = value.values.to_numpy(zero_copy_only=False)
                    if np.isfinite(found).all() and found.any():
                        by_dims.setdefault(len(found), []).append((i, found))
            for dims, held in by_dims.items():
                at = pa.array([i for i, _ in held])
                matrix = np.array([v for _, v in held])
                unit = moderate(matrix.astype(float))
                unit /= np.sqrt(squares(unit))[:, None]
                scale = np.abs(unit).max(1) / 127
                code = np.rint(unit / scale[:, None]).astype(np.int8)
                rest = np.linalg.norm(unit - scale[:, None] * code, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(at) for c in ("row", "id")),
                        pa.array(np.full(len(held), dims, np.int32)),
                        pa.array([v.astype(stored).tobytes() for v in matrix], pa.binary()),
                        pa.array([c.tobytes() for c in code], pa.binary()),
                        pa.array(scale),
                        pa.array(rest),
                    ],
                    names=["row", "id", "dims", "vector", "code", "scale", "rest"],
                )

    return materialise(rows.mapInArrow(run, CODED), "nearest-codes")


def moderate(matrix: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest number near 1: cosines keep their every bit."""
    return np.ldexp(matrix, -np.frexp(np.abs(matrix).max(1, keepdims=True))[1])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products added up in order of the dimensions: the same bits whatever the block."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def squares(matrix: np.ndarray) -> np.ndarray:
    return products(matrix, matrix)


class Block:
    """Coded rows of one length as matrices."""

    def __init__(self, rows: pa.Table, dims: int):
        def stacked(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(b"".join(rows[name].to_pylist()), kind).reshape(-1, dims)

        size = len(rows["vector"][0].as_py()) // dims
        self.row = rows["row"].to_numpy()
        self.no_id = np.array([i is None for i in rows["id"].to_pylist()])
        self.id = rows["id"].fill_null(0).to_numpy()
        self.exact = moderate(stacked("vector", f"<f{size}").astype(float))
        self.square = squares(self.exact)
        self.code = stacked("code", "i1").astype(np.float32)
        self.scale, self.rest = rows["scale"].to_numpy(), rows["rest"].to_numpy()
        self.floor = rows["floor"].fill_null(-np.inf).to_numpy() if "floor" in rows.column_names else None


class Candidates(Block):
    """A block of candidates whose equal vectors are one class, with the rows of each class by id."""

    def __init__(self, rows: pa.Table, dims: int):
        super().__init__(rows, dims)
        keys: dict[bytes, int] = {}
        kind = np.array([keys.setdefault(v, len(keys)) for v in rows["vector"].to_pylist()])
        self.members = np.lexsort((self.row, self.id, self.no_id, kind))
        self.size = np.bincount(kind)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.shown = self.members[self.first[:-1]]
        place = np.argsort(self.row)
        self.by_row, self.kind_by_row = self.row[place], kind[place]

    def kind_of(self, rows: np.ndarray) -> np.ndarray:
        """The class of each row, -1 for rows that aren't here."""
        at = np.minimum(np.searchsorted(self.by_row, rows), len(self.by_row) - 1)
        return np.where(self.by_row[at] == rows, self.kind_by_row[at], -1)


def kth_largest(values: np.ndarray, k: int) -> np.ndarray:
    """Per row the k-th largest value, -inf where there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


def tile_best(queries: Block, at: slice, rows: Candidates, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) indices of the k best rows of a block for the queries in ``at``.

    A tile of integer products is each cosine up to a known error. The k-th largest
    lower bound is a score that k classes reach; only classes whose upper bound
    reaches it, and the query's floor, are recomputed.
    """
    dims, shown = rows.code.shape[1], rows.shown
    whole = np.zeros((len(queries.code[at]), len(shown)))
    for d in range(0, dims, EXACT_DIMS):
        whole += queries.code[at, d : d + EXACT_DIMS] @ rows.code[shown, d : d + EXACT_DIMS].T
    whole *= queries.scale[at][:, None] * rows.scale[shown]
    slack = queries.rest[at][:, None] * (1 + rows.rest[shown]) + rows.rest[shown] + ROUNDING
    own = rows.kind_of(queries.row[at])
    lonely = np.flatnonzero((own >= 0) & (rows.size[own] == 1))
    whole[lonely, own[lonely]] = -np.inf
    least = np.maximum(kth_largest(whole - slack, k), queries.floor[at])
    q, c = np.nonzero((whole + slack >= least[:, None]) & (whole > -np.inf))
    score = np.zeros(len(q))
    for i in range(0, len(q), PAIRS):
        left, right = q[i : i + PAIRS] + at.start, shown[c[i : i + PAIRS]]
        score[i : i + PAIRS] = products(queries.exact[left], rows.exact[right]) / np.sqrt(
            queries.square[left] * rows.square[right]
        )
    # among the classes that are left, those below the k-th best score can't hold one of the k best rows
    order = np.lexsort((-score, q))
    rank = np.arange(len(q)) - np.searchsorted(q[order], q[order])
    reach = np.full(len(least), -np.inf)
    reach[q[order][rank == k - 1]] = score[order][rank == k - 1]
    good = score >= np.maximum(reach, queries.floor[at])[q]
    q, c, score = q[good], c[good], score[good]
    # a class gives its k + 1 smallest rows: one of them may be the query itself
    shares = np.minimum(rows.size[c], k + 1)
    step = np.arange(shares.sum()) - np.repeat(np.cumsum(shares) - shares, shares)
    member = rows.members[np.repeat(rows.first[c], shares) + step]
    q, score = np.repeat(q, shares), np.repeat(score, shares)
    other = rows.row[member] != queries.row[at][q]
    q, member, score = q[other], member[other], score[other]
    order = np.lexsort((rows.row[member], rows.id[member], rows.no_id[member], -score, q))
    q, member, score = q[order], member[order], score[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[kept] + at.start, member[kept], score[kept]


MATCH = "query_row long, query_id long, row long, vec_id long, score double"


def searched(candidates: DataFrame, folder: str, k: int) -> DataFrame:
    """The k best rows of every candidate block for every query: candidates stay where they are read.

    Each task holds a block of its candidates and reads the query blocks of
    ``folder`` one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = ds.dataset(folder, format="parquet")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            for dims in sorted(set(batch.column("dims").to_pylist())):
                alike = table.filter(ds.field("dims") == dims)
                for first in range(0, alike.num_rows, CANDIDATES):
                    rows = Candidates(alike.slice(first, CANDIDATES), dims)
                    asked = queries.to_batches(
                        filter=ds.field("dims") == dims, batch_size=16 * QUERIES, batch_readahead=1, fragment_readahead=1
                    )
                    for part in asked:
                        if part.num_rows:
                            yield from told(Block(pa.Table.from_batches([part]), dims), rows)

    def told(queries: Block, rows: Candidates) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(queries.row), QUERIES):
            q, member, score = tile_best(queries, slice(at, min(at + QUERIES, len(queries.row))), rows, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(queries.row[q]),
                    pa.array(queries.id[q]),
                    pa.array(rows.row[member]),
                    pa.array(rows.id[member], mask=rows.no_id[member]),
                    pa.array(score),
                ],
                names=["query_row", "query_id", "row", "vec_id", "score"],
            )

    return candidates.mapInArrow(run, MATCH)


def query_blocks(queries: DataFrame) -> str:
    folder = work_folder(queries.sparkSession, "nearest-queries")
    queries.write.parquet(folder)
    return folder


def nearest(
    vectors: DataFrame,
    asked: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows nearest to each query, by cosine, ties to the smaller id.

    Queries are the rows for which ``asked``, a condition on column ``id``, holds;
    candidates all other rows, among them rows that repeat the query's id. Only
    vectors of one length are compared. A candidate with a null id comes after
    those with one at the same score. A repeated query row is answered again. A
    query with fewer candidates has all of them; an empty table gives no rows.
    Scores known from a first share of the candidates only keep rows from being
    sent that k rows are sure to beat.
    """
    codes = coded(vectors, id_col, vector_col)
    queries = codes.where(asked)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = codes.where(F.pmod(F.xxhash64("row"), F.lit(FIRST_SHARE)) == 0)
    blocks = query_blocks(queries.withColumn("floor", F.lit(None).cast("double")))
    floors = ranked(searched(first, blocks, k)).where(F.col("rank") == k).select(F.col("query_row").alias("row"), F.col("score").alias("floor"))
    blocks = query_blocks(queries.join(materialise(floors, "nearest-floors"), "row", "left"))
    return ranked(searched(codes, blocks, k)).select("query_id", "rank", "vec_id", "score")

"""Near-duplicate vectors by randomised-rotation binary codes with stored correction factors."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import numbered
from flightlake.llm.components import components
from flightlake.llm.nearest import moderate, products, squares
from flightlake.session import materialise, work_folder

#: Most rows of a portion, and most bytes of its vectors as doubles.
BLOCK_ROWS = 8192
BLOCK_BYTES = 64 << 20
#: Rows of one side that are compared at a time, and open pairs that are recomputed at a time.
TILE_ROWS = 1024
PAIRS = 1 << 16
#: Bits per coordinate of a code, and dimensions whose products add up exactly in single precision.
BITS = 8
EXACT_DIMS = 1024
#: What rounding may add to an angle, in radians.
ROUNDING = 1e-7
#: Portion pairs with the same first portion that one task compares in a row, and most tasks.
PAIRS_PER_TASK = 16
MOST_TASKS = 20_000


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(unit: np.ndarray, turn: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, length, factor) of unit vectors: ``bits`` binary digits per rotated coordinate, signed.

    length: of the code as a vector; factor: the inner product of the rotated
    vector with the code's direction, that is the cosine of the angle between both.
    """
    rotated = unit @ turn
    top = 2 ** (bits - 1) - 1
    code = np.rint(rotated * (top / np.abs(rotated).max(1, keepdims=True))).astype(np.int8)
    length = np.linalg.norm(code.astype(float), axis=1)
    return code, length, (rotated * code).sum(1) / length


class Portion:
    """Codes of one label and length in a portion, as matrices."""

    def __init__(self, rows: pa.Table, dims: int):
        code = np.frombuffer(b"".join(rows["code"].to_pylist()), np.int8).reshape(-1, dims)
        self.code = code.astype(np.float32)
        self.number = rows["class"].to_numpy()
        self.members = rows["members"].to_numpy()
        self.length, self.factor = rows["length"].to_numpy(), rows["factor"].to_numpy()
        self.angle = np.arccos(np.clip(self.factor, -1, 1)) + ROUNDING


def code_cosines(left: Portion, at: slice, right: Portion) -> np.ndarray:
    """Cosines between the codes of ``left`` in ``at`` and all of ``right``, from integer products."""
    total = np.zeros((len(left.code[at]), len(right.code)))
    for d in range(0, left.code.shape[1], EXACT_DIMS):
        total += left.code[at, d : d + EXACT_DIMS] @ right.code[:, d : d + EXACT_DIMS].T
    return total / (left.length[at][:, None] * right.length)


def estimates(left: Portion, at: slice, right: Portion) -> np.ndarray:
    """Inner products of the vectors themselves, unbiased over the rotations: the codes' cosines by both factors."""
    return code_cosines(left, at, right) / (left.factor[at][:, None] * right.factor)


def decided(left: Portion, at: slice, right: Portion, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(surely linked, open) for each pair of a tile.

    A vector lies at the angle of its stored factor to its code. The angle between
    two vectors is therefore that between their codes, up to the sum of both: an
    interval around the estimate that holds in any case. Pairs whose interval lies
    on one side of the threshold are decided, the others are open.
    """
    between = code_cosines(left, at, right)
    a, b, limit = left.angle[at][:, None], right.angle, math.acos(threshold)
    both = a + b
    widest, nearest = limit + both, limit - both
    possible = (between >= np.cos(limit + a) * np.cos(b) - np.sin(limit + a) * np.sin(b)) | (widest >= math.pi)
    sure = (between >= np.cos(limit - a) * np.cos(b) + np.sin(limit - a) * np.sin(b)) & (nearest > 0)
    return sure, possible & ~sure


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least connected index of each of n nodes."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    return root


def classes_of(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): (id, key) per row, key null for what links with nothing; and each distinct vector once.

    Classes are numbered through in order of label and length, and dealt into
    portions of so many rows by that number.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    number, stored = ("float", "<f4") if single else ("double", "<f8")
    rows = vectors.select(
        F.col(id_col).alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast(f"array<{number}>").alias("vector"),
    )
    kind = rows.schema["id"].dataType.simpleString()

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, blobs, dims = [], [], []
            for label, value in zip(batch.column("label").to_pylist(), batch.column("vector"), strict=True):
                found = None
                if label is not None and value.is_valid and len(value) and not value.values.null_count:
                    found = value.values.to_numpy(zero_copy_only=False)
                    if not np.isfinite(found).all() or not found.any():
                        found = None
                blob = None if found is None else found.astype(stored).tobytes()
                keys.append(None if blob is None else hashlib.blake2b(label.encode() + b"\0" + blob, digest_size=16).digest())
                blobs.append(blob)
                dims.append(None if found is None else len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary()), pa.array(dims, pa.int32())],
                names=["id", "label", "key", "vector", "dims"],
            )

    keyed = materialise(
        rows.mapInArrow(key, f"id {kind}, label string, key binary, vector binary, dims int"), "vector-keys"
    )
    classes = (
        keyed.where("key IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("id").alias("least"),
            F.count(F.lit(1)).alias("members"),
            F.first("label").alias("label"),
            F.first("dims").alias("dims"),
            F.first("vector").alias("vector"),
        )
    )
    return keyed.select("id", "key"), numbered(classes, ["label", "dims", "key"], "class")


def matrix_of(blobs: list[bytes], dims: int) -> np.ndarray:
    """Stored vectors, of single or double precision, as doubles."""
    joined = b"".join(blobs)
    stored = "<f4" if len(joined) == 4 * dims * len(blobs) else "<f8"
    return np.frombuffer(joined, stored).reshape(-1, dims).astype(float)


def scaled(matrix: np.ndarray) -> np.ndarray:
    """Unit vectors, also of very large and very small numbers."""
    near_one = moderate(matrix)
    return near_one / np.linalg.norm(near_one, axis=1)[:, None]


def coded(classes: DataFrame, seed: int) -> str:
    """The folder of codes: a row per class, in a subfolder per portion.

    The vector is stored beside its code, for the tasks that have to recompute a
    pair of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.array(batch.column("dims").to_pylist())
            for dims in np.unique(sizes).tolist():
                turn = turns.setdefault(dims, rotation(dims, seed))
                rows = batch.take(pa.array(np.flatnonzero(sizes == dims)))
                for at in range(0, rows.num_rows, TILE_ROWS):
                    part = rows.slice(at, TILE_ROWS)
                    code, length, factor = encode(scaled(matrix_of(part.column("vector").to_pylist(), dims)), turn)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(c) for c in told]
                        + [pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(factor)],
                        names=[*told, "code", "length", "factor"],
                    )

    told = ["portion", "label", "dims", "class", "members", "vector"]
    codes = classes.select(*told).mapInArrow(
        run,
        "portion long, label string, dims int, class long, members long, vector binary, "
        "code binary, length double, factor double",
    )
    folder = work_folder(classes.sparkSession, "vector-codes")
    codes.write.partitionBy("portion").parquet(folder)
    return folder


def portion_pairs(classes: DataFrame) -> DataFrame:
    """(i, j), i <= j: the portions that have a label and length in common, a row per pair of portions.

    Classes being in order, only one label reaches from a portion into the next,
    so a pair of different portions has one in common.
    """
    ranges = classes.groupBy("label", "dims").agg(F.min("portion").alias("low"), F.max("portion").alias("high"))
    firsts = ranges.select("high", F.explode(F.sequence("low", "high")).alias("i"))
    return firsts.select("i", F.explode(F.sequence("i", "high")).alias("j")).distinct()


def linked(folder: str, pairs: DataFrame, threshold: float) -> DataFrame:
    """(class, links, root): per pair of portions, the linked vectors of each class and the least class it is connected with.

    A task reads the two portions' codes, and whole vectors only where the
    interval of a pair leaves it open.
    """

    def read(portion: int, columns: list[str]) -> pa.Table:
        return ds.dataset(f"{folder}/portion={portion}", format="parquet").to_table(columns=columns).sort_by("class")

    def groups(portion: int) -> dict[tuple[str, int], Portion]:
        rows = read(portion, ["label", "dims", "class", "members", "code", "length", "factor"])
        found = {}
        for told in rows.group_by(["label", "dims"]).aggregate([]).to_pylist():
            same = (ds.field("label") == told["label"]) & (ds.field("dims") == told["dims"])
            found[told["label"], told["dims"]] = Portion(rows.filter(same), told["dims"])
        return found

    def exact(portion: int, classes: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
        rows = read(portion, ["class", "vector"])
        place = np.searchsorted(rows["class"].to_numpy(), classes)
        vectors = moderate(matrix_of(rows["vector"].take(pa.array(place)).to_pylist(), dims))
        return vectors, squares(vectors)

    def links_of(left: Portion, right: Portion, i: int, j: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        open_pairs: list[tuple[np.ndarray, np.ndarray]] = []
        for top in range(0, len(left.code), TILE_ROWS):
            at = slice(top, min(top + TILE_ROWS, len(left.code)))
            sure, undecided = decided(left, at, right, threshold)
            if i == j:
                later = left.number[at][:, None] < right.number
                sure, undecided = sure & later, undecided & later
            a, b = np.nonzero(sure)
            yield a + top, b
            a, b = np.nonzero(undecided)
            open_pairs.append((a + top, b))
        a, b = (np.concatenate(x) for x in zip(*open_pairs, strict=True))
        if not len(a):
            return
        dims = left.code.shape[1]
        (rows_a, place_a), (rows_b, place_b) = (np.unique(x, return_inverse=True) for x in (a, b))
        (u, uu), (v, vv) = exact(i, left.number[rows_a], dims), exact(j, right.number[rows_b], dims)
        for at in range(0, len(a), PAIRS):
            p, q = place_a[at : at + PAIRS], place_b[at : at + PAIRS]
            near = products(u[p], v[q]) / np.sqrt(uu[p] * vv[q]) >= threshold
            yield a[at : at + PAIRS][near], b[at : at + PAIRS][near]

    def compare(left: Portion, right: Portion, i: int, j: int) -> pa.RecordBatch:
        number = np.unique(np.concatenate([left.number, right.number]))
        at_a, at_b = np.searchsorted(number, left.number), np.searchsorted(number, right.number)
        links, root = np.zeros(len(number), np.int64), np.arange(len(number))
        for a, b in links_of(left, right, i, j):
            np.add.at(links, at_a[a], right.members[b])
            np.add.at(links, at_b[b], left.members[a])
            root = spanning(len(number), root[at_a[a]], root[at_b[b]])[root]
        told = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays(
            [pa.array(number[told]), pa.array(links[told]), pa.array(number[root[told]])], names=["class", "links", "root"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, dict] = (-1, {})
        for batch in batches:
            for i, j in zip(batch.column("i").to_pylist(), batch.column("j").to_pylist(), strict=True):
                if held[0] != i:
                    held = i, groups(i)
                others = held[1] if i == j else groups(j)
                for key in held[1].keys() & others.keys():
                    yield compare(held[1][key], others[key], i, j)

    runs = F.expr(f"j div {PAIRS_PER_TASK}")
    tasks = max(1, min(MOST_TASKS, pairs.select("i", runs).distinct().count()))
    dealt = pairs.repartition(tasks, "i", runs).sortWithinPartitions("i", "j")
    return dealt.mapInArrow(run, "class long, links long, root long")


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    threshold: float = 0.93,
    seed: int = 1,
) -> DataFrame:
    """(id_col, n_links, component_id, kept): a row per vector.

    Vectors of one label link at a cosine of ``threshold`` or more. Equal vectors
    of a label are one class, counted but never paired. The classes of a label are
    compared by their codes, portion by portion: no vector is copied, and no pair is
    left out. Only pairs whose interval holds the threshold are recomputed, in
    double precision. A null label, and
    a vector that is null, empty, zero or holds null or non-finite numbers, links
    with nothing; vectors of different length don't link. Repeated rows are
    vectors of their own. component_id is the least id reachable, null ids aside;
    a null id is never kept. An empty table gives no rows.
    """
    rows, classes = classes_of(vectors, id_col, vector_col, label_col)
    widest = classes.agg(F.max("dims")).first()[0] or 1
    rows_each = max(64, min(BLOCK_ROWS, BLOCK_BYTES // (8 * widest)))
    classes = materialise(classes.withColumn("portion", F.expr(f"class div {rows_each}")), "vector-classes")
    pairs = materialise(portion_pairs(classes), "vector-pairs")
    found = materialise(linked(coded(classes, seed), pairs, threshold), "vector-links")
    roots = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    named = (
        classes.select("key", "class", "least", "members")
        .join(links, "class", "left")
        .join(roots, F.col("class") == F.col("node"), "left")
        .select(
            "key",
            "least",
            (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"),
            F.coalesce("root", "class").alias("root"),
        )
    )
    named = materialise(named, "vector-roots")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = materialise(named.join(least, "root").select("key", "n_links", "component_id"), "vector-names")
    own = F.col("id")
    return rows.join(by_key, "key", "left").select(
        own.alias(id_col),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("key").isNull(), own).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce(F.when(F.col("key").isNull(), own.isNotNull()).otherwise(own == F.col("component_id")), F.lit(False)).alias("kept"),
    )

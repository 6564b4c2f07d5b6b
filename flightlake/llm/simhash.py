"""SimHash near-duplicates: segment bit counts as a grid, a Manhattan lower bound, then exact bits."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.llm.common import fresh, without_rows
from flightlake.llm.components import components
from flightlake.session import materialise

SEED = 42
ODD_BITS = 0x5555555555555555
CHUNK = 1 << 15


def fingerprint(text: bytes, width: int) -> int:
    """The signed 64-bit fingerprint of a UTF-8 text; 0 for a text without words.

    A-Z are lower-cased, words split at ASCII white space. Each shingle's XXH64
    votes bit by bit; a bit is set if more than half of the shingles set it.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - width + 1)
    votes = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        upto = min(n, at + CHUNK)
        spans = zip(starts[at:upto].tolist(), ends[min(width, len(words)) - 1 :][at:upto].tolist(), strict=True)
        hashes = np.array([xxh64_intdigest(joined[i:j], SEED) for i, j in spans], "<u8")
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    bits = np.packbits(2 * votes > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """(id_col, fp): a signed 64-bit fingerprint per row, of the whole text; a null text has no words."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", width) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.int64())], names=["id", "fp"]
            )

    return rows.mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def counts(fp: Column) -> Column:
    """Bit counts of the 32 two-bit segments, packed in two bits each: the point in the grid."""
    odd, next_bit = F.lit(ODD_BITS), F.shiftrightunsigned(fp, 1)
    one, two = fp.bitwiseXOR(next_bit).bitwiseAND(odd), fp.bitwiseAND(next_bit).bitwiseAND(odd)
    return one.bitwiseOR(F.shiftleft(two, 1))


def manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed points; never above the bit distance of their fingerprints."""
    differ = a.bitwiseXOR(b)
    odd = F.lit(ODD_BITS)
    high = F.shiftrightunsigned(differ, 1).bitwiseAND(odd)
    by_two = high.bitwiseAND(F.bitwise_not(differ))
    return F.bit_count(differ.bitwiseAND(odd)) + 2 * F.bit_count(by_two)


def cell_masks(max_bits: int, agreeing: int) -> list[int]:
    """One mask per way to choose ``agreeing`` of max_bits + agreeing groups of neighbouring segments.

    A distance of max_bits touches at most that many groups, so points that
    close share the cell of at least one choice, and the join loses no link.
    """
    n = max_bits + agreeing
    edges = [2 * (32 * i // n) for i in range(n + 1)]
    groups = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(n)]
    masks = [sum(c) for c in combinations(groups, agreeing)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(points: DataFrame, max_bits: int = 4, agreeing: int = 3) -> DataFrame:
    """(a, b), a < b: every two of the distinct fingerprints ``fp`` at most max_bits apart, once.

    Each fingerprint goes to one grid cell per choice of coordinates. Pairs of a
    cell are compared by Manhattan distance, then by bits; a pair is kept by the
    first choice whose cell it shares, so none comes twice. Spark sizes the cells
    like the fingerprints, of which each has dozens, and would broadcast them; the
    join is told to shuffle.
    """
    if not 0 <= max_bits <= 32 - agreeing:
        raise ValueError("max_bits and agreeing must leave a segment for each group")
    masks = cell_masks(max_bits, agreeing)
    point = counts(F.col("fp"))
    cells = points.select(
        "fp",
        F.posexplode(F.array(*[point.bitwiseAND(F.lit(m)) for m in masks])).alias("choice", "cell"),
    )
    a, b = F.col("a.fp"), F.col("b.fp")
    differ = counts(a).bitwiseXOR(counts(b))
    first = F.lit(len(masks))
    for i, mask in reversed(list(enumerate(masks))):
        first = F.when(differ.bitwiseAND(F.lit(mask)) == 0, F.lit(i)).otherwise(first)
    return (
        cells.alias("a")
        .join(
            cells.alias("b").hint("merge"),
            (F.col("a.cell") == F.col("b.cell"))
            & (F.col("a.choice") == F.col("b.choice"))
            & (a < b)
            & (manhattan(counts(a), counts(b)) <= max_bits)
            & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)
            & (first == F.col("a.choice")),
        )
        .select(a.alias("a"), b.alias("b"))
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    max_bits: int = 4,
    agreeing: int = 3,
) -> DataFrame:
    """(id_col, fp, component_id): a row per document; component_id is the least id it is linked with.

    Documents of one fingerprint are one point, whatever their number, so only
    distinct fingerprints are joined. Texts without words (null or empty) share
    the fingerprint zero and link like any other. Repeated rows are documents of
    their own; null ids never name a component, and one of null ids alone has a
    null component_id. An empty table gives no rows.
    """
    found = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    points = materialise(found.groupBy("fp").agg(F.min(id_col).alias("least")), "points")
    roots = components(links(points, max_bits, agreeing))
    placed = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(placed.join(names, "root").select("fp", "component_id"), "components")
    return found.join(named, "fp").select(id_col, "fp", "component_id")


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row of each near-duplicate group, with all its columns: the one with the least id.

    Null ids come last, and of rows with one id the first of the scan stays;
    ``docs`` has to be a table, or anything else that gives the same rows in the
    same partitions.
    """
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, F.monotonically_increasing_id())
    order = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    found = near_duplicates(keyed.select(order.alias("key"), F.col(text_col).alias("text")), "key", "text", width, max_bits)
    repeated = found.where("key.row <> component_id.row").select(F.col("key.row").alias(row))
    return without_rows(keyed, repeated, row).drop(row)

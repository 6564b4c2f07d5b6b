"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flightlake.session import materialise

#: A word, and the characters between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
#: Rows of a key or two (about 60 bytes each) up to which a table is broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def bind(value: Column, body) -> Column:
    """``body(x)`` with x computed once per row.

    The optimizer copies an expression into every lambda that names it; as the
    only element of an array it is evaluated once and passed on as a variable.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def fresh(rows: DataFrame, name: str) -> str:
    """A column name that ``rows`` doesn't have yet."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds the 0-based global row number in ``order``, without one task seeing all rows.

    Rows are range-partitioned and sorted, numbered inside their partition, and
    shifted by the rows of the partitions before (one row each, so the broadcast
    is bounded by the partition count). Rows equal in ``order`` are numbered in
    any order; a running id lets even such a group span partitions. The rows are
    written before they are sorted, as finding the ranges reads them once more, and
    after, so a lost executor can't renumber them.
    """
    rows = materialise(rows, "unsorted")
    tie, part, at, before = (fresh(rows, c) for c in ("_tie", "_part", "_at", "_before"))
    placed = materialise(
        rows.withColumn(tie, F.monotonically_increasing_id())
        .repartitionByRange(*order, tie)
        .sortWithinPartitions(*order, tie)
        .drop(tie)
        .withColumn(part, F.spark_partition_id())
        .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))),
        "numbered",
    )
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part)
        .agg(F.count(F.lit(1)).alias(before))
        .withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    )
    return (
        placed.join(F.broadcast(starts), part)
        .withColumn(name, F.col(before) + F.col(at))
        .drop(part, at, before)
    )


def few_or_shuffled(rows: DataFrame) -> DataFrame:
    """A written table of short rows, marked for broadcast if its count shows it small, else for a shuffle.

    Unmarked, Spark would go by the bytes of the files, which may be a small part of those in memory.
    """
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows.hint("merge")


def without_rows(rows: DataFrame, removed: DataFrame, key: str) -> DataFrame:
    """``rows`` less those whose unique key is among ``removed``."""
    return rows.join(few_or_shuffled(materialise(removed, "removed")), key, "left_anti")

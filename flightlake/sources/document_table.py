"""The document table as levels of versions: a merge appends, a reader never moves a stored text.

A version is a folder with the rows of one merge, their ids in a file of their
own, and a Bloom filter of the ids. It is part of the table once the catalog has
its partition. Versions of a level are merged into one of the next when there are
enough of them, so a row is rewritten once per level.
"""

from __future__ import annotations

import re
import time
import uuid
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.operators.documents import latest_per_doc
from flightlake.schemas import RAG_DOCUMENTS

#: Versions of a level that are merged into one of the next.
FANOUT = 8
#: Ids (some tens of bytes each) up to which newer ids are broadcast to the readers of older rows.
BROADCAST_IDS = 500_000
#: Bits per id and hashes of a Bloom filter; it has 2**20 words of 64 bits (8 MB) at most.
BLOOM_BITS = 10
BLOOM_HASHES = 4
MOST_WORDS = 1 << 20
#: Folders that no version names are kept so long, for readers and writers that are still at work.
KEPT_SECONDS = 3600.0

KEYS = "level int, low bigint, version bigint, ids bigint, folder string"


class Version(NamedTuple):
    """The merges ``low`` to ``version`` as one folder; ``ids``: how many documents it holds."""

    level: int
    low: int
    version: int
    ids: int
    folder: str

    def spec(self) -> str:
        return f"level = {self.level}, low = {self.low}, version = {self.version}, ids = {self.ids}, folder = '{self.folder}'"

    def hidden_by(self, other: Version) -> bool:
        return other.level > self.level and other.low <= self.low and self.version <= other.version


def create_document_table(spark: SparkSession, table: str, path: str) -> None:
    """An empty document table below ``path``: one catalog partition per version."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAG_DOCUMENTS)
    keys = ", ".join(k.split()[0] for k in KEYS.split(", "))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {KEYS}) USING parquet "
        f"PARTITIONED BY ({keys}) LOCATION '{path}/empty' TBLPROPERTIES ('folder' = '{path}')"
    )


def published(spark: SparkSession, table: str) -> list[Version]:
    """All versions the catalog has, newest first."""
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        told = dict(part.split("=") for part in row["partition"].split("/"))
        numbers = (int(told[k]) for k in ("level", "low", "version", "ids"))
        found.append(Version(*numbers, told["folder"]))
    return sorted(found, key=lambda v: (-v.version, -v.level))


def live(versions: list[Version]) -> list[Version]:
    """Those that no merged version replaces."""
    return [v for v in versions if not any(v.hidden_by(o) for o in versions)]


def root_folder(spark: SparkSession, table: str) -> str:
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return properties["folder"]


def bit_places(key: str, words: Column) -> list[Column]:
    """A row's bits in a Bloom filter of so many words."""
    return [F.pmod(F.xxhash64(key, F.lit(i)), words * F.lit(64)) for i in range(BLOOM_HASHES)]


def bloom_filter(ids: DataFrame, count: int) -> DataFrame:
    """One row, ``words``: a Bloom filter of ``count`` ids.

    Bits are or-ed per word in the map tasks; one task lines up the words, of
    which there are ``MOST_WORDS`` at most.
    """
    words = 16
    while words * 64 < count * BLOOM_BITS and words < MOST_WORDS:
        words *= 2
    places = F.explode(F.array(*bit_places("doc_id", F.lit(words).cast("bigint")))).alias("place")
    bits = ids.select(places).select(
        F.shiftrightunsigned("place", 6).alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").cast("int").bitwiseAND(F.lit(63))).alias("bits"),
    )
    none = ids.sparkSession.range(words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    joined = bits.unionByName(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    lined = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return joined.agg(F.transform(lined, lambda w: w["bits"]).alias("words"))


def may_hold(words: Column, key: str) -> Column:
    """False only if the Bloom filter's ids surely lack the key."""
    size = F.size(words).cast("bigint")
    hits = [
        F.getbit(F.get(words, F.shiftrightunsigned(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        for p in bit_places(key, size)
    ]
    return reduce(Column.__and__, hits)


def _publish(
    spark: SparkSession, table: str, rows: DataFrame, level: int, low: int, version: int
) -> bool:
    """Write a version to a folder of its own, then add it by one catalog statement."""
    root, folder = root_folder(spark, table), uuid.uuid4().hex
    path = f"{root}/{folder}"
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RAG_DOCUMENTS]
    rows.select(*columns).write.parquet(f"{path}/rows")
    stored = spark.read.schema(RAG_DOCUMENTS).parquet(f"{path}/rows")
    stored.select("doc_id").orderBy("doc_id").write.parquet(f"{path}/ids")
    ids = spark.read.parquet(f"{path}/ids")
    count = ids.count()
    if not count:
        return False
    bloom_filter(ids, count).coalesce(1).write.parquet(f"{path}/bloom")
    own = Version(level, low, version, count, folder)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION ({own.spec()}) LOCATION '{path}/rows'")
    rivals = [v for v in published(spark, table) if v[:3] == own[:3] and v.folder != folder]
    if rivals:
        spark.sql(f"ALTER TABLE {table} DROP PARTITION ({own.spec()})")
        raise RuntimeError(f"another writer has added version {version}; merge again")
    return True


def upsert_table(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """Merge rows into a document table by adding them as its newest version.

    Neither the table's data is read nor any file of it rewritten, so the cost is
    that of the batch. A reader sees the table before the one catalog statement
    or after it; a merge that broke off before it has no effect, and one that is
    repeated gives the same documents. Of two writers at a time, those that meet
    take their version back and have to merge again.
    """
    newest = latest_per_doc(rows, ["content"])
    number = max((v.version for v in published(spark, table)), default=0) + 1
    _publish(spark, table, newest, 0, number, number)


def read_document_table(spark: SparkSession, table: str) -> DataFrame:
    """Each document from the newest version that has it."""
    return _current(spark, table, live(published(spark, table)))


def _current(spark: SparkSession, table: str, versions: list[Version]) -> DataFrame:
    """The newest row of each document among some versions, newest first.

    Only ids of the versions after the oldest are grouped and sent to the rows.
    Where they are too many to broadcast, the Bloom filters tell which rows have
    a newer version at most; these alone are shuffled, all others pass.
    """
    columns = RAG_DOCUMENTS.fieldNames()
    folders = [v.folder for v in versions]
    rows = spark.table(table).where(F.col("folder").isin(folders)).select("version", *columns)
    newer = versions[:-1]
    if not newer:
        return rows.select(*columns)
    root = root_folder(spark, table)
    ids = [
        spark.read.schema("doc_id string").parquet(f"{root}/{v.folder}/ids").withColumn("newest", F.lit(v.version))
        for v in newer
    ]
    newest = reduce(DataFrame.unionByName, ids).groupBy("doc_id").agg(F.max("newest").alias("newest"))
    replaced = (F.col("r.doc_id") == F.col("n.doc_id")) & (F.col("r.version") < F.col("n.newest"))
    if sum(v.ids for v in newer) <= BROADCAST_IDS:
        kept = rows.alias("r").join(F.broadcast(newest).alias("n"), replaced, "left_anti")
        return kept.select(*columns)
    maybe = reduce(
        Column.__or__,
        [
            (F.col("version") < F.lit(v.version))
            & may_hold(spark.read.schema("words array<bigint>").parquet(f"{root}/{v.folder}/bloom").scalar(), "doc_id")
            for v in newer
        ],
    )
    told = rows.withColumn("maybe", maybe)
    shuffled = newest.hint("shuffle_merge").alias("n")
    kept = told.where("maybe").drop("maybe").alias("r").join(shuffled, replaced, "left_anti")
    return told.where(~F.col("maybe")).select(*columns).unionByName(kept.select(*columns))


def compact_table(
    spark: SparkSession, table: str, least: int = FANOUT, kept_seconds: float = KEPT_SECONDS
) -> None:
    """Merge each level that has ``least`` versions (two at least) into one version of the next level.

    No other level is read. The merged version is published first and hides what
    it replaces, so readers agree at any point, and an interrupted compaction can
    be repeated. Folders that no version names any more, also those that a broken
    merge left, are deleted once they are older than ``kept_seconds``.
    """
    level = 0
    while versions := [v for v in live(published(spark, table)) if v.level >= level]:
        merged = [v for v in versions if v.level == level]
        if len(merged) >= max(2, least):
            rows = _current(spark, table, merged).hint("rebalance")
            _publish(spark, table, rows, level + 1, merged[-1].low, merged[0].version)
        level += 1
    known = published(spark, table)
    for version in known:
        if version not in live(known):
            spark.sql(f"ALTER TABLE {table} DROP PARTITION ({version.spec()})")
    drop_orphans(spark, table, kept_seconds)


def drop_orphans(spark: SparkSession, table: str, kept_seconds: float = KEPT_SECONDS) -> None:
    """Delete folders of versions that no partition names, older than ``kept_seconds``."""
    named = {v.folder for v in published(spark, table)}
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root_folder(spark, table))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return
    for status in files.listStatus(root):
        path = status.getPath()
        old = time.time() - status.getModificationTime() / 1000 >= kept_seconds
        if old and re.fullmatch("[0-9a-f]{32}", path.getName()) and path.getName() not in named:
            files.delete(path, True)

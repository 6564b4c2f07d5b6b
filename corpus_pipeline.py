"""From raw documents to packed training sequences, in stages that each leave a table behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm import line_crf, mixing, packing, secrets, simhash
from flightlake.llm.common import fresh, table
from flightlake.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the line classifier rejects; it learns from the labels of the folder."""
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return line_crf.kept(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group."""
    return simhash.deduplicated(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by its kind; ``n_chars`` follows."""
    return counted(secrets.redact(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents, or runs of their words, as often as the target weights take them."""
    row = fresh(docs, "_row")
    keyed = docs.withColumn(row, F.monotonically_increasing_id())
    return counted(mixing.mixed_texts(keyed, mixing.mix_sources(keyed, keep=(row,)), row, "text").drop(row))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places every token piece in a sequence of 1024."""
    import public_tokenizers

    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(digests, order=["doc_id", "start"])


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources", mix),
    ("packing", pack),
]
#: The classifier and the fingerprints have no form in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

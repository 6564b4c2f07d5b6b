"""The dealt operators applied to their whole tables, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm.common import table, whole_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


@query("op3_shard_shuffle")
def op3_shard_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: sixteen shards whose row counts differ by one at most."""
    from flightlake.llm.sharding import shard_rows

    rows = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shard_rows(rows, ["doc_id", "size", "text_crc32"]).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


@query("op10_pack_sequences")
def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from flightlake.llm.packing import pack, token_pieces

    pieces = token_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken")
    )
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(digests, order=["doc_id", "start"])


@query("op7_mix_sources")
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beside the words taken, how they fall to the sixteen shards by the shards' quotas."""
    from flightlake.llm.mixing import mix_sources, shard_words

    docs = table(spark, sf_dir, "documents").withColumn("row", F.monotonically_increasing_id())
    found = shard_words(mix_sources(docs, keep=("row",)), "row")
    return found.select("doc_id", "source", "size", "source_size", "target", "taken", "shard_words")


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, string_split(t, chr(10)) AS ls FROM d),
v AS (SELECT doc_id, i, w[i:i + 7] AS v FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, v) AS n FROM v) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM r, range(8) AS o(k) GROUP BY doc_id),
f AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
  list_filter(ls, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS told, len(ls) AS n_lines,
  len(regexp_extract_all(t, '\p{Lu}{2,}[^\x20\x09-\x0D]*!!')) AS shouted,
  len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS again FROM w),
m AS (SELECT *, len(told) - len(list_distinct(told)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat FROM f LEFT JOIN c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat AS n_repeat_words,
  n_words < 20 OR 100 * n_repeat > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat > 30 * n_words) AND word_chars / greatest(n_words, 1) BETWEEN 2 AND 15
  AND n_symbols <= 0.1 * greatest(n_words, 1) AND n_dup_lines <= 0.3 * n_lines
  AND shouted <= 0.2 * greatest(n_words, 1) AND again <= 0.2 * greatest(n_words, 1) AS kept
FROM m
"""


@query("op8_quality_rules", OP8_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The costs are estimated on those of a hundredth of the documents that the base passes; so are the rules run."""
    from flightlake.llm.rules import cascade, document_rules, estimate, measures

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = document_rules()
    passing = measures(docs.sample(0.01, 1)).where("NOT base_failed")
    verdict = cascade(measures(docs), rules, estimate(passing, rules, 1.0), F.col("base_failed"))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return verdict.select("doc_id", *columns, "kept")


def _kind_sql(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {number} AS k, '{kind}' AS kind, unnest(range(1, len(ms) + 1)) AS i, ms, gs, ps, {least} AS least
FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, regexp_extract_all(t, '{p}', {group}) AS gs,
  string_split_regex(t, '{p}') AS ps FROM d)"""


OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({kinds}),
s AS (SELECT doc_id, k, kind, length(ms[i]) AS n,
  list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS a
  FROM m WHERE length(gs[i]) >= least),
g AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  string_agg(kind || ':' || CAST(a AS BIGINT) || ':' || CAST(a + n AS BIGINT), ',' ORDER BY a, k) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN g USING (doc_id)
""".format(
    kinds=" UNION ALL ".join(
        [
            _kind_sql(
                0,
                "assign",
                r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                2,
                6,
            ),
            _kind_sql(1, "access", "AKIA[A-Z0-9]+", 0, 20),
            _kind_sql(2, "hex", "[0-9a-f]+", 0, 24),
        ]
    )
)


@query("op6_secret_scan", OP6_SQL)
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.secrets import digest, scan

    found = digest(*scan(table(spark, sf_dir, "documents")))
    return found.withColumn("base_sha256", F.sha2(F.col("spans").cast("binary"), 256))


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.simhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm import toxicity
    from flightlake.llm.training import held_out

    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op9_line_quality")
def op9_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm import line_crf
    from flightlake.llm.training import held_out

    docs = table(spark, sf_dir, "documents")
    model = line_crf.fit(docs, table(spark, sf_dir, "labels"))
    return line_crf.score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
OP1_SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS kept FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('{BASE32}', 1 + CAST(
    (CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31 AS INT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM q
"""


@query("op1_warc_records", OP1_SQL)
def op1_warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.warc import archive_folder, read_records, write_archives

    folder = archive_folder(spark)
    index = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_records(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )

OP5_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
degree AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN degree USING (vec_id)
"""


@query("op5_vector_duplicates", OP5_SQL)
def op5_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.vector_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY lang, source),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
  CAST(1 + (1000000000 * (CAST(coalesce(n, 0) AS HUGEINT) + 5)) // CAST(total + 5 * v AS HUGEINT) AS BIGINT) AS p
  FROM g JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, CAST(1 + (1000000000 * (CAST(sum(n) AS HUGEINT) + 5)) // CAST(sum(sum(n)) OVER (PARTITION BY lang) + 5 * v AS HUGEINT) AS BIGINT) AS q
  FROM p JOIN v USING (lang) GROUP BY lang, term, v),
f AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
    SELECT x.lang, x.source AS one, y.source AS two, sum(abs(x.p - y.p)) AS s FROM p x JOIN p y USING (lang, term) GROUP BY ALL) s
    ON s.lang = a.lang AND one = a.source AND two = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM f)
WHERE part = 'pair' OR rank <= 50
"""


@query("op11_source_audit", OP11_SQL)
def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.source_audit import audit

    return audit(table(spark, sf_dir, "documents"))


@query("op12_merkle_manifest")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where two divides the id's CRC-32, the text has lost its line feeds since."""
    from flightlake.llm.manifest import manifest

    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 != 0
    without = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    now = {"text": F.when(F.coalesce(odd, F.lit(True)), F.col("text")).otherwise(without)}
    return manifest(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], now)


OP13_SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.r <> c.r AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS rank FROM s)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM n WHERE rank <= 5
"""


@query("op13_nearest_vectors", OP13_SQL)
def op13_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from flightlake.llm.nearest import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)

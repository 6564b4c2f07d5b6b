"""Vectors: embedding jobs, exact top-k and leaf-pruned top-k by dot product.

Scoring multiplies matrices inside tasks and emits only the k best documents
per question and portion; pairs are never materialised. Portions and blocks are
bounded on both sides, so neither a crowded leaf nor a large question batch ends
up in one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.ml.feature import HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flightlake.constants import LEAF_SIZE, LEAVES_SEARCHED, MAX_TOP_K, VECTOR_DIMENSIONS
from flightlake.session import materialise, work_folder

DOC_BLOCK = 8192
QUESTION_BLOCK = 1024
#: Matches of a block of questions, components of documents and products that a task holds at a time.
HELD_MATCHES = 500_000
HELD_VALUES = 8_000_000
HELD_PRODUCTS = 1 << 18
#: Components that one of a vector with mostly zeros counts as: its row and place are held and sorted with it.
THIN_WEIGHT = 4
#: Bytes of a row group of the stored questions, which a reader decodes as a whole.
QUESTION_BYTES = 4 << 20
#: Most children of a node of the leaf tree, sampled rows per child that it is fitted on, and most levels.
MOST_CHILDREN = 1024
SAMPLED_ROWS = 32
MOST_LEVELS = 4
#: A vector is also stored in its second leaf if that centre is at most so much farther.
BORDER = 1.15
#: Questions on which the share of leaves to search is measured, and the recall it has to reach.
MEASURED_QUESTIONS = 256
WANTED_RECALL = 0.93


def embed_documents(
    rows: DataFrame, text: str = "content", dimensions: int = VECTOR_DIMENSIONS
) -> DataFrame:
    """Hashed word counts of unit length as ``embedding``; JVM-side, no shuffle."""
    words = RegexTokenizer(
        inputCol=text, outputCol="_words", pattern=r"[^\p{L}\p{N}]+", minTokenLength=1
    )
    hashed = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions)
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    vectors = unit.transform(hashed.transform(words.transform(rows)))
    return vectors.withColumn("embedding", vector_to_array("_unit")).drop(
        "_words", "_counts", "_unit"
    )


def embed_with_model(
    rows: DataFrame,
    model: Callable[[list[str]], list[list[float]]],
    text: str = "content",
    batch_size: int = 5,
    attempts: int = 6,
    first_wait: float = 5.0,
) -> DataFrame:
    """Embed with a caller's model, in small batches with doubling waits between tries."""
    columns = rows.columns
    vector = T.StructField("embedding", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*rows.schema.fields, vector])

    def embed(frames: Iterator) -> Iterator:
        import time

        for frame in frames:
            texts, vectors = frame[text].tolist(), []
            for start in range(0, len(texts), batch_size):
                for attempt in range(attempts):
                    try:
                        vectors.extend(model(texts[start : start + batch_size]))
                        break
                    except Exception:
                        if attempt == attempts - 1:
                            raise
                        time.sleep(first_wait * 2**attempt)
            yield frame[columns].assign(embedding=vectors)

    return rows.mapInPandas(embed, schema)


def _match_schema(questions: DataFrame, documents: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("request_id", questions.schema["request_id"].dataType),
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def with_vector(rows: DataFrame, key: str) -> DataFrame:
    """Ids and vectors of the rows that have one."""
    vector = F.col("embedding").cast("array<double>").alias("embedding")
    return rows.where(F.size("embedding") > 0).select(key, vector)


def thin_rows(rows: DataFrame, key: str) -> DataFrame:
    """Ids, the components that are not zero as ``values``, and which those are as ``filled``, a bit each.

    Vectors that are mostly zeros reach Python in a small part of their bytes: an Arrow batch
    of whole ones would be held in the JVM, its buffers and Python at once. Rows without a vector
    are told by the reader; a filter here would compute the vectors twice.
    """
    vector = F.col("embedding").cast("array<double>").alias("embedding")
    return rows.select(key, vector).select(
        key,
        F.array_remove("embedding", 0.0).alias("values"),
        F.transform("embedding", lambda x: ~x.eqNullSafe(F.lit(0.0))).alias("filled"),
    )


def _searcher(k: int, schema: T.StructType, most: int, once: bool) -> Callable:
    """Best k documents of a portion for each question of a block, as ``search(part, portion)``.

    ``portion`` is what ``_gatherer`` makes: ids in order and groups of documents. A group's
    products with the questions are one matrix, or, where most components are zero, a matrix
    for the different patterns of components that many documents have, and lists of the
    documents that have the others. The k best so far of a question keep all lower products from being
    looked at; ``most`` bounds the products that are formed at once. With
    ``once``, an id counts once, by its best product. ``floors``, if given, are products that the
    k best of the block's questions are known to reach; the search raises them.
    """
    import numpy as np
    import pyarrow as pa

    layout = to_arrow_schema(schema)

    def products(group, questions):
        if "lists" not in group:
            return questions @ group["rows"]().T
        lists, number = group["lists"], group["count"]
        found = (questions[:, group["common"]] @ group["patterns"].T).take(group["pattern"], axis=1)
        for row, question in zip(found, questions, strict=True):
            places = [p for p in np.flatnonzero(question).tolist() if p in lists]
            if places:
                at = np.concatenate([lists[p][0] for p in places])
                values = np.concatenate([question[p] * lists[p][1] for p in places])
                row += np.bincount(at, values, number)
        return found

    def candidates(found, ranks, level, last):
        """Places and rounded products of those that may be among the k best, first ones of equals first."""
        count = found.shape[1]
        floor, fresh = level.copy(), np.isneginf(level)
        if fresh.any() and not once and count >= k:
            # the k-th best of some is not above the k-th best of all
            some = found[fresh, : max(k, 4096)]
            some = np.where(np.isnan(some), -np.inf, some)
            place = some.shape[1] - k
            floor[fresh] = np.round(np.partition(some, place, axis=1)[:, place], 6)
        flat = np.flatnonzero((found > (floor - 1e-6)[:, None]).ravel())
        row, column = flat // count, flat % count
        score = np.round(found.ravel()[flat], 6) + 0.0
        equal = score == floor[row]
        first = np.searchsorted(row, row)
        before = np.concatenate([[0], np.cumsum(equal)])
        among = before[1:] - before[first]
        equal &= np.where(fresh[row], among <= k, ranks[column] < last[row])
        kept = (score > floor[row]) | equal
        return row[kept], ranks[column[kept]], score[kept]

    def merged(state, level, last):
        row, rank, score = (np.concatenate(x) for x in zip(*state, strict=True))
        if once:
            order = np.lexsort((-score, rank, row))
            row, rank, score = row[order], rank[order], score[order]
            again = (row[1:] == row[:-1]) & (rank[1:] == rank[:-1])
            new = np.concatenate([[True], ~again]) if len(row) else np.zeros(0, bool)
            row, rank, score = row[new], rank[new], score[new]
        order = np.lexsort((rank, -score, row))
        order = order[np.arange(len(row)) - np.searchsorted(row[order], row[order]) < k]
        row, rank, score = row[order], rank[order], score[order]
        full = np.arange(len(row)) - np.searchsorted(row, row) == k - 1
        level[row[full]], last[row[full]] = score[full], rank[full]
        return [(row, rank, score)]

    def visits(part, portion):
        """Which questions visit which group; None: all visit all."""
        if "centres" not in portion:
            return None
        near = np.round(portion["matrix"](part["embedding"]) @ portion["centres"].T, 6)
        score = np.asarray(part["cut_score"])[:, None]
        return (near > score) | ((near == score) & (portion["leaves"] <= np.asarray(part["cut_leaf"])[:, None]))

    def search(part, portion, floors=None):
        asked, seen = portion["matrix"](part["embedding"]), visits(part, portion)
        widest = max(group["count"] for group in portion["groups"])
        step = max(1, min(len(asked), most // widest))
        for start in range(0, len(asked), step):
            block = asked[start : start + step]
            level, last = np.full(len(block), -np.inf), np.zeros(len(block), "int64")
            if floors is not None:
                level = floors[start : start + step]
                # an equal product of an earlier portion may have the larger id
                last[~np.isneginf(level)] = np.iinfo("int64").max
            state, waiting = [], 0
            for group in portion["groups"]:
                rows = None if seen is None else np.flatnonzero(seen[start : start + step, group["leaf"]])
                if rows is not None and not len(rows):
                    continue
                chosen = slice(None) if rows is None else rows
                row, rank, score = candidates(
                    products(group, block[chosen]), group["ranks"], level[chosen], last[chosen]
                )
                state.append((row if rows is None else rows[row], rank, score))
                waiting += len(row)
                if waiting > 4 * k * len(block):
                    state, waiting = merged(state, level, last), 0
            if state:
                row, rank, score = merged(state, level, last)[0]
                found = [
                    part["request_id"].take(pa.array(row + start)),
                    portion["ids"].take(pa.array(rank)),
                    pa.array(score),
                ]
                yield from pa.Table.from_arrays(found, names=layout.names).cast(layout).to_batches()

    return search


def _gatherer(held: int, doc_block: int, once: bool, centres: str | None) -> Callable:
    """Document batches as portions of ``held`` components at most, their documents in order.

    Zeros of vectors that have mostly zeros are neither held nor counted, their other
    components as ``THIN_WEIGHT``. Batches have whole vectors or come from ``thin_rows``. With a
    folder of ``centres``, a group is documents of one leaf, else of following ids.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    long, weight = 4 * doc_block, THIN_WEIGHT

    def matrix(column):
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        values = np.asarray(pc.list_flatten(column), dtype="float64")
        return values.reshape(len(column), -1)

    def thin(rows):
        row, place = np.nonzero(rows)
        return *placed(row, place, rows.shape[1]), rows[row, place]

    def placed(row, place, width):
        return row.astype("int32"), place.astype("uint16" if width <= 1 << 16 else "int32")

    def read(batch):
        """Ids, vectors (whole, or thin where mostly zeros) and the number of components to hold; rows without one go."""
        ids = batch["doc_id"]
        if "embedding" in batch.schema.names:
            rows = matrix(batch["embedding"])
            filled = np.count_nonzero(rows)
            if filled * 4 >= rows.size:
                return ids, rows, rows.size
            return ids, (*thin(rows), rows.shape[1], len(rows)), weight * (filled + len(rows))
        sizes = np.asarray(pc.fill_null(pc.list_value_length(batch["filled"]), 0))
        ids = ids.filter(pa.array(sizes > 0))
        bits = np.asarray(pc.list_flatten(batch["filled"]).to_numpy(zero_copy_only=False), dtype=bool)
        # a copy, so that the batch is let go; a null component is no number
        found = np.array(pc.list_flatten(batch["values"]), dtype="float64")
        count, width = len(ids), len(bits) // max(1, len(ids))
        if not count:
            return ids, None, 0
        if len(found) * 4 >= len(bits):
            rows = np.zeros(len(bits))
            rows[bits] = found
            return ids, rows.reshape(count, -1), rows.size
        at = np.flatnonzero(bits)
        return ids, (*placed(at // width, at % width, width), found, width, count), weight * (len(found) + count)

    def different(rows):
        """Different rows and where each is among them; sorted by one number each where that tells them apart."""
        bits, told = rows.view("uint64"), np.zeros(len(rows), "uint64")
        for column in bits.T:
            told = (told ^ column) * np.uint64(0x9E3779B97F4A7C15)
            told ^= told >> np.uint64(29)
        _, first, number = np.unique(told, return_index=True, return_inverse=True)
        if (bits[first][number] == bits).all():
            return rows[first], number
        return np.unique(rows, axis=0, return_inverse=True)

    def lists_of(group, row, place, values, width):
        count = group["count"]
        many = np.bincount(place, minlength=width)
        common = np.flatnonzero(many * 8 > count)
        number = np.full(width, -1)
        number[common] = np.arange(len(common))
        full = number[place] >= 0
        columns = np.zeros((count, len(common)))
        columns[row[full], number[place[full]]] = values[full]
        patterns, pattern = different(columns)
        row, place, values = row[~full], place[~full], values[~full]
        order = np.argsort(place.astype("uint16") if width <= 1 << 16 else place, kind="stable")
        row, place, values = row[order], place[order], values[order]
        ends = np.flatnonzero(np.diff(place, append=-1)) + 1
        starts = np.concatenate([[0], ends[:-1]]).astype(int)
        lists = {int(place[a]): (row[a:b], values[a:b]) for a, b in zip(starts, ends, strict=True)}
        told = {"common": common, "patterns": patterns, "pattern": pattern.ravel()}
        return group | told | {"lists": lists}

    def portion(ids, vectors, leaves):
        ids = pa.chunked_array(ids).combine_chunks()
        by_id = np.asarray(pc.sort_indices(ids))
        ids = ids.take(pa.array(by_id))
        ranks = np.arange(len(ids))
        if once:
            told = ids.dictionary_encode(null_encoding="encode")
            ranks, ids = np.asarray(told.indices).astype("int64"), told.dictionary
        made, order = {"ids": ids, "matrix": matrix}, by_id
        if leaves:
            leaf = np.concatenate(leaves)[by_id]
            by_leaf = np.argsort(leaf, kind="stable")
            leaf, ranks, order = leaf[by_leaf], ranks[by_leaf], by_id[by_leaf]
            import pyarrow.dataset as ds

            near = ds.dataset(centres, format="parquet").to_table(
                columns=["leaf", "centre"], filter=ds.field("leaf").isin(np.unique(leaf).tolist())
            ).sort_by("leaf")
            if not near.num_rows:
                return None
            made |= {"centres": matrix(near["centre"]), "leaves": np.asarray(near["leaf"])}
            edges = np.flatnonzero(np.diff(leaf, prepend=leaf[:1] - 1))
        sparse = any(isinstance(v, tuple) for v in vectors)
        width = next(v[3] if isinstance(v, tuple) else v.shape[1] for v in vectors)
        if sparse:
            vectors = [v if isinstance(v, tuple) else (*thin(v), v.shape[1], len(v)) for v in vectors]
            begin = np.cumsum([0] + [v[4] for v in vectors])
            back = np.empty(len(order), "int64")
            back[order] = np.arange(len(order))
            row = back[np.concatenate([v[0] + b for v, b in zip(vectors, begin, strict=False)])]
            by_row = np.argsort(row, kind="stable")
            row = row[by_row]
            place = np.concatenate([v[1] for v in vectors])[by_row]
            values = np.concatenate([v[2] for v in vectors])[by_row]
        else:
            whole, at = np.empty((len(order), width)), np.empty(len(order), "int64")
            at[order] = np.arange(len(order))
            for v in vectors:
                whole[at[: len(v)]] = v
                at = at[len(v) :]
        size = long if sparse and not leaves else doc_block
        # the first group is small where nothing else tells what the k best reach
        begun = [0, 512] if once and not leaves else [0]
        pieces = [(a, a + size) for a in range(begun[-1], len(order), size)]
        pieces = [(0, 512), *pieces] if len(begun) > 1 else pieces
        if leaves:
            ends = np.append(edges[1:], len(order))
            pieces = [
                (a, min(a + size, end)) for first, end in zip(edges, ends, strict=True) for a in range(first, end, size)
            ]
        groups = []
        for start, end in pieces:
            end = min(end, len(order))
            group = {"count": end - start, "ranks": ranks[start:end]}
            if leaves:
                at = np.searchsorted(made["leaves"], leaf[start])
                if at == len(made["leaves"]) or made["leaves"][at] != leaf[start]:
                    continue
                group["leaf"] = at
            if not sparse:
                group["rows"] = lambda part=whole[start:end]: part
            else:
                a, b = np.searchsorted(row, [start, end])
                if end - start >= 4096:
                    group = lists_of(group, row[a:b] - start, place[a:b], values[a:b], width)
                else:

                    def rows(n=end - start, r=row[a:b] - start, p=place[a:b], v=values[a:b]):
                        filled = np.zeros((n, width))
                        filled[r, p] = v
                        return filled

                    group["rows"] = rows
            groups.append(group)
        return made | {"groups": groups} if groups else None

    def gathered(batches):
        ids, vectors, leaves, values = [], [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            told, rows, size = read(batch)
            if not len(told):
                continue
            ids.append(told)
            vectors.append(rows)
            if centres:
                leaves.append(np.asarray(batch["leaf"]))
            values += size
            if values >= held:
                made = portion(ids, vectors, leaves)
                # what the portion was made of is let go before it is searched
                batch, rows, ids, vectors, leaves, values = None, None, [], [], [], 0
                yield made
                made = None
        if ids:
            made = portion(ids, vectors, leaves)
            batch, rows, ids, vectors, leaves = None, None, [], [], []
            yield made

    return gathered


def top_matches(scored: DataFrame, k: int) -> DataFrame:
    """The k best of each question: higher product first, then the smaller id."""
    best = Window.partitionBy("request_id").orderBy(F.desc("distance"), "doc_id")
    return scored.withColumn("match_rank", F.row_number().over(best)).where(
        F.col("match_rank") <= k
    )


def _check_k(k: int) -> None:
    if not 1 <= k <= MAX_TOP_K:
        raise ValueError(f"k must be between 1 and {MAX_TOP_K}")


def stored_blocks(questions: DataFrame) -> str:
    """The questions' ids and vectors as files that every task can read in blocks."""
    folder = work_folder(questions.sparkSession, "questions")
    questions.select("request_id", "embedding").write.option("parquet.block.size", QUESTION_BYTES).parquet(folder)
    return folder


def score_where_they_lie(
    folder: str,
    documents: DataFrame,
    k: int,
    schema: T.StructType,
    block: int,
    doc_block: int = DOC_BLOCK,
    once: bool = False,
    centres: str | None = None,
) -> DataFrame:
    """Best matches per task: a task reads the question blocks once for each portion of its documents.

    A portion has ``HELD_VALUES`` components at most; of a question, its k best in a
    portion are handed on. ``once``: an id that occurs several times counts once.
    With a folder of ``centres``, questions carry the last leaf that they visit
    (``cut_score``, ``cut_leaf``), documents their ``leaf``, and only the leaves
    up to it are compared. What a question's k best reach in a task's earlier portions
    is kept, a number per question, and only products that reach it are handed on.
    """
    block = max(1, min(block, HELD_MATCHES // k))
    search = _searcher(k, schema, HELD_PRODUCTS, once)
    gathered = _gatherer(HELD_VALUES, doc_block, once, centres)

    def score(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow.dataset as ds

        asked = ds.dataset(folder, schema=None, format="parquet")
        reading = ds.ParquetFragmentScanOptions(pre_buffer=False)
        reached = {}
        for portion in gathered(batches):
            if portion is None:
                continue
            blocks = asked.to_batches(
                batch_size=block, batch_readahead=1, fragment_readahead=1, fragment_scan_options=reading
            )
            for number, part in enumerate(blocks):
                if part.num_rows:
                    floors = None if once else reached.setdefault(number, np.full(part.num_rows, -np.inf))
                    yield from search(part, portion, floors)
            portion = blocks = part = None

    return documents.mapInArrow(score, schema)


def vector_top_k(
    questions: DataFrame, documents: DataFrame, k: int = 5, block: int = QUESTION_BLOCK
) -> DataFrame:
    """Exact top-k documents per question by dot product.

    The questions are written once to the shared folder. Documents are scanned
    once, where they lie, in portions of bounded size; each task goes through the
    question blocks once a portion and keeps k rows per question, and ranks merge the
    rows before and after the one shuffle of matches. Nothing passes through the driver.
    """
    _check_k(k)
    asked, filed = with_vector(questions, "request_id"), thin_rows(documents, "doc_id")
    return best_by_product(stored_blocks(asked), asked, filed, k, block)


def best_by_product(
    folder: str, asked: DataFrame, filed: DataFrame, k: int, block: int = QUESTION_BLOCK
) -> DataFrame:
    schema = _match_schema(asked, filed)
    return top_matches(score_where_they_lie(folder, filed, k, schema, block), k)


def _square_distances(points, centres):
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)


def _centres_of(points, children: int, iterations: int, seed: int):
    """Lloyd's k-means from random different points; centres that lose all points are gone."""
    import numpy as np

    different = np.unique(points, axis=0)
    chosen = np.random.default_rng(seed).permutation(len(different))[:children]
    centres = different[chosen]
    for _ in range(iterations):
        nearest = _square_distances(points, centres).argmin(1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        centres = sums[counts > 0] / counts[counts > 0][:, None]
    return centres


class VectorLeaves:
    """Documents sorted into leaves of about ``leaf_size``, for pruned search.

    ``leaves`` holds (doc_id, embedding, cell, leaf): a leaf is a cell of the tree's
    last level, a cell one of its first. Vectors near a border between leaves are
    stored in both. ``centres`` holds (cell, leaf, centre). Saved, each cell is a
    folder sorted by leaf. ``searched`` is the share of leaves that a search visits.
    """

    def __init__(self, leaves: DataFrame, centres: DataFrame, searched: float = LEAVES_SEARCHED):
        self.leaves, self.centres, self.searched = leaves, centres, searched

    @classmethod
    def build(
        cls,
        documents: DataFrame,
        leaf_size: int = LEAF_SIZE,
        iterations: int = 10,
        seed: int = 42,
        measure_k: int = 5,
    ) -> VectorLeaves:
        """Split the documents level by level until leaves have about ``leaf_size``, and measure the index.

        A node is split by centres fitted on a sample of ``SAMPLED_ROWS`` rows per
        child, drawn by a hash of the id; every document is filed. A node with more
        rows than ``MOST_CHILDREN`` leaves hold is split by about the square root of
        its leaves first, so leaves keep their size however many documents there
        are; only equal vectors, or ``MOST_LEVELS`` uneven splits, leave larger ones.
        """
        documents = materialise(with_vector(documents, "doc_id"), "vectors")
        rows = documents.withColumns({"node": F.lit(0).cast("bigint"), "cell": F.lit(0)})
        done, centres = [], []
        for level in range(MOST_LEVELS):
            nodes = materialise(_plan_split(rows, leaf_size, last=level == MOST_LEVELS - 1), "nodes")
            fitted = materialise(_fit(rows, nodes, iterations, seed), "centres")
            filed = materialise(_file(rows, nodes, fitted, first=level == 0), "filed")
            done.append(filed.where("leaf").select("doc_id", "embedding", "cell", F.col("node").alias("leaf")))
            first = F.col("child") if level == 0 else F.col("cell")
            centres.append(
                fitted.where("leaf").select(
                    first.cast("int").alias("cell"), _child_node().alias("leaf"), "centre"
                )
            )
            rows = filed.where(~F.col("leaf")).select("doc_id", "embedding", "node", "cell")
            if rows.isEmpty():
                break
        leaves = reduce(DataFrame.unionByName, done)
        built = cls(leaves, materialise(reduce(DataFrame.unionByName, centres), "leaf-centres"))
        built.searched = built.measured_share(documents, measure_k)
        return built

    def save(self, path: str) -> None:
        """One folder per cell, its rows in order of their leaves; a crowded cell is written by several tasks."""
        (
            self.leaves.repartitionByRange("cell", "leaf", "doc_id")
            .sortWithinPartitions("cell", "leaf")
            .write.mode("overwrite")
            .partitionBy("cell")
            .parquet(f"{path}/leaves")
        )
        told = self.centres.withColumn("searched", F.lit(self.searched))
        told.coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VectorLeaves:
        centres = spark.read.parquet(f"{path}/centres")
        first = centres.select("searched").first()
        searched = LEAVES_SEARCHED if first is None else first["searched"]
        return cls(spark.read.parquet(f"{path}/leaves"), centres.drop("searched"), searched)

    def visited(self, searched: float) -> int:
        return max(1, math.ceil(self.centres.count() * searched))

    def probes(self, asked: DataFrame, visited: int) -> DataFrame:
        """(request_id, leaf, probe_rank): the leaves whose centres have the largest product with a question."""
        filed = self.centres.select(F.col("leaf").alias("doc_id"), F.col("centre").alias("embedding"))
        found = best_by_product(stored_blocks(asked), asked, filed, visited)
        return found.select("request_id", F.col("doc_id").alias("leaf"), F.col("match_rank").alias("probe_rank"))

    def measured_share(
        self, documents: DataFrame, k: int, wanted: float = WANTED_RECALL, sample: int = MEASURED_QUESTIONS
    ) -> float:
        """The least share of leaves, ``LEAVES_SEARCHED`` or more, that finds ``wanted`` of the exact matches.

        Measured on ``sample`` stored vectors, drawn by a hash of the id, each asking
        for its k nearest others: a match is found by as many leaves as the best
        ranked of the leaves that hold it.
        """
        count = documents.count()
        drawn = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(max(1, count // sample))) == 0
        asked = materialise(
            documents.where(drawn).select(F.col("doc_id").alias("request_id"), "embedding"), "measured"
        )
        exact = best_by_product(stored_blocks(asked), asked, documents, k + 1)
        exact = exact.where(F.col("request_id") != F.col("doc_id")).select("request_id", "doc_id")
        leaves = self.centres.count()
        ranks = (
            exact.join(self.leaves.select("doc_id", "leaf"), "doc_id")
            .join(self.probes(asked, leaves), ["request_id", "leaf"])
            .groupBy("request_id", "doc_id")
            .agg(F.min("probe_rank").alias("needed"))
        )
        needed = ranks.agg(F.percentile("needed", wanted)).first()[0]
        return LEAVES_SEARCHED if needed is None else max(LEAVES_SEARCHED, min(1.0, needed / leaves))

    def search(
        self,
        questions: DataFrame,
        k: int = 5,
        searched: float | None = None,
        doc_block: int = DOC_BLOCK,
        question_block: int = QUESTION_BLOCK,
    ) -> DataFrame:
        """Top-k among the documents of the visited leaves: the measured share of them, or ``searched``.

        Leaves are scored where they lie and copied nowhere. Of the leaves that a question
        visits, only the last is stored beside it; what lies before it follows from the
        centres. A leaf with a third of all documents is read by many tasks.
        """
        _check_k(k)
        asked = with_vector(questions, "request_id")
        schema = _match_schema(questions, self.leaves)
        visited = self.visited(self.searched if searched is None else searched)
        documents, centres = self.leaves, None
        if visited < self.centres.count():
            centres = work_folder(asked.sparkSession, "leaf-centres")
            self.centres.select("leaf", "cell", "centre").write.parquet(centres)
            folder = work_folder(asked.sparkSession, "reach")
            _reach(asked, centres, visited).write.option("parquet.block.size", QUESTION_BYTES).parquet(folder)
            # cells are children of the tree's root: MOST_CHILDREN at most
            cells = asked.sparkSession.read.parquet(folder).select(F.explode("cells").alias("cell")).distinct()
            documents = documents.where(F.col("cell").isin([row["cell"] for row in cells.collect()]))
        else:
            folder = stored_blocks(asked)
        filed = documents.select("doc_id", "embedding", "leaf")
        scored = score_where_they_lie(folder, filed, k, schema, question_block, doc_block, True, centres)
        once = scored.groupBy("request_id", "doc_id").agg(F.max("distance").alias("distance"))
        return top_matches(once, k)


def _reach(asked: DataFrame, centres: str, visited: int) -> DataFrame:
    """Questions with the last leaf that they visit, ``visited`` in all, and a batch's cells on its first row.

    Leaves come by the product of their centres, higher first, then the smaller leaf.
    """
    schema = T.StructType(
        [
            *asked.select("request_id", "embedding").schema.fields,
            T.StructField("cut_score", T.DoubleType()),
            T.StructField("cut_leaf", T.LongType()),
            T.StructField("cells", T.ArrayType(T.IntegerType())),
        ]
    )
    layout, most = to_arrow_schema(schema), HELD_PRODUCTS

    def reach(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds

        def matrix(column):
            return np.asarray(pc.list_flatten(column), dtype="float64").reshape(len(column), -1)

        told = ds.dataset(centres, format="parquet").to_table().sort_by("leaf").combine_chunks()
        leaves, cells = np.asarray(told["leaf"]), np.asarray(told["cell"])
        points = matrix(told["centre"].combine_chunks()).T
        step = max(1, most // len(leaves))
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                near = np.round(matrix(part["embedding"]) @ points, 6)
                place = len(leaves) - visited
                score = np.partition(near, place, axis=1)[:, place][:, None]
                missing = visited - (near > score).sum(axis=1, keepdims=True)
                level = near == score
                last = (level.cumsum(axis=1) >= missing).argmax(axis=1)
                seen = (near > score) | (level & (np.arange(len(leaves)) <= last[:, None]))
                reached = [np.unique(cells[seen.any(axis=0)]).tolist(), *[None] * (part.num_rows - 1)]
                columns = [part["request_id"], part["embedding"], score[:, 0], leaves[last], reached]
                arrays = [pa.array(c, f.type) if not isinstance(c, pa.Array) else c for c, f in zip(columns, layout, strict=True)]
                yield from pa.Table.from_arrays(arrays, names=layout.names).cast(layout).to_batches()

    return asked.select("request_id", "embedding").mapInArrow(reach, schema)


def _child_node():
    return F.col("node") * (MOST_CHILDREN + 1) + F.col("child") + 1


def _plan_split(rows: DataFrame, leaf_size: int, last: bool) -> DataFrame:
    """(node, rows, children, leaf, blocks): how each node is split; ``leaf``: its children are leaves."""
    wanted = F.ceil(F.col("rows") / F.lit(leaf_size))
    leaf = (wanted <= MOST_CHILDREN) | F.lit(last)
    children = F.when(leaf, wanted).otherwise(F.ceil(F.sqrt(wanted)))
    return rows.groupBy("node", "cell").agg(F.count("*").alias("rows")).select(
        "node",
        "cell",
        "rows",
        F.least(children, F.lit(MOST_CHILDREN)).cast("int").alias("children"),
        leaf.alias("leaf"),
        F.ceil(F.col("rows") / F.lit(DOC_BLOCK)).cast("int").alias("blocks"),
    )


def _fit(rows: DataFrame, nodes: DataFrame, iterations: int, seed: int) -> DataFrame:
    """(node, cell, leaf, child, centre): the centres of every node, each fitted in a task on a sample."""
    share = F.least(F.lit(1.0), F.col("children") * F.lit(float(SAMPLED_ROWS)) / F.col("rows"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < share * F.lit(float(1 << 30))
    sample = rows.drop("cell").join(nodes, "node").where(drawn)

    def fit(table):
        import numpy as np
        import pyarrow as pa

        points = np.array(table["embedding"].to_pylist(), dtype="float32")
        centres = _centres_of(points, table["children"][0].as_py(), iterations, seed).astype("float64")
        told = {name: [table[name][0].as_py()] * len(centres) for name in ("node", "cell", "leaf")}
        schema = pa.schema(
            [
                ("node", pa.int64()),
                ("cell", pa.int32()),
                ("leaf", pa.bool_()),
                ("child", pa.int32()),
                ("centre", pa.list_(pa.float64())),
            ]
        )
        return pa.table({**told, "child": range(len(centres)), "centre": centres.tolist()}, schema=schema)

    return sample.select("node", "cell", "leaf", "children", "embedding").groupBy("node").applyInArrow(
        fit, "node bigint, cell int, leaf boolean, child int, centre array<double>"
    )


def _file(rows: DataFrame, nodes: DataFrame, fitted: DataFrame, first: bool) -> DataFrame:
    """(doc_id, embedding, node, cell, leaf): rows below the nearest child of their node.

    Where the children are leaves, a row near the border is below its second
    nearest, too. Nodes are cut into blocks, to each of which their centres go. A node
    whose sample came out empty has one child.
    """
    kind = rows.schema["doc_id"].dataType.simpleString()
    block = F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int")
    left = rows.join(nodes.select("node", "leaf", "blocks"), "node").withColumn("block", block)
    right = fitted.drop("leaf").join(nodes.select("node", "blocks"), "node").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    border, most = BORDER, MOST_CHILDREN

    def file(docs, centres):
        import numpy as np
        import pyarrow as pa

        if not docs.num_rows:
            return pa.table([[]] * 5, schema=layout)
        points = np.array(docs["embedding"].to_pylist(), dtype="float64")
        order = [[i] for i in np.zeros(len(points), int).tolist()]
        if centres.num_rows:
            centres = centres.sort_by("child")
            matrix = np.array(centres["centre"].to_pylist())
            away = np.sqrt(np.maximum(_square_distances(points, matrix), 0))
            order = np.argsort(away, axis=1, kind="stable")[:, :2]
            if order.shape[1] == 2 and docs["leaf"][0].as_py():
                lead = np.take_along_axis(away, order, 1)
                order = [o if far <= border * near else o[:1] for o, (near, far) in zip(order.tolist(), lead.tolist(), strict=True)]
            else:
                order = order[:, :1].tolist()
        row = np.repeat(np.arange(len(points)), [len(o) for o in order])
        child = np.concatenate([np.array(o) for o in order])
        taken = docs.take(pa.array(row))
        node = docs["node"][0].as_py() * (most + 1) + child + 1
        cell = child if first else np.full(len(child), docs["cell"][0].as_py())
        return pa.table(
            [taken["doc_id"], taken["embedding"], node, pa.array(cell, pa.int32()), taken["leaf"]], schema=layout
        )

    layout = to_arrow_schema(
        T.StructType(
            [
                T.StructField("doc_id", rows.schema["doc_id"].dataType),
                T.StructField("embedding", T.ArrayType(T.DoubleType())),
                T.StructField("node", T.LongType()),
                T.StructField("cell", T.IntegerType()),
                T.StructField("leaf", T.BooleanType()),
            ]
        )
    )
    by = ["node", "block"]
    told = left.select(*by, "doc_id", "embedding", "cell", "leaf").groupBy(*by)
    return told.cogroup(right.select(*by, "child", "centre").groupBy(*by)).applyInArrow(
        file, f"doc_id {kind}, embedding array<double>, node bigint, cell int, leaf boolean"
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """Share of the exact matches that a pruned search also returned."""
    hit = exact.join(
        found.select("request_id", "doc_id", F.lit(True).alias("hit")),
        ["request_id", "doc_id"],
        "left",
    )
    return hit.agg(
        F.count("*").alias("exact_matches"),
        F.count_if("hit").alias("found_matches"),
        F.round(
            F.try_divide(F.count_if("hit").cast("double"), F.count("*")), 4
        ).alias("recall"),
    )

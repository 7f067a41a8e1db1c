"""Ranked lexical search over all documents: term-at-a-time over short lists, document-at-a-time over long ones.

The index is partitioned by document. One row holds a block of documents, ordered by id, with the postings (document, count)
of each term, so no term is hot and a lost executor costs the blocks it held. Corpus counts (documents, terms, documents
per term) are summed by Spark from all blocks before any score is computed.

For each query, the terms that stand in at most ``short_share`` of the documents have short lists: they are summed term
at a time into accumulators. The accumulators are then one more list, bounded by their largest sum in the block, beside
the long lists with their largest contributions. In order of these bounds, the lists whose bounds together stay below the
``k``-th best score so far cannot make a hit alone: only documents of the other lists are candidates, and each further list
is only looked up (skipping) for candidates that its and the lower bounds can still lift to that score. Scores are exact
integers, and equal ones rank by ascending id, so results do not depend on the partitioning.

Queries are held in blocks of about ``block_terms`` distinct terms; every block is searched over all documents. Terms are runs of
letters, digits and non-ASCII; only A-Z is lower-cased. Null or empty texts have no terms, and such queries no hits. Rows of
one item id form one query; a null id is an id of its own. Repeated document rows are ranked one by one, null document
ids after the others. Only the id and text columns are read, so further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_text, row_blocks, stored, utf8
from .decontaminate import FOLD

TOP = 50
SHORT_SHARE = 0.125
BLOCK_TERMS = 200_000
INDEX_BYTES = 2 << 20
SALTS = 64
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass
class QueryBlock:
    ids: list  # of the queries
    terms: dict[bytes, int]  # numbered from 1
    queries: list[np.ndarray]  # distinct term numbers


def query_table(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """Stored (item, terms): the distinct terms of each item id."""
    folded = F.translate(as_text(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = items.select(F.col(f"`{item_id}`").alias("item"), F.explode_outer(F.regexp_extract_all(folded, F.lit(TERM), 0)).alias("term"))
    return stored(words.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")))


def query_blocks(queries: DataFrame, block_terms: int = BLOCK_TERMS) -> Iterator[QueryBlock]:
    """The queries dealt by the hash of their id to blocks of about ``block_terms`` terms; one block at a time is on the driver."""
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = 1 + (total - 1) // block_terms if total else 0
    dealt = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    for number in range(blocks):
        rows = queries.where((F.size("terms") > 0) & (dealt == number)).collect()
        terms: dict[bytes, int] = {}
        numbers = [np.array([terms.setdefault(t.encode(), len(terms) + 1) for t in r.terms], np.int64) for r in rows]
        if rows:
            yield QueryBlock([r["item"] for r in rows], terms, numbers)


_INDEX = "sizes array<bigint>, terms array<int>, listed array<int>, docs array<int>, counts array<int>"


def document_index(docs: DataFrame, block: QueryBlock, doc_id: str, text: str, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Stored blocks: ``ids`` in ascending order, ``sizes`` (terms per document), and the postings ``docs``/``counts`` of the block's
    query terms, ``listed`` of each of ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(block.terms)
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), as_text(text).alias("text"))
    schema = T.StructType([T.StructField("ids", T.ArrayType(source.schema["id"].dataType)), *T.StructType.fromDDL(_INDEX)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = shared.value.get
        for batch in batches:
            data, offsets = utf8(batch, "text")
            raw = data.tobytes().translate(FOLD)
            for a, b in row_blocks(offsets, index_bytes):
                ids = batch.column(0).slice(a, b - a)
                order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
                words = [raw[offsets[a + i] : offsets[a + i + 1]].split() for i in order]
                sizes = np.array([len(w) for w in words], np.int64)
                term = np.fromiter((get(w, 0) for x in words for w in x), np.int64, sizes.sum())
                row = np.repeat(np.arange(b - a), sizes)
                hit = term > 0
                keys, counts = np.unique((term[hit] << 32) | row[hit], return_counts=True)
                terms, listed = np.unique(keys >> 32, return_counts=True)
                lists = [sizes, terms.astype(np.int32), listed.astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), counts.astype(np.int32)]
                columns = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), ids.take(pa.array(order)))]
                columns += [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x)) for x in lists]
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return stored(source.mapInArrow(run, schema))


@dataclass
class Corpus:
    documents: int
    terms: int
    weight: np.ndarray  # by term number
    short: np.ndarray


def corpus_counts(index: DataFrame, block: QueryBlock, short_share: float = SHORT_SHARE) -> Corpus:
    """Counts over all documents. One row a term of the query block reaches the driver."""
    n, total = index.select(F.explode("sizes").alias("s")).agg(F.count_if(F.col("s") > 0), F.sum("s")).first()
    listed = index.select(F.explode(F.arrays_zip("terms", "listed")).alias("t")).groupBy(F.col("t.terms").alias("term")).agg(F.sum("t.listed").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * (n or 0) + 2)) / (2 * F.col("df") + 1))).cast("bigint")
    weights, short = np.zeros(len(block.terms) + 1, np.int64), np.zeros(len(block.terms) + 1, bool)
    for r in listed.select("term", "df", weight.alias("w")).collect():
        weights[r.term], short[r.term] = r.w, r.df <= short_share * n
    return Corpus(n or 0, total or 0, weights, short)


def block_hits(corpus: Corpus, queries: list[np.ndarray], sizes: np.ndarray, terms: np.ndarray, listed: np.ndarray, docs: np.ndarray, counts: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, documents, scores) of a block's documents that may be among the ``k`` best, given the ``least`` score that each
    query still needs; best first. ``docs`` are ordered within each list."""
    length = 100 - 50 + (50 * sizes * corpus.documents) // max(1, corpus.terms)
    start = np.concatenate([[0], np.cumsum(listed)]).astype(np.int64)
    counts = counts.astype(np.int64)
    worth = np.repeat(corpus.weight[terms], listed) * ((1_000_000_000 * counts) // (1000 * counts + 20 * length[docs]))
    bound = np.maximum.reduceat(worth, start[:-1]) if len(terms) else np.zeros(0, np.int64)
    place = np.full(len(corpus.weight), -1, np.int64)
    place[terms] = np.arange(len(terms))
    for number, query in enumerate(queries):
        at = place[query]
        here = at >= 0
        is_short = corpus.short[query[here]]
        at = at[here]
        lists: list[tuple[int, np.ndarray, np.ndarray]] = []
        brief = at[is_short]
        if len(brief):
            into = np.concatenate([docs[start[i] : start[i + 1]] for i in brief])
            sums = np.zeros(len(sizes), np.int64)
            np.add.at(sums, into, np.concatenate([worth[start[i] : start[i + 1]] for i in brief]))
            touched = np.flatnonzero(sums)
            if len(touched):
                lists.append((int(sums.max()), touched, sums[touched]))
        lists += [(int(bound[i]), docs[start[i] : start[i + 1]], worth[start[i] : start[i + 1]]) for i in at[~is_short] if bound[i] > 0]
        lists.sort(key=lambda x: x[0])
        need = max(1, int(least[number]))
        reach = np.cumsum([x[0] for x in lists])
        first = int(np.searchsorted(reach, need))  # the lists before it cannot make a hit together
        if first == len(lists):
            continue
        score = np.zeros(len(sizes), np.int64)
        for _, where, value in lists[first:]:
            score[where] += value
        found = np.flatnonzero(score)
        score = score[found]
        for i in range(first - 1, -1, -1):
            alive = score + reach[i] >= need
            found, score = found[alive], score[alive]
            if not len(found):
                break
            _, where, value = lists[i]
            skip = np.minimum(np.searchsorted(where, found), len(where) - 1)
            score = score + np.where(where[skip] == found, value[skip], 0)
        good = score >= need
        found, score = found[good], score[good]
        if len(found):
            best = np.lexsort((found, -score))[:k]
            yield number, found[best], score[best]


def _search(index: DataFrame, block: QueryBlock, corpus: Corpus, k: int, id_type: T.DataType) -> DataFrame:
    """(query, id, score): the ``k`` best of each task's documents."""
    shared = index.sparkSession.sparkContext.broadcast((block.queries, corpus))
    schema = T.StructType([T.StructField("query", T.IntegerType()), T.StructField("id", id_type), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, counted = shared.value
        best: list[list] = [[] for _ in queries]
        least = np.zeros(len(queries), np.int64)
        arrow_id = None
        for batch in batches:
            arrow_id = batch.schema.field("ids").type.value_type
            for i in range(batch.num_rows):
                ids, *lists = (batch.column(n)[i].values for n in schema_names)
                arrays = [x.to_numpy(zero_copy_only=False) for x in lists]
                for q, where, score in block_hits(counted, queries, *arrays, least, k):
                    names = ids.take(pa.array(where)).to_pylist()
                    merged = best[q] + list(zip(score.tolist(), names))
                    merged.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
                    best[q] = merged[:k]
                    if len(merged) >= k:
                        least[q] = best[q][-1][0]
        rows = [(q, d, s) for q, hits in enumerate(best) for s, d in hits]
        if rows:
            q, d, s = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(d, arrow_id), pa.array(s, pa.int64())], ["query", "id", "score"])

    schema_names = index.columns
    return index.mapInArrow(run, schema)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    short_share: float = SHORT_SHARE,
    block_terms: int = BLOCK_TERMS,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents with a score above 0 of every item."""
    spark = docs.sparkSession
    queries = query_table(items, item_id, item_text)
    id_type, item_type = docs.schema[doc_id].dataType, queries.schema["item"]
    results = None
    for block in query_blocks(queries, block_terms):
        index = document_index(docs, block, doc_id, text, index_bytes)
        corpus = corpus_counts(index, block, short_share)
        hits = _search(index, block, corpus, k, id_type)
        order = [F.desc("score"), F.asc_nulls_last("id")]
        # first among some of the tasks, then among all: no task meets the hits of all tasks
        salted = hits.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        near = salted.withColumn("rank", F.row_number().over(Window.partitionBy("query", "salt").orderBy(*order))).where(F.col("rank") <= k)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("rank") <= k)
        names = spark.createDataFrame(list(enumerate(block.ids)), T.StructType([T.StructField("query", T.IntegerType()), item_type]))
        named = ranked.join(F.broadcast(names), "query").select(F.col("item").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
        results = named if results is None else results.unionByName(named)
    if results is None:
        schema = T.StructType([T.StructField(item_id, item_type.dataType), T.StructField("rank", T.IntegerType()), T.StructField(doc_id, id_type), T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return results

"""Ranked lexical search: term-at-a-time over blocks of documents, with a limit on accumulators."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

PIECE = 1 << 20
# Term characters are ASCII letters and digits and everything beyond ASCII; the rest becomes a space.
TERM_BYTES = bytes(b if b > 127 else ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, a bounded piece at a time."""
    data, start = text.translate(TERM_BYTES), 0
    while start < len(data):
        end = len(data) if start + PIECE >= len(data) else data.find(b" ", start + PIECE)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item, text) to (item, term), each term of a text once."""
    for batch in batches:
        for row in range(batch.num_rows):
            found = sorted({t for piece in pieces(batch.column(1)[row].as_py()) for t in piece})
            if found:
                item = pa.DictionaryArray.from_arrays(np.zeros(len(found), np.int32), batch.column(0).slice(row, 1))
                yield pa.RecordBatch.from_arrays([item.dictionary_decode(), pa.array(found, pa.binary())], ["item", "term"])


def _postings(batches: Iterator[pa.RecordBatch], vocabulary: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, n, terms, counts): all terms counted, those of the vocabulary kept. Texts without a term give no row."""
    number, step = vocabulary.get, 1024
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            kept, sizes, terms, counts = [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                n, held = 0, Counter()
                for piece in pieces(text):
                    n += len(piece)
                    held.update(map(number, piece))
                held.pop(None, None)
                if n:
                    kept.append(row), sizes.append(n), terms.append(list(held)), counts.append(list(held.values()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.array(terms, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["id", "n", "terms", "counts"],
            )


class _Queries:
    """The terms of one chunk of items with their weights, rarest first; a plain value that tasks share."""

    def __init__(self, items: pa.Array, owner: np.ndarray, term: np.ndarray, df: np.ndarray, documents: int, terms: int, k: int):
        self.items, self.k, self.documents, self.terms = items, k, documents, terms
        self.weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        order = np.lexsort((term, df[term], owner))
        bounds = np.searchsorted(owner[order], np.arange(len(items) + 1))
        self.lists = [term[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:])]

    def damping(self, sizes: np.ndarray) -> np.ndarray:
        if int(sizes.max()) * self.documents * 90 < 1 << 63:
            return 10 + 90 * sizes * self.documents // self.terms
        return np.array([10 + 90 * int(n) * self.documents // self.terms for n in sizes], np.int64)


class _Block:
    """Inverted lists of a block of documents: term -> (documents, what the term adds to their scores)."""

    def __init__(self, batches: list[pa.RecordBatch], queries: _Queries):
        table = pa.Table.from_batches(batches).combine_chunks()
        self.ids = table.column("id").combine_chunks()
        self.size = len(self.ids)
        rank = pc.sort_indices(self.ids, null_placement="at_end").to_numpy()
        self.place = np.empty(self.size, np.int64)
        self.place[rank] = np.arange(self.size)
        lists = table.column("terms").combine_chunks()
        term = lists.flatten().to_numpy().astype(np.int64)
        count = table.column("counts").combine_chunks().flatten().to_numpy()
        document = np.repeat(np.arange(self.size), pc.list_value_length(lists).to_numpy())
        damping = queries.damping(table.column("n").to_numpy())[document]
        added = queries.weights[term] * (1_000_000_000 * count // (1000 * count + 8 * damping))
        order = np.argsort(term, kind="stable")
        self.documents, self.added = document[order], added[order]
        self.bounds = np.searchsorted(term[order], np.arange(len(queries.weights) + 1))
        self.most = np.zeros(len(queries.weights), np.int64)
        np.maximum.at(self.most, term, added)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = slice(self.bounds[term], self.bounds[term + 1])
        return self.documents[span], self.added[span]

    def best(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of up to ``k`` best of the block that reach ``least``, by one list after the other.

        ``rest`` bounds what the lists from the next on can add. A document without an
        accumulator cannot pass the k-th partial score once ``rest`` is below it: from
        there on accumulators are only updated, exactly, with all lists that remain.
        """
        terms = terms[self.most[terms] > 0]
        rest = np.cumsum(self.most[terms][::-1])[::-1]
        scores, creating, held = np.zeros(self.size, np.int64), True, None
        for step, term in enumerate(terms):
            if creating:
                bound = least
                if self.size >= k and rest[step] < scores.max():
                    bound = max(bound, int(np.partition(scores, -k)[-k]))
                if rest[step] < bound:
                    creating, held = False, scores > 0
                    if not held.any():
                        break
            documents, added = self.postings(term)
            if not creating:
                known = held[documents]
                documents, added = documents[known], added[known]
            scores[documents] += added
        found = np.flatnonzero(scores >= max(least, 1))
        if len(found) > k:
            kth = np.partition(scores[found], -k)[-k]
            found = found[scores[found] >= kth]
            found = found[np.lexsort((self.place[found], -scores[found]))][:k]
        return found, scores[found]


def _search(batches: Iterator[pa.RecordBatch], queries: _Queries, block_rows: int, block_postings: int) -> Iterator[pa.RecordBatch]:
    """Postings of a partition to the best documents of every item in it; the k-th score goes on from block to block."""
    best: list[list[tuple]] = [[] for _ in queries.lists]
    kind = None

    def take(block: _Block) -> None:
        for item, terms in enumerate(queries.lists):
            least = best[item][-1][3] if len(best[item]) == queries.k else 0
            documents, scores = block.best(terms, queries.k, least)
            if len(documents):
                ids = block.ids.take(pa.array(documents)).to_pylist()
                best[item] += [(-int(s), i is None, i, int(s)) for i, s in zip(ids, scores)]
                best[item] = sorted(best[item], key=lambda row: row[:2] if row[1] else row[:3])[: queries.k]

    waiting: list[pa.RecordBatch] = []
    rows = postings = 0
    for whole in batches:
        kind = whole.schema.field("id").type
        for start in range(0, whole.num_rows, 512):
            batch = whole.slice(start, 512)
            waiting.append(batch)
            rows, postings = rows + batch.num_rows, postings + len(batch.column(2).flatten())
            if rows >= block_rows or postings >= block_postings:
                take(_Block(waiting, queries))
                waiting, rows, postings = [], 0, 0
    if rows:
        take(_Block(waiting, queries))
    owners = [item for item, found in enumerate(best) for _ in found]
    if owners:
        found = [row for rows in best for row in rows]
        items = queries.items.take(pa.array(owners, pa.int64()))
        ids = pa.array([row[2] for row in found], kind)
        yield pa.RecordBatch.from_arrays([items, ids, pa.array([row[3] for row in found], pa.int64())], ["item", "id", "score"])


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    chunk_terms: int = 1 << 18,
    block_rows: int = 4096,
    block_postings: int = 1 << 21,
) -> DataFrame:
    """The ``k`` highest-scoring documents of each item, equal scores by ascending id.

    With N documents that hold a term, L terms in all, df documents of a term, tf its
    occurrences in a document and n that document's terms, a document scores the sum
    over an item's distinct terms of ``w * (10^9 tf div (1000 tf + 8 m))``, where
    ``w = floor(1000 ln((2N+2)/(2df+1)))`` and ``m = 10 + (90 n N) div L``. Counts are
    over all documents and whole texts.

    Documents are read once per chunk of items (as many items as have ``chunk_terms``
    distinct terms between them, so what tasks are sent is bounded; one item alone may
    be larger) and reduced to their postings for the items' terms. Every task then
    inverts blocks of its documents and handles an item's lists rarest first: while
    the lists that remain could lift a new document to the k-th partial score,
    documents get accumulators; afterwards only existing ones are updated, exactly. The
    k-th score of earlier blocks counts from the start. Tasks give at most ``k`` rows
    an item, which are merged over salted groups.

    Returns ``item_column``, ``rank`` (from 1), ``id_column`` and ``score``, above 0
    only. Null and empty texts have no terms; items without terms give no row. Items
    that share an id (null too) are one item with the terms of all; rows that repeat a
    document id are documents of their own; a null document id comes last among equal
    scores. Other columns are ignored.
    """
    spark = docs.sparkSession
    id_type, item_type = docs.schema[id_column].dataType.simpleString(), items.schema[item_column].dataType.simpleString()

    def texts(df: DataFrame, key: str, text: str, name: str) -> DataFrame:
        return df.select(F.col(key).alias(name), F.coalesce(text, F.lit("")).cast("binary").alias("text"))

    pairs = texts(items, item_column, item_text_column, "item").mapInArrow(_item_terms, f"item {item_type}, term binary").distinct()
    pairs = saved(pairs, "item-terms")
    found = [
        _chunk_search(texts(docs, id_column, text_column, "id"), chunk, k, id_type, item_type, block_rows, block_postings)
        for chunk in _chunks(pairs, chunk_terms)
    ]
    merged = reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], f"item {item_type}, id {id_type}, score long")
    order = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    for group in (["item", F.pmod(F.xxhash64("id"), F.lit(64))], ["item"]):
        merged = merged.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)
    return merged.select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")


def _chunks(pairs: DataFrame, limit: int) -> Iterator[pa.Table]:
    """The (item, term) pairs in chunks of whole items with at most ``limit`` pairs, as far as items allow."""
    total, most = pairs.count(), 0
    sizes = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    if total:
        most = max(sizes.agg(F.max("n")).first()[0], limit)
    chunks = -(-total // limit)
    while chunks > 1 and sizes.groupBy(F.pmod(F.xxhash64("item"), F.lit(chunks)).alias("c")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] > most:
        chunks *= 2
    for chunk in range(chunks):
        table = pairs.where(F.pmod(F.xxhash64("item"), F.lit(chunks)) == chunk).orderBy("item", "term").toArrow()
        if table.num_rows:
            yield table


def _chunk_search(
    texts: DataFrame, chunk: pa.Table, k: int, id_type: str, item_type: str, block_rows: int, block_postings: int
) -> DataFrame:
    terms = chunk.column("term").combine_chunks().dictionary_encode()
    owners = chunk.column("item").combine_chunks().dictionary_encode(null_encoding="encode")
    vocabulary = {term: number for number, term in enumerate(terms.dictionary.to_pylist())}
    postings = texts.mapInArrow(lambda batches: _postings(batches, vocabulary), f"id {id_type}, n long, terms array<int>, counts array<long>")
    postings = saved(postings, "postings")
    documents, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        df[row["term"]] = row["df"]
    queries = _Queries(owners.dictionary, owners.indices.to_numpy(), terms.indices.to_numpy(), df, documents, length or 1, k)
    return postings.mapInArrow(lambda batches: _search(batches, queries, block_rows, block_postings), f"item {item_type}, id {id_type}, score long")

"""Ranked lexical search by two trees: node pairs whose bound is below the weakest k-th score are left out."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import rows_of, written

TOP = 10
#: Bytes of item texts that one pass over the documents serves; they bound what is broadcast.
PASS_BYTES = 16 << 20
#: Children of a tree node; documents of a block, a row of the index; most postings of a block of several documents.
FAN, BLOCK, POSTINGS = 16, 256, 32_768
#: Blocks per item that are searched first, for thresholds to start from.
FIRST_BLOCKS = 2
#: Sums of whole numbers below this are exact in doubles.
EXACT = 2**53
#: Upper end of a term's saturation: 10^9 tf div (10^3 tf + 8 m).
MOST_SATURATION = 1_000_000

_LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """ASCII letters and digits and all other characters above U+007F, in runs; A-Z lower-cased."""
    return (text or "").encode().translate(_LETTERS).split()


# ---- items


@dataclass
class Rows:
    """Sparse rows: the terms and weights of row i stand at starts[i] to starts[i + 1]."""

    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def maxima(self, fan: int = FAN) -> Rows:
        """One row per `fan` rows, with each term's largest weight."""
        n = -(-len(self) // fan)
        group = np.repeat(np.arange(len(self)) // fan, np.diff(self.starts))
        order = np.lexsort((self.terms, group))
        group, terms, weights = group[order], self.terms[order], self.weights[order]
        new = np.flatnonzero(np.append(True, (group[1:] != group[:-1]) | (terms[1:] != terms[:-1]))) if len(group) else np.zeros(0, int)
        most = np.maximum.reduceat(weights, new) if len(new) else weights
        return Rows(np.searchsorted(group[new], np.arange(n + 1)), terms[new], most)

    def dense(self, lo: int, hi: int, column: np.ndarray, width: int) -> np.ndarray:
        """Rows lo to hi over the terms that have a column."""
        a, b = self.starts[lo], self.starts[hi]
        at = column[self.terms[a:b]]
        row = np.repeat(np.arange(hi - lo), np.diff(self.starts[lo : hi + 1]))
        out = np.zeros((hi - lo, width), self.weights.dtype)
        out[row[at >= 0], at[at >= 0]] = self.weights[a:b][at >= 0]
        return out


@dataclass
class ItemTree:
    """Items, nodes of FAN items and nodes of FAN * FAN items, with the least score that still counts for each item."""

    item_ids: list[int | None]
    levels: list[Rows]
    least: np.ndarray
    vocabulary: int
    k: int

    def thresholds(self, least: np.ndarray, level: int) -> np.ndarray:
        """The weakest threshold among the items of each node."""
        return np.minimum.reduceat(least, np.arange(0, len(least), FAN**level))


def item_passes(items: DataFrame) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of the items, in lots of at most PASS_BYTES of text (or one item)."""
    lot, held = [], 0
    for item_id, text in items.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        size = len((text or "").encode())
        if lot and held + size > PASS_BYTES:
            yield lot
            lot, held = [], 0
        lot.append((item_id, list(dict.fromkeys(terms_of(text)))))
        held += size
    if lot:
        yield lot


def item_tree(lot: list[tuple[int | None, list[bytes]]], vocabulary: dict[bytes, int], df: np.ndarray, n_docs: int, k: int) -> ItemTree:
    """Items that share their commonest terms stand together, so that a node's maxima stay close to its items."""
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(f) + 1))) for f in df], np.int64)
    items = []
    for item_id, words in lot:
        terms = np.sort(np.array([vocabulary[w] for w in words], np.int64))
        common = terms[np.argsort(-df[terms], kind="stable")]
        items.append((tuple(common[:4].tolist()), item_id, terms))
    items.sort(key=lambda x: x[0])
    terms = np.concatenate([t for _, _, t in items])
    starts = np.append(0, np.cumsum([len(t) for _, _, t in items]))
    own = weights[terms]
    heaviest = max((int(own[a:b].sum()) for a, b in zip(starts, starts[1:])), default=0)
    rows = Rows(starts, terms, own.astype(np.float64) if heaviest * MOST_SATURATION < EXACT else own)
    levels = [rows, rows.maxima(), rows.maxima(FAN * FAN)]
    return ItemTree([i for _, i, _ in items], levels, np.ones(len(items)), len(vocabulary), k)


# ---- index


@contextmanager
def _sent(spark: SparkSession, value) -> Iterator[Broadcast]:
    """A broadcast value, removed from all machines once what reads it is written."""
    held = spark.sparkContext.broadcast(value)
    try:
        yield held
    finally:
        held.destroy()


def term_counts(docs: DataFrame, sent: Broadcast) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with at least one term: n of all terms, counts of those in the vocabulary sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for doc_ids, texts in rows_of(batches):
            out = []
            for doc_id, text in zip(doc_ids, texts, strict=True):
                words = terms_of(text)
                if words:
                    found = np.array([known[w] for w in words if w in known], np.int32)
                    out.append((doc_id, len(words), *np.unique(found, return_counts=True)))
            if out:
                ids, ns, terms, counts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), _lists(terms, np.int32), _lists(counts, np.int64)],
                    names=["doc_id", "n", "terms", "counts"],
                )

    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def _lists(arrays, kind) -> pa.ListArray:
    starts = np.append(0, np.cumsum([len(a) for a in arrays])).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(np.concatenate([np.asarray(a, kind) for a in arrays])))


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(starts, flat values) of a list column."""
    return column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)


def saturated(counts: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, terms, values, near, heavy): each term's saturation; the document's most repeated and most saturated rare term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, terms = _values(batch.column("terms"))
            _, tf = _values(batch.column("counts"))
            first, last = starts[0], starts[-1]
            terms, tf, starts = terms[first:last], tf[first:last], starts - first
            n = batch.column("n").to_numpy()
            owner = np.repeat(np.arange(len(n)), np.diff(starts))
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            values = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
            near = terms[np.lexsort((terms, -tf, owner))[starts[:-1]]]
            heavy = terms[np.lexsort((-terms, tf, owner))[starts[:-1]]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(terms)),
                    pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(values.astype(np.int32))),
                    pa.array(near.astype(np.int32)),
                    pa.array(heavy.astype(np.int32)),
                ],
                names=["doc_id", "terms", "values", "near", "heavy"],
            )

    some = counts.where(F.size("terms") > 0).select("doc_id", "n", "terms", "counts")
    return some.mapInArrow(run, "doc_id long, terms array<int>, values array<int>, near int, heavy int")


_BLOCKS = "block long, doc_ids array<long>, sizes array<int>, terms array<int>, values array<int>, top_terms array<int>, top_values array<int>"


def document_blocks(docs: DataFrame) -> DataFrame:
    """Similar documents in blocks, one row each, with the largest value of every term in the block."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["near", "heavy", "doc_id", "tie"]
    ranged = docs.withColumn("tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    narrow = ranged.select("doc_id", "terms", "values", F.spark_partition_id().alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def documents():
            for batch in batches:
                starts, terms = _values(batch.column("terms"))
                _, values = _values(batch.column("values"))
                for i, (doc_id, part) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(), strict=True)):
                    yield part, doc_id, terms[starts[i] : starts[i + 1]], values[starts[i] : starts[i + 1]]

        held, postings, number = [], 0, 0
        for document in documents():
            if held and (len(held) == BLOCK or postings + len(document[2]) > POSTINGS):
                yield block(held, number)
                held, postings, number = [], 0, number + 1
            held.append(document)
            postings += len(document[2])
        if held:
            yield block(held, number)

    def block(held: list[tuple], number: int) -> pa.RecordBatch:
        sizes = np.array([len(t) for _, _, t, _ in held])
        terms, values = np.concatenate([t for _, _, t, _ in held]), np.concatenate([v for _, _, _, v in held])
        top = Rows(np.append(0, np.cumsum(sizes)), terms, values).maxima(len(held))
        columns = ([d for _, d, _, _ in held], sizes, terms, values, top.terms, top.weights)
        types = (pa.int64(), *[pa.int32()] * 5)
        lists = [pa.array([c], pa.list_(t)) for c, t in zip(columns, types, strict=True)]
        names = ["block", "doc_ids", "sizes", "terms", "values", "top_terms", "top_values"]
        return pa.RecordBatch.from_arrays([pa.array([(held[0][0] << 32) + number], pa.int64()), *lists], names=names)

    return narrow.mapInArrow(run, _BLOCKS)


# ---- search


@dataclass
class Best:
    """The k best documents of each item that a task has seen, and the scores that others must reach."""

    tree: ItemTree
    least: np.ndarray = field(init=False)
    found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.least = self.tree.least.copy()

    def add(self, item: int, scores: np.ndarray, none: np.ndarray, ids: np.ndarray) -> None:
        if item in self.found:
            old = self.found[item]
            scores, none, ids = (np.concatenate(p) for p in zip(old, (scores, none, ids), strict=True))
        order = np.lexsort((ids, none, -scores))[: self.tree.k]
        self.found[item] = (scores[order], none[order], ids[order])
        if len(order) == self.tree.k:
            self.least[item] = max(self.least[item], scores[order[-1]])

    def rows(self) -> Iterator[tuple[int, int | None, int | None, int]]:
        for item, (scores, none, ids) in self.found.items():
            for s, no, i in zip(scores.tolist(), none.tolist(), ids.tolist()):
                yield item, self.tree.item_ids[item], None if no else i, int(s)


def search_block(tree: ItemTree, best: Best, ids: np.ndarray, none: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> int:
    """Descends both trees for one block of documents; returns how many pairs were scored.

    A node pair's bound is the inner product of two coordinate maxima, so no pair below it
    scores more. Pairs stay while the bound reaches the weakest threshold of the item node;
    equal scores stay too, since their order is by doc_id. Bounds are raised by a billionth,
    more than doubles can lose.
    """
    columns, at = np.unique(terms, return_inverse=True)
    width, n = len(columns), len(sizes)
    column = np.full(tree.vocabulary, -1, np.int32)
    column[columns] = np.arange(width)
    kind = tree.levels[0].weights.dtype
    docs = np.zeros((n, width), kind)
    docs[np.repeat(np.arange(n), sizes), at] = values
    nodes = np.maximum.reduceat(docs, np.arange(0, n, FAN), axis=0)
    whole = nodes.max(axis=0)

    def reached(level: int, lo: int, hi: int, weights: np.ndarray, below: np.ndarray) -> np.ndarray:
        bounds = (weights @ below.T).astype(np.float64) * (1 + 1e-9)
        return bounds >= tree.thresholds(best.least[lo * FAN**level : hi * FAN**level], level)[:, None]

    scored = 0
    top, middle, leaves = tree.levels[2], tree.levels[1], tree.levels[0]
    for group in range(0, len(top), FAN):
        upto = min(group + FAN, len(top))
        for big in group + np.flatnonzero(reached(2, group, upto, top.dense(group, upto, column, width), whole[None])):
            lo, hi = big * FAN, min((big + 1) * FAN, len(middle))
            open_ = reached(1, lo, hi, middle.dense(lo, hi, column, width), nodes)
            for batch in lo + np.flatnonzero(open_.any(axis=1)):
                first, last = batch * FAN, min((batch + 1) * FAN, len(leaves))
                weights = leaves.dense(first, last, column, width)
                pairs = reached(0, first, last, weights, nodes) & open_[batch - lo]
                items, which = np.flatnonzero(pairs.any(axis=1)), np.flatnonzero(pairs.any(axis=0))
                if not len(items):
                    continue
                rows = np.flatnonzero(np.isin(np.arange(n) // FAN, which))
                scores = weights[items] @ docs[rows].T
                scored += scores.size
                for item, of_item in zip((first + items).tolist(), scores):
                    good = np.flatnonzero(of_item >= best.least[item])
                    if len(good):
                        best.add(item, of_item[good], none[rows[good]], ids[rows[good]])
    return scored


_FOUND = "item int, item_id long, doc_id long, score long"


def _search(blocks: DataFrame, sent: Broadcast) -> DataFrame:
    """(item, item_id, doc_id, score): each task's best documents of every item of the tree sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(sent.value)
        for batch in batches:
            lists = [batch.column(c) for c in ("doc_ids", "sizes", "terms", "values")]
            for i in range(batch.num_rows):
                ids, *others = (c[i].values for c in lists)
                none = ids.is_null().to_numpy(zero_copy_only=False)
                search_block(best.tree, best, ids.fill_null(0).to_numpy(), none, *(o.to_numpy(zero_copy_only=False) for o in others))
        rows = list(best.rows())
        for i in range(0, len(rows), 10_000):
            columns = zip(*rows[i : i + 10_000], strict=True)
            types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "item_id", "doc_id", "score"])

    return blocks.select("doc_ids", "sizes", "terms", "values").mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by_item = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)


def first_blocks(blocks: DataFrame, sent: Broadcast, count: int = FIRST_BLOCKS) -> DataFrame:
    """(block): for each item of the tree sent the blocks with the highest bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = sent.value
        items, bounds, numbers = tree.levels[0], np.zeros((len(tree.levels[0]), 0)), np.zeros((len(tree.levels[0]), 0), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                terms, values = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("top_terms", "top_values"))
                value = np.zeros(tree.vocabulary)
                value[terms] = values
                sums = np.append(0, np.cumsum(value[items.terms] * items.weights))[items.starts]
                bounds = np.column_stack([bounds, np.diff(sums)])
                numbers = np.column_stack([numbers, np.full(len(items), batch.column("block")[i].as_py())])
                if bounds.shape[1] > 64:
                    bounds, numbers = _highest(bounds, numbers, count)
        bounds, numbers = _highest(bounds, numbers, count)
        item, at = np.nonzero(bounds > 0)
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [pa.array(item.astype(np.int32)), pa.array(numbers[item, at]), pa.array(bounds[item, at])], names=["item", "block", "bound"]
            )

    found = blocks.select("block", "top_terms", "top_values").mapInArrow(run, "item int, block long, bound double")
    order = Window.partitionBy("item").orderBy(F.col("bound").desc(), "block")
    return found.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= count).select("block").distinct()


def _highest(bounds: np.ndarray, numbers: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    at = np.argsort(-bounds, axis=1, kind="stable")[:, :count]
    return np.take_along_axis(bounds, at, 1), np.take_along_axis(numbers, at, 1)


_RANKED = "item_id long, rank int, doc_id long, score long"


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, with scores above 0.

    Each row of items and of docs stands for itself, whether ids repeat or are null; a null id
    of a document comes after all others of its score. Texts that are null, empty or without
    terms take no part. Only doc_id and text, and item_id and text, are read. Items go in lots
    of a bounded size, each with an index over all documents of its own: the counts of its
    terms, in blocks of similar documents. For each item the blocks with the highest bounds
    are searched first; the k-th scores found there are the thresholds of the search in all.
    """
    spark: SparkSession = docs.sparkSession
    out = []
    for lot in item_passes(items):
        vocabulary = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(words for _, words in lot)))}
        if not vocabulary:
            continue
        with _sent(spark, vocabulary) as sent:
            counts = written(term_counts(docs, sent), "lexical-counts")
        n_docs, n_terms = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for term, number in counts.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
            df[term] = number
        tree = item_tree(lot, vocabulary, df, n_docs, k)
        blocks = written(document_blocks(saturated(counts, n_docs, n_terms)), "lexical-blocks")
        with _sent(spark, tree) as sent:
            first = blocks.join(F.broadcast(first_blocks(blocks, sent)), "block")
            weakest = _ranked(_search(first, sent), k).where(F.col("rank") == k).select("item", "score").toLocalIterator()
            for item, score in weakest:
                tree.least[item] = score
        with _sent(spark, tree) as sent:
            ranked = _ranked(_search(blocks, sent), k).select("item_id", "rank", "doc_id", "score")
            out.append(written(ranked, "lexical-ranks"))
    if not out:
        return spark.createDataFrame([], _RANKED)
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found


RANKED_SQL = rf"""
WITH both_tables AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), terms AS (
  SELECT kind, id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM both_tables
), counts AS (
  SELECT kind, id, term, count(*) AS tf FROM terms GROUP BY kind, id, term
), sizes AS (
  SELECT id AS doc_id, sum(tf)::BIGINT AS n FROM counts WHERE kind = 0 GROUP BY id
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, corpus WHERE kind = 0 GROUP BY term
), lengths AS (
  SELECT doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM sizes, corpus
), scores AS (
  SELECT i.id AS item_id, d.id AS doc_id, sum(w * ((1000000000 * d.tf) // (1000 * d.tf + 8 * m)))::BIGINT AS score
  FROM counts i JOIN counts d ON i.kind = 1 AND d.kind = 0 AND i.term = d.term JOIN weights w ON w.term = d.term JOIN lengths l ON l.doc_id = d.id
  GROUP BY i.id, d.id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {TOP}
"""

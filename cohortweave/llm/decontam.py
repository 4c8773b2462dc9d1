"""Benchmark decontamination: size-partitioned MinHash containment, verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import SHINGLE, WordHashes, mix, shingle_hashes, written

#: Part of an item's distinct shingles that a document must hold.
CONTAINMENT = 0.8
#: MinHash registers. An item of more than w/2 and at most w shingles, four fifths of them in
#: a stretch of 2w, has a Jaccard similarity of 0.19 or more to it: all 64 registers differ
#: once in 700,000 times.
REGISTERS = 64
#: Items of at most so many shingles are looked up by each of their shingles: four fifths of
#: them are one at least, and the bound above needs longer stretches.
FEW_SHINGLES = 8
#: Shingles of the items that are searched for in one pass over the documents.
BLOCK_SHINGLES = 1_000_000

_SEEDS = mix(np.arange(REGISTERS, dtype=np.uint64), 23)
_TABLE_BITS = 22


def _registers(shingles: np.ndarray) -> np.ndarray:
    """The MinHash of a stretch of shingles. A register is a hash, so it names its shingle."""
    return np.min([mix(part[:, None] ^ _SEEDS).min(0) for part in np.array_split(shingles, len(shingles) // 20_000 + 1)], 0)


class ItemBlock:
    """Items by size class with their sketches, and the exact shingles of each."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        words = WordHashes()
        self.ids = [i for i, _ in items]
        texts = [words.of(t) for _, t in items]
        self.sizes = [len(t) for t in texts]
        self.shingles = [np.unique(shingle_hashes(t)) for t in texts]
        self.classes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        by_class: dict[int, list[int]] = {}
        few: list[int] = []
        held, widths = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for k, own in enumerate(self.shingles):
            if self.sizes[k] < SHINGLE:
                continue
            width = 1 << int(len(own) - 1).bit_length() if len(own) > FEW_SHINGLES else 1
            if width > 1:
                by_class.setdefault(width, []).append(k)
            else:
                few.append(k)
            self.table[self._cell(own)] = True
            held.append(own)
            widths.append(np.full(len(own), width))
        #: The shingles of these items, and the widths of the classes that hold each (1: few), as bits.
        self.known, at = np.unique(np.concatenate(held), return_inverse=True)
        self.widths = np.zeros(len(self.known), np.int64)
        np.bitwise_or.at(self.widths, at, np.concatenate(widths))
        values = np.concatenate([np.empty(0, np.uint64), *(self.shingles[k] for k in few)])
        order = np.argsort(values, kind="stable")
        #: Items of fewer words than a shingle has: their one shingle, by their number of words.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in range(1, SHINGLE):
            own = [(int(self.shingles[k][0]), k) for k in range(len(items)) if self.sizes[k] == size]
            if own:
                self.short[size] = np.array([h for h, _ in sorted(own)], np.uint64), np.array([k for _, k in sorted(own)])
        self.few = values[order], np.repeat(few, [len(self.shingles[k]) for k in few]).astype(np.int64)[order]
        for width, members in by_class.items():
            sketches = np.stack([_registers(self.shingles[k]) for k in members])
            values = (sketches ^ _SEEDS).ravel()  # registers of different hashes do not meet
            order = np.argsort(values, kind="stable")
            self.classes[width] = values[order], np.repeat(members, REGISTERS)[order]

    @staticmethod
    def _cell(shingles: np.ndarray) -> np.ndarray:
        return (shingles & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)

    def found(self, words: np.ndarray, containment: float) -> list[tuple[int, int, int]]:
        """(item, its shingles, those in the document) for the items that the document of these words contains.

        Items of fewer words than a shingle has are looked for among the document's runs of as
        many words. Items of few shingles are candidates if the document holds one of them. For each size
        class of the others the document is cut to stretches of twice the class width that
        overlap by half; a stretch without any shingle of an item of the class (a bit table and
        the sorted shingles tell) has no register in common with one and is passed over.
        """
        out = []
        for size, (values, owners) in self.short.items():
            if len(words) >= size:
                runs = np.unique(shingle_hashes(words, size))
                low, high = (np.searchsorted(values, runs, side) for side in ("left", "right"))
                for a, b in zip(low[high > low].tolist(), high[high > low].tolist()):
                    out += [(int(k), 1, 1) for k in owners[a:b]]
        shingles = shingle_hashes(words)
        hits = np.flatnonzero(self.table[self._cell(shingles)])
        if len(hits):  # other shingles share the cells
            at = np.minimum(np.searchsorted(self.known, shingles[hits]), len(self.known) - 1)
            own = self.known[at] == shingles[hits]
            hits, widths = hits[own], self.widths[at[own]]
        if not len(hits):
            return out
        values, owners = self.few
        low, high = (np.searchsorted(values, shingles[hits], side) for side in ("left", "right"))
        candidates: set[int] = set()
        for a, b in set(zip(low[high > low].tolist(), high[high > low].tolist())):
            candidates.update(owners[a:b].tolist())
        for width, (values, owners) in self.classes.items():
            blocks = hits[widths & width > 0] // width
            for b in np.unique(np.r_[blocks, np.maximum(blocks - 1, 0)]):
                mine = _registers(shingles[b * width : (b + 2) * width]) ^ _SEEDS
                low, high = np.searchsorted(values, mine, "left"), np.searchsorted(values, mine, "right")
                for i in np.flatnonzero(high > low):
                    candidates.update(owners[low[i] : high[i]].tolist())
        if not candidates:
            return out
        own = np.unique(shingles)
        for k in sorted(candidates):
            shared = int(np.isin(self.shingles[k], own, assume_unique=True).sum())
            if shared >= containment * len(self.shingles[k]):
                out.append((k, len(self.shingles[k]), shared))
        return out


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark in blocks of at most BLOCK_SHINGLES words (or one item)."""
    block, held = [], 0
    for item_id, text in benchmark.select(F.col("item_id").cast("long"), "text").toLocalIterator():
        words = len((text or "").split())
        if block and held + words > BLOCK_SHINGLES:
            yield block
            block, held = [], 0
        block.append((item_id, text))
        held += words
    if block:
        yield block


_MATCHES = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"


def contaminated(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment) of every item that a document contains.

    Shingles are five lower-cased words between ASCII white space, each counted once. An item
    of fewer words is one shingle of all of them and is contained in a document that has these
    words in a row; items or documents without words take no part. Each row of docs
    and of benchmark is judged on its own, whether ids repeat or are null. The benchmark goes
    to the tasks in blocks of a bounded size, each with a pass of its own over docs.
    """
    spark = docs.sparkSession
    parts = []
    for block in item_blocks(benchmark):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, words = ItemBlock(sent.value), WordHashes()
            for batch in batches:
                out = ([], [], [], [], [])
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for k, n, shared in items.found(words.of(text), containment):
                        for column, value in zip(out, (doc_id, items.ids[k], n, shared, shared / n), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in out[:4]), pa.array(out[4], pa.float64())],
                    names=["doc_id", "item_id", "n_shingles", "n_shared", "containment"],
                )

        parts.append(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _MATCHES))
    if len(parts) > 1:  # one pass at a time
        parts = [written(p, "contaminated") for p in parts]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], _MATCHES)


def decontaminate(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of docs that contain no item of the benchmark (see `contaminated`), unchanged."""
    for block in item_blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items, words = ItemBlock(sent.value), WordHashes()
            for batch in batches:
                clean = [not items.found(words.of(t), containment) for t in batch.column("text").to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


CONTAMINATED_SQL = f"""
WITH both_tables AS (
  SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\\x20\\x09-\\x0D]+'), lambda w : w <> '') AS w
  FROM both_tables
), lengths AS (
  SELECT DISTINCT least(len(w), {SHINGLE}) AS k FROM words WHERE kind = 1 AND len(w) > 0
), shingles AS (
  SELECT DISTINCT kind, id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS s, k
  FROM words JOIN lengths ON len(w) >= k AND (kind = 0 OR k = least(len(w), {SHINGLE})), range(1, len(w) - k + 2) AS r(i)
), sizes AS (
  SELECT id AS item_id, count(*) AS n_shingles FROM shingles WHERE kind = 1 GROUP BY id
), shared AS (
  SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared
  FROM shingles d JOIN shingles b ON d.kind = 0 AND b.kind = 1 AND d.s = b.s AND d.k = b.k GROUP BY d.id, b.id
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment
FROM shared JOIN sizes USING (item_id) WHERE n_shared >= {CONTAINMENT} * n_shingles
"""

"""Reversible line dedup: sharded cuckoo filters backed by exact reference counts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm.common import rows_of, unused, written
from cohortweave.llm.cuckoo import CuckooFilter
from cohortweave.session import shared_path

#: Shortest key, in code points, that counts as a repeat; least documents that hold it.
MIN_CHARS = 20
MIN_DOCS = 3
#: Least shards of the key space, and keys of a shard: a filter of 4 to 8 MB.
SHARDS, SHARD_KEYS = 64, 1_000_000
#: Filters that are sent to the tasks at a time.
FILTER_BYTES = 64 << 20

_REFS = "key binary, n_docs long, max_doc long"


def line_key(line: str) -> bytes:
    """The line in UTF-8 without ASCII white space at its ends, A-Z in lower case."""
    return line.encode().strip(b" \t\n\x0b\x0c\r").lower()


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _hash(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64)[::2]


def _counts_as_repeat(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)


_KEYS = "doc_id long, key binary"


def _keys_in(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, key) of batches of (doc_id, text); see `line_keys`."""
    for doc_ids, texts in rows_of(batches):
        ids, keys = [], []
        for doc_id, text in zip(doc_ids, texts, strict=True):
            own = {_digest(k) for k in map(line_key, (text or "").split("\n")) if _counts_as_repeat(k, min_chars)}
            keys.extend(own)
            ids.extend([doc_id] * len(own))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], names=["doc_id", "key"])


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, key): the distinct long-enough line keys of every row of docs, as 16-byte digests."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda batches: _keys_in(batches, min_chars), _KEYS)


def _maybe_held(rows: DataFrame, filters: DataFrame, shards: int, min_chars: int | None = None) -> DataFrame:
    """The keys (doc_id, key) that the filters (shard, filter) of their shards may hold.

    With `min_chars` rows are documents, whose line keys are made in the same task: two Python
    steps in a row would hold two workers per task.
    """
    sent = rows.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["filter"]) for r in filters.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {s: CuckooFilter.of_bytes(b) for s, b in sent.value.items()}
        for batch in batches if min_chars is None else _keys_in(batches, min_chars):
            own = batch.column("key").to_pylist()
            maybe = np.zeros(len(own), bool)
            if own:
                hashes = _hash(own)
                shard = (hashes % np.uint64(shards)).astype(np.int64)
                for s in np.unique(shard):
                    if s in held:
                        maybe[shard == s] = held[s].contains(hashes[shard == s])
            yield batch.select(["doc_id", "key"]).filter(pa.array(maybe))

    return rows.select(F.col("doc_id").cast("long"), "key" if min_chars is None else "text").mapInArrow(run, _KEYS)


def document_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """`line_keys`, each key once for every doc_id: rows that share an id are one document, those without are each their own."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    again = written(ids.where(F.col("id").isNotNull()).groupBy("id").count().where("count > 1").select("id"), "repeated-ids")
    if not again.take(1):
        return line_keys(docs, min_chars)
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    one, several = (narrow.join(again, F.col("doc_id") == F.col("id"), how) for how in ("left_anti", "left_semi"))
    return line_keys(one, min_chars).unionByName(line_keys(several, min_chars).distinct())


def _counted(keys: DataFrame) -> DataFrame:
    return keys.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("max_doc"))


def _shard(shards: int) -> Column:
    """The shard of a key: its first bytes, little-endian, modulo the shards, a power of two up to 2 ** 24."""
    byte = [F.conv(F.hex(F.substring("key", i, 1)), 16, 10).cast("int") for i in (1, 2, 3)]
    return F.pmod(byte[0] + byte[1] * 256 + byte[2] * 65536, F.lit(shards))


@dataclass
class LineState:
    """What is known of the lines of all documents inserted so far.

    refs: exact reference counts (key, n_docs, max_doc), a written table.
    filters: (shard, filter), one cuckoo filter per shard over the keys that `min_docs`
    documents or more hold; `shards` grow with these keys, so that one task builds a filter
    of about SHARD_KEYS at most.
    """

    refs: DataFrame
    filters: DataFrame
    min_chars: int = MIN_CHARS
    min_docs: int = MIN_DOCS
    shards: int = SHARDS

    @classmethod
    def empty(cls, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> LineState:
        return cls(spark.createDataFrame([], _REFS), spark.createDataFrame([], "shard int, filter binary"), min_chars, min_docs)

    def _with(self, refs: DataFrame, before: DataFrame | None) -> LineState:
        """The state over new counts. Filters change by the keys whose standing changed."""
        refs = written(refs, "line-refs")
        now, shards = refs.where(F.col("n_docs") >= self.min_docs), self.shards
        if before is None:
            changes = now.select("key", F.lit(1).alias("step"))
            shards = SHARDS
            keys = now.count()
            while shards * SHARD_KEYS < keys and shards < 1 << 24:
                shards *= 2
        else:
            was = before.where(F.col("n_docs") >= self.min_docs)
            changes = now.join(was, "key", "left_anti").select("key", F.lit(1).alias("step")).unionByName(
                was.join(now, "key", "left_anti").select("key", F.lit(-1).alias("step"))
            )
        changes = changes.withColumn("shard", _shard(shards))

        def update(key, old: pd.DataFrame, steps: pd.DataFrame) -> pd.DataFrame:
            hashes, step = _hash(list(steps["key"])), steps["step"].to_numpy()
            added = hashes[step > 0] if len(steps) else hashes
            if len(old):
                kept = CuckooFilter.of_bytes(old["filter"].iloc[0])
                if len(steps):
                    kept.delete(hashes[step < 0])
                if not kept.insert(added):
                    return pd.DataFrame({"shard": [key[0]], "filter": [None]})
            else:
                kept = CuckooFilter.build(added, 2 * len(added))
            return pd.DataFrame({"shard": [key[0]], "filter": [kept.to_bytes()]})

        if before is None:
            filters = changes.groupBy("shard").applyInPandas(
                lambda key, steps: update(key, steps.iloc[:0], steps), "shard int, filter binary"
            )
        else:
            filters = self.filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(update, "shard int, filter binary")
        filters = written(filters, "line-filters")
        if filters.where(F.col("filter").isNull()).take(1):  # a filter is full: build them with more room
            return self._with(refs, None)
        return LineState(refs, filters, self.min_chars, self.min_docs, shards)

    def insert(self, docs: DataFrame) -> LineState:
        """The state with the lines of more documents, none of which is in it yet.

        Rows of docs that share a doc_id are one document; each row without one is its own.
        """
        new = _counted(document_keys(docs, self.min_chars))
        if not self.refs.take(1):
            return self._with(new, None)
        both = self.refs.unionByName(new).groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("max_doc").alias("max_doc"))
        return self._with(both, self.refs)

    def delete(self, docs: DataFrame, remaining: DataFrame) -> LineState:
        """The state without some inserted documents; `remaining` are the documents that stay.

        Counts go down by what the documents held. Where the largest holder leaves, the next
        one is looked up among the remaining documents' lines.
        """
        gone = _counted(document_keys(docs, self.min_chars)).select("key", F.col("n_docs").alias("less"), F.col("max_doc").alias("left_doc"))
        touched = self.refs.join(gone, "key", "left")
        orphaned = touched.where((F.col("left_doc") == F.col("max_doc")) & (F.col("n_docs") > F.col("less"))).select("key")
        heirs = line_keys(remaining, self.min_chars).join(orphaned, "key", "left_semi").groupBy("key").agg(F.max("doc_id").alias("heir"))
        after = (
            touched.join(heirs, "key", "left")
            .select(
                "key",
                (F.col("n_docs") - F.coalesce("less", F.lit(0))).alias("n_docs"),
                F.when(F.col("left_doc") == F.col("max_doc"), F.col("heir")).otherwise(F.col("max_doc")).alias("max_doc"),
            )
            .where(F.col("n_docs") > 0)
        )
        return self._with(after, self.refs)

    def rebuild(self) -> LineState:
        """The same counts with filters built anew, with room for as many keys again."""
        return self._with(self.refs, None)

    def repeated_lines(self, docs: DataFrame) -> DataFrame:
        """(doc_id, key) of the lines to drop: repeated, and the document is not their largest holder.

        The filters pass the lines that may be repeated; the reference counts decide. Filters
        go to the tasks in lots of at most FILTER_BYTES (or one filter). Where there are several
        lots, lines are taken from the texts once and written by lot, so each is tested once.
        """
        sizes = self.filters.select("shard", F.length("filter").alias("n")).orderBy("shard").toLocalIterator()
        lots, held = [[]], 0
        for shard, n in sizes:
            if lots[-1] and held + n > FILTER_BYTES:
                lots.append([])
                held = 0
            lots[-1].append(shard)
            held += n
        if len(lots) == 1:
            maybe = _maybe_held(docs, self.filters, self.shards, self.min_chars)
        else:
            last = F.array(*[F.lit(lot[-1]) for lot in lots])
            lot_of = F.size(F.filter(last, lambda upto: upto < F.col("shard")))
            keys = line_keys(docs, self.min_chars).withColumn("shard", _shard(self.shards)).withColumn("lot", lot_of)
            path = shared_path(keys.sparkSession, "lines-by-lot")
            keys.write.partitionBy("lot").parquet(path)
            dealt = keys.sparkSession.read.schema(keys.schema).parquet(path)
            parts = []
            for i, lot in enumerate(lots):
                filters = self.filters.where(F.col("shard").between(lot[0], lot[-1]))
                parts.append(written(_maybe_held(dealt.where(F.col("lot") == i), filters, self.shards), "maybe-repeated"))
            maybe = reduce(DataFrame.unionByName, parts)
        repeated = self.refs.where(F.col("n_docs") >= self.min_docs).select("key", "max_doc")
        return (
            maybe.join(repeated, "key")
            .where(F.col("max_doc").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") < F.col("max_doc"))))
            .select("doc_id", "key")
        )

    def apply(self, docs: DataFrame) -> DataFrame:
        """docs without their repeated lines: `text` is what is left, and n_lines, n_dropped, kept_sha256 join it.

        A null text counts as one empty line. Rows with the same doc_id share what is dropped:
        a key repeats the same way in all of them. Rows with a null doc_id lose repeated lines
        to any document with an id. Other columns of docs stay, whatever their names, but for
        the three added ones, which must be free.
        """
        own, gone = unused("_doc", docs.columns), unused("_drop", docs.columns)
        drops = (
            self.repeated_lines(docs)
            .groupBy(F.col("doc_id").alias(own))
            .agg(F.collect_set("key").alias(gone))
        )
        joined = docs.join(drops, F.col("doc_id").cast("long").eqNullSafe(F.col(own)), "left").drop(own)
        added = T.StructType().add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
        schema = T.StructType([*docs.schema.fields, *added.fields])
        columns = docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_lines, n_dropped, shas, texts = [], [], [], []
                for text, drop in zip(batch.column("text").to_pylist(), batch.column(gone).to_pylist(), strict=True):
                    lines = (text or "").split("\n")
                    kept = lines
                    if drop:
                        dropped = set(drop)
                        kept = [x for x in lines if _digest(line_key(x)) not in dropped]
                    left = "\n".join(kept)
                    texts.append(text if len(kept) == len(lines) else left)
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                    shas.append(hashlib.sha256(left.encode()).hexdigest())
                arrays = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(shas, pa.string())],
                    names=[*columns, "n_lines", "n_dropped", "kept_sha256"],
                )

        return joined.mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All of docs as one collection: inserted into an empty state, which is then applied."""
    return LineState.empty(docs.sparkSession, min_chars, min_docs).insert(docs).apply(docs)


DEDUP_SQL = """
WITH lines AS (
  SELECT doc_id, pos, list_extract(string_split(coalesce(text, ''), chr(10)), pos) AS line
  FROM documents, range(1, 1 + len(string_split(coalesce(text, ''), chr(10)))) AS r(pos)
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS dropped FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

"""Long repeats across documents by recompression: runs and pairs of tokens get global names."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import WordHashes, factors, mix, written
from cohortweave.session import drop_dead_shuffles, stage_tables

#: Words of a window: a repeat of at least this many words is removed.
WINDOW = 13
#: Rounds of pair naming. A symbol of a later round hangs on more than a window of words.
ROUNDS = 3
#: Words that are parsed together in a task.
WORDS_AT_ONCE = 200_000

_MARK = np.uint64(0x5851F42D4C957F2D)  # stands between documents
_ONE = np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def anchors(words: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor symbol of every window of a word sequence: one per window start.

    Recompression: a maximal run of one word becomes a symbol named by (word, length); then,
    round by round, a bit of each symbol's name makes it left or right, and every left symbol
    followed by a right one becomes a symbol named by the pair. Names are hashes, so equal
    strings get equal names in every task without a table of names. What a symbol hangs on is
    tracked as a range of words: its own and those of the neighbours that decided its making.
    A symbol whose range lies inside a window is there in every occurrence of the window, and
    so are the words of the range, which a hash of them names. Of a window's symbols of two
    words or more (or else of all) that with the greatest hash is the window's anchor. A
    window without any, such as part of a long run, is its own anchor.

    Documents may stand in one sequence with marks between and around them; windows over a
    mark have no meaning.
    """
    n = len(words)
    best = np.zeros((window + 1, n), np.uint64)  # by width of the range and its first word
    # sums of words times powers of an odd base; the inverse powers shift a range to the front
    sums = np.r_[np.uint64(0), np.cumsum(words * np.multiply.accumulate(np.r_[_ONE, np.full(max(0, n - 1), _BASE)])[:n])]
    shift = np.multiply.accumulate(np.r_[_ONE, np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))])

    def offer(span: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        fits = (high - low <= window) & (low >= 0) & (high <= n)
        span, low, high = span[fits], low[fits], high[fits]
        key = mix((sums[high] - sums[low]) * shift[low] ^ mix((high - low).astype(np.uint64), 8), 9)
        key = (key >> np.uint64(1)) | ((span > 1).astype(np.uint64) << np.uint64(63))
        best[high - low, low] = key  # one range, one name; later symbols are of two words or more

    starts = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    ends = np.r_[starts[1:], n]
    length = ends - starts
    name = np.where(length > 1, mix(words[starts] ^ mix(length.astype(np.uint64), 3), 5), words[starts])
    low, high = np.r_[-1, starts[1:] - 1], np.r_[ends[:-1] + 1, n + 1]
    offer(ends - starts, low, high)
    for turn in range(ROUNDS):
        if len(name) < 2:
            break
        right = (mix(name, 40 + turn) & _ONE).astype(bool)
        joins = np.flatnonzero(~right[:-1] & right[1:])
        made = mix(name[joins] * np.uint64(0x9E3779B97F4A7C15) + mix(name[joins + 1], 6), 50)
        # who stays alone knows so from the neighbour that it did not join
        before, after = np.r_[-1, low[:-1]], np.r_[high[1:], n + 1]
        new_low, new_high = np.where(right, np.minimum(low, before), low), np.where(right, high, np.maximum(high, after))
        new_low[joins], new_high[joins] = low[joins], high[joins + 1]
        name, ends = name.copy(), ends.copy()
        name[joins], ends[joins] = made, ends[joins + 1]
        offer(ends[joins] - starts[joins], low[joins], high[joins + 1])
        keep = np.ones(len(name), bool)
        keep[joins + 1] = False
        name, starts, ends, low, high = name[keep], starts[keep], ends[keep], new_low[keep], new_high[keep]
    held = best[1].copy()
    for width in range(2, window + 1):
        np.maximum(held[:-1], held[1:], out=held[:-1])
        np.maximum(held, best[width], out=held)
    held = held[: max(0, n - window + 1)]
    alone = np.flatnonzero(held == 0)
    if len(alone):
        held[alone] = window_names(words, window, 1)[alone]
    return held


def window_names(words: np.ndarray, window: int, seed: int) -> np.ndarray:
    """A hash of each window's words."""
    n = len(words) - window + 1
    total, times = np.zeros(max(0, n), np.uint64), factors(window, seed)
    for i in range(window if n > 0 else 0):
        total += words[i : i + n] * times[i]
    return mix(total, seed)


def parsed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, digest, n_words, whole_sha256, anchors) of every row of docs, anchors distinct.

    digest names the sequence of words, whole_sha256 the words joined by one space.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            sequences, shas = [], []
            for text in batch.column(1).to_pylist():
                own = (text or "").encode().split()
                sequences.append(np.fromiter(map(words.__getitem__, own), np.uint64, len(own)))
                shas.append(hashlib.sha256(b" ".join(own)).hexdigest())
            found, group, size = [], [], 0
            for k, sequence in enumerate(sequences):
                group.append(sequence)
                size += len(sequence)
                if size > WORDS_AT_ONCE or k == len(sequences) - 1:
                    found += _anchors_of(group, window)
                    group, size = [], 0
            offsets = np.cumsum([0, *map(len, found)])
            flat = np.concatenate(found or [np.zeros(0, np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sequences], pa.binary()),
                    pa.array([len(s) for s in sequences], pa.int64()),
                    pa.array(shas, pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                ],
                names=["doc_id", "digest", "n_words", "whole_sha256", "anchors"],
            )

    schema = "doc_id long, digest binary, n_words long, whole_sha256 string, anchors array<long>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def _marked(sequences: list[np.ndarray]) -> np.ndarray:
    """The documents as one sequence with marks between and around them."""
    return np.concatenate([x for s in sequences for x in ([_MARK], s)] + [[_MARK]]).astype(np.uint64)


def _anchors_of(sequences: list[np.ndarray], window: int) -> list[np.ndarray]:
    """The distinct anchors of each of several documents, parsed as one sequence."""
    held, start, out = anchors(_marked(sequences), window), 1, []
    for s in sequences:
        own = held[start : start + max(0, len(s) - window + 1)]
        out.append(np.unique(own[np.r_[True, own[1:] != own[:-1]]]) if len(own) else own)
        start += len(s) + 1
    return out


def _windows_of(group: list[tuple[int, np.ndarray, np.ndarray]], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, name, check) of the distinct windows of several documents whose anchor is in their list.

    A document is its id, its words (a window at least) and its list. All are parsed as one sequence.
    """
    marked = _marked([own for _, own, _ in group])
    held, every = anchors(marked, window), window_names(marked, window, 1)
    start, ids, names, at = 1, [], [], []
    for doc_id, own, wanted in group:
        hit = start + np.flatnonzero(np.isin(held[start : start + len(own) - window + 1], wanted))
        name, first = np.unique(every[hit], return_index=True)
        ids.append(np.full(len(name), doc_id, np.int64))
        names.append(name)
        at.append(hit[first])
        start += len(own) + 1
    return np.concatenate(ids), np.concatenate(names), window_names(marked, window, 2)[np.concatenate(at)]


def repeated_windows(docs: DataFrame, shared: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, name, check) of the windows whose anchor is one of the document's `_anchors` in `shared`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            doc_ids, column = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2)
            flat, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            group, size = [], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = words.of(text, lower=False)
                if len(own) >= window:
                    group.append((doc_ids[i], own, flat[offsets[i] : offsets[i + 1]]))
                    size += len(own)
                if group and (size > WORDS_AT_ONCE or i == batch.num_rows - 1):
                    doc, name, check = (x.view(np.int64) for x in _windows_of(group, window))
                    short = (check >> 32).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(name), pa.array(short)], names=["doc_id", "name", "check"])
                    group, size = [], 0

    joined = docs.join(shared, docs["doc_id"] == shared["_doc"]).select("doc_id", "text", "_anchors")
    return joined.mapInArrow(run, "doc_id long, name long, check int")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) of every row of docs.

    Words are the parts of the text between ASCII white space. A word goes if it is in a
    window of 13 consecutive words that also starts in a document with a smaller doc_id,
    judged on the input. kept (only `with_text`): the words left, joined by one space, where
    any were removed and some are left; else null (nothing removed: the text's own words; all
    removed: none).

    A document whose words all equal those of a smaller doc_id goes as a whole. Among the
    others, anchors that two documents share lead to windows, which are compared by names of
    96 bits. A null text has no words. Rows with a null doc_id neither lose words nor take them
    from others. Rows of one doc_id do not count against each other. Fewer words than a window
    make none. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    spark = docs.sparkSession
    with stage_tables(spark) as stage:  # the anchors go once the shared ones are known
        table = written(parsed(texts, window), "parsed")
        able = table.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
        firsts = stage.keep(written(able.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts"))
        lead = able.join(firsts, "digest").where(F.col("doc_id") == F.col("first")).select("doc_id", F.explode("anchors").alias("anchor"))
        common = lead.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
        shared = lead.join(common, "anchor").groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("anchor").alias("_anchors"))
        shared = stage.keep(written(shared, "shared-anchors"))
        table = stage.keep(written(table.drop("anchors"), "documents"))
    drop_dead_shuffles(spark)
    with stage_tables(spark) as stage:
        windows = written(repeated_windows(texts, shared, window), "windows")
        drop_dead_shuffles(spark)
        source = windows.groupBy("name", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
        gone = (
            windows.join(source.select("name", "check", "low"), ["name", "check"])
            .where("doc_id > low")
            .groupBy(F.col("doc_id").alias("_doc"))
            .agg(F.collect_set("name").alias("_gone"))
        )
        gone = written(gone, "gone")
        drop_dead_shuffles(spark)
        cut = _without(texts, gone, window)
        cut = stage.keep(written(cut if with_text else cut.withColumn("kept", F.lit(None).cast("string")), "cut"))
    drop_dead_shuffles(spark)
    empty = hashlib.sha256(b"").hexdigest()
    copy = F.col("first").isNotNull() & (F.col("doc_id") > F.col("first"))
    named = cut.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "n_removed", "kept", F.col("kept_sha256").alias("_sha")).distinct()
    whole = table.join(firsts, "digest", "left")
    result = whole.join(named, (whole["doc_id"] == named["_doc"]) & (whole["digest"] == named["_digest"]), "left").select(
        "doc_id",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(~F.coalesce(copy, F.lit(False)), F.col("kept")).alias("kept"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("_sha", "whole_sha256")).alias("kept_sha256"),
    )
    return result if with_text else result.drop("kept")


def _without(texts: DataFrame, gone: DataFrame, window: int) -> DataFrame:
    """(doc_id, digest, n_removed, kept, kept_sha256) of the documents that have windows to lose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            out = ([], [], [], [], [])
            column = batch.column(2)
            flat, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            for i, (doc_id, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                words = (text or "").encode().split()
                own = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
                hit = np.isin(window_names(own, window, 1), flat[offsets[i] : offsets[i + 1]])
                edges = np.zeros(len(words) + 1, np.int64)
                starts = np.flatnonzero(hit)
                np.add.at(edges, starts, 1)
                np.add.at(edges, starts + window, -1)
                covered = np.cumsum(edges[:-1]) > 0
                kept = b" ".join(words[j] for j in np.flatnonzero(~covered))
                digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                for c, v in zip(out, (doc_id, digest, int(covered.sum()), kept.decode(), hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            types = (pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["doc_id", "digest", "n_removed", "kept", "kept_sha256"]
            )

    joined = texts.join(gone, texts["doc_id"] == gone["_doc"]).select("doc_id", "text", "_gone")
    return joined.mapInArrow(run, "doc_id long, digest binary, n_removed long, kept string, kept_sha256 string")

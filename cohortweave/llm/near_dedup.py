"""Near-duplicate detection by ProbMinHash, banding and verification."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.common import WordHashes, mix, shingle_hashes, unused, written
from cohortweave.llm.components import components

SIMILARITY = 0.8
#: 30 bands of 5 registers: a pair of similarity 0.8 shares no band once in 150,000 times.
BANDS, ROWS = 30, 5
REGISTERS = BANDS * ROWS
#: Cells in which shingles are counted to tell rare ones apart; their counts are a broadcast.
CELLS = 1 << 20
#: Classes of a document's shingles whose sizes bound what two documents can share.
CLASSES = 32
#: Room for rounding where a bound is compared with the similarity.
SLACK = 1e-9
#: Words whose signatures are computed together in a task.
WORDS_AT_ONCE = 200_000


def weighted_shingles(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a document and how often it holds each."""
    return np.unique(shingle_hashes(words), return_counts=True)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The sum over common elements i of 1 / sum over j of max(a_j / a_i, b_j / b_i).

    The inner sum depends on the ratio a_i / b_i alone, so it is computed once per ratio.
    """
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(at):
        return 0.0
    x, y = a[1].astype(float), b[1].astype(float)
    only_x, only_y = x.sum() - x[at].sum(), y.sum() - y[bt].sum()
    ratio = x[at] / y[bt]
    return float(sum(x[at][ratio == r].sum() / (np.maximum(x[at], r * y[bt]).sum() + only_x + r * only_y) for r in np.unique(ratio)))


def signatures(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash of n_docs weighted sets: the element of the first arrival in each register.

    Every element sends arrivals to random registers at a rate of its weight (a Poisson
    process seeded by the element). An element stops once its next arrival is later than the
    first arrivals of all registers of its document, for it cannot win one any more.
    """
    first = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, np.uint64)
    time = np.zeros(len(element))
    active, turn = np.arange(len(element)), 0
    while len(active):
        e, d = element[active], doc[active]
        uniform = ((mix(e, 2 * turn + 1) >> np.uint64(11)).astype(float) + 0.5) / (1 << 53)
        time[active] -= np.log(uniform) / weight[active]
        cell = d * registers + (mix(e, 2 * turn + 2) % np.uint64(registers)).astype(np.int64)
        now = time[active]
        early = now < first[cell]
        np.minimum.at(first, cell[early], now[early])
        won = early & (now == first[cell])
        winner[cell[won]] = e[won]
        own = np.unique(d)
        limit = np.full(n_docs, -np.inf)
        limit[own] = first.reshape(n_docs, registers)[own].max(1)
        active = active[now < limit[d]]
        turn += 1
    return winner.reshape(n_docs, registers)


def _bands(winner: np.ndarray) -> np.ndarray:
    parts = winner.reshape(len(winner), BANDS, ROWS)
    total = np.zeros(parts.shape[:2], np.uint64)
    for r in range(ROWS):
        total = mix(total ^ parts[:, :, r], r)
    return mix(total ^ np.arange(BANDS, dtype=np.uint64), 99)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, bands): a digest of the words of each document and its band hashes.

    Words are lower-cased. A document without words has a null digest and no bands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            digests, bands = [], np.zeros((len(texts), BANDS), np.uint64)
            held, held_words = [], 0

            def flush(bands=bands, held=held) -> None:
                if held:
                    rows, sets = zip(*held, strict=True)
                    doc = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
                    made = signatures(doc, np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]).astype(float), len(sets))
                    bands[list(rows)] = _bands(made)
                    held.clear()

            for i, text in enumerate(texts):
                own = words.of(text)
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                if len(own):
                    held.append((i, weighted_shingles(own)))
                    held_words += len(own)
                if held_words > WORDS_AT_ONCE:
                    flush()
                    held_words = 0
            flush()
            offsets = np.cumsum([0, *(BANDS if d else 0 for d in digests)])
            flat = bands[[d is not None for d in digests]].view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64()))],
                names=["doc_id", "digest", "bands"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, digest binary, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The (a, b) of pairs whose texts have a probability Jaccard of at least `similarity`."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            alike, last, held = [], None, None
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if ta is not last:
                    last, held = ta, weighted_shingles(words.of(ta))
                alike.append(probability_jaccard(held, weighted_shingles(words.of(tb))) >= similarity)
            yield batch.select(["a", "b"]).filter(pa.array(alike, pa.bool_()))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, class_id, kept) of every row of docs.

    Two documents are linked if the probability Jaccard similarity of their weighted word
    shingles (five words, lower-cased; fewer words are one shingle) is at least `similarity`;
    a class is a connected component, its id the smallest doc_id in it, which is kept.

    Documents of equal words are one from the start. Of the rest, each band's bucket first
    compares its members with its most central one: that whose buckets hold the most, as the
    original's do among its copies. Components of the verified links follow. Members of
    buckets that still span several components are compared across components wherever
    `rare_prefixes` leave a link possible, so no pair of them is lost and no group is
    compared with itself; two linked documents can miss each other only by sharing no band.

    A document without words, or with a null doc_id, is a class of its own (class_id is its
    doc_id). Rows of the same doc_id are in one class if their texts are; otherwise each keeps
    its own class. An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    sketches = written(sketched(texts), "sketches")
    copies = sketches.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    firsts = written(copies.groupBy("digest").agg(F.min("doc_id").alias("first")), "firsts")
    own = copies.join(firsts, "digest").where(F.col("doc_id") == F.col("first")).select("first", F.posexplode("bands").alias("band", "value"))
    members = written(own.distinct(), "band-members")
    buckets = members.groupBy("band", "value").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(members.join(buckets, ["band", "value"]), "buckets")
    weights = shared.groupBy("first").agg(F.sum("n").alias("weight"))
    shared = written(shared.join(weights, "first"), "buckets")
    seen = written(_with_hub(shared), "pairs")
    links = written(verified(seen, texts, similarity), "links")
    labels = components(links)
    members = written(_open_members(shared, labels), "open-members")
    prefixes = rare_prefixes(texts.join(members, texts["doc_id"] == members["first"]).select("first", "label", "text"), similarity)
    more = written(_pairs_across(prefixes, similarity).join(seen, ["a", "b"], "left_anti"), "pairs")
    found = written(verified(more, texts, similarity), "links")
    if found.take(1):
        labels = components(links.unionByName(found))
    named = firsts.join(labels, firsts["first"] == labels["node"], "left").select("digest", F.coalesce("label", "first").alias("class_id"))
    return (
        sketches.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
        .join(named, "digest", "left")
        .select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))
    )


def _ordered(one: str, two: str) -> list[F.Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def _with_hub(shared: DataFrame) -> DataFrame:
    """The pairs (a, b) of each bucket's most central member with its others."""
    hubs = shared.groupBy("band", "value").agg(F.max(F.struct("weight", "first")).alias("top")).select("band", "value", F.col("top.first").alias("hub"))
    return shared.join(hubs, ["band", "value"]).where("first != hub").select(*_ordered("first", "hub")).distinct()


def _open_members(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """(first, label): members, with their component, of the buckets that span several."""
    named = shared.join(labels, shared["first"] == labels["node"], "left").select("band", "value", "first", F.coalesce("label", "first").alias("label"))
    several = named.groupBy("band", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high")
    return named.join(several.select("band", "value"), ["band", "value"]).select("first", "label").distinct()


def _cells(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(CELLS)).astype(np.int64)


def _holders(members: DataFrame) -> np.ndarray:
    """About how many members hold a shingle of each cell; collects at most CELLS counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = WordHashes(), np.zeros(CELLS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                np.add.at(total, _cells(weighted_shingles(words.of(text))[0]), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["cell", "n"])

    counts = members.select("text").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    holders = np.zeros(CELLS, np.int64)
    holders[counts["cell"].to_numpy()] = counts["n"].to_numpy()
    return holders


def rare_prefixes(members: DataFrame, similarity: float) -> DataFrame:
    """(doc, label, shingle, before, n, weight, classes): shingles of members (first, label, text) that lead to links.

    All documents order their shingles alike, those that few members hold first. `before` is
    the part of a document's weight that comes before a shingle. If x and y first meet in a
    shingle before which x has weight u and y has v, these parts are not shared, and their
    similarity is at most (1 - u)(1 - v) / (1 - uv): see `_pairs_across`. So shingles with more
    than 1 - similarity before them cannot be where a link begins. Counts in cells are never too
    low, thus a shingle with the count 1 is in no other member; it weighs but is not sent.
    n is the document's number of distinct shingles, weight their total, classes the number of
    those that others may hold, in each of CLASSES by hash.
    """
    members = written(members, "member-texts")
    holders = members.sparkSession.sparkContext.broadcast(_holders(members))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            rows, shingles, befores, sizes = [], [np.zeros(0, np.uint64)], [np.zeros(0)], []
            for text in batch.column(2).to_pylist():
                shingle, weight = weighted_shingles(words.of(text))
                held = holders.value[_cells(shingle)]
                order = np.lexsort((shingle, held))
                ends = np.cumsum(weight[order])
                before = (ends - weight[order]) / max(1, weight.sum())
                sent = (before <= 1 - similarity + SLACK) & (held[order] > 1)
                rows.append(int(sent.sum()))
                shingles.append(shingle[order][sent])
                befores.append(before[sent])
                sizes.append((len(shingle), weight.sum(), *np.bincount((shingle[held > 1] >> np.uint64(40)) % np.uint64(CLASSES), minlength=CLASSES)))
            at = pa.array(np.repeat(np.arange(len(rows)), rows))
            of_doc = np.array(sizes, np.int64).reshape(len(rows), CLASSES + 2)
            classes = pa.FixedSizeListArray.from_arrays(pa.array(of_doc[:, 2:].ravel(), pa.int32()), CLASSES).cast(pa.list_(pa.int32()))
            own = [batch.column(0), batch.column(1), pa.array(of_doc[:, 0]), pa.array(of_doc[:, 1]), classes]
            doc, label, n, total, classes = (c.take(at) for c in own)
            flat = pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(befores))
            yield pa.RecordBatch.from_arrays([doc, label, *flat, n, total, classes], names=names)

    schema = "doc long, label long, shingle long, before double, n long, weight long, classes array<int>"
    names = [c.split()[0] for c in schema.split(", ")]
    return written(members.mapInArrow(run, schema), "prefixes")


def _pairs_across(prefixes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of different components that may be linked, by the bound of `rare_prefixes`.

    The members of a shingle's largest component meet those of others only, so a group that is
    one component already makes no pairs, however large it is. Two documents share no more
    shingles than the smaller of both holds in each class; every further one weighs at least 1.
    """
    sizes = prefixes.groupBy("shingle", "label").agg(F.count("*").alias("n"))
    top = sizes.groupBy("shingle").agg(F.count("*").alias("labels"), F.max(F.struct("n", "label")).alias("top")).where("labels > 1")
    spread = written(prefixes.join(top.select("shingle", F.col("top.label").alias("top")), "shingle"), "spread-shingles")
    left = spread.where("label != top").select(
        "shingle",
        F.col("doc").alias("first"),
        F.col("label").alias("label_a"),
        *(F.col(c).alias(f"{c}_a") for c in ("before", "n", "weight", "classes")),
    )
    right = spread.withColumnRenamed("doc", "hub")
    common = "aggregate(zip_with(classes_a, classes, (x, y) -> least(x, y)), 0, (s, x) -> s + x)"
    parts = [("before_a", "before"), (f"(n_a - {common}) / weight_a", f"(n - {common}) / weight")]
    possible = [f"(1 - {u}) * (1 - {v}) >= {similarity - SLACK} * (1 - {u} * {v})" for u, v in parts]
    met = left.join(right, "shingle").where(" AND ".join(["label_a != label", "(label = top OR first < hub)", *possible]))
    return met.select(*_ordered("first", "hub")).distinct()


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """docs with one document of each class; see `near_duplicates`.

    Rows that share a doc_id are one document: they go if none of them is kept. Documents
    without words or id all stay. Other columns of docs are passed through, whatever their names.
    """
    key = unused("_doc", docs.columns)
    stays = near_duplicates(docs, similarity).groupBy(F.col("doc_id").alias(key)).agg(F.max("kept").alias("_kept"))
    gone = stays.where(~F.col("_kept")).select(key)
    return docs.join(gone, F.col("doc_id").cast("long") == F.col(key), "left_anti")

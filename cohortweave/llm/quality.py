"""Quality classifier: document evidence and site posteriors by hierarchical empirical Bayes."""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.llm.common import WordHashes, shingle_hashes, written

#: The classifier is fitted on at most so many labelled rows, those of the smallest id hashes.
LABELLED_ROWS = 20_000
#: Parts of the labelled rows; the evidence of each is measured with weights of the others.
FOLDS = 4
#: A task adds up the features it has met when it holds more than this.
COUNTED_AT_ONCE = 2_000_000
#: A document is rejected if one of its two posteriors reaches this.
REJECT = 0.5
#: Before any label is seen, one document in twenty is taken to be bad.
PRIOR_BAD, PRIOR_ALL = 1.0, 20.0
#: Bounds on how many documents a prior of a site weighs.
WEIGHT_LOW, WEIGHT_HIGH = 10.0, 10_000.0

TARGETS = ("poor", "toxic")
#: Stands for all documents among the features.
EVERY = -1
#: Letters of a stem.
STEM = 4
#: Words whose features a task keeps; beyond it the table starts anew.
KEPT_WORDS = 300_000


#: Kinds of features, the low three bits of a feature's name: by how many of them tell, they differ.
WORD, END, SHARE, STEM_ONCE, STEM_TWICE, STEM_OFTEN = range(6)
KINDS = 8


def _feature(kind: int, value: str) -> int:
    """A 63-bit name of a feature."""
    return (xxhash.xxh64_intdigest(value.encode(), kind) >> 1) & ~(KINDS - 1) | kind


class Words(dict):
    """For each word: its letters in lower case, their stem and the marks after them, as features, and whether it is in capitals."""

    def __init__(self) -> None:
        self.stems: dict[str, int] = {}
        self.ends: dict[str, int] = {}

    def __missing__(self, word: str) -> tuple[int, int, int, bool]:
        if len(self) >= KEPT_WORDS:
            self.clear()
        if len(self.stems) + len(self.ends) >= KEPT_WORDS:
            self.stems, self.ends = {}, {}
        n = len(word)
        while n and not word[n - 1].isalnum():
            n -= 1
        core, marks = word[:n], word[n:][-4:]
        lower = core.lower()
        stem, end = self.stems.get(lower[:STEM]), self.ends.get(marks)
        if stem is None:
            stem = self.stems[lower[:STEM]] = _feature(STEM_ONCE, lower[:STEM])
        if end is None:
            end = self.ends[marks] = _feature(END, marks)
        value = self[word] = (_feature(WORD, lower), stem, end, n > 1 and core.isupper())
        return value


def features_of(text: str | None, words: Words) -> set[int]:
    """The distinct features of a document: its words, their stems, the marks after them, and shares of kinds of words.

    A stem is a word's first letters. It is one feature if the document has a word of it, another
    if it has two different ones, a third if four: words of one family count even if no labelled
    document has just these.
    """
    split = (text or "").split()
    n, lowered = len(split), (text or "").lower().split()
    if n != len(lowered):
        lowered = split
    distinct = set(split)
    cores, stems, ends, in_capitals = zip(*map(words.__getitem__, distinct), strict=True) if n else ((), (), (), ())
    capitals = set(compress(distinct, in_capitals))
    stem_of = dict(zip(cores, stems))
    shares = {
        "length": n.bit_length(),
        "upper": 10 * sum(map(capitals.__contains__, split)) // n if capitals else 0 if n else -1,
        "again": 10 * sum(map(operator.eq, lowered[1:], lowered)) // (n - 1) if n > 1 else -1,
        "distinct": 10 * len(set(lowered)) // n if n else -1,
    }
    of_stem = Counter(stem_of.values())
    found = {*stem_of, *ends, *of_stem, *(_feature(SHARE, f"{k} {v}") for k, v in shares.items())}
    found.update([stem - STEM_ONCE + STEM_TWICE for stem, count in of_stem.items() if count > 1])
    found.update([stem - STEM_ONCE + STEM_OFTEN for stem, count in of_stem.items() if count > 3])
    return found


def features_of_all(texts: list[str | None], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The features of each text in turn, and the place of the text that each is of."""
    each = [features_of(t, words) for t in texts]
    sizes = [len(f) for f in each]
    return np.fromiter(chain.from_iterable(each), np.int64, sum(sizes)), np.repeat(np.arange(len(each)), sizes)


def _weights_of(found: np.ndarray, features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights of each feature found; 0 for those that are not among the sorted `features`."""
    if not len(features):
        return np.zeros((len(found), weights.shape[1]))
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    return np.where((features[at] == found)[:, None], weights[at], 0.0)


def _targets() -> list[Column]:
    """1.0, 0.0 or null (not labelled) for each target."""
    return [(F.col("quality") == 0).cast("int").alias("poor"), (F.col("toxic") == 1).cast("int").alias("toxic")]


def ratios_by_kind(features: np.ndarray, bad: np.ndarray, good: np.ndarray, all_bad: int, all_good: int) -> np.ndarray:
    """`shrunk_ratios` of the features of each kind by themselves."""
    ratios = np.zeros(len(features))
    for kind in range(KINDS):
        of_kind = features % KINDS == kind
        if of_kind.any():
            ratios[of_kind] = shrunk_ratios(bad[of_kind], good[of_kind], all_bad, all_good)
    return ratios


def shrunk_ratios(bad: np.ndarray, good: np.ndarray, all_bad: int, all_good: int) -> np.ndarray:
    """The log ratio of each feature's frequencies among bad and good documents, times the chance that it tells at all.

    A feature tells nothing, and its bad documents are a binomial draw at the overall share, or
    it tells, and every share is as likely. How many features tell is found from all of them
    (empirical Bayes). A rare feature so counts for as much as its few documents can show.
    """
    pairs, which, times = np.unique(np.stack([bad, good]), axis=1, return_inverse=True, return_counts=True)
    (b, g), n, total = pairs, pairs.sum(0), all_bad + all_good
    share, overall = (all_bad + 0.5) / (total + 1), (n + 0.5) / (total + 1)
    ratio = np.log((b + overall) / (all_bad + 1)) - np.log((g + overall) / (all_good + 1))
    logs = [math.lgamma(x + 1) + math.lgamma(y + 1) - math.lgamma(x + y + 2) for x, y in pairs.T.tolist()]
    gain = np.array(logs) - b * math.log(share) - g * math.log1p(-share)
    times, part, tells = np.where(n > 0, times, 0), 0.01, np.zeros(len(n))
    for _ in range(100):
        tells = np.exp(-np.logaddexp(0, -(gain + math.log(part / (1 - part)))))
        before, part = part, float((times @ tells + 1) / (times.sum() + 1000))
        if abs(part - before) < 1e-9:
            break
    return np.where(n > 0, tells * ratio, 0.0)[which.ravel()]


def signs(weights: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """What the odds of each document are read from, given the weights of its features.

    The sums of weights for and against and the number of features, all three by their
    logarithms, as words come together: the tenth telling word adds less than the first, and
    a long document has more of everything. Beside them the largest weight.
    """
    up, down = np.bincount(doc, np.maximum(weights, 0), docs), np.bincount(doc, np.minimum(weights, 0), docs)
    top = np.zeros(docs)
    np.maximum.at(top, doc, weights)
    return np.column_stack([np.log1p(up), -np.log1p(-down), np.log1p(np.bincount(doc, minlength=docs)), top, np.ones(docs)])


#: Where the regression of the odds starts, and how strongly it is held there: weight for and against, size, largest weight.
START, HELD = (1.0, 1.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0)


def calibrated(seen: np.ndarray, bad: np.ndarray, prior: float) -> np.ndarray:
    """The scale of each of the documents' `signs`, by logistic regression.

    Words come together, so their ratios overstate the odds; the regression says by how much.
    With few rows it stays near its start and the odds near `prior`.
    """
    start, weight = np.array([*START, math.log(prior / (1 - prior))]), np.array([*HELD, 0.01])

    def loss(at: np.ndarray) -> float:
        return float((np.logaddexp(0, seen @ at) - bad * (seen @ at)).sum() + (weight * (at - start) ** 2).sum() / 2)

    at = start
    for _ in range(60):
        p = np.exp(-np.logaddexp(0, -(seen @ at)))
        step = np.linalg.solve((seen * (p * (1 - p))[:, None]).T @ seen + np.diag(weight), seen.T @ (p - bad) + weight * (at - start))
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > loss(at):
            size /= 2
        done = loss(at) - loss(at - size * step) < 1e-7
        at = at - size * step
        if done:
            break
    return at


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> tuple[tuple[np.ndarray, np.ndarray, np.ndarray], list[float]]:
    """(features, weights for each target, scales of each target), and the prior of each target.

    A feature's weight is its shrunk log ratio (`shrunk_ratios`). The scales turn a document's
    sums of weights for and against into log odds; they are fitted on evidence from the other
    parts of the labelled rows (`calibrated`). Of labelled
    documents that share their least shingle, as copies do, one counts, for copies would make
    any of their words look telling. Labels beyond `rows` are not used: the sample is a broadcast
    of at most so many rows, and all features of its documents are collected and broadcast, in 24
    bytes each.
    """
    chosen = labels.where(F.col("doc_id").isNotNull()).select("doc_id", *_targets())
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "poor", "toxic").limit(rows)
    labelled = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *TARGETS)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in batches:
            least = [int(shingle_hashes(words.of(t)).min(initial=np.uint64(0xFFFFFFFFFFFFFFFF)) >> np.uint64(1)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=[*batch.schema.names, "least"])

    keyed = labelled.mapInArrow(marked, T.StructType([*labelled.schema.fields, T.StructField("least", T.LongType())]))
    one = keyed.groupBy("least", *TARGETS).agg(F.min(F.struct("doc_id", "text")).alias("doc"))
    part = F.pmod(F.xxhash64(F.lit("part"), "doc.doc_id"), F.lit(FOLDS)).cast("int").alias("part")
    sample = written(one.select(part, "doc.text", *TARGETS), "labelled")
    columns = ["p0", "p1", "t0", "t1"]

    def counted(found: list[np.ndarray], groups: list[np.ndarray]) -> pa.RecordBatch:
        used, at = np.unique(np.concatenate(found), return_inverse=True)
        cells = np.bincount(at * 4 * FOLDS + np.concatenate(groups), minlength=len(used) * 4 * FOLDS).reshape(-1, 4)
        held = np.flatnonzero(cells.any(1))
        arrays = [pa.array(used[held // FOLDS]), pa.array((held % FOLDS).astype("i4")), *(pa.array(cells[held, i]) for i in range(4))]
        return pa.RecordBatch.from_arrays(arrays, names=["feature", "part", *columns])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, found, groups, kept = Words(), [], [], 0
        for batch in batches:
            own, doc = features_of_all(batch.column("text").to_pylist(), words)
            own, doc = np.r_[own, np.full(batch.num_rows, EVERY)], np.r_[doc, np.arange(batch.num_rows)]
            part = batch.column("part").to_numpy().astype(np.int64)
            for t, target in enumerate(TARGETS):
                mark = np.array([-1 if m is None else m for m in batch.column(target).to_pylist()], np.int64)
                known = mark[doc] >= 0
                found.append(own[known])
                groups.append((part * 4 + 2 * t + mark)[doc[known]])
                kept += len(found[-1])
            if kept > COUNTED_AT_ONCE:
                yield counted(found, groups)
                found, groups, kept = [], [], 0
        if kept:
            yield counted(found, groups)

    cells = sample.mapInArrow(run, "feature long, part int, p0 long, p1 long, t0 long, t1 long")
    sums = [F.sum(F.when(F.col("part") == k, F.col(c)).otherwise(0)).cast("int").alias(f"{c}_{k}") for k in range(FOLDS) for c in columns]
    table = cells.groupBy("feature").agg(*sums).toArrow()
    features = table.column("feature").to_numpy()
    order = np.argsort(features)
    counts = np.stack([table.column(i).to_numpy()[order] for i in range(1, table.num_columns)]).reshape(FOLDS, 4, len(order))
    features, every = features[order], np.zeros((FOLDS, 4), np.int64)
    if len(features):  # EVERY is below all others
        features, every, counts = features[1:], counts[:, :, 0].astype(np.int64), counts[:, :, 1:]

    def ratios(held: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return np.stack([ratios_by_kind(features, held[2 * t + 1], held[2 * t], int(whole[2 * t + 1]), int(whole[2 * t])) for t in range(2)], 1)

    held, whole = counts.sum(0), every.sum(0)
    priors = [float((whole[2 * t + 1] + PRIOR_BAD) / (whole[2 * t] + whole[2 * t + 1] + PRIOR_ALL)) for t in range(2)]
    weights, scales = ratios(held, whole), []
    others = np.concatenate([ratios(held - counts[k], whole - every[k]) for k in range(FOLDS)], 1).astype("f4")
    rated = _rated(sample, features, others)
    for t, prior in enumerate(priors):
        known = [(*r[f"_signs_{t}"], r[TARGETS[t]]) for r in rated if r[TARGETS[t]] is not None]
        seen = np.array(known, float).reshape(-1, len(START) + 2)
        at = calibrated(seen[:, :-1], seen[:, -1], prior)
        at[-1] -= math.log(prior / (1 - prior))
        scales.append(at)
    return (features, weights, np.array(scales)), priors


def _rated(sample: DataFrame, features: np.ndarray, others: np.ndarray) -> list[Row]:
    """The labels of each document of the sample, and its evidence for and against by the weights of the other parts."""
    sent = sample.sparkSession.sparkContext.broadcast((features, others))
    names = [f"_signs_{t}" for t in range(2)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, others = sent.value
        words = Words()
        for batch in batches:
            own, doc = features_of_all(batch.column("text").to_pylist(), words)
            part, each = batch.column("part").to_numpy()[doc], _weights_of(own, features, others)
            read = [signs(each[np.arange(len(own)), 2 * part + t], doc, batch.num_rows) for t in range(2)]
            lists = [pa.array(list(r), pa.list_(pa.float64())) for r in read]
            yield pa.RecordBatch.from_arrays([*(batch.column(t) for t in TARGETS), *lists], names=[*TARGETS, *names])

    return sample.mapInArrow(run, ", ".join([*(f"{t} int" for t in TARGETS), *(f"{n} array<double>" for n in names)])).collect()


def with_evidence(docs: DataFrame, weights: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """docs and the log likelihood ratio of each target, as _poor and _toxic."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    schema = T.StructType([*docs.schema.fields, *(T.StructField(f"_{t}", T.DoubleType()) for t in TARGETS)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, weights, scales = sent.value
        words = Words()
        for batch in batches:
            own, doc = features_of_all(batch.column("text").to_pylist(), words)
            each = _weights_of(own, features, weights)
            odds = [signs(each[:, t], doc, batch.num_rows) @ scales[t] for t in range(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, odds)], names=names)

    return docs.mapInArrow(run, schema)


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def _chance(evidence: Column, prior: Column) -> Column:
    return 1 / (1 + F.exp(-(evidence + _logit(prior))))


def site_posteriors(scored: DataFrame, priors: list[float]) -> DataFrame:
    """(_host, _path, n and sums of chances of the path, and the host's posterior means), written.

    Grouped sums of the documents' own chances give a rate per host and per path of a host.
    A host's rate is shrunk towards the global one by the weight that the spread of the hosts
    implies (method of moments), a path's towards its host's in the same way.
    """
    chances = [_chance(F.col(f"_{t}"), F.lit(p)).alias(f"_c_{t}") for t, p in zip(TARGETS, priors, strict=True)]
    paths = written(
        scored.select("_host", "_path", *chances)
        .groupBy("_host", "_path")
        .agg(F.count("*").alias("_n"), *(F.sum(f"_c_{t}").alias(f"_s_{t}") for t in TARGETS)),
        "paths",
    )
    sums = [F.sum("_n").alias("_hn"), *(F.sum(f"_s_{t}").alias(f"_h_{t}") for t in TARGETS)]
    hosts = paths.groupBy("_host").agg(*sums)
    total = hosts.agg(F.sum("_hn").alias("n"), *(F.sum(f"_h_{t}").alias(t) for t in TARGETS)).first()
    columns = []
    for t, prior in zip(TARGETS, priors, strict=True):
        mean = (total[t] + prior) / (total["n"] + 1) if total["n"] else prior
        weight = _prior_weight(hosts, "_hn", f"_h_{t}", mean)
        columns.append(((F.col(f"_h_{t}") + weight * mean) / (F.col("_hn") + weight)).alias(f"_m_{t}"))
        columns.append(F.lit(_prior_weight(paths, "_n", f"_s_{t}", mean)).alias(f"_w_{t}"))
    posts = hosts.select(F.col("_host").alias("_at"), *columns)
    return written(paths.join(posts, F.col("_host").eqNullSafe(F.col("_at"))).drop("_at"), "sites")


def _prior_weight(groups: DataFrame, n: str, total: str, mean: float) -> float:
    """How many documents the prior weighs: much where the groups' rates hardly differ."""
    spread = F.sum(F.col(n) * F.pow(F.col(total) / F.col(n) - mean, 2)) / F.sum(n)
    found = groups.agg(spread.alias("v"), (F.count("*") / F.sum(n)).alias("inverse")).first()
    noise = mean * (1 - mean) * (found["inverse"] or 0)
    between = max((found["v"] or 0) - noise, 1e-12)
    return float(min(max(mean * (1 - mean) / between - 1, WEIGHT_LOW), WEIGHT_HIGH))


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", with_text: bool = True) -> DataFrame:
    """docs with p_poor, p_toxic and accepted; without `with_text` they lack the column text, which then need not be written.

    A document's posterior joins the evidence of its text with the rate of its path (the
    documents of one `path` at one `host`), which leaves the document itself out and is
    shrunk towards its host's and the global rate. accepted: both are below one half.

    A null host or path is a site of its own; a null text is an empty one. Without labels all
    evidence is 0 and everything is accepted. Labels that repeat or contradict each other all
    count; null labels do not. p_poor, p_toxic, accepted and names with a leading underscore
    must be free in docs; other columns are passed through.
    """
    weights, priors = fit(docs, labels)
    site = [F.col(host).cast("string").alias("_host"), F.col(path).cast("string").alias("_path")]
    columns = docs.columns if with_text else [c for c in docs.columns if c != "text"]
    scored = with_evidence(docs.select("*", *site), weights)
    scored = written(scored if with_text else scored.drop("text"), "evidence")
    sites = site_posteriors(scored, priors)
    right = sites.withColumnsRenamed({"_host": "_rh", "_path": "_rp"})
    joined = scored.join(right, F.col("_host").eqNullSafe(F.col("_rh")) & F.col("_path").eqNullSafe(F.col("_rp")))
    chances = []
    for t, prior in zip(TARGETS, priors, strict=True):
        own = _chance(F.col(f"_{t}"), F.lit(prior))
        rate = (F.greatest(F.col(f"_s_{t}") - own, F.lit(0.0)) + F.col(f"_w_{t}") * F.col(f"_m_{t}")) / (F.col("_n") - 1 + F.col(f"_w_{t}"))
        bounded = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
        chances.append(_chance(F.col(f"_{t}"), bounded).alias(f"p_{t}"))
    return joined.select(*(F.col(f"`{c}`") for c in columns), *chances).withColumn(
        "accepted", (F.col("p_poor") < REJECT) & (F.col("p_toxic") < REJECT)
    )


def accepted_documents(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """The accepted rows of docs, unchanged; see `classify`."""
    return classify(docs, labels, host, path).where("accepted").select(*(f"`{c}`" for c in docs.columns))

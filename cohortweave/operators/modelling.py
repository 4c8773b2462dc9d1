"""Weighted model search, leaderboard, evaluation, storage and scoring with Spark ML."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.operators.metrics import weighted_auc, weighted_losses
from cohortweave.session import written

MAX_MODELS, FOLDS, SEED, TOLERANCE, ROUNDS = 50, 10, 789, 0.0001, 5
#: Fits at a time, and bytes of training rows in a partition.
PARALLELISM, PART_BYTES = 8, 64 << 20
#: Boosted trees are fitted to distinct rows where there are at least this many rows to one.
ROWS_TO_ONE = 2


@dataclass(frozen=True)
class Candidate:
    algo: str
    params: tuple[tuple[str, float], ...]

    def describe(self) -> str:
        return ", ".join(f"{k}={v:g}" for k, v in self.params)

    def trees(self) -> int:
        return int(dict(self.params).get("maxIter", 20))

    def but_trees(self) -> tuple[tuple[str, float], ...]:
        return tuple(p for p in self.params if p[0] != "maxIter")


@dataclass
class SearchResult:
    """The best model on all rows, every candidate's loss, and the best one's model of each fold.

    `training` is the written table of the rows searched: key, features, label, weight, fold.
    """

    best: PipelineModel
    candidate: Candidate
    fold_models: list[PipelineModel]
    training: DataFrame
    key: str
    label: str
    weight: str
    rows: list[tuple[int, str, str, float]] = field(default_factory=list)


def default_candidates(max_models: int = MAX_MODELS) -> list[Candidate]:
    """Boosted trees and regularised regressions in turn, from plain to elaborate."""
    trees = [
        Candidate("gbm", (("maxDepth", d), ("stepSize", s), ("maxIter", i)))
        for i, d, s in product((20, 50), (3, 5, 7), (0.1, 0.05))
    ]
    regressions = [
        Candidate("glm", (("regParam", r), ("elasticNetParam", a)))
        for r, a in product((0.001, 0.01, 0.1), (0.0, 0.5, 1.0))
    ]
    mixed: list[Candidate] = []
    for i in range(max(len(trees), len(regressions))):
        mixed += regressions[i : i + 1] + trees[i : i + 1]
    return mixed[:max_models]


def _preparation(features: list[str]) -> Pipeline:
    filled = [f + "__filled" for f in features]
    return Pipeline(
        stages=[
            Imputer(inputCols=features, outputCols=filled, strategy="mean"),
            VectorAssembler(inputCols=filled, outputCol="__features"),
        ]
    )


def _learner(candidate: Candidate, label: str, weight: str, seed: int, **options) -> Estimator:
    common = {"featuresCol": "__features", "labelCol": label, "weightCol": weight, **dict(candidate.params), **options}
    if candidate.algo == "glm":
        return LogisticRegression(**common)
    if candidate.algo == "gbm":
        return GBTClassifier(seed=seed, **common)
    raise ValueError(f"unknown algorithm {candidate.algo!r}")


def key_hash(salt: object, key: str, parts: int) -> Column:
    """A number below `parts` from the MD5 of salt and key, which SQL engines share."""
    digest = F.md5(F.concat_ws(":", F.lit(str(salt)), F.col(key).cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % parts).cast("int")


def hold_out(df: DataFrame, key: str = "cust_id", parts: int = 5) -> tuple[DataFrame, DataFrame]:
    """(train, test): every row of one key in ``parts`` is for the test.

    The hash is salted, so it is unrelated to the folds of ``model_search``.
    """
    test = key_hash("hold out", key, parts) == 0
    return df.where(~test), df.where(test)


def fold_of(key: str = "cust_id", folds: int = FOLDS, seed: int = SEED) -> Column:
    """A row's fold: a hash of its key, so a recomputed partition keeps its folds."""
    return key_hash(seed, key, folds)


def _values_by_fold(data: DataFrame, features: list[str]) -> dict[int, dict[str, int]]:
    """Fold to the number of values, neither NULL nor NaN, of each feature."""
    values = [F.count(F.nanvl(F.col(f), F.lit(None).cast("double"))).alias(f) for f in features]
    return {r["__fold"]: {f: r[f] for f in features} for r in data.groupBy("__fold").agg(*values).collect()}


def _with_values(features: list[str], values: dict[int, dict[str, int]], without: int | None = None) -> list[str]:
    """Features with a value in some fold but the one given. The others have no mean and tell a model nothing.

    Where none has any, all are kept and the Imputer names them in its error.
    """
    return [f for f in features if any(n[f] for fold, n in values.items() if fold != without)] or features


def _distinct(data: DataFrame, by: list[Column | str], weight: str) -> DataFrame:
    """Rows equal in ``by`` as one row with the sum of their weights.

    Boosted trees see a row through weighted sums only, so their fit and loss are those of all rows.
    """
    return data.groupBy(*by).agg(F.sum(weight).alias(weight))


class _Held:
    """Rows held in memory only while fits use them."""

    def __init__(self, rows: DataFrame):
        self.rows, self.lock, self.users, self.held = rows, Lock(), 0, None

    def __enter__(self) -> DataFrame:
        with self.lock:
            self.users += 1
            if self.held is None:
                self.held = self.rows.persist()
            return self.held

    def __exit__(self, *_) -> None:
        with self.lock:
            self.users -= 1
            if self.users == 0:
                self.held.unpersist()
                self.held = None


class _Fold:
    """The rows of one fold, prepared from the others: all for regressions, distinct ones for trees where they are few.

    ``parts`` is the number of partitions of distinct rows, None to fit trees to all rows. Distinct
    rows are written, as every tree of every candidate has passes over them.
    """

    def __init__(self, data: DataFrame, features: list[str], used: list[str], label: str, weight: str, number: int, parts: int | None):
        inside = F.col("__fold") == number
        self.prepare = _preparation(used).fit(data.where(~inside))
        self.rows = _Held(self._prepared(data.withColumn("__test", inside), label, weight))
        self.boosted = self.rows
        if parts:
            few = _distinct(data, [*features, label, inside.alias("__test")], weight).coalesce(parts)
            self.boosted = _Held(written(self._prepared(few, label, weight), "distinct-rows"))

    def _prepared(self, data: DataFrame, label: str, weight: str) -> DataFrame:
        return self.prepare.transform(data).select("__features", label, weight, "__test")

    def held(self, candidate: Candidate) -> _Held:
        return self.boosted if candidate.algo == "gbm" else self.rows


def _fit_fold(rows: DataFrame, candidate: Candidate, label: str, weight: str, seed: int, tolerance: float):
    """The candidate's model of the rows outside the fold.

    Boosting ends early once another tree lowers the loss inside the fold by less than the
    tolerance, in proportion; the trees up to there are kept.
    """
    if candidate.algo == "gbm":
        learner = _learner(candidate, label, weight, seed, validationIndicatorCol="__test", validationTol=tolerance)
        return learner.fit(rows)
    return _learner(candidate, label, weight, seed).fit(rows.where(~F.col("__test")))


def _with_local_properties(spark: SparkSession, work):
    """The function as a thread's target: job groups and the like of this thread hold in that one."""
    wrap = inheritable_thread_target(spark)
    return wrap(work) if callable(wrap) else work


def _longest(candidate: Candidate, among: list[Candidate]) -> Candidate:
    """The candidate of most trees that differs in the number of trees only."""
    if candidate.algo != "gbm":
        return candidate
    return max((c for c in among if c.algo == "gbm" and c.but_trees() == candidate.but_trees()), key=lambda c: c.trees())


def _fold_losses(model, test: DataFrame, candidates: list[Candidate], label: str, weight: str) -> list[float]:
    """Weighted logloss of each candidate on the fold that the model has not seen.

    The first trees of a boosted model are the model of fewer trees, so one pass over the rows
    gives the loss after each tree; a model that ended early stands for more trees too. Spark's
    loss of boosted trees is twice the logloss.
    """
    if candidates[0].algo == "gbm":
        after = model.evaluateEachIteration(test)
        return [after[min(c.trees(), len(after)) - 1] / 2 for c in candidates]
    evaluator = MulticlassClassificationEvaluator(metricName="logLoss", labelCol=label, weightCol=weight)
    return [evaluator.evaluate(model.transform(test))]


def model_search(
    train: DataFrame,
    features: list[str],
    label: str = "obese",
    weight: str = "weight",
    *,
    key: str = "cust_id",
    fold_key: str | None = None,
    folds: int = FOLDS,
    seed: int = SEED,
    max_models: int = MAX_MODELS,
    tolerance: float = TOLERANCE,
    rounds: int = ROUNDS,
    candidates: list[Candidate] | None = None,
    parallelism: int = PARALLELISM,
) -> SearchResult:
    """Cross-validated search by weighted logloss with early stopping.

    A row's fold goes by ``fold_key``, the key itself if not given: rows that should never
    score one another, such as a household's, share one.
    Candidates run in lots of ``rounds``; the search ends when a lot brings no gain above the
    tolerance. Candidates that differ in their number of boosted trees only are one fit per
    fold, which ends early where more trees do not help the fold. At most ``parallelism`` fits
    run at a time, in order of folds, so few folds are in memory. The best candidate is fitted
    on all rows, a boosted one with the folds' mean number of trees, and its fold models are
    kept. Training data stays distributed, in partitions of about PART_BYTES: the driver sees
    metrics and models only. Trees are fitted to distinct rows, weighted by their sums, where
    these are few, as of features in whole years, counts and flags. Every fold must leave rows of both labels to train on. A feature
    without any value in the rows that a model is trained on is no feature of that model.
    """
    data = train.where(F.col(label).isNotNull() & F.col(weight).isNotNull()).select(
        key,
        *[F.col(f).cast("double").alias(f) for f in features],
        F.col(label).cast("double").alias(label),
        F.col(weight).cast("double").alias(weight),
        fold_of(fold_key or key, folds, seed).alias("__fold"),
    )
    training = written(data, "training-rows")

    def partitions(rows: int) -> int:
        return max(1, math.ceil(rows * (len(features) + 3) * 8 / PART_BYTES))

    total = training.count()
    data = training.coalesce(partitions(total))
    queue = (candidates or default_candidates())[:max_models]
    one_each = _distinct(data, [*features, label], weight)
    distinct = one_each.count() if any(c.algo == "gbm" for c in queue) else total
    # a fold's distinct rows are in it or outside of it, or both
    few = partitions(2 * distinct) if distinct * ROWS_TO_ONE <= total else None
    best, best_loss, rows, fitted = None, float("inf"), [], {}
    losses: dict[Candidate, list[float]] = {}
    with ThreadPool(max(1, parallelism)) as pool:

        def each(work, items: list) -> list:
            return pool.map(_with_local_properties(train.sparkSession, work), items, chunksize=1)

        values = _values_by_fold(data, features)
        parted = each(lambda i: _Fold(data, features, _with_values(features, values, i), label, weight, i, few), list(range(folds)))

        def fit(job: tuple[Candidate, int]):
            candidate, i = job
            with parted[i].held(candidate) as held:
                model = _fit_fold(held, candidate, label, weight, seed, tolerance)
                shorter = [c for c in queue if _longest(c, queue) == candidate]
                return model, list(zip(shorter, _fold_losses(model, held.where("__test"), shorter, label, weight)))

        for start in range(0, len(queue), rounds):
            lot = queue[start : start + rounds]
            wanted = list(dict.fromkeys(_longest(c, queue) for c in lot if c not in losses))
            jobs = [(c, i) for i in range(folds) for c in wanted]
            for (candidate, _), (model, found) in zip(jobs, each(fit, jobs)):
                fitted.setdefault(candidate, []).append(model)
                for c, loss in found:
                    losses.setdefault(c, []).append(loss)
            before = best_loss
            for candidate in lot:
                loss = sum(losses[candidate]) / folds
                rows.append((len(rows), candidate.algo, candidate.describe(), float(loss)))
                if best is None or loss < best_loss:
                    best, best_loss = candidate, loss
            later = queue[start + rounds :]
            fitted = {c: models for c, models in fitted.items() if c == _longest(best, queue) or c in later}
            if before - best_loss <= tolerance:
                break

        def best_of_fold(i: int):
            model = fitted[_longest(best, queue)][i]
            if best.algo != "gbm" or model.getNumTrees <= best.trees():
                return model
            with parted[i].held(best) as held:
                return _fit_fold(held, best, label, weight, seed, tolerance)

        models = each(best_of_fold, list(range(folds)))
    prepare = _preparation(_with_values(features, values)).fit(data)
    trees = {"maxIter": max(1, round(sum(m.getNumTrees for m in models) / folds))} if best.algo == "gbm" else {}
    rows_of_best = one_each.coalesce(few) if few and best.algo == "gbm" else data
    whole = PipelineModel([*prepare.stages, _learner(best, label, weight, seed, **trees).fit(prepare.transform(rows_of_best))])
    fold_models = [PipelineModel([*f.prepare.stages, m]) for f, m in zip(parted, models, strict=True)]
    return SearchResult(whole, best, fold_models, training, key, label, weight, rows)


def cross_validated_scores(search: SearchResult, fold_models: list[PipelineModel] | None = None) -> DataFrame:
    """(key, fold, label, weight, p1): every training row scored by the fold model that has not seen it."""
    models = fold_models or search.fold_models
    parts = [
        model.transform(search.training.where(F.col("__fold") == i)).select(
            search.key, F.lit(i).alias("fold"), search.label, search.weight, vector_to_array("probability")[1].alias("p1")
        )
        for i, model in enumerate(models)
    ]
    return reduce(DataFrame.unionAll, parts)


def leaderboard(spark: SparkSession, search: SearchResult) -> DataFrame:
    """Models by cross-validated logloss, best first."""
    rows = sorted(search.rows, key=lambda r: (r[3], r[0]))
    return spark.createDataFrame(
        [(rank + 1, *row) for rank, row in enumerate(rows)],
        "rank int, model_no int, algo string, params string, logloss double",
    )


def _typed(model: PipelineModel, df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in model.stages[0].getInputCols()})


def evaluate(model: PipelineModel, test: DataFrame, label: str = "obese", weight: str = "weight") -> DataFrame:
    """One row of exact weighted metrics on held-out data: logloss, accuracy, auc, n."""
    scored = model.transform(_typed(model, test)).select(label, weight, vector_to_array("probability")[1].alias("p1"), F.lit(1).alias("__all"))
    scored = written(scored, "scored-rows")
    by = ["__all"]
    metrics = weighted_losses(scored, label, weight, by=by).join(weighted_auc(scored, label, weight, by=by), by, "left")
    return metrics.select("logloss", "accuracy", "auc", "n")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_fold_models(search: SearchResult, path: str) -> None:
    for i, model in enumerate(search.fold_models):
        save_model(model, f"{path}/fold-{i}")


def load_fold_models(path: str, folds: int = FOLDS) -> list[PipelineModel]:
    return [load_model(f"{path}/fold-{i}") for i in range(folds)]


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, df: DataFrame, key: str = "cust_id") -> DataFrame:
    """(key, p1): probability of label 1."""
    return model.transform(_typed(model, df)).select(key, vector_to_array("probability")[1].alias("p1"))

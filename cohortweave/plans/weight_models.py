"""Weight-status models: adults first, then children with their household's adult scores as a feature."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.operators.features import class_weights, household_mean_score
from cohortweave.operators.modelling import SearchResult, cross_validated_scores, fold_of, leaderboard, model_search

ADULTS, CHILDREN = "adults", "children"
HOUSEHOLD_SCORE = "hh_adult_mean_score"


@dataclass(frozen=True)
class ModelRules:
    adult_ages: tuple[int, int] = (20, 110)
    child_ages: tuple[int, int] = (2, 19)
    search: dict = field(default_factory=dict)


def household_folds(people: DataFrame, key: str = "cust_id", hh: str = "hh_id", out: str = "fold_id") -> DataFrame:
    """People with the id that their fold goes by: the household, or the person without one."""
    own = F.concat(F.lit("person "), F.col(key).cast("string"))
    return people.withColumn(out, F.coalesce(F.concat(F.lit("household "), F.col(hh).cast("string")), own))


def strata(labelled: DataFrame, rules: ModelRules = ModelRules()) -> DataFrame:
    """Adults and children, each with the class weights and the fold of their stratum."""
    folded = household_folds(labelled).withColumn("fold", fold_of("fold_id"))
    parts = [
        class_weights(folded, ages).withColumn("stratum", F.lit(name))
        for name, ages in ((ADULTS, rules.adult_ages), (CHILDREN, rules.child_ages))
    ]
    return parts[0].unionByName(parts[1])


def child_rows(labelled: DataFrame, adult_scores: DataFrame, rules: ModelRules = ModelRules()) -> DataFrame:
    """The children's stratum with the mean score of each household's adults."""
    children = class_weights(labelled, rules.child_ages)
    return household_mean_score(children, adult_scores, labelled.select("cust_id", "hh_id"), out=HOUSEHOLD_SCORE)


def stacked_models(
    labelled: DataFrame, adult_features: list[str], child_features: list[str], rules: ModelRules = ModelRules()
) -> tuple[SearchResult, SearchResult | None]:
    """(adult search, child search) over one labelled table with cust_id, hh_id, age, obese and features.

    Without children of both labels there is no child search.

    Adult scores are out of fold, and folds go by household: the score a child row sees comes
    from a model that was trained without its household, as will be the case for new people.
    """
    folded = household_folds(labelled)
    adults = model_search(class_weights(folded, rules.adult_ages), adult_features, fold_key="fold_id", **rules.search)
    scores = cross_validated_scores(adults).select("cust_id", "p1")
    children = child_rows(folded, scores, rules)
    if children.where(F.col("obese").isNotNull()).select("obese").distinct().count() < 2:
        return adults, None
    return adults, model_search(children, [*child_features, HOUSEHOLD_SCORE], fold_key="fold_id", **rules.search)


def leaderboards(adults: SearchResult, children: SearchResult | None) -> DataFrame:
    """Both leaderboards, best models first within each stratum; only the adults' where there is no child search."""
    spark = adults.training.sparkSession
    searches = [(ADULTS, adults), *([(CHILDREN, children)] if children else [])]
    return reduce(DataFrame.unionByName, [leaderboard(spark, s).select(F.lit(n).alias("stratum"), "*") for n, s in searches])

"""Feature templates, household and area features, training sets."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.operators.spread import spread_join, with_group_values


def join_features(parts: Sequence[DataFrame], key: str = "cust_id") -> DataFrame:
    """Full outer join of feature tables on one key.

    Each part is read once and rows without a key are left out. Parts that were grouped by
    the key keep that partitioning through the joins and need no further shuffle.
    """
    keyed = [p.where(F.col(key).isNotNull()) for p in parts]
    return reduce(lambda left, right: left.join(right, key, "full"), keyed)


def feature_templates(
    cohort: DataFrame,
    templates: dict[str, str],
    tables: dict[str, DataFrame] | None = None,
    lookback_months: int = 18,
    key: str = "cust_id",
) -> DataFrame:
    """Run every SQL template against the cohort and join the results on the key.

    A template names its inputs in braces ({cohort}, {claims}, ...) and the look-back as
    :lookback_months.
    """
    spark = cohort.sparkSession
    frames = {"cohort": cohort, **(tables or {})}
    parts = []
    for text in templates.values():
        used = {name: frame for name, frame in frames.items() if "{" + name + "}" in text}
        parts.append(spark.sql(text, args={"lookback_months": lookback_months}, **used))
    return join_features(parts, key)


def household_features(
    df: DataFrame, households: DataFrame, *, key: str = "cust_id", hh: str = "hh_id", label: str = "obese"
) -> DataFrame:
    """(key, hh, hh_obese, hh_nonobese): whether another member of the household has label 1 / label 0."""
    joined = df.select(key, label).join(households.select(key, hh), key, "left")
    ones = F.when(F.col(label) == 1, 1).otherwise(0)
    zeros = F.when(F.col(label) == 0, 1).otherwise(0)
    summed = with_group_values(joined, hh, __ones=F.sum(ones), __zeros=F.sum(zeros))
    known = F.col(hh).isNotNull()
    return summed.select(
        key,
        hh,
        F.when(known & (F.col("__ones") - ones >= 1), 1).otherwise(0).alias("hh_obese"),
        F.when(known & (F.col("__zeros") - zeros >= 1), 1).otherwise(0).alias("hh_nonobese"),
    )


def fallback_lookup(df: DataFrame, lookups: Sequence[tuple[str, DataFrame, str, str]], out: str) -> DataFrame:
    """Value of the first lookup (key column, table, table key, table value) that has one; the keys are dropped.

    The tables carry no hint: Spark broadcasts an area table when its size allows.
    """
    result, values = df, []
    for i, (column, table, table_key, table_value) in enumerate(lookups):
        side = table.select(F.col(table_key).alias(f"__k{i}"), F.col(table_value).alias(f"__v{i}"))
        result = result.join(side, F.col(column) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        values.append(f"__v{i}")
    return result.withColumn(out, F.coalesce(*values)).drop(*values, *[column for column, *_ in lookups])


def assemble_features(
    parts: Sequence[DataFrame],
    household: DataFrame,
    lookups: Sequence[tuple[str, DataFrame, str, str]],
    out: str = "cdc_obese_pct",
    key: str = "cust_id",
) -> DataFrame:
    """Template features with household and area features."""
    base = parts[0] if len(parts) == 1 else join_features(parts, key)
    return fallback_lookup(base.join(household, key, "left"), lookups, out)


def select_features(
    columns: Iterable[str],
    names: Sequence[str] = (),
    prefixes: Sequence[str] = (),
    exclude: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> list[str]:
    """Feature list: named columns, then those by prefix in table order, less the excluded, plus extras."""
    columns = list(columns)
    missing = [n for n in names if n not in columns]
    if missing:
        raise ValueError(f"features not in the table: {missing}")
    by_prefix = [c for p in prefixes for c in columns if c.startswith(p)]
    chosen = [c for c in dict.fromkeys([*names, *by_prefix]) if c not in exclude]
    return [*chosen, *[e for e in extra if e not in chosen]]


def labelled_set(labels: DataFrame, features: DataFrame, key: str = "cust_id") -> DataFrame:
    repeated = [c for c in features.columns if c in labels.columns and c != key]
    return labels.join(features.drop(*repeated), key, "left")


def class_weights(
    df: DataFrame, ages: tuple[int, int], *, label: str = "obese", age: str = "age", out: str = "weight"
) -> DataFrame:
    """The age stratum with weights: negatives 1, positives (negatives / positives) of the stratum."""
    stratum = df.where(F.col(age).between(*ages))
    ratio = stratum.agg(
        F.try_divide(F.sum(F.when(F.col(label) == 0, 1)), F.sum(F.when(F.col(label) == 1, 1))).alias("ratio")
    ).scalar()
    return stratum.withColumn(out, F.when(F.col(label) == 1, ratio).when(F.col(label) == 0, F.lit(1.0)))


def household_mean_score(
    people: DataFrame,
    scores: DataFrame,
    households: DataFrame,
    *,
    key: str = "cust_id",
    hh: str = "hh_id",
    score: str = "p1",
    out: str = "hh_adult_mean_score",
    null_safe: bool = False,
) -> DataFrame:
    """People (with their household) plus the mean score of its scored members.

    People without a household get NULL, or with ``null_safe`` the mean over all scored
    people without one.
    """
    means = scores.select(key, score).join(households.select(key, hh), key, "left").groupBy(hh).agg(F.avg(score).alias(out))
    return spread_join(people, means, hh, "left", null_safe=null_safe)


def snake_case(name: str) -> str:
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name.replace("%", "percent").replace("#", "number"))
    return re.sub(r"[^0-9a-zA-Z]+", "_", spaced).strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    """Columns in snake case; a repeated name gets a number."""
    seen: dict[str, int] = {}
    cleaned = []
    for column in df.columns:
        name = snake_case(column)
        seen[name] = seen.get(name, 0) + 1
        cleaned.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return df.toDF(*cleaned)


def two_period_mean(
    df: DataFrame,
    id_cols: list[str],
    years: list[int],
    *,
    rename: dict[str, str] | None = None,
    population: str = "pop_total",
) -> DataFrame:
    """Mean over the years of every ``name_YYYY`` column per id, rows without population left out."""
    df = clean_names(df)
    if rename:
        df = df.withColumnsRenamed(rename)
    stems = list(dict.fromkeys(re.sub(r"_\d{4}$", "", c) for c in df.columns if re.search(r"_\d{4}$", c)))

    def one_year(year: int):
        present = [F.col(f"{s}_{year}").cast("double") if f"{s}_{year}" in df.columns else F.lit(None).cast("double") for s in stems]
        return F.struct(*[c.alias(s) for c, s in zip(present, stems)])

    long = df.select(*id_cols, F.inline(F.array(*[one_year(y) for y in years])))
    return long.where(F.col(population) != 0).groupBy(*id_cols).agg(*[F.avg(s).alias(s) for s in stems])

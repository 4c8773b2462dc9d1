"""Code lists: derived from a reference table, or expanded from ranges and literals."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def code_list(
    reference: DataFrame,
    list_name: str,
    *,
    code_type: str | None = None,
    definition_contains: list[str] | None = None,
    lower: bool = False,
    dotted: bool = False,
    type_col: str = "type",
    code_col: str = "code",
    definition_col: str = "definition",
    match_len: int | None = None,
) -> DataFrame:
    """(list_name, code, match_len) of the reference codes of one type whose definition holds a text.

    ``dotted`` turns O9902 into O99.02. ``match_len`` is how many leading characters of a
    claim code are compared; by default the length of the list's own code.
    """
    df = reference
    if code_type is not None:
        df = df.where(F.col(type_col) == code_type)
    if definition_contains:
        text = F.lower(definition_col) if lower else F.col(definition_col)
        df = df.where(reduce(lambda a, b: a | b, [text.contains(t) for t in definition_contains]))
    code = F.col(code_col).cast("string")
    if dotted:
        code = F.when(F.length(code) > 3, F.concat(F.substring(code, 1, 3), F.lit("."), F.substring(code, 4, 7))).otherwise(
            code
        )
    length = F.length("code") if match_len is None else F.lit(match_len)
    return (
        df.select(code.alias("code"))
        .where(F.col("code").isNotNull())
        .distinct()
        .select(F.lit(list_name).alias("list_name"), "code", length.cast("int").alias("match_len"))
    )


def code_ranges(spark: SparkSession, ranges: list[tuple[str, str, int, int]]) -> DataFrame:
    """(list_name, code, match_len) rows for ranges such as ("delivery", "O", 80, 84)."""
    specs = spark.createDataFrame(ranges, "list_name string, prefix string, lo int, hi int")
    return (
        specs.select("list_name", "prefix", F.explode(F.sequence("lo", "hi")).alias("number"))
        .select("list_name", F.concat("prefix", F.col("number").cast("string")).alias("code"))
        .distinct()
        .withColumn("match_len", F.length("code").cast("int"))
    )


def code_literals(spark: SparkSession, lists: dict[str, list[str]]) -> DataFrame:
    """(list_name, code, match_len) rows from literal lists."""
    rows = [(name, code, len(code)) for name, codes in lists.items() for code in codes]
    return spark.createDataFrame(rows, "list_name string, code string, match_len int")

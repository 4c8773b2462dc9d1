"""Matching claims against code lists and naming who was found how."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.rules import DROP, any_code, flag, head, no_code
from cohortweave.operators.spread import names, spread_join, with_group_values
from cohortweave.session import written


#: Stands for a length: every code of a list is compared by its own match_len.
PER_CODE = "per_code"
#: Codes of a list that may become one filter; beyond, a list stays a table.
DICTIONARY = 20_000


def code_columns(df: DataFrame, pattern: str) -> list[str]:
    return [c for c in df.columns if re.search(pattern, c)]


def melt_codes(
    df: DataFrame,
    id_cols: list[str],
    pattern: str,
    *,
    rename: dict[str, str] | None = None,
    strip_prefix: str | None = None,
    name_col: str = "diag_seq",
    value_col: str = "diag_cd",
) -> DataFrame:
    """Wide code columns to one row per (row, position, code); NULL codes stay.

    ``rename`` brings irregular column names in line first and ``strip_prefix`` is cut
    from the position name.
    """
    if rename:
        df = df.withColumnsRenamed(rename)
    long = df.unpivot(id_cols, code_columns(df, pattern), name_col, value_col)
    if strip_prefix:
        long = long.withColumn(name_col, F.regexp_replace(name_col, "^" + re.escape(strip_prefix), ""))
    return long


def code_dictionary(codes: DataFrame, match_len: int | str | None = None) -> dict[int | None, list[str]] | None:
    """The heads to look for by their length (None: whole codes), or None for a list of more than DICTIONARY codes.

    A listed code of at least ``match_len`` characters counts by its head, a shorter one as a
    whole. With ``PER_CODE`` the length comes from the list's own column ``match_len``. Only
    DICTIONARY codes and one more ever reach the driver.
    """
    listed = codes.where(F.col("code").isNotNull())
    if match_len == PER_CODE:
        head_len = F.expr("if(length(code) >= match_len, match_len, null)").cast("int")
        heads = listed.select(head_len.alias("at"), F.expr("if(length(code) >= match_len, left(code, match_len), code)").alias("head"))
    else:
        heads = listed.select(F.lit(match_len).cast("int").alias("at"), F.col("code").alias("head"))
    rows = heads.distinct().limit(DICTIONARY + 1).collect()
    if len(rows) > DICTIONARY:
        return None
    found: dict[int | None, list[str]] = {}
    for at, code in sorted(rows, key=lambda r: (r[0] or 0, r[1])):
        found.setdefault(at, []).append(code)
    return found


def in_dictionary(columns: list[str], dictionary: dict[int | None, list[str]]) -> Column:
    """True where any column holds a listed code; not NULL."""
    tests = [any_code(columns, heads, at) for at, heads in dictionary.items()]
    return F.coalesce(reduce(lambda a, b: a | b, tests, F.lit(False)), F.lit(False))


def _met_codes(df: DataFrame, cols: list[str], listed: DataFrame) -> DataFrame:
    """The codes in df's columns whose first ``match_len`` characters are those of a listed code.

    Only distinct codes are cut into their heads. Position 0 stands for the whole code: it is
    compared where a listed code has no length or is shorter than its own.
    """
    met = df.select(F.explode(F.array(*cols)).alias("code")).where(F.col("code").isNotNull()).distinct()
    at = F.explode(F.sequence(F.lit(0), F.length("code"))).alias("__at")
    heads = met.select("code", at).withColumn("__head", F.expr("if(__at = 0, code, left(code, __at))"))
    wanted = listed.where(F.col("code").isNotNull()).select(
        F.expr("if(length(code) >= match_len, match_len, 0)").cast("int").alias("__at"),
        F.expr("if(length(code) >= match_len, left(code, match_len), code)").alias("__head"),
    )
    return heads.join(wanted.distinct(), ["__at", "__head"], "left_semi").select("code")


def match_codes(
    df: DataFrame, code_cols: str | list[str], codes: list[str] | DataFrame, match_len: int | str | None = None
) -> DataFrame:
    """Rows where any listed column's first ``match_len`` characters (or all) are in the list.

    A list, or a DataFrame list (column ``code``) of at most DICTIONARY codes, becomes one
    filter over all columns: the claims are neither joined nor moved. A longer DataFrame list
    is joined per column. With ``PER_CODE`` each code of a DataFrame list counts by its own
    column ``match_len``.
    """
    cols = names(code_cols)
    if not isinstance(codes, DataFrame):
        if match_len == PER_CODE:
            raise ValueError("a length per code needs a list with the columns code and match_len")
        return df.where(any_code(cols, codes, match_len))
    dictionary = code_dictionary(codes, match_len)
    if dictionary is not None:
        return df.where(in_dictionary(cols, dictionary))
    if match_len == PER_CODE:
        codes, match_len = _met_codes(df, cols, codes), None
    distinct = codes.select(F.col("code").alias("__code")).where(F.col("code").isNotNull()).distinct()
    if len(cols) == 1:
        return df.join(distinct, head(cols[0], match_len) == F.col("__code"), "left_semi")
    marked, hits = df, []
    for i, c in enumerate(cols):
        mark = distinct.select(F.col("__code").alias(f"__code{i}"))
        marked = marked.join(mark, head(c, match_len) == F.col(f"__code{i}"), "left")
        hits.append(f"__code{i}")
    found = reduce(lambda a, b: a | b, [F.col(h).isNotNull() for h in hits])
    return marked.where(found).drop(*hits)


def exclude_codes(df: DataFrame, code_cols: str | list[str], codes: list[str], null_policy: str = DROP) -> DataFrame:
    """Drop rows carrying a listed code; ``null_policy`` says what a NULL code does."""
    return df.where(no_code(names(code_cols), codes, null_policy))


def code_tier(
    df: DataFrame,
    method: str,
    code_cols: str | list[str],
    codes: list[str] | DataFrame,
    *,
    key: str = "person_id",
    from_dt: str = "from_dt",
    to_dt: str = "to_dt",
    match_len: int | str | None = None,
    report: str = "matched",
) -> DataFrame:
    """One code system's finds as distinct (key, from_dt, to_dt, id_method, id_code).

    ``report="matched"`` gives a row per matching code. ``report="first"`` gives one row
    per line with the first non-NULL of the columns, even if another column matched.
    """
    cols = names(code_cols)
    base = df.where(F.col(key).isNotNull())
    lines = match_codes(base, cols, codes, match_len)
    ids = [F.col(key), F.col(from_dt).alias("from_dt"), F.col(to_dt).alias("to_dt")]
    if report == "first":
        found = lines.select(*ids, F.coalesce(*cols).alias("id_code"))
    elif len(cols) == 1:
        found = lines.select(*ids, F.col(cols[0]).alias("id_code"))
    else:
        # lines are filtered before they are multiplied by their code columns
        long = lines.select(*ids, *cols).unpivot([key, "from_dt", "to_dt"], cols, "__pos", "id_code").drop("__pos")
        found = match_codes(long, "id_code", codes, match_len)
    return found.select(key, "from_dt", "to_dt", F.lit(method).alias("id_method"), "id_code").distinct()


def tiered_identify(tiers: list[DataFrame], key: str = "person_id") -> DataFrame:
    """Finds of ordered code systems; a key found by one tier is left out of all later ones."""
    numbered = [tier.withColumn("__tier", F.lit(i)) for i, tier in enumerate(tiers)]
    finds = reduce(DataFrame.unionByName, numbered)
    best = with_group_values(finds, key, __best=F.min("__tier"))
    return best.where(F.col("__tier") == F.col("__best")).drop("__tier", "__best")


@dataclass(frozen=True)
class TierRule:
    """How one code system identifies people: its name, the columns it reads and the codes it looks for.

    ``codes`` has the columns code and match_len (see ``sources.codelists``). ``report`` is
    that of ``code_tier``.
    """

    method: str
    columns: tuple[str, ...]
    codes: DataFrame
    report: str = "matched"


@dataclass(frozen=True)
class TierTable:
    """One claims table with the rules that read it."""

    claims: DataFrame
    rules: tuple[TierRule, ...]
    from_dt: str = "from_dt"
    to_dt: str = "to_dt"


def tier_finds(table: TierTable, order: list[str], key: str = "person_id") -> DataFrame:
    """Distinct (key, from_dt, to_dt, id_method, id_code, __tier) of all the table's rules, from one pass over it.

    A row's finds are gathered in an array and only those of its least tier leave the row, as
    its person cannot be named by a later one.
    """
    finds = []
    for rule in table.rules:
        dictionary = code_dictionary(rule.codes, PER_CODE)
        if dictionary is None:
            raise ValueError(f"{rule.method}: a tier's list may have {DICTIONARY} codes")
        shown = [(list(rule.columns), F.coalesce(*rule.columns))] if rule.report == "first" else [([c], F.col(c)) for c in rule.columns]
        for columns, code in shown:
            find = F.struct(F.lit(order.index(rule.method)).alias("__tier"), F.lit(rule.method).alias("id_method"), code.alias("id_code"))
            finds.append(F.when(in_dictionary(columns, dictionary), find))
    ids = [F.col(key), F.col(table.from_dt).alias("from_dt"), F.col(table.to_dt).alias("to_dt")]
    found = table.claims.where(F.col(key).isNotNull()).select(*ids, F.filter(F.array(*finds), lambda f: f.isNotNull()).alias("__finds"))
    least = F.array_min(F.transform("__finds", lambda f: f["__tier"]))
    first = F.filter("__finds", lambda f: f["__tier"] == F.col("__least"))
    return found.where(F.size("__finds") > 0).withColumn("__least", least).select(key, "from_dt", "to_dt", F.inline(first)).distinct()


def identify_by_tiers(tables: list[TierTable], order: list[str], key: str = "person_id") -> DataFrame:
    """Finds of ordered code systems, each person named by the first that finds them.

    As ``tiered_identify``, but each claims table is read once for all its code systems. The
    finds are few against the claims; they are written once, and the least tier of each
    person is joined back to them slice by slice.
    """
    finds = written(reduce(DataFrame.unionByName, [tier_finds(t, order, key) for t in tables]), "tier-finds")
    best = with_group_values(finds, key, __best=F.min("__tier"))
    return best.where(F.col("__tier") == F.col("__best")).select(key, "from_dt", "to_dt", "id_method", "id_code")


def method_counts(df: DataFrame, col: str = "id_method") -> DataFrame:
    """Frequency of a column's values, NULL left out."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def flag_columns(code_col: str, families: dict[str, tuple[list[str], int | None]]) -> dict[str, Column]:
    return {name: flag(head(code_col, length).isin(list(codes))) for name, (codes, length) in families.items()}


def code_flags(
    df: DataFrame, code_col: str, families: dict[str, tuple[list[str], int | None]], by: list[str]
) -> DataFrame:
    """0/1 flag per code family, highest value per group."""
    return df.groupBy(*by).agg(*[F.max(c).alias(n) for n, c in flag_columns(code_col, families).items()])


def keep_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in another table (the reduce-size step), without shipping the list through the driver."""
    return spread_join(df, listed.select(key).distinct(), key, "left_semi")

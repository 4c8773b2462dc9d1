"""Long-term-care flags, member-months, stays, index dates and categories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions import fixed_values as fixed
from cohortweave.functions.rules import DROP, any_code, first_match, flag, label_rules, no_code

PLACES = ["place_of_service_cd", "claim_ln_place_of_service_cd"]
PROCEDURES = ["cpt_cd", "service_cd", "procedure_cd"]
REVENUES = ["revenue_cd", "revenue_cd2"]


def care_rules(
    *,
    places: list[str] = PLACES,
    procedures: list[str] = PROCEDURES,
    revenues: list[str] = REVENUES,
    nursing_home: list[str] = fixed.NURSING_HOME_PLACES,
    snf: list[str] = fixed.SNF_PLACE,
    day_care: list[str] = fixed.DAY_CARE_PROCEDURES,
    home_procedures: list[str] = fixed.HOME_CARE_PROCEDURES,
    home_revenues: list[str] = fixed.HOME_CARE_REVENUE,
    null_policy: str = DROP,
) -> dict[str, Column]:
    """Conditions on a claim line: any use, institution, skilled nursing, home care, adult day care."""
    no_day_care = no_code(procedures, day_care, null_policy)
    return {
        "utiliz": F.lit(True),
        "iltc": any_code(places, nursing_home) & no_day_care,
        "snf": any_code(places, snf) & no_day_care,
        "hltc": any_code(procedures, home_procedures) | any_code(revenues, home_revenues),
        "cltc": any_code(procedures, day_care),
    }


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def period_flags(
    people: DataFrame,
    crosswalk: DataFrame,
    claims: DataFrame,
    rules: dict[str, Column],
    periods: dict[str, tuple[str, str]],
    *,
    first_months: dict[str, Column] | None = None,
    cust: str = "cust_id",
    person: str = "person_id",
    date: str = "claim_service_from_dt",
) -> DataFrame:
    """One 0/1 flag per rule and period for everyone in ``people``.

    One claims pass for all flags: claims shrink to one row per person before they meet
    the id crosswalk, and every step combines map-side. ``first_months`` adds the month of
    the first claim in any period that a condition holds for, in the same pass.
    """
    flags = {}
    for name, rule in rules.items():
        for suffix, (first, last) in periods.items():
            flags[f"{name}_{suffix}"] = flag(rule & F.col(date).between(_day(first), _day(last)))
    in_any = reduce(lambda a, b: a | b, [F.col(date).between(_day(f), _day(t)) for f, t in periods.values()])
    firsts = {n: F.min(F.when(c, F.col(date))) for n, c in (first_months or {}).items()}
    per_person = (
        claims.where(in_any)
        .groupBy(person)
        .agg(*[F.max(c).alias(n) for n, c in flags.items()], *[c.alias(n) for n, c in firsts.items()])
    )
    per_cust = (
        crosswalk.select(cust, person)
        .distinct()
        .join(per_person, person)
        .groupBy(cust)
        .agg(*[F.max(n).alias(n) for n in flags], *[F.trunc(F.min(n), "MM").alias(n) for n in firsts])
    )
    return (
        people.select(cust)
        .distinct()
        .join(per_cust, cust, "left")
        .withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in flags})
    )


def member_months(
    claims: DataFrame,
    *,
    key: str = "person_id",
    start: str = "claim_service_from_dt",
    end: str = "claim_service_to_dt",
    snf: Column | None = None,
    nh: Column | None = None,
    from_years: list[int] = (2017, 2018, 2019, 2020),
    last_month: str = "2020-03-01",
    endpoints_only: bool = True,
) -> DataFrame:
    """(key, yr, mo, snf, nh) of months with a skilled-nursing or nursing-home claim.

    A claim counts in its first and its last month, or in every month between with
    ``endpoints_only=False``. Rows combine map-side to one per person and month.
    """
    snf = any_code(PLACES, fixed.SNF_PLACE) if snf is None else snf
    nh = any_code(PLACES, fixed.NURSING_HOME_PLACES) if nh is None else nh
    years = list(from_years)
    rows = claims.where(F.year(start).isin(years)).select(
        key, F.trunc(start, "MM").alias("__a"), F.trunc(end, "MM").alias("__b"), flag(snf).alias("snf"), flag(nh).alias("nh")
    )
    rows = rows.where((F.col("snf") == 1) | (F.col("nh") == 1))
    if endpoints_only:
        months = F.array("__a", "__b")
    else:
        upto = F.greatest("__a", F.coalesce("__b", "__a"))
        months = F.sequence("__a", upto, F.expr("interval 1 month"))
    return (
        rows.select(key, F.explode(months).alias("__month"), "snf", "nh")
        .where(F.col("__month").between(F.make_date(F.lit(min(years)), F.lit(1), F.lit(1)), _day(last_month)))
        .groupBy(key, "__month")
        .agg(F.max("snf").alias("snf"), F.max("nh").alias("nh"))
        .select(key, F.year("__month").alias("yr"), F.month("__month").alias("mo"), "snf", "nh")
    )


def months_by_cust(
    months: DataFrame, crosswalk: DataFrame, *, cust: str = "cust_id", person: str = "person_id"
) -> DataFrame:
    """Member-months of claim-side ids brought to customer ids; a customer may have several."""
    pairs = crosswalk.select(cust, person).distinct()
    joined = months.join(pairs, person)
    return joined.groupBy(cust, "yr", "mo").agg(F.max("snf").alias("snf"), F.max("nh").alias("nh"))


def long_stays(months: DataFrame, min_months: int = 4, *, key: str = "person_id", per_stay: bool = False) -> DataFrame:
    """(key, yr_start, min_iltc4_month) of people with a contiguous stay of ``min_months`` or more.

    Skilled-nursing months that lead a stay do not count; later ones do, and a stay is not
    split again once they are gone. ``per_stay=True`` gives one row per stay (with
    ``visit_id``) instead of the earliest per person. A window holds the months of one
    person, at most a few dozen rows.
    """
    first_day = F.make_date("yr", "mo", F.lit(1))
    indexed = months.withColumn("__mo", F.col("yr") * 12 + F.col("mo"))
    by_month = Window.partitionBy(key).orderBy(F.col("__mo").asc_nulls_last())
    running = by_month.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_stay = Window.partitionBy(key, "visit_id").orderBy(F.col("__mo").asc_nulls_last())
    so_far = in_stay.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        indexed.withColumn("__split", flag(F.col("__mo") - F.lag("__mo").over(by_month) > 1))
        .withColumn("visit_id", F.sum("__split").over(running).cast("int"))
        .withColumn("__snf_so_far", F.sum("snf").over(so_far))
        .withColumn("__rn", F.row_number().over(in_stay))
        .where(F.col("__snf_so_far") != F.col("__rn"))
        .groupBy(key, "visit_id")
        .agg(F.count(F.lit(1)).alias("__n"), F.min(first_day).alias("min_iltc4_month"))
        .where(F.col("__n") >= min_months)
    )
    if per_stay:
        return counted.select(key, "visit_id", F.year("min_iltc4_month").alias("yr_start"), "min_iltc4_month")
    return (
        counted.groupBy(key)
        .agg(F.min("min_iltc4_month").alias("min_iltc4_month"))
        .select(key, F.year("min_iltc4_month").alias("yr_start"), "min_iltc4_month")
    )


def long_stay_flags(
    stays: DataFrame, periods: dict[str, list[int]], *, key: str = "person_id", name: str = "iltc_4m"
) -> DataFrame:
    """0/1 per period by the years stays start in; give it per-stay rows to let one person be in several."""
    return stays.groupBy(key).agg(
        *[F.max(flag(F.col("yr_start").isin(years))).alias(f"{name}_{suffix}") for suffix, years in periods.items()]
    )


def first_institution_month(months: DataFrame, stays: DataFrame, *, key: str = "person_id") -> DataFrame:
    """(key, min_iltc_month, min_iltc4_month): first nursing-home month, with the first long stay's month."""
    first = (
        months.where(F.col("nh") == 1)
        .groupBy(key)
        .agg(F.min(F.make_date("yr", "mo", F.lit(1))).alias("min_iltc_month"))
    )
    return first.join(stays.select(key, "min_iltc4_month"), key, "left")


def first_homecare_month(
    claims: DataFrame,
    rule: Column,
    first: str,
    last: str,
    *,
    key: str = "person_id",
    date: str = "claim_service_from_dt",
) -> DataFrame:
    """(key, min_hltc_month): month of the first claim in the period that the rule holds for."""
    return (
        claims.where(rule & F.col(date).between(_day(first), _day(last)))
        .groupBy(key)
        .agg(F.trunc(F.min(date), "MM").alias("min_hltc_month"))
    )


def events_by_text(
    df: DataFrame,
    year: int,
    patterns: list[str] = fixed.DEATH_PATTERNS,
    *,
    key: str = "cust_id",
    text: str = "reason",
    date: str = "event_dt",
    out: str = "death_dt",
) -> DataFrame:
    """First date per key whose lower-cased text matches a pattern, within a year."""
    matches = reduce(lambda a, b: a | b, [F.lower(text).like(p) for p in patterns])
    in_year = F.col(date).between(_day(f"{year}-01-01"), _day(f"{year}-12-31"))
    return df.where(matches & in_year).groupBy(key).agg(F.min(date).alias(out))


def random_month(key: str | Column, year: int, seed: int = 789) -> Column:
    """First day of a month that depends only on the id and the seed, not on partitioning."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(key.cast("string"), F.lit(str(seed))))
    month = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(12)) + 1
    return F.make_date(F.lit(year), month.cast("int"), F.lit(1))


def index_date(
    df: DataFrame, year: int = 2019, *, key: str = "cust_id", seed: int = 789, suffix: str = "19"
) -> DataFrame:
    """Last day of the month of the first candidate that holds: long stay, short stay, home care, death, random."""
    start = _day(f"{year}-01-01")
    chosen = first_match(
        [
            ((F.col(f"iltc_4m_{suffix}") == 1) & (F.col("min_iltc4_month") >= start), F.col("min_iltc4_month")),
            ((F.col(f"iltc_{suffix}") == 1) & (F.col("min_iltc_month") >= start), F.col("min_iltc_month")),
            ((F.col(f"hltc_{suffix}") == 1) & (F.col("min_hltc_month") >= start), F.col("min_hltc_month")),
            (F.col("death_dt").isNotNull() & (F.col("death_dt") >= start), F.col("death_dt")),
        ],
        random_month(key, year, seed),
    )
    return df.withColumn("index_dt", F.last_day(chosen))


def ltc_category_rules(
    now: str = "19", before: str = "1718", min_enrolled: int = 20, now_name: str = "2019", before_name: str = "17-18"
) -> list[tuple[Column, str]]:
    """The categories in order; ``now`` and ``before`` are column suffixes, their names go into the labels."""

    def on(name: str, period: str) -> Column:
        return F.col(f"{name}_{period}") == 1

    def off(name: str, period: str) -> Column:
        return F.col(f"{name}_{period}") == 0

    none_now = off("iltc", now) & off("hltc", now)
    return [
        ((F.col("months_enrolled") < min_enrolled) | off("utiliz", now), "Not in study"),
        (on("iltc_4m", now) & off("iltc_4m", before), f"ILTC long {now_name}, start {now_name}"),
        (on("iltc_4m", now) & on("iltc_4m", before), f"ILTC long {now_name}, start {before_name}"),
        (on("iltc", now) & off("iltc", before), f"ILTC short {now_name}, start {now_name}"),
        (on("iltc", now) & on("iltc", before), f"ILTC short {now_name}, start {before_name}"),
        (on("hltc", now) & off("hltc", before), f"HLTC {now_name}, start {now_name}"),
        (on("hltc", now) & on("hltc", before), f"HLTC {now_name}, start {before_name}"),
        (none_now & off("iltc", before) & off("hltc", before), f"No LTC {now_name}, nor {before_name}"),
        (none_now & (on("iltc", before) | on("hltc", before)), f"No LTC {now_name}, but LTC in {before_name}"),
    ]


def ltc_category(
    df: DataFrame, now: str = "19", before: str = "1718", min_enrolled: int = 20, now_name: str = "2019", before_name: str = "17-18"
) -> DataFrame:
    return label_rules(df, "ltc_cat", ltc_category_rules(now, before, min_enrolled, now_name, before_name))

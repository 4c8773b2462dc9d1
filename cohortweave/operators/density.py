"""Weighted densities of area variables by group."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.operators.spread import spread_join
from cohortweave.session import written

OVERALL = "NY Overall"


def density_input(
    members: DataFrame,
    geography: DataFrame,
    tracts: DataFrame,
    variables: list[str],
    *,
    key: str = "cust_id",
    group: str = "ltc_cat_simple",
    required: str = "ice_wb",
    population: str = "pop_total",
    overall: str = OVERALL,
) -> DataFrame:
    """(grouping_var, weight_tract, variable, value): members weigh 1, overall tract rows weigh their population.

    The area columns may sit on either side of the member-geography join.
    """
    own = spread_join(members, geography, key).where(F.col(required).isNotNull())
    columns = list(dict.fromkeys([*variables, population]))
    member_rows = own.select(F.col(group).cast("string").alias("grouping_var"), F.lit(1.0).alias("weight_tract"), *columns)
    tract_rows = tracts.select(
        F.lit(overall).alias("grouping_var"), F.col(population).cast("double").alias("weight_tract"), *columns
    )
    doubles = [F.col(v).cast("double").alias(v) for v in variables]
    wide = member_rows.unionByName(tract_rows).select("grouping_var", "weight_tract", *doubles)
    return wide.unpivot(["grouping_var", "weight_tract"], variables, "variable", "value")


SLIVER = 10_000


def _finite(value: str) -> Column:
    v = F.col(value).cast("double")
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(math.inf))


def _bounds(df: DataFrame, by: list[str], value: str, times: Column) -> DataFrame:
    v = F.col(value).cast("double")
    return df.where(_finite(value)).groupBy(*by).agg(
        F.min(v).alias("__lo"),
        F.max(v).alias("__hi"),
        F.sum(times).cast("long").alias("__n"),
        (F.sum(v * times) / F.sum(times)).alias("__mean"),
    )


#: Bits of the 64-bit image that each round leaves undecided: twelve are decided at a time.
UNDECIDED = (52, 40, 28, 16, 4, 0)


def ordered_image(value: Column) -> Column:
    """A long that orders finite doubles as they are ordered; -0.0 and 0.0 share one.

    The bits of a double's size, read from its exact hexadecimal text, ascend with the size;
    negative numbers get the negative.
    """
    text = F.format_string("%a", F.abs(value))
    fraction = F.substring_index(F.substring_index(text, "p", 1), ".", -1)
    exponent = F.substring_index(text, "p", -1).cast("long")
    normal = F.substring(text, 1, 4) == "0x1."
    bits = F.when(normal, (exponent + 1023) * F.lit(2**52)).otherwise(F.lit(0)) + F.conv(F.rpad(fraction, 13, "0"), 16, 10).cast("long")
    return F.when(value < 0, -bits).otherwise(bits)


def exact_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: list[float],
    *,
    count: str | None = None,
    bounds: DataFrame | None = None,
    sliver: int = SLIVER,
) -> DataFrame:
    """(by.., q0, q1, ..) linearly interpolated quantiles of groups of any size.

    ``count`` names a column saying how often a row's value occurs. Radix selection: each
    round counts the rows of the cells that still hold a wanted rank by the next twelve bits
    of the values' 64-bit images, so any finite data takes at most six rounds; as soon as no
    cell holds more than ``sliver`` rows, the next round is the last and tells values apart.
    A task holds cell counts, never a group. The ranks in search are written between rounds:
    that cuts the lineage. They are broadcast, being at most two per probability and group.
    Values that are null, NaN or infinite take no part.
    """
    times = F.lit(1) if count is None else F.col(count)
    bounds = _bounds(df, by, value, times) if bounds is None else bounds
    v = F.col(value).cast("double")
    base = df.where(_finite(value)).select(*by, v.alias("__v"), times.cast("long").alias("__t"), ordered_image(v).alias("__image"))
    base = written(base, "quantile-images")
    ranks = []
    for p in probs:
        h = (F.col("__n") - 1) * F.lit(float(p))
        ranks += [F.floor(h).cast("long"), F.ceil(h).cast("long")]
    rank = F.explode(F.array_distinct(F.array(*ranks))).alias("__rank")
    targets = bounds.select(*by, F.lit(0).cast("long").alias("__cell"), F.lit(0).cast("long").alias("__below"), "__n", rank, F.col("__n").alias("__size"))
    slot = [*by, "__cell", "__below"]
    # the cell of all values is 0; a shift by 64 bits is no shift, so it is not one
    cell, left = F.lit(0).cast("long"), 64
    while left:
        targets = written(targets, "ranks")
        largest = targets.agg(F.max("__size")).first()[0] or 0
        left = 0 if largest <= sliver else next(u for u in UNDECIDED if u < left)
        finer = F.shiftright("__image", left)
        slots = targets.select(*slot).distinct()
        inside = base.withColumn("__cell", cell).join(F.broadcast(slots), [*by, "__cell"])
        counted = inside.groupBy(*slot, finer.alias("__finer")).agg(
            F.sum("__t").alias("__c"), F.min("__v").alias("__value"), F.count(F.lit(1)).alias("__size")
        )
        order = Window.partitionBy(*slot).orderBy("__finer").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        counted = counted.withColumn("__upto", F.col("__below") + F.sum("__c").over(order))
        found = targets.drop("__size").join(counted, slot).where(
            (F.col("__rank") < F.col("__upto")) & (F.col("__rank") >= F.col("__upto") - F.col("__c"))
        )
        targets = found.select(
            *by, F.col("__finer").alias("__cell"), (F.col("__upto") - F.col("__c")).alias("__below"), "__n", "__rank", "__size", F.col("__value").alias("__lo")
        )
        cell = finer
    # at most two ranks per probability are left of each group
    table = targets.groupBy(*by, "__n").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__lo"))).alias("__at"))
    outputs = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1) * F.lit(float(p))
        low, high = F.col("__at")[F.floor(h).cast("long")], F.col("__at")[F.ceil(h).cast("long")]
        outputs.append((low + (high - low) * (h - F.floor(h))).alias(f"q{i}"))
    return table.select(*by, *outputs)


def bandwidths(counted: DataFrame, by: list[str], value: str, count: str, bounds: DataFrame) -> DataFrame:
    """(by.., n, bw) with bw = 0.9 * min(sd, IQR / 1.34) * n^-0.2, from values and how often each occurs.

    Where the smaller spread is 0 the next takes its place: sd, then the size of the
    lowest value, then 1. A single value counts as sd 0.
    """
    squares = F.sum(F.col(count) * F.pow(F.col(value) - F.col("__mean"), F.lit(2.0)))
    spread = counted.join(bounds, by).groupBy(*by, "__n", "__lo").agg(squares.alias("__squares"))
    quartiles = exact_quantiles(counted, by, value, [0.25, 0.75], count=count, bounds=bounds)
    joined = spread.join(quartiles, by)
    sd = F.sqrt(F.coalesce(F.try_divide(F.col("__squares"), F.col("__n") - 1), F.lit(0.0)))
    low = F.least(sd, (F.col("q1") - F.col("q0")) / F.lit(1.34))
    width = F.when(low > 0, low).when(sd > 0, sd).when(F.abs("__lo") > 0, F.abs("__lo")).otherwise(F.lit(1.0))
    n = F.col("__n").cast("double")
    return joined.select(*by, F.col("__n").alias("n"), (F.lit(0.9) * width * F.pow(n, F.lit(-0.2))).alias("bw"))


def weighted_density(
    df: DataFrame,
    variable: str = "variable",
    group: str = "grouping_var",
    value: str = "value",
    weight: str = "weight_tract",
    n: int = 512,
) -> DataFrame:
    """(variable, group, point, x, density): Gaussian density on n points over each variable's range.

    Equal values are summed up first and that table is written once, since every later step
    reads it: area values repeat for all people of an area. They are then binned linearly
    onto the grid, so each group ends up with at most n weights. Weights are normalised to 1
    in each group; a group without weight gives no rows. Rows whose value is null, NaN or
    infinite take no part.
    """
    by = [variable, group]
    known = df.where(_finite(value) & F.col(weight).isNotNull())
    counted = known.groupBy(*by, F.col(value).cast("double").alias("__value")).agg(
        F.count(F.lit(1)).alias("__times"), F.sum(weight).alias("__weight")
    )
    counted = written(counted, "density-values")
    bounds = written(_bounds(counted, by, "__value", F.col("__times")), "density-bounds")
    widths = written(bandwidths(counted, by, "__value", "__times", bounds), "density-widths")
    ranges = bounds.groupBy(variable).agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"))
    step = (F.col("__hi") - F.col("__lo")) / F.lit(n - 1)
    position = F.coalesce(F.try_divide(F.col("__value") - F.col("__lo"), step), F.lit(0.0))
    bin_no = F.least(F.floor(position), F.lit(n - 1)).cast("int")
    share = position - bin_no
    parts = F.array(
        F.struct(bin_no.alias("bin"), (F.col("__weight") * (F.lit(1.0) - share)).alias("w")),
        F.struct(F.least(bin_no + 1, F.lit(n - 1)).alias("bin"), (F.col("__weight") * share).alias("w")),
    )
    bins = (
        counted.join(ranges, variable)
        .select(*by, F.inline(parts))
        .groupBy(*by, "bin")
        .agg(F.sum("w").alias("w"))
        .where(F.col("w") != 0)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list(F.struct("bin", "w"))).alias("__bins"), F.sum("w").alias("__total"))
        .where(F.col("__total") > 0)
    )
    point = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("point")
    points = (
        bins.join(widths, by)
        .join(ranges, variable)
        .select(*by, "__bins", "__total", "bw", "__lo", step.alias("__step"), point)
    )

    def kernel(b):
        distance = (F.col("point") - b["bin"]) * F.col("__step") / F.col("bw")
        return b["w"] * F.exp(F.lit(-0.5) * distance * distance)

    kernel_sum = F.aggregate("__bins", F.lit(0.0), lambda total, b: total + kernel(b))
    return points.select(
        *by,
        "point",
        (F.col("__lo") + F.col("point") * F.col("__step")).alias("x"),
        (kernel_sum / (F.col("__total") * F.col("bw") * F.lit(math.sqrt(2 * math.pi)))).alias("density"),
    )

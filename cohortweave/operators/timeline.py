"""One row per person with a month bitmap per kind of care; flags, first months and stays are bit functions of it."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Months that one long holds.
MONTHS = 60


def _one() -> Column:
    return F.lit(1).cast("long")


def _shift(bits: Column, by: Column | int) -> Column:
    """Bits moved to later months, or to earlier ones by a negative number."""
    if isinstance(by, int):
        return F.shiftleft(bits, by) if by >= 0 else F.shiftright(bits, -by)
    return F.call_function("shiftleft", bits, by)


def _month_no(day: Column, first: dt.date) -> Column:
    return F.year(day) * 12 + F.month(day) - (first.year * 12 + first.month)


def month_bit(day: Column, first: dt.date, months: int) -> Column:
    """The bit of the day's month, counted from ``first`` on; no bit outside ``months`` of them or for NULL."""
    at = _month_no(day, first)
    return F.when(at.between(0, months - 1), _shift(_one(), at)).otherwise(F.lit(0).cast("long"))


def month_run(start: Column, end: Column, first: dt.date, months: int) -> Column:
    """The bits of all months from one day's to another's; only the first if the other is NULL or earlier."""
    low = F.greatest(_month_no(start, first), F.lit(0))
    high = F.least(_month_no(F.greatest(start, F.coalesce(end, start)), first), F.lit(months - 1))
    run = _shift(_one(), high - low + 1) - _one()
    return F.when(start.isNotNull() & (low <= high), _shift(run, low)).otherwise(F.lit(0).cast("long"))


def care_timeline(
    claims: DataFrame,
    points: dict[str, Column],
    stays: dict[str, Column],
    first: dt.date,
    months: int,
    *,
    key: str = "person_id",
    start: str = "claim_service_from_dt",
    end: str = "claim_service_to_dt",
    endpoints_only: bool = True,
) -> DataFrame:
    """(key, one bitmap per kind): the months in which a person had each kind of care.

    A claim sets the month it starts in for each condition of ``points`` that holds, and for
    those of ``stays`` the months it starts and ends in, or all between as well with
    ``endpoints_only=False``. One pass over the claims; bits are ORed map-side, so the shuffle
    carries a few longs per person however many claims there are.
    """
    if not 0 < months <= MONTHS:
        raise ValueError(f"a timeline has 1 to {MONTHS} months")
    begun = month_bit(F.col(start), first, months)
    if endpoints_only:
        lasted = begun.bitwiseOR(month_bit(F.col(end), first, months))
    else:
        lasted = month_run(F.col(start), F.col(end), first, months)
    none = F.lit(0).cast("long")
    bits = [F.bit_or(F.when(c, begun).otherwise(none)).alias(n) for n, c in points.items()]
    bits += [F.bit_or(F.when(c, lasted).otherwise(none)).alias(n) for n, c in stays.items()]
    return claims.groupBy(key).agg(*bits)


def merged(timelines: DataFrame, crosswalk: DataFrame, cust: str = "cust_id", person: str = "person_id") -> DataFrame:
    """Timelines of claim-side ids as timelines of customers, who may have several such ids."""
    kinds = [c for c in timelines.columns if c != person]
    pairs = crosswalk.select(cust, person).distinct()
    return pairs.join(timelines, person).groupBy(cust).agg(*[F.bit_or(k).alias(k) for k in kinds])


def mask(period: tuple[str, str], first: dt.date, months: int) -> int:
    """The bits of a period, which must begin and end with a month."""
    begin, end = (dt.date.fromisoformat(d) for d in period)
    if begin.day != 1 or (end + dt.timedelta(1)).day != 1:
        raise ValueError(f"{period} does not begin and end with a month")
    numbers = [d.year * 12 + d.month - first.year * 12 - first.month for d in (begin, end)]
    return sum(1 << i for i in range(max(numbers[0], 0), min(numbers[1], months - 1) + 1))


def any_in(bits: Column, wanted: int) -> Column:
    """0/1: is a month of the mask set; NULL bits count as none."""
    return F.when(bits.bitwiseAND(F.lit(wanted).cast("long")) != 0, 1).otherwise(0)


def first_month(bits: Column, first: dt.date) -> Column:
    """The first day of the earliest month set, NULL if there is none."""
    lowest = bits.bitwiseAND(-bits)
    return F.when(bits != 0, F.add_months(F.lit(first), F.bit_count(lowest - 1).cast("int")))


def long_stay_starts(snf: Column, nh: Column, min_months: int) -> Column:
    """The first months of stays of ``min_months`` or more.

    A stay is a run of months with skilled nursing or a nursing home; the skilled-nursing
    months that lead it do not count. Adding a run's first bit carries through just these, and
    a month begins ``min_months`` of a stay if it and the next ones are all set.
    """
    care = snf.bitwiseOR(nh)
    begins = care.bitwiseAND(F.bitwise_not(_shift(care, 1)))
    leading = snf.bitwiseAND(F.bitwise_not(snf + snf.bitwiseAND(begins)))
    counted = care.bitwiseAND(F.bitwise_not(leading))
    long = reduce(lambda a, b: a.bitwiseAND(b), [_shift(counted, -i) for i in range(min_months)])
    return long.bitwiseAND(F.bitwise_not(_shift(long, 1)))


def earliest(bits: Column) -> Column:
    return bits.bitwiseAND(-bits)

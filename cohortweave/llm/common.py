"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.session import tune, written

__all__ = ["mix", "prepare", "ranked_within", "read_table", "rows_of", "slots_frame", "unused", "written"]

#: Rows of one Arrow batch: whole documents, so few of them.
BATCH_ROWS = 500


def prepare(spark: SparkSession) -> SparkSession:
    """Session options that the operators are designed for."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """The name, with underscores before it until no column has it, in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser over unsigned longs: every input bit reaches every output bit."""
    x = values + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """The columns of each batch as Python lists."""
    for batch in batches:
        yield tuple(batch.column(i).to_pylist() for i in range(batch.num_columns))


def slots_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small table made on the driver; callers state what bounds its rows."""
    return F.broadcast(spark.createDataFrame(rows, schema))


def ranked_within(df: DataFrame, key: str, tie: str, counts: dict[int, int], rank: str) -> DataFrame:
    """Adds `rank`, gapless from 0 within each value of the integer `key`, in no set order.

    `df` is a written table and `tie` a unique number in it, so a recomputed task ranks every
    row as before. A key with more than its share of rows is cut into slices by a hash of the
    tie; a slice is ranked on its own and starts where the one before it ends. The two
    broadcast tables hold at most keys + shuffle partitions rows.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, math.ceil(sum(counts.values()) / parts))
    sizes = slots_frame(spark, [(k, math.ceil(n / share)) for k, n in counts.items()], "_key int, _slices int")
    sliced = (
        df.join(sizes, F.col(key) == F.col("_key"))
        .withColumn("_slice", F.pmod(F.xxhash64(tie), F.col("_slices")).cast("int"))
        .drop("_slices", key)
    )
    per_slice = sliced.groupBy("_key", "_slice").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_slice.select("_key", "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_key", "_slice").orderBy(tie)
    return (
        sliced.withColumn("_in", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), ["_key", "_slice"])
        .withColumn(rank, F.col("_start") + F.col("_in"))
        .withColumnRenamed("_key", key)
        .drop("_slice", "_start", "_in")
    )


def first_after(intervals: Column, upto: str, value: Column) -> Column:
    """The first of an ordered array of structs whose field `upto` is above the value."""
    return F.filter(intervals, lambda x: x[upto] > value)[0]


#: Words whose hashes a task keeps; beyond it the table starts anew.
KEPT_WORDS = 300_000
#: Words of a shingle.
SHINGLE = 5


class WordHashes(dict):
    """64-bit hashes of words, which are the parts of a text between ASCII white space."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, text: str | None, lower: bool = True) -> np.ndarray:
        words = ((text or "").lower() if lower else text or "").encode().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """The hash of every run of `size` words, in order.

    Fewer words make one shingle, of all of them; no words make none.
    """
    n = len(words)
    if n == 0:
        return words
    take = min(size, n)
    total, times = np.full(n - take + 1, take, np.uint64), factors(take)
    for i in range(take):
        total += words[i : n - take + 1 + i] * times[i]
    return mix(total, take)


def factors(n: int, seed: int = 0) -> np.ndarray:
    """n unrelated odd numbers: sums of words times them tell orders apart."""
    return mix(np.arange(n, dtype=np.uint64), 101 + seed) | np.uint64(1)

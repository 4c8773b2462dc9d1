"""Typed CSV and parquet readers, the stage writer and dated snapshot files."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NA = "NA"
HEADER_THREADS = 8


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _csv(spark: SparkSession):
    return spark.read.option("header", True).option("nullValue", NA).option("escape", '"')


def _escaped(text: Column) -> Column:
    """Text on one line that is never the NULL marker; every backslash starts an escape."""
    plain = F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
    return F.when(text == NA, F.lit("\\" + NA)).otherwise(plain)


def _restored(text: Column) -> Column:
    plain = F.replace(F.replace(F.replace(text, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")), F.lit("\\b"), F.lit("\\"))
    return F.when(text == "\\" + NA, F.lit(NA)).otherwise(plain)


def read_text_csv(spark: SparkSession, path: str | list[str], escaped: bool = False) -> DataFrame:
    """Header CSV as text columns; files whose header differs raise instead of shifting values.

    ``escaped`` reads what ``write_table`` wrote: text comes back as it was.
    """
    first = path if isinstance(path, str) else path[0]
    columns = _csv(spark).csv(first).columns
    raw = _csv(spark).schema(_text_schema(columns)).option("enforceSchema", False).csv(path)
    return raw.select(*[_restored(F.col(c)).alias(c) for c in columns]) if escaped else raw


def read_typed_csv(spark: SparkSession, path: str | list[str], types: dict[str, str], escaped: bool = False) -> DataFrame:
    """Header CSV with declared types by column name; text that does not fit a type becomes NULL.

    Columns without a declared type stay text, so ids keep their leading zeros. ``escaped``
    is for files of ``write_table``.
    """
    raw = read_text_csv(spark, path, escaped)
    missing = set(types) - set(raw.columns)
    if missing:
        raise ValueError(f"columns not in the file: {sorted(missing)}")
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def read_parquet_dates(spark: SparkSession, path: str, suffix: str = "_dt") -> DataFrame:
    """Parquet scan with every column ending in ``suffix`` as a date."""
    df = spark.read.parquet(path)
    return dates_by_suffix(df, suffix)


def dates_by_suffix(df: DataFrame, suffix: str = "_dt") -> DataFrame:
    def as_date(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.try_to_date(column)
        return column.cast("date")

    return df.withColumns(
        {f.name: as_date(f) for f in df.schema.fields if f.name.endswith(suffix) and f.dataType != T.DateType()}
    )


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write a stage result: CSV with a header, all values quoted and NA for NULL, or parquet.

    In CSV a line break in text is ``\\n`` or ``\\r``, a backslash ``\\b`` and the text NA
    ``\\NA``, so files can be read in splits and NULL stays apart from text. Outer blanks and
    empty text are kept.
    """
    if fmt == "csv":
        text = {f.name: _escaped(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        writer = df.withColumns(text).write.mode(mode).options(header=True, nullValue=NA, emptyValue="", escape='"', quoteAll=True)
        writer.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    elif fmt == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")


def snapshot_files(spark: SparkSession, folder: str, file_prefix: str) -> DataFrame:
    """(snapshot_dt, path, sample) of every file or folder of part files named ``<prefix>MMDDYYYY.csv`` below ``folder``.

    One row per date and place, however many part files there are; ``sample`` is one of them.
    Only the listing is read, never the content.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    root = F.regexp_extract("path", f"^(.*{file_prefix}(\\d{{8}})\\.csv)", 1)
    stamp = F.regexp_extract("path", f"{file_prefix}(\\d{{8}})\\.csv", 1)
    found = listed.where(stamp != "").groupBy(F.to_date(stamp, "MMddyyyy").alias("snapshot_dt"), root.alias("root"))
    return found.agg(F.min("path").alias("sample")).withColumnRenamed("root", "path")


def snapshot_lookup(
    keys: DataFrame,
    folder: str,
    *,
    key: str = "person_id",
    date: str = "score_dt",
    columns: list[str] | None = None,
    prefixes: list[str] | None = None,
    file_prefix: str = "Feature_df_",
    missing: str = "error",
) -> DataFrame:
    """For each (person, date) the person's row in the snapshot file of that date.

    Every needed file is read once with its own header, which all part files of a date share;
    dates with the same header share one scan and scans are united by column name, so
    reordered or absent columns are safe. The driver handles one row per date and place,
    bounded by calendar days, never part files or rows. A date without a file is an error, or
    yields no rows with ``missing="skip"``.
    """
    spark = keys.sparkSession
    wanted = keys.select(key, F.col(date).alias("snapshot_dt")).where(F.col(key).isNotNull()).distinct()
    files = snapshot_files(spark, folder, file_prefix)
    needed = wanted.select("snapshot_dt").distinct().join(files, "snapshot_dt", "left").collect()
    absent = sorted(r.snapshot_dt for r in needed if r.path is None and r.snapshot_dt is not None)
    if absent and missing == "error":
        raise FileNotFoundError(f"no snapshot for {absent}")

    present = [row for row in needed if row.path is not None]
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        headers = list(pool.map(lambda row: tuple(_csv(spark).csv(row.sample).columns), present))
    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for header, row in zip(headers, present):
        by_header[header].append(row.path)

    columns, prefixes = list(columns or []), tuple(prefixes or ())
    result = None
    for header, paths in sorted(by_header.items()):
        paths = sorted(paths)
        chosen = [c for c in header if c != key and (c in columns or (prefixes and c.startswith(prefixes)))]
        scan = (
            _csv(spark)
            .schema(_text_schema(list(header)))
            .option("enforceSchema", False)
            .csv(paths)
            .select(
                F.to_date(F.regexp_extract("_metadata.file_path", f"{file_prefix}(\\d{{8}})\\.csv", 1), "MMddyyyy").alias(
                    "snapshot_dt"
                ),
                key,
                *chosen,
            )
        )
        result = scan if result is None else result.unionByName(scan, allowMissingColumns=True)
    if result is None:
        return wanted.where(F.lit(False)).select("snapshot_dt", key)
    return result.join(wanted, [key, "snapshot_dt"], "left_semi")

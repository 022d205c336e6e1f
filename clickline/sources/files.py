"""Readers and writers for the CSV, Parquet and JSON files a run touches.

Writers that lay rows out by key use Spark's rebalance hint: rows of one key go to
the same file where they fit, and adaptive execution splits a key that holds far
more rows than the rest instead of giving all of them to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column as text; Spark only looks at the header line."""
    return spark.read.option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header, the schema's columns picked by name and typed.

    Columns are matched by name, so extra columns and another column order are fine and
    only the wanted ones are parsed. A value that does not fit its type becomes null.
    """
    text = read_csv_text(spark, path)
    return text.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def misfits(text: DataFrame, kinds: dict[str, T.DataType]) -> dict[str, int]:
    """How many values of each column of a table of text do not fit the type wanted. One job over the table."""
    counts = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()).alias(c) for c, kind in kinds.items()
    ]
    return text.agg(*counts).first().asDict()


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet stage directory."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def spread(df: DataFrame, key: str | None = None, files: int | None = None) -> DataFrame:
    """Lay rows out for a write: by ``key`` if given, into about ``files`` parts if given.

    Without ``files`` adaptive execution picks the number from the data size, which
    yields one file for a small result and many for a large one.
    """
    arguments = [a for a in (files, key) if a is not None]
    return df.hint("rebalance", *arguments)


def write_table(df: DataFrame, path: str, key: str | None = None, files: int | None = None) -> None:
    """Overwrite a Parquet stage directory.

    With ``key`` or ``files`` the rows are laid out by one more shuffle. Without them they are
    written from where they are, which suits tables whose readers shuffle them anyway.
    """
    laid_out = df if key is None and files is None else spread(df, key, files)
    laid_out.write.mode("overwrite").parquet(path)


def write_lookup_table(df: DataFrame, path: str, key: str, *then: str, files: int | None = None) -> None:
    """Overwrite a Parquet directory that serves lookups of single values of ``key``.

    Rows are sorted by ``key`` and ``then`` over ranges of both, so a dominant key spreads over many files and
    each value sits in few row groups and pages; Bloom filters tell which of those left hold a value at all. A reader
    that compares ``key`` with a literal of its stored type skips the rest.
    """
    order = [key, *then]
    ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
    _with_lookups(ranged.sortWithinPartitions(*order), key).mode("overwrite").parquet(path)


def write_grouped_for_lookup(df: DataFrame, path: str, key: str) -> None:
    """For rows whose equal ``key`` values already stand together, in whatever order: no shuffle and no sort. Lookups
    then rely on the Bloom filters and dictionaries of the row groups, not on their bounds."""
    _with_lookups(df, key).mode("overwrite").parquet(path)


def _with_lookups(df: DataFrame, key: str) -> DataFrameWriter:
    # Adaptive filters take the size that the row group's values need.
    return df.write.options(
        **{f"parquet.bloom.filter.enabled#{key}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    )


def write_small_table(df: DataFrame, path: str) -> None:
    """Overwrite a Parquet directory of a result expected to be small: one file if it is."""
    spread(df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Overwrite a CSV directory with a header in each file; ``files`` fixes their number."""
    laid_out = spread(df) if files is None else df.repartition(files)
    laid_out.write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    """Overwrite a JSON Lines directory."""
    spread(df).write.mode("overwrite").json(path)


def write_json_object(report: DataFrame, path: str) -> None:
    """Overwrite ``path`` with a one-row report as one indented JSON object."""
    _write_json(report.select(_as_struct(report).alias("value")), path)


def write_json_array(report: DataFrame, path: str, most: int, order: list[Column] | None = None) -> None:
    """Overwrite ``path`` with a report as one indented JSON array, sorted by ``order``.

    The array is one value, so a report of more than ``most`` rows is an error; it is never cut.
    """
    rows = (report.orderBy(*order) if order else report).limit(most + 1)
    value = F.collect_list(_as_struct(report))
    too_many = F.raise_error(F.lit(f"more than {most} rows for one JSON array: {path}"))
    _write_json(rows.coalesce(1).agg(F.when(F.count("*") > most, too_many).otherwise(value).alias("value")), path)


def _as_struct(report: DataFrame) -> Column:
    return F.struct(*[F.col(c) for c in report.columns])


def _write_json(value: DataFrame, path: str) -> None:
    options = {"pretty": "true", "ignoreNullFields": "false"}
    value.select(F.to_json("value", options).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save a table bucketed and sorted by ``key``: equal-bucket joins on it need no shuffle.

    Opt-in. A bucket is read by one task, so use it only where no key dominates.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def profile(df: DataFrame, user: str = "user_id", time: str = "timestamp") -> DataFrame:
    """One row: rows, distinct users, first and last time, nulls in both columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(user).alias("users"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
        F.count_if(F.col(user).isNull()).alias("null_users"),
        F.count_if(F.col(time).isNull()).alias("null_times"),
    )

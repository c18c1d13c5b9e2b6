"""Reading and writing tables on any Hadoop file system."""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paddock.sources.schemas import CLEAN, FILE_NAMES, RAW_ENCODINGS


def hadoop_path(spark: SparkSession, path: str):
    """A path and the file system it lies on."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return fs.exists(p)


def list_files(spark: SparkSession, folder: str, suffix: str) -> Iterator[tuple[str, str]]:
    """(name without suffix, full path) of the matching entries of a folder, by name."""
    p, fs = hadoop_path(spark, folder)
    found = [(s.getPath().getName(), s.getPath().toString()) for s in fs.listStatus(p)]
    return ((n.removesuffix(suffix), full) for n, full in sorted(found) if n.endswith(suffix))


def find_table(spark: SparkSession, folder: str, key: str) -> str:
    """Path of the first candidate file name that exists, each tried with underscores, then with blanks."""
    tried = []
    for name in FILE_NAMES[key]:
        for variant in dict.fromkeys([name, name.replace("_", " ")]):
            path = f"{folder.rstrip('/')}/{variant}"
            if exists(spark, path):
                return path
            tried.append(variant)
    raise FileNotFoundError(f"no file for '{key}' in {folder}; tried {tried}")


def _conform(raw: DataFrame, ddl: str) -> DataFrame:
    """Cast text columns to the declared types by name; undeclared columns stay text, absent ones are left out.

    A value that does not fit its declared type fails the job.
    """
    types = {f.name: f.dataType for f in T.StructType.fromDDL(ddl).fields}
    return raw.select(*[
        (F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")) for c in raw.columns
    ])


def read_csv(
    spark: SparkSession, path: str, ddl: str | None = None, *, encoding: str = "UTF-8", nulls: str = ""
) -> DataFrame:
    """CSV with header. Columns are matched to the schema by name, so their file order is free."""
    raw = (
        spark.read.option("header", True).option("encoding", encoding).option("nullValue", nulls)
        .option("escape", '"').option("mode", "FAILFAST").csv(path)
    )
    return _conform(raw, ddl) if ddl else raw


def load_table(spark: SparkSession, folder: str, key: str, *, encoding: str = "UTF-8") -> DataFrame:
    """A cleaned table: the Parquet folder of that name if there is one, else the CSV file."""
    stored = f"{folder.rstrip('/')}/{key}"
    if exists(spark, stored):
        return _conform(spark.read.parquet(stored), CLEAN[key])
    return read_csv(spark, find_table(spark, folder, key), CLEAN[key], encoding=encoding)


def load_all(spark: SparkSession, folder: str, *, encoding: str = "UTF-8") -> dict[str, DataFrame]:
    return {key: load_table(spark, folder, key, encoding=encoding) for key in FILE_NAMES}


def table_key(name: str) -> str:
    """The table that a raw file is named after: lapTimes, lap_times and Lap Times are all lap_times."""
    return re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name.strip()).replace(" ", "_").lower()


def load_raw(
    spark: SparkSession, folder: str, wanted: Collection[str], *, encodings: Mapping[str, str] = RAW_ENCODINGS,
    partial: bool = False,
) -> dict[str, DataFrame]:
    """The raw CSV files of a folder as text columns, by table.

    A file that is none of the wanted tables, and unless `partial` a table without a file, is an error.
    """
    found = {table_key(name): path for name, path in list_files(spark, folder, ".csv")}
    unknown, absent = sorted(found.keys() - set(wanted)), sorted(set(wanted) - found.keys())
    if unknown or (absent and not partial):
        raise FileNotFoundError(f"raw files in {folder}: not recognised {unknown}, absent {absent}")
    return {key: read_csv(spark, path, encoding=encodings.get(key, "UTF-8")) for key, path in found.items()}


def save_parquet(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Main output format: typed, splittable, pruned by partition.

    Rebalancing by the partition column keeps files few, and lets Spark split a value that holds much of
    the data over several tasks instead of writing it in one.
    """
    if partition_by:
        df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace those partitions of a stored table that `df` has rows of; the files of the others are not touched.

    The table may be there or not. Rows of one partition must all be in `df`.
    """
    rows = df.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy(partition_by).parquet(path)


def save_bucketed(df: DataFrame, name: str, path: str, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """Store a table in buckets of its keys, sorted within, as the catalogue table `name` over the folder `path`.

    Joins and windows by these keys then need no shuffle of it. Rows are dealt out by the keys first, so that each task writes
    its buckets whole: one file per bucket.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name)
    return df.sparkSession.table(name)


def open_bucketed(spark: SparkSession, name: str, path: str, ddl: str, keys: list[str], order: list[str], buckets: int) -> DataFrame:
    """A table that an earlier session has stored in buckets; the files do not say so themselves."""
    listed = lambda names: ", ".join(f"`{c}`" for c in names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet CLUSTERED BY ({listed(keys)}) "
              f"SORTED BY ({listed([*keys, *order])}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def save_csv(df: DataFrame, path: str, *, single_file: bool = False) -> None:
    """CSV with header. `single_file` is for report tables of a few rows only."""
    (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True).csv(path)


def load_parquet(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{folder.rstrip('/')}/{n}") for n in names}

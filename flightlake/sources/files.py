"""Text and Parquet sources, Parquet and CSV sinks."""

from __future__ import annotations

from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.contracts import CANONICAL_ORDER, CLEAN_KEY, COMPACT_COLUMNS, DASHBOARD_COLUMNS, RAW_COLUMNS

#: column of a written table with the row's place in its order
ROW_ID = "_row_id"
#: order of a clean table: its first column is the date, so a month's rows lie together
CLEAN_ORDER = [*CANONICAL_ORDER, *[c for c in CLEAN_KEY if c not in CANONICAL_ORDER]]
# File names looked for first in a raw folder.
PREFERRED_RAW_FILES = ["flights.csv", "flights_2024_01.csv"]


def _hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _hadoop_path(spark, path)
    return fs.exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, 0 where there is none."""
    target, fs = _hadoop_path(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def create_exclusively(spark: SparkSession, path: str) -> bool:
    """Create an empty file, False when it exists; where the store can, exactly one caller wins."""
    target, fs = _hadoop_path(spark, path)
    try:
        fs.create(target, False).close()
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers N of the entries `version=N` of a folder, rising."""
    target, fs = _hadoop_path(spark, folder)
    if not fs.exists(target):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(target)]
    return sorted(int(name.split("=")[1]) for name in names if name.startswith("version="))


def next_version(spark: SparkSession, path: str) -> int:
    """A version of `path` that no other writer has; claims are files in `_claims`."""
    version = max(versions(spark, f"{path}/_claims"), default=0)
    while True:
        version += 1
        if create_exclusively(spark, f"{path}/_claims/version={version}"):
            return version


def complete_version(spark: SparkSession, path: str, version: int, parts: list[str]) -> None:
    """The last write of a version: the names of the tables it consists of."""
    rows = spark.createDataFrame([(part,) for part in parts], "part string")
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/_versions/version={version}")


def newest_version(spark: SparkSession, path: str) -> tuple[int, list[str]] | None:
    """The highest complete version and its tables; versions without an entry do not count."""
    for version in reversed(versions(spark, f"{path}/_versions")):
        entry = f"{path}/_versions/version={version}"
        if path_exists(spark, f"{entry}/_SUCCESS"):
            return version, sorted(row["part"] for row in spark.read.parquet(entry).collect())
    return None


def find_raw_files(spark: SparkSession, folder: str) -> str:
    """A preferred raw file when present, else the folder's CSV glob, else an error.

    The remaining CSV files are read together instead of picking one of them.
    """
    for name in PREFERRED_RAW_FILES:
        if path_exists(spark, f"{folder}/{name}"):
            return f"{folder}/{name}"
    pattern, fs = _hadoop_path(spark, f"{folder}/*.csv")
    found = fs.globStatus(pattern)
    if not found:
        raise FileNotFoundError(f"No raw flight CSV found in {folder}.")
    return f"{folder}/*.csv"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, all columns text, empty cells null.

    Only the header line is looked at; there is no inference pass over the data.
    `enforceSchema=false` checks every file's header against the first one.
    """
    header = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return (
        spark.read.schema(header.schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("nullValue", "")
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str, *fallbacks: str) -> DataFrame:
    """First of the given Parquet locations that exists."""
    for candidate in (path, *fallbacks):
        if path_exists(spark, candidate):
            return spark.read.parquet(candidate)
    raise FileNotFoundError(f"No Parquet table at any of {[path, *fallbacks]}.")


def prune(df: DataFrame, columns: Iterable[str] = DASHBOARD_COLUMNS) -> DataFrame:
    """Project to the wanted columns that are present; the scan reads no others."""
    present = set(df.columns)
    return df.select(*[name for name in columns if name in present])


def layout_of(df: DataFrame) -> str:
    """`compact` or `standard`, from the column names alone."""
    return "compact" if "AIRLINE" in df.columns else "standard"


def expected_columns(layout: str) -> list[str]:
    return COMPACT_COLUMNS if layout == "compact" else RAW_COLUMNS


def write_clean_table(clean: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Publish a clean table: partitioned by month, canonical order inside.

    One range shuffle does everything: a month (or a single day) with most of
    the rows is cut over many tasks because the range key ends in the full
    natural key, and each task touches only one or two month folders.  Every row
    keeps its place in that order as ROW_ID: the task in the high bits, the position
    in the task's rows in the low 33.
    """
    write_ranged(clean.repartitionByRange("year", "month", *CLEAN_ORDER), path, mode)


def write_ranged(clean: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """`write_clean_table` for rows that lie in ranges of CLEAN_ORDER already."""
    (
        clean.sortWithinPartitions("year", "month", *CLEAN_ORDER)
        .withColumn(ROW_ID, F.monotonically_increasing_id())
        .write.mode(mode)
        .partitionBy("year", "month")
        .parquet(path)
    )


def read_clean_table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Clean table with its partition columns back in contract order."""
    table = spark.read.parquet(path).drop(ROW_ID)
    if columns is None:
        from flightlake.contracts import CLEAN_BASE_COLUMNS

        columns = [c for c in CLEAN_BASE_COLUMNS if c in table.columns] + [
            c for c in table.columns if c not in CLEAN_BASE_COLUMNS
        ]
    return table.select(*columns)


def write_report_csv(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Sink for rule results and profiles: a handful of rows, one CSV file."""
    report.coalesce(1).write.mode(mode).option("header", True).csv(path)


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    stamps = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps}) if stamps else df

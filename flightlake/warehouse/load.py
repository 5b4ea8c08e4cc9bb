"""Write-audit-publish loading of the star schema.

Layout: `<target>/<table>/load_id=<id>/...` for data and `<target>/_manifest/version=<n>`,
whose highest version names the loads that make up each table, with their rows.  A load
writes its files, audits them while they are written, and only then publishes the next
version: a failed load leaves the published one untouched, nothing is renamed, copied or
overwritten, and an increment adds its own files only.

A version has one winner.  Its number is claimed by an exclusive create before the manifest
is written; a loser reads the manifest again and builds on the winner's version.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flightlake.contracts import CANONICAL_ORDER, CLEAN_KEY, WAREHOUSE_REQUIRED
from flightlake.operators.ranks import dense_keys
from flightlake.operators.standard import missing_columns, missing_counts, raise_on_missing
from flightlake.sources.files import ROW_ID, create_exclusively, path_exists, versions
from flightlake.warehouse.dimensions import airline_dimension, airports_of, date_dimension, entities
from flightlake.warehouse.fact import fact_rows, stop_on_unmatched, unmatched

TABLES = ["dim_date", "dim_airline", "dim_airport", "fact_flight"]
FILE_ORDER = CANONICAL_ORDER + [c for c in CLEAN_KEY if c not in CANONICAL_ORDER]
#: how often a publisher tries, and how long it waits for a version that is claimed but not there yet
ATTEMPTS, WAIT_SECONDS = 5, 2.0
_MANIFEST = "table_name string, load_id string, rows bigint, batch_id string"


@dataclass(frozen=True)
class Star:
    dim_date: DataFrame
    dim_airline: DataFrame
    dim_airport: DataFrame
    fact_flight: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLES}


@dataclass(frozen=True)
class Published:
    """A version of the manifest: per table the rows of each load."""

    version: int
    loads: dict[str, dict[str, int]]

    def rows(self, table: str) -> int:
        return sum(self.loads.get(table, {}).values())


class VersionTaken(RuntimeError):
    """Another publisher claimed the version first."""


def validate_load_input(clean: DataFrame) -> None:
    missing = missing_columns(clean, WAREHOUSE_REQUIRED)
    if missing:
        raise ValueError(f"the clean table lacks columns of the warehouse: {missing}")


def load_counts(star: Star) -> DataFrame:
    """(table_name, row_count) of the four tables."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in star.tables().items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def published(spark: SparkSession, target: str) -> Published:
    """The current version; version 0 without loads where nothing was published."""
    for version in reversed(versions(spark, f"{target}/_manifest")):
        entry = f"{target}/_manifest/version={version}"
        if path_exists(spark, f"{entry}/_SUCCESS"):
            rows = spark.read.schema(_MANIFEST).parquet(entry).collect()  # a row per load and table
            loads = {name: {r["load_id"]: r["rows"] for r in rows if r["table_name"] == name} for name in TABLES}
            return Published(version, loads)
    return Published(0, {})


def batch_rows(spark: SparkSession, target: str, batch: str) -> int | None:
    """Fact rows that a batch has added to some version, None when no version holds it."""
    if not path_exists(spark, f"{target}/_manifest"):
        return None
    mine = spark.read.schema(_MANIFEST).parquet(f"{target}/_manifest").filter(F.col("batch_id") == batch)
    facts = F.coalesce(F.max(F.when(F.col("table_name") == "fact_flight", F.col("rows"))), F.lit(0))
    return mine.agg(F.when(F.count(F.lit(1)) > 0, facts)).first()[0]


def publish(
    spark: SparkSession, target: str, version: int, loads: dict[str, dict[str, int]], load_id: str = "", batch: str | None = None
) -> None:
    """Publish `version`, once; raises VersionTaken when another publisher has claimed it.

    The tables of `load_id` are marked with `batch`, so that a replay of the batch is recognised.
    """
    if not create_exclusively(spark, f"{target}/_claims/version={version}"):
        raise VersionTaken(f"version {version} of {target}")
    rows = [
        (name, each, count, batch if each == load_id else None) for name, ids in loads.items() for each, count in ids.items()
    ]
    entry = spark.createDataFrame(rows, _MANIFEST).coalesce(1)
    entry.write.mode("errorifexists").parquet(f"{target}/_manifest/version={version}")


def publishing(spark: SparkSession, target: str, build: Callable[[Published], None]) -> None:
    """Run `build` on the current version until it has published the next one."""
    for attempt in range(ATTEMPTS):
        current = published(spark, target)
        try:
            return build(current)
        except VersionTaken:
            if attempt == ATTEMPTS - 1:
                raise RuntimeError(
                    f"version {current.version + 1} is claimed in {target}/_claims and was never published; "
                    "delete the claim if its writer is dead"
                ) from None
            if published(spark, target).version == current.version:
                time.sleep(WAIT_SECONDS)  # the winner is still writing its manifest


def load_path(target: str, table: str, load_id: str) -> str:
    return f"{target}/{table}/load_id={load_id}"


def read_loads(spark: SparkSession, target: str, loads: dict[str, dict[str, int]]) -> Star:
    frames = {}
    for name in TABLES:
        paths = [load_path(target, name, load_id) for load_id in loads[name]]
        frame = spark.read.option("basePath", f"{target}/{name}").parquet(*paths)
        frames[name] = frame.drop("load_id")
    return Star(**frames)


def open_star(spark: SparkSession, target: str) -> Star:
    """The currently published star schema."""
    current = published(spark, target)
    if not current.loads:
        raise FileNotFoundError(f"no star schema was published at {target}")
    return read_loads(spark, target, current.loads)


def write_counted(frame: DataFrame, path: str, *partition_by: str) -> int:
    """Write a table and return its rows, counted by the writing tasks."""
    seen = Observation()
    writer = frame.observe(seen, F.count(F.lit(1)).alias("rows")).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return seen.get["rows"]


def write_facts(facts: DataFrame, path: str) -> int:
    """Write fact rows by month; raises when one lacks a dimension row.  Both are counted by the write."""
    seen = Observation()
    observed = facts.observe(seen, F.count(F.lit(1)).alias("rows"), unmatched().alias("unmatched"))
    observed.write.partitionBy("year", "month").parquet(path)
    stop_on_unmatched(seen.get["unmatched"])
    return seen.get["rows"]


def write_star(spark: SparkSession, clean_path: str, target: str, load_id: str) -> dict[str, dict[str, int]]:
    """Build and write dimensions, then the fact, from a published clean table; rows per table.

    The clean table is read three times: for what the dimensions hold (missing values are
    counted on the way), for the rows of each write task, and for the fact.  The fact is
    written straight from the scan: the files are split by month, so no row is shuffled.
    """
    clean = spark.read.parquet(clean_path)
    seen = Observation()
    dates, airlines, airports = entities(clean.observe(seen, *missing_counts()))
    raise_on_missing(seen.get, "the warehouse needs these values")
    dimensions = {
        "dim_date": date_dimension(dates),
        "dim_airline": airline_dimension(airlines),
        "dim_airport": airports_of(airports),
    }
    loads = {
        name: {load_id: write_counted(frame, load_path(target, name, load_id))} for name, frame in dimensions.items()
    }
    airline_keys = spark.read.parquet(load_path(target, "dim_airline", load_id))
    airport_keys = spark.read.parquet(load_path(target, "dim_airport", load_id))
    keyed, source = dense_keys(clean, ROW_ID, "flight_key")
    facts = fact_rows(keyed, airline_keys, airport_keys, ["flight_key", "year", "month"])
    written = write_facts(facts, load_path(target, "fact_flight", load_id))
    if source != written:
        raise RuntimeError(f"{written:,} fact rows were written from {source:,} clean rows")
    return {**loads, "fact_flight": {load_id: written}}


def load_warehouse(
    spark: SparkSession, clean_path: str, target: str, replace: bool = False
) -> DataFrame:
    """Full load of a clean table; returns the table counts."""
    validate_load_input(spark.read.parquet(clean_path))

    def guard(current: Published) -> None:
        if current.rows("fact_flight") and not replace:
            raise RuntimeError(
                f"{target} already holds {current.rows('fact_flight'):,} fact rows; a full reload needs replace=True"
            )

    guard(published(spark, target))  # before the work; asked again for every version that may win
    loads = write_star(spark, clean_path, target, uuid.uuid4().hex)

    def build(current: Published) -> None:
        guard(current)
        publish(spark, target, current.version + 1, loads)

    publishing(spark, target, build)
    return load_counts(read_loads(spark, target, loads))

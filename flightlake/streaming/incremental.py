"""Monthly increments into a published star schema.

One batch = one month of raw records.  Its content fingerprint is compared with
the ledger first, dimensions are upserted (or made, for an empty target), only facts
with a new natural key are written, under dense keys after the highest, and the
manifest moves last.  `stream_folder` drives the same batch function from a file stream.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from flightlake.contracts import CLEAN_KEY, FACT_NATURAL_KEY
from flightlake.functions.metrics import count_where, not_false
from flightlake.operators.clean import clean_flights
from flightlake.operators.duplicates import repeated_keys
from flightlake.operators.ranks import dense_keys
from flightlake.session import stage_path, staged
from flightlake.sources.files import ROW_ID, path_exists, read_clean_table, write_clean_table
from flightlake.warehouse.dimensions import airline_dimension, airports_of, date_dimension, entities, upsert
from flightlake.warehouse.fact import fact_rows
from flightlake.warehouse.load import (
    Published,
    Star,
    batch_rows,
    load_path,
    publish,
    publishing,
    read_loads,
    write_counted,
    write_facts,
)

LEDGER_SCHEMA = (
    "batch_id string, fingerprint string, reporting_year int, reporting_month int, "
    "source_row_count bigint, loaded_row_count bigint, status string, error_message string, "
    "loaded_at timestamp"
)


def fingerprint(raw: DataFrame) -> str:
    """Content hash of a batch that ignores file names, file count and row order.

    Two independent row hashes are summed and xor-ed in one distributed
    aggregate, so no file is ever read into one task as a whole.  The hashes skip
    nulls, so each value is preceded by whether it is one; names are part of it.
    """
    names = sorted(raw.columns)
    columns = [c for n in names for c in (F.col(n).isNull(), F.col(n).cast("string"))]
    one = F.xxhash64(F.lit("|".join(names)), *columns)
    marked = [F.coalesce(F.concat(F.lit("="), F.col(n).cast("string")), F.lit("-")) for n in names]
    two = F.conv(F.substring(F.md5(F.to_json(F.array(F.lit("|".join(names)), *marked))), 1, 15), 16, 10).cast("bigint")
    row = raw.select(one.alias("a"), two.alias("b")).agg(
        F.count(F.lit(1)).cast("string"),
        F.sum(F.col("a").cast("decimal(38,0)")).cast("string"),
        F.bit_xor("a").cast("string"),
        F.sum(F.col("b").cast("decimal(38,0)")).cast("string"),
        F.bit_xor("b").cast("string"),
    )
    return row.select(F.sha2(F.concat_ws("|", *row.columns), 256)).first()[0]


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    path = f"{target}/load_batch"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path)


def _record(spark: SparkSession, target: str, **fields) -> None:
    row = spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in fields.items()], F.current_timestamp().alias("loaded_at")
    )
    names = [part.split()[0] for part in LEDGER_SCHEMA.split(", ")]
    kinds = dict(part.split() for part in LEDGER_SCHEMA.split(", "))
    row = row.select(
        *[(F.col(n) if n in row.columns else F.lit(None)).cast(kinds[n]).alias(n) for n in names]
    )
    row.coalesce(1).write.mode("append").parquet(f"{target}/load_batch")


def is_loaded(spark: SparkSession, target: str, mark: str) -> bool:
    done = read_ledger(spark, target).filter(
        (F.col("fingerprint") == mark) & (F.col("status") == "complete")
    )
    return not done.isEmpty()


def new_facts(facts: DataFrame, existing: DataFrame, period: tuple[int, int] | None = None) -> DataFrame:
    """Facts whose natural key is not in `existing`.

    Only the months of the batch are compared.  With `period`, the one (year, month) that
    all facts have, the partition columns are compared with literals, so the files of
    other months are not even listed.
    """
    if period is not None:
        same = existing.filter((F.col("year") == period[0]) & (F.col("month") == period[1]))
        return facts.join(same.select(*FACT_NATURAL_KEY), FACT_NATURAL_KEY, "left_anti")
    months = facts.select("year", "month").distinct()
    same_months = existing.join(months, ["year", "month"], "left_semi")
    return facts.join(same_months.select(*FACT_NATURAL_KEY), FACT_NATURAL_KEY, "left_anti")


def _write_dimensions(star: Star | None, clean: DataFrame, target: str, batch: str) -> dict[str, dict[str, int]]:
    """Next version of the three dimensions, known keys kept; rows per table."""
    dates, airlines, airports = entities(clean)
    fresh = {"dim_date": date_dimension(dates), "dim_airline": airline_dimension(airlines), "dim_airport": airports_of(airports)}
    if star is not None:
        fresh = {
            "dim_date": upsert(star.dim_date, fresh["dim_date"], "date_key"),
            "dim_airline": upsert(
                star.dim_airline, fresh["dim_airline"].drop("airline_key"), "reporting_airline_id", "airline_key"
            ),
            "dim_airport": upsert(star.dim_airport, fresh["dim_airport"].drop("airport_key"), "airport_id", "airport_key"),
        }
    return {name: {batch: write_counted(frame, load_path(target, name, batch))} for name, frame in fresh.items()}


def _check_batch(clean: DataFrame, year: int, month: int) -> int:
    """Rows of the batch, once it is known to be one month with unique keys."""
    outside = not_false((F.col("year") != year) | (F.col("month") != month))
    found = clean.agg(F.count(F.lit(1)).alias("n"), count_where(outside).alias("outside")).first()
    if found["outside"]:
        raise ValueError(f"{found['outside']:,} rows are outside {year}-{month:02d}.")
    if not repeated_keys(clean, CLEAN_KEY).isEmpty():
        raise ValueError("The batch repeats a flight key with different values.")
    return found["n"]


def _append(clean: DataFrame, target: str, batch: str, period: tuple[int, int]) -> int:
    """Write and publish the new facts of a clean month; returns how many there are.

    The rows held before come from the manifest; keys are dense, so they are the highest key too.
    A publisher that lost its version starts again from the winner's, under a new load name.
    """
    spark = clean.sparkSession
    added = 0

    def build(current: Published) -> None:
        nonlocal added
        name = uuid.uuid4().hex  # what a loser or a killed attempt has written stays unpublished
        star = read_loads(spark, target, current.loads) if current.loads else None
        after = _write_dimensions(star, clean, target, name)
        airlines, airports = (spark.read.parquet(load_path(target, t, name)) for t in ("dim_airline", "dim_airport"))
        facts = fact_rows(clean, airlines, airports, ["year", "month"])
        fresh = facts if star is None else new_facts(facts, star.fact_flight, period)
        order = list(FACT_NATURAL_KEY)
        sorted_ = fresh.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(ROW_ID, F.monotonically_increasing_id())
        keyed, expected = dense_keys(staged(sorted_, "batch_facts"), ROW_ID, "flight_key", current.rows("fact_flight"))
        after["fact_flight"] = dict(current.loads.get("fact_flight", {}))
        if not expected and star is None:
            raise ValueError("a batch without flights cannot start a warehouse")
        added = write_facts(keyed, load_path(target, "fact_flight", name)) if expected else 0
        if added != expected:
            raise RuntimeError(f"{added:,} fact rows were written, {expected:,} are new")
        if added:
            after["fact_flight"][name] = added
        publish(spark, target, current.version + 1, after, name, batch)

    publishing(spark, target, build)
    return added


def load_batch(raw: DataFrame, target: str, year: int, month: int, batch: str | None = None) -> str:
    """Load one month; returns `complete`, `skipped` or raises after recording the failure.

    `batch` names the delivery: a batch that some version already holds is not loaded again,
    whatever became of its ledger entry.
    """
    spark = raw.sparkSession
    mark = fingerprint(raw)
    common = {"fingerprint": mark, "reporting_year": year, "reporting_month": month}
    known = batch_rows(spark, target, batch) if batch else None
    if is_loaded(spark, target, mark):
        return "skipped"
    if known is not None:  # published, then lost before its ledger entry
        _record(spark, target, **common, batch_id=batch, loaded_row_count=known, status="complete")
        return "skipped"
    batch = batch or uuid.uuid4().hex
    common["batch_id"] = batch
    try:
        clean_path = stage_path(spark, "batch_clean")
        write_clean_table(clean_flights(raw, month=month), clean_path)
        clean = read_clean_table(spark, clean_path)
        rows = _check_batch(clean, year, month)
        added = _append(clean, target, batch, (year, month))
    except Exception as error:
        _record(spark, target, **common, status="failed", error_message=str(error))
        raise
    _record(
        spark,
        target,
        **common,
        source_row_count=rows,
        loaded_row_count=added,
        status="complete",
    )
    return "complete"


def landed(batch: DataFrame, path: str) -> DataFrame:
    """The batch written to `path` once; a replay reads what was landed and not the source."""
    spark = batch.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        batch.write.mode("overwrite").parquet(path)
    return spark.read.schema(batch.schema).parquet(path)


def stream_folder(
    spark: SparkSession, folder: str, schema, target: str, checkpoint: str
) -> StreamingQuery:
    """Load every new monthly CSV of a folder, then stop (one file per micro-batch).

    The stream's checkpoint remembers files by name, the ledger by content, so a renamed copy
    is skipped.  A micro-batch is landed once and published under an id made of the stream and
    its number: a batch that was cut short is taken up from what was landed, one that was
    published before the cut is recognised by its id.
    """
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        name = f"{stream}-{number}"
        rows = landed(batch, f"{target}/_landing/batch={name}")
        months = rows.select("YEAR", "MONTH").distinct().limit(2).collect()
        if not months:
            return
        if len(months) > 1:
            raise ValueError("A monthly file must hold one month.")
        load_batch(rows, target, int(months[0]["YEAR"]), int(months[0]["MONTH"]), name)

    source = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("nullValue", "")
        .option("maxFilesPerTrigger", 1)
        .csv(folder)
    )
    return (
        source.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

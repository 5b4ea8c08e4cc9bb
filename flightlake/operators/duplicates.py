"""Duplicate counts without shuffling whole rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.session import staged


def repeated_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Key groups that hold more than one row, with their row count `rows`."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def row_digest(df: DataFrame) -> dict[str, Column]:
    """Two 64-bit hashes of a whole row by name; rows that are equal, nulls included, have equal ones."""
    # a hash passes over nulls, so where they are is hashed too
    nulls = [F.col(c).isNull() for c in df.columns]
    cells = [F.col(c) for c in df.columns]
    return {f"_digest{i}": F.xxhash64(F.lit(i), *cells, *nulls) for i in (1, 2)}


def _matching(df: DataFrame, found: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key, nulls included, is among those found."""
    renamed = found.select(*[F.col(k).alias(f"_{k}") for k in key])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key])
    return df.join(renamed, same, "left_semi")


def distinct_rows(first: DataFrame, df: DataFrame | None = None) -> DataFrame:
    """Distinct rows, where only rows whose digest repeats are shuffled whole.

    One job finds the repeated digests, 8 bytes a row.  Rows of a repeated digest are compared in
    full, so a digest that different rows share costs a comparison and never a row.  `first` is
    read by that job and `df`, the same rows, by the result: so `first` can be observed once.
    """
    df = first if df is None else df
    digests = dict(list(row_digest(df).items())[:1])
    repeated = staged(repeated_keys(first.select(*[c.alias(n) for n, c in digests.items()]), list(digests)).drop("rows"), "repeated_digests")
    if repeated.isEmpty():
        return df
    marked = df.withColumns(digests)
    single = marked.join(repeated, list(digests), "left_anti").select(*df.columns)
    return single.unionByName(_matching(marked, repeated, list(digests)).select(*df.columns).dropDuplicates())


def duplicate_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: exact_duplicates (n-1 per group), duplicate_key_rows (all n), repeated_keys.

    Rows that are equal everywhere are equal on the key and in their digest.  The repeated
    keys are written first; their rows are counted by digest, 16 bytes each, and only rows
    whose digest repeats are shuffled whole and compared in full, so a digest that different
    rows share costs a comparison and never a wrong count.  Both small tables have a known
    file size, so they are broadcast while they are small.  All aggregates combine before
    their shuffle, so a group of copies with a third of all rows arrives as one row per task.
    """
    repeated = staged(repeated_keys(df, key), "repeated_keys")
    digests = row_digest(df)
    marked = df.withColumns(digests)
    suspects = staged(repeated_keys(_matching(marked, repeated, key), list(digests)).drop("rows"), "repeated_digests")
    exact = (
        _matching(marked, suspects, list(digests)).groupBy(*df.columns)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("exact_duplicates"))
    )
    by_key = repeated.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("duplicate_key_rows"),
        F.count(F.lit(1)).alias("repeated_keys"),
    )
    return by_key.select(
        exact.scalar().alias("exact_duplicates"), "duplicate_key_rows", "repeated_keys"
    )

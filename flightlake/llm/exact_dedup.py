"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts are equal when they are identical after lower-casing A to Z; null counts as empty.

1. Rows are written once, in blocks that keep their place (a table bucketed by block).
2. A block sorts the distinct fingerprints of its texts (48 bits) and sends each owner, who
   holds a range of the fingerprints, the gaps between them in a Golomb-Rice code.
3. Owners mark what more than one block sent and answer each block with a bitmap; a block adds
   what repeats inside it.  Bitmaps meet the blocks bucket by bucket, so no text moves for that.
4. Only the texts of marked rows, the suspects, are shuffled, combined before the shuffle, and
   compared byte for byte.  A wrongly marked row costs a shuffled text, never a wrong result.

A text that a third of all rows share sends one fingerprint and at most one text a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.session import stage_path, staged

FINGERPRINT_BITS = 48
#: rows of a block as a power of two: what one task sorts at a time
BLOCK_BITS = 16
#: rows for each owner, and the least and largest number of owners: a message should hold some
#: dozens of fingerprints, and an owner what fits into one task (12 million at 5 * 10**10 rows)
OWNER_ROWS, OWNERS = 1 << 16, (16, 4096)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MESSAGE = "owner int, block long, n int, k int, high binary, low binary"


def golomb_encode(values: np.ndarray, base: int) -> tuple[int, bytes, bytes]:
    """(k, quotients, remainders) of rising distinct numbers >= base, as gaps in a Golomb code of 2**k.

    Quotients are unary, remainders have k bits; both streams decode without a loop.
    """
    gaps = np.diff(values.astype(np.int64), prepend=base - 1) - 1
    k = max(int(gaps.mean() * 0.69), 1).bit_length() - 1
    high = gaps >> k
    unary = np.zeros(int(high.sum()) + len(gaps), bool)
    unary[np.cumsum(high + 1) - 1] = True
    low = (gaps[:, None] >> np.arange(k - 1, -1, -1)) & 1
    return k, np.packbits(unary).tobytes(), np.packbits(low.astype(bool).ravel()).tobytes()


def golomb_decode(n: int, base: int, k: int, high: bytes, low: bytes) -> np.ndarray:
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(high, np.uint8)))[:n]
    gaps = (np.diff(ones, prepend=-1) - 1).astype(np.int64) << k
    if k:
        bits = np.unpackbits(np.frombuffer(low, np.uint8), count=n * k).reshape(n, k).astype(np.int64)
        gaps += bits @ (np.int64(1) << np.arange(k - 1, -1, -1))
    return np.cumsum(gaps + 1) + base - 1


def _bits(flags: np.ndarray) -> pa.Array:
    """One list of longs: bit i % 64 of long i // 64 is flag i."""
    packed = np.packbits(flags, bitorder="little")
    words = np.zeros(-(-len(flags) // 64) * 8, np.uint8)
    words[: len(packed)] = packed
    return pa.array([words.view(np.int64)], pa.list_(pa.int64()))


def _is_set(words: Column, place: Column) -> Column:
    word = F.get(words, F.shiftright(place, 6))
    return F.call_function("shiftrightunsigned", word, place.bitwiseAND(63)).bitwiseAND(F.lit(1)) == 1


def _by_owner(prints: np.ndarray, shift: int) -> Iterator[tuple[int, np.ndarray]]:
    """Rising distinct fingerprints cut at the owners' ranges."""
    owners = prints >> shift
    cuts = np.flatnonzero(np.diff(owners)) + 1
    for part in np.split(prints, cuts) if len(prints) else []:
        yield int(part[0] >> shift), part


def _sender(shift: int):
    def send(block: pa.Table) -> pa.Table:
        prints = np.unique(block.column("print").to_numpy())
        rows = [
            (owner, len(part), *golomb_encode(part, owner << shift)) for owner, part in _by_owner(prints, shift)
        ]
        owner, n, k, high, low = zip(*rows)
        ids = pa.array([block.column("block")[0].as_py()] * len(rows), pa.int64())
        return pa.table(
            [pa.array(owner, pa.int32()), ids, pa.array(n, pa.int32()), pa.array(k, pa.int32()),
             pa.array(high, pa.binary()), pa.array(low, pa.binary())],
            names=["owner", "block", "n", "k", "high", "low"],
        )

    return send


def _owner(shift: int):
    def answer(messages: pa.Table) -> pa.Table:
        base = messages.column("owner")[0].as_py() << shift
        columns = [messages.column(c).to_pylist() for c in ("n", "k", "high", "low")]
        parts = [golomb_decode(n, base, k, high, low) for n, k, high, low in zip(*columns)]
        values, counts = np.unique(np.concatenate(parts), return_counts=True)
        shared = values[counts > 1]
        maps = []
        for part in parts:
            at = np.searchsorted(shared, part)
            hit = at < len(shared)
            hit[hit] = shared[at[hit]] == part[hit]
            maps.append(np.packbits(hit).tobytes())
        return pa.table([messages.column("owner"), messages.column("block"), pa.array(maps, pa.binary())], names=["owner", "block", "marks"])

    return answer


def _receiver(shift: int):
    def receive(block: pa.Table, answers: pa.Table) -> pa.Table:
        if not block.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.list_(pa.int64()))], names=["block", "words"])
        prints, back, counts = np.unique(block.column("print").to_numpy(), return_inverse=True, return_counts=True)
        of = dict(zip(answers.column("owner").to_pylist(), answers.column("marks").to_pylist()))
        marks = [
            np.unpackbits(np.frombuffer(of[owner], np.uint8), count=len(part)) for owner, part in _by_owner(prints, shift)
        ]
        suspect = (np.concatenate(marks) > 0) | (counts > 1)
        flags = np.zeros(1 << BLOCK_BITS, bool)
        flags[block.column("place").to_numpy()] = suspect[back]
        return pa.table([pa.array([block.column("block")[0].as_py()], pa.int64()), _bits(flags)], names=["block", "words"])

    return receive


def _places(block: pa.Table) -> pa.Table:
    flags = np.zeros(1 << BLOCK_BITS, bool)
    flags[block.column("place").to_numpy()] = True
    return pa.table([block.column("block").slice(0, 1).combine_chunks(), _bits(flags)], names=["block", "words"])


def _normal(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)


def _in_blocks(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in a table bucketed by block: block, place, row (the columns), digest, print."""
    spark = docs.sparkSession
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        _normal(F.col("text")).alias("text"),
        F.monotonically_increasing_id().alias("at"),
    ).select(
        F.shiftright("at", BLOCK_BITS).alias("block"),
        F.col("at").bitwiseAND((1 << BLOCK_BITS) - 1).cast("int").alias("place"),
        "row",
        F.sha2("text", 256).alias("digest"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - FINGERPRINT_BITS).alias("print"),
    )
    path = stage_path(spark, "exact_blocks")
    name = path.rsplit("/", 1)[-1].replace("-", "_").replace(".", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "block").option("path", path).saveAsTable(name)
    return spark.table(name)


def _suspects(table: DataFrame) -> DataFrame:
    """(block, words): for every block the places of rows whose fingerprint repeats."""
    rows = table.agg(F.count(F.lit(1))).first()[0]
    owners = 1 << (min(max(rows // OWNER_ROWS, OWNERS[0]), OWNERS[1]) - 1).bit_length()
    shift = FINGERPRINT_BITS - owners.bit_length() + 1
    prints = table.select("block", "place", "print")
    messages = prints.groupBy("block").applyInArrow(_sender(shift), _MESSAGE)
    answers = messages.groupBy("owner").applyInArrow(_owner(shift), "owner int, block long, marks binary")
    flags = prints.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_receiver(shift), "block long, words array<long>")
    return staged(flags, "exact_suspects")


def _marked(table: DataFrame) -> DataFrame:
    """block, place, id, digest, keep_id, group_size, kept of every row of the table."""
    words = _suspects(table).hint("shuffle_hash")
    rows = table.withColumn("id", F.col("row.doc_id").cast("long"))
    suspects = rows.join(words, "block").filter(_is_set(F.col("words"), F.col("place")))
    # equal bytes, combined before the shuffle; the keeper is the largest id, of equal ids the last place
    texts = suspects.withColumn("text", _normal(F.col("row.text")))
    groups = texts.groupBy("print", "text", "digest").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "block", "place")).alias("keeper")
    )
    verdicts = staged(groups.filter("group_size > 1").select("digest", "group_size", "keeper"), "exact_groups")
    # back to the rows by way of the blocks: a common text has one line a block
    held = suspects.select("block", "digest").distinct()
    answers = held.join(verdicts, "digest")
    rows = rows.select("block", "place", "id", "digest").join(answers, ["block", "digest"], "left")
    stays = (F.col("keeper.block") == F.col("block")) & (F.col("keeper.place") == F.col("place"))
    alone = F.col("keeper").isNull()
    return rows.select(
        "block", "place", "id", "digest",
        F.when(alone, F.col("id")).otherwise(F.col("keeper.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | stays).alias("kept"),
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest doc_id stays, a null id being smaller than all
    others; of rows that repeat that id too, exactly one.  A null text counts as empty and
    equals other empty ones.  text_sha256 is the digest of the lower-cased text.  Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """
    marked = _marked(_in_blocks(docs, ["doc_id", "text"]))
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns; see `exact_groups`.

    Rows go by bitmaps of their blocks, so those that stay are not shuffled.
    """
    table = _in_blocks(docs, docs.columns)
    lost = _marked(table).filter("NOT kept").select("block", "place")
    words = staged(lost.groupBy("block").applyInArrow(_places, "block long, words array<long>"), "exact_lost")
    stays = F.col("words").isNull() | ~_is_set(F.col("words"), F.col("place"))
    return table.join(words.hint("shuffle_hash"), "block", "left").filter(stays).select("row.*")

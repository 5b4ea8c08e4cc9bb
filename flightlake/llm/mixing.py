"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are laid in a hashed order on a line of words, which is cut
into blocks of equal length.  The schedule has about SLOTS slots at any size of input:
slot i takes the point frac(i * golden ratio) through the cumulative weights of the
sources, and its rank among the slots of its source is the block it reads, starting
over at the end of the line.  A document's share is what its blocks were read.

The slots are a fixed number of rows, so what is ranked per source stays bounded even
where one source holds most of the corpus.  A source's line is built from 4096 hash
ranges, each summed first, so no task holds a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import staged

SLOTS = 1 << 20
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
GOLDEN = 0.6180339887498949
_CELLS = 4096
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """(sid, source, source_size, target): shares by weight, none above `repeats` times its size.

    Sources in code point order, null last, weigh `weights` in turn.  A source is capped
    when its even share exceeds its cap; taken by cap over weight, the capped ones come
    first, so the common level of the rest follows from running sums.  One row per source.
    """
    every = Window.orderBy(F.col("source").isNull(), "source")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("sid", F.row_number().over(every)).withColumn(
        "weight", F.element_at(listed, F.pmod(F.col("sid") - 1, F.lit(len(weights))) + 1)
    )
    per = per.withColumn("cap", F.col("source_size") * repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    line = Window.orderBy("ratio", "sid")
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("even", (F.sum("source_size").over(whole) - before) / rest)
    open_ = F.when(F.col("even") <= F.col("ratio"), F.struct("ratio", "sid", "even"))
    level = F.coalesce(F.min(open_).over(whole).getField("even"), F.lit(0.0))
    target = F.least(F.col("cap").cast("double"), F.col("weight") * level)
    return per.select("sid", "source", "source_size", target.alias("target"))


def _schedule(sources: DataFrame, total: int, slots: int) -> DataFrame:
    """(sid, block, uses): how often the schedule reads each block."""
    length = -(-total // slots)
    whole = Window.partitionBy()
    line = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    share = F.col("target") * F.col("blocks") / F.col("source_size")
    drawn = sources.filter("source_size > 0").withColumn(
        "blocks", F.ceil(F.col("source_size") / length).cast("long")
    )
    drawn = drawn.withColumn("share", share).withColumn("all", F.sum("share").over(whole))
    drawn = drawn.withColumn("high", F.sum("share").over(line) / F.col("all"))
    last = Window.orderBy("sid")
    drawn = drawn.withColumn("low", F.coalesce(F.lag("high").over(last), F.lit(0.0)))
    drawn = drawn.withColumn("high", F.when(F.lead("sid").over(last).isNull(), F.lit(2.0)).otherwise(F.col("high")))
    count = drawn.agg(F.round(F.max("all")).cast("long")).first()[0] or 0
    spark = sources.sparkSession
    point = F.col("id").cast("double") * F.lit(GOLDEN)
    points = spark.range(1, count + 1).withColumn("point", point - F.floor(point))
    points = points.withColumn("cell", F.floor(F.col("point") * _CELLS).cast("int"))
    cells = drawn.withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * _CELLS).cast("int"),
                F.least(F.floor(F.col("high") * _CELLS), F.lit(_CELLS - 1)).cast("int"),
            )
        ),
    )
    hit = points.join(cells, "cell").filter("point >= low AND point < high")
    rank = F.row_number().over(Window.partitionBy("sid").orderBy("id")) - 1
    ranked = hit.select("sid", "id", "blocks").withColumn("rank", rank)
    used = ranked.filter(F.col("rank") < F.col("blocks") * MOST_REPEATS)
    return used.groupBy("sid", F.pmod("rank", "blocks").alias("block")).agg(F.count("id").alias("uses"))


def mix_sources(docs: DataFrame, weights=WEIGHTS, slots: int = SLOTS, count: str | None = None) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, text_key) for every row of `docs`.

    `docs` has doc_id, source and text.  Null text and text without words have size 0
    and nothing taken; a null source is a source of its own, the last.  Repeated rows
    are laid on the line one after the other and each gets its own share.  Other
    columns are ignored; an empty table gives an empty result.  Reruns agree, because
    the order on the line is a digest of the id.
    """
    mixed = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sizes = docs.select(
        F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size"),
        mixed.alias("mixed"), F.xxhash64(F.col("text").cast("string")).alias("text_key"),
    )
    sizes = staged(sizes, "mix_sizes")
    sources = staged(source_targets(sizes, weights), "mix_sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    known = sources.select("sid", F.col("source").alias("of"), "source_size", "target")
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    if not total:
        return rows.withColumn("taken", F.lit(0).cast("long")).drop("sid", "mixed")
    rows = rows.withColumn("cell", F.substring("mixed", 1, 3))
    cells = rows.groupBy("sid", "cell").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("sid").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("sid", "cell", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("ahead"))
    inside = (
        Window.partitionBy("sid", "cell").orderBy("mixed", "doc_id", "size", "text_key")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.join(cells, ["sid", "cell"]).withColumn(
        "start", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )
    rows = staged(rows.drop("cell", "ahead", "mixed"), "mix_line")
    length = -(-total // slots)
    blocks = F.ceil(F.col("source_size") / length).cast("long")
    base, extra = F.expr("source_size div blocks"), F.expr("source_size % blocks")
    # the first `extra` blocks are one word longer than the others
    longer = F.col("extra") * (F.col("base") + 1)

    def block_of(at: str) -> Column:
        return F.when(F.col(at) < longer, F.expr(f"{at} div (base + 1)")).otherwise(
            F.col("extra") + F.floor((F.col(at) - longer) / F.col("base"))
        )

    def edge(block: Column) -> Column:
        return block * F.col("base") + F.least(block, F.col("extra"))

    cut = (
        rows.filter("size > 0")
        .withColumn("blocks", blocks)
        .withColumns({"base": base, "extra": extra, "last": F.col("start") + F.col("size") - 1})
        .select("sid", "start", "last", "base", "extra", F.explode(F.sequence(block_of("start"), block_of("last"))).alias("block"))
    )
    overlap = F.least(F.col("last") + 1, edge(F.col("block") + 1)) - F.greatest(F.col("start"), edge(F.col("block")))
    taken = (
        cut.join(_schedule(sources, total, slots), ["sid", "block"])
        .groupBy("sid", "start")
        .agg(F.sum(overlap * F.col("uses")).alias("words_taken"))
    )
    # rows of size 0 share a start with the row after them
    key = F.when(F.col("size") > 0, F.col("start")).otherwise(F.lit(-1))
    return (
        rows.withColumn("start", key)
        .join(taken, ["sid", "start"], "left")
        .withColumn("taken", F.coalesce("words_taken", F.lit(0)).cast("long"))
        .select("doc_id", "size", "source_size", "target", "taken", "source", "text_key")
    )


def mixed_documents(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """The mix itself: each row of `docs` as often as the schedule read it, to the nearest whole time.

    Rows of size 0 are not in the mix.  Rows of equal id, source and text appear equally often.
    """
    share = mix_sources(docs, weights)
    times = F.round(F.col("taken") / F.greatest("size", F.lit(1))).cast("int")
    copies = share.groupBy(
        F.col("doc_id").alias("__mix_id"), F.col("text_key").alias("__mix_text"), F.col("source").alias("__mix_source")
    ).agg(F.ceil(F.avg(times)).cast("int").alias("__mix_copies"))
    same = (
        docs["doc_id"].cast("long").eqNullSafe(F.col("__mix_id"))
        & F.xxhash64(docs["text"].cast("string")).eqNullSafe(F.col("__mix_text"))
        & docs["source"].cast("string").eqNullSafe(F.col("__mix_source"))
    )
    repeated = docs.join(copies.filter("__mix_copies > 0"), same)
    again = F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))).alias("__mix_copy")
    return repeated.select(*[docs[c] for c in docs.columns], again).drop("__mix_copy")

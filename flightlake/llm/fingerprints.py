"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A text's terms are its words, weighted by how often they stand in it.  Sample k draws for
every term, from a hash of the term and k, two gamma variables and a uniform one (r, c, b)
and takes the term with the smallest a:

    t = floor(ln(weight) / r + b),  ln a = ln c - r (t - b) - r

Two texts agree in sample k, in term and t, with a chance equal to their generalised
Jaccard similarity (sum of the smaller weights over sum of the larger ones).  A fingerprint
is SAMPLES such samples, each as 32 bits in hex; likeness is the share of equal samples.

A text and its edited form are sampled together: their terms are grouped once, with a weight
in each, and (r, c, b) are drawn once for both.  Gamma variables come from tables of the
inverse distribution, a straight line between 256 points and 256 more in its tail, since a
logarithm costs more than all the rest of a draw.

Texts move once.  They are dealt by ranges of the id, so that a document's neighbour is the
row before it in its range, and counting words, drawing samples and looking at neighbours
all happen where the texts lie; the last document of a range is also sent to the next one.
"""

from __future__ import annotations

from math import exp, log, log1p

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 96
#: samples drawn side by side in one row; more would outgrow what the JVM compiles
_SIDE = 4
_LEAST = -(1 << 63)
_SPACE = r"[\x20\x09-\x0D]+"


def _upper(v: float) -> float:
    """The x that a gamma variable of shape 2 exceeds with chance v = (1 + x) exp(-x)."""
    low, high = 0.0, 60.0
    for _ in range(80):
        x = (low + high) / 2
        low, high = (x, high) if log1p(x) - x > log(v) else (low, x)
    return (low + high) / 2


def _lower(v: float) -> float:
    """ln of the x that a gamma variable of shape 2 stays below with chance v."""
    low, high = 1e-9, 60.0
    for _ in range(80):
        x = (low * high) ** 0.5
        low, high = (x, high) if 1 - (1 + x) * exp(-x) < v else (low, x)
    return log(low * high) / 2


def _drawn(inverse, bits: Column, shift: int, last: float) -> Column:
    """`inverse` of a uniform number made of 21 bits of a hash; its singular end is at 0, `last` is at 1.

    The first 8 bits choose the point of a table and the rest the place after it; where they are
    all 0, the next 8 bits choose in a finer table, whose first cell is level.
    """

    def line(points: list[float], at: Column, rest: Column, scale: int) -> Column:
        steps = [(b - a) / scale for a, b in zip(points, points[1:])]
        a, d = (F.array(*[F.lit(x) for x in column]) for column in (points[:-1], steps))
        return F.get(a, at) + F.get(d, at) * rest

    def part(low: int, count: int) -> Column:
        return F.shiftrightunsigned(bits, shift + low).bitwiseAND(F.lit((1 << count) - 1))

    coarse = [inverse(max(i, 1) / 256) for i in range(256)] + [last]
    fine = [inverse(max(i, 1) / 65536) for i in range(257)]
    tail = line(fine, part(5, 8).cast("int"), part(0, 5), 1 << 5)
    high = part(13, 8).cast("int")
    return F.when(high > 0, line(coarse, high, part(0, 13), 1 << 13)).otherwise(tail)


def _draws(term: Column, k: Column) -> tuple[Column, Column, Column]:
    """(r, ln c, b) of a term in sample k."""
    bits = F.xxhash64(term, k)
    b = F.shiftrightunsigned(bits, 42).bitwiseAND(F.lit((1 << 21) - 1)) / F.lit(float(1 << 21))
    return _drawn(_upper, bits, 0, 1e-6), _drawn(_lower, bits, 21, 2.7), b


def _sample(term: Column, log_weight: Column, r: Column, log_c: Column, b: Column) -> Column:
    """ln a in the high bits, 32 bits of (term, t) in the low ones: the least is the sample."""
    t = F.floor(log_weight / r + b)
    log_a = log_c - r * (t - b) - r
    high = F.shiftleft(F.floor((log_a + 1000.0) * F.lit(float(1 << 20))), 32)
    low = term.bitwiseXOR(t * F.lit(2654435761)).bitwiseAND(F.lit(0xFFFFFFFF))
    return high.bitwiseOR(low)


def _terms(texts: DataFrame, keys: list[str], forms: list[str]) -> DataFrame:
    """(keys, term, lw0, lw1, ..): every word of the text columns `forms` with the ln of its weight in each."""
    each = [F.struct(F.lit(i).alias("form"), F.col(c).alias("text")) for i, c in enumerate(forms)]
    texts = texts.select(*keys, F.explode(F.array(*each)).alias("t")).filter("t.text IS NOT NULL")
    words = texts.select(*keys, "t.form", F.explode(F.split("t.text", _SPACE)).alias("word")).filter("word != ''")
    counted = words.select(*keys, "form", F.xxhash64("word").alias("term")).groupBy(*keys, "term").agg(
        *[F.sum(F.when(F.col("form") == i, 1)).alias(f"w{i}") for i in range(len(forms))]
    )
    return counted.select(*keys, "term", *[F.ln(F.col(f"w{i}").cast("double")).alias(f"lw{i}") for i in range(len(forms))])


def _samples(terms: DataFrame, keys: list[str], forms: int, samples: int) -> DataFrame:
    """(keys, f0, f1, ..): the low bits of every sample of each form, as arrays; null without terms."""
    rounds = -(-samples // _SIDE)
    logs = [f"lw{i}" for i in range(forms)]
    spread = terms.select(*keys, "term", *logs, F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("q"))
    draws = [
        c.alias(f"{name}{i}")
        for i in range(_SIDE)
        for name, c in zip("rcb", _draws(F.col("term"), F.col("q") * _SIDE + i))
    ]
    drawn = spread.select(*keys, "term", *logs, "q", *draws)
    least = drawn.groupBy(*keys, "q").agg(
        *[
            F.min(_sample(F.col("term"), F.col(f"lw{f}"), F.col(f"r{i}"), F.col(f"c{i}"), F.col(f"b{i}"))).alias(f"m{f}_{i}")
            for f in range(forms)
            for i in range(_SIDE)
        ]
    )

    def ordered(f: int) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col(f"m{f}_0").isNotNull(), F.struct("q", *[f"m{f}_{i}" for i in range(_SIDE)]))))
        flat = F.flatten(F.transform(rows, lambda row: F.array(*[row[f"m{f}_{i}"] for i in range(_SIDE)])))
        bits = F.transform(F.slice(flat, 1, samples), lambda m: m.bitwiseAND(F.lit(0xFFFFFFFF)))
        return F.when(F.size(bits) > 0, bits).alias(f"f{f}")

    return least.groupBy(*keys).agg(*[ordered(f) for f in range(forms)])


def likeness(a: Column, b: Column, samples: int) -> Column:
    """Share of equal samples; texts without words are alike to each other and to nothing else."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when(a.isNull() & b.isNull(), 1.0).when(a.isNull() | b.isNull(), 0.0).otherwise(equal / F.lit(float(samples)))


def _hex(bits: Column) -> Column:
    each = F.transform(bits, lambda s: F.lower(F.lpad(F.hex(s), 8, "0")))
    return F.coalesce(F.array_join(each, ""), F.lit(""))


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], list[int], list[int]]:
    """Bounds of `parts` ranges of the id, each range's largest id, and the range after it.

    What comes to the driver has one number for each range.
    """
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = sorted(set(docs.agg(F.percentile_approx("at", shares, 10000).alias("b")).first()[0] or []))
    largest = dict(docs.groupBy(_range_of(bounds).alias("r")).agg(F.max("at")).collect())
    ranges = sorted(largest)
    following = {r: ranges[(i + 1) % len(ranges)] for i, r in enumerate(ranges)}
    every = range(len(bounds) + 1)
    return bounds, [largest.get(r, _LEAST) for r in every], [following.get(r, -1) for r in every]


def _numbers(values: list[int], kind: str) -> Column:
    return F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.array().cast(f"array<{kind}>")


def _range_of(bounds: list[int]) -> Column:
    return F.size(F.filter(_numbers(bounds, "long"), lambda b: b <= F.col("at")))


def fingerprint_pairs(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of every text and its edited form, and their likeness.

    One row per row of `docs` (doc_id, text): doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The next document is the one before it in
    (doc_id, text) order, after the first comes the last; alone, a document is its own next.
    The edited text has its last floor(n_chars / 3) code points replaced by as many first
    ones (or all) of the next text.  A null text counts as empty, a null id as smaller than
    all others.  A text without words has an empty fingerprint.  Other columns are ignored;
    an empty table gives an empty result.
    """
    # a word takes some 40 times its bytes while it is counted and sampled, so ranges are small
    parts = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.coalesce(F.col("doc_id"), F.expr(f"{_LEAST + 1}L - 1L"))
    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    bounds, largest, following = _ranges(rows.select(at.alias("at")), parts)
    here = F.struct(F.col("range"), F.lit(False).alias("sent"))
    # never null, also to the planner: it would check that for one of the uses alone, and deal the texts twice
    to = F.struct(F.coalesce(F.get(_numbers(following, "int"), F.col("range")), F.lit(-1)).alias("range"), F.lit(True).alias("sent"))
    ends = F.get(_numbers(largest, "long"), F.col("range")) == F.col("at")
    dealt = (
        rows.withColumn("at", at)
        .withColumn("range", _range_of(bounds))
        .withColumn("d", F.explode(F.when(ends, F.array(here, to)).otherwise(F.array(here))))
        .select("doc_id", "text", "d.range", "d.sent")
        .repartition(parts, "range")  # both uses below need the same columns, so it is one exchange
    )
    line = Window.partitionBy("range").orderBy(F.col("sent").desc(), at, "text")
    placed = dealt.withColumns({"n": F.row_number().over(line), "next": F.lag("text").over(line)})
    n_chars = F.length("text").cast("long")
    cut = F.floor(n_chars / 3)
    edited = F.concat(
        F.substr("text", F.lit(1), (n_chars - cut).cast("int")), F.substr(F.coalesce("next", F.lit("")), F.lit(1), cut.cast("int"))
    )
    meta = placed.select(
        "range", "n", "sent", "doc_id", n_chars.alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256")
    )
    here = F.when(~F.col("sent"), edited)
    terms = _terms(placed.select("range", "n", "text", here.alias("edited")), ["range", "n"], ["text", "edited"])
    joined = meta.join(_samples(terms, ["range", "n"], 2, samples), ["range", "n"], "left")
    before = Window.partitionBy("range").orderBy("n")
    packed = joined.withColumn("near_next", likeness(F.col("f0"), F.lag("f0").over(before), samples)).filter("NOT sent")
    return packed.select(
        "doc_id", "n_chars", "edited_sha256", _hex(F.col("f0")).alias("fingerprint"), _hex(F.col("f1")).alias("edited_fingerprint"),
        likeness(F.col("f0"), F.col("f1"), samples).alias("near_edited"), "near_next",
    )

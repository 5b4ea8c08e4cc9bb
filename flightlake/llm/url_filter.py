"""URL verdicts: longest fitting rule first, else exact list membership by a Bloom filter cascade.

The keys are hosts and the universe is every host of the table.  Level 1 holds the
listed hosts; level 2 holds the unlisted hosts that level 1 lets through, level 3 the
listed hosts that level 2 lets through, and so on until a level lets nothing through.
Walking the levels then answers membership exactly for every host of the universe.

A level is cut into shards by the host's hash, each an array of at most SHARD_BITS bits
by construction, so that no filter grows with the list: a longer list has more shards.
Levels of at most LITERAL_BITS bits in all are constants of the expression that judges a
page, so pages are neither joined nor shuffled.  Filters of a longer list are looked up by
shard number: their table comes from files, so Spark broadcasts it only below its threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.session import staged

RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
#: a host is listed when one of its labels is among these
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")
SHARD_BITS = 1 << 16
#: all levels together, as constants of a plan: 20 KB, the filters of some 10,000 hosts
LITERAL_BITS = 1 << 17
BITS_PER_KEY = 10
HASHES = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty without `://` or for null."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, rest = rule.partition("/")
    return ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))


def judge_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds `rule` (null where none fits) and `rule_verdict`; needs host and path."""
    host, path = F.col("host"), F.col("path")
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        fits = _fits(text, host, path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    none = F.lit(None).cast("string")
    return pages.withColumns({"rule": none if rule is None else rule, "rule_verdict": none if verdict is None else verdict})


def _slot(level: int, i: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.col("host"), F.lit(level), F.lit(i)), F.lit(bits))


def _in_filter(level: int, bits: int, words: Column | None = None, first: Column | None = None) -> Column:
    """All bits of the host set in the words of its shard, which begin at `first`; false where the shard has no key."""
    words = F.col(f"level{level}") if words is None else words

    def is_set(slot: Column) -> Column:
        at = F.shiftright(slot, 6).cast("int")
        word = F.get(words, at if first is None else first + at)
        return F.call_function("getbit", word, F.pmod(slot, F.lit(64)).cast("int")) == 1

    return F.coalesce(reduce(lambda a, b: a & b, [is_set(_slot(level, i, bits)) for i in range(HASHES)]), F.lit(False))


def _filter(members: DataFrame, level: int, bits: int) -> DataFrame:
    """(shard, level<n>): the dense words of each shard."""
    slots = members.select("shard", F.explode(F.array(*[_slot(level, i, bits) for i in range(HASHES)])).alias("slot"))
    words = slots.groupBy("shard", F.shiftright("slot", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, int(pmod(slot, 64)))")).alias("bits")
    )
    dense = words.select("shard").distinct().select(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(bits // 64 - 1))).alias("word")
    )
    filled = dense.join(words, ["shard", "word"], "left").select(
        "shard", F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("w")
    )
    packed = filled.groupBy("shard").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return packed.select("shard", F.col("w.bits").alias(f"level{level}"))


class Cascade:
    """Exact membership of hosts in a list, for the hosts of one universe."""

    def __init__(self, universe: DataFrame):
        """`universe` has every host once, with a boolean `listed`."""
        listed = universe.filter("listed").count()
        self.shards = max(1, -(-listed * BITS_PER_KEY // SHARD_BITS))
        hosts = staged(universe.withColumn("shard", self._shard()), "url_universe")
        current, others = hosts.filter("listed"), hosts.filter("NOT listed")
        self.bits: list[int] = []
        self.table: DataFrame | None = None
        while True:
            level = len(self.bits) + 1
            keys = current.groupBy("shard").count().agg(F.max("count")).first()[0]
            if not keys:
                break
            bits = 64
            while bits < min(keys * BITS_PER_KEY, SHARD_BITS):
                bits *= 2
            made = staged(_filter(current, level, bits), f"url_level{level}")
            self.bits.append(bits)
            self.table = made if self.table is None else self.table.join(made, "shard", "left")
            passed = others.join(made, "shard").filter(_in_filter(level, bits)).select("host", "shard")
            current, others = staged(passed, f"url_passed{level}"), current
        if self.table is not None:
            self.table = staged(self.table, "url_cascade")

    def _shard(self) -> Column:
        return F.pmod(F.xxhash64(F.col("host"), F.lit("shard")), F.lit(self.shards)).cast("int")

    def mark(self, rows: DataFrame, column: str) -> DataFrame:
        """Adds a boolean: is the row's host listed?"""
        if self.table is None:
            return rows.withColumn(column, F.lit(False))
        if self.shards * sum(self.bits) <= LITERAL_BITS:
            return rows.withColumn(column, self._walk(self._constants()))
        looked = rows.withColumn("shard", self._shard()).join(self.table, "shard", "left")
        names = [f"level{i}" for i in range(1, len(self.bits) + 1)]
        return looked.withColumn(column, self._walk([_in_filter(i, b) for i, b in enumerate(self.bits, 1)])).drop("shard", *names)

    def _walk(self, passes: list[Column]) -> Column:
        """The first level that a host does not pass tells whether it is listed; past the last, the last does."""
        answer = F.lit(len(passes) % 2 == 1)
        for level in range(len(passes), 0, -1):
            answer = F.when(~passes[level - 1], F.lit(level % 2 == 0)).otherwise(answer)
        return answer

    def _constants(self) -> list[Column]:
        """Each level's test over the words of all shards as one constant array; at most LITERAL_BITS bits reach the driver."""
        rows = {r["shard"]: r for r in self.table.collect()}
        passes = []
        for level, bits in enumerate(self.bits, 1):
            size = bits // 64
            words = [w for shard in range(self.shards) for w in (shard in rows and rows[shard][f"level{level}"]) or [0] * size]
            constant = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
            passes.append(_in_filter(level, bits, constant, self._shard() * size))
        return passes


def labelled_hosts(hosts: DataFrame, labels=LISTED_LABELS) -> DataFrame:
    """(host) of the hosts one of whose labels is among those given."""
    known = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    return hosts.filter(F.arrays_overlap(F.split("host", r"\."), known)).select("host")


def filter_urls(pages: DataFrame, rules=RULES, listed: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed) for every row of `pages` (page_id, url).

    `listed` is a table of hosts (column host); without one, `labelled_hosts` of the pages
    are listed.  Hosts of the list that no page has, nulls and repeats change nothing.
    A null url and one without `://` have an empty host and path, which no rule fits
    and which cannot be listed: they are allowed.  Repeated rows stay, urls of any length are
    read whole, other columns are ignored; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = staged(parsed.select("host").distinct(), "url_hosts")
    keys = labelled_hosts(hosts) if listed is None else listed.select("host")
    keys = keys.filter("host <> ''").distinct().withColumn("listed", F.lit(True))
    universe = hosts.join(keys, "host", "left").select("host", F.coalesce("listed", F.lit(False)).alias("listed"))
    judged = judge_by_rules(Cascade(universe).mark(parsed, "listed"), rules)
    verdict = F.coalesce("rule_verdict", F.when(F.col("listed"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")

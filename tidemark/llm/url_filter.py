"""URL filters: host and path rules, and for the rest a list of hosts held in a Bloom filter cascade.

Level 0 of a cascade is a Bloom filter of the listed keys. The keys of the universe that it passes wrongly are encoded
by level 1, the listed keys that level 1 passes by level 2, and so on until a level passes nothing wrongly. A key's
membership is told by the first level that does not have it: as all keys of the corpus were tried while building, the
answer is exact for every one of them, and no key list is joined. Levels shrink by the filters' error rate, so a
cascade has a few bits per listed key.

Keys are dealt by hash into shards of a bounded number of keys with a cascade each. Pages meet their shard's cascade, a
row of bit arrays; Spark broadcasts these while their measured size is small and otherwise joins on the shard, split
where one host has most pages. Everything is SQL expressions.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed; a null or
repeated key counts once or not at all; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import joined, list_bytes, stored

# Verdict, rule.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]

#: Keys of a shard, bits for each key of a level, and hashes of a key.
SHARD_KEYS = 1 << 16
BITS = 8
HASHES = 4
#: More levels than any number of keys needs.
MOST_LEVELS = 64

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return (F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit("")))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest rule that fits, and its verdict."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        site, slash, rest = text.partition("/")
        fits = ((host == site) | F.endswith(host, F.lit(f".{site}"))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _places(key: Column, level: int, bits: Column) -> list[Column]:
    """Bit places of a key by double hashing."""
    one, two = F.pmod(F.xxhash64(key, F.lit(level)), bits), F.pmod(F.xxhash64(key, F.lit(level), F.lit(1)), bits)
    return [F.pmod(one + two * j, bits) for j in range(HASHES)]


def _has(key: Column, level: int, words: Column) -> Column:
    """Is the key in the filter of these words."""
    bits = F.size(words).cast("long") * 64
    found = F.lit(True)
    for place in _places(key, level, bits):
        found = found & (F.getbit(F.get(words, F.floor(place / 64).cast("int")), F.pmod(place, F.lit(64)).cast("int")) == 1)
    return F.coalesce(found, F.lit(False))


def _filter(keys: DataFrame, level: int) -> DataFrame:
    """(shard, words): the Bloom filter of each shard's keys."""
    sizes = keys.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) * BITS / 64).cast("int").alias("size"))
    placed = keys.join(sizes, "shard").select("shard", F.explode(F.array(
        *_places(F.col("key"), level, F.col("size").cast("long") * 64))).alias("place"))
    masks = placed.groupBy("shard", F.floor(F.col("place") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(place % 64 AS int))")).alias("mask"))
    empty = sizes.select("shard", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("word")).withColumn(
        "mask", F.lit(0).cast("long"))
    whole = masks.unionByName(empty).groupBy("shard", "word").agg(F.bit_or("mask").alias("mask"))
    return whole.groupBy("shard").agg(F.array_sort(F.collect_list(F.struct("word", "mask"))).alias("held")).select(
        "shard", F.col("held.mask").alias("words"))


class Cascade:
    """Exact membership for every key of the universe it was built over."""

    def __init__(self, levels: list[DataFrame], shards: int):
        self.shards = shards
        table = None
        for i, level in enumerate(levels):
            named = level.withColumnRenamed("words", f"level{i}")
            table = named if table is None else table.join(named, "shard", "full")
        self.depth = len(levels)
        self.table = None if table is None else stored(table)

    def mark(self, df: DataFrame, key: Column, name: str) -> DataFrame:
        """``df`` with a boolean column that tells whether ``key`` is listed."""
        if self.table is None:
            return df.withColumn(name, F.lit(False))
        held = [f"level{i}" for i in range(self.depth)]
        met = joined(df.withColumn("shard", shard_of(key, self.shards)), self.table, ["shard"], "left", list_bytes(*held))
        listed = F.lit(self.depth % 2 == 1)
        for i in reversed(range(self.depth)):  # listed where the first level that misses the key is an odd one
            listed = F.when(_has(key, i, F.col(held[i])), listed).otherwise(F.lit(i % 2 == 1))
        return met.withColumn(name, listed).drop("shard", *held)


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(shards)).cast("int")


def build_cascade(universe: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """From the complete (key, listed) universe. Only one count for each level reaches the driver."""
    once = universe.where(F.col("key").isNotNull()).groupBy("key").agg(F.max("listed").alias("listed"))
    once = stored(once.select("key", F.coalesce("listed", F.lit(False)).alias("listed")))
    count = once.count()
    shards = max(1, -(-count // shard_keys))
    once = once.withColumn("shard", shard_of(F.col("key"), shards))
    encoded, other = once.where("listed"), once.where("NOT listed")
    levels: list[DataFrame] = []
    while encoded.limit(1).count():
        if len(levels) == MOST_LEVELS:
            raise RuntimeError("the cascade does not end: two keys have equal hashes at every level")
        level = stored(_filter(encoded, len(levels)))
        passed = joined(other, level, ["shard"], "inner", list_bytes("words")).where(
            _has(F.col("key"), len(levels), F.col("words"))).select("key", "shard")
        levels.append(level)
        encoded, other = stored(passed), encoded
    return Cascade(levels, shards)


def judge(df: DataFrame, rules: list[tuple[str, str]] | None = None, shard_keys: int = SHARD_KEYS,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, listed, verdict.

    A host is listed if more of its pages are blocked by rules than allowed; that decides its pages without a rule.
    """
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    pages = df.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    pages = pages.withColumns({"rule": rule, "ruled": verdict})
    balance = F.sum(F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", -1).otherwise(0))
    cascade = build_cascade(pages.groupBy(F.col("host").alias("key")).agg((balance > 0).alias("listed")), shard_keys)
    marked = cascade.mark(pages, F.col("host"), "listed")
    return marked.select("page_id", "host", "path", "rule", "listed", F.coalesce(
        "ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))

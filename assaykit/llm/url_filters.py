"""URL filters by a Bloom filter cascade over the corpus's complete key universe.

Every (host suffix, path prefix) pair of the corpus that a rule could name is a key. Level 0
encodes the listed keys, level 1 the keys of the universe that level 0 admits wrongly, level 2 the
listed keys that level 1 admits wrongly, and so on until nobody is wrong. Membership is then exact
for every key of the universe, and looking a URL up needs no join: the levels are a few bits per
listed key, and their size is checked before they are sent out.

Defined results: a null URL or one without ``://`` has empty host and path, which no rule fits;
an empty path fits no rule with a path; repeated rows are judged one by one; a table without rows
gives none. Only the named columns are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.session import durable

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MOST_FILTER_BYTES = 256 << 20


@dataclass(frozen=True)
class Level:
    bits: bytes
    size: int
    hashes: int
    number: int


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), A_TO_Z, A_TO_Z.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def keys_of(host: Column, path: Column, rules: list[str]) -> Column:
    """array<struct<key, weight, host_size>>: all pairs that one of the rules could equal."""
    depth = max((rule.split("/")[0].count(".") + 1 for rule in rules), default=0)
    cuts = sorted({len(rule) - len(rule.split("/")[0]) for rule in rules})
    # a host with fewer labels than n gives itself again
    suffixes = F.array_distinct(
        F.array(*[F.substring_index(host, ".", -n) for n in range(1, max(depth, 1) + 1)])
    )
    prefixes = F.array_compact(
        F.array(*[F.when(F.length(path) >= n, F.substr(path, F.lit(1), F.lit(n))) for n in cuts])
    )
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda h: F.transform(
                prefixes,
                lambda p: F.struct(
                    F.concat(h, p).alias("key"),
                    (F.length(h) + F.length(p)).alias("weight"),
                    F.length(h).alias("host_size"),
                ),
            ),
        )
    )
    return F.when(host == "", F.array().cast(KEYS)).otherwise(pairs)


KEYS = "array<struct<key:string,weight:int,host_size:int>>"


def _hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def _places(first: np.ndarray, second: np.ndarray, level: Level, k: int) -> np.ndarray:
    mixed = first ^ (np.uint64(0x9E3779B97F4A7C15) * np.uint64(2 * level.number + 1))
    mixed = mixed + np.uint64(k) * (second | np.uint64(1))
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed % np.uint64(level.size)


def _admits(level: Level, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    table = np.frombuffer(level.bits, dtype=np.uint8)
    held = np.ones(len(first), dtype=bool)
    for k in range(level.hashes):
        at = _places(first, second, level, k)
        held &= (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return held


def lookup(levels: list[Level], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Exact membership for keys of the universe: the first level that refuses a key decides."""
    result = np.full(len(first), len(levels) % 2 == 1)
    left = np.arange(len(first))
    for n, level in enumerate(levels):
        held = _admits(level, first[left], second[left])
        result[left[~held]] = n % 2 == 1
        left = left[held]
    return result


def _admitted(keys: DataFrame, level: Level) -> DataFrame:
    sent = keys.sparkSession.sparkContext.broadcast(level)

    @F.pandas_udf("boolean")
    def admits(first: pd.Series, second: pd.Series) -> pd.Series:
        arrays = (x.to_numpy().view(np.uint64) for x in (first, second))
        return pd.Series(_admits(sent.value, *arrays))

    return keys.where(admits("first", "second"))


def _encode(keys: DataFrame, number: int, bits_per_key: float, hashes: int) -> Level | None:
    """A level for these keys; tasks set bits in arrays of their own, which are then merged."""
    count = keys.count()
    if not count:
        return None
    size = 8 * math.ceil(max(64.0, count * bits_per_key) / 8)
    if size // 8 > MOST_FILTER_BYTES:
        raise ValueError(f"a level of {size // 8} bytes is too large to send out")
    level = Level(b"", size, hashes, number)

    def places(batches):
        for batch in batches:
            first, second = (batch[c].to_numpy().view(np.uint64) for c in ("first", "second"))
            at = np.unique(np.concatenate([_places(first, second, level, k) for k in range(hashes)]))
            byte = (at >> np.uint64(3)).astype(np.int64)
            value = np.left_shift(1, (at & np.uint64(7)).astype(np.int64))
            yield pd.DataFrame({"byte": byte, "value": value}).groupby("byte", as_index=False).agg(
                {"value": "sum"}
            )

    filled = keys.mapInPandas(places, "byte long, value long").groupBy("byte").agg(
        F.bit_or("value").alias("value")
    )
    table = np.zeros(size // 8, dtype=np.uint8)
    merged = filled.toPandas()  # at most one record per byte of the level, checked above
    table[merged["byte"].to_numpy()] = merged["value"].to_numpy().astype(np.uint8)
    return Level(table.tobytes(), size, hashes, number)


def build(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """The cascade for (first, second) hash pairs: ``listed`` against the rest of ``universe``."""
    both = durable(
        universe.select("first", "second", F.lit(0).alias("is_listed"))
        .unionByName(listed.select("first", "second", F.lit(1).alias("is_listed")))
        .groupBy("first", "second")
        .agg(F.max("is_listed").alias("is_listed"))
    )
    inside, outside = both.where("is_listed = 1"), both.where("is_listed = 0")
    levels: list[Level] = []
    while True:
        # generous first level, then the usual half
        bits, hashes = (12.0, 6) if not levels else (2.0, 1)
        level = _encode(inside, len(levels), bits, hashes)
        if level is None:
            return levels
        levels.append(level)
        wrong = durable(_admitted(outside, level))
        inside, outside = wrong, inside


@dataclass(frozen=True)
class Lists:
    """Keys (host, then path) with their verdict; ``more`` block without being named as a rule."""

    allow: tuple[str, ...] = ()
    block: tuple[str, ...] = ()
    more: tuple[str, ...] = ()


def judge(
    pages: DataFrame, lists: Lists, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """id, host, path, rule (the longest that fits, else null) and verdict for every row."""
    every = [*lists.allow, *lists.block, *lists.more]
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    keyed = rows.select("*", keys_of(F.col("host"), F.col("path"), every).alias("keys"))
    universe = keyed.select(F.explode(F.transform("keys", lambda x: x["key"])).alias("key"))
    first, second = _hashed(F.col("key"))
    universe = durable(universe.distinct().select(first.alias("first"), second.alias("second")))
    spark = pages.sparkSession
    cascades = []
    for keys in (lists.allow, lists.block, lists.more):
        listed = spark.createDataFrame([(k,) for k in keys], "key string")
        cascades.append(
            build(universe, listed.select(first.alias("first"), second.alias("second")))
        )
    sent = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("array<int>")
    def lists_of(first: pd.Series, second: pd.Series) -> pd.Series:
        """Per key: 1 if allowed, plus 2 if blocked, plus 4 if blocked by the further list."""
        sizes = first.map(len).to_numpy()
        if not sizes.sum():
            return pd.Series([[]] * len(first))
        flat = [np.concatenate(x.to_numpy()).astype(np.int64).view(np.uint64) for x in (first, second)]
        codes = np.zeros(len(flat[0]), dtype=np.int32)
        for n, levels in enumerate(sent.value):
            codes |= lookup(levels, *flat).astype(np.int32) << n
        return pd.Series(np.split(codes, np.cumsum(sizes)[:-1]))

    codes = lists_of(
        F.transform("keys", lambda x: F.xxhash64(x["key"])),
        F.transform("keys", lambda x: F.xxhash64(x["key"], F.lit("second"))),
    )
    coded = keyed.select("page_id", "host", "path", "keys", codes.alias("codes"))
    fits = F.zip_with(
        "keys",
        "codes",
        lambda x, code: F.struct(
            x["weight"].alias("weight"), x["host_size"].alias("host_size"),
            x["key"].alias("key"), code.alias("code"),
        ),
    )
    coded = coded.select("page_id", "host", "path", fits.alias("fits"))
    best = F.array_max(F.filter("fits", lambda x: x["code"].bitwiseAND(3) > 0))
    more = F.exists("fits", lambda x: x["code"].bitwiseAND(4) > 0)
    by_rule = F.when(F.col("best.code").bitwiseAND(1) > 0, F.lit("allow")).otherwise(F.lit("block"))
    coded = coded.select("page_id", "host", "path", best.alias("best"), more.alias("more"))
    return coded.select(
        "page_id",
        "host",
        "path",
        F.col("best.key").alias("rule"),
        F.when(F.col("best").isNotNull(), by_rule)
        .when(F.col("more"), F.lit("block"))
        .otherwise(F.lit("allow"))
        .alias("verdict"),
    )

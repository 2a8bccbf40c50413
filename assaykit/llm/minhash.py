"""Near-duplicates by b-bit MinHash, with links confirmed on full shingle sets.

Every document's distinct shingles are hashed to 64 bits and reduced to ``BANDS * ROWS`` minima.
Bands of minima nominate pairs; the low ``LOW_BITS`` bits of all minima are packed into a short
signature, from whose equal fields the similarity is estimated, corrected for chance collisions.
Pairs whose estimate is not far below the threshold are confirmed on the full sets. With 32 bands
of 4 rows a pair at similarity 0.8 shares no band once in twenty million.

No bucket of a band is expanded into all pairs. Documents with equal sets are one class from the
start. Then every bucket links its members to one pivot, components are contracted, and buckets
that still hold several components get another pivot. After ``ROUNDS`` rounds the members of
different components that are left are compared: small buckets pair by pair, large ones in blocks
of full sets, from which only confirmed links come out. So each pair of a bucket is either in one
component already or compared. The work of that last step grows with the members outside a
bucket's largest component times its members; its output is links only.

Defined results: null or empty texts have an empty set and link with nothing; a text of fewer words
than a shingle is one shingle; equal rows are one class; rows that share a doc_id are one document;
a row with a null doc_id is linked with nothing, has a null component and is kept; an empty table
gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.llm.components import attach, connect
from assaykit.session import durable, few_parts, small_batches, small_if, small_side

BANDS, ROWS, LOW_BITS = 32, 4, 4
MINIMA = BANDS * ROWS
ROUNDS = 3
#: An estimate this far below the threshold is five standard deviations off.
MARGIN = 0.2
SMALL_BUCKET, BLOCK = 8, 1_000_000
WORD_CACHE = 200_000

_GENERATOR = np.random.default_rng(20_240_601)
_FACTORS = _GENERATOR.integers(1, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _GENERATOR.integers(0, 2**63, MINIMA, dtype=np.uint64)
_PLACES = _GENERATOR.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _GENERATOR.integers(1, 2**63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_FIELD = np.uint64(0x1111111111111111)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to sorted distinct 64-bit shingle hashes; word hashes are remembered up to a bound."""

    def __init__(self, size: int):
        self.size, self.known = size, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        if len(known) > WORD_CACHE:
            known.clear()
        try:
            codes = [known[w] for w in words]
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            codes = [known[w] for w in words]
        each = np.array(codes, dtype=np.uint64)
        size = min(self.size, len(each))
        total = np.full(len(each) - size + 1, size, dtype=np.uint64)
        for k in range(size):  # the place of a word counts, so order matters
            total = total * _PLACES[0] + _mixed(each[k : len(each) - size + 1 + k] + _PLACES[k + 1])
        return np.unique(_mixed(total))


def minima_of(shingles: np.ndarray) -> np.ndarray:
    """The 32-bit minimum of the set under every hash function; the set must not be empty."""
    low = np.full(MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        each = np.multiply.outer(shingles[at : at + 512], _FACTORS)
        each += _SHIFTS
        np.minimum(low, each.min(axis=0), out=low)
    return low >> np.uint64(32)


def bands_of(minima: np.ndarray) -> np.ndarray:
    rows = _mixed(minima.reshape(BANDS, ROWS) + np.uint64(1)) * _BAND_FACTORS
    return _mixed(rows.sum(axis=1, dtype=np.uint64)).view(np.int64)


def packed(minima: np.ndarray) -> bytes:
    """The low bits of the minima, 16 fields of 4 bits in each 64-bit word."""
    fields = (minima & np.uint64((1 << LOW_BITS) - 1)).reshape(-1, 64 // LOW_BITS)
    shifts = np.arange(0, 64, LOW_BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(fields << shifts, axis=1).astype("<u8").tobytes()


def unpacked(signatures) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), dtype="<u8").reshape(len(signatures), -1)


def estimate(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Similarity from the share of equal fields, less what equals by chance."""
    apart = one ^ other
    apart = (apart | apart >> np.uint64(1) | apart >> np.uint64(2) | apart >> np.uint64(3)) & _FIELD
    equal = 1.0 - np.bitwise_count(apart).sum(axis=-1) / MINIMA
    chance = 2.0**-LOW_BITS
    return (equal - chance) / (1.0 - chance)


FEATURES = "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary"


def features(documents: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    rows = documents.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for batch in batches:
            out = []
            for text in batch["text"]:
                s = shingle(text)
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                minima = minima_of(s)
                digest = xxhash.xxh3_128_digest(s.astype("<u8").tobytes())
                out.append((len(s), digest, bands_of(minima), packed(minima)))
            frame = pd.DataFrame(out, columns=["n_shingles", "digest", "bands", "signature"])
            frame.insert(0, "doc_id", batch["doc_id"].astype("Int64").array)
            yield frame

    return rows.mapInPandas(run, FEATURES)


def _estimated(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) whose signatures do not rule the threshold out."""

    @F.pandas_udf("boolean")
    def near(one: pd.Series, other: pd.Series) -> pd.Series:
        if not len(one):
            return pd.Series([], dtype=bool)
        return pd.Series(estimate(unpacked(one), unpacked(other)) >= least)

    sides = reps.select("class_id", "signature")
    pairs = pairs.join(sides.withColumnsRenamed({"class_id": "a", "signature": "sa"}), "a")
    pairs = pairs.join(sides.withColumnsRenamed({"class_id": "b", "signature": "sb"}), "b")
    return pairs.where(near("sa", "sb")).select("a", "b")


def _confirmed(
    pairs: DataFrame, rows: int, documents: DataFrame, words: int, percent: int,
    id_col: str, text_col: str,
) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union, on the full sets of both texts.

    Of at most ``rows`` pairs. Where these are few, texts meet their pairs without a shuffle of
    the texts for the one side.
    """
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    needed = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed = small_side(durable(few_parts(needed, 2 * rows)))
    texts = texts.join(needed, "id", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle, last = Shingler(words), (None, None)
        for batch in batches:
            kept = []
            for a, b, one, other in batch[["a", "b", "text_a", "text_b"]].itertuples(index=False):
                if last[0] != one:
                    last = (one, shingle(one))
                s, t = last[1], shingle(other)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    kept.append((a, b))
            yield pd.DataFrame(kept, columns=["a", "b"], dtype="int64")

    both = small_if(pairs, rows).join(texts.withColumnsRenamed({"id": "b", "text": "text_b"}), "b")
    both = both.join(texts.withColumnsRenamed({"id": "a", "text": "text_a"}), "a")
    return durable(few_parts(both.mapInPandas(run, "a long, b long").distinct(), rows))


def _rest_small(live: DataFrame) -> DataFrame:
    """All pairs of different components in buckets of bounded size."""
    small = live.where(F.col("members") <= SMALL_BUCKET)
    one = small.select("band", F.col("class_id").alias("a"), F.col("component").alias("ca"))
    other = small.select("band", F.col("class_id").alias("b"), F.col("component").alias("cb"))
    return one.join(other, "band").where("a < b and ca <> cb").select("a", "b").distinct()


def _rest_large(
    live: DataFrame, documents: DataFrame, words: int, percent: int, least: float,
    id_col: str, text_col: str,
) -> DataFrame:
    """Links (a, b) between different components of large buckets, block against block.

    Members are dealt into blocks of about ``BLOCK`` shingles, which travel with their full sets,
    so only confirmed links come out. Of two components at least one is not the block's largest, so
    the members of the others are held against all.
    """
    large = live.where(F.col("members") > SMALL_BUCKET).select("band", "class_id", "component")
    rows = large.count()
    needed = durable(few_parts(large.select(F.col("class_id").alias("id")).distinct(), rows))
    texts = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.join(small_side(needed), "id", "left_semi")

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingle = Shingler(words)
        for batch in batches:
            found = [shingle(text).astype("<u8").tobytes() for text in batch["text"]]
            yield pd.DataFrame({"class_id": batch["id"], "shingles": found})

    found = durable(texts.mapInPandas(sets, "class_id long, shingles binary"))
    sized = found.select("class_id", F.octet_length("shingles").alias("bytes"))
    weights = small_if(large, rows).join(sized, "class_id").groupBy("band").agg(F.sum("bytes").alias("bytes"))
    blocks = F.ceil(F.col("bytes") / (8 * BLOCK)).cast("int")
    weights = durable(few_parts(weights.select("band", F.greatest(blocks, F.lit(1)).alias("blocks")), rows))
    large = large.join(small_if(weights, rows), "band")
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    large = large.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    large = large.select(
        "band", "class_id", "component", "own",
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    ).join(found, "class_id")

    def run(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        found = set()
        one, other = Block(frame[frame["own"] == i]), Block(frame[frame["own"] == j])
        for left, right in ((one, other), (other, one))[: 1 + (i != j)]:
            found.update(left.links(right, percent, least))
        return pd.DataFrame(sorted(found), columns=["a", "b"], dtype="int64")

    return large.groupBy("band", "i", "j").applyInPandas(run, "a long, b long").distinct()


class Block:
    """Members of a bucket with their sets, signatures and an index from shingle to members."""

    def __init__(self, frame: pd.DataFrame):
        self.ids, self.components = (frame[c].to_numpy() for c in ("class_id", "component"))
        self.sets = [np.frombuffer(x, dtype="<u8") for x in frame["shingles"]]
        self.sizes = np.array([len(x) for x in self.sets], dtype=np.int64)
        if len(frame):
            self.signatures = unpacked([packed(minima_of(x)) for x in self.sets])
            shingles = np.concatenate(self.sets)
            order = np.argsort(shingles, kind="stable")
            self.shingles = shingles[order]
            self.owners = np.repeat(np.arange(len(frame)), self.sizes)[order]

    def common(self, shingles: np.ndarray) -> np.ndarray:
        """How many of these shingles each member has."""
        low = np.searchsorted(self.shingles, shingles, "left")
        count = np.searchsorted(self.shingles, shingles, "right") - low
        places = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
        return np.bincount(self.owners[places], minlength=len(self.ids))

    def links(self, other: Block, percent: int, least: float) -> Iterator[tuple[int, int]]:
        """Confirmed links of members outside the largest component of the two blocks."""
        if not len(self.ids) or not len(other.ids):
            return
        names, counts = np.unique(
            np.concatenate([self.components, other.components]), return_counts=True
        )
        for k in np.flatnonzero(self.components != names[counts.argmax()]):
            apart = other.components != self.components[k]
            near = estimate(other.signatures, self.signatures[k]) >= least
            if not (apart & near).any():
                continue
            both = other.common(self.sets[k])
            linked = apart & (100 * both >= percent * (self.sizes[k] + other.sizes - both))
            for b in other.ids[linked].tolist():
                a = int(self.ids[k])
                yield min(a, b), max(a, b)


def near_duplicates(
    documents: DataFrame, words: int = 5, percent: int = 80,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of documents: doc_id, n_shingles, component_id (its smallest doc_id)."""
    small_batches(documents.sparkSession)
    every = durable(features(documents, words, id_col, text_col))
    rows = every.where("doc_id is not null and digest is not null")
    # equal sets are one class; a hot class is combined before the shuffle
    classes = durable(rows.groupBy("digest").agg(F.min("doc_id").alias("class_id")))
    reps = durable(
        rows.join(classes.withColumnRenamed("class_id", "doc_id"), ["digest", "doc_id"], "left_semi")
        .select(F.col("doc_id").alias("class_id"), "bands", "signature")
        .repartition("class_id")  # the way all joins on it need them
        .dropDuplicates(["class_id", "signature"])
    )
    least = percent / 100 - MARGIN
    bands = reps.select(F.explode("bands").alias("band"), "class_id")
    sizes = bands.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    shared = durable(bands.join(sizes, "band").distinct())
    labels = None  # class_id, component: only of classes that have a link
    tested, known = None, 0

    def confirm(pairs: DataFrame) -> bool:
        """Test pairs not tested before; extend the components by those confirmed."""
        nonlocal labels, tested, known
        if tested is not None:
            pairs = pairs.join(small_if(tested, known), ["a", "b"], "left_anti")
        pairs = durable(_estimated(pairs, reps, least))
        rows = pairs.count()
        if not rows:
            return False
        pairs = few_parts(pairs, rows)
        links = _confirmed(pairs, rows, documents, words, percent, id_col, text_col)
        tested = pairs if tested is None else tested.union(pairs)
        known += rows
        if not links.isEmpty():
            labels = connect(links, labels)
        return True

    def labelled(rows: DataFrame) -> DataFrame:
        """With component; few labels go to the rows, which stay dealt out by band."""
        return attach(rows, labels if labels is None else small_side(labels), "class_id")

    for turn in range(ROUNDS):
        live = labelled(shared)
        if turn:  # buckets of two were decided by their pivot
            live = live.where("members > 2")
        place = F.xxhash64("class_id", F.lit(turn)) if turn else F.col("class_id")
        pivots = live.groupBy("band").agg(
            F.min_by("class_id", place).alias("pivot"),
            F.min_by("component", place).alias("pivot_component"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        pivots = pivots.where("low <> high").select("band", "pivot", "pivot_component")
        pairs = live.join(pivots, "band").where("component <> pivot_component")
        pairs = pairs.select(
            F.least("pivot", "class_id").alias("a"), F.greatest("pivot", "class_id").alias("b")
        )
        if not confirm(pairs.distinct()):
            break
    live = labelled(shared).where("members > 2")
    mixed = live.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    live = durable(live.join(mixed.where("low <> high").select("band"), "band", "left_semi"))
    rows = live.count()
    if rows:
        live = few_parts(live, rows)
        links = durable(_rest_large(live, documents, words, percent, least, id_col, text_col))
        confirm(_rest_small(live))
        if not links.isEmpty():
            labels = connect(links, labels)

    result = every.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
    result = labelled(result)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return result.select("doc_id", "n_shingles", component.alias("component_id"))

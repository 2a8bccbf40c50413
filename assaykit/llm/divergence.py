"""How far the sources of a language differ in their use of words, in whole numbers.

The texts are brought once into a plain form (lower-cased terms, documents of a source in a task run
together), so that no regular expression is left to the passes that follow.
Per language a CountVectorizer with a minimum document frequency and the largest integer as
vocabulary size is fitted and turns the joined texts into exact sparse count vectors. Only whether a
term reaches the minimum matters to the fit, so documents run together stand there as that many rows
at most: the first has their terms, the next those of two documents or more, and so on. For the
counts they stand as rows that weigh 1, 2, 4 and so on: a term is in those whose weights add up to
its occurrences. Each task adds the weighted vectors up by source, as Summarizer does for one group,
and the sums of the tasks are added by Spark. Sources are
compared from the sparse sums: a term that one of two sources lacks needs only the count of the
other and a constant, so histograms of the counts do; terms that both have are paired within blocks
of terms.

The vocabulary of a CountVectorizer passes the driver and lies in every executor. A language with
more than ``UNIT_BYTES`` of text is therefore cut by a hash of the term into units with a vectorizer
of their own, to which the terms of every document are dealt once. The sums of a vectorizer are
written before the next is fitted, so that the driver needs one vocabulary at a time. No result
depends on the number of units.

For a term with ``count`` in a group whose kept terms occur ``N`` times, of a language with ``V``
kept terms: p = 1 + floor(scale * (count + 1) / (N + V)). The divergence of p from q is
floor((p - q) * (p - q) / q). All of it is computed in integers, with decimals where 64 bits could
overflow.

Defined results: null texts, languages and sources are read as ''; a document without a term still
makes its group occur; repeated rows are documents of their own; a language without kept terms has
pairs with value 0 and no terms; ties are ordered by the item's bytes; an empty table gives an
empty table. Only the named columns are read. A long text is one row of the vectorizer.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm.tables import new_folder, written
from assaykit.session import durable, small_batches, small_side

SCALE = 10**9
MOST_TERMS = 2**31 - 1
#: Text of one vectorizer. Its vocabulary, which passes the driver, grows more slowly.
UNIT_BYTES = 2 << 30
#: Numbers that a task adds up before it passes them on (8 bytes each).
SUMS = 1 << 24
#: Vocabulary places of one chunk of a vector of sums.
CHUNK = 1 << 14
#: Entries (term, source) compared in one block.
BLOCK = 100_000
#: Bytes of documents that are run together; a longer document stays as it is.
JOINED = 1 << 20
#: Bytes of texts, and terms of groups, that a task holds before it passes all of them on.
HELD_BYTES, HELD_TERMS = 1 << 24, 3 << 18
#: Groups that leave a task in one batch.
TOGETHER = 32
#: Groups up to which a table with a row for each is broadcast.
FEW_GROUPS = 100_000
#: Fixed value: characters between terms.
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The same on UTF-8, where all bytes of other characters are 0x80 or more.
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256)).lower()
#: Stands between documents; no term holds a line feed.
_END = b" \n "


def terms_of(text: Column) -> Column:
    """The terms of a text, and perhaps '' at its ends; of its letters only A to Z are lower-cased.

    ``lower`` does that as long as no other character has a lower case; it is much faster than
    replacing letter by letter.
    """
    ascii_only = F.octet_length(text) == F.length(text)
    plain = ascii_only | ~text.rlike(r"[[\p{IsUppercase}\p{Lt}]&&[^\x00-\x7F]]")
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.split(lowered, BETWEEN)


def _spread(distinct: set[bytes], counts: Counter, more: list[set[bytes]]) -> None:
    """Note a document's terms, before they are counted, in the set of those met so often or more."""
    again = distinct & counts.keys()
    for layer in more:
        if not again:
            break
        known = again & layer
        layer |= again
        again = known


def _bits(counts: Counter) -> list[bytes]:
    """Terms and their counts, as rows of which the k-th holds those whose count has the bit k."""
    terms = np.array(list(counts), dtype=object)
    left = np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    rows = []
    while len(left):  # most terms are rare, so what is left shrinks fast
        rows.append(b" ".join(terms[left & 1 == 1].tolist()))
        terms, left = terms[left > 1], left[left > 1] >> 1
    return rows


def joined(documents: DataFrame, least: int = 3, texts: bool = True) -> DataFrame:
    """(lang, source, text, spread, counts) with the terms of every text, a space between them.

    Documents of one group that a task meets are run together with a line feed between them, as
    long as they have at most ``JOINED`` bytes; those without terms are left out. ``spread`` has
    their distinct terms: a term that is in d of the documents is in min(d, least) of its rows, so
    over any number of them it reaches ``least`` rows where it reaches ``least`` documents.
    ``counts`` has all their terms: those in its rows k occur as often as the sum of 2**k says.
    Without ``texts``, text is null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple, list[bytes]] = {}
        sizes: dict[tuple, int] = {}
        more: dict[tuple, list[set[bytes]]] = {}  # terms of 2 documents or more, of 3, and so on
        counts: dict[tuple, Counter] = {}
        held = terms = 0

        def out(keys: list[tuple]) -> pa.RecordBatch:
            langs, sources = zip(*keys, strict=True)
            plain = [_END.join(waiting.pop(key)) if texts else None for key in keys]
            layers = [[b" ".join(layer) for layer in (counts[key], *more.pop(key)) if layer] for key in keys]
            bits = [_bits(counts.pop(key)) for key in keys]
            for key in keys:
                del sizes[key]
            lists = pa.list_(pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sources, pa.string()),
                 pa.array(plain, pa.binary()), pa.array(layers, lists), pa.array(bits, lists)],
                ["lang", "source", "text", "spread", "counts"],
            )

        def all_out() -> Iterator[pa.RecordBatch]:
            keys = list(sizes)
            for at in range(0, len(keys), TOGETHER):
                yield out(keys[at : at + TOGETHER])

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.translate(_PLAIN).split()
                if not words:
                    continue
                key, size = (lang, source), len(text)
                if key not in sizes:
                    sizes[key], counts[key] = 0, Counter()
                    more[key] = [set() for _ in range(least - 1)]
                if texts:
                    waiting.setdefault(key, []).append(b" ".join(words))
                before = len(counts[key])
                _spread(set(words), counts[key], more[key])
                counts[key].update(words)
                sizes[key] += size
                held, terms = held + size, terms + len(counts[key]) - before
                if sizes[key] >= JOINED:
                    held, terms = held - sizes[key], terms - len(counts[key])
                    yield out([key])
            if texts and held >= HELD_BYTES or terms >= HELD_TERMS:  # many groups with little text each
                held = terms = 0
                yield from all_out()
        yield from all_out()

    rows = documents.select("lang", "source", F.col("text").cast("binary").alias("text"))
    plain = rows.mapInArrow(
        run, "lang string, source string, text binary, spread array<binary>, counts array<binary>"
    )
    kinds = {"text": "string", "spread": "array<string>", "counts": "array<string>"}
    return plain.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


def dealt(rows: DataFrame, units: int) -> DataFrame:
    """(source, weight, tokens, unit): one row per row and unit that has tokens of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("tokens")
            owner = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            flat = lists.flatten()
            coded = flat.dictionary_encode()
            unit_of = np.array(
                [zlib.crc32(t.encode()) % units for t in coded.dictionary.to_pylist()], dtype=np.int64
            )
            unit = unit_of[coded.indices.to_numpy()] if len(coded) else np.empty(0, dtype=np.int64)
            order = np.lexsort((owner, unit))
            owner, unit = owner[order], unit[order]
            new = np.ones(len(owner), dtype=bool)
            new[1:] = (owner[1:] != owner[:-1]) | (unit[1:] != unit[:-1])
            first = np.flatnonzero(new)
            ends = pa.array(np.append(first, len(owner)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("source").take(pa.array(owner[first])),
                    batch.column("weight").take(pa.array(owner[first])),
                    pa.ListArray.from_arrays(ends, flat.take(pa.array(order))),
                    pa.array(unit[first].astype(np.int32)),
                ],
                ["source", "weight", "tokens", "unit"],
            )

    return rows.mapInArrow(run, "source string, weight long, tokens array<string>, unit int")


class _Sums:
    """Sums of sparse vectors by key, chunk by chunk of their places, at most ``SUMS`` numbers."""

    def __init__(self):
        self.chunks: dict[tuple, np.ndarray] = {}

    def add(self, key, places: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Add to the vector of a key; places in ascending order, maybe repeated."""
        if not len(places):
            return
        chunk = places // CHUNK
        names, starts = np.unique(chunk, return_index=True)
        for name, low, high in zip(
            names.tolist(), starts.tolist(), [*starts[1:].tolist(), len(places)], strict=True
        ):
            if (key, name) not in self.chunks:
                if (len(self.chunks) + 1) * CHUNK > SUMS and self.chunks:
                    yield from self.out()
                self.chunks[key, name] = np.zeros(CHUNK, dtype=np.int64)
            np.add.at(self.chunks[key, name], places[low:high] - name * CHUNK, values[low:high])

    def out(self) -> Iterator[pa.RecordBatch]:
        """Hand over everything as (source, chunk, places, values), the last two as bytes."""
        found = []
        for (source, chunk), sums in self.chunks.items():
            at = np.flatnonzero(sums)
            found.append((source, chunk, (at + chunk * CHUNK).tobytes(), sums[at].tobytes()))
        self.chunks.clear()
        columns = list(zip(*found, strict=True)) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            ["source", "chunk", "places", "values"],
        )


SUMMED = "source string, chunk long, places binary, values binary"


def _added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a task's weighted vectors by source."""
    sums = _Sums()
    for batch in batches:
        coded = batch.column("source").dictionary_encode()
        kind = coded.indices.to_numpy()
        indices, values = batch.column("indices"), batch.column("values")
        row = pc.list_parent_indices(indices).to_numpy()
        owner, weight = kind[row].astype(np.int64), batch.column("weight").to_numpy()[row]
        places = indices.flatten().to_numpy().astype(np.int64)
        order = np.argsort(owner << 32 | places)
        places, n = places[order], (values.flatten().to_numpy().astype(np.int64) * weight)[order]
        ends = np.searchsorted(owner[order], np.arange(len(coded.dictionary) + 1))
        for at, source in enumerate(coded.dictionary.to_pylist()):
            mine = slice(ends[at], ends[at + 1])
            yield from sums.add(source, places[mine], n[mine])
    yield from sums.out()


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of several tasks, as (source, chunk, at, n)."""

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for source, chunk, places, values in zip(*(c.to_pylist() for c in part.columns), strict=True):
                at, n = np.frombuffer(places, dtype=np.int64), np.frombuffer(values, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([source] * len(at), pa.string()), pa.array([chunk] * len(at), pa.int64()),
                     pa.array(at), pa.array(n)],
                    ["source", "chunk", "at", "n"],
                )

    sums = _Sums()
    for batch in batches:
        for source, places, values in zip(
            *(batch.column(c).to_pylist() for c in ("source", "places", "values")), strict=True
        ):
            at, n = np.frombuffer(places, dtype=np.int64), np.frombuffer(values, dtype=np.int64)
            yield from rows(sums.add(source, at, n))
    yield from rows(sums.out())


def group_sums(rows: DataFrame, spread: DataFrame, least: int) -> tuple[DataFrame, int]:
    """(source, term, count) of the kept terms of (source, weight, tokens), counts above 0; how many.

    A term is kept that is in the tokens of ``least`` rows of ``spread``.
    """
    spark = rows.sparkSession
    vectorizer = CountVectorizer(
        inputCol="tokens", outputCol="counts", minDF=float(least), vocabSize=MOST_TERMS
    )
    model = vectorizer.fit(spread.select("tokens"))
    folder = new_folder(spark, "vocabulary")
    model.write().save(folder)
    stored = spark.read.parquet(f"{folder}/data").select(F.posexplode("vocabulary").alias("at", "term"))
    stored = stored.where("term <> ''")
    vectors = model.transform(rows).select("source", "weight", F.unwrap_udt("counts").alias("v"))
    vectors = vectors.select("source", "weight", "v.indices", "v.values")
    parts = vectors.mapInArrow(_added_up, SUMMED)
    parts = parts.repartition("source", "chunk").mapInArrow(
        _merged, "source string, chunk long, at long, n long"
    )
    sums = parts.groupBy("source", "at").agg(F.sum("n").alias("count"))
    return sums.join(stored, "at").select("source", "term", "count"), stored.count()


def all_sums(
    documents: DataFrame, sizes: dict[str, int], least: int, unit_bytes: int
) -> tuple[DataFrame, dict[str, int]]:
    """(lang, source, term, count) of (lang, source, text), and the kept terms of each language."""
    spark, parts, kept = documents.sparkSession, [], dict.fromkeys(sizes, 0)
    plain = joined(documents, least, texts=False).drop("text").withColumn("code", F.sha2("lang", 256))
    # each language is read twice; a reader may hold a row group at once
    plain = written(plain, "by-language", ["code"], {"parquet.block.size": 16 << 20})
    for lang, size in sorted(sizes.items()):
        mine = F.col("code") == hashlib.sha256(lang.encode()).hexdigest()
        rows = plain.where(mine & (F.col("lang") == lang))
        # the pattern of one character is no regular expression to Java
        weight, tokens = F.expr("shiftleft(1L, pos)"), F.split("col", " ")
        rows, spread = (
            rows.select("source", F.posexplode(name)).where("col <> ''")
            .select("source", weight.alias("weight"), tokens.alias("tokens"))
            for name in ("counts", "spread")
        )
        units = -(-size // unit_bytes)
        if units > 1:
            rows = written(dealt(rows, units), "terms-by-unit", ["unit"])
            spread = written(dealt(spread, units), "spread-by-unit", ["unit"])
        for unit in range(max(units, 1)):
            if units > 1:
                mine = F.col("unit") == unit
                found, n = group_sums(rows.where(mine), spread.where(mine), least)
            else:
                found, n = group_sums(rows, spread, least)
            # written here, so that this vocabulary can go before the next passes the driver
            parts.append(written(found.select(F.lit(lang).alias("lang"), "*"), "sums"))
            kept[lang] += n
    empty = spark.createDataFrame([], "lang string, source string, term string, count long")
    return reduce(DataFrame.union, parts, empty), kept


def _share(count: str) -> Column:
    """p of a count, from the columns total and kept; with decimals where 64 bits do not do."""
    exact = f"(CAST({SCALE} AS DECIMAL(10,0)) * (CAST({count} AS DECIMAL(20,0)) + 1)) div (total + kept)"
    fits = 2**63 // SCALE - 2
    return F.expr(f"1 + IF({count} <= {fits}, {SCALE}L * ({count} + 1) div (total + kept), {exact})")


def _apart(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _by_blocks(entries: DataFrame, sizes: DataFrame, most_ranks: int) -> DataFrame:
    """(lang, source, part, item, value, terms): what needs all sources of a term, by blocks of terms.

    ``pair``: what terms that both sources have change, that is the divergence at those terms less
    what the two histograms say of them, and how many there are. ``term``: the first ``most_ranks``
    terms of a source in the block and those that tie with the last.
    """
    blocks = sizes.groupBy("lang").agg(F.ceil(F.sum("nonzero") / BLOCK).alias("blocks"))
    rows = entries.join(F.broadcast(blocks), "lang").select(  # one row per language
        "lang", "source", "term", "count", "p", "p0", "lang_total", "kept",
        F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"),
    )

    def run(key: tuple[Any, ...], frame: pd.DataFrame) -> pd.DataFrame:
        source, names = pd.factorize(frame["source"])
        term, words = pd.factorize(frame["term"])
        order = np.argsort(term, kind="stable")
        source, term = source[order].astype(np.int64), term[order]
        p, p0, count = (frame[c].to_numpy()[order] for c in ("p", "p0", "count"))
        codes, values = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for lag in range(1, int(np.bincount(term).max())):
            a = np.flatnonzero(term[lag:] == term[:-lag])
            b = a + lag
            for one, other in ((a, b), (b, a)):
                value = (p[one] - p[other]) ** 2 // p[other]
                value -= (p[one] - p0[other]) ** 2 // p0[other]
                value -= (p0[one] - p[other]) ** 2 // p[other]
                codes.append(source[one] * len(names) + source[other])
                values.append(value)
        pairs, at = np.unique(np.concatenate(codes), return_inverse=True)
        total = np.zeros(len(pairs), dtype=np.int64)
        np.add.at(total, at, np.concatenate(values))
        parts = [
            pd.DataFrame(
                {"source": names[pairs // len(names)], "part": "pair", "item": names[pairs % len(names)],
                 "value": total, "terms": np.bincount(at, minlength=len(pairs))}
            )
        ]
        in_lang = np.zeros(len(words), dtype=np.int64)
        np.add.at(in_lang, term, count)
        below = int(frame["lang_total"].iat[0]) + int(frame["kept"].iat[0])
        if int(in_lang.max()) > 2**63 // SCALE - 2:  # Python's integers, as 64 bits do not do
            in_lang = in_lang.astype(object)
        q = (1 + SCALE * (in_lang + 1) // below).astype(np.int64)[term]
        more = np.flatnonzero(p > q)
        value = (p[more] - q[more]) ** 2 // q[more]
        for name in np.unique(source[more]):
            mine = np.flatnonzero(source[more] == name)
            if len(mine) > most_ranks:
                least = np.partition(value[mine], len(mine) - most_ranks)[len(mine) - most_ranks]
                mine = mine[value[mine] >= least]
            parts.append(
                pd.DataFrame(
                    {"source": names[name], "part": "term", "item": words[term[more[mine]]],
                     "value": value[mine], "terms": 0}
                )
            )
        out = pd.concat(parts, ignore_index=True)
        out.insert(0, "lang", key[0])
        return out

    return rows.groupBy("lang", "block").applyInPandas(
        run, "lang string, source string, part string, item string, value long, terms long"
    )


def _pairs(entries: DataFrame, sizes: DataFrame, both: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of sources of a language."""
    other = sizes.select(
        "lang", F.col("source").alias("item"), F.col("p0").alias("item_p0"),
        F.col("nonzero").alias("item_nonzero"),
    )
    counts = entries.groupBy("lang", "source", "p", "p0").agg(F.count("*").alias("n"))
    joined = counts.join(other, "lang").where("source <> item")
    here = joined.select("lang", "source", "item", (F.col("n") * _apart("p", "item_p0")).alias("value"))
    there = joined.select(
        "lang", F.col("item").alias("source"), F.col("source").alias("item"),
        (F.col("n") * _apart("item_p0", "p")).alias("value"),
    )
    one_has = here.union(there).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    keys = ["lang", "source", "item"]
    both = both.groupBy(*keys).agg(F.sum("value").alias("both_value"), F.sum("terms").alias("terms"))
    rows = sizes.join(other, "lang").where("source <> item").join(one_has, keys, "left")
    rows = rows.join(both, keys, "left").na.fill(0, ["value", "both_value", "terms"])
    neither = (F.col("kept") - F.col("nonzero") - F.col("item_nonzero") + F.col("terms")) * _apart(
        "p0", "item_p0"
    )
    total = F.col("value") + F.col("both_value") + F.when(F.col("kept") > 0, neither).otherwise(0)
    return rows.select(*keys, total.alias("value"))


def audit(
    documents: DataFrame, least: int = 3, most_ranks: int = 200, lang_col: str = "lang",
    source_col: str = "source", text_col: str = "text", unit_bytes: int = UNIT_BYTES,
) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank.

    ``pair`` ranks the other sources of the language by their divergence from the group, ``term``
    the ``most_ranks`` terms that the group uses more than its language does. Terms of fewer than
    ``least`` documents of a language are not kept.
    """
    columns = {"lang": lang_col, "source": source_col, "text": text_col}
    small_batches(documents.sparkSession)
    rows = documents.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for name, c in columns.items())
    )
    groups = durable(rows.groupBy("lang", "source").agg(F.sum(F.octet_length("text").cast("long")).alias("bytes")))
    # one row per language
    text_sizes = {r["lang"]: r["bytes"] for r in groups.groupBy("lang").agg(F.sum("bytes").alias("bytes")).collect()}
    entries, kept = all_sums(rows, text_sizes, least, unit_bytes)

    totals = entries.groupBy("lang", "source").agg(
        F.sum("count").alias("total"), F.count("*").alias("nonzero")
    )
    sizes = groups.select("lang", "source").join(totals, ["lang", "source"], "left")
    sizes = sizes.join(documents.sparkSession.createDataFrame(list(kept.items()), "lang string, kept long"), "lang")
    sizes = durable(sizes.na.fill(0, ["total", "nonzero"]))
    in_lang = sizes.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    sizes = durable(sizes.join(in_lang, "lang").withColumn("p0", F.when(F.col("kept") > 0, _share("0"))))

    entries = entries.join(small_side(sizes.drop("nonzero"), FEW_GROUPS), ["lang", "source"])
    entries = entries.withColumn("p", _share("count")).drop("total")
    found = written(_by_blocks(entries, sizes, most_ranks), "blocks")
    pairs = _pairs(entries, sizes, found.where("part = 'pair'"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = found.where("part = 'term'").drop("terms")
    rank = F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    )
    terms = terms.withColumn("rank", rank).where(F.col("rank") <= most_ranks)
    return pairs.withColumn("rank", rank).union(terms)

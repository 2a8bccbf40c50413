"""Benchmark decontamination by template canonicalisation.

A text becomes a list of tokens in which numbers, names and units are typed placeholders. Windows
of the canonical tokens of benchmark items are looked up in the documents' windows. Matches on one
diagonal (document position minus item position) form an occurrence. Its largest consistent part
counts: the windows in which each value of the item stands for one value of the document. An
occurrence with changed values that are consistent is a re-parameterised copy. An item with fewer
windows than wanted needs all of its own; an item without any is looked for as a whole.

A first pass hashes the documents' windows and keeps the places whose hash the benchmark has; that
side is broadcast after a count, so the corpus is not shuffled. A second pass cuts the tokens at
these places, confirms equal templates and compares slots.

Defined results: null or empty texts match nothing; an item with fewer than ``least_words`` plain
words matches only with its own values, and nothing if it also has fewer than ``window`` tokens; rows with a null doc_id or item_id are left out; items with equal canonical tokens and slot values are one item
with the smallest item_id; repeated document rows count once. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaykit.functions.stages import with_computed
from assaykit.llm.quality import let
from assaykit.session import durable, small_side

MARK = "\x01"
#: A space between a word, number, comma or semicolon and a capitalised word.
NAME_START = r" (?<=[\p{L}\p{N},;] )(?=\p{Lu}\p{Ll})"
#: ASCII other than letters, digits and the mark; Latin-1 signs; general and CJK punctuation.
SEPARATORS = r"[\x00\x02-\x2F\x3A-\x60\x7B-\xBF\u2000-\u206F\u3000-\u303F]+"
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb oz ml l gal s sec min h hr hour hours minute minutes second "
    "seconds day days week weeks month months year years meter meters metre metres kilometer "
    "kilometers kilometre kilometres mile miles foot feet inch inches gram grams kilogram "
    "kilograms pound pounds liter liters litre litres dollar dollars euro euros cent cents percent "
    "degree degrees"
).split()


def tokens(text: Column) -> Column:
    """Lower-case words and numbers; names inside sentences carry a mark in front."""
    plain = F.replace(text, F.lit(MARK), F.lit(" "))
    plain = F.regexp_replace(plain, r"([0-9])[.,]([0-9])", "$1$2")
    plain = F.regexp_replace(plain, r"([0-9])(\p{L})", "$1 $2")
    plain = F.regexp_replace(plain, NAME_START, " " + MARK)
    plain = F.regexp_replace(F.lower(plain), SEPARATORS, " ")
    return F.array_remove(F.split(plain, " "), "")


def canonical(token: Column) -> Column:
    return _typed(token, F.lit(NAME), F.lit(NUMBER), F.lit(UNIT), token)


def _typed(token: Column, name: Column, number: Column, unit: Column, word: Column) -> Column:
    return (
        F.when(token.startswith(MARK), name)
        .when((token >= "0") & (token < ":"), number)
        .when(token.isin(UNITS), unit)
        .otherwise(word)
    )


def window_hashes(raw: Column, size: int) -> Column:
    """One hash of the canonical tokens per window; an empty array for a shorter text."""
    codes = [F.lit(k).cast("long") for k in (1, 2, 3)]
    hashes = F.transform(raw, lambda w: _typed(w, *codes, F.xxhash64(w)))

    def windows(each: Column) -> Column:
        every = F.transform(
            each, lambda h, i: F.xxhash64(h, *[F.get(each, i + k) for k in range(1, size)])
        )
        return F.slice(every, 1, F.greatest(F.size(each) - (size - 1), F.lit(0)))

    return let(hashes, windows)


def _keyed(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    table = table.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    return table.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))


def benchmark_windows(
    benchmark: DataFrame, window: int = 8, least_words: int = 5,
    id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """item_id, item_pos, hash and tokens of every window with enough plain words.

    ``own`` is the number of such windows of the item.
    """
    df = _items(benchmark, window, id_col, text_col)
    df = df.select("item_id", "raw", "canon", F.posexplode("windows").alias("item_pos", "hash"))
    df = df.select(
        "item_id",
        "item_pos",
        "hash",
        F.slice("canon", F.col("item_pos") + 1, window).alias("template"),
        F.slice("raw", F.col("item_pos") + 1, window).alias("item_values"),
    )
    df = df.where(_plain_words("template") >= least_words)
    return df.withColumn("own", F.count("*").over(Window.partitionBy("item_id")))


def whole_items(
    benchmark: DataFrame, window: int = 8, least_words: int = 5,
    id_col: str = "item_id", text_col: str = "text",
) -> DataFrame:
    """The items without such a window as one window each, found by the hash of its first tokens.

    ``verbatim`` items have too few plain words to be known by their template.
    """
    df = _items(benchmark, window, id_col, text_col)
    held = F.transform(
        "windows", lambda _, i: _plain_words(F.slice("canon", i + 1, window)) >= least_words
    )
    df = df.where(~F.exists(held, lambda x: x))
    short = F.size("raw") < window
    df = df.withColumn("verbatim", _plain_words("canon") < least_words).where(~(short & F.col("verbatim")))
    code = F.col("windows")[0]
    for size in range(least_words, window):
        code = F.when(F.size("raw") == size, window_hashes(F.col("raw"), size)[0]).otherwise(code)
    return df.select(
        "item_id", F.lit(0).alias("item_pos"), code.alias("hash"), F.col("canon").alias("template"),
        F.col("raw").alias("item_values"), F.lit(1).cast("long").alias("own"), "verbatim",
    )


def _items(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    df = _keyed(benchmark, id_col, text_col)
    df = with_computed(df, {"raw": tokens(F.col("text"))})
    df = with_computed(
        df,
        {
            "canon": F.transform("raw", canonical),
            "windows": window_hashes(F.col("raw"), window),
        },
    )
    return df.groupBy("raw", "canon", "windows").agg(F.min("key").alias("item_id"))


def _plain_words(template) -> Column:
    return F.size(F.filter(template, lambda w: ~w.isin(NUMBER, NAME, UNIT)))


def consistent_parts(windows: Column, slots: Column, least: Column) -> Column:
    """Index lists of consistent windows, the largest among them, none below ``least``.

    Per role with several values each value in turn stays, and the windows with another one go.
    Lists inside longer ones are dropped, as they can only stay shorter.
    """
    def role(x: Column) -> Column:
        return F.struct(x["kind"].alias("kind"), x["item_value"].alias("v"))

    clashing = F.filter(
        slots, lambda x: F.exists(slots, lambda y: (role(x) == role(y)) & (x["doc_value"] != y["doc_value"]))
    )

    def without_others(x: Column) -> Column:
        """Indexes of the windows in which the role of the slot has another value."""
        bad = F.transform(
            windows,
            lambda w, i: F.when(
                F.exists(w["slots"], lambda y: (role(x) == role(y)) & (x["doc_value"] != y["doc_value"])), i
            ),
        )
        return F.filter(bad, lambda i: i.isNotNull())

    choices = F.transform(
        F.array_distinct(F.transform(clashing, role)),
        lambda r: F.transform(F.filter(clashing, lambda x: role(x) == r), without_others),
    )

    def split(kept: Column, goes: Column) -> Column:
        each = F.flatten(F.transform(kept, lambda k: F.transform(goes, lambda g: F.array_except(k, g))))
        return let(F.filter(F.array_distinct(each), lambda k: F.size(k) >= least), longest)

    def longest(each: Column) -> Column:
        return F.filter(
            each,
            lambda k: ~F.exists(
                each, lambda o: (F.size(o) > F.size(k)) & (F.size(F.array_except(k, o)) == 0)
            ),
        )

    every = F.transform(windows, lambda _, i: i)
    return F.aggregate(choices, F.array(every), split)


def find(
    documents: DataFrame, benchmark: DataFrame, window: int = 8, least_words: int = 5,
    least_windows: int = 3, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document and item that it holds.

    doc_id, item_id, n_windows (windows of the largest consistent part of an occurrence), n_slots (its distinct
    slots), n_changed (slots with another value than in the item), exact (no slot changed).
    """
    wanted = benchmark_windows(benchmark, window, least_words).withColumn("verbatim", F.lit(False))
    wanted = durable(wanted.unionByName(whole_items(benchmark, window, least_words)))
    wanted = wanted.withColumn("length", F.size("template"))
    shorter = wanted.where(F.col("length") < window).select("length").distinct()
    sizes = [window, *sorted(row["length"] for row in shorter.collect())]  # at most window numbers
    rows = _keyed(documents, id_col, text_col)
    raw = tokens(F.col("text"))
    places = rows.select("key", F.posexplode(window_hashes(raw, window)).alias("pos", "hash"))
    for size in sizes[1:]:
        more = rows.select("key", F.posexplode(window_hashes(raw, size)).alias("pos", "hash"))
        places = places.unionByName(more)
    # one record per window, of which only those found go on
    places = places.join(small_side(wanted.select("hash", "length").distinct()), "hash")
    places = durable(places.distinct())
    by_document = places.groupBy("key").agg(
        # at most one per token of the text and length of an item
        F.collect_list(F.struct("pos", "hash", "length")).alias("found")
    )
    rows = rows.join(small_side(by_document), "key")
    rows = with_computed(rows, {"raw": tokens(F.col("text"))}).drop("text")
    rows = with_computed(rows, {"canon": F.transform("raw", canonical)})
    cut = F.transform(
        "found",
        lambda x: F.struct(
            x["pos"].alias("pos"),
            x["hash"].alias("hash"),
            F.slice("canon", x["pos"] + 1, x["length"]).alias("doc_template"),
            F.slice("raw", x["pos"] + 1, x["length"]).alias("doc_values"),
        ),
    )
    rows = with_computed(rows, {"cut": cut}).select("key", F.inline("cut"))
    matched = rows.join(small_side(wanted), "hash").where(
        (F.col("doc_template") == F.col("template"))
        & (~F.col("verbatim") | (F.col("doc_values") == F.col("item_values")))
    )
    slots = F.filter(
        F.zip_with(
            F.arrays_zip("template", "item_values"),
            "doc_values",
            lambda x, value: F.struct(
                x["template"].alias("kind"),
                x["item_values"].alias("item_value"),
                value.alias("doc_value"),
            ),
        ),
        lambda x: x["kind"].isin(NUMBER, NAME, UNIT),
    )
    # one occurrence has at most one window per position of the item, so these sets are small
    runs = matched.groupBy(
        F.col("key").alias("doc_id"), "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")
    ).agg(
        F.array_sort(F.collect_set(F.struct("item_pos", slots.alias("slots")))).alias("windows"),
        F.least(F.lit(least_windows), F.min("own")).alias("least"),
    )
    runs = runs.where(F.size("windows") >= F.col("least"))
    runs = with_computed(runs, {"slots": F.array_distinct(F.flatten("windows.slots"))})
    parts = consistent_parts(F.col("windows"), F.col("slots"), F.col("least"))
    roles = F.array_distinct(
        F.transform("slots", lambda x: F.struct(x["kind"].alias("kind"), x["item_value"].alias("v")))
    )
    every = F.array(F.transform("windows", lambda _, i: i))
    parts = F.when(F.size("slots") == F.size(roles), every).otherwise(parts)
    runs = runs.select("doc_id", "item_id", "windows", "least", F.explode(parts).alias("part"))
    kept = F.transform("part", lambda i: F.col("windows")[i])
    runs = with_computed(runs, {"kept": kept})
    runs = runs.select(
        "doc_id",
        "item_id",
        "least",
        F.size(F.array_distinct("kept.item_pos")).alias("n_windows"),
        F.array_distinct(F.flatten("kept.slots")).alias("slots"),
    ).where(F.col("n_windows") >= F.col("least"))
    changed = F.size(F.filter("slots", lambda x: x["item_value"] != x["doc_value"]))
    runs = runs.select(
        "doc_id",
        "item_id",
        F.struct(
            "n_windows",
            (-changed).alias("less"),
            F.size("slots").alias("n_slots"),
        ).alias("best"),
    )
    best = runs.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("best.n_windows").cast("long").alias("n_windows"),
        F.col("best.n_slots").cast("long").alias("n_slots"),
        (-F.col("best.less")).cast("long").alias("n_changed"),
        (F.col("best.less") == 0).alias("exact"),
    )

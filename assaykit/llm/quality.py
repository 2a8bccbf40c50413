"""Quality rules: a threshold table compiled into one projection, without user functions.

Defined results: a null or empty text has no words, all counts are 0 and the base rule fails it.
Repeated rows are judged one by one. Columns of the input other than the id and the text are not
read, so extra or clashing names do not matter. An empty table gives an empty table. stop_ratio is
null, and so fails no threshold, for a text in other letters than those of the stop words' languages;
mean_word_chars is null for a text in a script without spaces between words.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions.stages import with_computed

SYMBOLS = "[#*$%&|<>]"
SHOUTS = "[!?]"

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as with this be by on was are from or an at not have has "
    "de la le les et des un une du que qui pour dans est sur par au ne pas plus avec "
    "der die und den von das ist zu mit ein eine im dem nicht auf sich als auch für "
    "el los y del las se por con para su al lo como en no"
).split()
#: Letters that these languages do not use, and a share of them that speaks for another language.
OTHER_LETTER = r"[\p{L}&&[^A-Za-zÀ-ÂÄÆ-ÏÑ-ÔÖÙ-Üß-âäæ-ïñ-ôöù-üÿŒœŸªº]]"
OTHER_SHARE = 0.01
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
UNSPACED_SHARE = 0.2


@dataclass(frozen=True)
class Threshold:
    """A metric has to lie within these bounds; None leaves that side open."""

    metric: str
    low: float | None = None
    high: float | None = None

    def fails(self) -> Column:
        value, bad = F.col(self.metric), F.lit(False)
        if self.low is not None:
            bad = bad | (value < F.lit(self.low))
        if self.high is not None:
            bad = bad | (value > F.lit(self.high))
        return bad


#: The production table. Ratios are per word, per character in words, or per line with a word.
THRESHOLDS = (
    Threshold("mean_word_chars", 2.5, 12.0),
    Threshold("symbol_ratio", high=0.02),
    Threshold("shout_ratio", high=0.08),
    Threshold("stop_ratio", low=0.05),
    Threshold("dup_line_ratio", high=0.4),
)


def let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` as a lambda variable."""
    return F.transform(F.array(value), use)[0]


def word_list(text: Column) -> Column:
    """Words between white space; one plain separator lets the split work without a pattern."""
    return F.array_remove(F.split(F.regexp_replace(text, r"[\x09-\x0D]", " "), " "), "")


def repeated_words(windows: Column) -> Column:
    """Words inside three-word windows that stand twice or more, from the window hashes."""

    def from_sorted(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, j: F.coalesce(F.get(ordered, j - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False)),
        )
        return let(F.array_sort(F.transform(twice, lambda x: x["i"])), covered)

    def covered(starts: Column) -> Column:
        each = F.transform(
            starts, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(starts, j + 1) - x, F.lit(3)))
        )
        return F.aggregate(each, F.lit(0), lambda total, x: total + x)

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    slow = let(ordered, from_sorted)
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(slow)


def measure(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_rows: bool = False,
    any_case: bool = False,
) -> DataFrame:
    """One row per document: id, base counts and the ratios that thresholds refer to.

    With ``keep_rows`` the input row comes along as the struct ``row``. With ``any_case`` stop words
    count however they are written, otherwise in lower case or capitalised.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = [F.struct(*documents.columns).alias("row")] if keep_rows else []
    df = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"), *row)
    row = ["row"] if keep_rows else []
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = with_computed(
        df,
        {
            "facts": let(word_list(F.col("text")), lambda words: _word_facts(words, any_case)),
            "n_symbols": F.regexp_count("text", F.lit(SYMBOLS)).cast("long"),
            "n_shouts": F.regexp_count("text", F.lit(SHOUTS)).cast("long"),
            "n_other": F.regexp_count("text", F.lit(OTHER_LETTER)),
            "lines": lines,
        },
    )
    # scripts without spaces have none of the letters above
    unspaced = F.when(F.col("n_other") > 0, F.regexp_count("text", F.lit(UNSPACED))).otherwise(0)
    df = df.select(
        "doc_id", *row, "facts.*", "n_symbols", "n_shouts", "lines", "n_other", unspaced.alias("n_unspaced")
    )
    df = df.select(
        "doc_id",
        *row,
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_shouts",
        "n_stop",
        (F.col("n_other") > OTHER_SHARE * F.col("word_chars")).alias("other"),
        (F.col("n_unspaced") > UNSPACED_SHARE * F.col("word_chars")).alias("unspaced"),
    )
    return df.select(
        *[c for c in df.columns if c not in ("other", "unspaced")],
        F.when(~F.col("unspaced"), _ratio("word_chars", "n_words")).alias("mean_word_chars"),
        _ratio("n_symbols", "word_chars").alias("symbol_ratio"),
        _ratio("n_shouts", "word_chars").alias("shout_ratio"),
        F.when(~F.col("other"), _ratio("n_stop", "n_words")).alias("stop_ratio"),
        _ratio("n_dup_lines", "n_lines").alias("dup_line_ratio"),
    )


def judge(measured: DataFrame, thresholds=THRESHOLDS, least_words: int = 50) -> DataFrame:
    """Add base_failed, the names of failed thresholds and kept."""
    base = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    failed = F.concat_ws(",", *[F.when(t.fails(), F.lit(t.metric)) for t in thresholds])
    return measured.withColumns({"base_failed": base, "failed_rules": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("failed_rules") == "")
    )


def keep(documents: DataFrame, thresholds=THRESHOLDS, least_words: int = 50) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    judged = judge(measure(documents, keep_rows=True, any_case=True), thresholds, least_words)
    return judged.where("kept").select("row.*")


def _word_facts(words: Column, any_case: bool) -> Column:
    def is_stop(w: Column) -> Column:
        return F.lower(w).isin(STOP_WORDS) if any_case else w.isin(_STOP_FORMS)

    windows = F.transform(
        words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.size(F.filter(words, is_stop)).cast("long").alias("n_stop"),
        F.slice(windows, 1, F.greatest(F.size(words) - 2, F.lit(0))).alias("windows"),
    )


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


_STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize())})

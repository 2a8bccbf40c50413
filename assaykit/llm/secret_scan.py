"""Secret scans through a trigram inverted index, with DataFrame functions only.

Each rule's pattern gives a Boolean trigram query: what trigrams must a text hold to match? The
index has one posting (trigram, text key) per text that holds a trigram of any query; postings of a
text are intersected under the rules' queries, and only rules that survive are run on its text. A
rule without mandatory trigrams runs on every text. Keys only nominate: a clash of two keys costs
a look and never changes a result.

Defined results: a null or empty text has no spans; repeated rows are scanned one by one; null
ids stay null; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass
from re import _constants as ops
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit.functions.stages import with_computed
from assaykit.llm.quality import let
from assaykit.session import durable, small_side


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters or more; else the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, in the order in which kinds are listed. A run of the last two kinds
#: is a match from its start to its end whether or not the length stands in the pattern, so it does.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Rules of this operator's own.
MORE_RULES = (
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES
MOST_STRINGS = 64


# --- from a pattern to a Boolean trigram query: nested ("and" | "or", parts), a trigram, or None


def trigram_query(pattern: str):
    """The query that each matching text satisfies once lower-cased; None: any text may match."""
    strings, query = _of_sequence(parser.parse(pattern))
    return _join("and", [query, _of_strings(strings)])


def _join(kind: str, parts: list):
    if kind == "or" and any(p is None for p in parts):
        return None
    parts = list(dict.fromkeys(p for p in parts if p is not None))
    if kind == "or":  # (a and b) or (a and b and c) is (a and b)
        parts = [p for p in parts if not any(grams_of(q) < grams_of(p) for q in parts)]
    return (kind, tuple(parts)) if len(parts) > 1 else (parts[0] if parts else None)


def _of_strings(strings: set[str]):
    each = []
    for text in sorted(strings):
        grams = sorted({text[i : i + 3] for i in range(len(text) - 2)})
        each.append(_join("and", grams))
    return _join("or", each)


def _of_sequence(items) -> tuple[set[str], object]:
    """The last run of possible strings, and the query for all that stood before it."""
    run, queries = {""}, []
    for item in items:
        strings, query = _of_item(*item)
        queries.append(query)
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = {a + b for a in run for b in strings}
        else:
            queries.append(_of_strings(run))
            run = strings or {""}
    return run, _join("and", queries)


def _of_item(op, value) -> tuple[set[str] | None, object]:
    """Possible strings of one item (None: too many to list) and a query for what is inside."""
    if op is ops.LITERAL:
        return {chr(value).lower()}, None
    if op is ops.IN:
        listed = {chr(v).lower() for o, v in value if o is ops.LITERAL}
        return (listed, None) if len(listed) == len(value) <= 8 else (None, None)
    if op is ops.SUBPATTERN:
        return _whole(value[-1])
    if op is ops.BRANCH:
        parts = [_whole(branch) for branch in value[1]]
        if all(s is not None and q is None for s, q in parts):
            return set().union(*(s for s, _ in parts)), None
        each = [_join("and", [q, _of_strings(s) if s is not None else None]) for s, q in parts]
        return None, _join("or", each)
    if op in (ops.MAX_REPEAT, ops.MIN_REPEAT):
        low, high, inner = value
        strings, query = _whole(inner)
        if (low, high) == (0, 1) and strings is not None and query is None:
            return strings | {""}, None
        if low == 0:
            return None, None
        return None, _join("and", [query, _of_strings(strings) if strings is not None else None])
    return None, None


def _whole(items) -> tuple[set[str] | None, object]:
    """Strings of a sub-pattern if it can be listed as a whole; else its query alone."""
    run = {""}
    for item in items:
        strings, query = _of_item(*item)
        if strings is None or query is not None or len(run) * len(strings) > MOST_STRINGS:
            tail, before = _of_sequence(items)
            return None, _join("and", [before, _of_strings(tail)])
        run = {a + b for a in run for b in strings}
    return run, None


def grams_of(query) -> set[str]:
    if query is None:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_of, query[1]))


def _holds(query, grams: Column) -> Column:
    if isinstance(query, str):
        return F.array_contains(grams, query)
    both = (lambda a, b: a & b) if query[0] == "and" else (lambda a, b: a | b)
    return functools.reduce(both, [_holds(part, grams) for part in query[1]])


# --- index, candidates, verification


def postings(texts: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, key): one row per text and gram of the queries that the lower-cased text holds."""
    df = with_computed(texts, {"low": F.lower("text")}).drop("text")
    hits = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return df.select(F.explode(hits).alias("gram"), "key")


def candidates(texts: DataFrame, rules=RULES) -> DataFrame:
    """(key, rules): names of the rules whose trigram query the text's postings satisfy."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    grams = sorted(set().union(set(), *map(grams_of, queries.values())))
    if not grams:
        return texts.select("key", F.array().cast("array<string>").alias("rules")).limit(0)
    held = postings(texts, grams).groupBy("key").agg(F.collect_set("gram").alias("grams"))
    kept = F.array_compact(
        F.array(*[F.when(_holds(q, F.col("grams")), F.lit(k)) for k, q in queries.items()])
    )
    return held.select("key", kept.alias("rules")).where(F.size("rules") > 0)


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, order, end, kind>> of the kept matches, in code points."""
    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x)).alias("gaps"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda x: F.length(x)).alias("widths"),
        F.transform(
            F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda x: F.length(x)
        ).alias("checked"),
    )

    def from_parts(p: Column) -> Column:
        # end of every match: gaps and matches alternate, and a match follows each gap but the last
        ends = F.aggregate(
            F.zip_with(F.slice(p["gaps"], 1, F.size(p["widths"])), p["widths"], lambda g, w: g + w),
            F.array().cast("array<int>"),
            lambda done, step: F.concat(
                done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + step)
            ),
        )
        every = F.transform(
            ends,
            lambda end, i: F.struct(
                (end - F.get(p["widths"], i)).alias("start"),
                F.lit(order).alias("order"),
                end.alias("end"),
                F.lit(rule.kind).alias("kind"),
            ),
        )
        return F.filter(every, lambda x, i: F.get(p["checked"], i) >= rule.least)

    return F.when(text.rlike(rule.pattern), let(parts, from_parts)).otherwise(
        F.array().cast(SPANS)
    )


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def scan(
    documents: DataFrame, rules=RULES, id_col: str = "doc_id", text_col: str = "text",
    keep_rows: bool = False,
) -> DataFrame:
    """One row per document: doc_id and spans (by start, then rule), plus the text if asked for.

    With ``keep_rows`` all input columns stay, and the spans come as ``secret_spans``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    texts = documents.select(key.alias("key"), text.alias("text"))
    nominated = small_side(durable(candidates(texts, rules)))
    if keep_rows:
        rows = documents.select(F.struct(*documents.columns).alias("row"), text.alias("text"), key.alias("key"))
    else:
        rows = documents.select(F.col(id_col).alias("doc_id"), text.alias("text"), key.alias("key"))
    rows = rows.join(nominated, "key", "left")
    found = []
    for order, rule in enumerate(rules):
        spans = spans_of(F.col("text"), rule, order)
        if trigram_query(rule.pattern) is not None:
            spans = F.when(F.array_contains("rules", rule.kind), spans).otherwise(
                F.array().cast(SPANS)
            )
        found.append(spans)
    every = F.array_sort(F.concat(*found)).alias("secret_spans" if keep_rows else "spans")
    if keep_rows:
        return rows.select("row.*", every)
    return rows.select("doc_id", "text", every)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span (overlapping ones as one) replaced by its kind in brackets."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, span: Column) -> Column:
        part = F.concat(
            state["done"],
            F.substr(text, state["at"] + 1, span["start"] - state["at"]),
            F.lit("["),
            span["kind"],
            F.lit("]"),
        )
        done = F.when(span["start"] >= state["at"], part).otherwise(state["done"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), done.alias("done"))

    def finish(state: Column) -> Column:
        return F.concat(state["done"], F.substr(text, state["at"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)

"""License scans: exact phrases, and short notices with a bounded number of edits.

A notice with up to k edits, cut into k + 1 pieces, holds one piece unchanged (pigeonhole). The
pieces of all notices are searched exactly; each hit nominates a stretch around it, as long as the
notice and its edits, where the regex library looks for the notice with at most k insertions,
deletions or substitutions. It reports the closest one, after which the stretch before and the one
behind are looked at alike. Stretches are looked at once and are short, so the work grows with the
hits. Of overlapping finds the one with the fewest edits, then the longest, stays.

Texts are read as lower-case words (ASCII letters, digits and all characters beyond ASCII) joined
by single spaces, so line breaks and punctuation do not matter. Spans are counted in words.

Defined results: a null or empty text has no words, no places and score 0; repeated rows are
scanned one by one; an empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import accumulate

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
SEPARATED = "".join(
    chr(c).lower() if chr(c).isalnum() else " " for c in range(128)
)


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    edits: int

    def pieces(self) -> list[tuple[int, str]]:
        """edits + 1 pieces of nearly equal length with their places in the notice."""
        n, parts = len(self.text), self.edits + 1
        cuts = [n * k // parts for k in range(parts + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    @cached_property
    def framed(self) -> str:
        return f" {self.text} "

    @cached_property
    def pattern(self):
        notice = regex.escape(self.text, literal_spaces=True)
        return regex.compile(rf"(?b)\b(?:{notice}){{e<={self.edits}}}\b")

    def matches(self, joined: str, begin: int, end: int) -> Iterator:
        """The best match of the stretch, then those of what is left on its two sides."""
        least, left = max(1, len(self.text) - self.edits), [(begin, end)]
        while left:
            begin, end = left.pop()
            match = self.pattern.search(joined, begin, end) if end - begin >= least else None
            if match:
                yield match
                left += [(begin, match.start()), (match.end(), end)]


#: Short notices of this operator's own; one edit for about ten characters.
NOTICES = (
    Notice("gnu general public license", "gpl", 2),
    Notice("gnu lesser general public license", "lgpl", 3),
    Notice("gnu affero general public license", "agpl", 3),
    Notice("licensed under the apache license", "apache", 3),
    Notice("apache license version 2 0", "apache", 2),
    Notice("released under the mit license", "mit", 3),
    Notice("the mit license", "mit", 1),
    Notice("permission is hereby granted free of charge to any person", "mit", 5),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("bsd 3 clause license", "bsd", 2),
    Notice("mozilla public license", "mpl", 2),
    Notice("licensed under cc by nc 4 0", "cc-by-nc", 2),
    Notice("licensed under cc by sa 4 0", "cc-by-sa", 2),
    Notice("licensed under cc by 4 0", "cc-by", 2),
    Notice("creative commons attribution", "cc-by", 2),
    Notice("all rights reserved", "reserved", 1),
)


@dataclass(frozen=True)
class Found:
    label: str
    start: int  # in characters of the joined words
    end: int
    edits: int
    notice: str

    @property
    def score(self) -> float:
        return 1.0 - self.edits / len(self.notice)


class Scanner:
    """Built once per task."""

    def __init__(self, phrases=PHRASES, notices=NOTICES):
        self.phrases, self.notices = dict(phrases), notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for n, notice in enumerate(notices):
            for at, piece in notice.pieces():
                seeds.setdefault(piece, []).append((n, at))
        self.seeds = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.seeds.add_word(piece, (len(piece), places))
        self.seeds.make_automaton()

    def exact(self, joined: str) -> list[tuple[str, int]]:
        """(label, character) of all places where a phrase's words stand consecutively."""
        framed, found = f" {joined} ", []
        for phrase, label in self.phrases.items():
            needle, at = f" {phrase} ", -1
            while (at := framed.find(needle, at + 1)) >= 0:
                found.append((label, at))
        return found

    def fuzzy(self, joined: str) -> list[Found]:
        """Verified notices: seeds nominate stretches, each of which is looked at once."""
        places = {
            (n, last + 1 - size - at) for last, (size, each) in self.seeds.iter(joined) for n, at in each
        }
        found, framed = set(), f" {joined} "
        for n, start in places:
            notice = self.notices[n]
            end = start + len(notice.text)
            if start >= 0 and framed.startswith(notice.framed, start):  # nothing to verify
                found.add(Found(notice.label, start, end, 0, notice.text))
                continue
            begin, end = max(0, start - notice.edits - 1), min(end + notice.edits + 1, len(joined))
            for match in notice.matches(joined, begin, end):
                found.add(Found(notice.label, *match.span(), sum(match.fuzzy_counts), notice.text))
        return _apart(found)


def _apart(found: Iterable[Found]) -> list[Found]:
    """Finds without overlaps, in order of place; closer and longer ones go first."""
    kept: list[Found] = []  # in order of place
    for f in sorted(found, key=lambda f: (f.edits, f.start - f.end, f.start, f.notice)):
        at = bisect_left(kept, f.start, key=lambda k: k.start)
        before = at > 0 and kept[at - 1].end > f.start
        after = at < len(kept) and kept[at].start < f.end
        if not before and not after:
            kept.insert(at, f)
    return kept


def scan(
    documents: DataFrame, phrases=PHRASES, notices=NOTICES,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document with exact places, verified notices (word spans, edits) and labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(phrases, notices)
        for batch in batches:
            yield pd.DataFrame(
                [
                    (key, *_row(scanner, text))
                    for key, text in zip(batch["doc_id"], batch["text"], strict=True)
                ],
                columns=["doc_id", *COLUMNS],
            ).astype({"doc_id": batch["doc_id"].dtype})

    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, {SCHEMA}")


COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "notices"]
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, "
    "notices array<struct<label:string,first:long,last:long,edits:int,notice:string>>"
)


def _row(scanner: Scanner, text: str | None) -> tuple:
    words = (text or "").translate(SEPARATED).split(" ")
    words = [w for w in words if w]
    joined = " ".join(words)
    exact, fuzzy = scanner.exact(joined), scanner.fuzzy(joined)
    ends = list(accumulate(len(w) + 1 for w in words)) if exact or fuzzy else []

    def word(at: int) -> int:
        """The number of spaces before a character."""
        return bisect_right(ends, at)

    starts = [word(at) for _, at in exact]
    base = sorted({label for label, _ in exact})
    labels = sorted({*base, *(f.label for f in fuzzy)})
    score = 1.0 if exact else max((f.score for f in fuzzy), default=0.0)
    spans = [
        {
            "label": f.label,
            "first": word(f.start),
            "last": word(f.end),
            "edits": f.edits,
            "notice": f.notice,
        }
        for f in sorted(fuzzy, key=lambda f: (f.start, f.end, f.label))
    ]
    return (
        len(words),
        len(exact),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(base),
        ",".join(labels),
        score,
        spans,
    )

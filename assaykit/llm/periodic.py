"""Periodic runs of words: stretches that repeat themselves, and texts without the repetitions.

Documents are joined into one sequence of word codes, with a code of its own before, between and
behind them, so that nothing extends over an end. How far two places agree is answered by a
difference cover: of every ``PERIOD`` places ``COVER`` are sampled, only suffixes at samples are
sorted, and any two places reach samples by the same step of less than ``PERIOD`` words, which are
compared one by one. Behind that, the common length is the least of the lengths between neighbours
in the order of suffixes, which a sparse table gives. The reversed sequence answers the other
direction.

Runs are found on a harmonic grid. A run of period q holds ``step(q)`` neighbouring places whose
word is repeated q words on, so it is enough to look at every ``step(q)``-th place: about n/3q of
them for each q, and about n * log(n) / 3 in all. Places whose word differs q words on are left at
once, the others are extended both ways.

A stretch found for several periods is a run of the smallest. By the theorem of Fine and Wilf the
others are multiples of it, as the stretch is four times as long.

Defined results: a null or empty text has no words and no runs; repeated rows are documents of
their own; null ids stay null; an empty table gives an empty table. Only the named columns are read.
A long text is handled alone; its task holds about 60 bytes a word and 10 bytes a word and power of
two of its samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A perfect difference set: every step between residues is the step of exactly one pair.
COVER, PERIOD = (0, 1, 3, 8, 12, 18), 31
#: Words of one sequence of several documents, and pairs of places looked at together.
UNIT_WORDS, PAIRS = 1 << 18, 1 << 20
#: Fixed value: characters between words.
BETWEEN = r"[\x20\x09-\x0D]+"


def _shifts() -> np.ndarray:
    """The step to samples, by the residue of one place and the distance to the other."""
    table = np.empty((PERIOD, PERIOD), dtype=np.int64)
    for at in range(PERIOD):
        table[at, 0] = min((c - at) % PERIOD for c in COVER)
        for a in COVER:
            for b in COVER:
                if a != b:
                    table[at, (b - a) % PERIOD] = (a - at) % PERIOD
    return table


_SHIFT = _shifts()


class Extension:
    """How many words from two places on are equal. The last code must occur once."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(len(codes)) % PERIOD])
        self.sample = np.full(len(codes), -1, dtype=np.int64)
        self.sample[at] = np.arange(len(at))
        names, block = self._sort(at)
        self.rank = names[-1]
        order = np.empty(len(at), dtype=np.int64)
        order[self.rank] = at
        self.least = [self._neighbours(order, names, block)]
        width = 1
        while 2 * width < len(at):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _sort(self, at: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Ranks of the sampled suffixes by their first words, by twice as many and so on.

        Equal suffixes have the rank of the first of them. Only tied suffixes are sorted on: by
        their next words, packed into one number, then by the rank of what follows. The last
        ranks are those of whole suffixes.
        """
        bits = max(1, int(self.codes.max()).bit_length())
        packed = max(1, 62 // bits)
        turns = -(-PERIOD // packed)
        words = np.concatenate([self.codes, np.zeros(packed * turns, dtype=np.int64)])
        rank = np.zeros(len(at), dtype=np.int64)
        tied = np.arange(len(at))
        for turn in range(turns):
            key = np.zeros(len(tied), dtype=np.int64)
            for k in range(turn * packed, (turn + 1) * packed):
                key = key << bits | words[at[tied] + k]
            tied = _refine(rank, tied, key)
            if not len(tied):
                break
        names, reach = [rank.copy()], PERIOD
        while len(tied):
            tied = _refine(rank, tied, rank[self.sample[at[tied] + reach]])
            names.append(rank.copy())
            reach *= 2
        return names, packed * turns

    def _neighbours(self, order: np.ndarray, names: list[np.ndarray], block: int) -> np.ndarray:
        """Common words of suffixes that follow each other, by falling powers of two."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), dtype=np.int64)
        for power in range(len(names) - 1, -1, -1):
            name, step = names[power], PERIOD << power
            equal = np.flatnonzero(name[self.sample[a]] == name[self.sample[b]])
            for x in (a, b, common):
                x[equal] += step
        live = np.arange(len(a))
        for _ in range(block):
            live = live[self.codes[a[live]] == self.codes[b[live]]]
            if not len(live):
                break
            for x in (a, b, common):
                x[live] += 1
        return common

    def __call__(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        shift = _SHIFT[one % PERIOD, (other - one) % PERIOD]
        common = shift.copy()
        live, same = np.arange(len(one)), [np.flatnonzero(shift == 0)]
        live = live[shift > 0]
        for k in range(PERIOD):
            if not len(live):
                break
            equal = self.codes[one[live] + k] == self.codes[other[live] + k]
            common[live[~equal]] = k
            live = live[equal]
            there = shift[live] == k + 1
            same.append(live[there])
            live = live[~there]
        found = np.concatenate(same)
        if len(found):
            a = self.rank[self.sample[one[found] + shift[found]]]
            b = self.rank[self.sample[other[found] + shift[found]]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            power = np.frexp((high - low).astype(np.float64))[1] - 1
            for p in np.unique(power):
                mine = power == p
                table, width = self.least[p], 1 << p
                l, h = low[mine], high[mine] - width
                common[found[mine]] += np.minimum(table[l], table[h])
        return common


def _refine(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split groups of equal rank by a key; returns those that are still tied."""
    before = rank[tied]
    order = np.lexsort((key, before))
    tied, before, key = tied[order], before[order], key[order]
    start = np.ones(len(tied), dtype=bool)
    start[1:] = before[1:] != before[:-1]
    split = start.copy()
    split[1:] |= key[1:] != key[:-1]
    place = np.arange(len(tied))
    group = np.maximum.accumulate(np.where(start, place, 0))
    part = np.maximum.accumulate(np.where(split, place, 0))
    rank[tied] = before + part - group
    alone = split & np.append(split[1:], True)
    return tied[~alone]


class Runs(NamedTuple):
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def runs_of(codes: np.ndarray, longest: int, least: int = 6, times: int = 4) -> Runs:
    """Runs of a sequence whose first and last codes occur once, by start, then period.

    No run has more than ``longest`` words; a run has at least ``least`` and ``times`` periods.
    """
    n, periods = len(codes), np.arange(1, longest // times + 1)
    found: list[np.ndarray] = []
    if len(periods) and longest >= least:
        ahead, back = Extension(codes), Extension(np.ascontiguousarray(codes[::-1]))
        steps = np.maximum(least, times * periods) - periods
        sizes = -(-(n - periods) // steps)
        ends = np.cumsum(sizes)
        for low in range(0, int(ends[-1]), PAIRS):
            flat = np.arange(low, min(low + PAIRS, int(ends[-1])))
            first, last = np.searchsorted(ends, (flat[0], flat[-1]), "right")
            share = np.diff(np.clip(np.append(ends[first : last + 1], flat[-1] + 1), None, flat[-1] + 1),
                            prepend=flat[0])[: last - first + 1]
            which = np.repeat(np.arange(first, last + 1), share)
            place = (flat - (ends - sizes)[which]) * steps[which]
            period = periods[which]
            equal = codes[place] == codes[place + period]
            place, period = place[equal], period[equal]
            right = ahead(place, place + period)
            left = back(n - 1 - place - period, n - 1 - place)
            length = right + left - 1 + period
            enough = length >= np.maximum(least, times * period)
            found.append(np.stack([place - left + 1, length, period])[:, enough])
            found = [_smallest(np.concatenate(found, axis=1))]
    if not found:
        found = [np.empty((3, 0), dtype=np.int64)]
    start, length, period = found[0]
    order = np.lexsort((period, start))
    return Runs(start[order], length[order], period[order])


def _smallest(found: np.ndarray) -> np.ndarray:
    """One entry per stretch, with its smallest period."""
    start, length, period = found
    found = found[:, np.lexsort((period, length, start))]
    new = np.ones(found.shape[1], dtype=bool)
    new[1:] = (found[:2, 1:] != found[:2, :-1]).any(axis=0)
    return found[:, new]


def repeated_places(runs: Runs, n: int) -> np.ndarray:
    """Which of n words lie in a run behind its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs.start + runs.period, 1)
    np.add.at(change, runs.start + runs.length, -1)
    return np.cumsum(change[:-1]) > 0


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _units(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about UNIT_WORDS words."""
    low, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        if at > low and total + size > UNIT_WORDS:
            yield low, at
            low, total = at, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def _scan(texts: pa.Array, least: int, times: int) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Word counts, runs and collapsed texts of a few documents."""
    rows = len(texts)
    parts = pc.split_pattern_regex(texts, BETWEEN)
    owner, parts = pc.list_parent_indices(parts), parts.flatten()
    filled = pc.not_equal(parts, "")
    words = parts.filter(filled)
    owner = owner.filter(filled).to_numpy().astype(np.int64)
    ends = np.searchsorted(owner, np.arange(rows + 1))  # first word of each document, then all
    coded = words.dictionary_encode()
    n, kinds = len(words), len(coded.dictionary)
    # word w lies at w + 1 + its document; the places between hold codes used once
    codes = np.empty(n + rows + 1, dtype=np.int64)
    codes[ends + np.arange(rows + 1)] = kinds + np.arange(rows + 1)
    codes[np.arange(n) + 1 + owner] = coded.indices.to_numpy()
    runs = runs_of(codes, int(np.diff(ends).max(initial=0)), least, times)
    of = np.searchsorted(ends + np.arange(rows + 1), runs.start, "right") - 1
    runs = Runs(runs.start - 1 - of, runs.length, runs.period)  # places among all words
    kept = ~repeated_places(runs, n)
    kept_ends = np.concatenate([[0], np.cumsum(kept)])[ends]
    collapsed = pc.binary_join(
        pa.LargeListArray.from_arrays(pa.array(kept_ends, pa.int64()), words.filter(pa.array(kept))), " "
    )
    structs = pa.StructArray.from_arrays(
        [pa.array(x) for x in (runs.start - ends[of], runs.length, runs.period)], fields=list(RUN)
    )
    lists = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(of, np.arange(rows + 1)), pa.int32()), structs
    )
    return pa.array(np.diff(ends)), lists, collapsed.cast(pa.string())


def find(
    documents: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed.

    Words are numbered from 0. ``collapsed`` holds the words that no run has behind its first
    period, joined by a space.
    """
    rows = documents.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            # at most one word to two bytes
            sizes = pc.binary_length(text).to_numpy(zero_copy_only=False) // 4 + 1
            for low, high in _units(sizes):
                found = _scan(text.slice(low, high - low), least, times)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), *found],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
        "collapsed string",
    )

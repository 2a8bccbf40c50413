"""Deterministic train/validation/test split with balanced labels in the holdouts.

For every stratum a fixed family of candidate holdouts is compared: the first k rows in seeded
order, and round-robin draws through label buckets (joint, first label, second label) with 32
rotations each. A round-robin draw through buckets takes, from each bucket, one circular run of
the bucket's rows. The run's length follows from the bucket sizes alone.

So all candidates are described by where their runs begin and end. A bucket's circle is cut at
these places (and the seeded order at k); rows between cuts are in the same candidates. The ranks
of a row in its label pair, labels and stratum rise together, so a label pair has no more segments
than cuts, about 200 whatever its size. Rows are counted once per segment, one record a row, and
everything else about a candidate is a sum over segments: its label counts, whether it equals
another, and the first row in which candidates differ.

The driver sees segments, at most 97 candidates per stratum, and for strata with at most 128
possible subsets their few rows. Its work does not grow with the rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaykit import fixed_values as fv
from assaykit.functions.text import order_key
from assaykit.operators.allocation import split_counts
from assaykit.operators.ranking import rank_by_digest, rank_levels
from assaykit.session import durable

_SPEC = {
    "stratum": pa.string(),
    "p": pa.int32(),
    "s": pa.int32(),
    "candidate": pa.int32(),
    "mode": pa.string(),
    "start": pa.int64(),
    "size": pa.int64(),
    "quota": pa.int64(),
}
_ROWS = ("id", "stratum", "p", "s")
#: The rank that decides membership, by the mode of a candidate.
_RANKS = {"first": "idx", "joint": "i_joint", "priority": "i_priority", "sentiment": "i_sentiment"}


@dataclass(frozen=True)
class Balance:
    """The label columns to balance and their label lists, in scoring order."""

    first: str = "priority"
    first_labels: tuple[str, ...] = fv.PRIORITIES
    second: str = "sentiment"
    second_labels: tuple[str, ...] = fv.SENTIMENTS
    strata_labels: tuple[str, ...] = fv.CATEGORIES


@dataclass
class _Candidate:
    stratum: str
    number: int
    spec: list[tuple]
    first: list[int] = field(default_factory=list)
    second: list[int] = field(default_factory=list)
    members: tuple[int, ...] | None = None
    held: np.ndarray | None = None
    tie: tuple = ()


@dataclass
class _Segments:
    """The segments of a stratum: rows that are in the same round-robin candidates."""

    place: dict[tuple, int]
    n: np.ndarray
    p: np.ndarray
    s: np.ndarray
    ranks: dict[str, np.ndarray]  # of the first row of each segment, by mode

    def holds(self, spec: list[tuple]) -> np.ndarray:
        """Which segments a candidate takes."""
        start, size, quota = np.zeros((3, self.p.max() + 1, self.s.max() + 1), dtype=np.int64)
        for _, p, s, _, _, first, length, many in spec:
            start[p, s], size[p, s], quota[p, s] = first, length, many
        mode, at = spec[0][4], (self.p, self.s)
        if mode == "first":
            return self.ranks[mode] < quota[at]
        return (self.ranks[mode] - start[at]) % size[at] < quota[at]


def stratified_split(
    df: DataFrame,
    record_id: str,
    stratum: str,
    balance: Balance | None = None,
    seed: int = 42,
    fractions: dict[str, float] | None = None,
    modes: Sequence[str] = fv.MODES,
    variants: int = fv.VARIANTS_PER_MODE,
    prefix_hex: int = 3,
) -> DataFrame:
    """Return (id, split, position). ``modes`` and ``variants`` may be reduced to save passes."""
    balance = balance or Balance()
    rows = durable(
        df.select(
            F.col(record_id).cast("string").alias("id"),
            F.col(stratum).cast("string").alias("stratum"),
            _label_index(F.col(balance.first), balance.first_labels).alias("p"),
            _label_index(F.col(balance.second), balance.second_labels).alias("s"),
        )
    )
    wanted = {r["stratum"]: r.asDict() for r in split_counts(rows, "stratum", fractions).collect()}
    source = _label_counts(rows)
    if any(None in cell for cell in source):
        raise ValueError("every row needs a stratum and labels from the given label lists")
    parts, remaining = [], rows
    for split in ("validation", "test"):
        search = _HoldoutSearch(remaining, split, seed, balance, modes, variants, prefix_hex)
        required = {name: counts[split] for name, counts in wanted.items()}
        marked = search.mark(required, source)
        parts.append(marked.where("held").select(*_ROWS, F.lit(split).alias("split")))
        remaining = marked.where("NOT held").select(*_ROWS)
    parts.append(remaining.select(*_ROWS, F.lit("train").alias("split")))
    labelled = parts[0].unionByName(parts[1]).unionByName(parts[2])
    keyed = labelled.withColumn(
        "__key", order_key(seed, F.concat(F.lit("split:"), F.col("split")), F.col("id"))
    )
    return rank_by_digest(keyed, ["split"], "__key", prefix_hex=prefix_hex).select(
        "id", "split", "position"
    )


def simple_split(
    df: DataFrame,
    record_id: str,
    stratum: str,
    seed: int = 42,
    fractions: dict[str, float] | None = None,
    prefix_hex: int = 3,
) -> DataFrame:
    """Split by seeded order inside each stratum, without label balancing."""
    keyed = df.select(
        F.col(record_id).alias("id"),
        F.col(stratum).alias("stratum"),
        order_key(seed, F.col(stratum), F.col(record_id)).alias("__key"),
    )
    ranked = rank_by_digest(keyed, ["stratum"], "__key", "__rank", prefix_hex)
    sizes = split_counts(keyed, "stratum", fractions)
    split = (
        F.when(F.col("__rank") < F.col("validation"), "validation")
        .when(F.col("__rank") < F.col("validation") + F.col("test"), "test")
        .otherwise("train")
    )
    placed = ranked.join(sizes, "stratum").select("id", "stratum", split.alias("split"))
    shuffled = placed.withColumn(
        "__key", order_key(seed, F.concat(F.lit("split:"), F.col("split")), F.col("id"))
    )
    return rank_by_digest(shuffled, ["split"], "__key", prefix_hex=prefix_hex).drop("__key")


def candidate_label_counts(
    df: DataFrame,
    record_id: str,
    stratum: str,
    split: str = "validation",
    balance: Balance | None = None,
    seed: int = 42,
    fractions: dict[str, float] | None = None,
    modes: Sequence[str] = fv.MODES,
    variants: int = fv.VARIANTS_PER_MODE,
) -> DataFrame:
    """Label counts of every round-robin candidate of the large strata."""
    balance = balance or Balance()
    rows = df.select(
        F.col(record_id).cast("string").alias("id"),
        F.col(stratum).cast("string").alias("stratum"),
        _label_index(F.col(balance.first), balance.first_labels).alias("p"),
        _label_index(F.col(balance.second), balance.second_labels).alias("s"),
    )
    wanted = {r["stratum"]: r[split] for r in split_counts(rows, "stratum", fractions).collect()}
    search = _HoldoutSearch(rows, split, seed, balance, modes, variants, 3)
    search.build(wanted)
    counted = [
        (c.stratum, c.number, p, s, n)
        for found in search.candidates.values() for c in found if c.spec
        for (p, s), n in search.cells_of(c).items()
    ]
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
    names = ("stratum", "candidate", "p", "s", "rows")
    return search.table(counted, dict(zip(names, kinds, strict=True)))


def _label_index(label: Column, labels: Sequence[str]) -> Column:
    known = F.array(*[F.lit(value) for value in labels])
    place = F.array_position(known, label.cast("string"))
    return F.when(place > 0, place - 1).cast("int")


def _label_counts(rows: DataFrame) -> dict[tuple[str, int, int], int]:
    grouped = rows.groupBy("stratum", "p", "s").agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["stratum"], r["p"], r["s"]): r["n"] for r in grouped}


def _few_subsets(n: int, k: int) -> bool:
    """C(n, k) <= limit, without computing a huge number."""
    ways = 1
    for i in range(1, min(k, n - k) + 1):
        ways = ways * (n - i + 1) // i
        if ways > fv.SUBSET_LIMIT:
            return False
    return True


def _digest(seed: int, scope: str, value: str) -> bytes:
    return hashlib.sha256(f"{seed}:{scope}:{value}".encode()).digest()


def _run_lengths(sizes: dict[tuple, int], wanted: int) -> tuple[int, int]:
    """Full rounds a round-robin draw of ``wanted`` rows makes, and rows left for the next round."""
    rounds, taken, alive = 0, 0, len(sizes)
    for size, same in sorted(Counter(sizes.values()).items()):
        step = min(size - rounds, (wanted - taken) // alive)
        rounds, taken = rounds + step, taken + step * alive
        if rounds < size:
            break
        alive -= same
        if not alive:
            break
    return rounds, wanted - taken


class _HoldoutSearch:
    def __init__(self, rows, split, seed, balance, modes, variants, prefix_hex) -> None:
        self.split, self.seed, self.balance = split, seed, balance
        self.modes, self.variants = modes, variants
        scope = F.concat(F.lit(f"{split}:"), F.col("stratum"))
        keyed = rows.withColumn("__key", order_key(seed, scope, F.col("id")))
        levels = {
            "idx": ("stratum",),
            "i_joint": ("stratum", "p", "s"),
            "i_priority": ("stratum", "p"),
            "i_sentiment": ("stratum", "s"),
        }
        self.rows = durable(rank_levels(keyed, levels, "__key", prefix_hex).drop("__key"))
        self.spark = rows.sparkSession
        self.cells = _label_counts(self.rows)
        self.candidates: dict[str, list[_Candidate]] = {}
        self.segments: dict[str, _Segments] = {}
        self.ordered = False

    # Candidates -------------------------------------------------------------------------

    def build(self, required: dict[str, int]) -> None:
        available = Counter()
        for (stratum, _, _), n in self.cells.items():
            available[stratum] += n
        few = []
        for stratum in sorted(required):
            n, k = available[stratum], required[stratum]
            if k > n:
                raise ValueError(f"{self.split} needs {k} rows of {stratum!r}, {n} remain")
            if k in (0, n):
                self.candidates[stratum] = [self._first_rows(stratum, 0, k)]
            elif _few_subsets(n, k):
                few.append(stratum)
            else:
                self.candidates[stratum] = self._round_robin(stratum, k)
        self._enumerate(few, required)
        self._cut()
        for found in self.candidates.values():
            for candidate in found:
                if candidate.members is None:
                    candidate.first, candidate.second = self._vectors(self.cells_of(candidate))

    def _pairs(self, stratum: str) -> list[tuple[int, int]]:
        return [(p, s) for (name, p, s) in self.cells if name == stratum]

    def _first_rows(self, stratum: str, number: int, k: int) -> _Candidate:
        spec = [(stratum, p, s, number, "first", 0, 1, k) for p, s in self._pairs(stratum)]
        return _Candidate(stratum, number, spec)

    def _round_robin(self, stratum: str, k: int) -> list[_Candidate]:
        found = [self._first_rows(stratum, 0, k)]
        pairs = self._pairs(stratum)
        for mode in self.modes:
            bucket_of = {
                "joint": lambda p, s: (p, s),
                "priority": lambda p, s: (p,),
                "sentiment": lambda p, s: (s,),
            }[mode]
            sizes: Counter = Counter()
            for p, s in pairs:
                sizes[bucket_of(p, s)] += self.cells[stratum, p, s]
            rounds, rest = _run_lengths(sizes, k)
            longer = [bucket for bucket, size in sizes.items() if size > rounds]
            for variant in range(self.variants):
                scope = f"{self.split}:{stratum}:bounded:{mode}:{variant}"
                drawn = sorted(
                    longer, key=lambda b: _digest(self.seed, scope, ":".join(map(str, b)))
                )[:rest]
                number, spec = len(found), []
                for p, s in pairs:
                    bucket = bucket_of(p, s)
                    size = sizes[bucket]
                    quota = min(size, rounds) + (bucket in drawn)
                    spec.append((stratum, p, s, number, mode, variant % size, size, quota))
                found.append(_Candidate(stratum, number, spec))
        return found

    def _enumerate(self, strata: list[str], required: dict[str, int]) -> None:
        """All subsets of strata that have at most 128 of them (so at most 128 + 1 rows)."""
        if not strata:
            return
        by_stratum = defaultdict(list)
        for row in self.rows.where(F.col("stratum").isin(strata)).collect():
            by_stratum[row["stratum"]].append(row)
        for stratum, rows in by_stratum.items():
            rows.sort(key=lambda row: row["idx"])
            self.candidates[stratum] = []
            for number, chosen in enumerate(combinations(rows, required[stratum])):
                scope = f"{self.split}:{stratum}:choice"
                candidate = _Candidate(stratum, number, [])
                candidate.members = tuple(row["idx"] for row in chosen)
                candidate.tie = tuple(
                    _digest(self.seed, f"{scope}:{slot}", row["id"])
                    for slot, row in enumerate(chosen)
                )
                candidate.first, candidate.second = self._vectors(
                    Counter((row["p"], row["s"]) for row in chosen)
                )
                self.candidates[stratum].append(candidate)

    def _vectors(self, counts: dict[tuple[int, int], int]) -> tuple[list[int], list[int]]:
        first = [0] * len(self.balance.first_labels)
        second = [0] * len(self.balance.second_labels)
        for (p, s), n in counts.items():
            first[p] += n
            second[s] += n
        return first, second

    # Segments ---------------------------------------------------------------------------

    def _cut(self) -> None:
        """Cut the strata that have several round-robin candidates, and count their segments."""
        cuts = []
        for stratum, found in self.candidates.items():
            if len(found) < 2 or found[0].members is not None:
                continue
            ends: dict[tuple, set[int]] = defaultdict(set)
            for candidate in found[1:]:
                for _, p, s, _, mode, start, size, quota in candidate.spec:
                    ends[mode, p, s] |= {start, (start + quota) % size}
            k = found[0].spec[0][7]
            for p, s in self._pairs(stratum):
                each = [sorted(ends[mode, p, s]) for mode in fv.MODES]
                cuts.append((stratum, p, s, [k], *each))
        names = [f"cut_{mode}" for mode in ("first", *fv.MODES)]
        types = {"stratum": pa.string(), "p": pa.int32(), "s": pa.int32()}
        if not cuts:
            return
        table = self.table(cuts, types | dict.fromkeys(names, pa.list_(pa.int64())))
        parts = [_passed(name, rank) for name, rank in zip(names, _RANKS.values(), strict=True)]
        joined = self.rows.join(table, ["stratum", "p", "s"])
        self.cut_rows = joined.select(*_ROWS, *_RANKS.values(), F.struct(*parts).alias("segment"))
        ranks = F.min(F.struct(*_RANKS.values())).alias("ranks")
        grouped = self.cut_rows.groupBy("stratum", "p", "s", "segment").agg(
            F.count(F.lit(1)).alias("n"), ranks
        )
        by_stratum = defaultdict(list)
        for row in grouped.collect():
            by_stratum[row["stratum"]].append(row)
        for stratum, rows in by_stratum.items():
            self.segments[stratum] = _Segments(
                {(r["p"], r["s"], *r["segment"]): i for i, r in enumerate(rows)},
                *(np.array([r[name] for r in rows], dtype=np.int64) for name in ("n", "p", "s")),
                {
                    mode: np.array([r["ranks"][rank] for r in rows], dtype=np.int64)
                    for mode, rank in _RANKS.items()
                },
            )
            for candidate in self.candidates[stratum]:
                candidate.held = self.segments[stratum].holds(candidate.spec)

    def cells_of(self, candidate: _Candidate) -> dict[tuple[int, int], int]:
        """Rows of a candidate per label pair."""
        if candidate.held is None:  # all rows of the stratum or none
            return {
                (p, s): self.cells[candidate.stratum, p, s]
                for _, p, s, _, _, _, _, quota in candidate.spec if quota
            }
        segments, counts = self.segments[candidate.stratum], Counter()
        for i in np.flatnonzero(candidate.held):
            counts[int(segments.p[i]), int(segments.s[i])] += int(segments.n[i])
        return dict(counts)

    def table(self, rows: list[tuple], types: dict[str, pa.DataType]) -> DataFrame:
        columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
        arrays = [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
        return self.spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(types)))

    # Ties -------------------------------------------------------------------------------

    def order_ties(self, sets: list[list[_Candidate]]) -> None:
        """Give round-robin candidates of each set comparable ``tie`` keys.

        Ties are decided by comparing, slot by slot, seeded digests of the chosen rows. Two
        candidates agree on all slots before the first row that only one of them holds. So each
        round finds that row per group of undecided candidates, from the segments, takes the row
        every candidate has in that slot, and splits the group by their digests. Rows are only
        scanned.
        """
        self.ordered = True
        groups = [found for found in sets if len(found) > 1]
        for found in sets:
            for candidate in found:
                candidate.tie = ()
        while groups:
            starts = [self._first_difference(group) for group in groups]
            undecided = [(g, at) for g, at in zip(groups, starts, strict=True) if at is not None]
            if not undecided:
                return
            slots = self._slot_rows(undecided)
            groups = []
            for group, _ in undecided:
                parts = defaultdict(list)
                for candidate in group:
                    slot, row_id = slots[candidate.stratum, candidate.number]
                    scope = f"{self.split}:{candidate.stratum}:choice:{slot}"
                    digest = _digest(self.seed, scope, row_id)
                    candidate.tie += ((slot, digest),)
                    parts[digest].append(candidate)
                groups += [part for part in parts.values() if len(part) > 1]

    def _first_difference(self, group: list[_Candidate]) -> int | None:
        """The first row, in seeded order, that some candidates of a group have and some lack."""
        held = np.stack([c.held for c in group])
        differs = held.any(axis=0) & ~held.all(axis=0)
        first = self.segments[group[0].stratum].ranks["first"][differs]
        return int(first.min()) if len(first) else None

    def _slot_rows(self, undecided) -> dict[tuple[str, int], tuple[int, str]]:
        """Per candidate the number of its rows before its group's place, and its next row."""
        places = defaultdict(set)
        for group, at in undecided:
            places[group[0].stratum].add(at)
        places = {stratum: sorted(found) for stratum, found in places.items()}
        table = self.table(
            list(places.items()), {"stratum": pa.string(), "places": pa.list_(pa.int64())}
        )
        before = F.size(F.filter("places", lambda at: at <= F.col("idx")))
        counted = (
            self.cut_rows.join(table, "stratum")
            .groupBy("stratum", "p", "s", "segment", before.alias("before"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("idx", "id")).alias("row"))
        )
        by_stratum = defaultdict(list)
        for r in counted.collect():
            segment = self.segments[r["stratum"]].place[r["p"], r["s"], *r["segment"]]
            by_stratum[r["stratum"]].append((segment, r["before"], r["n"], r["row"]))
        slots = {}
        for group, at in undecided:
            stratum = group[0].stratum
            found, passed = by_stratum[stratum], bisect_left(places[stratum], at)
            for c in group:
                mine = [x for x in found if c.held[x[0]]]
                slot = sum(n for _, before, n, _ in mine if before <= passed)
                _, row_id = min(tuple(row) for _, before, _, row in mine if before > passed)
                slots[stratum, c.number] = (slot, row_id)
        return slots

    # Choice -----------------------------------------------------------------------------

    def mark(self, required: dict[str, int], source: dict[tuple[str, int, int], int]) -> DataFrame:
        """Rows with a Boolean ``held``."""
        self.build(required)
        self._merge_equal()
        large = bool(self.segments)
        chosen = None
        if large and len(self.candidates) > 1:
            chosen = self._greedy()
            if not self._covers(chosen, source):
                chosen = None
        if chosen is None:
            chosen = self._frontier()
        return self._held(chosen)

    def _merge_equal(self) -> None:
        """Of candidates with the same rows only the first is kept."""
        for stratum, found in self.candidates.items():
            if found[0].held is not None:
                kept: dict[bytes, _Candidate] = {}
                for candidate in found:
                    kept.setdefault(candidate.held.tobytes(), candidate)
                self.candidates[stratum] = list(kept.values())

    def _score(self, first: Sequence[int], second: Sequence[int]) -> tuple[int, ...]:
        return (
            list(second).count(0),
            list(first).count(0),
            max(first) - min(first),
            sum(n * n for n in first),
            max(second) - min(second),
        )

    def _greedy(self) -> list[_Candidate]:
        """Best candidate stratum by stratum, given what was chosen before.

        All strata have their ties ordered together, which takes a few scans in total.
        """
        self.order_ties([f for f in self.candidates.values() if f[0].members is None])
        first = [0] * len(self.balance.first_labels)
        second = [0] * len(self.balance.second_labels)
        chosen = []
        for stratum in sorted(self.candidates):
            scored = defaultdict(list)
            for c in self.candidates[stratum]:
                scored[self._score(_add(first, c.first), _add(second, c.second))].append(c)
            pick = min(scored[min(scored)], key=lambda c: c.tie)
            first, second = _add(first, pick.first), _add(second, pick.second)
            chosen.append(pick)
        return chosen

    def _frontier(self) -> list[_Candidate]:
        """Best path over all strata, keeping the best state per label count."""
        strata = sorted(self.candidates)
        if len(strata) == 1:
            self._order_best_only(strata[0])
        elif not self.ordered:
            self.order_ties([f for f in self.candidates.values() if f[0].members is None])
        zero = ((0,) * len(self.balance.first_labels), (0,) * len(self.balance.second_labels))
        states: dict[tuple, tuple[tuple, tuple]] = {zero: ((), ())}
        for stratum in strata:
            ties = sorted({c.tie for c in self.candidates[stratum]})
            place = {tie: i for i, tie in enumerate(ties)}
            grown: dict[tuple, tuple[tuple, tuple]] = {}
            for (first, second), (ranks, path) in states.items():
                for c in self.candidates[stratum]:
                    key = (tuple(_add(first, c.first)), tuple(_add(second, c.second)))
                    entry = ((*ranks, place[c.tie]), (*path, c))
                    if key not in grown or entry[0] < grown[key][0]:
                        grown[key] = entry
            if len(grown) > fv.STATE_LIMIT:
                ranked = sorted(grown, key=lambda key: (self._score(*key), grown[key][0]))
                grown = {key: grown[key] for key in ranked[: fv.STATE_LIMIT]}
            states = grown
        best = min(states, key=lambda key: (self._score(*key), states[key][0]))
        return list(states[best][1])

    def _order_best_only(self, stratum: str) -> None:
        """With one stratum only the best-scored candidates can win, so only they are ordered."""
        found = self.candidates[stratum]
        best = min(self._score(c.first, c.second) for c in found)
        tied = [c for c in found if self._score(c.first, c.second) == best]
        if found[0].members is None:
            self.order_ties([tied])

    def _covers(self, chosen: list[_Candidate], source: dict[tuple[str, int, int], int]) -> bool:
        """The holdout keeps every label that the source can supply, with even first labels."""
        total = sum(sum(c.first) for c in chosen)
        held = {
            "stratum": Counter({c.stratum: sum(c.first) for c in chosen}),
            "p": Counter(dict(enumerate(_sum_all(c.first for c in chosen)))),
            "s": Counter(dict(enumerate(_sum_all(c.second for c in chosen)))),
        }
        labels = {
            "stratum": set(self.balance.strata_labels),
            "p": set(range(len(self.balance.first_labels))),
            "s": set(range(len(self.balance.second_labels))),
        }
        for at, name in enumerate(("stratum", "p", "s")):
            supply: Counter = Counter()
            for key, n in source.items():
                supply[key[at]] += n
            wanted = labels[name]
            if set(supply) != wanted or min(supply.values()) < 2 or total < len(wanted):
                continue
            observed = [held[name][label] for label in wanted]
            if 0 in observed or (name == "p" and max(observed) - min(observed) > 1):
                return False
        return True

    def _held(self, chosen: list[_Candidate]) -> DataFrame:
        spec = [row for c in chosen for row in c.spec]
        picks = [(c.stratum, i) for c in chosen if c.members is not None for i in c.members]
        table = self.table(spec, _SPEC)
        small = self.table(picks, {"stratum": pa.string(), "idx": pa.int64()})
        return (
            self.rows.join(table, ["stratum", "p", "s"], "left")
            .join(small.withColumn("picked", F.lit(True)), ["stratum", "idx"], "left")
            .withColumn(
                "held",
                F.coalesce(_is_member(), F.lit(False)) | F.coalesce("picked", F.lit(False)),
            )
            .select(*_ROWS, "held")
        )


def _passed(cuts: str, rank: str) -> Column:
    """How many cuts lie at or before a rank."""
    return F.size(F.filter(cuts, lambda cut: cut <= F.col(rank))).alias(cuts)


def _is_member() -> Column:
    index = F.coalesce(*[F.when(F.col("mode") == m, F.col(rank)) for m, rank in _RANKS.items()])
    in_run = F.pmod(index - F.col("start"), F.col("size")) < F.col("quota")
    return F.when(F.col("mode") == "first", F.col("idx") < F.col("quota")).otherwise(in_run)


def _add(left: Sequence[int], right: Sequence[int]) -> list[int]:
    return [a + b for a, b in zip(left, right, strict=True)]


def _sum_all(vectors) -> list[int]:
    return [sum(column) for column in zip(*vectors, strict=True)]

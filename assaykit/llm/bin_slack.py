"""Packing into few sequences by minimum bin slack.

A bin is one sequence. It takes the longest piece left and, of all combinations of the other pieces
that fit beside it, the fullest, which a subset-sum dynamic program over bitsets finds; the
combination is removed and the next bin begins. Among equally full ones that with longer pieces is
taken. Because a combination stays the fullest while its pieces last, it is repeated as often as
they do, so the plan depends on the number of pieces per length alone. There are at most ``window``
lengths, and each step leaves fewer pieces of some length than a bin of this kind takes, at most
window/length: so fewer than window * (1 + ln(window)) + window steps, whatever the table's size.
The same plan without the longest piece first is made too, and that with fewer sequences is used.

In Spark, documents are tokenised once into a written table that numbers the pieces of a length
within each task. The counts per task and length give every piece its number among all of its
length, and its place in the plan follows from that number. Token ids are not shuffled, unless the
counts exceed ``COUNTS_MB`` (far beyond ten thousand tasks) and have to be joined by a shuffle.

Defined results: a null or empty text is the end id alone; repeated rows are documents of their
own; null ids stay null; an empty table gives an empty table. Only the named columns are read. A
long text is cut into pieces of ``window`` ids, and only its first piece may be shorter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assaykit.llm.packing import Tokens
from assaykit.llm.tables import written
from assaykit.session import durable

#: Counts of tasks and lengths up to this size are sent to all executors.
COUNTS_MB = 128
#: Ids that a task hands over at once.
OUT_BYTES = 4 << 20


def cut(size: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; all but the first have ``window`` ids."""
    first = size % window or min(size, window)
    return [(0, first), *((at, window) for at in range(first, size, window))]


class Plan(NamedTuple):
    """Steps of equal bins: for each, what it takes as (length, how many), and how many bins."""

    takes: list[list[tuple[int, int]]]
    bins: list[int]

    def sequences(self) -> int:
        return sum(self.bins)


def fullest(available: list[tuple[int, int]], room: int) -> list[tuple[int, int]]:
    """The fullest combination of (length, count) pieces, by ascending length, within a room."""
    every = (1 << room + 1) - 1
    reach, before = 1, []
    for length, count in available:
        before.append(reach)
        count, part = min(count, room // length), 1
        while count:
            part = min(part, count)
            reach |= reach << part * length & every
            count, part = count - part, part * 2
    left, taken = reach.bit_length() - 1, []
    for (length, count), earlier in zip(reversed(available), reversed(before), strict=True):
        most = min(count, left // length)
        used = next(k for k in range(most, -1, -1) if earlier >> left - k * length & 1)
        if used:
            taken.append((length, used))
            left -= used * length
    return taken


def plan(counts: dict[int, int], window: int, longest_first: bool = True) -> Plan:
    """Bins for ``counts`` pieces of each length, none longer than the window."""
    left, steps = {k: n for k, n in sorted(counts.items()) if n}, Plan([], [])
    while left:
        taken: Counter[int] = Counter()
        room, rest = window, left
        if longest_first:
            top = max(left)
            taken[top], room = 1, window - top
            rest = left | {top: left[top] - 1}
        for length, used in fullest([(k, n) for k, n in rest.items() if n and k <= room], room):
            taken[length] += used
        times = min(left[length] // used for length, used in taken.items())
        steps.takes.append(sorted(taken.items(), reverse=True))
        steps.bins.append(times)
        left = {k: m for k, n in left.items() if (m := n - times * taken[k])}
    return steps


def best_plan(counts: dict[int, int], window: int) -> Plan:
    return min((plan(counts, window, first) for first in (True, False)), key=Plan.sequences)


class Places:
    """Sequence and offset of a piece from its length and its number among that length."""

    def __init__(self, steps: Plan, window: int):
        each: list[list[tuple[int, int, int, int]]] = [[] for _ in range(window + 1)]
        given, sequence = [0] * (window + 1), 0
        for takes, bins in zip(steps.takes, steps.bins, strict=True):
            offset = 0
            for length, used in takes:
                each[length].append((given[length], used, sequence, offset))
                given[length] += used * bins
                offset += used * length
            sequence += bins
        self.each = [np.array(x, dtype=np.int64).reshape(-1, 4) for x in each]

    def __call__(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty((2, len(length)), dtype=np.int64)
        for size in np.unique(length):
            mine = length == size
            table, wanted = self.each[size], number[mine]
            step = table[np.searchsorted(table[:, 0], wanted, "right") - 1]
            bin_, place = np.divmod(wanted - step[:, 0], step[:, 1])
            sequence[mine] = step[:, 2] + bin_
            offset[mine] = step[:, 3] + place * size
        return sequence, offset


def pieces(
    documents: DataFrame, vocabulary: str, window: int, end: int, id_col: str, text_col: str
) -> DataFrame:
    """doc_id, piece, start, length, ids, and the piece's number in its task and length."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())

    def made(keys: pa.Array, owner: list[int], found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays(
            [
                keys.take(pa.array(owner, pa.int64())),
                *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
            ],
            ["doc_id", "piece", "start", "length", "ids", "task", "seen"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task = Tokens(vocabulary), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        for batch in batches:
            owner, found, size = [], [], 0
            for row, text in enumerate(batch.column("text")):
                ids = np.append(tokens.ids(text.as_py()), np.uint32(end)).astype("<u4")
                for piece, (start, length) in enumerate(cut(len(ids), window)):
                    owner.append(row)
                    data = ids[start : start + length].tobytes()
                    found.append((piece, start, length, data, task, seen[length]))
                    seen[length] += 1
                size += ids.nbytes
                if size > OUT_BYTES:
                    yield made(batch.column("doc_id"), owner, found)
                    owner, found, size = [], [], 0
            yield made(batch.column("doc_id"), owner, found)

    return rows.mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids binary, task int, seen long"
    )


def pack(
    documents: DataFrame, vocabulary: str, window: int = 1024, end: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids, sequence_id, offset.

    ``ids`` are token ids as little-endian 32-bit numbers. ``vocabulary`` is the path of a
    tokenizers file that every executor has.
    """
    rows = written(pieces(documents, vocabulary, window, end, id_col, text_col), "pieces")
    counts = durable(rows.groupBy("task", "length").agg(F.count("*").alias("n")))
    # at most one row per length
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(best_plan(total, window), window)

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    per_task = before.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias("earlier"))
    if counts.count() * 24 <= COUNTS_MB << 20:
        per_task = F.broadcast(per_task)
    number = F.col("seen") + F.col("earlier")[F.col("length")]
    rows = rows.join(per_task, "task").withColumn("number", number)

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    at = placed("length", "number")
    rows = rows.withColumn("at", at)
    return rows.select("doc_id", "piece", "start", "length", "ids", "at.sequence_id", "at.offset")


def fewest(counts: dict[int, int], window: int) -> int:
    """A number of sequences that no packing can be below."""
    large = sum(n for length, n in counts.items() if 2 * length > window)
    return max(large, math.ceil(sum(length * n for length, n in counts.items()) / window))

"""Lexical retrieval packing into sequences of a fixed number of tokens.

Documents are tokenised and collected into shards of bounded size. A shard has an inverted index
with BM25 weights over token ids. The document that opens a sequence is its seed; its unused
neighbours by BM25, all of them if need be, fill the sequence one after another, the best first. A document is cut where the sequence is
full, and its rest opens the next one. When a seed has no neighbours left, the next unused document
follows. The tokens left at a shard's end go into sequences whose sizes are powers of two, which
need no padding.

A shard is made of the rows of one partition in their order, so nothing is shuffled and each id
lies in exactly one piece. Memory is bounded by a shard and the longest document.

Defined results: a null or empty text is the end-of-text id alone; repeated rows are packed as
documents of their own; null ids stay null; an empty table gives an empty table. Only the named
columns are read.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END = 0
#: Fixed value: the word pattern of byte-level vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: A run of white space from this length on is left to the library: the faster encoder's pattern
#: looks back over it and gives up at a million characters.
LONG_RUN = 10_000
_LONG_SPACE = re.compile(rf"\s{{{LONG_RUN}}}")


class Tokens:
    """Token ids of a text under a byte-level vocabulary file of the tokenizers library.

    The file's vocabulary is handed to a faster encoder of the same kind. Which of the two encodes a
    text depends on that text alone: the library takes texts that hold one of the file's marks (such
    as its end-of-text mark, which has an id of its own), texts with a very long run of white space,
    and texts that the faster encoder refuses.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self.marks = [token["content"] for token in stored["added_tokens"]]
        self.fast = self._faster(stored)

    @staticmethod
    def _faster(stored: dict):
        import tiktoken

        special = {token["content"] for token in stored["added_tokens"]}
        byte_of = _bytes_by_sign()
        ranks = {
            bytes(byte_of[sign] for sign in token): rank
            for token, rank in stored["model"]["vocab"].items()
            if token not in special
        }
        return tiktoken.Encoding("stored", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str | None) -> np.ndarray:
        """The ids alone; none for a null or empty text."""
        text = text or ""
        if any(mark in text for mark in self.marks):
            return self._slow(text)
        if len(text) >= LONG_RUN and _LONG_SPACE.search(text):
            return self._slow(text)
        try:
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        except BaseException as error:  # a panic of the encoder is no Exception
            if type(error).__name__ != "PanicException" and not isinstance(error, Exception):
                raise
            return self._slow(text)

    def __call__(self, text: str | None) -> np.ndarray:
        """The ids with the end-of-text id behind them."""
        return np.append(self.ids(text), np.array([END], dtype="<u4"))

    def _slow(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _bytes_by_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as they are, others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


#: Terms in more than this share of a shard's documents are rows of a matrix instead of postings.
DENSE = 0.1


class Index:
    """Weights of a shard: for every term that two documents share, documents and BM25 weights."""

    def __init__(
        self, documents: list[np.ndarray], k1: float = 1.2, b: float = 0.75,
        most_common: float = 1.0, query_terms: int | None = None,
    ):
        n = len(documents)
        counted = [np.unique(d, return_counts=True) for d in documents]
        sizes = np.array([len(t) for t, _ in counted], dtype=np.int64)
        term = np.concatenate([t for t, _ in counted]).astype(np.int64)
        count = np.concatenate([c for _, c in counted]).astype(np.float64)
        owner = np.repeat(np.arange(n), sizes)
        frequency = np.bincount(term)
        # terms of one document retrieve nothing
        useful = (frequency[term] > 1) & (frequency[term] <= max(2, most_common * n))
        term, count, owner = term[useful], count[useful], owner[useful]
        lengths = np.array([len(d) for d in documents], dtype=np.float64)
        norm = k1 * (1 - b + b * lengths / lengths.mean())
        rarity = np.log(1 + (n - frequency[term] + 0.5) / (frequency[term] + 0.5))
        weight = rarity * count * (k1 + 1) / (count + norm[owner])
        dense = frequency > DENSE * n
        row_of = np.cumsum(dense) - 1
        self.dense_row = np.where(dense, row_of, -1)
        self.common = np.zeros((int(dense.sum()), n), dtype=np.float32)
        often = dense[term]
        self.common[row_of[term[often]], owner[often]] = weight[often]
        order = np.argsort(term[~often], kind="stable")
        self.owner, self.weight = owner[~often][order], weight[~often][order]
        postings = np.bincount(term[~often], minlength=len(frequency))
        self.first = np.concatenate([[0], np.cumsum(postings)])
        # per document its terms, which are its query
        self.term, self.term_weight = term, weight
        self.own = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
        self.query_terms, self.n = query_terms, n

    def neighbours(self, seed: int, used: np.ndarray, most: int | None = None) -> list[int]:
        """Unused documents with a common query term, the best first; ties by position."""
        own = slice(self.own[seed], self.own[seed + 1])
        terms, weights = self.term[own], self.term_weight[own]
        if self.query_terms is not None and len(terms) > self.query_terms:
            terms = terms[np.argsort(-weights, kind="stable")[: self.query_terms]]
        rows = self.dense_row[terms]
        starts, sizes = self.first[terms], self.first[terms + 1] - self.first[terms]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
        scores = np.bincount(self.owner[places], self.weight[places], minlength=self.n).astype(float)
        scores += self.common[rows[rows >= 0]].sum(axis=0)
        scores[used] = 0.0
        found = np.flatnonzero(scores)
        if most is not None and len(found) > most:
            found = found[np.argpartition(-scores[found], most)[:most]]
        return found[np.lexsort((found, -scores[found]))].tolist()


def pack_shard(documents: list[np.ndarray], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) that cover every id once."""
    index, n = Index(documents), len(documents)
    used = np.zeros(n, dtype=bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    sequence = filled = 0
    queue: Iterator[int] | None = iter(())  # neighbours of the seed, None until they are wanted
    seed = next_free = 0

    def choose() -> int:
        nonlocal queue, next_free
        if queue is None:
            queue = iter(index.neighbours(seed, used))
        for found in queue:
            if not used[found]:
                return found
        while used[next_free]:
            next_free += 1
        return next_free

    for _ in range(n):
        current = choose()
        used[current] = True
        start, size = 0, len(documents[current])
        if filled == 0:
            seed, queue = current, None
        while start < size:
            length = min(window - filled, size - start)
            pieces.append((current, start, length, sequence, filled))
            start, filled = start + length, filled + length
            if filled == window:
                sequence, filled = sequence + 1, 0
                if start < size:
                    seed, queue = current, None
    return _split_last(pieces, sequence, filled) if filled else pieces


def _split_last(pieces, sequence: int, filled: int):
    """Cut the unfinished sequence into sequences of falling powers of two."""
    kept = [p for p in pieces if p[3] != sequence]
    sizes = [1 << k for k in range(filled.bit_length() - 1, -1, -1) if filled >> k & 1]
    room, offset = sizes.pop(0), 0
    for document, start, length, _, _ in pieces[len(kept) :]:
        while length:
            part = min(length, room - offset)
            kept.append((document, start, part, sequence, offset))
            start, length, offset = start + part, length - part, offset + part
            if offset == room and sizes:
                room, offset, sequence = sizes.pop(0), 0, sequence + 1
    return kept


PIECES = (
    "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


def pack(
    documents: DataFrame, vocabulary: str, window: int = 1024, shard_tokens: int = 2_000_000,
    shard_documents: int = 4096, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian 32-bit numbers.

    ``vocabulary`` is the path of a tokenizers file that every executor has.
    """
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens, numbers = Tokens(vocabulary), [TaskContext.get().partitionId() << 36]
        keys, shard, size = [], [], 0

        def emit() -> pd.DataFrame:
            pieces = pack_shard(shard, window)
            frame = pd.DataFrame(
                [
                    (keys[d], start, length, shard[d][start : start + length].tobytes(), len(shard[d]),
                     numbers[0] + sequence, offset)
                    for d, start, length, sequence, offset in pieces
                ],
                columns=["doc_id", *(part.split()[0] for part in PIECES.split(", "))],
            )
            numbers[0] += pieces[-1][3] + 1
            return frame

        for batch in batches:
            for key, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = tokens(text)
                keys.append(key)
                shard.append(ids)
                size += len(ids)
                if size >= shard_tokens or len(shard) >= shard_documents:
                    yield emit()
                    keys, shard, size = [], [], 0
        if shard:
            yield emit()

    return rows.mapInPandas(run, f"doc_id {kind}, {PIECES}")

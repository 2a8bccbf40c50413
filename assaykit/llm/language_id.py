"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text holds all its substrings. A text is parsed
into phrases, each the longest match in the automaton; the language that needs the fewest phrases
per letter, normalised by the size of its training text, wins.

Each automaton has the alphabet of its language, every letter of the training text. Many stretches
of text are parsed at once with array steps: through whole transition tables while these are small
together, else through sorted lists of the transitions that exist. A text is cut into stretches of ``STRETCH`` symbols; all of them
count, and each starts a phrase.

The training text is a bounded sample (``sample_chars`` per language) of the labelled documents in
the order of a hash. Prediction reads nothing but the text.

Defined results: ``und`` and score 0 for a null text, one without a letter, or when nothing could
be learned; ties go to the alphabetically first language; repeated rows are judged one by one; an
empty table gives an empty table. Only the named columns are read.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaykit.session import durable, small_side

STRETCH = 512
#: Bytes of all whole tables together.
MOST_TABLE_BYTES = 256 << 20
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # code point -> symbol; 0 is the gap between words
    alphabets: list[np.ndarray]  # per language: symbol -> symbol of its automaton
    tables: list[np.ndarray | Sparse]  # per language
    phrase_bits: list[float]


@dataclass
class Sparse:
    """Transitions in the order of state * width + symbol, without those that lead nowhere."""

    keys: np.ndarray
    targets: np.ndarray
    states: int
    width: int

    def __len__(self) -> int:
        return self.states

    def step(self, key: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.targets[at], -1)


def sparse_automaton(text: np.ndarray, n_symbols: int) -> Sparse:
    """The smallest automaton that reads exactly the substrings of ``text``, and a dead last state."""
    steps: list[dict[int, int]] = [{}]
    link, longest, last = [-1], [0], 0
    for symbol in text.tolist():
        new = len(steps)
        steps.append({})
        longest.append(longest[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at >= 0:
            old = steps[at][symbol]
            if longest[old] == longest[at] + 1:
                link[new] = old
            else:
                copy = len(steps)
                steps.append(dict(steps[old]))
                longest.append(longest[at] + 1)
                link.append(link[old])
                while at >= 0 and steps[at].get(symbol) == old:
                    steps[at][symbol] = copy
                    at = link[at]
                link[old] = link[new] = copy
        last = new
    ordered = [sorted(each.items()) for each in steps]
    sizes = np.array([len(each) for each in ordered], dtype=np.int64)
    pairs = np.array([pair for each in ordered for pair in each], dtype=np.int64).reshape(-1, 2)
    keys = np.repeat(np.arange(len(steps)), sizes) * n_symbols + pairs[:, 0]
    return Sparse(keys, pairs[:, 1].astype(np.int32), len(steps) + 1, n_symbols)


def whole_table(sparse: Sparse) -> np.ndarray:
    table = np.full((sparse.states, sparse.width), -1, dtype=np.int32)
    table.ravel()[sparse.keys] = sparse.targets
    return table


def suffix_automaton(text: np.ndarray, n_symbols: int) -> np.ndarray:
    """Transitions of the smallest automaton that reads exactly the substrings of ``text``.

    A last row without transitions stands behind it, for a symbol that no phrase can hold.
    """
    return whole_table(sparse_automaton(text, n_symbols))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def normalised(text: str, symbols: np.ndarray) -> np.ndarray:
    """Symbols of the lower-cased text; what is no letter becomes one gap between words."""
    each = symbols[code_points(text.lower())]
    keep = np.ones(len(each), dtype=bool)
    keep[1:] = (each[1:] != 0) | (each[:-1] != 0)
    return each[keep]


def fit(texts: dict[str, list[str]], sample_chars: int, most_bytes: int = MOST_TABLE_BYTES) -> Model:
    """Automata of the first ``sample_chars`` characters per language."""
    joined = {name: " ".join(each)[:sample_chars] for name, each in sorted(texts.items())}
    held = {c for text in joined.values() for c in text.lower() if unicodedata.category(c)[0] == "L"}
    letters = sorted(held)
    # letters that no sample holds share the last symbol, which starts a phrase everywhere
    n_symbols = len(letters) + 2
    symbols = np.zeros(0x110000, dtype=np.uint16 if n_symbols <= 1 << 16 else np.uint32)
    symbols[_LETTERS] = n_symbols - 1
    symbols[[ord(c) for c in letters]] = np.arange(1, n_symbols - 1)
    languages, alphabets, tables, bits = [], [], [], []
    for name, text in joined.items():
        parsed = normalised(text, symbols)
        if not parsed.any():
            continue
        own = np.unique(parsed[parsed != 0])
        alphabet = np.full(n_symbols, len(own) + 1, dtype=symbols.dtype)
        alphabet[0], alphabet[own] = 0, np.arange(1, len(own) + 1)
        languages.append(name)
        alphabets.append(alphabet)
        tables.append(sparse_automaton(alphabet[parsed], len(own) + 2))
        bits.append(float(np.log2(len(parsed) + 1)))
    if sum(4 * table.states * table.width for table in tables) <= most_bytes:
        tables = [whole_table(table) for table in tables]
    return Model(languages, symbols, alphabets, tables, bits)


def _all_letters() -> np.ndarray:
    return np.array([c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"])


_LETTERS = _all_letters()


def phrases(
    stretches: np.ndarray, lengths: np.ndarray, table: np.ndarray | Sparse,
    alphabet: np.ndarray | None = None,
) -> np.ndarray:
    """Phrases per stretch (a row, filled up at the end; longest stretches first)."""
    state = np.zeros(len(stretches), dtype=np.int64)
    count = (lengths > 0).astype(np.int64)
    if isinstance(table, Sparse):
        width, steps = table.width, table.step
    else:
        width, steps = table.shape[1], table.ravel().__getitem__
    alive, nowhere = len(stretches), len(table) - 1
    for at in range(stretches.shape[1]):
        while alive and lengths[alive - 1] <= at:
            alive -= 1
        if not alive:
            break
        symbol = stretches[:alive, at] if alphabet is None else alphabet[stretches[:alive, at]]
        step = steps(state[:alive] * width + symbol)
        ended = step < 0
        if ended.any():
            again = steps(symbol[ended])  # a new phrase starts with this symbol
            count[:alive][ended] += at > 0
            step[ended] = np.where(again < 0, nowhere, again)
        state[:alive] = step
    return count


def costs(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Normalised phrases [text, language] and whether the text has a letter."""
    each = [normalised(text, model.symbols) for text in texts]
    sizes = np.array([len(x) for x in each], dtype=np.int64)
    lettered = np.array([bool(x.any()) for x in each], dtype=bool)
    pieces = -(-sizes // STRETCH)
    owner = np.repeat(np.arange(len(texts)), pieces)
    rows = np.zeros((len(owner), STRETCH), dtype=model.symbols.dtype)
    lengths = np.zeros(len(owner), dtype=np.int64)
    row = 0
    for x, n in zip(each, pieces.tolist(), strict=True):
        padded = np.zeros(n * STRETCH, dtype=model.symbols.dtype)
        padded[: len(x)] = x
        rows[row : row + n] = padded.reshape(n, STRETCH)
        lengths[row : row + n] = STRETCH
        if n:
            lengths[row + n - 1] = len(x) - (n - 1) * STRETCH
        row += n
    order = np.argsort(-lengths, kind="stable")
    rows, lengths, owner = rows[order], lengths[order], owner[order]
    result = np.zeros((len(texts), len(model.languages)))
    for k, (table, alphabet) in enumerate(zip(model.tables, model.alphabets, strict=True)):
        count = np.bincount(owner, phrases(rows, lengths, table, alphabet), minlength=len(texts))
        result[:, k] = count * model.phrase_bits[k] / np.maximum(sizes, 1)
    return result, lettered


def predict(texts: list[str], model: Model) -> list[tuple[str, float]]:
    """(language, score): the score is the winner's share of lead over the runner-up."""
    cost, lettered = costs(texts, model)
    if not model.languages:
        return [(UNKNOWN, 0.0)] * len(texts)
    best = cost.argmin(axis=1)
    ordered = np.sort(cost, axis=1)
    second = ordered[:, 1] if ordered.shape[1] > 1 else np.full(len(texts), np.inf)
    with np.errstate(divide="ignore", invalid="ignore"):
        lead = np.where(second > 0, 1.0 - ordered[:, 0] / second, 0.0)
    return [
        (model.languages[b], float(s)) if ok else (UNKNOWN, 0.0)
        for b, s, ok in zip(best, lead, lettered, strict=True)
    ]


def held_out(key: F.Column, folds: int = 5) -> F.Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds)) == 0


def train(
    documents: DataFrame, sample_chars: int = 60_000, sample_rows: int = 600,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Fit on the documents outside the held-out fold.

    Per language at most ``sample_rows`` texts, of each at most a hundredth of ``sample_chars``, go
    to the driver. A first pass counts the languages' rows; the second keeps the rows whose hash
    lies below a bound that leaves about twice as many as wanted, so no task sends more than a few.
    """
    most = max(200, sample_chars // 100)
    labelled = documents.select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(1 << 40)).alias("place"),
    ).where(
        F.col(lang_col).isNotNull()
        & F.col(text_col).isNotNull()
        & ~F.coalesce(held_out(F.col(id_col)), F.lit(False))
    )
    bounds = labelled.groupBy("lang").count().select(
        "lang",
        (F.lit(float(1 << 40)) * F.least(F.lit(1.0), 2 * sample_rows / F.col("count")))
        .cast("long").alias("bound"),
    )
    chosen = labelled.join(small_side(durable(bounds)), "lang").where("place < bound").select(
        "lang", "place", F.substring("text", 1, most).alias("start")
    )
    texts: dict[str, list[str]] = {}
    for row in sorted(chosen.collect(), key=lambda r: (r["lang"], r["place"], r["start"])):
        texts.setdefault(row["lang"], []).append(row["start"])
    return fit({k: list(dict.fromkeys(t))[:sample_rows] for k, t in texts.items()}, sample_chars)


def identify(
    documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred and score for every document."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = predict([t or "" for t in batch["text"]], sent.value)
            frame = pd.DataFrame(found, columns=["lang_pred", "score"])
            frame.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield frame

    return rows.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")

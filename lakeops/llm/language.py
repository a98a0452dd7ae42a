"""Languages of a text as a mixture, fitted by expectation-maximisation over character n-grams.

Counts of hashed letter trigrams per language are gathered from all labelled texts. A text is
taken as draws from a mixture of those languages: expectation-maximisation gives its proportions, and
of the sets of its leading languages the one with the best penalised likelihood is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.bpe import LETTER, char_kinds
from lakeops.llm.common import as_documents, named
from lakeops.llm.scan import CHUNK_BYTES, U64, chunks, mix

BINS = 1 << 16
SMOOTHING = 0.5
# Log-likelihood a further language must add, times the log of the number of n-grams.
PENALTY = 4.0
ROUNDS = 12
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return char_kinds() == LETTER


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bins of all letter trigrams of all texts and where each text's begin.

    Letters are lower-cased and everything else between them is one gap; a gap surrounds each text.
    """
    joined = "\n" + "".join(f"{t.lower()}\n\n" for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = 1 + np.cumsum([len(t.lower()) + 2 for t in texts])
    letter = _letters()[codes]
    signs = np.where(letter, codes, 0).astype(U64)
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first of several signs that are no letters
    places = np.flatnonzero(keep)
    kept = signs[places]
    grams = (mix(kept[:-2] << U64(42) | kept[1:-1] << U64(21) | kept[2:]) >> U64(48)).astype(np.int64)
    # A trigram belongs to the text of its middle sign, which must be a letter.
    ok = kept[1:-1] > 0
    middle = places[1:-1][ok]
    return grams[ok], np.searchsorted(middle, np.concatenate([[0], ends]))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(counts[some])],
                ["lang", "bin", "n"],
            )
        held.clear()

    for rows, _, _ in chunks(batches, "text"):
        bins, at = trigrams(rows.column("text").to_pylist())
        langs, code = np.unique(np.array(rows.column("lang").to_pylist(), object).astype(str), return_inverse=True)
        owner = np.repeat(code, np.diff(at))
        for i, lang in enumerate(langs.tolist()):
            counts = np.bincount(bins[owner == i], minlength=BINS)
            held[lang] = held[lang] + counts if lang in held else counts
        if len(held) > 64:
            yield from flush()
    yield from flush()


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of all bins, from all rows with a text and a language.

    Tasks count, an aggregate adds up, and the driver gets at most ``BINS`` rows per language.
    """
    rows = labelled.select(
        F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    counted = (
        rows.mapInArrow(_count, "lang string, bin int, n long")
        .groupBy("lang", "bin")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs, code = np.unique(np.array(counted.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    table = np.full((len(langs), BINS), SMOOTHING)
    table[code, counted.column("bin").to_numpy()] += counted.column("n").to_numpy()
    return langs.tolist(), np.log(table / table.sum(axis=1, keepdims=True))


class Mixtures:
    """Expectation-maximisation for many texts at once; rows are (text, bin) with their counts."""

    def __init__(self, logs: np.ndarray, text: np.ndarray, bins: np.ndarray, counts: np.ndarray, n_texts: int):
        self.given = logs.T[bins]
        # Each row relative to its likeliest language, so that nothing becomes zero.
        self.shift = self.given.max(axis=1)
        self.given = np.exp(self.given - self.shift[:, None]).astype(np.float32)
        self.text, self.counts = text, counts.astype(np.float32)
        self.first = np.searchsorted(text, np.arange(n_texts))
        self.total = np.add.reduceat(counts.astype(float), self.first)

    def run(self, start: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Proportions and log-likelihoods after some rounds; a language at zero stays there."""
        share = start.astype(np.float32)
        for _ in range(rounds):
            part = self.given * share[self.text]
            part *= (self.counts / part.sum(axis=1))[:, None]
            share = np.add.reduceat(part, self.first, axis=0) / self.total[:, None].astype(np.float32)
        mixed = np.einsum("ij,ij->i", self.given, share[self.text], dtype=float)
        logs = np.log(np.maximum(mixed, 1e-300)) + self.shift
        return share, np.add.reduceat(logs * self.counts, self.first)


def infer(logs: np.ndarray, bins: np.ndarray, at: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """Proportions of the languages in each text; all zero for a text without letters."""
    out = np.zeros((len(at) - 1, len(logs)))
    filled = np.flatnonzero(np.diff(at))
    if not len(filled) or not len(logs):
        return out
    owner = np.repeat(np.arange(len(filled)), np.diff(at)[filled])
    keys, counts = np.unique(owner << 16 | bins, return_counts=True)
    text, bins = keys >> 16, keys & (BINS - 1)
    fit = Mixtures(logs, text, bins, counts, len(filled))
    everything = np.full((len(filled), len(logs)), 1 / len(logs))
    full, _ = fit.run(everything, rounds)
    rank = np.argsort(np.argsort(-full, axis=1, kind="stable"), axis=1, kind="stable")
    best, likelihood = fit.run(rank == 0, 0)
    best = best.astype(float)
    open_texts = np.arange(len(filled))
    for size in range(2, len(logs) + 1):  # sets of the leading languages, while they pay
        rows = np.isin(text, open_texts)
        some = Mixtures(logs, np.searchsorted(open_texts, text[rows]), bins[rows], counts[rows], len(open_texts))
        start = np.where(rank[open_texts] < size, np.maximum(full[open_texts], 1e-6), 0)
        share, more = some.run(start / start.sum(axis=1, keepdims=True), rounds // 3)
        pays = more - likelihood[open_texts] > penalty * np.log(some.total + 1)
        open_texts = open_texts[pays]
        if not len(open_texts):
            break
        best[open_texts], likelihood[open_texts] = share[pays], more[pays]
    out[filled] = best
    return out


def identify(
    documents: DataFrame,
    labelled: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    penalty: float = PENALTY,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``proportions`` (language to share) of every text.

    ``labelled`` has ``text`` and ``lang``; rows without either are left out of the counts. The
    leading language is predicted, at equal shares the first by name, and its share is the score. A
    text that is null or has no letters, or any text where nothing was learned, is ``und`` with
    score 0 and no proportions. One row per input row, repeated ids included; a null id stays null.
    Texts are read whole. The model holds ``BINS`` numbers per language and goes to all tasks. An
    empty table gives an empty result; further columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(fit(labelled, text, lang))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = model.value
        for rows, _, _ in chunks(batches, "text", CHUNK_BYTES * 4 // max(4, len(langs))):
            bins, at = trigrams(rows.column("text").to_pylist())
            share = infer(logs, bins, at, penalty, rounds)
            names, scores, parts = [], [], []
            for row in share.tolist():
                known = [(langs[i], x) for i, x in enumerate(row) if x > 0]
                name, score = max(known, key=lambda x: x[1], default=(UNKNOWN, 0.0))
                names.append(name)
                scores.append(min(score, 1.0))
                parts.append(known)
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), pa.array(names), pa.array(scores, pa.float64()), pa.array(parts, pa.map_(pa.string(), pa.float64()))],
                ["id", "lang_pred", "score", "proportions"],
            )

    found = as_documents(documents, id_name, text).mapInArrow(
        run, "id long, lang_pred string, score double, proportions map<string, double>"
    )
    return found.select(named(), "lang_pred", "score", "proportions")

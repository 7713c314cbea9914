"""Language identification by sparse multinomial logistic regression on character n-grams.

Features are TF-IDF weights of letter bigrams and trigrams (a word's edges count as a sign),
hashed into `BUCKETS` and scaled to length one. Weights are trained by follow-the-regularised-
leader with an elastic net, which leaves most of them zero; a temperature fitted on rows that
took no part in the training calibrates the probabilities.

The regression is fitted on at most `ROWS_PER_LANGUAGE` rows of each language, chosen by a hash
of their id. Document frequencies are counted over all rows that may be learned from, and every
row is scored on its whole text. Tasks hold one run of texts and the model (one megabyte per
four languages).

Defined results: a null text, or one without a letter, is `und` with score 1; without any row to
learn from, every other text is `und` with score 0; repeated rows are scored one by one; ties
between languages go to the first in order of their names; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import claim, code_points, column, letters, mix, text_runs, with_new_columns

BUCKETS = 2**15
ROWS_PER_LANGUAGE = 1000
EPOCHS = 4
RATE, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
CALIBRATION_SHARE = 0.2
UNKNOWN = "und"


def gram_counts(texts: list[str | None]) -> Iterator[np.ndarray | None]:
    """Counts of the hashed n-grams of each text; None for a text without letters."""
    codes, begins = code_points(texts)
    known = letters()[codes]
    signs = np.where(known, codes, 0).astype(np.uint64)
    with np.errstate(over="ignore"):
        pairs = signs[:-1] * np.uint64(0x9E3779B1) + signs[1:]
        two = (mix(pairs) & np.uint64(BUCKETS - 1)).astype(np.int32)
        three = (mix(pairs[:-1] * np.uint64(0x85EBCA77C2B2AE63) + signs[2:] + np.uint64(1)) & np.uint64(BUCKETS - 1)).astype(np.int32)
    # A pair needs a letter, a triple one in its middle or two around none.
    two_ok = known[:-1] | known[1:]
    three_ok = known[1:-1]
    for low, high in zip(begins[:-1], begins[1:], strict=True):
        high = int(high)
        if not known[low:high].any():
            yield None
            continue
        found = np.concatenate([two[low:high][two_ok[low:high]], three[low : high - 1][three_ok[low : high - 1]]])
        yield np.bincount(found, minlength=BUCKETS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sparse TF-IDF vector of length one: (buckets, weights)."""
    at = np.flatnonzero(counts)
    values = np.log1p(counts[at]) * idf[at]
    return at, values / max(float(np.sqrt(values @ values)), 1e-12)


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # languages x (buckets + 1); the last is the bias
    temperature: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        at, values = weighted(counts, self.idf)
        return softmax((self.weights[:, at] @ values + self.weights[:, -1]) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def document_frequencies(rows: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and the number of texts; one array per task is summed up."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        sums, n = np.zeros(BUCKETS + 1, dtype=np.int64), 0
        for batch in batches:
            for _, texts in text_runs(batch, text):
                for counts in gram_counts(texts):
                    if counts is not None:
                        sums[:-1] += counts > 0
                        n += 1
        sums[-1] = n
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["bucket", "n"])

    found = rows.select(text).mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    sums = np.zeros(BUCKETS + 1, dtype=np.int64)
    sums[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return sums[:-1], int(sums[-1])


def sample_rows(rows: DataFrame, per_language: int, lang: str = "lang") -> DataFrame:
    """About `per_language` rows of each language, chosen by a hash of the id."""
    sizes = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col(lang) == name, F.lit(min(1.0, per_language / n))).otherwise(share)
    return rows.filter(F.expr("pmod(xxhash64(doc_id, 'language'), 1000000)") < share * 1000000)


def follow_the_leader(examples: list[tuple[np.ndarray, np.ndarray, int]], n_languages: int, seed: int = 7) -> np.ndarray:
    """FTRL-proximal weights, languages x (buckets + 1)."""
    z = np.zeros((n_languages, BUCKETS + 1))
    squares = np.zeros_like(z)
    rng = np.random.default_rng(seed)

    def current(at: np.ndarray) -> np.ndarray:
        zs = z[:, at]
        w = -(zs - np.sign(zs) * L1) / ((BETA + np.sqrt(squares[:, at])) / RATE + L2)
        return np.where(np.abs(zs) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for i in rng.permutation(len(examples)):
            at, values, label = examples[i]
            at, values = np.append(at, BUCKETS), np.append(values, 1.0)
            w = current(at)
            error = softmax(w @ values)
            error[label] -= 1
            gradient = np.outer(error, values)
            before = squares[:, at]
            after = before + gradient**2
            z[:, at] += gradient - (np.sqrt(after) - np.sqrt(before)) / RATE * w
            squares[:, at] = after
    return current(np.arange(BUCKETS + 1))


def fitted_temperature(logits: list[np.ndarray], labels: list[int]) -> float:
    """The temperature with the smallest log loss, from a grid of ratios of 1.1; none below 0.38, so that an errorless fold does not give certainty."""
    if not logits:
        return 1.0
    grid = 1.1 ** np.arange(-10, 31)
    losses = [-sum(float(np.log(max(softmax(x / t)[y], 1e-300))) for x, y in zip(logits, labels, strict=True)) for t in grid]
    return float(grid[int(np.argmin(losses))])


def train(rows: DataFrame, per_language: int = ROWS_PER_LANGUAGE, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Fits the model on rows with a language; the caller has left out what must not be learned."""
    rows = rows.filter(F.col(lang).isNotNull())
    frequencies, n = document_frequencies(rows, text)
    idf = np.log((1 + n) / (1 + frequencies)) + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_runs(batch, text):
                found = [weighted(c, idf) if c is not None else (np.empty(0, np.int64), np.empty(0)) for c in gram_counts(texts)]
                yield pa.RecordBatch.from_arrays(
                    [column(part, lang), pa.array([a.astype("<i4").tobytes() for a, _ in found], pa.binary()),
                     pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary()), column(part, "fold")],
                    names=["lang", "at", "weights", "fold"],
                )

    fold = F.expr(f"pmod(xxhash64(doc_id, 'calibration'), 1000) < {int(1000 * CALIBRATION_SHARE)}").alias("fold")
    sample = sample_rows(rows, per_language, lang).select("doc_id", F.col(lang).alias("lang"), F.col(text).alias("text"), fold)
    text = "text"
    lang = "lang"
    found = sample.mapInArrow(counted, "lang string, at binary, weights binary, fold boolean").toPandas()
    found = found[found["at"].map(len) > 0].sort_values(["lang", "at", "weights"]).reset_index(drop=True)
    languages = sorted(found["lang"].unique())
    if not languages:
        return LanguageModel([], idf, np.zeros((0, BUCKETS + 1)), 1.0)
    place = {g: i for i, g in enumerate(languages)}
    examples = [
        (np.frombuffer(a, "<i4").astype(np.int64), np.frombuffer(w, "<f4").astype(float), place[g])
        for a, w, g in zip(found["at"], found["weights"], found["lang"], strict=True)
    ]
    held = found["fold"].to_numpy(bool)
    learned = [e for e, h in zip(examples, held, strict=True) if not h] or examples
    weights = follow_the_leader(learned, len(languages))
    logits = [weights[:, at] @ v + weights[:, -1] for (at, v, _), h in zip(examples, held, strict=True) if h]
    temperature = fitted_temperature(logits, [y for (_, _, y), h in zip(examples, held, strict=True) if h])
    return LanguageModel(languages, idf.astype(np.float32), weights.astype(np.float32), temperature)


def identify(docs: DataFrame, model: LanguageModel, keep: list[str | Column] | None = None, text: str = "text") -> DataFrame:
    """The chosen columns of each row, or all, with `lang_pred` and `score`, the predicted language's probability."""

    def judged(texts: list[str | None]) -> list[pa.Array]:
        claim("language")
        names, scores = [], []
        for counts in gram_counts(texts):
            if counts is None or not model.languages:
                names.append(UNKNOWN)
                scores.append(1.0 if counts is None else 0.0)
                continue
            p = model.probabilities(counts)
            names.append(model.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    return with_new_columns(docs, keep, text, [("lang_pred", "string"), ("score", "double")], judged)

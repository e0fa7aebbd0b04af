"""Language identification with string kernels.

Two stretches of text are as similar as the blended spectrum presence kernel says: the
number of different character n-grams (n = 1 to 3) that both hold, divided by the root of
the product of their own numbers. Landmark stretches give the Nyström map of that kernel,
and a one-versus-rest kernel ridge regression on it gives a score per language.

The regression is a sum over landmarks of kernel values. The kernel is an inner product
of presence vectors, so landmarks and weights fold into one matrix (n-grams x languages),
and a batch of stretches is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import give_back
from sluice.session import small_batches

UNKNOWN = "und"
# n-grams are hashed to this many columns.
BITS = 14
SIZES = (1, 2, 3)
# Characters of a stretch; a text is scored over all its stretches.
STRETCH = 1024
# The bound of the training sample: documents per language, and stretches per document.
SAMPLE = 150
SAMPLE_STRETCHES = 4
LANDMARKS = 64
RIDGE = 1e-2
# Stretches that are scored in one matrix product.
BATCH = 256

LETTER = regex.compile(r"\p{L}")


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def presence(codes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Which hashed n-grams each of ``count`` stretches holds; ``rows`` tells each character's stretch."""
    out = np.zeros(count << BITS, bool)
    mix, base = np.uint64(0x9E3779B97F4A7C15), rows.astype(np.int64) << BITS
    gram = np.zeros(len(codes), np.uint64)
    for n in SIZES:
        # The n-gram that starts at each place, as far as it stays in the stretch.
        if n > len(codes):
            break
        gram = gram[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :] + np.uint64(n)
        inside = rows[: len(gram)] == rows[n - 1 :]
        column = ((gram * mix) >> np.uint64(64 - BITS)).astype(np.int64)
        out[(base[: len(gram)] + column)[inside]] = True
    return out.reshape(count, 1 << BITS)


def stretches(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """Characters of a whole text, the stretch of each, and the number of stretches, of almost equal length."""
    codes = _codes(text)
    n = max(1, -(-len(codes) // STRETCH))
    return codes, np.arange(len(codes)) * n // max(1, len(codes)), n


@dataclass(frozen=True)
class LanguageModel:
    """Languages and the folded matrix of landmarks and ridge weights."""

    languages: tuple[str, ...]
    weights: np.ndarray

    def scores(self, texts: list[str]) -> np.ndarray:
        """A score per text and language: the mean over the text's stretches."""
        total, counts = np.zeros((len(texts), len(self.languages))), np.ones(len(texts))
        waiting: list[tuple[int, np.ndarray, np.ndarray, int]] = []

        def flush() -> None:
            if not waiting:
                return
            offsets = np.cumsum([0] + [w[3] for w in waiting])
            rows = np.concatenate([w[2] + o for w, o in zip(waiting, offsets)])
            held = presence(np.concatenate([w[1] for w in waiting]), rows, int(offsets[-1])).astype(np.float32)
            norm = np.sqrt(np.maximum(held.sum(axis=1, dtype=np.float64), 1.0))
            scored = (held @ self.weights) / norm[:, None]
            np.add.at(total, np.repeat([w[0] for w in waiting], [w[3] for w in waiting]), scored)
            waiting.clear()

        for i, text in enumerate(texts):
            codes, rows, n = stretches(text)
            counts[i] = n
            for first in range(0, n, BATCH):
                # Very long texts go in several batches.
                a, b = np.searchsorted(rows, (first, first + BATCH))
                part = min(BATCH, n - first)
                if sum(w[3] for w in waiting) + part > BATCH:
                    flush()
                waiting.append((i, codes[a:b], rows[a:b] - first, part))
        flush()
        return total / counts[:, None]


def fit(texts: list[str], langs: list[str]) -> LanguageModel:
    """Nyström landmarks and one-versus-rest ridge regression on labelled texts."""
    languages = tuple(sorted(set(langs)))
    vectors, labels, landmarks = [], [], []
    taken: dict[str, int] = dict.fromkeys(languages, 0)
    for text, lang in zip(texts, langs):
        codes, rows, n = stretches(text)
        held = presence(codes, rows, n)
        for k in np.linspace(0, n - 1, min(n, SAMPLE_STRETCHES)).astype(int):
            if taken[lang] < LANDMARKS:
                landmarks.append(len(vectors))
                taken[lang] += 1
            vectors.append(np.packbits(held[k]))
            labels.append(languages.index(lang))
    x = np.unpackbits(np.array(vectors), axis=1).astype(np.float32)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1.0))
    marks = x[landmarks]
    values, basis = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    kept = values > 1e-6 * values[-1]
    root = basis[:, kept] / np.sqrt(values[kept])
    mapped = (x @ marks.T).astype(np.float64) @ root
    labels = np.array(labels)
    # Every language weighs the same, however many stretches it has.
    share = 1.0 / np.bincount(labels, minlength=len(languages))[labels]
    goal = (labels[:, None] == np.arange(len(languages))).astype(np.float64)
    weighed = mapped * share[:, None]
    solved = np.linalg.solve(mapped.T @ weighed + RIDGE * np.eye(mapped.shape[1]) * share.sum() / len(labels), weighed.T @ goal)
    return LanguageModel(languages, (marks.T.astype(np.float64) @ (root @ solved)).astype(np.float32))


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether crc32 of the id as text falls in the fold that is not learned from; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE
) -> LanguageModel:
    """Fit on about ``sample`` documents per language, those with the smallest hashes of id and text.

    Only rows outside the held-out fold with a label and a letter in the text count. The
    sample is drawn by a hash threshold per language, so it is the same on every run and
    its size, on the driver, depends on the number of languages alone. Of a sampled text
    the stretches up to ``SAMPLE_STRETCHES`` are learned, spread over its whole length.
    Without such rows the model knows no language and predicts none.
    """
    usable = docs.where(
        ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")
    ).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col, text_col).alias("h"))
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel((), np.zeros((1 << BITS, 0), np.float32))
    spark = docs.sparkSession
    # Twice the share that is needed, so that enough rows pass; the smallest hashes stay.
    limits = [(k, float(min(1.0, (2 * sample + 20) / n))) for k, n in counts.items()]
    drawn = usable.join(F.broadcast(spark.createDataFrame(limits, "lang string, share double")), "lang").where(
        F.col("h") <= F.lit(-(2.0**63)) + F.col("share") * F.lit(2.0**64)
    )
    n = F.length("text")
    step = F.ceil(n / F.lit(SAMPLE_STRETCHES)).cast("int")
    # Not more than the learned stretches leave the executors.
    spread = F.concat_ws("\n", *[F.substring(F.col("text"), step * i + 1, F.least(step, F.lit(STRETCH))) for i in range(SAMPLE_STRETCHES)])
    rows = drawn.select("lang", "h", spread.alias("text")).collect()
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["h"], r["text"]))
    texts, langs = [], []
    for lang in sorted(by_lang):
        for _, text in sorted(by_lang[lang])[:sample]:
            texts.append(text)
            langs.append(lang)
    return fit(texts, langs)


def predicted(text: Column, model: LanguageModel) -> Column:
    """``lang_pred`` and ``score`` (0 to 1) of each text; ``und`` and 0 for a null text or one without letters."""

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known and model.languages:
                found = model.scores([texts.iloc[i] for i in known])
                best = found.argmax(axis=1)
                names[known] = np.array(model.languages, object)[best]
                scores[known] = np.clip(found[np.arange(len(known)), best], 0.0, 1.0)
            yield pd.DataFrame({"lang_pred": names, "score": scores})
        give_back()

    return run(text)


def identify_language(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``.

    Whole texts are scored; only the text is looked at. Equal scores go to the language
    that sorts first. Repeated rows stay, an empty table gives no rows, and nothing is
    shuffled: the model is a matrix of fixed size that travels with the function.
    """
    small_batches(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("id"), predicted(F.col(text_col), model).alias("p"))
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "p.lang_pred", "p.score")

"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on toxic text. A text is cut
into windows of some 128 bytes; a window that the toxic dictionary shortens by more bytes than the
ordinary one looks toxic. A text's score comes from how many of its windows exceed calibrated
thresholds, and by how much.

Labels mark documents, not windows, and most words of a toxic document are ordinary. So the
ordinary dictionary is large, the toxic one stands in front of the same ordinary text, and it is
trained again on those windows of toxic documents that it shortens by more than it shortens all
but ``QUANTILE`` of ordinary windows that neither has seen. Thresholds are quantiles on these
ordinary windows too, and documents that no dictionary has seen calibrate the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.workers import give_back
from sluice.session import small_batches

# A window ends at a word after so many bytes, at the latest after twice as many.
WINDOW = 128
# Bytes of the dictionaries: ordinary text, toxic text at first, toxic text when trained on its own windows.
ORDINARY, TOXIC, PURE = 1 << 18, 1 << 14, 1 << 13
ROUNDS = 2
# Bytes of the pieces that dictionaries are put together from: words with their surroundings, or about a word each.
PIECE, PURE_PIECE = 24, 12
QUANTILE = 0.99
# Share of windows that a document may have in common with those before it in the sample.
COPIED = 0.25
# Quantiles of ordinary windows that set the thresholds.
MARKS = (0.95, 0.99, 0.999)
# The bound of the training sample: documents per label, and windows per document.
SAMPLE, SAMPLE_WINDOWS = 2048, 64
# Parts that the sample is cut into for calibration.
FOLDS = 4
SETTINGS = zstandard.ZstdCompressionParameters.from_level(
    9, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS
)
LOWER = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def windows(text: str) -> list[bytes]:
    """A whole text in windows of words, lower-cased in A-Z, white space as one blank; an empty text has one empty window.

    Where a window ends depends on its words, so copies of a passage are cut alike.
    """
    out, words, size = [], [], 0
    for word in text.encode().translate(LOWER).split():
        for at in range(0, len(word), 2 * WINDOW):
            part = word[at : at + 2 * WINDOW]
            if size + len(part) > 2 * WINDOW:
                out.append(b" ".join(words))
                words, size = [], 0
            words.append(part)
            size += len(part) + 1
            if size >= WINDOW and xxhash.xxh3_64_intdigest(part) % 3 == 0:
                out.append(b" ".join(words))
                words, size = [], 0
    if words or not out:
        out.append(b" ".join(words))
    return out


def dictionary(samples: list[bytes], size: int, piece: int = PIECE) -> bytes:
    """The text of a dictionary trained on samples; of too few samples, what there is of them."""
    try:
        trained = zstandard.train_dictionary(size, samples, k=piece, d=6).as_bytes()
    except zstandard.ZstdError:
        return b" ".join(samples)[:size]
    # The tables before the text hold statistics of these samples, which would weigh more than the words.
    return trained[min(512, len(trained) // 4) :]


def compressor(text: bytes) -> zstandard.ZstdCompressor | None:
    if len(text) < 8:
        return zstandard.ZstdCompressor(compression_params=SETTINGS)
    held = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(compression_params=SETTINGS)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=SETTINGS)


def lengths(by: zstandard.ZstdCompressor, parts: list[bytes]) -> np.ndarray:
    return np.fromiter((len(by.compress(p)) for p in parts), np.int64, len(parts))


def features(saved: np.ndarray, sizes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Per document, from the bytes saved in each of its windows: how much, how often above the marks, and the most."""
    ends = np.cumsum(sizes)
    starts = ends - sizes
    gained = np.maximum(saved, 0)
    mean = np.add.reduceat(gained, starts) / sizes
    most = np.maximum.reduceat(gained, starts)
    over = [np.add.reduceat((saved > m).astype(np.int64), starts) / sizes for m in marks]
    beyond = [np.add.reduceat(np.maximum(saved - m, 0.0), starts) / sizes for m in marks[:2]]
    return np.stack([mean, np.log1p(100 * mean), np.log1p(most), *over, np.log1p(100 * over[1]), *beyond], axis=1)


@dataclass(frozen=True)
class ToxicityModel:
    """The dictionaries, the thresholds, and the calibration; without dictionaries every text scores ``share``."""

    share: float
    ordinary: bytes | None = None
    toxic: bytes | None = None
    marks: np.ndarray | None = None
    centre: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None


def _saved(model: ToxicityModel):
    one, two = compressor(model.ordinary), compressor(model.toxic + model.ordinary)
    return lambda parts: lengths(one, parts) - lengths(two, parts)


def scores(model: ToxicityModel, texts: list[list[bytes]], saved) -> np.ndarray:
    """The calibrated score of documents, given as windows."""
    if model.ordinary is None or not texts:
        return np.full(len(texts), model.share)
    sizes = np.array([len(t) for t in texts])
    found = features(saved(list(chain.from_iterable(texts))), sizes, model.marks)
    return 1 / (1 + np.exp(-np.clip((found - model.centre) / model.spread @ model.weights[1:] + model.weights[0], -30, 30)))


def _regression(found: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton's method, with a small ridge."""
    centre, spread = found.mean(axis=0), found.std(axis=0) + 1e-9
    rows = np.concatenate([np.ones((len(found), 1)), (found - centre) / spread], axis=1)
    ridge, w = 1e-1 * np.eye(rows.shape[1]), np.zeros(rows.shape[1])
    ridge[0, 0] = 1e-9
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        step = np.linalg.solve((rows * (weight * p * (1 - p))[:, None]).T @ rows + ridge, rows.T @ (weight * (toxic - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
    return centre, spread, w


def _distinct(docs: list[list[bytes]]) -> list[list[bytes]]:
    """The windows of each document, without those of near copies.

    Passages that several documents share would outweigh the words that many of them hold: a window counts
    where it comes first, and a document that has more than ``COPIED`` of its windows from others not at all.
    """
    seen: set[bytes] = set()
    out = []
    for doc in docs:
        mine = [w for w in dict.fromkeys(doc) if w not in seen]
        if len(mine) >= (1 - COPIED) * len(doc):
            out.append(mine)
        seen.update(mine)
    return out


def _dictionaries(plain_docs: list[list[bytes]], toxic_docs: list[list[bytes]], share: float) -> ToxicityModel:
    """Dictionaries and thresholds, without a calibration."""
    toxic = list(chain.from_iterable(_distinct(toxic_docs)))
    # Half of the ordinary documents train, the others tell how far ordinary windows go.
    plain, fresh = (list(chain.from_iterable(_distinct(plain_docs[i::2]))) for i in (0, 1))
    known = set(plain)
    fresh = [w for w in fresh if w not in known] or plain or [b""]
    toxic = toxic or [b""]
    ordinary = dictionary(plain, ORDINARY)
    base = compressor(ordinary)
    plain_fresh, plain_toxic = lengths(base, fresh), lengths(base, toxic)
    text = dictionary(toxic, TOXIC)
    for _ in range(ROUNDS):
        both = compressor(text + ordinary)
        bar = np.quantile(plain_fresh - lengths(both, fresh), QUANTILE)
        pure = [w for w, s in zip(toxic, plain_toxic - lengths(both, toxic)) if s > bar]
        if not pure:
            break
        text = dictionary(pure, PURE, PURE_PIECE)
    saved = plain_fresh - lengths(compressor(text + ordinary), fresh)
    return ToxicityModel(share, ordinary, text, np.quantile(saved, MARKS))


def fit(sample: list[tuple[list[bytes], int]], counts: dict[int, int]) -> ToxicityModel:
    """A model from ``(windows, toxic)``; ``counts`` are the numbers of labelled documents, for the true share of toxic ones."""
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    docs = [[w for w, toxic in sample if toxic == t] for t in (0, 1)]
    if min(map(len, docs)) < 2:
        return ToxicityModel(share)
    rows, label = [], []
    folds = min(FOLDS, *map(len, docs))
    for fold in range(folds):
        held, taught = ([[w for i, w in enumerate(d) if (i % folds == fold) == own] for d in docs] for own in (True, False))
        part = _dictionaries(*taught, share)
        parts = held[0] + held[1]
        rows.append(features(_saved(part)(list(chain.from_iterable(parts))), np.array([len(w) for w in parts]), part.marks))
        label += [0.0] * len(held[0]) + [1.0] * len(held[1])
    label = np.array(label)
    weight = np.where(label == 1, counts[1] / len(docs[1]), counts[0] / len(docs[0]))
    whole = _dictionaries(*docs, share)
    return ToxicityModel(share, whole.ordinary, whole.toxic, whole.marks, *_regression(np.concatenate(rows), label, weight / weight.mean()))


def _held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic") -> ToxicityModel:
    """Learn from labelled documents whose ``crc32(doc_id as text) mod 5`` is not 0.

    At most ``SAMPLE`` documents per label, by a hash of the id, and ``SAMPLE_WINDOWS`` windows of
    each, spread over its whole text, reach the driver. Labels other than 0 and 1 and ids without a label,
    or with both, teach nothing; of an id with several texts the least in order is taken; where a label has no documents, every score is the share of toxic labels.
    """
    spark = docs.sparkSession
    small_batches(spark)
    judged = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{toxic_col}`").cast("int").alias("toxic")).where(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~_held_out(F.col("id"))
    ).groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most").drop("most")
    known = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).where("id IS NOT NULL")
    # Which documents are in the sample is settled before texts are read.
    order = F.hash(F.xxhash64(F.col("id").cast("string"), F.lit("toxicity")))
    listed = known.select("id").distinct().join(judged, "id").withColumn("order", order)
    counts = {r["toxic"]: r["count"] for r in listed.groupBy("toxic").count().collect()}
    chosen = F.lit(False)
    for label, n in counts.items():
        bound = -(2**31) + min(2**32 - 1, int(2**32 * 1.2 * SAMPLE / n))
        chosen = chosen | ((F.col("toxic") == label) & (F.col("order") <= bound))

    @F.pandas_udf("array<binary>")
    def spread_windows(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            parts = windows(text)
            at = np.linspace(0, len(parts) - 1, min(len(parts), SAMPLE_WINDOWS)).astype(int)
            out.append([parts[i] for i in at])
        return pd.Series(out, dtype=object)

    # Some 1.2 * SAMPLE ids per label, whatever the number of documents.
    picked = known.join(F.broadcast(listed.where(chosen)), "id").withColumn("windows", spread_windows("text"))
    rows = picked.groupBy(F.col("id").cast("string").alias("id"), "order", "toxic").agg(F.min("windows").alias("windows")).collect()
    taken, sample = {0: 0, 1: 0}, []
    for r in sorted(rows, key=lambda r: (r["order"], r["id"])):
        taken[r["toxic"]] += 1
        if taken[r["toxic"]] <= SAMPLE:
            sample.append(([bytes(w) for w in r["windows"]], r["toxic"]))
    return fit(sample, counts)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5) for every row and its whole text.

    Null and empty texts are scored like a text without a word. Repeated rows are scored alike; a row
    without an id is not held out. An empty table gives no rows; other columns take no part.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        saved = _saved(model) if model.ordinary is not None else None
        for texts in batches:
            out, waiting, at = [], [], 0
            for text in texts:
                waiting.append(windows(text or ""))
                at += len(waiting[-1])
                if at > 1 << 15:
                    out.append(scores(model, waiting, saved))
                    waiting, at = [], 0
            out.append(scores(model, waiting, saved))
            yield pd.Series(np.concatenate(out))
        give_back()

    doc_id = F.col(f"`{id_col}`")
    found = docs.select(doc_id.alias(id_col), _held_out(doc_id).alias("held_out"), scored(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

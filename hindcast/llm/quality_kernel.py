"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic
regression.

The features ``sqrt(2 / D) cos(W x + b)`` with normal ``W`` approximate a Gaussian kernel over standardised statistics.
Every partition sums its share of the normal equations; the sums are added and solved once. A part of the training rows
stays out of the fit and calibrates the raw score.

Only ``MAX_TRAIN`` labelled rows (in expectation, chosen by a hash of the id) fit the model; every text is scored whole,
where it lies, without a shuffle.

Defined results: null text counts as empty; null ids are scored but never learned from (their remainder is unknown);
labels other than 0 and 1 are ignored; without training rows every score is 0.5, with one class the share of that
class; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from hindcast.llm.common import remainder, settled, share_of, small_batches, text_of

MAX_TRAIN = 40_000
WIDTH = 256  # random features
BANDWIDTH = 4.0  # of the kernel, in standard deviations
RIDGE = 1e-3  # per training row
CLIP = 6.0  # standard deviations
CALIBRATES = 0.3  # share of the training rows kept for calibration
KEEP_FROM = 0.7

STATISTICS = (
    "log_chars", "log_words", "word_length", "upper_share", "symbol_share", "shout_share", "digit_share", "variety",
    "repeat_share", "top_word_share", "repeat_line_share", "log_line_words", "bare_share", "punctuation_share",
    "blank_share", "trigram_variety",
)
SYMBOLS = "#*$%&|<>{}[]\\^~=+@_/"
SLICE = 1 << 20


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """0 other, 1 lower, 2 upper, 3 digit, 4 blank, 5 symbol, 6 shout, 7 punctuation, by code point below 65536."""
    kinds = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        kinds[code] = (
            4 if c.isspace() else 5 if c in SYMBOLS else 6 if c in "!?" else 3 if c.isdigit() else 2 if c.isupper()
            else 1 if c.isalpha() else 7 if c in ".,;:'\"-()" else 0)
    return kinds


def statistics_of(text: str) -> list[float]:
    kinds = np.zeros(8)
    for at in range(0, len(text), SLICE):
        codes = np.frombuffer(text[at:at + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        kinds += np.bincount(_kinds()[np.minimum(codes, (1 << 16) - 1)], minlength=8)
    words = text.split()
    n, chars = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    ids = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64) if n else np.zeros(0, np.int64)
    counts = np.bincount(ids) if n else np.zeros(1)
    distinct = int(np.count_nonzero(counts))
    bare = sum(not any(map(str.isalnum, w)) for w in set(words) if len(w) <= 4)
    wide = (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:] if n > 2 else ids[:0]
    letters = kinds[1] + kinds[2]
    return [
        np.log1p(chars), np.log1p(n), (chars - kinds[4]) / max(n, 1), kinds[2] / max(letters, 1), kinds[5] / max(chars, 1),
        kinds[6] / max(n, 1), kinds[3] / max(chars, 1), np.log1p(distinct) / max(np.log1p(n), 1e-9) if n else 1.0,
        float(np.count_nonzero(ids[1:] == ids[:-1])) / max(n, 1), counts.max() / max(n, 1) if n > 9 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)), bare / max(distinct, 1),
        kinds[7] / max(chars, 1), kinds[4] / max(chars, 1), len(pd.unique(wide)) / max(len(wide), 1) if len(wide) else 1.0,
    ]


def document_statistics(text: Column) -> Column:
    return F.pandas_udf(lambda texts: texts.map(statistics_of), ArrayType(DoubleType()))(text)


@dataclass(frozen=True)
class Model:
    """Everything a score needs; a few hundred kilobytes whatever the corpus."""

    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return features(x, self.centre, self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.level), 0.0, 1.0)


def features(x: np.ndarray, centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant."""
    rng = np.random.default_rng(17)
    w = rng.normal(size=(x.shape[1], WIDTH)) / BANDWIDTH
    b = rng.uniform(0, 2 * np.pi, WIDTH)
    z = np.clip((x - centre) / spread, -CLIP, CLIP)
    return np.hstack([np.sqrt(2 / WIDTH) * np.cos(z @ w + b), np.ones((len(x), 1))])


def normal_equations(rows: DataFrame, centre: np.ndarray, spread: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y, summed within partitions and then by matrix row."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((WIDTH + 2, WIDTH + 2))
        for batch in batches:
            if len(batch):
                z = np.column_stack([features(np.stack(batch["x"].to_list()), centre, spread), batch["y"]])
                total += z.T @ z
        yield pd.DataFrame({"line": np.arange(WIDTH + 2), "cells": list(total)})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"line": group["line"][:1], "cells": [np.sum(group["cells"].to_list(), axis=0)]})

    layout = "line long, cells array<double>"
    added = rows.select("x", "y").mapInPandas(sums, layout).groupBy("line").applyInPandas(add, layout)
    table = added.orderBy("line").toPandas()  # a matrix of fixed size
    whole = np.stack(table["cells"].to_list())
    return whole[:-1, :-1], whole[:-1, -1]


def training_rows(docs: DataFrame, labels: DataFrame, of: int, out: int) -> DataFrame:
    """doc_id, y, x, calibrates of the bounded sample of labelled documents."""
    marked = labelled(labels, "quality", of, out)
    chosen = marked.where(share_of(F.col("doc_id"), min(1.0, MAX_TRAIN / max(marked.count(), 1))))
    # At most about MAX_TRAIN ids.
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen), "doc_id")
    return settled(
        found.select(
            "doc_id", "y", document_statistics(F.col("text")).alias("x"),
            (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(1000)) < int(1000 * CALIBRATES)).alias("calibrates")),
        "quality-train")


def fit(sample: DataFrame) -> Model | float:
    """A model from rows (y, x, calibrates); a constant where there are no two classes."""
    shares = sample.groupBy("y").count().collect()
    if len(shares) < 2:
        return float(shares[0]["y"]) if shares else 0.5
    fitting = sample.where(~F.col("calibrates"))
    moments = (
        fitting.select(F.posexplode("x").alias("i", "v")).groupBy("i")
        .agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).orderBy("i").collect())
    if not moments:
        return 0.5
    centre = np.array([r["m"] for r in moments])
    spread = np.maximum([r["s"] for r in moments], 1e-6)
    gram, right = normal_equations(fitting, centre, spread)
    rows = gram[-1, -1]
    weights = np.linalg.solve(gram + RIDGE * rows * np.eye(len(gram)), right)
    plain = Model(centre, spread, weights, np.zeros(1), np.zeros(1))

    @F.pandas_udf("double")
    def raw(x: pd.Series) -> pd.Series:
        return pd.Series(plain.raw(np.stack(x.to_list())) if len(x) else [], dtype=float)

    held = sample.where("calibrates").select(raw("x").alias("raw"), "y")
    if not held.take(1):
        return Model(centre, spread, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))
    curve = IsotonicRegression(featuresCol="raw", labelCol="y").fit(held)
    return Model(centre, spread, weights, curve.boundaries.toArray(), curve.predictions.toArray())


def labelled(labels: DataFrame, column: str, of: int, out: int) -> DataFrame:
    """doc_id, y from 0/1 labels whose id leaves another remainder than ``out``."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("double").alias("y"))
        .where(F.col("y").isin(0.0, 1.0) & (remainder(F.col("doc_id"), of) != out)))


def quality_score(docs: DataFrame, labels: DataFrame, of: int, out: int) -> Column:
    """The calibrated score of ``text``, by a model fitted on ``docs`` and ``labels``."""
    small_batches(docs.sparkSession)
    model = fit(training_rows(docs, labels, of, out))
    if isinstance(model, float):
        return F.lit(model)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(shared.value.score(np.array([statistics_of(t) for t in texts])))

    return F.pandas_udf(score, DoubleType())(text_of())


def score_quality(docs: DataFrame, labels: DataFrame, *, of: int = 4, out: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(remainder(doc_id, of) == out, F.lit(False)).alias("held_out"),
        quality_score(docs, labels, of, out).alias("score"),
    ).withColumn("predicted", (F.col("score") >= KEEP_FROM).cast("int"))


def kept_by_quality(docs: DataFrame, labels: DataFrame, *, of: int = 4, out: int = 2) -> DataFrame:
    """The rows of ``docs`` that score ``KEEP_FROM`` or more."""
    return docs.where(quality_score(docs, labels, of, out) >= KEEP_FROM)

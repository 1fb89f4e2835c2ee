"""Toxicity by class-conditional Kneser-Ney models: a text is scored by how much likelier its words are under the model
of toxic texts than under that of ordinary ones.

Both classes have an interpolated Kneser-Ney model over the characters of lower-case words, of order ``ORDER``, so that a
word never seen is judged by its parts. Orders up to ``SHARED`` count both classes together: what is too rare for a
longer context backs off to the same probability in both classes and speaks for neither. As lower orders are shared,
scoring needs only log ratios: of each stored n-gram, and of each context's backoff weight.

A text gives the mean log ratio over its words, the highest mean over any run of ``RUN`` words, and its highest word; a
logistic curve, fitted on training rows kept out of the counts, turns them into a probability.

``MAX_TRAIN`` labelled rows per class (in expectation) fit the model, and ``MAX_GRAMS`` bounds its table, most frequent
first; every text is scored whole.

Defined results: null text counts as empty, and a text without words has ratios of 0; null ids are scored but never
learned from; labels other than 0 and 1 are ignored; without two classes in training every score is 0.5; repeated rows
are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType
from pyspark.sql.types import DoubleType

from hindcast.llm.common import remainder, settled, share_of, small_batches, text_of
from hindcast.llm.quality_kernel import labelled

MAX_TRAIN = 12_000
MAX_GRAMS = 400_000
ORDER = 6
SHARED = 3
RUN = 8
CALIBRATES = 0.25
TOXIC_FROM = 0.5
REMEMBERED = 500_000  # words whose ratio a worker keeps
CHUNK_CHARS = 4_000_000
BEGIN, END = "^", "$"  # no letters or digits, so no part of any word
TOKEN = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def gram_counts(rows: DataFrame) -> DataFrame:
    """gram, n0, n1: padded character n-grams of the highest order over rows (text, y)."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: Counter = Counter()
            for text, y in zip(batch["text"], batch["y"]):
                seen.update((w, y) for w in tokens(text))
            yield pd.DataFrame([(w, y, n) for (w, y), n in seen.items()], columns=["w", "y", "n"])

    words = rows.select("text", "y").mapInPandas(count, "w string, y double, n long")
    words = words.groupBy("w").agg(
        F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("n0"),
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("n1"))
    padded = F.concat(F.lit(BEGIN * (ORDER - 1)), F.col("w"), F.lit(END))
    grams = F.transform(F.sequence(F.lit(1), F.length("w") + 1), lambda i: F.substring(padded, i, F.lit(ORDER)))
    return words.select("n0", "n1", F.explode(grams).alias("gram")).groupBy("gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def hashed(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n code points that end at each place."""
    out = np.full(len(at), np.uint64(n))
    for back in range(n - 1, -1, -1):
        out = out * BASE + codes[at - back]
        out ^= out >> np.uint64(29)
    return out


def hash_of(grams: pd.Series) -> np.ndarray:
    n = len(grams.iloc[0]) if len(grams) else 0
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return hashed(codes, np.arange(len(grams)) * n + n - 1, n)


def found_in(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted keys, and which of them are right."""
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


@dataclass(frozen=True)
class Ratios:
    """Log ratios by order: of n-grams, and of the backoff weights of their contexts; bounded by MAX_GRAMS."""

    grams: dict[int, tuple[np.ndarray, np.ndarray]]
    backoff: dict[int, tuple[np.ndarray, np.ndarray]]

    def of(self, words: list[str]) -> np.ndarray:
        """The log ratio of each word, summed over its characters and its end."""
        if not words:
            return np.zeros(0)
        pad = BEGIN * (ORDER - 1)
        codes = np.frombuffer("".join(f"{pad}{w}{END}" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.uint64)
        sizes = np.array([len(w) + 1 for w in words])
        ends = np.cumsum(sizes + ORDER - 1)
        word = np.repeat(np.arange(len(words)), sizes)
        inner = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(ends - sizes, sizes) + inner
        out = np.zeros(len(at))
        open_ = np.arange(len(at))
        for n in range(ORDER, SHARED, -1):
            keys, values = self.grams[n]
            place, hit = found_in(keys, hashed(codes, at[open_], n))
            if hit.any():
                out[open_[hit]] += values[place[hit]]
            open_ = open_[~hit]
            keys, values = self.backoff[n]
            place, hit = found_in(keys, hashed(codes, at[open_] - 1, n - 1))
            if hit.any():
                out[open_[hit]] += values[place[hit]]
        return np.bincount(word, out, len(words))


def discount(counts: np.ndarray) -> float:
    """n1 / (n1 + 2 n2), kept inside (0, 1)."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return float(np.clip(one / max(one + 2 * two, 1), 0.1, 0.95))


def ratios(table: pd.DataFrame) -> Ratios:
    """Kneser-Ney log ratios from the highest order's counts (gram, n0, n1)."""
    orders = {ORDER: table.astype({"n0": float, "n1": float})}
    for n in range(ORDER - 1, 0, -1):
        # Lower orders count in how many different longer n-grams something continues.
        above = orders[n + 1]
        types = pd.DataFrame({
            "gram": above["gram"].str[1:], "n0": (above["n0"] > 0).astype(float), "n1": (above["n1"] > 0).astype(float)})
        types = types.groupby("gram", as_index=False, sort=True).sum()
        if n == SHARED:
            together = above.assign(gram=above["gram"].str[1:]).groupby("gram", sort=True).size().to_numpy(float)
            types["n0"] = types["n1"] = together
        orders[n] = types
    grams, backoff = {}, {}
    uniform = 1.0 / max(len(orders[1]), 1)
    below = None
    for n in range(1, ORDER + 1):
        now = orders[n]
        context, which = np.unique(now["gram"].str[:-1].to_numpy(object), return_inverse=True)
        p, gamma = [], []
        tail = now["gram"].str[1:]
        for c in ("n0", "n1"):
            count = now[c].to_numpy()
            cut = discount(count)
            total = np.bincount(which, count)
            types = np.bincount(which, count > 0)
            weight = np.where(total > 0, cut * types / np.maximum(total, 1), 1.0)
            rest = np.full(len(now), uniform) if below is None else below[c].reindex(tail).to_numpy()
            p.append(np.maximum(count - cut, 0) / np.maximum(total, 1)[which] + weight[which] * rest)
            gamma.append(weight)
        below = pd.DataFrame({"n0": p[0], "n1": p[1]}, index=now["gram"])
        if n > SHARED:
            for store, names, ratio in (
                    (grams, now["gram"], np.log(p[1]) - np.log(p[0])),
                    (backoff, pd.Series(context), np.log(gamma[1]) - np.log(gamma[0]))):
                keys = hash_of(names)
                order = np.argsort(keys)
                store[n] = keys[order], ratio[order]
    return Ratios(grams, backoff)


class Reader:
    """Measures of texts by one worker, which remembers the ratios of words it has met."""

    def __init__(self, table: Ratios):
        self.table, self.known = table, {}

    def __call__(self, texts: list[str]) -> np.ndarray:
        """mean, highest run, highest word, log size of each text."""
        out, start, held = [], 0, 0
        for i, text in enumerate(texts):
            held += len(text)
            if held > CHUNK_CHARS or i == len(texts) - 1:
                out.append(self.some(texts[start:i + 1]))
                start, held = i + 1, 0
        return np.concatenate(out) if out else np.zeros((0, 4))

    def some(self, texts: list[str]) -> np.ndarray:
        split = [tokens(t) for t in texts]
        flat = np.array(list(chain.from_iterable(split)), dtype=object)
        ids, distinct = pd.factorize(flat) if len(flat) else (np.zeros(0, int), [])
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in distinct if w not in self.known]
        self.known.update(zip(new, self.table.of(new)))
        ratio = np.array([self.known[w] for w in distinct], float)[ids] if len(flat) else np.zeros(0)
        ends = np.cumsum([len(w) for w in split])
        return np.array([measures(x) for x in np.split(ratio, ends[:-1])])


def measures(ratio: np.ndarray) -> tuple[float, float, float, float]:
    """Mean, highest mean of a run, highest word, and the length on a log scale."""
    n = len(ratio)
    if not n:
        return 0.0, 0.0, 0.0, 0.0
    run = min(RUN, n)
    upto = np.concatenate([[0.0], np.cumsum(ratio)])
    return ratio.mean(), (upto[run:] - upto[:-run]).max() / RUN, ratio.max(), np.log1p(n)


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; x has a constant column."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - 1e-2 * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta)), slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def design(measured: np.ndarray) -> np.ndarray:
    mean, top, most, size = measured.T
    return np.column_stack([mean, top, most, size, mean * size, top * size, most * size, np.ones(len(mean))])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, of: int = 5, out: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs``."""
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    marked = labelled(labels, "toxic", of, out)
    sizes = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    score = F.lit(0.5)
    if len(sizes) == 2:
        chosen = marked.where(
            (share_of(F.col("doc_id"), min(1.0, MAX_TRAIN / sizes[0.0])) & (F.col("y") == 0))
            | (share_of(F.col("doc_id"), min(1.0, MAX_TRAIN / sizes[1.0])) & (F.col("y") == 1)))
        # At most about 2 * MAX_TRAIN ids.
        train = settled(
            texts.join(F.broadcast(chosen), "doc_id")
            .withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("kn")), F.lit(1000)) < int(1000 * CALIBRATES)),
            "toxic-train")
        counted = gram_counts(train.where(~F.col("calibrates")))
        table = ratios(
            counted.orderBy(F.desc(F.col("n0") + F.col("n1")), "gram").limit(MAX_GRAMS).toPandas())  # bounded
        shared = spark.sparkContext.broadcast(table)

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            read = Reader(shared.value)
            for batch in batches:
                yield pd.DataFrame({"m": list(read(batch["text"].tolist())), "y": batch["y"].array})

        held = train.where("calibrates").select("text", "y").mapInPandas(
            measure, "m array<double>, y double").toPandas()  # a bounded sample
        beta = np.zeros(8)
        if held["y"].nunique() == 2:
            y = held["y"].to_numpy()
            beta = logistic(design(np.stack(held["m"].to_list())), y)
            # The sample has its own class shares; the offset puts those of the labels back.
            beta[-1] += np.log(sizes[1.0] / sizes[0.0]) - np.log(y.mean() / (1 - y.mean()))

        def chance(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
            read = Reader(shared.value)
            for part in parts:
                found = read(part.tolist())
                yield pd.Series(1 / (1 + np.exp(-np.clip(design(found) @ beta, -30, 30))), dtype=float)

        score = F.pandas_udf(chance, DoubleType(), PandasUDFType.SCALAR_ITER)("text")
    return texts.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), of) == out, F.lit(False)).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))

"""Mixing sources to target weights by the cube method of balanced sampling.

Each source has a target number of words. A document is taken ``floor(target / source size)`` times, and once more with
the fraction that is left as its inclusion probability. The cube method rounds these probabilities to 0 or 1 by moving
them inside the null-space of the balancing constraints (words and documents), so both totals stay put while units
settle one by one. A flight over a chunk of rows leaves at most two open units and those held back; the open units of
many chunks meet in the next level, until one small landing problem per source remains and is solved by trying every
subset.

Defined results: null text has size 0; null sources form one source, last in order; ids need not be unique or present;
an empty table gives no rows; a source of size 0 has target 0; other columns are ignored.
"""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import settled, text_of, word_count

MOST = 3.0  # a source's target is at most so many times its size
WEIGHTS = (1, 2, 3)  # by rank of the source, repeating
CHUNK_ROWS = 2_000  # rows of one flight
HELD = 64  # units per source kept open for the landing
TRIED = 14  # smallest units of the landing, all of whose subsets are tried
NEAR = 1e-9
LAYOUT = "doc_id long, source string, size long, source_size long, target double, times long, open double, held boolean, chunk long, chunks long, key long"


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, n, target: the water level at which capped targets sum to all words.

    Sorted by cap over weight, a source is capped when filling all up to its own level would not use up the words. One
    row per source goes through a single window.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")).cast("double")
    level = F.col("cap") / F.col("weight")
    every = Window.partitionBy()
    upto = Window.orderBy(level, "rank").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        ranked.withColumn("weight", weight)
        .withColumn("cap", MOST * F.col("source_size"))
        .withColumn("all_words", F.sum("source_size").over(every))
        .withColumn("below", F.sum("cap").over(upto))
        .withColumn("above", F.sum("weight").over(every) - F.sum("weight").over(upto))
        .withColumn("capped", F.col("below") + level * F.col("above") <= F.col("all_words"))
    )
    spare = F.col("all_words") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * spare / open_weight))
    return filled.select("source", "source_size", "n", target.alias("target"))


def null_vector(columns: list[tuple[float, ...]]) -> list[float] | None:
    """A direction along which the constraints do not change, for at most one column more than constraints.

    Plain elimination; None where the columns are independent.
    """
    rows = [list(r) for r in zip(*columns)]
    n, pivots = len(columns), []
    top = 0
    for c in range(n):
        best = max(range(top, len(rows)), key=lambda r: abs(rows[r][c]), default=None)
        if best is None or abs(rows[best][c]) < NEAR:
            free = c
            direction = [0.0] * n
            direction[free] = 1.0
            for row, p in zip(rows, pivots):
                direction[p] = -row[free]
            return direction
        rows[top], rows[best] = rows[best], rows[top]
        lead = rows[top][c]
        rows[top] = [x / lead for x in rows[top]]
        for r in range(len(rows)):
            if r != top and rows[r][c]:
                by = rows[r][c]
                rows[r] = [x - by * y for x, y in zip(rows[r], rows[top])]
        pivots.append(c)
        top += 1
    return None


def flight(probability: list[float], constraints: list[tuple[float, ...]], seed: int) -> list[float]:
    """Move the probabilities until the open ones admit no further balanced step."""
    rng = random.Random(seed)
    p = list(probability)
    waiting = iter([i for i, x in enumerate(p) if NEAR < x < 1 - NEAR])
    active: list[int] = []
    width = len(constraints[0]) + 1 if constraints else 1
    while True:
        while len(active) < width and (i := next(waiting, None)) is not None:
            active.append(i)
        if not active or (u := null_vector([constraints[i] for i in active])) is None:
            break
        up = min((1 - p[i]) / x if x > 0 else -p[i] / x for i, x in zip(active, u) if x)
        down = min(p[i] / x if x > 0 else (p[i] - 1) / x for i, x in zip(active, u) if x)
        step = up if rng.random() * (up + down) < down else -down
        for i, x in zip(active, u):
            p[i] = min(1.0, max(0.0, p[i] + step * x))
        settled_now = [i for i in active if not NEAR < p[i] < 1 - NEAR]
        for i in settled_now:
            p[i] = float(p[i] > 0.5)
        active = [i for i in active if NEAR < p[i] < 1 - NEAR]
    return p


def landing(probability: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the few open units: the large ones one by one towards the expected words of the rest, then the subset of
    the ``TRIED`` smallest that misses the words, then the documents, by least."""
    order = np.argsort(-size, kind="stable")
    out, wanted = np.zeros(len(size)), float(probability @ size)
    rest = wanted
    for i in order[: max(0, len(size) - TRIED)]:
        rest -= probability[i] * size[i]
        if abs(wanted - size[i] - rest) < abs(wanted - rest):
            out[i] = 1.0
            wanted -= size[i]
    few = order[max(0, len(size) - TRIED):]
    subsets = (np.arange(1 << len(few))[:, None] >> np.arange(len(few))) & 1
    words = np.abs(subsets @ size[few] - wanted)
    documents = np.abs(subsets.sum(1) - (probability.sum() - out.sum()))
    out[few] = subsets[np.lexsort((documents, np.round(words, 6)))[0]]
    return out


def _fly(last: bool, holding: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "key", "doc_id"], ignore_index=True)
        source = group["source"].iloc[0]
        seed = zlib.crc32(f"{source}/{group['chunk'].iloc[0]}/{group['chunks'].iloc[0]}".encode())
        p = group["open"].to_numpy(float).copy()
        held = group["held"].to_numpy(bool).copy()
        scale = max(1.0, float(group["size"].mean()))
        size = group["size"].to_numpy(float)
        if holding and group["chunk"].iloc[0] == 0:
            ready = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
            held[ready[np.unique(np.linspace(0, len(ready) - 1, min(HELD, len(ready))).round().astype(int))]] = True
        flying = np.flatnonzero(~held)
        order = flying[np.argsort(group["key"].to_numpy()[flying], kind="stable")]
        p[order] = flight(p[order].tolist(), [(s / scale, 1.0) for s in size[order]], seed)
        if last:
            rest = np.flatnonzero((p > NEAR) & (p < 1 - NEAR))
            p[rest] = landing(p[rest], size[rest])
        return group.assign(open=p, held=held)

    return run


def mix(docs: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``docs``.

    Only id, source and size leave the text scan. A hot source is dealt over as many chunks as its rows need; a chunk
    has about ``chunk_rows`` rows, a later level holds the few open rows of ``chunk_rows / (HELD + 2)`` chunks.
    """
    sized = settled(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            word_count(text_of()).alias("size"), F.xxhash64("doc_id", "text").alias("key"),
        ),
        "sized",
    )
    targets = settled(source_targets(sized), "targets")
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.least(F.floor(times + NEAR), F.lit(int(MOST)))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("n") / chunk_rows))
    rows = (
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("times", whole)
        .withColumn("open", F.greatest(F.lit(0.0), times - whole))
        .withColumn("open", F.when(F.col("open") < NEAR, 0.0).otherwise(F.col("open")))
        .withColumn("chunks", chunks)
        .withColumn("chunk", F.pmod("key", "chunks"))
        .withColumn("held", F.lit(False))
        .select(*(c.split()[0] for c in LAYOUT.split(", ")))
    )
    most = targets.agg(F.max(chunks)).first()[0] or 1
    parts, level = [], 0
    while True:
        last = most <= 1
        by = ["source", "chunk"]
        flown = settled(rows.groupBy(*by).applyInPandas(_fly(last, level == 0), LAYOUT), f"flight{level}")
        still = (F.col("open") > NEAR) & (F.col("open") < 1 - NEAR)
        parts.append(flown if last else flown.where(~still))
        if last:
            break
        together = max(2, chunk_rows // (HELD + 2))
        rows = flown.where(still).withColumn("chunk", F.floor(F.col("chunk") / together)).withColumn(
            "chunks", F.ceil(F.col("chunks") / together))
        most = -(-most // together)
        level += 1
    done = parts[0]
    for part in parts[1:]:
        done = done.unionByName(part)
    return done.select("doc_id", "source", "size", "source_size", "target", taken().alias("taken"))


def taken() -> Column:
    return (F.col("size") * (F.col("times") + F.round("open"))).cast("long")

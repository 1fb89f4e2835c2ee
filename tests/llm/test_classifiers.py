import random
import zlib

import numpy as np
import pandas as pd
import pytest

from hindcast.llm.kneser_ney import BEGIN, END, ORDER, Ratios, measures, ratios, score_toxicity
from hindcast.llm.quality_kernel import STATISTICS, features, fit, kept_by_quality, normal_equations, score_quality, statistics_of

from llm_helpers import DOCS, SF, prose

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def marked(spark):
    """Documents of which a quarter is junk and a fifth holds rude words, with labels for most."""
    rng = random.Random(8)
    rows, truth = [], []
    for i in range(900):
        text = prose(rng, rng.randrange(20, 120))
        good, rude = int(i % 4 != 0), int(i % 5 == 1)
        if not good:
            text = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split())
        if rude:
            words = text.split()
            for _ in range(2 + len(words) // 25):
                words.insert(rng.randrange(len(words)), rng.choice(["zzblurgh", "zzblurghs", "quonkle"]))
            text = " ".join(words)
        rows.append((i, text, "en", "s", 0))
        truth.append((i, good, rude))
    return (spark.createDataFrame(rows, DOCS), spark.createDataFrame([t for t in truth if t[0] % 9], LABELS),
            pd.DataFrame(truth, columns=["doc_id", "quality", "toxic"]))


def test_held_out_accuracy(marked):
    docs, labels, truth = marked
    for score, column, of, out in ((score_quality, "quality", 4, 2), (score_toxicity, "toxic", 5, 0)):
        found = score(docs, labels).toPandas().merge(truth, on="doc_id")
        assert len(found) == 900 and found["score"].between(0, 1).all()
        assert (found["held_out"] == [zlib.crc32(str(i).encode()) % of == out for i in found["doc_id"]]).all()
        held = found[found["held_out"]]
        assert (held["predicted"] == held[column]).mean() > 0.97
        assert (found["predicted"] == (found["score"] >= (0.7 if column == "quality" else 0.5))).all()


def test_labels_of_held_out_rows_change_nothing(spark, marked):
    docs, labels, _ = marked
    turned = labels.toPandas()
    out4, out5 = (turned["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % of == out) for of, out in ((4, 2), (5, 0)))
    turned["quality"] = np.where(out4, 1 - turned["quality"], turned["quality"])
    turned["toxic"] = np.where(out5, 1 - turned["toxic"], turned["toxic"])
    other = spark.createDataFrame(turned, LABELS)
    for score in (score_quality, score_toxicity):
        a, b = (score(docs, x).toPandas().sort_values("doc_id")["score"].to_numpy() for x in (labels, other))
        assert np.allclose(a, b, atol=1e-9)


def test_awkward_rows(spark, awkward, no_docs, labels, marked):
    for score, column in ((score_quality, "quality"), (score_toxicity, "toxic")):
        for told in (labels, labels.where("false"), marked[1], labels.where("doc_id = 1")):
            rows = score(awkward, told).collect()
            assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert score(no_docs, labels).count() == 0
    kept = kept_by_quality(awkward, labels)
    assert kept.columns == awkward.columns and kept_by_quality(no_docs, labels).count() == 0


def test_normal_equations_equal_one_sum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, y double").repartition(5)
    centre, spread = x.mean(0), x.std(0)
    gram, right = normal_equations(rows, centre, spread)
    z = features(x, centre, spread)
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ y)
    # Inner products of the features approximate the Gaussian kernel.
    near = z[:, :-1] @ z[:, :-1].T
    gap = ((x[:, None] - x[None]) / spread) ** 2
    assert np.abs(near - np.exp(-gap.sum(2) / (2 * 4.0**2))).mean() < 0.06


def test_statistics_are_finite():
    for text in ("", " ", "a", "A a a a a a a a a a a a", "x" * 3_000_000, "\n\n", "é💥" * 10):
        assert len(statistics_of(text)) == len(STATISTICS) and np.isfinite(statistics_of(text)).all()


def plain_kneser_ney(table, shared):
    """Interpolated Kneser-Ney by its recursive definition, one probability at a time."""
    def counts(n, c):
        if n == ORDER:
            return dict(zip(table["gram"], table[c]))
        above, out = counts(n + 1, c), {}
        kinds = {g for k in ("n0", "n1") for g, v in counts(n + 1, k).items() if v > 0} if n == shared else {
            g for g, v in above.items() if v > 0}
        for g in kinds:
            out[g[1:]] = out.get(g[1:], 0) + 1
        return out

    orders = {c: {n: counts(n, c) for n in range(1, ORDER + 1)} for c in ("n0", "n1")}
    letters = {g for c in orders for g in orders[c][1]}

    def chance(c, gram):
        if not gram:
            return 1 / len(letters)
        own = orders[c][len(gram)]
        every = sorted({g for k in orders for g in orders[k][len(gram)]})
        values = [own.get(g, 0) for g in every]
        one, two = values.count(1), values.count(2)
        cut = min(0.95, max(0.1, one / max(one + 2 * two, 1)))
        after = [own[g] for g in own if g[:-1] == gram[:-1] and own[g] > 0]
        if not after:
            return chance(c, gram[1:])
        return max(own.get(gram, 0) - cut, 0) / sum(after) + cut * len(after) / sum(after) * chance(c, gram[1:])

    return chance


def test_ratios_equal_the_definition():
    words = {"idiot": (0, 9), "idiots": (0, 2), "hello": (7, 6), "held": (3, 1), "a": (5, 5), "lot": (1, 0)}
    grams: dict = {}
    for w, (a, b) in words.items():
        padded = BEGIN * (ORDER - 1) + w + END
        for i in range(len(w) + 1):
            g = padded[i:i + ORDER]
            grams[g] = tuple(np.add(grams.get(g, (0, 0)), (a, b)))
    table = pd.DataFrame([(g, *n) for g, n in grams.items()], columns=["gram", "n0", "n1"])
    model: Ratios = ratios(table)
    chance = plain_kneser_ney(table, 3)
    for word in (*words, "idiotic", "hell", "zzz", "ot"):
        padded = BEGIN * (ORDER - 1) + word + END
        known = [c for c in padded if c in set("".join(grams))]
        if len(known) < len(padded):
            continue
        expected = sum(
            np.log(chance("n1", padded[i:i + ORDER])) - np.log(chance("n0", padded[i:i + ORDER])) for i in range(len(word) + 1))
        assert model.of([word])[0] == pytest.approx(expected, abs=1e-9), word
    assert model.of([]).shape == (0,) and measures(np.zeros(0)) == (0.0, 0.0, 0.0, 0.0)


def test_queries_on_the_test_tables(spark):
    from hindcast.llm.queries import QUERIES

    truth = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    found = QUERIES["op1_quality"](spark, SF).toPandas().merge(truth, on="doc_id")
    assert (found["predicted"] == found["quality"]).mean() > 0.9

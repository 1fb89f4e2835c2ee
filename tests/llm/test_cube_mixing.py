import random
from collections import defaultdict

import numpy as np
import pytest

from hindcast.llm.cube_mixing import MOST, WEIGHTS, flight, landing, mix, null_vector

from llm_helpers import DOCS


def water_levels(sizes):
    """The rule as told: share by weight, stop at three times the size, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    whole, open_, target = float(sum(sizes.values())), set(order), {}
    while open_:
        spare = whole - sum(target.values())
        over = {s for s in open_ if spare * weight[s] / sum(weight[o] for o in open_) > MOST * sizes[s]}
        if not over:
            target |= {s: spare * weight[s] / sum(weight[o] for o in open_) for s in open_}
            break
        target |= {s: MOST * sizes[s] for s in over}
        open_ -= over
    return target


def test_mix_reaches_targets_and_reruns_agree(spark):
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        source = rng.choice(["a", "b", "c", "d", "e", None, "é", "hot", "hot", "hot", "hot"])
        rows.append((i, "w " * int(rng.paretovariate(1.2) * 20 % 4000), "en", source, 0))
    rows += [(3001, "w " * 7, "en", "tiny", 0), (3002, "", "en", "zero", 0), (3003, None, "en", "zero", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = [r.asDict() for r in mix(docs, chunk_rows=200).join(docs.select("doc_id", "source"), "doc_id").collect()]
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0)
    target = water_levels(sizes)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
    for s in sizes:
        assert taken[s] == pytest.approx(target[s], rel=0.01, abs=25)
    again = {r["doc_id"]: r["taken"] for r in mix(docs.repartition(7), chunk_rows=200).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in out}


def test_flight_keeps_totals():
    rng = random.Random(3)
    size = [float(rng.randrange(1, 500)) for _ in range(400)]
    p = [0.3] * 400
    out = np.array(flight(p, [(s, 1.0) for s in size], 5))
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out @ size == pytest.approx(np.dot(p, size)) and out.sum() == pytest.approx(120)
    done = landing(np.array([0.5, 0.2, 0.7]), np.array([10.0, 3.0, 5.0]))
    assert set(done) <= {0.0, 1.0} and abs(done @ [10, 3, 5] - 9.1) < 2


def test_null_vector():
    u = null_vector([(5.0, 1.0), (5.0, 1.0)])
    assert u[0] + u[1] == pytest.approx(0) and any(u)
    assert null_vector([(5.0, 1.0), (6.0, 1.0)]) is None


def test_awkward_rows(awkward, no_docs):
    rows = mix(awkward).collect()
    assert len(rows) == awkward.count() and all(r["taken"] <= 3 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (2, 3, 4)} == {0}
    assert mix(no_docs).count() == 0

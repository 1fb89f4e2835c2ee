import random
from itertools import combinations

import numpy as np
import pytest

from hindcast.llm.components import components
from hindcast.llm.order_minhash import LEAST, edits_within, keys_of, near_classes, near_links, one_per_class, sketch, words_of

from llm_helpers import DOCS, prose


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        kind = rng.random()
        if kind < 0.4 and at < len(words):
            words[at] = f"new{rng.random()}"
        elif kind < 0.7 and at < len(words):
            del words[at]
        else:
            words.insert(at, f"new{rng.random()}")
    return words


@pytest.mark.parametrize("seed", range(6))
def test_banded_alignment_counts_edits_exactly(seed):
    rng = random.Random(seed)
    for _ in range(150):
        a = [rng.randrange(rng.choice([3, 40])) for _ in range(rng.randrange(50))]
        b = [rng.randrange(40) if rng.random() < 0.1 else x for x in a if rng.random() < 0.9] + [7] * rng.randrange(3)
        true = table_distance(a, b)
        for most in (0, 2, 9, 60):
            found = edits_within(np.array(a, np.uint32), np.array(b, np.uint32), most)
            assert found == (true if true <= most else None)


def test_sketch_depends_on_order():
    words = np.random.default_rng(0).integers(0, 1 << 62, 200).astype(np.uint64)
    same = (sketch(words) == sketch(words.copy())).mean()
    turned = (sketch(words) == sketch(np.r_[words[100:], words[:100]])).mean()
    assert same == 1 and 0.2 < turned < 0.8


def test_classes_equal_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(25):
        base = prose(rng, rng.randrange(30, 120)).split()
        texts += [" ".join(edited(rng, base, e)) for e in (0, 0, 1, 3, len(base) // 12)]
    passage = prose(rng, 25)
    texts += [f"{prose(rng, 40)}\n{passage}" for _ in range(40)]
    hot = prose(rng, 60).split()
    texts += [" ".join(edited(rng, hot, 2)) for _ in range(60)]
    rng.shuffle(texts)
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCS)
    words = [words_of(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        longer = max(len(words[i]), len(words[j]))
        if table_like(words[i], words[j]) and 1 - table_distance(words[i], words[j]) / longer >= LEAST:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    found = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert found == {i: root(i) for i in range(len(texts))}
    left = {r["doc_id"] for r in one_per_class(docs).collect()}
    assert left == {root(i) for i in range(len(texts))}


def table_like(a, b):
    """A cheap necessary condition, so that the quadratic table runs on few pairs."""
    return len(set(a) & set(b)) >= 0.4 * max(len(set(a)), len(set(b)))


def test_pairs_are_not_all_pairs(spark):
    rng = random.Random(9)
    hot = prose(rng, 80).split()
    docs = spark.createDataFrame(
        [(i, " ".join(edited(rng, hot, 1)), "en", "s", 1) for i in range(300)], DOCS)
    membership, classes, links = near_links(docs)
    assert links.count() < 300 * 24
    assert near_classes(docs).select("class_id").distinct().count() == 1


def test_awkward_rows(awkward, no_docs):
    rows = near_classes(awkward).collect()
    assert len(rows) == awkward.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["class_id"] == by_id[3]["class_id"] == by_id[4]["class_id"] == 2
    assert by_id[None]["class_id"] is None and by_id[None]["copy_of"] is None
    assert by_id[5]["class_id"] == 5 and by_id[1]["copy_of"] == 1
    kept = one_per_class(awkward)
    assert sorted(kept.columns) == sorted(awkward.columns)
    assert {3, 4}.isdisjoint(r["doc_id"] for r in kept.collect())
    assert near_classes(no_docs).count() == 0 and one_per_class(no_docs).count() == 0


def test_rows_without_an_id_and_under_one_id(spark):
    rng = random.Random(21)
    one, two, three, four = (prose(rng, 60).split() for _ in range(4))
    texts = [
        (1, one), (None, edited(rng, one, 3)), (None, two), (None, edited(rng, two, 3)), (3, three), (7, edited(rng, three, 2)),
        (7, four), (5, prose(rng, 50).split()),
    ]
    texts.append(texts[-1])
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", k) for k, (i, t) in enumerate(texts)], DOCS)
    found = sorted(((r["doc_id"], r["class_id"]) for r in near_classes(docs).collect()), key=str)
    assert found == sorted([(1, 1), (None, 1), (None, None), (None, None), (3, 3), (7, 3), (7, 7), (5, 5), (5, 5)], key=str)
    kept = sorted(((r["doc_id"], r["text"]) for r in one_per_class(docs).collect()), key=str)
    assert [i for i, _ in kept] == [1, 3, 5, 7, None]
    assert dict(kept)[7] == " ".join(four) and dict(kept)[1] == " ".join(one)


def test_links_of_a_large_group_are_few(spark):
    rng = random.Random(22)
    hot = prose(rng, 60).split()
    docs = spark.createDataFrame([(i, " ".join(edited(rng, hot, 1)), "en", "s", 1) for i in range(500)], DOCS)
    membership, classes, links = near_links(docs)
    assert links.count() < 2 * membership.select("node").distinct().count()
    assert classes.select("class").distinct().count() == 1


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)] + [(100, 101), (7, 7), (None, 3)]
    found = {r["node"]: r["class"] for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[100 + i] for i in range(50)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def replaced(rng, words, at):
    """The words with those places taken by words of their own."""
    return [f"own{rng.randrange(10**12)}" if i in at else w for i, w in enumerate(words)]


def test_variants_of_a_base_stay_with_it(spark):
    # Every variant is a link of the base, few variants are links of each other, and pivots are variants.
    rng = random.Random(12)
    base = prose(rng, 100).split()
    runs = [{x + k for x in rng.sample(range(0, 100, 6), 2) for k in range(6)} for _ in range(60)]
    texts = [" ".join(replaced(rng, base, run)) for run in runs] + [" ".join(base)]
    texts += [" ".join(replaced(rng, base, set(range(50, 100)))) for _ in range(20)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    found = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert {found[i] for i in range(61)} == {0}
    assert all(found[i] == i for i in range(61, 81))


@pytest.mark.parametrize("n", [5, 6, 8, 9, 10, 13, 14])
def test_short_links_are_always_candidates(n):
    rng = random.Random(n)
    for _ in range(300):
        a = [rng.randrange(30) for _ in range(n)]
        b = edited(rng, a, rng.randrange(1, 3))
        b = [x if isinstance(x, int) else 1000 + rng.randrange(30) for x in b]
        longer = max(len(a), len(b))
        if longer <= 14 and 1 - table_distance(a, b) / longer >= LEAST:
            assert np.intersect1d(keys_of(np.array(a, np.uint64)), keys_of(np.array(b, np.uint64))).size


@pytest.mark.parametrize("n", [15, 20, 40, 64, 65, 100, 400])
def test_links_at_the_threshold_are_candidates(n):
    rng = random.Random(n)
    found = 0
    for _ in range(200):
        a = np.array([rng.getrandbits(62) for _ in range(n)], np.uint64)
        b = a.copy()
        b[rng.sample(range(n), n // 5)] += np.uint64(1)
        found += bool(np.intersect1d(keys_of(a), keys_of(b)).size)
    print(n, found)
    assert found >= 190


def test_links_do_not_depend_on_the_crowd(spark, monkeypatch):
    # All texts share a passage; the links among them differ in scattered words of the rest. Blocks are small here.
    monkeypatch.setattr("hindcast.llm.order_minhash.BLOCK_ROWS", 40, raising=False)
    rng = random.Random(15)
    passage = prose(rng, 40).split()
    texts = []
    for _ in range(30):
        base = [f"own{rng.randrange(10**12)}" for _ in range(40)]
        texts += [" ".join(passage + base), " ".join(passage + replaced(rng, base, set(rng.sample(range(40), 13))))]
    texts += [" ".join(passage + [f"own{rng.randrange(10**12)}" for _ in range(40)]) for _ in range(240)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    found = {r["doc_id"]: r["class_id"] for r in near_classes(docs).collect()}
    assert found == {i: i - i % 2 if i < 60 else i for i in range(300)}

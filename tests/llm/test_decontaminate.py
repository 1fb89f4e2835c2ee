import random
from collections import defaultdict

from hindcast.llm import decontaminate
from hindcast.llm.decontaminate import Index, covered, find_leaks, question_and_answer, without_leaks

from llm_helpers import DOCS, prose

ITEMS = "item_id long, text string, doc_id int"


def test_search_equals_exhaustive_scores():
    rng = random.Random(6)
    index = Index([(i, prose(rng, rng.randrange(6, 150), 300)) for i in range(120)])
    for _ in range(300):
        piece = rng.randrange(index.end)
        terms = {t for t in range(len(index.ids)) if piece in index.ids[t] and rng.random() < 0.8}
        terms |= set(rng.sample(range(len(index.ids)), 20))
        scores: dict = defaultdict(float)
        for t in terms:
            for p, s in zip(index.ids[t], index.scores[t]):
                scores[p] += s
        for reach in (0.15, 0.4, 0.7):
            found = dict(index.search(sorted(terms), reach))
            assert set(found) == {p for p, s in scores.items() if s >= reach - 1e-12}
            assert all(abs(found[p] - scores[p]) < 1e-9 for p in found)


def test_finds_planted_items_and_only_those(spark, awkward, no_docs, monkeypatch):
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randrange(12, 160)) + "\n" + prose(rng, 6), 0) for i in range(60)]
    items += [(60, items[0][1], 0), (61, None, 0), (62, "the", 0), (None, prose(rng, 30), 0)]
    rows, planted = [], set()
    for d in range(400):
        words = prose(rng, rng.randrange(0, 400)).split()
        if d % 5 == 0:
            i = rng.randrange(1, 60)
            at = rng.randrange(len(words) + 1)
            words[at:at] = items[i][1].upper().split()
            planted.add((d, i))
        rows.append((d, " ".join(words), "en", "s", 0))
    rows += [(400, items[0][1], "en", "s", 0), (401, items[5][1].split("\n")[0], "en", "s", 0), (402, "long " * 50_000 + items[7][1], "en", "s", 0)]
    planted |= {(400, 0), (400, 60), (402, 7)}
    docs, table = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    found = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, table).collect()}
    assert planted <= found and found - planted <= {(401, 5)}
    left = {r["doc_id"] for r in without_leaks(docs, table).collect()}
    assert left == {r[0] for r in rows} - {d for d, _ in found}
    # A benchmark larger than one index takes several passes with the same result.
    monkeypatch.setattr(decontaminate, "ITEMS", 20)
    assert {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, table).collect()} == found
    assert find_leaks(awkward, table).count() == 0
    assert without_leaks(awkward, table).count() == awkward.count()
    assert find_leaks(no_docs, table).count() == 0 and find_leaks(docs, table.where("false")).count() == 0


def test_question_and_answer():
    assert question_and_answer("What is it?\nAnswer: A cat") == (["what", "is", "it"], ["a", "cat"])
    assert question_and_answer("One line. Two words.") == (["one", "line"], ["two", "words"])
    assert question_and_answer("alone") == (["alone"], ["alone"]) and question_and_answer("") == ([], [])
    assert covered("a b c d e f".split(), "x a b c d e y".split()) == 5 / 6 and covered([], ["x"]) == 0.0

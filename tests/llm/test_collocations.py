import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm import collocations as c
from hindcast.llm.collocations import Automaton, collocations, floored_score, numbered_words, shard_rows
from llm_helpers import DOCS, prose


def brute(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for row in rows:
        lang, text = row["lang"] or "und", row["text"] or ""
        if row["lang"] == "":
            lang = ""
        text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text)
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, of in counts.items():
        many = {p: a for p, a in of.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in many.items():
            if any(len(q) > len(p) and many[q] >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q in many):
                continue
            score, k = min((1000 * a * totals[lang] // (of[p[:k]] * of[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), of[p[:k]], of[p[k:]]))
        for rank, (score, a, phrase, left, rest) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, rest, totals[lang], -score))
    return sorted(out)


def found(docs, **how):
    return sorted(tuple(r) for r in collocations(docs, **how).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least, top, partitions", [(3, 2000, 1), (2, 7, 5)])
def test_equals_brute_force(spark, monkeypatch, least, top, partitions):
    monkeypatch.setattr(c, "RANGE_CHARS", 3000)
    rng = random.Random(least)
    texts = []
    for i in range(150):
        words = [rng.choice("the a of New york YORK é 💥 \x85 x\x00 to be or not".split(" ")) for _ in range(rng.randrange(60))]
        texts.append("".join(w + rng.choice([" ", "  ", "\t", ". ", "\n", ",", " "]) for w in words))
    texts += ["of the people by the people for the people"] * 9 + ["hot pair " * 300, "x", "...", " ", "", None]
    rows = [(i, t, rng.choice(["en", "de", None, "und", ""]), "s", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(partitions)
    assert found(docs, least=least, top=top) == brute(docs.collect(), least, top)


def test_automata_survive_their_rows_and_unite():
    rng = random.Random(2)
    lots = [[prose(rng, 40, 12).encode() for _ in range(8)] for _ in range(4)]

    def read(rows):
        return {(r["depth"], r["range"]): Automaton.of_row(type("Row", (), r)) for r in rows}

    every = np.full(1 << (c.PAIR_BITS - 3), 255, np.uint8)
    parts = [read(shard_rows("en", lot, 3) + shard_rows("en", lot, 3, every)) for lot in lots]
    whole = read(shard_rows("en", sum(lots, []), 3) + shard_rows("en", sum(lots, []), 3, every))
    for key, want in whole.items():
        got = Automaton.united([p[key] for p in parts if key in p])
        def named(a):
            return {tuple(a.words[i] for i in w if i >= 0): n for w, n in zip(a.windows, a.weights)}
        assert named(got) == named(want)
        assert [tuple(w) for w in got.windows] == sorted(tuple(w) for w in got.windows)
        counts = got.counts(2, key[0])
        runs = [list(p) for p in named(counts)]
        strangers = [p[:counts.windows.shape[1]] for p in ([b"no such"], [b"no", b"such"], runs[0][:-1] + [b"x"])]
        assert counts.composed(runs + strangers).tolist() == [*named(counts).values(), 0, 0, 0]


def test_states_are_shared():
    words, ids, _ = numbered_words([b"a b c d e. a b c d f. a b c"])
    assert words == [b"a", b"b", b"c", b"d", b"e", b"f"]
    windows = np.array([[0, 1, 2, 3, 4], [0, 1, 2, 3, 5]], np.int32)
    row = Automaton(words, windows, np.array([1, 1])).row()
    assert list(row["shared"]) == [0, 4] and len(row["labels"]) == 1 + 6


def test_scores_past_64_bits(spark):
    rng = random.Random(4)
    rows = [(a, rng.randrange(a, 10**16), rng.randrange(a, 10**13), rng.randrange(a, 10**13)) for a in (100, 10**9, 10**12, 9 * 10**12)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").withColumn(
        "s", floored_score(*[F.col(x) for x in "anlr"])).collect()
    assert all(r["s"] == 1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in got)


def test_awkward_rows(awkward, no_docs):
    assert found(awkward, least=2, top=50) == brute(awkward.collect(), 2, 50)
    assert found(no_docs) == []

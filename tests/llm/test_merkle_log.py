import random
import zlib
from hashlib import sha256

import pytest

from hindcast.llm.merkle_log import built, fold, log, manifest, place, siblings, verify
from llm_helpers import DOCS, prose


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes, fan=16):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + fan]) for i in range(0, len(out[-1]), fan)])
    return out


def path(tree, i, fan=16):
    out = []
    for row in tree[:-1]:
        run = row[i // fan * fan:i // fan * fan + fan]
        out.append(("".join(run[:i % fan]), "".join(run[i % fan + 1:])))
        i //= fan
    return out


def brute(rows):
    by_source = {}
    for row in rows:
        text = row["text"]
        tampered = text
        if row["doc_id"] is not None and text is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
            tampered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        key = (row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, text), leaf(row, tampered))
        by_source.setdefault((row["source"] is not None, (row["source"] or "").encode()), []).append((key, row["doc_id"]))
    trees = {s: levels([k[2] for k, _ in sorted(rows)]) for s, rows in by_source.items()}
    top = levels([trees[s][-1][0] for s in sorted(trees)])
    out = []
    for j, s in enumerate(sorted(trees)):
        for i, (key, doc_id) in enumerate(sorted(by_source[s])):
            steps = path(trees[s], i) + path(top, j)
            folded = fold(key[3], steps)
            out.append((doc_id, key[2], trees[s][-1][0], top[-1][0], h(*[b + a for b, a in steps]), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def found(docs, **how):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in verify(docs, **how).select(columns).collect()), key=str)


@pytest.mark.parametrize("height", [1, 3])
def test_equals_brute_force(spark, height):
    # Builders of one level make several tiers of the same rows.
    rng = random.Random(height)
    sizes = {None: 3, "": 1, "a": 700, "é": 16, "z": 17, "b": 256, **{f"s{i}": rng.randrange(1, 4) for i in range(30)}}
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((rng.choice([None, rng.randrange(2**62)]) if n < 9 else len(rows), rng.choice([None, prose(rng, 4), "", "É"]), None, source, 3))
    rows += rows[:5]
    docs = spark.createDataFrame(rows, DOCS)
    assert found(docs, height=height) == brute(docs.collect())


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257, 300])
def test_log_is_in_completion_order(spark, n):
    order = []

    def visit(level, i):
        if level:
            for child in range(i * 16, min(i * 16 + 16, -(-n // 16 ** (level - 1)))):
                visit(level - 1, child)
        order.append((level, i))

    height = 0
    while 16 ** height < n:
        height += 1
    visit(height, 0)
    assert [int(place(level, i, n)) for level, i in order] == list(range(len(order)))
    leaves = spark.createDataFrame([("t", i, h(str(i)), n) for i in range(n)], "tree string, rank long, leaf string, leaves long")
    segments, roots = built(leaves)
    written = {r["place"]: (r["level"], r["node"]) for r in log(segments).collect()}
    tree = levels([h(str(i)) for i in range(n)])
    assert written == {p: (level, tree[level][i]) for p, (level, i) in enumerate(order)}
    assert roots.first()["leaf"] == tree[-1][0]
    number = n // 2
    steps = [("".join(written[p][1] for p in before), "".join(written[p][1] for p in after)) for _, before, after in siblings(0, number, n)]
    assert fold(tree[0][number], steps) == tree[-1][0]


def test_awkward_rows(awkward, no_docs):
    assert found(awkward) == brute(awkward.collect())
    assert found(no_docs) == []
    assert all(f.count() == 0 for f in manifest(no_docs))

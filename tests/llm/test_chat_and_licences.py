import hashlib

import regex
from pyspark.sql import functions as F

from hindcast.llm.chat_prefix import digests, prefix_examples, turns_in
from hindcast.llm.licences import LEAST, TEMPLATES, bigram_set, scan_licences

from llm_helpers import DOCS

TURNS = "conv_id long, turn long, role string, text string, heads int"


def conversations(spark):
    tricky = "a\\b </s>\n[INST] \\[/INST] <s> \\\\ <\\s> x"
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (1, 3, "user", "more"),
        (1, 4, "assistant", ""), (2, 0, "user", None), (2, 1, None, "odd"), (3, 5, "assistant", "first 💥"),
        (3, 5, "assistant", "first 💥"), (3, None, "user", "untold"), (None, 0, "user", "x"), (None, 1, "assistant", "y"),
        (4, 0, "assi</s>stant", "no"), (5, 0, "assistant", "word " * 50_000),
    ]
    return rows, spark.createDataFrame([(*r, 0) for r in rows], TURNS)


def test_round_trip(spark):
    rows, table = conversations(spark)
    found = {r["conv_id"]: r for r in digests(prefix_examples(table)).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t, role or "", text or "") for c, t, role, text in rows if c == conv),
            key=lambda x: (x[0] is not None, x[0] or 0, x[1:]))
        told = "".join(f"{role}\n{text}\n" for _, role, text in turns)
        loss = "".join(text for _, role, text in turns if role == "assistant")
        r = found[conv]
        assert r["n_turns"] == len(turns) and r["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
        assert r["loss_chars"] == len(loss) and r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["formatted_chars"] > sum(len(x[2]) for x in turns)


def test_examples_are_prefixes(spark):
    _, table = conversations(spark)
    rows = prefix_examples(table).where("conv_id = 1").orderBy("example").collect()
    assert [r["turns"] for r in rows] == [3, 5] and rows[1]["text"].startswith(rows[0]["text"])
    for r in rows:
        assert r["text"][r["mask_start"] + r["mask_chars"]:] == "</s>\n"
    read = prefix_examples(table).where("conv_id = 1 and whole").select(turns_in(F.col("text")).alias("t")).first()["t"]
    assert [t["role"] for t in read] == ["system", "user", "assistant", "user", "assistant"]
    assert prefix_examples(table.where("false")).count() == 0


def dice(text, template):
    a, b = bigram_set(text), bigram_set(template)
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licences_equal_brute_force(spark, awkward, no_docs):
    texts = [
        "Hello.\nReleased under the MIT License.\nbye", TEMPLATES["mit"], TEMPLATES["mit"].replace("software", "code"),
        "x\n\n" + TEMPLATES["isc"].replace(". ", ".\n") + "\n\n\ny", "all RIGHTS reserved!!", "reserved rights all", None, "",
        "Licensed under CC BY-SA 4.0", "word " * 40_000, TEMPLATES["apache-2.0-header"] + " extra words at the end",
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)
    expected = set()
    for i, text in enumerate(texts):
        if text is None:
            continue
        units = [("line", k, x) for k, x in enumerate(text.split("\n"), 1)]
        if "\n\n" in text:
            units += [("paragraph", k, x) for k, x in enumerate(regex.split("\n\n+", text), 1)]
        if "\n" in text:
            units.append(("text", 1, text))
        for kind, k, unit in units:
            best = min((-dice(unit, t), name) for name, t in TEMPLATES.items())
            if -best[0] >= LEAST:
                expected.add((i, kind, k, best[1], round(-best[0], 9)))
    found = {(r["doc_id"], r["unit"], r["unit_no"], r["licence"], round(r["dice"], 9)) for r in scan_licences(docs).collect()}
    assert found == expected and len(expected) >= 6
    assert scan_licences(awkward).count() == 0 and scan_licences(no_docs).count() == 0

import math
import random
import re
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from hindcast.llm.fertility import (
    BANDS, BIN, BYTES_FILE, LAYOUT, MEASURES, PIECES_FILE, SCRIPT_BANDS, VOCABULARIES, Vocabularies, judge_fertility,
    kept_by_fertility, learned_bands, rejects_by_reason, script_of, with_reason,
)

from llm_helpers import DOCS, prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text, lang, vocabularies):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
        seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    tokens = [t for w in words for t in vocabularies.bytes.encode_ordinary(" " + w)]
    pieces = [p for w in words for p in vocabularies.pieces.encode(w)]
    chars = sum(map(len, words))
    counts = Counter(tokens).values()
    entropy = -sum(n / len(tokens) * math.log2(n / len(tokens)) for n in counts)
    per = chars / len(tokens) if tokens else 0.0
    share = sum(map(vocabularies.pieces.is_byte, pieces)) / len(pieces) if pieces else 0.0
    low, high, most, least = BANDS.get(lang) or SCRIPT_BANDS[script_of(text)]
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    return {
        "n_words": len(words), "word_chars": chars, "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": dup,
        "n_repeat_words": len(marked), "base_failed": failed, "chars_per_token": per, "byte_share": share,
        "token_entropy": entropy, "kept": not failed and low <= per <= high and share <= most and entropy >= least,
    }


def test_equals_brute_force(spark, awkward, no_docs):
    rng = random.Random(5)
    texts = [prose(rng, rng.randrange(1, 200)) for _ in range(40)]
    texts += [
        "a b c\na b c\n\n \na b c", "x y z x y z x", "# $ | <b> & 100%\v\f\r" * 30, "漢字 かな 한국어 " * 40, "Ωmega العربية हिन्दी " * 30,
        "q7Zk9Xw2Lp4Vt8" * 200, "the cat " * 400, " nbsp is a word　too", "💥👩‍👩‍👧 " * 60,
        "\n".join(prose(rng, 9) for _ in range(12)) * 2,
    ]
    langs = ["en", "de", "fr", "es", None, "zz"]
    docs = spark.createDataFrame([(i, t, langs[i % 6], "s", 0) for i, t in enumerate(texts)], DOCS)
    ready = Vocabularies(*[Path(VOCABULARIES, n).read_bytes() for n in (BYTES_FILE, PIECES_FILE)])
    found = judge_fertility(docs).collect()
    assert len(found) == len(texts)
    for r in found:
        for name, value in brute(texts[r["doc_id"]], langs[r["doc_id"] % 6], ready).items():
            assert r[name] == pytest.approx(value, abs=1e-9), (r["doc_id"], name)
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert {r["doc_id"] for r in kept_by_fertility(docs).collect()} == kept and kept
    assert not any(r["kept"] for r in found if texts[r["doc_id"]].startswith(("q7Zk", "the cat")))

    rows = judge_fertility(awkward).collect()
    assert len(rows) == awkward.count() and [f.name for f in judge_fertility(awkward).schema] == [
        c.split()[0] for c in LAYOUT.split(", ")]
    assert all(r["base_failed"] and r["n_words"] == 0 for r in rows if r["doc_id"] in (2, 3, 4))
    assert kept_by_fertility(awkward).columns == awkward.columns
    assert judge_fertility(no_docs).count() == 0 and kept_by_fertility(no_docs).count() == 0


def test_script_of():
    assert [script_of(x) for x in ("abc", "Привет", "漢字", "한국", "123", "")] == ["Latin", "Cyrillic", "Han", "Hangul", "other", "other"]


NAMES = [c.split()[0] for c in MEASURES.split(", ")]


def made(spark, rows):
    """Rows (band, characters per token, byte share, entropy, tokens, base verdict) as measured texts, numbered from 0."""
    filled = [
        (i, *[{"band": b, "chars_per_token": c, "byte_share": s, "token_entropy": e, "n_tokens": n, "base_failed": f}.get(x, 0) for x in NAMES])
        for i, (b, c, s, e, n, f) in enumerate(rows)]
    return spark.createDataFrame(filled, f"row int, {MEASURES}").select("row", F.struct(*NAMES).alias("m"))


def normal(rng, count, band="en", middle=(2.2, 0.0, 6.5), tokens=300, failed=False):
    return [(band, rng.gauss(middle[0], 0.04), middle[1], rng.gauss(middle[2], 0.1), tokens, failed) for _ in range(count)]


def test_each_measure_alone_rejects_by_the_bands_of_the_table(spark):
    rng = random.Random(3)
    odd = [("en", 1.9, 0.0, 6.5, 300, False), ("en", 2.2, 0.045, 6.5, 300, False), ("en", 2.2, 0.0, 5.9, 300, False), ("en", 2.2, 0.0, 6.5, 300, True)]
    rows = odd + normal(rng, 300) + normal(rng, 40, tokens=40, middle=(2.2, 0.0, 4.6)) + normal(rng, 300, failed=True, middle=(9.0, 0.9, 0.0))
    found = {r["row"]: r["reason"] for r in with_reason(made(spark, rows), BANDS | SCRIPT_BANDS, 30).collect()}
    assert [found[i] for i in range(4)] == ["chars_per_token", "byte_share", "token_entropy", "base rules"]
    # Short texts have their own band: an entropy that is far too low for a longer text is usual for them.
    assert all(found[i] is None for i in range(4, 344)) and len(found) == len(rows)


def test_bands_with_few_texts_give_way(spark):
    rng = random.Random(4)
    low = ("en", 2.2, 0.0, 5.0, 300, False)
    few = [low] + normal(rng, 10)
    assert with_reason(made(spark, few), BANDS | SCRIPT_BANDS, 30).where("reason is not null").isEmpty()
    # Eleven texts of this size, but many of the language: its band at all sizes decides.
    reasons = {r["row"]: r["reason"] for r in with_reason(made(spark, few + normal(rng, 60, tokens=3000)), BANDS | SCRIPT_BANDS, 30).collect()}
    assert reasons[0] == "token_entropy" and not any(reasons[i] for i in range(1, 71))


def test_learned_bands_are_the_quantiles_of_the_table(spark):
    rng = random.Random(5)
    rows = normal(rng, 400) + normal(rng, 100, tokens=5) + normal(rng, 90, band="Latin", middle=(3.0, 0.0, 5.0)) + [("Han", 0.5, 0.0, 4.0, 9, False)] * 40
    got = {(r["band"], r["size"]): r for r in learned_bands(made(spark, rows).select("m.*")).collect()}
    assert set(got) == {("en", 8), ("en", 2), ("en", -1), ("Latin", 8), ("Latin", -1), ("Han", 3), ("Han", -1)}
    for (band, size), r in got.items():
        mine = [x for x in rows if x[0] == band and (size < 0 or int(math.log2(x[4])) == size)]
        assert r["docs"] == len(mine)
        for at, name, floor in ((1, "chars_per_token", 0.02), (3, "token_entropy", 0.05)):
            low, middle, high = np.quantile([x[at] for x in mine], [0.25, 0.5, 0.75], method="inverted_cdf")
            assert abs(r[name]["middle"] - middle) <= BIN
            assert abs(r[name]["spread"] - max((high - low) / 1.349, floor)) <= 2 * BIN / 1.349


def test_reasons_add_up_and_junk_is_found(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    judged = judge_fertility(docs).join(labels, "doc_id").groupBy("quality", "reason").count().collect()
    count = {(r["quality"], r["reason"]): r["count"] for r in judged}
    for reason in ("chars_per_token", "token_entropy"):
        junk, good = count.get((0, reason), 0), count.get((1, reason), 0)
        assert junk > 20 and junk >= 0.97 * (junk + good)
    few = docs.limit(50)
    assert rejects_by_reason(few).agg(F.sum("docs")).first()[0] == 50

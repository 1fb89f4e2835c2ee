import random

import pytest
import sentencepiece

from hindcast.llm.token_counts import OVERLAP, VOCABULARY, Vocabulary, count_tokens, model_bytes
from llm_helpers import DOCS, prose

LIBRARY = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)


def counted(docs, **how):
    return sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in count_tokens(docs, **how).collect())


def expected(texts):
    return [(i, len(t.encode()), len(LIBRARY.encode(t)), len(LIBRARY.encode(t)) > 4096) for i, t in enumerate(texts)]


def kinds(rng):
    """Texts that are hard to cut: runs of one character, no blanks, unknown characters, blanks only, own markers."""
    yield from ("a" * 3000, " " * 900, "=" * 700 + prose(rng, 60) + "=" * 900, "漢" * 300, "\n\t " * 200, "\ue000" * 150, "▁▁x" * 200)
    for alphabet in ("ab", "ab \n", "aé漢💥 ", "<s></unk> ", "0123456789", "\x00a \x85"):
        yield "".join(rng.choice(alphabet) for _ in range(rng.randrange(300, 1500)))
    yield from (prose(rng, n) for n in (1, 30, 300))


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (50, 12)])
def test_spliced_counts_equal_the_library(spark, chunk, overlap):
    texts = list(kinds(random.Random(chunk)))
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS)
    assert counted(docs, chunk=chunk, overlap=overlap) == expected(texts)


def test_long_texts_at_full_size(spark):
    rng = random.Random(3)
    texts = [prose(rng, 40_000), prose(rng, 9_000) + "~" * 70_000 + prose(rng, 9_000), prose(rng, 10)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + texts)], DOCS)
    assert counted(docs) == expected(texts + texts)


def test_chunks_led_by_a_stranger_are_not_joined_to_it():
    known = Vocabulary(model_bytes(VOCABULARY))
    for text in ("hello world", " hello", "▁x", "漢x", "\x00"):
        ids = known.inner(text)
        assert known.chars[ids].sum() == len(text)
        assert LIBRARY.decode(ids.tolist()).strip() == text.strip().replace("▁", "").strip() or "漢" in text or "▁" in text
    assert OVERLAP > 0


def test_awkward_rows(awkward, no_docs):
    rows = count_tokens(awkward).collect()
    assert len(rows) == awkward.count()
    assert {(r["n_bytes"], r["n_tokens"]) for r in rows if r["doc_id"] in (2, 3)} == {(0, 0)}
    assert len({tuple(r) for r in rows if r["doc_id"] == 1}) == 1 and sum(r["doc_id"] == 1 for r in rows) == 3
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in rows)
    assert count_tokens(no_docs).count() == 0

"""Token counts of documents of any length by overlap resynchronisation.

A text of up to ``chunk`` characters is encoded at once. A longer one is cut into chunks that overlap, each chunk is
encoded in a task of its own, and the encodings are spliced inside the overlaps at a token that both hold at the same
place. Such a splice is proven: merges of a byte-pair encoding happen in one order, so a row of tokens is the encoding
of its text exactly if every two neighbours are the encoding of theirs. Left of the common token and with it, all
neighbours come from the left chunk, right of it all come from the right one. A character the vocabulary lacks is one
unit, however many byte tokens it becomes. Texts with an overlap that holds no common token (a long run of one
character, cut in two phases) are cut again with wider overlaps, until the whole text is one chunk if need be.

The vocabulary puts a blank before a text; chunks after the first are led by a character that no piece holds, so that
nothing is joined to it, and its tokens are dropped.

Defined results: null text counts as empty and has no tokens; a null or repeated id gives one row per row; equal texts
have equal counts and long ones are encoded once; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import settled, small_batches, text_of

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
MOST_BYTES = 64 << 20  # of a vocabulary file, which every worker holds
LIMIT = 4096
CHUNK = 65_536  # characters that a chunk has to itself
OVERLAP = 512  # characters it shares with the next one at first
WIDER = 8
# A private-use character that no piece holds, and the first byte of two, three and four that are one character.
APART = "\ue000"
LEAD = (0xC0, 0xE0, 0xF0)


class Vocabulary:
    """The library's encoder with the characters and byte tokens behind each id."""

    def __init__(self, model: bytes):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        byte = np.array([int(p[1:-1], 16) if self.library.is_byte(i) else -1 for i, p in enumerate(pieces)])
        follows = (byte >= 0x80) & (byte < LEAD[0])
        # Characters that start with the token, and tokens the unit that starts with it has; a following byte starts none.
        self.chars = np.where(follows, 0, np.where(byte >= 0, 1, [len(p) for p in pieces]))
        self.units = np.where(follows, 0, 1 + sum((byte >= lead).astype(int) for lead in LEAD))
        self.prefix = self.library.encode(APART)
        if any(APART in p for p in pieces) or not np.all(byte[self.prefix[1:]] >= 0):
            raise ValueError("the vocabulary holds the character that keeps chunks apart")

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]

    def inner(self, text: str) -> np.ndarray:
        """Ids of a text that has more before it."""
        return np.array(self.library.encode(APART + text)[len(self.prefix):], np.int64)


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Vocabulary:
    """One per worker process, whatever the number of tasks."""
    return Vocabulary(model)


def model_bytes(path: str) -> bytes:
    model = Path(path).read_bytes()
    if len(model) > MOST_BYTES:
        raise ValueError(f"{path} has more than {MOST_BYTES} bytes")
    return model


def cut(chunk: int, overlap: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """digest, number, start, own end, whether it is the last, and text of every chunk, one at a time."""
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for digest, text in zip(batch["digest"], batch["text"]):
                for no, start in enumerate(range(0, len(text), chunk)):
                    end = start + chunk
                    yield pd.DataFrame({
                        "digest": [digest], "no": [no], "start": [start], "stop": [end], "last": [end >= len(text)],
                        "text": [text[start:end + overlap]]})
    return pieces


def encode(model: bytes, overlap: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Tokens of every chunk, and of each end it shares: place and id of the units there and how many tokens a splice drops."""
    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = vocabulary(model)
        for batch in batches:
            for row in batch.itertuples():
                if row.no:
                    ids, begins = known.inner(row.text), row.start
                else:  # the blank before the text is no character of it
                    ids, begins = np.array(known.library.encode(row.text), np.int64), -1
                units = known.units[ids]
                at = begins + np.cumsum(known.chars[ids]) - known.chars[ids]
                upto = np.arange(len(ids)) + units
                head = (units > 0) & (at < row.start + overlap) & (row.no > 0)
                tail = (units > 0) & (at >= row.stop) & (not row.last)
                sides = [
                    pd.DataFrame({"seam": row.no - 1, "at": at[head], "id": ids[head], "drop": upto[head], "left": False}),
                    pd.DataFrame({"seam": row.no, "at": at[tail], "id": ids[tail], "drop": len(ids) - upto[tail], "left": True}),
                ]
                whole = pd.DataFrame({"seam": [row.no], "n": [len(ids)], "last": [row.last]})
                yield pd.concat([whole, *sides]).assign(digest=row.digest)[
                    ["digest", "seam", "n", "last", "at", "id", "drop", "left"]]
    return chunks


ENCODED = "digest string, seam long, n long, last boolean, at long, id long, drop long, left boolean"


def spliced(encoded: DataFrame) -> DataFrame:
    """digest, n_tokens of texts encoded in chunks; null where some overlap has no token at one place in both chunks.

    All common tokens of an overlap give the same count, for a text has one encoding.
    """
    where = ["digest", "seam", "at", "id"]
    left = encoded.where("left").select(*where, F.col("drop").alias("after"))
    right = encoded.where("not left").select(*where, F.col("drop").alias("before"))
    seams = left.join(right, where).groupBy("digest", "seam").agg(F.min(F.col("after") + F.col("before")).alias("twice"))
    chunks = encoded.where("n is not null").select("digest", "seam", "n", "last")
    told = F.every(F.col("last") | F.col("twice").isNotNull())
    return chunks.join(seams, ["digest", "seam"], "left").groupBy("digest").agg(
        F.when(told, F.sum(F.col("n") - F.coalesce("twice", F.lit(0)))).alias("n_tokens"))


def count_long(texts: DataFrame, model: bytes, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """digest, n_tokens of ``texts`` (digest, text), a chunk per task row."""
    counts = None
    while True:
        chunk = max(chunk, 4 * overlap)
        # One row per chunk of each text, dealt evenly: a huge text, or one with many copies, is no task's own.
        pieces = texts.mapInPandas(
            cut(chunk, overlap), "digest string, no long, start long, stop long, last boolean, text string"
        ).dropDuplicates(["digest", "no"])
        tokens = settled(pieces.mapInPandas(encode(model, overlap), ENCODED), "chunk-tokens")
        told = settled(spliced(tokens), "spliced")
        done = told.where("n_tokens is not null")
        counts = done if counts is None else counts.unionByName(done)
        failed = told.where("n_tokens is null").select("digest")
        if not failed.take(1):
            return counts
        texts = texts.join(failed, "digest", "left_semi")
        overlap *= WIDER


def count_tokens(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
                 ) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of ``docs``."""
    small_batches(docs.sparkSession)
    model = model_bytes(path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[["doc_id", "n_bytes"]].assign(n_tokens=vocabulary(model).count(batch["text"].tolist()))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn(
        "n_bytes", F.octet_length("text").cast("long"))
    fits = F.char_length("text") <= chunk
    short = rows.where(fits).mapInPandas(count, "doc_id long, n_bytes long, n_tokens long")
    long = rows.where(~fits).withColumn("digest", F.sha2("text", 256))
    counts = count_long(long.select("digest", "text"), model, chunk, overlap)
    whole = short.unionByName(long.drop("text").join(counts, "digest").drop("digest"))
    return whole.withColumn("over_limit", F.col("n_tokens") > limit)

"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every training passage by block-max
WAND, with the overlap of question and answer as the verdict.

Items are cut into pieces of at most ``PIECE`` words, numbered by length in blocks; each posting list keeps its highest
score per block. A passage starts at every ``STEP`` words of a document and is, for each block, long enough to hold its
longest piece whole wherever that begins, so each piece of a copied item lies whole in some passage. A passage is a query
of its distinct words. The score of a piece is its BM25 score divided by the score it would give itself, so that one
threshold serves all items and sums still bound it term by term. A passage for which no block can reach the threshold by
the block maxima is passed over; the others run document-at-a-time over the posting lists with a pivot, and leave a
block at once where its maxima do not suffice.

All pieces above the threshold are verified: the item's question and its answer (the part after ``Answer:``, else its
last line, else its last sentence) must each be covered by runs of ``RUN`` words of the text around the passage.

The index is built for ``ITEMS`` items at a time and sent to the workers; a larger benchmark takes more passes over the
documents, so nothing is dropped.

Defined results: null text counts as empty; items of fewer than ``LEAST_WORDS`` words are too common to search for;
repeated items are each reported; a null item id is reported as null; repeated rows give repeated pairs; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import settled, small_batches, text_of
from hindcast.llm.kneser_ney import tokens

PIECE = 64
STEP = 16
REACH = 0.5  # of the score that a piece gives itself
K1, B = 1.2, 0.75
BLOCK = 8  # pieces, or more where there would be over BLOCKS blocks
BLOCKS = 128
RUN = 5
QUESTION, ANSWER = 0.6, 0.5  # least shares of words covered
LEAST_WORDS = 5
ITEMS = 20_000
CHUNK_CHARS = 2_000_000
LAYOUT = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
MARKER = re.compile(r"(?is)\b(?:answer|antwort|réponse|respuesta)\s*:")


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    marks = list(MARKER.finditer(text))
    if marks:
        parts = text[:marks[-1].start()], text[marks[-1].end():]
    else:
        lines = [x for x in text.split("\n") if tokens(x)]
        if len(lines) < 2:
            lines = [x for x in re.split(r"(?<=[.!?])\s+", text.strip()) if tokens(x)]
        parts = " ".join(lines[:-1]), lines[-1] if lines else ""
    question, answer = map(tokens, parts)
    return (question or answer), (answer or question)


def covered(part: list[str], near: list[str]) -> float:
    """The share of the part's words inside runs of RUN words (or the whole part, if shorter) that also stand nearby."""
    n = min(RUN, len(part))
    if not n:
        return 0.0
    there = set(zip(*(near[i:] for i in range(n))))
    marks = bytearray(len(part))
    for i in range(len(part) - n + 1):
        if tuple(part[i:i + n]) in there:
            marks[i:i + n] = b"\1" * n
    return sum(marks) / len(part)


class Index:
    """Posting lists with normalised BM25 scores, their maxima by list and by block."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.items = [(i, *question_and_answer(t), tokens(t)) for i, t in items]
        pieces, self.owner = [], []
        for k, (_, _, _, words) in enumerate(self.items):
            if len(words) >= LEAST_WORDS:
                for at in range(0, len(words), PIECE):
                    piece = words[max(0, min(at, len(words) - PIECE)):at + PIECE]
                    pieces.append(Counter(piece))
                    self.owner.append(k)
        order = sorted(range(len(pieces)), key=lambda p: pieces[p].total())
        pieces, self.owner = [pieces[p] for p in order], [self.owner[p] for p in order]
        df = Counter(chain.from_iterable(pieces))
        mean = sum(map(Counter.total, pieces)) / max(len(pieces), 1)
        idf = {w: math.log(1 + (len(pieces) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
        lists = defaultdict(list)
        for p, piece in enumerate(pieces):
            norm = K1 * (1 - B + B * piece.total() / mean)
            own = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in piece.items()}
            whole = sum(own.values())
            for w, x in own.items():
                lists[w].append((p, x / whole))
        self.term = {w: t for t, w in enumerate(lists)}
        self.ids = [[p for p, _ in x] for x in lists.values()]
        self.scores = [[s for _, s in x] for x in lists.values()]
        self.best = np.array([max(x) for x in self.scores] or [0.0])
        self.end = len(pieces)
        self.block = max(BLOCK, -(-self.end // BLOCKS))
        self.blocks = -(-self.end // self.block)
        # Segments that hold any piece of the block, wherever in the first of them it begins.
        self.wide = [
            -(-max(p.total() for p in pieces[i:i + self.block]) // STEP) + 1 for i in range(0, self.end, self.block)]
        self.block_best: list[dict[int, float]] = []
        for x in lists.values():
            most: dict[int, float] = {}
            for p, score in x:
                most[p // self.block] = max(score, most.get(p // self.block, 0.0))
            self.block_best.append(most)
        # The same maxima as flat arrays, by term.
        self.spans = np.cumsum([0, *map(len, self.block_best)])
        self.span_block = np.fromiter(chain.from_iterable(self.block_best), np.int64, int(self.spans[-1]))
        self.span_best = np.fromiter(
            chain.from_iterable(x.values() for x in self.block_best), float, int(self.spans[-1]))

    def block_bounds(self, segment: np.ndarray, term: np.ndarray, segments: int) -> np.ndarray:
        """What each segment's distinct terms can score at most in each block."""
        seen = pd.unique(segment * len(self.ids) + term)
        segment, term = seen // len(self.ids), seen % len(self.ids)
        width = self.spans[term + 1] - self.spans[term]
        at = np.repeat(self.spans[term], width) + np.arange(int(width.sum())) - np.repeat(np.cumsum(width) - width, width)
        cell = np.repeat(segment, width) * self.blocks + self.span_block[at]
        return np.bincount(cell, self.span_best[at], segments * self.blocks).reshape(segments, self.blocks)

    def search(self, terms: list[int], reach: float = REACH) -> list[tuple[int, float]]:
        """All pieces scoring ``reach`` or more for a set of terms, by block-max WAND."""
        found = []
        best, end = self.best, self.end
        # Cursors: current piece, term, place in its list.
        cursors = [[self.ids[t][0], t, 0] for t in terms]

        def seek(cursor: list[int], piece: int) -> None:
            ids = self.ids[cursor[1]]
            cursor[2] = bisect_left(ids, piece, cursor[2])
            cursor[0] = ids[cursor[2]] if cursor[2] < len(ids) else end

        while True:
            cursors = sorted(c for c in cursors if c[0] < end)
            sum_best, pivot = 0.0, -1
            for i, c in enumerate(cursors):
                sum_best += best[c[1]]
                if sum_best >= reach - 1e-12:
                    pivot = i
                    break
            if pivot < 0:
                return found
            piece = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == piece:
                pivot += 1
            block = piece // self.block
            bound = sum(self.block_best[c[1]].get(block, 0.0) for c in cursors[:pivot + 1])
            # Beyond this block, or where another list joins in, the maxima are different ones.
            leave = min((block + 1) * self.block, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else end)
            if bound < reach - 1e-12:
                for c in cursors[:pivot + 1]:
                    seek(c, max(leave, piece + 1))
            elif cursors[0][0] == piece:
                score = sum(self.scores[c[1]][c[2]] for c in cursors[:pivot + 1])
                if score >= reach - 1e-12:
                    found.append((piece, score))
                for c in cursors[:pivot + 1]:
                    seek(c, piece + 1)
            else:
                for c in cursors[:pivot + 1]:
                    seek(c, piece)

    def leaks(self, texts: list[str]) -> Iterator[tuple[int, int, float, float, float]]:
        """(text number, item number, score, question overlap, answer overlap) of every verified item."""
        split = [tokens(t) for t in texts]
        sizes = np.array([len(x) for x in split], np.int64)
        flat = np.array(list(chain.from_iterable(split)), dtype=object)
        if not len(flat) or not self.end:
            return
        ids, distinct = pd.factorize(flat)
        term = np.array([self.term.get(w, -1) for w in distinct], np.int64)[ids]
        starts = np.cumsum(sizes) - sizes
        segments = -(-sizes // STEP)
        before = np.cumsum(segments) - segments
        doc = np.repeat(np.arange(len(texts)), segments)
        word_doc = np.repeat(np.arange(len(texts)), sizes)
        segment = before[word_doc] + (np.arange(len(flat)) - starts[word_doc]) // STEP
        known = term >= 0
        upto = np.zeros((len(doc) + 1, self.blocks))
        np.cumsum(self.block_bounds(segment[known], term[known], len(doc)), axis=0, out=upto[1:])
        here, last = np.arange(len(doc)), (before + segments)[doc]
        wanted = np.zeros(len(doc), np.int64)
        for b, wide in enumerate(self.wide):
            bound = upto[np.minimum(here + wide, last), b] - upto[here, b]
            wanted[bound >= REACH - 1e-9] = wide  # later blocks have the longer pieces
        begin = starts[doc] + (here - before[doc]) * STEP
        finish = np.minimum(begin + wanted * STEP, (starts + sizes)[doc])
        hopeful = np.flatnonzero(wanted)
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        for i in hopeful:
            inside = np.unique(term[begin[i]:finish[i]])
            inside = inside[inside >= 0]
            for piece, score in self.search(inside.tolist()):
                k = self.owner[piece]
                _, question, answer, words = self.items[k]
                at, to = int(begin[i] - starts[doc[i]]), int(finish[i] - starts[doc[i]])
                near = split[doc[i]][max(0, at - len(words)):to + len(words)]
                q, a = covered(question, near), covered(answer, near)
                if q >= QUESTION and a >= ANSWER:
                    key = int(doc[i]), k
                    best[key] = max(best.get(key, (0.0, 0.0, 0.0)), (score, q, a))
        for (d, k), (score, q, a) in best.items():
            yield d, k, score, q, a


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per document and item it holds."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    count = items.count()
    if count > ITEMS:
        lots = -(-2 * count // ITEMS)
        items = settled(items.withColumn("lot", F.pmod(F.xxhash64("item_id", "text"), F.lit(lots))), "items")
        parts = [items.where(F.col("lot") == i).drop("lot") for i in range(lots)]
    else:
        parts = [items]
    found = None
    for part in parts:
        shared = spark.sparkContext.broadcast(
            sorted(((r["item_id"], r["text"]) for r in part.collect()), key=lambda x: (x[0] is None, x[0] or 0, x[1])))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = Index(shared.value)
            for batch in batches:
                for piece in pieces_of(batch):
                    ids = piece["doc_id"].array
                    rows = list(index.leaks(piece["text"].tolist()))
                    yield pd.DataFrame({
                        "doc_id": pd.array([ids[d] for d, *_ in rows], dtype="Int64"),
                        "item_id": pd.array([index.items[k][0] for _, k, *_ in rows], dtype="Int64"),
                        "score": [float(s) for *_, s, _, _ in rows], "question_overlap": [float(q) for *_, q, _ in rows],
                        "answer_overlap": [float(a) for *_, a in rows],
                    })

        leaks = rows.mapInPandas(search, LAYOUT)
        found = leaks if found is None else found.unionByName(leaks)
    return found


def pieces_of(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(batch):
        for _, part in batch.groupby((batch["text"].str.len().cumsum() // CHUNK_CHARS).to_numpy(), sort=False):
            yield part


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item."""
    gone = find_leaks(docs, benchmark).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")

"""Phrase collocations by weighted acyclic automata.

Words of a lang (``n`` of them) and their contiguous runs within pieces are counted by shards. A shard sorts its windows
and builds an automaton from them step by step: a window shares the states of what it has in common with the window
before it, and only its other words make new states; its final weight is its count. Automata are cut by ranges of
hashed prefixes; all shards' automata of one range are united by merging their sorted windows and summing weights, which
gives each phrase its exact count, as the count of a phrase is the weight of all windows that begin with it. Windows of
one, two, and three to five words have prefixes of one, two and three words, so that a frequent word or word pair is
one entry of a shard and not a group of rows. Words and pairs are counted first. The pairs that count enough set bits of
a filter of fixed size, and the longer windows end where a pair has no bit: no frequent phrase holds such a pair, so the
filter decides how much is sent and never what is found.

Phrases counted at least ``LEAST`` times make smaller automata. Each cut of a candidate asks for its two parts: the
parts of a range, sorted out by candidates so that a part that many ask for is dealt to several tasks, are composed with
the automaton of the range, state by state for all parts at once. A candidate counts by its cut of lowest score,
``floor(1000 * a * n / (l * r))`` in exact decimals, and goes if some longer candidate around it is as frequent.

Defined results: null text counts as empty and null lang as ``und``; repeated rows and null ids count like others; ties
of a cut go to the fewest first words, ties of rank to the count, then to the phrase in byte order; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import settled, small_batches, text_of

LEAST = 100
LONGEST = 5
TOP = 2000
PREFIXES = {1: 1, 2: 2, 3: LONGEST}  # words of a prefix, and words of the longest window with such prefixes
RANGE_CHARS = 32 << 20  # of the corpus for each range of prefixes
SHARD_CHARS = 8_000_000  # a longer text is a shard of its own
PAIR_BITS, PAGE_BITS = 26, 19  # of the filter of frequent pairs (8 MB), and of one page of it
DEALT = {1: 64, 2: 16, 3: 4}  # tasks that the parts of one range are dealt to; a shorter part is asked for by more
# Ends of pieces, and blanks inside them.
ENDS, BLANK = b".,;:!?\n\x0b\x0c\r", b" "
TO_PIECES = bytes.maketrans(ENDS + b"\t", b"\n" * len(ENDS) + BLANK)
SQUASH, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x9E3779B97F4A7C15)
AUTOMATON = (
    "lang string, depth long, range long, words array<binary>, shared binary, lengths binary, labels binary, weights binary")
ASKED = "lang string, phrase string, a long, k long, left boolean, part string, near boolean, depth long, range long, slot long"


def sorted_rows(windows: np.ndarray, words: int, first: np.ndarray | None = None) -> np.ndarray:
    """Order of the rows by ``first``, if given, and then by word numbers; several numbers are sorted as one integer."""
    bits = (words + 1).bit_length()
    per = 62 // bits
    keys = []
    for start in range(0, windows.shape[1], per):
        key = np.zeros(len(windows), np.int64)
        for column in windows[:, start:start + per].T:
            key = key << bits | (column.astype(np.int64) + 1)
        keys.append(key)
    return np.lexsort([*keys[::-1], *([] if first is None else [first])])


def word_hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, dtype=object)) if words else np.zeros(0, np.uint64)


def ranges_of(hashes: np.ndarray, windows: np.ndarray, depth: int, ranges: int) -> np.ndarray:
    """The range of hashed prefixes that each window belongs to."""
    mixed = np.zeros(len(windows), np.uint64)
    for k in range(depth):
        mixed = (mixed * STEP + hashes[windows[:, k]]) * SQUASH
        mixed ^= mixed >> np.uint64(31)
    return ((mixed >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def compact(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, led by that number of bytes."""
    top = int(numbers.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - (w == 8)))
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def expanded(numbers: bytes) -> np.ndarray:
    return np.frombuffer(numbers, f"<u{numbers[0]}", offset=1).astype(np.int64)


def pair_bits(lang: str, hashes: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The bit of the filter that each pair of word numbers has."""
    own = np.uint64(pd.util.hash_array(np.array([lang], dtype=object))[0])
    mixed = ((hashes[pairs[:, 0]] ^ own) * STEP + hashes[pairs[:, 1]]) * SQUASH
    mixed ^= mixed >> np.uint64(31)
    return ((mixed * STEP) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


@dataclass
class Automaton:
    """Sorted windows of word numbers (-1 beyond their end) with final weights, and the words in byte order.

    In rows it is kept by states: how many words a window shares with the one before, and the labels of its new states.
    """

    words: list[bytes]
    windows: np.ndarray
    weights: np.ndarray

    @staticmethod
    def of_sorted(words: list[bytes], windows: np.ndarray, weights: np.ndarray) -> Automaton:
        """Equal neighbours summed."""
        if not len(windows):
            return Automaton(words, windows, weights)
        first = np.flatnonzero(np.r_[True, (windows[1:] != windows[:-1]).any(1)])
        return Automaton(words, windows[first], np.add.reduceat(weights, first))

    @staticmethod
    def united(parts: Sequence[Automaton]) -> Automaton:
        words = sorted(set().union(*[p.words for p in parts]))
        number = {w: i for i, w in enumerate(words)}
        renamed = [np.array([number[w] for w in p.words] + [-1], np.int32)[p.windows] for p in parts]
        windows, weights = np.concatenate(renamed), np.concatenate([p.weights for p in parts])
        order = sorted_rows(windows, len(words))
        return Automaton.of_sorted(words, windows[order], weights[order])

    def row(self) -> dict:
        same = np.zeros(self.windows.shape, bool)
        same[1:] = np.logical_and.accumulate(self.windows[1:] == self.windows[:-1], axis=1)
        new = ~same & (self.windows >= 0)
        labels = self.windows[new]
        used = np.unique(labels)
        return {
            "words": [self.words[i] for i in used], "shared": same.sum(1).astype(np.int8).tobytes(),
            "lengths": (self.windows >= 0).sum(1).astype(np.int8).tobytes(),
            "labels": compact(np.searchsorted(used, labels)), "weights": compact(self.weights)}

    @staticmethod
    def of_row(row) -> Automaton:
        shared, lengths = (np.frombuffer(x, np.int8).astype(np.int64) for x in (row.shared, row.lengths))
        labels, weights = expanded(row.labels), expanded(row.weights)
        windows = np.full((len(shared), PREFIXES[row.depth]), -1, np.int32)
        starts = np.cumsum(lengths - shared) - (lengths - shared) - shared
        for k in range(windows.shape[1]):
            own = shared <= k
            here = own & (k < lengths)
            windows[here, k] = labels[starts[here] + k]
            # A shared state is the one of the last window that had a state of its own at this depth.
            windows[:, k] = windows[np.maximum.accumulate(np.where(own, np.arange(len(shared)), 0)), k]
        return Automaton([bytes(w) for w in row.words], windows, weights)

    def counts(self, least: int, shortest: int) -> Automaton:
        """The automaton of all prefixes of at least ``shortest`` words that count ``least`` or more."""
        windows, weights = [], []
        for k in range(shortest, self.windows.shape[1] + 1):
            head = self.windows[:, :k]
            first = np.flatnonzero(np.r_[True, (head[1:] != head[:-1]).any(1)])
            sums = np.add.reduceat(self.weights, first)
            kept = (head[first, k - 1] >= 0) & (sums >= least)
            rows = np.full((kept.sum(), self.windows.shape[1]), -1, np.int32)
            rows[:, :k] = head[first[kept]]
            windows.append(rows)
            weights.append(sums[kept])
        found, weight = np.concatenate(windows), np.concatenate(weights)
        order = sorted_rows(found, len(self.words))
        return Automaton(self.words, found[order], weight[order])

    def composed(self, parts: list[list[bytes]]) -> np.ndarray:
        """Weights of those word runs, 0 where the automaton has no such path: all runs walk the states together."""
        number = {w: i for i, w in enumerate(self.words)}
        width, missing = self.windows.shape[1], len(self.words) + 1
        asked = np.zeros((len(parts), width), np.int64)
        for i, part in enumerate(parts):
            asked[i, :len(part)] = [number.get(w, missing - 1) + 1 for w in part]
        state, there = np.zeros(len(parts), np.int64), np.zeros(len(self.windows), np.int64)
        for k in range(width):
            # States of one depth are numbered by (state before, label); a missing word leads to no state.
            arcs, there = np.unique(there * (missing + 1) + self.windows[:, k] + 1, return_inverse=True)
            wanted = state * (missing + 1) + asked[:, k]
            at = np.minimum(np.searchsorted(arcs, wanted), len(arcs) - 1)
            state = np.where((arcs[at] == wanted) & (state >= 0), at, -1)
        final = np.zeros(len(arcs), np.int64)
        final[there] = self.weights
        return np.where(state >= 0, final[state], 0)


def numbered_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words in byte order, and of every word of the texts its number and its piece."""
    tokens = b"\n".join(texts).lower().translate(TO_PIECES).replace(b"\n", b" \n ").split(BLANK)
    codes, distinct = pd.factorize(np.array(tokens, dtype=object))
    words = sorted(w for w in distinct if w not in (b"", b"\n"))
    number = {w: i for i, w in enumerate(words)} | {b"": -1, b"\n": -2}
    ids = np.array([number[w] for w in distinct], np.int32)[codes]
    piece = np.cumsum(ids == -2)
    return words, ids[ids >= 0], piece[ids >= 0]


def shard_rows(lang: str, texts: list[bytes], ranges: int, frequent: np.ndarray | None = None) -> list[dict]:
    """Automata of one shard, one for each depth and range: of its words and pairs, or, where the bits of ``frequent`` pairs
    are given, of the longer windows that hold such pairs only."""
    words, ids, piece = numbered_words(texts)
    hashes, out = word_hashes(words), []
    windows = np.full((len(ids), 2 if frequent is None else LONGEST), -1, np.int32)
    windows[:, 0] = ids
    pairs = np.flatnonzero(piece[1:] == piece[:-1])
    if frequent is not None:
        bits = pair_bits(lang, hashes, np.stack([ids[pairs], ids[pairs + 1]], 1))
        pairs = pairs[frequent[bits >> 3] >> (bits & 7).astype(np.uint8) & 1 == 1]
    goes_on = np.zeros(len(ids), bool)
    goes_on[pairs] = True
    for k in range(1, min(windows.shape[1], len(ids))):
        upto = len(ids) - k
        windows[:upto, k] = np.where(goes_on[k - 1:k - 1 + upto] & (windows[:upto, k - 1] >= 0), ids[k:], -1)
    for depth, width in PREFIXES.items():
        if (depth == max(PREFIXES)) == (frequent is None):
            continue
        some = windows[windows[:, depth - 1] >= 0, :width]
        within = ranges_of(hashes, some, depth, ranges)
        order = sorted_rows(some, len(words), within)
        some, within = some[order], within[order]
        cuts = np.flatnonzero(np.r_[True, within[1:] != within[:-1], True]) if len(some) else []
        for start, end in zip(cuts[:-1], cuts[1:]):
            made = Automaton.of_sorted(words, some[start:end], np.ones(end - start, np.int64))
            out.append({"lang": lang, "depth": depth, "range": int(within[start]), **made.row()})
    return out


def sharded(ranges: int, frequent: Broadcast | None = None) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = None if frequent is None else np.frombuffer(frequent.value, np.uint8)

        def rows(held: dict[str, list[bytes]]) -> Iterator[pd.DataFrame]:
            for lang, texts in held.items():
                made = shard_rows(lang, texts, ranges, bits)
                if made:
                    yield pd.DataFrame(made)

        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                held.setdefault(lang, []).append(text.encode())
                size += len(text)
                if size >= SHARD_CHARS:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)
    return shards


def frequent_pairs(automata: DataFrame) -> bytes:
    """The filter: a bit for every pair of the automata. Its size is fixed, whatever the number of pairs."""
    def bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                held = Automaton.of_row(row)
                yield pd.DataFrame({"bit": np.unique(pair_bits(row.lang, word_hashes(held.words), held.windows))})

    def packed(page: pd.DataFrame) -> pd.DataFrame:
        here = np.zeros(1 << PAGE_BITS, np.uint8)
        here[page["bit"] & ((1 << PAGE_BITS) - 1)] = 1
        return pd.DataFrame({"page": [page["bit"].iloc[0] >> PAGE_BITS], "bits": [np.packbits(here, bitorder="little").tobytes()]})

    whole = bytearray(1 << (PAIR_BITS - 3))
    pages = automata.where("depth = 2").mapInPandas(bits, "bit long").distinct().groupBy(F.shiftright("bit", PAGE_BITS))
    for row in pages.applyInPandas(packed, "page long, bits binary").collect():
        whole[row["page"] << (PAGE_BITS - 3):(row["page"] + 1) << (PAGE_BITS - 3)] = row["bits"]
    return bytes(whole)


def united_range(least: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def unite(rows: pd.DataFrame) -> pd.DataFrame:
        whole = Automaton.united([Automaton.of_row(r) for r in rows.itertuples()])
        key = {c: rows[c].iloc[0] for c in ("lang", "depth", "range")}
        frequent = whole.counts(least, int(key["depth"]))
        return pd.DataFrame([{**key, **frequent.row(), "total": int(whole.weights.sum())}])
    return unite


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, int]:
    """Automata of all runs of up to ``LONGEST`` words that count ``least`` or more, one row for each lang, depth and range,
    with the weight of the whole range before that; and the number of ranges."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), text_of().alias("text"))
    chars = texts.agg(F.sum(F.char_length("text"))).first()[0] or 0
    ranges = 1 + chars // RANGE_CHARS

    def counted(shards: DataFrame, name: str) -> DataFrame:
        return settled(
            shards.groupBy("lang", "depth", "range").applyInPandas(united_range(least), AUTOMATON + ", total long"), name)

    short = counted(texts.mapInPandas(sharded(ranges), AUTOMATON), "short-counts")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_pairs(short))
    long = counted(texts.mapInPandas(sharded(ranges, frequent), AUTOMATON), "long-counts")
    return short.unionByName(long), ranges


def asked_parts(ranges: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Both parts of every cut of every candidate, with the range that tells their counts."""
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                held = Automaton.of_row(row)
                hashes = word_hashes(held.words)
                texts = np.array([w.decode() for w in held.words], dtype=object)
                lengths = (held.windows >= 0).sum(1)
                for size in range(2, held.windows.shape[1] + 1):
                    runs, a = held.windows[lengths == size, :size], held.weights[lengths == size]
                    if not len(runs):
                        continue
                    phrases = np.array([" ".join(r) for r in texts[runs]], dtype=object)
                    shares = pd.util.hash_array(phrases)
                    for k in range(1, size):
                        for left, part in ((True, runs[:, :k]), (False, runs[:, k:])):
                            depth = min(part.shape[1], max(PREFIXES))
                            yield pd.DataFrame({
                                "lang": row.lang, "phrase": phrases, "a": a, "k": k, "left": left,
                                "part": [" ".join(r) for r in texts[part]], "near": part.shape[1] == size - 1, "depth": depth,
                                "range": ranges_of(hashes, part, depth, ranges),
                                "slot": (shares % np.uint64(DEALT[depth])).astype(np.int64)})
    return ask


def composed_range(asked: pd.DataFrame, automata: pd.DataFrame) -> pd.DataFrame:
    out = asked[["lang", "phrase", "a", "k", "left", "part", "near"]]
    held = Automaton.of_row(next(automata.itertuples()))
    return out.assign(f=held.composed([p.encode().split(BLANK) for p in asked["part"]]))


def part_counts(automata: DataFrame, ranges: int) -> DataFrame:
    """lang, phrase, a, k, left, part, near, f: the count of each part of each cut of each candidate."""
    asked = settled(automata.where("depth > 1").mapInPandas(asked_parts(ranges), ASKED), "asked")
    keys = ["lang", "depth", "range", "slot"]
    dealt = automata.join(asked.select(*keys[:3], F.col("slot").alias("to")).distinct(), keys[:3]).withColumn("slot", F.col("to"))
    return asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
        composed_range, "lang string, phrase string, a long, k long, left boolean, part string, near boolean, f long")


def floored_score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 * a * n / (l * r)) with exact products of up to 38 digits."""
    def exact(x: Column, digits: int) -> Column:
        return x.cast(f"decimal({digits},0)")

    above = F.lit(1000).cast("decimal(4,0)") * exact(a, 15) * exact(n, 17)
    return F.call_function("div", above, exact(l, 15) * exact(r, 15))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the ``top`` phrases of every lang."""
    automata, ranges = phrase_counts(docs, least)
    totals = automata.where("depth = 1").groupBy("lang").agg(F.sum("total").alias("n"))
    parts = settled(part_counts(automata, ranges), "parts")
    cuts = parts.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r")
    ).join(totals, "lang")
    score = floored_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("x"))
    # A longer candidate is as frequent only if one a word longer is, and that one has the phrase as a part.
    inside = parts.where(F.col("near") & (F.col("f") == F.col("a"))).select("lang", F.col("part").alias("phrase")).distinct()
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        lowest.join(inside, ["lang", "phrase"], "left_anti").select("lang", "phrase", "x.*")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))

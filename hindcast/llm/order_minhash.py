"""Near-duplicates by Order MinHash: candidates from ordered minima of occurrence-labelled word k-mers, verified by
banded alignment.

A text is its lower-case words of letters and digits (its plain words where it has none of those). Its k-mers of ``K``
words are labelled with their occurrence number, so that repeats count. Each of ``SKETCHES`` hash functions picks the
``PICKED`` least k-mers and keeps them in text order; two texts that agree in one such sketch are candidates. Texts
up to ``MIDDLE`` words have sketches of k-mers of ``MIDDLE_K`` words; of texts up to ``SHORT`` words every link is found,
for they are candidates if they are equal after as many words of each are left out as a link may edit. A candidate pair is a link if its edit similarity ``1 - edits / longer length``, over words, is ``LEAST`` or more. Edits
are counted exactly by an alignment inside the band of diagonals that this similarity leaves.

Classes are the connected components of the links; equal word sequences are one node from the start, so copies cost
nothing. A bucket of at most ``SMALL`` texts is listed pair by pair. In a larger one every text is first aligned with one
pivot; where several classes are left, blocks of bounded size meet two by two in one task each, which aligns the pairs of
different classes that share enough words for a link. So a pair that agrees in one sketch is told, however many others do.

Each text is aligned with one candidate first, then only with candidates that are still of another class.

Defined results: null text counts as empty, and all texts without words are one class; a null id never names a class
unless all of its class are null; unlike texts under one id have classes of their own, which that id may both name; ties
go to the least id; one row of each class stays, also of repeated rows; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hindcast.llm.common import settled, small_batches, text_of
from hindcast.llm.components import components, merged
from hindcast.llm.kneser_ney import tokens

K = 3
LEAST = 0.8
SKETCHES = 40
PICKED = 2
# Texts up to MIDDLE words have sketches of shorter k-mers, as one edit spoils K of few; a longer partner of a text under
# LEAST * MIDDLE words is none. Texts up to SHORT words meet by what is left of them without some words.
MIDDLE, MIDDLE_K, MIDDLE_SKETCHES = 64, 2, 24
SHORT = 14
SMALL = 8  # texts of a bucket that are compared pair by pair
BLOCK_ROWS, BLOCK_WORDS = 1000, 2_000_000  # of a crowded bucket that meet another such block in one task
BLOCK = 1 << 16  # k-mers hashed at once
CHUNK_CHARS = 4_000_000

# Odd multipliers of the usual 64-bit finalisers.
MIX_A, MIX_B, STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
SEEDS = np.random.default_rng(5).integers(1, 1 << 63, SKETCHES, dtype=np.uint64)
MIDDLE_MARK, SHORT_MARK = np.uint64(1 << 20), np.uint64(1 << 21)  # keep keys of the three kinds apart
SHIFT = np.uint64(31)


def words_of(text: str) -> list[str]:
    return tokens(text) or text.split()


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> SHIFT)) * MIX_A
    x = (x ^ (x >> SHIFT)) * MIX_B
    return x ^ (x >> SHIFT)


def kmers(words: np.ndarray, k: int = K) -> np.ndarray:
    """A hash per run of k words; a shorter text is one k-mer."""
    n = max(1, len(words) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        out = out * STEP + words[i:i + n]
    return mixed(out)


def labelled(grams: np.ndarray) -> np.ndarray:
    """The k-mers with their occurrence number hashed in."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    first = np.r_[True, ranked[1:] != ranked[:-1]]
    at = np.arange(len(grams))
    number = np.empty(len(grams), np.uint64)
    number[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    return grams + number * STEP


def sketch(words: np.ndarray, k: int = K, sketches: int = SKETCHES) -> np.ndarray:
    """One hash per sketch over its two least labelled k-mers, in text order."""
    grams = kmers(words, k)
    marked = labelled(grams)
    rows = np.arange(sketches)
    picked = []
    for start in range(0, len(grams), BLOCK):
        values = (marked[None, start:start + BLOCK] ^ SEEDS[:sketches, None]) * MIX_A
        values ^= values >> SHIFT
        values *= MIX_B
        for _ in range(min(PICKED, values.shape[1])):
            at = values.argmin(1)
            picked.append((values[rows, at].copy(), at + start))
            values[rows, at] = np.uint64(0xFFFFFFFFFFFFFFFF)
    values = np.stack([v for v, _ in picked], 1)
    places = np.stack([p for _, p in picked], 1)
    order = np.argsort(values, axis=1, kind="stable")[:, :PICKED]
    chosen = np.sort(np.take_along_axis(places, order, 1), axis=1)
    out = np.zeros(sketches, np.uint64)
    for i in range(chosen.shape[1]):
        out = mixed(out * STEP + marked[chosen[:, i]] + np.uint64(i))
    return out.astype(np.int64)


def thinned(words: np.ndarray) -> np.ndarray:
    """A hash of every text that is left when at most as many words go as a link of this length may edit.

    Two short texts that are a link share one: drop the words of each that their alignment does not keep. Where the
    longer text may have more edits than the shorter, at least one is an insertion and costs the shorter no word.
    """
    n = len(words)
    out = []
    for most in range(int((1 - LEAST) * n + 1e-9) + 1):
        left = words[np.array(list(combinations(range(n), n - most)))]
        hashes = np.full(len(left), n - most, np.uint64)
        for column in left.T:
            hashes = mixed(hashes * STEP + column)
        out.append(hashes)
    return np.concatenate(out)


def keys_of(words: np.ndarray) -> np.ndarray:
    """The keys under which a text meets candidates, each once; none for a text without words."""
    n = len(words)
    numbered = np.arange(SKETCHES, dtype=np.uint64)
    keys = [np.zeros(0, np.uint64)]
    if 0 < n <= SHORT:
        keys.append(thinned(words) + SHORT_MARK)
    if LEAST * SHORT < n <= MIDDLE:
        keys.append(sketch(words, MIDDLE_K, MIDDLE_SKETCHES).view(np.uint64) + numbered[:MIDDLE_SKETCHES] + MIDDLE_MARK)
    if n > LEAST * MIDDLE:
        keys.append(sketch(words).view(np.uint64) + numbered)
    return np.unique(mixed(np.concatenate(keys))).view(np.int64)


def hashed_words(texts: list[str]) -> Iterator[np.ndarray]:
    """64-bit word hashes of each text, computed once per distinct word of the lot."""
    split = [words_of(t) for t in texts]
    flat = np.array([w for words in split for w in words], dtype=object)
    hashes = pd.util.hash_array(flat, categorize=True) if len(flat) else np.zeros(0, np.uint64)
    ends = np.cumsum([len(words) for words in split])
    yield from np.split(hashes, ends[:-1])


def parts_of(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    if len(batch):
        piece = (batch["text"].str.len().cumsum() // CHUNK_CHARS).to_numpy()
        for _, part in batch.groupby(piece, sort=False):
            yield part


def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """doc_id, the text's hash, digest of the words, their number, and their keys."""
    for batch in batches:
        for part in parts_of(batch):
            rows = list(hashed_words(part["text"].tolist()))
            yield pd.DataFrame({
                "doc_id": part["doc_id"].array, "text_key": part["text_key"].array,
                "digest": [hashlib.blake2b(w.tobytes(), digest_size=16).hexdigest() for w in rows],
                "n": [len(w) for w in rows],
                "keys": [keys_of(w) for w in rows],
            })


def short_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """node and its words as 32-bit hashes, for alignment."""
    for batch in batches:
        for part in parts_of(batch):
            rows = hashed_words(part["text"].tolist())
            yield pd.DataFrame({
                "node": part["node"].array, "words": [(w >> np.uint64(32)).astype(np.uint32).view(np.int32) for w in rows]})


def shared_grams(a: np.ndarray, b: np.ndarray, q: int) -> int:
    """How many q-grams two sequences share, counted as bags."""
    def grams(x: np.ndarray) -> np.ndarray:
        n = len(x) - q + 1
        out = np.zeros(n, np.uint64)
        for i in range(q):
            out = out * STEP + x[i:i + n]
        return out

    both, counts = np.unique(np.concatenate([np.unique(labelled(grams(x))) for x in (a, b)]), return_counts=True)
    return int(np.count_nonzero(counts == 2))


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> int | None:
    """The number of word edits from ``a`` to ``b``, or None if more than ``most``.

    Banded alignment, a column at a time: the differences down a column of the band are the bits of two integers that
    move one row down with every column, so a step costs a few operations on 2 * most bits.
    """
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return None
    unlike = np.flatnonzero(a[:len(b)] != b)
    head = int(unlike[0]) if len(unlike) else len(b)
    a, b = a[head:], b[head:]
    unlike = np.flatnonzero(a[len(a) - len(b):] != b)
    tail = len(b) - 1 - int(unlike[-1]) if len(unlike) else len(b)
    a, b = a[:len(a) - tail], b[:len(b) - tail]
    n, m = len(a), len(b)
    if not m:
        return n
    # An edit spoils three 3-grams at most, so near texts share many: a cheap certain no for most other pairs.
    if m > 2 and shared_grams(a.astype(np.uint64), b.astype(np.uint64), 3) < n - 2 - 3 * most:
        return None
    most_here = min(most, n)
    width = 2 * most_here + 2
    full = (1 << width) - 1
    places: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        places[x] = places.get(x, 0) | 1 << i
    down, up = full >> (width - most_here - 1) << (width - most_here - 1), 0
    start, edits = most_here + 1 - width, most_here
    foot, enough = 1 << (width - 1), 2 * most + m - n
    for j, x in enumerate(b.tolist()):
        here = places.get(x, 0)
        here = (here >> start if start >= 0 else here << -start) & full
        level = ((((here & down) + down) ^ down) | here | up) & full
        right, left = up | (full & ~(level | down)), level & down
        if j < n - most_here:  # the foot of the band still moves down
            edits += not level & foot
            if edits > enough:
                return None
        else:  # along the last row
            foot >>= 1
            edits += bool(right & foot) - bool(left & foot)
        down = left | (full & ~((level >> 1) | right))
        up = (level >> 1) & right
        start += 1
    return edits if edits <= most else None


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> float | None:
    """The edit similarity, or None below ``least``."""
    longer = max(len(a), len(b))
    found = edits_within(a, b, int((1 - least) * longer + 1e-9))
    return None if found is None else 1 - found / longer


def aligned(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """a, b, similarity of the pairs that are links."""
    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [similar(x.view(np.uint32), y.view(np.uint32)) for x, y in zip(batch["wa"], batch["wb"])]
            out = pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": pd.Series(values, batch.index, float)})
            yield out[out["similarity"].notna()]

    left = words.select(F.col("node").alias("a"), F.col("words").alias("wa"))
    right = words.select(F.col("node").alias("b"), F.col("words").alias("wb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "wa", "wb").mapInPandas(
        check, "a long, b long, similarity double")


def of_like_length(n: Column, m: Column) -> Column:
    return F.least(n, m) >= LEAST * F.greatest(n, m)


def next_pairs(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all buckets of ``members`` (key, node, n) with their size and pivot, and candidate pairs among them: all
    of a small bucket, those with the pivot in a crowded one.

    The buckets' sizes and pivots come from one aggregate; only buckets of at most ``SMALL`` rows are ever collected.
    """
    row = F.struct("node", "n")
    info = members.groupBy("key").agg(F.count("*").alias("size"), F.min(row).alias("pivot")).where("size > 1")
    met = settled(members.join(info, "key"), "bucketed")
    crowded = met.where((F.col("size") > SMALL) & (F.col("node") != F.col("pivot.node")))
    stars = crowded.where(of_like_length(F.col("n"), F.col("pivot.n"))).select(
        F.col("pivot.node").alias("a"), F.col("node").alias("b"))
    listed = met.where(F.col("size") <= SMALL).groupBy("key").agg(F.array_sort(F.collect_list(row)).alias("of"))
    first = listed.select(F.posexplode("of").alias("i", "x"), "of")
    others = F.filter(
        F.slice("of", F.col("i") + 2, F.lit(SMALL)),
        lambda y: (y["node"] != F.col("x.node")) & of_like_length(F.col("x.n"), y["n"]))
    each = first.select("x", F.explode(others).alias("y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    return met, stars.unionByName(each).distinct()


def with_class(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the class of their node; a node without links is its own."""
    return rows.drop("class").join(classes, "node", "left").withColumn("class", F.coalesce("class", "node"))


def named_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with what tells its rows apart: id and text. Neither may tell them alone, and rows alike in both may differ
    in other columns."""
    return docs.withColumn("text_key", F.xxhash64(text_of()))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, text_key, node) of every row, where equal word sequences share a node, the class of every linked node, and
    the links (a, b, similarity) that were needed to tell the classes."""
    small_batches(docs.sparkSession)
    texts = named_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")))
    rows = settled(
        texts.mapInPandas(sketched, "doc_id long, text_key long, digest string, n long, keys array<long>"), "sketches")
    # Nodes are numbered when they are written, so no id of a row is needed to name them; one row speaks for each.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("row")
    nodes = settled(
        rows.groupBy("digest").agg(first, F.first("n").alias("n"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    membership = settled(
        rows.select("doc_id", "text_key", "digest").join(nodes.select("digest", "node"), "digest")
        .select("doc_id", "text_key", "node"), "membership")
    members = nodes.select("node", "n", F.explode("keys").alias("key")).select("key", "node", "n")

    met, pairs = next_pairs(members)
    pairs = settled(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs")
    # The ids of texts with any candidate grow with the corpus, so they are merged and never broadcast.
    wanted = nodes.join(met.select("node").distinct(), "node").select("node", "row.*").hint("merge")
    words = settled(
        texts.join(wanted, same_row(texts, wanted)).select("node", "text").dropDuplicates(["node"])
        .mapInPandas(short_words, "node long, words array<int>"), "words")
    # One candidate of each text first: in a large group that leaves few classes, and few of the other pairs to align.
    once = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    found = settled(aligned(once, words), "aligned-once")
    classes = components(found)
    others = of_two_classes(pairs, classes).join(once, ["a", "b"], "left_anti")
    rest = settled(aligned(others, words), "aligned")
    classes = merged(classes, rest)
    crowd = settled(crowded_links(met.where(F.col("size") > SMALL), classes, words), "rest")
    return membership, merged(classes, crowd), found.unionByName(rest).unionByName(crowd)


def of_two_classes(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    left = classes.select(F.col("node").alias("a"), F.col("class").alias("ca"))
    right = classes.select(F.col("node").alias("b"), F.col("class").alias("cb"))
    return pairs.join(left, "a", "left").join(right, "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def crowded_links(crowded: DataFrame, classes: DataFrame, words: DataFrame) -> DataFrame:
    """a, b, similarity: links that join the classes of every crowded bucket, whatever else its texts agree in.

    A bucket is parted by length into overlapping bands no link can miss; parts with one class only or with the texts of
    another part are done. The others are cut into blocks of bounded rows and words by a hash of the node, and every two
    blocks of a part meet in one task. All texts of a part take part, also those already linked to its pivot.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1 / LEAST)))
    rows = settled(
        with_class(crowded.select("key", "node", "n"), classes).withColumn("band", band)
        .withColumn("banded", F.explode(F.array("band", F.col("band") + 1)))
        .select(F.xxhash64("key", "banded").alias("part"), "banded", "band", "node", "n", "class"), "crowded")
    parts = (
        rows.groupBy("part", "banded").agg(
            F.count("*").alias("size"), F.sum("n").alias("words"), F.max("band").alias("top"),
            F.min("class").alias("low"), F.max("class").alias("high"),
            F.bit_xor(F.xxhash64("node")).alias("one"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("two"))
        .where((F.col("low") != F.col("high")) & (F.col("top") == F.col("banded"))))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_ROWS, F.col("words") / BLOCK_WORDS)).cast("int")
    whole = parts.groupBy("banded", "size", "one", "two").agg(F.min("part").alias("part"), F.first("words").alias("words"))
    cut = whole.select("part", blocks.alias("blocks"))
    mine = F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int")
    dealt = (
        rows.join(cut, "part").withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("part", F.least("mine", "other").alias("first"), F.greatest("mine", "other").alias("second"), "mine", "banded",
                "band", "node", "class"))
    return dealt.join(words, "node").groupBy("part", "first", "second").applyInPandas(
        block_links, "a long, b long, similarity double")


def block_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between the two blocks of ``rows`` (or within the one), until no pair of different classes is untold.

    A pair is aligned if it shares as many words, counted as bags, as any link must; the counts come from lists of the
    rows that hold each word.
    """
    rows = rows.sort_values("node", kind="stable")
    texts = [np.asarray(w, np.int32).view(np.uint32) for w in rows["words"]]
    nodes, mine, band = (rows[c].to_numpy() for c in ("node", "mine", "band"))
    two_blocks, banded = rows["first"].iloc[0] != rows["second"].iloc[0], rows["banded"].iloc[0]
    lengths = np.array([len(t) for t in texts])
    _, ids = np.unique(np.concatenate([labelled(t.astype(np.uint64)) for t in texts]), return_inverse=True)
    of = np.split(ids, np.cumsum(lengths)[:-1])
    held = np.repeat(np.arange(len(texts)), lengths)[np.argsort(ids, kind="stable")]
    ends = np.cumsum(np.bincount(ids))
    starts = np.r_[0, ends[:-1]]
    group = pd.factorize(rows["class"])[0]
    out = []
    for i, text in enumerate(texts):
        at = of[i]
        at = at[ends[at] - starts[at] > 1]
        sizes = ends[at] - starts[at]
        places = np.repeat(starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        shared = np.bincount(held[places], minlength=len(texts))
        longer = np.maximum(lengths, lengths[i])
        fit = (shared >= longer - ((1 - LEAST) * longer + 1e-9).astype(np.int64)) & (group != group[i])
        fit &= (band == banded) | (band[i] == banded)
        if two_blocks:
            fit &= mine != mine[i]
        for j in np.flatnonzero(fit[i + 1:]) + i + 1:
            if group[i] != group[j]:
                value = similar(text, texts[j])
                if value is not None:
                    out.append((nodes[i], nodes[j], value))
                    group[group == group[j]] = group[i]
    return pd.DataFrame(out, columns=["a", "b", "similarity"])


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, copy_of: one row per row of ``docs``.

    ``class_id`` is the least id of the near-duplicate class, ``copy_of`` the least id with the same words. Both are
    null only where no row of theirs has an id.
    """
    membership, classes, _ = near_links(docs)
    least = membership.groupBy("node").agg(F.min("doc_id").alias("copy_of"))
    named = with_class(least, classes)
    of_class = named.groupBy("class").agg(F.min("copy_of").alias("class_id"))
    return membership.join(named.join(of_class, "class"), "node").select("doc_id", "class_id", "copy_of")


def one_per_class(docs: DataFrame) -> DataFrame:
    """One row of each class of ``docs``: one with its least id, or any where none has an id."""
    membership, classes, _ = near_links(docs)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    by_node = membership.groupBy("node", "doc_id", "text_key").agg(F.count("*").alias("alike")).groupBy("node").agg(
        F.min(F.struct(row.alias("row"), "alike")).alias("best"))
    kept = settled(
        with_class(by_node, classes).groupBy("class").agg(F.min("best").alias("best"))
        .select(F.col("best.row.doc_id").alias("doc_id"), F.col("best.row.text_key").alias("text_key"), F.col("best.alike").alias("alike")),
        "kept")
    rows = docs.withColumn("_row", F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key")))

    def those(which: DataFrame) -> DataFrame:
        return rows.join(
            which.select(F.struct("doc_id", "text_key").alias("_kept")), F.col("_row").eqNullSafe(F.col("_kept")), "left_semi")

    # Only rows whose like in id and text are repeated need to be brought together to keep one of them.
    single, repeated = those(kept.where("alike = 1")), those(kept.where("alike > 1"))
    return single.unionByName(repeated.dropDuplicates(["_row"])).drop("_row")

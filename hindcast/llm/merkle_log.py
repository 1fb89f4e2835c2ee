"""Merkle manifest of a corpus as a postorder append log.

Every source is a tree of fan-out 16 over its leaves in id order, and the subroots of all sources are the leaves of one
more such tree. The nodes of a tree are kept in the order in which they are completed. Builders work on aligned blocks of
``16 ** LEVELS`` leaves, so that all but the uppermost levels of a block are one builder's own; the tops of the blocks are
the leaves of the next tier of builders, until one block is left. The place of a node in the log follows from its
level and number alone: when leaf ``m - 1`` is appended, ``m - 1`` leaves and ``(m - 1) // 16**j`` nodes of each level j
are complete, and the node of level l that it completes comes l places later. So builders need no common counter, and a
proof finds the siblings of any node by computing their places.

Leaves are ranked by a range partitioning with one offset per source and partition. Proofs are extracted block by
block, from the uppermost tier down: a task reads one builder's segment of the log and the path above its top.

Defined results: a null source is a source of its own, before all others; null ids come first and are never tampered
with; rows of one id are ordered by their leaf, equal ones are leaves each; a null field and an empty one differ; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hindcast.llm.common import settled, small_batches

FAN = 16
LEVELS = 3  # levels that one builder completes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5  # one id in so many, by its checksum
TREES = "*"  # name of the tree over the subroots; names of sources are empty or start with TOLD
TOLD = "="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEGMENT = "tree string, tier long, block long, places array<long>, levels array<int>, nodes array<string>"
STEP = "struct<before: string, after: string>"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return F.sha2(F.concat(*[field(text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, and the leaf of the tampered text where the id is one to tamper with."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select(
        F.coalesce(F.concat(F.lit(TOLD), "source"), F.lit("")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of(F.col("text")).alias("leaf"),
        F.when(tampered, leaf_of(F.translate("text", UPPER, LOWER))).alias("altered"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` (tree, ...) with their number within the tree in that order, nulls first, and how many leaves it has."""
    by = [F.col(c).asc_nulls_first() for c in ("tree", *order)]
    placed = settled(
        rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("_at", 33)
    counts = placed.groupBy("tree", part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    upto = Window.partitionBy("tree").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "tree", "_part", (F.coalesce(F.sum("_n").over(upto), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("tree")).alias("leaves"))
    return placed.withColumn("_part", part).join(offsets, ["tree", "_part"]).select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "leaves")


def place(level, number, leaves):
    """Place in the log of the node of that level and number (arrays or ints) in a tree of so many leaves."""
    last = np.minimum((np.asarray(number) + 1) * FAN ** np.asarray(level), leaves) - 1
    at, complete = np.zeros_like(last), last
    while np.any(complete):
        at, complete = at + complete, complete // FAN
    return at + level


def siblings(level: int, number: int, leaves: int) -> list[tuple[int, list[int], list[int]]]:
    """For every level from there to the root: places of the siblings left and right of the path."""
    out = []
    width = -(-leaves // FAN ** level)
    while width > 1:
        run = range(number // FAN * FAN, min(number // FAN * FAN + FAN, width))
        at = {i: int(place(level, i, leaves)) for i in run if i != number}
        out.append((level, [at[i] for i in run if i < number], [at[i] for i in run if i > number]))
        level, number, width = level + 1, number // FAN, -(-width // FAN)
    return out


def build(block: pd.DataFrame, tier: int, height: int) -> tuple[list[int], list[int], list[str], str]:
    """Places, levels and digests of a block's nodes in completion order, and the top.

    ``block`` has the ``leaf`` digests in order, their ``rank`` in the tier, and the number of leaves of the tree.
    """
    base, first, leaves = height * tier, int(block["rank"].iloc[0]), int(block["leaves"].iloc[0])
    tops = -(-leaves // FAN ** base)
    rows, level, out = block["leaf"].tolist(), 0, []
    number = np.arange(first, first + len(rows))
    while True:
        out.append((number, np.full(len(rows), base + level), rows))
        if level == height or -(-tops // FAN ** level) == 1:
            break
        rows = [digest("".join(rows[i:i + FAN])) for i in range(0, len(rows), FAN)]
        level += 1
        number = np.arange(first // FAN ** level, first // FAN ** level + len(rows))
    numbers, levels = np.concatenate([n for n, _, _ in out]), np.concatenate([at for _, at, _ in out])
    places = place(levels, numbers, leaves)
    nodes = np.array([d for _, _, level_rows in out for d in level_rows], dtype=object)
    order = np.argsort(places, kind="stable")
    return places[order].tolist(), levels[order].tolist(), nodes[order].tolist(), rows[0]


def builder(tier: int, height: int, extra: Sequence[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """What one builder appends: the segment of one block."""
    def segment(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("rank", kind="stable")
        places, levels, nodes, top = build(block, tier, height)
        return pd.DataFrame({
            "tree": [block["tree"].iloc[0]], "tier": [tier], "block": [int(block["rank"].iloc[0]) // FAN ** height],
            "places": [places], "levels": [levels], "nodes": [nodes], "leaves": [int(block["leaves"].iloc[0])], "top": [top],
            **{c: [list(block[c]) if tier == 0 else []] for c in extra}})
    return segment


def built(leaves: DataFrame, extra: Sequence[str] = (), height: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """Segments of the log, one row per builder, of the trees over ``leaves`` (tree, rank, leaf, leaves, extra), and the root
    of each tree (tree, leaf, leaves). No step deals rows by tree alone.

    ``extra`` columns of the leaves are kept in the lowest segments, in leaf order.
    """
    rows = leaves
    segments, roots, tier, width = None, None, 0, FAN ** height
    types = dict(leaves.dtypes)
    layout = SEGMENT + ", leaves long, top string" + "".join(f", {c} array<{types[c]}>" for c in extra)
    while True:
        dealt = rows.withColumn("_block", F.floor(F.col("rank") / width))
        done = settled(dealt.groupBy("tree", "_block").applyInPandas(builder(tier, height, extra), layout), f"segments-{tier}")
        segments = done if segments is None else segments.unionByName(done)
        reach = width ** (tier + 1)
        root = done.where(F.col("leaves") <= reach).select("tree", F.col("top").alias("leaf"), "leaves")
        roots = root if roots is None else roots.unionByName(root)
        rows = done.where(F.col("leaves") > reach).select("tree", F.col("block").alias("rank"), F.col("top").alias("leaf"), "leaves")
        if not rows.take(1):
            return segments, roots
        tier += 1


def paths_in(segment: dict, above: list[tuple[str, str]], height: int) -> Iterator[tuple[int, str, list[tuple[str, str]]]]:
    """Rank, digest and path to the root of every leaf of a segment; siblings are found by their places."""
    base, leaves = height * segment["tier"], segment["leaves"]
    where = {p: i for i, p in enumerate(segment["places"])}
    nodes, first = segment["nodes"], segment["block"] * FAN ** height
    count = int(np.count_nonzero(np.asarray(segment["levels"]) == base))
    runs: dict[tuple[int, int], list[str]] = {}

    def run_of(level: int, run: int) -> list[str]:
        """Digests of the children of a node, once per node."""
        if (level, run) not in runs:
            width = -(-leaves // FAN ** level)
            numbers = np.arange(run * FAN, min(run * FAN + FAN, width))
            runs[level, run] = [nodes[where[p]] for p in place(level, numbers, leaves).tolist()]
        return runs[level, run]

    upper: dict[int, list[tuple[str, str]]] = {}

    def path(level: int, number: int) -> list[tuple[str, str]]:
        """Steps from a node to the root: those of the block, then those above it."""
        if level - base == height or -(-leaves // FAN ** level) == 1:
            return above
        row, i = run_of(level, number // FAN), number % FAN
        step = ("".join(row[:i]), "".join(row[i + 1:]))
        if level > base:
            return [step, *path(level + 1, number // FAN)]
        if number // FAN not in upper:
            upper[number // FAN] = path(level + 1, number // FAN)
        return [step, *upper[number // FAN]]

    for number in range(first, first + count):
        yield number, nodes[where[int(place(base, number, leaves))]], path(base, number)


def fold(leaf: str, path: Sequence[tuple[str, str]]) -> str:
    for before, after in path:
        leaf = digest(before + leaf + after)
    return leaf


def proof_digest(path: Sequence[tuple[str, str]]) -> str:
    return digest("".join(before + after for before, after in path))


def as_steps(path) -> list[tuple[str, str]]:
    return [(s["before"], s["after"]) for s in path]


def tier_paths(segments: DataFrame, above: DataFrame, height: int = LEVELS) -> DataFrame:
    """tree, rank, path of the leaves of those segments; ``above`` has the paths of their tops (tree, rank, path)."""
    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for segment in batch.to_dict("records"):
                found = list(paths_in(segment, as_steps(segment["path"]), height))
                yield pd.DataFrame({
                    "tree": segment["tree"], "rank": [r for r, _, _ in found],
                    "path": [[{"before": b, "after": a} for b, a in p] for _, _, p in found]})

    return with_path(segments, above).mapInPandas(extract, f"tree string, rank long, path array<{STEP}>")


def with_path(segments: DataFrame, above: DataFrame) -> DataFrame:
    return segments.join(above.select("tree", F.col("rank").alias("block"), "path"), ["tree", "block"])


def top_paths(segments: DataFrame, roots: DataFrame, height: int = LEVELS) -> DataFrame:
    """Paths of the blocks of the lowest tier, found from the uppermost tier down; ``roots`` has tree, path."""
    highest = segments.agg(F.max("tier")).first()[0] or 0
    paths = roots.select("tree", F.lit(0).cast("long").alias("rank"), "path")
    for tier in range(highest, 0, -1):
        # Trees that end below this tier have one block in the tier where they end.
        here = segments.where(F.col("tier") == tier)
        there = tier_paths(here, paths, height)
        ended = paths.join(here.select("tree").distinct(), "tree", "left_anti").select("tree", "rank", "path")
        paths = settled(there.unionByName(ended), f"paths-{tier}")
    return paths


def log(segments: DataFrame, height: int = LEVELS) -> DataFrame:
    """tree, place, level, node: the whole append log. Tops of blocks lie in two segments and are given once."""
    return segments.select("tree", "tier", F.explode(F.arrays_zip("places", "levels", "nodes")).alias("x")).where(
        (F.col("tier") == 0) | (F.col("x.levels") > F.col("tier") * height)).select(
        "tree", F.col("x.places").alias("place"), F.col("x.levels").alias("level"), F.col("x.nodes").alias("node"))


def manifest(docs: DataFrame, height: int = LEVELS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Segments and roots of the sources' trees, and of the tree over their subroots."""
    small_batches(docs.sparkSession)
    leaves = ranked(leaves_of(docs), ["doc_id", "leaf"])
    # As text, for pandas would make floats of ids among which one is null.
    segments, roots = built(leaves.withColumn("doc_id", F.col("doc_id").cast("string")), ["doc_id", "altered"], height)
    named = ranked(roots.select(F.lit(TREES).alias("tree"), F.col("tree").alias("source_tree"), "leaf"), ["source_tree"])
    top_segments, top_root = built(named, ["source_tree"], height)
    return segments, roots, top_segments, top_root


def verify(docs: DataFrame, height: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row of ``docs``."""
    segments, roots, top_segments, top_root = manifest(docs, height)
    none = F.array().cast(f"array<{STEP}>")
    first = top_paths(top_segments, top_root.select("tree", none.alias("path")), height)
    named = top_segments.where("tier = 0").select("block", F.posexplode("source_tree").alias("_i", "source_tree"))
    at = tier_paths(top_segments.where("tier = 0"), first, height).select("rank", "path")
    sources = named.select((F.col("block") * FAN ** height + F.col("_i")).alias("rank"), F.col("source_tree").alias("tree")).join(at, "rank")
    root = top_root.first()  # one digest; none for an empty table
    known = settled(
        roots.select("tree", F.col("leaf").alias("subroot")).join(sources, "tree")
        .withColumn("root", F.lit(root["leaf"] if root else None).cast("string")), "subroots")
    blocks = top_paths(segments, known, height)
    lowest = with_path(segments.where("tier = 0"), blocks).join(known.select("tree", "subroot", "root"), "tree")

    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for segment in batch.to_dict("records"):
                out = []
                found = paths_in(segment, as_steps(segment["path"]), height)
                for doc_id, altered, (_, leaf, path) in zip(segment["doc_id"], segment["altered"], found, strict=True):
                    out.append((doc_id, leaf, proof_digest(path), fold(altered or leaf, path)))
                rows = pd.DataFrame(out, columns=["doc_id", "leaf", "proof_sha256", "folded_root"])
                yield rows.assign(subroot=segment["subroot"], root=segment["root"], verified=rows["folded_root"] == segment["root"])[
                    ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]]

    return lowest.mapInPandas(
        prove, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))

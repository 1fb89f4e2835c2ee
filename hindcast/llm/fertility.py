"""Quality rules by tokeniser fertility: what public vocabularies make of a text, with rejection bands per language.

Each word is encoded with a leading blank, as it stands inside running text. A byte-level vocabulary gives characters
per token and the entropy of the text's tokens; a piece vocabulary with byte fallback gives the share of tokens that
are single bytes. A text is kept if it passes the base rules and all three measures lie inside the band of its
language, or of its script where the language is unknown or has no band.

Bands are learned from the table itself, from the texts that pass the base rules: median and spread (quartile range over
1.349) of each measure per language or script and size class (whole logarithm of the token count, as entropy grows with
length). A band with fewer than ``least_docs`` texts gives way to the one of its language or script at all sizes, and that
one to the fixed wide limits, which always hold as well. Quantiles come from counts in fixed bins of 1/256, which are exact,
add up in any order and stay within ``BINS`` bins a band, so reruns agree.

Vocabularies are files named by parameters; the driver reads them (each must stay below ``MOST_BYTES``) and sends them
to the workers. Tokens of words are remembered per worker, up to ``REMEMBERED`` words.

Defined results: null text counts as empty; texts without words have no tokens, zero measures and fail the base rules;
repeated rows are judged each, and count each in the bands; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType

from hindcast.llm.common import WORD, settled, small_batches, text_of

VOCABULARIES = "/opt/tokenizers"
BYTES_FILE, PIECES_FILE = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
MOST_BYTES = 64 << 20
REMEMBERED = 300_000
CHUNK_CHARS = 4_000_000  # characters of one vectorised pass; a longer text is a pass of its own

LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
# Fixed values.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
# The public pre-splitting pattern of the byte-level vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# How many spreads below and above the median a measure may lie, and the least spread a band is given.
LOW_SPREADS, HIGH_SPREADS, BYTE_SPREADS, ENTROPY_SPREADS = 4.0, 8.0, 8.0, 3.5
LEAST_SPREAD = {"chars_per_token": 0.02, "byte_share": 0.005, "token_entropy": 0.05}
LEAST_DOCS = 30
BIN, BINS = 1 / 256, 1 << 14

# Fixed outer limits: least and most characters per token, most byte-fallback share, least entropy in bits.
BANDS = {
    "en": (1.75, 6.5, 0.02, 4.0),
    "de": (1.6, 6.0, 0.02, 4.0),
    "fr": (1.45, 6.0, 0.02, 4.0),
    "es": (1.4, 6.0, 0.02, 4.0),
}
SCRIPT_BANDS = {
    "Latin": (1.4, 7.0, 0.05, 4.0),
    "Cyrillic": (0.5, 4.0, 0.10, 3.5),
    "Greek": (0.5, 4.0, 0.10, 3.5),
    "Arabic": (0.5, 4.0, 0.15, 3.5),
    "Hebrew": (0.4, 4.0, 0.15, 3.5),
    "Devanagari": (0.3, 4.0, 0.30, 3.0),
    "Han": (0.2, 3.0, 0.60, 3.5),
    "Kana": (0.2, 3.0, 0.40, 3.5),
    "Hangul": (0.2, 3.0, 0.60, 3.5),
    "other": (0.2, 8.0, 1.00, 3.0),
}
SCRIPTS = {
    "Latin": r"\p{Latin}", "Cyrillic": r"\p{Cyrillic}", "Greek": r"\p{Greek}", "Arabic": r"\p{Arabic}",
    "Hebrew": r"\p{Hebrew}", "Devanagari": r"\p{Devanagari}", "Han": r"\p{Han}", "Kana": r"[\p{Hiragana}\p{Katakana}]",
    "Hangul": r"\p{Hangul}",
}
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, band string, "
    "chars_per_token double, byte_share double, token_entropy double, n_tokens long")
LAYOUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, band string, chars_per_token double, byte_share double, token_entropy double, "
    "n_tokens long, reason string")


def script_of(text: str) -> str:
    """The script with most letters; the first by the order above on a tie."""
    counts = {name: sum(1 for _ in regex.finditer(p, text)) for name, p in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


class Vocabularies:
    """Both tokenisers of one worker and what they made of the words met so far."""

    def __init__(self, ranks: bytes, pieces: bytes):
        import sentencepiece
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        self.is_byte = [self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())]
        self.size = self.bytes.n_vocab
        self.known: dict[str, tuple[list[int], int, int]] = {}

    def encode(self, words: list[str]) -> list[tuple[list[int], int, int]]:
        """Byte-level tokens, number of pieces and number of byte pieces of each word."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        if new:
            tokens = [self.bytes.encode_ordinary(" " + w) for w in new]
            pieces = self.pieces.encode(new, num_threads=1)
            for w, t, p in zip(new, tokens, pieces):
                self.known[w] = (t, len(p), sum(self.is_byte[i] for i in p))
        return [self.known[w] for w in words]


def repeat_words(ids: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks the words inside any 3-word window that its text holds twice or more."""
    marks = np.zeros(len(ids), bool)
    if len(ids) < 3:
        return marks
    whole = doc[:-2] == doc[2:]
    distinct = int(ids.max()) + 1
    pair = pd.factorize((doc[:-2] * distinct + ids[:-2]) * distinct + ids[1:-1])[0].astype(np.int64)
    window = pd.factorize(pair * distinct + ids[2:])[0]
    again = whole & (np.bincount(window[whole], minlength=int(window.max()) + 1)[window] > 1)
    for shift in range(3):
        marks[shift:len(ids) - 2 + shift] |= again
    return marks


def repeated_lines(text: str) -> int:
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def measured(texts: list[str], vocabularies: Vocabularies) -> dict[str, np.ndarray]:
    """All counts and measures of some texts, word by word in arrays over all of them."""
    split = regex.compile(WORD).findall
    words = [split(t) for t in texts]
    n = len(texts)
    sizes = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(n), sizes)
    flat = np.array(list(chain.from_iterable(words)), dtype=object)
    ids, distinct = pd.factorize(flat)
    ids = ids.astype(np.int64)

    def by_doc(of: np.ndarray) -> np.ndarray:
        return np.bincount(doc, of[ids], n) if len(ids) else np.zeros(n)

    found = vocabularies.encode(list(distinct))
    lengths = np.array([len(w) for w in distinct], float)
    token_counts = np.array([len(t) for t, _, _ in found], np.int64)
    tokens = by_doc(token_counts)
    pieces, bytes_ = by_doc(np.array([p for _, p, _ in found], float)), by_doc(np.array([b for _, _, b in found], float))
    chars = by_doc(lengths)
    # Tokens per text: each text's distinct words first, then the tokens of those.
    entropy = np.zeros(n)
    if len(ids):
        wide = len(distinct)
        place, keys = pd.factorize(doc * wide + ids)
        times = np.bincount(place)
        owner, word = keys // wide, keys % wide
        starts = np.concatenate([[0], np.cumsum(token_counts)])
        all_tokens = np.fromiter(chain.from_iterable(t for t, _, _ in found), np.int64, int(starts[-1]))
        per = token_counts[word]
        inner = np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
        token = all_tokens[np.repeat(starts[word], per) + inner]
        at, groups = pd.factorize(np.repeat(owner, per) * vocabularies.size + token)
        counts = np.bincount(at, np.repeat(times, per))
        whose = groups // vocabularies.size
        total = np.maximum(tokens, 1)
        entropy = np.log2(total) - np.bincount(whose, counts * np.log2(counts), n) / total
        entropy[tokens == 0] = 0.0
    return {
        "n_words": sizes, "word_chars": chars.astype(np.int64),
        "n_symbols": np.array([sum(map(t.count, SYMBOLS)) for t in texts], np.int64),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], np.int64),
        "n_repeat_words": np.bincount(doc, repeat_words(ids, doc), n).astype(np.int64),
        "chars_per_token": np.where(tokens > 0, chars / np.maximum(tokens, 1), 0.0),
        "byte_share": np.where(pieces > 0, bytes_ / np.maximum(pieces, 1), 0.0),
        "token_entropy": np.maximum(entropy, 0.0),
        "n_tokens": tokens.astype(np.int64),
    }


def described(batch: pd.DataFrame, vocabularies: Vocabularies, named: set[str]) -> pd.DataFrame:
    """Counts, measures, base verdict and the name of the band of each text."""
    texts = batch["text"].tolist()
    found = measured(texts, vocabularies)
    band = [lang if lang in named else script_of(text) for lang, text in zip(batch["lang"], texts)]
    base = (found["n_words"] < LEAST_WORDS) | (100 * found["n_repeat_words"] > MOST_REPEATED * found["n_words"])
    return pd.DataFrame({**found, "base_failed": base, "band": band})[[c.split()[0] for c in MEASURES.split(", ")]]


def slices(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Pieces of about CHUNK_CHARS characters."""
    piece = (batch["text"].str.len().cumsum() // CHUNK_CHARS) if len(batch) else batch["text"]
    for _, part in batch.groupby(piece.to_numpy(), sort=False):
        yield part


def measures(docs: DataFrame, vocabularies: str, named: set[str]) -> Column:
    """A struct column of :data:`MEASURES` for rows with ``lang`` and ``text``."""
    files = [Path(vocabularies, name).read_bytes() for name in (BYTES_FILE, PIECES_FILE)]
    if max(map(len, files)) > MOST_BYTES:
        raise ValueError("a vocabulary file is too large to send to every worker")
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(files)

    def measure(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        both = Vocabularies(*shared.value)
        for lang, text in parts:
            batch = pd.DataFrame({"lang": lang, "text": text})
            found = [described(part, both, named) for part in slices(batch)] or [described(batch, both, named)]
            yield pd.concat(found, ignore_index=True)

    return F.pandas_udf(measure, MEASURES, PandasUDFType.SCALAR_ITER)(F.col("lang").cast("string"), text_of())


def learned_bands(rows: DataFrame) -> DataFrame:
    """Per band and size class (-1: all sizes): how many texts count, and each measure's median and spread.

    ``rows`` has the measures as columns. At most the named bands times 65 classes come out.
    """
    sound = rows.where(~F.col("base_failed")).select(
        "band", F.explode(F.array(size_class(), F.lit(-1))).alias("size"),
        F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("x")) for m in LEAST_SPREAD])).alias("m"),
    )
    place = F.least(F.floor(F.col("m.x") / BIN), F.lit(BINS - 1)).cast("int")
    keys = ["band", "size", "measure"]
    bins = sound.groupBy("band", "size", F.col("m.measure").alias("measure"), place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # A window sees the bins of one band, at most BINS.
    up_to = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    summed = bins.withColumns({"upto": F.sum("n").over(up_to), "all": F.sum("n").over(Window.partitionBy(*keys))})

    def quantile(p: float) -> Column:
        wanted = p * F.col("all")
        inside = BIN * (F.col("bin") + (wanted - (F.col("upto") - F.col("n"))) / F.col("n"))
        return F.min(F.when(F.col("upto") >= wanted, F.struct("bin", inside.alias("x"))))["x"]

    spreads = summed.groupBy(*keys).agg(
        F.max("all").alias("docs"), quantile(0.5).alias("middle"), ((quantile(0.75) - quantile(0.25)) / 1.349).alias("spread")
    )
    return spreads.groupBy("band", "size").agg(F.max("docs").alias("docs"), *[
        F.max(F.when(F.col("measure") == m, F.struct("middle", F.greatest("spread", F.lit(floor)).alias("spread")))).alias(m)
        for m, floor in LEAST_SPREAD.items()
    ])


def size_class(tokens: str = "n_tokens") -> Column:
    return F.floor(F.log2(F.greatest(F.col(tokens), F.lit(1)))).cast("int")


def with_reason(rows: DataFrame, limits: dict, least_docs: int) -> DataFrame:
    """Rows ``(row, m)`` with ``reason``: the first rule a text fails, null if it is kept.

    The learned bands are broadcast: a row per named band and size class, whatever the table holds.
    """
    bands = learned_bands(rows.select("m.*")).where(F.col("docs") >= least_docs)
    learned = F.struct(*LEAST_SPREAD)
    of_size = bands.where(F.col("size") >= 0).select(F.struct("band", "size").alias("_at"), learned.alias("_near"))
    at_all = bands.where(F.col("size") < 0).select(F.col("band").alias("_band"), learned.alias("_far"))
    asked = rows.withColumn("_at", F.struct(F.col("m.band").alias("band"), size_class("m.n_tokens").alias("size")))
    met = asked.join(F.broadcast(of_size), "_at", "left").join(F.broadcast(at_all), F.col("m.band") == F.col("_band"), "left")
    band = F.coalesce("_near", "_far")

    def edge(measure: str, spreads: float) -> Column:
        return band[measure]["middle"] + spreads * band[measure]["spread"]

    fixed = F.create_map(*chain.from_iterable((F.lit(k), F.array(*map(F.lit, map(float, v)))) for k, v in limits.items()))
    low, high, most, least = (fixed[F.col("m.band")][i] for i in range(4))
    per, share, entropy = (F.col(f"m.{m}") for m in LEAST_SPREAD)
    # greatest and least pass over the nulls of a band that was not learned.
    reason = (
        F.when(F.col("m.base_failed"), "base rules")
        .when((per < F.greatest(low, edge("chars_per_token", -LOW_SPREADS)))
              | (per > F.least(high, edge("chars_per_token", HIGH_SPREADS))), "chars_per_token")
        .when(share > F.least(most, edge("byte_share", BYTE_SPREADS)), "byte_share")
        .when(entropy < F.greatest(least, edge("token_entropy", -ENTROPY_SPREADS)), "token_entropy")
    )
    return met.select("row", "m", reason.alias("reason"))


def judged(docs: DataFrame, row: Column, vocabularies: str, bands: dict | None, script_bands: dict | None, least_docs: int
           ) -> DataFrame:
    """``row`` of every document with its measures ``m`` and the ``reason`` it is rejected for.

    Texts are tokenised once: rows and measures are written, then read for the bands (measures only) and for the verdict.
    """
    by_language, by_script = BANDS if bands is None else bands, SCRIPT_BANDS if script_bands is None else script_bands
    rows = docs.select(row.alias("row"), measures(docs, vocabularies, set(by_language)).alias("m"))
    return with_reason(settled(rows, "fertility"), by_script | by_language, least_docs)


def judge_fertility(
    docs: DataFrame, *, vocabularies: str = VOCABULARIES, bands: dict | None = None, script_bands: dict | None = None,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """One row per row of ``docs``: base counts, fertility measures, the band used, the verdict and its reason."""
    found = judged(docs, F.col("doc_id").cast("long"), vocabularies, bands, script_bands, least_docs)
    return found.select(
        F.col("row").alias("doc_id"), "m.*", F.col("reason").isNull().alias("kept"), "reason"
    ).select(*[c.split()[0] for c in LAYOUT.split(", ")])


def rejects_by_reason(docs: DataFrame, **settings) -> DataFrame:
    """How many texts each rule rejects first, per band; ``reason`` is null for those kept."""
    return judge_fertility(docs, **settings).groupBy("band", "reason").agg(F.count(F.lit(1)).alias("docs"))


def kept_by_fertility(
    docs: DataFrame, *, vocabularies: str = VOCABULARIES, bands: dict | None = None, script_bands: dict | None = None,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    found = judged(docs, F.struct("*"), vocabularies, bands, script_bands, least_docs)
    return found.where(F.col("reason").isNull()).select("row.*")

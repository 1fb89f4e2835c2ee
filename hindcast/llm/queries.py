"""The dealt operators as named queries over the test tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hindcast.llm.arc_warc import archived
from hindcast.llm.chat_prefix import digests, prefix_examples
from hindcast.llm.collocations import collocations
from hindcast.llm.common import settled, table
from hindcast.llm.cube_mixing import mix
from hindcast.llm.decontaminate import find_leaks
from hindcast.llm.fertility import judge_fertility
from hindcast.llm.html_trees import extract
from hindcast.llm.kneser_ney import score_toxicity
from hindcast.llm.licences import LEAST, MARKS, TEMPLATES, scan_licences
from hindcast.llm.merkle_log import verify
from hindcast.llm.order_minhash import near_classes
from hindcast.llm.quality_kernel import score_quality
from hindcast.llm.token_counts import count_tokens


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_licences(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(table(spark, folder, "documents"))


def op3_fertility(spark: SparkSession, folder: str) -> DataFrame:
    return judge_fertility(table(spark, folder, "documents"))


def op4_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(table(spark, folder, "documents"))


def op5_html_trees(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def op6_arc_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived(table(spark, folder, "pages"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return digests(settled(prefix_examples(rows), "prefix-examples"))


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"))


def op13_merkle_log(spark: SparkSession, folder: str) -> DataFrame:
    return verify(table(spark, folder, "documents"))


def _licence_sql() -> str:
    rows = ", ".join(f"('{name}', '{text}')" for name, text in sorted(TEMPLATES.items()))
    grams = "list_distinct([w[i] || ' ' || w[i + 1] for i in range(1, len(w))])"
    words = f"string_split(trim(regexp_replace(lower(text), '{MARKS}', ' ', 'g'), ' '), ' ')"
    return f"""
WITH licences(licence, text) AS (VALUES {rows}),
templates AS (SELECT licence, {grams} AS t FROM (SELECT licence, {words} AS w FROM licences)),
units AS (
    SELECT doc_id, 'line' AS unit, unnest(range(1, len(p) + 1)) AS unit_no, unnest(p) AS text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents WHERE text IS NOT NULL)
    UNION ALL
    SELECT doc_id, 'paragraph', unnest(range(1, len(p) + 1)), unnest(p)
    FROM (SELECT doc_id, regexp_split_to_array(text, '\n\n+') AS p FROM documents WHERE contains(text, chr(10) || chr(10)))
    UNION ALL
    SELECT doc_id, 'text', 1, text FROM documents WHERE contains(text, chr(10))
),
split AS (SELECT doc_id, unit, unit_no, {words} AS w FROM units),
sets AS (SELECT doc_id, unit, unit_no, {grams} AS g FROM split WHERE len(w) > 1),
scored AS (
    SELECT doc_id, unit, unit_no, licence, 2.0::DOUBLE * len(list_intersect(g, t)) / (len(g) + len(t)) AS dice
    FROM sets JOIN templates
      ON len(g) BETWEEN ceil(len(t) * {LEAST} / (2 - {LEAST}) - 1e-9) AND floor(len(t) * (2 - {LEAST}) / {LEAST} + 1e-9)
)
SELECT doc_id, unit, unit_no::INTEGER AS unit_no, licence, dice FROM scored WHERE dice >= {LEAST}
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, licence) = 1
"""


def _prefix_sql() -> str:
    def escaped(column: str) -> str:
        out = f"replace({column}, '\\', '\\\\')"
        for control in ("<s>", "</s>", "[INST]", "[/INST]"):
            out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
        return out

    return f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
        count(*) OVER (PARTITION BY conv_id) AS n,
        24 + length({escaped('role')}) + length({escaped('text')}) AS chars
    FROM turns
),
summed AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM numbered)
SELECT conv_id, count(*)::BIGINT AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    (sum(upto) FILTER (WHERE role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM summed GROUP BY conv_id
"""


def _merkle_sql(levels: int = 8) -> str:
    """Levels one by one, enough of them for 16 ** levels rows of a source and as many sources."""
    def field(name: str) -> str:
        text = f"({name})::VARCHAR"
        return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    digits = "string_split(doc_id::VARCHAR, '')"
    bits = f"flatten(list_transform({digits}, lambda d: [ord(d)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))"
    step = "xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, b: {step}), 4294967295::BIGINT)"
    parts = [
        f"""leaves AS (SELECT coalesce('=' || source, '') AS tree, doc_id, {leaf('text')} AS leaf,
            CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf(f"translate(text, '{upper}', '{upper.lower()}')")} END AS altered FROM documents)""",
        """a0 AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx FROM leaves)""",
        "l0 AS (SELECT tree, idx, leaf AS d FROM a0)",
        "w0 AS (SELECT tree, idx, idx AS up, leaf, coalesce(altered, leaf) AS folded, '' AS proof, doc_id FROM a0)",
    ]

    def climb(nodes: str, walk: str, keep: str) -> None:
        for k in range(levels):
            parts.append(f"""{nodes}n{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n,
                coalesce(string_agg(d, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
                coalesce(string_agg(d, '') OVER (PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post
                FROM {nodes}{k})""")
            parts.append(f"""{nodes}{k + 1} AS (SELECT tree, idx // 16 AS idx, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY idx)) ELSE min(d) END AS d
                FROM {nodes}n{k} GROUP BY tree, idx // 16, n)""")
            parts.append(f"""{walk}{k + 1} AS (SELECT w.tree, w.idx, CASE WHEN s.n > 1 THEN w.up // 16 ELSE w.up END AS up, {keep},
                CASE WHEN s.n > 1 THEN sha256(s.pre || w.folded || s.post) ELSE w.folded END AS folded, w.proof || s.pre || s.post AS proof
                FROM {walk}{k} w JOIN {nodes}n{k} s ON s.tree = w.tree AND s.idx = w.up)""")

    climb("l", "w", "w.leaf, w.doc_id")
    parts.append(f"subs AS (SELECT '*' AS tree, tree AS source_tree, row_number() OVER (ORDER BY tree) - 1 AS idx, d FROM l{levels})")
    parts.append("t0 AS (SELECT tree, idx, d FROM subs)")
    parts.append(f"""v0 AS (SELECT b.tree, b.idx, b.idx AS up, w.folded, w.proof, w.leaf, w.doc_id, b.d AS subroot
        FROM w{levels} w JOIN subs b ON b.source_tree = w.tree)""")
    climb("t", "v", "w.leaf, w.doc_id, w.subroot")
    return "WITH " + ",\n".join(parts) + f"""
SELECT v.doc_id, v.leaf, v.subroot, r.d AS root, sha256(v.proof) AS proof_sha256, v.folded AS folded_root, v.folded = r.d AS verified
FROM v{levels} v JOIN t{levels} r ON r.tree = v.tree
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_licences": op2_licences,
    "op3_fertility": op3_fertility,
    "op4_order_minhash": op4_order_minhash,
    "op5_html_trees": op5_html_trees,
    "op6_arc_warc": op6_arc_warc,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_prefix_targets": op10_prefix_targets,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_merkle_log": op13_merkle_log,
}
SQL: dict[str, str] = {
    "op6_arc_warc": """
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN best > page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN best > page_id THEN best END AS refers_to
FROM (
    SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest,
        CASE WHEN strlen(h) >= 1000 THEN max(page_id) OVER (PARTITION BY h) END AS best
    FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))
""",
    "op2_licences": _licence_sql(),
    "op10_prefix_targets": _prefix_sql(),
    "op11_collocations": """
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split WHERE len(w) > 0),
runs AS (SELECT lang, k, w[i:i + k - 1] AS p FROM starts, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE i + k - 1 <= len(w)),
counted AS (SELECT lang, k, p, count(*) AS f FROM runs GROUP BY ALL),
totals AS (SELECT lang, sum(f)::HUGEINT AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, p, f AS a FROM counted WHERE k > 1 AND f >= 100),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.size, c.p, c.a, c.k, x.f AS l, y.f AS r, t.n, 1000::HUGEINT * c.a * t.n // (x.f::HUGEINT * y.f) AS score,
        x.p AS first_part, y.p AS rest
    FROM cuts c JOIN totals t USING (lang) JOIN counted x ON x.lang = c.lang AND x.p = c.p[1:c.k]
    JOIN counted y ON y.lang = c.lang AND y.p = c.p[c.k + 1:]),
inside AS (
    SELECT lang, first_part AS p FROM scored WHERE k = size - 1 AND l = a UNION SELECT lang, rest FROM scored WHERE k = 1 AND r = a),
lowest AS (
    SELECT * FROM scored s WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = s.lang AND i.p = s.p)
    QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank, array_to_string(p, ' ') AS phrase,
    a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM lowest
QUALIFY rank <= 2000
""",
    "op13_merkle_log": _merkle_sql(),
}

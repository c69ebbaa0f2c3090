"""The registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cyclonespark.llm import (
    ann_forest,
    conversation_repair,
    html_template,
    merkle_manifest,
    minmax_dedup,
    mixing,
    packing,
    ppm_score,
    quality_rules,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
)
from cyclonespark.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    marks = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    machine = toxicity.fit(docs, marks.filter(~toxicity.held_out(F.col("doc_id"))))
    scored = toxicity.score(docs, machine)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op2_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_rules.score(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_html_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract(table(spark, sf_dir, "pages"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("_topic").alias("topic"), F.col("_tokens").alias("tokens"), F.round("_p", 6).alias("p"), F.col("_kept").alias("kept"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard(table(spark, sf_dir, "documents"))
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.dedup(docs, text_out=False).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minmax_dedup.near_dups(table(spark, sf_dir, "documents"), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm_score.score(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.verify(table(spark, sf_dir, "documents"), merkle_manifest.tampered())


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(rows, conversation_repair.damage(rows))


QUERIES = {f.__name__: f for f in (op1_toxicity, op2_ann_forest, op3_quality_rules, op4_packing, op5_token_counts, op6_html_template, op7_mixing, op8_sharding, op9_substring_dedup, op10_minmax_dedup, op11_ppm_score, op12_merkle_manifest, op13_conversation_repair)}

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _quality_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)

    def rule(ratio: str, low, high) -> str:
        top, bottom = ratio.split(" / ")
        value = f"coalesce({top}::DOUBLE / nullif({bottom}, 0), 0)"
        return " AND ".join([f"{value} >= {low}"] * (low is not None) + [f"{value} <= {high}"] * (high is not None))

    verdict = " AND ".join(rule(*r) for r in quality_rules.RULES)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS.format("t")} AS ws, list_filter(string_split(t, chr(10)), lambda x: translate(x, {_BLANKS}, '') <> '') AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS c FROM g) WHERE c > 1),
v AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM m) GROUP BY r),
q AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(translate(t, {_BLANKS}, ''))::BIGINT AS word_chars,
 (length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
 len(list_filter(ws, lambda x: list_contains([{stop}], lower(x))))::BIGINT AS n_stop_words, coalesce(v.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN v USING (r)),
b AS (SELECT *, (n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words) AS base_failed FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {verdict}) AS kept FROM b
"""


def _substring_sql() -> str:
    w = substring_dedup.WINDOW
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
g AS (SELECT r, i, md5(array_to_string(ws[i:i + {w - 1}], ' ')) AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - {w - 2})) AS i FROM w WHERE len(ws) >= {w})),
m AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY gram) AS c FROM g) WHERE c > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + {w})) AS p FROM m),
kept AS (SELECT x.r, string_agg(x.word, ' ' ORDER BY x.p) AS t, count(*) AS n FROM (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w) x ANTI JOIN gone USING (r, p) GROUP BY x.r)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (r)
"""


def _near_sql(k: int) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{upper}', '{upper.lower()}')")} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {k - 1}], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {k - 2}))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (gram) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= {minmax_dedup.PERCENT} * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT a, y FROM reach JOIN e ON b = x),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM c LEFT JOIN n USING (doc_id)
"""


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of a string of ASCII characters."""
    byte = "list_reduce(range(8), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(c, b))"
    return f"xor(list_reduce(list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT), lambda c, b: {byte}, 4294967295), 4294967295)"


def _merkle_sql() -> str:
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle_manifest.FIELDS) + ")"
    cut = f"CASE WHEN {_crc32_sql('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    up = lambda name, base: f"""{name}(key, k, pos, h) AS ({base} UNION ALL
 SELECT key, k + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY key) AS c FROM {name}) WHERE c > 1 GROUP BY key, k, pos // 3)"""  # noqa: E731
    near = lambda name: f"""SELECT a.key, a.k, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
 FROM {name} a JOIN {name} b ON a.key = b.key AND a.k = b.k AND a.pos // 3 = b.pos // 3 WHERE EXISTS (FROM {name} p WHERE p.key = a.key AND p.k = a.k + 1) GROUP BY ALL"""  # noqa: E731
    fold = lambda name, base, sides: f"""{name}(r, key, k, pos, h, proof) AS ({base} UNION ALL
 SELECT f.r, f.key, f.k + 1, f.pos // 3, sha256(s.l || f.h || s.r), f.proof || s.l || s.r FROM {name} f JOIN {sides} s ON s.key = f.key AND s.k = f.k AND s.pos = f.pos)"""  # noqa: E731
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS key, {leaf('text')} AS leaf, {leaf('(' + cut + ')')} AS claim FROM documents),
n AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS ix FROM d),
{up("low", "SELECT key, 0, ix, leaf FROM n")},
sub AS (SELECT key, h, row_number() OVER (ORDER BY encode(key)) - 1 AS ix FROM (SELECT key, arg_max(h, k) AS h FROM low GROUP BY key)),
{up("high", "SELECT '', 0, ix, h FROM sub")},
root AS (SELECT arg_max(h, k) AS root FROM high),
lows AS ({near("low")}), highs AS ({near("high")}),
{fold("f", "SELECT r, key, 0, ix, claim, '' FROM n", "lows")},
g AS (SELECT r, arg_max(key, k) AS key, arg_max(h, k) AS h, arg_max(proof, k) AS proof FROM f GROUP BY r),
{fold("t", "SELECT g.r, '', 0, sub.ix, g.h, g.proof FROM g JOIN sub USING (key)", "highs")},
e AS (SELECT r, arg_max(h, k) AS folded_root, arg_max(proof, k) AS proof FROM t GROUP BY r)
SELECT n.doc_id, n.leaf, sub.h AS subroot, root.root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = root.root AS verified
FROM n JOIN e USING (r) JOIN sub USING (key) CROSS JOIN root
"""


ORACLES = {
    "op3_quality_rules": _quality_sql(),
    "op7_mixing": mixing.oracle_sql(),
    "op9_substring_dedup": _substring_sql(),
    "op10_minmax_dedup": _near_sql(2),
    "op12_merkle_manifest": _merkle_sql(),
}

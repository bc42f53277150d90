"""The thirteen queries over whole tables, and those that SQL can express as DuckDB SQL."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runnel.llm import (
    alignment,
    decontaminate,
    html,
    negatives,
    packing,
    pii,
    quality,
    rules,
    secret_spans,
    simhash,
    substrings,
    toxicity,
    urls,
)

TOKENIZER = public_tokenizers.path(packing.TOKENIZER)
#: The byte-level vocabulary as ranks; the same ids as byte_bpe_50k.json.
BYTE_TOKENS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_TOKENS = public_tokenizers.path("piece_bpe_32k.model")


def prepare(spark: SparkSession) -> None:
    """Sets what a session without cluster settings lacks: the checkpoint folder in local
    mode, and this package on the workers' path."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not context.getCheckpointDir() and (named or context.master.startswith("local")):
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="runnel-"))
    root = Path(__file__).resolve().parents[2]
    system = context._jvm.java.lang.System
    known = [system.getProperty("user.dir"), *(system.getenv("PYTHONPATH") or "").split(os.pathsep)]
    if str(root) in known or not Path(root, "runnel").is_dir():
        return
    if any(Path(p, "runnel").is_dir() for p in known if p):
        return
    name = f"runnel-{os.getpid()}.zip"
    if not any(name in p for p in sys.path):
        whole = Path(tempfile.mkdtemp(prefix="runnel-"), name)
        with zipfile.ZipFile(whole, "w") as z:
            for p in Path(root, "runnel").rglob("*.py"):
                z.write(p, p.relative_to(root))
        context.addPyFile(str(whole))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.classify(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = decontaminate.find_passages(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), carry=["doc_id"]
    )
    n_hit = decontaminate.hit_words()
    return found.select(
        "row.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return urls.judge_urls(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_texts(docs, model, carry=["doc_id"]).select("row.doc_id", "score")
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op6_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    judged = rules.judge_hosts(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept")


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = html.main_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])
    return found.select(
        "row.page_id",
        "row.url",
        F.col("main").alias("text"),
        F.length("main").cast("long").alias("n_chars"),
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = pii.personal_data(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select(
        "row.doc_id",
        *[pii.count_of(kind).alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(base_only=True).cast("binary"), 256).alias("base_sha256"),
        pii.listed().alias("spans"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    number = F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(table(spark, sf_dir, "embeddings"), number % 50 == 0, label)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    found = secret_spans.find_secrets(
        table(spark, sf_dir, "documents"), BYTE_TOKENS, public_tokenizers.PATTERN, carry=["doc_id"]
    )
    return found.select(
        "row.doc_id",
        *[secret_spans.count_of(kind).alias(f"n_{kind}") for kind in secret_spans.BASE],
        F.sha2(secret_spans.listed(base_only=True).cast("binary"), 256).alias("base_sha256"),
        secret_spans.listed().alias("spans"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    found = alignment.align_corpus(
        docs, BYTE_TOKENS, public_tokenizers.PATTERN, PIECE_TOKENS, carry=["doc_id"]
    )
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), *alignment.columns())


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality, op2_decontamination, op3_urls, op4_toxicity, op5_simhash, op6_rules,
        op7_substrings, op8_html, op9_pii, op10_packing, op11_negatives, op12_secrets,
        op13_alignment,
    )
}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op2_decontamination": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM} AS w FROM documents),
items AS (SELECT item_id, {ALNUM} AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS s
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM wins),
runs AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS s
  FROM docs, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)),
hits AS (SELECT r, i, n, item_id FROM runs JOIN wins USING (n, s)),
places AS (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM hits),
hit AS (SELECT r, count(*) AS n_hit FROM places GROUP BY r),
named AS (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits),
found AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM named GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN found USING (r)""",
    "op6_rules": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
  {WORDS} AS w FROM documents),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lines
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
runs AS (SELECT r, i, array_to_string(w[i : i + 4], ' ') AS s
  FROM docs, unnest(range(1, len(w) - 3)) AS t(i)),
twice AS (SELECT r, s FROM runs GROUP BY r, s HAVING count(*) > 1),
places AS (SELECT DISTINCT r, unnest(range(i, i + 5)) AS p FROM runs JOIN twice USING (r, s)),
repeats AS (SELECT r, count(*) AS n FROM places GROUP BY r),
counted AS (
  SELECT doc_id, source, len(w) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN dups USING (r) LEFT JOIN repeats USING (r)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted),
failures AS (
  SELECT source, unnest([
    {{'rule': 'few_words', 'fails': n_words < 10}},
    {{'rule': 'repeats', 'fails': 100 * n_repeat_words > 20 * n_words}},
    {{'rule': 'symbols', 'fails': 100 * n_symbols > 10 * n_words}},
    {{'rule': 'lines', 'fails': 100 * n_dup_lines > 5 * n_words}}], recursive := true)
  FROM judged WHERE source IS NOT NULL),
hosts AS (SELECT source, rule, count(*) AS n, sum(CAST(fails AS BIGINT)) AS f FROM failures
  GROUP BY source, rule),
over AS (SELECT rule, avg(f / n) AS mean, avg((f / n) * (f / n)) AS square, avg(1 / n) AS inverse
  FROM hosts GROUP BY rule),
spread AS (
  SELECT rule, mean, square - mean * mean - mean * (1 - mean) * inverse AS between_hosts
  FROM over),
prior AS (SELECT rule, mean, CASE WHEN between_hosts > 0
  THEN greatest(mean * (1 - mean) / between_hosts - 1, 0) END AS weight FROM spread),
bounds AS (SELECT *, CASE WHEN weight IS NULL THEN {rules.HOST_RATES[1]} ELSE
  least(greatest(mean + {rules.TAIL} * sqrt(mean * (1 - mean) / (weight + 1)),
    {rules.HOST_RATES[0]}), {rules.HOST_RATES[1]}) END AS most FROM prior),
rates AS (
  SELECT source, bool_or(CASE WHEN weight IS NULL THEN mean
    ELSE (f + mean * weight) / (n + weight) END > most) AS rejected
  FROM hosts JOIN bounds USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM judged LEFT JOIN rates USING (source)""",
    "op7_substrings": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
runs AS (SELECT r, doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM docs, unnest(range(1, len(w) - 11)) AS t(i)),
least AS (SELECT s, min(doc_id) AS m FROM runs GROUP BY s),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 13)) AS p FROM runs JOIN least USING (s)
  WHERE doc_id > m),
words AS (SELECT r, p, w[p] AS word FROM docs, unnest(range(1, len(w) + 1)) AS t(p)),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (r, p)
  GROUP BY r),
cut AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(cut.n, 0) AS n_removed,
  sha256(coalesce(kept.t, '')) AS kept_sha256
FROM docs LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)""",
    "op11_negatives": f"""
WITH named AS (SELECT row_number() OVER () AS r, vec_id,
  CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding FROM embeddings),
v AS (SELECT r, vec_id, label,
  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM named
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a JOIN v AS b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
near AS (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) AS place
  FROM scored WHERE same),
windows AS (SELECT anchor, anchor_id, place, id AS positive_id, score AS positive_score FROM near
  WHERE place <= {negatives.POSITIVES}),
fits AS (
  SELECT w.*, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY w.anchor, w.place ORDER BY s.score DESC, s.id) AS rank
  FROM windows AS w JOIN scored AS s ON s.anchor = w.anchor AND NOT s.same
    AND {negatives.LOW} * positive_score <= 100 * s.score
    AND 100 * s.score <= {negatives.HIGH} * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM fits
WHERE rank <= {negatives.NEGATIVES}""",
}

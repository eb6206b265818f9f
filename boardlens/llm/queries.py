"""The registered queries of this subpackage, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boardlens.llm.common import table, written
from boardlens.llm.conversation_repair import damaged, repair, report, summaries
from boardlens.llm.exact_dedup import exact_duplicates
from boardlens.llm.host_reputation import judge
from boardlens.llm.language_id import fit_languages, identify
from boardlens.llm.mixing import fit_domains, fit_mixture, memberships, repeats
from boardlens.llm.near_minhash import near_duplicates
from boardlens.llm.near_vectors import near_vectors
from boardlens.llm.packing import pack
from boardlens.llm.quality import fit_quality, score_quality
from boardlens.llm.secret_scan import digest, secrets
from boardlens.llm.token_alignment import align_documents
from boardlens.llm.topk import quantised, top_k
from boardlens.llm.toxicity import fit_toxicity, score_toxicity

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query(
    "op7_minhash_near_dedup",
    r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, list_filter(string_split_regex(coalesce(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ''),
                   '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
        FROM documents
    ), g AS (
        SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN generate_series(1, len(w) - 4)] END) AS g
        FROM w
    ), s AS (SELECT doc_id, len(g) AS n, unnest(g) AS shingle FROM g),
    l AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
    ), r(id, root) AS (
        SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b
    ), c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id)
    SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM g JOIN c ON id = doc_id
    """,
)
def minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op4_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
        WHERE label IS NOT NULL AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
          AND list_bool_or([x <> 0 FOR x IN embedding])
    ), l AS (
        SELECT a.vec_id AS a, b.vec_id AS b
        FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
        WHERE list_cosine_similarity(a.e, b.e) >= 0.98
    ), r(id, root) AS (
        SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.root FROM r JOIN l ON l.a = r.id WHERE r.root < l.b
    ), c AS (SELECT id, min(root) AS component_id FROM r GROUP BY id),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN c ON id = vec_id LEFT JOIN n ON a = vec_id
    """,
)
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query(
    "op1_topk_maxscore",
    """
    WITH v AS (
        SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND list_bool_and([x IS NOT NULL AND isfinite(x) FOR x IN embedding])
    ), s AS (
        SELECT a.vec_id AS query_id, b.vec_id,
               CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(b.q AS DOUBLE[])) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
    )
    SELECT query_id,
           CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM s QUALIFY rank <= 20
    """,
)
def topk_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.filter("id % 20 = 0"), 20)


@query("op5_secret_scan")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is a repository, each source an owner."""
    return digest(secrets(table(spark, sf_dir, "documents")))


@query("op8_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, fit_languages(docs))


@query("op9_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query("op10_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op2_mixing")
def mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domains are the kinds of labelled documents; rates move the corpus to 85 % good tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_domains(docs, domains_of(table(spark, sf_dir, "labels")))
    rows = written(memberships(docs, model))
    mixture = fit_mixture(rows, model, {"good": 0.85, "poor": 0.1, "toxic": 0.05})
    return rows.withColumn("rate", mixture.rate()).select(
        "doc_id",
        F.col("__tokens").alias("tokens"),
        *[F.element_at("__p", i + 1).alias(f"p_{d}") for i, d in enumerate(model.domains)],
        "rate",
        repeats(F.col("rate"), F.col("doc_id").cast("string")).alias("copies"),
        *[F.lit(t).alias(f"target_{d}") for d, t in zip(mixture.domains, mixture.targets, strict=True)],
        F.lit(mixture.met).alias("targets_met"),
    )


def domains_of(labels: DataFrame) -> DataFrame:
    """doc_id, domain: toxic, else good or poor by quality; without both labels none."""
    kind = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return labels.select("doc_id", kind.alias("domain")).filter(F.col("domain").isNotNull())


@query("op3_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_LEVEL = """
    {name}_m AS (
        SELECT 1 / least(greatest(
            coalesce((sum(n * (bad / n - above) * (bad / n - above)) - sum(above * (1 - above)))
                     / nullif(sum(above * (1 - above) * (n - 1)), 0), 0.0001), 0.0001), 0.9) - 1 AS m
        FROM {name} WHERE n > 0
    )"""


@query(
    "op6_host_reputation",
    rf"""
    WITH r AS (
        SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
    ), p AS (
        SELECT page_id,
               coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM r
    ), o AS (
        SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
    ), c AS (
        SELECT host, string_split(regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '\.$', ''), '.') AS l,
               count(bad) AS n, coalesce(sum(bad), 0) AS bad
        FROM p LEFT JOIN o ON page_id = doc_id GROUP BY host
    ), c2 AS (
        SELECT *, array_to_string(l[-2:], '.') IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') AS two FROM c
    ), counts AS (
        SELECT host, n, bad, array_to_string(CASE WHEN two THEN l[-3:] ELSE l[-2:] END, '.') AS domain,
               array_to_string(CASE WHEN two THEN l[-2:] ELSE l[-1:] END, '.') AS suffix
        FROM c2
    ), s AS (
        SELECT suffix, sum(n) AS n, sum(bad) AS bad,
               ((SELECT sum(bad) FROM counts) + 0.5) / ((SELECT sum(n) FROM counts) + 1.0) AS above
        FROM counts GROUP BY suffix
    ), {_LEVEL.format(name="s")}, d AS (
        SELECT domain, suffix, sum(counts.n) AS n, sum(counts.bad) AS bad, any_value((m * above + s.bad) / (m + s.n)) AS above
        FROM counts JOIN s USING (suffix), s_m GROUP BY domain, suffix
    ), {_LEVEL.format(name="d")}, h AS (
        SELECT host, counts.n, counts.bad, (m * above + d.bad) / (m + d.n) AS above
        FROM counts JOIN d USING (domain, suffix), d_m
    ), {_LEVEL.format(name="h")}, post AS (
        SELECT host, (m * above + bad) / (m + n) AS mean, m + n AS weight FROM h, h_m
    ), ruled AS (
        SELECT p.*, CASE
            WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
        FROM p
    )
    SELECT page_id, host, path, rule,
           CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
                WHEN mean + 1.6448536269514722 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled JOIN post USING (host)
    """,
)
def host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of pages are the labels of equal number: bad if poor or toxic."""
    labels = table(spark, sf_dir, "labels")
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


@query(
    "op13_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return report(rows, summaries(repair(damaged(rows))))


@query("op11_token_alignment")
def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_documents(table(spark, sf_dir, "documents"), *files)

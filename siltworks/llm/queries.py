"""The registered queries of the training-data problems, with their production parameters and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import abuse, clusters, langid, leak, mixing, packing, pairs, quota, repetition, reservoir, tokens
from siltworks.session import spread

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


#: Size of the sample of problem 1.
SAMPLE_ROWS = 10_000
_CELL = ("domain", "difficulty")


def p1_sample(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id): a fixed number of distinct prompts, each with the same chance."""
    p = _table(spark, sf, "prompts").select("prompt_id", "rec_no", "shard")
    return reservoir.reservoir_sample(p, "prompt_id", "rec_no", "shard", k=SAMPLE_ROWS)


def p1_by_shard(spark: SparkSession, sf: str) -> DataFrame:
    """Of each shard: the prompts that first came with it and those in the sample."""
    p = _table(spark, sf, "prompts").select("prompt_id", "rec_no", "shard")
    first = p.where("prompt_id is not null").groupBy("prompt_id").agg(F.min_by("shard", "rec_no").alias("shard"))
    sample = reservoir.reservoir_sample(p, "prompt_id", "rec_no", "shard", k=SAMPLE_ROWS).withColumn("taken", F.lit(1))
    return first.join(sample, "prompt_id", "left").groupBy("shard").agg(F.count("*").alias("n_prompts"), F.sum(F.coalesce("taken", F.lit(0))).alias("n_sampled"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    """(response_id, defect): the defective responses."""
    r = _table(spark, sf, "responses").select("response_id", "prompt", "response", "reasoning", "answer")
    return pairs.primary_defects(spread(r))


def p2_defects(spark: SparkSession, sf: str) -> DataFrame:
    """(response_id, rank, defect): every defect that a response triggers, in the order of the rules."""
    r = _table(spark, sf, "responses").select("response_id", "prompt", "response", "reasoning", "answer")
    return pairs.broken_pairs(spread(r))


def p2_by_teacher(spark: SparkSession, sf: str) -> DataFrame:
    """Defects of each kind by teacher model."""
    r = _table(spark, sf, "responses")
    d = pairs.primary_defects(spread(r.select("response_id", "prompt", "response", "reasoning", "answer")))
    model = r.groupBy("response_id").agg(F.min("teacher_model").alias("teacher_model"))
    return model.join(d, "response_id", "left").groupBy("teacher_model", F.coalesce("defect", F.lit("none")).alias("defect")).agg(F.count("*").alias("n_responses"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """(domain, difficulty): the cells of the targets that cannot be met."""
    c = _table(spark, sf, "clustered_prompts").select("prompt_id", *_CELL)
    _, report = quota.quota_sample(c, "prompt_id", _CELL, _table(spark, sf, "quota_targets"))
    return report.where("exhausted").select(*_CELL)


def p3_sample(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id, domain, difficulty): a quarter of the prompts in the target shares."""
    c = _table(spark, sf, "clustered_prompts").select("prompt_id", *_CELL)
    return quota.quota_sample(c, "prompt_id", _CELL, _table(spark, sf, "quota_targets"))[0]


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """The targets with what is there, what was taken and the share reached."""
    c = _table(spark, sf, "clustered_prompts").select("prompt_id", *_CELL)
    report = quota.quota_sample(c, "prompt_id", _CELL, _table(spark, sf, "quota_targets"))[1]
    return report.withColumns({"wanted": F.round("wanted", 6), "share": F.round("share", 6)})


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id, item_id): the prompts that contain a test item and the item."""
    p = _table(spark, sf, "prompts").select("prompt_id", "prompt")
    e = _table(spark, sf, "eval_items").select("item_id", "question")
    return leak.leaked(spread(p), "prompt_id", "prompt", e, "item_id", "question").select("prompt_id", "item_id")


def p4_items(spark: SparkSession, sf: str) -> DataFrame:
    """Of each leaked item: the prompts it leaked into."""
    return p4_found(spark, sf).groupBy("item_id").agg(F.count("*").alias("n_prompts"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    """(response_id): the responses of which the response or the reasoning repeats itself."""
    r = _table(spark, sf, "responses").select("response_id", "response", "reasoning")
    return repetition.repetitive(spread(r), "response_id", ("response", "reasoning"))


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    """(response_id, field, share): the share of repeated content of every text."""
    r = _table(spark, sf, "responses").select("response_id", "response", "reasoning")
    return repetition.repetition_shares(spread(r), "response_id", ("response", "reasoning")).select("response_id", "field", F.round("share", 4).alias("share"))


def _clusters(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.similarity_clusters(_table(spark, sf, "clustered_prompts").select("prompt_id", "prompt"), "prompt_id", "prompt")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id_a, prompt_id_b): the pairs of prompts of one group."""
    return clusters.cluster_pairs(_clusters(spark, sf), "prompt_id")


def p5_members(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id, cluster, strength): a row for each prompt of a group with its group and how firmly it belongs to it."""
    return _clusters(spark, sf).withColumn("strength", F.round("strength", 4))


def p5_clusters(spark: SparkSession, sf: str) -> DataFrame:
    """Each group with its size and its most typical prompts."""
    return clusters.cluster_summary(_clusters(spark, sf), "prompt_id")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """(prompt_id, language): the languages of the prompts that are mixed, unlabelled or labelled wrongly."""
    c = _table(spark, sf, "clustered_prompts").select("prompt_id", "prompt", "language")
    return langid.mislabelled(spread(c), "prompt_id", "prompt", "language", least_confidence=0.6)


def p6_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Each stretch of one language of each prompt with its confidence."""
    c = _table(spark, sf, "clustered_prompts").select("prompt_id", "prompt", "language")
    return langid.segment_languages(spread(c), "prompt_id", "prompt", "language").select("prompt_id", "start", "length", "language", F.round("confidence", 3).alias("confidence"))


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    d = spread(_table(spark, sf, "documents").select("doc_id", "text"))
    return packing.pack_containers(d.select("doc_id", tokens.token_count(F.col("text")).alias("size")), "doc_id", "size", _table(spark, sf, "pack_plan"), "plan_name", "capacity")


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    """(plan_name, doc_id, piece, container, tokens): the container of every document, or piece of one, in each plan."""
    return _packed(spark, sf)


def p8_fill(spark: SparkSession, sf: str) -> DataFrame:
    """Of each plan the containers and how full they are."""
    return packing.fill_rates(_packed(spark, sf), _table(spark, sf, "pack_plan"), "plan_name", "capacity").withColumn("fill", F.round("fill", 6))


def _mixed(spark: SparkSession, sf: str, **options: object) -> tuple[DataFrame, DataFrame]:
    d = spread(_table(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixing.mix(d, "doc_id", "text", "source", _table(spark, sf, "mix_targets"), **options)


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id, source, tokens, copies): the documents of the mixture and how often each is used."""
    return _mixed(spark, sf)[0]


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Of each source the target share and the share really reached."""
    return _mixed(spark, sf)[1].withColumn("share", F.round("share", 6))


def p9_full_mixture(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of a mixture as large as all listed sources, where scarce sources are repeated up to their caps."""
    return _mixed(spark, sf, total_tokens="all")[0]


def p9_full_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Of that mixture, the target share of each source, the share really reached and whether it is exhausted."""
    return _mixed(spark, sf, total_tokens="all")[1].withColumn("share", F.round("share", 6))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    """(doc_id): the documents with abusive, hateful or sexually explicit language."""
    d = _table(spark, sf, "documents").select("doc_id", "text")
    return abuse.abusive(spread(d), "doc_id", "text")


def p10_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The share of such documents by source."""
    d = _table(spark, sf, "documents").select("doc_id", "text", "source")
    return abuse.rates(spread(d), "doc_id", "text", "source").withColumn("rate", F.round("rate", 6))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that it can express; the others are tested against brute force or held-out rows."""
    cell = "lower(trim(domain)) AS d, lower(trim(difficulty)) AS x"
    counts = f"""WITH ids AS (SELECT prompt_id, least.d AS d, least.x AS x FROM (SELECT prompt_id, min({{'d': d, 'x': x}}) AS least FROM (SELECT prompt_id, {cell} FROM clustered_prompts WHERE prompt_id IS NOT NULL) GROUP BY prompt_id)),
c AS (SELECT d, x, count(*) AS available FROM ids GROUP BY d, x),
t AS (SELECT q.domain, q.difficulty, q.target_share, q.min_rows, coalesce(c.available, 0) AS available, q.target_share * (SELECT count(*) // 4 FROM ids) AS wanted, (SELECT count(*) // 4 FROM ids) AS n
  FROM (SELECT *, {cell} FROM quota_targets) q LEFT JOIN c ON q.d = c.d AND q.x = c.x)"""
    quotas = """, b AS (SELECT *, floor(wanted)::BIGINT AS base, row_number() OVER (ORDER BY floor(wanted) - wanted, concat(lower(trim(domain)), chr(31), lower(trim(difficulty)))) AS place FROM t),
s AS (SELECT round(least(sum(wanted), max(n)))::BIGINT - sum(base) AS spare FROM b),
q AS (SELECT b.*, least(available, greatest(coalesce(min_rows, 0), base + CASE WHEN place <= spare THEN 1 ELSE 0 END)) AS taken FROM b, s)
SELECT domain, difficulty, target_share, min_rows, available, round(wanted, 6) AS wanted, taken, round(taken / greatest(1, sum(taken) OVER ()), 6) AS share, available < min_rows OR available < wanted AS exhausted FROM q"""
    return {"p3_found": f"{counts} SELECT domain, difficulty FROM t WHERE available < min_rows OR available < wanted", "p3_report": counts + quotas}

"""Registered queries of the engine's own operators, each with the SQL that gives the same result where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.functions import labels, scores, text
from siltworks.operators import decontam, external, filters, parse, relations, sampling, state, stats, vectors
from siltworks.session import spread
from siltworks.sources import files

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

#: Words of the project's own vocabulary as keywords, since its texts are invented.
POOL_KEYWORDS = {"math": ["fraction", "sequence", "root"], "code": ["cache", "thread", "parser"], "science": ["reactor", "membrane", "lens"], "language": ["pronoun", "suffix", "verb"]}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# SQL fragments that several statements share.
_WORDS = r"list_filter(regexp_split_to_array(coalesce({c}, ''), '[\s\pZ]+'), lambda w: w <> '')"
_STRIP = r"regexp_replace({c}, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')"
_MATCH = r"list_filter(string_split(regexp_replace(lower(coalesce({c}, '')), '[^\pL\pN]+', ' ', 'g'), ' '), lambda w: w <> '')"


def _words(c: str) -> str:
    return _WORDS.replace("{c}", c)


def _strip(c: str) -> str:
    return _STRIP.replace("{c}", c)


def _match(c: str) -> str:
    return _MATCH.replace("{c}", c)


_RESPONSES = "(SELECT DISTINCT response_id, prompt_id, prompt, domain, response, reasoning, answer, teacher_model FROM responses)"


def _responses(spark: SparkSession, sf: str) -> DataFrame:
    return _t(spark, sf, "responses").select("response_id", "prompt_id", "prompt", "domain", "response", "reasoning", "answer", "teacher_model").distinct()


# --- Normal forms and identity -------------------------------------------------------------------------------------------


@query("nrm1_collapse", rf"SELECT rec_no, trim(regexp_replace(prompt, '[\s\pZ]+', ' ', 'g')) AS text FROM prompts")
def _(spark, sf):
    return _t(spark, sf, "prompts").select("rec_no", text.normalise(F.col("prompt"), compat=False).alias("text"))


@query("nrm1_normalise")
def _(spark, sf):
    p = text.with_normal_form(spread(_t(spark, sf, "prompts").select("rec_no", "prompt")), "prompt")
    return p.select("rec_no", text.collapse(F.col("prompt")).alias("text"))


@query("nrm2_match_words", f"SELECT item_id, len(t) AS n_words, array_to_string(t, ' ') AS words FROM (SELECT item_id, {_match('question')} AS t FROM eval_items)")
def _(spark, sf):
    t = _t(spark, sf, "eval_items").select("item_id", text.match_words(F.col("question")).alias("t"))
    return t.select("item_id", F.size("t").cast("long").alias("n_words"), F.array_join("t", " ").alias("words"))


@query("nrm3_content_id", "SELECT rec_no, concat('sha256:', substr(sha256(prompt), 1, 32)) AS id FROM prompts")
def _(spark, sf):
    return _t(spark, sf, "prompts").select("rec_no", text.content_id(F.col("prompt")).alias("id"))


@query("nrm4_file_slug", "SELECT DISTINCT substr(replace(replace(source, '/', '_'), ':', '_'), 1, 120) AS slug FROM prompts WHERE source IS NOT NULL")
def _(spark, sf):
    return _t(spark, sf, "prompts").where("source is not null").select(text.file_slug(F.col("source")).alias("slug")).distinct()


@query("nrm5_last_words", f"SELECT doc_id, CASE WHEN len({_words('text')}) <= 100 THEN text ELSE array_to_string({_words('text')}[-100:], ' ') END AS tail FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    return _t(spark, sf, "documents").where("text is not null").select("doc_id", text.last_words(F.col("text"), 100).alias("tail"))


@query("nrm6_first_words", f"SELECT doc_id, CASE WHEN len(w) <= 50 THEN text ELSE concat(array_to_string(w[1:50], ' '), chr(10), '… [truncated — ', len(w) - 50, ' more words]') END AS head FROM (SELECT doc_id, text, {_words('text')} AS w FROM documents WHERE text IS NOT NULL)")
def _(spark, sf):
    return _t(spark, sf, "documents").where("text is not null").select("doc_id", text.first_words(F.col("text"), 50).alias("head"))


@query("lim2_shorten", "SELECT prompt_id, clustered_at, CASE WHEN length(s) > 120 THEN concat(substr(s, 1, 120), '…') ELSE s END AS shown FROM (SELECT prompt_id, clustered_at, coalesce(nullif(summary, ''), prompt) AS s FROM clustered_prompts)")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts")
    return c.select("prompt_id", "clustered_at", text.shorten(F.coalesce(text.nonempty(F.col("summary")), "prompt")).alias("shown"))


# --- Scans, caps, dedup, set operations ----------------------------------------------------------------------------------


@query("src7_cap_per_source", f"SELECT rec_no, source FROM (SELECT rec_no, source, prompt, row_number() OVER (PARTITION BY source ORDER BY rec_no) AS r FROM prompts WHERE {_strip("coalesce(prompt, '')")} <> '') WHERE r <= 20 AND length(trim(prompt)) >= 10")
def _(spark, sf):
    # Only rows with a prompt count towards the cap; the length filter comes after it.
    p = _t(spark, sf, "prompts").where(~text.is_blank(F.col("prompt"))).select("rec_no", "source", "prompt")
    return relations.cap_per_group(p, "source", ["rec_no"], 20).where(filters.long_enough(F.col("prompt"), 10)).select("rec_no", "source")


@query("src8_record_ids", "SELECT doc_id, concat('documents:', substr(md5(substr(text, 1, 100)), 1, 8)) AS tag FROM documents WHERE length(text) > 100")
def _(spark, sf):
    return _t(spark, sf, "documents").where(F.length("text") > 100).select("doc_id", files.record_id(F.lit("documents"), F.col("text")).alias("tag"))


@query("src10_eval_texts", f"SELECT item_id AS owner, field_no, text FROM (SELECT item_id, 0::BIGINT AS field_no, {_strip('question')} AS text FROM eval_items UNION ALL SELECT item_id, 1, array_to_string(list_filter(list_transform(choices, lambda x: trim(x)), lambda x: x <> ''), ' ') FROM eval_items) WHERE text <> ''")
def _(spark, sf):
    e = files.eval_texts(_t(spark, sf, "eval_items"), "item_id", "item_id", ["question", "choices"])
    return e.select("owner", F.col("field_no").cast("long").alias("field_no"), "text")


@query("src12_embedding_scan", "SELECT vec_id, len(embedding) AS dims, label FROM embeddings")
def _(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", F.size("embedding").cast("long").alias("dims"), "label")


@query("agg1_first_per_id", "SELECT rec_no, prompt_id, source FROM prompts QUALIFY row_number() OVER (PARTITION BY prompt_id ORDER BY rec_no) = 1")
def _(spark, sf):
    return relations.first_per_key(_t(spark, sf, "prompts").select("rec_no", "prompt_id", "source"), "prompt_id", ["rec_no"])


@query("agg2_dedup_rate", "SELECT source, count(*) AS seen, count(DISTINCT prompt_id) AS kept, round(100 * (1 - count(DISTINCT prompt_id) / count(*)), 6) AS rate FROM prompts GROUP BY source")
def _(spark, sf):
    return relations.dedup_rates(_t(spark, sf, "prompts"), "prompt_id", "source").withColumn("rate", F.round("rate", 6))


@query("flt1_min_length", "SELECT rec_no, length(trim(prompt)) >= 20 AS generated_ok FROM prompts WHERE length(trim(prompt)) >= 10")
def _(spark, sf):
    p = _t(spark, sf, "prompts").where(filters.long_enough(F.col("prompt"), 10))
    return p.select("rec_no", filters.long_enough(F.col("prompt"), 20).alias("generated_ok"))


@query("jn1_not_yet_done", "SELECT DISTINCT prompt_id FROM prompts WHERE prompt_id NOT IN (SELECT prompt_id FROM responses WHERE prompt_id IS NOT NULL)")
def _(spark, sf):
    return relations.not_yet_done(_t(spark, sf, "prompts").select("prompt_id"), _t(spark, sf, "responses"), "prompt_id").distinct()


@query("set1_union_stages", "SELECT prompt_id, prompt, NULL AS difficulty, 'pool' AS tag FROM prompts UNION ALL SELECT prompt_id, prompt, difficulty, 'clustered' FROM clustered_prompts")
def _(spark, sf):
    a = _t(spark, sf, "prompts").select("prompt_id", "prompt", F.lit("pool").alias("tag"))
    b = _t(spark, sf, "clustered_prompts").select("prompt_id", "prompt", "difficulty", F.lit("clustered").alias("tag"))
    return relations.union_all(a, b).select("prompt_id", "prompt", "difficulty", "tag")


@query("set2_union_distinct", "SELECT prompt_id, min(stage) AS stage FROM (SELECT prompt_id, stage FROM prompts UNION ALL SELECT prompt_id, stage FROM clustered_prompts) GROUP BY prompt_id")
def _(spark, sf):
    both = relations.union_all(*[_t(spark, sf, n).select("prompt_id", "stage") for n in ("prompts", "clustered_prompts")])
    return relations.first_per_key(both, "prompt_id", ["stage"])


@query("set3_token_sets", f"SELECT response_id, len(list_intersect(r, a)) AS shared, len(list_filter(a, lambda w: NOT list_contains(r, w))) AS only_answer FROM (SELECT response_id, list_distinct({_words('lower(reasoning)')}) AS r, list_distinct({_words('lower(answer)')}) AS a FROM {_RESPONSES})")
def _(spark, sf):
    r, a = (F.array_distinct(text.words(F.lower(c))) for c in ("reasoning", "answer"))
    return _responses(spark, sf).select("response_id", F.size(F.array_intersect(r, a)).cast("long").alias("shared"), F.size(F.array_except(a, r)).cast("long").alias("only_answer"))


@query("jn3_cluster_lookup", "SELECT p.rec_no, coalesce(c.cluster_id, -1) AS cluster_id, coalesce(c.centroid_sim, 0.5) AS centroid_sim FROM prompts p LEFT JOIN (SELECT prompt_id, r.cluster_id AS cluster_id, r.centroid_sim AS centroid_sim FROM (SELECT prompt_id, max({'cluster_id': coalesce(cluster_id, -9), 'centroid_sim': coalesce(centroid_sim, -9)}) AS r FROM clustered_prompts GROUP BY prompt_id)) c USING (prompt_id)")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts").select("prompt_id", F.coalesce("cluster_id", F.lit(-9)).alias("cluster_id"), F.coalesce(F.col("centroid_sim").cast("double"), F.lit(-9.0)).alias("centroid_sim"))
    return relations.with_cluster(_t(spark, sf, "prompts").select("rec_no", "prompt_id"), c, "prompt_id").select("rec_no", "cluster_id", "centroid_sim")


@query("jn4_overlay", "SELECT p.rec_no, coalesce(nullif(c.domain, ''), nullif(p.domain, ''), 'general') AS domain, coalesce(nullif(c.difficulty, ''), 'medium') AS difficulty FROM prompts p LEFT JOIN (SELECT prompt_id, min(domain) AS domain, min(difficulty) AS difficulty FROM clustered_prompts GROUP BY prompt_id) c USING (prompt_id)")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts").groupBy("prompt_id").agg(F.min("domain").alias("domain"), F.min("difficulty").alias("difficulty"))
    out = relations.overlay(_t(spark, sf, "prompts").select("rec_no", "prompt_id", "domain"), c, "prompt_id", {"domain": F.lit("general"), "difficulty": F.lit("medium")})
    return out.select("rec_no", "domain", "difficulty")


@query("jn5_join_counts", "SELECT count(*) AS n, count(CASE WHEN r.prompt_id IS NULL THEN 1 END) AS missing, count(CASE WHEN r.prompt_id IS NOT NULL AND r.has_text = 0 THEN 1 END) AS empty FROM (SELECT DISTINCT prompt_id FROM clustered_prompts) c LEFT JOIN (SELECT prompt_id, max(CASE WHEN trim(coalesce(response, '')) <> '' THEN 1 ELSE 0 END) AS has_text FROM responses GROUP BY prompt_id) r USING (prompt_id)")
def _(spark, sf):
    r = _t(spark, sf, "responses").groupBy("prompt_id").agg(F.max(F.when(F.trim(F.coalesce("response", F.lit(""))) != "", 1).otherwise(0)).alias("has_text"))
    j = _t(spark, sf, "clustered_prompts").select("prompt_id").distinct().join(r, "prompt_id", "left")
    return j.agg(F.count("*").alias("n"), F.count(F.when(F.col("has_text").isNull(), 1)).alias("missing"), F.count(F.when(F.col("has_text") == 0, 1)).alias("empty"))


@query("jn15_semi_join", "SELECT doc_id FROM documents WHERE source IN (SELECT source FROM mix_targets)")
def _(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", "source").join(_t(spark, sf, "mix_targets").select("source"), "source", "left_semi").select("doc_id")


_EVENTS_SQL = "(SELECT stage, 'started' AS status, min(rec_no) AS seq FROM prompts GROUP BY stage UNION ALL SELECT stage, 'complete', max(rec_no) FROM prompts GROUP BY stage UNION ALL SELECT 'stage3', CASE WHEN cluster_id IS NULL THEN 'failed' ELSE 'started' END, count(*) FROM clustered_prompts GROUP BY ALL)"


def _events(spark, sf):
    """Stage events read off the tables: a stage's first row starts it, its last completes it; stage 3 also fails."""
    p, c = _t(spark, sf, "prompts"), _t(spark, sf, "clustered_prompts")
    event = lambda d, status, seq: d.groupBy("stage").agg(seq.alias("seq")).select("stage", F.lit(status).alias("status"), "seq")
    third = c.groupBy(F.when(F.col("cluster_id").isNull(), "failed").otherwise("started").alias("status")).agg(F.count("*").alias("seq"))
    return event(p, "started", F.min("rec_no")).unionAll(event(p, "complete", F.max("rec_no"))).unionAll(third.select(F.lit("stage3").alias("stage"), "status", "seq"))


@query("sta1_stage_states", f"SELECT stage, arg_max(status, (seq, status)) AS status, max(seq) AS seq FROM {_EVENTS_SQL} WHERE stage IS NOT NULL GROUP BY stage")
def _(spark, sf):
    return state.current(_events(spark, sf), ["stage"], "seq").select("stage", "status", "seq")


@query("sta2_complete_stages", f"SELECT stage FROM (SELECT stage, arg_max(status, (seq, status)) AS status FROM {_EVENTS_SQL} WHERE stage IS NOT NULL GROUP BY stage) WHERE status = 'complete' ORDER BY stage")
def _(spark, sf):
    return state.current(_events(spark, sf), ["stage"], "seq").where("status = 'complete'").select("stage").orderBy("stage")


@query("sta4_pending_items", f"WITH l AS (SELECT prompt_id, CASE WHEN {_strip("coalesce(response, '')")} = '' THEN 'failed' WHEN answer IS NULL THEN 'skipped' ELSE 'success' END AS status, response_id AS seq FROM responses) SELECT DISTINCT prompt_id FROM clustered_prompts WHERE prompt_id NOT IN (SELECT prompt_id FROM (SELECT prompt_id, arg_max(status, (seq, status)) AS s FROM l GROUP BY prompt_id) WHERE s IN ('success', 'skipped'))")
def _(spark, sf):
    status = F.when(text.is_blank(F.col("response")), "failed").when(F.col("answer").isNull(), "skipped").otherwise("success")
    ledger = _t(spark, sf, "responses").select("prompt_id", status.alias("status"), F.col("response_id").alias("seq"))
    return state.pending(_t(spark, sf, "clustered_prompts").select("prompt_id").distinct(), ledger, "prompt_id")


@query("sta5_shard_manifest", "WITH m AS (SELECT shard, max(rec_no) AS seq FROM prompts WHERE stage = 'stage1' GROUP BY shard) SELECT shard, seq FROM m UNION ALL SELECT shard, min(rec_no) FROM prompts WHERE shard NOT IN (SELECT shard FROM m) GROUP BY shard")
def _(spark, sf):
    p = _t(spark, sf, "prompts")
    known = p.where("stage = 'stage1'").groupBy("shard").agg(F.max("rec_no").alias("seq"))
    return state.register(known, p.select("shard", F.col("rec_no").alias("seq")), "shard", "seq")


@query("sta6_merged_ledger", "SELECT 'n_input' AS name, count(*) AS value FROM prompts UNION ALL SELECT 'n_short', count(CASE WHEN length(prompt) < 100 THEN 1 END) FROM prompts")
def _(spark, sf):
    per = _t(spark, sf, "prompts").groupBy("shard").agg(F.count("*").alias("n_input"), F.count_if(F.length("prompt") < 100).alias("n_short"))
    ledger = per.unpivot("shard", ["n_input", "n_short"], "name", "value")
    # Every entry twice, as after a task that was redone.
    return state.merged_counters(ledger.unionAll(ledger))


@query("set4_missing_ids", "SELECT DISTINCT prompt_id FROM clustered_prompts WHERE prompt_id IS NOT NULL AND prompt_id NOT IN (SELECT prompt_id FROM responses WHERE prompt_id IS NOT NULL)")
def _(spark, sf):
    return state.missing(_t(spark, sf, "clustered_prompts"), _t(spark, sf, "responses"), "prompt_id")


@query("sta3_latest_state", "SELECT response_id, max(generated_at) AS generated_at FROM responses GROUP BY response_id")
def _(spark, sf):
    ledger = _t(spark, sf, "responses").select("response_id", "generated_at", F.col("generated_at").alias("at"))
    return relations.latest_state(ledger, "response_id", "at").select("response_id", "generated_at")


# --- Extraction and parsing ----------------------------------------------------------------------------------------------

_DELIMITED = r"regexp_extract(t, '(?s)<think>(.*?)</think>', 1)"
_MARK = r"(?is)^(.*)(\b(?:therefore|thus|in conclusion|hence|so,|the answer is|final answer:?|in summary|to summarize)\b.*)$"
_SENT = r"(?s)^(.*[.!?])[\s\pZ]+(.*)$"
_PARSE_SQL = rf"""
WITH base AS (SELECT response_id, {_strip("coalesce(response, '')")} AS t FROM {_RESPONSES}),
parts AS (SELECT *, regexp_matches(t, '(?s)<think>.*?</think>') AS ht, regexp_matches(t, '(?s)<answer>.*?</answer>') AS ha,
  {_strip("regexp_extract(t, '(?s)<think>(.*?)</think>', 1)")} AS th, {_strip("regexp_extract(t, '(?s)<answer>(.*?)</answer>', 1)")} AS an,
  {_strip("regexp_extract(t, '(?s)<think>.*?</think>(.*)$', 1)")} AS tail,
  {_strip(f"regexp_extract(t, '{_MARK}', 1)")} AS before, {_strip(f"regexp_extract(t, '{_MARK}', 2)")} AS after,
  {_strip(f"regexp_extract(t, '{_SENT}', 1)")} AS body, {_strip(f"regexp_extract(t, '{_SENT}', 2)")} AS last FROM base),
kind AS (SELECT *, CASE WHEN ht AND ha THEN 1 WHEN ht AND tail <> '' THEN 2 WHEN before <> '' AND after <> '' THEN 3 WHEN body <> '' AND last <> '' THEN 4 ELSE 5 END AS k FROM parts)
SELECT response_id, CASE k WHEN 1 THEN th WHEN 2 THEN th WHEN 3 THEN before WHEN 4 THEN body ELSE t END AS reasoning,
  CASE k WHEN 1 THEN an WHEN 2 THEN tail WHEN 3 THEN after WHEN 4 THEN last ELSE '' END AS answer, k > 2 AS fallback, k < 5 AS valid FROM kind"""


@query("prs1_parse_response", _PARSE_SQL)
def _(spark, sf):
    return _responses(spark, sf).select("response_id", parse.parse_response(F.col("response")).alias("p")).select("response_id", "p.*")


@query("prs2_parse_missing", f"""WITH p AS ({_PARSE_SQL}) SELECT r.response_id, CASE WHEN {_strip("coalesce(r.response, '')")} <> '' AND coalesce(r.reasoning, '') = '' AND coalesce(r.answer, '') = '' THEN p.reasoning ELSE r.reasoning END AS reasoning,
CASE WHEN {_strip("coalesce(r.response, '')")} <> '' AND coalesce(r.reasoning, '') = '' AND coalesce(r.answer, '') = '' THEN p.answer ELSE r.answer END AS answer FROM {_RESPONSES} r JOIN p USING (response_id)""")
def _(spark, sf):
    return parse.with_parsed(_responses(spark, sf)).select("response_id", "reasoning", "answer")


def _candidates(spark, sf):
    r = _responses(spark, sf).where("response is not null").groupBy("prompt_id").agg(F.array_sort(F.collect_list(F.struct("response_id", "response"))).alias("c"))
    return r.select("prompt_id", F.transform("c", lambda x: x["response"]).alias("c"))


@query("prs4_longest_candidate", f"SELECT prompt_id, arg_max(response, (length(response), -response_id)) AS response FROM {_RESPONSES} WHERE response IS NOT NULL GROUP BY prompt_id")
def _(spark, sf):
    return _candidates(spark, sf).select("prompt_id", parse.longest_candidate(F.col("c")).alias("response"))


@query("prs3_best_candidate", f"""WITH p AS ({_PARSE_SQL}), k AS (SELECT r.prompt_id, r.response_id, r.response, p.valid AND p.reasoning <> '' AND p.answer <> '' AS good, p.* EXCLUDE (response_id) FROM {_RESPONSES} r JOIN p USING (response_id) WHERE r.response IS NOT NULL)
SELECT prompt_id, arg_max(response, (CASE WHEN good AND NOT fallback THEN 2 WHEN good THEN 1 ELSE 0 END, CASE WHEN good THEN length(reasoning) ELSE length(response) END, -response_id)) AS response FROM k GROUP BY prompt_id""")
def _(spark, sf):
    return _candidates(spark, sf).select("prompt_id", parse.best_candidate(F.col("c"))["text"].alias("response"))


@query("ext2_chat_values", r"SELECT rec_no, concat(coalesce(nullif(trim(source), ''), 'none'), chr(10), chr(10), regexp_replace(prompt, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) AS prompt FROM prompts WHERE trim(coalesce(prompt, '')) <> ''")
def _(spark, sf):
    p = _t(spark, sf, "prompts").where(F.trim(F.coalesce("prompt", F.lit(""))) != "")
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    source = F.coalesce(text.nonempty(F.trim("source")), F.lit("none"))
    chat = F.to_json(F.array(turn("system", source), turn("assistant", F.lit("hello")), turn("user", F.lit(" ")), turn("user", F.trim("prompt")), turn("user", F.lit("later"))))
    return p.select("rec_no", parse.prompt_of_value(chat).alias("prompt"))


@query("chk2_char_chunks", "SELECT doc_id, i AS chunk_no, substr(text, i * 448 + 1, 512) AS chunk FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 448)) AS i FROM documents WHERE length(text) > 0) WHERE length(regexp_replace(substr(text, i * 448 + 1, 512), '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')) > 50".replace("\\\\", "\\"))
def _(spark, sf):
    c = parse.chunk_documents(_t(spark, sf, "documents"), "doc_id", "text", size_tokens=128, overlap_tokens=16)
    return c.select("doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "chunk")


@query("chk3_chunk_ids", "SELECT doc_id, printf('%d:chunk_%04d', doc_id, i) AS chunk_id, substr(sha256(printf('%d:chunk_%04d', doc_id, i)), 1, 32) AS chunk_hash FROM (SELECT doc_id, text, unnest(generate_series(0, (length(text) - 1) // 448)) AS i FROM documents WHERE length(text) > 0) WHERE length(regexp_replace(substr(text, i * 448 + 1, 512), '^[\\s\\pZ]+|[\\s\\pZ]+$', '', 'g')) > 50".replace("\\\\", "\\"))
def _(spark, sf):
    return parse.chunk_documents(_t(spark, sf, "documents"), "doc_id", "text", size_tokens=128, overlap_tokens=16).select("doc_id", "chunk_id", "chunk_hash")


@query("prs7_annotations", "SELECT DISTINCT prompt_id, CASE WHEN domain IN ('math', 'code', 'science', 'reasoning', 'writing', 'language', 'knowledge', 'instruction', 'other') THEN domain ELSE 'other' END AS domain, CASE WHEN difficulty IN ('easy', 'medium', 'hard') THEN difficulty ELSE 'medium' END AS difficulty, CASE WHEN length(language) <= 10 THEN language ELSE 'en' END AS language, coalesce(array_to_string(topics, '|'), '') AS topics, coalesce(summary, '') AS summary FROM clustered_prompts")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts")
    said = F.concat(F.lit("<think>Let me see {not json}</think>\n```json\n"), F.to_json(F.struct("domain", "difficulty", "language", "topics", "summary")), F.lit("\n```"))
    a = c.select("prompt_id", parse.parse_annotation(said).alias("a"))
    return a.select("prompt_id", "a.domain", "a.difficulty", "a.language", F.array_join("a.topics", "|").alias("topics"), "a.summary").distinct()


@query("prs5_split_thought", rf"SELECT response_id, position('</think>' IN coalesce(response, '')) > 0 OR position('<think>' IN coalesce(response, '')) = 0 AS complete, CASE WHEN position('</think>' IN response) > 0 THEN {_strip("regexp_extract(response, '(?s)</think>(.*)$', 1)")} WHEN position('<think>' IN response) > 0 THEN '' ELSE {_strip("coalesce(response, '')")} END AS answer FROM {_RESPONSES}")
def _(spark, sf):
    return _responses(spark, sf).select("response_id", parse.split_thought(F.col("response")).alias("p")).select("response_id", "p.complete", "p.answer")


@query("prj1_chat_messages", "SELECT rec_no, to_json([{'role': 'user', 'content': prompt}])::VARCHAR AS messages FROM prompts WHERE prompt IS NOT NULL")
def _(spark, sf):
    return _t(spark, sf, "prompts").where("prompt is not null").select("rec_no", F.to_json(parse.chat_messages(F.col("prompt"))).alias("messages"))


# --- Labels and scores ---------------------------------------------------------------------------------------------------

_COUNT = lambda ks: " ".join(f"len(regexp_extract_all(coalesce(prompt, ''), '(?i){'|'.join(ks)}'))".split())


def _domain_sql(keywords: dict[str, list[str]]) -> str:
    scores_ = {d: _COUNT(ks) for d, ks in keywords.items()}
    top = f"greatest({', '.join(scores_.values())})"
    cases = " ".join(f"WHEN {s} = {top} AND {s} > 0 THEN '{d}'" for d, s in scores_.items())
    return f"SELECT rec_no, CASE {cases} ELSE 'general' END AS label FROM prompts"


@query("lbl1_prompt_domain", _domain_sql(POOL_KEYWORDS))
def _(spark, sf):
    return spread(_t(spark, sf, "prompts").select("rec_no", "prompt")).select("rec_no", labels.prompt_domain(F.col("prompt"), POOL_KEYWORDS).alias("label"))


@query("lbl1_prompt_domain_default", _domain_sql(labels.PROMPT_KEYWORDS))
def _(spark, sf):
    return spread(_t(spark, sf, "prompts").select("rec_no", "prompt")).select("rec_no", labels.prompt_domain(F.col("prompt")).alias("label"))


def _cluster_sql() -> str:
    n = lambda k: f"(length(t) - length(replace(t, '{k}', ''))) // {len(k)}"
    scores_ = {d: "(" + " + ".join(n(k) for k in ks) + ")" for d, ks in labels.CLUSTER_KEYWORDS.items()}
    cases = " ".join(f"WHEN s.{d} = m AND m > 0 THEN '{d}'" for d in scores_)
    fields = ", ".join(f"{s} AS {d}" for d, s in scores_.items())
    return f"""WITH first AS (SELECT cluster_id, lower(string_agg(prompt, ' ' ORDER BY prompt_id, clustered_at)) AS t FROM (SELECT * FROM clustered_prompts WHERE cluster_id >= 0 AND prompt IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY prompt_id, clustered_at) <= 50) GROUP BY cluster_id),
s AS (SELECT cluster_id, {fields} FROM first), b AS (SELECT *, greatest({', '.join(scores_)}) AS m FROM s)
SELECT cluster_id, CASE {cases.replace('s.', '')} ELSE 'other' END AS label FROM b"""


@query("lbl2_cluster_domain", _cluster_sql())
def _(spark, sf):
    c = relations.cap_per_group(_t(spark, sf, "clustered_prompts").where("cluster_id >= 0 and prompt is not null"), "cluster_id", ["prompt_id", "clustered_at"], 50)
    joined = c.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prompt_id", "clustered_at", "prompt"))), lambda x: x["prompt"]), " ").alias("t"))
    return joined.select("cluster_id", labels.cluster_domain(F.col("t")).alias("label"))


@query("lbl3_difficulty", rf"SELECT rec_no, CASE WHEN n >= 200 OR m THEN 'hard' WHEN n <= 50 THEN 'easy' ELSE 'medium' END AS label FROM (SELECT rec_no, len({_words('prompt')}) AS n, regexp_matches(coalesce(prompt, ''), '(?i){labels.MULTI_STEP}') AS m FROM prompts)")
def _(spark, sf):
    return _t(spark, sf, "prompts").select("rec_no", labels.difficulty(F.col("prompt")).alias("label"))


@query("scr1_segment_ttr", f"SELECT doc_id, round(CASE WHEN len(t) < 100 THEN len(list_distinct(t)) / len(t) ELSE list_avg(list_transform(generate_series(0, len(t) // 100 - 1), lambda i: len(list_distinct(t[i * 100 + 1 : i * 100 + 100])) / 100.0)) END, 6) AS ttr FROM (SELECT doc_id, {_words('lower(text)')} AS t FROM documents) WHERE len(t) > 0")
def _(spark, sf):
    d = spread(_t(spark, sf, "documents").select("doc_id", "text")).select("doc_id", F.round(scores.segment_ttr(text.words(F.lower("text"))), 6).alias("ttr"))
    return d.where("ttr is not null")


@query("scr2_top_gram", f"SELECT response_id, max(n) AS top FROM (SELECT response_id, g, count(*) AS n FROM (SELECT response_id, unnest(list_transform(generate_series(1, len(t) - 4), lambda i: array_to_string(t[i : i + 4], ' '))) AS g FROM (SELECT response_id, {_words('lower(response)')} AS t FROM {_RESPONSES}) WHERE len(t) >= 5) GROUP BY response_id, g) GROUP BY response_id")
def _(spark, sf):
    r = _responses(spark, sf).select("response_id", scores.top_gram_count(text.words(F.lower("response")), 5).cast("long").alias("top"))
    return r.where("top > 0")


_NEG = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in scores.NEGATIONS) + "]"


@query("scr3_contradiction", f"""SELECT response_id FROM (SELECT response_id, list_distinct({_words('lower(reasoning)')}) AS r, list_distinct({_words('lower(answer)')}) AS a FROM {_RESPONSES})
WHERE list_has_any(r, {_NEG}) <> list_has_any(a, {_NEG}) AND len(list_intersect(list_filter(r, lambda w: length(w) > 3 AND NOT list_contains({_NEG}, w)), list_filter(a, lambda w: length(w) > 3 AND NOT list_contains({_NEG}, w)))) >= 3""")
def _(spark, sf):
    return _responses(spark, sf).where(scores.contradicts(F.col("reasoning"), F.col("answer"))).select("response_id")


@query("scr4_boilerplate", f"SELECT response_id FROM {_RESPONSES} WHERE regexp_matches({_strip("coalesce(answer, '')")}, '(?i)" + scores.BOILERPLATE.replace("'", "''") + "')")
def _(spark, sf):
    return _responses(spark, sf).where(scores.boilerplate(F.col("answer"))).select("response_id")


_NUM = r"-?\d+(?:\.\d+)?(?:/\d+)?"
_CONCLUDED = rf"list_distinct(list_concat(flatten(list_transform(regexp_extract_all(coalesce(answer, ''), '\\boxed\{{([^{{}}]*(?:\{{[^{{}}]*\}}[^{{}}]*)*)\}}', 1), lambda x: regexp_extract_all(x, '{_NUM}'))), regexp_extract_all(coalesce(answer, ''), '(?m)=\s*({_NUM})\s*(?:$|[^\w])', 1)))"
_DISJOINT = f"""SELECT response_id, domain, c, k, list_transform(list_filter(c, lambda x: NOT contains(x, '/')), lambda x: x::DOUBLE) AS cv, list_transform(list_filter(k, lambda x: NOT contains(x, '/')), lambda x: x::DOUBLE) AS kv
FROM (SELECT response_id, domain, {_CONCLUDED} AS c, list_distinct(regexp_extract_all(coalesce(reasoning, ''), '{_NUM}')) AS k FROM {_RESPONSES})"""
_IS_DISJOINT = "len(c) > 0 AND len(k) > 0 AND NOT list_has_any(c, k) AND len(cv) > 0 AND len(kv) > 0 AND len(list_filter(cv, lambda x: len(list_filter(kv, lambda y: abs(x - y) < 1e-6)) > 0)) = 0"


@query("scr5_concluded_numbers", f"SELECT DISTINCT response_id, unnest({_CONCLUDED}) AS number FROM {_RESPONSES}")
def _(spark, sf):
    return _responses(spark, sf).select("response_id", F.explode(scores.concluded_numbers(F.col("answer"))).alias("number")).distinct()


@query("scr7_numbers_disjoint", f"SELECT response_id FROM ({_DISJOINT}) WHERE {_IS_DISJOINT}")
def _(spark, sf):
    return _responses(spark, sf).where(scores.numbers_disjoint(F.col("reasoning"), F.col("answer"))).select("response_id")


@query("scr6_formulas", rf"SELECT response_id, len(list_filter(list_transform(list_concat(regexp_extract_all(t, '\$([^$]+)\$', 1), regexp_extract_all(t, '\\\((.+?)\\\)', 1), regexp_extract_all(t, '(?s)\$\$(.+?)\$\$', 1), regexp_extract_all(t, '(?s)\\\[(.+?)\\\]', 1)), lambda x: trim(x)), lambda x: x <> '')) AS n FROM (SELECT response_id, coalesce(answer, '') AS t FROM {_RESPONSES})")
def _(spark, sf):
    return _responses(spark, sf).select("response_id", F.size(scores.formulas(F.col("answer"))).cast("long").alias("n"))


@query("flt4_math_check", f"SELECT response_id, CASE WHEN lower(trim(domain)) = 'math' THEN {_IS_DISJOINT} END AS math_numbers_disjoint FROM ({_DISJOINT})")
def _(spark, sf):
    return filters.with_math_check(_responses(spark, sf)).select("response_id", "math_numbers_disjoint")


# --- Filters and reports -------------------------------------------------------------------------------------------------

_CHAIN_SQL = f"""
WITH f AS (SELECT response_id, domain, coalesce(reasoning, '') AS r, coalesce(answer, '') AS a, coalesce(response, '') AS x, coalesce(prompt, '') AS p FROM {_RESPONSES}),
g AS (SELECT *, (r <> '' OR a <> '') AS parsed, CASE WHEN r <> '' OR a <> '' THEN concat(r, ' ', a) ELSE x END AS body, CASE WHEN r <> '' OR a <> '' THEN r ELSE x END AS rep FROM f),
h AS (SELECT *, {_words('body')} AS w, {_words('lower(rep)')} AS rw, {_words('lower(body)')} AS lw FROM g),
top AS (SELECT response_id, max(n) AS top FROM (SELECT response_id, gram, count(*) AS n FROM (SELECT response_id, unnest(list_transform(generate_series(1, len(rw) - 4), lambda i: array_to_string(rw[i : i + 4], ' '))) AS gram FROM h WHERE len(rw) >= 5) GROUP BY ALL) GROUP BY response_id),
s AS (SELECT h.*, coalesce(top.top, 0) AS top, greatest(40, len(rw) // 150) AS lim, CASE WHEN len(lw) = 0 THEN NULL WHEN len(lw) < 100 THEN len(list_distinct(lw)) / len(lw) ELSE list_avg(list_transform(generate_series(0, len(lw) // 100 - 1), lambda i: len(list_distinct(lw[i * 100 + 1 : i * 100 + 100])) / 100.0)) END AS ttr FROM h LEFT JOIN top USING (response_id))
"""
_FAMILY = f"""CASE WHEN {_strip('p')} = '' THEN 'missing_prompt' WHEN NOT parsed AND {_strip('x')} = '' THEN 'missing_response' WHEN parsed AND {_strip('r')} = '' THEN 'missing_reasoning' WHEN parsed AND {_strip('a')} = '' THEN 'missing_answer'
 WHEN len(w) < 20 THEN 'too_short' WHEN len(w) > 8000 THEN 'too_long' WHEN len(rw) >= lim + 5 AND top > lim THEN 'repetition_loop' WHEN ttr < 0.2 THEN 'low_info_density'
 WHEN parsed AND regexp_matches({_strip('a')}, '(?i){scores.BOILERPLATE.replace("'", "''")}') THEN 'boilerplate_answer' END"""


@query("flt2_structural", _CHAIN_SQL + f"SELECT response_id, {_FAMILY.split(' WHEN ttr')[0]} END AS family FROM s")
def _(spark, sf):
    return _responses(spark, sf).select("response_id", filters.family(filters.structural_reason()).alias("family"))


@query("flt9_chain", _CHAIN_SQL + f"SELECT response_id, {_FAMILY} AS family FROM s")
def _(spark, sf):
    return filters.with_reason(_responses(spark, sf)).select("response_id", filters.family(F.col("reason")).alias("family"))


@query("agg6_filter_report", _CHAIN_SQL + f"SELECT domain, {_FAMILY} AS family, count(*) AS n FROM s GROUP BY ALL")
def _(spark, sf):
    return filters.filter_report(filters.with_reason(_responses(spark, sf)))


@query("flt5_code_check")
def _(spark, sf):
    r = _responses(spark, sf).select("response_id", "reasoning", "answer")
    return filters.code_reasons(r, "response_id", seconds=5.0).select("response_id", "code_passed", filters.family(F.col("code_reason")).alias("family"))


@query("flt5_code_blocks", r"SELECT response_id, list_extract(b, -1) AS block FROM (SELECT response_id, regexp_extract_all(concat(coalesce(reasoning, ''), chr(10), coalesce(answer, '')), '(?is)```(?:python|py)\s*\n(.*?)```', 1) AS b FROM " + _RESPONSES + ") WHERE len(b) > 0")
def _(spark, sf):
    return _responses(spark, sf).select("response_id", filters.last_code_block(F.col("reasoning"), F.col("answer")).alias("block")).where("block is not null")


@query("flt10_search", "SELECT prompt_id, clustered_at FROM clustered_prompts WHERE domain IN ('math', 'code') AND difficulty = 'medium' AND (regexp_matches(coalesce(prompt, ''), '(?i)lens|cache|ratio') OR regexp_matches(coalesce(summary, ''), '(?i)lens|cache|ratio'))")
def _(spark, sf):
    hit = lambda c: F.coalesce(F.col(c), F.lit("")).rlike("(?iu)lens|cache|ratio")
    return _t(spark, sf, "clustered_prompts").where(F.col("domain").isin("math", "code") & (F.col("difficulty") == "medium") & (hit("prompt") | hit("summary"))).select("prompt_id", "clustered_at")


@query("flt8_judge", _CHAIN_SQL + f", q AS (SELECT *, ({_FAMILY}) AS f FROM s) SELECT response_id, CASE WHEN f IS NOT NULL THEN f WHEN len({_words('a')}) < 6 THEN 'llm_judge' END AS family FROM q")
def _(spark, sf):
    # A stand-in for a model: as many points as the answer has words. Every record that is still alive is judged.
    d = filters.run_chain(_responses(spark, sf), "response_id", code_domains=(), judge=filters.words_judge, judge_rate=1.0)
    return d.select("response_id", filters.family(F.col("reason")).alias("family"))


@query("flt9_staged_chain")
def _(spark, sf):
    d = filters.run_chain(_responses(spark, sf), "response_id", seconds=5.0, judge=filters.words_judge)
    return d.select("response_id", "math_numbers_disjoint", filters.family(F.col("reason")).alias("family"))


_V0_SQL = rf"""WITH b AS (SELECT response_id, coalesce(prompt, '') AS p, {_strip("regexp_replace(coalesce(response, ''), '(?i)^[\s]*<[|][^\n>]*>?(?:thought|analysis|final)?[\s]*', '')")} AS t FROM {_RESPONSES}),
m AS (SELECT *, regexp_matches(t, '(?s)<think>.*?</think>') AND regexp_matches(t, '(?s)<answer>.*?</answer>') AS tagged, regexp_extract(t, '(?is)^(.*?)(\b(?:therefore|thus|in conclusion|hence|so,|the answer is|final answer:?|in summary|to summarize)\b.*)$', 1) AS before0,
 regexp_extract(t, '(?is)^(.*?)(\b(?:therefore|thus|in conclusion|hence|so,|the answer is|final answer:?|in summary|to summarize)\b.*)$', 2) AS after0,
 list_filter(list_transform(string_split(regexp_replace(t, '([.!?])[\s\pZ]+', '\1' || chr(1), 'g'), chr(1)), lambda x: {_strip("x")}), lambda x: x <> '') AS parts FROM b),
k AS (SELECT *, {_strip("before0")} AS before, {_strip("after0")} AS after FROM m),
ra AS (SELECT response_id, p, CASE WHEN tagged THEN {_strip("regexp_extract(t, '(?s)<think>(.*?)</think>', 1)")} WHEN before <> '' AND after <> '' THEN before WHEN len(parts) >= 2 THEN array_to_string(parts[:-2], ' ') ELSE t END AS r,
 CASE WHEN tagged THEN {_strip("regexp_extract(t, '(?s)<answer>(.*?)</answer>', 1)")} WHEN before <> '' AND after <> '' THEN after WHEN len(parts) >= 2 THEN parts[-1] ELSE '' END AS a FROM k),
w AS (SELECT *, {_words("concat(r, ' ', a)")} AS w, {_words('lower(r)')} AS rw, {_words("lower(concat(r, ' ', a))")} AS lw, list_distinct({_words('lower(r)')}) AS rs, list_distinct({_words('lower(a)')}) AS ax FROM ra),
top AS (SELECT response_id, max(n) AS top FROM (SELECT response_id, gram, count(*) AS n FROM (SELECT response_id, unnest(list_transform(generate_series(1, len(rw) - 4), lambda i: array_to_string(rw[i : i + 4], ' '))) AS gram FROM w WHERE len(rw) >= 20) GROUP BY ALL) GROUP BY response_id),
z AS (SELECT w.*, coalesce(top.top, 0) AS top, CASE WHEN len(lw) = 0 THEN NULL WHEN len(lw) < 100 THEN len(list_distinct(lw)) / len(lw) ELSE list_avg(list_transform(generate_series(0, len(lw) // 100 - 1), lambda i: len(list_distinct(lw[i * 100 + 1 : i * 100 + 100])) / 100.0)) END AS ttr FROM w LEFT JOIN top USING (response_id))
SELECT response_id, CASE WHEN {_strip('p')} = '' THEN 'missing_prompt' WHEN {_strip('r')} = '' THEN 'missing_reasoning' WHEN {_strip('a')} = '' THEN 'missing_answer' WHEN len(w) < 50 THEN 'too_short' WHEN len(w) > 8000 THEN 'too_long' WHEN top > 3 THEN 'repetition_loop' WHEN ttr < 0.3 THEN 'low_info_density'
 WHEN regexp_matches({_strip('a')}, '(?i){scores.BOILERPLATE.replace("'", "''")}') THEN 'boilerplate_answer'
 WHEN list_has_any(rs, {_NEG}) <> list_has_any(ax, {_NEG}) AND len(list_intersect(list_filter(rs, lambda v: length(v) > 3 AND NOT list_contains({_NEG}, v)), list_filter(ax, lambda v: length(v) > 3 AND NOT list_contains({_NEG}, v)))) >= 3 THEN 'self_contradiction' END AS family FROM z"""


@query("flt11_older_chain", _V0_SQL)
def _(spark, sf):
    return filters.older_chain(_responses(spark, sf)).select("response_id", filters.family(F.col("reason")).alias("family"))


@query("agg6_pass_rate", _CHAIN_SQL + f"SELECT count(*) AS n, count(CASE WHEN f IS NULL THEN 1 END) AS passed, round(count(CASE WHEN f IS NULL THEN 1 END) / greatest(count(*), 1), 4) AS pass_rate FROM (SELECT {_FAMILY} AS f FROM s)")
def _(spark, sf):
    return filters.pass_rate(filters.with_reason(_responses(spark, sf)))


@query("agg16_reason_histogram", _CHAIN_SQL + f"SELECT len(w) >= 60 AS good, coalesce({_FAMILY}, 'passed') AS family, count(*) AS n FROM s GROUP BY ALL")
def _(spark, sf):
    d = filters.with_reason(_responses(spark, sf))
    return filters.reason_histogram(d, F.size(text.words(filters.body())) >= 60)


_FLAGS = _CHAIN_SQL + f", v AS (SELECT response_id, ({_FAMILY}) IS NULL AS passed, len(w) >= 60 AS good FROM s)"


def _flags(spark, sf):
    d = filters.with_reason(_responses(spark, sf))
    body = F.when(filters._parsed(), F.concat(filters._text("reasoning"), F.lit(" "), filters._text("answer"))).otherwise(filters._text("response"))
    return d.select("response_id", F.col("reason").isNull().alias("passed"), (F.size(text.words(body)) >= 60).alias("good"))


@query("agg16_confusion", _FLAGS + ", c AS (SELECT count(CASE WHEN NOT passed AND NOT good THEN 1 END) AS tp, count(CASE WHEN NOT passed AND good THEN 1 END) AS fp, count(CASE WHEN passed AND NOT good THEN 1 END) AS fn, count(CASE WHEN passed AND good THEN 1 END) AS tn FROM v) SELECT tp, fp, fn, tn, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall, round(tn / nullif(tn + fp, 0), 6) AS specificity, round((tp + tn) / nullif(tp + fp + fn + tn, 0), 6) AS accuracy, round(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0)) / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0), 6) AS f1 FROM c")
def _(spark, sf):
    c = filters.confusion(_flags(spark, sf), F.col("passed"), F.col("good"))
    return c.select(*[F.col(x).cast("long").alias(x) for x in ("tp", "fp", "fn", "tn")], *[F.round(x, 6).alias(x) for x in ("precision", "recall", "specificity", "accuracy", "f1")])


@query("agg22_flips", _FLAGS + " SELECT CASE WHEN passed AND good THEN 'pass_pass' WHEN passed THEN 'pass_fail' WHEN good THEN 'fail_pass' ELSE 'fail_fail' END AS flip, count(*) AS n FROM v GROUP BY 1")
def _(spark, sf):
    return filters.flips(_flags(spark, sf), F.col("passed"), F.col("good"))


# --- Decontamination -----------------------------------------------------------------------------------------------------

_GRAMS_SQL = f"""
WITH it AS (SELECT item_id, {_match('question')} AS t FROM eval_items),
g AS (SELECT item_id, len(t) AS n, unnest(CASE WHEN len(t) >= 13 THEN list_transform(generate_series(1, len(t) - 12), lambda i: array_to_string(t[i : i + 12], ' ')) WHEN len(t) >= 5 THEN [array_to_string(t, ' ')] ELSE [] END) AS gram FROM it),
own AS (SELECT gram, least(min(n), 13) AS gram_len, min(item_id) AS owner FROM g GROUP BY gram),
p AS (SELECT prompt_id, {_match('prompt')} AS t FROM prompts WHERE prompt_id IS NOT NULL),
hit AS (SELECT DISTINCT p.prompt_id, own.owner, own.gram_len, position(concat(' ', own.gram, ' ') IN concat(' ', array_to_string(p.t, ' '), ' ')) AS pos FROM (SELECT prompt_id, t, unnest(list_concat(CASE WHEN len(t) >= 13 THEN list_transform(generate_series(1, len(t) - 12), lambda i: array_to_string(t[i : i + 12], ' ')) ELSE [] END, {{short}})) AS gram FROM p) p JOIN own USING (gram))
SELECT prompt_id, arg_min(owner, (gram_len, pos, owner)) AS owner FROM hit GROUP BY prompt_id"""
_SHORT = "flatten([" + ", ".join(f"CASE WHEN len(t) >= {n} THEN list_transform(generate_series(1, len(t) - {n - 1}), lambda i: array_to_string(t[i : i + {n - 1}], ' ')) ELSE [] END" for n in range(5, 13)) + "])"


def _decontaminated(spark, sf, compat):
    p = spread(_t(spark, sf, "prompts").select("rec_no", "prompt_id", "prompt"))
    return decontam.decontaminate(p, "prompt_id", "prompt", _t(spark, sf, "eval_items"), "item_id", "item_id", "question", compat=compat)


_HITS_SQL = _GRAMS_SQL.replace("{short}", _SHORT)


@query("jn2_hits", _HITS_SQL)
def _(spark, sf):
    return _decontaminated(spark, sf, False)[1].select("prompt_id", "owner")


@query("jn2_clean_pool", f"SELECT rec_no, prompt_id FROM prompts WHERE prompt_id NOT IN (SELECT prompt_id FROM ({_HITS_SQL}))")
def _(spark, sf):
    return _decontaminated(spark, sf, False)[0].select("rec_no", "prompt_id")


@query("jn2_decontaminate")
def _(spark, sf):
    return _decontaminated(spark, sf, True)[0].select("prompt_id")


@query("snk11_removed_rows", f"SELECT p.rec_no, p.prompt_id, p.prompt, h.owner FROM prompts p JOIN ({_HITS_SQL}) h USING (prompt_id)")
def _(spark, sf):
    _, hits = _decontaminated(spark, sf, False)
    return decontam.removed_rows(_t(spark, sf, "prompts"), hits, "prompt_id", "prompt", ["rec_no"]).select("rec_no", "prompt_id", "prompt", "owner")


@query("agg4_removals", f"""WITH h AS ({_HITS_SQL}), r AS (SELECT p.source, h.owner FROM prompts p LEFT JOIN h USING (prompt_id)),
w AS (SELECT item_id, {_match('question')} AS t FROM eval_items),
gr AS (SELECT gram, min(item_id) AS owner, least(min(n), 13) AS gram_len FROM (SELECT item_id, len(t) AS n, unnest(CASE WHEN len(t) >= 13 THEN list_transform(generate_series(1, len(t) - 12), lambda i: array_to_string(t[i : i + 12], ' ')) WHEN len(t) >= 5 THEN [array_to_string(t, ' ')] ELSE [] END) AS gram FROM w) GROUP BY gram)
SELECT 'total' AS section, 'in' AS name, count(*)::DOUBLE AS value FROM r UNION ALL SELECT 'total', 'removed', count(owner) FROM r UNION ALL SELECT 'total', 'removal_rate', round(count(owner) / greatest(count(*), 1), 6) FROM r
UNION ALL SELECT 'removed by owner', owner::VARCHAR, count(*) FROM r WHERE owner IS NOT NULL GROUP BY owner UNION ALL SELECT 'removed by source', source, count(owner) FROM r GROUP BY source
UNION ALL SELECT 'grams by length', gram_len::VARCHAR, count(*) FROM gr GROUP BY gram_len UNION ALL SELECT 'grams by owner', owner::VARCHAR, count(*) FROM gr GROUP BY owner
UNION ALL SELECT 'too short by owner', item_id::VARCHAR, count(*) FROM w WHERE len(t) BETWEEN 1 AND 4 GROUP BY item_id""")
def _(spark, sf):
    items = _t(spark, sf, "eval_items")
    _, hits = _decontaminated(spark, sf, False)
    grams, short = decontam.item_grams(items, "item_id", "item_id", "question", compat=False), decontam.short_items(items, "item_id", "question", compat=False)
    return decontam.removal_report(_t(spark, sf, "prompts"), hits, "prompt_id", "prompt", "source", grams, short)


@query("agg5_gram_owners", f"""WITH it AS (SELECT item_id, {_match('question')} AS t FROM eval_items), g AS (SELECT item_id, unnest(list_transform(generate_series(1, len(t) - 12), lambda i: array_to_string(t[i : i + 12], ' '))) AS gram FROM it WHERE len(t) >= 13 UNION ALL SELECT item_id, array_to_string(t, ' ') FROM it WHERE len(t) BETWEEN 5 AND 12) SELECT gram, min(item_id) AS owner FROM g GROUP BY gram""")
def _(spark, sf):
    return decontam.item_grams(_t(spark, sf, "eval_items"), "item_id", "item_id", "question").select("gram", "owner")


# --- Statistics ----------------------------------------------------------------------------------------------------------


_COUNTED = ("domain", "difficulty", "language", "source")


@query("agg7_value_counts", " UNION ALL ".join(f"SELECT '{f}' AS field, {f} AS value, count(*) AS n FROM clustered_prompts WHERE {f} <> '' GROUP BY {f}" for f in _COUNTED))
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts")
    return relations.union_all(*[stats.value_counts(c, f).select(F.lit(f).alias("field"), "value", "n") for f in _COUNTED])


@query("agg8_topics", "SELECT value, count(*) AS n FROM (SELECT trim(unnest(topics)) AS value FROM clustered_prompts) WHERE value <> '' GROUP BY value ORDER BY n DESC, value LIMIT 100")
def _(spark, sf):
    return stats.list_counts(_t(spark, sf, "clustered_prompts"), "topics", 100)


@query("agg9_cross_tab", "SELECT domain, count(CASE WHEN difficulty = 'easy' THEN 1 END) AS easy, count(CASE WHEN difficulty = 'medium' THEN 1 END) AS medium, count(CASE WHEN difficulty = 'hard' THEN 1 END) AS hard FROM clustered_prompts WHERE domain <> '' GROUP BY domain")
def _(spark, sf):
    return stats.cross_tab(_t(spark, sf, "clustered_prompts"), "domain", "difficulty", ["easy", "medium", "hard"])


@query("agg9_domain_by_language", "WITH l AS (SELECT language FROM clustered_prompts WHERE language <> '' GROUP BY language ORDER BY count(*) DESC, language LIMIT 10), d AS (SELECT DISTINCT domain FROM clustered_prompts WHERE domain <> '') SELECT d.domain, l.language, count(c.prompt_id) AS n FROM d CROSS JOIN l LEFT JOIN clustered_prompts c ON c.domain = d.domain AND c.language = l.language GROUP BY ALL")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts")
    top = [r["value"] for r in stats.top_values(c, "language", 10).collect()]
    return stats.cross_tab(c, "domain", "language", top).unpivot("domain", top, "language", "n")


@query("agg10_topics_per_domain", "SELECT domain, value, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY n DESC, value) AS rank FROM (SELECT domain, value, count(*) AS n FROM (SELECT domain, trim(unnest(topics)) AS value FROM clustered_prompts WHERE domain <> '') WHERE value <> '' GROUP BY ALL)) WHERE rank <= 15")
def _(spark, sf):
    return stats.top_per_group(_t(spark, sf, "clustered_prompts"), "domain", "topics", 15).withColumn("rank", F.col("rank").cast("long"))


@query("agg11_cluster_sizes", "SELECT cluster_id, count(*) AS size FROM clustered_prompts WHERE cluster_id >= 0 GROUP BY cluster_id")
def _(spark, sf):
    return stats.cluster_sizes(_t(spark, sf, "clustered_prompts"))


_HIST = "WITH s AS (SELECT count(*) AS size FROM clustered_prompts WHERE cluster_id >= 0 GROUP BY cluster_id), e AS (SELECT unnest([0, 5, 20, 50, 100, 250, 500, 1000, 5000])::INT AS lo, unnest([5, 20, 50, 100, 250, 500, 1000, 5000, NULL])::INT AS hi), h AS (SELECT lo, hi, count(s.size) AS n FROM e LEFT JOIN s ON s.size >= lo AND (hi IS NULL OR s.size < hi) GROUP BY lo, hi)"


@query("agg12_size_histogram", _HIST + " SELECT lo, hi, n FROM h")
def _(spark, sf):
    return stats.size_histogram(stats.cluster_sizes(_t(spark, sf, "clustered_prompts")))


@query("agg15_histogram_median", _HIST + ", c AS (SELECT *, sum(n) OVER (ORDER BY lo) AS upto, sum(n) OVER () AS total FROM h) SELECT round(lo + (total / 2 - (upto - n)) / n * (coalesce(hi, lo) - lo), 6) AS median FROM c WHERE upto >= total / 2 AND upto - n < total / 2")
def _(spark, sf):
    return stats.histogram_median(stats.size_histogram(stats.cluster_sizes(_t(spark, sf, "clustered_prompts")))).select(F.round("median", 6).alias("median"))


@query("agg13_dominant_domain", "SELECT domain, count(*) AS n_clusters FROM (SELECT cluster_id, domain FROM (SELECT cluster_id, domain, row_number() OVER (PARTITION BY cluster_id ORDER BY count(*) DESC, domain) AS r FROM clustered_prompts WHERE cluster_id >= 0 AND domain <> '' GROUP BY cluster_id, domain) WHERE r = 1) GROUP BY domain")
def _(spark, sf):
    return stats.dominant_label(_t(spark, sf, "clustered_prompts").where("cluster_id >= 0"), "cluster_id", "domain").groupBy("domain").agg(F.count("*").alias("n_clusters"))


@query("agg14_row_shares", "SELECT domain, difficulty, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY domain), 6) AS share FROM clustered_prompts WHERE domain <> '' AND difficulty <> '' GROUP BY domain, difficulty")
def _(spark, sf):
    return stats.row_shares(_t(spark, sf, "clustered_prompts"), "domain", "difficulty").withColumn("share", F.round("share", 6))


@query("agg17_score_summary", "SELECT label, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS stdev, count(CASE WHEN v = 1 THEN 1 END) AS n_1, count(CASE WHEN v = 5 THEN 1 END) AS n_5 FROM (SELECT label, vec_id % 5 + 1 AS v FROM embeddings) GROUP BY label")
def _(spark, sf):
    s = stats.score_summary(_t(spark, sf, "embeddings").select("label", (F.col("vec_id") % 5 + 1).alias("v")), "label", "v")
    return s.select("label", "n", F.round("mean", 6).alias("mean"), F.round("stdev", 6).alias("stdev"), "n_1", "n_5")


@query("agg18_centroids", "SELECT label, i - 1 AS i, round(x / nullif(sqrt(sum(x * x) OVER (PARTITION BY label)), 0), 5) AS x FROM (SELECT label, i, avg(e) AS x FROM (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS e FROM embeddings) GROUP BY label, i)")
def _(spark, sf):
    c = vectors.centroids(_t(spark, sf, "embeddings"), "label", "embedding")
    return c.select(F.col("cluster").alias("label"), F.posexplode("centroid").alias("i", "x")).select("label", F.col("i").cast("long").alias("i"), F.round("x", 5).alias("x"))


@query("vec8_own_similarity", "WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS e FROM embeddings), c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(e) AS x FROM u GROUP BY label, i) GROUP BY label) SELECT vec_id, round(list_cosine_similarity(list_transform(embedding, lambda v: v::DOUBLE), c.v), 5) AS centroid_sim FROM embeddings JOIN c USING (label)")
def _(spark, sf):
    return vectors.own_similarity(_t(spark, sf, "embeddings"), "label", "embedding").select("vec_id", F.round("centroid_sim", 5).alias("centroid_sim"))


@query("vec10_repaired_similarity", "WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS e FROM embeddings), c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(e) AS x FROM u GROUP BY label, i) GROUP BY label), m AS (SELECT min(label) AS kept FROM embeddings) SELECT vec_id, CASE WHEN label = kept THEN 0.25 ELSE round(list_cosine_similarity(list_transform(embedding, lambda v: v::DOUBLE), c.v), 5) END AS centroid_sim FROM embeddings JOIN c USING (label), m")
def _(spark, sf):
    # The rows of one label have a similarity that must stay, the others the default or none.
    e = _t(spark, sf, "embeddings")
    kept = e.agg(F.min("label").alias("kept"))
    old = e.select("vec_id", F.col("label").alias("cluster_id")).crossJoin(F.broadcast(kept)).withColumn("centroid_sim", F.when(F.col("cluster_id") == F.col("kept"), 0.25).when(F.col("vec_id") > 100, 0.5)).drop("kept")
    return vectors.repair_similarities(old, "vec_id", e, "embedding").select("vec_id", F.round("centroid_sim", 5).alias("centroid_sim"))


@query("jn7_similarity_or_default", "WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS e FROM embeddings WHERE vec_id IN (SELECT doc_id FROM documents)), c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(e) AS x FROM u GROUP BY label, i) GROUP BY label) SELECT d.doc_id, coalesce(round(list_cosine_similarity(list_transform(e.embedding, lambda v: v::DOUBLE), c.v), 5), 0.5) AS centroid_sim FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id LEFT JOIN c USING (label)")
def _(spark, sf):
    # Documents and vectors have ids in common; what has no vector gets the default.
    e = _t(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", F.col("label").alias("cluster_id"))
    d = _t(spark, sf, "documents").select("doc_id").join(e.select("doc_id", "cluster_id"), "doc_id", "left").withColumn("centroid_sim", F.lit(None).cast("double"))
    return vectors.repair_similarities(d, "doc_id", e.select("doc_id", "embedding"), "embedding").select("doc_id", F.round("centroid_sim", 5).alias("centroid_sim"))


@query("jn9_nearest_centre", "WITH u AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE / sqrt(list_sum(list_transform(embedding, lambda v: v::DOUBLE * v::DOUBLE))) AS e FROM embeddings), c AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(e) AS x FROM u GROUP BY label, i) GROUP BY label) SELECT vec_id, arg_max(c.label, list_cosine_similarity(list_transform(embedding, lambda v: v::DOUBLE), c.v)) AS cluster FROM embeddings, c GROUP BY vec_id")
def _(spark, sf):
    e = _t(spark, sf, "embeddings")
    return vectors.nearest_centre(e, "vec_id", "embedding", vectors.centroids(e, "label", "embedding")).select("vec_id", F.col("cluster").cast("int").alias("cluster"))


@query("vec3_exact_search", "SELECT q AS query_id, vec_id, rank FROM (SELECT q.vec_id AS q, e.vec_id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(list_transform(q.embedding, lambda v: v::DOUBLE), list_transform(e.embedding, lambda v: v::DOUBLE)), 9) DESC, e.vec_id) AS rank FROM (SELECT * FROM embeddings WHERE vec_id % 50 = 0) q, embeddings e) WHERE rank <= 10")
def _(spark, sf):
    e = _t(spark, sf, "embeddings")
    s = vectors.search(e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), "query_id", e, "vec_id", "embedding", 10)
    return s.select("query_id", "vec_id", F.col("rank").cast("long").alias("rank"))


@query("vec4_spherical_kmeans")
def _(spark, sf):
    return vectors.spherical_kmeans(_t(spark, sf, "embeddings"), "vec_id", "embedding", 10)[0].select("vec_id", "cluster")


@query("vec2_inverted_file")
def _(spark, sf):
    e = _t(spark, sf, "embeddings")
    index, centres = vectors.ivf_index(e, "vec_id", "embedding", cells=20)
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return vectors.ivf_search(q, "query_id", index, centres, "vec_id", "embedding", 10, probes=10).select("query_id", "vec_id", "rank")


@query("vec5_euclidean_kmeans")
def _(spark, sf):
    return vectors.euclidean_kmeans(_t(spark, sf, "embeddings"), "vec_id", "embedding", 10)[0]


@query("vec7_grouped_centroids")
def _(spark, sf):
    return vectors.group_centroids(vectors.centroids(_t(spark, sf, "embeddings"), "label", "embedding"), least=2)


@query("vec9_cluster_prompts")
def _(spark, sf):
    p = _t(spark, sf, "clustered_prompts").where("prompt is not null").groupBy("prompt_id").agg(F.min("prompt").alias("prompt"))
    return vectors.cluster_prompts(p, "prompt_id", "prompt", vectors.embed(spread(p), "prompt_id", "prompt"), "embedding", 20)


@query("vec1_embed")
def _(spark, sf):
    p = relations.first_per_key(_t(spark, sf, "prompts").select("prompt_id", "prompt"), "prompt_id", ["prompt"])
    return vectors.embed(p, "prompt_id", "prompt")


@query("agg23_source_shares", "SELECT source AS value, count(*) AS n, round(100 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM prompts WHERE source <> '' GROUP BY source")
def _(spark, sf):
    return stats.share_of_total(_t(spark, sf, "prompts"), "source")


_TOP = (("cluster_id", 50), ("language", 30), ("source", 30))


@query("top1_lists", " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}' AS field, {c}::VARCHAR AS value, count(*) AS n FROM clustered_prompts WHERE {c}::VARCHAR <> '' GROUP BY {c} ORDER BY n DESC, {c} LIMIT {k})" for c, k in _TOP) + " UNION ALL SELECT * FROM (SELECT 'topics', value, count(*) AS n FROM (SELECT trim(unnest(topics)) AS value FROM clustered_prompts) WHERE value <> '' GROUP BY value ORDER BY n DESC, value LIMIT 100)")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts")
    named = lambda d, f: d.select(F.lit(f).alias("field"), F.col("value").cast("string").alias("value"), "n")
    return relations.union_all(*[named(stats.top_values(c, f, k), f) for f, k in _TOP], named(stats.list_counts(c, "topics", 100), "topics"))


# --- Ranking and sampling ------------------------------------------------------------------------------------------------

_CELLS = sampling.cell_targets(1000)
_TARGETS = ", ".join(f"('{d}', '{x}', {n})" for d, x, n in _CELLS if n > 0)


def _pool(spark, sf):
    c = _t(spark, sf, "clustered_prompts").select("prompt_id", F.lower(F.trim("domain")).alias("domain"), F.lower(F.trim("difficulty")).alias("difficulty"), F.coalesce("cluster_id", F.lit(-1)).alias("cluster_id"), F.coalesce("centroid_sim", F.lit(0.5)).cast("float").alias("centroid_sim"))
    return c.distinct()


_POOL = "(SELECT DISTINCT prompt_id, lower(trim(domain)) AS domain, lower(trim(difficulty)) AS difficulty, coalesce(cluster_id, -1) AS cluster_id, coalesce(centroid_sim, 0.5)::FLOAT AS centroid_sim FROM clustered_prompts)"


@query("win1_centroid_order", f"SELECT prompt_id, cluster_id, CASE WHEN r = 1 THEN 0 ELSE n - r + 1 END AS pos FROM (SELECT *, row_number() OVER w AS r, count(*) OVER (PARTITION BY domain, difficulty, cluster_id) AS n FROM {_POOL} WINDOW w AS (PARTITION BY domain, difficulty, cluster_id ORDER BY centroid_sim DESC, prompt_id))")
def _(spark, sf):
    o = sampling.centroid_order(_pool(spark, sf), ["domain", "difficulty", "cluster_id"], "centroid_sim", "prompt_id")
    return o.select("prompt_id", "cluster_id", F.col("pos").cast("long").alias("pos"))


@query("win3_round_robin", f"""WITH t(domain, difficulty, target) AS (VALUES {_TARGETS}), p AS (SELECT * FROM {_POOL} JOIN t USING (domain, difficulty)),
o AS (SELECT *, CASE WHEN r = 1 THEN 0 ELSE n - r + 1 END AS pos FROM (SELECT *, row_number() OVER (PARTITION BY domain, difficulty, cluster_id ORDER BY centroid_sim DESC, prompt_id) AS r, count(*) OVER (PARTITION BY domain, difficulty, cluster_id) AS n FROM p)),
k AS (SELECT domain, difficulty, cluster_id, row_number() OVER (PARTITION BY domain, difficulty ORDER BY md5(concat(cluster_id, ':42')), cluster_id) AS rank FROM (SELECT DISTINCT domain, difficulty, cluster_id FROM p))
SELECT prompt_id, domain, difficulty, turn FROM (SELECT *, row_number() OVER (PARTITION BY domain, difficulty ORDER BY pos, rank) AS turn FROM o JOIN k USING (domain, difficulty, cluster_id)) WHERE turn <= target""")
def _(spark, sf):
    return sampling.quota_round_robin(_pool(spark, sf), 1000, "prompt_id").select("prompt_id", "domain", "difficulty", F.col("turn").cast("long").alias("turn"))


@query("win2_shuffled_clusters")
def _(spark, sf):
    return sampling.quota_round_robin(_pool(spark, sf), 1000, "prompt_id", order="python").select("prompt_id", "domain", "difficulty", "turn")


@query("win4_shortfall", f"WITH t(domain, difficulty, target) AS (VALUES {_TARGETS}) SELECT t.domain, t.difficulty, t.target, count(p.prompt_id) AS available FROM t LEFT JOIN {_POOL} p USING (domain, difficulty) GROUP BY ALL")
def _(spark, sf):
    t = spark.createDataFrame([c for c in _CELLS if c[2] > 0], "domain string, difficulty string, target int")
    n = _pool(spark, sf).groupBy("domain", "difficulty").agg(F.count("*").alias("available"))
    return t.join(n, ["domain", "difficulty"], "left").select("domain", "difficulty", "target", F.coalesce("available", F.lit(0)).alias("available"))


@query("smp1_hash_sample")
def _(spark, sf):
    return sampling.hash_sample(_t(spark, sf, "prompts").select("rec_no", "prompt_id"), "rec_no", 1000)


@query("smp2_first_members", "SELECT prompt_id, cluster_id, clustered_at FROM clustered_prompts WHERE cluster_id >= 0 QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY prompt_id, clustered_at) <= 50")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts").where("cluster_id >= 0").select("prompt_id", "cluster_id", "clustered_at")
    return relations.cap_per_group(c, "cluster_id", ["prompt_id", "clustered_at"], 50)


@query("smp3_window_per_domain", f"SELECT response_id, domain FROM (SELECT response_id, domain, row_number() OVER (PARTITION BY domain ORDER BY response_id) AS r FROM {_RESPONSES}) WHERE r > 5 AND r <= 15")
def _(spark, sf):
    return sampling.window_per_group(_responses(spark, sf).select("response_id", "domain"), "domain", ["response_id"], 5, 10)


@query("smp3_bounded_scan", f"SELECT response_id, domain FROM (SELECT response_id, domain, row_number() OVER (PARTITION BY domain ORDER BY response_id) AS r FROM (SELECT * FROM {_RESPONSES} ORDER BY response_id LIMIT 300)) WHERE r > 2 AND r <= 12")
def _(spark, sf):
    return sampling.window_per_group(_responses(spark, sf).select("response_id", "domain"), "domain", ["response_id"], 2, 10, scan=300)


@query("lim1_page", "SELECT rec_no, prompt_id FROM prompts ORDER BY rec_no LIMIT 10 OFFSET 30")
def _(spark, sf):
    return sampling.page(_t(spark, sf, "prompts").select("rec_no", "prompt_id"), ["rec_no"], 3)


# --- Sinks ---------------------------------------------------------------------------------------------------------------


@query("snk7_final_records", f"SELECT prompt_id AS id, coalesce(prompt, '') AS prompt, coalesce(reasoning, '') AS reasoning, coalesce(answer, '') AS answer, coalesce(domain, 'general') AS domain, 'medium' AS difficulty, 'en' AS language, 'unknown' AS source, coalesce(teacher_model, 'unknown') AS teacher_model FROM {_RESPONSES}")
def _(spark, sf):
    return files.final_records(_responses(spark, sf), ["response_id"])


@query("snk5_annotation_requests", "SELECT prompt_id, any_value(to_json([{'role': 'user', 'content': prompt}])::VARCHAR) AS messages FROM clustered_prompts WHERE prompt IS NOT NULL GROUP BY prompt_id")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts").where("prompt is not null").groupBy("prompt_id").agg(F.min("prompt").alias("prompt"))
    return c.select("prompt_id", F.to_json(parse.chat_messages(text.last_words(F.col("prompt"), 512))).alias("messages"))


@query("jn11_snapshot", _CHAIN_SQL + f", vd AS (SELECT r.prompt_id, count(*) AS n_responses, count(CASE WHEN v.family IS NULL THEN 1 END) AS n_passed, arg_max(coalesce(v.family, 'passed'), r.response_id) AS last_verdict FROM {_RESPONSES} r JOIN (SELECT response_id, {_FAMILY} AS family FROM s) v USING (response_id) GROUP BY r.prompt_id), cp AS (SELECT prompt_id, min(domain) AS domain, min(array_to_string(topics, ', ')) AS topics FROM clustered_prompts GROUP BY prompt_id) SELECT cp.*, coalesce(n_responses, 0) AS n_responses, coalesce(n_passed, 0) AS n_passed, last_verdict FROM cp LEFT JOIN vd USING (prompt_id)")
def _(spark, sf):
    c = _t(spark, sf, "clustered_prompts").groupBy("prompt_id").agg(F.min("domain").alias("domain"), F.min(F.array_join("topics", ", ")).alias("topics"))
    v = filters.with_reason(_responses(spark, sf)).select("prompt_id", "response_id", filters.family(F.col("reason")).alias("family"))
    per = v.groupBy("prompt_id").agg(F.count("*").alias("n_responses"), F.count_if(F.col("family").isNull()).alias("n_passed"), F.max_by(F.coalesce("family", F.lit("passed")), "response_id").alias("last_verdict"))
    return c.join(per, "prompt_id", "left").select("prompt_id", "domain", "topics", F.coalesce("n_responses", F.lit(0)).alias("n_responses"), F.coalesce("n_passed", F.lit(0)).alias("n_passed"), "last_verdict")


@query("snk12_first_rejections", _CHAIN_SQL + f"SELECT response_id, {_FAMILY} AS family FROM s WHERE ({_FAMILY}) IS NOT NULL ORDER BY response_id LIMIT 20")
def _(spark, sf):
    d = filters.with_reason(_responses(spark, sf)).where("reason is not null").orderBy("response_id").limit(20)
    return d.select("response_id", filters.family(F.col("reason")).alias("family"))


# --- More joins, reports and projections ---------------------------------------------------------------------------------


@query("ext1_nested_field", "SELECT doc_id, source AS a_b, NULL AS a_c FROM documents")
def _(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", F.struct(F.col("source").alias("b")).alias("a"))
    return d.select("doc_id", parse.field(d, "a.b").alias("a_b"), parse.field(d, "a.missing.c").alias("a_c"))


@query("nrm7_prefix", "SELECT doc_id, substr(text, 1, 400) AS head FROM documents WHERE text IS NOT NULL")
def _(spark, sf):
    return _t(spark, sf, "documents").where("text is not null").select("doc_id", F.substring("text", 1, 400).alias("head"))


@query("src13_annotation_topics", "SELECT prompt_id, clustered_at, len(topics) AS n_topics, topics[1] AS first_topic FROM clustered_prompts WHERE topics IS NOT NULL")
def _(spark, sf):
    # Topics pass through their stored form, a JSON string.
    c = _t(spark, sf, "clustered_prompts").where("topics is not null").select("prompt_id", "clustered_at", F.from_json(F.to_json("topics"), "array<string>").alias("t"))
    return c.select("prompt_id", "clustered_at", F.size("t").cast("long").alias("n_topics"), F.get("t", F.lit(0)).alias("first_topic"))


@query("jn6_new_annotations", "SELECT prompt_id, min(clustered_at) AS clustered_at FROM clustered_prompts WHERE prompt_id NOT IN (SELECT prompt_id FROM responses WHERE prompt_id IS NOT NULL) GROUP BY prompt_id")
def _(spark, sf):
    c = relations.not_yet_done(_t(spark, sf, "clustered_prompts").select("prompt_id", "clustered_at"), _t(spark, sf, "responses"), "prompt_id")
    return relations.first_per_key(c, "prompt_id", ["clustered_at"])


@query("jn10_sampled_records", f"WITH s AS (SELECT prompt_id, row_number() OVER (ORDER BY md5(prompt_id), prompt_id) AS place FROM (SELECT DISTINCT prompt_id FROM clustered_prompts) ORDER BY place LIMIT 200) SELECT s.place, p.prompt_id, p.domain FROM s JOIN {_POOL} p USING (prompt_id)")
def _(spark, sf):
    ids = _t(spark, sf, "clustered_prompts").select("prompt_id").distinct()
    head = ids.withColumn("h", F.md5("prompt_id")).orderBy("h", "prompt_id").limit(200)
    # The sample is of a fixed size, so its places come from one small sort.
    place = head.agg(F.array_sort(F.collect_list(F.struct("h", "prompt_id"))).alias("s")).select(F.posexplode("s").alias("i", "x")).select((F.col("i") + 1).cast("long").alias("place"), F.col("x.prompt_id").alias("prompt_id"))
    return place.join(_pool(spark, sf), "prompt_id").select("place", "prompt_id", "domain")


@query("jn12_verified_scores", _FLAGS + f", j AS (SELECT response_id, len({_words('answer')}) AS score FROM {_RESPONSES}) SELECT count(*) AS n, count(CASE WHEN passed AND score >= 4 THEN 1 END) AS passed_good, count(CASE WHEN NOT passed AND score < 4 THEN 1 END) AS rejected_bad FROM v JOIN j USING (response_id)")
def _(spark, sf):
    j = _responses(spark, sf).select("response_id", F.size(text.words(F.col("answer"))).alias("score"))
    v = _flags(spark, sf).join(j, "response_id")
    return v.agg(F.count("*").alias("n"), F.count_if(F.col("passed") & (F.col("score") >= 4)).alias("passed_good"), F.count_if(~F.col("passed") & (F.col("score") < 4)).alias("rejected_bad"))


@query("jn13_comparison", _CHAIN_SQL + f"SELECT s.response_id, {_FAMILY} AS now, CASE WHEN len(w) < 50 THEN 'too_short' END AS before, d.n_prompts, len({_words('a')}) AS score FROM s LEFT JOIN (SELECT domain, count(*) AS n_prompts FROM prompts GROUP BY domain) d USING (domain)")
def _(spark, sf):
    d = filters.with_reason(_responses(spark, sf))
    body = F.when(filters._parsed(), F.concat(filters._text("reasoning"), F.lit(" "), filters._text("answer"))).otherwise(filters._text("response"))
    per = _t(spark, sf, "prompts").groupBy("domain").agg(F.count("*").alias("n_prompts"))
    return d.withColumn("before", F.when(F.size(text.words(body)) < 50, "too_short")).join(per, "domain", "left").select("response_id", filters.family(F.col("reason")).alias("now"), "before", "n_prompts", F.size(text.words(F.col("answer"))).cast("long").alias("score"))


@query("jn14_judge_cache", f"SELECT response_id, CASE WHEN response_id % 2 = 0 THEN 'kept' ELSE 'sent' END AS origin FROM {_RESPONSES}")
def _(spark, sf):
    r = _responses(spark, sf).select("response_id")
    scored = r.where("response_id % 2 = 0")
    kept = r.join(scored, "response_id", "left_semi").withColumn("origin", F.lit("kept"))
    return kept.unionByName(relations.not_yet_done(r, scored, "response_id").withColumn("origin", F.lit("sent")))


@query("agg3_shard_counts", "SELECT shard, count(*) AS n_input, count(CASE WHEN length(prompt) < 100 THEN 1 END) AS n_removed, count(DISTINCT source) AS n_sources FROM prompts GROUP BY shard")
def _(spark, sf):
    return _t(spark, sf, "prompts").groupBy("shard").agg(F.count("*").alias("n_input"), F.count(F.when(F.length("prompt") < 100, 1)).alias("n_removed"), F.countDistinct("source").alias("n_sources"))


@query("agg20_counts", "SELECT (SELECT count(*) FROM prompts) AS n_prompts, (SELECT count(*) FROM responses) AS n_responses, (SELECT count(DISTINCT prompt_id) FROM clustered_prompts) AS n_clustered")
def _(spark, sf):
    n = lambda t, c, name: _t(spark, sf, t).agg(c.alias(name))
    return n("prompts", F.count("*"), "n_prompts").crossJoin(n("responses", F.count("*"), "n_responses")).crossJoin(n("clustered_prompts", F.countDistinct("prompt_id"), "n_clustered"))


@query("agg21_reason_buckets", _CHAIN_SQL + f"SELECT coalesce(CASE WHEN f IN ('too_short', 'too_long') THEN substr(concat(f, ':', len(w)), 1, 30) WHEN f = 'low_info_density' THEN concat(f, ':', printf('%.2f', ttr)) ELSE f END, 'passed') AS bucket, count(*) AS n FROM (SELECT *, {_FAMILY} AS f FROM s) GROUP BY 1")
def _(spark, sf):
    d = filters.with_reason(_responses(spark, sf))
    return d.groupBy(F.coalesce(filters.bucket(F.col("reason")), F.lit("passed")).alias("bucket")).agg(F.count("*").alias("n"))


@query("snk8_json_report", "SELECT to_json({'n_prompts': count(*), 'n_ids': count(DISTINCT prompt_id), 'n_sources': count(DISTINCT source)})::VARCHAR AS report FROM prompts")
def _(spark, sf):
    row = _t(spark, sf, "prompts").agg(F.count("*").alias("n_prompts"), F.countDistinct("prompt_id").alias("n_ids"), F.countDistinct("source").alias("n_sources"))
    return row.select(F.to_json(F.struct("n_prompts", "n_ids", "n_sources")).alias("report"))


@query("prj2_judge_prompt", f"SELECT response_id, concat('Question:', chr(10), substr(coalesce(prompt, ''), 1, 2000), chr(10), chr(10), 'Answer:', chr(10), substr(coalesce(answer, ''), 1, 3000)) AS judge_prompt FROM {_RESPONSES}")
def _(spark, sf):
    part = lambda c, n: F.substring(F.coalesce(c, F.lit("")), 1, n)
    return _responses(spark, sf).select("response_id", F.concat(F.lit("Question:\n"), part("prompt", 2000), F.lit("\n\nAnswer:\n"), part("answer", 3000)).alias("judge_prompt"))


@query("prs10_field_choice", f"SELECT response_id, coalesce(nullif({_strip('answer')}, ''), nullif({_strip('response')}, ''), '-') AS shown FROM {_RESPONSES}")
def _(spark, sf):
    said = lambda c: text.nonempty(text.strip(F.col(c)))
    return _responses(spark, sf).select("response_id", F.coalesce(said("answer"), said("response"), F.lit("-")).alias("shown"))


@query("srt1_ordered_states", "SELECT response_id, generated_at FROM responses ORDER BY generated_at NULLS LAST, response_id")
def _(spark, sf):
    return _t(spark, sf, "responses").select("response_id", "generated_at").orderBy(F.asc_nulls_last("generated_at"), "response_id")


@query("smp4_training_rows")
def _(spark, sf):
    return sampling.hash_sample(_t(spark, sf, "embeddings").select("vec_id", "embedding"), "vec_id", 200).select("vec_id")


@query("vec11_heuristic_labels", rf"SELECT rec_no, -1 AS cluster_id, d.label AS domain, CASE WHEN n >= 200 OR m THEN 'hard' WHEN n <= 50 THEN 'easy' ELSE 'medium' END AS difficulty FROM (SELECT rec_no, len({_words('prompt')}) AS n, regexp_matches(coalesce(prompt, ''), '(?i){labels.MULTI_STEP}') AS m FROM prompts) JOIN ({_domain_sql(labels.PROMPT_KEYWORDS)}) d USING (rec_no)")
def _(spark, sf):
    p = spread(_t(spark, sf, "prompts").select("rec_no", "prompt"))
    return p.select("rec_no", F.lit(-1).alias("cluster_id"), labels.prompt_domain(F.col("prompt")).alias("domain"), labels.difficulty(F.col("prompt")).alias("difficulty"))


@query("prs6_judge_json", "SELECT vec_id, label AS score FROM embeddings")
def _(spark, sf):
    said = F.concat(F.lit("<think>{a}</think>Score {rough} below\n```json\n{\"score\": "), F.col("label").cast("string"), F.lit("}\n```\nand {more}"))
    e = _t(spark, sf, "embeddings").select("vec_id", parse.json_object(said).alias("j"))
    return e.select("vec_id", F.get_json_object("j", "$.score").cast("int").alias("score"))


@query("extc1_generated", "SELECT prompt_id, i AS place, substr(p, i * 20 + 1, 20) AS text FROM (SELECT prompt_id, regexp_replace(min(prompt), '[^A-Za-z0-9]', '', 'g') AS p FROM prompts WHERE prompt_id IS NOT NULL GROUP BY prompt_id) t, (SELECT unnest([0, 1])::INT AS i) WHERE length(p) >= 40")
def _(spark, sf):
    # The stand-in lists a prompt's letters in pieces of 20, with a comma too many.
    p = relations.first_per_key(_t(spark, sf, "prompts").select("prompt_id", "prompt"), "prompt_id", ["prompt"])
    p = p.select("prompt_id", F.regexp_replace("prompt", "[^A-Za-z0-9]", "").alias("prompt")).where(F.length("prompt") >= 40)
    return external.generate(p, "prompt_id", "prompt", external.listing_client)


@query("extc_model_calls", f"SELECT prompt_id, concat('<answer>', array_to_string({_words('p')}[1:5], ' '), '</answer>') AS answer, true AS complete FROM (SELECT prompt_id, min(prompt) AS p FROM prompts WHERE prompt_id IS NOT NULL GROUP BY prompt_id)")
def _(spark, sf):
    p = relations.first_per_key(_t(spark, sf, "prompts").select("prompt_id", "prompt"), "prompt_id", ["prompt"])
    out = external.call_model(p, "prompt_id", "prompt", external.echo_client)
    return out.select("prompt_id", parse.split_thought(F.col("output")).alias("p")).select("prompt_id", "p.answer", "p.complete")

"""Responses into reasoning and answer, chat values into prompts, annotations and judgements out of model output."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.text import is_blank, strip

# Phrases that introduce a conclusion.
CONCLUSION = r"\b(?:therefore|thus|in conclusion|hence|so,|the answer is|final answer:?|in summary|to summarize)\b"
# Fixed value: the pattern by which public byte-level tokenizers cut texts before merging.
TOKEN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Labels of the annotation vocabulary.
DOMAINS = ["math", "code", "science", "reasoning", "writing", "language", "knowledge", "instruction", "other"]
DIFFICULTIES = ["easy", "medium", "hard"]


@dataclass(frozen=True)
class Tags:
    think: tuple[str, str] = ("<think>", "</think>")
    answer: tuple[str, str] = ("<answer>", "</answer>")


def _between(text: Column, tags: tuple[str, str]) -> tuple[Column, Column]:
    """(whether both tags occur in order, what stands between the first such pair)."""
    p = rf"(?s)\Q{tags[0]}\E(.*?)\Q{tags[1]}\E"
    return text.rlike(p), strip(F.regexp_extract(text, p, 1))


def parse_response(response: Column, tags: Tags = Tags()) -> Column:
    """struct(reasoning, answer, fallback, valid) by four rules: both tag pairs; a thought and what follows it; the last
    conclusion phrase; the last sentence. Where none applies the whole text is reasoning and the answer empty."""
    t = strip(F.coalesce(response, F.lit("")))
    has_think, think = _between(t, tags.think)
    has_answer, answer = _between(t, tags.answer)
    tail = strip(F.regexp_extract(t, rf"(?s)\Q{tags.think[0]}\E.*?\Q{tags.think[1]}\E(.*)$", 1))
    # A greedy prefix finds the last match.
    marker = rf"(?iuUs)^(.*)({CONCLUSION}.*)$"
    before, after = strip(F.regexp_extract(t, marker, 1)), strip(F.regexp_extract(t, marker, 2))
    sentence = r"(?s)^(.*[.!?])[\s\x1c-\x1f\x85\p{Z}]+(.*)$"
    body, last = strip(F.regexp_extract(t, sentence, 1)), strip(F.regexp_extract(t, sentence, 2))
    make = lambda r, a, f, v: F.struct(r.alias("reasoning"), a.alias("answer"), F.lit(f).alias("fallback"), F.lit(v).alias("valid"))
    return (
        F.when(has_think & has_answer, make(think, answer, False, True))
        .when(has_think & (tail != ""), make(think, tail, False, True))
        .when((before != "") & (after != ""), make(before, after, True, True))
        .when((body != "") & (last != ""), make(body, last, True, True))
        .otherwise(make(t, F.lit(""), True, False))
    )


def with_parsed(df: DataFrame, tags: Tags = Tags()) -> DataFrame:
    """Fills reasoning and answer from the response where both are empty and the response is not."""
    parsed = parse_response(F.col("response"), tags)
    missing = (F.coalesce("reasoning", F.lit("")) == "") & (F.coalesce("answer", F.lit("")) == "") & ~is_blank(F.col("response"))
    return df.withColumn("_p", F.when(missing, parsed)).withColumns({"reasoning": F.coalesce("_p.reasoning", "reasoning"), "answer": F.coalesce("_p.answer", "answer")}).drop("_p")


def best_candidate(candidates: Column, tags: Tags = Tags()) -> Column:
    """struct(place, text) of the best of an array: tagged before split by rule before unparsed; among parsed ones the
    longest reasoning, among unparsed ones the longest text; the first on ties."""

    def rank(c: Column, i: Column) -> Column:
        p = parse_response(c, tags)
        good = p["valid"] & (p["reasoning"] != "") & (p["answer"] != "")
        kind = F.when(good & ~p["fallback"], 2).when(good, 1).otherwise(0)
        return F.struct(kind.alias("kind"), F.when(good, F.length(p["reasoning"])).otherwise(F.length(c)).alias("n"), (-i).alias("i"), c.alias("text"))

    best = F.array_max(F.transform(candidates, rank))
    return F.struct((-best["i"]).alias("place"), best["text"].alias("text"))


def longest_candidate(candidates: Column) -> Column:
    best = F.array_max(F.transform(candidates, lambda c, i: F.struct(F.length(c).alias("n"), (-i).alias("i"), c.alias("text"))))
    return best["text"]


_PARTS = "array<struct<text:string>>"
_TURNS = "array<struct<role:string,`from`:string,content:string,value:string>>"


def _turn_text(content: Column) -> Column:
    """A turn's text: a string, or the joined texts of a list of parts (kept as JSON by the reader)."""
    parts = F.from_json(content, _PARTS)
    joined = F.array_join(F.filter(F.transform(parts, lambda p: p["text"]), lambda x: x.isNotNull()), " ")
    return strip(F.coalesce(F.when(content.startswith("["), joined), content, F.lit("")))


def prompt_of_value(value: Column) -> Column:
    """The prompt in a field: plain text; or, in JSON, the first user turn of a chat after the last system turn before it;
    or a message object's content, value or text. Text that only looks like JSON is taken as it is. Null if there is none."""
    t = strip(value)
    turns = F.from_json(t, _TURNS, {"primitivesAsString": "true"})
    head = turns[0]
    chat = F.when(head["role"].isNotNull(), F.transform(turns, lambda m: F.struct(m["role"].alias("who"), _turn_text(m["content"]).alias("text"))))
    share = F.when(head["from"].isNotNull(), F.transform(turns, lambda m: F.struct(m["from"].alias("who"), strip(F.coalesce(m["value"], F.lit(""))).alias("text"))))
    spoken = F.filter(F.coalesce(chat, share), lambda m: m["text"] != "")
    # In one fold: the system text so far, and the prompt once a user has spoken.
    state = F.aggregate(
        spoken,
        F.struct(F.lit(None).cast("string").alias("system"), F.lit(None).cast("string").alias("prompt")),
        lambda a, m: F.when(a["prompt"].isNotNull(), a)
        .when(m["who"] == "system", F.struct(m["text"].alias("system"), a["prompt"].alias("prompt")))
        .when(m["who"].isin("user", "human"), F.struct(a["system"].alias("system"), F.concat(F.coalesce(F.concat(a["system"], F.lit("\n\n")), F.lit("")), m["text"]).alias("prompt")))
        .otherwise(a),
    )
    valid = F.try_parse_json(t).isNotNull()
    pick = lambda k: F.when(F.get_json_object(t, f"$.{k}") != "", F.get_json_object(t, f"$.{k}"))
    single = strip(F.coalesce(pick("content"), pick("value"), pick("text")))
    return F.when(t == "", None).when(t.startswith("[") & valid, state["prompt"]).when(t.startswith("{") & valid, F.when(single != "", single)).otherwise(t)


def field(df: DataFrame, path: str) -> Column:
    """A dotted path into nested columns; null where a step is missing."""
    kind: T.DataType = df.schema
    for step in path.split("."):
        if isinstance(kind, T.StructType) and step in kind.names:
            kind = kind[step].dataType
        elif isinstance(kind, T.MapType):
            kind = kind.valueType
        else:
            return F.lit(None).cast("string")
    return F.col(path)


_ANNOTATION = "domain string, topics array<string>, difficulty string, language string, summary string"


def json_object(text: Column) -> Column:
    """The JSON object in model output, as text, without thoughts: what a fence holds, else the whole, else from the first to
    the last brace."""
    t = strip(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?is)<think>.*?</think>", ""))
    fenced = strip(F.regexp_extract(t, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1))
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    is_object = lambda c: c.startswith("{") & F.try_parse_json(c).isNotNull()
    return F.when(is_object(fenced), fenced).when(is_object(t), t).when(is_object(inner), inner)


def parse_annotation(text: Column) -> Column:
    """struct(domain, topics, difficulty, language, summary), values outside the vocabulary replaced by defaults."""
    a = F.from_json(json_object(text), _ANNOTATION)
    return F.struct(
        F.when(a["domain"].isin(DOMAINS), a["domain"]).otherwise("other").alias("domain"),
        F.coalesce(a["topics"], F.array().cast("array<string>")).alias("topics"),
        F.when(a["difficulty"].isin(DIFFICULTIES), a["difficulty"]).otherwise("medium").alias("difficulty"),
        F.when(F.length(a["language"]) <= 10, a["language"]).otherwise("en").alias("language"),
        F.coalesce(a["summary"], F.lit("")).alias("summary"),
    )


def parse_generated(text: Column, least: int = 20) -> Column:
    """Prompts out of generator output: the strings of a JSON list, also of one with a comma too many or without its end,
    else all quoted strings; those of at least ``least`` characters."""
    t = F.coalesce(text, F.lit(""))
    whole = F.regexp_extract(t, r"(?s)(\[.*\])", 1)
    begun = F.regexp_extract(t, r"(?s)(\[.*)", 1)
    mended = F.regexp_replace(whole, r",\s*\]", "]")
    closed = F.concat(F.regexp_replace(begun, r"(?s),?\s*(?:\"[^\"]*)?$", ""), F.lit("]"))
    listed = F.coalesce(*[F.when(F.try_parse_json(c).isNotNull(), F.from_json(c, "array<string>")) for c in (whole, mended, closed)])
    quoted = F.regexp_extract_all(t, F.lit(f'"([^"]{{{least},}})"'), 1)
    return F.filter(F.transform(F.coalesce(listed, quoted), strip), lambda x: F.length(x) >= least)


def split_thought(text: Column, open_tag: str = "<think>", close_tag: str = "</think>") -> Column:
    """struct(reasoning, answer, complete): the opening tag may be missing; without a closing one the thought is incomplete."""
    t = F.coalesce(text, F.lit(""))
    closed = F.instr(t, close_tag) > 0
    head = F.regexp_extract(t, rf"(?s)^(.*?)\Q{close_tag}\E", 1)
    opened = F.instr(t, open_tag) > 0
    inner = lambda c: strip(F.regexp_replace(c, rf"(?s)^.*?\Q{open_tag}\E", ""))
    return (
        F.when(closed, F.struct(inner(head).alias("reasoning"), strip(F.regexp_extract(t, rf"(?s)\Q{close_tag}\E(.*)$", 1)).alias("answer"), F.lit(True).alias("complete")))
        .when(opened, F.struct(inner(t).alias("reasoning"), F.lit("").alias("answer"), F.lit(False).alias("complete")))
        .otherwise(F.struct(F.lit("").alias("reasoning"), strip(t).alias("answer"), F.lit(True).alias("complete")))
    )


def chat_messages(prompt: Column, system: Column | None = None) -> Column:
    turn = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return F.array(turn("user", prompt)) if system is None else F.array(turn("system", system), turn("user", prompt))


def char_chunks(text: Column, size_tokens: int = 1024, overlap_tokens: int = 128, chars_per_token: int = 4) -> Column:
    """Overlapping windows of a text by characters; a last window that earlier ones cover is kept."""
    size, step = size_tokens * chars_per_token, (size_tokens - overlap_tokens) * chars_per_token
    n = F.length(F.coalesce(text, F.lit("")))
    starts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substr(text, i, F.lit(size)))


def chunk_documents(docs: DataFrame, id_col: str, text_col: str, *, least: int = 50, **sizes: int) -> DataFrame:
    """(doc_id, chunk_no, chunk_id, chunk_hash, chunk) of the chunks that hold more than ``least`` characters."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(char_chunks(F.col(text_col), **sizes)).alias("chunk_no", "chunk"))
    named = rows.where(F.length(strip(F.col("chunk"))) > least).withColumn("chunk_id", F.concat(F.col("doc_id").cast("string"), F.lit(":chunk_"), F.format_string("%04d", "chunk_no")))
    return named.select("doc_id", "chunk_no", "chunk_id", F.substring(F.sha2("chunk_id", 256), 1, 32).alias("chunk_hash"), "chunk")


def token_chunks(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, *, size: int = 1024, overlap: int = 128, least: int = 50) -> DataFrame:
    """(doc_id, chunk_no, chunk): windows of at most ``size`` tokens of a public byte-level tokenizer, which begin ``overlap``
    tokens before the end of the one before. A window that isn't the last ends after its last paragraph, sentence or word
    within the second half, whichever of them comes first in this order; chunks of ``least`` characters or fewer are left out.
    ``vocabulary``: a file of base64 tokens and ranks. Null ids or texts are left out."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        e = tiktoken.Encoding("chunks", pat_str=TOKEN_PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            rows = []
            for i, t in zip(b["id"], b["text"], strict=True):
                tokens, lo, n = e.encode_ordinary(t), 0, 0
                while lo < len(tokens):
                    text, last = e.decode(tokens[lo : lo + size], errors="ignore"), lo + size >= len(tokens)
                    if not last:
                        stop = next((k + len(m) for m in ("\n\n", "\n", ". ", " ") if (k := text.rfind(m, len(text) // 2)) >= 0), len(text))
                        text = text[:stop]
                    if len(text.strip()) > least:
                        rows.append((i, n, text))
                    n += 1
                    if last:
                        break
                    lo += max(1, len(e.encode_ordinary(text)) - overlap)
            yield pd.DataFrame(rows, columns=["doc_id", "chunk_no", "chunk"])

    narrow = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInPandas(run, f"doc_id {id_type}, chunk_no int, chunk string")

"""Quality filters as a chain of reasons. The first that applies names the rejection; its part before the colon is counted.

Text filters are native expressions in one CASE. Filters that run code or call a model are separate stages over the rows
that are still alive, since a CASE doesn't keep Spark from evaluating Python for every row.
"""

from __future__ import annotations

import os
import re
import resource
import signal
import subprocess
import sys
import tempfile
import textwrap
import warnings
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltworks.functions import scores
from siltworks.functions.text import BLANK, is_blank, let, strip, words
from siltworks.operators.parse import CONCLUSION


@dataclass(frozen=True)
class TextLimits:
    least_words: int = 20
    most_words: int = 8000
    gram: int = 5
    gram_floor: int = 40
    words_per_repeat: int = 150
    least_ttr: float = 0.20
    ttr_segment: int = 100
    contradictions: bool = False
    contradiction_words: int = 80


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _parsed() -> Column:
    return (_text("reasoning") != "") | (_text("answer") != "")


def body() -> Column:
    """The text that is judged: reasoning and answer where the record is parsed, else the response."""
    return F.when(_parsed(), F.concat(_text("reasoning"), F.lit(" "), _text("answer"))).otherwise(_text("response"))


def long_enough(prompt: Column, least: int) -> Column:
    """Prompts of fewer characters are left out: 10 for collected ones, 20 for generated ones."""
    return F.length(F.trim(prompt)) >= least


def with_math_check(df: DataFrame, domains: Sequence[str] = ("math",)) -> DataFrame:
    """Adds ``math_numbers_disjoint``, null outside the stated domains. It informs and rejects nothing."""
    inside = F.lower(F.trim("domain")).isin(*domains)
    return df.withColumn("math_numbers_disjoint", F.when(inside, scores.numbers_disjoint(F.col("reasoning"), F.col("answer"))))


def structural_reason(limits: TextLimits = TextLimits()) -> Column:
    """Null, or why the record's form is rejected. Columns: prompt, response, reasoning, answer."""
    parsed = _parsed()
    body = F.when(parsed, F.concat(_text("reasoning"), F.lit(" "), _text("answer"))).otherwise(_text("response"))
    n = F.size(words(body))
    looping = scores.loops(F.when(parsed, _text("reasoning")).otherwise(_text("response")), limits.gram, limits.gram_floor, limits.words_per_repeat)
    return (
        F.when(is_blank(F.col("prompt")), "missing_prompt")
        .when(~parsed & is_blank(F.col("response")), "missing_response")
        .when(parsed & is_blank(F.col("reasoning")), "missing_reasoning")
        .when(parsed & is_blank(F.col("answer")), "missing_answer")
        .when(n < limits.least_words, F.concat(F.lit("too_short:"), n.cast("string")))
        .when(n > limits.most_words, F.concat(F.lit("too_long:"), n.cast("string")))
        .when(looping, "repetition_loop")
    )


def heuristic_reason(limits: TextLimits = TextLimits()) -> Column:
    """Null, or why the record's content is rejected."""
    parsed = _parsed()
    body = F.when(parsed, F.concat(_text("reasoning"), F.lit(" "), _text("answer"))).otherwise(_text("response"))
    ttr = scores.segment_ttr(words(F.lower(body)), limits.ttr_segment)
    out = F.when(ttr < limits.least_ttr, F.concat(F.lit("low_info_density:"), F.format_number(ttr, 2))).when(parsed & scores.boilerplate(F.col("answer")), "boilerplate_answer")
    if limits.contradictions:
        short = F.size(words(F.col("answer"))) <= limits.contradiction_words
        out = out.when(parsed & short & scores.contradicts(_text("reasoning"), _text("answer")), "self_contradiction")
    return out


def family(reason: Column) -> Column:
    return F.substring_index(reason, ":", 1)


def bucket(reason: Column) -> Column:
    """The first two parts of a reason, at most 30 characters."""
    return F.substring(F.substring_index(reason, ":", 2), 1, 30)


# How a code block is found, and what tells limits of the sandbox from faults of the code.
CODE_BLOCK = r"(?is)```(?:python|py)\s*\n(.*?)```"
ENVIRONMENT_ERRORS = ("ModuleNotFoundError", "ImportError", "EOFError", "FileNotFoundError", "PermissionError", "ConnectionError", "SSLError", "Max retries exceeded", "gaierror", "URLError", "HTTPError", "TimeoutError", "NameError", "KeyboardInterrupt", "MemoryError", "UnicodeEncodeError", "UnicodeDecodeError")
LONG_RUNNING = ("input(", "mainloop(", "plt.show(", "app.run(", "serve_forever", "run_forever", "time.sleep(", "import turtle", "import tkinter", "import pygame", "from_pretrained(")


def last_code_block(reasoning: Column, answer: Column) -> Column:
    """The last block fenced as Python; null without one."""
    both = F.concat(F.coalesce(reasoning, F.lit("")), F.lit("\n"), F.coalesce(answer, F.lit("")))
    return F.try_element_at(F.regexp_extract_all(both, F.lit(CODE_BLOCK), 1), F.lit(-1))


def _compiles(source: str) -> bool:
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        try:
            compile(source, "<block>", "exec")
        except SyntaxError:
            return False
    return True


def _limit_process() -> None:
    os.setsid()
    resource.setrlimit(resource.RLIMIT_CPU, (30, 30))
    resource.setrlimit(resource.RLIMIT_AS, (1 << 30, 1 << 30))
    resource.setrlimit(resource.RLIMIT_FSIZE, (1 << 24, 1 << 24))


def run_code(code: str, seconds: float = 10.0) -> tuple[bool, bool, str]:
    """(ended well, timed out, stderr) of a program in its own process group, an empty environment and a folder of its own."""
    with tempfile.TemporaryDirectory() as folder:
        p = subprocess.Popen([sys.executable, "-I", "-c", code], stdin=subprocess.DEVNULL, stdout=subprocess.DEVNULL, stderr=subprocess.PIPE, cwd=folder, env={"PATH": "/usr/bin:/bin", "PYTHONIOENCODING": "utf-8"}, preexec_fn=_limit_process)  # noqa: PLW1509
        try:
            _, err = p.communicate(timeout=seconds)
            return p.returncode == 0, False, err.decode("utf-8", "replace")
        except subprocess.TimeoutExpired:
            return False, True, ""
        finally:
            try:
                os.killpg(p.pid, signal.SIGKILL)
            except OSError:
                pass
            p.wait()


def code_verdict(block: str | None, seconds: float = 10.0) -> tuple[bool, str | None]:
    """(passed, reason) of the last Python block of a record. Only faults of the code itself reject."""
    code = (block or "").strip()
    if not code:
        return True, None
    if ">>>" in code:
        return True, "code_repl_transcript"
    if re.search(r"(?m)^\s*[!%]\w", code):
        return True, "code_notebook_shell"
    try:
        if not _compiles(code):
            flat = textwrap.dedent(code)
            inner = "def block():\n" + textwrap.indent(flat, "    ")
            return (True, "code_fragment") if _compiles(flat) or _compiles(inner) else (False, "code_syntax_error")
    except (ValueError, MemoryError, RecursionError):
        return True, "code_compile_uncertain"
    well, late, err = run_code(code, seconds)
    if late:
        return (True, "code_long_running") if any(m in code for m in LONG_RUNNING) else (False, "code_timeout")
    if well:
        return True, None
    lines = [x.strip() for x in err.splitlines() if x.strip()]
    last = lines[-1] if lines else ""
    if any(m in err for m in ENVIRONMENT_ERRORS):
        return True, f"code_env_uncertain:{last[:80]}"
    return False, f"code_error:{last[:200]}"


def code_reasons(df: DataFrame, id_col: str, seconds: float = 10.0) -> DataFrame:
    """(id, code_passed, code_reason) of rows with reasoning and answer; only rows with a block reach Python."""
    blocks = df.select(F.col(id_col).alias("id"), last_code_block(F.col("reasoning"), F.col("answer")).alias("block")).where("block is not null")
    id_type = blocks.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            v = [code_verdict(x, seconds) for x in b["block"]]
            yield pd.DataFrame({"id": b["id"], "code_passed": [p for p, _ in v], "code_reason": [r for _, r in v]})

    return blocks.mapInPandas(run, f"id {id_type}, code_passed boolean, code_reason string").withColumnRenamed("id", id_col)


def sampled(key: Column, rate: float, seed: int = 42) -> Column:
    """True for about the share ``rate`` of the keys, the same ones whatever the partitioning."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(10_000)) < int(rate * 10_000)


def with_reason(df: DataFrame, limits: TextLimits = TextLimits()) -> DataFrame:
    """Adds ``reason``: of the text filters the first that applies, null where the record passes."""
    return df.withColumn("reason", F.coalesce(structural_reason(limits), heuristic_reason(limits)))


def run_chain(df: DataFrame, id_col: str, *, limits: TextLimits = TextLimits(), code_domains: Sequence[str] = ("code",), seconds: float = 10.0, judge: Callable[[pd.DataFrame], pd.Series] | None = None, judge_rate: float = 0.1, judge_least: float = 6.0) -> DataFrame:
    """Adds ``reason`` by the whole chain, cheapest filters first: text, then code in the code domains, then a judge on a
    sample; and ``math_numbers_disjoint`` in the domain math. judge: prompt, reasoning and answer columns of a batch ->
    scores; a null score passes."""
    out = with_math_check(with_reason(df, limits))
    if code_domains:
        todo = out.where(F.col("reason").isNull() & F.lower(F.trim("domain")).isin(*code_domains))
        bad = code_reasons(todo, id_col, seconds).where("not code_passed").select(id_col, "code_reason")
        out = out.join(bad.dropDuplicates([id_col]), id_col, "left").withColumn("reason", F.coalesce("reason", "code_reason")).drop("code_reason")
    if judge is not None:
        todo = out.where(F.col("reason").isNull() & sampled(F.col(id_col), judge_rate)).select(F.col(id_col).alias("id"), "prompt", "reasoning", "answer")
        id_type = todo.schema["id"].dataType.simpleString()

        def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"id": b["id"], "judge_score": judge(b)})

        low = todo.mapInPandas(score, f"id {id_type}, judge_score double").where(F.col("judge_score") < judge_least).select(F.col("id").alias(id_col), F.lit("llm_judge").alias("judge_reason"))
        out = out.join(low.dropDuplicates([id_col]), id_col, "left").withColumn("reason", F.coalesce("reason", "judge_reason")).drop("judge_reason")
    return out


def words_judge(batch: pd.DataFrame) -> pd.Series:
    """A stand-in for a judging model: as many points as the answer has words."""
    return batch["answer"].fillna("").str.split().str.len().astype(float)


# How the older chain finds the prefix of a channel.
CHANNEL = r"(?i)^\s*<\|[^\n>]*>?(?:thought|analysis|final)?\s*"


def older_chain(df: DataFrame) -> DataFrame:
    """Adds ``reason`` by the text filters of the older chain, for comparison. It parses every response anew: both tag pairs,
    else the first conclusion phrase, else the last sentence; and it is stricter: 50 words or more, no run of five words more
    than three times (in 20 words or more), a type-token ratio of 0.3, contradictions in answers of any length."""
    t = strip(F.regexp_replace(F.coalesce(F.col("response"), F.lit("")), CHANNEL, ""))
    between = lambda tag: strip(F.regexp_extract(t, rf"(?s)<{tag}>(.*?)</{tag}>", 1))
    tagged = t.rlike(r"(?s)<think>.*?</think>") & t.rlike(r"(?s)<answer>.*?</answer>")
    first = rf"(?is)^(.*?)({CONCLUSION}.*)$"
    before, after = strip(F.regexp_extract(t, first, 1)), strip(F.regexp_extract(t, first, 2))
    parts = F.filter(F.transform(F.split(t, rf"(?<=[.!?]){BLANK}+"), strip), lambda x: x != "")
    marked, several = (before != "") & (after != ""), F.size("_s") >= 2
    whole = df.withColumn("_s", parts)
    r = F.when(tagged, between("think")).when(marked, before).when(several, F.array_join(F.slice("_s", 1, F.size("_s") - 1), " ")).otherwise(t)
    a = F.when(tagged, between("answer")).when(marked, after).when(several, F.element_at("_s", -1)).otherwise("")
    out = whole.withColumns({"_r": r, "_a": a}).withColumn("_b", F.concat("_r", F.lit(" "), "_a"))
    n, low = F.size(words(F.col("_b"))), words(F.lower("_r"))
    loops = let(low, lambda x: F.when(F.size(x) < 20, False).otherwise(scores.top_gram_count(x, 5) > 3))
    ttr = scores.segment_ttr(words(F.lower("_b")))
    reason = (
        F.when(is_blank(F.col("prompt")), "missing_prompt").when(is_blank(F.col("_r")), "missing_reasoning").when(is_blank(F.col("_a")), "missing_answer")
        .when(n < 50, F.concat(F.lit("too_short:"), n.cast("string"))).when(n > 8000, F.concat(F.lit("too_long:"), n.cast("string"))).when(loops, "repetition_loop")
        .when(ttr < 0.3, F.concat(F.lit("low_info_density:"), F.format_number(ttr, 2))).when(scores.boilerplate(F.col("_a")), "boilerplate_answer").when(scores.contradicts(F.col("_r"), F.col("_a")), "self_contradiction")
    )
    return out.withColumn("reason", reason).drop("_s", "_r", "_a", "_b")


def pass_rate(judged: DataFrame) -> DataFrame:
    """One row: records, those that pass, and their share to four places."""
    n = judged.agg(F.count("*").alias("n"), F.count_if(F.col("reason").isNull()).alias("passed"))
    return n.withColumn("pass_rate", F.round(F.col("passed") / F.greatest("n", F.lit(1)), 4))


def reason_histogram(judged: DataFrame, good: Column) -> DataFrame:
    """(good, family, n): the reasons of the records that a reference calls good and of those that it calls bad."""
    return judged.groupBy(good.alias("good"), F.coalesce(family(F.col("reason")), F.lit("passed")).alias("family")).agg(F.count("*").alias("n"))


def filter_report(judged: DataFrame) -> DataFrame:
    """(domain, family, n): records by domain and kind of rejection, null for those that pass."""
    return judged.groupBy("domain", family(F.col("reason")).alias("family")).agg(F.count("*").alias("n"))


def confusion(df: DataFrame, passed: Column, good: Column) -> DataFrame:
    """One row of counts and rates of a filter against a reference; a rejection of a bad record is a true positive."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    known = df.where(passed.isNotNull() & good.isNotNull())
    c = known.agg(n(~passed & ~good).alias("tp"), n(~passed & good).alias("fp"), n(passed & ~good).alias("fn"), n(passed & good).alias("tn"))
    over = lambda a, b: F.when(b != 0, a / b)
    c = c.withColumns({k: F.coalesce(k, F.lit(0)) for k in ("tp", "fp", "fn", "tn")})
    rates = c.select("*", over(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), over(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), over(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"), over(F.col("tp") + F.col("tn"), F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("accuracy"))
    return rates.withColumn("f1", over(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def flips(df: DataFrame, before: Column, after: Column) -> DataFrame:
    """Verdicts of two filters: how many records each of the four changes has."""
    kind = F.when(before & after, "pass_pass").when(before, "pass_fail").when(after, "fail_pass").otherwise("fail_fail")
    return df.groupBy(kind.alias("flip")).agg(F.count("*").alias("n"))

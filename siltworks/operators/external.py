"""Calls to models outside of Spark as pluggable functions, batch by batch, each batch with bounded concurrency.

A call is not repeatable for free: write its result before using it twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.operators.parse import parse_annotation, parse_generated
from siltworks.session import stored


def with_retries(call: Callable[[str], str], attempts: int = 2, wait: float = 1.0) -> Callable[[str], str | None]:
    """The call, again after a failure with doubled waits; null when all attempts fail."""

    def run(x: str) -> str | None:
        for i in range(attempts):
            try:
                return call(x)
            except Exception:  # noqa: BLE001 - whatever a client raises
                if i + 1 < attempts:
                    time.sleep(wait * 2**i)
        return None

    return run


def call_model(df: DataFrame, id_col: str, prompt: str, client: Callable[[], Callable[[str], str]], *, concurrency: int = 16, attempts: int = 2, wait: float = 1.0) -> DataFrame:
    """(id, output): a model's output for each prompt; null where it failed. ``client`` makes a client once a task."""
    id_type = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = with_retries(client(), attempts, wait)
        with ThreadPoolExecutor(concurrency) as pool:
            for b in batches:
                yield pd.DataFrame({"id": b["id"], "output": list(pool.map(ask, b["prompt"]))})

    return df.select(F.col(id_col).alias("id"), F.col(prompt).alias("prompt")).mapInPandas(run, f"id {id_type}, output string").withColumnRenamed("id", id_col)


def generate(df: DataFrame, id_col: str, prompt: str, client: Callable[[], Callable[[str], str]], *, least: int = 20, **options: object) -> DataFrame:
    """(id, place, text): the prompts that a generator's output for each row lists; none where the call failed."""
    out = call_model(df, id_col, prompt, client, **options)
    return out.select(id_col, F.posexplode(parse_generated(F.col("output"), least)).alias("place", "text"))


def annotate(df: DataFrame, id_col: str, prompt: str, client: Callable[[], Callable[[str], str]], folder: str, *, every: int = 100_000, **options: object) -> DataFrame:
    """(id, domain, topics, difficulty, language, summary), defaults where the call failed or the output says nothing usable.

    Results are kept in ``folder`` in parts of about ``every`` rows; a run that broke off goes on with what is missing.
    """
    spark = df.sparkSession
    done = read_parts(spark, folder, id_col, df.schema[id_col].dataType.simpleString())
    todo = stored(df.select(id_col, prompt).where(F.col(id_col).isNotNull()).dropDuplicates([id_col]).join(done.select(id_col), id_col, "left_anti"))
    parts = max(1, -(-todo.count() // every))
    for k in range(parts):
        some = todo.where(F.pmod(F.xxhash64(id_col), F.lit(parts)) == k)
        out = call_model(some, id_col, prompt, client, **options)
        out.select(id_col, parse_annotation(F.col("output")).alias("a")).select(id_col, "a.*").write.mode("append").parquet(folder)
    return read_parts(spark, folder, id_col, df.schema[id_col].dataType.simpleString())


def read_parts(spark, folder: str, id_col: str, id_type: str) -> DataFrame:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], f"{id_col} {id_type}, domain string, topics array<string>, difficulty string, language string, summary string")
    return spark.read.parquet(folder)


def echo_client() -> Callable[[str], str]:
    """A stub: thinks about the number of words and answers with the first ones."""
    return lambda p: f"<think>The prompt has {len((p or '').split())} words.</think><answer>{' '.join((p or '').split()[:5])}</answer>"


def listing_client() -> Callable[[str], str]:
    """A stub of a generator: the first two pieces of 20 characters as a list with a comma too many."""
    return lambda p: f'Here: ["{p[:20]}", "{p[20:40]}",]'

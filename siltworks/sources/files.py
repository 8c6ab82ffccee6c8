"""Files in and out: JSON lines, text corpora, test items, vectors, snapshots."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.functions.text import is_blank, nonempty, strip
from siltworks.operators.parse import prompt_of_value
from siltworks.operators.relations import cap_per_group
from siltworks.operators.sampling import ranked
from siltworks.session import stored

PROMPT = T.StructType([T.StructField(c, T.StringType()) for c in ("prompt_id", "prompt", "source", "domain", "stage", "chunk_id")])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system that a path belongs to has it; patterns may match anything."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """The names of a folder's folders, in order."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, *, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines). A missing path has no rows; blank lines are skipped; bad lines are set apart, or raise if strict.
    Rows carry ``file`` so that the order of files can be kept."""
    paths = [path] if isinstance(path, str) else list(path)
    paths = [p for p in paths if exists(spark, p)]
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    if not paths:
        empty = spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("file", T.StringType())]))
        return empty, spark.createDataFrame([], "line string, file string")
    # Lines are parsed by an expression, so that a reader's column pruning can't hide what is bad.
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file")).where(~is_blank(F.col("value")))
    mode = "FAILFAST" if strict else "PERMISSIVE"
    parsed = lines.select("file", "value", F.from_json("value", full, {"mode": mode, "columnNameOfCorruptRecord": "_bad"} if not strict else {"mode": mode}).alias("r"))
    good = parsed.where(F.col("r").isNotNull() & F.col("r._bad").isNull()).select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields], "file")
    bad = parsed.where(F.col("r").isNull() | F.col("r._bad").isNotNull()).select(F.col("value").alias("line"), "file")
    return good, bad


_PLACE = ("_file", "_start", "_line")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The non-blank lines of files with what orders them: by file name, then as they stand in the file."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    return rows.where(~is_blank(F.col("value")))


def read_source(spark: SparkSession, path: str, field: str, source: str, *, cap: int | None = None, least: int = 10) -> DataFrame:
    """(prompt, source, file) of a local source: the stated field, a dotted path, of every line, whatever else the line
    holds; lines without it are left out, and so are lines that are no JSON. The cap counts prompts in the order of files and
    lines; prompts under ``least`` characters are left out after it."""
    if not exists(spark, path):
        return spark.createDataFrame([], "prompt string, source string, file string")
    lines = read_lines(spark, path).withColumn("prompt", prompt_of_value(F.get_json_object("value", "$." + field))).where("prompt is not null").withColumn("source", F.lit(source))
    kept = lines if cap is None else cap_per_group(lines, "source", list(_PLACE), cap)
    return kept.where(F.length(F.trim("prompt")) >= least).select("prompt", "source", F.col("_file").alias("file"))


def read_export(spark: SparkSession, folder: str, config: str | None = None, split: str | None = None) -> DataFrame | None:
    """A local export of a published dataset, Parquet or JSON lines: folder/config/split, either of which may be missing
    from the path. Null where there is nothing, so that a source that can't be read is skipped."""
    path = "/".join(x for x in (folder, config, split) if x)
    if exists(spark, f"{path}/*.parquet"):
        return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)
    if exists(spark, f"{path}/*.json*"):
        return spark.read.option("pathGlobFilter", "*.json*").json(path)
    return None


def numbered_corpus(df: DataFrame, name: str, text: str, least: int = 100) -> DataFrame:
    """(doc_id, text) of a published corpus: the dataset's name and the row's place in it."""
    placed = df.select(F.lit(name).alias("_name"), F.col(text).alias("text"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    rows = ranked(placed, ["_name"], list(_PLACE), "_r")
    return rows.where(F.length("text") > least).select(F.concat("_name", F.lit(":"), (F.col("_r") - 1).cast("string")).alias("doc_id"), "text")


def read_eval(spark: SparkSession, folder: str, *, configs: str | Sequence[str] | None = None, splits: Sequence[str] = ("test",), most: int | None = None) -> DataFrame | None:
    """A test set's rows with ``config`` and ``split``: one configuration, stated ones, or ``"all"``; splits that a
    configuration lacks are skipped. ``most`` bounds the rows of all of them together, in that order."""
    names = subfolders(spark, folder) if configs == "all" else [configs] if isinstance(configs, str) or configs is None else list(configs)
    parts = [(c, s, d) for c in names for s in splits if (d := read_export(spark, folder, c, s)) is not None]
    if not parts:
        return None
    rows = [d.withColumns({"config": F.lit(c), "split": F.lit(s), "_part": F.lit(i), "_line": F.monotonically_increasing_id()}) for i, (c, s, d) in enumerate(parts)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return (out if most is None else out.orderBy("_part", "_line").limit(most)).drop("_part", "_line")


def import_answers(spark: SparkSession, path: str) -> DataFrame:
    """(prompt_id, response) of a file of model answers; an answer that is an object rather than a text comes as its JSON."""
    lines = read_lines(spark, path)
    return lines.select(F.get_json_object("value", "$.prompt_id").alias("prompt_id"), F.get_json_object("value", "$.response").alias("response")).where("prompt_id is not null")


def shard_listing(spark: SparkSession, folders: Sequence[tuple[str, str | None]]) -> DataFrame:
    """(tag, shard, place) of the JSON line files of folders: the stated tag, or one made of the folder's name; in the order
    of folders and names."""
    rows = []
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder, tag in folders:
        p = hadoop(f"{folder.rstrip('/')}/*.jsonl")
        found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
        rows += [(tag or re.sub("[^0-9A-Za-z]+", "_", folder.rstrip("/").rsplit("/", 1)[-1]).strip("_"), n) for n in sorted(str(x.getPath().toString()) for x in found)]
    return spark.createDataFrame([(t, n, i) for i, (t, n) in enumerate(rows)], "tag string, shard string, place int")


def count_lines(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).where(~is_blank(F.col("value"))).count()


def record_id(file: Column, text: Column) -> Column:
    """A record's id: its file's name and a hash of how its text begins."""
    return F.concat(file, F.lit(":"), F.substring(F.md5(F.substring(text, 1, 100)), 1, 8))


def read_corpus(spark: SparkSession, folder: str, least: int = 100) -> DataFrame:
    """(doc_id, text) of a folder: .txt and .md files as wholes, .jsonl and .json record by record; texts of more than
    ``least`` characters. A record's id is its file's name and a hash of how it begins."""
    files = lambda glob: spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
    whole = files("*.{txt,md}").option("wholetext", "true").text(folder).select(F.col("_metadata.file_name").alias("doc_id"), F.col("value").alias("text"))
    lines = files("*.{jsonl,json}").text(folder).select(F.col("_metadata.file_name").alias("file"), F.from_json("value", "text string, content string").alias("r"))
    record = lines.select("file", F.coalesce("r.text", "r.content").alias("text")).where("text is not null").select(record_id(F.col("file"), F.col("text")).alias("doc_id"), "text")
    return whole.unionByName(record).where(F.length("text") > least)


def eval_texts(df: DataFrame, owner: str, order: str, fields: Sequence[str]) -> DataFrame:
    """(owner, order, field_no, text): one row per non-empty text of the stated fields; lists are joined by blanks."""

    def text(c: str):
        if isinstance(df.schema[c].dataType, T.ArrayType):
            parts = F.filter(F.transform(F.col(c), lambda x: strip(x.cast("string"))), lambda x: x != "")
            return nonempty(F.array_join(parts, " "))
        return nonempty(prompt_of_value(F.col(c).cast("string")))

    return df.select(F.col(owner).alias("owner"), F.col(order).alias("order"), F.posexplode(F.array(*[text(f) for f in fields])).alias("field_no", "text")).where("text is not null")


def read_vectors(spark: SparkSession, path: str, id_col: str, vector: str, *, ordered: bool = False) -> DataFrame:
    """(id, vector) of Parquet shards; in the order of shards and rows if wanted."""
    rows = spark.read.parquet(path)
    if not ordered:
        return rows.select(id_col, F.col(vector).cast("array<float>").alias(vector))
    placed = rows.select(id_col, F.col(vector).cast("array<float>").alias(vector), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_line"))
    return placed.orderBy("_file", "_line").select(id_col, vector)


def write_jsonl(df: DataFrame, path: str, *, shard_bytes: int = 500_000_000, row_bytes: int = 2_000) -> None:
    """JSON lines in files of about ``shard_bytes``; published by the commit protocol only when complete."""
    df.write.mode("error").option("maxRecordsPerFile", max(1, shard_bytes // row_bytes)).json(path)


def append_jsonl(df: DataFrame, folder: str, *, shard_bytes: int = 500_000_000, done: Callable[[str], None] | None = None) -> str | None:
    """JSON lines in a new folder under ``folder``, numbered after those that are there, in files of about ``shard_bytes`` by
    the measured size of the rows. Calls ``done`` with the folder once it is published. No rows: nothing is written."""
    spark = df.sparkSession
    rows = stored(df)
    row = rows.agg(F.avg(F.octet_length(F.to_json(F.struct(*rows.columns))))).first()[0]
    if row is None:
        return None
    last = max((int(n.rsplit("-", 1)[1]) for n in subfolders(spark, folder) if re.fullmatch(r"shards-\d+", n)), default=-1)
    path = f"{folder.rstrip('/')}/shards-{last + 1:05d}"
    rows.write.mode("error").option("maxRecordsPerFile", max(1, int(shard_bytes // (row + 1)))).json(path)
    if done:
        done(path)
    return path


def write_by_shard(df: DataFrame, shard: str, path: str) -> None:
    """Rows in a folder for each input shard, published together."""
    df.write.mode("error").partitionBy(shard).json(path)


def write_version(df: DataFrame, folder: str) -> str:
    """The next version of a table: a new folder beside the ones before, so that the table may be derived from itself."""
    last = max((int(n[1:]) for n in subfolders(df.sparkSession, folder) if re.fullmatch(r"v\d+", n)), default=0)
    path = f"{folder.rstrip('/')}/v{last + 1:06d}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return path


def read_version(spark: SparkSession, folder: str) -> DataFrame | None:
    """The last version that was published; null where there is none."""
    for n in sorted((n for n in subfolders(spark, folder) if re.fullmatch(r"v\d+", n)), reverse=True):
        if exists(spark, f"{folder.rstrip('/')}/{n}/_SUCCESS"):
            return spark.read.parquet(f"{folder.rstrip('/')}/{n}")
    return None


def save_annotations(df: DataFrame, folder: str) -> str:
    """Annotations with their topics as JSON texts, as the next version of a checkpoint."""
    return write_version(df.withColumn("topics", F.to_json("topics")), folder)


def load_annotations(spark: SparkSession, folder: str) -> DataFrame | None:
    rows = read_version(spark, folder)
    return None if rows is None else rows.withColumn("topics", F.from_json("topics", "array<string>"))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("error").option("compression", "zstd").parquet(path)


def final_records(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The schema of the published set, with defaults; ids that are missing are numbered in the order of the output.

    The numbering sorts only the rows without an id, by range partitions, and adds each partition's offset.
    """
    text = lambda c, d="": F.coalesce(F.col(c).cast("string"), F.lit(d)) if c in df.columns else F.lit(d)
    base = df.select(
        nonempty(F.col("prompt_id")).alias("id"), text("prompt").alias("prompt"), text("reasoning").alias("reasoning"), text("answer").alias("answer"), text("domain", "general").alias("domain"),
        text("difficulty", "medium").alias("difficulty"), text("language", "en").alias("language"), text("source", "unknown").alias("source"), text("teacher_model", "unknown").alias("teacher_model"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    )
    keys = [f"_o{i}" for i in range(len(order))]
    named, unnamed = base.where("id is not null").drop(*keys), base.where("id is null")
    # Written first, since the counts and the numbers must see the same partitions.
    placed = stored(unnamed.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33)))
    starts = {r["_p"]: r["n"] for r in placed.groupBy("_p").agg(F.count("*").alias("n")).collect()}
    offset, table = 0, []
    for p in sorted(starts):
        table.append((p, offset))
        offset += starts[p]
    offsets = df.sparkSession.createDataFrame(table, "_p long, _off long")
    numbered = placed.join(offsets, "_p").withColumn("id", F.format_string("gen_%010d", F.col("_off") + F.col("_m") - F.shiftleft("_p", 33)))
    return named.unionByName(numbered.select(named.columns))


def write_snapshot(df: DataFrame, path: str, meta: dict) -> None:
    """A Parquet snapshot with a small file about it beside the data."""
    write_parquet(df, f"{path}/snapshot.parquet")
    df.sparkSession.createDataFrame([(json.dumps(meta, sort_keys=True),)], "value string").coalesce(1).write.mode("error").text(f"{path}/meta")


def resolve_inputs(spark: SparkSession, cleaned: Mapping[str, str], raw: Mapping[str, str]) -> list[tuple[str, str]]:
    """(stage, folder): the cleaned folder of a stage where it exists, else its raw one where that does."""
    picked = [(s, next((f for f in (cleaned.get(s), raw.get(s)) if f and exists(spark, f)), None)) for s in sorted({*cleaned, *raw})]
    return [(s, f) for s, f in picked if f]


def detect_stage(spark: SparkSession, folders: Sequence[tuple[str, str]]) -> str | None:
    """The first of the stages, in order of preference, whose folder holds anything."""
    return next((stage for stage, folder in folders if exists(spark, f"{folder.rstrip('/')}/*")), None)

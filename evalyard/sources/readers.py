"""Sources: JSON lines with and without the strict prefix rule, ids, counts, CSV and result tables, YAML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import regex, strip
from ..operators.rows import row_numbers


def ordered_lines(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """value of each non-blank line with its order: file, block (start of the split in the file) and nth (within one task).

    Files are read in splits, so no task or string holds a whole file. Unreadable files are passed over; without
    any file there are no lines.
    """
    paths = path if recursive else sorted(set.difference(*map(set, unreadable_files(spark, path))))
    if not paths:
        return spark.createDataFrame([], "file string, block bigint, nth bigint, value string")
    lines = spark.read.text(paths, recursiveFileLookup=recursive)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("nth"), "value")
    return lines.where(F.length(strip(F.col("value"))) > 0)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, which may be a pattern, matches anything."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def unreadable_files(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(all files that ``path`` matches, those of them that may not be read), sorted; only names reach the driver."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s for s in fs.globStatus(at) or []]
    files = [f for s in found for f in (fs.listStatus(s.getPath()) if s.isDirectory() else [s])]
    names = sorted(f.getPath().toString() for f in files if f.isFile() and not f.getPath().getName().startswith(("_", ".")))
    read = jvm.org.apache.hadoop.fs.permission.FsAction.READ

    def closed(name: str) -> bool:
        try:
            fs.access(jvm.org.apache.hadoop.fs.Path(name), read)
            return False
        except Exception as e:
            if "AccessControlException" in str(e):
                return True
            raise

    return names, [n for n in names if closed(n)]


def readable_files(spark: SparkSession, path: str) -> list[str]:
    """The readable files that ``path`` matches; no match and no readable file are errors."""
    names, closed = unreadable_files(spark, path)
    if not names:
        raise FileNotFoundError(f"no files at {path!r}")
    if len(closed) == len(names):
        raise PermissionError(f"no readable files at {path!r}: {', '.join(closed)}")
    return sorted(set(names) - set(closed))


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Well-formed records of JSON lines; malformed lines are left out."""
    bad = T.StructField("_bad", T.StringType())
    full = T.StructType([*schema.fields, bad])
    parsed = spark.read.text(path).where(F.length(strip(F.col("value"))) > 0).select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r._bad is null").select(*[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def _prefix(spark: SparkSession, path: str, schema: T.StructType, index: str) -> DataFrame:
    """Lines up to the first malformed one, with their record ``r`` and number: numbered once, then cut by one minimum."""
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    rows = ordered_lines(spark, path).withColumn("r", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    rows = row_numbers(rows, ["file", "block", "nth"], index)
    cut = rows.where("r._bad is not null").agg(F.min(index).alias("_cut"))
    return rows.join(F.broadcast(cut)).where(F.col("_cut").isNull() | (F.col(index) < F.col("_cut")))


def read_prefix(spark: SparkSession, path: str, schema: T.StructType, index: str = "row_index") -> DataFrame:
    """Records up to the first malformed line of the first bad file, in file and line order, numbered from 0.

    Large files are read in splits; blank lines aren't counted.
    """
    return _prefix(spark, path, schema, index).select(index, *[F.col(f"r.{f.name}").alias(f.name) for f in schema.fields])


def repair(spark: SparkSession, path: str, schema: T.StructType, out: str) -> int:
    """Write the lines that ``read_prefix`` keeps, in order, to the new folder ``out``; returns how many.

    The files at ``path`` stay as they are, since shared stores can't cut a file in place; later
    appends go to ``out``.
    """
    kept = _prefix(spark, path, schema, "_line")
    kept.repartitionByRange("_line").sortWithinPartitions("_line").select("value").write.text(out)
    return spark.read.text(out).count()


def completed_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct row ids of a results file, by the first ``"row": n`` of each line, without parsing JSON; none where there is no file yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], "row bigint")
    p = r'"row"\s*:\s*(\d+)'
    return spark.read.text(path).where(F.col("value").rlike(p)).select(F.regexp_extract("value", p, 1).cast("bigint").alias("row")).distinct()


def count_records(spark: SparkSession, path: str) -> int:
    """Non-blank lines of the readable files; no match and no readable file are errors."""
    return spark.read.text(readable_files(spark, path)).where(F.length(strip(F.col("value"))) > 0).count()


def read_csv(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """Quoted CSV with a header; a missing required column is an error."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    if missing := [c for c in required if c not in df.columns]:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_variants(spark: SparkSession, path: str, index: str = "row_index") -> DataFrame:
    """Records of the readable files as VARIANT ``v``, numbered from 0 in file and line order; malformed lines are null."""
    return row_numbers(ordered_lines(spark, path).withColumn("v", F.try_parse_json("value")), ["file", "block", "nth"], index).select(index, "v")


def result_scores(df: DataFrame, prefix: str = "bfcl_", order: str | None = None) -> DataFrame:
    """Percent cells of one row of a result table in long form: name, value in 0..1.

    The row is the first by ``order`` where it is given, else the first that was read, in file order; whatever columns there are are unpivoted.
    Cells that are no percentage, such as N/A, are left out; a table without a row or without scores gives none.
    """
    cells = df.select(*[F.col(f"`{c}`").cast("string").alias(f"c{k}") for k, c in enumerate(df.columns)], (F.col(order) if order else F.monotonically_increasing_id()).alias("_at"))
    first = cells.agg(F.min_by(F.struct(*[f"c{k}" for k in range(len(df.columns))]), "_at").alias("r")).select("r.*")
    long = first.unpivot([], list(first.columns), "at", "cell")
    names = F.element_at(F.array(*map(F.lit, df.columns)), F.expr("cast(substring(at, 2) as int) + 1"))
    long = long.withColumn("name", F.concat(F.lit(prefix), F.regexp_replace(F.lower(names), r"[ -]", "_")))
    return long.where(F.endswith("cell", F.lit("%"))).select("name", (F.regexp_replace("cell", "%+$", "").try_cast("double") / 100).alias("value")).where("value is not null")


def tag_fractions(texts: DataFrame, tags: list[str], text: str = "text", prefix: str = "bfcl_think_tag_") -> DataFrame:
    """Share of each tag among all occurrences of ``tags`` in the transcripts, named after the tag without its marks; nothing without any."""
    counts = texts.agg(*[F.sum(F.coalesce(F.regexp_count(F.col(text), F.lit("\\Q" + t + "\\E")), F.lit(0))).alias(f"t{k}") for k, t in enumerate(tags)])
    long = counts.unpivot([], list(counts.columns), "at", "n")
    plain = [t.lstrip("<").rstrip(">").replace("/", "") for t in tags]
    name = F.element_at(F.array(*map(F.lit, plain)), F.expr("cast(substring(at, 2) as int) + 1"))
    total = sum((F.col(c) for c in counts.columns), F.lit(0))
    every = counts.select(total.alias("total"))
    return long.crossJoin(F.broadcast(every)).where("total > 0 and n > 0").select(F.concat(F.lit(prefix), name, F.lit("_frac")).alias("name"), (F.col("n") / F.col("total")).alias("value"))


def hub_uri(c) -> F.col:
    """Parts of hf://org/repo/[sub/]file[@rev] as a struct; NULL for another form."""
    p = r"^hf://([^/]+/[^/]+)/(?:(.*)/)?([^/@]+)(?:@(.+))?$"
    part = lambda k: F.regexp_extract(c, p, k)
    return F.when(c.rlike(p), F.struct(part(1).alias("repo"), part(3).alias("file"), F.nullif(part(2), F.lit("")).alias("sub"), F.coalesce(F.nullif(part(4), F.lit("")), F.lit("main")).alias("revision")))


def read_yaml(spark: SparkSession, paths: list[str], required: list[str]) -> DataFrame:
    """Small configuration files as rows of text values; a missing key is an error."""
    import json

    import yaml

    rows = []
    for p in paths:
        with open(p, encoding="utf-8") as f:
            got = yaml.safe_load(f)
        if missing := [k for k in required if k not in got]:
            raise ValueError(f"{p}: missing {missing}")
        rows.append((p, {k: v if isinstance(v, str) else json.dumps(v) for k, v in got.items()}))
    return spark.createDataFrame(rows, "path string, values map<string,string>")


def metric_sum(lines: DataFrame, names: list[str]) -> DataFrame:
    """Sum of a text exposition's samples whose metric name is one of ``names``."""
    p = regex(r"^([a-zA-Z_:][\w:]*)(?:\{.*\})?\s+(\S+)")
    got = lines.select(F.regexp_extract("value", p, 1).alias("name"), F.regexp_extract("value", p, 2).try_cast("double").alias("sample"))
    return got.where(F.col("name").isin(names)).agg(F.sum("sample").alias("total"))

"""Readers and writers of the engine's text tables, and reports."""

from __future__ import annotations

import hashlib
import json
import zipfile
from pathlib import Path, PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RECORD = StructType([StructField(c, StringType()) for c in ("entity_id", "business_name", "business_address", "country")])
MATCHING = ("source1_entity_id", "matched_entity_ids")
CANDIDATES = ("source1_entity_id", "candidate_entity_ids")


def _schema(columns) -> StructType:
    return columns if isinstance(columns, StructType) else StructType([StructField(c, StringType()) for c in columns])


def read_tsv(spark: SparkSession, path: str, columns=RECORD, multi_line: bool = False) -> DataFrame:
    """Strict TSV: the header must match, every row must have all fields; quotes are honoured, text such as NA stays.

    Null becomes empty. Single-line files are split over tasks; ``multi_line`` allows line breaks inside quotes.
    """
    schema = _schema(columns)
    df = (spark.read.schema(schema).option("sep", "\t").option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
          .option("escape", '"').option("multiLine", multi_line).option("nullValue", "\0").csv(path))
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in schema.names))


def read_records(spark: SparkSession, path: str, prefix: str | None = None, multi_line: bool = False) -> DataFrame:
    """Source records; an id that is empty, untrimmed, holds a comma, or lacks ``prefix`` fails the job."""
    df = read_tsv(spark, path, RECORD, multi_line)
    fine = (F.col("entity_id") != "") & (F.trim("entity_id") == F.col("entity_id")) & ~F.col("entity_id").contains(",")
    if prefix:
        fine = fine & F.col("entity_id").startswith(prefix)
    checked = F.when(fine, F.col("entity_id")).otherwise(F.raise_error(F.concat(F.lit("bad entity id: "), F.col("entity_id"))).cast("string"))
    return df.withColumn("entity_id", checked)


def with_row_index(df: DataFrame) -> DataFrame:
    """``row_idx``: file order, from partition and place in it; assign it once, at ingestion."""
    return df.withColumn("row_idx", F.monotonically_increasing_id())


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``number, value``: the lines of a text in file order, from 1. Only one count per input split travels."""
    split, at = F.spark_partition_id().alias("split"), (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("at")
    lines = spark.read.text(path).select("value", split, at)
    counts = lines.groupBy("split").agg(F.max("at").alias("n"))
    before = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("split", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return lines.join(F.broadcast(starts), "split").select((F.col("start") + F.col("at")).alias("number"), "value")


def read_tsv_lenient(spark: SparkSession, path: str, columns) -> tuple[DataFrame, DataFrame]:
    """(good rows, errors) instead of a failure; a byte order mark is ignored.

    errors: ``number`` of the line, ``reason`` and ``line``; a header that differs is one of them. Blank lines are skipped.
    """
    names = _schema(columns).names
    lines = numbered_lines(spark, path).withColumn("value", F.regexp_replace("value", "^\ufeff", ""))
    rows = lines.where("number > 1 and trim(value) <> ''")
    fields = StructType([*(StructField(f"f{i}", StringType()) for i in range(len(names))), StructField("broken", StringType())])
    options = {"sep": "\t", "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken", "nullValue": "\0"}
    parsed = rows.withColumn("x", F.from_csv("value", fields.simpleString(), options))
    good = F.col("x.broken").isNull()
    header = lines.where("number = 1").select("number", F.lit("header differs").alias("reason"), F.col("value").alias("line"), F.lower("value").alias("low"))
    bad = parsed.where(~good).select("number", F.format_string(f"expected {len(names)} fields, found %d", F.size(F.split("value", "\t"))).alias("reason"), F.col("value").alias("line"))
    errors = header.where(F.col("low") != "\t".join(names).lower()).drop("low").unionByName(bad)
    return parsed.where(good).select(*(F.coalesce(F.col(f"x.f{i}"), F.lit("")).alias(n) for i, n in enumerate(names))), errors


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of the first line, trimmed, lower case, without a byte order mark."""
    line = spark.read.text(path).first()
    return [c.strip().lower() for c in (line["value"].lstrip("﻿").split("\t") if line else [])]


def read_lines(spark: SparkSession, path: str, columns=MATCHING) -> DataFrame:
    """Quote-free reader: each line split on its first tab; blank lines and the header are skipped."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split("value", "\t", 2)
    key = F.regexp_replace(F.trim(parts[0]), "^﻿", "")
    out = lines.select(key.alias(columns[0]), F.coalesce(F.trim(F.try_element_at(parts, F.lit(2))), F.lit("")).alias(columns[1]))
    return out.where(F.lower(columns[0]) != columns[0].lower())


def first_column_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct first fields of a TSV without its header."""
    header = header_of(spark, path)
    first = F.split("value", "\t", 2)[0]
    ids = spark.read.text(path).where(F.trim("value") != "").select(F.trim(first).alias("entity_id"))
    return ids.where(F.lower("entity_id") != (header[0] if header else "")).distinct()


def find_records(df: DataFrame, ids: DataFrame, column: str = "entity_id") -> DataFrame:
    """Records of the given ids; stops reading once there is one for each."""
    n = ids.select(column).distinct().count()
    return df.join(ids.select(column).distinct(), column, "left_semi").limit(n)


def head(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy("row_idx").limit(n) if "row_idx" in df.columns else df.limit(n)


def write_tsv(df: DataFrame, path: str, quote: bool = False, mode: str = "errorifexists") -> None:
    """TSV with a header; existing output is refused, and the committer promotes all files at the end."""
    w = df.write.mode(mode).option("sep", "\t").option("header", True).option("emptyValue", "")
    w = w.option("escape", '"') if quote else w.option("quote", "")
    w.csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, required=()) -> DataFrame:
    """CSV as strings; missing required or repeated columns are an error."""
    df = spark.read.option("header", True).option("escape", '"').csv(path).withColumnsRenamed({})
    names = [c.lstrip("﻿") for c in df.columns]
    if missing := sorted(set(required) - set(names)):
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    if len(set(names)) != len(names):
        raise ValueError("columns repeat")
    return df.toDF(*names).fillna("")


def _file(path: str):
    """(file system, path) of a path in any store that Spark knows."""
    spark = SparkSession.active()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(str(path))
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def write_report(report: dict, path: str) -> None:
    """Indented JSON at ``path``, wherever Spark can write."""
    store, at = _file(path)
    out = store.create(at, True)
    out.write(bytearray(json.dumps(report, indent=2, default=str).encode()))
    out.close()


def read_report(path: str) -> dict | None:
    """A report as it was written, or null where there is none."""
    store, at = _file(path)
    if not store.exists(at):
        return None
    return json.loads("\n".join(r["value"] for r in SparkSession.active().read.text(str(path)).collect()))


def remove_report(path: str) -> None:
    store, at = _file(path)
    store.delete(at, False)


def report_frame(df: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-free content fingerprint: rows, and XOR and sum of two 60-bit parts of the rows' digests.

    A row's digest is that of its columns as texts, each with its length, nulls marked.
    """
    marked = lambda c: F.when(c.isNull(), F.lit("n;")).otherwise(F.concat(F.lit("v"), F.length(c).cast("string"), F.lit(":"), c))
    h = F.md5(F.concat(*(marked(F.col(f"`{c}`").cast("string")) for c in df.columns)))
    part = lambda at: F.conv(F.substring("h", at, 15), 16, 10).cast("long")
    return df.select(h.alias("h")).agg(
        F.count("*").alias("rows"), F.bit_xor(part(1)).alias("xor_hash"), F.sum(part(17).cast("decimal(38,0)")).cast("string").alias("sum_hash"))


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) of files below 2 GB each, read where they lie."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def sha256_of(path: str, chunk: int = 8 << 20) -> dict:
    """Fingerprint of one local file of any size."""
    h, n = hashlib.sha256(), 0
    with open(path, "rb") as f:
        while part := f.read(chunk):
            h.update(part)
            n += len(part)
    return {"path": str(path), "bytes": n, "sha256": h.hexdigest()}


def code_fingerprint() -> str:
    """SHA-256 of this package's modules, by name and content."""
    h = hashlib.sha256()
    root = Path(__file__).resolve().parents[1]
    for f in sorted(root.rglob("*.py")):
        h.update(f"{f.relative_to(root)}\0".encode() + f.read_bytes())
    return h.hexdigest()


def provenance(spark: SparkSession, **paths: str) -> dict:
    """Fingerprints of the code and of the files under each path, to be compared between the steps of a run."""
    out = {"code": code_fingerprint()}
    for name, path in paths.items():
        files = file_fingerprints(spark, path).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), "bytes", "sha256")
        row = files.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.md5(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "name", "sha256"))), ",")).alias("h")).first()
        out[name] = {"files": row["n"], "bytes": row["bytes"], "digest": row["h"]}
    return out


def require_same_provenance(one: dict, other: dict) -> None:
    """Raise with the names on which two provenances differ."""
    if differ := sorted(k for k in {*one, *other} if one.get(k) != other.get(k)):
        raise ValueError(f"provenance differs: {', '.join(differ)}")


def write_package(path: str, members: dict[str, str], required=()) -> dict:
    """ZIP of ``name -> file``; required members must be there, names must be safe and distinct. Returns member hashes."""
    if missing := sorted(set(required) - set(members)):
        raise ValueError(f"members are missing: {', '.join(missing)}")
    with zipfile.ZipFile(path, "x", zipfile.ZIP_DEFLATED) as z:
        for name, file in sorted(members.items()):
            z.write(file, name)
    return inspect_package(path, required)


def inspect_package(path: str, required=()) -> dict:
    """Hashes of the members of a ZIP that has no unsafe, repeated, missing or corrupt member."""
    with zipfile.ZipFile(path) as z:
        names = z.namelist()
        unsafe = [n for n in names if n.startswith(("/", "\\")) or ".." in PurePosixPath(n).parts or ":" in n]
        if unsafe or len(set(names)) != len(names) or set(required) - set(names):
            raise ValueError(f"bad members: unsafe {unsafe}, missing {sorted(set(required) - set(names))}, {len(names)} names")
        if (bad := z.testzip()) is not None:
            raise ValueError(f"corrupt member: {bad}")
        return {n: hashlib.sha256(z.read(n)).hexdigest() for n in names}

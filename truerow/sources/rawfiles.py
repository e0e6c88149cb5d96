"""Find raw JSONL files, describe them, fingerprint them and read their lines.

Listings, manifests and the ledger stay DataFrames; only the files to be applied next are
named on the driver, because a Spark scan needs their paths.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truerow.config.endpoints import UPSERT_ONLY, EndpointSchema
from truerow.functions.text import filled

_LOCAL = "^file:/+"
_DELTA = r"\.delta$"
_FILES = (
    "path STRING, file_path STRING, length LONG, modified TIMESTAMP, endpoint STRING, is_delta BOOLEAN, "
    "source_run_id STRING, run_mode STRING, manifest_path STRING, manifest_sha256 STRING"
)


@dataclass(frozen=True)
class RawFile:
    file_ord: int
    path: str  # as the file system names it, for opening the file
    file_path: str  # as scans report it in their metadata, the key of the ledger
    length: int
    modified: datetime
    endpoint: str
    is_delta: bool
    source_run_id: str
    run_mode: str | None
    manifest_path: str | None
    manifest_sha256: str | None
    content_sha256: str


#: Names the definition of a fingerprint, so that another one can never be taken for equal.
FINGERPRINT = "lines-1"


def _listing(spark: SparkSession, raw_dir: str, pattern: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return reader.option("recursiveFileLookup", "true").load(raw_dir)


def _folder(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def _name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def refuse_hidden(spark: SparkSession, raw_dir: str) -> None:
    """Fail on names that start with an underscore, which Spark's readers pass over in silence.

    Only names are listed, level by level, by the file system itself. Dot files are no evidence.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(raw_dir)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    level = raw_dir.rstrip("/")
    while True:
        hidden = system.globStatus(jvm.org.apache.hadoop.fs.Path(f"{level}/_*"))
        names = [status.getPath().toString() for status in hidden or []]
        names = [n for n in names if n.endswith(".jsonl") or system.getFileStatus(jvm.org.apache.hadoop.fs.Path(n)).isDirectory()]
        if names:
            raise ValueError(f"Spark does not read names that start with an underscore: {', '.join(names[:5])}")
        level += "/*"
        if not len(system.globStatus(jvm.org.apache.hadoop.fs.Path(level)) or []):
            return


def discover(spark: SparkSession, raw_dir: str) -> DataFrame:
    """All raw files with endpoint, delta flag and run, from names and manifests.

    Only the listing is read here; file contents are not. Dot files are left out; a name that
    starts with an underscore is an error.
    """
    refuse_hidden(spark, raw_dir)
    try:
        listed = _listing(spark, raw_dir, "*.jsonl").select(
            "path",
            F.col("_metadata.file_path").alias("file_path"),
            "length",
            F.col("modificationTime").alias("modified"),
        )
        manifests = _manifests(spark, raw_dir)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _FILES)
    stem = F.regexp_replace(_name(F.col("file_path")), r"\.jsonl$", "")
    files = listed.select(
        "*",
        F.regexp_replace(stem, _DELTA, "").alias("endpoint"),
        stem.rlike(_DELTA).alias("named_delta"),
        _folder(F.col("file_path")).alias("folder"),
    ).where(F.col("endpoint") != "")
    at_root = F.regexp_replace("folder", _LOCAL, "/") == re.sub(_LOCAL, "/", raw_dir.rstrip("/"))
    said = F.filter("entries", lambda e: e["file"] == _name(F.col("file_path")))
    said = F.filter(said, lambda e: e["is_delta"].isNotNull())
    return files.join(manifests, "folder", "left").select(
        "path",
        "file_path",
        "length",
        "modified",
        "endpoint",
        F.coalesce(
            F.get(said, 0)["is_delta"], F.col("run_mode") == "delta", F.col("named_delta")
        ).alias("is_delta"),
        F.coalesce("run_id", F.when(at_root, "root").otherwise(_name(F.col("folder")))).alias(
            "source_run_id"
        ),
        "run_mode",
        "manifest_path",
        "manifest_sha256",
    )


def _manifests(spark: SparkSession, raw_dir: str) -> DataFrame:
    """One row per folder with a manifest; text is kept only where the JSON holds text."""
    parsed = _listing(spark, raw_dir, "manifest.json").select(
        F.col("_metadata.file_path").alias("manifest_path"),
        F.sha2("content", 256).alias("manifest_sha256"),
        F.parse_json(F.decode("content", "UTF-8")).alias("manifest"),
    )

    def value(of: Column, key: str, kind: str) -> Column:
        found = F.try_variant_get(of, f"$.{key}", "variant")
        typed = F.try_variant_get(of, f"$.{key}", kind)
        return F.when(F.schema_of_variant(found) == kind.upper(), typed)

    entries = F.map_values(F.try_variant_get("manifest", "$.endpoints", "map<string,variant>"))
    entries = F.transform(
        entries,
        lambda e: F.struct(
            value(e, "file", "string").alias("file"),
            value(e, "is_delta", "boolean").alias("is_delta"),
        ),
    )
    manifest = F.col("manifest")
    return parsed.select(
        _folder(F.col("manifest_path")).alias("folder"),
        "manifest_path",
        "manifest_sha256",
        filled(value(manifest, "run_id", "string")).alias("run_id"),
        filled(value(manifest, "mode", "string")).alias("run_mode"),
        F.when(F.schema_of_variant(manifest).startswith("OBJECT"), entries).alias("entries"),
    ).where(F.schema_of_variant(manifest).startswith("OBJECT"))


def in_order(files: DataFrame) -> DataFrame:
    """Number files by run ('root' first), endpoint and path. One row per file, no records.

    Files are ranked inside their run; only one count per run is summed over all runs.
    """
    run = F.when(F.col("source_run_id") == "root", "").otherwise(F.col("source_run_id"))
    keyed = files.withColumn("run_", run)
    counts = keyed.groupBy("run_").agg(F.count("*").cast("int").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("run_", before.cast("int").alias("start_"))
    rank = F.row_number().over(Window.partitionBy("run_").orderBy("endpoint", "file_path"))
    ranked = keyed.withColumn("rank_", rank).join(starts, "run_")
    return ranked.withColumn("file_ord", F.col("start_") + F.col("rank_") - 1).drop("run_", "rank_", "start_")


def fingerprints(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Content hash per file of ``files`` (path, file_path, length).

    One definition for all sizes and settings: the number of bytes, and sums of the hashes of
    all lines with their numbers, digested. No task reads more than one input split, and the
    result does not depend on how a file was split. The byte count tells whether the last
    line ends with a newline.
    """
    paths = [row["path"] for row in files.select("path").collect()]
    if not paths:
        return spark.createDataFrame([], "file_path STRING, content_sha256 STRING")
    hashed = _numbered(spark, paths).select(
        "file_path",
        F.xxhash64("line_no", "value").alias("h1"),
        F.xxhash64(F.lit("second"), "value", "line_no").alias("h2"),
    )
    # Kept in decimals so that a sum of 64-bit hashes cannot overflow.
    totals = hashed.groupBy("file_path").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("h1").cast("decimal(38,0)")).alias("s1"),
        F.sum(F.col("h2").cast("decimal(38,0)")).alias("s2"),
        F.bit_xor("h1").alias("x1"),
    )
    digest = F.sha2(F.concat_ws(":", F.lit(FINGERPRINT), "length", "lines", "s1", "s2", "x1"), 256)
    # Empty files have no lines, and a fingerprint all the same.
    found = files.select("file_path", "length").join(totals, "file_path", "left")
    unread = F.col("lines").isNull() & (F.col("length") > 0)
    problem = F.raise_error(F.concat(F.lit("No lines were read of "), "file_path"))
    return found.select("file_path", F.when(unread, problem).otherwise(digest).alias("content_sha256"))


def _numbered(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with their number in the file, counted per split first (two scans, no sort)."""
    lines = spark.read.text(list(paths), lineSep="\n").select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    blocks = lines.groupBy("file_path", "block").agg(
        F.count("*").alias("n"), F.min("row_id").alias("first_id")
    )
    before = Window.partitionBy("file_path").orderBy("block")
    offsets = blocks.select(
        "file_path",
        "block",
        "first_id",
        (F.sum("n").over(before) - F.col("n")).alias("offset"),
    )
    line_no = F.col("offset") + F.col("row_id") - F.col("first_id")
    return lines.join(offsets, ["file_path", "block"]).select(
        "file_path", "value", line_no.alias("line_no")
    )


@dataclass(frozen=True)
class Pending:
    files: tuple[RawFile, ...]
    skipped: int


def pending(
    spark: SparkSession,
    files: DataFrame,
    ledger: DataFrame,
    verify_content: bool = False,
) -> Pending:
    """The files not applied yet, in order; already applied ones are skipped.

    A file whose size and modification time equal those in the ledger is taken as unchanged
    (``verify_content`` hashes it all the same). An applied file with other content is an
    error: raw evidence must not change.
    """
    known = ledger.groupBy("file_path").agg(
        F.max("content_sha256").alias("applied_sha256"),
        F.max("length").alias("applied_length"),
        F.max("modified").alias("applied_modified"),
    )
    checked = in_order(files).join(known, "file_path", "left")
    same = (F.col("applied_length") == F.col("length")) & (
        F.col("applied_modified") == F.col("modified")
    )
    unread = F.col("applied_sha256").isNull() | ~F.coalesce(same, F.lit(False))
    to_read = checked if verify_content else checked.where(unread)
    hashed = to_read.join(fingerprints(spark, to_read), "file_path").select(
        "*", (F.col("applied_sha256") == F.col("content_sha256")).alias("unchanged")
    )
    rows = hashed.where("unchanged IS NULL OR NOT unchanged").orderBy("file_ord").collect()
    changed = [r["file_path"] for r in rows if r["unchanged"] is False]
    if changed:
        raise ValueError(f"Raw files changed after they were applied: {', '.join(changed[:5])}")
    names = RawFile.__dataclass_fields__
    found = tuple(RawFile(**{name: row[name] for name in names}) for row in rows)
    return Pending(found, checked.count() - len(found))


def check_snapshot_modes(
    files: Sequence[RawFile], schemas: Mapping[str, EndpointSchema]
) -> None:
    """P5: a full file may only add and update; absence of a record never deletes it."""
    for file in files:
        mode = schemas.get(file.endpoint, EndpointSchema(file.endpoint)).full_snapshot_mode
        if not file.is_delta and mode != UPSERT_ONLY:
            raise ValueError(
                f"full_snapshot_mode={mode!r} of {file.endpoint} is not supported, "
                f"only {UPSERT_ONLY!r} is."
            )


def read_lines(spark: SparkSession, files: Sequence[RawFile]) -> DataFrame:
    """Non-empty lines with an exact order inside each file.

    Files are read in splits; (block start, row id) orders the lines of one file.
    """
    text = spark.read.text([file.path for file in files], lineSep="\n")
    return ordered_lines(text)


def ordered_lines(text: DataFrame) -> DataFrame:
    """The same for any text DataFrame that carries file metadata, such as a micro-batch."""
    return text.select(
        F.trim("value").alias("payload"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    ).where(F.col("payload") != "")

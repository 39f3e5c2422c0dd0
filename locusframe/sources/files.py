"""File inventories, task receipts and per-task observation folders."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import basename
from ..operators.digests import digest_tree

#: Bytes of a file that are one row, and bytes read at a time.
PART_BYTES, BLOCK_BYTES = 256 << 20, 4 << 20

RECEIPT = (
    "run_id string, started double, task_details array<struct<task_id:string, name:string, status:string, "
    "cpus:int, memory:bigint, started:double, completed:double>>"
)


def inventory(rows: DataFrame, path: Column, content: str) -> DataFrame:
    """Path, size, SHA-256 and MD5 of each row's content."""
    return rows.select(
        path.alias("path"),
        F.octet_length(content).cast("bigint").alias("bytes"),
        F.sha2(F.col(content).cast("binary"), 256).alias("sha256"),
        F.md5(F.col(content).cast("binary")).alias("md5"),
    )


def file_inventory(spark: SparkSession, root: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """Inventory of every file below a folder: path, bytes, sha256, md5, tree_sha256.

    Files of at most ``part_bytes`` are one row each, hashed whole. Longer ones are read as byte ranges, each
    in a row of its own, whose digests meet in a tree (``digest_tree``); they have a tree_sha256 only, as
    the other two cannot be made of parts. A file of one part has its SHA-256 there, so tree_sha256
    identifies files of any size, given ``part_bytes``. Spark's reader lists no empty files.
    """
    base = root.rstrip("/") + "/"
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.substring_index("path", base, -1)
    short = inventory(scan.filter(F.col("length") <= part_bytes), name, "content").withColumn("tree_sha256", F.col("sha256"))
    number = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("length") - 1) / part_bytes).cast("bigint")))
    long = scan.filter(F.col("length") > part_bytes).select("path", "length", number.alias("part"))
    # the ranges of one file spread over the cluster
    ranges = long.repartition("path", "part").mapInArrow(_hashed_range(part_bytes), "path string, part bigint, bytes bigint, sha256 string")
    trees = digest_tree(ranges, ["path"], "part", "sha256", "bytes")
    none = F.lit(None).cast("string")
    return short.unionByName(trees.select(name.alias("path"), "bytes", none.alias("sha256"), none.alias("md5"), F.col("sha256").alias("tree_sha256")))


def _hashed_range(part_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """SHA-256 of byte ranges, each read in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            paths, parts = batch.column("path").to_pylist(), batch.column("part").to_pylist()
            sizes, digests = [], []
            for path, part, length in zip(paths, parts, batch.column("length").to_pylist()):
                system, inner = fs.FileSystem.from_uri(path if "://" in path else path.replace(":/", ":///", 1))
                left, state = min(part_bytes, length - part * part_bytes), hashlib.sha256()
                sizes.append(left)
                with system.open_input_file(inner) as file:
                    file.seek(part * part_bytes)
                    while left:
                        block = file.read(min(left, BLOCK_BYTES))
                        if not block:
                            raise EOFError(f"{path} is shorter than it was")
                        state.update(block)
                        left -= len(block)
                digests.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("part"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], ["path", "part", "bytes", "sha256"])

    return run


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    """Provider receipts with their nested task details."""
    return spark.read.schema(RECEIPT).json(path, multiLine=True)


def flatten_receipts(receipts: DataFrame) -> DataFrame:
    """One row per provider task with run-relative offsets."""
    return receipts.select("run_id", "started", F.explode("task_details").alias("t")).select(
        "run_id",
        "t.task_id",
        "t.name",
        "t.status",
        "t.cpus",
        "t.memory",
        (F.col("t.started") - F.col("started")).alias("start_offset"),
        (F.col("t.completed") - F.col("started")).alias("end_offset"),
    )


def observation_folders(documents: DataFrame) -> DataFrame:
    """Members of per-task folders to one row per task.

    ``documents`` is ``(source, value)`` with one row per small member file.
    """
    folder = F.regexp_extract("source", r"^(.*)/[^/]+$", 1)
    members = {"metadata": "task.json", "started": "started.txt", "completed": "completed.txt", "command": "command.sh", "version": "version.txt"}
    member = basename(F.col("source"))
    picked = [F.max(F.when(member == name, F.col("value"))).alias(out) for out, name in members.items()]
    grouped = documents.groupBy(folder.alias("folder")).agg(*picked)
    meta = F.from_json("metadata", "process string, label string, nextflow_process_index int, attempt int, declared_image string, requested_cpus int, requested_memory_bytes bigint")
    return grouped.select(
        "folder",
        meta.alias("m"),
        F.trim("started").try_cast("bigint").alias("started"),
        F.trim("completed").try_cast("bigint").alias("completed"),
        F.sha2("command", 256).alias("command_sha256"),
        F.trim("version").alias("version"),
    ).select(
        "folder", "m.*", "started", "completed", "command_sha256", "version",
        F.when(F.col("started").isNull() | F.col("completed").isNull(), "incomplete")
        .when(F.col("completed") < F.col("started"), "timing")
        .when(F.coalesce(F.col("version"), F.lit("")) == "", "version")
        .alias("violation"),
    )

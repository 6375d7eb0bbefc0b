"""Token counts of documents in flat token files that have no index.

A token file is one run of ids with a separator after each document, read as
byte ranges of any task and cut into blocks anywhere. Each block is searched for separators on its own. Two prefix
scans over block summaries, a sum of tokens and a maximum of the place after
the last separator, then tell where each block starts and how many tokens of
its first document lie in earlier blocks. The scans run over groups of blocks
first, so a file of any length keeps its windows short.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.byte_bpe import encode, encoding
from touchline.llm.tables import query, table
from touchline.session import new_folder

BLOCK_TOKENS = 1 << 16
#: blocks that are read from a file at once, and bytes of files for each task
RANGE_BLOCKS = 64
TASK_BYTES = 128 << 20
GROUP = 4096
TOKEN = "<u2"


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that all tasks can reach: a shared mount, or what Arrow opens (hdfs, s3, gs)."""
    if re.match(r"(?!file:)[a-z0-9]+://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:(//)?(?=/)", "", path)


def write_token_files(
    docs: DataFrame,
    path: str,
    pattern: str,
    separator: int,
    key: str = "doc_id",
    text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> tuple[DataFrame, DataFrame]:
    """Encodes whole texts to flat files in the shared folder: the files' blocks, and which documents they hold in order.

    Each input partition is one file of any length. Its name is new for every
    attempt of a task, and only files of finished tasks are listed, so a task
    may run again. Null and empty texts are a separator alone.
    """
    if separator >= 1 << 16:
        raise ValueError("ids are stored in 16 bits")
    spark = docs.sparkSession
    folder, listed = new_folder(spark, "token-files"), new_folder(spark, "token-file-list")
    names = ["file", "path", "bytes", "nth", "docs"]

    def run(batches):
        enc = encoding(path, pattern)
        file, nth, name, out = TaskContext.get().partitionId(), 0, None, None

        def row(*values):
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names)

        try:
            for rows in batches:
                if out is None:
                    name = f"{folder}/{file:06d}-{uuid.uuid4().hex}.bin"
                    system, at = _place(name)
                    system.create_dir(at.rsplit("/", 1)[0])
                    out = system.open_output_stream(at)
                for t in rows.column("text").to_pylist():
                    out.write(np.array([*encode(t or "", enc), separator], TOKEN).tobytes())
                yield row(file, None, None, nth, rows.column("doc_id").to_pylist())
                nth += rows.num_rows
            if out is not None:
                size = out.tell()
                out.close()
                yield row(file, name, size, None, None)
        finally:
            if out is not None and not out.closed:
                out.close()

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    chosen = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    schema = "file long, path string, bytes long, nth long, docs array<long>"
    chosen.mapInArrow(run, schema).write.option("compression", "zstd").parquet(listed)
    stored = spark.read.schema(schema).parquet(listed)
    held = stored.where("path IS NULL").select("file", "nth", F.posexplode("docs").alias("at", "doc_id"))
    blocks = _blocks(stored.where("path IS NOT NULL").select("file", "path", "bytes"), block_tokens)
    return blocks, held.select("file", (F.col("nth") + F.col("at")).alias("nth"), "doc_id")


def _blocks(files: DataFrame, block_tokens: int) -> DataFrame:
    """``file, block, tokens`` of files given by ``file, path, bytes``: byte ranges are dealt to tasks, which read them alone."""
    step = 2 * block_tokens
    total = files.agg(F.sum("bytes").alias("n")).first()["n"] or 0
    tasks = max(math.ceil(total / TASK_BYTES), min(files.sparkSession.sparkContext.defaultParallelism, math.ceil(total / step)), 1)
    span = step * RANGE_BLOCKS
    even = files.withColumn("bytes", F.col("bytes") - F.col("bytes") % 2).where("bytes > 0")
    ranges = even.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(bytes - 1) div {span}"))).alias("range"))

    def run(batches):
        for rows in batches:
            for name, place, size, k in zip(*(rows.column(c).to_pylist() for c in ("file", "path", "bytes", "range")), strict=True):
                system, at = _place(place)
                with system.open_input_file(at) as source:
                    want = min(span, size - k * span)
                    raw = source.read_at(want, k * span)
                if len(raw) != want:
                    raise OSError(f"{place} holds fewer than the {size} bytes listed")
                parts = [raw[i : i + step] for i in range(0, len(raw), step)]
                m = len(parts)
                columns = [pa.array([name] * m, rows.column("file").type), pa.array([k * RANGE_BLOCKS + i for i in range(m)], pa.int64()), pa.array(parts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["file", "block", "tokens"])

    kind = files.schema["file"].dataType.simpleString()
    return ranges.repartition(tasks, "path", "range").mapInArrow(run, f"file {kind}, block long, tokens binary")


def blocks_of_files(spark, folder: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat files of little-endian 16-bit ids, of any length; only names and sizes are listed through Spark.

    ``file`` is the path. Empty files have no blocks, and half an id at the end of a file that was cut is left out.
    """
    files = spark.read.format("binaryFile").load(folder).select(F.col("path").alias("file"), "path", F.col("length").alias("bytes"))
    return _blocks(files, block_tokens)


def _searched(separator: int):
    """Of each block: tokens, separators, place after the last one, and the gaps that end in it."""

    def run(batches):
        for rows in batches:
            size, ends, last, gaps = [], [], [], []
            for raw in rows.column("tokens"):
                ids = np.frombuffer(raw.as_buffer(), TOKEN) if raw.is_valid else np.zeros(0, TOKEN)
                at = np.flatnonzero(ids == separator)
                size.append(len(ids))
                ends.append(len(at))
                last.append(int(at[-1]) + 1 if len(at) else None)
                gaps.append(np.diff(at, prepend=-1) - 1)
            numbers = [pa.array(x, pa.int64()) for x in (size, ends, last)]
            columns = [rows.column("file"), rows.column("block"), *numbers, pa.array(gaps, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["file", "block", "size", "ends", "last", "gaps"])

    return run


def count_tokens(blocks: DataFrame, separator: int, group: int = GROUP) -> DataFrame:
    """``file, nth, n_tokens`` of each document, separators not counted.

    What follows a file's last separator is a document too, if it has tokens.
    Two separators in a row enclose an empty document. A null block has no
    tokens. Only ``file``, ``block`` and ``tokens`` are read; blocks of a file
    are in the order of their numbers.
    """
    kind = blocks.schema["file"].dataType.simpleString()
    schema = f"file {kind}, block long, size long, ends long, last long, gaps array<long>"
    found = blocks.select("file", "block", "tokens").mapInArrow(_searched(separator), schema)
    found = found.withColumn("group", F.floor(F.col("block") / group))
    inside = Window.partitionBy("file", "group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    near = found.select(
        "*",
        F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("start"),
        F.coalesce(F.sum("ends").over(inside), F.lit(0)).alias("nth"),
    )
    near = near.withColumn("after", F.col("start") + F.col("last"))
    near = near.withColumn("open", F.max("after").over(inside))
    groups = near.groupBy("file", "group").agg(F.sum("size").alias("g_size"), F.sum("ends").alias("g_ends"), F.max("after").alias("g_after"))
    past = Window.partitionBy("file").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(past), F.lit(0)).alias(to) for c, to in (("g_size", "g_start"), ("g_ends", "g_nth"))]
    groups = groups.select("*", *sums)
    groups = groups.withColumn("g_open", F.coalesce(F.max(F.col("g_start") + F.col("g_after")).over(past), F.lit(0)))
    placed = near.join(groups.select("file", "group", "g_start", "g_nth", "g_open"), ["file", "group"])
    carried = F.col("g_start") + F.col("start") - F.coalesce(F.col("g_start") + F.col("open"), F.col("g_open"))
    docs = placed.select("file", (F.col("g_nth") + F.col("nth")).alias("base"), carried.alias("carried"), F.posexplode("gaps").alias("at", "gap"))
    length = F.col("gap") + F.when(F.col("at") == 0, F.col("carried")).otherwise(0)
    docs = docs.select("file", (F.col("base") + F.col("at")).alias("nth"), length.alias("n_tokens"))
    files = placed.groupBy("file").agg(
        F.max(F.col("g_start") + F.col("start") + F.col("size")).alias("total"),
        F.sum("ends").alias("nth"),
        F.coalesce(F.max(F.col("g_start") + F.col("after")), F.lit(0)).alias("closed"),
    )
    rest = files.where("total > closed").select("file", "nth", (F.col("total") - F.col("closed")).alias("n_tokens"))
    return docs.unionByName(rest)


@query("op2_token_counts")
def op2(spark, folder):
    """Documents as flat token files, and their counts from the files alone."""
    import public_tokenizers

    separator = 50256
    blocks, held = write_token_files(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, separator)
    counts = count_tokens(blocks, separator)
    return held.join(counts, ["file", "nth"], "full").select("doc_id", "n_tokens")

"""Helpers shared by the operators: words, checkpoints, numbering without a global window."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: white space of the word definition `[^\x20\x09-\x0D]+`
SPACE = " \t\n\x0b\x0c\r"
SPACE_RE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; one is made only where that is unset, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it from there."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the cluster's shared checkpoint folder and read it from there."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """The words of a text in order (null text: no words)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RE), lambda w: w != "")


def count_chars(text: Column, chars: str) -> Column:
    """How many code points of ``text`` are one of ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def numbered(df: DataFrame, by: list[str], order: list[Column], spread: Column, blocks: int, name: str) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each key of ``by``, without one task per key.

    Rows are dealt to ``blocks`` blocks by ``spread`` (any integer expression of the row);
    numbers run block by block, and by ``order`` inside one.  Only the block counts, one
    row per key and block, meet in a window.
    """
    dealt = df.withColumn("_block", F.pmod(spread, F.lit(blocks)).cast("int"))
    keys = [*by, "_block"]
    inside = Window.partitionBy(*keys).orderBy(*order)
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = dealt.withColumn("_row", F.row_number().over(inside))
    return ranked.join(starts, keys).withColumn(name, (F.col("_start") + F.col("_row") - 1).cast("long")).drop("_block", "_row", "_start")


def blocks_for(rows: int, per_block: int = 5000) -> int:
    return max(1, -(-rows // per_block))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_words(text: str) -> list[str]:
    """The words of a Python string, with empty strings between adjacent blanks."""
    for c in SPACE[1:]:
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a session, as ``spark-submit --py-files`` would."""
    context = spark.sparkContext
    if any(f.endswith("cyclonespark.zip") for f in context.listFiles):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="cyclonespark-")) / "cyclonespark.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"cyclonespark/{f.relative_to(root)}")
    context.addPyFile(str(archive))


def release() -> None:
    """Give memory that is free, but still held by the allocators, back to the system: a Python worker idles
    beside the next stage's JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # not glibc


def lean(task):
    """A generator over batches that releases memory at its end."""

    def run(batches):
        yield from task(batches)
        release()

    return run


def lean_group(task):
    """A function of one group that releases memory afterwards."""

    def run(frame):
        out = task(frame)
        release()
        return out

    return run


def lean_groups(task):
    """A function of two cogroups that releases memory afterwards."""

    def run(left, right):
        out = task(left, right)
        release()
        return out

    return run

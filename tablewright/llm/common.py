"""What several operators share: stored steps, batch sizes, word and shingle hashes."""

from __future__ import annotations

import zipfile
from pathlib import Path

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.workspace import scratch_path

# Rows of whole texts that travel to Python at a time; the default of 10,000 would hold gigabytes of long texts.
TEXT_ROWS = 500

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                dtype=np.uint64)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends here, and lost executors lose nothing."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    # What was shuffled for a stored step is not needed any more; otherwise all steps' files pile up on the disks.
    before = spark.conf.get(_CLEAN_UP)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Ready this session for Python steps on whole texts: small Arrow batches, and this package on every executor."""
    _ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > TEXT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_ROWS)


def _ship(spark: SparkSession) -> None:
    """Hand the package to the executors, once per application, through Spark's own distribution of files."""
    name, root = "tablewright_package.zip", Path(__file__).resolve().parents[1]
    if name in spark.sparkContext._python_includes:
        return
    path = f"{spark.sparkContext._temp_dir}/{name}"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A name that no column has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive words; of the whole sequence if there are fewer."""
    size = min(size, len(words))
    if size == 0:
        return words
    count = len(words) - size + 1
    total = np.full(count, np.uint64(size), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(size):
            total = mix(total * _ODD[i % len(_ODD)] + words[i:i + count])
    return total

"""Tables dealt into buckets by a hash of their key, so that a merge rewrites only the buckets that its batch meets.

The bucket is a partition column that follows from the key.  It is part of the match, so the target is pruned to the
batch's buckets, and no row can move to another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import tables
from tablewright.naming import TableRef, as_list, quote, resolve_columns
from tablewright.operators.merge import merge_into
from tablewright.tables import Storage

BUCKET = "key_bucket"
BUCKETS_PROPERTY, KEY_PROPERTY = "tablewright.key_buckets", "tablewright.bucket_key."


def bucket_of(schema: T.StructType, keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a row; keys are hashed in the types of ``schema``, so that a batch's int meets a bigint."""
    return F.pmod(F.xxhash64(*[F.col(quote(k)).cast(schema[k].dataType) for k in keys]), F.lit(buckets)).cast("int").alias(BUCKET)


def create_bucketed(df: DataFrame, ref: TableRef | str, key: Sequence[str] | str, buckets: int, storage: Storage = Storage()) -> DataFrame:
    """Store rows by the bucket of their key, in the partition column ``key_bucket``.

    Choose ``buckets`` so that one is worth rewriting for a row: some hundred MB.
    """
    keys = resolve_columns(as_list(key), df.columns, "key")
    if not keys or buckets < 1:
        raise ValueError("a bucketed table needs a key and at least one bucket")
    if BUCKET in [c.lower() for c in df.columns]:
        raise ValueError(f"the rows have a column {BUCKET!r} already")
    if as_list(storage.partition_by):
        raise ValueError("a bucketed table is partitioned by its buckets alone")
    known = {BUCKETS_PROPERTY: str(buckets), **{f"{KEY_PROPERTY}{i}": k for i, k in enumerate(keys)}}
    return tables.write_table(df.select("*", bucket_of(df.schema, keys, buckets)), ref, replace(
        storage, partition_by=[BUCKET], properties={**storage.properties, **known}))


def bucket_key(spark: SparkSession, ref: TableRef | str) -> tuple[list[str], int]:
    """The key and the number of buckets of a stored table."""
    known = tables.properties(spark, TableRef.parse(ref))
    if BUCKETS_PROPERTY not in known:
        raise ValueError(f"{TableRef.parse(ref).sql} is not bucketed by a key")
    parts = sorted((int(k.removeprefix(KEY_PROPERTY)), v) for k, v in known.items() if k.startswith(KEY_PROPERTY))
    return [v for _, v in parts], int(known[BUCKETS_PROPERTY])


def merge_bucketed(ref: TableRef | str, batch: DataFrame, **options: object) -> DataFrame:
    """Upsert a batch by the table's key; ``options`` are those of ``merge``.  A NULL key matches nothing, as there."""
    ref = TableRef.parse(ref)
    spark = batch.sparkSession
    keys, buckets = bucket_key(spark, ref)
    resolve_columns(keys, batch.columns, "key")
    placed = batch.withColumn(BUCKET, bucket_of(spark.table(ref.sql).schema, keys, buckets))
    return merge_into(ref, placed, [*keys, BUCKET], **options)

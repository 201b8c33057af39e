"""A maintained aggregate that follows change feeds as streams."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tablewright import tables
from tablewright.naming import TableRef
from tablewright.operators.views import AggregateView, floating_sums, refresh_incremental

_POSITION = re.compile(r"_s([0-9a-f]{12})n(\d+)")


def applied_batches(spark: SparkSession, ref: TableRef) -> dict[str, int]:
    """The last batch of each stream that is in the stored state.

    They are part of the version's directory name, so state and positions change in one catalog
    update; other rewrites of the table carry the name on.
    """
    return {stream: int(batch) for stream, batch in _POSITION.findall(tables.version_tag(spark, ref))}


def _stream(query_id: str) -> str:
    return query_id.replace("-", "")[:12]


def _known_stream(spark: SparkSession, checkpoint: str) -> str | None:
    """The stream that a checkpoint belongs to; None for a new one."""
    try:
        lines = spark.read.text(f"{checkpoint}/metadata").collect()
    except AnalysisException:
        return None
    return _stream(json.loads(lines[0][0])["id"]) if lines else None


def stream_refresh(
    spark: SparkSession,
    feed_path: str,
    feed_schema: T.StructType,
    ref: TableRef | str,
    view: AggregateView,
    checkpoint: str,
    files_per_batch: int | None = None,
    new_stream: bool = False,
    base: Callable[[], DataFrame] | None = None,
):
    """Apply every change file that arrived since the last call, then stop.

    A batch that is delivered again after a lost driver is recognised by its stream and number and
    skipped, so no change is counted twice.  Streams are told apart by their checkpoints.  Where the
    state follows streams already, a checkpoint it does not know is refused: it is either that of a
    further feed, which ``new_stream=True`` says, or takes the place of a lost one, whose changes
    would count twice.

    Extremes need lists (``kept`` of the view).  ``base`` gives the rows as they are after all changes that have
    arrived, for a group whose list has run empty; without it such a batch fails and can be delivered again.
    """
    ref = TableRef.parse(ref)
    if view.extremes and not view.kept:
        raise ValueError("min and max need the base rows or lists of kept values; refresh them in batch, or set kept")
    tables.require_table(spark, ref)
    if floating_sums(tables.fresh(spark, ref), view):
        raise ValueError("floating sums need the base rows; refresh them in batch, or sum decimals")
    applied = applied_batches(spark, ref)
    if applied and not new_stream and _known_stream(spark, checkpoint) not in applied:
        raise ValueError(f"{ref.sql} does not know the stream of {checkpoint}; new_stream=True adds a further feed")
    reader = spark.readStream.schema(feed_schema).format("parquet")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    started: Future[str] = Future()

    def apply(changes: DataFrame, batch_id: int) -> None:
        stream, done = started.result(), applied_batches(changes.sparkSession, ref)
        if batch_id > done.get(stream, -1):
            done[stream] = batch_id
            refresh_incremental(ref, changes, view, base=base() if base and view.kept else None, tag="".join(f"_s{s}n{n}" for s, n in sorted(done.items())))

    query = (
        reader.load(feed_path).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    started.set_result(_stream(query.id))
    query.awaitTermination()
    return tables.fresh(spark, ref)

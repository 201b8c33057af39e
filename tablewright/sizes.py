"""The one place where a side of a join is judged small enough to broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Of the rows in memory.  Files are looked at first, since only small ones are worth measuring.
BROADCAST_LIMIT = 16 * 1024 * 1024

# Plans of these nodes hold no more rows than their files do.
_NOT_GROWING = {
    "Aggregate", "Distinct", "Filter", "GlobalLimit", "LocalLimit", "LocalRelation", "LogicalRelation", "OneRowRelation",
    "Project", "Range", "RebalancePartitions", "Repartition", "RepartitionByExpression", "Sort", "SubqueryAlias",
    "Union", "Window",
}

_BY_LENGTH = (T.StringType, T.CharType, T.VarcharType, T.BinaryType)
_WIDE = (T.DecimalType, T.CalendarIntervalType)
_ONE_WORD = (
    T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType,
    T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType, T.NullType,
)


def _only_shrinks(plan) -> bool:
    children = plan.children()
    return plan.nodeName() in _NOT_GROWING and all(_only_shrinks(children.apply(i)) for i in range(children.size()))


def proven_bytes(df: DataFrame) -> int | None:
    """Catalyst's size of a plan, which for stored rows comes from their files.

    None where that is a guess: behind a join or an explode, or without a JVM to ask.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    return int(str(plan.stats().sizeInBytes())) if _only_shrinks(plan) else None


def memory_bytes(df: DataFrame) -> int | None:
    """Bytes of the rows as Spark holds them, measured by a job: compressed files tell little about them.

    None where a column is of another kind than below (nested ones are), so that its size is not known so simply.
    """
    # Words for which columns are NULL and one for each column; text, binary and wide values are held behind them.
    row = F.lit(8 * (1 + len(df.columns) // 64 + len(df.columns))).cast("long")
    for i, f in enumerate(df.schema):
        if isinstance(f.dataType, _BY_LENGTH):
            row = row + F.coalesce(F.octet_length(F.col(f"c{i}")), F.lit(0)) + 7
        elif isinstance(f.dataType, _WIDE):
            row = row + 16
        elif not isinstance(f.dataType, _ONE_WORD):
            return None
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).agg(F.sum(row)).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether to ask for a broadcast: small files, and rows measured to be small in memory.

    Otherwise Spark's own threshold and adaptive execution decide.
    """
    size = proven_bytes(df)
    if size is None or size > limit:
        return False
    size = memory_bytes(df)
    return size is not None and size <= limit

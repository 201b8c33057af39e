"""Conditions that end the job where they do not hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(test: Column, message: str) -> Column:
    """A filter condition: true where ``test`` is, otherwise the job fails with the message.

    Naming the running task (``never`` is always false) keeps Catalyst from moving the condition:
    below a join or an aggregate it would judge rows that never get as far as this filter.
    """
    never = F.spark_partition_id() < 0
    return F.when(test | never, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean"))

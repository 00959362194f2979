"""Arrow batches of bounded size, whatever the size of a table."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch may hold, so that very long texts do not fill a Python worker."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))):
        if spark.conf.get(key, None) in (None, "10000", "-1", "67108864", "256MB", str(256 << 20), str((1 << 63) - 1)):
            try:
                spark.conf.set(key, value)
            except Exception as error:  # a Spark without the byte limit
                if "CANNOT_MODIFY" not in str(error) and "doesn't exist" not in str(error):
                    raise


def arrow_udf(kind) -> Callable[[Callable], Callable[..., Column]]:
    """F.arrow_udf of a function whose batches small_batches bounds, for the session in which it is put to use."""

    def wrap(f: Callable) -> Callable[..., Column]:
        made = F.arrow_udf(kind)(f)

        @functools.wraps(f)
        def use(*columns: Column) -> Column:
            spark = SparkSession.getActiveSession()
            if spark is not None:
                small_batches(spark)
            return made(*columns)

        return use

    return wrap

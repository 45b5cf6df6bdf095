"""The progress percentage shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_done(processed: Column, total: Column) -> Column:
    """Null if the total is unknown, 100 if it is 0; may exceed 100 for estimated totals."""
    share = F.round(processed.cast("double") / F.nullif(total, F.lit(0).cast("long")) * 100, 2)
    return F.when(total.isNull(), F.lit(None).cast("double")) \
        .when(total == 0, F.lit(100.0)).otherwise(share)

"""Exponential moving averages over series of any length, on built-in functions.

EMA_t = sum of x_i * f**(t-i) over i <= t, divided by the sum of the weights, f = 1 - 2 / (period + 1). Weights
relative to one row of the series under- or overflow, so rows are taken in blocks of 256: weights within a block
stay representable, and what the blocks before add is carried over from their last rows, as many as count (below 1e-17
of a weight they don't). All of it is windows of the series: no join, one exchange and one read, which the other
windows of the series share. The carry's frame is the same for all rows of a block, so Spark works it out once a block.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import SERIES, series

BLOCK = 256


def factor(period: int) -> float:
    return 1 - 2 / (period + 1)


def _carry(step: float):
    return lambda state, block: state * step + block


def with_ema(df: DataFrame, wanted: dict[str, tuple[str, int]]) -> DataFrame:
    """df with a column for each entry of wanted: name -> (column, period). The column must have no nulls."""
    rn = F.row_number().over(series())
    rows = df.withColumn("__rn", rn).withColumn("__b", F.floor((F.col("__rn") - 1) / BLOCK)).withColumn("__r", (F.col("__rn") - 1) % BLOCK)
    in_block = Window.partitionBy(*SERIES, "__b").orderBy("open_time").rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"__n_{k}": F.pow(F.lit(factor(p)), F.col("__r")) * F.sum(F.col(x) * F.pow(F.lit(factor(p)), -F.col("__r"))).over(in_block) for k, (x, p) in wanted.items()}
    rows = rows.withColumns(sums)
    by_block, carried = Window.partitionBy(*SERIES).orderBy("__b"), {}
    for k, (_, p) in wanted.items():
        far = max(1, math.ceil(math.log(1e-17) / (BLOCK * math.log(factor(p)))))
        ends = F.when(F.col("__r") == BLOCK - 1, F.col(f"__n_{k}"))  # collect_list leaves the other rows' nulls out
        carried[f"__c_{k}"] = F.aggregate(F.collect_list(ends).over(by_block.rangeBetween(-far, -1)), F.lit(0.0), _carry(factor(p) ** BLOCK))
    out = rows.withColumns(carried)
    for k, (_, p) in wanted.items():
        f = F.lit(factor(p))
        out = out.withColumn(k, (F.col(f"__n_{k}") + F.pow(f, F.col("__r") + 1) * F.col(f"__c_{k}")) / ((1 - F.pow(f, F.col("__rn"))) / (1 - f)))
    return out.select(*df.columns, *wanted)

"""Exact medians and percentiles without a group's values in one place.

A double's bits, as a whole number with its sign, are in the order of doubles. Each round cuts the part of a group's range
in which a wanted rank lies into up to 2^BITS parts by the leading bits of that range, counts them by an ordinary aggregate
with partial sums, and goes on with the part that holds the rank; values elsewhere drop out. After ROUNDS rounds a part
holds one value. The state of a group is its counts, 2^BITS at most whatever the number of values; each
round's states are a table in the shared folder, as are the values, so that nothing is computed twice or lost with an
executor. No result depends on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lumiflux.sources.files import stored

BITS, ROUNDS = 16, 4  # 64 bits in all


def with_bits(data: DataFrame, value: str, bits: str) -> DataFrame:
    """data with the bits of a double column as a whole number that, read without a sign, is in the order of doubles; both
    zeros have the same. Built-in functions have no view of a double's bits: numpy has, a batch at a time."""
    kept = data.columns

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = (batch.column(value).to_numpy(zero_copy_only=False) + 0.0).view(np.int64)
            signed = np.where(raw < 0, ~raw ^ np.int64(-(1 << 63)), raw)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(signed ^ np.int64(-(1 << 63)))], names=[*kept, bits])

    return data.mapInArrow(put, StructType([*data.schema.fields, StructField(bits, LongType())]))


def _leading(bits: str, by: str) -> Column:
    """bits without the last `by` of them, 63 at most."""
    return F.expr(f"shiftrightunsigned({bits}, cast({by} AS INT))")


def quantiles(rows: DataFrame, value: str, probabilities: Sequence[float], keys: Sequence[str] = (), few: bool = True) -> DataFrame:
    """keys and quantiles, an array in the order of probabilities, linear between neighbours as usual. Nulls and NaN are
    skipped; a group without other values has no row. few: groups are no more than the pixels of some images, so that
    their states, two rows a probability, are broadcast; otherwise Spark joins as it sees fit."""
    k = [*keys]
    data = with_bits(rows.select(*k, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL AND NOT isnan(__v)"), "__v", "__bits")
    # Read some times: written once, with nothing but keys, values and bits.
    data = stored(data, "selection-values")
    signed = F.col("__bits").bitwiseXOR(F.lit(-(1 << 63)))
    ends = data.groupBy(*k).agg(F.count("*").alias("__n"), F.min(signed).alias("__lo"), F.max(signed).alias("__hi")).where("__n > 0")
    at = [F.lit(float(p)) * (F.col("__n") - 1) for p in probabilities]
    ranks = F.array_distinct(F.array(*(f(p).cast("long") for p in at for f in (F.floor, F.ceil))))
    # The bits after those that all values of a group have in common.
    state = ends.select(*k, "__n", F.length(F.bin(F.col("__hi").bitwiseXOR(F.col("__lo")))).alias("__w"), F.lit(0).cast("long").alias("__part"), F.lit(0).cast("long").alias("__below"), ranks.alias("__ranks"))
    for r in range(ROUNDS):
        state = stored(state, "selection-state")
        small = F.broadcast(state) if few else state
        met = data.join(small, k) if k else data.crossJoin(small)
        if r:
            met = met.where(_leading("__bits", "__w") == F.col("__part"))
        met = met.withColumn("__s", F.greatest(F.col("__w") - BITS, F.lit(0))).withColumn("__bin", _leading("__bits", "__s"))
        counts = met.groupBy(*k, "__part", "__s", "__bin").agg(F.count("*").alias("__c"), F.min("__v").alias("__v"))
        counts = counts.join(small.drop("__w"), [*k, "__part"])
        before = F.coalesce(F.sum("__c").over(W.partitionBy(*k, "__part").orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        cut = counts.withColumn("__start", F.col("__below") + before)
        mine = F.filter("__ranks", lambda x: (x >= F.col("__start")) & (x < F.col("__start") + F.col("__c")))
        state = cut.select(*k, "__n", F.col("__s").alias("__w"), F.col("__bin").alias("__part"), F.col("__start").alias("__below"), mine.alias("__ranks"), F.col("__v").alias("__found")).where(F.size("__ranks") > 0)
        state = state if r == ROUNDS - 1 else state.drop("__found")
    found = state.select(*k, "__n", F.explode("__ranks").alias("__rank"), "__found").groupBy(*k).agg(F.first("__n").alias("__n"), F.map_from_entries(F.collect_list(F.struct("__rank", "__found"))).alias("__m")).where("__n IS NOT NULL")

    def between(p: Column) -> Column:
        a, b = (F.element_at("__m", f(p).cast("long")) for f in (F.floor, F.ceil))
        return F.when(a == b, a).otherwise(a + (b - a) * (p - F.floor(p)))

    return found.select(*k, F.array(*(between(p) for p in at)).alias("quantiles"))


def medians(rows: DataFrame, value: str = "v", keys: Sequence[str] = ("y", "x"), few: bool = True) -> DataFrame:
    """keys and value: the median of each group, NaN where any value is."""
    spoilt = rows.groupBy(*keys).agg(F.max(F.isnan(value)).alias("__nan"))
    found = quantiles(rows, value, (0.5,), keys, few).select(*keys, F.col("quantiles")[0].alias("__m"))
    both = spoilt.join(F.broadcast(found) if few else found, list(keys), "left")
    return both.select(*keys, F.when(F.col("__nan"), F.lit(float("nan"))).otherwise(F.col("__m")).alias(value))

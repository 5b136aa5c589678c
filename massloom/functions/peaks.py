"""Column expressions on the peak arrays of one spectrum.

All of them work inside the row: no explode, no shuffle. ``sort_array`` and
``array_min``/``array_max`` run in generated code; lambdas are kept for the
places where no such function exists, and counting into bins, which would take
several of them for each peak, is done on Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The log-intensity histogram.
HISTOGRAM_BINS = 100
HISTOGRAM_LOW = 1.0
HISTOGRAM_HIGH = 9.0
BIN_WIDTH = (HISTOGRAM_HIGH - HISTOGRAM_LOW) / HISTOGRAM_BINS

# The quantile profile: percentages dense at both ends, spaced by the normal
# distribution over plus and minus three standard deviations.
PERCENTAGES = [50.0 * (1.0 + math.erf(6.0 * i / 100.0 / math.sqrt(2.0))) for i in range(-50, 51)]


def percentages() -> Column:
    return F.expr("array(" + ", ".join(f"{p!r}D" for p in PERCENTAGES) + ")")


def log_of(value: Column) -> Column:
    return F.log10(F.lit(1.0) + value)


def usable(intensity: Column) -> Column:
    """The intensities, or no peaks at all where one has no logarithm."""
    empty = F.array().cast("array<double>")
    return F.when(intensity.isNull() | (F.array_min(intensity) <= -1.0), empty).otherwise(intensity)


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(values) > 0, total / F.size(values))


def sorted_median(ordered: Column, of=lambda x: x) -> Column:
    """Median of an ascending array; ``of`` maps the one or two middle values."""
    n = F.size(ordered)
    low = F.get(ordered, F.floor((n - 1) / 2).cast("int"))
    high = F.get(ordered, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (of(low) + of(high)) / 2.0)


def gaps(ordered: Column) -> Column:
    """Differences between neighbours of an ascending array."""
    n = F.greatest(F.size(ordered) - 1, F.lit(0))
    return F.zip_with(F.slice(ordered, F.lit(2), n), F.slice(ordered, F.lit(1), n), lambda hi, lo: hi - lo)


def slot_counts(scans: pa.ListArray) -> pa.ListArray:
    """For each list of intensities 102 counts: under, bin 0 .. bin 99, over; NaN counts as over, a null not at all.

    All lists are one flat array to numpy, so that a batch takes one logarithm,
    one division and one ``bincount`` whatever the number of its scans.
    """
    slots = HISTOGRAM_BINS + 2
    flat = scans.flatten()
    sizes = pc.fill_null(pc.list_value_length(scans), 0).to_numpy(zero_copy_only=False)
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    with np.errstate(divide="ignore", invalid="ignore"):
        logs = np.log10(1.0 + flat.to_numpy(zero_copy_only=False))[known]
    inside = np.floor((np.clip(logs, HISTOGRAM_LOW, HISTOGRAM_HIGH) - HISTOGRAM_LOW) / BIN_WIDTH)
    inside = np.minimum(inside, HISTOGRAM_BINS - 1) + 1
    slot = np.where(logs < HISTOGRAM_LOW, 0, np.where(logs < HISTOGRAM_HIGH, inside, slots - 1)).astype(np.int64)
    scan = np.repeat(np.arange(len(scans)), sizes)[known]
    counts = np.bincount(scan * slots + slot, minlength=slots * len(scans)).astype(np.int32)
    return pa.ListArray.from_arrays(np.arange(0, len(counts) + 1, slots, dtype=np.int32), pa.array(counts))


def histogram_slots(intensity: Column) -> Column:
    """Array of 102 counts: under, bin 0 .. bin 99, over. Only the intensities go through Python."""

    @F.arrow_udf("array<int>")
    def counts(scans: pa.Array) -> pa.Array:
        return slot_counts(scans)

    return counts(usable(intensity))


def quantile_profile(ordered: Column) -> Column:
    """The 101 log-intensity quantiles of ascending raw intensities.

    The logarithm keeps order, so raw values are sorted once and only the
    values at the wanted positions are turned into logarithms.
    """
    n = F.size(ordered)
    step = (n - 1) / F.lit(100.0)

    def at(percent: Column) -> Column:
        position = step * percent
        index = F.floor(position).cast("int")
        share = position - index
        low = log_of(F.get(ordered, index))
        high = log_of(F.get(ordered, index + 1))
        return F.when(index + 1 < n, (F.lit(1.0) - share) * low + share * high).otherwise(
            log_of(F.get(ordered, n - 1))
        )

    return F.when(n > 0, F.transform(percentages(), at))

"""Bands of a MinHash signature."""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 2_000


@functools.lru_cache(maxsize=None)
def best_bands(threshold: float, num_perm: int) -> tuple[int, int]:
    """(bands, rows) with the least false-positive plus false-negative area at a threshold.

    A pair of similarity s shares a band with probability 1 - (1 - s^rows)^bands. Below the
    threshold that is a false positive, above it the rest is a false negative; both weigh the same.
    """
    middle = (np.arange(STEPS) + 0.5) / STEPS
    low, high = middle * threshold, threshold + middle * (1.0 - threshold)
    best = None
    for rows in range(1, num_perm + 1):
        missing_low, missing_high = np.log1p(-(low**rows)), np.log1p(-(high**rows))
        for bands in range(1, num_perm // rows + 1):
            wrong = np.mean(1.0 - np.exp(bands * missing_low)) * threshold
            missed = np.mean(np.exp(bands * missing_high)) * (1.0 - threshold)
            error = 0.5 * wrong + 0.5 * missed
            if best is None or error < best[0]:
                best = (error, bands, rows)
    return best[1], best[2]


def band_keys(signature: Column, bands: int, rows: int) -> Column:
    """One 64-bit bucket key per band; trailing numbers that fill no band are unused."""
    starts = F.sequence(F.lit(1), F.lit((bands - 1) * rows + 1), F.lit(rows))
    return F.transform(starts, lambda at: F.xxhash64(F.slice(signature, at, rows)))


def band_texts(signature: Column, bands: int, rows: int) -> Column:
    """The same buckets spelled out, for listings."""
    starts = F.sequence(F.lit(1), F.lit((bands - 1) * rows + 1), F.lit(rows))
    return F.transform(starts, lambda at: F.array_join(F.slice(signature, at, rows).cast("array<string>"), "-"))

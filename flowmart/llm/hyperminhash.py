"""HyperMinHash sketches: a leading-zero count and mantissa bits per bucket.

A sketch has 128 buckets. A bucket keeps, of the smallest 57-bit value that falls into
it, the number of leading zeros (6 bits) and the 10 bits after the first one: 16 bits in
place of 64. A bucket without a value takes the register of the first bucket with one on
its own fixed permutation of the buckets, so any two registers of one index agree with
the probability of the sets' similarity. Four registers form a band of 64 bits.
"""

from __future__ import annotations

import numpy as np

BUCKETS = 128
BUCKET_BITS = 7
MANTISSA_BITS = 10
VALUE_BITS = 64 - BUCKET_BITS
BAND_REGISTERS = 4
BANDS = BUCKETS // BAND_REGISTERS

_STARTS = np.arange(BUCKETS, dtype=np.uint64) << np.uint64(VALUE_BITS)
_PROBES = np.stack([np.random.default_rng(1000 + i).permutation(BUCKETS) for i in range(BUCKETS)])


def registers(ordered: np.ndarray) -> np.ndarray:
    """128 registers of sorted distinct 64-bit values; there must be one at least."""
    at = np.searchsorted(ordered, _STARTS)
    ends = np.append(at[1:], len(ordered))
    filled = at < ends
    values = ordered[np.minimum(at, len(ordered) - 1)] & np.uint64((1 << VALUE_BITS) - 1)
    # The exponent of a double is the position of the first one; values keep 53 bits there.
    _, width = np.frexp((values >> np.uint64(5)).astype(np.float64))
    zeros = np.minimum(VALUE_BITS - 5 - width, 63).astype(np.uint64)
    shifted = values << (zeros + np.uint64(1 + BUCKET_BITS))
    out = (zeros << np.uint64(MANTISSA_BITS)) | (shifted >> np.uint64(64 - MANTISSA_BITS))
    out = out.astype(np.uint16)
    if not filled.all():
        donors = _PROBES[np.arange(BUCKETS), filled[_PROBES].argmax(axis=1)]
        out = np.where(filled, out, out[donors])
    return out


def bands(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per four registers."""
    return np.ascontiguousarray(sketches).view(np.uint64)


#: Chance that the registers of two different smallest values agree: the zero counts
#: agree with probability 1/3, the mantissas then with 2^-10.
COLLISION = 2.0**-MANTISSA_BITS / 3


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Jaccard similarity of rows of registers, corrected for chance agreement."""
    agreed = (left == right).mean(axis=-1)
    return np.clip((agreed - COLLISION) / (1 - COLLISION), 0.0, 1.0)

"""Image hashes over arrays of grey values, and distances between them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions import fixed

_LOW_BITS = 0x1111111111111111


def bits_to_hex(bits: Column) -> Column:
    """A string of 64 binary digits as 16 hexadecimal characters."""
    return F.lower(F.lpad(F.conv(bits, 2, 16), 16, "0"))


def hex_to_long(text: Column) -> Column:
    """16 hexadecimal characters as a signed BIGINT with the same bits."""
    return F.conv(text, 16, -10).cast("long")


def nibble_distance(a: Column, b: Column) -> Column:
    """Number of differing hexadecimal characters of two BIGINT hashes."""
    x = a.bitwiseXOR(b)
    any_bit = (
        x.bitwiseOR(F.shiftrightunsigned(x, 1))
        .bitwiseOR(F.shiftrightunsigned(x, 2))
        .bitwiseOR(F.shiftrightunsigned(x, 3))
    )
    return F.bit_count(any_bit.bitwiseAND(F.lit(_LOW_BITS)))


def hex_distance(a: Column, b: Column) -> Column:
    """Number of differing characters of two 16-character hash texts."""
    return nibble_distance(hex_to_long(a), hex_to_long(b))


def bit_distance(a: Column, b: Column) -> Column:
    """Number of differing bits of two 16-character hash texts."""
    return F.bit_count(hex_to_long(a).bitwiseXOR(hex_to_long(b)))


def average_hash(px: Column) -> Column:
    """64-bit average hash of an 8x8 grey array: is each value above the mean?"""
    total = F.aggregate(px, F.lit(0.0), lambda s, v: s + v.cast("double"))

    def text(mean: Column) -> Column:
        return F.array_join(F.transform(px, lambda v: F.when(v > mean, F.lit("1")).otherwise(F.lit("0"))), "")

    bits = F.transform(F.array(total / F.size(px)), text)[0]
    return bits_to_hex(bits)


def _cosine_rows(side: int, size: int) -> np.ndarray:
    """First ``size`` rows of the DCT-II of length ``side``."""
    k = np.arange(size)[:, None]
    n = np.arange(side)[None, :]
    return 2.0 * np.cos(np.pi * k * (2 * n + 1) / (2 * side))


def perceptual_hash(px: Column, side: int = 32, size: int = fixed.HASH_SIZE) -> Column:
    """64-bit DCT hash of a ``side`` x ``side`` grey array.

    The cosine transform is a matrix product, so it runs as one numpy call per
    Arrow batch; a lambda over ``side**2 * size`` terms is far slower.
    """
    if size * size != 64:
        raise ValueError("perceptual_hash makes 64-bit hashes: size must be 8")
    basis = _cosine_rows(side, size)

    @F.pandas_udf("string")
    def dct_hash(values: pd.Series) -> pd.Series:
        known = values.notna().to_numpy()
        out = np.full(len(values), None, dtype=object)
        if known.any():
            grid = np.stack(values[known].to_numpy()).astype("float64").reshape(-1, side, side)
            low = (basis @ grid @ basis.T).reshape(len(grid), -1)
            bits = low > np.median(low, axis=1, keepdims=True)
            out[known] = [row.tobytes().hex() for row in np.packbits(bits, axis=1)]
        return pd.Series(out)

    return dct_hash(px)

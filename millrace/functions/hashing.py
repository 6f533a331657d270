"""64-bit perceptual hashes as BIGINT bit patterns: distances, bands and buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def band_layout(n_bands: int) -> list[tuple[int, int]]:
    """(first bit, width) of each band: 64 bits cut as evenly as whole bits allow."""
    cuts = [64 * k // n_bands for k in range(n_bands + 1)]
    return [(a, z - a) for a, z in zip(cuts, cuts[1:])]


def _mask(width: int) -> int:
    return (1 << width) - 1 if width < 63 else -1


def _turned(h: Column, by: int) -> Column:
    """The bits of a hash moved down by ``by`` places, those that fall out coming back at the top."""
    return F.shiftrightunsigned(h, by).bitwiseOR(F.shiftleft(h, 64 - by)) if 0 < by < 64 else h


def bands(h: Column, n_bands: int) -> Column:
    """Array of (band, key, rest): the bits of each band, and the hash turned so that the other bits come first.

    The shift is unsigned, as the top bit is a bit like any other.
    """
    return F.array(*[
        F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(h, start).bitwiseAND(F.lit(_mask(width))).alias("key"), _turned(h, start + width).alias("rest"))
        for k, (start, width) in enumerate(band_layout(n_bands))
    ])


def rest_bands(rest: Column, n_bands: int) -> Column:
    """Array of (band, key) over the low bits of ``rest``, as many as no band of ``n_bands`` bands of a hash reaches into."""
    free = 64 - max(12, *(width for _, width in band_layout(n_bands)))
    cuts = [free * k // n_bands for k in range(n_bands + 1)]
    return F.array(*[F.struct(F.lit(k).alias("band"), F.shiftrightunsigned(rest, a).bitwiseAND(F.lit(_mask(z - a))).alias("key")) for k, (a, z) in enumerate(zip(cuts, cuts[1:]))])


def first_shared(difference: Column, layout: list[tuple[int, int]]) -> Column:
    """The first band without a bit of ``difference``, or null."""
    found = None
    for k, (start, width) in enumerate(layout):
        same = F.shiftrightunsigned(difference, start).bitwiseAND(F.lit(_mask(width))) == 0
        found = F.when(same, k) if found is None else found.when(same, k)
    return found


def prefix(h: Column, bits: int = 12) -> Column:
    """The top bits of a hash."""
    return F.shiftrightunsigned(h, 64 - bits)


def probe_keys(h: Column, bits: int = 12) -> Column:
    """The prefix and all prefixes that differ from it in one bit."""
    p = prefix(h, bits)
    return F.concat(F.array(p), F.transform(F.sequence(F.lit(0), F.lit(bits - 1)), lambda b: p.bitwiseXOR(F.pow(F.lit(2.0), b).cast("long"))))


def median_hash(values: Column) -> Column:
    """Hash of 64 numbers: a bit per number that is over their median, the first number in the top bit.

    The median is bound once, as the only item of an array, and not worked out again for each number.
    """
    middle = F.transform(F.array(F.array_sort(values)), lambda s: (s[31] + s[32]) / 2)
    bits = F.transform(middle, lambda m: F.aggregate(values, F.lit(0).cast("long"), lambda acc, v: F.shiftleft(acc, 1).bitwiseOR((v > m).cast("long"))))
    return bits[0]

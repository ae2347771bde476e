"""Rows dealt into portions of bounded size, for what is broadcast in turns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most buckets that are measured; their sizes come to the driver.
MOST_BUCKETS = 1 << 16


def portions(rows: DataFrame, key: str, size: Column, limit: int) -> list[Column]:
    """Conditions that split ``rows`` into portions that carry at most ``limit`` bytes each.

    Rows of one ``key`` stay together, so a key that is larger alone makes a portion by
    itself. Keys are hashed to buckets, and buckets that are too large are made smaller until
    each fits or holds one key; what is measured is the size, not its average. No rows, no
    portions.
    """
    buckets = 1
    while True:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
        measured = rows.groupBy(bucket.alias("bucket")).agg(
            F.sum(size.cast("long")).alias("size"), (F.min(F.xxhash64(key)) < F.max(F.xxhash64(key))).alias("several")
        )
        found = sorted(measured.collect(), key=lambda r: r.bucket)
        if buckets >= MOST_BUCKETS or not any(r.several and r.size > limit for r in found):
            break
        buckets *= 16
    out, first, held = [], 0, 0
    for r in found:
        if held and held + r.size > limit:
            out.append(bucket.between(first, r.bucket - 1))
            first, held = r.bucket, 0
        held += r.size
    return [*out, bucket >= first] if found else []

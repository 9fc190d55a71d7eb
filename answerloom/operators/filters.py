"""Narrowing a table to what may have a partner, before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys are marked in this many bits, 32,768 to a row of 4 kB; so the filter never exceeds 16 MB.
FILTER_BITS = 1 << 27


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``keys`` (key) as a bitmap: bucket, marks. Combined map-side; at most ``bits / 32768`` rows, whatever the number of keys."""
    at = F.pmod("key", F.lit(bits)) + 1  # the bitmap functions count from 1
    return keys.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("marks"))


def maybe_in(rows: DataFrame, marked: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The ``rows`` (key, ...) whose bit is set in ``marked``: all with a key in the filter, and few others.

    The filter has a size bound of its own, so it is broadcast and no row moves.
    """
    at = F.pmod("key", F.lit(bits)) + 1
    position = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("marks", (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.get(F.array(*(F.lit(1 << k) for k in range(8))), (position % 8).cast("int"))
    hit = byte.bitwiseAND(bit) > 0
    with_bucket = rows.withColumn("_bucket", F.bitmap_bucket_number(at))
    return (
        with_bucket.join(F.broadcast(marked.withColumnRenamed("bucket", "_bucket")), "_bucket")
        .filter(hit).drop("_bucket", "marks")
    )

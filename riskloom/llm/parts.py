"""Joins on keys that may hold a third of all rows, dealt in parts.

A key with ``m`` of ``total`` rows is dealt in parts that hold about one row in ``PARTS``.
At most ``PARTS`` keys hold more than that, whatever the table's size, so the list of those
keys may be broadcast; and all keys together have at most ``PARTS`` parts more than keys.
The side with one row for each key carries ``salts``, the number of its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = 4096


def salts(m: Column, total: int) -> Column:
    return F.least(m, F.ceil(m * PARTS / F.lit(max(total, 1)))).cast("int")


def each_part(rows: DataFrame, part: str = "s") -> DataFrame:
    """A row of a key for every part of that key."""
    return rows.withColumn(part, F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))


def part_of(other: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(other), count).cast("int")


def joined(rows: DataFrame, per_key: DataFrame, key: str, other: str) -> DataFrame:
    """``rows`` join ``per_key`` (one row for each key, with ``salts``); rows of one key are
    dealt by ``other``. The result has the part's number as ``s``."""
    hot = F.broadcast(per_key.where("salts > 1").select(key, F.col("salts").alias("parts")))
    dealt = rows.join(hot, key, "left").withColumn("s", part_of(other, F.coalesce("parts", F.lit(1)))).drop("parts")
    return dealt.join(each_part(per_key), [key, "s"])

"""Problem 4: a sample that stays the same over reruns and keeps its members when records are added.

A ledger, persisted as parquet, holds every key selected so far with its priority and generation. A run keeps all ledger keys that
still occur, by a join, and fills what is missing of its quota from unseen keys with the lowest priority, a hash of the key and a
seed. Neither row order nor partitioning plays a part. With ``rate`` the quota is the number of unseen keys whose priority lies
below the rate; such a sample of a growing table holds that of the smaller table even where no ledger was kept. With ``total`` the
quota is exact, and the ledger is what keeps earlier members in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Priorities are the first 52 bits of an MD5, as a fraction.
BITS = 52
#: Bits that one round of the quota search resolves: a histogram of at most 2**STEP rows reaches the driver.
STEP = 12


def priority_bits(key: Column, seed: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key).cast("binary")), 1, BITS // 4), 16, 10).cast("long")


def _lowest(keys: DataFrame, quota: int) -> DataFrame:
    """The ``quota`` keys of lowest (bits, key), found by refining a histogram of the bits; no global sort."""
    if quota <= 0:
        return keys.limit(0)
    low, shift, left = 0, BITS, quota
    while shift > 0:
        shift -= min(STEP, shift)
        width = 1 << shift
        span = keys.where((F.col("bits") >= low) & (F.col("bits") < low + (width << STEP)))
        cells = span.groupBy(((F.col("bits") - low) / width).cast("long").alias("cell")).count().orderBy("cell").collect()
        for r in cells:
            if r["count"] >= left:
                low += r["cell"] * width
                break
            left -= r["count"]
        else:
            return keys  # fewer keys than the quota
        if r["count"] == left:
            return keys.where(F.col("bits") < low + width)
    edge = keys.where(F.col("bits") == low).orderBy("key").limit(left)  # keys of one 52-bit hash
    return keys.where(F.col("bits") < low).unionByName(edge)


def stable_sample(df: DataFrame, key: str, rate: float | None = None, total: int | None = None, ledger: DataFrame | None = None, seed: str = "sample") -> DataFrame:
    """``<key>, priority DOUBLE, generation INT`` of the selected keys, of the current table.

    Rows of one key are in or out together, whatever their number. Null keys are never selected; an empty table gives no rows;
    other columns are left out. Exactly one of ``rate`` (0 to 1) and ``total`` is given. Ledger keys that the table no longer
    holds do not come out, but still count as seen if they return.
    """
    if (rate is None) == (total is None):
        raise ValueError("give either rate or total")
    keys = df.select(F.col(key).cast("string").alias("key")).where("key is not null").distinct().withColumn("bits", priority_bits(F.col("key"), seed))
    if ledger is None:
        kept, unseen, generation = None, keys, 0
    else:
        own = ledger.select(F.col(key).cast("string").alias("key"), "generation").groupBy("key").agg(F.min("generation").alias("generation"))
        kept, unseen = keys.join(own, "key"), keys.join(own, "key", "left_anti")
        last = own.agg(F.max("generation")).first()[0]
        generation = 0 if last is None else last + 1
    if rate is not None:
        new = unseen.where(F.col("bits") < int(rate * (1 << BITS)))
    else:
        new = _lowest(unseen, total - (0 if kept is None else kept.count()))
    out = new.withColumn("generation", F.lit(generation))
    out = out if kept is None else kept.unionByName(out)
    return out.select(F.col("key").alias(key), (F.col("bits") / float(1 << BITS)).alias("priority"), "generation")


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return spark.read.parquet(path) if fs.exists(p) else None


def grow_sample(df: DataFrame, key: str, path: str, rate: float | None = None, total: int | None = None, seed: str = "sample") -> DataFrame:
    """``stable_sample`` against the ledger at ``path``, which then also holds the newly selected keys. Only they are appended, in
    one committed write, so a rerun after a failure finds either the old ledger or the new one."""
    spark = df.sparkSession
    ledger = read_ledger(spark, path)
    chosen = stable_sample(df, key, rate, total, ledger, seed)
    fresh = chosen if ledger is None else chosen.join(ledger.select(key), key, "left_anti")
    fresh.write.mode("append").parquet(path)
    return spark.read.parquet(path).join(df.select(F.col(key).cast("string").alias(key)).distinct(), key, "left_semi")

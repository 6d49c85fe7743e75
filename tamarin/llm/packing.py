"""Problem 7: filling containers of a fixed token capacity with whole texts, by minimum bin slack.

Only the histogram of lengths, at most one row per length up to the capacity, takes part in the search. For each window (container)
the largest remaining length is placed first; a bitset subset-sum over the remaining multiset then finds the filling closest to the
capacity, and backtracking through the bitsets gives its counts. A filling is used as often as the remaining counts allow, so the
number of different fillings is bounded by the number of lengths, not by the number of texts. Texts then find their container by
their rank within their length: ranks are counted per (length, hash bucket) and offset, so no task holds all texts of a length.

A text above the capacity is cut into full containers and a remainder, which is packed like any other text.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamarin.plans.durable import durable

#: Tokens a container holds.
CAPACITY = 2048
#: Vocabulary file of a public tokenizer and the pattern it splits by (fixed value).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes that a vocabulary file may have: it is sent to the tasks.
VOCABULARY_BYTES = 16_000_000
#: Texts that one hash bucket of a length is meant for, and the buckets of a length at least and at most.
PER_BUCKET, BUCKETS = 2_000_000, (16, 4096)
#: Rows up to which the table of fillings is broadcast.
SMALL = 500_000

_ENCODERS: dict = {}


def _encoder(name: str, packed: bytes):
    if name not in _ENCODERS:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, zlib.decompress(packed).splitlines())}
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[name]


def token_counts(df: DataFrame, key: str, text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """``<key>, tokens INT`` of every row; null and empty texts have 0 tokens. The vocabulary file is read where the query is made and
    sent to the tasks; one above VOCABULARY_BYTES raises ValueError."""
    with open(vocabulary, "rb") as f:
        raw = f.read(VOCABULARY_BYTES + 1)
    if len(raw) > VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary has more than {VOCABULARY_BYTES} bytes")
    packed, name = zlib.compress(raw), os.path.basename(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(name, packed).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int32())], [key, "tokens"])

    return df.select(key, text).mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, tokens int")


def _fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of the remaining lengths whose sum comes closest to ``room`` from below, larger lengths preferred."""
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left:
            size = min(size, left)
            steps.append((length, size, reach))
            reach |= reach << (length * size) & mask
            left -= size
            size *= 2
        if reach >> room & 1:
            break
    at, out = reach.bit_length() - 1, Counter()
    for length, size, before in reversed(steps):
        if not before >> at & 1:
            out[length] += size
            at -= length * size
    return out


def plan_fillings(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of one container, containers filled so) until nothing is left. Each filling is repeated until a length it needs runs
    short, so there are at most about as many as lengths."""
    counts = {x: n for x, n in histogram.items() if n > 0}
    out = []
    while counts:
        first = max(counts)
        counts[first] -= 1
        filling = Counter(_fill(counts, capacity - first))
        counts[first] += 1
        filling[first] += 1
        times = min(counts[x] // n for x, n in filling.items())
        for x, n in filling.items():
            counts[x] -= n * times
            if not counts[x]:
                del counts[x]
        out.append((dict(filling), times))
    return out


def _slots(plan: list[tuple[dict[int, int], int]], base: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, first container, texts of that length per container)."""
    used: Counter = Counter()
    out, container = [], base
    for filling, times in plan:
        for length, n in sorted(filling.items()):
            out.append((length, used[length], used[length] + n * times - 1, container, n))
            used[length] += n * times
        container += times
    return out


def _cells(slots: list[tuple[int, int, int, int, int]]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int, int, int]]]:
    """Ranks of a length fall into cells of one width, as many as it has slots: (length, width) of each, and each slot once for every
    cell it reaches into, at most twice as many rows as slots."""
    per: dict[int, list] = {}
    for s in slots:
        per.setdefault(s[0], []).append(s)
    widths = {size: -(-(max(s[2] for s in own) + 1) // len(own)) for size, own in per.items()}
    return sorted(widths.items()), [(s[0], cell, *s[1:]) for s in slots for cell in range(s[1] // widths[s[0]], s[2] // widths[s[0]] + 1)]


def pack(lengths: DataFrame, key: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``<key>, piece INT, tokens INT, container LONG``.

    ``lengths``: ``<key>, tokens``. Every row of it is packed, also rows of equal or null keys. Texts without tokens come out with a
    null container. Only texts above the capacity have more than one piece: full containers of their own, then the remainder.
    Container numbers run from 0 without gaps, shared ones first. An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = lengths.sparkSession
    rows = durable(lengths.select(F.col(key).alias("key"), F.coalesce(F.col("tokens"), F.lit(0)).cast("int").alias("tokens")), "lengths")
    buckets = min(BUCKETS[1], max(BUCKETS[0], -(-rows.count() // PER_BUCKET)))
    items = rows.where("tokens > 0").select(
        "key", "tokens",
        F.when(F.col("tokens") > capacity, F.col("tokens") % capacity).otherwise(F.col("tokens")).alias("size"),
        F.when(F.col("tokens") > capacity, F.floor(F.col("tokens") / capacity)).otherwise(0).cast("long").alias("full"),
        F.pmod(F.xxhash64("key", "tokens"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    groups = durable(items.groupBy("size", "bucket").agg(F.count("*").alias("n"), F.sum("full").alias("f")), "length-groups")
    sums = groups.groupBy("size").agg(F.sum("n").alias("n"), F.sum("f").alias("f")).collect()  # one row per length, at most the capacity
    slots = _slots(plan_fillings({r["size"]: r["n"] for r in sums if r["size"]}, capacity), 0)
    base, bases = max((c + (b - a) // n + 1 for _, a, b, c, n in slots), default=0), []
    for r in sorted(sums):
        bases.append((r["size"], base))
        base += r["f"]
    before = Window.partitionBy("size").orderBy("bucket")
    offsets = groups.select("size", "bucket", (F.sum("n").over(before) - F.col("n")).alias("n_before"), (F.sum("f").over(before) - F.col("f")).alias("f_before"))
    own = Window.partitionBy("size", "bucket").orderBy("key", "tokens")
    ranked = items.withColumn("rank", F.row_number().over(own) - 1).withColumn("f_rank", F.sum("full").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("full"))
    ranked = ranked.join(offsets, ["size", "bucket"]).join(F.broadcast(spark.createDataFrame(bases, "size int, base long")), "size").select(
        "key", "size", "full", (F.col("rank") + F.col("n_before")).alias("rank"), (F.col("base") + F.col("f_before") + F.col("f_rank")).alias("first_full")
    )
    # a text looks only at the fillings near its rank
    widths, cells = _cells(slots)
    small = F.broadcast if len(cells) <= SMALL else lambda df: df
    width = F.broadcast(spark.createDataFrame(widths, "size int, width long"))  # one row per length
    slot = small(spark.createDataFrame(cells, "size int, cell long, low long, high long, first long, per long"))
    near = ranked.where("size > 0").join(width, "size").withColumn("cell", F.floor(F.col("rank") / F.col("width")))
    shared = near.join(slot, ["size", "cell"]).where("rank between low and high").select(
        "key", F.col("full").cast("int").alias("piece"), F.col("size").alias("tokens"), (F.col("first") + F.floor((F.col("rank") - F.col("low")) / F.col("per"))).alias("container")
    )
    alone = ranked.where("full > 0").select("key", "first_full", F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1)).alias("piece")).select("key", "piece", F.lit(capacity).alias("tokens"), (F.col("first_full") + F.col("piece")).alias("container"))
    none = rows.where("tokens = 0").select("key", F.lit(0).alias("piece"), "tokens", F.lit(None).cast("long").alias("container"))
    return shared.unionByName(alone).unionByName(none).withColumnRenamed("key", key)

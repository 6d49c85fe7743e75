import random
from collections import Counter, defaultdict

import pytest

from tamarin.llm import packing as m

SCHEMA = "doc_id long, tokens int, container string"


def packed(spark, lengths, capacity):
    df = spark.createDataFrame([(i, n, "x") for i, n in enumerate(lengths)], SCHEMA)
    return m.pack(df, "doc_id", capacity).collect()


def check(lengths, rows, capacity):
    per, fill = defaultdict(list), Counter()
    for r in rows:
        per[r["doc_id"]].append(r)
        if r["container"] is not None:
            fill[r["container"]] += r["tokens"]
    assert all(v <= capacity for v in fill.values()) and sorted(fill) == list(range(len(fill)))
    for i, n in enumerate(lengths):
        n = n or 0
        assert sum(r["tokens"] for r in per[i]) == n
        assert len(per[i]) == (1 if n <= capacity else -(-n // capacity))
        assert n or per[i][0]["container"] is None
    return len(fill)


def test_tight_and_whole(spark):
    rng = random.Random(7)
    lengths = [rng.randrange(1, 60) for _ in range(500)]
    used = check(lengths, packed(spark, lengths, 100), 100)
    assert used <= -(-sum(lengths) // 100) + 1


def test_splits_only_above_capacity(spark):
    lengths = [250, 100, 200, 1, 0, None, 99, 50, 50, 100]
    assert check(lengths, packed(spark, lengths, 100), 100) == 9  # 2 + 1 + 2 full, 50 + 50, 99 + 1, 50, 100


def test_hot_length(spark):
    lengths = [40] * 999 + [20] * 500
    assert check(lengths, packed(spark, lengths, 100), 100) == -(-(40 * 999 + 20 * 500) // 100)


def test_subset_sum_is_best():
    rng = random.Random(8)
    for _ in range(100):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(6)}
        room = rng.randrange(0, 90)
        sums = {0}
        for x, n in counts.items():
            sums = {s + x * k for s in sums for k in range(n + 1)}
        got = m._fill(counts, room)
        assert sum(x * n for x, n in got.items()) == max(s for s in sums if s <= room) and all(n <= counts[x] for x, n in got.items() if n)


def test_edges(spark):
    assert packed(spark, [], 10) == []
    assert check([0, None], packed(spark, [0, None], 10), 10) == 0
    with pytest.raises(ValueError):
        packed(spark, [1], 0)


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "an ka manjé"), (2, None), (3, ""), (4, "la " * 100_000)], "doc_id long, text string")
    n = {r["doc_id"]: r["tokens"] for r in m.token_counts(df, "doc_id", "text").collect()}
    assert n[2] == n[3] == 0 and n[1] > 2 and n[4] >= 100_000


def test_each_rank_meets_its_slot_once():
    rng = random.Random(9)
    plan = m.plan_fillings({x: rng.randrange(1, 400) for x in range(1, 40)}, 60)
    slots = m._slots(plan, 0)
    widths, cells = m._cells(slots)
    width = dict(widths)
    assert len(cells) <= 2 * len(slots)
    for size, w in widths:
        last = max(s[2] for s in slots if s[0] == size)
        for rank in range(last + 1):
            assert sum(c[0] == size and c[1] == rank // w and c[2] <= rank <= c[3] for c in cells) == 1
    assert width.keys() == {s[0] for s in slots}


def test_vocabulary_is_sent_and_bounded(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "an ka")], "doc_id long, text string")
    monkeypatch.setattr(m, "VOCABULARY_BYTES", 10)
    with pytest.raises(ValueError):
        m.token_counts(df, "doc_id", "text")

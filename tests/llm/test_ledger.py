import random

import pytest

from tamarin.llm import ledger as m


def table(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "c string, priority int")


def chosen(df):
    return {r["c"] for r in df.collect()}


def test_rate_is_stable_without_ledger(spark):
    keys = [f"p{i}" for i in range(3000)]
    small, large = table(spark, keys[:1000]), table(spark, random.Random(1).sample(keys, len(keys)) + keys[:50])
    a, b = chosen(m.stable_sample(small, "c", rate=0.1)), chosen(m.stable_sample(large.repartition(7), "c", rate=0.1))
    assert a <= b and b & set(keys[:1000]) == a and 230 < len(b) < 370


def test_exact_quota_grows_and_keeps(spark, tmp_path):
    keys = [f"p{i}" for i in range(900)]
    path = f"file://{tmp_path}/ledger"
    a = chosen(m.grow_sample(table(spark, keys[:300]), "c", path, total=40))
    assert chosen(m.grow_sample(table(spark, keys[:300]), "c", path, total=40)) == a and len(a) == 40
    b = chosen(m.grow_sample(table(spark, keys), "c", path, total=90))
    assert a <= b and len(b) == 90
    rest = sorted((int(__import__("hashlib").md5(f"sample:{k}".encode()).hexdigest()[:13], 16), k) for k in keys if k not in a)
    assert b - a == {k for _, k in rest[:50]}


def test_quota_edges(spark):
    df = table(spark, ["a", "b", "b", None])
    assert chosen(m.stable_sample(df, "c", total=0)) == set()
    assert chosen(m.stable_sample(df, "c", total=1)) < {"a", "b"}
    assert chosen(m.stable_sample(df, "c", total=5)) == {"a", "b"} == chosen(m.stable_sample(df, "c", rate=1.0))
    assert m.stable_sample(table(spark, []), "c", total=3).count() == 0
    with pytest.raises(ValueError):
        m.stable_sample(df, "c")

import random

from tamarin.llm import ranking as m

SCHEMA = "id string, a double, b double, c double, d double, rho double"
SCORES = {"a": True, "b": False, "c": False, "d": False}


def test_significance_is_the_published_one(spark):
    """Against the tails of the beta distribution by numerical integration, all order statistics, corrected by their number."""
    from math import comb

    from pyspark.sql import functions as F

    def tail(r, k, n, steps=20_000):
        f = lambda x: k * comb(n, k) * x ** (k - 1) * (1 - x) ** (n - k)
        return sum(f((i + 0.5) * r / steps) for i in range(steps)) * r / steps

    rng = random.Random(3)
    rows = [[rng.random() ** 3 for _ in range(rng.randrange(1, 5))] for _ in range(12)]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rows], "r array<double>").select(m.significance(F.col("r"), 4)).collect()]
    for x, p in zip(rows, got):
        assert abs(p - min(1, len(x) * min(tail(v, k, len(x)) for k, v in enumerate(sorted(x), 1)))) < 1e-6


def test_consistent_items_lead_and_one_extreme_score_does_not(spark):
    rng = random.Random(1)
    rows = [(f"m{i}", rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1), None) for i in range(200)]
    rows += [("good", 2.5, -2.5, -2.5, -2.5, 9.0), ("bad", -2.5, 2.5, 2.5, 2.5, None), ("freak", 1e12, 0.5, 0.5, 0.5, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["id"]: r for r in m.aggregate_ranks(df, "id", SCORES, agree=2).collect()}
    assert out["good"]["place"] == 1 and out["bad"]["place"] == len(rows) and out["freak"]["place"] > 50
    out = {r["id"]: r for r in m.aggregate_ranks(df, "id", SCORES).collect()}
    assert out["good"]["place"] == 1 and out["bad"]["place"] == len(rows) and out["freak"]["rho"] > 100 * out["good"]["rho"]
    assert sorted(r["place"] for r in out.values())[-1] <= len(rows)


def test_monotone_scales_do_not_matter(spark):
    rng = random.Random(2)
    rows = [(str(i), rng.random(), rng.random(), rng.random(), rng.random(), None) for i in range(60)]
    bent = [(k, a**3 * 1e6, b**5, c * 1e-9, d + 7, None) for k, a, b, c, d, _ in rows]
    place = lambda rs: {r["id"]: r["place"] for r in m.aggregate_ranks(spark.createDataFrame(rs, SCHEMA), "id", SCORES).collect()}
    assert place(rows) == place(bent)


def test_nulls_nan_inf_ties_repeats(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("x", 1.0, 1.0, 1.0, 1.0, None), ("x", 1.0, 1.0, 1.0, 1.0, None), ("y", 1.0, 1.0, 1.0, 1.0, None), ("n", None, nan, None, None, None), ("p", 0.0, None, inf, 2.0, None), (None, 0.5, None, None, None, None)]
    out = {r["id"]: r for r in m.aggregate_ranks(spark.createDataFrame(rows, SCHEMA), "id", SCORES).collect()}
    assert len(out) == 5 and out["x"]["place"] == out["y"]["place"] == 2  # behind the row that has one score, of significance 0.75
    assert out["n"]["place"] is None and out["n"]["n_scores"] == 0 and out["p"]["n_scores"] == 3


def test_empty_table(spark):
    assert m.aggregate_ranks(spark.createDataFrame([], SCHEMA), "id", SCORES).count() == 0

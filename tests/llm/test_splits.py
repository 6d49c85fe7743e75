import random

from tamarin.llm import splits as m
from tamarin.llm.words import plain_words

SCHEMA = "pair_id long, target_gcf string, corpus string, form int"


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def found(spark, train, val):
    one = lambda rows: spark.createDataFrame(rows, SCHEMA)
    rows = m.split_records({"train": one(train), "val": one(val)}, "pair_id", "target_gcf", "corpus")
    return {(r["eval_key"], r["train_key"]) for r in m.overlaps(rows).collect()}, rows


def test_against_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(12)]
    train, val = [], []
    for i in range(60):
        n = rng.choice((1, 2, 3, 4, 5, 5, 6, 7, 9, 10, 14, 15, 20, 25))
        s = [rng.choice(words) for _ in range(n)]
        train.append((i, " ".join(s), None, 0))
        for k in range(3):
            t = list(s)
            for _ in range(rng.randrange(0, n // 4 + 2)):
                at, kind = rng.randrange(len(t) + 1), rng.random()
                t[at : at + (kind < 0.7)] = [rng.choice(words)] if kind > 0.3 else []
            val.append((1000 + 10 * i + k, " ".join(t), "c", 0))
    want = set()
    for v, a, _, _ in val:
        for t, b, _, _ in train:
            x, y = plain_words(a), plain_words(b)
            if x and y and edits(x, y) * 5 <= max(len(x), len(y)):
                want.add((v, t))
    assert found(spark, train, val)[0] == want and len(want) > 60


def test_case_accents_copies_and_nulls(spark):
    train = [(1, "Zòt vlé fouyé tout linj la!", "a", 0), (2, "zot vle fouye tout linj la", None, 0), (2, "zot vle fouye tout linj la", None, 0), (3, None, "a", 0), (4, " ... ", "a", 0)]
    val = [(10, "ZOT VLE​ FOUYE TOUT LINJ LA", None, 0), (11, None, "x", 0), (12, "...", "x", 0)]
    pairs, rows = found(spark, train, val)
    assert pairs == {(10, 1), (10, 2)}
    report = {(r["split"], r["source"]): r for r in m.overlap_report(rows).collect()}
    assert report["val", None]["leaked"] == 1 and report["val", None]["exact"] == 1 and report["val", None]["coverage"] == 1.0


def test_empty_tables(spark):
    assert found(spark, [], [])[0] == set()
    assert found(spark, [(1, "an ka manjé diri", None, 0)], [])[0] == set()


def test_records_share_the_promised_run():
    """No placing of the allowed edits leaves only shorter runs of equal words than the window is made for."""
    for n in range(m.BUDGET, 80):
        e = n // m.BUDGET
        assert m.clean_run(n) <= -(-(n - e) // (e + 1))
        assert m.clean_run(n) >= (m.RUN + 1 if n >= m.LONG else m.RUN if n > m.BUDGET else 2)


def test_windows_hold_a_fingerprint_and_any_order_keeps_common_ones():
    import numpy as np

    rng = np.random.default_rng(2)
    level = rng.integers(0, 9, m.SKETCH).astype(np.uint8)
    words = [f"w{i}" for i in rng.integers(0, 40, 60)]
    batch = m.Batch([words, words[20:40], words[:7]])
    h, at = batch.runs(m.RUN)
    which = batch.which[at]
    ok = m.winnow(h, which, np.array([True, True, False]), level)
    assert all(ok[i] or ok[i + 1] for i in range(len(h) - 1) if which[i] == which[i + 1])
    assert set(h[ok & (which == 1)][1:-1]) <= set(h[ok & (which == 0)]) and ok[which == 2].all()
    assert ok[which == 0].sum() < 0.8 * (which == 0).sum()


def test_chain_and_distance():
    a, b = "a b c d e f g h i j".split(), "x a b c d f g h i y".split()
    assert m.chain([(0, 1), (1, 2), (5, 5)], a, b) == 8  # a-d and f-i
    assert m.chain([(0, 7), (5, 0)], "a b c d e f".split(), "f u v w x y z a b c".split()) == 3  # crossing seeds: the longer one
    assert m.chain([], a, b) == 0
    rng = random.Random(8)
    for _ in range(300):
        x, y = [[rng.choice("abc") for _ in range(rng.randrange(0, 9))] for _ in range(2)]
        assert m.distance(x, y, 99) == edits(x, y) and m.distance(x, y, 2) == min(3, edits(x, y))
    many = [f"w{i}" for i in range(30_000)]
    assert m.distance(many, many[:100] + ["x"] + many[101:], 10) == 1


def test_common_runs_are_sliced(spark, monkeypatch):
    """Rows of one hot run stand in many slices, and no pair is lost or doubled."""
    monkeypatch.setattr(m, "HOT", 1)
    hot = "an ka manjé diri la chak jou lè an ni tan pou"
    train = [(i, f"{hot} fè sa {i} {i + 1} {i + 2} {i + 3} {i + 4}", "a", 0) for i in range(60)]
    val = [(1000 + i, f"{hot} fè sa {i} {i + 1} {i + 2} {i + 3} x", "a", 0) for i in range(0, 60, 7)]
    pairs, rows = found(spark, train, val)
    assert m.slices(m._counts(m._classes(rows))).max() > 3
    want = {(v, t) for v, x, _, _ in val for t, y, _, _ in train if edits(plain_words(x), plain_words(y)) * 5 <= 18}
    assert pairs == want and len(want) >= 9

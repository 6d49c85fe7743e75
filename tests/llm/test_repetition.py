import random


from tamarin.llm import repetition as m

SCHEMA = "id string, whisper_ht string, repeats string"


def brute(words):
    n, hit = len(words), 0
    for i in range(n):
        echo = i and words[i] == words[i - 1]
        run = any(any(words[s : s + 3] == words[e : e + 3] for e in range(s)) for s in range(max(0, i - 2), min(i, n - 3) + 1))
        hit += bool(echo or run)
    return hit


def test_against_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        w = [rng.choice((b"a", b"b", b"c", b"d")) for _ in range(rng.randrange(0, 25))]
        assert m.repeats(w) == brute(w)


def test_cases_and_edges(spark):
    stuck = "an ka manjé diri la " * 4
    rows = [("a", stuck, "x"), ("a", stuck, "x"), ("b", "an ka manjé diri la jodi a", "x"), ("c", None, "x"), ("d", " ", "x"), ("e", "wi wi wi", "x"), ("f", "wi " * 50_000, "x"), (None, stuck, "x"), ("g", "WI wi, Wí wi wi wi", "x")]
    rows += [(f"n{i}", f"fraz nimewo {i} ka di on biten ki pa ka répété", "x") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    stats = m.repetition(df, "id", "whisper_ht")
    assert stats.count() == len(rows)
    by = {r["id"]: r for r in stats.collect()}
    assert by["c"]["n_words"] == by["d"]["n_words"] == 0 and by["f"]["repeats"] == 49_999 and by["e"]["repeats"] == 2
    assert {r["id"] for r in m.repetitive(df, "id", "whisper_ht", m.fit(df, "id", "whisper_ht")).collect()} == {"a", "f", "g"}
    none = df.limit(0)
    assert m.repetitive(none, "id", "whisper_ht", m.fit(none, "id", "whisper_ht")).count() == 0


def test_decision_list_is_right_on_held_out_rows(spark):
    rng = random.Random(6)
    row = lambda x: {f: x if f in ("pair_share", "echo_share") else rng.random() for f in m.FEATURES} | {"label": "repetitive" if x >= 0.3 else "clean"}
    rules = m.learn_decision_list([row(rng.choice((rng.uniform(0, 0.2), rng.uniform(0.4, 1)))) for _ in range(400)], ("repetitive", "clean"))
    assert rules and all(r.conditions for r in rules)
    test = [row(rng.choice((rng.uniform(0, 0.2), rng.uniform(0.4, 1)))) for _ in range(200)]
    df = spark.createDataFrame([tuple(r[f] for f in m.FEATURES) + (r["label"],) for r in test], [*m.FEATURES, "label"])
    said = df.select("label", m.decision(rules).alias("said")).collect()
    assert sum(r["label"] == r["said"] for r in said) >= 195
    assert df.select(m.decision([])).first()[0] == "uncertain"


def said(rows):
    return {lab: {r["key"] for r in rows if r["said"] == lab} for lab in ("repetitive", "clean", "uncertain")}


def test_the_list_decides(spark):
    """Its word stands: a list that calls all clean finds nothing, one that calls all repetitive finds all, none leaves all to the
    exact measure. The share of repeats is no feature."""
    stuck = "an ka manjé diri la " * 4
    df = spark.createDataFrame([("a", stuck), ("b", "an ka manjé diri la jodi a")], "id string, whisper_ht string")
    find = lambda *rules: {r["id"] for r in m.repetitive(df, "id", "whisper_ht", list(rules)).collect()}
    every = (("distinct_share", False, 0.0),)
    assert find() == {"a"} and find(m.Rule("clean", every)) == set() and find(m.Rule("repetitive", every)) == {"a", "b"}
    assert "repeat_share" not in m.FEATURES


def test_the_list_alone_on_rows_it_was_not_learned_from(spark):
    """Precision and recall of what the list decides, and how much it leaves to the exact measure."""
    import pyarrow.parquet as pq

    from tamarin.llm.words import plain_words

    rows = [(r["id"], r["whisper_ht"]) for r in pq.read_table("/root/testdata/sf0.1/dataset_corrected.parquet", columns=["id", "whisper_ht"]).to_pylist() if r["whisper_ht"]]
    rows = [r for r in rows if len(plain_words(r[1])) >= m.MIN_WORDS]
    schema = "id string, whisper_ht string"
    rules = m.fit(spark.createDataFrame(rows[:4000], schema), "id", "whisper_ht")
    assert {r.label for r in rules} == {"repetitive", "clean"}
    held = rows[4000:]
    got = said(m.decided(spark.createDataFrame(held, schema), "id", "whisper_ht", rules).collect())
    case = {k for k, t in held if m.is_case(len(w := plain_words(t)), m.repeats(w))}
    clear = got["repetitive"] - got["uncertain"]
    assert len(clear & case) >= 0.99 * len(clear) and len(got["clean"] & case) <= 0.01 * len(case)
    assert len(clear & case) >= 0.9 * len(case) and len(got["uncertain"]) <= 0.02 * len(held)

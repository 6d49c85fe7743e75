import random

import pytest
from pyspark.sql import functions as F

from tamarin.llm import language as m
from tamarin.llm.spanish import GENERAL

FR = ["la maison est dans la rue derrière le pont", "nous allons chercher le pain avec les enfants", "il ne peut pas fermer la porte de la voiture", "elle doit trouver la clé pour ouvrir la fenêtre"]
EN = ["the house is in the street behind the bridge", "we are going to look for bread with the children", "he cannot close the door of the car", "she must find the key to open the window"]
LABELLED = [("fr", t) for t in FR] + [("en", t) for t in EN] + [(None, "x"), ("fr", None), ("fr", " ")]


def parser():
    return m.Parser(m.learn([(x, t) for x, t in LABELLED if x and t]))


def test_automaton_finds_the_longest_stretch():
    rng = random.Random(5)
    text = " " + "".join(rng.choice("abc ") for _ in range(300)) + " "
    a = m.Automaton(text)
    for _ in range(300):
        q = "".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 9)))
        assert a.longest(q, 0) == max(k for k in range(len(q) + 1) if q[:k] in text)


def test_phrases_are_the_greedy_parse():
    rng = random.Random(6)
    texts = [[rng.choice("abcde") for _ in range(rng.randrange(1, 9))] for _ in range(12)]
    x = m.Language(texts)
    held = [tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i + 1, len(t) + 1)]
    for _ in range(100):
        q, want, i = [rng.choice("abcde") for _ in range(rng.randrange(1, 10))], [], 0
        while i < len(q):
            k = max(k for k in range(1, len(q) - i + 1) if tuple(q[i : i + k]) in held)
            want += [1 / k] * k
            i += k
        assert x.phrases(q, [x.unknown(w) for w in q]) == pytest.approx(want)
    assert x.phrases(["zz"], [x.unknown("zz")])[0] > m.UNKNOWN and x.unknown("a") is None


def test_six_words_at_the_start_in_the_middle_and_at_the_end():
    p = parser()
    six = "he must open the car door"
    for t in (f"{six}. {FR[0]}. {FR[1]}.", f"{FR[0]}. {six}. {FR[1]}.", f"{FR[0]}. {FR[1]}. {six}."):
        assert {s[0] for s in p.stretches(t) if s[2] >= m.STRETCH} == {"fr", "en"}


def test_spanish_comes_from_general_text():
    p = m.Parser(m.learn([(x, t) for x, t in LABELLED if x and t], GENERAL))
    for t in ("Los hombres tienen derecho a una casa y a su trabajo", "el mozo no sabe leer los libros de su ama"):
        assert [s[0] for s in p.stretches(t)] == ["es"]
    # and only where no table labels it
    assert m.learn([("es", "hola"), ("fr", FR[0])], GENERAL)["es"] == ["hola"]


def test_many_languages_and_long_texts_are_kept(spark):
    rows = [(f"l{i:03d}", f"w{i}a w{i}b w{i}c") for i in range(80)] + [("big", "mo " * 40_000 + str(i)) for i in range(3)]
    texts = m.labelled_text(spark.createDataFrame(rows, "lang string, text string"))
    assert len(texts) == 81 and len(texts["big"]) == 1 and len(texts["big"][0]) > 120_000


def test_whole_and_mixed_texts():
    p = parser()
    assert [s[0] for s in p.stretches("la clé de la maison est dans la voiture")] == ["fr"]
    assert [s[0] for s in p.stretches("THE KEY OF THE HOUSE IS IN THE CAR")] == ["en"]
    found = p.stretches("nous allons chercher la clé de la maison, he cannot open the door of the house")
    assert [s[0] for s in found] == ["fr", "en"] and all(s[2] >= 6 and 0 < s[3] <= 1 for s in found)
    assert p.stretches(None) == p.stretches("  ...") == []


def test_misstated_and_edges(spark):
    rows = [("a", FR[0], "français"), ("b", FR[0], None), ("c", EN[0], "français"), ("d", FR[1] + " " + EN[1], "français"), ("e", "le pont", None), (None, FR[0], None), ("f", None, None), ("b", FR[0], None), ("g", FR[0], "")]
    df = m.language_stretches(spark.createDataFrame(rows, "c string, t string, m string"), "t", m.learn([(x, t) for x, t in LABELLED if x and t]))
    says = F.when(F.col("m") == "français", F.array(F.lit("fr"))).when(F.col("m") == "", F.array(F.lit("gcf")))
    out = {tuple(r) for r in m.misstated(df, "c", "m", says).collect()}
    assert out == {("b", "fr"), ("c", "en"), ("d", "fr"), ("d", "en"), ("g", "fr")}
    assert m.language_stretches(df.drop("stretches").limit(0), "t", {"fr": ["la"]}).count() == 0


def test_held_out_accuracy():
    import pyarrow.parquet as pq

    d = "/root/testdata/sf0.001/"
    rows = [(r["lang"].lower(), r["text"]) for n in ("subject_examples", "heldout_items") for r in pq.read_table(d + n + ".parquet").to_pylist() if r["lang"] and r["text"]]
    random.Random(1).shuffle(rows)
    p = m.Parser(m.learn(rows[60:]))
    right = sum(max(p.stretches(t), key=lambda s: s[2])[0] == x for x, t in rows[:60])
    assert right >= 58

import math

import pytest
from pyspark.sql import functions as F

from tamarin.functions import scores
from tamarin.operators import charlm, evaluate, gate, ingest, nbest, pairs
from tamarin.plans.correct import batch_corrector
from tamarin.operators.ranks import medians, value_ranks


@pytest.mark.parametrize(
    "text, want",
    [("Sous-titrage ST", "hallucination"), ("je suis dans les temps", "français"), ("je ka vini", None), ("", None), (None, None), ("merci.", "hallucination"), ("dans les", None), ("an ka manjé diri la", None)],
)
def test_gate(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(gate.rejection(F.col("t"))).first()[0] == want


def test_reasons_and_confidence(spark):
    df = spark.createDataFrame([(None, 1.0, None, None, 5), (-1.5, 2.5, 200.0, 0.9, 1), (-1.0, 2.0, 100.0, 0.6, 2)], "l double, c double, p double, s double, n int")
    out = [r[0] for r in df.select(gate.reasons(*(F.col(c) for c in "lcpsn"))).collect()]
    assert out == [[], ["logprob<-1.0", "compression>2.0", "ppl>100", "no_speech>0.6", "trop_court"], []]
    sig = lambda x, m, s: 1 / (1 + math.exp(-(x - m) / s))
    want = (0.3 * sig(-0.4, -1, 0.25) + 0.15 * (1 - sig(1.2, 2, 0.2)) + 0.35 * (1 - sig(math.log(20), math.log(100), 0.35)) + 0.2 * (1 - sig(0.1, 0.45, 0.12))) / 1.1
    df = spark.createDataFrame([(-0.4, 1.2, 20.0, 0.1, ["c"])], "l double, c double, p double, e double, v array<string>")
    assert abs(df.select(scores.confidence(F.col("l"), F.col("c"), F.col("p"), F.col("p"), F.col("e"), F.col("v"))).first()[0] - want) < 1e-4


@pytest.mark.parametrize("conf, table, want", [(0.55, [("0.5", 0.2), ("0.6", 0.1)], 0.2), (0.75, [("0.5", 0.2), ("0.9", 0.1)], 0.1), (0.8, [], 0.1)])
def test_bucket_lookup(spark, conf, table, want):
    t = spark.createDataFrame(table, "bucket string, wer double")
    assert abs(ingest.estimate_wer(spark.createDataFrame([(conf,)], "c double"), "c", t).first()["wer_estime"] - want) < 1e-9


def test_language_model(spark):
    targets = ["an ka manjé diri la", "i ka palé é mwen", "nou té ni onlo biten", "yo ka vini adan kaz la", "an té alé adan maché la"] * 5
    model = charlm.fit(spark.createDataFrame([(t,) for t in targets] + [(None,)], "t string"), "t", 4).persist()
    df = spark.createDataFrame([(1, "an ka manjé diri la"), (2, "mwen ap manje diri a"), (3, ""), (4, None)], "k int, t string")
    out = {r["k"]: r["perplexity"] for r in charlm.perplexity(df, "k", "t", model, 4).collect()}
    assert out[1] < out[2] and set(out) == {1, 2, 3, 4}
    counts = [{} for _ in range(5)]
    for t in [*targets, ""]:
        s = f"^{t}$"
        for n in range(1, 5):
            for i in range(len(s) - n + 1):
                counts[n][s[i : i + n]] = counts[n].get(s[i : i + n], 0) + 1
    total = sum(counts[1].values())

    def prob(ctx, ch):
        for k in range(len(ctx), -1, -1):
            c = ctx[len(ctx) - k :] if k else ""
            num, den = counts[k + 1].get(c + ch, 0), counts[k].get(c, 0) if k else total
            if num and den:
                return 0.4 ** (len(ctx) - k) * num / den
        return 1 / total

    s = "^mwen ap manje diri a$"
    lp = sum(math.log10(max(prob(s[max(0, i - 3) : i], s[i]), 1e-12)) for i in range(1, len(s)))
    assert abs(out[2] - 10 ** (-lp / (len(s) - 1))) < 1e-6


def test_quantile_medians_and_ranks(spark):
    df = spark.range(1, 21).select(F.col("id").cast("double").alias("v"))
    assert charlm.quantile_by_index(df, "v").first()[0] == 20.0
    assert charlm.quantile_by_index(df.limit(0), "v").first()[0] is None
    v = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", 9.0), ("b", 5.0), ("c", None)] + [("h", float(i % 3)) for i in range(3000)], "name string, v double")
    assert {(r["name"], r["median"]) for r in medians(v).collect()} == {("a", 2.0), ("b", 5.0), ("h", 1.0)}
    r = {(x["name"], x["v"]): (x["n"], x["less"], x["total"]) for x in value_ranks(v.where("v is not null")).collect()}
    assert r["a", 2.0] == (2, 1, 4) and r["h", 2.0] == (1000, 2000, 3000)


def test_sentences_noise_and_limits(spark):
    df = spark.createDataFrame([(1, "An ka manjé diri la. Wi. An ka manje diri la!"), (2, "an ka manjé, diri la"), (3, None), (4, " ")], "k int, t string")
    out = pairs.clean_sentences(df, "k", "t").collect()
    assert [(r["k"], r["pos"], r["sentence"]) for r in out] == [(1, 0, "An ka manjé diri la.")]
    text = "an ka manjé adan kaz la èvè fanmi an mwen"
    base = spark.createDataFrame([(1, text), (2, None)], "k int, t string")
    same = pairs.add_noise(base, "k", "t", 0.0).collect()
    assert [r["noisy"] for r in same] == [text, None]
    noisy = pairs.add_noise(base, "k", "t", 0.3, variants=20).persist()
    assert len({r["noisy"] for r in noisy.where("k = 1").collect()}) > 1
    again = pairs.add_noise(base.repartition(3), "k", "t", 0.3, variants=20)
    assert {tuple(r) for r in noisy.collect()} == {tuple(r) for r in again.collect()}
    n = spark.range(100).select(F.col("id").cast("double").alias("o"), F.lit(2).alias("a"))
    assert pairs.until_enough(n, "o", "a", 31).count() == 16 and pairs.until_enough(n.limit(0), "o", "a", 31).count() == 0
    a, b = spark.createDataFrame([("fraz 1",), ("fraz 2",)], "t string"), spark.createDataFrame([("Fraz 2!",), ("fraz 3",), (None,)], "t string")
    assert pairs.leaked_fingerprints(a, b, "t").count() == 1


def test_hypotheses(spark):
    rows = [("a", "wi", 0.0, -0.1, -2.0, "an ka alé"), ("a", "WI", 0.2, -0.1, -2.0, "an ka alé"), ("a", "wi wi", 0.4, -0.1, -2.0, "an ka ay"), ("b", "non", 0.0, None, None, "non")]
    h = spark.createDataFrame(rows, "audio string, text string, temperature double, avg_logprob double, lm_logprob double, corrected string")
    ranked = nbest.rank(nbest.dedup(h))
    assert {(r["audio"], r["text"], r["rank"]) for r in ranked.collect()} == {("a", "wi wi", 1), ("a", "wi", 2), ("b", "non", 1)}
    out = {r["audio"]: r for r in nbest.agreement(ranked).collect()}
    assert abs(out["a"]["accord"] - 0.6667) < 1e-9 and not out["a"]["kept"] and out["b"]["n_hypotheses"] == 1 and not out["b"]["kept"]
    p = spark.createDataFrame([(str(i), "t") for i in range(4)], "source string, target string")
    assert nbest.mix(p, p.limit(3), 0.5).count() == 6


def test_ingest(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    done = spark.createDataFrame([("a", "x"), ("b", " ")], "k string, t string")
    got = lambda df: sorted(r[0] for r in df.collect())
    assert got(ingest.todo(keys, done, "k")) == ["c"] and got(ingest.todo(keys, done, "k", "t", retry_empty=True)) == ["b", "c"] and got(ingest.todo(keys, done, "k", redo=True)) == ["a", "b", "c"]
    t = spark.createDataFrame([("a_segment_1_5.mp3", " an "), ("b", ""), ("c", "ok")], "file_name string, transcription string")
    r = spark.createDataFrame([("b", None, "mové"), ("c", "français", "x"), ("d", "hallucination", "merci")], "file_name string, motif string, texte_rejete string")
    assert {tuple(x) for x in ingest.build_index(t, r).collect()} == {("a_segment_1_5.mp3", "an", "", 4), ("b", "mové", "rejet", 0), ("c", "ok", "français", 0), ("d", "merci", "hallucination", 0)}
    index = spark.createDataFrame([(f"s{i:02d}", "t", "", 1000) for i in range(30)], "c string, t string, m string, d long")
    wit = spark.createDataFrame([("s25", "r"), ("s27", "r"), ("zz", "r")], "c string, ref string")
    page = ingest.inject_witnesses(ingest.page(index, 0, 12), index, wit, spark.createDataFrame([], "id string")).collect()
    assert [r["position"] for r in page if r["temoin"]] == [3, 10] and len(page) == 14
    assert ingest.manifest(ingest.lot(index, None, 5, "x"), "l", "c", 32).first()["segments"][0]["f"] is not None
    assert ingest.known_witnesses(wit, index).count() == 2


def test_evaluation(spark):
    df = spark.createDataFrame([("mwen ap manje", "an ka manjé", "an ka manjé")], "s string, p string, r string")
    out = evaluate.evaluate(df, "s", "p", "r").first()
    assert out["wer_after"] == 0 and out["wer_reduction"] == 1 and out["exact_matches"] == 1
    assert evaluate.evaluate(df.limit(0), "s", "p", "r").first()["n"] == 0
    assert evaluate.mismatches(df, "s", "s", "r").count() == 1 and evaluate.mismatches(df, "s", "p", "r").count() == 0
    v = spark.range(1, 12).select("id")
    assert {(r["q"], r["value"]) for r in evaluate.quantiles(v, "id").collect()} == {(0.1, 2.0), (0.25, 3.5), (0.5, 6.0), (0.75, 8.5), (0.9, 10.0)}
    a = spark.createDataFrame([("wi", "wi", 0.1), ("non", "wi", 0.3), ("x", None, 0.9)], "p string, t string, e double")
    assert tuple(evaluate.audited(a, "p", "t", "e").first()) == (2, 0.5, 0.2)


def test_corrector_isolates_failures(spark):
    def fix(texts):
        if "bad" in texts:
            raise ValueError("no")
        return [t.upper() for t in texts]

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (1, "a")], "k int, t string")
    out = {r["k"]: (r["new"], r["correction_error"]) for r in batch_corrector(fix)(df, "k", "t", "new").collect()}
    assert out == {1: ("A", None), 2: ("", "ValueError: no"), 3: ("", None)}

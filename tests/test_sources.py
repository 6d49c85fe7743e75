import json

import pytest

from tamarin.operators import suggest
from tamarin.sources import readers, writers


def test_text_column():
    assert readers.text_column(["audio", "Transcription"]) == "Transcription" and readers.text_column(["audio", "foo"]) == "foo"
    with pytest.raises(KeyError):
        readers.text_column(["a"], "b")
    with pytest.raises(KeyError):
        readers.text_column(["audio"])


def test_tolerant_lines(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('﻿{"k": "x", "t": "1"}\n\n{"k": "y", "t": "2"}\n{"k": "x", "t": "3"}\n{"k": "z", "t"', encoding="utf-8")
    df = readers.tolerant_json_lines(spark, str(tmp_path / "a.jsonl"), "k string, t string")
    assert df.count() == 3
    assert {tuple(r) for r in readers.tolerant_json_lines(spark, str(tmp_path / "a.jsonl"), "k string, t string", "k").collect()} == {("x", "3"), ("y", "2")}


def test_corrections_sheets_lexicon(spark, tmp_path):
    d = tmp_path / "corrections"
    d.mkdir()
    (d / "jan.jsonl").write_text('{"id": "s1", "corrected": "wi", "at": 5}\n{"id": "s2", "annotateur": "lia", "at": 6}\n')
    assert {(r["id"], r["annotateur"]) for r in readers.corrections(spark, str(d)).collect()} == {("s1", "jan"), ("s2", "lia")}
    (tmp_path / "s.csv").write_text('whisper_ht,corrected\n"a, ""b""",c\nx,\n')
    assert [tuple(r) for r in readers.corrected_pairs(readers.sheet(spark, str(tmp_path / "s.csv"))).collect()] == [('a, "b"', "c")]
    (tmp_path / "d.json").write_text(json.dumps([["Wi", 3], ["kaz", 1]]))
    assert {r[0] for r in readers.lexicon(spark, str(tmp_path / "d.json")).collect()} == {"wi", "kaz"} and readers.lexicon(spark, str(tmp_path / "none.json")).count() == 0
    for n in ("b.mp3", "a.wav", "c.txt"):
        (tmp_path / n).write_bytes(b"x")
    assert readers.audio_files(spark, str(tmp_path)).count() == 2


def test_writers(spark, tmp_path):
    from tamarin.operators.rules import seed_rules

    df = spark.createDataFrame([("a", 'x, "y"', "train"), ("b", None, "val")], "id string, t string, split string")
    assert writers.json_lines(df, f"{tmp_path}/j") == 2 and readers.json_lines(spark, f"{tmp_path}/j", "id string").count() == 2
    writers.split_sheets(df, f"{tmp_path}/s")
    assert readers.sheet(spark, f"{tmp_path}/s/split=train").first()["t"] == 'x, "y"'
    writers.sheet(df, f"{tmp_path}/crlf", crlf=True)
    assert any(b"\r\n" in p.read_bytes() for p in (tmp_path / "crlf").glob("*.csv"))
    n = writers.rules_file(seed_rules(spark), f"{tmp_path}/rules.json")
    back = readers.rules_file(spark, f"{tmp_path}/rules.json")
    assert n == back.count() == 42 and back.where("kind = 'regex'").count() == 3
    writers.json_object(df.limit(1), f"{tmp_path}/o.json")
    assert json.loads((tmp_path / "o.json").read_text())["id"] == "a"
    text = writers.markdown_report(spark, f"{tmp_path}/r.md", "Report", {"rows": df, "none": df.limit(0)})
    assert "| a |" in text and "_none_" in text


def test_suggestions(spark):
    words = suggest.dictionary(spark.createDataFrame([("manjé", 9), ("Manman", 5), ("mango", 7), ("kaz", 3), (None, 1)], "w string, n int"), "w", "n")
    ask = spark.createDataFrame([("man", "ka"), ("manjo", "ka"), ("q", "ka"), ("Kaz", None)], "input string, previous string")
    assert [r["word"] for r in suggest.prefix_matches(ask, words).where("input = 'man'").orderBy("rank").collect()] == ["manjé", "mango", "manman"]
    assert [(r["word"], r["distance"]) for r in suggest.fuzzy_matches(ask, words).where("input = 'manjo'").orderBy("rank").collect()] == [("manjé", 1), ("mango", 1)]
    out = suggest.merged(suggest.primary_suggestions(ask, words), suggest.secondary_suggestions(ask, words)).collect()
    assert {(r["input"], r["slot"]): r["word"] for r in out}["Kaz", 1] == "Kaz" and not any(r["input"] == "q" for r in out)
    assert suggest.prefix_matches(ask.limit(0), words).count() == 0


def test_pipeline_report(spark, tmp_path):
    from tamarin.operators.rules import seed_rules
    from tamarin.plans.report import RULES, pipeline_report

    rules = seed_rules(spark).selectExpr("*").drop("support").selectExpr("*", "length(src) as support")
    left = spark.createDataFrame([("a", "b", "replace")] * 3 + [("", "c", "insert")], "src string, tgt string, op string")
    text = pipeline_report(spark, f"{tmp_path}/r.md", rules=rules, residuals=left, deliverables={"rules": f"{tmp_path}/none", "report": str(tmp_path)})
    assert (tmp_path / "r.md").read_text() == text and "stage has not run" in text and "| rules | missing |" in text
    assert "| a | b | replace | 3 |" in text and text.split("## Starting")[0].count("\n| ") == RULES + 1


def test_sheets_keep_blanks_and_lines(spark, tmp_path):
    rows = [(" a ", ""), (None, "x\ny"), ('"q"', "tab\t")]
    writers.sheet(spark.createDataFrame(rows, "s string, t string"), f"{tmp_path}/s")
    assert {tuple(r) for r in readers.sheet(spark, f"{tmp_path}/s").collect()} == {(" a ", None), *rows[1:]}  # a sheet has no empty text


def test_sorted_lines_and_first_model(spark, tmp_path):
    import pytest

    from tamarin.operators import charlm

    df = spark.createDataFrame([(f"k{i * 37 % 100:02d}", i) for i in range(100)], "k string, i int").repartition(5)
    writers.sorted_json_lines(df, f"{tmp_path}/lines", "k")
    keys = [json.loads(line)["k"] for p in sorted((tmp_path / "lines").glob("part-*")) for line in p.read_text().splitlines()]
    assert keys == sorted(keys) and len(keys) == 100
    model = charlm.fit(df, "k", 2)
    model.write.parquet(f"{tmp_path}/small")
    held, at = charlm.load(spark, f"{tmp_path}/large", f"{tmp_path}/small")
    assert at.endswith("small") and held.count() == model.count()
    with pytest.raises(FileNotFoundError):
        charlm.load(spark, f"{tmp_path}/large")


def test_fuzzy_matches_are_all_within_two_edits(spark):
    import random

    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(150)})

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    asked = [w for w in words[::5] if len(w) >= 3]
    d = suggest.dictionary(spark.createDataFrame([(w,) for w in words], "w string"), "w")
    got = {(r["input"], r["word"], r["distance"]) for r in suggest.fuzzy_matches(spark.createDataFrame([(w,) for w in asked], "input string"), d, most=10_000).collect()}
    assert got == {(a, b, edits(a, b)) for a in asked for b in words if edits(a, b) <= 2}


def test_calibration_tables_are_checked(spark):
    import pytest

    from tamarin.operators import ingest

    df = spark.createDataFrame([(0.97,)], "c double")
    fine = spark.createDataFrame([(f"{i / 100:.2f}", i / 1000) for i in range(100)], "bucket string, wer double")
    assert ingest.estimate_wer(df, "c", fine).first()["wer_estime"] == 0.09  # the bucket of its tenth, beyond the twelfth row
    with pytest.raises(ValueError):
        ingest.estimate_wer(df, "c", spark.range(2000).selectExpr("cast(id as string) as bucket", "0.0D as wer"))


def test_many_distinct_tokens(spark):
    from pyspark.sql import functions as F

    from tamarin.functions import metrics

    a = [f"w{i}" for i in range(40_000)]
    b = a[:10] + ["x"] + a[11:39_999] + ["y", "z"]
    df = spark.createDataFrame([(a[:60], b[:60]), (a[-300:] + a[:5], a[-300:])], "a array<string>, b array<string>")
    plain = [r[0] for r in df.select(metrics.token_distance(F.col("a"), F.col("b"))).collect()]
    old, metrics.PLAIN_CODES = metrics.PLAIN_CODES, 20
    try:
        assert [r[0] for r in df.select(metrics.token_distance(F.col("a"), F.col("b"))).collect()] == plain == [1, 5]
    finally:
        metrics.PLAIN_CODES = old


def test_figures_of_a_pass(spark):
    from pyspark.sql import functions as F

    from tamarin.functions import text as tx
    from tamarin.operators import ingest

    keys = spark.createDataFrame([(k,) for k in "abcdef"], "k string")
    some = lambda x: spark.createDataFrame([(k,) for k in x], "k string")
    r = ingest.progress(keys, some("ab"), some("bc"), "k", 6).first()
    assert (r["total"], r["done"], r["rejected"], r["left"], r["per_second"], r["eta_s"]) == (6, 2, 1, 3, 0.5, 6.0)
    r = ingest.progress(keys, some(""), some(""), "k", 6).first()
    assert r["per_second"] is None and r["eta_s"] is None and r["left"] == 6
    got = [x[0] for x in spark.createDataFrame([(0.0,), (69.9,), (3600.0,), (7500.0,)], "s double").select(tx.duration_label(F.col("s"))).collect()]
    assert got == ["0m00s", "1m09s", "1h00m", "2h05m"]
    none = spark.createDataFrame([], "c string")
    w = spark.createDataFrame([("a",), (None,)], "c string")
    assert tuple(ingest.witness_counts(w, none).first()) == (2, 0) and tuple(ingest.witness_counts(w, w).first()) == (1, 1)

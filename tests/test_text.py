import pytest
from pyspark.sql import functions as F

from tamarin.functions import text as m
from tamarin.functions.metrics import capped_cer, cer, corpus_rate, token_distance, wer, word_errors


def one(spark, f, *values, kind="string"):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} {kind}" for i in range(len(values))))
    return df.select(f(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


# fixed values: some inputs below are those that the expected results of the originals are stated for


@pytest.mark.parametrize(
    "given, want",
    [("  an   ka  manjé ", "an ka manjé"), ("an ka alé , wi !", "an ka alé, wi!"), ("l’ay ’", "l'ay '"), ("wi… é", "wi. é"), ("! !", "!!"), ("é", "é"), (None, ""), ("", ""), ("a b – c", "a b - c"), ("wi!!!??", "wi!?")],
)
def test_normalize_surface(spark, given, want):
    assert one(spark, m.normalize_surface, given) == want


def test_tokens(spark):
    assert one(spark, m.tokenize, "k'ay alé") == ["k'ay", "alé"]
    assert one(spark, m.tokenize, "alé, wi") == ["alé", ",", "wi"]
    assert one(spark, m.tokenize, None) == []


@pytest.mark.parametrize("given, want", [("manjé èvè ò", "manje eve o"), (None, None), ("Ç", "C")])
def test_strip_accents(spark, given, want):
    assert one(spark, m.strip_accents, given) == want


def test_alphabet(spark):
    for text in ("çé une question", "qui coûte", "un exemple"):
        assert not set(one(spark, m.enforce_alphabet, text)) & set("çqx")
    assert one(spark, m.enforce_alphabet, "naïve") == "naive"
    assert one(spark, m.enforce_alphabet, "chita") == "hita"
    assert one(spark, m.violations, "ou ch") == ["c", "u"]
    assert one(spark, m.violations, "an ka manjé adan kaz la") == []
    with pytest.raises(Exception, match="outside the alphabet"):
        one(spark, lambda c: m.enforce_alphabet(c, strict=True), "une kestion")


def test_case(spark):
    assert one(spark, m.match_case, "AP", "ka") == "KA" and one(spark, m.match_case, "Ap", "ka") == "Ka" and one(spark, m.match_case, "A", "ka") == "Ka"
    assert one(spark, m.match_case, "ap", "ka") == "ka"
    assert one(spark, m.casing_pattern, "BON", "bonjou") == "BONJOU" and one(spark, m.casing_pattern, "Bo", "bonjou") == "Bonjou" and one(spark, m.casing_pattern, "bOn", "bonjou") == "bOnjou"


def test_sentences_and_fingerprints(spark):
    assert one(spark, m.sentences, " An ka vini. Wi!  É ou? … bon ") == ["An ka vini.", "Wi!", "É ou?", "…", "bon"]
    assert one(spark, m.sentences, None) == []
    for native in (True, False):
        f = lambda c, n=native: m.fingerprint(c, n)
        assert one(spark, f, "An ka manjé, wi!") == one(spark, f, "an ka manje wi")
    df = spark.range(400).select(m.split_of(m.fingerprint(F.format_string("fraz nimewo %d", "id"))).alias("s")).groupBy("s").count().collect()
    n = {r["s"]: r["count"] for r in df}
    assert set(n) == {"train", "val", "test"} and 0.7 < n["train"] / 400 < 0.9


def test_small_scalars(spark):
    assert one(spark, m.duration_ms, "a_segment_68644_75377.mp3") == 6733 and one(spark, m.duration_ms, "a.mp3") == 0
    assert one(spark, m.clean_name, "Jan-Pòl <x>!") == "Jan-Pòlx" and one(spark, m.clean_name, "!!") == "anonyme" and one(spark, m.clean_name, None) == "anonyme"
    assert one(spark, m.local_name, "a/b.mp3") == "a__b.mp3" and one(spark, m.plain_text, "Wi, Mésié!") == "wi mésié"
    assert one(spark, lambda c: m.relative_key(c, "/data"), "/data/x/y.mp3") == "x/y.mp3"
    assert one(spark, m.iso_time, 1767226133654, kind="long") == "2026-01-01T00:08:53.654000+00:00" and one(spark, m.iso_time, 0, kind="long") == ""
    assert one(spark, lambda c: m.word_ngrams(F.split(c, " "), 2), "A b c") == ["a", "b", "c", "a b", "b c"]
    assert one(spark, m.compression_ratio, "a" * 1000) > 50 and one(spark, m.compression_ratio, "") == 0.0
    assert one(spark, m.fold, "Épòß") == "eposs" and one(spark, m.percent, 0.123, kind="double") == "12.3 %"


def test_error_rates(spark):
    d = lambda a, b: token_distance(F.split(a, " "), F.split(b, " "))
    assert one(spark, d, "an ka manjé diri la", "mwen ap manje diri a") == 4 and one(spark, d, "kay", "kaz") == 1
    assert one(spark, wer, "an ka manjé", "An Ka Manjé") == 0.0 and one(spark, wer, "an ka manjé", "") == 1.0
    assert one(spark, wer, "", "") == 0.0 and one(spark, wer, None, "wi") == 1.0
    assert one(spark, cer, "a", "bbbb") == 4.0 and one(spark, capped_cer, "a", "bbbb") == 1.0 and one(spark, capped_cer, "Wi!", "wi") == 0.0
    df = spark.createDataFrame([("a b c d e f g h", "a b c d e f g h"), ("x", "y")], "r string, h string").select(word_errors(F.col("r"), F.col("h")).alias("e"))
    assert abs(df.agg(corpus_rate(F.col("e.errors"), F.col("e.length")).alias("x")).first()["x"] - 1 / 9) < 1e-9

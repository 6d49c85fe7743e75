import pytest
from pyspark.sql import functions as F

from tamarin.llm import lookalike as m

SCHEMA = "segment_id string, whisper_ht string, corrected string, segment_a int"


def forms(spark, texts):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "k string, t string")
    return [r["t_canonical"] for r in m.canonical_forms(df, ["t"]).orderBy(F.col("k").cast("int")).collect()]


def test_same_look_same_form(spark):
    a = "Bwa-Doukolo, l'ékip jodi a"
    same = ["Ｂｗａ－Ｄｏｕｋｏｌｏ, l'ékip jodi a", "Bwa-Doukolo, l’ékip jodi a", "Bwа-Dоukolo, l'ékip jo​di a", "Bwa-Doukolo, l'éki­p jodⅰ a", a]
    assert set(forms(spark, same)) == {a}


def test_other_look_other_form(spark):
    apart = ["l'ékip", "l'èkip", "L'ékip", "l ékip", "m²", "m2", "1ᵉ", "1e", "«jodi»", '"jodi"']
    assert len(set(forms(spark, apart))) == len(apart)


def test_shapes_are_the_public_table(spark):
    shape = m.shapes(spark)
    # letters that a hand-made list would lack
    for other, latin in zip("ӏɑꓡᎪᏴⅭᴦաԜՍ", "laLABCrwWU"):
        assert shape.get(m.shown(other), m.shown(other)) == latin, other
    assert 250 < len(shape) < 600 and all(len(v) == 1 and v.isascii() for v in shape.values())
    assert set(forms(spark, ["lari", "ӏari", "lаri", "ꮮari"])[:3]) == {"lari"}
    assert len(set(forms(spark, ["tan-tan", "tan‐tan", "tan‑tan"]))) == 1 and len(set(forms(spark, ["tan-tan", "tan–tan"]))) == 2


def test_classes_need_no_pairs(spark):
    rows = [(f"{i:03d}", "lari" if i % 3 else "lаri", None, 0) for i in range(30)] + [("x", "kaz", None, 0), ("y", "kaz", None, 0)]
    out = m.look_alike_classes(spark.createDataFrame(rows, SCHEMA), "segment_id", ["whisper_ht", "corrected"]).collect()
    assert len(out) == 30 and {(r["spellings"], r["members"]) for r in out} == {(2, 30)} and len({r["class"] for r in out}) == 1


def test_script_follows_the_ngrams(spark):
    out = forms(spark, ["жизнь", "привет", "привет", "a ka manjé diri la", "а ka manjé diri la"])
    assert out[1] == out[2] == "привет" and out[3] == out[4] == "a ka manjé diri la"


def test_pairs_edge_cases(spark):
    rows = [("a", "té", None, 1), ("b", "té", "", 2), ("c", "té", "", 3), ("a", "té", None, 1), (None, "té", None, 4), ("d", None, None, 5)]
    out = m.look_alike_pairs(spark.createDataFrame(rows, SCHEMA), "segment_id", ["whisper_ht", "corrected"]).collect()
    assert {tuple(r) for r in out} == {("a", "b", "whisper_ht"), ("b", "c", "whisper_ht")}


def test_hot_class_meets_in_slices(spark):
    rows = [(f"{i:03d}", "lari" if i % 2 else "lаri", None, 0) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert m.look_alike_pairs(df, "segment_id", ["whisper_ht"], group=7).count() == 30 * 30


def test_empty_table_and_clash(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert m.look_alike_pairs(df, "segment_id", ["whisper_ht", "corrected"]).count() == 0
    with pytest.raises(ValueError):
        m.canonical_forms(df.withColumnRenamed("segment_a", "corrected_canonical"), ["corrected"])


def test_very_long_text(spark):
    long = "mòn la " * 20_000
    assert forms(spark, [long.replace("ò", "ò")]) == [long]

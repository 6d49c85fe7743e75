"""Queries that once cut their tables, on small tables of our own."""

import math
import os
from collections import Counter

import pytest

from tamarin import queries as m
from tests.test_queries import DATA, compare


def write(spark, at, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{at}/{name}.parquet")
    return str(at)


def test_calibration_of_all_confidences(spark, tmp_path):
    rows = [("a", 0.31, 0.5), ("b", 0.39, 0.4), ("c", 0.72, 0.2), ("d", 0.95, 0.02), ("e", 0.99, 0.0), ("f", 1.0, 0.0), ("g", None, 0.9), ("h", 0.55, None), ("i", 0.83, None), ("j", 0.6, None)]
    d = write(spark, tmp_path, "dataset_corrected", rows, "id string, confiance double, wer_estime double")
    assert {tuple(r) for r in m.wer_buckets(spark, d).collect()} == {("0.3", 0.45), ("0.7", 0.2), ("0.9", 0.01), ("1.0", 0.0)}
    near = {r["id"]: r["wer_estime"] for r in m.wer_nearest(spark, d).collect()}
    # 0.55 lies nearest to 0.7, 0.83 to 0.9, 0.6 to 0.7
    assert near == {"a": 0.45, "b": 0.45, "c": 0.2, "d": 0.01, "e": 0.01, "f": 0.0, "h": 0.2, "i": 0.01, "j": 0.2}


def test_alphabet_of_all_documents(spark, tmp_path):
    rows = [("a", "fr", "français"), ("b", "gcf", "quach"), ("c", " HT ", "physique"), ("d", None, "forêt"), ("e", "en", "taxi"), ("f", "", None)]
    d = write(spark, tmp_path, "documents", rows, "doc_id string, lang string, text string")
    assert {tuple(r) for r in m.alphabet_enforced(spark, d).collect()} == {("a", "fransais"), ("b", "kah"), ("c", "fysike"), ("d", "forèt"), ("e", "taksi"), ("f", None)}


def test_alphabet_by_sql_on_all_documents(spark):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    compare(spark, m.alphabet_enforced, f"select doc_id, {m._enforced('text')} as text from documents")


def test_language_model_of_order_five(spark, tmp_path):
    targets = ["an ka manjé diri la", "an ka manjé pen la", "i ka manjé diri", ""]
    seen = ["an ka manjé diri", "yo ka alé", ""]
    write(spark, tmp_path, "train_pairs", [(t,) for t in targets], "target_gcf string")
    d = write(spark, tmp_path, "val_pairs", [(str(i), t) for i, t in enumerate(seen)], "pair_id string, target_gcf string")
    framed = [f"^{t}$" for t in targets]
    counts = Counter((n, s[i : i + n]) for s in framed for n in range(1, 6) for i in range(len(s) - n + 1))
    assert {(r["n"], r["gram"]): r["cnt"] for r in m.charlm_counts(spark, d).collect()} == counts
    total = sum(map(len, framed))

    def prob(ctx, ch):
        for k in range(len(ctx), -1, -1):
            c = ctx[len(ctx) - k :]
            num, den = counts[k + 1, c + ch], counts[k, c] if k else total
            if num and den:
                return 0.4 ** (len(ctx) - k) * num / den
        return 1 / total

    got = {r["pair_id"]: r["log10_prob"] for r in m.charlm_perplexity(spark, d).collect()}
    for i, t in enumerate(seen):
        s = f"^{t}$"
        assert abs(got[str(i)] - sum(math.log10(prob(s[max(0, j - 4) : j], s[j])) for j in range(1, len(s)))) < 2e-5


def test_correction_pass_uses_order_five(spark, monkeypatch):
    used = {}
    monkeypatch.setattr(m, "durable", lambda df, name: df)
    monkeypatch.setattr(m.correct, "correct", lambda df, key, text, corrector, model, calibration, order=5: used.update(order=order, model=model) or df)
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    m.corrected_segments(spark, DATA)
    assert used["order"] == 5 and used["model"].agg({"n": "max"}).first()[0] == 5

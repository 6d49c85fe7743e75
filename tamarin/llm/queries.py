"""The problems' queries over the project's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarin.llm import language, leakage, ledger, lookalike, packing, ranking, repetition, spanish, splits, subjects
from tamarin.plans.durable import scratch, spread


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work on texts that is worth all cores: a small table is dealt out to them."""
    return spread(_table(spark, sf_dir, name).select(*columns))


def p1_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both fields of every row in their consistent form."""
    df = _texts(spark, sf_dir, "diagnostic_to_correct", "segment_id", "whisper_ht", "corrected")
    return lookalike.canonical_forms(df, ["whisper_ht", "corrected"])


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookalike.look_alike_pairs(_texts(spark, sf_dir, "diagnostic_to_correct", "segment_id", "whisper_ht", "corrected"), "segment_id", ["whisper_ht", "corrected"])


def p1_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value that looks like a differently spelled one, with its class; no pairs."""
    return lookalike.look_alike_classes(_texts(spark, sf_dir, "diagnostic_to_correct", "segment_id", "whisper_ht", "corrected"), "segment_id", ["whisper_ht", "corrected"])


SCORES = {"avg_logprob": True, "compression_ratio": False, "perplexite_lm": False, "no_speech_prob": False}


def p2_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All segments, best first by ``place``."""
    out = ranking.aggregate_ranks(_table(spark, sf_dir, "dataset_corrected"), "id", SCORES)
    return out.select("id", "n_scores", F.round("rho", 6).alias("rho"), "place")


def _splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_records({s: _table(spark, sf_dir, f"{s}_pairs") for s in ("train", "val", "test")}, "pair_id", "target_gcf", "corpus")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = splits.overlaps(_splits(spark, sf_dir))
    return pairs.select(F.least("eval_key", "train_key").alias("pair_a"), F.greatest("eval_key", "train_key").alias("pair_b")).distinct()


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps per split and corpus."""
    return splits.overlap_report(_splits(spark, sf_dir))


RATE = 0.1


def p4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the paths, in two generations against a persisted ledger: those of ``lot-b`` as the table's earlier state, then all.
    What the first one selected stays in, and the quota grows with the table."""
    df, path = _table(spark, sf_dir, "segment_index"), scratch(spark, "ledger")
    ledger.grow_sample(df.where(F.col("c").contains("/lot-b/")), "c", path, rate=RATE, seed="segments")
    return ledger.grow_sample(df, "c", path, rate=RATE, seed="segments").select("c", "priority")


def p4_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two generations of exact size: one in twenty of the paths of ``lot-b``, then one in twenty of all paths."""
    df, path = _table(spark, sf_dir, "segment_index"), scratch(spark, "ledger")
    for part in (df.where(F.col("c").contains("/lot-b/")), df):
        total = part.agg(F.count_distinct("c")).first()[0] // 20
        out = ledger.grow_sample(part, "c", path, total=total, seed="segments")
    return out.select("c", "generation")


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``segment_index`` with stretches, labelled by the example and held-out texts, and by general text for Spanish, which no table labels."""
    df = _table(spark, sf_dir, "segment_index")
    given = _table(spark, sf_dir, "subject_examples").select("lang", "text").unionByName(_table(spark, sf_dir, "heldout_items").select("lang", "text"))
    texts = language.labelled_text(given.withColumn("lang", F.lower(F.trim("lang"))), spanish.GENERAL, df.select(F.col("t").alias("text")))
    return language.language_stretches(df.select("c", "t", "m").distinct(), "t", texts)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    reads = F.regexp_replace(F.lower(F.translate("m", "Çç\u0327", "cc")), r"[^a-z]", "")
    says = F.when(reads == "francais", F.array(F.lit("fr"))).when(F.col("m") == "", F.array(F.lit("gcf"), F.lit("ht")))
    return language.misstated(_languages(spark, sf_dir), "c", "m", says)


def p5_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every one-language stretch of every segment with its confidence."""
    df = _languages(spark, sf_dir).select("c", "t", F.posexplode("stretches").alias("stretch", "s"))
    return df.select("c", "t", "stretch", "s.lang", F.col("s.first").alias("first_word"), F.col("s.words").alias("n_words"), F.round("s.confidence", 4).alias("confidence")).distinct()


def p6_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of repeated content of every segment."""
    df = repetition.repetition(_texts(spark, sf_dir, "dataset_corrected", "id", "whisper_ht"), "id", "whisper_ht")
    return df.select("id", "n_words", "repeats", F.round("repeat_share", 6).alias("repeat_share")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "dataset_corrected", "id", "whisper_ht")
    return repetition.repetitive(df, "id", "whisper_ht", repetition.fit(df, "id", "whisper_ht"))


def p7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their containers."""
    return packing.pack(packing.token_counts(_texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text"), "doc_id")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked_items(_texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", _table(spark, sf_dir, "heldout_items"), "item_id", "text")


def _subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.document_subjects(_texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text", _table(spark, sf_dir, "subject_examples"), "subject", "lang", "text")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _subjects(spark, sf_dir).where(F.col("doc_id").isNotNull())
    return df.select("doc_id", F.explode("subjects").alias("subject")).distinct()


def p9_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the subjects it treats, several, one or none."""
    return _subjects(spark, sf_dir).select("doc_id", "n_sentences", "subjects")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_canonical": p1_canonical,
    "p1_classes": p1_classes,
    "p2_ranking": p2_ranking,
    "p3_found": p3_found,
    "p3_report": p3_report,
    "p4_sample": p4_sample,
    "p4_growth": p4_growth,
    "p5_found": p5_found,
    "p5_stretches": p5_stretches,
    "p6_found": p6_found,
    "p6_share": p6_share,
    "p7_pack": p7_pack,
    "p8_found": p8_found,
    "p9_found": p9_found,
    "p9_subjects": p9_subjects,
}

_RANKS = """with d as (select distinct id, -avg_logprob as a, compression_ratio as b, perplexite_lm as c, no_speech_prob as e from dataset_corrected),
r as (select id, a, b, c, e,
 list_filter([{good}], lambda x: x is not null) as good, list_filter([{bad}], lambda x: x is not null) as bad from d),
t as (select *, len(good) as m, list_sort(good) as g, list_sort(bad) as h from r),
s as (select *, least(1.0, {rg}) as rho, least(1.0, {rb}) as rho_bad from t where m > 0),
k as (select *, round(case when rho < 1 then ln(rho) else -ln(rho_bad) end, 9) as key from s)
select id, m::int as n_scores, round(rho, 6) as rho, rank() over (order by key) as place from k union all select id, 0, null, null from t where m = 0"""


def _rank_sql() -> str:
    share = "case when {c} is not null then (count({c}) over (order by {c} {d} range between unbounded preceding and current row) - (count({c}) over (partition by {c}) - 1) / 2) / count({c}) over () end"
    choose = ((1, 1), (1, 2, 1), (1, 3, 3, 1), (1, 4, 6, 4, 1))

    def tail(r: str, m: int) -> str:
        ks = range(1, m + 1)
        tails = ", ".join(" + ".join(f"{choose[m - 1][j]} * pow({r}[{k}], {j}) * pow(1 - {r}[{k}], {m - j})" for j in range(k, m + 1)) for k in ks)
        return f"least({tails}) * {len(ks)}" if len(ks) > 1 else f"({tails})"

    by = lambda r: "case m " + " ".join(f"when {m} then {tail(r, m)}" for m in range(1, 5)) + " end"
    return _RANKS.format(good=", ".join(share.format(c=c, d="asc nulls last") for c in "abce"), bad=", ".join(share.format(c=c, d="desc nulls last") for c in "abce"), rg=by("g"), rb=by("h"))


_BITS = "('0x' || substr(md5('segments:' || c), 1, 13))::bigint"
_WORDS = "regexp_extract_all(strip_accents(lower(regexp_replace(coalesce(whisper_ht, ''), '[\\x{ad}\\x{34f}\\x{200b}-\\x{200f}\\x{2060}\\x{feff}]', '', 'g'))), '[\\p{L}\\p{N}]+')"
_REPEATS = f"""with w as (select distinct id, {_WORDS} as w from dataset_corrected),
t as (select id, w, len(w) as n, list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) as t from w),
s as (select id, w, n, list_transform(range(1, len(t) + 1), lambda i: list_position(t, t[i]) < i) as again from t),
r as (select id, n, len(list_filter(range(1, n + 1), lambda i: coalesce(again[i], false) or (i > 1 and coalesce(again[i - 1], false)) or (i > 2 and coalesce(again[i - 2], false)) or (i > 1 and w[i] = w[i - 1]))) as repeats from s)"""

#: Edit distance of two lists.
_EDITS = (
    "list_reduce(range(1, len(a) + 1), lambda prev, i: list_reduce(range(1, len(b) + 1), "
    "lambda acc, j: list_append(acc, least(prev[j + 1] + 1, acc[-1] + 1, prev[j] + if(a[i] = b[j], 0, 1))), [i]), range(0, len(b) + 1))[-1]"
)
_SPLIT_WORDS = "list_distinct(w) as d, w from (select pair_id, " + _WORDS.replace("whisper_ht", "target_gcf") + " as w from @) where len(w) > 0"
#: All pairs of records, those left out first that differ in length or in words by more than the budget.
_OVERLAPS = f"""with e as (select pair_id, {_SPLIT_WORDS.replace("@", "(select * from val_pairs union all select * from test_pairs)")}), t as (select pair_id, {_SPLIT_WORDS.replace("@", "train_pairs")}),
n as (select e.pair_id as x, t.pair_id as y, e.w as a, t.w as b, greatest(len(e.w), len(t.w)) // 5 as most from e join t on abs(len(e.w) - len(t.w)) <= greatest(len(e.w), len(t.w)) // 5
 and len(e.d) - len(list_intersect(e.d, t.d)) <= greatest(len(e.w), len(t.w)) // 5),
f as (select distinct x, y from n where {_EDITS} <= most)"""

ORACLES: dict[str, str] = {
    "p3_found": _OVERLAPS + " select least(x, y) as pair_a, greatest(x, y) as pair_b from f",
    "p2_ranking": _rank_sql(),
    "p4_sample": f"select c, {_BITS} / 4503599627370496.0 as priority from (select distinct c from segment_index where c is not null) where {_BITS} < floor(0.1 * 4503599627370496)",
    "p4_growth": f"""with k as (select c, {_BITS} as b from (select distinct c from segment_index where c is not null)), r as (select *, row_number() over (order by b, c) as n from k where contains(c, '/lot-b/')),
one as (select c from r where n <= (select count(*) // 20 from k where contains(c, '/lot-b/'))), s as (select c, row_number() over (order by b, c) as n from k where c not in (select c from one))
select c, 0 as generation from one union all select c, 1 from s where n <= (select count(*) // 20 from k) - (select count(*) from one)""",
    "p6_share": _REPEATS + " select id, n::int as n_words, repeats::int as repeats, round(case when n > 0 then repeats / n else 0 end, 6) as repeat_share from r",
    "p6_found": _REPEATS + " select distinct id from r where n >= 6 and repeats * 10 >= n * 3",
}

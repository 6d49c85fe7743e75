"""Queries that write and read every source and sink, and the small figures of the pipeline, each with its SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarin.functions import text as tx
from tamarin.operators import annotations as an
from tamarin.operators import ingest, nbest, pairs, rules, suggest
from tamarin.plans import correct
from tamarin.plans.durable import scratch
from tamarin.queries import ORACLES as CORE
from tamarin.queries import _ASKED, _DICT, _SEG, _VERSIONS, _dictionary, _filled, _inputs, _lit, _log, _norm, _sentences_sql, _split, _table, _tokens, nbest_agreement, registry, sentence_dedup
from tamarin.sources import readers, writers

QUERIES, ORACLES, _query = registry()


# ---- round trips ---------------------------------------------------------------------------------------------------------------


@_query("select c, t, m, d from segment_index where c is not null")
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index as sorted JSON lines and back; nulls and repeated rows stay."""
    path = scratch(spark, "index")
    writers.sorted_json_lines(_table(spark, sf_dir, "segment_index", "c", "t", "m", "d").where("c is not null"), path, "c", "t")
    return readers.json_lines(spark, path, "c string, t string, m string, d bigint")


@_query("select count(*) as written, count(*) as read from segment_index")
def jsonl_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows counted while they are written, and rows read."""
    path = scratch(spark, "lines")
    n = writers.json_lines(_table(spark, sf_dir, "segment_index", "c", "t", "m", "d"), path)
    return readers.json_lines(spark, path, "c string").agg(F.lit(n).cast("long").alias("written"), F.count("*").alias("read"))


@_query(
    """with a as (select c, max(coalesce(t, '')) as t from segment_index where c is not null group by 1), b as (select c, max(coalesce(ref, '')) as t from temoins where c is not null group by 1)
select c, coalesce(b.t, a.t) as t from a full outer join b using (c)"""
)
def tolerant_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files with marks, blank and broken lines, read by key: the later file's line wins."""
    path = scratch(spark, "tolerant")
    parts = (("a", "segment_index", "t"), ("b", "temoins", "ref"))
    for name, table, text in parts:
        best = _table(spark, sf_dir, table, "c", text).where("c is not null").groupBy("c").agg(F.max(F.coalesce(text, F.lit(""))).alias("t"))
        junk = spark.createDataFrame([("",), ('{"c": "cut off',), ("﻿  ",), ("null",)], "value string")
        best.select(F.concat(F.lit("﻿"), F.to_json(F.struct("c", "t"))).alias("value")).unionByName(junk).write.text(f"{path}/{name}")
    return readers.tolerant_json_lines(spark, f"{path}/*", "c string, t string", "c")


@_query("select count(*) as segments, count_if(filtre_passe) as kept, round(avg(wer_estime), 4) as wer_estime from dataset_corrected")
def json_object_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics as one JSON object and back."""
    path = scratch(spark, "object") + "/stats.json"
    df = _table(spark, sf_dir, "dataset_corrected", "filtre_passe", "wer_estime")
    writers.json_object(df.agg(F.count("*").alias("segments"), F.count_if("filtre_passe").alias("kept"), F.round(F.avg("wer_estime"), 4).alias("wer_estime")), path)
    return readers.json_object(spark, path).select("segments", "kept", "wer_estime")


_SIDES = f"(select {_norm('whisper_ht')} as src, {_norm('corrected')} as tgt from diagnostic_to_correct)"


def _sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "sheet")
    writers.sheet(_table(spark, sf_dir, "diagnostic_to_correct"), path, crlf=True)
    return readers.sheet(spark, path)


@_query(f"select src, tgt from {_SIDES} where src <> '' and tgt <> ''")
def corrected_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diagnostic sheet as CSV and back, as pairs."""
    return readers.corrected_pairs(_sheet(spark, sf_dir))


@_query(f"select count_if(src <> '' and tgt <> '') as kept, count_if(src = '' or tgt = '') as skipped from {_SIDES}")
def corrected_sheet_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.skipped_pairs(_sheet(spark, sf_dir))


_SPLITS = ("train", "val", "test")


@_query(" union all ".join(f"select '{n}' as split, source_pseudo_ht as source, target_gcf as target from {n}_pairs" for n in _SPLITS))
def pairs_by_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of all splits, one CSV folder each, and back."""
    path, every = scratch(spark, "pairs"), None
    for n in _SPLITS:
        one = _table(spark, sf_dir, f"{n}_pairs", "source_pseudo_ht", "target_gcf").select(F.lit(n).alias("split"), F.col("source_pseudo_ht").alias("source"), F.col("target_gcf").alias("target"))
        every = one if every is None else every.unionByName(one)
    writers.split_sheets(every, path)
    return readers.sheet(spark, path).select("split", "source", "target")


@_query('select id, annotateur, corrected, notes, skipped, note, vote, jalons[\'ouvert\'] as ouvert, ecoute_ms, lectures, duree, "at" from corrections')
def corrections_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The correction log as one folder of JSON lines per annotator and back."""
    path = scratch(spark, "corrections")
    writers.annotator_partitions(_table(spark, sf_dir, "corrections"), path)
    df = readers.corrections(spark, path)
    return df.select("id", "annotateur", "corrected", "notes", "skipped", "note", "vote", F.element_at("jalons", "ouvert").alias("ouvert"), "ecoute_ms", "lectures", "duree", "at")


@_query(f"select distinct lower(w) as word from (select unnest({_tokens(_norm('text'))}) as w from heldout_items) where regexp_matches(w, '^\\p{{L}}{{2,}}$')")
def lexicon_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the held-out texts, a fixed table, as a lexicon file and back."""
    path = scratch(spark, "lexicon") + "/lexicon.json"
    words = [[r["word"], r["freq"]] for r in _dictionary(spark, sf_dir, "heldout_items", "text").collect()]
    writers.write_text_file(spark, path, json.dumps(words, ensure_ascii=False))
    return readers.lexicon(spark, path)


_SEEDS = [(s, t, "word", len(s.split())) for s, t in rules.SEED_WORDS] + [(s, t, "regex", 1) for s, t in rules.SEED_PATTERNS]


@_query("select * from (values " + ", ".join(f"({_lit(s)}, {_lit(t)}, '{k}', {n}, 'seed')" for s, t, k, n in _SEEDS) + ") as v(src, tgt, kind, ngram, status)")
def rules_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The starting rules as a rule file and back."""
    path = scratch(spark, "rules") + "/rules.json"
    writers.rules_file(rules.seed_rules(spark), path)
    return readers.rules_file(spark, path).select("src", "tgt", "kind", "ngram", "status")


@_query(_DICT + " select word, freq, folded from d")
def dictionary_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dictionary(spark, sf_dir, "train_pairs", "target_gcf").select("word", "freq", "folded")


_LOT = "(select c, replace(c, '/', '__') as f, t, m, d from (select distinct c, t, m, d from segment_index) where m in ('hallucination', 'français', 'vide') and d > 0 and d <= 25000 order by md5('lot|' || c), c limit 100)"


def _lot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.lot(_table(spark, sf_dir, "segment_index").distinct(), ["hallucination", "français", "vide"], 100, "lot")


@_query(f"select c, f, coalesce(t, '') as t, m, d from {_LOT}")
def lot_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lot's manifest as a JSON object and its segments back."""
    path = scratch(spark, "lot") + "/lot.json"
    writers.json_object(ingest.manifest(_lot(spark, sf_dir), "lot", "corpus", 32_000), path)
    return readers.lot_segments(spark, path).select("c", "f", F.coalesce("t", F.lit("")).alias("t"), "m", "d")


@_query(f"select 'lot' as lot, count(*) as segments, round(coalesce(sum(d), 0) / 60000, 1) as minutes, (select coalesce(sum(length(c)), 0) from {_LOT})::bigint as octets from {_LOT}")
def lot_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lot's line in the listing; the length of the path stands in for the file's, which no table holds."""
    return ingest.lot_listing(_lot(spark, sf_dir), "lot", _table(spark, sf_dir, "segment_index", "c").distinct().select("c", F.length("c").alias("length")))


@_query("select count(*) as rows, count_if(label) as labelled from (select m is not null and m <> '' as label, coalesce(t, '') as t from segment_index)")
def detected_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan whose text column is found by name: with a usual name it is that one, else the first column that is no audio."""
    df = _table(spark, sf_dir, "segment_index").select(F.col("c").alias("path"), F.col("m").alias("Transcription"), "t")
    name = readers.text_column(df.columns)
    return df.select(F.col(name).alias("x")).agg(F.count("*").alias("rows"), F.count_if(F.col("x").isNotNull() & (F.col("x") != "")).alias("labelled"))


# ---- sheets and figures --------------------------------------------------------------------------------------------------------


@_query(
    """select id, audio, whisper_ht, gcf_corrige, confiance, wer_estime, '' as verite_terrain, '' as verdict from (select distinct id, audio, whisper_ht, gcf_corrige, confiance, wer_estime from dataset_corrected where confiance >= 0.6 and wer_estime <= 0.3)
order by md5('audit|' || id), id limit 100"""
)
def audit_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-confidence segments for people to check."""
    cols = ("id", "audio", "whisper_ht", "gcf_corrige", "confiance", "wer_estime")
    return ingest.audit_sheet(correct.high_confidence(_table(spark, sf_dir, "dataset_corrected", *cols), 0.6, 0.3).distinct(), 100, "audit")


def _js_iso(x: str) -> str:
    return f"coalesce(case when {x} = 0 then '' else strftime(make_timestamp({x} * 1000), '%Y-%m-%dT%H:%M:%S') || '.' || lpad(({x} % 1000)::varchar, 3, '0') || 'Z' end, '')"


@_query(
    _VERSIONS
    + f""" select v.id as segment_id, coalesce(s.t, '') as whisper, coalesce(s.m, '') as motif, coalesce(s.d, 0) as duree_ms, coalesce(corrected, '') as corrected, coalesce(notes, '') as notes, annotateur,
 case when coalesce(note, 0) <> 0 then note::varchar else '' end as rating, case when note = 5 then 'human_validated' when note = 1 then 'unusable' when coalesce(note, 0) <> 0 then 'human_reviewed' when {_filled('corrected')} then 'draft' else '' end as status,
 case when vote then '1' else '' end as vote, coalesce(ecoute_ms, 0) as ecoute_ms, coalesce(lectures, 0) as lectures, {', '.join(f"{_js_iso(f'jalons[{_lit(k)}]')} as {k}_a" for k in an.MILESTONES)}
 from last v left join {_SEG} i on i.c = v.id where {_filled('corrected')} or coalesce(skipped, false) or coalesce(note, 0) <> 0"""
)
def client_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The page's export: one row per worked segment and annotator, no version column."""
    return an.client_export(_log(spark, sf_dir), _table(spark, sf_dir, "segment_index"))


@_query("select count(*) as total, count_if(done) as done, count_if(rej and not done) as rejected, count_if(not rej and not done) as left, round(count_if(rej or done) / 600.0, 3) as per_second, round(count_if(not rej and not done) / (count_if(rej or done) / 600.0), 1) as eta_s from (select c, c in (select audio from dataset_corrected where audio is not null) as done, bool_or(coalesce(m, '') in ('hallucination', 'vide', 'rejet')) as rej from segment_index where c is not null group by 1)")
def pass_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far a pass of ten minutes has come."""
    index = _table(spark, sf_dir, "segment_index", "c", "m").where("c is not null")
    done = _table(spark, sf_dir, "dataset_corrected", "audio").select(F.col("audio").alias("c"))
    return ingest.progress(index, done, index.where("m in ('hallucination', 'vide', 'rejet')"), "c", 600)


@_query("select distinct audio from dataset_corrected where audio in (select c from segment_index where c is not null)")
def known_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.known_paths(_table(spark, sf_dir, "dataset_corrected", "audio").distinct(), "audio", _table(spark, sf_dir, "segment_index", "c"))


@_query("select count_if(c in (select c from segment_index where c is not null)) as known, count_if(c is null or c not in (select c from segment_index where c is not null)) as outside from temoins")
def witness_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.witness_counts(_table(spark, sf_dir, "temoins"), _table(spark, sf_dir, "segment_index", "c"))


@_query("with f as (select distinct c, t, m, d from segment_index where m = 'français') select *, (select count(*) from f) as total from f order by c, t nulls first, m, d nulls first limit 20 offset 10")
def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.page_with_total(ingest.search(_table(spark, sf_dir, "segment_index").distinct(), label="français"), 10, 20)


@_query(_sentences_sql() + f" select {_split('fp')} as split, count(*) as pairs, sum(len({_tokens(_norm('sentence'))}))::bigint as tokens, sum(length(sentence))::bigint as characters from first group by 1")
def split_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs, tokens and characters of each split."""
    return pairs.split_statistics(pairs.with_split(sentence_dedup(spark, sf_dir)), "sentence")


@_query(
    f"""select count(*) as recordings, count_if(n_hypotheses > 1) as several, count_if(kept) as kept, round(avg(case when n_hypotheses > 1 then accord end), 4) as mean_agreement, round(avg(case when kept then accord end), 4) as mean_agreement_kept
from ({CORE['nbest_agreement']})"""
)
def pseudo_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What pseudo-labelling kept, and its mean agreement."""
    return nbest.pseudo_statistics(nbest_agreement(spark, sf_dir))


@_query(
    """select id, annotateur, greatest(0, least(5, coalesce(note, 0))) as note, list_sort(list_filter(map_keys(jalons), lambda k: regexp_matches(k, '^\\p{L}+$') and jalons[k] >= 0)) as jalons from corrections where id in (select c from segment_index where c is not null)"""
)
def guarded_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as the guard lets it through, with the names of its milestones."""
    df = an.guard_events(_table(spark, sf_dir, "corrections", "id", "annotateur", "note", "jalons"), _table(spark, sf_dir, "segment_index", "c"))
    return df.select("id", "annotateur", "note", F.array_sort(F.map_keys("jalons")).alias("jalons"))


@_query(
    f"""select distinct coalesce(nullif(left(regexp_replace(annotateur, '[^\\p{{L}}\\p{{N}}_-]', '', 'g'), 40), ''), 'anonyme') as name, array_to_string({_tokens(_norm('corrected'))}, ' ') as joined from corrections"""
)
def cleaned_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of annotators, and corrections as their tokens joined."""
    df = _table(spark, sf_dir, "corrections", "annotateur", "corrected")
    return df.select(tx.clean_name(F.col("annotateur")).alias("name"), F.array_join(tx.tokenize(F.col("corrected")), " ").alias("joined")).distinct()


@_query(_DICT + ", " + _ASKED + """, f as (select input, word, freq, levenshtein(a, folded) as distance from q join d on abs(length(folded) - length(a)) <= 2 where length(input) >= 3)
select distance, count(*) as pairs from f where distance <= 2 group by 1""")
def fuzzy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of an asked word and a dictionary word within two edits, by distance: none is cut by a rank."""
    df = suggest.fuzzy_matches(_inputs(spark, sf_dir), _dictionary(spark, sf_dir, "train_pairs", "target_gcf"), most=2_000_000_000)
    return df.groupBy(F.col("distance").cast("long").alias("distance")).agg(F.count("*").alias("pairs"))


# ---- alignment -----------------------------------------------------------------------------------------------------------------

#: Longest matching blocks, the earliest of the longest first, then left and right of each; what lies between them differs.
_BLOCKS = f"""with recursive p as (select row_number() over () as id, src, tgt, {_tokens('src')} as s, {_tokens('tgt')} as t from (select distinct src, tgt from {_SIDES} where src <> '' and tgt <> '')),
m as (select id, i, j from (select id, list_transform(s, lambda x: lower(x)) as a, list_transform(t, lambda x: lower(x)) as b from p), unnest(range(1, len(a) + 1)) as u(i), unnest(range(1, len(b) + 1)) as v(j) where a[i] = b[j]),
g as (select *, i - row_number() over (partition by id, i - j order by i) as island from m),
f as (select id, i, j, max(i) over (partition by id, i - j, island) - i + 1 as ahead from g),
block as (
 select id, alo, ahi, blo, bhi, x.i as i, x.j as j, x.k as k from (select id, 1::bigint as alo, (len(s) + 1)::bigint as ahi, 1::bigint as blo, (len(t) + 1)::bigint as bhi, arg_max(struct_pack(i := i, j := j, k := ahead), ahead * 1000000000000 - i * 1000000 - j) as x from p join f using (id) group by id, s, t)
 union all
 select id, lo, hi, lo2, hi2, x.i, x.j, x.k from (
  select c.id, lo, hi, lo2, hi2, arg_max(struct_pack(i := f.i, j := f.j, k := least(ahead, hi - f.i, hi2 - f.j)), least(ahead, hi - f.i, hi2 - f.j) * 1000000000000 - f.i * 1000000 - f.j) as x
  from (select id, alo as lo, i as hi, blo as lo2, j as hi2 from block where alo < i and blo < j union all select id, i + k, ahi, j + k, bhi from block where i + k < ahi and j + k < bhi) c
  join f on f.id = c.id and f.i >= lo and f.i < hi and f.j >= lo2 and f.j < hi2 group by all)),
e as (select id, i, j, k from block union all select id, len(s) + 1, len(t) + 1, 0 from p),
d as (select id, coalesce(lag(i + k) over w, 1) as a0, i as a1, coalesce(lag(j + k) over w, 1) as b0, j as b1 from e window w as (partition by id order by i, j)),
o as (select src, tgt, case when a0 < a1 and b0 < b1 then 'replace' when a0 < a1 then 'delete' else 'insert' end as op, (a0 - 1)::int as first, array_to_string(s[a0:a1 - 1], ' ') as before, array_to_string(t[b0:b1 - 1], ' ') as after, (a1 - a0)::int as words, (b1 - b0)::int as others
 from d join p using (id) where a0 < a1 or b0 < b1)"""


def _differing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tamarin.queries import _pairs

    df = _pairs(spark, sf_dir).select("src", "tgt").distinct()
    blocks = df.select("src", "tgt", F.explode(rules.align_words(tx.tokenize(F.col("src")), tx.tokenize(F.col("tgt")))).alias("x")).where("x.op <> 'equal'")
    return blocks.select("src", "tgt", "x.op", F.col("x.start").alias("first"), F.array_join("x.src", " ").alias("before"), F.array_join("x.tgt", " ").alias("after"), F.size("x.src").alias("words"), F.size("x.tgt").alias("others"))


@_query(_BLOCKS + " select * from o")
def aligned_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the corrected sheet's sides differ, by longest matching blocks."""
    return _differing(spark, sf_dir)


@_query(_BLOCKS + " select lower(before) as before, lower(after) as after, count(*) as n from o where words between 1 and 3 and others <= 3 group by 1, 2 having count(*) >= 2")
def block_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each short block stands for another: what the supports of mined rules begin from."""
    df = _differing(spark, sf_dir).where("words between 1 and 3 and others <= 3")
    return df.groupBy(F.lower("before").alias("before"), F.lower("after").alias("after")).agg(F.count("*").alias("n")).where("n >= 2")


@_query(
    f"""with s as (select list_transform({_tokens('src')}, lambda x: lower(x)) as w from (select distinct src, tgt from {_SIDES} where src <> '' and tgt <> '')),
g as (select unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as gram from s, (values (1), (2), (3)) as v(n) where len(w) >= n)
select gram, count(*) as total from g group by 1"""
)
def rule_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source n-gram stands in the corrected sheet: the denominators of mined rules."""
    from tamarin.queries import _pairs

    df = _pairs(spark, sf_dir).select("src", "tgt").distinct().select(F.explode(tx.word_ngrams(tx.tokenize(F.col("src")), 3)).alias("gram"))
    return df.groupBy("gram").agg(F.count("*").alias("total"))

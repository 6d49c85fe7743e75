"""The core's queries over the project's tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarin.functions import scores
from tamarin.functions import text as tx
from tamarin.functions.metrics import capped_cer, char_errors, corpus_rate, word_errors
from tamarin.operators import annotations as an
from tamarin.operators import charlm, evaluate, gate, ingest, nbest, pairs, rules, suggest
from tamarin.plans import correct
from tamarin.plans.durable import durable, scratch, spread
from tamarin.sources import readers

def registry():
    """Two tables, of queries and of their SQL, and a decorator that registers a function in them under its name."""
    queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql is not None:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, query


QUERIES, ORACLES, _query = registry()


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return readers.table(spark, f"{sf_dir}/{name}.parquet", list(columns) or None)


def _texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The same for work on texts that is worth all cores."""
    return spread(_table(spark, sf_dir, name, *columns))


# ---- SQL fragments -------------------------------------------------------------------------------------------------------------

_SP = tx.SPACE


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_SP}+', ' ', 'g'))"


def _norm(x: str, lower: bool = False) -> str:
    t = f"replace(translate(nfc_normalize(coalesce({x}, '')), {_lit(tx.SURFACE_FROM)}, {_lit(tx.SURFACE_TO)}), '…', '...')"
    for p in ",.;:!?":
        t = f"regexp_replace({t}, '[{p}]{{2,}}', '{p}', 'g')"
    t = _squeeze(f"regexp_replace({t}, '{_SP}+([,.;:!?%])', '\\1', 'g')")
    return f"lower({t})" if lower else t


def _tokens(normal: str) -> str:
    return f"regexp_extract_all({normal}, {_lit(tx.TOKEN)}, 1)"


def _low_tokens(x: str) -> str:
    return _tokens(_norm(_norm(x, True)))


def _plain(x: str) -> str:
    return _squeeze(f"regexp_replace(lower(coalesce({x}, '')), '\\p{{P}}', ' ', 'g')")


def _filled(x: str) -> str:
    blank = f"coalesce({x}, '')"
    return f"(length({_squeeze(blank)}) > 0)"


def _bytes1(x: str) -> str:
    """Lower-case text with each accented letter as one capital, so that a byte distance counts characters."""
    return f"translate({x}, 'éèòàùâêîôûëïüçöœáíóúñ…«»', 'ABCDEFGHIJKLMNOPQRSTUVXYZ')"


#: Edit distance of two lists.
_DP = (
    "list_reduce(range(1, len({a}) + 1), lambda prev, i: list_reduce(range(1, len({b}) + 1), "
    "lambda acc, j: list_append(acc, least(prev[j + 1] + 1, acc[-1] + 1, prev[j] + if({a}[i] = {b}[j], 0, 1))), [i]), range(0, len({b}) + 1))[-1]"
)


def _distance(a: str, b: str) -> str:
    return _DP.format(a=a, b=b)


def _words_sql(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(map(_lit, words)) + "]"


_T = f"regexp_replace(coalesce(text, ''), '^{_SP}+|{_SP}+$', '', 'g')"
_GATE = f"""case when @T = '' then null when regexp_matches(@T, {_lit("(?i)" + "|".join(gate.HALLUCINATIONS))}) then 'hallucination'
  when len(@W) >= 3 and len(list_filter(@W, lambda x: list_contains({_words_sql(gate.FRENCH)}, x))) > len(list_filter(@W, lambda x: list_contains({_words_sql(gate.CREOLE)}, translate(x, {_lit(gate.ACCENTED)}, {_lit(gate.PLAIN)})))) then 'français' end"""


def _gate(x: str) -> str:
    t = f"regexp_replace(coalesce({x}, ''), '^{_SP}+|{_SP}+$', '', 'g')"
    return _GATE.replace("@W", f"regexp_extract_all(lower({t}), {_lit(gate.WORD)}, 1)").replace("@T", t)


# ---- text ----------------------------------------------------------------------------------------------------------------------


@_query(f"select lower(trim(lang)) as lang, coalesce({_gate('text')}, '') as reason, count(*) as n from documents group by all")
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by language label and reason of rejection."""
    df = _texts(spark, sf_dir, "documents", "lang", "text")
    return df.groupBy(F.lower(F.trim("lang")).alias("lang"), F.coalesce(gate.rejection(F.col("text")), F.lit("")).alias("reason")).agg(F.count("*").alias("n"))


@_query(f"select distinct c, {_norm('t')} as t from segment_index")
def normalize_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "segment_index", "c", "t")
    return df.select("c", tx.normalize_surface(F.col("t")).alias("t")).distinct()


@_query(f"select token, count(*) as n from (select unnest({_tokens(_norm('target_gcf'))}) as token from train_pairs) group by 1 order by n desc, token limit 50")
def token_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "train_pairs", "target_gcf").select(F.explode(tx.tokenize(F.col("target_gcf"))).alias("token"))
    return df.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(50)


@_query(f"select letter, count(*) as n from (select unnest(list_distinct(regexp_extract_all(lower(gcf_corrige), '([{tx.OUTSIDE}])', 1))) as letter from dataset_corrected) group by 1")
def violation_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "dataset_corrected", "gcf_corrige").select(F.explode(tx.violations(F.col("gcf_corrige"))).alias("letter"))
    return df.groupBy("letter").agg(F.count("*").alias("n"))


def _enforced(x: str) -> str:
    once = (("ç", "s"), ("[êë]", "è"), (r"[âà]([\p{L}\p{N}_])", r"a\1"), (r"[âà]([\p{L}\p{N}_])", r"a\1"), ("[îï]", "i"), ("[ôö]", "ò"), ("[ûü]", "u"), ("qu", "k"), ("ph", "f"), ("[cC]([khKH])", r"\1"), ("c([eiéè])", r"s\1"), ("c([aouò])", r"k\1"), ("q", "k"), ("x", "ks"))
    for pattern, into in once:
        x = f"regexp_replace({x}, {_lit(pattern)}, {_lit(into)}, 'g')"
    return x


@_query(f"select doc_id, {_enforced('text')} as text from documents")
def alphabet_enforced(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "documents", "doc_id", "text")
    return df.select("doc_id", tx.enforce_alphabet(F.col("text")).alias("text"))


def _canonical(x: str) -> str:
    outside = "[^\\p{L}\\p{N}_" + _SP[1:-1] + "]"
    return _squeeze(f"regexp_replace(strip_accents(lower({x})), '{outside}', '', 'g')")


def _fp(x: str) -> str:
    return f"md5({_canonical(x)})"


def _split(fp: str) -> str:
    u = f"(('0x' || substr({fp}, 1, 8))::bigint / 4294967295.0)"
    return f"case when {u} < 0.8 then 'train' when {u} < 0.9 then 'val' else 'test' end"


_SENTENCES = f"""with parts as (select doc_id, list_filter(string_split(regexp_replace({_T}, '([.!?…]){_SP}+', '\\1' || chr(1), 'g'), chr(1)), lambda p: length({_squeeze('p')}) > 0) as p from documents),
raw as (select doc_id, unnest(p) as raw, generate_subscripts(p, 1) - 1 as pos from parts),
s as (select doc_id, pos::int as pos, {_norm('raw')} as sentence from raw),
fit as (select *, {_fp('sentence')} as fp from s where length(sentence) between 12 and 300 and len({_tokens(_norm('sentence'))}) >= 3),
first as (select * from (select *, row_number() over (partition by fp order by doc_id, pos) as rn from fit) where rn = 1)"""


def _sentences_sql() -> str:
    return _SENTENCES


@_query(_SENTENCES + " select doc_id, pos, sentence, fp from first")
def sentence_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first seen of each sentence of the documents."""
    return pairs.clean_sentences(_texts(spark, sf_dir, "documents", "doc_id", "text"), "doc_id", "text")


@_query(_SENTENCES + f" select {_split('fp')} as split, count(*) as n from first group by 1")
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs.with_split(sentence_dedup(spark, sf_dir)).groupBy("split").agg(F.count("*").alias("n"))


@_query(
    f"select distinct fp from (select {_fp('target_gcf')} as fp from train_pairs where length({_canonical('target_gcf')}) > 0) semi join (select {_fp('target_gcf')} as fp from test_pairs) using (fp)"
)
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints that train and test share."""
    return pairs.leaked_fingerprints(_table(spark, sf_dir, "train_pairs", "target_gcf"), _table(spark, sf_dir, "test_pairs", "target_gcf"), "target_gcf")


@_query(
    f"""with t as (select list_transform({_tokens(_norm('source_pseudo_ht'))}, lambda x: lower(x)) as w from train_pairs),
g as (select unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) as gram, n from t, (values (1), (2), (3)) as v(n) where len(w) >= n)
select gram, count(*) as n from g group by 1 having count(*) >= 5"""
)
def ngram_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "train_pairs", "source_pseudo_ht").select(F.explode(tx.word_ngrams(tx.tokenize(F.col("source_pseudo_ht")), 3)).alias("gram"))
    return df.groupBy("gram").agg(F.count("*").alias("n")).where("n >= 5")


# ---- rules ---------------------------------------------------------------------------------------------------------------------

_ONE_WORD: dict[str, str] = {}
for _s, _t in rules.SEED_WORDS:
    if " " not in _s:
        _ONE_WORD.setdefault(_s, _t)
_MAP = "map {" + ", ".join(f"{_lit(k)}: {_lit(v)}" for k, v in _ONE_WORD.items()) + "}"
_NEW = f"coalesce({_MAP}[lower(w)], w)"
_CASED = f"case when w <> lower(w) and w = upper(w) and length(w) > 1 then upper({_NEW}) when w[1] = upper(w[1]) and w[1] <> lower(w[1]) then upper({_NEW}[1]) || {_NEW}[2:] else {_NEW} end"


def _fix(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{_SP}+([,.;:!?…])', '\\1', 'g'), '{_SP}*''{_SP}*', '''', 'g')"


_REWRITTEN = "array_to_string(list_transform(" + _tokens(_norm("source_pseudo_ht")) + ", lambda w: " + _CASED + "), ' ')"


_NEW_TEXT = _norm(_fix(_REWRITTEN))


@_query(f"select pair_id, {_NEW_TEXT} as rewritten from test_pairs")
def rules_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-word rules, natively."""
    df = _table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht")
    return df.select("pair_id", rules.apply_word_rules(tx.tokenize(F.col("source_pseudo_ht")), _ONE_WORD).alias("rewritten"))


_PHRASES = {}
for _s, _t in rules.SEED_WORDS:
    _PHRASES.setdefault(_s, _t)
_TABLE = "map {" + ", ".join(f"{_lit(k)}: {_lit(v)}" for k, v in _PHRASES.items()) + "}"
_TWO, _ONE = "lower(w[i]) || ' ' || lower(w[i + 1])", "lower(w[i])"


def _cased_as(model: str, new: str) -> str:
    return f"case when length({model}) > 1 and {model} = upper({model}) and {model} <> lower({model}) then upper(split_part({new}, ' ', 1)) || substr({new}, length(split_part({new}, ' ', 1)) + 1) when {model}[1] = upper({model}[1]) and {model}[1] <> lower({model}[1]) then upper({new}[1]) || {new}[2:] else {new} end"


#: Left to right, two words before one: the fold's state is the text so far and whether the next word is used up.
_GREEDY = f"""list_reduce(range(1, len(w) + 1), lambda acc, i: case when acc[2] = 'x' then [acc[1], ''] when i < len(w) and {_TABLE}[{_TWO}] is not null then [acc[1] || ' ' || {_cased_as('w[i]', f'{_TABLE}[{_TWO}]')}, 'x']
 when {_TABLE}[{_ONE}] is not null then [acc[1] || ' ' || {_cased_as('w[i]', f'{_TABLE}[{_ONE}]')}, ''] else [acc[1] || ' ' || w[i], ''] end, ['', ''])[1]"""


def _patterns(x: str) -> str:
    """The starting patterns, with Unicode word edges; twice where a match uses up the edge of the next one."""
    edge = "[^\\p{L}\\p{N}_]"
    for _ in range(2):
        x = f"regexp_replace({x}, '(^|{edge})e($|{edge})', '\\1é\\2', 'g')"
    for _ in range(2):
        x = f"regexp_replace({x}, '([\\p{{L}}\\p{{N}}_]{{2,}})e($|{edge})', '\\1é\\2', 'g')"
    return f"regexp_replace({x}, '(^|{edge})ou{_SP}+se($|{edge})', '\\1ou sé\\2', 'g')"


@_query(f"select pair_id, {_norm(_fix('t'))} as rewritten from (select pair_id, {_patterns('substr(t, 2)')} as t from (select pair_id, coalesce({_GREEDY}, '') as t from (select pair_id, {_tokens(_norm('source_pseudo_ht'))} as w from test_pairs)))")
def rules_seeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All starting rules: several words before one, the first word's case, then the patterns."""
    df = _table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht")
    return rules.apply_rules(df, "pair_id", "source_pseudo_ht", rules.seed_rules(spark)).select("pair_id", "rewritten")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.corrected_pairs(_texts(spark, sf_dir, "diagnostic_to_correct", "whisper_ht", "corrected").distinct()).withColumn("key", F.md5(F.concat_ws("|", "src", "tgt").cast("binary")))


@_query()
def rules_mined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Substitution rules mined from the corrected sheet."""
    return rules.mine(_pairs(spark, sf_dir), "src", "tgt", "key")[0]


@_query()
def rules_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.top_residuals(rules.mine(_pairs(spark, sf_dir), "src", "tgt", "key")[1])


@_query()
def rules_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = durable(rules.mine(_pairs(spark, sf_dir), "src", "tgt", "key")[0], "mined")
    seed = rules.seed_rules(spark)
    return rules.merge(mined, rules.unconfirmed(seed, mined).unionByName(seed.join(mined.select("src").distinct(), "src", "left_semi")))


@_query()
def rules_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged rules on the test sources, and how many targets they meet."""
    merged = durable(rules_merged(spark, sf_dir), "merged")
    out = rules.apply_rules(_table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht", "target_gcf"), "pair_id", "source_pseudo_ht", merged)
    return rules.coverage(out, "rewritten", "target_gcf")


@_query()
def synthetic_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inverse rules and noise over the clean creole sentences: leak-free pairs per split."""
    docs = _table(spark, sf_dir, "documents", "doc_id", "lang", "text").where(F.lower(F.trim("lang")) == "gcf")
    clean = pairs.clean_sentences(docs, "doc_id", "text")
    back = rules.apply_rules(clean, "fp", "sentence", durable(rules_merged(spark, sf_dir), "merged"), inverse=True, prob=0.9)
    noisy = pairs.add_noise(back, "fp", "rewritten", 0.15).select("fp", "noisy").join(clean, "fp")
    return pairs.with_split(pairs.drop_identities(noisy, "noisy", "sentence", "fp")).select("fp", "split", F.col("noisy").alias("source"), F.col("sentence").alias("target"))


@_query()
def word_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source words outside the longest common subsequence with the target."""
    df = _table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht", "target_gcf")
    a = tx.tokenize(F.col("source_pseudo_ht"))
    return df.select("pair_id", a.alias("words"), rules.word_diff(a, tx.tokenize(F.col("target_gcf"))).alias("differs"))


_LCS = _DP.replace("if({a}[i] = {b}[j], 0, 1)", "if({a}[i] = {b}[j], 0, 2)")


@_query(
    f"""select pair_id, len(a)::int as words, ((len(a) - len(b) + {_LCS.format(a='a', b='b')}) / 2)::bigint as differing
from (select pair_id, list_transform({_tokens(_norm('source_pseudo_ht'))}, lambda x: lower(x)) as a, list_transform({_tokens(_norm('target_gcf'))}, lambda x: lower(x)) as b from test_pairs)"""
)
def word_difference_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many source words lie outside a longest common subsequence with the target."""
    return word_differences(spark, sf_dir).select("pair_id", F.size("words").alias("words"), F.size(F.filter("differs", lambda x: x)).cast("long").alias("differing"))


# ---- error rates and language model --------------------------------------------------------------------------------------------


@_query(f"select pair_id, {_distance('r', 'h')} as errors, len(r) as length from (select pair_id, {_low_tokens('target_gcf')} as r, {_low_tokens('source_pseudo_ht')} as h from test_pairs)")
def wer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht", "target_gcf")
    return df.select("pair_id", word_errors(F.col("target_gcf"), F.col("source_pseudo_ht")).alias("e")).select("pair_id", F.col("e.errors").cast("long").alias("errors"), F.col("e.length").cast("long").alias("length"))


@_query(f"select pair_id, levenshtein({_bytes1('r')}, {_bytes1('h')}) as errors, length(r) as length from (select pair_id, {_norm('target_gcf', True)} as r, {_norm('source_pseudo_ht', True)} as h from test_pairs)")
def cer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "test_pairs", "pair_id", "source_pseudo_ht", "target_gcf")
    return df.select("pair_id", char_errors(F.col("target_gcf"), F.col("source_pseudo_ht")).alias("e")).select("pair_id", F.col("e.errors").cast("long").alias("errors"), F.col("e.length").cast("long").alias("length"))


@_query(
    f"""select corpus, count(*) as n, round(sum({_distance('r', 'h')}) / greatest(sum(len(r)), 1), 6) as wer, round(sum(levenshtein({_bytes1('rc')}, {_bytes1('hc')})) / greatest(sum(length(rc)), 1), 6) as cer, count_if(rc = hc) as exact
from (select corpus, {_low_tokens('target_gcf')} as r, {_low_tokens('source_pseudo_ht')} as h, {_norm('target_gcf', True)} as rc, {_norm('source_pseudo_ht', True)} as hc from train_pairs) group by 1"""
)
def corpus_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summed error rates per corpus."""
    ref, hyp = F.col("target_gcf"), F.col("source_pseudo_ht")
    same = tx.normalize_surface(ref, lower=True) == tx.normalize_surface(hyp, lower=True)
    df = _texts(spark, sf_dir, "train_pairs", "corpus", "target_gcf", "source_pseudo_ht").select("corpus", word_errors(ref, hyp).alias("w"), char_errors(ref, hyp).alias("c"), same.alias("same"))
    return df.groupBy("corpus").agg(
        F.count("*").alias("n"), F.round(corpus_rate(F.col("w.errors"), F.col("w.length")), 6).alias("wer"), F.round(corpus_rate(F.col("c.errors"), F.col("c.length")), 6).alias("cer"), F.count_if("same").alias("exact")
    )


_COUNTS = f"""with s as (select '^' || {_norm('target_gcf', True)} || '$' as s from train_pairs),
model as (select n::int as n, gram, count(*) as cnt from (select n, substr(s, i, n) as gram from s, (values (1), (2), (3), (4), (5)) as v(n), unnest(range(1, length(s) - n + 2)) as u(i) where length(s) >= n) group by all)"""


@_query(_COUNTS + " select n, gram, cnt from model")
def charlm_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charlm.fit(_texts(spark, sf_dir, "train_pairs", "target_gcf"), "target_gcf", 5)


@_query(
    _COUNTS
    + f""", tot as (select sum(cnt) as total from model where n = 1),
v as (select pair_id, '^' || {_norm('target_gcf', True)} || '$' as s from val_pairs),
spots as (select pair_id, i, substr(s, greatest(i - 4, 1), i - greatest(i - 4, 1) + 1) as gram from v, unnest(range(2, length(s) + 1)) as u(i)),
tries as (select distinct gram, k, right(gram, k + 1) as sub, left(right(gram, k + 1), k) as ctx from spots, unnest(range(0, length(gram))) as w(k)),
found as (select t.gram, t.k, pow(0.4, length(t.gram) - 1 - k) * a.cnt / (case when k = 0 then total else b.cnt end) as p from tries t join model a on a.gram = t.sub left join model b on b.gram = t.ctx cross join tot where k = 0 or b.cnt is not null),
best as (select gram, max_by(p, k) as p from found group by 1),
lp as (select pair_id, sum(log10(greatest(coalesce(p, 1.0 / total), 1e-12))) as lp, count(*) as n from spots left join best using (gram) cross join tot group by 1)
select pair_id, round(lp, 5) as log10_prob, round(pow(10, -lp / n), 4) as perplexity from lp"""
)
def charlm_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = durable(charlm_counts(spark, sf_dir), "charlm")
    df = charlm.perplexity(_table(spark, sf_dir, "val_pairs", "pair_id", "target_gcf"), "pair_id", "target_gcf", model, 5)
    return df.select("pair_id", F.round("log10_prob", 5).alias("log10_prob"), F.round("perplexity", 4).alias("perplexity"))


@_query(
    """with v as (select perplexite_lm as v, row_number() over (order by perplexite_lm) - 1 as i, count(*) over () as n from dataset_corrected where perplexite_lm is not null and isfinite(perplexite_lm))
select v as threshold from v where i = least(floor(n * 0.95), n - 1)"""
)
def perplexity_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return charlm.quantile_by_index(_table(spark, sf_dir, "dataset_corrected", "perplexite_lm"), "perplexite_lm")


@_query(
    f"""with t as (select list_transform({_tokens(_norm('target_gcf'))}, lambda x: lower(x)) as w from train_pairs),
g as (select w[i] as prev, w[i + 1] as next, count(*) as n from t, unnest(range(1, len(w))) as u(i) group by all),
p as (select prev, next, n / sum(n) over (partition by prev) as prob from g),
r as (select *, row_number() over (partition by prev order by prob desc, next)::int as rank from p)
select prev, next, prob, rank from r where rank <= 5"""
)
def next_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "train_pairs", "target_gcf").select(tx.tokenize(F.col("target_gcf")).alias("w"))
    return charlm.next_words(df, "w")


@_query(
    f"""with e as (select {_low_tokens('target_gcf')} as r, {_low_tokens('source_pseudo_ht')} as s, {_low_tokens(_NEW_TEXT)} as h, {_norm('target_gcf', True)} as rc, {_norm('source_pseudo_ht', True)} as sc, {_norm(_NEW_TEXT, True)} as hc from test_pairs),
x as (select count(*) as n, sum({_distance('r', 's')}) / greatest(sum(len(r)), 1) as wb, sum({_distance('r', 'h')}) / greatest(sum(len(r)), 1) as wa, sum(levenshtein({_bytes1('rc')}, {_bytes1('sc')})) / greatest(sum(length(rc)), 1) as cb,
 sum(levenshtein({_bytes1('rc')}, {_bytes1('hc')})) / greatest(sum(length(rc)), 1) as ca, count_if(rc = hc) as exact_matches from e)
select n, round(wb, 6) as wer_before, round(wa, 6) as wer_after, round(cb, 6) as cer_before, round(ca, 6) as cer_after, round(case when wb = 0 then 0 else (wb - wa) / wb end, 6) as wer_reduction, exact_matches from x"""
)
def evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-word rules as a correction of the test pairs, before and after."""
    df = _texts(spark, sf_dir, "test_pairs", "source_pseudo_ht", "target_gcf").withColumn("new", rules.apply_word_rules(tx.tokenize(F.col("source_pseudo_ht")), _ONE_WORD))
    r = evaluate.evaluate(df, "source_pseudo_ht", "new", "target_gcf")
    return r.select("n", *(F.round(c, 6).alias(c) for c in ("wer_before", "wer_after", "cer_before", "cer_after", "wer_reduction")), "exact_matches")


@_query("select unnest([0.1, 0.25, 0.5, 0.75, 0.9])::double as q, round(unnest(quantile_cont(wer_estime, [0.1, 0.25, 0.5, 0.75, 0.9])), 6) as value from dataset_corrected")
def wer_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.quantiles(_table(spark, sf_dir, "dataset_corrected", "wer_estime"), "wer_estime").select("q", F.round("value", 6).alias("value"))


# ---- quality -------------------------------------------------------------------------------------------------------------------


@_query(
    """select value, count(*) as n from (select unnest(list_filter([case when avg_logprob < -1.0 then 'logprob<-1.0' end, case when compression_ratio > 2.0 then 'compression>2.0' end,
case when perplexite_lm > 100 then 'ppl>100' end, case when no_speech_prob > 0.6 then 'no_speech>0.6' end, case when n_tokens < 2 then 'trop_court' end], lambda x: x is not null)) as value
from (select distinct id, avg_logprob, compression_ratio, perplexite_lm, no_speech_prob, n_tokens from dataset_corrected)) group by 1"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments per reason of rejection."""
    df = _table(spark, sf_dir, "dataset_corrected", "id", "avg_logprob", "compression_ratio", "perplexite_lm", "no_speech_prob", "n_tokens").distinct()
    why = gate.reasons(*(F.col(c) for c in ("avg_logprob", "compression_ratio", "perplexite_lm", "no_speech_prob", "n_tokens")))
    return gate.histogram(df.withColumn("why", why), "why")


@_query(
    """select count(*) as segments, count_if(filtre_passe) as kept, round(avg(filtre_passe::int), 4) as retention, round(avg(wer_estime), 4) as wer_estime, count_if(confiance >= 0.6 and wer_estime <= 0.3) as high,
round(sum(case when confiance >= 0.6 and wer_estime <= 0.3 then duration else 0 end) / 3600, 4) as hours_high from dataset_corrected"""
)
def segment_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct.statistics(_table(spark, sf_dir, "dataset_corrected"), 0.6, 0.3)


_SIG = "1 / (1 + exp(-({x} - {m}) / {s}))"
_CONF = f"""with d as (select distinct id, avg_logprob as l, compression_ratio as c, coalesce(nullif(perplexite_corrigee, 0), nullif(perplexite_lm, 0)) as p, coalesce(taux_edition, 0) as e, coalesce(len(violations_gerec2) > 0, false) as v from dataset_corrected where filtre_passe),
conf as (select id, round((case when l is not null then 0.3 * {_SIG.format(x='l', m='-1.0', s='0.25')} else 0 end + case when c is not null then 0.15 * (1 - {_SIG.format(x='c', m='2.0', s='0.2')}) end
 + case when p is not null then 0.35 * (1 - {_SIG.format(x='ln(greatest(p, 1.01))', m='ln(100.0)', s='0.35')}) else 0 end + 0.2 * (1 - {_SIG.format(x='e', m='0.45', s='0.12')}))
 / (case when l is not null then 0.3 else 0 end + 0.15 + case when p is not null then 0.35 else 0 end + 0.2 + case when v then 0.1 else 0 end), 4) as confidence from d)"""


@_query(_CONF + " select id, confidence from conf")
def confidence_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "dataset_corrected").where("filtre_passe")
    c = scores.confidence(*(F.col(c) for c in ("avg_logprob", "compression_ratio", "perplexite_corrigee", "perplexite_lm", "taux_edition", "violations_gerec2")))
    return df.select("id", "avg_logprob", "compression_ratio", "perplexite_corrigee", "perplexite_lm", "taux_edition", "violations_gerec2").distinct().select("id", c.alias("confidence"))


_BUCKETS = """select format('{:.1f}', floor(confiance * 10) / 10) as bucket, round(avg(wer_estime), 4) as wer from dataset_corrected where confiance is not null and wer_estime is not null group by 1"""


@_query(_BUCKETS)
def wer_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration table of all rows with a confidence and an error rate."""
    return ingest.calibration(_table(spark, sf_dir, "dataset_corrected", "confiance", "wer_estime"), "confiance", "wer_estime")


@_query(
    f"""with b as ({_BUCKETS}), d as (select distinct id, confiance from dataset_corrected where confiance is not null)
select d.id, d.confiance, (select wer from b order by case when abs(bucket::double - floor(d.confiance * 10) / 10) < 1e-6 then -1 else round(abs(bucket::double - d.confiance), 9) end, bucket::double limit 1) as wer_estime from d"""
)
def wer_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error rates looked up in that table, from the nearest bucket where the own one is missing."""
    df = _table(spark, sf_dir, "dataset_corrected", "id", "confiance").where("confiance is not null").distinct()
    return ingest.estimate_wer(df, "confiance", wer_buckets(spark, sf_dir))


@_query("select distinct id, audio, confiance, wer_estime from dataset_corrected where confiance >= 0.6 and wer_estime <= 0.3")
def high_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct.high_confidence(_table(spark, sf_dir, "dataset_corrected", "id", "audio", "confiance", "wer_estime"), 0.6, 0.3).distinct()


@_query("select id from (select distinct id from dataset_corrected where filtre_passe) order by md5('audit|' || id), id limit 50")
def audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _table(spark, sf_dir, "dataset_corrected", "id", "filtre_passe").where("filtre_passe").select("id").distinct()
    return ingest.sample(df, "id", 50, "audit")


@_query()
def segment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression ratios of all segments, recomputed, and what the filter says of them."""
    df = _texts(spark, sf_dir, "dataset_corrected").withColumn("compression_ratio", tx.compression_ratio(F.col("whisper_ht"))).withColumn("n_tokens", F.size(tx.tokenize(F.col("whisper_ht"))))
    return correct.filtered(df).select("id", F.round("compression_ratio", 4).alias("compression_ratio"), "n_tokens", "filtre_passe", "motifs_rejet")


@_query()
def corrected_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole correction pass with rules as corrector."""
    seed = rules.seed_rules(spark)
    df = _table(spark, sf_dir, "dataset_corrected", "id", "audio", "duration", "whisper_ht", "avg_logprob", "compression_ratio", "no_speech_prob").dropDuplicates(["id"])
    model = durable(charlm_counts(spark, sf_dir), "charlm")
    by_rules = lambda d, key, text, into: rules.apply_rules(d, key, text, seed, into=into)
    return correct.correct(df, "id", "whisper_ht", by_rules, model, wer_buckets(spark, sf_dir), order=5)


# ---- hypotheses ----------------------------------------------------------------------------------------------------------------


def _hypotheses(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _texts(spark, sf_dir, "dataset_corrected", "id", "whisper_ht", "gcf_corrige", "avg_logprob", "perplexite_lm", "perplexite_corrigee").where("whisper_ht is not null").distinct()
    one = lambda text, t, ppl: F.struct(F.col(text).alias("text"), F.lit(t).alias("temperature"), F.col("avg_logprob"), (-F.log10(F.col(ppl))).alias("lm_logprob"))
    h = df.select(F.col("id").alias("audio"), F.explode(F.array(one("whisper_ht", 0.0, "perplexite_lm"), one("gcf_corrige", 0.2, "perplexite_corrigee"))).alias("h")).select("audio", "h.*")
    return h.where("text is not null").withColumn("corrected", F.col("text"))


_HYP = """with d as (select distinct id, whisper_ht, gcf_corrige, avg_logprob, perplexite_lm, perplexite_corrigee from dataset_corrected where whisper_ht is not null),
h as (select id as audio, whisper_ht as text, 0.0::double as temperature, avg_logprob, -log10(perplexite_lm) as lm_logprob from d union all
 select id, gcf_corrige, 0.2::double, avg_logprob, -log10(perplexite_corrigee) from d where gcf_corrige is not null),
u as (select * from (select *, row_number() over (partition by audio, lower(text) order by temperature, text) as rn from h) where rn = 1),
r as (select *, avg_logprob + 0.5 * lm_logprob / greatest(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')), 1) as f from u),
k as (select *, row_number() over (partition by audio order by f desc nulls last, temperature, text) as rank from r)"""


@_query(_HYP + " select audio, text, temperature, round(f, 6) as score_fusion, rank::int as rank from k")
def nbest_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.rank(nbest.dedup(_hypotheses(spark, sf_dir))).select("audio", "text", "temperature", F.round("score_fusion", 6).alias("score_fusion"), "rank")


@_query(
    _HYP
    + f""", b as (select audio, text as source, {_norm('text')} as target from k where rank = 1), o as (select audio, {_norm('text')} as other from k where rank > 1),
p as (select b.audio, {_low_tokens('b.target')} as r, {_low_tokens('o.other')} as h from b join o using (audio)),
w as (select audio, avg(case when len(r) = 0 then case when len(h) = 0 then 0.0 else 1.0 end else {_distance('r', 'h')} / len(r) end) as w, count(*) as others from p group by 1)
select audio, source, target, round(coalesce(greatest(0.0, 1 - w), 0.0), 4) as accord, (coalesce(others, 0) + 1)::int as n_hypotheses, coalesce(others, 0) > 0 and coalesce(greatest(0.0, 1 - w), 0.0) >= 0.85 as kept from b left join w using (audio)"""
)
def nbest_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbest.agreement(nbest.rank(nbest.dedup(_hypotheses(spark, sf_dir))))


@_query(
    """with p as (select target_gcf as target, source_pseudo_ht as source from val_pairs where source_pseudo_ht is not null), s as (select source_pseudo_ht as source, target_gcf as target from train_pairs where source_pseudo_ht is not null)
select source, target, 'pseudo' as origin from p union all select * from (select source, target, 'synthetic' from s order by md5('mix|' || source || '|' || target), source, target limit (select count(*) from p))"""
)
def pseudo_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda n: _texts(spark, sf_dir, n, "source_pseudo_ht", "target_gcf").where("source_pseudo_ht is not null").select(F.col("source_pseudo_ht").alias("source"), F.col("target_gcf").alias("target"))
    return nbest.mix(read("val_pairs"), read("train_pairs"))


# ---- corpus building -----------------------------------------------------------------------------------------------------------


@_query("select distinct c from segment_index where c not in (select audio from dataset_corrected where audio is not null)")
def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths without a scored segment."""
    done = _table(spark, sf_dir, "dataset_corrected", "audio").select(F.col("audio").alias("c"))
    return ingest.todo(_table(spark, sf_dir, "segment_index", "c").distinct(), done, "c")


@_query(
    f"""with g as (select distinct c, ref as t from temoins where {_filled('ref')}) select distinct c, t from segment_index where c is not null and c not in (select c from g) union all select c, t from g"""
)
def preserve_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts, but witness texts where they exist."""
    kept = _table(spark, sf_dir, "temoins").select("c", F.col("ref").alias("t")).distinct()
    return ingest.preserve(_table(spark, sf_dir, "segment_index", "c", "t").where("c is not null").distinct(), kept, "c", "t")


_INDEX = f"""with tr as (select audio as file_name, {_squeeze("coalesce(max(whisper_ht), '')")} as t0 from dataset_corrected where audio is not null and filtre_passe group by 1),
rj as (select c as file_name, max(coalesce(nullif(m, ''), 'rejet')) as motif, max(coalesce(t, '')) as text from segment_index where c is not null and m in ('hallucination', 'vide', 'rejet') group by 1),
x as (select coalesce(tr.file_name, rj.file_name) as c, case when coalesce(t0, '') = '' and rj.file_name is not null then text else coalesce(t0, '') end as t, coalesce(motif, case when coalesce(t0, '') = '' then 'vide' else '' end) as m,
 coalesce(try_cast(regexp_extract(coalesce(tr.file_name, rj.file_name), '_segment_(\\d+)_(\\d+)\\.mp3$', 2) as bigint) - try_cast(regexp_extract(coalesce(tr.file_name, rj.file_name), '_segment_(\\d+)_(\\d+)\\.mp3$', 1) as bigint), 0) as d
 from tr full outer join rj using (file_name))"""


@_query(_INDEX + " select c, t, m, d from x")
def segment_index_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts and rejects merged into one index."""
    t = _table(spark, sf_dir, "dataset_corrected", "audio", "whisper_ht", "filtre_passe").where("audio is not null and filtre_passe").groupBy(F.col("audio").alias("file_name")).agg(F.max("whisper_ht").alias("transcription"))
    r = _table(spark, sf_dir, "segment_index", "c", "m", "t").where("c is not null and m in ('hallucination', 'vide', 'rejet')").groupBy(F.col("c").alias("file_name")).agg(F.max(F.coalesce(F.nullif("m", F.lit("")), F.lit("rejet"))).alias("motif"), F.max(F.coalesce("t", F.lit(""))).alias("texte_rejete"))
    return ingest.build_index(t, r)


@_query(_INDEX + " select coalesce(nullif(m, ''), 'transcrit') as m, count(*) as n, round(sum(coalesce(d, 0)) / 3600000, 6) as hours from x group by 1")
def segment_index_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.index_summary(segment_index_built(spark, sf_dir))


@_query("select c, replace(c, '/', '__') as f, t, m, d from (select distinct * from segment_index) where m in ('hallucination', 'français', 'vide') and d > 0 and d <= 25000 order by md5('lot|' || c), c limit 100")
def lot_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.lot(_table(spark, sf_dir, "segment_index").distinct(), ["hallucination", "français", "vide"], 100, "lot")


@_query(
    f"""select format('diag_{{:04d}}', row_number() over (order by h, audio_ref, whisper_ht) - 1) as segment_id, audio_ref, whisper_ht, '' as corrected, '' as notes from
(select *, md5('sheet|' || coalesce(audio_ref || '|', '') || whisper_ht) as h from (select distinct audio as audio_ref, whisper_ht from dataset_corrected where len({_tokens(_norm('whisper_ht'))}) >= 5) order by h, audio_ref, whisper_ht limit 80)"""
)
def diagnostic_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.diagnostic_sheet(_table(spark, sf_dir, "dataset_corrected", "audio", "whisper_ht"), "audio", "whisper_ht", 80, "sheet")


@_query("select distinct c, t, m, d from segment_index where m = 'français' and (contains(lower(coalesce(t, '')), 'voudrait') or contains(lower(c), 'voudrait')) order by c, t nulls first, m, d nulls first limit 20 offset 10")
def segment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.page(ingest.search(_table(spark, sf_dir, "segment_index").distinct(), "Voudrait", "français"), 10, 20)


@_query(
    """with i as (select distinct c, t, m, d from segment_index), shown as (select * from i order by c nulls first, t nulls first, m nulls first, d nulls first limit 200),
r as (select c, t, m, d, (row_number() over (order by c nulls first, t nulls first, m nulls first, d nulls first) - 1)::double as p, false as temoin from shown),
cand as (select c, max(struct_pack(t := t, m := m, d := d)) as s from i where c in (select c from temoins) and c not in (select c from shown where c is not null) and c not in (select id from corrections where annotateur = 'Météwi' and id is not null) group by 1 order by c limit 2),
put as (select c, s.t as t, s.m as m, s.d as d, (row_number() over (order by c) - 1) * 6 + 2.5 as p, true as temoin from cand)
select (row_number() over (order by p, c) - 1)::int as position, c, t, m, d, temoin from (select * from r union all select * from put)"""
)
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first page of free browsing with witnesses slipped in."""
    index = _table(spark, sf_dir, "segment_index").distinct()
    seen = _table(spark, sf_dir, "corrections", "id", "annotateur").where("annotateur = 'Météwi'")
    return ingest.inject_witnesses(ingest.page(index), index, _table(spark, sf_dir, "temoins"), seen)


# ---- annotation log ------------------------------------------------------------------------------------------------------------

_AT = '"at"'
_ORDER = 'coalesce("at", 0), recu_le nulls first, corrected nulls first, note nulls first'
_VERSIONS = f"""with e as (select *, lead(coalesce("at", 0)) over (partition by id, annotateur order by {_ORDER}) as nxt from corrections),
v as (select *, row_number() over (partition by id, annotateur order by {_ORDER}) as version from e where nxt is null or nxt - coalesce("at", 0) >= 3600000),
ver as (select * exclude (nxt), max(version) over (partition by id, annotateur) as last_version from v), last as (select * from ver where version = last_version)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.versions(_texts(spark, sf_dir, "corrections"))


@_query(_VERSIONS + ' select id, annotateur, version::int as version, corrected, note, "at" from ver')
def correction_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("id", "annotateur", "version", "corrected", "note", "at")


@_query(_VERSIONS + ' select id, annotateur, version::int as version, corrected, note, "at" from ver')
def versions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream with state per (segment, annotator)."""
    from tamarin.streaming import log

    # the log as it arrived, in four files, one a trigger; late events come after the newer ones
    path = scratch(spark, "stream")
    df = _table(spark, sf_dir, "corrections", "id", "annotateur", "corrected", "note", "at", "recu_le")
    df.repartitionByRange(4, "recu_le").write.parquet(f"{path}/in")
    events = log.event_stream(spark, f"{path}/in", df._jdf.schema().toDDL(), files_per_trigger=1)
    log.run_versions(log.version_updates(events), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return log.current_versions(spark, f"{path}/out")


@_query(_VERSIONS + " select id, annotateur, corrected, note, skipped from last")
def latest_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.latest(_log(spark, sf_dir)).select("id", "annotateur", "corrected", "note", "skipped")


def _cer_sql(a: str, b: str) -> str:
    a, b = _plain(a), _plain(b)
    return f"case when length({a}) = 0 then case when length({b}) = 0 then 0.0 else 1.0 end else least(1.0, levenshtein({_bytes1(a)}, {_bytes1(b)}) / length({a})) end"


_SELF = f"""select id, annotateur, {_cer_sql('f', 'l')} as cer from (select id, annotateur, max(case when version = 1 then corrected end) as f, max(case when version = last_version then corrected end) as l from ver where last_version > 1 group by 1, 2) where {_filled('f')} and {_filled('l')}"""


@_query(_VERSIONS + f" select id, annotateur, round(cer, 6) as cer from ({_SELF})")
def self_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.self_agreement(_log(spark, sf_dir)).select("id", "annotateur", F.round("cer", 6).alias("cer"))


_NOW = 1_800_000_000_000


@_query(_VERSIONS + f" select id, annotateur from ver where last_version = 1 and {_filled('corrected')} and {_NOW} - coalesce({_AT}, 0) >= 1209600000 and ('0x' || substr(md5(id || '|' || annotateur), 1, 8))::bigint % 1000 < 30")
def retest_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.retest_due(_log(spark, sf_dir), _NOW)


@_query(
    _VERSIONS
    + f""", p as (select id, annotateur, count(*) as n, count_if({_filled('corrected')}) as texts, max(case when version = last_version then {_filled('corrected')}::int end) as filled, max(case when version = last_version then note end) as note from ver group by 1, 2),
s as (select id, sum(texts) as texts, sum(n - 1) as repeats, sum(filled) as filled, bool_or(note = 5) as five, bool_or(note = 1) as one from p group by 1)
select count_if(filled > 0) as corriges, sum(texts)::bigint as versions, sum(repeats)::bigint as reprises, count_if(filled > 1) as doubles, count_if(five) as validees, count_if(one) as rebuts,
 (select count(distinct annotateur) from ver) as annotateurs, (select count(*) from segment_index) as segments, (select count(*) from temoins) as temoins from s"""
)
def service_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.service_stats(_log(spark, sf_dir), _table(spark, sf_dir, "segment_index", "c"), _table(spark, sf_dir, "temoins"))


@_query(_VERSIONS + f" select id, count_if(annotateur <> 'Météwi' and {_filled('corrected')}) as autres from last group by 1")
def others_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.others_count(_log(spark, sf_dir), "Météwi")


def _iso(x: str) -> str:
    return f"coalesce(case when {x} = 0 then '' else strftime(make_timestamp({x} * 1000), '%Y-%m-%dT%H:%M:%S') || case when {x} % 1000 = 0 then '' else '.' || lpad(({x} % 1000)::varchar, 3, '0') || '000' end || '+00:00' end, '')"


_SEG = "(select c, max(struct_pack(t := coalesce(t, ''), m := coalesce(m, ''), d := coalesce(d, 0))) as s from segment_index group by 1)"


@_query(
    _VERSIONS
    + f""" select v.id as segment_id, coalesce(s.t, '') as whisper, coalesce(s.m, '') as motif, coalesce(s.d, 0) as duree_ms, coalesce(corrected, '') as corrected, coalesce(notes, '') as notes, annotateur, version::int as version,
 case when coalesce(note, 0) <> 0 then note::varchar else '' end as rating, case when note = 5 then 'human_validated' when note = 1 then 'unusable' when coalesce(note, 0) <> 0 then 'human_reviewed' when {_filled('corrected')} then 'draft' else '' end as status,
 case when vote then '1' else '' end as vote, coalesce(ecoute_ms, 0) as ecoute_ms, coalesce(lectures, 0) as lectures, {', '.join(f"{_iso(f'jalons[{_lit(k)}]')} as {k}_a" for k in an.MILESTONES)} from ver v left join {_SEG} i on i.c = v.id"""
)
def corrections_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return an.export(_log(spark, sf_dir), _table(spark, sf_dir, "segment_index"))


_SEG2 = "(select c, max(struct_pack(d := coalesce(d, 0), t := coalesce(t, ''))) as seg from segment_index group by 1)"


@_query(
    _VERSIONS
    + f""", l as (select last.*, seg.d as sd, seg.t as st from last left join {_SEG2} i on i.c = last.id), w as (select c, max(ref) as ref from temoins group by 1),
a as (select annotateur, count_if({_filled('corrected')}) as corrections, count_if(note = 1) as rebuts, count_if(note = 5) as validees, median(case when note <> 0 then note end) as note,
 median(case when {_filled('corrected')} and sd > 0 then least(2.0, coalesce(ecoute_ms, 0) / sd) end) as ecoute from l group by 1),
r as (select annotateur, median(cer) as reprise from ({_SELF}) group by 1),
t as (select annotateur, median({_cer_sql('ref', 'corrected')}) as temoin from l join w on w.c = l.id where {_filled('corrected')} group by 1)
select a.annotateur, corrections, rebuts, validees, note::double as note, round(ecoute, 6) as ecoute, round(reprise, 6) as reprise, round(temoin, 6) as temoin from a left join r using (annotateur) left join t using (annotateur)"""
)
def annotator_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = durable(_log(spark, sf_dir), "versions")
    df = an.annotator_quality(v, _table(spark, sf_dir, "segment_index"), _table(spark, sf_dir, "temoins"))
    return df.select("annotateur", "corrections", "rebuts", "validees", "note", *(F.round(c, 6).alias(c) for c in ("ecoute", "reprise", "temoin")))


@_query(
    _VERSIONS
    + f""", l as (select last.*, coalesce(seg.d, 0) as sd, seg.t as st, coalesce(ecoute_ms, 0) as e, coalesce(lectures, 0) as p from last left join {_SEG2} i on i.c = last.id where {_filled('corrected')}),
g as (select *, {_gate('corrected')} as why from l),
f as (select unnest(list_filter([case when coalesce(note, 0) = 5 and sd > 0 and (p = 0 or e < 0.5 * sd) then '5 étoiles sans avoir écouté' end, case when p = 0 then 'jamais écouté' when sd > 0 and e < 0.4 * sd then 'écoute partielle' end,
 case when {_plain('corrected')} = {_plain('st')} and sd > 0 and e < 0.5 * sd then 'validé sans écouter' end, case when why = 'français' then 'correction en français' when why is not null then 'correction : ' || why end], lambda x: x is not null)) as value from g)
select value, count(*) as n from f group by 1"""
)
def flag_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubts about the latest corrections."""
    return gate.histogram(an.review_sheet(_log(spark, sf_dir), _table(spark, sf_dir, "segment_index")), "drapeaux")


@_query(
    _VERSIONS
    + f""", lex as (select distinct lower(unnest(string_split({_plain('target_gcf')}, ' '))) as word from train_pairs),
l as (select last.*, coalesce(seg.d, 0) as sd, coalesce(seg.t, '') as st, coalesce(ecoute_ms, 0) as e, coalesce(lectures, 0) as p, row_number() over () as n from last left join {_SEG2} i on i.c = last.id where {_filled('corrected')}),
w as (select n, unnest(list_filter(string_split({_plain('corrected')}, ' '), lambda x: length(x) > 2)) as word from l),
u as (select n, count(*) as words, count(lex.word) as known from w left join lex using (word) group by 1),
g as (select l.*, {_gate('corrected')} as why, case when words >= 4 then (words - known) / words end as unknown_share from l left join u using (n)),
f as (select *, list_filter([case when coalesce(note, 0) = 5 and sd > 0 and (p = 0 or e < 0.5 * sd) then '5 étoiles sans avoir écouté' end, case when p = 0 then 'jamais écouté' when sd > 0 and e < 0.4 * sd then 'écoute partielle' end,
 case when {_plain('corrected')} = {_plain('st')} and sd > 0 and e < 0.5 * sd then 'validé sans écouter' end, case when why = 'français' then 'correction en français' when why is not null then 'correction : ' || why end,
 case when unknown_share > 0.7 and {_cer_sql('st', 'corrected')} > 0.5 then 'hors lexique et loin de la source' end], lambda x: x is not null) as drapeaux from g)
select id, annotateur, array_to_string(drapeaux, ' · ') as drapeaux, st as whisper, corrected as correction, sd::bigint as duree_ms, e as ecoute_ms, p as lectures, coalesce(note, 0) as rating from f where len(drapeaux) > 0"""
)
def review_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a sheet, judged by a lexicon of the training targets too."""
    lexicon = _table(spark, sf_dir, "train_pairs", "target_gcf").select(F.explode(F.split(tx.plain_text(F.col("target_gcf")), " ")).alias("word"))
    out = an.review_sheet(_log(spark, sf_dir), _table(spark, sf_dir, "segment_index"), lexicon)
    return out.withColumn("drapeaux", F.array_join("drapeaux", " · "))


@_query(f"select c, round({_cer_sql('ref', 't')}, 6) as cer from (select distinct c, t from segment_index) join temoins using (c)")
def witness_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of witness segments against their reference."""
    df = _table(spark, sf_dir, "segment_index", "c", "t").distinct().join(_table(spark, sf_dir, "temoins"), "c")
    return df.select("c", F.round(capped_cer(F.col("ref"), F.col("t")), 6).alias("cer"))


# ---- suggestions ---------------------------------------------------------------------------------------------------------------


def _dictionary(spark: SparkSession, sf_dir: str, table: str, column: str) -> DataFrame:
    words = _table(spark, sf_dir, table, column).select(F.explode(tx.tokenize(F.col(column))).alias("w")).where(F.rlike("w", F.lit(r"^\p{L}{2,}$")))
    return suggest.dictionary(words, "w")


_DICT = f"""with dict as (select lower(w) as word, count(*) as freq from (select unnest({_tokens(_norm('target_gcf'))}) as w from train_pairs) where regexp_matches(w, '^\\p{{L}}{{2,}}$') group by 1),
d as (select *, replace(translate(lower(word), {_lit(tx.FOLD_FROM)}, {_lit(tx.FOLD_TO)}), 'ß', 'ss') as folded from dict)"""
#: What is asked for: every word of the test sources.
_ASKED = f"""i as (select distinct w as input from (select unnest({_tokens(_norm('source_pseudo_ht'))}) as w from test_pairs) where regexp_matches(w, '^\\p{{L}}{{2,}}$')),
q as (select input, replace(translate(lower(input), {_lit(tx.FOLD_FROM)}, {_lit(tx.FOLD_TO)}), 'ß', 'ss') as a from i)"""


def _inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "test_pairs", "source_pseudo_ht").select(F.explode(tx.tokenize(F.col("source_pseudo_ht"))).alias("input"))
    return words.where(F.rlike("input", F.lit(r"^\p{L}{2,}$"))).distinct().withColumn("previous", F.lit("ka"))


@_query(_DICT + ", " + _ASKED + " select input, word, freq, rank from (select input, word, freq, row_number() over (partition by input order by freq desc, word)::int as rank from q join d on starts_with(folded, a) where length(input) >= 2) where rank <= 10")
def suggest_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suggest.prefix_matches(_inputs(spark, sf_dir), _dictionary(spark, sf_dir, "train_pairs", "target_gcf")).select("input", "word", "freq", "rank")


@_query(_DICT + ", " + _ASKED + " select input, word, freq, distance, rank from (select *, row_number() over (partition by input order by distance, freq desc, word)::int as rank from (select input, word, freq, levenshtein(a, folded) as distance from q join d on abs(length(folded) - length(a)) <= 2 where length(input) >= 3) where distance <= 2) where rank <= 5")
def suggest_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = suggest.fuzzy_matches(_inputs(spark, sf_dir), _dictionary(spark, sf_dir, "train_pairs", "target_gcf"))
    return df.select("input", "word", "freq", F.col("distance").cast("long").alias("distance"), "rank")


def _dictionary_score(word: str, text: str, freq: str, distance: str) -> str:
    fold = lambda x: f"replace(translate(lower({x}), {_lit(tx.FOLD_FROM)}, {_lit(tx.FOLD_TO)}), 'ß', 'ss')"
    return (
        f"({freq} + case when {distance} > 0 then (3 - {distance}) * 100000 else 0 end + case when starts_with({fold(word)}, {fold(text)}) then 50 else 0 end + case when length({word}) <= 6 then 10 else 0 end"
        f" - case when length({word}) > 12 then 10 else 0 end + case when regexp_matches(lower({word}), '[{tx.FOLD_FROM}]') then 5 else 0 end)"
    )


def _casing(model: str, word: str) -> str:
    letters = f"regexp_replace({model}, '[^\\p{{L}}]', '', 'g')"
    each = f"array_to_string(list_transform(range(1, length({word}) + 1), lambda i: case when i <= length({model}) and {model}[i] = upper({model}[i]) and {model}[i] <> lower({model}[i]) then upper({word}[i]) else {word}[i] end), '')"
    return f"case when length({letters}) >= 2 and {letters} = upper({letters}) then upper({word}) when regexp_matches({model}[1], '^\\p{{Lu}}') and {model}[2:] = lower({model}[2:]) then upper({word}[1]) || lower({word}[2:]) else {each} end"


#: Prefix matches, else near ones (letters without accents are never farther apart than with them), the likely next words' bonus,
#: three of these and two of the second dictionary, no word twice.
_MERGED = f""", pre as (select input, word, freq, 0 as distance from (select input, word, freq, row_number() over (partition by input order by freq desc, word) as rank from q join d on starts_with(folded, a) where length(input) >= 2) where rank <= 10),
close as (select input, word, freq, distance from (select *, row_number() over (partition by input order by distance, freq desc, word) as rank from (select input, word, freq, levenshtein(a, folded) as distance from q join d on abs(length(folded) - length(a)) <= 2 where length(input) >= 3 and input not in (select input from pre)) where distance <= 2) where rank <= 5),
nw as (select next from ({ORACLES['next_words']}) where prev = 'ka'),
sc as (select input, word, {_dictionary_score('word', 'input', 'freq', 'distance')} as score from (select * from pre union all select * from close) union all select input, next, 50 from q join nw on starts_with(lower(next), lower(input))),
one as (select input, word, row_number() over (partition by input order by sum(score) * 1.5 desc, word) as rank from sc group by 1, 2),
d2 as (select lower(w) as word, count(*) as freq from (select unnest({_tokens(_norm('text'))}) as w from heldout_items) where regexp_matches(w, '^\\p{{L}}{{2,}}$') group by 1),
s2 as (select input, word, freq from (select input, word, freq, row_number() over (partition by input order by freq desc, word) as rank from q join d2 on starts_with(word, a) where length(input) >= 3) where rank <= 2),
two as (select input, word, row_number() over (partition by input order by {_dictionary_score('word', 'input', 'freq', '0')} * 0.8 desc, word) as rank from s2),
both_ as (select input, word, 0 as side, rank from one where rank <= 3 union all select input, word, 1, rank from two where rank <= 2),
x as (select input, arg_min(word, side * 10 + rank) as word, min(side * 10 + rank) as o from both_ group by input, lower(word)),
y as (select input, word, row_number() over (partition by input order by o) as slot from x)
select input, slot::int as slot, {_casing('input', 'word')} as word from y where slot <= 5"""


@_query(_DICT + ", " + _ASKED + _MERGED)
def suggest_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creole first, then French, in the input's case."""
    words = _dictionary(spark, sf_dir, "train_pairs", "target_gcf")
    french = _dictionary(spark, sf_dir, "heldout_items", "text")
    return suggest.merged(suggest.primary_suggestions(_inputs(spark, sf_dir), words, next_words(spark, sf_dir)), suggest.secondary_suggestions(_inputs(spark, sf_dir), french))

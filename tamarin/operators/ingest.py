"""Building and resuming the corpus: to-do lists, index, lots, samples, calibration, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarin.functions.scores import bucket
from tamarin.functions.text import duration_ms, local_name, squeeze, tokenize


def todo(keys: DataFrame, done: DataFrame, key: str, text: str | None = None, retry_empty: bool = False, redo: bool = False) -> DataFrame:
    """Keys not yet done; with ``retry_empty`` also those done with a blank ``text``, with ``redo`` all."""
    if redo:
        return keys
    have = done.where(F.length(squeeze(F.coalesce(F.col(text), F.lit("")))) > 0) if retry_empty and text else done
    return keys.join(have.select(key).distinct(), key, "left_anti")


def preserve(new: DataFrame, kept: DataFrame, key: str, text: str) -> DataFrame:
    """New rows, but for keys that ``kept`` holds with a non-blank text: those stay as they are."""
    good = kept.where(F.length(squeeze(F.coalesce(F.col(text), F.lit("")))) > 0)
    return new.join(good.select(key).distinct(), key, "left_anti").unionByName(good)


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of the highest ``order`` per key."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).where("_rn = 1").drop("_rn")


def build_index(transcripts: DataFrame, rejects: DataFrame) -> DataFrame:
    """``c, t, m, d`` from ``transcripts(file_name, transcription)`` and ``rejects(file_name, motif, texte_rejete)``, unique by file:
    the reject's label and, where nothing else stands, its text; ``vide`` for other blank texts; ``rejet`` for a reject without label."""
    a = transcripts.select("file_name", squeeze(F.coalesce("transcription", F.lit(""))).alias("t0"), F.lit(True).alias("here"))
    b = rejects.select("file_name", F.coalesce("motif", F.lit("rejet")).alias("motif"), F.coalesce("texte_rejete", F.lit("")).alias("text"), F.lit(True).alias("out"))
    x = a.join(b, "file_name", "full_outer")
    t = F.when((F.coalesce("t0", F.lit("")) == "") & F.col("out"), F.col("text")).otherwise(F.coalesce("t0", F.lit("")))
    m = F.coalesce("motif", F.when(F.coalesce("t0", F.lit("")) == "", "vide").otherwise(""))
    return x.select(F.col("file_name").alias("c"), t.alias("t"), m.alias("m"), duration_ms(F.col("file_name")).alias("d"))


def index_summary(index: DataFrame) -> DataFrame:
    """Per label (``transcrit`` where empty): ``m, n, hours``."""
    m = F.coalesce(F.nullif("m", F.lit("")), F.lit("transcrit"))
    return index.groupBy(m.alias("m")).agg(F.count("*").alias("n"), F.round(F.sum(F.coalesce("d", F.lit(0))) / 3_600_000, 6).alias("hours"))


def known_witnesses(witnesses: DataFrame, index: DataFrame) -> DataFrame:
    return witnesses.join(index.select("c").distinct(), "c", "left_semi")


def hash_order(seed: str, *columns: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *columns).cast("binary"))


def sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows of lowest hash of their key: the same in every run and partitioning."""
    return df.orderBy(hash_order(seed, key), key).limit(n)


def lot(index: DataFrame, labels: list[str] | None, most: int, seed: str, longest_s: float = 25) -> DataFrame:
    """A reproducible lot: segments of the labels (all if none) with a length in (0, longest]: ``c, f, t, m, d``."""
    fit = index.where((F.col("d") > 0) & (F.col("d") <= longest_s * 1000))
    fit = fit.where(F.col("m").isin(labels)) if labels else fit
    return sample(fit, "c", most, seed).select("c", local_name(F.col("c")).alias("f"), "t", "m", "d")


def manifest(chosen: DataFrame, name: str, corpus: str, rate: int) -> DataFrame:
    """One row ``lot, corpus, debit, segments`` of a lot; its size is the lot's limit."""
    return chosen.agg(F.array_sort(F.collect_list(F.struct("c", "f", "t", "m", "d"))).alias("segments")).select(F.lit(name).alias("lot"), F.lit(corpus).alias("corpus"), F.lit(rate).alias("debit"), "segments")


def diagnostic_sheet(df: DataFrame, audio: str, text: str, n: int, seed: str, least_tokens: int = 5) -> DataFrame:
    """A sheet of ``n`` sampled rows of enough tokens: ``segment_id, audio_ref, whisper_ht, corrected, notes``."""
    fit = df.where(F.size(tokenize(F.col(text))) >= least_tokens).select(F.col(audio).alias("audio_ref"), F.col(text).alias("whisper_ht")).distinct()
    own = Window.orderBy("h", "audio_ref", "whisper_ht")  # over the sample's n rows only
    few = fit.withColumn("h", hash_order(seed, "audio_ref", "whisper_ht")).orderBy("h", "audio_ref", "whisper_ht").limit(n)
    return few.select(F.format_string("diag_%04d", F.row_number().over(own) - 1).alias("segment_id"), "audio_ref", "whisper_ht", F.lit("").alias("corrected"), F.lit("").alias("notes"))


#: Rows a calibration table may have.
MOST_BUCKETS = 1000


def calibration(df: DataFrame, confidence: str, wer: str) -> DataFrame:
    """``bucket, wer``: the mean error rate per tenth of confidence, 4 places; at most eleven rows."""
    return df.where(F.col(confidence).isNotNull() & F.col(wer).isNotNull()).groupBy(bucket(F.col(confidence)).alias("bucket")).agg(F.round(F.avg(wer), 4).alias("wer"))


def estimate_wer(df: DataFrame, confidence: str, table: DataFrame, into: str = "wer_estime") -> DataFrame:
    """``df`` with the error rate of its confidence's bucket, else of the nearest bucket (the lower on ties); half the missing
    confidence where the table is empty. The table, eleven rows from ``calibration``, becomes a literal; one of more than MOST_BUCKETS
    rows raises ValueError."""
    rows = sorted((float(r["bucket"]), r["wer"]) for r in table.limit(MOST_BUCKETS + 1).collect())
    if len(rows) > MOST_BUCKETS:
        raise ValueError(f"more than {MOST_BUCKETS} buckets")
    c = F.col(confidence)
    if not rows:
        return df.withColumn(into, F.round(F.greatest(F.lit(0.0), 0.5 * (1 - c)), 4))
    cells = F.array(*(F.struct(F.lit(b).alias("b"), F.lit(float(w)).alias("w")) for b, w in rows))
    own = F.floor(c * 10) / 10
    near = F.array_min(F.transform(cells, lambda x: F.struct(F.round(F.abs(x.b - c), 9).alias("d"), x.b.alias("b"), x.w.alias("w"))))
    mine = F.filter(cells, lambda x: F.abs(x.b - own) < 1e-6)
    return df.withColumn(into, F.coalesce(F.get(mine, 0).w, near.w))


def search(index: DataFrame, q: str = "", label: str = "") -> DataFrame:
    """Segments of a label whose text or path contains ``q``, case ignored."""
    out = index.where(F.col("m") == label) if label else index
    low = q.strip().lower()
    return out.where(F.contains(F.lower(F.coalesce("t", F.lit(""))), F.lit(low)) | F.contains(F.lower("c"), F.lit(low))) if low else out


def page(found: DataFrame, offset: int = 0, limit: int = 200) -> DataFrame:
    """One page in path order; the limit is kept between 1 and 500."""
    return found.orderBy("c", "t", "m", "d").offset(max(0, offset)).limit(max(1, min(limit, 500)))


def inject_witnesses(shown: DataFrame, index: DataFrame, witnesses: DataFrame, seen: DataFrame) -> DataFrame:
    """The page with up to two unseen witness segments at positions 3 and 10: ``position, c, t, m, d, temoin``. The page and the
    inserted rows are bounded by the page limit."""
    own = Window.orderBy("c", "t", "m", "d")
    rows = shown.select("c", "t", "m", "d", (F.row_number().over(own) - 1).cast("double").alias("p"), F.lit(False).alias("temoin"))
    cand = index.join(witnesses.select("c").distinct(), "c", "left_semi").join(shown.select("c"), "c", "left_anti").join(seen.select(F.col("id").alias("c")).distinct(), "c", "left_anti")
    two = cand.groupBy("c").agg(F.max(F.struct("t", "m", "d")).alias("s")).orderBy("c").limit(2)
    put = two.select("c", "s.*", ((F.row_number().over(Window.orderBy("c")) - 1) * 6 + 2.5).alias("p"), F.lit(True).alias("temoin"))
    return rows.unionByName(put).select((F.row_number().over(Window.orderBy("p", "c")) - 1).alias("position"), "c", "t", "m", "d", "temoin")


def page_with_total(found: DataFrame, offset: int = 0, limit: int = 200) -> DataFrame:
    """``page`` with ``total``, the number of rows found before the page was cut."""
    return page(found, offset, limit).crossJoin(F.broadcast(found.agg(F.count("*").alias("total"))))  # one row of one number


def known_paths(asked: DataFrame, path: str, index: DataFrame) -> DataFrame:
    """Of the rows of ``asked`` those whose ``path`` the index holds: no other file is ever served."""
    return asked.join(index.select(F.col("c").alias(path)).distinct(), path, "left_semi")


def witness_counts(witnesses: DataFrame, index: DataFrame) -> DataFrame:
    """One row ``known, outside``: witness rows inside and outside the index; with an empty index all count as known."""
    marked = witnesses.join(index.select("c", F.lit(True).alias("here")).distinct(), "c", "left")
    sums = marked.agg(F.count("here").alias("a"), F.count("*").alias("n"))
    return sums.crossJoin(F.broadcast(index.select(F.count("*").alias("size")))).select(F.when(F.col("size") == 0, F.col("n")).otherwise(F.col("a")).alias("known"), F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("n") - F.col("a")).alias("outside"))


def lot_listing(chosen: DataFrame, name: str, sizes: DataFrame | None = None) -> DataFrame:
    """One row of a lot for the listing of lots: ``lot, segments, minutes, octets``; ``sizes(c, length)`` gives the files' bytes."""
    rows = chosen if sizes is None else chosen.join(sizes.groupBy("c").agg(F.max("length").alias("length")), "c", "left")
    octets = F.lit(0).cast("long") if sizes is None else F.coalesce(F.sum("length"), F.lit(0))
    return rows.agg(F.count("*").alias("segments"), F.round(F.coalesce(F.sum("d"), F.lit(0)) / 60_000, 1).alias("minutes"), octets.alias("octets")).select(F.lit(name).alias("lot"), "segments", "minutes", "octets")


def progress(keys: DataFrame, done: DataFrame, rejected: DataFrame, key: str, seconds: float) -> DataFrame:
    """One row ``total, done, rejected, left, per_second, eta_s`` of a pass that has run for ``seconds``; null rates before the first
    row is done."""
    mark = lambda df, name: df.select(key, F.lit(True).alias(name)).distinct()
    x = keys.select(key).distinct().join(mark(done, "d"), key, "left").join(mark(rejected, "r"), key, "left")
    sums = x.agg(F.count("*").alias("total"), F.count("d").alias("done"), F.count(F.when(F.col("d").isNull(), F.col("r"))).alias("rejected"))
    sums = sums.withColumn("left", F.col("total") - F.col("done") - F.col("rejected")).withColumn("per_second", F.when(F.col("done") + F.col("rejected") > 0, (F.col("done") + F.col("rejected")) / F.lit(float(seconds))))
    return sums.withColumn("eta_s", F.round(F.col("left") / F.col("per_second"), 1)).withColumn("per_second", F.round("per_second", 3))


def audit_sheet(high: DataFrame, n: int, seed: str) -> DataFrame:
    """A sample of high-confidence segments for people to check, its two last columns blank: ``id, audio, whisper_ht, gcf_corrige,
    confiance, wer_estime, verite_terrain, verdict``."""
    cols = ("id", "audio", "whisper_ht", "gcf_corrige", "confiance", "wer_estime")
    return sample(high.select(*cols), "id", n, seed).select(*cols, F.lit("").alias("verite_terrain"), F.lit("").alias("verdict"))

"""The annotation log: session versions, latest rows, service figures, export and annotator quality."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamarin.functions.metrics import capped_cer
from tamarin.functions.text import iso_time, plain_text, strip
from tamarin.operators.gate import rejection
from tamarin.operators.ranks import medians

#: Events of one segment and annotator less than so many milliseconds apart replace each other.
SESSION_MS = 3_600_000
#: A correction is due again after so long, for so many in a thousand.
RETEST_MS, RETEST_RATE = 14 * 24 * 3_600_000, 30


def filled(c: Column) -> Column:
    """Whether a correction has visible text."""
    return strip(F.coalesce(c, F.lit(""))) != ""


def versions(events: DataFrame, gap_ms: int = SESSION_MS) -> DataFrame:
    """Session versions of the log: within one (id, annotateur), an event less than ``gap_ms`` before the next one is replaced by it.
    Adds ``version`` from 1 and ``last_version``.

    A null ``at`` counts as 0; events of one time go by arrival (``recu_le``), then text. Rows sent twice replace each other. One
    window sorts each (id, annotateur); ids spread a hot annotator over all tasks.
    """
    at = F.coalesce(F.col("at"), F.lit(0))
    own = Window.partitionBy("id", "annotateur").orderBy(at, "recu_le", "corrected", "note")
    kept = events.withColumn("_next", F.lead(at).over(own)).where(F.col("_next").isNull() | (F.col("_next") - at >= gap_ms)).drop("_next")
    every = Window.partitionBy("id", "annotateur")
    return kept.withColumn("version", F.row_number().over(own)).withColumn("last_version", F.max("version").over(every))


def latest(v: DataFrame) -> DataFrame:
    """The latest version per (id, annotateur)."""
    return v.where("version = last_version")


def self_agreement(v: DataFrame) -> DataFrame:
    """First against last version where there are several and the first is filled: ``id, annotateur, cer``; an unfilled last version
    is no agreement."""
    ends = v.where("last_version > 1").groupBy("id", "annotateur").agg(F.min_by("corrected", "version").alias("first"), F.max_by("corrected", "version").alias("last"))
    return ends.where(filled(F.col("first")) & filled(F.col("last"))).select("id", "annotateur", capped_cer(F.col("first"), F.col("last")).alias("cer"))


def retest_due(v: DataFrame, now_ms: int, rate: int = RETEST_RATE, after_ms: int = RETEST_MS) -> DataFrame:
    """Single filled versions older than ``after_ms`` whose hash falls under ``rate`` in a thousand: ``id, annotateur``."""
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", "id", "annotateur").cast("binary")), 1, 8), 16, 10).cast("long") % 1000
    return v.where((F.col("last_version") == 1) & filled(F.col("corrected")) & (F.lit(now_ms) - F.coalesce("at", F.lit(0)) >= after_ms) & (draw < rate)).select("id", "annotateur")


def service_stats(v: DataFrame, index: DataFrame, witnesses: DataFrame) -> DataFrame:
    """One row of figures: segments, covered, versions, repeats, doubles, validated, rejected, witnesses, annotators."""
    text = filled(F.col("corrected"))
    pairs = v.groupBy("id", "annotateur").agg(
        F.count("*").alias("n"), F.count_if(text).alias("texts"), F.max_by(text, "version").alias("filled"), F.max_by("note", "version").alias("note")
    )
    per = pairs.groupBy("id").agg(
        F.sum("texts").alias("texts"), F.sum(F.col("n") - 1).alias("repeats"), F.count_if("filled").alias("filled"),
        F.bool_or(F.col("note") == 5).alias("five"), F.bool_or(F.col("note") == 1).alias("one"),
    )
    sums = per.agg(
        F.count_if(F.col("filled") > 0).alias("corriges"), F.coalesce(F.sum("texts"), F.lit(0)).alias("versions"), F.coalesce(F.sum("repeats"), F.lit(0)).alias("reprises"),
        F.count_if(F.col("filled") > 1).alias("doubles"), F.count_if("five").alias("validees"), F.count_if("one").alias("rebuts"),
    )
    who = v.select("annotateur").where("annotateur is not null").distinct().agg(F.count("*").alias("annotateurs"))
    parts = [sums, who, index.select(F.count("*").alias("segments")), witnesses.select(F.count("*").alias("temoins"))]
    every = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)  # four rows
    return every.agg(*(F.max(c).alias(c) for c in every.columns))


def others_count(v: DataFrame, me: str) -> DataFrame:
    """Per segment, annotators other than ``me`` whose latest version is filled: ``id, autres``."""
    return latest(v).groupBy("id").agg(F.count_if((F.col("annotateur") != me) & filled(F.col("corrected"))).alias("autres"))


def status(note: Column, corrected: Column) -> Column:
    note = F.coalesce(note, F.lit(0))
    return F.when(note == 5, "human_validated").when(note == 1, "unusable").when(note != 0, "human_reviewed").when(filled(corrected), "draft").otherwise("")


#: Milestones of an annotation, in export order.
MILESTONES = ("ouvert", "ecoute", "edite", "note", "valide")


def js_time(ms: Column) -> Column:
    """Epoch milliseconds as UTC time with milliseconds and Z; empty for 0."""
    return F.when(ms == 0, "").otherwise(F.concat(F.date_format(F.to_utc_timestamp(F.timestamp_millis(ms), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("Z")))


def export(v: DataFrame, index: DataFrame, *more: str) -> DataFrame:
    """The 18 export columns, one row per version, and ``more`` of its columns; unknown segments keep empty source columns. An index
    path held several times gives its greatest row."""
    seg = index.groupBy(F.col("c").alias("id")).agg(F.max(F.struct(F.coalesce("t", F.lit("")).alias("t"), F.coalesce("m", F.lit("")).alias("m"), F.coalesce("d", F.lit(0)).alias("d"))).alias("s"))
    note = F.coalesce("note", F.lit(0))
    stamp = lambda k: iso_time(F.element_at("jalons", k))
    return v.join(seg, "id", "left").select(
        F.col("id").alias("segment_id"), F.coalesce("s.t", F.lit("")).alias("whisper"), F.coalesce("s.m", F.lit("")).alias("motif"), F.coalesce("s.d", F.lit(0)).cast("long").alias("duree_ms"),
        F.coalesce("corrected", F.lit("")).alias("corrected"), F.coalesce("notes", F.lit("")).alias("notes"), "annotateur", F.col("version").cast("int").alias("version"),
        F.when(note != 0, note.cast("string")).otherwise("").alias("rating"), status(F.col("note"), F.col("corrected")).alias("status"), F.when(F.col("vote"), "1").otherwise("").alias("vote"),
        F.coalesce("ecoute_ms", F.lit(0)).cast("long").alias("ecoute_ms"), F.coalesce("lectures", F.lit(0)).cast("int").alias("lectures"), *(F.coalesce(stamp(k), F.lit("")).alias(f"{k}_a") for k in MILESTONES), *more,
    )


def client_export(v: DataFrame, index: DataFrame) -> DataFrame:
    """The 17 columns of the page's own export, no version among them: the latest version of each segment and annotator that was
    worked on, which has a text, a note or was skipped. Times end in Z and have milliseconds."""
    worked = filled(F.col("corrected")) | F.coalesce("skipped", F.lit(False)) | (F.coalesce("note", F.lit(0)) != 0)
    rows = latest(v).where(worked)
    stamps = {f"{k}_a": F.coalesce(js_time(F.element_at("jalons", k)), F.lit("")) for k in MILESTONES}
    out = export(rows.select(*(c for c in rows.columns if c != "jalons"), F.create_map().cast("map<string,bigint>").alias("jalons"), *(x.alias(f"_{c}") for c, x in stamps.items())), index, *(f"_{c}" for c in stamps))
    return out.drop("version", *stamps).withColumnsRenamed({f"_{c}": c for c in stamps})


def clean_milestones(jalons: Column) -> Column:
    """Milestones with alphabetic names and non-negative values."""
    return F.map_filter(jalons, lambda k, t: F.rlike(k, F.lit(r"^\p{L}+$")) & (t >= 0))


def guard_events(events: DataFrame, index: DataFrame) -> DataFrame:
    """Events of known segments, the note clamped to 0..5, milestones cleaned."""
    return events.join(index.select(F.col("c").alias("id")).distinct(), "id", "left_semi").withColumns({"note": F.greatest(F.lit(0), F.least(F.lit(5), F.coalesce("note", F.lit(0)))), "jalons": clean_milestones(F.col("jalons"))})


def flags(text: Column, source: Column, duration: Column, listened: Column, plays: Column, note: Column, unknown_share: Column | None = None) -> Column:
    """Ordered doubts about a correction; an empty text has none. ``unknown_share`` is the share of its longer words outside a
    lexicon, null where that does not apply."""
    d, e, p = F.coalesce(duration, F.lit(0)), F.coalesce(listened, F.lit(0)), F.coalesce(plays, F.lit(0))
    why = rejection(text)
    marks = F.array_compact(
        F.array(
            F.when((F.coalesce(note, F.lit(0)) == 5) & (d > 0) & ((p == 0) | (e < 0.5 * d)), "5 étoiles sans avoir écouté"),
            F.when(p == 0, "jamais écouté").when((d > 0) & (e < 0.4 * d), "écoute partielle"),
            F.when((plain_text(text) == plain_text(source)) & (d > 0) & (e < 0.5 * d), "validé sans écouter"),
            F.when(why == "français", "correction en français").when(why.isNotNull(), F.concat(F.lit("correction : "), why)),
            F.when((unknown_share > 0.7) & (capped_cer(source, text) > 0.5), "hors lexique et loin de la source") if unknown_share is not None else F.lit(None).cast("string"),
        )
    )
    return F.when(filled(text), marks).otherwise(F.array().cast("array<string>"))


def unknown_shares(rows: DataFrame, text: str, lexicon: DataFrame, *keys: str) -> DataFrame:
    """``keys..., unknown_share`` of rows with at least four words longer than two letters; ``lexicon(word)``. A join, so the lexicon
    may be of any size."""
    words = rows.select(*keys, F.explode(F.filter(F.split(plain_text(F.col(text)), " "), lambda w: F.length(w) > 2)).alias("word"))
    known = lexicon.select(F.lower("word").alias("word"), F.lit(True).alias("known")).distinct()
    per = words.join(known, "word", "left").groupBy(*keys).agg(F.count("*").alias("n"), F.count("known").alias("k"))
    return per.where("n >= 4").select(*keys, ((F.col("n") - F.col("k")) / F.col("n")).alias("unknown_share"))


def _one_segment(index: DataFrame) -> DataFrame:
    return index.groupBy(F.col("c").alias("id")).agg(F.max(F.struct(F.coalesce("d", F.lit(0)).alias("d"), F.coalesce("t", F.lit("")).alias("t"))).alias("seg"))


def review_sheet(v: DataFrame, index: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Latest filled versions with at least one doubt: ``id, annotateur, drapeaux ARRAY<STRING>, ...``."""
    rows = latest(v).where(filled(F.col("corrected"))).join(_one_segment(index), "id", "left")
    share = None
    if lexicon is not None:
        rows = rows.join(unknown_shares(rows, "corrected", lexicon, "id", "annotateur"), ["id", "annotateur"], "left")
        share = F.col("unknown_share")
    marks = flags(F.col("corrected"), F.col("seg.t"), F.col("seg.d"), F.col("ecoute_ms"), F.col("lectures"), F.col("note"), share)
    return rows.withColumn("drapeaux", marks).where(F.size("drapeaux") > 0).select(
        "id", "annotateur", "drapeaux", F.coalesce("seg.t", F.lit("")).alias("whisper"), F.col("corrected").alias("correction"), F.coalesce("seg.d", F.lit(0)).cast("long").alias("duree_ms"),
        F.coalesce("ecoute_ms", F.lit(0)).alias("ecoute_ms"), F.coalesce("lectures", F.lit(0)).alias("lectures"), F.coalesce("note", F.lit(0)).alias("rating"),
    )


def annotator_quality(v: DataFrame, index: DataFrame, witnesses: DataFrame) -> DataFrame:
    """Per annotator: corrections, rejects, validated, and the medians of note, listened share (at most 2), distance to the own first
    version and to the witness text. Medians are exact and computed from value counts, so a hot annotator's values are never held
    in one place; witness texts are joined by key."""
    last = latest(v).join(_one_segment(index), "id", "left")
    wit = witnesses.groupBy(F.col("c").alias("id")).agg(F.max("ref").alias("ref"))
    text = filled(F.col("corrected"))
    counts = last.groupBy("annotateur").agg(F.count_if(text).alias("corrections"), F.count_if(F.col("note") == 1).alias("rebuts"), F.count_if(F.col("note") == 5).alias("validees"))
    of = lambda df, what, value: df.select(F.struct(F.col("annotateur"), F.lit(what).alias("what")).alias("name"), value.cast("double").alias("v"))
    values = (
        of(last.where("note <> 0"), "note", F.col("note"))
        .unionByName(of(last.where(text & (F.col("seg.d") > 0)), "ecoute", F.least(F.lit(2.0), F.coalesce("ecoute_ms", F.lit(0)) / F.col("seg.d"))))
        .unionByName(of(self_agreement(v), "reprise", F.col("cer")))
        .unionByName(of(last.where(text).join(wit, "id"), "temoin", capped_cer(F.col("ref"), F.col("corrected"))))
    )
    m = medians(values).select(F.col("name.annotateur").alias("annotateur"), F.col("name.what").alias("what"), "median")
    wide = m.groupBy("annotateur").pivot("what", ["note", "ecoute", "reprise", "temoin"]).agg(F.max("median"))
    return counts.join(wide, counts["annotateur"].eqNullSafe(wide["annotateur"]), "left").drop(wide["annotateur"])

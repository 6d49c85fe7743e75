"""Scans: tables, tolerant JSON lines, sheets, correction logs, lexicons, audio listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tamarin.functions.scores import first_present
from tamarin.functions.text import normalize_surface

#: Names of text columns and of score columns, in the order they are tried.
TEXT_COLUMNS = ("text", "transcription", "sentence", "texte", "transcript", "whisper", "content")
LOGPROB, RATIO, NO_SPEECH = ["avg_logprob", "logprob", "mean_logprob"], ["compression_ratio"], ["no_speech_prob", "no_speech"]

CORRECTION = "id string, annotateur string, corrected string, notes string, skipped boolean, note int, vote boolean, jalons map<string,bigint>, ecoute_ms bigint, lectures int, duree bigint, at bigint"


def text_column(columns: list[str], wanted: str | None = None, audio: tuple[str, ...] = ("audio", "file", "path")) -> str:
    """The wanted column or KeyError; else the first usual name, case ignored; else the first column that is no audio."""
    if wanted:
        if wanted not in columns:
            raise KeyError(f"no column {wanted!r} among {columns}")
        return wanted
    low = {c.lower(): c for c in reversed(columns)}
    for name in TEXT_COLUMNS:
        if name in low:
            return low[name]
    for c in columns:
        if c.lower() not in audio:
            return c
    raise KeyError(f"no text column among {columns}")


def table(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A parquet table; with ``columns`` only those are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def segments(df: DataFrame) -> DataFrame:
    """``df`` with the score columns under their own names, null where no candidate exists."""
    have = df.columns
    return df.withColumns({"avg_logprob": first_present(have, LOGPROB), "compression_ratio": first_present(have, RATIO), "no_speech_prob": first_present(have, NO_SPEECH)})


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def tolerant_json_lines(spark: SparkSession, path: str, schema: str, key: str | None = None) -> DataFrame:
    """JSON lines with a byte-order mark, blank lines and broken lines: those are dropped. With ``key``, the last line of a key wins
    within a file, and over files the last file by name; lines without the key go."""
    kind = T._parse_datatype_string(schema)
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    one = F.from_json(F.regexp_replace("value", "^\ufeff", ""), T.StructType([*kind.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = raw.where(F.trim("value") != "").withColumn("r", one).where("r is not null and r._bad is null")
    names = [f.name for f in kind.fields]
    if key is None:
        return rows.select(*(F.col(f"r.{n}").alias(n) for n in names))
    best = rows.where(F.col(f"r.{key}").isNotNull()).groupBy(F.col(f"r.{key}").alias("_k")).agg(F.max_by("r", F.struct("_file", "_block", "_line")).alias("r"))
    return best.select(*(F.col(f"r.{n}").alias(n) for n in names))


def json_object(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def rules_file(spark: SparkSession, path: str) -> DataFrame:
    """The rules of a rule file, missing fields at their defaults."""
    df = json_object(spark, path).select(F.explode("rules").alias("r"))
    have = df.schema["r"].dataType.fieldNames()
    defaults = {"kind": ("string", "word"), "support": ("int", 0), "src_total": ("int", 0), "confidence": ("double", 0.0), "ngram": ("int", 1), "left_context": ("string", None), "right_context": ("string", None), "examples": ("array<string>", None), "status": ("string", "mined"), "note": ("string", "")}
    cols = [F.col("r.src").alias("src"), F.col("r.tgt").alias("tgt")]
    for name, (kind, value) in defaults.items():
        given = F.col(f"r.{name}").cast(kind) if name in have else F.lit(None).cast(kind)
        fallback = F.array().cast("array<string>") if name == "examples" else F.lit(value).cast(kind)
        cols.append(F.coalesce(given, fallback).alias(name))
    return df.select(*cols)


def sheet(spark: SparkSession, path: str) -> DataFrame:
    """A CSV sheet with a header, all columns text, quotes doubled, values over several lines."""
    return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)


def corrected_pairs(df: DataFrame, source: str = "whisper_ht", target: str = "corrected") -> DataFrame:
    """``src, tgt`` normalised, rows with an empty side dropped."""
    pairs = df.select(normalize_surface(F.col(source)).alias("src"), normalize_surface(F.col(target)).alias("tgt"))
    return pairs.where("src <> '' and tgt <> ''")


def skipped_pairs(df: DataFrame, source: str = "whisper_ht", target: str = "corrected") -> DataFrame:
    """One row ``kept, skipped``: how many rows ``corrected_pairs`` takes and how many it drops."""
    whole = (normalize_surface(F.col(source)) != "") & (normalize_surface(F.col(target)) != "")
    return df.select(whole.alias("whole")).agg(F.count_if("whole").alias("kept"), F.count_if(~F.col("whole")).alias("skipped"))


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """The correction log of a directory of JSON lines; a missing annotator is the file's stem."""
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.jsonl?)?$", 1)
    df = spark.read.schema(CORRECTION).json(path)
    return df.withColumn("annotateur", F.coalesce("annotateur", F.url_decode(stem)))


def lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``word`` of a JSON array of [word, frequency]; empty if the file is missing."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "word string")
    raw = spark.read.option("wholetext", True).text(path)
    pairs = F.explode(F.from_json("value", "array<array<string>>")).alias("p")
    return raw.select(pairs).select(F.lower(F.get("p", 0)).alias("word")).where("word is not null").distinct()


def audio_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = (".mp3", ".wav", ".flac", ".ogg", ".m4a")) -> DataFrame:
    """``path, length`` of all audio files below ``path`` in the order of their paths; their bytes are never read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    return df.where(F.rlike(F.lower("path"), F.lit("(" + "|".join(s.replace(".", r"\.") for s in suffixes) + ")$"))).orderBy("path")


def lot_segments(spark: SparkSession, path: str) -> DataFrame:
    return json_object(spark, path).select(F.explode("segments").alias("s")).select("s.*")

"""Sinks: JSON lines, sheets, export, rule files, lots, report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_text_file(spark: SparkSession, path: str, text: str) -> None:
    """One small file, through the file system of its path."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write JSON lines; the number of rows, counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).option("ignoreNullFields", False).json(path)
    return seen.get["n"]


def json_object(df: DataFrame, path: str) -> None:
    """The single row of ``df`` as a JSON object."""
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(2).collect()
    if len(rows) != 1:
        raise ValueError("exactly one row is wanted")
    write_text_file(df.sparkSession, path, rows[0]["j"])


#: Quotes doubled, blanks at the ends kept; an empty value is an empty field, as a missing one is.
_SHEET = {"header": True, "quote": '"', "escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def sorted_json_lines(df: DataFrame, path: str, *keys: str, mode: str = "errorifexists") -> None:
    """JSON lines in the order of ``keys``: parts in the order of their names, each sorted; no single task sorts the table."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).option("ignoreNullFields", False).json(path)


def split_sheets(df: DataFrame, path: str, split: str = "split") -> None:
    """One folder of CSV parts per split."""
    df.write.partitionBy(split).options(**_SHEET).csv(path)


def sheet(df: DataFrame, path: str, crlf: bool = False) -> None:
    """CSV with a header, RFC 4180 quoting."""
    df.write.options(**_SHEET).option("lineSep", "\r\n" if crlf else "\n").csv(path)


def rules_file(rules: DataFrame, path: str, direction: str = "ht->gcf", meta: dict | None = None, most: int = 200_000) -> int:
    """The rule envelope as one JSON file; rule sets above ``most`` are refused."""
    rows = [json.loads(r["j"]) for r in rules.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("j")).limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    rows.sort(key=lambda r: (-r["ngram"], -r["confidence"], -r["support"], r["src"], r["tgt"]))
    write_text_file(rules.sparkSession, path, json.dumps({"schema_version": "1.0", "direction": direction, "meta": meta or {}, "n_rules": len(rows), "rules": rows}, ensure_ascii=False, indent=1))
    return len(rows)


def annotator_partitions(df: DataFrame, path: str) -> None:
    """Rewrite only the annotators that occur in ``df``, sorted by (id, at)."""
    df.repartition("annotateur").sortWithinPartitions("annotateur", "id", "at").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("annotateur").json(path)


def residual_report(residuals: DataFrame, path: str, key: str, top: DataFrame, samples: int = 500) -> None:
    """Residual blocks: their number, the most frequent, and a bounded sample."""
    n = residuals.count()
    some = [r.asDict() for r in residuals.orderBy(key, "src", "tgt").limit(samples).collect()]
    write_text_file(residuals.sparkSession, path, json.dumps({"n_residual_blocks": n, "top_unexplained": [r.asDict() for r in top.limit(200).collect()], "samples": some}, ensure_ascii=False, default=str))


def markdown_report(spark: SparkSession, path: str, title: str, sections: dict[str, DataFrame], most: int = 25) -> str:
    """Small aggregates as Markdown tables; at most ``most`` rows of each."""
    out = [f"# {title}"]
    for name, df in sections.items():
        rows = df.limit(most).collect()
        out += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|").replace("\n", " ") for v in r) + " |" for r in rows] or ["_none_"]
    text = "\n".join(out) + "\n"
    write_text_file(spark, path, text)
    return text

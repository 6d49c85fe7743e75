"""The pipeline's report: its stages' small aggregates under one heading each, as Markdown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarin.sources.writers import markdown_report

#: Rows that each list of the report shows.
RULES, RESIDUALS, EXAMPLES = 25, 20, 8


def pipeline_report(
    spark: SparkSession,
    path: str,
    rules: DataFrame | None = None,
    residuals: DataFrame | None = None,
    splits: DataFrame | None = None,
    evaluation: DataFrame | None = None,
    mismatches: DataFrame | None = None,
    statistics: DataFrame | None = None,
    rejected: DataFrame | None = None,
    deliverables: dict[str, str] | None = None,
) -> str:
    """Write the report of whatever stages have run, and return it. A stage without its table says so; ``deliverables`` maps names to
    paths, of which it tells the size or that they are missing. All lists are cut on the executors, so only their rows are sent."""
    missing = spark.createDataFrame([("stage has not run",)], "note string")
    top, unconfirmed = missing, missing
    if rules is not None:
        top = rules.where("support > 0").orderBy(F.desc("support"), "src", "tgt").select("src", "tgt", "support", F.round("confidence", 2).alias("confidence")).limit(RULES)
        unconfirmed = rules.where("status = 'seed_unconfirmed'").agg(F.count("*").alias("rules_never_observed"))
    left = missing if residuals is None else residuals.groupBy("src", "tgt", "op").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "src", "tgt", "op").limit(RESIDUALS)
    sections = {
        "Rules most observed": top,
        "Starting rules without evidence": unconfirmed,
        "Differences no rule covers": left,
        "Pairs per split": splits if splits is not None else missing,
        "Correction, before and after": evaluation if evaluation is not None else missing,
        "Examples of errors left": mismatches.limit(EXAMPLES) if mismatches is not None else missing,
        "Segments, kept and of high confidence": statistics if statistics is not None else missing,
        "Reasons of rejection": rejected if rejected is not None else missing,
        "Deliverables": spark.createDataFrame([(name, _size(spark, at)) for name, at in (deliverables or {}).items()], "file string, size string"),
    }
    return markdown_report(spark, path, "Aligned corpus", sections, most=RULES)


def _size(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return f"{fs.getContentSummary(p).getLength() / 1e6:.1f} MB" if fs.exists(p) else "missing"

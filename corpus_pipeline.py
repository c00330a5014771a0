"""The corpus pipeline: quality rules, near duplicates, benchmark passages,
secrets, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the one
before kept and returns a frame with the columns of ``documents``; the last
returns the packed pieces. ``run`` writes each stage's rows as Parquet to the
shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatline.llm import decontaminate, jaccard, packing, quality, secrets
from beatline.llm.common import pick, table
from beatline.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEEP = COLUMNS[1:]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.quality(docs, table(spark, sf_dir, "labels"), keep=KEEP).filter("kept").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents that of least id stays. Of rows
    with the same id, or none, and the same text one stays, that of least other
    columns. Rows without an id are in no component."""
    found = jaccard.jaccard_components(docs)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    kinds = dict(docs.dtypes)
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    # Grouped before the join, so that rows without an id are spread by their text.
    once = pick(docs, **{c: (c, kinds[c]) for c in COLUMNS}).groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest"))
    return once.select("doc_id", "text", "rest.*").join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    out = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=KEEP)
    return out.filter("not contaminated").select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by ``[kind]`` in the text, and ``n_chars`` follows."""
    out = secrets.find_secrets(docs, keep=KEEP)
    text = F.when(F.size("found") > 0, secrets.redacted(F.col("text"), F.col("found"))).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn(
        "n_chars", F.when(F.size("found") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into bins."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: The stages hash n-grams, search for bins and follow links: not SQL. The
#: pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

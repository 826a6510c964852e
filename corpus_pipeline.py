"""The training-data pipeline: five stages of the operators in ``shelfline.llm``.

``STAGES`` holds (name, function) pairs; each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of documents;
columns that documents have beside the known ones keep their values, whatever
they are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.common import staged
from shelfline.llm.line_dedup import line_dedup
from shelfline.llm.mixing import mix_sources
from shelfline.llm.packing import pack_best_fit
from shelfline.llm.quality_rules import quality_rules
from shelfline.llm.simhash import keep_rows


#: Columns that the operators know; all others travel as one.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _packed(docs: DataFrame) -> DataFrame:
    """The known columns and the others as one struct, so that none of them meets a column an operator adds or drops."""
    others = [c for c in docs.columns if c not in KNOWN]
    known = [c for c in docs.columns if c in KNOWN]
    return docs.select(*known, F.struct(*[F.col(f"`{c}`") for c in others]).alias("other_columns")) if others else docs


def _unpacked(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.select(*[F.col(c) if c in KNOWN else F.col(f"other_columns.`{c}`").alias(c) for c in columns])


def _with_text(docs: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """``docs`` with another text; ``n_chars`` follows it where there is one."""
    new = {"text": F.col(text)}
    if "n_chars" in columns:
        new["n_chars"] = F.length(text).cast("long")
    return _unpacked(docs.withColumns(new), columns)


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; kept ones lose their failing lines."""
    return _with_text(quality_rules(_packed(docs)).filter("kept"), "clean_text", docs.columns)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share go; no document does."""
    return _with_text(line_dedup(_packed(docs)), "kept_text", docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; without a doc_id it gets a negative one from its text, so that its pieces can be told apart."""
    own = -F.shiftrightunsigned(F.xxhash64("text"), 1) - 1
    return _unpacked(keep_rows(_packed(docs)).withColumn("doc_id", F.coalesce("doc_id", own)), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as many times as the mix takes it."""
    mixed = mix_sources(_packed(docs)).filter("copies > 0")
    return _unpacked(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the packed sequences."""
    return pack_best_fit(docs)


STAGES = [
    ("quality_rules", rules_stage),
    ("line_dedup", lines_stage),
    ("simhash_dedup", simhash_stage),
    ("mix_sources", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Line dedup hashes, SimHash and best fit have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

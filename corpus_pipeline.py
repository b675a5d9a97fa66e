"""The training-data pipeline: five stages from documents to packed sequences.

Every stage takes the table its predecessor wrote. All but the last return rows of the documents
table as they were given, without the rows the stage decides against:

1. language_id drops documents whose language is rejected (no letter, or below the calibrated
   threshold of a model trained on the stage's own documents; where no row names a language there is
   no model, and all rows stay);
2. quality drops documents that the weakly supervised classifier scores below one half;
3. near_duplicates keeps one row of each group of near copies: the one with the smallest id (of rows
   that share that id, or of rows without one where no row has an id, any one);
4. decontamination drops documents that hold a benchmark item;
5. packing cuts and packs the tokens of what is left.

The stages read two tables at most: their documents and, in stage 4, the benchmark. Null ids, empty
texts and repeated rows are treated as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import decontamination, langid, packing, quality, simhash
from tidegate.llm.registry import table, tokenizer_path
from tidegate.state.shared import shared_root, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs, F.lit(True))
    if not model.languages:  # nothing says what a language is: no reason to drop a document
        return docs
    return langid.judge(docs, model).filter("NOT rejected").select("row.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.judge(docs, quality.train(docs)).filter("kept").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # every row gets a key of its own, written so that it stays the same; an id may be null or repeated
    keyed = stage(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("key")), f"{shared_root(spark)}/keyed")
    order = F.struct(F.col("row.doc_id").isNull().alias("no_id"), "row.doc_id", "key")
    grouped = simhash.near_duplicates(keyed.select(order.alias("id"), "row.text"), "id", shingle=3, radius=3)
    others = grouped.filter("component_id.key <> doc_id.key").select("doc_id.key")
    return keyed.join(others, "key", "left_anti").select("row.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_decontamination),
    ("packing", pack),
]

# trained models, fingerprints by majority and token ids cannot be written in SQL
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each but the last is written to the shared folder and read again."""
    folder = shared_root(spark)
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = stage(work(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

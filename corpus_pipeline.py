"""From raw documents to packed sequences: stages that each call one operator on all that the one before has kept.

Every stage but the last returns the columns of documents; what a stage returns is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalume.llm import jaccard, language, mixing, packing, quality
from catalume.llm.common import stored
from catalume.llm.queries import tokenizer


def aside(docs: DataFrame, *names: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs with its columns of these names, which an operator adds, under other names; and what gives the columns of docs back."""
    own = {c: f"__own_{c}" for c in names if c in docs.columns}
    return docs.withColumnsRenamed(own), lambda out: out.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep. Null and empty texts go; ties and repeated rows are judged alike; no rows give no rows."""
    docs, back = aside(docs, "quality")
    return back(quality.judged(docs).where("quality.kept"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a language that was learned; for those that carry a lang, the predicted one has to be it or in doubt.

    Null texts and those without a letter go; repeated rows are judged alike; no rows give no rows.
    """
    docs, back = aside(docs, "lang_pred", "score", "held_out")
    agrees = F.col("lang").isNull() | (F.col("lang") == F.col("lang_pred")) | (F.col("score") < 0.9)
    return back(language.identified(docs).where((F.col("lang_pred") != "und") & agrees))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id; rows that share only their doc_id go by their texts, and those without words stay."""
    return jaccard.one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. Null and empty texts have no words, and may be taken or left; repeated rows go together; no rows give no rows."""
    docs, back = aside(docs, "mix")
    return back(mixing.repeated(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in its sequence, repeated rows as often as they come. Null and empty texts are their end id alone; no rows give no rows."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: Expectation-maximisation, iterated components and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. An empty table gives no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

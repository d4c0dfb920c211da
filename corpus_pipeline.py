"""A corpus made ready for training, stage by stage.

Every stage reads all that the one before it kept. Of a document the columns stay as they are,
but for the text where lines are cut, and ``n_chars`` with it; the last stage has token ids in
place of the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import bpe, decontaminate, language, line_templates, ngram_join
from orderloom.llm.queries import WORDS_49K, language_model, table
from orderloom.llm.shared import without_keys
from orderloom.session import handed_over


#: Rows that Spark hands to a Python worker at a time. They carry whole texts, which both sides hold.
BATCH_ROWS = 1000
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(spark: SparkSession) -> None:
    """Bounds what lies between Spark and its Python workers; results do not depend on it.

    Stages are lazy, so the setting stays with the session. A smaller one of the user's is kept;
    0 and less mean without a limit.
    """
    now = int(spark.conf.get(BATCH))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(BATCH, str(BATCH_ROWS))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts that are null or have no letter go."""
    in_small_batches(spark)
    known = language.identified(docs, language_model(docs))
    return known.where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines cut, but for one occurrence of each; documents of nothing else go."""
    cut = line_templates.without_recurring_lines(docs)
    left = cut.where((F.col("n_dropped") == 0) | F.col("text").rlike(r"\S"))
    changed = F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long"))
    return left.withColumn("n_chars", F.coalesce(changed, "n_chars")).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id."""
    in_small_batches(spark)
    groups = ngram_join.similar_groups(docs)
    return without_keys(docs, groups.where("doc_id <> component_id"), "doc_id")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    in_small_batches(spark)
    found = decontaminate.with_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select(*docs.columns)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed as little-endian unsigned 32-bit integers, and the digest of what they
    decode to."""
    in_small_batches(spark)
    found = bpe.encoded(docs, WORDS_49K)
    return found.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("language_id", in_a_language),
    ("line_dedup", without_boilerplate),
    ("near_copies", without_near_copies),
    ("decontamination", without_benchmarks),
    ("encoding", as_tokens),
]
#: Model scores, groups of similar sets, edit distances and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = handed_over(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before kept. `docs` has at least doc_id,
text and n_chars; all stages but the last return the same columns. Rows without a doc_id and null texts pass through as
each operator's docstring says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recall_lens.llm import language, near_duplicates, packing, repeats, toxicity
from recall_lens.llm.staging import Staging

#: No SQL learns from labels, so the stages are tested against brute force instead.
ORACLE_SQL = None

_MARK = "text_digest_of_the_pipeline"


_READ = ("doc_id", "text", "lang", "n_chars")


def _plain(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """The documents with all columns that no stage reads under names that no operator has, and what to carry along."""
    names = [c if c in _READ else f"column_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), tuple(c for c in names if c != "doc_id")


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in some language; those whose text is missing or has no letter go. A document without a lang gets the
    language that the parse finds. Where no row is labelled nothing is learnt: then only letters are looked for."""
    model = language.learn(docs)
    plain, carry = _plain(docs)
    if not model.samples:
        return language.with_letter(plain).toDF(*docs.columns)
    found = language.identify(plain, model, carry).where(F.col("lang_pred") != language.UNKNOWN)
    return found.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*plain.columns).toDF(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not graded toxic by a model of the labelled ones. Rows without a doc_id or a text, and repeated
    ones, are graded like others; without labels nothing goes."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    plain, carry = _plain(docs)
    return toxicity.grade(plain, model, carry).where(~F.col("toxic")).select(*plain.columns).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates, and all documents in no group. Of rows
    equal in doc_id and text one stays."""
    plain, _ = _plain(docs)
    marked = plain.withColumn(_MARK, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    kept = near_duplicates.group(marked, (_MARK,)).where("kept").select(F.col("doc_id").alias("kept_id"), F.col(_MARK).alias("kept_mark")).distinct()
    once = marked.dropDuplicates(["doc_id", _MARK])
    same = once["doc_id"].eqNullSafe(kept["kept_id"]) & (once[_MARK] == kept["kept_mark"])
    return once.join(kept, same, "left_semi").select(*plain.columns).toDF(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words or more that an earlier one holds; n_chars is that of the new text."""
    plain, carry = _plain(docs)
    left = repeats.remove_repeats(plain, tuple(c for c in carry if c not in ("text", "n_chars")), whole_as_is=True)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*plain.columns).toDF(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 4096 tokens; a document without text is its end token."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_languages),
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    staging = Staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = staging.table(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)

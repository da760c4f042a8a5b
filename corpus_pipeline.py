"""A corpus pipeline over ``documents``: language identification, line
deduplication, near-duplicate removal, source mixing, tokenization.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. ``run`` writes
what a stage returns to a table in the shared folder and hands the reread
table to the next one. All stages but the last return documents with the
columns they came with:

* ``identify_language`` drops documents whose language can't be told (no
  text or letter, or a score below one half); the classifier learns from the
  labels of its own input.
* ``drop_template_lines`` takes lines of recurring templates out of the texts but
  one carrier's.
* ``drop_near_duplicates`` links documents that share four fifths of their
  five-word shingles and keeps of each group of linked ones the one with the
  smallest id (null last; of equal ids one); documents without words
  link with nothing and stay.
* ``mix_sources`` takes whole documents towards each source's target, repeats
  as repeated rows, and leaves the others out. Rows come in training order.
* ``tokenize`` returns doc_id, n_tokens and digests of token ids and decoded bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitelens.llm import bpe_sql, jaccard_rtree, langid, line_templates, mixture
from sitelens.llm.queries import VOCABULARY
from sitelens.llm.textops import ship_package, staged

#: The classifier and the hashed order have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def _named_apart(stage: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The stage over documents whose other columns have names that no operator
    uses; they get their own names back."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        apart = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "lang", "source")}
        out = stage(docs.select(*[F.col(f"`{c}`").alias(apart.get(c, c)) for c in docs.columns]))
        return out.select(*[F.col(apart.get(c, c)).alias(c) for c in docs.columns])

    run_stage.__doc__ = stage.__doc__
    return run_stage


@_named_apart
def identify_language(docs: DataFrame) -> DataFrame:
    """Drop documents whose language can't be told."""
    return langid.accepted(langid.predict(docs, langid.train(docs)))


@_named_apart
def drop_template_lines(docs: DataFrame) -> DataFrame:
    """Take lines of recurring templates out of the texts."""
    return line_templates.drop_all_recurring_lines(docs)


@_named_apart
def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """Keep one document of each group of linked ones."""
    groups = staged(jaccard_rtree.jaccard_components(docs, width=5, threshold=80, count_links=False), "near_duplicate_groups")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")
    leaders = (groups.filter("component IS NOT NULL").groupBy("component").agg(F.min(row).alias("row"))
               .select(F.col("row.doc_id").alias("_id"), F.col("row.text_hash").alias("_text")))
    wordless = groups.filter("component IS NULL").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_text")).distinct()
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_text"))
    # Rows with a leader's id and text may repeat; the one that sorts first by its columns stays.
    rest = [c for c in docs.columns if c != "text"] + ["text"]
    leading = (hashed.join(leaders, same, "left_semi").groupBy("doc_id", "_hash").agg(F.min(F.struct(*rest)).alias("row")).select("row.*"))
    return leading.select(*docs.columns).unionByName(hashed.join(wordless, same, "left_semi").select(*docs.columns))


@_named_apart
def mix_sources(docs: DataFrame) -> DataFrame:
    """Take whole documents towards each source's target, in training order."""
    own = [c for c in docs.columns if c not in ("doc_id", "source")]
    return mixture.training_order(mixture.mixed(docs, cut=False, keep=own))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests."""
    ship_package(spark)
    vocabulary = bpe_sql.broadcast_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    return bpe_sql.token_digests(bpe_sql.encode(
        docs, vocabulary, public_tokenizers.PATTERN, decoded=True, cache=100_000, keep_codec=False))


STAGES = [("language", identify_language), ("lines", drop_template_lines), ("near_duplicates", drop_near_duplicates),
          ("mix", mix_sources), ("tokens", tokenize)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs

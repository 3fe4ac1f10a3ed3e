"""A training corpus from raw documents: five stages of the operators in lanemesh.llm.

Each stage takes the whole table that its predecessor wrote and returns a DataFrame; all but the last
return the columns of `documents`. Language ID, mixing and encoding leave texts where they are. Line dedup
and the near-copy stage join decisions by id; only where these are too many to be broadcast, by Spark's
own threshold, are texts shuffled for that.

Defined cases: rows with a null doc_id go at the first stage, as links and windows are by document;
null, empty and letterless texts go there as well; rows that repeat a doc_id and text are kept alike, and
language is found row by row where one id has several texts; ties are settled by the smallest id; texts
of any length are taken whole; an empty table passes all stages; further columns are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanemesh.llm import bpe, jaccard, language, line_dedup, mixing
from lanemesh.llm.common import materialized, table
from lanemesh.llm.queries import tokenizer_path, tokenizer_pattern

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document whose words belong to its language by less than this share is rejected.
LEAST_SHARE = 0.3
#: Near copies share this percentage of their shingles of so many words; op8's contract is narrower.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those that are in no learned language; the others' `lang` is the one found."""
    found = language.identified(_documents(docs).where("doc_id is not null"), language.learned(docs), COLUMNS)
    kept = found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated three-line windows out of the texts; documents that were nothing else go."""
    out = line_dedup.line_deduped(_documents(docs), drop_emptied=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    gone = jaccard.joined(docs, n=NEAR_WORDS, percent=NEAR_PERCENT).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return _documents(docs).join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, which may be never."""
    return mixing.repeated(_documents(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the hashes of ids and of the bytes they decode to."""
    return bpe.encode_documents(docs, bpe.load_ranks(tokenizer_path()), tokenizer_pattern(), keep_ids=True)


STAGES = [
    ("language ID", identify_language),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", join_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's table is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Language ID is a trained model, which SQL can't express.
ORACLE_SQL = None

"""The training-data pipeline over ``documents``.

``STAGES`` are (name, function) pairs; a function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame. Every stage but the last returns the
columns of ``documents`` (``doc_id, text, lang, source, n_chars``).
``run`` applies them one after the other, each result written as Parquet in
the shared folder and read back as the next one's ``docs``.

For every stage: further columns of ``docs``, whatever their names, are not
read and not returned; texts of any length are treated whole; no rows give no
rows. What else a stage does with nulls and repeated rows is said there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import bpe, jaccard, langid, mixing, queries, surrogates
from starloom.llm.common import drop_cut, passing, ship, write_cut

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The result's documents' rows are no SQL: language ID and PII have none.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no determined language go, those among them in which no
    learned language has any evidence; ``lang`` becomes the predicted one.
    A null, empty or letterless text goes; repeated rows all stay or all go;
    a row without id is not learned from."""
    ship(spark)
    filters = langid.learn(docs.where(langid.fold() != 1).select("lang", "text"))
    found = langid.label(docs.select(*COLUMNS), filters)
    return found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") > 0)).select(
        "doc_id", "text", F.col("lang_pred").alias("lang"), "source", "n_chars")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays, that of least id (a
    row without id only where no other is in its class). Rows equal in id and
    text are one. A null, empty or blank text is near nothing and stays."""
    ship(spark)
    return jaccard.representatives(docs.select(*COLUMNS))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets get surrogates; every row stays. A null text
    stays null; repeated rows get equal texts; ``n_chars`` follows the text."""
    ship(spark)
    done = surrogates.pseudonymise_checked(docs.select(*COLUMNS), surrogates.EXAMPLE_KEY)
    return done.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the numbers that the mix takes them: left out, once, or
    once an epoch. Null languages and sources are values like others; a null
    or blank text has no tokens and uses no budget; repeated rows count each."""
    return mixing.take(docs.select(*COLUMNS)).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded_sha256, same``: the token ids,
    little-endian unsigned 32-bit, the hash of what they decode to, and
    whether that is the text. A null text has no ids and counts as empty;
    repeated rows each give a row."""
    ship(spark)
    return bpe.round_trip(docs, queries.RANKS, queries.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("byte_bpe", encode_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents' token ids, decoded again, after all stages. What a
    stage writes for itself, and its input, are deleted once its result is
    written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with passing(spark):
            result = stage(spark, docs, sf_dir)
            docs = write_cut(result, f"pipeline-{name}", kept=True)
        if before is not None:
            drop_cut(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)

"""The corpus pipeline: language, near-duplicates, benchmark passages, source mix, token files.

Every stage takes (spark, docs, sf_dir), with docs in the columns of
``documents`` (doc_id, text, lang, source, n_chars), and returns a DataFrame;
it is written as Parquet and read back as the next stage's docs, before that
stage is called.  All stages but the last return the columns of ``documents``.

Nulls in any column, empty and very long texts, repeated rows, empty tables
and further columns are handled by every stage; what happens to them is
stated there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm import decontam, langid, minhash, mixing, tokenfile
from portacube.llm.scratch import Scratch
from portacube.llm.workers import ship_code

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


#: numbered rows of the stage before, which go when the next one begins: its own rows are written by then
_numbered_before: list[Scratch] = []


def _begin(spark: SparkSession) -> None:
    while _numbered_before:
        scratch = _numbered_before.pop()
        if scratch.spark is spark:
            scratch.drop("rows")


def _numbered(spark: SparkSession, docs: DataFrame, tag: str) -> DataFrame:
    """The rows of ``docs`` stored with a number of their own, by which a stage decides: ids may repeat or be null."""
    scratch = Scratch(spark, tag)
    rows = scratch.stage(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()), "rows")
    _numbered_before.append(scratch)
    return rows


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is identified; ``lang`` becomes the identified language.

    Empty and white-space texts go.  Every row is judged by itself, whatever
    its doc_id; rows without one have no page and are judged by the rest.
    """
    _begin(spark)
    rows = _numbered(spark, docs, "language")
    judged = langid.identify_documents(spark, rows.select("_row", "doc_id", "text", "lang", "source"), sf_dir)
    kept = judged.where("kept").select("_row", F.col("language").alias("_language"))
    return rows.join(kept, "_row").withColumn("lang", F.col("_language")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: that with the least doc_id, any id before none.

    Five words and a similarity of 0.8, row by row: unlike texts stay, also
    under one doc_id; of equal rows one stays.  Empty texts are no duplicates
    of each other.
    """
    _begin(spark)
    rows = _numbered(spark, docs, "near-duplicates")
    judged = minhash.near_duplicates(spark, rows.select("_row", "text"), key="_row")
    first = (judged.select("_row", F.col("component_id").alias("_group")).join(rows.select("_row", "doc_id"), "_row")
             .groupBy("_group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")).alias("_one")))
    return rows.join(first.select("_one._row"), "_row", "left_semi").select(*COLUMNS)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage within its edit budget, wherever it stands.

    Passages below ``decontam.MIN_CHARS`` normalised characters count word for
    word; those below ``decontam.DROP_CHARS``, common speech, drop nothing.
    Null and empty texts hold none; rows are judged one by one.
    """
    _begin(spark)
    passages = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(spark, docs.select(*COLUMNS), passages)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents as the source mix takes them, the repetitions as rows of their own.

    A document taken for 1.4 times its words gives one whole row and one with
    the first words of its text, so the rows of a source hold as many words
    as the mix gives it.  Documents that the mix takes no word of go: of
    every source, only the end of the seeded order.  Texts without words have
    nothing to take and go.
    """
    _begin(spark)
    rows = docs.select(*COLUMNS).withColumn("size", mixing.word_count())
    taken = mixing.mix(spark, rows)
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    copies = F.array_repeat(F.col("size"), whole.cast("int"))
    copies = F.when(rest > 0, F.concat(copies, F.array(rest))).otherwise(copies)
    pieces = F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_words").cast("int")), "")
    out = taken.where("taken > 0").withColumn("_words", F.explode(copies))
    return out.withColumn("text", F.when(F.col("_words") < F.col("size"), cut).otherwise(F.col("text"))).select(
        *COLUMNS[:-1], F.when(F.col("_words") < F.col("size"), F.length("text").cast("long"))
        .otherwise(F.col("n_chars")).alias("n_chars"))


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the documents as token files in ascending doc_id order and return every document read back:
    doc_id, start, n_tokens, ids_crc32."""
    _begin(spark)
    return tokenfile.write_and_read(spark, docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix),
          ("token_files", token_files)]

# The stages train a model and draw hashes that SQL has no functions for.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are staged in the shared folder."""
    ship_code(spark)
    scratch = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs

"""Language identification by Bayesian evidence fusion."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portacube.llm import textkit
from portacube.llm.scratch import Scratch
from portacube.llm.workers import batch_bytes, ship_code

BUCKETS = 1 << 15  # hashed byte trigrams
TRAIN_PER_LANGUAGE = 1000  # expected number of labelled rows the text model is fitted on, per language
BLOCK = 64  # languages whose counts are held at once
BACKOFF = 2048.0  # trigrams of all languages' texts that are added to a language's own
FLOOR = 1 / 64  # share of a model that is spread over all trigrams
EFFECTIVE = 150  # independent trigrams that a text counts for at most
SMOOTH = 8.0  # pseudo-rows of a parent in its child's prior
REJECT_Z = 6.0  # deviations below the labelled texts of the same language
MIN_SD = 0.25  # deviation of mean log likelihoods that is assumed at least
GRAM_SD = 3.0  # deviation of one trigram's log likelihood
TAIL = 4.0  # times the deviation near the median that the whole deviation counts for at most
STEP = 0.01  # to which log likelihoods are rounded for their median
MIN_POSTERIOR = 0.5
PIECE = 1 << 20
SHORT = 1 << 12  # trigrams whose scores are gathered one by one; those of longer pieces are counted first
BATCH_BYTES = 8 << 20  # of texts that a worker gets at once


def _grams(data: np.ndarray) -> np.ndarray:
    """Buckets of the byte trigrams (A-Z lower-cased, white space runs kept as they are)."""
    x = (textkit.LOWER[data] - np.uint64(1)).astype(np.uint32)
    g = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
    return ((g * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _pieces(data: np.ndarray):
    """Overlapping pieces of a text, so that memory does not grow with it and no trigram is lost or repeated."""
    for at in range(0, max(len(data) - 2, 0), PIECE):
        yield data[at:at + PIECE + 2]


def _blank(data: np.ndarray) -> bool:
    """Whether there is nothing but white space."""
    return all(textkit.WHITE[data[at:at + SHORT]].all() for at in range(0, len(data), SHORT))


def _count(batches):
    """(number of the language, bucket, n) of the training texts of one partition."""
    totals = {}
    for batch in batches:
        offsets, data = textkit.strings(batch.column(1))
        for i, lang in enumerate(batch.column(0).to_pylist()):
            own = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for piece in _pieces(data[offsets[i]:offsets[i + 1]]):
                own += np.bincount(_grams(piece), minlength=BUCKETS)
            if len(totals) > BLOCK:
                yield from _sparse(totals)
                totals = {}
    yield from _sparse(totals)


def _sparse(totals: dict):
    for lang, own in totals.items():
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), lang, np.int32)), pa.array(at), pa.array(own[at])],
                                         ["number", "bucket", "n"])


def _shares(counts: np.ndarray, every: np.ndarray, counted, all_counted) -> np.ndarray:
    """Probabilities of trigrams by their counts in a language and in ``every`` language, and the counts' totals."""
    back = BACKOFF * (every + 0.5) / (all_counted + 0.5 * BUCKETS)
    return (1 - FLOOR) * (counts + back) / (counted + BACKOFF) + FLOOR / BUCKETS


def _score(table: np.ndarray, every: np.ndarray, first: int, text_at: int, last: bool):
    """Append the mean log likelihoods under the languages of ``table``, the ``first`` one and those after it, to
    the fourth column after the text; fill the fifth, that under the declared language without the text's own counts.

    The columns between are the number of the declared language, null if there
    is none, and whether its counts hold the text.  The ``last`` block puts the
    number of trigrams in place of the text, -1 for blank texts.
    """
    def counts(data):
        own = np.zeros(BUCKETS)
        for piece in _pieces(data):
            own += np.bincount(_grams(piece), minlength=BUCKETS)
        return own

    def sums_of(model, data):
        """Log likelihoods under every model; numbers held do not grow with the text."""
        if len(data) - 2 <= SHORT:
            return model[:, _grams(data)].sum(axis=1) if len(data) > 2 else np.zeros(len(model))
        own = counts(data)
        at = np.flatnonzero(own)
        return model[:, at] @ own[at]

    def held_out(data, lang):
        own = counts(data)
        at, n = np.flatnonzero(own), own.sum()
        return own[at] @ np.log(_shares(table[lang, at] - own[at], every[at] - own[at], table[lang].sum() - n,
                                        every.sum() - n)) / n

    def run(batches):
        model = np.log(_shares(table, every, table.sum(axis=1, keepdims=True), every.sum()))
        for batch in batches:
            said, counted = batch.column(text_at + 1).to_pylist(), batch.column(text_at + 2).to_pylist()
            before = batch.column(text_at + 3).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, first)
            held = batch.column(text_at + 4).to_pylist()
            offsets, data = textkit.strings(batch.column(text_at))
            sizes = np.maximum(np.diff(offsets) - 2, 0)
            sums = np.array([sums_of(model, data[offsets[i]:offsets[i + 1]]) for i in range(batch.num_rows)])
            sums = sums.reshape(batch.num_rows, len(model))
            means = sums / np.maximum(sizes, 1)[:, None]
            for i, lang in enumerate(said):
                if lang is not None and first <= lang < first + len(model) and sizes[i] > 0:
                    held[i] = (held_out(data[offsets[i]:offsets[i + 1]], lang - first) if counted[i]
                               else means[i, lang - first])
            scores = np.concatenate([before, means], axis=1)
            held, text = pa.array(held, pa.float64()), batch.column(text_at)
            if last:
                blank = [_blank(data[offsets[i]:offsets[i + 1]]) for i in range(batch.num_rows)]
                text = pa.array(np.where(blank, -1, sizes).astype(np.int64))
            scores = pa.ListArray.from_arrays(np.arange(batch.num_rows + 1, dtype=np.int32) * scores.shape[1],
                                              pa.array(scores.reshape(-1)))
            out = [*[batch.column(i) for i in range(text_at)], text, *batch.columns[text_at + 1:text_at + 3], scores, held]
            yield pa.RecordBatch.from_arrays(out, [str(i) for i in range(len(out))])
    return run


def _named(declared: str) -> Column:
    return F.lower(F.regexp_extract(F.col(declared).cast("string"), "^[A-Za-z]+", 0))


def fit(docs: DataFrame, text: str, declared: str, key: str, scratch: Scratch,
        per_language: int = TRAIN_PER_LANGUAGE) -> tuple[list[str], DataFrame | None, Column, Column]:
    """All declared languages and their trigram counts (number, bucket, n), staged; a row's language number and
    whether it is counted, as expressions over ``docs``.

    About ``per_language`` rows of each language are drawn by a hash of their
    key.
    """
    sizes = {r["lang"]: r["n"] for r in docs.select(_named(declared).alias("lang")).where("lang <> ''").groupBy("lang")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return [], None, F.lit(None).cast("int"), F.lit(False)
    span = 1 << 20
    number = F.nullif(F.array_position(F.array(*[F.lit(x) for x in langs]), F.coalesce(_named(declared), F.lit(""))),
                      F.lit(0).cast("long")).cast("int") - 1
    quota = F.get(F.array(*[F.lit(min(span, -(-per_language * span // sizes[x]))) for x in langs]), number)
    drawn = F.coalesce(F.pmod(F.xxhash64(F.col(key), F.lit(11)), F.lit(span)) < quota, F.lit(False))
    counts = (docs.where(drawn).select(number.alias("number"), F.col(text).alias("text"))
              .mapInArrow(_count, "number int, bucket long, n long").groupBy("number", "bucket").agg(F.sum("n").alias("n")))
    with batch_bytes(docs.sparkSession, BATCH_BYTES):
        return langs, scratch.stage(counts, "counts"), number, drawn


def _table(counts: DataFrame, first: int, n: int) -> np.ndarray:
    """The counts of ``n`` languages; at most BLOCK * BUCKETS counts reach the driver at once."""
    rows = counts.where((F.col("number") >= first) & (F.col("number") < first + n)).toArrow()
    table = np.zeros((n, BUCKETS))
    table[rows["number"].to_numpy() - first, rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return table


def _typical(counts: list[tuple[int, int, int]], n: int) -> list[tuple[float, float] | None]:
    """(median, deviation from it) of each language's values, from (language, value in STEPs, rows); of all languages'
    values where a language has none.

    The deviation holds the tail of mixed texts, up to TAIL times that by the
    median distance, so rows far off cannot widen it without limit.
    """
    def middle(values, rows):
        order = np.argsort(values, kind="stable")
        run = np.cumsum(rows[order])
        return values[order][np.searchsorted(run, (run[-1] + 1) // 2)]

    def typical(part):
        if not len(part):
            return None
        center = middle(part[:, 1], part[:, 2])
        near = middle(np.abs(part[:, 1] - center), part[:, 2]) * 1.4826
        whole = np.sqrt(np.average((part[:, 1] - center) ** 2, weights=part[:, 2]))
        return float(center * STEP), float(min(whole, TAIL * near) * STEP)
    counts = np.array(counts, np.int64).reshape(-1, 3)
    every = typical(counts)
    return [typical(counts[counts[:, 0] == i]) or every for i in range(n)]


def _tallies(rows: DataFrame, n: int, *names: str) -> DataFrame:
    """(names, t: rows by best language, m: rows) of the values of ``names``."""
    return (rows.groupBy(*names, "best").agg(F.count(F.lit(1)).alias("m")).groupBy(*names)
            .agg(F.map_from_entries(F.collect_list(F.struct("best", "m"))).alias("by"), F.sum("m").alias("m"))
            .select(*names, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.coalesce(
                F.try_element_at("by", i).cast("double"), F.lit(0.0))).alias("t"), "m"))


def identify(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text",
             declared: str = "lang", host: str = "host", suffix: str = "suffix",
             evidence: DataFrame | None = None) -> DataFrame:
    """Languages of whole texts: adds ``language``, ``posterior``, ``text_language`` and ``kept``; drops the text.

    ``evidence`` (key, markup, host, suffix; one row per key) takes precedence
    over the row's own ``declared``, ``host`` and ``suffix``; it is joined
    after scoring, so texts are not shuffled.

    The posterior of a language is proportional to its trigram likelihood of
    the text (as if of EFFECTIVE independent trigrams at most), the rate at
    which texts of that language carry this ``declared`` (markup) language
    and this address ``suffix``, and the prior of the ``host``, smoothed to
    that of its domain and this to that of all rows.  Rates and priors come
    from grouped counts over all rows; a missing value (null or empty) is no
    evidence.  Every declared language is modelled, also from one row; a
    model is filled up with BACKOFF trigrams of all languages.  Models are
    applied BLOCK at a time, the texts being written again between blocks.

    Not ``kept``: empty texts and white space; texts that none of the
    languages explains (REJECT_Z deviations below the median of the texts that
    declare that language and are nearest to it, each scored without its own
    counts: unexplained rows without a label change nothing, labelled ones
    below half little); a posterior below MIN_POSTERIOR.  Defined cases: a null text
    is empty; a text too short for a trigram is judged by the other evidence;
    if no row declares a language all rows are rejected; null keys and
    repeated rows are judged like others; columns named like the results are
    replaced; an empty input gives an empty result.
    """
    ship_code(spark)
    scratch = Scratch(spark, "langid")
    docs = docs.drop("language", "posterior", "text_language", "kept")
    langs, counts, number, counted = fit(docs, text, declared, key, scratch)
    n = len(langs)
    if not n:
        return docs.drop(text).select("*", F.lit(None).cast("string").alias("language"), F.lit(0.0).alias("posterior"),
                                      F.lit(None).cast("string").alias("text_language"), F.lit(False).alias("kept"))
    rest = [c for c in docs.columns if c != text]
    every = np.zeros(BUCKETS)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        every[r["bucket"]] = r["n"]
    scored = docs.select(*rest, text, number.alias("_number"), counted.alias("_counted"),
                         F.array().cast("array<double>").alias("_score"), F.lit(None).cast("double").alias("_held"))
    for first in range(0, n, BLOCK):
        last = first + BLOCK >= n
        schema = T.StructType([*[T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(rest)],
                               T.StructField("grams", T.LongType()) if last else T.StructField("text", T.StringType()),
                               T.StructField("labelled", T.IntegerType()), T.StructField("counted", T.BooleanType()),
                               T.StructField("score", T.ArrayType(T.DoubleType())), T.StructField("held", T.DoubleType())])
        table = _table(counts, first, min(BLOCK, n - first))
        with batch_bytes(spark, BATCH_BYTES):
            scored = scratch.stage(scored.mapInArrow(_score(table, every, first, len(rest), last), schema),
                                   f"scored-{first}")
        if first:
            scratch.drop(f"scored-{first - BLOCK}")

    def col(name):
        return F.col(f"k{rest.index(name)}") if name in rest else F.lit(None).cast("string")

    def blank(c):
        return F.when(F.trim(c.cast("string")) == "", None).otherwise(F.lower(F.trim(c.cast("string"))))

    def language(c):
        return blank(F.regexp_extract(c.cast("string"), "^[A-Za-z]+", 0))
    said, place, tail = language(col(declared)), blank(col(host)), blank(col(suffix))
    if evidence is not None:
        scored = scored.join(evidence.select(F.col(key).alias("e_key"), F.col("markup").alias("e_markup"),
                                             F.col("host").alias("e_host"), F.col("suffix").alias("e_suffix")),
                             col(key) == F.col("e_key"), "left")
        said = F.coalesce(language(F.col("e_markup")), said)
        place, tail = F.coalesce(blank(F.col("e_host")), place), F.coalesce(blank(F.col("e_suffix")), tail)
    best = F.array_position("score", F.array_max("score")).cast("int") - 1
    rows = scored.withColumns({
        "best": F.when(F.col("grams") > 0, best), "said": said, "suffix": tail, "host": place})
    # two last labels of an address; a name without dots is its own domain
    rows = rows.withColumn("domain", F.regexp_extract("host", r"([^.]+\.)?[^.]+$", 0))
    found = {r["best"]: float(r["count"]) for r in rows.where("best is not null").groupBy("best").count().collect()}
    world = [(found.get(i, 0.0) + 1) / (sum(found.values()) + n) for i in range(n)]
    of_language = F.array(*[F.lit(found.get(i, 0.0)) for i in range(n)])

    def rates(name):
        """log P(value of ``name`` | language) by value."""
        return (_tallies(rows.where(F.col(name).isNotNull() & F.col("best").isNotNull()), n, name)
                .select(name, F.zip_with("t", of_language, lambda a, b: F.log((a + 0.5) / (b + 0.5 * n)))
                        .alias(f"{name}_rate")))

    domains = (_tallies(rows.where("domain is not null and best is not null"), n, "domain")
               .select("domain", F.zip_with("t", F.array(*[F.lit(w) for w in world]), lambda a, b: a + b * SMOOTH)
                       .alias("t"), "m")
               .select("domain", F.transform("t", lambda a: a / (F.col("m") + SMOOTH)).alias("domain_prior")))
    hosts = (_tallies(rows.where("host is not null and best is not null"), n, "host", "domain")
             .join(domains, "domain", "left")
             .select("host", F.zip_with("t", "domain_prior", lambda a, b: F.log(
                 (a + b * SMOOTH) / (F.col("m") + SMOOTH))).alias("host_prior")))
    usual = _typical([tuple(r) for r in rows.where("held is not null and best = labelled")
                      .groupBy("labelled", F.round(F.col("held") / STEP).cast("long").alias("at")).count().collect()], n)

    def typical(i):
        return F.get(F.array(*[F.lit(u and u[i]).cast("double") for u in usual]), F.col("best"))
    joined = (rows.join(rates("said"), "said", "left").join(rates("suffix"), "suffix", "left")
              .join(hosts, "host", "left"))
    zero = F.array(*[F.lit(0.0)] * n)
    prior = F.coalesce("host_prior", F.array(*[F.lit(float(np.log(w))) for w in world]))
    weight = F.greatest(F.least(F.col("grams"), F.lit(EFFECTIVE)), F.lit(0))
    total = F.transform("score", lambda s: s * weight)
    for part in (prior, F.coalesce("said_rate", zero), F.coalesce("suffix_rate", zero)):
        total = F.zip_with(total, part, lambda a, b: a + b)
    out = joined.withColumn("total", total).withColumn("top", F.array_max("total"))
    out = out.withColumns({
        "winner": F.array_position("total", F.col("top")).cast("int"),
        "p": 1 / F.aggregate("total", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top"))),
        # a mean over few trigrams varies more
        "z": (F.array_max("score") - typical(0)) / F.sqrt(
            typical(1) ** 2 + MIN_SD ** 2 + GRAM_SD ** 2 / F.greatest(F.col("grams"), F.lit(1)))})
    names = F.array(*[F.lit(x) for x in langs])
    has = F.col("grams") >= 0
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(rest)],
        F.when(has, F.get(names, F.col("winner") - 1)).alias("language"),
        F.when(has, F.col("p")).otherwise(0.0).alias("posterior"),
        F.get(names, F.col("best")).alias("text_language"),
        (has & (F.col("p") >= MIN_POSTERIOR) & F.coalesce(F.col("z") >= -REJECT_Z, F.lit(True))).alias("kept"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, markup, host, suffix) from the page that shows a document: the number in its path.

    Of several pages of a document that one counts which states a markup
    language and has the least (host, markup), or if none states one, that of
    the least host; the markup language is the first that an ``html`` tag
    states, wherever it stands.  Pages without such a number are no evidence.
    """
    rest = F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.lower(F.regexp_extract(rest, r"^[^/?#:]*", 0))
    number = F.expr("try_cast(nullif(regexp_extract(url, '://[^/?#]*/(?:[^/?#]*/)*([0-9]+)', 1), '') as bigint)")
    markup = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    return (pages.select(number.alias("doc_id"), host.alias("host"), markup.alias("markup"))
            .where("doc_id is not null").groupBy("doc_id")
            .agg(F.min(F.struct((F.col("markup") == "").alias("unstated"), "host", "markup")).alias("e"))
            .select("doc_id", "e.markup", "e.host", F.substring_index("e.host", ".", -1).alias("suffix")))


def identify_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``identify`` for rows of ``documents``, with all their columns but the text: the markup language and address of
    a document's page where there is one, else its ``lang`` and ``source``."""
    pages = page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return identify(spark, docs, host="source", evidence=pages)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every one of ``documents``, and whether it is kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    return identify_documents(spark, docs, sf_dir).select("doc_id", "language", "posterior", "text_language", "kept")

"""Personal data by weak supervision: labelers vote, EM weighs them, a span classifier decides.

Everything is DataFrame functions.  Patterns propose spans; regex, gazetteer
and context labelers vote on each; votes are counted by pattern (a table
whose size depends on the number of labelers only) and expectation
maximisation over those counts estimates how reliable each labeler is.  The
posteriors of the spans train a naive Bayes classifier over their shape and
surroundings, which accepts or rejects the proposals outside the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portacube.llm.scratch import Scratch

KINDS = ("email", "ip", "card", "phone", "iban", "id")  # order of spans with one start

# Base rules, written so that no start is scanned twice (possessive runs, run starts only).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider proposals: (kind, pattern).
WIDE = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(](?i:at|arroba)[\])] ?[A-Za-z0-9-]{1,63}+"
              r"(?: ?(?:\.|[\[(](?i:dot|punkt|punto|point)[\])]) ?[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("ip", r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])"),
    ("card", r"(?<![0-9A-Za-z./])[0-9]{4}([./])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9A-Za-z./])"),
    ("phone", r"(?<![0-9A-Za-z+.(=/-])(?:00[1-9][0-9]{0,2} |\(0?[0-9]{2,4}\) ?|0?[0-9]{2,4}[ .-])"
              r"[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z.-])"),
    ("iban", r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"),
    ("id", r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"),
)
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# Gazetteers and cue words.
TOP_LEVEL = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "us", "eu", "ch", "at")
IBAN_COUNTRIES = ("AT", "BE", "CH", "DE", "ES", "FR", "GB", "IE", "IT", "LU", "NL", "PL", "PT", "SE")
CUES = {
    "email": r"(?i)e-?mail|mailto|correo|courriel|contact|kontakt|write to",
    "ip": r"(?i)\bip\b|address|server|host|login|client",
    "card": r"(?i)card|visa|master|credit|kredit|tarjeta|carte|payment",
    "phone": r"(?i)tel|phone|call|fax|mobil|handy|whatsapp|contact|anruf",
    "iban": r"(?i)iban|account|konto|compte|cuenta|bank",
    "id": r"(?i)ssn|social|security|\bid\b|passport|ausweis",
}
CONTEXT = 40  # characters of context on each side
BUCKETS = 4096  # values of one classifier feature
ROUNDS = 25
ACCEPT = 0.95
LABELERS = 5


def _hits(text: Column, pattern: str, number: int) -> Column:
    """Array of (number, i, gap, match, left, right) for every match; gap counts the characters since the last."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    n = F.size(matches)
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(pieces.alias("p"), matches.alias("m"), F.slice(pieces, 2, n).alias("q"))
    rows = F.transform(F.slice(zipped, 1, n), lambda x, i: F.struct(
        F.lit(number).alias("pattern"), i.cast("long").alias("i"), F.length(x["p"]).cast("long").alias("gap"),
        x["m"].alias("match"), F.right(x["p"], F.lit(CONTEXT)).alias("left"),
        F.left(x["q"], F.lit(CONTEXT)).alias("right")))
    return F.when(n > 0, rows)


def _luhn(digits: Column) -> Column:
    n = F.length(digits)
    doubled = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, n - i + 1, F.lit(1)).cast("int")
                          * F.when(i % 2 == 0, 2).otherwise(1))
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return F.when(n.between(14, 19), total % 10 == 0).otherwise(False)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def spans_of(docs: DataFrame, text: str, scratch: Scratch) -> DataFrame:
    """Staged proposals: one row per match, with code-point offsets, and one row without match per other document.

    ``row`` numbers the documents, so equal or null keys stay apart.  Offsets
    are running sums of the gaps and matches before, per document and
    pattern.  ``base`` marks spans of the base rules that pass their check.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    patterns = [*BASE.items(), *WIDE]
    found = F.flatten(F.filter(F.array(*[_hits(t, p, k) for k, (_, p) in enumerate(patterns)]),
                               lambda x: x.isNotNull()))
    keep = [c for c in docs.columns if c != text]
    rows = docs.withColumn("_row", F.monotonically_increasing_id()).withColumn("_hit", F.explode_outer(found))
    raw = scratch.stage(rows.select(*[F.col(c).alias(f"k_{c}") for c in keep], F.col("_row").alias("row"), "_hit.*"),
                        "hits")
    kinds = F.array(*[F.lit(k) for k, _ in patterns])
    before = Window.partitionBy("row", "pattern").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap") + F.length("match")).over(before), F.lit(0)) + F.col("gap")
    h = (raw.where("pattern is not null").withColumn("start", start.cast("long"))
         .withColumns({"kind": kinds[F.col("pattern")], "end": F.col("start") + F.length("match"),
                       "digits": _digits(F.col("match"))}))
    n = F.length("digits")
    valid = (F.when(F.col("kind") == "email", True)
             .when(F.col("kind") == "ip", F.col("match").rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
             .when(F.col("kind") == "card", _luhn(F.col("digits")))
             .when(F.col("kind") == "phone", n.between(10, 15)))
    return scratch.stage(h.withColumn("base", (F.col("pattern") < len(BASE)) & valid), "spans"), raw


def votes(spans: DataFrame) -> DataFrame:
    """Add the labelers' votes v0..v4: 1 for personal data, 0 against, -1 for no opinion."""
    kind, match, digits = F.col("kind"), F.col("match"), F.col("digits")
    strict = F.col("pattern") < len(BASE)
    card_issuer = digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6)")
    regex = (F.when(strict, F.col("base").cast("int"))
             .when(kind == "card", _luhn(digits).cast("int"))
             .when(kind == "phone", F.length("digits").between(9, 13).cast("int")).otherwise(-1))
    gazetteer = (F.when(kind == "email", F.when(F.lower(F.substring_index(match, ".", -1)).isin(*TOP_LEVEL), 1)
                        .otherwise(-1))
                 .when((kind == "ip") & match.contains("."),
                       match.rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.").cast("int"))
                 .when(kind == "card", card_issuer.cast("int"))
                 .when(kind == "phone", F.when(match.rlike(r"^\+?0*(?:1|3[0-9]|4[0-9])|^\("), 1).otherwise(-1))
                 .when(kind == "iban", F.substring(match, 1, 2).isin(*IBAN_COUNTRIES).cast("int"))
                 .when(kind == "id", (~match.rlike(r"^(?:000|666|9)")).cast("int")).otherwise(-1))
    cue = F.lit(-1)
    for k, words in CUES.items():
        cue = F.when((kind == k) & F.col("left").rlike(words), 1).otherwise(cue)
    # a span glued to a longer token or assignment is a fragment of something else
    glued = (F.col("left").rlike(r"[\p{L}\p{N}_=/\"'#:.-]$")
             | F.coalesce(F.col("right"), F.lit("")).rlike(r"^[\p{L}\p{N}_=/@]"))
    shape = (F.when(kind == "email", (match.rlike("^[A-Za-z0-9]") & match.rlike("[a-z]{2}$")).cast("int"))
             .when(kind == "ip", (~match.rlike(r"(?:^|\.)0[0-9]")).cast("int"))
             .when(kind == "card", match.rlike(r"^(?:[0-9]{14,19}|[0-9]{4}(?:.[0-9]{4}){2,3}.?[0-9]{0,4})$")
                   .cast("int"))
             .when(kind == "phone", match.rlike(r"[0-9][ ().-]+[0-9]{3,}").cast("int")).otherwise(-1))
    return spans.withColumns({"v0": F.coalesce(regex, F.lit(0)), "v1": F.coalesce(gazetteer, F.lit(-1)), "v2": cue,
                              "v3": (~glued).cast("int"), "v4": F.coalesce(shape, F.lit(-1))})


def _posterior(v: Column, kind: Column, state: Column) -> Column:
    """P(personal | votes) under the labelers' rates: state = (prior by kind, rate if personal, rate if not)."""
    def log_odds(acc, j):
        a, b = state["hit"][j], state["false"][j]
        return acc + F.when(v[j] == 1, F.log(a / b)).when(v[j] == 0, F.log((1 - a) / (1 - b))).otherwise(0.0)
    prior = state["prior"][kind]
    score = F.aggregate(F.sequence(F.lit(0), F.lit(LABELERS - 1)), F.log(prior / (1 - prior)), log_odds)
    return 1 / (1 + F.exp(-score))


def _state(prior: Column, hit: Column, false: Column) -> Column:
    return F.struct(prior.alias("prior"), hit.alias("hit"), false.alias("false"))


def reliabilities(voted: DataFrame) -> DataFrame:
    """One row (prior, hit, false): labelers' rates by EM over the counts of vote patterns.

    The pattern table has at most kinds * 3^labelers rows whatever the input;
    all rounds run inside one aggregate expression over it.
    """
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    v = F.array(*[F.col(f"v{j}") for j in range(LABELERS)])
    counts = voted.groupBy(kind.alias("k"), v.alias("v")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    table = counts.agg(F.sort_array(F.collect_list(F.struct("k", "v", "n"))).alias("rows"))

    def fill(n, value):
        return F.array_repeat(F.lit(value), n)

    def total(rows, weight):
        return F.aggregate(rows, F.lit(0.0), lambda a, r: a + weight(r))

    def step(state, _):
        rated = F.transform(F.col("rows"), lambda r: F.struct(
            r["k"].alias("k"), r["v"].alias("v"), r["n"].alias("n"), _posterior(r["v"], r["k"], state).alias("q")))
        return F.transform(F.array(rated), lambda rows: _state(
            F.transform(F.sequence(F.lit(0), F.lit(len(KINDS) - 1)), lambda k:
                        (total(rows, lambda r: F.when(r["k"] == k, r["n"] * r["q"]).otherwise(0.0)) + 1)
                        / (total(rows, lambda r: F.when(r["k"] == k, r["n"]).otherwise(0.0)) + 2)),
            F.transform(F.sequence(F.lit(0), F.lit(LABELERS - 1)), lambda j:
                        (total(rows, lambda r: F.when(r["v"][j] == 1, r["n"] * r["q"]).otherwise(0.0)) + 8)
                        / (total(rows, lambda r: F.when(r["v"][j] >= 0, r["n"] * r["q"]).otherwise(0.0)) + 10)),
            F.transform(F.sequence(F.lit(0), F.lit(LABELERS - 1)), lambda j:
                        (total(rows, lambda r: F.when(r["v"][j] == 1, r["n"] * (1 - r["q"])).otherwise(0.0)) + 2)
                        / (total(rows, lambda r: F.when(r["v"][j] >= 0, r["n"] * (1 - r["q"])).otherwise(0.0)) + 10))
        ))[0]

    start = _state(fill(len(KINDS), 0.5), fill(LABELERS, 0.8), fill(LABELERS, 0.2))
    return table.select(F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step).alias("s")).select("s.*")


def _features() -> Column:
    """Classifier features of a span, each hashed into BUCKETS values."""
    shape = F.regexp_replace(F.regexp_replace(F.col("match"), r"\p{L}+", "a"), "[0-9]+", "9")
    cue = F.lower(F.regexp_extract("left", r"(\p{L}+)[^\p{L}]*$", 1))
    values = (F.length("digits").cast("string"), F.least(F.length("match"), F.lit(64)).cast("string"),
              F.left(shape, F.lit(32)), F.right(F.col("left"), F.lit(1)),
              F.left(F.coalesce(F.col("right"), F.lit("")), F.lit(1)), cue)
    return F.array(*[F.pmod(F.xxhash64(F.lit(i), F.col("kind"), x), F.lit(BUCKETS)) + i * BUCKETS
                     for i, x in enumerate(values)])


def classify(voted: DataFrame, scratch: Scratch) -> DataFrame:
    """Add ``p``: the span classifier's probability, trained on the posteriors of the weighed votes."""
    state = scratch.stage(reliabilities(voted), "rates")
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).cast("int") - 1
    one = state.select(F.struct("prior", "hit", "false").alias("s")).scalar()
    v = F.array(*[F.col(f"v{j}") for j in range(LABELERS)])
    soft = scratch.stage(voted.withColumn("_s", one).withColumn("q", _posterior(v, kind, F.col("_s")))
                         .withColumn("f", _features()).drop("_s"), "soft")
    # feature weights: at most features * BUCKETS rows
    parts = soft.select(F.explode("f").alias("x"), "q").groupBy("x").agg(F.sum("q").alias("yes"),
                                                                         F.sum(1 - F.col("q")).alias("no"))
    base = soft.agg(F.coalesce(F.sum("q"), F.lit(0.0)).alias("yes"),
                    F.coalesce(F.sum(1 - F.col("q")), F.lit(0.0)).alias("no"))
    yes, no = base.select("yes").scalar(), base.select("no").scalar()
    weights = scratch.stage(parts.select("x", (F.log((F.col("yes") + 0.5) / (yes + 1))
                                               - F.log((F.col("no") + 0.5) / (no + 1))).alias("w")), "weights")
    prior = F.log((yes + 1) / (no + 1))
    scores = (soft.select("row", "pattern", "i", F.explode("f").alias("x")).join(weights, "x")
              .groupBy("row", "pattern", "i").agg(F.sum("w").alias("w")))
    return (soft.join(scores, ["row", "pattern", "i"]).withColumn("p", 1 / (1 + F.exp(-(prior + F.col("w"))))))


def find_personal_data(spark: SparkSession, docs: DataFrame, text: str = "text",
                       accept: float = ACCEPT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spans of personal data in whole texts: (spans, rows, scored).

    ``spans`` has row, kind, start, end (code points, end exclusive), match,
    base and p: the base spans, and the classifier's spans with both the
    weighed votes and the classifier at ``accept`` or more that overlap no
    base span.  ``rows`` has every document's number ``row`` and its other
    columns as k_<name>, several times where it has several matches.

    Defined cases: a null text is empty; documents are told apart by row, not
    by key; texts of any length are scanned whole in one pass per pattern; an
    empty input gives empty results.
    """
    scratch = Scratch(spark, "pii")
    spans, rows = spans_of(docs, text, scratch)
    scored = scratch.stage(classify(votes(spans), scratch), "scored")
    # overlap with base spans: the furthest base end before and the nearest base start after
    order = [F.col("start"), F.col("end"), F.col("pattern")]
    ahead = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy("row").orderBy(*[c.desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    chosen = (scored.where(F.col("base") | ((F.col("pattern") >= len(BASE)) & (F.col("p") >= accept)
                                            & (F.col("q") >= accept)))
              .withColumn("_end", F.max(F.when(F.col("base"), F.col("end"))).over(ahead))
              .withColumn("_start", F.min(F.when(F.col("base"), F.col("start"))).over(behind)))
    free = ((F.coalesce(F.col("_end"), F.lit(-1)) <= F.col("start"))
            & (F.col("_start").isNull() | (F.col("_start") >= F.col("end"))))
    out = chosen.where(F.col("base") | free).select("row", "kind", "start", "end", "match", "base", "p")
    return out, rows, scored


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``: base counts and digest, and all spans."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    spans, rows, _ = find_personal_data(spark, docs)
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    marked = spans.select("row", F.lit(None).cast("long").alias("doc_id"), F.struct(
        "start", order.alias("k"), "end", "kind", "base").alias("s"))
    ids = rows.select("row", F.col("k_doc_id").alias("doc_id"), F.lit(None).cast(marked.schema["s"].dataType).alias("s"))
    # max of a document's rows: the same id, or null
    per = marked.union(ids).groupBy("row").agg(F.max("doc_id").alias("doc_id"),
                                               F.array_sort(F.collect_list("s")).alias("s"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"),
                                                                         x["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("s", lambda x: x["base"] & (x["kind"] == kind))).cast("long").alias(f"n_{kind}")
    base = F.filter("s", lambda x: x["base"])
    counts = [count(kind) for kind in BASE]
    return per.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                      joined(F.col("s")).alias("spans"))

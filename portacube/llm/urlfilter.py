"""URL filter: explicit rules first, then a tree of path templates per host."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm.scratch import Scratch

RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
MIN_SUPPORT = 5  # rows below which a literal segment is variable if most of its siblings are different
SIMILAR_Z = 2.576  # branches whose labelled rates differ by less (in deviations) are merged
SMOOTH = 4.0  # pseudo-rows of a parent rate
MAX_BAD = 0.5  # templates with a larger smoothed share of bad pages are rejected
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Part after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """Part after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits host (or a parent domain) and path; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _variable(segment: Column) -> Column:
    """Wildcard for a segment that is variable by its shape, else null."""
    return (F.when(segment.rlike(r"^[0-9]+$"), "{n}")
            .when(segment.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(segment, ".", -1)))
            .when(segment.rlike(r"^[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?$"), "{date}")
            .when(segment.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), "{hex}")
            .when(segment.rlike(r"^(?=(?:.*[0-9]){3}).{12,}$"), "{id}"))


def _fixed(segment: Column) -> Column:
    """Token of a segment whose siblings do not matter: empty, variable by its shape, or null."""
    return F.coalesce(F.when(segment == "", ""), _variable(segment))


def _skip_runs(live: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Walk the run of nodes with one child below each prefix in one step.

    All urls below (host, ``_t``) follow the longest of them, or end on its
    way, up to the first segment in which one differs; where that one alone is
    left the run ends too.  An only child has no siblings to differ from: its
    token is its shape's wildcard or ``*``.
    """
    key = ["host", "_t"]
    size = F.size("_s") - F.col("_at")
    longest = scratch.stage(live.groupBy(*key).agg(
        F.max_by("_s", F.struct(F.size("_s"), F.col("path"))).alias("_ref"), F.count(F.lit(1)).alias("_urls"))
        .where("_urls > 1").drop("_urls"), f"{name}-longest")
    left = F.slice("_s", F.col("_at") + 1, F.size("_s"))
    same = F.zip_with(left, F.slice("_ref", F.col("_at") + 1, F.size("_ref")), lambda x, y: x.eqNullSafe(y))
    first = F.array_position(same, False)
    agree = F.when(first > 0, first - 1).otherwise(size.cast("long"))
    compared = (live.join(longest, key).where("_s <> _ref")
                .select(*key, F.when(agree < size, agree).alias("_agree"), size.alias("_size")))
    runs = scratch.stage(compared.groupBy(*key).agg(F.min("_agree").alias("_agree"), F.max("_size").alias("_most"))
                         .select(*key, F.least("_agree", "_most").cast("int").alias("_run")).where("_run > 0"), f"{name}-runs")
    taken = F.least(F.coalesce("_run", F.lit(0)), size)
    tokens = F.transform(F.slice("_s", F.col("_at") + 1, taken),
                         lambda x: F.concat(F.lit("/"), F.coalesce(_fixed(x), F.lit("*"))))
    out = live.join(runs, key, "left").withColumns({
        "_t": F.concat("_t", F.array_join(tokens, "")), "_at": F.col("_at") + taken}).drop("_run")
    return scratch.stage(out.withColumn("_done", F.col("_at") == F.size("_s")), name)


def templates(spark: SparkSession, urls: DataFrame, scratch: Scratch) -> DataFrame:
    """(host, path, template) of the distinct ``urls`` (host, path, n, labelled, bad).

    The tree of each host is walked from branching to branching.  A segment
    becomes a wildcard if its shape is variable, or if it is rare among mostly
    distinct siblings.  The literal siblings left are merged into one ``*``
    branch unless the bad rate of a branch differs from that of its siblings
    (two proportions, SIMILAR_Z).  Branchings are grouped counts joined back
    on (host, prefix, segment); a hot host is a pre-aggregated group.  Runs of
    nodes with one child are walked in one step, so the number of rounds is
    that of branchings on the way to a url, not of its segments.  Paths are
    walked to their last segment: a url leaves the walk when it has no segment
    left, or when it is the only one below its prefix, whose other segments
    need no counts.
    """
    segments = F.split(F.regexp_replace("path", "^/", ""), "/", -1)
    rows = urls.withColumn("_s", F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(segments))
    rows = rows.withColumns({"_t": F.lit(""), "_at": F.lit(0)}).withColumn("_done", F.size("_s") == 0)
    rows = scratch.stage(rows, "level-0")
    rows.where("_done").write.parquet(scratch.path("templates"))
    d, live = 0, rows.where("not _done")
    while not live.isEmpty():
        walked = _skip_runs(live, scratch, f"run-{d}")
        walked.where("_done").write.mode("append").parquet(scratch.path("templates"))
        here = walked.where("not _done").withColumn("_x", F.get("_s", F.col("_at")))
        nodes = here.groupBy("host", "_t", "_x").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("m"), F.sum("bad").alias("b"), F.count(F.lit(1)).alias("urls"))
        nodes = scratch.stage(nodes, f"nodes-{d}")
        parents = scratch.stage(nodes.groupBy("host", "_t").agg(
            F.sum("n").alias("pn"), F.sum("m").alias("pm"), F.sum("b").alias("pb"), F.count(F.lit(1)).alias("kids"),
            (F.sum("urls") == 1).alias("_alone")), f"parents-{d}")
        om, ob = F.col("pm") - F.col("m"), F.col("pb") - F.col("b")
        pooled = F.col("pb") / F.greatest(F.col("pm"), F.lit(1))
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("m") + 1 / om))
        z = F.abs(F.col("b") / F.col("m") - ob / om) / spread
        differs = F.coalesce(F.when((F.col("m") > 0) & (om > 0) & (pooled > 0) & (pooled < 1), z > SIMILAR_Z),
                             F.lit(False))
        rare = (F.col("n") < MIN_SUPPORT) & (F.col("kids") * 2 > F.col("pn"))
        token = F.coalesce(_fixed(F.col("_x")), F.when(rare, "{*}"), F.when(differs, F.col("_x")), F.lit("*"))
        # both sides are stored, so that the join deals them itself and can split a hot host
        tokens = scratch.stage(nodes.join(parents, ["host", "_t"]).select("host", "_t", "_x", token.alias("_token"), "_alone"),
                               f"tokens-{d}")
        # an only url has no siblings at any level below
        below = F.transform(F.slice("_s", F.col("_at") + 2, F.size("_s")), lambda x: F.concat(F.lit("/"), F.coalesce(
            _fixed(x), F.when(F.col("n") == 1, "{*}"), F.lit("*"))))
        rows = scratch.stage(here.join(tokens, ["host", "_t", "_x"]).withColumns({
            "_t": F.concat("_t", F.lit("/"), "_token", F.when(F.col("_alone"), F.array_join(below, "")).otherwise("")),
            "_done": F.col("_alone") | (F.size("_s") == F.col("_at") + 1), "_at": F.col("_at") + 1})
            .drop("_x", "_token", "_alone"), f"level-{d + 1}")
        rows.where("_done").write.mode("append").parquet(scratch.path("templates"))
        scratch.drop(f"level-{d}", f"run-{d}", f"run-{d}-longest", f"run-{d}-runs", f"nodes-{d}", f"parents-{d}", f"tokens-{d}")
        d, live = d + 1, rows.where("not _done")
    return (spark.read.schema(rows.schema).parquet(scratch.path("templates")).withColumnRenamed("_t", "template")
            .drop("_s", "_at", "_done"))


def judge(spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", bad: str = "bad",
          rules=RULES) -> DataFrame:
    """Host, path, rule, template and verdict of every page.

    ``bad`` (1, 0 or null where unlabelled) labels pages; a template's share
    of bad pages is smoothed to its host's and this to that of all pages, and
    a template above MAX_BAD is rejected.  A template holds every segment of
    a path, however deep.  A rule overrides its template.
    Defined cases: a null url, or one without ``://``, has an empty host and
    path and is judged with the other such pages; repeated rows are judged
    alike; an empty input gives an empty result; only the named columns are
    read, so others cannot clash.
    """
    scratch = Scratch(spark, "urls")
    rows = scratch.stage(pages.select(F.col(key).alias("key"), host_of(F.col(url)).alias("host"),
                                      path_of(F.col(url)).alias("path"), F.col(bad).cast("int").alias("bad")), "rows")
    urls = rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"),
                                            F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = scratch.stage(templates(spark, urls, scratch), "tree")
    total = tree.agg(F.coalesce((F.sum("bad") + 1) / (F.sum("labelled") + 2), F.lit(0.5)).alias("p"))
    hosts = (tree.groupBy("host").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("m"))
             .select("host", ((F.col("b") + total.scalar() * SMOOTH) / (F.col("m") + SMOOTH)).alias("host_rate")))
    rates = (tree.groupBy("host", "template").agg(F.sum("bad").alias("b"), F.sum("labelled").alias("m"))
             .join(hosts, "host")
             .select("host", "template", "m", ((F.col("b") + F.col("host_rate") * SMOOTH) / (F.col("m") + SMOOTH))
                     .alias("bad_share")))
    judged = tree.select("host", "path", "template").join(rates, ["host", "template"])
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("key", "host", "path").join(judged, ["host", "path"]).select(
        F.col("key").alias(key), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bad_share") > MAX_BAD, "block").otherwise("allow")).alias("verdict"),
        "template", F.col("m").alias("labelled"), "bad_share")


def op8_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every ``pages`` url judged; a page is labelled bad if the document it shows (the number in its path) is
    labelled toxic or of low quality."""
    labels = (spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id")
              .agg(F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1)
                         .when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0)).alias("bad")))
    number = F.expr("try_cast(nullif(regexp_extract(url, '://[^/?#]*/(?:[^/?#]*/)*([0-9]+)', 1), '') as bigint)")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", number.alias("doc_id"))
    return judge(spark, pages.join(labels, "doc_id", "left"))

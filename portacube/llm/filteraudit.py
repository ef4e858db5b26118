"""Interaction audit of filters from sorted posting lists of failing rows."""

from __future__ import annotations

import heapq
from bisect import bisect_left
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm.scratch import Scratch
from portacube.llm.workers import ship_code

RANGE_BITS = 16  # rows of an id range: a posting list of one range holds 65,536 ids at most
PARTS_HELD = 1024  # parts whose sums a task holds before it passes them on

WORD = r"[^\x20\x09-\x0D]+"


def gallop(ids: list, at: int, value: int) -> int:
    """First place from ``at`` on whose id is not below ``value``: doubling steps, then a binary search."""
    step, to, n = 1, at, len(ids)
    while to < n and ids[to] < value:
        at, to, step = to + 1, to + step, step * 2
    return bisect_left(ids, value, at, min(to, n))


def union(lists: list[list]) -> list:
    """Union of sorted lists: the list with the least head gives its run up to the next head in one step."""
    heads = [(ids[0], i, 0) for i, ids in enumerate(lists) if ids]
    heapq.heapify(heads)
    out: list = []
    while len(heads) > 1:
        value, i, at = heads[0]
        ids, limit = lists[i], min(heads[1][0], heads[2][0]) if len(heads) > 2 else heads[1][0]
        if value == limit:  # another list gives it
            at += 1
        else:
            to = gallop(ids, at, limit)
            out += ids[at:to]
            at = to
        if at < len(ids):
            heapq.heapreplace(heads, (ids[at], i, at))
        else:
            heapq.heappop(heads)
    for _, i, at in heads:
        out += lists[i][at:]
    return out


def difference(ids: list, others: list) -> list:
    """The sorted ``ids`` that are not among ``others``, run by run."""
    out: list = []
    at = over = 0
    while at < len(ids):
        over = gallop(others, over, ids[at])
        if over == len(others):
            return out + ids[at:]
        to = gallop(ids, at, others[over])
        out += ids[at:to]
        at = to + (to < len(ids) and ids[to] == others[over])
    return out


def _interactions(filters: int, marks: int):
    """Sum, per part, over the posting lists of its ranges: rows, then per filter and set of filters before it the
    rows that fail it, that it removes, that the set and it leave out together, and of the removed those marked."""
    masks = [(f, m) for f in range(filters) for m in range(1 << filters) if not m >> f & 1]

    def sizes(n: int, fails: list[list], marked: list[list]) -> np.ndarray:
        gone = [union([ids for f, ids in enumerate(fails) if m >> f & 1]) for m in range(1 << filters)]
        out = [n]
        for f, m in masks:
            removed = difference(fails[f], gone[m])
            out += [len(fails[f]), len(removed), len(gone[m | 1 << f]),
                    *[len(removed) - len(difference(removed, ids)) for ids in marked]]
        return np.array(out, np.int64)

    def rows(sums: dict):
        wide = 3 + marks
        for part, own in sums.items():
            table = own[1:].reshape(-1, wide).T
            names = ["part", "n", "filter", "before", "fails", "removed", "gone", *[f"mark{i}" for i in range(marks)]]
            yield pa.RecordBatch.from_arrays([
                pa.array([part] * len(masks), pa.string()), pa.array(np.full(len(masks), own[0])),
                pa.array([f for f, _ in masks], pa.int32()), pa.array([m for _, m in masks], pa.int32()),
                *[pa.array(column) for column in table]], names)

    def run(batches):
        sums: dict = {}
        for batch in batches:
            part, n, lists = (batch.column(i) for i in range(3))
            for i in range(batch.num_rows):
                own = lists[i].as_py()
                found = sizes(n[i].as_py(), own[:filters], own[filters:])
                name = part[i].as_py()
                sums[name] = sums[name] + found if name in sums else found
                if len(sums) > PARTS_HELD:
                    yield from rows(sums)
                    sums = {}
        yield from rows(sums)
    return run


def posting_lists(rows: DataFrame, part: Column, flags: list[Column]) -> DataFrame:
    """(part, range, n, lists): per part and id range the rows, and per flag the sorted ids of the rows that have it.

    ``rows`` must be a stored table with a unique long ``_row``.  A range is a run of ids, so a part that holds most
    rows has many lists of bounded length and none that grows with it.
    """
    return (rows.select(part.alias("part"), F.shiftright("_row", RANGE_BITS).alias("range"), "_row",
                        *[F.coalesce(flag, F.lit(False)).alias(f"_f{i}") for i, flag in enumerate(flags)])
            .groupBy("part", "range").agg(F.count(F.lit(1)).alias("n"), F.array(*[
                F.array_sort(F.collect_list(F.when(F.col(f"_f{i}"), F.col("_row")))) for i in range(len(flags))])
                .alias("lists")))


def audit(spark: SparkSession, rows: DataFrame, part: Column, fails: dict[str, Column], marks: dict[str, Column],
          scratch: Scratch | None = None) -> DataFrame:
    """What each filter does in every order of the ``fails`` filters (one letter each), by ``part``.

    One row per part, ``filter_order`` (all orders, applied from the left) and
    ``step`` (from 1): rows ``kept`` after the step, ``removed`` in it,
    ``redundant`` (fail its filter, removed earlier), ``unique_fails`` (fail
    its filter only), ``<mark>_lost`` (removed in it and marked) and
    ``shapley`` (removed by its filter, summed over all orders).

    What a filter removes depends on the set of filters before it alone, so
    each set's posting lists are merged once and orders look their sums up.
    Lists are bounded by RANGE_BITS; ranges are independent and their sizes
    add up.  Null flags are false; rows may repeat (each counts); without rows
    the result is empty.
    """
    ship_code(spark)
    scratch = scratch or Scratch(spark, "filteraudit")
    names, k = list(fails), len(fails)
    stored = scratch.stage(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")
    lists = scratch.stage(posting_lists(stored, part, [*fails.values(), *marks.values()]), "lists")
    lost = [f"mark{i} long" for i in range(len(marks))]
    found = lists.select("part", "n", "lists").mapInArrow(
        _interactions(k, len(marks)),
        ", ".join(["part string, n long, filter int, before int, fails long, removed long, gone long", *lost]))
    sums = [F.sum(c).alias(c) for c in ("n", "fails", "removed", "gone", *[f"mark{i}" for i in range(len(marks))])]
    sets = scratch.stage(found.groupBy("part", "filter", "before").agg(*sums), "sets")
    size = F.bit_count("before")
    orders = F.get(F.array(*[F.lit(factorial(i) * factorial(k - 1 - i)) for i in range(k)]), size)
    alone = size == k - 1
    filters = sets.groupBy("part", "filter").agg(F.sum(F.col("removed") * orders).cast("long").alias("shapley"),
                                                 F.max(F.when(alone, F.col("removed"))).alias("unique_fails"))
    steps = [("".join(names[f] for f in order), i + 1, order[i], sum(1 << f for f in order[:i]))
             for order in permutations(range(k)) for i in range(k)]
    # k * k! rows whatever the data
    plan = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, filter int, before int"))
    return sets.join(plan, ["filter", "before"]).join(filters, ["part", "filter"]).select(
        "part", "filter_order", "step", (F.col("n") - F.col("gone")).alias("kept"), "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
        *[F.col(f"mark{i}").alias(f"{name}_lost") for i, name in enumerate(marks)], "shapley")


def judged(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per row of ``docs``: part, the failures A to E, and whether its labels call it good and toxic.

    A: under 200 words; B: under half of the words distinct; C: over 2 % of
    the code points are A-Z; D: any of ``#$%&*|``; E: the text of a smaller
    doc_id.  A null text is empty, a null source the empty part; rows without
    doc_id never fail E and have no labels; of several labels of a doc_id each
    counts.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"),
                        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"))
    letters = F.length("text") - F.length(F.regexp_replace("text", "[A-Z]+", ""))
    flags = scratch.stage(words.select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), (F.size("words") < 200).alias("A"),
        (F.size(F.array_distinct("words")) * 100 < F.size("words") * 50).alias("B"),
        (letters * 100 > F.length("text") * 2).alias("C"), F.col("text").rlike("[#$%&*|]").alias("D")), "flags")
    # staged, so that the join below deals both sides itself and a group of copies can be split over tasks
    first = scratch.stage(flags.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("_n"))
                          .where("_n > 1").select("digest", "first"), "first")
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"),
                                         F.max(F.col("toxic") == 1).alias("toxic"))
    return (flags.join(first, "digest", "left").join(marks, "doc_id", "left")
            .select("part", "A", "B", "C", "D", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).alias("E"),
                    "good", "toxic"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How five text filters overlap in every order, per source of ``documents``."""
    scratch = Scratch(spark, "filteraudit")
    rows = judged(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"),
                  scratch)
    return audit(spark, rows, F.col("part"), {f: F.col(f) for f in "ABCDE"},
                 {m: F.col(m) for m in ("good", "toxic")}, scratch)


FILTER_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         MIN(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
r AS (
  SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic,
         (CASE WHEN len(words) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 2 * length(text) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN coalesce(d.doc_id > first, FALSE) THEN 16 ELSE 0 END) AS mask
  FROM d LEFT JOIN l USING (doc_id)),
g AS (SELECT part, mask, COUNT(*) AS n, COUNT(*) FILTER (WHERE good) AS good, COUNT(*) FILTER (WHERE toxic) AS toxic
      FROM r GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT '' AS filter_order, 0 AS before
  UNION ALL
  SELECT filter_order || letter, before + bit FROM o, letters WHERE (before & bit) = 0),
s AS (
  SELECT f.filter_order, p.i::INT AS step, x.bit, (SELECT SUM(y.bit) FROM letters y
         WHERE position(y.letter IN left(f.filter_order, p.i::INT - 1)) > 0) AS before
  FROM (SELECT filter_order FROM o WHERE before = 31) f, range(1, 6) p(i), letters x
  WHERE x.letter = substr(f.filter_order, p.i::INT, 1)),
c AS (
  SELECT g.part, s.filter_order, s.step, s.bit,
         SUM(n) FILTER (WHERE (mask & (coalesce(before, 0) + bit)) = 0) AS kept,
         SUM(n) FILTER (WHERE (mask & bit) > 0 AND (mask & coalesce(before, 0)) = 0) AS removed,
         SUM(n) FILTER (WHERE (mask & bit) > 0 AND (mask & coalesce(before, 0)) > 0) AS redundant,
         SUM(n) FILTER (WHERE mask = bit) AS unique_fails,
         SUM(good) FILTER (WHERE (mask & bit) > 0 AND (mask & coalesce(before, 0)) = 0) AS good_lost,
         SUM(toxic) FILTER (WHERE (mask & bit) > 0 AND (mask & coalesce(before, 0)) = 0) AS toxic_lost
  FROM g, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(SUM(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM c
"""

"""op13 against a brute-force version, and its posting-list merges against sets."""

from itertools import permutations

import pytest
from conftest import write_tables
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from portacube.llm import filteraudit

IDS = st.lists(st.integers(0, 60), unique=True).map(sorted)


@settings(max_examples=200, deadline=None)
@given(st.lists(IDS, max_size=5))
def test_union_of_sorted_lists(lists):
    assert filteraudit.union(lists) == sorted(set().union(*lists))


@settings(max_examples=200, deadline=None)
@given(IDS, IDS)
def test_difference_of_sorted_lists(a, b):
    assert filteraudit.difference(a, b) == sorted(set(a) - set(b))


@settings(max_examples=100, deadline=None)
@given(IDS, st.integers(0, 70), st.integers(0, 60))
def test_gallop_finds_the_first_place(ids, value, at):
    at = min(at, len(ids))
    assert filteraudit.gallop(ids, at, value) == next((i for i in range(at, len(ids)) if ids[i] >= value), len(ids))


def words(text):
    return [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]


def brute(rows, labels):
    """The contract, row by row and order by order."""
    marked = {name: {i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k, name in enumerate(("good", "toxic"))}
    docs = [(i, t or "", s or "") for i, t, s in rows]
    out = {}
    for part in {s for _, _, s in docs}:
        fails = {f: set() for f in "ABCDE"}
        own = [(k, i, t) for k, (i, t, s) in enumerate(docs) if s == part]
        for k, i, t in own:
            w = words(t)
            for f, failed in zip("ABCDE", (
                    len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                    any(c in "#$%&*|" for c in t),
                    i is not None and any(j is not None and j < i and u == t for j, u, _ in docs)), strict=True):
                if failed:
                    fails[f].add(k)
        ids = {k: i for k, i, _ in own}
        removed_by = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = set(ids)
            for step, f in enumerate(order, 1):
                gone, before = left & fails[f], len(fails[f])
                left = left - gone
                removed_by[f] += len(gone)
                steps.append(("".join(order), step, f, len(left), len(gone), before - len(gone), gone))
        for order, step, f, kept, gone, redundant, rows_gone in steps:
            alone = fails[f] - set().union(*(fails[g] for g in "ABCDE" if g != f))
            out[part, order, step] = (kept, gone, redundant, len(alone),
                                      *(sum(ids[k] in marked[m] for k in rows_gone) for m in ("good", "toxic")),
                                      removed_by[f])
    return out


def audited(spark, folder):
    return {(r["part"], r["filter_order"], r["step"]): (
        r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"])
        for r in filteraudit.op13_filter_audit(spark, folder).collect()}


LONG = " ".join(f"w{i}" for i in range(220))
ROWS = [(1, LONG, "a"), (2, LONG, "a"), (2, LONG, "b"), (3, None, "a"), (4, "", None), (5, "SHORT TEXT", ""),
        (6, " ".join(["same"] * 250), "a"), (7, LONG + " 100 %", "b"), (8, LONG.upper(), "b"), (None, LONG, "b"),
        (None, "", None), (9, "é é\x0b\x0ca #", "a"), (10, LONG, "a"), (10, LONG, "a"), (11, "x" * 300_000, "b")]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (6, 1, None), (8, 0, 1), (None, 1, 1), (99, 1, 1)]
TYPES = {"documents": "doc_id long, text string, source string", "labels": "doc_id long, quality int, toxic int"}


def folder(spark, tmp_path, rows, labels):
    return write_tables(spark, str(tmp_path), documents=(rows, TYPES["documents"]), labels=(labels, TYPES["labels"]))


def test_nulls_ties_repeated_rows_and_empty_texts(spark, tmp_path):
    assert audited(spark, folder(spark, tmp_path, ROWS, LABELS)) == brute(ROWS, LABELS)


def test_a_part_over_many_id_ranges(spark, tmp_path, monkeypatch):
    """Ranges of four ids and a part that holds nearly all rows add up to the same sums."""
    monkeypatch.setattr(filteraudit, "RANGE_BITS", 2)
    rows = [(i, f"{LONG if i % 3 else 'few'} {'#' if i % 5 == 0 else ''}{i % 7}", "hot" if i % 10 else f"s{i}")
            for i in range(120)]
    labels = [(i, i % 2, i % 4 == 0 and 1 or 0) for i in range(0, 120, 3)]
    assert audited(spark, folder(spark, tmp_path, rows, labels)) == brute(rows, labels)


def test_empty_tables(spark, tmp_path):
    df = filteraudit.op13_filter_audit(spark, folder(spark, tmp_path, [], []))
    assert df.collect() == [] and df.columns == [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def test_own_filters_and_clashing_columns(spark):
    rows = spark.createDataFrame([(i, i % 2 == 0, i % 3 == 0, "x", 7) for i in range(30)],
                                 "i int, even boolean, third boolean, part string, _row int")
    got = {(r["filter_order"], r["step"]): (r["kept"], r["removed"], r["odd_lost"], r["shapley"]) for r in filteraudit.audit(
        spark, rows, F.lit("p"), {"E": F.col("even"), "T": F.col("third")}, {"odd": F.col("i") % 2 == 1}).collect()}
    assert got == {("ET", 1): (15, 15, 0, 25), ("ET", 2): (10, 5, 5, 15), ("TE", 1): (20, 10, 5, 15),
                   ("TE", 2): (10, 10, 0, 25)}


@pytest.mark.parametrize("lists", [[], [[]], [[], []]])
def test_union_of_nothing(lists):
    assert filteraudit.union(lists) == []

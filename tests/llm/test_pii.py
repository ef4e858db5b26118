"""op1: base spans against a plain scanner, added spans on planted variants, defined cases."""

import hashlib
import re

import pytest
from conftest import write_tables

from portacube.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum((2 * int(c) - 9 if 2 * int(c) > 9 else 2 * int(c)) if i % 2 else int(c)
               for i, c in enumerate(reversed(d))) % 10 == 0


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end(), kind))
    out.sort()
    return out


def check(rows, got):
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in rows:
        want = base(t)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, e, k in want)
        r = by[i].pop()
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest(), (i, joined, r["spans"])
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w[3] == k for w in want) for k in PATTERNS]
        assert set(joined.split(",")) - {""} <= set(r["spans"].split(","))
    assert not any(by.values())


def run(spark, scratch, rows):
    write_tables(spark, scratch, documents=(rows, "doc_id long, text string"))
    return pii.op1_pii(spark, scratch).collect()


def test_query_on_test_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = pii.op1_pii(spark, sf).collect()
    check(rows, got)
    plain = {i for i, t in rows if not re.search("[0-9]|@", t or "")}
    assert not any(r["spans"] for r in got if r["doc_id"] in plain)


def test_edges_of_the_base_rules(spark, scratch):
    rows = [(1, "a@b.com_x@c.com d@e f@g.h. i@j.k.l@m.n"), (2, "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3"),
            (3, "4111 1111 1111 1111 4111111111111112 4-1-1-1-1111 1111 1111 11 1"), (4, "+1 (555) 555-1234+49 30 1"),
            (5, None), (6, ""), (7, "é\U0001f600 x@y.org \U0001f600+12345678901"), (8, "@@@ a@ @b.c a@-.-"),
            (None, "q@r.st"), (9, "dup@a.bc"), (9, "dup@a.bc"), (10, "+123456789012345678901 +1.2 (3)4567890-"),
            (11, "x" * 2_000 + "@y.zz " + "1" * 2_000 + " a." * 500), (12, "a@" + "b." * 500 + "c"),
            (13, "word " * 60_000 + "e@f.gh")]
    check(rows, run(spark, scratch, rows))


def test_very_long_runs(spark, scratch):
    n = 300_000  # runs on which a pattern that rescans would take hours
    rows = [(1, "x" * n + "@y.zz " + "1" * n + " a." * n), (2, "a@" + "b." * n + "c"), (3, "1." * n), (4, "+" * n)]
    got = {r["doc_id"]: r["spans"] for r in run(spark, scratch, rows)}
    assert got[1] == f"email:0:{n + 5}" and got[2] == f"email:0:{2 * n + 3}" and got[4] == ""
    assert got[3].split(",")[:2] == ["ip:0:7", "ip:8:15"] and got[3].count(",") + 1 == n // 4


def test_adds_disguised_spans_and_keeps_clean_text(spark, scratch):
    rows = [(i, f"plain words here, contact me by mail: user{i}@mail{i % 9}.example.com or call +1 (555) 555-{1000 + i} "
                f"from 10.1.{i % 200}.{i % 99} or key=ab{i * 7919}cd") for i in range(150)]
    rows += [(1000 + i, f"please write to the contact e-mail: name{i} [at] host{i}.example.com soon") for i in range(30)]
    rows += [(2000 + i, f"call the phone number 555 555-{2000 + i} today") for i in range(30)]
    rows += [(3000 + i, f"in 19{i:02d} version 3 of 12 items cost 40 each, ratio 2.5 to {i}") for i in range(60)]
    got = run(spark, scratch, rows)
    check(rows, got)
    spans = {r["doc_id"]: r["spans"] for r in got}
    assert sum(spans[1000 + i].startswith("email:") for i in range(30)) >= 27
    assert not any(spans[3000 + i] for i in range(60))


def test_empty_table(spark, scratch):
    assert run(spark, scratch, []) == []


def test_clashing_columns(spark):
    df = spark.createDataFrame([("a@b.cc", 1, "k", 2, "p")], "text string, row int, kind string, i int, pattern string")
    spans, rows, _ = pii.find_personal_data(spark, df)
    assert [(r["kind"], r["start"], r["end"]) for r in spans.collect()] == [("email", 0, 6)]
    assert {"k_row", "k_kind", "k_i", "k_pattern"} <= set(rows.columns)
    with pytest.raises(ValueError):
        rows.columns.index("text")

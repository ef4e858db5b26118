"""op7, op8 and op10: round trips, plain Python versions, held-out accuracy, defined cases."""

import base64
import hashlib
import random

from conftest import write_tables

from portacube.llm import langid, urlfilter, warc
from portacube.llm.scratch import Scratch
from portacube.llm.workers import ship_code

PAGES = "page_id long, url string, html string"


# ------------------------------------------------------------------ archives
def archived(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        again = i is not None and first[h or ""] != i
        out.append((i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "revisit" if again else "response", first[h or ""] if again else None))
    return sorted(out, key=str)


def got_archive(df):
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in df.collect()), key=str)


def test_archive_round_trip(spark, scratch, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    assert got_archive(warc.op7_warc(spark, sf)) == archived(rows)
    rows = [(i, f"http://h{i % 7}.example/p{i % 11}?q\n{i}", f"<p>\r\n\r\n{i % 9}") for i in range(300)]
    rows += [(900, None, None), (901, "", ""), (902, "no scheme", "é\U0001f600"), (903, "http://x/", "z" * 3_000_000),
             (None, "http://x/", None), (904, "a", "dup"), (904, "a", "dup"), (905, "http://WWW.Big.example/A?b#c", "q")]
    write_tables(spark, scratch, pages=([(*r, 1, "x") for r in rows], PAGES + ", offset int, file string"))
    assert got_archive(warc.op7_warc(spark, scratch)) == archived(rows)
    write_tables(spark, scratch, pages=([], PAGES))
    assert warc.op7_warc(spark, scratch).collect() == []


def test_merge_of_runs_and_index_order(spark):
    rng = random.Random(1)
    runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(9))) for _ in range(7)]
    got = [(runs[r][i], r) for r, i in warc.merge_runs(runs)]
    assert got == sorted((x, r) for r, run in enumerate(runs) for x in run)
    assert list(warc.merge_runs([])) == [] and list(warc.merge_runs([[1, 2]])) == [(0, 0), (0, 1)]
    ship_code(spark)
    scratch = Scratch(spark, "t")
    folder = scratch.folder("a")
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.example/{i % 3}", str(i)) for i in range(400)], PAGES)
    index = warc.merge_index(spark, warc.write_archives(spark, pages.repartition(9), folder, scratch), scratch)
    rows = sorted(index.collect(), key=lambda r: r["position"])
    assert [r["position"] for r in rows] == list(range(400))
    keys = [(r["urlkey"], r["ts"], r["page_id"]) for r in rows]
    assert keys == sorted(keys) and rows[0]["urlkey"].startswith("example,h0)/")
    per = {r["urlkey"]: r["captures"] for r in warc.histories(index).collect()}
    assert len(per) == 15 and sum(per.values()) == 400


def test_merge_reads_runs_block_by_block(tmp_path, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(warc, "BLOCK_ROWS", 3)
    monkeypatch.setattr(warc, "MERGED_ROWS", 5)
    rng = random.Random(2)
    rows = []
    for r in range(6):
        own = [(rng.choice("abc"), f"t{rng.randrange(4)}", rng.choice([None, 1, 2, 3])) for _ in range(rng.randrange(1, 20))]
        own.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))
        rows += [(*k, f"run{r}", i, "f", i, 1) for i, k in enumerate(own)]
    names = ["urlkey", "ts", "page_id", "run", "seq", "file", "offset", "length"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    table = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
    out = list(warc._merge(f"file://{tmp_path}")(table.to_batches(max_chunksize=4)))
    got = pa.Table.from_batches(out)
    assert got.column("place").to_pylist() == list(range(len(rows))) and max(b.num_rows for b in out) <= 5
    key = [(x["urlkey"], x["ts"], x["page_id"] is not None, x["page_id"] or 0, x["run"], x["seq"]) for x in got.to_pylist()]
    assert key == sorted(key) and len(set(key)) == len(rows)
    assert list(warc._merge(f"file://{tmp_path}")([])) == []


# ------------------------------------------------------------------ urls
def judged(url):
    """Host, path, rule and verdict by the rules alone."""
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, kind) for kind, h, p in urlfilter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules_and_labels(spark, scratch, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()]
    for r in urlfilter.op8_url_templates(spark, sf).collect():
        host, path, rule, verdict = judged(dict(rows)[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if verdict else r["verdict"] in ("allow", "block")
    urls = ["HTTP://A.COM/x", "http://a.com", "http://a.com?x", "http://example.com/en/1", "https://www.EXAMPLE.com/en/",
            "x://b.net/es/1", "x://b.net/fr/?q", "x://b.net/de/1#f", "net/es/", "", None, "://net/es/x", "http://é.net/fr/",
            "http://notexample.com/en/", "http://a://b/c", "http://h.org/" + "/".join("abcdefghijkl"), "x://\n.net/es/"]
    pages = [(i, u, None) for i, u in enumerate(urls)] + [(3, urls[3], None), (None, urls[0], None)]
    write_tables(spark, scratch, pages=(pages, PAGES), labels=([], "doc_id long, quality int, toxic int"))
    got = urlfilter.op8_url_templates(spark, scratch).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = judged(urls[0 if r["page_id"] is None else r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    write_tables(spark, scratch, pages=([], PAGES))
    assert urlfilter.op8_url_templates(spark, scratch).collect() == []


def test_url_templates_split_bad_branches(spark):
    rows = [(i, f"http://h.org/{'spam' if i % 4 == 0 else 'news' if i % 4 == 1 else 'blog'}/{i}/x-{i}.html",
             (1 if i % 4 == 0 else 0) if i % 2 == 0 or i % 3 == 0 else None) for i in range(2000)]
    rows += [(5000 + i, f"http://clean.org/{'ab'[i % 2]}/{i}", 0) for i in range(50)]
    df = spark.createDataFrame([(*r, 1, "t") for r in rows], "page_id long, url string, bad int, n int, template string")
    got = {r["page_id"]: r for r in urlfilter.judge(spark, df, rules=()).collect()}
    assert len(got) == len(rows)
    assert all((got[i]["verdict"] == "block") == (i % 4 == 0) for i in range(2000))
    assert all(got[5000 + i]["verdict"] == "allow" for i in range(50))
    assert {got[i]["template"] for i in range(0, 2000, 4)} == {"/spam/{n}/{*}"}
    assert {got[5000 + i]["template"] for i in range(50)} == {"/*/{n}"}


def test_url_templates_of_deep_paths(spark):
    deep = "/".join("abcdefghijkl")
    rows = [(i, f"http://h.org/{deep}/{'spam' if i % 2 else 'news'}/{i}/x/{'tail/' * 3}", i % 2 if i % 3 else None)
            for i in range(600)]
    rows += [(1000, "http://one.org/a//7/" + "b/" * 30 + "9.html", 0), (1001, "http://two.org/" + "b/" * 20, 0),
             (1002, "http://two.org/" + "b/" * 20, 0), (1003, "http://two.org", 0), (1004, "http://two.org/b/**/b", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, bad int")
    got = {r["page_id"]: r for r in urlfilter.judge(spark, df, rules=()).collect()}
    assert len(got) == len(rows)
    assert all((got[i]["verdict"] == "block") == (i % 2 == 1) for i in range(600))
    assert {got[i]["template"] for i in range(1, 600, 2)} == {"/*" * 12 + "/spam/{n}" + "/*" * 4 + "/"}
    assert got[1000]["template"] == "/{*}//{n}" + "/{*}" * 30 + "/{n}.html"
    assert got[1001]["template"] == got[1002]["template"] == "/*/{*}" + "/*" * 18 + "/"
    assert got[1003]["template"] == ""


def walk(urls):
    """Templates by a plain walk of the tree, segment by segment; {(host, path): template}."""
    import math
    import re

    def shape(x):
        for rule, name in ((r"[0-9]+", "{n}"), (r"[0-9]+\.[A-Za-z]{1,5}", "{n}." + x.split(".")[-1]),
                           (r"[0-9]{4}-[0-9]{2}(?:-[0-9]{2})?", "{date}"), (r"(?=.*[0-9])[0-9A-Fa-f-]{8,}", "{hex}"),
                           (r"(?=(?:.*[0-9]){3}).{12,}", "{id}")):
            if re.fullmatch(rule, x):
                return name
        return "" if x == "" else None
    done, level = {}, {}
    for (host, path), counts in urls.items():
        segments = path[1:].split("/") if path else []
        level.setdefault((host, ""), []).append((path, segments, counts))
    while level:
        below = {}
        for (host, t), group in level.items():
            left = [u for u in group if u[1]]
            done.update({(host, u[0]): t for u in group if not u[1]})
            if not left:
                continue
            kids = {}
            for u in left:
                own = kids.setdefault(u[1][0], [0, 0, 0])
                for i in range(3):
                    own[i] += u[2][i]
            pn, pm, pb = (sum(k[i] for k in kids.values()) for i in range(3))
            for path, segments, counts in left:
                if len(left) == 1:  # alone: its other segments have no siblings
                    n = counts[0]
                    done[host, path] = t + "".join("/" + (shape(x) if shape(x) is not None else "{*}" if n == 1 and (
                        i or n < urlfilter.MIN_SUPPORT and 2 > n) else "*") for i, x in enumerate(segments))
                    continue
                n, m, b = kids[segments[0]]
                rest, bad = pm - m, pb - b
                pooled = pb / max(pm, 1)
                differs = (m > 0 and rest > 0 and 0 < pooled < 1 and abs(b / m - bad / rest)
                           / math.sqrt(pooled * (1 - pooled) * (1 / m + 1 / rest)) > urlfilter.SIMILAR_Z)
                token = shape(segments[0])
                if token is None:
                    token = ("{*}" if n < urlfilter.MIN_SUPPORT and len(kids) * 2 > pn else segments[0] if differs else "*")
                below.setdefault((host, f"{t}/{token}"), []).append((path, segments[1:], counts))
        level = below
    return done


def test_templates_against_a_plain_walk(spark, scratch):
    rng = random.Random(8)
    words = ["news", "spam", "a", "b", "", "12", "7.html", "2020-01", "deadbeef12", "x1y2z3longer"]
    urls = {}
    for _ in range(700):
        depth = rng.choice([0, 1, 1, 2, 3, 3, 4, 6, 9])
        host = rng.choice(["hot.org", "hot.org", "b.org", "c.net"])
        path = "".join("/" + rng.choice(words if i != 1 else [*words, *(f"t{k}" for k in range(60))]) for i in range(depth))
        m = rng.randrange(4)
        urls[host, path] = (m + rng.randrange(1, 4), m, m if "spam" in path else rng.randrange(m + 1) // 3)
    # pages at every depth of a trap, and a chain that only two urls share
    for i in range(40):
        urls["trap.org", "/x" * i + "/y"] = (1 + i % 3, 1, i % 2)
    for end in ("/p/q", "/p", "/r/s/t"):
        urls["chain.org", "/k/12/l//m" + end] = (2, 0, 0)
    rows = [(h, p, *c) for (h, p), c in urls.items()]
    df = spark.createDataFrame(rows, "host string, path string, n long, labelled long, bad long")
    got = {(r["host"], r["path"]): r["template"] for r in urlfilter.templates(spark, df, Scratch(spark, "walk")).collect()}
    expect = walk(urls)
    assert {k: v for k, v in got.items() if v != expect[k]} == {} and len(got) == len(urls)


def test_a_path_of_500_segments_takes_few_rounds(spark, scratch):
    """Before, every segment of the longest shared path was a round of jobs (four urls of 25 segments: 32 s)."""
    import time
    deep = "/s" * 500
    rows = [("t.org", deep + f"/{x}", 1, 0, 0) for x in ("a", "b")] + [("t.org", "/s" * i, 1, 0, 0) for i in range(0, 500, 50)]
    df = spark.createDataFrame(rows, "host string, path string, n long, labelled long, bad long")
    began = time.time()
    got = {r["path"]: r["template"] for r in urlfilter.templates(spark, df, Scratch(spark, "deep")).collect()}
    assert time.time() - began < 120
    assert got[deep + "/a"] == "/*" * 500 + "/{*}" and got["/s" * 250] == "/*" * 250 and got[""] == ""


# ------------------------------------------------------------------ languages
def test_language_on_test_table(spark, sf):
    given = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = langid.op10_language_id(spark, sf).collect()
    assert len(rows) == len(given)
    assert sum(r["text_language"] == given[r["doc_id"]] for r in rows) >= 0.97 * len(rows)  # by the text alone
    assert sum(r["kept"] for r in rows) >= 0.98 * len(rows)


def test_held_out_accuracy(spark, sf):
    """The text model fitted without half of the labels names the other half."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr(
        "doc_id", "text", "if(doc_id % 2 = 0, lang, null) as lang", "lang as truth")
    rows = langid.identify(spark, docs).where("doc_id % 2 = 1").collect()
    assert sum(r["language"] == r["truth"] for r in rows) >= 0.97 * len(rows)


def test_evidence_and_defined_cases(spark):
    en, fr = "the house and the garden of the old man with the hat ", "la maison et le jardin du vieil homme avec le chapeau "
    rows = [(i, en * (1 + i % 4), "en", "a.example.org") for i in range(60)]
    rows += [(100 + i, fr * (1 + i % 4), "fr-FR", "b.example.org") for i in range(60)]
    rows += [(200, None, "en", "a.example.org"), (201, "", None, None), (202, " \t", None, None), (203, "x", "fr", "b.example.org"),
             (204, "x", None, "a.example.org"), (205, "Ω≈ç√∫˜µ≤≥÷ΩΩΩ" * 40, None, None), (None, en, None, None), (0, en, "en", None),
             (206, fr * 30_000, None, None)]
    df = spark.createDataFrame([(*r, "z", 1) for r in rows],
                               "doc_id long, text string, lang string, host string, language string, grams int")
    out = langid.identify(spark, df)
    got = out.collect()
    assert "text" not in out.columns and len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["language"] == "en" and by[i]["kept"] for i in range(60))
    assert all(by[100 + i]["language"] == "fr" and by[100 + i]["kept"] for i in range(60))
    assert not any(by[i]["kept"] for i in (200, 201, 202, 205)) and by[200]["language"] is None
    # too short for the text model: the declared language, the host
    assert by[203]["language"] == "fr" and by[204]["language"] == "en"
    assert by[206]["language"] == "fr" and by[None]["language"] == "en"
    none = langid.identify(spark, df.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert [r["kept"] for r in none.collect()] == [False] * len(rows)
    assert langid.identify(spark, df.limit(0)).collect() == []


def sentences(rng, words):
    return " ".join(rng.choice(words) for _ in range(rng.randrange(20, 60)))


def invented(seed, letters, n=80):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(3, 8))) for _ in range(n)]


def test_many_unexplained_rows_are_rejected(spark):
    """Half of the rows nearest to a language are in an unmodelled one, or gibberish; all come from one host."""
    rng = random.Random(5)
    one, two, other = invented(1, "abcdefgh"), invented(2, "ijklmnop"), invented(3, "αβγδεζηθ")
    rows = [(i, sentences(rng, (one, two)[i % 2]), (("aa", "bb")[i % 2] if i % 3 else None), "h.org") for i in range(600)]
    rows += [(1000 + i, sentences(rng, other), None, "hot.org") for i in range(300)]
    rows += [(2000 + i, "".join(rng.choice("qrstuvwxyz0123456789#$%&") for _ in range(200)), None, "hot.org")
             for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    got = {r["doc_id"]: r for r in langid.identify(spark, df).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["kept"] and got[i]["language"] == ("aa", "bb")[i % 2] for i in range(600))
    assert not any(r["kept"] for i, r in got.items() if i >= 1000)


def test_more_languages_than_one_block(spark):
    rng = random.Random(9)
    names = [a + b for a in "abcdefgh" for b in "abcdefghij"][:70] + ["zz"]
    words = {x: invented(x, "abcdefghijklmnopqrstuvwxyz") for x in names}
    rows = [(x, x) for x in names for _ in range(6 if x != "zz" else 3)] + [(x, None) for x in names for _ in range(2)]
    rows = [(i, sentences(rng, words[x]), said, x) for i, (x, said) in enumerate(rows)]
    rows += [(1000 + i, "".join(rng.choice("αβγδεζηθ0123456789#$%&") for _ in range(300)), None, None) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    assert len(names) > langid.BLOCK
    got = langid.identify(spark, df).collect()
    assert len(got) == len(rows)
    assert all(r["kept"] and r["language"] == r["truth"] for r in got if r["doc_id"] < 1000)
    assert not any(r["kept"] for r in got if r["doc_id"] >= 1000)


def test_markup_language_after_a_preamble(spark):
    pages = [(1, "http://a.fi/doc/1", "<!DOCTYPE html>\n<html lang=\"fi\"><p>x"),
             (2, "http://a.sv/doc/2", "<?xml version='1.0'?>\n<!-- " + "licence text " * 300 + "-->\n<html class='x' lang='sv'>"),
             (3, "http://a.no/doc/3", " \n" * 5000 + "<HTML LANG=no>"), (4, "http://a.no/doc/4", None)]
    got = {r["doc_id"]: r["markup"] for r in langid.page_evidence(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {1: "fi", 2: "sv", 3: "no", 4: ""}


def test_two_pages_of_one_document(spark):
    """A stated markup language counts before an empty one, whichever host or place in the table it has."""
    pages = [(1, "http://h.org/doc/7", "<html><p>no language"), (2, "http://h.org/doc/7?a", "<html lang=fi>"),
             (3, "http://a.org/doc/8", None), (4, "http://b.org/doc/8", "<html lang=sv>"), (5, "http://c.org/doc/9", ""),
             (6, "http://b.org/doc/9", None)]
    got = {r["doc_id"]: (r["markup"], r["host"]) for r in
           langid.page_evidence(spark.createDataFrame(pages, PAGES)).collect()}
    assert got == {7: ("fi", "h.org"), 8: ("sv", "b.org"), 9: ("", "b.org")}


def test_scoring_holds_no_more_for_a_long_text():
    """64 languages and a text of 50 MB: the gathered scores alone would take 24 GB."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    table = np.random.default_rng(1).integers(0, 9, (64, langid.BUCKETS)).astype(float)
    text = ("the house and the garden of the old man with the hat " * (1 + (50 << 20) // 53))[:50 << 20]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2]), pa.array([text, text[:3000]]), pa.array([3, None], pa.int32()), pa.array([True, False]),
         pa.array([[], []], pa.list_(pa.float64())), pa.array([None, None], pa.float64())], [str(i) for i in range(6)])
    tracemalloc.start()
    out = next(langid._score(table, table.sum(axis=0), 0, 1, True)([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20
    own = langid._grams(np.frombuffer(text[:3000].encode(), np.uint8))
    model = np.log(langid._shares(table, table.sum(axis=0), table.sum(axis=1, keepdims=True), table.sum()))
    assert np.allclose(out.column(4)[1].as_py(), model[:, own].mean(axis=1))
    # counted or gathered, the same mean
    piece = np.frombuffer(text.encode(), np.uint8)
    whole = sum(model[:, langid._grams(x)].sum(axis=1) for x in langid._pieces(piece[:langid.PIECE + 2]))
    short = pa.RecordBatch.from_arrays([*[c.slice(0, 1) for c in batch.columns[:1]], pa.array([text[:langid.PIECE + 2]]),
                                        *[c.slice(1, 1) for c in batch.columns[2:]]], [str(i) for i in range(6)])
    got = next(langid._score(table, table.sum(axis=0), 0, 1, True)([short])).column(4)[0].as_py()
    assert np.allclose(got, whole / langid.PIECE)

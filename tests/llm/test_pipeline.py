"""The pipeline on the test tables and on awkward ones: each stage against its own rules."""

import re

import corpus_pipeline as cp
from conftest import write_tables
from test_decontam import brute as leaks_of
from test_minhash import brute as groups_of

from portacube.llm import decontam, mixing, tokenfile

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def stage(spark, scratch, name, docs, sf):
    out = dict(cp.STAGES)[name](spark, docs, sf)
    out.write.mode("overwrite").parquet(f"{scratch}/{name}")
    return spark.read.parquet(f"{scratch}/{name}")


def test_stages_on_test_tables(spark, sf, scratch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    given = {r["doc_id"]: r for r in docs.collect()}
    a = stage(spark, scratch, "language", docs, sf)
    assert a.columns == docs.columns and a.count() > 0.97 * len(given)
    same = sum(r["lang"] == given[r["doc_id"]]["lang"] for r in a.collect())
    assert same > 0.97 * len(given)
    b = stage(spark, scratch, "near_duplicates", a, sf)
    rows = sorted((r["doc_id"], r["text"]) for r in a.collect())
    assert sorted(r["doc_id"] for r in b.collect()) == [i for i, _, _, k in sorted(groups_of(rows, 5)) if k]
    c = stage(spark, scratch, "benchmark", b, sf)
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    code = {r["doc_id"]: bytes(decontam.normalise(r["text"])[0].astype("<u4")) for r in b.collect()}
    exact = {d for d in code for _, t in items if bytes(decontam.normalise(t)[0].astype("<u4")) in code[d]}
    gone = set(code) - {r["doc_id"] for r in c.collect()}
    assert exact and exact <= gone
    near = [(d, given[d]["text"]) for d in gone - exact][:3]
    assert len({d for d, _, _ in leaks_of(near, items)}) == len(near)
    d = stage(spark, scratch, "mix", c, sf)
    words = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in c.collect()}
    got = {}
    for r in d.collect():
        text, whole = r["text"], given[r["doc_id"]]["text"]
        assert text == whole or whole.startswith(text)
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(WORD.findall(text))
    sized = c.select("doc_id", "source", mixing.word_count().alias("size"))
    expect = {r["doc_id"]: r["taken"] for r in mixing.mix(spark, sized).collect() if r["taken"]}
    assert got == expect and all(got[i] <= 2 * words[i] for i in got)
    e = stage(spark, scratch, "token_files", d, sf)
    assert e.count() == d.count() and [r["doc_id"] for r in e.orderBy("start").collect()] == sorted(
        r["doc_id"] for r in d.collect())


def test_run_on_awkward_tables(spark, scratch):
    english = "the cat sat on the mat and then it went over the hill to see the other side of the valley "
    french = "le chat est sur la table et puis il est parti vers la colline pour voir la mer avec nous "
    rows = [(i, english + f"number {i} says {i * 31} " * 3, "en", "a" if i % 3 else None, 1) for i in range(40)]
    rows += [(100 + i, french + f"numero {i} dit {i * 17} " * 3, "fr", "b", None) for i in range(40)]
    rows += [(200, None, None, None, None), (201, "", "en", "a", 0), (202, " \n", "en", "a", 0), (None, english, "en", "a", 1),
             (203, english * 3000, "en", "c", 1), (0, english + "number 0 says 0 " * 3, "en", "a", 1)]
    pages = [(1, "http://x.example.org/fr/100", "<html lang='fr'>"), (2, None, None)]
    items = [(1, "number 5 says 155 number 5 says 155 number 5 says 155"), (2, None)]
    write_tables(spark, scratch, documents=([(*r, 7) for r in rows], SCHEMA + ", taken int"),
                 pages=(pages, "page_id long, url string, html string"), benchmark=(items, "item_id long, text string"))
    got = cp.run(spark, scratch).collect()
    ids = {r["doc_id"] for r in got}
    # the row without doc_id has the shingles of 203
    assert 5 not in ids and not ids & {200, 201, 202, None} and 203 in ids and all(r["n_tokens"] > 1 for r in got)
    empty = scratch + "/none"
    write_tables(spark, empty, documents=([], SCHEMA), pages=([], "page_id long, url string, html string"),
                 benchmark=([], "item_id long, text string"))
    assert cp.run(spark, empty).collect() == []


def test_rows_of_one_id_are_judged_row_by_row(spark, scratch, sf):
    english = "the cat sat on the mat and then it went over the hill to see the other side of the valley today "
    other = "a boat came down the river in the morning while all the people of the town were still asleep there "
    rows = [(5, None, "en", "a", 0), (5, english, "en", "a", 1), (6, english * 2 + "one more time", "en", "a", 1),
            (6, other, "en", "a", 1), (6, other, "en", "a", 1), (None, english, "en", "a", 1), (4, other + "again", "en", "a", 1),
            (None, "this row has no number but it is a clean text of its own that nobody else wrote down", "en", "a", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = stage(spark, scratch, "near_duplicates", docs, sf)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect())
    assert got == sorted([(5, ""), (5, english), (6, english * 2 + "one more time"), (4, other + "again"), (0, rows[-1][1])])
    spoken = {(r["doc_id"], r["text"]) for r in stage(spark, scratch, "language", docs, sf).collect()}
    assert (5, english) in spoken and (None, rows[-1][1]) in spoken and (5, None) not in spoken


def test_token_files_encode_every_whole_text(spark, scratch, sf, monkeypatch):
    write, asked = tokenfile._write, []
    monkeypatch.setattr(tokenfile, "_write", lambda folder, path, *words: asked.append(words) or write(folder, path, *words))
    rows = [(i, "the same words again and again", "en", "a", 1) for i in range(6)] + [(None, None, None, None, None)]
    out = stage(spark, scratch, "token_files", spark.createDataFrame(rows, SCHEMA), sf)
    assert asked == [(False,)] and out.count() == 7

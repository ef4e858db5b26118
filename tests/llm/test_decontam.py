"""op6 against full alignment of every passage with every text, and its defined cases."""

import random

import numpy as np

from portacube.llm import decontam

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def edits(passage, text):
    """Least edits of the whole passage against any stretch of the text (plain dynamic programme)."""
    cost = np.zeros(len(text) + 1, dtype=np.int64)
    slope = np.arange(len(text) + 1)
    for i, c in enumerate(passage):
        step = np.empty_like(cost)
        step[0] = i + 1
        step[1:] = np.minimum(cost[:-1] + (text != c), cost[1:] + 1)
        cost = np.minimum.accumulate(step - slope) + slope
    return int(cost.min())


def brute(docs, items):
    out = set()
    for i, t in items:
        p = decontam.normalise(t)[0]
        if t is None or not len(p):
            continue
        if len(p) < decontam.MIN_CHARS:  # word for word
            words = plain(t)
            out |= {(d, i, 0) for d, text in docs if f" {words} " in f" {plain(text)} "}
            continue
        budget = min(int(len(p) * decontam.EDIT_RATE), (len(p) - decontam.Q) // decontam.Q)
        for d, text in docs:
            e = edits(p, decontam.normalise(text)[0])
            if e <= budget:
                out.add((d, i, e))
    return out


def plain(text):
    return bytes(decontam.normalise(text)[0].astype("<u4")).decode("utf-32-le")


def run(spark, docs, items):
    got = decontam.leaks(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return {(r["doc_id"], r["item_id"], r["edits"]) for r in got}, got


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé ") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_brute_force_with_edits(spark):
    rng = random.Random(4)
    items = [(i, words(rng, rng.randint(6, 30))) for i in range(12)] + [(50, None), (51, "too short"), (52, "")]
    docs = []
    for d in range(60):
        text = words(rng, 60)
        if d % 2:
            p = list(items[rng.randrange(12)][1])
            for _ in range(rng.randint(0, max(1, len(p) // 8))):
                k, what = rng.randrange(len(p)), rng.randrange(3)
                if what == 0:
                    p[k] = rng.choice("xyz")
                elif what == 1:
                    del p[k]
                else:
                    p.insert(k, rng.choice("xyz"))
            cut = rng.randrange(len(text))
            text = text[:cut] + " " + "".join(p).upper() + "!? " + text[cut:]
        docs.append((d, text))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1]), (102, items[1][1])]
    got, rows = run(spark, docs, items)
    assert got == brute(docs, items) and len({x[0] for x in got}) > 15
    for r in rows:
        if r["doc_id"] == 102 and r["item_id"] == 1:
            assert r["edits"] == 0 and r["end"] == len(items[1][1].rstrip())


def test_query_on_test_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in decontam.op6_leaks(spark, sf).collect()}
    code = {d: bytes(decontam.normalise(t)[0].astype("<u4")) for d, t in docs}
    exact = {(d, i) for d, _ in docs for i, t in items if bytes(decontam.normalise(t)[0].astype("<u4")) in code[d]}
    assert exact and exact <= got
    some = {d for d, _ in exact} | {d for d, _ in docs[:6]}
    few = [x for x in docs if x[0] in some and len(x[1]) < 4000]
    chosen = [x for x in items if any(x[0] == i for _, i in exact)][:4]
    assert {(d, i, e) for d, i, e in brute(few, chosen)} == run(spark, few, chosen)[0]


def test_long_text_blocks_and_filter(spark, monkeypatch):
    rng = random.Random(9)
    items = [(i, words(rng, 25)) for i in range(6)]
    long = words(rng, 300_000)
    docs = [(1, long + " " + items[2][1] + " " + long[:50]), (2, long), (3, items[4][1] + long), (4, "  ")]
    got, _ = run(spark, docs, items)
    assert got == {(1, 2, 0), (3, 4, 0)}
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 200)
    assert run(spark, docs, items)[0] == got
    df = spark.createDataFrame([(d, t, d, "x") for d, t in docs], DOCS + ", item_id int, budget string")
    kept = decontam.decontaminate(spark, df, spark.createDataFrame(items, ITEMS))
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {2, 4}


def test_empty(spark):
    assert run(spark, [], [(1, "a passage that is long enough to count")])[0] == set()
    assert run(spark, [(1, "text")], [])[0] == set()


def test_short_passages_stand_word_for_word(spark):
    items = [(1, "What is 2 plus 2?"), (2, "2"), (3, "yes"), (None, "no way"), (5, "?!"), (6, "What is 2 plus 2?"),
             (7, "exactly 23 characters !"), (8, "a b")]
    docs = [(1, "He asked: what is  2 plus 2? Then left."), (2, "What is 2 plus 22?"), (3, "Yes."), (4, "yesterday 12 2x"),
            (5, "xno way"), (6, "no-way"), (7, "EXACTLY, 23 characters"), (8, None), (9, ""), (10, "a b a b"), (11, "a"),
            (12, "b")]
    got, rows = run(spark, docs, items)
    assert got == brute(docs, items) and {(1, 1, 0), (1, 6, 0), (1, 2, 0), (3, 3, 0), (6, None, 0), (7, 7, 0)} <= got
    assert not {d for d, _, _ in got} & {4, 5, 8, 9}
    at = next(r for r in rows if r["doc_id"] == 1 and r["item_id"] == 1)
    assert (docs[0][1][at["start"]:at["end"]], at["budget"]) == ("what is  2 plus 2", 0)
    kept = decontam.decontaminate(spark, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert {r["doc_id"] for r in kept.collect()} == set(range(1, 13)) - {1, 7}


def test_short_passages_in_long_texts(spark):
    """Parts of a long text end between words."""
    rng = random.Random(3)
    text = words(rng, 250_000).replace("é", "e")
    plant = text[:1_100_000] + " Zz top 1 " + text[1_100_000:]
    items = [(1, "zz top 1"), (2, "zz"), (3, "nowhere"), (4, "e")]
    docs = [(1, plant), (2, text)]
    assert run(spark, docs, items)[0] == brute(docs, items)

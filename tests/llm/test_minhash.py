"""op5 against brute force on small corpora, and its defined cases."""

import random
import re

from portacube.llm import minhash
from portacube.llm.components import components
from portacube.llm.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, k, threshold=80):
    sets = [(i, shingles(t, k)) for i, t in rows]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is None or j is None or not a or not b:
                continue
            both = len(a & b)
            if 100 * both >= threshold * (len(a) + len(b) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i), i is None or i == find(i)) for i, s in sets), key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def corpus(seed, n, family):
    """Families of edited copies around the threshold, chains included."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, doc = [], 0
    for _ in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 80))]
        for _ in range(rng.randint(1, family)):
            rows.append((doc, " ".join(words)))
            doc += 1
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            words = words.copy()
    return rows


def test_brute_force_on_edited_families(spark):
    rows = corpus(3, 40, 12)
    rows += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "one"), (9004, "ONE"), (9005, "one two"),
             (9006, "One\x0btwo"), (None, "one two"), (9007, "Éa b"), (9008, "éa b"), (9006, "One\x0btwo")]
    for k in (2, 5):
        df = minhash.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), words=k)
        assert result(df) == brute(rows, k)


def test_rows_of_one_id_with_different_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(5, a), (5, b), (9, b), (12, b + " c"), (3, a + " c"), (20, "x y z"), (20, None), (18, "x y z"), (21, None)]
    got = result(minhash.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), words=2))
    assert got == sorted(
        ((i, len(shingles(t, 2)), c, i == c) for (i, t), c in zip(rows, [3, 3, 3, 3, 3, 18, 18, 18, 21])), key=str)
    rng = random.Random(11)
    rows = [(rng.randrange(150) if i % 4 == 0 else 1000 + i, t) for i, t in corpus(8, 60, 6)]
    assert len({i for i, _ in rows}) < len(rows)
    assert result(minhash.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), words=2)) == brute(rows, 2)


def test_query_on_test_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert result(minhash.op5_minhash(spark, sf)) == brute(rows, 2)


def test_large_family_and_clashing_columns(spark):
    rng = random.Random(5)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(700):  # copies of one text, each edited on its own: some pairs lie below the threshold
        words = base.copy()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame([(i, t, 1, "s", b"k") for i, t in rows],
                               "doc_id long, text string, key int, sign string, print binary")
    assert result(minhash.near_duplicates(spark, df, words=2)) == brute(rows, 2)


def test_empty_and_long(spark):
    assert minhash.near_duplicates(spark, spark.createDataFrame([], SCHEMA)).collect() == []
    rng = random.Random(1)
    words = [f"t{rng.randrange(3000)}" for _ in range(400_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-5])), (3, "y" * 3_000_000), (4, "y" * 3_000_000 + " z")]
    assert result(minhash.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), words=5)) == brute(rows, 5)


def test_components_of_long_path_and_star(spark):
    rng = random.Random(2)
    path = list(range(200))
    edges = [(path[i], path[i + 1]) for i in range(199)] + [(500, 501 + i) for i in range(300)] + [(7, 7)]
    names = {i: rng.randrange(10**9) for i in range(900)}
    got = components(spark.createDataFrame([(names[a], names[b]) for a, b in edges], "u long, v long"),
                     Scratch(spark, "t"), "c").collect()
    expect = {names[i]: min(names[j] for j in path) for i in path}
    expect |= {names[i]: min(names[j] for j in range(500, 801)) for i in range(500, 801)}
    assert {r["node"]: r["component"] for r in got} == expect and len(got) == len(expect)


def test_components_end_with_stars(spark):
    """Stars are told from what is none by every edge: a chain, a node of two parents, a tied centre."""
    from portacube.llm.components import _stars

    def stars(edges):
        return _stars(spark.createDataFrame(edges, "u long, v long"))
    assert stars([]) and stars([(2, 1), (3, 1), (9, 8)])
    assert not stars([(2, 1), (3, 2)]) and not stars([(3, 1), (3, 2)]) and not stars([(5, 1), (6, 1), (9, 5)])
    many = [(i, 1) for i in range(2, 3000)]
    assert stars(many) and not stars([*many, (4000, 2999)])

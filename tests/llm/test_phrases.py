"""op11 against counts of every n-gram, and its indexes against plain search."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import write_tables

from portacube.llm import phrases, textkit

SCHEMA = "doc_id long, text string, lang string"


def pieces(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split(r"[\x20\x09]+", p) if w] for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, top=phrases.TOP):
    count, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for words in pieces(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i:i + k])] += 1
    found = {q: a for q, a in count.items() if len(q[1]) > 1 and a >= least}
    out = {}
    for (lang, q), a in found.items():
        if any(f >= a and g == lang and len(p) > len(q) and any(p[i:i + len(q)] == q for i in range(len(p)))
               for (g, p), f in found.items()):
            continue
        cuts = [(1000 * a * n[lang] // (count[lang, q[:k]] * count[lang, q[k:]]), k, count[lang, q[:k]], count[lang, q[k:]])
                for k in range(1, len(q))]
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(q).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s) for lang, own in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(own)[:top], 1))


def corpus(n, seed):
    draw = random.Random(seed)
    some = ["a", "b", "c", "new", "york", "city", "éa", "Zed", "x1"]
    out = []
    for i in range(n):
        text = "".join(draw.choice(some) + draw.choice([" ", " ", "  ", "\t", " ", ". ", ",", "\n"])
                       for _ in range(draw.randint(0, 40)))
        out.append((i, text + draw.choice(["", "new york city hall", "New York. city", "a a a a a a"]),
                    draw.choice(["en", "en", "de", None, ""])))
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(tuple(r) for r in phrases.collocations(spark, df, **options).collect())


def test_counts_over_many_shards(spark):
    rows = corpus(150, 1)
    assert mined(spark, rows, least=6, shard_words=200) == brute(rows, 6)


def test_first_phrases_of_each_language(spark):
    rows = corpus(100, 2)
    assert mined(spark, rows, least=4, top=5) == brute(rows, 4, 5)


def test_defined_cases(spark):
    rows = [(1, None, "en"), (2, "", None), (None, "one two three", "en"), (None, "one two three", "en"),
            (3, "One  TWO\tthree. one two", "en"), (4, ".,;:!?", "x"), (5, "to be " * 3000, None),
            (6, "w" * 100_000 + " big", "en"), (7, "ÄB äb ÄB äb", "de"), (8, "a b c a b c", "de")]
    assert mined(spark, rows, least=2, shard_words=500) == brute(rows, 2)


def test_nothing_frequent_and_empty(spark, tmp_path):
    assert mined(spark, [(1, "a b c", "en")], least=2) == []
    folder = write_tables(spark, str(tmp_path), documents=([], SCHEMA))
    assert phrases.op11_phrases(spark, folder).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_index_intervals(seed):
    """Every frequent phrase's two intervals hold just the places where it stands."""
    draw = np.random.default_rng(seed)
    s = np.where(draw.random(400) < 0.1, 0, draw.integers(1, 5, 400)).astype(np.int32)
    s[[0, -1]] = 0
    index = phrases.Index.load(phrases.Index.build(s, np.arange(5)).dump())
    words, state, order = {i: (i,) for i in range(1, 5)}, index.words(), phrases._sorted_places(s)
    back = phrases._sorted_places(s[::-1])
    for size in range(2, phrases.DEPTH + 1):
        lo, rlo, n, prefix, suffix = index.grow(*state, size == 2)
        keep = n >= 3
        lo, rlo, n, prefix, suffix = (x[keep] for x in (lo, rlo, n, prefix, suffix))
        every = Counter(tuple(s[i:i + size].tolist()) for i in range(len(s) - size + 1) if s[i:i + size].all())
        known = {}
        for j in range(len(n)):
            q = (*words[prefix[j]], words[suffix[j]][-1])
            assert words[suffix[j]] == q[1:]
            assert {tuple(s[i:i + size].tolist()) for i in order[lo[j]:lo[j] + n[j]]} == {q}
            assert {tuple(s[::-1][i:i + size].tolist()) for i in back[rlo[j]:rlo[j] + n[j]]} == {q[::-1]}
            known[j] = q
        assert {q: int(n[j]) for j, q in known.items()} == {q: c for q, c in every.items() if c >= 3}
        words, state = known, (lo, rlo, n, np.arange(len(n)))


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(phrases, "SEGMENT", 40)
    text = "Some words, and more of them; then a piece that is longer than a part of a text is here. End " * 5
    got = []
    for _, bounds, data in phrases._parts(*textkit.strings(pa.array([text]))):
        raw, sizes, first, _ = phrases._words(data, bounds)
        at = np.concatenate([[0], np.cumsum(sizes)])
        for i in range(len(sizes)):
            if first[i]:
                got.append([])
            got[-1].append(raw[at[i]:at[i + 1]].tobytes().decode())
    assert got == [p for p in pieces(text) if p]

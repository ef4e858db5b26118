"""op2 and op3 against plain Python, and their defined cases."""

import hashlib
import re
import zlib

import pytest
from conftest import write_tables

from portacube.llm import mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def shards(rows, n=40):
    """(doc_id, crc, size) in order, cut where the middle of a row's bytes passes a target."""
    items = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16)
                    for i, t in rows))
    total, at, out, slots = sum(x[3] for x in items), 0, [], {}
    for some, i, crc, size in items:
        shard = min(n - 1, (2 * at + size) * n // (2 * total))
        out.append((i if some else None, size, crc, shard, slots.setdefault(shard, 0), at))
        slots[shard] += 1
        at += size
    return sorted(out, key=str)


def got_shards(df):
    return sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"], r["byte_start"])
                   for r in df.collect()), key=str)


def test_shards_of_test_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = sharding.op2_byte_shards(spark, sf)
    assert got_shards(df) == shards(rows)
    assert {r["law"] for r in df.collect()} == {"bytes"} and {r["grown_shard"] for r in df.collect()} == {None}


def test_shards_of_awkward_rows(spark, scratch):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(500)] + [(None, None), (None, "é"), (7, None), (7, None), (8, "")]
    rows += [(1000, "hot")] * 400 + [(2000, "y" * 200_000)]
    write_tables(spark, scratch, documents=([(*r, "s") for r in rows], SCHEMA))
    assert got_shards(sharding.op2_byte_shards(spark, scratch)) == shards(rows)
    write_tables(spark, scratch, documents=([], SCHEMA))
    assert sharding.op2_byte_shards(spark, scratch).collect() == []


def test_shards_are_balanced_and_columns_may_clash(spark):
    df = spark.range(4000).selectExpr("id", "id % 50 + 1 as size", "id as _part", "id as _total", "id as _n")
    out = sharding.shard_by_bytes(spark, df, "size", ["id"], 8)
    report = sharding.shard_totals(out, "size").collect()
    assert len(report) == 8 and all(abs(r["of_mean"] - 1) < 0.01 for r in report)


def mixed(rows, weights=(3, 1, 2), share=1.5, cap=2, seed=17):
    sized = [(i, s, len(WORD.findall(t or ""))) for i, t, s in rows]
    names = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, s or ""))
    size = {n: sum(z for _, s, z in sized if s == n) for n in names}
    weight = {n: weights[k % 3] for k, n in enumerate(names)}
    budget, clamped = share * sum(size.values()), set()
    while True:
        free = [n for n in names if n not in clamped]
        if not free:
            break
        level = (budget - sum(cap * size[n] for n in clamped)) / sum(weight[n] for n in free)
        over = {n for n in names if weight[n] * level > cap * size[n]}
        if over == clamped:
            break
        clamped = over
    target = {n: min(cap * size[n], weight[n] * level) for n in names}
    out = []
    for n in names:
        own = sorted((x for x in sized if x[1] == n), key=lambda x: (
            hashlib.md5(f"{seed}:{x[0]}".encode() if x[0] is not None else f"{seed}".encode()).hexdigest(),
            x[0] or 0, x[2]))
        whole = int(target[n] // max(size[n], 1))
        rest = int(target[n]) - whole * size[n]
        for i, _, z in own:
            extra = max(0, min(z, rest))
            rest -= z
            out.append((i, z, size[n], pytest.approx(target[n]), whole * z + extra))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def got_mix(df):
    return sorted(((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in df.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[4]))


def test_mix_of_awkward_rows(spark, scratch):
    rows = [(i, "w " * (i * 13 % 90), f"s{i % 5}") for i in range(300)] + [(i, "a b c", "big") for i in range(300, 900)]
    rows += [(900, "x y", None), (901, None, None), (902, "", "empty"), (None, "n n n", "s1"), (903, "é\x0bb\x85c", "é"),
             (904, "dup dup", "Z"), (904, "dup dup", "Z"), (905, "long " * 40_000, "s0")]
    write_tables(spark, scratch, documents=(rows, SCHEMA))
    got = got_mix(mixing.op3_source_mix(spark, scratch))
    assert got == mixed(rows)
    assert got == got_mix(mixing.op3_source_mix(spark, scratch))
    assert all(t <= 2 * z for _, z, _, _, t in got)


def test_mix_of_test_table_and_empty(spark, sf, scratch):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    assert got_mix(mixing.op3_source_mix(spark, sf)) == mixed(rows)
    write_tables(spark, scratch, documents=([], SCHEMA))
    assert mixing.op3_source_mix(spark, scratch).collect() == []


def test_mix_columns_may_clash(spark):
    df = spark.createDataFrame([(1, "a", 5, 9, 9, 9)], "doc_id long, source string, size long, target int, taken int, "
                               "weight int")
    out = mixing.mix(spark, df).first()
    assert out["taken"] == 7 and out["weight"] == 9

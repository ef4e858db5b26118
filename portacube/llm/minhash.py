"""Near-duplicate texts by MinHash, banding, verification and connected components."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm import textkit
from portacube.llm.components import components
from portacube.llm.scratch import Scratch
from portacube.llm.workers import ship_code

HASHES = 128
BAND_ROWS = 4  # 32 bands: a pair at 0.8 is missed by all with probability 5e-8
MARGIN = 80  # of 128 equal minima; a pair at 0.8 has fewer with probability 2e-7
BLOCK = 2048  # members of a bucket in one comparison block
GROUP_ROWS = 512  # members of a group in one comparison block, with their sets
GROUP_BYTES = 8 << 20
_U = np.uint64


def _family(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and offsets of the universal hashes x -> high bits of a * x + b."""
    rng = np.random.Generator(np.random.PCG64(seed))
    return (rng.integers(0, 1 << 64, HASHES, dtype=np.uint64) | _U(1),
            rng.integers(0, 1 << 64, HASHES, dtype=np.uint64))


def signature(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least value of every hash over a non-empty set (uint32)."""
    a, b = family
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        values = a[:, None] * shingles[None, at:at + 2048]
        values += b[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> _U(32)).astype(np.uint32)


def _print(shingles: bytes) -> bytes | None:
    return hashlib.blake2b(shingles, digest_size=16).digest() if shingles else None


def _sketch(words: int):
    def run(batches):
        family = _family()
        for batch in batches:
            sizes, prints, signs = [], [], []
            for _, hashes in textkit.text_words(batch.column(1)):
                shingles = textkit.shingle_set(hashes, words)
                sizes.append(len(shingles))
                prints.append(_print(shingles.tobytes()))
                signs.append(signature(shingles, family).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()),
                 pa.array(signs, pa.binary())], ["id", "n", "print", "sign"])
    return run


def _sets(words: int):
    def run(batches):
        for batch in batches:
            ids, prints, sets, held = [], [], [], 0
            for row, hashes in textkit.text_words(batch.column(1)):
                ids.append(row)
                sets.append(textkit.shingle_set(hashes, words).tobytes())
                prints.append(_print(sets[-1]))
                held += len(sets[-1])
                if held > 16 << 20 or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids)), pa.array(prints, pa.binary()),
                                                      pa.array(sets, pa.binary())], ["id", "print", "shingles"])
                    ids, prints, sets, held = [], [], [], 0
    return run


def _bands(batches):
    """(id, key) for each band of each signature."""
    n = HASHES // BAND_ROWS
    for batch in batches:
        if not batch.num_rows:
            continue
        sign = _matrix(batch.column(1)).reshape(batch.num_rows, n, BAND_ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(n, dtype=np.uint64), (batch.num_rows, n)).copy()
        for i in range(BAND_ROWS):
            key = textkit.scramble(key * _U(0xD6E8FEB86659FD93) + sign[:, :, i] + _U(1))
        ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), n)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(key.reshape(-1).view(np.int64))], ["id", "key"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(len(column), HASHES)


def _alike(batches):
    """Pairs whose signatures agree in MARGIN places at least."""
    for batch in batches:
        if batch.num_rows:
            agree = (_matrix(batch.column(2)) == _matrix(batch.column(3))).sum(axis=1)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(agree >= MARGIN))


def _grouped(batches, keys: int):
    """(first row's columns, column arrays) of each run of rows that are equal in the first ``keys`` long columns."""
    held, mark = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        block = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)], axis=1)
        cuts = np.flatnonzero((np.diff(block, axis=0) != 0).any(axis=1)) + 1
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(block)]):
            part, here = batch.slice(lo, hi - lo), tuple(block[lo])
            if here == mark:
                held.append(part)
                continue
            if held:
                yield pa.Table.from_batches(held).combine_chunks()
            held, mark = [part], here
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _long(table, name) -> np.ndarray:
    return table.column(name).to_numpy()


def _across(batches):
    """One alike partner of every member in every other component of its bucket block.

    Members of the block's largest component are only partners: every pair
    between components has an end outside it.
    """
    for group in _grouped(batches, 3):
        ids, comps, side = _long(group, "id"), _long(group, "component"), _long(group, "side")
        signs = _matrix(group.column("sign"))
        names, where, sizes = np.unique(comps, return_inverse=True, return_counts=True)
        largest = where == int(sizes.argmax())
        out = []
        for i in np.flatnonzero(~largest):
            over = np.flatnonzero((comps != comps[i]) & ((side != side[i]) | (side.min() == side.max())))
            agree = (signs[over] == signs[i]).sum(axis=1)
            hit, agree = over[agree >= MARGIN], agree[agree >= MARGIN]
            order = np.lexsort((-agree, comps[hit]))
            first = np.r_[True, np.diff(comps[hit][order]) != 0] if len(order) else np.zeros(0, bool)
            out += [(ids[i], ids[j]) for j in hit[order][first]]
        u, v = zip(*out) if out else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])


def _links(threshold: int):
    """Links inside comparison blocks that join what the block's earlier links have not joined.

    Pairs with alike signatures are taken in falling order of likeness; a pair
    whose ends are not yet joined is confirmed on the full sets:
    100 * intersection >= threshold * union.
    """
    def linked(p, q):
        if len(p) > len(q):
            p, q = q, p
        if 100 * len(p) < threshold * len(q):
            return False
        at = np.searchsorted(q, p)
        both = int((q[np.minimum(at, len(q) - 1)] == p).sum())
        return 100 * both >= threshold * (len(p) + len(q) - both)

    def run(batches):
        for group in _grouped(batches, 3):
            ids, side = _long(group, "id"), _long(group, "side")
            signs = _matrix(group.column("sign"))
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("shingles")]
            left, right = np.flatnonzero(side == side.min()), np.flatnonzero(side == side.max())
            alone = len(left) == len(ids)
            i, j, agree = [], [], []
            for k, x in enumerate(left):
                over = right[k + 1:] if alone else right
                same = (signs[over] == signs[x]).sum(axis=1)
                hit = np.flatnonzero(same >= MARGIN)
                i.append(np.full(len(hit), x))
                j.append(over[hit])
                agree.append(same[hit])
            i, j, agree = (np.concatenate(x) for x in (i, j, agree))
            root = list(range(len(ids)))

            def find(x):
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x
            out = []
            for k in np.argsort(-agree, kind="stable"):
                x, y = find(int(i[k])), find(int(j[k]))
                if x != y and linked(sets[i[k]], sets[j[k]]):
                    root[y] = x
                    out.append((ids[i[k]], ids[j[k]]))
            u, v = zip(*out) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
    return run


def _blocks(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Deal each group's rows to all pairs (i <= j) of its ``blocks`` blocks; ``side`` is a row's own block."""
    mine = F.pmod(F.xxhash64("id"), F.col(blocks))
    out = (rows.withColumn("side", mine)
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1)))
           .withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("other", blocks))
    front = [group, "i", "j"]
    return (out.select(*front, *[c for c in out.columns if c not in front]).repartition(*front)
            .sortWithinPartitions(*front))


def near_duplicates(spark: SparkSession, docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5,
                    threshold: int = 80) -> DataFrame:
    """Components of documents linked by shingle sets with 100 * intersection >= ``threshold`` * union.

    1. Texts with equal shingle sets form a class, numbered as a node.
    2. 128 universal hash minima per class, 32 bands of 4 rows.  In a bucket
       every member is paired with one hub, so a group of any size gives one
       pair per member and band; pairs with alike signatures are kept.
    3. Where a bucket's members are still apart, they are compared by
       signature, block by block, and one alike partner per member and
       component is kept.  Large-star and small-star over the kept pairs
       give groups outside which no link can be.
    4. Inside a group, block against block, alike pairs that are not yet
       joined are confirmed on full sets.  Large-star and small-star over the
       confirmed links, and links between the classes of one id, give the
       components; the least id of each names it.

    Returns (id, n_shingles, component_id, kept): ``kept`` marks the least id.
    Defined cases: texts that are null, empty or white space have an empty
    set and are linked with nothing; a null id is linked with nothing and
    kept, its component is null; rows of one id, whatever their texts, are
    linked and get one component; an empty input gives an empty result.  Other columns are ignored.
    """
    ship_code(spark)
    scratch = Scratch(spark, "minhash")
    given = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sketch = scratch.stage(given.mapInArrow(_sketch(words), "id long, n long, print binary, sign binary"), "sketch")
    named = sketch.where("id is not null and print is not null")
    classes = scratch.stage(named.groupBy("print").agg(F.min("id").alias("rep"))
                            .withColumn("node", F.monotonically_increasing_id()), "classes")
    first = classes.select(F.col("rep").alias("id"), "print", "node")
    # from here to the links, ids are nodes
    signs = scratch.stage(named.join(first, ["id", "print"]).dropDuplicates(["id", "print"])
                          .select(F.col("node").alias("id"), "sign"), "signs")
    bands = scratch.stage(signs.mapInArrow(_bands, "id long, key long"), "bands")
    hubs = (bands.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("members"))
            .where("members > 1"))
    buckets = scratch.stage(bands.join(hubs, "key"), "buckets")
    scratch.drop("bands")

    # every member of a bucket with the bucket's hub
    pairs = buckets.where("id <> hub").select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct()
    alike = (pairs.join(signs.select(F.col("id").alias("u"), F.col("sign").alias("x")), "u")
             .join(signs.select(F.col("id").alias("v"), F.col("sign").alias("y")), "v")
             .select("u", "v", "x", "y").mapInArrow(_alike, "u long, v long"))
    near = components(alike, scratch, "near")

    # members of a bucket that its hub did not bring together
    placed = (buckets.where("members > 2").join(near.withColumnRenamed("node", "id"), "id", "left")
              .withColumn("component", F.coalesce("component", "id")))
    apart = (placed.where("id <> hub").groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo <> hi").select("key"))
    rows = (placed.where("id <> hub").join(apart, "key", "left_semi").join(signs, "id")
            .withColumn("n", F.ceil(F.col("members") / BLOCK)).select("key", "id", "component", "sign", "n"))
    more = scratch.stage(_blocks(rows, "key", "n").mapInArrow(_across, "u long, v long").distinct(), "more")
    star = near.where("node <> component").select(F.col("component").alias("u"), F.col("node").alias("v"))
    groups = scratch.stage(components(star.union(more), scratch, "groups"), "members")
    scratch.drop("buckets", "more")

    # links inside the groups, by full sets
    wanted = groups.join(first, "node")
    texts = given.join(wanted.select("id"), "id", "left_semi")
    sets = scratch.stage(texts.mapInArrow(_sets(words), "id long, print binary, shingles binary")
                         .join(wanted, ["id", "print"]).dropDuplicates(["id", "print"])
                         .select(F.col("node").alias("id"), "component", "shingles"), "sets")
    sizes = sets.groupBy("component").agg(
        F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_ROWS),
                   F.ceil(F.sum(F.length("shingles")) / GROUP_BYTES)).alias("n"))
    rows = sets.join(sizes, "component").join(signs, "id")
    links = scratch.stage(_blocks(rows, "component", "n").mapInArrow(_links(threshold), "u long, v long"), "links")
    scratch.drop("sets")
    # the classes of one id
    several = (named.groupBy("id").agg(F.min("print").alias("one"), F.max("print").alias("other"))
               .where("one <> other").select("id", "one"))
    same = (named.join(several, "id").where("print <> one").select("one", "print").distinct()
            .join(classes.select(F.col("print").alias("one"), F.col("node").alias("u")), "one")
            .join(classes.select("print", F.col("node").alias("v")), "print").select("u", "v"))
    found = scratch.stage(components(links.union(same), scratch, "linked").join(classes, "node")
                          .select("node", "component", "rep"), "found")
    least = found.groupBy("component").agg(F.min("rep").alias("_component"))
    member = classes.join(found.join(least, "component").select("node", "_component"), "node", "left").select(
        "print", F.coalesce("_component", "rep").alias("_component"))
    # empty texts of an id that has others
    empty = sketch.where("id is not null and print is null").select("id").distinct()
    others = (named.join(empty, "id", "left_semi").join(member, "print").groupBy("id")
              .agg(F.min("_component").alias("_other")))
    out = sketch.select("id", "n", "print").join(member, "print", "left").join(others, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("_component", "_other", "id"))
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("id").eqNullSafe(component).alias("kept"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``documents``: 2-word shingles, similarity 0.8."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), words=2)

"""Near-duplicate embeddings by lattice hashing: projections decoded to E8 points, neighbouring cells probed."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm.components import components
from portacube.llm.scratch import Scratch
from portacube.llm.textkit import scramble
from portacube.llm.workers import ship_code

TABLES = 16
PROBES = 8  # cells looked up per table, the own one included
SPREAD = 0.53  # projected distance of a pair at the threshold, in lattice units
CHUNK = 512
_U = np.uint64


def _roots() -> np.ndarray:
    """0 and the 240 shortest vectors of E8."""
    out = [np.zeros(8)]
    for i, j in itertools.combinations(range(8), 2):
        for s, t in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = s, t
            out.append(v)
    out += [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with even sum."""
    f = np.rint(x)
    err = x - f
    odd = np.flatnonzero(f.sum(axis=1) % 2 != 0)
    worst = np.abs(err[odd]).argmax(axis=1)
    f[odd, worst] += np.where(err[odd, worst] >= 0, 1, -1)
    return f


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the nearer of D8 and D8 shifted by one half."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _planes(dim: int, table: int, threshold: float) -> list[np.ndarray]:
    """Scaled orthonormal projections of one table: two of 8 dimensions, or one for short vectors."""
    wide = 16 if dim >= 16 else 8
    rng = np.random.Generator(np.random.PCG64([dim, table]))
    q = np.linalg.qr(rng.normal(size=(max(dim, wide), wide)))[0][:dim]
    # two unit vectors at the threshold lie sqrt(2 - 2 * threshold) apart, of which 8 / dim reach a projection
    scale = SPREAD / max(np.sqrt((2 - 2 * threshold) * min(1.0, 8 / dim)), 1e-3)
    return [q[:, i:i + 8] * scale for i in range(0, wide, 8)]


def cells(units: np.ndarray, table: int, threshold: float, roots: np.ndarray) -> np.ndarray:
    """Cell numbers of unit vectors in one table: the own cell, then the other probes by distance."""
    total, names = np.zeros((len(units), 1)), np.full((len(units), 1), _U(table + 1))
    for plane in _planes(units.shape[1], table, threshold):
        p = units @ plane
        own = decode(p)
        rest = p - own
        dist = (rest ** 2).sum(axis=1)[:, None] - 2 * rest @ roots.T + (roots ** 2).sum(axis=1)
        near = np.argsort(dist, axis=1, kind="stable")[:, :PROBES]
        near = np.concatenate([np.zeros((len(p), 1), near.dtype), near], axis=1)  # 0: the own cell
        far = np.take_along_axis(dist, near, axis=1)
        far[:, 1:][near[:, 1:] == 0] = np.inf
        points = np.rint((own[:, None, :] + roots[near]) * 2).astype(np.int64).view(np.uint64)
        code = np.zeros(near.shape, np.uint64)
        for i in range(8):
            code = scramble(code * _U(0xD6E8FEB86659FD93) + points[:, :, i] + _U(1))
        both = (total[:, :, None] + far[:, None, :]).reshape(len(p), -1)
        name = scramble(names[:, :, None] * _U(0x9E3779B97F4A7C15) + code[:, None, :]).reshape(len(p), -1)
        both[:, 0] = -np.inf  # the own cells of all blocks come first
        best = np.argsort(both, axis=1, kind="stable")[:, :PROBES]
        total, names = np.take_along_axis(both, best, 1), np.take_along_axis(name, best, 1)
        total[:, 0] = 0
    return names


def _valid(column):
    """(row, vector) of every usable vector: no nulls, all finite, not zero."""
    for i, item in enumerate(column):
        if not item.is_valid or not len(item.values) or item.values.null_count:
            continue
        v = item.values.to_numpy(zero_copy_only=False)
        if np.isfinite(v).all() and v.any():
            yield i, v + v.dtype.type(0)  # no negative zeros


def _prepare(batches):
    """(id, label, dim, print, vector) of usable labelled vectors; the print is of the exact components."""
    for batch in batches:
        at, dims, prints, raws = [], [], [], []
        labels = batch.column(1)
        for i, v in _valid(batch.column(2)):
            if labels[i].is_valid and batch.column(0)[i].is_valid:
                raw = v.tobytes()
                at.append(i)
                dims.append(len(v))
                prints.append(hashlib.blake2b(raw, digest_size=16).digest())
                raws.append(raw)
        take = pa.array(at, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), labels.take(take), pa.array(dims, pa.int64()),
                                          pa.array(prints, pa.binary()), pa.array(raws, pa.binary())],
                                         ["id", "label", "dim", "print", "vector"])


def _floats(raw, dim: int) -> np.ndarray:
    data = raw.as_buffer()
    return np.frombuffer(data, np.float32 if data.size == 4 * dim else np.float64).astype(np.float64)


def _hash(threshold: float):
    def run(batches):
        """(cell, id, own) rows: the own cell and the probes of every vector in every table."""
        roots = _roots()
        for batch in batches:
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                for lo in range(0, len(mine), CHUNK):
                    part = mine[lo:lo + CHUNK]
                    x = np.array([_floats(batch.column(3)[int(i)], int(dim)) for i in part])
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    salt = np.array([int.from_bytes(hashlib.blake2b(f"{dim}:{batch.column(1)[int(i)]}".encode(),
                                                                    digest_size=8).digest(), "little") for i in part],
                                    dtype=np.uint64)
                    names = np.concatenate([cells(x, t, threshold, roots) for t in range(TABLES)], axis=1)
                    names = scramble(names ^ salt[:, None]).view(np.int64)
                    ids = np.repeat(batch.column(0).to_numpy()[part], names.shape[1])
                    own = np.tile(np.arange(names.shape[1]) % PROBES == 0, len(part))
                    yield pa.RecordBatch.from_arrays([pa.array(names.reshape(-1)), pa.array(ids), pa.array(own)],
                                                     ["cell", "id", "own"])
    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise cosine in double precision; vectors are scaled first, so no square overflows."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _verify(threshold: float):
    def run(batches):
        for batch in batches:
            dims, keep = batch.column(2).to_numpy(), np.zeros(batch.num_rows, bool)
            for dim in np.unique(dims):
                mine = np.flatnonzero(dims == dim)
                for lo in range(0, len(mine), 4096):
                    part = mine[lo:lo + 4096]
                    x, y = (np.array([_floats(batch.column(c)[int(i)], int(dim)) for i in part]) for c in (3, 4))
                    keep[part] = cosine(x, y) >= threshold
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["u", "v"]).filter(pa.array(keep))
    return run


def near_duplicates(spark: SparkSession, vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label", threshold: float = 0.93) -> DataFrame:
    """Links of cosine >= ``threshold`` between vectors of equal label, and their components.

    1. Vectors with equal components and label form a class, numbered as a
       node.
    2. In each of TABLES tables a class is projected to two blocks of 8
       dimensions, each decoded to its E8 point; the pair of points is its
       cell.  It is stored in its own cell and looked up in the PROBES cells
       nearest to it.
    3. Pairs that meet are verified by cosine in double precision.  A pair at
       the threshold is met in a table with probability 0.39 in one direction
       alone: one in some thousands is missed by all tables both ways, none
       that is clearly above it.
    4. Large-star and small-star over the links, and links between the classes
       of one id, give the components; the least id of each names it.

    Returns (id, n_links, component_id, kept).  Defined cases: a vector that
    is null, empty, zero or holds null or non-finite components, or whose
    label is null, is linked with nothing; so is a null id, whose component is
    null and which is kept; rows of one id, whatever their vectors, get one
    result: ``n_links`` counts the other ids linked with any of them; vectors of
    different length are never compared; an empty input gives an empty result.
    """
    ship_code(spark)
    scratch = Scratch(spark, "lattice")
    given = vectors.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
                           F.col(vector).alias("vector"))
    usable = scratch.stage(given.mapInArrow(_prepare, "id long, label string, dim long, print binary, vector binary"),
                           "usable")
    classes = scratch.stage(usable.groupBy("label", "dim", "print").agg(
        F.min("id").alias("rep"), F.countDistinct("id").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    of_class = ["label", "dim", "print"]
    # from here to the links, ids are nodes
    reps = scratch.stage(usable.join(classes.select(F.col("rep").alias("id"), "node", *of_class), ["id", *of_class])
                         .dropDuplicates(["id", *of_class])
                         .select(F.col("node").alias("id"), "label", "dim", "vector"), "reps")
    hashed = scratch.stage(reps.mapInArrow(_hash(threshold), "cell long, id long, own boolean"), "hashed")
    # cells that hold one vector and its own probe only are no meeting
    stored = hashed.where("own").select("cell", F.col("id").alias("a"))
    asked = hashed.select("cell", F.col("id").alias("b"))
    pairs = (stored.join(asked, "cell").where("a <> b")
             .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    x = reps.select(F.col("id").alias("u"), F.col("label").alias("lu"), F.col("dim").alias("du"),
                    F.col("vector").alias("x"))
    y = reps.select(F.col("id").alias("v"), F.col("label").alias("lv"), F.col("dim").alias("dv"),
                    F.col("vector").alias("y"))
    met = pairs.join(x, "u").join(y, "v").where("lu = lv and du = dv").select("u", "v", F.col("du").alias("dim"), "x", "y")
    links = scratch.stage(met.mapInArrow(_verify(threshold), "u long, v long"), "links")
    scratch.drop("hashed")
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    both = both.union(classes.select(F.col("node").alias("u"), F.col("node").alias("v")))
    # ids with several classes: their classes are linked, and each is counted once
    mine = usable.select("id", *of_class).distinct()
    again = mine.groupBy("id").count().where("count > 1").select("id")
    several = scratch.stage(mine.join(again, "id").join(classes, of_class).select("id", "node"), "several")
    same = several.join(several.groupBy("id").agg(F.min("node").alias("u")), "id").where("node <> u").select(
        "u", F.col("node").alias("v"))
    sizes = (classes.join(several.groupBy("node").agg(F.count(F.lit(1)).alias("k")), "node", "left")
             .select(F.col("node").alias("v"), (F.col("n") - F.coalesce("k", F.lit(0))).alias("n")))

    def counted(reach, by):
        """Ids in the classes that ``by`` reaches."""
        also = (reach.join(several.withColumnsRenamed({"node": "v", "id": "other"}), "v").select(by, "other").distinct()
                .groupBy(by).agg(F.count(F.lit(1)).alias("also")))
        return (reach.join(sizes, "v").groupBy(by).agg(F.sum("n").alias("n")).join(also, by, "left")
                .select(by, (F.col("n") + F.coalesce("also", F.lit(0)) - 1).alias("n_links")))
    found = scratch.stage(components(links.union(same), scratch, "linked").join(classes, "node")
                          .select("node", "component", "rep"), "found")
    least = found.groupBy("component").agg(F.min("rep").alias("least"))
    per = (classes.join(counted(both, "u").withColumnRenamed("u", "node"), "node", "left")
           .join(found.join(least, "component").select("node", "least"), "node", "left")
           .select(*of_class, "n_links", F.coalesce("least", "rep").alias("component")))
    reach = several.join(both.withColumnRenamed("u", "node"), "node").select("id", "v").distinct()
    of = (usable.select("id", *of_class).join(per, of_class).groupBy("id")
          .agg(F.max("n_links").alias("n_links"), F.min("component").alias("component"))
          .join(counted(reach, "id").withColumnRenamed("n_links", "all_links"), "id", "left")
          .select("id", F.coalesce("all_links", "n_links").alias("n_links"), "component"))
    out = given.select("id").join(of, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among all ``embeddings`` of equal label."""
    return near_duplicates(spark, spark.read.parquet(f"{sf_dir}/embeddings.parquet"))

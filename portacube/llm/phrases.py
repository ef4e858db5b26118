"""Phrase collocations from word-level FM-indexes, one per shard of the texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portacube.llm import remote, textkit
from portacube.llm.scratch import Scratch
from portacube.llm.workers import batch_bytes, ship_code

SHARD_WORDS = 1 << 21  # words of a shard (one piece more at most)
SEGMENT = 1 << 21  # bytes of text tokenised at once
BATCH_BYTES = 8 << 20  # of texts that a worker gets at once
PART_ROWS = 1 << 21  # shards' phrases that one task sums up, at most on average
SHARDS_A_TASK = 12  # bits of a shard's number within its task
PLACE_BITS = 31  # bits of a place in a shard
DEPTH = 5  # words of the longest phrase
LEAST = 100
TOP = 2000

# bytes: 0 of a word, 1 blank, 2 between pieces
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _packed(*columns: np.ndarray, kind: str = "<i8") -> bytes:
    """Columns of numbers, the bytes of equal weight side by side, compressed: small numbers take little."""
    width = np.dtype(kind).itemsize
    planes = b"".join(c.astype(kind).view(np.uint8).reshape(-1, width).T.tobytes() for c in columns)
    return pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, columns: int, rows: int, kind: str = "<i8") -> list[np.ndarray]:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, columns * rows * width, codec="zstd"), np.uint8)
    return [np.ascontiguousarray(x.reshape(width, rows).T).view(kind).ravel() for x in np.split(planes, columns)]


# ------------------------------------------------------------------ tokenising
def _words(data: np.ndarray, bounds: np.ndarray):
    """Word bytes end to end, word sizes, whether a word starts a piece, and its text; ``bounds`` cuts ``data``."""
    kind = KIND[data]
    solid = kind == 0
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(data)]
    start[inner] |= solid[inner]
    s = np.flatnonzero(start)
    piece = np.cumsum(kind == 2, dtype=np.int64)[s]
    text = np.searchsorted(bounds, s, side="right") - 1
    first = np.ones(len(s), bool)
    first[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    place = np.cumsum(solid) - 1
    return LOWER[data[solid]], np.diff(np.append(place[s], int(solid.sum()))), first, text


def _parts(offsets: np.ndarray, data: np.ndarray):
    """(first row, bounds, bytes) of some whole texts at a time; a long text in parts that end between pieces."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SEGMENT, side="right")) - 1)
        own = data[offsets[row]:offsets[to]]
        if to > row + 1 or len(own) <= SEGMENT:
            yield row, offsets[row:to + 1] - offsets[row], own
        else:
            at = 0
            while at < len(own):
                end = min(at + SEGMENT, len(own))
                while end < len(own):
                    free = np.flatnonzero(KIND[own[end:end + SEGMENT]] == 2)
                    if len(free):
                        end += int(free[0]) + 1
                        break
                    end = min(end + SEGMENT, len(own))
                yield row, np.array([0, end - at]), own[at:end]
                at = end
        row = to


class _Shard:
    """Words of consecutive texts."""

    def __init__(self):
        self.bytes, self.sizes, self.first, self.langs, self.n = [], [], [], [], 0

    def add(self, raw, sizes, first, langs) -> None:
        self.bytes.append(raw)
        self.sizes.append(sizes)
        self.first.append(first)
        self.langs.append(langs)
        self.n += len(sizes)

    def symbols(self, names: list[str]) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
        """Symbols of the words (from 1 by falling count, negative where a piece starts), and of each symbol lang, word
        and count."""
        sizes = np.concatenate(self.sizes)
        bounds = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=bounds[1:])
        words = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(np.concatenate(self.bytes)))
        coded = words.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        total = len(coded.dictionary)
        code += np.concatenate(self.langs).astype(np.int64) * total
        used = np.bincount(code, minlength=total * len(names))
        have = np.flatnonzero(used)
        have = have[np.argsort(-used[have], kind="stable")]
        number = np.zeros(len(used), np.int32)
        number[have] = np.arange(1, len(have) + 1)
        symbols = number[code]
        lang = pa.array(names, pa.string()).take(pa.array(have // total))
        word = coded.dictionary.take(pa.array(have % total)).cast(pa.string())
        return np.where(np.concatenate(self.first), -symbols, symbols), lang, word, used[have]


def _tokenise(folder: str, limit: int):
    """Store the symbols of each shard; yield (shard, file, symbol, lang, word, n) for each of its words."""
    def run(batches):
        task, made, shard, langs = TaskContext.get().partitionId(), 0, _Shard(), {}

        def flush():
            symbols, lang, word, n = shard.symbols(list(langs))
            file = remote.NewFile(folder, ".words")
            file.write(_packed(np.abs(symbols) * 2 + (symbols < 0), kind="<i4"))
            file.close()
            number = task << SHARDS_A_TASK | made
            k = len(n)
            for at in range(0, k, 1 << 16):
                m = min(1 << 16, k - at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, number)), pa.array([f"{file.name} {len(symbols)}"] * m, pa.string()),
                     pa.array(np.arange(at + 1, at + m + 1, dtype=np.int32)), lang.slice(at, m), word.slice(at, m),
                     pa.array(n[at:at + m])], ["shard", "file", "symbol", "lang", "word", "n"])
        for batch in batches:
            own = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int32)
            for row, bounds, data in _parts(*textkit.strings(batch.column(1))):
                raw, sizes, first, text = _words(data, bounds)
                byte, at = np.concatenate([[0], np.cumsum(sizes)]), 0
                while at < len(sizes):
                    to = len(sizes)
                    if shard.n + to - at > limit:  # up to the first piece that starts behind the limit
                        free = np.flatnonzero(first[at + limit - shard.n:])
                        to = at + limit - shard.n + int(free[0]) if len(free) else to
                    shard.add(raw[byte[at]:byte[to]], sizes[at:to], first[at:to], own[row + text[at:to]])
                    at = to
                    if shard.n >= limit:
                        yield from flush()
                        made, shard = made + 1, _Shard()
        if shard.n:
            yield from flush()
    return run


# --------------------------------------------------------------------- indexes
def _sorted_places(s: np.ndarray) -> np.ndarray:
    """Places of ``s`` ordered by the DEPTH symbols there (cyclically), by doubling."""
    rank, reach = s.astype(np.int64), 1
    while True:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -reach)
        order = np.argsort(key)
        reach *= 2
        if reach >= DEPTH:
            return order
        ranked = key[order]
        rank = np.empty(len(s), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ranked[1:] != ranked[:-1]]))


def _steps(s: np.ndarray) -> np.ndarray:
    """For each row of the sorted places the row of the place before (last to first)."""
    order = _sorted_places(s)
    row = np.empty(len(s), np.int32)
    row[order] = np.arange(len(s), dtype=np.int32)
    return row[order - 1]  # place -1 is the last


class Index:
    """FM-index of a shard in both directions: steps to the symbol before and to the one behind.

    ``symbols`` 1.. have the global ``ids``; 0 stands between pieces.  Rows
    are sorted by DEPTH symbols, which is all that phrases of that length
    need.  A phrase is a pair of intervals of equal size: ``lo`` in the rows of
    the text, ``rlo`` in those of the reversed text.
    """

    def __init__(self, ids: np.ndarray, counts: np.ndarray, before: np.ndarray, behind: np.ndarray):
        self.ids, self.before, self.behind = ids, before, behind
        self.lows = np.concatenate([[0], np.cumsum(counts)])
        self.symbol = np.repeat(np.arange(len(counts), dtype=np.int32), counts)  # a row's own symbol

    @classmethod
    def build(cls, s: np.ndarray, ids: np.ndarray) -> Index:
        return cls(ids, np.bincount(s, minlength=len(ids)), _steps(s), _steps(s[::-1]))

    def dump(self) -> bytes:
        symbols, rows = _packed(self.ids, np.diff(self.lows)), [_packed(x, kind="<i4") for x in (self.before, self.behind)]
        head = np.array([len(self.ids), len(self.before), len(symbols), *map(len, rows)], "<i8")
        return b"".join([head.tobytes(), symbols, *rows])

    @classmethod
    def load(cls, data: bytes) -> Index:
        v, n, *sizes = np.frombuffer(data, "<i8", 5).tolist()
        cuts = np.cumsum([40, *sizes]).tolist()
        symbols, before, behind = (data[a:b] for a, b in zip(cuts, cuts[1:], strict=False))
        return cls(*_unpacked(symbols, 2, v), *_unpacked(before, 1, n, "<i4"), *_unpacked(behind, 1, n, "<i4"))

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(lo, rlo, size, id) of the single words."""
        return self.lows[1:-1], self.lows[1:-1], np.diff(self.lows)[1:], self.ids[1:]

    def extend(self, steps: np.ndarray, own: np.ndarray, other: np.ndarray, size: np.ndarray):
        """One word more for the intervals ``own``: (interval, symbol, its rows in ``steps``' order, in the other
        order, size).  Rows of the other order lie sorted by the added symbol."""
        first = np.cumsum(size) - size
        rows = steps[np.repeat(own - first, size) + np.arange(int(size.sum()))]
        key = np.repeat(np.arange(len(size)), size) * len(self.ids) + self.symbol[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        which, symbol = key[at] // len(self.ids), key[at] % len(self.ids)
        low = np.minimum.reduceat(rows[order], at) if len(at) else np.zeros(0, np.int64)
        n = np.diff(np.append(at, len(key)))
        on = symbol > 0
        return which[on], symbol[on], low[on].astype(np.int64), (other[which] + at - first[which])[on], n[on]

    def grow(self, lo: np.ndarray, rlo: np.ndarray, size: np.ndarray, ids: np.ndarray, single: bool):
        """Phrases a word longer whose first words and whose last words are both among the given ones:
        (lo, rlo, size, id of the first words, id of the last words)."""
        which, symbol, rlow, low, n = self.extend(self.behind, rlo, lo, size)
        if single:
            return low, rlow, n, ids[which], self.ids[symbol]
        left, _, left_low, _, _ = self.extend(self.before, lo, rlo, size)
        order = np.argsort(left_low)
        left, left_low = left[order], left_low[order]
        place = np.searchsorted(left_low, low)
        found = place < len(left_low)
        found[found] = left_low[place[found]] == low[found]
        return low[found], rlow[found], n[found], ids[which[found]], ids[left[place[found]]]


def _runs(symbols: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The stored symbols as an index needs them: rare words end a run, runs of one word are left out, 0 between runs."""
    own = number[np.abs(symbols)]
    keep = own > 0
    first = symbols < 0
    first[1:] |= ~keep[:-1]
    own, first = own[keep], first[keep]
    if not len(own):
        return np.zeros(1, np.int32)
    first[0] = True
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(own)))
    long = np.repeat(size > 1, size)
    own, first = own[long], first[long]
    return np.append(np.insert(own, np.flatnonzero(first), 0), 0).astype(np.int32)


def _read(folder: str, name: str) -> bytes:
    with remote.open_file(folder, name) as file:
        return file.read()


def _build(words: str, folder: str):
    """Index one shard from its stored symbols and the ids of its frequent words; (shard, file) of the index."""
    def run(table: pa.Table) -> pa.Table:
        name, size = next(x for x in table["file"].to_pylist() if x).split(" ")
        marked, = _unpacked(_read(words, name), 1, int(size), "<i4")
        symbols = np.where(marked & 1, -(marked >> 1), marked >> 1)
        given = table.filter(pa.compute.is_valid(table["id"])).sort_by("symbol")
        frequent, ids = given["symbol"].to_numpy(), given["id"].to_numpy()
        number = np.zeros(int(np.abs(symbols).max()) + 1, np.int32)
        number[frequent] = np.arange(1, len(frequent) + 1)
        index = Index.build(_runs(symbols, number), np.concatenate([[0], ids]))
        file = remote.NewFile(folder, ".fm")
        file.write(index.dump())
        file.close()
        return pa.table({"shard": table["shard"][:1], "file": pa.array([file.name])})
    return run


def _dealt(prefix: np.ndarray, suffix: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases ordered by part and key, and where the parts begin; a key's part does not depend on the shard."""
    mixed = textkit.scramble(prefix.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + suffix.astype(np.uint64))
    part = (mixed % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((suffix, prefix, part))
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _offer(folder: str, size: int, parts: int):
    """One shard's phrases of ``size`` words for the tasks that sum them, a packed row per part.

    The shard comes with the name of its index and, of the words one shorter,
    the places and ids of its frequent phrases.  These it walks again from
    the state stored a length before, and stores them as the next state,
    whose name it passes on as a row of a part below 0.
    """
    def run(table: pa.Table) -> pa.Table:
        shard = table["shard"][0].as_py()
        index = Index.load(_read(folder, next(x for x in table["file"].to_pylist() if x)))
        parted, counts, blobs = [], [], []
        state = index.words()
        if size > 2:
            rows = list(zip(*(table[c].to_pylist() for c in ("part", "rows", "blob")), strict=True))
            stored = [(rows, blob.decode()) for part, rows, blob in rows if part is not None and part < 0]
            if stored:
                state = tuple(_unpacked(_read(folder, stored[0][1]), 4, stored[0][0]))
            lo, rlo, n, prefix, suffix = index.grow(*state, size == 3)
            order, first = _dealt(prefix, suffix, parts)
            places, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for part, k, blob in rows:
                if part is not None and part >= 0:
                    place, own = _unpacked(blob, 2, k)
                    places.append(order[first[part] + place])
                    ids.append(own)
            keep = np.concatenate(places)
            state = lo[keep], rlo[keep], n[keep], np.concatenate(ids)
            file = remote.NewFile(folder, ".state")
            file.write(_packed(*state))
            file.close()
            parted, counts, blobs = [-1 - shard % parts], [len(keep)], [file.name.encode()]
        _, _, n, prefix, suffix = index.grow(*state, size == 2)
        order, first = _dealt(prefix, suffix, parts)
        for p in np.flatnonzero(np.diff(first)).tolist():
            own = order[first[p]:first[p + 1]]
            parted.append(p)
            counts.append(len(own))
            blobs.append(_packed(np.diff(prefix[own], prepend=0), suffix[own], n[own]))
        return pa.table({"part": pa.array(parted, pa.int32()), "shard": pa.array([shard] * len(parted), pa.int64()),
                         "rows": pa.array(counts, pa.int32()), "blob": pa.array(blobs, pa.binary())})
    return run


def _settle(least: int):
    """Sum one part's phrases over the shards: a row for each that is frequent (shard null), and a packed row for
    each shard with the places and ids of its frequent ones.  Parts below 0 pass as they are."""
    def run(table: pa.Table) -> pa.Table:
        part, shards, rows = table["part"][0].as_py(), table["shard"].to_pylist(), table["rows"].to_pylist()
        if part < 0:
            none = pa.nulls(len(shards), pa.int64())
            return pa.table({"shard": table["shard"], "part": table["part"], "rows": table["rows"], "blob": table["blob"],
                             "id": none, "prefix": none, "suffix": none, "f": none})
        columns = [_unpacked(blob.as_py(), 3, k) for blob, k in zip(table["blob"], rows, strict=True)]
        prefix = np.concatenate([np.cumsum(c[0]) for c in columns])
        suffix, n = (np.concatenate([c[i] for c in columns]) for i in (1, 2))
        order = np.lexsort((suffix, prefix))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(prefix[order]) != 0) | (np.diff(suffix[order]) != 0)
        at = np.flatnonzero(new)
        f = np.add.reduceat(n[order], at)
        frequent = f >= least
        ids = np.where(frequent, part << 32 | np.cumsum(frequent) - 1, -1)
        own = np.empty(len(order), np.int64)
        own[order] = np.repeat(ids, np.diff(np.append(at, len(order))))
        back, bounds = [], np.concatenate([[0], np.cumsum(rows)])
        for i, shard in enumerate(shards):
            mine = own[bounds[i]:bounds[i + 1]]
            place = np.flatnonzero(mine >= 0)
            if len(place):
                back.append((shard, len(place), _packed(place, mine[place])))
        one, k = order[at[frequent]], int(frequent.sum())
        total = k + len(back)
        return pa.table({
            "shard": pa.array([None] * k + [x[0] for x in back], pa.int64()), "part": pa.array([part] * total, pa.int32()),
            "rows": pa.array([None] * k + [x[1] for x in back], pa.int32()),
            "blob": pa.array([None] * k + [x[2] for x in back], pa.binary()),
            **{c: pa.array([*x.tolist(), *[None] * len(back)], pa.int64()) for c, x in (
                ("id", ids[frequent]), ("prefix", prefix[one]), ("suffix", suffix[one]), ("f", f[frequent]))}})
    return run


# --------------------------------------------------------------------- queries
def _frequent_words(tokens: DataFrame, least: int) -> DataFrame:
    """The shards' words that occur ``least`` times over all shards, with their sum ``f`` and an ``id``, the least
    place of the word; a word has one row a shard, so its group is bounded by the number of shards."""
    every = Window.partitionBy("lang", "word")
    here = F.shiftleft("shard", PLACE_BITS).bitwiseOR(F.col("symbol").cast("long"))
    return (tokens.withColumn("_here", here).withColumn("f", F.sum("n").over(every)).where(F.col("f") >= least)
            .withColumn("id", F.min("_here").over(every)))


def phrase_counts(spark: SparkSession, docs: DataFrame, least: int = LEAST, shard_words: int = SHARD_WORDS,
                  text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, n) over all words, and every phrase of 1 to DEPTH words that occurs ``least`` times in its language.

    Phrases have ``id``, ``lang``, ``words``, ``phrase``, ``f``, ``heads`` and
    ``tails`` (f of the first, and of the last, 1 to all words) and ``longer``
    (the largest f among the frequent phrases one word longer on the left or
    right).  Texts are lower-cased (A-Z) and split into pieces and words as in
    KIND; phrases lie within a piece.  A null language is ``und``.

    Every scan task cuts its texts into shards; each shard gets an index of
    its frequent words.  Level by level the shards' phrases are extended by a
    word on both sides, their counts summed over the shards, and the places
    of the frequent ones go back to the shards.  What is shuffled are phrases
    whose parts are frequent, packed by shard and part.
    """
    ship_code(spark)
    scratch = Scratch(spark, "phrases")
    stored, indexes = scratch.folder("words"), scratch.folder("indexes")
    source = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    with batch_bytes(spark, BATCH_BYTES):
        tokens = scratch.stage(source.mapInArrow(
            _tokenise(stored, shard_words), "shard long, file string, symbol int, lang string, word string, n long"),
            "tokens")
    totals = scratch.stage(tokens.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    level = scratch.stage(_frequent_words(tokens, least)
                          .select("shard", "file", "symbol", "lang", "word", "f", "n", "id", "_here"), "level-1")
    scratch.drop("tokens")
    known = scratch.stage(level.where("_here = id").select(
        "id", "lang", F.lit(1).alias("words"), F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
        F.array("f").alias("heads"), F.array("f").alias("tails")), "known-1")
    size = level.agg(F.count_distinct("shard"), F.sum("n")).first()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tasks, parts = max(1, min(size[0], 4 * wide)), max(wide, -(-(size[1] or 0) // PART_ROWS))
    void = F.lit(None)
    built = (level.select("shard", void.cast("string").alias("file"), "symbol", "id")
             .union(level.groupBy("shard").agg(F.min("file")).select("*", void.cast("int"), void.cast("long"))))
    heads = scratch.stage(built.repartition(tasks, "shard").groupBy("shard").applyInArrow(
        _build(stored, indexes), "shard long, file string"), "shards")
    scratch.drop("words")
    back = "shard long, part int, rows int, blob binary"
    heads = heads.select("*", void.cast("int").alias("part"), void.cast("int").alias("rows"), void.cast("binary").alias("blob"))
    levels, state = [known], heads
    for words in range(2, DEPTH + 1):
        offers = state.repartition(tasks, "shard").groupBy("shard").applyInArrow(
            _offer(indexes, words, parts), "part int, shard long, rows int, blob binary")
        settled = scratch.stage(offers.groupBy("part").applyInArrow(
            _settle(least), f"{back}, id long, prefix long, suffix long, f long"), f"settled-{words}")
        before = levels[-1].select("id", "lang", "phrase", "last", "heads", "tails")
        first = before.select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("begin"), "heads")
        rest = before.select(F.col("id").alias("suffix"), "last", "tails")
        known = scratch.stage(
            settled.where("shard is null").select("id", "prefix", "suffix", "f").join(first, "prefix").join(rest, "suffix")
            .select("id", "lang", F.lit(words).alias("words"), F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f",
                    F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"),
                    "prefix", "suffix"), f"known-{words}")
        longer = (known.select(F.col("prefix").alias("id"), "f").union(known.select("suffix", "f"))
                  .groupBy("id").agg(F.max("f").alias("longer")))
        levels[-1] = levels[-1].join(longer, "id", "left")
        levels.append(known)
        state = heads.union(settled.where("shard is not null").select("shard", void.cast("string"), "part", "rows", "blob"))
    levels[-1] = levels[-1].withColumn("longer", F.lit(None).cast("long"))
    columns = ["id", "lang", "words", "phrase", "f", "heads", "tails", "longer"]
    out = levels[0].select(*columns)
    for x in levels[1:]:
        out = out.union(x.select(*columns))
    return totals, out


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, top: int = TOP,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each language's ``top`` phrases of 2 to DEPTH words by how much oftener they occur than their parts suggest.

    For a cut of a phrase into two, of f = a, l and r among n words, the score
    is floor(1000 a n / (l r)); the cut of the lowest score counts, the first
    of equal ones.  Phrases that lie in an equally frequent longer one are
    left out.  Products are decimals of 38 digits, exact up to 10^17 words.
    Ties go to the larger a, then to the lesser phrase.  Null and empty texts
    have no words; repeated rows count; an empty table gives an empty result.
    """
    totals, phrases = phrase_counts(spark, docs, least, shard_words)
    wide = "decimal(19,0)"
    found = phrases.where("words > 1 and (longer is null or longer < f)").join(totals, "lang")
    cuts = F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(
        k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", F.col("words") - k - 1).alias("r")))
    scored = F.transform(cuts, lambda c: F.struct(
        F.call_function("div", F.col("f").cast(wide) * F.col("n").cast(wide) * F.lit(1000).cast("decimal(4,0)"),
                        c["l"].cast(wide) * c["r"].cast(wide)).alias("score"), c["k"].alias("k"), c["l"].alias("l"),
        c["r"].alias("r")))
    rows = found.withColumn("cut", F.array_min(scored)).select(
        "lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "n", F.col("cut.score").cast("long").alias("score"))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return rows.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language of ``documents``."""
    return collocations(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))


PHRASE_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
f1 AS (SELECT lang, word, COUNT(*) AS f FROM (SELECT lang, unnest(w) AS word FROM p) GROUP BY ALL),
n AS (SELECT lang, SUM(f)::BIGINT AS n FROM f1 GROUP BY lang),
s AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 6) r(k) WHERE len(w) >= k),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, COUNT(*) AS f FROM s GROUP BY ALL HAVING COUNT(*) >= 100),
q AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM g),
inner_ones AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT lang, k, f, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS phrase FROM q WHERE k > 2) x
  JOIN (SELECT lang, phrase, f AS a FROM g) USING (lang, phrase) WHERE 100 * f >= 100 * a),
c AS (
  SELECT q.lang, q.phrase, q.f AS a, j.i::INT AS cut, x.f AS l, y.f AS r, n.n,
         ((1000::HUGEINT * q.f * n.n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM q JOIN n USING (lang) JOIN range(1, 5) j(i) ON j.i < q.k
  JOIN g x ON x.lang = q.lang AND x.phrase = array_to_string(q.w[1:j.i], ' ')
  JOIN g y ON y.lang = q.lang AND y.phrase = array_to_string(q.w[j.i + 1:], ' ')
  WHERE q.k > 1 AND NOT EXISTS (SELECT 1 FROM inner_ones o WHERE o.lang = q.lang AND o.phrase = q.phrase)),
b AS (SELECT * FROM c QUALIFY ROW_NUMBER() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000
"""

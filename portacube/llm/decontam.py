"""Benchmark passages in documents: q-gram lemma filtering and banded alignment."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from portacube.llm import remote
from portacube.llm.ranks import with_prefix
from portacube.llm.scratch import Scratch
from portacube.llm.textkit import scramble
from portacube.llm.workers import ship_code

Q = 8  # characters of a gram
EDIT_RATE = 0.1  # edits per character of a passage
MIN_CHARS = 24  # shorter passages, normalised, are searched word for word
DROP_CHARS = 12  # shorter passages, normalised, are reported, but do not drop a document
BLOCK_CHARS = 4_000_000  # characters of benchmark passages that are indexed at once
CHUNK = 1 << 20  # characters of documents searched together
GROUP_TEXTS = 10_000  # texts searched together
HELD = 64 << 20  # bytes of documents a task holds while it searches them for block after block
ALIGN = 128  # regions aligned together
_U = np.uint64
_NONE = np.uint32(0x110000)
_SPACE = np.uint32(32)
_tables: list[np.ndarray] = []


def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Lower case (one character for one) and letter-or-digit flag of every code point."""
    if not _tables:
        lower, word = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
        for i in range(0x110000):
            c = chr(i)
            if c.isalnum():
                word[i] = True
                small = c.lower()
                if len(small) == 1:
                    lower[i] = ord(small)
        _tables[:] = [lower, word]
    return _tables[0], _tables[1]


def normalise(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters and digits with one space for everything between; and each one's place in the text."""
    lower, word = _characters()
    code = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    solid = word[code]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    at = np.flatnonzero(keep)
    out = np.where(solid[at], lower[code[at]], np.uint32(32))
    if len(out) and out[-1] == 32:
        out, at = out[:-1], at[:-1]
    return out, at


def _gram_hashes(code: np.ndarray) -> np.ndarray:
    """Hashes of all Q-grams, built by doubling."""
    h, step, base = code.astype(np.uint64), 1, 0x9E3779B97F4A7C15
    while step < Q:
        h = h[:-step] * _U(base) + h[step:]
        base, step = base * base % (1 << 64), step * 2
    return scramble(h)


def _bordered(code: np.ndarray) -> np.ndarray:
    return np.concatenate([[_SPACE], code, [_SPACE]]).astype(np.uint32)


def _window_hashes(code: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all windows of ``n`` characters, character by character."""
    h = np.zeros(len(code) - n + 1, np.uint64)
    for i in range(n):
        h = h * _U(0x9E3779B97F4A7C15) + code[i:len(code) - n + 1 + i].astype(np.uint64)
    return scramble(h)


class Passages:
    """The gram index of one block of benchmark passages; short ones, searched word for word, stand apart."""

    def __init__(self, rows: list[tuple[int, str]], rate: float = EDIT_RATE):
        own = [(i, normalise(t)[0]) for i, t in rows]
        brief = sorted(((len(x), i is not None, i or 0, x) for i, x in own if 0 < len(x) < MIN_CHARS), key=lambda b: b[:3])
        own = [(i, x) for i, x in own if len(x) >= MIN_CHARS]
        self.first_brief = len(own)
        own += [(i if some else None, x) for _, some, i, x in brief]
        self.ids = [i for i, _ in own]
        every_size = np.array([len(x) for _, x in own], dtype=np.int64)
        # a short passage's text between the spaces or ends of text around it, by length
        self.brief = {}
        for n in np.unique(every_size[self.first_brief:]).tolist():
            number = self.first_brief + np.flatnonzero(every_size[self.first_brief:] == n)
            prints = np.array([_window_hashes(_bordered(own[i][1]), n + 2)[0] for i in number])
            order = np.argsort(prints, kind="stable")
            self.brief[n] = prints[order], number[order]
        self.codes = [x for _, x in own]
        self.all_sizes, self.sizes = every_size, every_size[:self.first_brief]
        # q-gram lemma: an occurrence with k edits keeps at least m - q + 1 - k * q grams; k such that some are left
        self.budget = np.minimum((self.sizes * rate).astype(np.int64), (self.sizes - Q) // Q)
        self.all_budget = np.concatenate([self.budget, np.zeros(len(own) - self.first_brief, np.int64)])
        self.least = self.sizes - Q + 1 - self.budget * Q
        self.width = self.budget + 1
        self.longest = int(self.sizes.max(initial=0))
        grams = [_gram_hashes(x) for x in self.codes[:self.first_brief]]
        every = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams]) if grams else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.grams, self.first, self.count = np.unique(every[order], return_index=True, return_counts=True)
        bits = max(16, min(24, int(len(self.grams) * 16).bit_length()))
        self.shift = _U(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[(self.grams >> self.shift).astype(np.int64)] = True

    def regions(self, code: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, passage, first text place) of the diagonal bands that share enough grams.

        Bands are one budget + 1 wide; two neighbours are counted together,
        so any occurrence lies in one such pair.
        """
        none = np.zeros(0, np.int64)
        if len(code) < Q or not len(self.grams):
            return none, none, none
        hashes = _gram_hashes(code)
        at = np.flatnonzero(self.seen[(hashes >> self.shift).astype(np.int64)])
        gram = np.minimum(np.searchsorted(self.grams, hashes[at]), len(self.grams) - 1)
        doc = np.searchsorted(bounds, at, side="right") - 1
        real = (self.grams[gram] == hashes[at]) & (at + Q <= bounds[doc + 1])
        at, gram, doc = at[real], gram[real], doc[real]
        n = self.count[gram]
        posting = np.repeat(self.first[gram] - np.cumsum(n) + n, n) + np.arange(n.sum())
        item = self.item[posting]
        diagonal = np.repeat(at - bounds[doc], n) - self.place[posting] + self.longest
        band = diagonal // self.width[item]
        stride = len(code) + self.longest + 2  # more than there are bands
        assert len(bounds) * len(self.ids) * stride < 1 << 63, "too many texts and passages at once"
        key = (np.repeat(doc, n) * len(self.ids) + item) * stride + band
        key, hits = np.unique(key, return_counts=True)
        both = hits.copy()
        near = np.flatnonzero(np.diff(key) == 1)
        both[near] += hits[near + 1]
        # the pair that begins in an empty band has the hits of this one alone, which the pair from here covers
        pair, band = key // stride, key % stride
        doc, item = pair // len(self.ids), pair % len(self.ids)
        keep = both >= self.least[item]
        doc, item, band = doc[keep], item[keep], band[keep]
        return doc, item, band * self.width[item] - self.longest - self.budget[item]

    def align(self, code, bounds, doc, item, start) -> tuple[np.ndarray, np.ndarray]:
        """Least edits of each whole passage against any stretch of its region, and where that stretch ends."""
        best, end = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64)
        order = np.argsort(self.sizes[item], kind="stable")
        for lo in range(0, len(order), ALIGN):
            rows = order[lo:lo + ALIGN]
            sizes, own = self.sizes[item[rows]], item[rows]
            wide, long = int((2 * self.width[own] + 2 * self.budget[own] + 1).max()), int(sizes.max())
            at = start[rows][:, None] + np.arange(long + wide)
            inside = (at >= 0) & (at < np.diff(bounds)[doc[rows]][:, None])
            text = np.where(inside, code[np.where(inside, at + bounds[doc[rows]][:, None], 0)], _NONE)
            passage = np.full((len(rows), long), _NONE + np.uint32(1))
            for r, i in enumerate(own):
                passage[r, :sizes[r]] = self.codes[i]
            slope = np.arange(wide, dtype=np.int32)
            cost = np.zeros((len(rows), wide), np.int32)
            for i in range(long):
                step = cost + (text[:, i:i + wide] != passage[:, i:i + 1])
                step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                cost = np.minimum.accumulate(step - slope, axis=1) + slope
                done = np.flatnonzero(sizes == i + 1)
                if len(done):
                    where = cost[done].argmin(axis=1)
                    best[rows[done]] = cost[done, where]
                    end[rows[done]] = start[rows[done]] + i + 1 + where
        return best, end

    def find(self, code: np.ndarray, bounds: np.ndarray, behind: np.ndarray,
             before: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(document, passage, edits, end place) of every passage within its budget, the best of each pair.

        ``behind`` and ``before`` tell the parts that have more of their text before, and behind, them.
        """
        found = {(d, i): (0, z) for d, i, z in self._verbatim(code, bounds, behind, before)}
        doc, item, start = self.regions(code, bounds)
        if not len(doc):
            return [(d, i, e, z) for (d, i), (e, z) in sorted(found.items())]
        edits, end = self.align(code, bounds, doc, item, start)
        good = np.flatnonzero(edits <= self.budget[item])
        for d, i, e, z in zip(doc[good], item[good], edits[good], end[good]):
            found[int(d), int(i)] = min(found.get((int(d), int(i)), (1 << 40, 0)), (int(e), int(z)))
        return [(d, i, e, z) for (d, i), (e, z) in sorted(found.items())]


    def _verbatim(self, code: np.ndarray, bounds: np.ndarray, behind: np.ndarray,
                  before: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(document, passage, end place) of short passages that stand in a text as whole words, the first of each pair."""
        if not self.brief:
            return
        texts = len(bounds) - 1
        # a space before and behind each text; where a text is cut no word ends
        ends = np.stack([np.where(behind, _NONE, _SPACE), np.where(before, _NONE, _SPACE)], axis=1)
        own = np.insert(code, np.stack([bounds[:-1], bounds[1:]], axis=1).ravel(), ends.ravel()).astype(np.uint32)
        heads = bounds[:-1] + 2 * np.arange(texts)  # of each text's leading space
        for n, (prints, number) in self.brief.items():
            if len(own) < n + 2:
                continue
            spaces = (own[:len(own) - n - 1] == _SPACE) & (own[n + 1:] == _SPACE)
            at = np.flatnonzero(spaces)
            at = at[np.isin(hashes := _window_hashes(own, n + 2)[at], prints)]
            last = {}
            for k, h in zip(at.tolist(), hashes[np.isin(hashes, prints)], strict=True):
                text = own[k + 1:k + 1 + n]
                for j in range(*(int(np.searchsorted(prints, h, side=x)) for x in ("left", "right"))):
                    d = int(np.searchsorted(heads, k, side="right")) - 1
                    if (d, int(number[j])) not in last and np.array_equal(text, self.codes[number[j]]):
                        last[d, int(number[j])] = k - int(heads[d]) + n
            for (d, i), z in last.items():
                yield d, i, z


def _search(passages: Passages, texts) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, passage, edits, start, end) for the texts of a batch, several short texts or one part at a time.

    A long text is cut into overlapping parts; the overlap holds any region,
    so an occurrence lies whole in one of them.
    """
    overlap = 2 * max(passages.longest, MIN_CHARS) + 8 * Q

    def flush(group):
        code = np.concatenate([x[1] for x in group])
        bounds = np.concatenate([[0], np.cumsum([len(x[1]) for x in group])])
        for d, i, edits, end in passages.find(code, bounds, *(np.array([x[k] for x in group]) for k in (3, 4))):
            row, _, at, _, _ = group[d]
            last = int(at[min(end, len(at)) - 1]) + 1
            first = int(at[max(0, end - int(passages.all_sizes[i]))])
            yield row, i, edits, first, last
    group, held = [], 0
    for row, text in enumerate(texts):
        code, at = normalise(text.as_py())
        for lo in range(0, max(1, len(code) - overlap), CHUNK):
            part = slice(lo, lo + CHUNK + overlap)
            group.append((row, code[part], at[part], lo > 0, part.stop < len(code)))
            held += len(group[-1][1])
            if held >= CHUNK or len(group) >= GROUP_TEXTS:
                yield from flush(group)
                group, held = [], 0
    if group:
        yield from flush(group)


def _held(batches) -> Iterator[pa.Table]:
    """Batches put together to HELD bytes, so that each index is built once for many of them."""
    group, size = [], 0
    for batch in batches:
        group.append(batch)
        size += batch.nbytes
        if size >= HELD:
            yield pa.Table.from_batches(group)
            group, size = [], 0
    if group:
        yield pa.Table.from_batches(group)


@functools.lru_cache(maxsize=1)
def _index(folder: str, block: int) -> Passages:
    """The index of a stored block; a task holds one at a time."""
    system, path = remote.locate(f"{folder}/block={block}")
    rows = pq.read_table(path, columns=["item_id", "text"], filesystem=system, partitioning=None)
    return Passages(list(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True)))


def _matches(folder: str, blocks: int):
    def run(batches):
        for table in _held(batches) if blocks > 1 else (pa.Table.from_batches([b]) for b in batches):
            ids, texts = table.column(0).combine_chunks(), table.column(1)
            for block in range(blocks):
                passages = _index(folder, block)
                rows = list(_search(passages, texts))
                row, item, edits, start, end = zip(*rows) if rows else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row, pa.int64())), pa.array([passages.ids[i] for i in item], pa.int64()),
                     pa.array(edits, pa.int64()), pa.array([int(passages.all_budget[i]) for i in item], pa.int64()),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["id", "item_id", "edits", "budget", "start", "end"])
    return run


def _without(folder: str, blocks: int, text_at: int, least: int):
    def run(batches):
        for table in _held(batches) if blocks > 1 else (pa.Table.from_batches([b]) for b in batches):
            hit = np.zeros(table.num_rows, bool)
            for block in range(blocks):
                passages = _index(folder, block)
                hit[[r[0] for r in _search(passages, table.column(text_at)) if passages.all_sizes[r[1]] >= least]] = True
            yield from table.filter(pa.array(~hit)).to_batches()
    return run


def passage_blocks(benchmark: DataFrame, scratch: Scratch, item: str = "item_id", text: str = "text") -> tuple[str, int]:
    """The benchmark's passages, stored in blocks of about BLOCK_CHARS characters (or one passage): folder and number.

    Blocks are numbered and written by Spark; only their number comes to the driver.
    """
    rows = benchmark.where(F.col(text).isNotNull()).select(
        F.col(item).cast("long").alias("item_id"), F.col(text).cast("string").alias("text"),
        F.length(text).cast("long").alias("n"))
    placed = with_prefix(rows, ["item_id", "text"], {"before": "n"}, scratch, "passages")
    blocks = placed.select("item_id", "text", F.floor(F.col("before") / BLOCK_CHARS).alias("at"))
    # numbers without gaps, also behind a passage longer than a block
    numbers = blocks.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    numbers = scratch.stage(with_prefix(numbers, ["at"], {}, scratch, "numbers", "block").select("at", "block"), "blocks")
    folder = scratch.path("by-block")
    blocks.join(numbers, "at").select("block", "item_id", "text").repartition("block").write.partitionBy("block").parquet(
        folder)
    return folder, numbers.count()


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """Benchmark passages that occur in whole texts within EDIT_RATE edits per character.

    Both sides are compared lower-cased, with one space for every run of
    characters that are neither letters nor digits.  Shared Q-grams are
    counted in overlapping diagonal bands; regions that meet the q-gram lemma
    for the passage's edit budget are aligned in a band around them.
    Passages below MIN_CHARS characters have no budget: they are found where
    they stand word for word, between spaces or ends of the text.  The
    documents are read once and not shuffled: passages are stored in blocks,
    and a task indexes one block at a time.

    Returns (id, item_id, edits, budget, start, end), the best occurrence per
    row and passage; ``end`` is exact, ``start`` is ``end`` less the passage's
    length.  Defined cases: null and empty texts match nothing, nor do
    passages without letters and digits; a null id and a null item id are
    reported as null; repeated rows are reported once each; no documents or
    no passages give an empty result.
    """
    ship_code(spark)
    folder, blocks = passage_blocks(benchmark, Scratch(spark, "leaks"))
    out = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _matches(folder, blocks), "id long, item_id long, edits long, budget long, start long, end long")
    # parts of one long text may report an occurrence twice
    return out.distinct().withColumnRenamed("id", key)


def decontaminate(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  least: int = DROP_CHARS) -> DataFrame:
    """The rows of ``docs`` in which no passage occurs, with all their columns (see ``leaks``).

    Passages below ``least`` characters, such as a single word, are common
    speech and drop nothing.
    """
    ship_code(spark)
    folder, blocks = passage_blocks(benchmark, Scratch(spark, "leaks"))
    return docs.mapInArrow(_without(folder, blocks, docs.columns.index(text), least), docs.schema)


def op6_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of ``benchmark`` in every one of ``documents``."""
    return leaks(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"),
                 spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

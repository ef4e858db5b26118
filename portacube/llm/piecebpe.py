"""Encoding and decoding with the pieces of a SentencePiece BPE model, by a table of last tokens.

A text's encoding ends, at every prefix, in one token that the prefix alone
decides.  An automaton over the pieces gives the tokens that may end a prefix;
that one is right which fits behind the last token of the prefix before it,
i.e. the two stay apart when their joint text is merged.  From the table of
last tokens ids are recovered backwards.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from portacube.llm import textkit
from portacube.llm.workers import ship_code

SEGMENT = 1 << 21  # bytes of text worked on at once
STEP_TOGETHER = 24  # units that are worth a step side by side; fewer are followed one by one
PAIRS_HELD = 1 << 20  # slots of tested token pairs
SPACE, MARK = 0x20, "▁"
UNKNOWN = -2  # in place of a token: a byte of a character that is no piece
NEVER = np.iinfo(np.int64).max
_U = np.uint64


class Pieces:
    """Tables of one model: merges, pair tests and the automaton over the pieces' bytes.

    The mark that stands for a space is kept as the byte of a space.  Only
    models that split nothing, normalise nothing but spaces and fall back to
    bytes are supported; others raise ValueError.
    """

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        lib, n = self.library, self.library.get_piece_size()
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) for i in range(n)]
        texts = [lib.id_to_piece(i) for i in range(n)]
        self.text = {i: texts[i] for i in range(n) if not special[i]}
        self.score = {t: lib.get_score(i) for i, t in self.text.items()}
        self.number = {t: i for i, t in self.text.items()}
        self.byte_ids = np.array([lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        order = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        # when a piece is made: single characters from the start, others in the order of their scores
        self.made = np.full(n + 1, -1, np.int64)
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        self.reached = np.zeros(n + 1, bool)
        early: set[int] = set()  # pieces made no later than one of their parts
        for i, t in self.text.items():
            parts, last = self._merge([*t])
            self.reached[i] = len(parts) == 1
            if len(t) > 1:
                self.made[i] = order[self.score[t]]
                if last:
                    self.left[i], self.right[i] = (self.number.get(p, -1) for p in last)
        for i, t in self.text.items():
            if len(t) > 1 and self.reached[i] and max(self.made[self.left[i]], self.made[self.right[i]]) >= self.made[i]:
                early.add(i)
        self.odd = np.zeros(n + 1, bool)
        for i in sorted(self.text, key=lambda i: len(self.text[i])):
            self.odd[i] = i in early or (self.left[i] >= 0 and (self.odd[self.left[i]] or self.odd[self.right[i]]))
        self.odd_inside = {p for i in early for p in zip(self.text[i], self.text[i][1:], strict=False)}
        # every pair of pieces that makes a piece
        joins = sorted(((self.number[t[:k]] << 32 | self.number[t[k:]], order[self.score[t]])
                        for t in self.score for k in range(1, len(t)) if t[:k] in self.number and t[k:] in self.number))
        self.join_keys, self.join_made = (np.array(x, np.int64) for x in (zip(*joins, strict=True) if joins else ([], [])))
        self._automaton()
        self.held = np.full(PAIRS_HELD, -1, np.int64)
        self.fits_held = np.zeros(PAIRS_HELD, bool)
        self._check()

    def _merge(self, parts: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """The merged parts, by score and then from the left, and the last pair merged."""
        last = None
        while True:
            best = None
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best[0]):
                    best = score, i
            if best is None:
                return parts, last
            i = best[1]
            last = parts[i], parts[i + 1]
            parts[i:i + 2] = ["".join(last)]

    def _automaton(self) -> None:
        """Dense transitions, the longest token that ends in each state, and each token's next shorter one."""
        spelled = {i: t.replace(MARK, " ").encode() for i, t in self.text.items()}
        self.size = np.zeros(len(self.made), np.int64)
        self.inside = np.zeros((256, 256), bool)  # bytes that stand side by side in a piece
        for i, b in spelled.items():
            self.size[i] = len(b)
            x = np.frombuffer(b, np.uint8)
            self.inside[x[:-1], x[1:]] = True
        used = sorted({b for x in spelled.values() for b in x})
        self.kind = np.zeros(256, np.int64)  # 0: a byte of no piece
        self.kind[used] = np.arange(1, len(used) + 1)
        width = len(used) + 1
        nodes: list[dict[int, int]] = [{}]
        depth, parent, ends = [0], [(0, 0)], {}
        for i, b in spelled.items():
            at = 0
            for byte in b:
                nxt = nodes[at].get(byte)
                if nxt is None:
                    nxt = nodes[at][byte] = len(nodes)
                    nodes.append({})
                    depth.append(depth[at] + 1)
                    parent.append((at, byte))
                at = nxt
            if self.reached[i]:
                ends[at] = i
        n = len(nodes)
        self.go = np.zeros((n, width), np.int32)
        self.out = np.full(n, -1, np.int32)
        self.shorter = np.full(len(self.made), -1, np.int32)
        fail = np.zeros(n, np.int64)
        depth, above = np.array(depth), np.array([p for p, _ in parent])
        by = self.kind[[b for _, b in parent]]
        token = np.full(n, -1, np.int32)
        token[list(ends)] = list(ends.values())
        for d in range(1, depth.max() + 1):
            here = np.flatnonzero(depth == d)
            fail[here] = self.go[fail[above[here]], by[here]] if d > 1 else 0
            # a state's row is its failure's row, with its own children put over it one level later
            self.go[above[here], by[here]] = here
            self.go[here] = self.go[fail[here]]
            found = token[here] >= 0
            self.out[here] = np.where(found, token[here], self.out[fail[here]])
            self.shorter[token[here[found]]] = self.out[fail[here[found]]]

    def _check(self) -> None:
        for text in ("", " ", "a", "  a  b ", "Ab, cd.\n\tx  ", "é à ﬁ ½ Å", "1234 ▁x", "<s></s>", "​　 x"):
            if list(recovered(self, text.encode())) != self.library.encode(text):
                raise ValueError("the model normalises, splits or lacks what this encoder does not know")

    # ------------------------------------------------------------- pairs
    def _walk(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens ``a`` and ``b`` stay apart side by side.

        Their merges are undone from the last one back; wherever the parts at
        the border would have joined before either was used up, the tokens do
        not stand.  Of equal merges the left one comes first.
        """
        fits = np.ones(len(a), bool)
        at, a, b = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        used_a, used_b = np.full(len(a), NEVER), np.full(len(a), NEVER)
        while len(at):
            key = a << 32 | b
            place = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
            joined = np.where(self.join_keys[place] == key, self.join_made[place], NEVER)
            bad = (joined < used_a) & (joined <= used_b)
            fits[at[bad]] = False
            made_a, made_b = self.made[a], self.made[b]
            on = ~bad & ((made_a >= 0) | (made_b >= 0))
            at, a, b, used_a, used_b = at[on], a[on], b[on], used_a[on], used_b[on]
            made_a, made_b = made_a[on], made_b[on]
            undo = made_a > made_b
            used_a, used_b = np.where(undo, made_a, used_a), np.where(undo, used_b, made_b)
            a, b = np.where(undo, self.right[a], a), np.where(undo, b, self.left[b])
        return fits

    def _apart(self, a: int, b: int) -> bool:
        """The same for one pair, by merging."""
        parts, _ = self._merge([*self.text[a], *self.text[b]])
        return parts == [self.text[a], self.text[b]]

    @functools.cached_property
    def _borders(self) -> tuple[np.ndarray, np.ndarray]:
        """Whether a token's last, and first, character may stand at such a place inside a piece made early."""
        ends, starts = np.zeros(len(self.made), bool), np.zeros(len(self.made), bool)
        lasts, firsts = {a for a, _ in self.odd_inside}, {b for _, b in self.odd_inside}
        for i, t in self.text.items():
            ends[i], starts[i] = t[-1] in lasts, t[0] in firsts
        return ends, starts

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pair tests, remembered by slot."""
        key = a.astype(np.int64) << 32 | b
        slot = (textkit.scramble(key.astype(_U)) & _U(PAIRS_HELD - 1)).astype(np.int64)
        known = self.held[slot] == key
        out = self.fits_held[slot]
        if not known.all():
            new, back = np.unique(key[~known], return_inverse=True)
            x, y = new >> 32, new & 0xFFFFFFFF
            found = self._walk(x, y)
            ends, starts = self._borders
            # pieces made early do not follow the order of scores: few pairs, merged outright
            for i in np.flatnonzero(self.odd[x] | self.odd[y] | (ends[x] & starts[y])):
                found[i] = self._apart(int(x[i]), int(y[i]))
            place = (textkit.scramble(new.astype(_U)) & _U(PAIRS_HELD - 1)).astype(np.int64)
            self.held[place], self.fits_held[place] = new, found
            out[~known] = found[back]
        return out


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """The tables of a model, built once per worker."""
    return Pieces(path)


# --------------------------------------------------------------- last tokens
def _together(p: Pieces, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> None:
    """Fill ``last`` (per byte the token that ends the unit's prefix there) for units in order of falling size."""
    kinds, state = p.kind[data], np.zeros(len(starts), np.int64)
    begins = data & 0xC0 != 0x80
    active = len(starts)
    for at in range(int(sizes[0]) if len(sizes) else 0):
        active = int(np.searchsorted(-sizes[:active], -at, side="left"))  # units longer than ``at``
        if active < STEP_TOGETHER:
            for u in range(active):
                _follow(p, data, int(starts[u]), at, int(sizes[u]), int(state[u]), last)
            return
        here = starts[:active] + at
        state[:active] = p.go[state[:active], kinds[here]]
        token = p.out[state[:active]]
        wait = np.flatnonzero(token >= 0)
        token = token[wait]
        while len(wait):
            end = here[wait]
            before = end - p.size[token]
            first = before < starts[wait]
            previous = last[before]  # of the unit's first byte this is another unit's, and not used
            good = first | (previous == UNKNOWN)
            ask = np.flatnonzero(~good & (previous >= 0))
            if len(ask):
                good[ask] = p.fits(previous[ask], token[ask])
            last[end[good]] = token[good]
            token = p.shorter[token[~good]]
            wait = wait[~good]
            on = token >= 0
            token, wait = token[on], wait[on]
        ends = sizes[:active] == at + 1
        ends[~ends] = begins[here[~ends] + 1]
        for k in here[ends & (last[here] == -1)]:  # a character that is no piece
            _unknown(begins, last, int(k))


def _unknown(begins: np.ndarray, last: np.ndarray, k: int) -> None:
    """Mark the character that ends at byte ``k``, back to its first byte."""
    while True:
        last[k] = UNKNOWN
        if begins[k] or k == 0 or last[k - 1] != -1:
            return
        k -= 1


def _follow(p: Pieces, data: np.ndarray, start: int, at: int, size: int, state: int, last: np.ndarray) -> None:
    """The same for one long unit, from its byte ``at``."""
    go, kind, out, shorter, sizes = p.go, p.kind.tolist(), p.out, p.shorter, p.size
    begins = data & 0xC0 != 0x80
    known: dict[tuple[int, int], bool] = {}
    for k in range(start + at, start + size):
        state = int(go[state, kind[data[k]]])
        token = int(out[state])
        while token >= 0:
            before = k - int(sizes[token])
            previous = int(last[before]) if before >= start else UNKNOWN
            if previous >= 0:
                pair = previous, token
                if pair not in known:
                    known[pair] = bool(p.fits(np.array([previous]), np.array([token]))[0])
                fits = known[pair]
            else:
                fits = previous == UNKNOWN
            if fits:
                last[k] = token
                break
            token = int(shorter[token])
        if last[k] == -1 and (k + 1 == start + size or begins[k + 1]):
            _unknown(begins, last, k)


def _backwards(p: Pieces, starts: np.ndarray, sizes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Mark the bytes that end a token of the units' encodings, going back from the units' ends."""
    chosen = np.zeros(len(last), bool)
    at, floor = starts + sizes - 1, starts
    while len(at) >= STEP_TOGETHER:
        chosen[at] = True
        at = at - np.where(last[at] == UNKNOWN, 1, p.size[last[at]])
        on = at >= floor
        at, floor = at[on], floor[on]
    for k, low in zip(at.tolist(), floor.tolist(), strict=True):
        while k >= low:
            chosen[k] = True
            token = last[k]
            k -= 1 if token == UNKNOWN else int(p.size[token])
    return chosen


def _units(p: Pieces, data: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Starts of the units: no piece reaches over two bytes that stand side by side in none."""
    cut = np.ones(len(data), bool)
    cut[1:] = ~p.inside[data[:-1], data[1:]]
    cut[heads] = True
    return np.flatnonzero(cut)


def _distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that stand for all equal ones, and each unit's place among them."""
    power, inverse = textkit._power(max(len(data), 1))
    running = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * power[:len(data)], out=running[1:])
    prints = textkit.scramble((running[starts + sizes] - running[starts]) * inverse[starts] + sizes.astype(_U))
    _, first, place = np.unique(prints, return_index=True, return_inverse=True)
    # equal hashes are only trusted where the bytes are equal
    shift = starts[first][place] - starts
    other = np.arange(len(data)) + np.repeat(shift, sizes)
    differ = np.flatnonzero(data != data[np.minimum(other, len(data) - 1)])
    wrong = (sizes != sizes[first][place])
    if len(differ):
        wrong[np.searchsorted(starts, differ, side="right") - 1] = True
    lone = np.flatnonzero(wrong)
    place[lone] = len(first) + np.arange(len(lone))
    return np.concatenate([first, lone]), place


def _ids(p: Pieces, data: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts that lie side by side in ``data`` (marks as spaces), and ids per text, which start at ``heads``."""
    starts = _units(p, data, heads)
    sizes = np.diff(np.append(starts, len(data)))
    chosen, place = _distinct(data, starts, sizes)
    order = np.argsort(-sizes[chosen], kind="stable")
    own, long = starts[chosen][order], sizes[chosen][order]
    last = np.full(len(data), -1, np.int32)
    _together(p, data, own, long, last)
    ends = np.flatnonzero(_backwards(p, own, long, last))
    token = last[ends]
    token = np.where(token == UNKNOWN, p.byte_ids[data[ends]], token)
    low, high = np.searchsorted(ends, own), np.searchsorted(ends, own + long)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    low, n = low[rank][place], (high - low)[rank][place]
    before = np.cumsum(n) - n
    ids = token[np.repeat(low - before, n) + np.arange(int(n.sum()))]
    return ids, np.add.reduceat(n, np.searchsorted(starts, heads)) if len(heads) else np.zeros(0, np.int64)


def _parts(p: Pieces, data: np.ndarray):
    """A long text in parts of about SEGMENT bytes, cut where no piece reaches over."""
    at = 0
    while at < len(data):
        to = min(at + SEGMENT, len(data))
        while to < len(data):
            look = data[to - 1:to + SEGMENT]
            free = np.flatnonzero(~p.inside[look[:-1], look[1:]])
            if len(free):
                to += int(free[0])
                break
            to = min(to + SEGMENT, len(data))
        yield data[at:to]
        at = to


def recovered(p: Pieces, text: bytes) -> np.ndarray:
    """Ids of one text, without begin and end."""
    if not text:
        return np.zeros(0, np.int32)
    data = np.frombuffer(b" " + text.replace(MARK.encode(), b" "), np.uint8)
    return np.concatenate([_ids(p, part, np.zeros(1, np.int64))[0] for part in _parts(p, data)])


def _texts(p: Pieces, column):
    """(first row, ids, ids per text) for the texts of an Arrow column, some at a time."""
    offsets, data = textkit.strings(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + SEGMENT, side="right")) - 1)
        raw = data[offsets[row]:offsets[to]]
        if to == row + 1:
            ids = recovered(p, raw.tobytes())
            yield row, ids, np.array([len(ids)])
        elif MARK.encode() in raw.tobytes():
            each = [recovered(p, data[offsets[i]:offsets[i + 1]].tobytes()) for i in range(row, to)]
            yield row, np.concatenate(each), np.array([len(x) for x in each])
        else:
            bounds = offsets[row:to + 1] - offsets[row]
            sizes = np.diff(bounds)
            full = np.flatnonzero(sizes > 0)
            heads = bounds[:-1][full] + np.arange(len(full))  # a mark before every text that is not empty
            own = np.insert(raw, bounds[:-1][full], SPACE)
            n = np.zeros(to - row, np.int64)
            ids = np.zeros(0, np.int32)
            if len(own):
                ids, n[full] = _ids(p, own, heads)
            yield row, ids, n
        row = to


# ------------------------------------------------------------- Arrow batches
def _list(flat: np.ndarray, n: np.ndarray) -> pa.Array:
    bounds = np.zeros(len(n) + 1, np.int32)
    np.cumsum(n, out=bounds[1:])
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, pa.int32()))


def encoder(path: str, text_at: int, begin: bool, end: bool):
    """Batches with the ids of the column ``text_at`` in its place, in parts of about SEGMENT bytes of text."""
    def run(batches):
        p = pieces(path)
        ends = np.array([*[p.library.bos_id()] * begin, *[p.library.eos_id()] * end], np.int32)
        for batch in batches:
            for row, ids, n in _texts(p, batch.column(text_at)):
                after = np.cumsum(n)
                places = np.stack([*[after - n] * begin, *[after] * end], axis=1) if len(ends) else np.zeros(0, int)
                ids = np.insert(ids, places.ravel(), np.tile(ends, len(n)))
                n = n + len(ends)
                part = batch.slice(row, len(n))
                columns = [_list(ids, n) if i == text_at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays(columns, [str(i) for i in range(len(columns))])
    return run


def decoder(path: str, ids_at: int):
    """Batches with the text of the ids in column ``ids_at`` as another column; null ids give null."""
    def run(batches):
        library = pieces(path).library
        for batch in batches:
            texts = [None if x is None else library.decode(x) for x in batch.column(ids_at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             [str(i) for i in range(batch.num_columns + 1)])
    return run


def digester(ids_at: int, text_at: int):
    """The number and SHA-256 of ids and the SHA-256 of the text in place of both."""
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(ids_at), batch.column(text_at)
            bounds = ids.offsets.to_numpy()
            flat = np.ascontiguousarray(ids.values.to_numpy(), "<u4")
            prints = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            rest = [c for i, c in enumerate(batch.columns) if i not in (ids_at, text_at)]
            out = [*rest, pa.array(np.diff(bounds).astype(np.int64)), pa.array(prints, pa.string()),
                   pa.array([hashlib.sha256(x.as_py().encode()).hexdigest() for x in texts], pa.string())]
            yield pa.RecordBatch.from_arrays(out, [str(i) for i in range(len(out))])
    return run


def _chain(*steps):
    def run(batches):
        for step in steps:
            batches = step(batches)
        yield from batches
    return run


def _place(df: DataFrame, column: str) -> tuple[list[str], int]:
    columns = [c for c in df.columns if c != column]
    return [*columns, column], len(columns)


def encode(spark: SparkSession, df: DataFrame, text: str = "text", model: str | None = None, ids: str = "ids",
           begin: bool = True, end: bool = True) -> DataFrame:
    """``df`` with the ids of its whole texts (array of int) in place of the text, as the library encodes them
    without sampling.

    ``model`` is the path of a SentencePiece BPE model on every worker.  A
    null text is empty and has the begin and end ids alone.  Texts are worked
    on in parts cut where no piece reaches over; equal units of a part are
    encoded once.  Memory grows with the longest run of characters that has
    no such place (8 bytes a byte of it).  An empty table stays empty;
    repeated rows are encoded like others; a column of the name ``ids`` is
    replaced.
    """
    ship_code(spark)
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    if ids != text:
        df = df.drop(ids)
    names, at = _place(df, text)
    kept = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(names[:-1])]
    schema = T.StructType([*kept, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    out = df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(encoder(model, at, begin, end), schema)
    return out.toDF(*names[:-1], ids)


def decode(spark: SparkSession, df: DataFrame, ids: str = "ids", model: str | None = None,
           text: str = "text") -> DataFrame:
    """``df`` with the text of its ids; null ids give a null text, no ids an empty one.  A column of the name
    ``text`` is replaced."""
    ship_code(spark)
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    names, at = _place(df.drop(text) if text != ids else df, ids)
    fields = [T.StructField(f"c{i}", df.schema[c].dataType) for i, c in enumerate(names)]
    schema = T.StructType([*fields, T.StructField("text", T.StringType())])
    return df.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(decoder(model, at), schema).toDF(*names, text)


def op12_piece_ids(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Number and digest of every document's ids, and the digest of the text decoded from them.

    Encoding, decoding and digests run one behind the other in one pass over
    the texts, so neither ids nor decoded texts leave the worker.
    """
    ship_code(spark)
    model = model or public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(_chain(encoder(model, 1, True, True), decoder(model, 1), digester(1, 2)),
                           "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

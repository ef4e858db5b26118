"""op12 against the sentencepiece library, text by text."""

import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from conftest import write_tables
from hypothesis import given, settings
from hypothesis import strategies as st

from portacube.llm import piecebpe

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=MODEL)
SHARP = st.text(alphabet="abtheinrsou AZ.,\n\t\r\x00▁1230éüßñ執漢字ゼ🙂​ﬁ½\xa0-'\"<>/", max_size=60)


def rows(texts):
    out = []
    for i, t in texts:
        ids = LIBRARY.encode(t or "", add_bos=True, add_eos=True)
        out.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                    hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()))
    return sorted(out, key=str)


@settings(max_examples=400, deadline=None)
@given(st.one_of(SHARP, st.text(max_size=40)))
def test_one_text(text):
    assert piecebpe.recovered(piecebpe.pieces(MODEL), text.encode()).tolist() == LIBRARY.encode(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), SHARP), max_size=12))
def test_texts_side_by_side(texts):
    got = []
    for _, ids, n in piecebpe._texts(piecebpe.pieces(MODEL), pa.array(texts, pa.string())):
        got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
    assert got == [LIBRARY.encode(t or "") for t in texts]


@pytest.mark.parametrize("text", ["a" * 20_000, " " * 5_000, "the" * 9_000 + " end", "▁" * 100 + "x", "é" * 3_000, "🙂" * 2_000,
                                  "<0x0A><s></s>", "\n\n \n", "Über " * 300])
def test_long_runs_without_a_cut(text):
    assert piecebpe.recovered(piecebpe.pieces(MODEL), text.encode()).tolist() == LIBRARY.encode(text)


def test_every_piece_and_pair_test():
    """A piece is its own encoding; the walk over undone merges agrees with merging the joint text."""
    p = piecebpe.pieces(MODEL)
    assert p.reached[list(p.text)].all()
    draw = np.random.default_rng(3)
    plain = np.array([i for i in p.text if not p.odd[i]])
    a, b = draw.choice(plain, 4000), draw.choice(plain, 4000)
    both = np.array([i for i in p.text if len(p.text[i]) > 3])[:1500]
    split = [(p.number.get(t[:k]), p.number.get(t[k:])) for t in (p.text[i] for i in both) for k in range(1, len(t))]
    x, y = (np.array(z) for z in zip(*[s for s in split if None not in s], strict=True))
    for u, v in ((a, b), (x, y)):
        assert p.fits(u, v).tolist() == [p._apart(int(i), int(j)) for i, j in zip(u, v, strict=True)]
        assert p.fits(u, v).tolist() == [p._apart(int(i), int(j)) for i, j in zip(u, v, strict=True)]  # from memory


def test_parts_of_a_long_text(monkeypatch):
    monkeypatch.setattr(piecebpe, "SEGMENT", 50)
    text = "Many words stand here, one behind the other. " * 40 + "x" * 300 + " and more 12345"
    assert piecebpe.recovered(piecebpe.pieces(MODEL), text.encode()).tolist() == LIBRARY.encode(text)


def test_test_table(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in piecebpe.op12_piece_ids(spark, sf).collect()]
    assert sorted(got, key=str) == rows(docs)


def test_defined_cases(spark, tmp_path):
    docs = [(1, None), (2, ""), (2, ""), (None, "null id"), (4, " "), (5, "x" * 400_000), (6, "word " * 90_000), (6, "a")]
    folder = write_tables(spark, str(tmp_path), documents=(docs, "doc_id long, text string"))
    assert sorted((tuple(r) for r in piecebpe.op12_piece_ids(spark, folder).collect()), key=str) == rows(docs)


def test_empty_table(spark, tmp_path):
    folder = write_tables(spark, str(tmp_path), documents=([], "doc_id long, text string"))
    assert piecebpe.op12_piece_ids(spark, folder).collect() == []


def test_encode_and_decode_tables(spark):
    df = spark.createDataFrame([(1, "Two words", "old", 7), (2, None, "b", 8)], "k int, text string, ids string, decoded int")
    coded = piecebpe.encode(spark, df)
    assert {r["k"]: r["ids"] for r in coded.collect()} == {1: [1, *LIBRARY.encode("Two words"), 2], 2: [1, 2]}
    bare = piecebpe.encode(spark, df, begin=False, end=False)
    assert {r["k"]: r["ids"] for r in bare.collect()} == {1: LIBRARY.encode("Two words"), 2: []}
    back = piecebpe.decode(spark, coded, text="decoded")
    assert {r["k"]: r["decoded"] for r in back.collect()} == {1: "Two words", 2: ""}
    none = spark.createDataFrame([(1, None)], "k int, ids array<int>")
    assert piecebpe.decode(spark, none).first()["text"] is None

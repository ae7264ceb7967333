import random
import tracemalloc

import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as schema

from estrato.llm import pieces, queries

MODEL = queries.PIECE_MODEL
LETTERS = "abcdefghinorstuABC  \n\t.,!?éßñ▁漢字🙂\x00 01"


@pytest.fixture(scope="module")
def model():
    with open(MODEL, "rb") as f:
        return f.read()


def texts():
    rng = random.Random(3)
    yield from ("".join(rng.choices(LETTERS, k=rng.randint(0, 40))) for _ in range(4000))
    yield from (" " * k + "x" + " " * j for k in range(40) for j in range(0, 40, 3))
    yield from ("a" * 500, "", " ", "▁", "hello world  and more")


def test_merges_equal_the_library(model):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    given = list(texts())
    for text, (ids, _) in zip(given, pieces.encoder(own)(given)):
        assert ids.tolist() == library.encode(text), text
        assert own.decode(ids.tolist()) == library.decode(ids.tolist()) == text.replace("▁", " "), text


def test_best_sums_equal_the_library(model):
    proto = schema.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = pieces.UNIGRAM
    rng = random.Random(8)
    for p in proto.pieces:
        if p.type == pieces.NORMAL:  # multiples of 1/64: sums are exact in either precision
            p.score = -(len(p.piece) * 2 + rng.randrange(64 * 8) / 64)
    data = proto.SerializeToString()
    library, own = sentencepiece.SentencePieceProcessor(model_proto=data), pieces.Pieces(data)
    given = list(texts())

    def worth(ids):  # of equal sums either segmentation is right
        return sum(own.score[i] for i in ids)

    for text, (ids, _) in zip(given, pieces.encoder(own)(given)):
        want = library.encode(text)
        assert ids.tolist() == want or worth(ids.tolist()) == worth(want), text
        assert own.decode(ids.tolist()) == text.replace("▁", " ")


def test_kept_words_change_nothing(model, monkeypatch):
    given = list(texts())[:500]
    plain = [i.tolist() for i, _ in pieces.encoder(pieces.Pieces(model))(given)]
    monkeypatch.setattr(pieces, "KEPT_WORDS", 50)
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 30)
    encode = pieces.encoder(pieces.Pieces(model))
    assert [i.tolist() for k in range(0, 500, 20) for i, _ in encode(given[k : k + 20])] == plain


@pytest.mark.parametrize("letters", [4_000, 100_000])
@pytest.mark.parametrize("kind", ["漢字是一個很長的段落", "ABCDEFGHabcdefgh0123456789+/", "🙂𝛼𝛽ঌ"])
def test_long_texts_without_spaces(model, letters, kind):
    library, own = sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Pieces(model)
    text = "".join(random.Random(5).choices(kind, k=letters))
    tracemalloc.start()
    try:
        encode = pieces.encoder(own)
        got = [ids.tolist() for ids, _ in encode([text, text[:-1] + "x"])]
        del encode
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got == [library.encode(text), library.encode(text[:-1] + "x")]
    assert held < 1000 * letters + (4 << 20)


def test_long_words_are_not_kept(model):
    encode = pieces.encoder(pieces.Pieces(model))
    encode(["short " + "long" * 100])
    known = next(c.cell_contents for n, c in zip(encode.__code__.co_freevars, encode.__closure__) if n == "known")
    assert "short" in known and all(len(k) <= pieces.JOINED for k in known)


def test_edges(make_docs, spiky_rows, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    found = pieces.encoded_texts(make_docs(spiky_rows), MODEL).collect()
    assert len(found) == len(spiky_rows)
    for r in found:
        if r.text is None:
            assert r.piece_ids is None and r.n_pieces is None and r.n_words is None and r.decoded is None
        else:
            assert r.piece_ids == library.encode(r.text) and r.decoded == r.text and r.n_pieces == len(r.piece_ids)
    assert pieces.encoded_texts(make_docs([]), MODEL).count() == 0


def test_query(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = dict(map(tuple, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()))
    found = queries.op8_sentencepiece(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(docs) and all(r.round_trip and r.piece_ids == library.encode(docs[r.doc_id]) for r in found)

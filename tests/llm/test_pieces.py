from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pytest
import sentencepiece
from helpers import documents, prose
from sentencepiece import sentencepiece_model_pb2 as format_

from tallyloom.llm import pieces
from tallyloom.llm.queries import PIECE_MODEL

TEXTS = [
    "Hello  world", "a\n\n b", " lead", "trail ", "   ", "\n", "x\ty", "café 日本語 ☃ 😀", "don't, stop. 3.14 .com",
    "naïve ,comma", "word,word;word", "\u0000 nul", prose(1, 3000), "=" * 500, "a" * 300,
]


@pytest.fixture(scope="module")
def unigram():
    """The same pieces declared as a unigram model, whose library encoder is the yardstick.
    Scores so low that single precision would lose all others are raised."""
    model = format_.ModelProto()
    model.ParseFromString(Path(PIECE_MODEL).read_bytes())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -40_000.0)
    return model.SerializeToString()


def test_ids_equal_the_library(unigram):
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram)
    mine = pieces.PieceModel(unigram)
    for text in TEXTS:
        assert list(mine.encode(text)) == library.encode(text)


def test_best_path_equals_trying_all(unigram):
    model = pieces.PieceModel(unigram)
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram)
    score = {library.id_to_piece(i): library.get_score(i) for i in range(259, 32_000)}

    def best(text):
        if not text:
            return 0.0
        options = [best(text[n:]) + score[text[:n]] for n in range(1, len(text) + 1) if text[:n] in score]
        return max(options)

    for word in ("the", "▁another", "tation", "▁▁in", "zzq"):
        path = model.best_path(word)
        assert sum(library.get_score(i) for i in path) == best(word)


def test_whole_and_cut_texts_agree(unigram):
    model, whole = pieces.PieceModel(unigram), pieces.PieceModel(unigram)
    assert len(model.parts.findall(" one, two\n three")) == 5
    whole.parts = pieces.WHOLE
    for text in TEXTS:
        assert list(model.encode(text)) == list(whole.encode(text))


def test_round_trip_and_edge_cases(spark):
    rows = [(i, t) for i, t in enumerate([*TEXTS, "▁", "a▁b ▁▁ c", "▁ x", "", None, TEXTS[0]])]
    docs = documents(spark, rows, extra=True)
    encoded = pieces.encode_texts(docs, PIECE_MODEL, checked=True)
    made = {r.doc_id: r for r in encoded.collect()}
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in made.values())
    decoded = {r.doc_id: r.text for r in pieces.decode_ids(encoded, PIECE_MODEL).collect()}
    assert decoded == {i: t or "" for i, t in rows}
    assert made[0].ids == made[len(rows) - 1].ids
    assert pieces.encode_texts(docs.limit(0), PIECE_MODEL).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode_ids(nulls, PIECE_MODEL).first().text is None


def test_unknown_piece_without_byte_pieces():
    model = format_.ModelProto()
    for text, score, kind in (("<unk>", 0.0, 2), ("▁", -1.0, 1), ("a", -1.0, 1), ("ab", -1.5, 1), ("b", -1.0, 1)):
        model.pieces.add(piece=text, score=score, type=kind)
    model.trainer_spec.model_type = 1
    mine = pieces.PieceModel(model.SerializeToString())
    assert list(mine.encode("ab?b")) == [1, 3, 0, 4]
    assert mine.decode([1, 3, 0, 4]) == "ab ⁇ b"


def test_round_trips_are_judged_text_by_text(unigram):
    model = pieces.PieceModel(unigram)
    texts = [t for t in TEXTS if t] + [""]
    ids = [model.encode(t) for t in texts]

    def judged(texts, ids):
        ends = pieces.np.cumsum([0, *map(len, ids)]).astype("int32")
        flat = pieces.np.array([i for some in ids for i in some], "int32")
        return pieces._round_trips(model, texts, flat, ends).tolist()

    assert judged(texts, ids) == [model.decode(i) == t for i, t in zip(ids, texts, strict=True)] == [True] * len(texts)
    # One id lost, one changed for another as long, one text too many blanks.
    wrong = [list(i) for i in ids]
    del wrong[0][-1]
    at = next(n for n, piece in enumerate(wrong[1]) if len(model.raw[piece]) == 1)
    wrong[1][at] = model.bytes[0]
    assert judged(texts, wrong) == [False, False] + [True] * (len(texts) - 2)
    assert judged(texts, [ids[0], wrong[1], *ids[2:]]) == [True, False] + [True] * (len(texts) - 2)
    assert judged([], []) == []


def test_idle_workers_remember_no_parts(spark):
    serialised = Path(PIECE_MODEL).read_bytes()
    rows = [(i, " ".join(f"word{i}x{j}" for j in range(200))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert pieces.encode_texts(docs, PIECE_MODEL).count() == 64

    def remembered(source):
        for batch in source:
            model = pieces.load_model(serialised)
            parts = len(model.known) + len(model.older)
            yield pa.RecordBatch.from_arrays([pa.array([parts] * batch.num_rows, pa.int64())], names=["n"])

    found = spark.range(8, numPartitions=8).mapInArrow(remembered, "n long").collect()
    assert [row.n for row in found] == [0] * 8

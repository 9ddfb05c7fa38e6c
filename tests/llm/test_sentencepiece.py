from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto

from tabforge.llm.pieces import flattened
from tabforge.llm import sentencepiece_tokens as st
from tests.llm.data import awkward_rows, documents, sentence

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def hand_made_unigram(path) -> str:
    """A unigram model with byte fallback, written by hand: pieces and scores are listed, nothing is trained."""
    model = proto.ModelProto()
    model.trainer_spec.model_type, model.trainer_spec.byte_fallback = st.UNIGRAM, True
    model.normalizer_spec.name, model.normalizer_spec.add_dummy_prefix, model.normalizer_spec.remove_extra_whitespaces = "identity", True, False
    kinds = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", -20.0, 6) for b in range(256)]
    parts = ["▁", "▁ba", "▁ren", "ba", "ren", "to", "mil", "sa", "ku", "der", "▁to", "ba" + "ren", "a", "b", "e", "n", "r", "t", "o", "m", "i", "l", "s"]
    for piece, score, kind in kinds + [(p, -2.0 - 0.37 * i, 1) for i, p in enumerate(parts)]:
        model.pieces.add(piece=piece, score=score, type=kind)
    path.write_bytes(model.SerializeToString())
    return str(path)


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_parity_with_sentencepiece(spark, tmp_path, kind):
    model = MODEL if kind == "bpe" else hand_made_unigram(tmp_path / "u.model")
    truth = SentencePieceProcessor(model_file=model)
    rows = [*awkward_rows(), *[(100 + i, sentence(i, 40)) for i in range(30)], (200, "lit▁eral ▁x▁ y"), (201, "a \n b"), (202, "emoji 😀 ok")]
    for r in st.encode_documents(documents(spark, rows), model).collect():
        assert r["parity"] and (r["ids"] or []) == truth.encode(r["text"] or ""), r["text"][:50]


def test_decoding_and_digests(spark):
    docs = documents(spark, awkward_rows()).selectExpr("*", "1 AS IDS", "'z' AS decoded")
    encoded = st.encode_documents(docs, MODEL)
    for r in st.decode_documents(encoded, MODEL).collect():
        assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    truth = SentencePieceProcessor(model_file=MODEL)
    expected = sorted((len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in (truth.encode(t or "") for _, t, *_ in awkward_rows()))
    checked = st.verify_documents(documents(spark, awkward_rows()), MODEL).collect()
    assert sorted((r["n_tokens"], r["ids_crc32"]) for r in checked) == expected
    assert all(r["parity"] and r["round_trip"] for r in checked)


def test_ids_and_texts_are_those_of_the_rebuilt_library():
    """With a wrong rebuild the wrong ids come out, however many pieces differ, and parity says so."""
    own = st.Codec(MODEL)
    wrong, right = own.library.token_to_id("▁to"), own.library.token_to_id("▁the")
    given_ids = own._library_ids
    changed = lambda texts: [[wrong if i == right else i for i in x] for x in given_ids(texts)]
    own.encoder.encode = lambda pieces, first: own._compared(pieces, first, flattened(changed(pieces)))
    texts = ["the end of the day", "nothing here", None, "in the", ""]
    ids, starts, agrees = own.encode(pa.array(texts))
    assert agrees.tolist() == [False, True, True, False, True]
    pieces = [[changed([p])[0] for p in t.split(" ")] if t else [] for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == [sum(p, []) for p in pieces]
    assert own.decode(ids, starts)[0] == "to end of to day"

    class Other:
        def decode_batch(self, ids, skip_special_tokens):
            return [f"{len(i)} ids" for i in ids]

    own.library = Other()
    assert own.decode(ids, starts)[2] == "0 ids"


def test_decoding_equals_the_library(tmp_path):
    own = st.Codec(MODEL)
    truth = SentencePieceProcessor(model_file=MODEL)
    for text in ("  two  blanks ", "plain words", "日本 語", "", "end\n"):
        ids = np.array(truth.encode(text), np.uint32)
        assert own.decode(ids, np.array([0, len(ids)])) == [own.library.decode(ids.tolist())] == [truth.decode(ids.tolist())]


def test_empty_table_and_unsupported_models(spark, tmp_path):
    assert st.encode_documents(documents(spark, []), MODEL).count() == 0
    model = proto.ModelProto()
    model.ParseFromString(open(MODEL, "rb").read())
    model.trainer_spec.model_type = 3
    (tmp_path / "w.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="unigram and BPE"):
        st.read_model(str(tmp_path / "w.model"))


def test_the_library_works_in_the_thread_of_the_task(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    st.codec.cache_clear()
    st.codec(MODEL)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"

from __future__ import annotations

import io
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some
from tokenizers import AddedToken, Tokenizer

from tabforge.llm import token_files as tf
from tabforge.llm.pieces import PieceEncoder, strings
from tabforge.llm.queries import op10_token_bit_planes
from tests.llm.data import awkward_rows, documents, sentence

FILE = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(FILE)
    tokenizer.encode_special_tokens = True
    return tokenizer


@given(some.lists(some.text(alphabet=" \n\tabé'’1　\x1c<|endoftext|>", max_size=30), max_size=8))
@settings(max_examples=60, deadline=None)
def test_pieces_give_the_ids_of_whole_texts(library, texts):
    ids, starts = tf.byte_level_encoder(FILE)(pa.array(texts, pa.string()))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == expected


@given(some.lists(some.lists(some.sampled_from(["<|endoftext|>", " ", "  ", "a", "bé", "'s", "\n", "1", "<|", "word word"]), max_size=12).map("".join), max_size=8))
@settings(max_examples=200, deadline=None)
def test_added_tokens_are_those_of_the_file_as_loaded(texts):
    ids, starts = tf.byte_level_encoder(FILE, special_as_text=False)(pa.array(texts, pa.string()))
    plain = Tokenizer.from_file(FILE)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == expected


def test_query_gives_the_ids_of_the_file_as_loaded(spark, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "plain words"), (3, "x<|endoftext|><|endoftext|>  y"), (4, "<|endoftext|>"), *[(10 + i, sentence(i, 30)) for i in range(20)]]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    plain, start = Tokenizer.from_file(FILE), 0
    found = op10_token_bit_planes(spark, str(tmp_path)).orderBy("start").collect()
    for r, (i, text) in zip(found, rows, strict=True):
        tokens = [*plain.encode(text, add_special_tokens=False).ids, 0]
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes()))
        start += len(tokens)


def test_added_tokens_that_take_in_blanks(tmp_path):
    plain = Tokenizer.from_file(FILE)
    plain.add_special_tokens([AddedToken("<mark>", lstrip=True, rstrip=True)])
    plain.save(str(tmp_path / "t.json"))
    texts = ["a <mark> b", "words and words", None, "", "x  <mark>  <|endoftext|> y"]
    ids, starts = tf.byte_level_encoder(str(tmp_path / "t.json"), special_as_text=False)(pa.array(texts, pa.string()))
    expected = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)] == expected


class Kept(io.BytesIO):
    def close(self) -> None:
        """What was written stays readable."""


def test_memory_of_pieces_is_bounded():
    encoder = PieceEncoder(lambda pieces, first: (np.array([len(p) for p in pieces], np.uint32), np.ones(len(pieces), np.int64)), remember=60)
    for i in range(20):
        ids, starts = encoder(pa.array([" ".join(f"w{i}x{j}" for j in range(30)), None, ""]))
        assert len(ids) == 30 and starts.tolist() == [0, 30, 30, 30]
        assert len(encoder.later) <= 60


@given(some.lists(some.integers(0, 2**16 - 1), max_size=300), some.integers(1, 64))
@settings(max_examples=60, deadline=None)
def test_planes_and_files_round_trip(numbers, block):
    ids = np.array(numbers, np.uint32)
    if len(ids):
        assert (tf.from_planes(tf.to_planes(ids, 16), len(ids)) == ids).all()
    out = Kept()
    writer = tf.ShardWriter(out, 16, block, 1)
    for part in np.array_split(ids, 5):
        writer.add(part)
    writer.close()
    reader = tf.ShardReader(pa.BufferReader(out.getvalue()))
    assert reader.ids(0, len(ids)).tolist() == numbers
    middle = len(ids) // 3
    assert reader.ids(middle, len(ids) - 2 * middle).tolist() == numbers[middle : len(ids) - middle]


def test_wide_ids_need_planes():
    writer = tf.ShardWriter(io.BytesIO(), 8, 16, 1)
    with pytest.raises(ValueError, match="bits"):
        writer.add(np.array([256], np.uint32))


@pytest.mark.parametrize("shards", [1, 5])
def test_documents_in_files(spark, library, tmp_path, shards):
    rows = [*awkward_rows(), *[(1000 - i, sentence(i, i % 60)) for i in range(120)]]
    path = str(tmp_path / "files")
    written = tf.write_token_files(documents(spark, rows), lambda: tf.byte_level_encoder(FILE), path, block=97, shards=shards)
    found = tf.read_documents(tf.with_starts(written), path).orderBy("start").collect()
    assert len({r["file"] for r in found}) == shards
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    expected = sorted((i is not None, i or 0, [*library.encode(t or "", add_special_tokens=False).ids, 0]) for i, t, *_ in rows)
    start = 0
    for r, (_, _, tokens) in zip(found, expected, strict=True):
        assert (r["start"], r["n_tokens"]) == (start, len(tokens))
        assert r["ids_crc32"] == zlib.crc32(np.array(tokens, "<u4").tobytes())
        start += len(tokens)


def test_empty_table(spark, tmp_path):
    written = tf.write_token_files(documents(spark, []), lambda: tf.byte_level_encoder(FILE), str(tmp_path / "f"))
    assert tf.read_documents(tf.with_starts(written), str(tmp_path / "f")).count() == 0


def test_the_library_works_in_the_thread_of_the_task(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    tf.byte_level_encoder.cache_clear()
    tf.byte_level_encoder(FILE)
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_ids_within_one_chunk_are_not_copied():
    out = io.BytesIO()
    out.close = lambda: None
    writer = tf.ShardWriter(out, 16, 8, 3)
    writer.add(np.arange(20, dtype=np.uint32))
    writer.close()
    reader = tf.ShardReader(pa.BufferReader(out.getvalue()))
    assert np.shares_memory(reader.ids(1, 5), reader.chunk(0))
    assert reader.ids(6, 12).tolist() == list(range(6, 18)) and reader.ids(20, 0).tolist() == []


@given(some.lists(some.text(max_size=8), max_size=20), some.integers(0, 3))
@settings(max_examples=40, deadline=None)
def test_strings_of_a_sliced_array_are_those_of_its_list(texts, skip):
    found = strings(pa.array(texts, pa.large_string()).slice(min(skip, len(texts))))
    assert found == texts[skip:] and all(type(t) is str for t in found)

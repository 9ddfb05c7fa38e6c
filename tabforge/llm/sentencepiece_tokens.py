"""SentencePiece encoding and decoding by the tokenizers library, with parity verified against sentencepiece.

The model file is parsed as protobuf; from it come the normaliser (character
map, extra white space, leading blank), the metaspace marker, the pieces with
their scores (unigram) or the merges that the scores rank (BPE), and the byte
fallback.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from tabforge.llm.columns import without
from tabforge.llm.pieces import Coded, PieceEncoder, flattened, joined_encoder, one_thread

MARK = "▁"
# Model and piece types of the protobuf.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
DIFFERS = 2**32 - 1  # no id


def read_model(path: str) -> proto.ModelProto:
    model = proto.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    if model.trainer_spec.model_type not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models can be rebuilt")
    if any(p.type == USER_DEFINED for p in model.pieces):
        raise ValueError("models with user-defined symbols are not supported")
    return model


def merges_of(model: proto.ModelProto) -> list[tuple[str, str]]:
    """BPE merges in their order: every way to make a piece of two others, by the score of the piece.

    Ways of one piece are in the order of the left part's length.
    """
    scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
    ways = []
    for place, p in enumerate(model.pieces):
        for i in range(1, len(p.piece) if p.type == NORMAL else 0):
            a, b = p.piece[:i], p.piece[i:]
            if a in scores and b in scores:
                ways.append((-p.score, place, i, a, b))
    return [(a, b) for *_, a, b in sorted(ways)]


def rebuild(model: proto.ModelProto) -> Tokenizer:
    """A tokenizers-library tokenizer with the ids of the model."""
    norm, train = model.normalizer_spec, model.trainer_spec
    unknown = next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), None)
    fallback = train.byte_fallback
    if train.model_type == UNIGRAM:
        # Control pieces never match a text: no normalised text has a blank.
        vocabulary = [(p.piece if p.type in (NORMAL, BYTE) else " " + p.piece, p.score) for p in model.pieces]
        core = models.Unigram(vocabulary, unknown, fallback)
    else:
        vocabulary = {p.piece: i for i, p in enumerate(model.pieces)}
        mark = model.pieces[unknown].piece if unknown is not None else None
        core = models.BPE(vocabulary, merges_of(model), unk_token=mark, fuse_unk=True, byte_fallback=fallback)
    library = Tokenizer(core)
    steps = []
    if norm.precompiled_charsmap:
        steps.append(normalizers.Precompiled(norm.precompiled_charsmap))
    if norm.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if norm.add_dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    library.normalizer = normalizers.Sequence(steps)
    if can_cut(model):
        library.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    tail = [decoders.Strip(" ", 1, 0)] if norm.add_dummy_prefix else []
    library.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
    return library


def can_cut(model: proto.ModelProto) -> bool:
    """Whether no piece has the marker after another character, so that texts may be cut at lone blanks."""
    return not any(MARK in p.piece.lstrip(MARK) for p in model.pieces)


class Codec:
    """Encoder, decoder and parity check of one model; kept for the life of a Python worker."""

    def __init__(self, path: str, threads: int = 2):
        model = read_model(path)
        if not can_cut(model):
            raise ValueError("a piece of this model spans a blank")
        self.library, self.truth, self.threads = rebuild(model), SentencePieceProcessor(model_file=path), threads
        self.prefix = model.normalizer_spec.add_dummy_prefix
        norm = model.normalizer_spec
        plain = norm.name == "identity" and not norm.precompiled_charsmap and not norm.remove_extra_whitespaces
        if plain and model.trainer_spec.byte_fallback:
            lengths = np.array([1 if p.type == BYTE else len(p.piece.replace(MARK, " ").encode()) for p in model.pieces])
            encode = joined_encoder(self._library_ids, lengths, lambda p: pc.binary_length(pc.replace_substring(p, MARK, " ")), lead="" if self.prefix else " ")
        else:
            encode = self._one_by_one
        self.encoder = PieceEncoder(lambda pieces, first: self._compared(pieces, first, encode(pieces, first)), blanks=MARK, remember=120_000, at_once=20_000)

    def _library_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _one_by_one(self, pieces: list[str], first: bool) -> Coded:
        lead = "" if first or self.prefix else " "
        return flattened(self._library_ids([lead + p for p in pieces]))

    def _compared(self, pieces: list[str], first: bool, found: Coded) -> Coded:
        """The library's ids, with ``DIFFERS`` behind those of a piece that sentencepiece itself encodes otherwise.

        The mark goes through the memory of pieces and is taken out of the texts.
        """
        lead = "" if first or self.prefix else " "
        ids, counts = found
        expected, sizes = flattened(self.truth.encode([lead + p for p in pieces], num_threads=self.threads))
        if np.array_equal(counts, sizes) and np.array_equal(ids, expected):
            return found
        own, other = np.split(ids, np.cumsum(counts)[:-1]), np.split(expected, np.cumsum(sizes)[:-1])
        differs = np.array([not np.array_equal(a, b) for a, b in zip(own, other, strict=True)])
        return np.insert(ids, np.cumsum(counts)[differs], np.uint32(DIFFERS)), counts + differs

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of a batch, where each text's ids start, and whether all of its pieces agree with sentencepiece."""
        ids, starts = self.encoder(texts)
        marks = ids == DIFFERS
        if not marks.any():
            return ids, starts, np.ones(len(texts), bool)
        before = np.concatenate([[0], np.cumsum(marks)])[starts]
        return ids[~marks], starts - before, np.diff(before) == 0

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of a batch of ids, by the library's decoder."""
        return self.library.decode_batch([ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)], skip_special_tokens=False)


@lru_cache(maxsize=2)
def codec(path: str, threads: int = 2) -> Codec:
    one_thread()
    return Codec(path, threads)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def encode_documents(docs: DataFrame, model: str, text_col: str = "text", threads: int = 2, keep_text: bool = True) -> DataFrame:
    """``docs`` (without the text, unless ``keep_text``) with ``ids`` (array of int) and ``parity``; input columns of these names are replaced.

    ``model`` is the path of the model file on every machine. Null and empty
    texts have no ids. ``parity`` says that the rebuilt tokenizer gave every
    piece of the text the ids that sentencepiece gives it; the ids are those of the
    rebuilt tokenizer and never depend on other rows or on the batch.
    """
    docs = docs.select(*without(docs, ["ids", "parity"]))
    at = docs.columns.index(text_col)
    kept = [i for i in range(len(docs.columns)) if keep_text or i != at]
    names = [*[docs.columns[i] for i in kept], "ids", "parity"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for batch in _slices(batches):
            ids, starts, agrees = own.encode(batch.column(at))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], lists, pa.array(agrees)], names=names)

    schema = docs.select(*[f"`{docs.columns[i]}`" for i in kept], F.array().cast("array<int>").alias("ids"), F.lit(True).alias("parity")).schema
    return docs.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model: str, ids_col: str = "ids", threads: int = 2) -> DataFrame:
    """``encoded`` with ``decoded``, the text of ``ids_col``; null ids give null. An input column ``decoded`` is replaced."""
    encoded = encoded.select(*without(encoded, ["decoded"]))
    at = encoded.columns.index(ids_col)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for batch in _slices(batches):
            lists = batch.column(at)
            sizes = np.diff(lists.offsets.to_numpy()) * lists.is_valid().to_numpy(zero_copy_only=False)
            texts = own.decode(lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)]))
            found = pa.array(texts, pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(decode, encoded.select("*", F.lit("").alias("decoded")).schema)


def verify_documents(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", threads: int = 2) -> DataFrame:
    """``(doc_id, n_tokens, ids_crc32, parity, round_trip)`` of every text: encoded, compared, decoded again.

    ``ids_crc32`` is the checksum of the ids as little-endian u32;
    ``round_trip`` says that the decoded text is the text with the marker read
    as a blank. Null texts count as empty, which have no ids and come back as such.
    """

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, threads)
        for batch in _slices(batches):
            ids, starts, agrees = own.encode(batch.column(1))
            texts = [(t or "").replace(MARK, " ") for t in batch.column(1).to_pylist()]
            same = [a == b for a, b in zip(own.decode(ids, starts), texts, strict=True)]
            sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(starts)), pa.array(sums, pa.int64()), pa.array(agrees), pa.array(same, pa.bool_())],
                names=["doc_id", "n_tokens", "ids_crc32", "parity", "round_trip"],
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(slim.dtypes)["doc_id"]
    return slim.mapInArrow(check, f"doc_id {kind}, n_tokens long, ids_crc32 long, parity boolean, round_trip boolean")

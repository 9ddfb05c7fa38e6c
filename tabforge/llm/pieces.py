"""Encoding whole texts through the tokenizers library, each distinct piece once.

A byte-level or metaspace tokenizer never joins the two sides of a blank that
stands alone between other characters: the later word carries the blank at its
start. So a text may be cut at such blanks, and its ids are those of its pieces.
Natural text repeats its words, so a batch is cut and its pieces numbered with
vectorised Arrow functions, the library gets the pieces not seen lately, joined
to long texts, and the ids of the documents are gathered from the pieces' ids.
Texts in which some blanks do not stand alone are cut by a regular expression.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Coded = tuple[np.ndarray, np.ndarray]  # ids of several pieces, one after the other, and how many each has

_SPACES = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())


def lone_blank(also: str = "") -> re.Pattern:
    """Blanks between two characters that are neither white space nor in ``also``."""
    return re.compile(rf"(?<=[^\s{also}]) (?=[^\s{also}])")


def other_blank(also: str = "") -> str:
    """A pattern (RE2) of the blanks that do not stand alone between two such characters."""
    near = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in _SPACES + also) + "]"
    return rf"\A | \z| {near}|{near} "


def one_thread() -> None:
    """The tokenizers library works in the calling thread: tasks fill the cores already, and its pool of threads costs several times the work."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class Memory:
    """Ids of pieces under the numbers of the pieces; forgotten as a whole between batches once there are ``size`` of them."""

    def __init__(self, size: int):
        self.size = size
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.ids, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64)

    def __len__(self) -> int:
        return len(self.numbers)

    def look_up(self, pieces: list[str]) -> np.ndarray:
        """The number of each piece, -1 for one that is not known."""
        return np.fromiter(map(self.numbers.get, pieces, [-1] * len(pieces)), np.int64, len(pieces))

    def add(self, pieces: list[str], coded: Coded) -> np.ndarray:
        """The numbers that new pieces get."""
        given = range(len(self.counts), len(self.counts) + len(pieces))
        self.numbers.update(zip(pieces, given, strict=True))
        self.ids, self.counts = np.concatenate([self.ids, coded[0]]), np.concatenate([self.counts, coded[1]])
        return np.array(given, np.int64)


class PieceEncoder:
    """Ids of whole texts. ``encode(pieces, first)`` gives the ids of pieces.

    ``first`` says whether the pieces stand at the start of a text or after a
    lone blank; ``blanks`` are characters that the tokenizer takes for a blank.
    About ``remember`` pieces are kept between batches, and the library gets
    at most ``at_once`` of them at a time.
    """

    def __init__(self, encode: Callable[[list[str], bool], Coded], blanks: str = "", remember: int = 250_000, at_once: int = 40_000):
        self.encode, self.at_once = encode, at_once
        self.cut, self.odd = lone_blank(blanks).split, other_blank(blanks)
        self.later, self.first = Memory(remember), Memory(remember)

    def _numbers(self, pieces: list[str], memory: Memory) -> np.ndarray:
        numbers = memory.look_up(pieces)
        new = np.flatnonzero(numbers < 0)
        if len(new):
            wanted = pieces if len(new) == len(pieces) else [pieces[i] for i in new]
            parts = [self.encode(wanted[i : i + self.at_once], memory is self.first) for i in range(0, len(wanted), self.at_once)]
            numbers[new] = memory.add(wanted, (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])))
        return numbers

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of strings, and where each text's ids start (one entry more than texts)."""
        for memory in (self.later, self.first):
            if len(memory) >= memory.size:
                memory.forget()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, self.odd).to_numpy(zero_copy_only=False)
        even_at, odd_at = np.flatnonzero(filled & ~odd), np.flatnonzero(filled & odd)
        even = pc.split_pattern(texts.take(pa.array(even_at)), " ")
        cut = [self.cut(t) for t in strings(texts.take(pa.array(odd_at)))]
        flat = pa.concat_arrays([even.flatten(), pa.array([p for c in cut for p in c], pa.large_string())])
        sizes = np.concatenate([np.diff(even.offsets.to_numpy()), np.fromiter(map(len, cut), np.int64, len(cut))])
        heads_at = np.cumsum(sizes) - sizes
        coded, heads = flat.dictionary_encode(), flat.take(pa.array(heads_at)).dictionary_encode()
        later = self._numbers(strings(coded.dictionary), self.later)
        first = self._numbers(strings(heads.dictionary), self.first)
        number = later[coded.indices.to_numpy()]
        number[heads_at] = first[heads.indices.to_numpy()] + len(self.later.counts)
        counts = np.concatenate([self.later.counts, self.first.counts])
        # The texts with odd blanks were cut last; the ids are gathered in the order of the batch.
        at = np.concatenate([even_at, odd_at])
        if len(odd_at) and len(even_at):
            order = np.argsort(at, kind="stable")
            number, sizes, at = number[stretches(heads_at[order], sizes[order])], sizes[order], at[order]
        pool = pa.array(np.concatenate([self.later.ids, self.first.ids]))
        coded_pieces = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)])), pool)
        gathered = coded_pieces.take(pa.array(number))
        ends = gathered.offsets.to_numpy()[np.concatenate([[0], np.cumsum(sizes)])]
        lengths = np.zeros(len(texts), np.int64)
        lengths[at] = np.diff(ends)
        return gathered.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])


def strings(texts: pa.Array) -> list[str]:
    """The strings of an array without nulls as Python's; an array of objects is made many times faster than a list of scalars."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start``, ``start + 1``, .. of all stretches, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)


def flattened(lists: list[list[int]]) -> Coded:
    """Lists of ids as one array and their lengths."""
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.uint32, int(counts.sum())), counts


def joined_encoder(
    encode_texts: Callable[[list[str]], list[list[int]]],
    lengths: np.ndarray,
    size: Callable[[pa.Array], pa.Array] = pc.binary_length,
    lead: str = " ",
    group: int = 2000,
) -> Callable[[list[str], bool], Coded]:
    """An ``encode`` for ``PieceEncoder`` that sends many pieces as one text.

    ``lengths`` is the length of each id's part of the text and ``size`` that of
    pieces, both in the same unit and with the blank in front of a later piece;
    where the sums meet, the ids of the next piece begin. ``lead`` starts such a
    text, unless the tokenizer adds a blank itself. Pieces at the start of a
    text go one by one.
    """

    def encode(pieces: list[str], first: bool) -> Coded:
        if first:
            return flattened(encode_texts(pieces))
        groups = [pieces[i : i + group] for i in range(0, len(pieces), group)]
        ids = np.concatenate([np.array(x, np.uint32) for x in encode_texts([lead + " ".join(g) for g in groups])])
        # Each group begins with a blank of its own, so the lengths of all groups run on.
        ends = np.cumsum(size(pa.array(pieces, pa.large_string())).to_numpy() + 1)
        met = np.cumsum(lengths[ids])
        return ids, np.diff(np.searchsorted(met, ends) + 1, prepend=0)

    return encode

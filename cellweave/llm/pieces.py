"""Ids of texts through caches of chunks and words, and the tokenizers library as one source of such ids."""

from __future__ import annotations

import functools
import os
import sys
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .common import CACHES

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: How vocabularies with word ends split lower-cased text.
WORD_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
CHUNKS, WORDS, LONGEST = 150_000, 400_000, 48  # bounds of the caches' young halves; longer keys are not kept


class Kept:
    """A cache of ids by text in two generations: what is in use moves to the young one, the old one is dropped when the
    young one is full. So memory is bounded by twice the limit."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def lookup(self, wanted: list[str], learn: Callable[[list[str]], Iterable[bytes]]) -> list[bytes]:
        """The ids of each key; learn gives those of new ones. Keys are distinct."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        found = [young.get(k) for k in wanted]
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            if (ids := old.get(wanted[k])) is None:
                new.append(k)
            else:
                found[k] = young[wanted[k]] = ids
        for k, ids in zip(new, learn([wanted[k] for k in new]) if new else (), strict=True):
            found[k] = ids
            if len(wanted[k]) <= LONGEST:
                young[wanted[k]] = ids
        return found

def joined(split: list[list[str]], cache: Kept, learn: Callable[[list[str]], Iterable[bytes]]) -> list[bytes]:
    """Ids of chunks given as lists of words, each distinct word looked up once."""
    words = list(set().union(*split))
    known = dict(zip(words, cache.lookup(words, learn), strict=True))
    return [known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws]) for ws in split]


def by_chunks(texts: pa.Array, mark: str, lookup: Callable[[list[str]], list[bytes]]) -> list[bytes]:
    """Ids of texts that are cut at a mark. Arrow cuts and numbers the chunks; each distinct one is looked up once and
    numpy puts the ids together."""
    cut = pc.split_pattern(texts, mark)
    coded = cut.flatten().dictionary_encode()
    return gathered(lookup(coded.dictionary.to_pylist()), coded.indices.to_numpy(zero_copy_only=False), cut.offsets.to_numpy() - cut.offsets[0].as_py())


def gathered(ids: list[bytes], index: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """Ids of texts: those that the index names, from one offset to the next."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    start = np.cumsum(size) - size
    n = size[index]
    end = np.cumsum(n)
    out = flat[np.repeat(start[index] - (end - n), n) + np.arange(end[-1] if len(end) else 0)]
    at = np.concatenate([[0], end])[offsets]
    return [out[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def ids_bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


#: A lower-cased chunk that is one word, with or without a point or comma after it; others are split by WORD_SPLIT.
SIMPLE = "^(?P<word>[a-zß-öø-ɏ]+)(?P<end>[.,]?)$"
PIECES = 300_000  # bound of the young half of an encoder's cache of words


class PieceEncoder:
    """encode(texts): ids without special tokens added, as little-endian unsigned 32-bit integers.

    For a vocabulary that lower-cases and drops white space: no id spans a blank or a line feed, and words of one chunk
    do not affect each other. So distinct words go to the library once; Arrow cuts texts into chunks and simple chunks
    into words, and numpy puts their ids together. Texts that hold the mark of a special token go to the library whole;
    so do chunks with letters whose normal form or lower case depends on others.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = Kept(PIECES)
        self.ends = self.plain([".", ",", ""])

    def plain(self, texts: list[str]) -> list[bytes]:
        return [ids_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    @staticmethod
    def split(chunk: str) -> list[str]:
        if not chunk:
            return []
        if max(chunk) > "ɏ" or "İ" in chunk:
            return [chunk]
        return WORD_SPLIT.findall(chunk.lower())

    def pieces(self, chunks: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of words, and for each chunk which two of them it is made of."""
        found = pc.extract_regex(pc.if_else(pc.match_substring(chunks, "İ"), "", pc.utf8_lower(chunks)), SIMPLE)
        simple = found.is_valid().to_numpy(zero_copy_only=False)
        coded = found.field("word").filter(found.is_valid()).dictionary_encode()
        known = self.words.lookup(coded.dictionary.to_pylist(), self.plain)
        odd = joined([self.split(c) for c in chunks.filter(pc.invert(found.is_valid())).to_pylist()], self.words, self.plain)
        table = known + self.ends + odd
        two = np.full((len(chunks), 2), len(known) + 2)
        two[simple, 0] = coded.indices.to_numpy(zero_copy_only=False)
        end = found.field("end").filter(found.is_valid())
        for k, mark in enumerate(".,"):
            two[np.flatnonzero(simple)[pc.equal(end, mark).to_numpy(zero_copy_only=False)], 1] = len(known) + k
        two[~simple, 0] = len(known) + 3 + np.arange(len(odd))
        return table, two

    def encode(self, texts: pa.Array) -> list[bytes]:
        """texts: strings without nulls."""
        marked = sorted({int(k) for m in self.marks for k in np.flatnonzero(pc.match_substring(texts, m, ignore_case=True).to_numpy(zero_copy_only=False))})
        cut = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        table, two = self.pieces(coded.dictionary)
        offsets = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        out = gathered(table, two[coded.indices.to_numpy(zero_copy_only=False)].ravel(), 2 * offsets)
        for k, ids in zip(marked, self.plain([texts[k].as_py() for k in marked]), strict=True):
            out[k] = ids
        return out


@functools.lru_cache(2)
def piece_encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


CACHES.append(piece_encoder.cache_clear)

"""Byte-level BPE by a contiguous rank array, and exact re-use of a tokenizer's word pieces.

A word is held as part boundaries with the rank of each adjacent pair beside them. The lowest rank is looked for again
and again, its boundary is deleted and the two neighbouring ranks are refreshed, until no pair has a rank. Words of a
batch are handled together, one row of a matrix each, so that numpy makes each step for all of them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import functions as F

from .pieces import CHUNKS, WORDS, Kept, by_chunks, joined

#: How byte-level vocabularies split text before merging.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NONE = np.iinfo(np.int64).max

#: White space other than blank and line feed; \s of regex and of Python's re together.
ODD_ASCII = tuple("\t\r\x0b\x0c\x1c\x1d\x1e\x1f")
ODD_OTHER = tuple("\x85\xa0                　")
ROWS = 2000  # encoded at once
UNSAFE = re.compile(r"\s[ \n](?:\s|\Z)")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself if it prints, else the next free code from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class ByteBPE:
    """encode(texts) and decode(ids) for a tokenizers file with byte-level BPE."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        letters, vocab = byte_letters(), spec["model"]["vocab"]
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.table = [b""] * (max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocab.items():
            self.table[i] = as_bytes(token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for token, i in self.added.items():
            self.table[i] = token.encode()
        self.first = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        age: dict[str, int] = {}
        for k, (a, b) in enumerate(pairs):
            if max(age.get(a, -1), age.get(b, -1)) >= k or min(len(a), len(b)) > 1 and (a not in age or b not in age):
                raise ValueError(f"merge {k} joins a part that no earlier merge makes")  # merge_long relies on this
            age.setdefault(a + b, k)
        one = self.first
        self.byte_pairs = self.ranks(np.repeat(one, 256), np.tile(one, 256))
        self.marks = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.chunks, self.words = Kept(CHUNKS), Kept(WORDS)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.rank[at], NONE)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(words)
        by_length = sorted(range(len(words)), key=lambda k: len(words[k]))
        for start in range(0, len(by_length), 20_000):
            self._merge([k for k in by_length[start : start + 20_000]], words, out)
        return out

    def _merge(self, some: list[int], words: list[bytes], out: list[bytes]) -> None:
        some = [k for k in some if words[k]]
        if some and len(words[some[-1]]) > 256:
            for k in [k for k in some if len(words[k]) > 256]:
                out[k] = self.merge_long(words[k])
            some = [k for k in some if len(words[k]) <= 256]
        if not some:
            return
        n = np.array([len(words[k]) for k in some])
        ids = np.full((len(some), n.max() + 1), -1, np.int64)
        inside = np.arange(n.max() + 1) < n[:, None]
        letters = np.zeros(ids.shape, np.int64)
        letters[inside] = np.frombuffer(b"".join([words[k] for k in some]), np.uint8)
        ids[inside] = self.first[letters[inside]]
        rank = np.where(inside[:, 1:], self.byte_pairs[letters[:, :-1] << 8 | letters[:, 1:]], NONE)
        live = np.arange(len(some))
        while len(live):
            best = rank[live].argmin(1)
            low = rank[live, best]
            live, best, low = live[low < NONE], best[low < NONE], low[low < NONE]
            if not len(live):
                break
            ids[live, best] = self.made[low]
            width = ids.shape[1]
            move = np.arange(width)[None, :] > best[:, None]
            source = np.minimum(np.arange(width)[None, :] + move, width - 1)
            part = np.take_along_axis(ids[live], source, 1)
            part[:, -1] = -1
            ids[live] = part
            moved = np.take_along_axis(rank[live], np.minimum(source[:, :-1], width - 2), 1)
            moved[:, -1] = NONE
            row = np.arange(len(live))
            moved[row, best] = self.ranks(part[row, best], part[row, best + 1])
            left = np.maximum(best - 1, 0)
            moved[row, left] = np.where(best > 0, self.ranks(part[row, left], part[row, left + 1]), moved[row, left])
            rank[live] = moved
            n[live] -= 1
        kept = ids[np.arange(ids.shape[1]) < n[:, None]].astype("<u4").tobytes()
        ends = np.concatenate([[0], np.cumsum(n) * 4])
        for k, a, b in zip(some, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            out[k] = kept[a:b]

    def merge_long(self, word: bytes) -> bytes:
        """The same merges for a long word: all places of the lowest rank at once, left to right, as no pair of lower
        rank can come of merging the lowest."""
        ids = self.first[np.frombuffer(word, np.uint8)]
        while len(ids) > 1:
            rank = self.ranks(ids[:-1], ids[1:])
            low = rank.min()
            if low == NONE:
                break
            at = np.flatnonzero(rank == low)
            if len(at) > 1:  # of overlapping places (aaa) every second one of a run counts
                run = np.concatenate([[0], np.cumsum(np.diff(at) > 1)])
                first = at[np.searchsorted(run, run)]
                at = at[(at - first) % 2 == 0]
            ids[at] = self.made[low]
            ids = np.delete(ids, at + 1)
        return ids.astype("<u4").tobytes()

    def merge_texts(self, words: list[str]) -> list[bytes]:
        return self.merge([w.encode() for w in words])

    def learn(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, through their words; each distinct word is merged once."""
        return joined([words_of(c) for c in chunks], self.words, self.merge_texts)

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Whole texts (strings without nulls) as ids, little-endian unsigned 32-bit; marks of special tokens give their
        ids."""
        marks = list(self.added)
        alone = [k for k, t in enumerate(texts.to_pylist()) if any(m in t for m in marks) or not safe(t)]
        cut = pc.replace_substring(pc.replace_substring(texts, "\n", "\x00\n"), " ", "\x00 ")
        out = by_chunks(cut, "\x00", lambda chunks: self.chunks.lookup(chunks, self.learn))
        for k in alone:
            parts = self.marks.split(texts[k].as_py()) if self.marks else [texts[k].as_py()]
            out[k] = b"".join([self.added[p].to_bytes(4, "little") if j % 2 else b"".join(joined([SPLIT.findall(p)], self.words, self.merge_texts)) for j, p in enumerate(parts)])
        return out

    def decode(self, ids: bytes) -> str:
        table = self.table
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def words_of(chunk: str) -> list[str]:
    """The split pattern's pieces; plain words, alone or before a dot or comma, need no pattern."""
    if not chunk:
        return []
    if max(chunk) < "\u0250" and (chunk[0] == " " or chunk[0].isalpha()):
        if chunk[1:].isalpha() or len(chunk) == 1 and chunk != " ":
            return [chunk]
        if chunk[-1] in ".," and chunk[1:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
    return SPLIT.findall(chunk)


def safe(text: str) -> bool:
    """Whether the text may be cut before blanks and line feeds: the split pattern then treats each chunk alone as in
    the text. Each cut needs a character on one side that is no white space; the character used to cut may not occur."""
    odd = "  " in text or "\n " in text or " \n" in text or "\n\n" in text or any(c in text for c in ODD_ASCII)
    return "\x00" not in text and not ((odd or not text.isascii() and any(c in text for c in ODD_OTHER)) and UNSAFE.search(text))


@functools.lru_cache(2)
def byte_bpe(path: str) -> ByteBPE:
    return ByteBPE(path)


def codec_digest(df, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """Per row: doc_id, n_tokens, ids_sha256 and decoded_sha256 of the text encoded and decoded again (null text: empty).

    Texts are encoded whole, ROWS at a time, so memory is bounded by the longest ones; marks of the file's special tokens
    give their ids. Repeated rows give equal results, a null id stays null, other columns are left out, the empty table
    gives no rows.
    """

    def digest(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                ids = bpe.encode(pc.coalesce(some["text"], pa.scalar("", some["text"].type)))
                yield pa.RecordBatch.from_arrays([
                    some["doc_id"], pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                    pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids]),
                ], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

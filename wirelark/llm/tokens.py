"""Byte pair encoding with a public vocabulary, word by word, and its inverse.

``SegmentTreeBpe`` merges by a segment tree of its own; ``LibraryBpe`` asks the tokenizers library for each word. Both
cut a text into words as the vocabulary file says, and keep recent words in a bounded cache.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex

from .common import RecentCache

#: How byte-level vocabularies write bytes. Printable bytes stand for themselves, others for U+0100 on.
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Blanks of str.split() that the vocabulary's pattern for blanks does not hold.
_ODD_BLANKS = regex.compile(r"[\x1c-\x1f]")
_UNRANKED = 1 << 62


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_alphabet() -> list[str]:
    other = iter(range(0x100, 0x200))
    return [chr(b) if b in _PLAIN else chr(next(other)) for b in range(256)]


class SegmentTree:
    """Minimum of (rank, place) over a row of adjacent pairs: the root is the leftmost lowest-rank merge."""

    def __init__(self, keys: list[int]):
        self.width = width = 1 << max(0, len(keys) - 1).bit_length()
        self.tree = tree = [_UNRANKED] * width + keys + [_UNRANKED] * (width - len(keys))
        for at in range(width - 1, 0, -1):
            a, b = tree[2 * at], tree[2 * at + 1]
            tree[at] = a if a < b else b

    def root(self) -> int:
        return self.tree[1]

    def set(self, place: int, key: int) -> None:
        tree, at = self.tree, place + self.width
        tree[at] = key
        while at > 1:
            other = tree[at ^ 1]
            if other < key:
                key = other
            at >>= 1
            if tree[at] == key:
                return
            tree[at] = key


class WordBpe:
    """What the vocabulary file says about added tokens, normal form, words, ids and decoding."""

    def __init__(self, path: str, most: int):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_re = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        pattern = next(x for x in spec["pre_tokenizer"]["pretokenizers"] if x["type"] == "Split")["pattern"]["Regex"]
        self.word_re = regex.compile(pattern)
        self.bytes = byte_alphabet()
        self._merges(model["merges"])
        self.tokens = {i: t for t, i in [*self.vocab.items(), *self.added.items()]}
        self.cache = RecentCache(self._chunk, most)

    def _merges(self, merges: list) -> None:
        """Takes what it needs of the file's merges, the first of the lowest rank."""

    def word(self, word: str) -> list[int]:
        """Ids of one word, written in the byte alphabet."""
        raise NotImplementedError

    def _chunk(self, chunk: str) -> bytes:
        ids: list[int] = []
        for w in self.word_re.findall(chunk):
            if not w.isascii() or not w.isprintable():
                w = "".join([self.bytes[b] for b in w.encode("utf-8", "surrogatepass")])
            ids += self.word(w)
        return np.array(ids, "<u4").tobytes()

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # letter by letter, as the vocabulary's lower-casing is: str.lower() treats a final capital sigma apart
        text = text.lower() if "Σ" not in text else "".join([c.lower() for c in text])
        # no word holds a blank, so blanks may cut first
        chunks = text.split() if not _ODD_BLANKS.search(text) else regex.split(r"\s+", _ODD_BLANKS.sub(" \\g<0> ", text))
        cache = self.cache
        return b"".join([cache[c] for c in chunks])

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers; null is the empty text."""
        if not text:
            return b""
        if "<|" not in text:
            return self._plain(text)
        parts, at = [], 0
        for m in self.added_re.finditer(text):
            parts += [self._plain(text[at : m.start()]), np.array([self.added[m[0]]], "<u4").tobytes()]
            at = m.end()
        return b"".join([*parts, self._plain(text[at:])])

    def decode(self, ids) -> str:
        """The vocabulary names no decoder, so tokens are joined by one space, as the library does."""
        return " ".join([self.tokens[i] for i in ids])


class SegmentTreeBpe(WordBpe):
    """Merges by a segment tree over the ranks of adjacent pairs."""

    def __init__(self, path: str, most: int = 400_000):
        super().__init__(path, most)

    def _merges(self, merges: list) -> None:
        ids = self.vocab
        pairs = (x if isinstance(x, list) else x.split(" ") for x in merges)
        self.rank = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}

    def word(self, word: str) -> list[int]:
        if not word:
            return []
        vocab = self.vocab
        ids = [vocab[c] for c in word[:-1] if c in vocab]
        last = word[-1] + self.suffix
        if last in vocab:
            ids.append(vocab[last])
        n = len(ids)
        if n < 2:
            return ids
        rank = self.rank

        def key(a: int, b: int, place: int) -> int:
            found = rank.get((a, b))
            return _UNRANKED if found is None else found[0] << 32 | place

        tree = SegmentTree([key(ids[i], ids[i + 1], i) for i in range(n - 1)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (least := tree.root()) < _UNRANKED:
            i = least & 0xFFFFFFFF
            j = after[i]
            ids[i] = rank[ids[i], ids[j]][1]
            ids[j] = -1
            k = after[i] = after[j]
            if j < n - 1:
                tree.set(j, _UNRANKED)
            if k < n:
                before[k] = i
                tree.set(i, key(ids[i], ids[k], i))
            else:
                tree.set(i, _UNRANKED)
            if (h := before[i]) >= 0:
                tree.set(h, key(ids[h], ids[i], h))
        return [i for i in ids if i >= 0]


class LibraryBpe(WordBpe):
    """Merges by the tokenizers library."""

    def __init__(self, path: str, most: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__(path, most)
        self.model = Tokenizer.from_file(path).model

    def word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word)]


@lru_cache(maxsize=2)
def segment_tree_bpe(path: str) -> SegmentTreeBpe:
    """One for each Python worker, so that its cache outlives a task."""
    return SegmentTreeBpe(path)


@lru_cache(maxsize=2)
def library_bpe(path: str) -> LibraryBpe:
    return LibraryBpe(path)

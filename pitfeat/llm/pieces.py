"""Ids of whole texts by public tokenizers, with a bounded cache of words.

A byte-level vocabulary of the tokenizers library parts a text by a fixed pattern
before it merges; on plain characters (ASCII and Latin-1 letters) ``re``
reproduces that pattern, so a word met before takes its ids from the cache and a new
one goes through the vocabulary's model. A sentence-piece vocabulary without a
piece that holds a space inside never merges across a lone space, so its words
are what stands between spaces. A chunk with anything else (other characters, special
tokens, two spaces in a row) goes through the tokenizer as it is. ``tests/llm``
hold the ids against the tokenizers' own on whole texts.

Memory: a task holds one chunk of about CHUNK characters (more only where a text
has no lone space so long) and caches of at most HELD bytes, which then start anew.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain, islice
from typing import Iterator, Sequence

import numpy as np

CHUNK = 1 << 20
#: Bytes of cached words and ids in one cache; some three times as much memory.
HELD = 24 << 20
CUT = re.compile(r"(?<=\S) (?=\S)")


def vocabulary(name: str) -> str:
    """The file of a public vocabulary, by name, or a path as it is."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: printable ones stand for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def chunks(text: str, size: int = CHUNK) -> list[str]:
    """Parts of about ``size`` characters; each but the first begins with the lone space it was cut at."""
    out, at = [], 0
    while len(text) - at > size:
        cut = CUT.search(text, at + size)
        if cut is None:
            break
        out.append(text[at:cut.start()])
        at = cut.start()
    return [*out, text[at:]]


class Rows:
    """Growing rows of unsigned integers, laid end to end."""

    def __init__(self):
        self.flat, self.n = np.empty(1 << 16, np.uint32), 0
        self.begin, self.length, self.rows = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def append(self, ids: list[int], lengths: list[int]) -> None:
        new, lengths = np.array(ids, np.uint32), np.array(lengths, np.int64)
        rows = len(lengths)
        for a, used, more in (("flat", self.n, len(new)), ("begin", self.rows, rows), ("length", self.rows, rows)):
            old = getattr(self, a)
            if used + more > len(old):
                grown = np.empty(max(2 * len(old), used + more), old.dtype)
                grown[:used] = old[:used]
                setattr(self, a, grown)
        self.flat[self.n:self.n + len(new)] = new
        self.length[self.rows:self.rows + rows] = lengths
        self.begin[self.rows:self.rows + rows] = self.n + np.cumsum(lengths) - lengths
        self.n, self.rows = self.n + len(new), self.rows + rows

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows ``at`` laid end to end, and their lengths."""
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        where = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[at] - ends + lengths, lengths)
        return self.flat[where], lengths


class Numbers(dict):
    """Numbers words in the order they are first met."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


class Cached:
    """Ids of texts: words from the cache where a chunk can be split, else the whole chunk."""

    #: Ids' bytes, for joining tokens back to text; none where a vocabulary changes the text.
    bytes: Sequence[bytes] = ()

    def __init__(self):
        self._reset()

    def _reset(self) -> None:
        self.numbers, self.rows, self.held = Numbers(), Rows(), 0
        self.unlike: set[int] = set()  # words whose ids' bytes differ from them

    def same(self, ids: Sequence[int], text: str) -> bool:
        """Whether the ids' bytes give the text back."""
        return b"".join(map(self.bytes.__getitem__, ids)) == text.encode()

    def spelled(self, word: str) -> str:
        """The text that a word of ``split`` stands for."""
        return word

    def exact(self, text: str) -> list[int]:
        raise NotImplementedError

    def split(self, chunk: str) -> list[str] | None:
        raise NotImplementedError

    def learn(self, words: list[str]) -> Iterator[list[int]]:
        raise NotImplementedError

    def __call__(self, texts: Sequence[str]) -> list[np.ndarray]:
        return [ids for ids, _ in self.encode(texts)]

    def encode(self, texts: Sequence[str], check: bool = False) -> list[tuple[np.ndarray, bool]]:
        """Each text's ids and, if asked, whether their bytes give the text back (looked at once a word)."""
        of, parts = [], []
        for i, text in enumerate(texts):
            for part in chunks(text):
                of.append(i)
                parts.append(part)
        out: list[list[np.ndarray]] = [[] for _ in texts]
        alike = [True] * len(texts)
        for a in range(0, len(parts), 64):
            for i, (ids, same) in zip(of[a:a + 64], self._chunks(parts[a:a + 64], check), strict=True):
                out[i].append(ids)
                alike[i] &= same
        return [(x[0] if len(x) == 1 else np.concatenate(x), same) for x, same in zip(out, alike, strict=True)]

    def _chunks(self, parts: list[str], check: bool) -> list[tuple[np.ndarray, bool]]:
        if self.held > HELD:
            self._reset()
        split = [self.split(p) for p in parts]
        met, n = len(self.numbers), [len(s or ()) for s in split]
        at = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(s or () for s in split)), np.int64, sum(n))
        if len(self.numbers) > met:
            new = list(islice(reversed(self.numbers), len(self.numbers) - met))[::-1]
            flat, lengths, own = [], [], self.bytes
            for n_word, (word, ids) in enumerate(zip(new, self.learn(new), strict=True), met):
                flat += ids
                lengths.append(len(ids))
                if check and b"".join([own[i] for i in ids]) != self.spelled(word).encode():
                    self.unlike.add(n_word)
            self.rows.append(flat, lengths)
            self.held += sum(map(len, new)) + 4 * len(flat) + 16 * len(new)
        ids, lengths = self.rows.take(at)
        words = np.concatenate([[0], np.cumsum(n)])
        ends = np.concatenate([[0], np.cumsum(lengths)])[words]
        odd = np.isin(at, list(self.unlike)) if self.unlike else np.zeros(0, bool)
        out = []
        for i, (part, found) in enumerate(zip(parts, split, strict=True)):
            if found is None:
                own = self.exact(part)
                out.append((np.array(own, np.uint32), not check or self.same(own, part)))
            else:
                out.append((ids[ends[i]:ends[i + 1]], not (self.unlike and odd[words[i]:words[i + 1]].any())))
        return out


class ByteLevel(Cached):
    """A byte-level vocabulary of the tokenizers library. ``plain``: special tokens' strings are ordinary text."""

    ODD = re.compile("[^\t\n\r\x20-~À-ÖØ-öø-ÿ]")
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ÿ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ÿ]+|\s+(?!\S)|\s+")

    def __init__(self, name: str, plain: bool = False):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(vocabulary(name), encoding="utf-8") as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        how = spec["pre_tokenizer"]
        self.words = spec["normalizer"] is None and how["type"] == "ByteLevel" and how["use_regex"] and not how["add_prefix_space"]
        self.whole = Tokenizer.from_file(vocabulary(name))
        self.whole.encode_special_tokens = plain
        self.special = [] if plain else added
        letters = _byte_letters()
        byte = {c: b for b, c in letters.items()}
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = token.encode() if token in added else bytes(byte[c] for c in token)
        self.letters = {b: c for b, c in letters.items() if chr(b) != c}
        self.space = letters[32]

    def exact(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def split(self, chunk: str) -> list[str] | None:
        if not self.words or self.ODD.search(chunk) or any(s in chunk for s in self.special):
            return None
        return self.WORD.findall(chunk)

    def learn(self, words: list[str]) -> Iterator[list[int]]:
        tokenize = self.whole.model.tokenize
        for w in words:
            if w.isascii() and w.isprintable():
                w = w.replace(" ", self.space)
            else:
                w = w.encode().decode("latin-1").translate(self.letters)
            yield [t.id for t in tokenize(w)]


class LowerWords(Cached):
    """A vocabulary of the tokenizers library with word ends, which lowers case and drops white space."""

    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")

    def __init__(self, name: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(vocabulary(name))
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.letters = {b: c for b, c in _byte_letters().items() if chr(b) != c}

    def exact(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def split(self, chunk: str) -> list[str] | None:
        if ByteLevel.ODD.search(chunk) or any(s in chunk for s in self.special):
            return None
        return self.WORD.findall(chunk.lower())

    def learn(self, words: list[str]) -> Iterator[list[int]]:
        tokenize = self.whole.model.tokenize
        for w in words:
            yield [t.id for t in tokenize(w if w.isascii() else w.encode().decode("latin-1").translate(self.letters))]


class SentencePiece(Cached):
    """A sentence-piece vocabulary, which puts a space before every text; texts come with that space."""

    def __init__(self, name: str):
        super().__init__()
        from sentencepiece import SentencePieceProcessor

        self.whole = SentencePieceProcessor(model_file=vocabulary(name))
        names = [self.whole.id_to_piece(i) for i in range(self.whole.get_piece_size())]
        self.words = not any(re.search("[^▁]▁", x) for x in names)
        self.bytes = [bytes([int(x[3:5], 16)]) if self.whole.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)]

    def exact(self, text: str) -> list[int]:
        return self.whole.encode(text[1:], num_threads=1)

    def spelled(self, word: str) -> str:
        return " " + word

    def split(self, chunk: str) -> list[str] | None:
        return chunk[1:].split(" ") if self.words and "  " not in chunk and chunk[-1] != " " else None

    def learn(self, words: list[str]) -> Iterator[list[int]]:
        for i in range(0, len(words), 1000):
            yield from self.whole.encode(words[i:i + 1000], num_threads=1)

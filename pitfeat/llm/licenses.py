"""License scans: fuzzy search for short license notices.

A notice may occur with up to k edits (insertions, deletions, substitutions of
characters). Cut into k + 1 pieces, at least one piece then occurs unchanged, so
one automaton over all pieces finds every place worth looking at. There the
``regex`` library's bounded-error matching verifies the edits and gives the
span. A find must name the license: of the words that tell licenses apart, those
of up to three letters stand exactly and longer ones with an edit per three letters,
and no other version number stands in the version's place. Of overlapping finds
the one with the fewest edits stays (then the longer).

Texts are compared as their words, A-Z lower-cased, parted by one space; a word
is a run of ASCII letters, digits and any non-ASCII characters.

Scale: one narrow pass without a shuffle; a task holds one Arrow batch of texts.

Defined results: null and empty texts have no words, no labels (empty strings)
and score 0; repeated rows are scanned each; an empty table yields no rows;
extra columns are ignored; very long texts are searched to their end.
"""

from __future__ import annotations

import bisect
from typing import Iterator, Sequence

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rows_batch

#: Phrase and label of the base scan.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Public license notices in words, label and the edits allowed.
NOTICES = (
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", 6),
    ("licensed under the apache license version 2 0", "apache-2.0", 3),
    ("licensed under the gnu general public license version 3", "gpl-3.0", 4),
    ("licensed under the gnu general public license version 2", "gpl-2.0", 4),
    ("licensed under the gnu lesser general public license", "lgpl", 4),
    ("licensed under cc by 4 0", "cc-by-4.0", 2),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0", 2),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", 2),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa-4.0", 2),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 6),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", 6),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 5),
    ("this is free and unencumbered software released into the public domain", "unlicense", 5),
)

#: Words of notices that tell one license from another.
NAMES = frozenset(("mit", "apache", "general", "lesser", "by", "sa", "nc", "mozilla"))

#: Maps ASCII bytes outside letters and digits to a space, A-Z to a-z.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

MATCH = pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                    ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                    ("matches", pa.list_(MATCH))])
DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
       "score double, matches array<struct<label:string,start:long,end:long,edits:long>>")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(WORD_BYTES).split()


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """(offset, piece) of edits + 1 pieces of near-equal length."""
    at = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(at, at[1:], strict=False)]


class Scanner:
    def __init__(self, phrases: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str, int]]):
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases]
        self.notices = [(n, label, k, regex.compile(f"(?e)(?:{regex.escape(n)}){{e<={k}}}")) for n, label, k in notices]
        self.names = [[regex.compile(f"(?<= ){w}(?= )" if len(w) <= 3 else f"(?:{w}){{e<={len(w) // 3}}}") for w in n.split() if w in NAMES]
                      for n, *_ in self.notices]
        self.numbers = [[w for w in n.split() if w.isdecimal()] for n, *_ in self.notices]
        by_piece: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, k, _) in enumerate(self.notices):
            for offset, piece in pieces(n, k):
                by_piece.setdefault(piece, []).append((i, offset))
        self.seeds = ahocorasick.Automaton()
        for piece, where in by_piece.items():
            self.seeds.add_word(piece, (len(piece), where))
        self.seeds.make_automaton()

    def base(self, line: bytes) -> list[tuple[int, str]]:
        """(first word, label) of every place where a phrase's words stand."""
        out = []
        for phrase, label in self.phrases:
            at, word, was = line.find(phrase), 0, 0
            while at >= 0:
                word += line.count(b" ", was, at)
                was = at
                out.append((word, label))
                at = line.find(phrase, at + 1)
        return out

    def names_it(self, line: str, a: int, b: int, i: int) -> bool:
        """Whether the words of ``line`` that a find of notice i touches have its naming words and no other version."""
        inner = line[a:b]
        first, last = a + len(inner) - len(inner.lstrip(" ")), a + len(inner.rstrip(" "))
        text = line[line.rfind(" ", 0, first + 1):line.find(" ", last) + 1]
        numbers = self.numbers[i]
        rest = iter(numbers)
        found = regex.findall(r"(?<= )[0-9]+(?= )|[0-9]+(?= $)", text)[-len(numbers):] if numbers else []
        return all(w in rest for w in found) and all(p.search(text) for p in self.names[i])

    def fuzzy(self, line: str, named: bool = False) -> list[tuple[int, int, int, int]]:
        """(edits, start, end, notice) in characters of ``line``, overlaps resolved; of those that name the license if asked for."""
        regions: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.seeds.iter(line):
            for i, offset in where:
                n, _, k, _ = self.notices[i]
                a = max(0, end + 1 - length - offset - k)
                b = min(len(line), a + len(n) + 2 * k + 1)
                spans = regions.setdefault(i, [])
                if spans and a <= spans[-1][1]:
                    spans[-1] = [min(a, spans[-1][0]), max(b, spans[-1][1])]
                else:
                    spans.append([a, b])
        found = [(sum(m.fuzzy_counts), m.start(), m.end(), i) for i, spans in regions.items()
                 for a, b in spans for m in self.notices[i][3].finditer(line, a, b)
                 if not named or self.names_it(line, m.start(), m.end(), i)]
        kept: list[tuple[int, int, int, int]] = []  # by start, none overlapping
        for f in sorted(found, key=lambda f: (f[0], f[1] - f[2], f[1], f[3])):
            at = bisect.bisect(kept, f[1], key=lambda g: g[1])
            if (at == 0 or kept[at - 1][2] <= f[1]) and (at == len(kept) or f[2] <= kept[at][1]):
                kept.insert(at, f)
        return kept

    def __call__(self, text: str | None) -> tuple:
        words = words_of(text)
        line = b" " + b" ".join(words) + b" "
        base = self.base(line)
        plain = line.decode()
        matches = []
        for edits, a, b, i in self.fuzzy(plain, named=True):
            inner = plain[a:b]
            first = a + len(inner) - len(inner.lstrip(" "))
            last = a + len(inner.rstrip(" ")) - 1
            matches.append({"label": self.notices[i][1], "start": plain.count(" ", 0, first) - 1,
                            "end": plain.count(" ", 0, last) - 1, "edits": edits, "score": 1 - edits / (self.notices[i][2] + 1)})
        places = [w for w, _ in base]
        labels = {label for _, label in base}
        score = max([1.0] * bool(base) + [m.pop("score") for m in matches], default=0.0)
        return (len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
                ",".join(sorted(labels | {m["label"] for m in matches})), score, matches)


def _tasks(phrases, notices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(phrases, notices)
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                some = batch.slice(i, 500)
                yield rows_batch([(d, *scan(t)) for d, t in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist(), strict=True)], SCHEMA)
    return run


def scan_licenses(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES,
                  notices: Sequence[tuple[str, str, int]] = NOTICES) -> DataFrame:
    """Base places and labels, all labels, score and ``matches`` (label, first and last word, edits)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_tasks(tuple(phrases), tuple(notices)), DDL)

"""License notices by exact phrases and by bounded-error search.

A text becomes its words, lower-cased and joined by single blanks. A notice with at most e edits contains, in
one place at least, one of its e + 1 pieces unchanged (pigeonhole): one automaton finds the pieces of all notices,
and around each, with room for edits of four bytes a letter, the regex library's fuzzy matching verifies the edits and gives
the span. Base phrases are found word by word and always stay.

Some words tell licenses apart (``mit`` from ``isc``, ``nc`` from ``nd``, version numbers), and a single edit may turn one into
another. They are marked in the notices and must stand in the span unchanged, as whole words (letters that look like others,
as ``l`` like ``i``, count as these). Of notices that share a place the nearest is taken: a notice inside a longer one is left out, of
others the one with the fewest edits for its length stays, and differing labels at equal distance cancel out unless they are exact.

Edge cases: a null or empty text has no words; repeated rows are scanned each; an empty table gives an
empty table; other columns are ignored. Spans are code points of the original text, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from chatmeter.llm.tables import slices

# The base phrases.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Short notices, in words, that are searched with edits; a star marks a word that must be unchanged.
NOTICES = {
    "under the *mit license": "mit",
    "permission is hereby granted free of charge": "mit",
    "apache license version *2": "apache-2",
    "apache license version *1": "apache-1",
    "licensed under *cc *by *nc": "cc-by-nc",
    "licensed under *cc *by *nd": "cc-by-nd",
    "licensed under *cc *by *sa": "cc-by-sa",
    "licensed under *cc *by *nc *sa": "cc-by-nc-sa",
    "licensed under *cc *by *nc *nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "gnu general public license": "gpl",
    "gnu general public license version *2": "gpl-2",
    "gnu general public license version *3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu lesser general public license version *2 *1": "lgpl-2.1",
    "gnu lesser general public license version *3": "lgpl-3",
    "gnu affero general public license": "agpl",
    "gnu affero general public license version *3": "agpl-3",
    "mozilla public license": "mpl",
    "mozilla public license version *1": "mpl-1",
    "mozilla public license version *2": "mpl-2",
    "eclipse public license": "epl",
    "boost software license": "boost",
    "under the *bsd license": "bsd",
    "*bsd *2 clause license": "bsd-2",
    "*2 clause *bsd license": "bsd-2",
    "*bsd *3 clause license": "bsd-3",
    "*3 clause *bsd license": "bsd-3",
    "redistribution and use in source and binary forms": "bsd",
    "used to endorse or promote products derived from this software": "bsd-3",
    "under the *isc license": "isc",
    "permission to use copy modify and or distribute this software": "isc",
    "under the *sil license": "ofl",
    "under the *sil open font license": "ofl",
    "under the *zlib license": "zlib",
    "in no event will the authors be held liable for any damages": "zlib",
    "free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
LETTERS_AN_EDIT = 10  # a notice may have one edit for so many letters

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_KEPT = b"".join(bytes([b | 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32]) for b in range(256))
_LOOKS = str.maketrans("l105", "iios")


@dataclass(frozen=True)
class Notice:
    text: str
    label: str
    telling: tuple[str, ...]
    edits: int


def _notices() -> list[Notice]:
    out = []
    for marked, label in NOTICES.items():
        text = marked.replace("*", "")
        telling = tuple(w[1:].translate(_LOOKS) for w in marked.split() if w.startswith("*"))
        out.append(Notice(text, label, telling, len(text) // LETTERS_AN_EDIT))
    return out


ALL = _notices()


@cache
def _seeds():
    """(automaton of the pieces of all notices, verifiers). A piece gives the notices it is of, and its places in them."""
    import ahocorasick

    pieces: dict[str, list[tuple[int, int]]] = {}
    for k, n in enumerate(ALL):
        cuts = [round(i * len(n.text) / (n.edits + 1)) for i in range(n.edits + 2)]
        for a, b in zip(cuts, cuts[1:]):
            pieces.setdefault(n.text[a:b], []).append((k, a))
    automaton = ahocorasick.Automaton()
    for piece, of in pieces.items():
        automaton.add_word(piece, (len(piece), of))
    automaton.make_automaton()
    return automaton, [regex.compile(rf"(?b)(?:{regex.escape(n.text)}){{e<={n.edits}}}") for n in ALL]


def _places(line: bytes, part: bytes) -> list[int]:
    out, at = [], line.find(part)
    while at >= 0:
        out.append(at)
        at = line.find(part, at + 1)
    return out


def _tells(line: bytes, start: int, end: int, notice: Notice) -> bool:
    """Whether the telling words of a notice stand in the span, in order, as the line's own words."""
    if not notice.telling:
        return True
    start = line.rfind(b" ", 0, start + (line[start : start + 1] != b" ")) + 1
    end = line.find(b" ", max(start, end - (line[end - 1 : end] == b" ")))
    words = line[start : end if end >= 0 else len(line)].decode().translate(_LOOKS).split()
    for word in notice.telling:
        if word not in words:
            return False
        words = words[words.index(word) + 1 :]
    return True


def fuzzy(line: bytes) -> list[tuple[int, int, str, int, int]]:
    """(start, end, label, edits, letters) of notices in a line of words, in bytes, the nearest of each place."""
    return _nearest(sorted({(a, b, ALL[k].label, e, len(ALL[k].text)) for a, b, k, e in within(line) if _tells(line, a, b, ALL[k])}))


def within(line: bytes) -> list[tuple[int, int, int, int]]:
    """(start, end, place in ``ALL``, edits) of all notices within their edits."""
    automaton, verify = _seeds()
    windows: dict[int, list[tuple[int, int]]] = {}
    for last, (size, of) in automaton.iter(line.decode("latin-1")):  # a byte a letter; pieces are plain letters
        at = last + 1 - size
        for k, before in of:
            room = 4 * ALL[k].edits  # an edit is a letter, which takes four bytes at most
            windows.setdefault(k, []).append((max(0, at - before - room), at - before + len(ALL[k].text) + room))
    found = []
    for k, places in windows.items():
        done = -1
        for start, end in sorted(places):
            if end <= done:  # inside what is verified already
                continue
            while start and line[start] & 0xC0 == 0x80:
                start -= 1
            while end < len(line) and line[end] & 0xC0 == 0x80:
                end += 1
            window = line[start:end].decode()
            if m := verify[k].search(window):
                a = start + len(window[: m.start()].encode())
                b = start + len(window[: m.end()].encode())
                found.append((a, b, k, sum(m.fuzzy_counts)))
                done = b
    return found


def _nearest(found: list[tuple[int, int, str, int, int]]) -> list[tuple[int, int, str, int, int]]:
    """Of notices that share a place the nearest."""
    out = []
    for x in found:
        a, b, label, edits, letters = x
        keep = True
        for c, d, other, more, size in found:
            if c < b and a < d and other != label:
                inside = a >= c and b <= d and size > letters
                around = c >= a and d <= b and size < letters
                nearer = (more / size, -size) < (edits / letters, -letters)
                equal = edits > 0 and more / size == edits / letters and size == letters
                keep = keep and not inside and (around or not (nearer or equal))
        if keep:
            out.append(x)
    return out


def scan(text: str | None) -> dict:
    """All that is said of a text; see the columns of ``SCHEMA``."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_KEPT).split()
    line = b" ".join(words)
    padded, base = b" %b " % line, []
    for phrase, label in BASE.items():
        base += [(padded.count(b" ", 0, at), label, len(phrase.split())) for at in _places(padded, b" %b " % phrase.encode())]
    near = fuzzy(line)
    out = {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": min((w for w, _, _ in base), default=None),
        "last_word": max((w for w, _, _ in base), default=None),
        "base_labels": sorted({x for _, x, _ in base}),
        "labels": sorted({x for _, x, _ in base} | {x[2] for x in near}),
        "score": 1.0 if base else max((1 - x[3] / x[4] for x in near), default=0.0),
        "spans": [],
    }
    if base or near:
        at = [m.span() for m in WORD.finditer(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))]
        spans = {(at[w][0], at[w + n - 1][1], label, 0) for w, label, n in base}
        for a, b, label, edits, _ in near:
            first = line.count(b" ", 0, a + (line[a : a + 1] == b" "))
            last = line.count(b" ", 0, b - (line[b - 1 : b] == b" "))
            spans.add((at[first][0], at[max(first, last)][1], label, edits))
        out["spans"] = [{"start": a, "end": b, "label": x, "edits": e} for a, b, x, e in sorted(spans)]
    return out


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, "
    "score double, spans array<struct<start:int,end:int,label:string,edits:int>>"
)
_TYPES = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.list_(pa.string()),
    "labels": pa.list_(pa.string()),
    "score": pa.float64(),
    "spans": pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string()), ("edits", pa.int32())])),
}


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (none of the names in ``SCHEMA``) with what is said of each text."""
    source = docs.select(*[docs[c] for c in keep], docs["text"].cast("string").alias("_text"))
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            rows = [scan(x) for x in batch.column("_text").to_pylist()]
            columns = [pa.array([r[c] for r in rows], t) for c, t in _TYPES.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*keep, *_TYPES])

    return source.mapInArrow(run, f"{head}, {SCHEMA}")

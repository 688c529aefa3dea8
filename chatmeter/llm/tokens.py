"""Token ids of whole texts by a word tokenizer file, many texts at once.

White space ends every word of this kind of tokenizer, so a text's ids are its words' ids in a row. Each
distinct word is tokenized once and kept; batches are split and numbered by Arrow's kernels and
put together by numpy. The ids are those of tokenizing each text by itself (a test holds that).
"""

from __future__ import annotations

import os
import sys
import types
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_BYTES = 48 << 20  # that a worker remembers words with, about; then it starts anew

# A worker's memory of words outlives the task that fills it.
_KEPT = sys.modules.setdefault("chatmeter_kept_words", types.ModuleType("chatmeter_kept_words")).__dict__


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Words:
    """A tokenizer file with what this worker has tokenized by it so far."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; read when the library is loaded
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        # A word of letters is one unit of the tokenizer, so many can go in one line and be told apart.
        plain = [w for w in words if w.isalpha()]
        other = [w for w in words if not w.isalpha()]
        lines = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        for at in range(0, len(lines), 64):
            some = lines[at : at + 64]
            for line, found in zip(some, self.tokenizer.encode_batch_fast([" ".join(x) for x in some], add_special_tokens=False)):
                ids = np.array(found.ids, "<u4")
                cuts = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
                if len(cuts) != len(line):
                    other += line
                    continue
                raw = ids.tobytes()
                self.known.update((w, raw[i:j]) for w, i, j in zip(line, [0, *cuts], cuts))
                self.held += len(raw)
        for at in range(0, len(other), 1024):
            some = other[at : at + 1024]
            for w, found in zip(some, self.tokenizer.encode_batch_fast(some, add_special_tokens=False)):
                self.known[w] = array("I", found.ids).tobytes()  # four bytes an id, low ones first
                self.held += len(self.known[w])
        # Two objects and a place in the dictionary; a letter takes one byte here, or two to four.
        self.held += 190 * len(words) + 2 * sum(map(len, words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in a row, how many each text has). A null text has none."""
        # A copy without an offset: ascii_lower() reads slices of arrays wrongly.
        low = pc.ascii_lower(pa.array([x or "" for x in texts.to_pylist()], pa.large_string()))
        # A full stop or comma after a letter or digit is a unit of its own; cutting it off makes words recur.
        odd = pc.match_substring_regex(low, r"[^\pL\pN\s][.,]\s|\x{0130}")
        cut = low
        for mark in (", ", ". ", ",\n", ".\n"):
            cut = pc.replace_substring(cut, mark, f" {mark}")
        split = pc.ascii_split_whitespace(pc.if_else(odd, low, cut))
        if isinstance(split, pa.ChunkedArray):
            split = split.combine_chunks()
        ends = split.offsets.to_numpy()
        coded = split.flatten().dictionary_encode()
        words, which = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if self.held > WORD_BYTES:
            self._forget()
        self._learn([w for w in words if w not in self.known])
        parts = [self.known[w] for w in words]
        ids = np.frombuffer(b"".join(parts), "<u4")
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        starts = np.cumsum(sizes) - sizes
        n = sizes[which]
        before = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(before[-1]) + np.repeat(starts[which] - before[:-1], n)
        return ids[at], np.diff(before[ends - ends[0]])


def words(path: str) -> Words:
    if path not in _KEPT:
        _KEPT[path] = Words(path)
    return _KEPT[path]


def forget() -> None:
    """Gives the memory of words back, for steps of a job that tokenize no more."""
    for name in [k for k, v in _KEPT.items() if hasattr(v, "known")]:
        del _KEPT[name]

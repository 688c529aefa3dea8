"""Alignment of the tokens of two tokenizers over the same bytes, as an Arrow pipeline.

Tokenizer A (byte-level BPE) encodes a space and the text; tokenizer B (sentence pieces) encodes the text and
adds that space itself. So both cover the same bytes, and a token lies between two byte offsets. Texts
are split into words, each distinct word is encoded once by both, and lists of ids are taken for the words and
flattened, with parent indices that lead back to word and document. Cumulative sums of the tokens' bytes, counted on from the
document's first byte in the slice, give the offset where each token ends: a key of document and end. A full hash join of both
sides on it puts all ends in one table: an end of both closes a group, and the bytes up to an end from the one
before belong to one token of A and one of B, which is one link. ``group_by`` counts the links of a slice.

A slice of documents is written as one blob of its documents and links, and as a row for each distinct pair of ids with its
count there. Spark sums these partial counts, finds the highest count of each id of B, and brings the sums back to the
slices, whose links are weighed by them. So what is exchanged are distinct pairs of slices, not links, and a
frequent pair counts once a slice.

Words are cut at a space between two characters that are no white space. No token of A crosses such a
place, as its rule of words takes a space only in front, and none of B, as no piece holds a space after
another character (checked for the file given). So ids equal those of whole texts; a test holds that.

Edge cases: a null or empty text, or one whose tokens' bytes differ from a space and the text, has no tokens: all
counts zero and an empty digest. Repeated rows are each counted; null doc_ids stay; other columns
are ignored; an empty table gives an empty table. A document is never cut: a slice holds one at least, and its memory grows with the
longest text.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved, slices

SLICE = 1 << 20  # bytes of text that are aligned together, one document at least
WORD_BYTES = 80 << 20  # that a worker remembers words with, about
LINE = 256  # words that are encoded together
PARTS = "slice long, place int, a int, b int, n long, blob binary"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
PAIR = np.int64(1) << 32

# A space within a word, the sign that B writes it with, and white space at an end, which could meet that of a neighbour.
_SPACED = re.compile(r"[ \u2581]|^\s|\s$")
_CUT = re.compile(r"(?<=\S) (?=\S)")
# White space beside white space, or at an end; Python's own notion of it is the widest one here.
_ODD = r"^[\s\pZ\x0b\x1c-\x1f\x{85}]|[\s\pZ\x0b\x1c-\x1f\x{85}]$|[\s\pZ\x0b\x1c-\x1f\x{85}]{2}"

# A worker's memory of words outlives the task that fills it.
_KEPT = sys.modules.setdefault("chatmeter_kept_pairs", types.ModuleType("chatmeter_kept_pairs")).__dict__


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and number the others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Both:
    """The two tokenizers with what this worker has encoded by them."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        # A task has one core. This is read when the library is loaded.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pa.set_cpu_count(1)
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocabulary, byte = self.a.get_vocab(), _byte_of_sign()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for sign, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte[c] for c in sign) if all(c in byte for c in sign) else sign.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError(f"{path_b} has pieces over several words, so words can't be encoded by themselves")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.size_a = pa.array([len(x) for x in self.bytes_a], pa.int64())
        self.size_b = pa.array([len(x) for x in self.bytes_b], pa.int64())
        self.begins_a = np.array([x.startswith(b" ") for x in self.bytes_a])
        self.begins_b = np.array([x.startswith(b" ") for x in self.bytes_b])
        self.known: dict[str, tuple[bytes, bytes, bool]] = {}
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        # Many words go in one line where each token that begins with a space begins a word.
        other = list(filter(_SPACED.search, words))
        plain = list(itertools.filterfalse(_SPACED.search, words)) if other else words
        for at in range(0, len(plain), LINE * 64):
            lines = [plain[i : i + LINE] for i in range(at, min(at + LINE * 64, len(plain)), LINE)]
            joined = [" ".join(line) for line in lines]
            of_a = self.a.encode_batch_fast([" " + x for x in joined], add_special_tokens=False)
            for line, text, x, y in zip(lines, joined, of_a, self.b.encode(joined, num_threads=1)):
                x, y = np.array(x.ids, "<i4"), np.array(y, "<i4")
                cuts_a, cuts_b = np.flatnonzero(self.begins_a[x]), np.flatnonzero(self.begins_b[y])
                if not (len(cuts_a) == len(cuts_b) == len(line) and self._same(text, x.tolist(), y.tolist())):
                    other += line
                    continue
                cuts = zip(*((4 * np.append(c, len(ids))).tolist() for c, ids in ((cuts_a, x), (cuts_b, y))))
                raw_a, raw_b = x.tobytes(), y.tobytes()
                i, j = next(cuts)
                for word, (k, m) in zip(line, cuts):
                    self.known[word] = (raw_a[i:k], raw_b[j:m], True)
                    i, j = k, m
                self.held += len(text) + len(raw_a) + len(raw_b) + 250 * len(line)
        for word in other:
            x, y = self.a.encode(" " + word, add_special_tokens=False).ids, self.b.encode(word)
            self.known[word] = (np.array(x, "<i4").tobytes(), np.array(y, "<i4").tobytes(), self._same(word, x, y))
            self.held += len(word) + 4 * (len(x) + len(y)) + 250

    def _same(self, text: str, x: list[int], y: list[int]) -> bool:
        """Whether the tokens of both are the bytes of a space and the text."""
        return b"".join(map(self.bytes_a.__getitem__, x)) == b" " + text.encode() == b"".join(map(self.bytes_b.__getitem__, y))

    def encode(self, words: list[str]) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """The ids of A and of B for each word and the space before it, and whether both give its bytes."""
        if self.held > WORD_BYTES:
            self.known, self.held = {}, 0
        self._learn([w for w in words if w not in self.known])
        found = [self.known[w] for w in words]
        return _lists([x for x, _, _ in found]), _lists([y for _, y, _ in found]), np.array([ok for _, _, ok in found], bool)


def _lists(parts: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def _both(path_a: str, path_b: str) -> Both:
    if (path_a, path_b) not in _KEPT.setdefault("both", {}):
        _KEPT["both"] = {(path_a, path_b): Both(path_a, path_b)}
    return _KEPT["both"][path_a, path_b]


def _words(texts: pa.Array) -> pa.ListArray:
    """Each text cut at single spaces; texts with other white space nearby are cut one by one."""
    odd = pc.match_substring_regex(texts, _ODD)
    plain = pc.split_pattern(texts.filter(pc.invert(odd)), " ").cast(pa.list_(pa.string()))
    cut = [_CUT.split(x) for x in texts.filter(odd).to_pylist()]
    joined = pa.concat_arrays([plain, pa.array(cut, pa.list_(pa.string()))])
    odd = odd.to_numpy(zero_copy_only=False)
    place = np.empty(len(odd), np.int64)
    place[~odd], place[odd] = np.arange((~odd).sum()), (~odd).sum() + np.arange(odd.sum())
    return joined.take(pa.array(place))


def _tokens(lists: pa.ListArray, which: pa.Array, doc_of_word: pa.Array, size: pa.Array, name: str) -> pa.Table:
    """(end, row, doc, id) of one tokenizer's tokens, in order. An end is the document's first byte in the slice and the
    bytes of its tokens so far, so it is a key of document and end."""
    taken = lists.take(which)
    ids = pc.list_flatten(taken)
    doc = doc_of_word.take(pc.list_parent_indices(taken))
    end = pc.cumulative_sum(size.take(ids))
    return pa.table({"end": end, name: pa.array(np.arange(len(ids), dtype=np.int32)), "doc": doc, "id": ids})


def _digests(groups: pa.Table, doc_of_group: np.ndarray, docs: int) -> list[str]:
    """sha256 of ``a1,a2|b1;a3|b2,b3`` for each document; empty where it has no group."""
    text = pc.binary_join_element_wise(groups["a"], groups["b"], "|").combine_chunks()
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc_of_group, minlength=docs))))
    lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), text), ";")
    return [hashlib.sha256(x.as_buffer()).hexdigest() if n else "" for x, n in zip(lines, np.diff(ends))]


def _grouped(ids: pa.Array, cuts: np.ndarray) -> pa.Array:
    """The ids between neighbouring cuts, as comma-joined text."""
    ends = pa.array(np.concatenate(([0], cuts + 1)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(ends, ids.cast(pa.string())), ",")


def aligned(doc_ids: pa.Array, texts: pa.Array, both: Both) -> tuple[pa.Table, pa.Table, pa.Table]:
    """Of a slice of documents: (documents with their own columns of the result; links as doc, pair, n;
    distinct pairs as pair, a, b, n)."""
    number = len(texts)
    words = _words(texts.fill_null("").cast(pa.string()))
    coded = pc.list_flatten(words).dictionary_encode()
    ids_a, ids_b, same = both.encode(coded.dictionary.to_pylist())
    doc_of_word = pc.list_parent_indices(words).cast(pa.int64())
    which = coded.indices

    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    good = sizes > 0
    good[doc_of_word.to_numpy()[~same[which.to_numpy()]]] = False
    keep = pa.array(good[doc_of_word.to_numpy()])
    doc_of_word, which = doc_of_word.filter(keep), which.filter(keep)

    # Only whole documents of equal bytes are here, so the sums of both run along the same bytes, document by document.
    a = _tokens(ids_a, which, doc_of_word, both.size_a, "a")
    b = _tokens(ids_b, which, doc_of_word, both.size_b, "b")
    ends = a.select(["end", "a"]).join(b.select(["end", "b"]), "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    cut = pc.and_(pc.is_valid(ends["a"]), pc.is_valid(ends["b"]))
    # Bytes up to an end belong to the tokens that end there or next.
    row_a, row_b = pc.fill_null_backward(ends["a"]).combine_chunks(), pc.fill_null_backward(ends["b"]).combine_chunks()
    left, right = a["id"].combine_chunks().take(row_a), b["id"].combine_chunks().take(row_b)
    pair = pa.array(left.to_numpy().astype(np.int64) * PAIR + right.to_numpy()).dictionary_encode()
    doc_of_link = a["doc"].combine_chunks().take(row_a)
    links = pa.table({"doc": doc_of_link, "pair": pair.indices})

    pairs = links.group_by("pair", use_threads=False).aggregate([([], "count_all")])
    keys = pair.dictionary.to_numpy()[pairs["pair"].to_numpy()]
    pairs = pa.table({"pair": pairs["pair"], "a": pa.array(keys // PAIR, pa.int32()), "b": pa.array(keys % PAIR, pa.int32()), "n": pairs["count_all"]})

    cuts = ends.filter(cut)
    doc_of_group = doc_of_link.filter(cut.combine_chunks()).to_numpy()
    groups = pa.table(
        {
            "a": _grouped(a["id"].combine_chunks(), cuts["a"].to_numpy()),
            "b": _grouped(b["id"].combine_chunks(), cuts["b"].to_numpy()),
        }
    )

    def count(of: pa.Table | np.ndarray) -> np.ndarray:
        return np.bincount(of["doc"].to_numpy() if isinstance(of, pa.Table) else of, minlength=number)

    docs = pa.table(
        {
            "doc_id": doc_ids,
            "n_a": pa.array(count(a), pa.int64()),
            "n_b": pa.array(count(b), pa.int64()),
            "n_groups": pa.array(count(doc_of_group), pa.int64()),
            "n_links": pa.array(count(links), pa.int64()),
            "groups_sha256": pa.array(_digests(groups, doc_of_group, number), pa.string()),
        }
    )
    links = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["doc", "pair", "n"])
    return docs, links, pairs


def _packed(*tables: pa.Table) -> bytes:
    out = pa.BufferOutputStream()
    for table in tables:
        with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_table(table)
    return out.getvalue().to_pybytes()


def _unpacked(blob: bytes) -> tuple[pa.Table, pa.Table]:
    source = pa.BufferReader(blob)
    return pa.ipc.open_stream(source).read_all(), pa.ipc.open_stream(source).read_all()


def parts(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row with a blob for each slice of documents, and one for each distinct pair of ids in it."""
    names = [c.split()[0] for c in PARTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = _both(path_a, path_b)
        for batch in slices(batches, "text", SLICE):
            name = uuid.uuid4().int >> 65  # only what is committed counts, so a repeated task may name anew
            own, links, pairs = aligned(batch.column("doc_id"), batch.column("text"), both)
            columns = [pa.array(np.full(len(pairs), name)), pairs["pair"].cast(pa.int32()), pairs["a"], pairs["b"], pairs["n"]]
            columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
            yield pa.record_batch([*columns, pa.nulls(len(pairs), pa.binary())], names)
            none = [pa.nulls(1, t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64())]
            yield pa.record_batch([pa.array([name]), *none, pa.array([_packed(own, links)], pa.binary())], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PARTS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(a, b, total, best) of each pair of ids in ``parts``: its links in the corpus, and whether no other pair
    of the same id of B has more."""
    totals = rows.where("blob IS NULL").groupBy("a", "b").agg(F.sum("n").alias("total"))
    totals = saved(totals, "pair-counts")
    highest = totals.groupBy(F.col("b").alias("of")).agg(F.max("total").alias("highest"))
    best = (F.col("total") == F.col("highest")).alias("best")
    return totals.join(highest, F.col("b") == F.col("of")).select("a", "b", "total", best)


def _weighed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Documents of a slice: its blob, and the corpus counts of its pairs."""
    order = np.empty(len(right), np.int64)
    order[right["place"].to_numpy()] = np.arange(len(right))
    total, best = right["total"].to_numpy()[order], right["best"].to_numpy()[order]
    out = []
    for blob in left["blob"].to_pylist():
        docs, links = _unpacked(blob)
        pair, n = links["pair"].to_numpy(), links["n"].to_numpy()
        weighed = pa.table({"doc": links["doc"], "best": pa.array(n * best[pair]), "sum": pa.array(n * total[pair])})
        sums = weighed.group_by("doc", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
        n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
        n_best[sums["doc"].to_numpy()] = sums["best_sum"].to_numpy()
        count_sum[sums["doc"].to_numpy()] = sums["sum_sum"].to_numpy()
        columns = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        names = [c.split()[0] for c in RESULT.split(", ")]
        out.append(pa.table([*columns, pa.array(n_best), pa.array(count_sum), docs["groups_sha256"]], names))
    return pa.concat_tables(out).combine_chunks()


def cross_aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row for each document, with the columns of ``RESULT``."""
    rows = saved(parts(docs, path_a, path_b), "aligned")
    known = rows.where("blob IS NULL").join(pair_counts(rows), ["a", "b"]).select(F.col("slice").alias("of"), "place", "total", "best")
    blobs = rows.where("blob IS NOT NULL").select("slice", "blob")
    return blobs.groupBy("slice").cogroup(known.groupBy("of")).applyInArrow(_weighed, RESULT)

"""Toxicity by a learned lexicon, matched through Levenshtein automata, and context-window scores.

Learning. Distinct labelled texts, at most ``SAMPLE`` of each label in hash order, give document
counts of words and word beginnings. Entries of the lexicon are those that stand in toxic texts
and hardly ever in clean ones: whole words, or stems where many words share a telling beginning.

Matching. The trie of the lexicon and the Levenshtein automaton are walked together: a state is the set
of (trie node, edits so far) in reach of the letters read. States are made on first use, so a word
costs one table look-up per letter. Words match an entry exactly or with one edit.

Scoring. An entry's share of toxic texts, by edits, weighs a hit; a hit within quotation marks or beside
words of reporting weighs less, by what labelled texts show. Words that match with an edit are weighed
each by itself, since some are common words of their own. However often it is repeated, an entry counts
once in a text by edits and quotation, as it was tallied; different hits combine as independent evidence
above the base rate.

Edge cases: a null or empty text has the base score; rows without doc_id are scored by their text; no
labelled rows, or none of one label, give the base score 0 for all; repeated rows score alike;
an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatmeter.llm.tables import saved, slices

SAMPLE = 8_000  # labelled texts of either label that are learned from, at most
SHORTEST, LONGEST, STEM = 4, 24, 8  # letters of a lexicon entry, and of a stem at most
FUZZY_FROM = 5  # letters of an entry that may be matched with an edit
WINDOW = 6  # words before a hit in which words of reporting count
WORD = re.compile(r"\w+(?:[*@$!#'’]\w+)*")
# Words that report or discuss another's wording.
REPORTING = frozenset("said says called calls quote quoted quotes wrote writes word words term terms phrase phrases meaning means".split())
QUOTES = "\"“”„«»'‘’`"


class Matcher:
    """Finds the entries that a word matches with at most one edit."""

    def __init__(self, entries: dict[str, bool]):
        """entries: text to whether it is a stem, which any ending may follow."""
        self.children: list[dict[str, int]] = [{}]
        self.entry: list[tuple[str, bool] | None] = [None]
        for text, stem in entries.items():
            node = 0
            for letter in text:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.entry.append(None)
                node = self.children[node][letter]
            self.entry[node] = (text, stem)
        self.start = self._closed({0: 0})
        self.steps: dict[tuple, tuple] = {}
        self.found: dict[str, tuple | None] = {}

    def _closed(self, reach: dict[int, int]) -> tuple:
        """With the nodes that a letter left out leads to."""
        for node, edits in list(reach.items()):
            if edits == 0:
                for child in self.children[node].values():
                    reach[child] = min(1, reach.get(child, 1))
        return tuple(sorted(reach.items()))

    def _step(self, state: tuple, letter: str) -> tuple:
        reach: dict[int, int] = {}
        for node, edits in state:
            if (child := self.children[node].get(letter)) is not None:
                reach[child] = min(edits, reach.get(child, edits))
            if edits == 0:
                for other in (node, *self.children[node].values()):  # a letter too many, or another one
                    reach[other] = min(1, reach.get(other, 1))
        return self._closed(reach)

    def _accepts(self, state: tuple, ended: bool) -> tuple | None:
        best = None
        for node, edits in state:
            if (own := self.entry[node]) and (ended or own[1]) and (edits == 0 or len(own[0]) >= FUZZY_FROM):
                if best is None or edits < best[1]:
                    best = (own[0], edits)
        return best

    def __call__(self, word: str) -> tuple | None:
        """(entry, edits), the fewest edits first, or None."""
        if word in self.found:
            return self.found[word]
        state, best = self.start, None
        for letter in word[: LONGEST + 2]:
            key = (state, letter)
            if (following := self.steps.get(key)) is None:
                following = self.steps[key] = self._step(state, letter)
            state = following
            if not state:
                break
            now = self._accepts(state, False)  # a stem is known before the word ends
            if now and (best is None or now[1] < best[1]):
                best = now
        else:
            if len(word) <= LONGEST + 2 and (now := self._accepts(state, True)) and (best is None or now[1] <= best[1]):
                best = now
        if len(self.steps) > 300_000:
            self.steps = {}
        if len(self.found) > 500_000:
            self.found = {}
        self.found[word] = best
        return best


@dataclass
class Model:
    entries: dict[str, bool] = field(default_factory=dict)
    # (entry, edits, quoted, word); the word is empty for exact matches, and for words not seen before
    weight: dict[tuple[str, int, bool, str], float] = field(default_factory=dict)
    base: float = 0.0

    def score(self, hits: list[tuple[str, int, bool, str]]) -> float:
        best: dict[tuple[str, int, bool], float] = {}
        for hit in hits:
            kind = hit[:3]
            weight = self.weight.get(hit, self.weight.get((*kind, ""), 0.0))
            best[kind] = max(weight, best.get(kind, 0.0))
        return 1.0 - (1.0 - self.base) * math.prod(1.0 - best[kind] for kind in sorted(best))


def hits(text: str | None, match: Matcher) -> list[tuple[str, int, bool, str]]:
    """(entry, edits, quoted, the word if there are edits) of each word of a whole text that matches."""
    if not text:
        return []
    low = text.lower()
    words = WORD.findall(low)
    telling = {w for w in set(words) if match(w)}
    if not telling:
        return []
    out, before = [], []
    for m in WORD.finditer(low):
        if (word := m[0]) in telling:
            inside = low[max(0, m.start() - 1) : m.start()] in QUOTES and low[m.end() : m.end() + 1].strip(".,!?") in QUOTES
            inside = inside and m.start() > 0 and m.end() < len(low)
            entry, edits = match(word)
            out.append((entry, edits, bool(inside or REPORTING & set(before[-WINDOW:])), word if edits else ""))
        before.append(word)
        del before[:-WINDOW]
    return out


def _terms(text: str | None) -> set[tuple[str, bool]]:
    """A text's words, and their beginnings marked True."""
    words = {w for w in WORD.findall((text or "").lower()) if len(w) >= SHORTEST}
    out = {(w, False) for w in words if len(w) <= LONGEST}
    out |= {(w[:n], True) for w in words for n in range(SHORTEST, min(len(w), STEM) + 1)}
    return out


def _surprise(n: float, m: float, toxic: int, clean: int) -> float:
    """Log-likelihood ratio of n toxic and m clean documents against the sample's shares; 0 if not toxic."""
    if n * clean <= m * toxic:
        return 0.0
    expected = [(n + m) * x / (toxic + clean) for x in (toxic, clean)]
    return sum(x * math.log(x / e) for x, e in zip((n, m), expected) if x)


def _signature(text: str) -> tuple[int, int]:
    """Two min-hashes of three-word shingles: near copies mostly share them, other texts do not."""
    words = text.lower().split()
    parts = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    return tuple(min(xxhash.xxh64_intdigest(x, seed) >> 1 for x in parts) for seed in (1, 2))


def _lexicon(rows: list[tuple], clean_counts: dict[tuple[str, bool], int], toxic: int, clean: int, least: float) -> dict[str, bool]:
    """Entries from toxic documents, given as (signature, signature, their telling terms).

    A term's support is the number of documents that aren't near copies. From the shortest telling
    beginning on, one goes down while a single longer one keeps nearly all of the support; where
    none does, it is a stem. An entry stays if it is frequent, or brings in documents of its own.
    """
    inside: dict[tuple[str, bool], list[int]] = {}
    for i, (_, _, terms) in enumerate(rows):
        for t in terms:
            inside.setdefault((t[1:], t[0] == "+"), []).append(i)

    def support(ids: list[int]) -> int:
        return min(len({rows[i][0] for i in ids}), len({rows[i][1] for i in ids}))

    telling = {t: support(ids) for t, ids in inside.items()}
    telling = {t: n for t, n in telling.items() if _surprise(n, clean_counts.get(t, 0), toxic, clean) >= least}
    longer: dict[str, list[tuple[str, bool]]] = {}
    for text, begins in telling:
        longer.setdefault(text[:-1] if begins else text, []).append((text, begins))
        if not begins and len(text) > STEM:  # a word follows its longest counted beginning
            longer.setdefault(text[:STEM], []).append((text, begins))
    found: dict[str, bool] = {}
    for text, begins in sorted(telling):
        if (text[: STEM if not begins and len(text) > STEM else len(text) - begins], True) in telling:
            continue
        while begins:
            best = max((x for x in longer.get(text, []) if x != (text, True)), key=telling.get, default=None)
            if best is None or telling[best] < 0.85 * telling[text, True]:
                break
            text, begins = best
        found[text] = begins
    entries, covered = {}, set()
    for text, stem in sorted(found.items(), key=lambda x: (-telling[x], x)):
        own = inside[text, stem]
        if telling[text, stem] >= 0.05 * len(rows) or support([i for i in own if i not in covered]) >= max(3, 0.003 * toxic):
            entries[text] = stem
            covered.update(own)
    return entries


def learn(labelled: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from (text, toxic). The sample has at most ``sample`` distinct texts of each label."""
    rows = labelled.where(F.col("text").isNotNull() & F.col("toxic").isin(0, 1)).select("text", F.col("toxic").cast("int"))
    rows = saved(rows.withColumn("_order", F.xxhash64("text")).dropDuplicates(["toxic", "_order"]), "labelled_texts")
    # At most two times ``sample`` keys of 8 bytes, so the broadcast is bounded.
    picked = [rows.where(F.col("toxic") == y).select("toxic", "_order").orderBy("_order").limit(sample) for y in (1, 0)]
    picked = saved(picked[0].unionByName(picked[1]), "picked")
    learned = saved(rows.join(F.broadcast(picked), ["toxic", "_order"], "left_semi").repartition(16, "_order"), "learned")
    number = dict(learned.groupBy("toxic").count().collect())
    toxic, clean = number.get(1, 0), number.get(0, 0)
    if not toxic or not clean:
        return Model()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found.update((t, b, label) for t, b in _terms(text))
        columns = list(zip(*((t, b, n * y, n * (1 - y)) for (t, b, y), n in found.items()))) or [[]] * 4
        types = (pa.string(), pa.bool_(), pa.int64(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["term", "begins", "toxic", "clean"])

    terms = learned.select("text", "toxic").mapInArrow(count, "term string, begins boolean, toxic long, clean long")
    terms = terms.groupBy("term", "begins").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    terms = saved(terms.where("toxic >= 3"), "terms")
    least = math.log(max(1, terms.count()) / 0.01)  # so that chance alone rarely makes an entry
    few = terms.where(F.col("toxic") * clean > 10 * F.col("clean") * toxic).collect()  # bounded, as the sample is
    counts = {(r.term, r.begins): r.clean for r in few if _surprise(r.toxic, r.clean, toxic, clean) >= least}

    def telling(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(*_signature(x), ["-+"[b] + t for t, b in _terms(x) & counts.keys()]) for x in batch.column("text").to_pylist()]
            types = (pa.int64(), pa.int64(), pa.list_(pa.string()))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["a", "b", "terms"])

    rows_of = learned.where("toxic = 1").select("text").mapInArrow(telling, "a long, b long, terms array<string>").collect()
    entries = _lexicon([tuple(r) for r in rows_of], counts, toxic, clean, least)  # at most ``sample`` rows

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match, found = Matcher(entries), Counter()
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                found.update((*h, label) for h in set(hits(text, match)))
        columns = list(zip(*((*k, n) for k, n in found.items()))) or [[]] * 6
        types = (pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.int32(), pa.int64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], ["entry", "edits", "quoted", "word", "toxic", "n"])

    # Whether an entry also stands in clean texts is counted on others than it was chosen by.
    other = rows.where("toxic = 0").join(F.broadcast(picked), ["toxic", "_order"], "left_anti").orderBy("_order").limit(sample)
    other = saved(other, "other")
    unseen = other.count()
    seen: Counter = Counter()
    tallied = learned.select("text", "toxic").unionByName(other.select("text", "toxic"))
    for e, k, q, w, y, n in tallied.mapInArrow(tally, "entry string, edits int, quoted boolean, word string, toxic int, n long").collect():
        seen[e, k, q, w, y] += n  # bounded, as the samples are
    once: Counter = Counter()
    for e, k, q, w in {key[:4] for key in seen if key[1]}:
        n, m = seen[e, k, q, w, 1], seen[e, k, q, w, 0]
        if n + m == 1:
            once[e, k, q, 1] += n
            once[e, k, q, 0] += m
    weight, trust = {}, 3 / (clean + unseen)
    # Without evidence of its own, an edit or a quotation has the share believed beforehand.
    believed = {(0, False): 0.98, (0, True): 0.4, (1, False): 0.75, (1, True): 0.25}

    def share(n: float, m: float, k: int, q: bool) -> float:
        return min(0.995, (n + believed[k, q] * trust) / (n + m + trust))

    for e in entries:
        for q in (False, True):
            weight[e, 0, q, ""] = share(seen[e, 0, q, "", 1] / toxic, seen[e, 0, q, "", 0] / (clean + unseen), 0, q)
            # What words seen once tell holds for one that was not seen.
            weight[e, 1, q, ""] = share(once[e, 1, q, 1] / toxic, once[e, 1, q, 0] / (clean + unseen), 1, q)
    for e, k, q, w in {key[:4] for key in seen if key[1]}:
        n, m = seen[e, k, q, w, 1], seen[e, k, q, w, 0] / (clean + unseen)
        # A word that stands in clean texts as often is another word: only what is surely beyond that tells.
        more = max(0.0, (n - 2 * math.sqrt(n)) / toxic - m) if m else n / toxic
        weight[e, k, q, w] = share(more, m, k, q)
    return Model(entries, weight, 0.02)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Whether a row's label may not be learned from: crc32 of its id as text, by remainder."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labels of rows that aren't held out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int")).dropDuplicates(["_id"])
    # Labelled ids in hash order, bounded before they meet the texts.
    some = usable.where("toxic = 1").orderBy(F.xxhash64("_id")).limit(2 * sample)
    some = saved(some.unionByName(usable.where("toxic = 0").orderBy(F.xxhash64("_id")).limit(2 * sample)), "labelled")
    return learn(docs.join(F.broadcast(some), docs["doc_id"].cast("long") == some["_id"]).select(docs["text"].cast("string").alias("text"), some["toxic"]), sample)


def scored(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (none of them ``score``) of ``docs`` with ``score``, from 0 to 1."""
    schema = docs.select(*keep).schema.add("score", "double")
    source = docs.select(*[docs[c] for c in keep], docs["text"].cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(model.entries)
        for batch in slices(batches, "_text"):
            scores = [min(1.0, model.score(hits(x, match))) for x in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*keep, "score"])

    return source.mapInArrow(run, schema)


def clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, whole, whose score is under ``threshold``."""
    model = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = Matcher(model.entries)
        for batch in slices(batches, "text"):
            fine = [model.score(hits(x, match)) < threshold for x in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(fine, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

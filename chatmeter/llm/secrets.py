"""Secret scans: base rules, and formats learned by grammar inference.

The base rules are plain patterns. What they find in a sample of documents are the labelled credentials.
For each kind a prefix tree of them is generalised by merging statistically compatible states (the
Hoeffding bound on the shares of each next letter and of ending, checked for all states behind), which
gives a probabilistic automaton. Every run of twelve token characters or more in every text is a candidate, whole and
between its dots, however long; it is a secret if its log-likelihood under some automaton, against that of ordinary
words, passes what credentials reach that an automaton of the others was not shown. Ordinary runs may hold
secrets that no rule labels, so the few that pass are left out of the words, and only their bulk can
lift a threshold. Base findings stay whatever the automata say.

Edge cases: a null or empty text has no findings; repeated rows are scanned each; an empty table gives
an empty table; a sample with too few credentials of a kind gives no automaton of it; other columns
are ignored. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatmeter.llm.tables import saved, slices

# The base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("password", "passwd", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "format")

RUN = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{12,}+")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}+")
SAMPLE = 20_000  # documents that credentials and ordinary runs are learned from, at most
STRINGS = 400  # credentials of a kind, and ten times as many ordinary runs, at most
LETTERS = 40_000  # of the credentials that an automaton is inferred from, in all
FEWEST = 8
RARE = 100  # occurrences of a letter in ordinary runs from which on its pairs count more than the letters alone
BULK = 0.9  # of the ordinary runs that an automaton's threshold must pass; the others may be unlabelled secrets
MARGIN = 0.3  # above that, in log-likelihood a letter
UNSEEN = math.log(1e-4)
STAY = 8.0  # by which the log-likelihood of another state must be higher than that of going on in the same one

FOUND = T.ArrayType(T.StructType().add("start", "integer").add("kind", "string").add("end", "integer"))
Span = tuple[int, int, int]  # start, place of the kind in KINDS, end


def base_spans(text: str) -> list[tuple[Span, str]]:
    """What the base rules find, with the credential itself."""
    low, out = text.lower(), []
    if any(k in low for k in KEYWORDS):
        # A match too short to count still uses up its characters, so length is checked afterwards.
        out += [((m.start(), 0, m.end()), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    out += [((m.start(), 1, m.end()), m[0]) for m in ACCESS.finditer(text)]
    out += [((m.start(), 2, m.end()), m[0]) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> Iterator[list[tuple[int, int]]]:
    """Of each run of token characters its places: the whole without dots at its ends, then what lies between dots."""
    for m in RUN.finditer(text):
        start, end = m.span()
        if "." in m[0]:
            end -= len(m[0]) - len(m[0].rstrip("."))
            start += len(m[0]) - len(m[0].lstrip("."))
            parts = [x.span() for x in CANDIDATE.finditer(text, start, end)] if start < end else []
            out = [(start, end)] if end - start >= 12 and "." in text[start:end] else []
            if out + parts:
                yield out + parts
        else:
            yield [(start, end)]


class Automaton:
    """A probabilistic automaton inferred from strings by merging prefix-tree states."""

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[Counter] = [Counter()]
        self.ended: list[int] = [0]
        for text in sorted(strings):
            state = 0
            for letter in text:
                self.taken[state][letter] += 1
                if letter not in self.next[state]:
                    self.next[state][letter] = len(self.next)
                    self.next.append({})
                    self.taken.append(Counter())
                    self.ended.append(0)
                state = self.next[state][letter]
            self.ended[state] += 1
        self.dotted = any("." in x for x in strings)
        self.width = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self.log: list[dict[str, tuple[int, float]]] = []
        self.end: list[float] = []
        # Where a letter leads most often: from there it goes on after a letter that a state has not seen.
        most: dict[str, tuple[int, int]] = {}
        for moves, taken in zip(self.next, self.taken):
            for c, s in moves.items():
                most[c] = max(most.get(c, (0, 0)), (taken[c], s))
        self.usual = {c: s for c, (_, s) in most.items()}
        for moves, taken, ended in zip(self.next, self.taken, self.ended):
            total = max(1, sum(taken.values()) + ended)
            self.log.append({c: (s, math.log(taken[c] / total)) for c, s in moves.items() if taken[c]})
            self.end.append(math.log(ended / total) if ended else UNSEEN)

    def _alike(self, a: int, b: int) -> bool:
        """Whether no share of a next letter or of ending tells the two states apart, here or behind."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            n, m = sum(self.taken[a].values()) + self.ended[a], sum(self.taken[b].values()) + self.ended[b]
            if not n or not m:
                continue
            bound = self.width * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for c in self.taken[a].keys() | self.taken[b].keys():
                if abs(self.taken[a][c] / n - self.taken[b][c] / m) > bound:
                    return False
            pending += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _foretold(self, a: int, b: int) -> float:
        """The log-likelihood of what follows b by the shares of a."""
        total = math.log(sum(self.taken[a].values()) + self.ended[a] + 1)
        found = sum(n * (math.log(self.taken[a][c] + 0.01) - total) for c, n in self.taken[b].items())
        return found + self.ended[b] * (math.log(self.ended[a] + 0.01) - total)

    def _fold(self, a: int, b: int) -> None:
        """Adds b, the root of a tree, and all behind it to a."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            self.ended[a] += self.ended[b]
            self.taken[a] += self.taken[b]
            for c, behind in self.next[b].items():
                if c in self.next[a]:
                    pending.append((self.next[a][c], behind))
                else:
                    self.next[a][c] = behind

    def _merge_states(self) -> None:
        kept, place = [0], 0
        while place < len(kept):
            state = kept[place]
            place += 1
            for letter in sorted(self.next[state], key=lambda c: (-self.taken[state][c], c)):
                behind = self.next[state][letter]
                if behind in kept:
                    continue
                alike = [other for other in kept if self._alike(other, behind)]
                if alike:
                    # A state met seldom is alike to many; it joins the one that foretells best what follows it, or stays in
                    # the run that it comes from where that says little.
                    other = max(alike, key=lambda o: self._foretold(o, behind) + (STAY if o == state else 0.0))
                    self.next[state][letter] = other
                    self._fold(other, behind)
                else:
                    kept.append(behind)

            if any(s not in kept for s in self.next[state].values()):  # a fold brought new states here
                place -= 1
        number = {s: i for i, s in enumerate(kept)}
        self.next = [{c: number[t] for c, t in self.next[s].items() if t in number} for s in kept]
        self.taken, self.ended = [self.taken[s] for s in kept], [self.ended[s] for s in kept]

    def likelihood(self, text: str, least: float = -math.inf) -> float:
        """Its logarithm; given up under ``least``."""
        state, total = 0, 0.0
        for letter in text:
            state, step = self.log[state].get(letter) or (self.usual.get(letter, state), UNSEEN)
            total += step
            if total < least:
                return -math.inf
        return total + self.end[state]


class Formats:
    """The automata of all kinds, ordinary runs for comparison, and the learned thresholds."""

    def __init__(self, credentials: dict[int, list[str]], ordinary: list[str]):
        kinds = [sorted(v) for _, v in sorted(credentials.items()) if len(v) >= FEWEST]
        self.automata = [Automaton(v) for v in kinds]
        halves = [[(Automaton(v[i::2]), v[1 - i :: 2]) for i in (0, 1)] for v in kinds]
        self._words(ordinary)
        self.least = [self._bulk(a, ordinary) for a in self.automata]
        # Secrets among the runs make their own pairs of letters likely, so words are learned again without what looks like one.
        ordinary = [x for x in ordinary if self.score(x) <= 0]
        self._words(ordinary)
        for i, (automaton, own, parts) in enumerate(zip(self.automata, kinds, halves)):
            # Credentials unlike all others of their kind say nothing about its format.
            good = sorted(g for half, rest in parts for x in rest if (g := self._against(half, x)) > 0)
            good = good or sorted(self._against(automaton, x) for x in own)
            # Above what ordinary runs stay under, but no farther than half way to what credentials reach.
            bulk = self._bulk(automaton, ordinary)
            self.least[i] = max(min((good[len(good) // 20] + bulk) / 2, bulk + MARGIN), bulk)

    def _bulk(self, automaton: Automaton, ordinary: list[str]) -> float:
        """The score that the bulk of the ordinary runs stays under."""
        bad = sorted(self._against(automaton, x) for x in ordinary) or [0.0]
        return max(bad[int(BULK * len(bad))] + 0.1, 0.1)

    def _words(self, ordinary: list[str]) -> None:
        """Learns the pairs of letters in ordinary runs."""
        pairs: Counter = Counter()
        for text in ordinary:
            pairs.update(zip(" " + text, text + " "))
        firsts, seconds = Counter(), Counter()
        for (a, b), n in pairs.items():
            firsts[a] += n
            seconds[b] += n
        # A letter seldom seen foretells little, so secrets among the runs do not make their own pairs likely.
        total = sum(firsts.values()) + 1
        self.pairs = {(a, b): max(UNSEEN, math.log((n + RARE * seconds[b] / total) / (firsts[a] + RARE))) for (a, b), n in pairs.items()}
        self.seconds = {b: math.log(max(n / total, 1e-3)) for b, n in seconds.items()}
        self.firsts = {a: math.log(RARE / (n + RARE)) for a, n in firsts.items()}
        self.known: dict[str, float] = {}

    def _unseen(self, a: str, b: str) -> float:
        return max(UNSEEN, self.firsts.get(a, 0.0) + self.seconds.get(b, math.log(1e-3)))

    def _against(self, automaton: Automaton, text: str) -> float:
        """Log-likelihood ratio a letter."""
        if "." in text and not automaton.dotted:
            return -math.inf
        plain = sum(n if (n := self.pairs.get(p)) is not None else self._unseen(*p) for p in zip(" " + text, text + " "))
        return (automaton.likelihood(text, plain) - plain) / (len(text) + 1)

    def score(self, text: str) -> float:
        """Over 0 if the automata take a run for a secret: by how much it passes its threshold."""
        if (got := self.known.get(text)) is None:
            got = max((self._against(a, text) - t for a, t in zip(self.automata, self.least)), default=-math.inf)
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[text] = got
        return got


def spans(text: str | None, formats: Formats) -> list[Span]:
    """All findings in a whole text, by start; runs that a base span overlaps are left to it."""
    if not text:
        return []
    found = [s for s, _ in base_spans(text)]
    if formats.automata:
        base, k = sorted((a, b) for a, _, b in found), 0
        for places in candidates(text):
            taken = -1
            for start, end in places:
                if end > taken and formats.score(text[start:end]) > 0:
                    while k < len(base) and base[k][1] <= start:
                        k += 1
                    if k == len(base) or base[k][0] >= end:
                        found.append((start, 3, end))
                        taken = end
    return sorted(found)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Formats from the credentials and ordinary runs in at most ``sample`` documents, in hash order."""
    ids = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("_id")).distinct()
    ids = saved(ids.orderBy(F.xxhash64("_id"), "_id").limit(sample), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = set()
            for text in filter(None, batch.column("text").to_pylist()):
                base = base_spans(text)
                out |= {(kind, x.strip(".")) for (_, kind, _), x in base}
                places = (place for places in candidates(text) for place in places)
                out |= {(3, text[s:e]) for s, e in places if not any(a < e and s < b for (a, _, b), _ in base)}
            columns = list(zip(*out)) or [[], []]
            yield pa.record_batch([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string())], ["kind", "found"])

    # The ids are at most ``sample`` longs, so the broadcast is bounded.
    texts = docs.join(F.broadcast(ids), docs["doc_id"] == ids["_id"], "left_semi").select(F.col("text").cast("string").alias("text"))
    # Credentials may be so long that just enough of them make an automaton; of ordinary runs short ones tell as much.
    most = F.when(F.col("kind") < 3, LETTERS // FEWEST).otherwise(200)
    found = saved(texts.mapInArrow(run, "kind int, found string").where(F.length("found") <= most).distinct(), "found")
    # What a rule labels in any document is no ordinary run in another.
    labelled = found.where("kind < 3").select("found").distinct()
    ordinary = found.where("kind = 3").join(labelled, "found", "left_anti").select("kind", "found")
    found = found.where("kind < 3").unionByName(ordinary)
    picked: dict[int, list[str]] = {}
    for kind in range(4):
        most = STRINGS * (10 if kind == 3 else 1)
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("found"), "found").limit(most).collect()  # bounded
        picked[kind] = [r.found for r in rows]
        if kind < 3:
            picked[kind] = _within_letters(picked[kind])
    return Formats({k: picked[k] for k in range(3)}, picked[3])


def _within_letters(strings: list[str]) -> list[str]:
    """The first strings, up to ``LETTERS`` letters in all."""
    total, out = 0, []
    for x in strings:
        total += len(x)
        if total > LETTERS:
            break
        out.append(x)
    return out


def scanned(docs: DataFrame, formats: Formats, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``found``: an array of (start, kind, end)."""
    schema = docs.select(*keep).schema.add("found", FOUND)
    source = docs.select(*[docs[c] for c in keep], docs["text"].cast("string").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text"):
            found = [[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in spans(x, formats)] for x in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, kind)], [*keep, "found"])

    return source.mapInArrow(run, schema)


def redact(text: str | None, found: list[Span], mask: str = "[SECRET]") -> str | None:
    """The text with every finding masked; overlapping ones together."""
    if not found:
        return text
    out, at = [], 0
    for start, _, end in found:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, formats: Formats) -> DataFrame:
    """``docs`` with secrets masked in ``text``, and ``n_chars`` set anew where something was masked."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            old = batch.column("text").to_pylist()
            new = [redact(x, spans(x, formats)) for x in old]
            columns = dict(zip(names, batch.columns))
            columns["text"] = pa.array(new, batch.column("text").type)
            if "n_chars" in columns:
                sizes = [len(y) if x != y else n for x, y, n in zip(old, new, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return docs.mapInArrow(run, docs.schema)

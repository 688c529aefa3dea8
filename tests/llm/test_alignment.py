"""Token alignment against a plain one, token by token."""

import hashlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from chatmeter.llm import alignment, tokens

PATHS = tokens.vocabulary_path("byte_bpe_50k.json"), tokens.vocabulary_path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "a", " lead", "trail ", "two  blanks", "a\n b", "a \n\n  b\tc", "\n", "É é́ ﬁ", "▁piece▁", "<s> <|endoftext|> </s>",
    "it's we'll 12 345,6 !?", "x   y", "　wide", "zero\x00byte", "emoji 😀😀 汉字", "a\x1cb \x85 c", "     ", "tail\n", "lorem ipsum " * 20_000,
]


@pytest.fixture(scope="module")
def both():
    return alignment.Both(*PATHS)


def plain(both, text):
    """(A ids, B ids, groups, links as pairs of ids) of one text."""
    if not text:
        return [], [], "", []
    a, b = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text)
    x, y = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if not b"".join(x) == b"".join(y) == (" " + text).encode():
        return [], [], "", []
    i = j = at_x = at_y = 0
    groups, links, group = [], [], ([], [])
    while i < len(a) or j < len(b):
        links.append((a[i], b[j]))
        end_x, end_y = at_x + len(x[i]), at_y + len(y[j])
        if end_x <= end_y:
            group[0].append(a[i])
            i, at_x = i + 1, end_x
        if end_y <= end_x:
            group[1].append(b[j])
            j, at_y = j + 1, end_y
        if end_x == end_y:
            groups.append("|".join(",".join(map(str, g)) for g in group))
            group = ([], [])
    return a, b, ";".join(groups), links


def wanted(both, rows):
    found = [(doc_id, *plain(both, text)) for doc_id, text in rows]
    counts = Counter(link for *_, links in found for link in links)
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, len(a), len(b), groups.count(";") + 1 if a else 0, len(links), sum(counts[x] == best[x[1]] for x in links),
             sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if a else "")
            for d, a, b, groups, links in found
        ),
        key=str,
    )


def test_words_give_the_ids_of_whole_texts(both, spark, sf_dir):
    texts = [*ODD, *[r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]]
    own, _, _ = alignment.aligned(pa.array(range(len(texts))), pa.array(texts), both)
    for row, text in zip(own.to_pylist(), texts):
        a, b, groups, links = plain(both, text)
        assert (row["n_a"], row["n_b"], row["n_links"]) == (len(a), len(b), len(links)), text[:50]
        assert row["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if a else "")


def test_query_equals_a_plain_alignment(both, spark, sf_dir):
    df = entry_point.queries()["op13_token_alignment"](spark, sf_dir)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, df.collect()), key=str) == wanted(both, rows)


@pytest.mark.parametrize("size", [40, alignment.SLICE])
def test_odd_texts_over_slices(both, spark, monkeypatch, size):
    """Counts are of the whole corpus however it is sliced; a worker that forgets words gives the same."""
    monkeypatch.setattr(alignment, "SLICE", size)
    monkeypatch.setattr(alignment, "WORD_BYTES", 2000)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id at all"), (3, "a"), (3, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("slice", "n", "blob", "a", "pair")})
    assert sorted(map(tuple, alignment.cross_aligned(df.repartition(3), *PATHS).collect()), key=str) == wanted(both, rows)
    empty = spark.createDataFrame([], df.schema)
    assert alignment.cross_aligned(empty, *PATHS).columns == [c.split()[0] for c in alignment.RESULT.split(", ")]
    assert alignment.cross_aligned(empty, *PATHS).count() == 0
    only = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, alignment.cross_aligned(only, *PATHS).collect())) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]

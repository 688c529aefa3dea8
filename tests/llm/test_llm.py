"""The training-data operators against brute force, and on awkward tables."""

import binascii
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from chatmeter.llm import covertree, licenses, mixing, packing, secrets, sharding, shards, simhash, tokens, topk, toxicity
from chatmeter.llm.graph import components

PATH = tokens.vocabulary_path()
LONG = "lorem ipsum dolor " * 40_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ["score", "toxic", "fp", "repeated", "kept", "found", "_source", "_block", "_text", "_row", "shard", "slot", "_id", "mix_epoch0"]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, columns with names of the operators' own."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (3, "", "en", "b", 0),
        (4, None, None, None, None),
        (None, "no id at all", "en", "b", 12),
        (5, LONG, "la", "b", len(LONG)),
        (6, 'token = "0641917ea4e9feb9cda83477b57ac2654884f485" ß Released under the MIT License.', "en", None, 80),
        (7, "  \n\t ", "en", "c", 5),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({c: F.lit(0) for c in CLASH})


@pytest.fixture(scope="module")
def none(spark, odd):
    return spark.createDataFrame([], odd.schema)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


# --- components and SimHash -----------------------------------------------------------------------


def reached(ids, pairs):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_components_of_a_long_chain_a_star_and_loose_pairs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    got = components(spark.createDataFrame(pairs + [(None, 3)], "a long, b long"), "a", "b")
    want = reached({i for p in pairs for i in p}, pairs)
    assert sorted(map(tuple, got.collect())) == sorted(want.items())
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    parts = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [simhash.xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_fingerprints(texts):
    for text in [*list(texts.values())[:40], None, "", " \n ", "One", "a b c d e", "É é  x\x0b y"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("block", [4096, 8])
def test_links_connect_all_within_four_bits(spark, monkeypatch, block):
    """Random codes, and one dense group of many variants; small blocks split it."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(1)
    near = [0x123456789ABCDEF0 ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 7), replace=False)) for _ in range(400)]
    codes = np.unique(np.array([*near, *rng.integers(0, 2**63, 300).tolist(), 0, 2**64 - 1], np.uint64))
    nodes = spark.createDataFrame([(int(c), i) for i, c in enumerate(codes.view(np.int64))], "fp long, rep long")
    got = simhash.links(nodes, 4, 3)
    pairs = [(i, int(j) + i + 1) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes[i + 1 :] ^ codes[i]) <= 4)]
    want = reached(range(len(codes)), pairs)
    assert {k: v for k, v in reached(range(len(codes)), [tuple(r) for r in got.collect()]).items()} == want


def test_simhash_query(spark, sf_dir, texts):
    rows = entry_point.queries()["op1_simhash_near_dedup"](spark, sf_dir).collect()
    marks = {r.doc_id: plain_fingerprint(texts[r.doc_id]) for r in rows}
    assert all(r.fingerprint == f"{marks[r.doc_id]:016x}" for r in rows) and len(rows) == len(texts)
    ids = sorted(marks)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (marks[a] ^ marks[b]).bit_count() <= 4]
    assert {r.doc_id: r.component_id for r in rows} == reached(ids, pairs)


def test_simhash_on_odd_tables(odd, none):
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(odd).collect()}
    assert got >= {(1, 1), (2, 1), (3, 3), (4, 3), (7, 3)} and not any(d is None for d, _ in got)
    kept = simhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is not None, r.doc_id) for r in kept.collect()) == [(False, None), (True, 1), (True, 3), (True, 5), (True, 6)]
    assert simhash.near_duplicates(none).count() == simhash.deduplicated(none).count() == 0


# --- mixing ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op2_source_mixing", "op6_embedding_near_dedup", "op9_exact_topk"])
def test_queries_equal_their_sql(spark, sf_dir, duck, name):
    df = entry_point.queries()[name](spark, sf_dir)
    want = duck.execute(f"SELECT {', '.join(df.columns)} FROM ({entry_point.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_mixing_reads_all_once_and_small_sources_more(spark):
    rows = [(i, "x" * 400, "en", "big" if i < 900 else "small", 400) for i in range(1000)]
    got = mixing.mixed(spark.createDataFrame(rows, DOCS), mixing.Target(repeats=1.5))
    counts = {r.source: (r.n, r.ids) for r in got.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).collect()}
    assert counts["big"] == (900, 900) and counts["small"][1] == 100 and abs(counts["small"][0] - 150) <= 3
    # Every stretch of the order holds the sources by weight.
    early = got.where("mix_place < 0.5").groupBy("source").count().collect()
    assert {r.source: r["count"] for r in early} == {"big": pytest.approx(450, abs=10), "small": pytest.approx(75, abs=4)}


def test_mixing_on_odd_tables(odd, none):
    got = mixing.mixed(odd, mixing.Target(repeats=2.0))
    assert got.columns == [*odd.columns, "mix_epoch", "mix_place"]
    assert {r.doc_id for r in got.collect()} == {None, 1, 2, 3, 4, 5, 6, 7}
    assert mixing.counted(odd, mixing.Target(entropy=0.9, budget=1000)).count() == odd.count()
    assert mixing.mixed(none, mixing.Target(repeats=2.0)).count() == mixing.counted(none, mixing.Target(entropy=0.9, budget=0)).count() == 0


# --- toxicity -------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_the_automaton_finds_what_edit_distances_say():
    entries = {"stupid": False, "clown": False, "lowei": True, "vequ": True}
    match, rng = toxicity.Matcher(entries), np.random.default_rng(0)
    words = ["stupid", "stupd", "sttupid", "stvpid", "clowns", "clow", "loweichen", "lowxichen", "vequé", "vexué", "", "a"]
    words += ["".join(rng.choice(list("stupidclownwe"), rng.integers(3, 8))) for _ in range(3000)]
    for word in words:
        found = []
        for text, stem in entries.items():
            ends = range(len(word) + 1) if stem else [len(word)]
            edits = min((distance(word[:e], text) for e in ends), default=9)
            if edits == 0 or edits == 1 and len(text) >= toxicity.FUZZY_FROM:
                found.append(edits)
        assert (match(word) or (None, None))[1] == min(found, default=None), word


def toxic_table(spark, n=900):
    rng = np.random.default_rng(3)
    filler = ["".join(rng.choice(list("aeiorstln"), rng.integers(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = list(rng.choice(filler, 40))
        if toxic := i % 4 == 0:
            words[5 + i % 20] = ["moronic", "dimwit", "blockhead"][i // 4 % 3]
        rows.append((i, " ".join(words), "en", "s", 1, int(toxic)))
    df = spark.createDataFrame(rows, DOCS + ", toxic int")
    return df.drop("toxic"), df.select("doc_id", F.lit(1).alias("quality"), "toxic")


def test_toxicity_learns_words_finds_misspelt_ones_and_spares_quotations(spark):
    docs, labels = toxic_table(spark)
    model = toxicity.train(docs, labels)
    assert set(model.entries) == {"moronic", "dimwit", "blockhead"}
    match = toxicity.Matcher(model.entries)

    def score(text):
        return model.score(toxicity.hits(text, match))

    assert score("you are a dimwit indeed") >= 0.7 and score("you are a dimvit indeed") >= 0.7
    assert score('they wrote "dimwit" there') < 0.7 and score("quiet words only") < 0.1
    assert score(None) == score("") == pytest.approx(model.base)
    scored = toxicity.scored(docs, model, ["doc_id"]).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert scored and all((r.score >= 0.7) == (r.toxic == 1) for r in scored)


def test_repeated_quotations_and_common_neighbours_do_not_add_up(spark):
    docs, labels = toxic_table(spark)
    common = F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit(" dimwits"))).otherwise(F.col("text"))
    model = toxicity.train(docs.withColumn("text", common), labels)
    match = toxicity.Matcher(model.entries)

    def score(text):
        return model.score(toxicity.hits(text, match))

    plain = "quiet words only and nothing else in all of this text "
    assert match("dimwits") == ("dimwit", 1) and score((plain + "dimwits ") * 40) < 0.2
    assert score((plain + '"dimwit" ') * 40) == score(plain + '"dimwit"') < 0.7
    assert score(plain + "dimvit") >= 0.7 and score(plain + "dimwits dimvit") >= 0.7


def test_labels_of_held_out_rows_are_never_read(spark):
    docs, labels = toxic_table(spark, 300)
    wrong = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, labels) == toxicity.train(docs, wrong)


def test_held_out_is_by_checksum(spark):
    got = {r.i: r.h for r in spark.range(50).select(F.col("id").alias("i"), toxicity.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: binascii.crc32(str(i).encode()) % 3 == 1 for i in range(50)}


def test_toxicity_on_odd_tables(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, 1), (6, 0, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels)
    assert toxicity.scored(odd, model, ["doc_id"]).count() == odd.count()
    assert toxicity.clean(odd, labels).columns == odd.columns and toxicity.clean(odd, labels).count() == odd.count()
    assert toxicity.train(none, labels.limit(0)).entries == {} and toxicity.clean(none, labels.limit(0)).count() == 0


# --- secrets and licenses -------------------------------------------------------------------------


def plain_spans(text):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text, re.I | re.A) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


TRICKY = [
    "password=token:abcdefghijkl12 secret==abcdefghijklm", "AKIAAKIA1234567890 AKIA12 AKIAZZ-AKIA0123456789ABCD", "ſecret=abcdefghijklmno",
    "PassWord' : \"0123456789abcdef0123\" x", "é token=aaaaaaaaaaaa, api_key=bbbbbbbbbbbb APIKEY=c", "abcdef0123456789abcdefg 0123456789abcde",
]


def test_base_secrets(texts):
    for text in [*texts.values(), *TRICKY]:
        assert [s for s, _ in secrets.base_spans(text)] == plain_spans(text)


def test_secrets_query(spark, sf_dir, texts):
    for r in entry_point.queries()["op4_secret_scans"](spark, sf_dir).collect():
        base = plain_spans(texts[r.doc_id])
        said = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, said.split(","))) <= set(r.spans.split(","))


def test_automata_learn_a_format_and_tell_it_from_words():
    rng = np.random.default_rng(5)
    upper = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    keys = ["AKIA" + "".join(rng.choice(upper, 16)) for _ in range(300)]
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(300)]
    words = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(12, 20))) for _ in range(2000)]
    automaton = secrets.Automaton(keys)
    assert 4 < len(automaton.log) < 40 and set(automaton.log[0]) == {"A"}
    formats = secrets.Formats({0: hexes, 1: keys}, words)
    fresh = ["AKIA" + "".join(rng.choice(upper, 16)) for _ in range(50)]
    assert sum(formats.score(x) > 0 for x in fresh) >= 40
    assert not any(formats.score(x) > 0 for x in words)
    text = f"see {fresh[0]} and x{hexes[0][:12]}"
    assert (4, 1, 24) in secrets.spans(text, formats)


def test_secrets_that_stand_bare_in_the_sample_are_found(spark):
    rng = np.random.default_rng(6)
    upper, lower = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), list("etaoinshrdlu")

    def drawn(letters, n):
        return "".join(rng.choice(letters, n))

    keys = [f"KEY{drawn(upper, 20)}" for _ in range(500)]
    dotted = [f"SG.{drawn(upper, 8)}.{drawn(upper, 11)}" for _ in range(500)]  # no part between dots is long enough alone
    words = [drawn(lower, rng.integers(12, 20)) for _ in range(1500)]
    for own in (keys, dotted):
        told, bare = own[:400], [*own[:20], *own[400:440]]  # labelled; bare in the sample, 20 labelled elsewhere; the rest are fresh
        texts = [f"token={x}. {w}." for x, w in zip(told, words)] + [f"see {x}. {w}" for x, w in zip(bare, words[400:])] + words[500:]
        rows = spark.createDataFrame([(i, x, "en", "s", 1) for i, x in enumerate(texts)], DOCS)
        formats = secrets.learn(rows)
        for group in (bare, own[440:]):
            assert sum((4, 3, 4 + len(x)) in secrets.spans(f"see {x}. {words[0]}", formats) for x in group) >= 0.8 * len(group)
        assert not any(secrets.spans(f"{x}.{y} {x}", formats) for x, y in zip(words, words[1:]))


def test_planted_secrets_of_five_formats_are_found():
    """Labelled in any mixture, long signed tokens too; fresh ones of each format are found, and no word is."""
    rng = np.random.default_rng(9)
    upper, lower = list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), list("etaoinshrdlu")
    web = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")

    def drawn(letters, n):
        return "".join(rng.choice(letters, n))

    made = {
        "upper": lambda: "KEY" + drawn(upper, 20),
        "dotted": lambda: f"SG.{drawn(web, 8)}.{drawn(web, 11)}",
        "signed": lambda: f"eyJ{drawn(web, 30)}.eyJ{drawn(web, 150)}.{drawn(web, 43)}",
        "personal": lambda: "ghp_" + drawn(web[:62], 36),
        "service": lambda: "sk-" + drawn(web[:62], 48),
    }
    words = [drawn(lower, rng.integers(12, 20)) for _ in range(1000)]
    words += ["-".join(drawn(lower, 6) for _ in range(3)) for _ in range(200)] + ["/".join(drawn(lower, 5) for _ in range(4)) for _ in range(200)]
    labelled = [f() for f in made.values() for _ in range(100)]
    rng.shuffle(labelled)
    formats = secrets.Formats({0: secrets._within_letters(labelled)}, words)
    for name, f in made.items():
        fresh = [f() for _ in range(50)]
        found = sum((4, 3, 4 + len(x)) in secrets.spans(f"see {x}, {words[0]}", formats) for x in fresh)
        assert found >= 45, name
    fresh = [drawn(lower, rng.integers(12, 20)) for _ in range(500)] + ["-".join(drawn(lower, 6) for _ in range(3)) for _ in range(200)]
    assert not any(secrets.spans(f"{x}.{y} {x}", formats) for x, y in zip(fresh, fresh[1:]))


def test_credentials_of_many_letters_are_learned(spark):
    rng = np.random.default_rng(10)
    web = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_")
    keys = ["tok" + "".join(rng.choice(web, 297)) for _ in range(150)]
    words = ["".join(rng.choice(list("etaoinshrdlu"), 14)) for _ in range(300)]
    texts = [f"token={x}. {w}." for x, w in zip(keys[:100], words)] + words[100:]
    formats = secrets.learn(spark.createDataFrame([(i, x, "en", "s", 1) for i, x in enumerate(texts)], DOCS))
    assert len(formats.automata) == 1
    assert sum((4, 3, 304) in secrets.spans(f"see {x}. {words[0]}", formats) for x in keys[100:]) >= 45


def test_redaction():
    formats = secrets.Formats({}, [])
    text = 'a token = "0641917ea4e9feb9cda83477b57ac2654884f485" b'
    assert secrets.redact(text, secrets.spans(text, formats)) == 'a [SECRET]" b'
    assert secrets.redact(None, []) is None and secrets.spans(None, formats) == []


def test_secrets_on_odd_tables(odd, none):
    formats = secrets.learn(odd)
    assert secrets.scanned(odd, formats, ["doc_id"]).count() == odd.count()
    masked = secrets.redacted(odd, formats)
    assert masked.schema == odd.schema
    row = masked.where("doc_id = 6").first()
    assert "[SECRET]" in row.text and row.n_chars == len(row.text)
    assert masked.where("doc_id = 4").first().text is None
    assert secrets.redacted(none, secrets.learn(none)).count() == 0


PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [(i, x) for p, x in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]


def test_base_licenses(texts):
    odd = ["CC BY-NC cc by nc", "under_the-MIT.license é under the mit licenses", "x" * 9, None, "", "cc\x80by nc", "ccby nc"]
    for text in [*texts.values(), *odd]:
        n, places = plain_places(text)
        got = licenses.scan(text)
        assert (got["n_words"], got["n_base"]) == (n, len(places))
        assert got["first_word"] == min((i for i, _ in places), default=None)
        assert got["last_word"] == max((i for i, _ in places), default=None)
        assert got["base_labels"] == sorted({x for _, x in places}) and set(got["base_labels"]) <= set(got["labels"])


@pytest.mark.parametrize(
    ("text", "label", "edits"),
    [("Relased under teh MIT licence!", "mit", 4), ("under the MlT license", "mit", 1), ("GNU Generol Public Licens", "gpl", 2), ("é Apache Licence, Version 2", "apache-2", 1)],
)
def test_fuzzy_licenses_give_label_and_span(text, label, edits):
    got = licenses.scan(text)
    if edits <= 2:
        assert label in got["labels"] and got["score"] > 0.8
        span = next(s for s in got["spans"] if s["label"] == label)
        assert 0 <= span["start"] < span["end"] <= len(text) and 0 < span["edits"] <= edits
    else:
        assert got["labels"] == [] and got["score"] == 0.0


def untold(notice):
    """Places of the letters of a notice that are in no telling word."""
    words = [w.span() for w in re.finditer(r"\S+", notice.text) if w[0].translate(licenses._LOOKS) in notice.telling]
    return [i for i in range(len(notice.text)) if not any(a - 1 <= i <= b for a, b in words)]


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Apache License, Version 1.1", ["apache-1"]),
        ("Apache License, Version 2.0", ["apache-2"]),
        ("Apache License, Version 3", []),
        ("Apache License, Version 20", []),
        ("Licensed under CC BY ND", ["cc-by-nd"]),
        ("licensd under cc by sa 4.0", ["cc-by-sa"]),
        ("licensed under CC BY-NC-SA", ["cc-by-nc", "cc-by-nc-sa"]),
        ("under the SIL license", ["ofl"]),
        ("under the EIT license", []),
        ("under the bit license", []),
        ("under the ISC license", ["isc"]),
        ("under the BSD licence", ["bsd"]),
        ("Creative Commons Attribution NonCommercial", ["cc-by-nc"]),
        ("Creative Commons Attribution Non-Commerial", ["cc-by-nc"]),
        ("Creative Commons Attribution Share Alike", ["cc-by-sa"]),
        ("Creative Commons Attribution 4.0", ["cc-by"]),
        ("GNU General Public License, version 2", ["gpl-2"]),
        ("GNU Generl Public License version 3", ["gpl-3"]),
        ("GNU Lesser General Public License version 2.1", ["lgpl-2.1"]),
        ("GNU Affero General Public License", ["agpl"]),
        ("the BSD 3-Clause License", ["bsd-3"]),
        ("under the mit license and under the isc license", ["isc", "mit"]),
    ],
)
def test_near_misses_get_their_own_label_or_none(text, labels):
    assert licenses.scan(f"Some words. {text} and more.")["labels"] == labels


def fewest_edits(notice, line):
    """The fewest edits between a notice and any part of a line, by dynamic programming over all ends."""
    row = [0] * (len(line) + 1)
    for i, a in enumerate(notice, 1):
        last, row = row, [i] + [0] * len(line)
        for j, b in enumerate(line, 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a != b))
    return min(row)


def test_all_notices_within_their_edits_are_met():
    """Against every part of lines that hold mutated notices."""
    rng = np.random.default_rng(8)
    for _ in range(25):
        words = []
        for k in rng.choice(len(licenses.ALL), 2):
            letters = list(licenses.ALL[k].text)
            for _ in range(rng.integers(0, 5)):
                at = int(rng.integers(0, len(letters)))
                letters[at : at + int(rng.integers(0, 2))] = [str(rng.choice(list("aeinrst ")))]
            words += ["lorem", "".join(letters), "ipsum"]
        line = " ".join(" ".join(words).split())
        near = {k: fewest_edits(n.text, line) for k, n in enumerate(licenses.ALL)}
        met = {}
        for a, b, k, edits in licenses.within(line.encode()):
            assert fewest_edits(licenses.ALL[k].text, line[a:b]) <= edits <= licenses.ALL[k].edits
            met[k] = min(edits, met.get(k, edits))
        assert set(met) == {k for k, e in near.items() if e <= licenses.ALL[k].edits}


def test_license_query_is_the_scan_of_each_text(spark, sf_dir, texts):
    rows = entry_point.queries()["op10_license_scans"](spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        got = licenses.scan(texts[r.doc_id])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.score) == tuple(got[c] for c in ("n_words", "n_base", "first_word", "last_word", "score"))
        assert (r.base_labels, r.labels) == (",".join(got["base_labels"]), ",".join(got["labels"]))


def test_every_notice_with_few_edits_is_found():
    rng = np.random.default_rng(2)
    for n in licenses.ALL:
        notice, label, most = n.text, n.label, n.edits
        for _ in range(20):
            letters = list(notice)
            for at in rng.choice(untold(n)[1:-1], most, replace=False):
                letters[at] = "q" if letters[at] != " " else " "
            assert label in licenses.scan("xx yy " + "".join(letters) + " zz")["labels"], "".join(letters)


@pytest.mark.parametrize("letter", ["\u00ad", "\u200b", "\U0001f600"])
@pytest.mark.parametrize("instead", [0, 1])
def test_every_notice_with_edits_of_several_bytes_is_found(letter, instead):
    rng = np.random.default_rng(4)
    for n in licenses.ALL:
        notice, label, most = n.text, n.label, n.edits
        inside = [i for i in untold(n) if 0 < i < len(notice) - 1 and notice[i] != " " and notice[i - 1] != " "]
        places = [inside[:most], inside[-most:], *(sorted(rng.choice(inside, most, replace=False)) for _ in range(20))]
        for chosen in places:
            text = notice
            for at in reversed(chosen):
                text = text[:at] + letter + text[at + instead :]
            got = licenses.scan(f"xx yy {text} zz")
            assert any(x["label"] == label and (x["start"], x["end"]) == (6, 6 + len(text)) for x in got["spans"]), text


def test_licenses_on_odd_tables(odd, none):
    got = {r.doc_id: r for r in licenses.scanned(odd, ["doc_id"]).collect()}
    assert got[6].base_labels == ["mit"] and got[4].n_words == 0 and got[5].n_words == 120_000
    assert licenses.scanned(none, ["doc_id"]).count() == 0


# --- tokens, packing and shards -------------------------------------------------------------------

STRANGE = [
    "", None, "a), b. c! d", "Foo's, don't. ABC123, 4.5. x", "ß. é, ñ. İ. İ, é, x", "tab\tx\x1cy z w, q", "<|endoftext|> hi",
    "ΑΣ ΑΣ, Σ. x", "a.\r\nb", "!!, ??. ...", "_, a_. b", "́, ́a.", "ab" * 3000, "'s 't, x's. 're",
]


def test_ids_are_those_of_the_tokenizer(texts):
    words = tokens.words(PATH)
    given = [*STRANGE, *list(texts.values())[:60]]
    ids, sizes = words.encode(tokens.pa.array(given))
    ends = np.cumsum(sizes)
    for text, n, end in zip(given, sizes, ends):
        assert ids[end - n : end].tolist() == words.tokenizer.encode(text or "", add_special_tokens=False).ids, text
    assert words.encode(tokens.pa.array(given).slice(5, 3))[1].tolist() == sizes[5:8].tolist()


def test_packing_query(spark, sf_dir, texts):
    rows = entry_point.queries()["op5_best_fit_packing"](spark, sf_dir).collect()
    encode, want = tokens.words(PATH).tokenizer.encode, []
    for doc, text in texts.items():
        ids = [*encode(text or "", add_special_tokens=False).ids, 1]
        parts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        want += [(doc, k, k * 4096, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    check_places(rows, 4096)


def check_places(rows, capacity):
    ends: dict = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(e <= capacity for e in ends.values())
    return len(ends)


def test_packing_is_near_the_bound_and_places_by_the_sum_of_squares():
    lengths = np.sort(np.random.default_rng(0).integers(1, 4000, 3000))[::-1]
    sequence, offset = packing.place(lengths, 4096)
    gaps: list = []
    for size in lengths.tolist():  # best fit by falling length
        fits = [g for g in gaps if g >= size]
        if fits:
            gaps.remove(min(fits))
        gaps.append((min(fits) if fits else 4096) - size)
    assert sequence.max() + 1 <= 1.01 * len(gaps)
    # Open gaps of 5 and 3 (twice): a piece of 3 leaves 2 behind in the first, or takes one of the pair.
    assert packing.place(np.array([5, 7, 7, 3]), 10)[0].tolist() == [0, 1, 2, 2]


def test_packing_on_odd_tables(odd, none):
    rows = packing.packed(odd, PATH, 4096).collect()
    check_places(rows, 4096)
    assert sum(r.length for r in rows if r.doc_id == 4) == 1 and len([r for r in rows if r.doc_id == 2]) == 2
    assert packing.packed(none, PATH).count() == 0


def test_slots_are_a_permutation():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        assert sorted(shards.permuted(np.arange(n), n, 7)) == list(range(n))
    assert shards.permuted(np.arange(1000), 1000, 7).tolist() != shards.permuted(np.arange(1000), 1000, 8).tolist()


def test_shards_hold_every_token_and_resume_from_any_slot(spark, docs, texts, tmp_path):
    path = str(tmp_path / "shards")
    one = docs.coalesce(1)
    total = shards.write(one, path, PATH, length=128, per_shard=64, seed=5)
    rows = shards.read(spark, path, length=128, per_shard=64).collect()
    assert sorted(r.slot for r in rows) == list(range(total))
    stream = []
    for r in one.collect():
        stream += [*tokens.words(PATH).tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
    want = [stream[i : i + 128] for i in range(0, len(stream), 128)]
    lengths = [len(w) for w in want]
    checks = [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    want[-1] += [shards.PAD_ID] * (128 - len(want[-1]))
    slots = shards.permuted(np.arange(total), total, 5)
    got = {r.slot: np.frombuffer(bytes(r.ids), "<u2").tolist() for r in rows}
    assert all(got[int(s)] == w for s, w in zip(slots, want))
    digests = {r.slot: r for r in shards.digests(shards.read(spark, path, length=128, per_shard=64)).collect()}
    for slot, n, check in zip(slots.tolist(), lengths, checks):
        r = digests[slot]
        assert (r.n_ids, r.ids_crc32, r.shard, r.byte_offset) == (n, check, slot // 64, slot % 64 * shards.stride(128))
    for file in (tmp_path / "shards").glob("shard=*/part-*"):
        k = int(file.parent.name.removeprefix("shard="))
        assert file.stat().st_size == shards.stride(128) * min(64, total - 64 * k)
    assert sorted(r.slot for r in shards.read(spark, path, 128, 64, start=100).collect()) == list(range(100, total))


def test_token_shards_on_odd_tables(spark, odd, none, tmp_path):
    assert shards.write(odd, str(tmp_path / "odd"), PATH, length=64) > 0
    assert shards.write(none, str(tmp_path / "none"), PATH) == 0


def test_digests_count_every_id(spark, tmp_path):
    """Id 0 is a token like any other, also where a sequence ends with it."""
    text = "!§!?!"
    ids = [*tokens.words(PATH).tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert 0 in ids
    for length in (1, 2, 3):
        path = str(tmp_path / f"s{length}")
        total = shards.write(spark.createDataFrame([(text,)], "text string"), path, PATH, length=length)
        rows = shards.digests(shards.read(spark, path, length=length)).collect()
        parts = [ids[i : i + length] for i in range(0, len(ids), length)]
        assert total == len(parts)
        assert sorted((r.n_ids, r.ids_crc32) for r in rows) == sorted((len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for p in parts)


def test_token_shards_query(spark, sf_dir, texts):
    """What the query returns, against the tokens of all texts."""
    rows = entry_point.queries()["op8_token_shards"](spark, sf_dir).collect()
    encode = tokens.words(PATH).tokenizer.encode
    total = sum(len(encode(t or "", add_special_tokens=False).ids) + 1 for t in texts.values())
    assert sum(r.n_ids for r in rows) == total
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert all(r.shard == r.slot // shards.PER_SHARD and r.byte_offset == r.slot % shards.PER_SHARD * shards.stride(1024) for r in rows)
    assert len([r for r in rows if r.n_ids < 1024]) <= spark.read.parquet(f"{sf_dir}/documents.parquet").rdd.getNumPartitions()


def test_wide_vocabularies_are_refused(spark, tmp_path):
    from tokenizers import Tokenizer
    from tokenizers.models import BPE

    path = str(tmp_path / "wide.json")
    Tokenizer(BPE({"a": 0, "b": 65535}, [])).save(path)
    with pytest.raises(ValueError, match="65535"):
        shards.write(spark.createDataFrame([("a",)], "text string"), str(tmp_path / "x"), path)


def test_words_are_remembered_up_to_a_bound(texts, monkeypatch):
    monkeypatch.setattr(tokens, "WORD_BYTES", 20_000)
    words, given = tokens.Words(PATH), list(texts.values())[:40]
    for text in given:
        ids, _ = words.encode(tokens.pa.array([text]))
        assert ids.tolist() == words.tokenizer.encode(text or "", add_special_tokens=False).ids
        new = 190 * len(set(text.split())) * 3 + 20 * len(text)
        assert words.held <= 20_000 + new


# --- sharding -------------------------------------------------------------------------------------


def check_shards(rows, number, texts=None):
    for k in range(number):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    return [sum(r["size"] for r in rows if r.shard == k) for k in range(number)]


def test_sharding_query(spark, sf_dir, texts):
    rows = entry_point.queries()["op7_sharding"](spark, sf_dir).collect()
    sizes = check_shards(rows, 8)
    assert all(r["size"] == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)


def test_a_hot_group_is_split_and_no_other(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i // 6}", "en", "s", 9) for i in range(6000)]
    df = spark.createDataFrame(rows, DOCS)
    got = sharding.shards(df, 8, tolerance=0.01).collect()
    sizes = check_shards(got, 8)
    assert max(sizes) - min(sizes) <= 0.03 * sum(sizes) / 8
    of: dict = {}
    for r in got:
        of.setdefault(rows[r.doc_id][1], set()).add(r.shard)
    assert len(of["same text"]) >= 2 and all(len(v) == 1 for k, v in of.items() if k != "same text")


def test_sharding_on_odd_tables(odd, none):
    rows = sharding.shards(odd, 3).collect()
    assert len(rows) == odd.count()
    check_shards(rows, 3)
    assert sharding.shards(none, 8).count() == 0


# --- embeddings -----------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize(("size", "heads"), [(4096, 2000), (40, 2000), (12, 3)])
def test_cover_tree_links_equal_brute_force(spark, monkeypatch, size, heads):
    """Loose points, dense groups of several widths, equal vectors; small parts make many pairs of trees, over levels of pivots."""
    monkeypatch.setattr(covertree, "HEADS", heads)
    monkeypatch.setattr(covertree, "PIVOTS", 64 if size > 12 else 5)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 8))
    for width in (0.02, 0.1, 0.2):
        x = np.concatenate([x, rng.normal(size=8) + width * rng.normal(size=(60, 8))])
    x = np.concatenate([x, x[:20] * 3, np.repeat(x[:1], 30, axis=0)])
    got = {r.vec_id: r for r in covertree.links(vectors(spark, [(i, v.tolist()) for i, v in enumerate(x)]), size=size).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (u @ u.T >= 0.95) & ~np.eye(len(u), dtype=bool)
    roots = reached(range(len(x)), zip(*map(np.ndarray.tolist, np.nonzero(np.triu(near)))))
    assert [got[i].n_links for i in range(len(x))] == near.sum(axis=1).tolist()
    assert {i: got[i].component_id for i in got} == roots
    assert all(got[i].kept == (roots[i] == i) for i in got)


def test_parts_of_clusters_do_not_all_meet(spark):
    """Groups far apart get centres and radii of their own, so most pairs of parts are never formed; large cells are taken apart."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([c + 0.15 * rng.normal(size=(40, 16)) for c in centres])
    rows = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "rep long, weight long, v array<double>")
    parts = covertree._parts(covertree._cells(rows, 20))
    number = parts.count()
    meet = covertree._meeting(parts, float(np.sqrt(0.1))).collect()
    assert number >= 30 and len(meet) < 0.3 * number * (number + 1) / 2
    assert all(m.i <= m.j for m in meet) and len(set(meet)) == len(meet)
    held = {r.part: covertree._restored(r.blob) for r in parts.collect()}
    assert sorted(i for p in held.values() for i in p.reps.tolist()) == list(range(len(x)))
    assert max(len(p.reps) for p in held.values()) <= 60
    place = {i: k for k, p in held.items() for i in p.reps.tolist()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    formed = {(m.i, m.j) for m in meet}
    for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.95))):
        a, b = sorted((place[i], place[j]))
        assert (a, b) in formed


def test_shadows_are_never_farther_apart():
    rng = np.random.default_rng(7)
    for d, k in ((64, 16), (5, 2), (300, 75)):
        x = covertree._unit(rng.normal(size=(60, d)) * rng.gamma(1, 1, d))
        s = covertree._shadows(x, rng.choice(d, k, replace=False)).astype(float)
        assert np.abs((s * s).sum(axis=1) - 1).max() < 1e-6
        assert (s @ s.T >= x @ x.T - 1e-6).all()


def test_vectors_that_cannot_link(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (2, [1e-200, 0.0]), (9, [1e300, 1e299])]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in covertree.links(vectors(spark, rows)).collect())
    assert got == [(1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 3, 1)]
    assert covertree.links(vectors(spark, [(3, None)])).count() == 1 and covertree.links(vectors(spark, [])).count() == 0


def test_embedding_query(spark, sf_dir, duck):
    rows = entry_point.queries()["op6_embedding_near_dedup"](spark, sf_dir).collect()
    want = duck.execute("""SELECT a.vec_id, count(b.vec_id) FROM embeddings a LEFT JOIN embeddings b ON a.vec_id <> b.vec_id
        AND list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.95 GROUP BY ALL""").fetchall()
    assert sorted((r.vec_id, r.n_links) for r in rows) == sorted(want)


def test_topk_on_awkward_vectors(spark):
    same = [(i, [1.0] * 64) for i in range(1, 31)]
    rows = [*same, (0, [1.0] * 63 + [-1.0]), (100, [-1.0] * 64), (200, None), (300, []), (400, [None] * 64), (100, [-1.0] * 64)]
    got = topk.search(vectors(spark, rows), F.col("vec_id") % 100 == 0, k=3)
    found = sorted((r.vec_id, r["rank"], r.neighbor_id, r.distance) for r in got.collect())
    assert found == [(0, 1, 1, 1), (0, 2, 2, 1), (0, 3, 3, 1), (100, 1, 0, 63), (100, 2, 1, 64), (100, 3, 2, 64)]
    assert topk.search(vectors(spark, []), F.lit(True)).count() == 0


@pytest.mark.parametrize("size", [63, 64, 65, 128])
def test_topk_takes_every_component(spark, size):
    """Codes of one and two words, against all pairs; an id repeated more often than k."""
    rng = np.random.default_rng(size)
    x = rng.normal(size=(120, size))
    x[60:100] = x[:40] * np.where(rng.random((40, size)) < 0.1, -1, 1)
    x[100] = np.concatenate([x[0, :-1], -x[0, -1:]])  # differs from the first in its last component only
    ids = [*range(110), *[100] * 5, *[7] * 5]
    rows = [(i, v.tolist()) for i, v in zip(ids, x)] + [(500, x[3, : size - 1].tolist())]
    got = sorted(tuple(r) for r in topk.search(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=4, cell=16).collect())
    signs = np.array([np.pad(np.array(v) > 0, (0, size - len(v))) for _, v in rows])
    want = []
    for q in sorted({(i, tuple(s)) for (i, _), s in zip(rows, signs.tolist()) if i % 20 == 0}):
        near = sorted((int((np.array(q[1]) != s).sum()), i) for (i, _), s in zip(rows, signs) if i != q[0])
        want.append((q[0], near))
    for i in {q for q, _ in want}:
        near = sorted({(d, j, n) for q, found in want if q == i for n, (d, j) in enumerate(found)}, key=lambda x: x[:2])
        own = [(r, j, d) for v, r, j, d in got if v == i]
        assert [r for r, _, _ in own] == [1, 2, 3, 4]
        assert [d for _, _, d in own] == [d for d, _, _ in near][:4] or len([q for q, _ in want if q == i]) > 1
    assert (0, 1, 100, 1) in got


# --- pipeline -------------------------------------------------------------------------------------


def test_pipeline_equals_a_plain_version(spark, sf_dir, docs, texts):
    """The stages' decisions, made here row by row with the learned model, automata and schedule as given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels)
    match = toxicity.Matcher(model.entries)
    left = {d: t for d, t in texts.items() if model.score(toxicity.hits(t, match)) < corpus_pipeline.TOXIC_FROM}
    marks = {d: plain_fingerprint(t) for d, t in left.items()}
    ids = sorted(left)
    roots = reached(ids, [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (marks[a] ^ marks[b]).bit_count() <= 4])
    left = {d: t for d, t in left.items() if roots[d] == d}
    formats = secrets.learn(docs.where(F.col("doc_id").isin(list(left))))
    left = {d: secrets.redact(t, secrets.spans(t, formats)) for d, t in left.items()}
    source = {r.doc_id: r.source for r in docs.collect()}
    now = spark.createDataFrame([(d, t, "en", source[d], 0) for d, t in left.items()], DOCS)
    copies = {r.doc_id: r.copies for r in mixing.counted(now, mixing.Target(repeats=corpus_pipeline.REPEATS)).collect()}
    assert min(copies.values()) >= 1
    encode, want = tokens.words(PATH).tokenizer.encode, []
    for d, t in left.items():
        ids = [*encode(t, add_special_tokens=False).ids, 1]
        parts = [ids[i : i + 4096] for i in range(0, len(ids), 4096)]
        want += [(d, k, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, p in enumerate(parts)] * copies[d]
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows) == sorted(want)
    check_places(rows, corpus_pipeline.CAPACITY)


def test_stages_keep_the_columns_of_documents(spark, sf_dir, docs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash_near_dedup", "secret_scans", "source_mixing", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(40), sf_dir).schema.simpleString() == docs.schema.simpleString()

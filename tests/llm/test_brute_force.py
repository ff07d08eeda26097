"""Operators against plain Python on small fixtures."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import sentencepiece
from conftest import SMALL
from llm_cases import documents  # noqa: F401
from pyspark.sql import functions as F

from stopwise.llm import fingerprints, language, mixing, ngram_join, pieces, substring_dedup
from stopwise.llm.components import components
from stopwise.llm.fm_index import FMIndex
from stopwise.llm.hashing import words_of_texts
from stopwise.llm.queries import PIECES, REGISTRY
from stopwise.llm.text import written
from stopwise.llm.url_filter import Cascade, UrlRule, filter_urls
from stopwise.llm import line_dedup as lines_module

GAP = re.compile("[\x20\x09-\x0d]+")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def texts_of(spark, sf=SMALL):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


# ---------------------------------------------------------------- pieces


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load(PIECES)


def test_ids_are_those_of_the_library(spark, vocabulary):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coder = pieces.Coder(vocabulary)
    for text in texts_of(spark).values():
        assert coder.encode(text) == library.encode(text)


def test_caches_that_overflow_change_nothing(vocabulary, monkeypatch, spark):
    monkeypatch.setattr(pieces, "CACHED_BYTES", 3_000)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coder = pieces.Coder(vocabulary)
    for text in list(texts_of(spark).values())[:60]:
        whole = pieces.escaped(text)
        coder.learn([whole])
        assert np.frombuffer(coder.packed_ids(whole), np.int32).tolist() == library.encode(text)
        assert coder.others.bytes <= 3_000 + 64 * 5


def test_chunks_give_the_ids_of_whole_texts(spark, documents, vocabulary):
    random.seed(3)
    parts = ["the", "ing", " ", "  ", "    ", "\n", "é", "日本", "==", "AKIA", "▁", "er", "b", "😀"]
    made = ["".join(random.choices(parts, k=600)) for _ in range(20)]
    made += ["".join(random.choices(parts, k=900)).replace(" ", "").replace("\n", "") for _ in range(10)]
    df = documents(list(enumerate(made)))
    coder = pieces.Coder(vocabulary)
    out = pieces.encode(df, vocabulary, chunk=100, giant=150)
    rows = out.withColumn("back", pieces.decoded(F.col("ids"), vocabulary)).collect()
    assert len(rows) == len(made)
    for row in rows:
        assert list(row["ids"]) == coder.encode(row["text"])
        assert row["back"] == row["text"]


def test_transfer_matrices_combine_associatively(vocabulary):
    coder = pieces.Coder(vocabulary)
    text = pieces.escaped("unbelievableinternationalisation" * 20)
    edges = [0, 150, 300, 450, len(text)]
    matrices = [coder.transfer(text, a, b) for a, b in zip(edges, edges[1:])]
    left = pieces.combine(pieces.combine(matrices[0], matrices[1]), matrices[2])
    right = pieces.combine(matrices[0], pieces.combine(matrices[1], matrices[2]))
    assert np.array_equal(left, right)
    whole = coder.transfer(text, 0, 450)
    assert np.array_equal(whole, left)


def test_query_round_trips(spark):
    rows = REGISTRY["op3_sentencepiece"](spark, SMALL).collect()
    texts = texts_of(spark)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)
    for row in rows:
        ids = np.array(library.encode(texts[row["doc_id"]]), "<i4").tobytes()
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
    for row in rows:
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()


# ---------------------------------------------------------------- substrings


def brute_substrings(rows, window=13):
    least = {}
    for doc_id, text in rows:
        own = words(text)
        for k in range(len(own) - window + 1):
            key = tuple(own[k : k + window])
            least[key] = min(doc_id, least.get(key, doc_id))
    for doc_id, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if least[tuple(own[k : k + window])] < doc_id:
                gone[k : k + window] = [True] * window
        kept = [w for w, g in zip(own, gone) if not g]
        yield doc_id, len(own), sum(gone), " ".join(kept)


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_against_all_windows(spark, documents, seed):
    random.seed(seed)
    vocabulary = [f"w{i}" for i in range(40)]
    passages = [random.choices(vocabulary, k=random.randint(5, 40)) for _ in range(12)]
    rows = []
    for doc_id in random.sample(range(1000), 60):
        body = []
        for _ in range(random.randint(0, 6)):
            passage = random.choice(passages)
            cut = random.randint(0, 8)
            body += passage[cut:] + random.choices(vocabulary, k=random.randint(0, 10))
        rows.append((doc_id, random.choice([" ", "\n", "\t "]).join(body)))
    rows.append((2000, "same " * 100))
    rows.append((2001, "same " * 50))
    out = substring_dedup.substring_dedup(documents(rows).repartition(5), docs_a_shard=9)
    got = {(r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in out.collect()}
    assert got == set(brute_substrings(rows))


def test_substring_query(spark):
    want = {
        (d, n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for d, n, gone, kept in brute_substrings(sorted(texts_of(spark).items()))
    }
    got = {tuple(r) for r in REGISTRY["op6_substring_dedup"](spark, SMALL).collect()}
    assert got == want


def test_index_finds_all_places():
    random.seed(5)
    text = np.array([random.randint(1, 4) for _ in range(3000)] + [0])
    index = FMIndex(text)
    patterns = np.array([text[k : k + 7] for k in range(0, 2900, 13)])
    low, high = index.intervals(patterns)
    for pattern, a, b in zip(patterns, low, high):
        want = {k for k in range(len(text) - 6) if (text[k : k + 7] == pattern).all()}
        assert set(index.order[a:b].tolist()) == want


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["a b", None, "  ab\x0bb a\x0c", "é" * 5000 + " x", "", "a"]
    found = words_of_texts(pa.array(texts))
    assert np.diff(found.first).tolist() == [len(words(t)) for t in texts]
    by_word = {}
    for k, text in enumerate(texts):
        own = found.hashes[found.first[k] : found.first[k + 1]].tolist()
        for word, value in zip(words(text), own):
            assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)


# ---------------------------------------------------------------- n-gram join


def brute_components(rows, percent, size):
    lower = {65 + k: 97 + k for k in range(26)}
    sets = {}
    for doc_id, text in rows:
        own = words((text or "").translate(lower))
        grams = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)}
        sets[doc_id] = grams or ({tuple(own)} if own else set())
    least = {d: d for d in sets}

    def root(d):
        while least[d] != d:
            d = least[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return {(d, len(sets[d]), root(d)) for d in ids}


@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5), (60, 2)])
def test_components_against_all_pairs(spark, documents, percent, size):
    random.seed(percent)
    vocabulary = [f"v{i}" for i in range(300)]
    boilerplate = random.choices(vocabulary, k=30)
    rows = []
    for group in range(12):
        text = random.choices(vocabulary, k=random.randint(1, 90))
        for copy in range(random.choice([1, 2, 9])):
            text = list(text)
            for _ in range(random.choice([0, 1, 1, 3])):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            shared = boilerplate if random.random() < 0.5 else []
            body = " ".join(shared + text)
            rows.append((len(rows) * 7 % 101, body.upper() if copy % 3 == 1 else body))
    rows += [(500, ""), (501, None), (502, "A"), (503, "a"), (504, "a b")]
    out = ngram_join.joined(documents(rows), ngram_join.Similarity(percent, size))
    assert {tuple(r) for r in out.collect()} == brute_components(rows, percent, size)


@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5), (60, 2), (50, 1)])
def test_short_texts_link_to_those_with_one_more_word(spark, documents, percent, size):
    random.seed(size)
    rows = []
    for length in range(1, 24):
        text = [f"s{length}_{k}" for k in range(length)]
        longer = [[*text, "more"], ["first", *text], [*text, "more", "still"]]
        for body in random.sample([text, *longer], 4):
            rows.append((len(rows) * 37 % 1009, " ".join(body)))
    want = brute_components(rows, percent, size)
    out = ngram_join.joined(documents(rows), ngram_join.Similarity(percent, size))
    assert {tuple(r) for r in out.collect()} == want


@pytest.mark.parametrize("paired", [0, 3])
@pytest.mark.parametrize("percent, size", [(90, 3), (80, 5), (60, 2)])
def test_components_where_members_are_counted(spark, documents, monkeypatch, paired, percent, size):
    monkeypatch.setattr(ngram_join, "PAIRED", paired)
    random.seed(percent + paired)
    vocabulary = [f"v{i}" for i in range(150)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for group in range(25):
        text = random.choices(vocabulary, k=random.randint(8, 70))
        for copy in range(random.choice([1, 2, 6])):
            text = list(text)
            for _ in range(random.choice([0, 1, 2, 5])):
                text[random.randrange(len(text))] = random.choice(vocabulary)
            rows.append((len(rows) * 37 % 1009, " ".join(passage[: random.choice([0, 20, 40])] + text)))
    out = ngram_join.joined(documents(rows), ngram_join.Similarity(percent, size))
    assert {tuple(r) for r in out.collect()} == brute_components(rows, percent, size)


def test_texts_that_share_a_passage_are_not_paired(spark, documents, monkeypatch):
    random.seed(8)
    common = [f"c{i}" for i in range(40)]
    passage = [f"p{i}" for i in range(30)]
    # The first is too long to link to any other, so that as a pivot it settles nothing.
    rows = [(k, " ".join(passage + random.choices(common, k=70 if k else 500))) for k in range(120)]
    rows.append((200, f"{rows[7][1]} more"))
    pairs = {}

    def counting(spark, df, label):
        table = written(spark, df, label)
        pairs[label] = table.count()
        return table

    monkeypatch.setattr(ngram_join, "written", counting)
    out = ngram_join.joined(documents(rows), ngram_join.Similarity(80, 5))
    assert {tuple(r) for r in out.collect()} == brute_components(rows, 80, 5)
    assert pairs["ngram-unsettled"] <= len(rows)


def test_chain_of_near_copies_is_one_component(spark, documents):
    base = [f"t{i}" for i in range(200)]
    rows = []
    for step in range(40):
        rows.append((900 - step, " ".join(base)))
        base = base[3:] + [f"n{step}_{k}" for k in range(3)]
    out = ngram_join.joined(documents(rows), ngram_join.Similarity(90, 3)).collect()
    assert {r["component_id"] for r in out} == {861}


def test_join_query(spark):
    got = {tuple(r) for r in REGISTRY["op10_ngram_join"](spark, SMALL).collect()}
    assert got == brute_components(sorted(texts_of(spark).items()), 90, 3)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 160)]
    star = [(1, k) for k in range(2, 60)]
    df = spark.createDataFrame(chain + star + [(900, 900), (70, 70)], "u long, v long")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 60)}}


# ---------------------------------------------------------------- fingerprints


def test_fingerprint_query_row_by_row(spark):
    texts = texts_of(spark)
    ids = sorted(texts)
    rows = {r["doc_id"]: r for r in REGISTRY["op1_fingerprints"](spark, SMALL).collect()}
    assert sorted(rows) == ids
    for k, doc_id in enumerate(ids):
        text, nxt = texts[doc_id], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + nxt[:half]
        row = rows[doc_id]
        own, changed, other = fingerprints._hex(fingerprints.fingerprint_texts([text, edited, nxt]))
        assert (row["fingerprint"], row["edited_fingerprint"]) == (own, changed)
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for near, against in ((row["near_edited"], changed), (row["near_next"], other)):
            share = sum(a == b for a, b in zip(own, against)) / fingerprints.SAMPLES
            assert near == pytest.approx(max(0, (share - 1 / 16) / (15 / 16)))


def test_parts_do_not_show_in_fingerprints(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    one = fingerprints.with_next_edited(docs, rows_a_part=10_000)
    many = fingerprints.with_next_edited(docs.repartition(7), rows_a_part=6)
    assert sorted(one.collect()) == sorted(many.collect())


def test_likeness_falls_with_edits(spark):
    text = max(texts_of(spark).values(), key=len)[:6000]

    def near(other):
        a, b = fingerprints.fingerprint_texts([text, other])
        return float(fingerprints._likeness(a[None], b[None])[0])

    inserted = text[:500] + "one more word " + text[500:]
    replaced = text[:3000] + text[:3000][::-1]
    assert near(text) == 1.0
    assert near("x" + text) > 0.85 and near(inserted) > 0.5
    assert 0.35 < near(replaced) < 0.65
    assert near(text[::-1]) < 0.25


def test_bands_find_near_copies(spark, documents):
    texts = sorted(texts_of(spark).values(), key=len)[-12:]
    rows = [(10 * k, t[:3000]) for k, t in enumerate(texts)]
    rows += [(10 * k + 1, t[:3000]) for k, t in enumerate(texts)]
    rows += [(10 * k + 2, t[:2900] + "another end") for k, t in enumerate(texts)]
    out = fingerprints.near_classes(documents([*rows, (None, texts[0][:3000])])).collect()
    assert {r["doc_id"]: r["class_id"] for r in out} == {
        **{d: d - d % 10 for d, _ in rows},
        None: None,
    }


# ---------------------------------------------------------------- language, mixing, URLs, lines


def test_language_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    rows = REGISTRY["op8_language_id"](spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    right = sum(r["lang"] == r["lang_pred"] for r in rows)
    assert right >= 0.97 * len(rows)
    assert all(r["lang"] == r["lang_pred"] for r in rows if r["score"] > 0.2)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_ignores_labels_of_held_out_documents(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(), "zz").otherwise(F.col("lang")))
    a, b = (language.train(d.where(~language.held_out())) for d in (docs, wrong))
    assert a == b
    odd = documents([(1, None), (2, "123 !?"), (3, "Ünd")])
    got = {r["doc_id"]: r for r in language.identify(odd, a).collect()}
    assert got[1]["lang_pred"] == got[2]["lang_pred"] == "und" and got[3]["lang_pred"] != "und"


def test_language_of_mostly_copies_is_learned(spark, documents):
    few = documents([(k, f"kopia numero{'abcdefghij'[k]} teksto", "xx") for k in range(10)])
    many = documents([(k, f"sama{k % 26:c<3} vorto{'x' * (k % 50)}y{'z' * (k // 50)}", "yy") for k in range(300)])
    copies = documents([(0, "unu kopio", "yy")]).crossJoin(spark.range(20_000)).drop("id")
    rows = few.crossJoin(spark.range(3000)).drop("id").unionByName(many).unionByName(copies)
    model = language.train(rows)
    assert sorted(model.contents) == ["xx", "yy"]
    for doc in [*few.collect(), *many.collect(), *copies.limit(1).collect()]:
        assert language._spoken(doc["text"]) in model.contents[doc["lang"]]
    judged = language.identify(few, model).collect()
    assert {r["lang_pred"] for r in judged} == {"xx"}


def test_mix_reaches_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = mixing.mix(mixing.sized_documents(docs), rows_a_range=20)
    again = mixing.mix(mixing.sized_documents(docs.repartition(9)), rows_a_range=300)
    assert sorted(plan.collect()) == sorted(again.collect())
    by_source = plan.groupBy("source").agg(
        F.first("target").alias("target"), F.sum("taken").alias("taken"), F.max("size").alias("size")
    )
    for row in by_source.collect():
        assert abs(row["taken"] - row["target"]) <= row["size"] / 2 + 1
    assert plan.where("taken > 3 * size").count() == 0


def test_targets_stop_at_three_times_a_source(spark):
    sources = spark.createDataFrame(
        [("a", 100, 1), ("b", 10, 1), ("c", 0, 1), (None, 1, 1)], "source string, source_size long, n_docs long"
    )
    got = {r["source"]: r["target"] for r in mixing.targets(sources).collect()}
    assert got["b"] == 30.0 and got["c"] == 0.0 and got[None] == 3.0 and got["a"] == pytest.approx(78.0)


def test_mixed_rows_are_repeated(spark, documents):
    docs = documents([(1, "a b c", "en", "s"), (2, "d e f", "en", "t"), (3, "g", "en", "t")])
    plan = {r["doc_id"]: r["repeats"] for r in mixing.mix(mixing.sized_documents(docs)).collect()}
    rows = [r["doc_id"] for r in mixing.mixed_documents(docs).collect()]
    assert sorted(rows) == sorted(d for d, n in plan.items() for _ in range(n))


def test_rows_without_ids_of_their_own_are_cut(spark, documents):
    rows = [(None if k % 3 else 7, f"w{k} " * (1 + k % 4), "en", f"s{k % 2}") for k in range(240)]
    docs = documents(rows)
    taken = mixing.mixed_documents(docs).groupBy("source").agg(F.sum(F.size(F.split(F.trim("text"), " "))).alias("n"))
    sizes = mixing.sized_documents(docs).groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    for row in taken.collect():
        assert abs(row["n"] - targets[row["source"]]) <= 3


def test_cascade_is_exact_over_its_universe(spark):
    listed = spark.range(0, 3000, 7).selectExpr("cast(id as string) as key")
    universe = spark.range(20_000).selectExpr("cast(id as string) as key")
    cascade = Cascade.build(spark, listed, universe)
    got = {r["key"] for r in universe.where(cascade.lists(F.col("key"))).collect()}
    assert len(cascade.levels) > 1
    assert got == {str(k) for k in range(0, 3000, 7)}


def test_filter_and_join_agree(spark):
    urls = ["http://A.example.com/en/x", "https://www.example.com/en/", "ftp://x.net/es/1?q", "//x", None,
            "http://xnet/es/", "http://net/fr/#a", "http://example.com", "http://b.com:80/en/", "a://b://c.com/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rules = [UrlRule("com", "/", "allow"), UrlRule("example.com", "/en/", "block"),
             UrlRule("www.example.com", "/en/", "allow"), UrlRule("net", "/es/", "block"), UrlRule("net", "", "block")]
    a = filter_urls(df, rules).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, filter_urls(df, rules, max_filtered=0).collect()))
    verdicts = {r["url"]: (r["rule"], r["verdict"]) for r in a}
    assert verdicts["http://A.example.com/en/x"] == ("example.com/en/", "block")
    assert verdicts["https://www.example.com/en/"] == ("www.example.com/en/", "allow")
    assert verdicts["http://net/fr/#a"] == ("net", "block")
    assert verdicts["http://example.com"] == (None, "allow") and verdicts[None] == (None, "allow")


def test_colliding_chunk_hashes_are_told_apart(spark, documents, monkeypatch):
    whole = lines_module._hash
    monkeypatch.setattr(lines_module, "_hash", lambda lines: F.pmod(whole(lines), F.lit(3)))
    random.seed(9)
    made = [f"line {k}" for k in range(60)]
    rows = [(d, "\n".join(random.choices(made, k=12) + made[:9])) for d in range(30)]
    few = {tuple(r) for r in lines_module.line_dedup(documents(rows)).collect()}
    monkeypatch.setattr(lines_module, "_hash", whole)
    assert few == {tuple(r) for r in lines_module.line_dedup(documents(rows)).collect()}


def test_round_trips_are_checked_where_ids_are_made(spark, documents, vocabulary):
    texts = ["plain words", "▁ odd  😀\n\n", "", None, "x" * 500, "long words of it " * 40]
    df = documents(list(enumerate(texts)), ids=F.lit("old"), ok=F.lit("old"), _checked=F.lit(1))
    out = pieces.encode(df, vocabulary, chunk=100, giant=300, round_trip="ok")
    assert sorted(out.columns) == sorted(df.columns)
    plain = {r["doc_id"]: r["ids"] for r in pieces.encode(df, vocabulary, chunk=100, giant=300).collect()}
    for row in out.collect():
        assert row["ok"] is True and row["ids"] == plain[row["doc_id"]] and row["_checked"] == 1

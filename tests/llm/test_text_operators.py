"""Operators over whole texts against plain Python versions, odd inputs included."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ebbtide.llm import bpe, decontaminate, langid, ngram_join, pii, sharding, substring_dedup
from ebbtide.llm.components import components
from ebbtide.llm.scratch import ship

from . import brute


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def by_id(df, key="doc_id"):
    rows = [r.asDict() for r in df.collect()]
    return {r[key]: r for r in rows}, rows


# 1 substring dedup ------------------------------------------------------------


def test_matching_statistics():
    rng = np.random.default_rng(0)
    for _ in range(60):
        held = [rng.integers(1, 4, rng.integers(1, 15)) for _ in range(rng.integers(1, 6))]
        index = substring_dedup.FMIndex(held, 3)
        asked = [rng.integers(0, 4, rng.integers(1, 20)) for _ in range(4)]
        holds = lambda p, held=held: any((s[i : i + len(p)] == p).all() for s in held for i in range(len(s) - len(p) + 1))
        for live, at, depth, low, high in index.matching_statistics(asked):
            for q, a, d in zip(live, at, depth, strict=True):
                n = 0
                while a + n < len(asked[q]) and asked[q][a + n] > 0 and holds(asked[q][a : a + n + 1]):
                    n += 1
                assert n == d
            assert (low < high).all() or (depth[low >= high] == 0).all()


@pytest.mark.parametrize("options", [{}, {"hot_rows": 2, "shard_words": 300}, {"window": 20, "gram": 4}])
def test_substring_dedup(edge_docs, edge_texts, options):
    got, rows = by_id(substring_dedup.deduplicate(edge_docs, **options))
    assert len(rows) == len(edge_texts) + 1
    for i, (n, kept) in brute.removed_words(edge_texts, options.get("window", 50)).items():
        text = b" ".join(kept)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept"]) == (n, n - len(kept), text.decode())
        assert got[i]["kept_sha256"] == hashlib.sha256(text).hexdigest()


def test_substring_dedup_without_rows_or_ids(spark, no_docs):
    assert substring_dedup.deduplicate(no_docs).collect() == []
    text = " ".join(map(str, range(80)))
    rows = spark.createDataFrame([(None, text), (5, text), (7, text), (None, None)], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in substring_dedup.deduplicate(rows).collect()) == [(0, 0), (0, 0), (5, 0), (7, 80)]


# 3 n-gram join ----------------------------------------------------------------


def test_parities_bound_the_shingles_apart():
    rng = np.random.default_rng(4)
    for n, apart in ((1, 1), (30, 4), (400, 60), (5000, 900)):
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.union1d(x[apart // 2 :], rng.integers(0, 2**64, apart - apart // 2, dtype=np.uint64))
        p, q = ngram_join.parities(x), ngram_join.parities(y)
        differ = sum(int(a ^ b).bit_count() for a, b in zip(p.view(np.uint64).tolist(), q.view(np.uint64).tolist(), strict=True))
        assert differ <= len(np.setxor1d(x, y)) and (differ > 0) == (len(np.setxor1d(x, y)) > 0)
    far = [ngram_join.parities(rng.integers(0, 2**64, 100, dtype=np.uint64)).view(np.uint64).tolist() for _ in range(2)]
    assert sum((a ^ b).bit_count() for a, b in zip(*far, strict=True)) > 200 - 2 * 89  # unlike sets of 100: more than a link allows


@pytest.mark.parametrize("rounds", [0, 1, 5])
def test_ngram_join(edge_docs, edge_texts, rounds):
    got, rows = by_id(ngram_join.near_duplicates(edge_docs, rounds=rounds))
    sizes, roots = brute.jaccard_components(edge_texts)
    assert len(rows) == len(edge_texts) + 1
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == {i: (sizes[i], roots[i]) for i in sizes}
    assert got[11]["class_id"] == 10 and got[12]["class_id"] == 10


def test_ngram_join_large_groups(spark):
    """Groups of near copies, some linked only through others, and a passage that all share."""
    rng = random.Random(3)
    shared = " ".join(f"p{k}" for k in range(30))
    texts, i = {}, 0
    for g in range(6):
        base = [f"g{g}w{k}" for k in range(60)]
        for _ in range(40):
            own = list(base)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(60)] = f"u{rng.random()}"
            texts[i] = " ".join(own) + " " + shared
            i += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    _, roots = brute.jaccard_components(texts)
    for rounds in (0, 2, 5):
        got, _ = by_id(ngram_join.near_duplicates(docs, rounds=rounds))
        assert {k: r["component_id"] for k, r in got.items()} == roots


@pytest.mark.parametrize("rounds", [0, 5])
def test_ngram_join_through_rows_without_ids(spark, rounds):
    base = [f"w{k}" for k in range(60)]
    left, right = " ".join([*base, *(f"l{k}" for k in range(8))]), " ".join([*(f"r{k}" for k in range(8)), *base])
    alone = " ".join(f"z{k}" for k in range(60))
    rows = [(4, left), (None, " ".join(base)), (None, " ".join(base)), (9, right), (None, alone), (None, alone + " end"), (7, "three other words")]
    out = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), rounds=rounds).collect()
    got = sorted((r.doc_id or 0, r.component_id, r.class_id) for r in out if r.component_id is not None)
    assert got == [(0, 4, None), (0, 4, None), (4, 4, 4), (7, 7, 7), (9, 4, 9)]
    assert [(r.doc_id, r.class_id) for r in out if r.component_id is None] == [(None, None)] * 2


def test_ngram_join_without_rows(no_docs, spark):
    assert ngram_join.near_duplicates(no_docs).collect() == []
    lone = spark.createDataFrame([(None, "a b c d e f"), (4, None)], "doc_id bigint, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(lone).collect()} == {(None, 2, None), (4, 0, 4)}


def test_suffix_filter_is_an_upper_bound():
    rng = np.random.default_rng(1)
    for _ in range(300):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(2))
        both = len(np.intersect1d(x, y))
        assert ngram_join.may_overlap(x, y, both)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)]
    u = brute.Union({n for e in edges for n in e})
    for a, b in edges:
        u.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: u.find(n) for a, b in edges if a != b for n in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


# 4 decontamination ------------------------------------------------------------

ITEMS = [(1, "The quick brown fox jumps over the lazy dog and runs away from it all"), (2, "tiny item"), (3, "x"), (4, None), (5, ""), (None, "no id for this item here at all, is there one"), (1, "second text of the first item is this one here now ok")]


@pytest.mark.parametrize("limit", [1 << 20, 20])
def test_decontamination(spark, limit):
    texts = {
        0: "before THE QUICK, brown fox jumps over the lazy dog and runs after", 1: "a tiny   Item; x", 2: None, 3: "", 4: "nothing of the kind",
        5: "the quick brown fox jumps over the lazy cat", 6: "no id for this item here at all is there one two", 7: "x " * 20_000, 8: "y" * 100_000,
        9: "the quick brown fox jumps over the lazy dog and runs away from it all the quick brown fox jumps over the lazy dog and",
    }
    rows = [(i, t, 1, "z") for i, t in texts.items()]
    docs = spark.createDataFrame([*rows, rows[0], (None, "tiny item", 1, "z")], "doc_id bigint, text string, fp int, spans string").repartition(2)
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    got, all_rows = by_id(decontaminate.contamination(docs, bench, limit=limit))
    assert len(all_rows) == len(rows) + 2 and got[None]["n_hit"] == 2
    for i, (n, hit, items) in brute.contaminated(texts, ITEMS).items():
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(items), hit > 0), i
        assert r["items_sha256"] == hashlib.sha256(",".join(items).encode()).hexdigest()
    clean = decontaminate.keep_clean(docs, bench, limit=limit)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, r in got.items() if not r["n_hit"]}


def test_decontamination_without_rows(spark, no_docs, edge_docs):
    bench = spark.createDataFrame(ITEMS, "item_id int, text string")
    assert decontaminate.contamination(no_docs, bench).collect() == []
    assert not decontaminate.contamination(edge_docs, bench.limit(0)).filter("n_hit > 0").count()
    assert decontaminate.keep_clean(edge_docs, bench.limit(0)).count() == edge_docs.count()


# 5 sharding -------------------------------------------------------------------


def test_sharding(edge_docs, edge_texts):
    got, rows = by_id(sharding.shard(edge_docs, n_shards=4, n_slots=64))
    assert len(rows) == len(edge_texts) + 1
    places: dict[int, list[int]] = {}
    for r in rows:
        text = (edge_texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        places.setdefault(r["shard"], []).append(r["slot"])
    assert set(places) <= set(range(4)) and all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_balances_and_grows_into_the_new_shard_only(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    slotted = sharding.with_slots(docs, 512)
    one = sharding.first_map(sharding.slot_bytes(slotted), 6).cache()
    loads = {r.shard: r.b for r in one.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert set(loads) == set(range(6)) and max(loads.values()) < 1.01 * min(loads.values())
    two = sharding.add_shard(one, 6).cache()
    before, after = ({r.virtual_slot: (r.version, r.shard) for r in m.collect()} for m in (one, two))
    assert {v for v, _ in after.values()} == {2} and before.keys() == after.keys()
    assert all(after[s][1] in (before[s][1], 6) for s in before)
    grown = {r.shard: r.b for r in two.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    assert set(grown) == set(range(7)) and max(grown.values()) < 1.1 * min(grown.values())


def test_slot_maps_are_versioned(spark, edge_docs, tmp_path):
    one = sharding.first_map(sharding.slot_bytes(sharding.with_slots(edge_docs, 16)), 2)
    path = str(tmp_path / "maps")
    sharding.save_map(one, path)
    sharding.save_map(sharding.add_shard(sharding.load_map(spark, path), 2), path)
    assert sharding.load_map(spark, path).first().version == 2
    assert sorted(map(tuple, sharding.load_map(spark, path, 1).collect())) == sorted(map(tuple, one.collect()))


def test_sharding_without_rows(no_docs):
    assert sharding.shard(no_docs).collect() == []


# 6 personal data --------------------------------------------------------------


def test_base_spans_match_the_patterns():
    rng = random.Random(1)
    for _ in range(30_000):
        t = "".join(rng.choice("a.@1 2-+9(0)_5%:é") for _ in range(rng.randrange(1, 40)))
        assert brute.base_spans(t) == pii.base_spans(t), t
    for t in ("a" * 200_000, "1" * 200_000, "1." * 100_000, "@" * 100_000, "a@" * 50_000, "+1" + "(" * 100_000):
        pii.all_spans(t)  # linear time


@pytest.mark.parametrize(("text", "found"), [
    ("mail bob.smith (at) example (dot) com now", ["bob.smith (at) example (dot) com"]),
    ("write jane at mail dot example dot org.", ["jane at mail dot example dot org"]),
    ("call plus one two one two five five five one two three four now", ["plus one two one two five five five one two three four"]),
    ("jоhn＠exаmple.com x", ["jоhn＠exаmple.com"]),
    ("at 10[.]0[.]0[.]1!", ["10[.]0[.]0[.]1"]),
    ("four one one one 1111 1111 1111", ["four one one one 1111 1111 1111"]),
    ("a​@b.com and c@d.org", ["a​@b.com", "c@d.org"]),
    ("host eight point eight point eight point eight ok", ["eight point eight point eight point eight"]),
    ("host eight-dot-eight-dot-eight-dot-eight ok", ["eight-dot-eight-dot-eight-dot-eight"]),
    ("acht punkt acht punkt acht punkt acht", ["acht punkt acht punkt acht punkt acht"]),
    ("ocho punto ocho punto ocho punto ocho", ["ocho punto ocho punto ocho punto ocho"]),
    ("at 192 dot 168 dot 1 dot 10!", ["192 dot 168 dot 1 dot 10"]),
    ("at 192-dot-168-dot-one-dot-10!", ["192-dot-168-dot-one-dot-10"]),
    ("at 192.168 punkt 1 point 10!", ["192.168 punkt 1 point 10"]),
    ("eight (dot) eight [.] eight.eight", ["eight (dot) eight [.] eight.eight"]),
    ("call plus one two one two double five five one two three four now", ["plus one two one two double five five one two three four"]),
    ("double four one one 1111 1111 1111, double 5", []),
    ("four double one one 1111 1111 1111, double 5", ["four double one one 1111 1111 1111"]),
    ("call plus 49 30 1234567", ["plus 49 30 1234567"]),
    ("mail bob at 163 dot com or ann at one two dot com", ["bob at 163 dot com", "ann at one two dot com"]),
    ("3 point 5 of 10 dot 20 dot 30, double 7 and double trouble", []),
    ("look at the dot in it, one two three", []),
    ("plain text at home", []),
])
def test_disguises_map_back_to_the_source(text, found):
    base, both = pii.all_spans(text)
    assert [text[a:b] for _, a, b in both] == found
    assert set(base) <= set(both) and base == brute.base_spans(text)


def test_pii_query(spark, edge_docs, no_docs):
    rows = [(1, "x a@b.co 10.0.0.1", 0), (2, None, 0), (3, "", 0), (4, "call +1 (743) 555-3824", 0), (4, "call +1 (743) 555-3824", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_email int")
    got, every = by_id(pii.find(docs))
    assert len(every) == 5 and got[1]["spans"] == "email:2:8,ip:9:17" and (got[1]["n_email"], got[1]["n_ip"], got[4]["n_phone"]) == (1, 1, 1)
    assert got[2]["spans"] == got[3]["spans"] == "" and got[1]["base_sha256"] == hashlib.sha256(b"email:2:8,ip:9:17").hexdigest()
    masked = {r.doc_id: r.text for r in pii.masked(docs).collect()}
    assert masked == {1: "x [EMAIL] [IP]", 2: None, 3: "", 4: "call [PHONE]"}
    assert pii.find(no_docs).collect() == [] and pii.find(edge_docs).count() == edge_docs.count()


def test_many_disguises_in_one_text_are_placed_as_by_comparing_all():
    rng = random.Random(6)
    parts = ["a@b.co", "joe at host dot com", "joe (at) host (dot) com", "+1 555 123 4567", "five five five", "1.2.3.4", "192 dot 168 dot 1 dot 10", "4111 1111 1111 1111", "words", "four one one one 1111 1111 1111"]
    for _ in range(30):
        text = rng.choice((" ", ", ", " ; ")).join(rng.choice(parts) for _ in range(60))
        base, both = pii.all_spans(text)
        taken = [(s, e) for _, s, e in base]
        r = pii.rewrite(text)
        expected = list(base)
        for kind, a, b in pii.base_spans(r.text) if r else []:
            start, end = r.start[a], r.end[b - 1]
            rewritten = any(r.start[k] in r.changed for k in range(a, b)) or end - start != b - a
            if rewritten and not any(s < end and start < e for s, e in taken):
                expected.append((kind, start, end))
                taken.append((start, end))
        assert sorted(both) == sorted(expected)
    # 40,000 of each would take minutes if each were compared with all others
    base, both = pii.all_spans("a@b.co joe (at) host (dot) com " * 40_000)
    assert len(base) == 40_000 and len(both) == 80_000



# 8 byte-level BPE -------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}  # noqa: SIM115
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(reference):
    enc = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(2)
    alphabets = ["ab", "aeinrst ", "the of and\n'", "é中\U0001f600 a\x00\x85　", "0123456789 ,.", "a", " \t\n\r"]
    texts = ["".join(rng.choice(a) for _ in range(rng.randrange(1, 120))) for a in alphabets for _ in range(150)]
    texts += ["a" * 40_000, "ab" * 20_000, " " * 5000, "the" * 9000, "中" * 5000, "<|endoftext|>", "".join(rng.choice("etaoinshrdlu") for _ in range(40_000))]
    for t in texts:
        ids = list(struct.unpack(f"<{len(enc.encode(t)) // 4}I", enc.encode(t)))
        assert ids == reference.encode_ordinary(t), t[:60]


def test_tables_that_overflow_start_afresh(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MAX_STATES", 50)
    monkeypatch.setattr(bpe, "MAX_SEAMS", 50)
    monkeypatch.setattr(bpe, "MAX_PIECES", 5)
    monkeypatch.setattr(bpe, "PART_BYTES", 64)
    enc = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(30):
        t = "".join(rng.choice("etaoinshrdlu ") for _ in range(600)) + "".join(rng.choice("abc") for _ in range(700))
        assert list(np.frombuffer(enc.encode(t), "<u4")) == reference.encode_ordinary(t)


def test_merges_out_of_order_and_tokens_that_merging_never_makes():
    ranks = {bytes([c]): 1000 + c for c in b"abcd"} | {b"ab": 5, b"abc": 3, b"cd": 4, b"bc": 9, b"abcd": 1, b"dab": 7, b"da": 8, b"aa": 6, b"aaa": 2}
    t = bpe.Transducer(ranks)
    rng = random.Random(9)
    for _ in range(3000):
        data = "".join(rng.choice("abcd") for _ in range(rng.randrange(1, 14))).encode()
        expected = [ranks[data]] if data in ranks else [ranks[p] for p in bpe.merge_all(data, ranks)]
        assert t.encode_piece(data) == expected, data


def test_streaming_decode():
    enc = bpe.encoder(RANKS, public_tokenizers.PATTERN)
    text = "héllo 中文 \U0001f600\U0001f601 end"
    ids = np.frombuffer(enc.encode(text), "<u4").tolist()
    out = bpe.StreamDecoder(enc.transducer.token)
    parts = [out.feed([i]) for i in ids]
    assert "".join(parts) + out.finish() == text and "�" not in "".join(parts)
    cut = bpe.StreamDecoder(enc.transducer.token)
    assert cut.feed([enc.transducer.ranks[b"\xf0"]]) == "" and cut.finish() == "�"


def test_bpe_query(edge_docs, edge_texts, no_docs, reference):
    got, rows = by_id(bpe.encode(edge_docs, RANKS, public_tokenizers.PATTERN))
    assert len(rows) == len(edge_texts) + 1
    for i, t in edge_texts.items():
        ids = reference.encode_ordinary(t or "")
        assert (got[i]["n_tokens"], got[i]["ids"]) == (len(ids), ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).collect() == []


# 10 language identification ---------------------------------------------------


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got, _ = by_id(langid.identify(docs))
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in got.items() if r["held_out"]} == set(out)
    assert sum(got[i]["lang_pred"] == truth[i] for i in out) >= 0.98 * len(out)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_looks_at_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(docs.filter(~langid.held_out()))
    told = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(docs, model).collect()}
    other = docs.withColumn("doc_id", F.col("doc_id") + 10**6).withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    assert {r.doc_id - 10**6: (r.lang_pred, r.score) for r in langid.predict(other, model).collect()} == told


def test_language_odd_rows(spark, edge_docs, no_docs):
    got, rows = by_id(langid.identify(edge_docs))  # one language only
    assert {got[i]["lang_pred"] for i in (0, 1, 2)} == {"und"} and got[3]["lang_pred"] == "en" and got[6]["lang_pred"] == "en"
    assert len(rows) == edge_docs.count() and langid.identify(no_docs).collect() == []
    none = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(none).collect()} == {("und", 0.0)}
    odd = spark.createDataFrame([(None, "12 34 !?", "en"), (None, "hello there", None), (3, "中文", "zh"), (4, "hello again to all", "en")], "doc_id bigint, text string, lang string")
    told = sorted(r.lang_pred for r in langid.identify(odd).collect())
    assert len(told) == 4 and told.count("und") == 1 and set(told) <= {"und", "en", "zh"}


def test_every_labelled_language_is_learned(spark):
    """70 languages of two texts each, more than fit the sample whole; repeated rows come to the sample once."""
    rows = []
    for k in range(70):
        a, b = chr(97 + k % 26), chr(97 + k // 26)
        rows += [(100 * k + i, " ".join([f"{a}{a}{b}{a}{b}{b}"] * (8 + i)) + f" {a}{b}{i}", f"l{k:02}") for i in range(2)]
    rows += [(None, rows[0][1], "l00")] * 300 + [(5, rows[2][1], "l01")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    model = langid.fit(docs, total=140)
    assert model.langs == [f"l{k:02}" for k in range(70)]
    told = {(r.text, r.lang): r.lang_pred for r in langid.predict(docs, model).collect()}
    assert sum(lang == got for (_, lang), got in told.items()) >= 0.95 * len(told)


def test_languages_within_a_family(spark):
    """Two families of two: the family decides first, then the machine of its pair."""
    rng = random.Random(8)
    sounds = {"en": ["the", "ing", "sh"], "de": ["sch", "ung", "der"], "fr": ["eau", "oir", "que"], "es": ["cion", "ado", "que"]}
    rows = [(lang, " ".join("".join(rng.choice(s) for _ in range(2)) for _ in range(40))) for lang, s in sounds.items() for _ in range(30)]
    model = langid.train([(lang, langid.features(np.frombuffer(t.encode(), np.uint8))) for lang, t in rows])
    assert model.families == ["germanic", "romance"] and model.machines == [("family", "germanic"), ("de", "en"), ("es", "fr")]
    data = [t.encode() for _, t in rows]
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    told = langid.decide(model, langid.margins(model, np.frombuffer(b"".join(data), np.uint8), at))
    assert sum(a == lang for (a, _), (lang, _) in zip(told, rows, strict=True)) >= 118

"""Pages, archives, embeddings, the pipeline and the registry."""

from __future__ import annotations

import base64
import hashlib
import html
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from ebbtide.llm import embedding_join, html_extract, oracle, queries, warc
from ebbtide.llm.scratch import ship

from . import brute

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# 2 main text ------------------------------------------------------------------


def article_text(source: str) -> str:
    """The article of the generated pages by their markup."""
    m = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)
    inner = re.sub(r"<[^>]*(>|\Z)", lambda t: "" if re.match(r"</?b>", t.group()) else " ", m[1] if m else "")
    return " ".join(html.unescape(inner).split())


def test_extraction_matches_the_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {r.page_id: article_text(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    assert got == {i: (t, len(t)) for i, t in expected.items()}


def test_extraction_without_labelled_pages():
    weights = html_extract.learn([])
    body = "A long enough first paragraph of the text with many words in it, and <a href='/x'>a link</a> too."
    page = f"""<html><head><title>No text</title><style>p {{}}</style></head><body><header>Site name</header>
      <ul class="menu"><li><a>Home</a></li><li><a>News</a></li></ul><div id="cookie-notice">We use cookies, agree please to all of them now.</div>
      <div class="story"><h1>Heading &amp; more</h1><p>{body}</p><div class="ad">Buy this now and here</div><form>mail <input></form>
      <p>Second&nbsp;paragraph,\n  not<b>able</b> and well made.</p></div>
      <section id="comments"><p>Great post, I read all of it and liked every word of it so much.</p></section><aside>More on this</aside>
      <footer>&copy; site and all its many rights reserved by all its owners</footer><script>var x = "<p>not text</p>";</script></body></html>"""
    plain = "A long enough first paragraph of the text with many words in it, and a link too."
    assert html_extract.extract_text(page, weights) == f"Heading & more {plain} Second paragraph, notable and well made."


def test_fit_on_few_labelled_pages_of_many_kinds(spark):
    """1% of the pages are labelled, with over 10,000 kinds; one of them stands mostly outside of articles."""
    bare = [(i, "<p>no label here</p>") for i in range(2970)]
    page = lambda i: "".join(f"<div class=k{i}x{k}>word word word</div>" for k in range(400)) + "<div class=both>out of it</div>" * 3
    own = [(5000 + i, f"<body>{page(i)}<div class=menux>always out</div><article>{'<div class=both>in</div>' if i == 7 else 'text'}</article></body>") for i in range(30)]
    weights = html_extract.fit(spark.createDataFrame(bare + own, "page_id bigint, html string"), sample=30)
    assert weights.learned_boilerplate == {"div.menux"}


def test_extraction_of_odd_pages(spark):
    long = "<p>" + "word " * 100_000
    rows = [(1, "u", None, 0), (2, None, "", 0), (3, "u", "   <br> ", 0), (4, "u", "no markup", 0), (5, "u", "<p>a < b &lt; c <unfinished", 0), (6, "u", long, 0), (6, "u", long, 0),
            (7, "u", "<" * 100_000, 0), (8, "u", "<!-- open <p>x", 0), (9, "u", "<a href=\"" * 20_000, 0), (None, "u", "<p>x y</p>", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text int")
    got = [(r.page_id, r.text) for r in html_extract.extract(pages).collect()]
    assert len(got) == len(rows) and got.count((6, ("word " * 100_000).strip())) == 2
    assert {(1, ""), (2, ""), (3, ""), (4, "no markup"), (5, "a < b < c"), (8, ""), (None, "x y")} <= set(got)
    assert html_extract.extract(pages.limit(0)).collect() == []


# 7 embeddings -----------------------------------------------------------------


def pairs_by_force(ids, vectors, threshold=0.9):
    x = np.array(vectors, float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= threshold
    roots = brute.Union(ids)
    for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        roots.join(ids[i], ids[j])
    return {i: (int(n) - 1, roots.find(i)) for i, n in zip(ids, near.sum(axis=1), strict=True)}


@pytest.mark.parametrize(("dim", "chunk"), [(64, 8192), (64, 40), (7, 30), (1, 10)])
def test_embedding_links_by_force(spark, dim, chunk):
    rng = np.random.default_rng(dim)
    far = rng.standard_normal((300, dim))
    group = rng.standard_normal(dim) + 0.25 * rng.standard_normal((120, dim))
    copies = np.repeat(rng.standard_normal((1, dim)), 60, axis=0)
    x = np.vstack([far, group, copies, far[:20] * 3]).astype(np.float32)
    ids = rng.permutation(len(x)).tolist()
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<float>, n int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_join.near_duplicates(table, chunk=chunk).collect()}
    assert got == {i: (n, c, i == c) for i, (n, c) in pairs_by_force(ids, x).items()}


def test_embeddings_of_odd_shapes(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [2.0, 1e-9]), (9, [2.0, 1e-9]),
            (None, [1.0, 0.0]), (10, [1e300, 1e299]), (11, [-1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_join.near_duplicates(table).collect()]
    assert len(got) == len(rows) and got.count((9, 3, 1, False)) == 2
    alone = {(i, 0, i, True) for i in (2, 3, 4, 5, 6, 7, 8, 11)}
    assert alone | {(1, 3, 1, True), (10, 3, 1, False), (None, 0, None, True)} <= set(got)
    assert embedding_join.near_duplicates(table.limit(0)).collect() == []


# 9 archives -------------------------------------------------------------------

ROWS = [(1, "http://www.Example.com:80/a?b=1#c", "<p>one</p>"), (2, "https://example.com", "<p>one</p>"), (3, None, None), (4, "no scheme at all", ""), (5, "http://example.com/é", "été"),
        (6, "http://x.org/", "z" * 200_000), (6, "http://x.org/", "z" * 200_000), (None, "http://x.org/", "<p>one</p>"), (None, "http://y.org/", "alone"), (-3, "http://x.org/\r\nWARC-Type: x", "<p>one</p>")]


def test_archives_round_trip(spark):
    pages = spark.createDataFrame([(*r, 7) for r in ROWS], "page_id bigint, url string, html string, offset int").repartition(3)
    got = [r.asDict() for r in warc.round_trip(pages, with_payload=True).collect()]
    assert len(got) == len(ROWS)
    by_payload: dict = {}
    for i, _, h in ROWS:
        by_payload.setdefault(h or "", []).append(i)
    for i, _, h in ROWS:
        data = (h or "").encode()
        top = max((x for x in by_payload[h or ""] if x is not None), default=None)
        row = next(r for r in got if r["page_id"] == i and r["payload_bytes"] == len(data))
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (row["record_type"], row["refers_to"]) == (("response", None) if i == top else ("revisit", top))
        assert row["payload"] == (data if i == top else None)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_lookup_through_small_blocks(spark, tmp_path):
    from pyspark.sql import functions as F

    folder = f"file://{tmp_path}/w"
    rng = random.Random(3)
    rows = [(i, f"http://h{rng.randrange(30)}.example.com/{rng.randrange(5)}", f"body {i % 40}") for i in range(500)] + [(7000, "http://same.org/", f"copy {k}") for k in range(40)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
    captures = warc.write(pages, f"{folder}/archive")
    directory = warc.build_index(captures, f"{folder}/index", block_lines=7)
    key = warc.capture_key(F.col("url"), F.col("page_id")).alias("key")
    got = warc.lookup(pages.select(key), f"{folder}/archive", f"{folder}/index", directory, True).collect()
    assert sorted(r.payload.decode() for r in got if r.page_id == 7000) == sorted(f"copy {k}" for k in range(40))
    assert sorted(r.page_id for r in got) == sorted(r[0] for r in rows)
    some = pages.filter("page_id in (3, 77)").select(key)
    assert {r.page_id for r in warc.lookup(some, f"{folder}/archive", f"{folder}/index", directory).collect()} == {3, 77}
    missing = spark.createDataFrame([("com,nowhere)/ 1",)], "key string")
    with pytest.raises(Exception, match="no capture"):
        warc.lookup(missing, f"{folder}/archive", f"{folder}/index", directory).collect()
    keys = [r.key for r in spark.createDataFrame(ROWS, "page_id bigint, url string, html string").orderBy("page_id").select(key).collect()]
    assert any(k.startswith("com,example,www:80)/a?b=1 ") for k in keys) and not any("\r" in k or "\n" in k for k in keys)


# Pipeline and registry --------------------------------------------------------


def test_stages_take_effect(spark, edge_docs, tmp_path):
    item = "this benchmark item has more than ten words in it for sure"
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    extra = spark.createDataFrame([(900, f"some text, {item.upper()}", "en", "s", 5), (901, "write to a@b.co today my friend", "en", "s", 31), (902, "12 34", "en", "s", 5), (None, "no id but a text", None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = edge_docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(extra)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    at = {}
    held = docs
    for name, stage in corpus_pipeline.STAGES:
        held = stage(spark, held, str(tmp_path)).cache()
        at[name] = {r.doc_id: r for r in held.collect()}
        if name != "tokenize":
            assert held.dtypes == docs.dtypes
    kept = set(at["language_id"])
    assert kept >= {3, 10, 64, 900, 901, None} and not kept & {0, 1, 2, 902}
    _, roots = brute.jaccard_components({r.doc_id: r.text for r in at["language_id"].values() if r.doc_id is not None})
    assert set(at["near_duplicates"]) == {i for i, r in roots.items() if i == r} | {None}
    assert set(at["decontaminate"]) == set(at["near_duplicates"]) - {900}
    assert at["pii"][901].text == "write to [EMAIL] today my friend" and at["pii"][901].n_chars == len(at["pii"][901].text)
    assert at["pii"][10].text == at["near_duplicates"][10].text
    whole = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == {i: r.n_tokens for i, r in at["tokenize"].items()}


def test_one_id_with_different_texts(spark):
    one, two, three = (" ".join(f"{c}{k}" for k in range(60)) for c in "abc")
    rows = [(3, one), (5, one + " tail"), (5, two), (5, two), (5, "five other words stand here"), (5, None), (7, three), (7, three + " tail"), (8, three), (9, two + " end"), (None, one)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    seven = [t for i, t in kept if i == 7]
    assert len(seven) == 1 and seven[0] in (three, three + " tail")
    assert kept == sorted([(0, one), (3, one), (5, ""), (5, "five other words stand here"), (5, two), (7, seven[0])])


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    """Columns named like those that the operators make come back as they were; of repeated rows the first in order stays."""
    spark.createDataFrame([(1, "nothing of this is in any of the texts below at all")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    text = " ".join(f"w{k}" for k in range(30))
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, score double, lang_pred int, row string, id int, key int, gone string, n int, c1 string"
    more = ("keep me", 7.5, 3, "r", 1, 2, "g", 4, "c")
    rows = [(1, text, "en", "b", len(text), *more), (1, text, "en", "a", len(text), *more), (2, text + " tail", "en", "s", 5, *more), (3, "other words", "en", "s", 11, *more)]
    docs = spark.createDataFrame(rows, schema).repartition(2)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, str(tmp_path))
        assert held.dtypes == docs.dtypes
    assert sorted(map(tuple, held.collect())) == [rows[1], rows[3]]


def test_stages_without_rows(spark, tmp_path):
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registry():
    names = list(queries.all_queries())
    assert [n.split("_")[0] for n in names[:-1]] == [f"op{k}" for k in range(1, 14)] and names[-1] == "pipeline"
    assert set(oracle.all_queries()) <= set(names)
    assert [s[0] for s in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "pii", "tokenize"]

"""Licenses, main text, URL rules, quality classifier, suffix dedup and SentencePiece."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.plain import ALNUM, EDGES, SPACED, lower, word_counts
from tests.oracle import connect, differences
from tidemark.llm import licenses, main_text, quality_gam, sentencepiece_viterbi, suffix_dedup, url_filter
from tidemark.llm.words import Hasher

# licenses


def _places(text, phrase):
    words, wanted = ALNUM.findall(lower(text or "")), phrase.split()
    return [k for k in range(len(words)) if words[k : k + len(wanted)] == wanted]


def test_license_edges(spark, edges):
    texts = [
        (30, "CC-BY; cc by\nall rights\nreserved"),
        (31, "xcc by, cc byx. \u212acc by GENERAL public   License"),
        (32, "no\nLicensed under CC BY-NC 4.0."),
        (33, "permission is hereby granted free of charge to any person obtaining a copy"),
        (34, '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance'),
        (35, "x\nRedistribution and use in source\nand binary forms, with or without\nmodification, are permitted\ny"),
        (36, "Permission is hereby granted, free of charge,\n\n\nto any person obtaining a copy of this software"),
    ]
    docs = edges.select("doc_id", "text", "n").unionByName(
        spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True
    )
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(EDGES) + len(texts)
    known = dict(EDGES) | dict(texts)
    got = {r["doc_id"]: r for r in rows if r["doc_id"]}
    for doc, row in got.items():
        places = {p: _places(known[doc], p) for p in licenses.PHRASES}
        every = [x for ps in places.values() for x in ps]
        assert row["n_words"] == len(ALNUM.findall(lower(known[doc] or "")))
        assert row["n_base"] == len(every)
        assert (row["first_word"], row["last_word"]) == ((min(every), max(every)) if every else (None, None))
        assert row["base_labels"] == ",".join(sorted(licenses.PHRASES[p] for p in places if places[p]))
    assert got[32]["labels"] == "cc-by,cc-by-nc" and got[33]["labels"] == "mit" and 0.8 <= got[33]["score"] < 1
    assert [got[k]["labels"] for k in (34, 35, 36)] == ["apache-2.0", "bsd", ""]  # wrapped ones; too far apart
    assert licenses.scan(edges.where("false")).count() == 0


def test_license_plan_has_no_python(spark, data_dir):
    plan = licenses.query(spark, data_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|ArrowEval", plan)


# main text

PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><p>Site</p></header><nav><ul><li>Home<li>News</ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header><h1>Title &amp; more</h1></header><p class=lead>First <b>bold</b>&nbsp;text<br>goes on.</p>
<p hidden>gone</p><p>Second<span style="display:none">gone</span> line</p><aside>Aside</aside>
<div class="ad">Buy</div><!-- <p>no</p> --><script>var t="</p><p>x";</script><ul><li>One</li><li>Two</li></ul>
<form><input><button>Send</button></form><section id="comments"><article class="comment"><p>Nice</p></article></section>
</article></main><footer><p>&copy; me</p></footer></body></html>"""


def test_page_structure():
    lines = [t for t, kind in main_text.page_lines(PAGE) if kind == 2]
    assert lines == ["Title & more", "First bold text goes on.", "Second line", "One", "Two"]
    assert main_text.page_lines(None) == main_text.page_lines("") == []
    assert main_text.page_lines("<p>a<p class='x>b") == [("a", 1), ("b", 1)] or main_text.page_lines("a < b")
    assert main_text.page_lines("5 < 6 &lt; 7")[0][0].startswith("5")
    assert main_text.page_lines("<article>x</article><article><p>y &am &#65;")[-1] == ("y &am A", 2)


@pytest.mark.parametrize("name", ["ad", "ad-0", "newsletter-signup", "site-header", "post_comments", "cookieBanner", "main-nav", "header-2"])
def test_parts_left_out_by_name(name):
    page = f'<body class="x"><div id="{name}"><p>Out</p></div><div class="post-header with-sidebar">In</div></body>'
    assert [t for t, kind in main_text.page_lines(page) if kind] == ["In"]


@pytest.mark.parametrize("name", ["address", "has-sidebar", "content", "post-header", "formal", "adventure", "no-ads", "entry-header"])
def test_parts_kept_by_name(name):
    assert main_text.page_lines(f"<div class='a {name}'>In</div>") == [("In", 1)]


def test_common_lines_are_longest():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        shared = main_text.common_lines(np.array(a), np.array(b))
        found, rest = [x for x, s in zip(a, shared, strict=True) if s], iter(b)
        assert len(found) == best[-1, -1] and all(x in rest for x in found)


def test_template_lines_go_and_copies_stay(spark):
    page = "<div>{0}</div><div>Own {1}</div><div>Read on</div>"
    rows = [(k, f"http://h.org/a/{k}", page.format("Top line", k)) for k in range(9)]
    rows += [(50, "http://g.org/x", "<p>Same</p>"), (51, "http://g.org/y?z", "<p>Same</p>"), (52, "http://one.org/", "<p>Alone</p>")]
    rows += [(60, None, None), (61, "", "<p>No host</p>"), (None, "http://h.org/a/5", page.format("Top line", "n"))]
    rows += [(70, "http://h.org/a/4b", "<article><p>Top line</p><p>Mine</p></article>"), (0, rows[0][1], rows[0][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = main_text.extract(pages.selectExpr("*", "1 AS page", "2 AS host", "3 AS line")).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert all(text[k] == f"Own {k}" for k in range(9))
    assert (text[50], text[51], text[52], text[60], text[61], text[70]) == ("Same", "Same", "Alone", "", "No host", "Top line\nMine")
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert main_text.extract(pages.where("false")).count() == 0


def test_near_copies_keep_their_text(spark):
    body = "".join(f"<p>Paragraph {k} of the one article that both pages have.</p>" for k in range(10))
    menu = "<div>Home and all the rest of it</div>"
    page = lambda date: f"{menu}{body}<p>Date {date}</p>"
    other = menu + "".join(f"<p>Another text, sentence {k}, of another page.</p>" for k in range(8))
    rows = [(1, "http://h.org/a", page(1)), (2, "http://h.org/b", page(2)), (3, "http://h.org/c", page(3)), (4, "http://h.org/d", other)]
    rows += [(11, "http://g.org/a", page(1)), (12, "http://g.org/b", page(2))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    text = {r["page_id"]: r["text"].split("\n") for r in main_text.extract(pages).collect()}
    assert all(len(text[k]) == 12 for k in (11, 12))  # no other page to tell the menu by
    assert len(text[3]) == 11 and text[3][-1] == "Date 3" and len(text[4]) == 8
    assert all(len(text[k]) >= 11 and text[k][-1] == f"Date {k}" for k in (1, 2))


def test_pages_give_their_article(spark, data_dir):
    got = {r["page_id"]: r for r in main_text.query(spark, data_dir).collect()}
    import html

    for page, source in duckdb.sql(f"SELECT page_id, html FROM '{data_dir}/pages.parquet'").fetchall():
        body = re.search("<article>(.*)</article>", source, re.S)[1].replace("<br>", " ")
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", body)]
        assert got[page]["text"] == "\n".join(x for x in lines if x)


# url rules


def _glob(glob):
    parts = re.findall(r"\*\*|\*|\?|[^*?]+", glob)
    return re.compile("".join({"**": "(?s:.*)", "*": "[^/]*", "?": "[^/]"}.get(p) or re.escape(p) for p in parts))


def test_automaton_agrees_with_regular_expressions():
    import pyarrow as pa

    rng = random.Random(6)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "é"]) for _ in range(rng.randrange(1, 7))) for _ in range(80)]
    texts = ["".join(rng.choice("ab/é") for _ in range(rng.randrange(9))) for _ in range(200)]
    fits = url_filter.Automaton(globs).fits(pa.array(texts))
    for k, glob in enumerate(globs):
        assert fits[:, k].tolist() == [bool(_glob(glob).fullmatch(t)) for t in texts], glob


def test_url_edges(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://EXAMPLE.ORG/es/x", "http://a.example.org/en/19#q", "http://example.org/en/2",
        "http://badexample.org/es/", "http://x.com/fr/?a", "http://com/de/", "http://x.net/a.org/b", "http://x.org?/", "x://y://z.org/",
        "http://u@x.org/", "http://x.net/login", "http://x.net/" + "a" * 5000 + ".zip", "http://x.net/a\nb/de/é",
    ]
    rows = [(k, u, "r", "v") for k, u in enumerate([*urls, *urls[4:6]])]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, rule string, host string")).orderBy("page_id")
    found = [(r["rule"], r["verdict"]) for r in got.collect()]
    assert len(found) == len(rows)
    assert found[:4] == [(None, "allow")] * 4
    assert found[4:10] == [
        ("example.org/es/", "block"), ("example.org/en/1", "block"), ("org/", "allow"), ("org/", "allow"),
        ("com/fr/", "allow"), ("com/de/", "block"),
    ]
    assert found[10:14] == [(None, "allow"), (None, "allow"), (None, "allow"), ("org/", "allow")]
    assert found[14] == found[15] == (None, "block") and found[16] == (None, "allow")
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, rule string")).count() == 0


@pytest.mark.parametrize("module", [licenses, url_filter])
def test_sql_agrees(spark, data_dir, module):
    assert differences(module.query(spark, data_dir), connect(data_dir), module.SQL) is None


# quality classifier


def test_held_out_accuracy(spark, data_dir):
    data_dir = data_dir.replace("sf0.001", "sf0.01")  # the smallest has 19 labelled rows held out
    got = {r["doc_id"]: r for r in quality_gam.query(spark, data_dir).collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{data_dir}/labels.parquet'").fetchall())
    pairs = [(labels[i], r["predicted"]) for i, r in got.items() if r["held_out"] and i in labels]
    assert sum(a == b for a, b in pairs) >= 0.95 * len(pairs)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())


def test_classifier_edges(spark, edges):
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 10)] + [(5, None), (None, 1)], "doc_id long, quality int")
    rows = quality_gam.classify(edges, labels.selectExpr("*", "'x' AS text", "1 AS score")).collect()
    assert len(rows) == len(EDGES) and all(0 <= r["score"] <= 1 for r in rows)
    assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    none = quality_gam.classify(edges, labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality_gam.classify(edges.where("false"), labels).count() == 0


def _plain_features(text):
    text = text or ""
    n_words, chars, symbols, again, repeated = word_counts(text)
    words = SPACED.findall(text)
    lines = sum(bool(SPACED.search(line)) for line in text.split("\n"))
    per_char, per_word = max(chars, 1), max(n_words, 1)  # without words: as if one of one character
    return [
        math.log1p(n_words),
        per_char / per_word,
        symbols / per_char,
        again / max(lines, 1),
        repeated / per_word,
        sum("A" <= c <= "Z" for c in text) / per_char,
        len(set(words)) / per_word,
        sum("0" <= c <= "9" for c in text) / per_char,
        sum(c in "!?.,;:" for c in text) / per_char,
        math.log1p(len(text) / max(lines, 1)),
        sum(c > "\x7f" for c in text) / per_char,
    ]


def test_features_agree_with_plain_ones(documents):
    texts = [t for _, t in EDGES] + [t for _, t, *_ in documents]
    got = quality_gam.text_features(pa.array(texts, pa.string()), Hasher())
    assert np.allclose(got, [_plain_features(t) for t in texts], rtol=1e-12, atol=1e-12)


def test_repeated_rows_score_alike(spark, data_dir):
    """Every document twice: the scores are those of the model, the same for both rows."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    vectors = docs.union(docs).select("doc_id", quality_gam.features("text").alias("x"))
    assert vectors.groupBy("doc_id").agg(F.count_distinct("x").alias("c"), F.count("*").alias("n")).where("c <> 1 OR n <> 2").count() == 0


def test_model_finds_an_interaction():
    rng = np.random.default_rng(7)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.fit(x[:3000], y[:3000])
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert {model.pairs[0][0], model.pairs[0][1]} == {0, 1}


# suffix dedup


def _plain_rest(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if raw[k : k + length] in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(raw[k : k + length])
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[doc] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def _digests(docs, **more):
    rows = suffix_dedup.mark(docs, **more).select("doc_id", suffix_dedup._digest("text", "gone").alias("d"))
    return [(r[0], tuple(r[1])) for r in rows.collect()]


def test_suffix_query_agrees_with_plain_search(spark, data_dir, documents):
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.query(spark, data_dir).collect()}
    assert got == _plain_rest([(i, t) for i, t, *_ in documents])


@pytest.mark.parametrize("collection", [3, 100_000])
def test_suffix_edges(spark, edges, collection):
    rng = random.Random(8)
    line = "".join(rng.choice("abcdé ") for _ in range(150))
    texts = [(40, line), (41, "x" + line[:120] + "y" + line), (42, line[60:] + line[:110]), (43, "ab" * 200), (44, "c" * 99 + "\0" * 150)]
    texts += [(50 + k, line[:85] + "".join(rng.choice("abcd ") for _ in range(60))) for k in range(12)]
    docs = edges.select("doc_id", "text", "n", "id").unionByName(
        spark.createDataFrame(texts, "doc_id long, text string"), allowMissingColumns=True
    )
    got = _digests(docs, collection=collection)
    assert len(got) == len(EDGES) + len(texts)
    want = _plain_rest([*EDGES, *texts])
    assert {k: v for k, v in got if k is not None} == want
    assert all(v[1] == 0 for k, v in got if k is None)
    twice = dict(_digests(docs.union(docs), collection=collection))
    assert {k: v for k, v in twice.items() if k is not None} == want
    assert suffix_dedup.mark(edges.where("false")).count() == 0


# SentencePiece


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece_viterbi.Pieces(sentencepiece_viterbi.model_path())


def test_round_trip(spark, data_dir, edges, documents):
    assert all(r["round_trip"] for r in sentencepiece_viterbi.query(spark, data_dir).collect())
    coded = sentencepiece_viterbi.encode_texts(edges.selectExpr("*", "1 AS tokens"))
    back = sentencepiece_viterbi.decode_texts(coded, into="back").collect()
    assert len(back) == len(EDGES) and all(r["text"] == r["back"] for r in back)
    assert all((r["tokens"] is None) == (r["text"] is None) for r in back)
    assert sentencepiece_viterbi.encode_texts(edges.where("false")).count() == 0
    both = sentencepiece_viterbi.code_texts(edges.selectExpr("*", "1 AS tokens")).collect()
    key = lambda r: (r["doc_id"] or 0, r["text"] or "", r["tokens"] or [])
    assert sorted(map(key, both)) == sorted(map(key, back))


def test_marks_and_rare_characters_come_back(pieces):
    viterbi = sentencepiece_viterbi.Viterbi(pieces)
    texts = ["▁ a ▁▁b", "  two  spaces ", "\u2028 \ufdd0 🙂", "▁", " ", "a" * 10_000]
    assert [viterbi.decode(ids) for ids in viterbi.encode(texts)] == texts


def test_paths_are_best(pieces):
    """Against all ways to cut short words, and with the shared prefixes of a sorted list of words."""
    viterbi = sentencepiece_viterbi.Viterbi(pieces)

    def best(word):
        scores = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            scores[end] = scores[end - 1] + len(word[end - 1].encode()) * pieces.byte_score
            for start in range(end):
                if word[start:end] in pieces.ids:
                    scores[end] = max(scores[end], scores[start] + pieces.score[pieces.ids[word[start:end]]])
        return scores[-1]

    words = sorted({" the", " them", " there", " thereof", " zq日本", " naïveté", "  x", " th", " internationalization"})
    for word, ids in viterbi._walk(words):
        total = sum(pieces.byte_score if i in pieces.byte_ids else pieces.score[i] for i in ids)
        assert abs(total - best(word)) < 1e-9
        assert b"".join(pieces.raw[i] for i in ids).decode() == word

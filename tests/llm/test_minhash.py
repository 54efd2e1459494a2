import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter, functions as F

from tests.llm.plain import EDGES, SPACED, lower, shingles, similar_classes
from tidemark.llm import minhash_dedup, paragraph_dedup, passages
from tidemark.llm.graph import components
from tidemark.llm.words import SPACED as SPACED_BYTES, Hasher, find_words, long_windows, utf8
from tidemark.session import WRITING, settings, write_by_key


def _variants(seed, n, length=60):
    """A family of near copies, edited one after another."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("aeioubcd") for _ in range(6))
    base, out = [word() for _ in range(length)], []
    for _ in range(n):
        text = list(base if rng.random() < 0.5 or not out else rng.choice(out))
        for _ in range(rng.randrange(4)):
            text[rng.randrange(length)] = word()
        out.append(text)
    return [" ".join(t) for t in out]


def test_query_agrees_with_plain_search(spark, data_dir, documents):
    sets = [shingles(t) for _, t, *_ in documents]
    first = similar_classes(sets, 85)
    got = {r["doc_id"]: r for r in minhash_dedup.query(spark, data_dir).collect()}
    assert len(got) == len(documents)
    for place, (doc, *_) in enumerate(documents):
        component = documents[first[place]][0] if sets[place] else doc
        row = got[doc]
        assert (row["n_shingles"], row["component_id"], row["kept"]) == (len(sets[place]), component, doc == component)


def test_families_of_near_copies(spark):
    texts = [t for seed in range(4) for t in _variants(seed, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: r[2] for r in minhash_dedup.classes(docs).collect()}
    assert [got[k] for k in range(len(texts))] == similar_classes([shingles(t) for t in texts], 85)
    assert minhash_dedup.dedup(docs).count() == len(set(got.values()))


def test_documents_are_compared_in_lower_case(spark, data_dir, documents):
    sets = [shingles(lower(t or "")) for _, t, *_ in documents]
    first = similar_classes(sets, 85)
    got = {r["doc_id"]: r for r in minhash_dedup.query(spark, data_dir).collect()}
    for place, (doc, *_) in enumerate(documents):
        component = documents[first[place]][0] if sets[place] else doc
        assert (got[doc]["n_shingles"], got[doc]["component_id"]) == (len(sets[place]), component)
    said = " ".join(f"word{k} Ä" for k in range(20))
    docs = spark.createDataFrame([(1, said), (2, said.upper()), (3, said.replace("Ä", "ä")), (4, "A b a B a b")], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash_dedup.classes(docs).collect()}
    assert got == {1: (36, 1), 2: (36, 1), 3: (36, 3), 4: (2, 4)}


def _open(spark, texts, label):
    """What is left between components that share a bucket, if that were all of these texts."""
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    shape = minhash_dedup.DOCUMENTS
    signed = docs.select("id", minhash_dedup.signer(shape)("text").alias("s"))
    sketch = signed.select("id", *[F.col("s.odd")[k].alias(w) for k, w in enumerate(minhash_dedup._WORDS)])
    rare = minhash_dedup._rare_shingles(docs, docs.select("id"), shape).drop("common")
    return rare.join(sketch, "id").withColumn("label", label)


@pytest.mark.parametrize("labels", [200, 3])
def test_the_rest_meets_all_similar_pairs(spark, labels):
    rng = random.Random(labels)
    texts = sorted({" ".join(t.split()[rng.randrange(6) :]) for seed in (1, 2) for t in _variants(seed, 90)})
    label = F.least(F.col("id") % labels, F.lit(labels - 1)) if labels > 3 else F.greatest(F.col("id") % 12 - 9, F.lit(0))
    left = _open(spark, texts, label)
    named = dict(left.select("id", "label").distinct().collect())
    sets = [shingles(t) for t in texts]
    want = {
        (a, b)
        for a in range(len(sets))
        for b in range(a + 1, len(sets))
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and named.get(a) != named.get(b)
    }
    met = minhash_dedup._close(minhash_dedup._meeting(left, minhash_dedup.DOCUMENTS), minhash_dedup.DOCUMENTS)
    assert want and want <= {tuple(r) for r in met.collect()}


def test_a_long_template_just_below_the_threshold_lists_no_pairs(spark):
    rng = random.Random(5)
    template = [f"t{rng.randrange(10**9)}" for _ in range(270)]
    texts = [" ".join(template + [f"own{k}x{i}" for i in range(27 + k % 3)]) for k in range(300)]
    sets = [shingles(t) for t in texts[:2]]
    assert 0.8 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    left = _open(spark, texts, F.col("id"))
    assert left.count() > 300
    assert minhash_dedup._meeting(left, minhash_dedup.DOCUMENTS).count() <= 300


def test_edges(spark, edges):
    rows = minhash_dedup.classes(edges).collect()
    assert len(rows) == len(EDGES)
    got = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert [got[k]["n_shingles"] for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 3]
    assert got[6]["component_id"] == 5 and got[3]["component_id"] == 3
    assert all(r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert minhash_dedup.dedup(edges).count() == len(EDGES) - 1
    assert minhash_dedup.classes(edges.where("false")).count() == 0
    twice = edges.union(edges)
    assert minhash_dedup.dedup(twice).count() == 2 * (len(EDGES) - 1)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    universe = rng.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64)
    a, b = np.sort(universe[:2000]), np.sort(universe[1000:])
    one, two = minhash_dedup.Circulant(800).signatures([a, b])
    assert abs((one == two).mean() - 1 / 3) < 0.06


def test_sketch_never_overstates_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 400, 200).astype(np.uint64))
        b = np.unique(rng.integers(0, 400, 200).astype(np.uint64))
        x, y = (minhash_dedup.odd_sketch(s).view(np.uint64) for s in (a, b))
        assert sum(int(v).bit_count() for v in x ^ y) <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4), (4, 5)], [(k, k + 1) for k in range(40)]])
def test_components(spark, edges):
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if a != b:
            low = min(want.get(a, a), want.get(b, b))
            old = {want.get(a, a), want.get(b, b)}
            want.update({k: low for k, v in want.items() if v in old} | {a: low, b: low})
    assert got == want


def _plain_removals(rows, min_words=15, threshold=80):
    units = [
        (doc, place, line)
        for doc, text in rows
        for place, line in enumerate((text or "").split("\n"))
        if len(SPACED.findall(line)) >= min_words
    ]
    first = similar_classes([shingles(line) for *_, line in units], threshold)
    gone = {}
    for k, (doc, place, _) in enumerate(units):
        if first[k] != k:
            gone.setdefault(doc, set()).add(place)
    return gone


def _without(text, gone):
    """The text without its words numbered `gone`; of the gaps beside them the one with more line breaks stays."""
    spans = [m.span() for m in SPACED.finditer(text)]
    out, place, k = [], 0, 0
    while k < len(spans):
        last = k
        while k in gone and last in gone and last < len(spans):
            last += 1
        if last == k:
            k += 1
            continue
        before = spans[k - 1][1] if k else 0
        after = spans[last][0] if last < len(spans) else len(text)
        left, right = text[before : spans[k][0]], text[spans[last - 1][1] : after]
        if k and last < len(spans):
            gap = right if right.count("\n") > left.count("\n") else left
        else:
            gap = left if k else right if last < len(spans) else ""
        out += [text[place:before], gap]
        place, k = after, last
    return "".join([*out, text[place:]])


def plain_dedup(rows, size=51):
    """Texts by document, and how many lines and pieces went: lines first, then passages of earlier documents, in rounds."""
    gone = _plain_removals(rows)
    texts = {d: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(d, ())) for d, t in rows}
    removed = {d: len(gone.get(d, ())) for d, _ in rows}
    while True:
        words = {d: SPACED.findall(t) for d, t in texts.items()}
        first = {}
        for d in sorted(words):
            for k in range(len(words[d]) - size + 1):
                first.setdefault(tuple(words[d][k : k + size]), d)
        found = False
        for d, own in words.items():
            hit = [k for k in range(len(own) - size + 1) if first[tuple(own[k : k + size])] != d]
            cut = {j for k in hit for j in range(k, k + size)}
            if cut:
                found = True
                removed[d] += sum(k - 1 not in cut for k in cut)
                texts[d] = _without(texts[d], cut)
        if not found:
            return texts, removed


def test_paragraph_query_agrees_with_plain_search(spark, data_dir, documents):
    texts, removed = plain_dedup([(i, t) for i, t, *_ in documents])
    assert any(removed.values())
    got = {r["doc_id"]: r for r in paragraph_dedup.query(spark, data_dir).collect()}
    for doc, text, *_ in documents:
        assert got[doc]["n_paragraphs"] == len(text.split("\n"))
        assert (got[doc]["text"], got[doc]["n_removed"]) == (texts[doc], removed[doc])


def test_repeated_lines_agree_with_plain_search(spark, data_dir, documents):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    got = {r["doc"]: set(r["gone"]) for r in paragraph_dedup.repeats(docs).collect()}
    assert got == _plain_removals([(i, t) for i, t, *_ in documents])


def test_paragraph_edges(spark, edges):
    long = " ".join(f"w{k}" for k in range(20))
    extra = spark.createDataFrame(
        [(20, f"{long}\nshort\n{long} more"), (21, f"x\n{long}"), (21, f"x\n{long}"), (22, long)], "doc_id long, text string"
    )
    docs = edges.select("doc_id", "text", "n", "id").unionByName(extra, allowMissingColumns=True)
    rows = paragraph_dedup.dedup(docs.withColumn("n_removed", docs.n)).collect()
    assert len(rows) == len(EDGES) + 4
    got = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert got[20]["text"] == f"{long}\nshort" and got[21]["text"] == "x" and got[22]["text"] == ""
    assert got[1]["text"] is None and got[9]["text"] == EDGES[8][1]
    assert paragraph_dedup.dedup(edges.where("false")).count() == 0


def _held_earlier(rows, size=51):
    """Documents that hold `size` words in a row which a document before them holds as well."""
    first, held = {}, set()
    for doc, text in sorted(rows):
        words = SPACED.findall(text or "")
        for k in range(len(words) - size + 1):
            if first.setdefault(tuple(words[k : k + size]), doc) != doc:
                held.add(doc)
    return held


def test_no_passage_of_an_earlier_document_is_left(spark, data_dir):
    rows = [(r["doc_id"], r["text"]) for r in paragraph_dedup.query(spark, data_dir).collect()]
    assert not _held_earlier(rows)


def test_passages_go_wherever_lines_break(spark):
    def own(doc, n=60):
        return [f"{doc}_{k}" for k in range(n)]

    said = [f"p{k}" for k in range(60)]
    p = " ".join(said)
    texts = {
        1: " ".join(own(1)) + " " + p + " " + " ".join(own("one")),
        2: " ".join(own(2, 90)) + " " + p + " " + " ".join(own("two", 90)),  # in a longer line
        3: "head\n" + "\n".join(" ".join(said[k : k + 7]) for k in range(0, 60, 7)) + "\ntail",  # over short lines
        4: "x " + " ".join(said[:25]) + "\n" + " ".join(said[25:]) + " y",  # broken elsewhere
        5: p.replace("p59", "q") + " " + " ".join(own(5, 50)),  # 59 words
        6: " ".join(said[:50]) + " " + " ".join(own(6, 90)),  # 50 words stay
        7: " ".join(own(7, 40) + own("seven", 40)),
        # without p the words beside it are those of 7
        8: " ".join(own(7, 40)) + "\n" + p + "\n" + " ".join(own("seven", 40)),
    }
    docs = spark.createDataFrame([*texts.items(), (None, p)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in paragraph_dedup.dedup(docs).collect()}
    got = {k: r["text"] for k, r in rows.items() if k}
    assert not _held_earlier(got.items()) and rows[None]["text"] == p
    assert got[1] == texts[1] and got[6] == texts[6] and got[7] == texts[7]
    assert got[2] == " ".join(own(2, 90) + own("two", 90)) and rows[2]["n_removed"] == 1
    assert got[3] == "head\ntail" and got[4] == "x y" and got[5] == "q " + " ".join(own(5, 50))
    assert got[8] == ""


def test_later_rounds_read_only_what_shares_a_fresh_passage(spark, monkeypatch):
    def own(doc, n=60):
        return [f"{doc}_{k}" for k in range(n)]

    p, q = own("p"), own("q")
    texts = {k: " ".join(own(k) + p + own(f"{k}x")) for k in range(1, 30)}
    texts |= {k: " ".join(own(k)) for k in range(30, 40)}
    # without p the words beside it are those of 50
    texts |= {50: " ".join(own("a", 40) + own("b", 40) + q), 51: " ".join(own("a", 40) + p + own("b", 40))}
    read, find = [], passages._found

    def counted(asked, size):
        read.append({r["doc"] for r in asked.select("doc").collect()})
        return find(asked, size)

    monkeypatch.setattr(passages, "_found", counted)
    rows = paragraph_dedup.dedup(spark.createDataFrame([*texts.items()], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["text"] for r in rows} == plain_dedup([*texts.items()])[0]
    assert read[1:] == [{50, 51}, set()]


def test_rounds_agree_with_plain_search(spark):
    rng = random.Random(1)
    said = [[f"{rng.choice('abc')}{rng.randrange(4)}" for _ in range(rng.randrange(4, 14))] for _ in range(12)]
    rows = [(k, "\n".join(" ".join(line) for line in rng.choices(said, k=rng.randrange(12)))) for k in range(60)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    texts, removed = plain_dedup(rows, 8)
    got = [(r["doc_id"], r["text"].split(), r["n_removed"]) for r in paragraph_dedup.dedup(docs, passage=8).collect()]
    assert sorted(got) == sorted((k, texts[k].split(), removed[k]) for k, _ in rows + rows[:5])


def test_rows_that_repeat_an_id_with_other_texts(spark):
    p = " ".join(f"p{k}" for k in range(60))
    rows = [(1, p), (2, f"{p} x"), (2, f"y {p}"), (2, "z")]
    got = paragraph_dedup.dedup(spark.createDataFrame([(k, t.replace(" ", "\n")) for k, t in rows], "doc_id long, text string"))
    assert sorted((r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()) == sorted(
        [(1, p.replace(" ", "\n"), 0), (2, "x", 1), (2, "y", 1), (2, "z", 0)]
    )


def test_long_lines_are_found_in_whole_texts(spark):
    long = " ".join(f"w{k}" for k in range(15))
    texts = ["", None, long, f"{long}\n", f"\n\n{long}\nshort\n{long} é", "\n", f"x{long}\r\n{long[:-4]}\n{long}", f" {long} \n\n"]
    rows = spark.createDataFrame([*enumerate(texts)], "doc long, text string").coalesce(1)
    got = rows.select("doc", paragraph_dedup.screener(5, 3, 15)("text").alias("s")).collect()
    found = {r["doc"]: [(line["place"], line["n"], len(line["single"])) for line in r["s"]] for r in got}
    for doc, text in enumerate(texts):
        counts = [len(SPACED.findall(line)) for line in (text or "").split("\n")]
        assert found[doc] == [(k, n - 4, 3) for k, n in enumerate(counts) if n >= 15]
    keys = {line["key_a"] for r in got if r["doc"] in (2, 3, 7) for line in r["s"]}
    assert len(keys) == 1


def test_tuned_bands():
    shape = paragraph_dedup.tuned()
    assert (1 - 0.8**shape.rows) ** shape.bands + 0.2 ** paragraph_dedup.screening() <= 1e-6
    assert shape.rows * shape.bands <= 160


def test_tables_dealt_by_a_key_stay_where_they_are(spark):
    texts = spark.createDataFrame([(k % 40, f"text {k}", None) for k in range(200)], "doc long, text string, x int")
    found = spark.createDataFrame([(k, f"w{k}") for k in range(0, 80, 2)], "doc long, w string")
    dealt = write_by_key(texts, "doc")
    again = write_by_key(dealt.join(found.hint("shuffle_hash"), "doc"), "doc", dealt=True)
    want = sorted(map(tuple, texts.join(found, "doc").collect()))
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, texts.collect()))
    assert sorted(map(tuple, again.collect())) == want and len(want) == 100
    with settings(spark, WRITING):
        joined = again.join(found.withColumnRenamed("w", "v").hint("shuffle_hash"), "doc")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "ShuffledHashJoin" in plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def _moved(plan):
    """What is read with its texts right under exchanges for joins by document; of a round's few texts a union is moved."""
    scans = [x.partition("Scan ")[0:3:2] for x in re.split(r"Exchange hashpartitioning\(doc\w*#\d+L?, \d+\), ENSURE", plan)[1:]]
    return [scan.split("\n")[0] for above, scan in scans if "text#" in scan.split("\n")[0] and "Union" not in above]


def test_texts_are_dealt_once(spark, monkeypatch):
    """Joins with found lines and passages move no text, at any size; one round or many."""
    plans = []
    for name in ("parquet", "saveAsTable"):

        def written(self, *args, write=getattr(DataFrameWriter, name), **kwargs):
            plans.append(self._df._jdf.queryExecution().executedPlan().toString())
            return write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, name, written)
    rng = random.Random(1)
    said = [[f"{rng.choice('abc')}{rng.randrange(4)}" for _ in range(rng.randrange(4, 14))] for _ in range(12)]
    rows = [(k, "\n".join(" ".join(line) for line in rng.choices(said, k=rng.randrange(12)))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        got = {r["doc_id"]: r["text"].split() for r in paragraph_dedup.dedup(docs, passage=8).collect()}
    assert got == {k: t.split() for k, t in plain_dedup(rows, 8)[0].items()}
    assert len(plans) > 20 and any("ShuffledHashJoin" in plan for plan in plans)
    # of the rounds only the table of the last few texts is not dealt
    assert [x for plan in plans for x in _moved(plan) if "later-" not in x and "cut-" not in x] == []


def test_a_pivot_is_not_set_against_its_bucket_again(spark, monkeypatch):
    read, verified = [], minhash_dedup._verified

    def counted(pairs, texts, shape):
        read.append({tuple(r) for r in pairs.collect()})
        return verified(pairs, texts, shape)

    monkeypatch.setattr(minhash_dedup, "_verified", counted)
    # each shares two thirds of its shingles with one other text: they meet in bands and are not alike
    texts = [" ".join([f"p{k}_{j}" for j in range(60)] + [f"{side}{k}_{j}" for j in range(12)]) for k in range(40) for side in "xy"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.classes(docs).collect()}
    assert got == {k: k for k in range(80)}
    assert len(read[0]) > 5 and not set().union(*read[1:])


def test_long_windows_tell_stretches_apart():
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(["a", "b"], rng.integers(0, 150))) for _ in range(40)]
    data, offsets = utf8(pa.array(texts))
    words = find_words(data, offsets, SPACED_BYTES)
    hashes = Hasher().ranges(data, words.starts, words.ends)
    for size in (1, 2, 7, 8, 20, 51):
        runs, first = long_windows(words, hashes, size)
        want = [(t, k) for t, text in enumerate(texts) for k in range(len(text.split()) - size + 1)]
        assert len(runs) == len(first) == len(want)
        assert [(words.text[f], f - words.bounds[words.text[f]]) for f in first] == want
        said = [tuple(texts[t].split()[k : k + size]) for t, k in want]
        assert len(set(runs.tolist())) == len(set(said)) == len(set(zip(runs.tolist(), said)))


def test_one_coordinate_shared_by_chance_is_not_signed():
    t, k = 0.8, paragraph_dedup.screening()
    missed = sum(math.comb(k, x) * t**x * (1 - t) ** (k - x) for x in range(paragraph_dedup.MET))
    shape = paragraph_dedup.tuned()
    assert paragraph_dedup.MET > 1 and missed + (1 - t**shape.rows) ** shape.bands <= 1e-6


def test_columns_without_a_type_stay(spark):
    p = " ".join(f"p{k}" for k in range(60))
    docs = spark.createDataFrame([(1, p, 5), (2, f"{p} x", 6), (None, p, 7)], "doc_id long, text string, n_removed int")
    got = paragraph_dedup.dedup(docs.selectExpr("null AS empty", "*", "struct(1 AS x) AS s")).collect()
    assert got[0].asDict().keys() == {"empty", "doc_id", "text", "s", "n_paragraphs", "n_removed"}
    assert {(r["doc_id"], r["text"], r["empty"], r["s"]["x"]) for r in got} == {(1, p, None, 1), (2, "", None, 1), (None, p, None, 1)}

"""The pipeline's stages over the given documents, each by its own input."""

import pytest

import corpus_pipeline
from tests.llm.plain import shingles, similar_classes
from tests.llm.test_decontaminate import _plain
from tests.llm.test_minhash import plain_dedup
from tidemark.llm import quality_rules, sentencepiece_viterbi
from tidemark.session import write_and_read


@pytest.fixture(scope="module")
def outputs(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = write_and_read(stage(spark, docs, data_dir), name)
        out.append(docs)
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_columns_stay(outputs):
    for before, after in zip(outputs[:-2], outputs[1:-1], strict=True):
        assert after.columns == before.columns
    assert outputs[-1].where("n_chars <> length(text)").count() == 0


def test_rejected_documents_go(outputs):
    kept = {r["doc_id"] for r in quality_rules.judge(outputs[0]).where("kept").collect()}
    assert set(_texts(outputs[1])) == kept


def test_one_document_of_each_class_stays(outputs):
    rows = sorted(_texts(outputs[1]).items())
    first = similar_classes([shingles(t) for _, t in rows], 85)
    assert sorted(_texts(outputs[2])) == [i for k, (i, _) in enumerate(rows) if first[k] == k]


def test_repeated_paragraphs_go(outputs):
    """Lines and passages that an earlier document has; nothing else."""
    before, after = _texts(outputs[2]), _texts(outputs[3])
    assert after == plain_dedup(sorted(before.items()))[0]


def test_contaminated_documents_lose_the_benchmark(spark, data_dir, outputs):
    items = [tuple(r) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()]
    before, after = _texts(outputs[3]), _texts(outputs[4])
    assert set(before) == set(after)
    judged, left = _plain(before.items(), items), _plain(after.items(), items)
    assert any(row[4] for row in judged.values()) and not any(row[4] for row in left.values())
    assert all(after[d] == before[d] for d, row in judged.items() if not row[4])


def test_tokens_decode_to_the_texts(outputs):
    viterbi = sentencepiece_viterbi.Viterbi(sentencepiece_viterbi.Pieces(sentencepiece_viterbi.model_path()))
    before = _texts(outputs[4])
    rows = outputs[5].collect()
    assert len(rows) == len(before)
    for row in rows:
        assert row["text"] == before[row["doc_id"]] and row["n_tokens"] == len(row["tokens"])
        assert viterbi.encode([row["text"]])[0].tolist() == row["tokens"]


def _through(spark, docs, data_dir):
    for name, stage in corpus_pipeline.STAGES:
        docs = write_and_read(stage(spark, docs, data_dir), name)
    return docs


def test_edges_pass_through_all_stages(spark, data_dir):
    """Missing ids and texts, texts without words, repeated rows, ties, very long texts, columns named as the stages' own."""
    word = lambda k: "".join("bcdfghklmn"[int(c)] + "aeiou"[(k + int(c)) % 5] for c in f"{k * 7919 % 100000:05d}")
    prose = lambda first, n: " ".join(word(first + k) for k in range(n))
    long = prose(5000, 20_000)
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"),
        (10, prose(0, 120)), (11, prose(0, 120)),  # a copy: the first stays
        (20, prose(300, 90)), (20, prose(300, 90)),  # one row twice: both stay
        (30, long), (31, prose(600, 80) + "\n" + prose(5100, 60) + "\n" + prose(800, 70)),  # a passage of 30
        (None, prose(900, 100)), (None, prose(900, 100)), (None, None),
    ]
    names = "id string, hits string, label string, n string, kept string, band string"
    docs = spark.createDataFrame(
        [(i, t, None, None, 1, "a", "b", "c", "d", "e", "f") for i, t in rows],
        f"doc_id long, text string, lang string, source string, n_chars long, {names}",
    )
    out = _through(spark, docs, data_dir)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=lambda r: (r[0] is None, r[0] or 0))
    assert [i for i, _ in got] == [10, 20, 20, 30, 31, None, None]
    texts = dict(got)
    assert texts[10] == prose(0, 120) and texts[20] == prose(300, 90) and texts[30] == long
    assert prose(600, 80) in texts[31] and prose(800, 70) in texts[31] and prose(5100, 60) not in texts[31]
    assert out.select(*names.replace(" string", "").split(", ")).distinct().collect() == [tuple("abcdef")]


def test_an_empty_table_passes_through_all_stages(spark, data_dir):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    assert _through(spark, docs, data_dir).count() == 0

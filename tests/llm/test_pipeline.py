"""The pipeline against a brute-force version, stage by stage."""

import sys
import tempfile
from collections import Counter

import public_tokenizers
import pytest
from test_dedup import brute_components, line_expected, plain_fingerprint
from test_tokens import check_packing, library

import corpus_pipeline
from gridpulse.llm.common import plain_words

SF = "/root/testdata/sf0.001"


def grams(words):
    return Counter(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def holds_item(text, items):
    """Whether some window of an item's size has weighted shingle similarity 0.8 or more."""
    words = plain_words(text)
    for item in items:
        n = len(item)
        if not n or not words:
            continue
        wanted = grams(item)
        for lo in range(max(1, len(words) - n + 1)):
            window = words[lo : lo + n]
            if window[0] in item:
                got = grams(window)
                if (got & wanted).total() >= 0.8 * (got | wanted).total():
                    return True
    return False


@pytest.fixture(scope="module")
def documents(spark):
    own = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    line = "this very line stands in many of the documents"
    rows = [(10_000 + i, f"{line}\nthe house number {i} and the garden of the town {i * 7}\nend {i}", "en", None, 1) for i in range(12)]
    rows += [(10_100, None, None, "x", None), (10_101, "123 !!! 456", None, "x", 0), (10_102, "", "en", "x", 0)]
    return own.union(spark.createDataFrame(rows, own.schema))


def test_stages_match_brute_force(spark, documents):
    items = [plain_words(r.text or "") for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r.doc_id: r.text for r in documents.collect()}
    stages = dict(corpus_pipeline.STAGES)
    columns = documents.columns

    first = stages["language_id"](spark, documents, SF).cache()
    assert first.columns == columns
    kept = {r.doc_id: r.text for r in first.collect()}
    assert set(rows) - set(kept) == {10_100, 10_101, 10_102}  # no letters: no language

    second = stages["line_dedup"](spark, first, SF).cache()
    assert second.columns == columns and second.schema == first.schema
    got = {r.doc_id: (r.text, r.n_chars) for r in second.collect()}
    expected = {i: t for i, t, *_ in line_expected(list(kept.items()), 10)}
    assert {i: t for i, (t, _) in got.items()} == expected
    assert all(n == len(t) for i, (t, n) in got.items() if i >= 10_000) and "many of the documents" not in got[10_003][0]

    third = stages["simhash_near_dedup"](spark, second, SF).cache()
    ids = sorted(expected)
    classes = brute_components([plain_fingerprint(expected[i]) for i in ids], ids, 3)
    third_ids = {r.doc_id for r in third.collect()}
    assert third.columns == columns and third_ids == set(classes.values())

    fourth = stages["decontamination"](spark, third, SF).cache()
    clean = {i for i in third_ids if not holds_item(expected[i], items)}
    assert fourth.columns == columns and {r.doc_id for r in fourth.collect()} == clean

    last = stages["packing"](spark, fourth, SF).collect()
    whole = library("byte_bpe_50k.json")
    check_packing(last, {i: [*whole(expected[i]), 2] for i in clean}, 1024)


def test_decisions_belong_to_rows(spark, documents):
    """Rows of one id, or without any, are each answered by their own text."""
    stages = dict(corpus_pipeline.STAGES)
    schema = documents.schema
    make = lambda rows: spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], schema)
    texts = lambda df: Counter((r.doc_id, r.text) for r in df.collect())

    english = [r.text for r in documents.where("lang = 'en' and doc_id < 10000").limit(6).collect()]
    found = stages["language_id"](spark, documents.union(make([(None, english[0]), (None, "123 !!"), (10_200, english[1]), (10_200, "456 ??")])), SF)
    assert texts(found.where("doc_id is null or doc_id = 10200")) == Counter([(None, english[0]), (10_200, english[1])])

    rows = [(i, f"a common line\nown {i}") for i in range(10)] + [(None, f"a common line\nnull {k}") for k in range(3)] + [(None, "nothing"), (5, "other"), (5, "a common line\nagain"), (5, "a common line\nagain")]
    assert texts(stages["line_dedup"](spark, make(rows), SF)) == Counter((i, t.replace("a common line\n", "")) for i, t in rows)

    rows = [(7, english[0]), (7, english[0]), (3, english[0]), (None, english[0]), (None, english[1]), (None, english[1]), (7, english[2]), (3, english[3])]
    assert texts(stages["simhash_near_dedup"](spark, make(rows), SF)) == Counter([(3, english[0]), (None, english[1]), (7, english[2]), (3, english[3])])

    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    rows = [(None, item), (None, "clean"), (4, item), (4, "clean too")]
    assert texts(stages["decontamination"](spark, make(rows), SF)) == Counter([(None, "clean"), (4, "clean too")])


def test_empty_documents_go_through(spark, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_stage_list_and_tokenizer():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    assert public_tokenizers.path("byte_bpe_50k.json") and "corpus_pipeline" in sys.modules


def test_rows_of_files_are_known_by_their_place(spark, documents):
    """Stages over Parquet files, whose rows get keys without a copy, answer like those over other rows."""
    extra = [(None, "a common line\nthe house and the garden", "en", "x", 5), (7, "a common line\nthe house and the garden", "en", "x", 5)] * 6
    rows = documents.union(spark.createDataFrame(extra, documents.schema)).repartition(5)
    path = tempfile.mkdtemp(prefix="pipeline-rows-") + "/docs"
    rows.write.parquet(path)
    files = spark.read.parquet(path)
    keyed = corpus_pipeline._keyed(files)
    assert keyed.select(corpus_pipeline.ROW).distinct().count() == keyed.count() == rows.count()
    assert sorted(map(str, keyed.drop(corpus_pipeline.ROW).collect())) == sorted(map(str, files.collect()))
    for name, stage in corpus_pipeline.STAGES[:4]:
        got = [Counter((r.doc_id, r.text) for r in stage(spark, x, SF).collect()) for x in (files, rows)]
        assert got[0] == got[1] and got[0], name

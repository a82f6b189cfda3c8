"""Tokens, packing and token files: exact round trips."""

import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gridpulse.llm.packing import fill_one, pack, plan
from gridpulse.llm.token_files import decode_ranks, encode_ranks, read_token_files, write_token_files
from gridpulse.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "  a b  c ", "a\nb \nc d", "'s'll ''s  \n\n x\t\ty  ", "<|endoftext|> a", "日本語 テキスト x", "é é İstanbul ﬁ", "\x85\xa0 a\xa0b", "''''ve're", "a\x1cb ​", "It's 12½ ²x"]


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def rows_of(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, None), (20_001, "long text here " * 40_000), (20_002, ""), (20_002, "again")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", "x") for i, t in rows], "doc_id long, text string, start int, length string, ids string")


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_cached_ids_are_the_library_s(spark, name, kind):
    texts = [t or "" for _, t in rows_of(spark)]
    whole = library(name)
    expected = [np.array(whole(t), "<u4").tobytes() for t in texts]
    for own in (Encoder(public_tokenizers.path(name), kind), Encoder(public_tokenizers.path(name), kind, room=50, chunk=64)):
        assert [own.encode(t) for t in texts] == expected


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", "byte"), ("word_bpe_49k.json", "word")])
def test_parts_of_letters_are_not_cut(name, kind):
    """Letters between blanks are looked up as the one word that they are; all other parts are cut by the pattern."""
    own, cut = Encoder(public_tokenizers.path(name), kind), []
    pattern = own.cut
    own.cut = lambda text: cut.append(text) or pattern(text)
    text = "first Straße \xaa\xb5\xba Éÿ it's x2 last"
    assert own.encode(text) == np.array(library(name)(text), "<u4").tobytes()
    assert cut == ["first", " it's", " x2"]


def check_packing(got, ids, capacity):
    by_doc, by_sequence = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == ids.keys()
    for doc_id, pieces in by_doc.items():
        own, at = ids[doc_id], 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == capacity)
            assert r.ids_crc32 == zlib.crc32(np.array(own[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(own) and (len(pieces) == 1 or len(own) > capacity)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return len(by_sequence)


def test_packing_is_whole_and_tight(spark):
    rows = [r for r in rows_of(spark) if r[0] != 20_002]
    whole = library("byte_bpe_50k.json")
    ids = {i: [*whole(t), 2] for i, t in rows}
    got = pack(frame(spark, rows), public_tokenizers.path("byte_bpe_50k.json")).collect()
    sequences = check_packing(got, ids, 1024)
    assert sequences <= 1.05 * sum(map(len, ids.values())) / 1024 + 1
    small = pack(frame(spark, rows[-8:]), public_tokenizers.path("byte_bpe_50k.json"), capacity=7).collect()
    check_packing(small, dict(list(ids.items())[-8:]), 7)
    assert pack(frame(spark, []), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_best_two_replace_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[6, 3, 2]] = 1, 1, 2  # greedy leaves a gap of 1: 6 + 3; the 3 gives way to 2 + 2
    assert sorted(fill_one(counts, 10)) == [2, 2, 6]
    rng = np.random.default_rng(2)
    for _ in range(20):
        histogram = {int(k): int(n) for k, n in zip(rng.integers(1, 65, 20), rng.integers(1, 500, 20), strict=True)}
        runs = plan(histogram, 64)
        total = {}
        bins = {}
        for length, first, n, per, offset, sequence in runs:
            assert first == total.get(length, 0)
            total[length] = first + n
            for s in range(sequence, sequence + n // per):
                bins.setdefault(s, []).append((offset, per * length))
        assert total == histogram
        for parts in bins.values():
            at = 0
            for offset, size in sorted(parts):
                assert offset == at
                at += size
            assert at <= 64


def test_variable_length_code_round_trip():
    rng = np.random.default_rng(4)
    for n in (0, 1, 3, 4, 5, 1003):
        ranks = (rng.integers(0, 1 << 32, n).astype("<u4")) >> rng.integers(0, 32, n).astype("<u4")
        control, data = encode_ranks(ranks)
        assert len(control) == (n + 3) // 4 and (decode_ranks(control, data, n) == ranks).all()


def test_token_files_round_trip_in_order(spark):
    rows = [*rows_of(spark), (None, "no id")]
    whole = library("word_bpe_49k.json")
    path = tempfile.mkdtemp(prefix="token-files-") + "/out"
    write_token_files(frame(spark, rows), path, public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    expected = {}
    for i, t in rows:
        expected.setdefault(i, []).append(np.array([*whole(t), 1], "<u4").tobytes())
    for r in got:
        assert r.start == at and r.n_tokens * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
        expected[r.doc_id].remove(bytes(r.ids))
    short = read_token_files(spark, path, with_ids=False)
    assert sorted(map(tuple, short.collect()), key=str) == sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=str)
    empty = tempfile.mkdtemp(prefix="token-files-") + "/out"
    write_token_files(frame(spark, []), empty, public_tokenizers.path("word_bpe_49k.json"))
    assert read_token_files(spark, empty).count() == 0

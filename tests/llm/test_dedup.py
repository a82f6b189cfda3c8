"""Exact, line and near-duplicate operators against brute force, with edge cases."""

import hashlib
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import functions as F

from gridpulse.llm import exact_dedup as ed
from gridpulse.llm.components import components
from gridpulse.llm.exact_dedup import build_directory, exact_dedup
from gridpulse.llm.line_dedup import LineRuns, line_dedup
from gridpulse.llm.simhash_dedup import bucket_forest, covering_masks, fingerprint, fingerprint_links, simhash_classes

CLASHING = "doc_id long, text string, norm string, key string, n int, th string, h1 string, fp string, node string"


def frame(spark, rows):
    """Rows (doc_id, text) with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, t, "x", "x", 1, "x", "x", "x", "x") for i, t in rows], CLASHING)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


EDGE = [(1, "Same Text"), (2, "same text"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "same  text"), (7, "other"), (None, "same text"), (9, "x" * 200_000), (10, "X" * 200_000)]


def exact_expected(rows):
    norm = [lower(t or "") for _, t in rows]
    size = Counter(norm)
    keep = {}
    for (i, _), n in zip(rows, norm, strict=True):
        if i is not None:
            keep[n] = max(keep.get(n, i), i)
    return sorted(((i, keep.get(n), size[n], i == keep.get(n), hashlib.sha256(n.encode()).hexdigest()) for (i, _), n in zip(rows, norm, strict=True)), key=str)


def exact_got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=str)


def test_exact_dedup_edge_cases(spark):
    assert exact_got(exact_dedup(frame(spark, EDGE))) == exact_expected(EDGE)
    assert exact_dedup(frame(spark, EDGE[:0])).count() == 0


def test_exact_dedup_chains_colliding_keys_and_splits_buckets(spark):
    rows = [(i, f"text {i % 150}") for i in range(400)] + [(1000 + i, "hot") for i in range(300)]
    got = exact_dedup(frame(spark, rows), capacity=10, key_bits=4).cache()
    assert exact_got(got) == exact_expected(rows)
    assert got.agg({"chain": "max"}).first()[0] > 3  # 151 texts under 16 keys
    wide = exact_dedup(frame(spark, rows), capacity=10)
    assert exact_got(wide) == exact_expected(rows)
    assert wide.select("bucket").distinct().count() >= 15


def test_exact_dedup_answers_come_from_the_directory(spark, monkeypatch):
    """Entries that the directory puts into wrong buckets make wrong classes."""
    rows = [(i, f"text {i % 40}") for i in range(200)]
    docs = frame(spark, rows).repartition(5)
    assert exact_got(exact_dedup(docs, capacity=3)) == exact_expected(rows)
    right = ed.bucketed

    def wrong(entries, leaves):
        if "id" not in entries.columns:
            return right(entries, leaves)
        return right(entries, leaves).withColumn("bucket", F.when(F.col("id") % 2 == 0, F.col("bucket")).otherwise(F.lit(0)))

    monkeypatch.setattr(ed, "bucketed", wrong)
    assert exact_got(exact_dedup(docs, capacity=3)) != exact_expected(rows)


def test_exact_dedup_compares_bytes_across_tasks(spark):
    """One key for all: every link of the chain is found by comparing texts that several tasks hold."""
    rows = [(i, f"Text {i % 7}") for i in range(300)]
    got = exact_dedup(frame(spark, rows).repartition(8), key_bits=1).cache()
    assert exact_got(got) == exact_expected(rows)
    assert got.select("bucket", "chain").distinct().count() == 7


def test_directory_leaves_cover_the_key_space_and_hold_the_capacity(spark):
    entries = spark.range(5000).selectExpr("xxhash64(id) AS key")
    leaves = build_directory(entries, capacity=40, max_bits=64)
    assert sum(2.0**-d for _, d, _ in leaves) == 1.0
    assert sum(n for *_, n in leaves) == 5000 and max(n for *_, n in leaves) <= 40
    same = spark.range(100).selectExpr("CAST(7 AS long) AS key")
    assert sum(n for *_, n in build_directory(same, capacity=10, max_bits=64)) == 100


def line_expected(rows, min_docs, min_chars=1):
    blanks = " \t\n\x0b\x0c\r"
    docs = {}
    for i, t in rows:
        docs.setdefault((i, t or ""), None)
    count = Counter(k for _, t in docs for k in {lower(x.strip(blanks)) for x in t.split("\n")} if len(k) >= min_chars)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[lower(x.strip(blanks))] < min_docs]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def test_line_dedup_matches_brute_force(spark):
    rows = [(i, f"Head {i}\n  COMMON line\t\nown {i % 7}\n\ncommon Line") for i in range(20)]
    rows += [(100, None), (101, ""), (102, "common line"), (102, "common line"), (None, "common line\nx"), (103, "\n\n"), (104, "É\né\x0b")]
    rows += [(105, "\n".join(f"l{j}" for j in range(5000)) + "\ncommon line")]
    for batches, fanout in ((1, 2), (4, 2), (5, 3)):
        got = line_dedup(frame(spark, rows), min_docs=3, batches=batches, fanout=fanout)
        assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str) == line_expected(rows, 3)
    long_only = line_dedup(frame(spark, rows), min_docs=3, min_chars=6)
    assert sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in long_only.collect()), key=str) == line_expected(rows, 3, 6)
    assert line_dedup(frame(spark, [])).count() == 0


def test_line_runs_compact_and_drop_settled_keys(spark):
    runs = LineRuns(spark, min_docs=5, fanout=2, buckets=4)
    batch = spark.range(10).selectExpr("id AS h1", "id AS h2", "IF(id = 0, 5L, 2L) AS n")
    for _ in range(3):
        runs.add(batch)
    assert len(runs.names()) == 2 and len(runs.levels[0]) == 1
    assert spark.table(runs.levels[0][0]).where("h1 = 0").count() == 0  # settled by the first batch
    assert sorted(r.h1 for r in runs.common().collect()) == list(range(10))


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprint_matches_its_definition(spark):
    texts = ["", " \t", "one", "one two", "A b C d E f", "x " * 70_000, "É ß ñ a b", "a\x0bb\x0cc d e"]
    assert [fingerprint(t, 3) for t in texts] == [plain_fingerprint(t) for t in texts]
    assert spark.sql("SELECT xxhash64('a b c') h").first().h % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_masks_cover_every_difference_of_three_bits():
    masks = covering_masks(3)
    assert len(masks) == 15
    rng = np.random.default_rng(1)
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(diff & m == 0 for m in masks)


def brute_components(fps, ids, radius):
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in zip(ids, fps, strict=True):
        for b, y in zip(ids, fps, strict=True):
            if (x ^ y).bit_count() <= radius:
                i, j = find(a), find(b)
                up[max(i, j)] = min(i, j)
    return {i: find(i) for i in ids}


def test_links_give_the_components_of_all_pairs(spark):
    rng = np.random.default_rng(5)
    centres = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    fps = []
    for k in range(250):
        x = centres[k % 12]
        for b in rng.choice(64, int(rng.integers(0, 6)), replace=False):
            x ^= 1 << int(b)
        fps.append(x)
    fps = sorted(set(fps))
    ids = list(range(len(fps)))
    signed = [x - (1 << 64) if x >= 1 << 63 else x for x in fps]
    rows = spark.createDataFrame(list(zip(signed, ids, strict=True)), "fp long, node long")
    expected = brute_components(fps, ids, 3)
    for block in (4096, 5):  # 5: buckets are split into pairs of blocks
        got = {r.node: r.component for r in components(fingerprint_links(rows, 3, block)).collect()}
        assert {i: got.get(i, i) for i in ids} == expected


def test_bucket_forest_spans():
    fps = np.array([0, 1, 3, 7, 0xFF << 40, 0xFF << 40 | 1], np.uint64)
    assert len(bucket_forest(fps, 3)) == 4


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(5, j) for j in range(200, 400)] + [(7, 7), (8, 9), (9, 8)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[i] for i in range(100, 161)} == {100} and {got[j] for j in range(200, 400)} == {5} and got[9] == 8 and 7 not in got
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_classes_edge_cases(spark):
    base = "one two three four five six seven eight nine ten " * 30
    rows = [(3, base), (1, base.upper()), (2, None), (4, " "), (5, "completely different words in this other text"), (None, base), (None, "alone here"), (5, "completely different words in this other text")]
    got = sorted(((r.doc_id, r.component_id) for r in simhash_classes(frame(spark, rows)).collect()), key=str)
    assert got == sorted([(3, 1), (1, 1), (2, 2), (4, 2), (5, 5), (5, 5), (None, 1), (None, None)], key=str)
    assert simhash_classes(frame(spark, [])).count() == 0

"""Collocations, SetSketch near-dedup and hard negatives against brute force, with edge cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from gridpulse.llm import collocations as co
from gridpulse.llm import hard_negatives as hn
from gridpulse.llm import minhash_dedup as md


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ------------------------------------------------------------- collocations --
def phrases_brute(rows, min_count, longest, inside, top):
    count, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                count[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in count.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        rows_of = []
        for p, a in cand.items():
            around = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= inside * a for b in around):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows_of.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows_of)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, total[lang], -s))
    return sorted(out)


def phrases_got(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


CLASHING = "lang string, text string, phrase string, n long, words int, h long, a long, k int"


def texts_frame(spark, rows):
    return spark.createDataFrame([(lang, t, "x", 1, 1, 1, 1, 1) for lang, t in rows], CLASHING)


def random_texts(n, seed):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gamma", "ünter", "delta", "e", "Zeta x", "\x00", "eta"]
    out = []
    for _ in range(n):
        parts = [rng.choices(words, [30, 20, 10, 5, 5, 5, 3, 2, 1])[0] + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!"]) for _ in range(rng.randrange(0, 60))]
        out.append((rng.choice(["en", "en", "de", None]), "".join(parts)))
    return out


def test_collocations_match_brute_force(spark):
    rows = random_texts(300, 1) + [("en", None), ("de", ""), (None, " . "), ("und", "beta gamma " * 30), ("en", "hot phrase here, " * 500), ("xx", "once only")]
    docs = texts_frame(spark, rows).repartition(7)
    for longest, inside, top in ((3, 50, 2000), (4, 90, 20), (2, 50, 3)):
        got = co.collocations(docs, min_count=10, longest=longest, inside_percent=inside, top=top)
        assert phrases_got(got) == phrases_brute(rows, 10, longest, inside, top)
    assert co.collocations(texts_frame(spark, []), min_count=10).count() == 0
    assert co.collocations(texts_frame(spark, [("en", "a b c")]), min_count=10).count() == 0


def test_every_frequent_phrase_is_frequent_in_some_shard(spark):
    rows = random_texts(200, 2)
    texts = spark.createDataFrame([(lang or "und", t) for lang, t in rows], "lang string, text string").repartition(9)
    found = {r.h for r in co.locally_frequent(texts, 10, 3, 4).collect()}
    wanted = set()
    for lang in {lang or "und" for lang, _ in rows}:
        p = co.Phrases([t for x, t in rows if (x or "und") == lang], lang)
        for _, _, count, h in p.of_length(3):
            wanted |= set(h[count >= 10].tolist())
    assert wanted <= found
    every = co.locally_frequent(texts, 1, 3, 4).count()
    assert len(found) < every / 2  # rare phrases are left out


def test_counts_come_through_the_candidates(spark, monkeypatch):
    """Without a candidate's bit a phrase is not counted: the first pass decides what the second one counts."""
    rows = random_texts(100, 3)
    whole = co.collocations(texts_frame(spark, rows), min_count=10).count()
    monkeypatch.setattr(co, "candidate_bitmap", lambda hashes: np.zeros(1 << 12, np.uint8))
    assert whole > 0 and co.collocations(texts_frame(spark, rows), min_count=10).count() == 0


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_007_000_001
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big + 2), ("en", 2, "a b", big - 5)], "lang string, words int, phrase string, n long")
    (row,) = co.scored(counts).collect()
    assert row.score == 10**6 * (big - 5) ** 2 // (big * (big + 2))


def test_hashes_are_packed_without_loss():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 48, 5000, np.uint64))
    counts = np.arange(len(keys)) % 900 + 1
    got = co.unsqueeze(co.squeeze(keys, counts))
    assert (got[0] == keys).all() and (got[1] == counts).all()


# ----------------------------------------------------------------- SetSketch --
def sets_brute(rows, width, percent):
    def shingles(t):
        w = lower(t or "").encode().split()
        return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()

    own = [shingles(t) for _, t in rows]
    nodes = list({s for (i, _), s in zip(rows, own, strict=True) if s and i is not None})
    up = list(range(len(nodes)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(nodes)):
        for j in range(i):
            if 100 * len(nodes[i] & nodes[j]) >= percent * len(nodes[i] | nodes[j]):
                up[root(i)] = root(j)
    place = {s: root(i) for i, s in enumerate(nodes)}
    least = {}
    for (i, _), s in zip(rows, own, strict=True):
        if s and i is not None:
            least[place[s]] = min(least.get(place[s], i), i)
    return sorted(((i, len(s), (i if not s else least.get(place.get(s)))) for (i, _), s in zip(rows, own, strict=True)), key=str)


def sets_got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def sets_frame(spark, rows):
    names = "doc_id long, text string, node string, key string, n string, th string, bands string, label string, a string, b string, k1 string"
    return spark.createDataFrame([(i, t, *["x"] * 9) for i, t in rows], names)


def near_copies(seed, groups=12, size=9):
    rng = random.Random(seed)
    rows, n = [], 0
    for _ in range(groups):
        words = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(size):
            words = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(500)}"
            rows.append((n := n + 1, " ".join(words)))
    rng.shuffle(rows)
    return rows


SET_EDGE = [(1001, None), (1002, ""), (1003, " \n"), (1004, "one"), (1005, "ONE"), (1006, "a b"), (1007, "a b"), (1007, "other words here"), (None, "a b"), (None, "never seen"), (1008, "a b " * 30_000), (1009, "A b " * 30_001), (1010, "a b"), (1010, "a b")]


def test_setsketch_classes_match_brute_force(spark):
    rows = near_copies(1) + SET_EDGE
    for block in (512, 4):
        got = md.setsketch_classes(sets_frame(spark, rows), width=2, percent=80, block=block)
        assert sets_got(got) == sets_brute(rows, 2, 80)
    assert md.setsketch_classes(sets_frame(spark, []), width=2).count() == 0


def test_setsketch_default_takes_five_words(spark):
    rows = near_copies(2, groups=5)
    assert sets_got(md.setsketch_classes(sets_frame(spark, rows))) == sets_brute(rows, 5, 80)


def test_setsketch_joins_a_long_chain_and_a_large_group(spark):
    """A chain in which only neighbours link, and a group of copies that differ in one word each."""
    chain = [(i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 80))) for i in range(40)]
    base = [f"g{i}" for i in range(60)]
    group = [(5000 + i, " ".join([*base[:30], f"own{i}", *base[31:]])) for i in range(300)]
    rows = chain + group
    assert sets_got(md.setsketch_classes(sets_frame(spark, rows), width=2, block=64)) == sets_brute(rows, 2, 80)


def test_registers_are_mergeable_and_agree_with_the_similarity():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 3000, np.uint64)
    a, b = np.sort(pool[:2000]), np.sort(pool[500:2500])
    assert (md.merge(md.registers(a), md.registers(b)) == md.registers(np.union1d(a, b))).all()
    share = np.mean(md.registers(a) == md.registers(b))
    assert abs(share - 1500 / 2500) < 4 * math.sqrt(0.6 * 0.4 / md.BANDS / md.ROWS)


def test_likelihood_dismisses_the_unlike_only():
    rng = np.random.default_rng(6)
    for shared, wanted in ((900, False), (800, False), (200, True), (0, True)):
        whole = rng.integers(0, 1 << 63, 2000 - shared, np.uint64)
        a, b = np.sort(whole[:1000]), np.sort(whole[1000 - shared :])
        assert md.hopeless(md.registers(a), len(a), md.registers(b)[None, :], np.array([len(b)]), 0.8)[0] == (wanted and 100 * shared < 80 * (2000 - shared))


def test_pairs_at_the_threshold_meet_in_some_band():
    rng = np.random.default_rng(7)
    met = 0
    for _ in range(300):
        whole = rng.integers(0, 1 << 63, 100, np.uint64)
        a, b = np.sort(whole[:90]), np.sort(np.concatenate((whole[:80], whole[90:])))
        met += bool(set(md.band_keys(md.registers(a))) & set(md.band_keys(md.registers(b))))
    assert met == 300


# ------------------------------------------------------------ hard negatives --
def negatives_brute(rows, every, positives=5, negatives=5, least=80, most=100):
    own = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (label, [math.floor(256 * x) for x in v])
        own[i] = min(own.get(i, row), row)

    def score(a, b):
        return sum(x * y for x, y in zip(a, b, strict=False))

    out = []
    for i, (label, v) in own.items():
        if i % every:
            continue
        near = sorted((-score(v, w), j) for j, (other, w) in own.items() if j != i and other == label)[:positives]
        for s, j in near:
            hard = sorted((-score(v, w), k) for k, (other, w) in own.items() if other != label and least * -s <= 100 * score(v, w) <= most * -s)
            out += [(i, j, rank, k, -s, -t) for rank, (t, k) in enumerate(hard[:negatives], 1)]
    return sorted(out)


def negatives_got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


VECTORS = "vec_id long, label int, embedding array<float>, v string, norm string, angles string, score string, window string"


def vector_frame(spark, rows):
    return spark.createDataFrame([(i, label, v, *["x"] * 5) for i, label, v in rows], VECTORS)


def vectors(n, seed, dim=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, dim))
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 4))
        v = (centres[label] + rng.normal(size=dim) * 0.8).astype(np.float32)
        rows.append((i, label, [float(x) for x in v / np.linalg.norm(v)]))
    return rows


def test_hard_negatives_match_brute_force(spark):
    rows = vectors(400, 1) + [
        (1000, 1, [0.0] * 6), (1010, None, [0.1] * 6), (1020, 2, None), (1030, 2, [0.1, None, 0.1, 0.1, 0.1, 0.1]),
        (1040, 2, [float("nan")] * 6), (1050, 2, [float("inf")] * 6), (None, 1, [0.5] * 6), (1060, 3, []), (1070, 3, [0.9, 0.9]),
        (1080, 0, [0.3] * 6), (1080, 0, [0.3] * 6), (1090, 1, [0.3] * 6), (1090, 0, [0.2] * 6),
    ] + [(2000 + i, i % 2, [0.5, 0.25, 0.0, 0.0, -0.125, 0.0]) for i in range(120)]
    got = hn.hard_negatives(vector_frame(spark, rows).repartition(5), F.col("vec_id") % 10 == 0)
    assert negatives_got(got) == negatives_brute(rows, 10)
    wide = hn.hard_negatives(vector_frame(spark, rows), F.col("vec_id") % 20 == 0, positives=2, negatives=7, least_percent=50, most_percent=90)
    assert negatives_got(wide) == negatives_brute(rows, 20, 2, 7, 50, 90)
    assert hn.hard_negatives(vector_frame(spark, rows[:0]), F.col("vec_id") % 10 == 0).count() == 0
    assert hn.hard_negatives(vector_frame(spark, rows[:3]), F.col("vec_id") % 10 == 9).count() == 0


def test_hard_negatives_in_several_passes(spark, monkeypatch):
    rows = vectors(300, 2)
    monkeypatch.setattr(hn, "PASS_ANCHORS", 20)
    monkeypatch.setattr(hn, "STEP_ANCHORS", 7)
    got = hn.hard_negatives(vector_frame(spark, rows), F.col("vec_id") % 5 == 0)
    assert negatives_got(got) == negatives_brute(rows, 5)


def test_score_bounds_hold_every_score_and_leave_pairs_out():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 12))
    v = np.floor(256 * (centres[rng.integers(0, 8, 600)] + 0.1 * rng.normal(size=(600, 12)))).astype(np.int64)
    v[0] = 0
    v[1] = v[2]
    norm, direction = hn.unit(v)
    angles = np.arccos(np.clip(direction @ hn.chosen_references(v[:200]).T, -1, 1))
    rows = hn.Rows(np.arange(600), np.zeros(600), v, norm, angles)
    low, high = hn.bounds(rows, rows)
    scores = v @ v.T
    assert (low <= scores).all() and (scores <= high).all()
    assert (high < 0.8 * norm[:, None] * norm[None, :]).mean() > 0.5


def test_inner_products_beyond_64_bits_are_exact():
    a = np.array([[2**40, 3], [1, 2]], np.int64)
    assert hn.dots(a, a).tolist() == [2**80 + 9, 5]

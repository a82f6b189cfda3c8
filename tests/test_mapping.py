import random
import string

from pyspark.sql import functions as F

from gridpulse.operators import mapping


def _lcs(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def _ratio(a, b):
    return 100.0 * (1 - (len(a) + len(b) - 2 * _lcs(a, b)) / (len(a) + len(b))) if a + b else 100.0


def _part(a, b):
    if not a or not b:
        return 100.0 if a == b else 0.0
    found = []
    for short, long in ((a, b), (b, a)):
        if len(short) <= len(long):
            found += [_ratio(short, long[i:j]) for i in range(len(long)) for j in range(i + 1, len(long) + 1)
                      if j - i == len(short) or j - i < len(short) and (i == 0 or j == len(long))]
    return max(found)


def _score(a, b):
    """The weighted ratio, written out from its definition."""
    one, two = sorted(a.split()), sorted(b.split())
    both, own, other = sorted(set(one) & set(two)), sorted(set(one) - set(two)), sorted(set(two) - set(one))
    joined = [" ".join(both), " ".join(both + own), " ".join(both + other)]
    longer, shorter = max(len(a), len(b)), min(len(a), len(b))
    if longer / shorter < 1.5:
        sets = [_ratio(joined[1], joined[2])] if not both else []
        if both:
            sets = [100.0 if not own or not other else 0.0, _ratio(joined[0], joined[1]), _ratio(joined[0], joined[2])]
            apart = len(" ".join(own)) + len(" ".join(other)) - 2 * _lcs(" ".join(own), " ".join(other))
            sets.append(100.0 * (1 - apart / (len(joined[1]) + len(joined[2]))))
        return max(_ratio(a, b), 0.95 * max(_ratio(" ".join(one), " ".join(two)), *sets))
    scale = 0.9 if longer / shorter < 8 else 0.6
    words = 100.0 if both else max(_part(" ".join(one), " ".join(two)), _part(" ".join(own), " ".join(other)))
    return max(_ratio(a, b), scale * _part(a, b), 0.95 * scale * words)


def test_known_scores(spark):
    raw = spark.createDataFrame([("il", "page"), ("il", "cmed|kane|"), ("il", "du page"), ("il", "zzz"), ("il", "county of cook")], "state string, raw string")
    master = spark.createDataFrame([("il", "dupage"), ("il", "kane"), ("il", "cook")], "state string, county string")
    out = {r.raw: (r.standard, round(r.score, 1)) for r in mapping.fuzzy_map(raw, master).collect()}
    assert out == {"page": ("dupage", 90.0), "cmed|kane|": ("kane", 90.0), "du page": ("dupage", 92.3), "county of cook": ("cook", 90.0)}


def _random_names(rng, n):
    words = ["st", "saint", "new", "la", "e", "x", "clair", "salle", "york", "du", "page", "ab", "abc", "prince george", "de kalb"]
    names = []
    for _ in range(n):
        s = list(rng.choice([" ", " ", ""]).join(rng.choice(words) for _ in range(rng.randint(1, 4))))
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(s) + 1)
            s[at : at + rng.randint(0, 1)] = rng.choice(["", "a", " ", "q"])
        names.append("".join(s).strip() or "a")
    return sorted(set(names))


def test_score_against_its_definition():
    rng = random.Random(3)
    for a, b in zip(_random_names(rng, 900), _random_names(rng, 900), strict=False):
        assert abs(mapping.weighted_ratio(a, b) - _score(a, b)) < 1e-9, (a, b)
    assert mapping.weighted_ratio("", "a") == 0.0 and mapping.weighted_ratio("a", "a") == 100.0


def test_score_against_its_sql():
    """The SQL that the oracle uses, on names of several words."""
    import duckdb

    from gridpulse.plans.oracle import fuzzy_ctes

    rng = random.Random(5)
    con = duckdb.connect()
    con.execute("CREATE TABLE names(state VARCHAR, raw VARCHAR)")
    con.execute("CREATE TABLE master(state VARCHAR, county VARCHAR)")
    con.executemany("INSERT INTO names VALUES ('s', ?)", [(x,) for x in _random_names(rng, 50)])
    con.executemany("INSERT INTO master VALUES ('s', ?)", [(x,) for x in _random_names(rng, 30)])
    rows = con.execute(f"WITH {fuzzy_ctes('names')} SELECT raw, standard, score FROM fz").fetchall()
    assert len(rows) > 1000 and all(abs(s - mapping.weighted_ratio(a, b)) < 1e-9 for a, b, s in rows)


def test_candidates_hold_every_pair_that_scores(spark):
    rng = random.Random(7)
    masters, raws = _random_names(rng, 90), _random_names(rng, 250)
    raw_df = spark.createDataFrame([("s", r) for r in raws], "state string, raw string")
    m_df = spark.createDataFrame([("s", m) for m in masters], "state string, county string")
    candidates = {(r.raw, r.standard) for r in mapping.fuzzy_candidates(raw_df, m_df).collect()}
    want = {(r, m) for r in raws for m in masters if mapping.weighted_ratio(r, m) >= 85.0}
    assert want <= candidates and len(want) > 300
    best = {r.raw: (r.standard, r.score) for r in mapping.fuzzy_map(raw_df, m_df).collect()}
    expected = {}
    for r, m in sorted(want):
        s = mapping.weighted_ratio(r, m)
        if r not in expected or s > expected[r][1]:
            expected[r] = (m, s)
    assert best == expected
    names = ["".join(rng.choice(string.ascii_lowercase[:6]) for _ in range(rng.randint(1, 9))) for _ in range(120)]
    few = mapping.fuzzy_candidates(spark.createDataFrame([("s", x) for x in names], "state string, raw string"), spark.createDataFrame([("s", x) for x in names], "state string, county string"))
    found = {(r.raw, r.standard) for r in few.collect()}
    assert {(a, b) for a in names for b in names if mapping.weighted_ratio(a, b) >= 85.0} <= found
    assert len(found) < len(set(names)) ** 2 / 3


def test_distinct_counties_skips_muni(spark):
    df = spark.createDataFrame([("s", "Fulton County", None, None), ("s", "Cobb", "x", " MUNI "), ("s", None, "Hall", "co"),
                                ("s", "county", None, None)], "state string, a string, b string, key string")
    out = sorted(r.raw for r in mapping.distinct_counties(df, ["a", "b"], key_col="key").collect())
    assert out == ["fulton", "hall"]

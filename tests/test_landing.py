"""Profiles, snapshots and incremental landing of feed files."""

import os
import time

import pytest
from pyspark.sql import functions as F

from gridpulse.sinks.commits import Commits
from gridpulse.sources import feeds
from gridpulse.sources.landing import Landing, file_counters

MAPS = {"xx": {"name": "county", "n_out": "per_outage_customers_affected", "cust_s": "customers_served", "timestamp": "timestamp"},
        "yy": {"name": "county", "n_out": "per_outage_customers_affected", "timestamp": "timestamp"}}
HEAD = "timestamp,EMC,name,n_out,cust_s\n"


def _write(root, state, name, text, mode="w"):
    os.makedirs(os.path.join(root, state), exist_ok=True)
    path = os.path.join(root, state, name)
    with open(path, mode, newline="") as f:
        f.write(text)
    return path


def _lines(day, n, start=0, emc="e1"):
    return "".join(f"2024-01-{day:02d} {i // 60 % 24:02d}:{i % 60:02d}:00,{emc},c{i % 7},{i},100\n" for i in range(start, start + n))


def _data_files(store):
    out = {}
    for folder, _, files in os.walk(f"{store}/data"):
        for f in files:
            if f.endswith(".parquet"):
                out.setdefault(os.path.relpath(folder, f"{store}/data").split("/run=")[0], set()).add(os.path.join(folder, f))
    return out


def _rows(df):
    return sorted((r.state, r.timestamp or "", r.emc or "", r.county or "", r.per_outage_customers_affected or "") for r in df.collect())


def test_profile_counts_lines_quotes_and_bytes(spark, tmpdir_path):
    plain = HEAD + _lines(1, 50)
    _write(tmpdir_path, "xx", "a_per_county.csv", "﻿" + plain)
    _write(tmpdir_path, "xx", "b_per_county.csv", HEAD + '2024-01-01 00:00:00,e1,"two\nlines",6,100\n2024-01-01 00:00:00,e1,"say ""x""",6,100\n')
    _write(tmpdir_path, "xx", "empty_per_county.csv", "")
    got = {os.path.basename(r.uri): r for r in feeds.profile_files(spark, tmpdir_path).collect()}
    assert set(got) == {"a_per_county.csv", "b_per_county.csv"}
    a, b = got["a_per_county.csv"], got["b_per_county.csv"]
    assert (a.header, a.n_lines, a.n_odd, a.data_bytes) == (HEAD.strip(), 51, 0, len(plain) - len(HEAD))
    assert (b.header, b.n_lines, b.n_odd) == (HEAD.strip(), 4, 2)


def test_plain_files_are_read_in_splits_and_quoted_ones_whole(spark, tmpdir_path):
    n = 120_000
    _write(tmpdir_path, "xx", "big_per_county.csv", HEAD + _lines(1, n))
    _write(tmpdir_path, "xx", "quoted_per_county.csv", HEAD + '2024-01-01 00:00:00,e1,"two\nlines",6,100\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500000")
    try:
        manifest = feeds.file_manifest(spark, tmpdir_path).where("is_feed")
        groups = feeds.header_groups(feeds.profile_files(spark, tmpdir_path), manifest, MAPS)
        assert [(g.quoted, len(g.paths)) for g in groups] == [(False, 1), (True, 1)]
        plain, quoted = (feeds.read_group(spark, g) for g in groups)
        assert plain.rdd.getNumPartitions() > 4 and plain.count() == n
        assert plain.select("row_id").distinct().count() == n
        assert [r.county for r in quoted.collect()] == ["two\nlines"]
        # the header is that of the file's first line, however many splits there are
        assert {r.header for r in feeds.file_headers(spark, tmpdir_path).collect()} == {HEAD.strip()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_states_with_one_layout_are_one_read(spark, tmpdir_path):
    for state in ("xx", "zz"):
        _write(tmpdir_path, state, "a_per_county.csv", HEAD + _lines(1, 3, emc=state))
    df, groups = feeds.read_feeds(spark, tmpdir_path, MAPS | {"zz": MAPS["xx"]})
    assert len(groups) == 2 and df._jdf.queryExecution().logical().toString().count("Union") == 0
    assert sorted((r.state, r.emc) for r in df.collect()) == [("xx", "xx")] * 3 + [("zz", "zz")] * 3


def test_unchanged_files_are_not_opened_again(spark, tmpdir_path):
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    path = _write(root, "xx", "a_per_county.csv", HEAD + _lines(1, 20))
    landing = Landing(spark, store)
    landing.land(root, MAPS)
    before, stat = _rows(landing.read(MAPS)), os.stat(path)
    # Other bytes under the same size and time: who opened the file again would see them.
    with open(path, "r+") as f:
        f.write("x" * stat.st_size)
    os.utime(path, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert landing.land(root, MAPS).count() == 0
    assert landing.commits.last()[0] == 1 and _rows(landing.read(MAPS)) == before and len(before) == 20
    assert landing.files().first().header == HEAD.strip()


def test_grown_files_rewrite_exactly_the_touched_partitions(spark, tmpdir_path):
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    path = _write(root, "xx", "a_per_county.csv", HEAD + _lines(1, 20) + _lines(2, 20))
    _write(root, "xx", "b_per_county.csv", HEAD + _lines(2, 5, emc="e2") + "not a time,e2,c1,7,100\n")
    landing = Landing(spark, store)
    first = {(r.state, r.day) for r in landing.land(root, MAPS).collect()}
    assert first == {("xx", "2024-01-01"), ("xx", "2024-01-02"), ("xx", "none")}
    before = _data_files(store)
    time.sleep(0.02)
    with open(path, "a") as f:
        f.write(_lines(2, 4, start=500) + _lines(3, 6))
    touched = {(r.state, r.day) for r in landing.land(root, MAPS).collect()}
    assert touched == {("xx", "2024-01-02"), ("xx", "2024-01-03")}
    after = _data_files(store)
    assert after["state=xx/day=2024-01-01"] == before["state=xx/day=2024-01-01"] and after["state=xx/day=none"] == before["state=xx/day=none"]
    assert after["state=xx/day=2024-01-02"] > before["state=xx/day=2024-01-02"] and "state=xx/day=2024-01-03" in after
    whole, _ = feeds.read_feeds(spark, root, MAPS)
    assert _rows(landing.read(MAPS)) == _rows(whole) and whole.count() == 56
    assert sorted(r.change for r in landing.files().collect()) == ["changed", "same"]
    assert landing.read(MAPS, days=["2024-01-03"]).count() == 6 and landing.read(MAPS, days=[None]).count() == 1
    assert landing.recent_days(2) == ["2024-01-03", "2024-01-02"]


def test_removed_and_rewritten_files(spark, tmpdir_path):
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    path = _write(root, "xx", "a_per_county.csv", HEAD + _lines(1, 10) + _lines(2, 10))
    gone = _write(root, "xx", "b_per_county.csv", HEAD + _lines(3, 5, emc="e2"))
    landing = Landing(spark, store)
    landing.land(root, MAPS)
    os.remove(gone)
    _write(root, "xx", "a_per_county.csv", HEAD + _lines(2, 10) + _lines(4, 1))
    os.utime(path, (time.time() + 5, time.time() + 5))
    touched = {r.day for r in landing.land(root, MAPS).collect()}
    assert touched == {"2024-01-01", "2024-01-03", "2024-01-04"}
    whole, _ = feeds.read_feeds(spark, root, MAPS)
    assert _rows(landing.read(MAPS)) == _rows(whole) and whole.count() == 11
    assert {r.day: r.n_rows for r in landing.days().collect()} == {"2024-01-02": 10, "2024-01-04": 1}


def test_a_run_that_dies_leaves_the_old_state(spark, tmpdir_path, monkeypatch):
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    path = _write(root, "xx", "a_per_county.csv", HEAD + _lines(1, 10))
    landing = Landing(spark, store)
    landing.land(root, MAPS)
    before = _rows(landing.read(MAPS))
    with open(path, "a") as f:
        f.write(_lines(1, 3, start=600))
    os.utime(path, (time.time() + 5, time.time() + 5))
    monkeypatch.setattr(Commits, "add", lambda self, run: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        landing.land(root, MAPS)
    assert _rows(landing.read(MAPS)) == before
    monkeypatch.undo()
    landing.land(root, MAPS)
    assert _rows(landing.read(MAPS)) == _rows(feeds.read_feeds(spark, root, MAPS)[0]) and len(before) + 3 == landing.read(MAPS).count()


def test_of_two_runs_one_commits(spark, tmpdir_path):
    commits = Commits(spark, tmpdir_path)
    assert commits.last() == (0, None)
    one, two = commits.new_run(), commits.new_run()
    commits.add(one)
    with pytest.raises(Exception):
        commits.add(two)
    assert commits.last() == (1, one) and commits.after(0) == [one] and commits.after(1) == []


def test_served_estimate_is_decided_when_rows_are_read(spark, tmpdir_path):
    """A later file with a served column ends the estimate for all rows of the state."""
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    _write(root, "yy", "a_per_county.csv", "timestamp,EMC,name,n_out,% out\n2024-01-01 00:00:00,e1,c,5,5%\n")
    landing = Landing(spark, store)
    landing.land(root, MAPS)
    assert [r._impute for r in landing.read(MAPS).collect()] == [True]
    _write(root, "yy", "b_per_county.csv", "timestamp,EMC,name,n_out,served\n2024-01-02 00:00:00,e1,c,5,100\n")
    maps = {"yy": MAPS["yy"] | {"served": "customers_served"}}
    landing.land(root, maps)
    assert [r._impute for r in landing.read(maps).collect()] == [False, False]


def test_rows_without_a_provider_and_files_without_rows(spark, tmpdir_path):
    root, store = f"{tmpdir_path}/feeds", f"{tmpdir_path}/store"
    _write(root, "xx", "a_per_county.csv", HEAD + "2024-01-01 00:00:00,,c,5,100\n2024-01-01 00:00:00,e,c,5,100\n")
    _write(root, "xx", "head_per_county.csv", HEAD)
    _write(root, "xx", "empty_per_county.csv", "")
    landing = Landing(spark, store)
    landing.land(root, MAPS)
    assert landing.read(MAPS).count() == 1 and landing.read(MAPS, drop_null_provider=False).count() == 2
    counted = {os.path.basename(r.source_file): (r.day, r.n_rows) for r in file_counters(landing).collect()}
    assert counted == {"a_per_county.csv": ("2024-01-01", 2), "head_per_county.csv": (None, None)}
    nothing = Landing(spark, f"{tmpdir_path}/none")
    os.makedirs(f"{tmpdir_path}/no feeds")
    with pytest.raises(ValueError):
        nothing.read(MAPS)


def test_stale_days_come_from_the_settings(spark, tmpdir_path):
    from gridpulse.sources import lookups

    root = f"{tmpdir_path}/feeds"
    for state in ("xx", "zz"):
        path = _write(root, state, "a_per_county.csv", HEAD + _lines(1, 3))
        os.utime(path, (time.time() - 3 * 86400, time.time() - 3 * 86400))
    manifest = feeds.file_manifest(spark, root)
    settings = lookups.settings_table(spark, manifest, overrides={"zz": {"stale_threshold_days": 5}})
    df, _ = feeds.read_feeds(spark, root, MAPS | {"zz": MAPS["xx"]}, as_of=F.current_timestamp(), settings=settings)
    assert {r.state for r in df.collect()} == {"zz"}

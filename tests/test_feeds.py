import os

import pytest
from pyspark.sql import functions as F

from gridpulse.sources import feeds, lookups

COL_MAP = {"ga": {"name": "county", "countyname": "county", "n_out": "per_outage_customers_affected",
                  "cust_s": "customers_served", "timestamp": "timestamp", "last updated": "timestamp"},
           "nc": {"county": "county", "# out": "per_outage_customers_affected", "timestamp": "timestamp"}}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def feed_root(tmpdir_path):
    root = os.path.join(tmpdir_path, "feeds")
    _write(f"{root}/ga/a_per_county.csv",
           "timestamp,EMC,name,n_out,cust_s\n"
           "2025-05-01 10:00:00,e1,Fulton,\"1,200\",\"10,000\"\n"
           "2025-05-01 10:15:00,e1,NA,5,100\n"
           "2025-05-01 10:30:00,,Fulton,5,100\n")
    _write(f"{root}/ga/b_PerCounties.CSV",
           "timestamp,EMC,countyname,n_out\n"       # no served column in this layout
           "2025-05-01 11:00:00,e2,Cobb,7\n")
    _write(f"{root}/ga/c_per_county.csv", "last updated,EMC,name,n_out\n2025-05-01 10:00:00,e3,Fulton,9\n")
    _write(f"{root}/ga/summary.csv", "timestamp,EMC\n2025-05-01 10:00:00,e9\n")
    _write(f"{root}/nc/x_percounty.csv",
           "timestamp,EMC,county,# out,% out\n"
           "2025-05-01 10:00:00,p1,Wake,10,<5%\n"
           "2025-05-01 10:15:00,p1,Wake,4,0%\n")
    return root


def test_manifest_filters_names(spark, feed_root):
    m = feeds.file_manifest(spark, feed_root).collect()
    by_name = {os.path.basename(r.path): r.is_feed for r in m}
    assert by_name["a_per_county.csv"] and by_name["b_PerCounties.CSV"] and by_name["x_percounty.csv"]
    assert not by_name["summary.csv"]
    assert {r.state for r in m} == {"ga", "nc"}


def test_headers_and_groups(spark, feed_root):
    man = feeds.file_manifest(spark, feed_root).where("is_feed")
    groups = feeds.header_groups(feeds.file_headers(spark, feed_root), man, COL_MAP)
    reasons = {(g.state, g.header[0]): g.skipped_reason for g in groups}
    assert reasons[("ga", "last updated")] == "no timestamp column"   # alias never rescues a file
    assert reasons[("ga", "timestamp")] is None
    assert len(groups) == 4


def test_read_feeds_union_and_semantics(spark, feed_root):
    df, groups = feeds.read_feeds(spark, feed_root, COL_MAP)
    rows = df.orderBy("state", "timestamp").collect()
    ga = [r for r in rows if r.state == "ga"]
    # NA county -> NULL; empty EMC row dropped; quoted "1,200" read as text 1,200
    assert [r.county for r in ga] == ["Fulton", None, "Cobb"]
    assert ga[0].per_outage_customers_affected == "1,200"
    # ga has a served column in some file: no estimate for the file without one
    assert ga[2].customers_served is None
    nc = [r for r in rows if r.state == "nc"]
    assert [r["% out"] for r in nc] == ["<5%", "0%"]
    assert all(r.source_file.endswith("x_percounty.csv") for r in nc)
    assert df.select("row_id").distinct().count() == df.count()


def test_state_without_served_is_estimated(spark, feed_root):
    from gridpulse.operators.standardize import standardize

    df, _ = feeds.read_feeds(spark, feed_root, COL_MAP)
    cm = spark.createDataFrame([("nc", "wake", "wake"), ("ga", "fulton", "fulton"), ("ga", "cobb", "cobb")],
                               "state string, raw string, standard string")
    out = standardize(df, cm).orderBy("state", "ts").collect()
    nc = [r for r in out if r.state == "nc"]
    assert [r.customers_served for r in nc] == [200.0]      # 10 / 0.05; 0% -> no estimate -> dropped
    ga = [r for r in out if r.state == "ga"]
    assert [r.customers_served for r in ga] == [10000.0]    # Cobb row has no served -> 0 -> dropped


def test_missing_provider_column_is_an_error(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "feeds2")
    _write(f"{root}/ga/a_per_county.csv", "timestamp,name,n_out,cust_s\n2025-05-01 10:00:00,Fulton,1,10\n")
    with pytest.raises(ValueError):
        feeds.read_feeds(spark, root, COL_MAP)


def test_stale_filter_and_bytes_summary(spark, feed_root):
    old = os.path.join(feed_root, "ga", "a_per_county.csv")
    os.utime(old, (1_000_000_000, 1_000_000_000))
    man = feeds.file_manifest(spark, feed_root)
    fresh = feeds.stale_filter(man.where("is_feed"), F.current_timestamp(), 2).collect()
    assert not any(r.path.endswith("a_per_county.csv") for r in fresh)
    s = {r.state: r for r in feeds.bytes_summary(man, F.current_timestamp(), 2).collect()}
    assert s["ga"].bytes_available > s["ga"].bytes_read > 0      # stale bytes still available
    assert s["nc"].reduction_pct == 0.0


def test_lookups(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "maps")
    _write(f"{root}/GA/col_map.csv", "raw,standard\n Name ,County\nn_out,per_outage_customers_affected\nname,county\nbad\n")
    _write(f"{root}/GA/county_map.csv", "raw,standard,score\nfulton,fulton,100\nga - cobb,cobb,90\n")
    _write(f"{root}/GA/master_county_list.txt", "Fulton County\nCobb County\n\nDeKalb\n")
    _write(f"{root}/GA/raw_county_list.txt", " fulton \nFULTON\n\ncobb\n")
    _write(f"{root}/GA/raw_col_lists.csv", "county,timestamp\nname,timestamp\ncountyname,\n")
    cm = lookups.col_map_dict(lookups.read_col_map(spark, root))
    assert cm == {"ga": {"name": "county", "n_out": "per_outage_customers_affected"}}
    assert sorted(r.county for r in lookups.read_master_counties(spark, root).collect()) == ["cobb", "dekalb", "fulton"]
    assert sorted(r.raw for r in lookups.read_raw_counties(spark, root).collect()) == ["cobb", "fulton"]
    lists = {(r.canonical, r.raw) for r in lookups.read_col_lists(spark, root).collect()}
    assert lists == {("county", "name"), ("county", "countyname"), ("timestamp", "timestamp")}
    st = lookups.settings_table(spark, ["GA", "zz"]).orderBy("state").collect()
    assert st[0].tail_bytes == 200000 and st[1].tail_bytes == 524288 and st[1].utilization_log_low == 0.3


def _state_file(root, name, text, state="xx"):
    folder = os.path.join(root, state)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


PLAIN_MAP = {"xx": {"name": "county", "n_out": "per_outage_customers_affected", "cust_s": "customers_served", "timestamp": "timestamp"}}


def test_quotes_line_breaks_and_blanks(spark, tmpdir_path):
    _state_file(tmpdir_path, "b per_county.csv", (
        "timestamp,EMC,name,n_out,cust_s\n"
        '2024-01-01 00:00:00,e1,"Fulton ""North"", GA",5,100\n'
        '2024-01-01 00:00:00,e1,"two\nlines",6,100\n'
        "2024-01-01 00:00:00, NA ,padded,7,100\n"
        "2024-01-01 00:00:00,NA,dropped,8,100\n"
        "2024-01-01 00:00:00,e1,short\n"))
    df, groups = feeds.read_feeds(spark, tmpdir_path, PLAIN_MAP)
    rows = sorted((r.county, r.emc, r.per_outage_customers_affected, r.customers_served) for r in df.collect())
    assert rows == [('Fulton "North", GA', "e1", "5", "100"), ("padded", " NA ", "7", "100"), ("short", "e1", None, None), ("two\nlines", "e1", "6", "100")]
    # the lineage name is the manifest's, for a name with a blank too
    manifest = feeds.file_manifest(spark, tmpdir_path)
    assert df.select("source_file").distinct().join(manifest, F.col("source_file") == F.col("uri")).count() == 1


def test_long_header_is_read_whole(spark, tmpdir_path):
    names = [f"column_number_{i:05d}_with_a_long_name" for i in range(2600)]
    header = ",".join([*names, "timestamp", "EMC", "name", "n_out", "cust_s"])
    assert len(header) > 64 * 1024
    _state_file(tmpdir_path, "per_county.csv", header + "\n" + "," * 2600 + "2024-01-01 00:00:00,e1,c,5,100\n")
    df, groups = feeds.read_feeds(spark, tmpdir_path, PLAIN_MAP)
    assert [g.skipped_reason for g in groups] == [None] and [r.county for r in df.collect()] == ["c"]


def test_unreadable_and_malformed_files_fail_the_job(spark, tmpdir_path):
    path = _state_file(tmpdir_path, "per_county.csv", "timestamp,EMC,name,n_out,cust_s\n2024-01-01 00:00:00,e1,c,5,100,7\n")
    df, _ = feeds.read_feeds(spark, tmpdir_path, PLAIN_MAP)
    with pytest.raises(Exception, match="more fields than the header"):
        df.collect()
    headers = feeds.file_headers(spark, tmpdir_path)
    os.remove(path)
    with pytest.raises(Exception):
        headers.collect()


def test_mapping_files_are_read_by_their_own_headers(spark, tmpdir_path):
    from gridpulse.sources import lookups

    _state_file(tmpdir_path, "raw_col_lists.csv", "county,customers_served,per_outage_customers_affected\nname,cust_s,cust_a\n", "AL")
    _state_file(tmpdir_path, "raw_col_lists.csv", "county,per_outage_customers_affected,customers_served\nlocation,n_out,\n", "AR")
    got = {(r.state, r.canonical, r.raw) for r in lookups.read_col_lists(spark, tmpdir_path).collect()}
    assert got == {("al", "county", "name"), ("al", "customers_served", "cust_s"), ("al", "per_outage_customers_affected", "cust_a"),
                   ("ar", "county", "location"), ("ar", "per_outage_customers_affected", "n_out")}
    _state_file(tmpdir_path, "col_map.csv", "raw,standard\nName , county\nname,COUNTY2\nblank,\n", "AL")
    _state_file(tmpdir_path, "col_map.csv", "standard,raw\ncounty,location\n", "AR")
    assert lookups.col_map_dict(lookups.read_col_map(spark, tmpdir_path)) == {"al": {"name": "county2"}, "ar": {"location": "county"}}
    _state_file(tmpdir_path, "county_map.csv", "raw,standard,score\n\"du, page\",dupage,92.3\n", "AL")
    _state_file(tmpdir_path, "county_map.csv", "score,raw,standard\n100,x,y\n", "AR")
    assert {(r.state, r.raw, r.standard, r.score) for r in lookups.read_county_map(spark, tmpdir_path).collect()} == {("al", "du, page", "dupage", 92.3), ("ar", "x", "y", 100.0)}


def test_header_names_by_csv_rules(spark):
    from gridpulse.operators.mapping import header_names

    lines = ['a,"b, c","d ""q""",,e', "x", ""]
    got = [r.n for r in spark.createDataFrame([(t,) for t in lines], "h string").select(header_names("h").alias("n")).collect()]
    assert got == [["a", "b, c", 'd "q"', "", "e"], ["x"], [""]]


def test_timestamp_shapes(spark):
    from gridpulse.functions.time import parse_timestamp

    shapes = {
        "1/5/2024 3:15 PM": "2024-01-05 15:15:00", "Jan 5, 2024 3:15": "2024-01-05 03:15:00", "1/5/24 3:15": "2024-01-05 03:15:00",
        "2024/01/15 10:00:00": "2024-01-15 10:00:00", "20240115 10:00:00": "2024-01-15 10:00:00",
        "2024-01-15T10:00:00.123456": "2024-01-15 10:00:00.123456", "2024-01-15": "2024-01-15 00:00:00",
        "01-15-2024 00:54:37": "2024-01-15 00:54:37", "5 January 2024": "2024-01-05 00:00:00", "12/31/99 12:00 AM": "1999-12-31 00:00:00",
        "May 3 2024 11:59:59 p.m.": "2024-05-03 23:59:59", "not a time": None, "": None, "2024-13-01 00:00:00": None,
        "1/5/2024 13:15 PM": None, "2024-02-30": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in shapes], "t string")
    got = {r.t: None if r.p is None else str(r.p) for r in df.select("t", parse_timestamp("t").alias("p")).collect()}
    assert got == shapes


def test_monthly_history_import(spark, tmpdir_path):
    import datetime as dt

    from gridpulse.sinks import tables
    from gridpulse.sources import lookups

    _state_file(tmpdir_path, "2024_01.csv", "State,County,FIPS,SAIDI,SAIFI,Date\nGeorgia,Fulton,13121,0.1,0.2,2024-01-05\nGeorgia,Cobb,13067,0.3,,not a day\n", "GA")
    _state_file(tmpdir_path, "2024_02.csv", "Date,County,State,FIPS,SAIFI,SAIDI\n2/1/2024,Autauga,Alabama,01001,0.5,0.4\n", "AL")
    rows = lookups.read_monthly_history(spark, tmpdir_path)
    got = sorted((r.state_code, r.County, r.FIPS, r.SAIDI, r.SAIFI, r.Date) for r in rows.collect())
    assert got == [("al", "Autauga", "01001", 0.4, 0.5, dt.date(2024, 2, 1)), ("ga", "Cobb", "13067", 0.3, None, None),
                   ("ga", "Fulton", "13121", 0.1, 0.2, dt.date(2024, 1, 5))]
    out = os.path.join(tmpdir_path, "out")
    tables.upsert_history(rows, out)
    assert spark.read.parquet(out).count() == 3  # the row without a day included


def test_settings_from_a_file(spark, tmpdir_path):
    from gridpulse.sources import lookups

    path = os.path.join(tmpdir_path, "settings.csv")
    with open(path, "w") as f:
        f.write("state,setting,value\nGA,tail_bytes,1000\nga,use_optimization,false\nAL,stale_threshold_days,5\n")
    table = lookups.settings_table(spark, ["ga", "al", "tx"], overrides=lookups.read_settings(spark, path))
    rows = {r.state: r for r in table.collect()}
    assert (rows["ga"].tail_bytes, rows["ga"].use_optimization, rows["al"].stale_threshold_days) == (1000, False, 5)
    assert rows["tx"].tail_bytes == 524288


def test_rows_of_several_states_are_never_broadcast(spark, tmpdir_path):
    """Files of two states read alike get their states by a join, whose small side is the list of files."""
    root = os.path.join(tmpdir_path, "feeds")
    for state in ("ga", "nc"):
        _write(f"{root}/{state}/a_per_county.csv", f"timestamp,EMC,name,n_out,cust_s\n2025-05-01 10:00:00,{state},Fulton,1,2\n")
    maps = {s: COL_MAP["ga"] for s in ("ga", "nc")}
    df, _ = feeds.read_feeds(spark, root, maps)
    counted = df.groupBy("state", "emc").count()  # few columns, so the rows look small
    assert sorted(map(tuple, counted.collect())) == [("ga", "ga", 1), ("nc", "nc", 1)]
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan


def test_many_file_names_are_shuffled_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(feeds, "BROADCAST_LIMIT_BYTES", 4)
    rows = spark.createDataFrame([("u1", 1), ("u2", 2)], "source_file string, x int")
    states = feeds.state_table(spark, [("u1", "ga"), ("u2", "nc")])
    met = rows.join(states, rows["source_file"] == states["uri"])
    assert sorted((r.state, r.x) for r in met.collect()) == [("ga", 1), ("nc", 2)]
    assert "SortMergeJoin" in met._jdf.queryExecution().executedPlan().toString()

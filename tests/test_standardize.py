import datetime as dt

from pyspark.sql import functions as F

from gridpulse.functions.text import clean_numeric, fn_title, normalize_county, null_if_literal, strip_county_word
from gridpulse.functions.time import parse_timestamp
from gridpulse.operators import standardize as std

COL_MAP = {"name": "county", "countyname": "county", "n_out": "per_outage_customers_affected",
           "cust_s": "customers_served", "timestamp": "timestamp"}


def test_plan_header_rename_prune_duplicates():
    plan = std.plan_header([" Timestamp", "EMC", "Name", "CountyName", "n_out", "junk", "% Out", "cust_s"], COL_MAP)
    assert plan.normalized[0] == "timestamp"
    assert plan.sources["county"] == [2, 3]          # duplicates in column order
    assert "junk" not in plan.sources
    assert "% out" not in plan.sources                # served present -> % out dropped
    assert plan.missing == []


def test_plan_header_missing_and_pct_only():
    plan = std.plan_header(["timestamp", "EMC", "name", "n_out", "% out"], COL_MAP)
    assert "% out" in plan.sources and plan.missing == []   # served can be estimated
    plan = std.plan_header(["timestamp", "EMC", "name"], COL_MAP)
    assert plan.missing == ["per_outage_customers_affected", "customers_served"]


def test_coalesce_first_non_blank_untrimmed(spark):
    df = spark.createDataFrame([(None, "b"), ("  ", "b"), (" a ", "b"), ("", None)], "_c0 string, _c1 string")
    out = df.select(std.first_non_blank([F.col("_c0"), F.col("_c1")]).alias("v")).collect()
    assert [r.v for r in out] == ["b", "b", " a ", None]


def test_drop_bad_county_exact_values(spark):
    vals = ["unknown", "Unknown", "UNKNOWN", "", None, "UnKnown", " unknown", "fulton"]
    df = spark.createDataFrame([(v,) for v in vals], "county string")
    kept = sorted(r.county for r in std.drop_bad_county(df).collect())
    assert kept == [" unknown", "UnKnown", "fulton"]


def test_impute_served(spark):
    rows = [("10", "<5%"), ("1,200", "10%"), ("5", "0%"), ("5", None), ("25", "50%"), ("7", "abc")]
    df = spark.createDataFrame(rows, "per_outage_customers_affected string, `% out` string")
    out = [r.customers_served for r in std.impute_served(df).collect()]
    # 10/0.05=200; 1200/0.1=12000; 0% and NULL -> NULL; 25/0.5=50; bad pct -> NULL
    assert out == ["200", "12000", None, None, "50", None]
    # half-even: 5 / 0.4 = 12.5 -> 12, 7 / 0.4 = 17.5 -> 18
    df2 = spark.createDataFrame([("5", "40%"), ("7", "40%")], "per_outage_customers_affected string, `% out` string")
    assert [r.customers_served for r in std.impute_served(df2).collect()] == ["12", "18"]


def test_clean_numeric_and_null_literals(spark):
    vals = ['"1,234"', "1,234", "abc", None, "", " 12 ", "NaN", "-3.5"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r.x for r in df.select(clean_numeric(null_if_literal("v")).alias("x")).collect()]
    assert out == [1234.0, 1234.0, 0.0, 0.0, 0.0, 12.0, 0.0, -3.5]


def test_parse_timestamp_formats(spark):
    vals = ["2025-05-01 10:00:00", "2025-05-01T10:00:00.250", "05-01-2025 10:00:00", "garbage", None,
            "2025-05-01 10:00"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    out = [r.t for r in df.select(parse_timestamp("v").alias("t")).collect()]
    assert out[0] == dt.datetime(2025, 5, 1, 10, 0)
    assert out[1] == dt.datetime(2025, 5, 1, 10, 0, 0, 250000)
    assert out[2] == dt.datetime(2025, 5, 1, 10, 0)
    assert out[3] is None and out[4] is None
    assert out[5] == dt.datetime(2025, 5, 1, 10, 0)


def test_county_text_functions(spark):
    df = spark.createDataFrame([("  GA-Fulton ",), ("nc - warren",), ("De Kalb County",)], "v string")
    out = df.select(normalize_county("v").alias("n"), strip_county_word("v").alias("s"), fn_title("v").alias("t")).collect()
    assert [r.n for r in out] == ["ga - fulton", "nc - warren", "de kalb county"]
    assert out[2].s == "de kalb"
    t = spark.createDataFrame([("miami-dade",), ("o'brien",), ("st. johns",)], "v string").select(fn_title("v").alias("t"))
    assert [r.t for r in t.collect()] == ["Miami-Dade", "O'Brien", "St. Johns"]


def test_map_county_drops_unmapped_and_suffix_option(spark):
    cm = spark.createDataFrame([("ga", "fulton", "fulton"), ("ga", "ga - cobb", "cobb")], "state string, raw string, standard string")
    df = spark.createDataFrame([("ga", "Fulton"), ("ga", "ga-cobb"), ("ga", "fulton county"), ("ga", "nowhere")],
                               "state string, county string")
    assert sorted(r.county for r in std.map_county(df, cm).collect()) == ["cobb", "fulton"]
    assert sorted(r.county for r in std.map_county(df, cm, strip_county_suffix=True).collect()) == ["cobb", "fulton", "fulton"]


def test_standardize_end_to_end(spark):
    canon = spark.createDataFrame(
        [("ga", "f", 1, "e1", "Fulton", "10", "100", "2025-05-01 10:00:00"),
         ("ga", "f", 2, "e1", "Fulton", "5", "0", "2025-05-01 10:15:00"),        # zero served
         ("ga", "f", 3, None, "Fulton", "5", "100", "2025-05-01 10:30:00"),      # no provider
         ("ga", "f", 4, "e1", "unknown", "5", "100", "2025-05-01 10:30:00"),     # bad county
         ("ga", "f", 5, "e1", "Fulton", "5", "100", "bad"),                      # bad time
         ("ga", "f", 6, "e1", "Fulton", '"1,000"', "100", "2025-05-02 10:30:00")],
        "state string, source_file string, row_id long, emc string, county string, "
        "per_outage_customers_affected string, customers_served string, timestamp string")
    cm = spark.createDataFrame([("ga", "fulton", "fulton")], "state string, raw string, standard string")
    out = std.standardize(canon, cm).orderBy("row_id").collect()
    assert [r.row_id for r in out] == [1, 6]
    assert out[1].affected == 1000.0 and out[1].report_date == dt.date(2025, 5, 2)
    day = std.standardize(canon, cm, date_range=("2025-05-01", "2025-05-01")).collect()
    assert [r.row_id for r in day] == [1]


def test_pick_larger_column(spark):
    df = spark.createDataFrame([("1", "10"), ("2", "20")], "a string, b string")
    out = std.pick_larger_column(df, ["a", "b"]).collect()
    assert [r.a for r in out] == ["10", "20"] and "b" not in out[0].asDict()

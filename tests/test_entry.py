import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["state", "report_date", "county", "saidi", "lower_saifi", "middle_saifi", "upper_saifi"]
    assert df.count() > 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert "metric_daily" in o


def test_survey_inventory_registered():
    ids = """scan_file_manifest scan_stale_filter scan_csv_dynamic scan_recent_slice scan_require_timestamp
    scan_null_literals scan_source_lineage scan_union_by_name scan_provider_key scan_full_history lookup_col_map
    lookup_col_lists lookup_county_map lookup_raw_counties lookup_master_counties lookup_fips lookup_settings
    std_normalize_names std_rename_columns std_prune_columns std_coalesce_duplicates std_pick_larger_column
    std_drop_bad_county std_impute_served std_required_columns std_parse_timestamp std_filter_date
    std_filter_date_range std_clean_numeric std_drop_zero_served std_normalize_county std_map_county
    std_standardize join_county_map join_county_restrict join_missing_counties join_served_history
    join_county_spine join_fips join_compare join_fuzzy_top1 agg_outage_events agg_event_middle
    agg_customers_served agg_served_history agg_saidi agg_saifi agg_file_utilization agg_bytes_summary
    agg_null_profile agg_distinct_columns agg_distinct_counties agg_write_summary win_time_gap win_session_flag
    win_session_id win_prev_in_session win_positive_delta win_best_match sort_history sort_counties
    set_union_providers set_union_counties set_replace_date set_missing_columns fill_counties metric_round
    metric_format_small metric_add_date metric_daily final_projection history_projection sink_dashboard_csv
    sink_history_upsert sink_history_backfill fn_title qa_compare_tolerance qa_mapping_coverage job_daily
    job_backfill job_mapping_build""".split()
    missing = [i for i in ids if i not in E.queries()]
    assert missing == []

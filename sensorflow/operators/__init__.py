"""DataFrame -> DataFrame operators.

reshape      coalesce_value, terms_to_columns (long -> wide), to_long, union_all,
             keep_existing, drop_matching, empty_frame
quality      qf_mask, any_flag_passes, qf_or_after_date, gross_range, mask_rules,
             qc_series, qc_by_source, qc_incremental, rate_of_change
depth        correct_depth (interval join), validate_corrections, lookup_depth,
             surface_only, in_depth_window
rollup       hourly_mean, daily_mean (skip or strict), merge_sources (mean or union)
seriesscan   lag_columns, known_neighbours, row_index, linear_fill (bucketed scans)
series       date_range, series_spine, densify, series_with_data, interpolate, diff_sd,
             obs_error_fill
climatology  doy_stats, climatology_window, forecast_grid, densify_forecast,
             climatology_forecast, forecast_band
randomwalk   rw_analytic, ensemble_summary
provisional  provisional_wq_daily, provisional_tsd_surface_daily,
             provisional_tsd_profile_hourly, provisional_point_daily, read_product,
             drop_variable_for_class
coverage     check_columns, temporal_coverage, flatten_geo, geo_coverage
"""

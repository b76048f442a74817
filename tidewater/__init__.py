"""tidewater: environmental time-series organiser on Apache Spark.

Every operator is a ``DataFrame -> DataFrame`` function keyed by a list of
series-key columns; see README.md for the design and the operator map.
"""

from .operators.clean import drop_any_null, trim_ts, value_present
from .operators.daily import hourly_2_daily
from .operators.gate import wide_eligibility
from .operators.info import ts_info
from .operators.joins import enrich, keep_all_sites, select_listed
from .operators.pad import na_ts_insert
from .operators.reshape import daily_normalise, to_wide, ts_2_list, ts_melt, unpivot_long
from .operators.resample import apply_process_chain, apply_specs, raw_series, resample
from .operators.step import is_ts_daily, step_table, ts_step
from .operators.summary import data_range_summary, distinct_count
from .operators.validate import ts_validate
from .plans.extract import extract_job, long_record_filter
from .plans.organise import long_table, organise_folder
from .session import get_session
from .sources.dims import dim_from_catalog, dim_from_csv, dim_from_json_map
from .sources.report_csv import long_table_scan, report_csv_scan, report_files
from .sources.spec import report_spec_scan

__all__ = [
    "apply_process_chain", "apply_specs", "daily_normalise", "data_range_summary",
    "dim_from_catalog", "dim_from_csv", "dim_from_json_map", "distinct_count", "drop_any_null",
    "enrich", "extract_job", "get_session", "hourly_2_daily", "is_ts_daily", "keep_all_sites",
    "long_record_filter", "long_table", "long_table_scan", "na_ts_insert",
    "organise_folder", "raw_series", "report_csv_scan", "report_files", "report_spec_scan",
    "resample", "select_listed", "step_table", "to_wide", "trim_ts", "ts_2_list", "ts_info",
    "ts_melt", "ts_step", "ts_validate", "unpivot_long", "value_present", "wide_eligibility",
]

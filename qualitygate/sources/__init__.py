"""Tables, logs and files."""

from qualitygate.sources.check_ledger import CheckLedger
from qualitygate.sources.exports import (
    evaluations_to_json,
    export_all,
    export_dataset,
    export_drift,
    read_csv,
    read_json,
    rows_from_json,
    write_csv,
    write_json,
    write_json_array,
)
from qualitygate.sources.history import DailyHistory
from qualitygate.sources.metrics_log import MetricsLog, as_evaluations, as_metrics, latest_per_key
from qualitygate.sources.tables import conform, read_table, replace_version, write_table

__all__ = [
    "CheckLedger",
    "DailyHistory",
    "MetricsLog",
    "as_evaluations",
    "as_metrics",
    "conform",
    "evaluations_to_json",
    "export_all",
    "export_dataset",
    "export_drift",
    "latest_per_key",
    "read_csv",
    "read_json",
    "read_table",
    "replace_version",
    "rows_from_json",
    "write_csv",
    "write_json",
    "write_json_array",
    "write_table",
]

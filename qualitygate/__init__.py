"""Did a new version of the data keep its meaning? Checks, scoring, gate and metrics on Spark."""

from qualitygate.operators.checks import (
    check_counts,
    check_report,
    check_statuses,
    duplicated_ids,
    failing_versions,
    passing_rows,
)
from qualitygate.operators.evaluators import (
    BatchEvaluator,
    Evaluator,
    ExpressionEvaluator,
    ResponseEvaluator,
    get_evaluator,
    register_evaluator,
)
from qualitygate.operators.gate import decide, release, review_queue, scoring_outcome, worst_rows
from qualitygate.operators.metrics import (
    answers_wide,
    confusion_counts,
    disagreement_rate,
    distinct_keys,
    drift_by_version,
    drift_report,
    drift_trend,
    labels_from_keys,
    latency_percentiles,
    loop_metrics,
    mean_quality_by_version,
    semantic_drift,
)
from qualitygate.operators.routing import in_order, route_hash_sample, route_passing, route_prefix
from qualitygate.operators.scoring import (
    accepted,
    first_per_key,
    per_input_row,
    quarantined,
    score,
    score_and_split,
    score_queued,
    score_with_errors,
    unscored,
)
from qualitygate.operators.versions import drift_manifest, fork_version, manifest_in_order, stack_versions
from qualitygate.plans.loop import LoopResult, run_loop, score_into
from qualitygate.sources import (
    CheckLedger,
    DailyHistory,
    MetricsLog,
    evaluations_to_json,
    export_all,
    export_dataset,
    export_drift,
    latest_per_key,
    read_table,
    replace_version,
    rows_from_json,
    write_table,
)
from qualitygate.spec import GOODS, TICKETS, DatasetSpec, Options, Question, get_dataset, register_dataset
from qualitygate.streaming import drop_repeats, score_stream

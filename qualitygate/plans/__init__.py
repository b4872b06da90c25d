"""Plan building blocks shared by the operators."""

from qualitygate.plans.ranking import first_by, first_rows, value_at_rank
from qualitygate.plans.scratch import empty_table, exists, names_table, new_folder, pin, shared_folder, spool
from qualitygate.plans.broadcasting import fits, small_side
from qualitygate.plans.work_queue import WorkQueue

__all__ = [
    "WorkQueue",
    "empty_table",
    "exists",
    "first_by",
    "first_rows",
    "fits",
    "names_table",
    "new_folder",
    "pin",
    "shared_folder",
    "small_side",
    "spool",
    "value_at_rank",
]

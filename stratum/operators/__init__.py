from stratum.operators.checks import (
    ChecksFailed,
    accepted_values,
    check_counts,
    expression_is_true,
    failing_rows,
    not_null,
    relationships,
    run_checks,
    unique,
)
from stratum.operators.clean import clean, spec, valid_rows
from stratum.operators.dedupe import dedupe_latest
from stratum.operators.dimension import calendar, date_spine, distinct_dimension
from stratum.operators.rollup import Measure, bounded_broadcast, rollup_through_dimension

__all__ = [
    "ChecksFailed", "accepted_values", "check_counts", "expression_is_true", "failing_rows",
    "not_null", "relationships", "run_checks", "unique", "clean", "spec", "valid_rows",
    "dedupe_latest", "calendar", "date_spine", "distinct_dimension", "Measure",
    "bounded_broadcast", "rollup_through_dimension",
]

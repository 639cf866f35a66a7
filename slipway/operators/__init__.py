from slipway.operators import checks, gates, versions  # noqa: F401
from slipway.operators.checks import (  # noqa: F401
    Check,
    native_suite,
    not_null,
    positive,
    row_count_positive,
    run_checks,
    unique,
)

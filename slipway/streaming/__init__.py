from slipway.streaming.revert import (  # noqa: F401
    failed_evaluations,
    revert_batch,
    revert_on_failure,
)

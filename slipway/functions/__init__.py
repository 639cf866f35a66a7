from slipway.functions.scalar import (  # noqa: F401
    OK_STATUSES,
    TRUE_FLAGS,
    all_not_null,
    any_null,
    cursor_value,
    in_folder,
    is_truthy,
    joined_sorted,
    layer_of,
    node_label,
    run_key,
    schema_name,
    status_ok,
    strategy_of,
    to_ntz,
    trunc_ntz,
)

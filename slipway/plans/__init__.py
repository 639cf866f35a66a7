from slipway.plans.models import (  # noqa: F401
    build_marts,
    customer_totals,
    mart_customers,
    mart_orders,
    model_layers,
    stg_customers,
    stg_orders,
)

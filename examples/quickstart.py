"""Walk through the two safety patterns on the seed CSVs.

    python examples/quickstart.py [STORE_ROOT]

1. Publish twice: the first run creates green, the second clones green into
   blue, rebuilds, checks and promotes both marts in one commit.
2. A build with a duplicate order is checked and blocked; green is unchanged.
3. Live green is corrupted (one row appended to itself); the live check
   fails and the streaming revert restores the state before the last publish.

Without STORE_ROOT the store goes under the session's spark.checkpoint.dir.
"""

from __future__ import annotations

import json
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from slipway import schemas  # noqa: E402
from slipway.operators import checks as C  # noqa: E402
from slipway.plans import flow, models  # noqa: E402
from slipway.session import get_session  # noqa: E402
from slipway.sources import read_seed  # noqa: E402
from slipway.store import Store  # noqa: E402
from slipway.streaming import revert_on_failure  # noqa: E402

CHECKS = {
    "mart_orders": [C.not_null("order_id"), C.unique("order_id", ignore_nulls=True)],
    "mart_customers": [C.not_null("customer_id"), C.unique("customer_id", ignore_nulls=True)],
}


def show(store, label):
    state = {t: v.row_count for t, v in store.versions("green").items()}
    print(json.dumps({"step": label, "green_rows": state}))


def main():
    spark = get_session("local[*]")
    fixtures = os.path.join(ROOT, "tests", "fixtures")
    orders = read_seed(spark, os.path.join(fixtures, "raw_orders.csv"), schemas.RAW_ORDERS)
    customers = read_seed(spark, os.path.join(fixtures, "raw_customers.csv"), schemas.RAW_CUSTOMERS)
    store = Store(spark, sys.argv[1]) if len(sys.argv) > 1 else Store.scratch(spark)
    print(json.dumps({"store": store.root}))

    for i in (1, 2):
        report = flow.publish_run(store, models.build_marts(orders, customers), CHECKS)
        show(store, f"publish {i}: promoted {report.promoted}")

    bad = models.build_marts(orders, customers)
    bad["mart_orders"] = bad["mart_orders"].unionByName(bad["mart_orders"].where("order_id = 505"))
    report = flow.publish_run(store, bad, CHECKS)
    show(store, f"bad build: clean={report.clean}, failures={report.failures}")

    live = store.read("green", "mart_orders")
    store.append("green", "mart_orders", live.orderBy("order_id").limit(1))
    show(store, "live green corrupted")
    check = flow.check_live(store, "mart_orders", key="order_id").first()
    print(json.dumps({"live check": check["check_name"], "passed": check["passed"],
                      "duplicates": check["value"]}))
    revert_on_failure(store, tables=["mart_orders"]).awaitTermination(300)
    show(store, "after streaming revert")
    spark.stop()


if __name__ == "__main__":
    main()

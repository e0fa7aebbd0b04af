"""The whole way of one load: read, reject, rename, check, dedup, save, report."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sluice.functions.errors import errors_text
from sluice.operators.clean import drop_duplicates, rename_columns, split_blank
from sluice.operators.sql import run_sql
from sluice.operators.validate import lookup, require
from sluice.plans.registry import Tables, plan
from sluice.session import staged
from sluice.sinks.tables import quarantine, save_table
from sluice.sources.files import require_rows

SQL = """
SELECT n.n_name AS nation, c.c_mktsegment AS segment, count(*) AS orders, round(sum(o.o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2"""


@plan("q01_load_and_report", SQL)
def load_and_report(t: Tables) -> DataFrame:
    orders = split_blank(require_rows(t.orders), ["o_custkey", "o_orderstatus"]).good
    orders = rename_columns(orders, {"o_totalprice": "total_price"})
    checked = lookup(require(orders, ["o_orderpriority"]), "o_custkey", t.customer, "c_custkey")
    checked = errors_text(drop_duplicates(checked, ["o_orderkey"], "o_orderdate"), name="system_error_message")
    # The gate and the save both read the checked rows: compute them once.
    passed = quarantine(staged(checked, "checked"), "system_error_message", "o_orderstatus", t.scratch("rejected"))
    save_table(passed, "sluice_checked_orders", t.scratch("checked-orders"))
    return run_sql(
        t.spark,
        """SELECT n.n_name AS nation, c.c_mktsegment AS segment, count(*) AS orders,
                  round(sum(o.total_price), 2) AS total
           FROM sluice_checked_orders o JOIN {customer} c ON o.o_custkey = c.c_custkey
           JOIN {nation} n ON c.c_nationkey = n.n_nationkey GROUP BY 1, 2""",
        customer=t.customer, nation=t.nation,
    )

"""Wide tables and KPIs for SQL: ``SELECT * FROM kpi_express_bill('20240131')``.

Every wide table and KPI table is a table function with an optional day, over a view of the same plan that the API makes. The
planner sees through both: a day becomes a filter on the fact, ahead of its joins. Lookups of columns that a statement doesn't
ask for are joined all the same, but without their columns; the API's ``columns`` leaves them out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayline.operators.joins import Tables
from quayline.plans import summary, wide

#: Function name to job.
WIDE = {"wide_express_bill": wide.EXPRESS_BILL, "wide_waybill": wide.WAYBILL,
        "wide_transport_record": wide.TRANSPORT_RECORD, "wide_branch_vehicle": wide.BRANCH_VEHICLE}
KPIS = {"kpi_express_bill": summary.EXPRESS_BILL, "kpi_waybill": summary.WAYBILL,
        "kpi_transport_record": summary.TRANSPORT_RECORD, "kpi_branch_vehicle": summary.BRANCH_VEHICLE}


def _register(spark: SparkSession, function: str, view: str, rows: DataFrame, day: str) -> None:
    rows.createOrReplaceTempView(view)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {function}(wanted_day STRING DEFAULT NULL) RETURNS TABLE ({columns}) "
              f"RETURN SELECT * FROM {view} WHERE wanted_day IS NULL OR `{day}` = wanted_day")


def register(spark: SparkSession, tables: Tables) -> list[str]:
    """Make the views and table functions of all jobs over some source tables; returns the functions' names.

    They belong to the session. The customer table has no day, so ``tbl_customer_detail`` is a view alone.
    """
    for function, job in WIDE.items():
        _register(spark, function, job.name, wide.wide_table(job, tables), "day")
    for function, job in KPIS.items():
        _register(spark, function, job.name, summary.summarise_source(job, tables), "id")
    wide.customer_wide(tables).createOrReplaceTempView(wide.CUSTOMER_NAME)
    return [*WIDE, *KPIS]

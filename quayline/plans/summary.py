"""The daily KPI jobs: each reads one wide table and gives one row per day."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quayline.operators.joins import Tables, WideJob, widen
from quayline.operators.kpi import customer_snapshot, stats_of_group_counts
from quayline.plans import wide


@dataclass(frozen=True)
class SummaryJob:
    """Which keys of which wide table are counted, and under which labels."""

    name: str
    source: WideJob
    keys: dict[str, str]
    total: str | None = None
    sums: bool = False

    @property
    def columns(self) -> list[str]:
        extra = [self.total] if self.total not in (None, "*") else []
        return list(dict.fromkeys([*self.keys.values(), *extra, "day"]))


# Labels, counted columns and result names of the KPI tables.
EXPRESS_BILL = SummaryJob(
    "tbl_express_bill_summary", wide.EXPRESS_BILL,
    {"Type": "type", "Dot": "dot_id", "Channel": "order_channel_id", "Terminal": "order_terminal_type"},
    total="id")
WAYBILL = SummaryJob(
    "tbl_waybill_summary", wide.WAYBILL,
    {"Area": "area_id", "Company": "sw_company_name", "Dot": "dot_id", "Route": "route_id", "Tool": "tt_id",
     "Ctype": "ctype"},
    total="*")
TRANSPORT_RECORD = SummaryJob(
    "tbl_warehouse_summary", wide.TRANSPORT_RECORD,
    {"Sw": "sw_id", "Dot": "dot_id", "Route": "route_id", "Ctype": "ctype", "Package": "package_id",
     "Area": "area_id", "Company": "company_id"})
BRANCH_VEHICLE = SummaryJob(
    "tbl_dot_transport_tool_summary", wide.BRANCH_VEHICLE,
    {"Dot": "dot_id", "City": "city_id", "Company": "company_id"},
    sums=True)
CUSTOMER_NAME = "tbl_customer_summary"

JOBS = {job.name: job for job in (EXPRESS_BILL, WAYBILL, TRANSPORT_RECORD, BRANCH_VEHICLE)}


def summarise(job: SummaryJob, wide_table: DataFrame) -> DataFrame:
    """The KPI rows of a wide table, one per day."""
    return stats_of_group_counts(wide_table, job.keys, total=job.total, sums=job.sums)


def summarise_source(job: SummaryJob, tables: Tables) -> DataFrame:
    """The KPI rows straight from the source tables; lookups that no key needs are not joined."""
    return summarise(job, widen(job.source, tables, columns=job.columns))


def customer_summary(tables: Tables, as_of: dt.date | str) -> DataFrame:
    """The customer figures of one date straight from the source tables."""
    return customer_snapshot(wide.customer_wide(tables), as_of)

"""The wide-table jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quayline.functions.columns import day_of_text, day_of_time, money
from quayline.operators.joins import Lookup, Tables, WideJob, constant_key, spread_key, widen
from quayline.schemas import CODE_TYPES

# The joins and the output columns below are fixed values: they define the tables other jobs read.

EXPRESS_BILL = WideJob(
    name="tbl_express_bill_detail",
    role="bill",
    table="tbl_express_bill",
    lookups=(
        Lookup("courier", "tbl_courier", "id", "bill.eid"),
        Lookup("customer", "tbl_customer", "id", "bill.cid"),
        Lookup("channel", "tbl_codes", "code", "bill.orderChannelId", CODE_TYPES["order_channel_type"]),
        Lookup("terminal", "tbl_codes", "code", "bill.orderTerminalType", CODE_TYPES["order_terminal_type"]),
        Lookup("address_map", "tbl_consumer_address_map", "consumerId", "customer.id"),
        Lookup("address", "tbl_address", "id", "address_map.addressId"),
        Lookup("pkg", "tbl_pkg", "pwBill", "bill.expressNumber"),
        Lookup("dot", "tbl_dot", "id", "pkg.pwDotId"),
        Lookup("company_dot", "tbl_company_dot_map", "dotId", "dot.id"),
        Lookup("company", "tbl_company", "id", "company_dot.companyId"),
    ),
    columns=(
        "bill.id",
        "bill.expressNumber AS express_number",
        "bill.cid",
        "customer.name AS cname",
        "address.detailAddr AS caddress",
        "bill.eid",
        "courier.name AS ename",
        "dot.id AS dot_id",
        "dot.dotName AS dot_name",
        "company.companyName AS company_name",
        "bill.orderChannelId AS order_channel_id",
        "channel.codeDesc AS order_channel_name",
        "bill.orderDt AS order_dt",
        "terminal.code AS order_terminal_type",
        "terminal.codeDesc AS order_terminal_type_name",
        "bill.orderTerminalOsType AS order_terminal_os_type",
        "bill.reserveDt AS reserve_dt",
        "bill.isCollectPackageTimeout AS is_collect_package_timeout",
        "bill.timeoutDt AS timeout_dt",
        "customer.type",
        "bill.cdt",
        "bill.udt",
        "bill.remark",
    ),
    day=day_of_text,
    day_column="bill.cdt",
)

WAYBILL = WideJob(
    name="tbl_waybill_detail",
    role="waybill",
    table="tbl_waybill",
    lookups=(
        Lookup("courier", "tbl_courier", "id", "waybill.eid"),
        Lookup("dot", "tbl_dot", "id", "courier.dotId"),
        Lookup("area", "tbl_areas", "id", "dot.manageAreaId"),
        Lookup("record", "tbl_transport_record", "pwWaybillNumber", "waybill.waybillNumber"),
        Lookup("start_warehouse", "tbl_warehouse", "id", "record.swId"),
        Lookup("end_warehouse", "tbl_warehouse", "id", "record.ewId"),
        Lookup("tool", "tbl_transport_tool", "id", "record.transportToolId"),
        Lookup("route", "tbl_route", "id", "record.routeId"),
        Lookup("start_map", "tbl_company_warehouse_map", "warehouseId", "start_warehouse.id"),
        Lookup("start_company", "tbl_company", "id", "start_map.companyId"),
        Lookup("end_map", "tbl_company_warehouse_map", "warehouseId", "end_warehouse.id"),
        Lookup("end_company", "tbl_company", "id", "end_map.companyId"),
        Lookup("customer", "tbl_customer", "id", "waybill.cid"),
        Lookup("channel", "tbl_codes", "code", "waybill.orderChannelId", CODE_TYPES["order_channel_type"]),
        Lookup("customer_type", "tbl_codes", "code", "customer.type", CODE_TYPES["custom_type"]),
    ),
    columns=(
        "waybill.id",
        "waybill.expressBillNumber AS express_bill_number",
        "waybill.waybillNumber AS waybill_number",
        "waybill.cid",
        "customer.name AS cname",
        "customer.type AS ctype",
        "customer_type.codeDesc AS ctype_name",
        "waybill.eid",
        "courier.name AS ename",
        "dot.id AS dot_id",
        "dot.dotName AS dot_name",
        "area.id AS area_id",
        "area.name AS area_name",
        "waybill.orderChannelId AS order_channel_id",
        "channel.codeDesc AS order_chanel_name",
        "waybill.orderDt AS order_dt",
        "waybill.orderTerminalType AS order_terminal_type",
        "waybill.orderTerminalOsType AS order_terminal_os_type",
        "waybill.reserveDt AS reserve_dt",
        "waybill.isCollectPackageTimeout AS is_collect_package_timeout",
        "waybill.pkgId AS pkg_id",
        "waybill.pkgNumber AS pkg_number",
        "waybill.timeoutDt AS timeout_dt",
        "waybill.transformType AS transform_type",
        "waybill.deliveryAddr AS delivery_addr",
        "waybill.deliveryCustomerName AS delivery_customer_name",
        "waybill.deliveryMobile AS delivery_mobile",
        "waybill.deliveryTel AS delivery_tel",
        "waybill.receiveAddr AS receive_addr",
        "waybill.receiveCustomerName AS receive_customer_name",
        "waybill.receiveMobile AS receive_mobile",
        "waybill.receiveTel AS receive_tel",
        "waybill.cdt",
        "waybill.udt",
        "waybill.remark",
        "record.swId AS sw_id",
        "start_warehouse.name AS sw_name",
        "start_company.id AS sw_company_id",
        "start_company.companyName AS sw_company_name",
        "record.ewId AS ew_id",
        "end_warehouse.name AS ew_name",
        "end_company.id AS ew_company_id",
        "end_company.companyName AS ew_company_name",
        "tool.id AS tt_id",
        "tool.licensePlate AS tt_name",
        "record.routeId AS route_id",
        "concat(route.startStation, route.endStation) AS route_name",
    ),
    day=day_of_time,
    day_column="waybill.cdt",
)

TRANSPORT_RECORD = WideJob(
    name="tbl_warehouse_detail",
    role="record",
    table="tbl_transport_record",
    lookups=(
        Lookup("company_map", "tbl_company_warehouse_map", "warehouseId", "record.swId"),
        Lookup("company", "tbl_company", "id", "company_map.companyId"),
        Lookup("area", "tbl_areas", "id", "company.cityId"),
        Lookup("waybill", "tbl_waybill", "waybillNumber", "record.pwWaybillNumber"),
        Lookup("bill", "tbl_express_bill", "expressNumber", "waybill.expressBillNumber"),
        Lookup("sender", "tbl_consumer_sender_info", "ciid", "bill.cid"),
        Lookup("package", "tbl_express_package", "id", "sender.pkgId"),
        Lookup("customer", "tbl_customer", "id", "sender.ciid"),
        Lookup("customer_type", "tbl_codes", "code", "customer.type", CODE_TYPES["custom_type"]),
        Lookup("warehouse", "tbl_warehouse", "id", "record.swId"),
        Lookup("inbound", "tbl_push_warehouse", "warehouseId", "warehouse.id"),
        Lookup("dot", "tbl_dot", "id", "inbound.pwDotId"),
    ),
    columns=(
        "record.id",
        "record.pwId AS pw_id",
        "record.pwWaybillId AS pw_waybill_id",
        "record.pwWaybillNumber AS pw_waybill_number",
        "record.owId AS ow_id",
        "record.owWaybillId AS ow_waybill_id",
        "record.owWaybillNumber AS ow_waybill_number",
        "record.swId AS sw_id",
        "warehouse.name AS sw_name",
        "record.ewId AS ew_id",
        "record.transportToolId AS transport_tool_id",
        "record.pwDriver1Id AS pw_driver1_id",
        "record.pwDriver2Id AS pw_driver2_id",
        "record.pwDriver3Id AS pw_driver3_id",
        "record.owDriver1Id AS ow_driver1_id",
        "record.owDriver2Id AS ow_driver2_id",
        "record.owDriver3Id AS ow_driver3_id",
        "record.routeId AS route_id",
        "TRY_CAST(record.distance AS INT) AS distance",
        "TRY_CAST(record.duration AS INT) AS duration",
        "TRY_CAST(record.state AS INT) AS state",
        "record.startVehicleDt AS start_vehicle_dt",
        "record.predictArrivalsDt AS predict_arrivals_dt",
        "record.actualArrivalsDt AS actual_arrivals_dt",
        "record.cdt",
        "record.udt",
        "record.remark",
        "company.id AS company_id",
        "company.companyName AS company_name",
        "area.id AS area_id",
        "area.name AS area_name",
        "package.id AS package_id",
        "package.name AS package_name",
        "customer.id AS cid",
        "customer.name AS cname",
        "customer_type.code AS ctype",
        "customer_type.codeDesc AS ctype_name",
        "dot.id AS dot_id",
        "dot.dotName AS dot_name",
    ),
    day=day_of_time,
    day_column="record.cdt",
)


BRANCH_VEHICLE = WideJob(
    name="tbl_dot_transport_tool_detail",
    role="site",
    table="tbl_dot_transport_tool",
    lookups=(
        Lookup("tool", "tbl_transport_tool", "id", "site.transportToolId"),
        Lookup("tool_type", "tbl_codes", "code", "tool.type", CODE_TYPES["transport_type"]),
        Lookup("tool_state", "tbl_codes", "code", "tool.state", CODE_TYPES["transport_status"]),
        Lookup("dot", "tbl_dot", "id", "site.dotId"),
        Lookup("company_dot", "tbl_company_dot_map", "dotId", "site.dotId"),
        Lookup("company", "tbl_company", "id", "company_dot.companyId"),
    ),
    columns=(
        "tool.id",
        "tool.brand",
        "tool.model",
        "TRY_CAST(tool.type AS INT) AS type",
        "tool_type.codeDesc AS type_name",
        "TRY_CAST(tool.givenLoad AS INT) AS given_load",
        "tool.loadCnUnit AS load_cn_unit",
        "tool.loadEnUnit AS load_en_unit",
        "tool.buyDt AS buy_dt",
        "tool.licensePlate AS license_plate",
        "TRY_CAST(tool.state AS INT) AS state",
        "tool_state.codeDesc AS state_name",
        "tool.cdt",
        "tool.udt",
        "tool.remark",
        "dot.id AS dot_id",
        "dot.dotNumber AS dot_number",
        "dot.dotName AS dot_name",
        "dot.dotAddr AS dot_addr",
        "dot.dotGisAddr AS dot_gis_addr",
        "dot.dotTel AS dot_tel",
        "dot.manageAreaId AS manage_area_id",
        "dot.manageAreaGis AS manage_area_gis",
        "company.id AS company_id",
        "company.companyName AS company_name",
        "company.cityId AS city_id",
        "company.companyNumber AS company_number",
        "company.companyAddr AS company_addr",
        "company.companyAddrGis AS company_addr_gis",
        "company.companyTel AS company_tel",
        "company.isSubCompany AS is_sub_company",
    ),
    day=day_of_time,
    day_column="site.cdt",
    key="transportToolId",  # the table is stored per vehicle, not per assignment
    id_role="tool",
)

CUSTOMER_NAME = "tbl_customer_detail"

JOBS = {job.name: job for job in (EXPRESS_BILL, WAYBILL, TRANSPORT_RECORD, BRANCH_VEHICLE)}


def wide_table(job: WideJob, tables: Tables, fact: DataFrame | None = None, ordered: bool = False,
               **options) -> DataFrame:
    """A wide table; ``ordered=True`` sorts it by creation time, which a keyed table would forget again."""
    wide = widen(job, tables, fact, **options)
    return wide.orderBy("cdt") if ordered else wide


def sender_totals(senders: DataFrame, packages: DataFrame, exact: bool = True) -> DataFrame:
    """First and last shipment, number of shipments and total amount of each customer, over all time."""
    packages = packages.select(F.col("id").alias("package_id"), F.col("cdt").alias("package_cdt"), "actualAmount")
    return (senders.select("id", "ciid", "pkgId")
            .join(packages, (F.col("pkgId") == F.col("package_id"))
                  & (spread_key("pkgId", "id") == constant_key("package_id")), "left")  # NULL keys on all partitions
            .groupBy("ciid")
            .agg(F.min("id").alias("first_sender_id"),
                 F.max("id").alias("last_sender_id"),
                 F.min("package_cdt").alias("first_sender_cdt"),
                 F.max("package_cdt").alias("last_sender_cdt"),
                 F.count("id").alias("totalCount"),
                 F.sum(money("actualAmount", exact)).alias("totalAmount")))


def customer_wide(tables: Tables, customers: DataFrame | None = None, exact: bool = True,
                  ordered: bool = False) -> DataFrame:
    """The customer table with each customer's shipment totals. Only the customers may be an increment."""
    customers = tables("tbl_customer") if customers is None else customers
    totals = sender_totals(tables("tbl_consumer_sender_info"), tables("tbl_express_package"), exact)
    types = (tables("tbl_codes").where(F.col("type") == CODE_TYPES["custom_type"])
             .groupBy(F.col("code").try_cast("int").alias("type_code"))
             .agg(F.min_by("codeDesc", "id").alias("type_name")))
    wide = (customers
            .join(totals, customers["id"] == totals["ciid"], "left")
            .join(types, customers["type"] == types["type_code"], "left")
            .select("id", "name", "tel", "mobile", F.col("type").try_cast("int").alias("type"), "type_name",
                    F.col("isOwnReg").alias("is_own_reg"), F.col("regDt").alias("regdt"),
                    F.col("regChannelId").alias("reg_channel_id"), "state", "cdt", "udt",
                    F.col("lastLoginDt").alias("last_login_dt"), "remark",
                    "first_sender_id", "last_sender_id", "first_sender_cdt", "last_sender_cdt",
                    "totalCount", F.col("totalAmount").cast("double").alias("totalAmount")))
    return wide.orderBy("cdt") if ordered else wide

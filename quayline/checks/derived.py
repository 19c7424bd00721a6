"""The source tables of the warehouse, derived from the generic order tables.

The jobs read 51 source tables that a change feed fills. Where only the generic tables (orders, lineitem, customer ...)
are at hand, these views give the 21 tables that the wide-table jobs read, at the size of the generic tables: bills and
waybills are orders, transport records and parcels are order lines, warehouses and branches are suppliers, vehicles are
parts. Foreign keys that are NULL or lead nowhere, codes that cannot be decoded and one-to-many maps are part of them.
The texts are plain SQL that Spark and other engines read alike; ``{name}`` stands for a generic table.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

from quayline.session import fresh_path

# An order line is known by order and number. Lines that share both are one line: the smallest values stand for it.
_LINES = """(
    SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, min(l_suppkey) AS l_suppkey,
           min(l_quantity) AS l_quantity, min(l_shipdate) AS l_shipdate
    FROM {lineitem} GROUP BY l_orderkey, l_linenumber)"""

VIEWS = {
    "tbl_express_bill": """
        SELECT o_orderkey AS id, 'EB' || CAST(o_orderkey AS STRING) AS expressNumber, o_custkey AS cid,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 113 END AS eid,
               CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS orderChannelId,
               CAST(o_orderdate AS STRING) AS orderDt,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS orderTerminalType,
               CAST(o_orderkey % 3 AS INT) AS orderTerminalOsType, CAST(o_orderdate AS STRING) AS reserveDt,
               CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS isCollectPackageTimeout,
               CAST(NULL AS STRING) AS timeoutDt, CAST(o_orderdate AS STRING) AS cdt,
               CAST(o_orderdate AS STRING) AS udt, o_orderpriority AS remark
        FROM {orders}""",
    "tbl_waybill": """
        SELECT o_orderkey AS id, 'EB' || CAST(o_orderkey AS STRING) AS expressBillNumber,
               'WB' || CAST(o_orderkey AS STRING) AS waybillNumber, o_custkey AS cid,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey % 113 END AS eid,
               CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS orderChannelId,
               CAST(o_orderdate AS STRING) AS orderDt,
               CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 9 END AS orderTerminalType,
               CAST(o_orderkey % 3 AS INT) AS orderTerminalOsType, CAST(o_orderdate AS STRING) AS reserveDt,
               CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS isCollectPackageTimeout,
               o_orderkey AS pkgId, 'PK' || CAST(o_orderkey AS STRING) AS pkgNumber,
               CAST(NULL AS STRING) AS timeoutDt, CAST(o_custkey % 4 AS INT) AS transformType,
               'sender ' || CAST(o_custkey AS STRING) AS deliveryCustomerName,
               'street ' || CAST(o_custkey AS STRING) AS deliveryAddr, CAST(NULL AS STRING) AS deliveryMobile,
               CAST(NULL AS STRING) AS deliveryTel, 'receiver ' || o_orderstatus AS receiveCustomerName,
               'road ' || CAST(o_orderkey AS STRING) AS receiveAddr, CAST(NULL AS STRING) AS receiveMobile,
               CAST(NULL AS STRING) AS receiveTel, CAST(o_orderdate AS STRING) AS cdt,
               CAST(o_orderdate AS STRING) AS udt, o_orderpriority AS remark
        FROM {orders}""",
    "tbl_transport_record": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS pwId, l_orderkey AS pwWaybillId,
               'WB' || CAST(l_orderkey AS STRING) AS pwWaybillNumber, l_partkey AS owId, l_orderkey AS owWaybillId,
               'WB' || CAST(l_orderkey AS STRING) AS owWaybillNumber, l_suppkey AS swId,
               l_suppkey + l_linenumber AS ewId, l_partkey AS transportToolId, l_suppkey AS pwDriver1Id,
               l_suppkey + 1 AS pwDriver2Id, CAST(NULL AS BIGINT) AS pwDriver3Id, l_suppkey AS owDriver1Id,
               l_suppkey + 2 AS owDriver2Id, CAST(NULL AS BIGINT) AS owDriver3Id, l_suppkey % 30 AS routeId,
               CAST(l_quantity AS BIGINT) AS distance, CAST(l_quantity * 2 AS BIGINT) AS duration,
               CAST(l_linenumber % 4 AS INT) AS state, CAST(l_shipdate AS STRING) AS startVehicleDt,
               CAST(l_shipdate AS STRING) AS predictArrivalsDt, CAST(NULL AS STRING) AS actualArrivalsDt,
               CAST(l_shipdate AS STRING) AS cdt, CAST(l_shipdate AS STRING) AS udt, CAST(NULL AS STRING) AS remark
        FROM {_LINES} AS line""",
    "tbl_pkg": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, 'EB' || CAST(l_orderkey AS STRING) AS pwBill,
               l_suppkey AS pwDotId, l_suppkey AS warehouseId
        FROM {_LINES} AS line""",
    "tbl_push_warehouse": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS warehouseId, l_partkey % 120 AS pwDotId
        FROM {_LINES} AS line""",
    "tbl_dot_transport_tool": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_suppkey AS dotId, l_partkey AS transportToolId,
               CAST(l_shipdate AS STRING) AS cdt
        FROM {_LINES} AS line""",
    "tbl_consumer_sender_info": """
        SELECT o_orderkey AS id, o_custkey AS ciid,
               CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS pkgId, o_orderkey AS expressBillId,
               CAST(o_orderdate AS STRING) AS cdt
        FROM {orders}""",
    "tbl_express_package": """
        SELECT o_orderkey AS id, 'PK' || CAST(o_orderkey AS STRING) AS name, o_totalprice AS actualAmount,
               CAST(o_orderdate AS STRING) AS cdt
        FROM {orders}""",
    "tbl_customer": """
        SELECT c_custkey AS id, c_name AS name, CAST(NULL AS STRING) AS tel, c_name || '-m' AS mobile,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
                    WHEN 'HOUSEHOLD' THEN 4 END AS type,
               CASE WHEN c_acctbal < 0 THEN 0 ELSE 1 END AS isOwnReg,
               CAST(DATE '1995-01-01' + CAST((c_custkey * 7) % 2405 AS INT) AS STRING) || ' 09:30:00' AS regDt,
               CAST(c_nationkey % 4 AS STRING) AS regChannelId, 1 AS state,
               CAST(DATE '1995-01-01' + CAST((c_custkey * 7) % 2405 AS INT) AS STRING) || ' 09:30:00' AS cdt,
               CAST(DATE '1995-01-01' + CAST((c_custkey * 7) % 2405 AS INT) AS STRING) || ' 09:31:00' AS udt,
               CAST(NULL AS STRING) AS lastLoginDt, c_mktsegment AS remark
        FROM {customer}""",
    "tbl_consumer_address_map": """
        SELECT c_custkey * 10 AS id, c_custkey AS consumerId, c_custkey AS addressId FROM {customer}
        UNION ALL
        SELECT c_custkey * 10 - 5 AS id, c_custkey AS consumerId, c_custkey + 1 AS addressId FROM {customer}
        WHERE c_acctbal < 3000""",
    "tbl_address": """
        SELECT c_custkey AS id, c_name || ' street' AS detailAddr, CAST(c_nationkey AS BIGINT) AS areaId
        FROM {customer}""",
    "tbl_courier": """
        SELECT s_suppkey AS id, 'Courier ' || s_name AS name, s_suppkey + 1 AS dotId FROM {supplier}""",
    "tbl_dot": """
        SELECT s_suppkey AS id, 'D' || CAST(s_suppkey AS STRING) AS dotNumber, 'Dot ' || s_name AS dotName,
               'lane ' || CAST(s_suppkey AS STRING) AS dotAddr, CAST(NULL AS STRING) AS dotGisAddr,
               CAST(NULL AS STRING) AS dotTel, CAST(s_nationkey AS BIGINT) AS manageAreaId,
               CAST(NULL AS STRING) AS manageAreaGis
        FROM {supplier}""",
    "tbl_warehouse": """
        SELECT s_suppkey AS id, 'Warehouse ' || s_name AS name FROM {supplier}""",
    "tbl_company_dot_map": """
        SELECT s_suppkey * 2 AS id, CAST(s_nationkey + 100 AS BIGINT) AS companyId, s_suppkey AS dotId FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 2 - 3 AS id, 100 + s_suppkey % 25 AS companyId, s_suppkey AS dotId FROM {supplier}
        WHERE s_acctbal < 3000""",
    "tbl_company_warehouse_map": """
        SELECT s_suppkey * 2 AS id, CAST(s_nationkey + 100 AS BIGINT) AS companyId, s_suppkey AS warehouseId
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey * 2 + 1 AS id, 100 + s_suppkey % 25 AS companyId, s_suppkey AS warehouseId FROM {supplier}
        WHERE s_acctbal > 7000""",
    "tbl_company": """
        SELECT CAST(n_nationkey + 100 AS BIGINT) AS id, 'Company ' || n_name AS companyName,
               CAST(n_nationkey AS BIGINT) AS cityId, 'C' || CAST(n_nationkey AS STRING) AS companyNumber,
               'plaza ' || n_name AS companyAddr, CAST(NULL AS STRING) AS companyAddrGis,
               CAST(NULL AS STRING) AS companyTel, CAST(n_regionkey AS BIGINT) AS isSubCompany
        FROM {nation}""",
    "tbl_areas": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM {nation}""",
    "tbl_route": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS startStation,
               CASE WHEN n_regionkey = 0 THEN NULL ELSE 'to region ' || CAST(n_regionkey AS STRING) END AS endStation
        FROM {nation}""",
    "tbl_transport_tool": """
        SELECT p_partkey AS id, p_brand AS brand, p_name AS model, CAST(substring(p_brand, 7, 3) AS INT) AS type,
               CAST(p_size AS STRING) AS givenLoad, 'dun' AS loadCnUnit, 'ton' AS loadEnUnit,
               CAST(DATE '1994-01-01' + p_size AS STRING) AS buyDt, 'P' || CAST(p_partkey AS STRING) AS licensePlate,
               CASE p_type WHEN 'ECONOMY' THEN '1' WHEN 'SMALL' THEN '2' WHEN 'MEDIUM' THEN '3'
                    WHEN 'LARGE' THEN '4' ELSE '5' END AS state,
               CAST(DATE '1994-01-01' + p_size AS STRING) || ' 07:00:00' AS cdt,
               CAST(DATE '1994-01-01' + p_size AS STRING) || ' 07:00:00' AS udt, CAST(NULL AS STRING) AS remark
        FROM {part}""",
    "tbl_codes": """
        SELECT 1600 + number AS id, 16 AS type, CAST(number AS STRING) AS code, c_mktsegment AS codeDesc
        FROM (SELECT DISTINCT c_mktsegment,
                     CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 END
                         AS number
              FROM {customer}) AS segment
        WHERE number IS NOT NULL
        UNION ALL
        SELECT 1700 + length(code) AS id, 17 AS type, code, 'terminal ' || o_orderstatus AS codeDesc
        FROM (SELECT DISTINCT o_orderstatus,
                     CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '02' ELSE 'unknown' END AS code
              FROM {orders}) AS status
        UNION ALL
        SELECT 1800 + CAST(code AS INT) AS id, 18 AS type, code, o_orderpriority AS codeDesc
        FROM (SELECT DISTINCT o_orderpriority, substring(o_orderpriority, 1, 1) AS code FROM {orders}) AS channel
        WHERE code <> '5'
        UNION ALL
        SELECT 900 + CAST(code AS INT) AS id, 9 AS type, code, p_brand AS codeDesc
        FROM (SELECT DISTINCT p_brand, substring(p_brand, 7, 3) AS code FROM {part}) AS brand
        UNION ALL
        SELECT 1000 + CAST(code AS INT) AS id, 10 AS type, code, p_type AS codeDesc
        FROM (SELECT DISTINCT p_type,
                     CASE p_type WHEN 'ECONOMY' THEN '1' WHEN 'SMALL' THEN '2' WHEN 'MEDIUM' THEN '3'
                          WHEN 'LARGE' THEN '4' END AS code
              FROM {part}) AS kind
        WHERE code IS NOT NULL""",
}


#: The code dictionary is a few rows made from large tables. It is stored before it is used, so that its size is known.
STORED = ("tbl_codes",)


def generic_names(text: str) -> list[str]:
    """The generic tables a view text reads."""
    return sorted({name for _, name, _, _ in string.Formatter().parse(text) if name})


class DerivedTables:
    """``tables(name)`` gives a source table as a DataFrame over the generic Parquet tables in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._made: dict[str, DataFrame] = {}

    def generic(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._made[name]

    def __call__(self, name: str) -> DataFrame:
        if name not in self._made:
            text = VIEWS[name]
            made = self.spark.sql(text, **{n: self.generic(n) for n in generic_names(text)})
            if name in STORED:
                path = fresh_path(self.spark, name)
                made.repartition(1).write.parquet(path)  # coalesce would run all partitions of all aggregates in one task
                made = self.spark.read.parquet(path)
            self._made[name] = made
        return self._made[name]

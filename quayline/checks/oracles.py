"""For every query, SQL for another engine (DuckDB) that must give the same rows."""

from __future__ import annotations

from quayline.plans import summary
from quayline.schemas import load_catalogue
from quayline.checks import change_queries, search_queries, store_queries
from quayline.checks.derived import VIEWS, generic_names


def _source(*names: str) -> str:
    """``WITH`` items for derived source tables."""
    items = []
    for name in names:
        text = VIEWS[name]
        items.append(f"{name} AS ({text.format(**{n: n for n in generic_names(text)})})")
    return ",\n".join(items)


# --- wide tables: all copies first, then the one with the smallest ids --------------------------------------------

_BILL = _source("tbl_express_bill", "tbl_courier", "tbl_customer", "tbl_codes", "tbl_consumer_address_map",
                       "tbl_address", "tbl_pkg", "tbl_dot", "tbl_company_dot_map", "tbl_company") + """,
wide AS (
    SELECT * EXCLUDE (copy) FROM (
    SELECT b.id, b.expressNumber AS express_number, b.cid, c.name AS cname, a.detailAddr AS caddress, b.eid,
           e.name AS ename, d.id AS dot_id, d.dotName AS dot_name, co.companyName AS company_name,
           b.orderChannelId AS order_channel_id, ch.codeDesc AS order_channel_name, b.orderDt AS order_dt,
           te.code AS order_terminal_type, te.codeDesc AS order_terminal_type_name,
           b.orderTerminalOsType AS order_terminal_os_type, b.reserveDt AS reserve_dt,
           b.isCollectPackageTimeout AS is_collect_package_timeout, b.timeoutDt AS timeout_dt, c.type,
           b.cdt, b.udt, b.remark, replace(substring(b.cdt, 1, 10), '-', '') AS day,
           row_number() OVER (PARTITION BY b.id ORDER BY m.id, p.id, cd.id) AS copy
    FROM tbl_express_bill b
    LEFT JOIN tbl_courier e ON b.eid = e.id
    LEFT JOIN tbl_customer c ON b.cid = c.id
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 18) ch ON TRY_CAST(ch.code AS BIGINT) = b.orderChannelId
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 17) te ON TRY_CAST(te.code AS BIGINT) = b.orderTerminalType
    LEFT JOIN tbl_consumer_address_map m ON m.consumerId = c.id
    LEFT JOIN tbl_address a ON a.id = m.addressId
    LEFT JOIN tbl_pkg p ON p.pwBill = b.expressNumber
    LEFT JOIN tbl_dot d ON d.id = p.pwDotId
    LEFT JOIN tbl_company_dot_map cd ON cd.dotId = d.id
    LEFT JOIN tbl_company co ON co.id = cd.companyId) WHERE copy = 1)"""

_WAYBILL = _source("tbl_waybill", "tbl_courier", "tbl_dot", "tbl_areas", "tbl_transport_record", "tbl_warehouse",
                   "tbl_transport_tool", "tbl_route", "tbl_company_warehouse_map", "tbl_company", "tbl_customer",
                   "tbl_codes") + """,
wide AS (
    SELECT * EXCLUDE (copy) FROM (
    SELECT w.id, w.expressBillNumber AS express_bill_number, w.waybillNumber AS waybill_number, w.cid,
           c.name AS cname, c.type AS ctype, ct.codeDesc AS ctype_name, w.eid, e.name AS ename, d.id AS dot_id,
           d.dotName AS dot_name, ar.id AS area_id, ar.name AS area_name, w.orderChannelId AS order_channel_id,
           ch.codeDesc AS order_chanel_name, w.orderDt AS order_dt, w.orderTerminalType AS order_terminal_type,
           w.orderTerminalOsType AS order_terminal_os_type, w.reserveDt AS reserve_dt,
           w.isCollectPackageTimeout AS is_collect_package_timeout, w.pkgId AS pkg_id, w.pkgNumber AS pkg_number,
           w.timeoutDt AS timeout_dt, w.transformType AS transform_type, w.deliveryAddr AS delivery_addr,
           w.deliveryCustomerName AS delivery_customer_name, w.deliveryMobile AS delivery_mobile,
           w.deliveryTel AS delivery_tel, w.receiveAddr AS receive_addr,
           w.receiveCustomerName AS receive_customer_name, w.receiveMobile AS receive_mobile,
           w.receiveTel AS receive_tel, w.cdt, w.udt, w.remark, r.swId AS sw_id, sw.name AS sw_name,
           sc.id AS sw_company_id, sc.companyName AS sw_company_name, r.ewId AS ew_id, ew.name AS ew_name,
           ec.id AS ew_company_id, ec.companyName AS ew_company_name, t.id AS tt_id, t.licensePlate AS tt_name,
           r.routeId AS route_id, ro.startStation || ro.endStation AS route_name,
           strftime(CAST(w.cdt AS TIMESTAMP), '%Y%m%d') AS day,
           row_number() OVER (PARTITION BY w.id ORDER BY r.id, sm.id, em.id) AS copy
    FROM tbl_waybill w
    LEFT JOIN tbl_courier e ON w.eid = e.id
    LEFT JOIN tbl_dot d ON e.dotId = d.id
    LEFT JOIN tbl_areas ar ON ar.id = d.manageAreaId
    LEFT JOIN tbl_transport_record r ON r.pwWaybillNumber = w.waybillNumber
    LEFT JOIN tbl_warehouse sw ON sw.id = r.swId
    LEFT JOIN tbl_warehouse ew ON ew.id = r.ewId
    LEFT JOIN tbl_transport_tool t ON t.id = r.transportToolId
    LEFT JOIN tbl_route ro ON ro.id = r.routeId
    LEFT JOIN tbl_company_warehouse_map sm ON sm.warehouseId = sw.id
    LEFT JOIN tbl_company sc ON sc.id = sm.companyId
    LEFT JOIN tbl_company_warehouse_map em ON em.warehouseId = ew.id
    LEFT JOIN tbl_company ec ON ec.id = em.companyId
    LEFT JOIN tbl_customer c ON c.id = w.cid
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 18) ch ON TRY_CAST(ch.code AS BIGINT) = w.orderChannelId
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 16) ct ON TRY_CAST(ct.code AS BIGINT) = c.type)
    WHERE copy = 1)"""

# Two of these lookups lead to thousands of rows per key, so they are reduced before the join here as well.
_RECORD = _source("tbl_transport_record", "tbl_company_warehouse_map", "tbl_company", "tbl_areas", "tbl_waybill",
                  "tbl_express_bill", "tbl_consumer_sender_info", "tbl_express_package", "tbl_customer", "tbl_codes",
                  "tbl_warehouse", "tbl_push_warehouse", "tbl_dot") + """,
sender AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ciid ORDER BY id) AS place FROM tbl_consumer_sender_info)
    WHERE place = 1),
inbound AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY warehouseId ORDER BY id) AS place FROM tbl_push_warehouse)
    WHERE place = 1),
wide AS (
    SELECT * EXCLUDE (copy) FROM (
    SELECT r.id, r.pwId AS pw_id, r.pwWaybillId AS pw_waybill_id, r.pwWaybillNumber AS pw_waybill_number,
           r.owId AS ow_id, r.owWaybillId AS ow_waybill_id, r.owWaybillNumber AS ow_waybill_number, r.swId AS sw_id,
           wh.name AS sw_name, r.ewId AS ew_id, r.transportToolId AS transport_tool_id,
           r.pwDriver1Id AS pw_driver1_id, r.pwDriver2Id AS pw_driver2_id, r.pwDriver3Id AS pw_driver3_id,
           r.owDriver1Id AS ow_driver1_id, r.owDriver2Id AS ow_driver2_id, r.owDriver3Id AS ow_driver3_id,
           r.routeId AS route_id, CAST(r.distance AS INT) AS distance, CAST(r.duration AS INT) AS duration, r.state,
           r.startVehicleDt AS start_vehicle_dt, r.predictArrivalsDt AS predict_arrivals_dt,
           r.actualArrivalsDt AS actual_arrivals_dt, r.cdt, r.udt, r.remark, co.id AS company_id,
           co.companyName AS company_name, ar.id AS area_id, ar.name AS area_name, pa.id AS package_id,
           pa.name AS package_name, c.id AS cid, c.name AS cname, ct.code AS ctype, ct.codeDesc AS ctype_name,
           d.id AS dot_id, d.dotName AS dot_name, strftime(CAST(r.cdt AS TIMESTAMP), '%Y%m%d') AS day,
           row_number() OVER (PARTITION BY r.id ORDER BY cm.id, w.id, b.id) AS copy
    FROM tbl_transport_record r
    LEFT JOIN tbl_company_warehouse_map cm ON r.swId = cm.warehouseId
    LEFT JOIN tbl_company co ON cm.companyId = co.id
    LEFT JOIN tbl_areas ar ON co.cityId = ar.id
    LEFT JOIN tbl_waybill w ON r.pwWaybillNumber = w.waybillNumber
    LEFT JOIN tbl_express_bill b ON w.expressBillNumber = b.expressNumber
    LEFT JOIN sender s ON b.cid = s.ciid
    LEFT JOIN tbl_express_package pa ON s.pkgId = pa.id
    LEFT JOIN tbl_customer c ON s.ciid = c.id
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 16) ct ON c.type = TRY_CAST(ct.code AS BIGINT)
    LEFT JOIN tbl_warehouse wh ON r.swId = wh.id
    LEFT JOIN inbound i ON i.warehouseId = wh.id
    LEFT JOIN tbl_dot d ON d.id = i.pwDotId) WHERE copy = 1)"""

_VEHICLE = _source("tbl_dot_transport_tool", "tbl_transport_tool", "tbl_codes", "tbl_dot", "tbl_company_dot_map",
                   "tbl_company") + """,
wide AS (
    SELECT * EXCLUDE (copy) FROM (
    SELECT t.id, t.brand, t.model, t.type, ty.codeDesc AS type_name, CAST(t.givenLoad AS INT) AS given_load,
           t.loadCnUnit AS load_cn_unit, t.loadEnUnit AS load_en_unit, t.buyDt AS buy_dt,
           t.licensePlate AS license_plate, CAST(t.state AS INT) AS state, st.codeDesc AS state_name, t.cdt, t.udt,
           t.remark, d.id AS dot_id, d.dotNumber AS dot_number, d.dotName AS dot_name, d.dotAddr AS dot_addr,
           d.dotGisAddr AS dot_gis_addr, d.dotTel AS dot_tel, d.manageAreaId AS manage_area_id,
           d.manageAreaGis AS manage_area_gis, co.id AS company_id, co.companyName AS company_name,
           co.cityId AS city_id, co.companyNumber AS company_number, co.companyAddr AS company_addr,
           co.companyAddrGis AS company_addr_gis, co.companyTel AS company_tel, co.isSubCompany AS is_sub_company,
           strftime(CAST(s.cdt AS TIMESTAMP), '%Y%m%d') AS day,
           row_number() OVER (PARTITION BY t.id ORDER BY s.id, cd.id) AS copy
    FROM tbl_dot_transport_tool s
    JOIN tbl_transport_tool t ON s.transportToolId = t.id
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 9) ty ON TRY_CAST(ty.code AS BIGINT) = t.type
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 10) st ON st.code = t.state
    LEFT JOIN tbl_dot d ON d.id = s.dotId
    LEFT JOIN tbl_company_dot_map cd ON s.dotId = cd.dotId
    LEFT JOIN tbl_company co ON cd.companyId = co.id) WHERE copy = 1)"""

_TOTALS = """
totals AS (
    SELECT s.ciid, min(s.id) AS first_sender_id, max(s.id) AS last_sender_id, min(p.cdt) AS first_sender_cdt,
           max(p.cdt) AS last_sender_cdt, count(s.id) AS totalCount,
           CAST(sum(CAST(p.actualAmount AS DECIMAL(18, 2))) AS DOUBLE) AS totalAmount
    FROM tbl_consumer_sender_info s LEFT JOIN tbl_express_package p ON p.id = s.pkgId GROUP BY s.ciid)"""
_CUSTOMER = _source("tbl_customer", "tbl_consumer_sender_info", "tbl_express_package", "tbl_codes") + f""",
{_TOTALS},
wide AS (
    SELECT c.id, c.name, c.tel, c.mobile, c.type, ct.codeDesc AS type_name, c.isOwnReg AS is_own_reg,
           c.regDt AS regdt, c.regChannelId AS reg_channel_id, c.state, c.cdt, c.udt, c.lastLoginDt AS last_login_dt,
           c.remark, t.first_sender_id, t.last_sender_id, t.first_sender_cdt, t.last_sender_cdt, t.totalCount,
           t.totalAmount
    FROM tbl_customer c
    LEFT JOIN totals t ON c.id = t.ciid
    LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 16) ct ON c.type = TRY_CAST(ct.code AS INT))"""


def _kpi(source: str, keys: dict[str, str], total: str | None, sums: bool, table: str = "wide") -> str:
    """The KPI figures one key at a time, put side by side by day."""
    parts, columns, joins = [], [], []
    for label, key in keys.items():
        stats = f"max(n) AS max{label}Total, min(n) AS min{label}Total, round(avg(n), 0) AS avg{label}Total"
        names = [f"max{label}Total", f"min{label}Total", f"avg{label}Total"]
        if sums:
            stats += f", CAST(sum(n) AS BIGINT) AS sum{label}Total"
            names.append(f"sum{label}Total")
        parts.append(f"by_{label} AS (SELECT day, {stats} FROM (SELECT day, {key}, count(*) AS n FROM {table} "
                     f"GROUP BY day, {key}) GROUP BY day)")
        columns += names
        joins.append(f"JOIN by_{label} USING (day)")
    if total:
        columns.insert(0, "total")
    count = f", count({total}) AS total" if total else ""
    return (f"WITH {source},\n" + ",\n".join(parts) + f"\nSELECT day AS id, {', '.join(columns)} "
            f"FROM (SELECT day{count} FROM {table} WHERE day IS NOT NULL GROUP BY day) {' '.join(joins)}")


def _kpi_of(source: str, job: summary.SummaryJob) -> str:
    return _kpi(source, job.keys, job.total, job.sums)


# --- change events ------------------------------------------------------------------------------------------------

_ORACLE_CHANGES = """
    SELECT user_id AS id, event_id, ts, event_type, value,
           CASE event_type WHEN 'view' THEN 'update' WHEN 'error' THEN 'delete' ELSE 'insert' END AS op,
           CASE WHEN event_type = 'signup' THEN 'tbl_nowhere'
                WHEN user_id % 2 = 0 THEN 'tbl_vehicle_monitor' ELSE 'tbl_waybill_line' END AS tbl
    FROM events WHERE value <= 150"""
_MYSQL_CHANGES = """
    SELECT o_custkey * 3 + i AS id, o_custkey AS consumerId, o_orderkey + i AS addressId, o_orderpriority AS remark,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'delete' WHEN '2-HIGH' THEN 'update' ELSE 'insert' END AS op,
           CASE o_orderpriority WHEN '5-LOW' THEN 'tbl_customer' ELSE 'tbl_consumer_address_map' END AS tbl,
           o_orderdate AS moment, o_orderkey AS seq, i
    FROM orders, (VALUES (0), (1), (2)) AS rows(i) WHERE o_orderstatus <> 'P'"""


def _last(changes: str, key: str, order: str, where: str = "TRUE") -> str:
    return (f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS back "
            f"FROM ({changes}) WHERE {where}) WHERE back = 1")


def _rows(name: str, source: str, **given: str) -> str:
    """Rows of a source table with all its columns, NULL where nothing is given."""
    kinds = {"bigint": "BIGINT", "int": "INT", "double": "DOUBLE", "string": "VARCHAR"}
    columns = ", ".join(f"{given.get(c.name, 'CAST(NULL AS ' + kinds[c.type.simpleString()] + ')')} AS {c.name}"
                        for c in load_catalogue()[name].columns)
    return f"SELECT '{name}' AS \"table\", {columns} FROM ({source})"


def _oracle_rows(where: str) -> str:
    """The two tables that the Oracle messages are of."""
    last = {n: _last(_ORACLE_CHANGES, "id", "ts DESC, event_id DESC", f"tbl = '{n}'")
            for n in ("tbl_vehicle_monitor", "tbl_waybill_line")}
    at = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
    return " UNION ALL BY NAME ".join((
        _rows("tbl_vehicle_monitor", f"SELECT * FROM ({last['tbl_vehicle_monitor']}) WHERE {where}", id="id",
              deliveryRecord="event_id", expressBillId="event_type", cdt=at),
        _rows("tbl_waybill_line", f"SELECT * FROM ({last['tbl_waybill_line']}) WHERE {where}", id="id",
              waybillNumber="'WB' || CAST(id AS VARCHAR)", routeId="event_id", cdt=at)))


def _mysql_rows(changes: str) -> str:
    """The two tables that the MySQL messages are of."""
    last = {n: _last(changes, "id", "moment DESC, seq DESC, i DESC", f"tbl = '{n}'")
            for n in ("tbl_consumer_address_map", "tbl_customer")}
    return " UNION ALL BY NAME ".join((
        _rows("tbl_consumer_address_map", f"SELECT * FROM ({last['tbl_consumer_address_map']}) WHERE op <> 'delete'",
              id="id", consumerId="consumerId", addressId="addressId", remark="remark"),
        _rows("tbl_customer", f"SELECT * FROM ({last['tbl_customer']}) WHERE op <> 'delete'", id="id", remark="remark")))


_BROKEN_CHANGES = f"SELECT * FROM ({_MYSQL_CHANGES}) WHERE seq % 50 NOT IN (1, 2, 3, 4)"
_ORACLE_REJECTS = f"""
    SELECT 'tbl_nowhere' AS "table", 'unknown table' AS problem, count(*) AS messages
    FROM ({_ORACLE_CHANGES}) WHERE tbl = 'tbl_nowhere' HAVING count(*) > 0
    UNION ALL SELECT NULL, 'unreadable', count(*) FROM events WHERE value > 150 AND value <= 200 HAVING count(*) > 0"""
_MYSQL_REJECTS = """
    SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'tbl_customer' ELSE 'tbl_consumer_address_map' END AS "table",
           'no row' AS problem, count(*) AS messages FROM orders WHERE o_orderkey % 50 IN (1, 2) GROUP BY 1
    UNION ALL SELECT NULL, 'unreadable', count(*) FROM orders WHERE o_orderkey % 50 = 4 HAVING count(*) > 0"""
_BOTH_REJECTS = f"""
    SELECT "table", problem, CAST(sum(messages) AS BIGINT) AS messages
    FROM (SELECT * FROM ({_ORACLE_REJECTS}) UNION ALL SELECT * FROM ({_MYSQL_REJECTS})) GROUP BY ALL"""
_APPLIED = f"{_oracle_rows("op <> 'delete'")} UNION ALL BY NAME SELECT * FROM ({_ORACLE_REJECTS})"

# --- keyed tables -------------------------------------------------------------------------------------------------

_ACCOUNTS = "SELECT c_custkey AS id, c_name AS name, c_acctbal AS amount FROM customer"
_ACCOUNT_CHANGES = """
    SELECT o_custkey + 500 AS id, o_orderpriority AS name, o_totalprice AS amount, o_orderdate AS moment,
           o_orderkey AS seq,
           CASE o_orderstatus WHEN 'P' THEN 'delete' WHEN 'O' THEN 'insert' ELSE 'update' END AS op
    FROM orders"""
_KEYED = f"""
    accounts AS ({_ACCOUNTS}), changes AS ({_ACCOUNT_CHANGES}),
    last AS ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC")}),
    fresh AS (SELECT id, name, amount FROM last WHERE op <> 'delete'),
    versions AS ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC", "op <> 'delete'")})"""

# --- words and search ---------------------------------------------------------------------------------------------

_WORDS = r"""
    SELECT word, count(*) AS count FROM (
        SELECT unnest(regexp_split_to_array(trim(text), '[ \t\n\x0B\f\r]+')) AS word
        FROM documents WHERE text IS NOT NULL AND length(trim(text)) > 0)
    GROUP BY word"""
_TERM = r"(?i)(^|[^\p{L}\p{N}])(the|and)($|[^\p{L}\p{N}])"
_FOUND = f"SELECT * FROM documents WHERE regexp_matches(text, '{_TERM}')"


def _marked() -> str:
    """Mark twice, because two neighbours share the character between them; X keeps a mark from being marked."""
    once = f"regexp_replace(text, '{_TERM}', '\\1<X\\2X>\\3', 'g')"
    twice = once.replace("(text,", f"({once},")
    return f"replace(replace({twice}, '<X', '<em>'), 'X>', '</em>')"


_GENERIC = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
            "embeddings", "pages", "benchmark", "labels", "conversations")
_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS cnt FROM {t}" for t in _GENERIC)

# --- calendar -----------------------------------------------------------------------------------------------------

_SUNDAY = "(date - CAST(dayofweek(date) AS INT))"
_CALENDAR = f"""
    WITH bounds AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds),
    weeks AS (
        SELECT date, {_SUNDAY} AS sunday, make_date(year(date), 1, 1) AS new_year,
               make_date(year(date) + 1, 1, 1) AS next_new_year FROM days),
    per_day AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1)
    SELECT date, CAST(date AS TIMESTAMP) AS day_begin,
           CAST(date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 MILLISECOND AS day_end,
           date - 1 AS yesterday, date + 1 AS tomorrow,
           CAST(date_trunc('week', date) AS TIMESTAMP) AS week_begin,
           CAST(date_trunc('week', date) AS TIMESTAMP) + INTERVAL 7 DAY - INTERVAL 1 MILLISECOND AS week_end,
           CAST(date_trunc('week', date) AS TIMESTAMP) - INTERVAL 7 DAY AS last_week_begin,
           CAST(date_trunc('week', date) AS TIMESTAMP) - INTERVAL 1 MILLISECOND AS last_week_end,
           CAST(date_trunc('month', date) AS TIMESTAMP) AS month_begin,
           CAST(date_trunc('month', date) AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 1 MILLISECOND AS month_end,
           CAST(date_trunc('month', date) AS TIMESTAMP) - INTERVAL 1 MONTH AS last_month_begin,
           CAST(date_trunc('month', date) AS TIMESTAMP) - INTERVAL 1 MILLISECOND AS last_month_end,
           CAST(date_trunc('year', date) AS TIMESTAMP) AS year_begin,
           CAST(date_trunc('year', date) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 MILLISECOND AS year_end,
           CAST(quarter(date) * 3 - 2 AS INT) AS quarter_first_month,
           CAST(date_trunc('quarter', date) AS DATE) + CAST(day(date) - 1 AS INT) AS quarter_month_day,
           (year(date) % 4 = 0 AND year(date) % 100 <> 0) OR year(date) % 400 = 0 AS leap_year,
           dayname(date) AS weekday,
           printf('%d年第%02d周', year(date),
                  CASE WHEN sunday = next_new_year - CAST(dayofweek(next_new_year) AS INT) THEN 1
                       ELSE (sunday - (new_year - CAST(dayofweek(new_year) AS INT))) // 7 + 1 END) AS week_label,
           CAST(date_trunc('month', date) AS DATE) AS month_first,
           CAST(date_trunc('month', date) AS DATE)
               - CAST(dayofweek(date_trunc('month', date)) AS INT) AS grid_first_sunday,
           {", ".join(f"sunday + {n} AS week_day_{n}" for n in range(7))}, orders
    FROM weeks LEFT JOIN per_day USING (date)"""

_DUE = "l_shipdate + to_hours(31 * l_linenumber)"


ORACLES: dict[str, str] = {
    "wide_express_bill": f"WITH {_BILL} SELECT * FROM wide",
    "wide_waybill": f"WITH {_WAYBILL} SELECT * FROM wide",
    "wide_transport_record": f"WITH {_RECORD} SELECT * FROM wide",
    "wide_branch_vehicle": f"WITH {_VEHICLE} SELECT * FROM wide",
    "wide_customer": f"WITH {_CUSTOMER} SELECT * FROM wide",
    "kpi_express_bill": _kpi_of(_BILL, summary.EXPRESS_BILL),
    "kpi_waybill": _kpi_of(_WAYBILL, summary.WAYBILL),
    "kpi_transport_record": _kpi_of(_RECORD, summary.TRANSPORT_RECORD),
    "kpi_branch_vehicle": _kpi_of(_VEHICLE, summary.BRANCH_VEHICLE),
    "kpi_customer": f"""
        WITH {_CUSTOMER},
        dated AS (SELECT *, date_diff('day', CAST(substring(last_sender_cdt, 1, 10) AS DATE), DATE '2001-08-02') AS idle
                  FROM wide)
        SELECT '20010802' AS id, count(*) AS customerCount,
               count(*) FILTER (substring(regdt, 1, 10) = '2001-08-01') AS additionCustomerCount,
               CAST(count(*) FILTER (idle < 180) AS DOUBLE) / count(*) AS preserveRate,
               count(*) FILTER (idle < 10) AS activeCustomerCount,
               count(*) FILTER (regdt BETWEEN '2001-08-01' AND '2001-08-02') AS monthOfNewCustomerCount,
               count(*) FILTER (idle BETWEEN 90 AND 180) AS sleepCustomerCount,
               count(*) FILTER (idle >= 270) AS loseCustomerCount,
               count(first_sender_id) AS customerBillCount,
               CAST(sum(CAST(totalAmount AS DECIMAL(18, 2))) FILTER (first_sender_id IS NOT NULL) AS DOUBLE)
                   / sum(totalCount) FILTER (first_sender_id IS NOT NULL) AS customerAvgAmount,
               CAST(sum(totalCount) FILTER (first_sender_id IS NOT NULL) AS DOUBLE) / count(first_sender_id)
                   AS avgCustomerBillCount
        FROM dated""",
    "sender_totals": f"WITH {_source('tbl_consumer_sender_info', 'tbl_express_package')}, {_TOTALS} "
                     "SELECT * FROM totals",
    "dictionary_decode": f"""
        WITH {_source("tbl_express_bill", "tbl_codes")}
        SELECT b.orderChannelId, c.codeDesc AS channel_name, count(b.id) AS bills
        FROM tbl_express_bill b
        LEFT JOIN (SELECT * FROM tbl_codes WHERE type = 18) c ON TRY_CAST(c.code AS BIGINT) = b.orderChannelId
        GROUP BY ALL""",
    "kpi_order_daily": _kpi(
        """rows AS (
        SELECT strftime(o_orderdate, '%Y%m%d') AS day, o_orderkey, o_orderpriority,
               nullif(o_orderstatus, 'P') AS status, c_mktsegment, n_name
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)""",
        {"Segment": "c_mktsegment", "Nation": "n_name", "Priority": "o_orderpriority", "Status": "status"},
        "o_orderkey", True, "rows"),
    "distinct_days": "SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS day FROM orders WHERE o_orderdate IS NOT NULL",
    "group_count": "SELECT p_brand, count(p_brand) AS total FROM part GROUP BY p_brand",
    "incremental_scan": "SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-30'",
    "incremental_scan_text": f"WITH {_source('tbl_express_bill')} SELECT id, cdt FROM tbl_express_bill "
                             "WHERE substring(cdt, 1, 10) = '1998-06-15'",
    "query_by_example": "SELECT p_partkey, p_name, p_brand, p_type, p_size FROM part "
                        "WHERE p_brand = 'Brand#12' AND p_size = 7",
    "query_by_example_limit": "SELECT p_partkey, p_brand FROM part WHERE p_brand = 'Brand#12' "
                              "ORDER BY p_partkey LIMIT 5",
    "csv_ingest": """
        SELECT o_orderkey,
               CASE WHEN problem IS NULL THEN o_custkey END AS o_custkey,
               CASE WHEN problem IS NULL THEN o_orderdate END AS o_orderdate,
               CASE WHEN problem IS NULL THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN problem IS NULL THEN CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice
                    WHEN o_orderstatus = 'P' AND o_totalprice <= 490000 THEN NULL ELSE 0 END END AS o_totalprice,
               CASE WHEN problem IS NULL AND o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
               problem
        FROM (SELECT *, CASE WHEN o_totalprice > 490000 THEN 'too many values'
                             WHEN o_totalprice < 20000 AND o_orderpriority <> '5-LOW' THEN 'unreadable value'
                        END AS problem FROM orders)""",
    "cdc_oracle_apply": _APPLIED,
    "cdc_oracle_deletes": f"""
        SELECT id, event_id AS routeId, 0 AS transportTool
        FROM ({_last(_ORACLE_CHANGES, "id", "ts DESC, event_id DESC", "tbl = 'tbl_waybill_line'")})
        WHERE op = 'delete'""",
    "cdc_mysql_apply": f"{_mysql_rows(_MYSQL_CHANGES)} UNION ALL BY NAME SELECT NULL::VARCHAR AS problem, "
                       "NULL::BIGINT AS messages WHERE FALSE",
    "two_feeds": f"""{_oracle_rows("op <> 'delete'")} UNION ALL BY NAME {_mysql_rows(_BROKEN_CHANGES)}
        UNION ALL BY NAME SELECT * FROM ({_BOTH_REJECTS})""",
    "cdc_rejects": _BOTH_REJECTS,
    "cdc_order": """
        SELECT o_custkey AS id, CAST(o_orderkey AS VARCHAR) AS jobName
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 7 DESC, o_orderkey) AS back
              FROM orders) WHERE back = 1""",
    "cdc_pass_through": "SELECT props AS value, event_id FROM events",
    "cdc_unknown_operations": """
        SELECT CASE WHEN event_type = 'error' THEN 'truncate' WHEN event_type <> 'signup' THEN 'insert' END AS op_type,
               count(*) AS rows, bool_or(event_type IN ('error', 'signup')) AS refused
        FROM events GROUP BY 1""",
    "cdc_mysql_first_row": f"SELECT tbl AS \"table\", op AS op_type, count(*) AS changes FROM ({_MYSQL_CHANGES}) "
                           "WHERE tbl <> 'tbl_customer' OR i = 0 GROUP BY ALL",
    "cdc_route_counts": f"""
        SELECT tbl AS "table", op AS op_type, CASE tbl WHEN 'tbl_nowhere' THEN 'unknown table' END AS problem,
               count(*) AS changes FROM ({_ORACLE_CHANGES}) GROUP BY ALL
        UNION ALL
        SELECT * FROM (SELECT CAST(NULL AS VARCHAR), 'insert', 'unreadable', count(*) AS changes FROM events
                       WHERE value > 150 AND value <= 200) WHERE changes > 0""",
    "json_path_filter": "SELECT event_id, props FROM events "
                        "WHERE json_extract_string(props, '$.k') IN ('7', '42', '69')",
    "stream_cdc": _APPLIED,
    "stream_documents": f"{_oracle_rows('TRUE')} UNION ALL BY NAME SELECT NULL::VARCHAR AS problem, "
                        "NULL::BIGINT AS messages WHERE FALSE",
    "feed_to_kpi": _kpi_of(_BILL, summary.EXPRESS_BILL),
    "keyed_merge": f"WITH {_KEYED} SELECT * FROM accounts WHERE id NOT IN (SELECT id FROM changes) "
                   "UNION ALL SELECT * FROM fresh",
    "keyed_merge_strict": f"""
        WITH {_KEYED},
        decisive AS ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC", "op <> 'update'")})
        SELECT * FROM accounts WHERE id NOT IN (SELECT id FROM changes)
        UNION ALL
        SELECT f.* FROM fresh f LEFT JOIN decisive d ON f.id = d.id
        WHERE d.op = 'insert' OR (d.op IS NULL AND f.id IN (SELECT id FROM accounts))""",
    "keyed_insert_only": f"WITH {_KEYED} SELECT * FROM accounts UNION ALL "
                         "SELECT id, name, amount FROM versions WHERE id NOT IN (SELECT id FROM accounts)",
    "keyed_update_only": f"WITH {_KEYED} SELECT a.id, CASE WHEN f.id IS NULL THEN a.name ELSE f.name END AS name, "
                         "CASE WHEN f.id IS NULL THEN a.amount ELSE f.amount END AS amount "
                         "FROM accounts a LEFT JOIN versions f ON a.id = f.id",
    "keyed_delete": f"WITH {_KEYED} SELECT * FROM accounts WHERE id NOT IN (SELECT id FROM fresh)",
    "keyed_delete_report": f"WITH {_KEYED} SELECT count(a.id) AS found, count(*) - count(a.id) AS not_found "
                           "FROM (SELECT DISTINCT id FROM changes) c LEFT JOIN accounts a ON a.id = c.id",
    "keyed_update_columns": f"WITH {_KEYED} SELECT a.id, a.name, "
                            "CASE WHEN f.id IS NULL THEN a.amount ELSE f.amount END AS amount "
                            "FROM accounts a LEFT JOIN versions f ON a.id = f.id",
    "update_by_query": f"SELECT id, CASE WHEN amount < 0 THEN 'owes: ' || name ELSE name END AS name, "
                       f"CASE WHEN amount < 0 THEN 0.0 ELSE amount END AS amount FROM ({_ACCOUNTS})",
    "keyed_table": f"WITH {_KEYED} SELECT * FROM fresh",
    "keyed_load_and_feed": f"""
        WITH accounts AS ({_ACCOUNTS}),
        steps AS (
            SELECT id, name, amount, 'insert' AS op, 0 AS step FROM accounts
            UNION ALL SELECT id, name, amount, op, 1
            FROM ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC", "year(moment) < 1996")})
            UNION ALL SELECT id, 'by hand', amount, 'update', 2 FROM accounts WHERE id % 3 = 0
            UNION ALL SELECT id, name, amount, op, 3
            FROM ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC", "year(moment) BETWEEN 1996 AND 1998")})
            UNION ALL SELECT id, name, amount, op, 4
            FROM ({_last(_ACCOUNT_CHANGES, "id", "moment DESC, seq DESC", "year(moment) > 1998")}))
        SELECT id, name, amount
        FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step DESC) AS back FROM steps)
        WHERE back = 1 AND op <> 'delete'""",
    "job_full_and_increment": f"""
        WITH {_BILL}
        SELECT * REPLACE (CASE day WHEN '19980615' THEN coalesce(remark, '') || '-again' ELSE remark END AS remark,
                          coalesce(day, 'none') AS day) FROM wide""",
    "kpi_of_a_day": f"SELECT * FROM ({_kpi_of(_BILL, summary.EXPRESS_BILL)}) WHERE id = '19980615'",
    "changelog_final": f"""
        SELECT id, name, amount FROM ({_last(_ACCOUNT_CHANGES, "id", "seq DESC")}) WHERE op <> 'delete'""",
    "changelog_collapsed": f"""
        SELECT id, name, amount FROM ({_last(_ACCOUNT_CHANGES, "id", "seq DESC")}) WHERE op <> 'delete'""",
    "word_count": _WORDS,
    "stream_word_count": _WORDS,
    "stream_word_count_windows": r"""
        SELECT window_start, word, count(*) AS count FROM (
            SELECT date_trunc('day', ts) AS window_start,
                   unnest(regexp_split_to_array(trim(event_type || ' ' || props), '[ \t\n\x0B\f\r]+')) AS word
            FROM events WHERE event_type || ' ' || props IS NOT NULL AND (
                event_id % 10 <> 0 OR date_trunc('day', ts) + INTERVAL 1 DAY > (
                    SELECT max(ts) - INTERVAL 1 HOUR FROM events WHERE event_id % 10 <> 0)))
        GROUP BY ALL""",
    "stream_to_memory": "SELECT event_id, event_type, value FROM events",
    "rows_to_frame": "SELECT r_name AS name, count(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1",
    "sorted_wide": f"""
        WITH {_BILL},
        times AS (
            SELECT cdt AS time, count(*) AS rows, row_number() OVER (ORDER BY cdt NULLS FIRST) AS first_place,
                   row_number() OVER (ORDER BY cdt NULLS FIRST) AS last_place FROM wide GROUP BY cdt)
        SELECT wide.*, rows, first_place, last_place,
               row_number() OVER (PARTITION BY substring(cdt, 1, 10) ORDER BY cdt NULLS FIRST, id) AS n
        FROM wide JOIN times ON cdt IS NOT DISTINCT FROM time""",
    "day_texts": """
        SELECT CASE strftime(o_orderdate, '%Y%m%d') WHEN '19980616' THEN '1998-06-16' WHEN '19980615' THEN '1998-06-15'
               ELSE 'other' END AS day, count(*) AS orders FROM orders GROUP BY 1""",
    "value_rendering": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, trim(o_orderpriority) AS o_orderpriority,
               CAST(o_custkey AS VARCHAR) AS o_custkey, trim(o_orderstatus) AS o_orderstatus FROM orders""",
    "csv_ingest_header": "SELECT c_custkey, c_mktsegment, c_nationkey FROM customer",
    "search_hits": f"SELECT doc_id, lang, {_marked()} AS text FROM ({_FOUND})",
    "search_facets": f"""
        WITH found AS ({_FOUND})
        SELECT 'total' AS facet, CAST(NULL AS VARCHAR) AS value, count(*) AS docs FROM found
        UNION ALL SELECT 'lang', lang, count(*) FROM found GROUP BY lang
        UNION ALL SELECT 'source', source, count(*) FROM found GROUP BY source""",
    "search_count": f"SELECT count(*) AS total FROM ({_FOUND})",
    "row_audit": _COUNTS,
    "row_audit_total": f"SELECT CAST(sum(cnt) AS BIGINT) AS total FROM ({_COUNTS})",
    "row_audit_distinct": f"SELECT CAST(sum(cnt) AS BIGINT) AS total FROM (SELECT DISTINCT cnt FROM ({_COUNTS}))",
    "row_audit_expected": """
        WITH found AS (
            SELECT 'tbl_pkg' AS table_name, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
                                                                   FROM lineitem)) AS found
            UNION ALL SELECT 'tbl_waybill', (SELECT count(*) FROM orders)
            UNION ALL SELECT 'tbl_customer', (SELECT count(*) FROM customer)),
        expected AS (
            SELECT 'tbl_pkg' AS table_name, (SELECT count(*) FROM lineitem) AS expected
            UNION ALL SELECT 'tbl_waybill', (SELECT count(*) FROM orders)
            UNION ALL SELECT 'tbl_missing', (SELECT count(*) FROM nation))
        SELECT table_name, found, expected, coalesce(found, 0) - coalesce(expected, 0) AS difference
        FROM found FULL JOIN expected USING (table_name)""",
    "calendar_dim": _CALENDAR,
    "date_slices": """
        WITH months AS (
            SELECT CAST(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS DATE)
                       AS month
            FROM (SELECT min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders))
        SELECT month, month + step AS slice FROM months, (VALUES (0), (7), (14), (21), (28)) AS steps(step)
        WHERE month + step < last_day(month)
        UNION ALL SELECT month, last_day(month) FROM months""",
    "date_arithmetic": f"""
        SELECT l_orderkey, l_partkey, l_linenumber,
               CAST(date_diff('day', shipped, due) AS INT) AS days, epoch_ms(due) - epoch_ms(shipped) AS millis,
               greatest(due, shipped) AS later, least(due, shipped) AS earlier,
               CAST(shipped AS DATE) - 45 AS ordered, shipped + INTERVAL 90 MINUTE AS loaded,
               coalesce(TIMESTAMP '1998-06-01' BETWEEN shipped AND due, FALSE) AS open_in_june,
               date_trunc('week', shipped + INTERVAL 1 DAY) = date_trunc('week', due + INTERVAL 1 DAY) AS same_week
        FROM (SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate AS shipped,
                     CASE WHEN l_returnflag <> 'R' THEN {_DUE} END AS due FROM lineitem)""",
    "time_normalise": """
        SELECT event_id, moment, date_trunc('second', ts) AS second,
               CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN strftime(ts, '%Y%m%d') END AS day
        FROM (SELECT *, CASE WHEN event_type IN ('click', 'view') THEN date_trunc('second', ts)
                             WHEN event_type = 'purchase' THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
                             WHEN event_type = 'signup' OR value > 50 THEN date_trunc('milliseconds', ts)
                             WHEN value > 20 THEN date_trunc('second', ts) END AS moment FROM events)""",
} | search_queries.ORACLES
ORACLES["changelog_stored"] = ORACLES["changelog_final"]
ORACLES |= change_queries.oracles(ORACLES) | store_queries.oracles(ORACLES)

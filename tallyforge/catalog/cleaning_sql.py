"""Plain SQL for reading, deduplicating and judging the dirty text view."""

from __future__ import annotations

from ..config import Field, TableSpec
from ..functions.text import WHITESPACE
from ..sources import lake

CONFIG = lake.LAKE_DIRTY_CONFIG
_PLACED = "customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


def _raw(columns: list[str], source: str, copies: str) -> str:
    return f"SELECT {', '.join(columns)} FROM {source}, (VALUES (0), (1)) copied(copy) WHERE copy <= {copies}"


def _base(columns: list[str], where: str = "") -> str:
    order = ", ".join(f"{c} NULLS FIRST" for c in lake.LINE_ORDER)
    placed = f"(SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position FROM lineitem) placed"
    return f"(SELECT {', '.join(columns)} FROM {placed}{where}) base"


RAW_SQL = {
    "customers": _raw(lake.CUSTOMER_RAW, _PLACED, lake.CUSTOMER_COPIES),
    "products": _raw(lake.PRODUCT_RAW, "part", lake.PRODUCT_COPIES),
    "orders": _raw(lake.ORDER_RAW, "orders", lake.ORDER_COPIES),
    "order_lines": _raw(lake.LINE_RAW, _base(lake.line_base("//")), "copies"),
    "returns": _raw(lake.EVENT_RAW, _base(lake.event_base(), " WHERE l_returnflag = 'R'"), "copies"),
}


def strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), '{WHITESPACE}')"


def title(x: str) -> str:
    return f"array_to_string([upper(w[1]) || w[2:] for w in regexp_extract_all(lower({x}), '(\\p{{L}}+|\\P{{L}}+)')], '')"


def day(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"
        f" WHEN regexp_full_match({x}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') THEN CAST(try_strptime({x}, '%m/%d/%Y') AS DATE) END"
    )


def number(x: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({x}, '[+-]?(\\d+|\\d{{1,3}}(,\\d{{3}})+)(\\.\\d+)?')"
        f" THEN TRY_CAST(replace({x}, ',', '') AS DECIMAL(28,10)) END"
    )


def loose_number(x: str) -> str:
    body = "(\\d[\\d,]*(\\.\\d*)?|\\.\\d+)"
    bare = f"regexp_replace(replace(regexp_replace({x}, '[+-]', '', 'g'), ',', ''), '\\.$', '')"
    return (
        f"CASE WHEN regexp_full_match({x}, '([+-]?{body}|{body}[+-])') THEN"
        f" CASE WHEN contains({x}, '-') THEN -TRY_CAST({bare} AS DECIMAL(28,10)) ELSE TRY_CAST({bare} AS DECIMAL(28,10)) END END"
    )


def currency(x: str) -> str:
    return f"CASE WHEN starts_with({x}, '$') THEN {number(f'ltrim(substr({x}, 2))')} ELSE {number(x)} END"


def percent(x: str, read=number) -> str:
    body = read(f"rtrim(left({x}, length({x}) - 1))")
    hundredth = f"CAST(({body}) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(28,10))"
    return f"CASE WHEN ends_with({x}, '%') THEN {hundredth} ELSE {read(x)} END"


def whole(n: str) -> str:
    return f"CASE WHEN {n} > 0 AND {n} = floor({n}) THEN TRY_CAST({n} AS INT) END"


def _parsed_number(f: Field, sql: bool) -> str:
    cell = f"t_{f.name}"
    if not sql:
        return currency(cell) if f.kind == "price" else percent(cell) if f.kind == "rate" else number(cell)
    if f.kind == "price":
        return loose_number(f"trim(replace({cell}, '$', ''))")
    return percent(cell, loose_number) if f.kind == "rate" else loose_number(cell)


def _value(f: Field, sql: bool) -> str:
    cell, n = f"t_{f.name}", f"n_{f.name}"
    if f.kind == "identifier":
        return f"upper({cell})"
    if f.kind == "date":
        return day(cell)
    if f.kind == "count":
        return whole(n)
    if f.kind == "price":
        return f"TRY_CAST({n} AS DECIMAL(12,2))"
    if f.kind == "rate":
        return f"TRY_CAST({n} AS DECIMAL(5,4))"
    if f.kind == "email":
        return f"nullif({cell}, '')" if sql else f"nullif(lower({cell}), '')"
    words = f.synonyms or tuple((d, d) for d in f.domain)
    cases = " ".join(f"WHEN '{w.lower()}' THEN '{m}'" for w, m in words)
    if sql:
        if f.kind in ("label", "synonym"):
            return f"CASE lower({cell}) {cases} END"
        if f.name == "category":
            return f"upper({cell}[1]) || lower({cell}[2:])"
        return cell
    if f.kind == "synonym":
        return f"CASE lower({cell}) {cases} ELSE {title(cell)} END"
    return title(cell) if f.kind in ("label", "title") else cell


def _field_cases(f: Field) -> list[str]:
    cell, n, v = f"t_{f.name}", f"n_{f.name}", f.name
    cases = []

    def add(condition: str, message: str) -> None:
        cases.append(f"CASE WHEN {condition} THEN '{f.name}: {message}' END")

    if f.kind != "email":
        add(f"{cell} = ''", "required field missing")
    if f.kind == "identifier":
        add(f"NOT (length({v}) = {f.length} AND regexp_full_match({v}, '[\\p{{L}}\\p{{N}}]+'))", "invalid text identifier")
    elif f.kind == "date":
        shape = f"regexp_full_match({cell}, '\\d{{4}}-\\d{{2}}-\\d{{2}}|\\d{{2}}/\\d{{2}}/\\d{{4}}')"
        add(f"NOT {shape}", "date must be ISO YYYY-MM-DD or US MM/DD/YYYY")
        add(f"{shape} AND {v} IS NULL", "impossible calendar date")
    elif f.kind in ("price", "rate", "count"):
        add(f"{n} IS NULL", "invalid US-locale decimal")
        if f.kind == "price":
            add(f"{n} <= 0", "price must be positive")
            add(f"{n} > 0 AND coalesce({n} <> {v}, TRUE)", "outside the model precision")
        elif f.kind == "rate":
            add(f"{n} NOT BETWEEN 0 AND 1", "outside [0,1]")
            add(f"{n} BETWEEN 0 AND 1 AND coalesce({n} <> {v}, TRUE)", "outside the model precision")
        else:
            add(f"{n} IS NOT NULL AND {v} IS NULL", "quantity must be a positive integer")
    return cases


def _canonical_cases(t: TableSpec) -> list[str]:
    cases = [c for f in t.fields for c in _field_cases(f)]
    for f in t.fields:
        if f.domain:
            words = ", ".join(f"'{w}'" for w in f.domain)
            cases.append(f"CASE WHEN coalesce({f.name} NOT IN ({words}), TRUE) THEN '{f.name}: unrecognized value' END")
    if t.name == "orders":
        inside = f"order_date >= DATE '{CONFIG.order_from}' AND order_date < DATE '{CONFIG.order_before}'"
        cases.append(f"CASE WHEN NOT ({inside}) THEN 'order_date: outside {CONFIG.window_label}' END")
    return cases


def normalized(t: TableSpec, sql: bool = False) -> str:
    """CTEs s_, p_, n_<table>: stripped cells, numbers, typed values and field reasons."""
    cells = ", ".join(f"{strip(c)} AS t_{c}, {c} AS r_{c}" for c in t.columns)
    numbers = ", ".join(f"{_parsed_number(f, sql)} AS n_{f.name}" for f in t.fields if f.kind in ("price", "rate", "count"))
    values = ", ".join(f"{_value(f, sql)} AS {f.name}" for f in t.fields)
    reasons = "''" if sql else f"concat_ws('; ', {', '.join(_canonical_cases(t))})"
    return (
        f"s_{t.name} AS (SELECT source_row, {cells} FROM ({RAW_SQL[t.name]}) raw),"
        f" p_{t.name} AS (SELECT *{', ' + numbers if numbers else ''} FROM s_{t.name}),"
        f" v_{t.name} AS (SELECT *, {values} FROM p_{t.name}),"
        f" n_{t.name} AS (SELECT *, {reasons} AS field_reasons FROM v_{t.name})"
    )


def _identity_columns(t: TableSpec, sql: bool) -> str:
    if sql:
        return ", ".join(f"r_{c}" for c in t.columns)
    parts = []
    for f in t.fields:
        if f.kind in ("price", "rate"):
            parts += [f"n_{f.name}", f"CASE WHEN n_{f.name} IS NULL THEN t_{f.name} END"]
        elif f.kind in ("date", "count"):
            parts += [f.name, f"CASE WHEN {f.name} IS NULL THEN t_{f.name} END"]
        else:
            parts.append(f.name)
    return ", ".join(parts)


def identified(t: TableSpec, sql: bool = False) -> str:
    """CTEs up to i_<table>: copies, retained rows and key conflicts by window functions."""
    columns = _identity_columns(t, sql)
    return normalized(t, sql) + (
        f", k_{t.name} AS (SELECT *, row_number() OVER (PARTITION BY {columns} ORDER BY source_row) AS rn,"
        f" min(source_row) OVER (PARTITION BY {columns}) AS retained FROM n_{t.name}),"
        f" i_{t.name} AS (SELECT *, count(*) FILTER (rn = 1) OVER (PARTITION BY {t.key}) > 1 AS conflict FROM k_{t.name})"
    )


def _first_cases(t: TableSpec) -> list[str]:
    """First-match reasons, most important first."""

    def when(condition: str, message: str) -> str:
        return f"WHEN {condition} THEN '{message}'"

    def price(c: str, noun: str) -> list[str]:
        return [
            when(f"n_{c} IS NULL OR n_{c} <= 0", f"{noun} must be a positive number"),
            when(f"coalesce(n_{c} <> {c}, TRUE)", f"{noun} is outside the model precision"),
        ]

    key = t.field(t.key)
    cases = [
        when("conflict", "Conflicting records share a normalized business key"),
        when(f"{t.key} = '' OR length({t.key}) > {key.length}", f"Invalid {t.key_noun}"),
    ]
    shape = "require ISO yyyy-MM-dd or US MM/dd/yyyy"
    if t.name == "customers":
        cases += [
            when("customer_name = '' OR length(customer_name) > 100", "Missing or overlength customer name"),
            when("region IS NULL", "Unrecognized region"),
            when("segment IS NULL", "Unrecognized segment"),
        ]
    elif t.name == "products":
        cases += [
            when("product_name = '' OR length(product_name) > 100", "Missing or overlength product name"),
            when("category = '' OR length(category) > 30", "Missing or overlength category"),
            *price("list_price", "List price"),
        ]
    elif t.name == "orders":
        cases += [
            when("order_date IS NULL", f"Invalid order date: {shape}"),
            when(f"order_date < DATE '{CONFIG.order_from}' OR order_date >= DATE '{CONFIG.order_before}'", f"Order date is outside {CONFIG.window_label}"),
            when("NOT has_customers", "Unknown or rejected customer"),
            when("channel IS NULL", "Unrecognized channel"),
            when("status IS NULL", "Unrecognized order status"),
        ]
    elif t.name == "order_lines":
        cases += [
            when("NOT has_orders", "Unknown or rejected order"),
            when("NOT has_products", "Unknown or rejected product"),
            when("quantity IS NULL", "Quantity must be a positive integer"),
            *price("unit_price", "Unit price"),
            when("n_discount_rate IS NULL OR n_discount_rate NOT BETWEEN 0 AND 1", "Discount must be between zero and one"),
            when("coalesce(n_discount_rate <> discount_rate, TRUE)", "Discount is outside the model precision"),
        ]
    else:
        cases += [
            when("bought IS NULL", "Unknown or rejected order line"),
            when("order_status <> 'Completed'", "Returns require a completed order"),
            when("return_date IS NULL", f"Invalid return date: {shape}"),
            when("return_date < ordered", "Return date precedes order date"),
            when(f"return_date > DATE '{CONFIG.return_cutoff}'", f"Return date is after the {CONFIG.return_cutoff} cutoff"),
            when("return_quantity IS NULL", "Return quantity must be a positive integer"),
            when("return_quantity > bought", "Individual return quantity exceeds purchased units"),
            when("reason = '' OR length(reason) > 100", "Missing or overlength return reason"),
        ]
    return cases


def _row_reason(t: TableSpec, sql: bool) -> str:
    if sql:
        return f"CASE {' '.join(_first_cases(t))} END"
    cases = [f"CASE WHEN conflict THEN '{t.key}: conflicting business records for key' END"]
    cases += [f"CASE WHEN NOT has_{p.table} THEN '{p.column}: unknown or rejected {p.noun}' END" for p in t.parents]
    if t.name == "returns":
        cases += [
            "CASE WHEN bought IS NULL THEN 'order_line_id: unknown or rejected line' END",
            "CASE WHEN order_status <> 'Completed' THEN 'order_id: return requires completed order' END",
            "CASE WHEN return_date < ordered THEN 'return_date: precedes order date' END",
            f"CASE WHEN bought IS NOT NULL AND return_date > DATE '{CONFIG.return_cutoff}' THEN 'return_date: after {CONFIG.return_cutoff} cutoff' END",
            "CASE WHEN return_quantity > bought THEN 'return_quantity: event exceeds purchased quantity' END",
        ]
    return f"nullif(concat_ws('; ', nullif(field_reasons, ''), {', '.join(cases)}), '')"


def labelled(t: TableSpec, sql: bool = False) -> str:
    """CTEs up to l_<table> (disposition and reason) and a_<table> (accepted rows)."""
    flags, source = "", f"i_{t.name} i"
    if t.name == "returns":
        flags = ", l.quantity AS bought, o.status AS order_status, o.order_date AS ordered"
        source += " LEFT JOIN a_order_lines l ON l.order_line_id = i.order_line_id LEFT JOIN a_orders o ON o.order_id = l.order_id"
    for p in t.parents:
        flags += f", i.{p.column} IN (SELECT {p.column} FROM a_{p.table}) AS has_{p.table}"
    copy = "Exact duplicate of original business fields" if sql else "duplicate business record (source row excluded)"
    chain = identified(t, sql) + (
        f", f_{t.name} AS (SELECT i.*{flags} FROM {source}),"
        f" g_{t.name} AS (SELECT *, {_row_reason(t, sql)} AS row_reason FROM f_{t.name})"
    )
    judged = f"g_{t.name}"
    if t.name == "returns":
        message = (
            "Cumulative otherwise-valid returns exceed purchased units; review all events on line"
            if sql
            else "return_quantity: cumulative valid events exceed purchased quantity; whole group quarantined"
        )
        chain += (
            ", h_returns AS (SELECT * EXCLUDE (row_reason), CASE WHEN row_reason IS NULL AND rn = 1 AND sum(CASE WHEN row_reason IS NULL"
            f" AND rn = 1 THEN return_quantity END) OVER (PARTITION BY order_line_id) > bought THEN '{message}' ELSE row_reason END AS row_reason FROM g_returns)"
        )
        judged = "h_returns"
    raw_json = ", ".join(f"'{c}': r_{c}" for c in t.columns)
    return chain + (
        f", l_{t.name} AS (SELECT *, '{t.name}' AS source_table, nullif({t.key}, '') AS business_key,"
        " CASE WHEN rn > 1 THEN 'Duplicate' WHEN row_reason IS NOT NULL THEN 'Rejected' ELSE 'Accepted' END AS disposition,"
        f" CASE WHEN rn > 1 THEN '{copy}' ELSE row_reason END AS final_reason,"
        f" CASE WHEN rn > 1 THEN retained END AS retained_source_row, CAST(to_json({{{raw_json}}}) AS VARCHAR) AS raw_json FROM {judged}),"
        f" a_{t.name} AS (SELECT * FROM l_{t.name} WHERE disposition = 'Accepted')"
    )


def chain(sql: bool = False, upto: str = "returns") -> str:
    """The labelled CTEs of all tables up to ``upto``, parents first."""
    parts = []
    for t in CONFIG.tables:
        parts.append(labelled(t, sql))
        if t.name == upto:
            break
    return ", ".join(parts)


def log(sql: bool = False) -> str:
    """The disposition log over all tables."""
    columns = (
        "source_table, CAST(source_row AS VARCHAR) AS source_row, business_key, disposition, final_reason AS reason,"
        " CAST(retained_source_row AS VARCHAR) AS retained_source_row, raw_json"
    )
    union = " UNION ALL ".join(f"SELECT {columns} FROM l_{t.name}" for t in CONFIG.tables)
    return f"WITH {chain(sql)}, log AS ({union})"

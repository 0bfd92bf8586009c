"""The same results in plain SQL over the test tables, written without the library."""

from __future__ import annotations

AS_OF = "DATE '2001-08-31'"
DT_PROC = "20010831000000"
FIRST_LOAD, SECOND_LOAD = "20010731000000", "20010831000000"
THIRD_LOAD = "20010831120000"

_RAW_TRANSACTIONS = """
    SELECT CAST(l_orderkey AS VARCHAR) AS "Invoice ID", l_linenumber AS "Line", o_custkey AS "Customer ID",
           l_partkey AS "Product ID", l_linestatus AS "Size", o_orderpriority AS "Color",
           l_extendedprice / l_quantity AS "Unit Price", CAST(l_quantity AS INTEGER) AS "Quantity",
           o_orderdate + to_hours(CAST(l_orderkey % 24 AS INTEGER)) AS "Date",
           l_discount AS "Discount", l_extendedprice AS "Line Total", l_suppkey AS "Store ID",
           l_suppkey * 10 + l_linenumber AS "Employee ID",
           CASE n_regionkey WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP'
                            WHEN 3 THEN 'CNY' WHEN 4 THEN 'JPY' END AS "Currency",
           CASE n_regionkey WHEN 0 THEN '$' WHEN 1 THEN '€' WHEN 2 THEN '£'
                            WHEN 3 THEN '¥' WHEN 4 THEN '円' END AS "Currency Symbol",
           l_partkey || '-' || l_suppkey AS "SKU",
           CASE WHEN l_returnflag = 'R' THEN 'Return' ELSE 'Sale' END AS "Transaction Type",
           CASE o_orderstatus WHEN 'F' THEN 'Cash' WHEN 'O' THEN 'Credit Card'
                              ELSE 'Voucher' END AS "Payment Method",
           o_totalprice AS "Invoice Total"
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                  JOIN customer ON o_custkey = c_custkey
                  JOIN nation ON c_nationkey = n_nationkey"""

_RAW = {
    "customers": """
    SELECT c_custkey AS "Customer ID", c_name AS "Name",
           lower(c_name) || '@example.com' AS "Email", '+' || c_custkey AS "Telephone",
           'City ' || c_nationkey AS "City", n_name AS "Country",
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS "Gender",
           DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INTEGER) AS "Date Of Birth",
           c_mktsegment AS "Job Title"
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "discounts": """
    SELECT DATE '1995-01-01' + CAST(p_partkey AS INTEGER) AS "Start",
           DATE '1995-01-01' + CAST(p_partkey + p_size AS INTEGER) AS "End",
           p_size / 100 AS "Discont", p_type AS "Description", p_brand AS "Category",
           CASE WHEN p_size % 5 <> 0 THEN p_name END AS "Sub category"
    FROM part""",
    "employees": """
    SELECT l_suppkey * 10 + l_linenumber AS "Employee ID", l_suppkey AS "Store ID",
           'Employee ' || l_linenumber AS "Name", 'Desk ' || l_linenumber AS "Position"
    FROM lineitem""",
    "products": """
    SELECT p_partkey AS "Product ID", p_brand AS "Category", p_type AS "Sub Category",
           'PT ' || p_name AS "Description PT", 'DE ' || p_name AS "Description DE",
           'FR ' || p_name AS "Description FR", 'ES ' || p_name AS "Description ES",
           p_name AS "Description EN", 'ZH ' || p_name AS "Description ZH",
           split_part(p_name, ' ', 1) AS "Color", CAST(p_size AS VARCHAR) AS "Sizes",
           p_retailprice AS "Production Cost"
    FROM part""",
    "stores": """
    SELECT s_suppkey AS "Store ID", n_name AS "Country", 'City ' || s_nationkey AS "City",
           s_name AS "Store Name", CAST(s_suppkey % 50 AS INTEGER) AS "Number of Employees",
           lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS "ZIP Code",
           CAST(s_nationkey AS DOUBLE) + CAST(0.5 AS DOUBLE) AS "Latitude",
           s_acctbal / 100 AS "Longitude"
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "transactions": _RAW_TRANSACTIONS,
}

_TRUSTED_COLUMNS = {
    "customers": f"""
           "Customer ID" AS customer_id, "Name" AS name, "Email" AS email,
           "Telephone" AS telephone, "City" AS city, "Country" AS country, "Gender" AS gender,
           "Job Title" AS job_title, "Date Of Birth" AS birthdate,
           CAST(date_sub('year', "Date Of Birth", {AS_OF}) AS INTEGER) AS age""",
    "discounts": """
           "Start" AS start, "End" AS "end",
           substring(replace(CAST("Start" AS VARCHAR), '-', ''), 1, 6) AS ref,
           "Discont" AS discount, "Description" AS description, "Category" AS category,
           "Sub category" AS subcategory,
           "Description" || ' - ' || "Category" || ' - ' || "Sub category" AS discount_id""",
    "employees": """
           "Employee ID" AS employee_id, "Store ID" AS store_id, "Name" AS name,
           "Position" AS position""",
    "products": """
           "Product ID" AS product_id, "Category" AS category, "Sub Category" AS subcategory,
           "Description PT" AS description_pt, "Description DE" AS description_de,
           "Description FR" AS description_fr, "Description ES" AS description_es,
           "Description EN" AS description_en, "Description ZH" AS description_zh,
           "Color" AS color, "Sizes" AS sizes, "Production Cost" AS production_cost""",
    "stores": """
           "Store ID" AS store_id, "Country" AS country, "City" AS city,
           "Store Name" AS store_name, "Number of Employees" AS number_of_employees,
           "ZIP Code" AS zip_code, "Latitude" AS latitude, "Longitude" AS longitude""",
    "transactions": """
           "Invoice ID" AS invoice_id, "Line" AS line, "Customer ID" AS customer_id,
           "Product ID" AS product_id, "Size" AS size, "Color" AS color,
           "Unit Price" AS unit_price, "Quantity" AS quantity, "Date" AS date_hour,
           CAST("Date" AS DATE) AS date, CAST(hour("Date") AS INTEGER) AS hour,
           substring(replace(CAST("Date" AS VARCHAR), '-', ''), 1, 6) AS ref,
           "Discount" AS discount, "Line Total" AS line_total, "Store ID" AS store_id,
           "Employee ID" AS employee_id, "Currency" AS currency,
           "Currency Symbol" AS currency_symbol, "SKU" AS sku,
           "Transaction Type" AS transaction_type, "Payment Method" AS payment_method,
           "Invoice Total" AS invoice_total""",
}

_KEYS = {
    "customers": "customer_id",
    "discounts": "discount_id",
    "employees": "employee_id",
    "products": "product_id",
    "stores": "store_id",
    "transactions": "invoice_id",
}


def _trusted(subject: str, distinct: str = "DISTINCT") -> str:
    return f"""
    SELECT {_TRUSTED_COLUMNS[subject]},
           '{DT_PROC}' AS dt_proc
    FROM (SELECT {distinct} * FROM ({_RAW[subject]}))"""


_TRANSACTIONS = _trusted("transactions", distinct="")

_SHIPPED = """
    SELECT l_orderkey AS invoice_id, l_linenumber AS line, l_partkey AS product_id,
           l_suppkey AS store_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_extendedprice AS line_total,
           strftime(l_shipdate, '%Y%m') || '01000000' AS dt_proc
    FROM lineitem"""

_EVENTS = """
    SELECT event_id, user_id,
           CASE WHEN event_type <> 'error' THEN event_type END AS event_type, value,
           strftime(ts, '%Y%m%d') AS dt_proc
    FROM events"""

_DISCOUNTS = f"SELECT * REPLACE (ref AS dt_proc) FROM ({_trusted('discounts')})"


def _latest(source: str, keys: tuple[str, ...], equal: str = "=") -> str:
    same = " AND ".join(f"a.{key} {equal} b.{key}" for key in keys)
    return f"""
    WITH src AS ({source}),
         newest AS (SELECT {', '.join(keys)}, max(dt_proc) AS newest FROM src GROUP BY ALL)
    SELECT a.* FROM src a JOIN newest b ON {same} AND a.dt_proc = b.newest"""


_WEEKDAY = """CASE dayofweek(date) WHEN 0 THEN 'DOMINGO' WHEN 1 THEN 'SEGUNDA'
           WHEN 2 THEN 'TERCA' WHEN 3 THEN 'QUARTA' WHEN 4 THEN 'QUINTA'
           WHEN 5 THEN 'SEXTA' WHEN 6 THEN 'SABADO' END AS fbc_dia_compra"""
_PERIOD = """CASE WHEN hour <= 6 THEN 'MADRUGADA' WHEN hour <= 12 THEN 'MANHA'
           WHEN hour <= 18 THEN 'TARDE' WHEN hour <= 24 THEN 'NOITE'
           END AS fbc_periodo_compra"""
_PAYMENT = """CASE payment_method WHEN 'Cash' THEN 'DINHEIRO' WHEN 'Credit Card' THEN 'CARTAO'
           END AS fbc_metodo_pagamento"""
_CURRENCY = """CASE currency WHEN 'USD' THEN 'DOLAR' WHEN 'EUR' THEN 'EURO'
           WHEN 'GBP' THEN 'LIBRA' WHEN 'CNY' THEN 'YUAN' END AS fbc_moeda"""
_FLAGS = """CAST(coalesce(discount > 0, FALSE) AS INTEGER) AS flg_desconto,
           CAST(coalesce(transaction_type = 'Return', FALSE) AS INTEGER) AS flg_retorno"""


def _lines_with(expression: str) -> str:
    return f"SELECT invoice_id, line, product_id, {expression} FROM ({_TRANSACTIONS})"


_MARKER_SOURCE = f"""
    SELECT invoice_id, customer_id, line, product_id, store_id, line_total,
           row_number() OVER (PARTITION BY invoice_id
               ORDER BY customer_id NULLS LAST, line NULLS LAST, product_id NULLS LAST,
                        store_id NULLS LAST, line_total NULLS LAST) AS rn
    FROM ({_TRANSACTIONS})"""

_STAGE = f"""
    SELECT customer_id, CAST({DT_PROC} AS BIGINT) AS dt_proc, CAST(200108 AS INTEGER) AS ref, date,
           {_WEEKDAY},
           {_PERIOD},
           {_PAYMENT},
           {_CURRENCY},
           {_FLAGS},
           line_total AS fvl_invoice_total,
           CASE WHEN row_number() OVER (PARTITION BY invoice_id
               ORDER BY customer_id NULLS LAST, line NULLS LAST, date NULLS LAST,
                        hour NULLS LAST, discount NULLS LAST, currency NULLS LAST,
                        transaction_type NULLS LAST, payment_method NULLS LAST,
                        line_total NULLS LAST) = 1
               THEN CAST(1 AS INTEGER) END AS fvl_qtd_transacoes,
           CAST(1 AS INTEGER) AS fvl_qtd_itens_transacao
    FROM ({_TRANSACTIONS})"""

_WINDOW_FLAGS = ", ".join(
    f"CAST(coalesce(date >= CAST({AS_OF} - to_months({k}) AS DATE), FALSE) AS INTEGER)"
    f" AS flg_u{k}m"
    for k in (1, 3, 6, 9, 12)
)

_VALUES = {
    "FBC_DIA_COMPRA": ["DOMINGO", "SEGUNDA", "TERCA", "QUARTA", "QUINTA", "SEXTA", "SABADO"],
    "FBC_PERIODO_COMPRA": ["MADRUGADA", "MANHA", "TARDE", "NOITE"],
    "FBC_METODO_PAGAMENTO": ["DINHEIRO", "CARTAO"],
    "FBC_MOEDA": ["DOLAR", "EURO", "LIBRA", "YUAN"],
}
_COUNTED = ["FVL_QTD_TRANSACOES", "FVL_QTD_ITENS_TRANSACAO", "FLG_DESCONTO", "FLG_RETORNO"]
_MONTHS = [1, 3, 6, 9, 12]


def _numbered(dims: list[str], amount: bool, counts: bool) -> list[tuple[str, ...]]:
    """(dim, value, measure, window, aggregate), in the order the columns are numbered."""
    out = []
    for dim in dims:
        for value in _VALUES[dim]:
            if amount:
                for k in _MONTHS:
                    for agg in ("SUM", "AVG", "MIN", "MAX"):
                        out.append((dim, value, "FVL_INVOICE_TOTAL", f"FLG_U{k}M", agg))
            if counts:
                for measure in _COUNTED:
                    for k in _MONTHS:
                        out.append((dim, value, measure, f"FLG_U{k}M", "SUM"))
    return out


def _aggregate(dim: str, value: str, measure: str, window: str, agg: str) -> str:
    call = f"{agg}(CASE WHEN {dim} = '{value}' AND {window} = 1 THEN {measure} END)"
    if measure != "FVL_INVOICE_TOTAL":
        return f"CAST({call} AS BIGINT)"
    return {"SUM": f"round({call}, 2)", "AVG": f"round({call}, 6)"}.get(agg, call)


def _book(dims: list[str], amount: bool = True, counts: bool = True) -> str:
    columns = ",\n           ".join(
        f"{_aggregate(*feature)} AS VAR_{n}"
        for n, feature in enumerate(_numbered(dims, amount, counts))
    )
    return f"""
    WITH staged AS ({_STAGE}),
         windowed AS (SELECT *, {_WINDOW_FLAGS} FROM staged)
    SELECT customer_id, ref,
           {columns}
    FROM windowed GROUP BY customer_id, ref"""


_BOOK_FULL = _book(list(_VALUES))


def _exact_aggregate(dim: str, value: str, measure: str, window: str, agg: str) -> str:
    """Amounts added up as decimals, so that the order of the rows does not show."""
    picked = f"CASE WHEN {dim} = '{value}' AND {window} = 1 THEN {measure} END"
    if agg in ("MIN", "MAX"):
        return f"{agg}({picked})"
    total = f"CAST(sum(CAST({picked} AS DECIMAL(18, 4))) AS DOUBLE)"
    return total if agg == "SUM" else f"{total} / count({picked})"


def _book_exact() -> str:
    columns = ",\n           ".join(
        f"{_exact_aggregate(*feature)} AS VAR_{n}"
        for n, feature in enumerate(_numbered(list(_VALUES), True, False))
    )
    return f"""
    WITH staged AS ({_STAGE}),
         windowed AS (SELECT *, {_WINDOW_FLAGS} FROM staged)
    SELECT customer_id, ref,
           {columns}
    FROM windowed GROUP BY customer_id, ref"""


def _dictionary() -> str:
    features = _numbered(list(_VALUES), True, True)
    names = ", ".join(
        f"('VAR_{n}', {', '.join(repr(x) for x in feature)})" for n, feature in enumerate(features)
    )
    filled = ", ".join(f"count(VAR_{n}) AS VAR_{n}" for n in range(len(features)))
    return f"""
    WITH book AS ({_BOOK_FULL}),
         filled AS (SELECT {filled} FROM book),
         coverage AS (UNPIVOT filled ON COLUMNS(*) INTO NAME var VALUE customers),
         names(var, dim, value, measure, "window", agg) AS (VALUES {names})
    SELECT var, dim, value, measure, "window", agg, CAST(customers AS BIGINT) AS customers
    FROM names JOIN coverage USING (var)"""


def _count(tb_name: str, source: str) -> str:
    return (
        f"SELECT '{tb_name}' AS tb_name, CAST({DT_PROC} AS BIGINT) AS dt_proc,"
        f" CAST(count(*) AS BIGINT) AS qtd_registros FROM ({source})"
    )


def _control(stage: str) -> str:
    parts = []
    for subject, raw in _RAW.items():
        trusted = _trusted(subject)
        parts += [
            _count(f"tb_raw_{subject}", raw),
            _count(f"tb_trusted_{subject}", trusted),
            _count(f"tb_refined_data_viz_{subject}", _latest(trusted, (_KEYS[subject],))),
        ]
    parts += [
        _count("tb_refined_stage", stage),
        _count("tb_refined_book", f"SELECT customer_id, ref FROM ({stage}) GROUP BY ALL"),
    ]
    return "\nUNION ALL\n".join(parts)


def _ingested(subject: str) -> str:
    return f"SELECT *, CAST({DT_PROC} AS BIGINT) AS dt_proc FROM ({_RAW[subject]})"


_DIM_OF = {
    "day": "FBC_DIA_COMPRA",
    "period": "FBC_PERIODO_COMPRA",
    "payment": "FBC_METODO_PAGAMENTO",
    "currency": "FBC_MOEDA",
}

_DEDUP_TWICE = f"""
    SELECT *, '{FIRST_LOAD}' AS dt_proc FROM lineitem
    UNION ALL SELECT *, '{SECOND_LOAD}' AS dt_proc FROM lineitem"""

# A run removes exact duplicates of the landing rows before it makes the stage.
_DISTINCT_TRANSACTIONS = _trusted("transactions")
_RUN_BOOK = _BOOK_FULL.replace(_TRANSACTIONS, _DISTINCT_TRANSACTIONS)
_BROKEN_EMPLOYEES = f"""
    SELECT *, "Employee ID" % 10 = 7 AS bad FROM ({_RAW["employees"]})"""
_RUN_CONTROL = _control(_STAGE.replace(_TRANSACTIONS, _DISTINCT_TRANSACTIONS))

ORACLE: dict[str, str] = {
    **{f"trusted_{subject}": _trusted(subject) for subject in _RAW},
    "dedup_exact_rows": "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)",
    "dedup_exact_rows_per_load": f"SELECT DISTINCT * FROM ({_DEDUP_TWICE})",
    "latest_load_per_key": f"""
    SELECT invoice_id, max(dt_proc) AS newest_version FROM ({_SHIPPED}) GROUP BY invoice_id""",
    "dedup_latest_transactions": _latest(_SHIPPED, ("invoice_id",)),
    "dedup_latest_dims": _latest(_EVENTS, ("user_id", "event_type")),
    "dedup_latest_discounts": _latest(_DISCOUNTS, ("discount_id",)),
    "dedup_latest_discounts_null_key": _latest(
        _DISCOUNTS, ("discount_id",), "IS NOT DISTINCT FROM"
    ),
    "refined_snapshot": f"""
    SELECT * REPLACE ('{DT_PROC}' AS dt_proc) FROM ({_latest(_SHIPPED, ("invoice_id",))})""",
    "stage_day_of_week": _lines_with(_WEEKDAY),
    "stage_period_of_day": _lines_with(_PERIOD),
    "stage_payment_recode": _lines_with(_PAYMENT),
    "stage_currency_recode": _lines_with(_CURRENCY),
    "stage_flags": _lines_with(_FLAGS),
    "stage_period_of_day_events": f"""
    SELECT event_id, hour, {_PERIOD}
    FROM (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events)""",
    "txn_first_line_marker": f"""
    SELECT * EXCLUDE (rn), CASE WHEN rn = 1 THEN CAST(1 AS INTEGER) END AS fvl_qtd_transacoes
    FROM ({_MARKER_SOURCE})""",
    "txn_first_lines": f"SELECT * EXCLUDE (rn) FROM ({_MARKER_SOURCE}) WHERE rn = 1",
    "stage_features": _STAGE,
    "recency_windows": f"""
    SELECT invoice_id, line, product_id, date, {_WINDOW_FLAGS} FROM ({_TRANSACTIONS})""",
    "book_reference_period": """
    SELECT as_of, strftime(last_day(as_of), '%Y%m') AS ref,
           strftime(last_day(as_of) - INTERVAL 12 MONTH, '%Y%m') AS start_ref,
           CAST(last_day(as_of) AS DATE) AS month_end, count(*) AS orders
    FROM (SELECT CAST(o_orderdate AS DATE) AS as_of FROM orders)
    GROUP BY as_of""",
    **{
        f"book_amount_{name}": _book([dim], counts=False) for name, dim in _DIM_OF.items()
    },
    **{
        f"book_counts_{name}": _book([dim], amount=False) for name, dim in _DIM_OF.items()
    },
    "book_full": _BOOK_FULL,
    "book_full_from_stage": _BOOK_FULL,
    "book_exact": _book_exact(),
    "book_from_states": _BOOK_FULL,
    "book_after_late_lines": _BOOK_FULL,
    "book_dictionary": _dictionary(),
    "control_all_layers": _control(_STAGE),
    "refined_views": f"""
    SELECT c.country, t.payment_method, CAST({DT_PROC} AS BIGINT) AS dt_proc,
           CAST(count(*) AS BIGINT) AS lines,
           CAST(count(DISTINCT t.invoice_id) AS BIGINT) AS invoices,
           CAST(sum(t.quantity) AS BIGINT) AS items
    FROM ({_latest(_trusted("transactions"), ("invoice_id",))}) t
    JOIN ({_latest(_trusted("customers"), ("customer_id",))}) c USING (customer_id)
    GROUP BY ALL""",
    **{
        f"ingest_csv_{subject}": _ingested(subject) for subject in _RAW if subject != "transactions"
    },
    "ingest_csv_roundtrip": _ingested("transactions"),
    "write_by_ref_roundtrip": f"""
    SELECT invoice_id, line, product_id, line_total, dt_proc, CAST(ref AS INTEGER) AS ref
    FROM ({_TRANSACTIONS})""",
    "landing_incremental": f"""
    SELECT *, CAST({FIRST_LOAD} AS BIGINT) AS dt_proc FROM ({_RAW["products"]})
    UNION ALL SELECT *, CAST({SECOND_LOAD} AS BIGINT) AS dt_proc FROM ({_RAW["products"]})""",
    "landing_rejected": f"""
    SELECT CASE WHEN NOT bad THEN "Employee ID" END AS "Employee ID", "Store ID", "Name", "Position",
           CASE WHEN bad THEN 'no ' || "Employee ID" || ',' || "Store ID" || ',' || "Name" || ','
                              || "Position" END AS rejected_row,
           CAST({FIRST_LOAD} AS BIGINT) AS dt_proc
    FROM ({_BROKEN_EMPLOYEES})""",
    "landing_drift": f"""
    SELECT * REPLACE (CASE WHEN "Product ID" % 3 <> 2 THEN "Color" END AS "Color"),
           CASE WHEN "Product ID" % 3 = 1 AND "Product ID" % 2 = 0
                THEN 'S' || "Product ID" % 4 END AS season
    FROM ({_RAW["products"]})""",
    "load_replaced": f"""
    SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
           CAST({SECOND_LOAD} AS BIGINT) AS dt_proc
    FROM orders""",
    "trusted_new_loads": f"""
    SELECT * REPLACE (CAST(ref AS INTEGER) AS ref,
                      CAST(CASE WHEN line <= 3 THEN {FIRST_LOAD} WHEN line <= 5 THEN {SECOND_LOAD}
                                ELSE {THIRD_LOAD} END AS BIGINT) AS dt_proc)
    FROM ({_trusted("transactions")})""",
    "snapshot_new_loads": f"""
    SELECT * REPLACE (CAST({THIRD_LOAD} AS BIGINT) AS dt_proc) FROM ({_trusted("customers")})""",
    "snapshot_by_change": _latest(
        f"""
    SELECT CASE WHEN l_linenumber <> 7 THEN l_orderkey END AS invoice_id, l_linenumber AS line,
           l_partkey AS product_id, l_suppkey AS store_id, l_extendedprice AS line_total,
           CASE WHEN year(l_shipdate) < 1994 THEN '{FIRST_LOAD}'
                WHEN year(l_shipdate) < 1997 THEN '{SECOND_LOAD}' ELSE '{THIRD_LOAD}' END AS dt_proc
    FROM lineitem""",
        ("invoice_id",), "IS NOT DISTINCT FROM",
    ),
    "control_against_files": f"""
    SELECT tb_name, dt_proc, qtd_registros, qtd_registros AS found_rows FROM ({_RUN_CONTROL})""",
    "faulty_run_control": f"""
    SELECT * FROM ({_RUN_CONTROL}) WHERE tb_name NOT LIKE '%products'""",
    "resumed_run_control": _RUN_CONTROL,
    "monthly_run_control": _RUN_CONTROL,
    "monthly_run_book": _RUN_BOOK,
    "monthly_run_repeated": _RUN_BOOK,
    "monthly_run_repeated_control": _RUN_CONTROL,
}

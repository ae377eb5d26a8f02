"""SQL twins of the catalog views and of the exact rounding, for the comparison queries."""

from __future__ import annotations

MONEY = "DECIMAL(18,2)"

_VIEWS = {
    "heads": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending'
                                  WHEN 'P' THEN 'cancelled' END AS status
        FROM orders""",
    "placed": """
        SELECT h.*, s.quantity, s.total_amount
        FROM heads h JOIN (
            SELECT l_orderkey, CAST(SUM(CAST(l_quantity AS INT)) AS BIGINT) AS quantity,
                   CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
            FROM lineitem GROUP BY l_orderkey) s ON s.l_orderkey = h.order_id""",
    "lines": """
        SELECT h.order_id, l_linenumber AS line_number, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount,
               CAST((CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS HUGEINT) * 2 + CAST(l_quantity AS INT))
                    // (2 * CAST(l_quantity AS INT)) AS BIGINT) AS unit_cents,
               h.customer_id, h.order_date, h.status AS order_status
        FROM lineitem JOIN heads h ON l_orderkey = h.order_id""",
    "people": """
        SELECT c_custkey AS customer_id, c_name AS name,
               CASE WHEN c_acctbal < 0 THEN lower(c_name) ELSE replace(lower(c_name), '#', '.') END
                   || '@' || lower(c_mktsegment) || '.com' AS email,
               n_name AS country,
               DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS registration_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "paid": """
        SELECT o_orderkey AS payment_id, o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'
                    WHEN '3-MEDIUM' THEN 'paypal' WHEN '4-NOT SPECIFIED' THEN 'bank_transfer'
                    WHEN '5-LOW' THEN 'cash' END AS payment_method,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'card'
                    WHEN o_orderpriority = '3-MEDIUM' THEN 'digital_wallet'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'bank' ELSE 'other' END AS payment_category,
               CAST(o_orderdate AS DATE) AS payment_date,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' END AS status
        FROM orders WHERE o_orderstatus <> 'P'""",
    "rich": """
        SELECT o.order_id, o.customer_id, o.order_date, o.status AS order_status, o.quantity, o.total_amount,
               p.payment_id, p.amount AS payment_amount, p.payment_method, p.payment_category, p.payment_date,
               p.status AS payment_status, c.name AS customer_name, c.email AS customer_email,
               c.country AS customer_country, c.registration_date
        FROM placed o LEFT JOIN paid p ON p.order_id = o.order_id LEFT JOIN people c ON c.customer_id = o.customer_id""",
    "sent": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
               'P' || CAST(json_extract(props, '$.k') AS INT) AS product_id,
               CAST(value AS DECIMAL(18,2)) AS amount, CAST(json_extract(props, '$.k') AS INT) AS quantity, ts
        FROM events""",
    "happened": "SELECT * FROM sent WHERE event_type IS NOT NULL AND amount > 0",
    "moves": """
        SELECT user_id, CAST(value AS DECIMAL(18,2)) AS balance, event_type AS status,
               CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
               event_id, ts AS updated_at
        FROM events""",
}
_NEEDS = {"placed": ["heads"], "lines": ["heads"], "rich": ["placed", "paid", "people"], "happened": ["sent"]}


def _closure(names: list[str]) -> list[str]:
    found: list[str] = []
    for name in names:
        for each in [*_closure(_NEEDS.get(name, [])), name]:
            if each not in found:
                found.append(each)
    return found


def query(views: str, body: str, **extra: str) -> str:
    """``body`` behind a WITH clause of the named views and of ``extra`` ones."""
    parts = [f"{name} AS ({_VIEWS[name]})" for name in _closure(views.split())]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)}\n{body}" if parts else body


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def big(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def total(column: str) -> str:
    return f"CAST(SUM({column}) AS {MONEY})"


def _cents(value: str) -> str:
    return f"CAST(CAST({value} AS {MONEY}) * 100 AS HUGEINT)"


def mean_money(amount: str, count: str) -> str:
    """Average of amounts that are not negative, half-up to cents."""
    return f"CASE WHEN {count} <> 0 THEN {dbl(f'({_cents(amount)} * 2 + {count}) // (2 * {count})')} / 100.0 END"


def percent(part: str, whole: str) -> str:
    """Percentage of whole numbers, half-up to two places."""
    top = f"(CAST({part} AS HUGEINT) * 20000 + ({whole})) // (2 * ({whole}))"
    return f"CASE WHEN ({whole}) <> 0 THEN {dbl(top)} / 100.0 END"


def percent_money(part: str, whole: str) -> str:
    return percent(_cents(part), _cents(whole))


def ratio(part: str, whole: str, places: int) -> str:
    scale = 10**places
    top = f"(CAST({part} AS HUGEINT) * {2 * scale} + ({whole})) // (2 * ({whole}))"
    return f"CASE WHEN ({whole}) <> 0 THEN {dbl(top)} / {float(scale)} END"

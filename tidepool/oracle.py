"""DuckDB SQL oracle for every registered query.

Each model is restated once as plain SQL over the fixture bindings;
``compose`` prepends the CTEs a statement needs, in dependency order. The
statements are the correctness reference the Spark plans are checked
against, so they get their results by other means: the latest contact by an
anti-join, aggregates from filtered sets looked up per key, flags by
membership, facts read from the feeds instead of from other models.
"""

from __future__ import annotations

import re

from tidepool.plans.models import FIXTURE_AS_OF
from tidepool.sources.bindings import BINDINGS


def _dk(ts: str) -> str:
    return f"CAST(strftime(CAST({ts} AS DATE), '%Y%m%d') AS INTEGER)"


MODEL_SQL: dict[str, str] = {
    "calendar_bounds": """
SELECT make_date(CAST(year(min(d)) AS INTEGER), 1, 1) AS first_day,
       make_date(CAST(year(max(d)) AS INTEGER), 12, 31) AS last_day
FROM (SELECT CAST(created_at AS DATE) AS d FROM transactions
      UNION ALL SELECT CAST(created_at AS DATE) FROM completed_items
      UNION ALL SELECT CAST(scheduled_date AS DATE) FROM booking_logs) x""",
    "dim_date": f"""
SELECT {_dk('d')} AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS "year",
       CAST(month(d) AS INTEGER) AS "month", strftime(d, '%b') AS month_name, CAST(day(d) AS INTEGER) AS "day",
       strftime(d, '%a') AS day_of_week, CAST(quarter(d) AS INTEGER) AS quarter
FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS d
      FROM calendar_bounds) s""",
    "customer_contacts": """
SELECT customer_phone, customer_name, email, created_at FROM booking_groups
UNION ALL
SELECT customer_phone, customer_name, CAST(NULL AS VARCHAR) AS email, created_at FROM transactions""",
    "latest_customers": """
WITH ranked AS (   -- one sort key per contact: a missing time is the latest, then the smallest e-mail and name
    SELECT DISTINCT customer_phone, customer_name, email,
           created_at IS NULL AS undated, created_at, email IS NULL AS no_mail, customer_name IS NULL AS no_name
    FROM customer_contacts WHERE customer_phone IS NOT NULL)
SELECT DISTINCT customer_phone, customer_name, email
FROM ranked AS own
WHERE NOT EXISTS (
    SELECT 1 FROM ranked AS other
    WHERE other.customer_phone = own.customer_phone
      AND (other.undated > own.undated
           OR (other.undated = own.undated AND (other.created_at > own.created_at
               OR (other.created_at IS NOT DISTINCT FROM own.created_at
                   AND (other.no_mail < own.no_mail
                        OR (other.no_mail = own.no_mail AND (other.email < own.email
                            OR (other.email IS NOT DISTINCT FROM own.email
                                AND (other.no_name < own.no_name
                                     OR (other.no_name = own.no_name AND other.customer_name < own.customer_name)))))))))))""",
    "dim_customer": """
SELECT md5(person.customer_phone) AS customer_key, person.customer_phone, person.customer_name, person.email,
       person.customer_phone IN (SELECT phone FROM members WHERE phone IS NOT NULL) AS is_member,
       card.joined_date AS member_joined_date, card.total_visits
FROM latest_customers person
LEFT JOIN (SELECT phone, joined_date, total_visits FROM members) card ON card.phone = person.customer_phone""",
    "dim_product": """
SELECT md5(id) AS product_key, id AS product_id, name AS product_name, category, price FROM spa_products""",
    "dim_treatment": """
SELECT md5(id) AS treatment_key, id AS treatment_id, name AS treatment_name, category, price, duration, is_active
FROM treatments""",
    "fact_transactions": f"""
SELECT md5(id) AS transaction_key, id AS transaction_id, md5(customer_phone) AS customer_key,
       {_dk('created_at')} AS date_key, total_price + discount_amount AS gross_amount, discount_amount,
       total_price AS net_amount, source, created_at AS transaction_timestamp
FROM transactions""",
    "fact_completed_items": f"""
SELECT md5(id) AS completed_item_key, md5(transaction_id) AS transaction_key, md5(item_id) AS item_key,
       {_dk('created_at')} AS date_key, price, item_name, booking_log_id, created_at AS completed_timestamp
FROM completed_items""",
    "fact_treatment_activities": f"""
SELECT md5(bl.id) AS activity_key, bl.id AS booking_id, md5(bg.customer_phone) AS customer_key,
       md5(bl.treatment_id) AS treatment_key, {_dk('bl.scheduled_date')} AS scheduled_date_key,
       bl.price, bl.guest_name, bl.status, bl.scheduled_date
FROM booking_logs bl LEFT JOIN booking_groups bg ON bl.group_id = bg.id
WHERE bl.item_type = 'treatment'""",
    "mart_revenue_daily": """
SELECT f.date_key, d.full_date AS transaction_date, f.source, CAST(count(*) AS BIGINT) AS transaction_count,
       CAST(sum(f.gross_amount) AS BIGINT) AS gross_revenue, CAST(sum(f.discount_amount) AS BIGINT) AS total_discount,
       CAST(sum(f.net_amount) AS BIGINT) AS net_revenue,
       CAST(sum(f.net_amount) AS BIGINT) / NULLIF(count(*), 0) AS avg_order_value
FROM fact_transactions f LEFT JOIN dim_date d ON f.date_key = d.date_key
GROUP BY f.date_key, d.full_date, f.source""",
    "customer_agg": """
WITH keyed AS (SELECT md5(customer_phone) AS k, total_price AS paid, discount_amount AS off, created_at AS moment FROM transactions),
keys AS (SELECT DISTINCT k FROM keyed),
tally AS (SELECT k, count(*) AS n, sum(paid) AS paid, min(moment) AS earliest, max(moment) AS latest FROM keyed GROUP BY k),
discounted AS (SELECT k, sum(off) AS off, sum(paid + off) AS full_price FROM keyed WHERE off IS NOT NULL GROUP BY k)
SELECT keys.k AS customer_key, CAST(tally.n AS BIGINT) AS transaction_count, CAST(discounted.full_price AS BIGINT) AS total_gross,
       CAST(discounted.off AS BIGINT) AS total_discount, CAST(tally.paid AS BIGINT) AS total_net,
       tally.earliest AS first_transaction_at, tally.latest AS last_transaction_at
FROM keys JOIN tally ON tally.k IS NOT DISTINCT FROM keys.k
LEFT JOIN discounted ON discounted.k IS NOT DISTINCT FROM keys.k""",
    "mart_customer_analytics": f"""
WITH spending AS (SELECT * FROM customer_agg WHERE customer_key IS NOT NULL),
buyers AS (
    SELECT who.*, s.transaction_count, s.total_gross, s.total_discount, s.total_net,
           CAST(s.total_net AS DOUBLE) / s.transaction_count AS avg_transaction_value,
           s.first_transaction_at, s.last_transaction_at,
           date_diff('day', CAST(s.last_transaction_at AS DATE), DATE '{FIXTURE_AS_OF}') AS days_since_last_transaction
    FROM dim_customer who JOIN spending s USING (customer_key)),
others AS (SELECT * FROM dim_customer WHERE customer_key NOT IN (SELECT customer_key FROM spending))
SELECT customer_key, customer_phone, customer_name, email, is_member, member_joined_date, total_visits,
       transaction_count, ifnull(total_gross, 0) AS total_gross, ifnull(total_discount, 0) AS total_discount,
       ifnull(total_net, 0) AS total_net, avg_transaction_value, first_transaction_at, last_transaction_at,
       CAST(days_since_last_transaction AS INTEGER) AS days_since_last_transaction
FROM buyers
UNION ALL
SELECT customer_key, customer_phone, customer_name, email, is_member, member_joined_date, total_visits,
       0, 0, 0, 0, NULL, NULL, NULL, NULL
FROM others""",
    "mart_operations_booking": f"""
WITH pages AS (SELECT id AS page_id, ifnull(source_page, 'unknown') AS page FROM booking_logs),
treated AS (
    SELECT {_dk('b.scheduled_date')} AS day_key, p.page, b.status, b.price
    FROM pages p JOIN booking_logs b ON b.id = p.page_id
    WHERE b.item_type = 'treatment'),
counted AS (SELECT day_key, page, status, count(*) AS n, sum(price) AS revenue FROM treated GROUP BY ALL)
SELECT day_key AS scheduled_date_key, (SELECT full_date FROM dim_date WHERE date_key = counted.day_key) AS scheduled_date,
       page AS source_page, status, CAST(n AS BIGINT) AS booking_count, CAST(revenue AS BIGINT) AS booking_revenue
FROM counted""",
    "item_sales": """
SELECT item_key AS product_key, CAST(count(*) AS BIGINT) AS units_sold, CAST(sum(price) AS BIGINT) AS item_revenue
FROM fact_completed_items WHERE item_key IS NOT NULL GROUP BY item_key""",
    "mart_product_analytics": """
SELECT p.product_key, p.product_id, p.product_name, p.category, p.price,
       COALESCE(s.units_sold, 0) AS units_sold, COALESCE(s.item_revenue, 0) AS item_revenue
FROM dim_product p LEFT JOIN item_sales s ON p.product_key = s.product_key""",
    "treatment_agg": """
WITH bookings AS (SELECT md5(treatment_id) AS k, status, price FROM booking_logs WHERE item_type = 'treatment'),
shares AS (
    SELECT k, status, count(*) AS n, sum(price) AS revenue FROM bookings GROUP BY k, status)
SELECT k AS treatment_key, CAST(sum(n) AS BIGINT) AS total_bookings,
       CAST(ifnull(sum(n) FILTER (status = 'completed'), 0) AS BIGINT) AS completed_bookings,
       CAST(ifnull(sum(n) FILTER (status = 'cancelled'), 0) AS BIGINT) AS cancelled_bookings,
       CAST(ifnull(sum(n) FILTER (status = 'booked'), 0) AS BIGINT) AS booked_bookings,
       CAST(ifnull(sum(n) FILTER (status = 'no_show'), 0) AS BIGINT) AS no_show_bookings,
       CAST(sum(revenue) AS BIGINT) AS booking_revenue,
       CAST(CASE WHEN count(*) FILTER (status = 'completed') = 0 THEN 0
                 WHEN count(*) = count(*) FILTER (status = 'completed') THEN sum(revenue)
                 ELSE ifnull(sum(revenue) FILTER (status = 'completed'), 0) END AS BIGINT) AS completed_revenue
FROM shares GROUP BY k""",
    "mart_treatment_analytics": """
WITH known AS (SELECT * FROM treatment_agg WHERE treatment_key IS NOT NULL),
offered AS (SELECT treatment_key, treatment_id, treatment_name, category, price AS list_price, duration, is_active FROM dim_treatment)
SELECT offered.*, total_bookings, completed_bookings, cancelled_bookings, booked_bookings, no_show_bookings,
       ifnull(booking_revenue, 0) AS booking_revenue, ifnull(completed_revenue, 0) AS completed_revenue,
       CAST(cancelled_bookings AS DOUBLE) / total_bookings AS cancellation_rate
FROM offered JOIN known USING (treatment_key)
UNION ALL
SELECT offered.*, 0, 0, 0, 0, 0, 0, 0, NULL
FROM offered WHERE treatment_key NOT IN (SELECT treatment_key FROM known)""",
}

_NAMES = list(BINDINGS) + list(MODEL_SQL)


def _deps(body: str) -> list[str]:
    words = set(re.findall(r"\b[a-z_]+\b", body))
    return [n for n in _NAMES if n in words]


def _body(name: str) -> str:
    return BINDINGS[name].sql() if name in BINDINGS else MODEL_SQL[name].strip()


def compose(final: str, extra: dict[str, str] | None = None) -> str:
    """``WITH <every CTE the statement needs> <final>``; ``extra`` adds ad-hoc CTEs."""
    extra = extra or {}
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        body = extra.get(name) or _body(name)
        for dep in _deps(body):
            if dep != name and (dep in extra or dep in _NAMES):
                visit(dep)
        for dep in [d for d in extra if re.search(rf"\b{d}\b", body) and d != name]:
            visit(dep)
        order.append(name)

    roots = [n for n in _NAMES if re.search(rf"\b{n}\b", final)] + \
            [n for n in extra if re.search(rf"\b{n}\b", final)]
    for r in roots:
        visit(r)
    ctes = ",\n".join(f"{n} AS (\n{(extra.get(n) or _body(n)).strip()}\n)" for n in order)
    return (f"WITH {ctes}\n{final.strip()}" if ctes else final.strip())


def model(name: str) -> str:
    return compose(f"SELECT * FROM {name}")


# ---------------------------------------------------------------------------
# Quality gate and constraint suite, restated in SQL.
# ---------------------------------------------------------------------------

def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _pyl(values) -> str:
    return str(list(values))


def gate_sql(view: str, table: str, rules: dict, present: list[str], source: str | None = None,
             tag: str = "g") -> tuple[dict[str, str], str]:
    """(extra CTEs, SELECT of check rows) for one table; ``source`` is a table/view to count."""
    present_set = set(present)
    not_null = [c for c in rules.get("not_null", []) or [] if c in present_set]
    unique = list(rules.get("unique", []) or [])
    checks = list(rules.get("checks", []) or [])
    aggs = ["CAST(count(*) AS BIGINT) AS n_rows"]
    aggs.append(f"(SELECT CAST(count(*) AS BIGINT) FROM {source}) AS n_source" if source
                else "CAST(count(*) AS BIGINT) AS n_source")
    if unique:
        keys = ", ".join(unique)
        aggs.append(f"(SELECT CAST(count(*) AS BIGINT) FROM (SELECT {keys} FROM {view} GROUP BY {keys} "
                    f"HAVING count(*) > 1) d) AS dup_groups")
    for i, c in enumerate(not_null):
        aggs.append(f"CAST(count_if({c} IS NULL) AS BIGINT) AS nn{i}")
    for j, r in enumerate(checks):
        c = r.get("column")
        if c not in present_set:
            continue
        if r.get("type") == "min_value":
            aggs.append(f"CAST(count_if({c} IS NOT NULL AND {c} < {_lit(r['min'])}) AS BIGINT) AS r{j}")
        elif r.get("type") == "accepted_values":
            vals = ", ".join(_lit(v) for v in r["values"])
            aggs.append(f"CAST(count_if({c} IS NOT NULL AND {c} NOT IN ({vals})) AS BIGINT) AS r{j}")
    mname = f"{tag}_metrics"
    extra = {mname: f"SELECT {', '.join(aggs)} FROM {view}"}

    rows = []

    def row(name, status, detail, bad):
        rows.append(f"SELECT {_lit(table)} AS table_name, CAST({len(rows) + 1} AS INTEGER) AS check_order, "
                    f"{_lit(name)} AS check_name, {status} AS status, {detail} AS detail, "
                    f"CAST({bad} AS BIGINT) AS bad_rows FROM {mname}")

    expected = list(rules.get("columns", []) or [])
    miss, unexp = sorted(set(expected) - present_set), sorted(present_set - set(expected))
    if miss or unexp:
        row("columns", "'FAIL'", _lit(f"missing={miss} unexpected={unexp}"), "NULL")
    else:
        row("columns", "'PASS'", _lit(f"{len(expected)} columns match"), "NULL")
    row("row_count", "CASE WHEN n_source = n_rows THEN 'PASS' ELSE 'FAIL' END",
        "CASE WHEN n_source = n_rows THEN CAST(n_rows AS VARCHAR) || ' rows match' "
        "ELSE 'source=' || CAST(n_source AS VARCHAR) || ' extracted=' || CAST(n_rows AS VARCHAR) END",
        "abs(n_source - n_rows)")
    if rules.get("not_null"):
        total = " + ".join(f"nn{i}" for i in range(len(not_null))) or "0"
        names = ", ".join(f"CASE WHEN nn{i} > 0 THEN {_lit(repr(c))} END" for i, c in enumerate(not_null))
        listing = f"concat_ws(', ', {names})" if not_null else "''"
        row("not_null", f"CASE WHEN ({total}) > 0 THEN 'FAIL' ELSE 'PASS' END",
            f"CASE WHEN ({total}) > 0 THEN 'nulls found in [' || {listing} || ']' "
            f"ELSE 'no nulls in required columns' END", f"({total})")
    if unique:
        row("unique", "CASE WHEN dup_groups > 0 THEN 'FAIL' ELSE 'PASS' END",
            f"CASE WHEN dup_groups > 0 THEN {_lit('duplicates in ' + _pyl(unique))} "
            f"ELSE {_lit(_pyl(unique) + ' unique')} END", "dup_groups")
    for j, r in enumerate(checks):
        t, c = r.get("type"), r.get("column")
        if t in ("min_value", "accepted_values"):
            name = f"{t}.{c}"
            if c not in present_set:
                row(name, "'FAIL'", _lit(f"column {c} missing"), "NULL")
            elif t == "min_value":
                row(name, f"CASE WHEN r{j} > 0 THEN 'FAIL' ELSE 'PASS' END",
                    f"CASE WHEN r{j} > 0 THEN CAST(r{j} AS VARCHAR) || {_lit(' rows < ' + str(r['min']))} "
                    f"ELSE {_lit('all >= ' + str(r['min']))} END", f"r{j}")
            else:
                row(name, f"CASE WHEN r{j} > 0 THEN 'FAIL' ELSE 'PASS' END",
                    f"CASE WHEN r{j} > 0 THEN CAST(r{j} AS VARCHAR) || {_lit(' rows outside ' + _pyl(r['values']))} "
                    f"ELSE 'all values accepted' END", f"r{j}")
        else:
            row(f"unknown_check.{t}", "'FAIL'", "'unknown rule type'", "NULL")
    return extra, "\nUNION ALL\n".join(rows)


def suite_sql(specs) -> str:
    """SELECT of suite rows (model, column_name, test, failing_rows, status) for ``specs``."""
    parts = []
    for _layer, model, column, test, values in specs:
        head = f"SELECT {_lit(model)} AS model, {_lit(column)} AS column_name, {_lit(test)} AS test, "
        if test == "not_null":
            parts.append(head + f"CAST(count_if({column} IS NULL) AS BIGINT) AS failing_rows FROM {model}")
        elif test == "unique":
            parts.append(head + f"CAST(count(*) AS BIGINT) AS failing_rows FROM "
                                f"(SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
                                f"GROUP BY {column} HAVING count(*) > 1) d")
        else:
            vals = ", ".join(_lit(v) for v in values)
            parts.append(head + f"CAST(count_if({column} IS NOT NULL AND {column} NOT IN ({vals})) AS BIGINT) "
                                f"AS failing_rows FROM {model}")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT *, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (\n{body}\n) s"

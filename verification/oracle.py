"""SQL over the given tables that must give the rows of the registered queries.

The statements restate each rule in DuckDB's own terms. Only fixed values (lists, spellings,
texts) are shared with the package.
"""

from __future__ import annotations

import datetime as dt

from cartloom import bindings as B
from cartloom import domains as D
from cartloom.functions.text import WHITE_SPACE, WORD_BREAKS
from cartloom.operators.assertions import MART_CONDITIONS, MART_NOT_NULL
from cartloom.schemas import RAW_COLUMNS, REJECTED_COLUMNS, SOURCE_COLUMNS

AS_OF = f"DATE '{B.AS_OF}'"
YESTERDAY = B.AS_OF - dt.timedelta(days=1)
OLDER = B.AS_OF - dt.timedelta(days=2)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(texts: list[str]) -> str:
    return ", ".join(lit(t) for t in texts)


def pick(values: list[str], index: str) -> str:
    return f"([{lits(values)}])[CAST({index} AS INTEGER) + 1]"


def trim(c: str) -> str:
    return f"trim({c}, {lit(WHITE_SPACE)})"


def blank(c: str) -> str:
    return f"({c} IS NULL OR {trim(c)} = '')"


def title(c: str) -> str:
    breaks = "[" + "".join("\\" + x for x in WORD_BREAKS) + r"\s]"
    words = f"string_split(regexp_replace(lower({c}), '({breaks})', '\\1' || chr(1), 'g'), chr(1))"
    return f"array_to_string(list_transform({words}, lambda w: upper(w[1]) || substr(w, 2)), '')"


def integer(c: str) -> str:
    return rf"CASE WHEN regexp_full_match({c}, '\s*[+-]?\d+\s*') THEN TRY_CAST({c} AS BIGINT) END"


def amount(c: str) -> str:
    return f"TRY_CAST({c} AS DECIMAL(19,9))"


def day(c: str) -> str:
    return rf"CASE WHEN regexp_full_match({c}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN TRY_CAST({c} AS DATE) END"


def stamp(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def date_text(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d')"


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Exact half-up rounding of a share of counts, in integers."""
    unit = 10 ** digits
    return f"(CASE WHEN {whole} <> 0 THEN ((2 * {unit * 100} * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole})) / {unit}.0 END)"


def ratio(part: str, whole: str) -> str:
    """Two-decimal percentage of two amounts from their nine-decimal quotient, in integers."""
    p, w = (f"CAST({x} * 1000000000 AS HUGEINT)" for x in (part, whole))
    quotient = f"((2 * 1000000000 * {p} + {w}) // (2 * {w}))"
    return f"(CASE WHEN {whole} <> 0 THEN CAST(({quotient} * 100 + 5000000) // 10000000 AS DOUBLE) / 100 END)"


def first_match(rules: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {lit(name)}" for test, name in rules) + f" ELSE {otherwise} END"


def product(c: str) -> str:
    squeeze = f"regexp_replace({c}, '[\\s\\-]+', '', 'g')"
    key = f"lower({trim(squeeze)})"
    rules = [(f"regexp_matches({key}, {lit('|'.join(parts))})", name) for name, parts in D.PRODUCT_RULES]
    return first_match(rules, title(trim(rf"regexp_replace({c}, '\s+', ' ', 'g')")))


def by_pattern(c: str, patterns: list[tuple[str, str]]) -> str:
    return first_match([(f"regexp_matches(lower({trim(c)}), {lit(p)})", n) for n, p in patterns], title(trim(c)))


def status(c: str) -> str:
    return first_match([(f"lower({trim(c)}) IN ({lits(words)})", n) for n, words in D.STATUS_SYNONYMS], title(trim(c)))


def raw_cte() -> str:
    customer = "CAST(l_orderkey - l_orderkey % 3 AS VARCHAR)"
    product_no = "(l_partkey % 25)"
    plain = pick(B.PRODUCTS, product_no)
    state = pick(D.STATES, "l_orderkey % 50")
    ident = "('ORD-' || l_orderkey || '-' || l_linenumber)"
    flat_categories = [v for values in B.CATEGORIES for v in values]
    flat_stores = [v for values in B.STORES for v in values]

    def load(today: str, late: str, before: str) -> str:
        return f"CASE WHEN l_partkey % 4 = 3 THEN {before} WHEN l_partkey % 5 = 0 THEN {late} ELSE {today} END"

    return f"""
line AS (
  SELECT *, l_orderkey * 7 + l_linenumber * 13 + l_partkey AS k,
    CAST(l_quantity AS INTEGER) AS units,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)), 2) AS DECIMAL(12,2)) AS price
  FROM lineitem
),
priced AS (
  SELECT *, CAST(round(units * price * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(14,2)) AS discount,
    CAST(units * price - CAST(round(units * price * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(14,2)) AS DECIMAL(14,2)) AS exact,
    UNNEST(CASE WHEN k % 83 = 0 THEN [1, 2] ELSE [1] END) AS copy
  FROM line
),
raw AS (
  SELECT
    CASE WHEN k % 211 = 0 THEN '' WHEN k % 227 = 0 THEN ' ' || {ident} ELSE {ident} END AS order_id,
    CASE WHEN k % 97 = 0 THEN '' WHEN k % 193 = 0 THEN '2999-01-01' WHEN k % 389 = 0 THEN 'not-a-date'
      WHEN k % 401 = 0 THEN '2001-3-7' WHEN k % 409 = 0 THEN '2001' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS order_date,
    'C' || {customer} || CASE WHEN k % 5 = 0 THEN ' ' ELSE '' END AS customer_id,
    CASE WHEN k % 37 = 0 THEN '' WHEN k % 3 = 0 THEN '  mary-ann SMITH ' || {customer} ELSE 'Customer ' || {customer} END AS customer_name,
    CASE WHEN k % 29 = 0 THEN '' WHEN k % 31 = 0 THEN 'user' || {customer}
      ELSE 'User' || {customer} || '@Shop.example ' END AS customer_email,
    {pick(B.CITIES, f"l_orderkey % {len(B.CITIES)}")} AS customer_city,
    CASE WHEN k % 103 = 0 THEN ' ' WHEN k % 101 = 0 THEN 'ZZ' WHEN k % 7 = 0 THEN lower({state}) ELSE {state} END AS customer_state,
    CASE WHEN k % 149 = 0 THEN {pick(B.STRANGERS, f"l_partkey % {len(B.STRANGERS)}")}
      WHEN k % 7 = 3 THEN {pick(B.TYPOS, product_no)} WHEN k % 5 = 1 THEN lower({plain}) WHEN k % 5 = 2 THEN upper({plain})
      WHEN k % 5 = 3 THEN replace({plain}, ' ', '-') WHEN k % 5 = 4 THEN ' ' || replace({plain}, ' ', '  ')
      ELSE {plain} END AS product_name,
    CASE WHEN k % 151 = 0 THEN 'misc-items'
      ELSE {pick(flat_categories, f"(({product_no} - {product_no} % 5) // 5) * 3 + k % 3")} END AS product_category,
    CASE WHEN k % 53 = 0 THEN CAST(-units AS VARCHAR) WHEN k % 59 = 0 THEN '0' WHEN k % 61 = 0 THEN 'abc'
      WHEN k % 67 = 0 THEN '2.5' WHEN k % 71 = 0 THEN ' ' || units ELSE CAST(units AS VARCHAR) END AS quantity,
    CASE WHEN k % 173 = 0 THEN '' WHEN k % 179 = 0 THEN 'free' ELSE CAST(price AS VARCHAR) END AS unit_price,
    CASE WHEN k % 41 = 0 THEN '' ELSE CAST(discount AS VARCHAR) END AS discount_amount,
    CASE WHEN k % 73 = 0 THEN '' WHEN k % 79 = 0 THEN CAST(-exact AS VARCHAR) WHEN k % 89 = 0 THEN 'n/a'
      WHEN k % 43 = 0 THEN CAST(CAST(exact + 1 AS DECIMAL(14,2)) AS VARCHAR)
      WHEN k % 47 = 0 THEN CAST(CAST(exact + 0.02 AS DECIMAL(14,2)) AS VARCHAR) ELSE CAST(exact AS VARCHAR) END AS revenue,
    CASE WHEN k % 307 = 0 THEN 'pop-up STAND' ELSE {pick(flat_stores, "(l_suppkey % 5) * 4 + k % 4")} END AS store_name,
    CASE WHEN k % 23 = 0 THEN '' ELSE {pick(B.METHODS, f"k % {len(B.METHODS)}")} END AS shipping_method,
    {pick(B.STATUSES, f"(k + ascii(l_returnflag) + ascii(l_linestatus)) % {len(B.STATUSES)}")} AS shipping_status,
    CASE WHEN k % 19 = 0 THEN '' ELSE {pick(B.PAYMENTS, f"k % {len(B.PAYMENTS)}")} END AS payment_method,
    {load(f"TIMESTAMP '{B.AS_OF} 06:30:00'", f"TIMESTAMP '{B.AS_OF} 18:45:00'", f"TIMESTAMP '{YESTERDAY} 06:30:00'")} AS _ingested_at,
    {load(*(lit(B.export_name(d)) for d in (B.AS_OF, OLDER, YESTERDAY)))} AS _source_filename,
    {load(*(f"DATE '{d}'" for d in (B.AS_OF, OLDER, YESTERDAY)))} AS _pipeline_run_date,
    {load(*(lit(d.isoformat()) for d in (B.AS_OF, OLDER, YESTERDAY)))} AS _email_received_date
  FROM priced
)"""


def raw_shown(alias: str = "") -> str:
    dot = f"{alias}." if alias else ""
    shown = {"_ingested_at": stamp, "_pipeline_run_date": date_text}
    return ", ".join(f"{shown[c](dot + c)} AS {c}" if c in shown else f"{dot}{c}" for c in RAW_COLUMNS)


def batch_cte(name: str = "batch", date: str = AS_OF, source: str = "raw") -> str:
    return f"{name} AS (SELECT * FROM {source} WHERE CAST(_ingested_at AS DATE) = {date})"


def dedup_cte(name: str = "latest", source: str = "batch") -> str:
    rest = [c for c in RAW_COLUMNS if c not in ("_ingested_at", "_source_filename")]
    order = "_ingested_at DESC NULLS LAST, _source_filename DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS LAST" for c in rest)
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY {order}) AS rn
    FROM (SELECT DISTINCT * FROM {source}) WHERE NOT {blank('order_id')}
  ) WHERE rn = 1
)"""


def typed_cte(name: str = "typed", source: str = "latest") -> str:
    return f"""{name}_parsed AS (
  SELECT *, abs({integer('quantity')}) AS q, {amount('unit_price')} AS p,
    coalesce({amount('discount_amount')}, 0) AS d, {amount('revenue')} AS stated
  FROM {source}
),
{name}_expected AS (
  SELECT *, CAST(q AS DECIMAL(16,0)) * p - CAST(d AS DECIMAL(19,9)) AS expected FROM {name}_parsed
),
{name} AS (
  SELECT {trim('order_id')} AS order_id, {day('order_date')} AS order_date, {trim('customer_id')} AS customer_id,
    nullif({title(trim('customer_name'))}, '') AS customer_name, nullif(lower({trim('customer_email')}), '') AS customer_email,
    nullif({title(trim('customer_city'))}, '') AS customer_city, nullif(upper({trim('customer_state')}), '') AS customer_state,
    {by_pattern('store_name', D.STORE_RULES)} AS store_name, {product('product_name')} AS product_name,
    {by_pattern('product_category', D.CATEGORY_RULES)} AS product_category, q AS quantity, p AS unit_price, d AS discount_amount,
    CASE WHEN abs(stated - expected) <= 0.02 THEN round(stated, 2) ELSE round(expected, 2) END AS revenue,
    abs(stated - expected) > 0.02 AS _revenue_was_corrected,
    nullif({title(trim('shipping_method'))}, '') AS shipping_method, {status('shipping_status')} AS shipping_status,
    nullif({title(trim('payment_method'))}, '') AS payment_method,
    _ingested_at, _source_filename, _pipeline_run_date, _email_received_date
  FROM {name}_expected
)"""


def cleaned_cte(name: str = "cleaned", source: str = "typed", date: str = AS_OF) -> str:
    return f"""{name} AS (
  SELECT * FROM {source}
  WHERE order_date <= {date} AND quantity > 0 AND unit_price > 0 AND revenue > 0 AND customer_state IN ({lits(D.STATES)})
)"""


CLEAN_CHAIN = ",".join([batch_cte(), dedup_cte(), typed_cte(), cleaned_cte()])

CLEANED_SHOWN = f"""order_id, {date_text('order_date')} AS order_date, customer_id, customer_name, customer_email, customer_city,
  customer_state, store_name, product_name, product_category, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
  CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(revenue AS DOUBLE) AS revenue, _revenue_was_corrected,
  shipping_method, shipping_status, payment_method, {stamp('_ingested_at')} AS _ingested_at, _source_filename,
  {date_text('_pipeline_run_date')} AS _pipeline_run_date, _email_received_date"""


def mart_cte(name: str = "mart", source: str = "cleaned", updated: str = AS_OF) -> str:
    return f"""{name} AS (
  SELECT order_date, store_name, product_category, product_name, shipping_status,
    count(DISTINCT order_id) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
    count(DISTINCT customer_id) AS unique_customers, round(sum(revenue), 2) AS total_revenue,
    round(sum(discount_amount), 2) AS total_discounts_given,
    {ratio('sum(discount_amount)', 'sum(revenue)')} AS discount_rate_pct,
    CAST(year(order_date) AS BIGINT) AS order_year, CAST(month(order_date) AS BIGINT) AS order_month,
    strftime(order_date, '%Y-%m') AS order_year_month, strftime(order_date, '%A') AS order_day_of_week,
    {updated} AS _last_updated
  FROM {source} GROUP BY ALL
)"""


MART_SHOWN = f"""{date_text('order_date')} AS order_date, store_name, product_category, product_name, shipping_status,
  total_orders, total_units_sold, unique_customers, CAST(total_revenue AS DOUBLE) AS total_revenue,
  CAST(total_discounts_given AS DOUBLE) AS total_discounts_given, discount_rate_pct, order_year, order_month,
  order_year_month, order_day_of_week, {date_text('_last_updated')} AS _last_updated"""

MART_CHAIN = f"{CLEAN_CHAIN},{mart_cte()}"


def rejected_cte() -> str:
    q, p, r = integer("quantity"), amount("unit_price"), amount("revenue")
    state = f"upper({trim('customer_state')})"
    reasons = [
        (blank("order_id"), "'Missing order_id'"),
        (blank("order_date"), "'Missing order_date'"),
        (f"({day('order_date')}) > {AS_OF}", "'Future order_date (' || order_date || ')'"),
        (f"({q}) IS NULL OR ({q}) <= 0", "'Invalid quantity (' || coalesce(quantity, 'NULL') || ')'"),
        (f"{p} IS NULL OR {p} <= 0", "'Invalid unit_price (' || coalesce(unit_price, 'NULL') || ')'"),
        (blank("revenue"), "'Missing revenue'"),
        (f"{r} <= 0", "'Non-positive revenue (' || revenue || ')'"),
        (blank("customer_state"), "'Missing customer_state'"),
        (f"NOT {blank('customer_state')} AND {state} NOT IN ({lits(D.STATES)})", "'Invalid state (' || customer_state || ')'"),
    ]
    pieces = " || ".join(f"CASE WHEN {test} THEN '| ' || {text} || ' ' ELSE '' END" for test, text in reasons)
    return f"""rejected AS (
  SELECT {', '.join(REJECTED_COLUMNS)}, trim({pieces}, '| ') AS rejection_reason,
    TIMESTAMP '{B.REJECTED_AT:%Y-%m-%d %H:%M:%S}' AS _rejected_at
  FROM (SELECT DISTINCT * FROM batch) WHERE {' OR '.join(f'coalesce({test}, false)' for test, _ in reasons)}
)"""


def checks_select(source: str, date: dt.date, checked_at: dt.datetime) -> str:
    q, p, r = integer("quantity"), amount("unit_price"), amount("revenue")
    discount = f"coalesce({amount('discount_amount')}, 0)"
    as_of = f"DATE '{date}'"

    def rows(test: str) -> str:
        return f"(SELECT count(*) FROM {source} WHERE {test})"

    failed = {
        "C1": f"CASE WHEN (SELECT count(*) FROM {source}) = 0 THEN CAST(0 AS BIGINT) END",
        "C2": rows(blank("order_id")), "C3": rows(blank("order_date")),
        "C4": rows(f"({day(trim('order_date'))}) > {as_of}"), "C5": rows(blank("revenue")),
        "W1": f"(SELECT count(*) FROM {source}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {source}))",
        "W2": f"(SELECT count(order_id) - count(DISTINCT order_id) FROM {source})",
        "W3": rows(f"({q}) < 0"), "W4": rows(f"({q}) = 0"),
        "W5": rows(f"abs({r} - CAST(({q}) AS DECIMAL(16,0)) * {p} + CAST({discount} AS DECIMAL(19,9))) > 0.02"),
        "W6": rows(f"{r} <= 0.01 OR {r} > 5000"),
        "W7": rows(f"customer_state IS NOT NULL AND {trim('customer_state')} NOT IN ({lits(D.STATES)})"),
        "I1": rows(blank("customer_email")),
        "I2": rows(f"NOT {blank('customer_email')} AND NOT contains(customer_email, '@')"),
        "I3": rows(blank("customer_name")), "I4": rows(blank("shipping_method")), "I5": rows(blank("payment_method")),
        "I6": f"(SELECT count(DISTINCT {trim('lower(store_name)')}) FROM {source})",
    }
    lines = []
    for check, severity, name, about in D.CHECKS:
        verdict = "'INFO'" if severity == "INFO" else (
            "CASE WHEN failed_rows = 0 THEN 'FAIL' ELSE 'PASS' END" if check == "C1"
            else "CASE WHEN failed_rows > 0 THEN 'FAIL' ELSE 'PASS' END")
        lines.append(
            f"SELECT check_id, severity, check_name, description, total_rows, failed_rows, {verdict} AS status, "
            f"'{checked_at:%Y-%m-%d %H:%M:%S}' AS checked_at FROM (SELECT {lit(check)} AS check_id, {lit(severity)} AS severity, "
            f"{lit(name)} AS check_name, {lit(about)} AS description, (SELECT count(*) FROM {source}) AS total_rows, "
            f"{failed[check]} AS failed_rows)")
    return " UNION ALL ".join(lines)


def assertion_rows(source: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT {lit(name)} AS assertion, failed_rows, CASE WHEN failed_rows > 0 THEN 'FAIL' ELSE 'PASS' END AS status "
        f"FROM (SELECT {count} AS failed_rows FROM {source})" for name, count in rules.items())


def messages_cte() -> str:
    date, prefix = "strftime(ts, '%Y-%m-%d')", lit("[E-Com] Daily Sales Export ")
    name = "('e_com_sales_' || strftime(ts, '%Y%m%d') || '.csv')"
    return f"""messages AS (
  SELECT event_id AS seq, CASE event_type WHEN 'purchase' THEN {prefix} || '– ' || {date} WHEN 'view' THEN {prefix} || '- ' || {date}
      WHEN 'click' THEN 'Re: ' || {prefix} || '– ' || {date} WHEN 'signup' THEN upper({prefix}) || {date}
      ELSE 'Weekly digest ' || {date} END AS subject,
    'sales' || user_id || '@shop.example' AS sender, ts AS received_at,
    CASE WHEN event_id % 11 = 0 THEN NULL ELSE {name} END AS filename
  FROM events
),
recent AS (
  SELECT * FROM (SELECT * FROM messages WHERE contains(lower(subject), {lit(D.SUBJECT_FILTER.lower())}))
  WHERE regexp_matches(subject, {lit(D.SUBJECT_PATTERN)})
)"""


SALES = f"shipping_status NOT IN ({lits(D.NON_SALES_STATUSES)})"
TOTALS = """CAST(sum(total_orders) AS BIGINT) AS total_orders, CAST(sum(total_units_sold) AS BIGINT) AS total_units_sold,
  CAST(sum(total_revenue) AS DOUBLE) AS total_revenue, CAST(sum(total_discounts_given) AS DOUBLE) AS total_discounts_given"""


def oracle_statements() -> dict[str, str]:
    raw = raw_cte()

    def over(ctes: str, select: str) -> str:
        return f"WITH {raw}{',' + ctes if ctes else ''}\n{select}"

    def over_mart(select: str) -> str:
        return over(MART_CHAIN, select)

    def mapping(column: str, canonical: str) -> str:
        return over("", f"SELECT {column} AS raw_value, {canonical} AS canonical_value, count(*) AS row_count FROM raw GROUP BY 1, 2")

    def parsed(column: str, value: str) -> str:
        return (f"SELECT {lit(column)} AS column_name, {column} AS raw_value, CAST({value} AS VARCHAR) AS parsed, "
                f"count(*) AS row_count FROM raw GROUP BY 2, 3")

    customer_rules = {
        "customer_id": trim("customer_id"), "customer_name": f"nullif({title(trim('customer_name'))}, '')",
        "customer_email": f"nullif(lower({trim('customer_email')}), '')",
        "customer_city": f"nullif({title(trim('customer_city'))}, '')",
        "customer_state": f"nullif(upper({trim('customer_state')}), '')",
    }
    file_cte = f"file AS (SELECT {', '.join(SOURCE_COLUMNS)} FROM raw WHERE _pipeline_run_date = {AS_OF})"
    empties = " + ".join(f"CAST(coalesce(bool_or({c} = ''), false) AS BIGINT)" for c in SOURCE_COLUMNS)
    day1 = f"DATE '{YESTERDAY}'"
    history_chain = ",".join([
        CLEAN_CHAIN, batch_cte("batch1", day1), dedup_cte("latest1", "batch1"), typed_cte("typed1", "latest1"),
        cleaned_cte("history", "typed1", day1),
    ])
    touched = """touched AS (
      SELECT order_date FROM cleaned UNION SELECT order_date FROM history WHERE order_id IN (SELECT order_id FROM cleaned)),
    merged AS (SELECT * FROM history WHERE order_id NOT IN (SELECT order_id FROM cleaned) UNION ALL SELECT * FROM cleaned)"""
    upserted = f"{history_chain},{touched},{mart_cte('mart', 'merged')}"
    landed_at = f"{B.AS_OF} 06:30:00"

    def landed(email: str) -> str:
        return (f"SELECT {', '.join(SOURCE_COLUMNS)}, '{landed_at}' AS _ingested_at, _source_filename, "
                f"{date_text('_pipeline_run_date')} AS _pipeline_run_date{email} FROM raw")

    # Whole billionths in 128 bit integers, from the keys: no decimal type and no text is involved.
    exact, off = "((q - discounted) * a * ten * 1000000000::HUGEINT + q * f)", "abs(stated - expected) > 20000000"

    def text_of(c: str, digits: int) -> str:
        unit = f"{10 ** digits}::HUGEINT"
        return f"(CASE WHEN {c} < 0 THEN '-' ELSE '' END || abs({c}) // {unit} || '.' || lpad((abs({c}) % {unit})::VARCHAR, {digits}, '0'))"

    cents = "(CASE WHEN {0} < 0 THEN -1 ELSE 1 END * ((abs({0}) + 5000000) // 10000000))"
    large = f"""WITH keys AS (
          SELECT l_orderkey, l_linenumber, l_orderkey * 7 + l_linenumber * 13 + l_partkey AS k, l_quantity::BIGINT::HUGEINT AS q,
                 (l_orderkey * 100 + l_partkey % 97 + 1)::HUGEINT AS a FROM lineitem
        ), parts AS (
          SELECT *, ('1' || repeat('0', (k % 12 + 6)::INT))::HUGEINT AS ten, (k * 7919 % 1000000000)::HUGEINT AS f,
                 (k % 4 = 0)::INT AS discounted FROM keys
        ), priced AS (
          SELECT *, a * ten * 1000000000::HUGEINT + f AS price, {exact} AS expected FROM parts
        ), given AS (
          SELECT *, CASE k % 5 WHEN 0 THEN expected WHEN 1 THEN expected + 20000000 WHEN 2 THEN expected + 20000001
                    WHEN 4 THEN -price END AS stated FROM priced
        ), kept AS (SELECT *, CASE WHEN {off} OR stated IS NULL THEN expected ELSE stated END AS r FROM given)
        SELECT l_orderkey, l_linenumber, q::BIGINT AS quantity, {text_of('price', 9)} AS unit_price,
               {text_of(cents.format('r'), 2)} AS revenue, {off} AS _revenue_was_corrected FROM kept"""

    # Rows are told apart by their text; a winner is cleaned if its typed values are valid.
    def whole(columns: list[str]) -> str:
        return f"CAST(ROW({', '.join(columns)}) AS VARCHAR)"

    valid = f"""({day('order_date')}) <= {AS_OF} AND q > 0 AND p > 0 AND upper({trim('customer_state')}) IN ({lits(D.STATES)})
          AND CASE WHEN abs(stated - expected) <= 0.02 THEN round(stated, 2) ELSE round(expected, 2) END > 0"""
    fates = f"""winner AS (SELECT {whole(RAW_COLUMNS)} AS row_text, coalesce({valid}, false) AS kept FROM typed_expected),
    held AS (SELECT DISTINCT {whole(REJECTED_COLUMNS)} AS held_text FROM rejected),
    different AS (SELECT {whole(RAW_COLUMNS)} AS row_text, {whole(REJECTED_COLUMNS)} AS held_text, count(*) AS copies FROM batch GROUP BY ALL),
    fate AS (
      SELECT copies, coalesce(kept, false) AS kept, held_text IN (SELECT held_text FROM held) AS held, kept IS NOT NULL AS won
      FROM different LEFT JOIN winner USING (row_text)
    )"""
    outcomes = {
        "cleaned": "kept AND NOT held", "both": "kept AND held", "rejected": "held AND NOT kept",
        "superseded": "NOT kept AND NOT held AND NOT won", "dropped": "NOT kept AND NOT held AND won",
        "unexplained_cleaned": "false", "unexplained_rejected": "false",
    }
    fate_rows = " UNION ALL ".join(
        [f"SELECT '{o}' AS outcome, count(*) FILTER ({test}) AS rows FROM fate" for o, test in outcomes.items()]
        + ["SELECT 'copy', CAST(coalesce(sum(copies - 1), 0) AS BIGINT) FROM fate"])

    statements = {
        "large_amounts": large,
        "customer_totals": over(CLEAN_CHAIN, " UNION ALL ".join(
            f"""SELECT concat_ws('/', {', '.join(keys.values())}) AS of, '{' and '.join(keys)}' AS by,
              count(DISTINCT customer_id) AS customers, true AS within_stated_error FROM cleaned GROUP BY {', '.join(keys.values())}"""
            for keys in (
                {"store_name": "store_name", "order_year": "year(order_date)", "order_month": "month(order_date)"},
                {"store_name": "store_name"}, {"product_category": "product_category"},
            ))),
        "stage_reconcile": over(",".join([CLEAN_CHAIN, rejected_cte(), fates]), fate_rows),
        "raw_orders": over("", f"SELECT {raw_shown()} FROM raw"),
        "current_batch": over(batch_cte(), f"SELECT {raw_shown()} FROM batch"),
        "latest_run": over("", f"SELECT {raw_shown()} FROM raw WHERE _pipeline_run_date = (SELECT max(_pipeline_run_date) FROM raw)"),
        "exact_distinct": over(batch_cte(), f"SELECT DISTINCT {raw_shown()} FROM batch"),
        "dedup_latest": over(f"{batch_cte()},{dedup_cte()}", f"SELECT {raw_shown()} FROM latest"),
        "safe_casts": over("", " UNION ALL ".join([
            parsed("quantity", integer("quantity")), parsed("unit_price", "TRY_CAST(unit_price AS DECIMAL(19,2))"),
            parsed("order_date", day("order_date")),
        ])),
        "customer_fields": over("", f"SELECT {', '.join(f'{v} AS {c}' for c, v in customer_rules.items())}, "
                                    "count(*) AS row_count FROM raw GROUP BY 1, 2, 3, 4, 5"),
        "canonical_product": mapping("product_name", product("product_name")),
        "canonical_category": mapping("product_category", by_pattern("product_category", D.CATEGORY_RULES)),
        "canonical_store": mapping("store_name", by_pattern("store_name", D.STORE_RULES)),
        "canonical_status": mapping("shipping_status", status("shipping_status")),
        "revenue_correction": over(
            f"{batch_cte()}, different AS (SELECT DISTINCT * FROM batch),{typed_cte('typed', 'different')}",
            f"""SELECT order_id, _source_filename, quantity AS raw_quantity, unit_price AS raw_unit_price,
              discount_amount AS raw_discount_amount, revenue AS raw_revenue, q AS quantity, CAST(p AS DOUBLE) AS unit_price,
              CAST(d AS DOUBLE) AS discount_amount,
              CAST(CASE WHEN abs(stated - expected) <= 0.02 THEN round(stated, 2) ELSE round(expected, 2) END AS DOUBLE) AS revenue,
              abs(stated - expected) > 0.02 AS _revenue_was_corrected FROM typed_expected"""),
        "typed_orders": over(",".join([batch_cte(), dedup_cte(), typed_cte()]), f"SELECT {CLEANED_SHOWN} FROM typed"),
        "orders_cleaned": over(CLEAN_CHAIN, f"SELECT {CLEANED_SHOWN} FROM cleaned"),
        "orders_rejected": over(f"{batch_cte()},{rejected_cte()}",
            f"""SELECT {', '.join(c for c in REJECTED_COLUMNS if c != '_ingested_at')}, {stamp('_ingested_at')} AS _ingested_at,
              rejection_reason, {stamp('_rejected_at')} AS _rejected_at FROM rejected"""),
        "fct_orders": over_mart(f"SELECT {MART_SHOWN} FROM mart"),
        "mart_stored": over_mart(f"SELECT {MART_SHOWN} FROM mart"),
        "mart_assertions": over_mart(assertion_rows("mart", {
            **{f"{c} is not null": f"count(*) FILTER (WHERE {c} IS NULL)" for c in MART_NOT_NULL},
            **{c: f"count(*) FILTER (WHERE NOT coalesce({c}, false))" for c in MART_CONDITIONS}})),
        "cleaned_assertions": over(CLEAN_CHAIN, assertion_rows("cleaned", {
            "order_id is unique": "count(*) - count(DISTINCT order_id)",
            "shipping_status in accepted values":
                f"count(*) FILTER (WHERE shipping_status NOT IN ({lits([n for n, _ in D.STATUS_SYNONYMS])}))",
            "customer_state in accepted values": f"count(*) FILTER (WHERE customer_state NOT IN ({lits(D.STATES)}))",
            **{f"{c} is not null": f"count(*) FILTER (WHERE {c} IS NULL)" for c in ("order_id", "order_date", "customer_name")}})),
        "dq_checks": over(batch_cte(), checks_select("batch", B.AS_OF, B.CHECKED_AT)),
        "dq_critical": over(batch_cte(), f"SELECT * FROM ({checks_select('batch', B.AS_OF, B.CHECKED_AT)}) "
                                         "WHERE severity = 'CRITICAL' AND status = 'FAIL'"),
        "dq_empty_batch": over(batch_cte("batch", f"DATE '{B.AS_OF + dt.timedelta(days=30)}'"),
                               checks_select("batch", B.AS_OF + dt.timedelta(days=30), B.CHECKED_AT)),
        "dq_results_log": over(f"{batch_cte()},{batch_cte('batch1', day1)}",
            checks_select("batch", B.AS_OF, B.utc_instant(B.AS_OF, 6, 45)) + " UNION ALL "
            + checks_select("batch1", YESTERDAY, B.utc_instant(YESTERDAY, 6, 45))),
        "stage_funnel": over(f"{CLEAN_CHAIN},{rejected_cte()}", f"""SELECT *, CASE WHEN rejection_rate_pct < 5 THEN 'HEALTHY'
              WHEN rejection_rate_pct < 10 THEN 'WARNING' ELSE 'CRITICAL' END AS pipeline_health FROM (
            SELECT pipeline_run_date, latest_ingestion, stage_1_raw, stage_2_cleaned, stage_3_rejected,
              {pct('stage_2_cleaned', 'stage_1_raw')} AS pass_rate_pct, {pct('stage_3_rejected', 'stage_1_raw')} AS rejection_rate_pct,
              raw_null_order_id, raw_null_order_date, raw_null_revenue
            FROM (SELECT {date_text('max(_pipeline_run_date)')} AS pipeline_run_date, {stamp('max(_ingested_at)')} AS latest_ingestion,
                count(*) AS stage_1_raw, count(*) FILTER (WHERE {blank('order_id')}) AS raw_null_order_id,
                count(*) FILTER (WHERE {blank('order_date')}) AS raw_null_order_date,
                count(*) FILTER (WHERE {blank('revenue')}) AS raw_null_revenue
              FROM raw WHERE _pipeline_run_date = (SELECT max(_pipeline_run_date) FROM raw)),
              (SELECT count(*) AS stage_2_cleaned FROM cleaned),
              (SELECT count(*) AS stage_3_rejected FROM rejected
               WHERE CAST(_rejected_at AS DATE) = (SELECT max(CAST(_ingested_at AS DATE)) FROM raw)))"""),
        "rejection_reasons": over(f"{batch_cte()},{rejected_cte()}", f"""SELECT rejection_reason, affected_rows,
              {pct('affected_rows', 'total')} AS pct_of_all_rejections
            FROM (SELECT rejection_reason, count(*) AS affected_rows, CAST(sum(count(*)) OVER () AS BIGINT) AS total
              FROM (SELECT {trim('reason')} AS rejection_reason
                    FROM (SELECT UNNEST(string_split(rejection_reason, '|')) AS reason FROM rejected))
              WHERE rejection_reason <> '' GROUP BY rejection_reason)"""),
        "load_quality_report": over(file_cte, f"""SELECT *, duplicate_order_ids = 0 AND duplicate_rows = 0 AND columns_with_empties = 0 AS all_clean
            FROM (SELECT count(*) AS rows_loaded, count(*) - count(DISTINCT order_id) AS duplicate_order_ids,
              count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM file)) AS duplicate_rows,
              {empties} AS columns_with_empties, CAST({len(SOURCE_COLUMNS)} AS BIGINT) AS columns_total FROM file)"""),
        "empty_cells_by_column": over(file_cte, "SELECT column_name, empty_count, pct_of_rows FROM (" + " UNION ALL ".join(
            f"SELECT {lit(c)} AS column_name, count(*) FILTER (WHERE {c} = '') AS empty_count, "
            f"{pct(f'''count(*) FILTER (WHERE {c} = '')''', 'count(*)', 1)} AS pct_of_rows FROM file" for c in SOURCE_COLUMNS)
            + ") WHERE empty_count > 0"),
        "drifted_load_quality": over(file_cte, "SELECT column_name, empty_count, pct_of_rows FROM (" + " UNION ALL ".join(
            f"SELECT {lit(c)} AS column_name, count(*) FILTER (WHERE {test}) AS empty_count, "
            f"{pct(f'count(*) FILTER (WHERE {test})', 'count(*)', 1)} AS pct_of_rows FROM file"
            for c, test in [*[(c, f"{c} = ''") for c in SOURCE_COLUMNS if c != "payment_method"],
                            ("coupon_code", "quantity IS DISTINCT FROM '1'")])
            + ") WHERE empty_count > 0"),
        "landing_select_latest": f"""WITH {messages_cte()} SELECT CASE WHEN seq IS NULL THEN 'no_email'
              WHEN filename IS NULL THEN 'no_attachment' ELSE 'found' END AS status, seq, subject, sender,
              {stamp('received_at')} AS received_at, filename, regexp_extract(subject, '\\d{{4}}-\\d{{2}}-\\d{{2}}$') AS run_date
            FROM (SELECT 1) LEFT JOIN (SELECT * FROM recent ORDER BY received_at DESC, seq LIMIT 1) ON true""",
        "landing_recent_matches": f"WITH {messages_cte()} SELECT seq, subject FROM recent",
        "landing_dates": f"""WITH {messages_cte()} SELECT seq, subject,
              {date_text('received_at')} AS subject_date, filename,
              CASE WHEN filename IS NOT NULL THEN {date_text('received_at')} END AS filename_date FROM messages""",
        "landing_already_loaded": over("", f"SELECT {raw_shown()} FROM raw WHERE _source_filename NOT IN "
                                           f"(SELECT _source_filename FROM raw WHERE _pipeline_run_date < {AS_OF})"),
        "landing_exports": over("", landed(", _email_received_date")),
        "landing_broken_lines": over("", f"""SELECT * REPLACE (customer_city || chr(10) || '"x", y' || chr(10) || chr(10) AS customer_city)
            FROM ({landed(", _email_received_date")} WHERE _pipeline_run_date = {AS_OF})"""),
        "stream_landing": over("", landed("")),
        "late_arrivals": f"""WITH {messages_cte()},
            got AS (SELECT sender, filename, received_at + to_days(CAST(seq % 4 AS INTEGER)) AS got_at,
                strptime(filename[13:20], '%Y%m%d') AS day FROM messages WHERE filename IS NOT NULL),
            numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY sender, filename ORDER BY got_at ROWS UNBOUNDED PRECEDING) AS no FROM (
                SELECT *, CASE WHEN got_at <= lag(got_at) OVER (PARTITION BY sender, filename ORDER BY got_at) + INTERVAL 36 HOUR THEN 0 ELSE 1 END AS fresh
                FROM got)),
            closed AS (SELECT * FROM (SELECT sender, filename, day, no, min(got_at) AS first_at, max(got_at) AS last_at, count(*) AS deliveries
                FROM numbered GROUP BY ALL)
              WHERE last_at + INTERVAL 36 HOUR <= (SELECT date_trunc('milliseconds', max(got_at)) - INTERVAL 1 DAY FROM got))
            SELECT sender, filename, {date_text('day')} AS run_date, {stamp('first_at')} AS first_at, {stamp('last_at')} AS last_at, deliveries,
              greatest(CAST(floor(epoch_us(first_at - (day + INTERVAL 6 HOUR)) / 60000000) AS BIGINT), 0) AS minutes_late,
              CASE WHEN no > 1 THEN 'repeat' WHEN first_at <= day + INTERVAL 6 HOUR THEN 'on_time'
                WHEN first_at <= day + INTERVAL 375 MINUTE THEN 'late' ELSE 'alert' END AS status FROM closed
            UNION ALL
            SELECT sender, 'e_com_sales_' || strftime(day, '%Y%m%d') || '.csv', {date_text('day')}, NULL, NULL, NULL, NULL, 'missing'
            FROM (SELECT DISTINCT sender FROM closed), (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-25',
                INTERVAL 1 DAY)) AS day)
            WHERE (sender, day) NOT IN (SELECT (sender, day) FROM closed)""",
        "align_schema": over("", f"SELECT {', '.join(c for c in SOURCE_COLUMNS if c != 'payment_method')}, '' AS payment_method FROM raw"),
        "mart_upsert": over(upserted, f"""SELECT {MART_SHOWN} FROM (
            SELECT mart.* REPLACE (CASE WHEN order_date IN (SELECT order_date FROM touched) THEN {AS_OF} ELSE {day1} END AS _last_updated)
            FROM mart)"""),
        "daily_run": over(
            ",".join([f"batch AS (SELECT * REPLACE (TIMESTAMP '{landed_at}' AS _ingested_at) FROM raw WHERE _pipeline_run_date = {AS_OF})",
                      dedup_cte(), typed_cte(), cleaned_cte(), mart_cte()]), f"SELECT {MART_SHOWN} FROM mart"),
        "starter_last_month": over_mart(f"""SELECT '2001-09' AS order_year_month, {TOTALS},
              {ratio('sum(total_discounts_given)', 'sum(total_revenue)')} AS discount_rate_pct
            FROM mart WHERE order_year_month = '2001-09' AND {SALES}"""),
        "starter_top_product": over_mart(f"SELECT product_name, {TOTALS} FROM mart WHERE {SALES} GROUP BY product_name"),
        "starter_best_store": over_mart(f"SELECT store_name, {TOTALS} FROM mart WHERE {SALES} GROUP BY store_name"),
        "starter_store_revenue_year": over_mart(
            f"SELECT store_name, {TOTALS} FROM mart WHERE {SALES} AND order_year = {B.AS_OF.year} GROUP BY store_name"),
        "monthly_revenue": over_mart(f"SELECT order_year_month, {TOTALS} FROM mart WHERE {SALES} GROUP BY order_year_month"),
        "read_only_sql": over_mart("""SELECT product_category, order_year, CAST(sum(total_units_sold) AS BIGINT) AS units
            FROM mart WHERE shipping_status = 'Shipped' GROUP BY product_category, order_year"""),
        "file_lookup_sql": over("", f"""SELECT _source_filename, count(*) AS row_count FROM raw
            WHERE _source_filename = {lit(B.export_name(B.AS_OF))} GROUP BY _source_filename"""),
        "result_preview": over_mart(f"""SELECT {date_text('order_date')} AS order_date, CAST(revenue AS DOUBLE) AS revenue,
              round(units / 7.0, 2) AS units_per_store
            FROM (SELECT order_date, sum(total_revenue) AS revenue, CAST(sum(total_units_sold) AS DOUBLE) AS units FROM mart GROUP BY order_date)
            ORDER BY revenue DESC, order_date """),
    }
    return statements

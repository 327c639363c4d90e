"""Check SQL for the named queries, in the dialect of an independent engine.

The layers are written once as common table expressions; each check pulls in what it uses.
"""

from __future__ import annotations

import re

from ledgerloom.catalog.frames import SNAPSHOTS
from ledgerloom.schemas import BRANCHES, PRODUCTS
from ledgerloom.sources import testviews

AS_OF = "DATE '2000-12-31'"
AS_OF_KEY = 20001231
LOW_KEY = 19991231

_REASONS = {
    "customers": """CASE WHEN customer_source_id IS NULL THEN 'customer_source_id NULL'
        WHEN birth_date IS NOT NULL AND TRY_CAST(birth_date AS DATE) IS NULL THEN 'birth_date non convertible'
        WHEN segment IS NULL THEN 'segment manquant' END""",
    "accounts": """CASE WHEN account_source_id IS NULL THEN 'account_source_id NULL'
        WHEN customer_source_id IS NULL OR customer_source_id NOT IN (SELECT customer_source_id FROM customers)
          THEN 'customer_source_id inconnu en cleansed.customers'
        WHEN TRY_CAST(credit_limit AS DECIMAL(18,2)) IS NULL THEN 'credit_limit non convertible'
        WHEN TRY_CAST(credit_limit AS DECIMAL(18,2)) < 0 THEN 'credit_limit négatif'
        WHEN TRY_CAST(opening_date AS DATE) IS NULL THEN 'opening_date non convertible' END""",
    "transactions": """CASE WHEN transaction_id IS NULL THEN 'transaction_id NULL'
        WHEN account_source_id IS NULL OR account_source_id NOT IN (SELECT account_source_id FROM accounts)
          THEN 'account_source_id inconnu en cleansed.accounts'
        WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL THEN 'amount non convertible'
        WHEN TRY_CAST(transaction_date AS DATE) IS NULL THEN 'transaction_date non convertible' END""",
    "bureau": """CASE WHEN customer_source_id IS NULL OR customer_source_id NOT IN (SELECT customer_source_id FROM customers)
          THEN 'customer_source_id inconnu en cleansed.customers'
        WHEN TRY_CAST(bureau_score AS INT) IS NULL OR TRY_CAST(bureau_score AS INT) NOT BETWEEN 0 AND 1000
          THEN 'bureau_score hors plage [0,1000]'
        WHEN TRY_CAST(report_date AS DATE) IS NULL THEN 'report_date non convertible' END""",
}

_CUSTOMER_ROW = """customer_source_id, full_name, TRY_CAST(birth_date AS DATE) AS birth_date, national_id, segment,
    country_code, TRY_CAST(onboarding_date AS DATE) AS onboarding_date"""
_BAND = """CASE WHEN bureau_score IS NULL THEN NULL WHEN bureau_score < 500 THEN '0-500'
    WHEN bureau_score < 600 THEN '500-600' WHEN bureau_score < 700 THEN '600-700'
    WHEN bureau_score < 750 THEN '700-750' ELSE '750+' END"""
_TX_ORDER = """load_ts DESC, row_id DESC, account_source_id DESC, transaction_date DESC, amount DESC,
    transaction_type DESC, dpd_snapshot DESC"""
_SIGNED = "CASE transaction_type WHEN 'REPAYMENT' THEN -amount ELSE amount END"
# The feature column holds two digits before and four after the point; what does not fit is empty.
_RATIO = "CASE WHEN credit_limit > 0 AND abs(outstanding_balance::DOUBLE) < 99.99995 * credit_limit::DOUBLE THEN round(outstanding_balance::DOUBLE / credit_limit::DOUBLE, 4) END"
_STAGE = "CASE WHEN {0} > 90 THEN 3 WHEN {0} > 30 THEN 2 ELSE 1 END"


def _typed_transactions(load: str, batch: int) -> str:
    return f"""SELECT transaction_id, account_source_id, CAST(transaction_date AS DATE) AS transaction_date,
        CAST(amount AS DECIMAL(18,2)) AS amount, transaction_type,
        coalesce(TRY_CAST(dpd_snapshot AS INT), 0) AS dpd_snapshot, CAST({batch} AS BIGINT) AS batch_id
        FROM (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY {_TX_ORDER}) AS rn
              FROM transactions_judged WHERE failure_reason IS NULL {load}) t WHERE rn = 1"""


def _newest(judged: str, keys: str, columns: str, batch: int) -> str:
    return f"""SELECT {columns}, CAST({batch} AS BIGINT) AS batch_id
        FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY load_ts DESC, row_id DESC) AS rn
              FROM {judged} WHERE failure_reason IS NULL) t WHERE rn = 1"""


def _versions(customers: str) -> str:
    return f"""SELECT c.customer_source_id, full_name, segment, country_code, {_BAND} AS bureau_score_band
        FROM {customers} c LEFT JOIN latest_score s ON s.customer_source_id = c.customer_source_id"""


# Text columns are '' -> NULL after ingestion; only the transaction date is ever empty.
CTES: dict[str, str] = {
    "stg_customers": testviews.STG_CUSTOMERS,
    "stg_customers_2": testviews.STG_CUSTOMERS_2.replace(f"({testviews.STG_CUSTOMERS})", "stg_customers"),
    "stg_accounts": testviews.STG_ACCOUNTS,
    "stg_transactions": f"SELECT * REPLACE (nullif(transaction_date, '') AS transaction_date) FROM ({testviews.STG_TRANSACTIONS})",
    "stg_credit_bureau": testviews.STG_CREDIT_BUREAU,
    "stg_macro_indicators": testviews.STG_MACRO_INDICATORS,
    "products": f"SELECT * FROM (VALUES {PRODUCTS}) t(product_key, product_code, product_name, product_family, is_secured)",
    "branches": f"SELECT * FROM (VALUES {BRANCHES}) t(branch_key, branch_code, branch_name, region, country_code)",
    "customers_judged": f"SELECT *, {_REASONS['customers']} AS failure_reason FROM stg_customers",
    "customers": _newest("customers_judged", "customer_source_id", _CUSTOMER_ROW, 1),
    "customers_2_judged": f"SELECT *, {_REASONS['customers']} AS failure_reason FROM stg_customers_2",
    "customers_2": _newest("customers_2_judged", "customer_source_id", _CUSTOMER_ROW, 2),
    "accounts_judged": f"SELECT *, {_REASONS['accounts']} AS failure_reason FROM stg_accounts",
    "accounts": _newest("accounts_judged", "account_source_id", """account_source_id, customer_source_id, product_code,
        branch_code, CAST(opening_date AS DATE) AS opening_date, CAST(credit_limit AS DECIMAL(18,2)) AS credit_limit,
        TRY_CAST(interest_rate AS DECIMAL(6,4)) AS interest_rate, currency, parent_group_id""", 1),
    "transactions_judged": f"SELECT *, {_REASONS['transactions']} AS failure_reason FROM stg_transactions",
    "transactions": _typed_transactions("", 1),
    "transactions_load_1": _typed_transactions("AND batch_id = 1", 1),
    "transactions_load_2": _typed_transactions("AND batch_id = 2", 2),
    "bureau_judged": f"SELECT *, {_REASONS['bureau']} AS failure_reason FROM stg_credit_bureau",
    "bureau": _newest("bureau_judged", "customer_source_id, CAST(report_date AS DATE)", """customer_source_id,
        CAST(report_date AS DATE) AS report_date, CAST(bureau_score AS INT) AS bureau_score,
        external_default_flag = '1' AS external_default_flag, CAST(inquiry_count_12m AS INT) AS inquiry_count_12m""", 1),
    "latest_score": """SELECT customer_source_id, bureau_score FROM (SELECT *, row_number() OVER (
        PARTITION BY customer_source_id ORDER BY report_date DESC) AS rn FROM bureau) t WHERE rn = 1""",
    "source_1": _versions("customers"),
    "source_2": _versions("customers_2"),
    "dim_1": """SELECT row_number() OVER (ORDER BY customer_source_id) AS customer_key, source_1.* FROM source_1""",
    "changed": """SELECT d.customer_key AS old_key, s.*,
        coalesce(max(d.customer_key) OVER (), 0) AS top FROM source_2 s LEFT JOIN dim_1 d USING (customer_source_id)
        WHERE d.customer_key IS NULL OR d.full_name <> s.full_name OR d.segment <> s.segment
           OR d.country_code <> s.country_code
           OR coalesce(d.bureau_score_band, '') <> coalesce(s.bureau_score_band, '')""",
    "versions": """SELECT d.*, DATE '2026-01-01' AS effective_date,
          CASE WHEN c.old_key IS NULL THEN DATE '9999-12-31' ELSE DATE '2026-02-01' END AS expiry_date,
          CASE WHEN c.old_key IS NULL THEN 1 ELSE 0 END AS is_current, 1 AS version_number
        FROM dim_1 d LEFT JOIN changed c ON c.old_key = d.customer_key
        UNION ALL
        SELECT (SELECT max(customer_key) FROM dim_1) + row_number() OVER (ORDER BY customer_source_id),
          customer_source_id, full_name, segment, country_code, bureau_score_band, DATE '2026-02-01',
          DATE '9999-12-31', 1, CASE WHEN old_key IS NULL THEN 1 ELSE 2 END FROM changed""",
    "band_versions": f"""SELECT customer_source_id, bureau_score_band, report_date AS effective_date, lead(report_date) OVER w AS expiry_date,
          row_number() OVER w AS version_number
        FROM (SELECT *, lag(bureau_score_band) OVER v AS before, row_number() OVER v AS rn
              FROM (SELECT customer_source_id, report_date, {_BAND} AS bureau_score_band FROM bureau) b
              WINDOW v AS (PARTITION BY customer_source_id ORDER BY report_date)) t
        WHERE rn = 1 OR bureau_score_band IS DISTINCT FROM before WINDOW w AS (PARTITION BY customer_source_id ORDER BY report_date)""",
    "snapshots": "SELECT * FROM (VALUES " + ", ".join(f"(DATE '{d}')" for d in SNAPSHOTS) + ") t(as_of)",
    "states": f"""SELECT s.as_of, t.account_source_id, sum({_SIGNED}) AS balance, max(dpd_snapshot) AS dpd
        FROM transactions t JOIN snapshots s ON t.transaction_date <= s.as_of
        WHERE t.transaction_date >= DATE '1995-01-01' GROUP BY ALL""",
    "exposures": f"""SELECT CAST(strftime(s.as_of, '%Y%m%d') AS INT) AS date_key, d.customer_key, p.product_key, b.branch_key,
          1 AS scenario_key, a.account_source_id, CAST(coalesce(t.balance, 0) AS DECIMAL(18,2)) AS outstanding_balance,
          a.credit_limit, coalesce(t.dpd, 0) AS dpd_current, {_STAGE.format('coalesce(t.dpd, 0)')} AS ifrs9_stage,
          CAST(1 AS BIGINT) AS batch_id
        FROM accounts a CROSS JOIN snapshots s JOIN dim_1 d USING (customer_source_id) JOIN products p USING (product_code)
        JOIN branches b USING (branch_code)
        LEFT JOIN states t ON t.account_source_id = a.account_source_id AND t.as_of = s.as_of""",
    "exposure": f"SELECT * FROM exposures WHERE date_key = {AS_OF_KEY}",
    "events_fact": """SELECT CAST(strftime(t.transaction_date, '%Y%m%d') AS INT) AS date_key, d.customer_key, p.product_key,
          CASE WHEN t.dpd_snapshot > 90 THEN 'DEFAULT' ELSE 'MISSED_PAYMENT' END AS event_type,
          t.dpd_snapshot AS dpd_at_event, t.amount AS amount_impacted, CAST(1 AS BIGINT) AS batch_id
        FROM transactions t JOIN accounts a USING (account_source_id) JOIN dim_1 d USING (customer_source_id)
        JOIN products p USING (product_code)
        WHERE t.dpd_snapshot > 0 AND t.transaction_date BETWEEN DATE '1995-01-01' AND DATE '2030-12-31'""",
    "ratings": """SELECT CAST(strftime(report_date, '%Y%m%d') AS INT) AS date_key, d.customer_key, bureau_score,
          CASE WHEN bureau_score >= 750 THEN 'AAA' WHEN bureau_score >= 700 THEN 'AA' WHEN bureau_score >= 600 THEN 'A'
               WHEN bureau_score >= 500 THEN 'BBB' ELSE 'SPECULATIVE' END AS internal_rating, CAST(1 AS BIGINT) AS batch_id
        FROM bureau JOIN dim_1 d USING (customer_source_id)
        WHERE report_date BETWEEN DATE '1995-01-01' AND DATE '2030-12-31'""",
    "missed": f"""SELECT customer_key, CAST(count(*) AS INT) AS n_missed_payments_12m FROM events_fact
        WHERE event_type = 'MISSED_PAYMENT' AND date_key >= {LOW_KEY} GROUP BY customer_key""",
    "scores": f"""SELECT customer_key, bureau_score AS bureau_score_current, bureau_score - before AS bureau_score_delta_6m
        FROM (SELECT customer_key, bureau_score, lag(bureau_score, 6) OVER w AS before,
                     row_number() OVER (PARTITION BY customer_key ORDER BY date_key DESC) AS rn
              FROM ratings WHERE date_key <= {AS_OF_KEY} WINDOW w AS (PARTITION BY customer_key ORDER BY date_key)) t
        WHERE rn = 1""",
    "history": "SELECT customer_key, date_key, account_source_id AS tie, outstanding_balance, credit_limit, dpd_current FROM exposures",
    "history_month": """SELECT customer_key, date_key, '' AS tie, CAST(sum(outstanding_balance) AS DECIMAL(18,2)) AS outstanding_balance,
        CAST(sum(credit_limit) AS DECIMAL(18,2)) AS credit_limit, max(dpd_current) AS dpd_current
        FROM exposures GROUP BY customer_key, date_key""",
    "links": """SELECT account_source_id, customer_source_id, parent_group_id FROM accounts""",
    "tree": """SELECT account_source_id, customer_source_id, account_source_id AS root_group_id, 0 AS hierarchy_level,
          account_source_id AS hierarchy_path FROM links WHERE parent_group_id IS NULL
        UNION ALL
        SELECT c.account_source_id, c.customer_source_id, t.root_group_id, t.hierarchy_level + 1,
          t.hierarchy_path || ' > ' || c.account_source_id
        FROM links c JOIN tree t ON c.parent_group_id = t.account_source_id WHERE t.hierarchy_level < 10""",
    "pairs": """SELECT t.*, e.date_key, e.outstanding_balance, e.credit_limit FROM tree t
        JOIN dim_1 d ON d.customer_source_id = t.customer_source_id LEFT JOIN exposures e ON e.customer_key = d.customer_key""",
    "monthly": f"""SELECT account_source_id, last_day(transaction_date) AS day, {_SIGNED} AS signed, dpd_snapshot AS dpd
        FROM transactions""",
    "last_days": "SELECT year(day) || 'Q' || quarter(day) AS period, max(day) AS day FROM monthly GROUP BY 1",
    "periods": "SELECT * FROM last_days UNION ALL SELECT 'reference', min(day) FROM monthly",
    "utilizations": """SELECT p.period, CASE WHEN a.credit_limit > 0
            THEN least(2.0, greatest(b.balance, 0)::DOUBLE / a.credit_limit::DOUBLE)
            WHEN b.balance > 0 THEN 2.0 END AS value
        FROM periods p JOIN (SELECT p.period, m.account_source_id, sum(signed) AS balance FROM monthly m
                             JOIN periods p ON m.day <= p.day GROUP BY ALL) b USING (period)
        JOIN accounts a USING (account_source_id)""",
    "measured": """SELECT 'utilization_ratio' AS feature, period, value FROM utilizations
        UNION ALL
        SELECT 'dpd_current', period, max(dpd)::DOUBLE FROM monthly JOIN periods USING (day) GROUP BY period, account_source_id
        UNION ALL
        SELECT 'bureau_score', period, arg_max(bureau_score, report_date)::DOUBLE
        FROM bureau JOIN periods ON report_date <= day GROUP BY period, customer_source_id""",
    "vals": "SELECT * FROM measured WHERE value IS NOT NULL",
    "ref_sorted": """SELECT feature, value, row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS pos,
        count(*) OVER (PARTITION BY feature) AS n FROM vals WHERE period = 'reference'""",
    "cuts": """SELECT feature, n, (n - 1) * (i * CAST('0.1' AS DOUBLE)) AS h, CAST(floor((n - 1) * (i * CAST('0.1' AS DOUBLE))) AS BIGINT) AS low
        FROM (SELECT DISTINCT feature, n FROM ref_sorted) r CROSS JOIN (SELECT unnest(range(1, 10)) AS i) k""",
    "inner_edges": """SELECT DISTINCT c.feature, CASE WHEN h - low >= 0.5 THEN b.value - (b.value - a.value) * (1 - (h - low))
          ELSE a.value + (b.value - a.value) * (h - low) END AS edge
        FROM cuts c JOIN ref_sorted a ON a.feature = c.feature AND a.pos = c.low
        JOIN ref_sorted b ON b.feature = c.feature AND b.pos = least(c.low + 1, c.n - 1)""",
    "binned": """SELECT v.feature, v.period, v.bin, count(*) AS n FROM (
          SELECT v.feature, v.period, (SELECT count(*) FROM inner_edges e WHERE e.feature = v.feature AND e.edge <= v.value) AS bin
          FROM vals v) v GROUP BY ALL""",
    "bins": """SELECT feature, unnest(range(0, k + 1)) AS bin FROM (SELECT feature, count(*) AS k FROM inner_edges GROUP BY feature) t""",
    "totals": "SELECT feature, period, sum(n) AS total FROM binned GROUP BY ALL",
    "psi_all": """SELECT t.feature, t.period, CASE WHEN t.total < 10 OR r.total < 10 THEN 0.0 ELSE (
            SELECT sum((greatest(coalesce(c.n, 0) / t.total, 1e-4) - greatest(coalesce(o.n, 0) / r.total, 1e-4))
                   * ln(greatest(coalesce(c.n, 0) / t.total, 1e-4) / greatest(coalesce(o.n, 0) / r.total, 1e-4)))
            FROM bins b LEFT JOIN binned c ON c.feature = b.feature AND c.bin = b.bin AND c.period = t.period
            LEFT JOIN binned o ON o.feature = b.feature AND o.bin = b.bin AND o.period = 'reference'
            WHERE b.feature = t.feature) END AS psi
        FROM totals t JOIN totals r ON r.feature = t.feature AND r.period = 'reference' WHERE t.period <> 'reference'""",
    "book": f"""SELECT a.account_source_id, p.product_family, b.region, a.credit_limit, x.balance AS outstanding_balance,
          coalesce(d.dpd, 0) AS dpd_current, {_STAGE.format('coalesce(d.dpd, 0)')} AS ifrs9_stage,
          CASE WHEN a.credit_limit > 0 THEN least(2.0, x.balance::DOUBLE / a.credit_limit::DOUBLE)
               WHEN x.balance > 0 THEN 2.0 END AS ratio
        FROM accounts a
        JOIN (SELECT a.account_source_id, greatest(coalesce(sum(m.signed), 0), 0)::DECIMAL(18,2) AS balance FROM accounts a
              LEFT JOIN monthly m USING (account_source_id) GROUP BY 1) x USING (account_source_id)
        LEFT JOIN (SELECT account_source_id, max(dpd) AS dpd FROM monthly WHERE day = (SELECT max(day) FROM monthly) GROUP BY 1) d
          USING (account_source_id)
        LEFT JOIN products p USING (product_code) LEFT JOIN branches b USING (branch_code)""",
    "issues": """SELECT 'accounts' AS source, 'credit_limit négatif ou non numérique' AS issue,
            count(*) FILTER (TRY_CAST(credit_limit AS DECIMAL(18,2)) < 0) AS n, count(*) AS checked FROM stg_accounts
        UNION ALL SELECT 'accounts', 'opening_date non convertible',
            count(*) FILTER (TRY_CAST(opening_date AS DATE) IS NULL), count(*) FROM stg_accounts
        UNION ALL SELECT 'accounts', 'clé compte manquante', count(*) FILTER (account_source_id IS NULL), count(*) FROM stg_accounts
        UNION ALL SELECT 'credit_bureau', 'bureau_score hors [0,1000]',
            count(*) FILTER (TRY_CAST(bureau_score AS INT) NOT BETWEEN 0 AND 1000), count(*) FROM stg_credit_bureau""",
    "quality": """SELECT 'stg_customers' AS table_name, count(*) AS rows_checked,
            count(*) FILTER (customer_source_id IS NULL) + count(*) FILTER (segment IS NULL) AS rows_quarantined FROM stg_customers
        UNION ALL SELECT 'stg_accounts', count(*), count(*) FILTER (TRY_CAST(credit_limit AS DECIMAL(18,2)) IS NULL
            OR TRY_CAST(credit_limit AS DECIMAL(18,2)) < 0) FROM stg_accounts
        UNION ALL SELECT 'stg_transactions', count(*),
            count(*) FILTER (TRY_CAST(dpd_snapshot AS INT) NOT BETWEEN 0 AND 999) FROM stg_transactions
        UNION ALL SELECT 'stg_credit_bureau', count(*),
            count(*) FILTER (TRY_CAST(bureau_score AS INT) NOT BETWEEN 0 AND 1000) FROM stg_credit_bureau""",
}

_ORDER = list(CTES)


def _check(final: str) -> str:
    """Prefix ``final`` with every layer it needs, directly or through another layer."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in set(re.findall(r"\w+", text)) & CTES.keys() - needed:
            needed.add(name)
            visit(CTES[name])

    visit(final)
    if not needed:
        return final
    if final.startswith("WITH"):
        final = f"SELECT * FROM ({final})"
    layers = ",\n".join(f"{n} AS ({CTES[n]})" for n in _ORDER if n in needed)
    return f"WITH RECURSIVE {layers}\n{final}"


def _rejected(judged: str) -> str:
    return f"SELECT row_id AS source_row_id, failure_reason FROM {judged} WHERE failure_reason IS NOT NULL"


def _features(history: str) -> str:
    """Balances are averaged in whole cents, half away from zero, so no rounding is left to doubles."""
    def mean(frame: str) -> str:
        total, n = f"CAST(sum(outstanding_balance * 100) OVER {frame} AS BIGINT)", f"count(*) OVER {frame}"
        return f"CAST(sign({total}) * ((2 * abs({total}) + {n}) // (2 * {n})) AS DECIMAL(38,0))"

    return f"""SELECT {AS_OF_KEY} AS date_key, w.customer_key, utilization_ratio, dpd_current, dpd_max_last_6m,
          CAST(dpd_trend AS DECIMAL(6,2)) AS dpd_trend_3m, CAST(cents_3 / 100 AS DECIMAL(18,2)) AS avg_balance_3m,
          CAST(cents_12 / 100 AS DECIMAL(18,2)) AS avg_balance_12m, payment_volatility_6m,
          coalesce(n_missed_payments_12m, 0) AS n_missed_payments_12m, bureau_score_current, bureau_score_delta_6m,
          1 AS months_since_onboarding, CAST(1 AS BIGINT) AS batch_id
        FROM (SELECT customer_key, {_RATIO} AS utilization_ratio,
                dpd_current, max(dpd_current) OVER w6 AS dpd_max_last_6m, dpd_current - lag(dpd_current, 3) OVER w AS dpd_trend,
                {mean('w3')} AS cents_3, {mean('w12')} AS cents_12,
                CASE WHEN stddev_samp(outstanding_balance::DOUBLE) OVER w6 < 999999.99995
                  THEN round(stddev_samp(outstanding_balance::DOUBLE) OVER w6, 4) END AS payment_volatility_6m,
                row_number() OVER (PARTITION BY customer_key ORDER BY date_key DESC, tie DESC) AS rn
              FROM {history}
              WINDOW w AS (PARTITION BY customer_key ORDER BY date_key, tie),
                w3 AS (PARTITION BY customer_key ORDER BY date_key, tie ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
                w6 AS (PARTITION BY customer_key ORDER BY date_key, tie ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
                w12 AS (PARTITION BY customer_key ORDER BY date_key, tie ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) w
        LEFT JOIN scores s ON s.customer_key = w.customer_key LEFT JOIN missed m ON m.customer_key = w.customer_key
        WHERE rn = 1"""


def _raw_contracts() -> str:
    tables = {
        "customers": ("stg_customers", "customer_source_id", {
            c: f"{c} IS NULL" for c in ("customer_source_id", "full_name", "segment", "country_code")}),
        "accounts": ("stg_accounts", "account_source_id", {
            **{c: f"{c} IS NULL" for c in ("account_source_id", "customer_source_id", "product_code", "branch_code", "currency")},
            "opening_date": "TRY_CAST(opening_date AS DATE) IS NULL",
            "credit_limit": "TRY_CAST(credit_limit AS DECIMAL(18,2)) IS NULL"}),
        "transactions": ("stg_transactions", "transaction_id", {
            **{c: f"{c} IS NULL" for c in ("transaction_id", "account_source_id", "transaction_type")},
            "transaction_date": "TRY_CAST(transaction_date AS DATE) IS NULL",
            "amount": "TRY_CAST(amount AS DECIMAL(18,2)) IS NULL", "dpd_snapshot": "FALSE"}),
        "credit_bureau": ("stg_credit_bureau", "customer_source_id, report_date", {
            "customer_source_id": "customer_source_id IS NULL", "report_date": "TRY_CAST(report_date AS DATE) IS NULL",
            "bureau_score": "TRY_CAST(bureau_score AS INT) IS NULL"}),
    }
    checks = {
        "accounts": ("credit_limit >= 0", "TRY_CAST(credit_limit AS DECIMAL(18,2)) < 0"),
        "credit_bureau": ("bureau_score 0..1000", "TRY_CAST(bureau_score AS INT) NOT BETWEEN 0 AND 1000"),
    }
    references = {"accounts": ("customer_source_id", "customers", "stg_customers"),
                  "transactions": ("account_source_id", "accounts", "stg_accounts"),
                  "credit_bureau": ("customer_source_id", "customers", "stg_customers")}
    parts = []
    for table, (staged, key, tests) in tables.items():
        for column, test in tests.items():
            parts.append((table, f"not_null:{column}", f"SELECT count(*) FROM {staged} WHERE {test}"))
        parts.append((table, "unique:" + key.replace(" ", ""),
                      f"SELECT count(*) FROM (SELECT {key} FROM {staged} GROUP BY ALL HAVING count(*) > 1) r"))
        if table in checks:
            name, broken = checks[table]
            parts.append((table, f"check:{name}", f"SELECT count(*) FROM {staged} WHERE {broken}"))
        if table in references:
            column, parent, parent_staged = references[table]
            parts.append((table, f"reference:{column}->{parent}",
                          f"SELECT count(*) FROM {staged} WHERE {column} NOT IN (SELECT {column} FROM {parent_staged})"))
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS contract, ({q}) AS violations" for t, c, q in parts)


def _clean_contracts() -> str:
    """Same list of contracts, nothing broken."""
    names = re.findall(r"SELECT '(\w+)' AS table_name, '([^']+)' AS contract", _raw_contracts())
    rows = ", ".join(f"('{t}', '{c}', CAST(0 AS BIGINT))" for t, c in names)
    return f"SELECT * FROM (VALUES {rows}) t(table_name, contract, violations)"


def _conservation() -> str:
    keys = {"customers": "customer_source_id", "accounts": "account_source_id", "transactions": "transaction_id",
            "bureau": "customer_source_id || report_date"}
    return " UNION ALL ".join(
        f"""SELECT '{'credit_bureau' if t == 'bureau' else t}' AS table_name, count(*) AS staged,
            count(failure_reason) AS quarantined, count(DISTINCT {k}) FILTER (failure_reason IS NULL) AS upserted,
            count(*) FILTER (failure_reason IS NULL) - count(DISTINCT {k}) FILTER (failure_reason IS NULL) AS superseded
            FROM {t}_judged""" for t, k in keys.items())


def _class_counts(source: str, value: str, edges: list, labels: list[str]) -> str:
    rows = [f"SELECT {i} AS ordinal, '{label}' AS label, count(*) FILTER ({value} > {edges[i]} AND {value} <= {edges[i + 1]}) AS n FROM {source}"
            for i, label in enumerate(labels)]
    return " UNION ALL ".join(rows)


def _exposure_split(column: str) -> str:
    return f"""SELECT {column}, CAST(sum(outstanding_balance) AS DECIMAL(28,2)) AS exposure, count(*) AS n_accounts FROM book
        WHERE {column} IS NOT NULL GROUP BY {column}"""


_REJECTED_TOTAL = " + ".join(
    f"(SELECT count(*) FROM {t}_judged WHERE failure_reason IS NOT NULL)" for t in ("customers", "accounts", "transactions", "bureau"))
_FEATURE_ROWS = "SELECT count(DISTINCT customer_key) FROM exposure"

_FINAL = {
    "quarantine_customers": _rejected("customers_judged"),
    "quarantine_accounts": _rejected("accounts_judged"),
    "quarantine_transactions": _rejected("transactions_judged"),
    "quarantine_bureau": _rejected("bureau_judged"),
    "quarantine_payload": """SELECT CAST(1 AS BIGINT) AS batch_id, 'stg_customers' AS source_table, row_id AS source_row_id,
        failure_reason, customer_source_id, full_name, birth_date, national_id, segment, country_code, onboarding_date
        FROM customers_judged WHERE failure_reason IS NOT NULL""",
    "clean_customers": "SELECT * FROM customers",
    "clean_accounts": "SELECT * FROM accounts",
    "clean_transactions": "SELECT * FROM transactions",
    "clean_bureau": "SELECT * FROM bureau",
    "macro_cleanse": """SELECT CAST(period_date AS DATE) AS period_date, country_code, CAST(gdp_growth AS DECIMAL(8,4)) AS gdp_growth,
        TRY_CAST(unemployment_rate AS DECIMAL(6,3)) AS unemployment_rate, CAST(inflation_rate AS DECIMAL(6,3)) AS inflation_rate,
        CAST(trim(policy_rate) AS DECIMAL(6,3)) AS policy_rate, coalesce(scenario_tag, 'BASELINE') AS scenario_tag,
        CAST(1 AS BIGINT) AS batch_id FROM stg_macro_indicators""",
    "typed_values": """SELECT 'credit_bureau' AS source, row_id, TRY_CAST(bureau_score AS INT) AS as_int,
          CAST(external_default_flag AS INT) AS as_bit, CAST(NULL AS DECIMAL(18,2)) AS as_decimal,
          TRY_CAST(report_date AS DATE) AS as_date FROM stg_credit_bureau
        UNION ALL SELECT 'accounts', row_id, NULL, NULL, TRY_CAST(credit_limit AS DECIMAL(18,2)),
          TRY_CAST(opening_date AS DATE) FROM stg_accounts""",
    "superseded_rows": """SELECT transaction_id, count(*) - 1 AS superseded_rows FROM transactions_judged
        WHERE failure_reason IS NULL GROUP BY transaction_id HAVING count(*) > 1""",
    "row_conservation": _conservation(),
    "upsert_two_batches": """SELECT * FROM transactions_load_2 UNION ALL
        SELECT * FROM transactions_load_1 WHERE transaction_id NOT IN (SELECT transaction_id FROM transactions_load_2)""",
    "contract_violations_raw": _raw_contracts(),
    "contract_violations_clean": _clean_contracts(),
    "rules_evaluated": """SELECT 1 AS rule_id, 'stg_customers' AS target_table, 'customer_source_id' AS target_column,
          'NOT_NULL' AS rule_type, 'ERROR' AS severity, count(*) AS rows_checked,
          count(*) FILTER (customer_source_id IS NULL) AS rows_failed FROM stg_customers
        UNION ALL SELECT 2, 'stg_accounts', 'credit_limit', 'RANGE', 'ERROR', count(*), count(*) FILTER (
          coalesce(TRY_CAST(credit_limit AS DECIMAL(18,2)), -1) < 0) FROM stg_accounts
        UNION ALL SELECT 3, 'stg_transactions', 'dpd_snapshot', 'RANGE', 'WARNING', count(*), count(*) FILTER (
          coalesce(TRY_CAST(dpd_snapshot AS INT), -1) NOT BETWEEN 0 AND 999) FROM stg_transactions
        UNION ALL SELECT 4, 'stg_credit_bureau', 'bureau_score', 'RANGE', 'ERROR', count(*), count(*) FILTER (
          coalesce(TRY_CAST(bureau_score AS INT), -1) NOT BETWEEN 0 AND 1000) FROM stg_credit_bureau""",
    "quality_by_table": """SELECT *, round((1 - rows_quarantined / rows_checked) * 100, 2) AS pass_rate_pct FROM quality""",
    "quality_overall": """SELECT CAST(sum(rows_checked) AS BIGINT) AS total_rows_checked,
        CAST(sum(rows_quarantined) AS BIGINT) AS total_rows_quarantined,
        round((1 - sum(rows_quarantined) / sum(rows_checked)) * 100, 2) AS overall_pass_rate_pct FROM quality""",
    "tx_by_month": """SELECT strftime(TRY_CAST(transaction_date AS DATE), '%Y-%m') AS month, count(*) AS n FROM stg_transactions
        WHERE TRY_CAST(transaction_date AS DATE) IS NOT NULL GROUP BY 1""",
    "dq_issues": "SELECT * FROM issues",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
          CAST(quarter(d) AS INT) AS quarter, CAST(month(d) AS INT) AS month, monthname(d) AS month_name,
          CASE WHEN d = last_day(d) THEN 1 ELSE 0 END AS is_reporting_period_end, count(a.opening_date) AS accounts_opened
        FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d) c
        LEFT JOIN stg_accounts a ON TRY_CAST(a.opening_date AS DATE) = d GROUP BY d""",
    "latest_score_band": f"""SELECT c.customer_source_id, bureau_score, {_BAND} AS bureau_score_band FROM customers c
        LEFT JOIN latest_score s ON s.customer_source_id = c.customer_source_id""",
    "scd2_two_batches": "SELECT * FROM versions",
    "scd2_current": "SELECT * FROM versions WHERE is_current = 1",
    "scd2_collated": """WITH sent AS (SELECT customer_source_id, upper(full_name) || '  ' AS full_name, lower(segment) AS segment, country_code, bureau_score_band
            FROM source_2),
          differs AS (SELECT d.customer_key AS old_key, s.* FROM sent s LEFT JOIN dim_1 d USING (customer_source_id)
            WHERE d.customer_key IS NULL OR rtrim(lower(d.full_name)) <> rtrim(lower(s.full_name)) OR rtrim(lower(d.segment)) <> rtrim(lower(s.segment))
              OR rtrim(lower(d.country_code)) <> rtrim(lower(s.country_code))
              OR coalesce(d.bureau_score_band, '') <> coalesce(s.bureau_score_band, ''))
        SELECT d.*, DATE '2026-01-01' AS effective_date,
          CASE WHEN c.old_key IS NULL THEN DATE '9999-12-31' ELSE DATE '2026-02-01' END AS expiry_date,
          CASE WHEN c.old_key IS NULL THEN 1 ELSE 0 END AS is_current, 1 AS version_number
        FROM dim_1 d LEFT JOIN differs c ON c.old_key = d.customer_key
        UNION ALL
        SELECT (SELECT max(customer_key) FROM dim_1) + row_number() OVER (ORDER BY customer_source_id),
          lower(customer_source_id) || ' ', full_name, segment, country_code, bureau_score_band, DATE '2026-02-01',
          DATE '9999-12-31', 1, CASE WHEN old_key IS NULL THEN 1 ELSE 2 END FROM differs""",
    "surrogate_keys": """SELECT customer_source_id, account_source_id,
        row_number() OVER (ORDER BY customer_source_id, account_source_id) AS surrogate_key FROM stg_accounts""",
    "flagship_stage_exposure": f"""SELECT {_STAGE.format('coalesce(dpd, 0)')} AS ifrs9_stage, count(*) AS n_accounts,
          CAST(sum(coalesce(balance, 0)) AS DECIMAL(28,2)) AS outstanding_balance,
          CAST(sum(credit_limit) AS DECIMAL(28,2)) AS credit_limit
        FROM accounts JOIN products USING (product_code)
        LEFT JOIN (SELECT account_source_id, sum({_SIGNED}) AS balance, max(dpd_snapshot) AS dpd FROM transactions
                   WHERE transaction_date <= {AS_OF} GROUP BY 1) t USING (account_source_id) GROUP BY 1""",
    "fact_exposure": "SELECT * FROM exposure",
    "fact_exposure_collated": "SELECT * FROM exposure",
    "fact_exposure_history": "SELECT * FROM exposures",
    "exposure_point_in_time": """SELECT e.date_key, e.account_source_id, d.customer_source_id, e.outstanding_balance,
          CASE WHEN a.opening_date <= strptime(e.date_key::VARCHAR, '%Y%m%d')::DATE THEN 1 ELSE 0 END AS opened,
          v.bureau_score_band, CAST(v.version_number AS INT) AS version_number
        FROM exposures e JOIN dim_1 d USING (customer_key) JOIN accounts a ON a.account_source_id = e.account_source_id
        LEFT JOIN band_versions v ON v.customer_source_id = d.customer_source_id
          AND strptime(e.date_key::VARCHAR, '%Y%m%d')::DATE >= v.effective_date
          AND (v.expiry_date IS NULL OR strptime(e.date_key::VARCHAR, '%Y%m%d')::DATE < v.expiry_date)""",
    "transaction_score_asof": """SELECT t.transaction_id, a.customer_source_id, t.transaction_date, b.bureau_score, b.report_date
        FROM transactions t JOIN accounts a USING (account_source_id)
        ASOF LEFT JOIN bureau b ON b.customer_source_id = a.customer_source_id AND t.transaction_date >= b.report_date""",
    "sql_stage_exposure": f"""SELECT {_STAGE.format('coalesce(dpd, 0)')} AS ifrs9_stage, {_BAND} AS bureau_score_band, count(*) AS n_accounts,
          CAST(sum(coalesce(balance, 0)) AS DECIMAL(28,2)) AS outstanding_balance
        FROM accounts a LEFT JOIN (SELECT account_source_id, sum({_SIGNED}) AS balance, max(dpd_snapshot) AS dpd FROM transactions
                   WHERE transaction_date <= {AS_OF} GROUP BY 1) t USING (account_source_id)
        LEFT JOIN (SELECT customer_source_id, arg_max(bureau_score, report_date) AS bureau_score FROM bureau
                   WHERE report_date <= {AS_OF} GROUP BY 1) s USING (customer_source_id) GROUP BY 1, 2""",
    "quarantine_replay": """SELECT row_id AS source_row_id, account_source_id, TRY_CAST(opening_date AS DATE) AS opening_date,
          TRY_CAST(credit_limit AS DECIMAL(18,2)) AS credit_limit,
          CASE WHEN customer_source_id <> 'CUST-UNKNOWN' THEN failure_reason
            WHEN TRY_CAST(credit_limit AS DECIMAL(18,2)) IS NULL THEN 'credit_limit non convertible'
            WHEN TRY_CAST(credit_limit AS DECIMAL(18,2)) < 0 THEN 'credit_limit négatif'
            WHEN TRY_CAST(opening_date AS DATE) IS NULL THEN 'opening_date non convertible' END AS failure_reason
        FROM accounts_judged WHERE failure_reason = 'customer_source_id inconnu en cleansed.customers'""",
    "rules_all_types": """SELECT 1 AS rule_id, 'stg_customers' AS target_table, 'customer_source_id' AS target_column,
          'NOT_NULL' AS rule_type, 'ERROR' AS severity, count(*) AS rows_checked,
          count(*) FILTER (customer_source_id IS NULL) AS rows_failed FROM stg_customers
        UNION ALL SELECT 2, 'stg_customers', 'birth_date', 'REGEX', 'WARNING', count(*),
          count(*) FILTER (NOT regexp_full_match(birth_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')) FROM stg_customers
        UNION ALL SELECT 3, 'stg_accounts', 'credit_limit', 'RANGE', 'ERROR', count(*), count(*) FILTER (
          coalesce(TRY_CAST(credit_limit AS DECIMAL(18,2)), -1) < 0) FROM stg_accounts
        UNION ALL SELECT 4, 'stg_accounts', 'customer_source_id', 'REFERENTIAL', 'ERROR', count(*), count(*) FILTER (
          customer_source_id NOT IN (SELECT customer_source_id FROM stg_customers)) FROM stg_accounts
        UNION ALL SELECT 5, 'stg_transactions', 'load_ts', 'FRESHNESS', 'ERROR', count(*),
          CASE WHEN date_diff('day', max(load_ts)::DATE, DATE '2026-01-01') > 5000 THEN 1 ELSE 0 END FROM stg_transactions
        UNION ALL SELECT 6, 'stg_transactions', 'load_ts', 'FRESHNESS', 'WARNING', count(*),
          CASE WHEN date_diff('day', max(load_ts)::DATE, DATE '2026-01-01') > 30 THEN 1 ELSE 0 END FROM stg_transactions""",
    "damaged_lines": """SELECT CASE WHEN c_custkey % 29 <> 3 AND c_custkey % 37 <> 5 AND c_custkey % 31 <> 4 THEN c_name END AS full_name,
          CASE WHEN c_custkey % 29 = 3 THEN line || ',EXTRA' WHEN c_custkey % 37 = 5 THEN c_custkey::VARCHAR
               WHEN c_custkey % 31 = 4 THEN line END AS damaged
        FROM (SELECT *, c_custkey::VARCHAR || ',"' || c_name || CASE WHEN c_custkey % 31 = 4 THEN '' ELSE '"' END || ',,N,' || c_mktsegment
              || ',TN,2020-01-01' AS line FROM customer) t""",
    "slot_pruned_quarter": """SELECT transaction_type, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS amount, 3 AS slots_opened
        FROM transactions WHERE transaction_date BETWEEN DATE '2000-10-01' AND DATE '2000-12-31' GROUP BY 1""",
    "unreached_nodes": """WITH RECURSIVE g AS (SELECT account_source_id AS id, CASE WHEN n % 13 = 0 THEN NULL WHEN n % 17 = 3 THEN 'ACC-NONE'
              WHEN n % 3 = 1 THEN 'ACC-' || (n + 1)::VARCHAR ELSE 'ACC-' || ((n * 7 + 5) % 4001)::VARCHAR END AS up
            FROM (SELECT account_source_id, substr(account_source_id, 5)::BIGINT AS n FROM accounts) t),
          walk AS (SELECT g.id, p.id AS anc, p.up FROM g JOIN g p ON p.id = g.up UNION SELECT w.id, p.id, p.up FROM walk w JOIN g p ON p.id = w.up),
          ahead AS (SELECT id, count(*) AS steps, max(CASE WHEN up IS NULL THEN 1 ELSE 0 END) AS rooted,
              max(CASE WHEN up IS NOT NULL AND up NOT IN (SELECT id FROM g) THEN 1 ELSE 0 END) AS lost,
              max(CASE WHEN anc = id THEN 1 ELSE 0 END) AS cyclic FROM walk GROUP BY id),
          turning AS (SELECT id FROM ahead WHERE cyclic = 1),
          named AS (SELECT w.id, min(w.anc) AS cycle_id FROM walk w JOIN turning t ON t.id = w.anc GROUP BY w.id)
        SELECT g.id AS account_source_id, CASE WHEN a.id IS NULL OR a.lost = 1 THEN 'orphan' WHEN a.rooted = 1 THEN 'too deep'
            WHEN a.cyclic = 1 THEN 'cycle' ELSE 'below a cycle' END AS cause, n.cycle_id
        FROM g LEFT JOIN ahead a ON a.id = g.id LEFT JOIN named n ON n.id = g.id
        WHERE g.up IS NOT NULL AND NOT (coalesce(a.rooted, 0) = 1 AND coalesce(a.steps, 0) <= 10)""",
    "drift_sketches": """SELECT period, count(*) AS n, 1 AS median_within_error FROM utilizations WHERE value IS NOT NULL AND period <> 'reference' GROUP BY period""",
    "fact_credit_event": "SELECT * FROM events_fact",
    "fact_rating_history": "SELECT * FROM ratings",
    "ecl_inputs_by_segment": """SELECT date_key, segment, scenario_key, CAST(sum(outstanding_balance) AS DECIMAL(20,2)) AS total_exposure,
          CAST(sum(CASE ifrs9_stage WHEN 1 THEN outstanding_balance ELSE 0 END) AS DECIMAL(20,2)) AS stage_1_exposure,
          CAST(sum(CASE ifrs9_stage WHEN 2 THEN outstanding_balance ELSE 0 END) AS DECIMAL(20,2)) AS stage_2_exposure,
          CAST(sum(CASE ifrs9_stage WHEN 3 THEN outstanding_balance ELSE 0 END) AS DECIMAL(20,2)) AS stage_3_exposure,
          CAST(NULL AS DECIMAL(8,6)) AS avg_pd_12m, CAST(NULL AS DECIMAL(8,6)) AS avg_lgd,
          CAST(NULL AS DECIMAL(20,2)) AS weighted_ead, CAST(NULL AS DECIMAL(20,2)) AS computed_ecl
        FROM exposure JOIN dim_1 USING (customer_key) GROUP BY date_key, segment, scenario_key""",
    "risk_features": _features("history"),
    "risk_features_customer_month": _features("history_month"),
    "missed_payments_12m": "SELECT * FROM missed",
    "bureau_delta": "SELECT * FROM scores",
    "moving_balance_windows": """SELECT customer_key, date_key,
          CAST(sign(s3) * ((2 * abs(s3) + n3) // (2 * n3)) / 100 AS DECIMAL(18,2)) AS avg_balance_3m,
          CAST(sign(s12) * ((2 * abs(s12) + n12) // (2 * n12)) / 100 AS DECIMAL(18,2)) AS avg_balance_12m,
          dpd_max_last_6m, dpd_trend_3m, payment_volatility_6m
        FROM (SELECT customer_key, date_key,
            CAST(sum(outstanding_balance * 100) OVER w3 AS BIGINT) AS s3, count(*) OVER w3 AS n3,
            CAST(sum(outstanding_balance * 100) OVER w12 AS BIGINT) AS s12, count(*) OVER w12 AS n12,
            max(dpd_current) OVER w6 AS dpd_max_last_6m, dpd_current - lag(dpd_current, 3) OVER w AS dpd_trend_3m,
            round(stddev_samp(outstanding_balance::DOUBLE) OVER w6, 4) AS payment_volatility_6m
          FROM history_month WINDOW w AS (PARTITION BY customer_key ORDER BY date_key),
            w3 AS (PARTITION BY customer_key ORDER BY date_key ROWS BETWEEN 2 PRECEDING AND CURRENT ROW),
            w6 AS (PARTITION BY customer_key ORDER BY date_key ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
            w12 AS (PARTITION BY customer_key ORDER BY date_key ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)) t""",
    "group_hierarchy": "SELECT * FROM tree",
    "group_exposure_view": """SELECT root_group_id, account_source_id, customer_source_id, hierarchy_level, hierarchy_path, date_key,
          count(outstanding_balance) AS exposure_rows, CAST(sum(outstanding_balance) AS DECIMAL(28,2)) AS outstanding_balance,
          CAST(sum(credit_limit) AS DECIMAL(28,2)) AS credit_limit FROM pairs GROUP BY ALL""",
    "group_exposure_total": f"""SELECT root_group_id, date_key, CAST(sum(outstanding_balance) AS DECIMAL(28,2)) AS total_group_exposure
        FROM pairs WHERE date_key = {AS_OF_KEY} GROUP BY root_group_id, date_key""",
    "ntile_buckets": """SELECT account_source_id, CAST(ntile(10) OVER (
        ORDER BY outstanding_balance::DOUBLE / credit_limit::DOUBLE, account_source_id) AS INT) AS bucket
        FROM exposure WHERE credit_limit > 0""",
    "psi_ntile": f"""WITH feats AS (SELECT date_key, {_RATIO} AS u FROM (
            SELECT *, row_number() OVER (PARTITION BY date_key, customer_key ORDER BY account_source_id DESC) AS rn FROM exposures) t
            WHERE rn = 1),
          tiles AS (SELECT date_key < 20000601 AS is_ref, u, ntile(10) OVER (PARTITION BY date_key < 20000601 ORDER BY u) AS bucket
            FROM feats WHERE u IS NOT NULL AND (date_key BETWEEN 20000101 AND 20000331 OR date_key BETWEEN 20001001 AND 20001231)),
          sized AS (SELECT bucket, count(*) FILTER (is_ref) AS r, count(*) FILTER (NOT is_ref) AS c FROM tiles GROUP BY bucket),
          shares AS (SELECT r / sum(r) OVER () AS rp, c / sum(c) OVER () AS cp FROM sized),
          score AS (SELECT sum((cp - rp) * ln(cp / rp)) AS psi FROM shares)
        SELECT CAST(1 AS BIGINT) AS batch_id, 'utilization_ratio' AS feature_name, '2000-Q1' AS reference_period,
          '2000-Q4' AS current_period, (SELECT round(avg(u) FILTER (is_ref), 6) FROM tiles) AS reference_mean,
          (SELECT round(avg(u) FILTER (NOT is_ref), 6) FROM tiles) AS current_mean,
          round(psi, 6) AS population_stability_index, CASE WHEN psi > 0.25 THEN 1 ELSE 0 END AS drift_flag FROM score""",
    "psi_quantile_by_quarter": "SELECT feature, period, round(psi, 6) AS psi FROM psi_all",
    "feature_drift_status": """SELECT feature, CASE feature WHEN 'utilization_ratio' THEN 'Ratio d''utilisation du crédit'
            WHEN 'dpd_current' THEN 'Retard de paiement (DPD)' ELSE 'Score bureau de crédit' END AS label,
          round(psi, 4) AS current_psi, CASE WHEN round(psi, 4) > 0.25 THEN 'Dérive' WHEN round(psi, 4) > 0.1 THEN 'Surveillance'
            ELSE 'Stable' END AS status FROM psi_all WHERE period = (SELECT max(period) FROM psi_all)""",
    "utilization_histogram": "WITH clipped AS (SELECT period, least(value, 1.2) AS v FROM vals WHERE feature = 'utilization_ratio' "
        "AND period IN ('reference', (SELECT max(period) FROM last_days))) " + " UNION ALL ".join(
            f"""SELECT {i} AS ordinal, '{1.2 * i / 12:.2f}' AS label,
              count(*) FILTER (period = 'reference' AND v >= CAST('{1.2 * i / 12!r}' AS DOUBLE) AND v {'<=' if i == 11 else '<'} CAST('{1.2 * (i + 1) / 12!r}' AS DOUBLE)) AS reference,
              count(*) FILTER (period <> 'reference' AND v >= CAST('{1.2 * i / 12!r}' AS DOUBLE) AND v {'<=' if i == 11 else '<'} CAST('{1.2 * (i + 1) / 12!r}' AS DOUBLE)) AS current
            FROM clipped""" for i in range(12)),
    "dpd_distribution": _class_counts("book", "dpd_current", [-1, 0, 30, 60, 90, 120, 1000],
                                      ["0 (à jour)", "1-30", "31-60", "61-90", "91-120", "120+"]),
    "score_distribution": _class_counts("latest_score", "bureau_score", [0, 500, 600, 700, 750, 1000],
                                        ["0-500", "500-600", "600-700", "700-750", "750+"]),
    "segment_distribution": "SELECT segment, count(*) AS n FROM customers GROUP BY segment",
    "exposure_by_family": _exposure_split("product_family"),
    "exposure_by_region": _exposure_split("region"),
    "exposure_by_stage": " UNION ALL ".join(
        f"""SELECT {s} AS ifrs9_stage, '{label}' AS label,
          CAST(coalesce(sum(outstanding_balance) FILTER (ifrs9_stage = {s}), 0) AS DECIMAL(28,2)) AS exposure,
          round(coalesce(sum(outstanding_balance) FILTER (ifrs9_stage = {s}), 0)::DOUBLE * 100 / sum(outstanding_balance)::DOUBLE, 1) AS pct,
          count(*) FILTER (ifrs9_stage = {s}) AS n_accounts FROM book"""
        for s, label in ((1, "Stage 1 (sain)"), (2, "Stage 2 (dégradé)"), (3, "Stage 3 (déprécié)"))),
    "run_log": f"""SELECT CAST(2 AS BIGINT) AS batch_id, 'MONTHLY_CHECK' AS pipeline_name, 'SUCCESS' AS status,
        ({_FEATURE_ROWS}) AS rows_ingested, {_REJECTED_TOTAL} AS rows_quarantined""",
    "step_log": " UNION ALL ".join(
        f"SELECT '{name}' AS step_name, ({rows}) AS row_count, 'SUCCESS' AS status" for name, rows in {
            "cleanse_customers": "SELECT count(*) FROM stg_customers",
            "cleanse_accounts": "SELECT count(*) FROM stg_accounts",
            "cleanse_transactions": "SELECT count(*) FROM stg_transactions",
            "cleanse_credit_bureau": "SELECT count(*) FROM stg_credit_bureau",
            "merge_dim_customer_scd2": "SELECT count(*) FROM dim_1",
            "load_fact_exposure": "SELECT count(*) FROM exposure",
            "load_fact_credit_event": "SELECT count(*) FROM events_fact",
            "load_fact_credit_rating_history": "SELECT count(*) FROM ratings",
            "compute_risk_features": _FEATURE_ROWS}.items()),
    "verified_run": """SELECT CAST(2 AS BIGINT) AS batch_id, 'SUCCESS' AS status, count(*) AS rows_ingested,
          count(*) || ' rows' AS verdict FROM stg_macro_indicators
        UNION ALL SELECT 3, 'SUCCESS', 0, 'run 3 succeeded but produced no rows'""",
    "consumed_loads": """SELECT batch_id, count(*) AS n, max(row_id) AS last_row, 1 AS run, 2 AS open_loads FROM stg_transactions GROUP BY batch_id
        UNION ALL SELECT batch_id, count(*), max(row_id), 2, 1 FROM stg_transactions WHERE batch_id = 2 GROUP BY batch_id""",
    "slots_after_cleanup": """SELECT strftime(transaction_date, 'm%Y%m') AS slot, count(*) AS n, CAST(sum(amount) AS DECIMAL(28,2)) AS amount,
          count(*) AS rows, min(transaction_date) AS low, max(transaction_date) AS high,
          (SELECT count(DISTINCT last_day(transaction_date)) FROM transactions_load_1 WHERE transaction_id IN (
              SELECT transaction_id FROM transactions_load_2)
            OR last_day(transaction_date) IN (SELECT last_day(transaction_date) FROM transactions_load_2)) AS replaced
        FROM (SELECT * FROM transactions_load_2 UNION ALL
          SELECT * FROM transactions_load_1 WHERE transaction_id NOT IN (SELECT transaction_id FROM transactions_load_2)) GROUP BY slot""",
    "published_group_view": """SELECT hierarchy_level, date_key, count(*) AS accounts, CAST(sum(exposure_rows) AS BIGINT) AS exposure_rows,
          CAST(sum(outstanding_balance) AS DECIMAL(28,2)) AS outstanding_balance
        FROM (SELECT root_group_id, account_source_id, hierarchy_level, date_key, count(outstanding_balance) AS exposure_rows,
            sum(outstanding_balance) AS outstanding_balance FROM pairs GROUP BY ALL) v GROUP BY hierarchy_level, date_key""",
    "report_document": "SELECT 'segments' AS section, CAST(NULL AS INT) AS position, segment AS label, count(*) AS n FROM customers GROUP BY segment "
                       "UNION ALL SELECT 'scores', ordinal, label, n FROM (" + _class_counts(
                           "latest_score", "bureau_score", [0, 500, 600, 700, 750, 1000],
                           ["0-500", "500-600", "600-700", "700-750", "750+"]) + ") s",
    "incremental_ingest": """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total_value
        FROM events GROUP BY 1, 2""",
}

_FINAL["portfolio_kpis"] = """SELECT 'total_exposure' AS kpi, round(CAST(sum(outstanding_balance) AS DOUBLE), 4) AS value FROM book
    UNION ALL SELECT 'n_accounts', count(*) FROM book
    UNION ALL SELECT 'default_rate_pct', round(count(*) FILTER (ifrs9_stage = 3) * 100 / count(*), 4) FROM book
    UNION ALL SELECT 'avg_utilization_pct', round(avg(ratio) * 100, 4) FROM book
    UNION ALL SELECT 'n_customers', count(*) FROM customers
    UNION ALL SELECT 'dq_pass_rate_pct', round((1 - (SELECT sum(n) FROM issues) /
        ((SELECT count(*) FROM stg_accounts) + (SELECT count(*) FROM stg_credit_bureau))) * 100, 4)
    UNION ALL SELECT 'psi_utilization', round(psi, 4) FROM psi_all"""

ORACLE = {name: _check(sql) for name, sql in _FINAL.items()}
# The key figure compares the twelfth month with the last one, on utilisation alone.
_TWELFTH = """SELECT 'current' AS period, max(day) AS day FROM monthly UNION ALL
    SELECT 'reference', (SELECT day FROM (SELECT DISTINCT day FROM monthly ORDER BY day LIMIT 1 OFFSET 11) t)"""
ORACLE["portfolio_kpis"] = ORACLE["portfolio_kpis"].replace(CTES["periods"], _TWELFTH).replace(
    CTES["vals"], CTES["vals"] + " AND feature = 'utilization_ratio'")

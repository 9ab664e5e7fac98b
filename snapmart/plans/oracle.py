"""DuckDB SQL for each registered query, over the same tables.

The feeds and cleaned tables are common table expressions; each statement carries
only those it needs.
"""

from __future__ import annotations

# Written out here, so that a wrong rule in the code cannot be wrong in the SQL as well.
AGE_RANGE = (15, 100)
INTEREST_RANGE = (0, 100)
SSN_KEEP = "0-9-"
SSN_PATTERN = "^\\d{3}-\\d{2}-\\d{4}$"
OCCUPATION_PATTERN = "^[A-Za-z ]+$"
BEHAVIOUR_PATTERN = "^[A-Za-z0-9 _]+$"
SPECIAL_CHARACTER = "[^A-Za-z0-9 ]"
MONEY_KEEP = "0-9.-"
UNSIGNED_MONEY_KEEP = "0-9."
LOAN_TYPES = {
    "loan_id": "string",
    "Customer_ID": "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    "snapshot_date": "date",
}
MONEY_COLUMNS = (
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
)
FINANCIAL_TYPES = {
    "Customer_ID": "string",
    "Annual_Income": "float",
    "Monthly_Inhand_Salary": "float",
    "Num_Bank_Accounts": "int",
    "Num_Credit_Card": "int",
    "Interest_Rate": "int",
    "Num_of_Loan": "int",
    "Type_of_Loan": "string",
    "Delay_from_due_date": "int",
    "Num_of_Delayed_Payment": "int",
    "Changed_Credit_Limit": "float",
    "Num_Credit_Inquiries": "int",
    "Credit_Mix": "string",
    "Outstanding_Debt": "float",
    "Credit_Utilization_Ratio": "float",
    "Credit_History_Age": "string",
    "Payment_of_Min_Amount": "string",
    "Total_EMI_per_month": "float",
    "Amount_invested_monthly": "float",
    "Payment_Behaviour": "string",
    "Monthly_Balance": "float",
    "snapshot_date": "date",
}
CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))
ATTRIBUTE_COLUMNS = ("Customer_ID", "Name", "Age", "SSN", "Occupation", "snapshot_date")
ARREARS = ("mob", "installments_missed", "first_missed_date", "dpd")
FINANCIAL_COLUMNS = tuple(FINANCIAL_TYPES)
INT_FINANCIALS = tuple(c for c, t in FINANCIAL_TYPES.items() if t == "int")
EXACT_COLUMNS = ("Type_of_Loan", "Interest_Rate", "Annual_Income")
VOCABULARY = ("Auto Loan", "Credit-Builder Loan", "Not Specified", "Payday Loan", "Student Loan")


# Expressions ----------------------------------------------------------------


def whole(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^\\s*[+-]?\\.\\d*\\s*$') THEN 0 ELSE TRY_CAST("
        f"nullif(regexp_extract({c}, '^\\s*([+-]?\\d+)(?:\\.\\d*)?\\s*$', 1), '') AS INTEGER) END"
    )


def real(c: str) -> str:
    return f"TRY_CAST({c} AS FLOAT)"


def keep(c: str, characters: str) -> str:
    return f"regexp_replace({c}, '[^{characters}]', '', 'g')"


def allow(c: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({c}, '{pattern}') THEN {c} END"


def limit(c: str, low: int, high: int) -> str:
    return f"CASE WHEN {c} < {low} OR {c} > {high} THEN 0 ELSE {c} END"


def iso(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def month(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def items(c: str) -> str:
    return rf"string_split_regex(regexp_replace({c}, '\s+and\s+', ',', 'g'), ',\s*')"


def history(c: str) -> str:
    def part(unit: str) -> str:
        found = rf"nullif(regexp_extract({c}, '(\d+)\s*{unit}', 1), '')"
        return f"coalesce(TRY_CAST({found} AS INTEGER), 0)"

    return f"{part('Years')} * 12 + {part('Months')}"


RATIO = (
    "round(CASE WHEN Annual_Income > 0 THEN "
    "CAST(Outstanding_Debt AS DOUBLE) / CAST(Annual_Income AS DOUBLE) END, 6)"
)
SAVINGS = "CAST(Monthly_Inhand_Salary - Total_EMI_per_month - Amount_invested_monthly AS DOUBLE)"


def doubles(columns, types: dict[str, str], prefix: str = "") -> str:
    return ", ".join(
        f"CAST({prefix}{c} AS DOUBLE) AS {c}" if types.get(c) == "float" else f"{prefix}{c}"
        for c in columns
    )


def flags(prefix: str = "") -> str:
    parts = []
    for loan in VOCABULARY:
        name = "loan_" + "".join(ch if ch.isalnum() else "_" for ch in loan).lower()
        found = f"list_contains({items(prefix + 'Type_of_Loan')}, '{loan}')"
        parts.append(f"CAST({found} AS INTEGER) AS {name}")
    return ", ".join(parts)


# Feeds and cleaned tables ---------------------------------------------------

CTE: dict[str, str] = {}

CTE["loan_daily"] = """
SELECT 'L_' || l_orderkey || '_' || l_linenumber AS loan_id, 'CUS_' || o_custkey AS Customer_ID,
  CAST(o_orderdate AS DATE) AS loan_start_date, 10 AS tenure, l_linenumber AS installment_num,
  o_totalprice AS loan_amt,
  CASE WHEN l_suppkey % 25 = 0 THEN 0.0::DOUBLE ELSE l_extendedprice / 10 END AS due_amt,
  l_extendedprice / 20 AS paid_amt,
  CASE WHEN l_returnflag = 'R' THEN l_extendedprice / 10 * (CAST(l_quantity AS INTEGER) % 4)
       WHEN l_returnflag = 'A' THEN 0.0::DOUBLE END AS overdue_amt,
  o_totalprice - l_extendedprice AS balance,
  CAST(date_trunc('month', o_orderdate) + to_months(l_linenumber) AS DATE) AS snapshot_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

CTE["raw_attributes"] = """
SELECT 'CUS_' || c_custkey AS Customer_ID, c_name AS Name,
  CASE WHEN c_custkey % 7 = 0 THEN (c_custkey % 130) || '_'
       WHEN c_custkey % 11 = 0 THEN '-500' ELSE CAST(c_custkey % 130 AS VARCHAR) END AS Age,
  CASE WHEN c_custkey % 5 = 0 THEN '#F%$D@*&8' ELSE lpad(CAST(c_custkey % 900 AS VARCHAR), 3, '0')
    || '-' || lpad(CAST(c_custkey % 90 AS VARCHAR), 2, '0')
    || '-' || lpad(CAST(c_custkey % 450 AS VARCHAR), 4, '0') END AS SSN,
  CASE WHEN c_custkey % 9 = 0 THEN '_______' ELSE c_mktsegment END AS Occupation,
  CASE WHEN c_custkey % 13 = 0 THEN '2024-02-01' ELSE '2024-01-01' END AS snapshot_date
FROM customer"""

_K = "c_custkey"
_RAW_FINANCIALS = {
    "Customer_ID": f"'CUS_' || {_K}",
    "Annual_Income": f"c_acctbal || CASE WHEN {_K} % 6 = 0 THEN '_' ELSE '' END",
    "Monthly_Inhand_Salary": f"{_K} % 700",
    "Num_Bank_Accounts": f"{_K} % 9",
    "Num_Credit_Card": f"{_K} % 7",
    "Interest_Rate": f"CASE WHEN {_K} % 17 = 0 THEN '5318' WHEN {_K} % 19 = 0 THEN '8_' "
    f"ELSE CAST({_K} % 40 AS VARCHAR) END",
    "Num_of_Loan": f"CASE WHEN {_K} % 12 = 0 THEN -100 ELSE {_K} % 5 END",
    "Type_of_Loan": f"CASE WHEN {_K} % 8 = 0 THEN NULL WHEN {_K} % 3 = 0 "
    "THEN 'Auto Loan, Payday Loan, and Credit-Builder Loan' "
    f"WHEN {_K} % 3 = 1 THEN 'Not Specified, and Auto Loan' ELSE 'Student Loan ,Auto Loan' END",
    "Delay_from_due_date": f"{_K} % 60",
    "Num_of_Delayed_Payment": f"CASE WHEN {_K} % 14 = 0 THEN '7_' ELSE CAST({_K} % 25 AS VARCHAR) END",
    "Changed_Credit_Limit": f"CASE WHEN {_K} % 20 = 0 THEN '_' ELSE CAST({_K} % 30 AS VARCHAR) END",
    "Num_Credit_Inquiries": f"{_K} % 16",
    "Credit_Mix": f"CASE WHEN {_K} % 4 = 0 THEN '_' ELSE 'Standard' END",
    "Outstanding_Debt": f"{_K} * 3 % 5000",
    "Credit_Utilization_Ratio": f"{_K} % 50",
    "Credit_History_Age": f"CASE WHEN {_K} % 10 = 0 THEN 'NA' "
    f"ELSE ({_K} % 30) || ' Years and ' || ({_K} % 12) || ' Months' END",
    "Payment_of_Min_Amount": f"CASE {_K} % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END",
    "Total_EMI_per_month": f"{_K} % 90",
    "Amount_invested_monthly": f"CASE WHEN {_K} % 21 = 0 THEN '__10000__' "
    f"ELSE CAST({_K} % 200 AS VARCHAR) END",
    "Payment_Behaviour": f"CASE WHEN {_K} % 23 = 0 THEN '!@9#%8' "
    "ELSE 'Low_spent_Small_value_payments' END",
    "Monthly_Balance": f"CASE WHEN {_K} % 22 = 0 THEN '-12--3' ELSE CAST({_K} % 900 AS VARCHAR) END",
    "snapshot_date": f"CASE WHEN {_K} % 13 = 0 THEN '2024-02-01' ELSE '2024-01-01' END",
}
CTE["raw_financials"] = (
    "SELECT "
    + ", ".join(f"CAST({e} AS VARCHAR) AS {c}" for c, e in _RAW_FINANCIALS.items())
    + " FROM customer"
)


def _clicks(wrap: str) -> str:
    values = ", ".join(
        wrap.format(f"CAST(CAST(floor(value) AS BIGINT) + {i} * (event_id % 7) - 50 AS VARCHAR)")
        + f" AS {c}"
        for i, c in enumerate(CLICK_FEATURES, start=1)
    )
    return (
        f"SELECT {values}, 'CUS_' || user_id AS Customer_ID, "
        f"CAST({month('ts')} AS VARCHAR) AS snapshot_date FROM events"
    )


CTE["raw_clicks"] = _clicks("{}")
CTE["faulty_clicks"] = _clicks(
    "CASE WHEN event_id % 50 = 0 THEN '12.7' WHEN event_id % 70 = 0 THEN 'x' ELSE {} END"
)

CTE["typed_loans"] = (
    "SELECT "
    + ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in LOAN_TYPES.items() if t != "string")
    + ", loan_id, Customer_ID FROM loan_daily"
)
CTE["counted_loans"] = """
SELECT loan_id, Customer_ID, loan_start_date, snapshot_date,
  coalesce(tenure, 0) AS tenure, coalesce(installment_num, 0) AS installment_num,
  coalesce(loan_amt, 0) AS loan_amt, coalesce(due_amt, 0) AS due_amt,
  coalesce(paid_amt, 0) AS paid_amt, coalesce(overdue_amt, 0) AS overdue_amt,
  coalesce(balance, 0) AS balance, coalesce(installment_num, 0) AS mob,
  coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE) / nullif(CAST(due_amt AS DOUBLE), 0)) AS INTEGER), 0)
    AS installments_missed
FROM typed_loans"""
CTE["dated_loans"] = """
SELECT *, CASE WHEN installments_missed > 0
  THEN CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date
FROM counted_loans"""
CTE["loans"] = """
SELECT *, CAST(CASE WHEN overdue_amt > 0
  THEN date_diff('day', first_missed_date, snapshot_date) ELSE 0 END AS INTEGER) AS dpd
FROM dated_loans"""
CTE["flagged_loans"] = """
SELECT *, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS dpd_flag FROM loans
WHERE loan_start_date < DATE '2000-01-01'"""

CTE["draft_attributes"] = (
    f"SELECT Customer_ID, Name, {whole('Age')} AS Age, {keep('SSN', SSN_KEEP)} AS SSN, Occupation, "
    f"{iso('snapshot_date')} AS snapshot_date FROM raw_attributes"
)
CTE["attributes"] = (
    f"SELECT Customer_ID, Name, {limit('Age', *AGE_RANGE)} AS Age, {allow('SSN', SSN_PATTERN)} AS SSN, "
    f"{allow('Occupation', OCCUPATION_PATTERN)} AS Occupation, snapshot_date FROM draft_attributes"
)
# For the joins: a tenth of the customers has no attributes.
CTE["joined_attributes"] = "SELECT * FROM attributes WHERE CAST(substr(Customer_ID, 5) AS BIGINT) % 10 <> 3"


def _typed_financials(money: str | None, *, rules: bool) -> str:
    columns = []
    for c, t in FINANCIAL_TYPES.items():
        if t == "float":
            e = real(keep(c, money) if money else c)
        elif t == "int":
            e = whole(c)
            if rules and c == "Interest_Rate":
                e = limit(f"({e})", *INTEREST_RANGE)
        elif t == "date":
            e = iso(c)
        elif rules and c == "Payment_Behaviour":
            e = allow(c, BEHAVIOUR_PATTERN)
        else:
            e = c
        columns.append(f"{e} AS {c}")
    return f"SELECT {', '.join(columns)} FROM raw_financials"


CTE["bare_financials"] = _typed_financials(None, rules=False)
CTE["draft_financials"] = _typed_financials(UNSIGNED_MONEY_KEEP, rules=False)
CTE["financials"] = _typed_financials(MONEY_KEEP, rules=True)


def _typed_clicks(source: str) -> str:
    values = ", ".join(f"{whole(c)} AS {c}" for c in CLICK_FEATURES)
    return f"SELECT {values}, Customer_ID, {iso('snapshot_date')} AS snapshot_date FROM {source}"


CTE["clicks"] = _typed_clicks("raw_clicks")
CTE["typed_faulty_clicks"] = _typed_clicks("faulty_clicks")
CTE["click_means"] = (
    "SELECT Customer_ID, snapshot_date, "
    + ", ".join(f"avg({c}) AS {c}" for c in CLICK_FEATURES)
    + " FROM clicks GROUP BY ALL"
)


def _features(attributes: str, clicks: str) -> str:
    fin = doubles(FINANCIAL_COLUMNS, FINANCIAL_TYPES, "f.")
    means = ", ".join(f"round(coalesce(c.{x}, 0), 6) AS {x}" for x in CLICK_FEATURES)
    return f"""
SELECT {fin}, {flags("f.")}, coalesce({history("f.Credit_History_Age")}, 0) AS Credit_History_Months,
  a.Name, coalesce(a.Age, 0) AS Age, a.SSN, a.Occupation, {means},
  {RATIO.replace("Annual", "f.Annual").replace("Outstanding", "f.Outstanding")} AS Debt_to_Income_Ratio
FROM financials f
LEFT JOIN {attributes} a ON f.Customer_ID = a.Customer_ID AND f.snapshot_date = a.snapshot_date
LEFT JOIN {clicks} c ON f.Customer_ID = c.Customer_ID AND f.snapshot_date = c.snapshot_date"""


def _matched(where: str = "") -> str:
    fin = doubles(FINANCIAL_COLUMNS, FINANCIAL_TYPES, "f.")
    means = ", ".join(f"round(c.{x}, 6) AS {x}" for x in CLICK_FEATURES)
    return f"""
SELECT {fin}, a.Name, a.Age, a.SSN, a.Occupation, {means},
  {RATIO.replace("Annual", "f.Annual").replace("Outstanding", "f.Outstanding")} AS Debt_to_Income_Ratio,
  {SAVINGS} AS Monthly_Savings
FROM joined_attributes a
JOIN financials f ON f.Customer_ID = a.Customer_ID AND f.snapshot_date = a.snapshot_date
LEFT JOIN click_means c ON f.Customer_ID = c.Customer_ID AND f.snapshot_date = c.snapshot_date
{where}"""


CTE["features"] = _features("joined_attributes", "click_means")
CTE["common"] = """
SELECT snapshot_date FROM attributes INTERSECT SELECT snapshot_date FROM financials
INTERSECT SELECT snapshot_date FROM clicks"""


# Statements -----------------------------------------------------------------


def _mentions(name: str, text: str) -> bool:
    words = text.replace("(", " ").replace(")", " ").replace(",", " ").split()
    return any(
        words[i] in ("FROM", "JOIN") and words[i + 1] == name for i in range(len(words) - 1)
    )


def statement(body: str) -> str:
    """Put the needed common table expressions in front."""
    needed: list[str] = []
    text = body
    for name in reversed(CTE):
        if _mentions(name, text):
            needed.append(name)
            text += " " + CTE[name]
    if not needed:
        return body
    parts = ", ".join(f"{name} AS ({CTE[name]})" for name in reversed(needed))
    return f"WITH {parts} {body}"


def long_form(rows: dict[str, str], source: str, label: str = "column_name") -> str:
    """One aggregate query per name, stacked."""
    return " UNION ALL ".join(f"SELECT '{n}' AS {label}, {e} FROM {source}" for n, e in rows.items())


LOAN_SILVER = f"SELECT {doubles((*LOAN_TYPES, *ARREARS), LOAN_TYPES)} FROM loans"
FINANCIAL_SILVER = f"SELECT {doubles(FINANCIAL_COLUMNS, FINANCIAL_TYPES)} FROM financials"
LABELS = """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
  '30dpd_6mob' AS label_def, snapshot_date FROM loans WHERE mob = 6"""
ATTRIBUTES = f"SELECT {', '.join(ATTRIBUTE_COLUMNS)} FROM attributes"
CLICKS = f"SELECT {', '.join(CLICK_FEATURES)}, Customer_ID, snapshot_date FROM clicks"
LOAN_LONG = f"""SELECT Customer_ID, snapshot_date, trim(item) AS loan
FROM (SELECT Customer_ID, snapshot_date, unnest({items("Type_of_Loan")}) AS item FROM financials)
WHERE trim(item) <> ''"""


def _stats(c: str) -> str:
    return (
        f"count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS stddev, "
        f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max"
    )


def _duplicates(c: str, domain: str) -> str:
    distinct = f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)"
    return f"{distinct} AS distinct_values, count(*) - ({distinct}) AS duplicates, '{domain}' AS domain"


def _profile(c: str) -> str:
    numeric = FINANCIAL_TYPES[c] in ("int", "float")
    zeros = f"count(*) FILTER (WHERE {c} = 0)" if numeric else "CAST(0 AS BIGINT)"
    missing = f"count(*) FILTER (WHERE {c} IS NULL)"
    return (
        f"'{FINANCIAL_TYPES[c]}' AS dtype, {missing} AS missing, {zeros} AS zeros, "
        f"round({missing} / count(*) * 100, 6) AS pct_missing"
    )


def _count_if(condition: str, name: str) -> str:
    return f"count(*) FILTER (WHERE {condition}) AS {name}"


def _domain_counts(sources: dict[str, str], date: str = "snapshot_date, ") -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS domain, {date}count(*) AS n FROM {t} GROUP BY ALL"
        for d, t in sources.items()
    )


AGE_OUTSIDE = f"Age < {AGE_RANGE[0]} OR Age > {AGE_RANGE[1]}"
RATE_OUTSIDE = f"Interest_Rate < {INTEREST_RANGE[0]} OR Interest_Rate > {INTEREST_RANGE[1]}"

_SQL = {
    "scan_snapshot": f"{LOAN_SILVER} WHERE snapshot_date = DATE '1998-06-01'",
    "scan_all_snapshots": LABELS,
    "preview_snapshot": FINANCIAL_SILVER
    + " WHERE snapshot_date = (SELECT max(snapshot_date) FROM financials) ORDER BY Customer_ID LIMIT 5",
    "discover_snapshots": "SELECT DISTINCT snapshot_date FROM loans",
    "latest_snapshot": f"{LOAN_SILVER} WHERE snapshot_date = (SELECT max(snapshot_date) FROM loans)",
    "date_from_filename": "SELECT 'bronze_features_attributes_' || replace(snapshot_date, '-', '_') || '.csv' "
    "AS source_file, count(*) AS n, CAST(snapshot_date AS DATE) AS snapshot_date FROM raw_attributes GROUP BY ALL",
    "silver_from_files": "SELECT Customer_ID, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM attributes) "
    "THEN NULL ELSE Name END AS Name, Age, SSN, Occupation, snapshot_date FROM attributes",
    "typed_csv_scan": "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, "
    "CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer",
    "tolerant_csv_scan": "SELECT Customer_ID, TRY_CAST(Age AS INTEGER) AS Age, "
    "CASE WHEN TRY_CAST(Age AS INTEGER) IS NULL THEN Customer_ID || ',' || Age END AS corrupt FROM raw_attributes",
    "multi_file_scan": "SELECT Customer_ID, Annual_Income, Type_of_Loan, Payment_Behaviour, "
    "TRUE AS from_csv FROM raw_financials",
    "month_calendar": """
SELECT m.snapshot_date, count(o_orderkey) AS n_orders FROM (
  SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate),
    INTERVAL 1 MONTH)) AS DATE) AS snapshot_date FROM orders) m
LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = m.snapshot_date GROUP BY ALL""",
    "write_roundtrip": ATTRIBUTES,
    "bronze_slice": f"SELECT {', '.join(LOAN_TYPES)} FROM loan_daily "
    "WHERE snapshot_date = DATE '1998-06-01'",
    "bronze_backfill": _domain_counts(
        {
            "loan_daily": "loan_daily",
            "attributes": "raw_attributes",
            "financials": "raw_financials",
            "clickstream": "raw_clicks",
        },
        date="CAST(snapshot_date AS DATE) AS snapshot_date, ",
    ),
    "backfill_changed": "SELECT domain, snapshot_date, n, domain = 'financials' AND snapshot_date = "
    "(SELECT CAST(snapshot_date AS DATE) FROM raw_financials WHERE Customer_ID = 'CUS_13') AS rewritten FROM ("
    + _domain_counts(
        {"attributes": "raw_attributes", "financials": "raw_financials"},
        date="CAST(snapshot_date AS DATE) AS snapshot_date, ",
    )
    + ")",
    "load_failures": """
SELECT 'data' AS file, 'read' AS outcome, count(*) AS n, count(*) AS rows_read, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM customer
UNION ALL SELECT file, outcome, 0, NULL, NULL FROM (VALUES ('bad-empty.csv', 'empty'), ('bad-header-only.csv', 'no rows'),
  ('bad-other-header.csv', 'other header'), ('bad-cut.csv.gz', 'broken')) t(file, outcome)""",
    "mart_build": _domain_counts(
        {
            "silver/loan_daily": "loans",
            "silver/attributes": "attributes",
            "silver/financials": "financials",
            "silver/clickstream": "clicks",
            "gold/feature_store": "features",
        },
        date="",
    )
    + " UNION ALL SELECT 'gold/label_store' AS domain, count(*) AS n FROM loans WHERE mob = 6",
    "label_rebuild": """SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label,
  '30dpd_7mob' AS label_def, snapshot_date FROM loans WHERE mob = 7""",
    "feed_redelivery": _domain_counts(
        {
            f"{layer}": "(SELECT * FROM financials WHERE snapshot_date <> DATE '2024-02-01') t"
            for layer in ("silver/financials", "gold/feature_store")
        },
        date="",
    ),
    "gold_incremental": f"SELECT Customer_ID, snapshot_date, {flags()}, "
    f"coalesce({history('Credit_History_Age')}, 0) AS Credit_History_Months FROM financials "
    "WHERE NOT coalesce(Type_of_Loan LIKE '%Student Loan%' AND snapshot_date <> DATE '2024-02-01', FALSE)",
    "matched_build": _matched("WHERE f.snapshot_date IN (SELECT snapshot_date FROM common)"),
    # Pairs of a key: their count and sum of products, from the key's own counts and sums.
    "skewed_join_all_rows": """
SELECT user, band, count(*) * count(*) AS n, CAST(sum(floor(value)) * sum(floor(value)) AS BIGINT) AS s FROM
  (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user, CAST(hour(ts) AS INTEGER) AS band, value FROM events) x
WHERE user IS NOT NULL AND band IS NOT NULL GROUP BY ALL""",
    "skewed_join": """
SELECT user, band, count(*) * count(*) AS n, CAST(sum(floor(value)) * sum(floor(value)) AS BIGINT) AS s FROM
  (SELECT CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS user, CAST(hour(ts) % 2 AS INTEGER) AS band, value FROM events) x
WHERE user IS NOT NULL AND band IS NOT NULL GROUP BY ALL""",
    "loan_cast": f"SELECT {doubles(LOAN_TYPES, LOAN_TYPES)} FROM typed_loans",
    "attributes_cast": f"SELECT Customer_ID, Name, {whole('Age')} AS Age, SSN, Occupation, "
    f"{iso('snapshot_date')} AS snapshot_date FROM raw_attributes",
    "financials_cast": FINANCIAL_SILVER.replace("FROM financials", "FROM bare_financials"),
    "clickstream_cast": CLICKS.replace("FROM clicks", "FROM typed_faulty_clicks"),
    "attributes_schema_only": ATTRIBUTES.replace("FROM attributes", "FROM draft_attributes"),
    "financials_unsigned": FINANCIAL_SILVER.replace("FROM financials", "FROM draft_financials"),
    "clean_ssn": "SELECT Customer_ID, SSN FROM attributes",
    "enforce_age": "SELECT Customer_ID, Age FROM attributes",
    "clean_occupation": "SELECT Customer_ID, Occupation FROM attributes",
    "clean_numerics": "SELECT Customer_ID, "
    + ", ".join(f"{keep(c, MONEY_KEEP)} AS {c}" for c in MONEY_COLUMNS)
    + " FROM raw_financials",
    "enforce_interest_rate": "SELECT Customer_ID, Interest_Rate FROM financials",
    "interest_rate_null_to_zero": "SELECT Customer_ID, "
    f"CASE WHEN Interest_Rate BETWEEN {INTEREST_RANGE[0]} AND {INTEREST_RANGE[1]} "
    "THEN Interest_Rate ELSE 0 END AS Interest_Rate FROM draft_financials",
    "clean_payment_behaviour": "SELECT Customer_ID, Payment_Behaviour FROM financials",
    "clickstream_validate": long_form(
        {
            c: _count_if(f"({whole(c)}) IS NULL", "unparsable")
            + ", "
            + _count_if(f"TRY_CAST({c} AS DOUBLE) <> floor(TRY_CAST({c} AS DOUBLE))", "non_integer")
            for c in CLICK_FEATURES
        },
        "faulty_clicks",
    ),
    "loan_silver": LOAN_SILVER,
    "loan_dpd": "SELECT loan_id, snapshot_date, installments_missed, first_missed_date, dpd FROM loans",
    "attributes_silver": ATTRIBUTES,
    "financials_silver": FINANCIAL_SILVER,
    "clickstream_silver": CLICKS,
    "label_store": LABELS,
    "bad_rate_by_mob": "SELECT mob, round(avg(dpd_flag), 6) AS bad_rate FROM flagged_loans GROUP BY mob",
    "actual_bads": f"SELECT {doubles((*LOAN_TYPES, *ARREARS, 'dpd_flag'), LOAN_TYPES)} "
    "FROM flagged_loans WHERE installment_num = 7",
    "loan_list": f"SELECT Customer_ID, array_to_string({items('Type_of_Loan')}, '|') AS items, "
    f"CAST(len({items('Type_of_Loan')}) AS INTEGER) AS n_items FROM raw_financials",
    "loan_vocabulary": f"SELECT DISTINCT loan FROM ({LOAN_LONG}) ORDER BY loan",
    "loan_types_long": LOAN_LONG,
    "one_hot_loans": f"SELECT Customer_ID, snapshot_date, {flags()} FROM financials",
    "credit_history_months": "SELECT Customer_ID, snapshot_date, Credit_History_Age, "
    f"{history('Credit_History_Age')} AS Credit_History_Months FROM financials",
    "clickstream_dedup": "SELECT Customer_ID, snapshot_date, "
    + ", ".join(f"round({c}, 6) AS {c}" for c in CLICK_FEATURES)
    + " FROM click_means",
    "debt_to_income": "SELECT Customer_ID, snapshot_date, CAST(Annual_Income AS DOUBLE) AS Annual_Income, "
    f"CAST(Outstanding_Debt AS DOUBLE) AS Outstanding_Debt, {RATIO} AS Debt_to_Income_Ratio "
    "FROM financials",
    "monthly_savings": f"SELECT Customer_ID, snapshot_date, {SAVINGS} AS Monthly_Savings FROM financials",
    "gold_features": "SELECT * FROM features",
    "gold_optional_missing": _features(
        "(SELECT * FROM attributes WHERE FALSE)", "(SELECT * FROM click_means WHERE FALSE)"
    ),
    "gold_features_inner": _matched(),
    "common_snapshots": "SELECT snapshot_date FROM common",
    "gold_common_snapshots": _matched("WHERE f.snapshot_date IN (SELECT snapshot_date FROM common)"),
    "row_count": "SELECT count(*) AS n FROM loans",
    "row_count_by_snapshot": "SELECT snapshot_date, count(*) AS n, "
    "CAST(grouping(snapshot_date) AS INTEGER) AS is_total FROM loans GROUP BY ROLLUP (snapshot_date)",
    "row_count_by_domain": "SELECT domain, snapshot_date, CAST(sum(n) AS BIGINT) AS n, "
    "CAST(grouping(domain, snapshot_date) AS INTEGER) AS level FROM ("
    + _domain_counts(
        {"attributes": "attributes", "financials": "financials", "clickstream": "clicks"}
    )
    + ") GROUP BY ROLLUP (domain, snapshot_date)",
    "null_profile": long_form(
        {c: _count_if(f"{c} IS NULL", "nulls") for c in FINANCIAL_COLUMNS}, "financials"
    ),
    "clickstream_null_zero": long_form(
        {
            c: _count_if(f"{c} IS NULL", "nulls")
            + (
                ", " + _count_if(f"{c} = 0", "zeros")
                if c in CLICK_FEATURES
                else ", CAST(NULL AS BIGINT) AS zeros"
            )
            for c in (*CLICK_FEATURES, "Customer_ID", "snapshot_date")
        },
        "typed_faulty_clicks",
    ),
    "profile_table": long_form({c: _profile(c) for c in FINANCIAL_COLUMNS}, "financials"),
    "profile_accumulated": long_form(
        {
            c: _profile(c)
            + ", count(*) AS row_count, "
            + (f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" if c in EXACT_COLUMNS else "CAST(NULL AS BIGINT)")
            + " AS distinct_values"
            for c in FINANCIAL_COLUMNS
            if c != "snapshot_date"
        },
        "financials",
    ),
    "describe_accumulated": long_form(
        {c: _stats(c) for c, t in FINANCIAL_TYPES.items() if t in ("int", "float")}, "financials"
    ),
    "describe_numeric": long_form({"Age": _stats("Age")}, "draft_attributes")
    + " UNION ALL "
    + long_form({c: _stats(c) for c in CLICK_FEATURES}, "clicks"),
    "duplicate_stats": long_form(
        {c: _duplicates(c, "attributes") for c in ("Customer_ID", "snapshot_date", "SSN")},
        "draft_attributes",
    )
    + " UNION ALL "
    + long_form(
        {c: _duplicates(c, "clickstream") for c in ("Customer_ID", "snapshot_date")}, "clicks"
    ),
    "duplicate_keys": "SELECT SSN, count(*) AS n FROM draft_attributes GROUP BY SSN HAVING count(*) > 1",
    "duplicate_rows": "SELECT Customer_ID, Name, Age, SSN, Occupation, snapshot_date "
    "FROM draft_attributes WHERE SSN IN "
    "(SELECT SSN FROM draft_attributes GROUP BY SSN HAVING count(*) > 1)",
    "out_of_range_count": long_form(
        {"Age": _count_if(AGE_OUTSIDE, "violations")}, "draft_attributes", "rule"
    )
    + " UNION ALL "
    + long_form({"Interest_Rate": _count_if(RATE_OUTSIDE, "violations")}, "draft_financials", "rule"),
    "invalid_category_values": "SELECT Payment_of_Min_Amount, count(*) AS n FROM draft_financials "
    "WHERE Payment_of_Min_Amount NOT IN ('Yes', 'No') GROUP BY ALL",
    "special_char_count": "SELECT "
    + _count_if(f"regexp_matches(Payment_Behaviour, '{SPECIAL_CHARACTER}')", "n")
    + " FROM draft_financials",
    "rule_violations": long_form(
        {
            "interest rate out of range": _count_if(RATE_OUTSIDE, "violations"),
            "interest rate missing": _count_if("Interest_Rate IS NULL", "violations"),
            "minimum payment not yes or no": _count_if(
                "Payment_of_Min_Amount NOT IN ('Yes', 'No')", "violations"
            ),
            "behaviour has special characters": _count_if(
                f"regexp_matches(Payment_Behaviour, '{SPECIAL_CHARACTER}')", "violations"
            ),
            "behaviour not allowed": _count_if(
                f"NOT regexp_matches(Payment_Behaviour, '{BEHAVIOUR_PATTERN}')", "violations"
            ),
        },
        "draft_financials",
        "rule",
    ),
    "distinct_values": f"SELECT DISTINCT Interest_Rate FROM draft_financials WHERE {RATE_OUTSIDE}",
    "distinct_ages_sorted": "SELECT DISTINCT Age FROM attributes ORDER BY Age",
    "union_feeds": ATTRIBUTES.replace("FROM attributes", "FROM draft_attributes")
    + " WHERE snapshot_date IS NOT NULL",
}

ORACLE = {name: statement(body) for name, body in _SQL.items()}

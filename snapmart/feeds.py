"""The four monthly feeds, declared as data.

A feed names its key, the Spark type of each column and the cleaning rules that
``operators.silver.conform`` compiles into one projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# Column names, types, bounds and patterns of the feeds.
# ---------------------------------------------------------------------------
SNAPSHOT = "snapshot_date"
CUSTOMER = "Customer_ID"
FEATURE_KEYS = (CUSTOMER, SNAPSHOT)
CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))

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
ATTRIBUTE_TYPES = {
    "Customer_ID": "string",
    "Name": "string",
    "Age": "int",
    "SSN": "string",
    "Occupation": "string",
    "snapshot_date": "date",
}
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
CLICKSTREAM_TYPES = {
    **{name: "int" for name in CLICK_FEATURES},
    "Customer_ID": "string",
    "snapshot_date": "date",
}

AGE_RANGE = (15, 100)
INTEREST_RANGE = (0, 100)
SSN_KEEP = r"0-9\-"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
OCCUPATION_PATTERN = r"^[A-Za-z ]+$"
MONEY_KEEP = r"0-9\.\-"
UNSIGNED_MONEY_KEEP = r"0-9\."
BEHAVIOUR_PATTERN = r"^[A-Za-z0-9 _]+$"
SPECIAL_CHARACTER = r"[^A-Za-z0-9 ]"
MIN_PAYMENT_ANSWERS = ("Yes", "No")
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
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Feed:
    """One source of monthly rows.

    ``keep``     column -> character class; every other character is removed
    ``allowed``  column -> pattern; a value that does not match becomes null
    ``ranges``   column -> (low, high); a value outside becomes 0
    ``strict``   a declared column missing from the input is an error
    """

    table: str
    stem: str
    types: dict[str, str]
    key: tuple[str, ...] = FEATURE_KEYS
    keep: dict[str, str] = field(default_factory=dict)
    allowed: dict[str, str] = field(default_factory=dict)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    range_fills_null: bool = False
    strict: bool = False

    def ddl(self, *, text: bool = False) -> str:
        """Schema of the feed, all strings for raw files."""
        return ", ".join(f"`{c}` {'string' if text else t}" for c, t in self.types.items())


LOANS = Feed(
    table="loan_daily",
    stem="loan_daily",
    types=LOAN_TYPES,
    key=("loan_id", SNAPSHOT),
    strict=True,
)
ATTRIBUTES = Feed(
    table="attributes",
    stem="features_attributes",
    types=ATTRIBUTE_TYPES,
    keep={"SSN": SSN_KEEP},
    allowed={"SSN": SSN_PATTERN, "Occupation": OCCUPATION_PATTERN},
    ranges={"Age": AGE_RANGE},
)
FINANCIALS = Feed(
    table="financials",
    stem="features_financials",
    types=FINANCIAL_TYPES,
    keep={c: MONEY_KEEP for c in MONEY_COLUMNS},
    allowed={"Payment_Behaviour": BEHAVIOUR_PATTERN},
    ranges={"Interest_Rate": INTEREST_RANGE},
)
CLICKSTREAM = Feed(
    table="clickstream",
    stem="feature_clickstream",
    types=CLICKSTREAM_TYPES,
)
FEEDS = {f.table: f for f in (LOANS, ATTRIBUTES, FINANCIALS, CLICKSTREAM)}

# Draft rule sets used while profiling a feed, before its rules are settled.
ATTRIBUTES_TYPED_ONLY = replace(ATTRIBUTES, allowed={}, ranges={})
FINANCIALS_UNSIGNED = replace(
    FINANCIALS,
    keep={c: UNSIGNED_MONEY_KEEP for c in MONEY_COLUMNS},
    allowed={},
    ranges={},
)

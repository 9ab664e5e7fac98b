"""The four raw feeds, derived from the given tables by column expressions.

``oracle.py`` holds the same derivations for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..feeds import ATTRIBUTES, CLICK_FEATURES, CLICKSTREAM, FINANCIALS, LOANS

CUSTOMER_SNAPSHOT = "if(c_custkey % 13 = 0, '2024-02-01', '2024-01-01')"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {name}" for name, e in columns.items()])


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return _project(
        lines.join(orders, lines.l_orderkey == orders.o_orderkey),
        {
            "loan_id": "concat_ws('_', 'L', l_orderkey, l_linenumber)",
            "Customer_ID": "concat('CUS_', o_custkey)",
            "loan_start_date": "date(o_orderdate)",
            "tenure": "10",
            "installment_num": "l_linenumber",
            "loan_amt": "o_totalprice",
            "due_amt": "if(l_suppkey % 25 = 0, 0D, l_extendedprice / 10)",
            "paid_amt": "l_extendedprice / 20",
            "overdue_amt": "CASE l_returnflag WHEN 'A' THEN 0D "
            "WHEN 'R' THEN l_extendedprice / 10 * (int(l_quantity) % 4) END",
            "balance": "o_totalprice - l_extendedprice",
            "snapshot_date": "add_months(trunc(o_orderdate, 'MM'), l_linenumber)",
        },
    )


def attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _attributes(table(spark, sf_dir, "customer"))


def attributes_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of nine in ten customers, for the joins: the others have financials but no match."""
    return _attributes(table(spark, sf_dir, "customer").filter("c_custkey % 10 <> 3"))


def _attributes(customers: DataFrame) -> DataFrame:
    return _project(
        customers,
        {
            "Customer_ID": "concat('CUS_', c_custkey)",
            "Name": "c_name",
            "Age": "CASE WHEN c_custkey % 7 = 0 THEN concat(c_custkey % 130, '_') "
            "WHEN c_custkey % 11 = 0 THEN '-500' ELSE string(c_custkey % 130) END",
            "SSN": "if(c_custkey % 5 = 0, '#F%$D@*&8', concat_ws('-', "
            "lpad(string(c_custkey % 900), 3, '0'), lpad(string(c_custkey % 90), 2, '0'), "
            "lpad(string(c_custkey % 450), 4, '0')))",
            "Occupation": "if(c_custkey % 9 = 0, '_______', c_mktsegment)",
            "snapshot_date": CUSTOMER_SNAPSHOT,
        },
    )


def financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "Customer_ID": "concat('CUS_', c_custkey)",
        "Annual_Income": "concat(c_acctbal, if(c_custkey % 6 = 0, '_', ''))",
        "Monthly_Inhand_Salary": "c_custkey % 700",
        "Num_Bank_Accounts": "c_custkey % 9",
        "Num_Credit_Card": "c_custkey % 7",
        "Interest_Rate": "CASE WHEN c_custkey % 17 = 0 THEN '5318' "
        "WHEN c_custkey % 19 = 0 THEN '8_' ELSE string(c_custkey % 40) END",
        "Num_of_Loan": "if(c_custkey % 12 = 0, -100, c_custkey % 5)",
        "Type_of_Loan": "CASE WHEN c_custkey % 8 = 0 THEN NULL "
        "WHEN c_custkey % 3 = 0 THEN 'Auto Loan, Payday Loan, and Credit-Builder Loan' "
        "WHEN c_custkey % 3 = 1 THEN 'Not Specified, and Auto Loan' "
        "ELSE 'Student Loan ,Auto Loan' END",
        "Delay_from_due_date": "c_custkey % 60",
        "Num_of_Delayed_Payment": "if(c_custkey % 14 = 0, '7_', string(c_custkey % 25))",
        "Changed_Credit_Limit": "if(c_custkey % 20 = 0, '_', string(c_custkey % 30))",
        "Num_Credit_Inquiries": "c_custkey % 16",
        "Credit_Mix": "if(c_custkey % 4 = 0, '_', 'Standard')",
        "Outstanding_Debt": "c_custkey * 3 % 5000",
        "Credit_Utilization_Ratio": "c_custkey % 50",
        "Credit_History_Age": "if(c_custkey % 10 = 0, 'NA', "
        "concat(c_custkey % 30, ' Years and ', c_custkey % 12, ' Months'))",
        "Payment_of_Min_Amount": "CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END",
        "Total_EMI_per_month": "c_custkey % 90",
        "Amount_invested_monthly": "if(c_custkey % 21 = 0, '__10000__', string(c_custkey % 200))",
        "Payment_Behaviour": "if(c_custkey % 23 = 0, '!@9#%8', 'Low_spent_Small_value_payments')",
        "Monthly_Balance": "if(c_custkey % 22 = 0, '-12--3', string(c_custkey % 900))",
        "snapshot_date": CUSTOMER_SNAPSHOT,
    }
    return _project(
        table(spark, sf_dir, "customer"), {name: f"string({e})" for name, e in columns.items()}
    )


def _clicks(spark: SparkSession, sf_dir: str, wrap: str) -> DataFrame:
    values = {
        name: wrap.format(f"string(floor(value) + {i} * (event_id % 7) - 50)")
        for i, name in enumerate(CLICK_FEATURES, start=1)
    }
    return _project(
        table(spark, sf_dir, "events"),
        {
            **values,
            "Customer_ID": "concat('CUS_', user_id)",
            "snapshot_date": "string(trunc(ts, 'MM'))",
        },
    )


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clicks(spark, sf_dir, "{}")


def clickstream_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows with fractions and unreadable values mixed in."""
    return _clicks(
        spark,
        sf_dir,
        "CASE WHEN event_id % 50 = 0 THEN '12.7' WHEN event_id % 70 = 0 THEN 'x' ELSE {} END",
    )


RAW = {
    LOANS.table: loans,
    ATTRIBUTES.table: attributes,
    FINANCIALS.table: financials,
    CLICKSTREAM.table: clickstream,
}

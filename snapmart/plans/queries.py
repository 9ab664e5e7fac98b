"""Every operator as a query over the given tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import datetime as dt
import gzip
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import feeds
from ..feeds import (
    ATTRIBUTES,
    ATTRIBUTES_TYPED_ONLY,
    CLICK_FEATURES,
    CLICKSTREAM,
    FEATURE_KEYS,
    FEEDS,
    FINANCIALS,
    FINANCIALS_UNSIGNED,
    LOANS,
    SNAPSHOT,
)
from ..functions import credit
from ..functions.dates import file_snapshot, month_starts
from ..functions.numbers import outside, whole_number, zero_outside
from ..functions.text import keep_only, null_unless
from ..operators import features, labels, profiles, quality
from ..operators.joins import balanced_join, rows_with_repeated_key
from ..operators.silver import conform, with_arrears
from ..sources import tables
from ..sources.files import (
    CORRUPT,
    good_rows,
    load_report,
    scan_csv,
    scan_feed_files,
    slice_snapshots,
    with_source_file,
)
from . import derived
from .mart import FEATURES, LABELS, MATCHED_FEATURES, Mart
from .workdir import scratch_path

# Parameters of the registered queries.
DPD, MOB = 30, 6
LAST_INSTALLMENT = 7
STARTED_BEFORE = "2000-01-01"
ONE_SNAPSHOT = dt.date(1998, 6, 1)
LATE_MOB = 7
LOST_MONTH = dt.date(2024, 2, 1)
LATE_LOAN = "Student Loan"
BUCKETS = 8
CHANGED_CUSTOMER = "CUS_13"
EXACT_COLUMNS = ("Type_of_Loan", "Interest_Rate", "Annual_Income")

QUERIES: dict = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def comparable(df: DataFrame, *rounded: str) -> DataFrame:
    """Floats as doubles; the given columns rounded to six digits."""
    changed = {c: F.col(c).cast("double") for c, dtype in df.dtypes if dtype == "float"}
    changed |= {c: F.round(F.col(c).cast("double"), 6) for c in rounded}
    return df.withColumns(changed) if changed else df


# Cleaned feeds ------------------------------------------------------------


def loans(spark, sf_dir):
    return with_arrears(conform(derived.loans(spark, sf_dir), LOANS))


def attributes(spark, sf_dir):
    return conform(derived.attributes(spark, sf_dir), ATTRIBUTES)


def attributes_with_gaps(spark, sf_dir):
    """For joins: a tenth of the customers has no attributes."""
    return conform(derived.attributes_with_gaps(spark, sf_dir), ATTRIBUTES)


def financials(spark, sf_dir):
    return conform(derived.financials(spark, sf_dir), FINANCIALS)


def clicks(spark, sf_dir):
    return conform(derived.clickstream(spark, sf_dir), CLICKSTREAM)


def staged_loans(spark: SparkSession, sf_dir: str, *, gold: bool = False) -> Mart:
    """A new mart holding the loan table, and its labels on request."""
    mart = Mart(spark, scratch_path(spark, "staged"))
    mart.build_silver(LOANS, derived.loans(spark, sf_dir))
    if gold:
        mart.build_labels(DPD, MOB)
    return mart


def months_of(*raws: DataFrame) -> list[dt.date]:
    """The snapshots that the raw feeds hold."""
    found = tables.union_frames(*[r.select(F.col(SNAPSHOT).cast("date").alias(SNAPSHOT)) for r in raws])
    return sorted(r[SNAPSHOT] for r in tables.snapshot_dates(found).collect() if r[SNAPSHOT])


# Scans --------------------------------------------------------------------


@query
def scan_snapshot(spark, sf_dir):
    return comparable(staged_loans(spark, sf_dir).silver(LOANS, [ONE_SNAPSHOT]))


@query
def scan_all_snapshots(spark, sf_dir):
    return staged_loans(spark, sf_dir, gold=True).gold(LABELS)


@query
def preview_snapshot(spark, sf_dir):
    """A look at the newest snapshot that reads one of its files."""
    mart = Mart(spark, scratch_path(spark, "preview"))
    mart.build_silver(FINANCIALS, derived.financials(spark, sf_dir))
    return comparable(tables.preview_file(spark, mart.path("silver", FINANCIALS.table), ["Customer_ID"], 5))


@query
def discover_snapshots(spark, sf_dir):
    mart = staged_loans(spark, sf_dir)
    return tables.date_frame(spark, tables.stored_dates(spark, mart.path("silver", LOANS.table)))


@query
def latest_snapshot(spark, sf_dir):
    mart = staged_loans(spark, sf_dir)
    newest = tables.stored_dates(spark, mart.path("silver", LOANS.table))[-1]
    return comparable(mart.silver(LOANS, [newest]))


def monthly_files(raw: DataFrame, feed: feeds.Feed, folder: str) -> None:
    """CSV files for each snapshot, named as the feed's deliveries are, without that column.

    The first month has its columns in another order, the last one lacks the name. A large
    month has many files, the n-th ones of all months in the n-th subfolder.
    """
    spark = raw.sparkSession
    first, last = (F.col(SNAPSHOT).eqNullSafe(d) for d in raw.agg(F.min(SNAPSHOT), F.max(SNAPSHOT)).first())
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    columns = [c for c in raw.columns if c != SNAPSHOT]
    # One job for each header, whatever the number of months.
    headers = [
        (first, columns[::-1]),
        (~first & last, [c for c in columns if c != "Name"]),
        (~first & ~last, columns),
    ]
    for kind, (months, kept) in enumerate(headers):
        rows = raw.filter(months).select(*kept, SNAPSHOT).hint("rebalance", SNAPSHOT)
        rows.write.partitionBy(SNAPSHOT).option("header", True).csv(f"{folder}/_written-{kind}")
        for of_month in store.globStatus(path(f"{folder}/_written-{kind}/{SNAPSHOT}=*")) or []:
            date = of_month.getPath().getName().partition("=")[2]
            name = f"bronze_{feed.stem}_{date.replace('-', '_')}.csv"
            for n, part in enumerate(store.globStatus(path(f"{of_month.getPath().toString()}/part-*"))):
                store.mkdirs(path(f"{folder}/{n}"))
                if not store.rename(part.getPath(), path(f"{folder}/{n}/{name}")):
                    raise OSError(f"cannot rename {part.getPath().toString()}")


@query
def date_from_filename(spark, sf_dir):
    """The file each row came from, and the date in its name."""
    folder = scratch_path(spark, "dated")
    monthly_files(derived.attributes(spark, sf_dir), ATTRIBUTES, folder)
    rows = with_source_file(scan_csv(spark, f"{folder}/[0-9]*", schema="c string", pattern="*.csv", enforce=True))
    counted = rows.groupBy("source_file").agg(F.count("*").alias("n"))
    return counted.select("source_file", "n", file_snapshot("source_file").alias(SNAPSHOT))


@query
def silver_from_files(spark, sf_dir):
    """Monthly files with unlike headers, each read by its own."""
    folder = scratch_path(spark, "monthly")
    monthly_files(derived.attributes(spark, sf_dir), ATTRIBUTES, folder)
    mart = Mart(spark, scratch_path(spark, "monthly-mart"))
    mart.build_silver_from_files(ATTRIBUTES, f"{folder}/[0-9]*")
    return mart.silver(ATTRIBUTES)


@query
def typed_csv_scan(spark, sf_dir):
    """CSV read with inferred types."""
    path = scratch_path(spark, "typed")
    raw = derived.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    raw.write.option("header", True).csv(path)
    rows = scan_csv(spark, path, infer=True)
    return rows.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("bigint"), F.col("c_acctbal").cast("double"))


@query
def tolerant_csv_scan(spark, sf_dir):
    """CSV with a schema; rows that do not fit are kept with their text."""
    path = scratch_path(spark, "tolerant")
    derived.attributes(spark, sf_dir).select("Customer_ID", "Age").write.option("header", True).csv(path)
    rows = scan_csv(spark, path, schema="Customer_ID string, Age int", keep_corrupt=True)
    return rows.select("Customer_ID", "Age", F.col(CORRUPT).alias("corrupt"))


def _put(spark, path: str, content: bytes) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()


@query
def load_failures(spark, sf_dir):
    """A folder of many good files and some bad ones: outcome of every bad file by name, and all good rows."""
    folder = scratch_path(spark, "failures")
    columns = ["c_custkey", "c_name", "c_mktsegment"]
    raw = derived.table(spark, sf_dir, "customer").select(*columns)
    raw.repartition(12).write.option("header", True).csv(folder)
    header = ",".join(columns).encode()
    line = b"\n1,Nobody,NONE\n"
    _put(spark, f"{folder}/bad-empty.csv", b"")
    _put(spark, f"{folder}/bad-header-only.csv", header + b"\n")
    _put(spark, f"{folder}/bad-other-header.csv", b"c_name,c_custkey,c_mktsegment" + line)
    _put(spark, f"{folder}/bad-cut.csv.gz", gzip.compress(header + line * 5000)[:-40])
    report = load_report(spark, folder, columns)
    rows = good_rows(spark, folder, columns, report)
    name = F.element_at(F.split("path", "/"), -1)
    label = F.when(name.startswith("bad-"), name).otherwise("data").alias("file")
    found = rows.select(F.lit("data").alias("file"), "c_custkey").groupBy("file").agg(
        F.count("*").alias("rows_read"), F.sum(F.col("c_custkey").cast("bigint")).alias("key_sum")
    )
    return report.groupBy(label, "outcome").agg(F.sum("n").alias("n")).join(found, "file", "left")


@query
def multi_file_scan(spark, sf_dir):
    path = scratch_path(spark, "csv")
    tables.write_snapshots(derived.financials(spark, sf_dir), path, fmt="csv")
    rows = with_source_file(scan_csv(spark, path, pattern="part-*.csv", recursive=True))
    return rows.select(
        "Customer_ID",
        "Annual_Income",
        "Type_of_Loan",
        "Payment_Behaviour",
        F.col("source_file").endswith(".csv").alias("from_csv"),
    )


@query
def month_calendar(spark, sf_dir):
    orders = derived.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    bounds = orders.agg(F.min("day").alias("start"), F.max("day").alias("end"))
    months = bounds.select(F.explode(month_starts(F.col("start"), F.col("end"))).alias(SNAPSHOT))
    placed = orders.groupBy(F.trunc("day", "MM").alias(SNAPSHOT)).agg(F.count("*").alias("n_orders"))
    return months.join(placed, SNAPSHOT, "left").fillna(0, ["n_orders"])


# Sinks --------------------------------------------------------------------


@query
def write_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "attributes")
    rows = attributes(spark, sf_dir)
    tables.write_snapshots(rows, path)
    newest = tables.latest_snapshot(rows)
    tables.write_snapshots(newest, path)  # replaces one month, leaves the other
    return tables.read_snapshots(spark, path)


@query
def bronze_slice(spark, sf_dir):
    return slice_snapshots(derived.loans(spark, sf_dir), [ONE_SNAPSHOT])


@query
def bronze_backfill(spark, sf_dir):
    mart = Mart(spark, scratch_path(spark, "bronze"))
    sources = [derived.RAW[name](spark, sf_dir) for name in FEEDS]
    mart.backfill(list(FEEDS.values()), sources, None)
    stored = {name: mart.bronze(feed) for name, feed in FEEDS.items()}
    counts = quality.rows_by_domain(stored)
    return counts.filter(F.col("level") == 0).drop("level")


@query
def backfill_changed(spark, sf_dir):
    """A second backfill after the rows of one customer changed: which slices are written again."""
    mart = Mart(spark, scratch_path(spark, "changed"))
    kinds = [ATTRIBUTES, FINANCIALS]
    sources = [derived.attributes(spark, sf_dir), derived.financials(spark, sf_dir)]
    months = months_of(*sources)
    mart.backfill(kinds, sources, months, only_changed=True)
    before = {f.table: tables.live_versions(spark, mart.path("bronze", f.table)) for f in kinds}
    income = F.when(F.col("Customer_ID") == CHANGED_CUSTOMER, "1").otherwise(F.col("Annual_Income"))
    mart.backfill(kinds, [sources[0], sources[1].withColumn("Annual_Income", income)], months, only_changed=True)
    rewritten = [
        (table, date, version != before[table][date])
        for table in before
        for date, version in tables.live_versions(spark, mart.path("bronze", table)).items()
    ]
    counts = quality.rows_by_domain({f.table: mart.bronze(f) for f in kinds}).filter("level = 0").drop("level")
    return counts.join(spark.createDataFrame(rewritten, f"domain string, {SNAPSHOT} date, rewritten boolean"), ["domain", SNAPSHOT])


def _table_counts(mart: Mart, gold: tuple[str, ...], cleaned: list) -> DataFrame:
    built = {f"silver/{feed.table}": mart.silver(feed) for feed in cleaned}
    built |= {f"gold/{name}": mart.gold(name) for name in gold}
    counts = quality.rows_by_domain(built)
    return counts.filter(F.col("level") == 1).select("domain", "n")


@query
def mart_build(spark, sf_dir):
    mart = Mart(spark, scratch_path(spark, "mart"))
    sources = {name: raw(spark, sf_dir) for name, raw in derived.RAW.items()}
    mart.run(sources, None, dpd=DPD, mob=MOB)
    return _table_counts(mart, (LABELS, FEATURES), list(FEEDS.values()))


@query
def label_rebuild(spark, sf_dir):
    """Labels built again at another month on book: snapshots left empty must go."""
    mart = staged_loans(spark, sf_dir, gold=True)
    mart.build_labels(DPD, LATE_MOB)
    return mart.gold(LABELS)


@query
def feed_redelivery(spark, sf_dir):
    """A feed delivered again without one of its months."""
    mart = Mart(spark, scratch_path(spark, "redelivery"))
    raw = derived.financials(spark, sf_dir)
    months = months_of(raw)
    mart.run({FINANCIALS.table: raw}, months)
    mart.run({FINANCIALS.table: raw.filter(F.col(SNAPSHOT) != F.lit(LOST_MONTH).cast("string"))}, months)
    return _table_counts(mart, (FEATURES,), [FINANCIALS])


@query
def gold_incremental(spark, sf_dir):
    """Month by month, with a loan type that the first month does not have."""
    mart = Mart(spark, scratch_path(spark, "incremental"), buckets=BUCKETS)
    raw = derived.financials(spark, sf_dir)
    late = F.col("Type_of_Loan").contains(LATE_LOAN) & (F.col(SNAPSHOT) != F.lit(LOST_MONTH).cast("string"))
    raw = raw.filter(~F.coalesce(late, F.lit(False)))
    for month in months_of(raw):
        mart.run({FINANCIALS.table: raw}, [month])
    rows = mart.gold(FEATURES)
    return rows.select(*FEATURE_KEYS, *[c for c in rows.columns if c.startswith("loan_")], "Credit_History_Months")


@query
def matched_build(spark, sf_dir):
    """The written table of matched features, for the snapshots that all feeds have."""
    mart = Mart(spark, scratch_path(spark, "matched"), buckets=BUCKETS)
    for feed, raw in zip((ATTRIBUTES, FINANCIALS, CLICKSTREAM), _joined_feeds(spark, sf_dir)):
        mart.build_silver(feed, raw)
    mart.build_matched_features()
    return _comparable_features(mart.gold(MATCHED_FEATURES))


# Casts --------------------------------------------------------------------


@query
def loan_cast(spark, sf_dir):
    return comparable(conform(derived.loans(spark, sf_dir), LOANS))


@query
def attributes_cast(spark, sf_dir):
    return conform(
        derived.attributes(spark, sf_dir), replace(ATTRIBUTES, keep={}, allowed={}, ranges={})
    )


@query
def financials_cast(spark, sf_dir):
    bare = replace(FINANCIALS, keep={}, allowed={}, ranges={})
    return comparable(conform(derived.financials(spark, sf_dir), bare))


@query
def clickstream_cast(spark, sf_dir):
    return conform(derived.clickstream_with_faults(spark, sf_dir), CLICKSTREAM)


@query
def attributes_schema_only(spark, sf_dir):
    return conform(derived.attributes(spark, sf_dir), ATTRIBUTES_TYPED_ONLY)


@query
def financials_unsigned(spark, sf_dir):
    return comparable(conform(derived.financials(spark, sf_dir), FINANCIALS_UNSIGNED))


# Cleaning rules -----------------------------------------------------------


@query
def clean_ssn(spark, sf_dir):
    digits = keep_only(F.col("SSN"), feeds.SSN_KEEP)
    return derived.attributes(spark, sf_dir).select(
        "Customer_ID", null_unless(digits, feeds.SSN_PATTERN).alias("SSN")
    )


@query
def enforce_age(spark, sf_dir):
    age = zero_outside(whole_number("Age"), *feeds.AGE_RANGE)
    return derived.attributes(spark, sf_dir).select("Customer_ID", age.alias("Age"))


@query
def clean_occupation(spark, sf_dir):
    return derived.attributes(spark, sf_dir).select(
        "Customer_ID",
        null_unless(F.col("Occupation"), feeds.OCCUPATION_PATTERN).alias("Occupation"),
    )


@query
def clean_numerics(spark, sf_dir):
    return derived.financials(spark, sf_dir).select(
        "Customer_ID",
        *[keep_only(F.col(c), feeds.MONEY_KEEP).alias(c) for c in feeds.MONEY_COLUMNS],
    )


def _interest(spark, sf_dir, fill_null):
    rate = whole_number("Interest_Rate")
    rate = zero_outside(rate, *feeds.INTEREST_RANGE, fill_null=fill_null)
    return derived.financials(spark, sf_dir).select("Customer_ID", rate.alias("Interest_Rate"))


@query
def enforce_interest_rate(spark, sf_dir):
    return _interest(spark, sf_dir, fill_null=False)


@query
def interest_rate_null_to_zero(spark, sf_dir):
    return _interest(spark, sf_dir, fill_null=True)


@query
def clean_payment_behaviour(spark, sf_dir):
    return derived.financials(spark, sf_dir).select(
        "Customer_ID",
        null_unless(F.col("Payment_Behaviour"), feeds.BEHAVIOUR_PATTERN).alias("Payment_Behaviour"),
    )


@query
def clickstream_validate(spark, sf_dir):
    return quality.click_integrity(derived.clickstream_with_faults(spark, sf_dir))


# Cleaned tables -----------------------------------------------------------


@query
def loan_silver(spark, sf_dir):
    return comparable(loans(spark, sf_dir))


@query
def loan_dpd(spark, sf_dir):
    return loans(spark, sf_dir).select(
        "loan_id", SNAPSHOT, "installments_missed", "first_missed_date", "dpd"
    )


@query
def attributes_silver(spark, sf_dir):
    return attributes(spark, sf_dir)


@query
def financials_silver(spark, sf_dir):
    return comparable(financials(spark, sf_dir))


@query
def clickstream_silver(spark, sf_dir):
    return clicks(spark, sf_dir)


# Labels -------------------------------------------------------------------


@query
def label_store(spark, sf_dir):
    return labels.label_table(loans(spark, sf_dir), DPD, MOB)


@query
def bad_rate_by_mob(spark, sf_dir):
    return comparable(labels.bad_rate_by_month(loans(spark, sf_dir), DPD, STARTED_BEFORE), "bad_rate")


@query
def actual_bads(spark, sf_dir):
    flagged = labels.flagged_loans(loans(spark, sf_dir), DPD, STARTED_BEFORE)
    return comparable(labels.final_rows(flagged, LAST_INSTALLMENT))


# Features -----------------------------------------------------------------


@query
def loan_list(spark, sf_dir):
    items = credit.loan_items(F.col("Type_of_Loan"))
    return derived.financials(spark, sf_dir).select(
        "Customer_ID", F.array_join(items, "|").alias("items"), F.array_size(items).alias("n_items")
    )


@query
def loan_vocabulary(spark, sf_dir):
    return features.loan_vocabulary(financials(spark, sf_dir))


@query
def loan_types_long(spark, sf_dir):
    return features.loan_long(financials(spark, sf_dir))


@query
def one_hot_loans(spark, sf_dir):
    flagged = features.with_loan_flags(financials(spark, sf_dir))
    return flagged.select(*FEATURE_KEYS, *[c for c in flagged.columns if c.startswith("loan_")])


@query
def credit_history_months(spark, sf_dir):
    rows = features.with_history_months(financials(spark, sf_dir))
    return rows.select(*FEATURE_KEYS, "Credit_History_Age", "Credit_History_Months")


@query
def clickstream_dedup(spark, sf_dir):
    return comparable(features.click_means(clicks(spark, sf_dir)), *CLICK_FEATURES)


@query
def debt_to_income(spark, sf_dir):
    rows = features.with_debt_ratio(financials(spark, sf_dir))
    ratio = rows.select(*FEATURE_KEYS, "Annual_Income", "Outstanding_Debt", "Debt_to_Income_Ratio")
    return comparable(ratio, "Debt_to_Income_Ratio")


@query
def monthly_savings(spark, sf_dir):
    rows = features.with_savings(financials(spark, sf_dir))
    return comparable(rows.select(*FEATURE_KEYS, "Monthly_Savings"))


def _joined_feeds(spark, sf_dir) -> list[DataFrame]:
    return [raw(spark, sf_dir) for raw in (derived.attributes_with_gaps, derived.financials, derived.clickstream)]


def _comparable_features(df: DataFrame) -> DataFrame:
    return comparable(df, *CLICK_FEATURES, "Debt_to_Income_Ratio")


@query
def gold_features(spark, sf_dir):
    return _comparable_features(
        features.feature_table(
            financials(spark, sf_dir), attributes_with_gaps(spark, sf_dir), clicks(spark, sf_dir)
        )
    )


@query
def gold_optional_missing(spark, sf_dir):
    absent = scratch_path(spark, "absent")
    empty = [
        tables.optional_snapshots(spark, f"{absent}/{f.table}", f.ddl())
        for f in (ATTRIBUTES, CLICKSTREAM)
    ]
    return _comparable_features(features.feature_table(financials(spark, sf_dir), *empty))


@query
def gold_features_inner(spark, sf_dir):
    return _comparable_features(
        features.matched_feature_table(
            attributes_with_gaps(spark, sf_dir), financials(spark, sf_dir), clicks(spark, sf_dir)
        )
    )


@query
def common_snapshots(spark, sf_dir):
    return tables.common_snapshots(
        attributes(spark, sf_dir), financials(spark, sf_dir), clicks(spark, sf_dir)
    )


@query
def gold_common_snapshots(spark, sf_dir):
    """Common dates are settled once, from the date columns alone, and then filter all three feeds."""
    raws = _joined_feeds(spark, sf_dir)
    cleaned = [conform(r, f) for r, f in zip(raws, (ATTRIBUTES, FINANCIALS, CLICKSTREAM))]
    dates = [r[SNAPSHOT] for r in tables.common_snapshots(*cleaned).collect()]
    kept = [slice_snapshots(r, dates) for r in raws]
    return _comparable_features(
        features.matched_feature_table(*[conform(r, f) for r, f in zip(kept, (ATTRIBUTES, FINANCIALS, CLICKSTREAM))])
    )


@query
def skewed_join(spark, sf_dir):
    """Every pair of a user's events in odd or in even hours, over whole tables: one user holds a third."""
    events = derived.table(spark, sf_dir, "events")
    user = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("user")
    band = (F.hour("ts") % 2).alias("band")
    one, other = events.select(user, band, F.col("value").alias("a")), events.select(user, band, F.col("value").alias("b"))
    joined = balanced_join(one, other, ("user", "band"), "inner", rows_per_cell=500)
    return joined.groupBy("user", "band").agg(
        F.count("*").alias("n"), F.sum((F.floor("a") * F.floor("b")).cast("bigint")).alias("s")
    )


@query
def skewed_join_all_rows(spark, sf_dir):
    """Every pair of a user's events within an hour of the day, over whole tables: one user holds a third."""
    events = derived.table(spark, sf_dir, "events")
    user = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("user")
    band = F.hour("ts").alias("band")
    one, other = events.select(user, band, F.col("value").alias("a")), events.select(user, band, F.col("value").alias("b"))
    joined = balanced_join(one, other, ("user", "band"), "inner", rows_per_cell=16)
    return joined.groupBy("user", "band").agg(
        F.count("*").alias("n"), F.sum((F.floor("a") * F.floor("b")).cast("bigint")).alias("s")
    )


# Quality ------------------------------------------------------------------


def _draft_attributes(spark, sf_dir):
    return conform(derived.attributes(spark, sf_dir), ATTRIBUTES_TYPED_ONLY)


def _draft_financials(spark, sf_dir):
    return conform(derived.financials(spark, sf_dir), FINANCIALS_UNSIGNED)


@query
def row_count(spark, sf_dir):
    return quality.row_count(loans(spark, sf_dir))


@query
def row_count_by_snapshot(spark, sf_dir):
    return quality.rows_by_snapshot(loans(spark, sf_dir))


@query
def row_count_by_domain(spark, sf_dir):
    return quality.rows_by_domain(
        {
            "attributes": attributes(spark, sf_dir),
            "financials": financials(spark, sf_dir),
            "clickstream": clicks(spark, sf_dir),
        }
    )


@query
def null_profile(spark, sf_dir):
    return quality.null_counts(financials(spark, sf_dir))


@query
def clickstream_null_zero(spark, sf_dir):
    typed = conform(derived.clickstream_with_faults(spark, sf_dir), CLICKSTREAM)
    return quality.null_and_zero_counts(typed)


@query
def profile_table(spark, sf_dir):
    return comparable(quality.profile(financials(spark, sf_dir)), "pct_missing")


def _profiled_by_month(spark, sf_dir) -> Mart:
    """Financials that arrive month by month, each month profiled when it comes."""
    mart = Mart(spark, scratch_path(spark, "profiled"))
    raw = derived.financials(spark, sf_dir)
    for month in months_of(raw):
        mart.build_silver(FINANCIALS, slice_snapshots(raw, [month]))
        mart.refresh_profiles(FINANCIALS, EXACT_COLUMNS)
    return mart


@query
def profile_accumulated(spark, sf_dir):
    """The profile of all months, merged from states that were made a month at a time."""
    mart = _profiled_by_month(spark, sf_dir)
    merged = profiles.merged_profile(mart.profile_states(FINANCIALS)).drop("distinct_estimate")
    exact = profiles.merged_distinct(mart.distinct_states(FINANCIALS, EXACT_COLUMNS))
    return comparable(merged.join(exact, "column_name", "left"), "pct_missing")


@query
def describe_accumulated(spark, sf_dir):
    """Moments and extremes of all months, merged from the states of single ones."""
    mart = _profiled_by_month(spark, sf_dir)
    return comparable(profiles.merged_moments(mart.profile_states(FINANCIALS)), "mean", "stddev")


@query
def describe_numeric(spark, sf_dir):
    ages = quality.describe_numeric(_draft_attributes(spark, sf_dir), ["Age"])
    values = quality.describe_numeric(clicks(spark, sf_dir), list(CLICK_FEATURES))
    return comparable(ages.unionByName(values), "mean", "stddev")


@query
def duplicate_stats(spark, sf_dir):
    people = quality.duplicate_stats(
        _draft_attributes(spark, sf_dir), ["Customer_ID", SNAPSHOT, "SSN"]
    )
    events = quality.duplicate_stats(clicks(spark, sf_dir), list(FEATURE_KEYS))
    return people.withColumn("domain", F.lit("attributes")).unionByName(
        events.withColumn("domain", F.lit("clickstream"))
    )


@query
def duplicate_keys(spark, sf_dir):
    return quality.repeated_values(_draft_attributes(spark, sf_dir), "SSN")


@query
def duplicate_rows(spark, sf_dir):
    return rows_with_repeated_key(_draft_attributes(spark, sf_dir), "SSN")


@query
def out_of_range_count(spark, sf_dir):
    ages = quality.rule_violations(
        _draft_attributes(spark, sf_dir), {"Age": outside(F.col("Age"), *feeds.AGE_RANGE)}
    )
    rates = quality.rule_violations(
        _draft_financials(spark, sf_dir),
        {"Interest_Rate": outside(F.col("Interest_Rate"), *feeds.INTEREST_RANGE)},
    )
    return ages.unionByName(rates)


@query
def invalid_category_values(spark, sf_dir):
    return quality.values_outside(
        _draft_financials(spark, sf_dir), "Payment_of_Min_Amount", feeds.MIN_PAYMENT_ANSWERS
    )


@query
def special_char_count(spark, sf_dir):
    special = F.col("Payment_Behaviour").rlike(feeds.SPECIAL_CHARACTER)
    return _draft_financials(spark, sf_dir).agg(F.count_if(special).alias("n"))


@query
def rule_violations(spark, sf_dir):
    rate, answer = F.col("Interest_Rate"), F.col("Payment_of_Min_Amount")
    behaviour = F.col("Payment_Behaviour")
    return quality.rule_violations(
        _draft_financials(spark, sf_dir),
        {
            "interest rate out of range": outside(rate, *feeds.INTEREST_RANGE),
            "interest rate missing": rate.isNull(),
            "minimum payment not yes or no": ~answer.isin(*feeds.MIN_PAYMENT_ANSWERS),
            "behaviour has special characters": behaviour.rlike(feeds.SPECIAL_CHARACTER),
            "behaviour not allowed": ~behaviour.rlike(feeds.BEHAVIOUR_PATTERN),
        },
    )


@query
def distinct_values(spark, sf_dir):
    rates = _draft_financials(spark, sf_dir)
    bad = rates.filter(outside(F.col("Interest_Rate"), *feeds.INTEREST_RANGE))
    return quality.distinct_values(bad, "Interest_Rate")


@query
def distinct_ages_sorted(spark, sf_dir):
    return quality.distinct_values(attributes(spark, sf_dir), "Age").orderBy("Age")


@query
def union_feeds(spark, sf_dir):
    """All months of a feed, each its own frame, stacked."""
    rows = _draft_attributes(spark, sf_dir)
    months = sorted(r[SNAPSHOT] for r in tables.snapshot_dates(rows).filter(F.col(SNAPSHOT).isNotNull()).collect())
    return tables.union_frames(*[rows.filter(F.col(SNAPSHOT) == F.lit(d)) for d in months])

"""The whole build from CSV files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapmart.feeds import ATTRIBUTES, CLICKSTREAM, FEEDS, FINANCIALS, LOANS
from snapmart.functions.dates import month_list
from snapmart.plans import derived
from snapmart.plans.mart import FEATURES, LABELS, MATCHED_FEATURES, Mart, NoSnapshots
from snapmart.sources.files import slice_snapshots
from snapmart.sources.tables import latest_snapshot

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def dates(spark):
    return month_list(spark, "1990-01-01", "2030-12-01")


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Raw feeds as CSV folders."""
    root = tmp_path_factory.mktemp("raw")
    paths = {}
    for name, raw in derived.RAW.items():
        paths[name] = str(root / FEEDS[name].stem)
        raw(spark, SF).write.option("header", True).csv(paths[name])
    return paths


@pytest.fixture(scope="module")
def mart(spark, sources, dates, tmp_path_factory):
    built = Mart(spark, str(tmp_path_factory.mktemp("mart")))
    built.counts = built.run(sources, dates)
    return built


def same(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_counts(spark, mart):
    assert mart.counts["bronze/loan_daily"] == mart.counts["silver/loan_daily"] == 6000
    assert mart.counts["silver/financials"] == mart.counts["gold/feature_store"] == 150
    assert mart.counts["gold/label_store"] == 850
    for table, n in mart.counts.items():
        layer, name = table.split("/")
        assert spark.read.parquet(mart.path(layer, name)).count() == n


def test_csv_and_typed_loans_agree(spark, mart):
    from snapmart.operators.silver import conform, with_arrears

    assert same(mart.silver(LOANS), with_arrears(conform(derived.loans(spark, SF), LOANS)))


def test_csv_bronze_gives_the_same_silver(spark, mart, sources, dates, tmp_path):
    other = Mart(spark, str(tmp_path), bronze_format="csv")
    for feed in (ATTRIBUTES, FINANCIALS):
        other.ingest(feed, sources[feed.table], dates)
        other.build_silver(feed)
        assert same(mart.silver(feed), other.silver(feed))


def test_one_run_per_month_equals_one_run(spark, mart, sources, tmp_path):
    other = Mart(spark, str(tmp_path))
    for date in (dt.date(2024, 1, 1), dt.date(2024, 2, 1)):
        for feed in (ATTRIBUTES, FINANCIALS, CLICKSTREAM):
            other.ingest(feed, sources[feed.table], [date])
            other.build_silver(feed, dates=[date])
    for date in (dt.date(2024, 1, 1), dt.date(2024, 2, 1)):
        other.build_features([date])
    assert same(mart.gold(FEATURES), other.gold(FEATURES))


def test_running_again_changes_nothing(spark, mart):
    before = mart.gold(FEATURES).collect()
    mart.build_features()
    assert sorted(map(str, mart.gold(FEATURES).collect())) == sorted(map(str, before))


def test_features_without_the_optional_tables(spark, sources, dates, tmp_path):
    alone = Mart(spark, str(tmp_path))
    counts = alone.run({"financials": sources["financials"]}, dates)
    assert counts["gold/feature_store"] == 150
    with pytest.raises(NoSnapshots):
        alone.silver(ATTRIBUTES)


def test_feed_without_rows_in_the_period(spark, sources, tmp_path):
    quiet = Mart(spark, str(tmp_path))
    dates = [dt.date(2024, 2, 1)]  # no clicks in February
    counts = quiet.run({t: sources[t] for t in ("financials", "clickstream")}, dates)
    assert counts["bronze/clickstream"] == counts["silver/clickstream"] == 0
    assert counts["gold/feature_store"] == counts["silver/financials"] > 0


def test_matched_features_need_all_three(spark, mart):
    n = mart.build_matched_features()
    gold = mart.gold(MATCHED_FEATURES)
    # Clicks exist for one month only.
    assert [r.snapshot_date for r in gold.select("snapshot_date").distinct().collect()] == [dt.date(2024, 1, 1)]
    january = mart.silver(ATTRIBUTES, [dt.date(2024, 1, 1)])
    assert gold.count() == n == january.count()
    assert "Monthly_Savings" in gold.columns


def test_backfill_returns_every_slice(spark, sources, tmp_path):
    store = Mart(spark, str(tmp_path))
    dates = [dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)]
    slices = store.backfill([ATTRIBUTES, FINANCIALS], [sources["attributes"], sources["financials"]], dates)
    assert len(slices) == 6 and set(slices) == {(t, d) for t in ("attributes", "financials") for d in dates}
    raw = derived.attributes(spark, SF)
    for date in dates:
        assert slices["attributes", date].count() == slice_snapshots(raw, [date]).count()
    with pytest.raises(KeyError):
        slices["attributes", dt.date(1999, 1, 1)]
    every = store.backfill([ATTRIBUTES, FINANCIALS], [sources["attributes"], sources["financials"]], None)
    assert set(every) == {(t, d) for t in ("attributes", "financials") for d in dates[:2]}
    with pytest.raises(ValueError, match="2 feeds but 1 sources"):
        store.backfill([ATTRIBUTES, FINANCIALS], [sources["attributes"]], dates)


def test_silver_from_dated_files(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    (folder / "bronze_features_attributes_2024_01_01.csv").write_text(
        "Customer_ID,Name,Age,SSN,Occupation,snapshot_date\n1,A,20,123-45-6789,Engineer,2024-01-01\n"
    )
    store = Mart(spark, str(tmp_path / "mart"))
    assert store.build_silver_from_files(ATTRIBUTES, str(folder)) == 1
    row = store.silver(ATTRIBUTES).first()
    assert (row.Age, row.SSN, row.snapshot_date) == (20, "123-45-6789", dt.date(2024, 1, 1))


def test_latest_labels(spark, mart):
    labels = mart.gold(LABELS)
    newest = latest_snapshot(labels)
    top = labels.agg(F.max("snapshot_date")).first()[0]
    assert newest.count() == labels.filter(F.col("snapshot_date") == F.lit(top)).count() > 0


def test_rebuild_leaves_no_row_of_the_first_build(spark, sources, dates, tmp_path):
    store = Mart(spark, str(tmp_path))
    store.run({"loan_daily": sources["loan_daily"]}, dates)
    n = store.build_labels(30, 7)
    gold = store.gold(LABELS)
    assert gold.count() == n and {r.label_def for r in gold.select("label_def").distinct().collect()} == {"30dpd_7mob"}
    # Some dates only: the others keep what they hold.
    one = gold.first().snapshot_date
    kept = gold.filter(F.col("snapshot_date") != F.lit(one)).count()
    store.build_labels(30, 6, [one])
    assert store.gold(LABELS).filter("label_def = '30dpd_7mob'").count() == kept


def test_month_missing_in_a_second_delivery_goes_from_every_layer(spark, tmp_path):
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    raw = derived.financials(spark, SF)
    store = Mart(spark, str(tmp_path))
    store.run({"financials": raw}, months)
    january = raw.filter("snapshot_date = '2024-01-01'")
    counts = store.run({"financials": january}, months)
    assert counts["silver/financials"] == counts["gold/feature_store"] == january.count()
    for table in (store.bronze(FINANCIALS), store.silver(FINANCIALS), store.gold(FEATURES)):
        assert table.count() == january.count()
    assert store.run({"financials": raw.filter("false")}, months)["gold/feature_store"] == 0


def test_loan_type_that_comes_late(spark, tmp_path):
    months = [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    raw = derived.financials(spark, SF).withColumn(
        "Type_of_Loan",
        F.expr("CASE WHEN Type_of_Loan IS NULL THEN NULL WHEN snapshot_date = '2024-01-01' THEN 'Auto Loan' "
               "ELSE 'Auto Loan, and Payday Loan' END"),
    )
    step, whole = Mart(spark, str(tmp_path / "step")), Mart(spark, str(tmp_path / "whole"))
    for month in months:
        step.run({"financials": raw}, [month])
    whole.run({"financials": raw}, months)
    assert "loan_payday_loan" in step.gold(FEATURES).columns
    assert same(step.gold(FEATURES), whole.gold(FEATURES))
    assert same(step.gold(FEATURES, months[:1]), whole.gold(FEATURES, months[:1]))


def test_any_number_of_loan_types(spark):
    from snapmart.operators.features import with_loan_flags

    rows = spark.range(1200).selectExpr("concat('Type ', id) AS Type_of_Loan", "'c' AS Customer_ID", "date'2024-01-01' AS snapshot_date")
    assert len(with_loan_flags(rows).columns) == 1203


def test_silver_from_bronze_does_not_shuffle(spark, mart):
    from snapmart.operators.silver import conform

    rows = conform(mart.bronze(ATTRIBUTES), ATTRIBUTES)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


def test_dates_come_from_folder_names(spark, mart):
    from snapmart.sources.tables import NoSnapshots, stored_dates

    dates = stored_dates(spark, mart.path("silver", "attributes"))
    assert dates == [dt.date(2024, 1, 1), dt.date(2024, 2, 1)]
    assert mart.common_dates(ATTRIBUTES, FINANCIALS, CLICKSTREAM) == dates[:1]
    with pytest.raises(NoSnapshots):
        stored_dates(spark, mart.path("silver", "none"))


def test_labels_push_the_month_into_the_silver_scan(spark, mart):
    from snapmart.operators.labels import label_table

    text = label_table(mart.silver(LOANS))._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mob,6)" in text
    assert "ReadSchema: struct<loan_id:string,Customer_ID:string,mob:int,dpd:int>" in text

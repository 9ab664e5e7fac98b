"""Replacement through manifests, states by snapshot, one-file previews, load reports."""

import datetime as dt
import gzip

import pytest
from pyspark.sql import functions as F

from snapmart.feeds import ATTRIBUTES, CLICKSTREAM, FINANCIALS
from snapmart.operators import profiles, quality
from snapmart.plans import derived
from snapmart.plans.mart import FEATURES, LOAN_TYPES, Mart, fingerprints
from snapmart.sources import tables
from snapmart.sources.files import good_rows, load_report, scan_csv
from snapmart.sources.inference import inferred_types, typed
from snapmart.sources.states import refresh, stale_snapshots

SF = "/root/testdata/sf0.001"
JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


def rows(spark, *data):
    return spark.createDataFrame(list(data), "k string, v int, snapshot_date date")


def content(df):
    return sorted((r.k, r.v, r.snapshot_date) for r in df.collect())


def test_write_that_dies_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.write_snapshots(rows(spark, ("a", 1, JAN), ("b", 2, FEB)), path)
    reader = tables.read_snapshots(spark, path)

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(tables, "commit", die)
        with pytest.raises(KeyboardInterrupt):
            tables.write_snapshots(rows(spark, ("c", 3, JAN), ("d", 4, MAR)), path, dates=tables.ALL)
    want = [("a", 1, JAN), ("b", 2, FEB)]
    assert content(tables.read_snapshots(spark, path)) == content(reader) == want
    assert tables.remove_orphans(spark, path) == 2 and tables.remove_orphans(spark, path) == 0
    assert content(tables.read_snapshots(spark, path)) == want
    tables.write_snapshots(rows(spark, ("c", 3, JAN)), path, dates=tables.ALL)
    assert content(tables.read_snapshots(spark, path)) == [("c", 3, JAN)]


def test_reader_that_planned_before_the_switch_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(rows(spark, ("a", 1, JAN)), path)
    reader = tables.read_snapshots(spark, path)
    tables.write_snapshots(rows(spark, ("b", 2, JAN)), path)
    assert content(reader) == [("a", 1, JAN)] and content(tables.read_snapshots(spark, path)) == [("b", 2, JAN)]
    for k in range(4):
        tables.write_snapshots(rows(spark, ("c", k, JAN)), path)
    # Only the live and the former version are left.
    assert len(list(tmp_path.glob("t/snapshot_date=*/snapshot_version=*"))) == 1 + tables.KEPT_MANIFESTS
    assert len(list(tmp_path.glob("t/_manifests/*.json"))) == 1 + tables.KEPT_MANIFESTS


def test_second_of_two_writers_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(rows(spark, ("a", 1, JAN)), path)
    known = tables.manifest(spark, path)
    tables.write_snapshots(rows(spark, ("b", 2, JAN)), path)
    with pytest.raises(tables.ConcurrentWrite):
        tables.commit(spark, path, tables.Manifest(known.number + 1, known.versions))
    assert content(tables.read_snapshots(spark, path)) == [("b", 2, JAN)]


def test_plain_folders_are_read_but_not_written(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, ("a", 1, JAN), ("b", 2, FEB)).write.partitionBy("snapshot_date").parquet(path)
    assert content(tables.read_snapshots(spark, path, dates=[FEB])) == [("b", 2, FEB)]
    assert tables.stored_dates(spark, path) == [JAN, FEB]
    with pytest.raises(ValueError, match="no manifest"):
        tables.write_snapshots(rows(spark, ("c", 1, MAR)), path)


def test_only_wanted_folders_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshots(rows(spark, ("a", 1, JAN), ("b", 2, FEB), ("c", 3, None)), path)
    one = tables.read_snapshots(spark, path, dates=[FEB])
    assert "InMemoryFileIndex(1 paths)" in one._jdf.queryExecution().executedPlan().toString()
    assert {r.k for r in tables.read_snapshots(spark, path, dates=[FEB, None]).collect()} == {"b", "c"}
    assert tables.read_snapshots(spark, path, dates=[MAR]).count() == 0


def test_calls_of_a_write_do_not_grow_with_the_months(spark, tmp_path, monkeypatch):
    def calls(months):
        made = []
        path = str(tmp_path / f"t{months}")
        df = spark.range(months).selectExpr("string(id) k", "int(id) v", "add_months(date'2000-01-01', int(id)) snapshot_date")
        with monkeypatch.context() as watched:
            own = tables._folder
            watched.setattr(tables, "_folder", lambda *a: made.append(a) or own(*a))
            tables.write_snapshots(df, path)
        assert len(tables.stored_dates(spark, path)) == months
        return len(made)

    assert calls(2) == calls(40)


def test_preview_reads_one_file(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(50).selectExpr("string(100 + id) k", "int(id) v", "add_months(date'2024-01-01', int(id) % 3) snapshot_date")
    tables.write_snapshots(df, path, max_records_per_file=10)
    got = tables.preview_file(spark, path, ["k"], 5)
    assert len(got.inputFiles()) == 1 and got.count() == 5
    assert {r.snapshot_date for r in got.collect()} == {MAR}
    everything = tables.preview_file(spark, path, ["k"], 100, date=JAN)
    assert len(everything.inputFiles()) == 1 and everything.count() == 10
    with pytest.raises(tables.NoSnapshots):
        tables.preview_file(spark, path, ["k"], date=dt.date(1999, 1, 1))


# States by snapshot


def test_states_follow_new_rewritten_and_removed_snapshots(spark, tmp_path):
    source, path = str(tmp_path / "s"), str(tmp_path / "states")
    built = []

    def build(df):
        built.append(sorted(r.snapshot_date for r in tables.snapshot_dates(df).collect()))
        return df.groupBy("snapshot_date").agg(F.sum("v").alias("v"), F.lit("sum").alias("k"))

    tables.write_snapshots(rows(spark, ("a", 1, JAN), ("b", 2, FEB)), source)
    assert sorted(refresh(spark, source, path, build)) == [JAN, FEB]
    assert refresh(spark, source, path, build) == []
    tables.write_snapshots(rows(spark, ("c", 5, FEB), ("d", 6, MAR)), source)
    assert sorted(refresh(spark, source, path, build)) == [FEB, MAR]
    assert built == [[JAN, FEB], [FEB, MAR]]
    assert content(tables.read_snapshots(spark, path)) == [("sum", 1, JAN), ("sum", 5, FEB), ("sum", 6, MAR)]
    tables.drop_snapshots(spark, source, [JAN])
    assert refresh(spark, source, path, build) == []
    assert content(tables.read_snapshots(spark, path)) == [("sum", 5, FEB), ("sum", 6, MAR)]
    assert stale_snapshots(spark, source, path) == ([], [])


def test_new_month_reads_its_own_loan_lists_only(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    raw = derived.financials(spark, SF)
    mart.run({"financials": raw}, [JAN])
    mart.ingest(FINANCIALS, raw, [FEB])
    mart.build_silver(FINANCIALS, dates=[FEB])
    silver, kept = mart.path("silver", "financials"), mart.path("gold", LOAN_TYPES)
    assert stale_snapshots(spark, silver, kept) == ([FEB], [])
    scan = tables.read_snapshots(spark, silver, dates=[FEB]).select("Type_of_Loan")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in text and "PartitionFilters: [isnotnull(snapshot_date" in text
    before = tables.live_versions(spark, kept)
    mart.build_features([FEB])
    after = tables.live_versions(spark, kept)
    assert after[JAN] == before[JAN] and FEB in after
    whole = Mart(spark, str(tmp_path / "whole"))
    whole.run({"financials": raw}, [JAN, FEB])
    assert mart.vocabulary() == whole.vocabulary() != []
    assert sorted(map(str, mart.gold(FEATURES).collect())) == sorted(map(str, whole.gold(FEATURES).collect()))


def test_month_without_loan_lists_is_read_once(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    raw = derived.financials(spark, SF).withColumn("Type_of_Loan", F.lit(None).cast("string"))
    mart.run({"financials": raw}, None)
    assert mart.vocabulary() == [] and mart.refresh_vocabulary() == []


def test_merged_states_equal_one_pass(spark, tmp_path):
    from snapmart.operators.silver import conform

    df = conform(derived.financials(spark, SF), FINANCIALS).cache()
    states = profiles.column_states(df)
    assert states.columns == [c.strip().split()[0] for c in profiles.STATE_SCHEMA.split(",")]
    merged = {r.column_name: r for r in profiles.merged_profile(states).collect()}
    assert set(merged) == set(df.columns) - {"snapshot_date"}
    for r in quality.profile(df).collect():
        if r.column_name in merged:
            m = merged[r.column_name]
            assert (m.dtype, m.missing, m.zeros) == (r.dtype, r.missing, r.zeros) and m.pct_missing == pytest.approx(r.pct_missing)
    columns = ["Customer_ID", "Type_of_Loan", "Interest_Rate"]
    exact = {r.column_name: r.distinct_values for r in profiles.merged_distinct(profiles.distinct_states(df, columns)).collect()}
    for r in quality.duplicate_stats(df, columns).collect():
        assert exact[r.column_name] == r.distinct_values
        assert abs(merged[r.column_name].distinct_estimate - r.distinct_values) <= max(1, 3 * profiles.SKETCH_ERROR * r.distinct_values)
    moments = {r.column_name: r for r in profiles.merged_moments(states).collect()}
    for r in quality.describe_numeric(df).collect():
        m = moments[r.column_name]
        assert (m.n, m.min, m.max) == (r.n, r.min, r.max)
        assert m.mean == pytest.approx(r.mean) and m.stddev == pytest.approx(r.stddev)
    assert profiles.merged_profile(profiles.column_states(df.filter("false"))).count() == 0


def test_sketches_estimate_within_their_error(spark):
    df = spark.range(60_000).selectExpr("id % 20000 AS v", "add_months(date'2024-01-01', int(id % 5)) AS snapshot_date")
    got = profiles.merged_profile(profiles.column_states(df)).first()
    assert abs(got.distinct_estimate - 20_000) < 4 * profiles.SKETCH_ERROR * 20_000


def test_new_month_is_profiled_alone(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    raw = derived.financials(spark, SF)
    for month in (JAN, FEB):
        mart.ingest(FINANCIALS, raw, [month])
        mart.build_silver(FINANCIALS, dates=[month])
        assert mart.refresh_profiles(FINANCIALS, ("Interest_Rate",)) == [month]
    assert mart.refresh_profiles(FINANCIALS, ("Interest_Rate",)) == []


# Backfill of what changed


def test_backfill_writes_changed_slices_only(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    raw = derived.financials(spark, SF)
    path = mart.path("bronze", "financials")

    def files():
        return {p for p in tmp_path.rglob("part-*") if "bronze" in str(p)}

    assert mart.ingest(FINANCIALS, raw, [JAN, FEB], only_changed=True) == raw.count()
    first, held = tables.live_versions(spark, path), files()
    assert mart.ingest(FINANCIALS, raw.repartition(3), [JAN, FEB], only_changed=True) == 0
    assert tables.live_versions(spark, path) == first and files() == held
    other = raw.withColumn("Credit_Mix", F.when(F.col("Customer_ID") == "CUS_13", None).otherwise(F.col("Credit_Mix")))
    february = raw.filter("snapshot_date = '2024-02-01'").count()
    assert mart.ingest(FINANCIALS, other, [JAN, FEB], only_changed=True) == february
    second = tables.live_versions(spark, path)
    assert second[JAN] == first[JAN] and second[FEB] != first[FEB]
    assert mart.bronze(FINANCIALS).filter("Customer_ID = 'CUS_13'").first().Credit_Mix is None
    # A plain ingest forgets the fingerprint, a lost month goes.
    mart.ingest(FINANCIALS, raw, [FEB])
    assert mart.ingest(FINANCIALS, other, [JAN, FEB], only_changed=True) == february
    assert mart.ingest(FINANCIALS, raw.filter("snapshot_date = '2024-01-01'"), [JAN, FEB], only_changed=True) == 0
    assert set(tables.live_versions(spark, path)) == {JAN}


def test_fingerprints_see_nulls_repeats_and_column_borders(spark):
    def prints(*data):
        return fingerprints(spark.createDataFrame(list(data), "a string, b string, snapshot_date string"))[JAN]

    day = "2024-01-01"
    base = prints(("x", "y", day), ("p", None, day))
    assert base == prints(("p", None, day), ("x", "y", day))
    for other in ([("x", "y", day), ("p", "", day)], [("x", "y", day), (None, "p", day)], [("xy", "", day), ("p", None, day)],
                  [("x", "y", day), ("p", None, day), ("p", None, day)]):
        assert base != prints(*other)


# Files


def test_report_names_every_failing_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("p,q\n1,2\n3,4\n")
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress(b"p,q\n5,6\n"))
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("p,q\n")
    (tmp_path / "swapped.csv").write_text("q,p\n1,2\n")
    (tmp_path / "noise.csv.gz").write_bytes(b"\x1f\x8b broken")
    (tmp_path / "cut.csv.gz").write_bytes(gzip.compress(b"p,q\n" + b"7,8\n" * 90_000)[:-30])
    (tmp_path / "other.txt").write_text("left alone")
    report = load_report(spark, str(tmp_path), ["p", "q"])
    got = {r.path.rsplit("/", 1)[1]: (r.outcome, r.n) for r in report.collect()}
    assert got == {
        "a.csv": ("read", 2), "b.csv.gz": ("read", 1), "empty.csv": ("empty", 0), "header.csv": ("no rows", 0),
        "swapped.csv": ("other header", 0), "noise.csv.gz": ("broken", 0), "cut.csv.gz": ("broken", 0),
    }
    rows_read = good_rows(spark, str(tmp_path), ["p", "q"], report)
    assert sorted((r.p, r.q) for r in rows_read.collect()) == [("1", "2"), ("3", "4"), ("5", "6")]


def test_types_are_inferred_in_one_job(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "i,l,f,e,b,d,t,s,n,m\n1,1,1.5,1e3,true,2024-01-31,2024-01-31 10:00:00,x,,2024-01-01\n"
        "-2,3000000000,.5,2,FALSE,2024-02-29,2024-01-31,2024-13-01,,2024-01-01 00:00:01\n+7,5,7,,,,,,,\n"
    )
    text = scan_csv(spark, str(tmp_path))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("infer", "types")
    types = inferred_types(text)
    assert len(tracker.getJobIdsForGroup("infer")) <= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert types == {"i": "int", "l": "bigint", "f": "double", "e": "double", "b": "boolean", "d": "date", "t": "timestamp",
                     "s": "string", "n": "string", "m": "timestamp"}
    got = typed(text, types).orderBy("i").collect()
    assert [r.i for r in got] == [-2, 1, 7] and got[0].l == 3_000_000_000 and got[1].e == 1000.0 and got[0].b is False
    assert got[0].d == dt.date(2024, 2, 29) and got[2].s is None
    assert dict(scan_csv(spark, str(tmp_path), infer=True).dtypes) == types
    assert inferred_types(text.filter("false")) == dict.fromkeys(types, "string")
    assert inferred_types(spark.createDataFrame([("99999999999999999999",), ("9999999999",)], "v string")) == {"v": "double"}


def test_run_over_all_months_needs_no_calendar(spark, tmp_path):
    mart = Mart(spark, str(tmp_path))
    counts = mart.run({n: derived.RAW[n](spark, SF) for n in ("attributes", "financials")}, None)
    assert counts["bronze/attributes"] == counts["silver/attributes"] == derived.attributes(spark, SF).count()
    assert counts["gold/feature_store"] == 150 and tables.stored_dates(spark, mart.path("silver", ATTRIBUTES.table)) == [JAN, FEB]


# Silver by buckets


def bucketed(spark, root, n=4):
    mart = Mart(spark, root, buckets=n)
    feeds = (ATTRIBUTES, FINANCIALS, CLICKSTREAM)
    for feed, raw in zip(feeds, (derived.attributes_with_gaps, derived.financials, derived.clickstream)):
        mart.build_silver(feed, raw(spark, SF))
    return mart


@pytest.fixture(scope="module")
def laid_out(spark, tmp_path_factory):
    return bucketed(spark, str(tmp_path_factory.mktemp("buckets")))


def same(a, b):
    return a.exceptAll(b.select(*a.columns)).isEmpty() and b.select(*a.columns).exceptAll(a).isEmpty()


def test_gold_joins_buckets_without_a_shuffle(spark, laid_out, tmp_path):
    plain = Mart(spark, str(tmp_path))
    for feed, raw in zip((ATTRIBUTES, FINANCIALS, CLICKSTREAM), (derived.attributes_with_gaps, derived.financials, derived.clickstream)):
        plain.build_silver(feed, raw(spark, SF))
    laid_out.refresh_vocabulary(), plain.refresh_vocabulary()
    with tables.session_settings(spark, spark_sql_autoBroadcastJoinThreshold="-1"), laid_out._joins_by_bucket():
        for build in ("features", "matched_features"):
            df = getattr(laid_out, build)()
            text = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text
            df.count()
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
            other = getattr(plain, build)()
            assert "Exchange" in other._jdf.queryExecution().executedPlan().toString()
            assert same(df, other)
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"


def test_buckets_of_one_month(spark, laid_out):
    one = laid_out._side(FINANCIALS, [FEB])
    assert {r.snapshot_date for r in one.select("snapshot_date").distinct().collect()} == {FEB}
    assert "PartitionFilters: [isnotnull" in one._jdf.queryExecution().executedPlan().toString() or one.count()
    assert laid_out._side(FINANCIALS, [MAR]).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("snapmart_")]


def test_drift_of_buckets_is_refused(spark, laid_out):
    path = laid_out.path("silver", "financials")
    for other in (Mart(spark, laid_out.root, buckets=5), Mart(spark, laid_out.root)):
        with pytest.raises(tables.BucketDrift):
            other.build_silver(FINANCIALS, derived.financials(spark, SF))
    with pytest.raises(tables.BucketDrift):
        tables.read_bucketed(spark, path, ("Customer_ID", 5))
    assert tables.manifest(spark, path).buckets == ("Customer_ID", 4)


def test_replaced_months_keep_their_buckets(spark, tmp_path):
    mart = bucketed(spark, str(tmp_path))
    path = mart.path("silver", "financials")
    february = derived.financials(spark, SF).filter("snapshot_date = '2024-02-01'").withColumn("Credit_Mix", F.lit("new"))
    mart.build_silver(FINANCIALS, february)
    rows = tables.read_bucketed(spark, path, mart.buckets)
    assert rows.count() == 150 and rows.filter("Credit_Mix = 'new'").count() == february.count()
    assert same(rows, mart.silver(FINANCIALS))
    tables.drop_snapshots(spark, path, [JAN])
    assert tables.read_bucketed(spark, path, mart.buckets).count() == february.count()


def test_heavy_keys_are_still_found_with_buckets(spark, tmp_path, monkeypatch):
    from snapmart.operators import joins
    from snapmart.plans import mart as plans

    mart = bucketed(spark, str(tmp_path))
    assert mart._light(FINANCIALS, ATTRIBUTES) is not None
    monkeypatch.setattr(plans, "surely_light", lambda largest: joins.surely_light(largest, rows_per_cell=1))
    assert mart._light(FINANCIALS, CLICKSTREAM) is None
    assert joins.surely_light([]) and joins.surely_light([10, 10], rows_per_cell=10) and not joins.surely_light([10, 101], rows_per_cell=10)

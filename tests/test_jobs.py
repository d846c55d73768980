"""Composite jobs on small literal rows."""

import math

import os

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallgrass.operators.windows import latest_per_key
from tallgrass.plans import clusters
from tallgrass.plans import customers as C
from tallgrass.plans import experiments as X
from tallgrass.plans import funnel as U
from tallgrass.plans import incremental as I
from tallgrass.plans import measures as M
from tallgrass.plans import models as L
from tallgrass.plans import outliers as Z
from tallgrass.plans import promo as P
from tallgrass.plans import rentals as R
from tallgrass.plans import staged
from tallgrass.plans import timeseries as T
from tallgrass.plans import warehouse as H
from tallgrass.session import scratch_path
from tallgrass.sources.generated import calendar, synthetic_sales
from tests.util import plan, rows

PROMO = ("Product string, Year int, `week number` int, Price double, Discount double, `On Flyer?` string, Units double, "
         "`Sales $` double, `Gross Margin $` double, `# Transactions that contained the product` int")
PROMO_ROWS = [(" apple ", 2020, 5, 10.0, 0.1, "Yes", 120.0, 1080.0, 270.0, 9), ("pear", 2020, 53, 4.0, 0.6, "No", 50.0, 80.0, 0.0, 3),
              ("fig", 1999, 60, -1.0, 1.2, "Maybe", 1.0, 0.0, None, 0)]


def test_promo(spark):
    old = spark.createDataFrame(PROMO_ROWS, PROMO)
    out, report = P.promo_load(old, old.limit(0))
    got = {r.Product: r for r in out.collect()}
    assert (got["APPLE"].Final_Unit_Price, got["APPLE"].Gross_Margin_Percent, got["APPLE"].Sales_Category) == (9.0, 25.0, "High")
    assert str(got["APPLE"].Week_Start_Date) == "2020-01-27"
    assert (got["PEAR"].High_Discount_Flag, got["PEAR"].On_Flyer_Flag, got["PEAR"].Sales_Category) == (1, 0, "Medium")
    assert got["FIG"].Gross_Margin_Percent is None
    broken = {(r.rule, r.column): r.violations for r in report.where("input = 'old' AND violations > 0").collect()}
    assert broken == {("non_negative", "Price"): 1, ("discount_range", "Discount"): 1, ("on_flyer", "On Flyer?"): 1,
                      ("year_range", "Year"): 1, ("week_range", "week number"): 1, ("sales_consistency", "Sales $"): 1,
                      ("missing", "Gross Margin $"): 1}
    assert report.where("input = 'new' AND violations > 0").count() == 0


def test_promo_pipeline_refuses_errors_and_stores_the_rest(spark):
    good, bad = (spark.createDataFrame(r, PROMO) for r in (PROMO_ROWS[:2], PROMO_ROWS[2:]))
    path = scratch_path(spark, "promo")
    refused = P.promo_pipeline(P.labelled(old=good, new=bad), path)
    assert rows(refused, "input", "n_rows", "errors", "status") == [("new", 1, 5, "refused"), ("old", 2, 0, "refused")]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path).count()
    for _ in range(2):  # a repeated load leaves one copy
        done = P.promo_pipeline(P.labelled(old=good, new=good), path)
        assert rows(done, "input", "n_rows", "errors", "status") == [("new", 2, 0, "written"), ("old", 2, 0, "written")]
        assert spark.read.parquet(path).count() == 4
    half = spark.createDataFrame([("x", 2020, 5, 0.05, 0.5, "No", 1.0, 0.03, 0.01, 1)], PROMO)
    price, percent = P.promo_transform(half).select("Final_Unit_Price", "Gross_Margin_Percent").first()
    assert (str(price), float(percent)) == ("0.03", 33.33)


def test_fact_keeps_unknown_products(spark):
    s = synthetic_sales(spark, customers=20, products=5, orders=30, items=60)
    fact = H.build_fact_order_items(s["order_items"], s["orders"], s["products"].where("product_id > 1")).cache()
    assert fact.count() == 60
    assert fact.where("product_id = '1' AND margin_amount IS NOT NULL").count() == 0
    keys = calendar(spark, "2022-01-01", "2024-12-31").select(F.col("date").alias("order_date"), F.col("date_key").alias("order_date_key"))
    assert fact.join(keys, ["order_date", "order_date_key"], "left_anti").count() == 0
    daily = H.mart_sales_daily(fact)
    assert daily.agg(F.sum("revenue")).first()[0] == fact.agg(F.sum("extended_net")).first()[0]
    assert daily.agg(F.sum("orders")).first()[0] == fact.select("order_id").distinct().count()
    channel = H.mart_marketing_channel(fact, H.build_dim_customer(s["customers"]))
    assert channel.agg(F.sum("customers")).first()[0] == fact.select("customer_id").distinct().count()


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    once = I.upsert_type1(target, source, ["k"])
    assert rows(once) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(I.upsert_type1(once, source, ["k"])) == rows(once)


def test_latest_per_key_breaks_ties(spark):
    df = spark.createDataFrame([(1, "2024-01-01", 5), (1, "2024-02-01", 7), (1, "2024-02-01", 6)], "k int, d string, id int")
    assert rows(latest_per_key(df, ["k"], "d", ["id"])) == [(1, "2024-02-01", 6)]


def test_high_water_is_strict(spark):
    rows_ = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-03")]
    df = spark.createDataFrame(rows_, "id int, d string").withColumn("d", F.to_date("d"))
    target = df.where("id <= 2")
    assert rows(I.append_after_high_water(target, df, "d"), "id") == [(1,), (2,), (4,)]
    assert I.append_after_high_water(df.limit(0), df, "d").count() == 4
    in_order = I.append_after_high_water(df.where("d < DATE'2024-01-03'"), df, "d")
    assert rows(in_order) == rows(df)
    stamps = df.withColumn("d", F.col("d").cast("timestamp"))
    assert rows(I.append_after_high_water(stamps.where("id <= 2"), stamps, "d"), "id") == [(1,), (2,), (4,)]


def test_new_rows_read_only_later_folders(spark):
    """The limit is a literal, so days already stored are not scanned."""
    root = scratch_path(spark, "facts")
    df = spark.range(40).selectExpr("id", "date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) AS d")
    path = I.publish(df, root, "facts_by_day", partition_by=["d"])
    later = I.new_rows(df.where("d < DATE'2024-01-08'"), spark.read.parquet(path), "d")
    assert later.count() == 12
    filters = [x for x in plan(later).split("PartitionFilters:")[1:]]
    assert filters and all("(d#" in x and "> 2024-01-07" in x.split("]")[0] for x in filters)
    assert "subquery" not in plan(later).lower()
    from tallgrass.queries.rentals import calendar_fact
    if os.path.isdir("/root/testdata/sf0.001"):
        text = plan(calendar_fact(spark, "/root/testdata/sf0.001", since=F.lit("1998-06-14").cast("date")))
        assert "GreaterThanOrEqual(l_shipdate" in text


def test_publish_keeps_the_old_version_readable(spark, tmp_path):
    first = I.publish(spark.range(3), str(tmp_path), "published_v")
    reader = spark.table("published_v")
    I.publish(spark.table("published_v").where("id > 0"), str(tmp_path), "published_v")
    assert spark.table("published_v").count() == 2 and reader.count() == 3
    assert spark.read.parquet(first).count() == 3


def test_host_and_daily_marts(spark):
    listings = spark.createDataFrame([(1, 10, None, 1), (1, 10, "Ann", 2), (2, 10, "Anna", 3), (3, 11, None, 1)],
                                     "listing_id int, host_id int, host_name string, seq int")
    assert rows(R.dim_host(listings, ["seq"])) == [(10, "Ann", 2), (11, None, 1)]
    nights = spark.createDataFrame([(1, "d", 1, 10.0), (1, "d", 0, 20.0), (2, "d", 1, 30.0)],
                                   "listing_id int, date string, is_available int, nightly_price double")
    assert rows(R.daily_metrics(nights, ["date"])) == [("d", 2, 20.0, 40.0)]


def test_sample_size_and_ztest(spark):
    plan_ = spark.createDataFrame([(0.13, 0.15), (0.2, 0.2)], "p1 double, p2 double")
    assert [r.required_n for r in X.ab_sample_size(plan_, "p1", "p2").collect()] == [4720, None]
    data = [("control", 1)] * 580 + [("control", 0)] * 4140 + [("treatment", 1)] * 592 + [("treatment", 0)] * 4128
    r = X.ab_ztest(spark.createDataFrame(data, "arm string, c int"), "arm", "c", control="control", treatment="treatment").first()
    p = (580 + 592) / 9440
    z = (580 - 592) / 4720 / math.sqrt(p * (1 - p) * 2 / 4720)
    assert r.z == pytest.approx(z) and r.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), abs=4e-7)
    half = 1.959963985 * math.sqrt(592 / 4720 * (1 - 592 / 4720) / 4720)
    assert (r.low_treatment, r.high_treatment) == (pytest.approx(592 / 4720 - half), pytest.approx(592 / 4720 + half))
    empty = X.ab_ztest(spark.createDataFrame([], "arm string, c int"), "arm", "c", control="a", treatment="b").first()
    assert empty.z is None


def test_subjects_seen_twice_are_dropped(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b")], "u int, arm string")
    assert rows(X.dedupe_subjects(df, "u")) == [(1, "a")]


def test_funnel(spark):
    users = spark.createDataFrame([(1, "D", "M"), (2, "D", "F"), (3, "P", "F")], "u int, device string, sex string")
    log = spark.createDataFrame([(1, "home"), (1, "search"), (2, "home"), (2, "home"), (9, "home")], "u int, page string")
    reach = U.funnel_reach(users, log, "u", {"home": F.col("page") == "home", "search": F.col("page") == "search"})
    assert rows(reach, "u", "home", "search") == [(1, 1, 1), (2, 1, 0), (3, 0, 0)]
    got = {(r.segment, r.value): (r.users, r.home) for r in U.funnel_conversion(reach, ["home", "search"], ["device", "sex"]).collect()}
    assert got == {("all", "all"): (3, pytest.approx(2 / 3)), ("device", "D"): (2, 1.0), ("device", "P"): (1, 0.0),
                   ("sex", "M"): (1, 1.0), ("sex", "F"): (2, 0.5)}


def test_cohorts(spark):
    data = [(1, "2024-01-05"), (1, "2024-01-20"), (1, "2024-03-01"), (2, "2024-01-31"), (3, "2023-12-31"), (3, "2024-02-01")]
    df = spark.createDataFrame(data, "c int, d string").withColumn("d", F.to_date("d"))
    got = {(str(r["cohort"]), r["index"]): r["retention"] for r in C.cohort_retention(df, "c", "d").collect()}
    assert got == {("2024-01-01", 1): 100.0, ("2024-01-01", 3): 50.0, ("2023-12-01", 1): 100.0, ("2023-12-01", 3): 100.0}


def test_quantile_bins_match_qcut(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": range(500), "v": rng.permutation(500) * 1.5, "w": rng.permutation(500)})
    got = C.quantile_bins(spark.createDataFrame(pdf), {"v": ("b", False), "w": ("r", True)}, 5).toPandas().sort_values("id")
    assert got["b"].tolist() == pd.qcut(pdf["v"], 5, labels=range(1, 6)).astype(int).tolist()
    assert got["r"].tolist() == pd.qcut(pdf["w"], 5, labels=range(5, 0, -1)).astype(int).tolist()


def test_equal_values_share_a_bin(spark):
    df = spark.createDataFrame([(i, 7.0) for i in range(10)] + [(99, 8.0)], "id int, v double")
    assert {r.b for r in C.quantile_bins(df, {"v": ("b", False)}, 5).where("v = 7").collect()} == {1}


def test_log_zscore_shifts_negatives(spark):
    pdf = pd.DataFrame({"id": [1, 2, 3, 4], "m": [-50.0, 0.0, 20.0, 400.0]})
    got = C.log_zscore(spark.createDataFrame(pdf), ["m"], shift=["m"]).toPandas().sort_values("id")["m"]
    logged = np.log(pdf["m"] + 50 + 1)
    assert np.allclose(got, (logged - logged.mean()) / logged.std(ddof=0))


def test_rfm_and_tenure(spark):
    df = spark.createDataFrame([("a", "2024-01-01", 5.0), ("a", "2024-01-10", 5.0), ("b", "2024-01-04", 1.0)],
                               "c string, d string, m double").withColumn("d", F.to_date("d"))
    assert rows(C.rfm_base(df, "c", "d", "m")) == [("a", 1, 2, 10.0), ("b", 7, 1, 1.0)]
    assert rows(C.customer_tenure(df, "c", "d"), "customer", "tenure") == [("a", 10), ("b", 7)]
    levels = C.with_level(spark.createDataFrame([(s,) for s in (15, 14, 13, 11, 10, 8, 7, 6, 5, 3)], "score int"))
    assert [r.level for r in levels.collect()] == ["Platinum Plus"] * 2 + ["Platinum"] * 2 + ["Gold"] * 2 + ["Silver"] * 2 + ["Bronze"] * 2


def test_kmeans_separates_clear_groups(spark):
    pdf = pd.DataFrame({"id": range(60), "x": [0.0] * 30 + [10.0] * 30, "y": [i % 5 / 10 for i in range(60)]})
    df = spark.createDataFrame(pdf)
    got = C.kmeans_segments(df, ["x", "y"], 2, id_col="id").toPandas()
    assert got.groupby("x")["cluster"].nunique().tolist() == [1, 1] and got["cluster"].nunique() == 2
    elbow = {r.k: r.sse for r in C.kmeans_elbow(df, ["x", "y"], [2, 3], id_col="id").collect()}
    assert elbow[3] <= elbow[2] == pytest.approx(60 * 0.02)
    assert C.kmeans_segments(df.where("false"), ["x", "y"], 2, id_col="id").count() == 0
    gaps = C.kmeans_segments(df.withColumn("x", F.when(F.col("id") > 3, F.col("x"))), ["x", "y"], 2, id_col="id")
    assert gaps.where("cluster is null").count() == 4
    same = C.kmeans_segments(df.select("id", F.lit(1.0).alias("x"), F.lit(2.0).alias("y")), ["x", "y"], 5, id_col="id")
    assert [r.cluster for r in same.select("cluster").distinct().collect()] == [0]


def test_kmeans_does_not_depend_on_the_layout(spark):
    rng = np.random.default_rng(8)
    centres = rng.uniform(-40, 40, (9, 3))
    pdf = pd.DataFrame(centres[rng.integers(0, 9, 4000)] + rng.normal(size=(4000, 3)), columns=["x", "y", "z"]).assign(id=range(4000))
    cols, ks = ["x", "y", "z"], [2, 3, 5, 7, 9, 10, 13]
    one, eight = spark.createDataFrame(pdf).coalesce(1), spark.createDataFrame(pdf.sample(frac=1, random_state=1)).repartition(8)
    a, b = clusters.kmeans(one, "id", cols, ks), clusters.kmeans(eight, "id", cols, ks)
    assert all(np.array_equal(a[k][0], b[k][0]) and a[k][1] == b[k][1] for k in ks)
    sse = [a[k][1] for k in ks]
    assert sse == sorted(sse, reverse=True) and sse[ks.index(9)] < 1.05 * 3 * 4000
    x = pdf[cols].to_numpy()
    want = ((x[:, None, :] - a[5][0][None]) ** 2).sum(-1).min(1).sum()
    assert a[5][1] == pytest.approx(want)
    assert {tuple(r) for r in C.kmeans_segments(one, cols, 5, id_col="id").select("id", "cluster").collect()} == {
        tuple(r) for r in C.kmeans_segments(eight, cols, 5, id_col="id").select("id", "cluster").collect()}


def test_folds_and_scores_do_not_depend_on_the_layout(spark):
    from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    df = spark.range(1500).selectExpr("id", "cast(pmod(xxhash64(id), 100) as double) AS a", "cast(pmod(xxhash64(id, 1), 100) as double) AS b")
    df = df.withColumn("label", ((F.col("a") + F.col("b") > 100) != (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(10)) == 0)).cast("double"))
    rows_of = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    one, eight = rows_of.coalesce(1), rows_of.repartition(8, F.xxhash64("a"))
    grids = [L.tree_cv_grid(d, id_col="id", depths=[2, 4])[1].collect() for d in (one, eight)]
    assert grids[0] == grids[1]
    models = {"tree": DecisionTreeClassifier(maxDepth=3, seed=1), "forest": RandomForestClassifier(numTrees=5, maxDepth=3, seed=1)}
    compared = [sorted(L.compare_classifiers(d, eight, models, id_col="id", folds=3).collect()) for d in (one, eight)]
    assert compared[0] == compared[1]


def test_classifiers_are_compared_on_texts_read_once(spark, tmp_path):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    from tallgrass.queries import models as Q

    spark.sql("SELECT id AS doc_id, repeat('Ab 1 ', cast(1 + id % 40 AS int)) AS text, 'en' AS lang, 's' AS source, 5 * (1 + id % 40) AS n_chars FROM range(400)").write.parquet(str(tmp_path / "documents.parquet"))
    spark.sql("SELECT id AS doc_id, cast(id % 40 > 25 AND id % 7 > 0 AS int) AS quality, 0 AS toxic FROM range(400)").write.parquet(str(tmp_path / "labels.parquet"))
    train, test = Q.prepared(spark, str(tmp_path))
    assert train.count() + test.count() == 400
    assert "FileScan" not in plan(train) and "FileScan" not in plan(test)
    tree = DecisionTreeClassifier(maxDepth=3, seed=1)
    got = L.compare_classifiers(train, test, {"tree": tree}, id_col="doc_id", folds=3)
    want = CrossValidator(estimator=tree, estimatorParamMaps=ParamGridBuilder().build(), evaluator=BinaryClassificationEvaluator(), numFolds=3,
                          foldCol="fold", seed=7).fit(L._folded(train, "doc_id", 3, 7)).avgMetrics[0]
    assert got.first().cv_auc == pytest.approx(want)
    with pytest.raises(ValueError, match="have rows"):
        L.compare_classifiers(train.limit(1), test, {"tree": tree}, id_col="doc_id", folds=3)


def test_multiclass_figures_match_the_evaluators(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    counts = {(0.0, 0.0): 7, (0.0, 1.0): 2, (1.0, 1.0): 5, (1.0, 2.0): 1, (2.0, 0.0): 3, (2.0, 2.0): 4}
    df = spark.createDataFrame([k for k, n in counts.items() for _ in range(n)], "label double, prediction double")
    want = [MulticlassClassificationEvaluator(metricName=m).evaluate(df) for m in ("f1", "weightedPrecision", "weightedRecall", "accuracy")]
    assert L.multiclass_figures(counts) == pytest.approx(want)


def files_below(folder):
    return {os.path.relpath(os.path.join(d, f), folder): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet") and "/data/" in d}


def test_staged_upsert_rewrites_touched_parts_only(spark, tmp_path):
    folder, schema = str(tmp_path / "t"), "k long, v string, d date"
    part = staged.by_range("k", 10)

    def load(*given):
        source = spark.createDataFrame([(k, v, None) for k, v in given], schema)
        return staged.upsert_staged(source, folder, ["k"], part, view="staged_t")

    assert staged.read_staged(spark, folder, schema).count() == 0
    assert load(*[(k, f"v{k}") for k in range(50)]) == [0, 1, 2, 3, 4]
    before = files_below(folder)
    reader = staged.read_staged(spark, folder, schema)
    assert load((13, "new"), (17, "v17"), (71, "more"), (33, "v33")) == [1, 7]
    after = files_below(folder)
    assert before.items() <= after.items()
    added = set(after) - set(before)
    assert {f.split("_part=")[1].split("/")[0] for f in added} == {"1", "7"}
    want = {k: f"v{k}" for k in range(50)} | {13: "new", 71: "more"}
    assert {r.k: r.v for r in staged.read_staged(spark, folder, schema).collect()} == want
    assert {r.k: r.v for r in spark.table("staged_t").collect()} == want
    assert {r.k: r.v for r in reader.collect()} == {k: f"v{k}" for k in range(50)}  # the version it began with
    assert load((13, "new"), (17, "v17"), (71, "more"), (33, "v33")) == [] and files_below(folder) == after
    assert load((13, None)) == [1] and load((13, None)) == []
    assert {r.k: r.v for r in staged.read_staged(spark, folder, schema).collect()} == want | {13: None}


def test_staged_upsert_keeps_the_old_version_when_a_load_breaks_off(spark, tmp_path, monkeypatch):
    folder, schema = str(tmp_path / "t"), "k long, d date, v int"
    part = staged.by_month("d")
    day = pd.Timestamp("2024-03-05").date()
    first = spark.createDataFrame([(1, day, 5), (None, day, 6)], schema)
    assert staged.upsert_staged(first, folder, ["k", "d"], part) == [202403]
    broken = spark.createDataFrame([(1, day, 9)], schema).withColumn("v", F.when(F.col("v") == 9, F.raise_error(F.lit("no"))).cast("int"))
    with pytest.raises(Exception, match="no"):
        staged.upsert_staged(broken, folder, ["k", "d"], part)
    assert rows(staged.read_staged(spark, folder, schema), "k", "v") == [(1, 5), (None, 6)]
    assert staged.upsert_staged(spark.createDataFrame([(None, day, 7)], schema), folder, ["k", "d"], part) == [202403]
    assert rows(staged.read_staged(spark, folder, schema), "k", "v") == [(1, 5), (None, 7)]


def brute_lof(points, k):
    """Pairwise definition: ties at the k-distance count, a point is not its own neighbour."""
    n = len(points)
    d = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    kdist = np.sort(d, axis=1)[:, k - 1]
    near = [np.where(d[i] <= kdist[i])[0] for i in range(n)]
    reach = np.array([np.maximum(d[i][near[i]], kdist[near[i]]).sum() for i in range(n)])
    size = np.array([len(x) for x in near])
    lrd = np.array([s / r if r > 0 else np.inf for s, r in zip(size, reach)])
    return np.array([1.0 if np.isinf(lrd[i]) else lrd[near[i]].mean() / lrd[i] for i in range(n)])


@pytest.mark.parametrize("dims", [1, 2, 3])
def test_lof_matches_all_pairs(spark, dims):
    rng = np.random.default_rng(dims)
    points = np.vstack([rng.normal(0, 1, (200, dims)), rng.normal(30, 0.01, (120, dims)), rng.uniform(-60, 60, (15, dims)),
                        np.round(rng.normal(5, 2, (60, dims)))])
    cols = [f"c{i}" for i in range(dims)]
    pdf = pd.DataFrame(points, columns=cols).assign(id=range(len(points)))
    got = Z.lof(spark.createDataFrame(pdf), "id", cols, k=7, scale=False).toPandas().sort_values("id")["lof"].to_numpy()
    want = brute_lof(points, 7)
    finite = np.isfinite(want)
    assert np.allclose(got[finite], want[finite], rtol=1e-9) and np.array_equal(np.isfinite(got), finite)


def test_lof_copies_and_nulls(spark):
    pdf = pd.DataFrame({"id": range(25), "x": [1.0] * 20 + [5.0, 6.0, 7.0, 8.0, None], "y": [1.0] * 20 + [5.0, 5.0, 9.0, 2.0, 1.0]})
    got = Z.lof(spark.createDataFrame(pdf).replace(float("nan"), None), "id", ["x", "y"], k=5).toPandas().set_index("id")["lof"].sort_index()
    assert sorted(got.index) == list(range(24)) and (got[:20] == 1.0).all() and np.isinf(got[20])


def test_lof_never_pairs_a_whole_group(spark):
    """The candidate pairs grow with the points, not with their square."""
    sizes = []
    for n in (400, 1600):
        rng = np.random.default_rng(0)
        pdf = pd.DataFrame({"pid": range(n), "w": 1, "x0": rng.random(n), "x1": rng.random(n)})
        got = Z.nearest_neighbours(spark.createDataFrame(pdf), 2, 5)
        assert got.groupBy("p").agg(F.sum("w").alias("n")).where("n < 5").count() == 0
        text = plan(got)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        sizes.append(got.count())
    assert sizes[1] < 5 * sizes[0]


def test_lof_with_a_far_outlier_and_ties(spark):
    """One point 10^12 away, most points on one line, and a tight cloud: cells still get small."""
    rng = np.random.default_rng(5)
    points = np.vstack([[[1e12, 0.0]], np.column_stack([np.full(300, 7.0), rng.random(300)]), rng.random((300, 2)) * 1e-3])
    pdf = pd.DataFrame(points, columns=["x0", "x1"]).assign(pid=range(len(points)), w=1)
    seen = []
    real = Z._cells
    try:
        Z._cells = lambda p, d: seen.append(real(p, d)) or seen[-1]
        got = Z.nearest_neighbours(spark.createDataFrame(pdf), 2, 5).groupBy("p").agg(F.max("kdist").alias("k")).toPandas().set_index("p")["k"].sort_index()
    finally:
        Z._cells = real
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert np.allclose(got, np.sort(d, axis=1)[:, 4], rtol=1e-9)
    assert seen[-1].agg(F.max("m")).first()[0] <= 16 and len(seen) <= 9


@pytest.mark.parametrize("dims", [1, 2, 4])
def test_indexed_neighbours_recall(spark, dims):
    """Dense and thin places, copies, ties: nearly all neighbours are found, and no distance is wrong."""
    rng = np.random.default_rng(dims)
    points = np.unique(np.vstack([rng.normal(0, 1, (1500, dims)), rng.normal(20, 0.001, (600, dims)), rng.uniform(-60, 60, (300, dims)),
                                  np.round(rng.normal(5, 20, (300, dims)))]), axis=0)
    n, k = len(points), 10
    pdf = pd.DataFrame(points, columns=[f"x{i}" for i in range(dims)]).assign(pid=range(n), w=[3 if i % 50 == 0 else 1 for i in range(n)])
    df = spark.createDataFrame(pdf)
    exact = {(r.p, r.q): r.d for r in Z.nearest_neighbours(df, dims, k).collect()}
    settings = {"tables": 8} if dims > 2 else {}
    found = {(r.p, r.q): r.d for r in Z.indexed_neighbours(df, dims, k, **settings).collect()}
    hit = [x for x in exact if x in found]
    assert len(hit) / len(exact) >= (0.9 if dims > 2 else 0.97)
    assert all(abs(found[x] - exact[x]) < 1e-9 for x in hit)
    assert {p for p, _ in found} == set(range(n))


def test_indexed_lof_is_near_the_exact_one(spark):
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(0, 1, (1200, 2)), rng.normal(9, 0.05, (500, 2)), rng.uniform(-12, 12, (30, 2))])
    pdf = pd.DataFrame(points, columns=["a", "b"]).assign(id=range(len(points)))
    df = spark.createDataFrame(pdf)
    one = Z.lof(df, "id", ["a", "b"], k=10).toPandas().set_index("id").sort_index()
    two = Z.lof(df.repartition(5), "id", ["a", "b"], k=10, exact=False).toPandas().set_index("id").sort_index()
    assert (one["is_outlier"] == two["is_outlier"]).mean() > 0.99 and np.median(np.abs(one["lof"] / two["lof"] - 1)) < 1e-9
    assert Z.lof(df.where("false"), "id", ["a", "b"], exact=False).count() == 0


def test_quantile_outliers(spark):
    df = spark.range(1, 1001).withColumn("v", F.col("id").cast("double"))
    assert Z.quantile_outliers(df, "v").count() == 20


def test_decompose_by_hand(spark):
    n = 48
    months = pd.date_range("2020-01-01", periods=n, freq="MS").date
    season = np.array([5, 3, 0, -2, -4, -1, 1, 2, 0, -3, -2, 1.0])
    y = 100 + 2.0 * np.arange(n) + np.tile(season, 4)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "m": months, "v": y}))
    got = T.decompose_additive(df, ["k"], "m", "v").toPandas().sort_values("m")
    assert got["trend"].isna().sum() == 12
    inner = got.iloc[6:-6]
    assert np.allclose(inner["trend"], (100 + 2.0 * np.arange(n))[6:-6] + season.mean())
    assert np.allclose(inner["seasonal"], (np.tile(season, 4) - season.mean())[6:-6]) and np.allclose(inner["residual"], 0)


def test_dickey_fuller_against_least_squares(spark):
    rng = np.random.default_rng(5)
    y = np.cumsum(rng.normal(size=80))
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "t": range(80), "v": y}))
    r = T.dickey_fuller(df, ["k"], "t", "v").first()
    x, d = y[:-1], np.diff(y)
    design = np.column_stack([np.ones(79), x])
    coef, res, *_ = np.linalg.lstsq(design, d, rcond=None)
    error = math.sqrt(res[0] / 77 * np.linalg.inv(design.T @ design)[1, 1])
    assert r.statistic == pytest.approx(coef[1] / error)


def test_forecasts_follow_a_seasonal_line(spark):
    months = pd.date_range("2020-01-01", periods=48, freq="MS").date
    y = np.tile(np.arange(12.0), 4) + 6.0 * np.repeat(np.arange(4), 12)
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "m": months, "v": y}))
    want = list(np.arange(12.0) + 24) + [30.0]
    for made in (T.forecast_naive(df, ["k"], "m", "v", horizon=13), T.forecast_ar(df, ["k"], "m", "v", horizon=13)):
        got = made.orderBy("step").collect()
        assert [r.forecast for r in got] == pytest.approx(want) and str(got[0].m) == "2024-01-01"
    whole = T.forecast_naive(df.drop("k"), [], "m", "v", horizon=13).orderBy("step").collect()
    assert [r.forecast for r in whole] == pytest.approx(want)


def test_autoregression_against_least_squares(spark):
    rng = np.random.default_rng(2)
    n, season = 70, 12
    y = 50 + np.tile(rng.normal(size=season) * 9, 6)[:n] + np.cumsum(rng.normal(size=n))
    months = pd.date_range("2018-01-01", periods=n, freq="MS").date
    d = y[season:] - y[:-season]
    design = np.column_stack([np.ones(len(d) - 2), d[1:-1], d[:-2]])
    coef, *_ = np.linalg.lstsq(design, d[2:], rcond=None)
    level, diff = list(y), list(d)
    for _ in range(30):
        diff.append(coef[0] + coef[1] * diff[-1] + coef[2] * diff[-2])
        level.append(level[-season] + diff[-1])
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "m": months, "v": y})).repartition(3)
    made = T.forecast_ar(df, ["k"], "m", "v", horizon=30)
    assert "Pandas" not in plan(made) and "Arrow" not in plan(made)
    assert [r.forecast for r in made.orderBy("step").collect()] == pytest.approx(level[n:])


def test_monthly_mean_fills_empty_months(spark):
    df = spark.createDataFrame([("2024-01-01", 2.0), ("2024-01-01", 4.0), ("2024-01-09", 10.0), ("2024-03-05", 1.0)], "d string, v double")
    got = rows(T.monthly_mean(df.withColumn("d", F.to_date("d")), [], "d", "v").withColumn("month", F.col("month").cast("string")))
    assert got == [("2024-01-01", 8.0), ("2024-02-01", None), ("2024-03-01", 1.0)]


def test_report_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    data = [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 3 + [(0.0, 0.0)] * 11 + [(0.0, 1.0)] * 5
    df = spark.createDataFrame(data, "label double, prediction double")
    r = L.binary_report(df, "label", "prediction").first()
    for name, column in {"f1": "weighted_f1", "weightedPrecision": "weighted_precision", "weightedRecall": "weighted_recall",
                         "accuracy": "accuracy"}.items():
        assert MulticlassClassificationEvaluator(metricName=name).evaluate(df) == pytest.approx(r[column])
    nothing = L.binary_report(df.limit(0), "label", "prediction").first()
    assert nothing.accuracy == 0.0


def test_one_hot_columns_and_vectors(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "c string, v int")
    assert rows(L.one_hot(df, ["c"])) == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    vectors = L.one_hot_vectors(df, ["c"]).select("v", vector_to_array("c_vector").alias("a")).collect()
    assert {r.v: r.a for r in vectors} == {1: [1.0, 0.0], 2: [0.0, 1.0], 3: [0.0, 0.0]}
    wide = spark.range(300).selectExpr("concat('c', id) AS c", "id")
    assert len(L.one_hot(wide, ["c"]).columns) == 301


def test_tree_learns_a_threshold(spark):
    pdf = pd.DataFrame({"x": np.arange(200.0), "z": [0.0, 1.0] * 100, "churn": ["true" if i > 140 else "false" for i in range(200)]})
    vectors = L.vectorize(spark.createDataFrame(pdf), "churn", ["x", "z"])
    scored = L.tree_train(vectors).transform(vectors)
    assert L.binary_report(scored, "label", "prediction").first().accuracy > 0.95  # bins bound the threshold
    ranked = L.ranked_probability(scored.withColumn("id", F.col("x")), "id")
    assert ranked.where("id > 150 AND probability < 0.5").count() == 0 and ranked.where("id < 130 AND probability > 0.5").count() == 0


def test_measures(spark):
    fact = spark.createDataFrame([(1, "a", 10, 1), (2, "a", 30, -1), (3, "b", 30, 2), (4, "c", 5, 1)],
                                 "customer_id int, product string, sales int, quantity int")
    per = M.totals(fact, "product", "sales", "sales")
    assert rows(M.top_with_ties(per, "sales", 1)) == [("a", 40)]
    assert M.top_share(per, "sales", 2).first().share == pytest.approx(70 / 75)
    tied = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "p string, s int")
    assert M.top_with_ties(tied, "s", 1).count() == 2
    got = M.measure(["return_rate", "loyalty_index"], M.Star(fact), ["product"])
    assert rows(got) == [("a", 0.5, 0.0), ("b", 0.0, 1.0), ("c", 0.0, 0.0)]


def test_new_customers_both_ways(spark):
    df = spark.createDataFrame([(1, "2023-05-01"), (1, "2024-01-01"), (2, "2024-02-01"), (2, "2024-03-01"), (3, "2024-04-01")],
                               "c int, d string").withColumn("d", F.to_date("d"))
    r = M.new_customers(df, "c", "d", 2024).first()
    assert (r.first_purchase, r.single_row) == (2, 2)


def test_python_functions_need_no_package_on_the_workers(tmp_path):
    """Run from another folder, with the package reachable by the driver only."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from tallgrass.operators import udfs as U
df = spark.createDataFrame([("ab cd",)], ["t"])
print("got", df.select(U.text_udf(U.capitalize_each_word)(F.col("t")).alias("t")).first().t)
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert "got Ab Cd" in done.stdout, done.stderr[-2000:]


def test_forecasts_keep_short_series(spark):
    from tallgrass.plans import timeseries

    months = [(k, f"{2020 + i // 12}-{i % 12 + 1:02d}-01", float(i)) for k, n in (("short", 5), ("mid", 17), ("long", 40)) for i in range(n)]
    df = spark.createDataFrame(months, "k string, m string, v double").selectExpr("k", "to_date(m) m", "v")
    for method, full in (("naive", {"mid", "long"}), ("ar", {"long"})):
        got = timeseries.forecast(df, ["k"], "m", "v", horizon=14, method=method).collect()
        assert len(got) == 3 * 14 and len({(r.k, r.step) for r in got}) == 42
        assert {r.k for r in got} - {r.k for r in got if r.forecast is None} == full


def test_cohort_matrix_fails_beyond_its_columns(spark):
    df = spark.createDataFrame([(1, "2020-01-05"), (1, "2020-03-09")], "c int, d string").withColumn("d", F.to_date("d"))
    assert C.cohort_matrix(df, "c", "d", range(1, 4)).select("m1", "m2", "m3").first() == (1, None, 1)
    with pytest.raises(Exception, match="no column for cohort index 3"):
        C.cohort_matrix(df, "c", "d", range(1, 3)).collect()


def test_cohort_counts_has_a_column_per_index(spark, tmp_path):
    import __spark_entry__ as entry
    from tests.oracle import compare, duck

    data = [(1, "2010-01-05"), (1, "2010-03-09"), (1, "2017-01-01"), (2, "2010-01-07"), (2, "2010-01-08"), (3, "2016-12-31"), (3, None), (4, None), (None, "2011-05-01")]
    orders = spark.createDataFrame([(i, c, d, 1.0) for i, (c, d) in enumerate(data)], "o_orderkey long, o_custkey long, d string, o_totalprice double")
    orders.coalesce(1).selectExpr("*", "cast(d AS timestamp) o_orderdate").drop("d").write.parquet(str(tmp_path / "made"))
    next((tmp_path / "made").glob("*.parquet")).rename(tmp_path / "orders.parquet")
    query, sql = entry.queries()["cohort_counts"], entry.oracle_sql()["cohort_counts"]
    assert compare(spark, duck(str(tmp_path)), query, sql, str(tmp_path)) is None
    out = query(spark, str(tmp_path))
    assert out.columns == ["cohort", *[f"m{i}" for i in range(1, 81)], "m85", "undated"]
    assert rows(out, "cohort", "m1", "m2", "m3", "m85", "undated") == [
        ("2010-01-01", 2, 0, 1, 1, 0), ("2011-05-01", 0, 0, 0, 0, 0), ("2016-12-01", 1, 0, 0, 0, 1), (None, 0, 0, 0, 0, 1)]

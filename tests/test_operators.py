import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallgrass.functions import conditions, dates, nested, numbers, text
from tallgrass.operators import aggregates as A
from tallgrass.operators import columns as C
from tallgrass.operators import filters as P
from tallgrass.operators import joins as J
from tallgrass.operators import ordered as O
from tallgrass.operators import quality as Q
from tallgrass.operators import sampling as S
from tallgrass.operators import windows as W
from tallgrass.session import estimated_bytes
from tests.util import optimized, plan, rows


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_sanitize_gives_unique_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["a b", "a,b", "A=b", "ok"])
    assert C.sanitize_columns(df).columns == ["a_b", "a_b_1", "A_b_2", "ok"]


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, "x")], ["Name.First", "b"])
    assert C.add_constant(df, "one", 1, position=0).columns == ["one", "Name.First", "b"]
    assert C.to_json_rows(df).first().json == '{"Name.First":1,"b":"x"}'


def test_ambiguous_names(spark):
    df = spark.createDataFrame([(1, 2)], ["ID", "id"])
    with pytest.raises(AnalysisException):
        df.select("Id").collect()


def test_take_checked_refuses_more(spark):
    assert len(C.take_checked(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        C.take_checked(spark.range(6), 5)


def test_param_filters_leave_empty_lists_open(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], ["x", "y"])
    assert rows(P.apply_param_filters(df, {"x": ["a"], "y": []})) == [("a", 1)]


def test_password_rules(spark):
    df = spark.createDataFrame([("ABd1234@1",), ("a F1#",), ("2w3E*",), ("2We3345",), ("Abcdef1$ 9",)], ["w"])
    got = {r.w: r.ok for r in df.select("w", P.matches_all(F.col("w"), P.PASSWORD_RULES).alias("ok")).collect()}
    assert [w for w, ok in got.items() if ok] == ["ABd1234@1"]


PEOPLE = [(1, "Homer", 100), (2, "Marge", 200), (3, "Bart", None), (4, "Lisa", 300)]
UNIS = [(100, "Springfield"), (200, "Capital"), (500, "Ogden")]


@pytest.mark.parametrize("how,n", [("inner", 2), ("left", 4), ("right", 3), ("full", 5), ("left_semi", 2), ("left_anti", 2)])
def test_join_truth_table(spark, how, n):
    a = spark.createDataFrame(PEOPLE, "id int, name string, uni int")
    b = spark.createDataFrame(UNIS, "uni int, town string")
    assert a.join(b, "uni", how).count() == n


def test_broadcast_only_when_small(spark):
    big, small = spark.range(1000), spark.range(10).withColumn("x", F.lit(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        size = estimated_bytes(small)
        assert "BroadcastHashJoin" in plan(J.join_broadcast(big, small, "id", max_bytes=size))
        assert "BroadcastHashJoin" not in plan(J.join_broadcast(big, small, "id", max_bytes=size - 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_product_of_any_size(spark):
    assert J.product_with_small(spark.range(5), spark.range(3).toDF("b")).count() == 15
    assert J.product_with_small(spark.range(5), spark.range(2000).toDF("b"), max_bytes=0).count() == 10_000


def test_join_on_key_suffixes(spark):
    a = spark.createDataFrame([(1, "u")], ["k", "page"])
    got = J.join_on_key([a, a, a], "k", suffixes=["", "_home", "_search"])
    assert got.columns == ["k", "page", "page_home", "page_search"]


def test_grouping_levels(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], ["p", "q", "v"])
    got = A.subtotals(df, ["p", "q"], [F.sum("v").alias("v")], kind="cube")
    assert {r.level for r in got.collect()} == {0, 1, 2, 3}
    assert rows(A.subtotals(df, ["p", "q"], [F.sum("v").alias("v")], kind="cube", levels=[3]), "v") == [(7,)]


def test_pivot_with_total(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 4)], ["p", "q", "v"])
    got = A.pivot_sum(df, ["p"], "q", "v", values=["x", "y"], total=True)
    assert rows(got) == [("Total", 5, 2), ("a", 1, 2), ("b", 4, None)]


def test_key_profile(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (2, 2)], ["a", "b"])
    r = A.key_profile(df, ["a"]).first()
    assert (r.cardinality, r.entropy, r.is_key) == (2.0, 0.5, False)
    assert A.key_profile(df, ["a", "b"]).first().is_key


def test_label_of_max_resolves_ties(spark):
    df = spark.createDataFrame([("MON", 5), ("TUE", 9), ("SUN", 9)], ["day", "n"])
    assert A.label_of_max(df, [], "day", "n").first().day == "SUN"


def test_missing_counts_only_nan_of_floats(spark):
    df = spark.createDataFrame([("x", 1.0, 1), (None, float("nan"), None)], "a string, b double, c int")
    assert rows(Q.missing_by_column(df)) == [("a", 1), ("b", 1), ("c", 1)]


def test_rules_are_one_job_over_one_scan(spark):
    df = spark.createDataFrame([(1.0, 0.2, "Yes"), (-1.0, 1.5, "maybe")], "p double, d double, f string")
    report = Q.check_rules(df, [*Q.non_negative(df, ["p", "f", "gone"]), Q.within("d", 0, 1, "range"), Q.in_domain("f", ["Yes", "No"])])
    assert rows(report, "column", "violations") == [("d", 1), ("f", 1), ("p", 1)]
    assert plan(report).count("Scan") == 1


def test_split_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    ok, bad = Q.split_not_null(df, ["k"])
    assert (rows(ok), rows(bad)) == ([(1, "a")], [(None, "b")])


def test_floor_arithmetic(spark):
    assert one(spark, numbers.floor_divide(F.lit(-7), F.lit(2))) == -4
    assert one(spark, numbers.floor_mod(F.lit(-7), F.lit(2))) == 1
    assert one(spark, numbers.floor_divide(F.lit(1), F.lit(0))) is None


def test_normal_cdf(spark):
    from statistics import NormalDist

    for z in (-3.1, -1.96, 0.0, 0.3417, 2.5):
        assert abs(one(spark, numbers.normal_cdf(F.lit(z))) - NormalDist().cdf(z)) < 2e-7


def test_iso_weeks(spark):
    week = dates.iso_week_start(F.lit(2020), F.lit(5))
    assert str(one(spark, week)) == "2020-01-27"
    assert str(one(spark, dates.iso_week_start(F.lit(2021), F.lit(1)))) == "2021-01-04"


def test_serial_day(spark):
    noon = F.lit("1900-01-01 12:00:00").cast("timestamp_ntz")
    assert one(spark, dates.serial_day(noon)) == 2.5


def test_text(spark):
    assert one(spark, text.find(F.lit("hello"), "zz", zero_based=True)) == -1
    assert one(spark, text.email_company(F.lit("john@google.com"))) == "google"
    assert one(spark, text.all_numbers(F.lit("2 cats and 33 dogs"))) == ["2", "33"]
    assert one(spark, text.positive_parts({"Gold": F.lit(2), "Silver": F.lit(0), "Bronze": F.lit(1)})) == "2 Gold, 1 Bronze"
    assert one(spark, text.count_chars(F.lit("Ab1 c2"), "0-9")) == 2
    assert one(spark, text.words(F.lit("  a  b "))) == ["a", "b"]


def test_nested(spark):
    m = F.create_map(F.lit("a"), F.lit("1"))
    assert one(spark, nested.map_value(m, "z", "none")) == "none"
    assert one(spark, nested.element(F.array(F.lit(1)), 5)) is None
    assert one(spark, conditions.recode(F.lit("x"), {"y": 1})) is None


def test_samples_do_not_depend_on_partitions(spark):
    df = spark.range(2000).withColumn("g", F.col("id") % 3)
    a = S.sample_n(df, ["g"], 10, id_col="id", seed=4)
    assert rows(a) == rows(S.sample_n(df.repartition(13), ["g"], 10, id_col="id", seed=4))
    assert a.count() == 30
    split = S.split_by_hash(df, "id", {"train": 8, "test": 2}, seed=1).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split}["train"] == pytest.approx(1600, abs=80)
    balanced = S.balance_labels(spark.range(3000).selectExpr("id", "id < 300 AS label"), "label", id_col="id", seed=2)
    sizes = {r.label: r["count"] for r in balanced.groupBy("label").count().collect()}
    assert sizes[True] == 300 and abs(sizes[False] - 300) < 80


def test_first_rows_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS k")
    assert plan(W.first_rows(df, ["k"], ["id"])).count("WindowGroupLimit") == 2


@pytest.mark.parametrize("n", [1, 20, 4720])
def test_bottom_k_is_one_path_without_a_sort_of_all(spark, n):
    """The same plan for every n: tasks pass on at most n rows a group, and those are the smallest."""
    df = spark.range(0, 60_000, 1, 6).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 5 = 0 THEN NULL ELSE concat('g', id % 7) END AS g", "map('a', id) AS m")
    out = S.sample_n(df, ["g"], n, id_col="id", seed=9)
    text = plan(out)
    assert "rangepartitioning" not in text and text.count("MapInArrow") == 2 and "Scan ExistingRDD" not in text
    import hashlib

    groups = {}
    for i in range(60_000):
        g = "hot" if i % 2 == 0 else None if i % 5 == 0 else f"g{i % 7}"
        groups.setdefault(g, []).append((hashlib.md5(f"{i}:9".encode()).hexdigest(), i))
    want = {(g, i) for g, rows_of in groups.items() for _, i in sorted(rows_of)[:n]}
    got = out.select("g", "id", "m").collect()
    assert len(got) == len(want) and {(r.g, r.id) for r in got} == want and all(r.m == {"a": r.id} for r in got)
    keep = S._smallest(n, "_key", ["_o"])
    passed = df.selectExpr("coalesce(g, '') AS _key", "md5(cast(id AS string)) AS _o").mapInArrow(keep, "_key string, _o string")
    per_task = passed.groupBy("_key", F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert per_task <= n


def test_bottom_k_of_many_groups_passes_rows_on(spark, monkeypatch):
    monkeypatch.setattr(S, "_GATHERED", 64)
    monkeypatch.setattr(S, "_HELD", 100)
    df = spark.range(3000).selectExpr("id", "id % 700 AS g")
    kept = S._smallest(2, "_key", ["_o"])
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"_key": [str(i % 700)], "_o": [i]}) for i in range(3000)]
    out = [r for b in kept(iter(batches)) for r in b.to_pylist()]
    assert {(r["_key"], r["_o"]) for r in out} >= {(str(g), g + 700 * j) for g in range(700) for j in range(2)}
    assert S.bottom_k(df, ["g"], 0, [F.col("id")]).count() == 0 and S.bottom_k(df, [], 5, [F.col("id")]).count() == 5


def test_correlations_of_all_columns(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(size=(500, 9)) * 10 + 1e6, columns=[f"c{i}" for i in range(9)])
    pdf["c1"], pdf["c2"], pdf["c3"] = pdf.c0 * -2 + rng.normal(size=500), 7.0, np.arange(500)
    pdf.loc[rng.random(500) < 0.2, ["c4"]] = np.nan
    pdf.loc[1:, "c5"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    got = {(r.a, r.b): r["corr"] for r in A.correlation_pairs(df, df.columns).collect()}
    want = pdf.corr()
    assert len(got) == 81
    for (a, b), v in got.items():
        w = want.loc[a, b]
        assert (v is None and np.isnan(w)) or v == pytest.approx(w, abs=1e-6), (a, b, v, w)
    assert {r["corr"] for r in A.correlation_pairs(df.where("false"), df.columns[:3]).collect()} == {None}


def test_group_value_combines_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "id % 3 AS k")
    assert rows(W.group_value(df, ["k"], F.min("id"), "low").where("low <> k")) == []
    assert "partial_min" in plan(W.group_value(df, ["k"], F.min("id"), "low"))


def test_ewma_and_rolling_match_pandas(spark):
    import pandas as pd

    values = [float(v) for v in (5, 3, 8, 1, 9, 2, 7, 7, 4, 6, 3, 8, 2, 5)]
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(values)], "k string, t int, v double")
    series = pd.Series(values)
    got = [r.ewma for r in O.ewma(df, ["k"], ["t"], "v", halflife=12).orderBy("t").collect()]
    assert got == pytest.approx(series.ewm(halflife=12).mean().tolist())
    out = W.rolling(df, ["k"], "t", "v", periods=12, fns={"m": F.avg("v"), "s": F.stddev_samp("v")}).orderBy("t").collect()
    assert [r.m for r in out[:11]] == [None] * 11
    assert out[13].m == pytest.approx(series.rolling(12).mean()[13]) and out[13].s == pytest.approx(series.rolling(12).std()[13])


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id * 2 AS v", "'x' AS s").write.parquet(path)
    p = plan(spark.read.parquet(path).select("id", "v").where("v > 50").select("id"))
    assert "GreaterThan(v,50)" in p and "ReadSchema: struct<id:bigint,v:bigint>" in p


def test_sql_and_dataframe_have_one_plan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id % 5 AS k", "id AS v").write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("same_plan")
    a = optimized(spark.sql("SELECT k, sum(v) AS s FROM same_plan GROUP BY k"))
    b = optimized(spark.table("same_plan").groupBy("k").agg(F.sum("v").alias("s")))
    import re

    strip = lambda p: re.sub(r"#\d+L?", "", p)
    assert strip(a) == strip(b)

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallgrass.session import scratch_path, shared_dir
from tallgrass.sources import files, generated, jdbc, tables
from tests.util import plan, rows

FLIGHTS = [("Bonaire, Sint Eustatius, and Saba", "United States", 58), ("Cote d'Ivoire", "United States", 1),
           ("United States", "Curacao", 83), ("Saint Barthelemy", "United States", 39)]


def test_csv_three_call_styles(spark, tmp_path):
    schema = "dest string, origin string, count long"
    df = spark.createDataFrame(FLIGHTS, schema)
    path = str(tmp_path / "f")
    files.write_csv(df, path)
    inferred = files.read_csv(spark, path)
    assert inferred.schema["count"].dataType.simpleString() == "int"
    assert rows(files.read_csv(spark, path, schema=schema)) == rows(df)
    assert rows(spark.read.format("csv").schema(schema).option("header", True).load(path)) == rows(df)


def test_partitioned_folders_escape_names_and_read_back(spark, tmp_path):
    df = spark.createDataFrame(FLIGHTS, "dest string, origin string, count long")
    path = str(tmp_path / "p")
    files.write_csv(df, path, sep=";", partition_by=["dest"])
    assert sum(d.startswith("dest=") for d in os.listdir(path)) == 4
    back = files.read_csv(spark, path, sep=";").select("dest", "origin", F.col("count").cast("long"))
    assert rows(back) == rows(df)


def test_multi_line_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": {"b": [1, 2]}},\n {"a": {"b": []}}]')
    df = files.read_json(spark, str(tmp_path / "a.json"), multi_line=True)
    assert rows(df.select(F.size("a.b"))) == [(0,), (2,)]


def test_unknown_save_mode(spark, tmp_path):
    with pytest.raises(ValueError):
        files.write_files(spark.range(1), str(tmp_path / "x"), mode="replace")


def test_ingest_folder_names_skips_and_isolates(spark, tmp_path):
    (tmp_path / "Sales Order-2.csv").write_text("id,full name\n1,x\n2,y\n")
    (tmp_path / "dbo.ErrorLog.csv").write_text("a,b\n")
    (tmp_path / "blank.csv").write_text("")
    (tmp_path / "note.txt").write_text("no table")
    frames, problems = files.ingest_folder(spark, str(tmp_path))
    assert problems == {}
    assert sorted(frames) == ["dbo_errorlog", "sales_order_2"]
    assert frames["sales_order_2"].columns == ["id", "full_name"]
    assert frames["dbo_errorlog"].count() == 0


def test_ingest_folder_keeps_files_of_like_names(spark, tmp_path):
    for i, name in enumerate(("a-b", "a_b", "A b")):
        (tmp_path / f"{name}.csv").write_text(f"id\n{i}\n")
    frames, problems = files.ingest_folder(spark, str(tmp_path))
    assert problems == {} and len(frames) == 3
    assert sorted(r[0] for df in frames.values() for r in df.collect()) == sorted(r[0] for n in frames for r in frames[n].collect())
    assert len({str(df.first()[0]) for df in frames.values()}) == 3


def test_copy_into_loads_once_and_merges(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("id,x\n1,p\n2,q\n")
    b.write_text("id,x,y\n3,r,s\n")
    target = str(tmp_path / "stage")
    assert files.copy_into(spark, target, [str(a)]) == [str(a)]
    assert files.copy_into(spark, target, [str(a), str(b)]) == [str(b)]
    assert files.copy_into(spark, target, [str(a), str(b)]) == []
    got = files.read_copied(spark, target).select("id", "x", "y")
    assert rows(got) == [("1", "p", None), ("2", "q", None), ("3", "r", "s")]


def test_copy_into_repeats_a_load_that_broke_off(spark, tmp_path):
    a = tmp_path / "a.csv"
    a.write_text("id\n1\n")
    target = str(tmp_path / "stage")
    files.copy_into(spark, target, [str(a)])
    for folder in os.listdir(target):
        if folder.startswith("source_id="):
            (tmp_path / "stage" / folder / "_SUCCESS").unlink()
    assert files.copy_into(spark, target, [str(a)]) == [str(a)]
    assert files.read_copied(spark, target).count() == 1


def test_snapshots_need_every_file(spark, tmp_path):
    for date, names in {"2024-01-01": ["l.csv", "h.csv"], "2024-02-01": ["l.csv"], "notes": ["l.csv", "h.csv"]}.items():
        (tmp_path / date).mkdir()
        for n in names:
            (tmp_path / date / n).write_text("id\n1\n")
    dates = files.complete_snapshots(spark, str(tmp_path), ["l.csv", "h.csv"])
    assert dates == ["2024-01-01"]
    got = files.read_snapshots(spark, str(tmp_path), "l.csv", dates, schema="id int")
    assert [(r.id, str(r.snapshot_date)) for r in got.collect()] == [(1, "2024-01-01")]


def test_jdbc_options():
    got = jdbc.read_options("jdbc:x", "t", driver="d", partition_column="id", lower=0, upper=99, num_partitions=4)
    assert got["partitionColumn"] == "id" and got["upperBound"] == "99" and got["dbtable"] == "t"
    assert jdbc.read_options("jdbc:x", query="select 1")["query"] == "select 1"
    for bad in ({}, {"table": "t", "query": "q"}, {"table": "t", "partition_column": "id"},
                {"query": "q", "partition_column": "id", "lower": 0, "upper": 1, "num_partitions": 2}):
        with pytest.raises(ValueError):
            jdbc.read_options("jdbc:x", **bad)


def test_avro_is_gated(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)avro"):
        files.read_avro(spark, str(tmp_path)).collect()


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    a = spark.range(1000).withColumn("x", F.col("id") % 7)
    for name in ("bucket_a", "bucket_b"):
        tables.write_table(a, name, mode="overwrite", bucket_by=(4, ["id"]), path=str(tmp_path / name))
    joined = spark.table("bucket_a").join(spark.table("bucket_b").hint("merge"), "id")
    assert "Exchange" not in plan(joined)
    assert joined.count() == 1000


def test_append_by_name(spark, tmp_path):
    tables.write_table(spark.createDataFrame([(1, "a")], "id int, name string"), "by_name", mode="overwrite", path=str(tmp_path / "t"))
    tables.append_by_name(spark.createDataFrame([("b", 2)], "name string, id int"), "by_name")
    assert rows(spark.table("by_name")) == [(1, "a"), (2, "b")]


def test_views(spark):
    df = spark.range(3)
    tables.register_view(df, "v_once", replace=False)
    with pytest.raises(AnalysisException):
        tables.register_view(df, "v_once", replace=False)
    tables.register_view(df, "v_global", everywhere=True)
    assert spark.sql("SELECT * FROM global_temp.v_global").count() == 3
    assert tables.drop_view(spark, "v_once")


def test_calendar(spark):
    days = generated.calendar(spark, "2020-02-28", "2020-03-01")
    assert rows(days, "date_key", "day", "week_of_year", "day_name") == [
        (20200228, 28, 9, "Fri"), (20200229, 29, 9, "Sat"), (20200301, 1, 9, "Sun")]


def test_synthetic_sales_is_reproducible(spark):
    one = generated.synthetic_sales(spark, customers=50, products=20, orders=100, items=200)
    two = generated.synthetic_sales(spark, customers=50, products=20, orders=100, items=200)
    assert rows(one["order_items"]) == rows(two["order_items"].repartition(5))
    orphans = one["orders"].join(one["customers"], "customer_id", "left_anti")
    assert orphans.count() == 0


def test_scratch_paths_are_shared_and_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(shared_dir(spark))


def test_synthetic_sales_deals_rows_by_their_number(spark, tmp_path, monkeypatch):
    import __spark_entry__ as entry
    from tallgrass import session
    from tests.oracle import compare, duck

    made = {
        "customer": "SELECT id AS c_custkey FROM range(30)",
        "part": "SELECT id AS p_partkey, IF(id = 7, NULL, concat('Brand#', id % 3)) AS p_brand FROM range(20)",
        "orders": "SELECT id AS o_orderkey, IF(id = 5, NULL, id % 31) AS o_custkey FROM range(200) UNION ALL SELECT 6, 7",
        "lineitem": "SELECT id % 210 AS l_orderkey, IF(id = 9, NULL, id % 23) AS l_partkey, cast(id % 7 AS int) AS l_linenumber FROM range(800)"}
    for name, sql in made.items():
        spark.sql(sql).coalesce(1).write.parquet(str(tmp_path / f"{name}-made"))
        next((tmp_path / f"{name}-made").glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    monkeypatch.setitem(session.dealt.__kwdefaults__, "each", 50)
    query, sql = entry.queries()["synthetic_sales_source"], entry.oracle_sql()["synthetic_sales_source"]
    assert compare(spark, duck(str(tmp_path)), query, sql, str(tmp_path)) is None
    assert plan(query(spark, str(tmp_path))).count("16), REPARTITION_BY_NUM") == 2  # by order, then by customer and brand


def test_lookup_side_is_broadcast_or_hashed(spark, monkeypatch):
    from tallgrass import session

    big, little = spark.range(1000).toDF("k"), spark.range(10).toDF("k")
    assert "BroadcastHashJoin" in plan(big.join(session.lookup(little), "k"))
    monkeypatch.setattr(session, "broadcast_checked", lambda df: df)
    assert "ShuffledHashJoin" in plan(big.join(session.lookup(little), "k"))

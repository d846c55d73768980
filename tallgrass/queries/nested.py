"""Arrays, maps, JSON and generators. Collections are returned as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import nested as A
from tallgrass.functions.numbers import int_or_null
from tallgrass.queries import query, read


def joined(col, name):
    return F.array_join(col, ",").alias(name)


def parts(spark, sf):
    return read(spark, sf, "part").withColumn("w", F.split("p_name", " "))


@query("SELECT p_partkey, string_split(p_name, ' ')[1] AS first, string_split(p_name, ' ')[2] AS second, string_split(p_name, ' ')[9] AS ninth FROM part")
def arr_split_index(spark, sf):
    w = F.col("w")
    return parts(spark, sf).select("p_partkey", A.element(w, 0).alias("first"), A.element(w, 1).alias("second"), A.element(w, 8).alias("ninth"))


@query("""SELECT doc_id, list_contains(string_split(text, ' '), '') AS has_empty,
  len(list_filter(string_split(text, ' '), lambda x: x <> '')) AS n_words FROM documents""")
def arr_contains_remove(spark, sf):
    pieces = F.split("text", " ")
    return read(spark, sf, "documents").select(
        "doc_id", F.array_contains(pieces, "").alias("has_empty"), F.size(A.without_empty(pieces)).cast("bigint").alias("n_words"))


@query("SELECT lang, round(avg(len(string_split(text, ' '))), 6) AS mean_words, max(len(string_split(text, ' '))) AS most FROM documents GROUP BY lang")
def arr_size_avg(spark, sf):
    n = F.size(F.split("text", " "))
    return read(spark, sf, "documents").groupBy("lang").agg(F.round(F.avg(n), 6).alias("mean_words"), F.max(n).cast("bigint").alias("most"))


@query("""
WITH a AS (SELECT p_partkey, string_split(p_name, ' ') AS w, [p_brand, p_type, p_type] AS b FROM part)
SELECT p_partkey, array_to_string(b, ',') AS arr, list_unique(b)::INT AS n_distinct, list_min(w) AS low, list_max(w) AS high,
  coalesce(list_position(w, 'ring'), 0)::BIGINT AS place, p.p_type || ',' || p.p_type AS twice, array_to_string(list_sort(w), ',') AS sorted,
  list_has_any(b, [p.p_type]) AS overlap, w[1] || '=' || b[1] AS zipped
FROM a JOIN part p USING (p_partkey)""")
def arr_library(spark, sf):
    b = F.array("p_brand", "p_type", "p_type")
    first = F.arrays_zip(F.col("w").alias("x"), F.col("b").alias("y"))[0]
    return parts(spark, sf).withColumn("b", b).select(
        "p_partkey", joined("b", "arr"), F.size(F.array_distinct("b")).alias("n_distinct"), F.array_min("w").alias("low"),
        F.array_max("w").alias("high"), F.array_position("w", "ring").alias("place"),
        joined(F.array_repeat("p_type", 2), "twice"), joined(F.array_sort("w"), "sorted"),
        F.arrays_overlap("b", F.array("p_type")).alias("overlap"),
        F.concat_ws("=", first["x"], first["y"]).alias("zipped"))


@query("""
WITH a AS (SELECT n_nationkey, [n_nationkey, n_regionkey, 3] AS x, [n_regionkey, 4, 3] AS y FROM nation)
SELECT n_nationkey, array_to_string(list_sort(list_intersect(x, y)), ',') AS common, array_to_string(list_sort(list_distinct(x || y)), ',') AS either,
  array_to_string(list_sort(list_distinct(list_filter(x, lambda e: NOT list_contains(y, e)))), ',') AS only_x,
  array_to_string(list_sort(list_distinct(list_filter(x, lambda e: NOT list_contains(y, e)) || list_filter(y, lambda e: NOT list_contains(x, e)))), ',') AS one_side FROM a""")
def array_set_ops(spark, sf):
    x, y = F.array("n_nationkey", "n_regionkey", F.lit(3)), F.array("n_regionkey", F.lit(4), F.lit(3))
    return read(spark, sf, "nation").select(
        "n_nationkey", *[F.array_join(F.array_sort(c).cast("array<string>"), ",").alias(n) for n, c in (
            ("common", F.array_intersect(x, y)), ("either", F.array_union(x, y)),
            ("only_x", F.array_except(x, y)), ("one_side", A.symmetric_difference(x, y)))])


@query("""SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, ' '), lambda w: length(w) > 12), lambda w: '<' || w || '>'), ',') AS long_words FROM documents""")
def arr_higher_order(spark, sf):
    long_words = F.transform(F.filter(F.split("text", " "), lambda w: F.length(w) > 12),
                             lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    return read(spark, sf, "documents").select("doc_id", joined(long_words, "long_words"))


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def explode_words(spark, sf):
    return parts(spark, sf).select("p_partkey", F.explode("w").alias("word"))


@query("""SELECT word, count(*) AS n FROM (SELECT unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def word_count(spark, sf):
    words = read(spark, sf, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT item_id, array_to_string(list_sort(list_distinct(string_split(lower(text), ' '))), ' ') AS words FROM benchmark")
def sorted_unique_words(spark, sf):
    return read(spark, sf, "benchmark").select(
        "item_id", F.array_join(A.sorted_unique(F.split(F.lower("text"), " ")), " ").alias("words"))


def maps(spark, sf):
    """Keys in a different order from row to row, as a lookup must not depend on it."""
    flip = F.col("p_size") > 25
    keys = F.when(flip, F.array(F.lit("brand"), F.lit("type"))).otherwise(F.array(F.lit("type"), F.lit("brand")))
    values = F.when(flip, F.array("p_brand", "p_type")).otherwise(F.array("p_type", "p_brand"))
    return read(spark, sf, "part").select("p_partkey", "p_size", F.map_from_arrays(keys, values).alias("m"))


@query("SELECT p_partkey, p_brand AS brand, p_type AS type, NULL::VARCHAR AS colour FROM part")
def map_build_access(spark, sf):
    m = F.col("m")
    return maps(spark, sf).select("p_partkey", A.map_value(m, "brand").alias("brand"), A.map_value(m, "type").alias("type"),
                                  A.map_value(m, "colour").alias("colour"))


@query("SELECT p_partkey, CASE WHEN p_size > 25 THEN 'brand,type' ELSE 'type,brand' END AS keys, CASE WHEN p_size > 25 THEN p_brand || ',' || p_type ELSE p_type || ',' || p_brand END AS vals FROM part")
def map_keys_values(spark, sf):
    return maps(spark, sf).select("p_partkey", joined(F.map_keys("m"), "keys"), joined(F.map_values("m"), "vals"))


@query("SELECT p_partkey, 'brand' AS key, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'type', p_type FROM part")
def map_explode(spark, sf):
    return maps(spark, sf).select("p_partkey", F.explode("m"))


@query("SELECT p_partkey, p_brand AS brand, CAST(regexp_extract(p_brand, '[0-9]+') AS INT) AS brand_no FROM part")
def map_to_columns(spark, sf):
    m = F.col("m")
    return maps(spark, sf).select("p_partkey", m["brand"].alias("brand"),
                                  int_or_null(F.regexp_extract(m["brand"], "[0-9]+", 0)).alias("brand_no"))


@query("""SELECT p_partkey, p_size AS size, 'none' AS colour, CASE WHEN p_size > 25 THEN 3 ELSE 3 END AS n FROM part""")
def map_library(spark, sf):
    extra = F.map_from_entries(F.array(F.struct(F.lit("size"), F.col("p_size").cast("string"))))
    merged = maps(spark, sf).withColumn("m", F.map_concat("m", extra))
    return merged.select("p_partkey", F.col("m")["size"].cast("int").alias("size"),
                         A.map_value(F.col("m"), "colour", "none").alias("colour"), F.size("m").alias("n"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type AS second FROM events""")
def json_path(spark, sf):
    doc = F.to_json(F.struct(F.array(F.lit("x"), F.col("event_type")).alias("a")))
    return read(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                                            F.get_json_object(doc, "$.a[1]").alias("second"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.missing') AS missing FROM events""")
def json_tuple(spark, sf):
    return read(spark, sf, "events").select("event_id", F.json_tuple("props", "k", "missing").alias("k", "missing"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, event_type || '!' AS second FROM events""")
def json_parse(spark, sf):
    doc = F.to_json(F.create_map(F.lit("d"), F.array(F.lit("x"), F.concat("event_type", F.lit("!")))))
    return read(spark, sf, "events").select(
        "event_id", F.from_json("props", "map<string,int>")["k"].alias("k"),
        F.from_json(doc, "map<string,array<string>>")["d"][1].alias("second"))


@query("""SELECT n_nationkey, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS j, '{"' || n_name || '":' || n_regionkey || '}' AS m FROM nation""")
def json_write(spark, sf):
    return read(spark, sf, "nation").select(
        "n_nationkey", F.to_json(F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))).alias("j"),
        F.to_json(F.create_map("n_name", "n_regionkey")).alias("m"))

"""String, regular-expression and numeric functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import numbers as M
from tallgrass.functions import text as T
from tallgrass.queries import query, read

_name = "p_name"


def part(spark, sf, *cols):
    return read(spark, sf, "part").select("p_partkey", *cols)


@query("""SELECT p_partkey, lower(p_brand) AS low, upper(p_name) AS up,
  array_to_string(list_transform(string_split(lower(p_name), ' '), lambda x: upper(x[1:1]) || x[2:]), ' ') AS title FROM part""")
def str_case(spark, sf):
    return part(spark, sf, F.lower("p_brand").alias("low"), F.upper(_name).alias("up"), F.initcap(_name).alias("title"))


@query("SELECT p_partkey, length(p_name || '  ') AS raw, length(rtrim(p_name || '  ')) AS trimmed FROM part")
def str_length(spark, sf):
    padded = F.concat(F.col(_name), F.lit("  "))
    return part(spark, sf, F.length(padded).alias("raw"), T.trimmed_length(padded).alias("trimmed"))


@query("SELECT p_partkey, substr(p_name, 1, 1) AS initial, substr(p_name, 3, 4) AS middle FROM part")
def str_substr(spark, sf):
    return part(spark, sf, F.substring(_name, 1, 1).alias("initial"), F.substring(_name, 3, 4).alias("middle"))


@query("SELECT p_partkey, instr(p_name, 'i') AS place, instr(p_name, 'i') - 1 AS place0, CASE WHEN instr(substr(p_name, 3), 'e') > 0 THEN instr(substr(p_name, 3), 'e') + 2 ELSE 0 END AS later FROM part")
def str_find(spark, sf):
    return part(spark, sf, T.find(F.col(_name), "i").alias("place"), T.find(F.col(_name), "i", zero_based=True).alias("place0"),
                F.locate("e", F.col(_name), 3).alias("later"))


@query("SELECT p_partkey, split_part(p_name, ' ', 1) AS first, split_part(p_name, ' ', -1) AS last FROM part")
def str_split_part(spark, sf):
    return part(spark, sf, T.first_word(F.col(_name)).alias("first"), T.last_word(F.col(_name)).alias("last"))


@query("""SELECT p_partkey, trim('  ' || p_brand || ' ') AS t, ltrim('  ' || p_brand) AS l, rtrim(p_brand || '  ') || '|' AS r,
  lpad(p_type, 10, '.') AS lp, rpad(p_type, 10, '.') AS rp FROM part""")
def str_trim_pad(spark, sf):
    b, two = F.col("p_brand"), F.lit("  ")
    return part(spark, sf, F.trim(F.concat(two, b, F.lit(" "))).alias("t"), F.ltrim(F.concat(two, b)).alias("l"),
                F.concat(F.rtrim(F.concat(b, two)), F.lit("|")).alias("r"),
                F.lpad("p_type", 10, ".").alias("lp"), F.rpad("p_type", 10, ".").alias("rp"))


@query("SELECT p_partkey, p_brand || '/' || p_type AS joined, concat_ws('-', p_brand, p_type, p_size) AS key FROM part")
def str_concat(spark, sf):
    return part(spark, sf, F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
                F.concat_ws("-", "p_brand", "p_type", F.col("p_size").cast("string")).alias("key"))


@query("""SELECT p_partkey, array_to_string(list_transform(string_split(lower(p_name), ' '), lambda x: upper(x[1:1]) || x[2:]), ' ') AS name FROM part""")
def str_capitalize_words(spark, sf):
    return part(spark, sf, T.capitalize_words(F.col(_name)).alias("name"))


@query("""SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]')) AS letters, len(regexp_extract_all(text, '[0-9]')) AS digits,
  len(regexp_extract_all(text, '[A-Z]')) AS uppers, len(regexp_extract_all(text, '[a-z]')) AS lowers FROM documents""")
def str_char_counts(spark, sf):
    """Letters are the upper and lower ones together, so three passes give four counts."""
    t = F.col("text")
    counts = read(spark, sf, "documents").select(
        "doc_id", T.count_chars(t, "0-9").alias("digits"), T.count_chars(t, "A-Z").alias("uppers"),
        T.count_chars(t, "a-z").alias("lowers"))
    return counts.withColumn("letters", F.col("uppers") + F.col("lowers"))


@query("""
WITH e AS (SELECT c_custkey, lower(c_mktsegment) || c_nationkey || '@firm' || (c_custkey + 7) || '.com' AS email, c_name FROM customer)
SELECT c_custkey, regexp_extract(email, '^([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+)\\..*$', 1) AS who,
  regexp_extract(email, '^([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+)\\..*$', 2) AS company,
  array_to_string(regexp_extract_all(c_name || ' ' || email, '\\d+'), ',') AS numbers FROM e""")
def str_regex_extract(spark, sf):
    email = F.concat(F.lower("c_mktsegment"), "c_nationkey", F.lit("@firm"), F.col("c_custkey") + 7, F.lit(".com"))
    return read(spark, sf, "customer").withColumn("email", email).select(
        "c_custkey", T.email_user(F.col("email")).alias("who"), T.email_company(F.col("email")).alias("company"),
        F.array_join(T.all_numbers(F.concat_ws(" ", "c_name", "email")), ",").alias("numbers"))


@query("""
SELECT user_id, concat_ws(', ', CASE WHEN g > 12 THEN (g - 12) || ' Gold' END, CASE WHEN s > 12 THEN (s - 12) || ' Silver' END) AS medals FROM (
  SELECT user_id, count(*) FILTER (event_type = 'purchase') AS g, count(*) FILTER (event_type = 'signup') AS s FROM events GROUP BY 1)""")
def str_conditional_concat(spark, sf):
    counts = read(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("g"), F.count_if(F.col("event_type") == "signup").alias("s"))
    return counts.select("user_id", T.positive_parts({"Gold": F.col("g") - 12, "Silver": F.col("s") - 12}).alias("medals"))


@query("""SELECT o_orderkey, round(o_totalprice / 7, 4) AS four, round(o_totalprice)::BIGINT AS whole, round(o_totalprice, -3) AS thousands FROM orders""")
def math_round(spark, sf):
    return read(spark, sf, "orders").select(
        "o_orderkey", F.round(F.col("o_totalprice") / 7, 4).alias("four"),
        M.to_integer(F.col("o_totalprice")).alias("whole"), F.round("o_totalprice", -3).alias("thousands"))


@query("""
SELECT c_custkey, floor(c_acctbal / 7)::BIGINT AS q, round(c_acctbal - 7 * floor(c_acctbal / 7), 4) AS r, abs(c_acctbal) AS a,
  round(sqrt(abs(c_acctbal)), 6) AS root, round(power(c_acctbal / 1000, 3), 6) AS cube, round(ln(abs(c_acctbal) + 1), 6) AS log,
  floor(c_acctbal)::BIGINT AS f, ceil(c_acctbal)::BIGINT AS c FROM customer""")
def math_arith(spark, sf):
    x = F.col("c_acctbal")
    return read(spark, sf, "customer").select(
        "c_custkey", M.floor_divide(x, F.lit(7.0)).cast("bigint").alias("q"),
        F.round(M.floor_mod(x, F.lit(7.0)), 4).alias("r"), F.abs(x).alias("a"), F.round(F.sqrt(F.abs(x)), 6).alias("root"),
        F.round(F.pow(x / 1000, F.lit(3)), 6).alias("cube"), F.round(F.ln(F.abs(x) + 1), 6).alias("log"),
        F.floor(x).cast("bigint").alias("f"), F.ceil(x).cast("bigint").alias("c"))


@query("""
SELECT doc_id, coalesce(quality, toxic, -1) AS known, quality IS NULL AS missing, greatest(coalesce(quality, 0), coalesce(toxic, 0)) AS worst
FROM documents LEFT JOIN labels USING (doc_id)""")
def null_coalesce(spark, sf):
    joined = read(spark, sf, "documents").select("doc_id").join(read(spark, sf, "labels"), "doc_id", "left")
    zero = F.lit(0)
    return joined.select("doc_id", F.coalesce("quality", "toxic", F.lit(-1)).alias("known"), F.isnull("quality").alias("missing"),
                         F.greatest(F.coalesce("quality", zero), F.coalesce("toxic", zero)).alias("worst"))

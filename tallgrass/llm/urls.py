"""URL filters: a sort-merge range join of urls with host and path rules."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.llm.common import LOWER, UPPER, ascii_lower, packed
from tallgrass.llm.registry import query
from tallgrass.queries import read

#: The rules of the registered query.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1))).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def host_key(host: Column) -> Column:
    """The host's labels in reverse, each followed by a dot: a host and its subdomains share a prefix."""
    return F.when(host == "", F.lit("")).otherwise(F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit(".")))


def _sweep(default: str):
    """Read events in (part, key) order; rules open and close on a stack, urls look at what is open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            took, rules, verdicts = [], [], []
            names = ("part", "key", "end", "host", "path", "rule_host", "verdict")
            columns = [batch.column(n).to_pylist() for n in names]
            for i, (p, key, end, host, path, rule_host, verdict) in enumerate(zip(*columns)):
                if p != part:
                    part, stack = p, []
                while stack and stack[-1][0] is not None and key >= stack[-1][0]:
                    stack.pop()
                if rule_host is not None:
                    stack.append((end, path, rule_host + path, verdict, len(rule_host)))
                    continue
                fits = [r for r in stack if path.startswith(r[1])]
                best = max(fits, key=lambda r: (len(r[2]), r[4], r[3] == "block", r[2]), default=None)
                took.append(i)
                rules.append(best[2] if best else None)
                verdicts.append(best[3] if best else default)
            picked = batch.take(pa.array(took, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [picked.column("row"), picked.column("host"), picked.column("path"), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())],
                names=["row", "host", "path", "rule", "verdict"])

    return run


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow", sample: int = 4096,
               n_parts: int | None = None) -> DataFrame:
    """``pages`` (a url column) as ``row``, ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has host, path and verdict (``allow`` or ``block``). A rule fits its host and all
    subdomains if the url's path starts with the rule's; of several the longest ``host + path``
    wins, of those the longer host, of equal rules ``block``. A rule of host '' fits every url.
    No rule: ``default``. A null url, or one without ``://``, has an empty host and path.

    The reversed host with a dot at its end makes a rule the interval of keys that it is a
    prefix of. Range bounds come from about ``sample`` of the urls' keys (they only shape the
    parts); equal bounds, so a hot host or url, share their rows out by a
    digest of the url and the row's place. Columns of any type pass through. A rule goes
    to every part that its interval meets. Each part is sorted and swept once, and the rules
    open at a key are a stack, since such intervals are nested.
    """
    spark = pages.sparkSession
    n_parts = n_parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = packed(pages)
    row_type = rows.schema["row"].dataType
    text = F.coalesce(F.col(f"row.{url}").cast("string"), F.lit(""))
    rows = rows.select("row", host_of(text).alias("host"), path_of(text).alias("path"),
                       F.xxhash64(text, F.monotonically_increasing_id()).alias("draw"))
    keyed = rows.select("*", host_key(F.col("host")).alias("host_key"))
    keyed = keyed.select("*", F.concat_ws("\x01", "host_key", "path").alias("key"))
    one_of = max(1, rows.count() // sample)
    seen = sorted(r.key for r in keyed.where(F.pmod(F.xxhash64("draw", "key"), F.lit(one_of)) == 0).select("key", "draw").distinct().collect())
    bounds = [seen[i * len(seen) // n_parts] for i in range(1, n_parts)] if seen else []
    step = max(1, math.isqrt(len(bounds)))
    edges, tops = (F.array(*map(F.lit, x)) if x else F.array().cast("array<string>") for x in (bounds, bounds[::step]))

    def ahead(test) -> Column:
        """How many bounds pass a test that the first ones pass: of every ``step``-th one, then of those after the last of these."""
        blocks = F.size(F.filter(tops, test))
        rest = F.size(F.filter(F.slice(edges, (F.greatest(blocks, F.lit(1)) - 1) * step + 1, F.lit(step)), test))
        return F.when(blocks == 0, 0).otherwise((blocks - 1) * step + rest)

    def below(c: Column) -> Column:
        return ahead(lambda b: b < c)

    def up_to(c: Column) -> Column:
        return ahead(lambda b: b <= c)

    spans = keyed.select("*", below(F.col("key")).alias("lo"), up_to(F.col("key")).alias("hi"))
    none = F.lit(None).cast("string")
    urls = spans.select((F.col("lo") + F.pmod("draw", F.col("hi") - F.col("lo") + 1)).cast("int").alias("part"), "key", F.lit(1).alias("kind"),
                        none.alias("end"), "host", "path", none.alias("rule_host"), none.alias("verdict"), "row")
    heads = rules.select(ascii_lower(F.coalesce(F.col("host"), F.lit(""))).alias("rule_host"), F.coalesce(F.col("path"), F.lit("")).alias("path"), "verdict")
    heads = heads.select("*", host_key(F.col("rule_host")).alias("key"))
    # '/' follows '.' in order: the first key that doesn't start with the rule's
    heads = heads.select("*", F.when(F.col("key") != "", F.concat(F.expr("substring(key, 1, length(key) - 1)"), F.lit("/"))).alias("end"))
    last = F.when(F.col("end").isNull(), F.lit(len(bounds))).otherwise(up_to(F.col("end")))
    opened = heads.select(F.explode(F.sequence(below(F.col("key")), last)).alias("part"), "key", F.lit(0).alias("kind"), "end",
                          F.lit("").alias("host"), "path", "rule_host", "verdict", F.lit(None).cast(row_type).alias("row"))
    events = urls.unionByName(opened).repartition(n_parts, "part")
    # a wider interval opens first
    events = events.sortWithinPartitions("part", "key", "kind", F.col("end").desc_nulls_first())
    schema = T.StructType([T.StructField("row", row_type), *[T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict")]])
    return events.mapInArrow(_sweep(default), schema)


def allowed_pages(pages: DataFrame, rules: DataFrame, **settings) -> DataFrame:
    """The pages whose url isn't blocked; same columns."""
    return judge_urls(pages, rules, **settings).where("verdict <> 'block'").select("row.*")


_REST = "substr(url, strpos(url, '://') + 3)"


@query("op4_url_rules", f"""
WITH u AS (
  SELECT page_id,
    CASE WHEN strpos(url, '://') > 0 THEN translate(regexp_extract({_REST}, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') ELSE '' END AS host,
    CASE WHEN strpos(url, '://') > 0 THEN regexp_extract({_REST}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
j AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM j""")
def op4_url_rules(spark, sf_dir):
    """Verdict of the four rules on every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return out.select("row.page_id", "host", "path", "rule", "verdict")

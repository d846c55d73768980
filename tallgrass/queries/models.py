"""Classification over the labelled documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.operators.sampling import balance_labels, split_by_hash
from tallgrass.plans import models as M
from tallgrass.queries import query, read
from tallgrass.session import materialize

FEATURES = ["n_chars", "n_words", "n_digits", "n_upper", "n_lines"]


def features(spark, sf):
    t = F.col("text")
    docs = read(spark, sf, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split(t, " ")).cast("double").alias("n_words"),
        T.count_chars(t, "0-9").cast("double").alias("n_digits"), T.count_chars(t, "A-Z").cast("double").alias("n_upper"),
        F.size(F.split(t, "\n")).cast("double").alias("n_lines"))
    return docs.join(read(spark, sf, "labels"), "doc_id")


def prepared(spark, sf):
    """Label index 1 is the rarer label; train and test parts by digest of the id. The texts are read once."""
    df = materialize(features(spark, sf).select("doc_id", F.col("quality").cast("string").alias("quality"), *FEATURES))
    vectors = M.vectorize(df, "quality", FEATURES).select("doc_id", "label", "features")
    parts = split_by_hash(vectors, "doc_id", {"train": 0.8, "test": 0.2}, seed=7)
    return parts.where("split = 'train'"), parts.where("split = 'test'")


_RULE = "(CASE WHEN n_chars > 1200 THEN 1 ELSE 0 END)"


def ruled(spark, sf):
    return features(spark, sf).withColumn("prediction", F.expr(_RULE))


@query("""
SELECT doc_id, n_chars, CASE WHEN lang = 'en' THEN 1.0 ELSE 0.0 END::DOUBLE AS lang, CASE WHEN toxic = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS toxic
FROM documents JOIN labels USING (doc_id)""")
def churn_features(spark, sf):
    df = read(spark, sf, "documents").join(read(spark, sf, "labels"), "doc_id").select(
        "doc_id", "n_chars", "source", F.when(F.col("lang") == "en", " Yes").otherwise("no").alias("lang"),
        F.when(F.col("toxic") == 1, "yes").otherwise("No").alias("toxic"), "quality")
    return M.churn_features(df, drop=["source", "quality"], flags=["lang", "toxic"])


@query("""
SELECT n_nationkey, """ + ", ".join(f"CASE WHEN r_name = '{r}' THEN 1 ELSE 0 END AS \"r_name_{r}\"" for r in (
    "AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")) + " FROM nation JOIN region ON n_regionkey = r_regionkey")
def one_hot(spark, sf):
    joined = read(spark, sf, "nation").join(read(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return M.one_hot(joined.select("n_nationkey", "r_name"), ["r_name"])


_PREDICTED = f"(SELECT quality, {_RULE} AS prediction FROM documents JOIN labels USING (doc_id))"
_REPORT = f"""
WITH c AS (SELECT count(*) FILTER (quality = 1 AND prediction = 1) AS tp, count(*) FILTER (quality <> 1 AND prediction <> 1) AS tn,
  count(*) FILTER (quality <> 1 AND prediction = 1) AS fp, count(*) FILTER (quality = 1 AND prediction <> 1) AS fn FROM {_PREDICTED}),
r AS (SELECT *, tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, tn / (tn + fn) AS p0, tn / (tn + fp) AS r0 FROM c),
f AS (SELECT *, 2 * p1 * r1 / (p1 + r1) AS f1, 2 * p0 * r0 / (p0 + r0) AS f0, (tp + fn)::DOUBLE AS n1, (tn + fp)::DOUBLE AS n0 FROM r)
SELECT tp, tn, fp, fn, round(p1, 9) AS precision_1, round(r1, 9) AS recall_1, round(p0, 9) AS precision_0, round(r0, 9) AS recall_0,
  round((tp + tn) / (n1 + n0), 9) AS accuracy, round(f0, 9) AS f1_0, round(f1, 9) AS f1_1, round((p1 * n1 + p0 * n0) / (n1 + n0), 9) AS weighted_precision,
  round((r1 * n1 + r0 * n0) / (n1 + n0), 9) AS weighted_recall, round((f1 * n1 + f0 * n0) / (n1 + n0), 9) AS weighted_f1 FROM f"""


@query(_REPORT)
def classification_report(spark, sf):
    out = M.binary_report(ruled(spark, sf), "quality", "prediction")
    return out.select("tp", "tn", "fp", "fn", *[F.round(c, 9).alias(c) for c in out.columns[4:]])


@query(f"SELECT quality, prediction, count(*) AS n FROM {_PREDICTED} GROUP BY ALL")
def confusion_matrix(spark, sf):
    return M.confusion_matrix(ruled(spark, sf), "quality", "prediction")


@query("""
WITH c AS (SELECT quality, count(*) AS n FROM labels JOIN documents USING (doc_id) GROUP BY 1),
i AS (SELECT quality, (row_number() OVER (ORDER BY n DESC, quality) - 1)::DOUBLE AS label FROM c)
SELECT doc_id, label, n_chars::DOUBLE AS n_chars, toxic::DOUBLE AS toxic FROM documents JOIN labels USING (doc_id) JOIN i USING (quality)""")
def vectorize_index(spark, sf):
    """Vector entries are returned as columns; the two-valued entry stays 0/1."""
    from pyspark.ml.functions import vector_to_array

    df = read(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("double").alias("n_chars")).join(read(spark, sf, "labels"), "doc_id")
    df = df.withColumn("quality", F.col("quality").cast("string")).withColumn("toxic", F.col("toxic").cast("double"))
    out = M.vectorize(df, "quality", ["n_chars", "toxic"]).withColumn("v", vector_to_array("features"))
    return out.select("doc_id", "label", F.col("v")[0].alias("n_chars"), F.col("v")[1].alias("toxic"))


@query()
def logit_train_eval(spark, sf):
    df = features(spark, sf).withColumn("label", F.col("quality").cast("double"))
    parts = split_by_hash(df, "doc_id", {"train": 0.8, "test": 0.2}, seed=7)
    train = parts.where("split = 'train'")
    model, coefficients = M.logit_train(train, FEATURES, reg=1.0 / max(train.count(), 1))
    report = M.binary_report(M.score(model, parts.where("split = 'test'"), FEATURES), "label", "prediction")
    return coefficients.withColumn("test_accuracy", report.select("accuracy").scalar())


@query()
def tree_train(spark, sf):
    train, test = prepared(spark, sf)
    return M.binary_report(M.tree_train(train).transform(test), "label", "prediction")


@query(f"""
WITH s AS (SELECT quality, doc_id, ('0x' || substr(md5(doc_id || ':7'), 1, 8))::BIGINT % 5 AS fold FROM documents JOIN labels USING (doc_id))
SELECT fold::INT AS fold, quality, count(*) AS n FROM s GROUP BY ALL""")
def cv_folds(spark, sf):
    """Rows of each class in each fold of the comparison."""
    return M.with_fold(features(spark, sf), "doc_id", 5, seed=7).groupBy("fold", "quality").agg(F.count(F.lit(1)).alias("n"))


@query()
def tree_cv_grid(spark, sf):
    train, _ = prepared(spark, sf)
    return M.tree_cv_grid(balance_labels(train, "label", id_col="doc_id", seed=3), id_col="doc_id")[1]


@query()
def classifier_compare(spark, sf):
    train, test = prepared(spark, sf)
    return M.compare_classifiers(train, test, M.default_models(), id_col="doc_id", folds=5)

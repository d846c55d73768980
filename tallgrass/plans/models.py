"""Classification: feature preparation, training, reports, comparison."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.operators.columns import numeric_columns
from tallgrass.operators.sampling import digest
from tallgrass.session import settled


def yes_no(df: DataFrame, cols: list[str], *, yes: str = "yes") -> DataFrame:
    """1.0 for the yes text in any case, 0.0 for other texts, null for null."""
    return df.withColumns({c: F.when(F.lower(F.trim(c)) == yes, 1.0).when(F.col(c).isNotNull(), 0.0) for c in cols})


def churn_features(df: DataFrame, *, drop: list[str], flags: list[str]) -> DataFrame:
    return yes_no(df.drop(*drop), flags)


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    """A 0/1 column per category, as wide as Spark lets a pivot be (``spark.sql.pivotMaxValues``).

    Beyond that a table of columns is no longer workable: use ``one_hot_vectors``, which has no limit.
    """
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    cells = []
    for c in cols:
        values = sorted(r[0] for r in df.select(c).distinct().where(F.col(c).isNotNull()).limit(most + 1).collect())
        if len(values) > most:
            raise ValueError(f"{c} has more than {most} categories; use one_hot_vectors")
        cells += [F.when(F.col(c) == v, 1).otherwise(0).alias(f"{c}_{v}") for v in values]
    return df.select(*[c for c in df.columns if c not in cols], *cells)


def one_hot_vectors(df: DataFrame, cols: list[str]) -> DataFrame:
    """A sparse 0/1 vector per column, with a place for every category and all zeros for null."""
    names = [f"{c}_index" for c in cols]
    stages = [StringIndexer(inputCols=cols, outputCols=names, handleInvalid="keep", stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCols=names, outputCols=[f"{c}_vector" for c in cols], dropLast=True)]
    return Pipeline(stages=stages).fit(df).transform(df).drop(*names)


def feature_pipeline(features: list[str], label: str, *, max_categories: int = 2) -> list:
    """Stages: label index, assembled vector, small-domain columns indexed as categories."""
    return [
        StringIndexer(inputCol=label, outputCol="label", handleInvalid="error"),
        VectorAssembler(inputCols=features, outputCol="assembled"),
        VectorIndexer(inputCol="assembled", outputCol="features", maxCategories=max_categories, handleInvalid="keep"),
    ]


def vectorize(df: DataFrame, label: str, features: list[str] | None = None) -> DataFrame:
    cols = features or [c for c in numeric_columns(df) if c != label]
    return Pipeline(stages=feature_pipeline(cols, label)).fit(df).transform(df)


def logit_train(train: DataFrame, features: list[str], *, reg: float, seed: int = 0):
    """Logistic regression and its coefficients, largest first."""
    vectors = VectorAssembler(inputCols=features, outputCol="features").transform(train)
    model = LogisticRegression(regParam=reg, maxIter=100).fit(vectors)
    rows = sorted(zip(features, map(float, model.coefficients), strict=True), key=lambda r: -r[1])
    return model, train.sparkSession.createDataFrame(rows, "feature string, coefficient double")


def score(model, df: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(VectorAssembler(inputCols=features, outputCol="features").transform(df))


def tree_train(train: DataFrame, *, depth: int = 2, bins: int = 32):
    return DecisionTreeClassifier(impurity="gini", maxDepth=depth, maxBins=bins, seed=0).fit(train)


def with_fold(df: DataFrame, id_col: str, folds: int, *, seed: int, name: str = "fold") -> DataFrame:
    """Fold 0 to ``folds - 1`` of each row by a digest of its id, whatever the layout."""
    number = F.conv(F.substring(digest(id_col, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(name, F.pmod(number, F.lit(folds)).cast("int"))


def _folded(train: DataFrame, id_col: str, folds: int, seed: int) -> DataFrame:
    """Label, features and fold in a layout that goes by the ids alone, so that learners that draw
    rows or cut points by partition draw the same ones."""
    return settled(with_fold(train, id_col, folds, seed=seed).select(id_col, "label", "features", "fold"), id_col)


def tree_cv_grid(train: DataFrame, *, id_col: str, depths=range(2, 8), folds: int = 3, seed: int = 7):
    """Depth of a decision tree by cross-validated F1; returns the model and a score per depth.

    Folds go by digests of ``id_col``: scores don't depend on how the rows lie.
    """
    tree = DecisionTreeClassifier(impurity="gini", maxBins=32, seed=seed)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, list(depths)).build()
    cv = CrossValidator(estimator=tree, estimatorParamMaps=grid, numFolds=folds, foldCol="fold", seed=seed, parallelism=4,
                        evaluator=MulticlassClassificationEvaluator(metricName="f1"))
    fitted = cv.fit(_folded(train, id_col, folds, seed))
    rows = [(int(d), float(f1)) for d, f1 in zip(depths, fitted.avgMetrics, strict=True)]
    return fitted, train.sparkSession.createDataFrame(rows, "max_depth int, f1 double")


def ranked_probability(predictions: DataFrame, id_col: str) -> DataFrame:
    """Probability of the positive label per row."""
    return predictions.select(id_col, vector_to_array("probability")[1].alias("probability"), "prediction")


def binary_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts, per-class and weighted precision, recall and F1, accuracy; one aggregation."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & ~p).alias("tn"),
                    F.count_if(~y & p).alias("fp"), F.count_if(y & ~p).alias("fn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    out = counts.withColumns({
        "precision_1": ratio(tp, tp + fp), "recall_1": ratio(tp, tp + fn),
        "precision_0": ratio(tn, tn + fn), "recall_0": ratio(tn, tn + fp),
        "accuracy": ratio(tp + tn, tp + tn + fp + fn)})
    for side in ("0", "1"):
        pr, rc = F.col(f"precision_{side}"), F.col(f"recall_{side}")
        out = out.withColumn(f"f1_{side}", ratio(2 * pr * rc, pr + rc))
    ones, zeros = tp + fn, tn + fp
    for m in ("precision", "recall", "f1"):
        out = out.withColumn(f"weighted_{m}", ratio(F.col(f"{m}_1") * ones + F.col(f"{m}_0") * zeros, ones + zeros))
    return out


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))


def default_models(seed: int = 7) -> dict:
    return {
        "logistic_regression": LogisticRegression(maxIter=50, regParam=0.01),
        "naive_bayes": NaiveBayes(modelType="gaussian"),
        "linear_svc": LinearSVC(maxIter=10, regParam=0.01),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, seed=seed),
        "random_forest": RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed),
        "gradient_boosting": GBTClassifier(maxIter=10, maxDepth=3, seed=seed),
    }


def multiclass_figures(counts: dict[tuple[float, float], int]) -> tuple[float, float, float, float]:
    """Weighted F1, precision and recall, and accuracy, from rows per (label, prediction)."""
    total = sum(counts.values())
    f1 = precision = recall = 0.0
    for c in {label for label, _ in counts}:
        hit = counts.get((c, c), 0)
        own, said = sum(n for (y, _), n in counts.items() if y == c), sum(n for (_, p), n in counts.items() if p == c)
        p, r = (hit / said if said else 0.0), hit / own
        precision, recall = precision + p * own / total, recall + r * own / total
        f1 += (2 * p * r / (p + r) if p + r else 0.0) * own / total
    return f1, precision, recall, sum(n for (y, p), n in counts.items() if y == p) / total if total else 0.0


def compare_classifiers(train: DataFrame, test: DataFrame, models: dict, *, id_col: str, folds: int = 5, seed: int = 7,
                        parallel: int = 6) -> DataFrame:
    """Cross-validated AUC and test metrics of each model, one row per model.

    Folds go by digests of ``id_col``, as columns of one persisted copy that all fits share. The test
    metrics come from one count of rows per label and prediction. The threads submit the Spark jobs of
    several fits at a time, as each fit is a chain of short jobs that alone leaves a cluster idle.
    """
    auc = BinaryClassificationEvaluator(metricName="areaUnderROC")
    train, test = _folded(train, id_col, folds, seed).persist(), test.select("label", "features").persist()

    def held_out(name: str, fold: int) -> float:
        fitted = models[name].copy().fit(train.where(F.col("fold") != fold))
        return auc.evaluate(fitted.transform(train.where(F.col("fold") == fold)))

    def tested(name: str) -> tuple:
        scored = models[name].copy().fit(train).transform(test)
        counts = {(r.label, r.prediction): r["count"] for r in scored.groupBy("label", "prediction").count().collect()}
        return (float(auc.evaluate(scored)), *multiclass_figures(counts))

    try:
        sizes = {r.fold: r["count"] for r in train.groupBy("fold").count().collect()}
        if len(sizes) < max(folds, 2):
            raise ValueError(f"only folds {sorted(sizes)} of {folds} have rows")
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            runs = {name: (pool.submit(tested, name), [pool.submit(held_out, name, i) for i in range(folds)]) for name in models}
            rows = [(name, float(np.mean([f.result() for f in cv])), *whole.result()) for name, (whole, cv) in runs.items()]
    finally:
        train.unpersist()
        test.unpersist()
    schema = "model string, cv_auc double, test_auc double, f1 double, weighted_precision double, weighted_recall double, accuracy double"
    return train.sparkSession.createDataFrame(rows, schema)

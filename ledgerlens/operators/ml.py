"""MLlib pipelines: assembling and scaling, random forests, URL character counts, random search.

Training is MLlib's distributed tree learner (one job per tree level); predictions are ``transform`` (lazy,
works on streaming frames too)."""

from __future__ import annotations

import itertools

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer, RegexTokenizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.hashing import md5_unit
from ledgerlens.operators.labels import check_labels


def assemble_scale_stages(features: list[str], raw: str = "features_raw", out: str = "features"):
    """Vector of the feature columns, standardised to zero mean and unit (sample) standard deviation."""
    return [VectorAssembler(inputCols=features, outputCol=raw, handleInvalid="keep"),
            StandardScaler(inputCol=raw, outputCol=out, withStd=True, withMean=True)]


def assemble_scale(df: DataFrame, features: list[str]) -> DataFrame:
    model = Pipeline(stages=assemble_scale_stages(features)).fit(df)
    return model.transform(df)


def forest_pipeline(features: list[str], label: str, num_trees: int = 10, max_depth: int = 5,
                    min_instances: int = 1, seed: int = 42) -> Pipeline:
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_instances, seed=seed)
    return Pipeline(stages=[*assemble_scale_stages(features), rf])


def train_forest(train: DataFrame, features: list[str], label: str, **kw) -> PipelineModel:
    """Fit the forest pipeline; no positive label is an error, few of them a warning.  The input is persisted (memory, spilling to disk) for the many passes of the
    fit and released afterwards; lost blocks are recomputed from lineage."""
    from pyspark import StorageLevel
    data = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        check_labels(data, label)
        return forest_pipeline(features, label, **kw).fit(data)
    finally:
        data.unpersist()


def batch_predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Model over a table: adds prediction and the class-1 probability as a plain column."""
    return model.transform(df).withColumn("probability_1", vector_to_array("probability")[1])


def model_metrics(predictions: DataFrame, label: str, score: str = "probability_1") -> DataFrame:
    """(metric, value): AUC from scores and from hard predictions, accuracy, weighted precision, recall and F1.

    One grouping of the predictions (label, prediction, score) is written to the shared folder; every metric comes from
    it, so the model runs once over the table."""
    from ledgerlens.operators import evaluation as E
    from ledgerlens.session import scratch_path
    spark = predictions.sparkSession
    path = scratch_path(spark, "model-metrics")
    (predictions.groupBy(F.col(label).cast("int").alias("y"), F.col("prediction").cast("double").alias("p"),
                         F.col(score).cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n")).write.parquet(path))
    cells = spark.read.parquet(path)
    auc = E.eval_auc_score(cells, "y", "s", weight="n").select(F.lit("auc").alias("metric"), F.col("auc").alias("value"))
    hard = E.binary_metrics(E.confusion_cells(cells, "y", "p", F.col("n")))
    hard = hard.select(F.lit("auc_label").alias("metric"), F.col("auc").alias("value"))
    wide = E.eval_weighted(cells, "y", "p", weight="n")
    rest = wide.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                                           for m in wide.columns))).alias("x")).select("x.*")
    return auc.unionByName(hard).unionByName(rest)


def save_model(model: PipelineModel, path: str) -> str:
    """Save under a path that all machines of the cluster reach (the shared folder); what is there is replaced."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_champion(models: DataFrame, name: str) -> PipelineModel:
    """The saved model of the champion row of a model table (with its ``path``)."""
    row = models.filter((F.col("model_name") == name) & F.col("champion")).select("path").first()
    if row is None:
        raise LookupError(f"no champion of {name}")
    return load_model(row["path"])


def char_counts(df: DataFrame, url: str = "url", key: str = "page_id") -> DataFrame:
    """Per URL and character (lower-cased): the count.  Counted inside the row with array functions (no shuffle): same
    tokens as the MLlib RegexTokenizer(pattern='.', gaps=False) used inside the classifier."""
    chars = F.regexp_extract_all(F.lower(F.col(url)), F.lit("(.)"), 1)
    counted = F.transform(F.array_distinct("_c"), lambda c: F.struct(
        c.alias("ch"), F.size(F.filter("_c", lambda x: x == c)).cast("bigint").alias("n")))
    return df.select(key, F.explode(F.array(chars)).alias("_c")).select(key, F.inline(counted))


def url_pipeline(label: str = "label_enc", num_trees: int = 35, max_depth: int = 9, seed: int = 42,
                 url: str = "url") -> Pipeline:
    tok = RegexTokenizer(inputCol=url, outputCol="chars", pattern=".", gaps=False, toLowercase=True)
    cv = CountVectorizer(inputCol="chars", outputCol="features")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees, maxDepth=max_depth,
                                seed=seed)
    return Pipeline(stages=[tok, cv, rf])


# Search space (fixed values) mapped to MLlib: trees, depth, minimum rows per leaf, features per split.
# min_samples_split has no MLlib counterpart and is not searched.
SEARCH_SPACE = {
    "numTrees": [30, 40],
    "maxDepth": [8, 10],
    "minInstancesPerNode": [1, 2],
    "featureSubsetStrategy": ["sqrt", "log2", "all"],
}


def sample_grid(space: dict, n_iter: int, seed: int = 42) -> list[dict]:
    """Up to ``n_iter`` distinct combinations, chosen by a stable hash (all of them when the grid is smaller)."""
    names = list(space)
    combos = [dict(zip(names, vals)) for vals in itertools.product(*[space[n] for n in names])]
    if n_iter >= len(combos):
        return combos
    ranked = sorted(combos, key=lambda c: md5_unit(repr(sorted(c.items())), seed))
    return ranked[:n_iter]


def random_search(train: DataFrame, pipeline: Pipeline, space: dict = SEARCH_SPACE, n_iter: int = 50,
                  folds: int = 3, label: str = "label_enc", seed: int = 42, parallelism: int = 4
                  ) -> tuple[PipelineModel, DataFrame]:
    """k-fold search scored by the F1 of class 1; returns the refit pipeline and one row per combination.

    The feature stages (all but the last) carry no searched parameter: they are fitted once, their output is
    persisted for the k x combinations forest fits, and only the forest is cross-validated."""
    from pyspark import StorageLevel
    stages = pipeline.getStages()
    rf = stages[-1]
    feat_model = Pipeline(stages=stages[:-1]).fit(train)
    feats = feat_model.transform(train).select(rf.getFeaturesCol(), rf.getLabelCol()).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        combos = sample_grid(space, n_iter, seed)
        maps = [{rf.getParam(k): v for k, v in c.items()} for c in combos]
        ev = MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                               metricName="fMeasureByLabel", metricLabel=1.0)
        cv = CrossValidator(estimator=rf, estimatorParamMaps=maps, evaluator=ev, numFolds=folds, seed=seed,
                            parallelism=parallelism)
        cv_model = cv.fit(feats)
    finally:
        feats.unpersist()
    model = PipelineModel(stages=[*feat_model.stages, cv_model.bestModel])
    rows = [(c["numTrees"], c["maxDepth"], c["minInstancesPerNode"], c["featureSubsetStrategy"], float(m))
            for c, m in zip(combos, cv_model.avgMetrics)]
    res = train.sparkSession.createDataFrame(
        rows, "num_trees int, max_depth int, min_instances int, feature_subset string, mean_f1 double")
    return model, res

"""Distributed random forest: features, training, sweep, scoring. Rows never leave the executors."""

from __future__ import annotations

import math
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.scalars import risk_band
from lakeops.session import stored

# Categories beyond the most frequent ones share a fixed number of hashed names, which bounds what the driver and trees hold.
FREQUENT, HASHED = 96, 24
# Fixed values: (trees, depth) of the sweep.
GRID = ((50, 4), (100, 6), (200, 8))
WEIGHT = "_class_weight"
# Every task of a fit sends statistics of all open nodes, whatever its rows, so tasks are as few as hold no more rows than this.
TASK_ROWS = 500_000
# Up to so many training rows are fitted where they lie.
SPREAD_ROWS = 5_000
# From so many training rows on, a sweep fits rows of equal label and features as one weighted row, if that at least halves them.
MERGE_ROWS = 500_000
# Merged rows a task of a tree's fit reads.
TASK_CELLS = 200_000
COUNT = "_rows"


def threshold_label(df: DataFrame, measure: str, threshold: float, out: str) -> DataFrame:
    return df.withColumn(out, (F.col(measure) > threshold).cast("int"))


def bounded_categories(df: DataFrame, column: str) -> SQLTransformer:
    """Adds ``<column>_cat``: the ``FREQUENT`` most frequent values by name, all others under ``HASHED`` hashed names."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("v")).count()
    top = [r["v"] for r in counts.orderBy(F.desc("count"), "v").limit(FREQUENT).collect()]
    names = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in top) or "NULL"
    value = f"CAST(`{column}` AS string)"
    hashed = f"concat('#', CAST(pmod(xxhash64({value}), {HASHED}) AS string))"
    return SQLTransformer(statement=f"SELECT *, CASE WHEN {value} IN ({names}) THEN {value} ELSE {hashed} END AS `{column}_cat` FROM __THIS__")


def feature_stages(train: DataFrame, numeric: list[str], categorical: list[str], one_hot: bool = False) -> list:
    """Indexed (optionally one-hot) bounded categories and numbers in one vector; unseen categories get their own index."""
    if not categorical:
        return [VectorAssembler(inputCols=numeric, outputCol="features", handleInvalid="skip")]
    named, indexed = [f"{c}_cat" for c in categorical], [f"{c}_idx" for c in categorical]
    stages: list = [*[bounded_categories(train, c) for c in categorical], StringIndexer(inputCols=named, outputCols=indexed, handleInvalid="keep")]
    inputs = indexed
    if one_hot:
        inputs = [f"{c}_vec" for c in categorical]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=inputs, handleInvalid="keep"))
    stages.append(VectorAssembler(inputCols=[*numeric, *inputs], outputCol="features", handleInvalid="skip"))
    return stages


def with_class_weight(df: DataFrame, label: str) -> DataFrame:
    """Weights that make both classes count the same in total. The two counts are a one-row scalar."""
    ones = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    weight = F.when(F.col(label) == 1, F.try_divide(F.lit(0.5), ones)).otherwise(F.try_divide(F.lit(0.5), 1 - ones))
    return df.withColumn(WEIGHT, F.coalesce(weight, F.lit(1.0)))


def _classifier(label: str, trees: int, depth: int, balanced: bool, seed: int) -> RandomForestClassifier:
    forest = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, maxBins=FREQUENT + HASHED + 8)
    return forest.setWeightCol(WEIGHT) if balanced else forest


def placed_rows(train: DataFrame, made: PipelineModel, kept: list[str], parts: int) -> DataFrame:
    """Label, features and weight of the training rows, stored in ``parts`` files.

    A fit draws its samples by partition and place, so rows are placed by their content: a re-run fits the same trees. All columns
    count, the key among them, so rows of equal features are spread.
    """
    order = F.xxhash64(*[F.col(f"`{f.name}`") for f in train.schema if not isinstance(f.dataType, T.MapType | T.VariantType)])
    placed = made.transform(train).select(*kept, order.alias("_order"))
    held = stored(placed.repartition(parts, "_order").sortWithinPartitions("_order"), "train")
    # Files of equal size are read in the order they are named in: by part, not as a folder happens to list them.
    names = sorted((unquote(f) for f in held.inputFiles()), key=lambda f: f.rsplit("/", 1)[1])
    return held.sparkSession.read.schema(held.schema).parquet(*names) if names else held


def fit_forest(
    train: DataFrame,
    label: str,
    numeric: list[str],
    categorical: list[str],
    trees: int = 100,
    depth: int = 6,
    balanced: bool = False,
    one_hot: bool = False,
    seed: int = 42,
) -> PipelineModel:
    if balanced:
        train = with_class_weight(train, label)
    made = Pipeline(stages=feature_stages(train, numeric, categorical, one_hot)).fit(train)
    rows, n = made.transform(train), train.count()
    if n > SPREAD_ROWS:  # all cores take part, whatever few files the rows come from
        parts = max(train.sparkSession.sparkContext.defaultParallelism, math.ceil(n / TASK_ROWS))
        rows = placed_rows(train, made, [label, "features", *[WEIGHT] * balanced], parts)
    return PipelineModel(stages=[*made.stages, _classifier(label, trees, depth, balanced, seed).fit(rows)])


def merges(rows: DataFrame, by: list[str]) -> bool:
    """Whether the rows are many and at least twice as many as their distinct values of ``by``, by an estimate."""
    n, distinct = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*by))).first()
    return n > MERGE_ROWS and 2 * distinct <= n


def merged_rows(rows: DataFrame, by: list[str]) -> DataFrame:
    """One row per distinct value of ``by`` with the number of its rows, stored. The vector of features is an array here."""
    values = rows.select(*[vector_to_array(c).alias(c) if c == "features" else F.col(c) for c in by])
    return stored(values.groupBy(*by).agg(F.count(F.lit(1)).alias(COUNT)), "merged")


def _as_vector(cells: DataFrame, features: T.StructField) -> DataFrame:
    return cells.withColumn("features", array_to_vector("features").alias("features", metadata=features.metadata))


def _drawn(names: list[str], seed: int):
    """Adds a column per tree: how often its sample holds each row, drawn for all the equal rows at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng([seed % 2**32, TaskContext.get().partitionId()])
        for batch in batches:
            counts = batch.column(batch.schema.get_field_index(COUNT)).to_numpy()
            drawn = [pa.array(draw.poisson(counts).astype(np.int32)) for _ in names]
            yield pa.record_batch([*batch.columns, *drawn], names=[*batch.schema.names, *names])

    return run


def joined_trees(spark: SparkSession, forests: list[RandomForestClassificationModel], like: RandomForestClassifier) -> RandomForestClassificationModel:
    """One forest of the trees of several, which saw the same features and classes, with the parameters of ``like``."""
    context, first = spark.sparkContext, forests[0]
    models = context._jvm.org.apache.spark.ml.classification
    trees = [tree._java_obj for forest in forests for tree in forest.trees]
    array = context._gateway.new_array(models.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        array[i] = tree
    model = RandomForestClassificationModel(models.RandomForestClassificationModel(like.uid, array, first.numFeatures, first.numClasses))
    return model.copy({model.getParam(p.name): value for p, value in like.extractParamMap().items() if model.hasParam(p.name)})


def fit_merged(cells: DataFrame, features: T.StructField, label: str, grid, balanced: bool, seed: int) -> list[Model]:
    """A forest per (trees, depth) over merged rows: the bootstrap and the trees of a fit over all rows, in time that follows the merged ones.

    A bootstrap draws each row Poisson(1) times per tree. The draws of ``k`` equal rows sum to Poisson(k), so one draw per merged row and tree gives
    samples of the same distribution. Each tree is fitted by itself over its sample as weights, with the features per node of a forest.
    """
    spark, names = cells.sparkSession, [f"_tree_{i}" for i in range(max(trees for trees, _ in grid))]
    n, classes = cells.agg(F.count(F.lit(1)), F.max(label) + 1).first()
    keys = [c for c in cells.columns if c != COUNT]
    placed = cells.repartition(math.ceil(n / TASK_CELLS), *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*cells.schema, *[T.StructField(c, T.IntegerType()) for c in names]])
    kinds = {"ml_attr": {"type": "nominal", "name": label, "vals": [str(i) for i in range(int(classes))]}}
    drawn = _as_vector(placed.mapInArrow(_drawn(names, seed), schema), features).withColumn(label, F.col(label).alias(label, metadata=kinds)).persist()

    def fit(job: tuple[int, int]) -> RandomForestClassificationModel:
        depth, i = job
        weight = F.col(names[i]) * F.col(WEIGHT) if balanced else F.col(names[i]).cast("double")
        sample = drawn.where(F.col(names[i]) > 0).select(label, "features", weight.alias(WEIGHT))
        one = _classifier(label, 1, depth, True, seed + i).setBootstrap(False).setFeatureSubsetStrategy("sqrt")
        return one.fit(sample)

    try:
        drawn.count()
        jobs = [(depth, i) for trees, depth in grid for i in range(trees)]
        with ThreadPoolExecutor(max_workers=spark.sparkContext.defaultParallelism) as pool:
            fitted = iter(list(pool.map(inheritable_thread_target(spark)(fit), jobs)))
        return [joined_trees(spark, [next(fitted) for _ in range(trees)], _classifier(label, trees, depth, balanced, seed)) for trees, depth in grid]
    finally:
        drawn.unpersist()


def metrics_of(model: Model, test: DataFrame, label: str, count: str | None = None) -> tuple[float, float]:
    """AUC and accuracy on held-out rows; ``count`` names the number of rows a row stands for."""
    scored, weight = model.transform(test), {"weightCol": count} if count else {}
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", **weight).evaluate(scored)
    accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy", **weight).evaluate(scored)
    return auc, accuracy


def sweep(
    train: DataFrame, test: DataFrame, label: str, numeric: list[str], categorical: list[str], grid=GRID,
    balanced: bool = False, one_hot: bool = False, seed: int = 42, at_once: int = 3,
) -> tuple[PipelineModel, DataFrame]:
    """Fit every (trees, depth) pair; the model with the best AUC (of equal ones the first of the grid) and the metrics as rows.

    Categories are indexed and features assembled once, and both sides of the split are stored in that form, so each fit reads the same
    narrow rows and none is on both sides. ``at_once`` fits share the cluster: their jobs fill each other's idle cores. Many rows of few
    distinct features are merged first (:func:`fit_merged`).
    """
    if balanced:
        train = with_class_weight(train, label)
    made = Pipeline(stages=feature_stages(train, numeric, categorical, one_hot)).fit(train)
    kept, spark = [label, "features"], train.sparkSession
    trained = [*kept, *[WEIGHT] * balanced]
    rows = made.transform(train)
    if merges(rows, trained):
        features = rows.schema["features"]
        models = fit_merged(merged_rows(rows, trained), features, label, grid, balanced, seed)
        test_rows = _as_vector(merged_rows(made.transform(test), kept), features)
        fitted = [(model, *metrics_of(model, test_rows, label, COUNT)) for model in models]
    else:
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        train_rows = placed_rows(train, made, trained, parts)
        test_rows = stored(made.transform(test).select(*kept), "test")

        def fit(pair: tuple[int, int]) -> tuple[Model, float, float]:
            model = _classifier(label, *pair, balanced, seed).fit(train_rows)
            return model, *metrics_of(model, test_rows, label)

        # Threads hand the session's settings on to the jobs they start.
        with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(grid)))) as pool:
            fitted = list(pool.map(inheritable_thread_target(spark)(fit), grid))
    best = max(fitted, key=lambda f: f[1])[0]
    rows = [(trees, depth, auc, accuracy) for (trees, depth), (_, auc, accuracy) in zip(grid, fitted, strict=True)]
    metrics = spark.createDataFrame(rows, "num_trees int, max_depth int, test_auc double, accuracy double")
    return PipelineModel(stages=[*made.stages, best]), metrics


def score(model: PipelineModel, df: DataFrame, out: str = "probability_1") -> DataFrame:
    """Probability of class 1 per row."""
    scored = model.transform(df).withColumn(out, vector_to_array("probability")[1])
    return scored.select(*df.columns, out)


def score_bands(model: PipelineModel, df: DataFrame, out: str = "churn_probability") -> DataFrame:
    """Probability with its Low / Medium / High band."""
    return score(model, df, out).withColumn("risk_band", risk_band(out))

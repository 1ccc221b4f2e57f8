"""Phase classifier and price regressor on Spark ML.

Feature vectors come from ``VectorAssembler`` over the selected columns
(NULL -> 0 first, as the published feature matrix does).  Training and
scoring are distributed Spark ML jobs; the fitted ``PipelineModel`` carries
the feature list and the label index, and is saved with Spark ML
persistence.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from .. import constants as K
from ..functions import phase_action, phase_label, price_direction
from .histforest import fit_forest
from .metrics import class_weights, with_class_weight
from ..functions._util import np_round
from ..operators import add_lead, filter_abs_le, first_viable, pct_change


def prepare(df: DataFrame, cols) -> DataFrame:
    """NULL -> 0 in the model inputs (booleans as 0/1)."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols})


# Rows keep the node they are in, so a level of a forest costs one step of each tree instead
# of a walk from its root; the trees are the same.  A fit has few levels: no checkpoints.
NODE_IDS = {"cacheNodeIds": True, "checkpointInterval": -1}

TASK_ROWS = 300_000  # a task of a forest's fit holds its rows with a count and a node per tree

MANY_ROWS = 100_000  # training rows that a fit of Spark ML holds: some kilobytes each with 300 trees


def spread(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """More than ``rows`` training rows are dealt evenly over the cores, at most ``rows`` to a
    task: a compressed table comes in few parts, whose rows grow in a fit to a kilobyte or two."""
    n = df.count()  # † decides the number of parts
    if n <= rows:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-n // rows)))


def fit_phase(df: DataFrame, cols, label: str = "ipc_phase", trees: int = 300, depth: int = 6,
              seed: int = K.SEED, weighted: bool = True, algo: str = "forest",
              learning_rate: float = K.BOOST_LEARNING_RATE, row_share: float = K.BOOST_ROW_SHARE,
              min_child: int = K.BOOST_MIN_CHILD, many: int = MANY_ROWS) -> PipelineModel:
    """M1 + M4 + M5: label index (alphabetical, contiguous from 0), class
    weights, weighted random-forest classifier.  A forest is used for every
    class count so the model has a probability column (M10).

    ``algo="boosted"`` takes the published learning rate, row share and smallest
    child (rows here, a sum of Hessians there).  Spark's boosted trees have no
    column share and no gain, L1 or L2 penalty.

    A forest over more than ``many`` rows is grown from binned rows (``histforest``).

    Returns a PipelineModel whose first stage is the label index; scoring
    uses the later stages only, so unlabeled rows can be scored."""
    data = prepare(df, cols).withColumn(label, F.col(label).cast("string"))
    if weighted:
        data = with_class_weight(data, label, "weight")
    indexer = StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc").fit(data)
    if algo == "boosted":
        # boosted trees per class (Spark's GBT is binary): one-vs-rest
        gbt = GBTClassifier(featuresCol="features", labelCol="label_idx", maxIter=trees, maxDepth=depth,
                            stepSize=learning_rate, subsamplingRate=row_share, minInstancesPerNode=min_child,
                            seed=seed)
        # the classes' small jobs run side by side; each class's model is the same as alone
        clf = OneVsRest(classifier=gbt, featuresCol="features", labelCol="label_idx", parallelism=len(indexer.labels))
        if weighted:
            clf = clf.setWeightCol("weight")
    else:
        clf = RandomForestClassifier(featuresCol="features", labelCol="label_idx", numTrees=trees,
                                     maxDepth=depth, seed=seed, **NODE_IDS)
        if weighted:
            clf = clf.setWeightCol("weight")
    needed = [*cols, "label_idx"] + (["weight"] if weighted else [])
    rows = indexer.transform(data).select(*needed)
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    if algo != "boosted" and rows.count() > many:
        known = {r.label: r.weight for r in class_weights(data, label).collect()} if weighted else {}  # † a row per class
        weights = [known.get(v, 1.0) for v in indexer.labels]
        return PipelineModel(stages=[indexer, assembler, fit_forest(clf, rows, cols, "label_idx", len(weights), weights)])
    fitted = Pipeline(stages=[assembler, clf]).fit(spread(rows))
    return PipelineModel(stages=[indexer, *fitted.stages])


def predict_phase(model: PipelineModel, df: DataFrame, cols, action_style: str = "short") -> DataFrame:
    """Predicted phase, label, action, confidence (max class probability)."""
    labels = model.stages[0].labels
    out = PipelineModel(stages=model.stages[1:]).transform(prepare(df, cols))
    lab_arr = F.array(*[F.lit(v) for v in labels])
    if "probability" in out.columns:
        conf = F.array_max(vector_to_array("probability"))
    else:
        # one-vs-rest boosted trees: per-class margins m_k; the logistic link
        # 1 / (1 + exp(-2 m_k)) normalised over classes stands in for the
        # class probability
        p = F.transform(vector_to_array("rawPrediction"), lambda m: F.lit(1.0) / (F.lit(1.0) + F.exp(-2.0 * m)))
        conf = F.array_max(p) / F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x)
    out = out.withColumns({
        "pred_ipc_phase": F.element_at(lab_arr, F.col("prediction").cast("int") + 1).cast("int"),
        "pred_ipc_confidence": np_round(conf, 3)})
    out = out.withColumns({"pred_ipc_label": phase_label("pred_ipc_phase"),
                           "pred_ipc_action": phase_action("pred_ipc_phase", action_style)})
    return out.drop(*[c for c in ("features", "rawPrediction", "probability", "prediction") if c in out.columns])


TARGET = "target_price_change"


def price_frame(df: DataFrame, key: str = "district", max_abs: float = 200.0) -> tuple[DataFrame, str | None]:
    """The rows a regressor can be fitted to, with their target, and the column
    that the target comes from: the next month's price change, or where that has
    too few values the percent change of a price.  No column at all: no rows."""
    source = first_viable(df, K.PRICE_TARGETS, K.PRICE_TARGET_MIN_ROWS)
    if source is None:
        return df.withColumn(TARGET, F.lit(None).cast("double")).limit(0), None
    t = (add_lead(df, source, TARGET) if source == K.PRICE_TARGETS[0]
         else pct_change(df, source, TARGET, key=key, digits=None))
    return filter_abs_le(t.where(F.col(TARGET).isNotNull()), TARGET, max_abs), source


def fit_price(df: DataFrame, cols, target: str = "target_price_change", trees: int = K.FOREST_TREES,
              depth: int = 10, min_leaf: int = 5, seed: int = K.SEED, many: int = MANY_ROWS) -> PipelineModel:
    """M6: random-forest regressor on the next-period price change.  Over more than ``many``
    rows it is grown from binned rows (``histforest``)."""
    data = prepare(df, cols).select(*cols, target)
    assembler = VectorAssembler(inputCols=list(cols), outputCol="features")
    forest = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth,
                                   minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed, **NODE_IDS)
    if data.count() > many:
        return PipelineModel(stages=[assembler, fit_forest(forest, data, cols, target)])
    return Pipeline(stages=[assembler, forest]).fit(spread(data))


def predict_price(model: PipelineModel, df: DataFrame, cols) -> DataFrame:
    """Predicted change (2 places) and direction."""
    out = model.transform(prepare(df, cols))
    out = out.withColumn("pred_price_change", np_round("prediction", 2))
    return (out.withColumn("pred_price_direction", price_direction("pred_price_change"))
            .drop("features", "prediction"))


def without_price(df: DataFrame) -> DataFrame:
    """The columns of ``predict_price`` where no price could be learnt: no change known."""
    return (df.withColumn("pred_price_change", F.lit(None).cast("double"))
            .withColumn("pred_price_direction", price_direction("pred_price_change")))


def feature_importance(model: PipelineModel, cols, spark, k: int | None = 15) -> DataFrame:
    """M15 + O4: impurity importances as a (feature, importance) table, top k."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(list(cols), [float(v) for v in imp])), "feature string, importance double")
    if k is not None:
        df = df.orderBy(F.col("importance").desc(), "feature").limit(k)
    return df


def save_model(model: PipelineModel, path: str) -> None:
    """S9."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S9."""
    return PipelineModel.load(path)

"""The trained-classifier path: fit a decision tree on the rule table, predict charges.

The reference labels charges with a tree fitted to the exhaustive rule table.
The rule CASE (:mod:`eligo.operators.rules`) is the exact truth and the
default; this module gives the same model path with ``pyspark.ml``. Training
data is the fixed 12,288-row table; prediction is a narrow, codegen-free
but fully distributed ``transform`` over the charges.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from eligo.operators.rules import CATEGORY_DOMAINS, D3, RuleSet, decision_table
from eligo.schemas import DECISION_KEYS

CATEGORICAL = tuple(CATEGORY_DOMAINS)
BOOLEAN = tuple(k for k in DECISION_KEYS if k not in CATEGORY_DOMAINS)


def _prepare(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{b}_x": F.coalesce(F.col(b), F.lit(False)).cast("double") for b in BOOLEAN})


_MODELS: dict = {}


def fitted_tree(spark: SparkSession, rule_set: RuleSet = D3, max_depth: int = 20) -> PipelineModel:
    """:func:`train_tree`, fitted once per Spark application and rule set (the training table is fixed)."""
    key = (spark.sparkContext.applicationId, rule_set.name, max_depth)
    if key not in _MODELS:
        _MODELS[key] = train_tree(spark, rule_set, max_depth)
    return _MODELS[key]


def train_tree(spark: SparkSession, rule_set: RuleSet = D3, max_depth: int = 20) -> PipelineModel:
    """One-hot encode the categories, fit a fully grown tree on every combination."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in CATEGORICAL]
    stages.append(OneHotEncoder(inputCols=[f"{c}_i" for c in CATEGORICAL],
                                outputCols=[f"{c}_v" for c in CATEGORICAL], dropLast=False))
    stages.append(VectorAssembler(inputCols=[f"{c}_v" for c in CATEGORICAL] + [f"{b}_x" for b in BOOLEAN],
                                  outputCol="features"))
    label = StringIndexer(inputCol="expungability", outputCol="label")
    stages.append(label)
    stages.append(DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=max_depth,
                                         minInstancesPerNode=1, minInfoGain=0.0, seed=12345))
    model = Pipeline(stages=stages).fit(_prepare(decision_table(spark, rule_set)))
    label_model = model.stages[len(CATEGORICAL) + 2]
    feature_stages = [s for s in model.stages if s is not label_model]
    return PipelineModel(stages=feature_stages + [IndexToString(inputCol="prediction", outputCol="predicted_label",
                                                                labels=label_model.labels)])


def predict(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Add ``predicted_label`` to rows carrying the 12 decision-key columns."""
    keep = features.columns
    out = model.transform(_prepare(features))
    return out.select(*[c for c in keep if c != "expungability"], "predicted_label")

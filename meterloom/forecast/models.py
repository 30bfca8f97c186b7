"""One-step models: registry, fit, score, compare, ablate."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import replace

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, ImputerModel, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterloom.config import TARGET, DatasetConfig, Selection
from meterloom.metrics import best_model, train_test_metrics
from meterloom.plans.dataset import Dataset, feature_list, model_rows, with_features
from meterloom.session import stage
from meterloom.sources.writers import save_model

VECTOR = "features_vector"
KNOWN = "__known"
MISSING = "-1e18D"


def boosted_trees(rounds: int = 500, depth: int = 6, seed: int = 42) -> Estimator:
    """Gradient-boosted trees: 64 leaves at most, step 0.05, 80 % of rows and columns."""
    return GBTRegressor(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=0.05,
        subsamplingRate=0.8,
        featureSubsetStrategy="0.8",
        seed=seed,
    )


def random_forest(trees: int = 300, depth: int = 15, seed: int = 42) -> Estimator:
    return RandomForestRegressor(numTrees=trees, maxDepth=depth, seed=seed)


def linear() -> Estimator:
    return LinearRegression()


REGISTRY: dict[str, Callable[..., Estimator]] = {
    "gbt": boosted_trees,
    "rf": random_forest,
    "linear": linear,
}


def known_features(rows: DataFrame, features: Sequence[str]) -> list[str]:
    """Features with at least one known value."""
    counts = rows.select(*[F.count(c).alias(c) for c in features]).first()
    return [c for c in features if counts[c]]


def pipeline(estimator: Estimator, features: Sequence[str], target: str) -> Pipeline:
    """Numeric columns to a vector, then the estimator.

    A linear model sees a missing value as the column mean, trees as a value
    far below all others that a split can set apart.
    """
    estimator = estimator.copy()
    estimator.setFeaturesCol(VECTOR)
    estimator.setLabelCol(target)
    filled = [f"{c}{KNOWN}" for c in features]
    if isinstance(estimator, LinearRegression):
        filling = Imputer(inputCols=list(features), outputCols=filled, strategy="mean")
    else:
        columns = ", ".join(
            f"coalesce(cast(`{c}` as double), {MISSING}) as `{k}`" for c, k in zip(features, filled)
        )
        filling = SQLTransformer(statement=f"select *, {columns} from __THIS__")
    vector = VectorAssembler(inputCols=filled, outputCol=VECTOR)
    return Pipeline(stages=[filling, vector, estimator])


def fit_one_step(
    train: DataFrame,
    features: Sequence[str],
    model: str | Estimator = "gbt",
    *,
    target: str = TARGET,
    **settings,
) -> PipelineModel:
    """Fit one model over all series of ``train``."""
    estimator = REGISTRY[model](**settings) if isinstance(model, str) else model
    if isinstance(estimator, LinearRegression):
        features = known_features(train, features)
    return pipeline(estimator, features, target).fit(train)


def score(model: PipelineModel, rows: DataFrame, features: Sequence[str] = ()) -> DataFrame:
    """All rows with ``yhat``; feature columns the table lacks count as missing."""
    scored = model.transform(with_features(rows, list(features)))
    helpers = [c for c in scored.columns if c.endswith(KNOWN)]
    return scored.withColumnRenamed("prediction", "yhat").drop(VECTOR, *helpers)


def scoring_parts(model: PipelineModel) -> tuple[list[str], dict[str, float], Model]:
    """Feature names in order, what a missing one counts as, and the predictor of a pipeline."""
    filling, assembler, predictor = model.stages
    names = [c.removesuffix(KNOWN) for c in assembler.getInputCols()]
    if isinstance(filling, ImputerModel):
        means = filling.surrogateDF.first().asDict()
        return names, {c: float(means[c]) for c in names}, predictor
    return names, dict.fromkeys(names, float(MISSING.removesuffix("D"))), predictor


def evaluate(model: PipelineModel, data: Dataset, name: str) -> DataFrame:
    """One row: model name and its errors on training and test rows."""
    target = data.cfg.target
    scored = score(model, data.rows).withColumnRenamed(target, "y")
    return train_test_metrics(scored).select(F.lit(name).alias("model"), "*")


def compare_models(
    data: Dataset, models: Mapping[str, Estimator], folder: str | None = None
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit each registered model; fitted pipelines and the comparison table.

    With ``folder``, each pipeline is saved there under its name.
    """
    fitted = {
        name: fit_one_step(data.train, data.features, estimator, target=data.cfg.target)
        for name, estimator in models.items()
    }
    table = None
    for name, model in fitted.items():
        if folder:
            save_model(model, f"{folder}/{name}")
        row = evaluate(model, data, name)
        table = row if table is None else table.unionByName(row)
    return fitted, table


def choose_best(comparison: DataFrame) -> str:
    """Name of the model with the smallest test RMSE."""
    return best_model(comparison).first()["model"]


def ablation(
    features: DataFrame,
    configs: Mapping[str, DatasetConfig],
    model: str = "linear",
    **settings,
) -> DataFrame:
    """Errors per feature selection: one fit per configuration on the same table.

    Configurations that differ in the selection only share their numbered rows.
    """
    table, numbered = None, {}
    everything = Selection(without=frozenset())
    for name, cfg in configs.items():
        wide = replace(cfg, selection=everything)
        if wide not in numbered:
            numbered[wide] = stage(model_rows(features, wide).rows, "numbered")
        rows = numbered[wide]
        data = Dataset(rows, feature_list(rows.columns, cfg.selection), cfg)
        fitted = fit_one_step(data.train, data.features, model, target=cfg.target, **settings)
        row = evaluate(fitted, data, model).withColumn("selection", F.lit(name))
        table = row if table is None else table.unionByName(row)
    return table

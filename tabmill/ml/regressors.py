"""The model configurations that are compared."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.regression import LinearRegression

from tabmill.ml.mlp import MLPRegressor
from tabmill.ml.prep import MAX_NOMINAL_LEVELS, FeaturePrep
from tabmill.ml.target import FITTED_LABEL, TransformedTarget
from tabmill.ml.trees import BINS, DeepForest, LeafwiseBoosting

# --- fixed values of the tree learners ---
FOREST_TREES = 300
BOOSTING = {"maxDepth": 6, "stepSize": 0.1, "trees": 300, "minLeaf": 20}
UNLIMITED_DEPTH = 64
SEED = 42


@dataclass(frozen=True)
class ModelConfig:
    """A named recipe; the factory returns a new unfitted estimator."""

    name: str
    factory: Callable[[], Estimator]


def _model(regressor: Estimator, label: str, target: str, exclude: Sequence[str], **prep) -> TransformedTarget:
    stages = [FeaturePrep(exclude=[*exclude, label, FITTED_LABEL], **prep), regressor]
    return TransformedTarget(Pipeline(stages=stages), labelCol=label, target=target)


def linear_regression(label: str, target: str = "raw", exclude: Sequence[str] = ()) -> Estimator:
    """Ordinary least squares. All one-hot levels plus intercept are collinear: predictions are
    unique, coefficients are not."""
    return _model(LinearRegression(labelCol=FITTED_LABEL, regParam=0.0), label, target, exclude)


def random_forest(
    label: str, target: str = "raw", exclude: Sequence[str] = (), trees: int = FOREST_TREES, max_depth: int = UNLIMITED_DEPTH,
    min_leaf: int = 1, max_bins: int = BINS,
) -> Estimator:
    """All features at every split; trees as deep as the rows allow, in stored batches."""
    forest = DeepForest(labelCol=FITTED_LABEL, trees=trees, maxDepth=max_depth, minLeaf=min_leaf, maxBins=max_bins, seed=SEED)
    return _model(forest, label, target, exclude)


def small_forest(label: str, target: str = "raw", exclude: Sequence[str] = (), trees: int = FOREST_TREES) -> Estimator:
    """The capped forest of the exploration."""
    return random_forest(label, target, exclude, trees, max_depth=10, min_leaf=5)


def boosted_trees(label: str, target: str = "raw", exclude: Sequence[str] = (), **overrides) -> Estimator:
    """Histogram boosting, leaf by leaf, with nominal categories."""
    boosting = LeafwiseBoosting(labelCol=FITTED_LABEL, **{**BOOSTING, **overrides})
    return _model(boosting, label, target, exclude, kind="hgb_native", maxNominalLevels=MAX_NOMINAL_LEVELS)


def neural_net(label: str, target: str = "raw", exclude: Sequence[str] = (), id_column: str = "Id", **overrides) -> Estimator:
    net = MLPRegressor(labelCol=FITTED_LABEL, idCol=id_column, **overrides)
    return _model(net, label, target, exclude, scaleNumeric=True)


def default_configs(
    label: str, exclude: Sequence[str] = (), id_column: str = "Id", forest: dict | None = None,
    boosting: dict | None = None, net: dict | None = None,
) -> list[ModelConfig]:
    """The eight configurations: four learners, each on the raw and on the log target."""
    exclude = [id_column, *exclude]
    configs = []
    for name, build in (
        ("LinearRegression", lambda t: linear_regression(label, t, exclude)),
        ("RandomForest", lambda t: random_forest(label, t, exclude, **(forest or {}))),
        ("HistGBR", lambda t: boosted_trees(label, t, exclude, **(boosting or {}))),
        ("MLP", lambda t: neural_net(label, t, exclude, id_column, **(net or {}))),
    ):
        configs.append(ModelConfig(name, lambda b=build: b("raw")))
        configs.append(ModelConfig(f"{name}_log", lambda b=build: b("log")))
    return configs

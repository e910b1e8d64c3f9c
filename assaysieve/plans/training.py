"""From an experiment table to the best model per target."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.functions import vocabulary as V
from assaysieve.functions.exprs import col
from assaysieve.operators import histogram_trees, kernels, linear, support_vectors
from assaysieve.operators import prepare as P
from assaysieve.operators import roles as R
from assaysieve.operators import validate
from assaysieve.operators.profile import recommend
from assaysieve.operators.score import measured_values, target_bounds
from assaysieve.session import checkpointable, delete_paths

ROW = "row_id"


@dataclass
class Best:
    """The chosen model of one target with what is needed to score with it."""

    target: str
    model: str
    fitted_as: str
    family: str
    train_r2: float | None
    cv_r2: float | None
    cv_rmse: float | None
    parameters: Any = None


@dataclass
class Training:
    """A prepared experiment: features and targets in one frame, tied by their row."""

    frame: DataFrame
    preparation: P.Preparation
    targets: list[str]
    name: str
    raw: DataFrame

    @property
    def features(self) -> list[str]:
        return list(self.preparation.selected)


@dataclass
class Trained:
    training: Training
    strategy: str
    scores: DataFrame
    oof: DataFrame
    best: dict[str, Best]
    measured: DataFrame
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    kept: list[DataFrame] = field(default_factory=list)
    written: list[str] = field(default_factory=list)

    def release(self) -> None:
        """Give back the frames kept in memory, which are recomputed if they are used again, and delete the tables written by screenings:
        their rankings cannot be read after that."""
        for df in self.kept:
            df.unpersist()
        delete_paths(self.scores.sparkSession, self.written)
        self.written.clear()


def with_rows(df: DataFrame, row_id: str = ROW) -> DataFrame:
    """Row number where a table brings no key of its own, written down so that recomputed tasks keep it."""
    if row_id in df.columns:
        return df
    checkpointable(df.sparkSession)
    return df.withColumn(row_id, F.monotonically_increasing_id()).checkpoint()


def prepare_training(
    experiment: DataFrame,
    name: str = "solvent_name",
    targets: Sequence[str] | None = None,
    row_id: str = ROW,
    known: Sequence[str] = V.KNOWN_DESCRIPTORS,
    ids: Sequence[str] = V.ID_COLUMNS,
    groups: Sequence[Sequence[str]] = V.MANDATED_GROUPS,
    squares: Sequence[tuple[str, str]] | None = None,
    products: Sequence[tuple[str, str, str]] | None = None,
) -> Training:
    """Infer targets, drop controls and duplicates, impute, scale, engineer and select features.

    Duplicates are dropped before features and targets part, so that both keep the same rows; the last copy's row
    number stays, so that the last measurement of a name is still the last. Two small statistics
    frames reach the driver; everything applied is a projection.
    """
    df = with_rows(R.nan_as_null(experiment), row_id)
    targets = list(targets) if targets else R.infer_targets(df.drop(row_id), known)
    rows = R.without_controls(df, name)
    content = [c for c in rows.columns if c != row_id]
    rows = rows.groupBy(*[col(c) for c in content]).agg(F.max(col(row_id)).alias(row_id)).persist()
    features = [c for c in R.feature_columns(rows, targets) if c != row_id]
    described = rows.select(*[col(c) for c in features])
    numeric, categorical = R.numeric_columns(described), R.categorical_columns(described)

    imputer = P.fit_imputer(described, numeric, categorical)
    clean = P.impute(rows, imputer)
    scaler = P.fit_scaler(clean, numeric, categorical)
    made = P.default_engineering(features)
    squares, products = made[0] if squares is None else squares, made[1] if products is None else products
    engineered = P.engineer(P.scale(clean, scaler), squares, products)

    candidates = R.drop_ids(engineered.drop(row_id, *targets), ids)
    fresh = [c for c in candidates.columns if c not in features]
    flat = set(scaler.constant) | set(P.constant_columns(engineered, fresh))
    left = candidates.select(*[col(c) for c in candidates.columns if c not in flat])
    selected, missing = R.mandated_selection(left.columns, R.numeric_columns(left), groups)
    preparation = P.Preparation(
        imputer, scaler, tuple(numeric), tuple(categorical), tuple(squares), tuple(products), tuple(selected), tuple(missing)
    )
    kept = list(dict.fromkeys([row_id, name, *selected, *targets]))
    return Training(engineered.select(*[col(c) for c in kept]), preparation, targets, name, rows)


def _attempt(failures: list, targets: Sequence[str], models: str | Sequence[str], job):
    """Run one job; a failure is recorded for its models and the remaining ones go on."""
    try:
        return job()
    except Exception as problem:
        names = [models] if isinstance(models, str) else models
        failures += [(t, m, f"error: {type(problem).__name__}: {problem}") for t in targets for m in names]
        return None


def _tree_models(rows: DataFrame, features: Sequence[str], targets: Sequence[str], kinds: Sequence[str], row_id: str, options: dict, failures: list):
    """All tree models of all targets in one set of jobs; a kind with unusable options fails alone."""
    usable = [k for k in kinds if _attempt(failures, targets, k, lambda k=k: histogram_trees.style_of(k, **options.get(k, {})))]
    job = lambda: histogram_trees.fit_trees(rows, features, targets, usable, row_id, "fold", options=options)
    return _attempt(failures, targets, usable, job) if usable else None


def _linear_left_out(rows: DataFrame, features: Sequence[str], targets: Sequence[str], names: Sequence[str], row_id: str) -> tuple[DataFrame, DataFrame]:
    """Full fits and leave-one-out predictions: by leverages where the model allows, else by refits from the sums."""
    degree = max(linear.LINEAR_MODELS[m].degree for m in names)
    sums = linear.gram(rows, features, targets, degree=degree).persist()
    fits = linear.solve(sums, features, names).persist()
    parts = []
    for d in (1, 2):
        by_leverage = [m for m in names if linear.LINEAR_MODELS[m].degree == d and linear.LINEAR_MODELS[m].penalty != "l1"]
        if by_leverage:
            parts.append(linear.leave_one_out(rows, fits.where(F.col("model").isin(by_leverage)), features, targets, keep=[row_id, "fold"], degree=d))
    refitted = [m for m in names if linear.LINEAR_MODELS[m].penalty == "l1"]
    if refitted:
        parts.append(linear.leave_one_out_refits(rows, sums, features, targets, refitted, keep=[row_id, "fold"]))
    return fits, reduce(DataFrame.unionByName, parts)


def _reasons(failures: list[tuple[str, str, str]]) -> str:
    return "; ".join(sorted({f"{m} for {t}: {why}" for t, m, why in failures})) or "no model has all its predictions"


def train(
    training: Training,
    models: Sequence[str] | None = None,
    strategy: str | None = None,
    row_id: str = ROW,
    tree_options: dict | None = None,
    fold: Column | None = None,
    boosting: str | None = None,
    landmarks: int = kernels.LANDMARKS,
) -> Trained:
    """Fit and cross-validate every model for every target, then choose the best per target.

    `boosting="random_forest"` fits forests where boosting packages are asked for. Kernel models stand on at most `landmarks` distinct vectors: they are exact
    up to so many. Raises if no model of any target could be fitted.

    Folds are drawn by the validation strategy, unless the caller gives them as an expression over the row key.
    """
    frame, features, targets = training.frame.persist(), training.features, training.targets
    advised, plan = recommend(frame.count())
    models, strategy = list(models or advised), strategy or plan
    folds = validate.fold_count(strategy)
    choices = [validate.resolve_model(m, boosting) for m in models]
    families = {f: list(dict.fromkeys(c.fitted_as for c in choices if c.family == f)) for f in ("linear", "kernel", "trees", "vectors")}
    drawn = validate.assign_folds(frame, row_id, folds) if fold is None else frame.withColumn("fold", fold.cast("int"))
    rows = drawn.persist()
    number = folds if folds is not None else rows.count()

    oofs, failures, held, kept = [], [], {}, []
    shape = [row_id, "target", "model", "fold", "y", "yhat_train", "yhat_cv"]
    if families["linear"]:
        names = families["linear"]
        if folds is None and fold is None:
            fits, predicted = _linear_left_out(rows, features, targets, names, row_id)
        else:
            fits = linear.fit_folds(rows, features, targets, names, "fold").persist()
            predicted = linear.out_of_fold(rows, fits, features, targets, names, "fold", keep=[row_id])
        kept.append(fits)
        for r in fits.where(F.col("fold") == linear.FULL).collect():
            held[r["target"], r["model"]] = (r["intercept"], list(r["weights"] or []))
            if r["status"] != "ok":
                failures.append((r["target"], r["model"], r["status"]))
        oofs.append(predicted.select(*shape))
    if families["kernel"]:
        names = families["kernel"]
        for r in kernels.fit_kernels(frame, features, targets, names, landmarks=landmarks).collect():
            held[r["target"], r["model"]] = kernels.unpack(r) if r["status"] == "ok" else None
            if r["status"] != "ok":
                failures.append((r["target"], r["model"], r["status"]))
        left_out = kernels.kernel_out_of_fold(rows, features, targets, names, "fold", row_id, landmarks=landmarks, single=folds is None and fold is None)
        oofs.append(left_out.select(*shape))
    tables = [_tree_models(rows, features, targets, families["trees"], row_id, tree_options or {}, failures)]
    if families["vectors"]:
        tables.append(_attempt(failures, targets, families["vectors"], lambda: support_vectors.fit_support_vectors(rows, features, targets, row_id, "fold")))
    for fitted in (t for t in tables if t):
        held |= {(t, k): fitted.models.where((F.col("target") == t) & (F.col("model") == k)).drop("target", "model") for t in targets for k in families["trees"] + families["vectors"]
                 if (k in families["trees"]) == (fitted is tables[0])}
        oofs.append(fitted.predictions.select(*shape))

    if not oofs:
        raise ValueError(f"no model could be fitted and validated: {_reasons(failures)}")
    spark = frame.sparkSession
    oof = reduce(DataFrame.unionByName, oofs).persist()
    asked = spark.createDataFrame([(c.asked, c.fitted_as, c.family) for c in choices], "asked string, model string, family string")
    scored = validate.metrics(oof)
    if failures:
        failed = spark.createDataFrame(failures, "target string, model string, status string")
        scored = scored.join(failed, ["target", "model"], "left_anti").unionByName(failed, allowMissingColumns=True)
    scores = (
        scored.join(F.broadcast(asked), ["model"])
        .withColumnRenamed("model", "fitted_as").withColumnRenamed("asked", "model").persist()
    )
    best = {}
    chosen = {r["target"]: r for r in validate.best_models(scores.where("status = 'ok'"), models).collect()}
    for r in (chosen[t] for t in targets if t in chosen):
        best[r["target"]] = Best(
            r["target"], r["model"], r["fitted_as"], r["family"], r["train_r2"], r["cv_r2"], r["cv_rmse"],
            held.get((r["target"], r["fitted_as"])),
        )
    if not best:
        raise ValueError(f"no model could be fitted and validated: {_reasons(failures)}")
    measured = measured_values(training.raw, targets, row_id, training.name)
    return Trained(training, strategy, scores, oof, best, measured, target_bounds(frame, targets), [training.raw, frame, rows, oof, scores, *kept])

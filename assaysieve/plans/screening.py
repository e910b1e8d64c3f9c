"""From a library of entities to the ranked screening table."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, percent_text
from assaysieve.operators import explain as E
from assaysieve.operators import histogram_trees, kernels, linear, support_vectors, tree_paths, views
from assaysieve.operators import prepare as P
from assaysieve.operators import score as S
from assaysieve.operators.catalogue import align_for_inference
from assaysieve.operators.roles import apply_selection
from assaysieve.plans.training import Best, Trained


def prepare_library(
    library: DataFrame, preparation: P.Preparation, name: str = "solvent_name", fill: str = "zero", keep: Sequence[str] = ()
) -> DataFrame:
    """Name, the carried LogP and the selected features, ready for scoring: one projection of the library."""
    aligned = align_for_inference(library, preparation.numeric, [c for c in preparation.categorical if c != name], P.fill_values(preparation, fill))
    carried = aligned.withColumn("_LogP", S.carried_feature(aligned).cast("double"))
    features = P.engineer(P.scale(carried, preparation.scaler), preparation.squares, preparation.products)
    return apply_selection(features, preparation.selected, [name, *keep, "_LogP"])


def predict(
    library: DataFrame, best: dict[str, Best], features: Sequence[str], keep: Sequence[str], bounds: tuple[float, float] | None = None
) -> DataFrame:
    """Prediction and interval columns of every target's best model."""
    df, value, width = library, {}, {}
    kernel_fits = {t: b.parameters for t, b in best.items() if b.family == "kernel"}
    if kernel_fits:
        df = kernels.append_kernels(df, kernel_fits, features)
    for i, (t, b) in enumerate(best.items()):
        width[t] = S.constant_half_width(b.cv_rmse)
        if b.family == "linear":
            intercept, weights = b.parameters
            degree = linear.LINEAR_MODELS[b.fitted_as].degree
            value[t] = linear.linear_value(features, F.lit(float(intercept)), weights, degree)
        elif b.family == "kernel":
            value[t] = col(f"{t}_mean")
            if b.fitted_as == "gaussian_process":
                width[t] = F.lit(S.Z95) * col(f"{t}_deviation")
        else:
            score = histogram_trees.score_trees if b.family == "trees" else support_vectors.score_vectors
            df = score(df, b.parameters, features, f"_own{i}")
            value[t] = F.col(f"_own{i}")
    out = [c for t in best for c in S.interval(value[t], width[t], t, bounds)]
    return df.select(*[col(c) for c in keep], *out)


def screen(
    trained: Trained,
    library: DataFrame,
    name: str = "solvent_name",
    bounds: tuple[float, float] | None = None,
    fill: str = "zero",
    classes: Sequence[str] = (),
    keep: Sequence[str] = (),
    ranked: bool = True,
) -> DataFrame:
    """Score a library, put measured values in place of predictions, add the desirability score and the rank.

    Measurements are attached before scoring, so that measuring and sketching the join never runs a model.
    """
    preparation, targets = trained.training.preparation, list(trained.best)
    prepared = prepare_library(library, preparation, name, fill, keep)
    known = S.attach_measured(prepared, trained.measured, targets, name)
    predicted = predict(known, trained.best, trained.training.features, [name, *keep, "_LogP", *S.measured_columns(targets)], bounds)
    measured = S.use_measured(predicted.withColumnRenamed("_LogP", "LogP"), targets)
    scored = S.desirability(measured, trained.bounds)
    if classes:
        scored = S.classify(scored, classes)
    return S.rank_all(scored, name, written=trained.written) if ranked else scored


def result_table(ranked: DataFrame, identifier: str = "SMILES", name: str = "solvent_name", to: str = "Overall_Compatibility") -> DataFrame:
    """The ranking as it is shown: picture links as second column where any row has an identifier, and the score as percent text."""
    shown = ranked.withColumn(to, percent_text("score"))
    first = [name, *[c for c in shown.columns if c not in (name, identifier)]]
    linked = views.with_links(shown.select(*[col(c) for c in first], *([col(identifier)] if identifier in shown.columns else [])), identifier)
    return linked.drop(identifier)


def explain(trained: Trained, target: str, rows: DataFrame | None = None, keep: Sequence[str] = (), centres: int = 10) -> DataFrame:
    """Shapley values of the model that was chosen for a target, with `base`, for prepared rows (by default the training rows).

    Linear models in closed form, trees along their paths, all others over coalitions against a summary of the training rows.
    """
    best, features, frame = trained.best[target], trained.training.features, trained.training.frame
    rows = frame if rows is None else rows
    if best.family == "trees":
        return tree_paths.explain_trees(rows, features, best.parameters, keep)
    if best.family == "linear" and linear.LINEAR_MODELS[best.fitted_as].degree == 1:
        means = frame.where(col(target).isNotNull()).agg(*[F.avg(col(c)).alias(f"m{i}") for i, c in enumerate(features)]).first()
        intercept, weights = best.parameters
        return E.linear_shap(rows, features, weights, list(means), keep, intercept)
    points, share = E.background(frame, features, centres)
    if best.family == "vectors":
        return E.kernel_shap(rows, features, support_vectors.predictor(best.parameters), points, share, keep)
    if best.family == "kernel":
        return E.kernel_shap(rows, features, lambda x: kernels.kernel_predict(best.parameters, x)[0], points, share, keep)
    intercept, weights = best.parameters
    pairs = [(i, j) for i in range(len(features)) for j in range(i, len(features))]

    def value(x: np.ndarray) -> np.ndarray:
        return intercept + np.column_stack([x, *[x[:, i] * x[:, j] for i, j in pairs]]) @ np.asarray(weights)

    return E.kernel_shap(rows, features, value, points, share, keep)

"""Many experiments at once: training, choice and scoring by experiment as one set of jobs, without a loop over them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col
from assaysieve.operators import histogram_trees, kernels, linear, support_vectors, validate
from assaysieve.operators.score import Z95
from assaysieve.operators.skew import lookup_join


@dataclass
class Experiments:
    """Scores and choices per experiment and target, and the fitted models of all of them as tables."""

    by: list[str]
    features: list[str]
    scores: DataFrame
    best: DataFrame
    linear_fits: DataFrame | None
    kernel_fits: DataFrame | None
    tree_models: DataFrame | None = None
    vector_models: DataFrame | None = None


def train_experiments(
    frame: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str], models: Sequence[str], row_id: str,
    folds: int = 5, fold: Column | None = None, tree_options: dict | None = None, landmarks: int = kernels.LANDMARKS,
) -> Experiments:
    """Fit and cross-validate models of every experiment and target, and choose the best of each.

    `by` names the columns that tell experiments apart. Folds are drawn within each experiment unless they are given. Kernel models stand on at most
    `landmarks` distinct vectors of their experiment: they are exact up to so many.
    """
    by, features, targets = list(by), list(features), list(targets)
    choices = [validate.resolve_model(m) for m in models]
    names = {f: list(dict.fromkeys(c.fitted_as for c in choices if c.family == f)) for f in ("linear", "kernel", "trees", "vectors")}
    drawn = validate.assign_folds(frame, row_id, folds, by=by) if fold is None else frame.withColumn("fold", fold.cast("int"))
    rows = drawn.persist()
    shape = [*by, row_id, "target", "model", "fold", "y", "yhat_train", "yhat_cv"]
    oofs, linear_fits, kernel_fits, tree_models, vector_models = [], None, None, None, None
    if names["linear"]:
        fits = linear.fit_folds(rows, features, targets, names["linear"], "fold", by).persist()
        oofs.append(linear.out_of_fold(rows, fits, features, targets, names["linear"], "fold", by, [row_id]).select(*[col(c) for c in shape]))
        linear_fits = fits.where((F.col("fold") == linear.FULL) & (F.col("status") == "ok"))
    if names["kernel"]:
        kernel_fits = kernels.fit_kernels(rows, features, targets, names["kernel"], by, landmarks)
        oofs.append(kernels.kernel_out_of_fold(rows, features, targets, names["kernel"], "fold", row_id, by, landmarks).select(*[col(c) for c in shape]))
    if names["trees"]:
        fitted = histogram_trees.fit_trees(rows, features, targets, names["trees"], row_id, "fold", by, tree_options)
        tree_models = fitted.models
        oofs.append(fitted.predictions.select(*[col(c) for c in shape]))
    if names["vectors"]:
        fitted = support_vectors.fit_support_vectors(rows, features, targets, row_id, "fold", by)
        vector_models = fitted.models
        oofs.append(fitted.predictions.select(*[col(c) for c in shape]))
    oof = reduce(DataFrame.unionByName, oofs)
    order = [c.fitted_as for c in choices]
    scores = validate.metrics(oof, by).persist()
    best = validate.best_models(scores.where("status = 'ok'"), order, by)
    return Experiments(by, features, scores, best, linear_fits, kernel_fits, tree_models, vector_models)


def screen_experiments(trained: Experiments, library: DataFrame, keep: Sequence[str], unmatched: bool = True) -> DataFrame:
    """Library rows with the prediction of their experiment's best model per target and the half-width of its interval, long form.

    The library has the columns that tell experiments apart. Models meet rows in measured or salted joins. Rows of an experiment without any
    usable model, or of a null one, have one row each, with null target, model, prediction and half_width; without `unmatched` they are left out.
    """
    by, features, keep = trained.by, trained.features, list(keep)
    chosen = trained.best.select(*[col(k) for k in by], "target", "model", "cv_rmse").persist()
    out, usable = [], []
    if trained.linear_fits is not None:
        packed = trained.linear_fits.join(chosen, [*by, "target", "model"]).groupBy(*[col(k) for k in by]).agg(
            F.collect_list(F.struct("target", "model", "intercept", "weights", "cv_rmse")).alias("_fits"))
        usable.append(packed.select(*[col(k) for k in by]))
        met = lookup_join(library, packed, by, "inner").withColumn("_m", F.explode("_fits"))
        models = [m for m, s in linear.LINEAR_MODELS.items()]
        value = linear.spec_value(features, models, F.col("_m.model"), F.col("_m.intercept"), F.col("_m.weights"))
        out.append(met.select(*[col(k) for k in dict.fromkeys([*by, *keep])], "_m.target", "_m.model", value.alias("prediction"),
                              (F.lit(Z95) * F.col("_m.cv_rmse")).alias("half_width")))
    if trained.kernel_fits is not None:
        fits = trained.kernel_fits.join(chosen.drop("cv_rmse"), [*by, "target", "model"])
        usable.append(fits.select(*[col(k) for k in by]))
        scored = kernels.score_kernels(library, fits, features, keep, by).where("model is not null")
        errors = lookup_join(scored, chosen.drop("model"), [*by, "target"], "left")
        width = F.when(F.col("model") == "gaussian_process", F.lit(Z95) * F.col("deviation")).otherwise(F.lit(Z95) * F.col("cv_rmse"))
        out.append(errors.select(*[col(k) for k in dict.fromkeys([*by, *keep])], "target", "model", "prediction", width.alias("half_width")))
    for models, score in ((trained.tree_models, histogram_trees.score_experiments), (trained.vector_models, support_vectors.score_experiments)):
        if models is None:
            continue
        held = models.join(chosen.drop("cv_rmse"), [*by, "target", "model"])
        usable.append(held.select(*[col(k) for k in by]))
        scored = score(library, held, features, keep, by)
        errors = lookup_join(scored, chosen.drop("model"), [*by, "target"], "left")
        out.append(errors.select(*[col(k) for k in dict.fromkeys([*by, *keep])], "target", "model", "prediction", (F.lit(Z95) * F.col("cv_rmse")).alias("half_width")))
    if unmatched:
        known = reduce(DataFrame.unionByName, usable).distinct().withColumn("_known", F.lit(True))
        without = lookup_join(library, known, by, "left").where(F.col("_known").isNull())
        kinds = dict(out[0].dtypes)
        nothing = [F.lit(None).cast(kinds[c]).alias(c) for c in ("target", "model", "prediction", "half_width")]
        out.append(without.select(*[col(k) for k in dict.fromkeys([*by, *keep])], *nothing))
    return reduce(DataFrame.unionByName, out)

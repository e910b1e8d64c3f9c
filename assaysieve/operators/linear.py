"""Linear models fitted from sums.

One aggregation yields, per experiment, target and fold, the sums that determine ordinary, ridge, lasso and
degree-2 polynomial regression. The sums for "all folds but this one" are the total minus the fold, so that
k-fold validation needs no further pass over the data, and the solver sees one small row per fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import combinations_with_replacement
from operator import add
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaysieve.functions.exprs import col, safe_ratio
from assaysieve.operators.skew import lookup_join

FULL = -1  # fold number of the fit on all rows
SWEEPS = 20_000  # coordinate sweeps of a lasso fit; a fit that still moves then is reported as failed
FLAT = 1e-12  # centred squares below this share of the raw squares are rounding noise of a constant feature


class LinearSpec(NamedTuple):
    penalty: str = "none"  # none, l2 or l1
    strength: float = 0.0
    degree: int = 1


# Penalties of the linear models that can be asked for by name.
LINEAR_MODELS = {
    "Linear Regression": LinearSpec(),
    "Polynomial Regression": LinearSpec(degree=2),
    "Ridge": LinearSpec("l2", 1.0),
    "Lasso": LinearSpec("l1", 0.1),
}


class Term(NamedTuple):
    name: str
    value: Column


def terms(features: Sequence[str], degree: int = 1) -> list[Term]:
    """Model terms as expressions: the features, then for degree 2 all their squares and products."""
    out = [Term(c, col(c).cast("double")) for c in features]
    if degree == 2:
        for a, b in combinations_with_replacement(features, 2):
            out.append(Term(f"{a}*{b}", col(a).cast("double") * col(b).cast("double")))
    return out


def long_targets(df: DataFrame, targets: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per measured target, as (target, y). An Expand without shuffle."""
    wide = df.select(*[col(c) for c in keep], *[col(t).cast("double").alias(t) for t in targets if t not in keep])
    return wide.unpivot([col(c) for c in keep], [col(t) for t in targets], "target", "y").where("y is not null")


def gram(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = (), fold: str | None = None, degree: int = 1
) -> DataFrame:
    """Sums per (by, target, fold): n, term sums, term products, target sums. Partial sums are combined map-side.

    Without folds the sums are those of the full fit and go straight to the solver.
    """
    keep = list(dict.fromkeys([*by, *features, *([fold] if fold else [])]))
    long = long_targets(df, targets, keep)
    t = [term.value for term in terms(features, degree)]
    used = reduce(lambda a, b: a & b, [v.isNotNull() for v in t]) if t else F.lit(True)
    sums = [F.count("*").cast("double").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")]
    sums += [F.sum(v).alias(f"sx_{i}") for i, v in enumerate(t)]
    sums += [F.sum(v * F.col("y")).alias(f"sxy_{i}") for i, v in enumerate(t)]
    sums += [F.sum(t[i] * t[j]).alias(f"sxx_{i}_{j}") for i in range(len(t)) for j in range(i, len(t))]
    keys = [*by, "target"]
    fold_key = [col(fold).cast("int").alias("fold")] if fold else [F.lit(FULL).alias("fold")]
    return long.where(used).groupBy(*[col(k) for k in keys], *fold_key).agg(*sums)


def sum_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c in ("n", "sy", "syy") or c.split("_")[0] in ("sx", "sxy", "sxx")]


def training_sums(grams: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sums over all folds (fold = FULL) and, for every fold, over the other folds."""
    sums = sum_columns(grams)
    group = Window.partitionBy(*[col(k) for k in [*by, "target"]])
    totals = grams.withColumns({f"t_{c}": F.sum(c).over(group) for c in sums}).withColumn(
        "first", F.col("fold") == F.min("fold").over(group)
    )
    others = F.struct(F.col("fold"), *[(F.col(f"t_{c}") - F.col(c)).alias(c) for c in sums])
    whole = F.struct(F.lit(FULL).alias("fold"), *[F.col(f"t_{c}").alias(c) for c in sums])
    fits = F.explode(F.when(F.col("first"), F.array(others, whole)).otherwise(F.array(others)))
    return totals.select(*[col(k) for k in [*by, "target"]], fits.alias("s")).select(*[col(k) for k in [*by, "target"]], "s.*")


def solve_line(sums: DataFrame, models: Sequence[str] = ("Linear Regression",), by: Sequence[str] = ()) -> DataFrame:
    """Single-feature fits in closed form, in the JVM. Same columns as `solve`."""
    n, mean_x, mean_y = F.col("n"), safe_ratio(F.col("sx_0"), F.col("n")), safe_ratio(F.col("sy"), F.col("n"))
    g = F.col("sxx_0_0") - n * mean_x * mean_x
    g = F.when(g > FLAT * F.col("sxx_0_0"), g).otherwise(0.0)
    b = F.col("sxy_0") - n * mean_x * mean_y
    entries = []
    for model in models:
        spec = LINEAR_MODELS[model]
        precision = F.coalesce(safe_ratio(F.lit(1.0), g + spec.strength if spec.penalty == "l2" else g), F.lit(0.0))
        pull = b if spec.penalty != "l1" else F.signum(b) * F.greatest(F.abs(b) - n * spec.strength, F.lit(0.0))
        weight = pull * precision
        entries.append(F.struct(
            F.lit(model).alias("model"), n.alias("n"), (mean_y - weight * mean_x).alias("intercept"), F.array(weight).alias("weights"),
            F.array(mean_x).alias("means"), F.array(precision).alias("precision"),
            F.when(n > 0, "ok").otherwise("error: no training rows").alias("status"),
        ))
    keys = [*by, "target", "fold"]
    return sums.select(*[col(k) for k in keys], F.explode(F.array(*entries)).alias("f")).select(*[col(k) for k in keys], "f.*")


def _shrink(value: float, by: float) -> float:
    return np.sign(value) * max(abs(value) - by, 0.0)


def solve_one(n: float, sx: np.ndarray, sxx: np.ndarray, sy: float, sxy: np.ndarray, spec: LinearSpec):
    """Intercept, weights, term means and precision of the penalised centred Gram matrix of one fit."""
    mean_x, mean_y = sx / n, sy / n
    g = sxx - n * np.outer(mean_x, mean_x)
    b = sxy - n * mean_x * mean_y
    zero = FLAT * float(np.max(np.diag(sxx), initial=0.0))
    values, vectors = np.linalg.eigh(g + spec.strength * np.eye(len(sx)) if spec.penalty == "l2" else g)
    precision = (vectors * np.divide(1.0, values, out=np.zeros_like(values), where=values > zero)) @ vectors.T
    if spec.penalty == "l1":
        w, used = np.zeros(len(sx)), np.flatnonzero(np.diag(g) > zero)
        for _ in range(SWEEPS):
            before = w.copy()
            for j in used:
                w[j] = _shrink(b[j] - g[j] @ w + g[j, j] * w[j], n * spec.strength) / g[j, j]
            if np.max(np.abs(w - before), initial=0.0) < 1e-13 * max(1.0, np.max(np.abs(w), initial=0.0)):
                break
        else:
            raise ValueError(f"no convergence in {SWEEPS} sweeps")
    else:
        w = precision @ b
    return mean_y - mean_x @ w, w, mean_x, precision


def solve(sums: DataFrame, features: Sequence[str], models: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Fit every named linear model on every row of sums. A failed fit gives a row with its reason in `status`."""
    specs = {m: LINEAR_MODELS[m] for m in models}
    if len(features) == 1 and all(s.degree == 1 for s in specs.values()):
        return solve_line(sums, models, by)
    widest = 2 if any(f"sx_{len(features)}" == c for c in sums.columns) else 1
    size = {1: len(features), 2: len(term_names(features, 2))}
    total = size[widest]
    keys = [*by, "target", "fold"]
    kinds = dict(sums.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    schema += ", model string, n double, intercept double, weights array<double>, means array<double>, precision array<double>, status string"

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                for model, spec in specs.items():
                    p = size[spec.degree]
                    head = [r[k] for k in keys] + [model, r["n"]]
                    try:
                        if p > total:
                            raise ValueError("sums lack the degree-2 terms")
                        if not r["n"] > 0:
                            raise ValueError("no training rows")
                        sx = np.array([r[f"sx_{i}"] for i in range(p)])
                        sxy = np.array([r[f"sxy_{i}"] for i in range(p)])
                        sxx = np.array([[r[f"sxx_{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
                        b0, w, m, inv = solve_one(r["n"], sx, sxx, r["sy"], sxy, spec)
                        rows.append(head + [float(b0), w.tolist(), m.tolist(), inv.ravel().tolist(), "ok"])
                    except (ValueError, np.linalg.LinAlgError) as problem:
                        rows.append(head + [None, None, None, None, f"error: {problem}"])
            yield pd.DataFrame(rows, columns=[*keys, "model", "n", "intercept", "weights", "means", "precision", "status"])

    return sums.mapInPandas(fit, schema)


def solve_subsets(sums: DataFrame, features: Sequence[str], subsets: dict[str, Sequence[str]], by: Sequence[str] = ()) -> DataFrame:
    """Least squares on several subsets of the features, all from the sums of one pass; the subset's name is the model.

    Weights are those of all features, 0 outside the subset, so that any of these models is applied alike.
    """
    features, p = list(features), len(features)
    keys = [*by, "target", "fold"]
    kinds = dict(sums.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", model string, n double, intercept double, weights array<double>, status string"

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                sx = np.array([r[f"sx_{i}"] for i in range(p)])
                sxy = np.array([r[f"sxy_{i}"] for i in range(p)])
                sxx = np.array([[r[f"sxx_{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
                for model, names in subsets.items():
                    head, at = [*[r[k] for k in keys], model, r["n"]], [features.index(c) for c in names]
                    if not r["n"] > 0:
                        rows.append([*head, None, None, "error: no training rows"])
                        continue
                    b0, w, _, _ = solve_one(r["n"], sx[at], sxx[np.ix_(at, at)], r["sy"], sxy[at], LinearSpec())
                    whole = np.zeros(p)
                    whole[at] = w
                    rows.append([*head, float(b0), whole.tolist(), "ok"])
            yield pd.DataFrame(rows, columns=[*keys, "model", "n", "intercept", "weights", "status"])

    return sums.mapInPandas(fit, schema)


def term_names(features: Sequence[str], degree: int) -> list[str]:
    names = list(features)
    return names + [f"{a}*{b}" for a, b in combinations_with_replacement(features, 2)] if degree == 2 else names


def linear_value(features: Sequence[str], intercept: Column, weights: Column | Sequence[float], degree: int = 1) -> Column:
    """Prediction as a plain expression over feature columns."""
    parts = []
    for i, term in enumerate(terms(features, degree)):
        w = F.try_element_at(weights, F.lit(i + 1)) if isinstance(weights, Column) else F.lit(float(weights[i]))
        parts.append(w * term.value)
    return reduce(add, parts, intercept)


def spec_value(features: Sequence[str], models: Sequence[str], model: Column, intercept: Column, weights: Column) -> Column:
    """Prediction where the model, and so its degree, is told by a column."""
    wide = [m for m in models if LINEAR_MODELS[m].degree == 2]
    value = linear_value(features, intercept, weights)
    return F.when(model.isin(wide), linear_value(features, intercept, weights, 2)).otherwise(value) if wide else value


def fit_folds(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], models: Sequence[str], fold: str, by: Sequence[str] = ()
) -> DataFrame:
    """All full fits and all leave-one-fold-out fits of the linear models: one shuffle of the data's sums."""
    degree = max(LINEAR_MODELS[m].degree for m in models)
    return solve(training_sums(gram(df, features, targets, by, fold, degree), by), features, models, by)


def _with_models(long: DataFrame, packed: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per model. The packed models are copied to the executors only if they are measured to be small."""
    return lookup_join(long, packed, [*by, "target"], "inner").withColumn("_m", F.explode("_models"))


def out_of_fold(
    df: DataFrame,
    fits: DataFrame,
    features: Sequence[str],
    targets: Sequence[str],
    models: Sequence[str],
    fold: str,
    by: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row, target and model: the training-fit and the out-of-fold prediction."""
    entry = F.struct("fold", F.struct("intercept", "weights").alias("fit"))
    per_model = fits.where("status = 'ok'").groupBy(*[col(k) for k in by], "target", "model").agg(
        F.map_from_entries(F.collect_list(entry)).alias("fits")
    )
    packed = per_model.groupBy(*[col(k) for k in by], "target").agg(F.collect_list(F.struct("model", "fits")).alias("_models"))
    carried = list(dict.fromkeys([*by, *keep, *features, fold]))
    long = long_targets(df, targets, carried)
    joined = _with_models(long, packed, by)
    model, by_fold = F.col("_m.model"), F.col("_m.fits")

    def predicted(number: Column) -> Column:
        found = F.try_element_at(by_fold, number)
        return spec_value(features, models, model, found["intercept"], found["weights"])

    kept = list(dict.fromkeys([*by, *keep]))
    return joined.select(
        *[col(k) for k in kept], "target", model.alias("model"), col(fold).cast("int").alias("fold"), "y",
        predicted(F.lit(FULL)).alias("yhat_train"), predicted(col(fold).cast("int")).alias("yhat_cv"),
    )


def leave_one_out(
    df: DataFrame, fits: DataFrame, features: Sequence[str], targets: Sequence[str], by: Sequence[str] = (), keep: Sequence[str] = (), degree: int = 1
) -> DataFrame:
    """Leave-one-out predictions of unpenalised or ridge fits of one degree from the full fit alone.

    For these models the left-out residual is the residual divided by one minus the row's leverage, so no refits
    are needed. Rows with leverage one have no left-out prediction.
    """
    full = fits.where((F.col("fold") == FULL) & (F.col("status") == "ok")).select(
        *[col(k) for k in by], "target",
        F.struct("model", F.col("n").alias("rows"), "intercept", "weights", "means", "precision").alias("m"),
    )
    packed = full.groupBy(*[col(k) for k in by], "target").agg(F.collect_list("m").alias("_models"))
    carried = list(dict.fromkeys([*by, *keep, *features]))
    long = long_targets(df, targets, carried)
    joined = _with_models(long, packed, by)
    off = [t.value - F.col("_m.means")[i] for i, t in enumerate(terms(features, degree))]
    p = len(off)
    spread = reduce(add, [off[i] * F.col("_m.precision")[i * p + j] * off[j] for i in range(p) for j in range(p)])
    leverage = F.lit(1.0) / F.col("_m.rows") + spread
    fitted = linear_value(features, F.col("_m.intercept"), F.col("_m.weights"), degree)
    slack = F.when(1 - leverage > 1e-9, 1 - leverage)
    kept = list(dict.fromkeys([*by, *keep]))
    return joined.select(
        *[col(k) for k in kept], "target", F.col("_m.model").alias("model"), "y", fitted.alias("yhat_train"),
        (F.col("y") - safe_ratio(F.col("y") - fitted, slack)).alias("yhat_cv"),
    )


def leave_one_out_refits(
    df: DataFrame, sums: DataFrame, features: Sequence[str], targets: Sequence[str], models: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """Leave-one-out predictions of any linear model: each row's share is taken from the sums of its target, and the rest is solved.

    The sums are one row per target; rows are refitted where they lie, so neither fits nor folds are ever gathered.
    """
    features, keep, models = list(features), list(keep), list(models)
    degree = max(LINEAR_MODELS[m].degree for m in models)
    named = term_names(features, degree)
    p = len(named)
    totals = {}
    for r in sums.collect():
        sxx = np.array([[r[f"sxx_{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(p)] for i in range(p)])
        totals[r["target"]] = (r["n"], np.array([r[f"sx_{i}"] for i in range(p)]), sxx, r["sy"], np.array([r[f"sxy_{i}"] for i in range(p)]))
    long = long_targets(df, targets, list(dict.fromkeys([*keep, *features])))
    values = long.select(*[col(k) for k in keep], "target", "y", F.array(*[t.value for t in terms(features, degree)]).alias("_t"))
    kinds = dict(values.dtypes)
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keep) + ", target string, model string, y double, yhat_train double, yhat_cv double"
    names = [*keep, "target", "model", "y", "yhat_train", "yhat_cv"]

    def solved(total, spec):
        n, sx, sxx, sy, sxy = total
        q = p if spec.degree == degree else len(features)
        try:
            return solve_one(n, sx[:q], sxx[:q, :q], sy, sxy[:q], spec) if n > 0.5 else None
        except (ValueError, np.linalg.LinAlgError):
            return None

    def value(fit, t):
        return None if fit is None else float(fit[0] + fit[1] @ t[:len(fit[1])])

    def refit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = {(t, m): solved(total, LINEAR_MODELS[m]) for t, total in totals.items() for m in models}
        for batch in batches:
            rows = []
            for r in batch.to_dict("records"):
                t = np.asarray(r["_t"], float)
                n, sx, sxx, sy, sxy = totals[r["target"]]
                rest = (n - 1, sx - t, sxx - np.outer(t, t), sy - r["y"], sxy - t * r["y"])
                for m in models:
                    rows.append([*[r[k] for k in keep], r["target"], m, r["y"], value(whole[r["target"], m], t), value(solved(rest, LINEAR_MODELS[m]), t)])
            yield pd.DataFrame(rows, columns=names)

    return values.where(reduce(lambda a, b: a & b, [F.get("_t", F.lit(i)).isNotNull() for i in range(p)])).mapInPandas(refit, schema)

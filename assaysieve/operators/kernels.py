"""Kernel regressors of any number of rows: Gaussian process and kernel ridge, from sums over landmarks.

A model stands on at most `landmarks` distinct feature vectors of its experiment. The kernel between these and all rows is summed as products, per
fold, like the sums of a linear fit: every row counts, memory is bounded by the landmarks, and the training side of a fold is the total minus the
fold. An experiment with no more distinct vectors than landmarks is fitted exactly, however many rows repeat them. Large experiments are summed in chunks, so that none becomes one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaysieve.functions.exprs import col
from assaysieve.operators.linear import FULL, long_targets
from assaysieve.operators.skew import fits_broadcast, lookup_join

LANDMARKS = 200  # distinct feature vectors an experiment's models stand on: those of smallest hash
CHUNK_ROWS = 20_000
MERGED = 64  # partial sums that one task adds up
BUCKET_ROWS = 20_000  # rows of small experiments that are handled as one group
BUCKET_NUMBERS = 4_000_000  # numbers in their models
FOLDS = 6  # sums of a validated experiment that are held together, about: five folds and all rows

# Kernel settings. The signal amplitude is the only fitted one, within these bounds.
LENGTH_SCALE = 1.0
NOISE = 0.01
JITTER = 1e-6
AMPLITUDE_BOUNDS = (1e-5, 1e5)
RIDGE_STRENGTH = 1.0

MODEL_COLUMNS = (
    "model string, n int, m int, p int, points array<double>, dual array<double>, cover array<double>, "
    "amplitude double, gamma double, centre double, spread double, status string"
)
_NAMES = [c.split()[0] for c in MODEL_COLUMNS.split(", ")]
_TINY = 1e-12  # eigenvalues below this share of the largest are rounding noise


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0.0)


def fit_amplitude(eigenvalues: np.ndarray, projections: np.ndarray, bounds: tuple[float, float] = AMPLITUDE_BOUNDS) -> float:
    """Amplitude at the stationary point of the marginal likelihood uphill from 1.

    With the noise fixed, K = c R + s I shares the eigenvectors of R, so the likelihood is a function of log c alone.
    """
    if bounds[0] == bounds[1]:
        return float(bounds[0])
    s = NOISE + JITTER

    def slope(log_c: float) -> float:
        signal = np.exp(log_c) * eigenvalues
        total = signal + s
        return 0.5 * float(np.sum(projections * signal / total**2) - np.sum(signal / total))

    low, high = np.log(bounds)
    at, rising = 0.0, slope(0.0) > 0
    step = 0.25 if rising else -0.25
    while low < at + step < high and (slope(at + step) > 0) == rising:
        at += step
    a, b = at, min(max(at + step, low), high)
    if (slope(b) > 0) == rising:
        return float(np.clip(np.exp(b), *bounds))
    while abs(b - a) > 1e-12:
        middle = (a + b) / 2
        a, b = (middle, b) if (slope(middle) > 0) == rising else (a, middle)
    return float(np.clip(np.exp((a + b) / 2), *bounds))


def kernel_sums(x: np.ndarray, y: np.ndarray, points: np.ndarray, gamma: float) -> np.ndarray:
    """Rows, target sums, and sums of the kernel with the points: alone, times the target, and products of each pair."""
    k = np.exp(-gamma * squared_distances(x, points))
    return np.concatenate([[len(y), y.sum(), y @ y], k.sum(0), k.T @ y, (k.T @ k)[np.triu_indices(len(points))]])


def solve_kernel(name: str, points: np.ndarray, gamma: float, sums: np.ndarray, bounds: tuple[float, float] = AMPLITUDE_BOUNDS) -> dict:
    """The model of the rows that were summed.

    The points' own kernel is brought to eigenvectors; in these coordinates the model is a ridge regression, whose products are known from the
    sums. Where the points hold all rows, it is the model of the full kernel, for its variance too.
    """
    m = len(points)
    n, sy, syy = sums[:3]
    if not n > 0:
        raise ValueError("no training rows")
    once, with_y = sums[3:3 + m], sums[3 + m:3 + 2 * m]
    products = np.zeros((m, m))
    products[np.triu_indices(m)] = sums[3 + 2 * m:]
    products = products + np.triu(products, 1).T
    centre = sy / n
    spread = 1.0
    if name == "gaussian_process":
        variance = syy / n - centre * centre
        spread = float(np.sqrt(variance)) if variance > 1e-14 * syy / n else 1.0
    values, vectors = np.linalg.eigh(np.exp(-gamma * squared_distances(points, points)))
    real = values > _TINY * values[-1]
    basis = vectors[:, real] / np.sqrt(values[real])
    inner = basis.T @ products @ basis
    response = basis.T @ (with_y - centre * once) / spread
    own, turn = np.linalg.eigh((inner + inner.T) / 2)
    own = np.maximum(own, 0.0)
    turned = turn.T @ response
    basis = basis @ turn
    amplitude, noise = 1.0, RIDGE_STRENGTH
    if name == "gaussian_process":
        noise = NOISE + JITTER
        seen = own > _TINY * max(own.max(initial=0.0), 1e-300)
        amplitude = fit_amplitude(own[seen], turned[seen] ** 2 / own[seen], bounds)
    weight = 1 / (own + noise / amplitude)
    fit = {"points": points, "dual": basis @ (weight * turned) / amplitude, "cover": None, "amplitude": amplitude, "gamma": gamma,
           "centre": float(centre), "spread": spread}
    if name == "gaussian_process":
        fit["cover"] = (basis * (amplitude - noise * weight)) @ basis.T / amplitude**2
    return fit


def gamma_of(name: str, p: int, n: float, sx: float, sxx: float) -> float:
    """Kernel width from all rows of the experiment: fixed for a Gaussian process, by the variance of its numbers for kernel ridge."""
    if name == "gaussian_process":
        return 0.5 / LENGTH_SCALE**2
    variance = sxx / (n * p) - (sx / (n * p)) ** 2
    return 1.0 / (p * variance) if variance > 1e-14 * sxx / (n * p) else 1.0


def fit_rows(name: str, x: np.ndarray, y: np.ndarray, gamma: float | None = None) -> dict:
    """The exact model of a few rows, all of which are landmarks."""
    gamma = gamma_of(name, x.shape[1], len(y), x.sum(), (x * x).sum()) if gamma is None else gamma
    return solve_kernel(name, x, gamma, kernel_sums(x, y, x, gamma))


KERNEL_MODELS = ("gaussian_process", "kernel_ridge")


def kernel_predict(fit: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Mean and, for a Gaussian process, the deviation including the noise."""
    k = fit["amplitude"] * np.exp(-fit["gamma"] * squared_distances(x, fit["points"]))
    mean = k @ fit["dual"] * fit["spread"] + fit["centre"]
    if fit["cover"] is None:
        return mean, None
    variance = fit["amplitude"] + NOISE - np.einsum("ij,ij->i", k @ fit["cover"], k)
    return mean, np.sqrt(np.maximum(variance, 0.0)) * fit["spread"]


def experiment_plans(long: DataFrame, groups: Sequence[str], features: Sequence[str], landmarks: int, chunk_rows: int) -> DataFrame:
    """One row per experiment: its landmarks, sums of its numbers, and the chunks its rows are dealt to.

    Equal vectors are one landmark; they are dealt by vector, and then each task passes on no more than `landmarks` of an experiment.
    """
    keys = [col(g) for g in groups]
    numbers = F.array(*[col(c).cast("double") for c in features])
    squares = [col(c).cast("double") * col(c).cast("double") for c in features]
    sizes = long.groupBy(*keys).agg(
        F.count("*").alias("_rows"), F.sum(sum((col(c).cast("double") for c in features), F.lit(0.0))).alias("_sx"),
        F.sum(sum(squares, F.lit(0.0))).alias("_sxx"),
    ).withColumn("_chunks", F.greatest(F.lit(1), F.ceil(F.col("_rows") / F.lit(chunk_rows))).cast("int"))
    chosen = long.select(*keys, numbers.alias("_x")).distinct().withColumn("_i", F.row_number().over(
        Window.partitionBy(*keys).orderBy(F.xxhash64("_x"), F.col("_x")))).where(F.col("_i") <= landmarks)
    points = chosen.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda s: s["_x"]).alias("_points"))
    return sizes.join(points, list(groups))


def cell_of(df: DataFrame, keys: Sequence[str]) -> Column:
    """A text for each cell. Adding 0.0 makes a minus zero plain."""
    kinds = dict(df.dtypes)
    return F.to_json(F.struct(*[(col(k) + F.lit(0).cast(kinds[k]) if kinds[k] in ("double", "float") else col(k)).alias(k) for k in keys]))


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Cells dealt to buckets, each of which is one group of a task: most experiments are far too small for a group of their own."""
    return df.withColumn("_cell", cell_of(df, keys)).withColumn("_bucket", F.pmod(F.xxhash64("_cell"), F.lit(buckets)).cast("int")).repartition(buckets, "_bucket")


def buckets_for(df: DataFrame, cells: int, rows: int, numbers: int) -> int:
    """Buckets for so many cells, rows, and numbers in the models of all cells: several per core, and none beyond what a task holds."""
    return max(1, min(cells, max(2 * df.sparkSession.sparkContext.defaultParallelism, rows // BUCKET_ROWS, -(-numbers // BUCKET_NUMBERS))))


def _dealt(long: DataFrame, plans: DataFrame, groups: Sequence[str], carried: Sequence[str], models: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows dealt to chunks of their experiment, the experiment's plan repeated in each, and the largest number of chunks."""
    cells = [*groups, "_chunk"]
    products = F.col("_chunks").cast("bigint") * F.size("_points") * F.size("_points")
    measured = plans.agg(F.coalesce(F.sum("_chunks"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_chunks"), F.lit(1)), F.coalesce(F.sum(products), F.lit(0))).first()
    buckets = buckets_for(long, measured[0], measured[1], measured[3] * models)
    salted = lookup_join(long, plans.select(*[col(g) for g in groups], "_chunks"), groups, "inner").withColumn(
        "_chunk", F.pmod(F.xxhash64(*[col(c) for c in carried]), F.col("_chunks")).cast("int")
    ).drop("_chunks")
    repeated = plans.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    return bucketed(salted, cells, buckets), bucketed(repeated, cells, buckets), measured[2]


def _met(left: DataFrame, right: DataFrame):
    """Both sides grouped by bucket. The right one gets columns of its own, as both may come from the same frame."""
    own = right.select(*[col(c).alias(c) for c in right.columns])
    return left.groupBy("_bucket").cogroup(own.groupBy("_bucket"))


def _cells(pdf: pd.DataFrame) -> dict[str, np.ndarray]:
    """The places of each cell's rows."""
    return pdf.groupby("_cell", sort=False).indices if len(pdf) else {}


def _points(plan, p: int) -> np.ndarray:
    return np.array([list(x) for x in plan["_points"]], float).reshape(-1, p)


def kernel_gram(
    long: DataFrame, plans: DataFrame, groups: Sequence[str], features: Sequence[str], models: Sequence[str], fold: str | None = None
) -> DataFrame:
    """Kernel sums per experiment, model and fold, with the experiment's plan; fold is FULL without folds."""
    features, groups = list(features), list(groups)
    carried = list(dict.fromkeys([*groups, *([fold] if fold else []), *features, "y"]))
    salted, repeated, chunks = _dealt(long.select(*[col(c) for c in carried]), plans, groups, carried, len(models))
    kinds = dict(salted.dtypes)
    head = ", ".join(f"`{g}` {kinds[g]}" for g in groups)
    names, p = [*groups, "model", "fold", "part", "sums"], len(features)

    def summed(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        plan_of = dict(zip(right["_cell"], right.to_dict("records"), strict=True))
        all_x, all_y = left[features].to_numpy(float), left["y"].to_numpy(float)
        all_folds = left[fold].to_numpy() if fold else np.full(len(left), FULL)
        keys = [left[g].tolist() for g in groups]
        for cell, at in _cells(left).items():
            if (plan := plan_of.get(cell)) is None:
                continue
            points, x, y, folds = _points(plan, p), all_x[at], all_y[at], all_folds[at]
            for model in models:
                gamma = gamma_of(model, p, plan["_rows"], plan["_sx"], plan["_sxx"])
                for f in np.unique(folds):
                    sums = kernel_sums(x[folds == f], y[folds == f], points, gamma)
                    rows.append([*[k[at[0]] for k in keys], model, int(f), int(plan["_chunk"]) // MERGED, sums])
        return pd.DataFrame(rows, columns=names)

    schema = f"{head}, model string, fold int, part int, sums array<double>"
    sums = _met(salted, repeated).applyInPandas(summed, schema)

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        total = np.sum(np.stack(pdf["sums"].to_list()), axis=0)
        return pd.DataFrame([[*[first[g] for g in groups], first["model"], first["fold"], first["part"] // MERGED, total]], columns=names)

    parts = [*groups, "model", "fold", "part"]
    while chunks > 1:  # one round for every power of MERGED in the chunks of the largest experiment
        sums = sums.groupBy(*[col(c) for c in parts]).applyInPandas(merged, schema)
        chunks = -(-chunks // MERGED)
    return sums.drop("part").join(plans, groups)


def _solved(
    grams: DataFrame, plans: DataFrame, groups: Sequence[str], features: Sequence[str], folded: bool, bounds: tuple[float, float] = AMPLITUDE_BOUNDS
) -> DataFrame:
    """Models of all rows (fold = FULL) and, with folds, of all rows but each fold."""
    groups, p = list(groups), len(features)
    kinds = dict(grams.dtypes)
    head = ", ".join(f"`{g}` {kinds[g]}" for g in groups)
    names = [*groups, "fold", *_NAMES]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        held, rows = pdf.to_dict("records"), []
        for at in _cells(pdf).values():
            rows += solve_one([held[i] for i in at])
        return pd.DataFrame(rows, columns=names)

    def solve_one(sums_of: list[dict]) -> list[list]:
        first = sums_of[0]
        points, name = _points(first, p), first["model"]
        gamma = gamma_of(name, p, first["_rows"], first["_sx"], first["_sxx"])
        own = {int(s["fold"]): np.asarray(s["sums"], float) for s in sums_of}
        total = sum(own.values())
        rows = []
        for f, sums in {FULL: total, **({f: total - s for f, s in own.items()} if folded else {})}.items():
            head_ = [*[first[g] for g in groups], f, name, int(round(sums[0])), len(points), p]
            try:
                fit = solve_kernel(name, points, gamma, sums, bounds)
                cover = None if fit["cover"] is None else fit["cover"].ravel()
                rows.append([*head_, fit["points"].ravel(), fit["dual"], cover, fit["amplitude"], fit["gamma"], fit["centre"], fit["spread"], "ok"])
            except (ValueError, np.linalg.LinAlgError) as problem:
                rows.append([*head_, None, None, None, None, None, None, None, f"error: {problem}"])
        return rows

    measured = plans.agg(F.count("*"), F.coalesce(F.sum(F.size("_points").cast("bigint") * F.size("_points")), F.lit(0))).first()
    cells = measured[0] * len(KERNEL_MODELS)
    buckets = buckets_for(grams, cells, cells, measured[1] * len(KERNEL_MODELS) * (FOLDS if folded else 1))
    return bucketed(grams, [*groups, "model"], buckets).groupBy("_bucket").applyInPandas(solve, f"{head}, fold int, {MODEL_COLUMNS}")


def _whole_rows(df: DataFrame, features: Sequence[str], targets: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """Measured targets of rows with all features; models learn nothing from the others."""
    return long_targets(df, targets, list(dict.fromkeys([*carried, *features]))).dropna(subset=list(features))


def fit_kernels(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], models: Sequence[str], by: Sequence[str] = (),
    landmarks: int = LANDMARKS, chunk_rows: int = CHUNK_ROWS, bounds: tuple[float, float] = AMPLITUDE_BOUNDS,
) -> DataFrame:
    """One model row per (by, target, model), whatever the number of rows. Equal `bounds` fix the amplitude."""
    groups, features = [*by, "target"], list(features)
    long = _whole_rows(df, features, targets, by)
    plans = experiment_plans(long, groups, features, landmarks, chunk_rows).persist()
    return _solved(kernel_gram(long, plans, groups, features, models), plans, groups, features, False, bounds).drop("fold")


def kernel_out_of_fold(
    df: DataFrame, features: Sequence[str], targets: Sequence[str], models: Sequence[str], fold: str, row_id: str, by: Sequence[str] = (),
    landmarks: int = LANDMARKS, chunk_rows: int = CHUNK_ROWS, single: bool = False,
) -> DataFrame:
    """Training-fit and out-of-fold predictions of every row with all features.

    The few folds of a k-fold validation are models of their own. With `single` each row is a fold: no such models are made, but each row's
    share is taken from its experiment's sums where the row is predicted.
    """
    groups, features = [*by, "target"], list(features)
    long = _whole_rows(df, features, targets, [*by, row_id, fold]).persist()
    plans = experiment_plans(long, groups, features, landmarks, chunk_rows).persist()
    grams = kernel_gram(long, plans, groups, features, models, None if single else fold).persist()
    fits = _solved(grams, plans, groups, features, not single)
    per_group = fits.where("status = 'ok'").groupBy(*[col(g) for g in groups]).agg(F.collect_list(F.struct("fold", *_NAMES)).alias("_fits"))
    if single:
        per_group = per_group.join(grams.groupBy(*[col(g) for g in groups]).agg(F.collect_list(F.struct("model", "sums")).alias("_sums")), groups)
    carried = list(dict.fromkeys([*groups, row_id, fold, *features, "y"]))
    salted, repeated, _ = _dealt(long.select(*[col(c) for c in carried]), plans.join(per_group, groups), groups, carried, len(models) * FOLDS)
    kinds = dict(salted.dtypes)
    out = [*groups, row_id, "model", "fold", "y", "yhat_train", "yhat_cv"]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*groups, row_id]) + ", model string, fold int, y double, yhat_train double, yhat_cv double"

    def predicted(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        plan_of = dict(zip(right["_cell"], right.to_dict("records"), strict=True))
        parts = [told for cell, at in _cells(left).items() if cell in plan_of and (told := predicted_cell(left.iloc[at], plan_of[cell])) is not None]
        return pd.concat(parts) if parts else pd.DataFrame(columns=out)

    def predicted_cell(left: pd.DataFrame, plan: dict) -> pd.DataFrame | None:
        x, y, folds = left[features].to_numpy(float), left["y"].to_numpy(float), left[fold].to_numpy()
        fitted = {(r["model"], int(r["fold"])): unpack(r) for r in plan["_fits"]}
        parts = []
        for model in models:
            if (model, FULL) not in fitted:
                continue
            whole = fitted[model, FULL]
            cv = np.full(len(y), np.nan)
            if single:
                total = next(np.asarray(s["sums"], float) for s in plan["_sums"] if s["model"] == model)
                for i in range(len(y)):
                    rest = total - kernel_sums(x[i:i + 1], y[i:i + 1], whole["points"], whole["gamma"])
                    if rest[0] > 0.5:
                        cv[i] = kernel_predict(solve_kernel(model, whole["points"], whole["gamma"], rest), x[i:i + 1])[0][0]
            else:
                for f in np.unique(folds):
                    if (model, int(f)) in fitted:
                        cv[folds == f] = kernel_predict(fitted[model, int(f)], x[folds == f])[0]
            part = left[[*groups, row_id, "y"]].assign(model=model, fold=folds.astype("int32"), yhat_train=kernel_predict(whole, x)[0])
            parts.append(part.assign(yhat_cv=pd.Series(cv, index=part.index).where(~np.isnan(cv), None).astype(object)))
        return pd.concat(parts)[out] if parts else None

    return _met(salted, repeated).applyInPandas(predicted, schema)


def unpack(row) -> dict:
    m, p = int(row["m"]), int(row["p"])
    cover = row["cover"]
    return {
        "points": np.asarray(row["points"], float).reshape(m, p), "dual": np.asarray(row["dual"], float),
        "cover": None if cover is None else np.asarray(cover, float).reshape(m, m),
        "amplitude": row["amplitude"], "gamma": row["gamma"], "centre": row["centre"], "spread": row["spread"],
    }


def append_kernels(df: DataFrame, fits: dict[str, dict], features: Sequence[str]) -> DataFrame:
    """Add prediction and deviation columns of fitted models, one pair per target, while streaming through."""
    features = list(features)
    schema = T.StructType(df.schema.fields + [
        T.StructField(f"{t}_{part}", T.DoubleType()) for t in fits for part in ("mean", "deviation")
    ])

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(float)
            added = {}
            for target, fit in fits.items():
                mean, deviation = kernel_predict(fit, x)
                added[f"{target}_mean"] = mean
                added[f"{target}_deviation"] = deviation if deviation is not None else np.full(len(x), np.nan)
            yield batch.assign(**added)

    return df.mapInPandas(stream, schema)


def score_kernels(
    library: DataFrame, fits: DataFrame, features: Sequence[str], keep: Sequence[str], by: Sequence[str] = (), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Mean and deviation for every library row, target and model, long form.

    A row with a missing feature keeps its place with NULL predictions; a row of a group without any model has one row, with neither.

    Without groups the few models travel with the task and the library streams through in Arrow batches. With
    groups, library rows meet their group's models in chunks of bounded size: the models of a large group are
    repeated once per chunk, so that one group never becomes one task.
    """
    features, keep, by = list(features), list(keep), list(by)
    usable = fits.where("status = 'ok'")
    carried = list(dict.fromkeys([*by, *keep, *features]))
    rows = library.select(*[col(c) for c in carried])
    kinds = dict(rows.dtypes)
    kept = list(dict.fromkeys([*by, *keep]))
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", target string, model string, prediction double, deviation double"

    def predicted(x: np.ndarray, fit: dict) -> tuple[np.ndarray, np.ndarray]:
        whole = ~np.isnan(x).any(1)
        mean, deviation = np.full(len(x), np.nan), np.full(len(x), np.nan)
        found = kernel_predict(fit, x[whole])
        mean[whole] = found[0]
        if found[1] is not None:
            deviation[whole] = found[1]
        return mean, deviation

    def known(values: np.ndarray) -> pa.Array:
        return pa.array(values, pa.float64(), mask=np.isnan(values))

    def told(pdf: pd.DataFrame, target, model, mean: np.ndarray, deviation: np.ndarray) -> pd.DataFrame:
        values = {c: known(v).to_pandas(types_mapper=pd.ArrowDtype) for c, v in (("prediction", mean), ("deviation", deviation))}
        return pdf[kept].reset_index(drop=True).assign(target=target, model=model, **values)

    if not by:
        if not fits_broadcast(usable):
            raise ValueError("so many targets and models exceed the broadcast bound: score them by group")
        models = [(r["target"], r["model"], unpack(r)) for r in usable.collect()]

        def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = batch[features].to_numpy(float)
                for target, model, fit in models:
                    yield told(batch, target, model, *predicted(x, fit))

        return rows.mapInPandas(stream, schema)

    sizes = rows.groupBy(*[col(k) for k in by]).agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / F.lit(chunk_rows))).cast("int").alias("_chunks"), F.count("*").alias("_rows")
    ).persist()
    cells_, total = sizes.agg(F.coalesce(F.sum("_chunks"), F.lit(0)), F.coalesce(F.sum("_rows"), F.lit(0))).first()
    cells = [*by, "_chunk"]
    usable = usable.persist()
    numbers = usable.join(sizes.drop("_rows"), by).agg(F.sum(F.col("_chunks").cast("bigint") * (F.col("m") * F.col("p") + F.greatest(F.size("cover"), F.lit(0)))))
    buckets = buckets_for(rows, cells_, total, numbers.first()[0] or 0)
    salted = lookup_join(rows, sizes.drop("_rows"), by, "inner").withColumn(
        "_chunk", F.pmod(F.xxhash64(*[col(c) for c in carried]), F.col("_chunks")).cast("int")
    ).drop("_chunks")
    every = F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))
    repeated = usable.join(sizes.drop("_rows"), by).withColumn("_chunk", every).drop("_chunks")

    def chunk(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame(columns=[*kept, "target", "model", "prediction", "deviation"])
        x, fits_of, fitted = left[features].to_numpy(float), _cells(right), right.to_dict("records")
        places, targets, names, means, deviations = [], [], [], [], []
        for cell, at in _cells(left).items():
            for i in fits_of.get(cell, [None]):
                fit = None if i is None else fitted[i]
                mean, deviation = (np.full(len(at), np.nan),) * 2 if fit is None else predicted(x[at], unpack(fit))
                places.append(at)
                targets += [fit and fit["target"]] * len(at)
                names += [fit and fit["model"]] * len(at)
                means.append(mean)
                deviations.append(deviation)
        return told(left.iloc[np.concatenate(places)], targets, names, np.concatenate(means), np.concatenate(deviations))

    return _met(bucketed(salted, cells, buckets), bucketed(repeated, cells, buckets)).applyInPandas(chunk, schema)

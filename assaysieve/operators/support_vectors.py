"""Support-vector regression with a Gaussian kernel: every experiment, target and fold in the same jobs, and the duality gap of each fit.

The dual gives each row a coefficient between -cost and cost, all of which add up to 0. Steps move two coefficients against each other, the pair that violates the conditions most, as
far as the insensitive band and the box allow. An experiment of up to `LOCAL_ROWS` rows is one group per fit. So is one of up to `SPAN_ROWS`, where few rows span the kernel of all
(`spanned_vectors`), which closes the gap in time that grows as the rows do. Any other is dealt in parts anew in every round: each part is solved alone
against the residuals of all rows, the moves of all parts are joined along the step that raises the dual most, and residuals follow by kernel products with the rows that moved,
until the gap closes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.functions.exprs import col
from assaysieve.operators.histogram_trees import FULL, Fitted, _as_matrix, _features, _is, _vectors, _without, cell_tables, exploded_fits, met_by_experiment, spread_fits
from assaysieve.operators.kernels import bucketed
from assaysieve.operators.spanned_vectors import kernel, solve_spanned
from assaysieve.session import checkpointable, delete_paths, scratch_path

MODEL = "support_vectors"
# Cost of a row outside the band, and the band's half-width.
COST = 1.0
BAND = 0.1
TOLERANCE = 1e-3  # of the conditions, and of the gap against the primal
LOCAL_ROWS = 4_000
SPAN_ROWS = 1_000_000
PART_ROWS = 2_000
BUCKET_ROWS = 20_000  # rows of several small experiments that are one group, about
ROUNDS = 200
CHUNK = 4_096  # support vectors in one row of a model
MODEL_BYTES = 64 * 1024 * 1024
STEPS = tuple(2.0 ** -k for k in range(12))
UNSOLVED = -1  # chunk of the row that stands for a fit whose kernel too few rows span


def width(n: float, p: int, total: float, squares: float) -> float:
    """The kernel's width by the variance of all numbers of the training rows."""
    variance = squares / (n * p) - (total / (n * p)) ** 2 if n * p else 0.0
    return 1.0 / (p * variance) if variance > 1e-14 * max(squares / max(n * p, 1), 1e-300) else 1.0


def slopes(beta: np.ndarray, residual: np.ndarray, cost: float, band: float) -> tuple[np.ndarray, np.ndarray]:
    """What the dual gains per unit when a coefficient rises, and loses when it falls; infinite where the box ends."""
    rising = np.where(beta < cost, residual - np.where(beta >= 0, band, -band), -np.inf)
    falling = np.where(beta > -cost, residual - np.where(beta > 0, band, -band), np.inf)
    return rising, falling


def best_move(low: float, high: float, gain: float, curve: float, a: float, b: float, band: float) -> float:
    """The t in [low, high] with the largest gain * t - curve * t^2 / 2 - band * (|a + t| + |b - t|)."""
    borders = sorted({low, high, *(x for x in (-a, b) if low < x < high)})
    best, value = 0.0, -band * (abs(a) + abs(b))
    for left, right in zip(borders, borders[1:], strict=False):
        middle = (left + right) / 2
        slope = gain - band * (math.copysign(1.0, a + middle) - math.copysign(1.0, b - middle))
        t = min(max(slope / curve, left), right) if curve > 1e-12 else (right if slope > 0 else left)
        here = gain * t - curve * t * t / 2 - band * (abs(a + t) + abs(b - t))
        if here > value + 1e-15:
            best, value = t, here
    return best


def solve(k: np.ndarray, residual: np.ndarray, beta: np.ndarray, cost: float = COST, band: float = BAND, tolerance: float = TOLERANCE, steps: int | None = None) -> np.ndarray:
    """Coefficients of rows whose kernel is `k`, from `beta` and the residuals it leaves (targets less predictions without bias)."""
    beta, residual = beta.copy(), residual.copy()
    for _ in range(steps or max(10_000, 200 * len(beta))):
        rising, falling = slopes(beta, residual, cost, band)
        i, j = int(rising.argmax()), int(falling.argmin())
        if not rising[i] - falling[j] > tolerance:
            break
        if i == j:
            break
        low, high = max(-cost - beta[i], beta[j] - cost), min(cost - beta[i], cost + beta[j])
        t = best_move(low, high, residual[i] - residual[j], k[i, i] + k[j, j] - 2 * k[i, j], beta[i], beta[j], band)
        if t == 0.0:
            break
        beta[i] += t
        beta[j] -= t
        residual -= t * (k[:, i] - k[:, j])
    return np.where(np.abs(beta) < 1e-12, 0.0, beta)


def bias_of(beta: np.ndarray, residual: np.ndarray, cost: float, band: float) -> float:
    rising, falling = slopes(beta, residual, cost, band)
    ends = [x for x in (rising.max(initial=-np.inf), falling.min(initial=np.inf)) if np.isfinite(x)]
    return float(np.mean(ends)) if ends else 0.0


def gap_of(beta: np.ndarray, residual: np.ndarray, y: np.ndarray, cost: float, band: float) -> tuple[float, float]:
    """Primal less dual, and the primal."""
    smooth = float(beta @ (y - residual))
    primal = smooth / 2 + cost * float(np.maximum(np.abs(residual - bias_of(beta, residual, cost, band)) - band, 0).sum())
    return primal - (float(beta @ y) - band * float(np.abs(beta).sum()) - smooth / 2), primal


_MODEL = "chunk int, points array<double>, beta array<double>, bias double, gamma double, gap double"
_MODEL_NAMES = [c.split()[0] for c in _MODEL.split(", ")]


Solver = Callable[[np.ndarray, np.ndarray, float, float, float, float], tuple[np.ndarray, np.ndarray, float, float] | None]


def solve_pairs(x: np.ndarray, y: np.ndarray, gamma: float, cost: float, band: float, tolerance: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """Support vectors, their coefficients, bias and duality gap, by moves of pairs."""
    k = kernel(x, x, gamma)
    beta = solve(k, y, np.zeros(len(x)), cost, band, tolerance)
    residual = y - k @ beta
    some = beta != 0
    return x[some], beta[some], bias_of(beta, residual, cost, band), gap_of(beta, residual, y, cost, band)[0]


def _told(x: np.ndarray, points: np.ndarray, beta: np.ndarray, bias: float, gamma: float) -> np.ndarray:
    parts = [kernel(x[at:at + 2 * CHUNK], points, gamma) @ beta for at in range(0, len(x), 2 * CHUNK)]
    return np.concatenate([np.zeros(0), *parts]) + bias


def _local_fit(by: list[str], features: int, cost: float, band: float, tolerance: float, solver: Solver):
    names = [*by, "target", "left_out"]

    def fit_all(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        return pa.concat_tables([fit([own[c][0] for c in names], own) for own in cell_tables(table).values()]).combine_chunks()

    def fit(key: Sequence[pa.Scalar], table: pa.Table) -> pa.Table:
        left_out = key[-1].as_py()
        table = table.sort_by("hash")  # steps stop within the tolerance: the order of rows must not tell where
        x, y, fold = _features(table, features), table["y"].to_numpy(), table["fold"].to_numpy()
        whole = ~np.isnan(x).any(1)
        train = whole & (fold != left_out)
        points, values = x[train], np.full(len(y), np.nan)
        held = np.zeros((0, features))
        beta = np.zeros(0)
        bias = gamma = gap = 0.0
        solved = True
        if train.any():
            gamma = width(len(points), features, points.sum(), (points * points).sum())
            found = solver(points, y[train], gamma, cost, band, tolerance)
            solved = found is not None
            if found:
                held, beta, bias, gap = found
                values[whole] = _told(x[whole], held, beta, bias, gamma)
        asked = np.flatnonzero(whole if left_out == FULL else whole & (fold == left_out)) if solved else np.zeros(0, int)
        chunks = max(1, math.ceil(len(held) / CHUNK)) if not solved or left_out == FULL and train.any() else 0
        n, t = asked.size, chunks
        join = lambda found, missing, kind: pa.concat_arrays([found, pa.nulls(missing, kind)])
        out = {name: pa.array([key[i].as_py()] * (n + t), key[i].type) for i, name in enumerate([*by, "target"])}
        out["model"], out["left_out"] = pa.array([MODEL] * (n + t), pa.string()), pa.array([left_out] * (n + t), pa.int32())
        out["row"] = join(table["row"].combine_chunks().take(pa.array(asked)), t, table["row"].type)
        out["fold"] = join(pa.array(fold[asked], pa.int32()), t, pa.int32())
        out["y"], out["yhat"] = (join(pa.array(v[asked], pa.float64()), t, pa.float64()) for v in (y, values))
        parts = [slice(c * CHUNK, (c + 1) * CHUNK) for c in range(t)]
        kinds = {"chunk": pa.int32(), "points": pa.list_(pa.float64()), "beta": pa.list_(pa.float64()), "bias": pa.float64(), "gamma": pa.float64(), "gap": pa.float64()}
        model = {"chunk": list(range(t)) if solved else [UNSOLVED], "points": [held[s].ravel().tolist() for s in parts], "beta": [beta[s].tolist() for s in parts], "bias": [bias] * t, "gamma": [gamma] * t, "gap": [gap] * t}
        for name, kind in kinds.items():
            out[name] = pa.concat_arrays([pa.nulls(n, kind), pa.array(model[name], kind)])
        return pa.table(out)

    return fit, fit_all


def fit_support_vectors(
    rows: DataFrame, features: Sequence[str], targets: Sequence[str], row_id: str, fold: str | None = None, by: Sequence[str] = (),
    cost: float = COST, band: float = BAND, tolerance: float = TOLERANCE, local_rows: int = LOCAL_ROWS, part_rows: int = PART_ROWS,
) -> Fitted:
    """Fit every experiment and target on all rows and, if there is a fold, without each fold. Rows with a missing feature or target take no part.

    The table of models has the support vectors in chunks, the bias, the kernel's width and the duality gap. A model beyond `local_rows` may stand on rows that span
    the others instead, with the weights that make the same function.
    """
    by, features, targets = list(by), list(features), list(targets)
    spark, p = rows.sparkSession, len(features)
    whole = F.lit(True)
    for c in features:
        whole = whole & col(c).isNotNull() & ~F.isnan(col(c).cast("double"))
    values = F.array(*[F.struct(F.lit(t).alias("target"), col(t).cast("double").alias("y")) for t in targets])
    base = rows.where(whole).select(
        *[col(k) for k in by], col(row_id).alias("row"), F.xxhash64(col(row_id).cast("string")).alias("hash"), (col(fold).cast("int") if fold else F.lit(0)).alias("fold"),
        *[col(c).cast("double").alias(f"f{j}") for j, c in enumerate(features)], values.alias("_targets"))
    kinds = dict(base.dtypes)
    sizes = base.groupBy(*[col(k) for k in by]).count().where(F.col("count") > local_rows)
    large = sizes.collect()  # fewer than rows / local_rows
    head = [*[f"`{k}` {kinds[k]}" for k in by], "target string, model string, left_out int", f"row {kinds['row']}", "fold int, y double, yhat double", _MODEL]
    names = [*by, "target", "model", "left_out", "row", "fold", "y", "yhat", *_MODEL_NAMES]
    schema, path, written = ", ".join(head), scratch_path(spark, "vector-fits"), []

    def write(found: DataFrame) -> None:
        written.append(f"{path}/{len(written)}")
        found.select(*[col(c) for c in names]).write.parquet(written[-1])

    if by or not large:
        small = _without(base, sizes.drop("count"), by) if by else base
        dealt = exploded_fits(small, by, p, fold is not None)
        # Most experiments are far too small for a group of their own: a group holds several fits, which are made one after the other.
        tasks = max(4 * spark.sparkContext.defaultParallelism, dealt.count() // BUCKET_ROWS)
        write(bucketed(dealt, [*by, "target", "left_out"], tasks).groupBy("_bucket").applyInArrow(_local_fit(by, p, cost, band, tolerance, solve_pairs)[1], schema))
    spanned = [key for key in large if key["count"] <= SPAN_ROWS]
    unsolved = [(key, target, None) for key in large if key["count"] > SPAN_ROWS for target in targets]
    if spanned:
        own = _among(base, sizes.where(F.col("count") <= SPAN_ROWS).drop("count"), by) if by else base
        each = [*[col(k) for k in by], F.col("target"), F.col("left_out")]
        write(spread_fits(exploded_fits(own, by, p, fold is not None), own, each).groupBy(*each).applyInArrow(_local_fit(by, p, cost, band, tolerance, solve_spanned)[0], schema))
        lost = spark.read.schema(schema).parquet(written[-1]).where(F.col("chunk") == UNSOLVED).select(*[col(k) for k in by], "target", "left_out").collect()
        unsolved += [(key, key["target"], key["left_out"]) for key in lost]
    for key, target, left_out in unsolved:
        own = base.where(_is(key, by)).drop(*by)
        for found in _fit_table(own, p, targets.index(target), target, left_out, fold is not None, cost, band, tolerance, part_rows):
            write(found.withColumns({k: F.lit(key[k]).cast(kinds[k]) for k in by}))
    fits = spark.read.schema(schema).parquet(*written).where(F.col("chunk").isNull() | (F.col("chunk") != UNSOLVED))
    keys = [*[col(k) for k in by], "target", "model"]
    full = F.col("left_out") == FULL
    predicted = fits.where("chunk is null").groupBy(*keys, "row").agg(
        F.max("fold").alias("fold"), F.max("y").alias("y"), F.sum(F.when(full, F.col("yhat"))).alias("yhat_train"), F.sum(F.when(~full, F.col("yhat"))).alias("yhat_cv"))
    known = {c: F.when(~F.isnan(c), F.col(c)) for c in ("yhat_train", "yhat_cv")}
    return Fitted(by, features, fits.where("chunk is not null").select(*keys, *_MODEL_NAMES), lambda: predicted.withColumns(known).withColumnRenamed("row", row_id))


# Experiments of any size

def _fit_table(
    base: DataFrame, p: int, place: int, target: str, left_out: int | None, folds: bool, cost: float, band: float, tolerance: float, part_rows: int,
) -> list[DataFrame]:
    """The fit of a target without one fold, or all its fits."""
    checkpointable(base.sparkSession)
    left = [left_out] if left_out is not None else [FULL, *(sorted(r[0] for r in base.select("fold").distinct().collect()) if folds else [])]
    rows = base.select("row", "hash", "fold", F.array(*[f"f{j}" for j in range(p)]).alias("x"), F.col("_targets")[place]["y"].alias("y")).where("y is not null")
    return [found for one in left for found in _fit_rounds(rows, p, target, one, cost, band, tolerance, part_rows)]


def _among(base: DataFrame, some: DataFrame, by: list[str]) -> DataFrame:
    same = F.lit(True)
    for k in by:
        same = same & base[k].eqNullSafe(some[k])
    return base.join(F.broadcast(some), same, "left_semi")


def _moved_part(gamma: float, p: int, cost: float, band: float, tolerance: float):
    """The move of one part's coefficients, solved alone against the residuals it was given."""

    def move(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x, beta, residual = _as_matrix(table["x"].combine_chunks(), p), table["beta"].to_numpy(), table["residual"].to_numpy()
        new = solve(kernel(x, x, gamma), residual, beta, cost, band, tolerance, 20 * len(beta))
        return pa.table({"row": table["row"], "move": new - beta})

    return move


def _products(rows: DataFrame, points: np.ndarray, weights: np.ndarray, gamma: float) -> Column:
    """A column: the kernel of each row with the points, times the weights. The points come in pieces of bounded size."""
    p = points.shape[1]
    shared = rows.sparkSession.sparkContext.broadcast((points, weights))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x, (held, by) = _as_matrix(batch, p), shared.value
            total = np.zeros(len(x))
            for at in range(0, len(held), CHUNK):
                total += kernel(x, held[at:at + CHUNK], gamma) @ by[at:at + CHUNK]
            yield pa.array(total)

    return arrow_udf(run, returnType="double")(F.col("x"))


def _pieces(moved: DataFrame, p: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their weights in pieces of at most `size` rows: only one piece is on the driver at a time."""
    count = moved.count()
    pieces = max(1, math.ceil(1.2 * count / size))
    for k in range(pieces):
        own = moved.where(F.pmod("hash", F.lit(pieces)) == k).select("x", "move").toArrow()
        yield _as_matrix(own["x"].combine_chunks(), p) if own.num_rows else np.zeros((0, p)), own["move"].to_numpy()


def _fit_rounds(rows: DataFrame, p: int, target: str, left_out: int, cost: float, band: float, tolerance: float, part_rows: int) -> list[DataFrame]:
    spark = rows.sparkSession
    train = rows.where(F.col("fold") != left_out)
    n, total, squares = train.agg(F.count("*"), F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v)), F.sum(F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v))).first()
    if not n:
        return [rows.where("false").select(F.lit(target).alias("target"), F.lit(MODEL).alias("model"), F.lit(left_out).alias("left_out"), "row", "fold", "y", "y", *_nothing())]
    gamma, parts = width(n, p, total, squares), max(1, math.ceil(n / part_rows))
    piece = max(1, MODEL_BYTES // (8 * (p + 1)))
    path = scratch_path(spark, "vector-round")
    train.select("row", "hash", "fold", "x", "y", F.lit(0.0).alias("beta"), F.col("y").alias("residual")).write.parquet(path)
    state, written = spark.read.parquet(path), [path]
    gap, primal, bias = _gap(state, cost, band)
    rounds = 0
    while gap > tolerance * max(primal, 1e-12) and rounds < ROUNDS:
        dealt = state.withColumn("part", F.pmod(F.xxhash64("hash", F.lit(rounds)), F.lit(parts)))
        moves = dealt.groupBy("part").applyInArrow(_moved_part(gamma, p, cost, band, tolerance), f"row {dict(rows.dtypes)['row']}, move double").where("move <> 0")
        path = scratch_path(spark, "vector-moves")
        state.join(moves.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left").drop("_row").fillna(0.0, ["move"]).write.parquet(path)
        moved = spark.read.parquet(path)
        written.append(path)
        carried = moved.withColumn("change", F.lit(0.0))
        for points, weights in _pieces(moved.where("move <> 0"), p, piece):
            carried = carried.withColumn("change", F.col("change") + _products(carried, points, weights, gamma))
        path = scratch_path(spark, "vector-change")
        carried.write.parquet(path)
        carried = spark.read.parquet(path)
        written.append(path)
        step = _step(carried, band)
        if step == 0.0:
            break
        state = carried.select("row", "hash", "fold", "x", "y", (F.col("beta") + step * F.col("move")).alias("beta"), (F.col("residual") - step * F.col("change")).alias("residual"))
        gap, primal, bias = _gap(state, cost, band)
        delete_paths(spark, written[:-1])
        written, rounds = written[-1:], rounds + 1
    support = state.where("abs(beta) > 1e-12")
    asked = rows if left_out == FULL else rows.where(F.col("fold") == left_out)
    told = asked.withColumn("yhat", F.lit(bias))
    for points, weights in _pieces(support.withColumn("move", F.col("beta")), p, piece):
        told = told.withColumn("yhat", F.col("yhat") + _products(told, points, weights, gamma))
    head = [F.lit(target).alias("target"), F.lit(MODEL).alias("model"), F.lit(left_out).alias("left_out")]
    out = [told.select(*head, "row", "fold", "y", "yhat", *_nothing())]
    if left_out == FULL:
        chunks = max(1, math.ceil(support.count() / CHUNK))
        held = support.withColumn("chunk", F.pmod(F.xxhash64("hash", F.lit("chunk")), F.lit(chunks)).cast("int")).groupBy("chunk").agg(
            F.collect_list(F.struct("x", "beta")).alias("s"))
        kind = dict(rows.dtypes)["row"]
        out.append(held.select(*head, F.lit(None).cast(kind).alias("row"), F.lit(None).cast("int").alias("fold"), F.lit(None).cast("double").alias("y"), F.lit(None).cast("double").alias("yhat"), "chunk",
                               F.flatten("s.x").alias("points"), F.col("s.beta").alias("beta"), F.lit(bias).alias("bias"), F.lit(gamma).alias("gamma"), F.lit(gap).alias("gap")))
    return out


def _nothing() -> list[Column]:
    return [F.lit(None).cast(c.split(" ", 1)[1]).alias(c.split()[0]) for c in _MODEL.split(", ")]


def _gap(state: DataFrame, cost: float, band: float) -> tuple[float, float, float]:
    """Duality gap, primal and bias: two rows of sums."""
    b, r = F.col("beta"), F.col("residual")
    ends = state.agg(F.max(F.when(b < cost, r - F.when(b >= 0, band).otherwise(-band))), F.min(F.when(b > -cost, r - F.when(b > 0, band).otherwise(-band)))).first()
    known = [e for e in ends if e is not None]
    bias = sum(known) / len(known) if known else 0.0
    loss, smooth, fit, size = state.agg(
        F.sum(F.greatest(F.abs(r - bias) - band, F.lit(0.0))), F.sum(b * (F.col("y") - r)), F.sum(b * F.col("y")), F.sum(F.abs(b))).first()
    primal = smooth / 2 + cost * loss
    return primal - (fit - band * size - smooth / 2), primal, bias


def _step(carried: DataFrame, band: float) -> float:
    """The step along all moves together that raises the dual most, of a few."""
    b, m = F.col("beta"), F.col("move")
    found = carried.agg(F.sum(F.col("residual") * m).alias("gain"), F.sum(m * F.col("change")).alias("curve"), F.sum(F.abs(b)).alias("now"),
                        *[F.sum(F.abs(b + s * m)).alias(f"s{i}") for i, s in enumerate(STEPS)]).first()
    gains = [s * found["gain"] - s * s * found["curve"] / 2 - band * (found[f"s{i}"] - found["now"]) for i, s in enumerate(STEPS)]
    best = int(np.argmax(gains))
    return STEPS[best] if gains[best] > 0 else 0.0


# Scoring

def predictor(model: DataFrame):
    """A function from feature rows to predictions, for a model of bounded size."""
    size = model.agg(F.sum(F.size("points") + F.size("beta"))).first()[0] or 0
    if size * 8 > MODEL_BYTES:
        raise ValueError("so many support vectors exceed the broadcast bound: score them with score_vectors")
    held = model.toArrow().sort_by("chunk")
    beta = pc.list_flatten(held["beta"]).to_numpy()
    points = pc.list_flatten(held["points"]).to_numpy().reshape(len(beta), -1) if len(beta) else np.zeros((0, 0))
    bias, gamma = float(held["bias"][0].as_py()), float(held["gamma"][0].as_py())

    def predict(x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), bias)
        for at in range(0, len(beta), CHUNK):
            total += kernel(x, points[at:at + CHUNK], gamma) @ beta[at:at + CHUNK]
        return total

    return predict


def score_vectors(df: DataFrame, model: DataFrame, features: Sequence[str], to: str = "yhat") -> DataFrame:
    """All rows with the prediction of one model, NULL where a feature is missing. Support vectors are copied to the executors in pieces of bounded size."""
    bias, gamma, count = model.agg(F.max("bias"), F.max("gamma"), F.count("*")).first()
    p = len(features)
    per_piece = max(1, MODEL_BYTES // (8 * (p + 1) * CHUNK))
    out = df.withColumns({"x": _vectors(features), "_sum": F.lit(float(bias))}) if "x" not in df.columns else df.withColumn("_sum", F.lit(float(bias))).withColumn("_own_x", F.col("x")).withColumn("x", _vectors(features))
    lost = F.exists("x", lambda v: v.isNull())
    for begin in range(0, count, per_piece):
        own = model.where(F.col("chunk").between(begin, begin + per_piece - 1)).toArrow()
        beta = pc.list_flatten(own["beta"]).to_numpy()
        if len(beta):
            out = out.withColumn("_sum", F.col("_sum") + _products(out, pc.list_flatten(own["points"]).to_numpy().reshape(len(beta), p), beta, gamma))
    out = out.withColumn("_sum", F.when(~lost, F.col("_sum"))).drop("x")
    if "_own_x" in out.columns:
        out = out.withColumnRenamed("_own_x", "x").select(*[col(c) for c in df.columns], "_sum")
    return out.drop(to).withColumnRenamed("_sum", to)


def score_experiments(library: DataFrame, models: DataFrame, features: Sequence[str], keep: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows with the predictions of all models of their experiment, long: by, keep, target, model, prediction. Rows without a model are left out."""
    p = len(features)

    def work(x: np.ndarray, held: pa.Table) -> np.ndarray:
        beta = pc.list_flatten(held["beta"]).to_numpy()
        points = pc.list_flatten(held["points"]).to_numpy().reshape(len(beta), p)
        whole = ~np.isnan(x).any(1)
        out = np.full(len(x), np.nan)
        out[whole] = kernel(x[whole], points, held["gamma"][0].as_py()) @ beta + held["bias"][0].as_py()
        return out

    return met_by_experiment(library, models, features, keep, by, _MODEL_NAMES, work, bucket_rows=BUCKET_ROWS)

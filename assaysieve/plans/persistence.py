"""Save a trained screening as Parquet tables, and load it again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from assaysieve.operators import prepare as P
from assaysieve.operators.kernels import unpack
from assaysieve.plans.training import Best, Trained, Training
from assaysieve.sources.files import write_table

_BEST = (
    "target string, model string, fitted_as string, family string, train_r2 double, cv_r2 double, cv_rmse double, "
    "low double, high double, intercept double, weights array<double>, n int, m int, p int, points array<double>, dual array<double>, "
    "cover array<double>, amplitude double, gamma double, centre double, spread double"
)


def _preparation_json(p: P.Preparation) -> str:
    return json.dumps({
        "medians": p.imputer.medians, "modes": p.imputer.modes, "means": p.scaler.means, "deviations": p.scaler.deviations,
        "constant": p.scaler.constant, "numeric": p.numeric, "categorical": p.categorical, "squares": p.squares,
        "products": p.products, "selected": p.selected, "missing_groups": p.missing_groups,
    })


def _preparation(text: str) -> P.Preparation:
    d = json.loads(text)
    return P.Preparation(
        P.Imputer(d["medians"], d["modes"]), P.Scaler(d["means"], d["deviations"], tuple(d["constant"])),
        tuple(d["numeric"]), tuple(d["categorical"]), tuple(tuple(s) for s in d["squares"]),
        tuple(tuple(s) for s in d["products"]), tuple(d["selected"]), tuple(d["missing_groups"]),
    )


def save(trained: Trained, path: str) -> None:
    spark = trained.scores.sparkSession
    rows = []
    for i, (t, b) in enumerate(trained.best.items()):
        low, high = trained.bounds.get(t, (None, None))
        row = [t, b.model, b.fitted_as, b.family, b.train_r2, b.cv_r2, b.cv_rmse, low, high]
        intercept = weights = None
        kernel = [None] * 10
        if b.family == "linear":
            intercept, weights = float(b.parameters[0]), [float(w) for w in b.parameters[1]]
        elif b.family == "kernel":
            k = b.parameters
            cover = None if k["cover"] is None else k["cover"].ravel().tolist()
            kernel = [len(k["points"]), *k["points"].shape, k["points"].ravel().tolist(), k["dual"].tolist(), cover]
            kernel += [float(k[c]) for c in ("amplitude", "gamma", "centre", "spread")]
        else:
            write_table(b.parameters, f"{path}/models/{i}")
        rows.append([*row, intercept, weights, *kernel])
    write_table(spark.createDataFrame(rows, _BEST).coalesce(1), f"{path}/best")
    settings = [(trained.training.name, trained.strategy, trained.training.targets, _preparation_json(trained.training.preparation))]
    write_table(spark.createDataFrame(settings, "name string, strategy string, targets array<string>, preparation string"), f"{path}/settings")
    for part in ("scores", "oof", "measured"):
        write_table(getattr(trained, part), f"{path}/{part}")
    write_table(trained.training.frame, f"{path}/frame")


def load(spark: SparkSession, path: str) -> Trained:
    settings = spark.read.parquet(f"{path}/settings").first()
    best, bounds = {}, {}
    stored = {r["target"]: r for r in spark.read.parquet(f"{path}/best").collect()}
    order = [t for t in settings["targets"] if t in stored]
    for i, t in enumerate(order):
        r = stored[t]
        bounds[t] = (r["low"], r["high"])
        if r["family"] == "linear":
            parameters = (r["intercept"], list(r["weights"]))
        elif r["family"] == "kernel":
            parameters = unpack(r)
        else:
            parameters = spark.read.parquet(f"{path}/models/{i}")
        best[t] = Best(t, r["model"], r["fitted_as"], r["family"], r["train_r2"], r["cv_r2"], r["cv_rmse"], parameters)
    tables: dict[str, DataFrame] = {part: spark.read.parquet(f"{path}/{part}") for part in ("scores", "oof", "measured", "frame")}
    training = Training(tables["frame"], _preparation(settings["preparation"]), list(settings["targets"]), settings["name"], tables["frame"])
    return Trained(training, settings["strategy"], tables["scores"], tables["oof"], best, tables["measured"], bounds)

"""Whitening of embeddings by their leading principal components, found by Jacobi-Davidson without ever building the covariance.

The distinct vectors, as whole numbers, are packed into chunks and written once. Every product of the centred covariance with a few vectors is one job over these chunks, whose
tasks send sums of the size of those vectors only. On the driver there is a search space of at most `SPACE` vectors: Rayleigh-Ritz gives the wanted pairs,
and a few steps of MINRES, for all pairs together, solve each pair's projected correction equation. A pair whose residual is at rounding level is locked:
it stays in the space but gets no further corrections.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assaysieve.llm.vectors import narrowest, step_matrix, steps
from assaysieve.session import delete_paths, scratch_path

COMPONENTS = 4
GUARDS = 2  # further pairs kept in sight, so that none of the wanted is overlooked
SPACE = 40
INNER_STEPS = 6
ROUNDS = 300
CHUNK_VALUES = 1 << 18
EPS = float(np.finfo(np.float64).eps)


@dataclass
class Packed:
    """The fit list: chunks of distinct vectors, their number, exact sums by dimension and the centre."""

    chunks: DataFrame
    size: int
    n: int
    sums: list[int]
    centre: np.ndarray


def _pack(size: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_chunk = max(1, CHUNK_VALUES // size)
        for batch in batches:
            for at in range(0, batch.num_rows, per_chunk):
                rows = step_matrix(batch.column(0).slice(at, per_chunk), size)
                kind = narrowest(rows)
                yield pa.RecordBatch.from_pydict({"kind": [kind.str], "count": pa.array([len(rows)], pa.int32()), "data": [rows.astype(kind).tobytes()]})

    return pack


def _chunk_rows(batch: pa.RecordBatch, size: int) -> Iterator[np.ndarray]:
    for kind, data in zip(batch["kind"].to_pylist(), batch["data"], strict=True):
        yield np.frombuffer(data.as_buffer(), kind).reshape(-1, size)


def _summed(chunks: DataFrame, size: int, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum of `part` (as many numbers as `width`) over all chunks: one row per task and number, added up by place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            for rows in _chunk_rows(batch, size):
                total += part(rows)
        yield pa.RecordBatch.from_pydict({"place": np.arange(width, dtype=np.int32), "value": total})

    sums = chunks.select("kind", "data").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(width)
    out[sums["place"].to_numpy()] = sums["value"].to_numpy()
    return out


def _exact_sums(chunks: DataFrame, size: int) -> list[int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            for rows in _chunk_rows(batch, size):  # a chunk has less than 2^10 rows of entries up to 2^53, or shorter ones
                total = total + (rows.sum(0, dtype=np.int64) if rows.dtype.itemsize < 8 else rows.astype(object).sum(0))
        yield pa.RecordBatch.from_pydict({"place": np.arange(size, dtype=np.int32), "high": [int(t) >> 32 for t in total], "low": [int(t) & 0xFFFFFFFF for t in total]})

    sums = chunks.select("kind", "data").mapInArrow(run, "place int, high bigint, low bigint").groupBy("place").agg(
        F.sum(F.col("high").cast("decimal(38,0)")).alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    return [(int(r["high"]) << 32) + int(r["low"]) for r in sorted(sums, key=lambda r: r["place"])]


def products(packed: Packed) -> Callable[[np.ndarray], np.ndarray]:
    """The function from vectors (columns) to the covariance times these: one job, centred before multiplying."""

    def product(columns: np.ndarray) -> np.ndarray:
        centre = packed.centre

        def part(rows: np.ndarray) -> np.ndarray:
            centred = rows - centre
            return (centred.T @ (centred @ columns)).ravel()

        return _summed(packed.chunks, packed.size, part, columns.size).reshape(columns.shape) / packed.n

    return product


def _minres(apply: Callable[[np.ndarray], np.ndarray], sides: np.ndarray, inner_steps: int, least: float = 1e-3) -> np.ndarray:
    """Approximate solutions of symmetric, perhaps indefinite systems, one per column, all in the same products."""
    count = sides.shape[1]
    solution, old, first_way, second_way = (np.zeros_like(sides) for _ in range(4))
    start = np.linalg.norm(sides, axis=0)
    now, left, link = sides / np.where(start > 0, start, 1), start.copy(), np.zeros(count)
    cosines, sines = [np.ones(count)] * 2, [np.zeros(count)] * 2  # of the last rotation and the one before
    for _ in range(inner_steps):
        image = apply(now)
        diagonal = (now * image).sum(0)
        image = image - diagonal * now - link * old
        following = np.linalg.norm(image, axis=0)
        rotated = cosines[0] * diagonal - cosines[1] * sines[0] * link
        pivot = np.hypot(rotated, following)
        pivot = np.where(pivot > 0, pivot, 1)
        way = (now - sines[1] * link * first_way - (sines[0] * diagonal + cosines[1] * cosines[0] * link) * second_way) / pivot
        cosine, sine = rotated / pivot, following / pivot
        solution = solution + cosine * left * way
        left = -sine * left
        first_way, second_way = second_way, way
        cosines, sines = [cosine, cosines[0]], [sine, sines[0]]
        old, now, link = now, image / np.where(following > 0, following, 1), following
        if (np.abs(left) <= least * start).all():
            break
    return solution


def _orthonormal(columns: np.ndarray, space: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the space."""
    for _ in range(2):
        columns = columns - space @ (space.T @ columns)
        length = np.linalg.norm(columns, axis=0)
        columns = columns[:, length > 0] / length[length > 0]
    basis, triangle = np.linalg.qr(columns)
    basis = basis[:, np.abs(np.diag(triangle)) > 1e-8][:, :max(0, space.shape[0] - space.shape[1])]
    basis = basis - space @ (space.T @ basis)
    return np.linalg.qr(basis)[0]


def leading_pairs(product: Callable[[np.ndarray], np.ndarray], size: int, count: int, inner_steps: int = INNER_STEPS, space_limit: int = SPACE,
                  seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors (columns) of a symmetric matrix known by its products only.

    Ends when all residuals are at rounding level and one more round, with new random directions and corrections of the guard pairs, changed nothing.
    """
    rng = np.random.default_rng(seed)
    count = min(count, size)
    seen = min(size, count + GUARDS)
    space_limit = max(space_limit, 3 * seen)
    space = np.linalg.qr(rng.standard_normal((size, seen)))[0]
    images, confirmed = product(space), None
    for _ in range(ROUNDS):
        small = space.T @ images
        values, turns = np.linalg.eigh((small + small.T) / 2)
        values, turns = values[::-1], turns[:, ::-1]
        vectors = space @ turns[:, :seen]
        residuals = images @ turns[:, :seen] - vectors * values[:seen]
        length = np.linalg.norm(residuals, axis=0)
        level = 16 * np.sqrt(size) * EPS * max(abs(values[0]), np.finfo(float).tiny)
        done = bool((length[:count] <= level).all())
        if space.shape[1] == size or (done and confirmed is not None and np.allclose(confirmed, values[:count], rtol=0, atol=level)):
            return values[:count], vectors[:, :count]
        confirmed = values[:count] if done else None
        active = np.flatnonzero(length > level)
        if not done:
            active = active[active < count]
        if space.shape[1] + active.size + 1 > space_limit:
            space, images = space @ turns[:, :2 * seen], images @ turns[:, :2 * seen]

        def project(columns: np.ndarray, onto: np.ndarray = vectors) -> np.ndarray:
            return columns - onto @ (onto.T @ columns)

        def correction(columns: np.ndarray, shifts: np.ndarray = values[active]) -> np.ndarray:
            columns = project(columns)
            return project(product(columns) - columns * shifts)

        new = _minres(correction, -project(residuals[:, active]), inner_steps) if active.size else np.zeros((size, 0))
        if done:
            new = np.hstack([new, rng.standard_normal((size, 1))])
        added = _orthonormal(new, space)
        if not added.shape[1]:
            added = _orthonormal(rng.standard_normal((size, 1)), space)
        space, images = np.hstack([space, added]), np.hstack([images, product(added)])
    raise RuntimeError(f"residuals {length[:count]} did not reach {level}")


def _per_row(packed: Packed, scaled: np.ndarray):
    """Deviation and whitened entries of rows given as whole numbers. A deviation beyond 64 bits is null."""
    n, sums, centre, size = packed.n, packed.sums, packed.centre, packed.size
    sums_small = max(map(abs, sums), default=0) < 1 << 62

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            rows = step_matrix(column, size)
            most = n * int(np.abs(rows).max(initial=0)) + max(map(abs, sums), default=0)
            if sums_small and size * most * most < 1 << 63:
                deviation = ((n * rows - np.array(sums, np.int64)) ** 2).sum(1)
            else:
                exact = [sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows.tolist()]
                deviation = [e if e < 1 << 63 else None for e in exact]
            white = (rows - centre) @ scaled
            entries = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * scaled.shape[1], white.ravel())
            yield pa.StructArray.from_arrays([pa.array(deviation, pa.int64()), entries], ["deviation", "white"])

    return arrow_udf(run, returnType="deviation bigint, white array<double>")


def whiten(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component (from 1), n, deviation, whitened, explained and identity_error.

    Left out are rows whose vector is null, empty, has a null or non-finite entry, or another length than most rows (of equally common lengths the
    longest counts). The fit list holds each distinct vector of whole numbers floor(256 * c) once; covariances are over it, with divisor n. Every remaining row is
    returned, repeated ones and such without an id too. Components without variance (an eigenvalue at rounding level, as with one distinct
    vector) cannot be whitened and are left out; an empty table gives no rows. A deviation beyond 64 bits is null.
    """
    spark = vectors.sparkSession
    paths = [scratch_path(spark, "whitening-rows"), scratch_path(spark, "whitening-chunks")]
    vectors.select(F.col(vec_id).alias("vec_id"), steps(F.col(vector)).alias("s")).select("vec_id", "s.*").where("x is not null").write.parquet(paths[0])
    rows = spark.read.parquet(paths[0])
    common = rows.groupBy("size").count().agg(F.max_by("size", F.struct("count", "size"))).first()[0]
    none = rows.where("false").select("vec_id", F.lit(0).alias("component"), *(F.lit(0).cast(t).alias(c) for c, t in (
        ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))))
    if common is None:
        return none
    rows = rows.where(F.col("size") == common).select("vec_id", "x")
    rows.select("x").distinct().mapInArrow(_pack(common), "kind string, count int, data binary").write.parquet(paths[1])
    chunks = spark.read.parquet(paths[1]).persist(StorageLevel.MEMORY_AND_DISK)
    n = chunks.agg(F.sum("count")).first()[0]
    sums = _exact_sums(chunks, common)
    packed = Packed(chunks, common, n, sums, np.array([s / n for s in sums]))
    centre = packed.centre
    trace = _summed(chunks, common, lambda part: np.array([((part - centre) ** 2).sum()]), 1)[0] / n
    values, directions = leading_pairs(products(packed), common, components)
    real = values > common * EPS * trace
    values, directions = values[real], directions[:, real]
    scaled, k = directions / np.sqrt(values), int(real.sum())
    if not k:
        chunks.unpersist()
        return none

    def moments(part: np.ndarray) -> np.ndarray:
        white = (part - centre) @ scaled
        return np.concatenate([(white.T @ white).ravel(), white.sum(0)])

    moment = _summed(chunks, common, moments, k * k + k) / n
    identity_error = float(np.abs(moment[:k * k].reshape(k, k) - np.outer(moment[k * k:], moment[k * k:]) - np.eye(k)).max())
    chunks.unpersist()
    delete_paths(spark, paths[1:])
    told = rows.select("vec_id", _per_row(packed, scaled)(F.col("x")).alias("r")).select("vec_id", "r.deviation", F.posexplode("r.white").alias("place", "whitened"))
    shares = F.array(*[F.lit(float(v / trace)) for v in values])
    return told.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("place")).alias("explained"), F.lit(identity_error).alias("identity_error"))

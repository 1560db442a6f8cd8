"""2-D layout of the points of each role, and the geometry of its groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.vectors import lists, matrix, vector_sum
from ..session import lookup_join, materialize
from .topk import cut_at_rank


def role_moments(points: DataFrame) -> DataFrame:
    """Per task and role: row count, summed vectors, summed outer products (flattened)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, list] = {}
        for b in batches:
            if not b.num_rows:
                continue
            x, names = matrix(b.column(1)), np.asarray(b.column(0).to_pylist())
            for role in np.unique(names):
                mine = x[names == role]
                held = totals.setdefault(str(role), [0, 0.0, 0.0])
                held[0] += len(mine)
                held[1] = held[1] + mine.sum(axis=0)
                held[2] = held[2] + mine.T @ mine
        if totals:
            n, first, second = zip(*totals.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(totals)), pa.array(n), lists(np.stack(first)),
                    lists(np.stack([m.ravel() for m in second])),
                ],
                names=["role", "n", "first", "second"],
            )

    return points.select("role", "vec").mapInArrow(
        run, "role string, n long, first array<double>, second array<double>"
    )


def principal_axes(n: int, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mean and the two axes of most variance, each with its largest loading positive."""
    mean = first / n
    _, vectors = np.linalg.eigh(second.reshape(len(mean), -1) / n - np.outer(mean, mean))
    axes = np.zeros((2, len(mean)))
    for i, axis in enumerate(vectors.T[::-1][:min(2, n - 1)]):
        axes[i] = axis * np.sign(axis[np.argmax(np.abs(axis))])
    return mean, axes


def pca_layout(points: DataFrame) -> DataFrame:
    """I4: ``role, url_hash, vec`` to coordinates in [-1, 1], one principal plane per role."""
    return rescale(pca_plane(points))


def pca_plane(points: DataFrame) -> DataFrame:
    """``role, url_hash, x, y``: each role's points along its two axes of most variance.

    The second moments are summed per task, so a role of any size is laid out: what
    reaches the driver is one matrix per role, and the points are projected where
    they lie.
    """
    summed = role_moments(points).groupBy("role").agg(
        F.sum("n").alias("n"), vector_sum("first").alias("first"), vector_sum("second").alias("second")
    )
    planes = {
        r["role"]: principal_axes(r["n"], np.array(r["first"]), np.array(r["second"]))
        for r in summed.collect()
    }
    shared = points.sparkSession.sparkContext.broadcast(planes)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, names = matrix(b.column(2)), np.asarray(b.column(0).to_pylist())
            out = np.zeros((len(x), 2))
            for role in np.unique(names):
                mean, axes = shared.value[str(role)]
                mine = names == role
                out[mine] = (x[mine] - mean) @ axes.T
            cells = [b.column(0), b.column(1), pa.array(out[:, 0]), pa.array(out[:, 1])]
            yield pa.RecordBatch.from_arrays(cells, names=["role", "url_hash", "x", "y"])

    plane = points.select("role", "url_hash", "vec").mapInArrow(
        project, "role string, url_hash long, x double, y double"
    )
    return materialize(plane)


def axis_bounds(plane: DataFrame) -> DataFrame:
    """E8."""
    return plane.groupBy("role").agg(
        F.min("x").alias("min_x"), F.max("x").alias("max_x"),
        F.min("y").alias("min_y"), F.max("y").alias("max_y"),
    )


def rescale(plane: DataFrame, bounded: bool = False) -> DataFrame:
    """each axis to [-1, 1] per role; a flat axis stays as it is.

    The bounds are joined back, so a role of any size stays spread; for roles
    known to be ``bounded`` a window spares the second pass over the input.
    """

    def scaled(c: str):
        low, span = F.col(f"min_{c}"), F.col(f"max_{c}") - F.col(f"min_{c}")
        moved = (F.col(c) - low) * 2 / span - 1
        return F.round(
            F.when(span > fv.MIN_SPAN, moved).otherwise(F.col(c)), fv.COORDINATE_DIGITS
        )

    if bounded:
        role = Window.partitionBy("role")
        with_bounds = plane.withColumns({
            f"{f.__name__}_{c}": f(c).over(role) for f in (F.min, F.max) for c in ("x", "y")
        })
    else:
        with_bounds = lookup_join(plane, axis_bounds(plane), ["role"], "inner")
    return with_bounds.select(
        *[c for c in plane.columns if c not in ("x", "y")],
        scaled("x").alias("x"), scaled("y").alias("y"),
    )


def group_core(points: DataFrame, share: float = fv.CORE_SHARE) -> DataFrame:
    """Per group its centroid and the nearest ``floor(share * n)`` points.

    ``points`` is ``role, grp, url_hash, x, y``; groups of fewer than three are
    skipped.  Groups are the legend's, a handful per role.
    """
    centers = materialize(
        points.groupBy("role", "grp").agg(
            F.avg("x").alias("cx"), F.avg("y").alias("cy"), F.count("*").alias("n")
        ).filter(F.col("n") >= fv.MIN_HULL_POINTS)
        .withColumn("_group", F.concat_ws("\u0001", "role", "grp"))
    )
    placed = lookup_join(points, centers, ["role", "grp"], "inner").withColumn(
        "distance",
        F.round(F.sqrt(F.pow(F.col("x") - F.col("cx"), 2) + F.pow(F.col("y") - F.col("cy"), 2)), 9),
    ).withColumn("_near", -F.col("distance"))
    widths = {r["_group"]: int(np.floor(r["n"] * share)) for r in centers.collect()}
    if not widths:
        return placed.select("role", "grp", "url_hash", "x", "y", "cx", "cy")
    reach = placed.agg(F.max("distance")).first()[0]
    core = cut_at_rank(
        placed, "_group", "_near", "url_hash", widths, low=-(reach + fv.MIN_SPAN), high=0.0
    )
    return core.select("role", "grp", "url_hash", "x", "y", "cx", "cy")


def _hull(pdf: pd.DataFrame) -> pd.DataFrame:
    points = sorted(set(zip(pdf["x"], pdf["y"])))

    def chain(sequence: list) -> list:
        out: list = []
        for x, y in sequence:
            while len(out) > 1:
                (ax, ay), (bx, by) = out[-2:]
                if (bx - ax) * (y - ay) - (by - ay) * (x - ax) > 0:
                    break
                out.pop()
            out.append((x, y))
        return out[:-1]

    ring = chain(points) + chain(points[::-1]) if len(points) > 2 else points
    return pd.DataFrame({
        "role": pdf["role"].iloc[0], "grp": pdf["grp"].iloc[0],
        "vertex": range(1, len(ring) + 1),
        "x": [p[0] for p in ring], "y": [p[1] for p in ring],
    })


def group_hull(core: DataFrame, slice_rows: int = 10_000) -> DataFrame:
    """Convex hull of each core of at least three points, counter-clockwise.

    The hull of a group is the hull of its slices' hulls, so a group of more than
    ``slice_rows`` points is never handed to one call.
    """
    size = core.groupBy("role", "grp").agg(F.count("*").alias("_n"))
    usable = lookup_join(
        core.select("role", "grp", "x", "y"), size.filter(F.col("_n") >= fv.MIN_HULL_POINTS),
        ["role", "grp"], "inner",
    )
    schema = "role string, grp string, vertex int, x double, y double"
    slices = F.ceil(F.col("_n") / slice_rows)
    slice_ = F.pmod(F.xxhash64("x", "y"), slices).alias("_slice")
    parts = usable.groupBy("role", "grp", slice_).applyInPandas(_hull, schema)
    return parts.groupBy("role", "grp").applyInPandas(_hull, schema)

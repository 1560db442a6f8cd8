"""Neighborhoods as one JSON object per role."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.neighborhood import Neighborhood


def _list(df: DataFrame, name: str, order: str, columns: list[str]) -> DataFrame:
    rows = F.sort_array(F.collect_list(F.struct(order, *columns)))
    slim = F.transform(rows, lambda r: F.struct(*[r[c].alias(c) for c in columns]))
    return df.groupBy("role").agg(slim.alias(name))


def neighborhood_json(found: Neighborhood) -> DataFrame:
    """The payload of each role; every list in it is bounded by the job's settings."""
    legend = found.legend
    entry: Column = F.struct("legend_order", "grp", "n", "color")
    entries = legend.groupBy("role").agg(F.sort_array(F.collect_list(entry)).alias("_legend"))

    def mapped(value: str) -> Column:
        return F.map_from_entries(
            F.transform("_legend", lambda e: F.struct(e["grp"], e[value]))
        )

    # A group may share the label's name; the first (the center) keeps the entry.
    entries = entries.withColumn(
        "_legend",
        F.filter(
            "_legend",
            lambda e: (e["legend_order"] == 1) | (e["grp"] != F.element_at("_legend", 1)["grp"]),
        ),
    ).select("role", mapped("n").alias("group_counts"), mapped("color").alias("colors"))
    points = _list(
        found.points.withColumnRenamed("grp", "group"), "points", "url_hash",
        ["x", "y", "title", "company", "group", "url"],
    )
    panel = ["title", "company", "sim"]
    out = found.descriptions
    for part in [
        points, entries, _list(found.farthest, "farthest", "position", panel),
        _list(found.also_near(), "also_near", "position", panel),
    ]:
        out = out.join(part, "role", "left")
    empty = F.array().cast("array<struct<title:string,company:string,sim:double>>")
    return out.withColumns({
        "farthest": F.coalesce("farthest", empty), "also_near": F.coalesce("also_near", empty),
    })


def export_neighborhood(found: Neighborhood, path: str) -> None:
    """A11."""
    neighborhood_json(found).write.mode("overwrite").json(path)

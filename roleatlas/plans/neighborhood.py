"""All roles' neighborhoods in one job; ``role`` is a key column."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.titles import (
    group_contains_any, has_title, normalize_title, plausible_title, title_like_any,
)
from ..functions.regex import bind, text
from ..functions.vectors import apply_transform, centroid_scores, role_sums, vector_sum
from ..operators import layout, panels
from ..operators.key_filter import filtered, join_keys
from ..operators.topk import WINDOW_ROWS, cut_at_rank, top_k
from ..operators.wide_scores import above_cut, lowest
from ..session import materialize


@dataclass(frozen=True)
class Role:
    key: str
    label: str
    patterns: tuple[str, ...]


BUILTIN_ROLES = [Role(k, label, tuple(p)) for k, label, p in fv.BUILTIN_ROLES]


ROLE_SPEC = re.compile(r"(?P<key>[^:]*):(?P<label>[^:]*):(?P<patterns>.*)", re.DOTALL)
# What stands between bars, without blanks at its ends.
PATTERN_LIST = re.compile(r"[^|\s](?:[^|]*[^|\s])?")


def parse_role(spec: str) -> Role:
    """A custom role written ``key:label:pattern1|pattern2``."""
    found = ROLE_SPEC.fullmatch(spec)
    patterns = PATTERN_LIST.findall(found["patterns"].lower()) if found else []
    if not patterns:
        raise ValueError(f"a role is 'key:label:pattern1|pattern2' with a pattern at least, not {spec!r}")
    return Role(found["key"], found["label"], tuple(patterns))


def roles_of(title: Column, roles: list[Role]) -> Column:
    """The roles whose center a listing belongs to, as an array.

    The roles are a short driver-side list, so the theta match is an expression
    on the scanned rows rather than a join.  The title is normalised only for
    rows that pass some loose match.
    """
    loose = [title_like_any(title, list(r.patterns)) for r in roles]
    any_loose = title_like_any(title, [p for r in roles for p in r.patterns])

    def strict(group: Column) -> Column:
        hits = [
            F.when(c & group_contains_any(group, list(r.patterns)), F.lit(r.key))
            for c, r in zip(loose, roles)
        ]
        return F.array_compact(F.array(*hits))

    return F.when(any_loose, bind(normalize_title(title), strict)).otherwise(
        F.array().cast("array<string>")
    )


def role_labels(roles: list[Role]) -> Column:
    """The label of column ``role``."""
    pairs = [F.lit(x) for r in roles for x in (r.key, r.label)]
    return F.element_at(F.create_map(*pairs), F.col("role"))


def find_center(
    listings: DataFrame, roles: list[Role], tags: Column | None = None
) -> DataFrame:
    """Center listings per role, before they meet their vectors."""
    tags = roles_of(F.col("title"), roles) if tags is None else tags
    titled = listings.filter(has_title(F.col("title"), F.col("is_active")))
    return titled.select("url_hash", "title", "company", "url", F.explode(tags).alias("role"))


def find_centroids(
    center: DataFrame, vectors: DataFrame, w: np.ndarray | None = None
) -> DataFrame:
    """Per role its size, raw and deconfounded centroid, both of unit length.

    A Bloom filter of the center's keys is applied where the vectors are scanned, so only
    vectors of the center are exchanged, whatever its size.
    """
    keys = materialize(center.select("url_hash", "role"))
    both = join_keys(vectors.select("url_hash", "role_vec"), keys)
    sums = role_sums(both, w).groupBy("role").agg(
        F.sum("n").alias("n"), vector_sum("raw").alias("_raw"), vector_sum("clean").alias("_clean")
    )

    def unit(c: str) -> Column:
        # The sum divided by n, then by its length and the guard.
        norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x)) / F.col("n")
        return F.transform(c, lambda x: x / F.col("n") / (norm + fv.NORM_EPSILON))

    return sums.select(
        "role", "n", unit("_raw").alias("raw_centroid"), unit("_clean").alias("clean_centroid")
    )


def per_role(wide: DataFrame, keys: list[str]) -> DataFrame:
    """D11 written out, one row per listing and role; no step of a neighborhood needs it."""
    named = [
        F.struct(
            F.lit(k).alias("role"), F.get("raw_scores", i).alias("raw_score"),
            F.get("clean_scores", i).alias("clean_score"),
        )
        for i, k in enumerate(keys)
    ]
    return wide.select("url_hash", "center_of", "plain", F.inline(F.array(*named)))


@dataclass
class Neighborhood:
    """The neighborhoods of all roles that have a center.

    ``neighbors`` holds at most ``n`` rows per role and is written out, so the
    panels below read it rather than the corpus.
    """

    roles: list[Role]
    center: DataFrame
    centroids: DataFrame
    neighbors: DataFrame
    wide: DataFrame | None
    found: list[str]
    texts: DataFrame | None
    candidates: DataFrame | None
    vectors: DataFrame
    w: np.ndarray | None
    n: int
    settings: dict

    @cached_property
    def groups(self) -> DataFrame:
        return panels.group_counts(
            self.neighbors, self.settings["min_group_size"], self.settings["max_groups"]
        )

    @cached_property
    def center_sample(self) -> DataFrame:
        """At most MAX_CENTER_DOTS rows per role."""
        return materialize(
            panels.center_sample(self.center, self.settings["max_center_dots"])
        )

    @property
    def legend(self) -> DataFrame:
        return panels.legend(self.groups, self.center_sample, role_labels(self.roles))

    def also_near(self, exclude_named_groups: bool = True) -> DataFrame:
        return panels.also_near(
            self.neighbors, self.groups, exclude_named_groups=exclude_named_groups
        )

    @property
    def scored(self) -> DataFrame:
        """Both scores of every searchable listing for every role."""
        return per_role(self.wide, self.found)

    @property
    def farthest(self) -> DataFrame:
        if self.wide is None:
            return self.also_near().limit(0)
        return panels.farthest(lowest(self.wide, self.found, fv.FARTHEST_POOL), self.texts)

    @cached_property
    def viz(self) -> DataFrame:
        """Rows to draw: at most MAX_CENTER_DOTS + n per role."""
        return materialize(
            panels.viz_set(
                self.center_sample, self.neighbors, self.groups, role_labels(self.roles)
            )
        )

    @cached_property
    def points(self) -> DataFrame:
        """H1 with I4: coordinates, title, company, display group and link."""
        keys = self.viz.select("role", "url_hash")
        drawn = join_keys(self.vectors.select("url_hash", "role_vec"), keys)
        placed = layout.pca_layout(apply_transform(drawn, self.w, "role_vec", "vec"))
        return self.viz.join(placed, ["role", "url_hash"]).select(
            "role", "url_hash", "x", "y", "title", text(F.col("company")).alias("company"),
            "grp", text(F.col("url")).alias("url"), "is_center",
        )

    @property
    def descriptions(self) -> DataFrame:
        label = role_labels(self.roles)
        return self.centroids.select(
            "role", label.alias("label"),
            F.concat(
                F.lit(f"{self.n} nearest positions to "), label, F.lit(", grouped by title")
            ).alias("description"),
        )


def find_neighborhood(
    listings: DataFrame, vectors: DataFrame, roles: list[Role] | None = None,
    n: int = fv.NEIGHBORS, w: np.ndarray | None = None,
    prefetch_factor: int = fv.PREFETCH_FACTOR, prefetch_extra: int = fv.PREFETCH_EXTRA,
    min_group_size: int = fv.MIN_GROUP_SIZE, max_groups: int = fv.MAX_GROUPS,
    max_center_dots: int = fv.MAX_CENTER_DOTS, candidate_filter: Column | None = None,
    co_located: bool = False,
) -> Neighborhood:
    """J7.  Two passes over the vectors, whatever the number of roles.

    Pass 1 reads the center vectors and yields one centroid pair per role, the
    only thing that reaches the driver.  Pass 2 scores every vector against all
    centroids and drops it; one row per listing holds its scores for all roles, and
    kernels give the roles' histograms, then the rows above each role's cut.  If
    both tables are bucketed by ``url_hash``, say ``co_located``: the join then
    comes first, needs no exchange, and only rows that join are scored.  A
    ``candidate_filter`` on the listings applies before the prefetch, never after.
    """
    roles = roles or BUILTIN_ROLES
    settings = {
        "min_group_size": min_group_size, "max_groups": max_groups,
        "max_center_dots": max_center_dots,
    }
    tags = roles_of(F.col("title"), roles)
    tagged = materialize(find_center(listings, roles, tags))
    # One row per role.
    found = sorted(find_centroids(tagged, vectors, w).collect(), key=lambda r: r["role"])
    centroids = listings.sparkSession.createDataFrame(
        found, "role string, n long, raw_centroid array<double>, clean_centroid array<double>"
    )
    # Center listings that have a vector.
    embedded = filtered(vectors.select("url_hash"), tagged, "url_hash")
    center = materialize(tagged.join(embedded, "url_hash", "left_semi"))
    if not found:
        empty = center.select(
            "role", "url_hash", "title", "company", "url", F.lit("").alias("grp"),
            F.lit(0.0).alias("sim"), F.lit(0).alias("rank"),
        )
        return Neighborhood(roles, center, centroids, empty, None, [], None, None, vectors, w, n, settings)

    keys = [r["role"] for r in found]
    raw = np.array([r["raw_centroid"] for r in found])
    clean = np.array([r["clean_centroid"] for r in found])
    titled = listings.filter(has_title(F.col("title"), F.col("is_active")))
    if candidate_filter is not None:
        titled = titled.filter(candidate_filter)
    # Scores and flags of all rows are written; text is fetched for the few rows that are chosen.
    texts = titled.select("url_hash", "title", "company", "url")
    plain = plausible_title(F.col("title"), F.col("company")).alias("plain")
    titled = titled.select("url_hash", tags.alias("center_of"), plain)
    held = vectors.select("url_hash", "role_vec")
    if co_located:
        joined = centroid_scores(titled.join(held, "url_hash"), raw, clean, w)
    else:
        joined = titled.join(centroid_scores(held, raw, clean, w), "url_hash")
    wide = materialize(joined)
    widths = {
        r["role"]: max(n * prefetch_factor, n + r["n"] + prefetch_extra) for r in found
    }
    above = materialize(above_cut(wide, keys, widths))
    chosen = materialize(cut_at_rank(above, "role", "raw_score", "url_hash", widths))
    candidates = chosen.join(texts, "url_hash")
    # Whether a candidate is a center follows from its title, so no anti-join.
    in_center = F.array_contains("center_of", F.col("role"))
    others = (
        candidates.filter(~in_center)
        .withColumn("grp", normalize_title(F.col("title"))).filter("grp IS NOT NULL")
    )
    ranked = top_k(
        others, ["role"], [F.col("clean_score").desc(), F.col("url_hash")], n,
        bounded=max(widths.values()) <= WINDOW_ROWS,
    )
    neighbors = materialize(
        ranked.select(
            "role", "url_hash", "title", "company", "url", "grp",
            F.col("clean_score").alias("sim"), "rank",
        )
    )
    return Neighborhood(
        roles, center, centroids, neighbors, wide, keys, texts, candidates, vectors, w, n, settings
    )


"""Neighborhoods against a numpy brute force, and their invariants."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleatlas import schemas
from roleatlas.catalog import views as V
from roleatlas.operators import layout, panels
from roleatlas.operators import topk
from roleatlas.plans import neighborhood as NB
from roleatlas.plans.neighborhood import BUILTIN_ROLES, Role, find_neighborhood, parse_role
from roleatlas.sources.export import neighborhood_json

SETTINGS = {"n": 40, "prefetch_extra": 0, "prefetch_factor": 1, "min_group_size": 3}


@pytest.fixture(scope="module")
def tables(spark, sf):
    v2 = V.role_listings(spark, sf)
    return V.listings_of(v2), V.vectors_of(v2)


@pytest.fixture(scope="module")
def corpus(tables):
    listings, vectors = tables
    pdf = listings.join(vectors, "url_hash").toPandas().sort_values("url_hash")
    return pdf[pdf.is_active]


def brute(corpus, needle, n, w, extra=0):
    x = np.stack(corpus.role_vec).astype(float)

    def unit(a):
        return a / (np.linalg.norm(a, axis=-1, keepdims=True) + 1e-10)

    center = np.array([needle in t.lower() for t in corpus.title])
    clean = unit(x if w is None else x @ w)
    raw = unit(x) @ unit(x[center].mean(axis=0))
    keys = corpus.url_hash.to_numpy()
    width = max(n, n + center.sum() + extra)
    pool = np.lexsort((keys, -np.round(raw, 10)))[:width]
    pool = pool[~center[pool]]
    sim = clean @ unit(clean[center].mean(axis=0))
    best = pool[np.lexsort((keys[pool], -np.round(sim[pool], 10)))][:n]
    return [int(k) for k in keys[best]]


def ranked(found, role):
    rows = found.neighbors.filter(F.col("role") == role).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    return [r["url_hash"] for r in rows]


@pytest.mark.parametrize("with_w", [False, True])
def test_matches_brute_force(tables, corpus, with_w):
    w = np.random.default_rng(3).normal(size=(64, 64)) if with_w else None
    found = find_neighborhood(*tables, w=w, **SETTINGS)
    for role in ("ds", "pm", "ai"):
        label = next(r.patterns[0] for r in BUILTIN_ROLES if r.key == role)
        assert ranked(found, role) == brute(corpus, label, 40, w)


def test_ranks_do_not_depend_on_the_layout(spark, tables, monkeypatch):
    roles = BUILTIN_ROLES[:2]
    one = find_neighborhood(*tables, roles=roles, **SETTINGS)
    # Other partitioning, and the paths for groups that are too large for a window.
    monkeypatch.setattr(NB, "WINDOW_ROWS", 0)
    monkeypatch.setattr(topk.cut_at_rank, "__defaults__", (-1.0, 1.0, 0))
    spread = [t.repartition(13) for t in tables]
    two = find_neighborhood(*spread, roles=roles, **SETTINGS)
    for role in roles:
        assert ranked(one, role.key) == ranked(two, role.key)


def test_exact_copies_tie_by_key(spark):
    vectors = [(i, [1.0, 0.0] if i < 3 else ([0.6, 0.8] if i < 30 else [0.0, 1.0])) for i in range(60)]
    listings = spark.createDataFrame(
        [(i, f"u{i}", "Data Scientist" if i < 3 else "Data Engineer", "acme", True) for i in range(60)],
        "url_hash long, url string, title string, company string, is_active boolean",
    )
    found = find_neighborhood(
        listings.repartition(5), spark.createDataFrame(vectors, schemas.VECTORS).repartition(7),
        roles=BUILTIN_ROLES[:1], **{**SETTINGS, "n": 10},
    )
    assert ranked(found, "ds") == list(range(3, 13))


def test_empty_center_and_no_candidates(spark, tables):
    nobody = Role("x", "Nobody", ("no such role",))
    found = find_neighborhood(*tables, roles=[nobody], **SETTINGS)
    assert found.neighbors.count() == 0 and found.legend.count() == 0 and found.points.count() == 0
    assert found.farthest.count() == 0 and found.also_near().count() == 0
    both = find_neighborhood(*tables, roles=[nobody, BUILTIN_ROLES[0]], **SETTINGS)
    assert {r["role"] for r in both.neighbors.select("role").distinct().collect()} == {"ds"}
    listings, vectors = tables
    alone = listings.filter(F.lower("title").contains("data scientist"))
    lonely = find_neighborhood(alone, vectors, roles=BUILTIN_ROLES[:1], **SETTINGS)
    assert lonely.neighbors.count() == 0 and lonely.points.count() == lonely.center.count() > 0


def test_points_and_export(tables, tmp_path):
    found = find_neighborhood(*tables, roles=BUILTIN_ROLES[:2], max_center_dots=5, **SETTINGS)
    points = found.points.toPandas()
    assert (points.groupby("role").is_center.sum() == 5).all()
    assert points[["x", "y"]].abs().max().max() <= 1
    for _, p in points.groupby("role"):
        assert (p[["x", "y"]].max() == 1).all() and (p[["x", "y"]].min() == -1).all()
    for line in neighborhood_json(found).toJSON().collect():
        o = json.loads(line)
        assert o["group_counts"][o["label"]] == 5 and o["colors"][o["label"]] == "#2d5a34"
        assert len(o["points"]) == sum(o["group_counts"].values()) and len(o["farthest"]) == 5
        assert [p["sim"] for p in o["farthest"]] == sorted(p["sim"] for p in o["farthest"])


def test_custom_roles():
    assert parse_role("sre:Site Reliability:SRE| site reliability |") == Role("sre", "Site Reliability", ("sre", "site reliability"))
    for bad in ("a:b", "a:b: | "):
        with pytest.raises(ValueError):
            parse_role(bad)


def test_groups_prefer_the_first_seen_on_ties(spark):
    rows = [("r", g, i + 1, 0.5) for i, g in enumerate("bbaaccb" + "d")]
    groups = panels.group_counts(spark.createDataFrame(rows, "role string, grp string, rank int, sim double"), 2, 2)
    assert [(r["grp"], r["n"]) for r in groups.orderBy("position").collect()] == [("b", 3), ("a", 2)]


def test_colors_wrap(spark):
    rows = [("r", "me", 3, 0, True)] + [("r", f"g{i:02d}", 20 - i, i, False) for i in range(1, 19)]
    colored = panels.assign_colors(spark.createDataFrame(rows, "role string, grp string, n long, position int, is_center boolean"))
    color = {r["grp"]: r["color"] for r in colored.collect()}
    assert color["me"] == color["g17"] == "#2d5a34" and color["g01"] == color["g18"] == "#d94f1a"


def test_hull_and_flat_axis(spark):
    square = [("r", "g", i, x, y) for i, (x, y) in enumerate([(0., 0.), (2., 0.), (2., 2.), (0., 2.), (1., 1.), (1., 0.)])]
    two = [("r", "h", 10 + i, float(i), 0.0) for i in range(2)]
    frame = spark.createDataFrame(square + two, "role string, grp string, url_hash long, x double, y double")
    hull = layout.group_hull(frame).orderBy("grp", "vertex").collect()
    assert [(r["x"], r["y"]) for r in hull] == [(0., 0.), (2., 0.), (2., 2.), (0., 2.)]
    sliced = layout.group_hull(frame, slice_rows=2).orderBy("grp", "vertex").collect()
    assert sliced == hull
    flat = layout.rescale(frame.withColumn("y", F.lit(5.0)))
    assert {r["y"] for r in flat.collect()} == {5.0}
    assert sorted(flat.collect()) == sorted(layout.rescale(frame.withColumn("y", F.lit(5.0)), bounded=True).collect())
    core = layout.group_core(frame).collect()
    assert len(core) == 5 and all(r["grp"] == "g" for r in core)

"""Queries for neighborhoods (D6-D11, E4-E11, F, G, H, J7) and the model (I)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions.titles import shares_words
from ..functions.vectors import apply_transform
from ..operators import deconfound as D
from ..operators import layout
from ..operators.topk import global_rank
from ..plans.neighborhood import find_center, find_centroids, find_neighborhood, BUILTIN_ROLES
from ..session import scratch_path
from ..sources.export import export_neighborhood
from . import sql as S
from . import views as V
from .registry import registry
from .text_queries import PANEL, PLAUSIBLE, ROLES_SQL
from .views import with_views

add = registry.add
col = F.col

# Test vectors are few, so both top-k stages are narrowed until they bind.
N, EXTRA, MIN_GROUP = 60, 0, 3


def neighborhood(spark, d, **settings):
    v2 = V.role_listings(spark, d)
    return find_neighborhood(
        V.listings_of(v2), V.vectors_of(v2), n=N, prefetch_extra=EXTRA, prefetch_factor=1,
        min_group_size=MIN_GROUP, **settings,
    )


def _unit(v: str) -> str:
    return f"list_transform({v}, lambda x: x::DOUBLE / (sqrt(list_sum(list_transform({v}, lambda y: y::DOUBLE * y::DOUBLE))) + 1e-10))"


PARTS = {
    "titles": "SELECT title FROM v2",
    **S.norm_parts("titles"),
    "roles": ROLES_SQL,
    "titled": "SELECT v2.*, grp FROM v2 JOIN norm USING (title) WHERE is_active AND title <> ''",
    "center": """SELECT role, roles.label AS role_label, t.* EXCLUDE (label) FROM titled t, roles
        WHERE len(list_filter(variants, lambda p: lower(title) LIKE '%' || p || '%')) > 0
        AND len(list_filter(patterns, lambda p: contains(lower(coalesce(grp, '')), p))) > 0""",
    "sums": f"""SELECT role, i, avg(x) AS raw, avg(u) AS clean FROM (
        SELECT role, generate_subscripts(role_vec, 1) AS i, unnest(role_vec)::DOUBLE AS x,
        unnest({_unit('role_vec')}) AS u FROM center) GROUP BY role, i""",
    "means": """SELECT role, list(raw ORDER BY i) AS raw, list(clean ORDER BY i) AS clean FROM sums GROUP BY role""",
    "centroids": f"SELECT role, n, {_unit('raw')} AS raw, {_unit('clean')} AS clean "
                 "FROM means JOIN (SELECT role, count(*) AS n FROM center GROUP BY role) USING (role)",
    "scored": f"""SELECT role, n, url_hash, title, company, url, grp,
        round(list_dot_product({_unit('role_vec')}, raw), 10) AS raw_score,
        round(list_dot_product({_unit('role_vec')}, clean), 10) AS clean_score FROM titled, centroids""",
    "placed": "SELECT *, row_number() OVER (PARTITION BY role ORDER BY raw_score DESC, url_hash) AS place FROM scored",
    "candidates": f"SELECT * FROM placed WHERE place <= greatest({N}, {N} + n + {EXTRA})",
    "others": """SELECT * FROM candidates c WHERE grp IS NOT NULL
        AND NOT EXISTS (SELECT 1 FROM center x WHERE x.role = c.role AND x.url_hash = c.url_hash)""",
    "neighbors": f"""SELECT * FROM (SELECT *, clean_score AS sim,
        row_number() OVER (PARTITION BY role ORDER BY clean_score DESC, url_hash) AS rank FROM others) WHERE rank <= {N}""",
    "counted": f"""SELECT role, grp, count(*) AS n, min(rank) AS first_rank, avg(sim) AS mean_sim FROM neighbors
        GROUP BY role, grp HAVING count(*) >= {MIN_GROUP}""",
    "groups": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY n DESC, first_rank) AS position
        FROM counted) WHERE position <= 12""",
}


def atlas_sql(body: str, **more: str) -> str:
    return with_views(["v2"], body, **PARTS, **more)


@add(
    "j7_neighbors",
    atlas_sql("SELECT role, url_hash, title, company, url, grp, round(sim, 4) AS sim, rank FROM neighbors"),
)
def j7(spark, d):
    """The re-ranked neighbors of all roles."""
    found = neighborhood(spark, d).neighbors
    return found.select(
        "role", "url_hash", "title", "company", "url", "grp", F.round("sim", 4).alias("sim"),
        col("rank").cast("long").alias("rank"),
    )


@add("j7_neighbors_located", atlas_sql(
    "SELECT role, url_hash, round(sim, 4) AS sim, rank FROM neighbors",
).replace(
    "FROM titled, centroids", "FROM titled, centroids WHERE company IN ('company1', 'company2', 'company3')"
))
def j7_located(spark, d):
    """A user's filter narrows the corpus before the prefetch, not after it."""
    wanted = col("company").isin("company1", "company2", "company3")
    found = neighborhood(spark, d, candidate_filter=wanted).neighbors
    return found.select(
        "role", "url_hash", F.round("sim", 4).alias("sim"), col("rank").cast("long").alias("rank")
    )


@add("d10_role_title", atlas_sql("SELECT role, url_hash, title FROM center"))
def d10(spark, d):
    center = find_center(V.listings_of(V.role_listings(spark, d)), BUILTIN_ROLES)
    return center.select("role", "url_hash", "title")


@add(
    "e4_centroids",
    atlas_sql("""SELECT role, n, unnest(generate_series(1, len(raw))) AS i,
        round(unnest(raw), 6) AS raw, round(unnest(clean), 6) AS clean FROM centroids"""),
)
def e4(spark, d):
    v2 = V.role_listings(spark, d)
    found = find_centroids(find_center(V.listings_of(v2), BUILTIN_ROLES), V.vectors_of(v2))
    pairs = F.arrays_zip("raw_centroid", "clean_centroid")
    return found.select("role", "n", F.posexplode(pairs).alias("i", "p")).select(
        "role", "n", (col("i") + 1).cast("long").alias("i"),
        F.round("p.raw_centroid", 6).alias("raw"), F.round("p.clean_centroid", 6).alias("clean"),
    )


@add(
    "d11_centroid_scores",
    atlas_sql("SELECT role, url_hash, round(raw_score, 5) AS raw_score, round(clean_score, 5) AS clean_score FROM scored"),
)
def d11(spark, d):
    return neighborhood(spark, d).scored.select(
        "role", "url_hash", F.round("raw_score", 5).alias("raw_score"),
        F.round("clean_score", 5).alias("clean_score"),
    )


@add("g1_prefetch", atlas_sql("SELECT role, url_hash, round(raw_score, 5) AS raw_score FROM candidates"))
def g1(spark, d):
    return neighborhood(spark, d).candidates.select(
        "role", "url_hash", F.round("raw_score", 5).alias("raw_score")
    )


@add("d6_without_center", atlas_sql("""SELECT role, url_hash FROM candidates c WHERE NOT EXISTS
    (SELECT 1 FROM center x WHERE x.role = c.role AND x.url_hash = c.url_hash)"""))
def d6(spark, d):
    found = neighborhood(spark, d)
    keys = found.candidates.select("role", "url_hash")
    return keys.join(found.center.select("role", "url_hash"), ["role", "url_hash"], "left_anti")


@add(
    "e5_group_counts",
    atlas_sql("SELECT role, grp, n, first_rank, round(mean_sim, 4) AS mean_sim, position FROM groups"),
)
def e5(spark, d):
    """E5, E6, G3."""
    return neighborhood(spark, d).groups.select(
        "role", "grp", "n", col("first_rank").cast("long").alias("first_rank"),
        F.round("mean_sim", 4).alias("mean_sim"), col("position").cast("long").alias("position"),
    )


@add(
    "d7_legend_neighbors",
    atlas_sql("SELECT role, url_hash, grp FROM neighbors SEMI JOIN groups USING (role, grp)"),
)
def d7(spark, d):
    found = neighborhood(spark, d)
    return found.viz.filter(~col("is_center")).select("role", "url_hash", "grp")


@add(
    "g7_legend",
    atlas_sql(f"""SELECT role, grp, n, is_center, slot, ({S.sql_list(fv.PALETTE)})[slot % 17 + 1] AS color,
        row_number() OVER (PARTITION BY role ORDER BY is_center DESC, n DESC, slot) AS legend_order FROM entries""",
        entries="""SELECT role, role_label AS grp, least(count(*), 200) AS n, true AS is_center, 0 AS slot
            FROM center GROUP BY role, role_label UNION ALL
            SELECT role, grp, n, false, position FROM groups"""),
)
def g7(spark, d):
    """B22, F5, G7."""
    rows = neighborhood(spark, d).legend
    return rows.withColumns({c: col(c).cast("long") for c in ("n", "slot", "legend_order")})


ALSO = """SELECT role, row_number() OVER (PARTITION BY role ORDER BY rank) AS position, title, company,
    round(sim, 4) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY role, lower(grp) ORDER BY rank) AS k
    FROM neighbors n WHERE {panel} {named}) WHERE k = 1"""
_NAMED = "AND NOT EXISTS (SELECT 1 FROM groups g WHERE g.role = n.role AND lower(g.grp) = lower(n.grp))"


@add("g5_also_near", atlas_sql("SELECT * FROM also WHERE position <= 20", also=ALSO.format(panel=PANEL, named=_NAMED)))
def g5(spark, d):
    """F2, G5."""
    found = neighborhood(spark, d).also_near()
    return found.withColumn("position", col("position").cast("long"))


@add(
    "g5_also_near_all_groups",
    atlas_sql("SELECT * FROM also WHERE position <= 20", also=ALSO.format(panel=PANEL, named="")),
)
def g5_all(spark, d):
    found = neighborhood(spark, d).also_near(exclude_named_groups=False)
    return found.withColumn("position", col("position").cast("long"))


FAR_PARTS = {
    "pool": f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY role ORDER BY raw_score, url_hash) AS far
        FROM scored WHERE {PLAUSIBLE}) WHERE far <= 200""",
    "wordy": f"""SELECT *, row_number() OVER (PARTITION BY role, lower(trim(title)) ORDER BY far) AS k FROM pool
        WHERE list_has_any(regexp_extract_all(lower(title), '[a-z]+'), {S.sql_list(fv.ENGLISH_TITLE_WORDS)})""",
    "farthest": """SELECT role, row_number() OVER (PARTITION BY role ORDER BY far) AS position, title, company,
        round(raw_score, 3) AS sim FROM wordy WHERE k = 1""",
}


@add("g4_farthest", atlas_sql("SELECT * FROM farthest WHERE position <= 5", **FAR_PARTS))
def g4(spark, d):
    """F3, G4."""
    return neighborhood(spark, d).farthest.withColumn("position", col("position").cast("long"))


_SAMPLED = f"""SELECT *, row_number() OVER (PARTITION BY role ORDER BY md5('{fv.SEED}:' || url_hash), url_hash) AS draw FROM center"""


@add("g6_center_sample", atlas_sql("SELECT role, url_hash FROM drawn WHERE draw <= 20", drawn=_SAMPLED))
def g6(spark, d):
    return neighborhood(spark, d, max_center_dots=20).center_sample.select("role", "url_hash")


@add(
    "g6_center_sample_sizes",
    atlas_sql("SELECT role, least(count(*), 20) AS n, least(count(*), 20) AS n_in_center FROM center GROUP BY role"),
)
def g6_sizes(spark, d):
    found = neighborhood(spark, d, max_center_dots=20)
    center = found.center.select("role", "url_hash").withColumn("hit", F.lit(1))
    return found.center_sample.join(center, ["role", "url_hash"], "left").groupBy("role").agg(
        F.countDistinct("url_hash").alias("n"), F.count("hit").alias("n_in_center")
    )


@add("i4_points")
def i4(spark, d):
    """H1 with I4: the drawn points."""
    return neighborhood(spark, d).points


@add(
    "i4_axes",
    atlas_sql("SELECT DISTINCT role, -1.0::DOUBLE AS low_x, 1.0::DOUBLE AS high_x, -1.0::DOUBLE AS low_y, 1.0::DOUBLE AS high_y, "
              "TRUE AS uncorrelated, TRUE AS first_is_wider FROM center"),
)
def i4_axes(spark, d):
    """What makes a principal plane: each axis fills its span, and the axes do not correlate.

    The first axis explains no less than the second before they are scaled, which is
    read from the vectors' variance along both.
    """
    found = neighborhood(spark, d)
    clean = apply_transform(found.vectors.select("url_hash", "role_vec"), None, "role_vec", "vec")
    plane = layout.pca_plane(clean.join(found.viz.select("role", "url_hash"), "url_hash"))
    wider = plane.groupBy("role").agg((F.var_pop("x") >= F.var_pop("y") - 1e-9).alias("first_is_wider"))
    points = found.points.groupBy("role").agg(
        F.min("x").alias("low_x"), F.max("x").alias("high_x"), F.min("y").alias("low_y"), F.max("y").alias("high_y"),
        (F.abs(F.corr("x", "y")) < 1e-3).alias("uncorrelated"),
    )
    return points.join(wider, "role")


@add(
    "e11_hulls_of_points",
    atlas_sql(f"""SELECT role, grp, floor(sum(n) * 0.9)::BIGINT AS n_core, 0::BIGINT AS n_outside FROM entries
        GROUP BY role, grp HAVING floor(sum(n) * 0.9) >= 3""",
        entries=f"""SELECT role, role_label AS grp, least(count(*), {fv.MAX_CENTER_DOTS}) AS n FROM center GROUP BY role, role_label
            UNION ALL SELECT role, grp, n FROM groups"""),
)
def e11_points(spark, d):
    """E10, E11 on the drawn points: no core point lies outside an edge of its hull."""
    core = layout.group_core(neighborhood(spark, d).points.select("role", "grp", "url_hash", "x", "y"))
    hull = layout.group_hull(core)
    ring = hull.groupBy("role", "grp").agg(F.sort_array(F.collect_list(F.struct("vertex", "x", "y"))).alias("ring"))

    def side(edge):
        # Counter-clockwise edges have what is inside on their left.
        a, b = edge["a"], edge["b"]
        return (b["x"] - a["x"]) * (col("y") - a["y"]) - (b["y"] - a["y"]) * (col("x") - a["x"]) < -1e-9

    turned = F.concat(F.slice("ring", 2, F.size("ring")), F.slice("ring", 1, 1))
    edges = F.zip_with("ring", turned, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    outside = F.exists(edges, side)
    return core.join(ring, ["role", "grp"]).groupBy("role", "grp").agg(
        F.count("*").alias("n_core"), F.count_if(outside).alias("n_outside")
    )


@add(
    "h1_point_rows",
    atlas_sql(f"""SELECT role, role_label AS grp, url_hash, title, company, url, true AS is_center, true AS inside FROM drawn
        WHERE draw <= {fv.MAX_CENTER_DOTS}
        UNION ALL SELECT role, grp, url_hash, title, company, url, false, true FROM neighbors SEMI JOIN groups USING (role, grp)""",
        drawn=_SAMPLED),
)
def h1(spark, d):
    """The same rows without coordinates, which only have to lie in the unit square."""
    inside = col("x").between(-1, 1) & col("y").between(-1, 1)
    points = neighborhood(spark, d).points
    return points.select(
        "role", "grp", "url_hash", "title", "company", "url", "is_center", inside.alias("inside")
    )


@add(
    "a11_export",
    atlas_sql(f"""SELECT role, any_value(label) AS label, '{N} nearest positions to ' || any_value(label) || ', grouped by title' AS description,
        1 + (SELECT count(*) FROM groups g WHERE g.role = c.role AND g.grp <> any_value(label)) AS n_groups,
        (SELECT count(*) FROM farthest f WHERE f.role = c.role AND position <= 5) AS n_farthest,
        least(count(*), 200) + (SELECT coalesce(sum(n), 0) FROM groups g WHERE g.role = c.role)::BIGINT AS n_points,
        array_to_string(list_sort(list_distinct(list_append(coalesce((SELECT list(grp) FROM groups g WHERE g.role = c.role), []),
          any_value(label)))), '|') AS point_groups
        FROM center c JOIN (SELECT role, label FROM roles) USING (role) GROUP BY role""", **FAR_PARTS),
)
def a11(spark, d):
    path = scratch_path(spark, "atlas")
    export_neighborhood(neighborhood(spark, d), path)
    back = spark.read.json(path)
    return back.select(
        "role", "label", "description",
        F.size(F.json_object_keys(F.to_json("group_counts"))).cast("long").alias("n_groups"),
        F.size("farthest").cast("long").alias("n_farthest"), F.size("points").cast("long").alias("n_points"),
        F.array_join(F.array_sort(F.array_distinct("points.group")), "|").alias("point_groups"),
    )


# --- geometry over all vectors: role = label, place = the first two elements ---


def plane(spark, d):
    t = V.table(spark, d, "embeddings")
    return t.select(
        col("label").cast("string").alias("role"), F.concat(F.lit("g"), (col("vec_id") % 4).cast("string")).alias("grp"),
        col("vec_id").alias("url_hash"), F.round(F.get("embedding", 0).cast("double"), 6).alias("x"),
        F.round(F.get("embedding", 1).cast("double"), 6).alias("y"),
    )


PLANE = """SELECT label::VARCHAR AS role, 'g' || (vec_id % 4) AS grp, vec_id AS url_hash,
    round(embedding[1]::DOUBLE, 6) AS x, round(embedding[2]::DOUBLE, 6) AS y FROM embeddings"""


@add("e8_axis_bounds", f"SELECT role, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y FROM ({PLANE}) GROUP BY role")
def e8(spark, d):
    return layout.axis_bounds(plane(spark, d))


@add(
    "f6_rescale",
    f"""SELECT role, grp, url_hash, round(2 * (x - min(x) OVER r) / (max(x) OVER r - min(x) OVER r) - 1, 4) AS x,
        round(2 * (y - min(y) OVER r) / (max(y) OVER r - min(y) OVER r) - 1, 4) AS y FROM ({PLANE})
        WINDOW r AS (PARTITION BY role)""",
)
def f6(spark, d):
    return layout.rescale(plane(spark, d))


@add(
    "e10_group_core",
    f"""WITH p AS ({PLANE}), c AS (SELECT role, grp, avg(x) AS cx, avg(y) AS cy, count(*) AS n FROM p GROUP BY role, grp),
        r AS (SELECT *, row_number() OVER (PARTITION BY role, grp ORDER BY
          round(sqrt((x - cx) ** 2 + (y - cy) ** 2), 9), url_hash) AS place FROM p JOIN c USING (role, grp) WHERE n >= 3)
        SELECT role, grp, url_hash, x, y, round(cx, 6) AS cx, round(cy, 6) AS cy FROM r WHERE place <= floor(n * 0.9)""",
)
def e10(spark, d):
    return layout.group_core(plane(spark, d)).withColumns(
        {"cx": F.round("cx", 6), "cy": F.round("cy", 6)}
    )


@add("e11_group_hull")
def e11(spark, d):
    return layout.group_hull(layout.group_core(plane(spark, d)))


@add(
    "h3_hint_words",
    f"""SELECT DISTINCT p_name AS title, list_has_any(regexp_extract_all(lower(p_name), '[a-z]+'), ['part', 'product']) AS hit FROM part""",
)
def h3(spark, d):
    titles = V.table(spark, d, "part").select(col("p_name").alias("title")).distinct()
    return titles.withColumn("hit", shares_words(col("title"), ["part", "product"]))


@add(
    "f1_global_rank",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders",
)
def f1(spark, d):
    """The rank behind wide prefetches: all rows ranked, none gathered in one task."""
    orders = V.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    ranked = global_rank(orders, [col("o_totalprice").desc(), col("o_orderkey")], "place")
    return ranked.select("o_orderkey", "place")


# --- the model ---------------------------------------------------------------

LAMBDA, ALPHA = 1.0, 1e-3


@add(
    "i2_apply_transform",
    f"SELECT vec_id AS url_hash, unnest(generate_series(1, 64)) AS i, round(unnest({_unit('embedding')}), 5) AS x FROM embeddings",
)
def i2(spark, d):
    clean = apply_transform(V.vectors_of(V.role_listings(spark, d)), None)
    return clean.select("url_hash", F.posexplode("clean_vec").alias("i", "x")).select(
        "url_hash", (col("i") + 1).cast("long").alias("i"), F.round("x", 5).alias("x")
    )


@add(
    "i2_apply_rotation",
    f"""WITH r AS (SELECT vec_id AS url_hash, {_unit("list_concat(embedding[2:64], embedding[1:1])")} AS u FROM embeddings)
        SELECT url_hash, round(u[1], 5) AS first, round(u[64], 5) AS last FROM r""",
)
def i2_rotation(spark, d):
    """A permutation matrix as W: the first element moves to the end."""
    w = np.roll(np.eye(64), -1, axis=1)
    clean = apply_transform(V.vectors_of(V.role_listings(spark, d)), w)
    return clean.select(
        "url_hash", F.round(F.get("clean_vec", 0), 5).alias("first"),
        F.round(F.get("clean_vec", 63), 5).alias("last"),
    )


@add(
    "i5_gram_sums",
    with_views(["v7"], """SELECT i, j, round(sum(a * b), 4) AS xx, round(sum(a * c), 4) AS xy FROM (
        SELECT i, j, role_vec[i]::DOUBLE AS a, role_vec[j]::DOUBLE AS b, resp_vec[j] AS c
        FROM v7, (SELECT unnest(generate_series(1, 64)) AS i), (SELECT unnest(generate_series(1, 64)) AS j))
        GROUP BY i, j"""),
)
def i5_gram(spark, d):
    xx, xy = D.gram_sums(V.vector_pairs(spark, d))
    rows = [
        (i + 1, j + 1, round(float(xx[i, j]), 4) + 0.0, round(float(xy[i, j]), 4) + 0.0)
        for i in range(len(xx)) for j in range(len(xx))
    ]
    return spark.createDataFrame(rows, "i long, j long, xx double, xy double")


FOLDS = 3
V7_FOLDS = f"SELECT *, (('0x' || substr(md5(company), 1, 15))::BIGINT % {FOLDS})::INTEGER AS fold FROM v7"


@add(
    "i5_fold_sums",
    with_views(["v7"], """SELECT fold, i, j, round(sum(a * b), 4) AS xx, round(sum(a * c), 4) AS xy FROM (
        SELECT fold, i, j, role_vec[i]::DOUBLE AS a, role_vec[j]::DOUBLE AS b, resp_vec[j] AS c
        FROM f, (SELECT unnest(generate_series(1, 64)) AS i), (SELECT unnest(generate_series(1, 64)) AS j))
        GROUP BY fold, i, j""", f=V7_FOLDS),
)
def i5_folds(spark, d):
    """The sums of all folds, from one pass."""
    pairs = D.company_folds(V.vector_pairs(spark, d), FOLDS)
    xx, xy = D.fold_gram_sums(pairs, FOLDS)
    rows = [
        (f, i + 1, j + 1, round(float(xx[f, i, j]), 4) + 0.0, round(float(xy[f, i, j]), 4) + 0.0)
        for f in range(FOLDS) if xx[f].any() for i in range(xx.shape[1]) for j in range(xx.shape[1])
    ]
    return spark.createDataFrame(rows, "fold int, i long, j long, xx double, xy double")


@add(
    "i10_cross_validated",
    with_views(["v7"], """SELECT fold, n, round(r2, 5) AS raw_r2, round(ci, 5) AS raw_ci, TRUE AS r2_rises FROM (
        SELECT fold, 1 - sum(e) / sum(s) AS r2, any_value(n) AS n FROM (
          SELECT fold, i, sum((y - x) ** 2) AS e, sum(y * y) - sum(y) ** 2 / count(*) AS s, count(*) AS n FROM (
            SELECT fold, generate_subscripts(role_vec, 1) AS i, unnest(role_vec)::DOUBLE AS x, unnest(resp_vec) AS y FROM f)
          GROUP BY fold, i) GROUP BY fold) LEFT JOIN (
        SELECT a.fold, avg(list_dot_product(a.u, b.u)) AS ci FROM u a JOIN u b
        ON a.fold = b.fold AND a.title = b.title AND a.company < b.company GROUP BY a.fold) USING (fold)""",
        f=V7_FOLDS, u=f"SELECT fold, title, company, {_unit('role_vec')} AS u FROM f"),
)
def i10_cross(spark, d):
    """Held-out folds of companies; the matrix of each comes from the other folds."""
    found = D.cross_validate(V.vector_pairs(spark, d), FOLDS, LAMBDA, ALPHA)
    return found.select(
        "fold", "n", F.round("raw_r2", 5).alias("raw_r2"), F.round("raw_ci", 5).alias("raw_ci"),
        (col("clean_r2") > col("raw_r2")).alias("r2_rises"),
    )


@add("i5_fit_deconfound")
def i5(spark, d):
    w = D.fit_deconfound(V.vector_pairs(spark, d), LAMBDA, ALPHA)
    path = scratch_path(spark, "transform")
    D.save_transform(spark, w, path)
    stored = D.load_transform(spark, path)
    rows = [(i, j, round(float(stored[i, j]), 5)) for i in range(len(w)) for j in range(len(w))]
    return spark.createDataFrame(rows, "i int, j int, w double")


@add(
    "i6_company_folds",
    with_views(["v2"], "SELECT url_hash, company, (('0x' || substr(md5(company), 1, 15))::BIGINT % 5)::INTEGER AS fold FROM v2"),
)
def i6(spark, d):
    folds = D.company_folds(V.vector_pairs(spark, d), 5)
    return folds.select("url_hash", "company", "fold")


@add(
    "i6_fold_counts",
    with_views(["v2"], "SELECT company, 1::BIGINT AS n_folds, count(*) AS n FROM v2 GROUP BY company"),
)
def i6_counts(spark, d):
    folds = D.company_folds(V.vector_pairs(spark, d), 5)
    return folds.groupBy("company").agg(F.countDistinct("fold").alias("n_folds"), F.count("*").alias("n"))


def _knn(name: str, column: str) -> dict[str, str]:
    unit = _unit(column)
    return {
        f"{name}_u": f"SELECT url_hash, {unit} AS u FROM v7",
        name: f"""SELECT q, o FROM (SELECT a.url_hash AS q, b.url_hash AS o, row_number() OVER (PARTITION BY a.url_hash
            ORDER BY round(list_dot_product(a.u, b.u), 10) DESC, b.url_hash) AS k FROM {name}_u a, {name}_u b
            WHERE a.url_hash <> b.url_hash) WHERE k <= 20""",
    }


@add(
    "i7_knn_preservation",
    with_views(["v7"], """SELECT round(avg(share), 4) AS rnp, count(*) AS n_queries FROM (
        SELECT p.q, count(r.o) / count(*) AS share FROM resp p LEFT JOIN role r ON p.q = r.q AND p.o = r.o GROUP BY p.q)""",
        **_knn("role", "role_vec"), **_knn("resp", "resp_vec")),
)
def i7(spark, d):
    kept = D.knn_preservation(V.vector_pairs(spark, d), 20)
    return kept.select(F.round("rnp", 4).alias("rnp"), "n_queries")


@add(
    "i8_rank_correlation",
    with_views(["v7"], """SELECT round(corr(role_rank, resp_rank), 4) AS rrc, count(*) AS n_pairs FROM (
        SELECT avg_rank.* FROM (SELECT
          rank() OVER (ORDER BY role_sim) + (count(*) OVER (PARTITION BY role_sim) - 1) / 2 AS role_rank,
          rank() OVER (ORDER BY resp_sim) + (count(*) OVER (PARTITION BY resp_sim) - 1) / 2 AS resp_rank
          FROM sims) avg_rank)""",
        units=f"SELECT url_hash, {_unit('role_vec')} AS r, {_unit('resp_vec')} AS p FROM v7",
        placed="""SELECT *, row_number() OVER (ORDER BY md5(url_hash::VARCHAR), url_hash) AS place, count(*) OVER () AS n FROM units""",
        sims="""SELECT round(list_dot_product(x.r, y.r), 10) AS role_sim, round(list_dot_product(x.p, y.p), 10) AS resp_sim
            FROM placed x JOIN placed y ON (x.place % 2 = 1 AND y.place = x.place + 1)
              OR (x.place = x.n AND x.n % 2 = 1 AND y.place = x.n - 1)"""),
)
def i8(spark, d):
    found = D.rank_correlation(V.vector_pairs(spark, d))
    return found.select(F.round("rrc", 4).alias("rrc"), "n_pairs")


@add(
    "i9_company_invariance",
    with_views(["v2"], """SELECT round(avg(list_dot_product(a.u, b.u)), 5) AS ci, count(*) AS n_pairs FROM u a JOIN u b
        ON a.title = b.title AND a.company < b.company""",
        u=f"SELECT url_hash, title, company, {_unit('role_vec')} AS u FROM v2"),
)
def i9(spark, d):
    found = D.company_invariance(V.vector_pairs(spark, d))
    return found.select(F.round("ci", 5).alias("ci"), "n_pairs")


@add(
    "i10_reconstruction_r2",
    with_views(["v7"], """SELECT round(1 - sum(e) / sum(s), 5) AS r2, (SELECT count(*) FROM v7) AS n FROM (
        SELECT i, sum((y - x) ** 2) AS e, sum(y * y) - sum(y) ** 2 / count(*) AS s FROM (
          SELECT generate_subscripts(role_vec, 1) AS i, unnest(role_vec)::DOUBLE AS x, unnest(resp_vec) AS y FROM v7)
        GROUP BY i)"""),
)
def i10(spark, d):
    found = D.reconstruction_r2(V.vector_pairs(spark, d))
    return found.select(F.round("r2", 5).alias("r2"), "n")


@add("i10_fitted_r2")
def i10_fitted(spark, d):
    """With a fitted matrix the share explained has to rise."""
    pairs = V.vector_pairs(spark, d)
    w = D.fit_deconfound(pairs, LAMBDA, ALPHA)
    return D.reconstruction_r2(pairs, w).select(F.round("r2", 5).alias("r2"), "n")


@add("j7_deconfounded_neighbors")
def j7_deconfounded(spark, d):
    """The flagship with a fitted matrix."""
    w = D.fit_deconfound(V.vector_pairs(spark, d), LAMBDA, ALPHA)
    found = neighborhood(spark, d, w=w).neighbors
    return found.select("role", "url_hash", "grp", F.round("sim", 4).alias("sim"), "rank")


# --- a diagonal matrix, which SQL can apply ------------------------------------

DIMENSION = 64
_WEIGHTED = "list_transform(generate_series(1, len(role_vec)), lambda i: role_vec[i]::DOUBLE * (1 + i % 3))"


def stored_diagonal(spark) -> np.ndarray:
    """The matrix as it comes back from storage."""
    path = scratch_path(spark, "diagonal")
    D.save_transform(spark, np.diag(1.0 + np.arange(1, DIMENSION + 1) % 3), path)
    return D.load_transform(spark, path)


_DIAGONAL_PARTS = PARTS | {
    "titled": f"SELECT *, {_unit('weighted')} AS clean_unit FROM (SELECT v2.*, grp, {_WEIGHTED} AS weighted "
              "FROM v2 JOIN norm USING (title) WHERE is_active AND title <> '')",
    "sums": """SELECT role, i, avg(x) AS raw, avg(u) AS clean FROM (
        SELECT role, generate_subscripts(role_vec, 1) AS i, unnest(role_vec)::DOUBLE AS x,
        unnest(clean_unit) AS u FROM center) GROUP BY role, i""",
    "scored": f"""SELECT role, n, url_hash, title, company, url, grp,
        round(list_dot_product({_unit('role_vec')}, raw), 10) AS raw_score,
        round(list_dot_product(clean_unit, clean), 10) AS clean_score FROM titled, centroids""",
}


@add(
    "j7_diagonal_neighbors",
    with_views(["v2"], "SELECT role, url_hash, grp, round(sim, 4) AS sim, rank FROM neighbors", **_DIAGONAL_PARTS),
)
def j7_diagonal(spark, d):
    found = neighborhood(spark, d, w=stored_diagonal(spark)).neighbors
    return found.select("role", "url_hash", "grp", F.round("sim", 4).alias("sim"), "rank")


@add(
    "i10_diagonal_r2",
    with_views(["v7"], """SELECT round(1 - sum(e) / sum(s), 5) AS r2, (SELECT count(*) FROM v7) AS n FROM (
        SELECT i, sum((y - x * (1 + i % 3)) ** 2) AS e, sum(y * y) - sum(y) ** 2 / count(*) AS s FROM (
          SELECT generate_subscripts(role_vec, 1) AS i, unnest(role_vec)::DOUBLE AS x, unnest(resp_vec) AS y FROM v7)
        GROUP BY i)"""),
)
def i10_diagonal(spark, d):
    found = D.reconstruction_r2(V.vector_pairs(spark, d), stored_diagonal(spark))
    return found.select(F.round("r2", 5).alias("r2"), "n")

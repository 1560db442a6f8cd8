"""Queries for the scalar functions (B) and predicates (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import listings as L
from ..functions import text as X
from ..functions import titles as T
from ..functions import urls as U
from ..functions.vectors import cosine_scores, l2_normalize
from ..operators.vector_table import unembedded
from ..plans.encode import pending_texts
from ..plans.neighborhood import BUILTIN_ROLES
from . import sql as S
from . import views as V
from .registry import registry
from .views import with_views

add = registry.add
col = F.col


def all_titles(spark, d):
    """Every title of V1, V2 and V3, once."""
    parts = [V.pages(spark, d), V.role_listings(spark, d), V.documents(spark, d)]
    titles = [p.select("title") for p in parts]
    return titles[0].unionByName(titles[1]).unionByName(titles[2]).distinct()


ALL_TITLES = "SELECT title FROM v1 UNION SELECT title FROM v2 UNION SELECT title FROM v3"


# Page URLs in the form each host rule looks for.
_URL_FORMS = [
    ("https://www.linkedin.com/jobs/view/", "?trk=a"),
    ("https://jobs.ashbyhq.com/acme/", "/application?src=b"),
    ("https://boards.greenhouse.io/acme/jobs/", "?gh_jid=1&utm_source=x"),
    ("https://jobs.lever.co/acme/", "?lever-source=c"),
    ("https://www.google.com/about/careers/", "?q=d"),
    ("https://example.com/jobs/", "?gh_jid=7"),
    ("https://example.com/other/", "?keep=1"),
]


def url_forms(spark, d):
    pages = V.pages(spark, d).select("page_id", F.explode(F.array(
        col("url"),
        *[F.concat(F.lit(a), col("page_id").cast("string"), F.lit(b)) for a, b in _URL_FORMS],
    )).alias("url"))
    return pages


URL_FORMS = "SELECT page_id, unnest([url, " + ", ".join(
    f"'{a}' || page_id || '{b}'" for a, b in _URL_FORMS
) + "]) AS url FROM pages"


@add("b1_clean_ats_url", f"WITH forms AS ({URL_FORMS}) SELECT url AS raw_url, {S.clean_url('url')} AS url FROM forms")
def b1(spark, d):
    return url_forms(spark, d).select(
        col("url").alias("raw_url"), U.clean_ats_url(col("url")).alias("url")
    )


MARKED = "text || '<p>Pay &amp; perks&nbsp;&#8226; &lt;b&gt; &quot;a&quot; &#39;b&#39; &bull; &amp;lt;i&amp;gt;</p>'"


@add(
    "b2_clean_description",
    f"""SELECT 'd' || doc_id AS id, {S.clean_description(MARKED)} AS clean FROM documents
        UNION ALL SELECT 'p' || page_id, {S.clean_description('html')} FROM pages""",
)
def b2(spark, d):
    tail = "<p>Pay &amp; perks&nbsp;&#8226; &lt;b&gt; &quot;a&quot; &#39;b&#39; &bull; &amp;lt;i&amp;gt;</p>"
    docs = V.table(spark, d, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("id"), F.concat("text", F.lit(tail)).alias("t")
    )
    pages = V.table(spark, d, "pages").select(F.concat(F.lit("p"), "page_id").alias("id"), col("html").alias("t"))
    return docs.unionByName(pages).select("id", X.clean_description(col("t")).alias("clean"))


@add(
    "b3_clean_location",
    with_views(["v3"], f"SELECT doc_id, {S.clean_location('place')} AS location FROM "
               "(SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN ' ' || upper(location) || ' ' ELSE location END AS place FROM v3)"),
)
def b3(spark, d):
    place = F.when(
        col("doc_id") % 2 == 0, F.concat(F.lit(" "), F.upper("location"), F.lit(" "))
    ).otherwise(col("location"))
    return V.documents(spark, d).select("doc_id", X.clean_location(place).alias("location"))


@add("b4_scrub_nul", "SELECT doc_id, text FROM documents")
def b4(spark, d):
    t = V.table(spark, d, "documents")
    dirty = F.concat(F.lit("\u0000"), F.replace("text", F.lit(" "), F.lit(" \u0000")))
    return t.select("doc_id", X.scrub_nul(dirty).alias("text"))


@add("b5_url_hash")
def b5(spark, d):
    return url_forms(spark, d).select("url", U.url_hash(col("url")).alias("url_hash"))


@add(
    "b5_hash_profile",
    f"""WITH forms AS ({URL_FORMS})
        SELECT page_id % 10 AS part, count(DISTINCT url) AS n_urls, count(DISTINCT url) AS n_hashes,
        true AS in_range FROM forms GROUP BY 1""",
)
def b5_profile(spark, d):
    hashed = url_forms(spark, d).withColumn("h", U.url_hash(col("url")))
    return hashed.groupBy((col("page_id") % 10).alias("part")).agg(
        F.countDistinct("url").alias("n_urls"), F.countDistinct("h").alias("n_hashes"),
        F.bool_and(col("h").between(0, fv.URL_HASH_MASK)).alias("in_range"),
    )


@add("b6_strip_html", f"SELECT page_id, {S.strip_html('html')} AS plain FROM pages")
def b6(spark, d):
    return V.table(spark, d, "pages").select("page_id", X.strip_html(col("html")).alias("plain"))


# A third of the documents get a section header early, a third one late.
HEADED = """CASE doc_id % 3
    WHEN 0 THEN substring(text, 1, 300) || ' Key Responsibilities: ' || substring(text, 301)
    WHEN 1 THEN text || ' What you''ll do: more' ELSE text END"""


def headed(spark, d):
    t = V.documents(spark, d)
    body = col("description_raw")
    return t.withColumn(
        "description_raw",
        F.when(
            col("doc_id") % 3 == 0,
            F.concat(
                F.substring(body, 1, 300), F.lit(" Key Responsibilities: "),
                F.substring(body, F.lit(301), F.length(body)),
            ),
        ).when(col("doc_id") % 3 == 1, F.concat(body, F.lit(" What you'll do: more"))).otherwise(body),
    )


@add(
    "b7_extract_role_text",
    f"""WITH plain AS (SELECT doc_id, {S.strip_html(HEADED)} AS t FROM documents)
        SELECT doc_id, {S.extract_role_text('t')} AS role_part FROM plain""",
)
def b7(spark, d):
    return headed(spark, d).select(
        "doc_id", X.extract_role_text(col("description_raw")).alias("role_part")
    )


@add(
    "b8_role_text",
    with_views(
        ["v3"],
        f"""SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN title
            ELSE title || '. ' || {S.extract_role_text('t')} END AS role_text FROM plain""",
        plain=f"SELECT doc_id, v3.title, {S.strip_html(HEADED)} AS t FROM documents JOIN v3 USING (doc_id)",
    ),
)
def b8(spark, d):
    body = F.when(col("doc_id") % 7 == 0, "  ").otherwise(col("description_raw"))
    return headed(spark, d).select(
        "doc_id", X.role_text(F.concat(F.lit(" "), "title"), body).alias("role_text")
    )


@add(
    "b9_normalize_title",
    with_views(["v1", "v2", "v3"], "SELECT title, grp FROM norm", titles=ALL_TITLES, **S.norm_parts("titles")),
)
def b9(spark, d):
    return all_titles(spark, d).select("title", T.normalize_title(col("title")).alias("grp"))


@add(
    "b10_smart_cap",
    f"""WITH words AS (SELECT unnest(string_split_regex(lower(text), '\\s+')) AS word FROM documents),
        counted AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY word)
        SELECT word, {S.smart_cap('word')} AS cap, n FROM counted""",
)
def b10(spark, d):
    words = V.table(spark, d, "documents").select(
        F.explode(F.split(F.lower("text"), r"\s+")).alias("word")
    )
    counted = words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))
    return counted.select("word", T.smart_cap(col("word")).alias("cap"), "n")


_HIDDEN = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"


# References of every kind and what they stand for.
REFERENCES = [
    ("&#0000000065;&#x000000042", "AB"), ("&rarr;&larr", "→&larr"), ("1&plusmn;2&frac12", "1±2½"), ("&Ecirc;&para", "Ê¶"),
    ("&check;&CounterClockwiseContourIntegral;", "✓∳"), ("&nbspx&nbsp;y", "x\u00a0y"), ("&#146;&#x80;&#150", "’€–"),
    ("&#99999999;&#xD800;&#0;", "\ufffd\ufffd\ufffd"), ("&notit;&notin;&ampere", "¬it;∉&ere"), ("&zz; & &; &#;&#x;", "&zz; & &; &#;&#x;"),
    ("&amp;lt;&lt;b&gt;&AMP", "&lt;<b>&"), ("&#x1F600;&#128512", "😀😀"), ("&copy2026&copy;", "©2026©"), ("a&#1;&#xFFFF;b&#11;", "ab"),
]


@add(
    "b11_html_text",
    f"""WITH nodes AS (SELECT page_id, string_split_regex(
          regexp_replace(html, '{_HIDDEN}', '<br>', 'g'), '<[/!?]?[A-Za-z][^>]*>') AS parts FROM pages)
        SELECT page_id, array_to_string(list_append(list_filter(list_transform(parts, lambda p:
          {S.strip("replace(replace(replace(replace(p, '&copy;', '©'), '&middot;', '·'), '&quot;', chr(34)), '&amp;', '&')")}),
          lambda p: p <> ''), ({S.sql_list([plain for _, plain in REFERENCES])})[page_id % {len(REFERENCES)} + 1]), chr(10)) AS lines
        FROM nodes""",
)
def b11(spark, d):
    """Whole pages, each with one more paragraph of references."""
    raw = F.element_at(F.array(*[F.lit(r) for r, _ in REFERENCES]), (col("page_id") % len(REFERENCES)).cast("int") + 1)
    page = F.concat(col("html"), F.lit("<p>"), raw, F.lit("</p>"))
    return V.table(spark, d, "pages").select("page_id", X.html_text(page).alias("lines"))


@add(
    "b12_flatten_sections",
    with_views(["v3"], f"""SELECT doc_id, array_to_string(list_concat([title], list_transform(
          list_filter(list_transform(string_split(description_raw, chr(10)), lambda x: {S.strip('x')}),
          lambda x: x <> ''), lambda x: '- ' || x)), chr(10)) AS body FROM v3"""),
)
def b12(spark, d):
    items = F.transform(
        F.split("description_raw", "\n"), lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))
    )
    section = F.struct(col("title").alias("text"), F.array_join(items, "").alias("content"))
    return V.documents(spark, d).select(
        "doc_id", X.flatten_sections(F.array(section)).alias("body")
    )


@add(
    "b13_remote_onsite",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'remote' WHEN 1 THEN 'hybrid' ELSE '' END AS lever,
       CASE WHEN c_custkey % 5 = 0 THEN 'remote' ELSE
         (['remote', 'hybrid', 'onsite', ''])[c_custkey % 4 + 1] END AS ashby FROM customer""",
)
def b13(spark, d):
    i = col("c_custkey")
    plain = V.pick(["remote", "hybrid", "onsite", ""], i % 4)
    cased = F.initcap(plain)
    return V.table(spark, d, "customer").select(
        i, X.lever_remote(plain).alias("lever"), X.ashby_remote(i % 5 == 0, cased).alias("ashby")
    )


@add(
    "b14_posted_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS posted_date,
       o_orderdate::DATE AS posted_on, (epoch(o_orderdate)::BIGINT)::VARCHAR AS from_millis FROM orders""",
)
def b14(spark, d):
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # Milliseconds keep their first ten digits, which read as seconds.
    millis = (F.unix_timestamp(col("o_orderdate").cast("timestamp")) * 1000).cast("string")
    seconds = X.posted_date(millis)
    return V.table(spark, d, "orders").select(
        "o_orderkey", X.posted_date(stamp).alias("posted_date"),
        X.posted_on(stamp).alias("posted_on"), F.substring(millis, 1, F.length(millis) - 3).alias("_s"),
        seconds.alias("_cut"),
    ).select(
        "o_orderkey", "posted_date", "posted_on",
        F.when(F.length("_s") < 10, col("_s")).otherwise(col("_cut")).alias("from_millis"),
    )


@add(
    "b16_word_tokens",
    with_views(["v1", "v2", "v3"], f"""SELECT title, array_to_string(list_sort(words), ' ') AS words,
        list_has_any(words, {S.sql_list(fv.ENGLISH_TITLE_WORDS)}) AS shares
        FROM (SELECT title, list_distinct(regexp_extract_all(lower(title), '[a-z]+')) AS words FROM titles)""",
        titles=ALL_TITLES),
)
def b16(spark, d):
    return all_titles(spark, d).select(
        "title", F.array_join(F.sort_array(T.word_tokens(col("title"))), " ").alias("words"),
        T.shares_words(col("title")).alias("shares"),
    )


@add(
    "b17_l2_normalize",
    """WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE * (vec_id % 5)) AS v FROM embeddings),
       m AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e)
       SELECT vec_id, round(v[1] / (norm + 1e-10), 6) AS guarded_1,
       round(v[64] / (norm + 1e-10), 6) AS guarded_64,
       round(v[1] / CASE WHEN norm > 0 THEN norm ELSE 1 END, 6) AS plain_1 FROM m""",
)
def b17(spark, d):
    # Every fifth vector is zero: both forms leave it at zero.
    v = V.table(spark, d, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * (col("vec_id") % 5)).alias("v"),
        col("embedding").alias("_e"),
    ).select("vec_id", "v", F.col("v").alias("v2"))
    both = l2_normalize(l2_normalize(v, "v", "guarded"), "v2", "plain", epsilon=0)
    return both.select(
        "vec_id", F.round(F.get("guarded", 0), 6).alias("guarded_1"),
        F.round(F.get("guarded", 63), 6).alias("guarded_64"),
        F.round(F.get("plain", 0), 6).alias("plain_1"),
    )


@add(
    "b18_cosine",
    """WITH t AS (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1)
       SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 6) AS cosine,
       round(1 - list_cosine_similarity(embedding::DOUBLE[], q::DOUBLE[]), 6) AS distance
       FROM embeddings, t""",
)
def b18(spark, d):
    e = V.table(spark, d, "embeddings")
    target = e.orderBy("vec_id").select("embedding").first()[0]
    scored = cosine_scores(e.select("vec_id", "embedding"), [target], "embedding")
    s = F.get("scores", 0)
    return scored.select("vec_id", F.round(s, 6).alias("cosine"), F.round(1 - s, 6).alias("distance"))


@add(
    "b19_embed_input",
    """SELECT c_custkey, CASE WHEN c_custkey % 10 < 4 THEN 'untitled position' ELSE t END AS input FROM
       (SELECT c_custkey, ' ' || substring(c_name, 1, 2 + (c_custkey % 10)::INTEGER) || ' ' AS t FROM customer)""",
)
def b19(spark, d):
    i = col("c_custkey")
    t = F.concat(F.lit(" "), F.substring(col("c_name"), F.lit(1), (i % 10).cast("int") + 2), F.lit(" "))
    return V.table(spark, d, "customer").select(i, X.embed_input(t).alias("input"))


@add(
    "b19_embed_texts",
    f"""SELECT doc_id, md5(CASE WHEN length({S.strip('text')}) > {fv.MIN_EMBED_INPUT} THEN text
        ELSE '{fv.EMBED_PLACEHOLDER}' END) AS input FROM documents""",
)
def b19_texts(spark, d):
    """Whole texts as they are handed to an embedder."""
    return V.table(spark, d, "documents").select("doc_id", F.md5(X.embed_input(col("text"))).alias("input"))


@add("b20_is_ascii", "SELECT doc_id, regexp_full_match(text, '(?s)[\\x00-\\x7F]*') AS ascii FROM documents")
def b20(spark, d):
    return V.table(spark, d, "documents").select("doc_id", T.is_ascii(col("text")).alias("ascii"))


@add(
    "b21_url_path_parts",
    f"""WITH forms AS ({URL_FORMS})
        SELECT url, array_to_string({S.path_parts('url')}, '|') AS parts, len({S.path_parts('url')}) AS n FROM forms""",
)
def b21(spark, d):
    parts = U.url_path_parts(col("url"))
    return url_forms(spark, d).select(
        "url", F.array_join(parts, "|").alias("parts"), F.size(parts).cast("long").alias("n")
    )


# --- predicates --------------------------------------------------------------

# Real titles and pages carry few of the tell-tale phrases, so each title also
# appears inside the frames the rules look for.
_FRAMES = [
    "{}", "{} - Indeed", "Jobs: {} | LinkedIn", "12 {} jobs in Berlin", "Find {} Jobs", "Join us as {}",
    "Acme hiring {}", "Search jobs {}", "{} jobs + careers", "Explore careers {}", "unknown",
    "Work in {} - careers", "“{}” jobs", "Multiple positions {}", "{} careers - join now",
    "Careers at {}", "HIRING NOW! Acme hiring {}",
]


@add(
    "c1_aggregator_title",
    with_views(["v1", "v2", "v3"], f"SELECT title, {S.is_aggregator('title')} AS aggregator FROM framed",
               titles=ALL_TITLES, framed="SELECT DISTINCT unnest([" + ", ".join(
                   f"replace('{f}', '{{}}', title)" for f in _FRAMES) + "]) AS title FROM titles"),
)
def c1(spark, d):
    framed = all_titles(spark, d).select(F.explode(F.array(*[
        F.replace(F.lit(f), F.lit("{}"), col("title")) for f in _FRAMES
    ])).alias("title")).distinct()
    return framed.select("title", T.is_aggregator_listing(col("title")).alias("aggregator"))


_BAD_URLS = [
    "https://a.example/search?x=", "https://a.example/job-categories/", "https://a.example/teams/",
    "https://a.example/teams/jobs/", "https://jobs.lever.co/", "https://jobs.lever.co/acme/",
    "https://leverdemo.example/",
]
MORE_URLS = "SELECT unnest([url, " + ", ".join(f"'{u}' || page_id" for u in _BAD_URLS) + "]) AS url FROM pages"


@add("c2_garbage_url", f"WITH u AS ({MORE_URLS}) SELECT url, {S.is_garbage_url('url')} AS garbage FROM u")
def c2(spark, d):
    urls = V.pages(spark, d).select(F.explode(F.array(
        col("url"), *[F.concat(F.lit(u), col("page_id").cast("string")) for u in _BAD_URLS]
    )).alias("url"))
    return urls.select("url", U.is_garbage_url(col("url")).alias("garbage"))


_DESCRIPTION_FRAMES = [
    ("", ""), ("  Sign in ", ""), ("My career My applications My profile ", ""),
    ("", " please enable JavaScript"), ("Accept cookies", ""), (" \n ", ""),
]
DESCRIPTIONS = "SELECT doc_id, unnest(generate_series(1, {n})) AS form, unnest([{forms}]) AS t FROM documents".format(
    n=len(_DESCRIPTION_FRAMES),
    forms=", ".join(
        "'{}' || text || '{}'".format(a.replace("\n", "' || chr(10) || '"), b) for a, b in _DESCRIPTION_FRAMES
    ),
)


@add(
    "c3_garbage_description",
    f"WITH f AS ({DESCRIPTIONS}) SELECT doc_id, form, {S.is_garbage_description('t')} AS garbage FROM f",
)
def c3(spark, d):
    forms = V.table(spark, d, "documents").select("doc_id", F.posexplode(F.array(*[
        F.concat(F.lit(a), col("text"), F.lit(b)) for a, b in _DESCRIPTION_FRAMES
    ])).alias("form", "t"))
    return forms.select(
        "doc_id", (col("form") + 1).cast("long").alias("form"),
        X.is_garbage_description(col("t")).alias("garbage"),
    )


@add(
    "c4_has_content",
    """SELECT doc_id, url <> '' AND (trim(title) <> '' OR length(body) > 50) AS keep,
       length(text) > 50 AS keep_by_text FROM (SELECT doc_id, text, CASE WHEN doc_id % 17 = 0 THEN '' ELSE source END AS url,
       CASE WHEN doc_id % 3 = 0 THEN '  ' ELSE source END AS title,
       CASE WHEN doc_id % 2 = 0 THEN text ELSE source END AS body FROM documents)""",
)
def c4(spark, d):
    i = col("doc_id")
    return V.table(spark, d, "documents").select(i, L.has_content(
        F.when(i % 17 == 0, "").otherwise(col("source")),
        F.when(i % 3 == 0, "  ").otherwise(col("source")),
        F.when(i % 2 == 0, col("text")).otherwise(col("source")),
    ).alias("keep"), L.has_content(F.lit("u"), F.lit(" "), col("text")).alias("keep_by_text"))


SANE = (
    f"SELECT * FROM scraped WHERE url <> '' AND NOT {S.is_garbage_url('url')} AND NOT {S.is_aggregator('title')} "
    f"AND NOT {S.is_garbage_description('description_raw')}"
)


@add(
    "c5_sanitize",
    with_views(["v1", "v3"], f"""SELECT url, title, company, {S.clean_description('description_raw')} AS description_raw,
        {S.clean_location('location')} AS location, 'ats' AS source_domain FROM sane""",
        scraped="SELECT url, title, company, description_raw, location FROM v3 UNION ALL "
                "SELECT url, title, company, description_raw, '' FROM v1",
        sane=SANE),
)
def c5(spark, d):
    columns = ["url", "title", "company", "description_raw", "location"]
    scraped = V.documents(spark, d).select(columns).unionByName(
        V.pages(spark, d).withColumn("location", F.lit("")).select(columns)
    ).withColumns({"remote_onsite": F.lit(""), "posted_date": F.lit(None).cast("string")})
    return L.sanitize(scraped).select(*columns, "source_domain")


def stored_vectors(spark, d):
    """Vectors for some of the V4 rows, keyed like them."""
    state = V.prior_state(spark, d)
    return state.filter(col("url_hash") % 5 != 1).select(
        "url_hash", F.array(F.lit(1.0).cast("float")).alias("role_vec")
    )


PENDING = """SELECT url, url_hash, title, description_raw FROM v4
    WHERE is_active AND NOT (doc_id % 5 <> 1) AND (length(title) > 0 OR length(description_raw) > 50)"""


@add("c6_embeddable", with_views(["v4"], f"SELECT url, url_hash, title, length(description_raw) AS n FROM ({PENDING})"))
def c6(spark, d):
    found = unembedded(V.prior_state(spark, d), stored_vectors(spark, d))
    return found.select("url", "url_hash", "title", F.length("description_raw").cast("long").alias("n"))


@add(
    "c7_text_long_enough",
    with_views(["v4"], f"""SELECT url_hash, text FROM (SELECT url_hash,
        CASE WHEN {S.strip('description_raw')} = '' THEN trim(title)
        ELSE trim(title) || '. ' || {S.extract_role_text('t')} END AS text FROM plain)
        WHERE length(trim(text)) > 10""",
        plain=f"SELECT *, {S.strip_html('description_raw')} AS t FROM ({PENDING})"),
)
def c7(spark, d):
    return pending_texts(V.prior_state(spark, d), stored_vectors(spark, d))


ROLE_ROWS = ", ".join(
    f"('{r.key}', '{r.label}', {S.sql_list(list(r.patterns))}, {S.sql_list(T.plural_patterns(list(r.patterns)))})"
    for r in BUILTIN_ROLES
)
ROLES_SQL = f"SELECT * FROM (VALUES {ROLE_ROWS}) t(role, label, patterns, variants)"


@add(
    "c8_center_like",
    with_views(["v2"], """SELECT url_hash, role FROM v2, roles WHERE is_active AND title <> ''
        AND len(list_filter(variants, lambda p: lower(title) LIKE '%' || p || '%')) > 0""", roles=ROLES_SQL),
)
def c8(spark, d):
    loose = F.array_compact(F.array(*[
        F.when(T.title_like_any(col("title"), list(r.patterns)), F.lit(r.key)) for r in BUILTIN_ROLES
    ]))
    titled = V.role_listings(spark, d).filter(T.has_title(col("title"), col("is_active")))
    return titled.select("url_hash", F.explode(loose).alias("role"))


@add(
    "c9_center_exact",
    with_views(["v1", "v2", "v3"], """SELECT title, role FROM norm, roles WHERE
        len(list_filter(patterns, lambda p: contains(lower(coalesce(grp, '')), p))) > 0""",
        titles=ALL_TITLES, **S.norm_parts("titles"), roles=ROLES_SQL),
)
def c9(spark, d):
    grouped = all_titles(spark, d).withColumn("grp", T.normalize_title(col("title")))
    return grouped.select("title", F.explode(F.array_compact(F.array(*[
        F.when(T.group_contains_any(col("grp"), list(r.patterns)), F.lit(r.key)) for r in BUILTIN_ROLES
    ]))).alias("role"))


PLAUSIBLE = """regexp_matches(title, '^[A-Za-z0-9 ,\\-\\(\\)\\.&/''"]+$') AND length(title) BETWEEN 12 AND 80
    AND company IS NOT NULL AND company <> '' AND company <> 'unknown'"""


@add(
    "c10_plausible_title",
    with_views(["v1", "v2"], f"SELECT title, company FROM (SELECT title, company FROM v1 UNION ALL "
               f"SELECT title, CASE url_hash % 5 WHEN 0 THEN NULL WHEN 1 THEN 'unknown' WHEN 2 THEN '' ELSE company END FROM v2) WHERE {PLAUSIBLE}"),
)
def c10(spark, d):
    i = col("url_hash") % 5
    odd = V.role_listings(spark, d).select(
        "title",
        F.when(i == 0, None).when(i == 1, "unknown").when(i == 2, "").otherwise(col("company")).alias("company"),
    )
    both = V.pages(spark, d).select("title", "company").unionByName(odd)
    return both.filter(T.plausible_title(col("title"), col("company")))


PANEL = f"""coalesce(grp, '') <> '' AND NOT list_contains({S.sql_list(fv.PANEL_SKIP_GROUPS)}, lower(grp))
    AND NOT contains(lower(grp), 'jobs in') AND regexp_full_match(title, '[\\x00-\\x7F]*')
    AND coalesce(company, '') NOT IN ('', 'unknown')"""


@add(
    "c11_panel_ok",
    with_views(["v1", "v2", "v3"], f"SELECT title, grp FROM (SELECT *, 'acme' AS company FROM norm) WHERE {PANEL}",
               titles=ALL_TITLES, **S.norm_parts("titles")),
)
def c11(spark, d):
    grouped = all_titles(spark, d).withColumn("grp", T.normalize_title(col("title")))
    return grouped.filter(T.panel_ok(col("grp"), col("title"), F.lit("acme")))


@add("c12_active_titled", with_views(["v4"], "SELECT url, title FROM v4 WHERE is_active AND title <> ''"))
def c12(spark, d):
    state = V.prior_state(spark, d)
    return state.filter(T.has_title(col("title"), col("is_active"))).select("url", "title")

"""The scalar rules on literal examples, and against small Python oracles."""

import hashlib
import html
import re
from html.entities import html5

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roleatlas.functions import listings as L
from roleatlas.functions import text as X
from roleatlas.functions import titles as T
from roleatlas.functions import urls as U


def table(apply, fn, cases, *more):
    got = apply(fn, [c[0] for c in cases], *more)
    assert got == [c[1] for c in cases]


def test_aggregator_titles(apply):
    table(apply, T.is_aggregator_listing, [
        ("57 junior lab technician jobs in Leipzig", True),
        ("Find Forklift Driver Jobs in Graz", True), ("Careers Home", True), ("", True),
        ("unknown", True), (None, True), ("  UNKNOWN ", True), (" ", True),
        ("Senior Hydrologist", False), ("HIRING NOW! Bicycle Frame Welder", False),
        ("Archivist - Jobs - Careers at Borealis", False),
        ("Borealis Labs hiring Hydrologist", True), ("borealis labs hiring hydrologist", False),
        ("Borealis Labs hiring Welders HIRING NOW", False),
        ("Join our team", True), ("Join ours", False), ("Explore careers", True),
        ("Work in sales – careers", True), ("“nurse” or similar jobs", True),
        ("1,200 remote jobs in " + "x" * 100, True),
        ("Software jobs | LinkedIn", True), ("Software engineer | LinkedIn", False),
        ("Software jobs | linkedin", False), ("Various roles", True), ("View openings", True),
        ("Jobs & Careers", True), ("Job+career", True), ("Acme careers – join us", True),
        ("Job opportunities", True), ("Newest jobs", False), ("Top é jobs", True),
    ])


def test_urls(apply):
    table(apply, U.is_garbage_url, [
        ("https://work.borealis.example/search?q=welder", True),
        ("https://borealis.example/job-categories/welding", True),
        ("https://jobs.lever.co/borealis", True), ("https://jobs.lever.co/borealis/", True),
        ("https://JOBS.LEVER.CO/borealis/0a1b-77", False),
        ("https://jobs.lever.co/acme?x=a/b", True), ("jobs.lever.co/acme", False),
        ("https://boards.greenhouse.io/borealis/jobs/777", False),
        ("https://a.io/teams/x", True), ("https://a.io/teams/job/x", False),
        ("https://leverdemo.io/a/b", True), ("", False), (None, False),
    ])
    table(apply, U.clean_ats_url, [
        ("https://boards.greenhouse.io/borealis/jobs/8?gh_jid=8&ref=mail", "https://boards.greenhouse.io/borealis/jobs/8"),
        ("https://jobs.ashbyhq.com/borealis/77a/application?from=mail", "https://jobs.ashbyhq.com/borealis/77a"),
        ("https://jobs.ashbyhq.com/acme/applications/1?x", "https://jobs.ashbyhq.com/acme/applications/1"),
        ("https://www.linkedin.com/jobs/view/9?trk=z", "https://www.linkedin.com/jobs/view/9"),
        ("https://jobs.lever.co/a/b?c", "https://jobs.lever.co/a/b"),
        ("https://google.com/about/careers/x?y", "https://google.com/about/careers/x"),
        ("https://google.com/x?y", "https://google.com/x?y"),
        ("https://own.io/jobs?gh_jid=4", "https://own.io/jobs"),
        ("https://own.io/jobs?id=4", "https://own.io/jobs?id=4"), ("", ""), (None, None),
    ])
    table(apply, lambda c: F.array_join(U.url_path_parts(c), "|"), [
        ("https://a.io/b/c d/?q=/x", "b|c d"), ("https://a.io", ""), ("https://a.io//b//c/", "b||c"),
        ("a.io/b", "a.io|b"), ("//host/p#f/g", "p"),
    ])


def test_url_hash(apply):
    got = apply(U.url_hash, ["https://borealis.example/x", "https://borealis.example/y", None, "é"])
    first = hashlib.blake2b(b"https://borealis.example/x", digest_size=8).digest()
    assert got[0] == int.from_bytes(first, "big") & (2**63 - 1) and got[1] != got[0] and got[2] is None
    raw = hashlib.blake2b("é".encode(), digest_size=8).digest()
    assert got[3] == int.from_bytes(raw, "big") & (2**63 - 1)


def test_descriptions(apply):
    long = "word " * 30
    table(apply, X.is_garbage_description, [
        ("", True), (None, True), ("a few words", True), ("Kindly turn on javascript first", True),
        (long, False), ("  Sign in " + long, True), ("My career My applications My profile " + long, True),
        (long + " Javascript is required", True), (long * 4 + " javascript is required", False),
    ])
    table(apply, X.clean_description, [
        ("<div>Weld <i>frames</i>&nbsp;daily</div>", "Weld frames daily"), ("a &amp;lt;b&gt; c", "a c"),
        ("x &#233; &eacute; y", "x y"), ("&#39;q&#39; &quot;r&quot;", "'q' \"r\""), ("", ""), (None, None),
        ("a \x1cb ", "a b"),
    ])
    table(apply, X.clean_location, [
        ("Graz, Styria", "Graz, Styria"), ("3 Locations", ""), ("12 location", ""),
        ("2 Locations now", "2 Locations now"), (" Hybrid ", ""), ("N/A", ""), ("", ""), (" Berlin ", "Berlin"),
    ])
    table(apply, X.scrub_nul, [("a\0b", "ab"), ("", "")])


def test_html_text(apply):
    table(apply, X.html_text, [
        ("<p>a</p>\n<p> b <i>c</i></p>", "a\nb\nc"), ("a<br/>b<!-- <p>x --> c", "a\nb\nc"),
        ("<script>var t='</p>';</script>x<style>p{}</style>", "x"),
        ("&lt;p&gt;R&amp;D &#8226; &#x1F600; &zz; &amp;lt;", "<p>R&D • 😀 &zz; &lt;"),
        ("1 < 2 & 3 > 2", "1 < 2 & 3 > 2"), ("", ""), ("&#0;&#99999999;", "��"),
    ])


def test_titles(apply):
    table(apply, T.normalize_title, [
        ("Senior Soil Chemist", "Soil Chemist"), ("Staff ML Engineer", "ML Engineer"),
        ("Principal UI Designer", "UI Designer"), ("Welder @ Borealis", "Welder"),
        ("Site Manager - Remote", "Site Manager"), ("Soil Chemist - Contract", "Soil Chemist"),
        ("Bridge Engineer II", "Bridge Engineer"), ("Welder III", "Welder"),
        ("ux researcher", "UX Researcher"), ("ai engineer", "AI Engineer"),
        ("ml platform engineer", "ML Platform Engineer"), ("Director of Engineering", None),
        ("VP Welding", None), ("Vice President of Bridges", None), ("Welder / Driver", None),
        ("Sales & Marketing Manager", None), ("Data Science Intern", None), ("Recruiter", None),
        ("Events Manager", "Event Manager"), ("", None), ("  ", None), ("X", None), (None, None),
        # Rules that look odd and are kept.
        ("International Account Manager", None), ("Contractor", None), ("Full-Stack", "Full"),
        ("DevOps Engineer", "DEVOPS Engineer"), ("Engineer (remote)", "Engineer"),
        ("Engineer (m/w/d)", None), ("Nurse - Austin, TX", "Nurse"), ("a, b, c engineer", None),
        ("Senior Staff Engineer", "Staff Engineer"), ("Engineer - Remote II", "Engineer"),
        ("Managing Director, X", None), ("(remote ai) dev", "(Remote AI) Dev"), ("Sr. Dev V", "Dev"),
        ("o'neil e-commerce", "O'neil E-commerce"), ("Nurse  Lead", "Nurse Lead"), ("VPx", "Vpx"),
    ])
    assert T.plural_patterns(["event manager"]) == ["event manager", "events manager", "event managers"]


def test_like_patterns(apply):
    table(apply, lambda c: T.title_like_any(c, ["a%z", "m_n", r"50\%"]), [
        ("xaQzx", True), ("AZ", True), ("za", False), ("man", True), ("mn", False), ("50%", True), ("50x", False),
    ])


def test_panel_rules(apply):
    table(apply, lambda c: T.plausible_title(c, F.lit("acme")), [
        ("Data Scientist", True), ("Short title", False), ("Data Scientist é", False), ("Data Scientist's", True),
        ("x" * 80, True), ("x" * 81, False), (None, False), ('Data "Scientist"', True),
    ])
    table(apply, lambda c: T.plausible_title(F.lit("Data Scientist"), c), [("", False), (None, False), ("unknown", False), ("a", True)])
    table(apply, lambda c: T.panel_ok(c, F.lit("t"), F.lit("acme")), [
        (None, False), ("Search", False), ("Jobs In Rome", False), ("Data Engineer", True),
    ])
    table(apply, T.is_ascii, [("", True), ("abc\n", True), ("é", False), ("\x7f", True), ("\x80", False)])
    table(apply, T.shares_words, [("The data-team", True), ("Chef", False), ("DATA", True), ("database", False)])


def test_role_text(apply):
    pad, emoji = "x" * 1200, "😀" * 5
    late = "y" * 2500 + " Responsibilities " + "z" * 100
    body = emoji + " Your Role: " + "w" * 3000
    got = apply(X.extract_role_text, ["short", pad * 2 + "ab", late, body, "q" * 3001])
    assert got[0] == "short" and got[1] == (pad * 2 + "ab")[:2000] and got[2] == late[:2000]
    assert got[3] == body[body.index("Your Role"):][:2000]
    assert got[4] == "q" * 500 + " " + "q" * 1500
    assert apply(lambda c: X.role_text(c, F.lit(" \n")), [" T "]) == ["T"]
    assert apply(lambda c: X.role_text(F.lit("T"), c), ["a  b", None]) == ["T. a b", "T"]
    assert apply(X.embed_input, ["12345", "123456", " ", None]) == [
        "untitled position", "123456", "untitled position", "untitled position"]


def test_dates_and_remote(apply):
    assert apply(X.posted_date, ["2024-01-02T03:04", "1704164645000", None]) == ["2024-01-02", "1704164645", ""]
    assert [str(v) for v in apply(X.posted_on, ["2024-01-02T03", "1704164645", "2024-13-45"])] == ["2024-01-02", "None", "None"]
    assert apply(X.lever_remote, ["remote", "onsite", None]) == ["remote", "", ""]
    assert apply(lambda c: X.ashby_remote(F.lit(True), c), ["Hybrid"]) == ["remote"]
    assert apply(lambda c: X.ashby_remote(F.lit(None).cast("boolean"), c), ["OnSite", None]) == ["onsite", ""]


def test_has_content(apply):
    assert apply(lambda c: L.has_content(F.lit("u"), F.lit(" "), c), ["x" * 50, "x" * 51]) == [False, True]
    assert apply(lambda c: L.has_content(c, F.lit("t"), F.lit("")), ["", "u"]) == [False, True]


# --- properties --------------------------------------------------------------

words = st.text(alphabet=st.sampled_from(list("abé1 -(,)&/@.<>;# \x1c\n")), max_size=30)
batches = st.lists(words, min_size=1, max_size=40)
slow = settings(max_examples=6, deadline=None)


@slow
@given(batches)
def test_clean_location_is_idempotent(apply, values):
    once = apply(X.clean_location, values)
    assert apply(X.clean_location, once) == once


@slow
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab/?#=&")), max_size=12), min_size=1, max_size=30))
def test_clean_url_is_idempotent(apply, tails):
    urls = [h + t for t in tails for h in ("https://jobs.ashbyhq.com/", "https://x.greenhouse.io/", "https://o.io/")]
    once = apply(U.clean_ats_url, urls)
    assert apply(U.clean_ats_url, once) == once
    assert all("?" not in u for u in once if "greenhouse" in u)


@slow
@given(batches)
def test_strip_html_matches_python(apply, values):
    expected = [" ".join(re.sub(r"<[^>]+>", " ", v).split()) for v in values]
    assert apply(X.strip_html, values) == expected


@slow
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab1é(-'.")), min_size=1, max_size=8), min_size=1, max_size=40))
def test_smart_cap_matches_python(apply, values):
    def cap(w):
        core = w.strip("(-'.")
        return w.replace(core, core.capitalize(), 1) if core else w

    assert apply(T.smart_cap, values) == [cap(v.lower()) for v in values]


def test_all_numeric_references(spark):
    """Every code point there is, and some beyond."""
    forms = [("&#", F.col("id").cast("string")), ("&#x00", F.hex("id")), ("&#000000000", F.col("id").cast("string"))]
    for k, (start, number) in enumerate(forms):
        for end in (";", "&"):
            codes = spark.range(0x110010).filter(f"id % 3 = {k} OR id < 300")
            packed = codes.groupBy(F.floor(F.col("id") / 2000).alias("g")).agg(
                F.array_join(F.sort_array(F.collect_list(F.concat(F.lit(start), number, F.lit(end)))), "|").alias("t")
            )
            rows = packed.select("t", X.unescape_html(F.col("t")).alias("out")).collect()
            assert all(r["out"] == html.unescape(r["t"]) for r in rows)


def test_all_named_references(apply):
    texts = [f"&{n}{end}" for n in html5 for end in ("", ";", "x;", "=", " ", "1")]
    assert apply(X.unescape_html, texts) == [html.unescape(t) for t in texts]


@pytest.mark.parametrize("size", [1, 3])
def test_normalized_titles_are_stable(apply, size):
    titles = ["Data Scientist", "UX Researcher", "Machine Learning Engineer"][:size]
    assert apply(T.normalize_title, titles) == titles

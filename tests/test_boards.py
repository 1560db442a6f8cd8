"""Hand-written payloads that hit every fallback once."""

import json

import pytest

from roleatlas.sources import boards, companies


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("slug", "seq").collect()]


@pytest.fixture
def payload(spark):
    def make(*bodies):
        data = [(f"s{i}", b if isinstance(b, str) else json.dumps(b)) for i, b in enumerate(bodies)]
        return spark.createDataFrame(data, "slug string, body string")

    return make


def test_greenhouse(payload):
    jobs = {"jobs": [
        {"title": "A", "absolute_url": "u1", "content": "<p>x</p> <p>y</p>", "location": {"name": "Rome"}, "first_published": "2024-01-02T00:00:00Z"},
        {"title": None, "absolute_url": "u2", "content": None, "location": "Oslo"},
        {"location": {}}, {"location": None},
    ]}
    found = boards.greenhouse_listings(payload(jobs, {}, "not json", {"jobs": []}))
    assert rows(found, "title", "url", "description_raw", "location", "posted_date") == [
        ("A", "u1", "x\ny", "Rome", "2024-01-02T00:00:00Z"), ("", "u2", "", "Oslo", ""),
        ("", "", "", "", ""), ("", "", "", "", ""),
    ]


def test_lever(payload):
    jobs = [
        {"id": "1", "text": " Dev ", "descriptionPlain": "plain", "description": "<b>", "categories": {"location": "Rome"},
         "workplaceType": "remote", "hostedUrl": "h", "createdAt": 1704164645000},
        {"id": "2", "text": "Ops", "descriptionPlain": "", "description": "<b>", "workplaceType": "onsite", "categories": "x"},
        {"text": "QA", "lists": [{"text": "Do", "content": "<li>a</li><li> b </li><li></li>"}, {"text": "Have", "content": None}]},
        {"id": "4", "text": ""}, {"id": "5", "text": "Careers Home"}, {"id": "6"},
    ]
    found = boards.lever_listings(payload(jobs, {"text": "Dev", "id": "9"}, []))
    assert rows(found, "title", "url", "description_raw", "location", "remote_onsite", "posted_date") == [
        ("Dev", "h", "plain", "Rome", "remote", "1704164645"),
        ("Ops", "https://jobs.lever.co/s0/2", "<b>", "", "", ""),
        ("QA", "https://jobs.lever.co/s0/", "Do\n- a\n- b\nHave", "", "", ""),
    ]


def test_ashby(payload):
    jobs = {"jobs": [
        {"id": "1", "title": "Dev", "descriptionPlain": "plain", "jobUrl": "j", "applyUrl": "a", "isRemote": True,
         "workplaceType": "Hybrid", "locationName": "Rome", "location": "x", "publishedAt": "2024-01-02T03:04"},
        {"id": "2", "title": "Ops", "descriptionHtml": "<p>a</p>b", "applyUrl": "a", "isRemote": False,
         "workplaceType": "OnSite", "location": "Oslo"},
        {"id": "3", "title": "QA"}, {"title": "X"},
    ]}
    found = boards.ashby_listings(payload(jobs, {"jobs": None}))
    assert rows(found, "title", "url", "description_raw", "location", "remote_onsite", "posted_date") == [
        ("Dev", "j", "plain", "Rome", "remote", "2024-01-02"), ("Ops", "a", "a\nb", "Oslo", "onsite", ""),
        ("QA", "https://jobs.ashbyhq.com/s0/3", "", "", "", ""), ("X", "", "", "", "", ""),
    ]


def test_workday(spark):
    base = "https://acme.wd5.myworkdayjobs.com"

    def page(*postings):
        return json.dumps({"total": 2500, "jobPostings": list(postings)})

    pages = spark.createDataFrame([
        ("acme/ext/site", base, 0, page({"title": "A", "externalPath": "/job/1", "locationsText": "Rome", "postedOn": "Today"},
                                        {"title": "B", "externalPath": "", "locationsText": None})),
        ("acme/ext/site", base, 20, page({"title": "C", "externalPath": "/job/3", "locationsText": ["x"]},
                                         {"title": "D", "externalPath": "/job/4"})),
        ("nosite", base, 0, page({"title": "E", "externalPath": "/job/5"})),
    ], "slug string, base_url string, offset long, body string")
    detail = [(f"{base}/ext/site/job/{i}", json.dumps({"jobPostingInfo": {"jobDescription": f"<p>d{i}</p> x"}})) for i in (1, 3)]
    details = spark.createDataFrame(detail, "url string, body string")
    known = spark.createDataFrame([(f"{base}/ext/site/job/3",)], "url string")
    expected = [
        (0, "A", f"{base}/ext/site/job/1", "d1 x", "Rome", "Today"), (1, "B", "", "", "", ""),
        (20, "C", f"{base}/ext/site/job/3", "d3 x", "", ""), (21, "D", f"{base}/ext/site/job/4", "", "", ""),
    ]
    fields = ("seq", "title", "url", "description_raw", "location", "posted_date")
    assert rows(boards.workday_listings(pages, details), *fields) == expected
    expected[2] = (20, "C", f"{base}/ext/site/job/3", "", "", "")
    assert rows(boards.workday_listings(pages, details, known), *fields) == expected


def test_companies(spark, tmp_path):
    assert companies.read_companies(spark, str(tmp_path / "missing.json")).count() == 0
    path = tmp_path / "companies.json"
    path.write_text(json.dumps([
        {"name": "A", "greenhouse_slug": "g", "lever_slug": "l"}, {"name": "B", "greenhouse_slug": "", "workday_slug": "w/s"},
        {"name": "C", "industry": "x"}, {"name": "D", "ashby_slug": "a"},
    ]))
    routed = companies.route_boards(companies.read_companies(spark, str(path))).orderBy("company").collect()
    assert [tuple(r) for r in routed] == [("A", "greenhouse", "g"), ("B", "workday", "w/s"), ("D", "ashby", "a")]


def test_scraped_batch_joins_companies(spark):
    listed = spark.createDataFrame(
        [("A", "g", None, None, None), ("B", None, "l", None, None)],
        "name string, greenhouse_slug string, lever_slug string, ashby_slug string, workday_slug string",
    )
    payloads = spark.createDataFrame([
        ("greenhouse", "g", json.dumps({"jobs": [{"title": "Dev", "absolute_url": "u"}]}), None, None),
        ("lever", "l", json.dumps([{"id": "1", "text": "Ops"}]), None, None),
        ("lever", "nobody", json.dumps([{"id": "1", "text": "Ops"}]), None, None),
    ], "kind string, slug string, body string, base_url string, offset long")
    details = spark.createDataFrame([], "url string, body string")
    found = boards.scraped_batch(listed, payloads, details).orderBy("company").collect()
    assert [(r["company"], r["title"], r["url"]) for r in found] == [
        ("A", "Dev", "u"), ("B", "Ops", "https://jobs.lever.co/l/1")]


def test_fetch_outcomes(spark):
    log = spark.createDataFrame([
        ("ok", 200, False, 3, 3), ("part", 200, False, 3, 2001), ("edge", 200, False, 3, 2000), ("empty", 200, False, 0, 0),
        ("gone", 404, False, 0, None), ("slow", None, True, None, None), ("fault", 500, False, 0, None), ("lost", None, False, None, None),
    ], "company string, http_status int, timed_out boolean, n_jobs long, total long")
    found = {r["company"]: (r["status"], r["partial"]) for r in companies.classify_fetch(log).collect()}
    assert found == {
        "ok": ("ok", False), "part": ("ok", True), "edge": ("ok", False), "empty": ("empty", False),
        "gone": ("stale_404", False), "slow": ("timeout", False), "fault": ("empty", False), "lost": ("error", False),
    }

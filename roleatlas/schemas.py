"""Fixed schemas of the tables and payloads."""

from __future__ import annotations

LISTING_TEXT = [
    "title", "company", "description_raw", "location", "remote_onsite",
    "seniority", "posted_date", "source_domain",
]
LISTINGS = (
    "url string, url_hash long, title string, company string, description_raw string, "
    "location string, remote_onsite string, seniority string, posted_date string, "
    "source_domain string, scraped_at timestamp, last_refreshed timestamp, is_active boolean"
)
LISTING_COLUMNS = [
    "url", "url_hash", *LISTING_TEXT, "scraped_at", "last_refreshed", "is_active",
]
VECTORS = "url_hash long, role_vec array<float>"
COMPANIES = (
    "name string, greenhouse_slug string, lever_slug string, ashby_slug string, "
    "workday_slug string, industry string, stage string, size string"
)
SCRAPED = (
    "company string, seq long, url string, title string, description_raw string, "
    "location string, remote_onsite string, posted_date string"
)
SCRAPED_COLUMNS = [
    "title", "url", "description_raw", "location", "remote_onsite", "posted_date",
]
FETCH_LOG = "company string, http_status int, timed_out boolean, n_jobs long, total long"

# Fields read from board payloads; `location` stays raw JSON where a board sends
# either an object or a bare string.
GREENHOUSE = (
    "struct<jobs: array<struct<title: string, absolute_url: string, content: string, "
    "location: string, first_published: string>>>"
)
LEVER = (
    "array<struct<id: string, text: string, descriptionPlain: string, description: string, "
    "lists: array<struct<text: string, content: string>>, categories: string, "
    "workplaceType: string, hostedUrl: string, createdAt: string>>"
)
ASHBY = (
    "struct<jobs: array<struct<id: string, title: string, descriptionPlain: string, "
    "descriptionHtml: string, jobUrl: string, applyUrl: string, isRemote: boolean, "
    "workplaceType: string, locationName: string, location: string, publishedAt: string>>>"
)
WORKDAY_PAGE = (
    "struct<total: long, jobPostings: array<struct<title: string, externalPath: string, "
    "locationsText: string, postedOn: string>>>"
)
WORKDAY_DETAIL = "struct<jobPostingInfo: struct<jobDescription: string>>"

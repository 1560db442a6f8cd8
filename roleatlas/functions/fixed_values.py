"""Fixed values.

Every word list, pattern, lookup table and constant below has to equal the
published one for results to agree, so they are stated plainly and kept in one
place.  Patterns are written with Unicode-aware ``\\w \\s \\d \\b`` in mind;
``regex.pattern`` turns them into their Java form.
"""

# --- titles: index pages -----------------------------------------------------

# Matched against the trimmed, lowercased title.
AGGREGATOR_TITLE_PATTERNS = [
    r"^\d[\d,]*\+?\s+\w+.*\bjobs?\b",
    r"^(find|browse|search|best|latest|top|new)\s+\w+.*\bjobs?\b",
    r"^(careers?|jobs?)\s+(home|opportunit|opening|search|at\s)",
    r"^join\s+(our|us)\b",
    r"^explore\s+career",
    r"^work\s+in\s+\w+\s*[-–]?\s*careers?",
    r'["“].+?["”].*\bjobs\b',
    r"^(multiple|various)\s+(positions|openings|roles|opportunities)",
    r"^(search|all|open|view|see)\s+(jobs?|positions|roles|openings)",
    r"\bjobs?\s*[&+]\s*careers?\b",
    r"^[\w\s]+(careers?|jobs?)\s*[|–-]\s*(do|join|build|discover|find)",
]
# Lowercased title, and only when the title is shorter than 100 characters.
COUNTED_JOBS_IN_PATTERN = r"^[\d,]+\s+\w[\w\s]*\bjobs?\s+in\s+"
COUNTED_JOBS_IN_MAX_LENGTH = 100
# Case-sensitive: "Acme hiring Engineers", unless the title shouts HIRING NOW.
COMPANY_HIRING_PATTERN = r"^[A-Z][\w\s,]{2,30}\s+hiring\s+[A-Z]"
HIRING_NOW = "HIRING NOW"
# Case-sensitive: "... - Indeed"; counts only when the rest speaks of jobs.
AGGREGATOR_SITE_SUFFIX_PATTERN = (
    r"[\|–-]\s*(LinkedIn|Indeed|Glassdoor|ZipRecruiter|Wellfound|"
    r"Craigslist|Zippia|Career\.io|CareerBuilder|Dice)\s*$"
)
JOBS_WORD_PATTERN = r"\bjobs?\b"
UNKNOWN = "unknown"

# --- titles: normalisation ---------------------------------------------------

# Case-insensitive.
SENIORITY_PREFIX_PATTERN = (
    r"^(?:senior|staff|principal|lead|junior|sr\.?|founding|entry[- ]level)\s+"
)
AT_SUFFIX_PATTERN = r"\s*@\s*.+$"
# Case-insensitive.
CONTRACT_SUFFIX_PATTERN = r"\s*-\s*(?:remote|contract|hybrid|onsite|on-site)$"
CITY_SUFFIX_PATTERN = r"\s*-\s*[A-Z][a-z]+(?:,?\s+[A-Z]{2})?\s*$"
# Case-insensitive.
PAREN_SUFFIX_PATTERN = r"\s*\((?:remote|contract|hybrid|m/[wfd]/d)\)\s*$"
LEVEL_SUFFIX_PATTERN = r"\s+(?:I{1,3}|IV|V|VI{0,3}|[Ll]l)$"

COMBINED_ROLE_MARKS = ["/", "&"]
TITLE_DROPLIST = [
    "intern", "recrui", "cto", "ceo", "cfo", "work from home",
    "remote opportunity", "dream", "part time", "part-time",
]
EXECUTIVE_TITLE_STARTS = ["director", "vp ", "vice president"]
EXECUTIVE_TITLE_PHRASES = ["executive director", "managing director"]
PLURAL_EVENTS = ("events ", "event ")
MIN_TITLE_LENGTH = 3
ACRONYMS = [
    "ai", "ml", "ui", "ux", "qa", "hr", "it", "bi", "vp", "pm", "sre", "api",
    "sdk", "etl", "crm", "erp", "seo", "sem", "emea", "apac", "latam", "mena",
    "devops", "devsecops", "saas", "paas", "aws", "gcp",
]

# --- URLs --------------------------------------------------------------------

SEARCH_URL_MARK = "/search?"
CATEGORY_URL_MARK = "/job-categories/"
TEAMS_URL_MARK = "/teams/"
JOB_PATH_PATTERN = r"/jobs?/"
LEVER_HOST_MARK = "jobs.lever.co/"
LEVER_DEMO_MARK = "leverdemo"
LINKEDIN_VIEW_MARK = "linkedin.com/jobs/view/"
ASHBY_HOST_MARK = "ashbyhq.com/"
GREENHOUSE_HOST_MARK = "greenhouse.io/"
GREENHOUSE_ID_MARK = "?gh_jid="
GOOGLE_HOST_MARK = "google.com/"
GOOGLE_CAREERS_MARK = "/careers/"
QUERY_PATTERN = r"\?.*$"
APPLICATION_PATTERN = r"/application\b.*$"
LEVER_POSTING_URL = "https://jobs.lever.co/"
ASHBY_POSTING_URL = "https://jobs.ashbyhq.com/"
URL_HASH_DIGEST_BYTES = 8
URL_HASH_MASK = 0x7FFFFFFFFFFFFFFF

# --- descriptions ------------------------------------------------------------

MIN_DESCRIPTION_LENGTH = 100
NAVIGATION_PHRASES = ["My career", "My applications", "My profile"]
WALL_STARTS = ["Sign in", "Log in", "Accept cookies"]
SCRIPT_NOTICES = [
    "please enable javascript", "you need to enable javascript",
    "javascript is required", "this site requires javascript",
]
SCRIPT_NOTICE_MAX_LENGTH = 500
# Replaced in this order.
LITERAL_ENTITIES = [
    ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"),
    ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
]
NUMERIC_ENTITY_PATTERN = r"&#\d+;"
NAMED_ENTITY_PATTERN = r"&\w+;"
TAG_PATTERN = r"<[^>]+>"
STORED_CONTENT_MIN_LENGTH = 50
KNOWN_CONTENT_MIN_LENGTH = 100

# --- locations ---------------------------------------------------------------

# Case-insensitive.
LOCATION_COUNT_PATTERN = r"^\d+\s+Locations?$"
LOCATION_PLACEHOLDERS = [
    "hybrid", "onsite", "on-site", "n/a", "various",
    "multiple", "tbd", "flexible", "see description",
]

# --- role text ---------------------------------------------------------------

# Case-insensitive.
ROLE_SECTION_PATTERN = (
    r"(?:about the (?:role|position|job|opportunity)|"
    r"what you'?ll do|what you'?ll be doing|"
    r"the role|role overview|role summary|"
    r"job description|position summary|position overview|"
    r"key responsibilities|primary responsibilities|core responsibilities|"
    r"responsibilities|about this role|about this position|"
    r"in this role|your role|the opportunity|"
    r"what we'?re looking for|we are looking for|we'?re hiring|"
    r"(?:key |primary )?duties)"
)
ROLE_TEXT_MAX_CHARS = 2000
ROLE_TEXT_LONG = 3000
ROLE_TEXT_LEAD_CHARS = 500
ROLE_TEXT_BODY_START = 1000
MIN_ENCODED_TEXT = 10
MIN_EMBED_INPUT = 5
EMBED_PLACEHOLDER = "untitled position"
EMBED_BATCH = 100
EMBED_DIMENSION = 768

# --- boards ------------------------------------------------------------------

BOARD_ORDER = ["greenhouse", "lever", "ashby", "workday"]
WORKDAY_MAX_TOTAL = 2000
PARTIAL_GRACE_HOURS = 24
LEVER_WORKPLACES = ["remote", "hybrid"]
ATS_DOMAIN = "ats"

# --- neighborhoods -----------------------------------------------------------

NORM_EPSILON = 1e-10
NEIGHBORS = 700
PREFETCH_FACTOR = 5
PREFETCH_EXTRA = 2000
MIN_GROUP_SIZE = 6
MAX_GROUPS = 12
MAX_CENTER_DOTS = 200
SEED = 42
ALSO_NEAR_SIZE = 20
ALSO_NEAR_DIGITS = 4
FARTHEST_POOL = 200
FARTHEST_SIZE = 5
FARTHEST_DIGITS = 3
COORDINATE_DIGITS = 4
MIN_SPAN = 1e-9
CORE_SHARE = 0.90
MIN_HULL_POINTS = 3
# The last characters are a literal quote pair: ' and ".
PLAUSIBLE_TITLE_PATTERN = r"""^[A-Za-z0-9 ,\-\(\)\.&/'"]+$"""
PLAUSIBLE_TITLE_LENGTHS = (12, 80)
ENGLISH_TITLE_WORDS = [
    "manager", "engineer", "analyst", "coordinator", "specialist",
    "associate", "assistant", "director", "lead", "head", "officer",
    "designer", "developer", "scientist", "researcher", "consultant",
    "representative", "technician", "operations", "sales", "marketing",
    "product", "data", "software", "project", "program", "senior",
    "staff", "principal",
]
PANEL_SKIP_GROUPS = [
    "unknown", "search", "career exploration", "job descriptions",
    "current job openings", "pro jobs", "jobs san francisco",
]
PANEL_SKIP_PHRASE = "jobs in"
PALETTE = [
    "#2d5a34", "#d94f1a", "#2563eb", "#b45309", "#7c3aed",
    "#0891b2", "#be185d", "#4d7c0f", "#6d28d9", "#dc2626",
    "#0d6e6e", "#92400e", "#4338ca", "#ea580c", "#0e7490",
    "#a21caf", "#65a30d",
]
BUILTIN_ROLES = [
    ("ds", "Data Scientist", ["data scientist"]),
    ("swe", "Software Engineer", ["software engineer"]),
    ("pm", "Product Manager", ["product manager"]),
    ("ux", "UX / User Experience",
     ["ux designer", "ux researcher", "user experience designer"]),
    ("em", "Event Manager", ["event manager"]),
    ("ai", "AI Engineer", ["ai engineer"]),
    ("pjm", "Project Manager", ["project manager"]),
    ("tpm", "Technical Program Manager", ["technical program manager"]),
]

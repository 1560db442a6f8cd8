"""SQL forms of the text rules, for the oracle queries."""

from __future__ import annotations

from ..functions import fixed_values as fv
from .views import _list as sql_list

SPACES = r"[\s\x1c-\x1f\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def re2(pattern: str) -> str:
    """A pattern for DuckDB, whose ``\\w`` knows ASCII only, as an SQL literal."""
    word = r"\p{L}\p{N}_"
    out = pattern.replace(r"[\w", "[" + word).replace(r"\w", f"[{word}]")
    return "'" + out.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SPACES}+|{SPACES}+$', '', 'g')"


def collapse(x: str) -> str:
    blanks = f"regexp_replace({x}, '{SPACES}+', ' ', 'g')"
    return strip(blanks)


def strip_html(x: str) -> str:
    return collapse(f"regexp_replace({x}, {re2(fv.TAG_PATTERN)}, ' ', 'g')")


def clean_description(x: str) -> str:
    for entity, plain in fv.LITERAL_ENTITIES:
        x = f"replace({x}, '{entity}', '{plain.replace(chr(39), chr(39) * 2)}')"
    for p in (fv.NUMERIC_ENTITY_PATTERN, fv.NAMED_ENTITY_PATTERN):
        x = f"regexp_replace({x}, {re2(p)}, ' ', 'g')"
    return strip_html(x)


def clean_location(x: str) -> str:
    return f"""CASE WHEN regexp_matches({strip(x)}, {re2('(?i)' + fv.LOCATION_COUNT_PATTERN)})
        OR list_contains({sql_list(fv.LOCATION_PLACEHOLDERS)}, lower({strip(x)})) THEN ''
        ELSE {strip(x)} END"""


def is_aggregator(x: str) -> str:
    t, low = strip(x), f"lower({strip(x)})"
    tests = [f"{t} = ''", f"{low} = 'unknown'"]
    tests += [f"regexp_matches({low}, {re2(p)})" for p in fv.AGGREGATOR_TITLE_PATTERNS]
    tests.append(
        f"(regexp_matches({t}, {re2(fv.COMPANY_HIRING_PATTERN)}) AND NOT contains(upper({t}), 'HIRING NOW'))"
    )
    tests.append(
        f"(regexp_matches({low}, {re2(fv.COUNTED_JOBS_IN_PATTERN)}) AND length({t}) < 100)"
    )
    site = re2(fv.AGGREGATOR_SITE_SUFFIX_PATTERN)
    tests.append(
        f"(regexp_matches({t}, {site}) AND regexp_matches(lower(regexp_replace({t}, {site}, '')), "
        f"{re2(fv.JOBS_WORD_PATTERN)}))"
    )
    return "(" + " OR ".join(tests) + ")"


def path_parts(x: str) -> str:
    path = (
        f"regexp_extract(regexp_replace({x}, '^([A-Za-z][A-Za-z0-9+.\\-]*:)?(//[^/?#]*)?', ''), '^[^?#]*')"
    )
    return f"string_split(trim({path}, '/'), '/')"


def is_garbage_url(x: str) -> str:
    u = f"lower({x})"
    return f"""(contains({u}, '/search?') OR contains({u}, '/job-categories/')
        OR (contains({u}, '/teams/') AND NOT regexp_matches({u}, '/jobs?/'))
        OR (contains({u}, 'jobs.lever.co/') AND len({path_parts(u)}) < 2)
        OR contains({u}, 'leverdemo'))"""


def clean_url(x: str) -> str:
    def when(test: str, cleaned: str, u: str) -> str:
        return f"(CASE WHEN {test} THEN {cleaned} ELSE {u} END)"

    def cut(u: str) -> str:
        return f"regexp_replace({u}, '\\?.*$', '')"

    u = when(f"contains({x}, 'linkedin.com/jobs/view/')", cut(x), x)
    u = when(f"contains({u}, 'ashbyhq.com/')", cut(f"regexp_replace({u}, '/application\\b.*$', '')"), u)
    u = when(f"contains({u}, 'greenhouse.io/') OR contains({u}, '?gh_jid=')", cut(u), u)
    u = when(f"contains({u}, 'jobs.lever.co/')", cut(u), u)
    return when(f"contains({u}, 'google.com/') AND contains({u}, '/careers/')", cut(u), u)


def is_garbage_description(x: str) -> str:
    d = strip(x)
    starts = " OR ".join(f"starts_with({d}, '{s}')" for s in fv.WALL_STARTS)
    nav = " AND ".join(f"contains({d}, '{s}')" for s in fv.NAVIGATION_PHRASES)
    marks = " OR ".join(f"contains(lower({d}), '{s}')" for s in fv.SCRIPT_NOTICES)
    return f"(length({x}) < 100 OR ({nav}) OR {starts} OR (length({d}) < 500 AND ({marks})))"


def extract_role_text(x: str, cap: int = 2000) -> str:
    """``x`` must be a column that already holds the stripped text."""
    first = f"strpos({x}, regexp_extract({x}, {re2('(?i)' + fv.ROLE_SECTION_PATTERN)}))"
    found = f"regexp_matches({x}, {re2('(?i)' + fv.ROLE_SECTION_PATTERN)})"
    return f"""CASE WHEN length({x}) <= {cap} THEN {x}
        WHEN {found} AND {first} - 1 < length({x}) // 2 THEN substring({x}, {first}, {cap})
        WHEN length({x}) > 3000 THEN substring({x}, 1, 500) || ' ' || substring({x}, 1001, {cap - 500})
        ELSE substring({x}, 1, {cap}) END"""


def smart_cap(w: str) -> str:
    edge = r"[^\p{L}\p{N}]*"
    core = f"regexp_extract({w}, '^{edge}(.*?){edge}$', 1)"
    first = f"(CASE WHEN {core}[1] = 'ß' THEN 'Ss' ELSE upper({core}[1]) END)"
    return f"""CASE WHEN {core} = '' THEN {w} ELSE regexp_extract({w}, '^{edge}')
        || CASE WHEN list_contains({sql_list(fv.ACRONYMS)}, {core}) THEN upper({core})
           ELSE {first} || substring({core}, 2) END
        || regexp_extract({w}, '{edge}$') END"""


def norm_parts(titles: str) -> dict[str, str]:
    """Parts of a WITH clause that end in ``norm(title, grp)`` over ``titles``."""
    core = strip("title")
    core = strip(f"regexp_replace({core}, {re2(fv.SENIORITY_PREFIX_PATTERN)}, '', 'i')")
    for p, flag in [
        (fv.AT_SUFFIX_PATTERN, "c"), (fv.CONTRACT_SUFFIX_PATTERN, "i"),
        (fv.CITY_SUFFIX_PATTERN, "c"), (fv.PAREN_SUFFIX_PATTERN, "i"),
        (fv.LEVEL_SUFFIX_PATTERN, "c"),
    ]:
        core = f"regexp_replace({core}, {re2(p)}, '', '{flag}')"
    reject = " OR ".join(
        f"contains(lower(title), '{w}')" for w in fv.COMBINED_ROLE_MARKS + fv.TITLE_DROPLIST
    )
    seniors = " OR ".join(f"starts_with(low, '{s}')" for s in fv.EXECUTIVE_TITLE_STARTS)
    phrases = " OR ".join(f"contains(low, '{s}')" for s in fv.EXECUTIVE_TITLE_PHRASES)
    return {
        "norm1": f"SELECT title, {core} AS core, ({reject}) AS bad FROM (SELECT DISTINCT title FROM {titles})",
        "norm2": f"SELECT title, bad, core, {strip('lower(core)')} AS low FROM norm1",
        "norm3": f"""SELECT title, replace(low, 'events ', 'event ') AS low,
            bad OR {seniors} OR {phrases} OR length(core) - length(replace(core, ',', '')) > 1 AS bad
            FROM norm2""",
        "norm": f"""SELECT title, CASE WHEN NOT bad AND length(low) >= 3 THEN
            array_to_string(list_transform(string_split_regex(low, '\\s+'), lambda w: {smart_cap('w')}), ' ')
            END AS grp FROM norm3""",
    }

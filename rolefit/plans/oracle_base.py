"""Named SQL blocks that checks are assembled from (DuckDB dialect).

Regexes of the SQL side run on text whose non-ASCII letters are replaced by ``_``: its regex engine
knows only ASCII word boundaries, and the replacement makes them fall where Unicode ones do.
"""

from __future__ import annotations

from rolefit import vocab
from rolefit.functions.text import WS
from rolefit.plans import fixtures

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'{WS}+')}, ' ', 'g')"


def strip_html(x: str) -> str:
    return strip(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')")


def fold(x: str) -> str:
    return rf"regexp_replace({x}, '[^\P{{L}}\x00-\x7F]', '_', 'g')"


def rx(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {lit('(?i)' + pattern)})"


def skill_hit(x: str, name: str) -> str:
    special = {"r": r"(^|[^a-z])r([^a-z0-9_]|$)", "java": r"\bjava\b"}
    return rx(x, special.get(name, vocab.SKILL_PATTERNS[name]))


def skills_of(folded: str) -> str:
    parts = ", ".join(f"CASE WHEN {skill_hit(folded, s)} THEN {lit(s)} END" for s in sorted(vocab.SKILL_PATTERNS))
    return f"list_filter([{parts}], lambda x: x IS NOT NULL)"


def norm_title(x: str) -> str:
    out = f"lower({x})"
    for pattern, replacement in vocab.TITLE_FOLDS:
        out = f"regexp_replace({out}, {lit(pattern)}, {lit(replacement)}, 'g')"
    return out


def title_tokens(x: str) -> str:
    return f"regexp_extract_all({norm_title(x)}, '[a-z0-9+#]+')"


def sql_list(values: list[str]) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def distinctive(x: str) -> str:
    tokens = title_tokens(x)
    kept = f"list_filter({tokens}, lambda t: t NOT IN {sql_list(vocab.GENERIC_TITLE_TOKENS)})"
    return f"CASE WHEN len({kept}) > 0 THEN {kept} ELSE {tokens} END"


def csv(x: str) -> str:
    return f"list_filter(string_split({x}, ','), lambda t: t <> '')"


def level(x: str, unknown: int) -> str:
    return f"CASE {x} WHEN 'junior' THEN 0 WHEN 'mid' THEN 1 WHEN 'senior' THEN 2 WHEN 'staff' THEN 3 ELSE {unknown} END"


def seniority_case(folded: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({folded}, {lit(p)}) THEN {lit(n)}" for n, p in vocab.SENIORITY_PATTERNS)
    return f"CASE {whens} ELSE 'mid' END"


def stated_years(x: str) -> str:
    return (f"coalesce(list_max(list_transform(regexp_extract_all({x}, {lit('(?i)' + vocab.YEARS_PATTERN)}, 1), "
            "lambda y: try_cast(y AS INTEGER))), 0)")


KNOWN_LARGE = " OR ".join(f"contains(lower(company), {lit(n)})" for n in vocab.LARGE_EMPLOYERS)
DEFAULT_W = "{" + ", ".join(f"'{s}': {vocab.DEFAULT_WEIGHTS[s]}e0" for s in vocab.SIGNALS) + "}"


def _weights(shape: int) -> str:
    given = fixtures.BASE_WEIGHTS[shape]
    return "{" + ", ".join(f"'{s}': {given.get(s, 0.0)}e0" for s in vocab.SIGNALS) + "}"


def score_sum(weights: str, signals: str) -> str:
    total = "0e0"
    for s in vocab.SIGNALS:
        total = f"({total} + {weights}.{s} * {signals}.{s})"
    return total


WORD_IN = "len(list_filter({words}, lambda t: regexp_matches({text}, '\\b' || regexp_escape(lower(t)) || '\\b'))) > 0"

_PLAIN = {t: t for t in TABLES}

# name -> (blocks it reads, SQL)
BLOCKS: dict[str, tuple[list[str], str]] = {
    "raw": ([], fixtures.POSTINGS_SQL.format(**_PLAIN)),
    "norm0": (["raw"], f"""
        SELECT seq, {strip("coalesce(name, '')")} AS title, {strip("coalesce(company, 'Unknown')")} AS company,
         {strip("coalesce(location, '')")} AS location, {strip("coalesce(country, '')")} AS country,
         salary_min, salary_max, {strip_html("coalesce(text, '')")} AS description,
         coalesce(url, '') AS url, coalesce(source, 'kaggle') AS source, coalesce(dateadded, '') AS posted_date
        FROM raw"""),
    "norm1": (["norm0"], f"""
        SELECT *, {fold("title || '. ' || description")} AS fblob,
         substr(md5(lower(title) || '|' || lower(company) || '|' || lower(location) || '|' || substr({collapse("lower(description)")}, 1, 120)), 1, 16) AS job_id
        FROM norm0 WHERE title <> '' OR description <> ''"""),
    "normalized": (["norm1"], f"SELECT *, {skills_of('fblob')} AS skills FROM norm1"),
    "postings": (["normalized"], "SELECT * FROM normalized QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY seq) = 1"),
    "enriched0": (["postings"], f"SELECT *, {seniority_case(fold("lower(title || ' ' || description)"))} AS seniority FROM postings"),
    "enriched": (["enriched0"], f"""
        SELECT *, greatest({stated_years('description')}, CASE seniority WHEN 'senior' THEN 5 WHEN 'staff' THEN 8 ELSE 0 END) AS years_required,
         {rx('fblob', vocab.CONTRACT_PATTERN)} AS is_contract,
         CASE WHEN {rx('fblob', vocab.NO_SPONSOR_PATTERN)} THEN FALSE WHEN {rx('fblob', vocab.SPONSOR_PATTERN)} THEN TRUE END AS sponsors_visa,
         {rx('fblob', vocab.DEFENSE_PATTERN)} AS is_defense,
         CASE WHEN {KNOWN_LARGE} THEN 'large' WHEN {rx('fblob', vocab.SMALL_PATTERN)} THEN 'small'
              WHEN {rx('fblob', vocab.LARGE_PATTERN)} THEN 'large' ELSE 'unknown' END AS company_size,
         coalesce((salary_min + salary_max) / 2, salary_min, salary_max) AS salary_value
        FROM enriched0"""),
    "vecs": ([], "SELECT vec_id, embedding::DOUBLE[] AS vec FROM embeddings"),
    "posting_vectors": (["postings", "vecs"], """
        SELECT job_id, vec FROM postings JOIN vecs ON vec_id = (seq // 2) % (SELECT count(*) FROM embeddings)"""),
    "profiles0": ([], fixtures.PROFILES_SQL.format(**_PLAIN)),
    "profiles": (["profiles0"], f"""
        SELECT * EXCLUDE (exclude_defense, has_publications), {csv('skills_csv')} AS skills, {csv('roles_csv')} AS target_roles, {csv('locations_csv')} AS locations,
         {csv('preferred_csv')} AS preferred, {csv('emphasis_csv')} AS emphasis, exclude_defense, has_publications,
         CASE shape {" ".join(f"WHEN {n} THEN {_weights(n)}" for n in fixtures.BASE_WEIGHTS)} ELSE {DEFAULT_W} END AS weights
        FROM profiles0"""),
    "profile_vectors": (["profiles", "vecs"], "SELECT profile_id, vec FROM profiles JOIN vecs USING (vec_id)"),
    "sims": (["profile_vectors", "posting_vectors"], """
        SELECT p.profile_id, j.job_id, round(list_cosine_similarity(p.vec, j.vec), 9) AS similarity
        FROM profile_vectors p, posting_vectors j"""),
    "candidates": (["sims"], """
        SELECT profile_id, job_id, similarity,
         CAST(row_number() OVER (PARTITION BY profile_id ORDER BY similarity DESC, job_id) AS INTEGER) AS candidate_rank
        FROM sims QUALIFY candidate_rank <= 1000"""),
    "loc_hits": (["enriched", "profiles"], f"""
        SELECT l.location, w.locations, w.preferred,
         (len(w.locations) = 0 OR (list_contains(w.locations, 'remote') AND contains(lower(l.location), 'remote'))
          OR {WORD_IN.format(words='w.locations', text='lower(l.location)')}) AS wanted,
         CASE WHEN len(w.preferred) = 0 THEN 0.5e0
          WHEN (list_contains(w.preferred, 'remote') AND contains(lower(l.location), 'remote'))
           OR {WORD_IN.format(words='w.preferred', text='lower(l.location)')} THEN 1e0 ELSE 0.3e0 END AS s_location
        FROM (SELECT DISTINCT location FROM enriched) l, (SELECT DISTINCT locations, preferred FROM profiles) w"""),
    "title_hits": (["enriched", "profiles"], f"""
        SELECT title, target_roles, CASE WHEN len(toks) = 0 OR len(target_roles) = 0 THEN 0e0 ELSE
          list_max(list_transform(target_roles, lambda r: len(list_filter({distinctive('r')}, lambda t: list_contains(toks, t)))
            / greatest(1, len({distinctive('r')}))::DOUBLE)) END AS s_title
        FROM (SELECT DISTINCT title, {title_tokens('title')} AS toks FROM enriched), (SELECT DISTINCT target_roles FROM profiles)"""),
    "attrs": (["enriched"], f"SELECT * EXCLUDE (seq, fblob), {level('seniority', 1)} AS lvl FROM enriched"),
    "prof": (["profiles"], f"""
        SELECT profile_id, name AS p_name, resume_text AS p_resume, skills AS p_skills, target_roles, locations, preferred, emphasis,
         us_only, min_salary, exclude_defense, no_contract, needs_visa_sponsor, min_company_size, max_years_required,
         CASE WHEN max_seniority <> '' THEN {level('max_seniority', 99)} END AS cap,
         CASE WHEN min_seniority <> '' THEN {level('min_seniority', 0)} END AS flr, weights
        FROM profiles"""),
    "pairs": (["candidates", "attrs", "prof", "loc_hits", "title_hits"], """
        SELECT c.*, a.* EXCLUDE (job_id), p.* EXCLUDE (profile_id), l.wanted, l.s_location, t.s_title,
         (min_salary = 0 OR coalesce(salary_value >= min_salary, TRUE)) AS f_salary,
         (NOT us_only OR country = '' OR lower(country) IN ('us', 'usa', 'united states') OR contains(lower(a.location), 'united states')
           OR contains(lower(a.location), 'usa') OR contains(lower(a.location), ', us')) AS f_us_only,
         l.wanted AS f_locations,
         NOT (no_contract AND is_contract) AS f_contract,
         (coalesce(lvl <= cap, TRUE) AND coalesce(lvl >= flr, TRUE)) AS f_seniority,
         coalesce(years_required <= max_years_required, TRUE) AS f_years,
         NOT (exclude_defense AND is_defense) AS f_industry,
         coalesce(NOT (min_company_size = 'large' AND company_size = 'small'), TRUE) AS f_company_size,
         coalesce(NOT needs_visa_sponsor OR sponsors_visa, TRUE) AS f_visa,
         {'similarity': similarity,
          'skills': len(list_intersect(a.skills, p_skills)) / greatest(1, len(p_skills))::DOUBLE,
          'title': s_title,
          'salary': CASE WHEN min_salary = 0 OR salary_value IS NULL THEN 0.5e0 WHEN salary_value >= min_salary THEN 1e0 ELSE 0e0 END,
          'seniority': CASE WHEN cap IS NOT NULL THEN CASE WHEN lvl <= cap THEN 1e0 ELSE 0e0 END
                            WHEN flr IS NOT NULL THEN CASE WHEN lvl >= flr THEN 1e0 ELSE 0e0 END ELSE 0.5e0 END,
          'location': s_location,
          'experience': CASE WHEN max_years_required IS NULL THEN 0.5e0 WHEN years_required > max_years_required THEN 0e0
                             ELSE 1e0 - 0.5e0 * (years_required / greatest(1, max_years_required)::DOUBLE) END,
          'company_size': CASE company_size WHEN 'large' THEN 1e0 WHEN 'small' THEN 0e0 ELSE 0.5e0 END} AS bd
        FROM candidates c JOIN attrs a USING (job_id) JOIN prof p USING (profile_id)
         JOIN loc_hits l ON l.location = a.location AND l.locations = p.locations AND l.preferred = p.preferred
         JOIN title_hits t ON t.title = a.title AND t.target_roles = p.target_roles"""),
    "scored": (["pairs"], f"""
        SELECT *, round({score_sum('weights', 'bd')}, 12) AS score FROM pairs
        WHERE f_salary AND f_us_only AND f_locations AND f_contract AND f_seniority AND f_years AND f_industry AND f_company_size AND f_visa"""),
    "ranked": (["scored"], """
        SELECT *, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY score DESC, job_id) AS INTEGER) AS rank FROM scored
        QUALIFY rank <= 50"""),
    "feedback": ([], fixtures.FEEDBACK_SQL.format(**_PLAIN)),
}


def assemble(final: str, *needed: str, blocks: dict | None = None, recursive: bool = False) -> str:
    """WITH clause holding the needed blocks and all they read, then the final SELECT."""
    known = dict(BLOCKS, **(blocks or {}))
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for dependency in known[name][0]:
            visit(dependency)
        ordered.append(name)

    for name in needed:
        visit(name)
    if not ordered:
        return final
    body = ",\n".join(f"{name} AS {'' if recursive and known[name][1].lstrip().startswith('/*r*/') else 'MATERIALIZED '}({known[name][1]})" for name in ordered)
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n{final}"

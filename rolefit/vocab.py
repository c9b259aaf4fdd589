"""Word lists, patterns and constants the results depend on.

Everything in this module is data. The lists keep their natural (published) order because
that order is part of the semantics: keyword hits are reported in vocabulary order.
Users can pass their own tables to every function that reads one of these.
"""

# --- canonical posting columns -------------------------------------------------------------
# Names and order of the columns that results have.
CANONICAL_FIELDS = [
    "job_id", "title", "company", "location", "country", "salary_min", "salary_max",
    "description", "skills", "url", "source", "posted_date",
]

# Raw column names accepted for each canonical column, first present wins.
COLUMN_ALIASES = {
    "title": ["name", "title", "jobtitle", "job_title", "position"],
    "company": ["company", "orgcompany", "org_company", "employer", "company_name", "companyname"],
    "location": ["location", "city", "joblocation", "place", "locality", "area", "region"],
    "country": ["country", "countrycode", "country_code", "nation"],
    "salary_min": ["salary_min", "salarymin", "min_salary", "salary_lower"],
    "salary_max": ["salary_max", "salarymax", "max_salary", "salary_upper"],
    "description": ["text", "description", "jobdescription", "job_description", "details", "content", "html"],
    "url": ["url", "link", "applyurl", "apply_url", "redirect_url", "joburl", "source_url"],
    "posted_date": ["dateadded", "date_added", "posted", "posted_date", "created", "date", "datecreated"],
    "source": ["source", "site", "board", "via"],
    "skills": ["skills", "skill", "tags", "keywords"],
}

# Countries whose postings count as English when no locale is given.
ENGLISH_COUNTRIES = ["us", "uk", "gb", "ca", "au", "ie", "nz", "in", "sg", "za"]

# Skill vocabulary, canonical name -> pattern of surface forms.
SKILL_PATTERNS = {
    "python": r"\bpython\b",
    "r": r"(?<![a-z])r(?![a-z])(?=\b)",
    "sql": r"\bsql\b",
    "pandas": r"\bpandas\b",
    "numpy": r"\bnumpy\b",
    "scikit-learn": r"\b(scikit[- ]?learn|sklearn)\b",
    "pytorch": r"\b(pytorch|torch)\b",
    "tensorflow": r"\b(tensorflow|keras)\b",
    "deep learning": r"\bdeep learning\b",
    "machine learning": r"\b(machine learning|ml engineer|ml engineering)\b",
    "nlp": r"\b(nlp|natural language processing)\b",
    "computer vision": r"\b(computer vision|opencv)\b",
    "spark": r"\b(spark|pyspark)\b",
    "kafka": r"\bkafka\b",
    "hadoop": r"\bhadoop\b",
    "aws": r"\b(aws|amazon web services)\b",
    "gcp": r"\b(gcp|google cloud)\b",
    "azure": r"\bazure\b",
    "kubernetes": r"\b(kubernetes|k8s)\b",
    "docker": r"\bdocker\b",
    "microservices": r"\bmicroservices?\b",
    "java": r"\bjava\b(?!script)",
    "c++": r"\bc\+\+\b",
    "scala": r"\bscala\b",
    "tableau": r"\btableau\b",
    "power bi": r"\bpower\s?bi\b",
    "excel": r"\bexcel\b",
    "etl": r"\b(etl|elt|data pipeline)\b",
    "airflow": r"\bairflow\b",
    "mlops": r"\bmlops\b",
    "statistics": r"\b(statistics|statistical)\b",
    "data analysis": r"\b(data analysis|analytics)\b",
    "deep reinforcement": r"\b(reinforcement learning|rl)\b",
}

# Our own hints, not semantics: a text that contains none of a skill's cues (lower case) cannot
# match its pattern, so the pattern is never run on it. Skills without cues always run it.
SKILL_CUES = {
    "python": ["python"], "sql": ["sql"], "pandas": ["pandas"], "numpy": ["numpy"],
    "scikit-learn": ["scikit", "sklearn"], "pytorch": ["torch"],
    "tensorflow": ["tensorflow", "keras"], "deep learning": ["deep learning"],
    "machine learning": ["machine learning", "ml engineer"],
    "nlp": ["nlp", "natural language"], "computer vision": ["computer vision", "opencv"],
    "spark": ["spark"], "kafka": ["kafka"], "hadoop": ["hadoop"],
    "aws": ["aws", "amazon web"], "gcp": ["gcp", "google cloud"], "azure": ["azure"],
    "kubernetes": ["kubernetes", "k8s"], "docker": ["docker"],
    "microservices": ["microservice"], "java": ["java"], "c++": ["c++"], "scala": ["scala"],
    "tableau": ["tableau"], "power bi": ["power"], "excel": ["excel"],
    "etl": ["etl", "elt", "data pipeline"], "airflow": ["airflow"], "mlops": ["mlops"],
    "statistics": ["statistic"], "data analysis": ["data analysis", "analytics"],
    "deep reinforcement": ["reinforcement", "rl"],
}

# Seniority levels in order of precedence; no hit means "mid".
SENIORITY_PATTERNS = [
    ("staff", r"\b(staff|principal|distinguished)\b"),
    ("senior", r"\b(senior|sr\.?|lead)\b"),
    ("junior", r"\b(junior|jr\.?|entry[- ]level|intern|new grad|graduate)\b"),
]
SENIORITY_ORDER = {"junior": 0, "mid": 1, "senior": 2, "staff": 3}
IMPLIED_YEARS = {"senior": 5, "staff": 8}
YEARS_PATTERN = r"(\d+)\s*\+?\s*(?:years?|yrs?)"

# Text cues of the derived flags.
CONTRACT_PATTERN = (
    r"\b(?:contract|contractor|contract[- ]to[- ]hire|c2c|corp[- ]to[- ]corp|1099"
    r"|temp(?:orary)?|part[- ]time|freelance)\b"
    r"|\bduration\s*[:\-]?\s*\d+\s*\+?\s*(?:months?|mos?|weeks?|years?|yrs?)\b"
    r"|\b\d+\s*[-+]?\s*(?:month|week|yr|year)s?\s+(?:contract|engagement|assignment|project|gig)\b"
    r"|\bunpaid\s+(?:intern(?:ship)?|position|role|opportunity|work)\b"
    r"|\bvolunteer\s+(?:intern(?:ship)?|position|role|opportunity)\b"
    r"|\b(?:no|without)\s+compensation\b"
)
NO_SPONSOR_PATTERN = (
    r"(?:"
    r"\bno\s+(?:visa\s+|h-?1b\s+)?sponsor"
    r"|\bnot\s+(?:able|in a position|willing|currently able)\s+to\s+sponsor"
    r"|\b(?:cannot|can'?t|unable to|won'?t|will not|do(?:es)? not|are not able to)\s+"
    r"(?:currently\s+)?(?:provide|offer|support|extend|consider)?\s*(?:visa\s+)?sponsor"
    r"|\bwithout\s+(?:visa\s+)?sponsor"
    r"|\bsponsorship\s+(?:is\s+)?(?:not\s+available|unavailable|not\s+provided|not\s+offered)"
    r"|\bno\s+(?:c2c|corp[- ]to[- ]corp)\b"
    r"|\bauthoriz(?:ed|ation)\s+to\s+work[^.]{0,40}without\s+sponsor"
    r"|\b(?:us|u\.s\.?)\s+citizens?\s+only\b"
    r"|\bmust\s+be\s+(?:a\s+)?(?:us|u\.s\.?)\s+citizen"
    r")"
)
SPONSOR_PATTERN = r"\b(?:h-?1b|sponsor(?:ship)? (?:is )?(?:available|provided|offered)|will sponsor)\b"
DEFENSE_PATTERN = r"\b(?:defen[cs]e|military|lockheed|raytheon|northrop|weapons?|aerospace defen)\b"
SMALL_PATTERN = r"\b(?:early[- ]stage|seed|tiny|small (?:startup|team)|<\s*\d{1,2}\s*employees|stealth)\b"
LARGE_PATTERN = r"\b(?:fortune|enterprise|\d{3,}\+? employees|large (?:company|team)|publicly traded)\b"

# Our own hints like SKILL_CUES: every way to match a pattern above contains one of its cues.
FLAG_CUES = {
    "staff": ["staff", "principal", "distinguished"],
    "senior": ["senior", "sr", "lead"],
    "junior": ["junior", "jr", "entry", "intern", "grad"],
    "contract": ["contract", "c2c", "corp", "1099", "temp", "part-time", "part time", "freelance", "duration", "engagement",
                 "assignment", "project", "gig", "unpaid", "volunteer", "compensation"],
    "no_sponsor": ["sponsor", "c2c", "corp", "citizen"],
    "sponsor": ["sponsor", "h1b", "h-1b"],
    "defense": ["defen", "military", "lockheed", "raytheon", "northrop", "weapon"],
    "small": ["early", "seed", "tiny", "small", "<", "stealth"],
    "large": ["fortune", "enterprise", "employees", "large", "publicly"],
}

# Employers known to be large, matched as substrings of the lower-cased name.
LARGE_EMPLOYERS = [
    "google", "alphabet", "youtube", "amazon", "aws", "apple", "microsoft", "meta",
    "facebook", "instagram", "oracle", "ibm", "intel", "nvidia", "amd", "qualcomm", "cisco",
    "salesforce", "adobe", "sap", "netflix", "uber", "lyft", "airbnb", "paypal", "stripe",
    "linkedin", "tesla", "spacex", "deloitte", "accenture", "pwc", "pricewaterhouse", "kpmg",
    "ernst", "jpmorgan", "jp morgan", "goldman", "morgan stanley", "wells fargo",
    "bank of america", "citigroup", "citibank", "american express", "capital one", "visa",
    "mastercard", "comcast", "verizon", "at&t", "t-mobile", "walmart", "target", "costco",
    "home depot", "disney", "warner", "booz allen", "lockheed", "raytheon", "northrop",
    "boeing", "general electric", "ford", "general motors", "johnson & johnson", "pfizer",
    "unitedhealth", "cvs", "kaiser", "intuit", "workday", "servicenow", "snowflake",
    "databricks", "palantir", "dell", "hewlett", "nike", "starbucks", "mcdonald", "pepsico",
    "coca-cola", "procter", "honeywell", "caterpillar", "fedex", "ups", "marriott", "hilton",
    "wipro", "infosys", "tcs", "tata", "cognizant", "capgemini", "indeed", "spotify",
]

# Scoring signals in their fixed order with default weights.
SIGNALS = ["similarity", "skills", "title", "salary", "seniority", "location", "experience", "company_size"]
DEFAULT_WEIGHTS = {
    "similarity": 0.38, "skills": 0.25, "title": 0.24, "salary": 0.04,
    "seniority": 0.04, "location": 0.05, "experience": 0.0, "company_size": 0.0,
}

# Title words that say nothing about the field of work.
GENERIC_TITLE_TOKENS = [
    "engineer", "engineering", "senior", "sr", "jr", "junior", "staff", "lead", "principal",
    "manager", "management", "analyst", "developer", "development", "specialist", "consultant",
    "architect", "associate", "intern", "i", "ii", "iii", "iv", "of", "the", "and", "a", "an",
    "for", "to", "in",
]
# Title spellings folded before tokenising, applied in order to lower-cased text.
TITLE_FOLDS = [
    (r"machine\s+learning", "ml"),
    (r"artificial\s+intelligence", "ai"),
    (r"\bml\s*ops\b", "mlops"),
    (r"\bm\.?l\.?\b", "ml"),
]
US_COUNTRIES = ["us", "usa", "united states"]
US_LOCATION_HINTS = ["united states", "usa", ", us"]

# Labels of the signals that explanations mention.
EXPLAIN_LABELS = ["similarity", "skills", "title", "salary", "seniority"]

# Dealbreaker labels of profile payloads.
DEALBREAKERS = [
    "US only", "No contract/temp", "No defence/military",
    "No Senior/Staff titles", "No Junior titles", "Needs visa sponsor",
]
# Locations always offered by the pickers.
COMMON_LOCATIONS = [
    "remote", "united states", "new york", "san francisco",
    "los angeles", "seattle", "boston", "austin", "chicago",
]

# Keyword vocabulary of applicant-tracking systems, in matching order.
ATS_KEYWORDS = [
    "financial modeling", "financial modelling", "financial analysis", "variance analysis",
    "forecasting", "budgeting", "financial planning", "fp&a", "p&l", "profit and loss",
    "gaap", "reconciliation", "accounts payable", "accounts receivable", "month-end close",
    "cost analysis", "revenue analysis", "valuation", "audit", "financial reporting",
    "cash flow", "general ledger", "accruals", "cost accounting",
    "data analysis", "data analytics", "business intelligence", "data visualization",
    "dashboards", "reporting", "kpis", "key performance indicators", "data warehouse",
    "etl", "data pipeline", "data modeling", "predictive modeling", "statistical analysis",
    "regression", "a/b testing", "experimentation", "forecasting models", "segmentation",
    "data cleaning", "data wrangling", "ad hoc analysis", "stakeholder management",
    "requirements gathering", "process improvement", "data governance", "data quality",
    "sql", "python", "tableau", "power bi", "looker", "excel", "vba", "sas", "spss",
    "alteryx", "snowflake", "dbt", "airflow", "spark", "hadoop", "aws", "azure", "gcp",
    "salesforce", "google analytics", "looker studio", "bigquery", "redshift",
    "machine learning", "deep learning", "nlp", "pytorch", "tensorflow", "scikit-learn",
    "docker", "kubernetes", "git", "rest api", "microservices",
    "cross-functional", "communication", "presentation", "problem solving",
    "project management", "agile", "stakeholder", "stakeholders", "collaboration",
    "requirements", "dashboard", "kpi", "analyst", "analytics",
    "banking", "finance", "financial", "accounting", "modeling", "modelling",
    "testing", "quality assurance", "qa", "user stories", "use cases",
    "mysql", "postgresql", "sql server", "pivot tables", "vlookup", "macros",
    "powerpoint", "presentations", "wireframes", "business analyst", "data analyst",
    "documentation", "metrics", "insights", "visualization",
]
# Skill names the list above lacks are keywords too.
ATS_VOCABULARY = ATS_KEYWORDS + [s for s in SKILL_PATTERNS if s not in ATS_KEYWORDS]

# Feedback rewards and learner constants.
REWARDS = {"accept": 1.0, "reject": -1.0, "skip": -0.2}
LEARNING_RATE = 0.15
EPSILON = 0.2
BASELINE_START = 0.5
BASELINE_KEEP = 0.8

# Sentences of the tailored texts and of explanations, with named blanks.
SUMMARY_TEXT = (
    "{focus}{role} targeting {roles}. Hands-on strength in {strength}. Strong fit for the {title} role at {company}, "
    "bringing directly relevant experience and a track record of turning data into decisions."
)
OPENING_TEXT = (
    "I am excited to apply for the {title} position at {company}. As {role} with hands-on experience in {strength}, "
    "I am confident I can contribute from day one."
)
CLOSING_TEXT = (
    "What draws me to this role is the alignment between your requirements and my strengths in {strength}. "
    "I would welcome the opportunity to discuss how I can help {company} succeed."
)
REASON_TEXTS = {
    "skills": "Matches {n} of your skills: {names}",
    "similarity": "Strong semantic match to your profile ({percent}%)",
    "title": "Title aligns with your target roles",
    "salary": "Meets your salary requirement",
    "seniority": "Seniority level matches your preference",
}
REASON_FALLBACK = "Relevant to your profile"

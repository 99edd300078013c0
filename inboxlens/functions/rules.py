"""The vocabularies, patterns and labels that define the results.

Words and patterns are stated in the warehouse's regex dialect (RE2); see
:mod:`inboxlens.functions.regex` for how they run on the JVM.
"""

# --- fixed values: which mail is about a job search (substring search) -------

SENDER_WORDS = (
    "jobs-noreply@linkedin",
    "greenhouse",
    "lever",
    "ashby",
    "workday",
    "smartrecruiters",
    "indeed",
    "jobs",
    "recruit",
    "ziprecruiter",
    "wellfound",
)
SUBJECT_WORDS = (
    "job",
    "application",
    "interview",
    "recruiter",
    "position",
    "opportunity",
    "career",
    "hiring",
)
SNIPPET_WORDS = (
    "application",
    "resume",
    "cv",
    "interview",
    "hiring manager",
)
PROMOTIONS_LIKE = "%category_promotions%"

# --- fixed values: mail categories, in order of precedence (whole phrases) ---

OFFER = "offer"
REJECTION = "rejection"
INTERVIEW = "interview scheduling"
APPLIED = "applications submitted"
RECRUITER = "recruiter outreach"
OTHER = "other"

CATEGORY_PHRASES = (
    (
        OFFER,
        (
            "offer",
            "congratulations",
            "pleased to offer",
            "we are excited to offer",
        ),
    ),
    (
        REJECTION,
        (
            "unfortunately",
            "not moving forward",
            "decided to proceed with other candidates",
            "not selected",
            "rejection",
            "move forward with other candidates",
        ),
    ),
    (
        INTERVIEW,
        (
            "interview",
            "schedule a call",
            "availability",
            "available times",
            "calendar invite",
            "meet with",
            "phone screen",
            "technical screen",
        ),
    ),
    (
        APPLIED,
        (
            "application received",
            "thank you for applying",
            "your application",
            "submitted",
            "confirmation",
        ),
    ),
    (
        RECRUITER,
        (
            "recruiter",
            "sourcer",
            "talent acquisition",
            "opportunity",
            "hiring for",
            "came across your profile",
            "open role",
        ),
    ),
)
BODY_REJECTION_PHRASES = (
    "unfortunately",
    "not moving forward",
    "decided to proceed with other candidates",
    "not selected",
)

CATEGORIES = (OFFER, REJECTION, INTERVIEW, APPLIED, RECRUITER, OTHER)

# --- fixed values: rank of a category when picking a thread's status ---------

STATUS_RANK = {
    OFFER: 6,
    REJECTION: 5,
    INTERVIEW: 4,
    APPLIED: 3,
    RECRUITER: 2,
}

# --- fixed values: outcome buckets -------------------------------------------

OUTCOMES = (
    "offer",
    "rejection",
    "interview",
    "no_response",
    "application",
    "recruiter",
    "other",
)
PILL_OUTCOMES = ("interview", "offer", "rejection", "no_response")
NO_RESPONSE_DAYS = 14

# --- fixed values: sender and body patterns ----------------------------------

SENDER_DOMAIN = r"@([^>\s]+)"
SENDER_DISPLAY = r'^\s*"?([^"<]+?)"?\s*<'
GENERIC_SUFFIX = (
    r"(?i)\s*(careers|recruiting|recruitment|talent(?:\s+acquisition)?|team|jobs"
    r"|hiring(?:\s+team)?|hr|people(?:\s+team)?|no[\s\-]?reply)\s*$"
)
BODY_HEAD_CHARS = 1500
DISPLAY_LENGTH = (2, 60)

# Extraction patterns, each with words of which a matching text must hold one.
COMPANY_IN_SUBJECT = (
    r"(?i)\b(?:to|at|with|joining|join)\s+"
    r"([A-Z][A-Za-z0-9&\.\-]*(?:\s+[A-Z][A-Za-z0-9&\.\-]*){0,3})",
    ("to", "at", "with", "join"),
)
COMPANY_IN_BODY = (
    r"(?i)(?:thank you for (?:your interest in|applying to)"
    r"|application (?:to|for|received at)|interest in (?:joining|working at))\s+"
    r"([A-Z][A-Za-z0-9&\.\-]*(?:\s+[A-Z][A-Za-z0-9&\.\-]*){0,3})",
    ("thank you for ", "application ", "interest in "),
)
DOMAIN_LABEL = r"^([A-Za-z0-9\-]+)\."

ROLE_APPLYING_SUBJECT = (
    r"(?i)applying\s+for(?:\s+the)?\s+([A-Za-z0-9&/\-\s]+?)(?:\s+(?:role|position|at)\b|$)",
    ("applying",),
)
ROLE_FOR_THE_SUBJECT = (
    r"(?i)\bfor\s+the\s+([A-Za-z0-9&/\-\s]+?)\s+(?:role|position)\b",
    ("role", "position"),
)
ROLE_AT_SUBJECT = (
    r"(?i)\b([A-Z][A-Za-z0-9&/\-\s]+?)\s+(?:position|role|opportunity)\s+at\b",
    ("position", "role", "opportunity"),
)
ROLE_APPLYING_BODY = (
    r"(?i)applying\s+for(?:\s+the)?\s+([A-Za-z0-9&/\-\s]+?)\s+(?:role|position)\b",
    ("applying",),
)

# --- fixed values: source systems by sender domain, in order -----------------

SOURCE_DOMAINS = (
    ("Greenhouse", ("greenhouse.io",)),
    ("Lever", ("lever.co",)),
    ("Ashby", ("ashbyhq.com",)),
    ("Workday", ("myworkday.com", "workday.com")),
    ("SmartRecruiters", ("smartrecruiters.com",)),
    ("iCIMS", ("icims.com",)),
    ("BambooHR", ("bamboohr.com",)),
    ("Recruitee", ("recruitee.com",)),
    ("Jobvite", ("jobvite.com",)),
    ("Taleo", ("taleo.net",)),
    ("Workable", ("workable.com",)),
    ("Breezy", ("breezy.hr",)),
    ("LinkedIn", ("linkedin.com",)),
    ("Indeed", ("indeed.com",)),
    ("ZipRecruiter", ("ziprecruiter.com",)),
    ("Wellfound", ("wellfound.com",)),
    ("Hire", ("hire.com",)),
)
DIRECT = "Direct"

# Domains whose first label is not the name of an employer.
NOT_AN_EMPLOYER = (
    "greenhouse.io",
    "lever.co",
    "ashbyhq.com",
    "myworkday.com",
    "smartrecruiters.com",
    "icims.com",
    "bamboohr.com",
    "recruitee.com",
    "jobvite.com",
    "taleo.net",
    "workable.com",
    "breezy.hr",
    "linkedin.com",
    "indeed.com",
    "ziprecruiter.com",
    "wellfound.com",
    "hire.com",
    "gmail.com",
    "googlemail.com",
)

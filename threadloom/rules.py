"""Rule tables as data.

Every classifier takes its table as an argument and defaults to the one here, so
a different rule set is a different argument, never an edit of the code.
"""

from __future__ import annotations

# Topic patterns. Per topic, groups of whole-word phrases with a weight.
TOPIC_PATTERNS = {
    "debugging": [
        (["error", "exception", "stack trace", "traceback", "crash", "segfault", "segmentation"], 2.0),
        (["fails", "does not work", "not working", "doesn't work"], 1.6),
        (["null pointer", "nullreference", "undefined"], 1.4),
    ],
    "conceptual": [
        (["how does", "how do", "what is", "explain", "concept", "why"], 1.5),
        (["theory", "conceptual", "principle", "intuitively"], 1.2),
    ],
    "best_practice": [
        (["best way", "best practice", "best approach", "recommended", "preferable", "optimise", "optimize"], 1.7),
        (["performance", "efficient", "scalable", "safe"], 1.3),
    ],
    "configuration": [
        (["config", "configuration", "settings", "setup", "environment", "install", "deploy", "docker",
          "kubernetes", "service"], 1.6),
    ],
    "version_specific": [
        (["version", r"v\d+", r"python\s*\d", r"java\s*\d", r"php\s*\d", r"net\s*\d"], 1.6),
        (["deprecated", "since", "removed", "legacy"], 1.2),
    ],
}

# Topic keywords, each worth KEYWORD_WEIGHT once per text.
TOPIC_KEYWORDS = {
    "debugging": ["error", "exception", "stack", "traceback", "crash", "fail"],
    "conceptual": ["explain", "concept", "why", "intuition"],
    "best_practice": ["best", "recommend", "efficient", "optimize", "pattern"],
    "configuration": ["config", "environment", "install", "deploy", "docker", "service"],
    "version_specific": ["version", "deprecated", "since", "v"],
}
# Fixed value.
KEYWORD_WEIGHT = 0.25
# Fixed value.
TOPIC_THRESHOLD = 0.55

# Words left out of the token set before keywords are matched.
STOPWORDS = [
    "the", "is", "in", "and", "to", "of", "a", "for", "on", "with", "that",
    "this", "it", "an", "as", "are", "be", "by", "or", "from", "not", "have",
]

# Substrings that hint at a code language; ties go to the first language.
LANGUAGE_HINTS = {
    "python": ["def", "import", "self", "none", "lambda", "async", "await", "print"],
    "java": ["public", "static", "void", "class", "new", "extends", "@override"],
    "javascript": ["function", "console.log", "var", "let", "const", "=>"],
    "csharp": ["using system", "namespace", "console.writeline", "public class"],
    "sql": ["select", "insert", "update", "from", "where", "join"],
}

# Comment classes. First class with a matching pattern wins.
COMMENT_RULES = [
    ("Critical",
     [r"\bwrong\b", r"\bincorrect\b", "not true", "that's false", "no, it", "bug", "mistake", "error in",
      "actually,", "this is wrong", "cannot", "can't be"]),
    ("Clarification Seeking",
     [r"\bwhy\b", r"\bhow\b", r"\bwhat do you mean\b", r"\bcan you clarify\b", r"\bwhich one\b",
      r"\bare you saying\b", r"\?"]),
    ("Improvement Suggestions",
     [r"\byou should\b", r"\bit's better to\b", r"preferably\b", r"consider\b", r"instead you can\b",
      "use x rather than y", "suggest"]),
    ("Reproducibility / Failure Reports",
     [r"\bdoesn't work\b", "not working", "fails on", "error message", "cannot reproduce", "version",
      "environment", r"python \d", r"\bcrash"]),
    ("Moderation / Policy Issues",
     [r"\boff-topic\b", "duplicate", "flagged", "please edit", "follow the rules", "formatting",
      "too broad", r"condense\b"]),
]
# Fixed value.
COMMENT_DEFAULT = "Improvement Suggestions"

# Substrings that count for a user type.
ACADEMIC_HINTS = [
    "professor", "phd", "msc", "bsc", "doctorate", "researcher", "postdoc", "lecturer", "institute",
    "university", "faculty", "academic", "scientist", "lab", "scholar",
]
PRACTICAL_HINTS = [
    "developer", "engineer", "programmer", "software engineer", "full stack", "backend", "frontend",
    "freelancer", "consultant", "architect", "founder", "entrepreneur",
]

# Degrees. First degree with a matching whole word wins.
DEGREE_RULES = [
    ("PhD", ["phd", "doctorate", r"dr\.?"]),
    ("MSc", ["msc", r"m\.sc", "master", "graduate student"]),
    ("BSc", ["bsc", r"b\.sc", "bachelor"]),
    ("Professor", ["professor", r"prof\."]),
    ("Postdoc", ["postdoc", "post-doctoral"]),
    ("Student", ["student", "undergrad"]),
    ("Researcher", ["researcher", "research"]),
]

# States of the USA, by name and by two-letter code.
US_STATES = [
    "alabama", "alaska", "arizona", "arkansas", "california", "colorado", "connecticut", "delaware",
    "florida", "georgia", "hawaii", "idaho", "illinois", "indiana", "iowa", "kansas", "kentucky",
    "louisiana", "maine", "maryland", "massachusetts", "michigan", "minnesota", "mississippi",
    "missouri", "montana", "nebraska", "nevada", "new hampshire", "new jersey", "new mexico",
    "new york", "north carolina", "north dakota", "ohio", "oklahoma", "oregon", "pennsylvania",
    "rhode island", "south carolina", "south dakota", "tennessee", "texas", "utah", "vermont",
    "virginia", "washington", "west virginia", "wisconsin", "wyoming",
]
US_STATE_CODES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY",
    "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND",
    "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
# Fixed value.
GEORGIA_CITIES = ["tbilisi", "batumi"]

# Countries by continent.
COUNTRIES_BY_CONTINENT = {
    "Africa": [
        "algeria", "angola", "benin", "botswana", "burkina faso", "burundi", "cabo verde", "cameroon",
        "central african republic", "chad", "comoros", "congo (congo-brazzaville)", "djibouti", "egypt",
        "equatorial guinea", "eritrea", "eswatini", "ethiopia", "gabon", "gambia", "ghana", "guinea",
        "guinea-bissau", "kenya", "lesotho", "liberia", "libya", "madagascar", "malawi", "mali",
        "mauritania", "mauritius", "morocco", "mozambique", "namibia", "niger", "nigeria", "rwanda",
        "sao tome and principe", "senegal", "seychelles", "sierra leone", "somalia", "south africa",
        "south sudan", "sudan", "tanzania", "togo", "tunisia", "uganda", "zambia", "zimbabwe",
    ],
    "Asia": [
        "afghanistan", "armenia", "azerbaijan", "bahrain", "bangladesh", "bhutan", "brunei", "cambodia",
        "china", "georgia", "india", "indonesia", "iran", "iraq", "israel", "japan", "jordan",
        "kazakhstan", "kuwait", "kyrgyzstan", "laos", "lebanon", "malaysia", "maldives", "mongolia",
        "myanmar", "nepal", "north korea", "oman", "pakistan", "palestine", "philippines", "qatar",
        "saudi arabia", "singapore", "south korea", "sri lanka", "syria", "taiwan", "tajikistan",
        "thailand", "timor-leste", "turkey", "turkmenistan", "united arab emirates", "uzbekistan",
        "vietnam", "yemen",
    ],
    "Europe": [
        "albania", "andorra", "austria", "belarus", "belgium", "bosnia and herzegovina", "bulgaria",
        "croatia", "cyprus", "czechia", "denmark", "estonia", "finland", "france", "germany", "greece",
        "hungary", "iceland", "ireland", "italy", "latvia", "liechtenstein", "lithuania", "luxembourg",
        "malta", "moldova", "monaco", "montenegro", "netherlands", "north macedonia", "norway", "poland",
        "portugal", "romania", "russia", "san marino", "serbia", "slovakia", "slovenia", "spain",
        "sweden", "switzerland", "ukraine", "united kingdom", "vatican city",
    ],
    "North America": [
        "antigua and barbuda", "bahamas", "barbados", "belize", "canada", "costa rica", "cuba",
        "dominica", "dominican republic", "el salvador", "grenada", "guatemala", "haiti", "honduras",
        "jamaica", "mexico", "nicaragua", "panama", "saint kitts and nevis", "saint lucia",
        "saint vincent and the grenadines", "trinidad and tobago", "usa",
    ],
    "South America": [
        "argentina", "bolivia", "brazil", "chile", "colombia", "ecuador", "guyana", "paraguay", "peru",
        "suriname", "uruguay", "venezuela",
    ],
    "Oceania": [
        "australia", "fiji", "kiribati", "marshall islands", "micronesia", "nauru", "new zealand",
        "palau", "papua new guinea", "samoa", "solomon islands", "tonga", "tuvalu", "vanuatu",
    ],
}

# Other names of a country. Cities are not listed: they are a parameter
# (see operators.places.place_table).
COUNTRY_ALIASES = {
    "brazil": ["brasil"],
    "china": ["prc"],
    "congo (congo-brazzaville)": ["congo"],
    "czechia": ["czech republic"],
    "georgia (usa)": ["georgia usa", "georgia, usa"],
    "germany": ["deutschland"],
    "myanmar": ["burma"],
    "netherlands": ["holland"],
    "north korea": ["dprk"],
    "palestine": ["palestinian territories"],
    "russia": ["russian federation"],
    "sao tome and principe": ["sao tome"],
    "south korea": ["korea", "republic of korea"],
    "spain": ["españa"],
    "turkey": ["türkiye"],
    "united arab emirates": ["uae"],
    "united kingdom": ["england", "britain", "uk"],
    "usa": ["united states", "united states of america", "america", "u.s.", "virginia", "va", "ca"],
    "vatican city": ["vatican"],
    "vietnam": ["viet nam"],
}

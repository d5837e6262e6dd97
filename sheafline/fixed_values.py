"""Fixed values.

Everything here has to be exactly as written for results to be right: names,
routing rules, sizes and patterns that stored tables already depend on.
"""

# Category folder -> table slug. Other names are lower-cased.
CATEGORY_SLUGS = {
    "CRM": "crm",
    "발급": "issuance",
    "방카슈랑스": "bancassurance",
    "변경": "change",
    "보전": "conservation",
    "사고보험금": "accident_benefit",
    "상품": "product",
    "언더라이팅": "underwriting",
    "업무별_연락처": "tasks_contact_address",
    "제지급금": "payment_amount",
    "콜센터지침": "call_center_guideline",
}

# Agent -> document paths it owns, first match wins.
AGENT_PATHS = {
    "단체신계약": ["보험>언더라이팅>단체언더라이팅", "보험>언더라이팅>언더_공통", "보험>변경>단체변경"],
    "개인신계약": ["보험>언더라이팅>개인언더라이팅"],
    "상품": ["보험>상품"],
    "사고보험금": ["보험>사고보험금"],
}
DEFAULT_AGENT = "Default"

# Path globs -> how a file is cut, first match wins.
CHUNK_GLOBS = [
    {"glob": "**/summaries/**/*", "mode": "none"},
    {"glob": "**/raw_text/**/*.pdf", "mode": "fixed", "size": 500},
    {"glob": "**/contracts/**/*.pdf", "mode": "overlap", "size": 500, "overlap": 100},
]

# Sizes.
CHUNK_SIZE = 1000
CHUNK_OVERLAP = 200
PREVIEW_CHARS = 500
EMBED_DIMENSION = 1024
EMBED_BATCH = 32
SEARCH_RESULTS = 5

# Patterns (Java regex).
LAST_EXTENSION = r"\.[^.]+$"
SCHEME_AND_BUCKET = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/"
LAST_SEGMENT = r"/[^/]+$"
BLANK_LINES = r"\n{3,}"
NOT_BLANK = r"(?U)[^\s\x1c-\x1f]"
ROW_END = "</tr>"
CELL_END = "</t[dh]>"
ANY_TAG = "<[^>]+>"
TRAILING_BAR = r" \| *(?=\n|$)"

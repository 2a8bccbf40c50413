"""They must stay as they are for results to be comparable.

Labels, patterns (Java dialect), bounds, metric and policy names, formats.
"""

# Labels, in scoring order.
CATEGORIES = (
    "account_access",
    "billing",
    "bug",
    "cancellation",
    "feature_request",
    "shipping",
    "security",
)
PRIORITIES = ("low", "medium", "high", "urgent")
SENTIMENTS = ("positive", "neutral", "frustrated", "angry", "worried")
LABEL_DIMENSIONS = {
    "category": CATEGORIES,
    "priority": PRIORITIES,
    "sentiment": SENTIMENTS,
}
OUTPUT_FIELDS = ("category", "priority", "sentiment", "response", "next_action")
ROUTING_FIELDS = ("category", "priority", "sentiment", "next_action")
SPLITS = ("train", "validation", "test")
INVALID_LABEL = "__invalid__"

# Id codes of the label grid.
CATEGORY_CODES = {
    "account_access": "ACC",
    "billing": "BIL",
    "bug": "BUG",
    "cancellation": "CAN",
    "feature_request": "FEA",
    "shipping": "SHP",
    "security": "SEC",
}
PRIORITY_CODES = {"low": "LOW", "medium": "MED", "high": "HIG", "urgent": "URG"}
SENTIMENT_CODES = {
    "positive": "POS",
    "neutral": "NEU",
    "frustrated": "FRU",
    "angry": "ANG",
    "worried": "WOR",
}

# Bounds, in code points after trimming.
CONTENT_LENGTH = (1, 8000)
RESPONSE_LENGTH = (12, 1200)
CREATED_BY_LENGTH = (3, 120)
ERROR_TEXT_LIMIT = 4000

# Record patterns.
RECORD_ID = r"^[A-Z][A-Z0-9_-]{2,63}$"
NEXT_ACTION = r"^[a-z][a-z0-9_]{2,63}$"
PLACEHOLDER = r"\[[A-Z][A-Z0-9_]*\]"
SHA256_HEX = r"^[0-9a-f]{64}$"
REPEATED_CHARACTER = r"^(.)\1{63}$"
PROVENANCE_SOURCE = "synthetic"
PROVENANCE_LICENSE = "CC0-1.0"

# Character classes spelled out, because Java's \w, \d, \s and \b are ASCII-only.
WORD = r"\p{L}\p{N}_"
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"
TRIMMED_FROM_FIELDS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
TRIMMED_FROM_TEXT = TRIMMED_FROM_FIELDS + "\x1c\x1d\x1e\x1f"
NO_WORD_BEFORE = rf"(?<![{WORD}])"
NO_WORD_AFTER = rf"(?![{WORD}])"
WORD_EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
# A-Z ignoring case, with the four non-ASCII letters that fold into that range.
ANY_CASE_LETTER = r"A-Za-zİıſK"

PII_PATTERNS = {
    "email address": (
        rf"{WORD_EDGE}[{ANY_CASE_LETTER}0-9._%+-]+@[{ANY_CASE_LETTER}0-9.-]+"
        rf"\.[{ANY_CASE_LETTER}]{{2,}}{NO_WORD_AFTER}"
    ),
    "US social-security number": r"(?<!\p{Nd})\p{Nd}{3}-\p{Nd}{2}-\p{Nd}{4}(?!\p{Nd})",
    "payment-card-like number": r"(?<!\p{Nd})(?:\p{Nd}[ -]?){12,18}\p{Nd}(?!\p{Nd})",
    "phone-like number": (
        rf"(?<![{WORD}.])\+?(?:\p{{Nd}}[{SPACE}().-]*){{7,14}}\p{{Nd}}(?![{WORD}.])"
    ),
}
SECRET_ASSIGNMENT = (
    rf"(?iu){NO_WORD_BEFORE}(authorization|token|api[_-]?key|password|secret)"
    rf"([{SPACE}]*[:=][{SPACE}]*)(?:bearer[{SPACE}]+)?[^{SPACE},;]+"
)
HUB_TOKEN = rf"{NO_WORD_BEFORE}hf_[A-Za-z0-9]{{20,}}{NO_WORD_AFTER}"
REDACTED = "[REDACTED]"
JSON_FENCE = r"(?is)```(?:json)?\s*(.*?)```"

LOCAL_USER_PATHS = ("/Users/", "/home/")

# Metrics and gates.
ABSOLUTE_MINIMUMS = {
    "strict_json_rate": 0.95,
    "schema_valid_rate": 0.95,
    "category_accuracy": 0.85,
    "priority_accuracy": 0.85,
    "sentiment_accuracy": 0.80,
    "response_policy_rate": 0.95,
}
NON_REGRESSION_METRICS = (
    "strict_json_rate",
    "schema_valid_rate",
    "category_accuracy",
    "category_macro_f1",
    "priority_accuracy",
    "priority_macro_f1",
    "sentiment_accuracy",
    "sentiment_macro_f1",
    "response_policy_rate",
    "exact_match_rate",
)
PARITY_GATES = (
    "adapter_schema_valid_rate",
    "merged_schema_valid_rate",
    "category_match_rate",
    "priority_match_rate",
    "sentiment_match_rate",
    "next_action_match_rate",
    "routing_match_rate",
)
NUMBER_TOLERANCE = 1e-12
FRACTION_SUM_TOLERANCE = 1e-9

# Split search.
DEFAULT_FRACTIONS = {"train": 0.75, "validation": 0.125, "test": 0.125}
SUBSET_LIMIT = 128
VARIANTS_PER_MODE = 32
STATE_LIMIT = 4096
MODES = ("joint", "priority", "sentiment")

# Review policy.
MIN_RECORDS = 1000
MIN_REVIEWERS = 2
MIN_HELD_OUT = 100
DRAFT_REVIEWERS = ("REPLACE_WITH_REVIEWER_A", "REPLACE_WITH_REVIEWER_B")
PLACEHOLDER_MARKERS = ("replace", "placeholder", "example", "todo", "tbd")
PLACEHOLDER_REVIEWERS = ("reviewer-a", "reviewer_a", "reviewer-b", "reviewer_b")
REVIEW_FIELDS = ("labels", "response", "pii", "license")
REVIEW_OUTCOMES = ("pending", "approved", "rejected")
TIER_SMOKE = "portfolio_smoke"
TIER_CANDIDATE = "qualification_candidate"
CURRENT_POLICIES = (
    "review_evidence_schema_v1_2",
    "source_sha256_matches",
    "record_count_matches",
    "minimum_record_count",
    "prepared_manifest_sha256_matches",
    "prepared_manifest_source_matches",
    "prepared_manifest_record_ids_match",
    "holdout_freeze_sha256_matches",
    "holdout_freeze_matches_prepared_test",
    "minimum_independent_review_packets",
    "review_packet_files_distinct",
    "review_packet_hashes_match",
    "reviewer_ids_distinct",
    "reviewer_ids_non_placeholder",
    "review_packets_bind_source",
    "review_packets_bind_prepared_manifest",
    "review_packets_bind_holdout_freeze",
    "review_packets_cover_ordered_source",
    "review_packets_approved",
    "review_packet_decisions_approved",
    "full_record_review",
    "minimum_held_out_examples",
    "held_out_within_dataset",
    "held_out_count_matches_ids",
    "held_out_ids_within_source",
    "approved_status",
)
LEGACY_POLICIES = (
    "source_sha256_matches",
    "record_count_matches",
    "minimum_record_count",
    "minimum_independent_reviewers",
    "full_record_review",
    "minimum_held_out_examples",
    "held_out_within_dataset",
    "held_out_count_matches_ids",
    "held_out_ids_within_source",
    "approved_status",
)

# Route prefixes of the next action, per category.
ACTION_PREFIXES = {
    "account_access": ("verify", "review", "inspect"),
    "billing": ("review", "trace", "apply", "restore"),
    "bug": ("triage",),
    "cancellation": ("review",),
    "feature_request": ("review",),
    "shipping": ("trace", "review"),
    "security": ("secure", "review", "revoke", "lock"),
}

# Lineage fields carried by generated predictions.
LINEAGE_DATASET_KEYS = ("source", "manifest", "train", "validation", "test")
QUALIFICATION_PREFIX = "qualification_"

# Serving alerts: (rule, series, operator, limit, seconds the condition must hold, sum over series).
ALERT_RULES = (
    ("serving_down", "up:serving", "==", 0.0, 120, False),
    ("requests_waiting", "requests_waiting", ">", 8.0, 300, False),
    ("alert_manager_down", "up:alert_manager", "==", 0.0, 120, False),
    ("metric_storage_capacity", "metric_storage_bytes", ">", 4294967296.0, 600, True),
)
SAMPLE_SECONDS = 15

"""Fixed values. They must stay equal to those the data was produced with."""

# Target languages, ISO 639-3 codes.
TARGET_LANGS = ("swa", "amh", "tgl", "ceb", "mar", "bho")

# Two-letter labels and the ISO 639-3 code each one stands for.
LANGUAGE_ALIASES = {"sw": "swa", "am": "amh", "tl": "tgl", "mr": "mar"}

# Smallest share of the dataset each target language must hold.
MIN_SHARE = 0.05

# Terms a language gets when no source yielded any.
FALLBACK_TERMS = {
    "tgl": ("lindol", "bagyo", "baha", "sakuna", "tulong", "sunog", "paglikas"),
    "ceb": ("linog", "bagyo", "baha", "disastre", "tabang", "sunog", "bakwit"),
}

# Redaction patterns, in the order they are applied.
PII_PATTERNS = {
    "EMAIL": r"[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+",
    "PHONE": r"(\+?\d{1,3}[-.\s]?)?(\(?\d{2,4}\)?[-.\s]?)?\d{3,4}[-.\s]?\d{4}",
    "IP_ADDRESS": r"\b(?:\d{1,3}\.){3}\d{1,3}\b",
    "CREDIT_CARD": r"\b(?:\d[ -]*?){13,16}\b",
}

# Columns redacted by default.
REDACTED_COLUMNS = ("content", "title")

# Keys tried, in order, for the address embedded in a media reference.
MEDIA_URL_KEYS = ("url", "original_file_url", "original_url", "file_url", "src")

# Keys tried, in order, for the prompt of a record.
PROMPT_KEYS = ("prompt", "text", "title", "content", "description", "message")

# Columns the adaptation step adds and later removes.
OPERATION_COLUMN = "__adaptive_operation"
PROMPT_COLUMN = "__adaptive_prompt"
SOURCE_COLUMN = "__source_record"
INTERNAL_COLUMNS = (OPERATION_COLUMN, PROMPT_COLUMN, SOURCE_COLUMN)

# Instruction text of each adaptation operation.
OPERATION_INSTRUCTIONS = {
    "filter_noise": (
        "Keep crisis-relevant humanitarian records and remove irrelevant "
        "social chatter. Preserve useful source fields."
    ),
    "extract_intent": (
        "Normalize multilingual or code-switched crisis reports into clear "
        "humanitarian intents while preserving source context."
    ),
    "map_fema_esf": (
        "Map crisis reports to FEMA ESF and MIRA-style humanitarian response "
        "categories. Preserve the original source context."
    ),
}

# Operations with the deduplication flag, and with the rephrase flag.
DEDUP_OPERATIONS = ("filter_noise",)
REPHRASE_OPERATIONS = ("extract_intent", "map_fema_esf")

BATCH_SIZE = 50
PAGE_SIZE = 500
LISTING_LIMIT = 50
SNAPSHOT_LIMIT = 8

# Post selection.
POST_STATUS = "published"
POST_TAGS = ("disaster", "earthquake", "flood")

# Provenance values and address prefixes.
ARCHIVE_SOURCE = "internet_archive_ushahidi_api"
NEWS_SOURCE_TYPE = "common_crawl_news"
ARCHIVE_URL_PREFIX = "https://web.archive.org/web/"
LISTING_URL_PREFIX = "https://data.commoncrawl.org/"
DICTIONARY_SOURCE = "LUDP + Clear Global Web Scraping"

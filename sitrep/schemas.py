"""Column layouts of landed inputs and of the rows the readers give, as DDL text."""

RAW_RESPONSE = (
    "deployment string, endpoint string, status int, content_type string, "
    "body string, page_offset int, fetched_ts string"
)
CATEGORY = "deployment string, category_id int, name string"
MEDIA = "deployment string, media_id int, url string"
CDX_ROW = (
    "url string, ts string, original string, status int, mime string, "
    "digest string, ord bigint"
)
LUDP_RECORD = (
    "location string, language_code string, term string, "
    "language_name_local string, ord bigint"
)
GLOSSARY_PAGE = "category string, ord bigint, html string"
KEYWORD = "lang string, term string, ord bigint"
WARC_RECORD = (
    "segment string, rec_type string, target_uri string, content_type string, "
    "payload binary, error string"
)
NEWS_ROW = (
    "source_url string, source_type string, content string, title string, "
    "media_urls array<string>, timestamp string"
)
TAXONOMY = "term string, code string, label string"
LEXICON = "term string, intent string"

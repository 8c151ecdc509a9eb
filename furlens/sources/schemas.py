"""Fixed schemas, one per stage: no inference pass over the data."""

from __future__ import annotations

HIT = (
    "id bigint, pageURL string, webformatURL string, tags string, "
    "views bigint, downloads bigint, user string"
)
LISTING_RESPONSE = f"hits array<struct<{HIT.replace(' bigint', ':bigint').replace(' string', ':string')}>>"
LISTING = (
    "api_id bigint, page_url string, image_url string, tags string, "
    "views bigint, downloads bigint, user string, label int"
)
IMAGE_METADATA = (
    "image_id string, image_array array<array<array<int>>>, source_url string, "
    "description string, download_timestamp string, label int, keyword string, "
    "original_shape array<int>, tags string, views bigint, downloads bigint, user string"
)
EXTRACTED = (
    "image_id string, label string, keyword string, tags string, "
    "image_array string, original_shape string"
)
VALID = (
    "image_id string, label int, keyword string, tags string, "
    "image_array string, original_shape string"
)
CATEGORY_STATS = "label int, count bigint"
KEYWORD_STATS = "keyword string, count bigint"
FEATURES = (
    "image_id string, label int, keyword string, tags string, "
    "image_features array<double>, original_shape string"
)
FETCH_LOG = (
    "url string, status int, content_type string, content_length string, "
    "format string, mode string, width int, height int"
)
MODEL_RUNS = (
    "config string, model_name string, accuracy double, f1_score double, "
    "training_time double, success boolean, error string, model_order int"
)
CONFIG_RUNS = "config string, cores int, total_time double, method string"

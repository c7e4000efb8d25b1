"""Scalar rules as Column -> Column functions built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratebook.schemas import PRICE, TIER

# Fixed values.
USD = "USD"
UNBOUNDED = ("", "inf", "infinity")
ERROR_MAX_LEN = 8000


def first_filled(*cols: Column) -> Column:
    """First non-empty text; the last alternative is returned as it is."""
    *heads, last = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in heads], last)


# --- URLs -------------------------------------------------------------------


def version_from_url(url: Column) -> Column:
    """Third-from-last path segment, '' when there are fewer than three."""
    parts = F.split(F.regexp_replace(url, "/+$", ""), "/")
    return F.coalesce(F.try_element_at(parts, F.lit(-3)), F.lit(""))


def absolute_url(url: Column, base_url: str) -> Column:
    base = base_url.rstrip("/")
    rooted = F.when(url.startswith("/"), url).otherwise(F.concat(F.lit("/"), url))
    return F.when(
        url.startswith("http://") | url.startswith("https://"), url
    ).otherwise(F.concat(F.lit(base), rooted))


def url_path(url: Column) -> Column:
    """Path under the host, always with a leading slash: the landing key."""
    path = F.regexp_replace(url, "^https?://[^/]*", "")
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))


# --- prices and tiers -------------------------------------------------------


def normalise_range(bound: Column) -> Column:
    text = F.regexp_replace(bound, r"(?U)^\s+|\s+$", "")  # any Unicode blank
    return F.when(~F.lower(text).isin(*UNBOUNDED), text)


def tier_bound(bound: Column) -> Column:
    return normalise_range(bound).cast(TIER)


def exact_price(text: Column) -> Column:
    """Strict cast: under ANSI a malformed price fails the job."""
    return text.cast(PRICE)


def picked_currency(prices: Column) -> Column:
    """USD when the map has that key, else the first key in document order."""
    return F.when(F.map_contains_key(prices, USD), F.lit(USD)).otherwise(
        F.get(F.map_keys(prices), F.lit(0))
    )


def picked_price(prices: Column) -> Column:
    return F.when(
        F.map_contains_key(prices, USD), F.try_element_at(prices, F.lit(USD))
    ).otherwise(F.get(F.map_values(prices), F.lit(0)))


def map_or_null(value: Column) -> Column:
    return F.when(F.size(value) > 0, value)


def plan_raw_price(price: Column) -> Column:
    return F.when(price.isNotNull(), F.create_map(F.lit(USD), price))


# --- semi-structured values -------------------------------------------------


def json_or_null(value: Column) -> Column:
    """NULL for an absent, null or empty object/array; anything else unchanged."""
    return F.when(
        ~F.is_variant_null(value) & ~F.to_json(value).isin("{}", "[]"), value
    )


def json_value(value: Column, path: str) -> Column:
    """Scalar at `path` as text; NULL when the path is absent or not a scalar."""
    leaf = F.try_variant_get(value, path, "variant")
    nested = F.schema_of_variant(leaf).rlike("^(OBJECT|ARRAY)<")
    return F.when(~nested, F.try_variant_get(value, path, "string"))


def attribute(value: Column, key: str) -> Column:
    """Attribute known to be a scalar.  A bare path extraction, so that the
    parquet scan reads only that path of the variant column."""
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", "string")


def json_keys(value: Column) -> Column:
    return F.json_object_keys(F.to_json(value))


def service_name(attributes: Column) -> Column:
    return first_filled(
        attribute(attributes, "servicename"),
        attribute(attributes, "serviceName"),
        attribute(attributes, "ServiceName"),
    )


def plan_term_attributes(
    lease: Column, description: Column, effective: Column
) -> Column:
    """Object that keeps its null members; a missing lease becomes {}."""
    members = F.struct(
        F.coalesce(json_or_null(lease), F.parse_json(F.lit("{}"))).alias(
            "leaseContractLength"
        ),
        description.alias("description"),
        effective.alias("effectiveDate"),
    )
    return F.parse_json(F.to_json(members, {"ignoreNullFields": "false"}))


# --- dates, fallbacks, names ------------------------------------------------


def effective_date(text: Column) -> Column:
    return F.left(F.nullif(text, F.lit("")), F.lit(10)).cast("date")


def publication_ts(text: Column) -> Column:
    return text.cast("timestamp")


def rate_code(code: Column, term_id: Column) -> Column:
    return first_filled(code, term_id)


def effective_version(target_version: Column, document_version: Column) -> Column:
    return first_filled(
        target_version, F.nullif(document_version, F.lit("")), F.lit("")
    )


def description(rate_text: Column, plan_text: Column) -> Column:
    return first_filled(rate_text, plan_text)


def error_text(error: Column) -> Column:
    return F.left(F.coalesce(error, F.lit("")), F.lit(ERROR_MAX_LEN))


def pair_label(service: Column, region: Column) -> Column:
    return F.concat(service, F.lit("|"), region)


def safe_object_name(service: Column, region: Column, version: Column) -> Column:
    return F.regexp_replace(
        F.concat_ws("--", service, region, version), r"[^A-Za-z0-9._-]+", "_"
    )


def service_codes(text: str) -> list[str]:
    """Comma list -> trimmed, non-blank codes."""
    return sorted({part.strip() for part in text.split(",") if part.strip()})

"""The closed request contract: ordered rules, the first that fails is the message."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binding import let
from ..functions.text import strip
from ..functions.urls import canonical_url
from ..functions.variants import kind, spelled

#: Allowed fields, and the forms of an id and of a language.
KEYS = ("enabled", "request_id", "url", "language")
REQUEST_ID = r"\A[A-Za-z0-9][A-Za-z0-9._-]{2,79}\z"
LANGUAGE = r"\A(?:auto|[A-Za-z]{2,3}(?:-[A-Za-z0-9]{2,16})?)\z"
SCHEMA_VERSION = "2.1"


def validate_request(value: Column) -> Column:
    """struct(message, schema_version, enabled, request_id, url, video_id, source_type, language) of a raw JSON text.

    Of equal keys the last counts. Where message is not null all other fields are null. A null or
    malformed text has the message `invalid JSON`.
    """
    return let(F.from_json(value, "map<string,variant>"), lambda fields: let(_fields(fields), lambda f: let(_message(value, fields, f), lambda message: _resolved(message, f))))


def _fields(fields: Column) -> Column:
    get = lambda name: F.try_element_at(F.map_values(F.map_filter(fields, lambda k, _: k == name)), F.lit(-1))
    enabled = let(get("enabled"), lambda v: (kind(v) == "BOOLEAN") & F.try_variant_get(v, "$", "boolean"))
    return F.struct(
        F.array_sort(F.array_distinct(F.filter(F.map_keys(fields), lambda k: ~k.isin(*KEYS)))).alias("unknown"),
        strip(let(get("request_id"), spelled)).alias("request_id"),
        strip(F.coalesce(F.nullif(let(get("language"), spelled), F.lit("")), F.lit("auto"))).alias("language"),
        F.coalesce(enabled, F.lit(False)).alias("enabled"),
        canonical_url(let(get("url"), spelled)).alias("url"),
    )


#: The messages below, which callers compare.
def _message(value: Column, fields: Column, f: Column) -> Column:
    is_object = F.coalesce(value.rlike(r"(?s)\A\s*\{"), F.lit(False))
    is_json = F.coalesce(F.try_parse_json(value).isNotNull(), F.lit(False)) | (is_object & fields.isNotNull())
    return (
        F.when(~is_json, "invalid JSON")
        .when(~is_object, "request must be a JSON object")
        .when(F.size(f["unknown"]) > 0, F.concat(F.lit("unsupported request fields: "), F.array_join(f["unknown"], ", ")))
        .when(~f["request_id"].rlike(REQUEST_ID), "invalid request_id")
        .when(~f["enabled"], "enabled must be true")
        .when(~f["language"].rlike(LANGUAGE), "invalid language")
        .otherwise(f["url"]["message"])
    )


def _resolved(message: Column, f: Column) -> Column:
    good = {"schema_version": F.lit(SCHEMA_VERSION), "enabled": F.lit(True), "request_id": f["request_id"], "url": f["url"]["url"], "video_id": f["url"]["video_id"], "source_type": f["url"]["source_type"], "language": f["language"]}
    return F.struct(message.alias("message"), *(F.when(message.isNull(), c).alias(k) for k, c in good.items()))


def resolve_requests(requests: DataFrame, value_col: str = "value") -> DataFrame:
    """`requests` with a column `request` (see `validate_request`)."""
    return requests.withColumn("request", validate_request(F.col(value_col)))

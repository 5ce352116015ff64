"""Fields of SDK calls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REQUEST_ID_HEADER = "x-amz-request-id"


def operation_name(request_class: Column) -> Column:
    """Request class name without a trailing ``Request``."""
    return F.regexp_replace(request_class, "Request$", "")


def request_url(endpoint: Column, path: Column, parameters: Column) -> Column:
    """Endpoint, path and query string; only the first value of each parameter is used."""
    named = F.filter(F.map_entries(parameters), lambda e: e["key"] != "")
    pairs = F.transform(named, lambda e: F.concat(e["key"], F.lit("="), F.get(e["value"], 0)))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&")))
    return F.concat(endpoint, F.coalesce(path, F.lit("")), F.coalesce(query, F.lit("")))


def header_first_value(headers: Column, name: str) -> Column:
    """First value of a multi-valued header, null when absent or empty."""
    return F.try_element_at(headers[name], F.lit(1))


def response_status(status: Column) -> Column:
    return F.coalesce(status, F.lit(0))


def request_id(
    is_service_error: Column,
    error_request_id: Column,
    has_result: Column,
    metadata_request_id: Column,
    header_request_id: Column,
) -> Column:
    """The service error's ID; else the result metadata's; the header counts only without a result."""
    return (
        F.when(is_service_error, error_request_id)
        .when(has_result, metadata_request_id)
        .otherwise(header_request_id)
    )


def keep_real_error(
    error: Column, has_cause: Column, is_service_error: Column, message: Column
) -> Column:
    """Drop an error that only repeats an HTTP status: no cause, a service error, no message."""
    return F.when(~(~has_cause & is_service_error & message.isNull()), error)


def strip_headers(attributes: Column, names: list[str]) -> Column:
    return F.map_filter(attributes, lambda k, _: ~k.isin(names))

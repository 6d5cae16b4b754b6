"""URI structure, normalisation and request classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitlens import lookups as K
from hitlens.rules import column, first_match, lookup, lowered_text

UNKNOWN = "unknown"


def request_parts(request: Column) -> tuple[Column, Column, Column]:
    """Method, URI and protocol of a request line; missing parts are empty text."""
    parts = F.split(F.trim(request), r"\s+")
    return tuple(F.coalesce(F.get(parts, F.lit(i)), F.lit("")) for i in range(3))


def path(uri: Column) -> Column:
    return F.substring_index(uri, "?", 1)


def query(uri: Column) -> Column:
    """Text after the first ``?``, empty if none."""
    at = F.instr(uri, "?")
    return F.when(at > 0, F.substr(uri, at + 1)).otherwise(F.lit(""))


def trimmed_path(uri: Column) -> Column:
    """Path without query and without one trailing slash (the root stays)."""
    p = path(uri)
    return F.when(F.length(p) > 1, F.regexp_replace(p, "/$", "")).otherwise(p)


def grouping_path(uri: Column) -> Column:
    """Ids, hex tokens and version segments replaced by placeholders, in that order."""
    p = F.regexp_replace(path(uri), r"/\d+", "/{id}")
    p = F.regexp_replace(p, r"/[a-f0-9]{8,}", "/{uuid}")
    return F.regexp_replace(p, r"/v\d+/", "/v{n}/")


def masked(uri: Column) -> Column:
    """Query values replaced by ``***``; parts without ``=`` dropped."""
    q = F.get(F.split(uri, r"\?"), F.lit(1))
    parts = F.filter(F.split(q, "&"), lambda p: F.contains(p, F.lit("=")))
    named = F.transform(parts, lambda p: F.concat(F.substring_index(p, "=", 1), F.lit("=***")))
    return F.when(q.isNull(), path(uri)).otherwise(F.concat(path(uri), F.lit("?"), F.array_join(named, "&")))


def segments(uri: Column) -> Column:
    """Path segments without the outer slashes; the root gives one empty segment."""
    return F.split(F.regexp_replace(path(uri), r"^/+|/+$", ""), "/")


def _segment(uri: Column, index: int) -> Column:
    return F.coalesce(F.get(segments(uri), F.lit(index)), F.lit(""))


def service_of(uri: Column) -> Column:
    """First segment, or the second when the first is ``api``."""
    first, second = _segment(uri, 0), F.get(segments(uri), F.lit(1))
    return F.when((first == "api") & second.isNotNull(), second).otherwise(first)


def service_pair(uri: Column) -> tuple[Column, Column]:
    """Primary and secondary service: the first two segments of an absolute path."""
    absolute = F.startswith(uri, F.lit("/"))
    return (
        F.when(absolute, _segment(uri, 0)).otherwise(F.lit("")),
        F.when(absolute, _segment(uri, 1)).otherwise(F.lit("")),
    )


def inferred_application(uri: Column) -> Column:
    """First segment, or the second behind ``api``, ``v1`` or ``v2``."""
    first = _segment(uri, 0)
    return F.when(first.isin("api", "v1", "v2"), _segment(uri, 1)).otherwise(first)


def inferred_service(uri: Column) -> Column:
    """First segment that holds a service word."""
    hits = F.filter(segments(uri), lambda s: s.rlike(K.SERVICE_WORDS))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(""))


def is_static(uri: Column, parts: Column | None = None) -> Column:
    return uri.rlike(K.STATIC_RESOURCE) | _grouped_store(segments(uri) if parts is None else parts)


def _at(parts: Column, index: int) -> Column:
    return F.coalesce(F.get(parts, F.lit(index)), F.lit(""))


def _grouped_store(parts: Column) -> Column:
    return (_at(parts, 0) == K.STORE_APP) & (F.size(parts) >= 2)


def structure(uri: Column, parts: Column | None = None) -> dict[str, Column]:
    """Application, service, module, endpoint, depth, static flag and resource type.

    ``parts`` may pass segments that are already a column.
    """
    parts = segments(uri) if parts is None else parts
    absolute = F.startswith(uri, F.lit("/"))
    depth = F.when(~absolute | (F.get(parts, F.lit(0)) == ""), F.lit(0)).otherwise(F.size(parts))
    app = _at(parts, 0)
    deep = depth >= 2
    static = absolute & is_static(uri, parts)
    third = F.when(depth >= 3, _at(parts, 2)).otherwise(F.lit(UNKNOWN))
    file_stem = F.replace(F.substring_index(F.element_at(parts, -1), ".", 1), F.lit(".min"), F.lit(""))
    module = (
        F.when(app == K.STORE_APP, F.lit("files"))
        .when((app == K.PORTAL_APP) & (depth >= 3) & static, file_stem)
        .otherwise(third)
    )
    no_endpoint = app.isin(K.PORTAL_APP, K.STORE_APP)
    return {
        "application": F.when(depth > 0, app).otherwise(F.lit(UNKNOWN)),
        "service": F.when(deep, _at(parts, 1)).otherwise(F.lit(UNKNOWN)),
        "module": F.when(deep, module).otherwise(F.lit(UNKNOWN)),
        "endpoint": F.when((depth >= 4) & ~no_endpoint, _at(parts, 3)).otherwise(F.lit("")),
        "path_depth": depth,
        "is_static": static,
        "resource_type": F.when(absolute & _grouped_store(parts), F.lit("file"))
        .when(static, resource_type(uri))
        .otherwise(F.lit(UNKNOWN)),
    }


def resource_type(uri: Column) -> Column:
    return first_match(F.lower(uri), K.RESOURCE_TYPE, "other")


def content_type(uri: Column) -> Column:
    return first_match(F.lower(uri), K.CONTENT_TYPE, "application/octet-stream")


def api_version(uri: Column) -> Column:
    found = F.regexp_extract(uri, r"(?i)/v(\d+(?:\.\d+)?)", 1)
    return F.when(found != "", F.concat(F.lit("v"), found)).otherwise(F.lit(""))


def endpoint_type(method: Column) -> Column:
    return lookup(F.upper(method), K.ENDPOINT_TYPE, UNKNOWN)


def transaction_type(method: Column) -> Column:
    return lookup(F.upper(method), K.TRANSACTION_TYPE, UNKNOWN)


def api_category(uri: Column, rules=K.API_CATEGORY) -> Column:
    return first_match(uri, rules, "Other")


def path_class(uri: Column) -> Column:
    return F.when(uri == "", F.lit("Unknown")).otherwise(first_match(uri, K.PATH_CLASS, "Page"))


def operation(uri: Column | str, *, lowered: bool = False) -> Column:
    return F.when(column(uri) == "", F.lit(UNKNOWN)).otherwise(first_match(lowered_text(uri, lowered), K.OPERATION, "other"))


def journey_stage(uri: Column | str, *, lowered: bool = False) -> Column:
    return F.when(column(uri) == "", F.lit(UNKNOWN)).otherwise(first_match(lowered_text(uri, lowered), K.JOURNEY_STAGE, "active"))


def keyword_class(uri: Column) -> dict[str, Column]:
    """Category, module and importance by the first keyword in the path."""
    text = F.lower(uri)
    out: dict[str, Column] = {}
    for i, name in enumerate(("category", "module", "importance")):
        chosen = None
        for keyword, *labels in K.KEYWORD_CATEGORY:
            test, label = text.contains(keyword), F.lit(labels[i])
            chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
        out[name] = chosen.otherwise(F.lit({"category": "general", "module": "unknown", "importance": "Medium"}[name]))
    return out


def features(uri: Column) -> dict[str, Column]:
    """Length, query flag and size, slashes, file extension of a URI."""
    extension = F.regexp_extract(path(uri), r"\.([a-zA-Z0-9]+)$", 1)
    named = F.filter(F.split(query(uri), "&"), lambda p: p.rlike("^[^=]+=.+"))
    names = F.array_distinct(F.transform(named, lambda p: F.substring_index(p, "=", 1)))
    return {
        "uri_length": F.length(uri),
        "has_query": F.contains(uri, F.lit("?")),
        "query_count": F.size(names),
        "slashes": F.regexp_count(uri, F.lit("/")),
        "has_extension": extension != "",
        "extension": extension,
    }

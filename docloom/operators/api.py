"""API descriptions found in intercepted calls: OpenAPI endpoints, GraphQL operations, stored payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.functions import rules
from docloom.functions import scalars as S

_METHODS = ("get", "post", "put", "patch", "delete", "head", "options")


def openapi_endpoints(specs: DataFrame, body: str = "body") -> DataFrame:
    """A row per path and method of each JSON spec: the other columns, method, path, summary.  Bodies that aren't JSON give none."""
    keep = [c for c in specs.columns if c != body]
    paths = F.from_json(F.get_json_object(body, "$.paths"), "map<string,string>")
    rows = specs.select(*keep, F.explode(paths).alias("path", "item"))
    rows = rows.select(*keep, "path", F.explode(F.from_json("item", "map<string,string>")).alias("method", "details")).where(F.col("method").isin(*_METHODS))
    return rows.select(*keep, F.upper("method").alias("method"), "path", F.get_json_object("details", "$.summary").alias("summary"))


def openapi_specs(calls: DataFrame) -> DataFrame:
    """Calls that carry a spec, with file name and hidden header values."""
    body = F.col("responseBody")
    parsed = F.try_parse_json(body)
    holds = F.when(parsed.isNotNull(), F.get_json_object(body, "$.openapi").isNotNull() | F.get_json_object(body, "$.swagger").isNotNull()).otherwise(F.contains(body, F.lit("openapi")) | F.contains(body, F.lit("swagger")))
    found = calls.where((F.col("resourceType").isin("openapi", "swagger") | rules.is_openapi_url(F.col("url"))) & (body != "") & holds)
    ext = F.when(F.contains("url", F.lit(".yaml")), "yaml").otherwise("json")
    return found.select("url", F.concat(F.lit("openapi-"), S.url_hash(F.col("url")), F.lit("."), ext).alias("filename"), S.redact_headers(F.col("headers"), S.OPENAPI_SECRET_HEADERS).alias("headers"), body.alias("body"))


def _json_or_raw(c: Column) -> Column:
    return F.when(F.try_parse_json(c).isNotNull(), c).otherwise(F.to_json(F.struct(c.alias("raw"))))


def graphql_payloads(calls: DataFrame) -> DataFrame:
    found = calls.where(((F.col("resourceType") == "graphql") | rules.is_graphql_url(F.col("url"))) & (F.col("requestBody") != ""))
    return found.select(
        "url", F.concat(F.lit("graphql-"), S.url_hash(F.col("url")), F.lit(".json")).alias("filename"), S.redact_headers(F.col("headers"), S.GRAPHQL_SECRET_HEADERS).alias("headers"),
        _json_or_raw(F.col("requestBody")).alias("request"), F.when(F.col("responseBody") != "", _json_or_raw(F.col("responseBody"))).alias("response"),
    )


def graphql_operations(queries: DataFrame, query: str = "query") -> DataFrame:
    """A row per operation: the other columns, type, name.  A text without any is one of unknown type; a blank one gives none."""
    keep = [c for c in queries.columns if c != query]
    pattern = r"(?i)\b(query|mutation|subscription)\s+(\w+)?[^{]*\{"
    kinds, names = F.regexp_extract_all(query, F.lit(pattern), F.lit(1)), F.regexp_extract_all(query, F.lit(pattern), F.lit(2))
    named = F.zip_with(kinds, names, lambda k, n: F.struct(F.lower(k).alias("type"), S.blank_as_null(n).alias("name")))
    unknown = F.array(F.struct(F.lit("unknown").alias("type"), F.lit(None).cast("string").alias("name")))
    found = F.when(F.size(kinds) > 0, named).when(S.trim(F.col(query)) != "", unknown)
    return queries.select(*keep, F.posexplode(found).alias("position", "op")).select(*keep, "position", "op.type", "op.name")

"""Captured API responses → payloads.

A live HTTP client is a single-machine concern; here responses are a table
``(status INT, content_type STRING, body STRING[, error STRING])`` (one row
per call, as landed by an extractor) and the payload rules are column
expressions, so classification runs in parallel with no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: status reported for a transport error after the retries.
SERVICE_UNAVAILABLE = 503


#: A body that is neither object, array nor text: a number or a word.
_SCALAR = r"^\s*(-?[0-9][0-9.eE+-]*|true|false|null|NaN|-?Infinity)\s*$"


def parsed_body(body: Column) -> Column:
    """A JSON body as VARIANT, null if it is none.

    ``NaN`` and ``Infinity`` are numbers, as common writers emit them.  Text
    after the first value makes a body invalid; Spark's parsers stop there, so
    the body is read as the only element of an array.  An object that repeats a
    key keeps the last one if ``spark.sql.variant.allowDuplicateKeys`` is on
    (:func:`lakeward.session.build_session` sets it), else it is invalid."""
    first, last = F.substring(F.trim(body), 1, 1), F.substring(F.trim(body), -1, 1)
    closed = (
        ((first == "{") & (last == "}")) | ((first == "[") & (last == "]")) | ((first == '"') & (last == '"'))
        | body.rlike(_SCALAR)
    )
    whole = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "variant", {"allowNonNumericNumbers": "true"})
    elements = F.try_variant_get(whole, "$", "array<variant>")
    return F.when(closed & (F.size(elements) == 1), F.get(elements, F.lit(0)))


def classify_responses(responses: DataFrame) -> DataFrame:
    """Tolerant rules, per row:

    * transport ``error`` (after the client's retries) → status 503, kind
      ``error``, text ``request_error: {error}``;
    * status 204 or empty body → kind ``no_content``, no payload;
    * content type without ``application/json`` → kind ``text``, raw body;
    * JSON that parses → kind ``json``, ``payload`` as VARIANT;
    * JSON that does not parse → kind ``invalid_json``, raw body.

    Adds ``kind``, ``payload`` (VARIANT) and ``text`` (STRING).
    """
    has_error = F.col("error").isNotNull() if "error" in responses.columns else F.lit(False)
    body = F.col("body")
    parsed = F.col("__parsed")
    is_json_type = F.lower(F.coalesce(F.col("content_type"), F.lit(""))).contains("application/json")
    no_content = (F.col("status") == 204) | body.isNull() | (F.length(body) == 0)
    kind = (
        F.when(has_error, "error")
        .when(no_content, "no_content")
        .when(~is_json_type, "text")
        .when(parsed.isNotNull(), "json")
        .otherwise("invalid_json")
    )
    error_text = F.concat(F.lit("request_error: "), F.col("error")) if "error" in responses.columns else F.lit(None)
    # parsed once: a projection of its own, which Spark does not copy
    out = responses.withColumn("__parsed", F.when(is_json_type & ~no_content, parsed_body(body))).withColumn("kind", kind)
    return out.select(
        *[c for c in responses.columns if c != "status"],
        F.when(F.col("kind") == "error", F.lit(SERVICE_UNAVAILABLE)).otherwise(F.col("status")).alias("status"),
        "kind",
        F.when(F.col("kind") == "json", parsed).alias("payload"),
        F.when(F.col("kind").isin("text", "invalid_json"), body)
        .when(F.col("kind") == "error", error_text)
        .alias("text"),
    )


def strict_payloads(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Strict rules: a response is valid only with a 2xx status and a JSON
    object or array body.  Returns ``(records, quarantine)``: arrays are
    exploded into one record per element; everything else goes to quarantine
    with a ``reason``.

    The body is parsed once; the top-level shape is tested with cheap casts
    (``try_variant_get`` to a map or an array), not by deriving the schema of
    the whole value."""
    ok_status = (F.col("status") >= 200) & (F.col("status") < 300)
    parsed = F.col("__parsed")
    as_array = F.try_variant_get(parsed, "$", "array<variant>")
    is_obj = F.try_variant_get(parsed, "$", "map<string,variant>").isNotNull()
    reason = (
        F.when(~ok_status | F.col("status").isNull(), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("missing"))))
        .when(parsed.isNull(), F.lit("body is not JSON"))
        .when(~(is_obj | F.col("__array").isNotNull()), F.lit("JSON body is neither object nor array"))
    )
    tagged = (
        responses.withColumn("__parsed", parsed_body(F.col("body")))
        .withColumn("__array", as_array)
        .withColumn("reason", reason)
    )
    good = tagged.filter(F.col("reason").isNull())
    base = [c for c in responses.columns if c != "body"]
    # One generator for both shapes: an array yields its elements, an
    # object yields itself as element 0.
    elements = F.coalesce(F.col("__array"), F.array(F.col("__parsed")))
    records = good.select(*base, F.posexplode(elements).alias("element", "record"))
    quarantine = tagged.filter(F.col("reason").isNotNull()).drop("__parsed", "__array")
    return records, quarantine

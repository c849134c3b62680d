"""Captured API responses: tolerant and strict payload rules."""

from lakeward.sources import responses


def test_classify(spark):
    d = spark.createDataFrame(
        [
            ("a", 204, "application/json", '{"x": 1}', None),
            ("b", 200, "application/json", "", None),
            ("c", 200, "text/html", "<p>hi</p>", None),
            ("d", 200, "Application/JSON; charset=utf-8", '{"key": "value"}', None),
            ("e", 200, "application/json", "{bad", None),
            ("f", None, None, None, "timeout"),
            ("g", 200, "application/json", '[{"id": 1}, {"id": 2}]', None),
        ],
        "id string, status int, content_type string, body string, error string",
    )
    out = {r.id: r for r in responses.classify_responses(d).collect()}
    assert out["a"].kind == "no_content" and out["a"].payload is None
    assert out["b"].kind == "no_content"
    assert out["c"].kind == "text" and out["c"].text == "<p>hi</p>"
    assert out["d"].kind == "json" and out["d"].payload.toJson() == '{"key":"value"}'
    assert out["e"].kind == "invalid_json" and out["e"].text == "{bad"
    assert out["f"].kind == "error" and out["f"].status == 503 and out["f"].text == "request_error: timeout"
    assert out["g"].kind == "json"


def test_strict(spark):
    d = spark.createDataFrame(
        [
            ("a", 200, '{"key": "value"}'),
            ("b", 200, '[{"id": 1}, {"id": 2}]'),
            ("c", 500, '{"e": 1}'),
            ("d", 200, "plain"),
            ("e", 200, "42"),
        ],
        "id string, status int, body string",
    )
    good, bad = responses.strict_payloads(d)
    got = sorted((r.id, r.element, r.record.toJson()) for r in good.collect())
    assert got == [("a", 0, '{"key":"value"}'), ("b", 0, '{"id":1}'), ("b", 1, '{"id":2}')]
    assert {r.id: r.reason for r in bad.collect()} == {
        "c": "status 500", "d": "body is not JSON", "e": "JSON body is neither object nor array",
    }

"""Table-driven response classification (hand-made bodies)."""

from pyspark.sql import functions as F

from quarry.operators import requests as RQ

HTML_PROFILE = "<!DOCTYPE html><html><head><title>Profile</title></head><body>Forbidden</body></html>"
CHALLENGE = "<!DOCTYPE html><html><head><title>Just a moment...</title></head><body></body></html>"

CASES = [
    # (status, body, headers, category, signal, kind)
    (200, '{"items": []}', {}, "json", "ok", "ok"),
    (403, '{"error": {"code": 6}}', {}, "private", "ok", "private"),
    (403, HTML_PROFILE, {}, "private", "ok", "private"),
    (403, CHALLENGE, {}, "challenge", "challenge", "retryable"),
    (403, HTML_PROFILE, {"cf-mitigated": "challenge"}, "challenge", "challenge", "retryable"),
    (404, '{"error":{}}', {}, "dead", "ok", "dead"),
    (404, "", {}, "dead", "ok", "dead"),
    (404, HTML_PROFILE, {}, "dead", "ok", "dead"),
    (429, "", {}, "rate_limited", "throttled", "rate_limited"),
    (503, '{"error":{}}', {}, "server_error", "error", "retryable"),
    (200, "  <html>cloudflare</html>", {}, "challenge", "challenge", "retryable"),
    (200, "oops truncated", {}, "server_error", "error", "retryable"),
    (200, '{"character": {"name": "Just a moment Cloudflare"}}', {}, "json", "ok", "ok"),
    (400, '{"error": 1}', {}, "client_error", "error", "retryable"),
    (200, '{"a": 1} trailing', {}, "server_error", "error", "retryable"),
    (200, "42", {}, "json", "ok", "ok"),
]


def test_classification_table(spark):
    rows = [(i, s, b, h) for i, (s, b, h, *_rest) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, status int, body string, headers map<string,string>")
    got = (RQ.classify_response(df)
           .select("i", "category", RQ.signal().alias("signal"), RQ.result_kind().alias("kind"))
           .orderBy("i").collect())
    for r, (_s, _b, _h, cat, sig, kind) in zip(got, CASES):
        assert (r["category"], r["signal"], r["kind"]) == (cat, sig, kind), (r["i"], CASES[r["i"]][:2])

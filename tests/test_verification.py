import pytest

from talkscout.operators import verify

ROOT = '<https://x.org/wp-json/>; rel="https://api.w.org/"'


def capture(domain, kind, post_id=None, status=200, link=None, total=None, body=None, error=None):
    return (domain, kind, post_id, None if error else status, link, total, body, error)


def site(domain, total="5", body='[{"post":1}]', status=200, probe_error=None):
    return [
        capture(domain, "home_head", link=ROOT),
        capture(domain, "comments_probe", status=status, total=total, body=body, error=probe_error),
    ]


HEAD_FAILS = lambda d, error: [capture(d, "home_head", error=error)]

# domain -> (captures, (wp_confirmed, comments_endpoint, hint, api_root, error))
X = "https://x.org/wp-json/"
CASES = {
    "ok": (site, (1, 1, 5, X, "")),
    "get": (
        lambda d: [capture(d, "home_head", link="<f>; rel=x"), capture(d, "home_get", link=ROOT), *site(d)[1:]],
        (1, 1, 5, X, ""),
    ),
    "head_error_page": (
        lambda d: [capture(d, "home_head", status=500, link=ROOT), *site(d)[1:]],
        (1, 1, 5, X, ""),
    ),
    "no_bracket": (
        lambda d: [capture(d, "home_head", link="api.w.org"), *site(d)[1:]],
        (1, 1, 5, "https://no_bracket/wp-json/", ""),
    ),
    "plain": (
        lambda d: [capture(d, "home_head"), capture(d, "home_get")],
        (0, 0, 0, "", "no WordPress API header"),
    ),
    "get_fails": (
        lambda d: [capture(d, "home_head"), capture(d, "home_get", error="timeout")],
        (0, 0, 0, "", "timeout"),
    ),
    "down": (lambda d: HEAD_FAILS(d, "refused") + [capture(d, "home_get", link=ROOT)], (0, 0, 0, "", "refused")),
    "tls_ok": (
        lambda d: HEAD_FAILS(d, "tls: bad") + [capture(d, "home_http_get", link=ROOT), *site(d)[1:]],
        (1, 1, 5, "http://tls_ok/wp-json/", ""),
    ),
    "tls_get": (
        lambda d: [capture(d, "home_head"), capture(d, "home_get", error="bad certificate")]
        + [capture(d, "home_http_get", link=ROOT), *site(d)[1:]],
        (1, 1, 5, "http://tls_get/wp-json/", ""),
    ),
    "tls_plain": (
        lambda d: HEAD_FAILS(d, "x509: certificate") + [capture(d, "home_http_get")],
        (0, 0, 0, "", "SSL error, no WordPress API header"),
    ),
    "tls_down": (
        lambda d: HEAD_FAILS(d, "tls: bad") + [capture(d, "home_http_get", error="refused")],
        (0, 0, 0, "", "SSL error + fallback failed: refused"),
    ),
    "auth": (lambda d: site(d, status=401), (1, 0, 0, X, "comments endpoint requires auth")),
    "forbidden": (lambda d: site(d, status=403), (1, 0, 0, X, "comments endpoint forbidden")),
    "gone": (lambda d: site(d, status=404), (1, 0, 0, X, "HTTP 404")),
    "probe_down": (lambda d: site(d, probe_error="timeout"), (1, 0, 0, X, "timeout")),
    "bad_json": (lambda d: site(d, "7", "{"), (1, 0, 7, X, "invalid JSON")),
    "no_body": (lambda d: site(d, "7", None), (1, 0, 7, X, "invalid JSON")),
    "object": (lambda d: site(d, "7", '{"a":1}'), (1, 0, 7, X, "invalid comments response")),
    "empty": (lambda d: site(d, "0", "[]"), (1, 0, 0, X, "no comments")),
    "empty_no_total": (lambda d: site(d, None, "[]"), (1, 0, 0, X, "no comments")),
    "hidden": (lambda d: site(d, "9", "[]"), (1, 1, 9, X, "")),
    "spaces": (lambda d: site(d, " 42 "), (1, 1, 0, X, "")),
    "huge": (lambda d: site(d, "9" * 30), (1, 1, 2**63 - 1, X, "")),
    "tail": (lambda d: site(d, "2", ' [{"post":1}] <html>'), (1, 1, 2, X, "")),
    "absent": (lambda d: [], (0, 0, 0, "", verify.NOT_CAPTURED)),
    "no_probe": (lambda d: site(d)[:1], (1, 0, 0, X, verify.NOT_CAPTURED)),
}


@pytest.fixture(scope="module")
def results(spark):
    captures = spark.createDataFrame(
        [c for domain, (make, _) in CASES.items() for c in make(domain)], verify.CAPTURES_SCHEMA
    )
    domains = spark.createDataFrame([(d,) for d in CASES], "domain STRING")
    return {r.domain: tuple(r)[1:] for r in verify.verify_results(domains, captures).collect()}


@pytest.mark.parametrize("domain", CASES)
def test_result(results, domain):
    assert results[domain] == CASES[domain][1]


def test_one_row_per_domain(results):
    assert set(results) == set(CASES)


def sample(domain, posts, **kwargs):
    body = "[" + ",".join(f'{{"id":{i},"post":{p}}}' for i, p in enumerate(posts)) + "]"
    return capture(domain, "comments_sample", **{"body": body, **kwargs})


def post(domain, post_id, title='"T"', **kwargs):
    return capture(domain, "post", post_id, **{"body": f'{{"link":"u{post_id}","title":{title}}}', **kwargs})


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        # equal counts go by post id; 0 and negative ids are not posts
        sample("a", [9, 9, 9, 4, 4, 7, 7, 0, 0, 0, 0, -1]),
        post("a", 9, '{"rendered":"Nine"}'),
        post("a", 4),
        post("a", 7, "null"),
        # twelve posts, ten kept; a failed one is not replaced
        sample("many", [*range(1, 13), 12]),
        *(post("many", i, **({"status": 404} if i == 3 else {})) for i in range(1, 13)),
        sample("void", [1, '"x"']),
        post("void", 1),
        sample("refused", [1], status=403),
        post("refused", 1),
        sample("closed", [1]),
        post("closed", 1),
        sample("odd", [1, 2, 3, 4]),
        post("odd", 1, error="timeout"),
        capture("odd", "post", 2, body='{"link":5}'),
        capture("odd", "post", 3, body="{}"),
    ]
    captures = spark.createDataFrame(rows, verify.CAPTURES_SCHEMA)
    results = spark.createDataFrame(
        [(d, 0 if d == "closed" else 1) for d in ("a", "many", "void", "refused", "closed", "odd")],
        "domain STRING, comments_endpoint BIGINT",
    )
    by_domain = {}
    for r in verify.verify_pages(results, captures).orderBy("domain", "post_id").collect():
        by_domain.setdefault(r.domain, []).append(tuple(r)[1:])
    return by_domain


def test_counts_titles_and_order(pages):
    assert pages["a"] == [(4, "u4", "T", 2), (7, "u7", "", 2), (9, "u9", "Nine", 3)]


def test_ten_posts_and_no_backfill(pages):
    assert [p[0] for p in pages["many"]] == [1, 2, 4, 5, 6, 7, 8, 9, 12]


def test_unusable_samples_give_no_pages(pages):
    assert not {"void", "refused", "closed"} & set(pages)


def test_unreadable_posts_are_dropped(pages):
    assert pages["odd"] == [(3, "", "", 1)]


def test_totals(spark):
    captures = spark.createDataFrame(
        [*site("a"), sample("a", [1, 2]), post("a", 1), post("a", 2), *site("b", "0", "[]")], verify.CAPTURES_SCHEMA
    )
    domains = spark.createDataFrame([("a",), ("b",), ("c",)], "domain STRING")
    assert tuple(verify.verify_totals(*verify.verify_all(domains, captures)).first()) == (3, 1, 2)

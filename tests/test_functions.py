import pytest
from pyspark.sql import functions as F

from talkscout.functions import documents, responses, urls


def check(apply, expression, cases):
    assert dict(zip(cases, apply(expression, list(cases)))) == cases


def test_registered_domain(apply):
    check(
        apply,
        urls.registered_domain,
        {
            "site.org": "site.org",
            "www.site.org": "site.org",
            "x.y.z.site.org": "site.org",
            "www.shop.co.uk": "shop.co.uk",
            "shop.co.uk": "shop.co.uk",
            "co.uk": "co.uk",
            "News.Daily.COM.AU": "daily.com.au",
            "a.b.gov.uk": "b.gov.uk",
            "www.site.org.": "site.org",
            "WWW.Site.ORG": "site.org",
            "localhost": "localhost",
            "": "",
            ".": "",
            "a..": "a.",
            "10.0.0.1": "0.1",
        },
    )


def test_every_two_part_suffix_keeps_three_labels(apply):
    hosts = {f"a.b.{suffix}": f"b.{suffix}" for suffix in urls.TWO_PART_SUFFIXES}
    assert len(hosts) == 22
    check(apply, urls.registered_domain, hosts)


def test_url_host(apply):
    check(
        apply,
        urls.url_host,
        {
            "https://www.Site.org/a?b#c": "www.Site.org",
            "http://user:pw@host.org:8080/": "host.org",
            "//host.org/x": "host.org",
            "HTTP://host.org": "host.org",
            "http://[2001:db8::1]:80/": "2001:db8::1",
            "http://[::1]/": "::1",
            "http://under_score.host.org/": "under_score.host.org",
            "http://caf%C3%A9.org/": "café.org",
            "http://host.org/?q=%zz": "host.org",
            # no authority
            "mailto:a@host.org": "",
            "/path/only": "",
            "host.org/path": "",
            "http:///path": "",
            "": "",
            # rejected
            "http://host.org:port/": "",
            "http://host.org/%zz": "",
            "http://host.org/#%zz": "",
            "http://ho st.org/": "",
            "http://a%20b.org/": "",
            "http://host.org/\x01": "",
            "http://[::1/": "",
            "http://u%zz@host.org/": "",
        },
    )


def test_forum_from_link(apply):
    cases = {
        "//forum1.disqus.com/embed.js": "forum1",
        "https://forum1.disqus.com/some/path": "forum1",
        "//MyForum.disqus.com/?url=http://x.org": "myforum",
        "//my-own-forum.disqus.com/embed.js": "my-own-forum",
        "forum.disqus.com/x": "forum",
        "https://disqus.com/home/": "",
        "https://x.org/page": "",
        "": "",
        # only the first match counts
        "//www.disqus.com/?u=//real.disqus.com": "",
        "//a.b.disqus.com/x": "",
    }
    cases.update({f"//{name}.disqus.com/x": "" for name in urls.RESERVED_FORUM_NAMES})
    check(apply, urls.forum_from_link, cases)


def test_forum_from_script_keeps_case_and_reserved_names(apply):
    check(
        apply,
        urls.forum_from_script,
        {
            "//MyForum.disqus.com/embed.js": "MyForum",
            "//www.disqus.com/embed.js": "www",
            "//forum.disqus.com/count.js": "",
            "forum.disqus.com/embed.js": "",
        },
    )


def test_target_uri_is_trimmed_of_unicode_space(apply):
    check(
        apply,
        urls.target_uri,
        {
            "WARC-Target-URI: https://x.org/\r": "https://x.org/",
            "WARC-Target-URI:  https://x.org/ 　": "https://x.org/",
            "WARC-Target-URI:": "",
        },
    )


def test_forum_from_html(apply):
    check(
        apply,
        urls.forum_from_html,
        {
            '<script src="//mine.disqus.com/embed.js"></script>': "mine",
            "<script>var disqus_shortname = 'cool-one';</script>": "cool-one",
            '<script>var disqus_shortname="other";</script>': "other",
            "<script>disqus_shortname = 'v'</script><script src='//e.disqus.com/embed.js'>": "e",
            "<p>disqus.com</p>": "",
            "": "",
        },
    )


def envelope(inside: str) -> str:
    return (
        '{"Envelope":{"Payload-Metadata":{"HTTP-Response-Metadata":{"HTML-Metadata":' + inside + "}}}}"
    )


SCRIPT = '"Scripts":[{"url":"//fromscript.disqus.com/embed.js"}]'
LINK = '"Links":[{"url":"https://fromlink.disqus.com/?url=x"}]'

ENVELOPES = {
    envelope("{" + SCRIPT + ',"Links":[]}'): "fromscript",
    envelope('{"Scripts":[],' + LINK + "}"): "fromlink",
    envelope("{" + LINK + "," + SCRIPT + "}"): "fromscript",
    envelope('{"Scripts":[{"url":"//one.disqus.com/embed.js"},{"url":"//two.disqus.com/embed.js"}]}'): "one",
    envelope('{"Scripts":[{"url":"https://cdn.org/a.js"}],"Links":[{"url":"https://x.org/disqus.com"}]}'): "",
    envelope('{"Scripts":[],"Links":[{"url":"https://www.disqus.com/"},{"url":"//UP.disqus.com"}]}'): "up",
    envelope('{"Scripts":null,"Links":[null,{"path":"a"},{"url":null},{"url":"//n.disqus.com"}]}'): "n",
    envelope("{}"): "",
    envelope("{" + SCRIPT + "}") + " \r": "fromscript",
    # wrong type anywhere in the read fields, or not exactly one document
    envelope("{" + SCRIPT + ',"Links":"text"}'): "",
    envelope('{"Scripts":[{"url":"//s.disqus.com/embed.js"},{"url":5}]}'): "",
    envelope("{" + SCRIPT + ',"Links":["text"]}'): "",
    envelope("{" + SCRIPT + ',"Links":[[]]}'): "",
    envelope("{" + SCRIPT + ',"Links":{}}'): "",
    envelope("{" + SCRIPT + ',"Links":""}'): "",
    envelope("{" + SCRIPT + ',"Links":[""]}'): "",
    envelope("{" + SCRIPT + ',"Links":[{"url":{}}]}'): "",
    envelope("{" + SCRIPT + ',"Links":[{"url":"a\tb"}]}'): "",
    envelope("{" + SCRIPT + ',"Links":[{"url":"a\\tb"}],"other":[1,{"a":null}]}'): "fromscript",
    envelope('""'): "",
    '{"Envelope":5}': "",
    '{"Envelope":null,"x":"disqus.com"}': "",
    envelope('{"Scripts":[{"url":"\\/\\/esc.\\u0064isqus.com\\/embed.js"}]}'): "esc",
    envelope("[{" + SCRIPT + "}]"): "",
    "[" + envelope("{" + SCRIPT + "}") + "]": "",
    envelope("{" + SCRIPT + "}") + "}": "",
    envelope("{" + SCRIPT + "}") + "] x": "",
    envelope("{" + SCRIPT + "}") + ',"x":1': "",
    envelope("{" + SCRIPT + "}")[:-1]: "",
    envelope("{" + SCRIPT + "}").replace('"', "'"): "",
    "{not json disqus.com": "",
    "null": "",
}


def test_forum_from_envelope(spark):
    rows = spark.createDataFrame([(line,) for line in ENVELOPES], "line STRING")
    got = {r.line: r.name for r in documents.with_forum(rows, "line", "name").collect()}
    assert got == ENVELOPES


def test_envelope_paths_are_parameters(spark):
    head = documents.HTML_METADATA + ("Head", "Scripts")
    line = envelope('{"Head":{"Scripts":[{"url":"//deep.disqus.com/embed.js"}]},"Links":[]}')
    rows = spark.createDataFrame([(line,)], "line STRING")
    assert documents.with_forum(rows, "line", "name", scripts_path=head).first().name == "deep"
    assert documents.with_forum(rows, "line", "name").first().name == ""


def test_sampled_posts(apply):
    check_cases = {
        '[{"id":1,"post":7},{"post":7},{"post":8}]': [7, 7, 8],
        '[{"post":7},{"id":2},null,{"post":null}]': [7, 0, 0, 0],
        "[]": [],
        ' [{"post":7}] trailing': [7],
        '[{"post":7},{"post":"x"}]': None,
        '[{"post":7.0}]': None,
        '[{"post":1e2}]': None,
        '[{"post":9223372036854775808}]': None,
        "[7]": None,
        '{"post":7}': None,
        "null": None,
        "{": None,
        "": None,
    }
    check(apply, documents.sampled_posts, check_cases)


@pytest.mark.parametrize(
    "body, want",
    [
        ('{"link":"l","title":{"rendered":"Hi"}}', ("l", "Hi")),
        ('{"link":"l","title":"Plain"} tail', ("l", "Plain")),
        ('{"link":"l","title":{"rendered":""}}', ("l", "")),
        ('{"link":"l","title":{"rendered":5}}', ("l", "")),
        ('{"link":"l","title":null}', ("l", "")),
        ('{"link":"l","title":7}', ("l", "")),
        ('{"title":"T"}', ("", "T")),
        ("null", ("", "")),
        ('{"link":5}', None),
        ("[]", None),
        ("{", None),
    ],
)
def test_post_fields(apply, body, want):
    (got,) = apply(documents.post_fields, [body])
    assert (tuple(got) if got else None) == want


def test_comment_total(apply):
    check(
        apply,
        responses.comment_total,
        {
            "42": 42,
            "+7": 7,
            "-7": -7,
            "007": 7,
            " 42 ": 0,
            "": 0,
            "4_2": 0,
            "42\n": 0,
            "99999999999999999999": 2**63 - 1,
            "-99999999999999999999": -(2**63),
        },
    )


def test_tls_error(apply):
    check(
        apply,
        lambda e: responses.is_tls_error(e),
        {
            None: False,
            "remote error: tls: bad record": True,
            "x509: certificate has expired": True,
            "connection refused": False,
        },
    )


def test_api_root(apply):
    check(
        apply,
        lambda link: responses.api_root(link, F.lit("https://d.org")),
        {
            '<https://d.org/api/>; rel="https://api.w.org/"': "https://d.org/api/",
            '<https://d.org/f>; rel="x", <https://d.org/api/>; rel="https://api.w.org/"': "https://d.org/api/",
            '<>; rel="api.w.org", <u>; rel="api.w.org"': "u",
            "api.w.org": "https://d.org/wp-json/",
            # a comma inside the URL splits it
            "<https://d.org/a,b>; api.w.org": "https://d.org/wp-json/",
        },
    )


def test_endpoint_urls(apply):
    check(apply, lambda r: responses.comments_url(r, 100), {"https://d.org/wp-json//": "https://d.org/wp-json/wp/v2/comments?per_page=100"})
    check(apply, lambda r: responses.post_url(r, F.lit(5)), {"https://d.org/wp-json/": "https://d.org/wp-json/wp/v2/posts/5"})


def test_short_title(apply):
    check(
        apply,
        responses.short_title,
        {"x" * 60: "x" * 60, "x" * 61: "x" * 57 + "...", "é" * 31: "é" * 28 + "...", "": ""},
    )


def test_header_lines(spark):
    rows = [
        (1, [("Link", "a"), ("LINK", "b"), ("X", "c")]), (2, [("link", ""), ("Link", "b")]), (3, [("X", "c")]), (4, []), (5, None), (6, [("Link", None)]),
    ]
    df = spark.createDataFrame(rows, "i INT, h ARRAY<STRUCT<name STRING, value STRING>>")
    h = F.col("h")
    got = df.select("i", responses.header(h, "Link"), responses.joined_header(h, "Link"), responses.header_lines(h, "Link")).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [("a", "a, b", ["a", "b"]), ("", "b", ["", "b"]), (None, None, []), (None, None, []), (None, None, []), ("", "", [""])]

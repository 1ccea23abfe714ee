"""URL, host and forum-name expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public suffixes of two labels.
TWO_PART_SUFFIXES = (
    "co.uk", "co.jp", "co.kr", "co.nz", "co.za", "co.in", "co.id", "co.il",
    "com.au", "com.br", "com.cn", "com.mx", "com.tw", "com.sg", "com.hk",
    "com.ar", "com.tr", "org.uk", "org.au", "net.au", "ac.uk", "gov.uk",
)

# Sub-domains of the forum host that are not forums.
RESERVED_FORUM_NAMES = ("www", "disqus", "help", "blog", "docs", "https", "http")

# Patterns of a forum embed script and of any forum URL.
FORUM_EMBED = r"//(\w[\w-]*)\.disqus\.com/embed\.js"
FORUM_LINK = r"(?:^|//)(\w[\w-]*)\.disqus\.com"

# Fixed value: the header that names the page a crawl record is about.
TARGET_URI_HEADER = "WARC-Target-URI:"

# Unicode White_Space, the set of code points a header value is trimmed of.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# A URL with nothing unusual in it: no userinfo, brackets, fragment or broken escape.
_USUAL_URL = (
    r"^(?:[A-Za-z][A-Za-z0-9+.\-]*+:)?//[A-Za-z0-9._~\-]++(?::[0-9]*+)?"
    r"(?:/[^%?#\x00-\x1f\x7f]*+(?:%[0-9A-Fa-f]{2}[^%?#\x00-\x1f\x7f]*+)*+)?(?:\?[^#\x00-\x1f\x7f]*+)?\z"
)
_AUTHORITY_AND_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)"
_BAD_ESCAPE = r"%(?![0-9A-Fa-f]{2})"
_CONTROL = r"[\x00-\x1f\x7f]"


def trim_space(value: Column) -> Column:
    """Trim Unicode white space at both ends."""
    return F.btrim(value, F.lit(WHITESPACE))


def registered_domain(host: Column) -> Column:
    """Last two labels of a host, or three below a two-part suffix; lower case."""
    name = F.lower(F.regexp_replace(host, r"\.\z", ""))
    last_two = F.substring_index(name, ".", -2)
    return F.when(
        last_two.isin(*TWO_PART_SUFFIXES), F.substring_index(name, ".", -3)
    ).otherwise(last_two)


def url_host(url: Column) -> Column:
    """Host of a URL without userinfo, port and brackets; case is kept.

    Gives '' for a URL without authority and for one a strict parser rejects
    (control characters, bad port, bad percent escape, illegal host bytes). One pattern
    settles the usual URL; only the rest goes through the separate checks.
    """
    usual_host = F.regexp_extract(url, r"//([^:/?]+)", 1)
    return F.when(url.rlike(_USUAL_URL), usual_host).otherwise(_unusual_url_host(url))


def _unusual_url_host(url: Column) -> Column:
    authority = F.regexp_extract(url, _AUTHORITY_AND_PATH, 1)
    path = F.regexp_extract(url, _AUTHORITY_AND_PATH, 2)
    host_port = F.substring_index(authority, "@", -1)
    userinfo = F.regexp_extract(authority, r"(?s)^(.*)@", 1)
    bracketed = host_port.startswith("[")
    bad_port = F.when(
        bracketed, ~F.substring_index(host_port, "]", -1).rlike(r"^(:[0-9]*)?\z") | ~host_port.contains("]")
    ).otherwise(host_port.contains(":") & ~host_port.rlike(r":[0-9]*\z"))
    rejected = (
        F.substring_index(url, "#", 1).rlike(_CONTROL)
        | bad_port
        | host_port.rlike(r"[\x00-\x20\x7f\\^`{|}]")
        | host_port.rlike(r"%(?:[013-7]|2[^5])")
        | host_port.rlike(_BAD_ESCAPE)
        | ~userinfo.rlike(r"^[A-Za-z0-9\-._:~!$&'()*+,;=%@]*\z")
        | userinfo.rlike(_BAD_ESCAPE)
        | path.rlike(_BAD_ESCAPE)
        | F.regexp_extract(url, r"(?s)#(.*)", 1).rlike(_BAD_ESCAPE)
    )
    bare = F.regexp_replace(F.regexp_replace(host_port, r":[0-9]*\z", ""), r"(?s)^\[(.*)\]\z", "$1")
    decoded = F.when(bare.contains("%"), F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))).otherwise(bare)
    return F.when((authority == "") | rejected, "").otherwise(F.coalesce(decoded, F.lit("")))


def forum_from_script(url: Column) -> Column:
    """Forum name in an embed-script URL; case kept, reserved names not filtered."""
    return F.regexp_extract(url, FORUM_EMBED, 1)


def forum_from_link(url: Column) -> Column:
    """Forum name in any URL, lower case; '' when the first match is reserved."""
    name = F.lower(F.regexp_extract(url, FORUM_LINK, 1))
    return F.when(name.isin(*RESERVED_FORUM_NAMES), "").otherwise(name)


def is_target_uri_header(line: Column) -> Column:
    return line.startswith(TARGET_URI_HEADER)


def target_uri(line: Column) -> Column:
    """Value of a target-URI header line."""
    return trim_space(F.substring(line, len(TARGET_URI_HEADER) + 1, 2**31 - 1))


def forum_from_html(html: Column) -> Column:
    """Forum named by a page's HTML: embed script first, then the script variable."""
    embed = forum_from_script(html)
    variable = F.regexp_extract(html, r"""disqus_shortname\s*=\s*(?:'([^']+)'|"([^"]+)")""", 1)
    variable_dq = F.regexp_extract(html, r"""disqus_shortname\s*=\s*(?:'([^']+)'|"([^"]+)")""", 2)
    return F.coalesce(
        F.nullif(embed, F.lit("")), F.nullif(variable, F.lit("")), F.nullif(variable_dq, F.lit("")), F.lit("")
    )

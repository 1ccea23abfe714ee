"""Expressions over JSON text: crawl envelopes, comment samples, posts."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkscout.functions.urls import forum_from_link, forum_from_script, trim_space

# Where an envelope keeps script and link URLs.
HTML_METADATA = ("Envelope", "Payload-Metadata", "HTTP-Response-Metadata", "HTML-Metadata")
SCRIPTS_PATH = HTML_METADATA + ("Scripts",)
LINKS_PATH = HTML_METADATA + ("Links",)

_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
_URLS = T.ArrayType(T.StructType([T.StructField("url", T.VariantType())]))


def _nested(paths: Sequence[Sequence[str]]) -> T.DataType:
    """Struct type that holds just the given paths, each ending in a URL array."""
    if any(len(p) == 0 for p in paths):
        return _URLS
    heads = dict.fromkeys(p[0] for p in paths)
    return T.StructType(
        [T.StructField(h, _nested([p[1:] for p in paths if p[0] == h])) for h in heads]
    )


def _field(value: Column, path: Sequence[str]) -> Column:
    for name in path:
        value = value.getField(name)
    return value


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first_filled(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v != ""), F.lit(0))


def _url_text(item: Column) -> Column:
    return F.try_variant_get(item.getField("url"), "$", "string")


def _holds_non_text(urls: Column) -> Column:
    kind = lambda item: F.coalesce(F.schema_of_variant(item.getField("url")), F.lit("VOID"))
    return F.coalesce(F.exists(urls, lambda i: ~kind(i).isin("STRING", "VOID")), F.lit(False))


def with_names(text: Column, names: Sequence[str]) -> Column:
    """JSON text whose keys that equal one of the names but for case are spelled like it.

    Only a key is followed by a colon, and a quotation mark inside a string has a backslash before it, so nothing else is
    touched. Parsers that match exact keys then take the last of all spellings.
    """
    any_name = "|".join(map(re.escape, names))
    found = text
    for name in dict.fromkeys(names):
        found = F.regexp_replace(found, rf'(?iu)"{re.escape(name)}"(?=\s*:)', f'"{name}"')
    other_case = rf'(?iu)"(?!(?-iu:{any_name})")(?:{any_name})"\s*:'
    return F.when(text.rlike(other_case), found).otherwise(text)


def envelope(
    line: Column, scripts_path: Sequence[str] = SCRIPTS_PATH, links_path: Sequence[str] = LINKS_PATH
) -> Column:
    """One envelope line, parsed: (parsed, single).

    The document is parsed inside an object and again inside an array: text after the
    document cannot be valid in both, so `single` and the corrupt-record field tell a
    line that is exactly one document of the expected shape, without a UDF. Keys match in any
    case, and of several the last one counts.
    """
    named = with_names(line, [*scripts_path, *links_path, "url"])
    schema = T.StructType(
        [
            T.StructField("doc", _nested([tuple(scripts_path), tuple(links_path)])),
            T.StructField("bad", T.StringType()),
        ]
    )
    parsed = F.from_json(
        F.concat(F.lit('{"doc":'), named, F.lit("}")), schema, {**_STRICT, "columnNameOfCorruptRecord": "bad"}
    )
    return F.struct(
        parsed.alias("parsed"),
        (F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1).alias("single"),
    )


def forum_in(
    parsed: Column, scripts_path: Sequence[str] = SCRIPTS_PATH, links_path: Sequence[str] = LINKS_PATH
) -> Column:
    """Forum name in an `envelope`: scripts in order first, then links in order; else ''."""
    doc = parsed.getField("parsed").getField("doc")
    scripts, links = _field(doc, scripts_path), _field(doc, links_path)
    usable = (
        parsed.getField("single")
        & parsed.getField("parsed").getField("bad").isNull()
        & ~_holds_non_text(scripts)
        & ~_holds_non_text(links)
    )
    found = F.coalesce(
        _first_filled(F.transform(scripts, lambda s: forum_from_script(_url_text(s)))),
        _first_filled(F.transform(links, lambda s: forum_from_link(_url_text(s)))),
        F.lit(""),
    )
    return F.when(usable, found).otherwise("")


def with_forum(
    df: DataFrame,
    line: str,
    name: str,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
) -> DataFrame:
    """Add the forum name of an envelope line, parsing each line once.

    Filters on the name belong behind the next shuffle or aggregation: right here the
    optimizer would copy the parser into them.
    """
    return forum_reader(line, name, scripts_path, links_path)(df)


def forum_reader(
    line: str,
    name: str,
    scripts_path: Sequence[str] = SCRIPTS_PATH,
    links_path: Sequence[str] = LINKS_PATH,
) -> Callable[[DataFrame], DataFrame]:
    """`with_forum` whose expressions are made once, for callers that read one small table after the other."""
    parsed = envelope(F.col(line), scripts_path, links_path)
    forum = forum_in(F.col("_envelope"), scripts_path, links_path)
    return lambda df: df.withColumn("_envelope", parsed).withColumn(name, forum).drop("_envelope")


def is_json(body: Column) -> Column:
    """The text starts with a complete JSON value; later text is not looked at, and keys may be repeated."""
    start = F.left(trim_space(body), F.lit(1))
    readable = (
        F.when(start == "[", F.from_json(body, "ARRAY<STRING>", _STRICT).isNotNull())
        .when(start == "{", F.from_json(body, "MAP<STRING, STRING>", _STRICT).isNotNull())
        .otherwise(F.try_parse_json(body).isNotNull())
    )
    return F.coalesce(readable, F.lit(False))


def sampled_posts(body: Column) -> Column:
    """Post ids of a comment sample, as an array; NULL when the sample is void.

    One `post` that is not a whole 64-bit number voids the sample. Of repeated keys, in any case, the last counts.
    """
    post = lambda item: item.getField("post")
    kind = lambda item: F.coalesce(F.schema_of_variant(post(item)), F.lit("VOID"))

    def numbers(items: Column) -> Column:
        whole = F.forall(items, lambda i: kind(i).isin("BIGINT", "VOID"))
        return F.when(whole, F.transform(items, lambda i: F.coalesce(F.try_variant_get(post(i), "$", "bigint"), F.lit(0))))

    parsed = F.from_json(with_names(body, ["post"]), "ARRAY<STRUCT<post: VARIANT>>", _STRICT)
    return F.when(trim_space(body).startswith("["), _once(parsed, numbers))


def _kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def _text_or_empty(value: Column) -> Column:
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string"))


def title_text(title: Column) -> Column:
    """Title of a post from its variant: non-empty `rendered`, else plain text, else ''."""
    rendered = F.try_variant_get(title, "$.rendered", "variant")
    return F.coalesce(_text_or_empty(rendered), _text_or_empty(title), F.lit(""))


def post_fields(body: Column) -> Column:
    """(link, title) of a post body; NULL when the body cannot be read as a post.

    Of repeated keys, in any case, the last counts. A variant holds no repeated keys, so a body that has some inside a field is
    read again by schemas that leave them alone; any other is parsed once.
    """

    def post(link: Column, title: Column, readable: Column) -> Column:
        fields = F.struct(F.coalesce(_text_or_empty(link), F.lit("")).alias("link"), F.coalesce(title, F.lit("")).alias("title"))
        return F.when(readable & _kind(link).isin("STRING", "VOID"), fields)

    def parsed(text: Column, schema: str) -> Column:
        return F.from_json(text, f"{schema}, bad STRING", {**_STRICT, "columnNameOfCorruptRecord": "bad"})

    def again(text: Column) -> Column:
        doc = F.struct(
            parsed(text, "link STRING, title STRING").alias("raw"),
            parsed(text, "link VARIANT")["link"].alias("link"),
            parsed(text, "title STRUCT<rendered: VARIANT>")["title"]["rendered"].alias("rendered"),
            parsed(text, "title VARIANT")["title"].alias("title"),
        )

        def fields(doc: Column) -> Column:
            unread = doc["link"].isNull() & doc["raw"]["link"].isNotNull()  # an object that repeats keys
            title = F.coalesce(_text_or_empty(doc["rendered"]), _text_or_empty(doc["title"]))
            return post(doc["link"], title, doc["raw"]["bad"].isNull() & ~unread)

        return _once(doc, fields)

    def read(text: Column) -> Column:
        usual = lambda doc: F.when(doc["bad"].isNull(), post(doc["link"], title_text(doc["title"]), F.lit(True))).otherwise(again(text))
        return _once(parsed(text, "link VARIANT, title VARIANT"), usual)

    empty = F.struct(F.lit("").alias("link"), F.lit("").alias("title"))
    no_object = _once(F.try_parse_json(body), lambda doc: F.when(F.schema_of_variant(doc) == "VOID", empty))
    return F.when(trim_space(body).startswith("{"), _once(with_names(body, ["link", "title", "rendered"]), read)).otherwise(no_object)

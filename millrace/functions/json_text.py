"""Columns over JSON text: strict parsing, dotted paths, numbers, wrapping.

``try_parse_json`` stops at the end of the first value and ignores what
follows it, so ``{"a":1} x`` would count as JSON. The text is therefore parsed
inside an array whose second element is the text's own hash: the whole text is
one JSON value exactly when that array has two elements and the hash is found
in its place. One parse gives both the verdict and the value.

The parser takes up to 1,000 levels and numbers of up to 1,000 digits. What it refuses beyond
them may or may not be JSON: ``unjudged`` finds such texts, and they are neither wrapped nor
published, but set aside as they stand. ``with_verdict`` judges them too: it only tells whether a
text is JSON, and builds nothing of it.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNBOUNDED = str(2**31 - 1)
_PLAIN_KEY = re.compile(r"[^'\"?\\]+")
FIELDS = "map<string,variant>"

# How JSON texts begin.
ANY_START = r"\A[ \t\r\n]*[\[{\"0-9tfn-]"
OBJECT_START = r"\A[ \t\r\n]*\{"

# The texts of single values, how all others begin and end, and the levels that count as JSON.
SINGLE = (
    r'\A[ \t\r\n]*+(?:"[^"\\\x00-\x1f]*+"|-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?[0-9]++)?+|true|false|null)[ \t\r\n]*+\z'
)
SHAPE = r'(?s)\A[ \t\r\n]*+(?:\{.*\}|\[.*\]|".*\\.*")[ \t\r\n]*+\z'
MAX_DEPTH = 10_000

# The number spellings a numeric string may have.
DECIMAL_TEXT = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
SPECIAL_TEXT = r"(?i)\A([+-]?inf|[+-]?infinity|nan)\z"

# Brackets that a refused text opens, and digits of a number in it, from which on it is not judged.
DEEP = 900
LONG_NUMBER = r"[0-9]{900}"


def with_document(df: DataFrame, text: str = "payload", document: str = "_doc") -> DataFrame:
    """Add the parsed VARIANT of ``text``; NULL where the text is not one JSON value.

    The column comes out of a generator. A filter on it, or on what is derived
    from it, is therefore not pushed below, where it would parse all over again.
    """
    echo = F.xxhash64(F.col(text))
    wrapped = F.concat(F.lit("["), F.col(text), F.lit(","), echo.cast("string"), F.lit("]"))
    # Plain text is told by its first character, without the cost of a failed parse.
    pair = F.when(F.col(text).rlike(ANY_START), F.try_parse_json(wrapped).try_cast("array<variant>"))
    whole = (F.size("_pair") == 2) & (F.try_variant_get(F.get("_pair", F.lit(1)), "$", "bigint") == echo)
    found = F.when(whole, F.get("_pair", F.lit(0)))
    return (
        df.withColumn("_pair", pair)
        .select(*df.columns, F.explode(F.array(found)).alias(document))
    )


def is_json(document: Column) -> Column:
    """Whether the text from which ``document`` was parsed is one JSON value; never NULL."""
    return document.isNotNull()


def with_verdict(df: DataFrame, text: str = "payload", verdict: str = "_whole", depth: int = MAX_DEPTH) -> DataFrame:
    """Add whether ``text`` is one JSON value of up to ``depth`` levels, however long its numbers and strings; never NULL.

    Spark's reader is asked for the last member of an object and passes over the text in front of it, which is
    cheap, and cheaper still where the text is none. A second value after the first can only go unseen as a
    member of its own, with a comma and a colon; a text that has both is also read as an array's
    element, where no member can stand. The text's own hash tells that the end was reached. Single
    values are told by their spelling, without a reader.
    """
    source = F.col(text)
    echo = F.xxhash64(source)
    again = F.when(F.contains(source, F.lit(",")) & F.contains(source, F.lit(":")), F.concat(F.lit(',"b":['), source, F.lit("]")))
    asked = F.concat(F.lit('{"a":{"v":'), source, F.lit("}"), F.coalesce(again, F.lit("")), F.lit(',"h":'), echo.cast("string"), F.lit("}"))
    # The text stands two levels deep.
    limits = {"maxNestingDepth": str(depth + 2), "maxNumLen": _UNBOUNDED, "maxStringLen": _UNBOUNDED}
    found = F.from_json(asked, "h bigint", limits | {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})["h"]
    whole = F.when(source.rlike(SINGLE), True).when(source.rlike(SHAPE), F.coalesce(found == echo, F.lit(False))).otherwise(F.lit(False))
    return df.select(*df.columns, F.explode(F.array(whole)).alias(verdict))


def unjudged(document: Column, text: str = "payload") -> Column:
    """Whether the parser refused ``text`` for what may be its depth or the length of a number; never NULL."""
    source = F.col(text)
    opened = F.length(source) - F.length(F.translate(source, "[{", ""))
    beyond = source.rlike(ANY_START) & ((opened > DEEP) | source.rlike(LONG_NUMBER))
    refused = document.isNull() & (F.length(source) > DEEP)
    return F.when(refused, beyond).otherwise(F.lit(False))


def fields(document: Column) -> Column:
    """The members of a JSON object; NULL for every other value."""
    return document.try_cast(FIELDS)


def is_object(document: Column, text: str = "payload") -> Column:
    """Whether ``document``, parsed from ``text``, is an object."""
    return document.isNotNull() & F.col(text).rlike(OBJECT_START)


def extract(document: Column, path: str) -> Column:
    """The value at a dotted ``path``: NULL when missing, VARIANT null when null.

    Only objects are traversed, and a key never contains a dot.
    """
    keys = path.split(".")
    if all(_PLAIN_KEY.fullmatch(key) for key in keys):
        return F.try_variant_get(document, variant_path(path), "variant")
    found = document
    for key in keys:
        found = F.try_element_at(fields(found), F.lit(key))
    return found


def variant_path(path: str) -> str:
    """The path of a dotted ``path`` in the form VARIANT functions take.

    Quotes, question marks and backslashes in keys cannot be written that way.
    """
    keys = path.split(".")
    if not all(_PLAIN_KEY.fullmatch(key) for key in keys):
        raise ValueError(f"unsupported key in path {path!r}")
    return "$" + "".join(f"['{key}']" for key in keys)


def path_text(path: str) -> str:
    """A dotted ``path`` as a value for ``extract_text``: the form VARIANT functions take, else its keys as JSON."""
    keys = path.split(".")
    return variant_path(path) if all(_PLAIN_KEY.fullmatch(key) for key in keys) else json.dumps(keys)


def extract_text(document: Column, path: Column) -> Column:
    """``extract`` with a path that differs by row, as ``path_text`` gives it."""
    keys = F.from_json(path, "array<string>")
    walked = F.aggregate(keys, document, lambda found, key: F.try_element_at(fields(found), key))
    return F.when(path.startswith("$"), F.try_variant_get(document, path, "variant")).otherwise(walked)


def flat_object(document: Column, mapping: dict[str, str], tags: dict[str, str]) -> Column:
    """Text of the object with the values ``mapping`` (new key to path) finds, and ``tags``.

    Keys are sorted; a key whose path finds nothing is left out.
    """
    values = {name: F.to_json(extract(document, path)) for name, path in mapping.items()}
    values |= {name: F.lit(_quoted(value)) for name, value in tags.items()}
    members = [F.concat(F.lit(f"{_quoted(name)}:"), values[name]) for name in sorted(values)]
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def _quoted(text: str) -> str:
    return json.dumps(text, ensure_ascii=False)


def extract_mapped(document: Column, mapping: dict[str, str], tags: dict[str, str], path: str) -> Column:
    """The value at ``path`` in what ``flat_object`` builds, straight from the document."""
    first, dot, rest = path.partition(".")
    if first in tags:
        return F.lit(None).cast("variant") if dot else F.lit(tags[first]).cast("variant")
    if first in mapping:
        return extract(document, mapping[first] + dot + rest)
    return F.lit(None).cast("variant")


def extract_member(members: Column, path: str) -> Column:
    """Like ``extract``, starting from the members of an object."""
    first, dot, rest = path.partition(".")
    found = F.try_element_at(members, F.lit(first))
    return extract(found, rest) if dot else found


def tag(members: Column, tags: dict[str, str]) -> Column:
    """``members`` with string ``tags`` set at the root, replacing same-named ones."""
    kept = F.map_filter(members, lambda key, _: ~key.isin(list(tags)))
    added = [
        part
        for name, value in sorted(tags.items())
        for part in (F.lit(name), F.lit(value).cast("variant"))
    ]
    return F.map_concat(kept, F.create_map(*added))


def render(members: Column) -> Column:
    """Compact JSON text of an object, keys sorted."""
    return F.to_json(F.to_variant_object(members))


def number(value: Column) -> Column:
    """Double of a JSON number or numeric string; NULL for anything else."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    parsed = text.try_cast("double")
    overflow = F.abs(parsed) == F.lit(float("inf"))
    return (
        F.when(kind.rlike(r"\A(BIGINT|DOUBLE|FLOAT|DECIMAL.*)\z"), F.try_variant_get(value, "$", "double"))
        .when((kind == "STRING") & text.rlike(DECIMAL_TEXT) & ~overflow, parsed)
        .when((kind == "STRING") & text.rlike(SPECIAL_TEXT), parsed)
    )


def as_json_string(text: Column) -> Column:
    """``text`` as a JSON string."""
    inside = as_data_object(text)
    # Behind ``{"data":``, without the closing brace.
    return F.when(text.isNotNull(), F.substr(inside, F.lit(9), F.length(inside) - 9))


def as_data_object(text: Column) -> Column:
    """``text`` wrapped as ``{"data": text}``."""
    return F.to_json(F.struct(text.alias("data")))

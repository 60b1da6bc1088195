"""JSON documents as VARIANT values and maps.

VARIANT keeps numbers as numbers, so `1.50` would read `1.5` and a number of 41 digits a double. To keep them as they were
written, numbers that could change are turned into strings before parsing: a mark, a control character that the text does
not use, and then the literal. `plain` takes the marks out of what is read. Texts without such numbers stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Number literals that VARIANT may write differently: fractions, exponents, minus zero, 19 digits and more.
_AT_RISK = r"[0-9][.][0-9]|[0-9][eE]|-0|[0-9]{19}"
# A JSON string, or a JSON number that stands as a value; text that is neither is left to the parser.
_STRING = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")'
_NUMBER = r"((?<![0-9A-Za-z_.+-])-?(?:0|[1-9][0-9]*+)(?:[.][0-9]++)?(?:[eE][+-]?[0-9]++)?(?![0-9A-Za-z_.+-])(?!\s*:))"
# Marks are U+0001 to U+0008; U+0001 and U+0002 also serve between the steps, as no JSON text may hold them unescaped.
_MARKS = range(1, 9)


def number_mark(text: Column | str, *beside: str) -> Column:
    """Last digit of the code of a control character that the text escapes nowhere and the columns `beside` do not have;
    NULL if the text has no number at risk, or uses all of them."""
    text = _col(text)

    def free(code: int) -> Column:
        unused = ~F.contains(text, F.lit(f"\\u000{code}"))
        for name in beside:
            unused = unused & ~F.coalesce(F.contains(F.col(name), F.lit(chr(code))), F.lit(False))
        return F.when(unused, F.lit(str(code)))

    return F.when(F.rlike(text, F.lit(_AT_RISK)), F.coalesce(*[free(code) for code in _MARKS]))


def marked(text: Column | str, mark: Column | str) -> Column:
    """The text with its numbers as marked strings, where there is a mark. Malformed text stays malformed."""
    text, mark = _col(text), _col(mark)
    cut = F.replace(F.regexp_replace(text, f"{_STRING}|{_NUMBER}", "$1\x01$2\x02"), F.lit("\x01\x02"), F.lit(""))
    quoted = F.regexp_replace(cut, F.lit("\x01([^\x02]*)\x02"), F.concat(F.lit('"\\\\u000'), mark, F.lit('$1"')))
    return F.when(mark.isNull(), text).when(~F.rlike(text, F.lit("[\x01\x02]")), quoted)


def plain_json(text: Column, mark: Column | str) -> Column:
    """A JSON text with the marks taken out, numbers as they were written."""
    mark = _col(mark)
    pattern = F.concat(F.lit(r'"\\u000'), mark, F.lit('([^"]*)"'))
    return F.when(mark.isNull(), text).otherwise(F.regexp_replace(text, pattern, F.lit("$1")))


def plain(value: Column, mark: Column | str) -> Column:
    """Text of a member with the marks taken out: the literal of a number, or a nested JSON text."""
    mark = _col(mark)
    number = F.startswith(value, F.char(mark.cast("bigint")))
    return F.when(mark.isNull(), value).when(number, F.substring(value, 2, 2147483647)).otherwise(
        plain_json(value, mark))


def plain_texts(members: Column, mark: Column | str) -> Column:
    """A map of texts with the marks taken out."""
    return F.when(_col(mark).isNull(), members).otherwise(F.transform_values(members, lambda _, v: plain(v, mark)))


def parse(text: Column | str) -> Column:
    """VARIANT, or NULL for malformed text and for objects that repeat a key."""
    return F.try_parse_json(_col(text))


def object_texts(doc: Column | str, path: str = "$") -> Column:
    """MAP<name, text> of an object; nested values as JSON text, JSON null as NULL; NULL if not an object."""
    return F.try_variant_get(_col(doc), path, "map<string,string>")


def object_values(doc: Column | str, path: str = "$") -> Column:
    """MAP<name, VARIANT> of an object, which keeps the JSON types of its members."""
    return F.try_variant_get(_col(doc), path, "map<string,variant>")


def member_text(members: Column, name: str) -> Column:
    """Text of one member: JSON null reads as the text ``null``, an absent member as NULL."""
    return F.coalesce(members[name], F.when(F.map_contains_key(members, F.lit(name)), F.lit("null")))


def null_as_text(members: Column | str) -> Column:
    return F.transform_values(_col(members), lambda _, v: F.coalesce(v, F.lit("null")))


def size(members: Column | str) -> Column:
    return F.size(_col(members))


def names(members: Column | str) -> Column:
    return F.map_keys(_col(members))


def nesting_depth(text: Column | str) -> Column:
    """Levels of nested objects and arrays in a JSON text, brackets inside strings not counted."""
    unescaped = F.replace(F.replace(_col(text), F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    outside = F.filter(F.split(unescaped, '"'), lambda _, i: i % 2 == 0)
    brackets = F.regexp_replace(F.array_join(outside, ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("top"))

    def step(acc: Column, char: Column) -> Column:
        now = F.when(char.isin("[", "{"), acc["now"] + 1).when(char == "", acc["now"]).otherwise(acc["now"] - 1)
        return F.struct(now.alias("now"), F.greatest(acc["top"], now).alias("top"))

    return F.aggregate(F.split(brackets, ""), start, step, lambda acc: acc["top"])

"""Transforms: ``toUpperCase``, ``substring({{value}}, 0, 10)``, ``if({{value}} > 3, high, low)``, nested as needed.

A template is read once and becomes native columns. Further transforms can be registered in ``TRANSFORMS``: functions
from columns (the arguments) to a column. Arguments are ``{{value}}``, quoted or bare texts, numbers and further calls.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conditions import PLACE, condition, trimmed
from .convert import TRUE_WORDS_DOCUMENT, parse_time


class TransformError(ValueError):
    """A transform that can't be read."""


def _text(c: Column) -> Column:
    return c.cast("string")


def _substring(value: Column, start: Column, length: Column | None = None) -> Column:
    """From 0; a negative start counts from the end; without a readable start the value stays, without a length: to the end."""
    text, size = _text(value), F.char_length(_text(value))
    at = trimmed(_text(start)).try_cast("int")
    begin = F.when(at < 0, F.greatest(size + at, F.lit(0))).otherwise(at)
    rest = size if length is None else F.coalesce(trimmed(_text(length)).try_cast("int"), size)
    return F.when(at.isNull(), text).when(begin >= size, F.lit("")).otherwise(F.substring(text, begin + 1, F.greatest(rest, F.lit(0))))


def _replace(value: Column, old: Column, new: Column) -> Column:
    return F.replace(_text(value), trimmed(_text(old)), trimmed(_text(new)))


def _concat(*parts: Column) -> Column:
    return F.concat(*(F.coalesce(trimmed(_text(p)), F.lit("")) for p in parts))


def _default(value: Column, other: Column | None = None) -> Column:
    return value if other is None else F.coalesce(F.nullif(_text(value), F.lit("")), _text(other))


def _json_text(value: Column) -> Column:
    """The value's text as a JSON string; to_json takes no bare text, so it goes through an array."""
    whole = F.to_json(F.array(_text(value)))
    return F.when(value.isNotNull(), F.substring(whole, F.lit(2), F.char_length(whole) - 2))


#: What ``if`` gets as its condition is made by ``condition``; see ``_call``.
TRANSFORMS: dict[str, Callable[..., Column]] = {
    "toLowerCase": lambda v: F.lower(_text(v)),
    "toUpperCase": lambda v: F.upper(_text(v)),
    "trim": lambda v: trimmed(_text(v)),
    "parseDateTimeBestEffort": lambda v: parse_time(_text(v)),
    "toUnixTimestamp": lambda v: F.unix_seconds(parse_time(_text(v))),
    "if": lambda met, a, b: F.when(met, a).otherwise(b),
    "default": _default,
    "concat": _concat,
    "substring": _substring,
    "replace": _replace,
    "jsonStringify": _json_text,
    "toBoolean": lambda v: F.lower(_text(v)).isin(*TRUE_WORDS_DOCUMENT),
    "toEnum": lambda v: v,
    "enum": lambda v: v,
    # Documented in examples only.
    "round": lambda v, n=None: F.round(v.try_cast("double"), 0 if n is None else n.cast("int")),
}

#: Result types that aren't text; the other transforms give text, or what they are given.
RESULTS: dict[str, T.DataType] = {"parseDateTimeBestEffort": T.TimestampType(), "toUnixTimestamp": T.LongType(), "toBoolean": T.BooleanType(), "round": T.DoubleType()}
_SAME = ("toEnum", "enum")


def _arguments(text: str) -> list[str]:
    """Splits at commas outside quotes and brackets."""
    out, depth, quote, begin = [], 0, "", 0
    for i, c in enumerate(text):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "," and not depth:
            out.append(text[begin:i])
            begin = i + 1
    if quote or depth:
        raise TransformError(f"unbalanced: {text}")
    return [*out, text[begin:]] if text.strip() else []


def _literal(text: str) -> Column:
    plain = text.strip()
    if plain in ("true", "false"):
        return F.lit(plain == "true")
    if re.fullmatch(r"[+-]?\d{1,18}", plain):
        return F.lit(int(plain))
    if re.fullmatch(r"[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?", plain):
        return F.lit(float(plain))
    if len(plain) > 1 and plain[0] == plain[-1] and plain[0] in "'\"":
        return F.lit(plain[1:-1])
    return F.lit(plain)


def _argument(text: str, value: Column) -> Column:
    if text.strip() == PLACE:
        return value
    if re.match(r"\s*\w+\s*\(", text):
        return _call(text, value)
    if PLACE in text:
        parts = text.strip().split(PLACE)
        return F.concat(*(x for i, p in enumerate(parts) for x in ([_text(value)] if i else []) + [F.lit(p)]))
    return _literal(text)


def _call(text: str, value: Column) -> Column:
    found = re.fullmatch(r"\s*(\w+)\s*\((.*)\)\s*", text, re.DOTALL)
    if not found or found.group(1) not in TRANSFORMS:
        raise TransformError(f"no such transform: {text}")
    name, given = found.group(1), _arguments(found.group(2))
    if name == "if":
        if len(given) != 3:
            raise TransformError(f"if needs a condition and two values: {text}")
        first = given[0].strip()
        if re.search(r"[<>=!]", first):
            met = condition(first, value)[0]
        else:
            met = F.lower(_text(_argument(first, value))).isin("true", "1")
        return F.when(met, _text(_argument(given[1], value))).otherwise(_text(_argument(given[2], value)))
    try:
        return TRANSFORMS[name](*(_argument(a, value) for a in given))
    except TypeError as e:
        raise TransformError(f"wrong number of arguments: {text}") from e


def transform(text: str, value: Column, kind: T.DataType, semantics: str = "documented") -> tuple[Column, T.DataType]:
    """The transformed value and its Spark type.

    ``documented``: a bare name is applied to the value, unknown names are errors of the configuration.
    ``compat``: a bare name and an unknown call stand for their own text.
    """
    plain = text.strip()
    if plain == PLACE:
        return value, kind
    name = re.match(r"(\w+)\s*(\(|$)", plain)
    known = bool(name) and name.group(1) in TRANSFORMS
    if "(" not in plain:
        if known and semantics != "compat":
            return transform(f"{plain}({PLACE})", value, kind, semantics)
        out = _argument(plain, value)
        return (out, T.StringType()) if PLACE in plain else (_text(out), T.StringType())
    if not known and semantics == "compat":
        return F.lit(plain), T.StringType()
    out = _call(plain, value)
    kinds = RESULTS | {n: kind for n in _SAME}
    if name.group(1) == "default" and len(_arguments(plain[plain.index("(") + 1 : plain.rindex(")")])) < 2:
        return out, kind
    return out, kinds.get(name.group(1), T.StringType())

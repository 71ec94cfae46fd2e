"""One walk over an XML body for all that is asked of it: whether it is XML, and the texts in it. Small helpers of Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a walk over a body gives: no element for what is no XML, else one.
WALKED = "array<struct<texts array<string>>>"


def _local(name: str) -> str:
    return name.rpartition(":")[2]


class _Annotation:
    """An open Annotation: the names that it goes by, and the first text in its AnnotationTexts, with its place in the body."""

    def __init__(self, name: str | None):
        self.names, self.text = {name}, None


def annotations(body: str, names: tuple[str, ...]) -> list[str | None]:
    """For each name the first text() of an AnnotationText in an Annotation that has the name as its id or in a child AnnotationType, in the order of the body. ExpatError for what is no XML."""
    parser, stack, chars, found = expat.ParserCreate("utf-8"), [], [], {}  # stack: local name, Annotation, or parts of an AnnotationType's value
    place = 0

    def text():
        nonlocal place
        if chars:
            place += 1
            said = "".join(chars)
            chars.clear()
            for _, _, parts in stack:
                if parts is not None:
                    parts.append(said)
            if len(stack) > 1 and stack[-1][0] == "AnnotationText" and (outer := stack[-2][1]) is not None and outer.text is None:
                outer.text = (place, said)

    def start(name, attributes):
        text()
        local = _local(name)
        inner = stack and stack[-1][1] is not None
        stack.append((local, _Annotation(attributes.get("id")) if local == "Annotation" else None, [] if inner and local == "AnnotationType" else None))

    def end(_):
        text()
        _, annotation, parts = stack.pop()
        if parts is not None:
            stack[-1][1].names.add("".join(parts))
        if annotation is not None and annotation.text is not None:
            for name in annotation.names:
                found[name] = min(found.get(name, annotation.text), annotation.text)

    parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = start, end, chars.append
    parser.CommentHandler = parser.ProcessingInstructionHandler = lambda *_: text()
    parser.StartCdataSectionHandler = parser.EndCdataSectionHandler = text
    parser.Parse(body, True)
    return [found[name][1] if name in found else None for name in names]


def periods(body: str) -> list[str | None]:
    """Each TIME_PERIOD of a body once: values of keys, and attributes of observations. ExpatError for what is no XML."""
    parser, stack, found = expat.ParserCreate("utf-8"), [], {}

    def start(name, attributes):
        local = _local(name)
        value = attributes.get("TIME_PERIOD") if local in ("Obs", "ObsValue") else attributes.get("value") if local == "Value" and attributes.get("id") == "TIME_PERIOD" and stack and stack[-1] == "ObsKey" else None
        if value is not None:
            found[value] = None
        stack.append(local)

    parser.StartElementHandler, parser.EndElementHandler = start, lambda _: stack.pop()
    parser.Parse(body, True)
    return list(found)


def _walked(body: str | None, walk: Callable[[str], list[str | None]]) -> list[dict]:
    try:
        return [] if body is None else [{"texts": walk(body)}]
    except (expat.ExpatError, UnicodeError):
        return []


def walked(body: Column, walk: Callable[..., list[str | None]], *arguments) -> Column:
    """WALKED of body, an array for inline(): so a body is walked once, whatever is filtered by and read from it."""
    kind = pa.list_(pa.struct([("texts", pa.list_(pa.string()))]))

    @F.arrow_udf(WALKED)
    def walks(bodies: pa.Array) -> pa.Array:
        return pa.array([_walked(x, lambda b: walk(b, *arguments)) for x in bodies.to_pylist()], kind)

    return walks(body)

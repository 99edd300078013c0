"""Headers and bodies of a landed message.

Expressions with lambdas are written as SQL text: nested eight levels deep, the walk of a
message would otherwise take hundreds of calls into the JVM to put together.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN, HTML = "text/plain", "text/html"
_TOO_DEEP = "too deep"
_NOTHING = "CAST(array() AS ARRAY<STRUCT<mime: STRING, data: STRING>>)"

_NO_NODES = (
    "CAST(array() AS ARRAY<STRUCT<place: ARRAY<INT>, mime: STRING, data: STRING, part: VARIANT>>)"
)


def header(headers: str, name: str) -> Column:
    """Value of a header, any case; the last duplicate wins, NULL where missing."""
    return F.expr(f"try_element_at(filter({headers}, h -> lower(h.name) = '{name}'), -1).value")


def text_parts(part: str, depth: int) -> str:
    """SQL for the pre-order list of ``(mime, data)`` for the text parts of a message.

    A part with a file name or an attachment id hides its whole subtree.  Where children
    lie below the declared depth, an entry marks the spot; see :func:`too_deep`.
    """
    own = (
        f"if({part}.mimeType IN ('{PLAIN}', '{HTML}') AND length({part}.body.data) > 0, "
        f"array(named_struct('mime', {part}.mimeType, 'data', {part}.body.data)), {_NOTHING})"
    )
    if depth > 0:
        child = f"part{depth}"
        children = f"flatten(transform({part}.parts, {child} -> {text_parts(child, depth - 1)}))"
        below = f"coalesce({children}, {_NOTHING})"
    else:
        marker = f"array(named_struct('mime', '{_TOO_DEEP}', 'data', CAST(NULL AS STRING)))"
        below = f"if({part}.parts <> '[]', {marker}, {_NOTHING})"
    hidden = f"length({part}.filename) > 0 OR length({part}.body.attachmentId) > 0"
    return f"if({hidden}, {_NOTHING}, concat({own}, {below}))"


def nodes(part: str, place: str, levels: int) -> str:
    """SQL for the text parts in the first ``levels`` levels of a VARIANT part, each with its place in the tree.

    Parts below them come with no type and as they are.  A part with a file name or an attachment
    id hides its whole subtree.
    """
    if levels == 0:
        return (
            f"array(named_struct('place', {place}, 'mime', CAST(NULL AS STRING), "
            f"'data', CAST(NULL AS STRING), 'part', {part}))"
        )
    mime, data, filename, attachment = (
        f"try_variant_get({part}, '$.{name}', 'string')"
        for name in ("mimeType", "body.data", "filename", "body.attachmentId")
    )
    own = (
        f"if({mime} IN ('{PLAIN}', '{HTML}') AND length({data}) > 0, array(named_struct('place', {place}, "
        f"'mime', {mime}, 'data', {data}, 'part', CAST(NULL AS VARIANT))), {_NO_NODES})"
    )
    child, k = f"part{levels}", f"k{levels}"
    inner = nodes(child, f"concat({place}, array({k}))", levels - 1)
    listed = f"try_variant_get({part}, '$.parts', 'array<variant>')"
    below = f"coalesce(flatten(transform({listed}, ({child}, {k}) -> {inner})), {_NO_NODES})"
    hidden = f"length({filename}) > 0 OR length({attachment}) > 0"
    return f"if({hidden}, {_NO_NODES}, concat({own}, {below}))"


def decoded(parts: str) -> str:
    """SQL for the same list with its base64url data decoded to text.

    Bytes that are not UTF-8 become U+FFFD.  Data that is not base64 decodes to NULL.
    ``replace`` works on bytes, whereas ``translate`` pays per character.
    """
    standard = "replace(replace(p.data, '-', '+'), '_', '/')"
    text = f"make_valid_utf8(CAST(try_to_binary({standard}, 'base64') AS STRING))"
    return f"transform({parts}, p -> named_struct('mime', p.mime, 'data', {text}))"


def body(parts: str, mime: str, max_chars: int) -> Column:
    """Decoded parts of one type joined by newlines; ``''`` where there are none."""
    chosen = f"transform(filter({parts}, p -> p.mime = '{mime}'), p -> p.data)"
    text = F.array_join(F.expr(chosen), "\n")
    return F.substring(text, 1, max_chars) if max_chars > 0 else text


def too_deep(parts: str) -> Column:
    return F.expr(f"exists({parts}, p -> p.mime = '{_TOO_DEEP}')")


def undecodable(parts: str) -> Column:
    return F.expr(f"exists({parts}, p -> p.data IS NULL AND p.mime <> '{_TOO_DEEP}')")

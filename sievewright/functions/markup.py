"""Markup to text, and what of a text can be seen.  Python's own tokeniser cuts the markup; the rest is a pass over its events."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Tags that become a newline where they open and close, tags whose content is not shown, and tags that vanish (fixed values).
BLOCK = frozenset(
    """address article aside blockquote body br dd div dl dt figcaption figure footer h1 h2 h3 h4 h5 h6 header hr li main nav ol p
    pre section table tbody td tfoot th thead tr ul""".split()
)
HIDDEN = frozenset(("script", "style"))
INLINE = frozenset(
    """a abbr area audio b base bdi bdo button canvas caption cite code col colgroup data datalist del details dfn dialog em embed
    fieldset form head html i iframe img input ins kbd label legend link map mark menu meta meter noscript object optgroup
    option output param picture progress q rp rt ruby s samp select slot small source span strong sub summary sup svg
    template textarea time title track u var video wbr""".split()
)

#: Kinds of event.
TEXT, OPEN, CLOSE, ALONE = "text", "open", "close", "alone"


class _Events(HTMLParser):
    """Only notes what the tokeniser finds: kind, tag name, and the piece as text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str, str]] = []
        note = lambda kind: lambda tag, *_: self.found.append((kind, tag, self.get_starttag_text() if kind != CLOSE else f"</{tag}>"))
        self.handle_starttag, self.handle_endtag, self.handle_startendtag = note(OPEN), note(CLOSE), note(ALONE)
        self.handle_data = lambda data: self.found.append((TEXT, "", data))


def events(text: str) -> list[tuple[str, str, str]]:
    parser = _Events()
    parser.feed(text)
    parser.close()
    return parser.found


def _shown(kind: str, tag: str, piece: str) -> str:
    """What an event puts into the text where nothing hides it."""
    if kind == TEXT:
        return piece
    if tag in BLOCK:
        return "\n\n" if kind == ALONE else "\n"
    return "" if tag in INLINE or tag in HIDDEN else piece


def markup_text(text: str) -> str:
    """Composed text without known markup; block tags become newlines, unknown tags stay, scripts and styles go."""
    text = unicodedata.normalize("NFC", text)
    if "<" not in text:
        return html.unescape(text) if "&" in text else text
    found = events(text)
    step = [(1 if k == OPEN else -1 if k == CLOSE else 0) if t in HIDDEN else 0 for k, t, _ in found]
    depth = accumulate(step, lambda d, s: max(0, d + s))
    return "".join(_shown(*e) for e, d in zip(found, depth) if not d)


def visible_text(text: str) -> str:
    """All text between tags, that of scripts and styles too, without control characters: what decides whether a message is empty."""
    pieces = [p for k, _, p in events(text) if k == TEXT] if "<" in text or "&" in text else [text]
    return "".join(c for c in "".join(pieces) if unicodedata.category(c) != "Cc")


#: Bytes of texts that are Python strings at once.
PART = 1 << 20


def by_size(batch, column: int | None = None) -> Iterator:
    """A batch (or an array, without ``column``) in parts whose texts hold PART bytes or little more, so that few of them are Python strings at once."""
    texts = batch if column is None else batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(texts):
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + PART, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _udf(f):
    @F.arrow_udf(StringType())
    def run(texts: pa.Array) -> pa.Array:
        parts = [pa.array([None if x is None else f(x) for x in part.to_pylist()], pa.string()) for part in by_size(texts)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.string())

    return run


_markup, _visible, _nfc, _fold = _udf(markup_text), _udf(visible_text), _udf(lambda x: unicodedata.normalize("NFC", x)), _udf(str.casefold)

#: Texts of these characters alone are composed already, and their lower case is their folded case.
ASCII = r"^[\x00-\x7F]*$"


def markup_to_text(c: Column | str) -> Column:
    """:func:`markup_text`; texts of ASCII without ``<`` and ``&`` do not leave the JVM."""
    c = F.col(c) if isinstance(c, str) else c
    plain = ~c.contains("<") & ~c.contains("&") & c.rlike(ASCII)
    return F.when(plain, c).otherwise(_markup(F.when(~plain, c)))


def visible(c: Column | str) -> Column:
    """:func:`visible_text`; texts without markup do not leave the JVM."""
    c = F.col(c) if isinstance(c, str) else c
    plain = ~c.contains("<") & ~c.contains("&")
    return F.when(plain, F.regexp_replace(c, r"\p{Cc}", "")).otherwise(_visible(F.when(~plain, c)))


def nfc(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(ASCII), c).otherwise(_nfc(F.when(~c.rlike(ASCII), c)))


def casefold(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike(ASCII), F.lower(c)).otherwise(_fold(F.when(~c.rlike(ASCII), c)))

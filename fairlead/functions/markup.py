"""[S17] Descriptions that mix entities, Markdown and HTML: as safe HTML, and as plain text."""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

SAFE = {"p", "br", "strong", "em", "b", "i", "ul", "ol", "li", "a", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "code", "pre", "del", "hr", "table", "thead", "tbody", "tr", "th", "td"}
_ALONE = {"br", "hr"}
_INLINE = ((r"\*\*(.+?)\*\*|__(.+?)__", "strong"), (r"(?<![\w*])\*([^*\s][^*]*?)\*(?![\w*])", "em"), (r"~~(.+?)~~", "del"), (r"`([^`]+)`", "code"))


class _Safe(HTMLParser):
    def __init__(self, text: str):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.plain: list[str] = []
        self._skip, self._open = 0, []
        self.feed(text)
        self.close()
        self.out += [f"</{t}>" for t in reversed(self._open)]

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self._skip += 1
        elif tag in SAFE and not self._skip:
            link = dict(attrs).get("href") or ""
            self.out.append(f'<a href="{html.escape(link)}">' if tag == "a" and re.match(r"(?i)(https?:|mailto:|/|#)", link) else f"<{tag}>")
            if tag not in _ALONE:
                self._open.append(tag)
        self.plain.append(" " if tag not in ("strong", "em", "b", "i", "a", "code", "del") else "")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style"):
            self._skip = max(0, self._skip - 1)
        elif tag in self._open and not self._skip:
            while self._open:
                self.out.append(f"</{(t := self._open.pop())}>")
                if t == tag:
                    break
        self.plain.append(" " if tag not in ("strong", "em", "b", "i", "a", "code", "del") else "")

    def handle_data(self, data: str) -> None:
        if not self._skip:
            self.out.append(html.escape(data, quote=False))
            self.plain.append(data)


def to_html(text: str) -> str:
    """Markdown's headings, lists, quotes, emphasis, code and links as HTML; HTML in it stays, and is made safe afterwards."""
    blocks = []
    for block in re.split(r"\n\s*\n", html.unescape(text).strip()):
        lines = block.split("\n")
        if m := re.match(r"(#{1,6})\s+(.*)", block):
            blocks.append(f"<h{len(m[1])}>{m[2]}</h{len(m[1])}>")
        elif all(re.match(r"\s*[-*+]\s+", x) for x in lines):
            blocks.append("<ul>" + "".join(f"<li>{re.sub(r'^\s*[-*+]\s+', '', x)}</li>" for x in lines) + "</ul>")
        elif all(re.match(r"\s*\d+[.)]\s+", x) for x in lines):
            blocks.append("<ol>" + "".join(f"<li>{re.sub(r'^\s*\d+[.)]\s+', '', x)}</li>" for x in lines) + "</ol>")
        elif all(x.startswith(">") for x in lines):
            blocks.append("<blockquote><p>" + "\n".join(x[1:].strip() for x in lines) + "</p></blockquote>")
        elif re.match(r"\s*<(p|ul|ol|div|h\d|table|blockquote)\b", block):
            blocks.append(block)
        elif block:
            blocks.append(f"<p>{block}</p>")
    out = "\n".join(blocks)
    out = re.sub(r"\[([^\]]+)\]\(([^)\s]+)\)", lambda m: f'<a href="{html.escape(m[2])}">{m[1]}</a>', out)
    for pattern, tag in _INLINE:
        out = re.sub(pattern, lambda m, tag=tag: f"<{tag}>{next(g for g in m.groups() if g is not None)}</{tag}>", out, flags=re.S)
    return out


@F.pandas_udf(StringType())
def description_html(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: "".join(_Safe(to_html(t)).out) if t else "")


@F.pandas_udf(StringType())
def description_text(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: " ".join("".join(_Safe(to_html(t)).plain).split()) if t else "")

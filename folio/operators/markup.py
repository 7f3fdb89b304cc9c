"""HTML as markdown and as plain text, by an event-driven writer on the standard parser."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import zip_longest
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INLINE_MARKS = {"b": "**", "strong": "**", "big": "**", "i": "*", "em": "*", "del": "~~", "code": "`", "chem": "`"}
RAW_MARKS = {"sup": "^", "sub": "_"}
#: (Both fixed values: markdown's own marks.)
#: Elements that end the paragraph they stand in.
BREAKING = {"p", "div", "table", "ul", "ol", "hr", "pre", "h1", "h2", "h3", "h4", "h5", "h6", "li", "body", "section", "article"}
SILENT = {"script", "style", "head", "title"}
HARD_BREAK = "\x00"
HREF = re.compile(r"""(<a\b[^>]*?href=["'])([^"']*)(["'])""", re.I)


#: White space that collapses to one blank; a run that holds a hard break collapses to that.
BLANKS = re.compile(f"[\\s{HARD_BREAK}]+")
#: Two equal marks that touch: one run ends where the next begins.
TOUCHING = re.compile(r"\*{4}|~{4}")


def one_line(text: str) -> str:
    return BLANKS.sub(" ", text).strip()


def with_breaks(text: str) -> str:
    return BLANKS.sub(lambda m: "  \n" if HARD_BREAK in m[0] else " ", text).strip()


class Markdown(HTMLParser):
    """Writes blocks as they end. Text collects in nested inline buffers, each closed by its mark."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[str] = []
        self.buffers: list[tuple[str, str, list[str]]] = [("", "", [])]  # (element, target, text)
        self.lists: list[list] = []  # [ordered, next number, prefix of the open item]
        self.heading = ""
        self.rows: list[list[str]] | None = None
        self.cell: list[str] | None = None
        self.pre: list[str] | None = None
        self.silent = 0

    def text(self, t: str) -> None:
        if self.silent:
            return
        if self.pre is not None:
            self.pre.append(t)
        elif self.cell is not None:
            self.cell.append(t)
        elif self.rows is None:
            self.buffers[-1][2].append(t)

    handle_data = text

    def flush(self) -> None:
        """Ends the open paragraph, heading or list item."""
        while len(self.buffers) > 1:
            self.close_inline(self.buffers[-1][0])
        raw = "".join(self.buffers[0][2])
        self.buffers[0][2].clear()
        if self.lists:
            said = one_line(raw)
            pad = "   " * (len(self.lists) - 1)
            if said:
                self.blocks.append(pad + self.lists[-1][2] + said)
                self.lists[-1][2] = ""
            return
        said = TOUCHING.sub("", one_line(raw) if self.heading else with_breaks(raw))
        if said:
            self.blocks.append(f"{self.heading} {said}".strip())

    def close_inline(self, name: str) -> None:
        while len(self.buffers) > 1:
            element, target, parts = self.buffers.pop()
            inner = "".join(parts)
            core = inner.strip()
            if element in INLINE_MARKS and core:
                mark = INLINE_MARKS[element]
                inner = inner.replace(core, f"{mark}{core}{mark}", 1) if mark != "`" else f"`{core}`"
            elif element in RAW_MARKS:
                inner = RAW_MARKS[element] + inner + RAW_MARKS[element]
            elif element == "math":
                inner = f"$$ {core} $$" if target else f"${core}$"
            elif element == "a" and target:
                inner = f"[{core}]({target})"
            self.buffers[-1][2].append(inner)
            if element == name:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at = dict(attrs)
        if tag in SILENT:
            self.silent += 1
        elif self.rows is not None:
            if tag == "tr":
                self.rows.append([])
            elif tag in ("td", "th"):
                self.end_cell()
                self.cell = []
                if not self.rows:
                    self.rows.append([])
            elif self.cell is not None:
                self.cell.append(" ")
        elif tag == "table":
            self.flush()
            self.rows = []
        elif tag in ("ul", "ol"):
            self.flush()
            start = at.get("start") or "1"
            self.lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d+", start) else 1, ""])
        elif tag == "li":
            self.flush()
            if self.lists:
                own = self.lists[-1]
                own[2] = f"{own[1]}. " if own[0] else "- "
                own[1] += 1
        elif tag == "hr":
            self.flush()
            self.blocks.append("---")
        elif tag == "pre":
            self.flush()
            self.pre = []
        elif tag == "br":
            self.text(HARD_BREAK)
        elif tag == "img":
            alt = (at.get("alt") or "").strip()
            self.text(f"![{alt}]()" if alt else "")
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.heading = "#" * int(tag[1])
        elif tag in BREAKING:
            if not (self.lists and tag in ("p", "div")):
                self.flush()
        elif tag in INLINE_MARKS or tag in RAW_MARKS or tag in ("a", "math"):
            self.buffers.append((tag, at.get("href" if tag == "a" else "display") or "", []))

    def handle_endtag(self, tag: str) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag == "table" and self.rows is not None:
            self.end_cell()
            if piped := pipe_table(self.rows):
                self.blocks.append(piped)
            self.rows = None
        elif self.rows is not None:
            if tag in ("td", "th"):
                self.end_cell()
            elif self.cell is not None:
                self.cell.append(" ")
        elif tag in ("ul", "ol"):
            if self.lists:
                self.flush()
                self.lists.pop()
        elif tag == "pre" and self.pre is not None:
            self.blocks.append("```\n" + "".join(self.pre) + "\n```")
            self.pre = None
        elif re.fullmatch("h[1-6]", tag):
            self.flush()
            self.heading = ""
        elif tag in BREAKING:
            if not (self.lists and tag in ("p", "div")):
                self.flush()
        elif any(tag == b[0] for b in self.buffers[1:]):
            self.close_inline(tag)

    def result(self) -> str:
        """All blocks, those that the text leaves open included, an empty line between them."""
        self.flush()
        if self.rows:
            self.end_cell()
            self.blocks.append(pipe_table(self.rows))
        out = ""
        for block in filter(str.strip, self.blocks):
            out += ("\n\n" if out else "") + block.rstrip()
        return out

    def end_cell(self) -> None:
        if self.cell is not None and self.rows:
            self.rows[-1].append(one_line("".join(self.cell)))
        self.cell = None


def pipe_table(rows: list[list[str]]) -> str:
    """Rows with any text, padded to one width; the first is the header."""
    said = [row for row in rows if any(row)]
    if not said:
        return ""
    columns = list(zip_longest(*said, fillvalue=""))
    line = lambda cells: f"| {' | '.join(cells)} |"
    head, *body = zip(*columns, strict=True)
    return "\n".join(map(line, [head, ["---"] * len(columns), *body]))


def to_markdown(html: str | None) -> str:
    writer = Markdown()
    writer.feed(html or "")
    writer.close()
    return writer.result()


def tables_to_pipes(text: str | None) -> str:
    """Markdown whose embedded HTML tables are written as pipe tables; the rest is untouched."""
    return re.sub(r"(?is)<table\b.*?</table\s*>", lambda m: to_markdown(m[0]) or m[0], text or "")


@F.pandas_udf(T.StringType())
def markdown_of(html: pd.Series) -> pd.Series:
    return html.map(to_markdown)


def text_of(html: Column) -> Column:
    """Plain text without scripts, styles and page furniture: block ends become line ends. Built-in functions only; entities stay."""
    out = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?-->|<(script|style|noscript|nav|header|footer)\b[^>]*>.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6]|table|ul|ol)\s*>", "\n")
    out = F.regexp_replace(F.regexp_replace(out, r"<[^>]*>", " "), "[ \\t\u00a0]+", " ")
    return F.regexp_replace(F.regexp_replace(out, r" ?\n[ \n]*", "\n"), r"^\s+|\s+$", "")


@F.pandas_udf(T.StringType())
def absolute_links(html: pd.Series, base: pd.Series) -> pd.Series:
    """The targets of links, resolved against the address of their page."""
    return pd.Series([HREF.sub(lambda m, b=b: m[1] + urljoin(b or "", m[2]) + m[3], h or "") for h, b in zip(html, base, strict=True)], dtype="object")


def links_text(html: Column, base: Column | None = None) -> Column:
    """Plain text in which links read 'label [target]' and cells are parted by bars; with a base, targets are absolute."""
    html = html if base is None else absolute_links(html, base)
    out = F.regexp_replace(html, r"(?is)<a\b[^>]*?href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a\s*>", "$2 [$1]")
    return text_of(F.regexp_replace(out, r"(?i)</t[dh]\s*>\s*<t[dh][^>]*>", " | "))

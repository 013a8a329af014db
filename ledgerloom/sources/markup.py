"""Parsing of single documents in Python workers: HTML, numbered lists, list lines, release tables, workbooks.

A document is bounded, so each function takes one document and returns its rows; Spark spreads documents over tasks.
"""

from __future__ import annotations

import io
import re
import zipfile
from html.parser import HTMLParser
from xml.etree import ElementTree

LINES, CELLS = {"br", "p", "div", "tr", "li", "table", "h1", "h2", "h3", "h4", "h5", "h6"}, {"td", "th"}
BLOCKS = {"br", "p", "div", "tr", "td", "th", "li", "table", "h1", "h2", "h3", "h4", "h5", "h6"}
WIDE = 180  # longest plausible name
# Header words, by priority, and labels of serial columns.
NAME_HEADERS = ("name", "company", "entity", "institution")
HEADER = re.compile(r"name|company|entity|institution|sl\.?\s*no", re.I)
SERIAL = re.compile(r"^(sl\.?\s*no\.?|s\.?\s*no\.?)$", re.I)
FUND_END = re.compile(r"(?:limited|ltd\.?|private|pvt\.?(?:\s*limited|\s*ltd\.?)?|\(p\)\s*ltd\.?|company)\s*$", re.I)
NOT_FUND = re.compile(r"[%₹]|\b(charges|fee|click|scheme)\b", re.I)
ENTRY = re.compile(r"""(?<![A-Za-z0-9])(\d{1,9})(?:[.)](?=\s+[A-Za-z0-9"'(])|[.)](?=[A-Za-z"'(])|(?=\t[A-Za-z0-9"'(]))""")

BLANKS = re.compile(r"\s*")
PLAIN = re.compile(r"(?:^|\s)(\d{1,9})[.)]\s+", re.A)
PROSE = re.compile(r"(?:^|\s)(\d{1,9})\.\s+", re.A)


def flat(text: str) -> str:
    return " ".join(text.split())


class Page(HTMLParser):
    """Tables (rows of cells), links (href, text, row's text) and plain text of a page; scripts and styles are left out."""

    def __init__(self, html: str | None):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.links: list[tuple[str, str, str]] = []
        self.row_ids: dict[int, str] = {}  # by identity of a row: first intmId among its links
        self._text: list[str] = []
        self._shape: list[str] = []  # the same with breaks where a browser shows them
        self._open: list[dict] = []  # tables being read, outermost first
        self._link: list | None = None
        self._hidden = 0
        self._row_links: list[list] = []
        self.feed(html or "")
        self.close()
        while self._open:
            self._end_table()
        self._end_row_links()
        raw = "".join(self._text)
        self.text, self.lines = flat(raw), re.sub(r"\s*\n\s*", "\n", re.sub("[ \t]+", " ", raw)).strip()

    @property
    def rendered(self) -> str:
        """Text with a line per block and a tab per cell, as a browser renders it."""
        lines = (re.sub(r"\t+", "\t", "\t".join(flat(c) for c in x.split("\t"))).strip() for x in "".join(self._shape).split("\n"))
        return "\n".join(x for x in lines if x)

    def _break(self, tag: str):
        if tag in LINES or tag in CELLS:
            self._shape.append("\n" if tag in LINES else "\t")

    def _put(self, data: str):
        self._text.append(data)
        for t in self._open:
            if t["cell"] is not None:
                t["cell"].append(data)
        if self._link is not None:
            self._link[1].append(data)
        for w in self._row_links:
            w[2].append(data)

    def _end_cell(self):
        t = self._open[-1]
        if t["cell"] is not None:
            row, t["cell"] = "".join(t["cell"]), None
            t["row"].append(flat(row))

    def _end_row(self):
        if self._open:
            self._end_cell()
            self._open[-1]["row"] = None

    def _end_table(self):
        self._end_row()
        self._open.pop()

    def _end_row_links(self):
        for href, words, around in self._row_links:
            self.links.append((href, flat("".join(words)), flat("".join(around))))
        self._row_links = []

    def handle_starttag(self, tag, attrs):
        if tag not in CELLS:
            self._break(tag)
        if tag in ("script", "style"):
            self._hidden += 1
        elif tag == "table":
            rows: list[list[str]] = []
            self.tables.append(rows)
            self._open.append({"rows": rows, "row": None, "cell": None})
        elif tag == "tr":
            self._end_row()
            self._end_row_links()
            self._around = []
            if self._open:
                self._open[-1]["row"] = row = []
                for t in self._open:
                    t["rows"].append(row)
        elif tag in ("td", "th") and self._open:
            self._end_cell()
            if self._open[-1]["row"] is not None:
                self._open[-1]["cell"] = []
        elif tag == "br":
            self._put(" ")
        elif tag == "a" and (href := dict(attrs).get("href")):
            lead = [" ".join(self._open[-1]["row"] or []), " ", *(self._open[-1]["cell"] or [])] if self._open else []
            self._link = [href, [], lead]
            self._row_links.append(self._link)
            if found := re.search(r"intmId=(\d+)", href):
                for t in self._open:
                    if t["row"] is not None:
                        self.row_ids.setdefault(id(t["row"]), found.group(1))

    def handle_endtag(self, tag):
        self._break(tag)
        if tag in ("script", "style"):
            self._hidden = max(0, self._hidden - 1)
        elif tag == "a":
            self._link = None
        elif tag in ("td", "th") and self._open:
            self._end_cell()
        elif tag == "tr":
            self._end_row()
            self._end_row_links()
        elif tag == "table" and self._open:
            self._end_table()
        elif tag in ("li", "p", "div") and not self._open:
            self._end_row_links()
        if tag in BLOCKS:
            self._put(" ")

    def handle_data(self, data):
        if not self._hidden:
            self._put(data)
            self._shape.append(re.sub(r"\s", " ", data))


def tables(html: str | None, least_rows: int = 2) -> list[list[list[str]]]:
    """Tables of a page without their empty rows; those with fewer than `least_rows` are left out."""
    kept = ([r for r in t if any(r)] for t in Page(html).tables)
    return [t for t in kept if len(t) >= least_rows]


def header_row(rows: list[list[str]]) -> int | None:
    """First of the leading 15 rows with two cells or more that holds a label; else the first with two cells."""
    wide = [i for i, r in enumerate(rows[:15]) if sum(1 for c in r if c) >= 2]
    return next((i for i in wide if any(HEADER.search(c) for c in rows[i])), wide[0] if wide else None)


def name_column(header: list[str]) -> int:
    """Column by the priority of header words, else the first."""
    return next((i for w in NAME_HEADERS for i, h in enumerate(header) if w in h.lower()), 0)


def hub_counts(html: str | None) -> list[tuple[str, str, int]]:
    """(intmId, label, count) of linked rows under a `count` header; the last row of an id wins."""
    page, out = Page(html), {}
    for rows in page.tables:
        h = next((i for i, r in enumerate(rows) if any(c.lower() == "count" for c in r)), None)
        if len(rows) < 2 or h is None:
            continue
        col = [c.lower() for c in rows[h]].index("count")
        for r in rows[h + 1 :]:
            key = page.row_ids.get(id(r))
            if key and col < len(r) and re.fullmatch(r"[0-9]+", r[col]):
                out[key] = ((r[1] if len(r) > 1 and r[1] else r[0]), int(r[col]))
    return [(k, *v) for k, v in out.items()]


def numbered_entries(section: str | None, restart: bool = False, reject: str | None = None) -> list[str]:
    """Bodies of the entries of a numbered list. A number counts only if it carries the sequence on (gaps of one pass)."""
    text, bad, marks, last = section or "", re.compile(reject, re.I) if reject else None, [], 0
    for m in ENTRY.finditer(text):
        digits = m.group(1)
        n = int(digits)
        starts = n <= 3 if not marks else last < n <= last + 2 or (restart and n == 1 and last > 1)
        if (len(digits) > 1 and digits[0] == "0") or not starts:
            continue
        body = BLANKS.match(text, m.end()).end()
        if bad and bad.match(text[body : body + 40]):
            continue
        marks.append((m.start(), body))
        last = n
    ends = [s for s, _ in marks[1:]] + [len(text)]
    return [text[b:e] for (_, b), e in zip(marks, ends)]


def split_at_numbers(text: str | None, mark: re.Pattern, near: int | None = None) -> list[str]:
    """Bodies between the numbers that `mark` finds. One of four digits or more counts only if it follows the one before, as years and codes
    do not; from `near` characters on any has to, and the list ends at the first that does not."""
    text, marks, last, at = text or "", [], None, 0
    while m := mark.search(text, at):
        digits, n = m.group(1), int(m.group(1))
        follows = last is not None and n == last + 1
        if near is not None and m.start() >= near and not follows and len(digits) < 4:
            return [text[b:e] for (_, b), e in zip(marks, [*(s for s, _ in marks[1:]), m.start()])]
        if follows or len(digits) < 4:
            marks.append((m.start(), m.end()))
            last, at = n, m.end()
        else:
            at = m.end(1)
    return [text[b:e] for (_, b), e in zip(marks, [*(s for s, _ in marks[1:]), len(text)])]


def plain_entries(text: str | None) -> list[str]:
    """Entries of a plain list."""
    return split_at_numbers(text, PLAIN, 6000)


def prose_entries(text: str | None) -> list[str]:
    """What follows each number of a list in running text."""
    return split_at_numbers(text, PROSE)


def list_line_names(text: str | None, heading: str, keyword: str, stop: str | None = None, most: int = 40) -> list[str]:
    """Names among the lines after the last heading that has three or more below it; else among all lines."""
    head, key, end = re.compile(heading, re.I), re.compile(keyword, re.I), re.compile(stop, re.I) if stop else None
    lines = [x for x in (flat(re.sub(r"^[\s•·*\-–]+", "", x)) for x in (text or "").split("\n")) if x]

    def names(some):
        good = (x for x in some if 8 <= len(x) <= 120 and key.search(x) and FUND_END.search(x) and not NOT_FUND.search(x))
        return list({re.sub("[^a-z0-9]", "", x.lower()): x for x in reversed(list(good))}.values())[::-1]

    for i in reversed(range(len(lines))):
        if len(lines[i]) < 80 and head.search(lines[i]):
            below = lines[i + 1 :]
            cut = next((j for j, x in enumerate(below) if end and end.search(x)), len(below))
            if len(got := names(below[: min(cut, most)])) >= 3:
                return got
    return names(lines)


def _text_of(node, shared: list[str], formats) -> str:
    kind, value = node.get("t"), node.find("{*}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in node.iterfind(".//{*}t"))
    raw = (value.text or "") if value is not None else ""
    if kind == "s" and raw:
        return shared[int(raw)]
    if kind is None and raw and int(node.get("s", 0)) in formats:
        from datetime import date, timedelta

        return str(date(1899, 12, 30) + timedelta(days=int(float(raw))))
    return raw[:-2] if kind is None and raw.endswith(".0") else raw


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    own = {int(f.get("numFmtId")) for f in root.iterfind(".//{*}numFmt") if re.search("[dy]", f.get("formatCode", ""))}
    styles = root.find("{*}cellXfs")
    return {i for i, x in enumerate(styles if styles is not None else []) if int(x.get("numFmtId", 0)) in own | {14, 15, 16, 17, 22}}


def workbook(content: bytes) -> list[tuple[str, int, list[str]]]:
    """(sheet, row number, cells) of every row that holds anything, in the workbook's order of sheets. Dates are ISO days."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = set(book.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iterfind(".//{*}t")) for si in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iterfind(".//{*}si")]
        dates = _date_styles(book)
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        out = []
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iterfind(".//{*}sheet"):
            target = rels[next(v for k, v in sheet.attrib.items() if k.endswith("}id"))].lstrip("/")
            root = ElementTree.fromstring(book.read(target if target.startswith("xl/") else f"xl/{target}"))
            for n, row in enumerate(root.iterfind(".//{*}row")):
                cells: list[str] = []
                for c in row.iterfind(".//{*}c"):
                    letters = re.match("[A-Z]*", c.get("r", "")).group()
                    at = 0
                    for x in letters:
                        at = at * 26 + ord(x) - 64
                    cells.extend([""] * (at - 1 - len(cells)))
                    cells.append(_text_of(c, shared, dates).strip())
                if any(cells):
                    out.append((sheet.get("name"), n, cells))
        return out


def workbook_names(content: bytes) -> tuple[list[tuple[str, str | None]], str | None]:
    """((name, classification) of all sheets, title). A sheet about reconstruction companies classifies its rows as ARC."""
    by_sheet: dict[str, list[list[str]]] = {}
    for sheet, _, cells in workbook(content):
        by_sheet.setdefault(sheet, []).append(cells)
    out: dict[str, str | None] = {}
    title = None
    for sheet, rows in by_sheet.items():
        h = header_row(rows)
        if h is None:
            continue
        first = " ".join(c for c in rows[0] if c)
        title = title or (first if h else None)
        arc = re.search(r"\bARC\b|Asset Reconstruction", f"{sheet}\n{first}", re.I)
        col = name_column(rows[h])
        kind = next((i for i, c in enumerate(rows[h]) if c.strip().lower() == "classification"), None)
        for r in rows[h + 1 :]:
            name = r[col].strip() if col < len(r) else ""
            if name and not SERIAL.match(name) and len(name) <= WIDE:
                given = "ARC" if arc else (r[kind].strip() or None) if kind is not None and kind < len(r) else None
                out[name] = given or out.get(name)
    return list(out.items()), title

"""Per-file decoders: survey export bytes -> cells.

Each decoder turns one file's bytes into ``(row_id, col_ord, value)`` cells,
all values as text. Rows 0 and 1 are the two header rows. They run inside
``mapInPandas`` tasks, one file at a time, and yield cells in chunks, so a
large export never has to sit in memory as a table.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET

from visitlens.functions.text import header_text, identifier

#: Cells in one frame that a task hands on.
CHUNK = 50_000
#: Most characters in a field of a CSV export; a file with a longer one is rejected.
FIELD_LIMIT = 1 << 24

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_TYPED = re.compile(r"([+-]?[0-9]*[.,]?[0-9]+([eE][+-]?[0-9]+)?|[0-9]{1,4}[/.-][0-9]{1,2}[/.-][0-9]{1,4}([ T][0-9:.]+)?|(?i:true|false))\Z")
_COL_RE = re.compile(r"([A-Z]+)(\d+)")


def _col_index(letters: str) -> int:
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def csv_cells(data: bytes, encoding: str = "utf-8-sig") -> Iterator[tuple[int, int, str | None]]:
    text = io.StringIO(data.decode(encoding, errors="replace"), newline="")
    limit = csv.field_size_limit(FIELD_LIMIT)
    try:
        for r, row in enumerate(csv.reader(text)):
            for c, v in enumerate(row):
                yield r, c, (v if v != "" else None)
    finally:
        csv.field_size_limit(limit)


@dataclass
class Layout:
    """What the first rows of a file say about its columns."""

    depth: int                                  # header rows
    headers: dict[int, tuple[str, str, int]]    # column -> (top, sub, nth)
    respondent: int | None = None               # columns that hold a row's keys
    client: int | None = None
    venue: int | None = None


def is_typed(value: str | None) -> bool:
    """A number, date, time or truth value: data, not a header."""
    return bool(value and _TYPED.match(value.strip()))


def header_depth(rows: dict[int, dict[int, str | None]]) -> int:
    """One or two header rows, by the evidence of a file's first rows.

    A blank or repeated cell in the first row is a merged header, so a second row
    names its columns. A first row that names client and venue is that of a
    master, and typed values in the second row are answers: one header row. Else
    the second row holds texts or nothing, as the sub-headers of an export do.
    """
    top, second = rows.get(0, {}), rows.get(1, {})
    width = 1 + max([*top, *second], default=-1)
    names = [top.get(c) for c in range(width)]
    if not all(names) or len(set(names)) < len(names):
        return 2
    if {identifier(n) for n in names} >= {"client_name", "venue_name"}:
        return 1
    return 1 if any(map(is_typed, second.values())) else 2


def layout_of(rows: dict[int, dict[int, str | None]]) -> Layout:
    """Header rows, column names and key columns from a file's first rows.

    Blank top cells take the text to their left, as under a merged header;
    other blanks get a placeholder name. In a master (one header row that names
    client and venue) those columns are keys of a row, not answers.
    """
    depth = header_depth(rows)
    tops, subs = rows.get(0, {}), rows.get(1, {}) if depth == 2 else {}
    found, seen, left = {}, Counter(), None
    for col in sorted({*tops, *subs}):
        left = tops.get(col) or (left if depth == 2 else None)
        top = left or f"Unnamed: {col}_level_0"
        sub = subs.get(col) or f"Unnamed: {col}_level_1"
        found[col] = (top, sub, seen[top, sub])
        seen[top, sub] += 1
    names = {c: identifier(header_text(top, sub)) for c, (top, sub, _) in found.items()}
    first = {name: c for c, name in reversed(names.items())}
    out = Layout(depth, found, first.get("respondent_id"))
    if depth == 1 and {"client_name", "venue_name"} <= first.keys():
        out.client, out.venue = first["client_name"], first["venue_name"]
        out.headers = {c: h for c, h in found.items() if names[c] not in ("client_id", "client_name", "venue_name")}
    return out


def read_layout(cells: Iterator[tuple[int, int, str | None]]) -> Layout:
    """``layout_of`` a file's cells, all of which are read."""
    rows: dict[int, dict[int, str | None]] = {}
    for row, col, value in cells:
        if row < 2:
            rows.setdefault(row, {})[col] = value
    return layout_of(rows)


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    try:
        raw = z.read("xl/sharedStrings.xml")
    except KeyError:
        return []
    out = []
    for si in ET.fromstring(raw).iter(f"{_NS}si"):
        # plain text, or rich-text runs; phonetic guides (rPh) are not cell text
        plain = si.find(f"{_NS}t")
        runs = "".join(r.findtext(f"{_NS}t") or "" for r in si.findall(f"{_NS}r"))
        out.append((plain.text or "") if plain is not None else runs)
    return out


# Built-in number formats that show dates or times (ECMA-376 part 1, 18.8.30).
_BUILTIN_DATE_FORMATS = set(range(14, 23)) | set(range(45, 48))


def _is_date_format(code: str) -> bool:
    text = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code)
    return bool(re.search(r"[ydhs]", text, re.IGNORECASE))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    """Indexes of cell styles whose number format is a date or time."""
    try:
        root = ET.fromstring(z.read("xl/styles.xml"))
    except KeyError:
        return set()
    custom = {int(f.get("numFmtId")): f.get("formatCode", "")
              for f in root.iter(f"{_NS}numFmt")}
    xfs = root.find(f"{_NS}cellXfs")
    out = set()
    for i, xf in enumerate(xfs if xfs is not None else []):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _BUILTIN_DATE_FORMATS or (fid in custom and _is_date_format(custom[fid])):
            out.add(i)
    return out


def _uses_1904(z: zipfile.ZipFile) -> bool:
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
    except KeyError:
        return False
    pr = wb.find(f"{_NS}workbookPr")
    return pr is not None and pr.get("date1904") in ("1", "true")


def _serial_to_text(serial: str, date1904: bool) -> str:
    """Excel day number -> ISO date (with time when it has one); a fraction
    below one day is a time of day."""
    import datetime as dt
    value = float(serial)
    base = dt.datetime(1904, 1, 1) if date1904 else dt.datetime(1899, 12, 30)
    when = base + dt.timedelta(days=value)
    when = when.replace(microsecond=0) + dt.timedelta(seconds=round(when.microsecond / 1e6))
    if 0 <= value < 1:  # a time of day without a date
        return when.strftime("%H:%M:%S")
    return when.strftime("%Y-%m-%d") if when.time() == dt.time(0) else when.strftime("%Y-%m-%d %H:%M:%S")


def _first_sheet(z: zipfile.ZipFile) -> str:
    names = z.namelist()
    try:
        wb = ET.fromstring(z.read("xl/workbook.xml"))
        rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
        sheet = wb.find(f"{_NS}sheets/{_NS}sheet")
        rid = sheet.get(f"{_REL_NS}id")
        for rel in rels:
            if rel.get("Id") == rid:
                target = rel.get("Target").lstrip("/")
                return target if target.startswith("xl/") else "xl/" + target
    except (KeyError, AttributeError):
        pass
    sheets = sorted(n for n in names if n.startswith("xl/worksheets/sheet"))
    return sheets[0]


def xlsx_cells(data: bytes) -> Iterator[tuple[int, int, str | None]]:
    """Cells of the first worksheet; date-styled numbers become ISO dates."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        strings = _shared_strings(z)
        date_styles = _date_styles(z)
        date1904 = _uses_1904(z)
        with z.open(_first_sheet(z)) as fh:
            # r is optional on rows and cells: then the place follows the previous one
            row, col = -1, -1
            for event, el in ET.iterparse(fh, events=("start", "end")):
                if event == "start":
                    if el.tag == f"{_NS}row":
                        row, col = int(el.get("r", row + 2)) - 1, -1
                    continue
                if el.tag != f"{_NS}c":
                    if el.tag == f"{_NS}row":
                        el.clear()
                    continue
                place = _COL_RE.match(el.get("r", ""))
                col = _col_index(place.group(1)) if place else col + 1
                kind = el.get("t", "n")
                if kind == "inlineStr":
                    val = "".join(t.text or "" for t in el.iter(f"{_NS}t"))
                else:
                    v = el.find(f"{_NS}v")
                    val = v.text if v is not None else None
                    if val is not None and kind == "s":
                        val = strings[int(val)]
                    elif val is not None and kind == "b":
                        val = "True" if val == "1" else "False"
                    elif val is not None and kind == "n" and int(el.get("s", "0")) in date_styles:
                        val = _serial_to_text(val, date1904)
                yield row, col, (val if val != "" else None)


def cells_for(path: str, data: bytes) -> Iterator[tuple[int, int, str | None]]:
    lower = path.lower()
    if lower.endswith(".xlsx"):
        return xlsx_cells(data)
    if lower.endswith(".csv"):
        return csv_cells(data)
    raise ValueError(f"unsupported survey file type: {path}")

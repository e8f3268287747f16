"""A minimal workbook writer for tests."""

import zipfile
from datetime import datetime
from xml.sax.saxutils import escape, quoteattr

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
EPOCH = datetime(1899, 12, 30)


class Raw(str):
    """Cell XML written as it is."""


def letters(i):
    text = ""
    i += 1
    while i:
        i, rest = divmod(i - 1, 26)
        text = chr(65 + rest) + text
    return text


def cell(row, i, value, shared):
    at = f'r="{letters(i)}{row}"'
    if value is None:
        return ""
    if isinstance(value, Raw):
        return value.format(at=at)
    if isinstance(value, bool):
        return f'<c {at} t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime):
        days = (value - EPOCH).total_seconds() / 86400
        return f'<c {at} s="1"><v>{days!r}</v></c>'
    if isinstance(value, (int, float)):
        return f"<c {at}><v>{value!r}</v></c>"
    if value not in shared:
        shared.append(value)
    return f'<c {at} t="s"><v>{shared.index(value)}</v></c>'


def write(path, tabs):
    """``tabs``: name -> list of rows of values."""
    shared = []
    sheets = {}
    for n, rows in enumerate(tabs.values(), start=1):
        xml = "".join(
            f'<row r="{r}">' + "".join(cell(r, i, v, shared) for i, v in enumerate(row)) + "</row>"
            for r, row in enumerate(rows, start=1)
            if any(v is not None for v in row)
        )
        sheets[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet {MAIN}><sheetData>{xml}</sheetData></worksheet>"
    names = "".join(
        f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="rId{n}"/>'
        for n, name in enumerate(tabs, start=1)
    )
    links = "".join(
        f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>'
        for n in range(1, len(tabs) + 1)
    )
    strings = "".join(f"<si><t>{escape(s)}</t></si>" for s in shared)
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="[Red]0.0&quot;d&quot;"/>'
        '<numFmt numFmtId="165" formatCode="dd\\-mmm\\-yyyy;@"/></numFmts>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
    )
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("xl/workbook.xml", f"<workbook {MAIN} {REL}><sheets>{names}</sheets></workbook>")
        archive.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
            f"{links}</Relationships>",
        )
        archive.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        archive.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
        for name, xml in sheets.items():
            archive.writestr(name, xml)

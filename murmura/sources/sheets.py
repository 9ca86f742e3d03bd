"""Workbooks (.xlsx) for people: several sheets of bounded size, written and read with the standard library alone."""
from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a sheet holds at most; a larger table is left out.
SHEET_ROWS = 1_000_000
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float, Decimal)) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>" if isinstance(value, (int, float)) else f"<c><v>{value}</v></c>"
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_BAD.sub("", str(value)))}</t></is></c>'


def _rows(df: DataFrame) -> Iterator[str]:
    yield f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>'
    yield "<row>" + "".join(map(_cell, df.columns)) + "</row>"
    for row in df.toLocalIterator():
        yield "<row>" + "".join(map(_cell, row)) + "</row>"
    yield "</sheetData></worksheet>"


def sheet_name(name: str) -> str:
    """A name that a sheet may have."""
    return re.sub(r"[\[\]:*?/\\]", "_", name)[:31] or "sheet"


def write(sheets: dict[str, DataFrame], path: str, most: int = SHEET_ROWS) -> list[str]:
    """Writes a sheet for each table of at most `most` rows; returns the names of those that were left out as too large."""
    kept = {n: df for n, df in sheets.items() if df.limit(most + 1).count() <= most}
    names = [sheet_name(n) for n in kept]
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for i, df in enumerate(kept.values(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as out:
                for part in _rows(df):
                    out.write(part.encode())
        n = range(1, len(names) + 1)
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}"><sheets>' + "".join(
            f'<sheet name={quoteattr(x)} sheetId="{i}" r:id="r{i}"/>' for i, x in zip(n, names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships">' + "".join(
            f'<Relationship Id="r{i}" Type="{_REL}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in n) + "</Relationships>")
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="r1" Type="{_REL}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>' + "".join(
                       f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in n) + "</Types>")
    return [x for x in sheets if x not in kept]


def _column(ref: str | None, at: int) -> int:
    letters = re.match("[A-Z]+", ref or "")
    if not letters:
        return at
    n = 0
    for c in letters[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def cells(path: str) -> dict[str, list[list[str | None]]]:
    """The sheets of a workbook as rows of texts; a file that is no workbook has none."""
    m = f"{{{_MAIN}}}"
    try:
        z = zipfile.ZipFile(path)
    except (OSError, zipfile.BadZipFile):
        return {}
    with z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in s.iter(f"{m}t")) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{m}si")]
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        out = {}
        for sheet in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{m}sheet"):
            target = targets[sheet.get(f"{{{_REL}}}id")].lstrip("/")
            rows: list[list[str | None]] = []
            for row in ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter(f"{m}row"):
                own: list[str | None] = []
                for c in row.iter(f"{m}c"):
                    at = _column(c.get("r"), len(own))
                    own += [None] * (at - len(own))
                    value = c.find(f"{m}v")
                    if c.get("t") == "inlineStr":
                        own.append("".join(t.text or "" for t in c.iter(f"{m}t")))
                    elif value is None:
                        own.append(None)
                    else:
                        own.append(shared[int(value.text)] if c.get("t") == "s" else value.text)
                rows.append(own)
            out[sheet.get("name")] = rows
    return out


def read(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A sheet (the first, unless it is named) as columns of texts, named by its first row."""
    found = cells(path)
    rows = found.get(sheet) if sheet else next(iter(found.values()), None)
    if not rows:
        return spark.createDataFrame([], "term string")
    names = [x or f"column{i}" for i, x in enumerate(rows[0])]
    body = [tuple((r + [None] * len(names))[: len(names)]) for r in rows[1:]]
    return spark.createDataFrame(body, ", ".join(f"`{n}` string" for n in names))


# What a column of terms is called.
TERM_NAMES = ("term", "关键词", "词", "token")


def terms(table: DataFrame, source: str) -> DataFrame:
    """term, df, tf, source of any sheet that has a column of terms: by its usual names, or any name with term in it; each term once."""
    lower = {c.lower(): c for c in table.columns}
    column = next((lower[n] for n in TERM_NAMES if n in lower), None) or next((c for c in table.columns if "term" in c.lower()), None)
    if column is None:
        return table.sparkSession.createDataFrame([], "term string, df double, tf double, source string")
    number = lambda n: (F.col(f"`{lower[n]}`").try_cast("double") if n in lower else F.lit(None).cast("double")).alias(n)
    rows = table.select(F.trim(F.col(f"`{column}`")).alias("term"), number("df"), number("tf")).where("term is not null")
    return rows.groupBy("term").agg(F.max("df").alias("df"), F.max("tf").alias("tf")).withColumn("source", F.lit(source))

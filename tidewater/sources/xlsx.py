"""Excel workbooks (.xlsx) as a distributed source.

Workbooks are listed with the ``binaryFile`` source and decoded inside tasks
(``mapInPandas``), one workbook at a time, rows streamed out in batches -- no
workbook passes through the driver, and many workbooks load in parallel.

Decoding yields one row per sheet row: positional ``names`` (the header),
``kinds`` and ``texts`` arrays. Column types are then inferred with one aggregate over the
cells (the rules pandas applies to a sheet):

* no value at all -> STRING
* only integral numbers and no blanks -> BIGINT; other numbers -> DOUBLE
* only booleans and no blanks -> BOOLEAN
* only dates -> TIMESTAMP
* anything else -> STRING

and a single projection turns the cells into typed columns. Texts that mean
"no value" (``NA_TEXTS``) count as blanks; dates follow the workbook's epoch.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (file format constants) -------------------------------------
NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
# Built-in number formats that display dates/times.
DATE_FORMAT_IDS = set(range(14, 23)) | {27, 28, 29, 30, 31, 34, 35, 36, 45, 46, 47, 50, 51, 52, 53, 54, 55, 56, 57, 58}
EXCEL_EPOCH = _dt.datetime(1899, 12, 30)
EPOCH_1904 = _dt.datetime(1904, 1, 1)
# Cell texts that mean "no value" (pandas' defaults).
NA_TEXTS = {"", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
            "NULL", "NaN", "None", "n/a", "nan", "null"}
# -----------------------------------------------------------------------------

CELLS_SCHEMA = ("path string, sheet string, row_index bigint, "
                "names array<string>, kinds array<string>, texts array<string>")
BATCH_ROWS = 5000


_COL_CACHE: dict[str, int] = {}


def _col_index(ref: str) -> int:
    """Zero-based column of a cell reference such as ``AB12``."""
    letters = ref.rstrip("0123456789")
    idx = _COL_CACHE.get(letters)
    if idx is None:
        n = 0
        for ch in letters:
            n = n * 26 + (ord(ch) - 64)
        idx = _COL_CACHE[letters] = n - 1
    return idx


def _is_date_format(code: str) -> bool:
    code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", code.lower())
    return any(ch in code for ch in "dmyhs") and "general" not in code


def _serial_to_text(v: float, epoch: _dt.datetime = EXCEL_EPOCH) -> str:
    ts = epoch + _dt.timedelta(days=v)
    ts = ts.replace(microsecond=round(ts.microsecond / 1000) * 1000) if ts.microsecond else ts
    return ts.isoformat(sep=" ")


def _number_text(raw: str) -> tuple[str, str]:
    """Integral text stays an integer; anything with a point or exponent is a float."""
    raw = raw.strip()
    digits = raw[1:] if raw[:1] in "+-" else raw
    if digits.isdigit() and digits.isascii():
        return "int", str(int(raw))
    return "float", repr(float(raw))


class Workbook:
    """Minimal reader for the parts of an .xlsx needed to get cell values."""

    def __init__(self, data: bytes):
        self.zip = zipfile.ZipFile(io.BytesIO(data))
        names = set(self.zip.namelist())
        self.shared = self._shared_strings() if "xl/sharedStrings.xml" in names else []
        self.date_styles = self._date_styles() if "xl/styles.xml" in names else set()
        self.epoch = EXCEL_EPOCH
        self.sheets = self._sheets()

    def _shared_strings(self) -> list[str]:
        out = []
        for _, el in ET.iterparse(self.zip.open("xl/sharedStrings.xml")):
            if el.tag == NS + "si":
                out.append("".join(t.text or "" for t in el.iter(NS + "t")))
                el.clear()
        return out

    def _date_styles(self) -> set[int]:
        root = ET.parse(self.zip.open("xl/styles.xml")).getroot()
        custom = {int(n.get("numFmtId")): n.get("formatCode", "") for n in root.iter(NS + "numFmt")}
        xfs = root.find(NS + "cellXfs")
        out = set()
        for i, xf in enumerate(xfs if xfs is not None else []):
            fid = int(xf.get("numFmtId", "0"))
            if fid in DATE_FORMAT_IDS or (fid in custom and _is_date_format(custom[fid])):
                out.add(i)
        return out

    def _sheets(self) -> list[tuple[str, str]]:
        wb = ET.parse(self.zip.open("xl/workbook.xml")).getroot()
        props = wb.find(NS + "workbookPr")
        if props is not None and props.get("date1904", "0").lower() in ("1", "true"):
            self.epoch = EPOCH_1904
        rels = ET.parse(self.zip.open("xl/_rels/workbook.xml.rels")).getroot()
        targets = {r.get("Id"): r.get("Target") for r in rels.iter(PKG_REL_NS + "Relationship")}
        out = []
        for s in wb.iter(NS + "sheet"):
            t = targets[s.get(REL_NS + "id")]
            t = t.lstrip("/") if t.startswith("/") else "xl/" + t
            out.append((s.get("name"), t))
        return out

    def rows(self, sheet: str | None):
        """Yield (row_number, {col_index: (kind, text)}) for one sheet (first when None)."""
        if sheet is None:
            name, part = self.sheets[0]
        else:
            match = [x for x in self.sheets if x[0] == sheet]
            if not match:
                raise ValueError(f"Worksheet named '{sheet}' not found")
            name, part = match[0]
        for _, el in ET.iterparse(self.zip.open(part)):
            if el.tag != NS + "row":
                continue
            rnum = int(el.get("r"))
            cells = {}
            for i, c in enumerate(el.iter(NS + "c")):
                ref = c.get("r")
                idx = _col_index(ref) if ref else i
                t = c.get("t", "n")
                v = c.find(NS + "v")
                val = v.text if v is not None else None
                if t == "s" and val is not None:
                    cells[idx] = ("str", self.shared[int(val)])
                elif t == "inlineStr":
                    cells[idx] = ("str", "".join(x.text or "" for x in c.iter(NS + "t")))
                elif t == "b" and val is not None:
                    cells[idx] = ("bool", "true" if val.strip() == "1" else "false")
                elif t in ("str", "e") and val is not None:
                    cells[idx] = ("str", val)
                elif t == "d" and val is not None:
                    cells[idx] = ("date", val.replace("T", " "))
                elif val is not None and val != "":
                    if int(c.get("s", "0")) in self.date_styles:
                        cells[idx] = ("date", _serial_to_text(float(val), self.epoch))
                    else:
                        cells[idx] = _number_text(val)
            cells = {k: v for k, v in cells.items() if v[1] != "" or v[0] != "str"}
            yield rnum, cells
            el.clear()


COLUMNS = ["path", "sheet", "row_index", "names", "kinds", "texts"]


def blank_kinds(n: int) -> list:
    return [None] * n


def _decode(sheet: str | None, header: bool):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                wb = Workbook(bytes(content))
                names: dict[int, str] | None = None
                header_names: list[str] | None = None
                sheet_name = sheet or wb.sheets[0][0]
                out = []
                row_no = 0
                width = 0
                last = 0  # sheet row number of the last emitted (or header) row
                for rnum, cells in wb.rows(sheet):
                    if names is None:
                        if not cells:
                            continue
                        last = rnum
                        width = max(cells) + 1
                        if header:
                            names = {}
                            seen: dict[str, int] = {}
                            for i in range(width):
                                n = cells[i][1] if i in cells else f"Unnamed: {i}"
                                if n in seen:
                                    seen[n] += 1
                                    n = f"{n}.{seen[n]}"
                                else:
                                    seen[n] = 0
                                names[i] = n
                            continue
                        names = {i: str(i) for i in range(width)}
                        last = rnum - 1
                    if not cells:
                        continue  # blank rows count only when data follows them
                    if header_names is None:
                        width = max(max(names) + 1, width)
                        header_names = [names.get(i, f"Unnamed: {i}") for i in range(width)]
                    for _ in range(rnum - last - 1):  # inner blank rows stay, trailing ones do not
                        out.append((path, sheet_name, row_no, header_names, blank_kinds(len(header_names)),
                                    blank_kinds(len(header_names))))
                        row_no += 1
                    last = rnum
                    extra = max(cells) + 1 - len(header_names)
                    if extra > 0:  # data wider than the header row
                        header_names = header_names + [f"Unnamed: {len(header_names) + i}" for i in range(extra)]
                    kinds = [None] * len(header_names)
                    texts = [None] * len(header_names)
                    for i, (k, t) in cells.items():
                        if k != "str" or t not in NA_TEXTS:
                            kinds[i], texts[i] = k, t
                    out.append((path, sheet_name, row_no, header_names, kinds, texts))
                    row_no += 1
                    if len(out) >= BATCH_ROWS:
                        yield pd.DataFrame(out, columns=COLUMNS)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=COLUMNS)
    return run


def read_cells(spark: SparkSession, path, sheet: str | None = None, header: bool = True,
               first_only: bool = False) -> DataFrame:
    """One row per sheet row of every workbook under ``path``: (path, sheet, row_index, cells)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]").load(path)
    if first_only:
        # the first workbook (by key order) of each directory; decided on paths only,
        # so no workbook content is read for the choice
        listing = files.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"))
        first = listing.groupBy("dir").agg(F.min("path").alias("path")).select("path")
        files = files.join(first, on="path", how="left_semi")
    return files.select("path", "content").mapInPandas(_decode(sheet, header), CELLS_SCHEMA)


def infer_types(cells: DataFrame) -> DataFrame:
    """(column_name, position, spark_type) from aggregates over the cells.

    Counts are taken per workbook and column first: a column exists for every
    row of a workbook once any row has it (rows before a wider data row count
    as blanks, as in a sheet read whole), then summed over workbooks.
    """
    e = cells.select("path", F.posexplode(F.arrays_zip("names", "kinds")).alias("position", "c"))
    k = F.col("c.kinds")
    per_col = e.groupBy("path", F.col("c.names").alias("column_name")).agg(
        F.min("position").alias("position"),
        F.count_if(k.isNotNull()).alias("present"),
        F.count_if(k == "int").alias("ints"),
        F.count_if(k == "float").alias("floats"),
        F.count_if(k == "bool").alias("bools"),
        F.count_if(k == "date").alias("dates"))
    rows = cells.groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
    agg = per_col.join(rows, "path").groupBy("column_name").agg(
        F.min("position").alias("position"),
        F.sum(F.col("rows") - F.col("present")).alias("blank"),
        F.sum("present").alias("present"),
        F.sum("ints").alias("ints"), F.sum("floats").alias("floats"),
        F.sum("bools").alias("bools"), F.sum("dates").alias("dates"))
    present = F.col("present")
    t = (F.when(present == 0, "string")
          .when((F.col("ints") == present) & (F.col("blank") == 0), "bigint")
          .when(F.col("ints") + F.col("floats") == present, "double")
          .when((F.col("bools") == present) & (F.col("blank") == 0), "boolean")
          .when(F.col("dates") == present, "timestamp")
          .otherwise("string"))
    return agg.select("column_name", "position", t.alias("spark_type"))


def typed_rows(cells: DataFrame, types: list[tuple[str, str]], ntz: bool = True) -> DataFrame:
    """Project cells onto typed columns (one projection); a workbook without a
    column gives NULLs for it."""
    cols = []
    for name, t in types:
        pos = F.array_position("names", F.lit(name))
        text = F.when(pos > 0, F.element_at("texts", pos.cast("int")))
        if t == "bigint":
            v = text.try_cast("bigint")
        elif t == "double":
            v = text.try_cast("double")
        elif t == "boolean":
            v = text.try_cast("boolean")
        elif t == "timestamp":
            v = text.try_cast("timestamp_ntz" if ntz else "timestamp")
        else:
            v = text
        cols.append(v.alias(name))
    return cells.select(*cols, F.col("path").alias("_source_path"))


def read_xlsx(spark: SparkSession, path, sheet: str | None = None, header: bool = True,
              first_only: bool = False, keep_path: bool = False, **_) -> DataFrame:
    """Typed DataFrame of a sheet across all workbooks under ``path``.

    Workbooks are decoded once: the decoded cells are checkpointed to the
    session's (shared) checkpoint directory, and both the type inference and
    the typed projection read that copy.
    """
    from tidewater.session import shared_dir
    shared_dir(spark)  # make sure a reliable checkpoint directory is set
    cells = read_cells(spark, path, sheet, header, first_only).checkpoint(eager=True)
    types = [(r["column_name"], r["spark_type"]) for r in infer_types(cells).orderBy("position").collect()]
    out = typed_rows(cells, types)
    return out if keep_path else out.drop("_source_path")


# --- writer (fixtures and tests) ---------------------------------------------------

def _cell_xml(ref: str, v) -> str:
    if v is None or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v!r}</v></c>'
    if isinstance(v, (_dt.datetime, _dt.date, pd.Timestamp)):
        if not isinstance(v, _dt.datetime):
            v = _dt.datetime(v.year, v.month, v.day)
        serial = (v - EXCEL_EPOCH).total_seconds() / 86400
        return f'<c r="{ref}" s="1"><v>{serial!r}</v></c>'
    s = (str(v).replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;"))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{s}</t></is></c>'


def _ref(col: int, row: int) -> str:
    s = ""
    col += 1
    while col:
        col, r = divmod(col - 1, 26)
        s = chr(65 + r) + s
    return f"{s}{row}"


def workbook_bytes(sheets: dict[str, tuple[list[str], list[tuple]]]) -> bytes:
    """An .xlsx with one sheet per entry ``name -> (headers, rows)``."""
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        names = list(sheets)
        z.writestr("[Content_Types].xml",
                   '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
                   '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                   '<Default Extension="xml" ContentType="application/xml"/>'
                   '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
                   '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
                   + "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
                             for i in range(len(names))) + "</Types>")
        z.writestr("_rels/.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml",
                   '<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
                   'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>'
                   + "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, n in enumerate(names))
                   + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   + "".join(f'<Relationship Id="rId{i + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
                             for i in range(len(names)))
                   + f'<Relationship Id="rId{len(names) + 1}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/>'
                   + "</Relationships>")
        z.writestr("xl/styles.xml",
                   '<?xml version="1.0" encoding="UTF-8"?><styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                   '<numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy-mm-dd hh:mm:ss"/></numFmts>'
                   '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/></cellXfs></styleSheet>')
        for i, n in enumerate(names):
            headers, rows = sheets[n]
            body = ["<row r=\"1\">" + "".join(_cell_xml(_ref(j, 1), h) for j, h in enumerate(headers)) + "</row>"]
            for r, row in enumerate(rows, start=2):
                body.append(f'<row r="{r}">' + "".join(_cell_xml(_ref(j, r), v) for j, v in enumerate(row)) + "</row>")
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml",
                       '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                       "<sheetData>" + "".join(body) + "</sheetData></worksheet>")
    return buf.getvalue()


def write_workbooks(df: DataFrame, out_dir: str, headers: list[str], sheet: str = "Hoja 1",
                    prefix: str = "libro") -> list[str]:
    """Write each input partition of ``df`` as one workbook under ``out_dir``
    (from the tasks, through pyarrow's filesystem layer). Returns the file paths.
    File names follow the partition index, so task retries are idempotent."""
    out_dir = out_dir.rstrip("/")

    def write(batches):
        from pyarrow import fs as pafs
        from pyspark import TaskContext
        rows = []
        for pdf in batches:
            boxed = pdf.astype(object).where(pdf.notna(), None)
            rows.extend(boxed.itertuples(index=False, name=None))
        if not rows:
            return
        # one file name per input partition: a retried task overwrites its own file
        target = f"{out_dir}/{prefix}_{TaskContext.get().partitionId():05d}.xlsx"
        uri = target.replace("file:///", "/").replace("file:/", "/") if target.startswith("file:") else target
        filesystem, p = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
        filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(p) as f:
            f.write(workbook_bytes({sheet: (headers, rows)}))
        yield pd.DataFrame({"path": [target]})

    return [r["path"] for r in df.mapInPandas(write, "path string").collect()]

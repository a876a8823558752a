import datetime as dt
import os

import pytest

from tidewater.session import scratch_path, local_path
from tidewater.sources import xlsx


def _write(spark, sheets, name="libro.xlsx"):
    d = scratch_path(spark, "xlsx-test")
    p = local_path(d)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "wb") as f:
        f.write(xlsx.workbook_bytes(sheets))
    return d


def test_type_inference_golden(spark):
    headers = ["int_col", "float_col", "bool_col", "dt_col", "str_col", "all_null"]
    rows = [(1, 1.5, True, dt.datetime(2024, 1, 1), "a", None), (2, 2.5, False, dt.datetime(2024, 1, 2), "b", None)]
    d = _write(spark, {"Sheet1": (headers, rows)})
    df = xlsx.read_xlsx(spark, d)
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("int_col", "bigint"), ("float_col", "double"), ("bool_col", "boolean"), ("dt_col", "timestamp_ntz"),
        ("str_col", "string"), ("all_null", "string")]
    assert [tuple(r) for r in df.orderBy("int_col").collect()] == [
        (1, 1.5, True, dt.datetime(2024, 1, 1), "a", None), (2, 2.5, False, dt.datetime(2024, 1, 2), "b", None)]


def test_blanks_turn_ints_into_doubles_and_bools_into_text(spark):
    d = _write(spark, {"S": (["i", "b", "m"], [(1, True, 1), (None, None, "x")])})
    types = dict((r[0], r[2]) for r in xlsx.infer_types(xlsx.read_cells(spark, d)).collect())
    assert types == {"i": "double", "b": "string", "m": "string"}


def test_sheet_by_name_and_missing_sheet(spark):
    d = _write(spark, {"Primera": (["a"], [(1,)]), "Hoja 2": (["b"], [("x",), ("y",)])})
    assert xlsx.read_xlsx(spark, d, sheet="Hoja 2").count() == 2
    assert xlsx.read_xlsx(spark, d).columns == ["a"]
    with pytest.raises(Exception, match="not found"):
        xlsx.read_xlsx(spark, d, sheet="Nope").count()


def test_no_header_and_duplicate_headers(spark):
    d = _write(spark, {"S": (["x", "x", None], [(1, 2, 3)])})
    assert xlsx.read_xlsx(spark, d).columns == ["x", "x.1", "Unnamed: 2"]
    assert xlsx.read_xlsx(spark, d, header=False).count() == 2


def test_csv_null_marker_and_empty_guard(spark):
    from tidewater.sources import files
    d = scratch_path(spark, "csv-test")
    p = local_path(d)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "a.csv"), "w") as f:
        f.write("id;name\n1;\\N\n2;x\n")
    with open(os.path.join(p, "notes.txt"), "w") as f:
        f.write("ignored")
    rows = sorted(tuple(r) for r in files.read_csv(spark, d).collect())
    assert rows == [("1", None), ("2", "x")]
    rows_v1 = sorted(tuple(r) for r in files.read_csv(spark, d, null_value=None).collect())
    assert rows_v1 == [("1", "\\N"), ("2", "x")]
    inferred = files.read_csv(spark, d, infer=True)
    assert dict(inferred.dtypes)["id"] == "int"
    e = scratch_path(spark, "csv-empty")
    os.makedirs(local_path(e), exist_ok=True)
    with open(os.path.join(local_path(e), "h.csv"), "w") as f:
        f.write("id;name\n")
    with pytest.raises(ValueError, match="CSV read returned empty DataFrame"):
        files.require_rows(files.read_csv(spark, e), "csv")


def test_first_only_reads_one_workbook(spark):
    d = scratch_path(spark, "xlsx-two")
    p = local_path(d)
    os.makedirs(p, exist_ok=True)
    for name, rows in (("a.xlsx", [(1,)]), ("b.xlsx", [(2,), (3,)])):
        with open(os.path.join(p, name), "wb") as f:
            f.write(xlsx.workbook_bytes({"S": (["n"], rows)}))
    assert xlsx.read_xlsx(spark, d).count() == 3
    assert [r.n for r in xlsx.read_xlsx(spark, d, first_only=True).collect()] == [1]


def test_inner_blank_rows_kept_trailing_dropped(spark):
    d = _write(spark, {"S": (["a", "b"], [(1, "x"), (None, None), (3, "z"), (None, None), (None, None)])})
    rows = [tuple(r) for r in xlsx.read_xlsx(spark, d).collect()]
    assert rows == [(1.0, "x"), (None, None), (3.0, "z")]


def test_extension_match_is_case_insensitive(spark):
    from tidewater.sources import files
    d = scratch_path(spark, "csv-upper")
    p = local_path(d)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "DATA.CSV"), "w") as f:
        f.write("id;name\n1;a\n")
    assert files.read_csv(spark, d).count() == 1


def test_data_wider_than_header(spark):
    d = _write(spark, {"S": (["a"], [(1,), (2, 7)])})
    types = {r[0]: r[2] for r in xlsx.infer_types(xlsx.read_cells(spark, d)).collect()}
    assert types == {"a": "bigint", "Unnamed: 1": "double"}
    assert [tuple(r) for r in xlsx.read_xlsx(spark, d).collect()] == [(1, None), (2, 7.0)]


def _excel_style_workbook() -> bytes:
    """A workbook laid out the way spreadsheet applications write it: shared
    strings, a built-in date format, formulas with cached values, error cells."""
    import io
    import zipfile
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    sheet = (f'<?xml version="1.0"?><worksheet {ns}><sheetData>'
             '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c>'
             '<c r="D1" t="s"><v>3</v></c></row>'
             '<row r="2"><c r="A2" t="s"><v>4</v></c><c r="B2" s="1"><v>45292</v></c>'
             '<c r="C2"><f>1+1</f><v>2</v></c><c r="D2" t="e"><v>#N/A</v></c></row>'
             '<row r="3"><c r="A3" t="s"><v>5</v></c><c r="B3" s="1"><v>45293.5</v></c>'
             '<c r="C3" t="str"><f>"x"</f><v>x</v></c><c r="D3" t="b"><v>1</v></c></row>'
             '</sheetData></worksheet>')
    shared = (f'<?xml version="1.0"?><sst {ns} count="6" uniqueCount="6">'
              '<si><t>Nombre</t></si><si><t>Fecha</t></si><si><t>Calc</t></si><si><t>Otro</t></si>'
              '<si><r><t>Ana </t></r><r><t>María</t></r></si><si><t>Luis &amp; Co</t></si></sst>')
    styles = (f'<?xml version="1.0"?><styleSheet {ns}><cellXfs count="2"><xf numFmtId="0"/>'
              '<xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>')
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook {ns} {rel}><sheets>'
                                      '<sheet name="Datos" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Type="worksheet" Target="/xl/worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", sheet)
        z.writestr("xl/sharedStrings.xml", shared)
        z.writestr("xl/styles.xml", styles)
    return buf.getvalue()


def test_application_written_workbook(spark):
    d = scratch_path(spark, "xlsx-app")
    p = local_path(d)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "app.xlsx"), "wb") as f:
        f.write(_excel_style_workbook())
    df = xlsx.read_xlsx(spark, d, sheet="Datos")
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        ("Nombre", "string"), ("Fecha", "timestamp_ntz"), ("Calc", "string"), ("Otro", "string")]
    rows = [tuple(r) for r in df.collect()]
    assert rows == [("Ana María", dt.datetime(2024, 1, 1), "2", None),
                    ("Luis & Co", dt.datetime(2024, 1, 2, 12, 0), "x", "true")]

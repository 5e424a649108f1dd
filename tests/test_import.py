from __future__ import annotations

import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

from conftest import plan_of
from ledgerflow.sources.delimited import (
    fit_staging_slots,
    import_delimited,
    import_summary,
    source_files,
)
from ledgerflow.sources.lines import (
    BLOCK,
    FILE,
    LINE,
    VALUE,
    carry_over_blocks,
    read_lines,
    scan_blocks,
)
from ledgerflow.templates import ImportTemplate, LoadSettings, resolve_names


def write(folder, name, lines, encoding="utf-8", end="\n"):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes((end.join(lines) + end).encode(encoding))
    return str(folder)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def template(**settings):
    return ImportTemplate(table_name="t", **{"separator": ",", **settings})


def test_lines_are_numbered_along_the_whole_file(spark, tmp_path, small_blocks):
    texts = {f"f{i}": [f"{i} line {n} " + "x" * (n % 50) for n in range(n_lines)]
             for i, n_lines in enumerate((300, 1, 40, 170))}
    for name, lines in texts.items():
        write(tmp_path / "in", name, lines)
    lines = read_lines(spark, str(tmp_path / "in"))
    assert lines.select(FILE, BLOCK).distinct().count() > 20
    marked = lines.withColumn("tenth", F.col(VALUE).rlike(r" line \d*0 "))
    marked = marked.withColumn("seen", F.when(F.col("tenth"), F.col(VALUE)))
    scanned = scan_blocks(marked, counts={"n": "tenth"}, carry={"last": "seen"})
    out = carry_over_blocks(scanned, [LINE, "n"], ["last"]).collect()
    found = {(r[FILE].rsplit("/", 1)[1], r[LINE]): (r[VALUE], r["n"], r["last"]) for r in out}
    wanted = {}
    for name, lines in texts.items():
        for i, text in enumerate(lines):
            wanted[(name, i + 1)] = (text, i // 10 + 1, lines[i // 10 * 10])
    assert found == wanted


def test_small_arrow_batches_change_nothing(spark, tmp_path, small_blocks):
    write(tmp_path / "in", "f", [f"r{i}" for i in range(400)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        scanned = scan_blocks(read_lines(spark, str(tmp_path / "in")))
        out = carry_over_blocks(scanned, [LINE]).collect()
        assert sorted((r[LINE], r[VALUE]) for r in out) == [(i + 1, f"r{i}") for i in range(400)]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """What executors run must load where only the public libraries are installed."""
    taken = {}

    class Lines:
        schema = T.StructType([T.StructField(FILE, T.StringType()), T.StructField(BLOCK, T.LongType())])

        def mapInArrow(self, function, schema):
            taken["function"] = function

    scan_blocks(Lines())
    (tmp_path / "task.pickle").write_bytes(cloudpickle.dumps(taken["function"]))
    code = "import pickle; print(pickle.load(open('task.pickle', 'rb')).__name__)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.strip() == "number", done.stderr


def test_sheet_window_and_mapping(spark, tmp_path):
    """Two lines of preamble, a margin column, then five named ones."""
    names = ["Branch", "Till", "Drawn at", "Sum", "Note"]
    lines = ["Daily report,,,,,", "made by the till system,,,,,", "-,Hue,7,08:15,12.50,cash", "-,Hue,9,08:20,3.00,"]
    path = write(tmp_path / "in", "a.txt", lines)
    mapping = {"Branch": "branch_name", "Till": "till_no", "Drawn at": "drawn", "Sum": "amount", "Note": "remark"}
    out = import_delimited(
        spark, path,
        template(header=tuple(names), column_mapping=mapping, start_row=3, start_col=2, sheet_rules=True),
    )
    assert out.columns == ["BRANCH_NAME", "TILL_NO", "DRAWN", "AMOUNT", "REMARK"]
    assert rows(out) == [("Hue", "7", "08:15", "12.50", "cash"), ("Hue", "9", "08:20", "3.00", None)]


def test_headerless_rows_of_other_widths_lose_nothing(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h", "1,2", "1,2,3,4"])
    with pytest.raises(Exception, match="more than 2 cells"):
        import_delimited(spark, path, template(sheet_rules=True)).collect()
    wide = import_delimited(spark, path, template(sheet_rules=True, end_col=4))
    assert rows(wide) == [("1", "2", "3", "4"), ("1", "2", None, None)]


def test_each_headerless_file_has_a_width_of_its_own(spark, tmp_path, small_blocks):
    """Under sheet rules an empty cell in a file's first row ends that file's data, no other's."""
    write(tmp_path / "in", "a.csv", ["a,b,,d", "e,f,g,h"])
    path = write(tmp_path / "in", "b.csv", ["1,2,3,4", "5,6"])
    out = import_delimited(spark, path, template(sheet_rules=True, start_row=1))
    assert rows(out) == [("1", "2", "3", "4"), ("5", "6", None, None), ("a", "b", None, None), ("e", "f", None, None)]
    write(tmp_path / "in", "c.csv", ["", "x,y,z,u,v,w", *[f"{n}," + "q" * 40 for n in range(30)]])
    for settings in ({}, {"sheet_rules": True}, {"end_row": 40}):
        out = import_delimited(spark, path, template(start_row=1, **settings))
        assert out.columns == [f"C{k}" for k in range(1, 7)] and out.count() == 35
        assert ("x", "y", "z", "u", "v", "w") in rows(out)
    moved = import_delimited(spark, path, template(start_row=1, start_col=3, sheet_rules=True))
    assert ("3", "4", None, None) in rows(moved) and ("z", "u", "v", "w") in rows(moved)
    write(tmp_path / "in", "c.csv", ["x,y,z,u,v,w", "1,2,3,4,5,6,7"])
    with pytest.raises(Exception, match="more than 6 cells"):
        import_delimited(spark, path, template(start_row=1)).collect()
    write(tmp_path / "in", "c.csv", ["x", "1,2"])
    with pytest.raises(Exception, match="more than 1 cells"):
        import_delimited(spark, path, template(start_row=1, sheet_rules=True)).select("C4").collect()


def test_a_line_break_inside_quotes_stops_the_import(spark, tmp_path):
    kept = ["h,i", '5" pipe,x', '"a ""b"" c",5"', '"a,""b",c"d"e', '"",""', 'x,""""']
    path = write(tmp_path / "in", "a", kept)
    for settings, count in (({}, 5), ({"sheet_rules": True}, 4)):
        out = import_delimited(spark, path, template(header=("a", "b"), **settings), strict=False)
        assert ('5" pipe', "x") in rows(out) and out.count() == count
    for broken in ('1,"two', '"a ""b""', '"a,b",x,"', '"two ""'):
        write(tmp_path / "in", "a", ["h,i", "1,2", broken, 'lines",x'])
        for settings in ({"header": ("a", "b")}, {"sheet_rules": True}, {"header": ("a", "b"), "end_col": 2}):
            with pytest.raises(Exception, match="line break inside quotes"):
                import_delimited(spark, path, template(**settings)).select(F.col("*")).collect()


def test_unknown_encodings_are_refused_before_the_job(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h", "é"], encoding="latin-1")
    for name in ("utf-16", "shift_jis", "cp037", "gb18030", "no such", "utf-7", "hz", "rot13"):
        with pytest.raises(ValueError, match=name):
            import_delimited(spark, path, template(header=("a",), encoding=name))
    assert rows(import_delimited(spark, path, template(header=("a",), encoding="latin1"))) == [("é",)]


@pytest.mark.parametrize("name", ["windows-1252", "cp1251", "iso8859-15", "koi8-r", "cp437", "windows-1258"])
def test_code_pages_have_the_letters_of_their_codec(spark, tmp_path, name):
    known = [bytes([k]) for k in range(33, 256) if k not in b",\"" and bytes([k]).decode(name, "ignore")]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a").write_bytes(b"h\n" + b"\n".join(b"x" + k for k in known) + b"\n")
    out = import_delimited(spark, str(folder), template(header=("v",), encoding=name))
    assert sorted(r.V for r in out.collect()) == sorted("x" + k.decode(name) for k in known)


def test_a_file_that_a_code_page_does_not_fit_goes_on_to_the_next(spark, tmp_path):
    folder = tmp_path / "in"
    write(folder, "page", ["h", "5 € “x”"], "windows-1252")
    write(folder, "utf8", ["h", "plain", "Đường"])
    (folder / "neither").write_bytes(b"h\nplain two\n\x81\xe9\n")
    out = import_delimited(spark, str(folder), template(header=("v",), encoding="cp1252"))
    assert rows(out) == sorted([("5 € “x”",), ("plain",), ("Đường",), ("plain two",), ("\x81é",)], key=str)
    whole = import_delimited(spark, str(folder / "page"), template(header=("v",), encoding="cp1251"))
    assert plan_of(import_delimited(spark, str(folder / "page"), template(header=("v",), encoding="iso8859-5"))).count("FileScan text") == 1
    assert whole.count() == 1


def test_texts_like_na_may_be_values(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h,i", "NA,", "None,x"])
    kept = import_delimited(spark, path, template(header=("a", "b"), missing_texts=False))
    assert rows(kept) == [("NA", None), ("None", "x")]


def test_trusted_utf8_is_read_once(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["1,2"])
    settings = template(header=("a", "b"), start_row=1, encoding="utf-8")
    out = import_delimited(spark, path, settings, detect_encoding=False)
    assert plan_of(out).count("FileScan text") == 1


def test_values_stay_text_and_missing_cells_are_null(spark, tmp_path):
    path = write(tmp_path / "in", "a.csv", ["h1,h2", "007, x ", "NA,", '"a,b","say ""hi"""', "", "  ", "7"])
    out = import_delimited(spark, path, template(header=("a", "b")))
    wanted = [("007", " x "), (None, None), ("a,b", 'say "hi"'), ("7", None)]
    assert rows(out) == sorted(wanted, key=str)


def test_end_row_counts_filled_rows_per_file(spark, tmp_path, small_blocks):
    body = [f"{i},{'y' * 20}" for i in range(100)]
    write(tmp_path / "in", "a", ["head", "", "x,x", *body[:5], "", *body[5:]])
    write(tmp_path / "in", "b", ["head", "", "x,x", *body[:3]])
    out = import_delimited(
        spark, str(tmp_path / "in"), template(header=("n", "y"), start_row=4, end_row=13)
    )
    assert sorted(int(r.N) for r in out.collect()) == sorted([*range(10), *range(3)])


def test_sheet_rows_end_at_the_first_empty_one(spark, tmp_path, small_blocks):
    lines = ["head", *[f"{i},{'z' * 30}" for i in range(60)], ",", *["late,row"] * 60, "", "later,x"]
    path = write(tmp_path / "in", "a", lines)
    stop = template(header=("n", "z"), sheet_rules=True, read_to_empty_row=True)
    assert import_delimited(spark, path, stop).count() == 60
    keep = template(header=("n", "z"), sheet_rules=True)
    assert import_delimited(spark, path, keep).count() == 121


def test_one_header_line_per_file_over_many_blocks(spark, tmp_path, small_blocks):
    for i in range(4):
        write(tmp_path / "in", f"f{i}", ["h", *[f"{i}-{n}" for n in range(200)]])
    out = import_delimited(spark, str(tmp_path / "in"), template(header=("v",)))
    assert sorted(r.V for r in out.collect()) == sorted(f"{i}-{n}" for i in range(4) for n in range(200))


def test_encoding_is_settled_per_file(spark, tmp_path):
    write(tmp_path / "in", "latin", ["h", "crème", "plain"], "ISO-8859-1")
    write(tmp_path / "in", "utf8", ["h", "Đồng é"])
    write(tmp_path / "in", "bom", ["﻿h", "bom é"])
    out = import_delimited(spark, str(tmp_path / "in"), template(header=("v",)))
    assert rows(out) == [("bom é",), ("crème",), ("plain",), ("Đồng é",)]
    fixed = template(header=("v",), encoding="ISO-8859-1")
    assert ("crème",) in rows(import_delimited(spark, str(tmp_path / "in"), fixed))


def test_carriage_returns(spark, tmp_path):
    path = write(tmp_path / "in", "dos", ["h", "a,1", "", "b,2"], end="\r\n")
    assert rows(import_delimited(spark, path, template(header=("x", "y")))) == [("a", "1"), ("b", "2")]


def test_a_row_that_is_too_wide_stops_a_strict_import(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h", "1,2", "1,2,3"])
    with pytest.raises(Exception, match="more than 2 cells"):
        import_delimited(spark, path, template(header=("a", "b"))).select("B").collect()
    loose = import_delimited(spark, path, template(header=("a", "b")), strict=False)
    assert rows(loose) == [("1", "2"), ("1", "2")]


def test_header_fit(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h", "1,2,,4"])
    longer = template(header=("a", "b", "c", "d", "e"), sheet_rules=True)
    assert rows(import_delimited(spark, path, longer)) == [("1", "2", None, "4", None)]
    shorter = template(header=("a",), sheet_rules=True)
    assert rows(import_delimited(spark, path, shorter)) == [("1",)]
    none = template(sheet_rules=True)
    assert import_delimited(spark, path, none).columns == ["C1", "C2"]
    assert import_delimited(spark, path, template()).columns == ["C1", "C2", "C3", "C4"]
    window = template(header=("b", "c"), start_col=2, end_col=3)
    assert rows(import_delimited(spark, path, window)) == [("2", None)]
    with pytest.raises(ValueError, match="header names"):
        import_delimited(spark, path, template(header=("b",), start_col=2, end_col=3))


def test_a_map_of_another_length_is_left_out():
    assert resolve_names(["a", "b"], {"a": "x", "b": "y"}) == ["X", "Y"]
    assert resolve_names(["a", "b"], {"a": "x"}) == ["A", "B"]
    assert resolve_names(["a"], {}) == ["A"]


def test_repeated_names_and_missing_files(spark, tmp_path):
    path = write(tmp_path / "in", "a", ["h", "1,2"])
    with pytest.raises(ValueError, match="Duplicate"):
        import_delimited(spark, path, template(header=("a", "A")))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        import_delimited(spark, str(tmp_path / "nowhere"), template(header=("a",)))


def test_summary_and_slots(spark, tmp_path):
    write(tmp_path / "in", "a", ["h", "abcdef,1", "b,2"])
    path = write(tmp_path / "in", "b", ["h", "c,3"])
    out = import_delimited(
        spark, path, template(header=("Field_01_3", "Field_02_15")), file_column="FILE"
    )
    found = {r.FILE.rsplit("/", 1)[1]: (r.row_count, r.column_count) for r in import_summary(out, "FILE").collect()}
    assert found == {"a": (2, 2), "b": (1, 2)}
    write(tmp_path / "in", "empty one", ["h"])
    told = import_summary(out, "FILE", source_files(spark, path, "FILE")).collect()
    assert sorted((r.FILE.rsplit("/", 1)[1].replace("%20", " "), r.row_count) for r in told) == [
        ("a", 2), ("b", 1), ("empty one", 0),
    ]
    assert {r.column_types for r in told} == {"FIELD_01_3 string, FIELD_02_15 string"}
    assert sorted(r.FIELD_01_3 for r in fit_staging_slots(out).collect()) == ["abc", "b", "c"]


def test_templates_read_flags_and_windows():
    made = ImportTemplate.from_dict(
        {
            "table_name": "t", "header": ["a"], "sheet_rules": "Yes", "truncate_first": "y",
            "end_row": None, "load": {"load_type": "Incremental", "key_columns": ["a"]},
        }
    )
    assert made.sheet_rules and not made.truncate_first and made.end_row == 0
    assert made.load == LoadSettings("Incremental", None, ("a",)) and made.load.incremental
    assert (made.skip_rows, made.max_rows, made.first_col) == (1, None, 0)

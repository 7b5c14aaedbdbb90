import pytest
from pyspark.errors import AnalysisException

from labelflow.schema import AUDIT_COLUMNS, CANONICAL_COLUMNS, SEARCH_KEYWORDS
from labelflow.sinks.records import write_collected_csv, write_records_csv
from labelflow.sources.keywords import keyword_list, keyword_table, read_keywords
from labelflow.sources.records import canonical, read_records_csv, without_audit

HEADER = "app_id,category_id,description,is_boundary_case\n"


def write(path, text, bom=False):
    path.write_bytes((b"\xef\xbb\xbf" if bom else b"") + text.encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("bom", [False, True])
def test_quotes_line_breaks_and_byte_order_mark(spark, tmp_path, bom):
    path = write(tmp_path / "in.csv", HEADER + 'a,EXC,"two\nlines, ""quoted""",True\nb,03, x 　,\n', bom)
    got = {r.app_id: r for r in read_records_csv(spark, path).collect()}
    assert got["a"].category_id == "EXC"
    assert got["a"].description == 'two\nlines, "quoted"'
    assert got["a"].is_boundary_case is True
    assert got["b"].category_id == "03"
    assert got["b"].description == " x 　"
    assert got["b"].is_boundary_case is None


def test_missing_value_tokens_become_null(spark, tmp_path):
    path = write(tmp_path / "in.csv", HEADER + "NA,null,None,\nb,,nan,False\n")
    got = sorted((tuple(r) for r in read_records_csv(spark, path).collect()), key=repr)
    assert got == [("b", None, None, False), (None, None, None, None)]


def test_columns_are_matched_by_name(spark, tmp_path):
    path = write(tmp_path / "in.csv", "category_id,app_id\n5,x\n")
    assert read_records_csv(spark, path).first().app_id == "x"


def test_files_with_another_header_are_rejected(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "1.csv", "app_id,category_id\na,1\n" * 1)
    write(folder / "2.csv", "category_id,app_id\n1,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_records_csv(spark, str(folder)).collect()


def test_round_trip(spark, tmp_path):
    values = ["plain", 'say "hi", now', "line\nbreak", " padded\t", "", None, "유전자", "back\\slash"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "app_id string, note string")
    write_records_csv(df, str(tmp_path / "out"))
    got = {r.app_id: r.note for r in read_records_csv(spark, str(tmp_path / "out")).collect()}
    assert [got[str(i)] for i in range(len(values))] == [v or None for v in values]


def test_collected_records_need_all_columns(spark, tmp_path):
    full = spark.createDataFrame([tuple("x" * 13)], ", ".join(f"{c} string" for c in CANONICAL_COLUMNS))
    extra = full.selectExpr("*", "'y' AS labeled_by", *[f"'z' AS {c}" for c in AUDIT_COLUMNS])
    assert canonical(extra).columns == CANONICAL_COLUMNS
    assert without_audit(extra).columns == [*CANONICAL_COLUMNS, "labeled_by"]
    with pytest.raises(AnalysisException):
        write_collected_csv(full.drop("note"), str(tmp_path / "out"))


def test_keyword_file_keeps_order_and_drops_blanks(spark, tmp_path):
    path = write(tmp_path / "kw.txt", "  수면 관리 \r\n\r\n　\nDNA 검사\n\nb\n", bom=True)
    table = read_keywords(spark, path)
    assert [tuple(r) for r in table.orderBy("pos").collect()] == [(0, "수면 관리"), (1, "DNA 검사"), (2, "b")]
    assert keyword_list(table) == ["수면 관리", "DNA 검사", "b"]


def test_default_keywords(spark):
    assert len(SEARCH_KEYWORDS) == 55
    assert keyword_list(keyword_table(spark)) == SEARCH_KEYWORDS


def test_cells_of_another_type_are_null(spark, tmp_path):
    path = tmp_path / "odd.csv"
    path.write_text("app_id,is_boundary_case,min_confidence\na,maybe,x\nb,true,0.5\n", encoding="utf-8")
    got = {r.app_id: (r.is_boundary_case, r.min_confidence) for r in read_records_csv(spark, str(path)).collect()}
    assert got["a"] == (None, None) and got["b"][0] is True

"""Readers on small files with the dirt each format can bring."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cadastre.sources import files
from cadastre.sources.csv import count_lines, read_csv
from cadastre.sources.json_pages import page_order, read_all_pages, read_chained_json, read_pages
from cadastre.sources.rest import flat_record, read_rest
from cadastre.sources.xml import read_xml, root_attributes
from cadastre.sources.tables import parameterised
from conftest import rows_of


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


# --- CSV ---------------------------------------------------------------------
def test_csv_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,x\n1,"a ""q"", b"\n2,\n3,""\n4,  pad \n\n')
    assert rows_of(read_csv(spark, path, ["id", "x"])) == [
        ("1", 'a "q", b'), ("2", ""), ("3", ""), ("4", "  pad ")]


@pytest.mark.parametrize("line", ["5", "5,a,b"])
def test_csv_bad_row_fails(spark, tmp_path, line):
    path = write(tmp_path / "a.csv", f"id,x\n1,a\n{line}\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_csv(spark, path, ["id", "x"]).collect()


def test_csv_bad_rows_up_to_a_limit(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,x\n1,a\n2\n3,b,c\n4,d\n")
    with pytest.raises(ValueError, match="2 bad rows"):
        read_csv(spark, path, ["id", "x"], max_bad_records=1)
    assert rows_of(read_csv(spark, path, ["id", "x"], max_bad_records=2)) == [("1", "a"), ("4", "d")]


def test_csv_header_only_and_delimiter(spark, tmp_path):
    assert read_csv(spark, write(tmp_path / "h.csv", "id;x\n"), ["id", "x"], delimiter=";").count() == 0
    assert read_csv(spark, write(tmp_path / "e.csv", ""), ["id", "x"]).count() == 0
    path = write(tmp_path / "d.csv", "1;2\n")
    assert rows_of(read_csv(spark, path, ["id", "x"], header=False, delimiter=";")) == [("1", "2")]


def test_csv_quoted_line_break(spark, tmp_path):
    path = write(tmp_path / "q.csv", 'id,x\n1,"a\nb"\n')
    assert rows_of(read_csv(spark, path, ["id", "x"], quoted_newlines=True)) == [("1", "a\nb")]


def test_line_count(spark, tmp_path):
    write(tmp_path / "a.csv", "id\n1\n\n  \n2\n")
    write(tmp_path / "b.csv", "")
    write(tmp_path / "c.csv", "id\n")
    got = {os.path.basename(r["file"]): r["lines"] for r in count_lines(spark, str(tmp_path)).collect()}
    assert got == {"a.csv": 2, "c.csv": 0}


# --- XML ---------------------------------------------------------------------
XML = """<?xml version='1.0'?>
<!-- a > b -->
<housing_index unit="a &amp; b" base='100'>
<country name="X"><observation><month> m1 </month><price_index></price_index><other>1</other></observation>
<observation><month/></observation></country>
<country name="Y"></country>
<country><observation><month>q</month><price_index>1.5</price_index></observation></country>
</housing_index>"""


def test_xml_grouped(spark, tmp_path):
    got = read_xml(spark, write(tmp_path / "a.xml", XML), ["month", "price_index"])
    assert got.columns == ["unit", "country", "month", "price_index"]
    assert rows_of(got) == sorted([
        ("a & b", "X", "m1", ""), ("a & b", "X", "", None), ("a & b", None, "q", "1.5")], key=repr)


def test_xml_flat(spark, tmp_path):
    got = read_xml(spark, write(tmp_path / "a.xml", XML), ["month"], group_tag=None,
                   root={"unit": "u", "base": "b", "none": "n"})
    assert rows_of(got) == [("a & b", "100", None, m) for m in ("", "m1", "q")]


def test_xml_monthly_index_shape(spark, tmp_path):
    body = "".join(
        f'<country name="{c}">' + "".join(
            f"<observation><month>2024-{m:02d}</month><price_index>{100 + m}.5</price_index></observation>"
            for m in range(1, 13)) + "</country>" for c in ("A", "B", "C"))
    path = write(tmp_path / "i.xml", f'<housing_index unit="index">{body}</housing_index>')
    got = read_xml(spark, path, ["month", "price_index"])
    assert got.count() == 36
    assert got.select(F.to_date("month", "yyyy-MM")).distinct().count() == 12


def test_xml_malformed_fails(spark, tmp_path):
    path = write(tmp_path / "a.xml", '<r unit="u"><country name="X"><observation><month>1</mont>'
                                     "</observation></country></r>")
    with pytest.raises(Exception, match="FAILED_READ|MALFORMED"):
        read_xml(spark, path, ["month"]).collect()


def test_root_attributes_of_split_files(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"{i}.xml", f'<r unit="u{i}">' + "<r unit='inner'><x>1</x></r>" * 50 + "</r>")
    assert rows_of(root_attributes(spark, str(tmp_path), {"unit": "unit"}), "unit") == [
        ("u0",), ("u1",), ("u2",)]


# --- JSON pages ----------------------------------------------------------------
def page(folder, name, following, *records, **extra):
    body = {"meta": {"next": following} if following != "null" else None, **extra}
    if records != (None,):
        body["data"] = list(records)
    (folder / name).write_text(json.dumps(body, ensure_ascii=False), encoding="utf-8")
    return str(folder / name)


def test_json_chain(spark, tmp_path):
    start = page(tmp_path, "p1.json", "p2.json", {
        "transaction_id": 7, "property": {"state": "NY", "fair_market_value": 250000.50, "new": True},
        "tags": [1, "é"], "none": None})
    page(tmp_path, "p2.json", "p1.json", {"transaction_id": "x", "property": {"state": "NJ"}, "extra": 1})
    page(tmp_path, "p9.json", "null", {"transaction_id": "unreachable"})
    order = page_order(spark, start)
    assert rows_of(order) == [("p1.json", 0), ("p2.json", 1)]
    placed = read_pages(spark, str(tmp_path), order, position="at")
    assert rows_of(placed, "at", "transaction_id") == [(0, "7"), (1, "x")]
    got = {r["transaction_id"]: r.asDict() for r in read_chained_json(spark, start).collect()}
    assert set(got) == {"7", "x"}
    assert got["7"] == {"transaction_id": "7", "property_state": "NY", "none": None, "extra": None,
                        "property_fair_market_value": "250000.5", "property_new": "True",
                        "tags": '[1, "é"]'}
    target = StructType.fromDDL("transaction_id string, property_state string, sale_price string")
    aligned = read_chained_json(spark, start, target)
    assert rows_of(aligned) == [("7", "NY", None), ("x", "NJ", None)]
    assert read_all_pages(spark, str(tmp_path / "*.json")).count() == 3


def test_json_pages_outside_the_chain_are_not_parsed(spark, tmp_path):
    start = page(tmp_path, "p1.json", "null", {"a": 1})
    page(tmp_path, "p2.json", "null", {"a": 2, "other": 3})
    got = read_chained_json(spark, start)
    assert got.columns == ["a"] and rows_of(got) == [("1",)]


def test_json_page_of_many_lines(spark, tmp_path):
    start = page(tmp_path, "p1.json", "p2.json", {"a": {"b": 1}})
    text = (tmp_path / "p1.json").read_text()
    (tmp_path / "p1.json").write_text(json.dumps(json.loads(text), indent=2))
    page(tmp_path, "p2.json", "null", {"a": {"c": [2, "x"]}})
    assert rows_of(read_chained_json(spark, start), "a_b", "a_c") == [("1", None), (None, '[2, "x"]')]
    (tmp_path / "p2.json").write_text('{"data": [{"a": ')
    with pytest.raises(Exception, match="p2.json|MALFORMED"):
        read_chained_json(spark, start).collect()


def test_long_chain(spark, tmp_path):
    for k in range(300):
        page(tmp_path, f"p{k:03d}.json", f"p{k + 1:03d}.json" if k < 299 else "null", {"k": k})
    got = read_pages(spark, str(tmp_path), page_order(spark, str(tmp_path / "p000.json")), position="at")
    assert rows_of(got, "at", "k") == sorted([(k, str(k)) for k in range(300)], key=repr)


def test_json_name_collision_last_wins(spark, tmp_path):
    start = page(tmp_path, "p1.json", "null", {"a_b": "flat", "a": {"b": "nested"}})
    schema = StructType.fromDDL("a_b string, a struct<b: string>")
    assert rows_of(read_chained_json(spark, start, record_schema=schema)) == [("nested",)]


def test_json_page_without_data_fails(spark, tmp_path):
    start = page(tmp_path, "p1.json", "p2.json", {"a": 1})
    page(tmp_path, "p2.json", "null", None)
    with pytest.raises(Exception, match="no field data in page p2.json"):
        read_chained_json(spark, start).collect()


def test_json_without_records_fails(spark, tmp_path):
    with pytest.raises(ValueError, match="no records"):
        read_chained_json(spark, page(tmp_path, "p1.json", "null"))


# --- REST ----------------------------------------------------------------------
COLUMNS = ["property", "auction_date", "minimum_bid", "final_bid", "status"]


def rest_folder(tmp_path, total, limit):
    for offset in range(0, total, limit):
        records = [{"property": f"p{i}", "auction_date": "0023-01-02", "final_bid": i, "unknown": 1}
                   for i in range(offset, min(offset + limit, total))]
        (tmp_path / f"offset={offset}.json").write_text(json.dumps(records))
    return str(tmp_path)


@pytest.mark.parametrize("total, readers", [(25, 1), (25, 3), (30, 4), (7, 8), (0, 2)])
def test_rest_reads_every_page_once(spark, tmp_path, total, readers):
    got = read_rest(spark, rest_folder(tmp_path, total, 10), COLUMNS, limit=10, readers=readers,
                    fetcher="fake_service:fetch")
    assert sorted(r["property"] for r in got.collect()) == sorted(f"p{i}" for i in range(total))
    assert got.columns == COLUMNS


def test_rest_page_bound(spark, tmp_path):
    got = read_rest(spark, rest_folder(tmp_path, 95, 10), COLUMNS, limit=10, maxPages=4, readers=3,
                    fetcher="fake_service:fetch")
    assert got.count() == 40


def test_rest_request_details(spark):
    row = read_rest(spark, "http://x", ["asked_q", "token", "limit", "timeout", "list", "none"],
                    fetcher="fake_service:echo", token="t", **{"param.q": "v", "limit": 500}).first()
    assert tuple(row) == ("v", "t", "500", "30.0", '[1, "é"]', None)


def test_rest_answer_that_is_no_list_fails(spark):
    with pytest.raises(Exception, match="not a list"):
        read_rest(spark, "http://x", COLUMNS, fetcher="fake_service:broken").collect()


def test_flat_record():
    assert flat_record({"a": {"b": {"c": 1.5}}, "d": True, "a_b": None, "l": [1]}) == {
        "a_b_c": "1.5", "d": "True", "a_b": None, "l": "[1]"}


# --- files and parameters --------------------------------------------------------
def test_file_moves(spark, tmp_path):
    source = write(tmp_path / "a.txt", "new")
    (tmp_path / "done").mkdir()
    write(tmp_path / "done" / "a.txt", "old")
    assert files.find(spark, str(tmp_path), "a.txt") == source
    moved = files.move(spark, source, str(tmp_path / "done"))
    assert open(moved).read() == "new" and not files.exists(spark, source)
    with pytest.raises(FileNotFoundError):
        files.find(spark, str(tmp_path), "a.txt")


def test_parameters_are_bound_not_pasted(spark):
    frame = spark.createDataFrame([("x' OR 'a'='a",), ("b",)], "v string")
    got = parameterised(spark, "SELECT v FROM {t} WHERE v = :v", {"v": "x' OR 'a'='a"}, t=frame)
    assert got.count() == 1

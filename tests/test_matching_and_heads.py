"""Names by pieces, XML heads, unique rules in one scan."""

import random

import pytest
from pyspark.sql import functions as F

from cadastre.operators.contracts import Contract, contract_report
from cadastre.operators.match import match_names
from cadastre.sources import xml
from conftest import rows_of

HEADS = {
    '<r note="a>b" unit="x"><c/></r>': {"note": "a>b", "unit": "x"},
    '<!-- old: > <r unit="wrong"> --><r unit="right"/>': {"unit": "right"},
    "<?xml version='1.0'?>\n<?x <r unit='no'?>\n<!DOCTYPE r [<!ENTITY e \"<r unit='no'>\"> <!-- ]> ' -->\n<!ELEMENT r ANY>]>\n<r\n unit = 'a\"b'\n\tk=\"\" >":
        {"unit": 'a"b', "k": ""},
    '<r a="&lt;&amp;amp;&#233;&#xE9;&unknown;" b="1\n2">': {"a": "<&amp;éé&unknown;", "b": "1 2"},
    "<r>": {}, "<r/>": {}, "<ns:r ns:unit='1' unit='2'/>": {"ns:unit": "1", "unit": "2"},
    "": None, "no xml": None, '<r unit="open': None, "<!-- <r>": None, "<r unit='x'": None, "<!DOCTYPE r [": None,
}


@pytest.mark.parametrize("text", HEADS)
def test_root_tag(text):
    assert xml.root_tag(text) == HEADS[text]


def test_heads_of_files(spark, tmp_path):
    body = "<country name='C'><observation><month>1</month></observation></country></r>"
    cases = {"a.xml": '<r note="a>b" unit="x">'.encode(), "b.xml": b'<!-- old: > <r unit="wrong"> --><r unit="right">',
             "c.xml": ("<!--" + "x" * 200_000 + "-->" + '<r unit="far">').encode(),
             "d.xml": '<?xml version="1.0" encoding="ISO-8859-1"?><r unit="é">'.encode("latin-1"),
             "e.xml": b"\xef\xbb\xbf<r>"}
    for name, start in cases.items():
        encoding = "latin-1" if name == "d.xml" else "utf-8"
        (tmp_path / name).write_bytes(start + body.encode(encoding))
    got = {r[xml.FILE].rsplit("/", 1)[1]: r["unit"] for r in xml.root_attributes(spark, str(tmp_path), {"unit": "unit"}).collect()}
    assert got == {"a.xml": "x", "b.xml": "right", "c.xml": "far", "d.xml": "é", "e.xml": None}
    rows = xml.read_xml(spark, str(tmp_path / "a.xml"), ["month"])
    assert rows_of(rows, "unit", "country", "month") == [("x", "C", "1")]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1  # the file is not scanned a second time


def plain_match(names, cities):
    from cadastre.functions.text import fold  # noqa: F401
    out = {}
    for name in names:
        found = [c for c in cities if c is not None and (c.lower() in name.lower() or name.lower() in c.lower())]
        if name and found:
            out[name] = min(found)
    return out


def test_names_by_pieces_equal_all_comparisons(spark):
    rng = random.Random(3)

    def word(low, high):
        return "".join(rng.choices("abc", k=rng.randint(low, high)))

    cities = sorted({word(1, 6) for _ in range(40)} | {"zz", "q"})
    names = sorted({word(1, 9) for _ in range(150)} | {"zzz", "xqx", "nothing", "z"})
    got = match_names(spark.createDataFrame([(n,) for n in [*names, None, ""]], "name string"),
                      spark.createDataFrame([(c,) for c in [*cities, None]], "city string"))
    assert {r["name"]: r["city"] for r in got.collect()} == plain_match(names, cities)


def test_a_very_long_name(spark):
    long = "x" * 100_000 + "medellin" + "y" * 50_000
    got = match_names(spark.createDataFrame([(long,), ("mede",)], "name string"),
                      spark.createDataFrame([("Medellin",), ("Cali",)], "city string"))
    assert sorted(r["city"] for r in got.collect()) == ["Medellin", "Medellin"]


def test_unique_rules_share_one_scan(spark):
    rows = [(1, "a", 1.0), (1, "b", None), (2, None, 2.0), (3, None, 2.0)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    contract = Contract("c", columns=tuple({"name": c, "constraints": ["unique"]} for c in ("i", "s", "d")))
    report = contract_report(df, contract, "2024-01-01 00:00:00")
    assert {r["check"]: r["observed"] for r in report.collect()} == {
        "row_count": 4, "i__unique": 1, "s__unique": 2, "d__unique": 2}
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Scan") == 2  # all row rules, all unique rules
    empty = contract_report(df.where(F.lit(False)), contract, "2024-01-01 00:00:00")
    assert {r["observed"] for r in empty.collect()} == {0}

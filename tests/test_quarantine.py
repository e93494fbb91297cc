import datetime

import pytest
from pyspark.sql import types as T

from locrank.schemas import OBSERVATIONS
from locrank.sources import BadRowsRule, MalformedRowsError, checked_csv

HEADER = "iso,location,date,total_cases,new_cases,note,total_deaths,new_deaths"


@pytest.fixture
def folder(tmp_path):
    def write(*files):
        for number, lines in enumerate(files):
            (tmp_path / f"part-{number}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        return str(tmp_path)

    return write


def test_good_and_bad_rows_come_out_separately(spark, folder):
    path = folder(
        [
            "x,Aland,2020-01-02,1.5,,free text,0,inf",
            "x,Bland,2020-01-02,n/a,1,a,0,0",
            "x,Cland,01/02/2020,1,1,a,zero,0",
            "x,Dland,2020-01-02",
        ],
        ["x,Eland,2020-01-03,2,1,a,0,0,too many", 'x,"F, land",2020-01-03,3,,,,', "x,Gland,2020-13-03,1,1,a,0,0"],
    )
    checked = checked_csv(spark, path, OBSERVATIONS)
    assert checked.good.schema == OBSERVATIONS
    good = sorted(tuple(r) for r in checked.good.collect())
    assert good == [
        ("Aland", datetime.date(2020, 1, 2), 1.5, None, 0.0, float("inf")),
        ("F, land", datetime.date(2020, 1, 3), 3.0, None, None, None),
    ]
    bad = {r.text.split(",")[1]: r for r in checked.bad.collect()}
    assert {name: r.reason for name, r in bad.items()} == {
        "Bland": "total_cases is not double: n/a",
        "Cland": "date is not date: 01/02/2020; total_deaths is not double: zero",
        "Dland": "not 8 fields",
        "Eland": "not 8 fields",
        "Gland": "date is not date: 2020-13-03",
    }
    assert bad["Dland"].text == "x,Dland,2020-01-02" and bad["Eland"].file.endswith("part-1.csv")
    assert (checked.row_count, checked.bad_count) == (7, 5)


def test_either_kind_is_the_same_whatever_columns_are_used(spark, folder):
    path = folder(["x,A,2020-01-02,n/a,1,a,0,0", "x,B,2020-01-02,1,1,a,0,0", "x,C,2020-01-02,1,1,a,0,no"])
    checked = checked_csv(spark, path, OBSERVATIONS)
    assert [r.location for r in checked.good.select("location").collect()] == ["B"]
    assert checked.good.count() == 1 and checked.bad.select("reason").count() == 2
    plan = checked.good.select("location")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<location:string>" in plan and "PartitionFilters" in plan


def test_rules_limit_the_bad_rows(spark, folder):
    path = folder(["x,A,2020-01-02,n/a,1,a,0,0", "x,B,2020-01-02,1,1,a,0,0"])
    assert checked_csv(spark, path, OBSERVATIONS, BadRowsRule(1, 0.5)).bad_count == 1
    for rule in (BadRowsRule(most_rows=0), BadRowsRule(most_share=0.4)):
        with pytest.raises(MalformedRowsError, match="1 malformed rows of 2") as raised:
            checked_csv(spark, path, OBSERVATIONS, rule)
        assert [r.reason for r in raised.value.bad.collect()] == ["total_cases is not double: n/a"]


def test_missing_columns_and_files_without_rows(spark, folder):
    path = folder([])
    checked = checked_csv(spark, path, OBSERVATIONS, BadRowsRule(0, 0.0))
    assert (checked.good.count(), checked.bad.count(), checked.row_count) == (0, 0, 0)
    with pytest.raises(ValueError, match="no column height"):
        checked_csv(spark, path, T.StructType([T.StructField("height", T.LongType())]))


def test_whole_numbers_with_a_fraction_are_malformed(spark, folder):
    path = folder(["x,A,2020-01-02,1.5,1,a,0,0", "x,B,2020-01-02,2,1,a,0,0"])
    schema = T.StructType([T.StructField("location", T.StringType()), T.StructField("total_cases", T.LongType())])
    checked = checked_csv(spark, path, schema)
    assert [tuple(r) for r in checked.good.collect()] == [("B", 2)]
    assert [r.reason for r in checked.bad.collect()] == ["total_cases is not bigint: 1.5"]

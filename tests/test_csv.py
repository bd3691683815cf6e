"""CSV reading: names, quotes, line breaks, bad rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lotwise.schema import CLEANED_COLUMNS, require_columns
from lotwise.sources.inventory import input_inventory, input_totals
from lotwise.sources.listings_csv import BAD_ROW, read_flagged_csv, read_listings_csv, split_bad_rows
from lotwise.sources.sinks import write_table
from tests.compare import first_difference, spark_table, sql_table
from workload import all_oracles, all_queries
from workload.tables import TABLES

TRICKY = 'id,text,n\n1,"a ""q"" b",x\n2,"two\nlines, and\n\n""more""",y\n3,short\n4,a,b,c\n5,,\n'


def test_quotes_breaks_and_bad_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(TRICKY)
    good, bad = split_bad_rows(read_flagged_csv(spark, str(path)))
    assert sorted(map(tuple, good.collect())) == [
        ("1", 'a "q" b', "x"),
        ("2", 'two\nlines, and\n\n"more"', "y"),
        ("5", None, None),
    ]
    assert sorted(r[BAD_ROW] for r in bad.collect()) == ["3,short", "4,a,b,c"]


def test_bad_rows_are_found_when_columns_are_pruned(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(TRICKY)
    assert [r.id for r in read_listings_csv(spark, str(path), ["id"]).orderBy("id").collect()] == ["1", "2", "5"]


@pytest.mark.parametrize("multiline", [True, False])
def test_rows_can_be_counted(spark, tmp_path, multiline):
    path = tmp_path / "t.csv"
    path.write_text("id,text,n\n1,x,y\n2,short\n3,a,b\n")
    good, bad = split_bad_rows(read_flagged_csv(spark, str(path), multiline))
    assert (good.count(), bad.count()) == (2, 1)
    assert read_listings_csv(spark, str(path), multiline=multiline).count() == 2


def test_a_quote_inside_a_field_is_text(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,text\n1,24" wheels\n2,5" rim\n3,plain\n4,"quoted ""x"""\n')
    rows = read_listings_csv(spark, str(path)).orderBy("id").collect()
    assert [r.text for r in rows] == ['24" wheels', '5" rim', "plain", 'quoted "x"']


def test_other_header_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,text\n1,x\n")
    (tmp_path / "b.csv").write_text("text,id\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_flagged_csv(spark, str(tmp_path)).collect()


def test_table_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(" a ", 'x"y'), ("b\nc", "d,e")], "s string, t string")
    write_table(df, str(tmp_path / "t"), "csv")
    back = read_listings_csv(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_require_columns(spark):
    df = spark.range(1).withColumn("x", F.lit(1))
    assert require_columns(df, ["x", "id", "x"]) == ["x", "id"]
    assert require_columns(df, ["x", "y"], on_missing="ignore") == ["x"]
    with pytest.raises(ValueError, match="y"):
        require_columns(df, ["x", "y"])


def test_cleaned_table_positions():
    assert len(CLEANED_COLUMNS) == 112
    places = {name: CLEANED_COLUMNS.index(name) for name in
              ("city", "daysonmarket", "description", "make_name", "model_name", "price", "year",
               "description_cleaned", "unified_color")}
    assert list(places.values()) == [3, 5, 7, 34, 37, 40, 56, 69, 111]


def test_inventory(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    df.repartition(3).write.parquet(str(tmp_path / "o"))
    df.limit(0).coalesce(1).write.mode("append").parquet(str(tmp_path / "o"))
    rows = input_inventory(spark, str(tmp_path / "o")).collect()
    sizes = {f.name: f.stat().st_size for f in (tmp_path / "o").glob("part-*")}
    assert sum(r.n_rows for r in rows) == df.count()
    assert {r.file_name: round(r.size_mb * 1024 * 1024) for r in rows} == sizes


def test_inventory_of_tables_in_many_files(spark, sf_dir, tmp_path):
    # One table as a file, one as a folder of files of which one is empty.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    orders.repartition(3).write.parquet(str(tmp_path / "orders.parquet"))
    orders.limit(0).coalesce(1).write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    part = f"{sf_dir}/part.parquet"
    got = {r.input: r for r in input_totals(spark, [str(tmp_path / "orders.parquet"), part]).collect()}
    folder = got[str(tmp_path / "orders.parquet")]
    sizes = [f.stat().st_size for f in (tmp_path / "orders.parquet").glob("part-*")]
    assert (folder.n_files, folder.n_rows, round(folder.size_mb * 1024 * 1024)) == (4, orders.count(), sum(sizes))
    assert (got[part].n_files, got[part].n_rows) == (1, spark.read.parquet(part).count())


def test_inventory_query_has_a_row_per_table(spark, duck, sf_dir, tmp_path):
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(2).write.parquet(str(tmp_path / f"{name}.parquet"))
    got = spark_table(all_queries()["input_inventory"](spark, str(tmp_path)))
    want = sql_table(duck, all_oracles()["input_inventory"])
    assert got == want, first_difference(got, want)

"""A small project on the star schema, from raw files to tested tables."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright import Storage, TableRef, tables
from tablewright.operators import checks
from tablewright.operators.constraints import contract
from tablewright.sources.files import parquet_table
from tablewright.sources.seeds import seed

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def grades(tmp_path_factory):
    """A hand-kept list: what a balance is called."""
    file = tmp_path_factory.mktemp("seeds") / "grades.csv"
    file.write_text("grade,from_balance\nred,-1000\namber,0\ngreen,5000\n")
    return str(file)


def build(spark, ns, grades):
    listed = seed(spark, grades, TableRef("grades", ns))
    suppliers = tables.materialize_view(
        spark, f"SELECT s_suppkey AS supplier, s_nationkey AS nation, s_acctbal AS balance FROM parquet.`{FOLDER}/supplier.parquet`",
        TableRef("stg_suppliers", ns))
    lines = parquet_table(spark, FOLDER, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_returnflag").alias("flag"), F.round(F.col("l_quantity")).cast("bigint").alias("pieces"))

    def supplier_model():
        graded = suppliers.join(F.broadcast(listed), F.col("balance") >= F.col("from_balance"), "left").groupBy("supplier", "nation").agg(
            F.max_by("grade", "from_balance").alias("grade"))
        moved = lines.groupBy("supplier").agg(
            F.sum("pieces").alias("pieces"), F.sum(F.when(F.col("flag") == "R", F.col("pieces")).otherwise(0)).alias("returned"))
        return contract(graded.join(moved, "supplier", "left"),
                        "supplier bigint, nation int, grade string, pieces bigint, returned bigint")

    return listed, suppliers, tables.materialize_table(supplier_model, TableRef("suppliers", ns), Storage(partition_by="grade"))


def test_project(spark, ns, grades):
    raw = parquet_table(spark, FOLDER, "supplier").collect()
    listed, suppliers, built = build(spark, ns, grades)
    assert dict(listed.dtypes)["from_balance"] in ("int", "bigint") and suppliers.count() == len(raw)
    pieces, returned = defaultdict(int), defaultdict(int)
    for line in parquet_table(spark, FOLDER, "lineitem").collect():
        pieces[line["l_suppkey"]] += round(line["l_quantity"])
        returned[line["l_suppkey"]] += round(line["l_quantity"]) * (line["l_returnflag"] == "R")
    grade = lambda b: "green" if b >= 5000 else "amber" if b >= 0 else "red"
    expected = {r["s_suppkey"]: (grade(r["s_acctbal"]), pieces.get(r["s_suppkey"]), returned.get(r["s_suppkey"])) for r in raw}
    assert {r["supplier"]: (r["grade"], r["pieces"], r["returned"]) for r in built.collect()} == expected

    tests = [checks.unique(built, "supplier"), checks.not_null(built, "grade"),
             checks.accepted_values(built, "grade", ["red", "amber", "green"]),
             checks.relationships(parquet_table(spark, FOLDER, "lineitem"), "l_suppkey", built, "supplier")]
    assert [tuple(checks.evaluate(t).first()) for t in tests] == [(0, False, False)] * len(tests)
    # Built again, nothing changes.
    again = build(spark, ns, grades)[2]
    assert tuple(checks.relations_equal(again, built).first()) == (0, 0)

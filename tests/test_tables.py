import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators import profile
from tablewright.operators.merge import merge_into
from tablewright.operators.schema_change import (
    SchemaChanged, apply_schema_change, change_columns, evolve, widen_column, widens)
from tablewright.operators import incremental as inc
from tablewright.sources.files import find_table, source
from tablewright.sources.seeds import read_seed, seed
from tablewright.workspace import shared_root


@pytest.fixture
def data(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id bigint, name string")


def test_names():
    assert TableRef.parse("t") == TableRef("t")
    assert TableRef.parse("c.n.t").sql == "`c`.`n`.`t`"
    for bad in ("", "a..b", "w.c.n.t"):
        with pytest.raises(ValueError):
            TableRef.parse(bad)


def test_storage_clauses(spark, ns, data, tmp_path):
    ref = TableRef("stored", ns)
    storage = Storage(partition_by=["name"], clustered_by="id", buckets=2, properties={"layer": "it's raw"},
                      comment="all 'of' it", location_root=str(tmp_path / "root"), options={"compression": "gzip"})
    tables.write_table(data, ref, storage)
    kept = tables.storage_of(spark, ref)
    assert (kept.partition_by, kept.clustered_by, kept.buckets, kept.fmt) == (["name"], ["id"], 2, "parquet")
    assert kept.properties["layer"] == "it's raw" and kept.comment == "all 'of' it"
    assert str(tmp_path / "root" / "stored") in tables.location(spark, ref)
    assert any(".gz.parquet" in f for _, _, fs in os.walk(tmp_path / "root") for f in fs)
    # Buckets count only together with their number.
    tables.write_table(data, ref, Storage(clustered_by="id"))
    assert tables.storage_of(spark, ref).buckets is None
    with pytest.raises(ValueError, match="unknown file format"):
        tables.write_table(data, ref, Storage(fmt="xml"))
    with pytest.raises(ValueError, match="no such column day"):
        tables.write_table(data, ref, Storage(partition_by="day"))


def test_csv_table(spark, ns, data):
    assert rows(tables.write_table(data, TableRef("text", ns), Storage(fmt="csv"))) == rows(data)


def test_rewrite_reads_its_own_table_and_keeps_the_layout(spark, ns, data):
    for layout in (Storage(properties={"k": "v"}, comment="c", options={"compression": "gzip"}),
                   Storage(partition_by="name"), Storage(clustered_by="id", buckets=2)):
        ref = TableRef("own", ns)
        own = tables.write_table(data, ref, layout)
        assert dict(tables.storage_of(spark, ref).options) == dict(layout.options)
        profile.persist_docs(spark, ref, columns={"id": "the key"})
        before = tables.storage_of(spark, ref)
        tables.rewrite(own.withColumn("id", F.col("id") + 10), ref)
        assert rows(spark.table(ref.sql), "id") == [(11,), (12,), (13,)]
        assert tables.storage_of(spark, ref) == before
        assert {c.name: c.description for c in spark.catalog.listColumns(ref.sql)} == {"id": "the key", "name": None}


def test_a_failed_build_leaves_the_table(spark, ns, data):
    ref = TableRef("safe", ns)
    tables.write_table(data, ref)
    broken = spark.table(ref.sql).withColumn("id", F.raise_error(F.lit("broken model")).cast("bigint"))
    with pytest.raises(Exception, match="broken model"):
        tables.materialize_table(broken, ref)
    assert rows(spark.table(ref.sql)) == rows(data)


def test_types_are_swapped(spark, ns, data):
    ref = TableRef("model", ns)
    tables.write_table(data, TableRef("base", ns))
    for _ in range(2):
        tables.materialize_view(spark, f"SELECT id FROM {TableRef('base', ns).sql}", ref,
                                comment="just ids", column_comments={"ID": "the 'key'"})
        assert tables.table_kind(spark, ref) == "view"
        assert spark.catalog.listColumns(ref.sql)[0].description == "the 'key'"
        tables.materialize_table(lambda: data, ref)
        assert tables.table_kind(spark, ref) == "table"
    tables.drop(spark, ref)
    tables.drop(spark, ref)
    assert tables.table_kind(spark, ref) is None


@pytest.mark.parametrize("layout", [None, "name"])
def test_clone(spark, ns, data, layout):
    src, dst = TableRef("src", ns), TableRef("dst", ns)
    tables.write_table(data, src, Storage(partition_by=layout))
    assert rows(tables.clone(spark, src, dst), "id", "name") == rows(data)
    assert tables.location(spark, src) == tables.location(spark, dst)
    # Changing either one does not show in the other, in place or not.
    tables.append_rows(data, dst)
    assert (spark.table(src.sql).count(), spark.table(dst.sql).count()) == (3, 6)
    inc.insert_overwrite(src, data.filter("id = 1").withColumn("id", F.lit(9).cast("bigint")))
    assert spark.table(dst.sql).filter("id = 9").isEmpty()
    # An existing target is left alone unless asked.
    assert tables.clone(spark, src, dst).count() == 6
    assert tables.clone(spark, src, dst, full_refresh=True).filter("id = 9").count() == 1
    tables.materialize_view(spark, "SELECT 1 AS x", TableRef("v", ns))
    tables.clone(spark, f"{ns}.v", f"{ns}.v2")
    assert tables.table_kind(spark, TableRef("v2", ns)) == "view"


def test_update_where(spark, ns, data):
    ref = TableRef("upd", ns)
    tables.write_table(data, ref)
    changed = tables.update_where(spark, ref, F.col("name") == "a", {"ID": F.col("id") * 100})
    assert rows(changed) == [(100, "a"), (2, "b"), (300, "a")]
    for hit, expected in (("a", [(2, "b"), (7, "a"), (7, "a")]), ("z", [(2, "b"), (7, "a"), (7, "a")])):
        part = ref.sibling("upd_part")
        if hit == "a":
            tables.write_table(data, part, Storage(partition_by="name"))
        got = tables.update_where(spark, part, F.col("name") == hit, {"id": F.lit(7)})
        assert rows(got, "id", "name") == expected
    moved = tables.update_where(spark, part, F.col("id") == 7, {"name": F.lit("b")})
    assert rows(moved, "id", "name") == [(2, "b"), (7, "b"), (7, "b")]


def test_many_partitions_of_two_columns(spark, ns):
    """400 of 420 partitions are changed, the others keep their files."""
    ref = TableRef("grid", ns)
    table = spark.range(400).selectExpr("id", "'old' as v", "id as a", "if(id = 7, null, id) as b")
    table = table.union(spark.range(20).selectExpr("id + 1000", "'old'", "id", "id + 1")).coalesce(1)
    tables.write_table(table, ref, Storage(partition_by=["a", "b"]))
    files = lambda test: {r[0] for r in spark.table(ref.sql).filter(test).select("_metadata.file_path").collect()}
    before = files("id >= 1000")
    got = merge_into(ref, table.filter("id < 400").withColumn("v", F.lit("new")), "id")
    assert got.count() == 420 and got.filter("(v = 'new') = (id < 400)").count() == 420
    assert files("id >= 1000") == before
    got = tables.update_where(spark, ref, F.col("id") < 400, {"v": F.lit("newer")})
    assert got.count() == 420 and got.filter("(v = 'newer') = (id < 400)").count() == 420
    assert files("id >= 1000") == before


def test_partitions_are_named_however_many(spark):
    df = spark.range(6000).selectExpr("nullif(id, 0) as a", "id % 2 as b")
    assert tables.in_partitions(df, ["a"], [(None,), *[(i,) for i in range(1, 3000)]]).count() == 3000
    assert tables.in_partitions(df, ["a", "b"], [(None, 0), *[(i, 0) for i in range(1, 3000)]]).count() == 1500
    assert tables.in_partitions(df, ["a", "b"], []).count() == tables.in_partitions(df, ["a"], []).count() == 0


def test_show(data):
    assert [r.id for r in tables.show(data, 2).collect()] == [1, 2]
    assert [r.id for r in tables.show(data.limit(0), 5).collect()] == []
    with pytest.raises(ValueError):
        tables.show(data, -1)


def test_shared_folder_is_the_configured_one(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")


# ---------------------------------------------------------------- schema changes

def test_evolve(spark, data):
    batch = data.withColumn("extra", F.lit(1)).drop("name")
    assert evolve(data, batch)[0].columns == ["id", "name"]
    with pytest.raises(SchemaChanged, match="extra"):
        evolve(data, batch, "fail")
    target, filled = evolve(data, batch, "append_new_columns")
    assert target.columns == ["id", "name", "extra"] and "name" in filled.columns
    with pytest.raises(SchemaChanged, match="dropped"):
        evolve(data, batch, "sync_all_columns")
    assert evolve(data, batch, "sync_all_columns", allow_drop=True)[0].columns == ["id", "extra"]
    assert evolve(data, data, "fail")[0] is data
    with pytest.raises(ValueError, match="on_schema_change"):
        evolve(data, batch, "whatever")


@pytest.mark.parametrize("layout", [None, "name"])
def test_schema_change_of_a_stored_table(spark, ns, data, layout):
    ref = TableRef("evolving", ns)
    build = lambda df, **k: inc.build_incremental(
        spark, ref, lambda _: df, storage=Storage(partition_by=layout), **k)
    build(data)
    build(data.withColumn("extra", F.lit(1)), on_schema_change="append_new_columns")
    assert rows(spark.table(ref.sql).filter("id = 1"), "id", "extra") == sorted([(1, None), (1, 1)], key=repr)
    with pytest.raises(SchemaChanged):
        build(data, on_schema_change="fail")
    build(data.withColumn("extra", F.lit(2.5)), on_schema_change="sync_all_columns")
    assert dict(spark.table(ref.sql).dtypes)["extra"] == "double"
    assert spark.table(ref.sql).count() == 9


def test_widen_column(spark, ns):
    ref = TableRef("narrow", ns)
    tables.write_table(spark.sql("select 7 as n, 'x' as s"), ref)
    assert widen_column(spark, ref, "N", "bigint").dtypes == [("n", "bigint"), ("s", "string")]
    with pytest.raises(Exception):
        widen_column(spark, ref, "s", "int")
    assert rows(spark.table(ref.sql)) == [(7, "x")]


# ---------------------------------------------------------------- seeds

def test_seed_types(spark, ns, tmp_path):
    path = str(tmp_path / "seed.csv")
    with open(path, "w") as f:
        f.write("id,big,price,name,day,at,flag,zip\n"
                "1,9007199254740993,1.5,\"a, \"\"b\"\"\",2020-01-02,2020-01-02 03:04:05,true,00501\n"
                "2,,2,,,,false,10001\n")
    ref = TableRef("seeded", ns)
    tables.materialize_view(spark, "SELECT 1 AS id", ref)
    loaded = seed(spark, path, ref, {"ZIP": "string", "price": "decimal(20,2)"})
    assert dict(loaded.dtypes) == {
        "id": "bigint", "big": "bigint", "price": "decimal(20,2)", "name": "string", "day": "date",
        "at": "timestamp", "flag": "boolean", "zip": "string"}
    first, second = loaded.orderBy("id").collect()
    assert (first.big, first.name, first.zip) == (9007199254740993, 'a, "b"', "00501")
    assert (second.big, second.name, second.day) == (None, None, None)  # a missing value stays NULL
    with pytest.raises(ValueError, match="no such column nope"):
        read_seed(spark, path, {"nope": "string"})
    assert seed(spark, path, ref, full_refresh=False).count() == 2
    assert rows(spark.table(ref.sql), "zip") == [("00501",), ("10001",)]


def test_seed_with_line_breaks(spark, tmp_path):
    path = str(tmp_path / "lines.csv")
    with open(path, "w") as f:
        f.write('id;note\n1;"two\nlines"\n')
    assert rows(read_seed(spark, path, delimiter=";", multi_line=True)) == [(1, "two\nlines")]


def test_empty_seed(spark, ns, tmp_path):
    path = str(tmp_path / "empty.csv")
    with open(path, "w") as f:
        f.write("a,b\n")
    loaded = seed(spark, path, TableRef("empty", ns), delimiter=",")
    assert loaded.columns == ["a", "b"] and loaded.count() == 0


# ---------------------------------------------------------------- catalog

def test_catalog_operators(spark, ns, data):
    ref = TableRef("people", ns)
    tables.write_table(data, ref, Storage(partition_by="name"))
    tables.materialize_view(spark, f"SELECT id FROM {ref.sql}", TableRef("ids", ns))
    assert profile.columns_in(spark, ref) == [("id", "bigint"), ("name", "string")]
    assert profile.columns_in(spark, f"{ns}.missing") == []
    assert profile.list_tables(spark, ns) == [
        {"name": "ids", "type": "view", "format": None}, {"name": "people", "type": "table", "format": "parquet"}]
    assert profile.list_tables(spark, "no_such_namespace") == []
    assert source(spark, ns, "people").count() == 3
    assert profile.table_stats(spark, ref)["rows"] == 3
    assert find_table(spark, "people").name == "people"
    assert find_table(spark, "no_such_table") is None
    profile.persist_docs(spark, ref, "it's -- /* a */ $1 \"table\"", {"ID": "the 'key' \\ $$"})
    described = profile.catalog(spark, ns)
    assert rows(described, "table_name", "column_name", "comment", "row_count", "non_null") == sorted([
        ("ids", "id", None, 3, 3), ("people", "id", "the 'key' \\ $$", 3, 3), ("people", "name", None, 3, 3)], key=repr)
    assert tables.describe(spark, ref)[1]["Comment"] == "it's -- /* a */ $1 \"table\""
    with pytest.raises(ValueError, match="no such column column_that_does_not_exist"):
        profile.persist_docs(spark, ref, columns={"column_that_does_not_exist": "x"})
    profile.rename(spark, ref, TableRef("persons", ns))
    assert rows(spark.table(TableRef("persons", ns).sql), "id") == [(1,), (2,), (3,)]
    with pytest.raises(ValueError, match="does not exist"):
        profile.rename(spark, ref, TableRef("x", ns))
    assert profile.catalog(spark, "no_such_namespace").isEmpty()


def test_namespaces(spark, tmp_path):
    for _ in range(2):
        profile.ensure_namespace(spark, "made_here", str(tmp_path / "made"))
    tables.write_table(spark.range(3).toDF("id"), TableRef("t", "made_here"))
    profile.drop_namespace(spark, "made_here")
    assert not spark.catalog.databaseExists("made_here")


def test_statistics_text():
    assert profile.parse_statistics("4096 bytes, 17 rows") == {"bytes": 4096, "rows": 17}
    assert profile.parse_statistics("73 bytes") == {"bytes": 73}
    assert profile.parse_statistics("") == {}


def _places(spark, ref, test="true"):
    return {r[0] for r in spark.table(ref.sql).filter(test).select("_metadata.file_path").collect()}


def test_clones_copy_by_partition(spark, ns):
    """A change of one partition leaves the files of the others shared, whatever the kind of change."""
    src, dst, third = TableRef("src", ns), TableRef("dst", ns), TableRef("third", ns)
    data = spark.createDataFrame(
        [(1, 1, "a/b"), (2, 1, "ü%2F"), (3, 2, "a/b"), (4, None, "a/b"), (5, 2, None)], "id long, p int, r string")
    tables.write_table(data, src, Storage(partition_by=["p", "r"]))
    tables.clone(spark, src, dst)
    tables.clone(spark, dst, third)
    kept = _places(spark, src)
    assert _places(spark, dst) == _places(spark, third) == kept
    # Appending: one partition is copied, one is new.
    more = spark.createDataFrame([(10, 1, "a/b"), (11, 7, "new")], data.schema)
    tables.append_rows(more, dst)
    assert rows(spark.table(dst.sql)) == rows(data.union(more))
    assert _places(spark, dst, "id not in (1, 10, 11)") == _places(spark, src, "id <> 1")
    # Replacing and emptying, NULL partitions included.
    tables.overwrite_partitions(spark.createDataFrame([(40, None, "a/b")], data.schema), dst)
    tables.empty_partitions(spark, dst, ["p", "r"], [(2, None), (1, "ü%2F")])
    assert rows(spark.table(dst.sql), "id") == [(1,), (10,), (11,), (3,), (40,)]
    assert rows(spark.table(src.sql)) == rows(spark.table(third.sql)) == rows(data)
    assert _places(spark, src) == kept
    # A clone of a table with moved partitions, and of one that dropped some.
    fourth = TableRef("fourth", ns)
    assert rows(tables.clone(spark, dst, fourth)) == rows(spark.table(dst.sql))
    assert _places(spark, fourth) == _places(spark, dst)


def test_the_last_sharer_owns_the_files(spark, ns, data):
    first, second, third = (TableRef(n, ns) for n in ("first", "second", "third"))
    tables.write_table(data, first, Storage(partition_by="name"))
    tables.clone(spark, first, second)
    tables.clone(spark, second, third)
    tables.drop(spark, second)
    assert tables.sharers(spark, first) == [third]  # not alone: the clone of the clone reads its files
    profile.rename(spark, third, TableRef("moved", ns))
    assert [r.name for r in tables.sharers(spark, first)] == ["moved"]
    tables.rewrite(spark.table(f"{ns}.moved"), TableRef("moved", ns))
    assert tables.sharers(spark, first) == [] and tables.SHARED_PROPERTY not in tables.properties(spark, first)
    before = _places(spark, first)
    tables.append_rows(data, first)
    assert before < _places(spark, first) and spark.table(first.sql).count() == 2 * data.count()


@pytest.mark.parametrize("layout", [None, "p"])
def test_columns_change_in_the_catalog(spark, ns, layout):
    """Files stay when columns go, come or get wider; an old value never comes back."""
    ref = TableRef("wide", ns)
    data = spark.range(6).selectExpr(
        "id", "cast(id as int) as n", "cast(id as float) / 4 as f", "cast(id as decimal(6,2)) as d", "id * 10 as x",
        "id % 2 as p")
    tables.write_table(data, ref, Storage(partition_by=layout, comment="six rows"))
    profile.persist_docs(spark, ref, columns={"n": "a number"})
    before = _places(spark, ref)
    for column, kind in (("n", "bigint"), ("f", "double"), ("d", "decimal(12,4)")):
        widen_column(spark, ref, column, kind)
    apply_schema_change(ref, data.drop("x").select("*", F.lit("new").alias("y")).withColumns(
        {c: F.col(c).cast(t) for c, t in (("n", "bigint"), ("f", "double"), ("d", "decimal(12,4)"))}),
        "sync_all_columns", allow_drop=True)
    assert _places(spark, ref) == before
    now = spark.table(ref.sql)
    assert dict(now.dtypes) == {"id": "bigint", "n": "bigint", "f": "double", "d": "decimal(12,4)", "y": "string", "p": "bigint"}
    assert rows(now, "id", "n", "f", "y") == [(i, i, i / 4, None) for i in range(6)]
    assert now.schema["n"].metadata == {"comment": "a number"} and tables.storage_of(spark, ref).comment == "six rows"
    # New rows have values the narrow types could not hold; filters find rows of both kinds of files.
    tables.append_rows(spark.createDataFrame([(9, 1 << 40, 1e300, "z", 1)], "id long, n long, f double, y string, p long")
                       .withColumn("d", F.lit("12345678.1234").cast("decimal(12,4)")), ref)
    now = spark.table(ref.sql)
    assert now.filter("n > 4").count() == 2 and now.filter(f"n = {1 << 40}").count() == 1 and now.filter("n < 3").count() == 3
    assert now.filter("f > 1").count() == 2 and now.filter("d >= 5").count() == 2 and now.filter("d = 4").count() == 1
    # A column of the dropped one's name starts empty, also below filters.
    batch = now.withColumn("x", F.lit(7).cast("bigint"))
    apply_schema_change(ref, batch, "append_new_columns")
    now = spark.table(ref.sql)
    assert now.filter("x is null").count() == 7 and now.filter("x is not null").isEmpty()
    assert tables.still_stored(spark, ref) == set()


def test_other_changes_of_columns_rewrite(spark, ns):
    ref, dst = TableRef("narrow", ns), TableRef("copy", ns)
    data = spark.range(4).selectExpr("id", "cast(id as int) as k", "cast(id as string) as s")
    tables.write_table(data, ref, Storage(clustered_by="k", buckets=2))
    tables.clone(spark, ref, dst)
    before = _places(spark, ref)
    change_columns(ref, data.drop("s"))  # only this table's entry changes
    assert spark.table(ref.sql).columns == ["id", "k"] and spark.table(dst.sql).columns == ["id", "k", "s"]
    assert _places(spark, ref) == before and tables.sharers(spark, ref) == [dst] and tables.storage_of(spark, ref).buckets == 2
    widen_column(spark, ref, "k", "bigint")  # rows lie in buckets by the hash of an int
    assert not _places(spark, ref) & before and rows(spark.table(ref.sql)) == [(i, i) for i in range(4)]
    assert tables.sharers(spark, dst) == [] and rows(spark.table(dst.sql)) == rows(data)
    assert widens(data.schema["k"].dataType, data.schema["id"].dataType)
    assert not widens(data.schema["id"].dataType, data.schema["k"].dataType)

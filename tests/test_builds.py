"""Contracts, constraints, data tests, comments, hooks and the source check as part of every build."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tablewright import Storage, TableRef, tables
from tablewright.operators import builds, checks
from tablewright.operators.builds import Model, TestsFailed
from tablewright.operators.constraints import Check
from tablewright.operators.merge import merge_into
from tablewright.operators.snapshot import SnapshotConfig

SHAPE = "id bigint, name string"
DATA = [(1, "a"), (2, "b"), (3, None)]


def backwards(spark, data=DATA):
    return spark.createDataFrame(data, SHAPE).select("name", "id")


def comments(spark, ref):
    return {c.name: c.description for c in spark.catalog.listColumns(ref.sql) if c.description}


def as_table(spark, model, data):
    return builds.build_table(spark, model, lambda: backwards(spark, data))


def as_view(spark, model, data):
    tables.write_table(backwards(spark, data), model.table.sibling("base"))
    return builds.build_view(spark, model, f"SELECT * FROM {model.table.sibling('base').sql}")


def as_increment(spark, model, data):
    return builds.build_increment(spark, model, lambda again: backwards(spark, data), strategy="merge", unique_key="id")


def as_history(spark, model, data):
    config = SnapshotConfig("id", "check", check_cols="all")
    return builds.build_snapshot(spark, model, lambda: backwards(spark, data), config, "2024-01-01 00:00:00").select("id", "name")


def as_maintained(spark, model, data):
    return builds.build_maintained(spark, model, lambda: backwards(spark, data), on_demand=True)


def as_seed(spark, model, data):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/{model.table.namespace}_{len(data)}.csv"
    backwards(spark, data).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return builds.build_seed(spark, model, path, column_types={"id": "bigint"})


KINDS = [as_table, as_view, as_increment, as_history, as_maintained, as_seed]


@pytest.mark.parametrize("build", KINDS)
def test_every_kind_of_build_has_all_of_it(spark, ns, build):
    seen, ref = [], TableRef("model", ns)
    model = Model(ref, SHAPE, [Check("name IS NOT NULL", "named", "DROP"), Check("id < 9", "small")],
                  {"unique": lambda df: checks.unique(df, "id")}, "what it's about", {"name": "its name"},
                  pre=[lambda: seen.append(("pre", tables.table_kind(spark, ref)))],
                  post=[lambda: seen.append(("post", tables.table_kind(spark, ref)))])
    got = build(spark, model, DATA)
    assert got.columns == ["id", "name"] and rows(got) == [(1, "a"), (2, "b")]
    assert seen == [("pre", None), ("post", "view" if build is as_view else "table")]
    assert comments(spark, ref) == {"name": "its name"}
    assert tables.describe(spark, ref)[1]["Comment"] == "what it's about"
    # A broken constraint or contract ends the build before the rows are replaced, and post hooks do not run.
    if build is as_view:
        with pytest.raises(Exception, match="constraint small violated"):
            build(spark, model, [(9, "z")]).collect()
    else:
        with pytest.raises(Exception, match="constraint small violated"):
            build(spark, model, [(9, "z")])
        assert rows(spark.table(ref.sql).select("id", "name")) == [(1, "a"), (2, "b")]
        assert [s[0] for s in seen] == ["pre", "post", "pre"]
    with pytest.raises(ValueError, match="contract broken"):
        build(spark, Model(ref, "id bigint, name string, more int"), DATA)


def test_failing_tests_name_all_failures(spark, ns):
    model = Model(TableRef("model", ns), tests={
        "unique": lambda df: checks.unique(df, "id"), "named": lambda df: checks.not_null(df, "name"),
        "known": lambda df: checks.accepted_values(df, "id", [1, 2, 3])})
    with pytest.raises(TestsFailed) as failed:
        as_table(spark, model, [*DATA, (1, "again")])
    assert failed.value.failures == {"unique": 1, "named": 1}
    assert as_table(spark, model, DATA[:2]).count() == 2


def test_sources_are_checked(spark, ns):
    tables.write_table(backwards(spark), TableRef("t", ns))
    tables.materialize_view(spark, "SELECT 1 AS id", TableRef("v", ns))
    seen = []
    model = Model(TableRef("mv", ns), sources=[f"{ns}.t", f"{ns}.v"], pre=[lambda: seen.append(1)])
    with pytest.raises(ValueError, match="is a view"):
        as_maintained(spark, model, DATA)
    assert not seen and tables.table_kind(spark, model.table) is None
    assert as_table(spark, model, DATA).count() == 3  # a plain table may read a view
    with pytest.warns(UserWarning, match="nowhere"):
        as_maintained(spark, Model(TableRef("mv", ns), sources=[f"{ns}.nowhere"]), DATA)


def test_a_constraint_of_a_view_judges_only_what_the_view_reads(spark, ns):
    tables.write_table(spark.createDataFrame([(1, -1), (2, 5)], "id int, n int"), TableRef("base", ns))
    model = Model(TableRef("v", ns), checks=[Check("n > 0", "kept", "DROP"), Check("n > 0", "positive")])
    assert rows(builds.build_view(spark, model, f"SELECT * FROM {ns}.base")) == [(2, 5)]
    strict = Model(TableRef("w", ns), checks=[Check("n > 0", "positive")])
    with pytest.raises(Exception, match="constraint positive violated"):
        builds.build_view(spark, strict, f"SELECT * FROM {ns}.base").count()


def test_a_table_keeps_its_root_and_only_what_is_said_of_it(spark, ns, tmp_path):
    ref, root = TableRef("rooted", ns), str(tmp_path / "root")
    data = spark.createDataFrame(DATA, SHAPE)
    tables.write_table(data, ref, Storage(location_root=root, properties={"k": "v"}, comment="first"))
    for _ in range(2):
        merge_into(ref, spark.createDataFrame([(1, "z")], SHAPE), "id")
        assert root in tables.location(spark, ref)
        kept = tables.storage_of(spark, ref)
        assert (kept.location_root, kept.comment, dict(kept.properties)) == (root, "first", {"k": "v"})
    tables.write_table(data, ref, Storage(properties={"other": "w"}))
    kept = tables.storage_of(spark, ref)
    assert root not in tables.location(spark, ref) and kept.location_root is None
    assert dict(kept.properties) == {"other": "w"} and not kept.comment
    assert rows(spark.table(ref.sql).select(F.max("id"))) == [(3,)]

import pytest
from conftest import plan_of, rows

from tillwork.operators import governance as g
from tillwork.sources.tables import write_table

DATA = [("C1", "a@x.org", "LATAM"), ("C2", None, "APAC"), ("C3", "c@x.org", "EMEA"), ("C4", "d@x.org", None)]


@pytest.fixture
def customers(spark):
    return spark.createDataFrame(DATA, "customer_id string, email string, region string")


def test_mask(customers):
    assert rows(g.mask_columns(customers, ["email"], set()), "email") == [(g.MASK_TEXT,)] * 4
    assert rows(g.mask_columns(customers, ["email"], {"admin_group"})) == sorted(DATA, key=repr)
    with pytest.raises(ValueError, match="string"):
        g.mask_columns(customers.selectExpr("1 AS n"), ["n"], set())


@pytest.mark.parametrize("groups, keys", [
    ({"latam_managers"}, ["C1"]), ({"apac_managers"}, ["C2"]), ({"latam_managers", "apac_managers"}, ["C1", "C2"]),
    ({"admin_group"}, ["C1", "C2", "C3", "C4"]), ({"others"}, []), (set(), [])])
def test_row_filter(spark, customers, groups, keys):
    assert [r[0] for r in rows(g.filter_rows(customers, groups), "customer_id")] == keys
    g.register_sql_functions(spark)
    listed = ", ".join(f"'{n}'" for n in groups)
    sql = customers.filter(f"can_read_region(region, cast(array({listed}) AS array<string>))")
    assert [r[0] for r in rows(sql, "customer_id")] == keys


def test_sql_mask(spark, customers):
    g.register_sql_functions(spark)
    shown = customers.selectExpr("mask_pii(email, array('x')) a", "mask_pii(email, array('admin_group')) b", "email")
    assert shown.filter(f"a <> '{g.MASK_TEXT}' OR NOT b <=> email").isEmpty()


def test_tags_survive_parquet_and_drive_the_mask(spark, customers, folder):
    g.tag_sensitive(customers, ["email"]).write.parquet(f"{folder}/c")
    stored = spark.read.parquet(f"{folder}/c")
    assert g.sensitive_columns(stored) == ["email"]
    assert rows(g.governed_view(stored, {"latam_managers"})) == [("C1", g.MASK_TEXT, "LATAM")]
    assert g.sensitive_columns(g.governed_view(stored, set())) == ["email"]
    assert rows(g.governed_view(stored, {"admin_group"})) == sorted(DATA, key=repr)


def test_filter_reaches_the_scan(spark, customers, folder):
    g.tag_sensitive(customers, ["email"]).write.parquet(f"{folder}/c")
    plan = plan_of(g.governed_view(spark.read.parquet(f"{folder}/c"), {"latam_managers"}))
    assert "PushedFilters: [IsNotNull(region), EqualTo(region,LATAM)]" in plan
    assert "ReadSchema: struct<customer_id:string,region:string>" in plan


def test_governed_view_of_a_table(spark, layers):
    table, view = layers("gold", "t"), layers("gold", "seen")
    write_table(spark.createDataFrame([("LATAM", "a"), ("EMEA", "b"), (None, "c")], "region string, email string"), table, "overwrite")
    for groups, expected in (({"latam_managers"}, [("LATAM", g.MASK_TEXT)]), (set(), []),
                             ({g.ADMIN_GROUP}, [("EMEA", "b"), ("LATAM", "a"), (None, "c")])):
        g.create_governed_view(spark, view, table, groups, ["email"])
        assert rows(spark.table(view)) == expected
    with pytest.raises(ValueError, match="no columns"):
        g.create_governed_view(spark, view, table, set(), ["phone"])


def test_one_view_shows_each_reader_their_rows(spark, layers):
    """The reader is looked up when the view is read, also after memberships changed."""
    table, members, reader = layers("gold", "t"), layers("gold", "members"), layers("gold", "reader")
    data = [("LATAM", "a", 1), ("AP'AC\\", "b", 2), ("EMEA", "c", 3), (None, "d", 4)]
    write_table(spark.createDataFrame(data, "region string, email string, n int"), table, "merge", "email")
    groups = "user_name string, group_name string"
    write_table(spark.createDataFrame([("eva", "latam_managers"), ("kim", "apac_managers"), ("sam", g.ADMIN_GROUP)], groups), members, "append")
    write_table(spark.createDataFrame([("eva",)], "name string"), reader, "overwrite")
    view = layers("gold", "seen")
    rules = {"latam_managers": "LATAM", "apac_managers": "AP'AC\\"}
    g.create_policy_view(spark, view, table, members, ["email"], rules=rules, reader=f"(SELECT max(name) FROM {reader})")

    def seen_by(name):
        write_table(spark.createDataFrame([(name,)], "name string"), reader, "overwrite")
        spark.catalog.refreshTable(reader)
        return rows(spark.table(view))

    assert seen_by("eva") == [("LATAM", g.MASK_TEXT, 1)]
    assert seen_by("kim") == [("AP'AC\\", g.MASK_TEXT, 2)]
    assert seen_by("sam") == sorted(data, key=repr)
    assert seen_by("nobody") == []
    write_table(spark.createDataFrame([("kim", "latam_managers")], groups), members, "append")
    spark.catalog.refreshTable(members)
    assert [r[2] for r in seen_by("kim")] == [2, 1]
    own = layers("gold", "own")
    g.create_policy_view(spark, own, table, members, ["email"])
    assert spark.table(own).isEmpty()
    me = spark.sql("SELECT current_user() AS me").first()["me"]
    write_table(spark.createDataFrame([(me, "latam_managers")], groups), members, "append")
    spark.catalog.refreshTable(members)
    assert rows(spark.table(own)) == [("LATAM", g.MASK_TEXT, 1)]
    with pytest.raises(ValueError, match="string columns"):
        g.create_policy_view(spark, own, table, members, ["n"])

"""The daily report kept from changes equals the one computed in full."""

from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows

from tillwork.plans import daily_view, marts
from tillwork.plans.daily_view import maintain_daily_sales
from tillwork.sources.tables import file_sizes, generations, read_table, write_table

SALES = ("transaction_id string, customer_id string, product_id string, quantity int, total_amount decimal(10,2),"
         " transaction_timestamp timestamp")
GROUPS = ("sales_date", "product_category", "customer_region", "daily_sale", "daily_units_sold", "average_margin_pct")


def sale(number, day=1, customer="C1", product="P1", quantity=1, amount="10.00"):
    return (f"T{number}", customer, product, quantity, amount and Decimal(amount), datetime(2026, 1, day, 12))


class Shop:
    def __init__(self, spark, folder, layers):
        self.spark, self.folder = spark, folder
        self.c, self.p, self.s, self.report = (layers("gold", n) for n in ("c", "p", "s", "fact_daily_sales"))

    def customers(self, **regions):
        df = self.spark.createDataFrame(list(regions.items()), "customer_id string, region string")
        write_table(df, self.c, "overwrite", "customer_id")

    def products(self, **values):
        df = self.spark.createDataFrame(
            [(k, c, m and Decimal(m)) for k, (c, m) in values.items()],
            "product_id string, category string, gross_margin_percentage decimal(5,2)")
        write_table(df, self.p, "overwrite", "product_id")

    def sales(self, *found, removed=None):
        keys = [f"T{i}" for i in removed] if removed else None
        write_table(
            self.spark.createDataFrame(list(found), SALES), self.s, "merge", "transaction_id",
            replaced_keys=self.spark.createDataFrame([(k,) for k in keys], "transaction_id string") if keys else None)

    def maintain(self):
        maintain_daily_sales(self.spark, self.c, self.p, self.s, self.report, f"{self.folder}/ck")

    def check(self):
        full = marts.daily_sales(*(read_table(self.spark, t) for t in (self.c, self.p, self.s)))
        assert rows(read_table(self.spark, self.report), *GROUPS) == rows(full, *GROUPS)


@pytest.fixture
def shop(spark, folder, layers):
    found = Shop(spark, folder, layers)
    found.customers(C1="LATAM", C2="APAC", C3=None)
    found.products(P1=("Lamps", "12.50"), P2=("Desks", None), P3=(None, "33.33"))
    found.sales(
        sale(1), sale(2, 1, "C2", "P2"), sale(3, 2, None, "P1"), sale(4, 2, "C9", "P9"), sale(5, 1, "C1", "P1", None, None),
        sale(6, 3, "C3", "P3", 7, "0.07"), *[sale(10 + i, 4, f"C{i % 3 + 1}", f"P{i % 3 + 1}", i, f"{i}.11") for i in range(9)])
    found.maintain()
    found.check()
    return found


def test_changes_of_every_kind(shop):
    shop.maintain()
    shop.check()
    # Corrected, moved to another day, removed and new sales; a group of its own goes.
    shop.sales(sale(1, 1, amount="99.99"), sale(2, 9, "C2", "P2"), sale(30, 9, "C1", "P3"), removed=[1, 2, 6, 30])
    shop.maintain()
    shop.check()
    # Customers move, come and go; products change category and margin; with new sales on top.
    shop.customers(C1="EMEA", C9="LATAM", C3="APAC")
    shop.products(P1=("Lights", "12.50"), P2=("Desks", "1.01"), P9=("Chairs", "5.00"))
    shop.sales(sale(40, 2, "C9", "P9"), sale(41, 2, "C1", "P3"))
    shop.maintain()
    shop.check()


def test_only_groups_that_changed_are_written(shop):
    before = rows(read_table(shop.spark, shop.report), *GROUPS, "_gold_updated_at")
    size = file_sizes(shop.spark, shop.report).count()
    shop.sales(sale(50, 2, "C9", "P9"))
    shop.maintain()
    shop.check()
    after = rows(read_table(shop.spark, shop.report), *GROUPS, "_gold_updated_at")
    assert len(set(after) - set(before)) == 1 and size
    count = len(generations(shop.spark, shop.report))
    shop.maintain()
    assert len(generations(shop.spark, shop.report)) == count


@pytest.mark.parametrize("dies_at", [1, 2])
def test_a_pass_that_dies_counts_every_change_once(shop, monkeypatch, dies_at):
    """The n-th write of the pass succeeds and then the process dies."""
    shop.customers(C1="EMEA", C2="APAC")
    shop.products(P1=("Lights", "1.50"), P2=("Desks", "2.00"))
    shop.sales(sale(1, 5), sale(60, 1, "C2"))
    calls, real = [], daily_view.write_table

    def dies(*args, **kwargs):
        real(*args, **kwargs)
        calls.append(args[1])
        if len(calls) == dies_at + 1:
            raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(daily_view, "write_table", dies)
        with pytest.raises(Exception, match="killed"):
            shop.maintain()
    # The dimensions change again before the retry.
    shop.customers(C1="APAC", C2="APAC", C9="EMEA")
    shop.maintain()
    shop.check()

"""The daily sales report kept up to date from changes.

Each group's sums and counts are a table. Changed sales come from the fact table's feed with
the rows before and after: a row before counts as minus one, a row after as plus one, in the
groups that the dimensions gave them when they were last counted. Then changed dimension rows
move what they concern: the sales of a customer who moved leave their groups by the old region
and enter others by the new one, and likewise a product's category and margin. A group whose
count reaches 0 goes. The report follows the feed of the sums, so a run writes the groups that
changed and no others.

What the dimensions were when last counted is a table of its own, ``inputs``; a pass first
notes what they shall be (``next``), then changes the sums, then ``inputs``, each write under a
name that a retry finds again. So a failure at any point leaves every change counted once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwork.operators.diff import CHANGE
from tillwork.plans.marts import stamped
from tillwork.sources.schemas import GOLD_TABLES
from tillwork.sources.tables import Stage, generations, known_batch, read_table, same_key, write_table
from tillwork.streaming.progress import current_rows, follow_table

GROUP = GOLD_TABLES["fact_daily_sales"].keys
SUMS = {
    "sales": "bigint", "amount": "decimal(38,2)", "amounts": "bigint", "units": "bigint", "unit_counts": "bigint",
    "margin": "decimal(38,2)", "margins": "bigint",
}
CUSTOMER, PRODUCT = "customer", "product"
INPUT_KEYS = ("kind", "id")


def counted_inputs(customers: DataFrame, products: DataFrame) -> DataFrame:
    """What the report takes from both dimensions, as one table keyed by kind and id."""
    none = F.lit(None).cast("string")
    return customers.select(
        F.lit(CUSTOMER).alias("kind"), F.col("customer_id").alias("id"), F.col("region").alias("region"),
        none.alias("category"), F.lit(None).cast("decimal(5,2)").alias("margin"),
    ).unionAll(
        products.select(
            F.lit(PRODUCT), "product_id", none, "category", F.col("gross_margin_percentage").cast("decimal(5,2)")
        )
    )


def _customers(inputs: DataFrame) -> DataFrame:
    return inputs.where(F.col("kind") == CUSTOMER).select(F.col("id").alias("customer_id"), F.col("region").alias("customer_region"))


def _products(inputs: DataFrame) -> DataFrame:
    return inputs.where(F.col("kind") == PRODUCT).select(
        F.col("id").alias("product_id"), F.col("category").alias("product_category"), F.col("margin").alias("margin_pct")
    )


def _lines(sales: DataFrame, sign: Column) -> DataFrame:
    """The columns of sale lines that count, with the sign they count by."""
    return sales.select(
        "customer_id", "product_id", F.col("total_amount").cast("decimal(38,2)").alias("total_amount"),
        F.col("quantity").cast("bigint").alias("quantity"), F.to_date("transaction_timestamp").alias("sales_date"),
        sign.cast("bigint").alias("sign"),
    )


def _signed_sums(lines: DataFrame) -> DataFrame:
    """Sums per group of lines that have a sign, a region, a category and a margin."""

    def total(value: str, kind: str) -> Column:
        return F.coalesce(F.sum(F.col(value) * F.col("sign")).cast(kind), F.lit(0).cast(kind))

    def count(value: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(value).isNotNull(), F.col("sign"))), F.lit(0)).cast("bigint")

    return lines.groupBy(*GROUP).agg(
        F.sum("sign").cast("bigint").alias("sales"),
        total("total_amount", SUMS["amount"]).alias("amount"), count("total_amount").alias("amounts"),
        total("quantity", "bigint").alias("units"), count("quantity").alias("unit_counts"),
        total("margin_pct", SUMS["margin"]).alias("margin"), count("margin_pct").alias("margins"),
    ).where(" OR ".join(f"{n} <> 0" for n in SUMS))


def changed_sales(changes: DataFrame, inputs: DataFrame) -> DataFrame:
    """What changed sales add to the sums, by the dimensions as last counted."""
    sign = F.when(F.col(CHANGE).isin("insert", "update_post"), F.lit(1)).otherwise(F.lit(-1))
    lines = _lines(changes, sign)
    return _signed_sums(lines.join(_customers(inputs), "customer_id", "left").join(_products(inputs), "product_id", "left"))


def _moves(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``key``, ``before``, ``after``: rows of a dimension that differ, as structs; null where there is none."""
    values = [n for n in old.columns if n != key]
    left = old.select(F.col(key).alias("k1"), F.struct(*values).alias("before"))
    right = new.select(F.col(key).alias("k2"), F.struct(*values).alias("after"))
    return left.join(right, F.col("k1").eqNullSafe(F.col("k2")), "full_outer").where(
        ~F.col("before").eqNullSafe(F.col("after"))
    ).select(F.coalesce("k1", "k2").alias(key), "before", "after")


def _moved(lines: DataFrame, moves: DataFrame, key: str) -> DataFrame:
    """Each line that a move concerns twice: taken from where it was, added to where it is."""
    twice = moves.select(
        key,
        F.explode(
            F.array(
                F.struct(F.lit(-1).alias("way"), F.col("before").alias("row")),
                F.struct(F.lit(1).alias("way"), F.col("after").alias("row")),
            )
        ).alias("side"),
    ).select(key, "side.way", "side.row.*")
    return lines.join(twice, key).withColumn("sign", F.col("sign") * F.col("way")).drop("way")


def moved_sales(sales: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """What changed dimension rows do to the sums; ``old`` and ``new`` are inputs.

    Customers move first, by the old products; then products, by the new customers. Only sales
    of moved customers and products are read beyond the join's filter.
    """
    lines = _lines(sales, F.lit(1))
    by_customer = _moved(lines, _moves(_customers(old), _customers(new), "customer_id"), "customer_id").join(
        _products(old), "product_id", "left"
    )
    by_product = _moved(lines, _moves(_products(old), _products(new), "product_id"), "product_id").join(
        _customers(new), "customer_id", "left"
    )
    return _signed_sums(by_customer.unionByName(by_product))


def add_to_sums(spark: SparkSession, table: str, delta: DataFrame, batch: str) -> None:
    """Changes the groups of ``delta`` and no others; a group without sales goes."""
    if known_batch(spark, table, batch):
        return
    with Stage(spark) as stage:
        delta = stage.keep(delta, "delta")
        stored = read_table(spark, table)
        match = same_key(delta, stored, GROUP)
        totals = delta.join(stored, match, "left").select(
            *[delta[n] for n in GROUP],
            *[(delta[n] + F.coalesce(stored[n], F.lit(0).cast(kind))).cast(kind).alias(n) for n, kind in SUMS.items()],
        )
        write_table(
            totals.where("sales > 0"), table, "merge", GROUP, check_unique=False, replaced_keys=delta.select(*GROUP),
            batch=batch,
        )


def report_rows(sums: DataFrame, amount_type: str = "decimal(12,2)") -> DataFrame:
    """The report's columns from the sums; a group's revenue beyond ``amount_type`` is an error."""
    return stamped(
        sums.select(
            *GROUP,
            F.when(F.col("amounts") > 0, F.col("amount").cast(amount_type)).alias("daily_sale"),
            F.when(F.col("unit_counts") > 0, F.col("units")).alias("daily_units_sold"),
            F.when(F.col("margins") > 0, (F.col("margin").cast("decimal(25,2)") / F.col("margins")).cast("decimal(9,6)"))
            .alias("average_margin_pct"),
        )
    )


def _empty(spark: SparkSession, table: str, schema: str, keys: Sequence[str]) -> None:
    if not spark.catalog.tableExists(table):
        write_table(spark.createDataFrame([], schema), table, "append", keys, check_unique=False)


def maintain_daily_sales(
    spark: SparkSession, customers: str, products: str, sales: str, report: str, checkpoint: str,
    amount_type: str = "decimal(12,2)",
) -> None:
    """Bring ``report`` up to date with the tables ``customers``, ``products`` and ``sales``."""
    sums, inputs, upcoming = f"{report}_sums", f"{report}_inputs", f"{report}_next"
    contract = GOLD_TABLES["fact_daily_sales"]
    kinds = ", ".join(f"{n} {t}" for n, t in SUMS.items())
    now = counted_inputs(read_table(spark, customers), read_table(spark, products))
    if not spark.catalog.tableExists(sums):
        # Nothing is counted yet, so the dimensions as they are will do.
        write_table(now, inputs, "overwrite", INPUT_KEYS, check_unique=False)
        write_table(now, upcoming, "overwrite", INPUT_KEYS, check_unique=False)
        _empty(spark, sums, f"sales_date date, product_category string, customer_region string, {kinds}", GROUP)

    def count(changes: DataFrame, batch: str) -> None:
        session = changes.sparkSession
        add_to_sums(session, sums, changed_sales(changes, read_table(session, inputs)), batch)

    follow_table(spark, sales, f"{checkpoint}/sales", count)

    pending = True
    while pending:  # a pass that died is finished first, with the dimensions it had noted
        pass_name = f"inputs after {generations(spark, inputs)[-1]}"
        pending = known_batch(spark, upcoming, pass_name)
        if pending or _moves_exist(read_table(spark, inputs), now):
            write_table(now, upcoming, "overwrite", INPUT_KEYS, check_unique=False, batch=pass_name)
            new = read_table(spark, upcoming)
            add_to_sums(spark, sums, moved_sales(read_table(spark, sales), read_table(spark, inputs), new), pass_name)
            write_table(new, inputs, "overwrite", INPUT_KEYS, check_unique=False, batch=pass_name)

    def tell(changes: DataFrame, batch: str) -> None:
        rows = report_rows(current_rows(changes, GROUP, keyed=True), amount_type)
        write_table(
            rows, report, "merge", GROUP, contract.cluster, check_unique=False,
            replaced_keys=changes.select(*GROUP).distinct(), batch=batch,
        )

    follow_table(spark, sums, f"{checkpoint}/report", tell)


def _moves_exist(old: DataFrame, new: DataFrame) -> bool:
    same = same_key(old, new, INPUT_KEYS) & F.struct(old["region"], old["category"], old["margin"]).eqNullSafe(
        F.struct(new["region"], new["category"], new["margin"])
    )
    return not (old.join(new, same, "left_anti").isEmpty() and new.join(old, same, "left_anti").isEmpty())

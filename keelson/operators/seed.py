"""Deterministic load-test tables: every column is a function of the row's number, so any range can be made anywhere.

i is the id and h = i * 2654435761 % 2147483647; i must stay below 3.47e9, where the product leaves 64 bits.
"""

from __future__ import annotations

from math import floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shares of the total, parents before children (fixed values).
SHARES = {"Customers": 0.10, "Products": 0.01, "Orders": 0.25, "OrderItems": 0.40, "Payments": 0.24}
BASE = "2026-01-01 00:00:00"
#: Value lists (fixed values).
FIRST = ("Aarav", "Priya", "Rahul", "Ananya", "Vikram", "Sara", "John", "Maria", "Wei", "Fatima")
LAST = ("Sharma", "Patel", "Singh", "Iyer", "Khan", "Smith", "Garcia", "Chen", "Müller", "Okafor")
COUNTRIES = ("IN", "US", "GB", "DE", "SG", "AE")
CATEGORIES = ("Electronics", "Books", "Home", "Toys", "Grocery", "Fashion")
STATUSES = ("new", "paid", "shipped", "delivered", "cancelled")
CURRENCIES = ("INR", "USD", "EUR")
METHODS = ("card", "upi", "netbanking", "wallet", "cod")
PARENTS = {"Orders": ("Customers",), "OrderItems": ("Orders", "Products"), "Payments": ("Orders",)}


def plan_rows(total: int | None = None, rows: dict[str, int] | None = None) -> dict[str, int]:
    """Rows by table: shares of a total, halves rounded up, or as given."""
    total = 10_000_000 if total is None and not rows else total
    out = {t: floor(total * s + 0.5) for t, s in SHARES.items()} if total is not None else dict.fromkeys(SHARES, 0)
    for t, n in (rows or {}).items():
        if t not in SHARES or n < 0:
            raise ValueError(f"rows: {t}={n}")
        out[t] = n
    return out


def check_batch(size: int) -> int:
    if not 1000 <= size <= 1_000_000:
        raise ValueError("batch size must be from 1000 to 1000000")
    return size


def pick(k: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


def _minutes_before(k: Column) -> Column:
    return F.lit(BASE).cast("timestamp_ntz") - F.make_dt_interval(mins=k.cast("int"))


def _money(cents: Column, precision: int) -> Column:
    return (cents.cast("decimal(18,0)") / F.lit(100).cast("decimal(3,0)")).cast(f"decimal({precision},2)")


def make(spark: SparkSession, table: str, first: int, rows: int, counts: dict[str, int] | None = None) -> DataFrame:
    """Rows first .. first + rows - 1 of a table; counts gives the sizes of its parents, which must not be empty."""
    counts = counts or {}
    if empty := [p for p in PARENTS.get(table, ()) if not counts.get(p)]:
        raise ValueError(f"{table}: empty parents {empty}")
    i, h = F.col("i"), F.col("h")
    n = {t: F.lit(c) for t, c in counts.items()}
    div = lambda k: F.floor(h / k).cast("bigint")
    base = spark.range(first, first + rows).select(F.col("id").alias("i"), (F.col("id") * 2654435761 % 2147483647).alias("h"))
    columns = {
        "Customers": lambda: [
            i.alias("CustomerId"), pick(h, FIRST).alias("FirstName"), pick(div(10), LAST).alias("LastName"), F.concat(F.lit("user"), i, F.lit("@example.com")).alias("Email"),
            pick(div(100), COUNTRIES).alias("Country"), _minutes_before(h % 1051200).alias("CreatedAt"), (h % 10 != 0).alias("IsActive"),
        ],
        "Products": lambda: [
            i.alias("ProductId"), F.concat(F.lit("SKU-"), F.lpad(i.cast("string"), 10, "0")).alias("Sku"), F.concat(F.lit("Product "), i).alias("Name"), pick(h, CATEGORIES).alias("Category"),
            _money(100 + h % 100000, 10).alias("Price"), _minutes_before(h % 1051200).alias("CreatedAt"),
        ],
        "Orders": lambda: [
            i.alias("OrderId"), (1 + h % n["Customers"]).alias("CustomerId"), pick(h, STATUSES).alias("Status"), _minutes_before(h % 525600).alias("OrderDate"),
            _money(h % 5000000, 18).alias("TotalAmount"), pick(div(7), CURRENCIES).alias("Currency"), F.expr("uuid()").alias("ExternalRef"),
        ],
        "OrderItems": lambda: [
            i.alias("OrderItemId"), (1 + h % n["Orders"]).alias("OrderId"), (1 + div(3) % n["Products"]).alias("ProductId"), (1 + h % 5).cast("int").alias("Quantity"),
            _money(100 + h % 50000, 10).alias("UnitPrice"), F.when(h % 4 != 0, _money(h % 30, 5)).alias("Discount"),
        ],
        "Payments": lambda: [
            i.alias("PaymentId"), (1 + (i - 1) % n["Orders"]).alias("OrderId"), pick(h, METHODS).alias("Method"), _money(h % 5000000, 18).alias("Amount"),
            F.when(h % 7 != 0, _minutes_before(h % 525600 + 330)).alias("PaidAt"), F.when(h % 50 == 0, F.repeat(F.lit("note "), 20)).alias("Notes"),
        ],
    }
    return base.select(*columns[table]())


def seed(spark: SparkSession, root: str, plan: dict[str, int], batch: int = 200_000, cancelled=lambda: False, progress=lambda table, done, total: None) -> dict[str, int]:
    """Appends the planned rows below root, parents first, ids behind the largest there is, batch by batch; returns rows added."""
    check_batch(batch)
    keys = {t: {"Customers": "CustomerId", "Products": "ProductId", "Orders": "OrderId", "OrderItems": "OrderItemId", "Payments": "PaymentId"}[t] for t in SHARES}
    counts: dict[str, int] = {}
    added = dict.fromkeys(SHARES, 0)
    for t in SHARES:
        path = f"{root}/{t}"
        try:
            start = spark.read.parquet(path).agg(F.coalesce(F.max(keys[t]), F.lit(0))).first()[0]
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            start = 0
        for at in range(0, plan[t], batch):
            if cancelled():
                return added
            rows = min(batch, plan[t] - at)
            make(spark, t, start + 1 + at, rows, counts).write.mode("append").parquet(path)
            added[t] += rows
            progress(t, added[t], plan[t])
        counts[t] = start + added[t]
    return added


# --- demonstration tables and the changes to watch


def demo_orders(spark: SparkSession, rows: int = 200_000, now: str = BASE) -> DataFrame:
    i = F.col("OrderId")
    at = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(mins=i.cast("int"))
    amount = ((i % 100_000).cast("decimal(18,6)") / F.lit(7).cast("decimal(1,0)")).cast("decimal(18,2)")
    status = pick(i, ("new", "paid", "shipped", "cancelled"))
    return spark.range(1, rows + 1).select(F.col("id").alias("OrderId")).select(
        i, (i % 5000).cast("int").alias("CustomerId"), status.alias("Status"), amount.alias("Amount"), F.lit("INR").alias("Currency"), (i % 4).isin(1, 2).alias("IsPaid"), at.alias("CreatedAt"),
        (at - F.make_dt_interval(mins=F.lit(330))).alias("UpdatedAtTz"), F.lit(None).cast("string").alias("Notes"),
    )


def demo_lines(spark: SparkSession, orders: int = 50_000) -> DataFrame:
    o, n = F.col("OrderId"), F.col("LineNo")
    base = spark.range(1, orders + 1).select(F.col("id").alias("OrderId"), F.explode(F.array(*[F.lit(k).cast("smallint") for k in (1, 2, 3)])).alias("LineNo"))
    return base.select(o, n, F.concat_ws("-", F.lit("SKU"), o % 997, n).alias("Sku"), (1 + o % 5).cast("int").alias("Qty"), F.lit("99.50").cast("decimal(19,4)").alias("Price"))


def demo_changes(orders: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables after refunds, deletes, inserts and a new column; which rows are taken is fixed by key order."""
    spark = orders.sparkSession
    first = lambda df, where, n, *key: df.where(where).orderBy(*key).limit(n).select(*key)  # noqa: E731 - a demonstration's TOP (n)
    refunded = first(orders, "Status = 'paid'", 500, "OrderId").withColumn("r", F.lit(True))
    gone = first(orders, "Status = 'cancelled' AND OrderId > 50000", 100, "OrderId")
    top = orders.agg(F.max("OrderId")).first()[0]
    new = spark.createDataFrame([(top + 1, 42, "new", 10), (top + 2, 43, "new", 20)], "OrderId long, CustomerId int, Status string, a int")
    new = new.withColumn("Amount", F.col("a").cast("decimal(18,2)")).withColumns({"Currency": F.lit("INR"), "IsPaid": F.lit(False)}).drop("a")
    after = orders.join(refunded, "OrderId", "left").join(gone, "OrderId", "left_anti")
    after = after.withColumns({"Status": F.when(F.col("r"), "refunded").otherwise(F.col("Status")), "Amount": F.when(F.col("r"), -F.col("Amount")).otherwise(F.col("Amount")).cast("decimal(18,2)")}).drop("r")
    after = after.unionByName(new, allowMissingColumns=True)
    mobile = first(after, "Status = 'new'", 50, "OrderId").withColumn("Channel", F.lit("mobile"))
    return after.join(mobile, "OrderId", "left"), lines.join(first(lines, "LineNo = 3", 100, "OrderId", "LineNo"), ["OrderId", "LineNo"], "left_anti")

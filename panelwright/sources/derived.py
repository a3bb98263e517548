"""Dirty panels derived from the driver's tables.

The driver's tables have no NULLs or placeholders, so dirt is an expression
of the row key (see FIXTURES.md section 2). Every frame here is computed by
Spark from the whole table and grows with it. The ``*_SQL`` strings are the
same derivations for DuckDB, used by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import PanelSpec
from .tables import read_table

# Panel stand-ins
ORDERS_SPEC = PanelSpec(("o_custkey",), ("o_orderdate", "o_orderkey"), id="o_orderkey")
EVENTS_SPEC = PanelSpec(("user_id",), ("ts", "event_id"), id="event_id")

# The five order priorities in their natural order (list fixture).
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _k(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def raw_text() -> Column:
    """Dirty text of the order total: NULL, '_' placeholder, trailing '_'."""
    price = F.col("o_totalprice").cast("string")
    return (F.when(_k(17), F.lit(None).cast("string"))
            .when(_k(13), F.lit("_"))
            .when(_k(11), F.concat(price, F.lit("_")))
            .otherwise(price))


RAW_SQL = ("CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '_' "
           "WHEN o_orderkey % 11 = 0 THEN concat(cast(o_totalprice AS varchar), '_') "
           "ELSE cast(o_totalprice AS varchar) END")


def orders_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """TO raw: (o_orderkey, o_custkey, o_orderdate, raw)."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return o.select("o_orderkey", "o_custkey", "o_orderdate", raw_text().alias("raw"))


TO_RAW_SQL = f"(SELECT o_orderkey, o_custkey, o_orderdate, {RAW_SQL} AS raw FROM orders)"


def bucket_col() -> Column:
    return F.when(_k(7), F.lit(None).cast("int")).otherwise((F.col("o_totalprice") / 100000).cast("int"))


BUCKET_SQL = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(trunc(o_totalprice / 100000) AS INTEGER) END"


def orders_bucketed(spark: SparkSession, data_dir: str) -> DataFrame:
    """TO bucketed: integer bucket of the total with NULLs (ties in modes)."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    return o.select("o_orderkey", "o_custkey", "o_orderdate", bucket_col().alias("bucket"))


TO_BUCKET_SQL = f"(SELECT o_orderkey, o_custkey, o_orderdate, {BUCKET_SQL} AS bucket FROM orders)"


def orders_category(spark: SparkSession, data_dir: str) -> DataFrame:
    """TO category: priority text with a '_______' placeholder."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return o.select("o_orderkey", "o_custkey", "o_orderdate",
                    F.when(_k(9), F.lit("_______")).otherwise(F.col("o_orderpriority")).alias("category"))


TO_CATEGORY_SQL = ("(SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderkey % 9 = 0 "
                   "THEN '_______' ELSE o_orderpriority END AS category FROM orders)")


def duration_text(r: Column) -> Column:
    return F.concat(F.floor(r / 12).cast("string"), F.lit(" Years and "), (r % 12).cast("string"),
                    F.lit(" Months"))


def orders_duration(spark: SparkSession, data_dir: str) -> DataFrame:
    """TO duration: 'Y Years and M Months' of the row's position in its
    customer's history (a month counter), NULL on some rows and corrupted
    (+30) on others."""
    from ..operators.ordered import row_index
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    o = row_index(o, ORDERS_SPEC, "_r")
    r = F.when(_k(19), F.col("_r") + 30).otherwise(F.col("_r"))
    return o.select("o_orderkey", "o_custkey", "o_orderdate",
                    F.when(_k(5), F.lit(None).cast("string")).otherwise(duration_text(r)).alias("history"))


TO_DURATION_SQL = """(SELECT o_orderkey, o_custkey, o_orderdate,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL
       ELSE concat(CAST(floor(r2 / 12) AS BIGINT), ' Years and ', r2 % 12, ' Months') END AS history
  FROM (SELECT *, CASE WHEN o_orderkey % 19 = 0 THEN r + 30 ELSE r END AS r2
        FROM (SELECT o_orderkey, o_custkey, o_orderdate,
                     row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r
              FROM orders)))"""


def list_text() -> Column:
    """TO list: a loan-list-like string per order, e.g. '1-URGENT, 3-MEDIUM,
    and 5-LOW'. Earlier items are picked by bits of the key; the last item is
    the row's own priority; NULL on some rows."""
    parts = [F.when(F.shiftright(F.col("o_orderkey"), i) % 2 == 1, F.lit(PRIORITIES[i] + ", "))
             .otherwise(F.lit("")) for i in range(4)]
    anybit = (F.col("o_orderkey") % 16) > 0
    s = F.concat(*parts, F.when(anybit, F.lit("and ")).otherwise(F.lit("")), F.col("o_orderpriority"))
    return F.when(_k(17), F.lit(None).cast("string")).otherwise(s)


LIST_SQL = ("CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE concat("
            + ", ".join(f"CASE WHEN (o_orderkey >> {i}) % 2 = 1 THEN '{PRIORITIES[i]}, ' ELSE '' END"
                        for i in range(4))
            + ", CASE WHEN o_orderkey % 16 > 0 THEN 'and ' ELSE '' END, o_orderpriority) END")


def orders_list(spark: SparkSession, data_dir: str) -> DataFrame:
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return o.select("o_orderkey", "o_custkey", "o_orderdate", list_text().alias("loans"))


TO_LIST_SQL = f"(SELECT o_orderkey, o_custkey, o_orderdate, {LIST_SQL} AS loans FROM orders)"

# y / y-hat for the metric queries (class indices 0..2)
Y_SQL = "o_orderkey % 3"
YHAT_SQL = "(o_orderkey + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END) % 3"


def orders_predictions(spark: SparkSession, data_dir: str) -> DataFrame:
    o = read_table(spark, data_dir, "orders", ["o_orderkey"])
    return o.select("o_orderkey", (F.col("o_orderkey") % 3).cast("int").alias("y"),
                    ((F.col("o_orderkey") + F.when(_k(7), 1).otherwise(0)) % 3).cast("int").alias("yhat"))


TO_PRED_SQL = f"(SELECT o_orderkey, CAST({Y_SQL} AS INTEGER) AS y, CAST({YHAT_SQL} AS INTEGER) AS yhat FROM orders)"


def events(spark: SparkSession, data_dir: str, columns=None) -> DataFrame:
    return read_table(spark, data_dir, "events", columns)


# ---------------------------------------------------------------------------
# a 28-column credit panel derived from orders x customer

def _txt(c: Column) -> Column:
    return c.cast("string")


def credit_panel_raw(spark: SparkSession, data_dir: str) -> DataFrame:
    """Raw credit panel in the 28-column layout: one row per order, the
    customer as panel key, the order month as 'Month'. Values are functions
    of the two tables with the dirt kinds of the source data (trailing '_',
    placeholders, sentinels, negatives, extremes, NULLs, list strings,
    durations). The label follows the customer's balance band, shifted by
    the order total."""
    o = read_table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                                "o_orderdate", "o_orderpriority"])
    c = read_table(spark, data_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                  "c_mktsegment"])
    j = o.join(c, o.o_custkey == c.c_custkey)
    k = F.col("o_orderkey")
    ck = F.col("c_custkey")
    bal = F.abs(F.col("c_acctbal"))
    income = F.round(bal * 12 + 20000, 2)
    age = ck % 45 + 20
    delayed = ck % 20
    n_loans = sum((F.shiftright(k, i) % 2) for i in range(4)) + 1
    months_hist = (F.year("o_orderdate") - 1990) * 12 + F.month("o_orderdate")
    nul = F.lit(None)
    return j.select(
        F.concat(F.lit("0x"), F.lower(F.hex(k))).alias("ID"),
        F.concat(F.lit("CUS_0x"), F.lower(F.hex(ck))).alias("Customer_ID"),
        F.date_format("o_orderdate", "MMMM").alias("Month"),
        F.col("c_name").alias("Name"),
        F.when(k % 23 == 0, F.lit("-500")).when(k % 29 == 0, F.lit("3000"))
         .when(k % 11 == 0, F.concat(_txt(age), F.lit("_"))).otherwise(_txt(age)).alias("Age"),
        F.concat(F.lit("SSN-"), _txt(ck)).alias("SSN"),
        F.when(k % 9 == 0, F.lit("_______")).otherwise(F.col("c_mktsegment")).alias("Occupation"),
        F.when(k % 13 == 0, F.concat(_txt(income), F.lit("_"))).otherwise(_txt(income)).alias("Annual_Income"),
        F.when(k % 7 == 0, nul).otherwise(F.round(income / 12, 2)).cast("double").alias("Monthly_Inhand_Salary"),
        F.when(k % 37 == 0, F.lit(-1)).when(k % 41 == 0, F.lit(1000) + ck % 500)
         .otherwise(F.col("c_nationkey") % 10).cast("int").alias("Num_Bank_Accounts"),
        F.when(k % 43 == 0, F.lit(1200) + ck % 300).otherwise(ck % 8 + 1).cast("int").alias("Num_Credit_Card"),
        F.when(k % 47 == 0, F.lit(3000) + ck % 100).otherwise(ck % 30 + 1).cast("int").alias("Interest_Rate"),
        F.when(k % 53 == 0, F.lit("-100")).when(k % 13 == 0, F.concat(_txt(n_loans), F.lit("_")))
         .otherwise(_txt(n_loans)).alias("Num_of_Loan"),
        list_text().alias("Type_of_Loan"),
        (k % 30).cast("int").alias("Delay_from_due_date"),
        F.when(k % 17 == 0, nul.cast("string")).when(k % 59 == 0, F.lit("4000"))
         .when(k % 11 == 0, F.concat(_txt(delayed), F.lit("_"))).otherwise(_txt(delayed))
         .alias("Num_of_Delayed_Payment"),
        F.when(k % 13 == 0, F.lit("_")).otherwise(_txt(F.round(F.col("o_totalprice") % 30, 2)))
         .alias("Changed_Credit_Limit"),
        F.when(k % 19 == 0, nul).when(k % 61 == 0, F.lit(2000.0))
         .otherwise((ck % 10).cast("double")).cast("double").alias("Num_Credit_Inquiries"),
        F.when(k % 7 == 0, F.lit("_")).otherwise(
            F.element_at(F.array(F.lit("Bad"), F.lit("Standard"), F.lit("Good")),
                         (F.col("c_nationkey") % 3 + 1).cast("int"))).alias("Credit_Mix"),
        F.when(k % 11 == 0, F.concat(_txt(F.round(F.col("o_totalprice") / 100, 2)), F.lit("_")))
         .otherwise(_txt(F.round(F.col("o_totalprice") / 100, 2))).alias("Outstanding_Debt"),
        ((k % 100) / 2.5).alias("Credit_Utilization_Ratio"),
        F.when(k % 5 == 0, nul.cast("string")).otherwise(duration_text(months_hist)).alias("Credit_History_Age"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes")).when(F.col("o_orderstatus") == "O", F.lit("No"))
         .otherwise(F.lit("NM")).alias("Payment_of_Min_Amount"),
        F.when(k % 67 == 0, F.lit(50000.0) + ck).otherwise(F.round(F.col("o_totalprice") / 1000, 2))
         .cast("double").alias("Total_EMI_per_month"),
        F.when(k % 19 == 0, nul.cast("string")).when(k % 71 == 0, F.lit("__10000__"))
         .otherwise(_txt(F.round(F.col("o_totalprice") / 500, 2))).alias("Amount_invested_monthly"),
        F.when(k % 9 == 0, F.lit("!@9#%8")).otherwise(F.col("o_orderpriority")).alias("Payment_Behaviour"),
        F.when(k % 97 == 0, F.lit("__-333333333333333333333333333__")).when(k % 23 == 0, nul.cast("string"))
         .otherwise(_txt(F.round(bal / 3 + F.col("o_totalprice") / 1000, 2))).alias("Monthly_Balance"),
        # the label follows the balance band, shifted by the order's size: partly learnable
        F.when(F.col("c_acctbal") + F.col("o_totalprice") % 3000 < 3000, F.lit("Poor"))
         .when(F.col("c_acctbal") + F.col("o_totalprice") % 3000 < 7500, F.lit("Standard"))
         .otherwise(F.lit("Good")).alias("Credit_Score"),
    )

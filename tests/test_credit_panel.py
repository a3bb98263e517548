"""The credit-panel recipe on a hand-made 28-column CSV (FIXTURES.md section 1)."""

import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from panelwright.plans import credit_panel as cp
from panelwright.sources import csv as csvsrc

MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August"]
HEADER = [f.name for f in cp.CREDIT_SCHEMA.fields]


def customer_rows(cid, base_age, occ, loans, dirty):
    rows = []
    for m in range(8):
        age = str(base_age + (1 if m >= 5 else 0))
        r = {
            "ID": f"0x{cid}{m:02d}", "Customer_ID": f"CUS_0x{cid}", "Month": MONTHS[m], "Name": "N",
            "Age": age, "SSN": "000-00-0000", "Occupation": occ, "Annual_Income": "36000.5",
            "Monthly_Inhand_Salary": "3000.0", "Num_Bank_Accounts": "3", "Num_Credit_Card": "4",
            "Interest_Rate": "7", "Num_of_Loan": str(len(loans.split(", ")) if loans else 0),
            "Type_of_Loan": loans, "Delay_from_due_date": str(m), "Num_of_Delayed_Payment": "5",
            "Changed_Credit_Limit": "11.27", "Num_Credit_Inquiries": "4.0", "Credit_Mix": "Good",
            "Outstanding_Debt": "809.98", "Credit_Utilization_Ratio": "26.8",
            "Credit_History_Age": f"22 Years and {m + 1} Months", "Payment_of_Min_Amount": "No",
            "Total_EMI_per_month": "49.57", "Amount_invested_monthly": "80.41",
            "Payment_Behaviour": "High_spent_Small_value_payments", "Monthly_Balance": "312.49",
            "Credit_Score": "Good" if cid == "A" else "Standard",
        }
        rows.append(r)
    if dirty:
        rows[2]["Age"] = rows[2]["Age"] + "_"
        rows[3]["Age"] = "-500"
        rows[1]["Occupation"] = "_______"
        rows[4]["Annual_Income"] = "36000.5_"
        rows[2]["Monthly_Inhand_Salary"] = ""
        rows[6]["Num_Bank_Accounts"] = "-1"
        rows[5]["Num_Credit_Card"] = "1385"
        rows[3]["Interest_Rate"] = "5000"
        rows[1]["Num_of_Delayed_Payment"] = ""
        rows[4]["Num_of_Delayed_Payment"] = "3_"
        rows[2]["Changed_Credit_Limit"] = "_"
        rows[6]["Num_Credit_Inquiries"] = ""
        rows[0]["Credit_Mix"] = "_"
        rows[7]["Outstanding_Debt"] = "809.98_"
        rows[1]["Credit_History_Age"] = ""
        rows[5]["Payment_of_Min_Amount"] = "NM"
        rows[3]["Total_EMI_per_month"] = "80000.0"
        rows[0]["Amount_invested_monthly"] = "__10000__"
        rows[6]["Payment_Behaviour"] = "!@9#%8"
        rows[7]["Monthly_Balance"] = "__-333333333333333333333333333__"
    return rows


@pytest.fixture(scope="module")
def raw(spark):
    d = tempfile.mkdtemp(prefix="pw-credit-")
    rows = (customer_rows("A", 23, "Scientist", "Auto Loan, Credit-Builder Loan, and Home Equity Loan", True)
            + customer_rows("B", 40, "Teacher", "Student Loan", True)
            + customer_rows("C", 31, "Lawyer", "", False))
    # a customer with a spread of ages gives the column a non-zero max MAD
    rows[18]["Age"], rows[20]["Age"] = "35", "40"
    with open(os.path.join(d, "panel.csv"), "w", newline="") as fh:
        w = csv.DictWriter(fh, HEADER, quoting=csv.QUOTE_MINIMAL, doublequote=True)
        w.writeheader()
        w.writerows(rows)
    return csvsrc.read_panel_csv(spark, d, cp.CREDIT_SCHEMA, glob="*.csv", with_source=False)


@pytest.fixture(scope="module")
def cleaned(raw):
    return {r["ID"]: r for r in cp.clean(raw).collect()}


def test_scan(raw):
    assert raw.count() == 24
    r = raw.where(F.col("ID") == "0xA02").first()
    assert r["Monthly_Inhand_Salary"] is None and r["Age"] == "23_"


def test_columns(raw):
    out = cp.clean(raw)
    assert out.columns == ["ID", *cp.CLEAN_COLUMNS, "Last_Loan_3", "Last_Loan_2", "Last_Loan_1", "Credit_Score"]


def by_customer(cleaned, cid, col):
    return [cleaned[f"0x{cid}{m:02d}"][col] for m in range(8)]


def test_age(cleaned):
    assert by_customer(cleaned, "A", "Age") == [23, 23, 23, 23, 23, 24, 24, 24]


def test_placeholders_filled(cleaned):
    assert set(by_customer(cleaned, "A", "Occupation")) == {"Scientist"}
    assert set(by_customer(cleaned, "A", "Credit_Mix")) == {"Good"}
    assert set(by_customer(cleaned, "A", "Payment_Behaviour")) == {"High_spent_Small_value_payments"}
    assert set(by_customer(cleaned, "A", "Payment_of_Min_Amount")) == {"No"}


def test_numeric_repairs(cleaned):
    assert set(by_customer(cleaned, "A", "Annual_Income")) == {36000.5}
    assert set(by_customer(cleaned, "A", "Monthly_Inhand_Salary")) == {3000.0}
    assert set(by_customer(cleaned, "A", "Num_Bank_Accounts")) == {3}
    assert set(by_customer(cleaned, "A", "Num_Credit_Card")) == {4}
    assert set(by_customer(cleaned, "A", "Interest_Rate")) == {7.0}
    assert set(by_customer(cleaned, "A", "Outstanding_Debt")) == {809.98}
    assert set(by_customer(cleaned, "A", "Monthly_Balance")) == {312.49}
    assert set(by_customer(cleaned, "A", "Amount_invested_monthly")) == {80.41}
    assert set(by_customer(cleaned, "A", "Changed_Credit_Limit")) == {11.27}
    # '3_' stays a value (3); the NULL takes the single mode 5
    assert by_customer(cleaned, "A", "Num_of_Delayed_Payment") == [5, 5, 5, 5, 3, 5, 5, 5]


def test_counter_rebuilt(cleaned):
    assert by_customer(cleaned, "A", "Credit_History_Age") == [265 + m for m in range(8)]


def test_loans(cleaned):
    a = cleaned["0xA00"]
    assert (a["Last_Loan_3"], a["Last_Loan_2"], a["Last_Loan_1"]) == (
        "Auto Loan", "Credit-Builder Loan", "Home Equity Loan")
    b = cleaned["0xB00"]
    assert (b["Last_Loan_3"], b["Last_Loan_2"], b["Last_Loan_1"]) == ("No Loan", "No Loan", "Student Loan")
    c = cleaned["0xC00"]
    assert (c["Last_Loan_1"], c["Num_of_Loan"]) == ("No Loan", 0)
    assert a["Num_of_Loan"] == 3


def test_emi_rules(cleaned):
    emi = by_customer(cleaned, "A", "Total_EMI_per_month")
    assert emi[3] == 49.57 and set(emi) == {49.57}


def test_no_nulls_left(cleaned):
    for r in cleaned.values():
        assert all(r[c] is not None for c in cp.CLEAN_COLUMNS), r


@pytest.mark.parametrize("sf", ["hand", "/root/testdata/sf0.001"])
def test_fused_equals_operator_chain(spark, raw, sf):
    from panelwright.sources import derived as dv
    src = raw if sf == "hand" else dv.credit_panel_raw(spark, sf)
    a = cp.clean(src, cp.CreditOptions(fused=True)).collect()
    b = cp.clean(src, cp.CreditOptions(fused=False)).collect()
    norm = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert norm(a) == norm(b)


def test_hot_customers_give_the_same_panel(spark):
    """Every customer forced hot: the recipe runs the operators' split plans
    (chunked scans, bracketed quantiles, aggregate statistics) end to end."""
    from panelwright.sources import derived as dv
    from panelwright.spec import PanelSpec, SkewPolicy
    tiny = SkewPolicy(hot_rows=4, chunk_rows=3, broadcast_keys=1_000_000)
    hot_spec = PanelSpec(("Customer_ID",), ("Month", "ID"), id="ID", skew=tiny)
    src = dv.credit_panel_raw(spark, "/root/testdata/sf0.001")
    a = cp.clean(src).collect()
    b = cp.clean(src, spec=hot_spec).collect()
    norm = lambda rows: sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)
    assert norm(a) == norm(b)


def norm(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


def mixed(spark):
    """A panel whose largest customers are hot beside bounded ones, and rows
    without a customer."""
    from panelwright.sources import derived as dv
    src = dv.credit_panel_raw(spark, "/root/testdata/sf0.001")
    few = F.col("Customer_ID").isin([f"CUS_0x{i:x}" for i in (1, 2, 4)])
    src = src.withColumn("Customer_ID", F.when(few, F.lit("CUS_0xHOT")).otherwise(F.col("Customer_ID")))
    lost = src.limit(40).withColumns({"Customer_ID": F.lit(None).cast("string"), "ID": F.concat(F.lit("n"), "ID")})
    return src.unionByName(lost).cache()


def test_hot_and_bounded_customers_share_one_recipe_and_one_write(spark, monkeypatch):
    from panelwright.plans import panel_levels as pl
    from panelwright.spec import PanelSpec, SkewPolicy
    src = mixed(spark)
    sizes = sorted(r["count"] for r in src.where("Customer_ID is not null").groupBy("Customer_ID").count().collect())
    policy = SkewPolicy(hot_rows=sizes[-2], chunk_rows=5)          # exactly one hot customer
    writes = {"bounded": 0, "hot": 0}
    materialize, bucketed = pl.materialize, pl.bucketed
    monkeypatch.setattr(pl, "materialize", lambda *a, **k: (writes.update(bounded=writes["bounded"] + 1), materialize(*a, **k))[1])
    monkeypatch.setattr(pl, "bucketed", lambda *a, **k: (writes.update(hot=writes["hot"] + 1), bucketed(*a, **k))[1])
    got = cp.clean(src, spec=PanelSpec(("Customer_ID",), ("Month", "ID"), id="ID", skew=policy)).collect()
    assert writes == {"bounded": 1, "hot": 1}
    monkeypatch.undo()
    assert norm(got) == norm(cp.clean(src).collect())


def two_samples(spark):
    """Two samples of the same customers with different values, gaps and rows."""
    from panelwright.sources import derived as dv
    a = dv.credit_panel_raw(spark, "/root/testdata/sf0.001")
    odd = F.pmod(F.xxhash64("ID"), F.lit(3)) == 0
    b = a.withColumns({
        "Total_EMI_per_month": F.col("Total_EMI_per_month") * 40, "Age": F.when(odd, None).otherwise(F.concat(F.col("Age"), F.lit("1"))),
        "Num_Credit_Inquiries": F.col("Num_Credit_Inquiries") * 9, "Monthly_Balance": F.when(odd, None).otherwise(F.lit("7.5")),
        "Occupation": F.when(odd, F.col("Occupation")).otherwise(F.lit("Miner"))}).where(F.pmod(F.xxhash64("ID"), F.lit(7)) > 0)
    return a, b


@pytest.mark.parametrize("hot_rows", [2_000_000, 6])
def test_samples_are_cleaned_as_if_alone(spark, hot_rows):
    from panelwright.spec import PanelSpec, SkewPolicy
    a, b = two_samples(spark)
    policy = SkewPolicy(hot_rows=hot_rows, chunk_rows=4)
    both = a.withColumn("sample", F.lit("a")).unionByName(b.withColumn("sample", F.lit("b")))
    spec = PanelSpec(("Customer_ID", "sample"), ("Month", "ID"), id="ID", skew=policy)
    got = cp.clean(both, cp.CreditOptions(keep=("sample",), sample="sample", loan_width=9), spec)
    for name, alone in (("a", a), ("b", b)):
        want = cp.clean(alone, cp.CreditOptions(loan_width=9))
        mine = got.where(F.col("sample") == name).drop("sample")
        assert mine.columns == want.columns and norm(mine.collect()) == norm(want.collect())


def test_point_repair_nulls_the_named_cells_before_the_fills(spark, raw):
    repairs = spark.createDataFrame([("0xB03", "Num_Credit_Card"), ("0xA02", "Age"), ("0xB05", "Occupation")], "ID string, column string")
    wrong = raw.withColumn("Num_Credit_Card", F.when(F.col("ID") == "0xB03", 5).otherwise(F.col("Num_Credit_Card")))
    out = {r["ID"]: r for r in cp.clean(wrong, cp.CreditOptions(point_repairs=repairs)).collect()}
    assert out["0xB03"]["Num_Credit_Card"] == 4 and out["0xB05"]["Occupation"] == "Teacher"


def test_group_work_is_done_once_and_rows_are_ordered_once(spark):
    """The last job reads the written panel: medians, income and salary are
    in it, one order of the rows serves every fill, and modes take one column."""
    from panelwright.sources import derived as dv
    text = cp.clean(dv.credit_panel_raw(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in text and "ExistingRDD" not in text and "Window [percentile" not in text
    # the fills, the anchor and one narrow window for each of four modes
    assert text.count("Window [") == 6 and text.count("_pos#") and len([x for x in text.splitlines() if "Sort [" in x and "_pos#" in x]) == 1


def test_rows_without_a_customer_meet_nobody(spark, raw):
    """A customer named by an empty text is one; a missing customer is none."""
    some = raw.where(F.col("ID").isin("0xA00", "0xA01")).withColumn("Customer_ID", F.when(F.col("ID") == "0xA00", F.lit("")))
    named = raw.where("ID = '0xB05'").withColumns({"Customer_ID": F.lit(""), "Month": F.lit("February"), "Occupation": F.lit("Cook")})
    out = {r["ID"]: r for r in cp.clean(some.unionByName(named)).collect()}
    assert len(out) == 3 and out["0xA01"]["Customer_ID"] is None and out["0xA01"]["Occupation"] is None
    assert out["0xA00"]["Customer_ID"] == out["0xB05"]["Customer_ID"] == ""

"""The credit recipe against an independent brute-force pandas version.

The recipe has no SQL oracle, so the same rules are written here a second
time, row by row in pandas (group by group), and both are run on the
derived 28-column panel of the smallest tables. Every cell must agree.
"""

import math
import re

import numpy as np
import pandas as pd
import pytest

from panelwright.functions.text import MONTH_NUMBER
from panelwright.plans import credit_panel as cp
from panelwright.sources import derived as dv

from .conftest import SF_SMALL

DUR = re.compile(r"(\d+) Years and (\d+) Months")


def num(s, strip=True):
    s = s.astype("object")
    if strip:
        s = s.map(lambda v: v.replace("_", "") if isinstance(v, str) else v)
    return pd.to_numeric(s, errors="coerce")


def ffbf(s):
    return s.ffill().bfill()


def modes(s):
    return sorted(s.dropna().value_counts().pipe(lambda vc: vc[vc == vc.max()]).index.tolist()) if s.notna().any() else []


def median(s):
    return s.median() if s.notna().any() else np.nan


def mad(s):
    if not s.notna().any():
        return np.nan
    return (s - s.median()).abs().median()


def robust_z(s, max_mad):
    med = median(s)
    dev = s - med
    m = mad(s)
    if m != 0:
        return dev / m
    if ((dev.abs() == 0) | s.isna()).all():
        return s * 0

    def div(x):
        if pd.isna(x):
            return np.nan
        if max_mad != 0:
            return x / max_mad
        return math.inf if x > 0 else (-math.inf if x < 0 else 0.0)
    return dev.map(div)


def upper_fence(s):
    q1, q3 = s.quantile(0.25), s.quantile(0.75)
    return q3 + 1.5 * (q3 - q1)


def brute(raw: pd.DataFrame, k: int) -> pd.DataFrame:
    df = raw.copy()
    df["Month"] = df["Month"].map(MONTH_NUMBER)
    df["Age"] = num(df["Age"])
    df.loc[(df["Age"] > 100) | (df["Age"] <= 0), "Age"] = np.nan
    df["Occupation"] = df["Occupation"].replace("_______", np.nan)
    df["Annual_Income"] = num(df["Annual_Income"])
    df["Num_of_Delayed_Payment"] = num(df["Num_of_Delayed_Payment"])
    df["Changed_Credit_Limit"] = num(df["Changed_Credit_Limit"].replace("_", np.nan), strip=False)
    df["Credit_Mix"] = df["Credit_Mix"].replace("_", np.nan)
    df["Outstanding_Debt"] = num(df["Outstanding_Debt"])
    df["Amount_invested_monthly"] = num(df["Amount_invested_monthly"])
    df.loc[df["Amount_invested_monthly"] > 8000, "Amount_invested_monthly"] = np.nan
    df["Payment_Behaviour"] = df["Payment_Behaviour"].replace("!@9#%8", np.nan)
    df["Monthly_Balance"] = num(df["Monthly_Balance"].replace("__-333333333333333333333333333__", np.nan),
                                strip=False)
    df["Credit_History_Age"] = df["Credit_History_Age"].map(
        lambda v: int(DUR.search(v).group(1)) * 12 + int(DUR.search(v).group(2))
        if isinstance(v, str) and DUR.search(v) else np.nan)
    df["Payment_of_Min_Amount"] = df["Payment_of_Min_Amount"].map({"Yes": 1, "No": 0})
    df.loc[df["Num_Bank_Accounts"] < 0, "Num_Bank_Accounts"] = np.nan
    for c in ("Num_Bank_Accounts", "Num_Credit_Card", "Interest_Rate", "Num_Credit_Inquiries",
              "Total_EMI_per_month", "Monthly_Inhand_Salary"):
        df[c] = df[c].astype(float)
    df = df.sort_values(["Customer_ID", "Month", "ID"]).reset_index(drop=True)
    g = df.groupby("Customer_ID", sort=False)

    def max_mad(c):
        return g[c].agg(mad).max()

    mm = {c: max_mad(c) for c in ("Age", "Num_Bank_Accounts", "Num_Credit_Card", "Total_EMI_per_month")}
    fence_delay = upper_fence(df["Num_of_Delayed_Payment"])
    fence_inq = upper_fence(df["Num_Credit_Inquiries"])

    # EMI: robust rule, fence, fill, mean
    z = g["Total_EMI_per_month"].transform(lambda s: robust_z(s, mm["Total_EMI_per_month"]))
    df.loc[z > 10000, "Total_EMI_per_month"] = np.nan
    df.loc[df["Total_EMI_per_month"] > upper_fence(df["Total_EMI_per_month"]), "Total_EMI_per_month"] = np.nan
    df["Total_EMI_per_month"] = df.groupby("Customer_ID", sort=False)["Total_EMI_per_month"].transform(ffbf)
    df["Total_EMI_per_month"] = df["Total_EMI_per_month"].fillna(df["Total_EMI_per_month"].mean())

    g = df.groupby("Customer_ID", sort=False)
    z = g["Age"].transform(lambda s: robust_z(s, mm["Age"]))
    df.loc[z > 80, "Age"] = np.nan
    for c in ("Num_Bank_Accounts", "Num_Credit_Card"):
        z = g[c].transform(lambda s, c=c: robust_z(s, mm[c]))
        df.loc[z.abs() > 2, c] = np.nan
    df.loc[(df["Num_of_Delayed_Payment"] > fence_delay) | (df["Num_of_Delayed_Payment"] < 0),
           "Num_of_Delayed_Payment"] = np.nan
    df.loc[(df["Num_Credit_Inquiries"] > fence_inq) | (df["Num_Credit_Inquiries"] < 0),
           "Num_Credit_Inquiries"] = np.nan

    # income within (customer, salary); salary within (customer, income)
    has_sal = df["Monthly_Inhand_Salary"].notna()
    sub = df[has_sal].groupby(["Customer_ID", "Monthly_Inhand_Salary"], sort=False)["Annual_Income"]
    df.loc[has_sal, "Annual_Income"] = sub.transform(lambda s: min(modes(s)) if modes(s) else np.nan)
    has_inc = df["Annual_Income"].notna()
    sub = df[has_inc].groupby(["Customer_ID", "Annual_Income"], sort=False)["Monthly_Inhand_Salary"]
    df.loc[has_inc, "Monthly_Inhand_Salary"] = sub.transform(ffbf)
    df.loc[df["Monthly_Inhand_Salary"].isna(), "Annual_Income"] = np.nan

    df["Num_of_Loan"] = df["Type_of_Loan"].map(lambda v: len(v.split(", ")) if isinstance(v, str) else 0)
    g = df.groupby("Customer_ID", sort=False)
    for c in ("Age", "Occupation", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts",
              "Num_Credit_Card", "Num_of_Loan", "Num_Credit_Inquiries", "Credit_Mix"):
        df[c] = g[c].transform(ffbf)
    df["Interest_Rate"] = g["Interest_Rate"].transform(median)

    def mode_median_int(s):
        m = modes(s)
        if not m:
            return s
        return s.fillna(m[0] if len(m) == 1 else float(int(np.median(m))))

    def mode_mean(s):
        m = modes(s)
        if not m:
            return s
        return s.fillna(m[0] if len(m) == 1 else float(np.mean(m)))

    def counter(s):
        if not s.notna().any():
            return s
        pos = int(np.nanargmin(s.to_numpy(dtype=float)))
        return pd.Series(s.iloc[pos] + np.arange(len(s)) - pos, index=s.index, dtype=float)

    def smallest_mode(s):
        m = modes(s)
        return s.fillna(m[0]) if m else s

    def mode_or_fill(s):
        m = modes(s)
        return pd.Series([m[0]] * len(s), index=s.index) if len(m) == 1 else ffbf(s)

    df["Num_of_Delayed_Payment"] = g["Num_of_Delayed_Payment"].transform(mode_median_int)
    df["Changed_Credit_Limit"] = g["Changed_Credit_Limit"].transform(mode_mean)
    df["Credit_History_Age"] = g["Credit_History_Age"].transform(counter)
    df["Payment_of_Min_Amount"] = g["Payment_of_Min_Amount"].transform(smallest_mode).map({1: "Yes", 0: "No"})
    df["Amount_invested_monthly"] = g["Amount_invested_monthly"].transform(lambda s: s.fillna(median(s)))
    df["Payment_Behaviour"] = g["Payment_Behaviour"].transform(mode_or_fill)
    df["Monthly_Balance"] = g["Monthly_Balance"].transform(lambda s: s.fillna(median(s)))

    items = df["Type_of_Loan"].fillna("No Loan").map(lambda v: [x.lstrip("and ") for x in v.split(", ")])
    for i in range(k, 0, -1):
        df[f"Last_Loan_{i}"] = items.map(lambda a, i=i: a[-i] if len(a) >= i else "No Loan")
    return df


@pytest.mark.parametrize("fused", [True, False])
def test_recipe_matches_bruteforce(spark, fused):
    raw_df = dv.credit_panel_raw(spark, SF_SMALL)
    out = cp.clean(raw_df, cp.CreditOptions(fused=fused)).toPandas().set_index("ID").sort_index()
    k = sum(1 for c in out.columns if c.startswith("Last_Loan_"))
    exp = brute(raw_df.toPandas(), k).set_index("ID").sort_index()
    assert list(out.index) == list(exp.index)
    bad = []
    for c in out.columns:
        a, b = out[c], exp[c]
        for idx in out.index:
            x, y = a[idx], b[idx]
            xn, yn = x is None or (isinstance(x, float) and math.isnan(x)), y is None or (
                isinstance(y, float) and math.isnan(y))
            if xn or yn:
                ok = xn and yn
            elif isinstance(x, str) or isinstance(y, str):
                ok = x == y
            else:
                ok = math.isclose(float(x), float(y), rel_tol=1e-9, abs_tol=1e-9)
            if not ok:
                bad.append((c, idx, x, y))
    assert not bad, bad[:10]

"""The credit-panel recipe as one DuckDB statement, for the oracle.

Written from the rules, not from the Spark plan: typed values straight from
``orders`` x ``customer`` (what the raw text stands for), then the rules as
windows. ``samples`` names the samples and how each one's rows differ.
"""

from __future__ import annotations

from ..sources.derived import LIST_SQL

INTS = ("Age", "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Num_of_Delayed_Payment", "Num_Credit_Inquiries",
        "Credit_History_Age", "Delay_from_due_date")
DOUBLES = ("Annual_Income", "Monthly_Inhand_Salary", "Interest_Rate", "Changed_Credit_Limit", "Outstanding_Debt",
           "Credit_Utilization_Ratio", "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance")
TEXTS = ("Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour")
LOANS = 5       # the derived lists hold at most five items


def r2(x: str) -> str:
    """Half up at two places of the shortest decimal form, as Spark rounds."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


# Values of the two tables behind the raw text, by column.
TYPED = {
    "Age": "CASE WHEN k % 23 = 0 OR k % 29 = 0 THEN NULL ELSE ck % 45 + 20 END",
    "Occupation": "CASE WHEN k % 9 = 0 THEN NULL ELSE c_mktsegment END",
    "Annual_Income": "income",
    "Monthly_Inhand_Salary": f"CASE WHEN k % 7 = 0 THEN NULL ELSE {r2('income / 12')} END",
    "Num_Bank_Accounts": "CASE WHEN k % 37 = 0 THEN NULL WHEN k % 41 = 0 THEN 1000 + ck % 500 ELSE c_nationkey % 10 END",
    "Num_Credit_Card": "CASE WHEN k % 43 = 0 THEN 1200 + ck % 300 ELSE ck % 8 + 1 END",
    "Interest_Rate": "CAST(CASE WHEN k % 47 = 0 THEN 3000 + ck % 100 ELSE ck % 30 + 1 END AS DOUBLE)",
    "Delay_from_due_date": "k % 30",
    "Num_of_Delayed_Payment": "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 59 = 0 THEN 4000 ELSE ck % 20 END",
    "Changed_Credit_Limit": f"CASE WHEN k % 13 = 0 THEN NULL ELSE {r2('o_totalprice % 30')} END",
    "Num_Credit_Inquiries": "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 61 = 0 THEN 2000 ELSE ck % 10 END",
    "Credit_Mix": "CASE WHEN k % 7 = 0 THEN NULL ELSE ['Bad', 'Standard', 'Good'][c_nationkey % 3 + 1] END",
    "Outstanding_Debt": r2("o_totalprice / 100"),
    "Credit_Utilization_Ratio": "(k % 100) / CAST(2.5 AS DOUBLE)",
    "Credit_History_Age": "CASE WHEN k % 5 = 0 THEN NULL ELSE (year(o_orderdate) - 1990) * 12 + month(o_orderdate) END",
    "Payment_of_Min_Amount": "CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' END",
    "Total_EMI_per_month": f"CASE WHEN k % 67 = 0 THEN CAST(50000.0 AS DOUBLE) + ck ELSE {r2('o_totalprice / 1000')} END",
    "Amount_invested_monthly": f"CASE WHEN k % 19 = 0 OR k % 71 = 0 THEN NULL ELSE {r2('o_totalprice / 500')} END",
    "Payment_Behaviour": "CASE WHEN k % 9 = 0 THEN NULL ELSE o_orderpriority END",
    "Monthly_Balance": f"CASE WHEN k % 97 = 0 OR k % 23 = 0 THEN NULL ELSE {r2('bal / 3 + o_totalprice / 1000')} END",
}


TYPED_CTE = f"""base AS (SELECT *, o_orderkey AS k, c_custkey AS ck, abs(c_acctbal) AS bal, {r2('abs(c_acctbal) * 12 + 20000')} AS income,
  {LIST_SQL} AS loans FROM orders JOIN customer ON o_custkey = c_custkey),
typed AS (SELECT 'CUS_0x' || lower(printf('%x', ck)) AS g, month(o_orderdate) AS m, k, '0x' || lower(printf('%x', k)) AS ID, loans,
  CASE WHEN c_acctbal + o_totalprice % 3000 < 3000 THEN 'Poor' WHEN c_acctbal + o_totalprice % 3000 < 7500 THEN 'Standard'
       ELSE 'Good' END AS Credit_Score, {', '.join(f'{e} AS {c}' for c, e in TYPED.items())} FROM base)"""


def _fill(col: str, part: str = "s, g") -> str:
    w = f"PARTITION BY {part} ORDER BY m, ID ROWS BETWEEN"
    return (f"coalesce(last_value({col} IGNORE NULLS) OVER ({w} UNBOUNDED PRECEDING AND CURRENT ROW), "
            f"first_value({col} IGNORE NULLS) OVER ({w} CURRENT ROW AND UNBOUNDED FOLLOWING))")


def _modes(name: str, col: str, src: str) -> str:
    value = "" if col in TEXTS else f", avg(v) AS mean_, median(v) AS med_"
    return f"""{name} AS (SELECT s, g, count(*) AS n_, min(v) AS min_{value}
  FROM (SELECT s, g, {col} AS v, count(*) AS c, max(count(*)) OVER (PARTITION BY s, g) AS mx
        FROM {src} WHERE {col} IS NOT NULL GROUP BY s, g, {col}) WHERE c = mx GROUP BY s, g)"""


def credit_panel_sql(samples: dict[str, tuple[dict[str, str], str]], with_sample: bool = False) -> str:
    """``samples``: name -> (SQL of the columns that differ, condition on the rows)."""
    dev = ("Age", "Num_Bank_Accounts", "Num_Credit_Card", "Total_EMI_per_month")
    fences = ("Num_of_Delayed_Payment", "Num_Credit_Inquiries")
    typed = " UNION ALL ".join(
        f"SELECT '{s}' AS s, g, m, k, ID, loans, Credit_Score, " + ", ".join(f"{other.get(c, f't.{c}')} AS {c}" for c in TYPED)
        + f" FROM typed t WHERE {keep}" for s, (other, keep) in samples.items())
    z = {c: (f"CASE WHEN {c} IS NULL THEN NULL WHEN mad_{c} <> 0 THEN ({c} - med_{c}) / mad_{c} WHEN eq_{c} THEN {c} * 0.0 "
             f"WHEN maxmad_{c} <> 0 THEN ({c} - med_{c}) / maxmad_{c} WHEN {c} > med_{c} THEN CAST('inf' AS DOUBLE) "
             f"WHEN {c} < med_{c} THEN CAST('-inf' AS DOUBLE) ELSE 0.0 END") for c in dev}
    rule = {
        "Age": f"CASE WHEN {z['Age']} > 80 THEN NULL ELSE Age END",
        **{c: f"CASE WHEN abs({z[c]}) > 2 THEN NULL ELSE {c} END" for c in dev[1:3]},
        "Total_EMI_per_month": f"CASE WHEN {z['Total_EMI_per_month']} > 10000 THEN NULL ELSE Total_EMI_per_month END",
        **{c: f"CASE WHEN {c} > up_{c} OR {c} < 0 THEN NULL ELSE {c} END" for c in fences},
        "Interest_Rate": "median(Interest_Rate) OVER (PARTITION BY s, g)",
        **{c: f"coalesce({c}, median({c}) OVER (PARTITION BY s, g))" for c in ("Amount_invested_monthly", "Monthly_Balance")},
    }
    filled = ("Age", "Occupation", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
              "Num_Credit_Inquiries", "Credit_Mix", "Total_EMI_per_month")

    def upper(c: str) -> str:
        return f"quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
    last = {
        "Num_of_Loan": "CASE WHEN loans IS NULL THEN 0 ELSE len(string_split(loans, ', ')) END",
        "Num_of_Delayed_Payment": "coalesce(Num_of_Delayed_Payment, CASE WHEN nd.n_ = 1 THEN nd.min_ ELSE trunc(nd.med_) END)",
        "Changed_Credit_Limit": "coalesce(Changed_Credit_Limit, CASE WHEN cc.n_ = 1 THEN cc.min_ ELSE cc.mean_ END)",
        "Payment_of_Min_Amount": "coalesce(Payment_of_Min_Amount, pm.min_)",
        "Payment_Behaviour": "CASE WHEN pb.n_ = 1 THEN pb.min_ ELSE behaviour END",
        "Credit_History_Age": "anchor.v + pos - anchor.p",
        "Total_EMI_per_month": "coalesce(Total_EMI_per_month, (SELECT avg(Total_EMI_per_month) FROM fills f2 WHERE f2.s = f.s))",
    }
    from .credit_panel import CLEAN_COLUMNS

    def out(c: str) -> str:
        e = last.get(c, c)
        if c == "Customer_ID":
            return "f.g AS Customer_ID"
        return f"CAST({e} AS INTEGER) AS {c}" if c in INTS else f"round({e}, 6) AS {c}" if c in DOUBLES else f"{e} AS {c}"
    items = [f"""CASE WHEN loans IS NULL OR len(string_split(loans, ', ')) < {i} THEN 'No Loan'
  ELSE ltrim(string_split(loans, ', ')[-{i}], 'and ') END AS Last_Loan_{i}""" for i in range(LOANS, 0, -1)]
    return f"""
WITH {TYPED_CTE},
panel AS ({typed}),
med AS (SELECT *, {', '.join(f'median({c}) OVER (PARTITION BY s, g) AS med_{c}' for c in dev)} FROM panel),
mad AS (SELECT *, {', '.join(f'median(abs({c} - med_{c})) OVER (PARTITION BY s, g) AS mad_{c}, '
                             f'bool_and({c} = med_{c}) OVER (PARTITION BY s, g) AS eq_{c}' for c in dev)} FROM med),
whole AS (SELECT s, {', '.join(f'max(mad_{c}) AS maxmad_{c}' for c in dev)}, {', '.join(f'{upper(c)} AS up_{c}' for c in fences)}
  FROM mad GROUP BY s),
rules AS (SELECT s, g, m, k, ID, loans, Credit_Score, {', '.join(f'{rule.get(c, c)} AS {c}' for c in TYPED)} FROM mad JOIN whole USING (s)),
fence AS (SELECT s, {upper('Total_EMI_per_month')} AS up FROM rules GROUP BY s),
counted AS (SELECT r.* REPLACE (CASE WHEN Total_EMI_per_month > up THEN NULL ELSE Total_EMI_per_month END AS Total_EMI_per_month),
  count(Annual_Income) OVER (PARTITION BY s, g, Monthly_Inhand_Salary, Annual_Income) AS c_ FROM rules r JOIN fence USING (s)),
income AS (SELECT * REPLACE (CASE WHEN Monthly_Inhand_Salary IS NULL THEN Annual_Income ELSE first_value(Annual_Income) OVER (
  PARTITION BY s, g, Monthly_Inhand_Salary ORDER BY Annual_Income IS NULL, c_ DESC, Annual_Income) END AS Annual_Income) FROM counted),
salary AS (SELECT * REPLACE (CASE WHEN Annual_Income IS NULL THEN Monthly_Inhand_Salary
  ELSE {_fill('Monthly_Inhand_Salary', 's, g, Annual_Income')} END AS Monthly_Inhand_Salary) FROM income),
both_known AS (SELECT * REPLACE (CASE WHEN Monthly_Inhand_Salary IS NULL THEN NULL ELSE Annual_Income END AS Annual_Income) FROM salary),
fills AS (SELECT * REPLACE ({', '.join(f'{_fill(c)} AS {c}' for c in filled)}), {_fill('Payment_Behaviour')} AS behaviour,
  row_number() OVER (PARTITION BY s, g ORDER BY m, ID) AS pos FROM both_known),
{_modes('nd', 'Num_of_Delayed_Payment', 'rules')},
{_modes('cc', 'Changed_Credit_Limit', 'rules')},
{_modes('pm', 'Payment_of_Min_Amount', 'rules')},
{_modes('pb', 'Payment_Behaviour', 'rules')},
anchor AS (SELECT s, g, arg_min(Credit_History_Age, (Credit_History_Age, pos)) AS v, arg_min(pos, (Credit_History_Age, pos)) AS p
  FROM fills WHERE Credit_History_Age IS NOT NULL GROUP BY s, g)
SELECT {'f.s AS sample, ' if with_sample else ''}ID, {', '.join(out(c) for c in CLEAN_COLUMNS)}, {', '.join(items)}, Credit_Score
FROM fills f LEFT JOIN nd USING (s, g) LEFT JOIN cc USING (s, g) LEFT JOIN pm USING (s, g) LEFT JOIN pb USING (s, g)
LEFT JOIN anchor USING (s, g)"""


# What the second sample of ``q_credit_samples`` changes, as SQL.
SECOND = ({
    "Total_EMI_per_month": "t.Total_EMI_per_month * 40",
    "Num_Credit_Inquiries": "t.Num_Credit_Inquiries * 9",
    "Monthly_Balance": "CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(7.5 AS DOUBLE) END",
    "Occupation": "CASE WHEN k % 3 = 0 THEN t.Occupation ELSE 'Miner' END",
    "Num_Credit_Card": "t.Num_Credit_Card + CASE WHEN k % 2 = 0 THEN 3 ELSE 0 END",
}, "k % 7 > 0")


# The modelling variant: caps, fills, the median rate and the derived ratio.
MODELLING_SQL = f"""
WITH {TYPED_CTE},
capped AS (SELECT * REPLACE (CASE WHEN Annual_Income > 180000 THEN NULL ELSE Annual_Income END AS Annual_Income,
  CASE WHEN Num_Credit_Card > 11 THEN NULL ELSE Num_Credit_Card END AS Num_Credit_Card,
  CASE WHEN Interest_Rate > 34 THEN NULL ELSE Interest_Rate END AS Interest_Rate) FROM typed),
filled AS (SELECT * REPLACE ({', '.join(f"{_fill(c, 'g')} AS {c}" for c in (
    'Age', 'Occupation', 'Annual_Income', 'Monthly_Inhand_Salary', 'Num_Credit_Card', 'Credit_Mix'))},
  median(Interest_Rate) OVER (PARTITION BY g) AS Interest_Rate) FROM capped)
SELECT ID, g AS Customer_ID, CAST(Age AS INTEGER) AS Age, Occupation, round(Annual_Income, 6) AS Annual_Income,
  round(Monthly_Inhand_Salary, 6) AS Monthly_Inhand_Salary, CAST(Num_Credit_Card AS INTEGER) AS Num_Credit_Card,
  round(Interest_Rate, 6) AS Interest_Rate, Credit_Mix, round(Credit_Utilization_Ratio, 6) AS Credit_Utilization_Ratio,
  round(Total_EMI_per_month / (Monthly_Inhand_Salary + 1), 6) AS EMI_Salary_Ratio, Credit_Score
FROM filled"""

"""Hand-written star fixtures (small rows covering ties, NULLs, gaps, zero totals)."""

import datetime as dt
from decimal import Decimal as D

from saleslens.functions.dates import build_calendar
from saleslens.schemas import CUSTOMERS, PRODUCTS, SALES
from saleslens.sources.adapter import Star


def products(spark, rows):
    """rows: (id, name, brand, category, is_organic, price)"""
    data = [(i, n, b, c, None, org, D(str(p)), None) for i, n, b, c, org, p in rows]
    return spark.createDataFrame(data, PRODUCTS)


def customers(spark, rows):
    """rows: (id, name, type, region)"""
    data = [(i, n, t, r, None, None, True) for i, n, t, r in rows]
    return spark.createDataFrame(data, CUSTOMERS)


def sales(spark, rows):
    """rows: (sale_id, product_id, customer_id, date 'YYYY-MM-DD', qty, total, disc_pct, disc_amt)"""
    data = []
    for r in rows:
        sid, pid, cid, d, q, total = r[:6]
        pct = r[6] if len(r) > 6 else 0
        amt = r[7] if len(r) > 7 else 0
        data.append((sid, pid, cid, dt.date.fromisoformat(d), q, D("1.00"), D(str(pct)),
                     D(str(amt)), D(str(total))))
    return spark.createDataFrame(data, SALES)


def star(spark, prod_rows, cust_rows, sale_rows, cal=("2023-01-01", "2024-12-31")):
    return Star(sales=sales(spark, sale_rows), products=products(spark, prod_rows),
                customers=customers(spark, cust_rows), calendar=build_calendar(spark, *cal))

"""Writes small raw CSV layouts for the tests."""

from __future__ import annotations

import csv
import datetime as dt
import pathlib

ORDER_HEADER = (
    "order_id,customer_id,store_id,city,created_at,status,total_amount,"
    "delivery_minutes,is_late,date"
).split(",")
ITEM_HEADER = "order_item_id,order_id,product_id,qty,unit_price,line_total,date".split(",")
REFERENCES = {
    "products": (
        "product_id,name,category,subcategory,mrp".split(","),
        [
            ["P1", " Milk ", "Dairy", "Milk", "49.99"],
            ["P2", "Rice, long", "Grocery", "Rice", "500"],
        ],
    ),
    "customers": (
        "customer_id,name,phone,city,tier,state,signup_date".split(","),
        [
            ["C1", 'Asha "A"', "1", "Pune", "1", "Maharashtra", "2024-01-01"],
            ["C2", "Ben", "", "Jaipur", "2", "Rajasthan", "2024-06-01"],
        ],
    ),
    "stores": (
        "store_id,city,zone,lat,lon".split(","),
        [["S1", "Pune", "Kothrud", "18.5", "73.8"], ["S2", "Jaipur", "Vaishali", "26.9", "75.7"]],
    ),
}


def _write(path: pathlib.Path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows(rows)


def write_day(base, table, day: dt.date, rows, header=None):
    default = ORDER_HEADER if table == "orders" else ITEM_HEADER
    path = pathlib.Path(base) / table / f"{day:%Y/%m/%d}" / f"{table}.csv"
    _write(path, header or default, rows)


def write_references(base, **override):
    for table, (header, rows) in REFERENCES.items():
        _write(pathlib.Path(base) / table / f"{table}.csv", header, override.get(table, rows))


def order(n, day: dt.date, **values):
    row = {
        "order_id": f"O{day:%d}{n:04d}",
        "customer_id": "C1" if n % 2 else "C2",
        "store_id": "S1" if n % 3 else "S2",
        "city": "Pune" if n % 3 else "Jaipur",
        "created_at": f"{day}T{n % 24:02d}:15:00",
        "status": ("delivered", "delivered", "cancelled", "returned")[n % 4],
        "total_amount": f"{100 + n}.50",
        "delivery_minutes": str(8 + n % 28) if n % 4 < 2 else "",
        "is_late": str(n % 4 < 2 and 8 + n % 28 > 25),
        "date": str(day),
    } | values
    return [row[c] for c in ORDER_HEADER]


def item(n, day: dt.date, **values):
    row = {
        "order_item_id": f"I{day:%d}{n:04d}",
        "order_id": f"O{day:%d}{n:04d}",
        "product_id": "P1" if n % 2 else "P2",
        "qty": str(1 + n % 3),
        "unit_price": "45.25",
        "line_total": f"{45.25 * (1 + n % 3):.2f}",
        "date": str(day),
    } | values
    return [row[c] for c in ITEM_HEADER]


def write_full_day(base, day: dt.date, n: int = 120):
    write_day(base, "orders", day, [order(i, day) for i in range(n)])
    write_day(base, "order_items", day, [item(i, day) for i in range(n)])

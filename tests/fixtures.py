"""A small raw drop (headered CSV) with the dirty cases each batch should exercise."""

from __future__ import annotations

import csv
import os

from ledgerline.contracts import SOURCE_COLUMNS

CUSTOMERS = [
    ["C1", "aung KYAW", "0912345678", "a@x.mm", "yangon", "YANGON REGION", "Kamayut", "vip", "2024-01-01 10:00:00"],
    ["C2", "su su", "0998765432", "s@x.mm", "Mandalay", "Mandalay Region", "Chanmya", "new", "2024-02-01 09:30:00"],
    ["C3", "mg mg", "0911111111", "m@x.mm", "Bago", "Bago Region", "", "returning", "not a time"],
    ["C3", "mg mg old", "0911111111", "m@x.mm", "Bago", "Bago Region", "", "returning", "2023-01-01 00:00:00"],
]
SELLERS = [
    ["S1", "golden SHOP", "YANGON", "yangon region", "business", "4.50", "2023-05-01 00:00:00"],
    ["S2", "taunggyi tea", "Taunggyi", "Shan State", "individual", "x", "2023-06-01 00:00:00"],
]
PRODUCTS = [
    ["P1", "S1", "Longyi", "Fashion", "Shwe", "15000.00", "true", "2023-01-01 00:00:00"],
    ["P2", "S2", "Tea Leaf", "Grocery", "Laphet", "3000.50", "false", "2023-01-01 00:00:00"],
    ["P3", "S1", "Longyi", "Fashion", "Other", "-5.00", "yes", "2023-01-01 00:00:00"],
]


def day1_orders():
    return [
        ["O1", "C1", "2024-03-01 10:00:00", "delivered", "Yangon", "Yangon Region", "kbzpay", "2000.00", "30000.00", "32000.00", "MMK", "2", "3"],
        ["O2", "C2", "2024-03-01 11:00:00", "", "Mandalay", "Mandalay Region", "", "0.00", "3000.50", "3000.50", "MMK", "1", "1"],
        ["O2", "C2", "2024-03-01 11:00:00", "", "Mandalay", "Mandalay Region", "", "0.00", "3000.50", "3000.50", "MMK", "1", "1"],
    ]


def day1_items():
    return [
        ["I1", "O1", "P1", "S1", "1", "2", "15000.00", "30000.00", "0.00", "30000.00"],
        ["I2", "O2", "P2", "S2", "1", "1", "3000.50", "3000.50", "0.00", "3000.50"],
    ]


def day1_payments():
    return [
        ["Y1", "O1", "C1", "kbzpay", "captured", "32000.00", "2024-03-01 10:05:00"],
        ["Y2", "O2", "C2", "cash_on_delivery", "captured", "3000.50", "2024-03-01 11:10:00"],
    ]


def day1_deliveries():
    return [
        ["D1", "O1", "Royal Express", "Yangon Region", "YANGON", "2024-03-03", "2024-03-04", "delivered", "2000.00"],
        ["D2", "O2", "Ninja Van", "Mandalay Region", "Mandalay", "2024-03-04", "2024-03-02", "delivered", "0.00"],
    ]


def day1_inventory():
    return [
        ["V1", "P1", "S1", "2024-03-01", "0", "0", "out_of_stock", "10"],
        ["V2", "P2", "S2", "2024-03-01", "40", "2", "in_stock", "10"],
    ]


def day2_orders():
    return [["O3", "C1", "2024-03-02 09:00:00", "placed", "Yangon", "Yangon Region", "wave", "0.00", "15000.00", "15000.00", "MMK", "1", "1"]]


def day2_items():
    return [["I3", "O3", "P1", "S1", "1", "1", "15000.00", "15000.00", "0.00", "15000.00"]]


def write_csv(path: str, entity: str, rows) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(SOURCE_COLUMNS[entity])
        for r in rows:
            w.writerow(r)


def write_master(raw: str) -> None:
    write_csv(f"{raw}/master/customers.csv", "customers", CUSTOMERS)
    write_csv(f"{raw}/master/sellers.csv", "sellers", SELLERS)
    write_csv(f"{raw}/master/products.csv", "products", PRODUCTS)


def write_day(raw: str, day: str, orders, items, payments=(), deliveries=(), inventory=()) -> None:
    base = f"{raw}/batches/batch_date={day}"
    write_csv(f"{base}/orders.csv", "orders", orders)
    write_csv(f"{base}/order_items.csv", "order_items", items)
    write_csv(f"{base}/payments.csv", "payments", payments)
    write_csv(f"{base}/deliveries.csv", "deliveries", deliveries)
    write_csv(f"{base}/inventory_snapshots.csv", "inventory_snapshots", inventory)


def write_drop(raw: str) -> None:
    write_master(raw)
    write_day(raw, "2024-03-01", day1_orders(), day1_items(), day1_payments(), day1_deliveries(), day1_inventory())
    write_day(raw, "2024-03-02", day2_orders(), day2_items())

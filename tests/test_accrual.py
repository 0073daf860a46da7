"""Accrual against a row-at-a-time model, with the edge rows of the business rules."""

from __future__ import annotations

import math
import random
from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from perkmill.functions import running
from perkmill.operators import accrual, ledger
from perkmill.plans import jobs

RECENT = datetime(2024, 2, 20)
TIERS = [
    {"level_id": 0, "percent_point_collect": D("0.5")},
    {"level_id": 1, "percent_point_collect": D("1.0")},
    {"level_id": 2, "percent_point_collect": D("1.5")},
]


def shop(table, accounts, attrs, suborders, items, bundles=(), company_rules=()):
    """`suborders` are (suborder_id, customer_id, overrides); one order per suborder."""
    subs, orders = [], []
    for sid, customer, extra in suborders:
        subs.append(
            {"suborder_id": sid, "order_id": sid, "status": "complete", "f_point_amount": 0,
             "delivery_timestamp": RECENT, **extra}
        )
        orders.append({"order_id": sid, "customer_id": customer, "status": "complete", "grand_total": D(1)})
    return {
        "account": table("account", accounts),
        "account_attr": table("account_attr", attrs),
        "orders": table("orders", orders),
        "suborder": table("suborder", subs),
        "suborder_item": table("suborder_item", items),
        "suborder_bundle": table("suborder_bundle", list(bundles)),
        "tier_rule": table("tier_rule", TIERS),
        "company": table("company", [{"company_id": "C1"}, {"company_id": "C2"}]),
        "company_tier_rule": table("company_tier_rule", list(company_rules)),
        "ledger": table("ledger", []),
    }


def account(cid, **extra):
    return {
        "customer_id": cid, "email": f"c{cid}@x.test", "fpoint": D("12.9"), "vip_level": 1, "num_freeship": 2,
        "fpoint_accrue_year": 0, "num_rewarded_freeship": 0, **extra,
    }


def company(cid, value=""):
    return {"customer_id": cid, "attribute_id": 178, "value": value}


def item(sid, price, qty=1, product=100, **extra):
    return {"suborder_id": sid, "order_id": sid, "product_id": product, "price": D(price), "qty": qty, **extra}


def amounts(t, p):
    return {r["suborder_id"]: r["amount"] for r in jobs.accrual_judged(t, p).collect()}


def test_amounts(table, params):
    bundle = {"bundle_id": 5, "bundle_type": "combo"}
    t = shop(
        table,
        [account(1)],
        [company(1)],
        [
            (1, 1, {}),
            (2, 1, {"cod_fee": D(10), "shipping_fee": D("5.5"), "discount_amount": D(20), "giftwrap_fee": D(3),
                    "tryout_discount": D(1)}),
            (3, 1, {"discount_amount": D(100)}),
            (4, 1, {"discount_amount": D("99.5")}),
            (5, 1, {"discount_amount": D(200)}),
            (6, 1, {}), (7, 1, {}), (8, 1, {}), (9, 1, {}),
        ],
        [
            item(1, "10.25", 2), item(1, "3.333", 3),
            item(2, "100"), item(2, "50", product=None),  # unknown product: not counted
            item(3, "100"), item(4, "100"), item(5, "100"),
            item(6, "100", 2, **bundle), item(6, "50", **bundle), item(6, "7", bundle_id=6, bundle_type="combo"),
            item(7, "100", **bundle), item(7, "30"),  # saving unknown: the item counts nothing
            item(8, "10", product=72984),  # excluded product only: no suborder
            {**item(9, "1"), "price": None},
        ],
        [
            {"suborder_id": 6, **bundle, "saving": D("0.1"), "qty": 2},
            {"suborder_id": 7, **bundle, "saving": None, "qty": 2},
        ],
    )
    assert amounts(t, params) == {
        1: 30.0, 2: 97.0, 3: 0.0, 4: 0.0, 5: -100.0, 6: 457.0, 7: 30.0, 9: None
    }


def test_repeated_bundle_rows_multiply(table, params):
    """As the row join does: each bundle row counts the items again."""
    key = {"bundle_id": 5, "bundle_type": "combo"}
    t = shop(
        table, [account(1)], [company(1)], [(1, 1, {})],
        [item(1, "100", 2, **key), item(1, "10", 1, **key)],
        [{"suborder_id": 1, **key, "saving": D("0.1"), "qty": 2}, {"suborder_id": 1, **key, "saving": D("0.5"), "qty": 1}],
    )
    from perkmill.operators.pricing import bundle_price

    row_wise = bundle_price(t["suborder_item"], t["suborder_bundle"]).agg(F.sum(F.col("eff_price") * F.col("eff_qty")))
    assert amounts(t, params) == {1: float(row_wise.collect()[0][0])}


def test_who_is_eligible(table, params):
    old, future = datetime(2024, 1, 30, 23, 59, 59), datetime(2024, 1, 31)
    t = shop(
        table,
        [account(1), account(2)],
        [company(1), company(2), {"customer_id": 2, "attribute_id": 16, "value": "x"},
         {"customer_id": 1, "attribute_id": 16, "value": None}],
        [(1, 1, {}), (2, 2, {}), (3, 1, {"parent_id": 1}), (4, 1, {"status": "open"}),
         (5, 1, {"f_point_amount": 5}), (6, 1, {"delivery_timestamp": old}), (7, 1, {"delivery_timestamp": future}),
         (8, None, {}), (9, 1, {"f_point_amount": None})],
        [item(i, "100") for i in range(1, 10)],
    )
    assert set(amounts(t, params)) == {1, 7}


def test_rejects_and_percents(table, params):
    rule = {"company_id": "C1", "level_id": 1, "percent_point_collect": D("3")}
    twice = [{"company_id": "C1", "level_id": 2, "percent_point_collect": D(n)} for n in (5, 6)]
    t = shop(
        table,
        [account(1), account(2, vip_level=2), account(3, vip_level=2), account(4), account(5), account(5),
         account(6), account(7, vip_level=9), account(8, email=None), account(9)],
        [company(1, "C1"), company(2, "C1"), company(3, "C9"), company(5), company(6), company(6), company(7),
         company(8), company(9)],
        [(i, i, {}) for i in range(1, 10)] + [(10, 77, {}), (11, 7, {"discount_amount": D(500)})],
        [item(i, "1000") for i in range(1, 9)] + [{**item(9, "1"), "price": None}, item(10, "5"), item(11, "5")],
        company_rules=[rule, *twice],
    )
    judged = jobs.accrual_judged(t, params)
    reasons = {r["ref_id"]: r["reason"] for r in accrual.reject_rows(judged).collect()}
    assert reasons == {
        4: "no company attribute", 5: "duplicate account", 6: "duplicate company attribute", 7: "no tier rule",
        8: "no email", 9: "no amount", 10: "no account",
    }
    points = {r["suborder_id"]: (r["points"], r["company_code"]) for r in accrual.suborder_points(judged).collect()}
    assert points == {1: (30, "C1"), 2: (15, ""), 3: (15, "")}


def model(account_row, suborders, percent):
    """One customer, suborder by suborder, as the rules tell it."""
    balance = int(account_row["fpoint"])
    ships, year, rewarded = (
        account_row["num_freeship"], account_row["fpoint_accrue_year"], account_row["num_rewarded_freeship"]
    )
    out = []
    for sid, value in sorted(suborders):
        amount = math.floor(float(value))
        if amount <= 0:
            continue
        points = math.floor(amount * percent / 100.0)
        balance, year = balance + points, year + points
        due, grant = year // 10_000, 0
        if due > 0:
            grant = max(0, due - rewarded)
            rewarded = due
        ships += grant
        out.append((sid, points, balance, year, grant, ships, rewarded))
    return out


@pytest.mark.parametrize("split", [False, True])
def test_balances_follow_the_model(table, params, monkeypatch, split):
    rng = random.Random(7)
    accounts, attrs, subs, items, expected = [], [], [], [], []
    sid = 0
    for cid in range(1, 41):
        row = account(
            cid, fpoint=D(str(rng.choice(["12.9", "0", "100.5"]))), vip_level=rng.randrange(3),
            fpoint_accrue_year=rng.choice([0, 9_999, 9_000, 25_000, 30_000]), num_freeship=rng.randrange(4),
            num_rewarded_freeship=rng.choice([0, 1, 2, 3, 5]),
        )
        accounts.append(row)
        attrs.append(company(cid))
        mine = []
        for _ in range(rng.randrange(0, 60 if cid == 1 else 9)):
            sid += rng.randrange(1, 5)
            value = rng.choice(["0", "0.4", "100", "100000", "1000000", "999950", f"{rng.randrange(10**6)}.37"])
            subs.append((sid, cid, {}))
            items.append(item(sid, value))
            mine.append((sid, value))
        percent = [0.5, 1.0, 1.5][row["vip_level"]]
        expected += model(row, mine, percent)
    t = shop(table, accounts, attrs, subs, items)
    if split:
        monkeypatch.setattr(jobs, "hot_keys", lambda df, keys: running.hot_keys(df, keys, 4))
    judged, accrued = jobs.accrual_state(t, params)
    columns = ["suborder_id", "points", "balance_after", "accrue_after", "freeship_grant", "freeship_after", "rewarded_after"]
    assert sorted(map(tuple, accrued.select(columns).collect())) == sorted(expected)

    rows = accrual.accrual_ledger(accrued, params).collect()
    assert sum(r["value"] for r in rows if r["type"] == "fpoint") == sum(e[1] for e in expected)
    assert len(rows) == sum(e[1] > 0 for e in expected) + sum(e[4] > 0 for e in expected)
    assert all(r["amount_after"] - r["amount_before"] == r["value"] for r in rows)

    owner = {sid: cid for sid, cid, _ in subs}
    last = {}
    for e in sorted(expected):
        last[owner[e[0]]] = e
    changes = {r["customer_id"]: r for r in accrual.account_changes(accrued).collect()}
    assert {c: (int(r["set_fpoint"]), r["set_accrue_year"], r["set_freeship"], r["set_rewarded_freeship"])
            for c, r in changes.items()} == {c: (e[2], e[3], e[5], e[6]) for c, e in last.items()}

    stamped = accrual.stamped(t["suborder"], accrual.suborder_stamps(accrual.suborder_points(judged)))
    got = {r["suborder_id"]: r["f_point_amount"] for r in stamped.collect()}
    assert got == {s: dict((e[0], e[1]) for e in expected).get(s, 0) for s, _, _ in subs}


def test_paid_suborders_are_not_paid_again(table, params):
    """By the ledger alone and by the stamps alone; balances stay."""
    t = shop(table, [account(1), account(2)], [company(1), company(2)], [(1, 1, {}), (2, 1, {}), (3, 2, {})],
             [item(1, "500000"), item(2, "90000"), item(3, "7000")])
    first = jobs.run_accrual(t, params)
    after = ledger.apply_changes(t["account"], first.changes)
    assert first.ledger.count() >= 3
    for held in ({"ledger": first.ledger}, {"suborder_stamp": first.tables["suborder_stamp"]}):
        again = jobs.run_accrual({**t, "account": after, **held}, params)
        assert again.ledger.isEmpty() and again.tables["suborder_stamp"].isEmpty()
        assert sorted(ledger.apply_changes(after, again.changes).collect()) == sorted(after.collect())


def test_level_listed_twice_pays_once(table, params):
    t = shop(table, [account(1)], [company(1)], [(1, 1, {})], [item(1, "500000")])
    once = jobs.run_accrual(t, params).ledger.collect()
    t["tier_rule"] = t["tier_rule"].unionAll(t["tier_rule"])
    assert jobs.run_accrual(t, params).ledger.collect() == once

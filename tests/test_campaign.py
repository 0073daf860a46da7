"""Campaign rules against a row-at-a-time model."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from perkmill.functions import running
from perkmill.operators import campaign
from perkmill.plans import jobs

START = datetime(2024, 1, 1)


def base(table, **tables):
    empty = {"account": [], "orders": [], "suborder": [], "suborder_item": [], "suborder_bundle": [], "product": [],
             "campaign": [], "campaign_action": [], "campaign_rule": [], "campaign_rule_filter": [], "ledger": [],
             "tier_rule": [{"level_id": 0, "percent_point_collect": D(1)}]}
    return {name: table(name, tables.get(name, rows)) for name, rows in empty.items()}


def order(oid, customer=1, total="1000", at=datetime(2024, 1, 10), **extra):
    return {"order_id": oid, "customer_id": customer, "customer_email": f"c{customer}@x.test", "status": "complete",
            "grand_total": D(total), "created_at": at, **extra}


def suborder(oid, **extra):
    return {"suborder_id": oid * 10, "order_id": oid, "status": "complete", **extra}


def item(oid, product=1, price="100", qty=1, **extra):
    return {"suborder_id": oid * 10, "order_id": oid, "product_id": product, "price": D(price), "qty": qty, **extra}


def product(pid, sku=None, main="m", mid="d"):
    return {"product_id": pid, "sku": sku or f"s{pid}", "category_main_id": main, "category_mid_id": mid}


def rule(rid, name="promo_fpoint", action="add", value=10, cap=None, ends=datetime(2024, 2, 1), ended=0):
    return (
        {"campaign_id": rid * 100, "from_date": START, "to_date": ends, "end_status": ended},
        {"action_id": rid, "action_name": name, "action": action, "value": value, "max_value": cap},
        {"rule_id": rid, "campaign_id": rid * 100, "action_id": rid},
    )


def rules(*parts):
    return {"campaign": [r[0] for r in parts], "campaign_action": [r[1] for r in parts],
            "campaign_rule": [r[2] for r in parts]}


def limit(rid, kind="grand_total", low=None, high=None, **extra):
    return {"rule_id": rid, "type": kind, "min_value": low, "max_value": high, **extra}


def account(cid, **extra):
    return {"customer_id": cid, "email": f"c{cid}@x.test", "fpoint": D("12.9"), "vip_level": 0, "num_freeship": 1, **extra}


def winners(t, p):
    found = jobs.campaign_winners(t, jobs.campaign_rules(t, p), p).collect()
    return {r["order_id"]: r["rule_id"] for r in found}


def simple(table, orders, filters, parts=None, **more):
    """Each order has one suborder with one item of product 1 unless given."""
    return base(
        table, account=[account(1)], orders=orders, suborder=more.pop("suborder", [suborder(o["order_id"]) for o in orders]),
        suborder_item=more.pop("suborder_item", [item(o["order_id"]) for o in orders]),
        product=more.pop("product", [product(1), product(2)]), campaign_rule_filter=filters,
        **rules(*(parts or [rule(1)])), **more,
    )


def test_bounds_are_inclusive_and_default(table, params):
    orders = [order(1, total="99.99"), order(2, total="100"), order(3, total="200"), order(4, total="200.01"),
              order(5, total="10000000"), order(6, total="10000000.01")]
    assert set(winners(simple(table, orders, [limit(1, low=100, high=200)]), params)) == {2, 3}
    assert set(winners(simple(table, orders, [limit(1)]), params)) == {1, 2, 3, 4, 5}
    items = [item(o["order_id"], qty=o["order_id"]) for o in orders]
    t = simple(table, orders, [limit(1, "num_item", 2, 3), limit(1, low=150)], suborder_item=items)
    assert set(winners(t, params)) == {3}


def test_windows_are_local_and_inclusive(table, params):
    ends = datetime(2024, 2, 1)
    at = [START - timedelta(hours=7, seconds=1), START - timedelta(hours=7), ends - timedelta(hours=7),
          ends - timedelta(hours=7) + timedelta(seconds=1)]
    orders = [order(i, at=t) for i, t in enumerate(at)]
    assert set(winners(simple(table, orders, [limit(1)]), params)) == {1, 2}


def test_which_orders_and_rules_count(table, params):
    orders = [order(1), order(2, status="open"), order(3, total="0"), order(4), order(5), order(6, customer=None),
              order(7), order(8)]
    subs = [suborder(i) for i in (1, 2, 3, 6, 7, 8)] + [suborder(4, status="open"), suborder(5, parent_id=1)]
    t = simple(table, orders, [limit(1)], suborder=subs, ledger=[{"order_id": 7, "campaign_id": 3},
               {"order_id": 8, "campaign_id": 0}, {"order_id": 1}])
    assert set(winners(t, params)) == {1, 8}
    t = simple(table, [order(1)], [limit(1), limit(2), limit(3), limit(4)],
               [rule(1), rule(2, ended=1), rule(3, name="mystery"), rule(4, "promo_freeship", "multiply"), rule(5)])
    assert winners(t, params) == {1: 1}  # 2 ended, 3 and 4 unknown, 5 has no filter
    t = simple(table, [order(1)], [limit(1), limit(2), limit(2, "weekday")], [rule(1), rule(2)])
    assert winners(t, params) == {1: 1}  # unknown filter type matches nothing
    t = simple(table, [order(1)], [limit(1), limit(2, "sku", action="include")], [rule(1), rule(2)])
    assert winners(t, params) == {1: 1}  # item filter without a list matches nothing


def test_item_filters(table, params):
    products = [product(1, "a", "X", "1"), product(2, "b", "Y", "2"), product(3, "c", None, "3"),
                product(4, "1903041244305a"), product(5, "e", mid="4388"), {"product_id": 6, "category_mid_id": "1"}]
    orders = [order(i) for i in range(1, 7)]
    items = [item(i, product=i) for i in range(1, 7)]

    def matched(*filters):
        return set(winners(simple(table, orders, list(filters), product=products, suborder_item=items), params))

    assert matched(limit(1)) == {1, 2, 3}  # 4 to 6: excluded SKU, excluded category, unknown SKU
    assert matched(limit(1, "sku", action="include", value="a, 'b'")) == {1, 2}
    assert matched(limit(1, "sku", action="exclude", value="a")) == {2, 3}
    assert matched(limit(1, "sku", value="a")) == set()  # neither include nor exclude: the rule matches nothing
    assert matched(limit(1, "category_main_id", action="exclude", value="X")) == {2}  # unknown category drops
    assert matched(limit(1, "sku", action="include", value="a,b"), limit(1, "sku", action="include", value="b,c")) == {2}
    assert matched(limit(1, "sku", action="include", value="a"), limit(1, "sku", action="include", value="b")) == set()
    assert matched(limit(1, "sku", action="include", value="a,b"), limit(1, "category_mid_id", action="exclude", value="1")) == {2}


def test_rewards_and_balances(table, params):
    orders = [order(i, total="12345") for i in range(1, 6)] + [order(6, customer=9), order(7, customer=2), order(8, customer=3)]
    parts = [rule(1, "cheapest", value=10, cap=5), rule(2, "highest", value=10), rule(3, "promo_fpoint", "multiply", 3),
             rule(4, "promo_freeship", "add", 2), rule(5, "promo_fpoint", "add", 7), rule(6, "promo_fpoint", "add", 1)]
    pick = [limit(r, "category_main_id", action="include", value=f"r{r}") for r in range(1, 7)]
    items = []
    for oid in range(1, 9):
        pid = min(oid, 6) * 10
        items += [item(oid, pid, "33.3333"), item(oid, pid + 1, "250.5", bundle_id=1, bundle_type="b")]
    products = [product(r * 10 + k, main=f"r{r}") for r in range(1, 7) for k in (0, 1)]
    t = simple(table, orders, pick, parts, suborder_item=items, product=products,
               suborder_bundle=[{"suborder_id": 10, "bundle_id": 1, "bundle_type": "b", "saving": D("0.9"), "qty": 3}])
    t["account"] = table("account", [account(1), account(2), account(2), account(3, vip_level=5)])
    judged, rows = jobs.campaign_state(t, jobs.campaign_rules(t, params), params)
    got = {r["order_id"]: (r["type"], r["value"], r["amount_before"], r["amount_after"]) for r in rows.collect()}
    assert got == {
        5: ("fpoint", 7.0, 12.9, 19.9),
        4: ("freeship", 2.0, 1.0, 3.0),
        3: ("fpoint", 246.0, 19.9, 265.9),
        2: ("fpoint", 25.05, 265.9, 290.95),
        1: ("fpoint", 2.505, 290.95, 293.455),
    }
    assert {r["ref_id"]: r["reason"] for r in campaign.reject_rows(judged).collect()} == {
        6: "no account", 7: "duplicate account", 8: "no tier rule"
    }
    capped = simple(table, [order(1)], [limit(1)], [rule(1, "highest", value=50, cap=20)])
    _, rows = jobs.campaign_state(capped, jobs.campaign_rules(capped, params), params)
    assert [r["value"] for r in rows.collect()] == [20.0]


def test_random_orders_follow_the_model(table, params, monkeypatch):
    rng = random.Random(11)
    products = [product(i, f"s{i}", rng.choice("XYZ"), rng.choice(["1", "2", "3"])) for i in range(1, 20)]
    by_id = {p["product_id"]: p for p in products}
    parts = [rule(r, rng.choice(["promo_fpoint", "cheapest"]), "add", r) for r in range(1, 6)]
    filters = [
        limit(1), limit(2, "num_item", 4, None), limit(2, "category_main_id", action="include", value="X,Y"),
        limit(3, low=300, high=700), limit(3, "category_mid_id", action="exclude", value="2,3"),
        limit(4, "num_item", None, 6), limit(4, "sku", action="include", value="s1,s2,s3,s4,s5"),
        limit(5, "grand_total", 900, None),
    ]
    orders, items, subs, bundles = [], [], [], []
    for oid in range(1, 201):
        orders.append(order(oid, customer=rng.randrange(1, 4) if oid % 2 else 1, total=str(rng.randrange(1000))))
        subs.append(suborder(oid))
        if rng.random() < 0.3:
            bundles.append({"suborder_id": oid * 10, "bundle_id": 1, "bundle_type": "b", "saving": D("0.25"), "qty": 2})
        for _ in range(rng.randrange(5)):
            extra = {"bundle_id": 1, "bundle_type": "b"} if rng.random() < 0.4 else {}
            items.append(item(oid, rng.randrange(1, 20), str(rng.randrange(0, 90)), rng.randrange(1, 4), **extra))
    t = base(table, account=[account(c) for c in (1, 2, 3)], orders=orders, suborder=subs, suborder_item=items,
             suborder_bundle=bundles, product=products, campaign_rule_filter=filters, **rules(*parts))

    sets = {(f["rule_id"], f["type"]): (f.get("action"), set(f["value"].split(","))) for f in filters if f.get("value")}
    in_bundle = {b["suborder_id"] for b in bundles}
    balance, expected = {c: D("12.9") for c in (1, 2, 3)}, {}
    taken = set()
    for r in sorted(range(1, 6), reverse=True):
        terms = parts[r - 1][1]
        for o in sorted(orders, key=lambda o: o["order_id"]):
            if o["grand_total"] <= 0 or o["order_id"] in taken:
                continue
            kept = []
            for i in items:
                if i["order_id"] != o["order_id"] or i["price"] <= 0:
                    continue
                tests = [
                    (by_id[i["product_id"]][k] in sets[r, k][1]) == (sets[r, k][0] == "include")
                    for k in ("sku", "category_main_id", "category_mid_id") if (r, k) in sets
                ]
                if all(tests):
                    on = i.get("bundle_id") and i["suborder_id"] in in_bundle
                    kept.append((i["price"] * (D("0.75") if on else 1), i["qty"] * (2 if on else 1)))
            if not kept:
                continue
            count = sum(q for _, q in kept)
            ok = True
            for f in filters:
                if f["rule_id"] == r and f["type"] in ("grand_total", "num_item"):
                    v = o["grand_total"] if f["type"] == "grand_total" else count
                    ok &= (f["min_value"] or 0) <= v <= (10_000_000 if f["max_value"] is None else f["max_value"])
            if not ok:
                continue
            taken.add(o["order_id"])
            reward = D(r) if terms["action_name"] == "promo_fpoint" else min(p for p, _ in kept) * r / 100
            balance[o["customer_id"]] += reward
            expected[o["order_id"]] = (r, float(reward), float(balance[o["customer_id"]]))

    for least in (None, 5):
        if least:
            monkeypatch.setattr(jobs, "hot_keys", lambda df, keys: running.hot_keys(df, keys, least))
        _, rows = jobs.campaign_state(t, jobs.campaign_rules(t, params), params)
        got = {r["order_id"]: (r["campaign_rule_id"], r["value"], r["amount_after"]) for r in rows.collect()}
        assert got.keys() == expected.keys()
        for oid, value in expected.items():
            assert got[oid] == pytest.approx(value), oid


def test_windows_far_from_the_run(table, params):
    """Open ends, old and future orders: bounds stay exact, and no rule has more intervals than there are
    starts and ends."""
    ages, never = datetime(1970, 1, 1), datetime(9999, 12, 31)
    times = {1: datetime(1980, 5, 5), 2: datetime(1999, 5, 5), 3: datetime(2024, 1, 5), 4: datetime(2024, 4, 5),
             5: datetime(2031, 5, 5), 6: datetime(2031, 5, 7)}
    spans = {1: (ages, never), 2: (datetime(1999, 5, 1), datetime(2024, 1, 1)), 3: (datetime(2031, 5, 6), never),
             4: (datetime(1980, 1, 1), datetime(1980, 5, 5))}
    parts = []
    for rid, (starts, ends) in spans.items():
        window, terms, link = rule(rid, ends=ends)
        parts.append(({**window, "from_date": starts}, terms, link))
    t = simple(table, [order(i, at=at) for i, at in times.items()], [limit(r) for r in spans], parts)
    assert winners(t, params) == {1: 1, 2: 2, 3: 1, 4: 1, 5: 1, 6: 3}
    rows = jobs.campaign_windows(jobs.campaign_rules(t, params), params).rows
    assert rows.count() <= 4 * 7
    assert rows.groupBy("interval").count().agg({"count": "max"}).first()[0] <= 4


def test_long_lists_are_not_copied_per_interval(table, params):
    """A rule of 20,000 SKUs over two years: its intervals carry counts, its values are rows."""
    listed = ",".join(f"s{i}" for i in range(20_000))
    t = simple(table, [order(1), order(2)], [limit(1, "sku", action="include", value=listed)],
               product=[product(1, "s19999", "X", "1"), product(2, "other", "X", "1")],
               suborder_item=[item(1, product=1), item(2, product=2)])
    active = jobs.campaign_rules(t, params)
    windows = jobs.campaign_windows(active, params)
    assert not any("array" in kind for _, kind in windows.rows.dtypes)
    assert jobs.campaign_lists(active).count() == 20_000
    assert winners(t, params) == {1: 1}

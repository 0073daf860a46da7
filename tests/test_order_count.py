from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal as D

import pytest

from perkmill.functions import running
from perkmill.operators import order_count
from perkmill.plans import jobs

NEW = datetime(2024, 1, 1)


def account(cid, **extra):
    return {"customer_id": cid, "email": f"c{cid}@x.test", "fpoint": D("12.9"), "num_freeship": 1, "created_at": NEW,
            "finish_warm_up_period": 0, **extra}


def order(oid, customer, **extra):
    return {"order_id": oid, "customer_id": customer, "customer_email": f"c{customer}@x.test", "status": "complete",
            "grand_total": D(5), "created_at": datetime(2024, 2, 20), **extra}


def done(oid):
    return {"suborder_id": oid, "order_id": oid, "status": "complete"}


def rule(rid, nth, kind="fpoint", value=10, ended=0):
    return {"rule_id": rid, "type": kind, "number_order": nth, "value": value, "end_status": ended}


def shop(table, accounts, orders, rules, ledger=(), suborders=None):
    return {
        "account": table("account", accounts), "orders": table("orders", orders),
        "suborder": table("suborder", suborders or [done(o["order_id"]) for o in orders]),
        "order_count_rule": table("order_count_rule", rules), "ledger": table("ledger", list(ledger)),
    }


def test_which_orders_count(table, params):
    since = params.as_of - timedelta(days=60, hours=7)
    new_from = datetime(2018, 10, 22, 0, 0, 1) - timedelta(hours=7)
    orders = [order(1, 1), order(2, 1, status="open"), order(3, 1, grand_total=D(0)), order(4, 1), order(5, 1),
              order(6, 1, created_at=since), order(7, 1, created_at=since - timedelta(seconds=1)),
              order(8, 2), order(9, 3), order(10, 4), order(11, 5), order(12, None)]
    subs = [done(o["order_id"]) for o in orders if o["order_id"] not in (4, 5)] + [
        done(1), {"suborder_id": 4, "order_id": 4, "status": "open"}]
    accounts = [account(1), account(2, finish_warm_up_period=1), account(3, created_at=new_from),
                account(4, created_at=new_from - timedelta(seconds=1))]
    t = shop(table, accounts, orders, [], suborders=subs)
    found = order_count.new_customer_orders(t["orders"], t["suborder"], t["account"], params)
    assert sorted(r["order_id"] for r in found.collect()) == [1, 6, 9]


def model(orders, held, index, rules):
    """The loop over orders by id; returns rewards and customers who finish."""
    index, rewards, finished = dict(index), set(), set()
    for oid, customer in sorted(orders):
        if (customer, oid) in held:
            continue
        at = index.get(customer, 0)
        if at > 2:
            finished.add(customer)
            continue
        paid = [r for r in rules if r["end_status"] == 0 and r["type"] in ("fpoint", "freeship") and r["number_order"] == at + 1]
        for r in paid:
            rewards.add((oid, customer, at + 1, r["rule_id"]))
        if paid:
            index[customer] = at + 1
    return rewards, finished


@pytest.mark.parametrize("seed", range(6))
def test_random_rules_follow_the_loop(table, params, monkeypatch, seed):
    rng = random.Random(seed)
    rules, rid = [], 0
    for nth in range(0, 5):
        for _ in range(rng.choice([0, 1, 1, 2])):
            rid += 1
            rules.append(rule(rid, nth, rng.choice(["fpoint", "freeship", "fpoint extra"]), rid, rng.choice([0, 0, 0, 1])))
    orders = [(oid, rng.randrange(1, 13)) for oid in range(1, 60)] + [(oid, 1) for oid in range(100, 140)]
    index = {c: rng.randrange(0, 5) for c in range(1, 13) if rng.random() < 0.5}
    held = {(c, o) for o, c in orders if rng.random() < 0.1}
    ledger = [{"customer_id": c, "order_id": -c, "index_order": i, "number_order_rule": 1} for c, i in index.items()]
    ledger += [{"customer_id": c, "index_order": 0} for c in index]
    ledger += [{"customer_id": c, "order_id": o, "number_order_rule": 1} for c, o in held]
    ledger += [{"customer_id": c, "order_id": o, "number_order_rule": None} for o, c in orders[:10]]
    t = shop(table, [account(c) for c in range(1, 13)], [order(o, c) for o, c in orders], rules, ledger)
    if seed % 2:
        monkeypatch.setattr(jobs, "hot_keys", lambda df, keys: running.hot_keys(df, keys, 6))
    result = jobs.run_order_count(t, params)
    rewards, finished = model(orders, held, index, rules)
    rows = result.ledger.collect()
    assert {(r["order_id"], r["customer_id"], r["index_order"], r["number_order_rule"]) for r in rows} == rewards
    changes = {r["customer_id"]: r for r in result.changes.collect()}
    assert {c for c, r in changes.items() if r["set_finish_warm_up"]} == finished
    for c in range(1, 13):
        for kind, column, start in (("fpoint", "add_fpoint", 12.9), ("freeship", "add_freeship", 1.0)):
            mine = sorted((r["index_order"], r["number_order_rule"], r) for r in rows if (r["customer_id"], r["type"]) == (c, kind))
            total = start
            for _, _, r in mine:
                assert r["amount_before"] == pytest.approx(total)
                total += r["value"]
                assert r["amount_after"] == pytest.approx(total)
            added = changes[c][column] if c in changes else None
            assert float(added or 0) == pytest.approx(total - start)

from __future__ import annotations

import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal as D
from pathlib import Path

import pytest

from perkmill.functions import running
from perkmill.functions.lineage import cut
from perkmill.operators import reviews
from perkmill.plans import jobs
from perkmill.plans.daily import run_job
from perkmill.schemas import schema_of
from perkmill.sources.store import Store
from perkmill.sources.tables import parquet_table, write_by_day

START, END = datetime(2024, 1, 1), datetime(2024, 2, 1)


def rule(rid, kind="character", value=100, low=None, high=None, ended=0):
    return {"review_campaign_id": rid, "action_name": f"review_{kind}", "review_type": kind, "value": value,
            "min_value": low, "max_value": high, "from_date": START, "to_date": END, "end_status": ended}


def review(rid, customer=1, product=None, text="x" * 100, at=datetime(2024, 1, 10), status=1):
    return {"review_id": rid, "product_id": rid if product is None else product, "status_id": status,
            "created_at": at, "customer_id": customer, "detail": text}


def like(rid, kind="like", at=datetime(2024, 1, 11)):
    return {"review_id": rid, "type": kind, "created_at": at}


def account(cid, **extra):
    return {"customer_id": cid, "email": f"c{cid}@x.test", "fpoint": D("12.9"), **extra}


def shop(table, rules, review_rows, actions=(), ledger=(), accounts=None, **more):
    return {
        "review_rule": table("review_rule", rules), "review": table("review", review_rows),
        "review_action": table("review_action", list(actions)), "ledger": table("ledger", list(ledger)),
        "account": table("account", accounts or [account(1), account(2)]),
        **{name: table(name, rows) for name, rows in more.items()},
    }


def paid(t, p):
    return {(r["review_campaign_id"], r["review_id"]) for r in jobs.run_reviews(t, p).ledger.collect()}


def test_characters_skip_blanks_and_add_the_buffer(table, spark, params):
    rows = [review(1, text=" \n\r \n"), review(2, text="a b\nc\rd\te"), review(3, text=None), review(4, text="đọc sách")]
    df = table("review", rows).withColumn("chars", reviews.review_chars("detail", params.review_char_buffer))
    assert {r["review_id"]: r["chars"] for r in df.collect()} == {1: 20, 2: 26, 3: None, 4: 27}


def test_bounds_windows_and_states(table, params):
    text = {n: "x" * (n - 20) for n in (99, 100, 200, 201)}
    seven = timedelta(hours=7)
    rows = [review(1, text=text[99]), review(2, text=text[100]), review(3, text=text[200]), review(4, text=text[201]),
            review(5, text=text[100], status=2), review(6, text=text[100], at=START - seven),
            review(7, text=text[100], at=END - seven), review(8, text=text[100], at=END - seven + timedelta(seconds=1)),
            review(9, customer=None), review(10, customer=77)]
    t = shop(table, [rule(1, low=100, high=200), rule(2, ended=1), rule(3, "stars")], rows)
    assert paid(t, params) == {(1, i) for i in (2, 3, 6, 7)}
    # Default bounds: 0 to 10,000.
    t = shop(table, [rule(1)], [review(1, text="x" * 9980), review(2, text="x" * 9981), review(3, text="")])
    assert paid(t, params) == {(1, 1), (1, 3)}


def test_likes_count_inside_the_window_only(table, params):
    actions = [like(1), like(1), like(1, "report"), like(2), like(2, at=datetime(2024, 2, 10)), like(9)]
    t = shop(table, [rule(1, "like", low=2), rule(2, "like", high=1)], [review(1), review(2), review(3)], actions)
    assert paid(t, params) == {(1, 1), (2, 2), (2, 3)}


def test_one_reward_per_customer_product_and_rule(table, params):
    rows = [review(5, product=1), review(3, product=1), review(4, customer=2, product=1), review(6, product=2)]
    held = [{"customer_id": 2, "product_id": 1, "review_campaign_id": 1}, {"customer_id": 1, "product_id": 2}]
    t = shop(table, [rule(1), rule(2, value=50)], rows, ledger=held)
    assert paid(t, params) == {(1, 3), (1, 6), (2, 3), (2, 4), (2, 6)}


@pytest.mark.parametrize("split", [False, True])
def test_running_balance(table, params, monkeypatch, split):
    rng = random.Random(5)
    rows = [review(i, customer=rng.choice([1, 1, 1, 2, 3]), product=i % 17) for i in range(1, 120)]
    t = shop(table, [rule(2, value=10), rule(1, value=7)], rows, accounts=[account(1), account(2), account(3), account(3)])
    if split:
        monkeypatch.setattr(jobs, "hot_keys", lambda df, keys: running.hot_keys(df, keys, 3))
    result = jobs.run_reviews(t, params)
    balance, expected = {1: D("12.9"), 2: D("12.9")}, {}
    for rid, value in ((1, 7), (2, 10)):
        seen = set()
        for r in sorted(rows, key=lambda r: r["review_id"]):
            key = (r["customer_id"], r["product_id"])
            if key in seen or r["customer_id"] == 3:
                continue
            seen.add(key)
            balance[r["customer_id"]] += value
            expected[rid, r["review_id"]] = float(balance[r["customer_id"]])
    assert {(r["review_campaign_id"], r["review_id"]): r["amount_after"] for r in result.ledger.collect()} == expected
    changes = {r["customer_id"]: r["add_fpoint"] for r in result.changes.collect()}
    assert changes == {c: b - D("12.9") for c, b in balance.items()}
    assert {r["reason"] for r in result.rejects.collect()} == {"duplicate account"}


def test_editor_reviews(table, params):
    log = [
        {"review_id": 1, "review": "x" * 100, "author": "c1@x.test", "author_id": 51, "editor_id": 1},
        {"review_id": 2, "review": "x" * 100, "author": "guest@y.test", "author_id": 52, "editor_id": 1},
        {"review_id": 3, "review": "x" * 100, "author": "C1@x.test", "author_id": 53, "editor_id": 2},
        {"review_id": 4, "review": "x", "author": "late@y.test", "author_id": 54, "editor_id": 1},
        {"review_id": 5, "review": "x" * 100, "author": None, "author_id": 55, "editor_id": 1},
        {"review_id": 6, "review": "x" * 100, "author": "guest@y.test", "author_id": 52, "editor_id": 3},
        {"review_id": 7, "review": "x" * 100, "author": "c2@x.test", "author_id": 57, "editor_id": 1},
        {"review_id": 7, "review": "x" * 100, "author": "c1@x.test", "author_id": 56, "editor_id": 1},
        {"review_id": 8, "review": "x" * 100, "author": "both@x.test", "author_id": 58, "editor_id": 1},
    ]
    t = shop(
        table,
        [rule(1, low=100), rule(2, low=110)],
        [review(i, product=i) for i in range(1, 9)],
        ledger=[{"customer_id": 1, "product_id": 1, "review_campaign_id": 2}],
        accounts=[account(1), account(2), account(4, email="both@x.test"), account(3, email="both@x.test")],
        review_editor_log=log,
        review_editor=[{"editor_id": 1, "editor_type": "staff"}, {"editor_id": 2, "editor_type": "partner"}],
        review_reward_log=[{"author_id": 53, "review_id": 3, "status": "not rewarded"}, {"author_id": 52, "review_id": 9}],
    )
    result = jobs.run_editor_reviews(t, params)
    assert {(r["review_campaign_id"], r["review_id"], r["customer_id"], r["product_id"]) for r in result.ledger.collect()} == {
        (1, 1, 1, 1), (1, 7, 1, 7), (2, 7, 1, 7), (1, 8, 3, 8), (2, 8, 3, 8)
    }
    log_rows = {(r["email"], r["author_id"], r["review_id"], r["status"], r["editor_type"])
                for r in result.tables["review_reward_log"].collect()}
    assert log_rows == {
        ("c1@x.test", 51, 1, "rewarded", "staff"), ("c1@x.test", 56, 7, "rewarded", "staff"),
        ("both@x.test", 58, 8, "rewarded", "staff"),
        ("guest@y.test", 52, 2, "not rewarded", "staff"), ("", 55, 5, "not rewarded", "staff"),
    }


def merged(spark, parts, name):
    schema = schema_of(name)
    rows = [tuple(r[n] for n in schema.names) for part in parts for r in part.collect()]
    return spark.createDataFrame(rows, schema)


def counts(df):
    return {(r["review_campaign_id"], r["review_id"]): r["num_like"] for r in df.collect() if r["num_like"]}


def test_likes_are_counted_once_and_day_by_day(spark, table, params, tmp_path):
    """Each day reads the actions since the last, late ones too; the sums equal a full recount, also for a
    rule that's new or whose window was changed. Older days' files aren't opened."""
    rng = random.Random(8)
    day = timedelta(days=1)
    rules = [rule(1, "like"), rule(2, "like"), rule(3, "like"), rule(4)]
    rules[1]["from_date"] = START + 10.5 * day
    at = lambda: START - 2 * day + timedelta(seconds=rng.randint(0, 36 * 86_400))
    actions = [like(rng.randint(1, 20), rng.choice(["like", "like", "report"]), at()) for _ in range(600)]
    arrived = lambda a: a["created_at"] + timedelta(hours=a["review_id"])
    increments, marks, read = [], [], []
    for k, now in enumerate([START + 5 * day, START + 6 * day, START + 20 * day, START + 21 * day, START + 50 * day]):
        if k == 3:  # the third rule begins, the second is changed
            rules[1]["to_date"] = START + 25 * day
        known = [r for r in rules if k >= 3 or r["review_campaign_id"] != 3]
        p = replace(params, as_of=now + timedelta(hours=7))
        root = f"{tmp_path}/{k}"
        write_by_day(table("review_action", [a for a in actions if arrived(a) <= now]), root, "review_action")
        action = parquet_table(spark, root, "review_action", True)
        windows = reviews.like_windows(jobs.review_windows({"review_rule": table("review_rule", known)}, p))
        expected = counts(reviews.review_like_count(action, windows, p))
        if k in (1, 4):  # nothing new but the day's and the late ones
            for folder in Path(root, "review_action").glob("*=2*"):
                if folder.name < f"created_at_day={now - 2 * day if k == 1 else START + 18 * day:%Y-%m-%d}":
                    for file in folder.glob("*.parquet"):
                        file.write_bytes(b"not parquet")
                    read.append(folder)
        held, reached = merged(spark, increments, "review_like"), merged(spark, marks, "review_like_mark")
        total, more, marked = reviews.likes_since(action, windows, held, reached, p)
        assert counts(total) == expected and (expected or not k)
        increments.append(cut(more))
        marks.append(cut(marked))
    assert read and increments[1].count() < 60


def test_store_keeps_likes(spark, table, params, tmp_path):
    """Through the store: the second day pays what a full recount would."""
    rows = [review(i, product=i) for i in range(1, 5)]
    actions = [like(1), like(1), like(2), like(3, at=datetime(2024, 1, 14)), like(3, at=datetime(2024, 1, 15, 20))]
    t = shop(table, [rule(1, "like", low=2)], rows, review_reward_log=[])
    store = Store(spark, str(tmp_path), 2)
    store.start("0", table("account", [{**account(c), "num_freeship": 0} for c in (1, 2)]), t["ledger"])
    given = {k: v for k, v in t.items() if k not in ("ledger", "account")}
    previous, paid = "0", []
    for k, now in enumerate([datetime(2024, 1, 13), datetime(2024, 1, 16), datetime(2024, 1, 17)]):
        seen = [a for a in actions if a["created_at"] < now]
        run_job(store, "review", f"d{k}", previous, given | {"review_action": table("review_action", seen)}, replace(params, as_of=now))
        paid.append(sorted(r["review_id"] for r in store.written("ledger", f"d{k}").collect()))
        previous = f"d{k}"
    assert paid == [[1], [3], []]
    stored = store.before("review_like", "d3").groupBy("review_id").sum("num_like").collect()
    assert {r[0]: r[1] for r in stored} == {1: 2, 2: 1, 3: 1}  # the last like is not settled yet

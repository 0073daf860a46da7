"""Shape of the physical plans."""

from __future__ import annotations

import re
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from perkmill.functions.lineage import cut
from perkmill.functions.localtime import day_of, windows_of
from perkmill.operators import accrual, campaign, order_count, referral, reviews
from perkmill.operators.accounts import states_of
from perkmill.operators.pricing import bundles_of, goods_value, items_of, order_products
from perkmill.plans import jobs
from perkmill.schemas import LEDGER, schema_of
from perkmill.sources.tables import DAYS, parquet_table, write_by_day


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))

    def read(name):
        path = f"{root}/{name}"
        kinds = {"bigint": F.col("id"), "int": F.lit(1), "string": F.lit("1"), "timestamp_ntz": F.lit("2024-02-20").cast("timestamp_ntz")}
        own = {"status": F.lit("complete"), "parent_id": F.lit(None), "f_point_amount": F.lit(0), "finish_warm_up_period": F.lit(0)}
        value = lambda f: own.get(f.name, kinds.get(f.dataType.simpleString(), F.lit(1)))
        columns = [value(f).cast(f.dataType).alias(f.name) for f in schema_of(name)]
        spark.range(5, 10).select(*columns).write.mode("overwrite").parquet(path)
        return spark.read.schema(schema_of(name)).parquet(path)

    return read


def scan(text: str, column: str) -> str:
    return next(line for line in text.splitlines() if "FileScan" in line and column in line)


def test_filters_and_columns_reach_the_scan(stored, table, params):
    line = scan(plan(accrual.recent_suborders(stored("suborder"), params)), "delivery_timestamp")
    for pushed in ("IsNull(parent_id)", "EqualTo(status,complete)", "GreaterThanOrEqual(delivery_timestamp",
                   "EqualTo(f_point_amount,0)"):
        assert pushed in line
    unpaid = accrual.unpaid_suborders(stored("suborder"), stored("orders"), stored("account_attr"), table("ledger", []), None, params)
    assert "ReadSchema: struct<order_id:bigint,customer_id:bigint>" in scan(plan(unpaid), "customer_id:bigint>")
    orders = scan(plan(campaign.complete_orders(stored("orders"))), "grand_total")
    assert "EqualTo(status,complete)" in orders and "GreaterThan(grand_total" in orders
    assert "coupon_code" not in orders.split("ReadSchema")[1]


def test_items_are_looked_up_before_they_fold_or_shuffle(stored):
    """Below the first aggregate or exchange of items lie the id bound and the semi-join."""
    wanted = stored("suborder").select("order_id", "suborder_id")
    item, bundle = items_of(stored("suborder_item"), wanted), bundles_of(stored("suborder_bundle"), wanted)
    for df in (goods_value(item, bundle), order_products(item, bundle)):
        lines = plan(df).splitlines()
        scans = [at for at, line in enumerate(lines) if "FileScan" in line and "price" in line]
        assert scans
        for at in scans:
            assert re.search(r"GreaterThanOrEqual\(\w*order_id,5\), LessThanOrEqual\(\w*order_id,9\)", lines[at])
            # On the way up from the scan: the lines above it that start further left.
            way, left = [], lines[at].index("FileScan")
            for line in reversed(lines[:at]):
                start = re.search(r"[A-Z*]", line).start()
                if start < left:
                    way.append(line)
                    left = start
            assert "LeftSemi" in next(x for x in way if re.search("Aggregate|Exchange|Join", x))


def test_accounts_are_not_sorted_or_folded_whole(stored):
    """Only counts of the wanted customers are aggregated, by hash."""
    account, rows = stored("account"), stored("orders").select("customer_id")
    wanted = rows.distinct()
    own = account.select("customer_id", "email", "fpoint").join(wanted, "customer_id", "left_semi")
    text = plan(own.groupBy("customer_id").count())
    assert "SortAggregate" not in text
    states = states_of(account, rows, ["email", "fpoint"])
    assert states.columns == ["customer_id", "account_rows", "email", "fpoint"]


def test_review_text_is_not_shuffled(stored, params):
    holders = stored("account").select("customer_id").hint("merge")
    lines = plan(reviews.approved_reviews(stored("review"), params).join(holders, "customer_id")).splitlines()
    first = next(at for at, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    assert "length(replace(" in lines[first + 1]
    assert not any("detail" in line for line in lines[:first])


def test_rule_span_reaches_the_scan(spark, stored, table, params):
    rules = table("review_rule", [{"review_campaign_id": 1, "end_status": 0, "from_date": datetime(2024, 1, 1),
                                   "to_date": datetime(2024, 2, 1)}])
    windows = jobs.review_windows({"review_rule": rules}, params)
    inside = reviews.in_rule_windows(reviews.approved_reviews(stored("review"), params), windows, params)
    line = scan(plan(inside), "detail")
    assert "GreaterThanOrEqual(created_at,2023-12-31T17:00)" in line and "LessThanOrEqual(created_at,2024-01-31T17:00" in line


def bound_by_ids(line: str, column: str) -> bool:
    return bool(re.search(rf"GreaterThanOrEqual\(({column}),5\), LessThanOrEqual\(({column}),9\)", line))


@pytest.fixture
def by_job(spark, table, tmp_path):
    """A ledger split by job and run, as the store keeps it."""
    rows = table("ledger", [{"job": j, "order_id": i} for i, j in enumerate([None, "accrual", "campaign", "referral"])])
    rows.write.partitionBy("job").parquet(f"{tmp_path}/run_id=1")
    fields = [f for f in LEDGER if f.name != "job"]
    return spark.read.schema(StructType([*fields, LEDGER["job"]])).parquet(str(tmp_path))


def test_ledger_checks_read_one_jobs_rows_within_the_candidates(stored, by_job, params):
    """The partitions of other jobs are pruned, and ids bound the rest."""
    ids = stored("orders")
    checks = {
        "campaign": campaign.already_campaign_rewarded(ids, by_job, ids),
        "referral": referral.already_referred(ids, by_job),
        "order count": order_count.order_ordinal(ids.select("order_id", "customer_id", "customer_email"), by_job),
        "accrual": accrual.unpaid_suborders(stored("suborder"), ids, stored("account_attr"), by_job, None, params),
    }
    for job, df in checks.items():
        lines = [x for x in plan(df).splitlines() if "FileScan" in x and "PartitionFilters: [" in x and "job#" in x]
        assert lines
        for line in lines:
            filters = line.split("PartitionFilters: [")[1].split("]")[0]
            assert f"= {job})" in filters and "isnull(job" in filters
            assert bound_by_ids(line, "order_id|suborder_id|customer_id")
    reviewed = reviews.not_rewarded(stored("review").withColumn("review_campaign_id", F.lit(1)), by_job)
    assert "job#" in scan(plan(reviewed), "PartitionFilters: [(job") and "IN (review,editor review)" in plan(reviewed)


def test_orders_and_suborders_are_bounded_by_the_candidates(stored, table, params):
    """Of the tables that candidates are joined to, only the range of their ids is read."""
    unpaid = accrual.unpaid_suborders(stored("suborder"), stored("orders"), stored("account_attr"), table("ledger", []), None, params)
    assert bound_by_ids(scan(plan(unpaid), "ReadSchema: struct<order_id:bigint,customer_id:bigint>"), "order_id")
    span = {"from_date": "2024-01-01", "to_date": "2024-03-01"}
    windows = windows_of(table("campaign_rule", [{"rule_id": 1}]).withColumns({k: F.lit(v).cast("timestamp_ntz") for k, v in span.items()}))
    wanted = campaign.wanted_suborders(stored("suborder"), stored("orders"), windows, params, table("ledger", []))
    assert bound_by_ids(scan(plan(wanted), "parent_id"), "order_id")
    new = order_count.new_customer_orders(stored("orders"), stored("suborder"), stored("account"), params)
    assert bound_by_ids(scan(plan(new), "status"), "order_id")


def test_the_ledger_comes_before_items(spark, stored, table, params, monkeypatch):
    """Orders paid by a campaign are dropped before items of any order are looked up."""
    seen = []

    def spy(df, *args):
        seen.append(plan(df))
        return cut(df, *args)

    monkeypatch.setattr(campaign, "cut", spy)
    rules = [{"rule_id": 1, "campaign_id": 1, "action_id": 1}]
    t = {
        "campaign": table("campaign", [{"campaign_id": 1, "from_date": datetime(2024, 1, 1), "to_date": datetime(2024, 2, 25), "end_status": 0}]),
        "campaign_action": table("campaign_action", [{"action_id": 1, "action_name": "cheapest", "value": 1}]),
        "campaign_rule": table("campaign_rule", rules),
        "campaign_rule_filter": table("campaign_rule_filter", [{"rule_id": 1, "type": "grand_total"}]),
        "ledger": table("ledger", []),
        **{n: stored(n) for n in ("suborder_item", "suborder_bundle", "suborder", "orders", "product")},
    }
    winners = jobs.campaign_winners(t, jobs.campaign_rules(t, params), params)
    orders, wanted = seen
    assert "price" not in orders + wanted and "LeftAnti" in wanted
    assert "LeftAnti" not in plan(winners)
    # Items and bundles are read once, and their orders' intervals are known.
    assert plan(winners).count("ReadSchema: struct<suborder_id:bigint,order_id:bigint,product_id:bigint,price") == 1
    assert "local_at" not in plan(winners) and "aggregate(sequence" not in plan(winners)


FACTS = ["orders", "suborder", "review", "review_action"]


def test_days_outside_look_backs_and_rules_are_not_opened(spark, table, params, tmp_path):
    """Facts laid out by day, with files nobody can read outside the span: every job of them runs."""
    root = str(tmp_path)
    at = datetime(2024, 2, 20, 5)
    rows = {
        "orders": [{"order_id": 1, "customer_id": 1, "customer_email": "a@x.test", "status": "complete", "grand_total": Decimal(900),
                    "created_at": at, "coupon_code": "R2"}],
        "suborder": [{"suborder_id": 10, "order_id": 1, "status": "complete", "f_point_amount": 0, "delivery_timestamp": at}],
        "review": [{"review_id": 1, "product_id": 1, "status_id": 1, "created_at": at, "customer_id": 1, "detail": "x" * 200}],
        "review_action": [{"review_id": 1, "type": "like", "created_at": at}],
    }
    t = {}
    for name in FACTS:
        write_by_day(table(name, rows[name]), root, name)
        day = tmp_path / name / f"{day_of(DAYS[name])}=2015-01-01"
        day.mkdir()
        (day / "part-0.parquet").write_bytes(b"not parquet")
        t[name] = parquet_table(spark, root, name, True)
    span = {"from_date": datetime(2024, 2, 1), "to_date": datetime(2024, 2, 25), "end_status": 0}
    account = {"email": "a@x.test", "fpoint": Decimal(0), "vip_level": 0, "num_freeship": 0, "fpoint_accrue_year": 0,
               "num_rewarded_freeship": 0, "created_at": datetime(2024, 1, 1), "finish_warm_up_period": 0, "refer_status": 1, "refer_rule": 1}
    given = {
        "account": [{"customer_id": 1, "refer_code": "R1", **account}, {"customer_id": 2, "refer_code": "R2", **account}],
        "account_attr": [{"customer_id": 1, "attribute_id": 178, "value": ""}],
        "suborder_item": [{"suborder_id": 10, "order_id": 1, "product_id": 1, "price": Decimal(900), "qty": 1}],
        "product": [{"product_id": 1, "sku": "a", "category_main_id": "1", "category_mid_id": "1"}],
        "tier_rule": [{"level_id": 0, "percent_point_collect": Decimal(1), "num_freeship_award": 0, "num_point_begin_level": 0}],
        "campaign": [{"campaign_id": 1, **span}],
        "campaign_action": [{"action_id": 1, "action_name": "promo_fpoint", "action": "add", "value": 5}],
        "campaign_rule": [{"rule_id": 1, "campaign_id": 1, "action_id": 1}],
        "campaign_rule_filter": [{"rule_id": 1, "type": "grand_total", "min_value": 0}],
        "review_rule": [{"review_campaign_id": 1, "action_name": "likes", "review_type": "like", "value": 3, "min_value": 1, **span}],
        "order_count_rule": [{"rule_id": 1, "type": "fpoint", "number_order": 1, "value": 7, "end_status": 0}],
        "refer_rule": [{"refer_rule_id": 1, "action": "add", "value": 9, "status": 1}],
        "suborder_bundle": [], "company": [], "company_tier_rule": [], "ledger": [],
    }
    t |= {name: table(name, r) for name, r in given.items()}
    # Orders of delivered suborders may be of any day: they are bounded by their ids.
    of = {"accrual": t | {"orders": table("orders", rows["orders"])}, "order count": t | {"suborder": table("suborder", rows["suborder"])}}
    of["campaign"] = of["order count"]
    names = ("accrual", "campaign", "review", "order count", "referral")
    paid = {job: [r["value"] for r in jobs.JOBS[job](of.get(job, t), params).ledger.collect()] for job in names}
    assert paid == {"accrual": [9.0], "campaign": [5.0], "review": [3.0], "order count": [7.0], "referral": [9.0]}
    with pytest.raises(Exception, match="not a Parquet file|CANNOT_READ"):
        t["orders"].select(F.max("grand_total")).collect()
    windows = jobs.campaign_windows(jobs.campaign_rules(t, params), params)
    scans = {
        "J1": scan(plan(accrual.recent_suborders(t["suborder"], params)), "delivery_timestamp"),
        "J2": scan(plan(campaign.orders_in_windows(t["orders"], windows, params)), "grand_total"),
        "J6": scan(plan(referral.used_codes(t["orders"], params)), "coupon_code"),
        "J5": scan(plan(order_count.recent_orders(t["orders"], params)), "grand_total"),
    }
    for job, line in scans.items():
        filters = line.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
        assert re.search(r"_day#\d+ >= ", filters), job
        assert (job == "J2") == ("<= 2024-02-24" in filters)


def test_look_back_of_first_orders(stored, params):
    recent = order_count.recent_orders(stored("orders"), params)
    assert "GreaterThanOrEqual(created_at,2024-01-01T02:00)" in scan(plan(recent), "grand_total")

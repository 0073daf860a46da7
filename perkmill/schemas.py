"""Table contracts: what the jobs read and what they write."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(8,4)": T.DecimalType(8, 4),
    "decimal(18,4)": T.DecimalType(18, 4),
    "decimal(28,4)": T.DecimalType(28, 4),
}


def _struct(columns: str) -> T.StructType:
    """Schema from "name type, name type"; needs no running session, unlike `fromDDL`."""
    fields = (column.split(" ") for column in columns.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


# What each job reads, by table name.
INPUTS: dict[str, str] = {
    "account": "customer_id long, email string, fpoint decimal(18,4), vip_level int, num_freeship int, "
    "fpoint_accrue_year int, num_rewarded_freeship int, created_at timestamp_ntz, "
    "finish_warm_up_period int, refer_code string, refer_status int, refer_rule int",
    "account_attr": "customer_id long, attribute_id int, value string",
    "orders": "order_id long, customer_id long, customer_email string, status string, "
    "grand_total decimal(18,4), created_at timestamp_ntz, coupon_code string",
    "suborder": "suborder_id long, order_id long, status string, parent_id long, f_point_amount int, "
    "delivery_timestamp timestamp_ntz, cod_fee decimal(18,4), shipping_fee decimal(18,4), "
    "discount_amount decimal(18,4), giftwrap_fee decimal(18,4), tryout_discount decimal(18,4)",
    "suborder_item": "suborder_id long, order_id long, product_id long, price decimal(18,4), qty int, "
    "bundle_id long, bundle_type string",
    "suborder_bundle": "suborder_id long, bundle_id long, bundle_type string, saving decimal(8,4), qty int",
    "product": "product_id long, sku string, category_main_id string, category_mid_id string",
    "tier_rule": "level_id int, percent_point_collect decimal(8,4), num_freeship_award int, "
    "num_point_begin_level int",
    "company": "company_id string",
    "company_tier_rule": "company_id string, level_id int, percent_point_collect decimal(8,4)",
    "campaign": "campaign_id int, from_date timestamp_ntz, to_date timestamp_ntz, end_status int",
    "campaign_action": "action_id int, action_name string, type string, action string, value int, max_value int",
    "campaign_rule": "rule_id int, campaign_id int, action_id int",
    "campaign_rule_filter": "rule_id int, type string, action string, min_value int, max_value int, value string",
    "review": "review_id long, product_id long, status_id int, created_at timestamp_ntz, customer_id long, detail string",
    "review_action": "review_id long, type string, created_at timestamp_ntz",
    "review_editor_log": "review_id long, review string, author string, author_id long, editor_id long",
    "review_editor": "editor_id long, editor_type string",
    "review_rule": "review_campaign_id int, action_name string, review_type string, value int, min_value int, "
    "max_value int, from_date timestamp_ntz, to_date timestamp_ntz, end_status int",
    "review_reward_log": "email string, customer_id long, author_id long, review_id long, status string, "
    "redeem_code string, created_at string, editor_type string",
    "order_count_rule": "rule_id int, type string, number_order int, value int, end_status int",
    "refer_rule": "refer_rule_id int, action string, value int, status int",
}

LEDGER = _struct(
    "job string, job_key string, customer_id long, account string, action string, type string, "
    "value double, amount_before double, amount_after double, order_id long, suborder_id long, "
    "review_id long, product_id long, campaign_id int, campaign_rule_id int, review_campaign_id int, "
    "number_order_rule int, index_order int, refer_rule_id int, refer_code string, company_code string, "
    "description string, updated_by string, last_updated timestamp_ntz"
)

# At most one row per customer. `add_` columns are increments, `set_` columns replace.
CHANGES = _struct(
    "customer_id long, add_fpoint decimal(28,4), add_freeship long, set_fpoint decimal(28,4), "
    "set_freeship long, set_accrue_year long, set_rewarded_freeship long, set_vip_level int, "
    "set_finish_warm_up int"
)

# One row per run that ended, and one per bucket of accounts that a snapshot wrote.
COMMITS = _struct("run_id string, job string, previous string")
SNAPSHOTS = _struct("run_id string, bucket int, buckets int")

REJECTS = _struct("job string, customer_id long, ref_id long, reason string")

REWARD_LOG = _struct(INPUTS["review_reward_log"])

# What runs write for later runs to read, besides ledger and account.
STORED: dict[str, str] = {
    "suborder_stamp": "order_id long, suborder_id long, f_point_amount int",
    "review_reward_log": INPUTS["review_reward_log"],
    # Likes counted so far per rule, window and review, and up to when.
    "review_like": "review_campaign_id int, from_at timestamp_ntz, until_at timestamp_ntz, review_id long, num_like long",
    "review_like_mark": "review_campaign_id int, from_at timestamp_ntz, until_at timestamp_ntz, upto timestamp_ntz",
}


def schema_of(table: str) -> T.StructType:
    return _struct(INPUTS.get(table) or STORED[table])

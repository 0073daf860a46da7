"""Engine tables projected from the given parquet tables.

The SQL runs unchanged in Spark and in DuckDB; later bindings use earlier ones.
"""

BINDINGS: dict[str, str] = {}

BINDINGS["fx_account"] = """
select c_custkey as customer_id,
       concat('c', cast(c_custkey as string), '@x.test') as email,
       cast(case when c_acctbal < 0 then 0 else c_acctbal end as decimal(18,4)) as fpoint,
       cast(c_custkey % 3 as int) as vip_level,
       cast(c_custkey % 5 as int) as num_freeship,
       cast((c_custkey * 7919) % 60000 as int) as fpoint_accrue_year,
       cast(c_custkey % 4 as int) as num_rewarded_freeship,
       case when c_custkey % 2 = 0 then date '2018-12-01' else date '2017-01-01' end as created_on,
       cast(case when c_custkey % 17 = 0 then 1 else 0 end as int) as finish_warm_up_period,
       concat('REF', cast(c_custkey as string)) as refer_code,
       cast(case when c_custkey % 4 = 0 then 0 else 1 end as int) as refer_status,
       cast(c_custkey % 3 + 1 as int) as refer_rule
from customer
"""

BINDINGS["fx_account_attr"] = """
select c_custkey as customer_id, 178 as attribute_id,
       case when c_mktsegment = 'BUILDING' then 'C1' when c_mktsegment = 'MACHINERY' then 'C2' else '' end as value
from customer where c_custkey % 47 <> 1
union all
select c_custkey, 178, 'C1' from customer where c_custkey % 47 = 2
union all
select c_custkey, 16, 'pending' from customer where c_custkey % 50 = 0
"""

BINDINGS["fx_order"] = """
select o_orderkey as order_id, o_custkey as customer_id,
       concat('c', cast(o_custkey as string), '@x.test') as customer_email,
       case o_orderstatus when 'F' then 'complete' when 'P' then 'processing' else 'open' end as status,
       cast(o_totalprice as decimal(18,2)) as grand_total, o_orderdate as created_at,
       case when o_orderkey % 10 = 0 then concat('REF', cast(o_orderkey % 150 as string)) end as coupon_code
from orders
"""

BINDINGS["fx_suborder_item"] = """
select l_orderkey * 10 + l_linenumber as suborder_id, l_orderkey as order_id, l_partkey as product_id,
       cast(l_extendedprice as decimal(18,2)) as price, cast(l_quantity as int) as qty,
       case when l_partkey % 6 = 0 then l_partkey % 9 end as bundle_id,
       case when l_partkey % 6 = 0 then 'combo' end as bundle_type
from lineitem
"""

BINDINGS["fx_suborder"] = """
select l_orderkey * 10 + l_linenumber as suborder_id, l_orderkey as order_id,
       case when max(l_linestatus) = 'F' then 'complete' else 'open' end as status,
       case when (l_orderkey * 10 + l_linenumber) % 11 = 0 then l_orderkey end as parent_id,
       cast(case when (l_orderkey * 10 + l_linenumber) % 7 = 0 then 5 else 0 end as int) as f_point_amount,
       max(l_shipdate) as delivery_timestamp,
       case when l_orderkey % 2 = 0 then cast(10000 as decimal(18,2)) end as cod_fee,
       case when l_orderkey % 3 = 0 then cast(15000 as decimal(18,2)) end as shipping_fee,
       case when l_orderkey % 5 = 0 then cast(20000 as decimal(18,2)) end as discount_amount,
       case when l_orderkey % 7 = 0 then cast(5000 as decimal(18,2)) end as giftwrap_fee,
       case when l_orderkey % 9 = 0 then cast(3000 as decimal(18,2)) end as tryout_discount
from lineitem group by l_orderkey, l_linenumber
"""

BINDINGS["fx_suborder_bundle"] = """
select distinct suborder_id, bundle_id, bundle_type, cast(0.1 as decimal(8,4)) as saving, 2 as qty
from fx_suborder_item where bundle_id is not null and suborder_id % 13 <> 0
"""

BINDINGS["fx_product"] = """
select p_partkey as product_id, cast(p_partkey as string) as sku,
       p_type as category_main_id, cast(p_size as string) as category_mid_id
from part
"""

BINDINGS["fx_tier_rule"] = """
select * from (values (0, cast(0.5 as decimal(8,4)), 0, 0), (1, cast(1.0 as decimal(8,4)), 2, 30000),
                      (2, cast(1.5 as decimal(8,4)), 5, 50000))
  as t(level_id, percent_point_collect, num_freeship_award, num_point_begin_level)
"""

BINDINGS["fx_company_tier_rule"] = """
select * from (values ('C1', 0, cast(0.7 as decimal(8,4))), ('C1', 1, cast(1.3 as decimal(8,4))))
  as t(company_id, level_id, percent_point_collect)
"""

BINDINGS["fx_campaign_rule"] = """
select * from (values
  (1, 10, 'cheapest',       'add',      10, 500,                date '1995-01-01', date '2001-12-31', 0),
  (2, 10, 'promo_fpoint',   'multiply',  3, cast(null as int),  date '1996-01-01', date '1999-12-31', 0),
  (3, 11, 'promo_freeship', 'add',       2, cast(null as int),  date '1998-01-01', date '2001-12-31', 0),
  (4, 11, 'highest',        'add',       5, 900,                date '1995-01-01', date '2001-12-31', 0),
  (5, 12, 'unknown',        'add',       5, 900,                date '1995-01-01', date '2001-12-31', 0),
  (6, 13, 'cheapest',       'add',      90, cast(null as int),  date '1995-01-01', date '2001-12-31', 1))
  as t(rule_id, campaign_id, action_name, action, value, max_value, from_date, to_date, end_status)
"""

BINDINGS["fx_campaign_rule_filter"] = """
select * from (values
  (1, 'grand_total',      cast(null as string), cast(null as int), cast(null as int), cast(null as string)),
  (2, 'category_mid_id',  'include', cast(null as int), cast(null as int), '1,2,3,4,5,6'),
  (2, 'num_item',         cast(null as string), 10, cast(null as int), cast(null as string)),
  (3, 'category_main_id', 'exclude', cast(null as int), cast(null as int), 'ECONOMY'),
  (3, 'grand_total',      cast(null as string), 300000, 400000, cast(null as string)),
  (4, 'sku',              'include', cast(null as int), cast(null as int), '11,22,33,44,55,66,77,88,99,110,121'),
  (4, 'num_item',         cast(null as string), cast(null as int), 60, cast(null as string)),
  (5, 'grand_total',      cast(null as string), 0, cast(null as int), cast(null as string)),
  (6, 'grand_total',      cast(null as string), 0, cast(null as int), cast(null as string)))
  as t(rule_id, type, action, min_value, max_value, value)
"""

BINDINGS["fx_review"] = """
select d.doc_id as review_id, d.doc_id % 150 as customer_id, d.doc_id % 40 as product_id,
       cast(case when d.doc_id % 9 = 0 then 2 else 1 end as int) as status_id, d.text as detail, e.ts as created_at,
       case when d.doc_id % 12 = 0 then concat('guest', cast(d.doc_id as string), '@y.test')
            else concat('c', cast(d.doc_id % 150 as string), '@x.test') end as author,
       d.doc_id % 150 + 5000 as author_id,
       case when d.source = 'src0' then 'staff' else 'partner' end as editor_type
from documents d join events e on e.event_id = d.doc_id * 5
"""

BINDINGS["fx_review_action"] = """
select event_id % 200 as review_id, case when event_type = 'click' then 'like' else event_type end as type,
       ts as created_at
from events
"""

BINDINGS["fx_review_rule"] = """
select * from (values
  (21, 'review_character', 'character', 700, 300, cast(null as int), date '2024-01-01', date '2024-01-25', 0),
  (22, 'review_like',      'like',      200, 1,   10,                date '2024-01-02', date '2024-02-01', 0),
  (23, 'review_like',      'like',      900, cast(null as int), cast(null as int), date '2024-01-01', date '2024-02-01', 1))
  as t(review_campaign_id, action_name, review_type, value, min_value, max_value, from_date, to_date, end_status)
"""

BINDINGS["fx_order_count_rule"] = """
select * from (values (31, 'fpoint', 1, 5000, 0), (32, 'fpoint', 2, 10000, 0), (33, 'freeship', 2, 1, 0),
                      (34, 'fpoint', 3, 15000, 0), (35, 'fpoint', 4, 99999, 0), (36, 'fpoint', 1, 77777, 1))
  as t(rule_id, type, number_order, value, end_status)
"""

BINDINGS["fx_refer_rule"] = """
select * from (values (1, 'add', 3000, 1), (2, 'percent', 2, 1), (3, 'add', 999, 0))
  as t(refer_rule_id, action, value, status)
"""

BINDINGS["fx_email_list"] = """
select c_custkey as row_no, concat('  C', cast(c_custkey as string), '@X.Test ') as email_raw
from customer where c_custkey % 20 = 0
union all
select c_custkey + 1000000, concat('c', cast(c_custkey as string), '@ x.test') from customer where c_custkey % 40 = 0
union all
select c_custkey + 2000000, concat('nobody', cast(c_custkey as string), '@x.test') from customer where c_custkey % 60 = 0
"""

BINDINGS["fx_prior_ledger"] = """
select customer_id, order_id, cast(10 as int) as campaign_id, cast(null as int) as number_order_rule,
       cast(null as int) as index_order, cast(null as bigint) as product_id, cast(null as int) as review_campaign_id,
       'campaign' as action from fx_order where order_id % 13 = 0
union all
select customer_id, min(order_id), cast(null as int), 31, 1, cast(null as bigint), cast(null as int), 'x order get y reward'
from fx_order where customer_id % 3 = 1 group by customer_id
union all
select customer_id, order_id, cast(null as int), cast(null as int), cast(null as int), cast(null as bigint), cast(null as int),
       'add refer fpoint' from fx_order where order_id % 70 = 0
union all
select customer_id, cast(null as bigint), cast(null as int), cast(null as int), cast(null as int), product_id, 21,
       'review_character' from fx_review where review_id % 31 = 0
"""

BINDINGS["fx_review_reward_log"] = """
select author_id, review_id, 'not rewarded' as status from fx_review where review_id % 24 = 0
"""

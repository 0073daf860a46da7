"""Reference answers in DuckDB SQL, written apart from the Spark operators.

`BLOCKS` are shared subqueries; an answer is its `SELECTS` text with the blocks and bindings it
names put in front.
"""

from __future__ import annotations

from .tables import ALL, with_blocks

BLOCKS: dict[str, str] = {
    # --- base accrual
    "o_items": """
select i.*, b.saving, b.qty as b_qty, b.suborder_id is not null as bundled,
       case when b.suborder_id is null then i.price else (1 - b.saving) * i.price end as eff_price,
       case when b.suborder_id is null then i.qty else b.qty * i.qty end as eff_qty
from fx_suborder_item i
left join fx_suborder_bundle b
  on i.bundle_id = b.bundle_id and i.suborder_id = b.suborder_id and i.bundle_type = b.bundle_type""",
    "o_unpaid": """
select s.*, o.customer_id
from fx_suborder s join fx_order o on s.order_id = o.order_id
where s.parent_id is null and s.status = 'complete' and s.f_point_amount = 0
  and s.delivery_timestamp >= timestamp '2001-08-02' - interval 365 day
  and not exists (select 1 from fx_account_attr a
                  where a.customer_id = o.customer_id and a.attribute_id = 16 and a.value is not null)""",
    "o_amount": """
select s.suborder_id, s.order_id, s.customer_id,
       floor(cast(sum(i.eff_price * i.eff_qty) + coalesce(max(s.cod_fee), 0) + coalesce(max(s.shipping_fee), 0)
             - coalesce(max(s.discount_amount), 0) + coalesce(max(s.giftwrap_fee), 0)
             - coalesce(max(s.tryout_discount), 0) as double)) as amount
from o_unpaid s join o_items i on s.suborder_id = i.suborder_id and s.order_id = i.order_id
where i.product_id not in (3, 5)
group by 1, 2, 3""",
    "o_guard": """
select m.*, (select count(*) from fx_account a join fx_account_attr v
             on a.customer_id = v.customer_id and v.attribute_id = 178
             where a.customer_id = m.customer_id) as guard_rows
from o_amount m""",
    "o_percent": """
select a.customer_id, a.vip_level, v.value as company_id,
       cast(coalesce(r.percent_point_collect, t.percent_point_collect) as double) as percent,
       case when r.company_id is null then '' else v.value end as company_code
from fx_account a
join fx_account_attr v on v.customer_id = a.customer_id and v.attribute_id = 178
left join fx_tier_rule t on t.level_id = a.vip_level
left join fx_company_tier_rule r
  on r.company_id = v.value and r.level_id = a.vip_level and v.value in (select company_id from fx_company)""",
    "o_points": """
select g.suborder_id, g.order_id, g.customer_id, g.amount, c.company_code,
       cast(floor(g.amount * c.percent / 100.0) as bigint) as points
from o_guard g join o_percent c on c.customer_id = g.customer_id
where g.guard_rows = 1 and g.amount > 0""",
    "o_balance": """
select w.*, a.email, a.vip_level, a.num_freeship, a.num_rewarded_freeship,
       cast(trunc(a.fpoint) as bigint) as start_points, a.fpoint_accrue_year as start_year
from (select *, sum(points) over (partition by customer_id order by suborder_id) as earned,
             row_number() over (partition by customer_id order by suborder_id) as rn from o_points) w
join fx_account a on a.customer_id = w.customer_id""",
    "o_milestone": """
select *, case when fl > 0 then greatest(0, fl - prev_rewarded) else 0 end as freeship_grant,
       case when fl > 0 then fl else prev_rewarded end as rewarded_after
from (select *, case when rn > 1 and fl_prev > 0 then fl_prev else num_rewarded_freeship end as prev_rewarded
      from (select *, cast(floor((start_year + earned) / 10000.0) as bigint) as fl,
                   cast(floor((start_year + earned - points) / 10000.0) as bigint) as fl_prev
            from o_balance) f) g""",
    "o_accrued": """
select *, start_points + earned as balance_after, start_year + earned as accrue_after,
       num_freeship + sum(freeship_grant) over (partition by customer_id order by suborder_id) as freeship_after
from o_milestone""",
    # --- campaigns
    "o_sales": """
select i.order_id, i.suborder_id, i.product_id, i.price, i.qty, i.eff_price, i.eff_qty,
       o.customer_id, o.customer_email, o.grand_total, o.created_at + interval 7 hour as local_at
from o_items i
join fx_suborder s on s.order_id = i.order_id and s.suborder_id = i.suborder_id
join fx_order o on o.order_id = i.order_id
where o.status = 'complete' and s.status = 'complete' and s.parent_id is null
  and i.price > 0 and o.customer_id is not null and o.grand_total > 0""",
    "o_sold": """
select s.*, p.sku, p.category_main_id, p.category_mid_id
from o_sales s join fx_product p on p.product_id = s.product_id
where p.sku not in ('7', '8') and p.category_mid_id not in ('49', '50')""",
    "o_rules": """
select rule_id, campaign_id, action_name, action, value, coalesce(max_value, 10000000) as cap,
       cast(from_date as timestamp) as from_at, cast(to_date as timestamp) as to_at
from fx_campaign_rule r
where end_status = 0 and exists (select 1 from fx_campaign_rule_filter f where f.rule_id = r.rule_id)""",
    "o_rule_items": """
select r.rule_id, s.*
from o_sold s join o_rules r on s.local_at between r.from_at and r.to_at
where not exists (
  select 1 from fx_campaign_rule_filter f
  where f.rule_id = r.rule_id and f.value is not null
    and f.type in ('sku', 'category_main_id', 'category_mid_id')
    and not coalesce((f.action = 'include') = list_contains(string_split(f.value, ','),
        case f.type when 'sku' then s.sku when 'category_main_id' then s.category_main_id
             else s.category_mid_id end), false))""",
    "o_rule_orders": """
select rule_id, order_id, customer_id, customer_email, grand_total, sum(eff_qty) as qty,
       min(eff_price) as min_price, max(eff_price) as max_price
from o_rule_items group by 1, 2, 3, 4, 5""",
    "o_matched": """
select m.* from o_rule_orders m
where not exists (
  select 1 from fx_campaign_rule_filter f
  where f.rule_id = m.rule_id
    and not (f.type in ('sku', 'category_main_id', 'category_mid_id') and f.value is not null)
    and not case f.type
      when 'grand_total' then m.grand_total between coalesce(f.min_value, 0) and coalesce(f.max_value, 10000000)
      when 'num_item' then m.qty between coalesce(f.min_value, 0) and coalesce(f.max_value, 10000000)
      else false end)""",
    "o_unrewarded": """
select * from o_matched m
where not exists (select 1 from fx_prior_ledger l where l.order_id = m.order_id and l.campaign_id > 0)""",
    "o_winners": """
select m.*, r.campaign_id, r.action_name, r.action, r.value, r.cap
from o_unrewarded m join o_rules r on r.rule_id = m.rule_id
where r.action_name in ('cheapest', 'highest', 'promo_fpoint')
   or (r.action_name = 'promo_freeship' and r.action = 'add')
qualify r.rule_id = max(r.rule_id) over (partition by m.order_id)""",
    "o_rewards": """
select w.*, a.fpoint, a.num_freeship,
       case when action_name = 'promo_freeship' then 'freeship' else 'fpoint' end as reward_type,
       cast(case action_name
         when 'cheapest' then least(round(cast(min_price as decimal(20,6)) * w.value * 0.01, 4), cap)
         when 'highest' then least(round(cast(max_price as decimal(20,6)) * w.value * 0.01, 4), cap)
         when 'promo_fpoint' then case when w.action = 'add' then w.value else
           cast(floor(cast(grand_total as double) * cast(t.percent_point_collect as double) / 100.0) as bigint)
           * (w.value - 1) end
         else w.value end as decimal(28,4)) as reward
from o_winners w
join fx_account a on a.customer_id = w.customer_id
join fx_tier_rule t on t.level_id = a.vip_level""",
    "o_campaign_ledger": """
select *, sum(reward) over (partition by customer_id, reward_type order by rule_id desc, order_id) as paid,
       case when reward_type = 'freeship' then num_freeship else fpoint end as start_value
from o_rewards""",
    # --- reviews
    "o_review_rules": """
select review_campaign_id, action_name, review_type, value, coalesce(min_value, 0) as lo,
       coalesce(max_value, 10000) as hi, cast(from_date as timestamp) as from_at, cast(to_date as timestamp) as to_at
from fx_review_rule where end_status = 0""",
    "o_chars": """
select review_id, length(replace(replace(replace(detail, ' ', ''), e'\\n', ''), e'\\r', '')) + 20 as chars
from fx_review""",
    "o_likes": """
select r.review_campaign_id, a.review_id, count(*) as num_like
from fx_review_action a join o_review_rules r on a.created_at + interval 7 hour between r.from_at and r.to_at
where a.type = 'like' group by 1, 2""",
    "o_review_hits": """
select r.*, v.review_id, v.product_id, v.customer_id, v.author, v.author_id, v.editor_type, c.chars,
       coalesce(l.num_like, 0) as num_like
from fx_review v
join o_chars c on c.review_id = v.review_id
join o_review_rules r on v.created_at + interval 7 hour between r.from_at and r.to_at
left join o_likes l on l.review_campaign_id = r.review_campaign_id and l.review_id = v.review_id
where v.status_id = 1""",
    "o_window_reviews": """
select * from o_review_hits h where h.customer_id in (select customer_id from fx_account)""",
    "o_review_match": """
select * from o_window_reviews
where case review_type when 'character' then chars between lo and hi
      when 'like' then num_like between lo and hi else false end""",
    "o_review_first": """
select * from o_review_match m
where not exists (select 1 from fx_prior_ledger l where l.customer_id = m.customer_id
                  and l.product_id = m.product_id and l.review_campaign_id = m.review_campaign_id)
qualify row_number() over (partition by customer_id, product_id, review_campaign_id order by review_id) = 1""",
    "o_review_paid": """
select f.*, a.email, a.fpoint,
       sum(f.value) over (partition by f.customer_id order by f.review_campaign_id, f.review_id) as paid
from o_review_first f join fx_account a on a.customer_id = f.customer_id""",
    "o_editor_match": """
select h.* exclude (customer_id), a.customer_id, a.email, a.fpoint
from o_review_hits h left join fx_account a on a.email = h.author
where case review_type when 'character' then chars between lo and hi
      when 'like' then num_like between lo and hi else false end""",
    "o_editor_paid": """
select *, sum(value) over (partition by customer_id order by review_campaign_id, review_id) as paid
from (select * from o_editor_match m
      where customer_id is not null
        and not exists (select 1 from fx_prior_ledger l where l.customer_id = m.customer_id
                        and l.product_id = m.product_id and l.review_campaign_id = m.review_campaign_id)
      qualify row_number() over (partition by customer_id, product_id, review_campaign_id order by review_id) = 1) f""",
    # --- first orders
    "o_new_orders": """
select o.order_id, o.customer_id, o.customer_email
from fx_order o join fx_account a on a.customer_id = o.customer_id
where o.status = 'complete' and o.grand_total > 0 and a.created_on >= date '2018-10-22'
  and a.finish_warm_up_period = 0
  and o.created_at + interval 7 hour >= timestamp '2001-08-02' - interval 3650 day
  and exists (select 1 from fx_suborder s where s.order_id = o.order_id and s.status = 'complete')""",
    "o_ordinals": """
select u.*, start_index + row_number() over (partition by customer_id order by order_id) as ordinal
from (select n.*, coalesce((select max(index_order) from fx_prior_ledger l where l.customer_id = n.customer_id), 0)
             as start_index
      from o_new_orders n
      where not exists (select 1 from fx_prior_ledger l where l.customer_id = n.customer_id
                        and l.order_id = n.order_id and l.number_order_rule > 0)) u""",
    "o_count_rules": """
select * from fx_order_count_rule where end_status = 0 and type in ('fpoint', 'freeship')""",
    "o_count_rewards": """
select o.*, r.rule_id, r.type, r.value
from o_ordinals o join o_count_rules r on r.number_order = o.ordinal
where o.ordinal <= 3
  and (select count(distinct x.number_order) from o_count_rules x
       where x.number_order > o.start_index and x.number_order <= o.ordinal) = o.ordinal - o.start_index""",
    "o_stall_rewards": """
select o.*, r.rule_id, r.type, r.value
from o_ordinals o join o_count_rules r on r.number_order = o.ordinal
where o.ordinal <= 3 and r.number_order <> 2
  and (select count(distinct x.number_order) from o_count_rules x
       where x.number_order > o.start_index and x.number_order <= o.ordinal and x.number_order <> 2)
      = o.ordinal - o.start_index""",
    "o_count_ledger": """
select c.*, case when c.type = 'freeship' then a.num_freeship else a.fpoint end as start_value,
       sum(c.value) over (partition by c.customer_id, c.type order by c.ordinal, c.rule_id) as paid
from o_count_rewards c join fx_account a on a.customer_id = c.customer_id""",
    "o_finished": """
select distinct customer_id from o_ordinals o
where ordinal > 3
  and (start_index >= 3
       or (select count(distinct x.number_order) from o_count_rules x
           where x.number_order > o.start_index and x.number_order <= 3) = 3 - o.start_index)""",
    # --- referrals
    "o_referred": """
select o.order_id, a.customer_id, a.email, a.fpoint, o.coupon_code as refer_code, o.grand_total,
       a.refer_rule, r.action, r.value
from fx_order o
join fx_account a on a.refer_code = o.coupon_code and a.refer_status = 1
join fx_refer_rule r on r.refer_rule_id = a.refer_rule and r.status = 1
where o.status = 'complete' and o.customer_id is not null
  and o.created_at >= timestamp '2001-08-02' - interval 3650 day
qualify row_number() over (partition by o.order_id order by a.customer_id) = 1""",
    "o_refer_unpaid": """
select *, cast(case when action = 'add' then value
               else round(cast(grand_total as decimal(20,6)) * value * 0.01, 4) end as decimal(28,4)) as reward
from o_referred r
where not exists (select 1 from fx_prior_ledger l where l.order_id = r.order_id and l.action = 'add refer fpoint')""",
    "o_refer_ledger": """
select *, sum(reward) over (partition by customer_id order by order_id) as paid from o_refer_unpaid""",
    # --- tiers and list
    "o_levels": """
select *, case when fpoint_accrue_year < (select num_point_begin_level from fx_tier_rule where level_id = 2)
          then 1 else 2 end as new_level
from fx_account where fpoint_accrue_year >= 30000""",
    "o_upgrades": """
select l.*, t.num_freeship_award as award, l.num_freeship + t.num_freeship_award as new_freeship
from o_levels l join fx_tier_rule t on t.level_id = l.new_level
where l.new_level > l.vip_level""",
    "o_owed": """
select *, fpoint_accrue_year // 10000 as reached, fpoint_accrue_year // 10000 - num_rewarded_freeship as owed
from fx_account
where fpoint_accrue_year // 10000 > 0 and fpoint_accrue_year // 10000 > num_rewarded_freeship""",
    "o_entries": """
select row_no, lower(replace(email_raw, ' ', '')) as email from fx_email_list where email_raw like '%@%'""",
    "o_grants": """
select e.row_no, e.email, a.customer_id, a.num_freeship,
       row_number() over (partition by a.customer_id order by e.row_no) as nth
from o_entries e join fx_account a on lower(a.email) = e.email
where a.customer_id = (select min(b.customer_id) from fx_account b where lower(b.email) = e.email)""",
}


def _ledger(action: str, kind: str, value: str, before: str, after: str, account: str = "email") -> str:
    return (
        f"cast(customer_id as bigint) as customer_id, {account} as account, {action} as action, {kind} as type, "
        f"cast({value} as double) as value, cast({before} as double) as amount_before, "
        f"cast({after} as double) as amount_after"
    )


def _b(*names: str) -> str:
    return ", ".join(f"cast({n} as bigint) as {n}" for n in names)


def _snapshot(joins: str = "", **after: str) -> str:
    columns = []
    for name in ("fpoint", "num_freeship", "fpoint_accrue_year", "num_rewarded_freeship", "vip_level", "finish_warm_up_period"):
        kind = "double" if name == "fpoint" else "bigint"
        columns.append(f"cast({after.get(name, 'a.' + name)} as {kind}) as {name}")
    return f"select a.customer_id, a.email, {', '.join(columns)} from fx_account a {joins}"


_REVIEW_DESC = (
    "concat('review rule ', review_campaign_id, ', review ', review_id, "
    "case review_type when 'like' then concat(', likes ', num_like) else concat(', characters ', chars) end)"
)
_REFER_ROWS = _ledger("'add refer fpoint'", "'fpoint'", "reward", "fpoint + paid - reward", "fpoint + paid")


def _reward(action: str) -> str:
    return (
        f"select {_b('order_id', 'customer_id', 'rule_id')}, reward_type, cast(reward as double) as reward "
        f"from o_rewards where action_name = '{action}'"
    )


SELECTS: dict[str, str] = {
    "eligible_suborders": f"""
select {_b('suborder_id', 'order_id', 'customer_id')} from o_unpaid u
where exists (select 1 from fx_suborder_item i where i.suborder_id = u.suborder_id and i.order_id = u.order_id
              and i.product_id not in (3, 5))""",
    "bundle_price": f"""
select {_b('suborder_id', 'order_id', 'product_id', 'bundle_id')}, cast(eff_price as double) as eff_price,
       {_b('eff_qty')} from o_items""",
    "suborder_amount": f"select {_b('suborder_id', 'order_id', 'customer_id')}, amount from o_amount",
    "account_unique_guard": f"""
select {_b('suborder_id', 'customer_id')}, amount, {_b('guard_rows')},
       case when guard_rows = 1 then 'ok' else 'reject' end as verdict from o_guard""",
    "tier_percent": """
select a.customer_id, cast(a.vip_level as bigint) as vip_level,
       (select cast(t.percent_point_collect as double) from fx_tier_rule t where t.level_id = a.vip_level) as percent
from fx_account a""",
    "company_tier_percent": f"""
select {_b('customer_id', 'vip_level')}, company_id, percent, company_code from o_percent
where customer_id in (select customer_id from fx_account_attr where attribute_id = 178
                      group by customer_id having count(*) = 1)""",
    "suborder_points": f"select {_b('suborder_id', 'customer_id')}, amount, company_code, points from o_points",
    "running_point_balance": f"""
select {_b('suborder_id', 'customer_id', 'points')}, cast(start_points + earned - points as bigint) as balance_before,
       cast(start_points + earned as bigint) as balance_after, cast(start_year + earned as bigint) as accrue_after
from o_balance""",
    "freeship_milestone": f"""
select {_b('suborder_id', 'customer_id', 'accrue_after', 'freeship_grant', 'freeship_after', 'rewarded_after')}
from o_accrued""",
    "accrual_ledger": f"""
select {_ledger("'accure fpoint'", "'fpoint'", "points", "balance_after - points", "balance_after")},
       {_b('order_id', 'suborder_id')}, company_code,
       concat('points for delivered suborder, amount ', cast(amount as bigint), ', level ', vip_level,
              case when company_code <> '' then concat(', company ', company_code) else '' end) as description
from o_accrued where points > 0
union all
select {_ledger("'add more freeship'", "'freeship'", "freeship_grant", "freeship_after - freeship_grant", "freeship_after")},
       {_b('order_id', 'suborder_id')}, company_code,
       concat('free shipping per milestone, year points ', cast(accrue_after as bigint),
              ', rewarded before ', cast(prev_rewarded as bigint)) as description
from o_accrued where freeship_grant > 0""",
    "suborder_stamp": """
select s.suborder_id, s.order_id, s.status, cast(coalesce(p.points, s.f_point_amount) as bigint) as f_point_amount
from fx_suborder s left join o_points p on p.suborder_id = s.suborder_id""",
    "active_campaign_rules": """
select cast(r.rule_id as bigint) as rule_id, cast(r.campaign_id as bigint) as campaign_id, r.action_name, r.action,
       cast(r.value as bigint) as value, cast(r.cap as bigint) as max_value, f.type as filter_type,
       f.action as filter_action, cast(f.min_value as bigint) as filter_min, cast(f.max_value as bigint) as filter_max,
       f.value as filter_value,
       (select count(*) from fx_order o where o.created_at + interval 7 hour between r.from_at and r.to_at)
         as orders_in_window
from o_rules r join fx_campaign_rule_filter f on f.rule_id = r.rule_id""",
    "campaign_items": """
select cast(r.rule_id as bigint) as rule_id, s.order_id, s.suborder_id, s.product_id,
       cast(s.price as double) as price, cast(s.qty as bigint) as qty, s.customer_id,
       cast(s.grand_total as double) as grand_total
from o_sales s join o_rules r on s.local_at between r.from_at and r.to_at""",
    "global_item_exclusions": """
select order_id, suborder_id, product_id, sku, category_main_id, category_mid_id from o_sold""",
    "rule_item_filter": f"select {_b('rule_id', 'order_id', 'suborder_id', 'product_id')} from o_rule_items",
    "campaign_order_agg": f"""
select {_b('rule_id', 'order_id', 'qty')}, cast(min_price as double) as min_price,
       cast(max_price as double) as max_price from o_rule_orders""",
    "rule_order_match": f"""
select {_b('rule_id', 'order_id', 'qty')}, cast(grand_total as double) as grand_total from o_matched""",
    "already_campaign_rewarded": f"""
select {_b('rule_id', 'order_id', 'qty')}, cast(grand_total as double) as grand_total from o_unrewarded""",
    "one_campaign_per_order": f"select {_b('order_id', 'rule_id', 'customer_id')}, action_name from o_winners",
    "reward_cheapest_pct": _reward("cheapest"),
    "reward_highest_pct": _reward("highest"),
    "reward_promo_points": _reward("promo_fpoint"),
    "reward_promo_freeship": _reward("promo_freeship"),
    "campaign_ledger": f"""
select {_ledger('action_name', 'reward_type', 'reward', 'start_value + paid - reward', 'start_value + paid', 'customer_email')},
       {_b('order_id', 'campaign_id')}, cast(rule_id as bigint) as campaign_rule_id,
       concat('campaign ', campaign_id, ' rule ', rule_id, ', items ', cast(qty as bigint)) as description
from o_campaign_ledger""",
    "active_review_rules": """
select cast(review_campaign_id as bigint) as review_campaign_id, action_name, review_type,
       cast(value as bigint) as value, cast(lo as bigint) as min_value, cast(hi as bigint) as max_value,
       (select count(*) from fx_review v where v.status_id = 1
          and v.created_at + interval 7 hour between r.from_at and r.to_at) as reviews_in_window
from o_review_rules r""",
    "review_char_count": f"select {_b('review_id', 'chars')} from o_chars",
    "review_like_count": f"select {_b('review_campaign_id', 'review_id', 'num_like')} from o_window_reviews",
    "reviews_in_window": f"""
select {_b('review_campaign_id', 'review_id', 'customer_id', 'product_id', 'chars')} from o_window_reviews""",
    "review_rule_match": f"""
select {_b('review_campaign_id', 'review_id', 'customer_id', 'product_id')} from o_review_match""",
    "review_dedup": f"""
select {_b('review_campaign_id', 'review_id', 'customer_id', 'product_id')} from o_review_first""",
    "review_ledger": f"""
select {_ledger('action_name', "'fpoint'", 'value', 'fpoint + paid - value', 'fpoint + paid')},
       {_b('review_id', 'product_id', 'review_campaign_id')}, {_REVIEW_DESC} as description from o_review_paid""",
    "editor_reviews": """
select v.review_id, v.product_id, v.author, v.author_id, a.customer_id, v.editor_type, cast(c.chars as bigint) as chars
from fx_review v join o_chars c on c.review_id = v.review_id left join fx_account a on a.email = v.author
where v.status_id = 1""",
    "editor_review_rewards": f"""
select {_ledger('action_name', "'fpoint'", 'value', 'fpoint + paid - value', 'fpoint + paid')},
       {_b('review_id', 'product_id', 'review_campaign_id', 'author_id')}, 'rewarded' as status, editor_type
from o_editor_paid""",
    "guest_review_outbox": """
select distinct author as email, author_id, review_id, 'not rewarded' as status, editor_type
from o_editor_match m
where customer_id is null
  and not exists (select 1 from fx_review_reward_log l where l.author_id = m.author_id and l.review_id = m.review_id)""",
    "new_customer_orders": "select order_id, customer_id from o_new_orders",
    "order_ordinal": f"select {_b('order_id', 'customer_id', 'start_index', 'ordinal')} from o_ordinals",
    "order_count_rewards": f"""
select {_b('order_id', 'customer_id', 'start_index', 'ordinal', 'rule_id')}, type, {_b('value')} from o_count_rewards""",
    "order_count_rewards_stalled": f"""
select {_b('order_id', 'customer_id', 'start_index', 'ordinal', 'rule_id')}, type, {_b('value')} from o_stall_rewards""",
    "order_count_ledger": f"""
select {_ledger("'x order get y reward'", 'type', 'value', 'start_value + paid - value', 'start_value + paid', 'customer_email')},
       {_b('order_id')}, cast(rule_id as bigint) as number_order_rule, cast(ordinal as bigint) as index_order,
       concat('order number ', ordinal, ' of a new customer, order ', order_id) as description
from o_count_ledger""",
    "finish_warm_up": "select customer_id from o_finished",
    "referral_orders": f"""
select {_b('order_id', 'customer_id')}, refer_code, {_b('refer_rule')}, action as refer_action,
       cast(value as bigint) as refer_value, cast(grand_total as double) as grand_total from o_referred""",
    "already_referred": f"select {_b('order_id', 'customer_id')}, refer_code from o_refer_unpaid",
    "referral_reward": f"""
select {_b('order_id', 'customer_id', 'refer_rule')}, cast(reward as double) as reward from o_refer_unpaid""",
    "referral_ledger": f"""
select {_REFER_ROWS}, {_b('order_id')}, cast(refer_rule as bigint) as refer_rule_id, refer_code,
       concat('order ', order_id, ' used refer code ', refer_code) as description from o_refer_ledger""",
    "tier_classify": f"select {_b('customer_id', 'fpoint_accrue_year', 'vip_level', 'new_level')} from o_levels",
    "tier_upgrade": f"select {_b('customer_id', 'vip_level', 'new_level', 'award', 'new_freeship')} from o_upgrades",
    "tier_upgrade_ledger": f"""
select {_ledger("'upgrade level'", "'vip level'", 'new_level - vip_level', 'vip_level', 'new_level')},
       concat('level upgrade, year points ', fpoint_accrue_year) as description from o_upgrades
union all
select {_ledger("'add more freeship'", "'freeship'", 'award', 'num_freeship', 'new_freeship')},
       concat('free shipping for level upgrade, year points ', fpoint_accrue_year) as description from o_upgrades""",
    "freeship_backfill": f"""
select {_ledger("'add more freeship'", "'freeship'", 'owed', 'num_freeship', 'num_freeship + owed')},
       {_b('reached')}, concat('free shipping owed, year points ', fpoint_accrue_year) as description from o_owed""",
    "email_list_ingest": "select row_no, email from o_entries",
    "email_list_grant": """
select email, nth, customer_id, cast(num_freeship + nth - 1 as bigint) as freeship_before,
       cast(num_freeship + nth as bigint) as freeship_after from o_grants""",
    "apply_ledger": _snapshot(
        """left join (select customer_id, sum(points) as points, sum(freeship_grant) as grants,
                             max_by(rewarded_after, suborder_id) as rewarded
                      from o_accrued group by customer_id) d on d.customer_id = a.customer_id""",
        fpoint="case when d.customer_id is null then cast(a.fpoint as double) else cast(trunc(a.fpoint) + d.points as double) end",
        num_freeship="a.num_freeship + coalesce(d.grants, 0)",
        fpoint_accrue_year="a.fpoint_accrue_year + coalesce(d.points, 0)",
        num_rewarded_freeship="coalesce(d.rewarded, a.num_rewarded_freeship)",
    ),
    "apply_ledger_campaign": _snapshot(
        fpoint="a.fpoint + coalesce((select sum(reward) from o_rewards r where r.customer_id = a.customer_id "
        "and r.reward_type = 'fpoint'), 0)",
        num_freeship="a.num_freeship + coalesce((select sum(reward) from o_rewards r "
        "where r.customer_id = a.customer_id and r.reward_type = 'freeship'), 0)",
    ),
    "apply_ledger_order_count": _snapshot(
        fpoint="a.fpoint + coalesce((select sum(value) from o_count_rewards r where r.customer_id = a.customer_id "
        "and r.type = 'fpoint'), 0)",
        num_freeship="a.num_freeship + coalesce((select sum(value) from o_count_rewards r "
        "where r.customer_id = a.customer_id and r.type = 'freeship'), 0)",
        finish_warm_up_period="case when a.customer_id in (select customer_id from o_finished) then 1 "
        "else a.finish_warm_up_period end",
    ),
    "apply_ledger_referral": _snapshot(
        fpoint="a.fpoint + coalesce((select sum(reward) from o_refer_unpaid r where r.customer_id = a.customer_id), 0)",
    ),
    "apply_ledger_review": _snapshot(
        fpoint="a.fpoint + coalesce((select sum(value) from o_review_first r where r.customer_id = a.customer_id), 0)",
    ),
    "apply_ledger_tier_upgrade": _snapshot(
        "left join o_upgrades u on u.customer_id = a.customer_id",
        vip_level="coalesce(u.new_level, a.vip_level)",
        num_freeship="coalesce(u.new_freeship, a.num_freeship)",
    ),
    "apply_ledger_backfill": _snapshot(
        "left join o_owed u on u.customer_id = a.customer_id",
        num_freeship="a.num_freeship + coalesce(u.owed, 0)",
        num_rewarded_freeship="coalesce(u.reached, a.num_rewarded_freeship)",
    ),
    "apply_ledger_email_list": _snapshot(
        num_freeship="a.num_freeship + (select count(*) from o_grants g where g.customer_id = a.customer_id)",
    ),
    "ledger_append": f"""
select {_REFER_ROWS}, {_b('order_id')}, 'referral' as job, cast(order_id as varchar) as job_key from o_refer_ledger""",
    "local_window": """
select o.order_id, cast(o.created_at + interval 7 hour as varchar) as local_at,
       cast(o.created_at >= timestamp '2001-08-02' - interval 365 day as bigint) as since_midnight,
       cast(o.created_at + interval 7 hour >= timestamp '2001-08-02 15:30:00' - interval 365 day as bigint)
         as since_instant,
       (select count(*) from fx_campaign_rule r
        where o.created_at + interval 7 hour between cast(r.from_date as timestamp) and cast(r.to_date as timestamp))
         as rules_open
from fx_order o""",
    "reject_report": f"""
select 'accrual' as job, {_b('customer_id')}, cast(suborder_id as bigint) as ref_id,
       case when guard_rows = 0 then 'no company attribute' else 'duplicate company attribute' end as reason
from o_guard where guard_rows <> 1
union all
select 'campaign', cast(customer_id as bigint), cast(order_id as bigint), 'no tier rule' from o_winners w
where not exists (select 1 from fx_account a join fx_tier_rule t on t.level_id = a.vip_level
                  where a.customer_id = w.customer_id)""",
}

# A second run over the same tables pays nothing.
SELECTS["accrual_paid_once"] = SELECTS["accrual_ledger"]
SELECTS["apply_ledger_twice"] = SELECTS["apply_ledger"]


def oracle_sql() -> dict[str, str]:
    return {name: with_blocks(sql, ALL | BLOCKS) for name, sql in SELECTS.items()}

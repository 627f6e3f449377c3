"""DuckDB oracle texts for the registered queries.

Every text runs against the driver's base tables only, so the staging-shaped
fixtures (FIXTURES.md) are inlined as CTEs.  The texts are phrased
independently of the Spark plans (e.g. window de-dup here vs. grouped
de-dup in Spark; filtered distinct counts here vs. the per-customer
pre-aggregation in Spark).
"""

from __future__ import annotations

# --- staging-shaped fixture views -------------------------------------------

FX_ORDERS = """fx_orders as (
  select l_orderkey*1000000000000 + cast(l_linenumber as bigint)*100000000000
         + l_partkey*100000 + l_suppkey as id,
    c_nationkey as city_id, n_name as city_name, o_custkey as customer_id,
    o_orderdate as date_time,
    split_part(c_name,'#',1) as first_name, split_part(c_name,'#',2) as last_name,
    cast(l_partkey as integer) as item_id, p_name as item_name,
    cast(l_quantity as bigint) as quantity,
    cast(l_extendedprice as decimal(14,2)) as payment_amount,
    case when l_returnflag='R' then 'refunded' else 'shipped' end as status,
    p_type as category_name
  from lineitem join orders on l_orderkey=o_orderkey
    join customer on o_custkey=c_custkey join nation on c_nationkey=n_nationkey
    join part on l_partkey=p_partkey)"""

USER_ORDERS_LOG = """user_orders_log as (
  select city_id, city_name, customer_id, date_time, first_name, id, item_id,
         item_name, last_name, quantity, payment_amount, status
  from fx_orders
  union all
  select city_id, city_name, customer_id, date_time, first_name,
         id+1000000000000000000 as id, item_id, item_name, last_name, quantity,
         payment_amount, 'refunded' as status
  from fx_orders where customer_id % 10 = 0)"""

USER_ACTIVITY_LOG = """user_activity_log as (
  select case event_type when 'view' then 1 when 'click' then 2 when 'signup' then 3
                         when 'purchase' then 4 else 5 end::bigint as action_id,
    user_id as customer_id, cast(cast(ts as date) as timestamp) as date_time,
    event_id as id, cast(floor(value) as bigint) as quantity
  from events)"""

ACTIVITY_WITH_COPIES = """activity_with_copies as (
  select * from user_activity_log
  union all
  select action_id, customer_id, date_time, id + 1000000000 as id, quantity
  from user_activity_log where action_id = 4)"""

CUSTOMER_RESEARCH = """customer_research as (
  select cast(strftime(date_time, '%Y%m%d') as bigint)*100000 + category_id*100 + geo_id as id,
         date_time, category_id, geo_id, sales_qty, sales_amt
  from (select date_time, cast(item_id % 50 as integer) as category_id, city_id as geo_id,
               cast(sum(quantity) as integer) as sales_qty,
               cast(sum(payment_amount) as decimal(14,2)) as sales_amt
        from fx_orders group by 1, 2, 3) g)"""

RESEARCH_WITH_COPIES = """research_with_copies as (
  select * from customer_research
  union all
  select id + 10000000000000 as id, date_time, category_id, geo_id, sales_qty, sales_amt
  from customer_research where category_id < 5)"""

ITEM_CATEGORIES = """item_categories as (
  select cast(p_partkey as integer) as item_id, p_type as category_name from part)"""

# C1 over the orders staging input.  Price: exact HALF_UP of amount/quantity
# computed in integer cents (DuckDB's decimal/bigint division is DOUBLE).
F_DAILY_SALES_FROM = """f_daily_sales as (
  select distinct cast(date_time as date) as date_time, item_id,
    cast(customer_id as integer) as customer_id,
    cast(sign(sa) * ((2*abs(cast(sa*100 as bigint)) + quantity) // (2*quantity)) / 100.0
         as decimal(10,2)) as price,
    quantity, cast(sa as decimal(10,2)) as payment_amount, status
  from (select *, case when status = 'refunded' and payment_amount > 0
                       then -payment_amount else payment_amount end as sa
        from {src}) s)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "with " + ",\n".join(ctes) + "\n" + body


ORDERS_CTES = (FX_ORDERS, USER_ORDERS_LOG)
SALES_CTES = ORDERS_CTES + (F_DAILY_SALES_FROM.format(src="user_orders_log"),)

# D4 over the orders staging input: latest item name by (date_time, id),
# category from the part mapping.
D_ITEM = """d_item as (
  select n.item_id, n.item_name, c.category_name
  from (select item_id, item_name,
               row_number() over (partition by item_id
                                  order by date_time desc nulls last, id desc nulls last) as rn
        from user_orders_log where item_id is not null) n
  left join item_categories c on n.item_id = c.item_id
  where n.rn = 1)"""


def sales_cte(name: str, src: str) -> str:
    """C1 over any staging-shaped CTE ``src`` as CTE ``name``."""
    return F_DAILY_SALES_FROM.replace("f_daily_sales as (", f"{name} as (", 1).format(src=src)


def retention_ctes(sales: str, prefix: str = "") -> tuple[str, ...]:
    """Retention over the sales CTE ``sales``, from its definitions (SURVEY
    §2.15): a customer's cohort is the week of the earliest sale that is not
    refunded; every measure is one filtered count or sum over the distinct
    sales.  Defines ``<prefix>cohorts``, ``<prefix>sold`` and
    ``<prefix>retention``; needs a ``d_item`` CTE."""
    p = prefix
    week = "cast(year({0}) as varchar) || cast(week({0}) as varchar)"
    return (
        f"""{p}cohorts as (
  select customer_id, min(date_time) as first_buy, {week.format('min(date_time)')} as cohort
  from {sales} where status <> 'refunded' and customer_id is not null group by customer_id)""",
        f"""{p}sold as (
  select distinct {week.format('s.date_time')} as period_id, s.date_time, s.customer_id, s.item_id,
    d_item.category_name, s.payment_amount, s.status, c.cohort,
    coalesce(c.cohort = {week.format('s.date_time')}, false) as is_new
  from {sales} s left join d_item using (item_id) left join {p}cohorts c using (customer_id))""",
        f"""{p}retention as (
  select 'weekly' as period_name, period_id, category_name, cohort,
    count(distinct customer_id) filter (where status = 'shipped' and is_new)::integer as new_customers_count,
    count(distinct customer_id) filter (where status = 'shipped' and not is_new)::integer as returning_customers_count,
    count(distinct customer_id) filter (where status = 'refunded')::integer as refunded_customers_count,
    coalesce(sum(payment_amount) filter (where status = 'shipped' and is_new), 0)::decimal(14,2) as new_customers_revenue,
    coalesce(sum(payment_amount) filter (where status = 'shipped' and not is_new), 0)::decimal(14,2)
      as returning_customers_revenue,
    coalesce(sum(payment_amount) filter (where status = 'refunded'), 0)::decimal(14,2) as refunded_customers_sum,
    count(*) filter (where status = 'refunded')::integer as customers_refunded
  from {p}sold group by period_id, category_name, cohort)""",
    )


def latest_cte(name: str, src: str, key: str, attrs: list[str], key_type: str) -> str:
    """Latest attributes per key by (date_time, id), window form."""
    a = ", ".join(attrs)
    return f"""{name} as (
  select cast({key} as {key_type}) as {key}, {a}
  from (select {key}, {a}, row_number() over (partition by {key}
                 order by date_time desc nulls last, id desc nulls last) as rn
        from {src}) t
  where rn = 1)"""


D_CALENDAR = """d_calendar as (
  select d as date_time, cast(day(d) as smallint) as day_num,
         cast(month(d) as smallint) as month_num, monthname(d) as month_name,
         cast(year(d) as smallint) as year_num
  from (select cast(date_time as date) as d from user_orders_log
        union
        select cast(date_time as date) from user_activity_log) days
  where d is not null)"""

F_ACTIVITY = """f_activity as (
  select cast(action_id as integer) as activity_id, cast(date_time as date) as date_time,
         cast(sum(quantity) as integer) as click_number
  from user_activity_log
  where action_id is not null and date_time is not null
  group by 1, 2)"""

ORDER_COLS = ("city_id, city_name, customer_id, date_time, first_name, id, item_id, "
              "item_name, last_name, quantity, payment_amount")
ORDER_COLS_NO_ID = ORDER_COLS.replace(" id,", "")

"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each text starts from the raw driver tables; ``SALES`` maps them onto sales
lines exactly like ``sources.sales.sales_from_tables``. The SQL is written
the direct way (range joins, ROW_NUMBER, correlated EXISTS) so it checks the
Spark plans rather than repeating them.
"""

from __future__ import annotations

import datetime as dt

from tillsight import constants as K
from tillsight.plans import params as P

SALES = """sales as (
select concat_ws('-', cast(l.l_orderkey as varchar), cast(l.l_linenumber as varchar),
                 cast(l.l_partkey as varchar), cast(l.l_suppkey as varchar),
                 cast(cast(l.l_shipdate as date) as varchar))                     as source_row_id,
       concat(p.p_type, cast(p.p_size as varchar))                                as product_code,
       p.p_name                                                                   as product_name,
       l.l_returnflag                                                             as unit_name,
       cast(cast(l.l_quantity as decimal(6,0)) * cast(p.p_retailprice as decimal(10,2)) as decimal(18,4)) as import_amount,
       cast(cast(l.l_quantity as decimal(6,0)) * cast(l.l_discount as decimal(4,2)) as decimal(18,4))     as promo_quantity,
       cast(l.l_quantity as decimal(18,4))                                        as sales_quantity,
       cast(l.l_extendedprice as decimal(18,4))                                   as export_amount,
       cast(cast(l.l_extendedprice as decimal(12,2)) * (1 - cast(l.l_discount as decimal(4,2))) as decimal(18,4)) as revenue,
       cast(l.l_shipdate as date)                                                 as sale_date,
       c.c_name                                                                   as customer_name,
       o.o_orderpriority                                                          as segment_name,
       cast(cast(l.l_extendedprice as decimal(12,2)) * (1 - cast(l.l_discount as decimal(4,2)))
            - cast(l.l_quantity as decimal(6,0)) * cast(p.p_retailprice as decimal(10,2)) as decimal(18,4)) as profit,
       cast(l.l_discount as decimal(18,8))                                        as promo_pct,
       case when cast(l.l_shipdate as date) < date '1998-07-01' then 'batch_a' else 'batch_b' end as load_batch_id
from lineitem l
join orders   o on l.l_orderkey = o.o_orderkey
join customer c on o.o_custkey  = c.c_custkey
join part     p on l.l_partkey  = p.p_partkey
)"""


def _d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def snaps_cte(dates, name: str = "snaps") -> str:
    rows = ", ".join(f"({_d(x)})" for x in sorted(dates))
    return f"{name}(snapshot_date) as (values {rows})"


def features_ctes(dates, lookback: int = P.LOOKBACK, trend_mode: str = "zero_fill",
                  name: str = "features") -> str:
    """CTEs ``snaps``, ``win``, ``seg`` and ``<name>``: one row per snapshot and customer."""
    if trend_mode == "zero_fill":
        trend = ("cast(sum(case when w.sale_date > w.snapshot_date - 30 then w.revenue else 0 end)"
                 " - sum(case when w.sale_date <= w.snapshot_date - 30 and w.sale_date > w.snapshot_date - 60"
                 " then w.revenue else 0 end) as double)")
    else:
        trend = ("case when count(case when w.sale_date > w.snapshot_date - 30 then 1 end) > 0"
                 " and count(case when w.sale_date <= w.snapshot_date - 30 and w.sale_date > w.snapshot_date - 60"
                 " then 1 end) > 0 then"
                 " cast(sum(case when w.sale_date > w.snapshot_date - 30 then w.revenue else 0 end)"
                 " - sum(case when w.sale_date <= w.snapshot_date - 30 and w.sale_date > w.snapshot_date - 60"
                 " then w.revenue else 0 end) as double) else 0.0 end")
    return f"""{snaps_cte(dates)},
win as (
  select s.snapshot_date, x.*
  from sales x join snaps s
    on x.sale_date > s.snapshot_date - {lookback} and x.sale_date <= s.snapshot_date
  where x.customer_name is not null
),
seg as (
  select snapshot_date, customer_name, segment_name as segment,
         row_number() over (partition by snapshot_date, customer_name
                            order by sale_date desc, source_row_id desc) as rn
  from win
),
{name}_agg as (
  select w.snapshot_date, w.customer_name,
         cast(date_diff('day', max(w.sale_date), w.snapshot_date) as integer) as recency,
         count(*) as frequency,
         cast(sum(w.revenue) as double) / count(*) as aov,
         cast(sum(coalesce(w.promo_pct, 0)) as double) / count(*) as promo_rate,
         coalesce(cast(sum(w.profit) as double) / nullif(cast(sum(w.revenue) as double), 0), 0.0) as margin,
         {trend} as trend,
         cast(date_diff('day', min(w.sale_date), w.snapshot_date) as integer) as days_since_first,
         count(distinct strftime(w.sale_date, '%Y-%m')) as active_months
  from win w
  group by w.snapshot_date, w.customer_name
),
{name} as (
  select a.snapshot_date, a.customer_name, s.segment, a.recency, a.frequency, a.aov, a.promo_rate,
         a.margin, a.trend, a.days_since_first, a.active_months
  from {name}_agg a
  left join seg s on s.snapshot_date = a.snapshot_date and s.customer_name = a.customer_name and s.rn = 1
)"""


def labels_cte(src: str = "features", name: str = "labeled") -> str:
    """``<name>``: ``src`` plus churn_label via a correlated EXISTS per row."""
    return f"""{name} as (
  select f.*,
         case when exists (
           select 1 from sales x
           where x.customer_name = f.customer_name
             and x.sale_date >= f.snapshot_date + 1
             and x.sale_date <= last_day(f.snapshot_date + 1)
         ) then 0 else 1 end as churn_label
  from {src} f
)"""



def dbl(x: float) -> str:
    """A double literal parsed from its shortest text (exact in both engines)."""
    return f"cast('{float(x)!r}' as double)"


def half_even_div(num: str, den: str, scale: int) -> str:
    """num / den rounded half-even to ``scale`` decimals, exactly, for decimal(18,4) inputs."""
    n = f"(cast({num} * 10000 as hugeint) * {10 ** scale})"
    b = f"cast({den} * 10000 as hugeint)"
    q = f"({n} // {b})"
    r = f"({n} % {b})"
    adj = (f"case when 2 * abs({r}) > abs({b}) or (2 * abs({r}) = abs({b}) and abs({q}) % 2 = 1)"
           f" then sign({n}) * sign({b}) else 0 end")
    return (f"case when {b} = 0 then 0.0 else cast({q} + {adj} as double) / {float(10 ** scale)!r} end")


def category_case(col: str = "product_code") -> str:
    prefix = f"regexp_extract(trim({col}), '^(\\p{{L}}+)', 1)"
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in P.TEST_CATEGORY_MAP.items())
    return f"coalesce(case {prefix} {whens} end, '{K.DEFAULT_CATEGORY}')"


CLEANED = f"""cleaned as (
  select s.*,
         cast(year(sale_date) as integer) as year_number,
         cast(month(sale_date) as integer) as month_number,
         {category_case()} as category_name,
         {half_even_div('profit', 'revenue', 4)} as margin_pct,
         {half_even_div('revenue', 'sales_quantity', 0)} as revenue_per_unit
  from sales s
),
staged as (
  select *, load_batch_id || '.parquet' as source_file_name from cleaned
)"""

RELOAD = f"""reload as (
  select * replace (cast(revenue + 1 as decimal(18,4)) as revenue, 'batch_c' as load_batch_id,
                    'batch_c.parquet' as source_file_name)
  from staged where load_batch_id = 'batch_a' and sale_date >= {_d(P.RELOAD_FROM)}
),
staged_all as (select * from staged union all select * from reload)"""


def _cust_cand(batch: str, name: str, where: str = "") -> str:
    return f"""{name}_g as (
  select customer_name, segment_name, min(sale_date) as f, max(sale_date) as l
  from staged where load_batch_id = '{batch}' {where} and customer_name is not null group by 1, 2
),
{name} as (
  select customer_name, segment_name as current_segment, f, l from (
    select *, row_number() over (partition by customer_name order by l desc, segment_name desc nulls last) as rn
    from {name}_g) where rn = 1
)"""


DIMC = f"""{_cust_cand('batch_a', 'cand_a')},
{_cust_cand('batch_b', 'cand_b')},
dimc as (
  select coalesce(a.customer_name, b.customer_name) as customer_name,
         case when b.customer_name is not null then b.current_segment else a.current_segment end as current_segment,
         case when a.customer_name is null then b.f when b.customer_name is null then a.f else least(a.f, b.f) end
           as first_purchase_date,
         case when a.customer_name is null then b.l when b.customer_name is null then a.l else greatest(a.l, b.l) end
           as last_purchase_date
  from cand_a a full outer join cand_b b on a.customer_name = b.customer_name
)"""


def _prod_cand(batch: str, name: str) -> str:
    return f"""{name} as (
  select product_code, product_name, unit_name, category_name from (
    select *, row_number() over (partition by product_code order by n desc, l desc,
             product_name desc nulls last, unit_name desc nulls last, category_name desc nulls last) as rn
    from (select product_code, product_name, unit_name, category_name, count(*) as n, max(sale_date) as l
          from staged where load_batch_id = '{batch}' and product_code is not null group by 1, 2, 3, 4)
  ) where rn = 1
)"""


DIMP = f"""{_prod_cand('batch_a', 'pcand_a')},
{_prod_cand('batch_b', 'pcand_b')},
dimp as (
  select * from pcand_b
  union all
  select * from pcand_a where product_code not in (select product_code from pcand_b)
)"""

FACT = """fact as (
  select 'ExcelDataModel' as source_system, s.source_row_id, s.load_batch_id,
         cast(strftime(s.sale_date, '%Y%m%d') as integer) as date_key, s.customer_name, s.product_code,
         s.segment_name as segment_at_sale, s.revenue, s.profit, s.promo_pct
  from staged s
  join dimc c on c.customer_name = s.customer_name
  join dimp p on p.product_code = s.product_code
)"""

UPSERT = f"""src as (
  select source_row_id, load_batch_id, revenue, profit from staged where load_batch_id = 'batch_b'
  union all select source_row_id, load_batch_id, revenue, profit from reload
  union all select source_row_id, load_batch_id, revenue, profit from staged
            where load_batch_id = 'batch_a' and sale_date >= {_d(P.RELOAD_FROM)}
),
src1 as (
  select source_row_id, load_batch_id, revenue, profit from (
    select *, row_number() over (partition by source_row_id order by load_batch_id desc) as rn from src)
  where rn = 1
),
upserted as (
  select * from src1
  union all
  select source_row_id, load_batch_id, revenue, profit from staged
  where load_batch_id = 'batch_a' and source_row_id not in (select source_row_id from src1)
)"""


def pseudo(a: int = 37, b: int = 11) -> str:
    return P.pseudo_prob_sql().replace("* 37", f"* {a}").replace("* 11", f"* {b}")


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- cleaning

def q_clean_sales() -> str:
    return _with(SALES, CLEANED) + """select source_row_id, product_code, category_name, sale_date, year_number,
  month_number, cast(revenue as double) as revenue, cast(profit as double) as profit,
  cast(sales_quantity as double) as sales_quantity, margin_pct, revenue_per_unit from cleaned"""


def q_category() -> str:
    return _with(SALES, CLEANED) + "select product_code, category_name, count(*) as lines from cleaned group by 1, 2"


def q_kpis() -> str:
    return _with(SALES, CLEANED) + """select cast(sum(revenue) as double) as total_revenue,
  cast(sum(profit) as double) as total_profit,
  coalesce(cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0), 0.0) as margin,
  count(*) as order_lines, count(distinct customer_name) as customers, count(distinct product_name) as products,
  coalesce(cast(sum(revenue) as double) / nullif(cast(count(*) as double), 0), 0.0) as aov,
  count(case when profit < 0 then 1 end) as negative_profit_lines
from cleaned"""


def q_row_hash() -> str:
    from tillsight.plans.fixtures import HASH_COLUMNS
    parts = ", ".join(f"coalesce(cast({c} as varchar), '')" for c in HASH_COLUMNS)
    return _with(SALES) + f"select source_row_id, sha256(concat_ws('|', {parts})) as row_hash from sales"


def q_row_changes() -> str:
    from tillsight.plans.fixtures import CHANGE_COLUMNS
    same = " and ".join(f"o.{c} is not distinct from n.{c}" for c in CHANGE_COLUMNS)
    return _with(SALES, CLEANED, f"""old as (select * from staged where load_batch_id = 'batch_a'),
new as (
  select * replace (case when sale_date >= {_d(P.RELOAD_FROM)} then cast(revenue + 1 as decimal(18,4))
                         else revenue end as revenue)
  from staged where load_batch_id = 'batch_a' and sale_date >= date '1998-03-01'
  union all select * from staged where load_batch_id = 'batch_b'
)""") + f"""select coalesce(o.source_row_id, n.source_row_id) as source_row_id,
  case when o.source_row_id is null then 'new' when n.source_row_id is null then 'gone'
       when {same} then 'same' else 'changed' end as change_status
from old o full outer join new n on o.source_row_id = n.source_row_id"""


# --------------------------------------------------------------- warehouse

def q_dim_date() -> str:
    return _with(SALES, CLEANED) + """select cast(strftime(d, '%Y%m%d') as integer) as date_key, d as full_date,
  cast(day(d) as integer) as day_of_month, cast(month(d) as integer) as month_number,
  strftime(d, '%B') as month_name, cast(quarter(d) as integer) as quarter_number,
  cast(year(d) as integer) as year_number, strftime(d, '%Y-%m') as year_month,
  dayofweek(d) in (0, 6) as is_weekend
from (select cast(g as date) as d
      from (select min(sale_date) as a, max(sale_date) as b from staged) r,
           generate_series(cast(r.a as timestamp), cast(r.b as timestamp), interval 1 day) t(g))"""


def q_dim_customer() -> str:
    return _with(SALES, CLEANED, DIMC) + "select * from dimc"


def q_dim_product() -> str:
    return _with(SALES, CLEANED, DIMP) + "select * from dimp"


def q_fact_sales() -> str:
    return _with(SALES, CLEANED, DIMC, DIMP, FACT) + """select source_system, source_row_id, load_batch_id, date_key,
  segment_at_sale, cast(revenue as double) as revenue, cast(profit as double) as profit,
  cast(promo_pct as double) as promo_pct from fact"""


def q_upsert() -> str:
    return _with(SALES, CLEANED, RELOAD, UPSERT) + \
        "select source_row_id, load_batch_id, cast(revenue as double) as revenue from upserted"


def q_unknown_customers() -> str:
    return _with(SALES, CLEANED, features_ctes([P.TEST_SNAPSHOT])) + f"""select {_d(P.TEST_SNAPSHOT)} as snapshot_date,
  f.customer_name, {pseudo()} as churn_prob
from features f
where not exists (select 1 from staged s where s.customer_name = f.customer_name
                  and s.load_batch_id = 'batch_a' and s.sale_date >= {_d(P.RELOAD_FROM)})"""


def _dup(src: str, keys: str, name: str) -> str:
    return f"""select '{name}' as check_name, cast(sum(n) as bigint) as row_count, count(*) as distinct_keys,
  count(case when n > 1 then 1 end) as duplicate_keys
from (select {keys}, count(*) as n from {src} group by {keys})"""


def q_dup_keys() -> str:
    parts = [
        _dup("staged", "source_row_id", "staging.source_row_id"),
        _dup("staged", "customer_name, sale_date, product_code", "staging.customer_day_product"),
        _dup("dimc", "customer_name", "dim_customer.customer_name"),
        _dup("dimp", "product_code", "dim_product.product_code"),
        _dup("fact", "source_system, source_row_id", "fact.source_row"),
        _dup("features", "snapshot_date, customer_name", "snapshot.snapshot_customer"),
    ]
    return _with(SALES, CLEANED, DIMC, DIMP, FACT, features_ctes(P.SNAPSHOTS)) + "\nunion all\n".join(parts)


def q_orphans() -> str:
    return _with(SALES, CLEANED) + """select distinct 'staging.customer_name' as check_name, customer_name as key_value
from staged where customer_name is not null and customer_name not in
  (select customer_name from staged where load_batch_id = 'batch_a' and customer_name is not null)
union all
select distinct 'staging.product_code', product_code from staged where product_code is not null and product_code not in
  (select product_code from staged where load_batch_id = 'batch_a' and product_code is not null)"""


# ---------------------------------------------------------------- features

def q_customer_snapshot() -> str:
    return _with(SALES, features_ctes([P.TEST_SNAPSHOT])) + "select * from features"


def q_trend_both_windows() -> str:
    return _with(SALES, features_ctes([P.TEST_SNAPSHOT], trend_mode="both_windows")) + "select * from features"


def q_segment_as_of() -> str:
    return _with(SALES, features_ctes(P.SNAPSHOTS)) + """select snapshot_date, customer_name, segment from (
  select f.snapshot_date, f.customer_name, x.segment_name as segment,
         row_number() over (partition by f.snapshot_date, f.customer_name
                            order by x.sale_date desc, x.source_row_id desc) as rn
  from features f left join sales x
    on x.customer_name = f.customer_name and x.sale_date <= f.snapshot_date and x.segment_name is not null
) where rn = 1"""


def q_multi_snapshot() -> str:
    return _with(SALES, features_ctes(P.ALL_MONTH_ENDS)) + "select * from features"


def q_model_input() -> str:
    return _with(SALES, CLEANED, DIMC, features_ctes(P.SNAPSHOTS), labels_cte()) + \
        "select l.* from labeled l join dimc c on c.customer_name = l.customer_name"


def q_training_set() -> str:
    return _with(SALES, features_ctes([P.TRAIN_SNAPSHOT, P.TEST_SNAPSHOT]), labels_cte()) + "select * from labeled"


# ------------------------------------------------------------------ labels

def q_churn_label() -> str:
    return _with(SALES, features_ctes(P.SNAPSHOTS), labels_cte()) + \
        "select snapshot_date, customer_name, churn_label from labeled"


def q_retained_semi() -> str:
    return _with(SALES, features_ctes(P.SNAPSHOTS), labels_cte()) + \
        "select snapshot_date, customer_name from labeled where churn_label = 0"


def q_churned_anti() -> str:
    return _with(SALES, features_ctes(P.SNAPSHOTS)) + """select f.snapshot_date, f.customer_name from features f
where f.customer_name not in (
  select x.customer_name from sales x
  where x.sale_date between f.snapshot_date + 1 and last_day(f.snapshot_date + 1) and x.customer_name is not null)"""


# ------------------------------------------------------------------- rules

def _level(p: str = "churn_prob") -> str:
    return (f"case when {p} >= {dbl(K.URGENT_THRESHOLD)} then '{K.LEVEL_URGENT}'"
            f" when {p} >= {dbl(K.HIGH_THRESHOLD)} then '{K.LEVEL_HIGH}'"
            f" when {p} >= {dbl(K.MEDIUM_THRESHOLD)} then '{K.LEVEL_MEDIUM}' else '{K.LEVEL_LOW}' end")


def _action(level: str = "risk_level", seg: str = "segment", rec: str = "recency") -> str:
    return (f"case when {level} = '{K.LEVEL_URGENT}' and {seg} = '{P.TEST_VIP_SEGMENT}' then '{K.ACTION_VISIT}'"
            f" when {level} = '{K.LEVEL_URGENT}' or {rec} > 60 then '{K.ACTION_CALL}'"
            f" when {level} = '{K.LEVEL_HIGH}' or {rec} > 30 then '{K.ACTION_OFFER}'"
            f" else '{K.ACTION_FOLLOW_UP}' end")


def scored_cte(src: str = "features", name: str = "scored") -> str:
    return f"""{name}_p as (select *, {pseudo()} as churn_prob from {src}),
{name}_l as (
  select *, round_even(least(greatest(churn_prob * 10, 1.0), 10.0), 1) as risk_score,
         {_level()} as risk_level
  from {name}_p
),
{name} as (select *, {_action()} as sales_action from {name}_l)"""


def q_risk_rules() -> str:
    return _with(SALES, features_ctes(P.SNAPSHOTS), scored_cte()) + \
        "select snapshot_date, customer_name, churn_prob, risk_score, risk_level, sales_action from scored"


def q_churn_list() -> str:
    return _with(SALES, features_ctes([P.FORECAST_SNAPSHOT]), scored_cte()) + """select customer_name, segment, recency,
  frequency, aov, margin, trend, active_months, risk_score, churn_prob, risk_level, sales_action from scored"""


def q_churn_by_segment() -> str:
    return _with(SALES, features_ctes([P.FORECAST_SNAPSHOT]), scored_cte()) + f"""select segment, count(*) as customers,
  sum(churn_prob) / count(churn_prob) as mean_churn_prob,
  count(case when risk_level = '{K.LEVEL_URGENT}' then 1 end) as urgent_customers,
  count(case when risk_level in ('{K.LEVEL_HIGH}', '{K.LEVEL_URGENT}') then 1 end) as high_or_urgent,
  cast(sum(recency) as double) / cast(count(recency) as double) as avg_recency,
  round(sum(aov) / count(aov), 2) as avg_aov,
  round(sum(margin) / count(margin), 6) as avg_margin
from scored group by segment"""


# ----------------------------------------------------------------- reports

def q_rfm_summary() -> str:
    return _with(SALES, features_ctes([P.TEST_SNAPSHOT])) + """select segment, count(*) as customers,
  cast(sum(recency) as double) / cast(count(recency) as double) as avg_recency,
  cast(sum(frequency) as double) / cast(count(frequency) as double) as avg_frequency,
  round(sum(aov) / count(aov), 2) as avg_aov,
  round(sum(margin) / count(margin), 6) as avg_margin,
  round(sum(promo_rate) / count(promo_rate), 6) as avg_promo_rate
from features group by segment"""


def q_monthly_sales() -> str:
    return _with(SALES, CLEANED) + """select cast(year(sale_date) as integer) as year_number,
  cast(month(sale_date) as integer) as month_number, strftime(sale_date, '%Y-%m') as year_month,
  count(*) as transaction_count, count(distinct customer_name) as customer_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit,
  cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0) as margin
from staged group by 1, 2, 3"""


def q_top_customers() -> str:
    return _with(SALES, CLEANED, DIMC) + """select s.customer_name, c.current_segment, count(*) as transaction_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit,
  cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0) as margin
from staged s join dimc c on c.customer_name = s.customer_name
group by 1, 2 order by sum(revenue) desc, s.customer_name limit 20"""


def q_reconciliation() -> str:
    return _with(SALES, CLEANED, RELOAD, UPSERT) + """select 'staging' as source_name, count(*) as row_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit from staged_all
union all
select 'fact', count(*), cast(sum(revenue) as double), cast(sum(profit) as double) from upserted"""


def q_reconciliation_by_batch() -> str:
    return _with(SALES, CLEANED, RELOAD, UPSERT) + """select coalesce(s.load_batch_id, f.load_batch_id) as load_batch_id,
  coalesce(s.n, 0) as staged_rows, coalesce(f.n, 0) as fact_rows,
  coalesce(s.n, 0) - coalesce(f.n, 0) as row_difference,
  cast(coalesce(s.r, 0) - coalesce(f.r, 0) as double) as revenue_difference
from (select load_batch_id, count(*) as n, sum(revenue) as r from staged_all group by 1) s
full outer join (select load_batch_id, count(*) as n, sum(revenue) as r from upserted group by 1) f
  on s.load_batch_id = f.load_batch_id"""


def q_null_counts() -> str:
    from tillsight.plans.fixtures import NOT_NULL_COLUMNS
    cols = ",\n  ".join(f"count(case when {c} is null then 1 end) as null_{c}" for c in NOT_NULL_COLUMNS)
    return _with(SALES, CLEANED) + f"select {cols}\nfrom staged"


def q_column_profile() -> str:
    return _with(SALES, CLEANED) + """select count(distinct category_name) as categories,
  count(distinct month_number) as months, round(avg(margin_pct), 8) as avg_margin_pct,
  min(sale_date) as first_sale_date, max(sale_date) as last_sale_date from cleaned"""


def q_load_audit() -> str:
    return _with(SALES, CLEANED, RELOAD) + """select load_batch_id, source_file_name, count(*) as row_count,
  cast(sum(revenue) as double) as revenue, min(sale_date) as first_sale_date, max(sale_date) as last_sale_date,
  'SUCCESS' as status
from staged_all group by 1, 2"""


def q_sales_by_segment() -> str:
    return _with(SALES, CLEANED) + """select segment_name as segment, count(*) as transaction_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit,
  cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0) as margin
from cleaned group by 1"""


def q_customer_share() -> str:
    return _with(SALES, CLEANED, DIMC) + """select segment, customers,
  cast(customers as double) / cast(sum(customers) over () as double) as customer_share
from (select current_segment as segment, count(*) as customers from dimc group by 1)"""


def q_customers_month_segment() -> str:
    return _with(SALES, CLEANED) + """select strftime(sale_date, '%Y-%m') as year_month, segment_name as segment,
  count(distinct customer_name) as customers from cleaned group by 1, 2"""


PRODUCT_TOTALS = """ptot as (
  select product_code, count(*) as transaction_count, cast(sum(revenue) as double) as revenue,
         cast(sum(profit) as double) as profit,
         coalesce(cast(sum(profit) as double) / nullif(cast(sum(revenue) as double), 0), 0.0) as margin
  from cleaned group by 1
)"""


def q_top_products_margin() -> str:
    return _with(SALES, CLEANED, PRODUCT_TOTALS) + "select * from ptot order by margin desc, product_code limit 5"


def q_top_products_revenue() -> str:
    return _with(SALES, CLEANED, PRODUCT_TOTALS) + "select * from ptot order by revenue desc, product_code limit 10"


def q_revenue_share() -> str:
    return _with(SALES, CLEANED) + """select customer_name, segment, cast(rev as double) as revenue,
  cast(prof as double) as profit,
  cast(rev as double) / nullif(cast(sum(rev) over (partition by segment) as double), 0) as revenue_share
from (select customer_name, segment_name as segment, sum(revenue) as rev, sum(profit) as prof
      from cleaned group by 1, 2)"""


def q_revenue_by_category() -> str:
    return _with(SALES, CLEANED) + """select category_name, count(*) as transaction_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit from cleaned group by 1"""


# ----------------------------------------------------------------- metrics

def test_scores_ctes(a: int = 37, b: int = 11, name: str = "sc") -> str:
    return f"""{name} as (select customer_name, churn_label, {pseudo(a, b)} as churn_prob from labeled),
{name}_counts as (
  select churn_prob as threshold, count(case when churn_label = 1 then 1 end) as pos,
         count(case when churn_label <> 1 then 1 end) as neg
  from {name} group by 1
),
{name}_tot as (select cast(sum(pos) as bigint) as p, cast(sum(neg) as bigint) as n from {name}_counts)"""


def _grid() -> str:
    from tillsight.operators.evaluation import threshold_grid
    return ", ".join(f"({dbl(x)})" for x in threshold_grid())


def sweep_cte() -> str:
    return f"""grid(threshold) as (values {_grid()}),
cands as (
  select threshold, sum(pos) as pos, sum(neg) as neg
  from (select * from sc_counts union all select threshold, 0, 0 from grid) group by threshold
),
cum as (
  select threshold, cast(sum(pos) over (order by threshold desc) as bigint) as tp,
         cast(sum(neg) over (order by threshold desc) as bigint) as fp
  from cands
),
sweep as (
  select c.threshold,
         coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0) as precision,
         coalesce(cast(tp as double) / nullif(cast(t.p as double), 0), 0.0) as recall,
         coalesce(cast(5 * tp as double) / nullif(cast(5 * tp + 4 * (t.p - tp) + fp as double), 0), 0.0) as f2,
         tp + fp as urgent_count, tp, fp, t.p - tp as fn, t.n - fp as tn
  from cum c, sc_tot t
)"""


def _metric_base() -> list[str]:
    return [SALES, features_ctes([P.TEST_SNAPSHOT]), labels_cte()]


def q_threshold_sweep() -> str:
    return _with(*_metric_base(), test_scores_ctes(), sweep_cte()) + "select * from sweep"


def q_choose_threshold() -> str:
    return _with(*_metric_base(), test_scores_ctes(), sweep_cte()) + f"""select threshold, precision, recall, f2,
  urgent_count, tp, fp, fn, tn, feasible from (
  select * from (select *, true as feasible, 0 as p from sweep
                 where recall >= {dbl(K.MIN_RECALL)} and urgent_count <= {K.MAX_URGENT}
                 order by f2 desc, precision desc, threshold desc limit 1)
  union all
  select * from (select *, (recall >= {dbl(K.MIN_RECALL)} and urgent_count <= {K.MAX_URGENT}) as feasible, 1 as p
                 from sweep order by f2 desc, recall desc, precision desc, threshold asc limit 1)
) order by p limit 1"""


def q_confusion() -> str:
    t = dbl(K.URGENT_THRESHOLD)
    return _with(*_metric_base(), test_scores_ctes()) + f"""select {t} as threshold,
  count(case when churn_prob < {t} and churn_label <> 1 then 1 end) as tn,
  count(case when churn_prob >= {t} and churn_label <> 1 then 1 end) as fp,
  count(case when churn_prob < {t} and churn_label = 1 then 1 end) as fn,
  count(case when churn_prob >= {t} and churn_label = 1 then 1 end) as tp,
  coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0) as precision,
  coalesce(cast(tp as double) / nullif(cast(tp + fn as double), 0), 0.0) as recall,
  coalesce(cast(5 * tp as double) / nullif(cast(5 * tp + 4 * fn + fp as double), 0), 0.0) as f2,
  cast(sum(churn_label) as double) / cast(count(*) as double) as actual_churn_rate,
  sum(churn_prob) / cast(count(*) as double) as mean_predicted_prob
from sc"""


def auc_expr(name: str = "sc") -> str:
    """AUC from per-score counts: pairs won plus half the ties, exact integers, one division."""
    return f"""(select cast(sum(pos * (2 * neg_below + neg)) as double) / cast(2 * max(t.p) * max(t.n) as double)
   from (select pos, neg, coalesce(sum(neg) over (order by threshold rows between unbounded preceding
                                                  and 1 preceding), 0) as neg_below from {name}_counts),
        {name}_tot t)"""


def ap_expr(name: str = "sc") -> str:
    return f"""(select sum(case when pos > 0 then cast(pos as double) * cast(tp as double) / cast(tp + fp as double) end)
          / cast(max(t.p) as double)
   from (select pos, sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp
         from {name}_counts), {name}_tot t)"""


def q_auc() -> str:
    return _with(*_metric_base(), test_scores_ctes()) + \
        f"select {auc_expr()} as roc_auc, p as positives, n as negatives from sc_tot"


def q_average_precision() -> str:
    return _with(*_metric_base(), test_scores_ctes()) + \
        f"select round({ap_expr()}, 12) as average_precision, p as positives from sc_tot"


def q_champion() -> str:
    from tillsight.plans.fixtures import PSEUDO_MODELS
    t = dbl(K.URGENT_THRESHOLD)
    ctes, rows = [], []
    for i, (name, (a, b)) in enumerate(PSEUDO_MODELS.items()):
        n = f"m{i}"
        ctes.append(test_scores_ctes(a, b, n))
        rows.append(f"""select '{name}' as model_name, {auc_expr(n)} as roc_auc, round({ap_expr(n)}, 12) as average_precision,
  (select coalesce(cast(5 * tp as double) / nullif(cast(5 * tp + 4 * (max_p - tp) + fp as double), 0), 0.0)
   from (select count(case when churn_prob >= {t} and churn_label = 1 then 1 end) as tp,
                count(case when churn_prob >= {t} and churn_label <> 1 then 1 end) as fp,
                count(case when churn_label = 1 then 1 end) as max_p from {n})) as f2,
  (select coalesce(cast(tp as double) / nullif(cast(tp + fp as double), 0), 0.0)
   from (select count(case when churn_prob >= {t} and churn_label = 1 then 1 end) as tp,
                count(case when churn_prob >= {t} and churn_label <> 1 then 1 end) as fp from {n})) as precision""")
    body = "\nunion all\n".join(rows)
    return _with(*_metric_base(), *ctes, f"metrics as ({body})") + """select *,
  cast(row_number() over (order by roc_auc desc, average_precision desc, f2 desc, precision desc, model_name)
       as integer) as model_rank,
  row_number() over (order by roc_auc desc, average_precision desc, f2 desc, precision desc, model_name) = 1
    as is_active
from metrics"""


# ------------------------------------------------------- through the pipeline

def q_pipeline_fact() -> str:
    return _with(SALES) + f"""select source_row_id, load_batch_id,
  cast(year(d) * 10000 + month(d) * 100 + day(d) as integer) as date_key, cast(year(d) * 100 + month(d) as integer) as sale_month,
  customer_name, product_code, cast(revenue as double) as revenue, cast(profit as double) as profit
from (
  select source_row_id, customer_name, product_code, profit,
         case when load_batch_id = 'batch_b' or sale_date < date '1995-02-01' then 'batch_11'
              when sale_date >= {_d(P.RELOAD_FROM)} then 'batch_10' else 'batch_9' end as load_batch_id,
         case when load_batch_id = 'batch_a' and sale_date < date '1995-02-01' then sale_date + 31 else sale_date end as d,
         case when load_batch_id = 'batch_a' and sale_date >= {_d(P.RELOAD_FROM)} then revenue + 1 else revenue end as revenue
  from sales)"""


def q_pipeline_scores() -> str:
    return _with(SALES, features_ctes([P.TEST_SNAPSHOT])) + f"""select customer_name,
  case when customer_name like '%7' then 's10' else 's9' end as load_batch_id,
  p / case when customer_name like '%7' then 4 else 1 end as churn_prob,
  p * 10 / case when customer_name like '%7' then 4 else 1 end as risk_score
from (select customer_name, {pseudo()} as p from features)
union all select 'nobody', 'rejected s9', 0.5, 5.0"""


# ----------------------------------------------------- the published warehouse

def q_batch_ledger() -> str:
    return _with(SALES, """t as (
  select count(*) filter (load_batch_id = 'batch_a') as na, count(*) filter (load_batch_id = 'batch_b') as nb,
         cast(sum(revenue) filter (load_batch_id = 'batch_a') as double) as ra, cast(sum(revenue) as double) as r from sales)""") + """
select 1 as attempt, 'batch_a' as load_batch_id, 'batch_a.parquet' as source_file_name, 'SUCCESS' as status, na as rows_loaded, 0 as rows_rejected,
       1 as version, true as finished, false as has_error, na as fact_rows, ra as fact_revenue from t
union all select 2, 'batch_b', 'batch_b.parquet', 'FAILED', nb, 0, null, true, true, na, ra from t
union all select 3, 'batch_b', 'batch_b.parquet', 'SUCCESS', nb, 0, 2, true, false, na + nb, r from t
union all select 4, 'empty:1/2', 'empty:1/2.parquet', 'FAILED', 0, 0, null, true, true, na + nb, r from t"""


def q_snapshot_incremental() -> str:
    return q_multi_snapshot()


# ------------------------------------------------- dashboard in one pass, checks, versions

def q_dashboard_cube() -> str:
    return _with(SALES, CLEANED) + """select year_month, segment, category_name, product_code, customer_name,
  cast(grouping(year_month, segment, category_name, product_code, customer_name) as integer) as level, count(*) as transaction_count,
  cast(sum(revenue) as double) as revenue, cast(sum(profit) as double) as profit
from (select strftime(sale_date, '%Y-%m') as year_month, segment_name as segment, category_name, product_code, customer_name, revenue, profit from cleaned)
group by grouping sets ((segment), (category_name), (product_code), (year_month), (segment, customer_name), (year_month, segment), (year_month, segment, customer_name), ())"""


def q_customers_pivot() -> str:
    each = ", ".join(f"count(distinct customer_name) filter (segment_name = '{s}') as \"{s}\"" for s in P.SEGMENTS)
    return _with(SALES, CLEANED) + f"select strftime(sale_date, '%Y-%m') as year_month, {each} from cleaned group by 1"


def q_monthly_growth() -> str:
    return _with(SALES, """m as (select date_trunc('month', sale_date)::date as month, count(*) as n, sum(revenue) as r from sales
  where strftime(sale_date, '%Y-%m') <> '1996-02' group by 1),
c as (select unnest(generate_series((select min(month) from m), (select max(month) from m), interval 1 month))::date as month),
f as (select c.month, coalesce(n, 0) as n, cast(coalesce(r, 0) as double) as r from c left join m on m.month = c.month)""") + """
select strftime(month, '%Y-%m') as year_month, n as transaction_count, r as revenue, lag(r) over (order by month) as revenue_before,
       round((r - lag(r) over (order by month)) / nullif(lag(r) over (order by month), 0), 9) as growth from f"""


def q_customer_sketches() -> str:
    return _with(SALES, CLEANED) + "select strftime(sale_date, '%Y-%m') as year_month, count(distinct customer_name) as customers, true as within_bound from cleaned group by 1"


def q_collated_customers() -> str:
    return _with(SALES) + """select lower(customer_name) as customer_name, count(*) as transaction_count, cast(sum(revenue) as double) as revenue
from sales where customer_name is not null group by 1"""


def q_load_checks() -> str:
    from tillsight.plans.fixtures import NOT_NULL_COLUMNS
    nulls = "\n".join(f"union all select 'staging', 'null_{c}', cast(count(*) filter ({c} is null) as double) from staged" for c in NOT_NULL_COLUMNS)
    both = "\nunion all ".join(f"select '{t}' as table_name, 'row_count' as metric, cast(count(*) as double) as value from staged "
                               f"union all select '{t}', 'sum_revenue', cast(sum(revenue) as double) from staged "
                               f"union all select '{t}', 'sum_profit', cast(sum(profit) as double) from staged" for t in ("staging", "fact_sales"))
    zero = " ".join(f"union all select 'fact_sales', '{m}', 0.0" for m in ("null_date_key", "null_customer_key", "null_product_key", "wrong_date_key"))
    return _with(SALES, CLEANED) + f"{both} {nulls} {zero}"


def q_score_date_keys() -> str:
    return _with(SALES, CLEANED, features_ctes([P.TEST_SNAPSHOT]), """days as (select unnest(generate_series(min(sale_date)::timestamp, max(sale_date)::timestamp, interval 1 day)) as d from staged),
n as (select count(*) as n from features)""") + """select 'dim_date.date_key' as check_name, count(*) as row_count, count(*) as distinct_keys, 0 as duplicate_keys from days
union all select 'dim_date.full_date', count(*), count(*), 0 from days
union all select 'score_file.key', 2 * n, n, n from n
union all select 'churn_score.key', n, n, 0 from n"""


def q_model_versions() -> str:
    from tillsight.plans.fixtures import PSEUDO_MODELS
    scored = " union all ".join(f"select snapshot_date, churn_label, '{m}' as model_name, {pseudo(a, b)} as p from labeled" for m, (a, b) in PSEUDO_MODELS.items())
    return _with(SALES, features_ctes(P.ALL_MONTH_ENDS), labels_cte(), f"""scored as ({scored}),
counts as (select snapshot_date, model_name, p, count(*) filter (churn_label = 1) as pos, count(*) filter (churn_label <> 1) as neg from scored group by all),
ranked as (select *, sum(neg) over (partition by snapshot_date, model_name order by p desc) as fp from counts),
aucs as (select snapshot_date, model_name, round(1.0 - cast(sum(pos * (2 * fp - neg)) as double) / nullif(cast(2 * sum(pos) * sum(neg) as double), 0), 9) as roc_auc from ranked group by all),
best as (select * from aucs where roc_auc is not null qualify row_number() over (partition by snapshot_date order by roc_auc desc, model_name) = 1),
marked as (select *, case when lag(model_name) over (order by snapshot_date) = model_name then 0 else 1 end as new from best)""") + """
select snapshot_date as selected_on, model_name, roc_auc, cast(sum(new) over (order by snapshot_date) as integer) as model_version,
       lead(snapshot_date) over (order by snapshot_date) is null as is_active from marked"""


def q_bucketed_customers() -> str:
    return _with(SALES, features_ctes([P.TEST_SNAPSHOT])) + f"select *, {pseudo()} as churn_prob from features"


def build() -> dict[str, str]:
    """All oracle texts, keyed like ``__spark_entry__.queries()``."""
    from tillsight.plans import model_oracle
    out = model_oracle.build()
    for k, v in globals().items():
        if k.startswith("q_") and callable(v):
            out[k] = v()
    return out

"""The same queries in DuckDB SQL, written from the rules and not from the Spark plans."""

from __future__ import annotations

RUN = "date '2001-08-01'"

CTES = {
    "fx_product": """
select case when p_partkey % 97 = 0 then '  ' else cast(p_partkey as varchar) end as product_no,
  p_name as product_name, p_type as product_type,
  case when p_partkey % 11 = 0 then '' else lower(p_type) end as category,
  case when p_partkey % 5 = 0 then '  ' when p_partkey % 7 = 0 then null else p_brand end as brand,
  'SKU-' || cast(p_partkey as varchar) as sku_no,
  case when p_size > 25 then 'CARTON' else 'PCS' end as unit_of_measure,
  case when p_partkey % 19 = 0 then '1,234'
    else cast(cast(p_retailprice as decimal(18,4)) as varchar) end as purchase_price,
  cast(p_retailprice as decimal(18,4)) as price,
  cast(p_partkey + 1000000 as varchar) as barcode,
  cast(row_number() over (order by p_partkey) - 1 as bigint) as row_id from part""",
    "stg_product": """
select row_id, case when trim(product_no) = '' then 'UNSPECIFIED-' || cast(row_id as varchar)
    else trim(product_no) end as product_no, product_name, product_type, category,
  case when brand is not null and trim(brand) <> '' then upper(trim(brand))
    when category = 'PROMO' then 'PROMO' else category || ' - UNBRANDED' end as brand,
  sku_no, unit_of_measure, try_cast(purchase_price as decimal(18,4)) as purchase_price,
  price as wholesale_price, price as retail_price, cast(null as decimal(18,4)) as online_price,
  barcode
from (select * replace (case when trim(category) = '' then 'UNCATEGORISED'
                        else upper(trim(category)) end as category) from fx_product)""",
    "fx_sales": """
select case when l_orderkey % 13 = 0 then '31/02/2000'
    else strftime(o_orderdate, '%d/%m/%Y') end as date_txt,
  p_name as product_name, cast(l_partkey as varchar) as product_no, p_type as product_type,
  lower(p_type) as category,
  case when p_partkey % 5 = 0 then '  ' else p_brand end as brand, n_name as warehouse,
  s_name as store,
  case when o_custkey % 17 = 0 then ' ' else ' ' || lower(c_mktsegment) end as channel,
  cast(l_quantity as decimal(15,2)) as qty,
  cast(l_extendedprice as decimal(15,2)) * (1 - cast(l_discount as decimal(15,2))) as amount,
  cast(l_quantity as decimal(15,2)) * cast(p_retailprice as decimal(15,2)) as cost,
  case when l_returnflag = 'R' then cast(l_quantity as decimal(15,2)) else 0 end as refund_qty,
  case when l_returnflag = 'R' then 1 else 0 end as refund_orders,
  cast(l_extendedprice as decimal(15,2)) as unit_price,
  cast(p_retailprice as decimal(15,2)) as unit_cost,
  cast(trunc(l_discount * 100) as int) || '%' as margin_text
from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey""",
    "stg_sales": """
select case when regexp_matches(date_txt, '^\\d{1,2}/\\d{1,2}/\\d{4}$')
    then cast(try_strptime(date_txt, '%d/%m/%Y') as date) end as date,
  product_name, product_no, product_type, upper(category) as category,
  case when trim(brand) <> '' then upper(trim(brand)) when upper(category) = 'PROMO' then 'PROMO'
    else upper(category) || ' - UNBRANDED' end as brand, warehouse, store,
  case when trim(channel) = '' then 'UNSPECIFIED' else upper(trim(channel)) end as channel,
  cast(refund_qty as decimal(18,4)) as refund_qty, cast(refund_orders as int) as refund_orders,
  cast(amount as decimal(18,4)) as amount, cast(qty as decimal(18,4)) as qty,
  cast(cost as decimal(18,4)) as cost, cast(unit_price as decimal(18,4)) as unit_price,
  cast(unit_cost as decimal(18,4)) as unit_cost,
  cast(amount - cost as decimal(18,4)) as profit, margin_text
from fx_sales""",
    "stg_movement": """
select cast(l_partkey as varchar) as product_no, cast(null as varchar) as product_name,
  cast(null as varchar) as sku_no, 'UNCATEGORISED' as category,
  'UNCATEGORISED - UNBRANDED' as brand, 'PCS' as unit_of_measure,
  case l_returnflag when 'N' then 'Receive Stock' when 'A' then 'Transfer Stock'
    else 'UNSPECIFIED MOVEMENT' end as type,
  cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as document_no,
  cast(try_strptime(strftime(l_shipdate, '%d/%m/%Y'), '%d/%m/%Y') as date) as date,
  n_name as warehouse,
  case when l_linestatus = 'O' then cast(l_quantity as decimal(18,4)) end as inbound,
  case when l_linestatus = 'F' then cast(l_quantity as decimal(18,4)) end as outbound,
  cast(l_quantity as decimal(18,4)) as closing, cast(null as decimal(18,4)) as closing_cost
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey""",
    "mv_recent": f"""
select cast(l_partkey as varchar) as product_no, n_name as warehouse,
  cast({RUN} - cast(case when p_partkey % 40 < cast(substr(p_brand, 7) as int) % 12 then 46 else 0
    end + cast(l_quantity as int) % 45 as integer) as date) as date
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join part on l_partkey = p_partkey""",
    "stg_balance": """
select cast(p_partkey as varchar) as product_no, p_name as product_name,
  cast(null as varchar) as sku_no, upper(p_type) as category,
  case when p_partkey % 5 <> 0 then upper(p_brand) when upper(p_type) = 'PROMO' then 'PROMO'
    else upper(p_type) || ' - UNBRANDED' end as brand, 'PCS' as unit_of_measure,
  n_name as warehouse, cast(coalesce(b.soh, 0) as decimal(18,4)) as stock_on_hand,
  cast(null as decimal(18,4)) as unit_cost,
  cast(coalesce(b.soh, 0) * cast(p_retailprice as decimal(15,2)) as decimal(18,4)) as asset_value
from part cross join nation left join (
  select l_partkey, s_nationkey, sum(cast(l_quantity as decimal(15,2))) as soh
  from lineitem join supplier on l_suppkey = s_suppkey where l_linestatus = 'O' group by 1, 2) b
  on p_partkey = b.l_partkey and n_nationkey = b.s_nationkey""",
}
_BLANK = "case when l_partkey % 97 = 0 then 'UNSPECIFIED-' || cast(pos as varchar)"
CTES["numbered"] = "select *, row_number() over () - 1 as pos from lineitem"
CTES["mixed_log"] = """
select cast(l_partkey as varchar) as product_no, cast(null as varchar) as product_name,
  cast(null as varchar) as sku_no, category,
  case when p_partkey % 5 <> 0 then upper(p_brand) when category = 'PROMO' then 'PROMO'
    else category || ' - UNBRANDED' end as brand, 'PCS' as unit_of_measure,
  case l_returnflag when 'N' then 'Receive Stock' when 'A' then 'Transfer Stock'
    else 'UNSPECIFIED MOVEMENT' end as type,
  cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as document_no,
  case when l_orderkey % 13 <> 0 then cast(l_shipdate as date) end as date,
  n_name as warehouse,
  case when l_linestatus = 'O' then cast(l_quantity as decimal(18,4)) end as inbound,
  case when l_linestatus = 'F' then cast(l_quantity as decimal(18,4)) end as outbound,
  case when l_orderkey % 3 <> 0 then cast(l_quantity as decimal(18,4)) end as closing,
  cast(null as decimal(18,4)) as closing_cost
from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey
  join (select *, case when p_partkey % 11 = 0 then 'UNCATEGORISED' else upper(p_type) end
        as category from part) on l_partkey = p_partkey"""
STATUS = """case when age_days is null or age_days < 0 then 'No Movement Data'
  when age_days <= 15 then 'Healthy' when age_days <= 30 then 'Watch'
  when age_days <= 45 then 'Review' when age_days <= 60 then 'Slow Moving'
  when age_days <= 90 then 'Critical' else 'Dead Stock' end"""
ORDER = """case when age_days is null or age_days < 0 then 7 when age_days <= 15 then 1
  when age_days <= 30 then 2 when age_days <= 45 then 3 when age_days <= 60 then 4
  when age_days <= 90 then 5 else 6 end"""


def bucket(age: str) -> str:
    return f"""case when {age} is null or {age} < 0 then 'No Movement Data'
  when {age} <= 15 then '0-15 Days' when {age} <= 30 then '16-30 Days'
  when {age} <= 45 then '31-45 Days' when {age} <= 60 then '46-60 Days'
  when {age} <= 90 then '61-90 Days' else '90+ Days' end"""


def aged(log: str, run: str = RUN) -> str:
    return f"""
select product_no, product_name, category, brand, warehouse, stock_on_hand, asset_value,
  last_movement_date, age_days, {bucket('age_days')} as aging_bucket,
  coalesce(age_days >= 45, false) as is_aged
from (select b.*, l.last_movement_date,
        cast(date_diff('day', l.last_movement_date, {run}) as integer) as age_days
      from stg_balance b left join (select product_no, warehouse, max(date) as last_movement_date
                                    from {log} group by 1, 2) l
        on b.product_no = l.product_no and b.warehouse = l.warehouse)"""


CTES["hot_log"] = """
select * replace (case when mod(cast(split_part(document_no, '-', 1) as bigint), 3) = 1 then '7'
    else product_no end as product_no,
  case when mod(cast(split_part(document_no, '-', 1) as bigint), 3) = 1 then 'NATION_7'
    else warehouse end as warehouse) from stg_movement"""
CTES["stg_aging"] = aged("stg_movement")
CTES["stg_aging_recent"] = aged("mv_recent")

_NAMES = list(CTES)


def q(body: str, **more: str) -> str:
    """A query with the common tables it mentions, directly or through others, in front."""
    tables = {**CTES, **more}
    wanted, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name in tables:
            if name in text and name not in wanted:
                wanted.add(name)
                todo.append(tables[name])
    ctes = ", ".join(f"{n} as ({tables[n]})" for n in tables if n in wanted)
    return f"with {ctes} {body}" if ctes else body


def d38(expr: str) -> str:
    return f"cast({expr} as decimal(38,4))"


def share(num: str, den: str) -> str:
    return f"case when {den} <> 0 then round(cast({num} as double) / cast({den} as double), 6) end"


def slow(inner: str) -> str:
    return q(f"""select brand, cast(sum(i) as bigint) as in_stock, cast(sum(a) as bigint) as aged,
  {share('sum(a)', 'sum(i)')} as ratio,
  coalesce(case when sum(i) <> 0 then cast(sum(a) as double) / sum(i) >= 0.1 end, false) as flagged
from ({inner}) group by brand""")


def profile(extra: str = "") -> str:
    by = f"{extra}, " if extra else ""
    return q(f"""select {by}{ORDER} as bucket_order, aging_bucket, {STATUS} as aging_status,
  count(*) as n_rows, count(distinct product_no) as n_skus, {d38('sum(stock_on_hand)')} as units,
  {d38('sum(asset_value)')} as value from stg_aging group by all""")


def segment(where: str) -> str:
    return q(f"""select brand, {d38('coalesce(units, 0)')} as units,
  {d38('coalesce(value, 0)')} as value, {d38('coalesce(aged_value, 0)')} as aged_value,
  {d38('coalesce(amount, 0)')} as amount, {d38('coalesce(profit, 0)')} as profit
from (select brand, sum(stock_on_hand) as units, sum(asset_value) as value,
        sum(case when is_aged then asset_value end) as aged_value
      from stg_aging where {where} group by 1) a
  full join (select brand, sum(amount) as amount, sum(profit) as profit
             from stg_sales where {where} group by 1) s using (brand)""")


def cover(key: str, sales: str = "stg_sales") -> str:
    return f"""select {key}, {d38('coalesce(units, 0)')} as units,
  {d38('coalesce(sold_qty, 0)')} as sold_qty,
  case when sold_qty > 0 then round(cast(coalesce(units, 0) as double) * 30
    / cast(sold_qty as double), 6) end as days_of_cover
from (select {key}, sum(stock_on_hand) as units from stg_balance group by 1) a
  full join (select {key}, sum(qty) as sold_qty from {sales}
             where date > {RUN} - 30 and date <= {RUN} group by 1) s using ({key})"""


SALES_NOW = f"""(select * replace (cast({RUN} - case when k % 11 = 5 then 60
    when k % 4 = 1 and cast(product_no as int) % 10 <> 0 then 60
    else cast(product_no as int) % 30 end as date) as date,
  qty * case when k % 4 = 0 then 2 else 1 end as qty)
from (select *, coalesce(try_cast(split_part(brand, '#', 2) as int), 0) as k from stg_sales))"""


def status(key: str, sales: str = "stg_sales") -> str:
    return q(f"""select *, case when units <= 0 or days_of_cover < 14 then 'RESTOCK'
  when days_of_cover is null or days_of_cover > 90 then 'OVERSTOCK' else 'OK' end as status
from ({cover(key, sales)})""")


def trend(period: str, name: str) -> str:
    return q(f"""select {period} as {name}, count(*) as n_rows, {d38('sum(amount)')} as amount,
  {d38('sum(qty)')} as qty, {d38('sum(profit)')} as profit from stg_sales group by 1""")


def reconcile(log: str) -> str:
    return q(f"""select product_no, warehouse, stock, closing,
  {d38('stock - closing')} as variance,
  case when stock is null then 'NO_STOCK' when closing is null then 'NO_LOG'
    when stock = closing then 'MATCH' else 'VARIANCE' end as class
from (select product_no, warehouse, {d38('sum(stock_on_hand)')} as stock
      from stg_balance group by 1, 2)
  full join ({log}) using (product_no, warehouse)""")


def dq(table: str, field: str, rule: str, source: str, condition: str) -> str:
    return (f"select '{table}' as table_name, '{field}' as field, '{rule}' as rule, "
            f"cast(count(*) filter (where {condition}) as bigint) as n from {source}")


RULES = ("not a number", "rounded", "too large")


def dq_report() -> str:
    parts = []

    def add(table, source, conditions):
        for (field, rule), cond in conditions.items():
            parts.append(dq(table, field, rule, source, cond))

    def blank(c):
        return f"({c} is null or trim({c}) = '')"

    add("product", "fx_product", {
        ("Product No.", "placeholder"): blank("product_no"),
        ("Category", "placeholder"): blank("category"),
        ("Brand", "placeholder"): blank("brand"),
        ("Purchase Price", "not a number"): "try_cast(purchase_price as decimal(18,4)) is null",
        **{(f"{p} Price", "not a number"): "false" for p in ("Wholesale", "Retail", "Online")},
        **{(f"{p} Price", r): "false" for r in ("rounded", "too large")
           for p in ("Purchase", "Wholesale", "Retail", "Online")}})
    numbers = ["Refund Quantity", "Refund Order Count", "Net Sales Amount", "Net Sales Quantity",
               "Net Sales Cost", "Net Sales Unit Price", "Net Sales Unit Cost", "Net Sales Gross Profit"]
    add("sales", "fx_sales", {
        ("Product NO.", "placeholder"): blank("product_no"),
        ("Tier 1 Category", "placeholder"): blank("category"),
        ("Brand", "placeholder"): blank("brand"),
        ("Sales Channels", "placeholder"): blank("channel"),
        ("Warehouse", "placeholder"): blank("warehouse"),
        ("Store", "placeholder"): blank("store"),
        ("Date", "unparsed date"): "try_strptime(date_txt, '%d/%m/%Y') is null",
        **{(f, r): "false" for f in numbers for r in RULES}})
    add("stock_balance", "part", {
        ("Product No.", "placeholder"): "false", ("Category", "placeholder"): blank("p_type"),
        ("Brand", "placeholder"): "p_partkey % 5 = 0",
        **{(f, r): "false" for r in RULES
           for f in ("Stock on Hand", "Unit Cost", "Inventory Asset Value")}})
    logged = ["Inbound-Quantity", "Outbound-Quantity", "Closing-Quantity", "Closing-Cost"]
    add("stock_balance_details", "stg_movement", {
        ("Product No.", "placeholder"): "false", ("Category", "placeholder"): "true",
        ("Brand", "placeholder"): "true",
        ("Type", "placeholder"): "type = 'UNSPECIFIED MOVEMENT'",
        ("Warehouse", "placeholder"): "false", ("Date", "unparsed date"): "date is null",
        **{(f, r): "false" for f in logged for r in RULES}})
    return q(" union all ".join(parts))


def facts(column: str) -> str:
    return q(f"select {column} from stg_sales union select {column} from stg_aging")


SHIPPED = """select cast(l_shipdate as date) as day, l_returnflag as channel, count(*) as n_rows,
  cast(sum(cast(l_quantity as decimal(18,4))) as decimal(38,4)) as amount,
  cast(sum(cast(l_quantity as decimal(18,4))) as decimal(38,4)) as qty,
  cast(sum(cast(l_quantity as decimal(18,4))) as decimal(38,4)) as profit
from lineitem group by 1, 2"""


def oracle_sql() -> dict[str, str]:
    last = "select product_no, warehouse, max(date) as last_movement_date from stg_movement group by 1, 2"
    aging = q("select * from stg_aging")
    cleaned_brand = "select row_id, {} from stg_product"
    asof = " union all ".join(
        f"""select date '{d}' as run_date, {bucket('age')} as aging_bucket, count(*) as n_rows,
  {d38('sum(stock_on_hand)')} as units
from (select stock_on_hand, date_diff('day', l.last_d, date '{d}') as age from stg_balance b
      left join (select product_no, warehouse, max(date) as last_d from stg_movement
                 where date <= date '{d}' group by 1, 2) l
      on b.product_no = l.product_no and b.warehouse = l.warehouse) group by 2"""
        for d in ("1999-06-30", "2000-12-31", "2001-08-01"))
    weekly = f"""
select run_date, {bucket('age')} as aging_bucket, count(*) as n_rows,
  {d38('sum(stock_on_hand)')} as units
from (select run_date, stock_on_hand, date_diff('day', l.date, run_date) as age
      from (select b.*, cast(run_date as date) as run_date
            from stg_balance b, range(date '1994-01-01', date '2001-09-01', interval 7 day) r(run_date)) p
      asof left join stg_movement l
      on p.product_no = l.product_no and p.warehouse = l.warehouse and run_date >= l.date)
group by 1, 2"""
    return {
        "c2_clean_category": q(cleaned_brand.format("category")),
        "c3_clean_brand": q(cleaned_brand.format("brand")),
        "c4_product_no": q(cleaned_brand.format("product_no")),
        "c4_product_no_unpivoted": """
with w as (select n_name, row_number() over (order by n_nationkey) - 1 as block from nation),
p as (select p_partkey, row_number() over (order by p_partkey) - 1 as pos,
        count(*) over () as n from part)
select case when p_partkey % 97 = 0 then 'UNSPECIFIED-' || cast(block * n + pos as varchar)
    else cast(p_partkey as varchar) end as product_no, n_name as warehouse
from p cross join w""",
        "c5_clean_text": q("""select channel, warehouse, store, count(*) as n_rows
from stg_sales group by all"""),
        "c6_parse_date": q("select date, count(*) as n_rows from stg_sales group by 1"),
        "c7_numeric": q("""select row_id, purchase_price,
  coalesce(purchase_price, cast(0 as decimal(18,4))) as purchase_price_or_zero from stg_product"""),
        "t1_product": q("select * exclude (row_id) from stg_product"),
        "s2_product_csv": q("select * exclude (row_id) from stg_product"),
        "t2_sales": q("select * from stg_sales"),
        "t3_unpivot_balance": q("select * from stg_balance"),
        "t3_unpivot_two_warehouses": q("""select product_no, warehouse, stock_on_hand, asset_value
from stg_balance where warehouse in ('NATION_3', 'NATION_17')"""),
        "t4_movement": q("select * from stg_movement"),
        "a1_last_movement": q(last),
        "k3_csv_snapshot": q(last),
        "x1_streaming_last_movement": q(last),
        "t5_stock_aging": aging,
        "p2_published_aging": aging,
        "t5_stock_aging_strict": q(
            "select * from strict_aging",
            strict_log="select * from stg_movement where date <= date '2000-12-31'",
            strict_aging=aged("strict_log", "date '2000-12-31'")),
        "q1_row_conservation": q("""
select table_name, cast(n as bigint) as expected_rows, cast(m as bigint) as actual_rows,
  n = m as ok from (
select 'stg_product' as table_name, (select count(*) from part) as n, (select count(*) from stg_product) as m
union all select 'stg_sales', (select count(*) from lineitem), (select count(*) from stg_sales)
union all select 'stg_stock_balance', (select count(*) from part) * (select count(*) from nation),
  (select count(*) from stg_balance)
union all select 'stg_stock_movement', (select count(*) from lineitem), (select count(*) from stg_movement)
union all select 'stg_stock_aging', (select count(*) from part) * (select count(*) from nation),
  (select count(*) from stg_aging))"""),
        "q2_dq_report": dq_report(),
        "q3_key_check": q("""
select 'stg_product' as table_name, key, count(*) as n_rows from (select
  case when try_cast(product_no as int) % 50 = 1 then '0' else product_no end as key
  from stg_product) group by 2 having count(*) > 1
union all select 'stg_stock_balance', key || ' | ' || warehouse, count(*) from (select warehouse,
  case when try_cast(product_no as int) % 50 = 1 then '0' else product_no end as key
  from stg_balance) group by 2 having count(*) > 1"""),
        "c4_sales_blank_numbers": q(f"""
select {_BLANK} else cast(l_partkey as varchar) end as product_no,
  cast(l_quantity as decimal(18,4)) as qty, cast(cast(l_extendedprice as decimal(15,2))
    * (1 - cast(l_discount as decimal(15,2))) as decimal(18,4)) as amount from numbered"""),
        "c4_movement_blank_numbers": q(f"""
select {_BLANK} else cast(l_partkey as varchar) end as product_no, n_name as warehouse,
  cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as document_no
from numbered join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey"""),
        "s3_sales_csv": q("select * from stg_sales"),
        "s4_balance_csv": q("select * from stg_balance"),
        "s5_movement_csv": q("select * from stg_movement"),
        "t4_movement_mixed": q("select * from mixed_log"),
        "a1_last_movement_bad_dates": q("""select product_no, warehouse,
  max(date) as last_movement_date from mixed_log where date is not null group by 1, 2"""),
        "g8_stock_status_all_classes": status("brand", SALES_NOW),
        "g8_stock_status_sku_all_classes": status("product_no", SALES_NOW),
        "g15_star_keys": q(" union all ".join(
            f"""select '{fact}' as fact, '{d}' as dimension, count(*) as n_rows,
  count(*) as n_matched, count(*) as n_same_name from {source}"""
            for fact, source in (("fact_sales", "stg_sales"), ("fact_stock_aging", "stg_aging"))
            for d in ("brand", "warehouse", "category"))),
        "g16_reconcile_closing_gaps": reconcile(f"""
select product_no, warehouse, {d38('closing')} as closing
  from (select *, row_number() over (partition by product_no, warehouse
          order by date desc nulls last, document_no desc, closing desc nulls last) as rn
        from mixed_log) where rn = 1"""),
        "x1_folded_last_movement": q(last),
        "x3_folded_channel_days": SHIPPED,
        "x3_watermarked_channel_days": f"""select * from ({SHIPPED})
where day <= (select max(cast(l_shipdate as date)) - 30 from lineitem)""",
        "g1_slow_moving": slow("""select brand, product_no,
    max(case when stock_on_hand > 0 then 1 else 0 end) as i,
    max(case when stock_on_hand > 0 and is_aged then 1 else 0 end) as a
  from stg_aging_recent group by 1, 2"""),
        "g1_slow_moving_pair": slow("""select brand,
    case when stock_on_hand > 0 then 1 else 0 end as i,
    case when stock_on_hand > 0 and is_aged then 1 else 0 end as a from stg_aging_recent"""),
        "g2_aging_profile": profile(),
        "g2_aging_profile_by_brand": profile("brand"),
        "g2_aging_cube": q(" union all ".join(
            f"""select '{d}' as dimension, {c} as member, aging_bucket, count(*) as n_rows,
  count(distinct product_no) as n_skus, {d38('sum(stock_on_hand)')} as units,
  {d38('coalesce(sum(asset_value), 0)')} as value
from stg_aging group by 2, 3"""
            for d, c in (("all", "cast(null as varchar)"), ("brand", "brand"),
                         ("warehouse", "warehouse"), ("category", "category")))),
        "g3_exec_kpi": q(f"""
select {d38('v')} as inventory_value, {d38('u')} as units, n_skus, n_warehouses,
  {d38('net')} as net_sales, {d38('gp')} as gross_profit, {share('gp', 'net')} as margin,
  {share('av', 'v')} as aged_value_share
from (select sum(asset_value) as v, sum(stock_on_hand) as u, count(distinct product_no) as n_skus,
        count(distinct warehouse) as n_warehouses,
        sum(case when is_aged then asset_value else 0 end) as av from stg_aging),
     (select sum(amount) as net, sum(profit) as gp from stg_sales)"""),
        "g4_sales_trend": trend("cast(date_trunc('month', date) as date)", "month"),
        "g4_sales_trend_daily": trend("date", "day"),
        "g5_channel_split": q(f"""
select channel, {d38('a')} as amount, {d38('n')} as qty, {d38('p')} as profit,
  {share('p', 'a')} as margin, {share('a', '(sum(a) over ())')} as share
from (select channel, sum(amount) as a, sum(qty) as n, sum(profit) as p
      from stg_sales group by 1)"""),
        "g6_segment": segment("category = 'PROMO'"),
        "g6_segment_others": segment("category in ('SMALL', 'LARGE')"),
        "g6_segment_brands": segment("brand in ('BRAND#3', 'BRAND#12', 'SMALL - UNBRANDED')"),
        "g7_days_of_cover": q(cover("brand")),
        "g8_stock_status": status("brand"),
        "g8_stock_status_sku": status("product_no"),
        "g9_mgmt_alert": q(f"""
select brand, warehouse, count(*) as n_rows, {d38('sum(stock_on_hand)')} as units,
  {d38('sum(asset_value)')} as value
from stg_aging where is_aged and stock_on_hand > 0 and category <> 'PROMO' group by 1, 2"""),
        "g10_dim_date": q("""
select cast(strftime(date, '%Y%m%d') as int) as date_key, date, cast(year(date) as int) as year,
  cast(quarter(date) as int) as quarter, cast(month(date) as int) as month,
  cast(day(date) as int) as day_of_month, cast(date_trunc('month', date) as date) as month_start
from (select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as date
      from (select min(d) as lo, max(d) as hi from (
        select date as d from stg_sales union all select last_movement_date from stg_aging)))"""),
        "g11_dim_brand": facts("brand"),
        "g12_dim_warehouse": facts("warehouse"),
        "g13_dim_category": facts("category"),
        "g14_fact_sales": q("""select cast(strftime(date, '%Y%m%d') as int) as date_key, date,
  product_no, brand, warehouse, category, channel, amount, qty, cost, profit from stg_sales"""),
        "g15_fact_stock_aging": q(f"""
select cast(strftime(last_movement_date, '%Y%m%d') as int) as date_key, product_no, brand,
  warehouse, category, stock_on_hand, asset_value, age_days, aging_bucket,
  {STATUS} as aging_status, is_aged from stg_aging"""),
        "g16_reconcile": reconcile(f"""select product_no, warehouse,
    {d38('coalesce(sum(inbound), 0) - coalesce(sum(outbound), 0)')} as closing
  from stg_movement group by 1, 2"""),
        "g16_reconcile_closing": reconcile(f"""select product_no, warehouse, {d38('closing')} as closing
  from (select *, row_number() over (partition by product_no, warehouse
          order by date desc, document_no desc, closing desc) as rn from stg_movement)
  where rn = 1"""),
        "g17_orphans": q(" union all ".join(
            f"""select '{name}' as source_table, product_no, count(*) as n_rows from {source}
where product_no not in (select product_no from stg_product) group by 2"""
            for name, source in (("stg_sales", "stg_sales"), ("stg_stock_balance", "stg_balance"),
                                 ("stg_stock_movement", "stg_movement")))),
        "g18_top_brands": q(f"""
select row_number() over (order by value desc, brand) as rank, brand, value
from (select brand, {d38('sum(asset_value)')} as value from stg_balance group by 1)
order by value desc, brand limit 10"""),
        "g18_top_skus_aged": q(f"""
select row_number() over (order by value desc, product_no) as rank, product_no, value
from (select product_no, {d38('coalesce(sum(case when is_aged then asset_value end), 0)')} as value
      from stg_aging group by 1) order by value desc, product_no limit 25"""),
        "g18_top_skus_per_brand": q(f"""
select brand, rank, product_no, value from (
  select brand, product_no, value,
    row_number() over (partition by brand order by value desc, product_no) as rank
  from (select brand, product_no, {d38('sum(amount)')} as value from stg_sales group by 1, 2))
where rank <= 3"""),
        "a1_stored_last_movement": q("""select product_no, warehouse,
  max(date) as last_movement_date from hot_log group by 1, 2"""),
        "t5_stored_aging": q("select * from hot_aging", hot_aging=aged("hot_log")),
        "q3_stored_key_check": q("""select 'stg_stock_movement' as table_name,
  product_no || ' | ' || warehouse as key, count(*) as n_rows from hot_log
group by product_no, warehouse having count(*) > 1"""),
        "g16_stored_reconcile": reconcile(f"""
select product_no, warehouse, {d38('closing')} as closing
  from (select *, row_number() over (partition by product_no, warehouse
          order by date desc, document_no desc, closing desc) as rn from hot_log) where rn = 1"""),
        "q1_content_conservation": q("""
select table_name, cast(n as bigint) as expected_rows, cast(n as bigint) as actual_rows, true as ok
from (select 'stg_product' as table_name, count(*) as n from part
union all select 'stg_sales', count(*) from lineitem
union all select 'stg_stock_balance', (select count(*) from part) * (select count(*) from nation)
union all select 'stg_stock_movement', count(*) from lineitem
union all select 'stg_stock_aging', (select count(*) from part) * (select count(*) from nation))"""),
        "q2_rejected_rows": q("""
select 'product' as table_name, row_id as position, 'Retail Price' as field, 'too large' as reason,
  cast(price as varchar) || 'e15' as text from fx_product where row_id % 50 = 3"""),
        "x3_closed_channel_days": """
with lines as (select l_orderkey % 4 as k, cast(l_shipdate as date) as day, l_returnflag as channel,
    cast(l_quantity as decimal(18,4)) as x from lineitem),
closed as (select b as k, max(day) - 30 as day from lines, range(1, 5) r(b) where k < b group by b),
marked as (select l.*, coalesce(l.day < c.day, false) as late from lines l left join closed c using (k))
select day, channel, count(*) as n_rows, count(*) filter (late) as n_late,
  cast(sum(x) as decimal(38,4)) as amount, cast(sum(x) as decimal(38,4)) as qty,
  cast(sum(x) as decimal(38,4)) as profit,
  coalesce(day < (select max(day) - 30 from lines), false) as closed
from marked group by day, channel""",
        "g16_first_divergence": f"""
with log as (select case when l_orderkey % 3 = 1 then '7' else cast(l_partkey as varchar) end as product_no,
  case when l_orderkey % 3 = 1 then 'NATION_7' else n_name end as warehouse,
  cast(l_shipdate as date) as date, cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as document_no,
  cast(case when l_orderkey % 11 = 4 and l_partkey % 3 = 0 then 2 else 0 end as decimal(38,4)) as net,
  cast(case when l_orderkey % 11 <> 4 and l_orderkey % 4 <> 3 then 100 + case when l_partkey % 5 = 1
    and l_orderkey % 3 <> 1 and l_shipdate > timestamp '1999-06-30' then 5 else 0 end end as decimal(38,4)) as closing
  from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey),
placed as (select *, sum(net) over w as moved, row_number() over w as nth from log window w as
  (partition by product_no, warehouse order by date nulls last, document_no, net, closing nulls last)),
opened as (select product_no, warehouse, arg_min(closing - moved, nth) as opening
  from placed where closing is not null group by 1, 2)
select product_no, warehouse, date, document_no, {d38('opening + moved')} as balance,
  {d38('closing')} as closing from placed join opened using (product_no, warehouse)
where closing <> opening + moved
qualify row_number() over (partition by product_no, warehouse order by nth) = 1""",
        "x2_asof_series": q(asof),
        "x2_asof_weekly": q(weekly),
        "x3_streaming_channel_days": q(f"""
select date as day, channel, count(*) as n_rows, {d38('sum(amount)')} as amount,
  {d38('sum(qty)')} as qty, {d38('sum(profit)')} as profit from stg_sales group by 1, 2"""),
    }

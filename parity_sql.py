"""SQL counterparts of the registered queries, for DuckDB over the benchmark tables.

Averages and shares are rounded in integer arithmetic (half a cent goes up), which is
independent of either engine's decimal or floating-point division.
"""

from __future__ import annotations

# The source tables, then the star schema, as common table expressions.
_CTES = {
    "client": """
        select c_custkey as client_id, c_name as client_name,
               lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example'
                   as email,
               '(555) 000-' || lpad(cast(c_custkey % 10000 as varchar), 4, '0') as phone_number,
               cast(c_custkey as varchar) || ' ' || c_mktsegment || ' St' as address,
               cast(c_nationkey as bigint) as type_id, c_custkey % 7 as status_id,
               cast(date '2018-01-01' + cast(c_custkey % 1000 as integer) as timestamp)
                   as registration_date
        from customer""",
    "client_status": """
        select cast(r_regionkey as bigint) as client_status_id, r_name as status_name
        from region""",
    "client_type": """
        select cast(n_nationkey as bigint) as client_type_id, n_name as type_name from nation""",
    "sales_order": """
        select o_orderkey as order_id, o_custkey as client_id,
               cast(left(o_orderpriority, 1) as bigint) as payment_id,
               cast(o_orderdate as date) as order_date, o_orderstatus as status,
               cast(o_totalprice as decimal(10,2)) as total_amount
        from orders""",
    "order_product": """
        select l_orderkey * 10 + l_linenumber as order_product_id, l_orderkey as order_id,
               l_partkey as product_id, cast(l_quantity as decimal(10,1)) as quantity,
               cast(floor(l_extendedprice / l_quantity * 100) / 100 as decimal(10,2)) as price_unit
        from lineitem""",
    "product": """
        select p_partkey as product_id, p_name as product_name, p_type as category,
               cast(p_retailprice as decimal(10,2)) as price
        from part""",
    "payment_method": """
        select distinct cast(left(o_orderpriority, 1) as bigint) as payment_id,
               split_part(o_orderpriority, '-', 2) as payment_method
        from orders""",
    "dim_client": """
        select client_id, client_name,
               left(email, 1) || '***@' || split_part(email, '@', 2) as email,
               '(***) ***-' || right(phone_number, 4) as phone_number,
               left(address, 3) || '***' as address,
               type_name, status_name, registration_date
        from client
        left join client_type on type_id = client_type_id
        left join client_status on status_id = client_status_id""",
    "fact_orders": """
        select order_product_id, o.order_id, client_id, product_id, payment_id, order_date,
               status, quantity, price_unit, total_amount
        from sales_order o join order_product l on o.order_id = l.order_id""",
    "sale": """
        select *, cast(date_trunc('month', order_date) as date) as month,
               price_unit * quantity as revenue,
               cast(price_unit * 100 as bigint) * cast(quantity * 10 as bigint) as mils,
               cast(quantity * 10 as bigint) as tenths
        from fact_orders""",
    "by_category": """
        select category, count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue,
               cast(cast((2 * sum(mils) + sum(tenths)) // (2 * sum(tenths)) as bigint) * 0.01
                    as decimal(38,2)) as avg_price_per_unit,
               sum(mils) as mils
        from sale join product using (product_id) group by category""",
    "by_client_type": """
        select type_name as client_type, count(distinct client_id) as total_clients,
               count(distinct order_id) as total_orders,
               cast(sum(revenue) as decimal(38,3)) as total_revenue,
               cast(cast((2 * sum(mils) + 10 * count(distinct client_id))
                         // (20 * count(distinct client_id)) as bigint) * 0.01
                    as decimal(38,2)) as revenue_per_client
        from sale join dim_client using (client_id) group by type_name""",
    "by_client": """
        select client_id, client_name, type_name as client_type, status_name as client_status,
               count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue,
               min(order_date) as first_order_date, max(order_date) as last_order_date
        from sale join dim_client using (client_id) group by 1, 2, 3, 4""",
    "monthly": """
        select month, count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue,
               cast(cast((2 * sum(mils) + 10 * count(distinct order_id))
                         // (20 * count(distinct order_id)) as bigint) * 0.01
                    as decimal(38,2)) as avg_order_value
        from sale group by month""",
    "cube_category_month": """
        select coalesce(a, 'ALL CATEGORIES') as category,
               coalesce(cast(b as varchar), 'ALL MONTHS') as month,
               count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue
        from (select category as a, month as b, * from sale join product using (product_id))
        group by cube (a, b)""",
    "cube_payment_status": """
        select coalesce(a, 'ALL METHODS') as payment_method,
               coalesce(b, 'ALL STATUSES') as order_status,
               count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue
        from (select payment_method as a, status as b, *
              from sale join payment_method using (payment_id))
        group by cube (a, b)""",
    "cell_category_month": """
        select * from cube_category_month
        where category != 'ALL CATEGORIES' and month != 'ALL MONTHS'""",
    "client_delivery": """
        select client.* replace ((type_id + n * (client_id % 3)) % 25 as type_id,
                                 (status_id + n // 2) % 7 as status_id), delivered_at
        from client, (values (0, timestamp '1995-06-30 08:00'), (1, timestamp '1996-09-15 13:50'),
                             (2, timestamp '1998-03-01 14:37'), (3, timestamp '2000-01-20 09:05')) d(n, delivered_at)
        where case n when 0 then client_id % 5 != 4 when 1 then client_id % 2 = 0 or client_id % 5 = 4
              else client_id % (n + 1) = 0 end""",
    # A version opens where type or status, all that ever changes, differ from the row before.
    "client_version": """
        select * exclude (opens), row_number() over (partition by client_id order by delivered_at) as version,
               delivered_at as valid_from, lead(delivered_at) over (partition by client_id order by delivered_at) as valid_to
        from (select *, lag((type_id, status_id)) over (partition by client_id order by delivered_at)
                        is distinct from (type_id, status_id) as opens from client_delivery)
        where opens""",
    "kpi": """
        select count(distinct order_id) as orders, count(distinct client_id) as clients,
               cast(sum(quantity) as decimal(38,1)) as units,
               cast(sum(revenue) as decimal(38,3)) as revenue
        from sale""",
}

# Tested relations: the table that stands for each, and its primary key.
_TESTED = {
    "stg_client": ("client", "client_id"),
    "stg_client_status": ("client_status", "client_status_id"),
    "stg_client_type": ("client_type", "client_type_id"),
    "stg_orders": ("sales_order", "order_id"),
    "stg_order_product": ("order_product", "order_product_id"),
    "stg_product": ("product", "product_id"),
    "stg_payment_method": ("payment_method", "payment_id"),
    "dim_client": ("dim_client", "client_id"),
    "dim_product": ("product", "product_id"),
    "dim_payment": ("payment_method", "payment_id"),
    "fact_orders": ("fact_orders", "order_product_id"),
}
_FOREIGN_KEYS = {"client_id": "dim_client", "product_id": "product", "payment_id": "payment_method"}

_DUPLICATES = " union all ".join(
    f"select '{model}' as model, '{key}' as column_name, {key} as key, count(*) as occurrences "
    f"from {table} group by {key} having count(*) > 1"
    for model, (table, key) in _TESTED.items()
)
_NULLS = " union all ".join(
    f"select '{model}' as model, '{key}' as column_name, "
    f"count(*) filter (where {key} is null) as null_rows from {table}"
    for model, table, key in [
        *[(model, table, key) for model, (table, key) in _TESTED.items()],
        *[("fact_orders", "fact_orders", key) for key in _FOREIGN_KEYS],
    ]
)
_ORPHANS = " union all ".join(
    f"select 'fact_orders' as model, '{key}' as column_name, count(*) as orphan_rows "
    f"from fact_orders where {key} is not null "
    f"and not exists (select 1 from {parent} p where p.{key} = fact_orders.{key})"
    for key, parent in _FOREIGN_KEYS.items()
)
_FIRST_KEYS = " union all ".join(
    f"select '{model}' as model, '{key}' as column_name" for model, (_, key) in _TESTED.items()
)

# The test data covers January 1995 to August 2001.
_MONTHS = [
    f"{n // 12:04d}-{n % 12 + 1:02d}-01" for n in range(1995 * 12, 2001 * 12 + 8)
]
_MONTH_COLUMNS = ", ".join(
    f"""cast(sum(total_revenue) filter (where month = '{month}') as decimal(38,3)) as "{month}\""""
    for month in _MONTHS
)


def _with_ctes(select: str) -> str:
    ctes = ",\n".join(f"{name} as ({body}\n)" for name, body in _CTES.items())
    return f"with {ctes}\n{select}"


def _counts(tables: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count from {table}"
        for name, table in tables.items()
    )


# Raw tables: the name that stands for each, and its first column.
_RAW = {
    "client": ("client", "client_id"),
    "client_status": ("client_status", "client_status_id"),
    "client_type": ("client_type", "client_type_id"),
    "orders": ("sales_order", "order_id"),
    "order_product": ("order_product", "order_product_id"),
    "product": ("product", "product_id"),
    "payment_method": ("payment_method", "payment_id"),
}
_SOLD = ("sum(total_units_sold)", "sum(total_revenue)")

# Whole dollars of total_revenue, half to even, from the exact decimal.
_LABEL = """'$' || format('{:,}', cast(
    cast(total_revenue * 1000 as hugeint) // 1000
    + case when cast(total_revenue * 1000 as hugeint) % 1000 > 500
             or (cast(total_revenue * 1000 as hugeint) % 1000 = 500
                 and cast(total_revenue * 1000 as hugeint) // 1000 % 2 = 1)
           then 1 else 0 end as bigint)) as revenue_label"""

_SELECTS = {
    "stg_client": "select * from client",
    "stg_client_status": "select * from client_status",
    "stg_client_type": "select * from client_type",
    "stg_orders": "select * from sales_order",
    "stg_order_product": "select * from order_product",
    "stg_product": "select * from product",
    "stg_payment_method": "select * from payment_method",
    "dim_client": "select * from dim_client",
    "dim_product": "select * from product",
    "dim_payment": "select * from payment_method",
    "fact_orders": "select * from fact_orders",
    "mart_monthly_sales": "select * from monthly order by month",
    "mart_sales_by_category": (
        "select category, total_orders, total_units_sold, total_revenue, avg_price_per_unit "
        "from by_category order by total_revenue desc"
    ),
    "mart_sales_by_client_type": "select * from by_client_type order by total_revenue desc",
    "mart_sales_by_client": "select * from by_client",
    "mart_cube_category_month": "select * from cube_category_month",
    "mart_cube_payment_status": "select * from cube_payment_status",
    "dq_unique": _DUPLICATES,
    "dq_not_null": _NULLS,
    "dq_relationships": _ORPHANS,
    "dq_report": f"""
        select model, column_name, check_name, cast(failures as bigint) as failures,
               failures = 0 as passed
        from (
            select k.model, k.column_name, 'unique' as check_name, count(d.occurrences) as failures
            from ({_FIRST_KEYS}) k left join ({_DUPLICATES}) d
              on k.model = d.model and k.column_name = d.column_name
            group by 1, 2
            union all select model, column_name, 'not_null', null_rows from ({_NULLS})
            union all select model, column_name, 'relationships', orphan_rows from ({_ORPHANS})
        )""",
    "row_counts_raw": _counts({table: name for table, (name, _) in _RAW.items()}),
    "row_counts_star": _counts(
        {
            "dim_client": "dim_client",
            "dim_product": "product",
            "dim_payment": "payment_method",
            "fact_orders": "fact_orders",
        }
    ),
    "kpi_totals": "select * from kpi",
    # The cards are formatted from the exact decimals, cents rounded half to even.
    "kpi_cards": """
        select '$' || format('{:,}', cents // 100) || '.' || lpad(cast(cents % 100 as varchar), 2, '0')
                   as total_revenue,
               format('{:,}', orders) as total_orders, format('{:,}', clients) as unique_clients,
               format('{:,}', whole) as units_sold
        from (select *, cast(mils // 10 + case when mils % 10 > 5 or (mils % 10 = 5 and mils // 10 % 2 = 1)
                                          then 1 else 0 end as bigint) as cents,
                     cast(tenths // 10 + case when tenths % 10 > 5 or (tenths % 10 = 5 and tenths // 10 % 2 = 1)
                                         then 1 else 0 end as bigint) as whole
              from (select orders, clients, cast(revenue * 1000 as hugeint) as mils,
                           cast(units * 10 as hugeint) as tenths from kpi))""",
    "monthly_sales_series": f"""
        select month, strftime(month, '%b %Y') as month_label, total_revenue, {_LABEL}
        from monthly order by month""",
    "category_revenue_share": f"""
        select category, total_revenue, {_LABEL},
               cast(cast((20000 * mils + whole) // (2 * whole) as bigint) * 0.01
                    as decimal(38,2)) as share_pct
        from (select *, sum(mils) over () as whole from by_category)""",
    "client_type_revenue": f"select client_type, total_revenue, {_LABEL} from by_client_type",
    "cells_category_month": "select * from cell_category_month",
    "cells_payment_status": """
        select * from cube_payment_status
        where payment_method != 'ALL METHODS' and order_status != 'ALL STATUSES'""",
    "heatmap_series": f"""
        select category, cast(month as date) as month,
               strftime(cast(month as date), '%b %Y') as month_label, total_revenue, {_LABEL}
        from cell_category_month""",
    "heatmap_category_month": f"""
        select category, {_MONTH_COLUMNS} from cell_category_month group by category""",
    "top_clients": f"""
        select client_id, client_name, client_type, total_revenue, {_LABEL} from by_client
        order by total_revenue desc, client_id limit 10""",
    "client_history": """
        select * exclude (delivered_at, version), cast(version as int) as version,
               valid_to is null as is_current from client_version""",
    # Replayed: the last row delivered by that day.
    "clients_as_of": """
        select * exclude (delivered_at, n) from (
            select *, row_number() over (partition by client_id order by delivered_at desc) as n
            from client_delivery where delivered_at <= timestamp '1999-01-01')
        where n = 1""",
    "orders_as_of": """
        select order_id, o.client_id, order_date, type_id, status_id, valid_from
        from sales_order o asof left join client_version v
          on o.client_id = v.client_id and cast(o.order_date as timestamp) >= v.valid_from""",
    "sales_by_type_then": """
        select type_name as client_type, count(distinct client_id) as total_clients,
               count(distinct (client_id, order_id)) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue
        from (select s.*, v.type_id from sale s asof left join client_version v
              on s.client_id = v.client_id and cast(s.order_date as timestamp) >= v.valid_from)
        left join client_type on type_id = client_type_id group by type_name""",
    "order_total_mismatches": """
        select order_id, total_amount, line_total, cast(total_amount - line_total as decimal(38,3)) as difference,
               coalesce(line_count, 0) as line_count
        from sales_order full join (
            select order_id, count(*) as line_count, cast(sum(price_unit * quantity) as decimal(38,3)) as line_total
            from order_product group by order_id) using (order_id)
        where total_amount is distinct from line_total""",
    "ingest_named_files": " union all ".join(
        f"select '{name}' as table_name, {key} as row_id, if(coalesce({key} % 2 = 0, false), "
        f"timestamp '2025-03-22 14:30', timestamp '2025-04-22 07:20') as delivered_at from {name}"
        for name, key in (("product", "product_id"), ("order_product", "order_product_id"))
    ),
    "ingest_freshness": """
        select table_name, newest_delivery, cast(deliveries as bigint) as deliveries, cast(0 as bigint) as unstamped_files,
               date_diff('minute', newest_delivery, timestamp '2025-04-23 07:20') as age_minutes,
               coalesce(newest_delivery >= timestamp '2025-03-24 07:20', false) as fresh
        from (values ('client', timestamp '2025-04-22 07:20', 2), ('client_type', timestamp '2025-03-22 14:30', 1),
                     ('payment_method', timestamp '2025-04-22 07:20', 1), ('client_status', null, 0), ('orders', null, 0),
                     ('order_product', null, 0), ('product', null, 0)) t(table_name, newest_delivery, deliveries)""",
    # Line ids repeat in the data: of equal ones sent at once the greatest row counts.
    "warehouse_resent": """
        select month, count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue,
               cast(cast((2 * sum(mils) + 10 * count(distinct order_id))
                         // (20 * count(distinct order_id)) as bigint) * 0.01
                    as decimal(38,2)) as avg_order_value
        from (select *, row_number() over (partition by order_product_id order by
                          order_id desc, product_id desc, quantity desc, price_unit desc) as n from sale)
        where n = 1 group by month""",
    "ingest_distinct_stream": "select *, cast(1 as bigint) as times from (select distinct * from sales_order)",
    "quarterly_clients": """
        select cast(date_trunc('quarter', month) as date) as quarter, count(distinct client_id) as clients,
               true as estimate_within_bound
        from sale group by 1""",
    # The watermark is the latest date of the deliveries before, less 31 days.
    "ingest_stream_totals": """
        select * from (with sold as (
            select order_id, order_date, month, sum(quantity) as units, sum(revenue) as revenue,
                   least(case when order_date < date '1997-01-01' then 0 when order_date < date '1999-01-01' then 1
                              else 2 end + case when order_id % 7 = 0 then 1 else 0 end, 2) as delivery
            from sale group by all
        ), bounds as (
            select d.delivery, max(s.order_date) - interval 31 days as bound
            from (select distinct delivery from sold) d left join sold s on s.delivery < d.delivery group by 1
        ), judged as (
            select sold.*, coalesce(order_date < bound, false) as late from sold join bounds using (delivery)
        )
        select month, count(*) filter (not late) as total_orders,
               cast(sum(units) filter (not late) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) filter (not late) as decimal(38,3)) as total_revenue,
               count(*) filter (late) as late_orders,
               cast(sum(revenue) filter (late) as decimal(38,3)) as late_revenue
        from judged group by month)""",
    "warehouse_incremental": """
        select category, month, count(distinct order_id) as total_orders,
               cast(sum(quantity) as decimal(38,1)) as total_units_sold,
               cast(sum(revenue) as decimal(38,3)) as total_revenue
        from sale join product using (product_id) group by category, month""",
    "ingest_csv_batch": "select * from order_product",
    "ingest_csv_stream": "select * from sales_order",
    **{
        f"ingest_csv_{form}_{table}": f"select * from {_RAW[table][0]}"
        for form, registered in (("batch", "order_product"), ("stream", "orders"))
        for table in _RAW
        if table != registered
    },
    "ingest_file_listing": " union all ".join(
        f"select '{table}' as table_name, if(coalesce({key} % 2 = 0, false), 'first', 'second') "
        f"as delivery, count(*) as row_count, cast(0 as bigint) as rejected_rows "
        f"from {name} group by all"
        for table, (name, key) in _RAW.items()
    ),
    "warehouse_build": " union all ".join(
        f"select '{name}' as table_name, count(*) as row_count, "
        f"cast({units} as decimal(38,1)) as units, cast({revenue} as decimal(38,3)) as revenue "
        f"from {table}"
        for name, table, units, revenue in (
            ("dim_client", "dim_client", "null", "null"),
            ("dim_product", "product", "null", "null"),
            ("dim_payment", "payment_method", "null", "null"),
            ("fact_orders", "sale", "sum(quantity)", "sum(revenue)"),
            ("mart_monthly_sales", "monthly", *_SOLD),
            ("mart_sales_by_category", "by_category", *_SOLD),
            ("mart_sales_by_client_type", "by_client_type", "null", "sum(total_revenue)"),
            ("mart_sales_by_client", "by_client", *_SOLD),
            ("mart_cube_category_month", "cube_category_month", *_SOLD),
            ("mart_cube_payment_status", "cube_payment_status", *_SOLD),
        )
    ),
}

ORACLE_SQL: dict[str, str] = {name: _with_ctes(select) for name, select in _SELECTS.items()}

"""The eight raw tables derived from the driver tables, with planned defects.

The texts run in Spark and in DuckDB alike: ``{orders}`` and the like stand
for the driver tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW_SQL = {
    "customers": """
        select case when c_custkey % 97 = 5 then '   '
                    when c_custkey % 101 = 7 then ' ' || cast(c_custkey - 1 as string) || ' '
                    else cast(c_custkey as string) end customer_id,
               case when c_custkey % 89 = 3 then '' else c_name end customer_name,
               n_name city, lower(r_name) state,
               case when c_custkey % 61 = 0 then ' ' else c_mktsegment end customer_segment
        from {customer} join {nation} on c_nationkey = n_nationkey
                        join {region} on n_regionkey = r_regionkey""",
    "products": """
        select case when p_partkey % 103 = 9 then cast(p_partkey - 1 as string)
                    else cast(p_partkey as string) end product_id,
               case when p_partkey % 83 = 2 then '' else p_name end product_name,
               p_type category,
               case when p_partkey % 79 = 4 then ' '
                    else cast(p_partkey % 100 as string) end supplier_id,
               case when p_partkey % 73 = 1 then null when p_partkey % 71 = 1 then -1.0e0
                    else round(p_retailprice * 0.6e0, 2) end unit_cost,
               case when p_partkey % 67 = 1 then -p_retailprice when p_partkey % 59 = 1 then null
                    else p_retailprice end unit_price
        from {part}""",
    "suppliers": """
        select cast(s_suppkey as string) supplier_id, s_name supplier_name, n_name country,
               case when s_suppkey % 23 = 6 then null
                    else round(s_acctbal / 1900e0, 2) end supplier_rating
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "warehouses": """
        select 'W' || cast(n_nationkey as string) warehouse_id, 'DC ' || n_name warehouse_name,
               n_name city,
               case when n_nationkey = 24 then null else n_regionkey * 1000 end capacity_units
        from {nation}""",
    "inventory": """
        select 'I' || cast(p_partkey as string) inventory_id,
               'W' || cast(p_partkey % 25 as string) warehouse_id,
               cast(p_partkey as string) product_id,
               p_size * 10 - 30 quantity_on_hand,
               case when p_size = 50 then -1 else p_size * 5 end reorder_level,
               case when p_size = 13 then '2024-13-01' when p_size = 14 then ''
                    else '2024-01-15' end inventory_date
        from {part}""",
    "orders": """
        select case when o_orderkey % 211 = 3 then ''
                    when o_orderkey % 307 = 5 then cast(o_orderkey - 1 as string)
                    else cast(o_orderkey as string) || ' ' end order_id,
               cast(o_custkey as string) customer_id,
               case when o_orderkey % 199 = 8 then '  '
                    else 'W' || cast((o_orderkey + o_custkey) % 27 as string) end warehouse_id,
               case when o_orderkey % 197 = 1 then '1997-02-30' when o_orderkey % 193 = 1 then ''
                    else cast(cast(o_orderdate as date) as string) end order_date,
               case o_orderstatus when 'F' then 'Delivered' when 'O' then 'Processing'
                    else case when o_orderkey % 5 = 0 then 'Cancelled' else 'Shipped' end
                    end order_status
        from {orders}""",
    "order_items": """
        select case when l_orderkey % 50 = 0
                    then cast(l_orderkey as string) || '-' || cast(l_linenumber as string)
                    else cast(l_orderkey as string) || '-' || cast(l_linenumber as string)
                         || '-' || cast(l_partkey as string) end order_item_id,
               cast(l_orderkey as string) order_id, cast(l_partkey as string) product_id,
               case when l_partkey % 181 = 2 then 0 else cast(l_quantity as int) end quantity,
               case when l_partkey % 179 = 2 then null
                    else floor(round(l_extendedprice * 100) / l_quantity) / 100e0 end unit_price
        from {lineitem}""",
    "shipments": """
        select case when l_orderkey % 40 = 0 then 'S' || cast(l_orderkey as string)
                    else 'S' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string)
                         || '-' || cast(l_partkey as string) end shipment_id,
               cast(l_orderkey as string) order_id,
               'W' || cast(l_orderkey % 27 as string) warehouse_id,
               'Carrier ' || cast(l_suppkey % 4 as string) carrier,
               cast(cast(l_shipdate as date) as string) shipment_date,
               case when l_orderkey % 11 = 0 then '' when l_orderkey % 113 = 1 then 'n/a'
                    else cast(cast(l_shipdate as date) + cast(l_orderkey % 9 - 1 as int)
                              as string) end delivery_date,
               case when l_orderkey % 11 = 0 then 'In Transit' else 'Delivered' end shipment_status
        from {lineitem} where l_returnflag <> 'N' and l_linestatus = 'F'""",
}


def raw_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    text = RAW_SQL[table]
    sources = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in set(re.findall(r"{(\w+)}", text))
    }
    return spark.sql(text, **sources)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {table: raw_table(spark, sf_dir, table) for table in RAW_SQL}

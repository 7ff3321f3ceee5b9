"""Test inputs derived from the driver tables.

``DIRTY_REGISTRATIONS_SQL`` builds dirty registration records (all 14 bronze
columns as text) from ``orders`` and ``part``: one row per order, with the
dirt the cleaning rules exist for. The same text runs in Spark SQL and in
DuckDB, which is what makes it usable as a shared oracle input. Its work grows
with ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regstar.session import shuffled
from regstar.sources.tables import read_table

DIRTY_REGISTRATIONS_SQL = """
select cast(k as string) as slno,
 case when k%23=0 then null when k%19=0 then upper(p_name)||' TIPPER 2015' when k%14=0 then p_name||' vxi (O)' when k%7=0 then p_name||' (O)  PLUS'
      when k%5=0 then substr(p_name,1,length(p_name)-1)||' vxi' else p_name||' lxi 1.2' end as modelDesc,
 case when k%29=0 then null when k%17=0 then '12345' when k%13=0 then 'NA' when k%11=0 then '***'
      when k%5=0 then p_brand||'  MOTORS PVT LTD' else lower(p_brand)||'.,' end as makerName,
 case when k%53=0 then dmy when k%31=0 then null when k%37=0 then 'ONLINE' when k%41=0 then 'HERO MOTORS'
      when k%10=1 then 'TG0'||n2 when k%10=2 then 'TS0'||n2 when k%10=3 then ' rta khammam ' when k%10=4 then 'HYDERABAD-SZ' else 'TS'||n2 end as OfficeCd,
 case when k%101=0 then null when k%97=0 then 'TS1' when c%3=0 then 'ts-'||n2||'X'||cast(c as string) else 'TS'||n2||'X'||cast(c as string) end as tempRegistrationNumber,
 case when k%53=0 then 'TS'||n2 when k%59=0 then 'NIRMAL' when k%6=0 then dmy when k%6=1 then cast(day(d) as string)||'-'||cast(month(d) as string)||'-'||yyyy
      when k%6=2 then yyyy||'-'||mm||'-'||dd||' 00:00:00' when k%6=3 then yyyy||mm||dd when k%6=4 then mm||'.'||dd||'.'||yyyy else 'garbage' end as fromdate,
 case when k%59=0 then dmy when k%4=0 then null else yyyy||'/'||mm||'/'||dd end as todate,
 case k%9 when 0 then null when 1 then 'PETROL+CNG' when 2 then 'Petrol/Battery' when 3 then 'diesel' when 4 then 'CNG ONLY' when 5 then 'LPG' when 6 then 'BATTERY' when 7 then '' else 'NA' end as fuel,
 case when k%8=0 then '' when k%8=1 then 'NA' else ' red ' end as colour,
 case k%4 when 0 then 'GOODS CARRIAGE' when 1 then 'MOTOR CYCLE' when 2 then 'MAXI TAXI' else null end as vehicleClass,
 case k%6 when 0 then null when 1 then '' when 2 then 'UNKNOWN' when 3 then '19' when 4 then 'Mar-2018' else yyyy end as makeYear,
 case k%5 when 0 then '2.0' when 1 then 'x' when 2 then null when 3 then '5' else '4.9' end as seatCapacity,
 case k%3 when 0 then 'Non-Transport' when 1 then 'TRANSPORT' else null end as category,
 case k%4 when 0 then 'Y' when 1 then ' yes ' when 2 then 'N' else null end as secondVehicle
from (select o_orderkey as k, o_custkey as c, o_orderdate as d, p_brand,
  p_name||' '||translate(cast(p_partkey as string),'0123456789','abcdefghij') as p_name,
  cast(year(o_orderdate) as string) as yyyy, lpad(cast(month(o_orderdate) as string),2,'0') as mm, lpad(cast(day(o_orderdate) as string),2,'0') as dd,
  lpad(cast(day(o_orderdate) as string),2,'0')||'/'||lpad(cast(month(o_orderdate) as string),2,'0')||'/'||cast(year(o_orderdate) as string) as dmy,
  lpad(cast(o_custkey%50+1 as string),2,'0') as n2
  from (select *, o_orderkey % (select count(*) from {part}) as pk from {orders}) o join {part} on p_partkey = pk) b
"""


def dirty_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View R: dirty registrations over the whole ``orders`` and ``part`` tables.

    Every part is used, and its key is spelled in the model text, so models,
    dimensions and candidate pairs grow with the tables. Both are dealt out by
    part: the part table grows too, so no process holds the whole of it.
    """
    return spark.sql(DIRTY_REGISTRATIONS_SQL, orders=read_table(spark, sf_dir, "orders"), part=shuffled(read_table(spark, sf_dir, "part")))


def dirty_registrations_sql_for(orders: str = "orders", part: str = "part") -> str:
    """The same text with table names, for engines given named tables."""
    return DIRTY_REGISTRATIONS_SQL.replace("{orders}", orders).replace("{part}", part)

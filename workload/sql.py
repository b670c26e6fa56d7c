"""Shared pieces of the SQL counterparts: the fixtures of ``fixtures.py`` as common table expressions."""

from __future__ import annotations


def r(expression: str) -> str:
    """Onto the comparison grid, by the same arithmetic as ``common.six_digits``."""
    return f"(floor(({expression}) * 1e6 + 0.4321987e0) / 1e6)"


def shown(expression: str, digits: int) -> str:
    """Decimal ROUND half away from zero of the number as printed, which is what Spark's ROUND does."""
    return f"cast(round(cast(cast({expression} as varchar) as decimal(38, 17)), {digits}) as double)"


def period(column: str, grain: str) -> str:
    if grain == "year":
        return f"cast(year({column}) as bigint)"
    return f"cast((year({column}) - 1995) * 4 + quarter({column}) as bigint)"


DIMS = {
    "customer": """dims as (
  select c_custkey as entity, c_name as name, r_name as grp, cast(r_regionkey as bigint) as grp_code
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
    "supplier": """dims as (
  select s_suppkey as entity, s_name as name, r_name as grp, cast(r_regionkey as bigint) as grp_code
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)""",
}

SHARE = """100::double * f / n as a,
    greatest(0::double, 100::double * f / n - 196::double * sqrt((f::double / n) * (1::double - f::double / n) / n)) as a_low,
    least(100::double, 100::double * f / n + 196::double * sqrt((f::double / n) * (1::double - f::double / n) / n)) as a_high"""


def facts(level: str, grain: str) -> str:
    when = period("o_orderdate", grain)
    if level == "customer":
        return f"""facts as (select o_custkey as entity, {when} as period, o_orderpriority as category_code,
  o_orderstatus = 'F' as final from orders)"""
    return f"""facts as (select l_suppkey as entity, {when} as period, o_orderpriority as category_code,
  o_orderstatus = 'F' as final from lineitem join orders on l_orderkey = o_orderkey)"""


def slice_cte(level: str = "customer", grain: str = "year") -> str:
    return f"""{facts(level, grain)}, slice as (
  select entity, period, {SHARE}
  from (select entity, period, count(*) as n, count(*) filter (final) as f from facts group by entity, period))"""


def supply_cte(level: str = "customer", grain: str = "year") -> str:
    key = "o_custkey" if level == "customer" else "l_suppkey"
    source = "lineitem join orders on l_orderkey = o_orderkey" if level == "customer" else "lineitem"
    return f"""supply as (
  select {key} as entity, {period("l_shipdate", grain)} as period,
    sum(l_quantity) filter (l_returnflag <> 'N') as b,
    avg(l_extendedprice) filter (l_linestatus = 'O') as b2
  from {source} group by 1, 2)"""


def panel_cte(level: str = "customer", grain: str = "year") -> str:
    return f"""{slice_cte(level, grain)}, {supply_cte(level, grain)}, {DIMS[level]}, panel as (
  select s.entity, d.name, s.period, s.a, s.a_low, s.a_high, u.b, u.b2, d.grp, d.grp_code
  from slice s join supply u on s.entity = u.entity and s.period = u.period join dims d on s.entity = d.entity)"""


def observations_cte(level: str = "customer", grain: str = "year") -> str:
    return f"""{facts(level, grain)}, {DIMS[level]}, observations as (
  select g.entity, g.period, g.category_code,
    case g.category_code when 'ALL' then 'All orders' when '1-URGENT' then 'Urgent' when '5-LOW' then 'Low'
      else g.category_code end as category, {SHARE}, d.grp, d.grp_code
  from (select entity, period, case when grouping(category_code) = 1 then 'ALL' else category_code end as category_code,
          count(*) as n, count(*) filter (final) as f
        from facts group by grouping sets ((entity, period, category_code), (entity, period))) g
  join dims d on g.entity = d.entity)"""


LONG = """long as (
  select case when l_returnflag = 'R' and l_tax = 0 then '999'
      when l_returnflag = 'A' then '''' || lpad(cast(n_nationkey as varchar), 3, '0')
      when l_returnflag = 'N' then cast(n_nationkey as varchar) || '.0'
      else ' ' || cast(n_nationkey as varchar) end as code,
    n_name as area, p_type as item, e.element, cast(year(l_shipdate) as varchar) || '.0' as period,
    case when e.element = 'quantity' then 'units' else 'money' end as unit,
    case when l_discount = 0 then 'n/a' when e.element = 'quantity' then cast(l_quantity as varchar)
      else cast(l_extendedprice as varchar) end as value,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax,
    l_returnflag, l_linestatus
  from lineitem join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey
    join nation on s_nationkey = n_nationkey
    cross join (values ('quantity'), ('price')) e(element))"""
LONG_ORDER = (
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
CODES = "codes as (select lpad(cast(n_nationkey as varchar), 3, '0') as code, upper(n_name) as area_entity from nation)"
BARE_CODE = "regexp_replace(trim(replace(code, '''', '')), '\\.0$', '')"
CLEAN_CODE = f"(case when length({BARE_CODE}) < 3 then lpad({BARE_CODE}, 3, '0') else {BARE_CODE} end)"


def with_(*ctes: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(ctes) + "\n"

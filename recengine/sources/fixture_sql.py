"""The input relations as SQL (DuckDB and Spark), for the oracle side of the checks.

Same relations as ``recengine.sources.fixtures`` builds with the DataFrame API; see FIXTURES.md.
"""

from __future__ import annotations

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["student_course"] = """
select o.o_custkey as student_id, l.l_partkey as course_id,
       case when max(l.l_returnflag) = 'N' then null
            else cast(ceil(max(l.l_quantity) / 10.0) as int) end as rating
from lineitem l join orders o on l.l_orderkey = o.o_orderkey
group by o.o_custkey, l.l_partkey
"""

FIXTURE_SQL["course_infos"] = """
select p.p_partkey as src_id, p.p_type as type,
       concat('/c/', cast(p.p_partkey as string)) as link,
       case when p.p_size % 11 = 0 then null else g.n end as participants_number,
       case when p.p_size % 13 = 0 then null else s.s_name end as instructor,
       p.p_name as name, p.p_brand as school,
       concat('L', cast(cast(floor(p.p_size / 10.0) as int) as string)) as labels,
       concat(cast(1995 + p.p_partkey % 7 as string), '年', cast(1 + p.p_size % 12 as string), '月',
              cast(1 + p.p_partkey % 28 as string), '日') as start_time,
       concat(cast(1995 + p.p_partkey % 7 + p.p_size % 3 as string), '年',
              cast(1 + (p.p_size * 7) % 12 as string), '月',
              cast(1 + p.p_partkey % 28 as string), '日') as end_time,
       case when p.p_size % 7 = 0 then null else cast(p.p_size as double) / 10 end as grading
from part p
join (select l_partkey, count(distinct l_orderkey) as n, min(l_suppkey) as sk
      from lineitem group by l_partkey) g on g.l_partkey = p.p_partkey
left join supplier s on s.s_suppkey = g.sk
"""

FIXTURE_SQL["course"] = """
select src_id as id, type, link, coalesce(participants_number, 0) as participants_number,
       instructor, name, school, labels, start_time,
       cast(replace(replace(replace(start_time, '年', '-'), '月', '-'), '日', '') as date) as start_time_date,
       end_time,
       cast(replace(replace(replace(end_time, '年', '-'), '月', '-'), '日', '') as date) as end_time_date,
       coalesce(grading, 0) as grading
from course_infos
"""

FIXTURE_SQL["sys_user"] = """
select c_custkey as id, c_name as name,
       case c_custkey % 5 when 0 then 'ECONOMY,PROMO' when 1 then 'STANDARD'
                          when 2 then 'PROMO,SMALL' when 3 then null else 'ECONOMY' end as course_type,
       concat('Brand#', cast(c_custkey % 25 + 1 as string)) as school_names,
       case when c_custkey % 4 = 0 then null else concat('L', cast(c_custkey % 5 as string)) end as labels
from customer
"""


ORDER = ("student_course", "course_infos", "course", "sys_user")


def with_fixtures(body: str) -> str:
    """Prefix ``body`` with the fixture relations as common table expressions."""
    ctes = ",\n".join(f"{n} as (\n{FIXTURE_SQL[n].strip()}\n)" for n in ORDER)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"

"""DuckDB form of the fixture views (FIXTURES.md section B), as CTE bodies.

Mirrors ``pulseboard.sources.fixtures``; both must change together.
"""

FIXTURE_CTES: list[tuple[str, str]] = [
    ("n", "select count(*) as k from supplier"),
    ("roster", """
select s_suppkey as user_id, s_name as user_name,
       lower(replace(s_name, '#', '.')) || '@example.com' as email,
       s_suppkey % 20 <> 19 as is_active,
       case when s_suppkey % 10 = 9 then 'Account Executive'
            when s_suppkey % 4 = 0 then 'Senior Customer Success Manager'
            when s_suppkey % 4 = 1 then 'csm ii' else 'CSM' end as title,
       case when s_suppkey % 23 = 1 then null
            when s_suppkey % 13 = 12 then 'Manager CS'
            when s_suppkey % 17 = 16 then 'VP CS' else 'Rep' end as role_name,
       case when s_suppkey % 11 = 10 then 'Sydney, Australia'
            when s_suppkey % 3 = 0 then null else 'Remote' end as working_location,
       case when s_suppkey % 4 = 2 then null else s_suppkey % 4 = 0 end as is_offshore,
       case s_suppkey % 6 when 0 then 'MEDSPA' when 1 then 'auto'
            when 2 then 'home decor' else null end as hr_vertical
from supplier"""),
    ("touch", """
select l.l_orderkey * 10 + l.l_linenumber as touch_id, s.s_name as rep,
       case when l.l_orderkey % 40 = 11 then null else o.o_custkey end as org,
       l.l_returnflag as channel, l.l_linestatus as st, l.l_quantity as qty,
       o.o_orderdate + to_days(cast(o.o_orderkey % 6 as int))
                     + to_hours(cast(l.l_linenumber * 3 as int)) as ts
from lineitem l join orders o on l.l_orderkey = o.o_orderkey cross join n
join supplier s on s.s_suppkey = case when l.l_linenumber = 3 then l.l_suppkey
                                      else o.o_custkey % n.k end"""),
    ("actions", """
select touch_id as action_id, rep, org, 'REVIEW' as record_type,
       case st when 'F' then 'Closed' else 'Open' end as status, ts as closed_at
from touch where channel = 'N'"""),
    ("calls_a", """
select touch_id as call_id, rep, org,
       case st when 'F' then 'COMPLETED' else 'missed' end as status,
       qty as minutes, ts as start_at
from touch where channel = 'A'"""),
    ("calls_b", """
select touch_id as call_id, rep, org, qty * 60 as seconds, ts as inserted_at
from touch where channel = 'R'"""),
    ("book", """
select c.c_custkey as org, cast(m.m as date) as month, s.s_name as owner,
       c.c_acctbal as mrr, r.r_name as vertical,
       case c.c_mktsegment when 'BUILDING' then 'Mid Market'
            when 'MACHINERY' then 'Phones' when 'FURNITURE' then 'Strategic'
            when 'HOUSEHOLD' then 'SMB' else null end as segment,
       case when c.c_custkey % 15 = 0 then 'Partner' else 'Other' end as dealer_type,
       c.c_custkey % 12 = 0 as has_ai,
       cast(date '1998-06-15' + to_months(cast((c.c_custkey + 2 * d.d) % 7 as int)) as date) as contract_end,
       cast(1 + c.c_custkey % 5 as int) as location_count,
       case c.c_custkey % 3 when 0 then 'Month-to-Month' when 1 then 'Annual' else null end as contract_type
from customer c cross join n
cross join (select unnest(generate_series(timestamp '1998-05-01', timestamp '1998-12-01', interval 1 month)) as m) m
join (select 0 as d union all select 1) d on d.d = 0 or c.c_custkey % 10 = 3
join supplier s on s.s_suppkey = c.c_custkey % n.k
join nation na on na.n_nationkey = c.c_nationkey
join region r on r.r_regionkey = na.n_regionkey
where not (c.c_custkey % 9 = 8 and m.m < timestamp '1998-07-01')"""),
    ("accounts", """
select c.c_custkey as org, (c.c_custkey + (case when c.c_custkey % 25 = 4 then 1 else 0 end)) % n.k as owner_id,
       na.n_name as manager_name
from customer c cross join n
join supplier s on s.s_suppkey = c.c_custkey % n.k
join nation na on na.n_nationkey = s.s_nationkey"""),
    ("contracts", """
select c.c_custkey as org, case when c.c_custkey % 8 = 5 then 'Expired' else 'Activated' end as status,
       cast(date '1998-06-15' + to_months(cast((c.c_custkey + 2 * d.d) % 7 as int)) as date) as end_date
from customer c
join (select 0 as d union all select 1) d on d.d = 0 or c.c_custkey % 10 = 3"""),
    ("cases", """
select o.o_orderkey as case_id,
       case when o.o_orderkey % 50 = 7 then null else o.o_custkey end as org,
       s.s_name as owner, s.s_suppkey as owner_id,
       case o.o_orderkey % 5 when 0 then null when 1 then s.s_suppkey else -1 end as created_by_id,
       case o.o_orderpriority when '1-URGENT' then 'Retention' when '2-HIGH' then 'Onboarding A'
            when '3-MEDIUM' then 'Onboarding B' when '4-NOT SPECIFIED' then 'Onboarding C'
            else 'Other' end as record_type,
       o.o_orderdate + to_hours(cast(o.o_orderkey % 24 as int)) as created_at,
       o.o_orderstatus = 'F' as is_closed
from orders o cross join n join supplier s on s.s_suppkey = o.o_custkey % n.k"""),
    ("scored", """
select (l.l_linenumber - 1) % 4 + 1 as k, s.s_name as rep, cast(l.l_shipdate as date) as conv_date,
       case when l.l_returnflag = 'R' and l.l_linestatus = 'O' then 'incomplete'
            when l.l_orderkey % 30 = 0 then null else 'complete' end as quality,
       50.0::double + l.l_quantity as score,
       l.l_quantity * 2 as sub_1, 100 - l.l_quantity as sub_2,
       l.l_discount * 1000 as sub_3, l.l_tax * 1000 as sub_4
from lineitem l join supplier s on s.s_suppkey = l.l_suppkey"""),
    ("scores_1", "select rep, conv_date, quality, score, sub_1, sub_2, sub_3, sub_4 from scored where k = 1"),
    ("scores_2", "select rep, conv_date, quality, score, sub_1, sub_2, sub_3, sub_4 from scored where k = 2"),
    ("scores_3", "select rep, conv_date, quality, score, sub_1, sub_2, sub_3, sub_4 from scored where k = 3"),
    ("scores_4", "select rep, conv_date, quality, score, sub_1, sub_2, sub_3, sub_4 from scored where k = 4"),
    ("tasks", """
select o.o_orderkey as task_id, o.o_custkey as org, s.s_name as owner,
       case o.o_orderstatus when 'P' then 'churn_risk' else 'other' end as slug,
       o.o_orderdate as inserted_at, o.o_orderkey % 4 = 0 as is_archived
from orders o cross join n join supplier s on s.s_suppkey = o.o_custkey % n.k"""),
    ("signals", """
select s.s_name as rep, e.user_id as org, cast(e.ts as date) - 9345 as analysis_date,
       row_number() over (partition by e.user_id order by e.ts desc, e.event_id desc) = 1 as is_latest,
       e.value as risk_score,
       case when e.value > 200 then 'critical' when e.value > 100 then 'high' else 'low' end as risk_level,
       e.event_type = 'error' as cancel_intent, e.value / 500 as sentiment
from events e cross join n join supplier s on s.s_suppkey = e.user_id % n.k"""),
    ("snapshots", """
select cast(date '1998-06-03' + to_days(cast(d.i as int)) as date) as snapshot_date, s.s_name as rep,
       ((s.s_suppkey * 7 + d.i * 3) % 101) / 100.0::double as composite_score,
       ((s.s_suppkey + d.i) % 50) / 10.0::double as ars_per_day,
       case when s.s_suppkey % 5 = 0 then null else cast(50 + (s.s_suppkey + d.i) % 50 as decimal(38,0)) end as avg_call_score,
       case when s.s_suppkey % 4 = 0 then null else ((s.s_suppkey + d.i) % 11) / 10.0::double end as ret_sla_pct,
       case when s.s_suppkey % 3 = 0 then null else ((s.s_suppkey + d.i) % 6) / 5.0::double end as renewal_m2_pct,
       case when d.i % 3 = 0 then null else (s.s_suppkey + d.i) % 7 end as daily_ar_count
from supplier s cross join (select unnest(range(14)) as i) d"""),
]

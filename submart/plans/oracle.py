"""DuckDB SQL giving the expected result of each driver query.

Views ``events``, ``orders``, ``customer``, ``nation``, ``region`` (and the
driver's other tables) are registered by the caller.
"""

from __future__ import annotations

_USAGE = """u as (select user_id as subs_key, ts as evnt_strt_ts,
    case when event_type = 'purchase' then 'D' else 'V' end as serv_type_cd,
    cast(round(value * 100) as bigint) as dwld_vlum_qty,
    case when event_type = 'view' then null else event_id % 97 end as upld_vlum_qty,
    case when event_id % 5 = 0 then null else event_id % 13 end as actl_data_vlum_qty,
    cast(1 as bigint) as rnd_unit_cnt from events)"""

_SUMS = """
  cast(coalesce(sum(case when serv_type_cd = 'D' then coalesce(dwld_vlum_qty, 0) end), 0) as bigint) as dwld_vlum_qty,
  cast(coalesce(sum(case when serv_type_cd = 'D' then coalesce(upld_vlum_qty, 0) end), 0) as bigint) as upld_vlum_qty,
  cast(coalesce(sum(case when serv_type_cd = 'D' then coalesce(actl_data_vlum_qty, 0) end), 0) as bigint) as actl_data_vlum_qty,
  cast(coalesce(sum(case when serv_type_cd = 'D' then coalesce(rnd_unit_cnt, 0) end), 0) as bigint) as data_rnd_unit_qty"""


def _daily(start: str) -> str:
    return f"""select subs_key,{_SUMS},
  cast(evnt_strt_ts as date) as evnt_strt
from u where cast(evnt_strt_ts as date) >= {start}
group by subs_key, cast(evnt_strt_ts as date)"""


def _enrich(run_date: str) -> str:
    return f"""select a.c_custkey as subs_key, cast(a.c_custkey % 30 as int) as subs_stts_key,
  coalesce(b.n_name, '~UNK') as subs_stts_ds, a.c_nationkey % 7 as cust_type_key,
  coalesce(c.r_name, '~UNK') as cust_type_ds, '{run_date}' as run_date
from customer a left join nation b on a.c_custkey % 30 = b.n_nationkey
left join region c on a.c_nationkey % 7 = c.r_regionkey"""


_ENRICH = _enrich("2024-01-25")


def _profile_ctes(first_day: str | None) -> str:
    return f"""with {_USAGE},
d as ({_daily(first_day) if first_day else _daily("date '0001-01-01'")}),
en as (select cast(subs_key as varchar) as subs_key, subs_stts_key, subs_stts_ds, cust_type_ds from ({_ENRICH}) z),
ac as (select * from (select o_custkey, o_orderkey, o_orderpriority,
    rank() over (partition by o_custkey order by o_orderdate desc) as rnk
    from orders where cast(o_orderdate as date) <= date '2024-01-25') z where rnk = 1)"""


_PROFILE_COLUMNS = """a.c_custkey as subs_key, a.c_name as subs_id, en.subs_stts_ds,
  cast(a.c_custkey % 30 as int) as subs_stts_key, en.cust_type_ds, cast(null as varchar) as subs_prim_rsrc_valu,
  cast(null as varchar) as serv_tech_nm, a.c_mktsegment as prod_nm, {ts} as subs_orig_actv_ts,
  {ts} as subs_stts_efft_ts, cast(null as varchar) as sold_imei_id, a.c_custkey as subs_prim_acct_key,
  a.c_nationkey % 7 as cust_type_key, cast(null as int) as prod_type_key, cast(null as int) as subs_main_offr_key,
  a.c_custkey as prim_acct_key, cast(a.c_custkey % 30 as int) as subs_stts_rsn_key, e.o_custkey as acct_key,
  e.o_orderkey as acct_id, cast(null as int) as acct_stts_key, e.o_orderpriority as xtrn_id,
  f.n_nationkey as cust_key, f.n_name as cust_id, f.n_regionkey as cust_stat_key""".replace(
    "{ts}", "cast(null as timestamp with time zone)")
_MEASURES = ("dwld_vlum_qty", "upld_vlum_qty", "actl_data_vlum_qty", "data_rnd_unit_qty")
_PROFILE_JOINS = """from customer a left join en on a.c_custkey = try_cast(en.subs_key as bigint)
left join ac e on a.c_custkey = e.o_custkey
left join nation f on a.c_nationkey = f.n_nationkey"""


def _profile_as_written(run_date: str, ctes: str) -> str:
    sums = ", ".join(f"cast(sum(g.{m}) as bigint) as {m}" for m in _MEASURES)
    return f"""{ctes}
select {_PROFILE_COLUMNS}, {sums}, '{run_date}' as run_date
{_PROFILE_JOINS}
left join d g on a.c_custkey = g.subs_key
group by a.c_custkey, a.c_name, a.c_mktsegment, a.c_nationkey, en.subs_stts_ds, en.cust_type_ds, en.subs_stts_key,
  e.o_custkey, e.o_orderkey, e.o_orderpriority, f.n_nationkey, f.n_name, f.n_regionkey, g.subs_key,
  {", ".join("g." + m for m in _MEASURES)}"""


# run 1 (2024-01-24) writes the days from its window's start on; run 2's days are among them
_JOBS = " union all ".join(f"select * from ({_profile_as_written(day, _profile_ctes("date '2024-01-24' - 40"))}) p"
                           for day in ("2024-01-24", "2024-01-25"))

ORACLE_SQL = {
    "scd1_window": """select event_id, user_id, event_type from events
where cast(ts as date) >= date '2024-01-25' - 10""",

    "scd1_full": "select event_id, user_id, event_type from events",

    "scd4_asof_latest": """select o_custkey, o_orderkey, o_orderstatus, cast(rnk as int) as rnk from (
  select *, rank() over (partition by o_custkey order by o_orderdate desc) as rnk
  from orders where cast(o_orderdate as date) <= date '1999-06-30') z where rnk = 1""",

    "scd4_asof_tie_break": """select o_custkey, o_orderkey, o_orderstatus, cast(rnk as int) as rnk from (
  select *, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) as rnk
  from orders where cast(o_orderdate as date) <= date '1999-06-30') z where rnk = 1""",

    "scd1_window_until": """select event_id, user_id, event_type from events
where cast(ts as date) >= date '2024-01-25' - 10 and cast(ts as date) <= date '2024-01-25'""",

    "scd4_active_route": "select c_custkey, c_name, c_nationkey from customer",

    "snapshot_read": """select o_orderkey, o_custkey from orders
where cast(o_orderdate as date) = date '1998-10-03'""",

    "source_dedup": "select event_id, user_id, event_type from (select distinct * from events) z",

    "usage_daily_aggr": f"with {_USAGE}\n{_daily("date '2024-01-25' - 10")}",

    "usage_monthly_aggr": f"""with {_USAGE}
select subs_key,{_SUMS},
  strftime(evnt_strt_ts, '%Y-%m-01') as aggr_grain
from u group by subs_key, strftime(evnt_strt_ts, '%Y-%m-01')""",

    # 2024-01-25 minus 10 days is 2024-01-15; aligned to its month: 2024-01-01
    "usage_monthly_aligned": f"""with {_USAGE}
select subs_key,{_SUMS},
  strftime(evnt_strt_ts, '%Y-%m-01') as aggr_grain
from u where cast(evnt_strt_ts as date) >= date '2024-01-01'
group by subs_key, strftime(evnt_strt_ts, '%Y-%m-01')""",

    "enrich_status_type": _ENRICH,

    "cast_key_left_join": """select a.c_custkey as subs_key, b.c_name as subs_id from customer a
left join (select case when c_custkey % 50 = 0 then 'bad' else cast(c_custkey as varchar) end as sk,
  c_name from customer) b on a.c_custkey = try_cast(b.sk as bigint)""",

    "profile_as_written": _profile_as_written("2024-01-25", _profile_ctes(None)),

    "profile_per_subscriber": f"""{_profile_ctes(None)},
s as (select subs_key, {", ".join(f"cast(sum({m}) as bigint) as {m}" for m in _MEASURES)} from d group by subs_key)
select distinct {_PROFILE_COLUMNS}, {", ".join("g." + m for m in _MEASURES)}, '2024-01-25' as run_date
{_PROFILE_JOINS}
left join s g on a.c_custkey = g.subs_key""",

    "profile_as_written_skewsafe": None,  # filled below: same rows as profile_as_written

    # run 1 (2024-01-20, window from 01-10) is overwritten from 01-15 on by
    # run 2 (2024-01-25); every day from 01-10 ends up complete
    "restate_usage_window": f"with {_USAGE}\n{_daily("date '2024-01-20' - 10")}",

    "full_table_overwrite": "select r_regionkey as k, r_name as name from region",

    "snapshot_write_read": f"{_enrich('2024-01-24')} union all {_ENRICH}",

    "source_dedup_full_row": """select user_id, event_type from (
  select distinct user_id, event_type, cast(ts as date) as day from events) z""",

    "enrich_salted_text_key": """select c_custkey as subs_key, n_name as subs_stts_ds
from customer left join nation on c_nationkey = n_nationkey""",

    "pipeline_profile_path": _JOBS,

    "pipeline_profile_catalog": _JOBS,

    "pipeline_profile_bucketed": _JOBS,

    "path_partitions_registered": f"{_enrich('2024-01-24')} union all {_ENRICH}",

    # append: both; overwrite: the second; ignore and error: the first, and error says so
    "write_modes_catalog": """with r as (select cast(r_regionkey as bigint) as k, r_name as name from region),
n as (select cast(n_nationkey as bigint) as k, n_name as name from nation)
select 'append' as mode, false as refused, * from r
union all select 'append', false, * from n
union all select 'overwrite', false, * from n
union all select 'ignore', false, * from r
union all select 'error', true, * from r""",
}

ORACLE_SQL["profile_as_written_skewsafe"] = ORACLE_SQL["profile_as_written"]
ORACLE_SQL["scd4_asof_latest_large"] = ORACLE_SQL["scd4_asof_latest"]

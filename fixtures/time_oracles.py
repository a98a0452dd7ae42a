"""The same results as ``fixtures.time_queries`` in SQL."""

from __future__ import annotations

from fixtures.oracles import FELONIES, ORACLES

TIME_ORACLES: dict[str, str] = {}

_START = "(o_orderkey * 37 + o_custkey) % 43200"
_BASE = "timestamp '2024-01-01 00:00:00'"
PLACED = f"""
    select o_orderkey, o_custkey % 150 as buyer, o_orderstatus,
        {_BASE} + to_minutes({_START}) as placed,
        case when o_orderkey % 50 <> 0
            then {_BASE} + to_minutes({_START} + 1 + (o_orderkey % 7) * (o_orderkey % 411)) end as until
    from orders
"""


def _as_of(condition: str) -> str:
    return f"""
        with placed as ({PLACED}),
        ranked as (
            select event_id, o_orderkey, o_orderstatus,
                row_number() over (partition by event_id order by placed desc, o_orderkey desc) as n
            from events join placed on user_id = buyer and {condition}
        )
        select event_id, o_orderkey, o_orderstatus
        from events left join (select * from ranked where n = 1) using (event_id)
    """


TIME_ORACLES["as_of_orders"] = _as_of("placed <= ts")
TIME_ORACLES["as_of_orders_within"] = _as_of("placed < ts and placed >= ts - interval 6 hours")
TIME_ORACLES["range_join_valid_orders"] = f"""
    with placed as ({PLACED})
    select event_id, o_orderkey from events join placed
        on user_id = buyer and placed <= ts and (until is null or ts < until)
"""
TIME_ORACLES["range_join_merged"] = f"""
    with placed as ({PLACED})
    select event_id, o_orderkey from events left join placed
        on user_id = buyer and placed <= ts and (until is null or ts < until)
"""
TIME_ORACLES["range_join_values"] = """
    select p_partkey, o_orderkey from part join orders
        on o_orderkey % 20 = 0 and o_totalprice / 100 <= p_retailprice
        and p_retailprice < o_totalprice / 100 + o_custkey % 40
"""



def _sessions(key: str, gap: str, more: str = "") -> str:
    """Rows sorted by time; a session begins where all earlier reaches have ended."""
    return f"""
        with reaches as (select {key}, ts, ts + {gap} as until from events),
        marked as (
            select *, case when ts <= max(until) over (
                partition by {key} order by ts, until rows between unbounded preceding and 1 preceding
            ) then 0 else 1 end as begins from reaches
        ),
        numbered as (
            select *, sum(begins) over (partition by {key} order by ts, until rows unbounded preceding) as n from marked
        )
        select {key}, min(ts) as window_start, max(until) as window_end, count(*) as cnt{more}
        from numbered group by {key}, n
    """


_IDLE = """(case event_type when 'purchase' then interval 8 hours when 'error' then interval 20 minutes
    else interval 2 hours end)"""
TIME_ORACLES["sessions_of_users"] = _sessions("user_id", _IDLE, ", count(*) as ones")
TIME_ORACLES["sessions_of_types"] = _sessions("event_type", "interval 5 minutes")
TIME_ORACLES["stream_sessions"] = f"""
    with found as ({_sessions("user_id", "interval 90 minutes")}),
    mark as (select max(ts) - interval 1 hour as upto from events)
    select user_id, window_start, window_end, cnt from found, mark
    where window_end <= date_trunc('millisecond', upto)
"""


def _grouped(keys: list[str], sets: list[list[str]], source: str, more: str = "") -> str:
    """One plain GROUP BY per grouping, the bits of left out keys added up by hand."""
    parts = []
    for some in sets:
        bits = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in some)
        named = ", ".join(k if k in some else f"cast(null as {'bigint' if k == 'yr' else 'varchar'}) as {k}" for k in keys)
        by = f"group by {', '.join(some)}" if some else "having count(*) > 0"
        parts.append(f"select {named}, {bits}::bigint as grouping_id, count(*)::bigint as cnt{more} from ({source}) {by}")
    return " union all ".join(parts)


_LINES = "select l_returnflag, l_linestatus, year(l_shipdate) as yr, cast(l_quantity as bigint) as quantity from lineitem"
_FLAGS = ["l_returnflag", "l_linestatus", "yr"]
_CUBE = [[k for i, k in enumerate(_FLAGS) if mask >> i & 1] for mask in range(8)]
TIME_ORACLES["cube_of_lines"] = _grouped(
    _FLAGS, _CUBE, _LINES.replace("year(l_shipdate)", "case when l_suppkey % 7 <> 0 then year(l_shipdate) end"),
    ", sum(quantity)::bigint as quantity",
)
_ROLL = ["yr", "l_returnflag", "l_linestatus"]
TIME_ORACLES["rollup_of_lines"] = _grouped(_ROLL, [_ROLL[:n] for n in range(4)], _LINES)
TIME_ORACLES["chosen_groupings"] = _grouped(_FLAGS, [["l_returnflag", "yr"], ["l_linestatus"], []], _LINES)

_DATED = """
    select l_orderkey, l_linenumber, l_returnflag, date_diff('day', date '1990-01-01', l_shipdate::date)::int as day,
        cast(l_quantity as bigint) as quantity from lineitem
"""
TIME_ORACLES["running_quantity"] = f"""
    select *, sum(quantity) over (partition by l_returnflag order by day)::bigint as total from ({_DATED})
"""
TIME_ORACLES["quantity_of_a_month"] = f"""
    select *, sum(quantity) over w::bigint as total, count(*) over w as lines from ({_DATED})
    window w as (partition by l_returnflag order by day range between 30 preceding and current row)
"""
TIME_ORACLES["sketched_users"] = """
    select ((day(ts) - 1) // 10)::int as third, count(*) as n, count(distinct event_id) as n_ids,
        true as distinct_near, true as median_near, true as high_near
    from events group by 1
"""
TIME_ORACLES["bucketed_join"] = """
    select o_orderpriority, count(*) as cnt, sum(l_quantity) as quantity
    from lineitem join orders on l_orderkey = o_orderkey group by 1
"""
TIME_ORACLES["partitioned_read"] = """
    select o_orderkey, o_orderstatus, year(o_orderdate) as yr from orders
    where o_orderstatus = 'F' and year(o_orderdate) = 1997
"""

_PAIRS = """
    select v.event_id as view_id, b.event_id as buy_id
    from events as v join events as b on v.user_id = b.user_id
        and b.ts >= v.ts and b.ts <= v.ts + interval 6 hours
    where v.event_type = 'view' and b.event_type = 'purchase'
"""
TIME_ORACLES["stream_join_purchases"] = _PAIRS
# Both sides' watermarks stand 10 minutes before their latest row; the earlier one rules.
TIME_ORACLES["stream_join_lost_views"] = f"""
    with pairs as ({_PAIRS}),
    mark as (
        select least(max(ts) filter (event_type = 'view'), max(ts) filter (event_type = 'purchase'))
            - interval 10 minutes as upto
        from events
    )
    select view_id, buy_id from pairs
    union all
    select event_id, null from events, mark
    where event_type = 'view' and ts + interval 6 hours < upto
        and not exists (select 1 from pairs where view_id = event_id)
"""
TIME_ORACLES["stream_drop_repeats"] = "select distinct user_id, event_type from events"
TIME_ORACLES["uncommon_events_stream_large"] = ORACLES["uncommon_events"]

# Rows of the second part whose window had ended by the watermark of the first are left out.
TIME_ORACLES["felonies_without_late_ones"] = f"""
    with felonies as (select *, cast(CMPLNT_NUM as bigint) % 10 = 0 as late from {FELONIES}),
    mark as (select max(moment) - interval 36 hours as upto from felonies where not late)
    select date_trunc('hour', moment) as window_start,
        date_trunc('hour', moment) + interval 1 hour as window_end,
        BORO_NM as "Borough", count(*) as "Felonies"
    from felonies, mark
    where not late or date_trunc('hour', moment) + interval 1 hour > upto
    group by all
"""
TIME_ORACLES["counts_without_late_rows"] = """
    with rows as (
        select event_type, ts, event_id % 10 = 0 as late,
            time_bucket(interval 6 hours, ts, timestamp '2000-01-01') as b
        from events
    ),
    marks as (select max(ts) filter (not late) - interval 2 days as first, max(ts) - interval 2 days as last from rows)
    select b as window_start, b + interval 6 hours as window_end, event_type, count(*) as cnt
    from rows, marks
    where b + interval 6 hours <= date_trunc('millisecond', last)
        and (not late or b + interval 6 hours > date_trunc('millisecond', first))
    group by all
"""
TIME_ORACLES["error_alerts"] = """
    with marks as (select max(ts) filter (event_type = 'error') - interval 1 hour as upto from events),
    steps as (
        select user_id, time_bucket(interval 10 minutes, ts, timestamp '2000-01-01') + interval 10 minutes as moment, 1 as n
        from events where event_type = 'error'
    ),
    moves as (
        select user_id, moment, n from steps
        union all select user_id, moment + interval 12 hours, -n from steps
    ),
    levels as (
        select user_id, moment, sum(sum(n)) over (partition by user_id order by moment) as hits
        from moves, marks where moment <= upto group by user_id, moment
    ),
    turns as (
        select *, hits >= 3 as raised, coalesce(lag(hits >= 3) over (partition by user_id order by moment), false) as was
        from levels
    )
    select user_id, moment as "time", hits::bigint as hits, raised from turns where raised <> was
"""

"""The same results as ``fixtures.queries`` in SQL, each written without regard to the Spark form."""

from __future__ import annotations


from fixtures.inputs import COMPLAINT, RAW_SURVEY, RESPONDENT
from lakeops.plans import values
from lakeops.plans.survey import CODES, FLAGS, NUMBERS

ORACLES: dict[str, str] = {}


def rounded(expression: str) -> str:
    """Half-up rounding of the decimal text of a double to 2 digits."""
    return f"round(cast({expression} as decimal(30, 9)), 2)::double"


def share(part: str, whole: str, scale: str = "100.0") -> str:
    return rounded(f"{scale}::double * ({part}) / nullif({whole}, 0)")


def case(column: str, book: dict, default: str = "null") -> str:
    arms = " ".join(f"when {code!r} then '{label}'" for code, label in book.items())
    return f"case {column} {arms} else {default} end"


# Draws: the 64-bit hash of a non-negative key, computed step by step on 128-bit integers.

P1, P2, P3 = 0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
P4, P5 = 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
WORD = 2**64

# Hash of the seed, the draw's index and a key without nulls, for draws 0, 1 and 2.
STARTS = {
    7: (0xdfcf5ca1fd0b61d9, 0x5280c0523b15f5dd, 0x4f9c7fa0013fddda),
    11: (0x2d7ed744602ca33c, 0xaf50d02ed4c65e44, 0xf09d936d38b3af57),
}


def _big(number: int) -> str:
    return f"{number}::uhugeint"


def _rotated(value: str, bits: int) -> str:
    return f"({value} * {_big(2**bits)} % {_big(WORD)} + {value} // {_big(2 ** (64 - bits))})"


def draws(source: str, key: str, seed: int) -> str:
    """``source`` with the three uniform columns ``explore``, ``which`` and ``spin``, from ``key``."""
    seeds = dict(zip(("explore", "which", "spin"), STARTS[seed]))

    def step(expression: str, **extra: str) -> str:
        return ", ".join(
            f"{expression.format(v=name, start=extra.get(name, ''))} as {name}" for name in seeds
        )

    starts = {
        name: _big((begin + P5 + 8) % WORD)
        for name, begin in seeds.items()
    }
    first = ", ".join(f"{key}::uhugeint * {_big(P2)} % {_big(WORD)} as {name}" for name in seeds)
    steps = [
        step(_rotated("{v}", 31)),
        step(f"xor({{v}} * {_big(P1)} % {_big(WORD)}, {{start}})", **starts),
        step(_rotated("{v}", 27)),
        step(f"({{v}} * {_big(P1)} % {_big(WORD)} + {_big(P4)}) % {_big(WORD)}"),
        step(f"xor({{v}}, {{v}} // {_big(2**33)}) * {_big(P2)} % {_big(WORD)}"),
        step(f"xor({{v}}, {{v}} // {_big(2**29)}) * {_big(P3)} % {_big(WORD)}"),
        step(f"xor({{v}}, {{v}} // {_big(2**32)})"),
        step(f"({{v}} // {_big(2**11)})::double / {2**53}::double"),
    ]
    text = f"select *, {first} from {source}"
    for replacement in steps:
        text = f"select * replace ({replacement}) from ({text})"
    return text


def wheel(labels: list[str], limits: list[str]) -> str:
    """Label by the draws ``explore``, ``which`` and ``spin``."""
    arms = " ".join(
        f"when spin <= {limit} then '{label}'" for label, limit in zip(labels[:-1], limits)
    )
    listed = ", ".join(f"'{label}'" for label in labels)
    return (
        f"case when explore <= 0.1 then ([{listed}])[floor(which * {len(labels)})::int + 1] "
        f"{arms} else '{labels[-1]}' end"
    )


# Shares, indexes and scores.

ORACLES["count_by"] = """
    select l_returnflag, l_linestatus, count(*) as cnt from lineitem group by all
"""
ORACLES["share_of_total"] = f"""
    select c_mktsegment, {share("count(*)", "(select count(*) from customer)")} as percentage
    from customer group by c_mktsegment
"""
ORACLES["conditional_share"] = f"""
    with sizes as (select l_returnflag, count(*) as n from lineitem group by 1)
    select l_returnflag, {share("count(*)", "any_value(n)")} as percentage
    from lineitem join sizes using (l_returnflag)
    where l_discount >= 0.09 or l_tax >= 0.07 or l_quantity >= 48
    group by l_returnflag
"""
ORACLES["duration_stats"] = """
    with lengths as (
        select l_returnflag, l_quantity::int * 30 + l_linenumber as days from lineitem
    )
    select distinct l_returnflag, avg(days) over w as avg_days, min(days) over w as min_days,
        max(days) over w as max_days
    from lengths where days > 0 window w as (partition by l_returnflag)
"""


def _score(branches: dict[str, str], source: str, name: str, score: str) -> str:
    stacked = " union all ".join(
        f"select '{label}' as {name}, ({column})::double as answer from {source}"
        for label, column in branches.items()
    )
    part = "1.0::double / nullif(answer, 0) * (n::double / sum(n) over (partition by " + name + "))"
    return f"""
        with stacked as ({stacked}),
        frequencies as (
            select {name}, answer, count(*) as n from stacked where answer is not null group by all
        ), parts as (select {name}, {part} as part from frequencies)
        select {name}, {rounded("sum(part)")} as {score} from parts group by {name}
    """


ORACLES["weighted_code_score"] = _score(
    {"l_quantity": "l_quantity", "discount_pct": "l_discount * 100", "l_linenumber": "l_linenumber"},
    "lineitem",
    "question",
    "score",
)


def _index(source: str, group: str, category: str, name: str, size: str) -> str:
    extra = f", c.n as {size}" if size else ""
    value = "(g.n::double / c.n) / nullif(o.portion, 0)"
    return f"""
        with src as ({source}),
        c as (select {category}, count(*) as n from src group by 1),
        g as (select {category}, {group}, count(*) as n from src group by 1, 2),
        o as (
            select {group}, {share("count(*)", "(select count(*) from src)", "1.0")} as portion
            from src group by 1
        )
        select c.{category}, g.{group}, {rounded(value)} as {name}{extra}
        from c left join g on g.{category} = c.{category} left join o on o.{group} = g.{group}
    """


ORACLES["share_index"] = _index(
    "select * from orders", "o_orderstatus", "o_orderpriority", "share_index", "cnt"
)
ORACLES["modal_with_ties"] = """
    with located as (
        select n_regionkey, c_mktsegment, n_name, count(*) as n
        from customer join nation on c_nationkey = n_nationkey
        group by all
    )
    select n_regionkey, c_mktsegment, n_name from located as a
    where n = (
        select max(n) from located as b
        where a.n_regionkey = b.n_regionkey and a.c_mktsegment = b.c_mktsegment
    )
"""


# Ranks and changes.


def _top(source: str, group: str, category: str, k: int) -> str:
    return f"""
        with src as ({source}),
        counts as (select {group}, {category}, count(*) as cnt from src group by all),
        sized as (select *, (sum(cnt) over (partition by {group}))::bigint as total from counts)
        select *, {share("cnt", "total")} as percentage,
            (dense_rank() over (partition by {group} order by cnt desc))::int as ranking
        from sized
        qualify dense_rank() over (partition by {group} order by cnt desc) <= {k}
    """


ORACLES["topk_share"] = _top("select * from customer", "c_nationkey", "c_mktsegment", 3)
ORACLES["topk_values"] = """
    select l_suppkey, l_orderkey, l_quantity, l_tax,
        (dense_rank() over (partition by l_suppkey order by l_quantity desc))::int as ranking
    from lineitem
    qualify dense_rank() over (partition by l_suppkey order by l_quantity desc) <= 2
"""


def _change(source: str, entity: str, period: str, low: int, high: int, names: list[str]) -> str:
    count, portion, change = names
    return f"""
        with src as (select * from ({source}) where {period} between {low} and {high}),
        yearly as (select {period}, count(*) as n from src group by 1),
        counted as (
            select {period}, {entity}, count(*) as {count} from src
            where {entity} is not null group by 1, 2
        ),
        shares as (
            select counted.*, {share(count, "n")} as {portion} from counted join yearly using ({period})
        ),
        steps as (
            select *, {portion} - lag({portion}) over (partition by {entity} order by {period}) as step
            from shares
        )
        select {period}, {entity}, {count}, {portion}, {rounded("step")} as {change} from steps
    """


_changes = _change(
    "select o_orderstatus, year(o_orderdate)::int as yr from orders",
    "o_orderstatus",
    "yr",
    1996,
    2001,
    ["cnt", "share", "change"],
)
ORACLES["change_over_time"] = f"""
    select *, coalesce(cast(cast(change as decimal(10, 2)) as varchar), 'N/A') as change_text
    from ({_changes})
"""


def _patterns(source: str, outer: str, keys: str, k: int, columns: str) -> str:
    return f"""
        with src as ({source}),
        sizes as (select {outer}, count(*) as total from src group by 1),
        fractions as (
            select {outer}, {keys}, {share("count(*)", "any_value(total)", "1.0")} as percentage
            from src join sizes using ({outer}) group by {outer}, {keys}
        ), ranked as (
            select *, (dense_rank() over (partition by {outer} order by percentage desc))::int
                as ranking
            from fractions
        )
        select {columns} from ranked where ranking <= {k}
    """


ORACLES["mine_common_patterns"] = _patterns(
    "select *, year(l_shipdate)::int as yr from lineitem",
    "l_returnflag",
    "yr, l_linestatus",
    4,
    "*",
)
ORACLES["arrival_schedule"] = """
    with buckets as (select distinct (hour(ts) * 60 + minute(ts))::int as bucket from events)
    select bucket, (lead(bucket) over (order by bucket) - bucket)::int as gap from buckets
"""

# Cleaning and coding.


def _select(expressions: dict[str, str], source: str) -> str:
    return f"select {', '.join(f'{e} as {n}' for n, e in expressions.items())} from {source}"


RAW = _select({"RESPONDENT": RESPONDENT} | RAW_SURVEY, "lineitem")

ORACLES["select_cast"] = f"""
    select try_cast(V0022 as int) as V0022, try_cast(V9001 as int) as V9001, V0404::int as V0404
    from ({RAW})
"""
ORACLES["rename_and_drop"] = f"""
    select RESPONDENT, V1168 as PARENTS, V9003, V0062 as OFFENSE from ({RAW})
"""
ORACLES["missing_profile"] = """
    select count(*) filter (l_linenumber is null or l_linenumber in (9, 99, 999, 9999))
            as l_linenumber,
        count(*) filter (l_suppkey is null or l_suppkey in (9, 99, 999, 9999)) as l_suppkey,
        count(*) filter (try_cast(l_returnflag as int) is null
            or try_cast(l_returnflag as int) in (9, 99, 999, 9999)) as l_returnflag
    from lineitem
"""
ORACLES["decode"] = """
    select o_orderkey,
        case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'OPEN' end as label,
        case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'OPEN' else 'NEITHER' end
            as label_or_default
    from orders
"""
ORACLES["normalise_category"] = """
    select o_orderkey, case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'SOON'
        when o_orderpriority = '5-LOW' then 'LATER' else o_orderpriority end as priority
    from orders
"""
ORACLES["classify_by_prefix"] = """
    select o_orderkey, case when o_orderpriority like '1-U%' then 'EXCEPTION'
        when substr(o_orderpriority, 1, 2) in ('1-', '2-', '3-') then 'NUMBERED'
        else o_orderpriority end as priority
    from orders
"""
ORACLES["first_flag_label"] = """
    select l_orderkey, case when l_returnflag = 'A' then 'A' when l_linestatus = 'F' then 'F'
        else 'OTHER' end as label
    from lineitem
"""
ORACLES["recode_flag"] = """
    select l_orderkey, if(l_linenumber = 2, 0, l_linenumber)::int as flag from lineitem
"""
ORACLES["blank_negative"] = """
    select l_orderkey, l_returnflag, if(l_quantity >= 25, l_quantity - 25, null) as above_25
    from lineitem
"""
ORACLES["duration_total"] = f"""
    select RESPONDENT, V0391 * 365 + V0392 * 30 + V0393 * 7 + V0394 as days from ({RAW})
"""


# The decoded survey.


def _decoded() -> str:
    flags = " ".join(f"when {flag} = 1 then '{race}'" for flag, race in values.RACE_FLAGS.items())
    expressions = {"RESPONDENT": "RESPONDENT"}
    for code, name in NUMBERS.items():
        expressions[name] = f"if({code} < 0, null, {code})::int"
    for code, name in FLAGS.items():
        expressions[name] = f"(case when {code} = 2 then 0 when {code} >= 0 then {code} end)::int"
    expressions["RACE"] = f"case {flags} else 'OTHER' end"
    for code, (name, book) in CODES.items():
        expressions[name] = case(f"try_cast({code} as int)", book)
    total = "V0391 * 365 + V0392 * 30 + V0393 * 7 + V0394"
    expressions["JAIL_TIME_TOTAL_DAYS"] = f"if({total} < 0, null, {total})::int"
    return _select(expressions, f"({RAW})")


SURVEY = _decoded()

ORACLES["drop_unusable_columns"] = f"select RESPONDENT, V0022, V9003 from ({RAW})"
ORACLES["transform_for_consumption"] = SURVEY
ORACLES["racial_structure"] = f"""
    with s as ({SURVEY})
    select RACE as "Race", {share("count(*)", "(select count(*) from s)")} as "Percentage"
    from s group by RACE
"""
ORACLES["marital_status"] = f"""
    with s as ({SURVEY})
    select MARITAL_STATUS as "Marital_Status",
        {share("count(*)", "(select count(*) from s)")} as "Percentage"
    from s group by MARITAL_STATUS
"""
ORACLES["family_criminal_history"] = f"""
    with s as ({SURVEY}),
    marked as (
        select RACE, (FATHER_SERVED = 1 or MOTHER_SERVED = 1 or SIBLING_SERVED = 1) as served from s
    )
    select RACE, {share("count(*) filter (served)", "count(*)")} as PERCENTAGE
    from marked where RACE is not null group by RACE having bool_or(served)
"""
ORACLES["flat_sentence_stats"] = f"""
    with lengths as (
        select OFFENSE_TYPE, FLAT_YEARS * 365 + FLAT_MONTHS * 30 + FLAT_DAYS as days from ({SURVEY})
    )
    select OFFENSE_TYPE, avg(days) as AVG_DURATION_DAYS, min(days) as MIN_DURATION_DAYS,
        max(days) as MAX_DURATION_DAYS
    from lengths where days > 0 group by OFFENSE_TYPE
"""
ORACLES["most_common_feelings"] = _score(
    {feeling: feeling for feeling in values.FEELINGS}, f"({SURVEY})", "FEELING", "summed_score"
)
ORACLES["parental_status_per_race"] = f"""
    select RACE, PARENTAL_STATUS, percentage, ranking
    from ({_top(SURVEY, "RACE", "PARENTAL_STATUS", 5)})
"""
ORACLES["top_3_crimes_by_race"] = f"""
    select RACE, OFFENSE_TYPE, percentage as CRIME_PERCENTAGE
    from ({_top(SURVEY, "RACE", "OFFENSE_TYPE", 3)}) where RACE is not null
"""
ORACLES["race_share_scaled_by_crime"] = _index(SURVEY, "RACE", "OFFENSE_TYPE", "RACE_INDEX", "")
_years = _change(
    SURVEY, "RACE", "ADMISSION_YEAR", 2008, 2016, ["yearly_race_count", "share", "CHANGE"]
)
ORACLES["races_through_years"] = f"""
    select * replace (coalesce(cast(CHANGE as varchar), 'N/A') as CHANGE) from ({_years})
"""
ORACLES["victim_stats"] = f"""
    with violent as (
        select * from ({SURVEY})
        where OFFENSE_TYPE = 'VIOLENT_OFFENSE' and VIOLENT_TYPE is not null
    ),
    types as (
        select VIOLENT_TYPE, count(*) as n, {rounded("100 * avg(KNEW_VICTIM)")} as knew_vict_perc
        from violent group by 1
    ),
    usual as (
        select VIOLENT_TYPE, VICTIM_SEX, VICTIM_AGE_GROUP
        from violent where VICTIM_SEX is not null group by 1, 2, 3
        qualify rank() over (partition by VIOLENT_TYPE, VICTIM_SEX order by count(*) desc) = 1
    )
    select VIOLENT_TYPE, coalesce(v.VICTIM_SEX, 'unspecified') as vict_gender,
        {share("count(*)", "any_value(n)")} as gender_share,
        any_value(knew_vict_perc) as knew_vict_perc, u.VICTIM_AGE_GROUP
    from violent as v join types using (VIOLENT_TYPE)
    left join usual as u using (VIOLENT_TYPE, VICTIM_SEX)
    group by VIOLENT_TYPE, v.VICTIM_SEX, u.VICTIM_AGE_GROUP
"""

# Joins and assignment.

_percent = ", ".join(
    f"floor(count(*) filter (RESPONDENT % 11 % 6 = {i}) * 100.0::double / count(*)) as w{i}"
    for i in range(len(values.BOROUGHS))
)
WEIGHTS = f"""
    select OFFENSE_TYPE, RACE, {_percent} from ({SURVEY})
    where OFFENSE_TYPE is not null and RACE <> 'ASIAN' group by all
"""
ORACLES["left_join_two_keys"] = f"""
    select s.RESPONDENT, w.w0 as weight
    from ({SURVEY}) as s left join ({WEIGHTS}) as w
        on s.OFFENSE_TYPE = w.OFFENSE_TYPE and s.RACE = w.RACE
"""
ORACLES["left_join_large_dimension"] = """
    select l_orderkey, l_linenumber, l_partkey, o_orderstatus
    from lineitem left join orders on l_orderkey = o_orderkey
"""
ORACLES["cumulative_weights"] = """
    select l_orderkey, l_quantity / 100 as l_quantity,
        l_quantity / 100 + l_linenumber / 100 as l_linenumber,
        l_quantity / 100 + l_linenumber / 100 + l_discount / 100 as l_discount
    from lineitem
"""
ORACLES["cumulative_weights_compat"] = """
    with a as (select *, l_quantity / 100 as x from lineitem),
    b as (select *, (x + l_linenumber) / 100 as y from a),
    c as (select *, (y + l_discount) / 100 as z from b)
    select l_orderkey, x as l_quantity, x + y as l_linenumber, x + y + z as l_discount from c
"""
_labels = ["a", "b", "c"]
ORACLES["weighted_assign"] = f"""
    select event_id, {wheel(_labels, ["0.5", "0.8", "1.0"])} as label
    from ({draws("events", "event_id", 7)})
"""
_sums = [" + ".join(f"coalesce(w{j}, 0) / 100" for j in range(i + 1)) for i in range(6)]
MAPPED = f"""
    select s.OFFENSE_TYPE, s.RACE, {wheel(list(values.BOROUGHS), _sums)} as BOROUGH
    from ({draws(f"({SURVEY})", "RESPONDENT", 11)}) as s left join ({WEIGHTS}) as w
        on s.OFFENSE_TYPE = w.OFFENSE_TYPE and s.RACE = w.RACE
"""
_steps = ["coalesce(w0, 0) / 100"]
for _i in range(1, 6):
    _steps.append(f"({_steps[-1]} + coalesce(w{_i}, 0)) / 100")
ORACLES["add_borough_compat"] = f"""
    select s.OFFENSE_TYPE, s.RACE, {wheel(list(values.BOROUGHS), [" + ".join(_steps[: i + 1]) for i in range(6)])} as BOROUGH
    from ({draws(f"({SURVEY})", "RESPONDENT", 11)}) as s left join ({WEIGHTS}) as w
        on s.OFFENSE_TYPE = w.OFFENSE_TYPE and s.RACE = w.RACE
"""
PATTERNS = _patterns(
    MAPPED, "BOROUGH", "RACE, OFFENSE_TYPE", 4, "BOROUGH, RACE, OFFENSE_TYPE, ranking"
)
ORACLES["add_borough"] = MAPPED
ORACLES["common_patterns"] = PATTERNS
ORACLES["print_patterns"] = f"""
    select * from ({PATTERNS})
    order by BOROUGH, ranking, RACE nulls first, OFFENSE_TYPE nulls first
"""

# Sources and sinks.

ORACLES["csv_round_trip"] = "select * from customer"
ORACLES["tsv_inferred"] = "select c_custkey, c_acctbal, c_mktsegment from customer"
ORACLES["sql_over_frame"] = """
    select l_returnflag, count(*) as cnt, sum(l_quantity) as quantity from lineitem group by 1
"""
ORACLES["publish_and_parse"] = "select o_orderkey, o_orderstatus, o_totalprice from orders"
ORACLES["parse_json"] = "select cast(props->>'$.k' as bigint) as k from events"
ORACLES["event_times"] = """
    select cast(event_id as varchar) as CMPLNT_NUM, date_trunc('second', ts) as event_time,
        strftime(ts, '%Y-%m-%dT%H:%M:%S') as RPT_DT
    from events
"""
NEAR = "sqrt(pow(user_id - 75, 2) + pow(value - 20, 2)) <= 30"
ORACLES["geofence"] = f"select event_id, {NEAR} as inside from events"

# Event-time windows.

_hourly = """
    select date_trunc('hour', ts) as window_start,
        date_trunc('hour', ts) + interval 1 hour as window_end, event_type, count(*) as cnt
    from events group by all
"""
ORACLES["tumbling_counts"] = _hourly
ORACLES["tumbling_counts_ordered"] = _hourly
ORACLES["window_status"] = f"""
    with w as (select *, time_bucket(interval 2 hours, ts, timestamp '2000-01-01') as b from events)
    select b as window_start, b + interval 2 hours as window_end,
        count(*) filter ({NEAR}) as hits,
        if(count(*) filter ({NEAR}) >= 3, 'unsafe', 'safe') as status
    from w group by b
"""
ORACLES["uncommon_events"] = """
    with days as (
        select event_type, day(ts) as d from events group by 1, 2
        qualify dense_rank() over (partition by event_type order by count(*) desc) <= 4
    )
    select event_id, event_type from events as e
    where not exists (
        select 1 from days where days.event_type = e.event_type and days.d = day(e.ts)
    )
"""
ORACLES["uncommon_events_large"] = ORACLES["uncommon_events"]

# Complaint jobs.

FEED = f"""
    select *, date_trunc('second', ts) as moment from ({_select({"ts": "ts"} | COMPLAINT, "events")})
"""


def window_label(start: str, hours: int) -> str:
    pattern = "'%Y-%m-%d %H:%M:%S'"
    return (
        f"'[' || strftime({start}, {pattern}) || ', ' || "
        f"strftime({start} + interval {hours} hours, {pattern}) || ']'"
    )


def _hourly_counts(key: str, name: str) -> str:
    return f"""
        select {window_label("date_trunc('hour', moment)", 1)} as window_str, {key} as {name},
            count(*) as complaints_count
        from ({FEED}) group by all
    """


FELONIES = f"({FEED}) where LAW_CAT_CD = 'FELONY' and BORO_NM <> 'UNKNOWN'"
ORACLES["complaints_per_hour_and_borough"] = _hourly_counts("BORO_NM", "boro_nm")
ORACLES["most_common_complaints"] = _hourly_counts("OFNS_DESC", "crime")
ORACLES["unsafest_boroughs"] = f"""
    select date_trunc('hour', moment) as window_start,
        date_trunc('hour', moment) + interval 1 hour as window_end,
        BORO_NM as "Borough", count(*) as "Felonies"
    from {FELONIES} group by all
"""
ORACLES["unsafest_boroughs_watermark"] = ORACLES["unsafest_boroughs"]
ORACLES["location_safety"] = f"""
    with felonies as (
        select time_bucket(interval 2 hours, moment, timestamp '2000-01-01') as b,
            sqrt(pow(Longitude + 73.99::double, 2) + pow(Latitude - 40.73::double, 2)) <= 0.06::double
                as near
        from {FELONIES}
    )
    select {window_label("b", 2)} as window_str,
        case when count(*) filter (near) >= 3 then 'unsafe' else 'safe' end as safety
    from felonies group by b
"""
ORACLES["uncommon_crimes"] = f"""
    with patterns as ({PATTERNS}),
    classes(description, class) as (values
        ('ROBBERY,HOME INVASION', 'Violent_Offense'), ('LARCENY,PETIT FROM AUTO', 'Property_Offense'),
        ('CANNABIS SALE, 3', 'Drug_Offense'), ('TRESPASS 3, CRIMINAL', 'Other_Offense'),
        ('TRESPASS 2, CRIMINAL', 'Public_Order_Offense'),
        ('MISCHIEF, CRIMINAL 4, BY FIRE', 'Other_Offense'), ('ASSAULT 3', 'Violent_Offense'),
        ('FORGERY,ETC.-MISD.', 'Other_Offense'), ('BURGLARY,RESIDENCE,DAY', 'Property_Offense'),
        ('CONTROLLED SUBSTANCE, SALE 5', 'Drug_Offense')
    ),
    races(text, race) as (values
        ('BLACK', 'BLACK'), ('WHITE HISPANIC', 'HISPANIC'), ('BLACK HISPANIC', 'HISPANIC'),
        ('WHITE', 'WHITE'), ('ASIAN / PACIFIC ISLANDER', 'ASIAN'),
        ('AMERICAN INDIAN/ALASKAN NATIVE', 'AMERICAN_INDIAN')
    ),
    labelled as (
        select f.*, coalesce(class, PD_DESC) as OFFENSE_TYPE, coalesce(race, SUSP_RACE) as RACE
        from ({FEED}) as f left join classes on PD_DESC = description
        left join races on SUSP_RACE = text
    )
    select CMPLNT_NUM, strftime(moment, '%H:%M:%S') as CMPLNT_FR_TM, SUSP_RACE, PD_DESC, BORO_NM,
        OFFENSE_TYPE
    from labelled as l
    where not exists (
        select 1 from patterns as p where p.BOROUGH = l.BORO_NM and p.RACE = l.RACE
            and lower(p.OFFENSE_TYPE) = lower(l.OFFENSE_TYPE)
    )
"""


def _archive() -> str:
    known = {"CMPLNT_FR_DT": "strftime(moment, '%m/%d/%Y')", "CMPLNT_FR_TM": "strftime(moment, '%H:%M:%S')"}
    known["RPT_DT"] = "strftime(moment, '%Y-%m-%dT%H:%M:%S')"
    known |= {name: name for name in COMPLAINT}
    kinds = {"string": "varchar", "long": "bigint", "float": "float", "double": "double"}
    columns = {}
    for field in values.COMPLAINT_SCHEMA.fields:
        kind = kinds[field.dataType.typeName()]
        columns[field.name] = f"cast({known.get(field.name, 'null')} as {kind})"
    return _select(columns, f"({FEED})")


ORACLES["save_to_lake"] = _archive()

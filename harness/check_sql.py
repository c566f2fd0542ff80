"""The SQL each query is checked against, over the given tables as views.

Written for DuckDB, from the event feed up. It restates every result in plain SQL and shares only the
feed's column expressions with the Spark side.
"""

from __future__ import annotations

from eventmill.schema import CRITICAL_COLUMNS, KNOWN_EVENT_TYPES, REQUIRED_COLUMNS
from harness import feed

KNOWN = ", ".join(f"'{t}'" for t in KNOWN_EVENT_TYPES)
LAG = "cast(floor(value / 10) as bigint)"

BASE = """
base as (
  select event_id, ts, user_id, event_type, value,
         try_cast(json_extract_string(props, '$.k') as bigint) as k
  from events
)"""

# One row per raw record, already in staging's column names.
FEED = f"""{BASE},
feed as (
  select cast(event_id as varchar) as event_id,
         {feed.EVENT_TYPE} as event_type,
         user_id as actor_id,
         nullif({feed.ACTOR_LOGIN}, '') as actor_login,
         nullif(k, 0) as repo_id,
         case when k <> 0 then {feed.REPO_NAME} end as repo_name,
         {feed.ORG_ID} as org_id,
         case when event_type in ('purchase', 'view') then nullif({feed.ORG_LOGIN}, '') end as org_login,
         {feed.PAYLOAD} as payload,
         value < 100 as is_public,
         ts as created_at,
         date_trunc('hour', ts + to_minutes({LAG})) as land_hour
  from base
)"""


def scalar(path: str) -> str:
    return (
        f"case when json_type(payload, '{path}') not in ('OBJECT', 'ARRAY', 'NULL') "
        f"then json_extract_string(payload, '{path}') end"
    )


def whole(path: str) -> str:
    text = scalar(path)
    return f"case when regexp_full_match(trim({text}), '[+-]?[0-9]+') then try_cast({text} as bigint) end"


FLAT_COLUMNS = f"""
         {scalar('$.action')} as action,
         {scalar('$.ref')} as ref,
         {scalar('$.ref_type')} as ref_type,
         {whole('$.distinct_size')} as push_commit_count,
         {whole('$.number')} as pull_request_number,
         {whole('$.issue.number')} as issue_number"""

ROLLUP_COLUMNS = """
         cast(created_at as date) as activity_date,
         repo_id,
         count(*) as total_events,
         count(*) filter (where event_type = 'PushEvent') as push_events,
         count(*) filter (where event_type = 'WatchEvent') as star_events,
         count(*) filter (where event_type = 'ForkEvent') as fork_events,
         count(*) filter (where event_type = 'PullRequestEvent') as pull_request_events,
         count(*) filter (where event_type = 'IssuesEvent') as issue_events,
         count(distinct actor_id) as distinct_actors"""


def rollup(source: str) -> str:
    return f"select {ROLLUP_COLUMNS} from {source} where repo_id is not null group by 1, 2"


def latest(source: str, key: str, value: str) -> str:
    return (
        f"select {key}, {value} from {source} where {key} is not null "
        f"qualify row_number() over (partition by {key} "
        f"order by created_at desc, {value} desc nulls last) = 1"
    )


MARTS = f"""{FEED},
rollup_t as ({rollup('feed')}),
dim_repo_t as ({latest('feed', 'repo_id', 'repo_name')}),
dim_actor_t as ({latest('feed', 'actor_id', 'actor_login')})"""

# Records that landed under their own day: what the raw table holds after a load.
STORED = f"""{FEED},
stored as (select * from feed where cast(land_hour as date) = cast(created_at as date))"""

# The same after the first day was sent again without its issues.
RELOADED = f"""{STORED},
reloaded as (
  select * from stored
  where event_type <> 'IssuesEvent' or cast(land_hour as date) > (select min(cast(land_hour as date)) from feed)
)"""

FAULTY = f"""{BASE},
faulty_all as (
  select case when value < 0.5 then null when value > 300 then 'dup' else cast(event_id as varchar) end as event_id,
         case when value between 20 and 20.4 then null
              when value > 250 then 'odd-' || event_type
              else {feed.EVENT_TYPE} end as event_type,
         user_id as actor_id,
         nullif({feed.ACTOR_LOGIN}, '') as actor_login,
         k as repo_id,
         {feed.REPO_NAME} as repo_name,
         {feed.ORG_ID} as org_id,
         nullif({feed.ORG_LOGIN}, '') as org_login,
         {feed.PAYLOAD} as payload,
         true as is_public,
         case when not (value between 40 and 40.4) then ts end as created_at,
         cast(ts + to_hours({LAG}) as date) as land_date,
         value > 400 as has_extra
  from base
),
faulty as (select * from faulty_all where event_id is not null and created_at is not null)"""


def gate(source: str, day: str, present: dict[str, str]) -> str:
    """Six rows per day. ``present`` says, per required column, when a record carries it."""
    renamed = {"id": "event_id", "type": "event_type"}
    day_start = "cast(land_date as timestamp)"
    counts = [
        "count(*) as total",
        *[f"count({renamed.get(c, c)}) as {c}_count" for c in CRITICAL_COLUMNS],
        f"count(*) filter (where created_at between {day_start} - interval 6 hours "
        f"and {day_start} + interval 30 hours) as in_range",
        f"count(*) filter (where event_type in ({KNOWN})) as known",
        *[f"bool_or({present.get(c, 'true')}) as has_{c}" for c in REQUIRED_COLUMNS],
    ]
    missing = "concat_ws(',', " + ", ".join(f"case when not has_{c} then '{c}' end" for c in REQUIRED_COLUMNS) + ")"

    def check(name: str, column: str, judged: str, good: str) -> str:
        bad = f"({judged} - {good})"
        return (
            f"select land_date, '{name}' as \"check\", '{column}' as \"column\", "
            f"{bad} * 100 <= {judged} as success, total as element_count, total - {judged} as missing_count, "
            f"{bad} as unexpected_count, "
            f"case when {judged} > 0 then {bad} * cast(100 as double) / {judged} end as unexpected_percent, "
            "'' as detail from counts"
        )

    columns = (
        f"select land_date, 'columns_present' as \"check\", '*' as \"column\", {missing} = '' as success, "
        "total as element_count, cast(0 as bigint) as missing_count, "
        f"cast(case when {missing} = '' then 0 else len(string_split({missing}, ',')) end as bigint) as unexpected_count, "
        f"cast(null as double) as unexpected_percent, {missing} as detail from counts"
    )
    checks = [columns]
    checks += [check("not_null", c, "total", f"{c}_count") for c in CRITICAL_COLUMNS]
    checks += [
        check("in_range", "created_at", "created_at_count", "in_range"),
        check("in_set", "type", "type_count", "known"),
    ]
    return (
        f"dated as (select * replace ({day} as land_date) from {source}),\n"
        f"counts as (select land_date, {', '.join(counts)} from dated group by land_date)\n"
        + "\nunion all\n".join(checks)
    )


LISTINGS = """
hourly as (
  select date_trunc('hour', ts) as hour, sum(user_id) as remote,
         coalesce(sum(user_id) filter (where value < 200), 0) as local,
         max(value) as top, min(user_id) as lowest
  from events group by 1
),
grid as (
  select unnest(generate_series(min(hour), max(hour) + interval 2 hours, interval 1 hour)) as hour from hourly
),
sides as (
  select grid.hour, strftime(grid.hour, 'raw/%Y/%m/%d/%-H.json.gz') as path,
         case when top < 270 then cast(local as bigint) end as landed,
         coalesce(top > 90, false) as published,
         case when lowest > 0 then cast(remote as bigint) end as size
  from grid left join hourly using (hour)
)"""


def plan(forced: bool) -> str:
    fetch = "true" if forced else "landed is null"
    return f"""plan as (
  select hour, path,
         case when not published then 'not_found'
              when {fetch} then 'fetch'
              when size is null then 'not_found'
              when landed = size then 'skipped'
              else 'refetch' end as status, size, published
  from sides
)"""


PLANNED = "select hour, path, status, case when status = 'not_found' then 0 else coalesce(size, 0) end as bytes from plan"


def test_rows(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nunion all\n".join(
        f"select '{model}' as model, '{column}' as \"column\", '{test}' as test, f as failures, f = 0 as passed "
        f"from (select {count})"
        for model, column, test, count in rows
    )


def nulls(table: str, column: str) -> str:
    return f"count(*) filter (where {column} is null) as f from {table}"


def duplicates(table: str, column: str) -> str:
    return (
        f"count(*) as f from (select {column} from {table} where {column} is not null "
        f"group by 1 having count(*) > 1)"
    )


def orphans(child: str, column: str, parent: str) -> str:
    return (
        f"count(*) as f from {child} where {column} is not null "
        f"and not exists (select 1 from {parent} p where p.{column} = {child}.{column})"
    )


def unaccepted(table: str, column: str) -> str:
    return f"count(distinct {column}) as f from {table} where {column} not in ({KNOWN})"


def declared(stg: str, repos: str, actors: str, fact: str, agg: str) -> str:
    return test_rows(
        [
            ("stg_events", "event_id", "unique", duplicates(stg, "event_id")),
            ("stg_events", "event_id", "not_null", nulls(stg, "event_id")),
            ("stg_events", "event_type", "not_null", nulls(stg, "event_type")),
            ("stg_events", "event_type", "accepted_values", unaccepted(stg, "event_type")),
            ("stg_events", "created_at", "not_null", nulls(stg, "created_at")),
            ("dim_repo", "repo_id", "unique", duplicates(repos, "repo_id")),
            ("dim_repo", "repo_id", "not_null", nulls(repos, "repo_id")),
            ("dim_actor", "actor_id", "unique", duplicates(actors, "actor_id")),
            ("dim_actor", "actor_id", "not_null", nulls(actors, "actor_id")),
            ("fct_events", "event_id", "unique", duplicates(fact, "event_id")),
            ("fct_events", "event_id", "not_null", nulls(fact, "event_id")),
            ("fct_events", "repo_id", "relationships", orphans(fact, "repo_id", repos)),
            ("fct_events", "actor_id", "relationships", orphans(fact, "actor_id", actors)),
            ("agg_daily_repo_activity", "activity_date", "not_null", nulls(agg, "activity_date")),
            ("agg_daily_repo_activity", "repo_id", "not_null", nulls(agg, "repo_id")),
        ]
    )


def model_rows(stg: str, listed: tuple[str, ...]) -> str:
    """(model, key, label, number) of every row of the named models."""
    rows = {
        "stg_events": f"event_id, event_type, actor_id from {stg}",
        "int_events_flattened": f"event_id, {scalar('$.action')}, {whole('$.distinct_size')} from {stg}",
        "fct_events": f"event_id, event_type, repo_id from {stg}",
        "agg_daily_repo_activity": "cast(repo_id as varchar), cast(activity_date as varchar), total_events from rollup_t",
        "dim_repo": "cast(repo_id as varchar), repo_name, repo_id from dim_repo_t",
        "dim_actor": "cast(actor_id as varchar), actor_login, actor_id from dim_actor_t",
    }
    parts = "\nunion all\n".join(f"select '{model}', {rows[model]}" for model in listed)
    return f"select * from ({parts}) t(model, key, label, number)"


ALL_MODELS = ("stg_events", "int_events_flattened", "fct_events", "agg_daily_repo_activity", "dim_repo", "dim_actor")

STORED_MARTS = f"""{STORED},
rollup_t as ({rollup('stored')}),
dim_repo_t as ({latest('stored', 'repo_id', 'repo_name')}),
dim_actor_t as ({latest('stored', 'actor_id', 'actor_login')})"""

FACT = f"""select event_id, event_type, actor_id, repo_id, org_id, is_public, {FLAT_COLUMNS}, created_at from feed"""


def check_sql() -> dict[str, str]:
    return {
        "hour_grid": """
            select hour, strftime(hour, 'raw/%Y/%m/%d/%-H.json.gz') as path,
                   strftime(hour, '%Y-%m-%d-%-H.json.gz') as key
            from (select unnest(generate_series(date_trunc('hour', min(ts)),
                         date_trunc('hour', max(ts)) - interval 1 hour, interval 1 hour)) as hour from events)""",
        "trailing_window": """
            select unnest(generate_series(date_trunc('hour', max(ts) - interval 26 hours),
                   date_trunc('hour', max(ts) - interval 2 hours) - interval 1 hour, interval 1 hour)) as hour
            from events""",
        "landed_hours": f"with {FEED} select distinct land_hour as hour, true as has_bytes from feed",
        "day_files": f"""with {FEED}
            select day, hour, strftime(land_hour, '%Y/%m/%d/%-H.json.gz') as path,
                   cast(row_number() over (partition by day order by hour) as integer) as rank
            from (select distinct land_hour, cast(land_hour as date) as day,
                         cast(extract(hour from land_hour) as integer) as hour from feed)""",
        "sync_plan": f"with {LISTINGS}, {plan(False)} {PLANNED}",
        "sync_plan_forced": f"with {LISTINGS}, {plan(True)} {PLANNED}",
        "sync_summary": f"""with {LISTINGS}, {plan(False)},
            result as (
              select case when status not in ('fetch', 'refetch') then status
                          when size is null then 'failed' else 'downloaded' end as status,
                     case when status = 'not_found' then 0 else coalesce(size, 0) end as bytes
              from plan
            )
            select count(*) as hours_requested,
                   count(*) filter (where status = 'downloaded') as downloaded,
                   count(*) filter (where status = 'skipped') as skipped,
                   count(*) filter (where status = 'not_found') as not_found,
                   count(*) filter (where status = 'failed') as failed,
                   cast(sum(bytes) as bigint) as total_bytes
            from result""",
        "jsonl_scan": f"""with {FEED}
            select event_id as id, event_type as type, actor_id, coalesce(actor_login, '') as actor_login,
                   repo_id, repo_name, org_id,
                   case when event_type in ('PullRequestEvent', 'WatchEvent') then coalesce(org_login, '') end as org_login,
                   payload, is_public as public_event, created_at, cast(land_hour as date) as land_date
            from feed""",
        "light_scan": f"""with {FEED}
            select event_id as id, event_type as type, created_at, cast(land_hour as date) as land_date from feed""",
        "sample_lines": f"""with {FEED}
            select event_id as id from feed
            where cast(land_hour as date) = (select min(cast(land_hour as date)) from feed)
            order by land_hour, cast(event_id as bigint) limit 2000""",
        "sample_lines_bounded": f"""with {FEED}
            select event_id as id from feed
            where cast(land_hour as date) = (select min(cast(land_hour as date)) from feed)
            order by land_hour, cast(event_id as bigint) limit 100""",
        "source_freshness": """
            select *, case when lag_seconds > 3 * 86400 then 'error' when lag_seconds > 86400 then 'warn'
                           else 'pass' end as status
            from (select max(ts) as max_created_at,
                         cast(epoch(timestamp '2024-02-01') as bigint)
                         - cast(floor(epoch(max(ts))) as bigint) as lag_seconds
                  from events)""",
        "gate_landed_days": f"""with {FEED},
            landed as (select *, cast(land_hour as date) as land_date from feed),
            {gate('landed', 'land_date', {'repo': 'repo_id is not null'})}""",
        "gate_faulty_days": f"with {FAULTY}, {gate('faulty_all', 'land_date', {'public': 'has_extra'})}",
        "gate_one_batch": f"""with {FAULTY}, {gate('faulty_all', "date '2024-01-01'", {'public': 'has_extra'})}""",
        "gate_failure_samples": f"""with {FAULTY},
            offenders as (
              select land_date, 'in_range' as "check", cast(created_at as varchar) as value from faulty_all
              where not (created_at between cast(land_date as timestamp) - interval 6 hours
                         and cast(land_date as timestamp) + interval 30 hours)
              union all
              select land_date, 'in_set', event_type from faulty_all where event_type not in ({KNOWN})
            )
            select * from offenders
            qualify row_number() over (partition by land_date, "check" order by value) <= 20""",
        "gate_unlisted_keys": f"""with {FAULTY}
            select land_date, 'extra' as key, count(*) as records from faulty_all where has_extra group by 1""",
        "gate_failure_values": f"""with {FAULTY},
            offenders as (
              select land_date, 'in_range' as "check", cast(created_at as varchar) as value from faulty_all
              where not (created_at between cast(land_date as timestamp) - interval 6 hours
                         and cast(land_date as timestamp) + interval 30 hours)
              union all
              select land_date, 'in_set', event_type from faulty_all where event_type not in ({KNOWN})
            )
            select *, count(*) as records from offenders group by all""",
        "gate_landed_unlisted_keys": f"""with {FAULTY}
            select land_date, unnest(['extra', 'public']) as key, count(*) as records
            from faulty_all where has_extra group by 1
            union all
            select land_date, unnest(['org', 'payload']), count(*) from faulty_all group by 1""",
        "reloaded_rows": f"""with {RELOADED}
            select event_id as id, event_type as type, repo_id, cast(payload as varchar) as payload, created_at,
                   cast(created_at as date) as event_date from reloaded""",
        "run_outcome": f"""with {FEED},
            days as (
              select cast(land_hour as date) as land_date, count(*) as total,
                     count(*) filter (where cast(land_hour as date) = cast(created_at as date)) as mine,
                     bool_or(cast(land_hour as date) = date '{feed.LOST_DAY}'
                             and extract(hour from land_hour) between {feed.LOST_HOURS[0]} and {feed.LOST_HOURS[1]}) as lost
              from feed group by 1
            ),
            judged as (
              select *, case when land_date = date '{feed.MISSING_DAY}' then 'missing'
                             when lost then 'incomplete' else 'complete' end as coverage,
                     land_date = date '{feed.ODD_DAY}' as odd, max(land_date) over () as newest
              from days
            )
            select land_date, coverage,
                   case when coverage = 'complete' then case when odd then 'failed' else 'passed' end end as gate,
                   case when coverage = 'complete' and not odd then mine end as loaded,
                   case when coverage = 'complete' and not odd then total - mine end as rejected,
                   coverage = 'complete' and not odd and mine > 0 and land_date < newest - 20 as expired,
                   case when coverage <> 'complete' then 'coverage' when odd then 'gate' end as stopped_by
            from judged""",
        "reload_recovery": f"""with {RELOADED},
            rollup_t as ({rollup('reloaded')}),
            dim_repo_t as ({latest('reloaded', 'repo_id', 'repo_name')}),
            dim_actor_t as ({latest('reloaded', 'actor_id', 'actor_login')})
            {model_rows('reloaded', ALL_MODELS[2:])}""",
        "day_overwrite": f"""with {STORED}
            select cast(created_at as date) as event_date, event_type as type, count(*) as n_rows,
                   count(distinct event_id) as n_ids
            from stored group by 1, 2""",
        "loaded_row_count": f"""with {FEED}
            select cast(land_hour as date) as land_date,
                   count(*) filter (where cast(land_hour as date) = cast(created_at as date)) as loaded,
                   count(*) filter (where cast(land_hour as date) <> cast(created_at as date)) as rejected
            from feed group by 1""",
        "gated_load": f"""with {FEED},
            days as (
              select cast(land_hour as date) as land_date, cast(land_hour as date) <> date '{feed.ODD_DAY}' as passed, count(*) as records,
                     count(*) filter (where cast(land_hour as date) = cast(created_at as date)) as mine
              from feed
              where cast(land_hour as date) <> date '{feed.MISSING_DAY}'
                and not (cast(land_hour as date) = date '{feed.LOST_DAY}'
                         and extract(hour from land_hour) between {feed.LOST_HOURS[0]} and {feed.LOST_HOURS[1]})
              group by 1, 2
            )
            select land_date, records, passed, case when passed then 0 else records end as odd_types,
                   case when passed then mine end as loaded, case when passed then records - mine end as rejected,
                   case when passed and mine > 0 then mine end as stored
            from days""",
        "straggler_rejects": f"""with {FEED}
            select event_id as id, event_type as type, created_at, cast(land_hour as date) as event_date
            from feed where cast(land_hour as date) <> cast(created_at as date)""",
        "partition_retention": f"""with {STORED}
            select cast(created_at as date) as event_date, count(*) as n_rows from stored
            where cast(created_at as date) >= date '2024-03-15' - 60 group by 1""",
        "pruned_range_scan": f"""with {STORED}
            select event_type as type, count(*) as n_rows from stored
            where created_at >= date '2024-01-05' and created_at < date '2024-01-12' group by 1""",
        "daily_run": f"with {STORED_MARTS} {declared('stored', 'dim_repo_t', 'dim_actor_t', 'stored', 'rollup_t')}",
        "day_wise_rollup": f"with {STORED} {rollup('stored')}",
        "day_wise_dims": f"""with {STORED_MARTS}
            select 'repo' as dim, repo_id as id, repo_name as label from dim_repo_t
            union all select 'actor', actor_id, actor_login from dim_actor_t""",
        "repo_lookup": f"""with {STORED}
            select cast(created_at as date) as event_date, event_type, count(*) as events from stored
            where repo_id = (select repo_id from stored where repo_id is not null group by 1 order by count(*) desc, 1 limit 1) group by all""",
        "dims_after_expiry": f"""with {STORED},
            last_day as (select max(cast(land_hour as date)) as newest from feed),
            left_over as (
              select stored.* from stored, last_day
              where cast(land_hour as date) >= newest - 20 and (event_type <> 'IssuesEvent' or cast(land_hour as date) < newest)
            ),
            dim_repo_t as ({latest('left_over', 'repo_id', 'repo_name')}),
            dim_actor_t as ({latest('left_over', 'actor_id', 'actor_login')})
            {model_rows('left_over', ALL_MODELS[4:])}""",
        "tests_by_day": f"""with {FAULTY},
            kept as (
              select * from faulty where cast(created_at as date) = land_date
              and land_date >= (select max(land_date) from faulty_all) - 20
            ),
            repos as ({latest('kept', 'repo_id', 'repo_name')}),
            actors as ({latest('kept', 'actor_id', 'actor_login')}),
            rollup_t as ({rollup('kept')})
            {declared('kept', 'repos', 'actors', 'kept', 'rollup_t')}""",
        "duplicates_by_day": f"with {FAULTY} select event_id, count(*) as n from faulty group by 1 having count(*) > 1",
        "orphans_by_day": """
            select l_orderkey, count(*) as n from lineitem
            where l_orderkey is not null and l_orderkey not in (select o_orderkey from orders where o_totalprice > 150000)
            group by 1""",
        "mart_tables": f"with {STORED_MARTS} {model_rows('stored', ALL_MODELS)}",
        "dev_views": f"with {MARTS} {model_rows('feed', ALL_MODELS)}",
        "stg_events": f"with {FEED} select * exclude (land_hour) from feed",
        "stg_faulty_events": f"with {FAULTY} select * exclude (payload, land_date, has_extra) from faulty",
        "int_events_flattened": f"""with {FEED}
            select * exclude (payload, land_hour), {FLAT_COLUMNS} from feed""",
        "fct_events": f"with {FEED} {FACT}",
        "dim_repo": f"with {MARTS} select * from dim_repo_t",
        "dim_actor": f"with {MARTS} select * from dim_actor_t",
        "agg_daily_repo_activity": f"with {MARTS} select * from rollup_t",
        "daily_event_volume": f"""with {MARTS}
            select activity_date, cast(sum(total_events) as bigint) as total_events
            from rollup_t group by 1 order by 1""",
        "repo_totals": f"""with {MARTS}
            select repo_name, cast(sum(total_events) as bigint) as total_events
            from rollup_t join dim_repo_t using (repo_id) group by 1""",
        "top_repos": f"""with {MARTS}
            select repo_name, cast(sum(total_events) as bigint) as total_events
            from rollup_t join dim_repo_t using (repo_id)
            group by 1 order by 2 desc, 1 asc nulls last limit 10""",
        "most_active_hours": f"""with {FEED}
            select cast(extract(hour from created_at) as integer) as hour_of_day, count(*) as event_count
            from feed group by 1 order by 1""",
        "event_type_breakdown": f"""with {FEED}
            select event_type, count(*) as event_count from feed group by 1 order by 2 desc""",
        "total_events_tracked": f"with {MARTS} select cast(sum(total_events) as bigint) as total_events from rollup_t",
        "repositories_tracked": f"with {MARTS} select count(*) as repo_count from dim_repo_t",
        "contributors_tracked": f"with {MARTS} select count(*) as actor_count from dim_actor_t",
        "pull_request_activity": f"with {MARTS} select cast(sum(pull_request_events) as bigint) as pr_events from rollup_t",
        "model_tests": f"""with {FAULTY},
            repos as ({latest("(select * from faulty where event_type = 'PushEvent')", 'repo_id', 'repo_name')}),
            actors as ({latest("(select * from faulty where event_type = 'PushEvent' and actor_id > 20)", 'actor_id', 'actor_login')}),
            rollup_t as ({rollup('faulty')})
            {declared('faulty', 'repos', 'actors', 'faulty', 'rollup_t')}""",
        "test_unique": "select l_orderkey, count(*) as n from lineitem where l_orderkey is not null group by 1 having count(*) > 1",
        "test_not_null": f"with {FAULTY} "
        + test_rows(
            [
                ("stg_events", c, "not_null", nulls("faulty", c))
                for c in (
                    "event_id", "event_type", "actor_id", "actor_login", "repo_id", "repo_name",
                    "org_id", "org_login", "is_public", "created_at",
                )
            ]
        ),
        "test_accepted_values": """
            select p_brand, count(*) as n from part
            where p_brand not in ('Brand#11', 'Brand#12', 'Brand#13') group by 1""",
        "test_relationships": """
            select l_orderkey, count(*) as n from lineitem
            where l_orderkey is not null and l_orderkey not in (select o_orderkey from orders where o_totalprice > 100000)
            group by 1""",
    }

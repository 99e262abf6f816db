"""The same results in DuckDB SQL over the same tables."""

from __future__ import annotations

ISO = "'%Y-%m-%dT%H:%M:%S+00:00'"
ISO_US = "'%Y-%m-%dT%H:%M:%S.%f+00:00'"
AS_OF = "timestamp '2024-01-31 00:00:00'"
# The characters trimmed from text, by code point.
SPACES = "||".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def iso(c: str) -> str:
    """Instant as text, with a fraction only when there is one."""
    return (f"case when date_part('microsecond', {c}) % 1000000 = 0 then strftime({c}, {ISO}) "
            f"else strftime({c}, {ISO_US}) end")


CTES = {
    "feed_a": ((), """
        select 'C-' || c_custkey as record_id, c_name as name,
          'cust' || c_custkey || case when c_custkey % 50 = 7 then '.example.com'
            else '@example.com' end as email,
          case when c_custkey % 97 = 5 then null else c_acctbal end as value,
          'Source A' as source,
          cast(date '2024-01-01' + cast(c_custkey % 28 as int) as timestamp) as created_at,
          1 as source_rank, c_custkey as pos from customer"""),
    "feed_b": ((), """
        select 'C-' || o_custkey as record_id,
          'Customer#' || lpad(cast(o_custkey as varchar), 9, '0') as name,
          'cust' || o_custkey || '@example.com' as email, o_totalprice as value,
          'Source B' as source, cast(date_trunc('second', o_orderdate) as timestamp) as created_at,
          2 as source_rank, o_orderkey as pos from orders"""),
    "feed_c": ((), """
        select 'U-' || user_id as record_id,
          case when event_type <> 'error' then 'User ' || user_id end as name,
          'user' || user_id || '@example.com' as email, value as value, 'Source C' as source,
          cast(date_trunc('second', ts) as timestamp) as created_at,
          3 as source_rank, event_id as pos from events"""),
    "canon": (("feed_a", "feed_b", "feed_c"), """
        select * from feed_a union all select * from feed_b union all select * from feed_c"""),
    "checked": (("canon",), """
        select *, sha256(lower(record_id) || '|' || lower(coalesce(email, ''))) as record_hash,
          list_filter([case when coalesce(record_id, '') = '' then 'Missing record_id' end,
            case when coalesce(name, '') = '' then 'Missing name' end,
            case when email is null or not regexp_full_match(email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+')
              then 'Invalid email' end,
            case when value is null then 'Value must be numeric' end,
            case when value < 0 then 'Value must not be negative' end,
            case when created_at is null then 'Invalid or missing created_at' end],
            lambda x: x is not null) as errors from canon"""),
    "valid": (("checked",), "select * from checked where len(errors) = 0"),
    "kept": (("valid",), """
        select * from valid
        qualify row_number() over (partition by record_hash order by source_rank, pos) = 1"""),
    "c_day": (("checked",), """
        select *, cast(date_diff('day', date '2024-01-01', cast(created_at as date)) + 1 as bigint)
          as run_id from checked where source = 'Source C'"""),
    "vals": (("c_day",), "select * from c_day where len(errors) = 0"),
    "ev": ((), """
        select *, cast(date_diff('day', date '2024-01-01', cast(ts as date)) + 1 as bigint)
          as run_id from events"""),
    "day": (("ev",), """
        select run_id, count(*) as total_received,
          count(*) filter (event_type <> 'error') as valid_rows,
          count(distinct user_id) filter (event_type <> 'error') as total_processed,
          round(cast(sum(cast(round(value * 100) as bigint)) as bigint) / 100.0) / 10.0
            as duration_ms,
          case when run_id % 7 = 0 then 3 when run_id % 4 = 0 then 1 else 0 end as total_failed,
          timestamp '2024-01-01' + to_days(cast(run_id - 1 as int)) as started_at
        from ev group by run_id"""),
    "runs": (("day",), """
        select run_id, case total_failed when 0 then 'COMPLETED' when 3 then 'FAILED'
            else 'PARTIAL' end as status, total_received, total_processed,
          valid_rows - total_processed as total_duplicates,
          cast(total_failed as bigint) as total_failed, duration_ms, started_at,
          started_at + to_microseconds(cast(round(duration_ms * 1000) as bigint)) as completed_at
        from day"""),
    "spiky": (("runs",), """
        select * replace (case when run_id % 10 = 0 then duration_ms * 3 else duration_ms end
          as duration_ms) from runs"""),
    "outcomes": (("ev",), """
        select run_id, event_type as source, count(*) as received,
          count(distinct user_id) as users,
          (run_id + length(event_type)) % 5 = 0 as bad,
          case when (run_id + length(event_type)) % 5 = 0 and run_id % 2 = 1
            then 'feed ' || event_type || ' unavailable' end as error
        from ev group by run_id, event_type"""),
    "log": (("outcomes",), """
        select source, case when bad then 'DEGRADED' else 'HEALTHY' end as status,
          case when not bad then day_end end as last_success,
          case when bad then day_end end as last_failure,
          received as records_received, users as records_processed,
          received - users as duplicates, error as error_message, run_id,
          day_end as updated_at
        from (select *, timestamp '2024-01-01' + to_days(cast(run_id as int)) as day_end
              from outcomes)"""),
    "strict": (("log",), """
        select * from log qualify row_number() over (partition by source order by run_id desc) = 1"""),
    "merged": (("log", "strict"), """
        select s.* replace (l.ok as last_success, l.bad as last_failure)
        from strict s join (select source, max(last_success) as ok, max(last_failure) as bad
                            from log group by source) l using (source)"""),
    "stats": (("vals",), """
        select 2 * count(*) as n, avg(value) as mean, stddev_pop(value) as std,
          greatest(0.0, avg(value) - 2.5 * stddev_pop(value)) as low,
          avg(value) + 2.5 * stddev_pop(value) as high from vals"""),
    "value_found": (("vals", "stats"), """
        select run_id, record_id, source, 'value' as feature_name, value as current_value,
          printf('%.1f – %.1f', low, high) as expected_range,
          case when z > 4 or value > mean + 4 * std then 'HIGH' when z < 2 then 'LOW'
            else 'MEDIUM' end as severity,
          printf('Record value (%.2f) is significantly outside historical normal range '
            || '[%.2f – %.2f]. Historical mean: %.2f, Std dev: %.2f.',
            value, low, high, mean, std) as reason, 'ACTIVE' as status, pos
        from (select v.*, s.*, abs(value - mean) / std as z from vals v cross join stats s)
        where n >= 5 and (z > 2.5 or value < low or value > high)"""),
    "base": (("spiky",), """
        select run_id, duration_ms, count(*) over w as history_runs,
          count(duration_ms) filter (duration_ms <> 0) over w as durations,
          avg(duration_ms) filter (duration_ms <> 0) over w as mean,
          stddev_pop(duration_ms) filter (duration_ms <> 0) over w as raw_std
        from spiky
        window w as (order by run_id rows between unbounded preceding and 1 preceding)"""),
    "run_found": (("base",), """
        select run_id, cast(null as varchar) as record_id, 'Pipeline Orchestrator' as source,
          'duration_ms' as feature_name, duration_ms as current_value,
          printf('<%.1f ms', mean + 2 * std) as expected_range, 'HIGH' as severity,
          printf('Ingestion run duration (%.1f ms) exceeded historical baseline '
            || '[%.1f ms – %.1f ms].', duration_ms, mean - std, mean + 2 * std) as reason,
          'ACTIVE' as status
        from (select *, case when durations = 1 then 100.0 when raw_std = 0 then 50.0
                else raw_std end as std from base)
        where history_runs >= 3 and durations > 0 and duration_ms > mean + 2.5 * std"""),
    "found": (("value_found", "run_found"), """
        select * replace (case when run_id % 3 = 0 then 'RESOLVED' else 'ACTIVE' end as status),
          timestamp '2024-01-01' + to_days(cast(run_id as int)) as timestamp
        from (select * exclude (pos) from value_found union all select * from run_found)"""),
    "q_day": (("c_day",), """
        select run_id, count(*) as rows,
          count(*) filter (coalesce(name, '') = '') + count(*) filter (coalesce(email, '') = '')
            + count(*) filter (value is null) + count(*) filter (created_at is null) as gaps,
          count(*) filter (contains(coalesce(email, ''), '@') and contains(coalesce(email, ''), '.')
            and value is not null and value >= 0) as valid_rows,
          count(*) filter (coalesce(email, '') = lower(coalesce(email, ''))
            and created_at is not null) as consistent_rows,
          count(distinct record_hash) as unique_rows, max(created_at) as newest
        from c_day group by run_id"""),
    "snaps": (("q_day",), """
        select run_id, cast(printf('%.1f', .25 * completeness + .25 * validity + .2 * consistency
            + .15 * uniqueness + .15 * freshness) as double) as overall_score,
          cast(printf('%.1f', completeness) as double) as completeness, cast(printf('%.1f', validity) as double) as validity,
          cast(printf('%.1f', consistency) as double) as consistency, cast(printf('%.1f', uniqueness) as double) as uniqueness,
          cast(printf('%.1f', freshness) as double) as freshness, rows, valid_rows, consistent_rows,
          timestamp '2024-01-01' + to_days(cast(run_id as int)) as timestamp
        from (select *, (4 * rows - gaps) / (4 * rows) * 100.0 as completeness,
            valid_rows / rows * 100.0 as validity, consistent_rows / rows * 100.0 as consistency,
            unique_rows / rows * 100.0 as uniqueness,
            greatest(50.0, least(100.0, 100.0 - least(50.0, 2.0
              * (epoch(timestamp '2024-01-31 00:00:00') - epoch(newest)) / 3600))) as freshness
          from q_day)"""),
    "run_alerts": (("runs",), """
        select * from (
          select 'MEDIUM' as severity, 'High Run Latency in Run #' || run_id as title,
            printf('Ingestion run #%d took %.1fms, exceeding 3000ms threshold.', run_id,
              duration_ms * 2) as description, 'Pipeline Orchestrator' as source,
            'ACTIVE' as status, run_id from runs where duration_ms * 2 > 3000
          union all
          select 'MEDIUM', printf('High Duplicate Rate (%.1f%%) in Run #%d',
              total_duplicates / total_received * 100.0, run_id),
            printf('Detected %d duplicates out of %d records.', total_duplicates, total_received),
            'Deduplicator', 'ACTIVE', run_id
          from runs where total_duplicates / total_received * 100.0 > 15
          union all
          select 'HIGH', 'Failed Sources in Run #' || run_id,
            printf('%d source(s) failed during concurrent ingestion run #%d.', total_failed,
              run_id), 'Pipeline Orchestrator', 'ACTIVE', run_id from runs where total_failed > 0)"""),
    "cluster": (("found",), """
        select case when n > 5 then 'HIGH' else 'MEDIUM' end as severity,
          printf('Multiple Active Anomalies (%d detected)', n) as title,
          printf('%d active records/runs flagged as anomalies by IsolationForest.', n)
            as description, 'ML Anomaly Engine' as source, 'ACTIVE' as status,
          cast(null as bigint) as run_id
        from (select count(*) filter (status = 'ACTIVE') as n from found) where n >= 3"""),
    "alerts_now": (("run_alerts",), """
        select * replace (case when run_id % 4 = 0 then 'RESOLVED'
            when run_id % 2 = 0 then 'ACKNOWLEDGED' else 'ACTIVE' end as status),
          timestamp '2024-01-01' + to_days(cast(run_id as int)) as timestamp from run_alerts"""),
    "steps": (("kept",), """
        select record_id, record_hash, source, s.stage_no, s.stage, 'SUCCESS' as status,
          s.details, s.moment as timestamp
        from (select record_id, record_hash, source, unnest([
            {stage_no: 1, stage: 'SOURCE', moment: created_at,
             details: 'raw_id=' || record_id || '; source=' || source},
            {stage_no: 2, stage: 'RAW_INGESTION', moment: created_at,
             details: 'received_by=IngestionOrchestrator'},
            {stage_no: 3, stage: 'VALIDATION', moment: created_at,
             details: 'result=PASSED; rule_set=StandardSchemaValidator'},
            {stage_no: 4, stage: 'NORMALIZATION', moment: created_at,
             details: 'schema=CanonicalRecord; transformed_fields=email,value,created_at'},
            {stage_no: 5, stage: 'DEDUPLICATION', moment: created_at,
             details: 'fingerprint_hash=' || record_hash},
            {stage_no: 6, stage: 'STORAGE', moment: created_at,
             details: 'persisted_to=Repository'}]) as s from kept)"""),
    "measured": (("spiky", "snaps", "run_found"), """
        select r.run_id, cast(total_processed as double) as processed,
          cast(total_duplicates as double) as duplicates, cast(total_failed as double) as failed,
          duration_ms as latency, overall_score as quality, coalesce(n, 0.0) as anomalies
        from spiky r left join snaps q using (run_id)
          left join (select run_id, cast(count(*) as double) as n from run_found group by run_id) f
            using (run_id)"""),
    "life": (("runs", "outcomes"), """
        select 'INGESTION_STARTED' as event, run_id, started_at as timestamp,
          cast(null as varchar) as source, cast(null as bigint) as records,
          cast(null as double) as duration_ms, cast(null as varchar) as error,
          cast(null as varchar) as status from runs
        union all
        select 'SOURCE_STARTED', run_id, started_at, o.source, null, null, null, null
        from runs join outcomes o using (run_id)
        union all
        select case when bad then 'SOURCE_FAILED' else 'SOURCE_COMPLETED' end, run_id,
          started_at + to_microseconds(o.received * 1000), o.source,
          case when not bad then o.received end, cast(o.received as double),
          case when bad then o.error end, null
        from runs join outcomes o using (run_id)
        union all
        select 'INGESTION_COMPLETED', run_id, completed_at, null, null, duration_ms, null, status
        from runs"""),
    "told": (("life",), """
        select *, case event
            when 'INGESTION_STARTED' then 'Run #' || run_id || ' started'
            when 'SOURCE_STARTED' then source || ' started'
            when 'SOURCE_COMPLETED' then source || ' completed — ' || coalesce(records, 0) || ' records'
            when 'SOURCE_FAILED' then source || ' failed' || coalesce(' — ' || error, '')
            else 'Run #' || run_id || ' finished — ' || coalesce(status, 'unknown') end as message,
          case when event = 'SOURCE_FAILED' or (event = 'INGESTION_COMPLETED'
              and status = 'FAILED') then 'error'
            when event in ('SOURCE_COMPLETED', 'INGESTION_COMPLETED') then 'success'
            else 'info' end as tone from life"""),
    "pairs": (("valid",), """
        select record_hash, record_id, pos, source as duplicate_source,
          first_value(source) over w as original_source, row_number() over w as rn
        from valid window w as (partition by record_hash order by source_rank, pos
          rows between unbounded preceding and current row)"""),
}


def _needed(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(name: str) -> None:
        for other in CTES[name][0]:
            visit(other)
        if name not in out:
            out.append(name)

    for name in names:
        visit(name)
    return out


def sql(select: str, *names: str) -> str:
    """``select`` after the named common tables and those they need."""
    parts = [f"{n} as ({CTES[n][1]})" for n in _needed(names)]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + select


CANON = f"record_id, name, email, value, source, {iso('created_at')} as created_at, pos"
RUN = "run_id, status, total_received, total_processed, total_duplicates, total_failed"
ALERT = "severity, title, description, source, status, run_id"
ANOMALY = ("run_id, record_id, source, feature_name, current_value, expected_range, severity, "
           "reason, status")
LOG = (f"source, status, {iso('last_success')} as last_success, {iso('last_failure')} as "
       "last_failure, records_received, records_processed, duplicates, error_message, run_id, "
       f"{iso('updated_at')} as updated_at")
ERRORS = "array_to_string(errors, '; ') as errors"
NO_JSON = "'Missing record_id; Missing name; Invalid email; Value must be numeric; " \
          "Invalid or missing created_at'"


def _quality(rows: str, fresh: str) -> str:
    return f"""
        select cast(printf('%.1f', .25 * c + .25 * v + .2 * k + .15 * u + .15 * f) as double) as overall_score,
          cast(printf('%.1f', c) as double) as completeness, cast(printf('%.1f', v) as double) as validity, cast(printf('%.1f', k) as double) as consistency,
          cast(printf('%.1f', u) as double) as uniqueness, cast(printf('%.1f', f) as double) as freshness, rows, valid_rows, consistent_rows
        from (select count(*) as rows,
            (4 * count(*) - count(*) filter (coalesce(name, '') = '')
              - count(*) filter (coalesce(email, '') = '') - count(*) filter (value is null)
              - count(*) filter (created_at is null)) / (4 * count(*)) * 100.0 as c,
            count(*) filter (contains(email, '@') and contains(email, '.') and value >= 0)
              as valid_rows, valid_rows / count(*) * 100.0 as v,
            count(*) filter (email = lower(email) and created_at is not null) as consistent_rows,
            consistent_rows / count(*) * 100.0 as k,
            count(distinct record_hash) / count(*) * 100.0 as u,
            greatest(50.0, least(100.0, 100.0 - least(50.0, 2.0 * (epoch({fresh})
              - epoch(max(created_at))) / 3600))) as f from {rows})"""


def _health(runs: str, sources: str, found: str, ms: str = "duration_ms") -> str:
    """Health score of the runs and sources given as table expressions."""
    return f"""
        select cast(printf('%.1f', .3 * a + .25 * l + .25 * v + .2 * r) as double) as overall_score,
          cast(printf('%.1f', a) as double) as availability, cast(printf('%.1f', l) as double) as latency, cast(printf('%.1f', v) as double) as validation,
          cast(printf('%.1f', r) as double) as reliability,
          case when cast(printf('%.1f', .3 * a + .25 * l + .25 * v + .2 * r) as double) < 50 then 'CRITICAL'
            when cast(printf('%.1f', .3 * a + .25 * l + .25 * v + .2 * r) as double) < 80 then 'DEGRADED'
            else 'HEALTHY' end as status
        from (select {sources} as a,
            greatest(20.0, least(100.0, 100.0 - greatest(0.0, (m - 1000.0) / 100.0))) as l,
            greatest(0.0, least(100.0, 100.0 - greatest(0, rec - proc - dup) / rec * 100.0)) as v,
            greatest(10.0, least(100.0, 100.0 - dup / rec * 40.0 - {found} * 5.0)) as r
          from (select (select avg(d) from (select {ms} as d from {runs} order by run_id desc
                limit 10)) as m, sum(total_received) as rec, sum(total_processed) as proc,
              sum(total_duplicates) as dup
            from (select * from {runs} order by run_id desc limit 5)))"""


def _changes(pairs: str) -> str:
    """One row per metric of pairs with columns a (latest) and b (previous)."""
    metrics = [(1, "Records Processed", "processed", ">"), (2, "Duplicates", "duplicates", "<"),
               (3, "Validation Errors", "failed", "<"), (4, "Latency (ms)", "latency", "<"),
               (5, "Quality Score", "quality", ">"), (6, "Anomalies", "anomalies", "<")]
    rows = " union all ".join(f"""
        select a.run_id as latest_run_id, b.run_id as previous_run_id, {no} as metric_no,
          '{name}' as name, coalesce(a.{c}, 95.0) as x, coalesce(b.{c}, 90.0) as y,
          coalesce(a.{c}, 95.0) - coalesce(b.{c}, 90.0) {better} 0 as better
        from ({pairs})""" for no, name, c, better in metrics)
    return f"""
        select latest_run_id, previous_run_id, metric_no, name,
          cast(printf('%.2f', x) as double) as latest_value,
          cast(printf('%.2f', y) as double) as previous_value,
          cast(printf('%.2f', x - y) as double) as absolute_change,
          cast(printf('%.1f', case when y > 0 then (x - y) / y * 100.0 when x > 0 then 100.0
            else 0.0 end) as double) as percent_change,
          case when abs(x - y) < 0.001 then 'NEUTRAL' when better then 'IMPROVED'
            else 'DEGRADED' end as status from ({rows})"""


KEPT_PAGE = f"record_hash, record_id, source, {iso('created_at')} as ingested_at from kept"
NEWEST = "order by created_at desc, record_hash desc"
HEALTHY = "(select count(*) filter (status = 'HEALTHY') / count(*) * 100.0 from merged)"
LATEST_RUN = "run_id = (select max(run_id) from runs)"

ORACLE: dict[str, str] = {
    "normalize_feed_a": sql(f"select {CANON} from feed_a", "feed_a"),
    "normalize_feed_b": sql(f"select {CANON} from feed_b", "feed_b"),
    "normalize_feed_c": sql(f"select {CANON} from feed_c", "feed_c"),
    "union_canonical": sql(f"""select {CANON}, source_rank, {iso('created_at')} as ingested_at
        from canon""", "canon"),
    "schema_detect": """
        with j as (
          select 1 as rank, c_custkey as pos, json_object('id', ' C-' || c_custkey, 'name', c_name,
            'email', '', 'amount', c_acctbal, 'created', '') as payload from customer
          union all select 2, o_orderkey, json_object('customer_id', 'C-' || o_custkey,
            'value', o_totalprice) from orders
          union all select 3, event_id, json_object('userId', 'U-' || user_id, 'mail', '')
            from events
          union all select 4, event_id, cast(props as json) from events)
        select rank, pos, case when list_contains(json_keys(payload), 'id') then 'Source A'
          when list_contains(json_keys(payload), 'customer_id') then 'Source B'
          when list_contains(json_keys(payload), 'userId') then 'Source C'
          else 'Unknown' end as source from j""",
    "normalize_mixed": sql(f"""select {CANON}, source_rank from canon
        union all select '', null, null, null, 'Unknown', null, event_id, 4 from events""",
                           "canon"),
    "unknown_schema": f"""select event_id as pos, 'Unknown' as source, '' as record_id,
        {NO_JSON} as errors from events""",
    "passthrough_mapping": """
        select case when event_type <> 'view' then cast(event_id as varchar)
            when event_id % 2 = 1 then 'R-' || event_id else 'unknown-' || event_id end
            as record_id, 'User ' || user_id as name, value,
          case when event_type <> 'click' then event_type else 'unknown' end as source,
          event_id as pos from events""",
    "text_cleaning": f"""
        select doc_id, length(t) as n_clean, sha256(t) as clean_digest,
          sha256(lower(t)) as lower_digest
        from (select doc_id, nullif(trim(text, {SPACES}), '') as t from documents)""",
    "number_grammar": """
        select l_linenumber as form, count(*) as texts, count(v) as numbers,
          round(sum(v), 2) as total
        from (select l_linenumber, q, k, case l_linenumber when 1 then q
              when 2 then cast(q || lpad(cast(k as varchar), 3, '0') as double)
              when 3 then cast(q || '.' || k as double) when 4 then q * 100.0
              when 5 then null when 6 then null else cast('.' || q as double) end as v
            from (select *, cast(l_quantity as int) as q, l_orderkey % 1000 as k from lineitem))
        group by l_linenumber""",
    "instant_grammar": f"""
        select o_orderkey, {iso('t')} as instant
        from (select o_orderkey, case when o_orderkey % 8 in (0, 5)
              then cast(cast(o_orderdate as date) as timestamp)
              when o_orderkey % 8 in (1, 2, 3) then date_trunc('second', o_orderdate)
              when o_orderkey % 8 = 4 then date_trunc('second', o_orderdate) - interval 2 hour
              end as t from orders)""",
    "fingerprint": sql("select source, pos, record_hash from checked", "checked"),
    "record_documents": sql(f"""select record_hash, record_id, {iso('created_at')} as created_at,
        true as same from kept""", "kept"),
    "validation_errors": sql(f"select source, pos, record_id, {ERRORS} from checked", "checked"),
    "valid_records": sql("select source, pos, record_id, value from valid", "valid"),
    "rejected_records": sql(f"""select source, pos, record_id, {ERRORS} from checked
        where len(errors) > 0""", "checked"),
    "validation_counts": sql("""select source, count(*) as received,
        count(*) filter (len(errors) = 0) as valid_count,
        count(*) filter (len(errors) > 0) as invalid_count from checked group by source""",
                             "checked"),
    "reject_reasons": sql("""select source, reason, count(*) as rows
        from (select source, unnest(errors) as reason from checked) group by source, reason""",
                          "checked"),
    "hash_guard": sql("""select source, count(*) as records, min(record_hash) as lowest_hash
        from kept group by source""", "kept"),
    "records_of_source": sql("""select record_id, email, value from kept
        where source = 'Source B'""", "kept"),
    "dedupe_first": sql("select record_hash, source, pos, record_id, value from kept", "kept"),
    "dedupe_by_id": sql("""select record_id, source, pos from valid
        qualify row_number() over (partition by record_id order by source_rank, pos) = 1""",
                        "valid"),
    "duplicate_pairs": sql("""select original_source, duplicate_source, count(*) as duplicates
        from pairs where rn > 1 group by all""", "pairs"),
    "duplicate_report": sql("""select record_hash, original_source, duplicate_source, record_id,
        pos from pairs where rn > 1""", "pairs"),
    "duplicate_count": sql("""select count(*) as valid_records,
        count(distinct record_hash) as unique_records,
        count(*) - count(distinct record_hash) as duplicates from valid""", "valid"),
    "cross_run_new": sql("""select record_hash, source, pos from valid v
        where source <> 'Source A' and not exists (select 1 from valid a
          where a.source = 'Source A' and a.record_hash = v.record_hash)
        qualify row_number() over (partition by record_hash order by source_rank, pos) = 1""",
                         "valid"),
    "source_counts": sql("""select c.source, count(*) as received,
          count(*) filter (len(errors) > 0) as rejected, count(*) filter (len(errors) = 0) as valid,
          count(k.pos) as unique_records,
          count(*) filter (len(errors) = 0) - count(k.pos) as duplicates
        from checked c left join (select source_rank, pos from kept) k using (source_rank, pos)
        group by c.source""", "checked", "kept"),
    "daily_runs": sql(f"select * replace ({iso('started_at')} as started_at) from runs", "runs"),
    "run_totals": sql("""
        select run_id, case when f = 0 then 'COMPLETED' when f = n then 'FAILED'
            else 'PARTIAL' end as status, total_received, total_processed,
          valid - total_processed as total_duplicates, f as total_failed
        from (select run_id, cast(sum(received) as bigint) as total_received,
            count(*) filter (bad) as f, count(*) as n from outcomes group by run_id)
          join (select run_id, count(*) as valid, count(distinct record_hash) as total_processed
            from vals group by run_id) using (run_id)""", "outcomes", "vals"),
    "source_status_rows": sql("""
        select run_id, o.source, case when bad then 'DEGRADED' else 'HEALTHY' end as status,
          received as records_received, coalesce(kept, 0) as records_processed,
          received - coalesce(kept, 0) as duplicates, error as error_message,
          not bad as succeeded
        from outcomes o left join (select run_id, event_type as source, count(*) as kept
          from (select * from ev qualify row_number() over (partition by run_id, user_id
            order by event_id) = 1) group by all) k using (run_id, source)""", "outcomes", "ev"),
    "latest_run_upsert": sql(f"select {RUN} from runs", "runs"),
    "source_status_upsert": sql(f"select {LOG} from merged", "merged"),
    "source_status_strict": sql(f"select {LOG} from strict", "strict"),
    "lifetime_stats": sql(f"""
        select cast(sum(total_received) as bigint) as total_received,
          cast(sum(total_processed) as bigint) as total_processed,
          cast(sum(total_duplicates) as bigint) as total_duplicates,
          cast(sum(total_failed) as bigint) as total_failed,
          arg_max(status, run_id) as last_run_status,
          arg_max({iso('completed_at')}, run_id) as last_run_timestamp,
          arg_max(duration_ms, run_id) as last_run_duration_ms from runs""", "runs"),
    "source_cards": sql("""select source, status, records_received, records_processed,
        greatest(0, records_received - records_processed) as duplicates from merged""", "merged"),
    "status_fold": """select case o_orderstatus when 'F' then 'HEALTHY' when 'O' then 'DOWN'
        else 'UNKNOWN' end as status, count(*) as rows from orders group by 1""",
    "failed_sources": sql("""select run_id, coalesce(string_agg(source, ',' order by source)
        filter (bad), '') as failed_sources from outcomes group by run_id""", "outcomes"),
    "run_documents": sql(f"""
        select run_id, case when run_id % 5 = 0 then 0.0 else duration_ms end as duration_ms,
          case when run_id % 5 = 0 then '' else {iso('started_at')} end as started_at,
          run_id % 5 = 0 as unfinished from runs""", "runs"),
    "quality_scores": sql(_quality("checked", AS_OF), "checked"),
    "quality_by_source": sql("""select source, count(*) as rows,
        cast(printf('%.1f', (3 * count(*) - count(*) filter (coalesce(name, '') = '')
          - count(*) filter (coalesce(email, '') = '') - count(*) filter (value is null))
          / (3 * count(*)) * 100.0) as double) as completeness from checked group by source""", "checked"),
    "quality_snapshot": sql("select cast(1 as bigint) as run_id, * exclude (consistent_rows), "
                            "100.0 as source_a, (select case when count(*) > 0 then 100.0 end "
                            "from kept where source = 'Source B') as source_b from ("
                            + _quality("kept", AS_OF) + ")", "kept"),
    "quality_newest_rows": sql(_quality(f"(select * from kept {NEWEST} limit 1000)", AS_OF),
                               "kept"),
    "quality_by_run": sql("select * exclude (timestamp) from snaps", "snaps"),
    "value_bounds": sql("""select n, round(mean, 4) as mean, round(std, 4) as std,
        round(low, 4) as low, round(high, 4) as high from stats""", "stats"),
    "zscores": sql("select pos, round(abs(value - mean) / std, 4) as z from vals, stats",
                   "vals", "stats"),
    "zscore_anomalies": sql(f"select {ANOMALY} from value_found", "value_found"),
    "latest_run_values": sql("""
        select run_id, record_id, source, 'value' as feature_name, value as current_value,
          printf('%.1f – %.1f', low, high) as expected_range,
          case when z > 4 or value > mean + 4 * std then 'HIGH' when z < 2 then 'LOW'
            else 'MEDIUM' end as severity,
          printf('Record value (%.2f) is significantly outside historical normal range '
            || '[%.2f – %.2f]. Historical mean: %.2f, Std dev: %.2f.',
            value, low, high, mean, std) as reason, 'ACTIVE' as status
        from (select v.*, s.*, abs(value - mean) / std as z from vals v cross join
            (select avg(value) as mean, stddev_pop(value) as std,
               greatest(0.0, mean - 2.5 * std) as low, mean + 2.5 * std as high from vals) s
          where run_id = (select max(run_id) from vals))
        where z > 2.5 or value < low or value > high""", "vals"),
    "run_duration_anomalies": sql(f"select {ANOMALY} from run_found", "run_found"),
    "latest_run_anomaly": sql(f"""select {ANOMALY} from run_found
        where run_id = (select max(run_id) from base)""", "run_found"),
    "anomaly_identity": sql("""select run_id, count(*) as inserted from found where run_id > 15
        group by run_id""", "found"),
    "anomaly_summary": sql("""select count(*) as total_anomalies,
        count(*) filter (severity = 'HIGH') as high_count,
        count(*) filter (severity = 'MEDIUM') as medium_count,
        count(*) filter (severity = 'LOW') as low_count from found""", "found"),
    "anomaly_summary_filtered": sql("""select count(*) as total_anomalies,
        count(*) filter (severity = 'HIGH') as high_count,
        count(*) filter (severity = 'MEDIUM') as medium_count,
        count(*) filter (severity = 'LOW') as low_count from found
        where severity = 'HIGH' and source = 'Source C'""", "found"),
    "anomalies_by_severity": sql(f"""select run_id, record_id, source, current_value,
        {iso('timestamp')} as timestamp from found where severity = 'HIGH'""", "found"),
    "anomaly_by_id": sql(f"""select {ANOMALY} from found where feature_name = 'duration_ms'
        and run_id = (select max(run_id) from run_found)""", "found"),
    "health_score": sql(_health("runs", HEALTHY, "(select count(*) from run_found)"),
                        "runs", "merged", "run_found"),
    "health_without_sources": sql(_health(
        "runs", "(select count(*) filter (status = 'COMPLETED') / count(*) * 100.0 from runs)",
        "0", "duration_ms * 3"), "runs"),
    "health_without_runs": sql("""select 100.0 as overall_score, 100.0 as availability,
        100.0 as latency, 100.0 as validation, 100.0 as reliability, 'HEALTHY' as status"""),
    "latest_health": sql(f"select *, strftime({AS_OF}, {ISO}) as updated_at from ("
                         + _health("runs", HEALTHY, "0") + ")", "runs", "merged"),
    "alerts_all_runs": sql(f"""
        select {ALERT} from run_alerts union all select {ALERT} from cluster
        union all select 'HIGH', 'Source Degradation: ' || source, 'Source ' || source
          || ' is currently reporting DEGRADED status. Error: '
          || coalesce(error_message, 'Unknown error'), source, 'ACTIVE', null
        from log where status = 'DEGRADED'""", "run_alerts", "cluster", "log"),
    "alerts_latest": sql(f"""
        select {ALERT} from cluster
        union all select 'HIGH', 'Source Degradation: ' || source, 'Source ' || source
          || ' is currently reporting DEGRADED status. Error: '
          || coalesce(error_message, 'Unknown error'), source, 'ACTIVE', null
        from merged where status = 'DEGRADED'
        union all select 'MEDIUM', 'High Run Latency in Run #' || run_id,
          printf('Ingestion run #%d took %.1fms, exceeding 3000ms threshold.', run_id,
            duration_ms), 'Pipeline Orchestrator', 'ACTIVE', run_id
        from spiky where duration_ms > 3000 and {LATEST_RUN}
        union all select {ALERT} from run_alerts
        where title not like '%Latency%' and {LATEST_RUN}""",
                         "cluster", "merged", "spiky", "run_alerts"),
    "alerts_insert": sql(f"select {ALERT} from run_alerts where run_id > 15", "run_alerts"),
    "alert_status": sql(f"select {ALERT} from alerts_now", "alerts_now"),
    "active_alerts": sql("""select count(*) filter (status = 'ACTIVE') as active_count
        from alerts_now""", "alerts_now"),
    "alerts_by_status": sql(f"""select run_id, title, {iso('timestamp')} as timestamp
        from alerts_now where status = 'ACKNOWLEDGED'""", "alerts_now"),
    "alerts_any_status": sql("select status, count(*) as alerts from alerts_now group by status",
                             "alerts_now"),
    "alert_by_id": sql(f"""select {ALERT} from alerts_now where title like 'Failed%'
        order by run_id desc limit 1""", "alerts_now"),
    "records_page": sql(f"select {KEPT_PAGE} {NEWEST} limit 20 offset 40", "kept"),
    "records_page_of_source": sql(f"""select {KEPT_PAGE} where source = 'Source C' {NEWEST}
        limit 15 offset 15""", "kept"),
    "records_page_by_key": sql(f"select {KEPT_PAGE} {NEWEST} limit 20 offset 60", "kept"),
    "page_numbers": sql("""select 2 as page, 200 as page_size, count(*) as total,
        cast(greatest(1, ceil(count(*) / 200)) as bigint) as total_pages,
        cast(201 as bigint) as range_start, least(count(*), 400) as range_end from kept""",
                        "kept"),
    "recent_runs": sql(f"select {RUN} from runs order by run_id desc limit 20", "runs"),
    "run_by_id": sql(f"select {RUN} from runs where run_id = 12", "runs"),
    "latest_quality": sql(f"""select * replace ({iso('timestamp')} as timestamp) from snaps
        order by run_id desc limit 1""", "snaps"),
    "quality_trend": sql(f"""
        select point, case when run_id % 3 = 0 then point else run_id end as run_id,
          {iso('timestamp')} as timestamp, overall_score, completeness, validity, consistency,
          uniqueness, freshness
        from (select *, row_number() over (order by run_id) as point
          from (select * from snaps order by run_id desc limit 20))""", "snaps"),
    "duration_series": sql("""select run_id, 'Run ' || run_id as label,
        cast(floor(duration_ms + 0.5) as bigint) as duration_ms, status
        from runs order by run_id desc limit 10""", "runs"),
    "source_lanes": sql("""
        select l.name, coalesce(m.status, 'UNKNOWN') as health
        from (select unnest(['Source A', 'Source B', 'Source C']) as name
              union all select distinct event_type from events) l
          left join merged m on m.source = l.name""", "merged"),
    "lineage_steps": sql(f"select * replace ({iso('timestamp')} as timestamp) from steps",
                         "steps"),
    "lineage_nested": sql(f"""select record_id, record_hash, source,
        {iso('created_at')} as received_at, 'STORED' as final_status,
        'SOURCE>RAW_INGESTION>VALIDATION>NORMALIZATION>DEDUPLICATION>STORAGE' as stages
        from kept""", "kept"),
    "lineage_summary": sql(f"""select record_id, {iso('min(created_at)')} as received_at,
        'STORED' as final_status, 6 * count(*) as step_count from valid group by record_id""",
                           "valid"),
    "lineage_fallback": sql("""
        select source, stage, count(*) as steps from steps group by source, stage
        union all select source, 'rebuilt', count(*) from steps where source <> 'Source A'
        group by source""", "steps"),
    "run_lineage": sql("""
        select source, stage_no, stage, status, count(*) as steps from (
          select source, s.stage_no, s.stage, s.status from (
            select c.source, unnest([
              {stage_no: 1, stage: 'SOURCE', status: 'SUCCESS'},
              {stage_no: 2, stage: 'RAW_INGESTION', status: 'SUCCESS'},
              {stage_no: 3, stage: 'VALIDATION',
               status: case when len(errors) > 0 then 'FAILED' else 'SUCCESS' end},
              {stage_no: 4, stage: 'NORMALIZATION', status: 'SUCCESS'},
              {stage_no: 5, stage: 'DEDUPLICATION', status: case when len(errors) > 0
                then 'SKIPPED' when k.pos is null then 'DUPLICATE' else 'SUCCESS' end},
              {stage_no: 6, stage: 'STORAGE', status: case when len(errors) = 0
                and k.pos is not null then 'SUCCESS' else 'SKIPPED' end}]) as s
            from checked c left join (select source_rank, pos from kept) k
              using (source_rank, pos)))
        group by all""", "checked", "kept"),
    "run_deltas": sql(_changes("""select m as a, lag(m) over (order by run_id) as b
        from measured m qualify b is not null"""), "measured"),
    "compare_latest": sql(_changes("""select m as a, n as b from measured m, measured n
        where m.run_id = (select max(run_id) from measured) and n.run_id =
          (select max(run_id) from measured where run_id < m.run_id)"""), "measured"),
    "compare_two": sql(_changes("""select m as a, n as b from measured m, measured n
        where m.run_id = 20 and n.run_id = 7"""), "measured"),
    "replay_candidates": sql("select run_id, status from runs where status <> 'COMPLETED'",
                             "runs"),
    "replay_source": sql("""select count(distinct record_hash) as processed,
        cast(0 as bigint) as inserted from valid where source = 'Source B'""", "valid"),
    "lifecycle_events": sql(f"select * replace ({iso('timestamp')} as timestamp) from life",
                            "life"),
    "event_messages": sql("select run_id, event, source, message, tone from told", "told"),
    "event_json": sql("""select run_id, event, source, 3 + cast(source is not null as bigint)
        + cast(records is not null as bigint) + cast(duration_ms is not null as bigint)
        + cast(error is not null as bigint) + cast(status is not null as bigint) as fields,
        event as event_text from life""", "life"),
    "activity_feed": sql(f"""select run_id, message, tone, {iso('timestamp')} as timestamp
        from told where run_id = (select max(run_id) from told)""", "told"),
    "run_state": sql(f"""select run_id, 'INGESTION_COMPLETED' as last_event,
        {iso('max(timestamp)')} as last_at, true as finished, max(status) as status,
        count(*) filter (event = 'SOURCE_COMPLETED') as sources_completed,
        count(*) filter (event = 'SOURCE_FAILED') as sources_failed,
        cast(coalesce(sum(records), 0) as bigint) as records from life group by run_id""", "life"),
    "source_state": sql(f"""select source, arg_max(event, timestamp) as last_event,
        max(run_id) as last_run, {iso('max(timestamp)')} as last_at,
        count(*) filter (event = 'SOURCE_FAILED') as failures from life
        where source is not null group by source""", "life"),
    "ingest_run": sql("""
        select cast(1 as bigint) as run_id, 'COMPLETED' as status,
          (select count(*) from canon) as total_received, count(*) as total_processed,
          (select count(*) from valid) - count(*) as total_duplicates,
          cast(0 as bigint) as total_failed, count(*) as total_inserted, count(*) as stored,
          (select count(*) from canon) - (select count(*) from valid) as rejects,
          (select count(*) from valid) - count(*) as duplicates from kept""",
                      "canon", "valid", "kept"),
    "stream_ingest": sql("""select distinct record_hash, record_id, email from valid
        where source = 'Source C'""", "valid"),
    "stream_recent_duplicates": sql("""select distinct record_hash, record_id from valid
        where source = 'Source C'""", "valid"),
}
ORACLE["stream_run_state"] = ORACLE["run_state"]
ORACLE["ingest_repeat"] = (
    "select *, 1::bigint as quality_rows, 1::bigint as health_rows, 3::bigint as source_rows, "
    f"1::bigint as run_rows, 8::bigint as event_rows from ({ORACLE['ingest_run']})")
ORACLE["run_state_repeated"] = ORACLE["run_state"]
ORACLE["ingest_files"] = sql("""
    select case source when 'Source C' then 'Feed M' else source end as source,
        (select count(*) from canon c where c.source = s.source) as records_received,
        (select count(*) from kept k where k.source = s.source) as records_processed,
        (select count(*) from valid v where v.source = s.source)
          - (select count(*) from kept k where k.source = s.source) as duplicates
    from (select distinct source from canon) s""", "canon", "valid", "kept")
ORACLE["ingest_retry"] = """
    select 'Source A' as source, 'SUCCESS' as status, count(*) as received, 3 as attempts from customer
    union all select 'Source B', 'FAILED', 0, 3 union all select 'Source C', 'TIMEOUT', 0, 2"""
ORACLE["lineage_stored"] = sql("""
    select 6 * n as steps, 6 * n as stored_by_first, n as first_read, n as second_read
    from (select count(distinct record_hash) as n from valid where source = 'Source A')""", "valid")
ORACLE["quality_of_nothing"] = """
    select 100.0::double as overall_score, 100.0::double as completeness, 100.0::double as validity,
        100.0::double as consistency, 100.0::double as uniqueness, 100.0::double as freshness,
        0::bigint as rows, 0::bigint as valid_rows, 0::bigint as consistent_rows"""
ORACLE["quality_first_read"] = sql("""
    select 1::bigint as snapshots, true as same, count(distinct record_hash) as records
    from valid where source = 'Source A'""", "valid")
ORACLE["incremental_analysis"] = sql(f"""
    select kind, q.* exclude (rows, valid_rows, consistent_rows), q.rows as evaluated, v.*
    from (values ('counters'), ('records')) k(kind),
      ({_quality("kept", "max(created_at)")}) q,
      (select round(avg(value), 4) as mean, round(stddev_pop(value), 4) as std,
         round(avg(value) + 2.5 * stddev_pop(value), 4) as high from kept) v""", "kept")
ORACLE["forest_step"] = sql("""select value <= 100 or value > 20000 as anomalous, count(*) as rows
    from vals group by 1""", "vals")
ORACLE["forest_invariants"] = sql("""select count(*) as training_rows, true as within_share,
    true as far_values_found from vals""", "vals")
ORACLE["stream_three_feeds"] = sql("select record_hash, record_id, email, source from kept", "kept")
ORACLE["stream_run_state_updates"] = ORACLE["run_state"]
ORACLE["run_state_keyed"] = f"select *, 2 as attempt from ({ORACLE['run_state']})"
ORACLE["numbers_in_other_digits"] = """
    select script, count(*) as texts, count(v) as numbers, round(sum(v), 2) as total
    from (select l_linenumber % 4 as script, case l_linenumber % 4 when 0 then q
          when 1 then -cast(q || '.' || k as double)
          when 2 then cast(q || lpad(cast(k as varchar), 3, '0') as double) end as v
        from (select *, cast(l_quantity as int) as q, l_orderkey % 1000 as k from lineitem))
    group by script"""
ORACLE["week_dates_with_time"] = f"""
    select o_orderkey, {iso('t')} as instant
    from (select o_orderkey, case o_orderkey % 5 when 0 then s when 1 then s
          when 2 then date_trunc('week', s) + (date_trunc('minute', s) - date_trunc('day', s)) - interval 2 hour
          when 3 then null
          else date_trunc('week', s) + (date_trunc('hour', s) - date_trunc('day', s)) end as t
        from (select o_orderkey, date_trunc('second', cast(o_orderdate as timestamp)) as s from orders))"""
ORACLE["events_live"] = """
    with n as (select (select count(*) from customer) + (select count(*) from events) as n)
    select 1::bigint as run_id, attempt, event, k::bigint as events, 1::bigint as times,
        cast(case when event = 'SOURCE_COMPLETED' then n else 0 end as bigint) as records
    from n, (values (1), (2)) a(attempt), (values ('INGESTION_STARTED', 1), ('SOURCE_STARTED', 2),
        ('SOURCE_COMPLETED', 2), ('INGESTION_COMPLETED', 1)) e(event, k)"""
ORACLE["compacted_store"] = sql("""
    select count(distinct record_hash) as records, count(distinct record_hash) as different,
        count(distinct run_id) as runs, true as few_files, true as swapped, true as same_for_readers
    from (select record_hash, min(pos) % 20 as run_id from valid where source = 'Source A' group by 1)""", "valid")
ORACLE["incremental_forest"] = sql("""select count(distinct record_hash) as trained, true as same_steps, true as same_scores,
    true as same_threshold, true as same_ranges from valid""", "valid")
ORACLE["health_first_read"] = sql("select *, true as same, 1::bigint as snapshots from ("
                                  + _health("runs", HEALTHY, "0") + ")", "runs", "merged")
ORACLE["alerts_reraised"] = sql("""
    select severity, source, status, 2::bigint as alerts, 1 as after_first, 1 as after_repeat
    from cluster""", "cluster")
ORACLE["exact_moments"] = sql("""
    select count(*) as n, round(m, 4) as mean, round(s, 4) as std, round(greatest(0, m - 2.5 * s), 4) as low,
        round(m + 2.5 * s, 4) as high, true as any_partitioning, true as from_counters
    from valid, (select avg(value) as m, stddev_pop(value) as s from valid) group by m, s""", "valid")
ORACLE["records_page_deep"] = sql(f"select {KEPT_PAGE} {NEWEST} limit 25 offset 1300", "kept")

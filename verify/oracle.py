"""The same derivations and jobs as DuckDB SQL.

``CTES`` holds one named query per table; :func:`sql` puts the ones a final
query needs in front of it.
"""

from __future__ import annotations

import re

from tickloom.functions import fixed_values as fv
from verify import adapter as ad


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def values(rows: list[tuple]) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in rows)


def case(subject: str, options: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {q(k)} THEN {v if isinstance(v, int) else q(v)}" for k, v in options.items())
    return f"CASE {subject} {arms} ELSE {default} END"


def half_up(num: str, den: str, digits: int) -> str:
    """Exact rounding of num / den (whole numbers), half away from zero."""
    scale = 10 ** digits
    n, d = f"({num})::HUGEINT", f"({den})::HUGEINT"
    return (f"CASE WHEN ({den}) <> 0 THEN sign({n}) * ((2 * abs({n}) * {scale} + {d}) // (2 * {d}))"
            f"::DOUBLE / {scale}.0::DOUBLE END")


def clean(col: str) -> str:
    out = f"coalesce({col}, '')"
    for pattern, repl in fv.CLEANING_STEPS:
        flags = "g"
        if pattern.startswith("(?si)"):
            pattern, flags = pattern[5:], "gsi"
        out = f"regexp_replace({out}, {q(pattern)}, {q(repl.replace('$1', chr(92) + '1'))}, '{flags}')"
    return f"trim({out}, ' ')"


def hours(a: str, b: str) -> str:
    return f"date_diff('hour', {a}, {b})"


def days(a: str, b: str) -> str:
    return f"date_diff('day', {a}, {b})"


def zero(*names: str, prefix: str = "") -> str:
    return ", ".join(f"coalesce({prefix}{n}, 0) AS {n}" for n in names)


def contains(text: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(w)})" for w in words) + ")"


def rules(text: str, arms: list[tuple[list[str], str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {contains(text, w)} THEN {q(v)}" for w, v in arms) + f" ELSE {q(default)} END"


KEY = "'CORE-' || "
TIES = "from_string NULLS LAST, to_string NULLS LAST, author NULLS LAST"
K = "CAST(json_extract(props, '$.k') AS INTEGER)"


def kcase(expr: str, options: list) -> str:
    arms = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(options) if v is not None)
    return f"CASE {expr} {arms} END"


CTES: dict[str, str] = {
    # ---- raw tables; timestamps stay typed here, Spark parses them from text ----
    "raw_one": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS id, {KEY}o_orderkey AS key,
          coalesce(split_part(text, chr(10), 1), {case('o_orderpriority', ad.SUMMARY_HEAD)} || c_name) AS summary,
          text || coalesce(chr(10) || '{{code:xml}}' || html || '{{code}} [~' || c_name || '] https://example.org/x', '') AS description,
          CASE WHEN o_totalprice >= 1500 THEN o_orderdate + to_minutes(o_orderkey % 1440) END AS created_at,
          CASE WHEN o_orderstatus = 'F' THEN last_ship END AS resolved_at,
          coalesce({case('c_mktsegment', ad.SEGMENT_TYPE)},
            CASE c_mktsegment WHEN 'FURNITURE' THEN {case('o_orderstatus', ad.FURNITURE_TYPE)}
                              WHEN 'HOUSEHOLD' THEN {case('o_orderstatus', ad.HOUSEHOLD_TYPE)} END) AS issuetype_raw,
          CASE WHEN o_orderstatus <> 'O' THEN coalesce({case('o_orderpriority', ad.PRIORITY_RESOLUTION)},
            CASE o_orderstatus WHEN 'F' THEN 'Cannot Reproduce' ELSE 'Auto Closed' END) END AS resolution_raw,
          {case('o_orderpriority', ad.PRIORITY_NAME, "' '")} AS priority,
          {case('o_orderstatus', ad.STATUS_NAME)} AS status,
          CASE WHEN c_acctbal >= 0 THEN 'CORE' ELSE 'EDGE' END AS project,
          CASE WHEN c_acctbal < 2000 THEN 'Unassigned' ELSE 'dev' || c_nationkey END AS assignee,
          c_name AS reporter, 'nation' || c_nationkey AS creator,
          CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(c_nationkey + 1 AS BIGINT) END AS votes,
          CASE WHEN o_orderstatus <> 'O' THEN CAST(c_nationkey AS BIGINT) END AS watches,
          o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey
        LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        LEFT JOIN documents ON doc_id = o_orderkey
        LEFT JOIN pages ON page_id = o_orderkey""",
    "raw_issues": """
        SELECT * FROM raw_one UNION ALL
        SELECT * REPLACE (CASE status WHEN 'In Progress' THEN '0' ELSE 'z' END || id AS id, 'copy' AS summary)
        FROM raw_one WHERE o_totalprice > 495000""",
    "raw_comments": f"""
        SELECT {KEY}conv_id AS key, conv_id || '-' || turn AS comment_id, role AS comment_author, text AS comment_body,
          TIMESTAMP '2001-09-01 00:50:00' + to_minutes(turn * 25) AS comment_created,
          CAST(NULL AS TIMESTAMP) AS comment_updated FROM conversations""",
    "raw_changelog": f"""
        SELECT {KEY}(user_id + 150 * (k % 7)) AS key, 'a' || (k % 9) AS author,
          ts - to_days(8400 + 30 * (k % 60)) AS created,
          CASE event_type WHEN 'signup' THEN 'status' WHEN 'error' THEN 'Priority' WHEN 'click' THEN 'assignee'
            WHEN 'view' THEN 'Fix Version/s' ELSE CASE WHEN value < 10 THEN 'resolution' ELSE 'Rank' END END AS field,
          CASE WHEN event_type = 'signup' THEN {kcase('(k // 6) % 6', ad.STATUS_FROM)} END AS from_string,
          CASE event_type WHEN 'signup' THEN {kcase('k % 6', ad.STATUS_TO)}
            WHEN 'error' THEN {kcase('k % 6', ad.PRIORITY_TO)}
            WHEN 'click' THEN CASE WHEN k % 8 <> 0 THEN 'u' || (k % 12) END
            WHEN 'view' THEN CASE WHEN k % 11 = 0 THEN 'master' ELSE (1 + k % 5) || '.' || (k % 7) || '.0'
              || CASE WHEN k % 10 = 0 THEN '-RC1' ELSE '' END END
            WHEN 'purchase' THEN 'Fixed' END AS to_string
        FROM (SELECT *, {K} AS k FROM events)""",
    "raw_issuelinks": f"""
        SELECT {KEY}l_orderkey AS key,
          CASE l_linenumber WHEN 5 THEN 'Cloners' WHEN 6 THEN 'Blocked' WHEN 7 THEN 'Blocker' ELSE
            CASE l_returnflag WHEN 'R' THEN 'Reference' WHEN 'A' THEN 'duplicate' WHEN 'N' THEN 'Container' END END AS type_name,
          {KEY}l_partkey AS inwardissue_key, {KEY}l_suppkey AS outwardissue_key FROM lineitem""",
    "every_parent": f"""
        SELECT key, CASE WHEN has_parent = 1 THEN {KEY}(o_orderkey - 1) END AS parent_key, has_parent, o_orderstatus FROM (
          SELECT {KEY}o_orderkey AS key, o_orderkey, o_orderstatus, CAST({case('o_orderpriority', ad.PARENT_FLAG)} AS INTEGER) AS has_parent
          FROM orders)""",
    "raw_parents": "SELECT key, parent_key, has_parent FROM every_parent WHERE o_orderstatus <> 'P'",
    "parents": """
        SELECT key, parent_key, CAST(CASE WHEN has_parent >= 1 THEN 1 ELSE 0 END AS INTEGER) AS has_parent FROM raw_parents""",
    "type_map": f"SELECT * FROM ({values(list(fv.ISSUETYPE_MAPPING.items()))}) m(issuetype_raw, issuetype)",
    "res_map": f"SELECT * FROM ({values(list(fv.RESOLUTION_MAPPING.items()))}) m(resolution_raw, resolution)",
    # ---- staging ----
    "stg_issues": """
        SELECT id AS issue_id, key, summary, description, created_at, resolved_at, issuetype_raw, resolution_raw, priority,
          status, project, assignee, reporter, creator, votes, watches
        FROM raw_issues WHERE project = 'CORE'
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY id) = 1""",
    "stg_comments": "SELECT * FROM raw_comments WHERE key IN (SELECT key FROM stg_issues)",
    "stg_changelog": f"""
        SELECT * FROM raw_changelog WHERE key IN (SELECT key FROM stg_issues)
          AND upper(field) IN {in_list(fv.CHANGELOG_FIELDS)}""",
    "stg_issuelinks": "SELECT * FROM raw_issuelinks WHERE key IN (SELECT key FROM stg_issues)",
    # ---- intermediate ----
    "labelled": """
        SELECT b.*, coalesce(t.issuetype, 'Other') AS issuetype, r.resolution
        FROM stg_issues b LEFT JOIN type_map t USING (issuetype_raw) LEFT JOIN res_map r USING (resolution_raw)""",
    "cleaned": f"""
        SELECT key, issue_id, created_at, resolved_at, priority, status, project, assignee, reporter, creator, votes, watches,
          issuetype_raw, resolution_raw, issuetype, resolution, {clean('summary')} AS summary, {clean('description')} AS description,
          CAST(least(coalesce({days('created_at', 'resolved_at')}, 0), 5000) AS INTEGER) AS resolution_days,
          CAST(length(coalesce(summary, '')) AS INTEGER) AS summary_length,
          CAST(length(coalesce(description, '')) AS INTEGER) AS description_length,
          CASE WHEN created_at < TIMESTAMP '{ad.TRAIN_BEFORE}' THEN 'train'
               WHEN created_at < TIMESTAMP '{ad.VALIDATION_BEFORE}' THEN 'validation' ELSE 'excluded' END AS split
        FROM labelled WHERE resolution IS NOT NULL""",
    "analytics": f"""
        SELECT key, issue_id, created_at, resolved_at, coalesce(nullif(trim(priority, ' '), ''), 'Unknown') AS priority, status, project,
          assignee, reporter, votes, watches, issuetype, resolution,
          CAST(CASE WHEN created_at IS NOT NULL THEN least({days('created_at', f"coalesce(resolved_at, TIMESTAMP '{ad.AS_OF}')")}, 5000) END AS INTEGER) AS age_days,
          CAST(CASE WHEN created_at IS NOT NULL AND resolved_at IS NOT NULL THEN least({days('created_at', 'resolved_at')}, 5000) END AS INTEGER) AS resolution_days,
          CASE WHEN resolved_at IS NOT NULL THEN 1 ELSE 0 END AS is_resolved,
          CAST(date_trunc('month', created_at) AS TIMESTAMP) AS created_month, CAST(date_trunc('year', created_at) AS TIMESTAMP) AS created_year
        FROM labelled""",
    "clean_comments": f"""
        SELECT * FROM (SELECT * REPLACE ({clean('comment_body')} AS comment_body) FROM stg_comments) WHERE length(comment_body) >= 10""",
    "comments": """
        SELECT key, left(string_agg(comment_body, ' | ' ORDER BY comment_created NULLS LAST, comment_id), 3000) AS all_comments,
          count(*) AS n_comments, count(DISTINCT comment_author) AS n_commenters,
          min(comment_created) AS first_comment_at, max(comment_created) AS last_comment_at
        FROM clean_comments GROUP BY key""",
    "escalation": f"""
        SELECT key, (len(list_filter(range(1, len(ranks)), lambda i: ranks[i + 1] > ranks[i])) > 0)::INTEGER AS was_escalated FROM (
          SELECT key, list(nullif(list_position(['TRIVIAL', 'MINOR', 'MAJOR', 'CRITICAL', 'BLOCKER'], upper(to_string)), 0)
                      ORDER BY created NULLS LAST, {TIES}) AS ranks
          FROM stg_changelog WHERE upper(field) = 'PRIORITY' GROUP BY key)""",
    "first_assignee": f"""
        SELECT key, to_string AS first_assignee FROM stg_changelog WHERE upper(field) = 'ASSIGNEE' AND to_string IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY key ORDER BY created NULLS LAST, to_string) = 1""",
    "change_counts": """
        SELECT key, count(*) AS n_total_changes, count(*) FILTER (upper(field) = 'STATUS') AS n_status_changes,
          count(*) FILTER (upper(field) = 'PRIORITY') AS n_priority_changes,
          count(*) FILTER (upper(field) = 'ASSIGNEE') AS n_assignee_changes,
          count(*) FILTER (upper(field) = 'RESOLUTION') AS n_resolution_changes,
          count(DISTINCT author) AS n_people_involved FROM stg_changelog GROUP BY key""",
    "changelog_features": """
        SELECT a.*, coalesce(e.was_escalated, 0) AS was_escalated, f.first_assignee
        FROM change_counts a LEFT JOIN escalation e USING (key) LEFT JOIN first_assignee f USING (key)
        WHERE key IN (SELECT key FROM cleaned)""",
    "link_features": """
        SELECT key, count(*) AS n_links_total, count(*) FILTER (upper(type_name) = 'DUPLICATE') AS n_duplicates,
          count(*) FILTER (upper(type_name) = 'BLOCKER') AS n_blocks, count(*) FILTER (upper(type_name) = 'BLOCKED') AS n_blocked_by,
          count(*) FILTER (upper(type_name) = 'REFERENCE') AS n_relates, count(*) FILTER (upper(type_name) = 'CLONERS') AS n_clones,
          count(*) FILTER (upper(type_name) = 'CONTAINER') AS n_container FROM stg_issuelinks GROUP BY key""",
    "transitions": f"""
        SELECT key, from_status, to_string AS to_status, created AS transition_at,
          CASE WHEN {hours('prev', 'created')} < 0 THEN 0 ELSE {hours('prev', 'created')} END AS hours_in_from_status,
          (upper(to_string) = 'REOPENED' AND upper(from_status) IN ('RESOLVED', 'CLOSED'))::INTEGER AS is_reopen_event
        FROM (SELECT *, coalesce(nullif(trim(from_string, ' '), ''), 'Open') AS from_status,
                lag(created) OVER (PARTITION BY key ORDER BY created NULLS LAST, {TIES}) AS prev
              FROM stg_changelog WHERE upper(field) = 'STATUS' AND to_string IS NOT NULL)""",
    "daily": """
        SELECT activity_date, CAST(dayofweek(activity_date) AS INTEGER) AS day_of_week, CAST(weekofyear(activity_date) AS INTEGER) AS week_of_year,
          CAST(year(activity_date) AS INTEGER) AS year,
          coalesce(issues_created, 0) AS issues_created, coalesce(bugs_created, 0) AS bugs_created,
          coalesce(issues_resolved, 0) AS issues_resolved, coalesce(changelog_events, 0) AS changelog_events,
          coalesce(active_issues, 0) AS active_issues, coalesce(active_contributors, 0) AS active_contributors,
          coalesce(issues_created, 0) - coalesce(issues_resolved, 0) AS daily_backlog_delta
        FROM (SELECT CAST(created_at AS DATE) AS activity_date, count(*) AS issues_created,
                count(*) FILTER (issuetype = 'Bug') AS bugs_created FROM analytics GROUP BY 1)
        FULL JOIN (SELECT CAST(created AS DATE) AS activity_date, count(*) AS changelog_events, count(DISTINCT key) AS active_issues,
                count(DISTINCT author) AS active_contributors FROM stg_changelog GROUP BY 1) USING (activity_date)
        FULL JOIN (SELECT CAST(resolved_at AS DATE) AS activity_date, count(*) AS issues_resolved FROM analytics
                WHERE resolved_at IS NOT NULL GROUP BY 1) USING (activity_date)""",
    "fix_versions": r"""
        SELECT key, to_string AS version_raw, nullif(regexp_extract(to_string, '^[0-9]+\.[0-9]+'), '') AS version_minor,
          CASE WHEN to_string LIKE '1.%' THEN '1.x' WHEN to_string LIKE '2.%' THEN '2.x' WHEN to_string LIKE '3.%' THEN '3.x'
               WHEN to_string LIKE '4.%' THEN '4.x' ELSE 'Other' END AS version_major,
          CASE WHEN to_string ILIKE '%-rc%' THEN 1 ELSE 0 END AS is_rc, created AS assigned_at,
          issuetype, resolution, priority, resolution_days, is_resolved
        FROM stg_changelog JOIN analytics USING (key)
        WHERE upper(field) IN ('FIX VERSION', 'FIX VERSION/S') AND to_string IS NOT NULL AND trim(to_string, ' ') <> ''""",
    # ---- marts ----
    "mart_ml": f"""
        SELECT key, created_at, split, issuetype, resolution, summary AS summary_clean, description AS description_clean,
          coalesce(all_comments, '') AS comments_concat,
          left(repeat('[NO-DESCRIPTION] ', (length(description) = 0)::INTEGER)
            || repeat('[SHORT-DESC] ', (length(description) > 0 AND length(description) < 80)::INTEGER)
            || repeat('[NO-COMMENTS] ', (n_comments IS NULL)::INTEGER)
            || repeat('[CONTAINER-LINK] ', (n_container IS NOT NULL AND n_container > 0)::INTEGER)
            || printf('TICKET: %s%sPRI: %s%sDESC: ', summary, chr(10), priority, chr(10)) || description
            || repeat(' ' || left(coalesce(all_comments, ''), 600), (length(description) < 50)::INTEGER), 2000) AS text_for_it,
          left(printf('TICKET: %s%sTYPE: %s | PRI: %s%sDESC: %s%sCOMMENTS: %s', summary, chr(10), issuetype, priority, chr(10),
            left(description, 800), chr(10), left(coalesce(all_comments, ''), 400)), 2000) AS text_for_res,
          left(printf('TICKET: %s%sTYPE: %s | PRI: %s%sDESC: %s', summary, chr(10), issuetype, priority, chr(10),
            left(description, 800)), 2000) AS text_noco,
          priority, status, reporter, assignee,
          {zero('n_total_changes', 'n_status_changes', 'n_priority_changes', 'n_assignee_changes', 'n_resolution_changes',
                'was_escalated', 'n_people_involved')}, first_assignee,
          {zero('n_links_total', 'n_duplicates', 'n_blocks', 'n_blocked_by', 'n_relates', 'n_container', 'n_comments', 'n_commenters')},
          resolution_days, summary_length, description_length, {zero('has_parent')}, parent_key
        FROM cleaned LEFT JOIN comments USING (key) LEFT JOIN changelog_features USING (key)
        LEFT JOIN link_features USING (key) LEFT JOIN parents USING (key)
        WHERE split IN ('train', 'validation')""",
    "ops": f"""
        SELECT key, issuetype, priority, status, assignee, reporter, resolution, created_at, resolved_at, resolution_days, age_days,
          is_resolved, created_month, created_year, votes, watches, {zero('n_comments', 'n_commenters')}, first_comment_at,
          CASE WHEN first_comment_at IS NOT NULL THEN {hours('created_at', 'first_comment_at')} END AS hours_to_first_response
        FROM analytics LEFT JOIN comments USING (key)""",
    "modal": """
        SELECT assignee, issuetype AS top_issuetype FROM analytics GROUP BY assignee, issuetype
        QUALIFY row_number() OVER (PARTITION BY assignee ORDER BY count(*) DESC, issuetype) = 1""",
    "workload": f"""
        SELECT assignee, count(*) AS n_assigned, CAST(sum(is_resolved) AS BIGINT) AS n_fixed,
          count(*) - CAST(sum(is_resolved) AS BIGINT) AS n_open_backlog,
          {half_up('sum(CASE WHEN is_resolved = 1 THEN resolution_days END)', 'count(CASE WHEN is_resolved = 1 THEN resolution_days END)', 1)} AS avg_resolution_days,
          round(median(CASE WHEN is_resolved = 1 THEN resolution_days END), 1) AS median_resolution_days,
          {half_up('100 * sum(is_resolved)', 'count(*)', 2)} AS resolution_rate_pct,
          count(*) FILTER (issuetype = 'Bug') AS n_bugs, count(*) FILTER (issuetype = 'Improvement') AS n_improvements,
          count(*) FILTER (issuetype = 'New Feature') AS n_new_features, any_value(top_issuetype) AS top_issuetype,
          count(DISTINCT issuetype) AS n_distinct_issuetypes, min(created_at) AS first_assignment, max(created_at) AS last_assignment
        FROM analytics JOIN modal USING (assignee) WHERE assignee <> 'Unassigned' GROUP BY assignee""",
    "links": """
        SELECT key, n_links_total, n_duplicates, n_blocks, n_blocked_by, n_relates,
          n_duplicates + n_blocks + n_blocked_by AS n_outgoing_plus_incoming FROM link_features WHERE n_links_total > 0""",
    "sankey": f"""
        SELECT from_status, to_status, count(*) AS n_transitions,
          {half_up('sum(hours_in_from_status)', 'count(hours_in_from_status)', 1)} AS avg_hours_before_transition,
          round(median(hours_in_from_status), 1) AS median_hours_before_transition,
          CAST(sum(is_reopen_event) AS BIGINT) AS n_reopen_events FROM transitions GROUP BY from_status, to_status""",
    "state_time": f"""
        SELECT *, status || ' (moy. ' || printf('%.1f', avg_days) || 'j)' AS status_label FROM (
          SELECT from_status AS status, count(*) AS n_exits, {half_up('sum(hours_in_from_status)', 'count(*)', 1)} AS avg_hours,
            round(median(hours_in_from_status), 1) AS median_hours,
            {half_up('sum(hours_in_from_status)', '24 * count(*)', 1)} AS avg_days,
            round(median(hours_in_from_status) / 24.0::DOUBLE, 1) AS median_days
          FROM transitions WHERE hours_in_from_status IS NOT NULL GROUP BY from_status)""",
    "versions": f"""
        SELECT version_major, version_minor, issuetype, count(DISTINCT key) AS n_issues,
          count(DISTINCT CASE WHEN issuetype = 'Bug' THEN key END) AS n_bugs,
          count(DISTINCT CASE WHEN issuetype = 'Improvement' THEN key END) AS n_improvements,
          count(DISTINCT CASE WHEN issuetype = 'New Feature' THEN key END) AS n_new_features,
          count(DISTINCT CASE WHEN is_resolved = 1 THEN key END) AS n_resolved,
          {half_up('sum(CASE WHEN is_resolved = 1 THEN resolution_days END)', 'count(CASE WHEN is_resolved = 1 THEN resolution_days END)', 1)} AS avg_resolution_days,
          round(median(CASE WHEN is_resolved = 1 THEN resolution_days END), 1) AS median_resolution_days,
          {half_up("100 * count(DISTINCT CASE WHEN issuetype = 'Bug' THEN key END)", 'count(DISTINCT key)', 2)} AS bug_ratio_pct
        FROM fix_versions WHERE version_major <> 'Other' GROUP BY version_major, version_minor, issuetype""",
    "calendar": f"""
        SELECT *, CAST(sum(daily_backlog_delta) OVER (ORDER BY activity_date NULLS LAST ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_backlog,
          {half_up('sum(issues_created) OVER w', 'count(*) OVER w', 1)} AS issues_created_7d_avg,
          {half_up('sum(issues_resolved) OVER w', 'count(*) OVER w', 1)} AS issues_resolved_7d_avg,
          {half_up('sum(active_contributors) OVER w', 'count(*) OVER w', 1)} AS contributors_7d_avg,
          {half_up('100 * (issues_created + changelog_events)', 'max(issues_created + changelog_events) OVER ()', 1)} AS activity_intensity
        FROM daily WINDOW w AS (ORDER BY activity_date NULLS LAST ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
}

TEXT = "lower(coalesce(summary, '') || ' ' || coalesce(description, ''))"
CTES["tickets"] = "SELECT * FROM cleaned WHERE split IN ('train', 'validation')"
CTES["predicted"] = f"""
    SELECT *, {rules(TEXT, [(w, t) for w, t, _ in fv.PREDICTION_RULES], fv.PREDICTION_DEFAULT[0])} AS pred_issuetype,
      {rules(TEXT, [(w, r) for w, _, r in fv.PREDICTION_RULES], fv.PREDICTION_DEFAULT[1])} AS pred_resolution FROM tickets"""


def sql(final: str) -> str:
    """The final query behind the CTEs it uses, in the order of definition."""
    needed: set[str] = set()
    names = re.compile(r"\b(" + "|".join(map(re.escape, CTES)) + r")\b")

    def add(text: str) -> None:
        for name in set(names.findall(text)) - needed:
            needed.add(name)
            add(CTES[name])

    add(final)
    ctes = ", ".join(f"{name} AS ({body})" for name, body in CTES.items() if name in needed)
    return f"WITH {ctes} {final}" if ctes else final


def table(name: str) -> str:
    return sql(f"SELECT * FROM {name}")

"""SQL counterparts of the registered queries, for an independent engine.

They are written against the raw tables and restate each rule in plain SQL;
only constants, prompt texts and the damaged input texts are shared.
"""

from __future__ import annotations

from quillgate.functions.text import WHITESPACE
from quillgate.operators import evaluation, extraction, prompts
from quillgate.queries import bindings as b
from quillgate.queries.spark_queries import BATCH, SEED, TOP


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS = lit(WHITESPACE)
NL = "chr(10)"
NL2 = "chr(10) || chr(10)"


def words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^\s]+'))"


def cases(key: str, table: dict, default: str) -> str:
    whens = " ".join(f"when {lit(k)} then {v}" for k, v in table.items())
    return f"case {key} {whens} else {default} end"


def rid(x: str) -> str:
    return f"printf('rule-%06d', {x} + 1)"


# -- inputs ------------------------------------------------------------------

D = f"""d0 as (
  select doc_id, doc_id as "index", {rid('doc_id')} as record_id, text, lang, source, n_chars,
    {b.COMPLEXITY_SQL} as complexity, string_split(text, chr(10)) as lines
  from documents),
d1 as (select *, lines[1:len(lines) - 1] as statements, lines[len(lines)] as schedule from d0),
d as (select *, '[' || coalesce(array_to_string(list_transform(statements,
    lambda x: {b.quoted('x')}), ','), '') || ']' as sj from d1)"""

L = f"""l as (
  select doc_id, {rid('doc_id')} as record_id, quality, toxic,
    {b.FAITHFUL_SQL} as fa, {b.TIMING_SQL} as sa from labels)"""


def yes(x: str) -> str:
    return f"starts_with(upper(trim({x}, {WS})), 'YES')"


# evaluated labelled records; ok_f and ok_s are the verdicts
E = f"""e as (
  select d.*, l.quality, l.toxic, l.fa, l.sa, d.doc_id % 13 = 0 as no_output,
    {yes('fa')} as ok_f, {yes('sa')} as ok_s
  from d join l using (doc_id)),
ev as (
  select *,
    case when no_output then 0.0e0 else 100.0e0 end as schema_score,
    case when not no_output then case when ok_f then 100.0e0 else 0.0e0 end end as faithfulness_score,
    case when not no_output then case when ok_s then 100.0e0 else 0.0e0 end end as schedule_score,
    case when no_output then 0.0e0
      else round((100.0e0 + (case when ok_f then 100.0e0 else 0.0e0 end)
        + (case when ok_s then 100.0e0 else 0.0e0 end)) / 3.0e0, 2) end as overall_score,
    not no_output and ok_f and ok_s as overall_pass
  from e)"""

BASE = f"with {D}, {L}, {E}"
FLAT = "record_id, schema_score, faithfulness_score, schedule_score, overall_score, overall_pass"
MISSING = lit(evaluation.MISSING_REASON)

ORACLES: dict[str, str] = {}

# -- evaluation --------------------------------------------------------------

ORACLES["verdict_scores"] = f"""with {L}, a as (
  select record_id, 'faithfulness' as metric, fa as answer from l
  union all select record_id, 'schedule', sa from l)
select record_id, metric, case when {yes('answer')} then 100.0e0 else 0.0e0 end as score,
  {yes('answer')} as passed, trim(answer, {WS}) as reason from a"""

ORACLES["record_rollup"] = f"{BASE} select {FLAT} from ev"

ORACLES["missing_output_eval"] = f"""{BASE}, m as (
  select *, case when doc_id % 13 = 0 or doc_id % 17 = 0 then 'missing'
    when doc_id % 19 = 0 then 'invalid' else 'valid' end as kind from e)
select record_id,
  case kind when 'valid' then 100.0e0 else 0.0e0 end as schema_score,
  case when kind <> 'missing' then case when ok_f then 100.0e0 else 0.0e0 end end as faithfulness_score,
  case when kind <> 'missing' then case when ok_s then 100.0e0 else 0.0e0 end end as schedule_score,
  case kind when 'missing' then {MISSING} else '' end as schema_reason,
  case when kind = 'missing' then 0.0e0 else round(((case kind when 'valid' then 100.0e0 else 0.0e0 end)
    + (case when ok_f then 100.0e0 else 0.0e0 end) + (case when ok_s then 100.0e0 else 0.0e0 end)) / 3.0e0, 2)
  end as overall_score,
  kind = 'valid' and ok_f and ok_s as overall_pass
from m"""

FAITH_PROMPT = (
    f"{lit(prompts.JUDGE_FAITHFULNESS)} || {NL2} || 'Instruction:' || {NL} || text || {NL2} || 'Statements:' "
    f"|| {NL} || coalesce(array_to_string(statements, chr(10)), '')"
)
SCHEDULE_PROMPT = (
    f"{lit(prompts.JUDGE_SCHEDULE)} || {NL2} || 'Instruction:' || {NL} || text || {NL2} || 'Schedule:' "
    f"|| {NL} || schedule"
)
ORACLES["judge_prompts"] = f"""with {D}, p as (
  select record_id, 'faithfulness' as metric, {FAITH_PROMPT} as prompt from d where doc_id % 13 <> 0
  union all select record_id, 'schedule', {SCHEDULE_PROMPT} from d where doc_id % 13 <> 0)
select record_id, metric, md5(prompt) as prompt_md5, length(prompt) as n_chars from p"""

ORACLES["pass_rates"] = f"""{BASE}, r as (
  select 'schema' as metric, not no_output as passed from ev
  union all select 'faithfulness', ok_f from ev where not no_output
  union all select 'schedule', ok_s from ev where not no_output
  union all select 'overall', overall_pass from ev)
select metric, count(*) as records, count(*) filter (where passed) as passed,
  round(count(*) filter (where passed) / cast(count(*) as double) * 100, 2) as pass_rate
from r group by metric"""

ORACLES["custom_metric_eval"] = f"""{BASE}, g as (
  select *, case when doc_id % 11 = 0 then 0.0e0 else (doc_id % 5) * 25.0e0 end as grade from ev),
h as (select *, not no_output and ok_f and ok_s and grade >= 50 as all_pass,
  case when no_output then 0.0e0 else round((100.0e0 + (case when ok_f then 100.0e0 else 0.0e0 end)
    + (case when ok_s then 100.0e0 else 0.0e0 end) + grade) / 4.0e0, 2) end as mean from g),
r as (
  select 'schema' as metric, not no_output as passed from h
  union all select 'faithfulness', ok_f from h where not no_output
  union all select 'schedule', ok_s from h where not no_output
  union all select 'grade', grade >= 50 from h where not no_output
  union all select 'overall', all_pass from h)
select metric, count(*) as records, count(*) filter (where passed) as passed,
  round(count(*) filter (where passed) / cast(count(*) as double) * 100, 2) as pass_rate from r group by metric
union all select 'score', count(*), count(*) filter (where all_pass), round(avg(mean), 6) from h"""

ORACLES["score_histogram"] = (
    f"{BASE} select overall_score, count(*) as records from ev group by overall_score"
)

ORACLES["top_failing"] = f"""{BASE}
select record_id, overall_score, concat_ws(' | ',
  case when no_output then 'schema: ' || {MISSING} end,
  case when not no_output and not ok_f then 'faithfulness: ' || trim(fa, {WS}) end,
  case when not no_output and not ok_s then 'schedule: ' || trim(sa, {WS}) end) as reasons
from ev where not overall_pass order by overall_score, record_id limit {TOP}"""

ORACLES["quality_gate"] = f"""{BASE}, q as (
  select count(*) as records,
    round(count(*) filter (where overall_pass) / cast(count(*) as double), 4) as pass_share from ev)
select records, pass_share, pass_share >= 0.7e0 as gate_open from q"""

ORACLES["metric_gate"] = f"""{BASE}, r as (
  select 'schema' as metric, lang, not no_output as passed, 0.9e0 as threshold from ev
  union all select 'faithfulness', lang, ok_f, 0.3e0 from ev where not no_output
  union all select 'schedule', lang, ok_s, 0.5e0 from ev where not no_output
  union all select 'overall', lang, overall_pass, 0.2e0 from ev),
g as (select metric, case when grouping(lang) = 1 then 'all' else 'group' end as level, lang, any_value(threshold) as threshold,
  count(*) as records, round(count(*) filter (where passed) / cast(count(*) as double), 4) as pass_share
  from r group by grouping sets ((metric), (metric, lang)))
select *, pass_share >= threshold as holds, bool_and(pass_share >= threshold) over () as gate_open from g"""

ORACLES["gold_overlap"] = rf"""with g as (
  select {rid('item_id')} as record_id, list_distinct(regexp_extract_all(lower(text), '[^\s]+')) as gold
  from benchmark),
f as (
  select {rid('doc_id')} as record_id, list_distinct(regexp_extract_all(lower(text), '[^\s]+')) as found
  from documents),
c as (select record_id, coalesce(len(found), 0) as n_found, len(gold) as n_gold,
  coalesce(len(list_intersect(found, gold)), 0) as n_common from g left join f using (record_id))
select *, round(n_common / nullif(cast(n_found as double), 0), 6) as "precision",
  round(n_common / cast(n_gold as double), 6) as recall from c"""

# -- gate --------------------------------------------------------------------

ORACLES["dedup_last_wins"] = """select md5(text) as record_id, max(doc_id) as "index",
  arg_max(source, doc_id) as source from documents group by md5(text)"""

ORACLES["gate_join"] = f"""{BASE}, last as (
  select md5(text) as record_id, max(doc_id) as "index" from d group by md5(text)),
s as (select last.*, case when d.doc_id % 13 <> 0 then len(d.statements) end as n_statements
  from last join d on d.doc_id = last."index")
select s.record_id, s."index", s.n_statements, ev.overall_score, ev.overall_pass
from ev join s on s.record_id = md5(ev.text)"""

ORACLES["gate_unmatched"] = f"""{BASE}
select record_id, overall_score, overall_pass from ev where not contains(text, chr(10))"""

SUMMARY = """count(*) as total,
  count(*) filter (where contains(text, chr(10)) and overall_pass) as passed,
  count(*) filter (where contains(text, chr(10)) and not overall_pass) as failed,
  count(*) filter (where not contains(text, chr(10))) as unmatched"""
SUMMARY_PCT = """*, round(passed * 100 / cast(total as double), 1) as passed_pct,
  round(failed * 100 / cast(total as double), 1) as failed_pct"""
ORACLES["gate_summary"] = f"{BASE}, c as (select {SUMMARY} from ev) select {SUMMARY_PCT} from c"
ORACLES["gate_summary_by_lang"] = (
    f"{BASE}, c as (select lang, {SUMMARY} from ev group by lang) select {SUMMARY_PCT} from c"
)

ORACLES["split_write"] = f"""{BASE} select record_id,
  case when overall_pass then 'passed' else 'failed' end as verdict, overall_score,
  md5(text) as text_md5 from ev"""

# -- planning ----------------------------------------------------------------

ORACLES["complexity_distribution"] = """with n as (select lang, count(*) as n from documents group by lang)
select lang, cast(ord as int) as ord, complexity, n // 3 + case when n % 3 > ord then 1 else 0 end as n_class
from n, (values (0, 'simple'), (1, 'medium'), (2, 'complex')) t(ord, complexity)"""

ORACLES["plan_expand"] = f"""with c as (
  select case when n_chars < 500 then 0 when n_chars < 2000 then 1 else 2 end as ord from documents),
p as (select ord, row_number() over (order by ord) - 1 as "index" from c)
select "index", {rid('"index"')} as record_id,
  case ord when 0 then 'simple' when 1 then 'medium' else 'complex' end as complexity from p"""

PENDING = f"""select record_id, "index", complexity from d
  where not exists (select 1 from labels where labels.doc_id = d.doc_id)"""
ORACLES["pending_records"] = f"with {D} {PENDING}"
ORACLES["next_batch"] = f'with {D}, p as ({PENDING}) select * from p order by "index" limit {BATCH}'
ORACLES["next_batch_large"] = f"""with {D}, p as ({PENDING}),
r as (select *, row_number() over (order by "index") as rn, count(*) over () as n from p)
select record_id, "index", complexity from r where rn <= n // 2"""

ORACLES["prefix_commit"] = f"""with {D}
select "index", record_id from d where doc_id < coalesce(
  (select min(doc_id) from labels where quality = 0 and toxic = 1), 9223372036854775807)"""

ORACLES["id_mismatch"] = f"""with {D}
select "index", record_id as planned_id, {rid('doc_id + 2')} as found_id from d
where regexp_matches(text, '[!"]')"""

ORACLES["stage_handoff"] = """select count(*) as planned, count(l.doc_id) as available,
  count(*) - count(l.doc_id) as missing, count(*) = count(l.doc_id) as complete
from documents d left join labels l on d.doc_id = l.doc_id"""

ORACLES["missing_upstream"] = f"with {D} {PENDING}"

ORACLES["record_lookup"] = f"""with {D}
select d.record_id, d."index", d.complexity, l.quality, l.doc_id is not null as record_found
from d left join labels l using (doc_id)"""

STATUS = f"""st as (select user_id, {rid('user_id')} as record_id, event_id, ts,
  case when event_type in ('purchase', 'signup') then 'completed'
    when event_type = 'error' then 'failed' else 'pending' end as status from events),
last as (select record_id, user_id, status, event_id, ts from (
  select *, row_number() over (partition by record_id order by event_id desc) as rn from st) where rn = 1)"""
ORACLES["latest_state"] = f"with {STATUS} select record_id, status, event_id as seq from last"
ORACLES["progress"] = f"""with {STATUS}
select count(*) as planned, count(*) filter (where status = 'completed') as completed,
  arg_max(record_id, user_id) filter (where status = 'completed') as last_id,
  strftime(max(ts) filter (where status = 'completed'), '%Y-%m-%d %H:%M:%S.%f') as last_at
from last"""

ORACLES["completion_counts"] = f"""with {D}
select coalesce(complexity, 'all') as complexity, count(*) as planned, count(l.doc_id) as completed
from d left join labels l using (doc_id) group by rollup (complexity)"""

ORACLES["resume_guard"] = """with a as (
  select source, max(lang) as model, count(*) / 1000.0e0 as t from documents group by source),
c as (select source, max(lang) as model, count(*) / 1000.0e0 as t
  from documents join labels using (doc_id) group by source),
j as (select a.source, a.model <> c.model as m, abs(a.t - c.t) > 1e-9 as t from a join c using (source))
select source as run_id, 'model' as setting from j where m
union all select source, 'temperature' from j where t"""

# -- sampling and prompts ----------------------------------------------------


def number(*parts: str) -> str:
    joined = " || '|' || ".join(parts)
    return f"('0x' || substr(md5({joined}), 1, 15))::bigint"


TONE = (
    f"case {number(lit(SEED), 'record_id', lit('tone'))} % 3 "
    "when 0 then 'formal' when 1 then 'direct' else 'casual' end"
)
ORACLES["tone_assign"] = f"with {D} select record_id, {TONE} as tone from d"


def sample_ctes(records: str) -> str:
    """Draws without replacement, one step per draw; ``records`` must have
    record_id and complexity."""
    steps = [f"""k as (select count(*) as k from part),
prof as (select row_number() over (order by p_partkey) - 1 as pos, p_partkey, p_name,
  p_brand || ' ' || p_type || ' size ' || p_size as descr from part),
w as (select *, {TONE} as tone, least((select k from k), {number(lit(SEED), 'record_id', lit('n'))} % 2 +
  case complexity when 'simple' then 1 when 'medium' then 3 else 4 end) as n, (select k from k) as k
  from {records}),
s0 as (select *, []::bigint[] as picks from w)"""]
    for j in range(1, 6):
        free = f"{number(lit(SEED), 'record_id', lit(str(j)))} % greatest(k - {j} + 1, 1)"
        # move past the earlier picks in rising order, one column per pick
        steps.append(f"f{j}_0 as (select *, list_sort(picks) as sorted, {free} as free from s{j - 1})")
        for i in range(1, j):
            steps.append(
                f"f{j}_{i} as (select * replace (case when len(sorted) >= {i} and free >= sorted[{i}] "
                f"then free + 1 else free end as free) from f{j}_{i - 1})"
            )
        steps.append(
            f"s{j} as (select * exclude (sorted, free) replace (case when n >= {j} "
            f"then list_append(picks, free) else picks end as picks) from f{j}_{j - 1})"
        )
    steps.append("""dr as (select record_id, unnest(range(len(picks))) as draw, unnest(picks) as pos from s5),
kp as (select dr.record_id, dr.draw, prof.* from dr join prof using (pos))""")
    return ",\n".join(steps)


SAMPLED = f"with {D}, {sample_ctes('d')}"
SECTION = (
    f"{lit(prompts.KPI_HEADER)} || {NL2} || string_agg('KPI ' || (draw + 1) || ': ' || descr, {NL2} order by draw) "
    f"|| {NL2} || {lit(prompts.KPI_FOOTER)}"
)
ORACLES["kpi_sample"] = f"{SAMPLED} select record_id, draw, p_partkey as profile_id, p_name as profile_name from kp"
ORACLES["kpis_used"] = f"""{SAMPLED} select record_id, count(*) as num_kpis,
  string_agg(p_partkey::varchar, ',' order by draw) as profile_ids from kp group by record_id"""
ORACLES["kpi_section"] = f"{SAMPLED} select record_id, {SECTION} as section from kp group by record_id"


def generation_prompt_sql() -> str:
    guides = {k: lit(v) for k, v in prompts.COMPLEXITY_GUIDES.items()}
    parts = [
        lit(prompts.GENERATE_OPENING),
        "section",
        cases("tone", {k: lit(v) for k, v in prompts.TONE_GUIDES.items()}, "''"),
        lit(prompts.SCHEDULE_GUIDE),
        "'Complexity: ' || upper(complexity)",
        cases("complexity", guides, guides["complex"]),
        lit(prompts.GENERATE_CLOSING),
    ]
    return f" || {NL2} || ".join(f"({p})" for p in parts)


WITH_SECTION = f"""sec as (select record_id, {SECTION} as section from kp group by record_id),
pr as (select w.record_id, w.complexity, w.tone, w.n, {generation_prompt_sql()} as prompt
  from w join sec using (record_id))"""
ORACLES["generation_prompt"] = f"{SAMPLED}, {WITH_SECTION} select record_id, prompt from pr"

ORACLES["generate_stage"] = f"""with p0 as (
  select doc_id as i, (select count(*) from documents) as n from documents),
p as (select {rid('i')} as record_id,
  case when i < n // 3 + least(n % 3, 1) then 'simple'
    when i < 2 * (n // 3) + least(n % 3, 2) then 'medium' else 'complex' end as complexity from p0),
{sample_ctes('p')}, {WITH_SECTION},
q as (select *, 'user:' || {NL} || prompt as request from pr)
select record_id, complexity, tone, n as num_kpis,
  'answer ' || md5(request) || ' of ' || length(request) as utterance from q"""

ORACLES["stage_resume"] = f"""with p as (
  select doc_id as i, (select count(*) from documents) as n from documents)
select {rid('i')} as record_id, i as index,
  case when i < n // 3 + least(n % 3, 1) then 'simple'
    when i < 2 * (n // 3) + least(n % 3, 2) then 'medium' else 'complex' end as complexity,
  'completed' as status, least(i // (n // 3), 2) + 1 as commit, 1 as n_rows, 0 as refused_commits from p"""

ORACLES["extraction_request"] = f"""with {D}
select record_id, 'system' as role, md5({lit(prompts.EXTRACT_SYSTEM)}) as content_md5 from d
union all
select record_id, 'user', md5({lit(prompts.EXTRACT_USER.rstrip())} || {NL} || text) from d"""

ORACLES["messages"] = f"""select conv_id, turn, 'system:' || {NL} || {lit(prompts.EXTRACT_SYSTEM)} || {NL2}
  || 'user:' || {NL} || {lit(prompts.EXTRACT_USER.rstrip())} || {NL} || text as request
from conversations where role = 'user'"""

PREVIOUS = f"""'{{"normal_statements":' || sj || ',"schedule":' || {b.quoted('schedule')} || '}}'"""
FEEDBACK = f"""{lit(prompts.FEEDBACK_OPENING)} || {NL2} || 'Instruction:' || {NL} || text || {NL2}
  || 'Previous result:' || {NL} || {PREVIOUS} || {NL2} || 'Feedback:' || {NL}
  || '- Faithfulness: ' || trim(fa, {WS}) || {NL} || '- Schedule: ' || trim(sa, {WS})"""
ORACLES["feedback_prompt"] = f"{BASE} select record_id, {FEEDBACK} as prompt from ev where not no_output"

AUDIT = rf"""a0 as (select record_id, complexity, {words('text')} as n_words,
  case complexity when 'simple' then regexp_matches(text, '[<>]|==|(^|\s)(AND|OR)(\s|$)')
    when 'medium' then regexp_matches(text, '[<>]|&&|\|\|') else regexp_matches(text, '[<>!]|&&|\|\|') end as has_marks,
  contains(trim(text, {WS}), chr(10)) as many_lines from d),
a1 as (select *, not case complexity when 'simple' then n_words between 25 and 50
  when 'medium' then n_words between 50 and 75 else n_words between 75 and 110 end as bad_length from a0),
a as (select *, not (bad_length or has_marks or many_lines) as in_contract from a1)"""
ORACLES["contract_audit"] = (
    f"with {D}, {AUDIT} select record_id, n_words, bad_length, has_marks, many_lines, in_contract from a"
)
ORACLES["contract_summary"] = f"""with {D}, {AUDIT} select complexity, count(*) as records,
  count(*) filter (where bad_length) as bad_length, count(*) filter (where has_marks) as has_marks,
  count(*) filter (where many_lines) as many_lines, count(*) filter (where in_contract) as in_contract
from a group by complexity"""

# -- completions -------------------------------------------------------------

ORACLES["completion_attach"] = f"""with {D}, {L},
p as (select record_id, doc_id, {lit(prompts.EXTRACT_USER.rstrip())} || {NL} || text as prompt from d),
c as (select prompt, min(fa) as cached from p join l using (doc_id) group by prompt)
select record_id,
  case when cached is not null then trim(cached, {WS})
    when not contains(prompt, '!') then 'answer ' || md5(prompt) || ' of ' || length(prompt) end as response,
  case when cached is null and contains(prompt, '!') then 'ValueError: refused' end as error
from p left join c using (prompt)"""

ORACLES["completion_resume"] = f"""with {D},
p as (select record_id, {lit(prompts.EXTRACT_USER.rstrip())} || {NL} || text as prompt from d)
select record_id, 'answer ' || md5(prompt) || ' of ' || length(prompt) as response,
  case when sha256('model-a@0.0' || chr(31) || prompt) < '8' then 'first' else 'second' end as answered_by,
  1 as calls from p"""

CLASS = """case when error is null then null
  when lower(error) like '%timeout%' or lower(error) like '%timed out%' then 'timeout'
  when lower(error) like '%401%' or lower(error) like '%unauthorized%' then 'auth'
  when lower(error) like '%429%' or lower(error) like '%rate limit%' then 'rate_limit'
  else 'fatal' end"""
ATTEMPTS = f"""att as (select cast({b.REQUEST_SQL} as varchar) as request_id, event_id as attempt,
  {b.ENDPOINT_SQL} as endpoint, {b.ERROR_SQL} as error from events)"""
ORACLES["error_classes"] = f"""with {ATTEMPTS}
select {CLASS} as error_class, count(*) as attempts from att where error is not null group by 1"""

ORACLES["retry_frontier"] = f"""with {ATTEMPTS},
r as (select *, row_number() over (partition by request_id order by attempt desc) as rn,
  count(*) over (partition by request_id, endpoint) as tries from att),
v as (select request_id, count(distinct endpoint) as visited from att group by request_id),
z as (select r.request_id, endpoint, tries, visited, {CLASS} as cls from r join v using (request_id) where rn = 1),
y as (select *, case when cls is null then 'done' when cls = 'fatal' then 'fatal'
  when cls = 'timeout' and tries < 5 then 'retry_same'
  when visited >= 8 then 'exhausted' else 'rotate' end as action from z)
select request_id, action, cast(case action when 'retry_same' then endpoint
  when 'rotate' then (endpoint + 1) % 8 end as bigint) as next_endpoint from y"""

EXTRACT_REQUEST = f"""'system:' || {NL} || {lit(prompts.EXTRACT_SYSTEM)} || {NL2}
  || 'user:' || {NL} || {lit(prompts.EXTRACT_USER.rstrip())} || {NL} || text"""
ORACLES["extract_stage"] = f"""with {D}, q as (select record_id, {EXTRACT_REQUEST} as request from d)
select record_id, 'completed' as structured_status, md5(request) as statement,
  length(request)::varchar as schedule from q where not contains(request, '!')"""

COIN = "case when md5({}) < '9' then 100.0e0 else 0.0e0 end"
ORACLES["evaluate_stage"] = f"""with {D}, q as (select record_id, doc_id % 13 = 0 as gone,
    case when doc_id % 13 <> 0 then {COIN.format(FAITH_PROMPT)} end as f,
    case when doc_id % 13 <> 0 then {COIN.format(SCHEDULE_PROMPT)} end as s from d)
select record_id, case when gone then 0.0e0 else 100.0e0 end as schema_score, f as faithfulness_score,
  s as schedule_score, case when gone then 0.0e0 else round((100.0e0 + f + s) / 3.0e0, 2) end as overall_score,
  coalesce(f = 100 and s = 100, false) as overall_pass from q"""

# -- extraction --------------------------------------------------------------

TRIM_RAW = f"trim(raw, {WS})"
PAYLOAD = rf"""case when starts_with({TRIM_RAW}, {b.FENCE_SQL}) then trim(regexp_replace(
    regexp_replace({TRIM_RAW}, '^```[^\n]*(\n|$)', ''), '((^|\n)[ \t]*```[^\n]*)+$', ''), {WS})
  else {TRIM_RAW} end"""
RAW = f"raw as (select *, {b.COMPLETION_SQL} as raw from d), pl as (select *, {PAYLOAD} as payload from raw)"


def valid(j: str) -> str:
    return f"""(case when not json_valid({j}) then false else coalesce(json_type({j}) = 'OBJECT'
      and json_type({j}, '$.schedule') = 'VARCHAR' and json_type({j}, '$.normal_statements') = 'ARRAY'
      and len(list_filter(json_type({j}, '$.normal_statements[*]'), lambda t: t <> 'VARCHAR')) = 0, false) end)"""


ORACLES["fence_strip"] = f"with {D}, {RAW} select record_id, payload from pl"

CHECKED = f"ck as (select *, {valid('payload')} as ok from pl)"
ORACLES["extract_validate"] = f"""with {D}, {RAW}, {CHECKED}
select record_id, ok as is_valid, case when ok then json_array_length(payload, '$.normal_statements')::bigint end as n_statements,
  case when ok then coalesce(array_to_string(json_extract_string(payload, '$.normal_statements[*]'), chr(10)), '') end as statements,
  case when ok then json_extract_string(payload, '$.schedule') end as schedule from ck"""

ORACLES["structured_attach"] = f"""with {D}, {RAW}, {CHECKED}
select record_id, case when ok then 'completed' else 'failed' end as structured_status,
  case when not ok then {lit(extraction.INVALID)} end as structured_error,
  case when ok then md5({b.OUTPUT_SQL}) end as output_md5 from ck"""

SLINES = f"""sl as (select record_id, {b.STRUCTURED_LINE_SQL} as j from d),
so as (select *, json_type(j, '$.structured_output') as t, json_extract_string(j, '$.structured_output') as inner_text,
  json_extract(j, '$.structured_output')::varchar as o from sl),
sv as (select *, coalesce(t = 'VARCHAR' and not json_valid(inner_text), false) as bad_text,
  case when t = 'VARCHAR' then case when json_valid(inner_text) then inner_text end else o end as v from so)"""
ORACLES["output_from_string"] = f"""with {D}, {SLINES}
select record_id, case when json_type(v, '$.schedule') = 'VARCHAR' then json_extract_string(v, '$.schedule') end as schedule,
  bad_text from sv"""
S_ISSUE = f"""case when json_type(j, '$.utterance') is null then 'missing_utterance'
  when bad_text then 'structured_output_not_json'
  when v is null or json_type(v) = 'NULL' then 'missing_structured_output'
  when not {valid('v')} then 'invalid_structured_output'
  when json_extract_string(j, '$.structured_status') is distinct from 'completed' then 'incomplete_status' end"""
ORACLES["structured_issues"] = f"with {D}, {SLINES} select record_id, {S_ISSUE} as issue from sv"
ORACLES["structured_issue_counts"] = f"""with {D}, {SLINES}, i as (select {S_ISSUE} as issue from sv)
select issue, count(*) as records from i where issue is not null group by issue"""

ORACLES["structured_repair_jsonl"] = f"""with {D}, {SLINES},
w as (select *, {S_ISSUE} as issue, json_extract_string(j, '$.utterance') as text, json_keys(j) as k from sv),
r as (select *, {EXTRACT_REQUEST} as request from w),
x as (select *, case when issue is null then null when issue = 'missing_utterance' then 'record has no utterance'
  when contains(request, '!') then 'ValueError: refused' end as why, issue is not null as bad from r),
m as (select *, k || case when bad and why is null and not list_contains(k, 'structured_output') then ['structured_output'] else [] end
  || case when bad and not list_contains(k, 'structured_status') then ['structured_status'] else [] end
  || case when not bad then [] when why is null then ['repair_history'] else ['structured_error'] end as all_k from x)
select record_id, case when why is null then 'completed' else 'failed' end as structured_status, why as structured_error,
  case when bad and why is null then length(request)::varchar
    when json_type(v, '$.schedule') = 'VARCHAR' then json_extract_string(v, '$.schedule') end as schedule,
  case when bad and why is null then 1 else 0 end as n_repairs, array_to_string(all_k, ',') as members,
  case when why is null then 'completed' else 'failed' end as plan_status from m"""

# -- repair ------------------------------------------------------------------

ORACLES["repair_open_fields"] = f"""with {D}, n as (select *, '"utterance":"new ' || md5(text) || '"' as u from d)
select record_id, case
  when doc_id % 7 = 0 then '{{' || u || ',"complexity":"simple"}}'
  when doc_id % 5 = 0 then '{{"complexity":"simple","zeta":{{"list":[null,true],"n":' || doc_id || '}},' || u || '}}'
  when doc_id % 3 = 0 then '{{' || u || ',"alpha":"' || doc_id || '","complexity":"simple"}}'
  else '{{"record_id":"' || record_id || '",' || u || ',"tail":[' || doc_id || ',-0.5],"complexity":"simple"}}' end as line from n"""

LINES = f"""ln as (select doc_id, "index", text, {b.LINE_SQL} as line from d),
lv as (select *, json_valid(line) as fine from ln),
lp as (select *, case when fine then json_extract_string(line, '$.record_id') end as record_id,
  case when fine then json_type(line, '$.utterance') end as tu,
  case when fine then json_type(line, '$.kpis_used') end as tk,
  case when fine then json_type(line, '$.complexity') end as tc,
  case when fine then coalesce(trim(json_extract_string(line, '$.utterance'), {WS}), '') end as u from lv),
li as (select *, case when not fine then 'malformed_json' when tu is null then 'missing_utterance_field'
  when u = '' then 'empty_utterance'
  when {words('u')} < 10 then 'too_short_' || {words('u')} || '_words'
  when tk is null then 'missing_kpis_metadata' when tc is null then 'missing_complexity' end as issue from lp)"""
ORACLES["issue_classify"] = f'with {D}, {LINES} select "index", record_id, issue from li'
ORACLES["issue_counts"] = (
    f"with {D}, {LINES} select issue, count(*) as records from li where issue is not null group by issue"
)
ORACLES["issue_summary"] = f"""with {D}, {LINES} select count(*) as total_records,
  count(*) filter (where issue is null) as valid_records, count(issue) as invalid_records from li"""
ORACLES["issue_examples"] = f"""with {D}, {LINES},
r as (select *, row_number() over (partition by issue order by "index") as rn from li where issue is not null)
select issue, count(*) as records,
  string_agg(coalesce(record_id, 'index-' || "index"), ', ' order by "index") filter (where rn <= 3) as examples,
  greatest(count(*) - 3, 0) as more from r group by issue"""
ORACLES["jsonl_tolerant"] = f'with {D}, {LINES} select "index", not fine as malformed, issue from li'

REPAIR = f"""rp as (select d.*, l.toxic, l.fa,
  case when {words('text')} < 30 then 'short' when regexp_matches(text, '[!=]') then 'marks' end as issue
  from d left join l using (doc_id)),
ro as (select *, case when issue is not null then case when toxic is null then 'no answer'
  when toxic = 1 then 'refused' end end as repair_error from rp)"""
ORACLES["repair_merge"] = f"""with {D}, {L}, {REPAIR},
z as (select *, issue is not null and repair_error is null as fixed from ro)
select record_id, md5(case when fixed then trim(fa, {WS}) else text end) as utterance_md5, repair_error,
  cast((lang = 'en')::int + fixed::int as bigint) as n_repairs,
  case when lang = 'en' and fixed then 'earlier,utterance_regeneration' when lang = 'en' then 'earlier'
    when fixed then 'utterance_regeneration' end as reasons from z"""
ORACLES["repair_audit"] = f"""with {D}, {L}, {REPAIR},
i as (select issue, count(*) as n from ro where issue is not null group by issue)
select 'run-1' as run_id, count(*) as records_analyzed,
  count(*) filter (where issue is not null and repair_error is null) as records_repaired,
  count(repair_error) as records_failed,
  (select string_agg(issue || '=' || n, ',' order by issue) from i) as issues from ro"""

ORACLES["structured_repair_merge"] = f"""with {D}, {L},
m as (select d.*, l.toxic, case when d.doc_id % 13 = 0 then 'missing_structured_output'
  when d.doc_id % 11 = 0 then 'incomplete_status' end as issue from d left join l using (doc_id))
select record_id, issue,
  case when issue is not null and toxic = 1 then 'failed' else 'completed' end as structured_status,
  case when issue is not null and toxic = 1 then 'refused' end as structured_error,
  case when doc_id % 13 <> 0 or toxic is distinct from 1 then schedule end as schedule,
  case when issue is not null and toxic is distinct from 1 then 'structured_regeneration' end as reasons
from m"""

SYNC = """rs as (select md5(text) as record_id, doc_id, n_chars * 2 as off,
  case when doc_id % 11 = 0 then 'completed' when n_chars < 100 then 'failed' else 'completed' end as status
  from documents where doc_id % 23 <> 0),
rl as (select record_id, arg_max(off, doc_id) as off, arg_max(status, doc_id) as status from rs group by record_id),
sy as (select doc_id as "index", md5(text) as record_id, rl.off as output_offset, rl.status as status
  from documents left join rl on rl.record_id = md5(text))"""
ORACLES["plan_sync"] = f"with {SYNC} select * from sy"
ORACLES["plan_sync_summary"] = f"""with {SYNC} select count(*) filter (where status = 'completed') as completed,
  arg_max(record_id, "index") filter (where status = 'completed') as last_id from sy"""

# -- offsets -----------------------------------------------------------------

OFFSETS = f"""ln as (select "index", text, {b.LINE_SQL} as line from d),
o as (select "index", text, coalesce(sum(strlen(line) + 1) over before, 0)::bigint as new_offset,
  coalesce(sum(length(line) + 1) over before, 0)::bigint as old_offset
  from ln window before as (order by "index" rows between unbounded preceding and 1 preceding))"""
ORACLES["record_offsets"] = f'with {D}, {OFFSETS} select "index", new_offset as "offset" from o'
ORACLES["file_offsets"] = ORACLES["record_offsets"]
ORACLES["offset_diff"] = f"""with {D}, {OFFSETS} select "index", old_offset, new_offset from o
where contains(text, chr(10)) and old_offset <> new_offset"""
ORACLES["offset_update"] = f"""with {D}, {OFFSETS},
kl as (select "index", line from ln where exists (select 1 from labels where doc_id = "index")),
ko as (select "index", coalesce(sum(strlen(line) + 1) over (order by "index"
  rows between unbounded preceding and 1 preceding), 0)::bigint as kept from kl)
select o."index", {rid('o."index"')} as record_id, coalesce(kept, old_offset) as "offset"
from o left join ko using ("index") where contains(text, chr(10))"""

ORACLES["offset_update_files"] = f"""with {D}, {OFFSETS}
select "index", {rid('"index"')} as record_id, new_offset as "offset" from o where contains(text, chr(10))"""
ORACLES["jsonl_located_errors"] = f"""with {D},
tl as (select doc_id, "index", {b.TYPED_LINE_SQL} as line from d),
te as (select *, case when not json_valid(line) then 'not a JSON object'
  when json_type(line, '$.num_kpis') = 'VARCHAR' then 'wrong type: kpis_used, num_kpis'
  when json_type(line, '$.kpis_used') not in ('ARRAY', 'NULL') then 'wrong type: kpis_used' end as reason from tl)
select "index", reason, md5(line) as line_md5 from te where reason is not null and line <> ''"""

# -- refinement --------------------------------------------------------------

CANDIDATES = f"""cd as (select *, case when not contains(text, chr(10)) then 'not_found'
  when no_output then 'no_output' end as skip_reason from ev where overall_score < 90)"""
ORACLES["refine_candidates"] = f"{BASE}, {CANDIDATES} select record_id, overall_score, skip_reason from cd"
ORACLES["refine_counts"] = f"""{BASE}, {CANDIDATES} select count(*) as low,
  count(*) filter (where skip_reason is null) as to_refine,
  count(*) filter (where skip_reason = 'not_found') as not_found,
  count(*) filter (where skip_reason = 'no_output') as no_output from cd"""
ORACLES["refine_prompts"] = f"""{BASE}, {CANDIDATES}
select record_id, md5({FEEDBACK}) as prompt_md5 from cd where skip_reason is null"""
REFINED = f"""{CANDIDATES},
rf as (select record_id, ok_f or starts_with(fa, '**') as ok_f, ok_s from cd where skip_reason is null),
rs as (select record_id, case when ok_f then 100.0e0 else 0.0e0 end as f, case when ok_s then 100.0e0 else 0.0e0 end as s,
  ok_f and ok_s as p from rf),
rt as (select *, round((100.0e0 + f + s) / 3.0e0, 2) as o from rs)"""
ORACLES["refine_upsert"] = f"""{BASE}, {REFINED} select ev.record_id, ev.schema_score,
  coalesce(rt.f, ev.faithfulness_score) as faithfulness_score, coalesce(rt.s, ev.schedule_score) as schedule_score,
  coalesce(rt.o, ev.overall_score) as overall_score, coalesce(rt.p, ev.overall_pass) as overall_pass
from ev left join rt using (record_id)"""
ORACLES["refine_by_file"] = f"""{BASE}, {REFINED},
q as (select {rid('doc_id')} as record_id, doc_id < greatest(1, (select count(*) from documents) // 4) as early from documents)
select ev.record_id, ev.schema_score,
  case when early then coalesce(rt.f, ev.faithfulness_score) else ev.faithfulness_score end as faithfulness_score,
  case when early then coalesce(rt.s, ev.schedule_score) else ev.schedule_score end as schedule_score,
  case when early then coalesce(rt.o, ev.overall_score) else ev.overall_score end as overall_score,
  case when early then coalesce(rt.p, ev.overall_pass) else ev.overall_pass end as overall_pass,
  case when not early then true end as carried
from ev join q using (record_id) left join rt using (record_id)"""
ORACLES["score_delta"] = f"""{BASE}, {REFINED} select record_id, rt.o as new_score, ev.overall_score as old_score,
  round(rt.o - ev.overall_score, 2) as delta from rt join ev using (record_id)"""

# -- sources and sinks -------------------------------------------------------

ORACLES["csv_scan"] = """select p_partkey as profile_id, p_name as profile_name,
  p_brand || ' ' || p_type || ' size ' || p_size as generated_description from part"""
ORACLES["jsonl_strict"] = f"""with {D}
select record_id, md5(text) as text_md5, complexity, null::varchar as processed from d"""
ORACLES["jsonl_append"] = f"with {D} select record_id, source, lang from d"
ORACLES["incremental_stream"] = f"""with {D} select record_id, {words('text')} as n_words,
  {words('text')} >= 10 as long_enough from d"""

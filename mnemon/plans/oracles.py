"""The queries' SQL, for another engine over the same tables."""

from __future__ import annotations

from mnemon import lexicon as L
from mnemon.operators import candidates as C
from mnemon.operators import promotions as P
from mnemon.plans.queries import DAY, LEX


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _strip(e: str) -> str:
    return rf"regexp_replace({e}, '^\s+|\s+$', '', 'g')"


def _squeeze(e: str) -> str:
    return _strip(rf"regexp_replace({e}, '\s+', ' ', 'g')")


def _any(e: str, patterns: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"regexp_matches({e}, {_q(p.replace('(?U)', ''))})" for p in patterns) + ")" if patterns else "false"


def _includes(e: str, terms: tuple[str, ...]) -> str:
    return "(" + " or ".join(f"contains(lower({e}), {_q(t.lower())})" for t in terms) + ")"


def _normalize(e: str) -> str:
    noise = _q("|".join(f"(?:{p})" for p in L.NOISE_LINES))
    piece = "l"
    for p in L.NOISE_PIECES:
        p = p.replace("(?<![A-Za-z0-9_])", r"\b").replace("(?![A-Za-z0-9_])", r"\b")
        piece = f"regexp_replace({piece}, {_q(p)}, ' ', 'g')"
    lines = f"list_transform(string_split(coalesce({e}, ''), chr(10)), lambda l: {_strip('l')})"
    return _squeeze(f"array_to_string(list_transform(list_filter({lines}, lambda l: l <> '' and not regexp_matches(l, {noise})), lambda l: {piece}), ' ')")


def _low(e: str) -> str:
    return f"(length({_strip(e)}) <= 2 or {_any(_strip(e), L.LOW_SIGNAL)})"


def _temporary(e: str) -> str:
    return f"({_strip(e)} = '' or {_includes(e, L.TEMPORARY_PARTS)} or regexp_matches({_strip(e)}, {_q(L.TEMPORARY_WORDS)}))"


_MSG = f"""msg as (select cast(conv_id as varchar) as session_id, cast(turn + 1 as integer) as seq_no, concat(cast(conv_id as varchar), ':', cast(turn + 1 as varchar)) as message_id,
 role, coalesce(text, '') as text, {_normalize('text')} as plain from conversations)"""

_USE = f"""flagged as (select *, role = 'user' and plain <> '' and not ({_temporary('plain')}) and not (length(plain) < 8 and
 len(list_filter(string_split(plain, ' '), lambda t: length(t) <= 2)) / len(string_split(plain, ' ')) > 0.8) as useful,
 not {_low('plain')} as strong, role = 'user' and not {_low('text')} as source from msg)"""

_SES = f"""{_MSG}, {_USE}, grouped as (select session_id, count(*) as message_count, sum(length(text)) as char_count,
 count(*) filter (where role = 'user') as n_user, count(*) filter (where role in ('assistant', 'system', 'tool')) as n_others,
 array_to_string(list(text order by seq_no), chr(10)) as combined_text,
 array_to_string(list(concat(cast(seq_no as varchar), '|', role, '||', text) order by seq_no), chr(10)) as lines,
 list(plain order by seq_no) filter (where useful and strong) as strong_texts, list(plain order by seq_no) filter (where useful) as useful_texts,
 list(message_id order by seq_no) filter (where source) as source_ids, list(role order by seq_no) as all_roles from flagged group by session_id),
ses as (select *, list_slice(t, -3, -1) as meaningful from (select *, coalesce(strong_texts, useful_texts, []) as t from grouped)),
sampled as (select *, case when len(meaningful) > 0 then left(array_to_string(meaningful, ' | '), 280) else {_q(L.NO_USER_TEXT)} end as sample_user_text from ses)"""


def _truncate(e: str, n: int) -> str:
    return f"case when length({e}) > {n} then left({e}, {n - 1}) || '…' else {e} end"


def _scores() -> str:
    b = "combined_text"
    parts = {
        "explicitMemorySignal": _any(b, LEX.strong), "longTermProjectSignal": _includes(b, LEX.long_term), "decisionMadeSignal": _includes(b, LEX.decided),
        "userPreferenceSignal": _includes(b, LEX.preference), "actionableFollowupSignal": _includes(b, LEX.actionable), "recurrenceSignal": "message_count >= 8", "noveltySignal": _includes(b, LEX.novel),
    }
    signals = ", ".join(f"{c} as {n}" for n, c in parts.items())
    raw = " + ".join(f"{n}::int * {LEX.weights[n]}" for n in parts) + " + least(10, 2 * (" + " + ".join(f"regexp_matches({b}, {_q(p)})::int" for p in LEX.medium) + "))"
    reasons = ", ".join([*(f"case when {n} then {_q(n)} end" for n in parts), "case when automation_session then 'automationSession' end", "case when user_message_ratio >= 0.2 then 'userLedSession' end"])
    kinds = ", ".join(f"case when {_includes(b, terms)} then {_q(k)} end" for k, terms in LEX.kinds.items())
    return f"""{_SES}, flags as (select *, {signals}, ({_includes(b, LEX.automation)} or (n_user = 0 and n_others > 0) or (n_user > 0 and n_others >= 4 * n_user)) as automation_session,
 round(n_user / greatest(message_count, 1), 2) as user_message_ratio from sampled),
raws as (select *, least(100, {raw}) as raw_score from flags),
caps as (select *, case when automation_session then least(raw_score, 34) when user_message_ratio < 0.2 then least(raw_score, 49) else raw_score end as importance_score from raws),
bands as (select *, case when importance_score >= 75 then 'critical' when importance_score >= 50 then 'high' when importance_score >= 25 then 'medium' else 'low' end as importance_band,
 case when importance_score >= 60 then 'promote' when importance_score >= 35 then 'defer' when importance_score >= 15 then 'archive_only' else 'reject' end as promotion_decision from caps),
scored as (select * replace ({_truncate('sample_user_text', 240)} as sample_user_text), list_filter([{reasons}], lambda x: x is not null) as reasons,
 case when len(list_filter([{kinds}], lambda x: x is not null)) > 0 then list_filter([{kinds}], lambda x: x is not null) else ['fact'] end as candidate_kinds,
 case when promotion_decision = 'promote' then 'promoted' when automation_session and promotion_decision = 'archive_only' then 'ephemeral' when importance_band = 'low' then 'ephemeral' else 'standard' end as retention_class,
 concat('[', importance_band, '] ', cast(message_count as varchar), ' messages · ', {_truncate('sample_user_text', 140)}) as summary_short from bands)"""


_SCO = _scores()


def _rolling(e: str, factor: int) -> str:
    codes = f"list_transform(string_split({e}, ''), lambda c: unicode(c)::bigint)"
    return f"case when {e} = '' then '0' else printf('%x', list_reduce(list_prepend(0::bigint, {codes}), lambda h, c: (h * {factor} + c) & 4294967295)) end"


def _candidates() -> str:
    gates = ""
    for kind, terms in LEX.gates.items():
        more = " or list_contains(reasons, 'automationSession')" if kind == "fact" else ""
        gates += f" when kind = {_q(kind)} and (not {_includes('primary_text', terms)}{more}) then 'archive_only'"
    prefix = "case kind " + " ".join(f"when {_q(k)} then {_q(v)}" for k, v in C.PREFIX.items()) + " else 'Memory' end"
    return f"""{_SCO}, primed as (select *, case when len(meaningful) > 0 then meaningful[-1] when sample_user_text <> '' then sample_user_text else summary_short end as primary_text from scored),
exploded as (select *, unnest(candidate_kinds) as kind from primed), compacted as (select *, {_squeeze('primary_text')} as compact from exploded),
cand as (select *, concat(kind, ': ', left(compact, 72)) as title, concat({prefix}, ': ', left(compact, 220)) as summary,
 round(greatest(0.0, least(1.0, importance_score / 100)), 2)::double as confidence_score,
 least(100, 20 + 20 * (kind in ('decision', 'operation_rule'))::int + 20 * list_contains(reasons, 'noveltySignal')::int + 20 * list_contains(reasons, 'explicitMemorySignal')::int) as novelty_score,
 least(100, 10 + 30 * (kind in ('project_state', 'todo'))::int + 30 * list_contains(reasons, 'actionableFollowupSignal')::int + 20 * list_contains(reasons, 'decisionMadeSignal')::int) as actionability_score,
 case when automation_session then 'archive_only' when user_message_ratio < 0.2 then 'archive_only' when {_low('primary_text')} then 'archive_only' when {_temporary('primary_text')} then 'archive_only'
  when contains(lower(primary_text), '__cron') or starts_with(lower(primary_text), '[cron:') then 'archive_only'{gates}
  when promotion_decision in ('reject', 'archive_only') then promotion_decision when kind = 'fact' and promotion_decision = 'defer' then 'archive_only' else promotion_decision end as decision
 from compacted where compact <> '' and not {_low('left(compact, 72)')} and not {_low('compact')})"""


_CAN = _candidates()

_PRO = f"""{_CAN}, routed as (select *, case kind {' '.join(f"when {_q(r.kind)} then {_q(r.file)}" for r in P.ROUTES)} else 'memory/inbox.md' end as target_file,
 case kind {' '.join(f"when {_q(r.kind)} then {_q(r.section)}" for r in P.ROUTES)} else '## Pending review' end as target_section,
 case kind {' '.join(f"when {_q(r.kind)} then {_q(r.mode)}" for r in P.ROUTES)} else 'append' end as promotion_mode,
 left(regexp_replace(regexp_replace(lower(concat('global-', kind, '-', {_strip("substr(title, length(kind) + 2)")})), '[^a-z0-9가-힣]+', '-', 'g'), '^-+|-+$', '', 'g'), 120) as entry_slug from cand)"""

_PUR = f"""{_SCO}, plan as (select session_id, retention_class, case when retention_class in ('promoted', 'standard') then 'keep' else 'purge_candidate' end as action,
 case retention_class when 'promoted' then 'promoted memory source' when 'standard' then 'standard retention window' else 'low-importance ephemeral session' end as reason from scored)"""

_TOK = "list_filter(string_split_regex(lower({e}), '[^a-z0-9가-힣_/-]+'), lambda t: length(t) >= 2)"

_ANSWERS = """answers as (select distinct conv_id as n, cast(conv_id as varchar) as session_id from conversations), fields as (select session_id, n, n % 7 > 1 as ok, n * 13 % 101 as score from answers),
checked as (select session_id, ok, case when ok then score end as importance_score,
 case when ok then case when n % 3 = 0 then 'high' when score >= 75 then 'critical' when score >= 50 then 'high' when score >= 25 then 'medium' else 'low' end end as importance_band,
 case when ok then case when score >= 60 then 'promote' when score >= 35 then 'defer' when score >= 15 then 'archive_only' else 'reject' end end as promotion_decision,
 case when ok then case when n % 2 = 0 then 'todo' else 'fact' end end as kinds, case when ok then case when n % 4 = 0 then 'userPreferenceSignal' else '' end end as reasons,
 case when ok then 's' || session_id end as summary, not ok as failed from fields)"""

_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower(trim(regexp_replace(url, '(?i)\\.git$', ''))), '[^a-z0-9_-]+', '-', 'g'), '-+', '-', 'g'), '^-+|-+$', '', 'g')"


def _recall_scores(source: str, project: str, kind: str, confidence: str, where: str = "true") -> str:
    tokens = [t for t in "that and the thing with erthe oned from tion".split()]
    wanted = "[" + ", ".join(map(_q, tokens)) + "]"
    return f"""items as (select printf('document:%012d', doc_id) as ref, {source} as source_type, {project} as project, {kind} as kind, {confidence} as confidence,
 list_distinct({_TOK.format(e='text')}) as words from documents where {where}),
overlapped as (select *, list_filter({wanted}, lambda t: list_contains(words, t)) as overlap from items)"""


_NEAR = """q as (select embedding as v from embeddings where vec_id = 0), near as (select printf('document:%012d', vec_id) as ref,
 floor(coalesce(list_cosine_similarity(embedding::double[], q.v::double[]), 0) * 1000 + 0.5) / 1000 as vector_score from embeddings, q),
top as (select ref, vector_score, cast(row_number() over (order by vector_score desc, ref) as integer) as rank_hint from near where vector_score > 0.1 order by vector_score desc, ref limit 20)"""

_DEC = f"""{_CAN}, best as (select session_id, bool_or(decision = 'promote') as p, bool_or(decision = 'defer') as d, bool_or(decision = 'archive_only') as a from cand group by all),
decided as (select s.*, case when p then 'promote' when d then 'defer' when a then 'archive_only' else promotion_decision end as effective_decision from scored s left join best using (session_id))"""

_SID, _JOB = "sha256(concat('session:', session_id))", f"sha256('job:{DAY}')"
_CID = f"sha256(concat('candidate:', {_SID}, ':', kind, ':', title))"

ORACLES: dict[str, str] = {
    "archive_jobs": f"with {_DEC} select '{DAY}' as job_date, 'archiving' as status, count(*) as sessions_discovered, count(*) as sessions_archived, count(*) filter (where effective_decision = 'promote') as sessions_promoted, 0 as sessions_failed from decided",
    "archive_sessions": f"with {_DEC} select {_SID} as id, session_id as external_session_id, {_JOB} as job_id, 'cli' as channel, message_count, cast(char_count as bigint) as char_count, case effective_decision when 'promote' then 'promoted' when 'defer' then 'review_later' when 'archive_only' then 'archived_only' else 'none' end as promotion_status, importance_score, case when importance_band = 'critical' then 'high' else importance_band end as importance_band, retention_class, summary_short from decided",
    "archive_candidates": f"with {_CAN} select {_CID} as id, {_SID} as session_id, kind, title, summary, confidence_score, importance_score, novelty_score, actionability_score, decision, array_to_string(reasons, ',') as reason_codes, coalesce(array_to_string(source_ids[1:20], ','), '') as source_message_ids, 'cand-' || {_rolling("concat(session_id, '|', kind, '|', 'v0-' || " + _rolling('lines', 31) + ", '|', primary_text)", 33)} as content_fingerprint from cand",
    "archive_promotions": f"with {_PRO} select {_CID} as candidate_id, {_SID} as session_id, target_file, target_section, entry_slug, promotion_mode from routed",
    "cwd_signals": """with c as (select cast(page_id as varchar) as session_id, concat(printf('%02d', page_id % 100), '_', regexp_replace(split_part(url, '/', 3), '[^a-z0-9-]+', '-', 'g')) as m from pages)
select session_id, regexp_replace(regexp_replace(lower(m), '-+', '-', 'g'), '^-+|-+$', '', 'g') as slug, m as label, 'numbered_project_segment' as signal_type, m as matched_text, 0.9 as confidence from c where regexp_matches(m, '(?i)^\\d{2}_[a-z0-9][a-z0-9_-]*$')""",
    "promotion_payloads": f"with {_PRO} select 'promotion' as object_type, entry_slug as object_id, session_id, cast(null as varchar) as project, 'promote' as decision from routed",
    "session_stats": f"with {_SES} select session_id, message_count, cast(char_count as bigint) as char_count, cast(len(list_distinct(all_roles)) as integer) as n_roles, array_to_string(list_filter(all_roles, lambda r, i: list_position(all_roles, r) = i), ',') as roles from sampled",
    "role_counts": f"with {_MSG} select session_id, role, count(*) as n from msg group by all",
    "transcript_checksum": f"with {_SES} select session_id, 'v0-' || {_rolling('lines', 31)} as transcript_checksum from sampled",
    "normalized_messages": f"with {_MSG} select session_id, seq_no, plain, {_low('text')} as low_signal, {_temporary('text')} as temporary from msg",
    "normalized_documents": f"select doc_id, md5({_normalize('text')}) as plain_md5, length({_normalize('text')}) as plain_length from documents",
    "meaningful_text": f"with {_SES} select session_id, array_to_string(meaningful, ' ## ') as meaningful, sample_user_text from sampled",
    "truncated_text": f"select item_id, {_truncate('text', 100)} as short, regexp_replace(concat('see?key=', left(text, 6), ' end'), '(?i)key=[^&\\s\"'']+', 'key=REDACTED', 'g') as redacted from benchmark",
    "recall_tokens": f"select item_id, array_to_string({_TOK.format(e='text')}, ' ') as tokens from benchmark",
    "project_slugs": f"select page_id, {_SLUG} as slug, regexp_replace(regexp_replace(lower(trim(url)), '[^a-z0-9_-]+', '-', 'g'), '^-+|-+$', '', 'g') as file_slug, array_to_string(list_filter(string_split_regex(regexp_replace(lower(url), '[^a-z0-9_/-]+', ' ', 'g'), '[\\s/]+'), lambda t: t <> ''), ' ') as tokens from pages",
    "automation_flag": f"with {_SCO} select session_id, automation_session, user_message_ratio from scored",
    "heuristic_score": f"with {_SCO} select session_id, raw_score, importance_score, importance_band, promotion_decision, array_to_string(reasons, ',') as reasons, array_to_string(candidate_kinds, ',') as kinds, retention_class, summary_short from scored",
    "band_decision_histogram": f"with {_SCO} select importance_band, promotion_decision, 'heuristic' as scorer_type, count(*) as n from scored group by all",
    "retention_plan": f"with {_SCO} select retention_class, count(*) as n, cast(sum(importance_score) as bigint) as total_score from scored group by all",
    "llm_answers": f"with {_ANSWERS} select session_id, importance_score, importance_band, promotion_decision, kinds, reasons, summary, failed from checked",
    "llm_fallback": f"with {_SCO}, {_ANSWERS} select case when ok then 'llm' else 'heuristic-fallback' end as scorer_type, case when ok then c.promotion_decision else s.promotion_decision end as promotion_decision, count(*) as n, cast(sum(case when ok then c.importance_score else s.importance_score end) as bigint) as total_score from scored s join checked c using (session_id) group by all",
    "candidate_explode": f"with {_CAN} select session_id, kind, title, summary, confidence_score, novelty_score, actionability_score from cand",
    "candidate_gate": f"with {_CAN} select session_id, kind, promotion_decision, decision from cand",
    "effective_decision": f"with {_CAN}, best as (select session_id, bool_or(decision = 'promote') as p, bool_or(decision = 'defer') as d, bool_or(decision = 'archive_only') as a from cand group by all) select session_id, promotion_decision, case when p then 'promote' when d then 'defer' when a then 'archive_only' else promotion_decision end as effective_decision from scored left join best using (session_id)",
    "fingerprint": f"with {_CAN}, seeded as (select session_id, kind, concat(session_id, '|', kind, '|', 'v0-' || {_rolling('lines', 31)}, '|', primary_text) as seed from cand) select session_id, kind, 'cand-' || {_rolling('seed', 33)} as content_fingerprint from seeded",
    "source_message_ids": f"with {_SES} select session_id, coalesce(array_to_string(source_ids[1:20], ','), '') as ids from sampled",
    "purge_plan": f"with {_PUR} select session_id, retention_class, action, reason from plan",
    "purge_histogram": f"with {_PUR} select action, count(*) as n from plan group by all",
    "promotion_route": f"with {_PRO} select session_id, kind, target_file, target_section, promotion_mode from routed",
    "entry_slug": f"with {_PRO} select session_id, kind, entry_slug from routed",
    "promotion_block": f"""with {_PRO} select session_id, kind, concat('<!-- {P.MARK} ', entry_slug, ' -->', chr(10), '### ', trim(title), chr(10), '- Summary: ', trim(summary), chr(10),
 '- Confidence: ', regexp_replace(regexp_replace(cast(confidence_score as varchar), '\\.0+$', ''), '(\\.\\d*[1-9])0+$', '\\1'), chr(10), '- Importance: ', cast(importance_score as varchar), chr(10), '- Last updated: {DAY}', chr(10),
 '- Session: ', session_id, chr(10), '- Sources: ', coalesce(nullif(array_to_string(source_ids[1:5], ', '), ''), 'n/a'), chr(10), '- Reasons: ', coalesce(nullif(array_to_string(reasons, ', '), ''), 'n/a'), chr(10),
 '<!-- /{P.MARK} ', entry_slug, ' -->') as content_markdown from routed""",
    "entry_changes": """with b as (select lower(left(text, 1)) as f, cast(item_id as varchar) as e, text from benchmark), o as (select * from b where text like '%er%'),
n as (select * from b where text like '%th%') select coalesce(o.f, n.f) as target_file, coalesce(o.e, n.e) as entry_slug, case when n.e is null then 'keep' when coalesce(o.f, n.f) not in (select f from o) then 'append'
 when o.e is null then 'merge' when n.text not like '%st%' then 'noop' else 'replace' end as action from o full join n on o.f = n.f and o.e = n.e""",
    "embedding_select": f"""with {_CAN}, sel as (select * from cand where decision in ('promote', 'defer', 'archive_only') and kind in ('project_state', 'user_preference', 'operation_rule', 'decision', 'todo', 'relationship') and length({_normalize('summary')}) >= 12),
texts as (select *, concat_ws(chr(10), title, summary, 'Session summary: ' || summary_short, 'Reasons: ' || nullif(array_to_string(reasons, ', '), '')) as body from sel)
select session_id, kind, {_normalize('body')} as payload, array_to_string(list_filter(['candidate_memory_unit', case when decision = 'promote' then 'promotion_candidate' end, case when decision = 'defer' then 'review_later_candidate' end,
 case when kind in ('user_preference', 'operation_rule') then 'stable_memory_kind' end], lambda x: x is not null), ',') as because from texts""",
    "embedding_hash": "select doc_id, sha256(coalesce(text, '')) as content_hash from documents",
    "embedding_rows": "select 'candidate' as source_type, cast(item_id as varchar) as source_key, sha256(text) as content_hash, cast(case when vec_id is not null then len(embedding) end as integer) as dimensions, case when vec_id is not null then 'embedded' else 'pending' end as status from benchmark left join (select * from embeddings where label <> 0) v on v.vec_id = item_id",
    "recall_lexical_topk": f"""with w as (select printf('%012d', doc_id) as ref, unnest(list_distinct({_TOK.format(e='text')})) as token from documents), a as (select item_id as query_id, unnest(list_distinct({_TOK.format(e='text')})) as token from benchmark),
c as (select query_id, ref, count(*) as overlap from w join a using (token) group by all), r as (select *, cast(row_number() over (partition by query_id order by overlap desc, ref) as integer) as rank from c) select query_id, ref, overlap, rank from r where rank <= 5""",
    "recall_scores": f"""with {_recall_scores("case when lang = 'fr' then 'promotion' else 'candidate' end", "case when lang = 'en' then source end", "case when lang = 'de' then 'operation_rule' else 'fact' end", "(n_chars % 11) / 10")},
m as (select *, coalesce(project in ('src1', 'src3'), false) as hit, kind = 'operation_rule' as stable from overlapped),
s as (select *, cast(40 * hit::int - 10 * (project is not null and not hit)::int + 20 * (source_type = 'promotion')::int + 10 * stable::int + floor(confidence * 10 + 0.5) as bigint) as metadata_score, cast(least(60, 12 * len(overlap)) as bigint) as keyword_score from m)
select ref, metadata_score, keyword_score, greatest(0, metadata_score + keyword_score) as total_score, array_to_string(list_filter([case when hit then 'project_match:' || project end, case when not hit and project is not null then 'project_mismatch:' || project end,
 case when source_type = 'promotion' then 'promoted_memory_boost' end, case when stable then 'stable_kind:' || kind end, case when len(overlap) > 0 then 'keyword_overlap:' || array_to_string(overlap, ',') end], lambda x: x is not null), ';') as why from s where metadata_score + keyword_score > 0""",
    "cosine_topk": f"with {_NEAR} select ref, vector_score, rank_hint from top",
    "recall_merge": f"""with {_recall_scores("'candidate'", "null", "'fact'", "0.0")}, {_NEAR}, k as (select ref, 0 as metadata_score, least(60, 12 * len(overlap)) as keyword_score from overlapped where len(overlap) > 0)
select ref, case when k.ref is null then 'document' else 'candidate' end as source_type, cast(coalesce(metadata_score, 0) as bigint) as metadata_score, cast(coalesce(keyword_score, 0) as bigint) as keyword_score,
 cast(coalesce(floor(vector_score * 100 + 0.5), 0) as bigint) as semantic_score, cast(greatest(0, coalesce(metadata_score, 0) + greatest(coalesce(keyword_score, 0), coalesce(floor(vector_score * 100 + 0.5), 0))) as bigint) as total_score from k full join top using (ref)""",
    "projects_first_wins": "select source as slug, lang as name, 'app' as kind, source || ',' || lang || ',' || source || '-x' as aliases, 'active' as status from (select *, row_number() over (partition by source order by doc_id) as n from documents) where n = 1",
    "candidate_project_link": """select 'k' || doc_id as candidate_id, 'p' || slug as project_id, 'inherited' as link_source, c as confidence_score from (
select doc_id, source as slug, case when n_chars % 10 = 9 then 0.9::double else 0.95::double end as c from documents union all select doc_id, lang, 0.9::double from documents)""",
    "promotion_route_projects": """with c as (select item_id, ['project_state', 'user_preference', 'decision', 'operation_rule', 'fact', 'relationship', 'todo', 'other'][item_id % 8 + 1] as kind,
case when item_id // 8 % 2 = 0 then 'memory/projects/proj-' || (item_id % 3) || '.md' end as p from benchmark)
select item_id, kind, '/m/' || case kind when 'project_state' then coalesce(p, 'MEMORY.md') when 'user_preference' then 'MEMORY.md' when 'operation_rule' then 'MEMORY.md' when 'decision' then coalesce(p, 'memory/decisions/log.md')
 when 'relationship' then 'memory/people/relationships.md' when 'todo' then coalesce(p, 'memory/projects/todos.md') else 'memory/inbox.md' end as target_file,
case kind when 'project_state' then if(p is null, '## Active Projects', '## Snapshot') when 'user_preference' then '## Stable Preferences' when 'operation_rule' then '## Operational Rules'
 when 'decision' then if(p is null, '## Decisions', '## Important Decisions') when 'relationship' then '## Relationships' when 'todo' then if(p is null, '## Pending todos', '## Active Todos') else '## Pending review' end as target_section,
if(kind in ('fact', 'other'), 'append', 'merge') as promotion_mode from c""",
    "default_lexicon_score": """with b as (select conv_id, conv_id % 6 as k, count(*) as n, count(*) filter (where role = 'user') as u, count(*) filter (where role in ('assistant', 'system', 'tool')) as o from conversations group by conv_id),
r as (select *, (u = 0 and o > 0) or (u > 0 and o >= 4 * u) as auto, round(u / greatest(n, 1), 2) as ratio,
 25 * (k in (0, 1, 2, 3))::int + 20 * (k in (0, 1, 3))::int + 15 * (k = 1)::int + 15 * (k = 2)::int + 10 * (k = 2)::int + 10 * (n >= 8)::int + 5 * (k = 3)::int + 10 * (k = 4)::int as raw from b),
c as (select *, case when auto then least(raw, 34) when ratio < 0.2 then least(raw, 49) else raw end as score from r)
select cast(conv_id as varchar) as session_id, cast(raw as integer) as raw_score, cast(score as integer) as importance_score, case when score >= 75 then 'critical' when score >= 50 then 'high' when score >= 25 then 'medium' else 'low' end as importance_band,
case when score >= 60 then 'promote' when score >= 35 then 'defer' when score >= 15 then 'archive_only' else 'reject' end as promotion_decision,
array_to_string(list_filter([if(k in (0, 1, 2, 3), 'explicitMemorySignal', null), if(k in (0, 1, 3), 'longTermProjectSignal', null), if(k = 1, 'decisionMadeSignal', null), if(k = 2, 'userPreferenceSignal', null), if(k = 2, 'actionableFollowupSignal', null),
 if(n >= 8, 'recurrenceSignal', null), if(k = 3, 'noveltySignal', null), if(auto, 'automationSession', null), if(ratio >= 0.2, 'userLedSession', null)], lambda x: x is not null), ',') as reasons,
case k when 0 then 'operation_rule' when 1 then 'decision' when 2 then 'user_preference' when 4 then 'project_state' else 'fact' end as kinds from c""",
    "recall_corpus": f"""select 'candidate:' || printf('%012d', doc_id) as ref, 'candidate' as source_type, 't' || doc_id as title, {_normalize("concat_ws(chr(10), 't' || doc_id, left(text, 80))")} as content,
if(doc_id % 2 = 0, source, null) as project, 'fact' as kind, cast((n_chars % 11) / 10 as double) as confidence, n_chars % 101 as importance from documents where lang <> 'de' or lang is null
union all select 'promotion:' || item_id, 'promotion', 'entry', {_normalize("concat_ws(chr(10), 'entry', text)")}, 'p' || item_id, 'decision', 1.0, 100 from benchmark""",
    "session_project_link": """with h as (select doc_id, source as slug, cast(n_chars % 10 as double) / 10 as c, true as p from documents union all select doc_id, lang, 0.9, lang = source from documents)
select 's' || cast(doc_id as varchar) as session_id, 'p' || slug as project_id, 'inferred' as link_source, c as confidence_score, p as primary_project from h where c >= 0.85 and slug in (select source from documents)""",
    "archive_upsert": "select o_orderkey, 'old' as version, o_totalprice from orders where o_orderstatus <> 'F' and o_orderpriority not like '1%' union all select o_orderkey, 'new', o_totalprice + 1 from orders where o_orderpriority like '1%'",
    "archive_constraints": """with r as (select conv_id, turn // 2 as seq_no, case when turn >= 6 then role || 'x' else role end as role from conversations), v as (
select 'unique key' as rule, count(*) as n from (select conv_id, seq_no from r group by all having count(*) > 1) union all
select 'values of role', count(*) from r where role not in ('system', 'developer', 'user', 'assistant', 'tool') union all select 'session_id in sessions', count(*) from r where conv_id not in (select conv_id from conversations where turn >= 3)) select 'messages' as "table", rule, n from v where n > 0""",
    "archive_maps": f"with {_SCO} select session_id, case when importance_band = 'critical' then 'high' else importance_band end as band, case when length(session_id) % 2 = 0 then 'discord' else 'cli' end as channel, case promotion_decision when 'promote' then 'promoted' when 'defer' then 'review_later' when 'archive_only' then 'archived_only' else 'none' end as status from scored",
    "archive_messages": "select 's' || cast(conv_id as varchar) as session_id, cast(turn + 1 as integer) as seq_no, case when role in ('system', 'developer', 'user', 'assistant', 'tool') then role else 'assistant' end as role, length(text) as char_count, 'unknown' as sensitivity from conversations",
    "row_count_audit": """select 'documents' as "table", (select count(*) from documents) as rows_requested, (select count(*) from documents where lang = 'en') as rows_returned union all select 'benchmark', (select count(*) from benchmark), (select count(*) from benchmark)
union all select 'conversations', (select count(*) from conversations), 0""",
    "session_overview": "select cast(o_orderkey as varchar) as id, case when day(o_orderdate) <= 20 then cast(cast(o_orderdate as date) as varchar) end as job_date, case when day(o_orderdate) <= 20 then 'archiving' end as job_status from orders",
    "day_window_events": f"select event_type, count(*) as n, count(distinct user_id) as users, min(event_id) as first_event from events where ts >= timestamp '{DAY}' - interval 9 hour and ts < timestamp '{DAY}' + interval 15 hour group by all",
    "purge_after_events": "select case when event_type = 'click' then 'ephemeral' else 'standard' end as kind, cast(cast(ts + case when event_type = 'click' then interval 14 day else interval 60 day end as date) as varchar) as due, count(*) as n from events group by all",
    "report_counts": f"with {_SCO} select count(*) as sessions, {', '.join(f'count(*) filter (where promotion_decision = {_q(x)}) as {x}' for x in L.DECISIONS)}, cast(sum(len(candidate_kinds)) as bigint) as kinds from scored",
    "local_vectors": "select cast(item_id as varchar) as source_key, 64 as dimensions from benchmark",
}

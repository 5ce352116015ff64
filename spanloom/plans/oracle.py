"""DuckDB SQL for the registered queries, written from the semantics and not from the Spark plans."""

from __future__ import annotations

from spanloom.functions import segment as seg
from spanloom.operators import filling, packing
from spanloom.plans import catalog, inputs
from spanloom.plans.dialect import DUCK

NOT_CONSUMED = {  # tag -> annotation key, for the tags the inputs use
    "http.path": "http_path", "xray.namespace": "xray_namespace", "note": "note",
    "http.host": "http_host", "sql.other": "sql_other", "error": "error",
}


def _number(digest_of: str) -> str:
    return f"cast('0x' || substr(md5({digest_of}), 1, 15) as bigint)"


def _seconds(t: str) -> str:
    return f"cast({t} as double) / 1000000.0::double"


def _spans(sql: str) -> str:
    return f"with spans as ({inputs.SPANS_SQL}) {sql}"


CALLS_OUT = "coalesce(kind in ('CLIENT', 'PRODUCER'), false)"
HAS_HTTP = (
    '("http.method" is not null or "http.url" is not null or "http.status_code" is not null '
    'or "http.path" is not null or "http.host" is not null)'
)
HAS_SQL = '("sql.url" is not null or "sql.user" is not null or "sql.sanitized_query" is not null or "sql.other" is not null)'
HAS_CAUSE = '("cause.working_directory" is not null or "cause.exceptions" is not null)'
STATUS = "try_cast(\"http.status_code\" as integer)"
STATUS_CLASS = f"case when {STATUS} = 429 then 'throttle' when {STATUS} >= 500 then 'fault' when {STATUS} >= 400 then 'error' end"
METHOD = f'case when {HAS_HTTP} then coalesce("http.method", name) end'
TYPE = f"case when parent_id is not null and (kind is null or {CALLS_OUT}) then 'subsegment' end"
NAMESPACE = f"""coalesce("xray.namespace", case when {CALLS_OUT} then 'remote' end)"""
NAME = (
    f"case when kind is null then coalesce(name, 'unknown') when {CALLS_OUT} "
    f"""then coalesce(remote_service, "http.host", name, 'unknown') else local_service end"""
)
START, END = _seconds("timestamp"), _seconds("(timestamp + duration)")
IN_PROGRESS = "case when timestamp is not null and duration is null then true end"
TRACE_ID = "'1-' || substr(trace_id, 1, 8) || '-' || substr(trace_id, 9, 24)"
SDK = f"""coalesce("aws.xray.sdk", '{seg.DEFAULT_SDK}')"""
ANNOTATION_COUNT = "(" + " + ".join(
    f'case when length("{t}") < 250 then 1 else 0 end' for t in NOT_CONSUMED
) + ")"
METADATA_COUNT = "case when length(note) >= 250 then 1 else 0 end"
OPERATION = (
    f"case when {ANNOTATION_COUNT} > 0 and ({METHOD}) is not null and name is not null "
    f"and ({METHOD}) <> name then name end"
)
BROKEN = "coalesce(\"cause.exceptions\" = '[{', false)"
FIRST_EXCEPTION = f"""case when "cause.exceptions" is not null and not {BROKEN} then 'boom' end"""
ENCODABLE = """length(trace_id) = 32 and coalesce("http.status_code", '0') <> 'abc'"""


def _segment(columns: str) -> str:
    return _spans(f"select trace_id, id, {columns} from spans")


def _entries(condition: str) -> str:
    parts = [
        f"""select trace_id, id, '{key}' as key, "{t}" as value from spans where "{t}" is not null and length("{t}") {condition} 250"""
        for t, key in NOT_CONSUMED.items()
    ]
    return _spans(" union all ".join(parts))


DOCUMENT = _spans(f"""
select {TRACE_ID} as trace_id, parent_id, id, {TYPE} as type, {NAMESPACE} as namespace, {NAME} as name,
  {START} as start_time, case when timestamp is not null then {END} end as end_time,
  {IN_PROGRESS} as in_progress,
  case when {STATUS_CLASS} = 'throttle' then true end as throttle,
  case when {STATUS_CLASS} = 'fault' then true end as fault,
  case when {STATUS_CLASS} = 'error' then true end as error,
  "aws.origin" as origin, upper({METHOD}) as http_method, "http.url" as http_url,
  {STATUS} as http_status, {HAS_SQL} as has_sql, "sql.sanitized_query" as sql_query, {SDK} as sdk,
  "aws.operation" as aws_operation, "aws.region" as aws_region, "aws.table_name" as aws_table_name,
  "aws.ec2.instance_id" as instance_id, "cause.working_directory" as working_directory,
  {FIRST_EXCEPTION} as first_exception,
  cast({ANNOTATION_COUNT} + case when {OPERATION} is not null then 1 else 0 end as bigint) as annotation_count,
  cast({METADATA_COUNT} as bigint) as metadata_count, {OPERATION} as operation
from spans where {ENCODABLE}
""")

# ---------------------------------------------------------------- messages

# what each kind of message turns into
EVENT_SPAN = """lpad(printf('%x', cast(floor(epoch(ts)) as bigint)), 8, '0') || lpad(printf('%x', user_id), 24, '0') as trace_id,
  lpad(printf('%x', event_id + 1), 16, '0') as id,
  event_type || case when event_id % 8 = 6 then 'é' else '' end as name,
  epoch_us(ts) as timestamp, cast(round(value * 1000) as bigint) as duration,
  json_extract_string(props, '$.k') as tag_k"""
EVENT_SPANS = f"""select {inputs.TRANSPORT} as transport, cast(event_id as varchar) as message_id, {EVENT_SPAN}
from events where event_id % 8 in (0, 1, 6)"""
RECORD_SPANS = f"""select 'kinesis' as transport, cast(event_id as varchar) as message_id, {EVENT_SPAN}
from events where event_id % 8 in (0, 1, 6)"""

PAYLOADS = f"""messages as ({inputs.MESSAGES_SQL}),
payloads as (
  select *, cast(message_id as bigint) % 8 as k,
    case when body in ('', '[]') then null when body[1] = '[' then encode(body)
      when cast(message_id as bigint) % 8 = 1 then from_base64(body) end as payload
  from messages)"""
COUNTERS = """cast(count(*) filter (where k in (0, 1, 4, 6, 7)) as bigint) as messages,
  cast(coalesce(sum(octet_length(payload)) filter (where k in (0, 1, 4, 6, 7)), 0) as bigint) as bytes,
  cast(count(*) filter (where k in (4, 7)) as bigint) as messages_dropped,
  cast(count(*) filter (where k in (0, 1, 6)) as bigint) as spans"""


def _window_metrics(starts: str, length: str) -> str:
    return f"""with {PAYLOADS},
windows as (select *, unnest({starts}) as window_start from payloads)
select window_start, window_start + interval '{length}' as window_end, transport, {COUNTERS}
from windows group by window_start, transport"""


TUMBLING = _window_metrics("[time_bucket(interval '10 minutes', received_at)]", "10 minutes")
SLIDING = _window_metrics(
    "[time_bucket(interval '20 minutes', received_at) - interval '20 minutes' * x for x in [0, 1, 2]]",
    "1 hour",
)

V1 = """with e as (
  select *, event_id % 6 as k, epoch_us(ts) as t, cast(round(value * 1000) as bigint) as n,
    event_id % 5 <> 0 as own from events),
sides as (
  select *, 'CLIENT' as kind, 'web' as local_service, case when k = 0 then 'db' end as remote_service,
    t as timestamp, n as duration, null::boolean as shared from e where k in (0, 4)
  union all
  select *, 'SERVER', 'api', null, case when k = 4 then t + 5 else t end, n,
    case when k = 4 then true end from e where k in (1, 4)
  union all
  select *, 'PRODUCER', 'web', 'broker', t, case when own then n end, null from e where k = 2
  union all
  select *, 'CONSUMER', 'job', null, t, case when own then n end, null from e where k = 3
  union all
  select *, null, 'worker', null, case when own then t end, case when own then n end, null
  from e where k = 5)
select cast(event_id as varchar) as message_id, lpad(printf('%x', user_id + 1), 16, '0') as trace_id,
  lpad(printf('%x', event_id + 1), 16, '0') as id, kind, event_type as name, timestamp, duration,
  local_service, case when k <> 5 then '10.0.0.1' end as local_ipv4, remote_service, shared,
  cast(case when k = 1 then 1 else 0 end as bigint) as annotation_count,
  json_extract_string(props, '$.k') as tag_k, 1::bigint as tag_count
from sides"""

# ---------------------------------------------------------------- packing

UNIQUE = f"""spans as ({inputs.SPANS_SQL}),
delivered as (select * from spans union all select * from spans where order_key % 5 = 0),
uniq as (
  select * from delivered qualify row_number() over (
    partition by trace_id, id, kind
    order by timestamp nulls last, duration nulls last, name nulls last, remote_service nulls last) = 1)"""


def _text(field: str, column: str) -> str:
    return f"""coalesce(',"{field}":"' || {column} || '"', '')"""


SPAN_JSON = (
    """'{"traceId":"' || trace_id || '"' || """ + _text("parentId", "parent_id")
    + """ || ',"id":"' || id || '"' || """ + _text("kind", "kind") + " || " + _text("name", "name")
    + """ || coalesce(',"timestamp":' || timestamp, '') || coalesce(',"duration":' || duration, '')"""
    + """ || coalesce(',"localEndpoint":{"serviceName":"' || local_service || '"}', '')"""
    + """ || coalesce(',"remoteEndpoint":{"serviceName":"' || remote_service || '"}', '')"""
    + """ || ',"tags":{' || concat_ws(',', """ + ", ".join(
        f"""'"{t}":"' || replace("{t}", '"', '\\"') || '"'""" for t in [*inputs.ALL_TAGS, inputs.LONG_TAG]
    ) + """) || '}}'"""
)


def _packing(max_bytes: int, base64: bool) -> str:
    usable = max_bytes * 3 // 4 - 2 if base64 else max_bytes
    small, large = usable // 16, usable // 2

    def running(step: int) -> str:
        return f"""((sum(size) over (partition by pack_key, packing order by bucket, trace_id, id, kind
      rows unbounded preceding) - 1) // {step})"""

    return f"""with plain as ({inputs.SPANS_SQL}),
spans as (select *, {inputs.long_tag_text()} as "{inputs.LONG_TAG}" from plain),
encoded as (
  select local_service as pack_key, trace_id, id, kind, {SPAN_JSON} as json,
    cast(strlen({SPAN_JSON}) + 1 as bigint) as size,
    {_number("trace_id || ':' || id")} % {packing.DEFAULT_BUCKETS} as bucket from spans
  qualify row_number() over (partition by trace_id, id, kind order by json) = 1),
sized as (
  select *, case when size + 1 > {usable} then 'oversize' when size > {large} then 'alone'
    when size > {small} then 'large' else 'shared' end as packing from encoded),
packed as (
  select *, case packing when 'shared' then 'b' || {running(usable - small - 1)}
    when 'large' then 'l' || {running(usable - large - 1)}
    when 'alone' then concat_ws('-', 'a', trace_id, id, coalesce(kind, '')) end as batch
  from sized)"""


def _filling(max_bytes: int, base64: bool, bucket_bytes: int) -> str:
    room, small = filling.room_and_small(max_bytes, base64)
    return f"""with plain as ({inputs.SPANS_SQL}),
spans as (select *, {inputs.long_tag_text()} as "{inputs.LONG_TAG}" from plain),
encoded as (
  select local_service as pack_key, trace_id, id, kind, cast(strlen({SPAN_JSON}) + 1 as bigint) as size,
    {_number("trace_id || ':' || id")} as number from spans
  qualify row_number() over (partition by trace_id, id, kind order by {SPAN_JSON}) = 1),
keyed as (select *, number % cast(ceil(sum(size) over (partition by pack_key) / {bucket_bytes}) as bigint) as bucket,
    least({room} // size, {filling.SHARED_CLASS}) as class from encoded where size <= {room}),
placed as (select *, row_number() over w - 1 as nth, sum(size) over w - size as start from keyed
  window w as (partition by pack_key, class order by bucket, trace_id, id, kind nulls first rows unbounded preceding)),
large as (select *, nth // class as message from placed where class < {filling.SHARED_CLASS}),
laid as (select pack_key, class, message, {room} - sum(size) - {small} + 1 as length from large group by all),
gaps as (select pack_key, 'c' || class || '-' || message as batch, length,
    sum(length) over (partition by pack_key order by class, message rows unbounded preceding) as gap_end
  from laid where length > 0),
filled as (select p.*, coalesce(m.gap_end, 0) as gap_end
  from (select * from placed where class = {filling.SHARED_CLASS}) p
  left join (select pack_key, max(gap_end) as gap_end from gaps group by 1) m using (pack_key)),
joined as (select f.*, g.batch from filled f asof left join (select *, gap_end - length as gap_start from gaps) g
  on f.pack_key = g.pack_key and f.start >= g.gap_start)
select pack_key, trace_id, id, kind, size, 'class' || class as packing, 'c' || class || '-' || message as batch from large
union all select pack_key, trace_id, id, kind, size, 'shared',
  case when start < gap_end then batch else 'b' || ((start - gap_end) // {room - small + 1}) end from joined
union all select pack_key, trace_id, id, kind, size, 'oversize', null from encoded where size > {room}"""


def _lists(key: str, md5: str, max_bytes: int, base64: bool) -> str:
    return f"""{_packing(max_bytes, base64)}
select pack_key as {key}, batch, count(*) as span_count, cast(sum(size) + 1 as bigint) as list_bytes,
  md5('[' || string_agg(json, ',' order by trace_id, id) || ']') as {md5}
from packed where packing <> 'oversize' group by pack_key, batch"""


# ---------------------------------------------------------------- logs

def _attempts(wanted: str = "true") -> str:
    return f"""log as ({inputs.ATTEMPTS_SQL}),
a as (
  select * exclude (trace_id, parent_id),
    coalesce(trace_id, '00000000' || substr(md5('call:' || call_id), 1, 24)) as trace_id,
    case when trace_id is not null then parent_id end as parent_id,
    substr(md5('call:' || call_id), 1, 16) as call_span,
    case when request_class = 'GetItemRequest' then 'GetItem' else 'Scan' end as operation
  from log where {wanted})"""


# calls without a caller are left out where the request rule says so
ATTEMPTS = f"""{_attempts("log.trace_id is not null or coalesce(request_rule, true)")},
finals as (
  select call_id, recv_ts as last_recv, status as last_status, error as last_error,
    case when has_cause or not is_service_error or error_message is not null then error end as last_real_error
  from a qualify row_number() over (
    partition by call_id order by attempt_no desc, recv_ts desc nulls last, status desc nulls last) = 1)"""

CALL_SPANS = f"""with {ATTEMPTS}
select trace_id, parent_id, call_span as id, null as kind, 'aws-sdk' as name, min(send_ts) as timestamp,
  any_value(last_recv) - min(send_ts) as duration, null as local_service, null as remote_service,
  service as aws_service_name, operation as aws_operation, null as aws_request_id,
  null as http_status_code,
  coalesce(any_value(last_error),
    case when any_value(last_status) >= 400 then cast(any_value(last_status) as varchar) end) as error
from a join finals using (call_id) group by trace_id, parent_id, call_span, service, operation
union all
select trace_id, call_span, substr(md5(call_id || ':' || attempt_no), 1, 16), 'CLIENT', operation,
  send_ts, recv_ts - send_ts, null, service, null, null, request_id,
  case when status not between 200 and 299 then cast(status as varchar) end,
  coalesce(error, case when status >= 400 then cast(status as varchar) end)
from a"""


def _operation_spans(error: str) -> str:
    return f"""with {ATTEMPTS}
select trace_id, parent_id, call_span as id, 'CLIENT' as kind, operation as name,
  min(send_ts) as timestamp, any_value(last_recv) - min(send_ts) as duration,
  null as local_service, service as remote_service,
  service as aws_service_name, operation as aws_operation,
  case when any_value(last_status) not between 200 and 299 then cast(any_value(last_status) as varchar) end
    as http_status_code,
  {error} as error
from a join finals using (call_id)
group by trace_id, parent_id, call_span, service, operation"""


LAST_FAILED = "case when any_value(last_status) >= 400 then cast(any_value(last_status) as varchar) end"
OPERATION_SPANS = _operation_spans(f"coalesce(any_value(last_real_error), {LAST_FAILED})")
# events carry a status but no error
EVENT_SPANS_OF_CALLS = _operation_spans(LAST_FAILED)

PUBLISHES = f"publishes as ({inputs.PUBLISHES_SQL})"
_HEX_SECONDS = "lpad(printf('%x', {} // 1000000), 8, '0')"
# by order number: scope (3), header (2), header with parent (4)
CONTEXTS = f"""{PUBLISHES},
contexts as (
  select *, substr(md5(batch_id || ':' || entry_id), 1, 16) as span_id,
    case when scope_trace_id is not null then scope_trace_id
      when header is not null then substr(header, 8, 8) || substr(header, 17, 24)
      else {_HEX_SECONDS.format("sent_ts")} || substr(md5('message:' || batch_id || ':' || entry_id), 1, 24)
    end as trace_id,
    case when scope_trace_id is not null then scope_span_id
      when header like '%Parent=%' then split_part(split_part(header, 'Parent=', 2), ';', 1)
    end as parent_id,
    case when scope_trace_id is not null then true when header like '%Sampled=0%' then false end as sampled,
    case when scope_trace_id is null and header like '%;k=v' then ';k=v' else '' end as custom
  from publishes)"""
PUBLISH_FLAT = """'PRODUCER' as kind, 'publish' as name, sent_ts as timestamp, 0::bigint as duration,
  local_service, 'amazon-sqs' as remote_service, queue_url"""
PUBLISH_SPANS = f"""with {CONTEXTS}
select trace_id, parent_id, span_id as id, {PUBLISH_FLAT} from contexts
where coalesce(sampled, true)"""
BATCH_TRACE = f"""coalesce(scope_trace_id, {_HEX_SECONDS.format("batch_ts")} || substr(md5('batch:' || batch_id), 1, 24))"""
BATCH_ID = "substr(md5('batch:' || batch_id), 1, 16)"
BATCH_SPANS = f"""with {PUBLISHES}
select {BATCH_TRACE} as trace_id, {BATCH_ID} as parent_id,
  substr(md5(batch_id || ':' || entry_id), 1, 16) as id, {PUBLISH_FLAT} from publishes
union all
select any_value({BATCH_TRACE}), any_value(scope_span_id), {BATCH_ID}, 'PRODUCER', 'publish-batch',
  any_value(batch_ts), max(sent_ts) - any_value(batch_ts), any_value(local_service), 'amazon-sqs', null
from publishes group by batch_id"""

# ---------------------------------------------------------------- headers

PARSED = f"""headers as ({inputs.HEADERS_SQL}),
parsed as (
  select *, request_key % 8 as k,
    case when request_key % 8 in (0, 1, 2, 3) or (request_key % 8 = 6 and r1 = upper(r1))
      then r1 || r2 end as root,
    case when request_key % 8 in (0, 1) then p end as parent,
    case when request_key % 8 in (0, 5) then true
      when request_key % 8 = 1 or (request_key % 8 = 6 and r1 = upper(r1)) then false end as sampled,
    case when request_key % 8 = 3 then ';Robot=Hello;CalledFrom=<segment>'
      when request_key % 8 <> 7 then '' end as custom
  from headers)"""
CONTEXT = "case when root is null then 'flags' when parent is null then 'trace_id' else 'context' end"

STORE = f"with {UNIQUE}"
FLAT = "trace_id, parent_id, id, kind, name, timestamp, duration, local_service, remote_service"
LATEST_TRACES = f"""{STORE},
t as (select trace_id, min(timestamp) as ts, bool_or(coalesce(local_service = 'building'
    and "http.path" is not null and duration >= 1000000, false)) as hit from uniq group by trace_id),
top as (select trace_id from t where hit and ts between {(catalog.END_TS - catalog.LOOKBACK) * 1000}
    and {catalog.END_TS * 1000} order by ts desc, trace_id limit 10)
select {FLAT} from uniq where trace_id in (select trace_id from top)"""

LINKED = f"""{STORE.replace("with ", "with recursive ", 1)},
ends as (
  select trace_id, id, coalesce(kind in ('SERVER', 'CONSUMER'), false) as incoming, local_service as service,
    remote_service as remote, parent_id, kind, timestamp,
    error is not null or coalesce(try_cast("http.status_code" as integer) >= 500, false) as failed
  from uniq
  qualify row_number() over (partition by trace_id, id, incoming
    order by service nulls first, remote nulls first, parent_id nulls first, kind nulls first,
      timestamp nulls first, failed) = 1),
halves as (select *, count(*) over (partition by trace_id, id) = 2 as shared from ends),
nodes as (
  select trace_id, case when shared and not incoming then id || '/caller' else id end as node,
    case when shared and incoming then id || '/caller' else parent_id end as up,
    service, remote, kind, timestamp, failed, shared and not incoming as answered
  from halves),
walk as (
  select trace_id, node, service as own, up from nodes where up is not null
  union
  select w.trace_id, w.node, w.own, n.up from walk w join nodes n on n.trace_id = w.trace_id and n.node = w.up
  where (n.service is null or n.service = w.own) and n.up is not null),
callers as (
  select w.trace_id, w.node, n.service as caller
  from walk w join nodes n on n.trace_id = w.trace_id and n.node = w.up
  where n.service is not null and (w.own is null or n.service <> w.own)),
calls as (
  select coalesce(c.caller, n.remote) as parent, n.service as child, failed
  from nodes n left join callers c on n.trace_id = c.trace_id and n.node = c.node
  where n.kind in ('SERVER', 'CONSUMER') and n.service is not null
    and n.timestamp between {(catalog.END_TS - catalog.LOOKBACK) * 1000} and {catalog.END_TS * 1000}
  union all
  select coalesce(n.service, c.caller), n.remote, failed
  from nodes n left join callers c on n.trace_id = c.trace_id and n.node = c.node
  where n.kind in ('CLIENT', 'PRODUCER') and n.remote is not null and not n.answered
    and n.timestamp between {(catalog.END_TS - catalog.LOOKBACK) * 1000} and {catalog.END_TS * 1000}
    and not exists (select 1 from nodes k where k.trace_id = n.trace_id and k.up = n.node))"""
LOGGED = f"""{STORE},
logs as ({inputs.REQUEST_LOGS_SQL}),
summary as (select trace_id, count(*) as span_count, min(timestamp) as first_ts from uniq group by trace_id),
rooted as (
  select request_id,
    case when header like 'Root=1-%' then substr(header, 8, 8) || substr(header, 17, 24) end as trace_id
  from logs),
joined as (
  select request_id, trace_id,
    case when trace_id is null then 'untraced' when span_count is null then 'unknown_trace' else 'traced' end as state,
    span_count, first_ts
  from rooted left join summary using (trace_id))"""


def oracle_sql() -> dict[str, str]:
    sampled = f"{_number('trace_id')} % 10000 < {int(catalog.SAMPLE_RATE * 10000)}"
    return {
        # sources and sinks
        "read_queue_messages": f"select message_id, receipt_handle, transport, body from ({inputs.MESSAGES_SQL})",
        "read_stream_records": (
            "select message_id, partition_key, lower(hex(data)) as data_hex, "
            f"octet_length(data) as bytes from ({inputs.RECORDS_SQL})"
        ),
        "decode_spans_json_v2": EVENT_SPANS,
        "decode_spans_json_v1": V1,
        "read_all_spans": f"{EVENT_SPANS} union all {RECORD_SPANS}",
        "write_queue_messages": _lists("pack_key", "body_md5", catalog.QUEUE_BYTES, True),
        "write_oversize_spans": f"""{_packing(catalog.QUEUE_BYTES, True)}
            select pack_key, trace_id, id, kind, size, md5(json) as json_md5 from packed where packing = 'oversize'""",
        "write_stream_records": _lists("partition_key", "data_md5", catalog.STREAM_BYTES, False),
        "write_xray_segments": DOCUMENT,
        "report_xray": _spans(f"""
            select trace_id, id, case when length(trace_id) <> 32 then 'trace_id_not_128_bit'
                when "http.status_code" = 'abc' then 'status_not_a_number' else 'sent' end as outcome,
              case when {ENCODABLE} then coalesce("aws.xray.sdk", '{seg.REPORTER_SDK}') end as sdk
            from spans"""),
        # filters and routing
        "skip_empty_bodies": f"select message_id, body from ({inputs.MESSAGES_SQL}) where body not in ('', '[]')",
        "decode_transport": f"with {PAYLOADS} select message_id, octet_length(payload) as bytes, md5(payload) as payload_md5 from payloads",
        "detect_payload_format": (
            "select cast(event_id as varchar) as message_id, case event_id % 8 when 2 then null "
            "when 5 then 'binary' else 'json' end as format from events"
        ),
        "route_messages": """
            with m as (select event_id, event_id % 8 as k from events),
            o as (select event_id, case when k in (2, 3) then 'skipped' when k = 5 then 'undecodable'
                when k in (4, 7) then 'malformed' when event_id % 48 = 0 then 'retry'
                when event_id % 40 = 0 then 'malformed' else 'accepted' end as outcome from m)
            select cast(event_id as varchar) as message_id, outcome,
              outcome not in ('skipped', 'undecodable') as counted,
              outcome not in ('skipped', 'retry') as "delete" from o""",
        "require_128bit_trace_id": _spans("select trace_id, id from spans where length(trace_id) = 32"),
        "sample_traces": _spans(f"""select trace_id, id, case when id like '0007%' then true end as debug
            from spans where id like '0007%' or {sampled}"""),
        "encode_body": (
            "select cast(doc_id as varchar) as key, md5(case when strlen(text) = length(text) "
            "then text else to_base64(encode(text)) end) as body_md5 from (select doc_id, text from documents "
            f"union all select 'e' || event_id, {inputs.list_text(DUCK)} from events)"
        ),
        "default_sdk_tag": _spans(f"""select trace_id, id, coalesce("aws.xray.sdk", '{seg.REPORTER_SDK}') as sdk,
            cast({" + ".join(f'case when "{t}" is not null then 1 else 0 end' for t in inputs.ALL_TAGS if t != seg.SDK_TAG)} + 1 as bigint) as tag_count
            from spans"""),
        "strip_trace_headers": f"""select batch_id, entry_id, tenant, null::varchar as header,
            1::bigint as attribute_count from ({inputs.PUBLISHES_SQL})""",
        "keep_real_errors": f"""select call_id, attempt_no, case when has_cause or not is_service_error
            or error_message is not null then error end as error from ({inputs.ATTEMPTS_SQL})""",
        "empty_to_null": "select p_partkey as part_key, case when p_partkey % 5 <> 0 then p_name end as setting from part",
        # segments
        "xray_trace_id": _segment(f"case when length(trace_id) = 32 then {TRACE_ID} end as xray_trace_id"),
        "xray_parent_id": _segment("parent_id"),
        "xray_type": _segment(f"{TYPE} as type"),
        "xray_namespace": _segment(f"{NAMESPACE} as namespace"),
        "xray_name": _segment(f"{NAME} as name"),
        "xray_times": _segment(f"{START} as start_time, {END} as end_time, {IN_PROGRESS} as in_progress"),
        "xray_http": _segment(f"""{HAS_HTTP} as has_http, upper({METHOD}) as http_method, "http.url" as http_url, {STATUS} as http_status"""),
        "xray_status_class": _segment(f"{STATUS_CLASS} as status_class"),
        "xray_sql": _segment(f"""{HAS_SQL} as has_sql, "sql.url" as sql_url, null::varchar as sql_preparation,
            null::varchar as sql_database_type, null::varchar as sql_database_version,
            null::varchar as sql_driver_version, "sql.user" as sql_user, "sql.sanitized_query" as sql_sanitized_query"""),
        "xray_aws": _segment(f"""{SDK} as sdk, "aws.operation" as operation, null::varchar as account_id,
            "aws.region" as region, null::varchar as request_id, null::varchar as queue_url, "aws.table_name" as table_name"""),
        "xray_ec2": _segment('"aws.ec2.instance_id" is not null as has_ec2, "aws.ec2.instance_id" as instance_id'),
        "xray_origin": _segment('"aws.origin" as origin'),
        "xray_cause": _segment(f"""{HAS_CAUSE} as has_cause, "cause.working_directory" as working_directory,
            {FIRST_EXCEPTION} as first_exception, {BROKEN} as broken"""),
        "xray_annotations": _entries("<"),
        "xray_metadata": _entries(">="),
        "xray_operation": _segment(f"{OPERATION} as operation"),
        "xray_document": DOCUMENT,
        "xray_segments": _spans(f"""
            select trace_id, id, {TRACE_ID} as xray_trace_id, parent_id, {TYPE} as type, {NAMESPACE} as namespace,
              {NAME} as name, {START} as start_time, {END} as end_time, {IN_PROGRESS} as in_progress,
              upper({METHOD}) as http_method, "http.url" as http_url, {STATUS} as http_status, {STATUS_CLASS} as status_class,
              "sql.url" as sql_url, null::varchar as sql_preparation, null::varchar as sql_database_type,
              null::varchar as sql_database_version, null::varchar as sql_driver_version, "sql.user" as sql_user,
              "sql.sanitized_query" as sql_sanitized_query, {SDK} as sdk, "aws.operation" as aws_operation,
              null::varchar as aws_account_id, "aws.region" as aws_region, null::varchar as aws_request_id,
              null::varchar as aws_queue_url, "aws.table_name" as aws_table_name,
              null::varchar as ec2_availability_zone, "aws.ec2.instance_id" as ec2_instance_id, "aws.origin" as origin
            from spans where {ENCODABLE}"""),
        # headers
        "parse_trace_header": f"with {PARSED} select request_key, root, parent, sampled, custom from parsed",
        "classify_trace_context": f"with {PARSED} select request_key, {CONTEXT} as context from parsed",
        "format_trace_header": _spans(f"""
            select trace_id, id, 'Root=' || {TRACE_ID} || ';Parent=' || id || ';Sampled='
              || case when duration is null then '?' when duration % 2 = 0 then '1' else '0' end
              || case when kind is null then ';Tenant=north-7' else '' end as header
            from spans where length(trace_id) = 32"""),
        "format_root_id": _spans(f"select id, {TRACE_ID} as root from spans where length(trace_id) = 32"),
        "root_from_passthrough": f"""with {PARSED} select request_key,
            case when k in (0, 1, 2, 3) or k = 6 then '1-' || case when k = 6 then upper(r1) else r1 end || '-' || r2
              when k = 4 then '2-' || r1 || '-' || r2 end as root from parsed""",
        "root_epoch": _spans("""select trace_id, cast('0x' || substr(trace_id, 1, 8) as bigint) as epoch_seconds
            from spans where length(trace_id) = 32"""),
        "hex_id": "select event_id, lpad(printf('%x', event_id * 1000003), 16, '0') as hex from events",
        "parse_lambda_header": f"""with {PARSED},
            env as (select * replace (case when request_key % 3 <> 0 then root end as root,
                case when request_key % 3 <> 0 then parent end as parent,
                case when request_key % 3 <> 0 then sampled end as sampled,
                case when request_key % 3 <> 0 then custom end as custom) from parsed)
            select request_key, root, parent, sampled, custom, {CONTEXT} as context from env""",
        "custom_fields": f"""with {PARSED} select request_key, case when k = 3 then 'Hello' end as robot,
            case when k = 3 then '<segment>' end as called_from from parsed""",
        # logs
        "sdk_call_spans": CALL_SPANS,
        "sdk_operation_spans": OPERATION_SPANS,
        "call_annotations": f"""with {ATTEMPTS}
            select trace_id, call_span as id, send_ts as timestamp, 'ws' as value from a
            union all select trace_id, call_span, recv_ts, 'wr' from a where recv_ts is not null""",
        "publish_spans": PUBLISH_SPANS,
        "publish_batch_spans": BATCH_SPANS,
        "inject_message_headers": f"""with {CONTEXTS}
            select batch_id, entry_id, tenant, 'Root=' || {TRACE_ID} || ';Parent=' || span_id || ';Sampled='
              || case when coalesce(sampled, {sampled}) then '1' else '0' end || custom as header
            from contexts""",
        "resolve_parent": f"with {CONTEXTS} select batch_id, entry_id, trace_id, parent_id, sampled, custom from contexts",
        "operation_name": """select case when o_orderkey % 4 = 0 then 'Scan' else 'GetItem' end as operation,
            count(*) as attempts from lineitem join orders on l_orderkey = o_orderkey group by 1""",
        "request_url": """select p_partkey as part_key, 'https://part-' || (p_partkey % 5) || '.example'
            || case when p_partkey % 2 = 0 then '/parts/' || p_partkey else '' end
            || case p_partkey % 3 when 0 then '' when 1 then '?brand=' || p_brand || '&size=' || p_size
                else '?brand=' || p_brand end as url from part""",
        "request_id": f"""select call_id, attempt_no, case when is_service_error or has_result then request_id
            else header_request_id end as request_id from ({inputs.ATTEMPTS_SQL})""",
        "deferred_root_sampling": f"""with {_attempts()}
            select distinct call_id, case when cast(call_id as bigint) % 3 <> 0 then true
              else coalesce(request_rule, {sampled}) end as sampled from a""",
        "header_first_value": """select p_partkey as part_key, case when p_partkey % 4 <> 0 then p_type end as first,
            null::varchar as absent from part""",
        "response_status": "select p_partkey as part_key, case when p_partkey % 6 <> 0 then p_size else 0 end as status from part",
        # counters and packing
        "collector_metrics": f"with {PAYLOADS} select transport, {COUNTERS} from payloads group by transport",
        "message_size": f"""with {PAYLOADS}, sized as (
              select transport, cast(sum(octet_length(payload)) as bigint) as list_bytes from payloads group by transport)
            select transport, list_bytes, (list_bytes + 2) * 4 // 3 as size_estimate from sized""",
        "pack_spans": f"{_packing(catalog.QUEUE_BYTES, True)} select pack_key, trace_id, id, kind, size, packing, batch from packed",
        "fill_messages": _filling(catalog.QUEUE_BYTES, True, catalog.FILLED_BUCKET_BYTES),
        "partition_key": """with h as (select event_id, user_id, md5('producer-' || user_id) as m from events)
            select event_id, case when event_id % 4 <> 0 then 'host-' || user_id else substr(m, 1, 8) || '-'
              || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21, 12)
              end as partition_key from h""",
        # store
        "get_traces": LATEST_TRACES,
        "get_traces_indexed": LATEST_TRACES,
        "sample_to_budget": f"""{STORE},
            firsts as (select trace_id, local_service as service, {_number("trace_id")} as hash,
                timestamp // {catalog.SAMPLED_SECONDS * 1_000_000} * {catalog.SAMPLED_SECONDS} as slot from uniq
              qualify row_number() over (partition by trace_id order by parent_id is not null,
                timestamp nulls last, id, coalesce(kind, ''), coalesce(local_service, '')) = 1),
            placed as (select *, row_number() over g as place, nth_value(hash, {catalog.SAMPLED_TRACES + 1}) over (g
                rows between unbounded preceding and unbounded following) as threshold
              from firsts window g as (partition by service, slot order by hash, trace_id))
            select trace_id, service, slot, coalesce({float(1 << 60)}::double / threshold, 1.0) as weight
            from placed where place <= {catalog.SAMPLED_TRACES}""",
        "get_trace": f"{STORE} select {FLAT} from uniq where trace_id = (select max(trace_id) from spans)",
        "get_service_names": _spans("select distinct local_service as service from spans where local_service is not null"),
        "get_span_names": _spans("select distinct name from spans where local_service = 'building' and name is not null"),
        "get_dependencies": f"""{STORE},
            parents as (select trace_id, id, local_service from uniq qualify row_number() over (
                partition by trace_id, id order by coalesce(kind in ('SERVER', 'CONSUMER'), false) desc,
                kind nulls last, local_service) = 1)
            select p.local_service as parent,
              case when c.kind in ('CLIENT', 'PRODUCER') then c.remote_service else c.local_service end as child,
              count(*) as call_count,
              cast(count(*) filter (where c.error is not null or try_cast(c."http.status_code" as integer) >= 500) as bigint) as error_count
            from uniq c join parents p on c.trace_id = p.trace_id and c.parent_id = p.id
            where c.kind is not null and c.timestamp is not null and p.local_service is not null
              and case when c.kind in ('CLIENT', 'PRODUCER') then c.remote_service else c.local_service end is not null
            group by 1, 2""",
        "service_links": f"""{LINKED}
            select parent, child, count(*) as call_count, count(*) filter (where failed) as error_count
            from calls where parent <> child group by 1, 2""",
        "correlate_logs": f"{LOGGED} select * from joined",
        "correlate_logs_indexed": f"{LOGGED} select * from joined",
        "untraced_requests": f"{LOGGED} select request_id, state from joined where state <> 'traced'",
        # regions
        "region_from_hosts": f"""select host_key,
            case host_key % 8 when 0 then r when 2 then r when 6 then upper(r) end as region,
            case host_key % 8 when 0 then 'ok' when 1 then 'none' when 2 then 'ok' when 3 then 'mismatched regions'
              when 4 then 'too many regions' when 5 then 'too many regions' when 6 then 'ok' end as status
            from (select s_suppkey as host_key, lower(replace(n_name, '_', '-')) as r
              from supplier join nation on s_nationkey = n_nationkey)""",
        # streaming
        "stream_ingest": EVENT_SPANS,
        "acknowledgements": """
            with m as (select event_id, event_id % 8 as k from events)
            select cast(event_id as varchar) as message_id, 'r' || event_id as receipt_handle,
              case when k in (2, 3) then 'skipped' when k = 5 then 'undecodable'
                when k in (4, 7) then 'malformed' else 'accepted' end as outcome,
              k not in (2, 3) as "delete" from m""",
        "stream_ingest_records": f"""with r as (select *, event_id % 8 as k from events join (
              select cast(message_id as bigint) as event_id, octet_length(data) as n from ({inputs.RECORDS_SQL}))
              using (event_id))
            select case when k in (0, 1, 3, 6) then 'accepted' when k = 5 then 'unsupported_format' else 'malformed' end as outcome,
              count(*) as records, cast(sum(n) as bigint) as bytes,
              cast(count(*) filter (where k in (0, 1, 6)) as bigint) as spans from r group by 1""",
        "dedup_spans": f"{STORE} select {FLAT} from uniq",
        "dedup_spans_stream": EVENT_SPANS,
        "metrics_by_window": TUMBLING,
        "metrics_by_sliding_window": SLIDING,
        "metrics_by_window_stream": TUMBLING,
        "pair_call_events": EVENT_SPANS_OF_CALLS,
        "pair_call_events_stream": EVENT_SPANS_OF_CALLS,
        "pair_call_events_timed": EVENT_SPANS_OF_CALLS,
        "stream_store": EVENT_SPANS,
        "retry_messages": EVENT_SPANS,
        "dedup_spans_store": EVENT_SPANS,
        "max_batch": """select cast(ceil(count(distinct part) / 3.0) as bigint) as batches, sum(n)::bigint as messages,
            sum(accepted)::bigint as accepted from (
              select x as part, count(*) as n, count(*) filter (where event_id % 8 in (0, 1, 6)) as accepted
              from (select *, event_id % 12 as x from events) group by x)""",
    }

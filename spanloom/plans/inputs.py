"""Spans, messages, headers and logs derived from the given tables.

Each input is a list of (column, expression) pairs over a join of tables, written once and rendered
for Spark and for the oracle, so both sides start from the same rows.  Inputs are plain joins and
projections over whole tables; the operators under test never appear here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom import schema
from spanloom.plans.dialect import DUCK, SPARK

Columns = list[tuple[str, str]]

# columns that tell rows of a table apart
ROW_KEYS = {
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber", "l_partkey"],
    "customer": ["c_custkey"], "supplier": ["s_suppkey"], "events": ["event_id"],
    "documents": ["doc_id"],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a stream.

    The pattern matches one name only, and makes a single file and a folder of files both work.
    """
    kind = table(spark, sf_dir, name).schema
    return spark.readStream.schema(kind).parquet(f"{sf_dir}/{name}.parque[t]")


# ---------------------------------------------------------------- spans

ORDER_JOIN = [("orders", None), ("customer", "o_custkey = c_custkey")]
ITEM_JOIN = [
    ("lineitem", None), ("orders", "l_orderkey = o_orderkey"), *ORDER_JOIN[1:],
    ("supplier", "l_suppkey = s_suppkey"), ("nation", "s_nationkey = n_nationkey"),
]


def _trace_id(d) -> str:
    full = f"{d.hex(d.seconds('o_orderdate'), 8)} || {d.hex('o_orderkey + 1', 24)}"
    return f"case when o_orderkey % 25 = 0 then {d.hex('o_orderkey + 1', 16)} else {full} end"


def root_columns(d) -> Columns:
    return [
        ("order_key", "o_orderkey"),
        ("trace_id", _trace_id(d)),
        ("parent_id", "cast(null as varchar(16))"),
        ("id", d.hex("o_orderkey + 1", 16)),
        ("kind", "'SERVER'"),
        ("name", "lower(o_orderpriority)"),
        ("timestamp", f"case when o_orderkey % 13 <> 0 then {d.micros('o_orderdate')} end"),
        ("duration",
         "case when o_orderkey % 11 <> 0 then cast(round(o_totalprice * 100) as bigint) end"),
        ("local_service", "lower(c_mktsegment)"),
        ("remote_service", "cast(null as varchar(16))"),
    ]


ROOT_TAGS = {
    "http.method": "case when o_orderkey % 2 = 0 then 'post' end",
    "http.url": "'https://shop.example/orders/' || o_orderkey",
    "http.status_code": (
        "case when o_orderkey % 50 = 1 then 'abc' when o_orderkey % 9 = 0 then '404' "
        "when o_orderstatus = 'F' then '500' when o_orderstatus = 'O' then '200' else '429' end"
    ),
    "http.path": "case when o_orderkey % 3 = 0 then '/orders' end",
    "xray.namespace": "case when o_orderkey % 7 = 0 then 'aws' end",
    "note": "repeat('x', case when o_orderkey % 10 = 0 then 250 else 249 end)",
    "aws.region": "'us-west-2'",
    "aws.origin": "case when o_orderkey % 4 = 0 then 'AWS::EC2::Instance' end",
    "aws.ec2.instance_id": "case when o_orderkey % 6 = 0 then 'i-' || o_orderkey end",
}


def child_columns(d) -> Columns:
    return [
        ("order_key", "o_orderkey"),
        ("trace_id", _trace_id(d)),
        ("parent_id", d.hex("o_orderkey + 1", 16)),
        ("id", f"{d.hex('l_linenumber', 4)} || {d.hex('o_orderkey + 1', 12)}"),
        ("kind",
         "case l_linenumber when 4 then 'SERVER' when 5 then 'PRODUCER' when 6 then null "
         "else 'CLIENT' end"),
        ("name",
         "case when l_linenumber = 3 and l_returnflag = 'N' then null "
         "else lower(l_returnflag || l_linestatus) end"),
        ("timestamp",
         f"case when o_orderkey % 13 <> 0 then {d.micros('o_orderdate')} + l_linenumber * 1000 end"),
        ("duration",
         "case when o_orderkey % 11 <> 0 then cast(round(l_quantity * 1000) as bigint) end"),
        ("local_service", "lower(c_mktsegment)"),
        ("remote_service", "case when l_linenumber not in (3, 7) then lower(n_name) end"),
    ]


CHILD_TAGS = {
    "sql.url": "case when l_returnflag = 'A' then 'jdbc:shop' end",
    "sql.user": "case when l_returnflag = 'A' then 'reader' end",
    "sql.sanitized_query": "case when l_returnflag = 'A' then 'select ' || l_linenumber end",
    "sql.other": "case when l_returnflag = 'N' then 'x' end",
    "http.host": "case when l_linenumber = 7 then 'host-' || l_suppkey end",
    "aws.table_name": "'t' || (l_partkey % 10)",
    "aws.operation": "'GetItem'",
    "cause.working_directory": "case when l_returnflag = 'R' and l_linenumber = 1 then '/srv' end",
    "cause.exceptions": (
        "case when l_returnflag = 'R' and l_linenumber = 1 then "
        "case when l_partkey % 5 = 0 then '[{' "
        "else '[{\"id\":\"e1\",\"message\":\"boom\"}]' end end"
    ),
    "error": "case when l_returnflag = 'R' and l_linenumber = 2 then 'boom' end",
    "aws.xray.sdk": "case when l_linenumber = 2 then 'custom sdk' end",
}

ALL_TAGS = [*ROOT_TAGS, *CHILD_TAGS]


def _join(spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    return _join_to(table(spark, sf_dir, tables[0][0]), spark, sf_dir, tables[1:])


def _join_to(joined: DataFrame, spark: SparkSession, sf_dir: str, tables) -> DataFrame:
    for name, condition in tables:
        joined = joined.join(table(spark, sf_dir, name), F.expr(condition))
    return joined


def _joined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ITEM_JOIN``; orders meet their customers first, so that line items do not move for these."""
    (items, _), (_, of_order), *others = ITEM_JOIN
    ordered = _join(spark, sf_dir, ORDER_JOIN)
    joined = table(spark, sf_dir, items).join(ordered, F.expr(of_order))
    return _join_to(joined, spark, sf_dir, [t for t in others if t not in ORDER_JOIN])


def _project(df: DataFrame, columns: Columns, *more) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns], *more)


def _tag_map(tags: dict[str, str], deliveries: str):
    pairs = [x for k, e in tags.items() for x in (F.lit(k), F.expr(e))]
    built = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())
    # a stored table holds its tags ready made; without the explode every filter on a tag would
    # build the map again below the joins
    return F.explode(F.array_repeat(built, F.expr(deliveries))).alias("tags")


def root_spans(spark: SparkSession, sf_dir: str, deliveries: str = "1") -> DataFrame:
    joined = _join(spark, sf_dir, ORDER_JOIN)
    return schema.conform(_project(joined, root_columns(SPARK), _tag_map(ROOT_TAGS, deliveries)))


def child_spans(spark: SparkSession, sf_dir: str, deliveries: str = "1") -> DataFrame:
    joined = _joined_items(spark, sf_dir)
    return schema.conform(_project(joined, child_columns(SPARK), _tag_map(CHILD_TAGS, deliveries)))


def spans(spark: SparkSession, sf_dir: str, deliveries: str = "1") -> DataFrame:
    """Spans of orders and line items, each as often as ``deliveries`` says."""
    return root_spans(spark, sf_dir, deliveries).unionByName(child_spans(spark, sf_dir, deliveries))


def delivered_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans plus the redelivery of every fifth order's; the tables are joined once for both."""
    return spans(spark, sf_dir, "case when o_orderkey % 5 = 0 then 2 else 1 end")


def _duck_select(columns: Columns, tags: dict[str, str], tables) -> str:
    own = [f'{e} as "{n}"' for n, e in columns]
    tagged = [f'{tags.get(t, "cast(null as varchar)")} as "{t}"' for t in ALL_TAGS]
    source = tables[0][0] + "".join(f" join {t} on {c}" for t, c in tables[1:])
    return f"select {', '.join(own + tagged)} from {source}"


SPANS_SQL = (
    _duck_select(root_columns(DUCK), ROOT_TAGS, ORDER_JOIN)
    + " union all "
    + _duck_select(child_columns(DUCK), CHILD_TAGS, ITEM_JOIN)
)

# Of the packed spans some carry a long tag, by the end of their ID.
LONG_TAG = "blob"
LONG_TAG_SIZES = {"1": 1_500, "2f": 9_000, "3f": 20_000, "4f": 40_000}


def long_tag_text() -> str:
    """The long tag, or null; the same expression in both dialects."""
    cases = " ".join(f"when id like '%{end}' then repeat('z', {n})" for end, n in LONG_TAG_SIZES.items())
    return f"case {cases} end"


# ---------------------------------------------------------------- messages and records


def _span_text(d, event_type: str) -> str:
    trace = f"{d.hex(d.seconds('ts'), 8)} || {d.hex('user_id', 24)}"
    return (
        f"'{{\"traceId\":\"' || {trace} || '\",\"id\":\"' || {d.hex('event_id + 1', 16)} "
        f"|| '\",\"name\":\"' || {event_type} || '\",\"timestamp\":' || {d.micros('ts')} "
        f"|| ',\"duration\":' || cast(round(value * 1000) as bigint) "
        f"|| ',\"tags\":{{\"k\":\"' || {d.json_text('props', 'k')} || '\"}}}}'"
    )


def _list_text(d) -> str:
    return f"'[' || {_span_text(d, 'event_type')} || ']'"


def _accented_text(d) -> str:
    return f"""'[' || {_span_text(d, "event_type || 'é'")} || ']'"""


def _partly_bad_text(d) -> str:
    return f"""'[{{"traceId":"zz"}},' || {_span_text(d, 'event_type')} || ']'"""


def list_text(d) -> str:
    """The list of every event, some with an accent."""
    return f"case when event_id % 8 = 6 then {_accented_text(d)} else {_list_text(d)} end"


BAD_LIST = "'[this is no span list'"
TRANSPORT = "case when user_id % 2 = 0 then 'sqs' else 'kinesis' end"


def message_columns(d) -> Columns:
    return [
        ("message_id", "cast(event_id as varchar(20))"),
        ("receipt_handle", "'r' || event_id"),
        ("transport", TRANSPORT),
        ("body",
         f"case event_id % 8 when 0 then {_list_text(d)} when 1 then {d.base64(_list_text(d))} "
         f"when 2 then '' when 3 then '[]' when 4 then {BAD_LIST} when 5 then '!!not-base64' "
         f"when 6 then {_accented_text(d)} else {_partly_bad_text(d)} end"),
        ("received_at", d.timestamp("ts")),
    ]


def record_columns(d) -> Columns:
    """Records: lists, an empty list, unreadable text, bytes of another encoding, nothing at all."""
    return [
        ("message_id", "cast(event_id as varchar(20))"),
        ("partition_key", "'host-' || (user_id % 7)"),
        ("transport", "'kinesis'"),
        ("data",
         f"case event_id % 8 when 2 then {d.utf8(repr(''))} when 3 then {d.utf8(repr('[]'))} "
         f"when 4 then {d.utf8(BAD_LIST)} when 5 then {d.blob('0A0B0C')} "
         f"when 6 then {d.utf8(_accented_text(d))} when 7 then {d.utf8(_partly_bad_text(d))} "
         f"else {d.utf8(_list_text(d))} end"),
        ("received_at", d.timestamp("ts")),
    ]


def messages(events: DataFrame) -> DataFrame:
    return _project(events, message_columns(SPARK))


def records(events: DataFrame) -> DataFrame:
    return _project(events, record_columns(SPARK))


def queue_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(table(spark, sf_dir, "events"))


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records(table(spark, sf_dir, "events"))


def _sql(columns: Columns, source: str) -> str:
    return "select " + ", ".join(f'{e} as "{n}"' for n, e in columns) + f" from {source}"


MESSAGES_SQL = _sql(message_columns(DUCK), "events")
RECORDS_SQL = _sql(record_columns(DUCK), "events")


def _v1_text(d) -> str:
    """Older layout: client, server, producer, consumer, both ends, and local, by ``event_id % 6``."""
    t = d.micros("ts")
    n = "cast(round(value * 1000) as bigint)"

    def note(value: str, at: str, service: str) -> str:
        return (
            f"'{{\"timestamp\":' || ({at}) || ',\"value\":\"{value}\",\"endpoint\":"
            f"{{\"serviceName\":\"{service}\",\"ipv4\":\"10.0.0.1\"}}}}'"
        )

    def pair(a: str, b: str, service: str, shift: int = 0) -> str:
        return f"{note(a, f'{t} + {shift}', service)} || ',' || {note(b, f'{t} + {shift} + {n}', service)}"

    notes = (
        f"case event_id % 6 when 0 then {pair('cs', 'cr', 'web')} "
        f"when 1 then {pair('sr', 'ss', 'api')} || ',' || {note('note', t, 'api')} "
        f"when 2 then {note('ms', t, 'web')} when 3 then {note('mr', t, 'job')} "
        f"when 4 then {pair('cs', 'cr', 'web')} || ',' || {pair('sr', 'ss', 'api', 5)} "
        f"else '' end"
    )
    address = (
        "case event_id % 6 when 0 then ',{\"key\":\"sa\",\"value\":true,\"endpoint\":"
        "{\"serviceName\":\"db\"}}' when 2 then ',{\"key\":\"ma\",\"value\":true,\"endpoint\":"
        "{\"serviceName\":\"broker\"}}' when 5 then ',{\"key\":\"lc\",\"value\":\"part\","
        "\"endpoint\":{\"serviceName\":\"worker\"}}' else '' end"
    )
    own_times = f"case when event_id % 5 <> 0 then ',\"timestamp\":' || {t} || ',\"duration\":' || {n} else '' end"
    return (
        f"'[{{\"traceId\":\"' || {d.hex('user_id + 1', 16)} || '\",\"id\":\"' "
        f"|| {d.hex('event_id + 1', 16)} || '\",\"name\":\"' || event_type || '\"' || {own_times} "
        f"|| ',\"annotations\":[' || {notes} || '],\"binaryAnnotations\":[{{\"key\":\"k\",\"value\":\"' "
        f"|| {d.json_text('props', 'k')} || '\"}}' || {address} || ']}}]'"
    )


def v1_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [
        ("message_id", "cast(event_id as varchar(20))"), ("receipt_handle", "'r' || event_id"),
        ("transport", TRANSPORT), ("body", _v1_text(SPARK)),
        ("received_at", SPARK.timestamp("ts")),
    ]
    return _project(table(spark, sf_dir, "events"), columns)


# ---------------------------------------------------------------- headers


def header_columns(d) -> Columns:
    r1 = d.hex("1704067200 + c_custkey", 8)
    r2 = d.hex("c_custkey", 24, "a")
    p = d.hex("c_custkey", 16, "b")
    root = f"'Root=1-' || {r1} || '-' || {r2}"
    return [
        ("request_key", "c_custkey"),
        ("r1", r1), ("r2", r2), ("p", p),
        ("header",
         f"case c_custkey % 8 when 0 then {root} || ';Parent=' || {p} || ';Sampled=1' "
         f"when 1 then 'Sampled=0;Parent=' || {p} || ';' || {root} "
         f"when 2 then {root} || case when c_custkey % 3 = 0 then ';Root=1-abc' else '' end || ';Sampled=?' "
         f"when 3 then 'Robot=Hello;Self=1-65f0c2aa-0b1c2d3e4f5061728394a5b6;  ' || {root} "
         f"|| ';  CalledFrom=<segment>' "
         f"when 4 then 'Root=2-' || {r1} || '-' || {r2} "
         f"when 5 then 'Sampled=1;Root=1-' || {r1} || '-' || substr({r2}, 2) "
         f"when 6 then 'Root=1-' || upper({r1}) || '-' || {r2} || ';Sampled=0' end"),
    ]


def request_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "customer"), header_columns(SPARK))


HEADERS_SQL = _sql(header_columns(DUCK), "customer")

# Request logs carry the root of an existing trace, of an unknown one, or nothing usable.


def request_log_columns(d) -> Columns:
    order = d.hex("o_orderkey + 1", 24)
    return [
        ("request_id", "'q-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey"),
        ("header",
         f"case when l_linenumber = 1 then null "
         f"when l_linenumber = 2 then 'Root=1-00000001-' || {order} "
         f"when l_linenumber = 3 then 'Root=2-' || {d.hex(d.seconds('o_orderdate'), 8)} || '-' || {order} "
         f"else 'Root=1-' || {d.hex(d.seconds('o_orderdate'), 8)} || '-' || {order} || ';Sampled=1' end"),
    ]


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_join(spark, sf_dir, ITEM_JOIN[:2]), request_log_columns(SPARK))


REQUEST_LOGS_SQL = _sql(
    request_log_columns(DUCK), "lineitem join orders on l_orderkey = o_orderkey"
)

# ---------------------------------------------------------------- call and publish logs


def attempt_columns(d) -> Columns:
    started = d.micros("o_orderdate")
    sent = f"{started} + l_linenumber * 1000000 + l_partkey % 1000"
    unfinished = "o_orderkey % 19 = 0 and l_linenumber = 7"
    return [
        ("call_id", "cast(o_orderkey as varchar(20))"),
        ("attempt_no", "(l_linenumber * 1000000 + l_partkey) * 100000 + l_suppkey"),
        ("service", "'DynamoDb'"),
        ("request_class", "case when o_orderkey % 4 = 0 then 'Scan' else 'GetItemRequest' end"),
        ("trace_id", f"case when o_orderkey % 3 <> 0 then {_trace_id(d)} end"),
        ("parent_id", f"case when o_orderkey % 3 <> 0 then {d.hex('o_orderkey + 1', 16)} end"),
        ("request_rule",
         "case o_orderkey % 5 when 0 then true when 1 then false end"),
        ("send_ts", sent),
        ("recv_ts",
         f"case when not ({unfinished}) then {sent} + cast(round(l_quantity * 1000) as bigint) end"),
        ("status",
         f"case when not ({unfinished}) then case l_returnflag when 'N' then 200 when 'R' then 500 "
         f"else 400 end end"),
        ("request_id",
         "case when l_linestatus = 'F' then substr(md5(cast(l_partkey as varchar(20))), 1, 8) end"),
        # what the SDK handed over besides the status
        ("has_result", "l_linenumber % 3 <> 0"),
        ("header_request_id", "'h-' || l_suppkey"),
        ("error", "case when l_returnflag <> 'N' then 'failure ' || l_linenumber end"),
        ("error_message", "case when l_linenumber % 2 = 0 then 'slow down' end"),
        ("has_cause", "l_partkey % 7 = 0"),
        ("is_service_error", "l_returnflag = 'R'"),
    ]


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_join(spark, sf_dir, ITEM_JOIN[:2]), attempt_columns(SPARK))


def stream_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as a stream, against the orders table."""
    items = stream_table(spark, sf_dir, "lineitem")
    joined = items.join(table(spark, sf_dir, "orders"), F.expr("l_orderkey = o_orderkey"))
    return _project(joined, attempt_columns(SPARK))


ATTEMPTS_SQL = _sql(attempt_columns(DUCK), "lineitem join orders on l_orderkey = o_orderkey")


def publish_columns(d) -> Columns:
    r1 = d.hex(d.seconds("o_orderdate"), 8)
    return [
        ("batch_id", "cast(o_orderkey as varchar(20))"),
        ("entry_id", "l_linenumber || '-' || l_partkey || '-' || l_suppkey"),
        ("queue_url", "'https://queue.example/' || lower(c_mktsegment)"),
        ("batch_ts", d.micros("o_orderdate")),
        ("sent_ts", f"{d.micros('o_orderdate')} + l_linenumber * 1000"),
        ("local_service", "lower(c_mktsegment)"),
        ("header",
         f"case when o_orderkey % 2 = 0 then 'Root=1-' || {r1} || '-' "
         f"|| {d.hex('o_orderkey + 1', 24)} || case o_orderkey % 4 when 0 then ';Parent=' || "
         f"{d.hex('o_orderkey + 1', 16)} || ';Sampled=0;k=v' else '' end end"),
        ("tenant", "'tenant-' || (l_suppkey % 3)"),
        ("scope_trace_id",
         f"case when o_orderkey % 3 = 0 then {r1} || {d.hex('o_orderkey + 7', 24)} end"),
        ("scope_span_id", f"case when o_orderkey % 3 = 0 then {d.hex('o_orderkey + 9', 16)} end"),
    ]


PUBLISH_JOIN = ITEM_JOIN[:3]


def publishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = _project(_join(spark, sf_dir, PUBLISH_JOIN), publish_columns(SPARK))
    attributes = F.map_filter(
        F.create_map(F.lit("x-amzn-trace-id"), F.col("header"), F.lit("tenant"), F.col("tenant")),
        lambda _, v: v.isNotNull(),
    )
    scope = F.when(
        F.col("scope_trace_id").isNotNull(),
        F.struct(
            F.col("scope_trace_id").alias("trace_id"), F.col("scope_span_id").alias("span_id"),
            F.lit(True).alias("sampled"),
        ),
    )
    return flat.withColumn("attributes", attributes).withColumn("scope", scope).drop(
        "header", "tenant", "scope_trace_id", "scope_span_id"
    )


PUBLISHES_SQL = _sql(
    publish_columns(DUCK),
    "lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey",
)

# ---------------------------------------------------------------- host lists and URLs


def host_columns(d) -> Columns:
    mine = "'https://search-' || s_suppkey || '.' || lower(replace(n_name, '_', '-')) || '.es.amazonaws.com'"
    other = "'https://search-other.eu-west-1.es.amazonaws.com'"
    plain = "'https://localhost:9200'"
    return [
        ("host_key", "s_suppkey"),
        ("hosts",
         f"case s_suppkey % 8 when 0 then {mine} when 1 then {plain} "
         f"when 2 then {plain} || ',' || {mine} when 3 then {mine} || ',' || {plain} "
         f"when 4 then {mine} || ',' || {mine} when 5 then {mine} || ',' || {other} "
         f"when 6 then upper({mine}) end"),
    ]


HOST_JOIN = [("supplier", None), ("nation", "s_nationkey = n_nationkey")]


def host_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(_join(spark, sf_dir, HOST_JOIN), host_columns(SPARK))


HOSTS_SQL = _sql(host_columns(DUCK), "supplier join nation on s_nationkey = n_nationkey")


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTTP requests from parts: endpoint, path, parameters and multi-valued headers."""
    part = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    parameters = F.when(key % 3 == 0, F.create_map().cast("map<string,array<string>>")).otherwise(
        F.map_from_arrays(
            F.array(F.lit("brand"), F.when(key % 3 == 1, F.lit("size")).otherwise(F.lit(""))),
            F.array(
                F.array(F.col("p_brand"), F.lit("second")), F.array(F.col("p_size").cast("string"))
            ),
        )
    )
    headers = F.create_map(
        F.lit("x-request"),
        F.when(key % 4 == 0, F.array().cast("array<string>")).otherwise(
            F.array(F.col("p_type"), F.lit("later"))
        ),
    )
    return part.select(
        key.alias("part_key"),
        F.concat(F.lit("https://part-"), (key % 5).cast("string"), F.lit(".example")).alias("endpoint"),
        F.when(key % 2 == 0, F.concat(F.lit("/parts/"), key.cast("string"))).alias("path"),
        parameters.alias("parameters"),
        headers.alias("headers"),
        F.when(key % 6 != 0, F.col("p_size")).alias("status"),
        F.when(key % 5 == 0, F.lit("")).otherwise(F.col("p_name")).alias("setting"),
    )

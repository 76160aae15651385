"""Every operator and job as a query on the test tables, with its SQL twin.

Each entry takes ``(spark, sf_dir)`` and runs over whole tables. The SQL is
what DuckDB computes on the same Parquet files, under the same column names.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import operators as op
from .plans import jobs, loader
from .session import scratch_path
from .sources import decode_json
from .streaming import (
    FactLookup,
    FileSink,
    MemorySink,
    SampleSink,
    TableSink,
    merge_batches,
    start_pipeline,
    write_batch,
)
from .streaming.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- translate ---------------------------------------------------------------


@query(
    """select o.o_orderkey, o.o_custkey, c.c_mktsegment as segment
       from orders o left join customer c on o.o_custkey = c.c_custkey"""
)
def translate_lookup(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer")
    return op.translate(orders, "o_custkey", "segment", customer, "c_custkey", "c_mktsegment")


@query(
    """select c.c_custkey, c.c_nationkey, n.n_name as nation
       from customer c left join (
         select n_nationkey, n_name from nation join region on n_regionkey = r_regionkey
         where r_name in ('AFRICA', 'AMERICA')
       ) n on c.c_nationkey = n.n_nationkey"""
)
def translate_miss(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    region = table(spark, sf_dir, "region").where(F.col("r_name").isin("AFRICA", "AMERICA"))
    nation = table(spark, sf_dir, "nation")
    lookup = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return op.translate(customer, "c_nationkey", "nation", lookup, "n_nationkey", "n_name")


@query(
    """select c.c_custkey, l.alias as c_mktsegment
       from customer c left join (
         select c_mktsegment, min(c_name) as alias from customer
         where c_mktsegment <> 'BUILDING' group by c_mktsegment
       ) l on c.c_mktsegment = l.c_mktsegment"""
)
def translate_overwrite(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    lookup = (
        customer.where("c_mktsegment <> 'BUILDING'")
        .groupBy("c_mktsegment")
        .agg(F.min("c_name").alias("alias"))
    )
    records = customer.select("c_custkey", "c_mktsegment")
    return op.translate(
        records, "c_mktsegment", "c_mktsegment", lookup, "c_mktsegment", "alias"
    )


@query(
    """select l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderpriority as priority
       from lineitem l left join orders o on l.l_orderkey = o.o_orderkey"""
)
def translate_large_lookup(spark, sf_dir):
    """A lookup past the broadcast limit: spread over salts and shuffled."""
    lineitem = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = table(spark, sf_dir, "orders")
    return op.translate(
        lineitem,
        "l_orderkey",
        "priority",
        orders,
        "o_orderkey",
        "o_orderpriority",
        on_duplicate_key="error",
        broadcast_limit=0,
    )


_HOT_SQL = """
    select l_orderkey, l_linenumber, o_orderpriority as priority
    from (select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then 1 when l_linenumber % 3 = 1 then l_orderkey end as k
          from lineitem) l left join orders o on l.k = o.o_orderkey"""


def _hot_lines(lineitem: DataFrame) -> DataFrame:
    """Lines of which a third have one key and a third have none."""
    rest = F.col("l_linenumber") % 3
    key = F.when(rest == 0, F.lit(1).cast("long")).when(rest == 1, F.col("l_orderkey"))
    return lineitem.select("l_orderkey", "l_linenumber", key.alias("k"))


@query(_HOT_SQL)
def translate_hot_key(spark, sf_dir):
    """A lookup past the broadcast limit, pinned: a sketch finds the hot key, its row is broadcast."""
    lookup = op.prepare_lookup(
        table(spark, sf_dir, "orders"), "o_orderkey", "o_orderpriority", broadcast_limit=0, cache=True, mark_first=False
    )
    lines = _hot_lines(table(spark, sf_dir, "lineitem"))
    return op.translate(lines, "k", "priority", lookup).drop("k")


@query(_HOT_SQL)
def stream_hot_key(spark, sf_dir):
    """The same in a stream: every micro-batch is joined as a batch, with hot keys of its own."""
    lookup = op.prepare_lookup(
        table(spark, sf_dir, "orders"), "o_orderkey", "o_orderpriority", broadcast_limit=0, cache=True, salts=1
    )
    step = op.translate_step("k", "priority", lookup, "orders", "o_orderkey", "o_orderpriority")
    schema = table(spark, sf_dir, "lineitem").schema
    records = _hot_lines(spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem.parq*"))
    audited = op.apply_audited(records, [step], "l_orderkey", "p")
    root = scratch_path(spark, "hot-stream")
    data, trail = op.split_audit(audited, "l_orderkey")
    sinks = TableSink(f"{root}/data", data.schema), FileSink(f"{root}/audit", trail.schema)
    run = start_pipeline(
        audited, "l_orderkey", *sinks, f"{root}/checkpoint", "hot-key", available_now=True,
        records=records, prepare=lambda batch: op.apply_audited(batch, [step], "l_orderkey", "p"),
    )
    run.await_termination()
    lookup.close()
    return sinks[0].read(spark).drop("k")


@query(
    """select o.o_orderkey, l.l_partkey as part
       from orders o left join lineitem l on o.o_orderkey = l.l_orderkey"""
)
def translate_fanout(spark, sf_dir):
    """A lookup with several rows per key, past the broadcast limit."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    lineitem = table(spark, sf_dir, "lineitem")
    return op.translate(
        orders, "o_orderkey", "part", lineitem, "l_orderkey", "l_partkey", broadcast_limit=0
    )


# --- redact ------------------------------------------------------------------


@query(
    """select c_custkey, 'XXXXX' as c_name, c_nationkey, c_acctbal, c_mktsegment
       from customer"""
)
def redact_in_place(spark, sf_dir):
    return op.redact(table(spark, sf_dir, "customer"), "c_name", "c_name", "XXXXX")


@query(
    """select c_custkey, c_nationkey, c_acctbal, c_mktsegment, 'hidden' as c_alias
       from customer"""
)
def redact_move(spark, sf_dir):
    return op.redact(table(spark, sf_dir, "customer"), "c_name", "c_alias", "hidden")


@query("select conv_id, turn, role, '[removed]' as text from conversations")
def redact_text(spark, sf_dir):
    """A constant for a whole text: the text is not even read."""
    return op.redact(table(spark, sf_dir, "conversations"), "text", "text", "[removed]")


# --- split_pick --------------------------------------------------------------


@query("select o_orderkey, string_split(o_orderpriority, '-')[1] as o_orderpriority from orders")
def split_pick_first(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return op.split_pick(orders, "o_orderpriority", "o_orderpriority", "-", 0)


@query("select o_orderkey, string_split(o_orderpriority, ' ')[2] as word from orders")
def split_pick_nth(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return op.split_pick(orders, "o_orderpriority", "word", " ", 1).drop("o_orderpriority")


@query(
    """select o_orderkey, string_split_regex(o_orderpriority, '[- ]')[2] as word from orders"""
)
def split_pick_regex(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return op.split_pick(orders, "o_orderpriority", "word", "[- ]", 1).drop("o_orderpriority")


@query("select page_id, string_split(url, '/')[3] as host from pages")
def split_pick_host(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return op.split_pick(pages, "url", "host", "/", 2).drop("url")


@query(
    """select doc_id, string_split(text, chr(10))[1] as head,
              string_split(text, chr(10))[3] as third from documents"""
)
def split_pick_lines(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    heads = op.split_pick(documents, "text", "head", "\n", 0)
    return op.split_pick(heads, "text", "third", "\n", 2).drop("text")


# --- audited pipelines ---------------------------------------------------------

PIPELINE = "order_pseudonymiser"


def order_steps(spark: SparkSession, sf_dir: str, cache: bool = False) -> list[op.Step]:
    """The flagship pipeline: translate, redact, split-and-pick on orders."""
    lookup = op.prepare_lookup(
        table(spark, sf_dir, "customer"), "c_custkey", "c_mktsegment", cache=cache
    )
    return [
        op.translate_step(
            "o_custkey", "segment", lookup, "customer", "c_custkey", "c_mktsegment"
        ),
        op.redact_step("o_orderstatus", "o_orderstatus", "XXXXX"),
        op.split_pick_step("o_orderpriority", "o_orderpriority", "-", 0),
    ]


def audited_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.apply_audited(
        table(spark, sf_dir, "orders"), order_steps(spark, sf_dir), "o_orderkey", PIPELINE
    )


# What the tags of the flagship pipeline look like.
TAGS = (
    "segment#1 = order_pseudonymiser.translate(o_custkey#0, fixture='customer',"
    " key_column='c_custkey', value_column='c_mktsegment')",
    "o_orderstatus#2 = order_pseudonymiser.redact(o_orderstatus#1, replace_with='XXXXX')",
    "o_orderpriority#3 = order_pseudonymiser.split_pick(o_orderpriority#2, split_by='-',"
    " pick_index=0)",
)


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_DATA_SQL = """
    select o.o_orderkey, o.o_custkey, 'XXXXX' as o_orderstatus, o.o_totalprice, o.o_orderdate,
           string_split(o.o_orderpriority, '-')[1] as o_orderpriority,
           c.c_mktsegment as segment
    from orders o left join customer c on o.o_custkey = c.c_custkey"""

_AUDIT_SQL = f"""
    select o.o_orderkey, cast(null as varchar) as old_value, c.c_mktsegment as new_value,
           {_sql_text(TAGS[0])} as transform_tag
    from orders o left join customer c on o.o_custkey = c.c_custkey
    union all
    select o_orderkey, o_orderstatus, 'XXXXX', {_sql_text(TAGS[1])} from orders
    union all
    select o_orderkey, o_orderpriority, string_split(o_orderpriority, '-')[1],
           {_sql_text(TAGS[2])} from orders"""


@query(_DATA_SQL)
def pseudonymise_orders(spark, sf_dir):
    return op.split_audit(audited_orders(spark, sf_dir), "o_orderkey")[0]


@query(_AUDIT_SQL)
def audit_chain(spark, sf_dir):
    return op.split_audit(audited_orders(spark, sf_dir), "o_orderkey")[1]


@query(
    """select c.c_custkey, cast(null as varchar) as old_value, n.n_name as new_value,
         'nation#1 = p.translate(c_nationkey#0, fixture=''nation'', key_column=''n_nationkey'','
         || ' value_column=''n_name'')' as transform_tag
       from customer c left join nation n on c.c_nationkey = n.n_nationkey"""
)
def audit_translate(spark, sf_dir):
    lookup = op.prepare_lookup(table(spark, sf_dir, "nation"), "n_nationkey", "n_name")
    step = op.translate_step(
        "c_nationkey", "nation", lookup, "nation", "n_nationkey", "n_name"
    )
    audited = op.apply_audited(table(spark, sf_dir, "customer"), [step], "c_custkey", "p")
    return op.split_audit(audited, "c_custkey")[1]


@query(
    """select o_orderkey, o_orderpriority as old_value,
         string_split(o_orderpriority, '-')[2] as new_value,
         'o_orderpriority#1 = p.split_pick(o_orderpriority#0, split_by=''-'', pick_index=1)'
           as transform_tag
       from orders
       union all
       select o_orderkey, string_split(o_orderpriority, '-')[2],
         string_split(string_split(o_orderpriority, '-')[2], ' ')[1],
         'o_orderpriority#2 = p.split_pick(o_orderpriority#1, split_by='' '', pick_index=0)'
       from orders"""
)
def audit_step_order(spark, sf_dir):
    """Two steps on one column: the second overwrites what the first made."""
    steps = [
        op.split_pick_step("o_orderpriority", "o_orderpriority", "-", 1),
        op.split_pick_step("o_orderpriority", "o_orderpriority", " ", 0),
    ]
    audited = op.apply_audited(table(spark, sf_dir, "orders"), steps, "o_orderkey", "p")
    return op.split_audit(audited, "o_orderkey")[1]


_FANOUT_SQL = """
    select o_orderkey, o_orderstatus as old_value, 'X' as new_value,
      'o_orderstatus#1 = p.redact(o_orderstatus#0, replace_with=''X'')' as transform_tag
    from orders
    union all
    select o.o_orderkey, cast(null as varchar), cast(l.l_partkey as varchar),
      'part#2 = p.translate(o_orderkey#1, fixture=''lineitem'', key_column=''l_orderkey'','
      || ' value_column=''l_partkey'')'
    from orders o left join lineitem l on o.o_orderkey = l.l_orderkey
    union all
    select o.o_orderkey, o.o_orderpriority, string_split(o.o_orderpriority, '-')[1],
      'o_orderpriority#3 = p.split_pick(o_orderpriority#2, split_by=''-'', pick_index=0)'
    from orders o left join lineitem l on o.o_orderkey = l.l_orderkey"""


@query(_FANOUT_SQL)
def audit_fanout(spark, sf_dir):
    """Steps before a lookup with several rows per key are audited once per
    record, that lookup and later steps once per copy."""
    return _audit_fanout(spark, sf_dir, broadcast_limit=0)


@query(_FANOUT_SQL)
def audit_fanout_by_size(spark, sf_dir):
    """The same, with the join chosen by the lookup's measured size."""
    return _audit_fanout(spark, sf_dir)


@query(_FANOUT_SQL)
def audit_fanout_chunked(spark, sf_dir):
    """The same, as if most keys had more lookup rows than one task should get."""
    return _audit_fanout(spark, sf_dir, broadcast_limit=0, group_rows=3)


def _audit_fanout(spark, sf_dir, **options):
    lookup = op.prepare_lookup(
        table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey", **options
    )
    steps = [
        op.redact_step("o_orderstatus", "o_orderstatus", "X"),
        op.translate_step("o_orderkey", "part", lookup, "lineitem", "l_orderkey", "l_partkey"),
        op.split_pick_step("o_orderpriority", "o_orderpriority", "-", 0),
    ]
    audited = op.apply_audited(table(spark, sf_dir, "orders"), steps, "o_orderkey", "p")
    return op.split_audit(audited, "o_orderkey")[1]


# --- decoding ------------------------------------------------------------------

_EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def _envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(_whole_envelope().alias("value"))


def _whole_envelope() -> Column:
    # Spark writes milliseconds unless it is told otherwise.
    micros = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    return F.to_json(F.struct(*_EVENT.fieldNames()), micros)


def _faulty_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of one kind are cut off, those of another have a text for a number."""
    events = table(spark, sf_dir, "events")
    whole = _whole_envelope()
    mistyped = F.to_json(
        F.struct(
            "event_id",
            F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("user_id"),
            "event_type",
        )
    )
    cut = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"))
    return events.select(
        F.when(F.col("event_type") == "error", cut)
        .when(F.col("event_type") == "click", mistyped)
        .otherwise(whole)
        .alias("value")
    )


@query("select event_id, ts, user_id, event_type, value, props from events")
def json_envelope_decode(spark, sf_dir):
    return decode_json(_envelopes(spark, sf_dir), _EVENT)


@query("select cast(json_extract(props, '$.k') as integer) as k from events")
def json_props_decode(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return decode_json(table(spark, sf_dir, "events"), schema, "props")


@query(
    """select case when event_type <> 'error' then event_id end as event_id,
              case when event_type not in ('error', 'click') then user_id end as user_id,
              case when event_type <> 'error' then event_type end as event_type,
              case when event_type not in ('error', 'click') then ts end as ts,
              case when event_type not in ('error', 'click') then value end as value,
              case when event_type not in ('error', 'click') then props end as props
       from events"""
)
def json_malformed_keep(spark, sf_dir):
    faulty = _faulty_envelopes(spark, sf_dir)
    return decode_json(faulty, _EVENT)


@query(
    """select event_id, ts, user_id, event_type, value, props from events
       where event_type not in ('error', 'click')"""
)
def json_quarantine_good(spark, sf_dir):
    return decode_json(_faulty_envelopes(spark, sf_dir), _EVENT, on_malformed="quarantine")[0]


@query(
    """select case when event_type = 'error' then '{"event_id": ' || event_id
         else '{"event_id":' || event_id || ',"user_id":"user ' || user_id
              || '","event_type":"click"}' end as value
       from events where event_type in ('error', 'click')"""
)
def json_quarantine_bad(spark, sf_dir):
    return decode_json(_faulty_envelopes(spark, sf_dir), _EVENT, on_malformed="quarantine")[1]


# --- the loader ------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "lines")
    _faulty_envelopes(spark, sf_dir).write.text(path)
    return path


@query(
    """select cast(event_id as varchar) as key, event_id, ts, user_id, event_type, value, props
       from events where event_type not in ('error', 'click')"""
)
def loader_validate(spark, sf_dir):
    good, _ = loader.load_records(spark, _lines(spark, sf_dir), _EVENT, "event_id")
    return good.select("key", F.from_json("value", _EVENT).alias("r")).select("key", "r.*")


@query(
    """select case when event_type = 'error' then '{"event_id": ' || event_id
         else '{"event_id":' || event_id || ',"user_id":"user ' || user_id
              || '","event_type":"click"}' end as value
       from events where event_type in ('error', 'click')"""
)
def loader_rejected(spark, sf_dir):
    _, bad = loader.load_records(spark, _lines(spark, sf_dir), _EVENT, "event_id")
    return bad.select("value")


@query(
    """select event_id, ts, user_id, event_type, value, 'XXXXX' as props from events
       where event_type not in ('error', 'click')"""
)
def stream_loaded_records(spark, sf_dir):
    """Loader to folder, folder to stream, stream to table."""
    good, _ = loader.load_records(spark, _lines(spark, sf_dir), _EVENT, "event_id")
    folder = scratch_path(spark, "topic")
    loader.write_folder(good, folder)
    records = decode_json(spark.readStream.text(folder), _EVENT)
    audited = op.apply_audited(
        records, [op.redact_step("props", "props", "XXXXX")], "event_id", "p"
    )
    return _stream(audited, "event_id")[0].read(spark)


# --- streams -----------------------------------------------------------------------


def _stream(audited: DataFrame, primary: str, memory: bool = False):
    """Run an audited stream until its source is used up; returns both sinks."""
    spark = audited.sparkSession
    root = scratch_path(spark, "stream")
    data, trail = op.split_audit(audited, primary)
    if memory:
        sinks = [MemorySink("records_now", schema=data.schema)]
        sinks.append(MemorySink("audit_now", schema=trail.schema))
    else:
        sinks = [TableSink(f"{root}/data", data.schema)]
        sinks.append(FileSink(f"{root}/audit", trail.schema))
    run = start_pipeline(
        audited, primary, *sinks, f"{root}/checkpoint", PIPELINE, available_now=True
    )
    run.await_termination()
    return sinks


def _order_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "orders").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/orders.parq*")
    return op.apply_audited(stream, order_steps(spark, sf_dir), "o_orderkey", PIPELINE)


@query(_DATA_SQL)
def stream_pseudonymise(spark, sf_dir):
    return _stream(_order_stream(spark, sf_dir), "o_orderkey")[0].read(spark)


@query(_AUDIT_SQL)
def stream_audit(spark, sf_dir):
    return _stream(_order_stream(spark, sf_dir), "o_orderkey")[1].read(spark)


@query(_DATA_SQL)
def stream_memory_snapshot(spark, sf_dir):
    return _stream(_order_stream(spark, sf_dir), "o_orderkey", memory=True)[0].snapshot(spark)


@query(_DATA_SQL)
def stream_replay(spark, sf_dir):
    """The same batch written twice leaves the table as after the first time."""
    data = pseudonymise_orders(spark, sf_dir)
    path = scratch_path(spark, "replay")
    for _ in range(2):
        write_batch(data, path, "query", 0)
    return read_table(spark, path, data.schema)


@query("select 0 as batch_id, count(*) as n, 1 as stamps from orders")
def batch_metadata(spark, sf_dir):
    """Each row carries its batch number and one time of writing per batch."""
    data = table(spark, sf_dir, "orders")
    declared = T.StructType(
        [
            T.StructField("batch_id", T.IntegerType()),
            T.StructField("inserted_at", T.TimestampType()),
            *data.schema.fields,
        ]
    )
    sink = TableSink(scratch_path(spark, "stamped"), declared, partition_on="inserted_at")
    sink.write(data, "query", 0)
    stamps = sink.read(spark).groupBy("batch_id", "inserted_at").agg(F.count("*").alias("n"))
    return stamps.groupBy("batch_id").agg(
        F.sum("n").alias("n"), F.count("*").cast("int").alias("stamps")
    )


# --- a specification, end to end ------------------------------------------------

SPEC = str(Path(__file__).parent / "examples" / "orders.yml")


def _spec_env(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    root = scratch_path(spark, "spec")
    return {
        "ORDER_SOURCE": f"{sf_dir}/orders.parq*",
        "CUSTOMER_SEGMENT": f"{sf_dir}/customer.parquet",
        "ORDER_PSEUDO": f"{root}/data",
        "ORDER_AUDIT": f"{root}/audit",
        "CHECKPOINT": f"{root}/checkpoint",
    }


@query(_DATA_SQL)
def spec_batch_records(spark, sf_dir):
    from .plans.pipeline import run_batch
    from .spec import Store

    plan = run_batch(spark, Store.load(filepath=SPEC), PIPELINE, _spec_env(spark, sf_dir))
    return plan.data_sink.read(spark).drop("batch_id", "inserted_at")


@query(_AUDIT_SQL)
def spec_stream_audit(spark, sf_dir):
    from .plans.pipeline import run_stream
    from .spec import Store

    env = _spec_env(spark, sf_dir)
    run = run_stream(
        spark, Store.load(filepath=SPEC), PIPELINE, env, available_now=True, checkpoint=env["CHECKPOINT"]
    )
    run.await_termination()
    return run.audit_sink.read(spark)


@query(_DATA_SQL)
def command_line_run(spark, sf_dir):
    """The command line on a specification and files that only the environment names."""
    import os
    from unittest import mock

    from .__main__ import main
    from .plans.pipeline import build
    from .spec import Store

    env = _spec_env(spark, sf_dir)
    names = ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
             "spark.sql.adaptive.coalescePartitions.enabled", "spark.app.name")
    before = {n: spark.conf.get(n) for n in names}
    try:
        with mock.patch.dict(os.environ, env | {"METASTORE_FILEPATH": SPEC}):
            main([])  # only checks: nothing is written
            main(["-r", PIPELINE, "--available-now", "--checkpoint", env["CHECKPOINT"]])
            plan = build(spark, Store.load(), PIPELINE, streaming=False)
    finally:
        for name, value in before.items():
            if spark.conf.isModifiable(name):
                spark.conf.set(name, value)
    plan.close()
    return plan.data_sink.read(spark).drop("batch_id", "inserted_at")


_REFUSED = {
    "column": {"transforms": [{"transform_type": "redact", "source_column": "o_none", "destination_column": "x", "replace_with": ""}]},
    "primary": {"transforms": [{"transform_type": "redact", "source_column": "o_orderkey", "destination_column": "x", "replace_with": ""}]},
    "key": {"colour": "red"},
    "schema": {"source": {"source_type": "file", "filepath_env": "ORDER_SOURCE", "source_schema": "none", "format": "parquet"}},
    "table": {"sink": {"sink_type": "deltalake", "connector_id": "lake", "table": "none", "trigger_seconds": 60}},
}


@query(
    f"select d.*, r.refused from ({_DATA_SQL}) d,"
    f" (select '{','.join(sorted(_REFUSED))}' as refused) r"
)
def spec_refusals(spark, sf_dir):
    """The example runs; with one column, key or name that does not resolve it is refused."""
    import yaml
    from pydantic import ValidationError

    from .plans.pipeline import run_batch
    from .spec import Store

    text = Path(SPEC).read_text(encoding="utf-8")
    refused = []
    for name, change in _REFUSED.items():
        declared = yaml.safe_load(text)
        declared["pipelines"][0] |= change
        try:
            Store.model_validate(declared)
        except ValidationError:
            refused.append(name)
    plan = run_batch(spark, Store.parse(text), PIPELINE, _spec_env(spark, sf_dir))
    rows = plan.data_sink.read(spark).drop("batch_id", "inserted_at")
    return rows.withColumn("refused", F.lit(",".join(sorted(refused))))


@query(f"select a.*, 2 as plans, 1 as reads_customer from ({_AUDIT_SQL}) a")
def explained_audit(spark, sf_dir):
    """The plans of records and trail are shown before the run; the trail itself."""
    import contextlib
    import io

    from .plans.pipeline import explain, run_batch
    from .spec import Store

    env, store, shown = _spec_env(spark, sf_dir), Store.load(filepath=SPEC), io.StringIO()
    with contextlib.redirect_stdout(shown):
        explain(spark, store, PIPELINE, env, streaming=False)
    plans = shown.getvalue().count("== Physical Plan ==")
    reads = int("c_mktsegment" in shown.getvalue())
    trail = run_batch(spark, store, PIPELINE, env).audit_sink.read(spark)
    return trail.withColumns({"plans": F.lit(plans), "reads_customer": F.lit(reads)})


# --- upsert ----------------------------------------------------------------------


@query(
    """select s_suppkey, s_name, s_nationkey, s_acctbal from supplier s
       where not exists (select 1 from customer c where c.c_custkey = s.s_suppkey
                         and c.c_mktsegment <> 'BUILDING')
       union all
       select c_custkey, c_name, c_nationkey, c_acctbal from customer
       where c_mktsegment <> 'BUILDING'"""
)
def upsert_by_key(spark, sf_dir):
    arriving = (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment <> 'BUILDING'")
        .select(
            F.col("c_custkey").alias("s_suppkey"),
            F.col("c_name").alias("s_name"),
            F.col("c_nationkey").alias("s_nationkey"),
            F.col("c_acctbal").alias("s_acctbal"),
        )
    )
    return op.upsert(table(spark, sf_dir, "supplier"), arriving, ["s_suppkey"])


# --- aggregates --------------------------------------------------------------------


@query(
    """with n as (select o_custkey, o_orderpriority, count(*) as n from orders group by all)
       select o_custkey, o_orderpriority from n
       qualify row_number() over (partition by o_custkey
                                  order by n desc, o_orderpriority) = 1"""
)
def most_common_value(spark, sf_dir):
    return op.most_common(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query(
    """with peak as (
         select p_type, p_name, max(p_retailprice) as peak from part
         where p_type in ('ECONOMY', 'SMALL', 'LARGE') group by all)
       select p_type, p_name, peak from peak
       qualify row_number() over (partition by p_type order by peak, p_name)
         <= case p_type when 'ECONOMY' then 10 when 'SMALL' then 5 else 20 end"""
)
def rarest_per_group(spark, sf_dir):
    return op.n_rarest(
        table(spark, sf_dir, "part"),
        "p_type",
        "p_name",
        "p_retailprice",
        {"ECONOMY": 10, "SMALL": 5, "LARGE": 20},
    )


# --- samples and row numbers --------------------------------------------------------


def _sql_draw(seed: str, key: str) -> str:
    """The number a sample draws for a key, as DuckDB computes it."""
    digits = f"substr(md5(concat_ws(':', {_sql_text(seed)}, {key})), 1, 13)"
    return f"((('0x' || {digits})::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)"


@query(f"select * from orders order by {_sql_draw('7', 'o_orderkey')}, o_orderkey limit 500")
def uniform_sample(spark, sf_dir):
    return op.sample_uniform(table(spark, sf_dir, "orders"), 500, "o_orderkey", 7, "md5")


@query(
    f"""select p_partkey, p_name, p_size from part where p_size > 0
        order by -ln({_sql_draw('7', 'p_partkey')}) / p_size, p_partkey limit 100"""
)
def weighted_sample(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    return op.sample_weighted(part, 100, "p_partkey", "p_size", 7, "md5")


@query(
    f"""select * from customer order by {_sql_draw('11', 'c_custkey')}, c_custkey limit 30"""
)
def preview(spark, sf_dir):
    return op.preview(table(spark, sf_dir, "customer"), 30, 11, "c_custkey", "md5")


@query(
    """select o_orderkey, row_number() over (order by o_orderdate, o_orderkey) - 1 as row_id
       from orders"""
)
def row_id(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return op.row_id(orders, "o_orderdate", "o_orderkey").select("o_orderkey", "row_id")


@query(
    """select row_id, c_custkey, p_partkey from
         (select c_custkey, row_number() over (order by c_acctbal, c_custkey) - 1 as row_id
          from customer)
         join
         (select p_partkey, row_number() over (order by p_name, p_partkey) - 1 as row_id
          from part) using (row_id)"""
)
def zip_rows(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    zipped = op.zip_rows(customer, part, ["c_acctbal", "c_custkey"], ["p_name", "p_partkey"])
    return zipped.select("row_id", "c_custkey", "p_partkey")


# --- batch jobs ------------------------------------------------------------------------


@query(
    """select replace(p_name, ' ring', '') as disease,
              case when p_brand = 'Brand#1' then 1
                   else cast(replace(p_brand, 'Brand#', '') as bigint) end as usage
       from part where p_name like '%ring'"""
)
def code_frequency(spark, sf_dir):
    """Part names as descriptions, brand numbers as usage, one of them starred."""
    number = F.regexp_replace("p_brand", "Brand#", "")
    codes = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("Description"),
        F.when(F.col("p_brand") == "Brand#1", F.lit("*")).otherwise(number).alias("Usage"),
    )
    return jobs.code_frequency(codes, marker="ring")


def _places(spark: SparkSession, sf_dir: str):
    """Orders as postcodes, customers as cities, nations as regions."""
    orders = table(spark, sf_dir, "orders")
    postcodes = orders.select(
        F.col("o_orderpriority").alias("ctry"),
        F.col("o_orderkey").cast("string").alias("pcds"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("doterm"),
        F.month("o_orderdate").alias("rgn"),
        F.col("o_custkey").alias("ttwa"),
    )
    cities = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("TTWA11CD"), F.col("c_name").alias("TTWA11NM")
    )
    regions = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("RGN20CD"),
        F.concat(F.lit("(pseudo) "), "n_name").alias("RGN20NM"),
    )
    return jobs.place_dimensions(postcodes, cities, regions, ("1-URGENT", "5-LOW"))


@query(
    """with placed as (
         select c.c_name as city, n.n_name as region
         from orders o left join customer c on o.o_custkey = c.c_custkey
         left join nation n on month(o.o_orderdate) = n.n_nationkey
         where o.o_orderpriority in ('1-URGENT', '5-LOW')),
       counted as (select city, region, count(*) as n from placed
                   where city is not null group by all)
       select city, region from counted
       qualify row_number() over (partition by city order by n desc, region) = 1"""
)
def place_city_region(spark, sf_dir):
    return _places(spark, sf_dir)[0]


@query(
    """select cast(o.o_orderkey as varchar) as postcode, c.c_name as city
       from orders o left join customer c on o.o_custkey = c.c_custkey
       where o.o_orderpriority in ('1-URGENT', '5-LOW') and o.o_orderstatus <> 'F'"""
)
def place_postcode_city(spark, sf_dir):
    return _places(spark, sf_dir)[1]


@query(
    """with peak as (
         select p_type, p_name, max(p_retailprice) as peak from part
         where p_type in ('ECONOMY', 'SMALL') group by all)
       select p_name as forename from peak
       qualify row_number() over (partition by p_type order by peak, p_name)
         <= case p_type when 'ECONOMY' then 8 else 7 end"""
)
def rare_names(spark, sf_dir):
    sex = F.when(F.col("p_type") == "ECONOMY", "boy").when(F.col("p_type") == "SMALL", "girl")
    names = table(spark, sf_dir, "part").select(
        sex.alias("sex"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("percent")
    )
    return jobs.rare_names(names, 15)


def _sql_numbered(name: str, rows: str, key: str, draw: str, n: int, order_seed: str) -> str:
    """A sample of rows, numbered in the order a job puts samples side by side."""
    return f"""
        {name}_drawn as (select * from {rows} order by {draw}, {key} limit {n}),
        {name} as (select *, row_number() over (
            order by md5(concat_ws(':', {_sql_text(order_seed)}, {key}))) - 1 as i
          from {name}_drawn)"""


@query(
    f"""with words as (
          select distinct unnest(string_split(text, ' ')) as noun from documents),
        plain as (select noun from words where not contains(noun, '-')
          and not contains(noun, '_') and lower(noun) = noun),
        {_sql_numbered('a', 'plain', 'noun', _sql_draw('5:first', 'noun'), 40, '5:first')},
        {_sql_numbered('b', 'plain', 'noun', _sql_draw('5:second', 'noun'), 40, '5:second')}
        select case when a.noun[1] = 'ß' then 'Ss' else upper(a.noun[1]) end || substr(a.noun, 2)
               || '-' || case when b.noun[1] = 'ß' then 'Ss' else upper(b.noun[1]) end
               || substr(b.noun, 2) as surname
        from a join b on a.i = b.i"""
)
def compound_names(spark, sf_dir):
    """The words of all documents as the table of nouns."""
    words = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", " ")).alias("noun")
    )
    nouns = words.distinct()
    # Four passes read the nouns, so they are a table and not a plan.
    path = scratch_path(spark, "nouns")
    jobs.write_parquet(nouns, path)
    return jobs.compound_names(spark.read.parquet(path), "noun", 40, 5, algorithm="md5")


@query(
    f"""with diseases as (select p_name as disease, sum(p_size) as usage from part group by all),
        places as (select cast(o_orderkey as varchar) as postcode, o_orderpriority as city
                   from orders),
        {_sql_numbered('f', 'customer', 'c_name', _sql_draw('3:forename:draw', 'c_name'), 60, '3:forename')},
        {_sql_numbered('s', 'part', 'p_partkey', _sql_draw('3:surname:draw', 'p_partkey'), 60, '3:surname')},
        {_sql_numbered('p', 'places', 'postcode', _sql_draw('3:postcode:draw', 'postcode'), 60,
                       '3:postcode')},
        {_sql_numbered('d', 'diseases', 'disease',
                       '-ln(' + _sql_draw('3:disease:draw', 'disease') + ') / usage', 60, '3:disease')}
        select cast(f.i as integer) as patient_id, f.c_name || ' ' || s.p_partkey as patient_name,
               p.city, p.postcode, d.disease
        from f join s on f.i = s.i join p on f.i = p.i join d on f.i = d.i"""
)
def assemble_records(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return jobs.assemble_records(
        table(spark, sf_dir, "customer").select(F.col("c_name").alias("forename")),
        part.select(F.col("p_partkey").cast("string").alias("surname")),
        table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").cast("string").alias("postcode"),
            F.col("o_orderpriority").alias("city"),
        ),
        part.groupBy(F.col("p_name").alias("disease")).agg(F.sum("p_size").alias("usage")),
        60,
        3,
        algorithm="md5",
    )


@query(
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
              case when o_orderstatus <> 'F' then o_orderpriority end as open_priority
       from orders"""
)
def ndjson_roundtrip(spark, sf_dir):
    """Records written one per line, nulls included, and read back as declared."""
    orders = table(spark, sf_dir, "orders")
    open_priority = F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority"))
    records = orders.withColumn("open_priority", open_priority)
    path = scratch_path(spark, "ndjson")
    jobs.write_ndjson(records, path)
    return decode_json(spark.read.text(path), records.schema)


@query("select c_custkey, c_name, c_mktsegment from customer")
def csv_columns(spark, sf_dir):
    """A CSV scan of some of the columns."""
    path = scratch_path(spark, "customer") + ".csv"
    table(spark, sf_dir, "customer").write.option("header", "true").csv(path)
    columns = jobs.read_any(spark, path).select("c_custkey", "c_name", "c_mktsegment")
    return columns.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@query(
    """select 'source' as side, count(*) as n from orders
       union all select 'records', count(*) from orders
       union all select 'audit', 3 * count(*) from orders"""
)
def viewer_counts(spark, sf_dir):
    """Row counts of source, records and audit trail after a run."""
    from .plans.pipeline import run_batch
    from .spec import Store

    plan = run_batch(spark, Store.load(filepath=SPEC), PIPELINE, _spec_env(spark, sf_dir))
    sides = {
        "source": table(spark, sf_dir, "orders"),
        "records": plan.data_sink.read(spark),
        "audit": plan.audit_sink.read(spark),
    }
    counts = [df.agg(F.lit(s).alias("side"), F.count("*").alias("n")) for s, df in sides.items()]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


# --- what pipelines, loaders and sinks do beside the usual run ----------------------

_BAD_SQL = """select case when event_type = 'error' then '{"event_id": ' || event_id
         else '{"event_id":' || event_id || ',"user_id":"user ' || user_id
              || '","event_type":"click"}' end as value
       from events where event_type in ('error', 'click')"""


def _event_store(source: dict, sink: dict, audit: dict, loader_quarantine: bool = False):
    """A specification over the events: one transformer and one loader."""
    from .spec import Store

    kinds = {"event_id": "long", "ts": "timestamp_ntz", "user_id": "long", "event_type": "string"}
    fields = kinds | {"value": "double", "props": "string"}
    redact = {
        "transform_type": "redact",
        "source_column": "props",
        "destination_column": "props",
        "replace_with": "XXXXX",
    }
    loaded = {
        "id": "loader",
        "pipeline_type": "kafka_producer",
        "source_filepath_env": "LINES",
        "sink_topic": "bus.events",
    }
    if loader_quarantine:
        loaded["quarantine_filepath_env"] = "QUARANTINE"
    return Store.model_validate(
        {
            "schemas": [{"name": "event", "primary_field": "event_id", "fields": fields}],
            "connectors": [
                {
                    "id": "bus",
                    "connector_type": "kafka",
                    "broker_env": "BROKERS",
                    "topics": [{"topic_name": "events", "topic_schema": "event"}],
                }
            ],
            "pipelines": [
                {
                    "id": "events",
                    "pipeline_type": "transformer",
                    "source": {
                        "source_type": "file",
                        "filepath_env": "LINES",
                        "source_schema": "event",
                        "format": "json",
                        **source,
                    },
                    "sink": sink,
                    "audit": audit,
                    "transforms": [redact],
                },
                loaded,
            ],
        }
    )


def _event_env(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    root = scratch_path(spark, "events")
    names = {"DATA": "data", "AUDIT": "audit", "QUARANTINE": "bad", "CHECKPOINT": "checkpoint"}
    return {k: f"{root}/{v}" for k, v in names.items()} | {"LINES": _lines(spark, sf_dir)}


def _file_sink(env: str, trigger_seconds: int = 60, **options) -> dict:
    sink = {"sink_type": "file", "filepath_env": env, "format": "json"}
    return sink | {"trigger_seconds": trigger_seconds, **options}


@query(f"select 'bad' as side, value from ({_BAD_SQL}) union all "
       "select 'good', cast(event_id as varchar) from events where event_type not in ('error', 'click')")
def loader_quarantine(spark, sf_dir):
    """A loader run to a folder: what was loaded, and every line that was not."""
    env = _event_env(spark, sf_dir)
    store = _event_store({}, _file_sink("DATA"), _file_sink("AUDIT"), loader_quarantine=True)
    bad = loader.run_loader(spark, store, "loader", env, folder=env["DATA"])
    good = decode_json(spark.read.text(env["DATA"]), _EVENT)
    return bad.select(F.lit("bad").alias("side"), "value").unionAll(
        good.select(F.lit("good"), F.col("event_id").cast("string"))
    )


def _run_events(spark, sf_dir, source: dict, sink: dict, audit: dict, starts: int = 1):
    from .plans.pipeline import run_stream

    env = _event_env(spark, sf_dir)
    store = _event_store(source, sink, audit)
    for _ in range(starts):
        run = run_stream(
            spark, store, "events", env, available_now=True, checkpoint=env["CHECKPOINT"]
        )
        run.await_termination()
    return run, env


@query(f"select 'bad' as side, value, 0 as entries from ({_BAD_SQL}) union all "
       "select 'good', cast(event_id as varchar), 1 from events "
       "where event_type not in ('error', 'click')")
def stream_quarantine(spark, sf_dir):
    """Good rows with their audit entries, and malformed rows, of one query."""
    source = {"on_malformed": "quarantine", "quarantine_filepath_env": "QUARANTINE"}
    run, env = _run_events(spark, sf_dir, source, _file_sink("DATA"), _file_sink("AUDIT"))
    entries = run.audit_sink.read(spark).groupBy("event_id").agg(
        F.count("*").cast("int").alias("entries")
    )
    good = run.data_sink.read(spark).join(entries, "event_id", "left")
    bad = spark.read.schema("value string").json(f"{env['QUARANTINE']}/*/*")
    return bad.select(F.lit("bad").alias("side"), "value", F.lit(0).alias("entries")).unionAll(
        good.select(F.lit("good"), F.col("event_id").cast("string"), "entries")
    )


@query("select event_type, count(*) as records, count(*) as entries from events "
       "where event_type not in ('error', 'click') group by event_type")
def stream_two_paces(spark, sf_dir):
    """Sinks with paces of their own share one query, so every record has its entry."""
    source = {"on_malformed": "quarantine", "quarantine_filepath_env": "QUARANTINE"}
    data = _file_sink("DATA", trigger_seconds=1, coalesce=1)
    run, _ = _run_events(spark, sf_dir, source, data, _file_sink("AUDIT", trigger_seconds=5))
    entries = run.audit_sink.read(spark).select("event_id")
    records = run.data_sink.read(spark).select("event_id", "event_type")
    joined = records.join(entries.withColumnRenamed("event_id", "entry"), F.col("event_id") == F.col("entry"), "left")
    return joined.groupBy("event_type").agg(
        F.count("event_id").alias("records"), F.count("entry").alias("entries")
    )


@query("select event_id, event_type, 1 as entries, 6 as fast_leaves, 1 as slow_leaves from events")
def stream_own_paces(spark, sf_dir):
    """Six batches: the faster sink has a leaf of each, the slower one writes them as one range."""
    root = scratch_path(spark, "paces")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "props")
    events.repartition(6, "event_id").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    audited = op.apply_audited(stream, [op.redact_step("props", "props", "XXXXX")], "event_id", "p")
    data, trail = op.split_audit(audited, "event_id")
    fast = FileSink(f"{root}/data", data.schema, trigger_seconds=1)
    late = FileSink(f"{root}/audit", trail.schema, trigger_seconds=3600)
    start_pipeline(audited, "event_id", fast, late, f"{root}/checkpoint", "paces", available_now=True).await_termination()

    def leaves(path: str, name: str) -> DataFrame:
        return spark.read.json(path).agg(F.count_distinct("batch_id").cast("int").alias(name))

    entries = late.read(spark).groupBy("event_id").agg(F.count("*").cast("int").alias("entries"))
    counts = {n: leaves(f"{root}/{p}", n).first()[0] for n, p in (("fast_leaves", "data"), ("slow_leaves", "audit"))}
    joined = fast.read(spark).select("event_id", "event_type").join(entries, "event_id", "left")
    return joined.withColumns({n: F.lit(c) for n, c in counts.items()})


@query("select event_id, event_type, user_id, 1 as entries from events where event_type not in ('error', 'click')")
def stream_memory_restart(spark, sf_dir):
    """A memory pipeline started twice on one checkpoint still shows all its rows."""
    source = {"on_malformed": "quarantine", "quarantine_filepath_env": "QUARANTINE"}
    sinks = [
        {"sink_type": "memory", "query_name": n, "query_interval": 1, "duration_seconds": 1}
        for n in ("events_now", "event_trail_now")
    ]
    run, _ = _run_events(spark, sf_dir, source, *sinks, starts=2)
    trail = run.audit_sink.snapshot(spark).groupBy("event_id").agg(F.count("*").cast("int").alias("entries"))
    return run.data_sink.snapshot(spark).select("event_id", "event_type", "user_id").join(trail, "event_id", "left")


@query(
    """select case when event_type <> 'error' then event_id end as event_id,
              case when event_type <> 'error' then event_type end as event_type,
              case when event_type not in ('error', 'click') then user_id end as user_id, 0 as failed
       from events"""
)
def stream_processing_time(spark, sf_dir):
    """A run by processing time, stopped when the source is used up; malformed fields are null."""
    from .plans.pipeline import run_stream

    env = _event_env(spark, sf_dir)
    store = _event_store({}, _file_sink("DATA", trigger_seconds=1), _file_sink("AUDIT", trigger_seconds=1))
    run = run_stream(spark, store, "events", env, checkpoint=env["CHECKPOINT"])
    for each in run.queries:
        each.processAllAvailable()
    failed = sum(each.exception() is not None for each in run.queries)
    run.stop()
    return run.data_sink.read(spark).select("event_id", "event_type", "user_id", F.lit(failed).alias("failed"))


@query(
    """select o_orderkey, o_custkey, case when o_orderkey % 2 = 0 then 'new' else o_orderstatus end as o_orderstatus
       from orders"""
)
def upsert_latest(spark, sf_dir):
    """Several source rows for a key: the one with the greatest version counts."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    even = orders.where("o_orderkey % 2 = 0")
    source = even.withColumns({"o_orderstatus": F.lit("old"), "version": F.lit(1)}).unionByName(
        even.withColumns({"o_orderstatus": F.lit("new"), "version": F.lit(2)})
    )
    return op.upsert(orders, source, ["o_orderkey"], latest="version")


@query(
    """with w as (select *, case when o_orderkey % 5 = 0 then null when o_orderkey % 5 = 1 then 0.0
                        when o_orderkey % 5 = 2 then 'nan'::double else o_totalprice end as w from orders)
       select count(*) as n, 0 as odd from w where w > 0 and not isnan(w)"""
)
def weighted_sample_odd(spark, sf_dir):
    """Null, zero and NaN weights are never drawn, however large the sample."""
    rest = F.col("o_orderkey") % 5
    weight = F.when(rest == 1, 0.0).when(rest == 2, float("nan")).when(rest > 2, F.col("o_totalprice"))
    orders = table(spark, sf_dir, "orders").withColumn("w", weight)
    drawn = op.sample_weighted(orders, 1 << 40, "o_orderkey", "w", 7)
    odd = F.count_if(F.col("w").isNull() | F.isnan("w") | (F.col("w") <= 0)).cast("int")
    return drawn.agg(F.count("*").alias("n"), odd.alias("odd"))


@query(
    """select cast(o_orderkey % 128 as tinyint)::int as b, cast(o_orderkey % 1000 as smallint) as s,
              cast(o_custkey as integer) as i, o_orderkey as l, cast(o_totalprice as float) as f,
              o_totalprice as d, o_orderkey % 2 = 0 as t, o_orderstatus as v,
              cast(o_orderdate as date) as day, cast(o_orderdate as timestamp) as at, o_orderdate as local
       from orders"""
)
def json_declared_types(spark, sf_dir):
    """Every type that a specification may declare, written as JSON and decoded."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "cast(o_orderkey % 128 as int) b", "cast(o_orderkey % 1000 as short) s", "cast(o_custkey as int) i",
        "o_orderkey l", "cast(o_totalprice as float) f", "o_totalprice d", "o_orderkey % 2 = 0 t",
        "o_orderstatus v", "cast(o_orderdate as date) day", "cast(o_orderdate as timestamp) at",
        "cast(o_orderdate as timestamp_ntz) local",
    )
    return decode_json(orders.select(F.to_json(F.struct("*")).alias("value")), orders.schema)


@query(
    """select p_name as disease, cast(p_size as bigint) as usage, cast(count(*) over (partition by p_name) as int) as records
       from part where p_size % 2 = 1"""
)
def job_list(spark, sf_dir):
    """Two jobs of a configuration, the second on what the first one wrote."""
    root = scratch_path(spark, "jobs")
    part = table(spark, sf_dir, "part")
    codes = part.select(
        F.concat("p_name", F.when(F.col("p_size") % 2 == 1, " (disorder)").otherwise(" (finding)")).alias("Description"),
        F.when(F.col("p_size") == 1, "*").otherwise(F.col("p_size").cast("string")).alias("Usage"),
    )
    codes.write.option("header", "true").csv(f"{root}/codes.csv")
    written = f"{root}/usage"
    names = part.select(F.concat(F.lit("n"), "p_partkey").alias("n"))
    names.select(F.col("n").alias("forename")).write.parquet(f"{root}/forenames")
    names.select(F.col("n").alias("surname")).write.parquet(f"{root}/surnames")
    names.select(F.col("n").alias("postcode"), F.col("n").alias("city")).write.parquet(f"{root}/cities")
    inputs = {f"{n}_filename": f"{root}/{f}" for n, f in (("forenames", "forenames"), ("surnames", "surnames"), ("city", "cities"))}
    # More records than there are rows of diseases: each row is drawn once.
    records = {"number": 900_000, "snomed_filename": written, "output": f"{root}/records", **inputs}
    listed = [
        {"function": "snomed_transform", "params": {"input": f"{root}/codes.csv", "output": written}},
        {"function": "sample_data_transform", "params": records},
    ]
    assert jobs.run_jobs(spark, {"transform": listed}) == ["snomed_transform", "sample_data_transform"]
    drawn = spark.read.schema("disease string").json(f"{root}/records").groupBy("disease")
    per_disease = drawn.agg(F.count("*").cast("int").alias("records"))
    return spark.read.parquet(written).join(per_disease, "disease", "left")


# --- tables kept by batches ---------------------------------------------------------


@query(
    """select o_orderkey, o_custkey,
              case when o_orderkey = (select min(o_orderkey) from orders) then 'new' else o_orderstatus end
                as o_orderstatus, 1 as buckets_written, 15 as buckets_untouched
       from orders"""
)
def upsert_one_bucket(spark, sf_dir):
    """A source that hits one bucket of a table by key: the files of the others stay."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    kept = op.BucketTable.create(orders, scratch_path(spark, "orders-by-key"), ["o_orderkey"], 16)
    before = kept.files()
    first = orders.orderBy("o_orderkey").limit(1).withColumn("o_orderstatus", F.lit("new"))
    hit = kept.upsert(first)
    same = sum(before[b] == names for b, names in kept.files().items())
    return kept.read().withColumns({"buckets_written": F.lit(len(hit)), "buckets_untouched": F.lit(same)})


@query(
    """select o_orderkey, o_custkey, case when o_orderkey % 10 = 0 then 'two' when o_orderkey % 2 = 0 then 'one'
              else o_orderstatus end as o_orderstatus from orders
       union all select -o_orderkey, o_custkey, 'one' from orders where o_orderkey % 2 = 0"""
)
def upsert_versions(spark, sf_dir):
    """Two upserts of a table by key, the second written twice, old buckets deleted.

    An order and its mirrored copy are two rows, also where -0 is 0: the side is in the key.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").withColumn("mirrored", F.lit(False))
    kept = op.BucketTable.create(orders, scratch_path(spark, "orders-by-key"), ["o_orderkey", "mirrored"], 8)
    even = orders.where("o_orderkey % 2 = 0").withColumn("o_orderstatus", F.lit("one"))
    copies = even.withColumns({"o_orderkey": -F.col("o_orderkey"), "mirrored": F.lit(True)})
    kept.upsert(even.unionByName(copies))
    for _ in range(2):
        kept.upsert(orders.where("o_orderkey % 10 = 0").withColumn("o_orderstatus", F.lit("two")), version=2)
    kept.tidy()
    return kept.read().drop("mirrored")


@query(
    """select event_id, event_type, cast(event_id % 40 as int) as batch_id, 1 as leaves from events"""
)
def merged_batches(spark, sf_dir):
    """Forty batches of a query, merged but for the newest; a merged one comes again."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    path, schema = scratch_path(spark, "batches"), T.StructType([*events.schema, T.StructField("batch_id", T.IntegerType())])
    for number in range(40):
        write_batch(events.where(F.col("event_id") % 40 == number), path, "q", number)
        if number in (19, 39):
            merge_batches(spark, path, schema)
    write_batch(events.where("event_id % 40 = 7"), path, "q", 7)
    leaves = spark.read.parquet(path).select("batch_id").distinct().count()
    return read_table(spark, path, schema).withColumn("leaves", F.lit(leaves))


@query(
    f"""select value, case when value like '%click%' then 'user_id' end as field,
               case when value like '%click%' then 'wrong type: STRING' else 'no JSON' end as reason
        from ({_BAD_SQL})
        union all select '{{"user_id":' || user_id || '}}', 'event_id', 'missing' from events
        union all select '{{"event_id":null,"user_id":' || user_id || '}}', 'event_id', 'null' from events"""
)
def quarantine_reasons(spark, sf_dir):
    """Lines that are cut off, mistyped, or have no primary: each with field and reason."""
    users = table(spark, sf_dir, "events").select("user_id")
    missing = users.select(F.format_string('{"user_id":%d}', "user_id").alias("value"))
    null = users.select(F.format_string('{"event_id":null,"user_id":%d}', "user_id").alias("value"))
    lines = _faulty_envelopes(spark, sf_dir).unionByName(missing).unionByName(null)
    _, bad = loader.check_records(lines.withColumn("file", F.lit("lines")), _EVENT, "event_id")
    return bad.select("value", F.explode("reasons").alias("r")).select("value", "r.field", "r.reason")


@query(
    f"""select o_orderkey, o_totalprice from orders
        order by {_sql_draw("5", "o_orderkey")}, o_orderkey limit 300"""
)
def running_sample(spark, sf_dir):
    """The sample of a table that comes in nine batches, two of them twice."""
    return _in_batches(spark, sf_dir)


@query(
    f"""select o_orderkey, o_totalprice from orders where o_totalprice > 0
        order by -ln({_sql_draw("5", "o_orderkey")}) / o_totalprice, o_orderkey limit 300"""
)
def running_sample_weighted(spark, sf_dir):
    """The same, with chances in proportion to a weight."""
    return _in_batches(spark, sf_dir, weight="o_totalprice")


def _in_batches(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    path = scratch_path(spark, "sample")
    sink = SampleSink(path, orders.schema, 300, "o_orderkey", 5, algorithm="md5", **options)
    sink.prepare(spark)
    for number in (0, 1, 2, 2, 3, 4, 5, 5):
        sink.write(orders.where(F.col("o_orderkey") % 9 == number), "first", number)
    # A new checkpoint counts from 0 again.
    for number in (6, 7, 8):
        sink.write(orders.where(F.col("o_orderkey") % 9 == number), "second", number - 6)
    return sink.read(spark)


@query(
    """with c as (select o_custkey, o_orderpriority, count(*) as n from orders group by all)
       select o_custkey, arg_min(o_orderpriority, (-n, o_orderpriority)) as priority, 2 as versions
       from c group by o_custkey"""
)
def lookup_from_batches(spark, sf_dir):
    """Three batches of facts, one of them twice, give the lookup of all facts."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("priority"), "o_orderkey")
    lookup = FactLookup(scratch_path(spark, "facts"), orders.schema["o_custkey"], orders.schema["priority"])
    lookup.prepare(spark)
    for number in (0, 1, 1, 2):
        lookup.write(orders.where(F.col("o_orderkey") % 3 == number), "facts", number)
        if number == 0:
            lookup.publish(spark)
    lookup.publish(spark)
    lookup.tidy(spark)
    return lookup.current(spark).withColumn("versions", F.lit(len(lookup.versions(spark))))


@query("select event_id, ts, user_id, event_type, value, 'XXXXX' as props, 'refused' as other_steps from events")
def stream_changed_steps(spark, sf_dir):
    """A restart on a checkpoint: equal steps go on, other steps are refused and write nothing."""
    from .plans.pipeline import run_stream

    env = _event_env(spark, sf_dir)
    _envelopes(spark, sf_dir).write.mode("overwrite").text(env["LINES"])
    store = _event_store({}, _file_sink("DATA"), _file_sink("AUDIT"))
    for _ in range(2):
        run = run_stream(spark, store, "events", env, available_now=True, checkpoint=env["CHECKPOINT"])
        run.await_termination()
    changed = store.model_copy(deep=True)
    changed.pipeline("events").transforms[0].replace_with = "YYYYY"
    try:
        run_stream(spark, changed, "events", env, available_now=True, checkpoint=env["CHECKPOINT"])
    except ValueError as error:
        outcome = "refused" if "other steps" in str(error) else str(error)
    else:
        outcome = "started"
    return run.data_sink.read(spark).withColumn("other_steps", F.lit(outcome))

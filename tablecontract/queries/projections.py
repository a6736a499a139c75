"""Typed rows becoming contract columns."""

from pyspark.sql import functions as F, types as T

from ..contract import Contract
from ..mapping import Override
from ..operators.conform import conform
from ..options import column
from ..types import TableColumn
from .registry import query

LONG, INT, TEXT, DOUBLE, BOOL = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType(), T.BooleanType()
INSTANT, MONEY = T.TimestampType(), T.DecimalType(38, 9)


def row(*fields):
    return T.StructType(list(fields))


EVENT = Contract.of(
    row(
        column("event_id", LONG, name="id", required=True),
        column("ts", INSTANT, name="at"),
        column("tokyo", INSTANT, name="day", as_time="date", zone="Asia/Tokyo"),
        column("user_id", LONG),
        column("value", MONEY, name="amount", description="billed amount"),
        column("props", TEXT, type="JSON"),
        column("event_type", TEXT, skip=True),
    )
)


@query(
    """SELECT event_id AS id, CAST(ts AS VARCHAR) AS at, CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS day,
              user_id, CAST(CAST(value AS DECIMAL(38,9)) AS VARCHAR) AS amount, props
       FROM events"""
)
def q_conform(t):
    events = t.instants.withColumn("tokyo", F.col("ts")).withColumn("value", F.col("value").cast(MONEY))
    return conform(events, EVENT)


def _orders_with_facts(t):
    return t.orders.select(
        F.struct(
            F.col("o_orderstatus").alias("status"),
            F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_custkey").alias("key")).alias("deep"),
        ).alias("facts"),
        F.struct(F.col("o_custkey").alias("customer"), F.lit("hidden").alias("status")).alias("party"),
        F.col("o_orderkey").alias("key"),
    )


_FACTS = T.StructType(
    [
        column("status", TEXT),
        column("deep", T.StructType([column("priority", TEXT), column("key", LONG)]), embed=True),
    ]
)
_PARTY = T.StructType([column("customer", LONG), column("status", TEXT, skip=True)])


@query("SELECT o_orderstatus AS status, o_orderpriority AS priority, o_custkey AS customer, o_orderkey AS key FROM orders")
def q_promote(t):
    """Embedded structs flatten; the outer key hides the deeper one."""
    contract = Contract.of(
        row(column("facts", _FACTS, embed=True), column("party", _PARTY, embed=True), column("key", LONG))
    )
    return conform(_orders_with_facts(t), contract)


@query("SELECT o_orderkey AS key, o_orderstatus AS status, to_json({'customer': o_custkey, 'status': 'hidden'})::VARCHAR AS party FROM orders")
def q_named_embed(t):
    """An embedded struct with a name of its own is one column, and nothing inside it is promoted."""
    facts = T.StructType([column("status", TEXT), column("deep", T.StructType([column("priority", TEXT), column("key", LONG)]), skip=True)])
    whole = T.StructType([column("customer", LONG), column("status", TEXT)])
    contract = Contract.of(row(column("facts", facts, embed=True), column("party", whole, name="party", embed=True), column("key", LONG)))
    return conform(_orders_with_facts(t), contract).select("key", "status", "party")


class Span(T.UserDefinedType):
    """A type that says itself what it becomes."""

    contract_type = "STRING"

    @classmethod
    def sqlType(cls):
        return T.StructType([T.StructField("status", TEXT), T.StructField("customer", LONG)])

    @classmethod
    def contract_value(cls, value):
        return F.concat_ws("/", value["customer"].cast("string"), value["status"])


@query("""SELECT o_orderkey AS key, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey || '/' || o_orderstatus END AS span,
                 to_json([o_custkey || '/' || o_orderstatus])::VARCHAR AS spans FROM orders""")
def q_own_mapping(t):
    """A column whose type brings its mapping along, alone and in a list."""
    one = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("customer"))
    rows = t.orders.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 5 != 0, one).alias("span"), F.array(one).alias("spans"))
    return conform(rows, Contract.of(row(column("key", LONG), column("span", Span()), column("spans", T.ArrayType(Span())))))


@query(
    """SELECT o_orderkey AS key, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status,
              CASE WHEN o_orderkey % 3 <> 0 THEN to_json([o_orderpriority])::VARCHAR END AS tags
       FROM orders"""
)
def q_promote_null(t):
    """A missing embedded struct leaves its columns NULL, repeated ones too."""
    parent = T.StructType([column("status", TEXT), column("tags", T.ArrayType(TEXT))])
    contract = Contract.of(row(column("key", LONG), column("facts", parent, embed=True)))
    facts = F.struct(F.col("o_orderstatus").alias("status"), F.array("o_orderpriority").alias("tags"))
    orders = t.orders.select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 3 != 0, facts).alias("facts"))
    return conform(orders, contract)


@query(
    """SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, l_tax AS tax,
              CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS flag,
              CASE WHEN l_linestatus <> 'O' THEN true END AS filled,
              CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_shipdate AS VARCHAR) END AS shipped,
              CASE WHEN l_tax <> 0 OR l_returnflag <> 'N'
                   THEN to_json({'a': l_tax, 'b': CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag END})::VARCHAR END AS pair
       FROM lineitem"""
)
def q_nullifzero(t):
    flag = F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag"))
    rows = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_discount") == 0, F.lit(-0.0)).otherwise(F.col("l_discount")).alias("discount"),
        F.col("l_tax").alias("tax"),
        flag.alias("flag"),
        (F.col("l_linestatus") != "O").alias("filled"),
        F.when(F.col("l_orderkey") % 5 == 0, F.timestamp_micros(F.lit(-62135596800000000)))
        .otherwise(F.col("l_shipdate").cast("timestamp"))
        .alias("shipped"),
        F.struct(F.col("l_tax").alias("a"), flag.alias("b")).alias("pair"),
    )
    pair = T.StructType([T.StructField("a", DOUBLE), T.StructField("b", TEXT)])
    contract = Contract.of(
        row(
            column("l_orderkey", LONG),
            column("l_linenumber", INT),
            column("discount", DOUBLE, nullifzero=True),
            column("tax", DOUBLE),
            column("flag", TEXT, nullifzero=True),
            column("filled", BOOL, nullifzero=True),
            column("shipped", INSTANT, nullifzero=True),
            column("pair", pair, nullifzero=True),
        )
    )
    return conform(rows, contract)


_TAGS = """(CASE WHEN l_orderkey % 7 = 0 THEN NULL
            ELSE list_filter([l_returnflag, l_linestatus], lambda x: x NOT IN ('N', 'O')) END)"""


def _tagged_lines(t):
    tags = F.filter(F.array("l_returnflag", "l_linestatus"), lambda x: ~x.isin("N", "O"))
    return t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 7 != 0, tags).alias("tags"))


def _tag_contract(**options):
    return Contract.of(
        row(column("l_orderkey", LONG), column("l_linenumber", INT), column("tags", T.ArrayType(TEXT), **options))
    )


@query(
    f"""SELECT l_orderkey, l_linenumber, CASE WHEN len({_TAGS}) > 0 THEN to_json({_TAGS})::VARCHAR END AS tags FROM lineitem"""
)
def q_nullifempty(t):
    return conform(_tagged_lines(t), _tag_contract(nullifzero=True))


@query(f"SELECT l_orderkey, l_linenumber, to_json(coalesce({_TAGS}, []))::VARCHAR AS tags FROM lineitem")
def q_empty_array(t):
    return conform(_tagged_lines(t), _tag_contract())


def _one_time(as_time, **zone):
    return Contract.of(row(column("event_id", LONG), column("ts", INSTANT, name="out", as_time=as_time, **zone)))


@query("SELECT event_id, CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR) AS out FROM events")
def q_to_date_zone(t):
    return conform(t.instants, _one_time("date", zone="Asia/Tokyo"))


@query(
    """SELECT event_id, CAST(CASE WHEN user_id % 2 = 0 THEN ts + INTERVAL 9 HOUR
                                  ELSE ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' END AS VARCHAR) AS out FROM events"""
)
def q_to_datetime_zone(t):
    """Every row in its own zone."""
    contract = Contract.of(
        row(
            column("event_id", LONG),
            column("ts", INSTANT, name="out", as_time="datetime", zone_column="zone"),
        )
    )
    zone = F.when(F.col("user_id") % 2 == 0, "Asia/Tokyo").otherwise("America/New_York")
    return conform(t.instants.withColumn("zone", zone), contract)


@query(
    """SELECT event_id, strftime(ts, '%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN ''
              ELSE '.' || strftime(ts, '%f') END AS out FROM events"""
)
def q_to_time(t):
    return conform(t.instants, _one_time("time"))


_DETAIL = T.StructType(
    [T.StructField("status", TEXT), T.StructField("total", DOUBLE), T.StructField("on", T.TimestampNTZType())]
)


@query(
    """SELECT o_orderkey, CASE WHEN o_custkey % 4 <> 0 THEN
              to_json({'status': CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END, 'total': o_totalprice,
                       'on': strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')})::VARCHAR END AS detail
       FROM orders"""
)
def q_struct_json(t):
    detail = F.struct(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_orderdate").alias("on"),
    )
    orders = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 4 != 0, detail).alias("detail"))
    return conform(orders, Contract.of(row(column("o_orderkey", LONG), column("detail", _DETAIL))))


@query(
    """SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL WHEN page_id % 5 = 1 THEN '{}'
              ELSE to_json({'a&b': html, 'url': url})::VARCHAR END AS attrs FROM pages"""
)
def q_map_json(t):
    """Keys come out sorted, and markup is not escaped."""
    full = F.create_map(F.lit("url"), F.col("url"), F.lit("a&b"), F.col("html"))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    attrs = F.when(F.col("page_id") % 5 == 1, empty).when(F.col("page_id") % 5 != 0, full)
    contract = Contract.of(row(column("page_id", LONG), column("attrs", T.MapType(TEXT, TEXT))))
    return conform(t.pages.select("page_id", attrs.alias("attrs")), contract)


@query(
    """SELECT o_orderkey, to_json([to_json({'k': o_orderstatus, 'n': o_custkey})::VARCHAR,
                                   to_json({'k': o_orderpriority, 'n': o_orderkey})::VARCHAR])::VARCHAR AS items FROM orders"""
)
def q_array_json(t):
    def item(k, n):
        return F.struct(F.col(k).alias("k"), F.col(n).alias("n"))

    element = T.StructType([T.StructField("k", TEXT), T.StructField("n", LONG)])
    orders = t.orders.select(
        "o_orderkey", F.array(item("o_orderstatus", "o_custkey"), item("o_orderpriority", "o_orderkey")).alias("items")
    )
    return conform(orders, Contract.of(row(column("o_orderkey", LONG), column("items", T.ArrayType(element)))))


@query("SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN props END AS props FROM events")
def q_raw_json(t):
    """Text passes through unchanged, an empty one is NULL."""
    events = t.events.withColumn("props", F.when(F.col("event_id") % 10 == 0, "").otherwise(F.col("props")))
    return conform(events, Contract.of(row(column("event_id", LONG), column("props", TEXT, type="JSON"))))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS status,
              CASE WHEN o_orderkey % 6 <> 0 THEN o_custkey END AS customer,
              CASE WHEN o_orderkey % 6 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day,
              o_orderkey % 6 = 0 AS missing
       FROM orders"""
)
def q_record(t):
    """Records nest; a missing one stays missing rather than turning into a record of NULLs."""
    party = T.StructType([column("customer", LONG, name="c"), column("ts", INSTANT, name="day", as_time="date")])
    detail = T.StructType([column("status", TEXT), column("party", party, record=True)])
    value = F.struct(
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("o_custkey").alias("customer"), F.col("o_orderdate").cast("timestamp").alias("ts")).alias("party"),
    )
    orders = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 6 != 0, value).alias("detail"))
    out = conform(orders, Contract.of(row(column("o_orderkey", LONG), column("detail", detail, record=True))))
    return out.select(
        "o_orderkey",
        F.col("detail.status").alias("status"),
        F.col("detail.party.c").alias("customer"),
        F.col("detail.party.day").alias("day"),
        F.col("detail").isNull().alias("missing"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, to_json([{'A': 'quantity', 'B': CAST(l_quantity AS BIGINT)},
                                                 {'A': 'part', 'B': l_partkey}])::VARCHAR AS items FROM lineitem"""
)
def q_repeated_record(t):
    element = T.StructType([column("name", TEXT, name="A"), column("n", LONG, name="B"), column("x", TEXT, skip=True)])

    def item(name, n):
        return F.struct(F.lit(name).alias("name"), n.alias("n"), F.lit("").alias("x"))

    items = F.array(item("quantity", F.col("l_quantity").cast("bigint")), item("part", F.col("l_partkey")))
    contract = Contract.of(
        row(
            column("l_orderkey", LONG),
            column("l_linenumber", INT),
            column("items", T.ArrayType(element), record=True),
        )
    )
    return conform(t.lineitem.select("l_orderkey", "l_linenumber", items.alias("items")), contract)


@query(
    """SELECT p_partkey, CAST(p_size AS BIGINT) AS size, CAST(CAST(p_size AS TINYINT) AS BIGINT) AS tiny,
              CAST(p_retailprice AS DOUBLE) AS price, CAST(CAST(p_size AS FLOAT) AS DOUBLE) AS ratio, p_size > 20 AS big,
              p_name AS name, to_base64(encode(p_brand)) AS brand
       FROM part"""
)
def q_widen(t):
    parts = t.part.select(
        "p_partkey",
        F.col("p_size").alias("size"),
        F.col("p_size").cast("tinyint").alias("tiny"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("float").alias("ratio"),
        (F.col("p_size") > 20).alias("big"),
        F.col("p_name").alias("name"),
        F.col("p_brand").cast("binary").alias("brand"),
    )
    return conform(
        parts,
        Contract.of(
            row(
                column("p_partkey", LONG),
                column("size", INT),
                column("tiny", T.ByteType()),
                column("price", DOUBLE),
                column("ratio", T.FloatType()),
                column("big", BOOL),
                column("name", TEXT),
                column("brand", T.BinaryType()),
            )
        ),
    )


@query(
    """SELECT o_orderkey, CAST(CAST(18446744073709551615 - o_orderkey AS DECIMAL(38,9)) AS VARCHAR) AS large,
              CASE WHEN o_custkey % 3 <> 0 THEN CAST(CAST(o_custkey AS DECIMAL(38,9)) AS VARCHAR) END AS small
       FROM orders"""
)
def q_uint64_numeric(t):
    unsigned = T.DecimalType(20, 0)
    orders = t.orders.select(
        "o_orderkey",
        (F.lit("18446744073709551615").cast(unsigned) - F.col("o_orderkey")).cast(unsigned).alias("large"),
        F.when(F.col("o_custkey") % 3 == 0, 0).otherwise(F.col("o_custkey")).cast(unsigned).alias("small"),
    )
    contract = Contract.of(
        row(column("o_orderkey", LONG), column("large", unsigned), column("small", unsigned, nullifzero=True))
    )
    return conform(orders, contract)


@query(
    """SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(38,9)) AS VARCHAR) AS exact,
              CAST(CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,1)) AS VARCHAR) AS rounded
       FROM customer"""
)
def q_numeric(t):
    """A decimal keeps its digits up to the declared scale and rounds half away from zero there."""
    cents = T.DecimalType(18, 2)
    customers = t.customer.select(
        "c_custkey", F.col("c_acctbal").cast(cents).alias("exact"), F.col("c_acctbal").cast(cents).alias("rounded")
    )
    contract = Contract.of(
        row(column("c_custkey", LONG), column("exact", cents), column("rounded", cents, scale=1)),
    )
    return conform(customers, contract)


@query(
    """SELECT event_id, upper(event_type) AS event_type, to_json([upper(event_type), 'X'])::VARCHAR AS kinds,
              CAST(floor(value) AS BIGINT) AS value FROM events"""
)
def q_override(t):
    """A registered mapping covers plain and repeated uses of its type, and may change the column's type."""
    events = t.events.select("event_id", "event_type", F.array("event_type", F.lit("x")).alias("kinds"), "value")
    contract = Contract.of(
        row(
            column("event_id", LONG),
            column("event_type", TEXT),
            column("kinds", T.ArrayType(TEXT)),
            column("value", DOUBLE),
        ),
        overrides=[
            Override(TEXT, "STRING", F.lower),
            Override(TEXT, "STRING", F.upper),
            Override(DOUBLE, "INTEGER", F.floor),
        ],
    )
    return conform(events, contract)


@query(
    """SELECT CAST(NULL AS VARCHAR) AS note, CAST(c_nationkey AS BIGINT) AS nation, c_name AS name,
              CAST(NULL AS VARCHAR) AS amount, c_custkey AS id FROM customer"""
)
def q_wide_read(t):
    """A table may be wider than the rows written to it."""
    contract = Contract.of(
        row(
            column("c_custkey", LONG, name="id"),
            column("c_name", TEXT, name="name"),
            column("c_nationkey", INT, name="nation"),
        ),
        columns=[
            TableColumn("note", "STRING"),
            TableColumn("nation", "INTEGER"),
            TableColumn("name", "STRING"),
            TableColumn("amount", "NUMERIC"),
            TableColumn("id", "INTEGER"),
        ],
    )
    return conform(t.customer, contract, wide=True)

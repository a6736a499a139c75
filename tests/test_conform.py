"""Values of typed rows under their contract."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import BatchTypeError, Contract, Override, column, conform
from tablecontract.functions.temporal import utc_wall_clock

S, L, TS = T.StringType(), T.LongType(), T.TimestampType()
INNER = T.StructType([column("A", S), column("B", L)])


def of(*fields, **options):
    return Contract.of(T.StructType(list(fields)), **options)


@pytest.fixture
def one(spark):
    """One row from SQL expressions, conformed."""

    def run(contract, gated=True, **values):
        df = spark.range(1).select(*[F.expr(v).alias(k) for k, v in values.items()])
        return conform(df, contract, gated=gated).first()

    return run


def test_many_shapes_in_one_row(one):
    """An order with its lines: each column by another rule, next to those it could be mixed up with."""
    line = T.StructType([column("sku", S), column("pieces", L)])
    contract = of(
        column("number", L, required=True), column("note", S, nullifzero=True), column("weight", T.FloatType()), column("gift", T.BooleanType()),
        column("stamp", T.BinaryType()), column("placed", TS, as_time="date"), column("packed", TS, as_time="time"), column("due", T.DateType(), name="due_on"),
        column("visits", T.ArrayType(TS), as_time="date"), column("total", T.DecimalType(38, 9)), column("codes", T.ArrayType(S)),
        column("first", line, record=True), column("lines", T.ArrayType(line), record=True), column("last", line),
        column("extra", T.MapType(S, S)), column("source", S, type="JSON"), column("scratch", S, skip=True),
    )
    late = "timestamp'2024-02-29T23:59:58Z'"
    row = one(
        contract, number="7L", note="''", weight="cast(0.25 as float)", gift="false", stamp="X'00FF'", placed=late, packed=late, due="date'2024-03-01'",
        visits=f"array({late}, timestamp'2024-01-01T00:00:00Z')", total="cast(19.99 as decimal(38,9))", codes="array('q')",
        first="named_struct('sku','s-1','pieces',2L)", lines="array(named_struct('sku','s-1','pieces',2L), named_struct('sku','s-2','pieces',5L))",
        last="named_struct('sku','s-2','pieces',cast(null as bigint))", extra="map('go','<a & b>')", source="'[1, {}]'", scratch="'x'",
    ).asDict()
    assert "scratch" not in row and "due" not in row
    assert [r.asDict() for r in row.pop("lines")] == [{"sku": "s-1", "pieces": 2}, {"sku": "s-2", "pieces": 5}] and row.pop("first").pieces == 2
    assert row == {
        "number": 7, "note": None, "weight": 0.25, "gift": False, "stamp": b"\x00\xff", "placed": dt.date(2024, 2, 29), "packed": "23:59:58", "due_on": dt.date(2024, 3, 1),
        "visits": [dt.date(2024, 2, 29), dt.date(2024, 1, 1)], "total": Decimal("19.99"), "codes": ["q"], "last": '{"sku":"s-2","pieces":null}',
        "extra": '{"go":"<a & b>"}', "source": "[1, {}]",
    }


def test_the_plan_is_one_projection_and_a_filter(spark):
    contract = of(column("id", L, required=True), column("at", TS, as_time="date", zone="Asia/Tokyo"), column("d", INNER))
    df = spark.range(3).select("id", F.current_timestamp().alias("at"), F.struct(F.lit("x").alias("A"), F.col("id").alias("B")).alias("d"))
    plan = conform(df, contract)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Project") == 1


# -- zones ------------------------------------------------------------------------------


def test_one_instant_four_ways(one):
    contract = of(
        column("a", TS), column("b", TS, as_time="date"), column("c", TS, as_time="datetime"), column("d", TS, as_time="time")
    )
    at = "timestamp'2019-03-14T21:45:09.000007Z'"
    row = one(contract, a=at, b=at, c=at, d=at)
    assert row.b == dt.date(2019, 3, 14)
    assert row.c == dt.datetime(2019, 3, 14, 21, 45, 9, 7)
    assert row.d == "21:45:09.000007"


def test_the_zone_is_the_values_own(one):
    at = "timestamp'2019-03-14T21:45:00Z'"
    fields = [column("utc", TS, as_time="date"), column("tokyo", TS, as_time="date", zone="Asia/Tokyo")]
    row = one(of(*fields, column("own", TS, as_time="datetime", zone_column="z"), column("z", S)), utc=at, tokyo=at, own=at, z="'Asia/Tokyo'")
    assert (row.utc, row.tokyo) == (dt.date(2019, 3, 14), dt.date(2019, 3, 15))
    assert row.own == dt.datetime(2019, 3, 15, 6, 45)
    assert one(of(column("utc", TS, as_time="date"), zone="Asia/Tokyo"), utc=at).utc == dt.date(2019, 3, 15)


def test_wall_clocks_survive_the_sessions_daylight_saving(spark):
    # 02:30 does not exist that day in the session's zone.
    row = spark.sql("select timestamp'2024-03-10T02:30:00Z' t").select(utc_wall_clock(F.col("t")).cast("string")).first()
    assert row[0] == "2024-03-10 02:30:00"


# -- zero and empty ---------------------------------------------------------------------

ZERO = "timestamp_micros(-62135596800000000)"


@pytest.mark.parametrize(
    "dtype, zero, kept",
    [
        (S, "''", "'x'"),
        (L, "0L", "1L"),
        (T.DoubleType(), "-0.0D", "0.5D"),
        (T.BooleanType(), "false", "true"),
        (TS, ZERO, "timestamp'2024-01-01T00:00:00Z'"),
        (T.DecimalType(20, 0), "cast(0 as decimal(20,0))", "cast(5 as decimal(20,0))"),
        (INNER, "named_struct('A','','B',0L)", "named_struct('A','','B',1L)"),
        (INNER, "named_struct('A',cast(null as string),'B',cast(null as bigint))", "named_struct('A','a','B',0L)"),
        (T.ArrayType(S), "array()", "array('')"),
        (T.ArrayType(S), "cast(null as array<string>)", "array('x')"),
    ],
)
def test_nullifzero(spark, dtype, zero, kept):
    kind = dtype.simpleString()
    rows = spark.sql(f"select 1 as n, cast({zero} as {kind}) as v union all select 2, cast({kept} as {kind})")

    def nulls(**options):
        out = conform(rows, of(column("n", T.IntegerType()), column("v", dtype, **options)))
        return {r.n for r in out.filter("v is null").select("n").collect()}

    assert nulls(nullifzero=True) == {1}
    assert nulls() == set()


@pytest.mark.parametrize("dtype, value", [(T.BinaryType(), "X''"), (T.MapType(S, S), "map()"), (T.DecimalType(38, 9), "cast(0 as decimal(38,9))")])
def test_what_only_null_makes_zero(one, dtype, value):
    assert one(of(column("v", dtype, nullifzero=True)), v=f"cast({value} as {dtype.simpleString()})").v is not None


def test_a_date_is_zero_where_its_instant_is(one):
    kept, dropped = of(column("v", TS, as_time="date")), of(column("v", TS, as_time="date", nullifzero=True))
    assert one(kept, v=ZERO).v == dt.date(1, 1, 1)
    assert one(dropped, v=ZERO).v is None
    assert one(kept, v="cast(null as timestamp)").v is None


def test_null_lists_maps_and_parents(one):
    parent = T.StructType([column("tags", T.ArrayType(S)), column("n", L)])
    contract = of(column("p", parent, embed=True), column("own", T.ArrayType(S)), column("m", T.MapType(S, L)))
    null = "cast(null as struct<tags:array<string>,n:bigint>)"
    row = one(contract, p=null, own="cast(null as array<string>)", m="cast(null as map<string,bigint>)")
    assert (row.tags, row.n, row.own, row.m) == (None, None, [], None)
    row = one(contract, p="named_struct('tags',cast(null as array<string>),'n',1L)", own="array('a')", m="cast(map() as map<string,bigint>)")
    assert (row.tags, row.n, row.own, row.m) == ([], 1, ["a"], "{}")


def test_json_text_keeps_what_to_json_would_cut(one):
    inner = T.StructType(
        [T.StructField(n, t) for n, t in (("at", TS), ("n", T.DecimalType(10, 2)), ("m", T.MapType(S, L)), ("l", T.ArrayType(TS)))]
    )
    at = "timestamp'2019-03-14T05:20:00.654321Z'"
    row = one(of(column("v", inner)), v=f"named_struct('at',{at},'n',cast(2 as decimal(10,2)),'m',map('b',1L,'a',2L),'l',array({at}))")
    assert row.v == '{"at":"2019-03-14T05:20:00.654321Z","n":"2","m":{"a":2,"b":1},"l":["2019-03-14T05:20:00.654321Z"]}'


def test_nan_has_no_json(one):
    with pytest.raises(Exception, match="NaN"):
        one(of(column("v", T.MapType(S, T.DoubleType()))), v="map('a', double('NaN'))")


def test_unsigned_numbers_do_not_pass_through_signed_ones(one):
    big = "cast('18446744073709551615' as decimal(20,0))"
    assert one(of(column("v", T.DecimalType(20, 0))), v=big).v == Decimal("18446744073709551615")


def test_decimals_round_half_away_from_zero(one):
    contract = of(column("a", T.DecimalType(10, 3), scale=2), column("b", T.DecimalType(10, 3), scale=2))
    row = one(contract, a="cast(0.125 as decimal(10,3))", b="cast(-0.125 as decimal(10,3))")
    assert (row.a, row.b) == (Decimal("0.13"), Decimal("-0.13"))


def test_pandas_overrides(one):
    @F.pandas_udf("string")
    def shout(s):
        return s.str.upper()

    contract = of(column("v", S, required=True), overrides=[Override(S, "STRING", shout)])
    assert one(contract, v="'abc'").v == "ABC"


# -- batches ----------------------------------------------------------------------------


def test_a_batch_of_another_type_is_refused(spark):
    contract = of(column("id", L), column("x", S))
    with pytest.raises(BatchTypeError, match="x is missing"):
        conform(spark.range(1), contract)
    with pytest.raises(BatchTypeError, match="id is int"):
        conform(spark.range(1).select(F.col("id").cast("int"), F.lit("").alias("x")), contract)
    with pytest.raises(BatchTypeError):
        conform(spark.range(1), Contract.dynamic(contract.columns))

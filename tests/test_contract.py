"""What a row type becomes, and what is refused when a contract is built."""

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import Contract, ContractError, Layout, Override, TableColumn, TableMetadata, column, parse_labels
from tablecontract.options import ColumnOptions

STRING, LONG, DOUBLE, TS = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()


def of(*fields, **options):
    return Contract.of(T.StructType(list(fields)), **options)


def shape(contract):
    return [(c.name, c.type, c.mode) for c in contract.columns]


INNER = T.StructType([column("A", STRING), column("B", LONG)])


@pytest.mark.parametrize(
    "dtype, options, expected",
    [
        (STRING, {}, ("STRING", "NULLABLE")),
        (T.BooleanType(), {"required": True}, ("BOOL", "REQUIRED")),
        (T.ByteType(), {}, ("INTEGER", "NULLABLE")),
        (T.ShortType(), {}, ("INTEGER", "NULLABLE")),
        (T.IntegerType(), {}, ("INTEGER", "NULLABLE")),
        (LONG, {}, ("INTEGER", "NULLABLE")),
        (T.FloatType(), {}, ("FLOAT", "NULLABLE")),
        (DOUBLE, {}, ("FLOAT", "NULLABLE")),
        (T.BinaryType(), {}, ("BYTES", "NULLABLE")),
        (TS, {}, ("TIMESTAMP", "NULLABLE")),
        (TS, {"as_time": "date"}, ("DATE", "NULLABLE")),
        (TS, {"as_time": "datetime"}, ("DATETIME", "NULLABLE")),
        (TS, {"as_time": "time"}, ("TIME", "NULLABLE")),
        (TS, {"record": True}, ("TIMESTAMP", "NULLABLE")),
        (T.DateType(), {}, ("DATE", "NULLABLE")),
        (T.TimestampNTZType(), {}, ("DATETIME", "NULLABLE")),
        (STRING, {"type": "TIME"}, ("TIME", "NULLABLE")),
        (STRING, {"type": "JSON"}, ("JSON", "NULLABLE")),
        (STRING, {"type": "GEOGRAPHY"}, ("GEOGRAPHY", "NULLABLE")),
        (T.DecimalType(20, 0), {}, ("NUMERIC", "NULLABLE")),
        (T.DecimalType(38, 9), {}, ("NUMERIC", "NULLABLE")),
        (T.DecimalType(38, 20), {}, ("BIGNUMERIC", "NULLABLE")),
        (INNER, {}, ("JSON", "NULLABLE")),
        (INNER, {"record": True}, ("RECORD", "NULLABLE")),
        (T.MapType(STRING, LONG), {}, ("JSON", "NULLABLE")),
        (T.VariantType(), {}, ("JSON", "NULLABLE")),
        (T.ArrayType(STRING), {"required": True}, ("STRING", "REPEATED")),
        (T.ArrayType(T.BinaryType()), {}, ("BYTES", "REPEATED")),
        (T.ArrayType(TS), {"as_time": "date"}, ("DATE", "REPEATED")),
        (T.ArrayType(INNER), {}, ("JSON", "REPEATED")),
        (T.ArrayType(INNER), {"record": True}, ("RECORD", "REPEATED")),
        (T.ArrayType(T.MapType(STRING, STRING)), {}, ("JSON", "REPEATED")),
    ],
)
def test_derivation(dtype, options, expected):
    assert shape(of(column("v", dtype, **options))) == [("v", *expected)]


def test_names_and_dropped_fields():
    contract = of(column("Name", STRING, name="user_id"), column("Kept", LONG), column("gone", LONG, skip=True))
    assert shape(contract) == [("user_id", "STRING", "NULLABLE"), ("Kept", "INTEGER", "NULLABLE")]


@pytest.mark.parametrize(
    "dtype, options",
    [
        (T.MapType(LONG, STRING), {}),
        (T.ArrayType(T.ArrayType(STRING)), {}),
        (T.CalendarIntervalType(), {}),
        (STRING, {"record": True}),
        (STRING, {"as_time": "date"}),
        (T.TimestampNTZType(), {"as_time": "date"}),
    ],
)
def test_unsupported_types(dtype, options):
    with pytest.raises(ContractError):
        of(column("v", dtype, **options))


@pytest.mark.parametrize(
    "options",
    [
        {"required": True, "nullifzero": True},
        {"record": True, "as_time": "date"},
        {"as_time": "week"},
        {"zone": "UTC", "zone_column": "z"},
        {"cluster": 5},
        {"cluster": -1},
        {"partition": "week"},
        {"partition": "day,always"},
        {"type": "INTEGER"},
        {"embed": True},
        {"colour": "red"},
    ],
)
def test_refused_options(options):
    with pytest.raises(ContractError):
        column("v", TS, **options)


def test_empty_options_are_ignored():
    assert ColumnOptions.of(T.StructField("v", STRING, True, {"other.key": 1})) == ColumnOptions()


def test_rows_without_usable_fields():
    with pytest.raises(ContractError):
        of(column("v", STRING, skip=True))
    with pytest.raises(ContractError):
        Contract.of(STRING)


def test_names_equal_ignoring_case_are_refused():
    with pytest.raises(ContractError, match="ignoring case"):
        of(column("id", LONG), column("ID", LONG))


def test_wide_decimals_are_refused():
    with pytest.raises(ContractError):
        TableColumn("huge", "BIGNUMERIC")
    with pytest.raises(ContractError):
        TableColumn("huge", "BIGNUMERIC", precision=76, scale=38)
    assert TableColumn("ok", "BIGNUMERIC", precision=38, scale=20).element_type() == T.DecimalType(38, 20)


# -- t_cover ----------------------------------------------------------------------------


def test_a_wider_schema_is_fine_and_a_narrower_one_names_all_missing():
    fields = (column("a", STRING), column("b", LONG), column("c", LONG))
    wide = of(*fields, columns=[TableColumn(n, "STRING" if n == "a" else "INTEGER") for n in "xabc"])
    assert [c.name for c in wide.columns] == list("xabc")
    with pytest.raises(ContractError, match="rows write b, c"):
        of(*fields, columns=[TableColumn("a", "STRING")])


# -- t_precedence, t_override_order, t_udt_mapping --------------------------------------


class Money(T.UserDefinedType):
    """Says itself what it becomes."""

    contract_type = "STRING"

    @classmethod
    def sqlType(cls):
        return INNER

    @classmethod
    def contract_value(cls, value):
        return F.concat_ws(":", value["A"], value["B"])


def test_a_time_option_and_an_override_of_its_type_contradict():
    override = Override(TS, "STRING", lambda c: c.cast("string"))
    with pytest.raises(ContractError, match="disagree"):
        of(column("at", TS, as_time="date"), overrides=[override])
    assert shape(of(column("at", TS), overrides=[override])) == [("at", "STRING", "NULLABLE")]


def test_registered_before_own_before_record():
    own = Money()
    assert shape(of(column("m", own)))[0][1] == "STRING"
    registered = Override(own, "BYTES", lambda c: c["A"].cast("binary"))
    assert shape(of(column("m", own), overrides=[registered]))[0][1] == "BYTES"
    struct = Override(INNER, "STRING", lambda c: c["A"])
    assert shape(of(column("m", INNER, record=True), overrides=[struct]))[0][1] == "STRING"


def test_last_registration_wins():
    first, second = Override(STRING, "STRING", F.lower), Override(STRING, "BYTES", lambda c: c.cast("binary"))
    assert shape(of(column("v", STRING), overrides=[first, second]))[0][1] == "BYTES"
    assert shape(of(column("v", T.ArrayType(STRING)), overrides=[first, second])) == [("v", "BYTES", "REPEATED")]


def test_refused_overrides():
    with pytest.raises(ContractError, match="no function"):
        Override(STRING, "STRING", None)
    with pytest.raises(ContractError, match="element type"):
        Override(T.ArrayType(STRING), "STRING", F.lower)
    with pytest.raises(ContractError, match="RECORD"):
        of(column("v", STRING), overrides=[Override(STRING, "RECORD", F.lower)])


def test_own_mapping_converts(spark):
    from tablecontract import conform

    df = spark.createDataFrame([(("x", 1),), (None,)], T.StructType([T.StructField("m", INNER)]))
    rows = conform(df, of(column("m", Money()))).collect()
    assert [r.m for r in rows] == ["x:1", None]


# -- t_layout_rules ---------------------------------------------------------------------


def test_layout_from_fields():
    layout = of(
        column("at", TS, required=True, partition="hour,require"),
        column("region", STRING, cluster=2),
        column("user", STRING, cluster=1),
    ).layout
    assert layout == Layout("at", "hour", True, ("user", "region"))
    assert of(column("at", TS, partition="")).layout.unit == "day"
    assert of(column("on", TS, as_time="date", partition="month")).layout.unit == "month"


def test_dropped_fields_carry_no_layout():
    assert of(column("a", STRING), column("b", DOUBLE, skip=True, cluster=1)).layout == Layout()


SHAPES = {
    "STRING": (STRING, {}), "INTEGER": (LONG, {}), "FLOAT": (DOUBLE, {}), "BYTES": (T.BinaryType(), {}), "JSON": (STRING, {"type": "JSON"}),
    "RECORD": (INNER, {"record": True}), "TIMESTAMP": (TS, {}), "DATE": (TS, {"as_time": "date"}), "DATETIME": (TS, {"as_time": "datetime"}), "TIME": (TS, {"as_time": "time"}),
}
#: By type: the units it can partition by, and whether it can cluster.
UNITS = {"TIMESTAMP": {"hour", "day", "month", "year"}, "DATETIME": {"hour", "day", "month", "year"}, "DATE": {"day", "month", "year"}}
ORDERED = {"STRING", "INTEGER", "TIMESTAMP", "DATE", "DATETIME", "TIME"}


@pytest.mark.parametrize("kind", SHAPES)
@pytest.mark.parametrize("repeated", [False, True])
def test_what_can_lay_out_a_table(kind, repeated):
    dtype, options = SHAPES[kind]
    dtype = T.ArrayType(dtype) if repeated else dtype

    def accepted(**layout):
        try:
            of(column("it", dtype, **options, **layout))
        except ContractError:
            return False
        return True

    for unit in ("hour", "day", "month", "year", "week"):
        assert accepted(partition=unit) == (not repeated and unit in UNITS.get(kind, ())), unit
    assert accepted(cluster=1) == (not repeated and kind in ORDERED)


def test_places_in_a_layout_are_taken_once_and_in_a_row():
    for places in ((1, 1), (1, 3), (2, 3)):
        with pytest.raises(ContractError):
            of(*[column(f"c{i}", STRING, cluster=p) for i, p in enumerate(places)])
    with pytest.raises(ContractError):
        of(*[column(n, TS, partition="month") for n in ("created", "changed")])


def test_five_clustering_columns_are_too_many():
    with pytest.raises(ContractError):
        of(*[column(n, STRING) for n in "abcde"], layout=Layout(cluster_by=tuple("abcde")))


# -- t_table_meta -----------------------------------------------------------------------


def test_labels():
    assert parse_labels("stage=,kind=raw") == {"stage": "", "kind": "raw"}
    for bad in ("team", "=x", "a=1,a=2", ""):
        with pytest.raises(ContractError):
            parse_labels(bad)


def test_one_place_says_what_a_table_is():
    field = column("at", TS, partition="day")
    kept = of(field, description="rows", labels="a=b", table=TableMetadata())
    assert (kept.description, dict(kept.labels)) == ("rows", {"a": "b"})
    for options in (
        {"description": "x", "table": TableMetadata(description="y")},
        {"labels": {"a": "b"}, "table": TableMetadata(labels={"c": "d"})},
        {"table": TableMetadata(layout=Layout("at"))},
    ):
        with pytest.raises(ContractError, match="both set"):
            of(field, **options)
    with pytest.raises(ContractError, match="clustering"):
        of(column("u", STRING, cluster=1), table=TableMetadata(layout=Layout(cluster_by=("u",))))


def test_descriptions_become_comments():
    schema = of(column("amount", LONG, description="billed, with tax")).spark_schema()
    assert schema["amount"].metadata == {"comment": "billed, with tax"}


# -- t_contract_from_table --------------------------------------------------------------


def test_a_dynamic_contract_from_stored_metadata():
    source = of(column("at", TS, required=True, partition="day"), column("r", INNER, record=True), description="d")
    again = Contract.from_json(source.to_json())
    assert again.is_dynamic and again.columns == source.columns
    assert (again.layout, again.description) == (source.layout, "d")
    for bad in ("", '{"columns": []}'):
        with pytest.raises(ContractError):
            Contract.from_json(bad)


def test_the_partition_column_is_taken():
    with pytest.raises(ContractError, match="_p"):
        of(column("_p", STRING))

"""From a field to its column: one place settles both the type and the conversion."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from . import types as ct
from .errors import ContractError
from .functions import jsontext, temporal
from .operators.promote import Candidate, promoted_fields
from .options import TIME_OPTIONS

Convert = Callable[[Column], Column]

# Spark's carrier of an unsigned 64 bit number.
UNSIGNED = T.DecimalType(20, 0)

_TIME_CONVERSIONS = {ct.DATE: temporal.to_date, ct.DATETIME: temporal.to_datetime, ct.TIME: temporal.to_time}


@dataclass(frozen=True)
class Override:
    """A registered mapping: values of ``source`` become ``target`` by ``convert``.

    It also covers repeated uses of the type. The function gets a column and
    returns one, so a built-in expression stays inside code generation; a pandas
    UDF works as well.
    """

    source: T.DataType
    target: str
    convert: Convert
    precision: int | None = None
    scale: int | None = None

    def __post_init__(self):
        if not callable(self.convert):
            raise ContractError(f"the override of {self.source.simpleString()} has no function")
        if isinstance(self.source, T.ArrayType):
            raise ContractError(
                "an override of an array type never applies; register the element type, which covers repeated columns"
            )


class Overrides:
    """Registered mappings by source type; the last registration of a type wins."""

    def __init__(self, overrides=()):
        self._latest_first = tuple(reversed(tuple(overrides)))

    def lookup(self, dtype: T.DataType) -> Override | None:
        same = (o for o in self._latest_first if type(o.source) is type(dtype) and ct.same_type(o.source, dtype))
        return next(same, None)


@dataclass(frozen=True)
class Mapping:
    """What one value of a field becomes; ``encoded`` JSON text is written here, so it needs no check."""

    type: str
    convert: Convert
    fields: tuple["Binding", ...] = ()
    precision: int | None = None
    scale: int | None = None
    encoded: bool = False


@dataclass(frozen=True)
class Binding:
    """A column together with the field it is written from."""

    column: ct.TableColumn
    candidate: Candidate
    element: T.DataType
    mapping: Mapping

    @property
    def is_plain(self) -> bool:
        """Carried over as it is, apart from a cast or an empty text becoming NULL."""
        return self.mapping.convert in (_identity, _raw_json) and not self.column.fields

    def value(self, at: Callable[[tuple[str, ...]], Column]) -> Column:
        """The column's value; ``at`` reads a path of the row or of an enclosing struct."""
        source = at(self.candidate.path)
        if self.column.repeated:
            return self._repeated(source, at)
        value = self.mapping.convert(source)
        if self.candidate.options.nullifzero:
            value = F.when(~F.coalesce(_is_zero(source, self.element), F.lit(False)), value)
        return value.cast(self.column.element_type()) if self.column.type != ct.RECORD else value

    def _repeated(self, source: Column, at) -> Column:
        target = self.column.element_type()
        dtype = self.element

        def element(x):
            value = self.mapping.convert(x)
            return value if self.column.type == ct.RECORD else value.cast(target)

        unchanged = dtype == target and self.mapping.convert is _identity
        value = source if unchanged else F.transform(source, element)
        if self.candidate.options.nullifzero:
            return F.when(F.size(source) > 0, value)
        value = F.coalesce(value, F.array().cast(T.ArrayType(target)))
        parents = [at(self.candidate.path[:n]) for n in range(1, self.candidate.depth)]
        for parent in parents:
            value = F.when(parent.isNotNull(), value)
        return value


def bind(schema: T.StructType, overrides: Overrides, zone: str) -> tuple[Binding, ...]:
    """The columns a row type writes, in declaration order."""
    bindings = tuple(_bind(c, overrides, zone) for c in promoted_fields(schema))
    if not bindings:
        raise ContractError("the row type has no usable field")
    ct.check_distinct([b.column for b in bindings], "the row type")
    return bindings


def _bind(candidate: Candidate, overrides: Overrides, zone: str) -> Binding:
    dtype, options = candidate.field.dataType, candidate.options
    repeated = isinstance(dtype, T.ArrayType)
    element = dtype.elementType if repeated else dtype
    try:
        mapping = _resolve(element, candidate, overrides, zone)
        column = ct.TableColumn(
            name=candidate.name,
            type=mapping.type,
            required=options.required and not repeated,
            repeated=repeated,
            fields=tuple(b.column for b in mapping.fields),
            description=options.description,
            precision=mapping.precision,
            scale=mapping.scale,
        )
    except ContractError as err:
        raise ContractError(f"field {candidate.field.name}: {err}") from None
    return Binding(column, candidate, element, mapping)


def _resolve(dtype, candidate: Candidate, overrides: Overrides, zone: str) -> Mapping:
    """Precedence: time option, registered, the type's own, time types, record, by type, JSON."""
    options = candidate.options
    if options.as_time:
        return _time_option(dtype, options, overrides, zone)
    registered = overrides.lookup(dtype)
    if registered:
        _refuse_record(registered.target, f"the override of {dtype.simpleString()}")
        return Mapping(registered.target, _keep_null(registered.convert), (), registered.precision, registered.scale)
    own = getattr(dtype, "contract_type", None)
    if own:
        _refuse_record(own, type(dtype).__name__)
        return Mapping(own, _keep_null(dtype.contract_value))
    timed = _TIME_TYPES.get(type(dtype))
    if timed:
        return Mapping(*timed)
    if options.record:
        if not isinstance(dtype, T.StructType):
            raise ContractError(f"the record option needs a struct, but the type is {dtype.simpleString()}")
        return _record(bind(dtype, overrides, zone))
    return _by_type(dtype, options)


def _time_option(dtype, options, overrides, zone) -> Mapping:
    if not isinstance(dtype, T.TimestampType):
        raise ContractError(f"the {options.as_time} option needs a timestamp, but the type is {dtype.simpleString()}")
    if overrides.lookup(dtype):
        raise ContractError(f"the {options.as_time} option and the override of timestamp disagree; drop one of them")
    target = TIME_OPTIONS[options.as_time]
    where = F.col(options.zone_column) if options.zone_column else options.zone or zone
    return Mapping(target, lambda c: _TIME_CONVERSIONS[target](c, where))


def _record(bindings) -> Mapping:
    def convert(struct: Column) -> Column:
        def at(path):
            value = struct
            for part in path:
                value = value.getField(part)
            return value

        return F.when(struct.isNotNull(), F.struct(*[b.value(at).alias(b.column.name) for b in bindings]))

    return Mapping(ct.RECORD, convert, bindings)


def _by_type(dtype, options) -> Mapping:
    if isinstance(dtype, T.StringType):
        if options.type == ct.JSON:
            return Mapping(ct.JSON, _raw_json)
        return Mapping(options.type or ct.STRING, _identity)
    if isinstance(dtype, T.DecimalType):
        return _decimal(dtype, options)
    plain = _PLAIN.get(type(dtype))
    if plain:
        return Mapping(plain, _identity)
    return _json(dtype)


def _decimal(dtype: T.DecimalType, options) -> Mapping:
    fits = dtype.scale <= ct.NUMERIC_SCALE and dtype.precision - dtype.scale <= ct.MAX_DIGITS - ct.NUMERIC_SCALE
    target = options.type or (ct.NUMERIC if fits else ct.BIGNUMERIC)
    precision, scale = options.precision, options.scale
    if target == ct.BIGNUMERIC and precision is None:
        precision, scale = dtype.precision, scale or dtype.scale
    return Mapping(target, _identity, (), precision, scale)


def _json(dtype) -> Mapping:
    if isinstance(dtype, T.MapType) and not isinstance(dtype.keyType, T.StringType):
        raise ContractError(f"a map needs string keys to become JSON, but the key is {dtype.keyType.simpleString()}")
    if isinstance(dtype, T.VariantType):
        return Mapping(ct.JSON, F.to_json, encoded=True)
    if isinstance(dtype, (T.StructType, T.MapType)):
        return Mapping(ct.JSON, lambda c: jsontext.to_json(jsontext.ready_for_json(c, dtype)), encoded=True)
    raise ContractError(f"unsupported type {dtype.simpleString()}")


def _refuse_record(target, what):
    if target == ct.RECORD:
        raise ContractError(f"{what} declares RECORD, whose fields cannot be derived")


def _identity(value: Column) -> Column:
    return value


def _raw_json(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _keep_null(convert: Convert) -> Convert:
    return lambda c: F.when(c.isNotNull(), convert(c))


_TIME_TYPES = {
    T.TimestampType: (ct.TIMESTAMP, _identity),
    T.TimestampNTZType: (ct.DATETIME, _identity),
    T.DateType: (ct.DATE, _identity),
}
if hasattr(T, "TimeType"):
    _TIME_TYPES[T.TimeType] = (ct.TIME, lambda c: temporal.time_of(F.concat(F.lit("0000-00-00 "), c.cast("string"))))

_PLAIN = {
    T.BooleanType: ct.BOOL,
    T.ByteType: ct.INTEGER,
    T.ShortType: ct.INTEGER,
    T.IntegerType: ct.INTEGER,
    T.LongType: ct.INTEGER,
    T.FloatType: ct.FLOAT,
    T.DoubleType: ct.FLOAT,
    T.BinaryType: ct.BYTES,
}


def _is_zero(value: Column, dtype: T.DataType) -> Column:
    """Zero in the sense of nullifzero; a NULL is not asked about at the top level.

    Bytes, maps and arrays are zero only when NULL, and a decimal only when it
    carries an unsigned number, since a decimal holding 0 is a value.
    """
    if isinstance(dtype, T.StringType):
        return value == ""
    if isinstance(dtype, T.BooleanType):
        return ~value
    if isinstance(dtype, T.NumericType):
        return value == 0 if dtype == UNSIGNED or not isinstance(dtype, T.DecimalType) else F.lit(False)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(value) == temporal.ZERO_TIMESTAMP_MICROS
    if isinstance(dtype, T.StructType):
        zero = F.lit(True)
        for f in dtype.fields:
            inner = value.getField(f.name)
            zero = zero & (inner.isNull() | F.coalesce(_is_zero(inner, f.dataType), F.lit(False)))
        return zero
    return F.lit(False)

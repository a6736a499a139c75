"""Schema differences over many tables at once, as a join of two descriptions.

A description has one row per table and column at any depth: ``table``, ``path`` (the names from the
top-level column down, as an array, so that a name may hold any character), ``type``, ``repeated``, ``required``
and ``seen``, which is true where values were looked at and no schema was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import types as ct
from ..sources.files import shared_folder

DESCRIPTION = "table string, path array<string>, type string, repeated boolean, required boolean, seen boolean"

#: Levels of records that one pass over the rows opens.
LEVELS = 3

# Contract types by variant type.
_CONTRACT_TYPE = {
    "STRING": ct.STRING,
    "BOOLEAN": ct.BOOL,
    "BIGINT": ct.INTEGER,
    "DOUBLE": ct.FLOAT,
    "FLOAT": ct.FLOAT,
    "DECIMAL": ct.NUMERIC,
    "BINARY": ct.BYTES,
    "TIMESTAMP": ct.TIMESTAMP,
    "DATE": ct.DATE,
    "TIMESTAMP_NTZ": ct.DATETIME,
    "OBJECT": ct.RECORD,
}


def describe(spark: SparkSession, tables: dict) -> DataFrame:
    """The columns of contracts or tables by table name."""

    def rows(table, columns, above):
        for c in columns:
            yield table, [*above, c.name], c.type, c.repeated, c.required, False
            yield from rows(table, c.fields, [*above, c.name])

    return spark.createDataFrame([r for table, columns in tables.items() for r in rows(table, columns, [])], DESCRIPTION)


def observe_entries(df: DataFrame, table: str, entries: str) -> DataFrame:
    """Describe what rows of maps of variants actually hold, per value of ``table``, at every depth; adds ``rows``.

    Records are opened level by level, ``LEVELS`` of them in one pass over the rows; what is counted is a path and a
    kind, partially before the shuffle. Rows with deeper records are gone through again for what lies below, until none is left. A
    column counts as REQUIRED when every row of its table, or every record it can stand in, has it. JSON null
    is no value; a list is REPEATED with the kind of its elements, and without elements it is REPEATED with no type
    unless other rows give it one. Kinds that disagree give one row each.
    """
    spark = df.sparkSession
    # Each row is a record that is opened, so that what it lacks can be told from what it has.
    path = F.array().cast("array<string>")
    whole = _cell(path, F.lit("OBJECT"), F.lit(False), F.lit(1), F.lit(None).cast("variant"))
    held = F.filter(F.array(F.col(entries)), lambda r: r.isNotNull())
    level = df.select(F.col(table).alias("table"), F.inline(F.concat(F.array(whole), _below(None, held, LEVELS))))
    parts = []
    while True:
        seen = level.groupBy("table", "path", "kind", "repeated").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("objects").alias("objects"), F.count("deeper").alias("deeper"))
        folder = shared_folder(spark, "audit")
        seen.write.mode("overwrite").parquet(folder)
        parts.append(spark.read.schema(seen.schema).parquet(folder))
        if parts[-1].where("deeper > 0").isEmpty():
            break
        level = level.where("deeper is not null").select("table", F.inline(_below(F.col("path"), _records(F.col("deeper")), LEVELS)))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return _described(found)


_RECORD, _LIST, _RECORDS = "map<string,variant>", "array<variant>", "array<map<string,variant>>"


def _read(value: Column, kind: str) -> Column:
    """A variant as a record or a list; null where it is none."""
    return F.try_variant_get(value, F.lit("$"), kind)


def _records(value: Column) -> Column:
    """The record that a variant is, or those among its elements."""
    record, items = _read(value, _RECORD), _read(value, _LIST)
    inside = F.filter(F.transform(items, lambda x: _read(x, _RECORD)), lambda r: r.isNotNull())
    return F.when(record.isNotNull(), F.array(record)).otherwise(F.coalesce(inside, F.array().cast(_RECORDS)))


def _cell(path: Column, kind: Column, repeated: Column, objects: Column, deeper: Column) -> Column:
    """What is known of a value; ``objects`` counts the records in it, ``deeper`` is the value itself where they are still to be opened."""
    return F.struct(path.alias("path"), kind.alias("kind"), repeated.alias("repeated"), objects.cast("long").alias("objects"), deeper.alias("deeper"))


def _below(path: Column | None, records: Column, levels: int) -> Column:
    """Cells of all fields of records at a path, and of the records in them, so many levels down."""

    def cells(e: Column) -> Column:
        name, count = F.array(e["key"]), F.size(e["records"])
        at = name if path is None else F.concat(path, name)
        # Names are part of a record's type text only, and those texts are not made.
        kind = F.when(count == 0, F.schema_of_variant(e["value"])).when(e["items"].isNull() | (count == F.size(e["items"])), F.lit("OBJECT")).otherwise(F.lit("VARIANT"))
        deeper = F.when(count > 0, e["value"]) if levels == 1 else F.lit(None).cast("variant")
        self = F.array(_cell(at, kind, e["items"].isNotNull(), count, deeper))
        return self if levels == 1 else F.when(count == 0, self).otherwise(F.concat(self, _below(at, e["records"], levels - 1)))

    def opened(e: Column) -> Column:
        return F.struct(e["key"].alias("key"), e["value"].alias("value"), e["items"].alias("items"), F.when(e["record"].isNotNull(), F.array(e["record"])).when(
            e["items"].isNotNull(), F.filter(F.transform(e["items"], lambda x: _read(x, _RECORD)), lambda r: r.isNotNull())).otherwise(F.array().cast(_RECORDS)).alias("records"))

    def looked(e: Column) -> Column:
        record = _read(e["value"], _RECORD)
        items = F.when(record.isNull(), F.filter(_read(e["value"], _LIST), lambda x: ~F.is_variant_null(x)))
        return F.struct(e["key"].alias("key"), e["value"].alias("value"), record.alias("record"), items.alias("items"))

    fields = F.flatten(F.transform(records, lambda r: F.map_entries(r)))
    return F.flatten(F.transform(F.transform(F.transform(fields, looked), opened), cells))


def _described(found: DataFrame) -> DataFrame:
    """Kinds by path as a description."""
    kind = F.regexp_extract("kind", r"^(?:ARRAY<)?([A-Z_]+)", 1)
    names = F.create_map(*[F.lit(x) for pair in _CONTRACT_TYPE.items() for x in pair])
    known = F.when(F.col("kind") != "VOID", F.coalesce(F.element_at(names, F.col("kind")), F.col("kind")))
    # A list without elements says that there is a list; a null says nothing.
    typed = found.withColumn("kind", kind).where("kind <> 'VOID' or repeated").select("table", "path", known.alias("type"), "repeated", "rows", "objects")
    typed = typed.groupBy("table", "path", "type", "repeated").agg(F.sum("rows").alias("rows"), F.sum("objects").alias("objects"))
    by_path = typed.groupBy("table", "path").agg(F.collect_list(F.struct("type", "repeated", "rows")).alias("kinds"), F.sum("objects").alias("objects"))
    above = F.slice("path", 1, F.size("path") - 1)
    up = by_path.select(F.col("table").alias("t"), F.col("path").alias("p"), F.col("objects").alias("stands_in"))
    kinds = by_path.where(F.size("path") > 0).withColumn("above", above).join(up, (F.col("table") == F.col("t")) & (F.col("above") == F.col("p")))
    typed_list = F.exists("kinds", lambda k: k["type"].isNotNull() & k["repeated"])
    empty_rows = F.aggregate(F.filter("kinds", lambda k: k["type"].isNull()), F.lit(0).cast("long"), lambda s, k: s + k["rows"])
    kept = F.filter("kinds", lambda k: k["type"].isNotNull() | ~F.col("typed_list"))
    rows = kinds.select("table", "path", "stands_in", typed_list.alias("typed_list"), empty_rows.alias("empty_rows"), "kinds")
    rows = rows.select("table", "path", "stands_in", "typed_list", "empty_rows", F.inline(kept))
    total = F.col("rows") + F.when(F.col("typed_list") & F.col("repeated"), F.col("empty_rows")).otherwise(0)
    return rows.select(
        "table", "path", "type", "repeated", (~F.col("repeated") & (F.col("rows") == F.col("stands_in"))).alias("required"), F.lit(True).alias("seen"), total.alias("rows"))


def audit(declared: DataFrame, observed: DataFrame) -> DataFrame:
    """Compare two descriptions: one row per table and top-level column, ``change`` saying what differs.

    ``added`` is declared but absent, ``removed`` present but undeclared,
    ``relaxed`` present as REQUIRED but declared NULLABLE; a ``conflict`` names
    the first thing no migration settles, and any difference inside a record is one. ``inside`` are the paths of such
    differences, names joined by dots. A field of a record that happens to be in every value looked at is no difference.
    """
    want = declared.select("table", "path", F.struct("type", "repeated", "required").alias("want"))
    got = observed.select("table", "path", F.struct("type", "repeated", "required", "seen").alias("got"))
    both = want.join(got, ["table", "path"], "full_outer").withColumn("nested", F.size("path") > 1)
    change = (
        F.when(F.col("got").isNull(), "added")
        .when(F.col("want").isNull(), "removed")
        .when(F.col("want.type") != F.col("got.type"), "conflict: type")
        .when(F.col("want.repeated") != F.col("got.repeated"), "conflict: repeated")
        .when(F.col("want.required") & ~F.col("got.required"), "conflict: required")
        .when(~F.col("want.required") & F.col("got.required") & ~(F.col("nested") & F.col("got.seen")), "relaxed")
        .otherwise("same")
    )
    rows = both.select("table", F.col("path")[0].alias("name"), "nested", "path", F.col("want.type").alias("declared"), F.col("got.type").alias("found"), change.alias("change"))
    differs = F.when(F.col("nested") & (F.col("change") != "same"), F.array_join("path", "."))
    tops = rows.groupBy("table", "name").agg(
        F.collect_list(F.when(~F.col("nested"), F.struct("declared", "found", "change"))).alias("tops"), F.sort_array(F.collect_set(differs)).alias("inside"))
    flat = tops.select("table", F.col("name").alias("path"), "inside", F.inline("tops"))
    # Below a column that is new, gone or of another type there is nothing to compare.
    open_ = F.col("change").isin("same", "relaxed", "conflict: required") & (F.col("found") == ct.RECORD)
    inside = F.when(open_, F.col("inside")).otherwise(F.array().cast("array<string>"))
    nested = open_ & (F.size("inside") > 0) & ~F.col("change").startswith("conflict")
    return flat.select("table", "path", "declared", "found", F.when(nested, "conflict: nested").otherwise(F.col("change")).alias("change"), inside.alias("inside"))

"""Table columns that change with their source: wider types, and new fields inside structs.

Parquet files keep the types they were written with; a reader that asks for a wider type gets it from
old and new files alike, and null for a struct's fields that a file does not have. So widening a
table changes its catalogue entry alone, no file is written again.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: What files of a type can be read as without loss, besides the type itself.
_READ_AS = {
    T.ByteType: (T.ShortType, T.IntegerType, T.LongType, T.DoubleType),
    T.ShortType: (T.IntegerType, T.LongType, T.DoubleType),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
}


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether files of the atomic type ``narrow`` can be read as ``wide`` without loss."""
    if wide == narrow:
        return True
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return isinstance(wide, _READ_AS.get(type(narrow), ()))


def merged(old: T.DataType, new: T.DataType, name: str) -> T.DataType:
    """The type of a column ``name`` that takes values of both types.

    Structs keep their fields in order and get new ones at the end; arrays and maps are merged by
    element and value, with equal keys. Types that do not hold one another are refused, since one of
    the two would lose values.
    """
    if old == new or isinstance(new, T.NullType):
        return old
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merged_struct(old, new, f"{name}.")
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(merged(old.elementType, new.elementType, f"{name}.element"), True)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        # maps are built by key, so a key that changes its type could make two keys one
        if old.keyType != new.keyType:
            raise ValueError(f"{name}.key is {old.keyType.simpleString()}, not {new.keyType.simpleString()}")
        return T.MapType(old.keyType, merged(old.valueType, new.valueType, f"{name}.value"), True)
    if holds(new, old):
        return new
    if holds(old, new):
        return old
    raise ValueError(f"{name} is {old.simpleString()} and cannot take {new.simpleString()}")


def merged_struct(old: T.StructType, new: T.StructType, prefix: str = "") -> T.StructType:
    """``old`` with its fields widened by those of ``new``, and the fields that it lacks at the end.
    Names are told apart as Spark does by default, without regard to case."""
    coming = {f.name.lower(): f for f in new}
    fields = [T.StructField(f.name, merged(f.dataType, coming[f.name.lower()].dataType, prefix + f.name))
              if f.name.lower() in coming else T.StructField(f.name, f.dataType) for f in old]
    known = {f.name.lower() for f in old}
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in new if f.name.lower() not in known])


def shaped(value: Column, have: T.DataType, want: T.DataType, name: str = "") -> Column:
    """``value`` as type ``want``, struct fields matched by name instead of by place. Fields it lacks
    are null, a null struct stays null, fields that ``want`` lacks are refused."""
    if have == want:
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name.lower(): f for f in have}
        extra = own.keys() - {f.name.lower() for f in want}
        if extra:
            raise ValueError(f"{name} has no field {', '.join(sorted(extra))}")
        parts = [shaped(value.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType,
                        f"{name}.{f.name}") if f.name.lower() in own else F.lit(None).cast(f.dataType) for f in want]
        built = F.struct(*[p.alias(f.name) for p, f in zip(parts, want)])
        return F.when(value.isNotNull(), built)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(value, lambda x: shaped(x, have.elementType, want.elementType, f"{name}.element"))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType) and have.keyType == want.keyType:
        return F.transform_values(value, lambda _, x: shaped(x, have.valueType, want.valueType, f"{name}.value"))
    return value.cast(want)


def widen(spark: SparkSession, table: str, schema: T.StructType, partition_by: tuple[str, ...] = ()) -> bool:
    """Give the catalogue's ``table`` wider columns and new ones, as in ``schema``; whether it changed.

    One change of the catalogue entry, so readers see the old types or all new ones. Values of
    partition columns are names of folders; their types stay, and values that they do not hold are
    refused. SQL has no statement for another type of a Parquet table's column, so the session's
    catalogue is asked directly.
    """
    now = spark.table(table).schema
    then = merged_struct(now, schema)
    if [(f.name, f.dataType) for f in now] == [(f.name, f.dataType) for f in then]:
        return False
    for name in partition_by:
        if now[name].dataType != then[name].dataType:
            raise ValueError(f"{table} is partitioned by {name}: {now[name].dataType.simpleString()} stays")
    session = spark._jsparkSession
    data = T.StructType([f for f in then if f.name not in partition_by])
    session.sessionState().catalog().alterTableDataSchema(
        session.sessionState().sqlParser().parseTableIdentifier(table),
        spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json()))
    spark.catalog.refreshTable(table)
    return True

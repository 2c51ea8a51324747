"""Field declarations: which kind a column is and how its text is analysed.

A declaration is stored as column metadata, so it travels with the DataFrame
and survives a Parquet round trip without a side file.
"""

from __future__ import annotations

import datetime as dt
import ipaddress
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textquarry.errors import FieldError, LiteralError

TEXT, STRING, BOOL, I64, U64, F64 = "text", "string", "bool", "i64", "u64", "f64"
DATE, BYTES, FACET, JSON, IP = "date", "bytes", "facet", "json", "ip"

#: Which Spark types may carry each kind (fixed values).
SPARK_TYPES = {
    TEXT: (T.StringType,),
    STRING: (T.StringType,),
    BOOL: (T.BooleanType,),
    I64: (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
    U64: (T.DecimalType,),
    F64: (T.FloatType, T.DoubleType),
    DATE: (T.TimestampType, T.TimestampNTZType, T.DateType),
    BYTES: (T.BinaryType,),
    FACET: (T.StringType,),
    JSON: (T.StringType, T.VariantType),
    IP: (T.StringType,),
}

#: Kinds that can be ordered by, ranged over and paged through (fixed values).
RANGE_KINDS = (TEXT, STRING, I64, U64, F64, DATE, BYTES)
SORT_KINDS = (TEXT, STRING, BOOL, I64, U64, F64, DATE)
CURSOR_KINDS = (TEXT, STRING, I64, U64, F64, DATE)
CONCAT_KINDS = (TEXT, STRING, BOOL, I64, U64, F64, FACET, IP)
TABLE_SET_KINDS = (STRING, BOOL, I64, U64, F64, DATE, BYTES)
NUMERIC_KINDS = (I64, U64, F64)

METADATA_KEY = "textquarry"


@dataclass(frozen=True)
class FieldSpec:
    """One field: ``kind`` plus, for text, the name of its analyzer."""

    name: str
    kind: str
    analyzer: str = "default"
    data_type: T.DataType | None = None

    @property
    def multi(self) -> bool:
        return isinstance(self.data_type, T.ArrayType)

    @property
    def element_type(self) -> T.DataType:
        return self.data_type.elementType if self.multi else self.data_type

    @property
    def column(self) -> Column:
        return F.col(f"`{self.name}`")

    def values(self) -> Column:
        """The field as an array of its non-null values (empty when missing)."""
        arr = self.column if self.multi else F.array(self.column)
        return F.coalesce(F.array_compact(arr), F.array().cast(T.ArrayType(self.element_type)))

    def first(self) -> Column:
        """The value a sort sees: the only one, or the first of several."""
        return F.get(self.column, F.lit(0)) if self.multi else self.column

    def any_value(self, test) -> Column:
        """``test`` holds for at least one value; NULL counts as no value."""
        return F.exists(self.column, lambda v: test(v)) if self.multi else test(self.column)

    def metadata(self) -> dict:
        return {METADATA_KEY: {"kind": self.kind, "analyzer": self.analyzer}}


def text(analyzer: str = "default") -> FieldSpec:
    """Declare an analysed text field."""
    return FieldSpec("", TEXT, analyzer)


def of_kind(kind: str) -> FieldSpec:
    """Declare a field of any other kind."""
    if kind not in SPARK_TYPES:
        raise FieldError(f"unknown field kind {kind!r}")
    return FieldSpec("", kind)


def infer_kind(data_type: T.DataType) -> str | None:
    """The kind a column gets when none is declared; None leaves it payload-only."""
    base = data_type.elementType if isinstance(data_type, T.ArrayType) else data_type
    if isinstance(base, T.DecimalType):
        return U64 if base.scale == 0 else None
    for kind in (STRING, BOOL, I64, F64, DATE, BYTES):
        if isinstance(base, SPARK_TYPES[kind]):
            return kind
    return JSON if isinstance(base, T.VariantType) else None


def resolve_fields(schema: T.StructType, declared: dict[str, FieldSpec | str]) -> dict[str, FieldSpec]:
    """Merge declarations, stored metadata and inference into one spec per column."""
    unknown = [n for n in declared if n not in schema.names]
    if unknown:
        raise FieldError(f"declared fields are not columns: {unknown}")
    specs = {}
    for f in schema.fields:
        if not f.name:
            raise FieldError("field name must not be empty")
        want = declared.get(f.name)
        if isinstance(want, str):
            want = of_kind(want)
        if want is None and METADATA_KEY in (f.metadata or {}):
            stored = f.metadata[METADATA_KEY]
            want = FieldSpec("", stored["kind"], stored["analyzer"])
        if want is None:
            kind = infer_kind(f.dataType)
            if kind is None:
                continue
            want = FieldSpec("", kind)
        spec = FieldSpec(f.name, want.kind, want.analyzer, f.dataType)
        if not isinstance(spec.element_type, SPARK_TYPES[spec.kind]):
            raise FieldError(f"column {f.name!r} of type {f.dataType.simpleString()} cannot be a {spec.kind} field")
        specs[f.name] = spec
    return specs


def _epoch_micros(value: dt.datetime) -> int:
    if value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return (value - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def from_millis(millis: int) -> dt.datetime:
    """Epoch milliseconds to a UTC datetime; exact before 1970 too."""
    return dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=millis)


def literal(spec: FieldSpec, value) -> Column:
    """``value`` as a literal of the field's type, or an error: never a silent cast."""
    kind, fits = spec.kind, False
    is_int = isinstance(value, int) and not isinstance(value, bool)
    if kind in (TEXT, STRING, FACET):
        fits = isinstance(value, str)
    elif kind == BOOL:
        fits = isinstance(value, bool)
    elif kind == I64:
        fits = is_int and -(2**63) <= value < 2**63
    elif kind == U64:
        fits = is_int and 0 <= value < 2**64
        if fits:
            return F.lit(str(value)).cast(T.DecimalType(20, 0))
    elif kind == F64:
        fits = isinstance(value, float)
    elif kind == BYTES:
        fits = isinstance(value, (bytes, bytearray))
        value = bytearray(value) if fits else value
    elif kind == DATE and isinstance(value, dt.datetime):
        micros = _epoch_micros(value)
        if isinstance(spec.element_type, T.TimestampType):
            return F.timestamp_micros(F.lit(micros))
        wall = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)
        return F.lit(wall.isoformat(sep=" ")).cast(T.TimestampNTZType())
    elif kind == IP and isinstance(value, str):
        return F.lit(canonical_ip(value))
    if not fits:
        raise LiteralError(f"{value!r} is not a {kind} value (field {spec.name!r})")
    return F.lit(value)


def canonical_ip(value: str) -> str:
    """Canonical text of an address; an IPv4-mapped IPv6 address becomes IPv4."""
    try:
        ip = ipaddress.ip_address(value)
    except ValueError as e:
        raise LiteralError(f"invalid ip address {value!r}") from e
    mapped = getattr(ip, "ipv4_mapped", None)
    return str(mapped or ip)

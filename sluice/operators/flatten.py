"""Flattening of JSON documents into rows of text columns."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.naming import column_names
from sluice.session import durable, plain_unions, staged
from sluice.types import RuleViolation, Split

ROOT = "/root"
# Fields of the largest merged document type that is worked with.
MOST_FIELDS = 10_000


def split_json(df: DataFrame, col: str) -> Split:
    """Rows whose text is a JSON document, and the others (nulls are others)."""
    good = F.try_parse_json(F.col(col)).isNotNull()
    return Split(df.where(good), df.where(~good))


@dataclass
class Shape:
    """What the documents hold at one path: any of fields, list elements and scalars."""

    fields: dict[str, Shape] = field(default_factory=dict)
    element: Shape | None = None
    scalar: bool = False
    # Documents disagree, and what they hold is not known yet.
    open: bool = False

    @property
    def kinds(self) -> int:
        return bool(self.fields) + (self.element is not None) + self.scalar

    def add(self, t: T.DataType) -> Shape:
        if isinstance(t, T.StructType):
            for f in t:
                self.fields.setdefault(f.name, Shape()).add(f.dataType)
        elif isinstance(t, T.ArrayType):
            self.element = (self.element or Shape()).add(t.elementType)
        elif isinstance(t, T.VariantType):
            self.open = True
        else:
            self.scalar = True
        return self

    def type(self) -> T.DataType:
        """What a value is read as: text for scalars, a variant where it may be of several kinds."""
        if self.kinds > 1 or self.open:
            return T.VariantType()
        if self.fields:
            return T.StructType([T.StructField(k, v.type()) for k, v in self.fields.items()])
        return T.ArrayType(self.element.type()) if self.element is not None else T.StringType()

    def count(self) -> int:
        return sum(1 + f.count() for f in self.fields.values()) + (self.element.count() if self.element else 0)

    def unknown(self, steps: tuple = ()) -> list[tuple[tuple, Shape]]:
        """The open places below, by the keys that lead there; None is a step into a list."""
        found = [(steps, self)] if self.open else []
        for key, inner in self.fields.items():
            found += inner.unknown((*steps, key))
        return found + (self.element.unknown((*steps, None)) if self.element is not None else [])

    def paths(self, path: str = ROOT) -> list[str]:
        """The path of every key, containers included; elements share the path of their list."""
        own = [p for key, inner in self.fields.items() for p in (f"{path}/{key}", *inner.paths(f"{path}/{key}"))]
        return own + [p for p in (self.element.paths(path) if self.element is not None else []) if p not in own]

    def leaves(self, path: str = ROOT) -> list[str]:
        """The paths of scalars, in order."""
        inner = [p for key, f in self.fields.items() for p in f.leaves(f"{path}/{key}")]
        inner += self.element.leaves(path) if self.element is not None else []
        return [path] * self.scalar + inner


def _ddl(t: T.DataType) -> str:
    """The text of a type, with every field name quoted."""
    if isinstance(t, T.StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in t) + ">"
    return f"array<{_ddl(t.elementType)}>" if isinstance(t, T.ArrayType) else t.simpleString()


def _kind(v: Column) -> Column:
    """object, array or the name of a scalar type."""
    return F.split(F.lower(F.schema_of_variant(v)), "<")[0]


def _values_at(v: Column, steps: tuple) -> Column:
    """The variants at a place, as an array; places within lists may hold many."""
    if None not in steps:
        return F.array(_inside(v, steps, "variant"))
    first = steps.index(None)
    listed = F.coalesce(_inside(v, steps[:first], "array<variant>"), F.array().cast("array<variant>"))
    return F.flatten(F.transform(listed, lambda x: _values_at(x, steps[first + 1 :])))


def _inside(v: Column, keys: tuple, kind: str) -> Column:
    quoted = [("['%s']" if "'" not in k else '["%s"]') % k for k in keys]
    return F.try_variant_get(v, "$" + "".join(quoted), kind)


def _merged(ddl: str | None) -> T.DataType | None:
    return None if ddl is None else T.DataType.fromDDL(ddl.replace("OBJECT<", "STRUCT<"))


def document_shape(docs: DataFrame, most_fields: int = MOST_FIELDS) -> Shape:
    """The shape of all documents, given as variants ``v``: one aggregate with one result row.

    Where documents disagree about a path, their objects and lists there are merged by a further aggregate,
    one for each level of disagreement. Documents with ids or dates as keys have as many fields as those:
    beyond ``most_fields`` such a shape is refused, and a schema has to be given.
    """
    shape = Shape()
    found = _merged(docs.agg(F.schema_of_variant_agg("v")).first()[0])
    if found is not None:
        shape.add(found)
    while True:
        if shape.count() > most_fields:
            raise RuleViolation(f"documents have {shape.count()} fields; give a schema")
        places = shape.unknown()
        if not places:
            return shape
        held = F.array(*[F.struct(F.lit(i).alias("place"), _values_at(F.col("v"), steps).alias("values")) for i, (steps, _) in enumerate(places)])
        values = docs.select(F.inline(held)).select("place", F.explode("values").alias("v")).where("v IS NOT NULL").withColumn("kind", _kind(F.col("v")))
        merged = values.groupBy("place").agg(*[
            F.schema_of_variant_agg(F.when(F.col("kind") == kind, F.col("v"))).alias(kind) for kind in ("object", "array")
        ], F.bool_or(~F.col("kind").isin("object", "array", "void")).alias("scalar")).collect()
        for _, place in places:
            place.open = False
        for r in merged:
            place = places[r["place"]][1]
            place.scalar |= r["scalar"]
            for kind in ("object", "array"):
                t = _merged(r[kind])
                if isinstance(t, (T.StructType, T.ArrayType)):
                    place.add(t)


def document_schema(df: DataFrame, col: str, most_fields: int = MOST_FIELDS) -> T.DataType:
    """Merged type of all documents of a text column, scalars as text; a variant where documents disagree."""
    return document_shape(df.select(F.try_parse_json(F.col(col)).alias("v")), most_fields).type()


def json_paths(df: DataFrame, col: str) -> DataFrame:
    """Rows (path, type): every field path that occurs in any document, with each of its types.

    Types are object, array or the name of a scalar type. Documents are taken apart one
    level at a time, so paths are found below a key that is a scalar elsewhere; elements
    of a list share the path of the list.
    """
    spark, kind = df.sparkSession, _kind(F.col("v"))
    plain_unions(spark)
    level = df.select(F.lit(ROOT).alias("path"), F.try_parse_json(F.col(col)).alias("v")).where("v IS NOT NULL")
    found = None
    while True:
        # Only objects and lists go on to the next level; of the scalars the distinct paths are all that is kept.
        level = durable(level)
        if level.isEmpty():
            empty = spark.createDataFrame([], "path string, type string")
            return (empty if found is None else found).distinct()
        inside = level.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        named = F.when(F.col("key").isNotNull(), F.concat_ws("/", "path", "key")).otherwise(F.col("path"))
        children = inside.select(named.alias("path"), F.col("key").isNotNull().alias("own"), F.col("value").alias("v")).withColumn("type", kind)
        here = children.where("own").select("path", "type").distinct()
        found = here if found is None else found.union(here)
        level = children.where("type IN ('object', 'array')").select("path", "v")


def _as(kind: str, v: Column) -> Column:
    """The variant where it is of a kind, else null."""
    own = _kind(v)
    here = ~own.isin("object", "array", "void") if kind == "scalar" else own == kind
    return F.when(v.isNotNull() & here, v)


def _views(c: Column, s: Shape) -> tuple[Column | None, Column | None, Column | None]:
    """A value as object, list and scalar text, each where it is one."""
    if s.kinds <= 1:
        return (c if s.fields else None), (c if s.element is not None else None), (c if s.scalar else None)
    as_object = Shape(fields=s.fields).type() if s.fields else None
    as_list = T.ArrayType(s.element.type()) if s.element is not None else None
    read = lambda kind, t: None if t is None else F.try_variant_get(_as(kind, c), "$", _ddl(t))
    return read("object", as_object), read("array", as_list), (F.try_variant_get(_as("scalar", c), "$", "string") if s.scalar else None)


def flatten_json(
    df: DataFrame,
    col: str,
    schema: T.DataType | str | None = None,
    naming: str = "custom",
    remove: Sequence[str] = (),
    update: Sequence[str] = (),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per document and one per element of every list in it, all columns text.

    A list element's row carries the scalars of everything around it. A path that is an object or a list in
    some documents and a scalar in others gives both: ``{"a": 1}`` and ``{"a": {"b": 2}}`` have ``a`` and ``a/b``.
    Rows without any value are dropped, equal rows are merged. Documents are parsed once. Without ``schema``
    they are written to the shared folder as variants, and their shape is found first, by one aggregate and
    one more per level of disagreement. ``keep`` names columns to carry along.
    """
    docs = df.select(*keep, F.try_parse_json(F.col(col)).alias("v")).where("v IS NOT NULL")
    if schema is None:
        docs = staged(docs, "documents")
        shape = document_shape(docs)
    else:
        shape = Shape().add(T.DataType.fromDDL(schema) if isinstance(schema, str) else schema)
    names = column_names(shape.paths() or [ROOT], naming, remove, update)

    def label(path: str) -> str:
        return names.get(path, path.rsplit("/", 1)[-1].lower())

    columns = list(dict.fromkeys(map(label, shape.leaves()))) or [label(ROOT)]
    row_type = T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    nothing = F.array().cast(row_type)

    def record(values: dict[str, Column]) -> Column:
        by_name: dict[str, list[Column]] = {}
        for path, c in values.items():
            by_name.setdefault(label(path), []).append(c)
        cells = [
            (F.coalesce(*by_name[n]) if n in by_name else F.lit(None).cast("string")).alias(n) for n in columns
        ]
        return F.array(F.struct(*cells))

    def taken_apart(c: Column, s: Shape, path: str) -> tuple[dict[str, Column], list[tuple[str, Column, Shape]]]:
        """Scalars and lists reachable through objects."""
        as_object, as_list, text = _views(c, s)
        scalars = {path: text} if text is not None else {}
        lists = [(path, as_list, s.element)] if as_list is not None else []
        if as_object is not None:
            for key, inner in s.fields.items():
                more = taken_apart(as_object.getField(key), inner, f"{path}/{key}")
                scalars |= more[0]
                lists += more[1]
        return scalars, lists

    def records(c: Column, s: Shape, path: str, around: dict[str, Column]) -> Column:
        scalars, lists = taken_apart(c, s, path)
        own = around | scalars
        parts = [
            F.coalesce(F.flatten(F.transform(listed, each(element, list_path, own))), nothing) for list_path, listed, element in lists
        ]
        # A list has no row of its own where nothing else may stand in its place.
        if s.fields or s.scalar or s.element is None:
            parts.append(record(own))
        return F.concat(*parts) if len(parts) > 1 else parts[0]

    def each(element: Shape, path: str, around: dict[str, Column]):
        return lambda item: records(item, element, path, around)

    kind = shape.type()
    whole = F.col("v") if isinstance(kind, T.VariantType) else F.try_variant_get(F.col("v"), "$", _ddl(kind))
    rows = docs.select(*keep, whole.alias("_doc")).select(*keep, F.explode(records(F.col("_doc"), shape, ROOT, {})).alias("_row"))
    flat = rows.select(*keep, *[F.col("_row").getField(c).alias(c) for c in columns])
    return flat.where(F.coalesce(*[F.col(f"`{c}`") for c in columns]).isNotNull()).dropDuplicates()

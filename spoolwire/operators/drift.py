"""Records held against the schema that was declared for them: fields that are new, absent or of another type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spoolwire.functions.json import parse_json_any

#: Objects are looked into this deep.
DEPTH = 4


def declared_fields(schema: T.StructType, prefix: str = "$") -> dict[str, str]:
    """``{path: JSON type}`` of a declared schema; a struct's own path is an OBJECT."""
    out = {}
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        out[path] = _json_type(f.dataType)
        if isinstance(f.dataType, T.StructType):
            out.update(declared_fields(f.dataType, path))
    return out


def _json_type(t: T.DataType) -> str:
    if isinstance(t, T.StructType | T.MapType):
        return "OBJECT"
    if isinstance(t, T.ArrayType):
        return "ARRAY"
    if isinstance(t, T.BooleanType):
        return "BOOLEAN"
    if isinstance(t, T.IntegralType):
        return "BIGINT"
    return "NUMBER" if isinstance(t, T.NumericType) else "STRING"


def _kind(value: Column) -> Column:
    """JSON type of a variant: OBJECT, ARRAY, STRING, BOOLEAN, BIGINT, NUMBER, or VOID for a JSON null."""
    t = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    return F.when(t.isin("DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(t)


def record_fields(topic_df: DataFrame, column: str = "value", depth: int = DEPTH) -> DataFrame:
    """One row per field of every JSON object record: ``partition, offset, path, type``; ``$`` is the record itself.

    Objects are opened level by level, ``depth`` deep; arrays aren't. A record
    that is not JSON has the type ``MALFORMED``. One scan, no shuffle.
    """
    spark = topic_df.sparkSession
    text = F.col(column).cast("string")
    rows = topic_df.select("partition", "offset", F.lit("$").alias("path"), parse_json_any(text).alias("v"), F.lit(True).alias("new"))
    for _ in range(depth):
        inside = F.when(F.col("new") & (_kind(F.col("v")) == "OBJECT"), F.col("v"))
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(inside.outer()))
        own = F.struct("path", "v", F.lit(False).alias("new"))
        field = F.struct(F.concat("path", F.lit("."), F.col("key")).alias("path"), F.col("value").alias("v"), F.lit(True).alias("new"))
        # the object itself comes along with its first field
        both = F.when(F.col("pos").isNull(), F.array(own)).when(F.col("pos") == 0, F.array(own, field)).otherwise(F.array(field))
        rows = rows.select("partition", "offset", F.inline(both))
    kind = F.when(F.col("v").isNull(), "MALFORMED").otherwise(_kind(F.col("v")))
    return rows.select("partition", "offset", "path", kind.alias("type"))


def schema_drift(topic_df: DataFrame, schema: T.StructType, column: str = "value", depth: int = DEPTH) -> DataFrame:
    """How records differ from a declared schema: ``partition, path, drift, declared, found, records, first_offset``.

    ``drift`` is ``added`` (a field that isn't declared), ``missing`` (a
    declared field that a record, or the object that should hold it, does not
    have), or ``changed`` (a declared field of another JSON type; the path ``$``
    stands for records that are no object, or not JSON at all). A JSON null fits any type, a whole
    number fits a fractional one. Counts are per topic partition, aggregated
    before the shuffle. Offsets are those of the first record of each kind.
    """
    declared = declared_fields(schema)
    wanted = F.create_map(*[F.lit(x) for p, t in [("$", "OBJECT"), *declared.items()] for x in (p, t)])
    found = record_fields(topic_df, column, depth).withColumn("declared", wanted[F.col("path")])
    fits = F.col("type").isin("VOID") | (F.col("type") == F.col("declared")) | ((F.col("type") == "BIGINT") & (F.col("declared") == "NUMBER"))
    drift = F.when(F.col("declared").isNull(), "added").when((F.col("path") == "$") & (F.col("type") == "VOID"), "changed").when(~fits, "changed")
    there = found.withColumn("drift", drift).where("drift is not null").groupBy("partition", "path", "drift", "declared", F.col("type").alias("found"))
    figures = [F.count(F.lit(1)).alias("records"), F.min("offset").alias("first_offset")]
    there = there.agg(*figures)
    # a record's declared fields that it doesn't have, one row each
    json = parse_json_any(F.col(column).cast("string"))
    records = topic_df.select("partition", "offset", json.alias("v"))
    nested = {p: t for p, t in declared.items() if p.rpartition(".")[0].count(".") < depth}
    parents = {p: p.rpartition(".")[0] for p in nested}
    keys = {parent: F.json_object_keys(F.get_json_object(F.to_json("v"), parent)) for parent in set(parents.values())}
    lacks = [
        F.when(~F.coalesce(F.array_contains(keys[parents[p]], p.rpartition(".")[2]), F.lit(False)), F.struct(F.lit(p).alias("path"), F.lit(t).alias("declared")))
        for p, t in nested.items()
    ]
    empty = F.array().cast("array<struct<path:string,declared:string>>")
    rows = records.select("partition", "offset", F.explode(F.array_compact(F.array(*lacks)) if lacks else empty).alias("l"))
    absent = rows.groupBy("partition", F.col("l.path").alias("path"), F.lit("missing").alias("drift"), F.col("l.declared").alias("declared"), F.lit(None).cast("string").alias("found"))
    return there.unionByName(absent.agg(*figures))

"""Trees of scales: nested JSON to placements and back."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.model import Model

SCALE_COLUMNS = {"scale_id": "bigint", "scale_name": "string", "scale_construct_name": "string", "scale_depth": "bigint", "scale_id_path": "array<bigint>", "scale_name_path": "array<string>"}
INNERMOST = "array<string>"  # of the level below the last: must stay empty


def tree_schema(item: Model, depth: int, meta: Model | None = None) -> str:
    """The struct of a tree of ``depth`` levels of scales."""
    own = f"id: bigint, scale_name: string, construct_name: string, items: array<{item.wire_schema()}>"
    below = INNERMOST
    for _ in range(depth):
        below = f"array<struct<{own}, subscales: {below}>>"
    more = f", meta: {meta.wire_schema()}" if meta else ""
    return f"struct<scales: {below}, orphan_items: array<{item.wire_schema()}>, unscaled_items: array<{item.wire_schema()}>{more}>"


def tree_depth(docs: DataFrame, tree: str) -> int:
    """Levels of scales in the deepest tree, from the one schema that all trees share: a single aggregate."""
    found = docs.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(tree).cast("string"))).alias("s")).first()["s"] or ""
    open_, levels, deepest = [], 0, 0  # whether each open bracket belongs to a list of scales
    for name, mark in re.findall(r"(?:([A-Za-z0-9_]+): ARRAY(?=<OBJECT))?(<|>)", found):
        if mark == "<":
            open_.append(name in ("scales", "subscales"))
            levels += open_[-1]
            deepest = max(deepest, levels)
        elif open_:
            levels -= open_.pop()
    return deepest


def _placements(node: Column, item: Model, ids: Column, names: Column, depth: int, left: int) -> Column:
    """A node's own items, then those of its subscales, as one array; ``left`` levels may follow below."""
    some = lambda c, kind: F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array().cast(kind))
    items = F.filter(node["items"], lambda x: x.isNotNull())
    own = F.transform(items, lambda x: F.struct(
        F.lit("scaled").alias("bucket"), node["id"].alias("scale_id"), node["scale_name"].alias("scale_name"), node["construct_name"].alias("scale_construct_name"),
        F.lit(depth).cast("bigint").alias("scale_depth"), ids.alias("scale_id_path"), names.alias("scale_name_path"), item.resolved(x).alias("item")))
    own = F.coalesce(own, F.array().cast(_placed(item)))
    if not left:
        deeper = F.size(some(node["subscales"], INNERMOST)) > 0
        return F.when(deeper, F.raise_error(F.lit(f"a tree is deeper than {depth} levels")).cast(_placed(item))).otherwise(own)
    below = F.transform(F.filter(node["subscales"], lambda x: x.isNotNull()), lambda n: _placements(n, item, F.array_append(ids, n["id"]), F.array_append(names, n["scale_name"]), depth + 1, left - 1))
    return F.concat(own, F.coalesce(F.flatten(below), F.array().cast(_placed(item))))


def _placed(item: Model) -> str:
    return f"array<struct<bucket: string, {', '.join(f'{k}: {v}' for k, v in SCALE_COLUMNS.items())}, item: {item.schema()}>>"


def _all_placements(parsed: Column, item: Model, depth: int) -> Column:
    """All placements of a document in order: scales in pre-order, then orphans, then unscaled items."""
    one = lambda n: _placements(n, item, F.array(n["id"]), F.array(n["scale_name"]), 1, depth - 1)
    loose = lambda bucket: F.transform(F.filter(parsed[f"{bucket}_items"], lambda x: x.isNotNull()), lambda x: F.struct(
        F.lit(bucket).alias("bucket"), *(F.lit(None).cast(v).alias(k) for k, v in SCALE_COLUMNS.items()), item.resolved(x).alias("item")))
    parts = [F.flatten(F.transform(F.filter(parsed["scales"], lambda x: x.isNotNull()), one))] if depth else []
    parts += [loose("orphan"), loose("unscaled")]
    return F.concat(*(F.coalesce(x, F.array().cast(_placed(item))) for x in parts))


def explode_trees(docs: DataFrame, key: str, tree: str, item: str | Model, depth: int | None = None) -> DataFrame:
    """One row a placement: (key, bucket, the SCALE_COLUMNS, item, ord).

    A node's own items come before its subscales', in pre-order; then orphans, then unscaled items; ``ord`` numbers them
    within the document. A document without a tree is one shell row; a text that is no JSON has none. Trees may have any
    depth: the deepest one's is found by one aggregate beforehand, unless ``depth`` says what is allowed (deeper trees
    then raise an error instead of losing their leaves). Every document is parsed and exploded in one pass, without a join.
    """
    item = Model.of(item) if isinstance(item, str) else item
    depth = tree_depth(docs, tree) if depth is None else depth
    parsed = docs.withColumn("_t", F.from_json(tree, tree_schema(item, depth)))
    shell = F.array(F.lit(None).cast(_placed(item).removeprefix("array<")[:-1]))
    rows = F.when(F.col(tree).isNull(), shell).otherwise(_all_placements(F.col("_t"), item, depth))
    placed = parsed.select(F.col(key).alias(key), F.posexplode(rows).alias("ord", "_p"))
    return placed.select(key, "_p.bucket", *(f"_p.{c}" for c in SCALE_COLUMNS), "_p.item", "ord")


def explode_extractions(docs: DataFrame, tree: str, item: Model, meta: Model | None = None, nested: str = "_extractor_content", depth: int | None = None) -> DataFrame:
    """The whole layout of an exploded store: carried columns (all but the tree and those that end with ``nested``), bucket,
    the scale columns, ``meta_`` and ``item_`` columns as the models declare them, and ord.

    Every column of the models is there with its type, whatever the documents hold, so batches of a stream agree.
    """
    depth = tree_depth(docs, tree) if depth is None else depth
    carried = [c for c in docs.columns if c != tree and not c.endswith(nested)]
    parsed = docs.select(*carried, F.col(tree).alias("_tree"), F.from_json(tree, tree_schema(item, depth, meta)).alias("_t"))
    shell = F.array(F.lit(None).cast(_placed(item).removeprefix("array<")[:-1]))
    rows = F.when(F.col("_tree").isNull(), shell).otherwise(_all_placements(F.col("_t"), item, depth))
    of_meta = meta.columns(meta.resolved(F.col("_t.meta")), "meta_") if meta else []
    placed = parsed.select(*carried, *of_meta, F.posexplode(rows).alias("ord", "_p"))
    return placed.select(*carried, "_p.bucket", *(f"_p.{c}" for c in SCALE_COLUMNS), *(f"meta_{f.name}" for f in (meta.fields if meta else ())), *item.columns(F.col("_p.item"), "item_"), "ord")


def rebuild(rows: DataFrame, key: str, ids: str, names: str, item: str, order: str) -> DataFrame:
    """(key, scales): trees of any depth from placements, items in order, nodes by their first row.

    A node is struct(id, scale_name, items, subscales); nodes of the deepest level have no subscales. Levels are
    gathered from the deepest up, each by one aggregate; how many there are is the one number the driver reads.
    """
    deepest = rows.agg(F.max(F.size(ids))).first()[0] or 0
    none = F.array().cast(rows.select(F.array(item)).schema[0].dataType)
    sorted_ = lambda value, alias: F.transform(F.array_sort(F.collect_list(F.struct("_first", value.alias("v")))), lambda s: s["v"]).alias(alias)
    below = None
    for depth in range(deepest, 0, -1):
        here = rows.where(F.size(ids) >= depth)
        path = F.slice(ids, 1, depth).alias("_path")
        own = F.size(ids) == depth
        items = F.transform(F.array_sort(F.collect_list(F.when(own, F.struct(F.col(order).alias("o"), F.col(item).alias("v"))))), lambda s: s["v"])
        nodes = here.groupBy(key, path).agg(F.min_by(F.col(names)[depth - 1], order).alias("_name"), F.min(order).alias("_first"), F.coalesce(items, none).alias("_items"))
        fields = [F.element_at("_path", depth).alias("id"), F.col("_name").alias("scale_name"), F.col("_items").alias("items")]
        if below is not None:
            kind = below.schema["_node"].dataType.simpleString()
            under = below.groupBy(key, F.slice("_path", 1, depth).alias("_path")).agg(sorted_(F.col("_node"), "_subs"))
            nodes = nodes.join(under, [key, "_path"], "left")
            fields.append(F.coalesce("_subs", F.array().cast(f"array<{kind}>")).alias("subscales"))
        below = nodes.select(key, "_path", "_first", F.struct(*fields).alias("_node"))
    if below is None:
        return rows.select(key, F.array().cast("array<string>").alias("scales")).limit(0)
    return below.groupBy(key).agg(sorted_(F.col("_node"), "scales"))


def resolve_mappings(mappings: DataFrame, items: DataFrame, scales: DataFrame, key: str, item: str, scale: str, order: str) -> DataFrame:
    """Mapping rows against items and scales: unknown items go, a repeated pair keeps its first row, an unknown
    scale makes the item an orphan."""
    known = mappings.join(items, [key, item], "left_semi")
    once = known.withColumn("_n", F.row_number().over(Window.partitionBy(key, item, scale).orderBy(order))).where("_n = 1").drop("_n")
    joined = once.join(scales.select(F.col(scale).alias("_s")).distinct(), F.col(scale) == F.col("_s"), "left")
    return joined.withColumn("bucket", F.when(F.col("_s").isNull(), "orphan").otherwise("scaled")).withColumn(scale, F.col("_s")).drop("_s")


def subtree(rows: DataFrame, path: str, prefix: Column) -> DataFrame:
    """Rows whose path begins with ``prefix``."""
    return rows.where(F.slice(path, F.lit(1), F.size(prefix)) == prefix)

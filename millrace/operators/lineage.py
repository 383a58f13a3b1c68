"""Lineage: every pipeline is a chain SOURCE -> BRONZE -> SILVER -> GOLD."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The layers in flow order.
LAYERS = ("SOURCE", "BRONZE", "SILVER", "GOLD")
MAPPING_TYPE = "array<struct<from:string,to:string>>"


def layer_rank(layer: Column) -> Column:
    return F.array_position(F.array(*[F.lit(name) for name in LAYERS]), layer)


def pipeline_edges(pipelines: DataFrame) -> DataFrame:
    """Three edges for every row of (pipeline, source, dataset[, renames]).

    The column mapping rides on BRONZE -> SILVER.
    """
    renames = (
        F.coalesce(F.col("renames").cast(MAPPING_TYPE), F.array().cast(MAPPING_TYPE))
        if "renames" in pipelines.columns
        else F.array().cast(MAPPING_TYPE)
    )
    none = F.array().cast(MAPPING_TYPE)

    def hop(start: int) -> Column:
        return F.struct(
            F.lit(LAYERS[start]).alias("from_layer"),
            (F.col("source") if start == 0 else F.col("dataset")).alias("from_name"),
            F.lit(LAYERS[start + 1]).alias("to_layer"),
            F.col("dataset").alias("to_name"),
            (renames if LAYERS[start] == "BRONZE" else none).alias("column_mapping"),
        )

    kept = [c for c in ("pipeline", "recorded_at") if c in pipelines.columns]
    return pipelines.select(*kept, F.inline(F.array(hop(0), hop(1), hop(2))))


ENDS = ("pipeline", "from_layer", "from_name", "to_layer", "to_name")


def latest_edges(edges: DataFrame) -> DataFrame:
    """The edges, unique by pipeline and both ends, with the mapping that was recorded last.

    Edges without ``recorded_at`` have no order; of different mappings the largest one counts.
    """
    newest = F.max_by("column_mapping", "recorded_at") if "recorded_at" in edges.columns else F.max("column_mapping")
    return edges.groupBy(*ENDS).agg(newest.alias("column_mapping"))


def lineage_edges(pipelines: DataFrame) -> DataFrame:
    """The edges of all pipelines, unique by pipeline and both ends; ``recorded_at`` orders repeated ones."""
    return latest_edges(pipeline_edges(pipelines))


def lineage_nodes(edges: DataFrame) -> DataFrame:
    """Distinct (layer, name) over both ends of all edges."""
    ends = F.array(
        F.struct(F.col("from_layer").alias("layer"), F.col("from_name").alias("name")),
        F.struct(F.col("to_layer").alias("layer"), F.col("to_name").alias("name")),
    )
    return edges.select(F.inline(ends)).distinct()


def edges_of_dataset(edges: DataFrame, dataset: str | None = None) -> DataFrame:
    """Edges touching a dataset's nodes at either end; without a name, for every dataset at once.

    Source nodes belong to no dataset, so they match through their other end only. Edges that were
    recorded several times appear once.
    """
    edges = latest_edges(edges)
    from_dataset = F.when(F.col("from_layer") != "SOURCE", F.col("from_name"))
    to_dataset = F.when(F.col("to_layer") != "SOURCE", F.col("to_name"))
    if dataset is not None:
        touching = edges.filter((from_dataset == dataset) | (to_dataset == dataset))
        return touching.withColumn("dataset", F.lit(dataset))
    owners = F.array_distinct(F.array_compact(F.array(from_dataset, to_dataset)))
    return edges.withColumn("dataset", F.explode(owners))


def lineage_graph(edges: DataFrame, dataset: str) -> dict:
    """Nodes and edges feeding one dataset, in layer order; catalog-sized."""
    touching = edges_of_dataset(edges, dataset)
    nodes = lineage_nodes(touching).orderBy(layer_rank(F.col("layer")), "name").collect()
    hops = touching.orderBy(layer_rank(F.col("from_layer")), "pipeline", "from_name").collect()
    return {
        "dataset": dataset,
        "nodes": [{"layer": n.layer, "name": n.name} for n in nodes],
        "edges": [
            {
                "pipeline": e.pipeline,
                "from": {"layer": e.from_layer, "name": e.from_name},
                "to": {"layer": e.to_layer, "name": e.to_name},
                "column_mapping": [{"from": m["from"], "to": m["to"]} for m in e.column_mapping],
            }
            for e in hops
        ],
    }

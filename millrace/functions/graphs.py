"""Prompt graphs as JSON texts: checks and patches (SF7, SF18, SF19)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.variants import with_nested
from .templates import render

GRAPH = "map<string,struct<class_type:string,inputs:map<string,string>>>"


def is_api_graph(graph: Column) -> Column:
    """SF18: an object of nodes that all have a class_type and inputs, one at least."""
    nodes = F.from_json(graph, GRAPH)
    sound = F.forall(F.map_values(nodes), lambda n: n["class_type"].isNotNull() & n["inputs"].isNotNull())
    return F.coalesce((F.size(nodes) > 0) & sound, F.lit(False))


def is_ui_graph(graph: Column) -> Column:
    """SF18: a saved editor file instead: an object with nodes, links and last_node_id."""
    fields = F.from_json(graph, "struct<nodes:string,links:string,last_node_id:string>")
    return F.coalesce(fields["nodes"].isNotNull() & fields["links"].isNotNull() & fields["last_node_id"].isNotNull(), F.lit(False))


def checked_graph(graph: Column) -> Column:
    """SF18: the graph; an editor file or anything else fails."""
    message = F.when(is_ui_graph(graph), "an editor file is no prompt graph").otherwise("no prompt graph: nodes need class_type and inputs")
    return F.when(is_api_graph(graph), graph).otherwise(F.raise_error(message).cast("string"))


def with_inputs(graph: Column, inputs: dict[tuple[str, str], Column]) -> Column:
    """SF19: the graph with inputs (node, key) set to columns; nodes that are not there are made, blank node names change nothing."""
    changes = {(node, "inputs", key): value for (node, key), value in inputs.items() if node}
    return F.to_json(with_nested(F.parse_json(graph), changes)) if changes else graph


def prompt_text(template: str, anchor: dict[str, Column], chosen: dict[str, Column], index: Column, seed: Column, rendered: bool = True) -> Column:
    """SF7: the template with sample_index, seed, the anchor row's columns and the chosen words, which come before equal names; verbatim
    if it is not to be rendered."""
    return render(template, {"sample_index": index, "seed": seed, **anchor, **chosen}) if rendered else F.lit(template)

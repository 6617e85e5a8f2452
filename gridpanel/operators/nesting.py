"""Parent and child rows as nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpanel.operators.ordering import index_in_group
from gridpanel.scratch import stage


def attach_parent(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Add the parent row as a struct (NULL if there is none)."""
    side = parent.select(F.col(parent_key).alias("_parent_key"), F.struct(*parent.columns).alias(name))
    return child.join(side, child[key] == side["_parent_key"], "left").drop("_parent_key")


def attach_children(
    parent: DataFrame,
    key: str,
    children: DataFrame,
    child_key: str,
    order: list[str],
    name: str,
    page_size: int = 1000,
) -> DataFrame:
    """Add the ordered list of child rows, in pages of at most ``page_size``.

    A parent gets one document per page (``page`` 0, 1, ... of ``pages``), so a
    parent with very many children never becomes one giant row; up to
    ``page_size`` children there is exactly one. Parents without children get
    one page with an empty list.
    ``order`` must be unique among a parent's children.
    """
    fields = [c for c in children.columns if c != child_key]
    placed = stage(index_in_group(children.filter(F.col(child_key).isNotNull()), [child_key], order, "_at"), "children")
    counts = placed.groupBy(child_key).agg((F.floor(F.max("_at") / F.lit(page_size)) + 1).alias("pages"))
    counts = counts.withColumnRenamed(child_key, "_counted_key")
    pages = (
        placed.withColumn("page", F.floor(F.col("_at") / F.lit(page_size)))
        .groupBy(child_key, "page")
        .agg(F.array_sort(F.collect_list(F.struct("_at", *fields))).alias("_list"))
        .select(
            F.col(child_key).alias("_parent_key"),
            "page",
            F.transform("_list", lambda c: F.struct(*[c[f].alias(f) for f in fields])).alias(name),
        )
    )
    joined = parent.join(pages, parent[key] == pages["_parent_key"], "left").join(counts, parent[key] == counts["_counted_key"], "left")
    empty = F.array().cast(pages.schema[name].dataType)
    return joined.select(
        *[parent[c] for c in parent.columns],
        F.coalesce(pages["page"], F.lit(0)).alias("page"),
        F.coalesce(counts["pages"], F.lit(1)).alias("pages"),
        F.coalesce(pages[name], empty).alias(name),
    )

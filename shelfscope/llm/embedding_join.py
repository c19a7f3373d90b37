"""Embedding near-duplicates: an exact metric range join over pivots.

Vectors of one label are cut into cells by their nearest pivot, in the angle between
vectors, which is a metric. A pair within the radius r meets in the cells of both:
by the triangle inequality a vector can only have a partner in a cell whose pivot is
at most 2 r farther away than its own, so it visits those cells. Cells are joined
independently, in units of bounded size.

Equal vectors are one class, joined once and counted as often as they occur. With
vectors whose angles are all alike, as random ones of many dimensions, no pivot
excludes a cell and a label is compared with itself: exact still, but quadratic.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..staging import Workspace
from .components import connected_components
from .frames import without

#: Vectors for which a label gets a pivot, pivots at most, and vectors looked at to choose them.
CELL, MAX_PIVOTS, PIVOT_SAMPLE = 2048, 64, 512
#: Vectors on either side of a unit of the join.
CHUNK = 2048
#: Widens the angles that are excluded, against rounding.
SLACK = 1e-6


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors) -> np.ndarray:
    rows = np.array(list(vectors), dtype=np.float64)
    # Scaled first, so that very large or small components neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def _choose_pivots(sample: pd.DataFrame) -> pd.DataFrame:
    """Pivots far from each other: each next one is the vector farthest from all before."""
    sample = sample.sort_values("class")
    points = _unit(sample["vector"])
    wanted = min(int(sample["pivots"].iloc[0]), len(points))
    chosen, nearest = [0], _angles(points, points[:1])[:, 0]
    while len(chosen) < wanted:
        at = int(nearest.argmax())
        if nearest[at] <= 0:
            break
        chosen.append(at)
        nearest = np.minimum(nearest, _angles(points, points[at : at + 1])[:, 0])
    return pd.DataFrame(
        {"space": sample["space"].iloc[0], "cell": np.arange(len(chosen), dtype=np.int32), "pivot": list(points[chosen])}
    )


def _assigner(radius: float):
    def assign(vectors: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if vectors.empty:
            return pd.DataFrame({"space": [], "cell": [], "home": [], "class": [], "copies": [], "vector": []})
        pivots = pivots.sort_values("cell")
        angles = _angles(_unit(vectors["vector"]), np.array(list(pivots["pivot"])))
        own = angles.argmin(axis=1)
        visits = angles <= angles.min(axis=1, keepdims=True) + 2 * radius + SLACK
        row, cell = np.nonzero(visits)
        taken = vectors.iloc[row]
        return pd.DataFrame(
            {
                "space": taken["space"].to_numpy(),
                "cell": pivots["cell"].to_numpy()[cell],
                "home": own[row] == cell,
                "class": taken["class"].to_numpy(),
                "copies": taken["copies"].to_numpy(),
                "vector": taken["vector"].to_numpy(),
            }
        )

    return assign


def _joiner(threshold: float):
    def join(unit: pd.DataFrame) -> pd.DataFrame:
        """Links of the unit's home vectors to its members, and a root for each group that they connect."""
        homes, members = unit[unit["side"] == 0], unit[unit["side"] == 1]
        none = pd.DataFrame({"class": [], "links": [], "root": []})
        if homes.empty or members.empty:
            return none
        home_ids, member_ids = homes["class"].to_numpy(), members["class"].to_numpy()
        linked = _unit(homes["vector"]) @ _unit(members["vector"]).T >= threshold
        linked &= home_ids[:, None] != member_ids[None, :]
        counts = linked @ members["copies"].to_numpy(dtype=np.int64)
        left = linked.any(axis=1)
        if not left.any():
            return none
        home_root = np.full(len(home_ids), -1, dtype=np.int64)
        member_root = np.full(len(member_ids), -1, dtype=np.int64)
        for start in np.flatnonzero(left):
            if home_root[start] >= 0:
                continue
            frontier = np.array([start])
            home_root[start] = start
            while len(frontier):
                reached = linked[frontier].any(axis=0) & (member_root < 0)
                member_root[reached] = start
                found = linked[:, reached].any(axis=1) & (home_root < 0)
                home_root[found] = start
                frontier = np.flatnonzero(found)
        at, with_root = np.flatnonzero(left), np.flatnonzero(member_root >= 0)
        return pd.DataFrame(
            {
                "class": np.concatenate([home_ids[at], member_ids[with_root]]),
                "links": np.concatenate([counts[at], np.zeros(len(with_root), dtype=np.int64)]),
                "root": home_ids[np.concatenate([home_root[at], member_root[with_root]])],
            }
        )

    return join


def _pieces(count: Column) -> Column:
    return F.greatest(F.ceil(count / CHUNK), F.lit(1)).cast("int")


def _piece(count: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64("class", F.lit(salt)), count).cast("int")


def near_duplicates(
    df: DataFrame, threshold: float, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """``df`` without its vector, with ``n_links``, ``component_id`` and ``kept``.

    Two vectors link if their labels are equal and not null, their lengths are equal and
    their cosine, in doubles, is at least ``threshold``, which is positive. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing.
    ``n_links`` counts other rows, repeated ones included; ``component_id`` is the smallest
    id reachable by links, the row's own included; ``kept`` says whether the row's id is
    that. A null id is never kept and never names a component of others. Columns of the
    same names are replaced. The work is done when the function returns; the result
    reads staged tables.
    """
    spark = df.sparkSession
    radius = math.acos(threshold)
    values = F.col(f"`{vector}`")
    # A vector that links with nothing has no class; the others share one if they are equal.
    named = without(df, ["n_links", "component_id", "kept"])
    linkable = usable(values) & F.col(f"`{label}`").isNotNull()
    zero_free = F.transform(values, lambda x: x.cast("double") + 0.0)
    named = named.select(
        *(F.col(f"`{c}`") for c in named.columns if c != vector),
        F.when(linkable, zero_free).alias("_vector"),
        F.when(linkable, F.xxhash64(F.col(f"`{label}`"), zero_free)).alias("_class"),
    )
    out = Workspace(spark, "near-duplicates")
    rows = out.stage(named.drop("_vector"), "rows").frame
    with Workspace(spark, "embedding-join") as space:
        classes = space.stage(
            named.filter("_class is not null")
            .groupBy(F.col("_class").alias("class"), F.xxhash64(F.col(f"`{label}`"), F.size("_vector")).alias("space"))
            .agg(F.first("_vector").alias("vector"), F.count(F.lit(1)).alias("copies")),
            "classes",
        ).frame
        sizes = classes.groupBy("space").agg(F.count(F.lit(1)).alias("size"))
        sizes = space.stage(
            sizes.withColumn("pivots", F.least(F.ceil(F.col("size") / CELL), F.lit(MAX_PIVOTS)).cast("int")), "sizes"
        ).frame
        # A bounded sample of each label: the classes of lowest hash.
        order = Window.partitionBy("space").orderBy(F.xxhash64("class", F.lit(3)))
        sample = classes.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PIVOT_SAMPLE).drop("place")
        pivots = space.stage(
            sample.join(sizes, "space")
            .groupBy("space")
            .applyInPandas(_choose_pivots, "space long, cell int, pivot array<double>"),
            "pivots",
        ).frame
        sized = classes.join(sizes, "space").withColumn("part", _piece(_pieces(F.col("size")), 5))
        parts = sizes.select("space", F.explode(F.sequence(F.lit(0), _pieces(F.col("size")) - 1)).alias("part"))
        cells = space.stage(
            sized.select("space", "part", "class", "copies", "vector")
            .groupBy("space", "part")
            .cogroup(pivots.join(parts, "space").groupBy("space", "part"))
            .applyInPandas(
                _assigner(radius), "space long, cell int, home boolean, class long, copies long, vector array<double>"
            ),
            "cells",
        ).frame
        counts = space.stage(
            cells.groupBy("space", "cell").agg(
                _pieces(F.count_if("home")).alias("home_parts"), _pieces(F.count(F.lit(1))).alias("member_parts")
            ),
            "counts",
        ).frame
        placed = cells.join(counts, ["space", "cell"])
        homes = placed.filter("home").select(
            "space",
            "cell",
            _piece(F.col("home_parts"), 7).alias("h"),
            F.explode(F.sequence(F.lit(0), F.col("member_parts") - 1)).alias("m"),
            F.lit(0).alias("side"),
            "class",
            "copies",
            "vector",
        )
        members = placed.select(
            "space",
            "cell",
            F.explode(F.sequence(F.lit(0), F.col("home_parts") - 1)).alias("h"),
            _piece(F.col("member_parts"), 11).alias("m"),
            F.lit(1).alias("side"),
            "class",
            "copies",
            "vector",
        )
        linked = space.stage(
            homes.unionByName(members)
            .groupBy("space", "cell", "h", "m")
            .applyInPandas(_joiner(threshold), "class long, links long, root long"),
            "linked",
        ).frame
        roots = connected_components(linked.select(F.col("class").alias("a"), F.col("root").alias("b")), space)
        links = linked.groupBy("class").agg(F.sum("links").alias("links"))
        # Names: the smallest id of a class, then of the classes that are connected.
        ids = rows.filter("_class is not null").groupBy("_class").agg(
            F.min(F.col(f"`{key}`")).alias("smallest"), F.count(F.lit(1)).alias("copies")
        )
        known = ids.join(links, ids["_class"] == links["class"], "left").join(roots, ids["_class"] == roots["node"], "left")
        known = space.stage(
            known.select("_class", "smallest", "copies", "links", F.coalesce("component", "_class").alias("group")), "known"
        ).frame
        names = known.groupBy("group").agg(F.min("smallest").alias("name"))
        result = out.stage(known.join(names, "group").select(F.col("_class").alias("of"), "copies", "links", "name"), "result").frame
    joined = rows.join(result, rows["_class"] == result["of"], "left")
    component = F.coalesce(F.col("name"), F.col(f"`{key}`"))
    return joined.select(
        *(F.col(f"`{c}`") for c in rows.columns if c != "_class"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col(f"`{key}`") == component, F.lit(False)).alias("kept"),
    )

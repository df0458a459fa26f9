"""Near-duplicate embeddings by an exact metric range join.

Unit vectors with cosine ``c`` or more are at most ``r = sqrt(2 - 2 c)`` apart. Pivots cut the
vectors of each label into cells (a vector's home is its nearest pivot). By the triangle
inequality a vector can have a neighbour at home in another cell only if its distance to that
pivot is at most its distance to its own plus ``2 r``, and at most the cell's radius plus ``r``; it
visits just those cells. Each cell then compares its residents with its visitors, on its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm import words as wd
from tallyline.llm.components import components
from tallyline.sources.tables import stage_table

COSINE = 0.98
MOST_PIVOTS = 1_024
CELL_VECTORS = 500
PART_VECTORS = 1_000
_SLACK = 1e-7


def _unit_task(batches):
    """Unit vectors in double precision; rows that cannot be compared are left out."""
    for batch in batches:
        column = batch.column(3)
        rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
        # Of NULL lists nothing is in the flat values; NULL components are NaN there.
        x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        size = pc.list_value_length(column).fill_null(0).to_numpy()[rows].astype(np.int64)
        rows, size = rows[size > 0], size[size > 0]
        if not len(rows):
            continue
        at = np.cumsum(size) - size
        most = np.maximum.reduceat(np.where(np.isfinite(x), np.abs(x), np.inf), at)
        good = np.isfinite(most) & (most > 0)
        x, most = x[np.repeat(good, size)], most[good]
        rows, size = rows[good], size[good]
        if not len(rows):
            continue
        x = x / np.repeat(most, size)
        x /= np.repeat(np.sqrt(np.add.reduceat(x * x, np.cumsum(size) - size)), size)
        rows = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(i).take(rows) for i in range(3)), wd.list_column(x, size, pa.float64())],
            ["node", "label", "copies", "unit"])


def _matrix(units) -> np.ndarray:
    return np.stack([np.asarray(u, np.float64) for u in units])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ pivots.T), 0))


def _home_task(shared):
    def run(frames):
        for frame in frames:
            cell = np.full(len(frame), -1, np.int32)
            away = np.zeros(len(frame))
            for kind, rows in _alike(frame):
                if kind not in shared.value:
                    continue
                pivots, numbers = shared.value[kind]
                d = _distances(_matrix(frame["unit"].iloc[rows]), pivots)
                nearest = d.argmin(1)
                cell[rows], away[rows] = numbers[nearest], d[np.arange(len(rows)), nearest]
            yield frame.assign(cell=cell, away=away)

    return run


def _alike(frame: pd.DataFrame):
    """Rows by label and vector length."""
    for key, part in frame.groupby(["label", "width"]).indices.items():
        yield (int(key[0]), int(key[1])), part


def _visit_task(shared, radii, r: float):
    def run(frames):
        for frame in frames:
            for kind, rows in _alike(frame):
                if kind not in shared.value:
                    yield frame.iloc[rows][["node", "label", "width", "copies", "unit", "cell"]]
                    continue
                pivots, numbers = shared.value[kind]
                reach = np.array([radii.value.get(int(c), -1.0) for c in numbers])
                for at in range(0, len(rows), 512):
                    part = rows[at: at + 512]
                    d = _distances(_matrix(frame["unit"].iloc[part]), pivots)
                    near = (d <= frame["away"].to_numpy()[part][:, None] + 2 * r + _SLACK) & (
                        d <= reach + r + _SLACK) & (reach >= 0)
                    who, where = np.nonzero(near)
                    visits = frame.iloc[part[who]][["node", "label", "width", "copies", "unit"]]
                    yield visits.assign(cell=numbers[where])

    return run


def _cell_task(cosine: float):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        """Links of residents to visitors: counts, and enough links to connect what is linked."""
        home = cell[cell["resident"]]
        guest = cell[~cell["resident"]]
        if not len(home) or not len(guest):
            return pd.DataFrame({"node": [], "n": [], "peer": []}).astype("int64")
        a, b = home["node"].to_numpy(), guest["node"].to_numpy()
        close = _matrix(home["unit"]) @ _matrix(guest["unit"]).T >= cosine
        close &= a[:, None] != b[None, :]
        n = close @ guest["copies"].to_numpy()
        # Smallest node of each connected part of this block, by repeated minima over links.
        none = np.iinfo(np.int64).max
        low_a, low_b = a.copy(), b.copy()
        while True:
            seen = np.minimum(low_a, np.where(close, low_b[None, :], none).min(1))
            back = np.minimum(low_b, np.where(close, seen[:, None], none).min(0))
            if (seen == low_a).all() and (back == low_b).all():
                break
            low_a, low_b = seen, back
        guests = close.any(0)
        return pd.DataFrame({
            "node": np.append(a, b[guests]), "n": np.append(n, np.zeros(guests.sum(), np.int64)),
            "peer": np.append(low_a, low_b[guests])})

    return run


def near_duplicates(
    vectors: DataFrame, *, cosine: float = COSINE, vec_id: str = "vec_id",
    embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Two vectors of equal label and length are linked when their cosine, in double precision, is
    ``cosine`` or more. ``n_links`` counts the other vectors linked directly, ``component_id`` is
    the smallest id reachable by links, and ``kept`` marks the rows with that id.

    Vectors that are NULL, empty, zero, or have a NULL or non-finite component, and those with a
    NULL label, are linked with nothing. Equal vectors of one label are compared once and counted
    as often as they have ids; repeated rows of one id and vector each come back and count as one.
    An id that stands on several vectors or labels is a vector of its own on each: its rows have
    links and components of their own, and it counts once for each of its vectors that is linked.
    Rows with a NULL id have a NULL component unless linked to others. Other columns are ignored.
    """
    spark = vectors.sparkSession
    base = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"),
        F.col(label).cast("int").alias("label"))
    base = stage_table(base, "vectors")
    classes = base.where("label is not null and embedding is not null").groupBy(
        "label", "embedding").agg(
            F.min("vec_id").alias("low"), F.count_distinct("vec_id").alias("copies"))
    # A node is a vector with a label. Its number is unique, and fixed once it is written.
    classes = stage_table(classes.where("low is not null").withColumn(
        "node", F.monotonically_increasing_id()), "classes")
    units = classes.select("node", "label", "copies", "embedding").mapInArrow(
        _unit_task, "node long, label int, copies long, unit array<double>")
    units = stage_table(units.withColumn("width", F.size("unit")), "units")

    # Pivots: a sample by hash, in number bounded and shared out over labels and lengths by their
    # rows. Labels with too few rows for two pivots are one cell each (number -1).
    total = units.count()
    kinds = units.groupBy("label", "width").agg(F.count("*").alias("n")).withColumn(
        "want", F.least(F.ceil(F.col("n") / CELL_VECTORS), F.floor(F.col("n") * MOST_PIVOTS / max(total, 1))))
    kinds = F.broadcast(kinds.where("want >= 2"))  # MOST_PIVOTS / 2 rows at most
    chance = F.pmod(F.xxhash64("unit"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    picked = units.join(kinds, ["label", "width"]).where(chance < F.col("want") / F.col("n"))
    pivots: dict = {}
    for number, p in enumerate(picked.select("label", "width", "unit").collect()):
        pivots.setdefault((p.label, p.width), []).append((number, p.unit))
    pivots = {
        kind: (_matrix([u for _, u in own]), np.array([i for i, _ in own], np.int32))
        for kind, own in pivots.items()}
    r = float(np.sqrt(2 - 2 * cosine))
    shared = spark.sparkContext.broadcast(pivots)
    fields = "node long, label int, width int, copies long, unit array<double>, cell int"
    names = ["node", "label", "width", "copies", "unit"]
    homes = stage_table(
        units.select(*names).mapInPandas(_home_task(shared), f"{fields}, away double"), "homes")
    radii = homes.where("cell >= 0").groupBy("cell").agg(F.max("away").alias("radius")).collect()
    radii = spark.sparkContext.broadcast({c.cell: c.radius for c in radii})
    visits = stage_table(homes.mapInPandas(_visit_task(shared, radii, r), fields), "visits")

    # A cell of many residents or visitors is compared in pairs of bounded parts.
    cell = ["label", "width", "cell"]
    parts = F.ceil(F.count("*") / PART_VECTORS).cast("int")
    sizes = stage_table(homes.groupBy(*cell).agg(parts.alias("h_parts")).join(
        visits.groupBy(*cell).agg(parts.alias("v_parts")), cell), "cells")
    spread = F.xxhash64("node")
    residents = homes.join(sizes, cell).select(
        *cell, F.pmod(spread, F.col("h_parts")).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("v_parts") - 1)).alias("j"),
        F.lit(True).alias("resident"), "node", "copies", "unit")
    guests = visits.join(sizes, cell).select(
        *cell, F.explode(F.sequence(F.lit(0), F.col("h_parts") - 1)).alias("i"),
        F.pmod(spread, F.col("v_parts")).cast("int").alias("j"),
        F.lit(False).alias("resident"), "node", "copies", "unit")
    found = stage_table(
        residents.unionByName(guests).groupBy(*cell, "i", "j").applyInPandas(
            _cell_task(cosine), "node long, n long, peer long"), "links")

    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    comps = components(found.where("node <> peer"), "node", "peer").groupBy("node").agg(
        F.min("component").alias("component"))
    lowest = comps.join(classes.select("node", "low"), "node").groupBy("component").agg(
        F.min("low").alias("lowest"))
    comps = comps.join(lowest, "component").select("node", "lowest")
    known = classes.join(units.select("node"), "node")
    known = known.join(counts, "node", "left").join(comps, "node", "left").select(
        "label", "embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("lowest", "low").alias("component_id"))
    out = base.join(known, ["label", "embedding"], "left")
    out = out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

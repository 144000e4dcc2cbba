"""Embedding near-duplicates: spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from culprit.llm.common import components, kept_table, merge_labels

THRESHOLD = 0.98
FIT_ROWS = 10_000
CELL_ROWS = 2_000
MAX_CELLS = 2_048
PIECE_ROWS = 8_192
ROUNDS = 10
COPY_COST = 1_000  # cosines that take as long as moving a vector to one more task
TRIED_ROWS = 2_000  # of the sample, on which numbers of cells are compared
NEAR_VALUES = 1 << 20  # products of vectors and centres, or of vectors, that a task holds at a time
BATCH_ROWS = 4_096


def fit_cells(sample: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = 7) -> np.ndarray:
    """Unit centres of spherical k-means over unit vectors; an empty cell takes a random vector."""
    draw = np.random.default_rng(seed)
    centres = sample[draw.choice(len(sample), cells, replace=False)].copy()
    for _ in range(rounds):
        home = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1)
        empty = size < 1e-12
        sums[empty] = sample[draw.integers(0, len(sample), empty.sum())]
        size[empty] = 1.0
        centres = sums / size[:, None]
    return centres


def _placing(centres: np.ndarray, threshold: float):
    """Gives for unit vectors their own cells and a table of the lower-numbered cells that may hold a neighbour.

    Vectors with cosine of at least ``threshold`` are at most ``reach`` apart, so a neighbour
    can lie in another cell only when the plane halfway to that cell's centre is that close.
    """
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    apart = np.linalg.norm(centres[:, None, :] - centres[None, :, :], axis=2)

    def place(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = x @ centres.T
        home = near.argmax(axis=1)
        gap = near[np.arange(len(x)), home][:, None] - near
        return home, (gap <= reach * apart[home]) & (np.arange(len(centres))[None, :] < home[:, None])

    return place


def _assigner(centres: np.ndarray, threshold: float):
    """Every vector in its own cell and, as a guest, in the others within reach, in small batches."""
    place, step = _placing(centres, threshold), max(1, NEAR_VALUES // len(centres))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), step):
                rows = batch.iloc[at : at + step]
                x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
                home, guest = place(x / np.linalg.norm(x, axis=1)[:, None])
                yield rows.assign(cell=home.astype(np.int32), guest=False)
                row, cell = np.nonzero(guest)
                for k in range(0, len(row), BATCH_ROWS):
                    some = slice(k, k + BATCH_ROWS)
                    yield rows.iloc[row[some]].assign(cell=cell[some].astype(np.int32), guest=True)

    return assign


def choose_cells(sample: np.ndarray, n: int, alike: float, most: int, threshold: float, piece_rows: int) -> np.ndarray:
    """Centres of as many cells as seem to cost least, from one to ``most``.

    More cells need fewer cosines, but a vector near many planes is copied into many cells.
    Both are counted on some of the sample, for ``n`` vectors of which two have the same label
    with probability ``alike``. Any choice gives the same links.
    """
    best, least = None, math.inf
    tried = sample[:TRIED_ROWS]
    counts = [1]
    while counts[-1] < most:
        counts.append(min(most, 4 * counts[-1]))
    for cells in counts:
        centres = fit_cells(sample, cells)
        place, step = _placing(centres, threshold), max(1, NEAR_VALUES // cells)
        share, guests = np.zeros(cells), np.zeros(cells)
        for at in range(0, len(tried), step):
            home, guest = place(tried[at : at + step])
            share += np.bincount(home, minlength=cells) / len(tried)
            guests += guest.sum(axis=0) / len(tried)
        own = share * n * alike  # members of a cell and label
        members, hosted = np.ceil(own / piece_rows), np.ceil(guests * n * alike / piece_rows)
        copies = (share * (members + hosted)).sum() + (guests * members).sum()
        cost = n * alike * (share * (share / 2 + guests)).sum() + COPY_COST * copies
        if cost < least:
            best, least = centres, cost
        elif cost > 4 * least:
            break  # copies only grow from here on
    return best


def _blocked(threshold: float):
    def join(rows: pd.DataFrame) -> pd.DataFrame:
        """Links between two pieces of a cell: ``n`` per vector and a star per linked group."""
        own = rows["p"].iat[0] == rows["q"].iat[0]
        x = np.stack(rows["vector"].to_numpy()).astype(np.float64)
        size = np.linalg.norm(x, axis=1)
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        left = np.arange(len(x)) if own else np.flatnonzero(rows["side"].to_numpy() == 0)
        right = left if own else np.flatnonzero(rows["side"].to_numpy() == 1)
        found, label = np.zeros(len(x), np.int64), np.arange(len(x))
        step = max(16, NEAR_VALUES // max(1, len(right)))
        for at in range(0, len(left), step):
            part = left[at : at + step]
            cosine = (x[part] @ x[right].T) / (size[part][:, None] * size[right][None, :])
            near = cosine >= threshold
            if own:
                near[np.arange(len(part)), at + np.arange(len(part))] = False
            i, j = np.nonzero(near)
            np.add.at(found, part[i], copies[right[j]])
            if not own:
                np.add.at(found, right[j], copies[part[i]])
            merge_labels(label, part[i], right[j])
        linked = found > 0
        root = pd.Series(node).groupby(label).transform("min").to_numpy()
        return pd.DataFrame({"node": node[linked], "root": root[linked], "n": found[linked]})

    return join


def usable(vector: str = "embedding"):
    """True for vectors that can link: not null, not empty, not zero, all components finite."""
    finite = F.forall(F.col(vector), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(F.col(vector), lambda v: v != 0), F.lit(False))


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    fit_rows: int = FIT_ROWS,
    cell_rows: int = CELL_ROWS,
    max_cells: int = MAX_CELLS,
    piece_rows: int = PIECE_ROWS,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept``: one row per row of ``df``.

    Vectors of equal non-null label and length link at cosine ``threshold`` or more. The
    centres, as many as cost least, are fitted on the ``fit_rows`` vectors that come first by a hash; every vector is
    then placed in its cell and, as a guest, in each other cell within reach, so no link is
    missed. Equal vectors are one node with a count. A cell with more than ``piece_rows``
    vectors is cut into pieces that meet pairwise. Only link counts and stars leave a task.

    Vectors that are null, empty, zero or hold a null or non-finite component, and rows with
    a null label, link with nothing: ``n_links`` 0, ``component_id`` their id. Rows that
    repeat an id with the same vector count as further vectors; with other vectors they are
    one node. A null id links and is counted but names no component. Other columns are not read.
    """
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.withColumn("vector", F.when(usable("vector") & F.col("label").isNotNull(), F.col("vector")))
    able = rows.filter("vector IS NOT NULL")
    nodes = able.groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    node = F.coalesce("first", F.xxhash64("label", "vector"))
    nodes = kept_table(nodes.withColumn("node", node), "vectors")
    sizes = nodes.groupBy(F.size("vector").alias("width"), "label").agg(F.count("*").alias("n"))
    alike = (F.sum(F.col("n").cast("double") * F.col("n")) / F.sum("n") / F.sum("n")).alias("alike")
    sizes = sizes.groupBy("width").agg(F.sum("n").alias("n"), alike).collect()
    parts, kind = [], dict(nodes.dtypes)["label"]
    for width, n, same in sorted((r["width"], r["n"], r["alike"]) for r in sizes):
        some = nodes.filter(F.size("vector") == width)
        cells = int(min(max_cells, max(1, n // cell_rows), n))
        sample = some.orderBy(F.xxhash64("vector"), "label").limit(max(cells, fit_rows)).select("vector").toPandas()
        sample = np.stack(sample["vector"].to_numpy()).astype(np.float64)
        centres = choose_cells(sample / np.linalg.norm(sample, axis=1)[:, None], n, same, cells, threshold, piece_rows)
        placed = some.select("label", "vector", "node", "copies").mapInPandas(
            _assigner(centres, threshold), f"label {kind}, vector array<double>, node long, copies long, cell int, guest boolean"
        )
        parts.append(placed.withColumn("width", F.lit(width)))
    if not parts:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    placed = parts[0]
    for part in parts[1:]:
        placed = placed.unionByName(part)
    # Placing again costs less than keeping every copy of every vector.
    cell = ["width", "label", "cell"]
    pieces = F.ceil(F.count("*") / piece_rows).cast("int").alias("pieces")
    counts = kept_table(placed.filter("NOT guest").groupBy(*cell).agg(pieces), "cell-sizes")
    # Members meet members once; guests meet members. Both as (piece p, piece q) of one cell.
    spread = placed.join(counts, cell)
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    spread = spread.select(*cell, "guest", "node", "copies", "vector", "mine", "pieces", other)
    guest_piece = -1 - F.pmod(F.xxhash64("node", F.lit(1)), F.col("guests")).cast("int")
    member = spread.filter("NOT guest").select(
        *cell, F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "node", "copies", "vector",
    )
    crowd = placed.filter("guest").groupBy(*cell).agg(F.ceil(F.count("*") / piece_rows).cast("int").alias("guests"))
    crowd = kept_table(crowd, "guest-sizes")
    visitor = spread.filter("guest").join(crowd, cell).select(
        *cell, guest_piece.alias("p"), F.col("other").alias("q"), F.lit(0).alias("side"), "node", "copies", "vector"
    )
    host = placed.filter("NOT guest").join(counts, cell).join(crowd, cell)
    host = host.withColumn("q", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    host = host.withColumn("g", F.explode(F.sequence(F.lit(1), F.col("guests"))))
    host = host.select(*cell, (-F.col("g")).alias("p"), "q", F.lit(1).alias("side"), "node", "copies", "vector")
    meet = member.unionByName(visitor).unionByName(host)
    found = meet.groupBy(*cell, "p", "q").applyInPandas(_blocked(threshold), "node long, root long, n long")
    found = kept_table(found, "links")
    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    n_links = found.groupBy("node").agg(F.sum("n").alias("others"))
    grouped = nodes.join(n_links, "node", "left").join(linked, "node", "left")
    grouped = grouped.select("label", "vector", "first", "copies", F.coalesce("others", F.lit(0)).alias("others"), F.coalesce("comp", "node").alias("comp"))
    first = grouped.groupBy("comp").agg(F.min("first").alias("smallest"))
    named = kept_table(grouped.join(first, "comp").select("label", "vector", "others", "copies", "smallest"), "vector-components")
    out = rows.join(named, ["label", "vector"], "left")
    component = F.when(F.col("copies").isNull(), F.col("vec_id")).otherwise(F.col("smallest"))
    links = F.coalesce(F.col("others") + F.col("copies") - 1, F.lit(0)).cast("long")
    out = out.select("vec_id", links.alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0 AND isfinite(x))) > 0
    AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
pair AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= {THRESHOLD}),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.vec_id, p.b FROM reach r JOIN pair p ON r.other = p.a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e
LEFT JOIN (SELECT a, count(*) AS n FROM pair GROUP BY a) n ON e.vec_id = n.a
JOIN (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id) c ON e.vec_id = c.vec_id
"""

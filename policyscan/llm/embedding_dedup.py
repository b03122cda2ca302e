"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them.

Cells: unit centroids are fitted by spherical k-means on a bounded sample of the vectors
(``SAMPLE_ROWS``); every vector is assigned to the centroid of largest cosine.  Vectors of
different labels never share a cell.

No link is lost at the borders: a vector is also sent, as a guest, to every later cell in
which a vector within the link angle could be at home.  Between its home centroid h and
another centroid c that is the case exactly if x.(h - c) <= sin(angle) * |h - c|, the
angular distance to the border of the two cells.  A link across cells is found once, in
the later cell, and counted for both its ends.  So the sample and the number of cells
change the work, not the result.

Links: a cell's vectors are dealt by hash into blocks, and each pair of a home block and a
block of members or guests is one double-precision matrix product.  A pair of blocks
returns link counts and a spanning star of its components, never its pairs; so a group of
near-copies of any size costs products, not rows.  Equal vectors are one vector with a
weight.

Defined results
    null label, null vec_id, null or zero vectors, null or non-finite components: no links
    vectors of different lengths: never linked
    equal vectors and repeated rows: each row is a vector; rows with one id share its links
    ties: the component id, and the one kept, is the smallest vec_id
    extra input columns: not read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policyscan.llm.components import components
from policyscan.session import stage

COSINE = 0.98
SAMPLE_ROWS = 20_000
ROWS_PER_CELL = 4_000
MAX_CELLS = 1_024
BLOCK_ROWS = 2_048
ROUNDS = 8


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision; large components do not overflow."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit(sample: np.ndarray, cells: int, seed: int = 7) -> np.ndarray:
    """Unit centroids by spherical k-means."""
    rng = np.random.default_rng(seed)
    centers = sample[rng.permutation(len(sample))[:cells]]
    for _ in range(ROUNDS):
        nearest = (sample @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        lengths = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centers = np.where(lengths > 0, sums / np.where(lengths > 0, lengths, 1), centers)
    return centers


def places(vectors: np.ndarray, centers: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether at home, for the home of every unit vector and the cells it could be a guest of."""
    products = vectors @ centers.T
    home = products.argmax(axis=1)
    apart = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * centers @ centers.T))
    margin = products[np.arange(len(vectors)), home][:, None] - products
    reach = np.sqrt(1.0 - least * least) * apart[home] + 1e-9
    row, cell = np.nonzero(margin <= reach)
    return row, cell, cell == home[row]


def one_way(row: np.ndarray, cell: np.ndarray, home: np.ndarray) -> np.ndarray:
    """The places to send: every home, and guests to cells later than their home.

    Both ends of a link reach each other's cell, so the later of the two cells sees it.
    """
    return cell >= cell[home][row]


def local_roots(row: np.ndarray, other: np.ndarray, ids: np.ndarray, other_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id reachable from every row and every other, over the links of one pair of blocks."""
    mine, theirs = ids.copy(), other_ids.copy()
    while True:
        before = mine.copy()
        np.minimum.at(theirs, other, mine[row])
        np.minimum.at(mine, row, theirs[other])
        if (mine == before).all():
            return mine, theirs


def _sample(vectors: DataFrame, n: int) -> np.ndarray:
    share = max(1, -(-n // SAMPLE_ROWS))
    rows = vectors.filter(F.expr(f"pmod(xxhash64(id, 3), {share}L) = 0")).select("vector").limit(2 * SAMPLE_ROWS)
    return np.array([r.vector for r in rows.collect()], np.float64)


def links(vectors: DataFrame, least: float = COSINE) -> tuple[DataFrame, DataFrame]:
    """Link counts and edges of the distinct ``vectors`` (written: id, label, dims, weight, vector).

    Returns ``id``, ``n`` (weights of the other vectors linked to it) and edges ``a``,
    ``b`` that connect what is linked.
    """
    sizes = {r.dims: r["count"] for r in vectors.groupBy("dims").count().collect()}  # lengths of vectors are few
    dims_centers = {}
    for dims, n in sizes.items():
        cells = min(MAX_CELLS, max(1, n // ROWS_PER_CELL))
        sample = _sample(vectors.filter(F.col("dims") == dims), n) if cells > 1 else np.ones((1, dims))
        dims_centers[dims] = fit(unit(sample), min(cells, max(1, len(sample))))

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for dims, part in frame.groupby("dims"):
                x = unit(np.array(part["vector"].tolist(), np.float64))
                row, cell, home = places(x, dims_centers[dims], least)
                sent = one_way(row, cell, home)
                yield part.iloc[row[sent]].assign(cell=cell[sent], home=home[sent])

    schema = "id long, label int, dims int, weight long, vector array<float>, cell int, home boolean"
    kind = vectors.schema["vector"].dataType.simpleString()
    schema = schema.replace("array<float>", kind).replace("label int", f"label {vectors.schema['label'].dataType.simpleString()}")
    members = stage(vectors.select("id", "label", "dims", "weight", "vector").mapInPandas(assign, schema), "cell-members")

    key = ["label", "dims", "cell"]
    blocks = members.groupBy(*key).agg(
        F.ceil(F.sum(F.col("home").cast("long")) / BLOCK_ROWS).alias("home_blocks"),
        F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).alias("all_blocks"),
    )
    blocks = stage(blocks.filter("home_blocks > 0"), "cell-blocks")
    dealt = members.join(blocks, key)
    left = dealt.filter("home").select(
        *key, "id", "weight", "vector", "home", F.lit(True).alias("left"),
        F.expr("pmod(xxhash64(id, 1), home_blocks)").alias("i"), F.explode(F.expr("sequence(0L, all_blocks - 1)")).alias("j"),
    )
    right = dealt.select(
        *key, "id", "weight", "vector", "home", F.lit(False).alias("left"),
        F.explode(F.expr("sequence(0L, home_blocks - 1)")).alias("i"), F.expr("pmod(xxhash64(id, 2), all_blocks)").alias("j"),
    )

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = frame[frame["left"]], frame[~frame["left"]]
        if not len(a) or not len(b):
            return pd.DataFrame({"id": [], "n": [], "root": []}).astype("int64")
        ids, other_ids = a["id"].to_numpy(np.int64), b["id"].to_numpy(np.int64)
        products = unit(np.array(a["vector"].tolist(), np.float64)) @ unit(np.array(b["vector"].tolist(), np.float64)).T
        row, other = np.nonzero(products >= least)
        differ = ids[row] != other_ids[other]
        row, other = row[differ], other[differ]
        n = np.bincount(row, weights=b["weight"].to_numpy(np.float64)[other], minlength=len(a)).astype(np.int64)
        # Members at home stand on both sides; a guest's links are seen from here alone.
        guest = ~b["home"].to_numpy(bool)[other]
        weights = a["weight"].to_numpy(np.float64)[row[guest]]
        n_other = np.bincount(other[guest], weights=weights, minlength=len(b)).astype(np.int64)
        mine, theirs = local_roots(row, other, ids, other_ids)
        linked = np.unique(other)
        found = np.flatnonzero(n)
        return pd.DataFrame(
            {
                "id": np.concatenate((ids[found], other_ids[linked])),
                "n": np.concatenate((n[found], n_other[linked])),
                "root": np.concatenate((mine[found], theirs[linked])),
            }
        )

    found = left.unionByName(right).groupBy(*key, "i", "j").applyInPandas(compare, "id long, n long, root long")
    found = stage(found, "block-links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n"))
    edges = found.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")).distinct()
    return counts, edges


def dedup(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = COSINE
) -> DataFrame:
    """One row per row of ``rows``: vec_id, n_links, component_id, kept."""
    vector = F.col("vector")
    given = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{vector_col}`").alias("vector"),
        F.col(f"`{label_col}`").alias("label"),
    )
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    ) & F.exists(vector, lambda x: x != 0)
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & vector.isNotNull() & finite
    # Equal vectors of a label are found by two independent 64-bit hashes.
    keyed = given.withColumns(
        {
            "able": F.coalesce(able, F.lit(False)),
            "k1": F.xxhash64("label", "vector"),
            "k2": F.xxhash64(F.lit(99), F.size("vector"), F.reverse("vector")),
        }
    )
    keyed = stage(keyed, "vectors")
    copies = keyed.filter("able").groupBy("k1", "k2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    copies = stage(copies, "distinct-vectors")
    first = keyed.filter("able").join(copies, (keyed.vec_id == copies.id) & (keyed.k1 == copies.k1) & (keyed.k2 == copies.k2))
    distinct = first.select("id", "label", F.size("vector").alias("dims"), "weight", "vector").dropDuplicates(["id", "label", "dims", "weight", "vector"])
    counts, edges = links(stage(distinct, "distinct-rows"), least)
    found = stage(components(edges), "vector-components")

    named = keyed.select("vec_id", "able", "k1", "k2").join(
        copies.withColumn("able", F.lit(True)), ["k1", "k2", "able"], "left"
    )
    named = named.join(stage(counts, "link-counts"), "id", "left").join(
        found.select(F.col("node").alias("id"), "component"), "id", "left"
    )
    component = F.coalesce("component", "id", "vec_id")
    return named.select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


ORACLE = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), scaled AS (
  SELECT vec_id, label, len(e) AS dims, [x / sqrt(list_dot_product(e, e)) FOR x IN e] AS u FROM usable
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM scaled a JOIN scaled b
  ON a.label = b.label AND a.dims = b.dims AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.u, b.u) >= {COSINE}
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
), smallest AS (
  SELECT a AS vec_id, min(b) AS m FROM reach GROUP BY a
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id))::BIGINT AS component_id,
  vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN counted USING (vec_id) LEFT JOIN smallest USING (vec_id)
"""

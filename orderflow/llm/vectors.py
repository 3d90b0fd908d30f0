"""Near-duplicate vectors by randomly rotated binary codes with correction factors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import mixed, written
from orderflow.llm.graph import components

#: Tables of cells, and bits of a cell's number: how vectors that may be alike are brought together.
TABLES = 18
CELL_BITS = 16
#: Standard deviations that an estimate may be off.
SURE = 5.0
_BLOCK = 512
_PAIRS_AT_ONCE = 100_000
#: Rows of the tiles that one call compares, about.
_BUNDLE = 10_000
_ODD = mixed(np.arange(100, 104)) | np.uint64(1)


def rotation(dims: int, seed: int = 3) -> np.ndarray:
    """A random orthogonal matrix."""
    matrix, upper = np.linalg.qr(np.random.default_rng([seed, dims]).standard_normal((dims, dims)))
    return matrix * np.sign(np.diag(upper))


def cells(unit: np.ndarray) -> np.ndarray:
    """The cell of each vector in each table: on which side of random planes it lies."""
    dims = unit.shape[1]
    planes = np.random.default_rng([4, dims]).standard_normal((dims, TABLES * CELL_BITS))
    bits = (unit @ planes > 0).reshape(len(unit), TABLES, CELL_BITS)
    return (bits * (1 << np.arange(CELL_BITS))).sum(axis=2).astype(np.uint16)


class Codes:
    """Signs of rotated vectors, and by how much each vector agrees with its signs."""

    def __init__(self, unit: np.ndarray):
        self.rotated = unit @ rotation(unit.shape[1])
        self.signs = np.packbits(self.rotated > 0, axis=1)
        self.agreement = np.abs(self.rotated).sum(axis=1) / np.sqrt(unit.shape[1])

    def estimates(self, queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unbiased estimates of inner products of rotated queries with the vectors at rows, and their bounds.

        The inner product of a query with a vector's signs, over the vector's agreement with
        them, is right in the mean over rotations; what remains spreads as the part of the
        vector that its signs miss.
        """
        dims = self.rotated.shape[1]
        signs = np.unpackbits(self.signs[rows], axis=1, count=dims).astype(np.float32) * 2 - 1
        agreement = self.agreement[rows]
        found = np.einsum("ij,ij->i", queries, signs) / np.sqrt(dims) / agreement
        missed = np.sqrt(np.maximum(1 - agreement**2, 0)) / agreement
        return found, SURE * missed / np.sqrt(max(dims - 1, 1))


def _unit(column: pd.Series) -> np.ndarray:
    rows = np.stack([np.asarray(v, np.float64) for v in column])
    # Scaled first, so that squares neither vanish nor overflow.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _pairs(sizes_a: np.ndarray, sizes_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of asking and other rows within each tile, a bounded number at a time."""
    first_a, first_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
    row_tile = np.repeat(np.arange(len(sizes_a)), sizes_a)
    counts = sizes_b[row_tile]
    ends = np.cumsum(counts)
    begin = 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + _PAIRS_AT_ONCE, "right")))
        own = counts[begin:end]
        a = np.repeat(np.arange(begin, end), own)
        place = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        yield a, first_b[row_tile[a]] + place
        begin = end


def compare_tiles(tiles: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links within the tiles of a bundle: per asking vector their number, and a forest of them."""
    found = [_compared(same, least) for _, same in tiles.groupby(tiles["embedding"].map(len))]
    a, b, copies = (np.concatenate([x[k] for x in found]) if found else np.zeros(0, np.int64) for k in range(3))
    nodes, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    place_a, place_b = place[: len(a)], place[len(a) :]
    links = np.bincount(place_a, copies, len(nodes)).astype(np.int64)
    # The smallest neighbour by turns, until nothing changes: one link a vector is left.
    label, before = nodes.copy(), None
    while before is None or (label != before).any():
        before = label.copy()
        np.minimum.at(label, place_b, before[place_a])
        np.minimum.at(label, place_a, before[place_b])
    return pd.DataFrame({"a": nodes, "b": label, "links": links})


def _compared(tiles: pd.DataFrame, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Asking node, other node and the other's copies of every link, each in one table only."""
    tile = pd.MultiIndex.from_frame(tiles[["cell", "q", "t"]]).factorize()[0]
    order = np.argsort(tile, kind="stable")
    tiles, tile = tiles.iloc[order], tile[order]
    asks = tiles["asks"].to_numpy()
    count = int(tile.max()) + 1
    one, other = tiles[asks], tiles[~asks]
    cells_a, cells_b = (np.stack([np.frombuffer(c, np.uint16) for c in x["cells"]]).reshape(-1, TABLES) for x in (one, other))
    nodes_a, nodes_b = one["node"].to_numpy(), other["node"].to_numpy()
    table, copies = one["table"].to_numpy(), other["copies"].to_numpy()
    unit_a, unit_b = _unit(one["embedding"]), _unit(other["embedding"])
    codes, queries = Codes(unit_b), (unit_a @ rotation(unit_a.shape[1])).astype(np.float32)
    out: list[tuple] = []
    for a, b in _pairs(np.bincount(tile[asks], minlength=count), np.bincount(tile[~asks], minlength=count)):
        open_pairs = nodes_a[a] != nodes_b[b]
        a, b = a[open_pairs], b[open_pairs]
        # A pair counts in the first table in which it meets.
        first = (cells_a[a] == cells_b[b]).argmax(axis=1) == table[a]
        a, b = a[first], b[first]
        estimate, off = codes.estimates(queries[a], b)
        a, b = a[estimate + off >= least], b[estimate + off >= least]
        exact = np.einsum("ij,ij->i", unit_a[a], unit_b[b])
        a, b = a[exact >= least], b[exact >= least]
        out.append((nodes_a[a], nodes_b[b], copies[b]))
    if not out:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing
    return tuple(np.concatenate([x[k] for x in out]) for k in range(3))


def near_duplicates(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """Per vector vec_id, n_links, component_id and kept: links of cosine ``least`` or more.

    Only vectors of one label and length are compared. Equal vectors are one node with its number
    of copies. Nodes meet in the cells of ``TABLES`` tables of random planes: a pair of cosine
    0.98 shares one with probability 0.9995, closer ones more surely. Cells are cut into blocks
    and every two blocks of a cell are a tile. Tiles are compared in bundles. In a tile the inner products are estimated from
    binary codes of randomly rotated vectors and their correction factors; a pair whose estimate
    and its bound leave the threshold open is computed again in double precision. Links are
    counted in the tile and leave it as one link a node, so a dense cell gives no table of pairs.

    Vectors that are null, empty or zero or hold null or non-finite components, and those without
    a label, link with nothing and are components of their own. Repeated rows are vectors of
    their own with the same vec_id. No vectors give no rows. Extra columns are left out.
    """
    own = vectors.select(
        F.col("vec_id").cast("long"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>")
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    usable = F.coalesce(
        F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0.0), F.lit(False)
    )
    rows = written(
        own.withColumn("node", F.when(usable, F.xxhash64("label", "embedding"))), "vectors"
    )
    nodes = written(
        rows.filter("node IS NOT NULL").groupBy("node").agg(
            F.count("*").alias("copies"), F.min("vec_id").alias("vec_id"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
        ),
        "vector-nodes",
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            out = []
            for _, same in frame.groupby(frame["embedding"].map(len)):
                found = cells(_unit(same["embedding"]))
                out.append(
                    pd.DataFrame(
                        {"node": same["node"], "cells": [c.tobytes() for c in found], "cell": found.astype(np.int32).tolist()}
                    )
                )
            schema = pa.schema([("node", pa.int64()), ("cells", pa.binary()), ("cell", pa.list_(pa.int32()))])
            if out:
                yield pa.RecordBatch.from_pandas(pd.concat(out), schema, preserve_index=False)

    codes = written(
        nodes.select("node", "embedding").mapInArrow(placed, "node long, cells binary, cell array<int>"), "vector-cells"
    )
    carried = written(nodes.join(codes, "node"), "vector-codes")
    spots = carried.select(
        "node",
        F.posexplode("cell").alias("table", "value"),
        F.xxhash64("label", F.size("embedding")).alias("space"),
    ).select("node", "table", F.xxhash64("space", "table", "value").alias("cell"))
    spots = written(spots, "vector-spots")
    sizes = written(spots.groupBy("cell").agg(F.count("*").alias("members")).filter("members > 1"), "cell-sizes")
    blocks = F.ceil(F.col("members") / _BLOCK).cast("long")
    every = F.sequence(F.lit(0).cast("long"), blocks - 1)
    block = F.pmod(F.xxhash64("node"), blocks)
    split = written(
        spots.join(sizes, "cell").withColumn("block", block).withColumn("every", every), "cell-blocks"
    )
    asking = split.select("cell", "table", "node", F.col("block").alias("q"), F.explode("every").alias("t"), F.lit(True).alias("asks"))
    asked = split.select("cell", "table", "node", F.explode("every").alias("q"), F.col("block").alias("t"), F.lit(False).alias("asks"))
    tiles = asking.unionByName(asked).join(carried.select("node", "copies", "embedding", "cells"), "node")
    rows_in_tiles = sizes.agg(F.sum(2 * F.col("members") * blocks)).first()[0] or 0
    bundle = F.pmod(F.xxhash64("cell", "q", "t"), F.lit(rows_in_tiles // _BUNDLE + 1))
    found = written(
        tiles.groupBy(bundle.alias("bundle")).applyInPandas(lambda own: compare_tiles(own, least), "a long, b long, links long"),
        "vector-links",
    )
    counts = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    classes = components(found.select("a", "b"))
    named = nodes.select("node", "vec_id", "copies").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    by_node = written(
        named.join(names, "root").join(counts, "node", "left").select(
            "node", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
        ),
        "vector-names",
    )
    out = rows.select("vec_id", "node").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )

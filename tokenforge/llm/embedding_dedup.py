"""Embedding near-duplicates by int8 tile products with error bounds (operator 8).

Vectors are scaled to unit length and rounded once to int8 with a scale of their own; the length of what rounding took
away is kept.  With x = x' + dx and y = y' + dy, the true cosine lies within |x'||dy| + |dx||y'| + |dx||dy| of the
product of the rounded vectors, so pairs whose whole interval lies on one side of the threshold are settled by the int8
product alone; the others are computed anew from the full vectors in double precision.

Vectors are ordered by the nearest of a few fixed directions and cut into tiles of at most TILE rows; each pair of
tiles is one row of work, held by one task at a time, and what is moved for it are the int8 codes.  Full vectors are moved
for the rows of unsettled pairs only, once for each pair of tiles.  Tile pairs that lie too far apart on the sphere (centre
and radius) are never paired; which are near is found over a grid of groups of tiles, so no task meets all of them.  A tile
pair returns the number of links of each row and a spanning forest of the links, not the links, so groups of copies do not
grow into pairs.

Defined cases: vectors that are null, empty, zero or that hold null or non-finite components link with nothing; only
vectors of one length are compared; repeated rows with one vec_id each get a row and link like others; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import components, dropped, stored, table, whole_groups

THRESHOLD = 0.9
#: Rows of a tile at most, about.
TILE = 2048
#: Slack for rounding in float32 sums and in the comparison of angles.
SLACK = 1e-5


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 rows, their scales and the lengths of the rounding errors, of unit rows ``x`` in double precision."""
    scale = np.abs(x).max(1) / 127
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def _unit(full: np.ndarray) -> np.ndarray:
    full = full.astype(np.float64)
    full = full / np.abs(full).max(1, keepdims=True)
    return full / np.linalg.norm(full, axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosines of the rows of ``x`` and ``y`` in double precision, from the vectors as they are."""
    with np.errstate(all="ignore"):
        cos = np.einsum("ij,ij->i", x, y) / (np.linalg.norm(x, axis=1) * np.linalg.norm(y, axis=1))
    odd = ~np.isfinite(cos)
    if odd.any():  # over- or underflow of squares
        cos[odd] = np.einsum("ij,ij->i", _unit(x[odd]), _unit(y[odd]))
    return cos


def settled(a: tuple, b: tuple, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of two tiles ``(codes, scales, errors)``: the pairs that surely link, and those that may (rows, columns of each).

    ``same``: ``a`` is ``b`` and each pair is wanted once.
    """
    (qa, sa, ea), (qb, sb, eb) = a, b
    # |int8 product| < 2**24 up to 1040 components: exact in float32, whose products the BLAS does fast
    kind = np.float32 if qa.shape[1] <= 1040 else np.float64
    fb = qb.astype(kind).T
    out: list[list[np.ndarray]] = [[], [], [], []]
    for lo in range(0, len(qa), 256):
        part = slice(lo, lo + 256)
        dot = (qa[part].astype(kind) @ fb) * sa[part, None].astype(np.float32) * sb[None].astype(np.float32)
        # |x'| <= 1 + |dx|
        bound = (1 + ea[part])[:, None] * eb[None] + ea[part][:, None] * (1 + eb)[None] + (ea[part][:, None] * eb[None]) + SLACK
        sure = dot >= threshold + bound
        for k, found in enumerate((sure, ~sure & (dot >= threshold - bound))):
            r, c = np.nonzero(found)
            r += lo
            if same:
                r, c = r[r < c], c[r < c]
            out[2 * k].append(r)
            out[2 * k + 1].append(c)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def forest(n: int, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a graph on ``n`` nodes: labels spread in rounds, one edge a node and round at most."""
    label, out = np.arange(n), []
    while len(rows):
        x, y = label[rows], label[cols]
        live = x != y
        rows, cols, x, y = rows[live], cols[live], x[live], y[live]
        if not len(rows):
            break
        hi, lo = np.maximum(x, y), np.minimum(x, y)
        order = np.lexsort((lo, hi))
        first = order[np.concatenate(([True], hi[order][1:] != hi[order][:-1]))]
        parent = np.arange(n)
        parent[hi[first]] = lo[first]  # one smaller label each: no circle
        out += zip(rows[first].tolist(), cols[first].tolist(), strict=True)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        label = parent[label]
    return out


def _directions(dim: int, k: int) -> np.ndarray:
    x = np.random.default_rng(dim).standard_normal((k, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of usable vectors, and their lengths."""
    good, sizes = [], []
    for i, v in enumerate(column):
        if v.is_valid and len(v) and v.values.null_count == 0:
            x = np.asarray(v.values)
            if np.isfinite(x).all() and x.any():
                good.append(i)
                sizes.append(len(x))
    return np.array(good, np.int64), np.array(sizes, np.int64)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes with their length and nearest direction."""
    known: dict[int, np.ndarray] = {}
    for b in batches:
        column = b.column("embedding")
        good, sizes = _matrix(column)
        ids = b.column("vec_id").take(pa.array(good))
        raw, near = [], []
        for i, n in zip(good, sizes, strict=True):
            x = np.asarray(column[int(i)].values).astype(np.float64)
            if n not in known:
                known[n] = _directions(int(n), 64)
            near.append(int(np.argmax(known[n] @ (x / np.abs(x).max()))))
            raw.append(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(sizes, pa.int32()), pa.array(near, pa.int32()), pa.array(raw, pa.binary())], names=["vec_id", "dim", "near", "raw"]
        )


_TILES = pa.schema(
    [("dim", pa.int32()), ("tile", pa.string()), *((c, pa.binary()) for c in ("ids", "codes", "scales", "errors", "centre")), ("radius", pa.float64())]
)


def _tiles(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        held: dict[int, list] = {}

        def close(dim: int) -> pa.RecordBatch:
            rows = held.pop(dim)
            u = _unit(np.stack([np.frombuffer(r, np.float64) for _, r in rows]))
            centre = u.mean(0)
            size = np.linalg.norm(centre)
            radius = math.pi
            if size > 1e-9:
                centre /= size
                radius = float(np.arccos(np.clip((u @ centre).min(), -1, 1)))
            codes, scales, errors = quantised(u)
            x = {"ids": np.array([i for i, _ in rows], np.int64), "codes": codes, "scales": scales, "errors": errors, "centre": centre}
            return pa.RecordBatch.from_pylist([{"dim": dim, "tile": uuid.uuid4().hex, "radius": radius} | {k: v.tobytes() for k, v in x.items()}], schema=_TILES)

        for b in batches:
            for i, d, r in zip(*(b.column(c).to_pylist() for c in ("vec_id", "dim", "raw")), strict=True):
                rows = held.setdefault(d, [])
                rows.append((i, r))
                if len(rows) >= most:
                    yield close(d)
        for d in list(held):
            yield close(d)

    return run


#: What a pair of tiles gives: numbers of links (``vec, links``), edges of a forest (``vec, other``), rows whose full vectors
#: are needed (``pair, vec``, and their place in ``other``), and the unsettled pairs of places (``pair, mask``).
COUNT, EDGE, NEED, MASK = range(4)
_FOUND = "kind int, pair string, vec long, other long, links long, mask binary"
_FOUND_SCHEMA = pa.schema([("kind", pa.int32()), ("pair", pa.string()), ("vec", pa.int64()), ("other", pa.int64()), ("links", pa.int64()), ("mask", pa.binary())])


def _found(kind: int, vec, other=None, links=None, pair: str | None = None, mask: bytes | None = None) -> pa.RecordBatch:
    n = len(vec)
    wide = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x, pa.int64())
    arrays = [pa.array([kind] * n, pa.int32()), pa.array([pair] * n, pa.string()), wide(vec), wide(other), wide(links), pa.array([mask] * n, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, schema=_FOUND_SCHEMA)


def _links(every: np.ndarray, r: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts and a spanning forest of links between places ``r`` and ``c`` of the rows ``every``."""
    if len(r):
        count = np.bincount(r, minlength=len(every)) + np.bincount(c, minlength=len(every))
        some = np.flatnonzero(count)
        yield _found(COUNT, every[some], links=count[some])
        edges = np.array(forest(len(every), r, c), np.int64)
        yield _found(EDGE, every[edges[:, 0]], every[edges[:, 1]])


def _pairs(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                x = {c: b.column(c)[row].as_py() for c in b.schema.names}
                same = x["tile"] == x["tile2"]

                def side(end: str, x=x) -> tuple:
                    ids = np.frombuffer(x["ids" + end], np.int64)
                    codes = np.frombuffer(x["codes" + end], np.int8).reshape(len(ids), -1)
                    return ids, (codes, *(np.frombuffer(x[k + end], np.float64) for k in ("scales", "errors")))

                ids, a = side("")
                ids2, c = (ids, a) if same else side("2")
                every = ids if same else np.concatenate((ids, ids2))
                shift = 0 if same else len(ids)
                r, k, r2, k2 = settled(a, c, threshold, same)
                yield from _links(every, r, k + shift)
                if len(r2):
                    pair, k2 = f"{x['tile']}|{x['tile2']}", k2 + shift
                    places = np.unique(np.concatenate((r2, k2)))
                    yield _found(NEED, every[places], places, pair=pair)
                    mask = zlib.compress(np.stack((r2, k2)).astype(np.uint16 if len(every) <= 1 << 16 else np.uint32).tobytes(), 1)
                    yield _found(MASK, [-1], [-1], [len(every)], pair, mask)

    return run


def _resolved(threshold: float):
    """Links of unsettled pairs in full precision, from rows grouped by pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, ["pair"]):
            pairs = t.column("pair").to_pylist()
            start = 0
            while start < len(pairs):
                stop = start + 1
                while stop < len(pairs) and pairs[stop] == pairs[start]:
                    stop += 1
                one = t.slice(start, stop - start)
                start = stop
                at, vec = one.column("other").to_numpy(), one.column("vec").to_numpy()
                order = np.argsort(at, kind="stable")  # the mask comes first
                n, mask = one.column("links")[int(order[0])].as_py(), one.column("mask")[int(order[0])].as_py()
                r, c = np.frombuffer(zlib.decompress(mask), np.uint16 if n <= 1 << 16 else np.uint32).reshape(2, -1).astype(np.int64)
                rows = order[1:]
                vectors = one.column("embedding")
                full = np.array([vectors[int(i)].as_py() for i in rows], np.float64)
                place = np.searchsorted(at[rows], np.stack((r, c)))
                keep = []
                for k in range(0, len(r), 1 << 15):
                    keep.append(cosines(full[place[0, k : k + (1 << 15)]], full[place[1, k : k + (1 << 15)]]) >= threshold)
                keep = np.concatenate(keep)
                yield from _links(vec[rows], place[0][keep], place[1][keep])

    return run


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding)``."""
    reach = math.acos(threshold) + SLACK
    # rows are told apart by a number of their own, as vec_id may repeat
    numbered, _ = stored(vectors.select("vec_id", "embedding").withColumn("row", F.monotonically_increasing_id()), "vectors")
    usable = numbered.select(F.col("row").alias("vec_id"), "embedding").mapInArrow(_rows, "vec_id long, dim int, near int, raw binary")
    # equal counts a range, whatever direction is crowded: the row number splits it
    laid = usable.repartitionByRange(F.col("dim"), F.col("near"), F.xxhash64("vec_id")).sortWithinPartitions("dim", "near")
    schema = "dim int, tile string, ids binary, codes binary, scales binary, errors binary, centre binary, radius double"
    tiles, tiles_path = stored(laid.mapInArrow(_tiles(tile), schema), "vector-tiles")
    pairs, pairs_path = stored(_near_tiles(tiles, reach), "tile-pairs")
    body = tiles.select("tile", "ids", "codes", "scales", "errors")
    body2 = tiles.select(*(F.col(c).alias(c + "2") for c in body.columns))
    first, first_path = stored(pairs.join(body, "tile").join(body2, "tile2").mapInArrow(_pairs(threshold), _FOUND), "vector-found")
    full = first.where(F.col("kind") == NEED).join(numbered.select(F.col("row").alias("vec"), "embedding"), "vec")
    masks = first.where(F.col("kind") == MASK).withColumn("embedding", F.lit(None).cast(numbered.schema["embedding"].dataType))
    columns = ["pair", "vec", "other", "links", "mask", "embedding"]
    unsettled = full.select(columns).unionByName(masks.select(columns)).repartition("pair").sortWithinPartitions("pair")
    links = first.where(F.col("kind") <= EDGE).unionByName(unsettled.mapInArrow(_resolved(threshold), _FOUND))
    links, _ = stored(links.select("kind", "vec", "other", "links"), "vector-links")
    for path in (tiles_path, pairs_path, first_path):
        dropped(vectors.sparkSession, path)
    counts = links.where(F.col("kind") == COUNT).groupBy(F.col("vec").alias("row")).agg(F.sum("links").alias("n_links"))
    edges = links.where(F.col("kind") == EDGE).select(F.col("vec").alias("src"), F.col("other").alias("dst"))
    rows = components(edges, "vector-cc").withColumnsRenamed({"id": "row", "component": "root"})
    placed = numbered.select("vec_id", "row").join(counts, "row", "left").join(rows, "row", "left")
    least = placed.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    return placed.join(least, "root", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(False)).alias("kept"),
    )


def _near(reach: float):
    """Which tile pairs can hold a link: their centres are not farther apart than both radii and the reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = (np.frombuffer(b.column(c)[i].as_py(), np.float64) for c in ("centre", "centre2"))
                far = math.acos(max(-1.0, min(1.0, float(x @ y)))) if np.linalg.norm(x) > 0.5 and np.linalg.norm(y) > 0.5 else 0.0
                keep[i] = far <= b.column("radius")[i].as_py() + b.column("radius2")[i].as_py() + reach
            yield b.select(["tile", "tile2"]).filter(pa.array(keep))

    return run


#: Tiles of a group at most, about, when near tiles are looked for.
GROUP = 256


def _near_tiles(tiles: DataFrame, reach: float) -> DataFrame:
    """``(tile, tile2)``: the pairs of tiles of one length that can hold a link, each once.

    The square of tiles is cut into a grid of groups, and each field of its upper half is a key of its own.
    """
    heads = tiles.select("dim", "tile", "centre", "radius")
    sizes = heads.groupBy("dim").agg(F.ceil(F.count("*") / F.lit(GROUP)).cast("int").alias("g"))
    placed = heads.join(sizes, "dim").withColumn("own", F.pmod(F.xxhash64("tile"), F.col("g")).cast("int"))
    fields = placed.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    row = fields.where("own <= to").select("dim", F.col("own").alias("x"), F.col("to").alias("y"), "tile", "centre", "radius")
    column = fields.where("to <= own").select(
        "dim", F.col("to").alias("x"), F.col("own").alias("y"), *(F.col(c).alias(c + "2") for c in ("tile", "centre", "radius"))
    )
    # in a field off the diagonal the two sides are different groups
    return row.join(column, ["dim", "x", "y"]).where("x < y or tile <= tile2").select("tile", "tile2", "centre", "centre2", "radius", "radius2").mapInArrow(
        _near(reach), "tile string, tile2 string"
    )


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


OP8_SQL = """
with recursive v as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0 and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
    and list_bool_or(list_transform(embedding, lambda x: x <> 0))),
n as (select vec_id, e, sqrt(list_inner_product(e, e)) as s from v),
l as (select a.vec_id as x, b.vec_id as y from n a, n b
  where a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_inner_product(a.e, b.e) / (a.s * b.s) >= 0.9),
r(x, y) as (select x, y from l union select r.x, l.y from r join l on r.y = l.x),
c as (select x, least(x, min(y)) as component_id from r group by x),
k as (select x, count(*) as n_links from l group by x)
select e.vec_id, coalesce(k.n_links, 0)::bigint as n_links, coalesce(c.component_id, e.vec_id)::bigint as component_id,
  coalesce(c.component_id, e.vec_id) = e.vec_id as kept
from embeddings e left join k on k.x = e.vec_id left join c on c.x = e.vec_id
"""

"""N-gram Jaccard join by vertical partitioning (operator 4).

The global order of word n-grams is the order of their 64-bit hashes.  Documents with equal sets form a class, named by
the set's digest.  What can have a link is found without pairs: two sets with Jaccard t or more share at least l of the
first n - ceil(t n) + l n-grams in the global order, so a class survives only if enough of its first n-grams occur in
another class.  Of those, each leaves out as many of the most frequent as a partner must share beyond one, which keeps
passages that many documents hold from tying them together.  N-grams that repeat within a batch are known to be shared there; only two of their rows go to the
common group and the rest are salted, so that a frequent n-gram is dealt to many tasks.

Survivors that share first n-grams and have sizes in reach of each other form blocks.  Passages that many documents hold
still tie some of them together, so a block of more than one tile is taken apart again by its whole sets: its n-grams
are ordered by how many sets have them (counted by their low bits), linked sets share one of their n - ceil(t n) + 1 rarest, and classes that
share one of those form new blocks.  A block, or a pair of tiles of at most TILE classes and TILE_GRAMS n-grams from one (about: tiles are dealt by hash), is a unit of work; only tiles that
share one of those first n-grams are paired.  A unit's sets are cut along the global order into FRAGMENTS vertical fragments.
Each fragment counts the partial overlaps of its pairs on its own, the counts are summed per pair, and pairs at or above
the threshold link.  A unit returns a spanning forest of its links, so that groups of near copies never become pairs.

Defined cases: null texts and texts without words have no set, link with nothing and are their own component; texts of
fewer words than n have one n-gram, the whole sequence; repeated rows each get a row, and equal doc_ids are one
document for components; a null doc_id gets a null component unless its class has another; an empty table gives an
empty result; other columns are ignored by the join and kept by :func:`distinct_documents`.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .embedding_dedup import forest
from .shared import components, made_filter, spread, stored, table, unused, whole_groups

#: Classes of a tile at most, about.
TILE = 512
#: N-grams of all classes of a tile at most, about: 16 MB.
TILE_GRAMS = 1 << 21
#: Vertical fragments of a unit of work.
FRAGMENTS = 4
#: Parts in which the classes of a crowded block or leading n-gram meet its counts.
SALTS = 32
#: Classes of one n-gram that meet its leader in one task, about.
LED = 4096
#: Counts of n-grams are kept by so many low bits at most: 16 MB.  More n-grams share counts, and none is lost.
MOST_COUNTS = 22
#: Parts of the counts, each a row of its own while they are summed.
_PARTS = 64
_TURN = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def _distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values; faster than ``np.unique``, which hashes integers before it sorts them."""
    x = np.sort(x)
    keep = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    return x[keep]


def ngram_sets(column: pa.Array, n: int, words: np.ndarray = tk.GRAPH) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    buf, off = tk.flat(column)
    hasher = tk.Hasher()
    for a, b in tk.slices(off):
        low, own = tk.LOWER[buf[off[a] : off[b]]], off[a : b + 1] - off[a]
        starts, ends, rows = tk.word_spans(low, own, words)
        h = hasher.spans(low, starts, ends)
        edges = np.searchsorted(rows, np.arange(b - a + 1))
        full = max(0, len(h) - n + 1)
        grams = np.zeros(full, np.uint64)
        for k in range(n):
            grams += h[k : k + full] * _TURN[k]
        grams = tk.mix(grams)
        for i in range(b - a):
            lo, hi = edges[i], edges[i + 1]
            if hi - lo >= n:
                yield _distinct(grams[lo : hi - n + 1])
            elif hi > lo:
                short = np.uint64(hi - lo)
                for k in range(lo, hi):
                    short = tk.mix(np.array([short ^ h[k]]) * _TURN[k - lo])[0]
                yield np.array([short])
            else:
                yield grams[:0]


def set_digest(s: np.ndarray) -> int:
    """A signed 64-bit digest of a set of hashes."""
    x = tk.mix(s + np.uint64(0x5BD1E995))
    return int(tk.mix(np.array([x.sum(dtype=np.uint64) + np.uint64(len(s))])).view(np.int64)[0])


def least_overlap(n: int, percent: int) -> int:
    """The fewest members that a set of ``n`` shares with one of at least that similarity."""
    return -(-n * percent // 100)


def _band(n: Column, percent: int) -> Column:
    """The band of a set's size: those of linked sets are the same or neighbours."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(percent / 100)) + F.lit(1e-9)).cast("int")


def spare(n: int) -> int:
    """How many first n-grams two sets must share beyond the one that any link implies."""
    return max(1, n // 16)


_FIRST = "token long, flag int, digest long, doc_id long, n int"


def _first(n: int, percent: int):
    """First n-grams of each class in a batch, and a row for each document (flag -1)."""
    schema = pa.schema([("token", pa.int64()), ("flag", pa.int32()), ("digest", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[int, np.ndarray] = {}
            digests, sizes = [], []
            for s in ngram_sets(b.column("text"), n):
                d = set_digest(s) if len(s) else None
                digests.append(d)
                sizes.append(len(s))
                if d is not None and d not in seen:
                    seen[d] = s[: len(s) - least_overlap(len(s), percent) + spare(len(s))]
            k = b.num_rows
            ids = b.column("doc_id")
            # spread over tasks, copies and empty texts too
            start = np.uint64(next((d for d in digests if d is not None), 0) & (2**64 - 1))
            own = pa.array(tk.mix(start + np.arange(k, dtype=np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [own, pa.array(np.full(k, -1, np.int32)), pa.array(digests, pa.int64()), ids.cast(pa.int64()), pa.array(sizes, pa.int32())], schema=schema
            )
            if not seen:
                continue
            tokens = np.concatenate(list(seen.values())).view(np.int64)
            owners = np.repeat(np.fromiter(seen, np.int64, len(seen)), [len(x) for x in seen.values()])
            order = np.lexsort((owners, tokens))
            tokens, owners = tokens[order], owners[order]
            first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
            last = np.concatenate((first[1:], [True]))
            alone = first & last
            # 0: alone in the batch, 1: an end of a run, from 2 on: salted
            flag = np.where(alone, 0, np.where(first | last, 1, 2 + (owners & 63))).astype(np.int32)
            for lo in range(0, len(tokens), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                m = len(tokens[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[part]), pa.array(flag[part]), pa.array(owners[part]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32())], schema=schema
                )

    return run


def _sets(n: int, shared):
    """Sets of classes in the filter, as bytes, once for each batch.

    The filter holds a doc_id of each class too, so only texts of such documents, and those without a doc_id, are cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for b in batches:
            ids = b.column("doc_id").cast(pa.int64())
            nameless = ids.is_null().to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(nameless | wanted.has(ids.fill_null(0).to_numpy(zero_copy_only=False))))
            seen: set[int] = set()
            digests, raw, size = [], [], 0
            for s in ngram_sets(b.column("text"), n):
                if not len(s):
                    continue
                d = set_digest(s)
                if d in seen:
                    continue
                if wanted.has(np.array([d], np.int64))[0]:
                    seen.add(d)
                    digests.append(d)
                    raw.append(s.tobytes())
                    size += s.nbytes
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(raw, pa.binary())], names=["digest", "grams"])
                    digests, raw, size = [], [], 0
            if digests:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(raw, pa.binary())], names=["digest", "grams"])

    return run


def overlaps(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Numbers of common members: of the first ``split`` sets with the rest, or of all pairs where ``split`` is 0."""
    m = len(sets)
    tokens = np.concatenate(sets)
    owners = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, owners = tokens[order], owners[order]
    same = np.zeros(len(tokens) + 1, bool)
    same[1:-1] = tokens[1:] == tokens[:-1]
    keep = same[:-1] | same[1:]
    owners, fresh = owners[keep], ~same[:-1][keep]
    number = np.cumsum(fresh) - 1
    a, b = (m, m) if not split else (split, m - split)
    out = np.zeros((a, b), np.float32)
    total = int(number[-1]) + 1 if len(number) else 0
    step = max(64, (1 << 21) // max(m, 1))
    for lo in range(0, total, step):
        i, j = np.searchsorted(number, [lo, lo + step])
        x = np.zeros((min(step, total - lo), m), np.float32)
        x[number[i:j] - lo, owners[i:j]] = 1
        out += (x.T @ x) if not split else x[:, :split].T @ x[:, split:]
    return out.astype(np.int32)


_PARTIAL = pa.schema([("unit", pa.string()), ("digests", pa.binary()), ("sizes", pa.binary()), ("split", pa.int32()), ("counts", pa.binary())])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial overlaps of the pairs of each (unit, fragment)."""
    for t in whole_groups(batches, ["unit", "fragment"]):
        units, fragments = t.column("unit").to_pylist(), t.column("fragment").to_pylist()
        sides, digests = t.column("side").to_pylist(), t.column("digest").to_numpy()
        sizes, grams = t.column("n").to_numpy(), t.column("grams")
        i, rows, held = 0, [], 0
        while i < len(units):
            j = i + 1
            while j < len(units) and units[j] == units[i] and fragments[j] == fragments[i]:
                j += 1
            order = sorted(range(i, j), key=lambda r: (sides[r], digests[r]))
            split = sum(sides[r] == 0 for r in order) if sides[order[-1]] else 0
            if len(order) > 1 and (split or not sides[order[-1]]):
                found = overlaps([np.frombuffer(grams[r].as_py(), np.uint64) for r in order], split)
                rows.append((units[i], digests[order].tobytes(), sizes[order].astype(np.int32).tobytes(), split, found.tobytes()))
                held += found.nbytes
            i = j
            if rows and (held > 1 << 23 or i == len(units)):
                yield pa.RecordBatch.from_pydict(dict(zip(_PARTIAL.names, zip(*rows, strict=True), strict=True)), schema=_PARTIAL)
                rows, held = [], 0


def _summed(percent: int):
    """Links of each unit from its fragments' counts, as a spanning forest and the number of links."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(digests, sizes, split, total) -> pa.RecordBatch | None:
            a, b = (np.arange(split), np.arange(split, len(sizes))) if split else (np.arange(len(sizes)),) * 2
            union = sizes[a][:, None] + sizes[b][None] - total
            r, c = np.nonzero(100 * total.astype(np.int64) >= percent * union)
            r, c = a[r], b[c]
            r, c = r[r != c], c[r != c]
            edges = forest(len(digests), r, c)
            if not edges:
                return None
            e = np.array(edges)
            return pa.RecordBatch.from_arrays([pa.array(digests[e[:, 0]]), pa.array(digests[e[:, 1]])], schema=schema)

        unit, held = None, None
        for b in batches:
            for k in range(b.num_rows):
                u = b.column("unit")[k].as_py()
                split = b.column("split")[k].as_py()
                digests = np.frombuffer(b.column("digests")[k].as_py(), np.int64)
                sizes = np.frombuffer(b.column("sizes")[k].as_py(), np.int32).astype(np.int64)
                shape = (split, len(sizes) - split) if split else (len(sizes),) * 2
                counts = np.frombuffer(b.column("counts")[k].as_py(), np.int32).reshape(shape)
                if u != unit:
                    if held is not None and (out := close(*held)) is not None:
                        yield out
                    unit, held = u, (digests, sizes, split, counts.astype(np.int64))
                else:
                    held[3][...] += counts  # all fragments list the same classes
        if held is not None and (out := close(*held)) is not None:
            yield out

    return run


def _tiles(tile: int) -> Column:
    """How many tiles the classes of a group take: they are dealt by hash, so they are planned a quarter smaller than they may be."""
    return F.greatest(F.ceil(F.count("*") * 4 / F.lit(3 * tile)), F.ceil(F.sum(F.col("n").cast("long")) / F.lit(TILE_GRAMS))).cast("int")


def _blocks(telling: DataFrame, percent: int, name: str) -> DataFrame:
    """``(digest, block)``: classes of sizes in reach that share one of ``telling(token, digest, n, cuts)``."""
    band = _band(F.col("n"), percent)
    reach = telling.select("token", "cuts", F.pmod("digest", "cuts").alias("part"), "digest", F.explode(F.array(band, band + 1)).alias("band"))

    def led(members: DataFrame, *key: str) -> DataFrame:
        leaders = members.groupBy(*key).agg(F.min("digest").alias("leader"), F.max("digest").alias("last")).where("leader < last").drop("last")
        return members.join(leaders, list(key)).where("digest <> leader").select(F.col("digest").alias("src"), F.col("leader").alias("dst"))

    # a part of a frequent n-gram's classes meets its own leader, then the leaders of parts meet theirs
    heads = reach.where("cuts > 1").groupBy("token", "band", "part").agg(F.min("digest").alias("digest"))
    edges = led(reach, "token", "band", "part").unionByName(led(heads, "token", "band")).distinct()
    return components(edges, name).withColumnsRenamed({"id": "digest", "component": "block"})


def _counts(sets: DataFrame, bits: int) -> np.ndarray:
    """How many of the sets ``(grams)`` have n-grams of each ``bits`` low bits, built by all tasks."""
    size = 1 << bits
    step = size // _PARTS

    def given(parts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for k, x in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], names=["part", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.int32)
        for b in batches:
            grams = np.frombuffer(b"".join(b.column("grams").to_pylist()), np.uint64)
            own += np.bincount((grams & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.int32)
        yield from given({k: x for k, x in enumerate(own.reshape(_PARTS, step)) if x.any()})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("part").to_pylist(), b.column("c").to_pylist(), strict=True):
                parts[k] = parts.get(k, 0) + np.frombuffer(zlib.decompress(x), np.int32)
        yield from given(parts)

    out = np.zeros(size, np.int32)
    for r in sets.select("grams").mapInArrow(run, "part int, c binary").repartition("part").mapInArrow(joined, "part int, c binary").toLocalIterator():
        out[r["part"] * step : (r["part"] + 1) * step] += np.frombuffer(zlib.decompress(r["c"]), np.int32)
    return out


_RARE = pa.schema([("token", pa.int64()), ("digest", pa.int64()), ("n", pa.int32())])


def _rare(shared, percent: int):
    """The n-grams of ``(block, digest, n, grams)`` of which linked sets share one at least, but those that no other set has.
    A token names an n-gram and a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for b in batches:
            tokens, rows, held = [], [], 0
            blocks, digests, sizes = (b.column(c).to_numpy() for c in ("block", "digest", "n"))
            for i, x in enumerate(b.column("grams")):
                s = np.frombuffer(x.as_py(), np.uint64)
                often = counts[(s & np.uint64(len(counts) - 1)).astype(np.int64)]
                # equal counts stay in the order of their hashes, so the order is one for all sets
                rarest = np.argsort(often, kind="stable")[: len(s) - least_overlap(len(s), percent) + 1]
                s = s[rarest[often[rarest] > 1]]
                tokens.append(tk.mix(s + blocks[i : i + 1].view(np.uint64)).view(np.int64))
                rows.append(np.full(len(s), i))
                held += len(s)
                if held > 1 << 16 or i == b.num_rows - 1:
                    at = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(digests[at]), pa.array(sizes[at])], schema=_RARE)
                    tokens, rows, held = [], [], 0

    return run


def _rarest(classes: DataFrame, percent: int) -> DataFrame:
    """``(token, digest, n, cuts)``: the rarest n-grams of ``(block, digest, n, grams)`` that several classes of a block have.

    Counts are by low bits of n-grams: any order that is one for all sets will do, and what is frequent stays so.
    """
    spark = classes.sparkSession
    classes, _ = stored(classes, "ngram-crowded")
    total = classes.agg(F.sum(F.col("n").cast("long"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(_counts(classes, min(MOST_COUNTS, max(16, total.bit_length()))))
    rows = classes.mapInArrow(_rare(shared, percent), "token long, digest long, n int")
    often = F.count("*").over(Window.partitionBy("token"))
    return rows.withColumn("often", often).where("often > 1").select("token", "digest", "n", F.ceil(F.col("often") / F.lit(LED)).alias("cuts"))


def _units(survivors: DataFrame, telling: DataFrame, percent: int, tile: int) -> DataFrame:
    """``(digest, n, unit, side)``: the units of work of each survivor ``(digest, n, block)``.

    ``telling(token, digest)``: the n-grams of which linked sets share one at least.
    """
    g = _tiles(tile)
    # what is counted per large group meets its classes in SALTS parts, so no task has a whole group
    salted = lambda df: df.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    large = salted(survivors.groupBy("block").agg(g.alias("g")).where("g > 1").select("block")).withColumn("large", F.lit(True))
    told = survivors.withColumn("salt", F.pmod("digest", F.lit(SALTS)).cast("int")).join(large, ["block", "salt"], "left")
    whole = told.where("large is null").select("digest", "n", F.concat(F.lit("b"), F.col("block")).alias("unit"), F.lit(0).alias("side"))
    # sizes of linked sets lie in the same or in neighbouring bands
    large = told.where("large").drop("large").withColumn("band", _band(F.col("n"), percent))
    parts = salted(large.groupBy("block", "band").agg(g.alias("g")))
    # classes that share their leading n-gram lie together, so that few tiles share any
    lead = telling.groupBy("digest").agg(F.min("token").alias("lead"))
    dealt, _ = stored(large.join(parts, ["block", "band", "salt"]).join(lead, "digest"), "ngram-dealt")
    # a crowded leading n-gram is cut by the classes' own digests, into so small parts that tiles stay even
    parts_of = F.greatest(F.ceil(F.count("*") * 16 / F.lit(tile)), F.ceil(F.sum(F.col("n").cast("long")) * 16 / F.lit(TILE_GRAMS)))
    crowd = salted(dealt.groupBy("block", "band", "lead").agg(parts_of.cast("long").alias("cuts")).where("cuts > 1"))
    place = F.pmod(F.xxhash64("lead", F.pmod("digest", F.coalesce("cuts", F.lit(1).cast("long")))), F.col("g")).cast("int")
    tiles = dealt.join(crowd, ["block", "band", "lead", "salt"], "left").select("digest", "n", F.struct("block", "band", place.alias("t")).alias("tile"))
    tiles, _ = stored(tiles, "ngram-tiles")
    held = telling.join(tiles.select("digest", "tile"), "digest").select("token", "tile").distinct()
    other = held.select("token", F.col("tile").alias("tile2"))
    pairs = held.join(other, "token").where("tile.block = tile2.block and tile <= tile2 and tile2.band - tile.band <= 1").select("tile", "tile2").distinct()
    name = F.concat_ws("|", "tile.block", "tile.band", "tile.t", "tile2.band", "tile2.t")
    pairs, _ = stored(pairs.withColumn("unit", name), "ngram-tile-pairs")
    own = tiles.join(pairs.select("tile", "unit"), "tile").select("digest", "n", "unit", F.lit(0).alias("side"))
    far = pairs.where("tile <> tile2").select(F.col("tile2").alias("tile"), "unit")
    return whole.unionByName(own).unionByName(tiles.join(far, "tile").select("digest", "n", "unit", F.lit(1).alias("side")))


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the sets of ``(unit, side, digest, n, grams)`` along the global order."""
    cuts = (np.arange(1, FRAGMENTS, dtype=np.uint64)) << np.uint64(64 - (FRAGMENTS.bit_length() - 1))
    for b in batches:
        for k in range(0, b.num_rows, 256):
            part = b.slice(k, 256)
            raw, at = [], []
            for i, x in enumerate(part.column("grams")):
                s = np.frombuffer(x.as_py(), np.uint64)
                edge = [0, *np.searchsorted(s, cuts), len(s)]
                raw += [s[edge[f] : edge[f + 1]].tobytes() for f in range(FRAGMENTS)]
                at += [i] * FRAGMENTS
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c).take(at) for c in ("unit", "side", "digest", "n")), pa.array(list(range(FRAGMENTS)) * part.num_rows, pa.int32()), pa.array(raw, pa.binary())],
                names=["unit", "side", "digest", "n", "fragment", "grams"],
            )


def ngram_join(docs: DataFrame, n: int = 4, percent: int = 85, tile: int = TILE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for every row of ``docs(doc_id, text)``.

    Texts link when ``100 * |intersection| >= percent * |union|`` of their distinct ``n``-grams of words.
    """
    spark = docs.sparkSession
    first = docs.select("doc_id", "text").mapInArrow(_first(n, percent), _FIRST)
    group = Window.partitionBy("token", F.when(F.col("flag").isin(0, 1), 0).otherwise(F.col("flag")))
    shared = (F.col("flag") != 0) | (F.min("digest").over(group) != F.max("digest").over(group))
    kept, _ = stored(first.withColumn("shared", shared).where("shared").select("token", "digest", "doc_id", "n", "flag"), "ngram-first")
    rows = kept.where("flag = -1").select("doc_id", "digest", "n")
    classes = rows.where("digest is not null").groupBy("digest").agg(F.max("n").alias("n"), F.min("doc_id").alias("least"))
    # n-grams that several batches know of are there once for each
    tokens = kept.where("flag <> -1").select("token", "digest").repartition("digest").dropDuplicates(["digest", "token"])
    # a partner shares at least so many of the first n-grams
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n") * F.lit(percent) / 100) / 16))
    used = F.count("*").over(Window.partitionBy("digest"))
    own = tokens.withColumn("used", used).join(classes.select("digest", "n"), "digest").where(F.col("used") >= least)
    own, _ = stored(own.select("token", "digest", "n"), "ngram-survivors")
    # so the rarest that a pair shares is not among the last least - 1 of either in the order of their frequency
    often = own.groupBy("token").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("digest").orderBy(F.desc("often"), F.desc("token")))
    telling = own.join(often, "token").withColumn("place", place).where(F.col("place") >= least)
    telling, _ = stored(telling.select("token", "digest", "n", F.ceil(F.col("often") / F.lit(LED)).alias("cuts")), "ngram-telling")
    live, _ = stored(classes.join(_blocks(telling, percent, "ngram-blocks"), "digest"), "ngram-live")
    # a class of documents with doc_ids has one of its smallest, whatever other texts have that too
    told = live.select(F.explode(F.array("digest", "least")).alias("value")).where("value is not null")
    wanted = spark.sparkContext.broadcast(made_filter(told, "value", 2 * live.count()))
    sets = docs.select("doc_id", "text").mapInArrow(_sets(n, wanted), "digest long, grams binary").dropDuplicates(["digest"])
    sets, _ = stored(sets, "ngram-sets")
    # blocks of more than one tile are taken apart by their rarest n-grams
    crowded = live.groupBy("block").agg(_tiles(tile).alias("g")).where("g > 1").select("block")
    telling, _ = stored(_rarest(live.join(crowded, "block").join(sets, "digest").select("block", "digest", "n", "grams"), percent), "ngram-rarest")
    parted = live.join(crowded, "block").select("digest", "n").join(_blocks(telling, percent, "ngram-parted"), "digest")
    live, _ = stored(live.join(crowded, "block", "left_anti").select("digest", "n", "block").unionByName(parted), "ngram-parted-live")
    work = _units(live, telling, percent, tile).join(sets, "digest").select("unit", "side", "digest", "n", "grams")
    pieces = work.mapInArrow(_fragments, "unit string, side int, digest long, n int, fragment int, grams binary")
    partial = pieces.repartition("unit", "fragment").sortWithinPartitions("unit", "fragment").mapInArrow(
        _partial, "unit string, digests binary, sizes binary, split int, counts binary"
    )
    links = partial.repartition("unit").sortWithinPartitions("unit").mapInArrow(_summed(percent), "src long, dst long")
    links, _ = stored(links, "ngram-links")
    named = components(links, "ngram-cc").withColumnsRenamed({"id": "digest", "component": "root"})
    whole = classes.join(named, "digest", "left").select("digest", "least", F.coalesce("root", "digest").alias("root"))
    whole, _ = stored(whole, "ngram-classes")
    least = whole.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(whole.join(least, "root").select("digest", "component_id"), "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


def distinct_documents(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: the one with the smallest doc_id, once.

    Rows without a doc_id cannot be named and all stay.
    """
    best = ngram_join(docs, n, percent)
    keep, _ = stored(best.where("doc_id = component_id").select("doc_id").distinct(), "ngram-kept")
    named = docs.where("doc_id is not null").join(keep, "doc_id", "left_semi")
    same = unused(docs, "_same")
    once = named.withColumn(same, F.sha2("text", 256)).dropDuplicates(["doc_id", same]).select(*docs.columns)
    return once.unionByName(docs.where("doc_id is null"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def ngram_components_of_five(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join as the pipeline's stage has it: five words, a similarity of 0.8."""
    return ngram_join(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), n=5, percent=80)


OP4_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
s as (select distinct doc_id, g from (
  select doc_id, unnest(case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) when len(w) > 0 then [w] else [] end) as g from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as x, b.doc_id as y, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by all),
l as (select x, y from o join n a on a.doc_id = x join n b on b.doc_id = y where 100 * o >= 85 * (a.n + b.n - o)),
r(x, y) as (select x, y from l union select r.x, l.y from r join l on r.y = l.x),
c as (select x, least(x, min(y)) as component_id from r group by x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(c.component_id, d.doc_id)::bigint as component_id
from d left join n on n.doc_id = d.doc_id left join c on c.x = d.doc_id
"""
OP4_FIVE_SQL = OP4_SQL.replace("len(w) >= 4", "len(w) >= 5").replace("len(w) - 2", "len(w) - 3").replace("i + 3", "i + 4").replace(">= 85 *", ">= 80 *")

"""Exact n-gram Jaccard join: size-banded tiles, bitmap bounds, sorted-array intersection.

1. Each text becomes a set of 64-bit shingle hashes; equal sets are one set from here on.
2. Prefix rule: sets that link share k of the first ``n - ceil(t * n) + k`` shingles in any
   fixed order. The order is by hash, with frequent shingles last. With k a tenth of a set, a
   set of whose prefix too few shingles occur in any other set of like size links with none and
   goes, so a passage that many texts share leads to candidates only if it is much of a text.
3. Entries of a shingle and a size band form a tile. First each set meets the first set of
   its tiles only (the one it shares most tiles with): that joins large groups of near copies
   with one comparison per set.
4. What is left are tiles that still hold several components. Their sets are compared block
   by block with sets of the same and the next band; counts of differing bits bound the overlap
   from above. A pair that passes joins its components for the rest of the tile, so a tile emits
   fewer pairs than it has components. Pairs are settled by intersecting the sorted arrays.
5. A tile all of whose pairs linked is done: what it left out lies within one component. One with a
   pair that did not link is opened again, and all pairs of components still apart that pass leave.
Tiles of the same sets are one tile, and a pair leaves from the first tile that both sets are in, so
it leaves once and not once a shingle. What that tile leaves out is joined by what it emits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lavra.llm.components import components
from lavra.llm.staging import chunks, discard, stage, texts_of

WORDS = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A shingle held by this many sets of one chunk of text is reported as frequent.
OFTEN = 4
#: Most frequent shingles that get an order of their own. They only order the prefixes: no candidate depends on them.
ORDERED = 1 << 16
#: k of the prefix rule, in percent of a set.
EXTRA = 10
#: Least bits per element of a bitmap.
BITS = 4
#: Sets that hold a shingle are counted up to here; shingles of more count as equally frequent.
MANY = 1 << 16
#: Sets per block of a tile, which bounds the sets that a task compares at once.
BLOCK = 512

_U = np.uint64
_STEP = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams; a shorter text is one n-gram, none if empty."""
    parts = text.encode().lower().split()
    if not parts:
        return np.zeros(0, _U)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), _U, len(parts))
    size = min(words, len(parts))
    total = np.full(len(parts) - size + 1, size, _U)
    for k in range(size):
        total += hashed[k : k + len(total)] * _STEP[k]
    return np.unique(_mix(total))


def identity(found: np.ndarray) -> tuple[int, int]:
    """Two numbers that name a set; the upper half of the second is its size."""
    a = int(_mix(found ^ _STEP[5]).sum())
    b = int(_mix(found ^ _STEP[6]).sum()) & 0xFFFFFFFF
    return a - (a >> 63 << 64), len(found) << 32 | b


def bitmap(found: np.ndarray) -> np.ndarray:
    """A hashed bitmap of at least ``BITS`` bits per element, as 64-bit words."""
    bits = max(64, 1 << (BITS * len(found) - 1).bit_length())
    at = found & _U(bits - 1)
    out = np.zeros(bits, bool)
    out[at] = True
    return np.packbits(out, bitorder="little").view(_U)


def fold(words: np.ndarray, count: int) -> np.ndarray:
    while len(words) > count:
        words = words[: len(words) // 2] | words[len(words) // 2 :]
    return words


def linked(a: int, b: int, overlap, percent: int = PERCENT):
    return 100 * overlap >= percent * (a + b - overlap)


def _sets(words: int):
    schema = "doc_id long, key_a long, key_b long, bits binary, often array<long>, times array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            keys, bits, distinct = [], [], {}
            for text in texts_of(chunk, "text"):
                found = shingles(text, words)
                keys.append(identity(found))
                bits.append(bitmap(found).tobytes() if len(found) else None)
                distinct[keys[-1]] = found
            every, times = np.unique(np.concatenate(list(distinct.values())), return_counts=True)
            top = times >= OFTEN
            n = chunk.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").cast(pa.int64()),
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array([every[top].view(np.int64)] + [None] * (n - 1), pa.list_(pa.int64())),
                    pa.array([times[top]] + [None] * (n - 1), pa.list_(pa.int64())),
                ],
                names=["doc_id", "key_a", "key_b", "bits", "often", "times"],
            )

    return run, schema


def _prefixes(words: int, percent: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = hot.value
        seen: set[tuple[int, int]] = set()
        for chunk in chunks(batches, "text"):
            firsts, sizes, keys = [], [], []
            for text in texts_of(chunk, "text"):
                found = shingles(text, words)
                key = identity(found)
                if not len(found) or key in seen:
                    continue
                seen.add(key)
                n = len(found)
                want = n - -(-percent * n // 100) + max(1, -(-EXTRA * n // 100))
                if len(values):
                    at = np.minimum(np.searchsorted(values, found), len(values) - 1)
                    weight = np.where(values[at] == found, counts[at], 0)
                    if weight.any():
                        found = found[np.argsort(weight, kind="stable")]
                firsts.append(found[:want])
                sizes.append(len(firsts[-1]))
                keys.append(key)
            if len(seen) > 50_000:
                seen.clear()
            if keys:
                pairs = np.array(keys, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(firsts).view(np.int64)), pa.array(np.repeat(pairs[:, 0], sizes)), pa.array(np.repeat(pairs[:, 1], sizes))],
                    names=["shingle", "key_a", "key_b"],
                )

    return run


def _band(key_b: np.ndarray, percent: int) -> np.ndarray:
    """Size bands a little wider than the ratio of sizes that can link: such sizes are at most one band apart."""
    return np.floor(np.log(key_b >> 32) / np.log(101 / percent)).astype(np.int32)


ENTRY = ["shingle", "key_a", "key_b"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to a stream sorted by shingle how many entries each shingle has (holders), up to ``MANY``.

    A shingle of more entries is held back until that is known, so no more than ``MANY`` rows wait.
    """
    held, many = [np.zeros(0, np.int64)] * 3, None

    def made(rows: list[np.ndarray], counts: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(counts, pa.int32())], names=[*ENTRY, "holders"])

    for batch in batches:
        rows = [np.concatenate([old, batch.column(c).to_numpy()]) for old, c in zip(held, ENTRY)]
        of = rows[0]
        if not len(of):
            continue
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        sizes = np.diff(np.append(starts, len(of)))
        counts = np.minimum(sizes, MANY)
        if of[0] == many:
            counts[0] = MANY
        cut = len(of) if counts[-1] == MANY else starts[-1]
        many = of[-1] if cut == len(of) else None
        if cut:
            yield made([x[:cut] for x in rows], np.repeat(counts, sizes)[:cut])
        held = [x[cut:] for x in rows]
    if len(held[0]):
        yield made(held, np.full(len(held[0]), len(held[0])))


def _tiles(percent: int):
    """Stream entries sorted by shingle and size; leave out those that no entry of like size joins.

    Entries of one shingle are sorted by size, so the neighbours are the nearest in size.
    """
    names = ["shingle", "key_a", "key_b", "band", "pos", "first_a", "first_b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, whose successor is unknown: values, starts a shingle, starts a tile, place, first of the tile, joined

        def step(s, a, b, last: bool):
            nonlocal held
            if held:
                s, a, b = (np.concatenate([[x], y]) for x, y in zip(held[0], (s, a, b)))
                joined = held[-1]
            same = np.concatenate([[False], (s[1:] == s[:-1]) & (a[1:] == a[:-1]) & (b[1:] == b[:-1])])
            s, a, b = s[~same], a[~same], b[~same]
            band, n = _band(b, percent), len(s)
            new = np.concatenate([[True], s[1:] != s[:-1]])
            tile = new | np.concatenate([[True], band[1:] != band[:-1]])
            place, first_a, first_b = 0, 0, 0
            if held:
                new[0], tile[0], place, first_a, first_b = held[1:-1]
            row = np.arange(n)
            start = np.maximum.accumulate(np.where(tile, row, -1))
            pos = np.where(start >= 0, row - start, row + place)
            fa = np.where(start >= 0, a[np.maximum(start, 0)], first_a)
            fb = np.where(start >= 0, b[np.maximum(start, 0)], first_b)
            size = b >> 32
            like = ~new
            like[1:] &= 100 * size[:-1] >= percent * size[1:]
            if held:
                like[0] = joined
            more = np.concatenate([like[1:], [False]])
            end = n if last else n - 1
            held = ((s[-1], a[-1], b[-1]), bool(new[-1]), bool(tile[-1]), int(pos[-1]), int(fa[-1]), int(fb[-1]), bool(like[-1]))
            keep = np.flatnonzero((like | more)[:end])
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (s, a, b, band, pos.astype(np.int64), fa, fb)], names=names)

        for batch in batches:
            if batch.num_rows:
                yield step(*(batch.column(c).to_numpy() for c in ("shingle", "key_a", "key_b")), last=False)
        if held:
            empty = np.zeros(0, np.int64)
            yield step(empty, empty, empty, last=True)

    return run, "shingle long, key_a long, key_b long, band int, pos long, first_a long, first_b long"


def _arrays(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            found = [shingles(text, words) for text in texts_of(chunk, "text")]
            keys = [identity(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.int64()),
                    pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                names=["key_a", "key_b", "items"],
            )

    return run


def _may_link(bits: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Bit bound: every bit set on one side only proves one element outside the intersection."""
    mine = np.bitwise_count(bits & ~others).sum(axis=1, dtype=np.int64)
    theirs = np.bitwise_count(others & ~bits).sum(axis=1, dtype=np.int64)
    return linked(size, sizes, np.minimum(size - mine, sizes - theirs), percent)


def _meet_first(earlier: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of ``others`` have no value in common with ``earlier``; all are sorted."""
    if not len(earlier):
        return np.ones(len(others), bool)
    every = np.concatenate(others)
    shared = earlier[np.minimum(np.searchsorted(earlier, every), len(earlier) - 1)] == every
    return np.bincount(np.repeat(np.arange(len(others)), list(map(len, others))), weights=shared, minlength=len(others)) == 0


TILE = ["shingle", "band", "block_a", "block_b", "crossing"]
MET = "shingle long, key_a long, key_b long, other_a long, other_b long"


def _compare(percent: int, forest: bool):
    """Stream the blocks of tiles; emit pairs of different components that the bounds let pass.

    Each set carries the shingles of all its tiles (``open``): a pair that shares an earlier tile
    is left to that one, so it leaves once and not once a shingle. With ``forest`` a pair joins its
    two components for the rest of the tile, so a tile emits fewer pairs than it has components.
    """

    def tile(rows: pa.Table) -> np.ndarray:
        size = rows.column("key_b").to_numpy() >> 32
        comp = rows.column("comp").to_numpy()
        if (comp == comp[0]).all():
            return np.zeros((0, 2), np.int64)
        right = rows.column("right").to_numpy()
        crossing = bool(rows.column("crossing")[0].as_py())
        raw = [np.frombuffer(x.as_py(), _U) for x in rows.column("bits")]
        width = min(map(len, raw))
        bits = np.stack([fold(x, width) for x in raw])
        comp = comp.copy()
        open_at = rows.column("open").combine_chunks()
        ends = np.cumsum(open_at.value_lengths().to_numpy())
        shingle = rows.column("shingle")[0].as_py()
        earlier = [x[: np.searchsorted(x, shingle)] for x in np.split(open_at.flatten().to_numpy(), ends[:-1])]
        found = [np.zeros((0, 2), np.int64)]
        for i in np.flatnonzero(right == 0) if crossing else range(len(size) - 1):
            rest = np.flatnonzero(right == 1) if crossing else np.arange(i + 1, len(size))
            rest = rest[(comp[rest] != comp[i]) & linked(size[i], size[rest], np.minimum(size[i], size[rest]), percent)]
            if len(rest):
                rest = rest[_may_link(bits[i], size[i], bits[rest], size[rest], percent)]
            if len(rest):
                rest = rest[_meet_first(earlier[i], [earlier[j] for j in rest])]
            if forest and len(rest):
                joined, first = np.unique(comp[rest], return_index=True)
                rest = rest[first]
                comp[np.isin(comp, joined)] = comp[i]
            if len(rest):
                found.append(np.stack([np.full(len(rest), i), rest], axis=1))
        return np.concatenate(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: pa.Table | None = None

        def emit(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key = np.stack([table.column(c).to_numpy() for c in TILE])
            cuts = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, [table.num_rows]])
            a, b = table.column("key_a").to_numpy(), table.column("key_b").to_numpy()
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if hi - lo > 1 and len(pairs := tile(table.slice(lo, hi - lo)) + lo):
                    x, y = pairs[:, 0], pairs[:, 1]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (key[0][x], a[x], b[x], a[y], b[y])], names=["shingle", "key_a", "key_b", "other_a", "other_b"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([left, table]) if left is not None and left.num_rows else table
            if not table.num_rows:
                continue
            key = np.stack([table.column(c).to_numpy() for c in TILE])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            cut = int(change[-1]) if len(change) else 0
            if cut:
                yield from emit(table.slice(0, cut))
            left = table.slice(cut)
        if left is not None and left.num_rows:
            yield from emit(left)

    return run, MET


PAIR = "key_a long, key_b long, other_a long, other_b long"


def _bounded(percent: int):
    """Leave out pairs whose sizes or bitmaps exclude a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            sizes = zip(batch.column("key_b").to_numpy() >> 32, batch.column("other_b").to_numpy() >> 32)
            for row, ((m, n), p, q) in enumerate(zip(sizes, batch.column("bits"), batch.column("other_bits"))):
                if linked(m, n, min(m, n), percent):
                    p, q = np.frombuffer(p.as_py(), _U), np.frombuffer(q.as_py(), _U)
                    width = min(len(p), len(q))
                    if _may_link(fold(p, width), m, fold(q, width)[None], np.array([n]), percent)[0]:
                        keep.append(row)
            yield batch.select(["key_a", "key_b", "other_a", "other_b"]).take(pa.array(keep, pa.int64()))

    return run, PAIR


def _settle(percent: int):
    """The exact test of pairs that carry both arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for row, (x, y) in enumerate(zip(batch.column("items"), batch.column("other_items"))):
                a, b = np.frombuffer(x.as_py(), _U), np.frombuffer(y.as_py(), _U)
                if linked(len(a), len(b), len(np.intersect1d(a, b, assume_unique=True)), percent):
                    keep.append(row)
            yield batch.select(["key_a", "key_b", "other_a", "other_b"]).take(pa.array(keep, pa.int64()))

    return run, PAIR


def _as_other(sets: DataFrame, value: str, name: str) -> DataFrame:
    return sets.select(F.col("key_a").alias("other_a"), F.col("key_b").alias("other_b"), F.col(value).alias(name))


def _exact(pairs: DataFrame, reps: DataFrame, thin: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs that link.

    Only sets of the given pairs are made again from their texts. Their ids are
    written first: Spark then knows their size and sends them out only if they are few.
    """
    ids = ["key_a", "key_b"]
    both = pairs.select(*ids).unionByName(pairs.select(F.col("other_a").alias("key_a"), F.col("other_b").alias("key_b")))
    wanted = stage(both.distinct().join(reps, ids).select(F.col("rep").alias("doc_id")), "wanted")
    arrays = stage(thin.join(wanted, "doc_id").mapInArrow(_arrays(words), "key_a long, key_b long, items binary"), "arrays")
    found = stage(pairs.join(arrays, ids).join(_as_other(arrays, "items", "other_items"), ["other_a", "other_b"]).mapInArrow(*_settle(percent)), "linked")
    discard(wanted, arrays)
    return found


def _edges(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs of sets as pairs of their representatives (a, b)."""
    named = pairs.join(reps, ["key_a", "key_b"]).join(_as_other(reps, "rep", "b"), ["other_a", "other_b"])
    return named.select(F.col("rep").alias("a"), "b")


def _shared_enough(entries: DataFrame, percent: int) -> DataFrame:
    """Entries of sets that share as much of their prefix with others as any link needs."""
    own = Window.partitionBy("key_a", "key_b")
    counted = entries.withColumn("shared", F.count("*").over(own))
    return counted.where(F.col("shared") >= _need(percent)).select(*ENTRY)


def _need(percent: int) -> Column:
    """Entries that a set shares with any set it links to; the smaller of the two may set k."""
    return F.greatest(F.lit(1), F.floor(F.shiftright("key_b", 32) * (percent * EXTRA) / F.lit(10000)))


def _rarest(entries: DataFrame, percent: int) -> DataFrame:
    """The prefix rule once more, over the entries left: of its m entries a set keeps the m - need + 1 rarest."""
    own = Window.partitionBy("key_a", "key_b").orderBy("holders", "shingle")
    every = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = entries.select(*ENTRY, F.row_number().over(own).alias("nth"), F.count("*").over(every).alias("shared"))
    return ranked.where((F.col("shared") >= _need(percent)) & (F.col("nth") <= F.col("shared") - _need(percent) + 1)).select(*ENTRY)


def _component_of(reps: DataFrame, edges: DataFrame) -> DataFrame:
    """key_a, key_b and the component (comp) of every set."""
    labels = components(edges)
    return reps.join(labels, reps["rep"] == labels["node"], "left").select("key_a", "key_b", F.coalesce("label", "rep").alias("comp"))


def _placed(entries: DataFrame, of: DataFrame) -> DataFrame:
    """Entries with the component (comp) of their set, written."""
    return stage(entries.select(*ENTRY, "band", "pos").join(of, ["key_a", "key_b"]), "placed")


def _mixed(placed: DataFrame) -> DataFrame:
    """Entries of the tiles that hold several components; of tiles that hold the same sets, one."""
    # Sums of two hashes name the sets of a tile: 128 bits, whatever the order.
    same = [F.sum(F.xxhash64(F.lit(seed), "key_a", "key_b").cast("decimal(38,0)")).alias(f"same{seed}") for seed in (1, 2)]
    tiles = placed.groupBy("shingle").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("n"), *same).where("lo != hi")
    return placed.join(tiles.groupBy("n", "same1", "same2").agg(F.min("shingle").alias("shingle")).select("shingle"), "shingle", "left_semi")


def _across(open_rows: DataFrame, bits: DataFrame, percent: int, forest: bool) -> DataFrame:
    """Pairs of sets of different components that pass the bounds of a tile, with its shingle.

    Tiles are cut into blocks, and a set meets each block of its own and the next size band once.
    So two sets meet in every tile that both have, and the first of these alone has to emit them.
    """
    ids = ["key_a", "key_b"]
    bits = bits.join(open_rows.groupBy(*ids).agg(F.array_sort(F.collect_list("shingle")).alias("open")), ids)
    blocks = open_rows.groupBy("shingle", "band").agg((F.floor(F.max("pos") / BLOCK) + 1).cast("int").alias("blocks"))
    near = [blocks.select("shingle", (F.col("band") + d).alias("band"), F.col("blocks").alias(name)) for d, name in ((0, "own"), (-1, "above"), (1, "below"))]
    rows = open_rows
    for table in near:
        rows = rows.join(table, ["shingle", "band"], "left")
    block = F.floor(F.col("pos") / BLOCK).cast("int")

    def others(count: str):
        n = F.coalesce(count, F.lit(0))
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def tile(band, a, b, crossing: Column, right: Column):
        return F.struct(band.alias("band"), a.alias("block_a"), b.alias("block_b"), crossing.alias("crossing"), right.alias("right"))

    # Crossing: 0 compares a block with itself, 1 with one of the next band, 2 with another of its own band.
    band, no, yes = F.col("band"), F.lit(0), F.lit(1)
    tiles = F.concat(
        F.transform(others("own"), lambda j: tile(band, F.least(block, j), F.greatest(block, j), F.when(block == j, no).otherwise(F.lit(2)), (block > j).cast("int"))),
        F.transform(others("above"), lambda j: tile(band, block, j, yes, no)),
        F.transform(others("below"), lambda j: tile(band - 1, j, block, yes, yes)),
    )
    dealt = rows.select("shingle", *ids, "comp", F.explode(tiles).alias("tile")).select("shingle", *ids, "comp", "tile.*").join(bits, ids)
    dealt = dealt.repartition(*TILE).sortWithinPartitions(*TILE, "key_b", "key_a")
    return dealt.mapInArrow(*_compare(percent, forest))


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Link ``docs`` (doc_id, text) whose word ``words``-gram sets have a Jaccard similarity of ``percent`` / 100 or more.

    Words are separated by ASCII white space, A-Z lower-cased. A text with fewer
    words is one n-gram; a NULL, empty or blank text has no set and links with
    nothing. Repeated rows (same id, same text) stay repeated. Other columns are
    ignored; an empty table gives no rows. The join is exact for any size of
    groups: no bucket, tile or partner list is capped.

    Returns doc_id, n_shingles, component_id (least linked doc_id, itself included).
    """
    spark = docs.sparkSession
    thin = docs.select(F.col("doc_id").cast("long"), "text")
    ids = ["key_a", "key_b"]
    sets = stage(thin.mapInArrow(*_sets(words)), "sets")
    often = sets.where("often is not null").select(F.explode(F.arrays_zip("often", "times")).alias("x"))
    often = often.groupBy(F.col("x.often").alias("shingle")).agg(F.sum("x.times").alias("times")).orderBy(F.desc("times"), "shingle").limit(ORDERED).collect()
    order = np.array([r["shingle"] for r in often], np.int64).view(_U)
    times = np.array([r["times"] for r in often], np.int64)
    hot = spark.sparkContext.broadcast((order[np.argsort(order)], times[np.argsort(order)]))

    prefix = thin.mapInArrow(_prefixes(words, percent, hot), "shingle long, key_a long, key_b long")

    find, schema = _tiles(percent)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(find(batches))

    def by_shingle(rows: DataFrame) -> DataFrame:
        return rows.repartition("shingle").sortWithinPartitions("shingle", "key_b", "key_a")

    # Sets that share too little go, and then those that shared it with them.
    counted = "shingle long, key_a long, key_b long, holders int"
    entries = _shared_enough(by_shingle(prefix).mapInArrow(narrow, counted), percent)
    entries = _rarest(by_shingle(entries).mapInArrow(narrow, counted), percent)
    entries = stage(by_shingle(entries).mapInArrow(find, schema), "entries")
    reps = stage(sets.where(F.col("key_b") >= 1 << 32).groupBy(*ids).agg(F.min("doc_id").alias("rep"), F.first("bits").alias("bits")), "representatives")
    rep_ids, bits = reps.drop("bits"), reps.drop("rep")

    # Step 3: one partner for each set, the first set of the tiles that it shares most.
    met = entries.where("key_a != first_a or key_b != first_b").groupBy(*ids, "first_a", "first_b").agg(F.count("*").alias("shared"))
    best = met.groupBy(*ids).agg(F.max(F.struct("shared", "first_a", "first_b")).alias("best"))
    best = best.select(*ids, F.col("best.first_a").alias("other_a"), F.col("best.first_b").alias("other_b"))
    best = best.join(bits, ids).join(_as_other(bits, "bits", "other_bits"), ["other_a", "other_b"])
    edges = stage(_edges(_exact(stage(best.mapInArrow(*_bounded(percent)), "pairs"), rep_ids, thin, words, percent), rep_ids), "links")

    # Step 4: what the bounds let pass, few pairs of each tile.
    pair = [*ids, "other_a", "other_b"]
    placed = _placed(entries, _component_of(rep_ids, edges))
    discard(entries)
    entries = stage(_mixed(placed), "entries")
    discard(placed)
    met = stage(_across(entries, bits, percent, forest=True), "met")
    linking = _exact(stage(met.select(*pair).distinct(), "pairs"), rep_ids, thin, words, percent)
    edges = stage(edges.unionByName(_edges(linking, rep_ids)), "links")

    # Step 5: the tiles where a pair passed that does not link.
    failed = stage(met.join(linking, pair, "left_anti"), "failed")
    again = entries.drop("comp").join(failed.select("shingle").distinct(), "shingle", "left_semi")
    placed = _placed(again, _component_of(rep_ids, edges))
    again = stage(_mixed(placed), "again")
    left = _across(again, bits, percent, forest=False).select(*pair).distinct()
    left = stage(left.join(failed, pair, "left_anti"), "pairs")
    discard(entries, placed, again, met, failed)
    edges = edges.unionByName(_edges(_exact(left, rep_ids, thin, words, percent), rep_ids))

    of = _component_of(rep_ids, edges)
    return sets.join(of, ids, "left").select("doc_id", F.shiftright("key_b", 32).alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id"))

"""Jaccard join on word shingles: blocked sparse products of documents by shingles.

The incidence matrix has a row for each different shingle set (a class) and a column for each
shingle. Overlaps are products of its rows, and only those that can reach the similarity are made:

1. Two sets that are similar agree in most of their smallest shingle hashes. How many of a set's
   smallest hashes a similar one must have too follows from its size. A class keeps as many
   columns, and only when that many of them occur elsewhere; of these the most frequent ones are
   dropped, as far as the bound allows.
2. Every column has a pivot, the class there that shares most of its own columns. Classes meet at
   the pivots of their columns. A class's overlap with each of its pivots is counted first; all
   that are similar to a pivot are one component, without looking at their pairs.
3. What is left at a pivot is cut into bands by the distance to it. Distances obey the triangle
   inequality, so only neighbouring bands can hold similar sets. Pairs of blocks of neighbouring
   bands are multiplied, some columns at a time; a pair is dropped once its count and what is left
   of its rows cannot reach the bound. Members of one component are not compared again.

A task holds two blocks of bounded size and hands on links enough to connect what is connected.
Shingles are compared by 64-bit hashes, sets also by a 128-bit digest.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from shelfwise.llm.common import slices, unlike, utf8
from shelfwise.llm.components import components
from shelfwise.session import BROADCAST_LIMIT_BYTES, staged

WORDS = 3
LEAST = 90
# A block of rows has at most so many sets, and about so many bytes of them.
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
# Columns multiplied at a time.
COLUMNS = 4096
# Words whose hashes a task remembers.
KNOWN_WORDS = 400_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, words: int, known: dict) -> np.ndarray:
    """The sorted distinct hashes of a UTF-8 text's shingles; ``known`` gives the hash of a word.

    A-Z are lower-cased, words are runs of anything but ASCII white space. A shorter text is one
    shingle, a text without words has none.
    """
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) < words:
        whole = xxhash.xxh64_intdigest(b" ".join(parts), len(parts))
        return np.array([whole], np.uint64)
    hashes = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    size = len(parts) - words + 1
    total = np.zeros(size, np.uint64)
    for i in range(words):
        total = _mixed(total + hashes[i:i + size])
    return np.unique(total)


def least_overlap(size: int, least: int) -> int:
    """Shingles that a set of this size shares with any similar one."""
    return -(-least * size // 100)


def extra(size: int) -> int:
    """Shared hashes that are asked for among a set's smallest ones; it grows with the size."""
    return 1 + size // 10


def kept_columns(size: int, least: int) -> int:
    """How many of a set's smallest hashes are looked at: of those that it shares with a similar
    set, ``extra`` of the smaller size are among them, whatever the other set is."""
    return size - least_overlap(size, least) + extra(size)


def wanted_columns(size: int, least: int) -> int:
    """How many of these every similar set has too: ``extra`` of the least size it can have."""
    return extra(least_overlap(size, least))


def _signed(docs: DataFrame, words: int, least: int) -> DataFrame:
    """(key, n, digest, columns): of every document the size of its set, the set's digest (null
    when empty) and its smallest hashes."""

    def run(batches):
        known = _Hashes()
        for batch in slices(batches, "text"):
            sizes, digests, columns = [], [], []
            for text in utf8(batch, "text"):
                found = shingles(text, words, known)
                size = len(found)
                sizes.append(size)
                digests.append(digest(found) if size else None)
                columns.append(found[:kept_columns(size, least) if size else 0].view(np.int64))
            ends = np.cumsum([0, *map(len, columns)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(ends, pa.array(np.concatenate(columns))),
                ],
                ["key", "n", "digest", "columns"],
            )

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n bigint, digest binary, columns array<bigint>")


def digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _first_of_each(df: DataFrame, group: str, *order) -> DataFrame:
    """One row of each group; all but one of a task's rows go before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("place", place).where("place = 1").drop("place")


def _met(classes: DataFrame, least: int) -> DataFrame:
    """(c, pivot): the pivots of each class's columns, for classes that may have a similar one."""
    entries = classes.select("c", F.explode("columns").alias("column"))
    shared = entries.groupBy("column").agg(F.count("*").alias("classes")).where("classes > 1")
    found = entries.join(shared, "column").groupBy("c").agg(
        F.sort_array(F.collect_list(F.struct("classes", "column"))).alias("found")
    )
    sized = found.join(classes.select("c", "n", F.size("columns").alias("all")), "c")
    n = F.col("n")
    size_bound = F.ceil(n * least / 100).cast("long")
    # The same as wanted_columns.
    wanted = (F.lit(1) + F.floor(size_bound / 10)).cast("int")
    share = F.round(F.size("found") / F.col("all"), 3)
    kept = staged(
        sized.withColumn("wanted", wanted).where(F.size("found") >= F.col("wanted")).select(
            "c", (-share).alias("lack"),
            F.explode(F.slice("found", F.lit(1), F.size("found") - F.col("wanted") + 1)).alias("f"),
        ).select("c", "lack", "f.column"),
        "jaccard-columns",
    )
    pivots = kept.groupBy("column").agg(
        F.min(F.struct("lack", "c")).alias("least"), F.count("*").alias("classes")
    ).where("classes > 1").select("column", F.col("least.c").alias("pivot"))
    return kept.join(pivots, "column").select("c", "pivot").distinct()


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(c, set): the whole sets of the ``wanted`` classes (c, first, digest), from one document
    each."""
    few = wanted.count() * 128 <= BROADCAST_LIMIT_BYTES
    named = wanted.select("c", "first", F.col("digest").alias("own"))
    found = docs.join(
        F.broadcast(named) if few else named, F.col("key").eqNullSafe(F.col("first"))
    ).select("c", "own", "text")

    def run(batches):
        known = _Hashes()
        for batch in slices(batches, "text"):
            sets = [shingles(t, words, known) for t in utf8(batch, "text")]
            own = batch.column("own").to_pylist()
            keep = pa.array([len(s) > 0 and digest(s) == d for s, d in zip(sets, own)], pa.bool_())
            out = pa.RecordBatch.from_arrays(
                [batch.column("c"), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["c", "set"],
            )
            yield out.filter(keep)

    return _first_of_each(found.mapInArrow(run, "c bigint, set binary"), "c", "c")


def _groups(batches, key: list[str], rest: list[str]):
    """Consecutive rows that agree in ``key``, as (key, rows of ``rest``)."""
    names = key + rest
    rows = (
        row for batch in batches for row in zip(*(batch.column(n).to_pylist() for n in names))
    )
    size = len(key)
    for group, own in groupby(rows, key=lambda r: r[:size]):
        yield group, (r[size:] for r in own)


def _numbers(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _with_pivots(batches):
    """The overlap of each class with its pivot; a pivot's row comes before its classes'."""
    names = ["pivot", "c", "n", "pivot_n", "overlap"]
    out = []
    for (pivot, _), rows in _groups(batches, ["pivot", "part"], ["c", "set"]):
        own = None
        for c, data in rows:
            found = np.frombuffer(data, np.uint64)
            if c == pivot:
                own = found
                continue
            at = np.minimum(np.searchsorted(own, found), len(own) - 1)
            out.append((pivot, c, len(found), len(own), int((own[at] == found).sum())))
        if len(out) >= 4096:
            yield _numbers(out, names)
            out = []
    yield _numbers(out, names)


def _parts(bytes_, rows) -> F.Column:
    return F.ceil(F.greatest(bytes_ / BLOCK_BYTES, rows / BLOCK_ROWS)).cast("int")


def _stars(met: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """(pivot, c, n, pivot_n, overlap) of every class and each of its pivots."""
    sized = met.join(classes.select("c", "n"), "c")
    parts = sized.groupBy("pivot").agg(_parts(F.sum("n") * 8, F.count("*")).alias("parts"))
    dealt = met.where("c <> pivot").join(parts, "pivot").select(
        "pivot", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int").alias("part"), "c"
    )
    own = parts.select(
        "pivot", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("pivot").alias("c"),
    )
    rows = dealt.unionByName(own).join(sets, "c").repartition("pivot", "part")
    ordered = rows.sortWithinPartitions("pivot", "part", F.col("c") != F.col("pivot"))
    return ordered.mapInArrow(
        _with_pivots, "pivot bigint, c bigint, n bigint, pivot_n bigint, overlap bigint"
    )


def linked_pairs(left: list, right: list, alive: np.ndarray, least: int) -> np.ndarray:
    """Index pairs of similar sets, of those that ``alive`` marks.

    Overlaps are accumulated over blocks of columns. A pair is dropped when its count and the
    entries that are left of its shorter row stay below the bound for its sizes.
    """
    sizes_l, sizes_r = (np.array([len(x) for x in side], np.int64) for side in (left, right))
    need = -(-least * (sizes_l[:, None] + sizes_r[None, :]) // (100 + least))
    alive = alive & (np.minimum(sizes_l[:, None], sizes_r[None, :]) >= need)
    rows_l, rows_r = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if not len(rows_l):
        return np.zeros((0, 2), np.int64)
    sides = []
    for side, rows in ((left, rows_l), (right, rows_r)):
        own = [side[i] for i in rows]
        sides.append((np.concatenate(own), np.repeat(np.arange(len(own)), [len(x) for x in own])))
    both = np.intersect1d(sides[0][0], sides[1][0])
    entries = []
    for tokens, owner in sides:
        at = np.minimum(np.searchsorted(both, tokens), max(0, len(both) - 1))
        hit = both[at] == tokens if len(both) else np.zeros(len(tokens), bool)
        column, owner = at[hit], owner[hit]
        order = np.argsort(column, kind="stable")
        entries.append((column[order], owner[order]))
    alive, need = alive[np.ix_(rows_l, rows_r)], need[np.ix_(rows_l, rows_r)]
    rest = [np.bincount(o, minlength=len(r)) for (_, o), r in zip(entries, (rows_l, rows_r))]
    count = np.zeros(alive.shape, np.float32)
    for start in range(0, len(both), COLUMNS):
        alive &= count + np.minimum(rest[0][:, None], rest[1][None, :]) >= need
        if not alive.any():
            break
        tiles = []
        for k, ((column, owner), rows) in enumerate(zip(entries, (rows_l, rows_r))):
            i, j = np.searchsorted(column, [start, start + COLUMNS])
            tile = np.zeros((len(rows), min(COLUMNS, len(both) - start)), np.float32)
            tile[owner[i:j], column[i:j] - start] = 1
            rest[k] = rest[k] - np.bincount(owner[i:j], minlength=len(rows))
            tiles.append(tile)
        count += tiles[0] @ tiles[1].T
    i, j = np.nonzero(alive & (count >= need))
    return np.stack([rows_l[i], rows_r[j]], axis=1)


def _local_roots(pairs: list[tuple]) -> dict:
    """The smallest node that each node of the pairs reaches."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(root)}


def _between_blocks(least: int, tile: list[str]):
    """Links between two blocks, as pairs of the components their classes are in."""

    def run(batches):
        for _, rows in _groups(batches, tile, ["side", "root", "set"]):
            sides, roots = ([], []), ([], [])
            for side, root, data in rows:
                for s in ((0, 1) if side == 2 else (side,)):
                    sides[s].append(np.frombuffer(data, np.uint64))
                    roots[s].append(root)
            if not sides[0] or not sides[1]:
                continue
            apart = np.array(roots[0])[:, None] != np.array(roots[1])[None, :]
            pairs = {(roots[0][i], roots[1][j])
                     for i, j in linked_pairs(*sides, apart, least).tolist()}
            found = [(a, b) for a, b in _local_roots(sorted(pairs)).items() if a != b]
            if found:
                yield _numbers(found, ["a", "b"])

    return run


def _rest(stars: DataFrame, roots: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b): further links between the components ``roots`` (node, root)."""
    of_class = roots.select(F.col("node").alias("c"), "root")
    of_pivot = roots.select(F.col("node").alias("pivot"), F.col("root").alias("pivot_root"))
    # A band is as wide as the largest distance of similar sets.
    band = F.expr(
        "cast((100 * (n + pivot_n - 2 * overlap))"
        f" div ({100 - least} * (n + pivot_n - overlap)) as int)"
    )
    members = stars.select("pivot", "c", "n", band.alias("band")).unionByName(
        stars.select("pivot", F.col("pivot").alias("c"), F.col("pivot_n").alias("n"),
                     F.lit(0).alias("band")).distinct()
    )
    members = members.join(of_class, "c", "left").join(of_pivot, "pivot", "left").select(
        "pivot", "c", "n", "band", F.coalesce("root", "c").alias("root"),
        (F.coalesce("root", "c") == F.coalesce("pivot_root", "pivot")).alias("main"),
    )
    members = staged(members, "jaccard-members")
    open_pivots = members.where("not main").select("pivot").distinct()
    blocks = members.join(open_pivots, "pivot").groupBy("pivot", "band", "main").agg(
        _parts(F.sum("n") * 8, F.count("*")).alias("parts")
    )
    dealt = members.join(blocks, ["pivot", "band", "main"]).select(
        "pivot", "band", "main", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int").alias("part"),
        "c", "root",
    )
    place = ["band", "main", "part"]
    cells = blocks.select(
        "pivot", "band", "main",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
    )
    left = cells.select(
        "pivot", *[F.col(x).alias(f"{x}1") for x in place],
        F.explode(F.array("band", F.col("band") + 1)).alias("band2"),
    )
    right = cells.select("pivot", *[F.col(x).alias(f"{x}2") for x in place])
    first, second = F.struct("main1", "part1"), F.struct("main2", "part2")
    tiles = left.join(right, ["pivot", "band2"]).where(
        ~(F.col("main1") & F.col("main2")) & ((F.col("band1") < F.col("band2")) | (first <= second))
    )
    tile = ["pivot", *[f"{x}{i}" for i in (1, 2) for x in place]]
    same = (F.col("band1") == F.col("band2")) & (first == second)
    sides = tiles.select(*tile, F.when(same, 2).otherwise(0).alias("side"),
                         *[F.col(f"{x}1").alias(x) for x in place])
    sides = sides.unionByName(
        tiles.where(~same).select(*tile, F.lit(1).alias("side"),
                                  *[F.col(f"{x}2").alias(x) for x in place])
    )
    rows = sides.join(dealt, ["pivot", *place]).select(*tile, "side", "c", "root").join(sets, "c")
    ordered = rows.repartition(*tile).sortWithinPartitions(*tile)
    return ordered.mapInArrow(_between_blocks(least, tile), "a bigint, b bigint")


def near(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = WORDS, least: int = LEAST
) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id``.

    Two documents are linked when ``least`` per cent of the shingles that either has are in both.
    component_id is the smallest key reachable over links, the row's own included; a null key is
    one only when the component has no other. Null texts and texts without words have no shingles
    and no links: their component_id is their key. Repeated rows stay, and are linked like equal
    texts. Texts are read whole. An empty table gives no rows. Other columns are not read.
    """
    if not 50 <= least < 100:
        raise ValueError("least must be from 50 to 99 per cent")
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    signed = staged(_signed(keyed, words, least), "jaccard-signed")
    classes = staged(
        _first_of_each(
            signed.where("digest is not null"), "digest", F.asc_nulls_last("key")
        ).withColumnRenamed("key", "first").withColumn("c", F.monotonically_increasing_id()),
        "jaccard-classes",
    )
    met = staged(_met(classes, least), "jaccard-met")
    wanted = met.select("c").distinct().join(classes.select("c", "first", "digest"), "c")
    sets = staged(_sets(keyed, wanted, words), "jaccard-sets")
    stars = staged(_stars(met, classes, sets), "jaccard-stars")
    union = F.col("n") + F.col("pivot_n") - F.col("overlap")
    links = stars.where(100 * F.col("overlap") >= least * union)
    roots = staged(
        components(links.select(F.col("c").alias("a"), F.col("pivot").alias("b"))), "jaccard-roots"
    )
    more = staged(_rest(stars, roots, sets, least), "jaccard-links")
    final = components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
    member = classes.select("c", "digest", "first").join(
        roots.withColumnRenamed("node", "c"), "c", "left"
    ).select("digest", "first", F.coalesce("root", "c").alias("root"))
    member = staged(
        member.join(final, "root", "left").select(
            "digest", "first", F.coalesce("top", "root").alias("top")
        ),
        "jaccard-members",
    )
    named = member.join(member.groupBy("top").agg(F.min("first").alias("component_id")), "top")
    found = signed.select("key", "n", "digest").join(
        named.select("digest", "component_id", F.lit(True).alias("known")), "digest", "left"
    )
    return found.select(
        "key", "n", F.when(F.col("known"), F.col("component_id")).otherwise(F.col("key"))
    ).toDF(*unlike([key, "n_shingles", "component_id"]))

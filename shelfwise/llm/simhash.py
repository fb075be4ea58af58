"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every distinct fingerprint stands for all fingerprints within half of the maximum distance (its
variants). Two fingerprints are linked exactly when their balls meet, so the pairs are found by
bringing equal variants together.

A ball of radius 2 holds 2,081 variants. They are dealt to buckets by a linear hash: the bucket of
``x ^ mask`` is ``h(x) ^ h(mask)``. So a fingerprint is sent to each bucket once, as 8 bytes, and
the bucket's task makes just the variants that belong there; a row per variant is never shuffled.
A task works through its bucket in passes of bounded size.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfwise.llm.common import freed, fresh_name, map_text, unlike, utf8
from shelfwise.llm.components import components
from shelfwise.session import BROADCAST_LIMIT_BYTES, compute_slots, staged

BITS = 64
SHINGLE_SEED = 42
# Variants in memory at a time.
PASS_VARIANTS = 2 << 20
# Fingerprints that one bucket may hold.
BUCKET_PRINTS = 16 << 20
LEAST_BUCKET_BITS = 6


def fingerprint(text: bytes, words: int) -> int:
    """The SimHash of a UTF-8 text over ``words``-word shingles, repeats counted.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A shorter text is one
    shingle; a text without words gets zero. A bit is set when over half of the hashes have it.
    """
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        digests = xxhash.xxh64_digest(line, SHINGLE_SEED)
    else:
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
        ends = np.cumsum(sizes) - 1
        starts = ends - sizes + 1
        digest = xxhash.xxh64_digest
        digests = b"".join([
            digest(line[i:j], SHINGLE_SEED)
            for i, j in zip(starts.tolist(), ends[words - 1:].tolist())
        ])
    hashes = np.frombuffer(digests, np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at:at + (1 << 16)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def with_fingerprints(df: DataFrame, text: str, words: int, name: str) -> DataFrame:
    """``df`` with the fingerprint of its text as a long column ``name``; null is empty text."""
    schema = StructType([*df.schema.fields, StructField(name, LongType())])

    def run(batch):
        prints = [fingerprint(x, words) for x in utf8(batch, text)]
        return batch.append_column(name, pa.array(prints, pa.int64()))

    def build():
        freed()
        return run

    return map_text(df, text, schema, build)


def _linear_hash(values: np.ndarray, bits: int) -> np.ndarray:
    """A fixed linear map from 64 to ``bits`` bits: h(a ^ b) = h(a) ^ h(b)."""
    columns = np.random.default_rng(2).integers(0, 1 << 32, BITS, dtype=np.uint64)
    columns &= np.uint64((1 << bits) - 1)
    out = np.zeros(len(values), np.uint64)
    for i in range(BITS):
        out ^= columns[i] * ((values >> np.uint64(i)) & np.uint64(1))
    return out.astype(np.int64)


def _masks(radius: int) -> np.ndarray:
    found = [
        sum(1 << b for b in bits)
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    ]
    return np.array(found, np.uint64)


def _deal(bits: int, radius: int):
    """Sends every fingerprint to each bucket that holds one of its variants, in blocks."""

    def run(batches):
        shifts = np.unique(_linear_hash(_masks(radius), bits))
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(prints), 1 << 12):
                part = prints[at:at + (1 << 12)]
                bucket = (_linear_hash(part, bits)[:, None] ^ shifts[None, :]).ravel()
                order = np.argsort(bucket, kind="stable")
                owner = part[order // len(shifts)]
                keys, first = np.unique(bucket[order], return_index=True)
                blocks = [x.tobytes() for x in np.split(owner, first[1:])]
                yield pa.record_batch([pa.array(keys), pa.array(blocks, pa.binary())],
                                      ["bucket", "prints"])

    return run


def _variants(prints, starts, masks, mask_hash, cell):
    """All variants in a cell of the hash space, with the index of their fingerprint and mask.

    ``prints`` are sorted by hash, ``starts`` has the first index for each hash value.
    """
    values, owners, used = [], [], []
    for k, (mask, h) in enumerate(zip(masks, mask_hash ^ cell)):
        i, j = starts[h], starts[h + 1]
        if i < j:
            values.append(prints[i:j] ^ mask)
            owners.append((i, j))
            used.append(k)
    return values, owners, used


def _meetings(prints: np.ndarray, bucket: int, bits: int, distance: int):
    """Links found in one bucket, as index pairs into ``prints`` (sorted, distinct).

    Two prints that differ in d bits have a variant at most d // 2 from one and d - d // 2 from the
    other. Of the prints that share a variant, all are within ``distance`` of any that is near it,
    so links to one of the near ones connect them all.
    """
    near, far = distance // 2, distance - distance // 2
    masks = _masks(far)
    is_near = np.bitwise_count(masks) <= near
    extra = 0
    while len(prints) * len(masks) >> (bits + extra) > PASS_VARIANTS:
        extra += 1
    full = bits + extra
    hashes = _linear_hash(prints, full)
    order = np.argsort(hashes, kind="stable")
    ordered, place = prints[order], order
    starts = np.searchsorted(hashes[order], np.arange((1 << full) + 1))
    mask_hash = _linear_hash(masks, full)
    for high in range(1 << extra):
        values, owners, used = _variants(ordered, starts, masks, mask_hash, bucket | high << bits)
        if not values:
            continue
        flat = np.concatenate(values)
        met = np.sort(flat)
        met = np.unique(met[1:][met[1:] == met[:-1]])
        if not len(met):
            continue
        # A small table of hashed values leaves few variants to look up exactly.
        spot = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
        seen = np.zeros(1 << 20, bool)
        seen[spot(met)] = True
        at = np.flatnonzero(seen[spot(flat)])
        group = np.minimum(np.searchsorted(met, flat[at]), len(met) - 1)
        hit = met[group] == flat[at]
        at, group = at[hit], group[hit]
        ends = np.cumsum([j - i for i, j in owners])
        run = np.searchsorted(ends, at, side="right")
        begin = np.array([i for i, _ in owners])
        owner = place[begin[run] + at - (ends - [j - i for i, j in owners])[run]]
        away = ~is_near[np.array(used)[run]]
        rank = np.lexsort((owner, away, group))
        group, owner, away = group[rank], owner[rank], away[rank]
        first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        centre = np.repeat(first, np.diff(np.r_[first, len(group)]))
        keep = ~away[centre]
        a, b = owner[centre][keep], owner[keep]
        keep = (a != b) & (np.bitwise_count(prints[a] ^ prints[b]) <= distance)
        yield np.unique(np.stack([a[keep], b[keep]], axis=1), axis=0)


def _local_roots(size: int, pairs: np.ndarray) -> np.ndarray:
    """The smallest index that each index reaches."""
    root = np.arange(size)
    a, b = pairs[:, 0], pairs[:, 1]
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = low != high
        if not differ.any():
            return root
        np.minimum.at(root, high[differ], low[differ])
        while (root != root[root]).any():
            root = root[root]


def _meet(bits: int, distance: int):
    """Grouped by bucket: a spanning forest of the links between the bucket's fingerprints."""

    def run(group: pa.Table) -> pa.Table:
        freed()
        bucket = group.column("bucket")[0].as_py()
        blocks = [np.frombuffer(x, np.int64) for x in group.column("prints").to_pylist()]
        prints = np.unique(np.concatenate(blocks)).view(np.uint64)
        pairs = [np.zeros((0, 2), np.int64), *_meetings(prints, bucket, bits, distance)]
        root = _local_roots(len(prints), np.concatenate(pairs))
        moved = np.flatnonzero(root != np.arange(len(prints)))
        signed = prints.view(np.int64)
        return pa.table({"a": signed[moved], "b": signed[root[moved]]})

    return run


def bucket_bits(prints: int, variants: int) -> int:
    """Hash bits that keep a bucket within ``BUCKET_PRINTS`` fingerprints."""
    bits = LEAST_BUCKET_BITS
    while prints * min(variants, 1 << bits) >> bits > BUCKET_PRINTS and bits < 30:
        bits += 1
    return bits


def links(prints: DataFrame, distance: int) -> DataFrame:
    """``(a, b)``: fingerprints at most ``distance`` bits apart, enough of them to connect all that
    are connected. ``prints`` has one long column of distinct fingerprints."""
    if not 0 <= distance < BITS:
        raise ValueError("distance must be between 0 and 63")
    far = distance - distance // 2
    bits = bucket_bits(prints.count(), len(_masks(far)))
    dealt = prints.mapInArrow(_deal(bits, far), "bucket bigint, prints binary")
    dealt = dealt.repartition(compute_slots(prints.sparkSession, 1 << bits), "bucket")
    return dealt.groupBy("bucket").applyInArrow(_meet(bits, distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4, distance: int = 4
) -> DataFrame:
    """One row per row of ``docs``: key, ``fingerprint``, ``component_id``, ``print``, ``root``.

    component_id is the smallest key reachable over links of at most ``distance`` differing bits,
    the row's own included. ``print`` is the fingerprint as a long, ``root`` the smallest print of
    the component. A null text is empty; texts without words share fingerprint zero. A null key
    never becomes a component_id unless the component has no other; repeated rows stay. Other
    columns of ``docs`` are not read. An empty table gives an empty result. Where the result's names
    clash, the later one gets an underscore.
    """
    found = _classified(docs, text, key, words, distance)
    return found.select(
        "key", F.lower(F.lpad(F.hex("print"), 16, "0")), "component_id", "print", "root"
    ).toDF(*unlike([key, "fingerprint", "component_id", "print", "root"]))


def _classified(docs: DataFrame, text: str, key: str, words: int, distance: int) -> DataFrame:
    """(key, print, root, component_id)"""
    keyed = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    prints = staged(
        with_fingerprints(keyed, "text", words, "print").select("key", "print"), "prints"
    )
    nodes = staged(prints.groupBy("print").agg(F.min("key").alias("first")), "nodes")
    member = components(links(nodes.select("print"), distance))
    linked = nodes.join(member, nodes["print"] == member["node"]).select("print", "first", "root")
    linked = staged(linked, "linked")
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    named = linked.join(least, "root").select("print", "root", "least")
    classes = staged(
        nodes.join(named, "print", "left").select(
            "print",
            F.coalesce("root", "print").alias("root"),
            F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least"))
            .alias("component_id"),
        ),
        "classes",
    )
    return prints.join(classes, "print").select("key", "print", "root", "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id", words: int = 4,
                distance: int = 4) -> DataFrame:
    """``docs`` with one row of each near-duplicate component: a row whose key is the smallest.

    Where rows repeat that key, the smallest fingerprint in the component counts, and of the rows
    that share it the one with the smallest hash of its text. The columns are those of ``docs``,
    whatever their names. Null and empty texts and those without words are one component; null keys
    come last. An empty table gives no rows.

    Texts are hashed once. Rows with a key of their own are dropped by key alone; only rows that
    share a key are hashed again. The dropped keys are broadcast when they are few enough.
    """
    found = staged(_classified(docs, text, key, words, distance), "found")
    kept = found.where(F.col("key").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min("key").alias("kept_key"), F.min("print").alias("kept_print")
    )
    is_kept = F.col("key").eqNullSafe(F.col("kept_key")) & (F.col("print") == F.col("kept_print"))
    keys = found.join(kept, "root").groupBy("key").agg(
        F.count("*").alias("rows"), F.count_if(is_kept).alias("kept")
    )
    keys = staged(keys.where("rows > 1 or kept = 0"), "dropped")
    few = keys.count() * 64 <= BROADCAST_LIMIT_BYTES
    shared = keys.where("kept > 0")
    sent, some = (F.broadcast(k) if few else k for k in (keys, shared))
    whole = docs.join(sent, docs[f"`{key}`"].eqNullSafe(sent["key"]), "left_anti")
    if shared.isEmpty():
        return whole
    name, order, first = (fresh_name(docs, n) for n in ("print", "place", "digest"))
    again = with_fingerprints(
        docs.join(some, docs[f"`{key}`"].eqNullSafe(some["key"]), "left_semi"), text, words, name
    )
    chosen = again.alias("m").join(
        kept.alias("k"),
        F.col(f"m.`{key}`").eqNullSafe(F.col("k.kept_key"))
        & (F.col(f"m.`{name}`") == F.col("k.kept_print")),
        "left_semi",
    ).withColumn(first, F.xxhash64(f"`{text}`"))
    place = F.row_number().over(Window.partitionBy(f"`{key}`", f"`{name}`").orderBy(first, f"`{text}`"))
    columns = [f"`{c}`" for c in docs.columns]
    return whole.unionAll(chosen.withColumn(order, place).where(F.col(order) == 1).select(*columns))

"""Near-duplicates: fast similarity sketches, banding, exact check of every link on full sets.

A document is the set of its 5-word shingles (64-bit hashes). Documents of the same set are one
class, named by a 128-bit digest, so copies cost one sketch however many there are. The sketch has
``ROWS * BANDS`` coordinates. Round i of the first half throws every shingle into a hashed bin with
a value that grows with i; round i of the second half throws all into bin i. A coordinate keeps the
smallest value thrown into its bin, so none stays empty, and all are filled after about as many
throws as a few passes over the set.

Classes that agree in a band meet in a bucket. First every class is checked against the smallest
class of each of its buckets. That joins nearly all that belong together. Classes outside the largest
component of a bucket are then checked, in tiles, against all members of their buckets: no pair that
could join two components goes unchecked, and no table holds pairs other than links. A pair at the
threshold shares no band with probability (1 - 0.75**4)**32 = 5e-6.

Edge cases: a null or empty text, or one without words, has an empty set, is linked with nothing and
is its own component. With fewer than five words the whole sequence is the one shingle. Rows without
an id take part; a component's id is the smallest id in it. Repeated rows are exact copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from notelake.llm.components import connected_components, stored
from notelake.llm.texts import Texts, Words, give_back, map_texts, mix, pieces, window_hashes

WIDTH = 5
ROWS, BANDS = 4, 32
COORDINATES = ROWS * BANDS
BIN_SHIFT = np.uint64(64 - COORDINATES.bit_length() + 1)
PERCENT = 75

# Shingles of the classes that one tile asks for (2.4 MB).
TILE = 300_000

# Bits of the filter that tells which sets are needed (4 MB, whatever the number of documents; more
# documents make it let more sets through than needed, never fewer).
FILTER_BITS = 25


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(Texts(column), lower=True)
    hashes = words.hashes()
    windows = window_hashes(hashes, WIDTH)
    out = []
    for a, b in zip(words.at[:-1].tolist(), words.at[1:].tolist()):
        if b - a >= WIDTH:
            out.append(np.unique(windows[a:b - WIDTH + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for h in hashes[a:b]:
                whole = mix(np.array([whole ^ h]))[0] + np.uint64(1)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def digest(hashes: np.ndarray) -> bytes | None:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """Fast similarity sketch of each set, row by row; empty sets keep the largest value."""
    t = COORDINATES
    out = np.full(len(sets) * t, np.iinfo(np.uint64).max, np.uint64)
    empty = np.uint64(np.iinfo(np.uint64).max)
    live = np.flatnonzero([len(s) for s in sets])
    for i in range(2 * t):
        if not len(live):
            break
        flat = np.concatenate([sets[k] for k in live])
        owner = np.repeat(live, [len(sets[k]) for k in live])
        thrown = mix(flat ^ mix(np.array([i + 1], np.uint64)))
        value = (np.uint64(i) << np.uint64(56)) | (thrown & np.uint64((1 << 56) - 1))
        into = (thrown >> BIN_SHIFT).astype(np.int64) if i < t else i - t
        np.minimum.at(out, owner * t + into, value)
        live = live[(out.reshape(-1, t)[live] == empty).any(1)]
    return out.reshape(-1, t)


def band_keys(sketches: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; bands differ in their keys."""
    rows = sketches.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2])
    for k in range(ROWS):
        key = mix(key ^ rows[:, :, k]) + np.uint64(1)
    return key.astype(np.int64)


def lists(arrays) -> pa.Array:
    """A list column from one array per row."""
    at = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if len(arrays) else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.astype(np.int64)))


def sketched(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_shingles, digest, bands) of every document."""

    def work(batch: pa.RecordBatch):
        sets = shingle_sets(batch.column(1))
        digests = [digest(s) for s in sets]
        first = {d: i for i, d in reversed(list(enumerate(digests))) if d is not None}
        of = list(first.values())
        keys = dict(zip(first, band_keys(sketch([sets[i] for i in of])))) if of else {}
        none = np.zeros(0, np.int64)
        return (batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()), lists([keys.get(d, none) for d in digests]))

    kind = docs.schema[key].dataType.simpleString()
    return map_texts(docs, key, text,
                     f"{key} {kind}, n_shingles bigint, digest binary, bands array<bigint>", work)


def filter_bit(column: str):
    """Place of a digest in the filter, from 1 as Spark's bitmaps count."""
    first = F.conv(F.hex(F.substring(column, 1, 4)), 16, 10).cast("bigint")
    return first.bitwiseAND(F.lit((1 << FILTER_BITS) - 1)) + 1


def filter_of(keys: DataFrame) -> np.ndarray:
    """Bitmap of the digests in ``keys``: of a fixed size, joined from parts of 4 kB."""
    places = keys.select(filter_bit("key").alias("p"))
    parts = places.groupBy(F.bitmap_bucket_number("p").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")).collect()
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in parts:
        bits = np.frombuffer(row["bits"], np.uint8)
        begin = (row["part"] - 1) * len(bits)
        out[begin:begin + len(bits)] = bits
    return out


def needed_sets(docs: DataFrame, keys: DataFrame, text: str) -> DataFrame:
    """(key, set) of the classes in ``keys``, one row each, from the texts."""
    sent = docs.sparkSession.sparkContext.broadcast(filter_of(keys))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0):
                sets = shingle_sets(part.column(0))
                found = {}
                for hashes in sets:
                    name = digest(hashes)
                    if name is None or name in found:
                        continue
                    p = int.from_bytes(name[:4], "big") & ((1 << FILTER_BITS) - 1)
                    if sent.value[p >> 3] >> (p & 7) & 1:
                        found[name] = hashes
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.binary()), lists(list(found.values()))], ["key", "set"])
        give_back()

    sets = docs.select(F.col(text).cast("string").alias("_0")).mapInArrow(
        run, "key binary, set array<bigint>")
    return sets.join(keys, "key", "left_semi").groupBy("key").agg(F.first("set").alias("set"))


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, checked in full."""
    both = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("set").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("set").alias("y")), "b")
    )
    common = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - F.col("common")
    return both.select("a", "b", "x", "y", common.alias("common")).where(
        F.col("common") * 100 >= union * PERCENT).select("a", "b")


def similar_sizes(m: str, n: str):
    """Sets of such sizes can reach the threshold."""
    return F.least(m, n) * 100 >= F.greatest(m, n) * PERCENT


def class_links(docs: DataFrame, classes: DataFrame, text: str) -> DataFrame:
    """(key, component) of the classes that are linked with another one."""
    rows = classes.select("digest", "n_shingles", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("digest", "n_shingles")).alias("lead"))
    members = stored(
        rows.join(shared.where("n > 1").drop("n"), "band").select(
            "band", F.col("digest").alias("key"), F.col("n_shingles").alias("size"),
            F.col("lead.digest").alias("lead"), F.col("lead.n_shingles").alias("lead_size")),
        "buckets")
    first = stored(
        members.where((F.col("key") != F.col("lead")) & similar_sizes("size", "lead_size"))
        .select(F.col("key").alias("a"), F.col("lead").alias("b")).distinct(), "pairs")
    keys = members.select("key").distinct()
    sets = stored(needed_sets(docs, keys, text), "sets")
    links = stored(linked(first, sets), "links")
    so_far = connected_components(links)
    more = stored(remaining_links(members.join(so_far, "key", "left").select(
        "band", "key", "size", "lead", F.coalesce("component", "key").alias("component")), sets),
        "links")
    return connected_components(links.unionByName(more))


def remaining_links(placed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between members of one bucket that are still in different components.

    Those outside the largest component of a bucket ask, in tiles of about ``TILE`` shingles (by
    the smallest lead they have, so that members of one group share tiles); every member of their
    buckets is sent once to each tile, not once to each that asks. Pairs are formed in the tiles
    only, and of the links found one for each component is returned.
    """
    placed = stored(placed, "placed")
    parts = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = parts.groupBy("band").agg(
        F.max(F.struct("n", "component")).alias("top"), F.count(F.lit(1)).alias("parts"))
    open_ = placed.join(
        largest.where("parts > 1").select("band", F.col("top.component").alias("top")), "band")
    outside = stored(open_.where("component <> top"), "outside")
    asking = outside.groupBy("key").agg(
        F.first("size").alias("size"), F.first("component").alias("component"),
        F.min("lead").alias("home"))
    asking = in_parts(asking, ["home"], TILE, "part")
    asking = stored(asking, "asking")
    tile = ["home", "part"]
    reached = (
        outside.join(asking.select("key", *tile), "key").select("band", *tile).distinct()
        .join(open_.select("band", "key", "size", "component"), "band")
        .select(*tile, "key", "size", "component").distinct()
    )
    reached = stored(in_parts(reached, tile, 4 * TILE, "split"), "reached")
    splits = reached.select(*tile, "split").distinct()
    keys = [*tile, "split"]
    columns = [*keys, "key", "component", "set"]
    left = asking.join(sets, "key").join(splits, tile).select(columns)
    # Renamed, as both sides come from the same tables.
    right = reached.join(sets, "key").select(columns).toDF(*columns)
    left = left.toDF(*columns)
    return left.groupBy(keys).cogroup(right.groupBy(keys)).applyInArrow(
        tile_links, "a binary, b binary").distinct()


def in_parts(rows: DataFrame, group: list[str], limit: int, name: str) -> DataFrame:
    """Number parts of each group, of about ``limit`` shingles, by the hash of the key."""
    sums = rows.groupBy(*group).agg(
        F.ceil(F.sum("size") / limit).cast("int").alias("_parts"))
    return rows.join(sums, group).withColumn(
        name, F.pmod(F.xxhash64("key"), F.col("_parts")).cast("int")).drop("_parts")


def tile_links(asking: pa.Table, reached: pa.Table) -> pa.Table:
    """Links between two small tables of (key, component, set), one per key and component."""
    mine, theirs = (t.select(["key", "component", "set"]).combine_chunks() for t in (asking, reached))
    keys, own = mine.column("key").to_pylist(), mine.column("component").to_pylist()
    lists = [np.asarray(x.values) for x in mine.column("set")]
    sizes = np.array([len(x) for x in lists])
    values = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    order = np.argsort(values)
    values, owner = values[order], np.repeat(np.arange(len(lists)), sizes)[order]
    found = {}
    for name, component, hashes in zip(theirs.column("key").to_pylist(),
                                       theirs.column("component").to_pylist(), theirs.column("set")):
        hashes = np.asarray(hashes.values)
        begin = np.searchsorted(values, hashes, "left")
        times = np.searchsorted(values, hashes, "right") - begin
        ends = np.cumsum(times)
        hits = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + times, times)
        common = np.bincount(owner[hits], minlength=len(lists))
        union = sizes + len(hashes) - common
        for i in np.flatnonzero(common * 100 >= union * PERCENT):
            if own[i] != component:
                found.setdefault((keys[i], component), name)
    pairs = [(a, b) for (a, _), b in found.items()]
    return pa.table([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], ["a", "b"])


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every document; kept: key = component_id.

    With a repeated key several rows can be kept of one group; ``keep_one`` picks one of them.
    """
    return _judged(docs, key, text).drop("digest").withColumn(
        "kept", F.col(key).eqNullSafe(F.col("component_id")))


def _judged(docs: DataFrame, key: str, text: str) -> DataFrame:
    found = stored(sketched(docs, key, text), "sketches")
    classes = found.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"))).alias("least"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    parts = class_links(docs, classes, text)
    placed = classes.select("digest", "least").join(
        parts.withColumnRenamed("key", "digest"), "digest", "left").select(
        "digest", "least", F.coalesce("component", "digest").alias("component"))
    # Ids may be missing or repeated: then the set tells which row stays.
    least = placed.groupBy("component").agg(F.min(F.struct("least", "digest")).alias("keeper"))
    names = placed.join(least, "component").select(
        "digest", F.col("keeper.least.id").alias("component_id"),
        (F.col("digest") == F.col("keeper.digest")).alias("keeps"))
    return found.select(key, "n_shingles", "digest").join(names, "digest", "left").select(
        key, "n_shingles", "digest",
        F.when(F.col("digest").isNull(), F.col(key)).otherwise(F.col("component_id"))
        .alias("component_id"), F.coalesce("keeps", F.lit(True)).alias("keeps"),
    ).withColumn("kept", F.col("keeps") & F.col(key).eqNullSafe(F.col("component_id"))).drop("keeps")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id,
    and of several texts with that id, or a group without ids, the one with the smallest digest.

    Rows that repeat both id and set are one document. Empty texts all stay.
    """
    schema = docs.schema

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 0):
                names = [digest(s) for s in shingle_sets(part.column(0))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(names, pa.binary())], ["row", "digest"])
        give_back()

    named = docs.select(F.col(text).cast("string").alias("_text"),
                        F.struct(*(F.col(c) for c in docs.columns)).alias("row")
                        ).mapInArrow(run, f"row {schema.simpleString()}, digest binary")
    named = named.withColumn("id", F.col(f"row.{key}"))
    kept = _judged(docs, key, text).where("kept and digest is not null").select(
        F.col("digest").alias("_digest"), F.col(key).alias("_id")).distinct()
    same = (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_id"))
    one = named.where(F.col("digest").isNotNull()).join(kept, same, "left_semi").dropDuplicates(
        ["digest", "id"])
    return one.unionByName(named.where(F.col("digest").isNull())).select("row.*")

"""Exact Jaccard join of shingle sets by universe partition, one-deletion neighbourhoods and allocation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.llm.components import components
from flowsift.llm.tokens import mix, shingle_sets
from flowsift.session import stage

#: Bytes of text per bucket of signatures, and per hand-over of a task to the buckets.
BUCKET_BYTES = 8 << 20
FLUSH_BYTES = 2 << 20
#: Of a band's segments, one in so many also offers its one-deletion neighbourhood.
DELETION_SHARE = 16
#: Bands of at most so many segments index empty segments too, so that none is ever missing.
SMALL_BAND = 128
#: Bits of the filter that keeps texts without candidates out of verification.
FILTER_BITS = 1 << 23


class Bands:
    """Segment counts and needs for a similarity of ``num / den`` or more.

    Band b holds sets of 2**b to 2**(b + 1) - 1 members. Linked sets x and y differ in at most
    (den - num) / (den + num) * (|x| + |y|) members. The larger set looks for the smaller one, in its
    own band and, where the smaller one may lie there, in the band below.
    """

    def __init__(self, num: int, den: int) -> None:
        if not num <= den <= 2 * num:
            raise ValueError("similarity must lie between a half and 1")
        self.num, self.den = num, den

    def fills(self, segments: np.ndarray) -> np.ndarray:
        """Where empty segments are indexed too: without them few or low thresholds may lack credits."""
        return (segments <= SMALL_BAND) | (10 * self.num < 7 * self.den)

    def largest(self, band: np.ndarray) -> np.ndarray:
        return (np.int64(2) << band) - 1

    def segments(self, band: np.ndarray) -> np.ndarray:
        """An eighth more than a partner at the far end of the size range can ask for."""
        top = self.largest(band)
        return (9 * (top * self.den // self.num + top) * (self.den - self.num) // (8 * (self.den + self.num))) + 1

    def need(self, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Segments among which one must be equal when a set of ``own`` members meets one of at most ``other``."""
        return (own + other) * (self.den - self.num) // (self.den + self.num) + 1

    def reaches_below(self, size: np.ndarray, band: np.ndarray) -> np.ndarray:
        return (band > 0) & (size * self.num <= (self.largest(band) >> 1) * self.den)


def _band(size: np.ndarray) -> np.ndarray:
    return np.frexp(size.astype(float))[1] - 1


def _roles(bands: Bands, sizes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(role, which sets, their bands)``: role 0 is the own band, role 1 the band below."""
    band = _band(np.maximum(sizes, 1))
    yield 0, np.flatnonzero(sizes > 0), band
    yield 1, np.flatnonzero((sizes > 0) & bands.reaches_below(sizes, band)), band - 1


class Signatures:
    """Signatures of some sets in one role: parallel arrays ``owner, key, slot, deleted``."""

    def __init__(self, bands: Bands, sets: list[np.ndarray], chosen: np.ndarray, band_of: np.ndarray) -> None:
        counts = np.array([len(sets[i]) for i in chosen], np.int64)
        tokens = np.concatenate([sets[i] for i in chosen]) if len(chosen) else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(chosen)), counts)
        band = band_of[chosen]
        m = bands.segments(band)
        slots = np.maximum(m // DELETION_SHARE, 1)
        base = np.concatenate([[0], np.cumsum(m)])
        segment = ((tokens >> np.uint64(32)) * m[owner].astype(np.uint64)) >> np.uint64(32)
        place = base[owner] + segment.astype(np.int64)
        content = np.zeros(base[-1], np.uint64)
        order = np.argsort(place, kind="stable")
        filled, begins = np.unique(place[order], return_index=True)
        content[filled] = np.add.reduceat(tokens[order], begins) if len(begins) else 0
        members = np.zeros(base[-1], np.int64)
        members[filled] = np.diff(np.append(begins, len(order)))
        of_place = np.repeat(np.arange(len(chosen)), m)
        number = np.arange(base[-1]) - base[of_place]
        salt = mix(number.astype(np.uint64) + (band[of_place].astype(np.uint64) << np.uint64(48)) + np.uint64(1))
        used = np.flatnonzero((members > 0) | bands.fills(m)[of_place])
        designated = number < slots[of_place]
        self.used = np.bincount(of_place[used], minlength=len(chosen))
        self.upgrades = np.bincount(of_place[designated & (members > 1)], minlength=len(chosen))
        dropped = np.flatnonzero(designated[place] & (members[place] > 1))
        at = place[dropped]
        self.owner = chosen[np.concatenate([of_place[used], owner[dropped]])] if len(chosen) else np.zeros(0, np.int64)
        self.key = mix(np.concatenate([content[used] ^ salt[used], (content[at] - tokens[dropped]) ^ salt[at]]))
        self.slot = np.concatenate([np.where(designated[used], number[used], -1), number[at]]).astype(np.int32)
        self.deleted = np.concatenate([np.zeros(len(used), bool), np.ones(len(at), bool)])


def _set_key(members: np.ndarray) -> int:
    """Name of a set: equal sets, and in practice only those, share it."""
    total = mix(members + np.uint64(len(members))).sum(dtype=np.uint64)
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


_SETS = "doc_id bigint, text_hash bigint, set_key bigint, n_shingles bigint, used_0 int, up_0 int, used_1 int, up_1 int"


def describe_sets(docs: DataFrame, bands: Bands, shingle: int) -> DataFrame:
    """Per row the hash of its text, the name and size of its set, and what its segments can offer in either role."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = list(shingle_sets(part.column(1), shingle))
                sizes = np.array([len(s) for s in sets], np.int64)
                offers = np.zeros((4, len(sets)), np.int32)
                for role, chosen, band in _roles(bands, sizes):
                    found = Signatures(bands, sets, chosen, band)
                    offers[2 * role, chosen], offers[2 * role + 1, chosen] = found.used, found.upgrades
                keys = pa.array([_set_key(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), keys, pa.array(sizes), *map(pa.array, offers)], [c.split()[0] for c in _SETS.split(", ")])

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(run, _SETS)


_PACKED = "bucket int, final boolean, low binary, set_key binary, role binary, slot binary, deleted binary"
_SHARED = "sig bigint, set_key bigint, role int, slot int, deleted boolean"


def _shared(bucket: np.ndarray, low: np.ndarray, set_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries have a signature of two sets or more, and one entry of each signature."""
    key = (bucket.astype(np.uint64) << np.uint64(32)) | low
    order = np.lexsort((set_key, key))
    key, names = key[order], set_key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(key))
    several = names[begins] != names[ends - 1]
    out = np.zeros(len(key), bool)
    out[order] = np.repeat(several, ends - begins)
    first = np.zeros(len(key), bool)
    first[order[begins]] = True
    return out, first


def shared_signatures(docs: DataFrame, bands: Bands, shingle: int, buckets: int) -> DataFrame:
    """Every signature that two sets or more have, once for each of them.

    Copies of a set count once per task. A signature that several sets of a task have is passed on for
    those sets at once and meets the other tasks' signatures as a single entry.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        seen: set[int] = set()
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            key, name, role, slot, deleted = (np.concatenate(x) for x in zip(*held))
            held.clear()
            seen.clear()
            bucket = ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)
            low = key.astype(np.uint32)
            shared, first = _shared(bucket, low, name)
            rows = []
            order = np.lexsort((name, bucket, shared))
            for final in (False, True):
                own = order[(shared if final else first & ~shared)[order]] if final else order[first[order]]
                own = own[np.argsort(bucket[own], kind="stable")]
                edges = np.searchsorted(bucket[own], np.arange(buckets + 1))
                for b in range(buckets):
                    at = own[edges[b] : edges[b + 1]]
                    if len(at):
                        rows.append((b, final, low[at].tobytes(), name[at].tobytes(), role[at].tobytes(), slot[at].tobytes(), deleted[at].tobytes()))
            kinds = [pa.int32(), pa.bool_(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [c.split()[0] for c in _PACKED.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                names, fresh = [], []
                for s in shingle_sets(part.column(1), shingle):
                    name = _set_key(s)
                    if len(s) and name not in seen:
                        seen.add(name)
                        names.append(name)
                        fresh.append(s)
                        size += 6 * len(s)
                names = np.array(names, np.int64)
                for role, chosen, band in _roles(bands, np.array([len(s) for s in fresh], np.int64)):
                    found = Signatures(bands, fresh, chosen, band)
                    held.append((found.key, names[found.owner], np.full(len(found.key), role, np.int8), found.slot, found.deleted))
                if size >= FLUSH_BYTES:
                    yield from flush()
                    size = 0
        yield from flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = -1, []

        def rows(parts: list[tuple[np.ndarray, ...]], only_shared: bool) -> Iterator[pa.RecordBatch]:
            if parts:
                low, name, role, slot, deleted = (np.concatenate(x) for x in zip(*parts))
                keep = _shared(np.full(len(low), bucket), low, name)[0] if only_shared else np.ones(len(low), bool)
                sig = (np.int64(bucket) << 32) | low[keep].astype(np.int64)
                columns = [pa.array(sig), pa.array(name[keep]), pa.array(role[keep].astype(np.int32)), pa.array(slot[keep]), pa.array(deleted[keep])]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _SHARED.split(", ")])

        for batch in batches:
            for i in range(batch.num_rows):
                number, final, *blobs = (c[i].as_py() for c in batch.columns)
                entry = tuple(np.frombuffer(b, t) for b, t in zip(blobs, (np.uint32, np.int64, np.int8, np.int32, np.bool_)))
                if number != bucket:
                    yield from rows(held, True)
                    held.clear()
                    bucket = number
                if final:
                    yield from rows([entry], False)
                else:
                    held.append(entry)
        yield from rows(held, True)

    packed = docs.mapInArrow(emit, _PACKED)
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(meet, _SHARED).distinct()


def allocate(shared: DataFrame, sets: DataFrame, bands: Bands) -> DataFrame:
    """The shared signatures that each set has to look up: ``sig, set_key, upgrade``.

    A set that differs from a partner in fewer members than it has credits meets it in one of the
    segments that give them. A segment gives one credit for its exact signature and one more for its
    one-deletion neighbourhood. What no other set has costs nothing and is credited first; then come
    the exact signatures that fewest sets share, and the shared neighbourhoods only where those do not
    suffice. A set whose free credits cover its need looks up nothing.
    """
    exact, deleted = F.count_if(~F.col("deleted")), F.count_if("deleted")
    per_sig = shared.groupBy("sig").agg(exact.alias("n_exact"), deleted.alias("n_deleted")).where("n_exact > 0")
    rows = shared.join(per_sig, "sig")
    costly = F.when(F.col("deleted"), F.lit(True)).otherwise((F.col("n_exact") > 1) | (F.col("n_deleted") > 0))
    rows = rows.withColumn("exact", ~F.col("deleted") & (F.col("n_exact") > 1)).withColumn("near", (F.col("slot") >= 0) & costly)
    used = rows.groupBy("set_key", "role").agg(
        F.count_if("exact").alias("n_shared"), F.count_distinct(F.when(F.col("near"), F.col("slot"))).alias("n_slots")
    )
    size = F.col("n_shingles")
    top = F.expr("shiftleft(1L, cast(floor(log2(n_shingles + 0.5D)) AS int)) - 1")
    other = F.when(F.col("role") == 0, size).otherwise(top)
    need = F.floor((size + other) * (bands.den - bands.num) / (bands.den + bands.num)) + 1
    offered = F.when(F.col("role") == 0, F.col("used_0")).otherwise(F.col("used_1"))
    upgrades = F.when(F.col("role") == 0, F.col("up_0")).otherwise(F.col("up_1"))
    free = offered - F.col("n_shared") + F.greatest(upgrades - F.col("n_slots"), F.lit(0))
    wanted = used.join(sets, "set_key").select("set_key", "role", (need - free).alias("wanted"), "n_shared").where("wanted > 0")
    rows = rows.join(wanted, ["set_key", "role"])
    cheapest = Window.partitionBy("set_key", "role").orderBy(F.desc("exact"), "n_exact", "sig", "slot")
    ranked = rows.withColumn("rank", F.row_number().over(cheapest))
    by_exact = F.col("exact") & (F.col("rank") <= F.col("wanted"))
    by_upgrade = F.col("near") & (F.col("n_shared") < F.col("wanted"))
    return ranked.where(by_exact | by_upgrade).select("sig", "set_key", "deleted", by_upgrade.alias("upgrade"), by_exact.alias("by_exact"))


def _verify(pairs: DataFrame, members: DataFrame, bands: Bands) -> DataFrame:
    """The pairs that are linked, by exact intersection; sets without a pair are not moved."""
    paired = members.join(pairs.select(F.col("a").alias("set_key")), "set_key", "left_semi")
    left = paired.select(F.col("set_key").alias("a"), F.col("members").alias("members_a"))
    right = members.select(F.col("set_key").alias("b"), F.col("members").alias("members_b"))
    both = pairs.join(right, "b").join(left, "a")
    common = F.size(F.array_intersect("members_a", "members_b"))
    union = F.size("members_a") + F.size("members_b") - common
    return both.where(common * bands.den >= union * bands.num).select("a", "b")


def _members(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """``set_key, members`` of the documents wanted, and of a few more that share a bit of the filter."""
    bit = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = wanted.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 32).alias("word"))
    flags = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 32 AS int))")).alias("flags")).toArrow()
    filled = np.zeros(FILTER_BITS // 32, np.uint32)
    filled[flags.column("word").to_numpy()] = flags.column("flags").to_numpy().astype(np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(2).to_numpy()
            hit = (filled[bits // 32] >> (bits % 32).astype(np.uint32)) & 1
            chosen = batch.filter(pa.array(hit.astype(bool)))
            for at in range(0, chosen.num_rows, 256):
                sets = list(shingle_sets(chosen.column(1).slice(at, 256), shingle))
                keys = pa.array([_set_key(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([chosen.column(0).slice(at, 256), keys, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "set_key", "members"])

    found = docs.select("doc_id", "text", bit).mapInArrow(run, "doc_id bigint, set_key bigint, members array<bigint>")
    # ids may repeat: one text of a set is enough
    return stage(found.where("set_key IS NOT NULL").dropDuplicates(["doc_id", "set_key"]).drop("doc_id"), "jaccard-sets")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))


def _prefixes(touched: DataFrame, members: DataFrame, labels: DataFrame, bands: Bands) -> DataFrame:
    """``member, set_key, component, size, remaining``: the members by which a set can meet sets of other components.

    Members are ordered from those that fewest sets have, and ``remaining`` counts a set's members from this
    one on. All that two sets have in common remains at their first common member, which therefore stands
    near the beginning of either if they are linked. Members that no set of another component has come
    before all others and are not listed.
    """
    held = _labelled(members.join(touched, "set_key", "left_semi"), labels)
    rows = held.select("set_key", "component", F.size("members").alias("size"), F.explode("members").alias("member"))
    facts = [F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n_sets")]
    several = rows.groupBy("member").agg(*facts).where("low < high").select("member", "n_sets")
    # a set may be held more than once; its ranks must not count that
    commonest = Window.partitionBy("set_key").orderBy(F.desc("n_sets"), "member")
    ranked = rows.join(several, "member").withColumn("remaining", F.dense_rank().over(commonest))
    first = ranked.where(F.col("remaining") * bands.den >= F.col("size") * bands.num)
    return stage(first.select("member", "set_key", "component", "size", "remaining"), "jaccard-prefixes")


def _pairs(met: DataFrame, bands: Bands) -> DataFrame:
    """Of sets that meet at a member, the pairs ``a, b`` of different components that can be linked by what remains."""
    enough = F.least("remaining", "other_remaining") * (bands.num + bands.den) >= (F.col("size") + F.col("other_size")) * bands.num
    fit = met.where((F.col("component") != F.col("foreign")) & enough)
    return fit.select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b")).distinct()


def _stars(prefixes: DataFrame, bands: Bands) -> DataFrame:
    """Pairs of every set with the one that has most left at a member: no more than there are rows."""
    hub = F.struct("set_key", "component", "size", "remaining")
    order = F.struct(F.col("remaining") * (bands.num + bands.den) - F.col("size") * bands.num, "set_key")
    hubs = prefixes.groupBy("member").agg(F.max_by(hub, order).alias("hub"))
    hubs = hubs.select("member", "hub.*").toDF("member", "other", "foreign", "other_size", "other_remaining")
    return _pairs(prefixes.join(hubs, "member"), bands)


def _candidates(prefixes: DataFrame, labels: DataFrame, bands: Bands) -> DataFrame:
    """All pairs that can still be linked, once components are as in ``labels``."""
    rows = _labelled(prefixes.drop("component"), labels)
    others = rows.select("member", "set_key", "component", "size", "remaining").toDF("member", "other", "foreign", "other_size", "other_remaining")
    return _pairs(rows.join(others, "member").where("component < foreign"), bands)


def link_sets(docs: DataFrame, sets: DataFrame, bands: Bands, shingle: int, buckets: int) -> DataFrame:
    """Links ``a, b`` between set names, enough to give every component.

    All looked-up signatures first link their sets to the smallest set that has the signature. Sets that
    share a looked-up signature with another component then meet by their rarest members instead, first
    with one set a member, then, if still in different components, with each other. A link leaves few
    members different, so variants of one text too far apart to be linked hardly meet at all, however
    many signatures they share. Each pair is compared once.
    """
    shared = stage(shared_signatures(docs, bands, shingle, buckets), "jaccard-shared")
    looked = stage(allocate(shared, sets, bands), "jaccard-allocated")
    sizes = sets.select("set_key", "n_shingles")
    exact = shared.where("NOT deleted").select("sig", F.col("set_key").alias("other"))
    hubs = exact.groupBy("sig").agg(F.min("other").alias("other"))
    stars = looked.where("by_exact").join(hubs, "sig").where("set_key != other").select("set_key", "other")

    def fitting(pairs: DataFrame) -> DataFrame:
        pairs = pairs.select(F.least("set_key", "other").alias("a"), F.greatest("set_key", "other").alias("b")).distinct()
        pairs = pairs.join(sizes.toDF("a", "size_a"), "a").join(sizes.toDF("b", "size_b"), "b")
        return pairs.where(F.least("size_a", "size_b") * bands.den >= F.greatest("size_a", "size_b") * bands.num).select("a", "b")

    first = stage(fitting(stars), "jaccard-pairs")
    involved = looked.select("set_key").union(shared.join(looked.select("sig").distinct(), "sig", "left_semi").select("set_key")).distinct()
    members = _members(docs, sets.join(involved, "set_key", "left_semi").select("doc_id"), shingle)
    links = stage(_verify(first, members, bands), "jaccard-links")
    labels = components(links)
    # a signature whose sets are all in one component has nothing left to link
    met = _labelled(shared.join(looked.select("sig").distinct(), "sig", "left_semi").select("sig", "set_key"), labels)
    several = met.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("sig")
    touched = met.join(several, "sig", "left_semi").select("set_key").distinct()
    prefixes = _prefixes(touched, members, labels, bands)
    second = stage(_stars(prefixes, bands).join(first, ["a", "b"], "left_anti"), "jaccard-pairs")
    links = stage(links.union(_verify(second, members, bands)), "jaccard-links")
    last = stage(_candidates(prefixes, components(links), bands).join(first.union(second), ["a", "b"], "left_anti"), "jaccard-pairs")
    return stage(links.union(_verify(last, members, bands)), "jaccard-links")


def _grouped(docs: DataFrame, num: int, den: int, shingle: int, doc_id: str, text: str) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component``; the component is a set name, NULL without words."""
    bands = Bands(num, den)
    slim = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = slim.agg(F.sum(F.octet_length("text")).alias("n")).head().n or 0
    described = stage(describe_sets(slim, bands, shingle), "jaccard-described")
    facts = ("n_shingles", "used_0", "up_0", "used_1", "up_1")
    sets = described.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("doc_id"), *[F.max(c).alias(c) for c in facts])
    links = link_sets(slim, stage(sets, "jaccard-sets"), bands, shingle, max(1, -(-size // BUCKET_BYTES)))
    return _labelled(described.select("doc_id", "text_hash", "n_shingles", "set_key"), components(links)).drop("set_key")


def join_similar(docs: DataFrame, num: int = 3, den: int = 4, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id``: documents linked by a Jaccard similarity of ``num / den`` or more.

    The set of a document holds its distinct shingles of white-space words, A-Z in lower case; with
    fewer words the whole sequence, without words nothing. Equal sets are one set throughout, so
    copies are never paired. ``component_id`` is the smallest id reachable by links; a document
    without words or text has its own. A NULL id is linked like others but is never a component's id,
    unless it has no other. Rows that repeat an id are documents of their own. An empty table gives
    no rows; other columns are not read.
    """
    named = _grouped(docs, num, den, shingle, doc_id, text)
    smallest = named.where("component IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    return named.join(smallest, "component", "left").select("doc_id", "n_shingles", F.coalesce("smallest", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, num: int = 3, den: int = 4, shingle: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every linked group, all columns as they are: that of smallest id, NULL last.

    Documents without words are in no group and stay, but rows that repeat both id and text become one.
    """
    named = _grouped(docs, num, den, shingle, doc_id, text)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    chosen = named.where("component IS NOT NULL").groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    chosen = chosen.union(named.where("component IS NULL").select("doc_id", "text_hash")).distinct().toDF("kept_id", "kept_hash")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    row_id, row_hash = F.col("row").getField(doc_id).cast("bigint"), F.xxhash64(F.coalesce(F.col("row").getField(text), F.lit("")))
    kept = packed.select("row", row_id.alias("row_id"), row_hash.alias("row_hash")).join(
        chosen, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_hash") == F.col("kept_hash"))
    )
    return kept.groupBy("row_id", "row_hash").agg(F.first("row").alias("row")).select("row.*")

"""Near-duplicate documents by one-permutation hashing, bands and star edges.

1. A document is the set of its distinct word shingles. Sets are hashed once
   into ``BINS`` bins (the least hash of each bin); empty bins copy a bin picked
   by a hash of (bin, attempt), the densification of least variance.
2. Documents with equal sets are one class. Only its first document goes on, so
   a third of all rows being copies is one row.
3. Bands of consecutive bins name buckets. Each bucket gives one edge per
   member, to its first document (a star), not one per pair.
4. Pairs whose one-bit signatures differ in more than ``MAX_BITS`` bins are
   dropped (at the bound 25 are expected, with a deviation below 5); the others
   are confirmed on the full sets, and components are formed.
5. Where a bucket still holds several components, more stars follow: from the
   member that shares the most buckets of the largest size, as the original of a
   group of copies does, and from others picked by a hash for each bucket.
6. In the buckets that hold several components even then, all pairs between
   components are compared, whatever the size of the bucket. Buckets above
   ``SMALL`` members are cut into chunks for it. The sets travel to the chunks, half
   of each hash, so a task counts what two sets share and only pairs that reach
   the bound leave it: in a large group of texts that resemble each other below
   the bound, signatures alone would let most pairs through.

A pair at the similarity bound shares no bucket with probability below 3e-6.

Defined results: case of A-Z is ignored; a text of fewer words than a shingle
is one shingle of all its words; a null or blank text has no shingles and is
linked with nothing; rows with equal texts share a component; an empty table
gives no rows. Ids must be unique and not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.graph import components
from wellspring.llm.stages import bounded, saved
from wellspring.llm.words import (
    Slice,
    Stretches,
    mixed,
    packed_texts,
    signed,
    slices,
    unpacked,
    window_starts,
    words,
)

BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
MAX_BITS = 60
#: Stars of a bucket, the first included.
STARS = 3
#: Buckets of up to so many members are compared by a join, larger ones in chunks.
SMALL = 24
#: Members of a chunk of a larger bucket, and their shingles, about.
CHUNK, CHUNK_SHINGLES = 512, 1 << 19


def shingles(part: Slice, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct shingles of a slice, sorted."""
    w = words(part, lower=True)
    stretch = Stretches(w.hashes)
    starts, rows = window_starts(w.first, width)
    count = np.diff(w.first)
    short = np.flatnonzero((count > 0) & (count < width))
    hashes = np.concatenate((stretch(starts, width), stretch(w.first[short], count[short])))
    rows = np.concatenate((rows, short))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]


def bins_of(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Signatures (n, BINS) of rows that have at least one shingle each."""
    at = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    key = rows * BINS + at.astype(np.int64)  # sorted, as the shingles are
    first = np.ones(len(key), dtype=bool)
    first[1:] = key[1:] != key[:-1]
    signature = np.zeros(n * BINS, dtype=np.uint64)
    filled = np.zeros(n * BINS, dtype=bool)
    signature[key[first]] = hashes[first]
    filled[key[first]] = True
    todo, attempt = np.flatnonzero(~filled), 0
    while len(todo):
        attempt += 1
        own = (todo % BINS).astype(np.uint64)
        pick = mixed(own * np.uint64(0x10001) + np.uint64(attempt << 32)) % np.uint64(BINS)
        source = todo - todo % BINS + pick.astype(np.int64)
        good = filled[source]
        signature[todo[good]] = signature[source[good]]
        todo = todo[~good]
    return signature.reshape(n, BINS)


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key per band; equal keys of different bands do not occur together."""
    parts = signature.reshape(len(signature), BANDS, ROWS)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)
    for i in range(ROWS):
        keys = mixed(keys ^ parts[:, :, i])
    return keys


def one_bit(signature: np.ndarray) -> np.ndarray:
    """One bit per bin, in 64-bit words (n, words)."""
    own = np.arange(1, BINS + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    bits = (mixed(signature ^ own[None, :]) >> np.uint64(63)).astype(np.uint8)
    return np.packbits(np.pad(bits, ((0, 0), (0, -BINS % 64))), axis=1).view(np.uint64)


def profiles(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """id, n shingles, two sums that identify the set, keys of the bands, one-bit signature."""
    kind = docs.schema[key].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                rows, hashes = shingles(part, width)
                n = np.bincount(rows, minlength=part.rows)
                sums = []
                for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
                    upto = np.concatenate(
                        ([0], np.cumsum(mixed(hashes ^ np.uint64(salt)))),
                    ).astype(np.uint64)
                    ends = np.cumsum(n)
                    sums.append(upto[ends] - upto[ends - n])
                full = np.flatnonzero(n)
                rank = np.cumsum(n > 0) - 1
                signature = bins_of(rank[rows], hashes, len(full))
                upto = np.concatenate(([0], np.cumsum(n > 0)))
                keys, bits = (
                    pa.ListArray.from_arrays(
                        pa.array(upto * x.shape[1], pa.int32()), pa.array(signed(x.reshape(-1)))
                    )
                    for x in (band_keys(signature), one_bit(signature))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.rows),
                        pa.array(n.astype(np.int64)),
                        pa.array(signed(sums[0])),
                        pa.array(signed(sums[1])),
                        keys,
                        bits,
                    ],
                    names=["id", "n", "d1", "d2", "bands", "bits"],
                )

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        found, f"id {kind}, n long, d1 long, d2 long, bands array<long>, bits array<long>"
    )


def full_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """The shingle hashes, sorted, of the documents named by wanted.id."""
    kind = docs.schema[key].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in unpacked(batch.column(1)):
                for part in slices(texts):
                    rows, hashes = shingles(part, width)
                    ends = np.searchsorted(rows, np.arange(part.rows + 1))
                    sets = [hashes[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
                    own = batch.column(0).slice(begin + part.first, part.rows)
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(sets, pa.binary())], names=["id", "hashes"]
                    )

    rows = packed_texts(docs, key, text)
    return rows.join(wanted, "id", "left_semi").mapInArrow(found, f"id {kind}, hashes binary")


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * common >= percent * all."""
    joined = (
        pairs.select("a", "b")
        .join(sets.toDF("a", "left"), "a")
        .join(sets.toDF("b", "right"), "b")
        .select("a", "b", "left", "right")
    )
    kinds = {n: t for n, t in joined.dtypes}

    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            keep = []
            for i in range(batch.num_rows):
                x = np.frombuffer(left[i].as_buffer(), dtype=np.uint64)
                y = np.frombuffer(right[i].as_buffer(), dtype=np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    continue
                both = np.sort(np.concatenate((x, y)), kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    keep.append(i)
            picked = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(picked), batch.column(1).take(picked)], names=["a", "b"]
            )

    return joined.mapInArrow(confirmed, f"a {kinds['a']}, b {kinds['b']}")


def _close(percent: int):
    """Whether two members m and h may be similar, by sizes and one-bit signatures."""
    differing = sum(
        F.bit_count(F.col(f"m.b{k}").bitwiseXOR(F.col(f"h.b{k}"))) for k in range(-(-BINS // 64))
    )
    least, most = F.least("m.n", "h.n"), F.greatest("m.n", "h.n")
    return (100 * least >= percent * most) & (differing <= MAX_BITS)


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold several components, with their component c."""

    def named(some: DataFrame) -> DataFrame:
        return some.join(labels, some["id"] == labels["node"], "left").select(
            *some.columns, F.coalesce("component", "id").alias("c")
        )

    # signatures travel only for the buckets that are looked for
    several = (
        named(members.select("band", "id"))
        .groupBy("band")
        .agg(F.min("c").alias("low"), F.max("c").alias("high"))
        .where("low < high")
        .select("band")
    )
    several = bounded(saved(several, "near-several"))
    return saved(named(members.join(several, "band", "left_semi")), "near-mixed")


def _star_pairs(mixed_members: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each bucket's centre of this turn with its members of other components."""
    if turn == 1:
        sizes = mixed_members.groupBy("band").agg(F.count("*").alias("size"))
        reach = mixed_members.join(sizes, "band").groupBy("id").agg(F.sum("size").alias("reach"))
        ordered = mixed_members.join(reach, "id").withColumn("order", F.struct(-F.col("reach"), "id"))
    else:
        ordered = mixed_members.withColumn("order", F.struct(F.xxhash64("id", "band", F.lit(turn)), "id"))
    hubs = ordered.groupBy("band").agg(
        *[F.min_by(c, "order").alias(c) for c in mixed_members.columns if c != "band"]
    )
    return _paired(mixed_members, hubs, F.col("m.c") != F.col("h.c"), percent)


def _halves(sets: DataFrame) -> DataFrame:
    """(id, codes): 32 bits of each hash of a set, so what two sets share is never undercounted."""
    kind = dict(sets.dtypes)["id"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [
                np.frombuffer(value.as_buffer(), dtype=np.uint64).astype("<u4").tobytes()
                for value in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.binary())], names=["id", "codes"]
            )

    return sets.select("id", "hashes").mapInArrow(cut, f"id {kind}, codes binary")


def _remaining_pairs(
    mixed_members: DataFrame, percent: int, sets: DataFrame | None = None
) -> DataFrame:
    """All pairs of members of different components that share a bucket and may be similar.

    With ``sets`` (id, hashes), pairs of large buckets are counted on the sets.
    """
    sizes = mixed_members.groupBy("band", "c").agg(
        F.count("*").alias("size"), F.sum("n").alias("mass")
    )
    largest = F.struct("size", "c")
    main = sizes.groupBy("band").agg(
        F.max_by("c", largest).alias("main"),
        F.sum("size").alias("all"),
        (F.sum("size") - F.max("size")).alias("outside"),
        F.sum("mass").alias("all_mass"),
        (F.sum("mass") - F.max_by("mass", largest)).alias("outside_mass"),
    )
    named = saved(mixed_members.join(main, "band"), "near-rest")
    small = named.where(F.col("all") <= SMALL)
    few = _paired(
        small,
        small.where("c <> main"),
        (F.col("m.c") != F.col("h.c"))
        & ((F.col("m.c") == F.col("h.main")) | (F.col("m.id") < F.col("h.id"))),
        percent,
    )
    return few.unionByName(_chunked_pairs(named.where(F.col("all") > SMALL), percent, sets)).distinct()


def _chunked_pairs(named: DataFrame, percent: int, sets: DataFrame | None) -> DataFrame:
    """The same pairs of large buckets: chunks of all members by chunks of those outside main."""
    rows, columns = (
        F.greatest(F.ceil(F.col(c) / CHUNK), F.ceil(F.col(f"{c}_mass") / CHUNK_SHINGLES)).cast("int")
        for c in ("all", "outside")
    )
    at = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    signature = [f"b{k}" for k in range(-(-BINS // 64))]
    kept = ["band", "id", "c", "n", *signature]
    if sets is not None:
        named = named.join(_halves(sets), "id")
        kept.append("codes")
    member = named.select(*kept, F.lit(False).alias("hub"), at(rows, 0).alias("i"), F.explode(every(columns)).alias("j"))
    hub = named.where("c <> main").select(
        *kept, F.lit(True).alias("hub"), F.explode(every(rows)).alias("i"), at(columns, 1).alias("j")
    )
    kind = dict(named.dtypes)["id"]

    def compared(group: pa.Table) -> pa.Table:
        is_hub = group.column("hub").to_numpy()
        code = pa.concat_arrays(group.column("c").chunks).dictionary_encode().indices.to_numpy()
        n = group.column("n").to_numpy()
        bits = np.stack([group.column(w).to_numpy() for w in signature], axis=1).view(np.uint64)
        members, hubs = np.flatnonzero(~is_hub), np.flatnonzero(is_hub)
        first = np.cumsum(n) - n
        if "codes" in kept:
            raw = b"".join(value.as_buffer() for value in group.column("codes"))
            every, flat = np.unique(np.frombuffer(raw, dtype="<u4"), return_inverse=True)
            of_hub = np.zeros(len(every), dtype=bool)
        left, right = [], []
        for h in hubs:
            # a pair of two members outside main is found from both sides and made distinct later
            near = code[members] != code[h]
            near &= 100 * np.minimum(n[members], n[h]) >= percent * np.maximum(n[members], n[h])
            some = members[near]
            apart = np.bitwise_count(bits[some] ^ bits[h]).sum(axis=1, dtype=np.int64)
            some = some[apart <= MAX_BITS]
            if "codes" in kept and len(some):
                own = flat[first[h] : first[h] + n[h]]
                of_hub[own] = True
                upto = np.cumsum(n[some])
                at = np.arange(upto[-1]) + np.repeat(first[some] - (upto - n[some]), n[some])
                common = np.add.reduceat(of_hub[flat[at]], upto - n[some], dtype=np.int64)
                of_hub[own] = False
                some = some[100 * common >= percent * (n[some] + n[h] - common)]
            left.append(some)
            right.append(np.full(len(some), h))
        ids = group.column("id")
        nothing = np.zeros(0, dtype=np.int64)
        return pa.table(
            {
                "m": ids.take(pa.array(np.concatenate((nothing, *left)))),
                "h": ids.take(pa.array(np.concatenate((nothing, *right)))),
            }
        )

    return (
        member.unionByName(hub)
        .groupBy("band", "i", "j")
        .applyInArrow(compared, f"m {kind}, h {kind}")
        .select(F.greatest("m", "h").alias("a"), F.least("m", "h").alias("b"))
    )


def _paired(members: DataFrame, hubs: DataFrame, which, percent: int) -> DataFrame:
    on = (F.col("m.band") == F.col("h.band")) & which & _close(percent)
    return (
        members.alias("m")
        .join(hubs.alias("h"), on)
        .select(F.greatest("m.id", "h.id").alias("a"), F.least("m.id", "h.id").alias("b"))
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
) -> DataFrame:
    """key, n_shingles, component_id (least id reachable) and kept for every row."""
    rows = saved(profiles(docs, key, text, width), "near-profiles")
    classes = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("id").alias("first"))
    firsts = rows.join(classes.select(F.col("first").alias("id")), "id", "left_semi")
    bits = [F.element_at("bits", k + 1).alias(f"b{k}") for k in range(-(-BINS // 64))]
    buckets = firsts.select("id", "n", *bits, F.explode("bands").alias("band"))
    shared = (
        buckets.groupBy("band")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("size"))
        .where("size > 1")
        .select("band", "first_id")
    )
    members = saved(buckets.join(shared, "band"), "near-members")
    stars = _paired(
        members, members.where("id = first_id"), F.col("m.id") != F.col("h.id"), percent
    )
    wanted = members.select("id").distinct()
    sets = saved(full_sets(docs, wanted, key, text, width), "near-sets")
    tested = saved(stars, "near-pairs")
    links = saved(similar(tested, sets, percent), "near-links")
    labels = saved(components(links), "near-labels")
    for last in (False, True):
        rest = _mixed(members, labels)
        if rest.isEmpty():
            break
        if last:
            pairs = _remaining_pairs(rest, percent, sets)
        else:
            pairs = reduce(
                DataFrame.unionByName, [_star_pairs(rest, t, percent) for t in range(1, STARS)]
            )
        pairs = saved(pairs.distinct().join(tested, ["a", "b"], "left_anti"), "near-pairs")
        more = saved(similar(pairs, sets, percent), "near-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            labels = saved(components(links), "near-labels")
        tested = tested.unionByName(pairs)
    named = classes.join(labels, classes["first"] == labels["node"], "left").select(
        "n", "d1", "d2", F.coalesce("component", "first").alias("component_id")
    )
    full = rows.where("n > 0").select("id", "n", "d1", "d2").join(named, ["n", "d1", "d2"])
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return (
        full.select("id", "n", "component_id")
        .unionByName(empty)
        .select(
            F.col("id").alias(key),
            F.col("n").alias("n_shingles"),
            "component_id",
            (F.col("id") == F.col("component_id")).alias("kept"),
        )
    )

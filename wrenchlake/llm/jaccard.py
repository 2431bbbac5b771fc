"""Exact Jaccard join of word-shingle sets by parity sketches.

Copies of one set are one class from the start. For each band of set sizes the
largest possible symmetric difference d of two similar sets is known. A set is
sketched into more than d segments: every shingle flips a pseudo-random bit
pattern in one segment (XOR), so two sets differ in at most as many segments
as shingles, and two similar sets agree on some segments. A few segments more
than needed allow each set to leave out its emptiest ones. Sets of a band (and
of the band below) that agree on a segment are candidates.

Candidates are first linked as stars, to the least set of their bucket. A short
parity sketch, one bit per shingle, whose Hamming distance is at most the
symmetric difference, discards most false ones; the rest are verified on the
whole sets. The leader of a bucket has then met all its members. Buckets whose
other members still lie in several components are dealt out in pairs of blocks
of bounded size, by (bucket, block, block): a task compares the sketches of two
blocks at once as matrices and passes on only pairs across components that the
sketches allow, and of the buckets two sets share only the least one does so.
These pairs are verified as well. No pair that could join two components is
lost, and no pair is a row before its sketches allow it.

Defined cases: a null or empty text, or one without words, is the empty set:
0 shingles, linked with nothing, a component of its own. A text with fewer
words than a shingle has one shingle, its whole word sequence. Equal sets are
always linked. Rows may repeat; rows with a null id belong to components but
never name one (a component without any id has the null id).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.llm import texts
from wrenchlake.llm.components import components
from wrenchlake.llm.membership import Membership
from wrenchlake.operators.skew import bounded
from wrenchlake.session import materialise

SHINGLE = 5
SIMILARITY = (80, 100)
# Least length of a parity sketch in 64-bit words; it doubles until it has a bit for each shingle.
SKETCH_WORDS = 16
# Members of a block; two blocks are compared at once.
BLOCK_SETS = 1_024
# Words of sketches that are compared at once.
STRIP_WORDS = 1 << 19
# Buckets of a member that are looked through for a smaller common one; with more, a pair may come from several buckets.
LISTED = 32
# Sets that a task remembers to have met, to spare repeats.
MET = 1 << 16
# Rows of one bucket that are held to compare its members with earlier buckets.
BUCKET_ROWS = 8_192


class Bands:
    """Size bands for a similarity of p / q: sets of similar size lie in one band or in neighbouring ones."""

    def __init__(self, p: int, q: int):
        self._share = Fraction(q - p, q + p)  # of both sizes together, what may differ
        self._ratio = Fraction(q, p)
        self._tops = [1]

    def of(self, n: int) -> int:
        while self._tops[-1] < n:
            self._tops.append(max(math.floor((self._tops[-1] + 1) * self._ratio), self._tops[-1] + 1))
        low, high = 0, len(self._tops) - 1
        while low < high:
            middle = (low + high) // 2
            if self._tops[middle] < n:
                low = middle + 1
            else:
                high = middle
        return low

    def difference(self, band: int) -> int:
        """Most shingles in which two similar sets of the band, or of it and the one below, differ."""
        self.of(self._tops[-1])
        while len(self._tops) <= band:
            self.of(self._tops[-1] + 1)
        return math.floor(2 * self._tops[band] * self._share)

    def spare(self, band: int) -> int:
        """Segments beyond those that may differ and one; as many weak ones may be left out."""
        d = self.difference(band)
        return 2 + d // 5 if d else 0

    def segments(self, band: int) -> int:
        return self.difference(band) + 1 + self.spare(band)


def set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def segment_keys(shingles: np.ndarray, band: int, bands: Bands) -> np.ndarray:
    """Hashes of the sketch segments of a set for one band, with their place.

    Two similar sets agree on more segments than ``spare``. Segments that hold
    few shingles, or none, agree by chance as well, so a set leaves out all that
    hold at most t, for the largest t at which no more than ``spare`` go. Where
    two sets agree on a segment it holds as much in both, so of those they agree
    on, no more than ``spare`` go in either: one at least is left.
    """
    m = bands.segments(band)
    place = (((shingles >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)).astype(np.int64)  # ascending with the shingles
    held = np.bincount(place, minlength=m)
    at = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    parity = np.zeros(m, np.uint64)
    parity[place[at]] = np.bitwise_xor.reduceat(texts.mix(shingles + np.uint64(0xA0761D6478BD642F)), at)
    least = np.searchsorted(np.cumsum(np.bincount(held)), bands.spare(band), side="right")  # the fewest shingles of a kept one
    kept = np.flatnonzero(held >= least)
    return texts.mix(parity[kept] ^ texts.mix(kept.astype(np.uint64) + (np.uint64(band + 1) << np.uint64(32)))).view(np.int64)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """One bit per shingle, XORed: the Hamming distance of two sketches is at most the symmetric difference.

    The number of bits is a power of two and at least that of the shingles, so
    that the sketch of a large set is not worn out. XORing its two halves gives
    the sketch of half the length.
    """
    words = SKETCH_WORDS
    while 64 * words < len(shingles):
        words *= 2
    odd = np.bincount((texts.mix(shingles) % np.uint64(64 * words)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    for batch in batches:
        for part in texts.slices(batch):
            hashes, _, counts = texts.words(*texts.utf8(part.column("text")))
            yield part.column("doc_id"), texts.shingles(hashes, counts, size)


def shingle_sets(docs: DataFrame, size: int = SHINGLE, row=None) -> DataFrame:
    """doc_id, n_shingles, set_id (null for the empty set) and ``row`` (a long over ``docs``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "set_id", "row"]
        for batch in batches:
            for part in texts.slices(batch):
                hashes, _, counts = texts.words(*texts.utf8(part.column("text")))
                sets = texts.shingles(hashes, counts, size)
                own = pa.array([set_id(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), own, part.column("row")], names)

    marked = docs.select(*texts.columns_of_id_and_text(), (F.lit(0) if row is None else row).cast("long").alias("row"))
    return marked.mapInArrow(run, "doc_id long, n_shingles long, set_id long, row long")


def _segment_rows(docs: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """(key, set_id) for the segments of each set; a task gives a set it has met before no second time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met = Bands(p, q), set()
        for _, sets in _sets(batches, size):
            keys, ids = [], []
            for shingles in sets:
                if not len(shingles):
                    continue
                own = set_id(shingles)
                if own in met:
                    continue
                if len(met) >= MET:
                    met.clear()
                met.add(own)
                band = bands.of(len(shingles))
                for join_band in (band, band + 1):
                    found = segment_keys(shingles, join_band, bands)
                    keys.append(found)
                    ids.append(np.full(len(found), own))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], ["key", "set_id"])

    return texts.id_and_text(docs).mapInArrow(run, "key long, set_id long")


def _buckets(rows: DataFrame) -> DataFrame:
    """(bucket, leader, member) of every bucket with at least two sets; the leader is its own member too.

    Rows arrive sorted by key. A bucket is named by its members, so equal ones
    are one, in whatever task they arise. A bucket of more than BUCKET_ROWS rows
    keeps its key and is passed on as it comes, so the largest one needs no more
    memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        keys, ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        passing = None  # (key, leader, last member) of a large bucket under way

        def grouped(keys: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
            new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])) if len(keys) else np.zeros(0, bool)
            keys, ids = keys[new], ids[new]
            starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
            stops = np.append(starts[1:], len(keys))
            for a, b in zip(starts[stops - starts > 1].tolist(), stops[stops - starts > 1].tolist(), strict=True):
                members = ids[a:b]
                sign = hashlib.blake2b(members.tobytes(), digest_size=8).digest()
                if sign in met:
                    continue
                if len(met) >= MET:
                    met.clear()
                met.add(sign)
                yield int.from_bytes(sign, "little", signed=True), int(members[0]), members

        def out(found: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            sizes = [len(m) for _, _, m in found]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array([x[k] for x in found], np.int64), sizes)) for k in (0, 1)]
                + [pa.array(np.concatenate([m for _, _, m in found]))],
                ["bucket", "leader", "member"],
            )

        for batch in batches:
            keys = np.concatenate([keys, batch.column("key").to_numpy()])
            ids = np.concatenate([ids, batch.column("set_id").to_numpy()])
            if not len(keys):
                continue
            if passing and keys[0] == passing[0]:  # more of the large bucket
                stop = int(np.searchsorted(keys, passing[0], side="right"))
                members = ids[:stop][np.append(ids[0] != passing[2], ids[1:stop] != ids[: stop - 1])]
                if len(members):
                    yield out([(passing[0], passing[1], members)])
                    passing = (passing[0], passing[1], int(members[-1]))
                keys, ids = keys[stop:], ids[stop:]
                if not len(keys):
                    continue
            open_from = int(np.searchsorted(keys, keys[-1], side="left"))
            found = list(grouped(keys[:open_from], ids[:open_from]))
            keys, ids = keys[open_from:], ids[open_from:]
            if len(keys) > BUCKET_ROWS:
                distinct = np.unique(ids)
                found.append((int(keys[0]), int(distinct[0]), distinct))
                passing = (int(keys[0]), int(distinct[0]), int(distinct[-1]))
                keys, ids = keys[:0], ids[:0]
            if found:
                yield out(found)
        found = list(grouped(keys, ids))
        if found:
            yield out(found)

    return rows.repartition("key").sortWithinPartitions("key", "set_id").mapInArrow(run, "bucket long, leader long, member long")


def _looked_up(docs: DataFrame, size: int, wanted: DataFrame, whole: bool) -> DataFrame:
    """One row for each wanted set (one column, set_id): its tokens if ``whole``, else its size n and parity sketch."""
    wanted = materialise(wanted, "wanted")
    filtered = Membership(wanted, "set_id")
    names = ["set_id", "tokens"] if whole else ["set_id", "n", "sketch"]

    def lists(arrays: list[np.ndarray]) -> pa.Array:
        cuts = np.cumsum([0, *(len(x) for x in arrays)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate(arrays).view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for _, sets in _sets(batches, size):
            found = []
            for shingles in sets:
                if not len(shingles):
                    continue
                own = set_id(shingles)
                if own not in met and filtered.possible(np.array([own]))[0]:
                    if len(met) >= MET:
                        met.clear()
                    met.add(own)
                    found.append((own, shingles))
            if found:
                ids = pa.array([x for x, _ in found], pa.int64())
                if whole:
                    columns = [ids, lists([s for _, s in found])]
                else:
                    columns = [ids, pa.array([len(s) for _, s in found], pa.int32()), lists([parity_sketch(s) for _, s in found])]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "set_id long, tokens array<long>" if whole else "set_id long, n int, sketch array<long>"
    found = texts.id_and_text(docs).mapInArrow(run, schema)
    one = found.groupBy("set_id").agg(*[F.first(name).alias(name) for name in names[1:]])
    return materialise(one.join(wanted, "set_id", "left_semi"), "sets")


def _folded(sketches: list[np.ndarray], words: int) -> np.ndarray:
    """Sketches at one length: their parts of that length, XORed."""
    out = np.empty((len(sketches), words), np.uint64)
    for k, sketch in enumerate(sketches):
        out[k] = np.bitwise_xor.reduce(sketch.reshape(-1, words), axis=0)
    return out


def _allowed(n_a: np.ndarray, n_b: np.ndarray, apart: np.ndarray, p: int, q: int) -> np.ndarray:
    """Whether sizes and sketch distances allow similarity: no similar pair fails this."""
    return (np.minimum(n_a, n_b) * q >= np.maximum(n_a, n_b) * p) & (apart * (p + q) <= (n_a + n_b) * (q - p))


def _sketches_of(column: pa.Array) -> list[np.ndarray]:
    cuts = column.offsets.to_numpy()
    values = column.values.to_numpy().view(np.uint64)
    return [values[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _close(pairs: DataFrame, p: int, q: int) -> DataFrame:
    """Of rows (a, b, n_a, n_b, s_a, s_b) the pairs (a, b) that sizes and sketches allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (_sketches_of(batch.column(name)) for name in ("s_a", "s_b"))
            words = np.array([min(len(x), len(y)) for x, y in zip(first, second, strict=True)], np.int64)
            apart = np.zeros(batch.num_rows, np.int64)
            for w in np.unique(words).tolist():
                own = np.flatnonzero(words == w)
                x, y = (_folded([side[k] for k in own], w) for side in (first, second))
                apart[own] = np.bitwise_count(x ^ y).sum(1)
            n_a, n_b = (batch.column(name).to_numpy().astype(np.int64) for name in ("n_a", "n_b"))
            yield batch.filter(pa.array(_allowed(n_a, n_b, apart, p, q))).select(["a", "b"])

    return pairs.select("a", "b", "n_a", "n_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def _side(members: DataFrame, side: str) -> DataFrame:
    return members.select(F.col("set_id").alias(side), F.col("n").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))


class _Verifier:
    """Checks pairs: sizes, then the sketches' bound, then the whole sets.

    Whole sets are read from the documents again, and only those that a pair
    which the sketches leave names and that have not been read before.
    """

    def __init__(self, docs: DataFrame, size: int, members: DataFrame, p: int, q: int):
        self._docs, self._size, self._members, self._p, self._q = docs, size, members, p, q
        self._held: DataFrame | None = None

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar."""
        p, q = self._p, self._q
        sides = pairs.join(_side(self._members, "a"), "a").join(_side(self._members, "b"), "b")
        close = bounded(_close(sides, p, q))
        needed = close.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
        if self._held is not None:
            needed = needed.join(self._held.select("set_id"), "set_id", "left_anti")
        needed = materialise(needed, "needed")
        if self._held is None or not needed.isEmpty():
            fresh = _looked_up(self._docs, self._size, needed, whole=True)
            self._held = fresh if self._held is None else self._held.unionByName(fresh)
        # The pairs are broadcast while they are small, so that only sets they name are shuffled, each first set once.
        first = self._held.join(bounded(close.select(F.col("a").alias("set_id")).distinct()), "set_id", "left_semi")
        second = self._held.join(close, F.col("set_id") == F.col("b")).select("a", "b", F.col("tokens").alias("t_b"))
        met = second.join(first.withColumnsRenamed({"set_id": "a", "tokens": "t_a"}), "a")
        common = F.size(F.array_intersect("t_a", "t_b"))
        return met.filter(common * (p + q) >= (F.size("t_a") + F.size("t_b")) * p).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _others(state: DataFrame) -> DataFrame:
    """(member, component, bucket) of all members but the leader of a bucket."""
    return state.select("member", "component", F.explode(F.array_except("buckets", "leads")).alias("bucket"))


def _open_buckets(state: DataFrame) -> DataFrame:
    """Buckets whose members, but the leader, lie in several components, and how many members those are."""
    by_bucket = _others(state).groupBy("bucket").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("size"))
    return by_bucket.filter("_low < _high").select("bucket", "size")


def _met(left: dict, right: dict, same: bool, bucket: int, p: int, q: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Members of two blocks of a bucket that lie in different components and may be similar."""
    words = min(min(map(len, side["sketch"])) for side in (left, right))
    a, b = _folded(left["sketch"], words), _folded(right["sketch"], words)
    # Which of the smaller buckets a member is in: two that share one of them meet there.
    smaller = np.unique(np.concatenate([x for side in (left, right) for x in side["listed"]] or [np.zeros(0, np.int64)]))
    smaller = smaller[smaller < bucket]

    def inside(side: dict) -> np.ndarray:
        out = np.zeros((len(side["listed"]), len(smaller)), np.float32)
        for k, listed in enumerate(side["listed"]):
            out[k, np.searchsorted(smaller, listed[listed < bucket])] = 1
        return out

    in_a, in_b = inside(left), inside(right)
    strip = max(1, STRIP_WORDS // max(words * len(b), 1))
    for at in range(0, len(a), strip):
        own = slice(at, at + strip)
        apart = np.bitwise_count(a[own, None, :] ^ b[None, :, :]).sum(2, dtype=np.int64)
        found = _allowed(left["n"][own, None], right["n"][None, :], apart, p, q) & (left["component"][own, None] != right["component"][None, :])
        if found.any() and len(smaller):
            found &= in_a[own] @ in_b.T == 0
        x, y = np.nonzero(found)
        x += at
        if same:
            x, y = x[x < y], y[x < y]
        if len(x):
            yield left["member"][x], right["member"][y]


def _across(state: DataFrame, buckets: DataFrame, members: DataFrame, p: int, q: int) -> DataFrame:
    """Pairs (a, b) across components of a bucket that sizes and sketches allow.

    A bucket of n members has n / BLOCK_SETS blocks. A task holds two of them.
    """
    rows = materialise(_others(state).join(bounded(buckets), "bucket"), "open")
    listed = rows.groupBy("member").agg(F.array_sort(F.collect_set("bucket")).alias("listed"))
    listed = listed.select("member", F.slice("listed", 1, LISTED).alias("listed"))
    whole = rows.join(listed.join(members.withColumnRenamed("set_id", "member"), "member"), "member")
    blocks = F.ceil(F.col("size") / F.lit(BLOCK_SETS)).cast("int")
    whole = whole.withColumn("own", F.pmod(F.xxhash64("member", "bucket"), blocks).cast("int"))
    dealt = whole.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    dealt = dealt.select(
        "bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "member", "component", "n", "sketch", "listed"
    )
    key = ["bucket", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def side(table: pa.Table, block: int) -> dict | None:
            own = table.filter(pa.compute.equal(table.column("own"), block)).combine_chunks()
            if not own.num_rows:
                return None
            one = {name: own.column(name).chunk(0) for name in ("sketch", "listed", "member", "component", "n")}
            out = {name: one[name].to_numpy().astype(np.int64) for name in ("member", "component", "n")}
            return out | {"sketch": _sketches_of(one["sketch"]), "listed": [x.view(np.int64) for x in _sketches_of(one["listed"])]}

        def compared() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            bucket, low, high = (table.column(name)[0].as_py() for name in key)
            left = side(table, low)
            right = left if low == high else side(table, high)
            if left and right:
                for x, y in _met(left, right, low == high, bucket, p, q):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = [batch.column(name).to_numpy() for name in key]
            turns = np.flatnonzero(np.logical_or.reduce([x[1:] != x[:-1] for x in names])) + 1
            for a, b in zip([0, *turns.tolist()], [*turns.tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                if held and any(held[0].column(name)[0] != part.column(name)[0] for name in key):
                    yield from compared()
                    held = []
                held.append(part)
        if held:
            yield from compared()

    ordered = dealt.repartition(*key).sortWithinPartitions(*key)
    return ordered.mapInArrow(run, "a long, b long").distinct()


def similar_sets(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """node, component over set ids: the components of similar sets with more than one set.

    Sets A and B are similar if q * |A and B| >= p * |A or B| for similarity (p, q).
    """
    p, q = similarity
    rows = _buckets(_segment_rows(docs, size, p, q))
    # One row per member, with its buckets and their leaders; buckets with the same members become one here.
    leads = F.collect_set(F.when(F.col("leader") == F.col("member"), F.col("bucket"))).alias("leads")
    held = materialise(rows.groupBy("member").agg(F.collect_set("leader").alias("leaders"), F.collect_set("bucket").alias("buckets"), leads), "members")
    members = _looked_up(docs, size, held.select(F.col("member").alias("set_id")), whole=False)
    verified = _Verifier(docs, size, members, p, q)
    stars = held.select(F.explode("leaders").alias("a"), F.col("member").alias("b")).filter("a != b")
    bound = members.count()
    found = components(verified(_ordered(stars)), bound)
    own = held.join(found.withColumnRenamed("node", "member"), "member", "left")
    state = materialise(own.select("member", F.coalesce("component", "member").alias("component"), "buckets", "leads"), "state")
    buckets = materialise(_open_buckets(state), "open_buckets")
    if buckets.isEmpty():
        return found
    known = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(known.unionByName(verified(_across(state, buckets, members, p, q))), 2 * bound)


def _classified(docs: DataFrame, size: int, similarity: tuple[int, int], row=None) -> DataFrame:
    """doc_id, n_shingles, set_id, row, component_set and component_id of every row."""
    sets = materialise(shingle_sets(docs, size, row).hint("rebalance"), "sets")
    least = sets.filter(F.col("set_id").isNotNull()).groupBy("set_id").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_rows"))
    similar = similar_sets(docs, size, similarity)
    named = least.join(similar.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("_root", F.coalesce("component", "set_id"))
    roots = named.groupBy("_root").agg(F.min("_least").alias("component_id"), F.sum("_rows").alias("_rows")).filter("_rows > 1").drop("_rows")
    named = materialise(named.select("set_id", "_root").join(roots, "_root"), "named")
    joined = sets.join(named.withColumn("_linked", F.lit(True)), "set_id", "left")
    return joined.select(
        "doc_id", "n_shingles", "set_id", "row", F.coalesce("_root", "set_id").alias("component_set"),
        F.when(F.col("_linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, set_id, component_set, component_id of every row.

    component_id is the least doc_id of the component, component_set its least
    set id (null for the empty set).
    """
    return _classified(docs, size, similarity).drop("row")


def first_of_each(docs: DataFrame, size: int = SHINGLE, similarity: tuple[int, int] = SIMILARITY) -> DataFrame:
    """``docs`` without near duplicates: of each component one row stays.

    It is the row with the least id; of several with that id the one with the
    least set id, then with the least hash over all its columns, so the choice
    is the same in every run. Equal rows leave one. Rows without words stay, as
    they are linked with nothing.
    """
    kinds = dict(docs.dtypes)
    row = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns if "map<" not in kinds[c]])
    rank = F.struct(F.col("doc_id").isNull().alias("lacking"), "doc_id", "set_id", "row")
    found = materialise(_classified(docs, size, similarity, row), "classified")
    blank = found.filter(F.col("set_id").isNull())
    firsts = found.filter(F.col("set_id").isNotNull()).groupBy("component_set").agg(F.min(rank).alias("kept")).select("kept.doc_id", "kept.row")
    once = firsts.withColumn("once", F.lit(True)).unionByName(blank.select("doc_id", "row").distinct().withColumn("once", F.lit(False)))
    key, kept_id, kept_row, single = texts.free_names(docs, "_key", "_kept_id", "_kept_row", "_once")
    names = once.select(F.col("doc_id").alias(kept_id), F.col("row").alias(kept_row), F.col("once").alias(single))
    on = (F.col(key) == F.col(kept_row)) & F.col("doc_id").cast("long").eqNullSafe(F.col(kept_id))
    met = docs.withColumn(key, row).join(bounded(names), on).drop(kept_id, kept_row)
    # Rows that are equal in every column and not blank: one of each stays.
    worded = found.filter(F.col("set_id").isNotNull()).join(firsts, "row", "left_semi")
    again = bounded(worded.groupBy("row").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("row").alias(kept_row)))
    if again.isEmpty():
        return met.select(*docs.columns)
    repeated = F.col(single) & (F.col(key) == F.col(kept_row))
    alone = met.join(again, repeated, "left_anti")
    one = met.join(again, repeated, "left_semi").dropDuplicates([key])
    return alone.unionByName(one).select(*docs.columns)

"""Exact Jaccard join of documents on word n-grams, with components of the links.

1. One pass hashes the n-gram set of every document, gives equal sets one class, and counts n-grams
   in a sketch of fixed size. The sketch defines the global order of n-grams, rare ones first; any
   order gives the same result, this one keeps frequent n-grams out of the prefixes.
2. Each class sends out the prefix of its ordered set: two sets that reach the threshold share an
   n-gram of their prefixes. Prefix n-grams that only one class has go no further.
3. Rounds: every class is paired with a few leaders only, classes of another component that it shares most
   prefix n-grams with, in bands of sizes that can link. This is linear in the rows, and joins large groups
   of near copies without looking at all their pairs, also where only a few of these link. Each round
   draws other leaders; n-grams whose classes are all in one component are done. Rounds go on
   while they join a fair share of what they try. After the first round only crowded n-grams take
   part, as the complete pairs of the others are linear in the rows anyway.
4. What can still link two components is then paired completely: per prefix n-gram, the classes
   outside its largest component with all classes of other components, under the length, positional
   and suffix filters, each pair once. Most such n-grams have two rows: an aggregate makes their pair.
5. Pairs are verified on their whole sets. Pairs inside one component are never built: they cannot
   change the result. Links become pairs of components before components are joined.

Texts of classes that share a prefix n-gram are found in the scan by their keys, if these are few, else by a Bloom
filter of bounded size, stored once, and move only for pairs that pass all filters (a text is shorter than its set);
a filter of these pairs stands before that shuffle too. Joins on n-grams are plain equi-joins, so adaptive execution can
split hot ones. Every step starts from stored tables, and its shuffle files go when it ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sparcel.llm import hashing
from sparcel.llm.common import shuffles_removed, stored
from sparcel.operators.components import star_links

WIDTH = 5
THRESHOLD = (80, 100)
#: Counters of the sketch and of one of its parts; what the driver sums up and broadcasts is 4 bytes times the first.
SKETCH, PART = 1 << 22, 1 << 12
#: Ranges of the hash space by which the suffix filter compares two sets.
RANGES = 64
#: Leaders that a class tries in the first rounds. Rounds with the last number go on while one of FAIR pairs links;
#: then what is left is paired completely. Leaders that each n-gram draws in these rounds.
TRIED, FAIR, DRAWS = (1, 1, 8), 64, 4
#: An n-gram that more open rows have goes through the rounds; those of the others are all paired at the end.
CROWDED = 8
#: Most bits of a Bloom filter, 64-bit words of one of its parts, and bits set for a key.
BLOOM, BLOOM_PART, PROBES = 1 << 27, 1 << 12, 5
#: So many keys are broadcast as they are; a Bloom filter stands for more.
FEW = 1 << 14
#: Rows of a few numbers come from one of so many partitions, whose number is chosen for texts; pairs that a task verifies at least.
NARROW, VERIFIED = 8, 256
#: First n-grams of a class that its rows know when they are paired.
FIRSTS = 16

_SETS = "c long, n int, hist array<int>, ranges array<short>, text string"


def _need(n, threshold) -> int:
    """Smallest overlap with a set of n members that can reach the threshold."""
    a, b = threshold
    return (n * a + b - 1) // b


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(np.int64)


def _narrow(rows: DataFrame) -> DataFrame:
    """Fewer partitions for rows of a few numbers, as each task that writes or starts Python has its own cost."""
    spark = rows.sparkSession
    return rows.coalesce(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // NARROW))


def _add(counts: np.ndarray, seen: list[np.ndarray]) -> None:
    at, n = np.unique(np.concatenate(seen), return_counts=True)
    counts[at] = np.minimum(counts[at].astype(np.int64) + n, 0xFFFFFFFF)


def _keys_and_counts(batches: Iterator[pa.RecordBatch], schema: pa.Schema, width: int) -> Iterator[pa.RecordBatch]:
    """(id, t, text) -> a row for each document, and the sketch of the task in parts."""
    counts, seen, held = np.zeros(SKETCH, np.uint32), [], 0
    for batch in batches:
        n, c, k = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        for row, words in hashing.word_hashes(batch.column(2)):
            members = hashing.shingles(words, width)
            n[row] = len(members)
            if len(members):
                c[row], k[row] = hashing.set_keys(members)
                seen.append(_bucket(members))
                held += len(members)
                if held >= SKETCH // 4:
                    _add(counts, seen)
                    seen, held = [], 0
        none = pa.nulls(batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n), pa.array(c), pa.array(k), none.cast(pa.int32()), none.cast(pa.binary())],
            schema=schema,
        )
    if seen:
        _add(counts, seen)
    parts = [(p, counts[p * PART:(p + 1) * PART]) for p in range(SKETCH // PART)]
    parts = [(p, x.astype(np.min_scalar_type(x.max()))) for p, x in parts if x.any()]
    if parts:
        m = len(parts)
        columns = [pa.nulls(m).cast(f.type) for f in schema][:5]
        columns += [pa.array([p for p, _ in parts], pa.int32()), pa.array([x.tobytes() for _, x in parts], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _sum_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(raw, f"<u{len(raw) // PART}").astype(np.int64)
            total[p] = total[p] + x if p in total else x
    if total:
        sums = [np.minimum(x, 0xFFFFFFFF) for x in total.values()]  # an order is all that is asked for
        packed = [x.astype(np.min_scalar_type(x.max())).tobytes() for x in sums]
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"])


def _sketch(first: DataFrame) -> np.ndarray:
    """Sum of the parts, a vector of fixed length on the driver, in the narrowest type that holds it."""
    parts = first.where("part IS NOT NULL").select("part", "counts").repartition("part")
    counts = np.zeros(SKETCH, np.uint8)
    for row in stored(parts.mapInArrow(_sum_parts, "part int, counts binary"), "sketch").toLocalIterator():
        part = np.frombuffer(row["counts"], f"<u{len(row['counts']) // PART}")
        if part.itemsize > counts.itemsize:
            counts = counts.astype(part.dtype)
        counts[row["part"] * PART:(row["part"] + 1) * PART] = part
    return counts


def _prefixes(batches: Iterator[pa.RecordBatch], counts, width: int, threshold) -> Iterator[pa.RecordBatch]:
    """(text) -> (g, c, n, pos) for the rarest n-grams of each document."""
    rank = counts.value
    for batch in batches:
        out: list[tuple] = []
        held = 0
        for _, words in hashing.word_hashes(batch.column(0)):
            members = hashing.shingles(words, width)
            n = len(members)
            if n == 0:
                continue
            size = n - _need(n, threshold) + 1
            # members are sorted by hash, so a stable sort by count orders by (count, hash)
            order = np.argsort(rank[_bucket(members)], kind="stable")[:size]
            c, _ = hashing.set_keys(members)
            out.append((members[order].view(np.int64), np.full(size, c), np.full(size, n, np.int32), np.arange(size, dtype=np.int32)))
            held += size
            if held > 200_000:
                yield _batch(out)
                out, held = [], 0
        if out:
            yield _batch(out)


def _batch(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["g", "c", "n", "pos"]
    )


def _shared(batches: Iterator[pa.RecordBatch], threshold) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (g, c): drop copies and n-grams that only one class has, and name first partners.

    ``lead`` is the first class of the n-gram whose size can link with the row's, ``prev`` the class
    before the row. Class keys are hashes, so both are random ones, and the same for most n-grams of
    a group of copies: a star and a chain through each group. Where there is no such class, the
    row's own stands. One row and the leaders of its n-gram (their sizes lie apart by the
    threshold) are kept between batches.
    """
    p, q = threshold
    last, last_paired = None, False  # (g, c, n, pos, lead, prev) not given out yet
    leaders: list[tuple[int, int]] = []
    for batch in batches:
        g, c, n, pos = (batch.column(i).to_numpy() for i in range(4))
        if last is not None:
            g, c, n, pos = (np.concatenate([[a], b]) for a, b in zip(last[:4], (g, c, n, pos), strict=True))
        if not len(g):
            continue
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (c[1:] != c[:-1])
        g, c, n, pos = g[new], c[new], n[new], pos[new]
        same = g[1:] == g[:-1]
        paired = np.zeros(len(g), bool)
        paired[1:] |= same
        paired[:-1] |= same
        lead = c.copy()
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        ends = np.append(starts[1:], len(g))
        several = ends - starts > 1
        several[0] |= last is not None
        several[-1] = True
        for a, b in zip(starts[several], ends[several], strict=True):
            known = leaders if a == 0 and last is not None else []
            left = np.arange(a, b)
            for own, size in known:
                ok = np.minimum(n[left], size) * q >= np.maximum(n[left], size) * p
                lead[left[ok]] = own
                left = left[~ok]
            while len(left):
                own, size = int(c[left[0]]), int(n[left[0]])
                known.append((own, size))
                ok = np.minimum(n[left], size) * q >= np.maximum(n[left], size) * p
                lead[left[ok]] = own
                left = left[~ok]
        leaders = known
        prev = c.copy()
        near = same & (np.minimum(n[1:], n[:-1]) * q >= np.maximum(n[1:], n[:-1]) * p)
        prev[1:][near] = c[:-1][near]
        if last is not None:
            paired[0] |= last_paired
            prev[0] = last[5]
        last, last_paired = (g[-1], c[-1], n[-1], pos[-1], lead[-1], prev[-1]), bool(paired[-1])
        keep = paired[:-1]
        if keep.any():
            yield _token_batch(*(x[:-1][keep] for x in (g, c, n, pos, lead, prev)))
    if last is not None and last_paired:
        yield _token_batch(*(np.array([x]) for x in last))


def _token_batch(g, c, n, pos, lead, prev) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(g), pa.array(c), pa.array(n.astype(np.int32)), pa.array(pos.astype(np.int32)), pa.array(lead), pa.array(prev)],
        names=["g", "c", "n", "pos", "lead", "prev"],
    )


def _bloom_bits(keys: np.ndarray, bits: int) -> np.ndarray:
    """(PROBES x keys) bit numbers; ``bits`` is a power of two."""
    h = hashing.mix(keys.view(np.uint64))
    step = hashing.mix(h) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) >> np.uint64(64 - bits.bit_length() + 1) for i in range(PROBES)]).astype(np.int64)


def _bloom_parts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(key) -> the Bloom filter of the task, in the parts that are not empty."""
    words = np.zeros(size // 64, np.uint64)
    for batch in batches:
        bits = _bloom_bits(batch.column(0).to_numpy(), size).ravel()
        np.bitwise_or.at(words, bits >> 6, np.uint64(1) << (bits & 63).astype(np.uint64))
    parts = words.reshape(-1, BLOOM_PART)
    held = np.flatnonzero(parts.any(1))
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array([parts[p].tobytes() for p in held], pa.binary())], names=["part", "words"])


def _united_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(raw, np.uint64)
            total[p] = total[p] | x if p in total else x
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["part", "words"])


def _bloom(keys: DataFrame, size: int) -> np.ndarray:
    """Bloom filter of a column of longs, of ``size`` bits on the driver."""
    parts = _narrow(keys.mapInArrow(lambda it: _bloom_parts(it, size), "part int, words binary").repartition("part"))
    words = np.zeros((size // 64 // BLOOM_PART, BLOOM_PART), np.uint64)
    for row in stored(parts.mapInArrow(_united_parts, "part int, words binary"), "bloom").toLocalIterator():
        words[row["part"]] = np.frombuffer(row["words"], np.uint64)
    return words.ravel()


def _bits(keys: int) -> int:
    """Bits of a filter for so many keys: 16 each, a power of two, one part at least."""
    return min(BLOOM, max(64 * BLOOM_PART, 1 << (16 * keys).bit_length()))


def _passes(batches: Iterator[pa.RecordBatch], bloom) -> Iterator[pa.RecordBatch]:
    """(key, text) -> rows whose key the filter may hold."""
    words = bloom.value
    for batch in batches:
        bits = _bloom_bits(batch.column(0).to_numpy(), 64 * len(words))
        yield batch.filter(pa.array(((words[bits >> 6] >> (bits & 63).astype(np.uint64)) & np.uint64(1)).all(0)))


def _held(rows: DataFrame, keys: DataFrame, n: int) -> tuple[DataFrame, Broadcast | None]:
    """Rows (key, text) whose key is one of the ``n`` keys, and maybe a few more, without moving them; and the filter, if one was made."""
    if n <= FEW:
        return rows.join(F.broadcast(keys), "key", "left_semi"), None
    bloom = rows.sparkSession.sparkContext.broadcast(_bloom(keys, _bits(n)))
    return rows.mapInArrow(lambda it: _passes(it, bloom), "key long, text string"), bloom


def _texts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(key, text) -> the class of each text that has words, and the counts of its set by range."""
    for batch in batches:
        rows, c, n, hists = [], [], [], []
        for row, words in hashing.word_hashes(batch.column(1)):
            m = hashing.shingles(words, width)
            if len(m):
                rows.append(row)
                c.append(hashing.set_keys(m)[0])
                n.append(len(m))
                hists.append(np.bincount((m >> np.uint64(58)).astype(np.int64), minlength=RANGES))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()), pa.array(n, pa.int32()), pa.array([h.tolist() for h in hists], pa.list_(pa.int32())),
             pa.array([_short(h) for h in hists], pa.list_(pa.int16())), batch.column(1).take(pa.array(rows, pa.int64()))],
            names=["c", "n", "hist", "ranges", "text"],
        )


def _short(hist: np.ndarray) -> list[int] | None:
    """Counts by range for rows that are paired; null if one is too large for a short."""
    return hist.tolist() if hist.max() < 1 << 15 else None


def _most_shared(x: str, y: str) -> Column:
    """Upper bound of the overlap of two sets: the sum of the lesser counts."""
    both = F.zip_with(x, y, lambda a, b: F.least(a, b).cast("long"))
    return F.aggregate(both, F.lit(0).cast("long"), lambda total, n: total + n)


def _verified(batches: Iterator[pa.RecordBatch], width: int, threshold) -> Iterator[pa.RecordBatch]:
    """(a, b, text_a, text_b), sorted by b -> pairs that reach the threshold."""
    p, q = threshold
    for batch in batches:
        b = batch.column(1).to_numpy()
        firsts = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]])) if len(b) else b
        seconds = [hashing.shingles(w, width) for _, w in hashing.word_hashes(batch.column(3).take(pa.array(firsts)))]
        at = np.searchsorted(firsts, np.arange(len(b)), "right") - 1
        ok = np.zeros(len(b), bool)
        for i, words in hashing.word_hashes(batch.column(2)):
            x = hashing.shingles(words, width)
            both = np.concatenate([x, seconds[at[i]]])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            ok[i] = q * shared >= p * (len(both) - shared)
        yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], names=["u", "v"])


def _with_before(tokens: DataFrame) -> DataFrame:
    """Add ``before``: those of the first FIRSTS n-grams of the class that stand before the row's.

    Two rows that share one of these also meet there, with more room ahead, so their pair need not
    be built again. A class's n-grams are gathered in one row, as its set is.
    """
    placed = F.array_sort(F.collect_list(F.struct("pos", "g")))
    firsts = tokens.groupBy("c").agg(F.slice(placed, 1, FIRSTS).alias("firsts"))
    earlier = F.filter("firsts", lambda f: f["pos"] < F.col("pos"))
    return tokens.join(firsts, "c").withColumn("before", F.transform(earlier, lambda f: f["g"])).drop("firsts")


def _pairs(x: DataFrame, y: DataFrame, threshold) -> DataFrame:
    """Pairs (a, b) of classes of other components that meet in a prefix n-gram, some more than once."""
    p, q = threshold
    low, high = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    # positional filter, for the first n-gram that both have: the overlap starts there, so all of it has
    # to fit behind; every pair that links has such a row, and later ones need not bring it again
    ahead = F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    return (
        x.alias("x").join(y.alias("y"), "g")
        .where(F.col("x.comp") != F.col("y.comp"))
        .where((low * q >= high * p) & (ahead * (p + q) >= (low + high) * p))
        # a pair that meets in several n-grams is built at the first, as far as the rows know it
        .where(~F.arrays_overlap("x.before", "y.before"))
        # suffix filter; sets whose counts are too large for it here meet it before they move
        .where(F.coalesce(_most_shared("x.ranges", "y.ranges") * (p + q) >= (low + high) * p, F.lit(True)))
        .select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b"))
    )


def _lone_pairs(rows: DataFrame, threshold) -> DataFrame:
    """``_pairs`` for n-grams with two rows, which stand in two components: an aggregate, no row is joined.

    The length and positional filters ask for the lesser and greater values only, whichever row has them.
    """
    p, q = threshold
    both = rows.groupBy("g").agg(
        F.min("c").alias("a"), F.max("c").alias("b"), F.min("n").alias("low"), F.max("n").alias("high"), F.min(F.col("n") - F.col("pos")).alias("ahead")
    )
    near = (F.col("low") * q >= F.col("high") * p) & (F.col("ahead") * (p + q) >= (F.col("low") + F.col("high")) * p)
    return both.where(near).select("a", "b")


def _links(pairs: DataFrame, sets: DataFrame, width: int, threshold, name: str) -> tuple[DataFrame, int]:
    """Verified pairs, and how many were tried; texts move only for pairs that pass the suffix filter."""
    p, q = threshold
    facts = sets.select("c", "n", "hist")
    # suffix filter: the overlap can be no more than that of the counts by range
    enough = _most_shared("hist_a", "hist_b") * (p + q) >= (F.col("n_a").cast("long") + F.col("n_b")) * p
    near = (
        pairs.join(facts.select(F.col("c").alias("a"), F.col("n").alias("n_a"), F.col("hist").alias("hist_a")), "a")
        .join(facts.select(F.col("c").alias("b"), F.col("n").alias("n_b"), F.col("hist").alias("hist_b")), "b")
        .where(enough).select("a", "b").distinct()
    )
    near = stored(_narrow(near), f"near-{name}")
    tried = near.count()
    keys = near.select(F.explode(F.array("a", "b")).alias("key"))
    texts, bloom = _held(sets.select(F.col("c").alias("key"), "text"), keys, 2 * tried)
    both = (
        near.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
        .select("a", "b", "text_a", "text_b")
    )
    both = both.coalesce(max(pairs.sparkSession.sparkContext.defaultParallelism, tried // VERIFIED))
    links = stored(both.mapInArrow(lambda it: _verified(it, width, threshold), "u long, v long"), name)
    if bloom is not None:
        bloom.unpersist()
    return links, tried


def _joined(links: DataFrame, comps: DataFrame | None, name: str) -> DataFrame:
    """(id, component) after more links, for all ids but the smallest of a component; links inside a component are left out."""
    for c in ("u", "v") if comps is not None else ():
        own = comps.select(F.col("id").alias(c), F.col("component").alias("own"))
        links = links.join(own, c, "left").withColumn(c, F.coalesce("own", c)).drop("own")
    stars = star_links(links, lambda edges: stored(_narrow(edges), f"{name}-edges")).select(F.col("u").alias("id"), F.col("v").alias("component"))
    if comps is None:
        return stars
    above = stars.select(F.col("id").alias("component"), F.col("component").alias("root"))
    moved = comps.join(above, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
    return stored(moved.unionByName(stars), name)


def _labelled(tokens: DataFrame, comps: DataFrame) -> DataFrame:
    return tokens.join(comps, tokens.c == comps.id, "left").select(*tokens.columns, F.coalesce("component", "c").alias("comp"))


def _open_tokens(tokens: DataFrame, comps: DataFrame | None) -> DataFrame:
    """Rows of prefix n-grams that two components have, with how many they are and the component that has most as ``main``."""
    own = tokens.select("g", "c", "n", "pos")
    own = _labelled(own, comps) if comps is not None else own.withColumn("comp", F.col("c"))
    share = own.groupBy("g", "comp").agg(F.count(F.lit(1)).alias("rows"))
    mains = (
        share.groupBy("g").agg(F.max(F.struct("rows", "comp")).alias("most"), F.count(F.lit(1)).alias("k"), F.sum("rows").alias("rows"))
        .where("k > 1").select("g", F.col("most.comp").alias("main"), "rows")
    )
    return own.join(mains, "g")


def _first_pairs(tokens: DataFrame) -> DataFrame:
    """Each class with the first partner that it shares most prefix n-grams with."""
    both = tokens.select("c", F.explode(F.array_distinct(F.array("lead", "prev"))).alias("other"))
    return _best(both.where("other != c"))


def _best(met: DataFrame, tried: int = 1) -> DataFrame:
    """(c, other), a row for each n-gram -> the pairs to try: of each class those with most n-grams, ``b`` being the partner."""
    shared = met.groupBy("c", "other").agg(F.count(F.lit(1)).alias("shared"))
    if tried == 1:
        best = shared.groupBy("c").agg(F.max_by("other", F.struct("shared", "other")).alias("other"))
    else:
        order = Window.partitionBy("c").orderBy(F.desc("shared"), "other")
        best = shared.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= tried)
    return best.select(F.col("c").alias("a"), F.col("other").alias("b"))


def _leader_pairs(tokens: DataFrame, threshold, number: int, tried: int) -> DataFrame:
    """For each class ``tried`` leaders of other components, those that it shares most prefix n-grams with.

    A leader is drawn from the component that has most rows of a prefix n-gram in a band of sizes, by a
    hash that is new in each round; where several are tried, each n-gram draws DRAWS for itself. Bands are as
    wide as the threshold, so a class looks in its own and the two next to it.
    """
    p, q = threshold
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(q / p))).cast("int") if p < q else F.col("n")
    rows = tokens.withColumn("band", band)
    hashes = [F.xxhash64("c", F.lit(number))] if tried == 1 else [F.xxhash64("c", "g", F.lit(number), F.lit(i)) for i in range(DRAWS)]
    ones = [F.min(F.struct(h.alias("h"), "n", "c")).alias(f"d{i}") for i, h in enumerate(hashes)]
    per = rows.groupBy("g", "band", "comp").agg(F.count(F.lit(1)).alias("rows"), *ones)
    drawn = F.array(*[F.struct(F.col(f"d{i}.n").alias("n"), F.col(f"d{i}.c").alias("c"), "comp") for i in range(len(ones))])
    leaders = per.groupBy("g", "band").agg(F.max_by(drawn, F.struct("rows", "comp")).alias("leads"))
    near = leaders.select("g", F.explode(F.array(*[F.col("band") + F.lit(d) for d in ((-1, 0, 1) if p < q else (0,))])).alias("band"), "leads")
    met = (
        rows.join(near, ["g", "band"]).select("c", "n", "comp", F.explode(F.array_distinct("leads")).alias("lead"))
        .where("lead.comp != comp").where(F.least("n", "lead.n") * q >= F.greatest("n", "lead.n") * p)
    )
    return _best(met.select("c", F.col("lead.c").alias("other")), tried)


def _plain(key: Column) -> Column:
    """A form of an id that is never null. Null and empty ids meet, but are used with a hash of the text only."""
    return F.coalesce(key.cast("string"), F.lit(""))


def ngram_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD,
) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id``.

    Words are runs of anything but white space (space, tab to carriage return), with A-Z lowered. A
    set holds the distinct runs of ``width`` words, or all words as one run if there are fewer. Two
    documents link when ``|A & B| * threshold[1] >= |A | B| * threshold[0]``; ``component_id`` is the
    smallest id that links lead to, the own one included.

    * A text without words, or null, has an empty set: it links with nothing, not even with others
      of its kind, and its component is its own id.
    * Null ids take part; the component of a group is its smallest non-null id, or null.
    * Rows with the same id count as documents of their own. Other columns are ignored.
    * N-grams are compared by 64-bit hashes, equal sets by 128 bits.
    """
    a, b = threshold
    if not 0 < a <= b:
        raise ValueError("the threshold is a fraction in (0, 1]")
    with shuffles_removed(docs.sparkSession):
        rows, classes, comps = _components(docs, doc_id, text, width, threshold)
    labelled = classes.join(comps, classes.c == comps.id, "left") if comps is not None else classes.withColumn("component", F.lit(None).cast("long"))
    labelled = labelled.select("c", "k", "n", "low", F.coalesce("component", "c").alias("comp"))
    lows = labelled.groupBy("comp").agg(F.min("low").alias("component_id"))
    named = labelled.join(lows, "comp").select("c", "k", "n", "component_id")
    return (
        rows.join(named, ["c", "k", "n"], "left")
        .select(
            F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        )
    )


def _components(docs: DataFrame, doc_id: str, text: str, width: int, threshold: tuple[int, int]) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The rows with their classes, the classes, and the component of each class that links."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("t"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([
        base.schema["id"], *T.StructType.fromDDL("t long, n long, c long, k long, part int, counts binary").fields,
    ])
    arrow = pa.schema([pa.field(f.name, f.type, True) for f in to_arrow_schema(schema)])
    first = stored(base.mapInArrow(lambda it: _keys_and_counts(it, arrow, width), schema), "keys")
    rows = first.where("part IS NULL").select("id", "t", "n", "c", "k")
    counts = spark.sparkContext.broadcast(_sketch(first))
    tokens = (
        base.select("text").mapInArrow(lambda it: _prefixes(it, counts, width, threshold), "g long, c long, n int, pos int")
        .repartition("g").sortWithinPartitions("g", "c")
        .mapInArrow(lambda it: _shared(it, threshold), "g long, c long, n int, pos int, lead long, prev long")
    )
    tokens = stored(tokens, "tokens")
    counts.unpersist()
    classes = rows.where("n > 0").groupBy("c", "k", "n").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("rep"), F.min("id").alias("low")
    )
    wanted = (
        classes.join(tokens.select("c").distinct(), "c", "left_semi")
        .select(_plain(F.col("rep.id")).alias("own"), F.col("rep.t").alias("t"), "c")
    )
    # a row that repeats id and text would bring its text more than once
    often = rows.groupBy(_plain(F.col("id")).alias("own"), "t").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    wanted = stored(_narrow(wanted.join(often, ["own", "t"], "left")), "wanted")
    key = F.xxhash64("own", "t").alias("key")
    once = wanted.where("rows IS NULL")
    named = base.select(_plain(F.col("id")).alias("own"), "t", "text")
    texts, bloom = _held(named.select(key, "text"), once.select(key), once.count())
    again = wanted.where("rows > 1")
    if not again.isEmpty():
        texts = texts.unionByName(named.join(again, ["own", "t"]).dropDuplicates(["own", "t"]).select(key, "text"))
    sets = stored(texts.mapInArrow(lambda it: _texts(it, width), _SETS), "sets")
    if bloom is not None:
        bloom.unpersist()

    links, _ = _links(_first_pairs(tokens), sets, width, threshold, "links0")
    comps = _joined(links, None, "comps0") if links.count() else None
    left = stored(_open_tokens(tokens, comps), "open0")
    crowd, number, stale = left.where(F.col("rows") > CROWDED), 0, False
    while not crowd.isEmpty():
        number += 1
        pairs = _leader_pairs(crowd, threshold, number, TRIED[min(number, len(TRIED) - 1)])
        links, tried = _links(pairs, sets, width, threshold, f"links{number}")
        found = links.count()
        if found:
            comps, stale = _joined(links, comps, f"comps{number}"), True
        if not tried or (number >= len(TRIED) - 1 and found * FAIR <= tried):
            break
        if found:
            crowd = stored(_open_tokens(crowd, comps), f"crowd{number}")
    if stale:
        left = stored(_open_tokens(left, comps), "open")
    full = _with_before(left.where(F.col("rows") > 2)).join(sets.select("c", "ranges").dropDuplicates(["c"]), "c")
    pairs = _pairs(full.where("comp != main"), full, threshold).unionByName(_lone_pairs(left.where(F.col("rows") == 2), threshold)).distinct()
    links, _ = _links(pairs, sets, width, threshold, "links")
    if links.count():
        comps = _joined(links, comps, "comps")
    return rows, classes, comps


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Keep one document of each component: the one that gives it its id. Rows of that id all stay."""
    groups = ngram_components(docs, doc_id, text)
    gone = ~F.col(doc_id).eqNullSafe(F.col("component_id"))
    drop = groups.where(gone & F.col("component_id").isNotNull()).select(F.col(doc_id).alias("__gone")).distinct()
    return docs.join(drop, F.col(doc_id).eqNullSafe(F.col("__gone")), "left_anti")

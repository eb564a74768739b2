"""SimHash near-duplicates, candidates pruned by the pigeonring principle.

A fingerprint's 64 bits are a ring of ``segments`` segments.  If two fingerprints differ in at
most t bits, then from some segment on, *every* chain of l consecutive segments differs in at
most l * t / segments bits (the strong form of the pigeonhole principle on a ring).  So

* the first segments of that chain, as long as the budget is below 1, are equal;
* of the next ones, as long as it is below 2, at most one differs, so one half is equal.

Equality on such a chain is the key under which candidates meet (40 bits for the default of 8
segments and 2 bits).  Candidates must then keep within the budget for every chain length
before their full Hamming distance is counted.

Buckets of up to ``bucket`` fingerprints are compared in their task and give the edges of a
spanning forest, not all pairs.  Members of larger buckets are linked in another exact way
whose groups are bounded: two fingerprints differ in at most 2 r bits if and only if the balls
of radius r around them meet, and no point is in more balls than a ball has points (65 for
r = 1).  Equal fingerprints are folded first, so a bucket never holds copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import keyed_texts, shuffle_partitions
from cubeloom.llm.components import connected_components
from cubeloom.session import materialize

BITS = 64
SEED = 42
BLOCK = 1 << 16


# ------------------------------------------------------------------ fingerprints


def shingle_hashes(words: list[bytes], size: int) -> list[int]:
    """A hash for each run of ``size`` words; fewer words: one for all of them; none: none."""
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)] if words else []
    shifted = [words[i:] for i in range(size)]
    return [digest(b" ".join(run), SEED) for run in zip(*shifted)]


def fingerprint(text: bytes, size: int) -> int:
    hashes = np.array(shingle_hashes(text.lower().split(), size), "<u8")
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), BLOCK):
        part = hashes[lo : lo + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle_words: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; that of a text without words is 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [
                fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle_words)
                for t in rows.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(found, pa.int64())], ["doc_id", "fp"]
            )

    return keyed_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


# ------------------------------------------------------------------ candidates


def chain_patterns(max_bits: int, segments: int) -> list[tuple[int, list[int]]]:
    """(start, segments that are equal) for each way a chain within budget can look."""
    equal = 0
    while equal < segments and (equal + 1) * max_bits < segments:
        equal += 1
    loose = equal
    while loose < segments and (loose + 1) * max_bits < 2 * segments:
        loose += 1
    middle = equal + (loose - equal) // 2
    tails = [range(equal, middle), range(middle, loose)] if loose - equal >= 2 else [range(0)]
    return [
        (start, [(start + s) % segments for s in (*range(equal), *tail)])
        for start in range(segments)
        for tail in tails
    ]


def chain_keys(fp: Column, max_bits: int, segments: int) -> Column:
    """Array of (start, pattern, bits) under which fingerprints can meet."""
    width = BITS // segments
    keys = []
    for number, (start, own) in enumerate(chain_patterns(max_bits, segments)):
        mask = sum(((1 << width) - 1) << (s * width) for s in own)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(
            F.struct(
                F.lit(start).alias("start"),
                F.lit(number).alias("pattern"),
                fp.bitwiseAND(F.lit(signed).cast("long")).alias("bits"),
            )
        )
    return F.array(*keys)


def within_chain(
    differ: np.ndarray, start: int, max_bits: int, segments: int
) -> np.ndarray:
    """Which xor-ed pairs keep every chain's budget from ``start`` on."""
    width = BITS // segments
    fits = np.ones(len(differ), bool)
    spent = np.zeros(len(differ), np.int64)
    mask = np.uint64((1 << width) - 1)
    for length in range(1, segments + 1):
        at = (start + length - 1) % segments * width
        spent += np.bitwise_count((differ >> np.uint64(at)) & mask)
        fits &= spent * segments <= length * max_bits
    return fits


def spanning_forest(size: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    root = list(range(size))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    edges = []
    for a, b in pairs.tolist():
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            edges.append((a, b))
    return edges


def _compare_buckets(max_bits: int, segments: int, bucket: int):
    """mapInArrow over rows sorted by key: edges (u, v), and v null for a large bucket's u."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def pairs_of(members: np.ndarray, start: int) -> list[tuple[int, int]]:
        a, b = np.triu_indices(len(members), 1)
        differ = members[a] ^ members[b]
        kept = np.flatnonzero(within_chain(differ, start, max_bits, segments))
        kept = kept[np.bitwise_count(differ[kept]) <= max_bits]
        return spanning_forest(len(members), np.stack([a[kept], b[kept]], 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, large = None, [], False
        us: list[int] = []
        vs: list[int | None] = []

        def close() -> None:
            if len(members) > 1 and not large:
                own = np.array(members, np.int64)
                for a, b in pairs_of(own.view(np.uint64), key[0]):
                    us.append(members[a])
                    vs.append(members[b])
            elif large:
                us.extend(members)
                vs.extend([None] * len(members))

        for rows in batches:
            columns = [rows.column(c).to_pylist() for c in ("start", "pattern", "bits", "fp")]
            for start, pattern, bits, fp in zip(*columns):
                if (start, pattern, bits) != key:
                    close()
                    key, members, large = (start, pattern, bits), [], False
                members.append(fp)
                if len(members) > bucket:
                    # goes on as a stream: nothing of a large bucket is kept
                    large = True
                    us.extend(members)
                    vs.extend([None] * len(members))
                    members = []
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=schema
                )
                us.clear()
                vs.clear()
        close()
        if us:
            yield pa.RecordBatch.from_arrays(
                [pa.array(us, pa.int64()), pa.array(vs, pa.int64())], schema=schema
            )

    return run


def ball_edges(fps: DataFrame, max_bits: int) -> DataFrame:
    """Edges among ``fps`` through the points that their balls share."""
    radius = (max_bits + 1) // 2
    flips = [
        sum(1 << bit for bit in bits)
        for size in range(radius + 1)
        for bits in combinations(range(BITS), size)
    ]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    point = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in signed]))
    meets = (
        fps.select("fp", point.alias("point"))
        .groupBy("point")
        .agg(F.collect_set("fp").alias("own"))
        .where(F.size("own") > 1)
    )
    if max_bits % 2:  # the balls are one too wide then
        pairs = meets.select(F.explode("own").alias("u"), "own").select(
            "u", F.explode("own").alias("v")
        )
        return pairs.where(
            (F.col("u") > F.col("v"))
            & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits)
        )
    return meets.select(F.explode("own").alias("u"), F.array_min("own").alias("v")).where("u <> v")


def near_edges(fps: DataFrame, max_bits: int, segments: int, bucket: int) -> DataFrame:
    """A spanning forest's edges (u, v) for fingerprints within ``max_bits``; ``fps`` distinct."""
    keyed = fps.select(
        F.explode(chain_keys(F.col("fp"), max_bits, segments)).alias("k"), "fp"
    ).select("k.start", "k.pattern", "k.bits", "fp")
    parts = shuffle_partitions(fps.sparkSession)
    found = materialize(
        keyed.repartition(parts, "start", "pattern", "bits")
        .sortWithinPartitions("start", "pattern", "bits")
        .mapInArrow(_compare_buckets(max_bits, segments, bucket), "u long, v long"),
        "simhash-edges",
    )
    edges = found.where("v IS NOT NULL")
    crowded = found.where("v IS NULL").select(F.col("u").alias("fp")).distinct()
    return edges.unionByName(ball_edges(crowded, max_bits))


def simhash_components(
    docs: DataFrame,
    shingle_words: int = 3,
    max_bits: int = 2,
    segments: int = 8,
    bucket: int = 128,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``docs``.

    ``component_id`` is the smallest doc_id that can be reached over links of at most
    ``max_bits`` differing bits, the document's own included; it is null only where every
    reachable doc_id is null.  Null and empty texts have the fingerprint 0 and are linked like
    any other.  Other columns are ignored; an empty table gives an empty result.
    """
    own = materialize(fingerprints(docs, shingle_words, id_col, text_col), "simhash")
    fps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = near_edges(fps.select("fp"), max_bits, segments, bucket)
    roots = connected_components(edges)
    labelled = materialize(
        fps.join(roots.withColumnRenamed("node", "fp"), "fp").select("fp", "root", "least"),
        "simhash-linked",
    )
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = labelled.join(smallest, "root").select("fp", "component_id")
    by_fp = fps.join(linked, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    return own.join(by_fp, "fp").select("doc_id", "fp", "component_id")

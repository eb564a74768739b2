"""Near-duplicates at a given share of common shingles, through wide SimHash budgets.

A fingerprint has for each bit what most *distinct* shingles have there.  With 64-bit hashes as
random, a bit of two sets with a, b and c common shingles differs with a chance that is a sum of
binomial terms; among all such sets at 80 % it is largest, 12 / 64, for 4 and 5 shingles, and
tends to arccos(8 / 9) / pi, or 9.7 / 64, for long ones.  So more than 28 of 64 bits differ with a
chance of 1.1e-6 at most (1.4e-8 from 50 shingles on), and more than 20 with 5e-3 (4e-4).

Candidates meet under two kinds of keys.  The *chains* of the pigeonring, as in ``simhash``, find
every pair of at most 2 differing bits: equal parts of a chain are the key, and pairs must keep
the budget of each chain length before their Hamming distance is counted.  Within the wide radius
no chain of segments is equal, so there they meet under *bands*: pairs of least hashes over the
same shingles, which two texts share with probability similarity squared; with 12 bands one pair
in 200,000 at 80 % meets under none.

No pair of candidates is ever a row.  In a band's bucket, fingerprints (full Hamming check) and
sizes of the sets part the members into *cells* that no possible link leaves; cells of several
bands with the same members are one.  A cell's members come to a task with their shingle sets, all
of them are compared there, and only the links of a spanning forest, fewer than members, leave it.
A member whose rare shingles alone put 80 % out of reach is not compared at all, so a passage that
thousands share is no meeting point.  Cells of more shingles than a task should hold are cut into
blocks: each block is a cell first, and what its links do not join yet meets the other blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.common import keyed_texts, shuffle_partitions, text_of, tidy
from cubeloom.llm.components import connected_components
from cubeloom.llm.simhash import BITS, chain_keys, shingle_hashes, within_chain
from cubeloom.session import materialize

BANDS = 12
ROWS = 2  # least hashes in a band
MAX_BITS = 28  # lets a pair at 80 % go with a chance of 1.1e-6 at most, see below
RING_BITS, SEGMENTS = 2, 8  # of the chains under which near fingerprints meet
NO_CHAIN = -1  # the start of a key that is a band
BUCKET = 2_048  # members of a bucket that fingerprints part into cells; larger ones are one cell
CELL_SHINGLES = 3_000_000  # that a task compares at a time
STRIP = 256  # members that are compared with all others in one matrix product
DENSE = 8 << 20  # numbers of a matrix that holds members by shingles
BLOCK = 1 << 13  # shingles that are hashed at a time
# odd multipliers and offsets of the permutations, from a fixed generator
_RNG = np.random.default_rng(20_240_531)
MULTIPLY = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSET = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def sketch(text: bytes, size: int) -> tuple[int, int, list[int], int]:
    """Fingerprint, identity, keys of the bands and size, all of the set of shingles."""
    hashes = np.unique(np.array(shingle_hashes(text.lower().split(), size), np.uint64))
    if not len(hashes):
        return 0, 0, [], 0
    ones = np.zeros(BITS, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), BLOCK):
        part = hashes[lo : lo + BLOCK]
        ones += np.unpackbits(
            part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        ).sum(0, dtype=np.uint32)
        mixed = part[None, :] * MULTIPLY[:, None] + OFFSET[:, None]
        mixed ^= mixed >> np.uint64(29)
        least = np.minimum(least, mixed.min(1))
    fp = np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0]
    keys = least[0::2] * np.uint64(0x9E3779B97F4A7C15) + least[1::2]
    identity = np.bitwise_xor.reduce(hashes * MULTIPLY[0]) + np.uint64(len(hashes))
    return int(fp), int(identity.astype(np.int64)), keys.view(np.int64).tolist(), len(hashes)


def _sketches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for rows in batches:
            found = [
                sketch(t.as_buffer().to_pybytes() if t.is_valid else b"", size)
                for t in rows.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("mark"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(pa.int64())),
                    pa.array([f[3] for f in found], pa.int64()),
                ],
                ["doc_id", "mark", "fp", "node", "bands", "size"],
            )

    return run


def survives_ring(differ: np.ndarray, max_bits: int, segments: int) -> np.ndarray:
    """Whether from some segment on every chain of segments stays within its budget."""
    width = BITS // segments
    mask = np.uint64((1 << width) - 1)
    spent = np.stack(
        [np.bitwise_count((differ >> np.uint64(s * width)) & mask) for s in range(segments)], 1
    ).astype(np.int16)
    ring = np.cumsum(np.concatenate([spent, spent], 1), 1)
    ring = np.concatenate([np.zeros((len(differ), 1), np.int16), ring], 1)
    budget = np.arange(1, segments + 1) * max_bits
    fits = np.zeros(len(differ), bool)
    for start in range(segments):
        chains = ring[:, start + 1 : start + 1 + segments] - ring[:, start : start + 1]
        fits |= (chains * segments <= budget).all(1)
    return fits


# ------------------------------------------------------------------ comparison in a task


def _join(labels: np.ndarray, group: np.ndarray) -> None:
    """Give all members that are linked to a member of ``group`` the least label among them."""
    held = np.zeros(len(labels), bool)
    held[labels[group]] = True
    if np.count_nonzero(held) > 1:
        labels[held[labels]] = np.flatnonzero(held)[0]


def _join_hits(labels: np.ndarray, rows: np.ndarray, columns: np.ndarray, hits: np.ndarray) -> None:
    for place in np.flatnonzero(hits.any(1)):
        _join(labels, np.append(columns[hits[place]], rows[place]))


def possible_cells(
    fps: np.ndarray, sizes: np.ndarray, max_bits: int, similarity: float, start: int = NO_CHAIN
) -> np.ndarray:
    """A label per member; members of different labels cannot be linked.

    With ``start`` the members met under a chain from there, and the pigeonring's budgets hold.
    """
    labels = np.arange(len(fps))
    for lo in range(0, len(fps), STRIP):
        own = slice(lo, lo + STRIP)
        differ = fps[own, None] ^ fps[None, lo:]
        near = np.bitwise_count(differ) <= (max_bits if start == NO_CHAIN else RING_BITS)
        if start != NO_CHAIN:
            near &= within_chain(differ.ravel(), start, RING_BITS, SEGMENTS).reshape(differ.shape)
        low, high = np.minimum(sizes[own, None], sizes[lo:]), np.maximum(sizes[own, None], sizes[lo:])
        # sets that differ more in size cannot have so much in common
        hits = near & (low >= similarity * high - 1e-6)
        places = np.arange(lo, len(fps))
        _join_hits(labels, places[: len(hits)], places, hits)
    return labels


def linked_sets(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """A label per set: sets linked over pairs with ``similarity`` in common have the same one.

    ``sets`` are distinct shingles each.  Exact: every pair that may reach the similarity is
    counted, by matrix products over the shingles that at least two sets have.
    """
    n = len(sets)
    labels = np.arange(n)
    sizes = np.array([len(s) for s in sets], np.int64)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        if sizes.all() and both >= similarity * (sizes.sum() - both) - 1e-9:
            labels[1] = 0
        return labels
    every, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.empty(0, bool)
    shingle = np.cumsum(new) - 1
    shared = np.bincount(shingle) > 1 if len(every) else np.empty(0, bool)
    held = shared[shingle]
    owner, shingle = owner[held], (np.cumsum(shared) - 1)[shingle[held]]
    # who shares too few of its shingles with anyone has no link
    reach = np.bincount(owner, minlength=n) >= similarity * sizes - 1e-9
    open_ = np.flatnonzero(reach & (sizes > 0))
    order = np.argsort(owner, kind="stable")
    owner, shingle = owner[order], shingle[order]
    starts = np.searchsorted(owner, np.arange(n + 1))
    n_shingles = int(shared.sum())
    column_of = np.full(n_shingles, -1, np.int64)

    def entries(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = starts[members + 1] - starts[members]
        row = np.repeat(np.arange(len(members)), counts)
        at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        return row, shingle[at + np.repeat(starts[members], counts)]

    while len(open_) > 1:
        strip = open_[:STRIP]
        if len(np.unique(labels[open_])) == 1:
            break
        own_row, own = entries(strip)
        row, other = entries(open_)
        columns = np.unique(own)
        column_of[columns] = np.arange(len(columns))
        place = column_of[other]
        row, place = row[place >= 0], place[place >= 0]
        own_place = column_of[own]
        both = np.zeros((len(strip), len(open_)), np.float32)
        width = max(1, DENSE // len(open_))
        for lo in range(0, len(columns), width):
            mine, theirs = ((p >= lo) & (p < lo + width) for p in (own_place, place))
            wide = min(width, len(columns) - lo)
            a = np.zeros((len(strip), wide), np.float32)
            a[own_row[mine], own_place[mine] - lo] = 1
            b = np.zeros((len(open_), wide), np.float32)
            b[row[theirs], place[theirs] - lo] = 1
            both += a @ b.T
        column_of[columns] = -1
        needed = similarity * (sizes[strip, None] + sizes[open_] - both) - 1e-6
        _join_hits(labels, strip, open_, both >= needed)
        open_ = open_[len(strip) :]
    return labels


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest(nodes: np.ndarray, labels: np.ndarray) -> pa.RecordBatch:
    """Links from each member to the first of its label: fewer than members."""
    linked = np.flatnonzero(labels != np.arange(len(labels)))
    u, v = nodes[linked], nodes[labels[linked]]
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(u, v)), pa.array(np.minimum(u, v))], schema=LINKS)


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with the same keys, from rows sorted by them."""
    key, parts = None, []
    for rows in batches:
        if not rows.num_rows:
            continue
        every = np.stack([rows.column(c).to_numpy() for c in keys], 1)
        cuts = [0, *(np.flatnonzero((every[1:] != every[:-1]).any(1)) + 1), rows.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if (own := tuple(every[lo].tolist())) != key:
                if parts:
                    yield key, pa.Table.from_batches(parts)
                key, parts = own, []
            parts.append(rows.slice(lo, hi - lo))
    if parts:
        yield key, pa.Table.from_batches(parts)


def _cells(max_bits: int, similarity: float):
    """mapInArrow over rows sorted by band and start: (cell, node), cells of one member left out.

    A bucket that grows beyond ``BUCKET`` goes on as a stream and is a cell as a whole.
    """
    schema = pa.schema([("cell", pa.int64()), ("node", pa.int64())])

    def told(cells: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cells), pa.array(nodes)], schema=schema)

    def part(rows: pa.Table, start: int) -> Iterator[pa.RecordBatch]:
        nodes, fps, sizes = (rows.column(c).to_numpy() for c in ("node", "fp", "size"))
        labels = possible_cells(fps.view(np.uint64), sizes, max_bits, similarity, start)
        held = np.bincount(labels, minlength=len(labels))[labels] > 1
        nodes, labels = nodes[held], labels[held]
        # the same members are the same cell, whatever band they met in
        mixed = (nodes.view(np.uint64) ^ (nodes.view(np.uint64) >> np.uint64(31))) * MULTIPLY[1]
        name = np.zeros(len(fps), np.uint64)
        np.add.at(name, labels, mixed)
        if len(nodes):
            yield told(name[labels].view(np.int64), nodes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        key, parts, count, large = None, [], 0, False

        def close() -> Iterator[pa.RecordBatch]:
            if parts and not large and count > 1:
                yield from part(pa.Table.from_batches(parts), key[1])

        for rows in batches:
            if not rows.num_rows:
                continue
            keys = np.stack([rows.column(c).to_numpy() for c in ("band", "start")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1), rows.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if (own_key := tuple(keys[lo].tolist())) != key:
                    yield from close()
                    key, parts, count, large = own_key, [], 0, False
                parts.append(rows.slice(lo, hi - lo))
                count += hi - lo
                if count > BUCKET:
                    large = True
                    for own in parts:
                        yield told(np.full(own.num_rows, key[0]), own.column("node").to_numpy())
                    parts = []
        yield from close()

    return run


def _compare(similarity: float, keys: tuple[str, ...]):
    """mapInArrow over rows (…, node, shingles) sorted by ``keys``: links of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for _, rows in _groups(batches, keys):
            nodes = rows.column("node").to_numpy()
            sets = [x.values.to_numpy() for x in rows.column("shingles")]
            yield _forest(nodes, linked_sets(sets, similarity))

    return run


def _shingle_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            sets = [
                np.unique(
                    np.array(shingle_hashes(t.as_buffer().to_pybytes().lower().split(), size), np.uint64)
                ).view(np.int64)
                for t in rows.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [rows.column("node"), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    return run


def meeting_keys(nodes: DataFrame) -> DataFrame:
    """(band, start, node, fp, size): every key under which a text can meet another.

    ``start`` is where a key's chain begins on the ring, or NO_CHAIN for a band.
    """
    bands = nodes.select("node", "fp", "size", F.posexplode("bands").alias("number", "key")).select(
        F.xxhash64("number", "key").alias("band"), F.lit(NO_CHAIN).cast("long").alias("start"), "node", "fp", "size"
    )
    keys = F.explode(chain_keys(F.col("fp"), RING_BITS, SEGMENTS)).alias("k")
    chains = nodes.where("size > 0").select("node", "fp", "size", keys).select(
        F.xxhash64("k.start", "k.pattern", "k.bits").alias("band"),
        F.col("k.start").cast("long").alias("start"),
        "node",
        "fp",
        "size",
    )
    return bands.unionByName(chains)


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, mark): doc_id and mark, the text's hash, tell rows of different text apart."""
    return keyed_texts(docs, id_col, text_col).withColumn("mark", F.xxhash64("text"))


def _grouped_rows(
    docs: DataFrame, shingle_words: int, similarity: float, max_bits: int, id_col: str, text_col: str
) -> DataFrame:
    """(doc_id, mark, component_id), one row per row of ``docs``."""
    texts = _marked(docs, id_col, text_col)
    own = materialize(
        texts.mapInArrow(
            _sketches(shingle_words),
            "doc_id long, mark long, fp long, node long, bands array<long>, size long",
        ),
        "near-sketches",
    )
    nodes = materialize(
        own.groupBy("node").agg(
            F.min("doc_id").alias("least"),
            # a row that stands for the node: its text gives the shingles
            F.min(F.struct("doc_id", "mark")).alias("row"),
            *(F.first(c).alias(c) for c in ("fp", "bands", "size")),
        ),
        "near-nodes",
    )
    parts = shuffle_partitions(docs.sparkSession)
    cells = materialize(
        meeting_keys(nodes)
        .repartition(parts, "band")
        .sortWithinPartitions("band", "start", "node")
        .mapInArrow(_cells(max_bits, similarity), "cell long, node long")
        .distinct(),
        "near-cells",
    )
    chosen = nodes.join(cells.select("node").distinct(), "node", "left_semi").select("node", "row.*", "size")
    same = texts["doc_id"].eqNullSafe(chosen["doc_id"]) & (texts["mark"] == chosen["mark"])
    sets = materialize(
        texts.join(chosen, same)
        .select("node", "text")
        .dropDuplicates(["node"])
        .mapInArrow(_shingle_sets(shingle_words), "node long, shingles array<long>"),
        "near-shingles",
    )
    weights = cells.join(nodes.select("node", "size"), "node").groupBy("cell").agg(
        F.ceil(F.sum("size") / CELL_SHINGLES).alias("blocks")
    )
    # rows of a cell are those of its block: all of a cell in one, as a rule
    blocked = materialize(
        cells.join(weights, "cell").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))),
        "near-blocks",
    )

    def compared(rows: DataFrame, *keys: str) -> DataFrame:
        links = (
            rows.join(sets, "node")
            .select(*keys, "node", "shingles")
            .repartition(parts, *keys)
            .sortWithinPartitions(*keys, "node")
            .mapInArrow(_compare(similarity, keys), "u long, v long")
        )
        return materialize(links.distinct(), "near-links")

    links = compared(blocked, "cell", "block")
    roots = connected_components(links)
    heavy = blocked.where("blocks > 1")
    if not heavy.isEmpty():
        links = links.unionByName(compared(_open_blocks(heavy, roots), "cell", "low", "high"))
        roots = connected_components(links)
    linked = materialize(nodes.join(roots, "node").select("node", "root", "least"), "near-linked")
    smallest = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    found = nodes.join(linked.join(smallest, "root").select("node", "component_id"), "node", "left")
    return own.join(
        found.select("node", F.coalesce("component_id", "least").alias("component_id")), "node"
    ).select("doc_id", "mark", "component_id")


def _open_blocks(heavy: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows of the pairs of blocks of a cell that its links so far leave unjoined.

    In each cell the largest group is put apart: its members meet the others, not one another.
    """
    labelled = heavy.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = labelled.groupBy("cell", "root").agg(F.count(F.lit(1)).alias("n"))
    largest = groups.groupBy("cell").agg(F.max(F.struct("n", "root")).alias("top"), F.count(F.lit(1)).alias("groups"))
    unjoined = largest.where("groups > 1").select("cell", F.col("top.root").alias("top"))
    marked = labelled.join(unjoined, "cell").withColumn("main", F.col("root") == F.col("top"))
    # blocks of the members outside the largest group, then those of the group itself
    sizes = marked.groupBy("cell").agg(
        F.ceil(F.count_if(~F.col("main")) * F.first("blocks") / F.count(F.lit(1))).alias("few")
    )
    few = F.greatest(F.col("few"), F.lit(1))
    placed = marked.join(sizes, "cell").withColumn(
        "place",
        F.when(F.col("main"), few + F.col("block")).otherwise(F.pmod(F.xxhash64("node", F.lit(1)), few)),
    )
    last = F.when(F.col("main"), few - 1).otherwise(few + F.col("blocks") - 1)
    return placed.select(
        "cell", "node", "place", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("met")
    ).select("cell", F.least("place", "met").alias("low"), F.greatest("place", "met").alias("high"), "node")


def near_components(
    docs: DataFrame,
    shingle_words: int = 5,
    similarity: float = 0.8,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, component_id), one row per row of ``docs``.

    Texts are linked if their sets of shingles have at least ``similarity`` in common (Jaccard)
    and they are candidates as told above; ``component_id`` is the smallest doc_id reachable.
    Texts without words are linked with one another.  Texts with the same shingles are folded
    before anything is compared.  Rows that share a doc_id and differ in text are texts each.
    """
    rows = _grouped_rows(docs, shingle_words, similarity, max_bits, id_col, text_col)
    return rows.select("doc_id", "component_id")


def keep_one(
    docs: DataFrame,
    shingle_words: int = 5,
    similarity: float = 0.8,
    max_bits: int = MAX_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with the rows of the smallest doc_id of each group of near-duplicates only.

    A row without doc_id goes if its group has a document with one, and stays otherwise.
    """
    rows = _grouped_rows(docs, shingle_words, similarity, max_bits, id_col, text_col)
    gone = (
        rows.where((F.col("doc_id") > F.col("component_id")) | (F.col("doc_id").isNull() & F.col("component_id").isNotNull()))
        .select(F.col("doc_id").alias("__near_id"), F.col("mark").alias("__near_mark"))
        .distinct()
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__near_id")) & (
        F.xxhash64(text_of(text_col)) == F.col("__near_mark")
    )
    return docs.join(gone, same, "left_anti")

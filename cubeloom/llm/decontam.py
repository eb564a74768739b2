"""Benchmark decontamination with suffix arrays of the training texts.

A scan task lays the words of its documents end to end, a shard of about ``SHARD_WORDS`` words
at a time, numbers the distinct words and sorts the shard's suffixes by word: the first key packs
as many words as fit 62 bits, then prefix doubling settles what is still tied, to the depth of
the longest benchmark item.  Every suffix of every item is searched in every shard by binary
search, one more word at a time for all suffixes at once.  That gives its longest verbatim match
there, the range of the suffix array that holds all its locations, and on the way the range of
its first ``window`` words: the places that are hit.

The benchmark goes to the tasks in blocks of bounded size.  With one block, shards live in the
task that made them; with more, they are written once to the shared folder and searched again
for each block.  A document longer than a shard is cut into pieces that overlap by the depth
less one word, so no window is lost; what its pieces find is merged by document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.chunks import Numbers, pack_ints, pack_words, unpack_ints, unpack_words
from cubeloom.llm.common import Shared, numbering, text_of, tidy
from cubeloom.session import materialize

WINDOW = 10
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 8 << 20  # of benchmark texts that tasks search for at a time
PLACES = 1 << 20  # locations that are looked at together
# of a text whose A-Z are lower-cased, which bytes.lower() does and nothing else
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
JVM_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: bytes) -> list[bytes]:
    return WORD.findall(text.lower())


# ------------------------------------------------------------------ suffix arrays


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of the words in ``tokens``, sorted by their next ``depth`` words.

    0 ends a document and is the last token; a suffix that ends there comes before its
    continuations.
    """
    places = np.flatnonzero(tokens)
    if not len(places):
        return places.astype(np.int32)
    bits = int(tokens.max()).bit_length()
    packed = max(1, min(62 // bits, depth))
    padded = np.concatenate([tokens, np.zeros(packed, tokens.dtype)]).astype(np.int64)
    key, goes_on = padded[places], np.ones(len(places), bool)
    for ahead in range(1, packed):
        word = padded[places + ahead]
        goes_on &= word > 0
        key = key << bits | np.where(goes_on, word, 0)
    ends = np.flatnonzero(tokens == 0)
    end = ends[np.searchsorted(ends, places)]
    order = np.argsort(key, kind="stable")
    key, places, end = key[order], places[order], end[order]
    rank = np.zeros(len(tokens), np.int64)

    def groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the group of each key begins, and whether it has others in it."""
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(keys)))
        return np.repeat(begins, sizes), np.repeat(sizes > 1, sizes)

    begins, tied = groups(key)
    rank[places] = begins + 1
    settled = packed
    # suffixes with the same words that have ended by now stay tied
    open_ = np.flatnonzero(tied & (places + settled <= end))
    while len(open_) and settled < depth:
        own, own_end = places[open_], end[open_]
        key = rank[own] * (len(tokens) + 1) + rank[own + settled]
        turn = np.argsort(key, kind="stable")
        key = key[turn]
        places[open_], end[open_] = own[turn], own_end[turn]
        begins, tied = groups(key)
        rank[places[open_]] = open_[begins] + 1
        settled *= 2
        open_ = open_[tied & (places[open_] + settled <= end[open_])]
    return places.astype(np.int32)


@dataclass
class Shard:
    """Documents (or pieces) end to end, each followed by 0, and the order of their suffixes."""

    words: list[bytes]  # numbered from 1
    tokens: np.ndarray
    order: np.ndarray
    pieces: list[tuple]  # (row, doc_id, mark, first word, words), in the order of the tokens
    lengths: list[int]

    def __post_init__(self):
        self.starts = np.concatenate([[0], np.cumsum(np.array(self.lengths[:-1], np.int64) + 1)])

    def to_row(self) -> dict:
        return {
            "pieces": [dict(zip(PIECE.names, p)) for p in self.pieces],
            "lengths": self.lengths,
            "n": len(self.words),
            "words": pack_words(self.words),
            "tokens": pack_ints(self.tokens),
            "suffixes": pack_ints(self.order),
        }

    @classmethod
    def from_row(cls, row: dict) -> Shard:
        return cls(
            unpack_words(row["words"], row["n"]),
            unpack_ints(row["tokens"]).astype(np.int32),
            unpack_ints(row["suffixes"]).astype(np.int32),
            [tuple(p[c] for c in PIECE.names) for p in row["pieces"]],
            row["lengths"],
        )


PIECE = pa.schema(
    [("row", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64()), ("first", pa.int64()), ("n_words", pa.int64())]
)
INDEX = pa.schema(
    [
        ("pieces", pa.list_(pa.struct(list(PIECE)))),
        ("lengths", pa.list_(pa.int32())),
        ("n", pa.int64()),
        ("words", pa.binary()),
        ("tokens", pa.binary()),
        ("suffixes", pa.binary()),
    ]
)
INDEX_DDL = (
    "pieces array<struct<row: long, doc_id: long, mark: long, first: long, n_words: long>>, "
    "lengths array<int>, n long, words binary, tokens binary, suffixes binary"
)


def _shards(batches: Iterator[pa.RecordBatch], depth: int, shard_words: int) -> Iterator[Shard]:
    rows, ids, parts, pieces, size = numbering(), Numbers(), [], [], 0
    end = np.zeros(1, np.int32)

    def close() -> Shard:
        tokens = np.concatenate([x for p in parts for x in (p, end)])
        return Shard(list(ids), tokens, suffix_order(tokens, depth), pieces, [len(p) for p in parts])

    for batch in batches:
        texts = batch.column("text")
        for doc_id, mark, text in zip(
            batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist(), texts
        ):
            words, row = words_of(text.as_buffer().to_pybytes()), next(rows)
            for lo in range(0, max(1, len(words)), shard_words):
                own = words[lo : lo + shard_words + depth - 1]
                parts.append(np.fromiter(map(ids.__getitem__, own), np.int32, len(own)) + np.int32(1))
                # a document's words are told with its first piece
                pieces.append((row, doc_id, mark, lo, 0 if lo else len(words)))
                size += len(own)
                if size >= shard_words:
                    yield close()
                    ids, parts, pieces, size = Numbers(), [], [], 0
    if parts:
        yield close()


# ------------------------------------------------------------------ search


class Items:
    """A block of the benchmark: items with the same id are one item of several texts."""

    def __init__(self, rows: list[tuple[int | None, bytes]], window: int):
        self.window = window
        vocabulary, numbers = Numbers(), []
        self.ids: list[int | None] = []
        self.position: list[int] = []
        self.wanted: list[int] = []  # words of the window that starts here, 0: none does
        for item_id, text in rows:
            own = [vocabulary[w] for w in words_of(text)]
            numbers += [*own, -1]
            self.ids += [item_id] * (len(own) + 1)
            self.position += range(len(own) + 1)
            length = min(window, len(own))
            self.wanted += [length if i + length <= len(own) else 0 for i in range(len(own))] + [0]
        self.vocabulary = list(vocabulary)
        self.numbers = np.array(numbers, np.int64)
        self.wanted = np.array(self.wanted, np.int64)

    def tokens(self, shard: Shard) -> np.ndarray:
        """The items in the shard's numbers; 0 for the end and for words it does not have."""
        known = {w: i + 1 for i, w in enumerate(shard.words)}
        own = np.array([*(known.get(w, 0) for w in self.vocabulary), 0], np.int32)
        return own[self.numbers]  # the last place is that of -1


@dataclass
class Found:
    """Per suffix of the items: words matched at most, and the ranges of the suffix array."""

    length: np.ndarray
    low: np.ndarray
    high: np.ndarray
    window_low: np.ndarray
    window_high: np.ndarray


def _bound(shard: Shard, low: np.ndarray, high: np.ndarray, ahead: int, word: np.ndarray, after: bool):
    """First place of [low, high) whose word ``ahead`` is at least ``word`` (``after``: above it)."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) >> 1
        own = shard.tokens[shard.order[middle] + ahead]
        before = own <= word[open_] if after else own < word[open_]
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]


def search(shard: Shard, items: Items) -> Found:
    """Every suffix of the items against the shard, by binary search a word at a time."""
    tokens = items.tokens(shard)
    n = len(tokens)
    found = Found(*(np.zeros(n, np.int64) for _ in range(5)))
    active = np.flatnonzero(tokens)
    low, high = np.zeros(len(active), np.int64), np.full(len(active), len(shard.order))
    ahead = 0
    while len(active):
        word = tokens[active + ahead]
        held = word > 0
        active, low, high, word = active[held], low[held], high[held], word[held]
        left = _bound(shard, low, high, ahead, word, False)
        right = _bound(shard, left, high, ahead, word, True)
        held = left < right
        active, low, high = active[held], left[held], right[held]
        ahead += 1
        found.length[active], found.low[active], found.high[active] = ahead, low, high
        whole = items.wanted[active] == ahead
        found.window_low[active[whole]], found.window_high[active[whole]] = low[whole], high[whole]
    return found


def _ranges(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(range, place) for each place of each range, some ranges at a time."""
    sizes = high - low
    cut = np.concatenate([[0], np.cumsum(sizes)])
    lo = 0
    while lo < len(low):
        hi = max(lo + 1, int(np.searchsorted(cut, cut[lo] + PLACES, "right")) - 1)
        own = np.repeat(np.arange(lo, hi), sizes[lo:hi])
        yield own, np.arange(cut[lo], cut[hi]) - cut[own] + low[own]
        lo = hi


def _hits(shard: Shard, items: Items) -> tuple[np.ndarray, list[set]]:
    """Whether each token is in an occurrence of a window, and the item ids of each piece."""
    found = search(shard, items)
    suffixes = np.flatnonzero(found.window_high > found.window_low)
    # one range for each text of a window; its items are looked up by it
    spans = np.stack([found.window_low[suffixes], found.window_high[suffixes], items.wanted[suffixes]], 1)
    spans, which = np.unique(spans.reshape(-1, 3), axis=0, return_inverse=True)
    owners: list[set] = [set() for _ in spans]
    for suffix, span in zip(suffixes.tolist(), which.ravel().tolist()):
        if items.ids[suffix] is not None:
            owners[span].add(items.ids[suffix])
    change = np.zeros(len(shard.tokens) + 1, np.int64)
    of_piece: list[set] = [set() for _ in shard.pieces]
    starts = shard.starts
    for span, place in _ranges(spans[:, 0], spans[:, 1]):
        at = shard.order[place].astype(np.int64)
        change += np.bincount(at, minlength=len(change))
        change -= np.bincount(at + spans[span, 2], minlength=len(change))
        piece = np.searchsorted(starts, at, "right") - 1
        for pair in np.unique(piece * len(spans) + span).tolist():
            of_piece[pair // len(spans)] |= owners[pair % len(spans)]
    return np.cumsum(change[:-1]) > 0, of_piece


HITS = pa.schema(
    [
        *PIECE,
        ("starts", pa.list_(pa.int64())),
        ("stops", pa.list_(pa.int64())),
        ("items", pa.list_(pa.int64())),
    ]
)
HITS_DDL = (
    "row long, doc_id long, mark long, first long, n_words long, starts array<long>, "
    "stops array<long>, items array<long>"
)


def _tell_hits(shard: Shard, items: Items) -> Iterator[pa.RecordBatch]:
    hit, of_piece = _hits(shard, items)
    change = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    starts = shard.starts
    cuts = np.append(np.searchsorted(begins, starts), len(begins))
    columns: list[list] = [[] for _ in HITS]
    for i, piece in enumerate(shard.pieces):
        own, shift = slice(cuts[i], cuts[i + 1]), piece[3] - starts[i]
        values = (*piece, begins[own] + shift, ends[own] + shift, sorted(of_piece[i]))
        for column, value in zip(columns, values):
            column.append(value)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, HITS)], schema=HITS)


MATCHES = pa.schema(
    [
        ("item_id", pa.int64()),
        ("position", pa.int64()),
        ("length", pa.int64()),
        ("locations", pa.int64()),
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
    ]
)
MATCHES_DDL = "item_id long, position long, length long, locations long, doc_id long, start long"


def _tell_matches(least: int, shard_words: int):
    def tell(shard: Shard, items: Items) -> Iterator[pa.RecordBatch]:
        found = search(shard, items)
        firsts = np.array([p[3] for p in shard.pieces], np.int64)
        no_id = np.array([p[1] is None for p in shard.pieces])
        doc_ids = np.array([p[1] or 0 for p in shard.pieces], np.int64)
        columns: list[list] = [[] for _ in MATCHES]
        for s in np.flatnonzero(found.length >= least).tolist():
            if items.ids[s] is None:
                continue
            at = shard.order[found.low[s] : found.high[s]].astype(np.int64)
            piece = np.searchsorted(shard.starts, at, "right") - 1
            place = at - shard.starts[piece]
            own = place < shard_words  # what pieces overlap in counts in the later one
            piece, start = piece[own], firsts[piece[own]] + place[own]
            if not len(piece):
                continue
            first = np.lexsort((start, doc_ids[piece], no_id[piece]))[0]
            doc_id = shard.pieces[piece[first]][1]
            values = (items.ids[s], items.position[s], found.length[s], len(piece), doc_id, start[first])
            for column, value in zip(columns, values):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, MATCHES)], schema=MATCHES
        )

    return tell


# ------------------------------------------------------------------ on Spark


def _marked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, mark): the mark tells texts of the same doc_id apart."""
    text = text_of(text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("mark")
    )


def suffix_arrays(docs: DataFrame, depth: int, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Shards of ``docs`` (doc_id, text, mark) as rows of ``INDEX_DDL``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy()
        for shard in _shards(batches, depth, shard_words):
            yield pa.RecordBatch.from_pylist([shard.to_row()], schema=INDEX)

    return docs.mapInArrow(run, INDEX_DDL)


def _searched(
    docs: DataFrame,
    benchmark: DataFrame,
    tell,
    ddl: str,
    window: int,
    shard_words: int,
    block_bytes: int,
    item_col: str,
    text_col: str,
) -> DataFrame:
    """What ``tell`` says of every shard and every block of the benchmark."""
    text = text_of(text_col)
    texts = benchmark.select(F.col(item_col).cast("long").alias("item_id"), text.alias("text"))
    size, longest = texts.agg(
        F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
        F.coalesce(F.max(F.regexp_count("text", F.lit(JVM_WORD))), F.lit(0)),
    ).first()
    depth, blocks = max(window, longest), max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def sent(number: int) -> Shared:
        # one block: about block_bytes, one text at least
        rows = texts.where(block == number).collect()
        return Shared(docs.sparkSession, Items([(r.item_id, r.text.encode()) for r in rows], window))

    if blocks == 1:
        items = sent(0)

        def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tidy()
            for shard in _shards(batches, depth, shard_words):
                yield from tell(shard, items.value)

        return docs.mapInArrow(both, ddl)

    def again(items: Shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tidy()
            for batch in batches:
                for row in range(batch.num_rows):
                    shard = Shard.from_row(batch.slice(row, 1).to_pylist()[0])
                    yield from tell(shard, items.value)

        return run

    index = materialize(suffix_arrays(docs, depth, shard_words), "suffix-arrays")
    found = [materialize(index.mapInArrow(again(sent(b)), ddl), "suffix-found") for b in range(blocks)]
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    """Joined in pairs, so that the plan stays flat."""
    while len(frames) > 1:
        frames = [
            a[0].unionByName(a[1]) if len(a) == 2 else a[0]
            for a in (frames[i : i + 2] for i in range(0, len(frames), 2))
        ]
    return frames[0]


def _merge_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of pieces and blocks, which may overlap, as those of the document."""
    for rows in batches:
        merged: list[list[int]] = []
        ends: list[list[int]] = []
        for starts, stops in zip(rows.column("starts").to_pylist(), rows.column("stops").to_pylist()):
            order = np.argsort(np.array(starts, np.int64), kind="stable")
            a, b = np.array(starts, np.int64)[order], np.array(stops, np.int64)[order]
            reach = np.maximum.accumulate(b) if len(b) else b
            new = np.ones(len(a), bool)
            new[1:] = a[1:] > reach[:-1]
            last = np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1) if len(a) else np.empty(0, int)
            merged.append(a[new].tolist())
            ends.append(reach[last].tolist())
        columns = [rows.column(c) for c in ("doc_id", "mark", "n_words")]
        hits = [sum(e) - sum(s) for s, e in zip(merged, ends)]
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (merged, ends)]
        yield pa.RecordBatch.from_arrays(
            [*columns, pa.array(hits, pa.int64()), *lists, rows.column("items")],
            ["doc_id", "mark", "n_words", "n_hit", "starts", "stops", "items"],
        )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, mark, n_words, n_hit, starts, stops, items), one row per row of ``docs``.

    ``starts`` and ``stops`` are the spans of words hit, from 0, stop excluded, apart from one
    another and in order; ``items`` the sorted ids of the items with occurring windows; ``mark``
    is xxhash64 of the text.  Items that share an id are one item; windows of an item without id
    hit words and are listed nowhere.  Null and empty texts have no words; an item without words
    has no window, one with fewer than ``window`` is one window.  Other columns are ignored.
    """
    found = _searched(
        _marked(docs, id_col, text_col), benchmark, _tell_hits, HITS_DDL,
        window, shard_words, block_bytes, item_col, text_col,
    )
    own = found.groupBy("row").agg(
        F.min("doc_id").alias("doc_id"),
        F.min("mark").alias("mark"),
        F.max("n_words").alias("n_words"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "stops")),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return own.drop("row").mapInArrow(
        _merge_spans,
        "doc_id long, mark long, n_words long, n_hit long, starts array<long>, stops array<long>, items array<long>",
    )


def remove_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings
) -> DataFrame:
    """``docs`` without the rows that hold a window of the benchmark."""
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **settings)
    gone = (
        found.where("n_hit > 0")
        .select(F.col("doc_id").alias("__leak_id"), F.col("mark").alias("__leak_mark"))
        .distinct()
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col("__leak_id")) & (
        F.xxhash64(text_of(text_col)) == F.col("__leak_mark")
    )
    return docs.join(gone, same, "left_anti")


def longest_matches(
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(item_id, position, length, locations, doc_id, start) for suffixes that match ``least`` words.

    For the suffix of an item that begins at word ``position``: the words of its longest
    verbatim match in any document, at how many places it occurs, and the first of them, by
    doc_id (null last) and word.  Of the same suffix place in texts that share an id, the longer
    match counts; items without id are left out.
    """
    found = _searched(
        _marked(docs, id_col, text_col), benchmark, _tell_matches(least, shard_words), MATCHES_DDL,
        least, shard_words, block_bytes, item_col, text_col,
    )
    longest = found.groupBy("item_id", "position", "length").agg(
        F.sum("locations").alias("locations"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "start")).alias("at"),
    )
    best = longest.groupBy("item_id", "position").agg(
        F.max_by(F.struct("length", "locations", "at"), "length").alias("best")
    )
    return best.select(
        "item_id", "position", "best.length", "best.locations", "best.at.doc_id", "best.at.start"
    )

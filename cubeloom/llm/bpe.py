"""Byte-pair encoding with word ends by a distinct-word table, and decoding by id.

Texts are split into words in scan tasks; every distinct word is encoded once, in the task of
its hash bucket; ids are joined back by position (see :mod:`cubeloom.llm.chunks`).  Decoding
looks every id up in the id-to-piece table.  That table is as large as the vocabulary file,
whatever the corpus, so the join with it is a lookup in a broadcast array; for id tables of any
origin, :func:`decode` makes the same join as a DataFrame.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeloom.llm.chunks import (
    documents_of,
    pack_ints,
    packets_of,
    unpack_ints,
    unpack_words,
    word_order,
    write_chunks,
)
from cubeloom.llm.common import Shared, keyed_texts, tidy

# Fixed values of the tokenizer format: what splits a text before the merges, for texts below
# U+0250 with the letters and numbers of that range spelt out, which a plain regex finds faster.
SPACE = r"\t-\r \x85\xa0  -     　"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
ANY_WORD = regex.compile(rf"{ENDINGS}|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
LETTER = r"a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
NEAR_WORD = re.compile(rf"{ENDINGS}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
FAR = re.compile(r"[^\x00-ɏ]")
WORD_END = "</w>"


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself if printable, else from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for byte in range(256):
        if byte in printable:
            letters.append(chr(byte))
        else:
            letters.append(chr(spare))
            spare += 1
    return letters


@dataclass(frozen=True)
class WordBpe:
    """A vocabulary file of the kind ``word_bpe_49k.json``."""

    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]

    @classmethod
    def from_file(cls, path: str) -> WordBpe:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in data["model"]["merges"]]
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        return cls(data["model"]["vocab"], {m: i for i, m in enumerate(merges)}, special)

    def pieces(self) -> list[str]:
        """The piece of each id."""
        both = self.ids | self.special
        out = [""] * (max(both.values()) + 1)
        for piece, number in both.items():
            out[number] = piece
        return out

    def splitter(self):
        """bytes -> words; a special token is a word of its own, with its case kept."""
        special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        marks = [s.encode() for s in self.special]

        def plain(text: str) -> list[bytes]:
            if not text.isascii():
                text = unicodedata.normalize("NFC", text)
            # no final sigma: letters are lowered one by one
            text = text.replace("Σ", "σ").lower()
            words = (ANY_WORD if FAR.search(text) else NEAR_WORD).findall(text)
            return "\n".join(words).encode().split(b"\n") if words else []

        def split(data: bytes) -> list[bytes]:
            text = data.decode("utf-8", "replace")
            if not any(m in data for m in marks):
                return plain(text)
            out: list[bytes] = []
            for i, part in enumerate(special.split(text)):
                # a special token starts with a control byte so that no plain word equals it
                out.extend([b"\x00" + part.encode()] if i % 2 else plain(part))
            return out

        return split

    def encode_word(self, word: bytes, letters: list[str]) -> list[int]:
        if word[:1] == b"\x00" and (mark := word[1:].decode()) in self.special:
            return [self.special[mark]]
        parts = [letters[b] for b in word]
        parts[-1] += WORD_END
        ranks, far = self.ranks, len(self.ranks)
        while len(parts) > 1:
            best, at = min(
                (ranks.get(pair, far), i) for i, pair in enumerate(zip(parts, parts[1:]))
            )
            if best == far:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts if p in self.ids]


def _encode_bucket(shared):
    """All packets of a bucket: each distinct word is encoded once."""
    schema = pa.schema(
        [("chunk", pa.int64()), ("numbers", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary())]
    )

    def run(packets):
        tidy()
        model: WordBpe = shared.value
        letters = byte_letters()
        known: dict[bytes, list[int]] = {}
        chunks, numbers, sizes, ids = [], [], [], []
        for chunk, n, own, words in zip(
            *(packets.column(c).to_pylist() for c in ("chunk", "n", "numbers", "words"))
        ):
            found = []
            for word in unpack_words(words, n):
                if (code := known.get(word)) is None:
                    code = known[word] = model.encode_word(word, letters)
                found.append(code)
            chunks.append(chunk)
            numbers.append(own)
            sizes.append(pack_ints(np.fromiter(map(len, found), np.uint32, n)))
            ids.append(pack_ints(np.array([i for code in found for i in code], np.uint32)))
        return pa.table([chunks, numbers, sizes, ids], schema=schema)

    return run


ENCODED = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())]
)
ENCODED_DDL = "doc_id long, n_tokens long, ids binary, decoded string"


def _join_chunk(shared, with_text: bool):
    """One chunk: ids of its documents by word number, and each id's piece."""

    def run(docs, packets):
        tidy()
        place = word_order(packets)
        sizes = [unpack_ints(d) for d in packets.column("sizes").to_pylist()]
        flat = [unpack_ints(d) for d in packets.column("ids").to_pylist()]
        sizes = np.concatenate(sizes).astype(np.int64) if sizes else np.empty(0, np.int64)
        flat = np.concatenate(flat) if flat else np.empty(0, np.uint32)
        starts = (np.cumsum(sizes) - sizes)[place]
        sizes = sizes[place]
        decoded: list[str] = []
        if with_text:
            pieces = shared.value
            decoded = [
                " ".join([pieces[i] for i in flat[s : s + n].tolist()])
                for s, n in zip(starts.tolist(), sizes.tolist())
            ]
        out: list[pa.RecordBatch] = []
        for doc_ids, lengths, numbers in zip(
            *(docs.column(c) for c in ("doc_ids", "lengths", "numbers"))
        ):
            words = unpack_ints(numbers.as_py())
            own = sizes[words]
            ends = np.cumsum(own)
            tokens = flat[
                np.repeat(starts[words] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)
            ].astype("<u4")
            word_ends = np.cumsum(lengths.as_py())
            token_ends = np.concatenate([[0], ends])[word_ends]
            token_starts = np.concatenate([[0], token_ends[:-1]])
            texts: list[str | None] = [None] * len(word_ends)
            if with_text:
                spelt = [decoded[i] for i in words.tolist()]
                at = 0
                for i, end in enumerate(word_ends.tolist()):
                    texts[i] = " ".join(spelt[at:end])
                    at = end
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids.as_py(), pa.int64()),
                        pa.array(token_ends - token_starts, pa.int64()),
                        pa.array(
                            [tokens[a:b].tobytes() for a, b in zip(token_starts, token_ends)],
                            pa.binary(),
                        ),
                        pa.array(texts, pa.string()),
                    ],
                    schema=ENCODED,
                )
            )
        return pa.Table.from_batches(out, ENCODED)

    return run


def encode(
    docs: DataFrame,
    model: WordBpe,
    id_col: str = "doc_id",
    text_col: str = "text",
    decoded: bool = True,
) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded), one row per row of ``docs``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``decoded`` is the pieces joined by
    blanks, as the library decodes without a decoder (null if not wanted).  No special tokens
    are added; their strings in a text are the special tokens.  A null or empty text has no
    ids.  Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    shared, pieces = Shared(spark, model), Shared(spark, model.pieces())
    chunks = write_chunks(keyed_texts(docs, id_col, text_col), model.splitter())
    words = (
        packets_of(chunks)
        .groupBy("bucket")
        .applyInArrow(
            _encode_bucket(shared), "chunk long, numbers binary, sizes binary, ids binary"
        )
    )
    return (
        documents_of(chunks)
        .groupBy("chunk")
        .cogroup(words.groupBy("chunk"))
        .applyInArrow(_join_chunk(pieces, decoded), ENCODED_DDL)
    )


def piece_table(spark, model: WordBpe) -> DataFrame:
    """(id, piece): one row per entry of the vocabulary file."""
    return spark.createDataFrame(list(enumerate(model.pieces())), "id int, piece string")


def decode(tokens: DataFrame, pieces: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded) from an array column of ids, by a join with the id-to-piece table.

    One row per row of ``tokens``; null or empty ids decode to the empty text.
    """
    rows = tokens.select(
        F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")
    ).withColumn("row", F.monotonically_increasing_id())
    each = rows.select("row", "doc_id", F.posexplode_outer("ids").alias("at", "id"))
    joined = each.join(F.broadcast(pieces), "id", "left").groupBy("row", "doc_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "piece")))).alias("p")
    )
    return joined.select(
        "doc_id", F.array_join(F.transform("p", lambda x: x["piece"]), " ").alias("decoded")
    )

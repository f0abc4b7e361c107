"""Token ids as Simple-8b words: files of packed ids, written in document order and decoded in bulk."""

from __future__ import annotations

import array
import functools
import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, compress, repeat
from operator import is_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.chunks import LONGEST_REMEMBERED, MOST_REMEMBERED, SLICE, pieces
from riskloom.llm.common import chunk_rank, stored

#: Fixed values of the file format: (ids, bits each) of every selector, the upper four bits of a word.
#: Selector 0 is the escape: its word names a place in the list of ids of more than 60 bits.
SELECTORS = (
    (1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
    (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
)
ESCAPE = 0
PAYLOAD = 60
BLOCK_IDS = 1024
SEGMENT_IDS = 65_536
END_ID = 0
#: A word of Latin letters behind a space and the signs behind it, which byte-level files take apart.
WORD_AND_SIGNS = re.compile(r"( [A-Za-zÀ-ÖØ-öø-ɏ]+)([^\s\w'’]+)")
PIECE_BEHIND_SPACE = re.compile(r"\s\S+")
#: Pieces encoded as one string.
JOINED = 2048
COUNTS = np.array([count for count, _ in SELECTORS], np.int64)
_WIDTHS = np.array([k.bit_length() for k in range(1 << 16)], np.uint8)


def bit_widths(ids: np.ndarray) -> np.ndarray:
    if not len(ids) or ids.max() < 1 << 16:
        return _WIDTHS[ids.astype(np.int64)]
    powers = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))
    return np.searchsorted(powers, ids, side="right").astype(np.uint8)


def choose(widths: np.ndarray, block: int) -> np.ndarray:
    """For every place the selector with the most ids that fit and stay within the block."""
    blocks, longest = -(-len(widths) // block), int(COUNTS.max())
    grid = np.full((blocks, block + longest), 255, np.uint8)
    flat = np.full(blocks * block, 255, np.uint8)
    flat[: len(widths)] = widths
    grid[:, :block] = flat.reshape(blocks, block)
    best = np.full((blocks, block), ESCAPE, np.uint8)
    widest = {1: grid}  # count -> widest of that many ids from each place
    for selector in sorted(range(1, len(SELECTORS)), key=lambda k: SELECTORS[k][0]):
        count, bits = SELECTORS[selector]
        have = max(widest)
        while have < count:
            step = min(have, count - have)
            # the widest of the next ``have`` ids from here and from ``step`` on
            following = widest[have][:, step:]
            wider = np.full_like(grid, 255)
            wider[:, : following.shape[1]] = np.maximum(widest[have][:, : following.shape[1]], following)
            have += step
            widest = {have: wider}
        fits = widest[count][:, :block] <= bits
        if not fits.any():
            break  # then no longer run of narrower ids fits either
        best[fits] = selector
    return best.reshape(-1)[: len(widths)]


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of every block, ids of more than 60 bits). Blocks of ``block`` ids start on a word."""
    ids = ids.astype(np.uint64)
    if not len(ids):
        return np.zeros(0, "<u8"), np.zeros(0, "<u4"), np.zeros(0, "<u8")
    chosen = choose(bit_widths(ids), block)
    steps, starts, at, end = COUNTS[chosen].tolist(), [], 0, len(ids)
    while at < end:
        starts.append(at)
        at += steps[at]
    firsts = np.array(starts, np.int64)
    selectors = chosen[firsts]
    words = selectors.astype(np.uint64) << np.uint64(PAYLOAD)
    escapes = np.zeros(0, np.uint64)
    for selector in np.unique(selectors):
        count, bits = SELECTORS[selector]
        rows = np.flatnonzero(selectors == selector)
        if selector == ESCAPE:
            escapes = ids[firsts[rows]]
            words[rows] |= np.arange(len(rows), dtype=np.uint64)
        elif bits:
            lanes = np.arange(count)
            values = ids[firsts[rows][:, None] + lanes] << (lanes * bits).astype(np.uint64)
            words[rows] |= np.bitwise_or.reduce(values, axis=1)
    offsets = np.searchsorted(firsts, np.arange(0, len(ids), block))
    return words.astype("<u8"), offsets.astype("<u4"), escapes.astype("<u8")


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """All ids of whole blocks of words, a selector at a time."""
    selectors = (words >> np.uint64(PAYLOAD)).astype(np.int64)
    ends = np.cumsum(COUNTS[selectors])
    firsts = ends - COUNTS[selectors]
    ids = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for selector in np.unique(selectors):
        count, bits = SELECTORS[selector]
        rows = np.flatnonzero(selectors == selector)
        if not bits:
            continue
        lanes, mask = np.arange(count), np.uint64((1 << bits) - 1)
        values = (words[rows][:, None] >> (lanes * bits).astype(np.uint64)) & mask
        if selector == ESCAPE:
            values = escapes[values.astype(np.int64)]
        ids[firsts[rows][:, None] + lanes] = values
    return ids


class LibraryEncoder:
    """Texts to ids with the tokenizers library, without added start or end tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.width, self.code = (2, "H") if size <= 1 << 16 else (4, "I")
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        # only the plain byte-level file is known to cut where the pieces are cut
        byte_level = (description.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        self.by_piece = byte_level and not description.get("normalizer") and not description["pre_tokenizer"]["add_prefix_space"]
        self.specials = tuple(token["content"] for token in description["added_tokens"])
        self.known: dict[str, bytes] = {}
        self.most = MOST_REMEMBERED
        self.lengths = np.zeros(size, np.int64)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=True).items():
            self.lengths[number] = len(token)  # a symbol of such a file is a byte

    def learn(self, pieces: set[str]) -> None:
        """Look up new pieces, at which a text may be cut, and remember their ids.

        A word and the signs behind it are pre-tokens of their own, so each is looked
        up alone. Pieces that start with white space are encoded as one string, as
        they would stand in a text; every token is as long as its bytes, which tells
        whose it is.
        """
        known = self.known
        halves = {piece: match.groups() for piece in pieces if (match := WORD_AND_SIGNS.fullmatch(piece))}
        wanted = pieces.difference(halves).union(*halves.values()).difference(known)
        joined = list(filter(PIECE_BEHIND_SPACE.fullmatch, wanted))
        every = "".join(joined)
        if any(special in every for special in self.specials):
            joined = [piece for piece in joined if not any(special in piece for special in self.specials)]
        alone = list(wanted.difference(joined))
        known.update(zip(alone, self.library(alone)))
        for start in range(0, len(joined), JOINED):
            some = joined[start : start + JOINED]
            known.update(zip(some, self.library_of_joined(some)))
        known.update((piece, known[word] + known[signs]) for piece, (word, signs) in halves.items())

    def by_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of the texts; what is new in about SLICE characters of text is looked up together."""
        done: list[bytes] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and size <= SLICE:
                size += len(texts[end])
                end += 1
            if len(self.known) > self.most:
                self.known = {}
            cut = [list(chain.from_iterable(pieces(text, self.specials))) for text in texts[start:end]]
            found = [list(map(self.known.get, parts)) for parts in cut]
            open_texts = [k for k, ids in enumerate(found) if None in ids]
            new: set[str] = set()
            for k in open_texts:
                new.update(compress(cut[k], map(is_, found[k], repeat(None))))
            if new:
                self.learn(new)
            for k in open_texts:
                found[k] = map(self.known.__getitem__, cut[k])
            done += map(b"".join, found)
            for piece in [piece for piece in new if len(piece) > LONGEST_REMEMBERED]:
                del self.known[piece]
            start = end
        return done

    def library_of_joined(self, pieces: list[str]) -> list[bytes]:
        ids = np.frombuffer(self.library(["".join(pieces)])[0], f"<u{self.width}")
        ends = np.cumsum([len(piece.encode()) for piece in pieces])
        upto = np.cumsum(self.lengths[ids])
        cuts = np.searchsorted(upto, ends) + 1
        if upto[-1] != ends[-1] or (upto[cuts - 1] != ends).any():
            return self.library(pieces)  # a token over the edge of a piece
        raw, at = ids.tobytes(), (cuts * self.width).tolist()
        return [raw[low:high] for low, high in zip([0, *at], at)]

    def library(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array.array(self.code, e.ids).tobytes() for e in encoded]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        raw = self.by_pieces(texts) if self.by_piece else self.library(texts)
        return [np.frombuffer(ids, f"<u{self.width}") for ids in raw]


@functools.lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


_SEGMENT = (
    "part long, segment long, n_ids long, doc_ids array<long>, lengths array<long>, "
    "words binary, block_offsets binary, escapes binary"
)


def segment_row(part: int, number: int, doc_ids: list[int | None], ids: list[np.ndarray]) -> dict:
    every = np.concatenate(ids)
    words, offsets, escapes = pack(every)
    return {
        "part": part, "segment": number, "n_ids": len(every), "doc_ids": doc_ids, "lengths": [len(x) for x in ids],
        "words": words.tobytes(), "block_offsets": offsets.tobytes(), "escapes": escapes.tobytes(),
    }


def segments(docs: DataFrame, path: str, rows_per_part: int = 2048, most_parts: int = 200_000) -> DataFrame:
    """Packed ids of every document in ascending doc_id order, each followed by END_ID.

    A segment is a row: whole documents of about SEGMENT_IDS ids, their ids and
    numbers of ids, the Simple-8b words, the word offset of every block of
    BLOCK_IDS ids, and the escaped ids. ``part`` and ``segment`` number the segments
    in document order. Null texts are empty, a null doc_id comes first, and
    documents that share an id follow the order of their text.
    """
    schema = _arrow_schema()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, number, held_ids, held, size, part = library_encoder(path), 0, [], [], 0, 0
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            part = batch.column(2)[0].as_py() if batch.num_rows else part
            rows = []
            for start in range(0, len(texts), 256):
                encoded = codec.encode([t or "" for t in texts[start : start + 256]])
                for doc_id, ids in zip(doc_ids[start : start + 256], encoded):
                    held_ids.append(doc_id)
                    held.append(np.append(ids, ids.dtype.type(END_ID)))
                    size += len(ids) + 1
                    if size >= SEGMENT_IDS:
                        rows.append(segment_row(part, number, held_ids, held))
                        number, held_ids, held, size = number + 1, [], [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        if held:
            yield pa.RecordBatch.from_pylist([segment_row(part, number, held_ids, held)], schema=schema)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = max(1, min(most_parts, -(-rows.count() // rows_per_part)))
    dealt = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return dealt.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(write, _SEGMENT)


def _arrow_schema() -> pa.Schema:
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), longs, longs, pa.binary(), pa.binary(), pa.binary()]
    names = [field.split()[0] for field in _SEGMENT.split(", ")]
    return pa.schema(list(zip(names, kinds)))


def documents_of(files: DataFrame) -> DataFrame:
    """(doc_id, part, segment, inner_start, n_tokens, ids_crc32) of every document, decoded from the packed words."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for part, segment, _, doc_ids, lengths, words, _, escapes in zip(*(c.to_pylist() for c in batch.columns)):
                ids = unpack(np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u8")).astype("<u4")
                ends = np.cumsum(np.array(lengths, np.int64)).tolist()
                for doc_id, length, end in zip(doc_ids, lengths, ends):
                    row = (doc_id, part, segment, end - length, length, zlib.crc32(ids[end - length : end]))
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in out],
                names=["doc_id", "part", "segment", "inner_start", "n_tokens", "ids_crc32"],
            )

    columns = [field.split()[0] for field in _SEGMENT.split(", ")]
    schema = "doc_id long, part long, segment long, inner_start long, n_tokens long, ids_crc32 long"
    return files.select(*columns).mapInArrow(read, schema)


def encoded_files(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every row of ``docs`` (doc_id, text), read back from the written files.

    ``start`` counts the ids of all documents before, each with its end id. The
    crc32 is that of the ids as little-endian unsigned 32-bit numbers. Other
    columns are not looked at; an empty table gives no rows.
    """
    files = stored(segments(docs, path), "token-files", compression="zstd")
    starts = chunk_rank(files.select("part", "segment", "n_ids"), [], "part", ["segment"], {"before": "n_ids"})
    found = documents_of(files).join(starts.drop("n_ids"), ["part", "segment"])
    return found.select("doc_id", (F.col("before") + F.col("inner_start")).alias("start"), "n_tokens", "ids_crc32")

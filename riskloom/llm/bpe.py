"""Byte-pair encoding and decoding over contiguous arrays of adjacent ranks."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm.chunks import Remembered

NO_RANK = np.int32(2**31 - 1)
#: Longest word that is merged by scanning its ranks; longer ones keep their ranks in a heap.
SHORT_WORD = 48
WORDS_AT_ONCE = 8192
#: The pre-token pattern with the letters, numbers and white space of Latin-1 spelled out; other text is cut by the library.
LETTERS, NUMBERS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾", " \\t\\n\\x0b\\x0c\\r\\x85\\xa0"
LATIN_WORDS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{BLANKS}{LETTERS}{NUMBERS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
LATIN = re.compile(r"[\x00-\xff]*")
ONE_WORD = re.compile(f" ?[{LETTERS}]+")


def byte_symbols() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """A byte-level BPE vocabulary file: merges by rank, bytes by id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            description = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        model = description["model"]
        self.symbols = byte_symbols()
        vocab: dict[str, int] = model["vocab"]
        self.specials = {token["content"]: token["id"] for token in description["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.pieces = [b""] * size
        for token, number in vocab.items():
            self.pieces[number] = bytes(self.symbols[c] for c in token)
        for token, number in self.specials.items():
            self.pieces[number] = token.encode()
        self.width = 2 if size <= 1 << 16 else 4
        self.type = np.dtype(f"<u{self.width}")
        self.byte_ids = np.zeros(256, np.int64)
        for symbol, byte in self.symbols.items():
            self.byte_ids[byte] = vocab[symbol]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.size = size
        keys = np.array([vocab[a] * size + vocab[b] for a, b in pairs], np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.rank_of = dict(zip(keys.tolist(), range(len(keys))))
        # ranks of pairs of bytes, which start every word
        first = self.byte_ids[:, None] * size + self.byte_ids[None, :]
        self.byte_ranks = self.find(first.ravel()).reshape(256, 256)
        self.cut_specials = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NO_RANK where there is no merge."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_RANK)

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        if LATIN.fullmatch(text):
            return LATIN_WORDS.findall(text)
        return [text[start:end] for _, (start, end) in self.library.pre_tokenizer.pre_tokenize_str(text)]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_block(block: np.ndarray, vocab: Vocabulary) -> list[tuple[np.ndarray, np.ndarray]]:
    """Merge words of one length, a row of bytes each; gives (rows, ids) blocks of finished words.

    A row holds the parts that are left, their ids, and beside each part the rank of
    merging it with the next. Every step scans each row for its smallest rank, the
    leftmost of equals, deletes that boundary, and looks up the two ranks beside
    it. All unfinished rows lose one part a step, so the arrays stay contiguous.
    """
    ids = vocab.byte_ids[block]
    ranks = np.full(ids.shape, NO_RANK, np.int32)
    if ids.shape[1] > 1:
        ranks[:, :-1] = vocab.byte_ranks[block[:, :-1], block[:, 1:]]
    rows, done = np.arange(len(block)), []
    while len(rows):
        at = ranks.argmin(axis=1)
        line = np.arange(len(rows))
        least = ranks[line, at]
        open_ = least != NO_RANK
        if not open_.all():
            done.append((rows[~open_], ids[~open_]))
            rows, ids, ranks, at, least = rows[open_], ids[open_], ranks[open_], at[open_], least[open_]
            line = np.arange(len(rows))
            if not len(rows):
                break
        ids[line, at] = vocab.merged[least]
        width = ids.shape[1] - 1
        behind = np.arange(width, dtype=np.int32) > at[:, None]  # these parts move up over the one that is gone
        ids, ranks = np.where(behind, ids[:, 1:], ids[:, :-1]), np.where(behind, ranks[:, 1:], ranks[:, :-1])
        right = at < width - 1
        ranks[line, at] = NO_RANK
        ranks[line[right], at[right]] = vocab.find(ids[line[right], at[right]] * vocab.size + ids[line[right], at[right] + 1])
        left = at > 0
        ranks[line[left], at[left] - 1] = vocab.find(ids[line[left], at[left] - 1] * vocab.size + ids[line[left], at[left]])
    return done


def merge_long(word: bytes, vocab: Vocabulary) -> list[int]:
    """Merge one long word; candidate boundaries wait in a heap by rank and place."""
    ids = vocab.byte_ids[np.frombuffer(word, np.uint8)].tolist()
    n = len(ids)
    following, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks, size, merged = vocab.rank_of, vocab.size, vocab.merged
    heap = []
    for i in range(n - 1):
        rank = ranks.get(ids[i] * size + ids[i + 1])
        if rank is not None:
            heap.append((rank, i, ids[i], ids[i + 1]))
    heapq.heapify(heap)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = following[i]
        if ids[i] != a or j >= n or ids[j] != b:
            continue  # one of its parts is gone
        ids[i], ids[j] = int(merged[rank]), -1
        k = following[i] = following[j]
        if k < n:
            before[k] = i
            rank = ranks.get(ids[i] * size + ids[k])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[k]))
        h = before[i]
        if h >= 0:
            rank = ranks.get(ids[h] * size + ids[i])
            if rank is not None:
                heapq.heappush(heap, (rank, h, ids[h], ids[i]))
    return [x for x in ids if x >= 0]


def merge_words(words: set[str], vocab: Vocabulary) -> dict[str, bytes]:
    """Ids of distinct words, as bytes."""
    by_length: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
    found: dict[str, bytes] = {}
    for word in words:
        raw = word.encode()
        if len(raw) > SHORT_WORD:
            found[word] = np.array(merge_long(raw, vocab), vocab.type).tobytes()
        else:
            by_length[len(raw)].append((word, raw))
    for length, group in by_length.items():
        for start in range(0, len(group), WORDS_AT_ONCE):
            names, raws = zip(*group[start : start + WORDS_AT_ONCE])
            block = np.frombuffer(b"".join(raws), np.uint8).reshape(len(raws), length)
            for rows, ids in merge_block(block, vocab):
                joined, step = ids.astype(vocab.type).tobytes(), ids.shape[1] * vocab.width
                for k, row in enumerate(rows.tolist()):
                    found[names[row]] = joined[k * step : (k + 1) * step]
    return found


class Encoder:
    """Texts to ids and back for one vocabulary."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.memory = Remembered(self.encode_pieces, tuple(self.vocab.specials))

    def encode_pieces(self, texts: list[str]) -> list[bytes]:
        """Ids of texts; special tokens in them become their own id."""
        plans = [[text] if ONE_WORD.fullmatch(text) else self.plan(text) for text in texts]
        found = merge_words({word for plan in plans for word in plan if isinstance(word, str)}, self.vocab)
        for number in self.vocab.specials.values():
            found[number] = np.array([number], self.vocab.type).tobytes()
        return [b"".join(map(found.__getitem__, plan)) for plan in plans]

    def plan(self, text: str) -> list[str | int]:
        """Words and ids of special tokens, in order."""
        vocab, found, start = self.vocab, [], 0
        if any(special in text for special in vocab.specials):
            for match in vocab.cut_specials.finditer(text):
                found += vocab.words(text[start : match.start()])
                found.append(vocab.specials[match.group()])
                start = match.end()
        return found + vocab.words(text[start:]) if start else vocab.words(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(raw, self.vocab.type) for raw in self.memory.texts(texts)]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of the ids; bytes that are no UTF-8 become replacement characters."""
        raw = b"".join(map(self.vocab.pieces.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "replace").encode()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a Python worker, so that what it remembers serves all its tasks."""
    return Encoder(path)


def encoded_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs`` (doc_id, text).

    ``path`` is a byte-level BPE file that all workers can read. Ids are those of
    the library that defines the file, without added start or end tokens; they
    are hashed as little-endian unsigned 32-bit numbers, and decoded again. A null
    or empty text has no ids. Texts are read whole; repeated rows get a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(path)
        for batch in batches:
            texts = [text or "" for text in batch.column(1).to_pylist()]
            counts, hashes, decoded = [], [], []
            for start in range(0, len(texts), 256):
                for ids in codec.encode(texts[start : start + 256]):
                    counts.append(len(ids))
                    hashes.append(hashlib.sha256(ids.astype("<u4")).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

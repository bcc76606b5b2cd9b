"""BPE encoding and decoding with content-defined chunks that are encoded once."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CACHED_WORDS = 600_000
CACHED_BYTES = 32 << 20
LONG_WORD = 100
WHITE = b" \t\n\v\f\r"
# Rolling hash over four bytes; one in 2**CUT_BITS positions is a cut.
WEIGHTS = (0x9E37, 0x85EB, 0xC2B3, 0x27D5)
CUT_BITS = 8

# Words of printable ASCII and Latin-1 letters. Lower-casing and the split into pieces are the same here
# as in the tokenizer's normalizer and pre-tokenizer; all other words go through the whole tokenizer.
PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*")
LETTERS = "a-z\xdf-\xf6\xf8-\xff"
# The pieces of the word_bpe tokenizer's pattern.
PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[0-9]|[^\\s{LETTERS}0-9]+")
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions behind which a rolling hash of the last bytes asks for a cut."""
    mixed = data * np.uint16(WEIGHTS[0])
    for back, weight in enumerate(WEIGHTS[1:], 1):
        mixed[back:] += data[:-back] * np.uint16(weight)
    return np.flatnonzero(mixed >> np.uint16(16 - CUT_BITS) == 0)


def chunks(text: bytes) -> list[bytes]:
    """The text cut where the rolling hash says, so that a passage yields the same chunks wherever it stands."""
    joins = (cuts(np.frombuffer(text, np.uint8).astype(np.uint16)) + 1).tolist()
    if joins and joins[-1] == len(text):
        joins.pop()
    return [text[start:end] for start, end in zip([0, *joins], [*joins, len(text)])]


def bounded(chunk: bytes) -> tuple[bytes, list[bytes], bytes]:
    """What stands before a chunk's first white space, its words between white space, and what stands behind the last.

    A chunk without white space is all first part.
    """
    words = chunk.split()
    head, tail = chunk[0] not in WHITE, chunk[-1] not in WHITE
    if head and tail and len(words) == 1:
        return chunk, [], b""
    return words[0] if head else b"", words[head:len(words) - tail], words[-1] if tail else b""


class ChunkEncoder:
    """Encodes whole texts, each chunk and each word once while the bounded memory holds it.

    A chunk's ids are those of its words between white space. A word that reaches over a join
    is in no chunk as a whole; the join is repaired by encoding it again among its
    neighbours, see ``_repaired``. For tokenizers whose tokens do not reach over ASCII white
    space and that drop it, and that add no token for the text as a whole.
    """

    def __init__(self, path: str, cached_words: int = CACHED_WORDS, cached_bytes: int = CACHED_BYTES):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        whole, *parts = (self.tokenizer.encode(text, add_special_tokens=False).ids for text in ("a b", "a", "b"))
        if whole != sum(parts, []):
            raise ValueError("tokens of this tokenizer reach over white space")
        self.cached_words, self.cached_bytes = cached_words, cached_bytes
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, tuple[bytes, bytes, bytes, bool]] = {}
        self.chunk_bytes = 0
        self.letters = byte_letters()
        self.model = self.tokenizer.model
        described = self.tokenizer.to_str()
        self.fast = WORD_PATTERN.replace("\\", "\\\\") in described and '"Lowercase"' in described
        self.joins_by_space = self.tokenizer.decoder is None
        size = 1 + max(self.tokenizer.get_vocab(with_added_tokens=True).values())
        self.tokens = [(self.tokenizer.id_to_token(i) or "").encode() for i in range(size)]
        self.decimals = [b"%d" % i for i in range(size)]

    def _word(self, word: bytes) -> bytes:
        """Ids of a word that is not known, as bytes."""
        text = word.decode()
        if self.fast and "<|" not in text and (text.isascii() and text.isprintable() or PLAIN.fullmatch(text)):
            text = text.lower()
            pieces = [text] if text.isalpha() else PIECES.findall(text)
            if not text.isascii():
                pieces = [piece.encode().decode("latin-1").translate(self.letters) for piece in pieces]
            ids = [token.id for piece in pieces for token in self.model.tokenize(piece)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        found = pack(f"<{len(ids)}I", *ids)
        if len(word) <= LONG_WORD:
            if len(self.words) >= self.cached_words:
                self.words.clear()
            self.words[word] = found
        return found

    def _words(self, words: list[bytes]) -> bytes:
        known, learn = self.words.get, self._word
        return b"".join([known(word) or learn(word) for word in words])

    def _whole(self, text: bytes) -> bytes:
        """What the tokenizer gives for all of the text."""
        ids = self.tokenizer.encode(text.decode(), add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def _repaired(self, word: bytes, before: list[bytes], after: list[bytes]) -> bytes | None:
        """Ids of a word over a join, encoded again with whole words of the chunks on both sides.

        The tokenizer's ids of that window must begin with what the left chunk has for its
        words and end with what the right one has; else the window takes in a word
        more on each side. None if they do not even agree over both chunks.
        """
        for reach in range(1, max(len(before), len(after), 1) + 1):
            left, right = before[-reach:], after[:reach]
            window = self._whole(b" ".join([*left, word, *right]))
            head, tail = self._words(left), self._words(right)
            if len(head) + len(tail) <= len(window) and window.startswith(head) and window.endswith(tail):
                found = window[len(head):len(window) - len(tail)]
                if len(word) <= LONG_WORD and len(self.words) < self.cached_words:
                    self.words[word] = found
                return found
        return None

    def _chunk(self, chunk: bytes) -> tuple[bytes, bytes, bytes, bool]:
        """A chunk's first part, the ids of its words, its last part, and whether it holds white space."""
        head, words, tail = bounded(chunk)
        found = head, self._words(words), tail, len(head) < len(chunk)
        if len(chunk) < self.cached_bytes // 16:
            self.chunk_bytes += 2 * len(chunk) + len(found[1])
            if self.chunk_bytes > self.cached_bytes:
                self.chunks.clear()
                self.chunk_bytes = 2 * len(chunk) + len(found[1])
            self.chunks[chunk] = found
        return found

    def id_bytes(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        whole = text.encode()
        known, learn, word_ids = self.chunks.get, self._chunk, self.words.get
        found: list[bytes] = []
        parts: list[bytes] = []
        opened = b""
        for chunk in [*chunks(whole), b"\n"]:
            head, inner, tail, white = known(chunk) or learn(chunk)
            if not white:
                opened = opened if parts else b""
                parts.append(chunk)
                continue
            if head:
                parts.append(head)
            if parts:
                word = b"".join(parts)
                ids = word_ids(word)
                if not ids and len(parts) == 1:
                    ids = self._word(word)
                elif not ids:
                    ids = self._repaired(word, bounded(opened)[1] if opened else [], bounded(chunk)[1])
                    if ids is None:
                        return self._whole(whole)
                found.append(ids)
            found.append(inner)
            parts, opened = [tail] if tail else [], chunk
        return b"".join(found)

    def ids(self, text: str | None) -> list[int]:
        return np.frombuffer(self.id_bytes(text), "<u4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        """What the tokenizer's decode gives, special tokens kept."""
        if self.joins_by_space:
            return b" ".join([self.tokens[i] for i in ids])
        return self.tokenizer.decode(ids, skip_special_tokens=False).encode()

    def written(self, ids: list[int]) -> bytes:
        """The ids in decimal, joined by a space."""
        return b" ".join([self.decimals[i] for i in ids])


_encoders: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python worker, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids, decoded): every whole text encoded, and its ids decoded again.

    Null and empty texts have no ids and decode to the empty text. Rows repeated under one id
    keep a row each; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = coder.ids(batch.column("text")[row].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(row, 1), pa.array([ids], pa.list_(pa.int32())),
                     pa.array([coder.decode(ids).decode()])], [id_col, "ids", "decoded"])

    return _rows(docs, id_col, text_col).mapInArrow(work, f"`{id_col}` long, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What ``encoded`` gives, as n_tokens, ids_sha256 and decoded_sha256 without moving the ids to the JVM."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            counts, ids, texts = [], [], []
            for text in batch.column("text"):
                found = coder.ids(text.as_py())
                counts.append(len(found))
                ids.append(hashlib.sha256(coder.written(found)).hexdigest())
                texts.append(hashlib.sha256(coder.decode(found)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(counts, pa.int64()),
                                              pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                                             [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return _rows(docs, id_col, text_col) \
        .mapInArrow(work, f"`{id_col}` long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

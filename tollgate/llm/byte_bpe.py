r"""Byte-level BPE encoding and decoding through a sentencepiece model.

The model is serialised straight from a rank file: every vocabulary entry becomes a piece
in which each byte is one printable character, scored by its negative rank, so that
sentencepiece's merges (highest score first, then leftmost) are those of the ranks
(lowest first). Normalisation is the identity: no prefix, no white space handling. A text is
cut into pre-tokens by the tokenizer's pattern and each pre-token is encoded on its own;
decoding maps the pieces back to bytes.

Defined results: null and empty texts have no ids; any other text, of any length, decodes
to its own UTF-8 bytes. Special tokens do not exist: their names are ordinary text.
Repeated rows keep their own rows. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tollgate.llm.common import small_batches, text_of, tidy
from tollgate.llm.words import chunks

MAX_CACHED = 100_000  # pre-tokens whose ids a task remembers: about 20 MB
PIECE_ROWS = 256
MAX_CACHED_CHARS = 40


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank from a rank file (base64 token, blank, rank per line)."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranks[i] for i in range(len(ranks))]


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable
    Latin-1, else the next code point from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(256) if b not in shown)
    stand_in = {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [stand_in.get(b, chr(b)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: bytes | int | float | bool) -> bytes:
    """One protocol buffer field: bytes, 32-bit float, or integer."""
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(int(value) & (1 << 64) - 1)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised sentencepiece model whose piece i + 1 is token i (piece 0: unknown)."""
    shown = byte_characters()
    unknown, bpe = 2, 2  # fixed values: the piece type and the model type of the format
    pieces = [_field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, unknown))]
    for rank, token in enumerate(tokens):
        mapped = "".join(shown[b] for b in token).encode()
        pieces.append(_field(1, _field(1, mapped) + _field(2, float(-rank))))
    # fixed values: field numbers of the trainer and normaliser settings
    trainer = (_field(3, bpe) + _field(4, len(tokens) + 1) + _field(24, False) + _field(40, 0)
               + _field(41, -1) + _field(42, -1) + _field(43, -1))
    normaliser = _field(1, b"identity") + _field(3, False) + _field(4, False) + _field(5, False)
    return b"".join(pieces) + _field(2, trainer) + _field(3, normaliser)


class ByteBpe:
    """Encoder and decoder over one vocabulary; `encode` of a text is a list of ids."""

    def __init__(self, tokens: list[bytes], pattern: str, model: bytes | None = None) -> None:
        import regex
        import sentencepiece

        self.tokens = tokens
        self.find = regex.compile(pattern).findall
        self.shown = byte_characters()
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model or sentencepiece_model(tokens))
        self.cache: dict[str, list[int]] = {}

    def _learn(self, new: list[str]) -> dict[str, list[int]]:
        shown = self.shown
        mapped = ["".join([shown[b] for b in t.encode()]) for t in new]
        return {t: [i - 1 for i in ids] for t, ids in zip(new, self.model.encode(mapped, num_threads=1))}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; its pre-tokens not met before go to the model in one call."""
        cut = [self.find(t) for t in texts]
        cache = self.cache
        new = self._learn(list({w for words in cut for w in words if w not in cache}))
        out = []
        for words in cut:
            ids: list[int] = []
            for w in words:
                ids += cache.get(w) or new[w]
            out.append(ids)
        if len(cache) + len(new) > MAX_CACHED:
            cache.clear()
        cache.update((w, ids) for w, ids in new.items() if len(w) <= MAX_CACHED_CHARS)
        if len(cache) > MAX_CACHED:
            cache.clear()
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def _codec_maker(spark: SparkSession, path: str, pattern: str):
    """A function that makes the codec in a task; vocabulary and model are read and
    serialised once, on the driver, and broadcast (a few MB, whatever the data)."""
    small_batches(spark)
    tokens = read_ranks(path)
    sent = spark.sparkContext.broadcast((tokens, sentencepiece_model(tokens)))

    def make() -> ByteBpe:
        return ByteBpe(sent.value[0], pattern, sent.value[1])

    return make


def _parts(batch: pa.RecordBatch, most_chars: int = 1_000_000) -> Iterator[tuple[int, list[str]]]:
    """(place, texts) of pieces of the batch; its last column has the texts."""
    column = batch.column(batch.num_columns - 1)
    for at in range(0, len(column), PIECE_ROWS):
        texts = column.slice(at, PIECE_ROWS).to_pylist()
        for a, b in chunks(texts, most_chars):
            yield at + a, texts[a:b]


def _kinds(df: DataFrame, columns: list[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)


def encode(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The `keep` columns, `ids` (array<int>), `n_tokens`, and `exact`: the ids decode to the text."""
    make, keep = _codec_maker(docs.sparkSession, path, pattern), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch in batches:
            for at, part in _parts(batch):
                ids = codec.encode(part)
                exact = [codec.decode(x) == t.encode() for x, t in zip(ids, part)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(at, len(part)) for i in range(len(keep))), pa.array(ids, pa.list_(pa.int32())),
                     pa.array(list(map(len, ids)), pa.int64()), pa.array(exact, pa.bool_())],
                    names=[*keep, "ids", "n_tokens", "exact"])

    return docs.select(*keep, text_of(text_col).alias("_text")).mapInArrow(
        tidy(run), f"{_kinds(docs, keep)}ids array<int>, n_tokens bigint, exact boolean")


def decode(encoded: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns and `decoded` (binary) of each row of `ids` (null: empty)."""
    make, keep = _codec_maker(encoded.sparkSession, path, pattern), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        for batch in batches:
            out = pa.array([codec.decode(ids or []) for ids in batch.column(len(keep)).to_pylist()], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], out], names=[*keep, "decoded"])

    return encoded.select(*keep, "ids").mapInArrow(tidy(run), f"{_kinds(encoded, keep)}decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The `keep` columns, n_tokens, ids_sha256, decoded_sha256 and `exact` (the decoded
    bytes are the text's): encode, then decode the ids, without moving the ids out of
    the task."""
    make, keep = _codec_maker(docs.sparkSession, path, pattern), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = make()
        names = [str(i) for i in range(len(codec.tokens))]
        for batch in batches:
            rows: list[tuple] = []
            for _, part in _parts(batch):
                for text, ids in zip(part, codec.encode(part)):
                    back = codec.decode(ids)
                    rows.append((len(ids), hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                                 hashlib.sha256(back).hexdigest(), back == text.encode()))
            found = [pa.array([r[i] for r in rows], type=t) for i, t in enumerate((pa.int64(), pa.string(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found], names=[
                *keep, "n_tokens", "ids_sha256", "decoded_sha256", "exact"])

    return docs.select(*keep, text_of(text_col).alias("_text")).mapInArrow(
        tidy(run), f"{_kinds(docs, keep)}n_tokens bigint, ids_sha256 string, decoded_sha256 string, exact boolean")

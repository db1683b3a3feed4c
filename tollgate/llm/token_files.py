r"""Token ids of documents as Parquet lists, in the order of their ids.

`write_tokens` sorts the documents by id over range partitions (one file each), encodes
them with a `tokenizers` vocabulary, ends each with an id and writes a row per document:
`doc_id`, `ids` (list of integers, dictionary coded), `n_tokens` and `at` (ids before it in its file),
both delta coded, and the file's number `part`. Row groups have a bounded size and pages a bounded size and
row count; the writer adds column and offset indexes, so a reader that wants a few
documents or only the lengths touches those pages alone. `manifest` has the first
global position of every file: one row a file, from the lengths only, without reading the ids.
`read_tokens` joins it on and gives every document's global `start`.

How a text is encoded: the vocabulary's normaliser and splitter never join or change anything
across an ASCII blank, so a text's ids are those of its pieces between blanks, one after another. Pieces met before
come from a bounded cache. That holds for vocabularies with the rules below; others are encoded text by text.

Defined results: a null or empty text has only the end id. Rows are ordered by id (nulls
first), rows of one id by the hash of their text; rows that share both are interchangeable
and are dealt over the files by a row number, so one id may hold any share of the rows. An empty
table gives no rows. Other columns are not read. Special tokens spelt out in a text are
taken as the library takes them: as one id, unless `plain_specials` is set.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate, islice
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tollgate.llm.byte_bpe import byte_characters
from tollgate.llm.common import text_of, tidy
from tollgate.plans.materialize import checkpoint_dir

END_ID = 2
MAX_CACHED = 700_000
MAX_CACHED_CHARS = 48
# plain letters: up to U+024F, but for U+0130, the library lower-cases like Python, letter by letter, and has
# nothing to compose; the splitter knows them from signs (the apostrophe starts contractions)
PLAIN = "A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f\\u0131-\\u024f"
PLAIN_SIGNS = "!-&(-/:-@[-`{-~"
LETTERS = re.compile(f"^[{PLAIN}]+$", re.MULTILINE)
MIXED = re.compile(f"^[{PLAIN}{PLAIN_SIGNS}]+$", re.MULTILINE)
RUN = re.compile(f"[^{PLAIN_SIGNS}]+|[{PLAIN_SIGNS}]+")
WITHIN_PIECES = re.compile("[.,;:!?\\s]")
# a sign after a letter or digit and before a blank or the end is a word of its own to the splitter (lower-cased,
# U+0130 ends with a mark, which the splitter takes together with the sign)
SIGN_AFTER_WORD = "([0-9A-Za-z\\x{c0}-\\x{d6}\\x{d8}-\\x{f6}\\x{f8}-\\x{12f}\\x{131}-\\x{24f}])([.,;:!?])( |$)"
LETTERS_AT_ONCE = 500  # words in one call of the library's model
BATCH_BYTES = 4_000_000  # of text in one batch of rows that a task hands on

# The rules of a vocabulary (as its file spells them) that never join anything across
# a blank and take a run of letters as one word.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}

# How the files are laid out (Parquet writer settings).
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",  # integers without a dictionary are delta coded
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
    "parquet.enable.dictionary#at": "false",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


class PieceEncoder:
    """Ids of texts as little-endian 32-bit bytes, by a cache of pieces between blanks.

    A new piece that is one run of plain letters, with or without signs after it, needs no
    normaliser or splitter: its lower-cased letters go to the library's BPE model directly, many in one call. Other
    pieces take the library's whole way. A vocabulary of other rules takes it for whole texts.
    """

    def __init__(self, vocabulary: str, plain_specials: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer, pre_tokenizers

        rules = json.loads(vocabulary)
        self.model = Tokenizer.from_str(vocabulary)
        if plain_specials:
            self.model.encode_special_tokens = True
        self.added = [t["content"].lower() for t in rules["added_tokens"]]
        # an added token must not reach over a cut between pieces, nor stand within plain letters
        apart = all(not WITHIN_PIECES.search(t) and not LETTERS.search(t) for t in self.added)
        self.by_piece = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == SPLITTER and apart
        self.letters = Tokenizer(self.model.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        suffix = rules["model"].get("end_of_word_suffix") or ""
        self.ends = np.zeros(1 + max(rules["model"]["vocab"].values()), dtype=bool)
        self.ends[[i for t, i in rules["model"]["vocab"].items() if suffix and t.endswith(suffix)]] = True
        # the character of each byte, for `codecs`; blanks stay between words
        self.shown = "".join(" " if b == 0x20 else c for b, c in enumerate(byte_characters()))
        self.cache: dict[str, bytes] = {"": b""}
        self.signs: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case letters: in one text; a word's last token, and no other, has
        the mark of a word's end."""
        out: list[bytes] = []
        for at in range(0, len(words), LETTERS_AT_ONCE):
            part = words[at:at + LETTERS_AT_ONCE]
            text = codecs.charmap_decode(" ".join(part).encode(), "strict", self.shown)[0]
            found = self.letters.encode_batch_fast([text], add_special_tokens=False)[0]
            ids = np.array(found.ids, dtype="<u4")
            ends = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(ends) != len(part):
                out += self._whole(part)
                continue
            raw = ids.tobytes()
            out += [raw[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """Ids of different pieces without line ends."""
        cache, signs, joined = self.cache, self.signs, "\n".join(new)
        # most are letters alone: lower-cased one to one
        letters = LETTERS.findall(joined)
        cores = "\n".join(letters).lower().split("\n")
        # letters and signs: runs of either, as the splitter takes them
        rest = sorted(set(new).difference(letters))
        mixed = [w for w in MIXED.findall("\n".join(rest)) if not any(t in w.lower() for t in self.added)]
        runs = [RUN.findall(w) for w in "\n".join(mixed).lower().split("\n")]
        parts = set().union(*runs)
        unseen = [r for r in parts if not r.isalpha() and r not in signs]
        signs.update(zip(unseen, self._whole(unseen)))
        known = [c for c in dict.fromkeys([*cores, *filter(str.isalpha, parts)]) if c not in cache]
        ids = dict(zip(known, self._letters(known)))
        out = {w: ids[c] if c in ids else cache[c] for w, c in zip(letters, cores)}
        held = {r: ids[r] if r in ids else cache[r] if r.isalpha() else signs[r] for r in parts}
        out.update((w, b"".join([held[r] for r in own])) for w, own in zip(mixed, runs))
        other = [w for w in rest if w not in out]
        out.update(zip(other, self._whole(other)))
        if len(signs) > 10_000:
            signs.clear()
        return out

    def _pieces(self, words: list[str]) -> list[bytes]:
        """Ids of different pieces."""
        cache = self.cache
        out = [cache.get(w) for w in words]
        new = [w for w, ids in zip(words, out) if ids is None]
        if new:
            learned = self._learn(new)
            cache.update(learned)
            out = [learned[w] if ids is None else ids for w, ids in zip(words, out)]
        for w in new:
            if len(w) > MAX_CACHED_CHARS:
                del cache[w]
        if len(cache) > MAX_CACHED:  # pieces met first are the frequent ones
            self.cache = dict(islice(cache.items(), MAX_CACHED // 2))
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and how many each has. Arrow cuts the texts and numbers the
        different pieces, so only those become Python strings; a sign at a word's end is a piece of its own."""
        if self.by_piece:
            flat = pc.replace_substring(pc.replace_substring(texts, "\n", " "), "\t", " ")
            flat = pc.replace_substring_regex(flat, SIGN_AFTER_WORD, "\\1 \\2\\3")
            lists = pc.split_pattern(flat, " ")
            numbered = lists.flatten().dictionary_encode()
            found, which = self._pieces(numbered.dictionary.to_pylist()), numbered.indices.to_numpy()
            bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        else:
            found, which, bounds = self._whole(texts.to_pylist()), np.arange(len(texts)), np.arange(len(texts) + 1)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        n = sizes[which]
        ends = np.concatenate(([0], np.cumsum(n)))
        # the place of each id among those of the different pieces
        place = np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], n) + np.arange(ends[-1])
        return np.frombuffer(b"".join(found), dtype="<u4")[place], np.diff(ends[bounds])

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, n = self.encode(pa.array(texts, pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []


def spans(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Consecutive spans (a, b) of at most `most` in sum, or of one."""
    ends, a = np.cumsum(sizes, dtype=np.int64), 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, side="right")))
        yield a, b
        a = b


def shared_encoder(vocabulary: str, plain_specials: bool) -> PieceEncoder:
    """The encoder of this Python worker, which Spark uses for task after task: what one task has
    cached serves the next."""
    place = sys.modules.setdefault("_tollgate_piece_encoders", ModuleType("_tollgate_piece_encoders"))
    key = (hashlib.sha256(vocabulary.encode()).hexdigest(), plain_specials)
    held = getattr(place, "held", (None, None))
    if held[0] != key:
        place.held = held = (key, PieceEncoder(vocabulary, plain_specials))
    return held[1]


def _encoded(ordered: DataFrame, id_col: str, vocabulary: str, end_id: int, plain_specials: bool) -> DataFrame:
    """part, id, ids, n_tokens and at, in the order of `ordered` (id, text, part)."""
    sent = ordered.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, before = shared_encoder(sent.value, plain_specials), 0
        for batch in batches:
            texts = batch.column(1)
            for a, b in spans(pc.binary_length(texts).to_numpy(), BATCH_BYTES):
                found, n = encoder.encode(texts.slice(a, b - a))
                ids = np.insert(found, np.cumsum(n), end_id)
                n = n + 1
                ends = np.cumsum(n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(ids.view("<i4"), pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(2).slice(a, b - a), batch.column(0).slice(a, b - a), lists, pa.array(n), pa.array(before + ends - n)],
                    names=["part", id_col, "ids", "n_tokens", "at"])
                before += int(ends[-1])

    kind = ordered.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(tidy(run), f"part int, `{id_col}` {kind}, ids array<int>, n_tokens bigint, at bigint")


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, plain_specials: bool = False, n_files: int | None = None) -> None:
    """Encodes every document and writes the files below `folder`, a shared place.

    The texts are shuffled once, to range partitions of the id; a file is a
    partition. A lost task or shuffle is run again by Spark before the write commits.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        vocabulary = f.read()
    text = text_of(text_col)
    order = [F.col(id_col).asc_nulls_first(), F.col("_text_key"), F.col("_row")]
    # the row number only deals out rows that share id and text
    keyed = docs.select(id_col, text.alias("_t")).select(
        id_col, "_t", F.xxhash64("_t").alias("_text_key"), F.xxhash64(F.monotonically_increasing_id()).alias("_row"))
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = keyed.repartitionByRange(n, *order).sortWithinPartitions(*order).select(
        id_col, "_t", F.spark_partition_id().alias("part"))
    _encoded(ordered, id_col, vocabulary, end_id, plain_specials).write.options(**LAYOUT).parquet(f"{folder}/tokens")


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """The files as they are: part, id, ids, n_tokens, at. Selections of columns and
    comparisons of the id reach the scan (column chunks, row groups and pages)."""
    return spark.read.parquet(f"{folder}/tokens")


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """(part, first): ids before each file. Reads the lengths only; one row per file,
    as many as the writer had partitions, reaches the driver."""
    sums = sorted((r["part"], r["n"]) for r in stored(spark, folder).groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())
    firsts = accumulate((n for _, n in sums), initial=0)
    return spark.createDataFrame([(p, first) for (p, _), first in zip(sums, firsts)], "part int, first bigint")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """id, start (ids of all documents before it), n_tokens and ids, from the files."""
    found = stored(spark, folder).join(F.broadcast(manifest(spark, folder)), "part")
    return found.withColumn("start", F.col("at") + F.col("first")).drop("part", "at", "first")


def ids_checksum(tokens: DataFrame, keep: list[str]) -> DataFrame:
    """The `keep` columns and ids_crc32: of the ids as little-endian 32-bit integers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(keep))
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<i4", copy=False)
            sums = [zlib.crc32(flat[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sums, pa.int64())], names=[*keep, "ids_crc32"])

    kinds = "".join(f"`{c}` {tokens.schema[c].dataType.simpleString()}, " for c in keep)
    return tokens.select(*keep, "ids").mapInArrow(tidy(run), f"{kinds}ids_crc32 bigint")


def encode_to_files(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Writes the documents below the shared checkpoint folder and reads them back."""
    folder = f"{checkpoint_dir(docs.sparkSession)}/tokens-{uuid.uuid4()}"
    write_tokens(docs, folder, tokenizer_path, **options)
    return read_tokens(docs.sparkSession, folder)

r"""Phrases whose words go together, from suffix subtrees built group by group.

Texts (A-Z lower-cased) are cut at `.,;:!?` and line ends into pieces, pieces at blanks into words. Every
word starts a suffix: itself and the words after it in its piece, up to `most_words` (three).
The tree of all suffixes is partitioned vertically, as ERA does: by their first words, so
that each part is built on its own in bounded memory.

1. Words. Occurrences of every word per language, by 64-bit hashes of language and word.
   Two words with one hash are seen here (within a batch by a second hash, else by their letters); then
   everything is hashed anew.
2. Groups of prefixes. The words' counts bound the suffixes that start with them. Prefixes
   fall into cells by their hash; cells are packed into groups, the heaviest first, so that
   a group holds at most `budget` suffixes. A word with more than that is no prefix of its
   own: it is lengthened by the next word and, if that is as frequent, by a third.
3. Subtrees. Suffixes are cut before a word that occurs less than `min_count` times (no
   phrase with it is a candidate; a bit table of fixed size says so, and errs only
   towards longer suffixes). A task counts equal suffixes, so only distinct ones move, packed in a block
   per group. A group sorts its suffixes: equal ones are leaves, leaves that share words are
   below one inner node, and a node's count is the total of its leaves.
4. Scores from the counts of the phrases' parts, exact in decimals of 38 digits; the order
   within a language from range partitions, not from one task for a language.

Defined results: a null or empty text has no words; a null language is `und`, together
with the language of that name; a null id, repeated rows and extra columns do not
matter (only text and language are read). An empty table gives no rows. Words of over 64 bytes
are hashed by a cryptographic hash. Texts that are not valid UTF-8 are taken byte by byte.
"""

from __future__ import annotations

import dataclasses
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import text_of, tidy
from tollgate.llm.words import mix
from tollgate.operators.joins import fits_broadcast
from tollgate.operators.ordering import with_ordinal
from tollgate.plans.materialize import materialize

MOST_WORDS = 3
BUDGET = 1 << 19        # suffixes of a group
CELLS = 12              # bits of the cell of a prefix
TABLE = 24              # bits of a place in the table of frequent words
BLOCK_BITS = 1 << 15    # of one part of that table
PIECE_BYTES = 1 << 20   # of text hashed at a time
MOST_AT_ONCE = 1 << 20  # words whose suffixes are counted at a time
HELD = 300_000          # distinct words that a task keeps before it hands them on
LONG = 64
UNDETERMINED = "und"
_BASES = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

KIND = np.zeros(256, dtype=np.uint8)  # 0: of a word
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


# ---- words of texts --------------------------------------------------------------

@dataclasses.dataclass
class Words:
    """Words of some texts: hashes, second hashes (where asked for), whether the next word is
    in the same piece, and places."""

    hashes: np.ndarray
    checks: np.ndarray | None
    followed: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    data: np.ndarray


class Splitter:
    """Words of texts (as UTF-8 bytes) and their hashes, by array operations over all bytes."""

    def __init__(self, seed: int) -> None:
        self.seed = seed
        letters = LOWER.astype(np.uint64)
        self.values = [mix(letters * np.uint64(0xD1342543DE82EF95) + np.uint64(2 * seed + 1 + (k << 40))) for k in range(2)]
        self._grow(PIECE_BYTES + (1 << 16))

    def _grow(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            out = np.full(n, base, dtype=np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)

        self.powers = [(powers(base), powers(pow(base, -1, 1 << 64))) for base in _BASES]

    def _hash(self, k: int, data: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        up, down = self.powers[k]
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.values[k][data] * up[: len(data)], out=total[1:])
        return mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64))

    def __call__(self, texts: list[bytes], languages: np.ndarray, check: bool = False) -> Words:
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)
        if len(data) > len(self.powers[0][0]):
            self._grow(len(data))
        kind = KIND[data]
        inside = np.zeros(len(data) + 2, dtype=np.int8)
        inside[1:-1] = kind == 0
        step = np.diff(inside)
        first, last = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        h = self._hash(0, data, first, last)
        checks = self._hash(1, data, first, last) if check else None
        for i in np.flatnonzero(last - first > LONG):
            word = LOWER[data[first[i]:last[i]]].tobytes()
            digest = hashlib.blake2b(word, digest_size=16, key=b"%d" % self.seed).digest()
            h[i] = int.from_bytes(digest[:8], "little")
            if check:
                checks[i] = int.from_bytes(digest[8:], "little")
        row = np.searchsorted(ends, first, side="right")
        h = mix(h ^ languages[row])
        h[h == 0] = 1  # 0 stands for the end of a suffix
        breaks = np.cumsum(kind == 2, dtype=np.int32)[first]
        followed = np.zeros(len(first), dtype=bool)
        followed[:-1] = breaks[1:] == breaks[:-1]
        return Words(h, checks, followed, row, first, last, data)


def _pieces(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(place, texts) of runs of rows with about PIECE_BYTES, one row at least."""
    at, size, held = 0, 0, []
    for i, t in enumerate(column):
        t = t.as_py()
        if held and size + len(t) > PIECE_BYTES:
            yield at, held
            at, size, held = i, 0, []
        held.append(t)
        size += len(t)
    if held:
        yield at, held


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(UNDETERMINED))
    return docs.select(text_of(text_col).cast("binary").alias("t"), lang.alias("lang"), F.xxhash64(lang).alias("key"))


def _words_in(batch: pa.RecordBatch, splitter: Splitter, check: bool = False) -> Iterator[tuple[int, Words]]:
    keys = batch.column(2).to_numpy().view(np.uint64)
    for at, texts in _pieces(batch.column(0)):
        yield at, splitter(texts, keys[at:at + len(texts)], check)


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(h, lang, word, n) of every word; tasks hand on each word about once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, held = Splitter(seed), []

        def merged() -> pa.Table:
            return pa.concat_tables(held).group_by(["h", "lang", "word"]).aggregate([("n", "sum")]).select(
                ["h", "lang", "word", "n_sum"]).rename_columns(["h", "lang", "word", "n"])

        for batch in batches:
            for at, w in _words_in(batch, splitter, check=True):
                order = np.argsort(w.hashes)
                h, checks = w.hashes[order], w.checks[order]
                new = np.flatnonzero((h[1:] != h[:-1]) | (checks[1:] != checks[:-1])) + 1
                starts = np.concatenate(([0], new)) if len(h) else new
                h, which, n = h[starts], order[starts], np.diff(np.append(starts, len(h)))
                first, size = w.first[which], w.last[which] - w.first[which]
                ends = np.cumsum(size)
                letters = LOWER[w.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]]
                word = pa.Array.from_buffers(pa.binary(), len(h), [
                    None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32)), pa.py_buffer(letters.tobytes())])
                lang = batch.column(1).take(pa.array(at + w.row[which]))
                held.append(pa.table([pa.array(h.view(np.int64)), lang, word, pa.array(n)], names=["h", "lang", "word", "n"]))
                if sum(t.num_rows for t in held) > 2 * HELD:
                    held = [merged()]
                    if held[0].num_rows > HELD:
                        yield from held.pop().combine_chunks().to_batches(100_000)
        if held:
            yield from merged().combine_chunks().to_batches(100_000)

    counted = texts.mapInArrow(tidy(run), "h bigint, lang string, word binary, n bigint")
    return counted.groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))


# ---- vertical partitioning -------------------------------------------------------

def bit_table(hashes: DataFrame) -> np.ndarray:
    """Bits (of 2 ** TABLE) at the places of the hashes, packed in bytes; its size is fixed."""
    place = F.shiftrightunsigned("h", 64 - TABLE)
    parts = hashes.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("part")).agg(
        F.bitmap_construct_agg((F.col("p") % BLOCK_BITS).cast("int")).alias("bits")).collect()
    out = np.zeros((1 << TABLE) // 8, dtype=np.uint8)
    for r in parts:
        at = r["part"] * (BLOCK_BITS // 8)
        out[at:at + len(r["bits"])] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


@dataclasses.dataclass
class Groups:
    """Group of every prefix: of a cell, by `of_cell`; of a word of more than `budget` suffixes
    (`hot`, sorted), by the hash of its lengthened prefix among the groups that follow."""

    of_cell: np.ndarray
    n_cell: int
    hot: np.ndarray
    n_hot: int

    def assign(self, h1: np.ndarray, h2: np.ndarray, h3: np.ndarray) -> np.ndarray:
        group = self.of_cell[(h1 >> np.uint64(64 - CELLS)).astype(np.intp)].astype(np.int64)
        if len(self.hot):
            def is_hot(h: np.ndarray) -> np.ndarray:
                at = np.searchsorted(self.hot, h)
                return self.hot[np.minimum(at, len(self.hot) - 1)] == h

            longer = is_hot(h1)
            third = longer & is_hot(h2)
            key = mix(h1[longer] ^ mix(h2[longer])) ^ np.where(third[longer], mix(h3[longer]), np.uint64(0))
            group[longer] = self.n_cell + (mix(key) % np.uint64(self.n_hot)).astype(np.int64)
        return group

    def is_split(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether the suffixes of a pair of words are in several groups."""
        return np.isin(h1, self.hot) & np.isin(h2, self.hot)


def plan_groups(frequent: DataFrame, budget: int) -> Groups:
    """Packs the prefixes into groups. The driver gets the hashes of words with over `budget`
    occurrences (fewer than the words of the corpus over the budget, like the groups
    themselves) and a sum per cell, 2 ** CELLS of them."""
    hot_rows = frequent.where(F.col("n") > budget).select("h", "n").toArrow()
    hot = np.sort(hot_rows.column("h").to_numpy().view(np.uint64))
    hot_load = int(hot_rows.column("n").to_numpy().sum())
    cells = frequent.where(F.col("n") <= budget).groupBy(F.shiftrightunsigned("h", 64 - CELLS).alias("cell")).agg(
        F.sum("n").alias("n")).collect()
    of_cell, loads = np.zeros(1 << CELLS, dtype=np.int32), [0]
    room = [(0, 0)]  # (load, group) with the emptiest first
    for r in sorted(cells, key=lambda r: (-r["n"], r["cell"])):
        load, group = heapq.heappop(room)
        if load and load + r["n"] > budget:
            heapq.heappush(room, (load, group))
            load, group = 0, len(loads)
            loads.append(0)
        of_cell[r["cell"]] = group
        heapq.heappush(room, (load + r["n"], group))
    return Groups(of_cell, len(loads), hot, max(1, -(-2 * hot_load // budget)))


# ---- subtrees ----------------------------------------------------------------------

def pack(names: np.ndarray, ids: tuple[np.ndarray, ...], counts: np.ndarray) -> bytes:
    """A block: the hashes that its suffixes use, and the suffixes as places among them (from 1;
    0: no word)."""
    used = np.zeros(len(names) + 1, dtype=bool)
    for i in ids:
        used[i] = True
    used[0] = False
    place = np.cumsum(used, dtype=np.uint32)
    place[0] = 0
    head = np.array([int(used.sum()), len(counts)], dtype="<u4").tobytes()
    body = [names[used[1:]].astype("<u8").tobytes(), *(place[i].astype("<u4").tobytes() for i in ids), counts.astype("<u4").tobytes()]
    return head + b"".join(body)


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, suffixes as rows of places, counts) of a block."""
    k, n = np.frombuffer(block, dtype="<u4", count=2).tolist()
    names = np.frombuffer(block, dtype="<u8", count=k, offset=8)
    rest = np.frombuffer(block, dtype="<u4", offset=8 + 8 * k).reshape(MOST_WORDS + 1, n)
    return names, rest[:MOST_WORDS], rest[MOST_WORDS]


def suffix_blocks(texts: DataFrame, seed: int, table: np.ndarray, groups: Groups) -> DataFrame:
    """(grp, block): the distinct suffixes of two words and more that tasks have met."""
    sent = texts.sparkSession.sparkContext.broadcast((table, groups))

    def count(h: np.ndarray, followed: np.ndarray, plan: Groups, bits: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
        """Blocks of the suffixes that start at the first n of the words."""
        place = (h >> np.uint64(64 - TABLE)).astype(np.int64)
        often = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
        names, inverse = np.unique(h[often], return_inverse=True)
        ids = np.zeros(len(h) + 2, dtype=np.int64)
        ids[:-2][often] = inverse + 1
        after = np.zeros(len(h) + 1, dtype=bool)
        after[:len(h)] = followed
        i1 = ids[:n]
        i2 = np.where(after[:n], ids[1:n + 1], 0)
        i3 = np.where(after[1:n + 1] & (i2 > 0), ids[2:n + 2], 0)
        both = (i1 > 0) & (i2 > 0)
        width = np.int64(max(1, int(len(names)).bit_length()))
        key, times = np.unique((i1[both] << (2 * width)) | (i2[both] << width) | i3[both], return_counts=True)
        if not len(key):
            return
        low = (np.int64(1) << width) - 1
        parts = key >> (2 * width), (key >> width) & low, key & low
        by_id = np.concatenate((np.zeros(1, dtype=np.uint64), names))
        group = plan.assign(*(by_id[p] for p in parts))
        order = np.argsort(group, kind="stable")
        cuts = np.flatnonzero(np.diff(group[order])) + 1
        for at in np.split(order, cuts):
            yield int(group[at[0]]), pack(names, tuple(p[at] for p in parts), times[at])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, (bits, plan) = Splitter(seed), sent.value
        hashes, followed, size = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal hashes, followed, size
            h, f = np.concatenate(hashes), np.concatenate(followed)
            hashes, followed, size = [], [], 0
            step = MOST_AT_ONCE - MOST_WORDS
            for at in range(0, len(h), step):  # words looked at beyond a step only end its suffixes
                part = slice(at, at + step + MOST_WORDS - 1)
                out = list(count(h[part], f[part], plan, bits, len(h[at:at + step])))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([g for g, _ in out], pa.int32()),
                                                      pa.array([b for _, b in out], pa.binary())], names=["grp", "block"])

        for batch in batches:
            for _, w in _words_in(batch, splitter):
                if len(w.hashes):
                    hashes.append(w.hashes)
                    followed.append(w.followed)
                    size += len(w.hashes)
                if size > MOST_AT_ONCE // 2:
                    yield from flush()
        if size:
            yield from flush()

    return texts.select("t", "lang", "key").mapInArrow(tidy(run), "grp int, block binary")


def node_counts(blocks: DataFrame, groups: Groups, min_count: int) -> DataFrame:
    """(h1, h2, h3, n) of the inner nodes of two words (h3 = 0) and the leaves of three with at
    least `min_count`. A group's subtree is built on its own."""
    sent = blocks.sparkSession.sparkContext.broadcast(groups)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        plan = sent.value
        read = [unpack(b) for b in frame["block"]]
        names, inverse = np.unique(np.concatenate([r[0] for r in read]), return_inverse=True)
        by_id = np.concatenate((np.zeros(1, dtype=np.uint64), names))
        at, columns = 0, []
        for own, suffixes, _ in read:  # places in a block to places in the group
            where = np.concatenate(([0], inverse[at:at + len(own)] + 1)).astype(np.int32)
            columns.append(where[suffixes])
            at += len(own)
        ids = np.concatenate(columns, axis=1)
        n = np.concatenate([r[2] for r in read]).astype(np.int64)
        order = np.lexsort(ids[::-1])
        ids, n = ids[:, order], n[order]
        new = np.any(ids[:, 1:] != ids[:, :-1], axis=0)
        leaf = np.flatnonzero(np.concatenate(([True], new)))
        ids, n = ids[:, leaf], np.add.reduceat(n, leaf)
        new = np.any(ids[:2, 1:] != ids[:2, :-1], axis=0)
        inner = np.flatnonzero(np.concatenate(([True], new)))
        total = np.add.reduceat(n, inner)
        pair = by_id[ids[0, inner]], by_id[ids[1, inner]]
        keep2 = (total >= min_count) | plan.is_split(*pair)  # a split pair has a part of its count here
        keep3 = (n >= min_count) & (ids[2] > 0)
        h = [np.concatenate((pair[0][keep2], by_id[ids[0, keep3]])), np.concatenate((pair[1][keep2], by_id[ids[1, keep3]])),
             np.concatenate((np.zeros(int(keep2.sum()), dtype=np.uint64), by_id[ids[2, keep3]]))]
        return pd.DataFrame({"h1": h[0].view(np.int64), "h2": h[1].view(np.int64), "h3": h[2].view(np.int64),
                             "n": np.concatenate((total[keep2], n[keep3]))})

    built = blocks.groupBy("grp").applyInPandas(run, "h1 bigint, h2 bigint, h3 bigint, n bigint")
    return built.groupBy("h1", "h2", "h3").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# ---- phrases -------------------------------------------------------------------------

def _score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (left right)), in whole decimals: up to 10^15 occurrences fit 38 digits."""
    return F.expr(f"cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0)) "
                  f"div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def phrases(docs: DataFrame, min_count: int = 10, contained_percent: int = 50, top: int = 2000,
            lang_col: str = "lang", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases of two or three
    words that occur `min_count` times, without those whose words lie in a longer one
    that occurs at least `contained_percent` percent as often."""
    texts = _texts(docs, lang_col, text_col)
    for seed in range(8):
        words = materialize(word_counts(texts, seed))
        if words.groupBy("h").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("two words have the same hash under every seed")
    frequent = materialize(words.where(F.col("n") >= min_count))
    groups = plan_groups(frequent, budget)
    blocks = suffix_blocks(texts, seed, bit_table(frequent), groups)
    nodes = materialize(node_counts(blocks, groups, min_count))
    known = frequent.select("h", "lang", F.col("word").cast("string").alias("word"), "n")

    def named(h: str, word: str, n: str, *more: str) -> DataFrame:
        return known.select(F.col("h").alias(h), F.col("word").alias(word), F.col("n").alias(n), *more)

    two = materialize(
        nodes.where("h3 = 0").select("h1", "h2", F.col("n").alias("a"))
        .join(named("h1", "w1", "f1", "lang"), "h1").join(named("h2", "w2", "f2"), "h2"))
    three = nodes.where("h3 <> 0").select("h1", "h2", "h3", F.col("n").alias("a"))
    # the parts of a phrase of three occur at least as often, so they are among the phrases of two
    three = materialize(
        three.join(two.select("h1", "h2", "lang", "w1", "w2", "f1", F.col("a").alias("f12")), ["h1", "h2"])
        .join(two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("w2").alias("w3"), F.col("f2").alias("f3"),
                         F.col("a").alias("f23")), ["h2", "h3"]))
    longest = three.select("h1", "h2", "a").union(three.select("h2", "h3", "a")).groupBy("h1", "h2").agg(F.max("a").alias("longer"))
    alone = two.join(longest, ["h1", "h2"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * contained_percent))
    pairs = alone.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
                         _score("a", "f1", "f2").alias("score"))
    after_one, after_two = _score("a", "f1", "f23"), _score("a", "f12", "f3")
    first = F.col("s1") <= F.col("s2")
    triples = three.withColumn("s1", after_one).withColumn("s2", after_two).select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"))
    # every language's phrases side by side in one order, cut into even ranges
    placed = with_ordinal(pairs.unionByName(triples).withColumn("_s", -F.col("score")).withColumn("_a", -F.col("a")),
                          ["lang", "_s", "_a", "phrase"])
    per_lang = materialize(placed.groupBy("lang").agg(F.min("ordinal").alias("first")).join(
        words.groupBy("lang").agg(F.sum("n").alias("n")), "lang"))
    side = F.broadcast(per_lang) if fits_broadcast(per_lang.count(), 128) else per_lang
    rank = F.col("ordinal") - F.col("first") + 1
    return placed.join(side, "lang").where(rank <= top).select("lang", rank.alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Phrase collocations, counted exactly in counting quotient filters.

A text (ASCII letters in lower case) is cut into pieces at ``[.,;:!?\\x0A-\\x0D]``
and these into words ``[^\\x20\\x09]+``; a phrase lies within one piece. Everything
is counted for each language apart.

1. Texts are read once. A chunk of texts of one language becomes rows of a staged
   table: one for each distinct word, with its place and its number of occurrences,
   and one with the chunk's tokens as places in that list (0 ends a piece).
2. The words of all chunks are summed. Those that occur ``LEAST`` times get ids
   without gaps, since a phrase that is frequent enough holds no other; the
   others end a run of tokens as a piece does.
3. The ids go back to the chunks by a join on the words, one row for each distinct
   word of a chunk; no dictionary is broadcast.
4. Each task packs the runs' two and three word ids into a key of 2 * h bits and
   permutes it by a Feistel network. The top bits are the quotient, the rest the
   full remainder, so the counter loses nothing: the key is got back by the
   inverse. Sorted keys with counters form a filter, stored as the run length of
   each quotient, packed remainders and counts of one byte (larger ones apart).
5. Filters are cut into blocks of the key space, so many that a merged block has
   at most about ``BLOCK_KEYS`` keys, and shuffled by block. Sorted filters of one block are merged as
   they arrive; memory holds one merged block, however many shards there are.
6. Frequent phrases leave the filters, are scored against the counts of their
   parts and get their words back by joins.

A hot word or phrase is one counter of each shard. Arithmetic is exact: counts are
64-bit, scores are whole divisions of decimals of 38 digits.

Defined cases: a null text is empty, a null language is ``und``; empty texts and
texts of separators hold no word; very long texts are one chunk; rows that repeat
count each time, ids are not read; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siglake.llm.common import _LOWER, U, chunked, discard, mix, numbered, small, span_hashes, staged, string_buffers

LEAST = 10               # occurrences of a phrase
INSIDE = 50              # percent of a phrase's occurrences inside a longer one, from which it is dropped
TOP = 2000               # phrases of each language
CHUNK_BYTES = 8 << 20    # text of the chunks that a task makes at once, one for each language
SHARD_KEYS = 1 << 20     # keys that a task gathers before it writes a filter
BLOCK_KEYS = 1 << 20     # keys of a merged block
ROUNDS = 4

_KIND = np.zeros(256, np.uint8)          # 0 word, 1 white space, 2 end of a piece
_KIND[[9, 32]] = 1
_KIND[[10, 11, 12, 13, *b".,;:!?"]] = 2


# ----------------------------------------------------------------- filters

class Keys:
    """Invertible permutation of packed phrases: three ids of ``width`` bits (the first 0 in a phrase of two)."""

    def __init__(self, width: int):
        if not 1 <= width <= 42:
            raise ValueError("word ids have 1 to 42 bits")
        self.width, self.half = width, -(-3 * width // 2)
        self.mask = U((1 << self.half) - 1)

    def pack(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Halves (left, right) of the keys of rows of three ids."""
        a, b, c = (ids[:, k].astype(U) for k in range(3))
        w, h = self.width, self.half
        # the bits a|b|c, cut after the lower ``half`` ones, which always lie in b and c
        right = ((b << U(w)) | c) & self.mask if 2 * w <= 64 else (c | ((b & U((1 << (h - w)) - 1)) << U(w)))
        left = (b >> U(h - w)) | (a << U(2 * w - h))
        return left, right

    def unpack(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        w, h = self.width, self.half
        c = right & U((1 << w) - 1)
        b = (right >> U(w)) | ((left & U((1 << (2 * w - h)) - 1)) << U(h - w))
        return np.stack([left >> U(2 * w - h), b, c], 1).astype(np.int64)

    def _round(self, x: np.ndarray, k: int) -> np.ndarray:
        return mix(x ^ U(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1))) & self.mask

    def permute(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in range(ROUNDS):
            left, right = right, left ^ self._round(right, k)
        return left, right

    def restore(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for k in reversed(range(ROUNDS)):
            left, right = right ^ self._round(left, k), left
        return left, right


class QuotientFilter:
    """Sorted permuted keys, as halves, with their counts."""

    def __init__(self, half: int, left: np.ndarray, right: np.ndarray, count: np.ndarray):
        self.half, self.left, self.right, self.count = half, left, right, count

    @classmethod
    def of(cls, half: int, left: np.ndarray, right: np.ndarray, count: np.ndarray | None = None) -> "QuotientFilter":
        """Counts of keys in any order; those that repeat add up."""
        order = np.lexsort((right, left)) if 2 * half > 64 else np.argsort((left << U(half)) | right, kind="stable")
        left, right = left[order], right[order]
        fresh = np.ones(len(left), bool)
        fresh[1:] = (left[1:] != left[:-1]) | (right[1:] != right[:-1])
        at = np.flatnonzero(fresh)
        if count is None:
            total = np.diff(np.append(at, len(left)))
        else:
            total = np.add.reduceat(count[order], at) if len(at) else count[:0]
        return cls(half, left[at], right[at], total.astype(np.int64))

    def __len__(self) -> int:
        return len(self.left)

    def merge(self, others: list["QuotientFilter"]) -> "QuotientFilter":
        every = [self, *others]
        return QuotientFilter.of(self.half, *(np.concatenate([getattr(f, n) for f in every])
                                              for n in ("left", "right", "count")))

    def blocks(self, bits: int) -> Iterator[tuple[int, "QuotientFilter"]]:
        """The parts of the 2^bits equal ranges of the key space that hold a key."""
        block = (self.left >> U(self.half - bits)).astype(np.int64)
        cut = np.flatnonzero(np.diff(block)) + 1
        for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(block)]):
            if hi > lo:
                yield int(block[lo]), QuotientFilter(self.half, self.left[lo:hi], self.right[lo:hi], self.count[lo:hi])

    def dump(self, bits: int) -> bytes:
        """One block: quotients as unary run lengths, packed remainders, counts of one byte, larger counts apart.

        ``bits``: the leading bits that name the block, and are not stored again.
        """
        n = len(self.left)
        q = max(0, min(self.half - bits, int(n).bit_length() - 1))       # about one key for each quotient
        rest = self.half - bits - q
        place = self.left & U((1 << (self.half - bits)) - 1)
        quotient = (place >> U(rest)).astype(np.int64)
        # a one for each key, a zero after each quotient's run
        runs = np.zeros(n + (1 << q), np.uint8)
        runs[np.arange(n) + quotient] = 1
        large = np.flatnonzero(self.count > 255)
        head = np.array([n, q, len(large)], "<u4").tobytes()
        small_counts = np.minimum(self.count, 256).astype(np.uint16)
        small_counts[large] = 0                                          # a count is never 0: see the list
        return b"".join([head, np.packbits(runs).tobytes(),
                         _bytes(place & U((1 << rest) - 1), self.right, rest, self.half),
                         small_counts.astype(np.uint8).tobytes(), self.count[large].astype("<i8").tobytes()])

    @classmethod
    def load(cls, raw: memoryview, half: int, bits: int, block: int) -> "QuotientFilter":
        n, q, n_large = np.frombuffer(raw, "<u4", 3).tolist()
        at, rest = 12, half - bits - q
        size = -(-(n + (1 << q)) // 8)
        runs = np.unpackbits(np.frombuffer(raw, np.uint8, size, at), count=n + (1 << q))
        at += size
        ones = np.flatnonzero(runs)
        quotient = (ones - np.arange(n)).astype(U)                       # zeros before a key's one
        low, right, at = _from_bytes(raw, at, n, rest, half)
        count = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
        count[count == 0] = np.frombuffer(raw, "<i8", n_large, at + n)
        left = (U(block) << U(half - bits)) | (quotient << U(rest)) | low
        return cls(half, left, right, count)


def _bytes(low: np.ndarray, right: np.ndarray, rest: int, half: int) -> bytes:
    """Remainders, ``rest`` bits above ``half`` bits, in as many whole bytes as they need together."""
    if rest + half <= 64:
        right, parts = (low << U(half)) | right if rest else right, [rest + half]
    else:
        parts = [half, rest]
    columns = [x.astype("<u8")[:, None].view(np.uint8)[:, :-(-bits // 8)] for x, bits in zip((right, low), parts)]
    return np.ascontiguousarray(np.concatenate(columns, 1)).tobytes()


def _from_bytes(raw: memoryview, at: int, n: int, rest: int, half: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(low, right, the byte after them) of ``n`` remainders."""
    parts = [rest + half] if rest + half <= 64 else [half, rest]
    widths = [-(-bits // 8) for bits in parts]
    held, out, k = np.frombuffer(raw, np.uint8, n * sum(widths), at).reshape(n, sum(widths)), [], 0
    for w in widths:
        whole = np.zeros((n, 8), np.uint8)
        whole[:, :w] = held[:, k:k + w]
        out.append(whole.view("<u8")[:, 0].astype(U))
        k += w
    if len(out) == 1:
        out = [out[0] & U((1 << half) - 1), (out[0] >> U(half)) if rest else np.zeros(n, U)]
    return out[1], out[0], at + n * sum(widths)


# ------------------------------------------------------------------- words

def words_in(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, end bytes, whether a word is its piece's last) of the words of all rows."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(0, bool)
    kind = _KIND[data]
    word = kind == 0
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    row = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    first[row], last[row - 1] = word[row], word[row - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    # pieces: breaks before a byte, by ends of pieces and of rows
    breaks = np.cumsum(np.bincount(row, minlength=len(data)) + (kind == 2))
    piece = breaks[starts]
    return starts, ends, np.append(piece[1:] != piece[:-1], True)[:len(starts)]


def _distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an occurrence of each distinct word, each word's place among them), compared byte for byte."""
    h = span_hashes(data, starts, ends)
    _, at, place = np.unique(h, return_index=True, return_inverse=True)
    size, model = ends - starts, starts[at][place]
    same = np.array_equal(size, (ends - starts)[at][place])
    if same and len(size):
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        same = np.array_equal(data[np.repeat(starts, size) + step], data[np.repeat(model, size) + step])
    if not same:                                     # two words of one hash
        raw, seen = data.tobytes(), {}
        place = np.array([seen.setdefault(raw[s:e], (len(seen), i))[0]
                          for i, (s, e) in enumerate(zip(starts.tolist(), ends.tolist()))])
        at = np.array([i for _, i in seen.values()])
    return at, place


#: Rows of a chunk: one of its tokens (``n`` its distinct words, ``total`` all words), one for each word (``n`` times).
_CHUNKS = "chunk bigint, lang string, word string, place int, n bigint, tokens binary, total bigint"


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together until they hold CHUNK_BYTES."""
    held, size = [], 0
    for b in chunked(batches, CHUNK_BYTES):
        held.append(b)
        size += b.nbytes
        if size >= CHUNK_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split(" ")[0] for f in _CHUNKS.split(", ")]
    for whole in _gathered(batches):
        langs = whole.column(0).combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        kind = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            data, off = string_buffers(whole.column(1).take(pa.array(np.flatnonzero(kind == k))).combine_chunks())
            data = _LOWER[data]
            starts, ends, last = words_in(data, off)
            if not len(starts):
                continue
            at, place = _distinct(data, starts, ends)
            size = (ends - starts)[at]
            cut = np.cumsum(size)
            raw = data[np.repeat(starts[at] - (cut - size), size) + np.arange(int(cut[-1]))].tobytes()
            # places of two bytes where they are enough
            tokens = np.zeros(len(place) + int(last.sum()), "<u2" if len(at) < 1 << 16 else "<u4")
            tokens[np.arange(len(place)) + np.cumsum(last) - last] = place + 1
            chunk = uuid.uuid4().int >> 65
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([lang], pa.string()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int32()),
                 pa.array([len(at)], pa.int64()), pa.array([tokens.tobytes()], pa.binary()), pa.array([len(place)], pa.int64())],
                names=names)
            words = pa.Array.from_buffers(pa.string(), len(at), [
                None, pa.py_buffer(np.append(0, cut).astype(np.int32)), pa.py_buffer(raw)])
            n = np.bincount(place, minlength=len(at))
            for lo in range(0, len(at), 10_000):
                some = words[lo:lo + 10_000]
                m = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, chunk)), pa.DictionaryArray.from_arrays(pa.array(np.zeros(m, np.int32)), [lang]).cast(
                        pa.string()), some, pa.array(np.arange(lo + 1, lo + m + 1, dtype=np.int32)), pa.array(n[lo:lo + m]),
                     pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64())], names=names)


def chunk_texts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Staged rows of the chunks."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    return staged(rows.mapInArrow(_chunks, _CHUNKS), "chunks")


# ----------------------------------------------------------------- counting

def count_phrases(chunks: DataFrame, vocabulary: DataFrame, n_ids: int, n_words: int, least: int = LEAST) -> DataFrame:
    """(w1, w2, w3, a): phrases of three word ids (w1 is 0 in one of two) that occur at least ``least`` times."""
    keys = Keys(max(1, int(n_ids).bit_length()))
    bits = max(0, min(keys.half - 1, (2 * n_words // BLOCK_KEYS).bit_length()))
    named = chunks.where("word is not null").select("chunk", "lang", "word", "place").join(
        vocabulary.select("lang", "word", "id"), ["lang", "word"])
    ids = named.groupBy("chunk").agg(F.collect_list(F.struct("place", "id")).alias("ids"))
    tokens = chunks.where("tokens is not null").select("chunk", "tokens", "n")
    coded = ids.join(tokens, "chunk").select("tokens", "ids", "n")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        filters: list[QuotientFilter] = []

        def pack() -> None:
            if held:
                filters.append(QuotientFilter.of(keys.half, *(np.concatenate(x) for x in zip(*held))))
                held.clear()

        def written() -> Iterator[pa.RecordBatch]:
            pack()
            if filters:
                merged = filters[0].merge(filters[1:]) if len(filters) > 1 else filters[0]
                filters.clear()
                parts = list(merged.blocks(bits))
                for at in range(0, len(parts), 256):
                    some = parts[at:at + 256]
                    yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in some], pa.int64()),
                                                      pa.array([f.dump(bits) for _, f in some], pa.binary())],
                                                     names=["block", "filter"])

        for b in batches:
            for raw, own, n in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
                tokens = np.frombuffer(raw.as_buffer(), "<u2" if n < 1 << 16 else "<u4")
                table = np.zeros(n + 1, np.int64)
                table[own.values.field(0).to_numpy()] = own.values.field(1).to_numpy()
                t = table[tokens]                                   # 0: the end of a piece, or a rare word
                two = np.flatnonzero((t[:-1] > 0) & (t[1:] > 0))
                three = two[:-1][np.diff(two) == 1]
                gram = np.zeros((len(two) + len(three), 3), np.int64)
                gram[:len(two), 1], gram[:len(two), 2] = t[two], t[two + 1]
                for k in range(3):
                    gram[len(two):, k] = t[three + k]
                held.append(keys.permute(*keys.pack(gram)))
                if sum(len(x) for x, _ in held) >= SHARD_KEYS:
                    pack()
                    if sum(map(len, filters)) >= 2 * SHARD_KEYS:
                        yield from written()
        yield from written()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Filters in the order of their blocks to the frequent phrases."""
        block, held = None, []

        def fold() -> None:
            if len(held) > 1:
                held[:] = [held[0].merge(held[1:])]

        def frequent() -> Iterator[pa.RecordBatch]:
            fold()
            if held:
                f = held[0]
                often = f.count >= least
                ids = keys.unpack(*keys.restore(f.left[often], f.right[often]))
                yield pa.RecordBatch.from_arrays([*(pa.array(ids[:, k].copy()) for k in range(3)), pa.array(f.count[often])],
                                                 names=["w1", "w2", "w3", "a"])
                held.clear()

        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1)):
                if k != block:
                    yield from frequent()
                    block = k
                held.append(QuotientFilter.load(memoryview(raw.as_buffer()), keys.half, bits, k))
                # the first is the merged one; the others are merged once they are as large as it
                if sum(map(len, held[1:])) > max(len(held[0]), 1 << 16):
                    fold()
        yield from frequent()

    dealt = coded.mapInArrow(shards, "block bigint, filter binary").repartition("block").sortWithinPartitions("block")
    return staged(dealt.mapInArrow(merged, "w1 bigint, w2 bigint, w3 bigint, a bigint"), "phrases")


def _score() -> Column:
    big = "decimal(38,0)"
    a, l, r = (F.col(c).cast("decimal(18,0)") for c in "alr")
    # whole division of exact products
    return F.call_function("div", (a * a).cast(big) * F.lit(1_000_000).cast("decimal(7,0)"), (l * r).cast(big))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP
                 ) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    chunks = chunk_texts(docs, text_col, lang_col)
    totals = staged(chunks.where("total is not null").groupBy("lang").agg(F.sum("total").alias("n")), "totals")
    n_words = totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    words = chunks.where("word is not null").groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    vocabulary = numbered(words, "id", "vocabulary")
    vocabulary = _as(vocabulary, vocabulary.withColumn("id", F.col("id") + 1))
    n_ids = vocabulary.count()
    found = count_phrases(chunks, vocabulary, n_ids, n_words, least)
    discard(chunks)
    two = found.where("w1 = 0").select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")
    three = found.where("w1 > 0")

    def part(first: str, second: str | None, name: str) -> DataFrame:
        """Counts ``name`` of parts of one or two words, by columns of the given names."""
        if second is None:
            return small(_as(vocabulary, vocabulary.select(F.col("id").alias(first), F.col("f").alias(name))))
        return small(_as(found, two.select(F.col("w1").alias(first), F.col("w2").alias(second), F.col("a").alias(name))))

    longer = three.select("w1", "w2", "a").union(three.select("w2", "w3", "a")).groupBy("w1", "w2").agg(
        F.max("a").alias("longest"))
    pairs = two.join(longer, ["w1", "w2"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < INSIDE * F.col("a")))
    pairs = pairs.join(part("w1", None, "l"), "w1").join(part("w2", None, "r"), "w2").select(
        F.array("w1", "w2").alias("ids"), "a", "l", "r", _score().alias("score"))
    cuts = three.join(part("w1", None, "l1"), "w1").join(part("w2", "w3", "r1"), ["w2", "w3"]).join(
        part("w1", "w2", "l2"), ["w1", "w2"]).join(part("w3", None, "r2"), "w3")
    cuts = cuts.select(F.array("w1", "w2", "w3").alias("ids"), "a", F.explode(F.array(
        F.struct(F.lit(1).alias("k"), F.col("l1").alias("l"), F.col("r1").alias("r")),
        F.struct(F.lit(2).alias("k"), F.col("l2").alias("l"), F.col("r2").alias("r")))).alias("cut"))
    cuts = cuts.select("ids", "a", "cut.k", "cut.l", "cut.r").withColumn("score", _score())
    triples = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select(
        "ids", "a", "m.l", "m.r", "m.score")
    scored = pairs.unionByName(triples)
    # words come back by their ids, first to last
    text = None
    for k in range(3):
        word = small(_as(vocabulary, vocabulary.select(
            F.col("id").alias("id_k"), F.col("word").alias(f"t{k}"), *(["lang"] if k == 0 else []))))
        scored = scored.join(word, F.get("ids", F.lit(k)) == F.col("id_k"), "left" if k == 2 else "inner").drop("id_k")
    text = F.concat_ws(" ", "t0", "t1", "t2")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.select("lang", text.alias("phrase"), "a", "l", "r", "score").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(small(totals), "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def _as(stored: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, a projection of the staged table ``stored``, which tells its size."""
    df.staged_path = stored.staged_path
    return df

"""Repeated passages across documents by compact windows over token min-hashes.

A token is a five-word shingle (ASCII letters in lower case). Under one hash
function, all runs of a document whose least token stands at place ``c`` form
one compact window ``(l, c, r)``: every run that starts in [l, c] and ends in
[c, r] has that token as its min-hash. The windows are the nodes of the
Cartesian tree over the hashed tokens whose runs reach the wanted length, about
2 n / t of them. Two passages that share a signature lie in windows of the same
key (hash function, least token).

1. Windows of ``HASHES`` functions are written as a thin table; keys that only
   one document has are dropped by an aggregation of ids alone.
2. The first document of a key stands for it: each other document is joined to
   its window there, so a key of n documents gives n - 1 rows, not their square.
3. Matches of the same two documents are joined as intervals: windows that
   overlap in both documents form one candidate, and candidates with at least
   ``ENOUGH`` matching functions, or one exact alignment of full length, go on.
4. Candidates are verified on the tokens themselves: a passage is reported if it
   has at least ``MIN_WORDS`` words and a Jaccard similarity of at least 0.75 to
   a passage of the earlier document, and lies in no other reported one.
5. An earlier document that has a key but not the passage can hide it so. What
   reported passages do not cover is therefore cut into segments: runs of the
   shortest length whose least tokens under two functions stay the same. Segments
   of one key, now of two tokens, are sorted by range, by key, then by the least
   tokens under the other functions, then by document, and each is held against
   the one before it, so a key of n segments gives n - 1 rows. Documents that share
   the passage follow each other in that order, even if very many others hold its
   lines. What (3) and (4) make of these matches is reported too.

Word for word repeats have equal least tokens under all functions, so only
documents alike in all of them stand between. The tests count such runs and measure
recall of changed passages where earlier documents hold their lines.

Defined cases: null, empty and short texts hold no passage; repeats within one
document are not reported, nor between rows that repeat an id; such rows are
each held against the others' documents; null ids are left out; an empty table
gives an empty result; very long texts are read whole; other columns are not
read.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siglake.llm.common import (U, chunked, columns_of, discard, local_rows, mix, ngram_hashes, numbered, small, staged,
                                string_buffers, text_hash, words_of)

SHINGLE = 5
MIN_WORDS = 50
LENGTH = MIN_WORDS - SHINGLE + 1      # tokens of the shortest passage
HASHES = 4
ENOUGH = 2
FILTERS = 2                           # functions whose shared keys choose the runs of segments
#: Pairs of functions that key segments; those of the first pair also end where any function's least token changes.
PAIRS = ((0, 1), (0, 2), (1, 3))
SHARE = 0.75
GAP = 3 * SHINGLE                     # tokens without a match that a passage may contain in a row

_SALT = mix(np.arange(77, 77 + HASHES).astype(U))
_PLACE = 28                           # bits of a place; the rest of the 64 hold the hash
_MASK = U((1 << _PLACE) - 1)


def least_of_runs(tokens: np.ndarray, sizes: np.ndarray, salt: np.uint64, length: int = LENGTH
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and place of each token of rows laid end to end, the least of every run of ``length``, the rows' stops.

    Runs that cross rows have a least value of at most ``_MASK``.
    """
    # a zero after each row is smaller than any hash, so no window crosses rows
    n = int(sizes.sum()) + len(sizes)
    stops = np.cumsum(sizes + 1) - 1
    at = np.ones(n, bool)
    at[stops] = False
    value = np.zeros(n, U)
    value[at] = mix(tokens ^ salt) | (U(1) << U(_PLACE))
    value = (value & ~_MASK) | np.arange(n, dtype=U)
    if n < length:
        return value, value[:0], stops
    # least value of every run of `length`: suffix minimum of one block, prefix minimum of the next
    blocks = -(-n // length) * length
    padded = np.concatenate([value, np.zeros(blocks - n, U)]).reshape(-1, length)
    prefix = np.minimum.accumulate(padded, 1).ravel()
    suffix = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    return value, np.minimum(suffix[:n - length + 1], prefix[length - 1:n]), stops


def compact_windows(tokens: np.ndarray, sizes: np.ndarray, salt: np.uint64, length: int = LENGTH
                    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(l, c, r) places of all compact windows of rows of tokens laid end to end.

    Ties take the first place. A window is kept if its runs reach ``length``.
    """
    value, least, stops = least_of_runs(tokens, sizes, salt, length)
    n = len(value)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z
    least = least[least > _MASK]
    centre = (least & _MASK).astype(np.int64)
    centre = centre[np.concatenate([[True], centre[1:] != centre[:-1]])] if len(centre) else centre
    # the smaller neighbour of a window's centre is a centre or a row end, so the tree needs only these
    places = np.union1d(centre, stops)
    values = value[places]
    order = values.tolist()
    where = places.tolist()
    before, after = [-1] * len(where), [n] * len(where)
    stack: list[int] = []
    for i, v in enumerate(order):
        while stack and order[stack[-1]] > v:
            after[stack.pop()] = where[i]
        if stack:
            before[i] = where[stack[-1]]
        stack.append(i)
    used = values > _MASK
    return np.array(before)[used] + 1, places[used], np.array(after)[used] - 1


_WINDOWS = "doc_id bigint, key bigint, l int, c int, r int"


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunked(batches, 1 << 19):
        words, _, _, per_row = words_of(*string_buffers(b.column(1)), lower=True)
        grams = ngram_hashes(words, SHINGLE)
        ids = b.column(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(per_row)
        use = np.flatnonzero(per_row >= MIN_WORDS)
        if not len(use):
            continue
        sizes = per_row[use] - SHINGLE + 1
        tokens = np.concatenate([grams[e - c:e - SHINGLE + 1] for e, c in zip(ends[use].tolist(), per_row[use].tolist())])
        begins = np.cumsum(sizes + 1) - sizes - 1             # places count a stop after each row
        token_at = np.cumsum(sizes) - sizes
        for j in range(HASHES):
            left, centre, right = compact_windows(tokens, sizes, _SALT[j])
            row = np.searchsorted(begins, centre, "right") - 1
            token = tokens[centre - begins[row] + token_at[row]]
            key = (mix(token ^ _SALT[j]) & ~U(HASHES - 1)) | U(j)
            # where a text repeats itself, equal keys follow closely: one for each half length stands for them
            same = np.zeros(len(key), bool)
            same[1:] = (key[1:] == key[:-1]) & (row[1:] == row[:-1]) & (np.diff(centre) < LENGTH // 2)
            start = np.maximum.accumulate(np.where(same, 0, np.arange(len(key))))
            step = (centre - centre[start]) // (LENGTH // 2)
            s = ~same
            s[1:] |= step[1:] != step[:-1]
            base = begins[row][s]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[use][row[s]].astype(np.int64)), pa.array(key[s].view(np.int64)),
                 *(pa.array((x[s] - base).astype(np.int32)) for x in (left, centre, right))],
                names=["doc_id", "key", "l", "c", "r"])


_MATCHES = "first bigint, doc_id bigint, key bigint, l int, c int, r int, al int, ac int, ar int"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in order to matches of each with the one before it; ``task`` marks the first and last segment of a task."""
    from pyspark import TaskContext
    task = TaskContext.get().partitionId()
    names = [*(f.split(" ")[0] for f in _MATCHES.split(", ")), "task"]
    kinds = [pa.int64()] * 3 + [pa.int32()] * 6
    before = first = None
    for b in batches:
        doc, key, left, centre, right = (b.column(k).to_numpy(zero_copy_only=False) for k in range(5))
        if not len(doc):
            continue
        if first is None:
            first = (doc[0], doc[0], key[0], left[0], centre[0], right[0], left[0], centre[0], right[0])
        else:
            doc, key, left, centre, right = (np.append(x, y) for x, y in zip(before, (doc, key, left, centre, right)))
        hit = np.flatnonzero((key[1:] == key[:-1]) & (doc[1:] != doc[:-1]))
        # the earlier document is the first of a match
        turn = doc[hit] > doc[hit + 1]
        lo, hi = np.where(turn, hit + 1, hit), np.where(turn, hit, hit + 1)
        cols = [doc[lo], doc[hi], key[hi], left[hi], centre[hi], right[hi], left[lo], centre[lo], right[lo]]
        yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(cols, kinds)),
                                          pa.nulls(len(hit), pa.int32())], names=names)
        before = [x[-1:] for x in (doc, key, left, centre, right)]
    if first is not None:
        d, k, lo, c, r = (x[0] for x in before)
        rows = [first, (d, d, k, lo, c, r, lo, c, r)]
        yield pa.RecordBatch.from_arrays([*(pa.array([int(x) for x in col], t) for col, t in zip(zip(*rows), kinds)),
                                          pa.array([task, task], pa.int32())], names=names)


def neighbours(segments: DataFrame) -> DataFrame:
    """Matches of each segment with the one before it in the order of key, context and document."""
    ordered = segments.repartitionByRange("key", "ctx", "doc_id").sortWithinPartitions("key", "ctx", "doc_id", "c")
    found = staged(ordered.select("doc_id", "key", "l", "c", "r").mapInArrow(_neighbours, _MATCHES + ", task int"),
                   "neighbours")
    # the first and the last segment of each task come to the driver, to meet those of the tasks beside it
    edges = sorted(found.where("task is not null").collect(), key=lambda r: r["task"])
    between = [sorted([one, other], key=lambda r: r["doc_id"]) for one, other in zip(edges[1::2], edges[2::2])
               if one["key"] == other["key"] and one["doc_id"] != other["doc_id"]]
    rows = [(a["doc_id"], b["doc_id"], b["key"], b["l"], b["c"], b["r"], a["l"], a["c"], a["r"]) for a, b in between]
    inside = found.where("task is null").drop("task")
    return inside.union(local_rows(segments.sparkSession, rows, _MATCHES)) if rows else inside


_CANDIDATES = "a bigint, b bigint, a_lo int, a_hi int, b_lo int, b_hi int, shift int"


def _intervals(enough: int, beyond: int = 0):
    """Matches of two documents to candidates: windows that overlap in both, from enough functions, and ``beyond`` tokens."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for a, b, matches in zip(*(batch.column(i).to_pylist() for i in range(3))):
                open_: list[list] = []
                rows = sorted((m["c"], m["ac"], m["l"], m["r"], m["al"], m["ar"], m["key"]) for m in matches)
                for c, ac, left, right, a_left, a_right, key in rows:
                    back, on = min(c - left, ac - a_left), min(right - c, a_right - ac)
                    b_lo, b_hi, a_lo, a_hi = c - back, c + on, ac - back, ac + on
                    if b_hi - b_lo + 1 < SHARE * LENGTH:
                        continue
                    full = b_hi - b_lo + 1 >= LENGTH
                    for o in open_:
                        if b_lo <= o[1] and b_hi >= o[0] and a_lo <= o[3] and a_hi >= o[2]:
                            o[0], o[1], o[2], o[3] = min(o[0], b_lo), max(o[1], b_hi), min(o[2], a_lo), max(o[3], a_hi)
                            o[4].add(key & (HASHES - 1))
                            o[5] |= full
                            break
                    else:
                        open_.append([b_lo, b_hi, a_lo, a_hi, {key & (HASHES - 1)}, full, ac - c])
                out += [(a, b, max(0, o[2] - beyond), o[3] + beyond, max(0, o[0] - beyond), o[1] + beyond, o[6])
                        for o in open_ if o[5] or len(o[4]) >= enough]
            kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 5)
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["a", "b", "a_lo", "a_hi", "b_lo", "b_hi", "shift"])

    return apply


def _tokens_of(arr: pa.Array) -> list[np.ndarray]:
    words, _, _, per_row = words_of(*string_buffers(arr), lower=True)
    grams = ngram_hashes(words, SHINGLE)
    ends = np.cumsum(per_row).tolist()
    return [grams[e - c:max(e - c, e - SHINGLE + 1)] for e, c in zip(ends, per_row.tolist())]


_CARRIED = "a bigint, b bigint, a_lo int, a_hi int, b_lo int, shift int, tokens binary"


def _carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The later document's side of each candidate, with its tokens."""
    for batch in chunked(batches, 1 << 20):
        out: list[tuple] = []
        tokens = _tokens_of(batch.column(1))
        for b, own, wanted in zip(batch.column(0).to_pylist(), tokens, batch.column(2).to_pylist()):
            out += [(w["a"], b, w["a_lo"], w["a_hi"], w["b_lo"], w["shift"], own[w["b_lo"]:w["b_hi"] + 1].tobytes())
                    for w in wanted]
        cols = list(zip(*out)) if out else [()] * 7
        kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         names=["a", "b", "a_lo", "a_hi", "b_lo", "shift", "tokens"])


def align(a: np.ndarray, b: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in b, and in a, of matching tokens in order, along the diagonal ``shift`` if it explains them."""
    lo, hi = max(0, -shift), min(len(b), len(a) - shift)
    same = np.flatnonzero(a[lo + shift:hi + shift] == b[lo:hi]) + lo if hi > lo else np.zeros(0, np.int64)
    if len(same) == len(b):
        return same, same + shift
    held = np.flatnonzero(np.isin(b, a))
    if len(same) >= 0.95 * len(held):
        return same, same + shift
    places: dict[int, list[int]] = {}
    for i, t in enumerate(a.tolist()):
        places.setdefault(t, []).append(i)
    out, last = [], -1
    for t in b[held].tolist():
        found = places[t]
        k = bisect_right(found, last)
        if last >= 0 and k < len(found) and found[k] - last <= GAP:
            last = found[k]                          # the next place after the last match
        elif last >= 0 and k and last - found[k - 1] <= GAP:
            last = found[k - 1]                      # a text that repeats itself longer than the earlier one
        else:
            last = found[0]
        out.append(last)
    return held, np.array(out, np.int64)


def passages(a: np.ndarray, b: np.ndarray, shift: int) -> list[tuple[int, int, int, int, float]]:
    """Passages of ``b`` like a passage of ``a``: (start, end, start in a, end in a, similarity) in tokens."""
    hit_b, hit_a = align(a, b, shift)
    out: list[tuple[int, int, int, int, float]] = []
    if not len(hit_b):
        return out
    steps = np.diff(hit_b)
    cut = (np.flatnonzero((steps > GAP + 1) | (np.abs(np.diff(hit_a)) > GAP + 1)) + 1).tolist()
    todo = list(zip([0, *cut], [*cut, len(hit_b)]))
    while todo:
        s, e = todo.pop()
        if e <= s:
            continue
        b0, b1 = int(hit_b[s]), int(hit_b[e - 1]) + 1
        if b1 - b0 < LENGTH:
            continue
        a0, a1 = int(hit_a[s:e].min()), int(hit_a[s:e].max()) + 1
        if e - s == b1 - b0 == a1 - a0:              # the same tokens in the same order
            out.append((b0, b1, a0, a1, 1.0))
            continue
        own, other = np.unique(b[b0:b1]), np.unique(a[a0:a1])
        both = len(np.intersect1d(own, other, assume_unique=True))
        share = both / (len(own) + len(other) - both)
        if share >= SHARE:
            out.append((b0, b1, a0, a1, share))
            continue
        gaps = steps[s:e - 1]
        if gaps.max(initial=0) > 1:
            at = s + 1 + int(np.argmax(gaps))
            todo += [(s, at), (at, e)]
    return sorted(out)


_FOUND = ("doc_id bigint, match_id bigint, start_word int, end_word int, match_start int, match_end int, "
          "similarity double")


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunked(batches, 1 << 20):
        out: list[tuple] = []
        # rows of one earlier document often follow each other: its text is split once
        earlier = batch.column(0).to_numpy(zero_copy_only=False)
        fresh = np.concatenate([[True], earlier[1:] != earlier[:-1]])
        held = _tokens_of(batch.column(7).take(pa.array(np.flatnonzero(fresh))))
        which = (np.cumsum(fresh) - 1).tolist()
        for i, (k, a, b, a_lo, a_hi, b_lo, shift) in enumerate(zip(
                which, *(batch.column(c).to_pylist() for c in range(6)))):
            own = held[k][a_lo:a_hi + 1]
            later = np.frombuffer(batch.column(6)[i].as_buffer(), U)
            for b0, b1, a0, a1, share in passages(own, later, b_lo + shift - a_lo):
                out.append((b, a, b_lo + b0, b_lo + b1 + SHINGLE - 1, a_lo + a0, a_lo + a1 + SHINGLE - 1, share))
        cols = list(zip(*out)) if out else [()] * 7
        kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds)],
            names=["doc_id", "match_id", "start_word", "end_word", "match_start", "match_end", "similarity"])


def _maximal(found: DataFrame) -> DataFrame:
    """Passages that lie in no other one of their document; of equal ones that of the first matching document."""
    order = Window.partitionBy("doc_id").orderBy("start_word", F.desc("end_word"), "match_id", "match_start", "match_end")
    reached = F.max("end_word").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("reached", reached).where("reached is null or end_word > reached").drop("reached")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, match_id, start_word, end_word, match_start, match_end, similarity.

    Words [start_word, end_word) of ``doc_id`` repeat words [match_start, match_end) of the earlier ``match_id``.
    """
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).where(
        "doc_id is not null and text is not null")
    windows = staged(two.mapInArrow(_windows, _WINDOWS), "windows")
    keys = staged(windows.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                  .where("first < last").select("key", "first"), "keys")
    shared = staged(windows.join(keys, "key"), "shared")          # keys grow with the windows: shuffled alike
    discard(windows)
    stands = staged(shared.where("doc_id = first").groupBy("key").agg(F.min(F.struct("c", "l", "r")).alias("w"))
                    .select("key", F.col("w.c").alias("ac"), F.col("w.l").alias("al"), F.col("w.r").alias("ar")),
                    "stands")
    matches = shared.where("doc_id > first").join(small(stands), "key")
    found = staged(_verified(two, matches, _intervals(ENOUGH)), "found")
    discard(keys, stands)
    segments = staged(_segments_of(two, shared, found), "segments")
    discard(shared)
    hidden = _verified(two, neighbours(segments), _intervals(1, LENGTH))
    return _maximal(found.union(hidden))


def _verified(two: DataFrame, matches: DataFrame, intervals) -> DataFrame:
    """Passages of documents like a passage of an earlier one, from matches of their windows."""
    pairs = matches.groupBy("first", "doc_id").agg(
        F.collect_list(F.struct("key", "l", "c", "r", "al", "ac", "ar")).alias("matches"))
    candidates = staged(pairs.select("first", "doc_id", "matches").mapInArrow(intervals, _CANDIDATES), "candidates")
    later = staged(candidates.groupBy(F.col("b").alias("doc_id")).agg(
        F.collect_list(F.struct("a", "a_lo", "a_hi", "b_lo", "b_hi", "shift")).alias("wanted")), "later")
    texts = two.join(small(later), "doc_id").select("doc_id", "text", "wanted")
    carried = staged(texts.mapInArrow(_carry, _CARRIED), "carried")
    earlier = staged(candidates.select(F.col("a").alias("doc_id")).distinct(), "earlier")
    first = two.join(small(earlier), "doc_id", "left_semi")
    found = carried.join(first.withColumnRenamed("doc_id", "a"), "a").select(
        "a", "b", "a_lo", "a_hi", "b_lo", "shift", "tokens", "text")
    found = staged(_maximal(found.mapInArrow(_verify, _FOUND)), "verified")
    discard(candidates, later, carried, earlier)
    return found


# ---------------------------------------------------------- segments

_SEGMENTS = "doc_id bigint, key bigint, l int, c int, r int, ctx int"


def _bare(n_words: int, spans: list[dict] | None, place: np.ndarray) -> np.ndarray:
    """Words of each run of MIN_WORDS words that lie in no span."""
    left = np.ones(n_words, bool)
    for span in spans or []:
        left[span["start_word"]:span["end_word"]] = False
    left = np.concatenate([[0], np.cumsum(left)])
    return left[place + MIN_WORDS] - left[place]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of runs whose least tokens under a filter function are shared and that reported passages do not cover."""
    for b in chunked(batches, 1 << 19):
        words, _, _, per_row = words_of(*string_buffers(b.column(1)), lower=True)
        use = np.flatnonzero(per_row >= MIN_WORDS)
        if not len(use):
            continue
        grams = ngram_hashes(words, SHINGLE)
        first = (np.cumsum(per_row) - per_row)[use]
        sizes = per_row[use] - SHINGLE + 1
        tokens = np.concatenate([grams[f:f + n] for f, n in zip(first.tolist(), sizes.tolist())])
        begins = np.cumsum(sizes + 1) - sizes - 1             # places count a stop after each row
        token_at = np.cumsum(sizes) - sizes
        lists = b.column(2).take(pa.array(use))
        wanted = lists.flatten().to_numpy(zero_copy_only=False).view(U)
        wanted = mix(wanted ^ mix(np.repeat(np.arange(len(use)), np.diff(lists.offsets.to_numpy())).astype(U)))
        least = [least_of_runs(tokens, sizes, salt)[1] for salt in _SALT]
        run = np.flatnonzero(least[0] > _MASK)

        def key_of(j: int, c: np.ndarray, row: np.ndarray) -> np.ndarray:
            return mix(tokens[c - begins[row] + token_at[row]] ^ _SALT[j])

        held = []
        for j in range(FILTERS):
            c = (least[j][run] & _MASK).astype(np.int64)
            fresh = np.concatenate([[True], c[1:] != c[:-1]])[:len(c)]
            row = np.searchsorted(begins, c[fresh], "right") - 1
            key = (key_of(j, c[fresh], row) & ~U(HASHES - 1)) | U(j)
            held.append(np.isin(mix(key ^ mix(row.astype(U))), wanted)[np.cumsum(fresh) - 1])
        row = np.searchsorted(begins, run, "right") - 1
        chosen = held[0] | held[1]
        spans = b.column(3)
        for i in np.flatnonzero(spans.is_valid().to_numpy(zero_copy_only=False)[use]).tolist():
            lo, hi = np.searchsorted(row, [i, i + 1])
            chosen[lo:hi] &= _bare(int(per_row[use[i]]), spans[int(use[i])].as_py(), run[lo:hi] - begins[i]) > 0
        run, row, held = run[chosen], row[chosen], [h[chosen] for h in held]
        centre = [(x[run] & _MASK).astype(np.int64) for x in least]
        ids = b.column(0).to_numpy(zero_copy_only=False)[use]
        for kind, (i, j) in enumerate(PAIRS):
            chosen = held[i] & (held[j] if j < FILTERS else True)
            at, own = run[chosen], row[chosen]
            if not len(at):
                continue
            fresh = np.ones(len(at), bool)
            fresh[1:] = (np.diff(at) != 1) | (own[1:] != own[:-1])
            for k in range(HASHES) if kind == 0 else (i, j):
                c = centre[k][chosen]
                fresh[1:] |= c[1:] != c[:-1]
            lo = np.flatnonzero(fresh)
            hi = np.append(lo[1:], len(at)) - 1
            middle = (lo + hi) // 2
            key = {k: key_of(k, centre[k][chosen][lo if k in (i, j) else middle], own[lo]) for k in range(HASHES)}
            both = (mix(key[i] ^ mix(key[j])) & ~U(HASHES - 1)) | U(kind)
            context = mix(np.bitwise_xor.reduce([mix(key[k] + U(k)) for k in range(HASHES) if k not in (i, j)]))
            context = (context >> U(32)).astype(np.uint32).view(np.int32)
            base = begins[own[lo]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[own[lo]].astype(np.int64)), pa.array(both.view(np.int64)),
                 *(pa.array((x - base).astype(np.int32)) for x in (at[lo], centre[i][chosen][lo], at[hi] + LENGTH - 1)),
                 pa.array(context)], names=["doc_id", "key", "l", "c", "r", "ctx"])


def _segments_of(two: DataFrame, shared: DataFrame, found: DataFrame) -> DataFrame:
    keys = shared.where((F.col("key").bitwiseAND(F.lit(HASHES - 1))) < FILTERS).groupBy("doc_id").agg(
        F.collect_set("key").alias("keys"))
    spans = found.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    asked = keys.join(spans, "doc_id", "left")
    texts = two.join(asked.hint("merge"), "doc_id").select("doc_id", "text", "keys", "spans")
    return texts.mapInArrow(_segments, _SEGMENTS)


# ------------------------------------------------------------- removal

def _cut(spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray, raw: bytes) -> bytes:
    """``raw`` without the words of the spans and the white space after them."""
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= len(starts):
            continue
        lo = max(at, int(starts[s]))
        hi = int(starts[e]) if e < len(starts) else int(ends[min(e, len(ends)) - 1])
        if hi > at:
            out.append(raw[at:lo])
            at = max(at, hi)
    return b"".join([*out, raw[at:]])


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with a number ``key`` for each id and text, in the order of the ids: the id itself where none repeats."""
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.limit(1).count() == 0:
        return docs.withColumn(key, F.col("doc_id").cast("bigint"))
    rows = docs.where("doc_id is not null").select(F.col("doc_id").alias("known_id"), text_hash("text").alias("known_h"))
    rows = numbered(rows.distinct().orderBy("known_id", "known_h"), key, "rows")
    same = (docs["doc_id"] == rows["known_id"]) & (text_hash("text") == rows["known_h"])
    return docs.join(small(rows), same, "left").select(*columns_of(docs), key)


def cut_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with each passage left in the earliest document that holds it.

    Later copies are cut out of their texts (``n_chars``, if there, follows);
    a document without a word left is dropped. All columns stay. Rows that repeat
    an id with different texts are documents of their own.
    """
    own, key = "spans", "row"
    while own in docs.columns:                       # names that the documents do not have
        own = f"_{own}"
    while key in docs.columns:
        key = f"_{key}"
    keyed = _keyed(docs, key)
    spans = repeated_passages(keyed, key).groupBy(F.col("doc_id").alias(key)).agg(
        F.collect_set(F.struct("start_word", "end_word")).alias(own))
    spans = staged(spans, "spans")
    joined = keyed.join(small(spans), key, "left")
    hit = joined.where(F.col(own).isNotNull()).select(*columns_of(docs), own)
    place = docs.columns.index("text")
    # plain names on the way through Python, which takes no others
    plain = [f"c{i}" for i in range(len(docs.columns))]
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(plain, docs.schema.fields)])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1 << 20, plain[place]):
            texts = []
            for t, wanted in zip(b.column(place).to_pylist(), b.column(b.num_columns - 1).to_pylist()):
                raw = t.encode()
                _, starts, ends, _ = words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                texts.append(_cut([(w["start_word"], w["end_word"]) for w in wanted], starts, ends, raw).decode())
            cols = list(b.columns[:-1])
            cols[place] = pa.array(texts, b.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(cols, names=b.schema.names[:-1])

    rest = hit.toDF(*plain, own).mapInArrow(cut, schema).where(F.col(plain[place]).rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        n = plain[docs.columns.index("n_chars")]
        rest = rest.withColumn(n, F.length(plain[place]).cast(schema[n].dataType))
    return joined.where(F.col(own).isNull()).select(*columns_of(docs)).union(rest)

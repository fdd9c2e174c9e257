"""Removes every byte of a string of ``span`` bytes that has occurred before, by sorted suffixes.

An occurrence is earlier in a document of smaller id, or in the same document at an earlier place. All
strings are judged on the input. Only some suffixes need to be sorted:

1. Of each string of ``span`` bytes, the ranges of ``gram`` bytes in it with the smallest hash
   are pointers. Equal strings have their pointers at the same places, so every repeat shows
   as two pointers with equal ranges. A pointer whose hash occurs once in all documents goes.
2. The others fetch the bytes around them: up to ``span - gram`` before and ``span`` from there. Equal
   surroundings within a slice need only one to go on; the later ones are repeats already.
3. Surroundings meet by hash in tasks that sort them, what follows the pointer and (reversed) what precedes
   it, by deep-shallow sorting (``deep_shallow``). Neighbours' common prefixes then tell, for each
   distance o of a string's begin before the pointer, which surroundings hold equal
   strings there: those that share ``span - o`` bytes after and o bytes before. All but the first
   occurrence are removed. Strings of one set of equal surroundings are compared as bytes, never by hash.
4. A hash that more than ``crowd`` pointers have, as around a passage with many different
   surroundings, would crowd one task. Its strings are told apart whole: each is a pointer of its own whose
   surroundings are just the ``span`` bytes, and equal ones in a slice again need only one to go on.

Null text counts as empty; a text shorter than ``span`` loses nothing. Null ids come before
all others; different texts of one id come in order of a hash of the text; of repeated rows the first
stays, and the others lose all if they hold ``span`` bytes. Very long texts are searched in
slices that overlap, so memory follows the slice; one row still has to fit a task when it is
rewritten. Only ``doc_id`` and ``text`` are read. An empty table gives no rows. Removal can split a character:
``kept`` is binary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.deep_shallow import as_words, deep_shallow_sort
from shelfwise.llm.prefix_hash import PrefixHash
from shelfwise.llm.textops import chain, text_buffers
from shelfwise.sources.scratch import materialise

SLICE = 1 << 21
BLOCK = (1 << 18) - (1 << 10)


@dataclass(frozen=True)
class SuffixDedupParams:
    span: int = 100
    gram: int = 40
    crowd: int = 1 << 16
    bucket_bytes: int = 1 << 25
    bucket_contexts: int = 100_000
    broadcast_rows: int = 250_000

    @property
    def before(self) -> int:
        """Most bytes of a string that lie before its pointer."""
        return self.span - self.gram


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` over ``width`` values from each place on (fewer at the end)."""
    out, done = values.copy(), 1
    while done < width:
        step = min(done, width - done)
        out[: len(out) - step] = pick(out[: len(out) - step], out[step:])
        done += step
    return out


@dataclass
class Slice:
    """Consecutive parts of texts: ``core`` bounds what belongs to each, within the bytes it may see."""

    data: np.ndarray
    place: np.ndarray  # of each part
    first: np.ndarray  # where each part's visible bytes begin in ``data``
    at: np.ndarray  # where they begin in the text
    size: np.ndarray  # how many they are
    core: np.ndarray  # begin and end, in the text, of the pointers that belong to the part


def slices_of(place: np.ndarray, at: np.ndarray, data: np.ndarray, params: SuffixDedupParams,
              size: int = SLICE) -> Iterator[Slice]:
    """All texts, in slices of about ``size`` bytes; longer texts in parts that overlap by a string."""
    held: list[tuple[int, int, int, int, int]] = []
    total = 0

    def made() -> Slice:
        rows, lows, highs, begins, ends = (np.array(c, np.int64) for c in zip(*held, strict=True))
        seen = np.concatenate([data[at[r] + lo : at[r] + hi] for r, lo, hi in zip(rows, lows, highs, strict=True)])
        first = np.append(0, np.cumsum(highs - lows))[:-1]
        return Slice(seen, place[rows], first, lows, highs - lows, np.column_stack([begins, ends]))

    for row in range(len(place)):
        length = int(at[row + 1] - at[row])
        for begin in range(0, max(length, 1), size):
            end = min(begin + size, length)
            low, high = max(0, begin - params.before), min(length, end + params.span)
            if held and total + high - low > size:
                yield made()
                held, total = [], 0
            held.append((row, low, high, begin, end))
            total += high - low
    if held:
        yield made()


def pointers(part: Slice, params: SuffixDedupParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, place in ``data``, hash) of all pointers of the slice.

    They are looked for in one block after the other: a place takes some 80 bytes meanwhile.
    """
    n = len(part.data)
    none = np.zeros(0, np.int64)
    if n < params.span:
        return none, none, none.view(np.uint64)
    found = [_block_pointers(part, begin, min(begin + BLOCK, n), params) for begin in range(0, n, BLOCK)]
    own, at, hashes = (np.concatenate(c) for c in zip(*found, strict=True))
    return own, at, hashes


def _block_pointers(part: Slice, begin: int, end: int, params: SuffixDedupParams):
    """The pointers from ``begin`` to ``end``, by the bytes of all strings that may hold them."""
    low, high = max(0, begin - params.before), min(len(part.data), end + params.span)
    n = high - low
    top = np.uint64(2**64 - 1)
    hashes = np.full(n, top, np.uint64)
    grams = PrefixHash(part.data[low:high]).grams(params.gram)
    hashes[: len(grams)] = np.minimum(grams, top - np.uint64(1)) | np.uint64(1)
    width = params.before + 1
    least = _sliding(hashes, width, np.minimum)
    # No string begins where fewer than ``span`` bytes of its part are left.
    ends = part.first + part.size
    number = np.repeat(np.arange(len(part.size)), np.clip(ends, low, high) - np.clip(part.first, low, high))
    least[ends[number] - np.arange(low, high) < params.span] = 0
    # A range is a pointer if it has the smallest hash of a string that holds it.
    chosen = _sliding(least[::-1], width, np.maximum)[::-1] == hashes
    at = np.flatnonzero(chosen[begin - low : end - low]) + begin
    own = number[at - low]
    in_text = at - part.first[own] + part.at[own]
    keep = (in_text >= part.core[own, 0]) & (in_text < part.core[own, 1])
    return own[keep], at[keep], hashes[at[keep] - low]


CONTEXT = ("key", "place", "pos", "before", "after", "left", "right")


def surroundings(part: Slice, own: np.ndarray, at: np.ndarray, before: int, after: int):
    """(bytes before, reversed; bytes from there) with zeros where the part ends, and how many are real."""
    low = np.minimum(at - part.first[own], before)
    high = np.minimum(part.first[own] + part.size[own] - at, after)
    left = np.zeros((len(at), -(-before // 8) * 8), np.uint8)
    right = np.zeros((len(at), -(-after // 8) * 8), np.uint8)
    top = max(len(part.data) - 1, 0)
    for k in range(before):
        left[:, k] = np.where(k < low, part.data[np.maximum(at - 1 - k, 0)], 0)
    for k in range(after):
        right[:, k] = np.where(k < high, part.data[np.minimum(at + k, top)], 0)
    return left, right, low.astype(np.uint8), high.astype(np.uint8)


@dataclass
class Contexts:
    """Pointers with what surrounds them, in order of key, place and position."""

    key: np.ndarray
    place: np.ndarray
    pos: np.ndarray
    before: np.ndarray
    after: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def taken(self, rows: np.ndarray) -> Contexts:
        return Contexts(*(getattr(self, c)[rows] for c in CONTEXT))

    def ordered(self) -> Contexts:
        return self.taken(np.lexsort((self.pos, self.place, self.key)))

    def packed(self) -> bytes:
        """Compressed columns."""
        arrays = [np.ascontiguousarray(getattr(self, c)) for c in CONTEXT]
        raw = b"".join(x.tobytes() for x in arrays)
        return np.int64(len(raw)).tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpacked(blobs: list[bytes], sizes: list[int], before: int, after: int) -> Contexts:
    widths = (-(-before // 8) * 8, -(-after // 8) * 8)
    kinds = [(np.uint64, 1), (np.int64, 1), (np.int64, 1), (np.uint8, 1), (np.uint8, 1),
             (np.uint8, widths[0]), (np.uint8, widths[1])]
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob, n in zip(blobs, sizes, strict=True):
        total = int(np.frombuffer(blob[:8], np.int64)[0])
        raw = pa.decompress(blob[8:], total, "zstd", asbytes=True)
        at = 0
        for k, (kind, width) in enumerate(kinds):
            size = n * width * np.dtype(kind).itemsize
            column = np.frombuffer(raw, kind, n * width, at)
            columns[k].append(column if k < 5 else column.reshape(n, width))
            at += size
    return Contexts(*(np.concatenate(c) for c in columns))


def equal_runs(c: Contexts) -> tuple[np.ndarray, np.ndarray]:
    """(rows in an order that brings equal surroundings together, whether each begins a run of them).

    Within a run the earliest comes first. Rows are in order of key, place and position.
    """
    n = len(c.key)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    left, right = c.left.view(np.uint64), c.right.view(np.uint64)
    sizes = c.before.astype(np.uint64) << np.uint64(8) | c.after
    near = chain(*left.T, *right.T, sizes)
    order = np.lexsort((near, c.key))
    before, after = order[:-1], order[1:]
    new = np.ones(n, bool)
    new[1:] = (c.key[after] != c.key[before]) | (sizes[after] != sizes[before])
    same = np.flatnonzero(~new)
    for part in (left, right):
        new[same] |= (part[order[same]] != part[order[same - 1]]).any(axis=1)
    return order, new


def _span_rows(place: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ranges of each place united where they meet or overlap."""
    if not len(place):
        return place, begin, end
    order = np.lexsort((begin, place))
    place, begin, end = place[order], begin[order], end[order]
    new_place = np.append(True, place[1:] != place[:-1])
    # Ends never pass those of the next place once places lie apart.
    far = np.cumsum(new_place) * np.int64(int(end.max()) + 2)
    reach = np.maximum.accumulate(end + far)
    new = np.append(True, begin[1:] + far[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return place[at], begin[at], (reach - far)[np.append(at[1:] - 1, len(place) - 1)]


def repeats(c: Contexts, params: SuffixDedupParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, begin, end) of what the strings of contexts that met by hash repeat."""
    none = np.zeros(0, np.int64)
    if not len(c.key):
        return none, none, none
    c = c.ordered()
    order, new = equal_runs(c)
    later = order[~new]
    found = [_whole(c, later, params)]
    c = c.taken(np.sort(order[new]))
    several = np.append(True, c.key[1:] != c.key[:-1])
    begins = np.flatnonzero(several)
    sizes = np.diff(np.append(begins, len(c.key)))
    c = c.taken(np.flatnonzero(np.repeat(sizes > 1, sizes)))
    if len(c.key):
        found.append(_partly(c, params))
    return _span_rows(*(np.concatenate(x) for x in zip(*found, strict=True)))


def _whole(c: Contexts, rows: np.ndarray, params: SuffixDedupParams):
    """All strings within the surroundings of these rows."""
    before, after = c.before[rows].astype(np.int64), c.after[rows].astype(np.int64)
    keep = before + after >= params.span
    pos = c.pos[rows][keep]
    return c.place[rows][keep], pos - before[keep], pos + after[keep]


def _partly(c: Contexts, params: SuffixDedupParams):
    """Different surroundings with one key, in order of key, place and position."""
    n = len(c.key)
    _, group = np.unique(c.key, return_inverse=True)
    shallow = params.gram // 8 + 1
    by_right, share_right = deep_shallow_sort(as_words(c.right), group, shallow)
    by_left, share_left = deep_shallow_sort(as_words(c.left), group, 1)
    before, after = c.before.astype(np.int64), c.after.astype(np.int64)
    low, high = np.full(n, params.span, np.int64), np.full(n, -1, np.int64)
    right, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for o in range(min(params.before, int(before.max())) + 1):
        right[by_right] = np.cumsum(share_right < params.span - o)
        left[by_left] = np.cumsum(share_left < o)
        real = np.flatnonzero((before >= o) & (after >= params.span - o))
        # Rows are in order of place and position within a key, and so the first of a class is the earliest.
        cls = right[real] * (n + 1) + left[real]
        _, first = np.unique(cls, return_index=True)
        again = np.ones(len(real), bool)
        again[first] = False
        again = real[again]
        low[again] = np.minimum(low[again], o)
        high[again] = np.maximum(high[again], o)
    rows = np.flatnonzero(high >= 0)
    # All strings of a row hold its pointer, so what they cover is one range.
    return c.place[rows], c.pos[rows] - high[rows], c.pos[rows] - low[rows] + params.span


_PIECE = "bucket int, n long, data binary"
_PIECE_SCHEMA = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("data", pa.binary())])


def _piece(bucket: int, n: int, data: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bucket": [bucket], "n": [n], "data": [data]}, schema=_PIECE_SCHEMA)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield int(bucket[order[begin]]), order[begin:end]


def _places(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("place").to_numpy(zero_copy_only=False)


def _split_columns(columns: list[np.ndarray]) -> bytes:
    """Columns as compressed byte planes."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def _joined_columns(n: int, data: bytes, width: int) -> list[np.ndarray]:
    raw = np.frombuffer(pa.decompress(data, 8 * n * width, "zstd", asbytes=True), np.uint8)
    planes = raw.reshape(width, 8, n).transpose(0, 2, 1)
    return list(np.ascontiguousarray(planes).view(np.int64).reshape(width, n))


_FOUND = "place long, pos long, key long, crowded boolean, end long"


def _known(spans) -> pa.RecordBatch:
    """Ranges that are known to be repeats already, in bucket -1."""
    return _piece(-1, len(spans[0]), _split_columns([np.asarray(s, np.int64) for s in spans]))


def _salted(pieces: DataFrame) -> DataFrame:
    """Known ranges need no meeting and are dealt out by a number of their own."""
    salt = F.when(F.col("bucket") < 0, F.pmod(F.xxhash64("data"), F.lit(64)).cast("int")).otherwise(0)
    return pieces.withColumn("salt", salt).groupBy("bucket", "salt")


def _repeated(pieces: DataFrame, crowd: int) -> DataFrame:
    """Pointers whose key is there more than once, and whether it is crowded; ranges known have an ``end``."""

    def meet(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = [_joined_columns(r.n, r.data, 3) for r in part.itertuples()]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        if key[0] < 0:
            place, begin, end = _span_rows(*columns)
            return pd.DataFrame({"place": place, "pos": begin, "key": 0, "crowded": False, "end": end})
        hashes, place, pos = columns
        _, at, count = np.unique(hashes, return_inverse=True, return_counts=True)
        n = count[at]
        keep = n > 1
        return pd.DataFrame(
            {"place": place[keep], "pos": pos[keep], "key": hashes[keep], "crowded": n[keep] > crowd, "end": 0}
        )

    return _salted(pieces).applyInPandas(meet, _FOUND)


class _Pieces:
    """Pointers of a task, handed on by bucket whenever there are many."""

    LIMIT = 1 << 19

    def __init__(self, buckets: int):
        self.buckets, self.held, self.size = buckets, [], 0

    def add(self, key: np.ndarray, place: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((key, place, pos))
        self.size += len(key)
        if self.size > self.LIMIT:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            key, place, pos = (np.concatenate(c) for c in zip(*self.held, strict=True))
            for number, rows in _by_bucket(_bucket(key, self.buckets)):
                rows = rows[np.argsort(place[rows], kind="stable")]
                yield _piece(number, len(rows), _split_columns([key[rows].view(np.int64), place[rows], pos[rows]]))
        self.held, self.size = [], 0


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _first_of_equal(part: Slice, own, at, key, before: int, params: SuffixDedupParams):
    """Rows (own, at, key) without later ones of equal surroundings, and the ranges those repeat."""
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    common = count[inverse] > 1
    rows = np.flatnonzero(common)
    c = _contexts(part, own[rows], at[rows], key[rows], before, params.span)
    by = np.lexsort((c.pos, c.place, c.key))
    c = c.taken(by)
    order, new = equal_runs(c)
    first = np.sort(np.concatenate([np.flatnonzero(~common), rows[by[order[new]]]]))
    return first, _span_rows(*_whole(c, order[~new], params))


def _contexts(part: Slice, own, at, key, before: int, after: int) -> Contexts:
    left, right, low, high = surroundings(part, own, at, before, after)
    return Contexts(key, part.place[own], at - part.first[own] + part.at[own], low, high, left, right)


def _texts(batch: pa.RecordBatch, params: SuffixDedupParams) -> Iterator[Slice]:
    at, data = text_buffers(batch.column("text"))
    yield from slices_of(_places(batch), at, data, params)


def _scan_pointers(texts: DataFrame, buckets: int, params: SuffixDedupParams) -> DataFrame:
    def scan(batches):
        pieces = _Pieces(buckets)
        for batch in batches:
            for part in _texts(batch, params):
                own, at, key = pointers(part, params)
                if not len(at):
                    continue
                rows, known = _first_of_equal(part, own, at, key, params.before, params)
                if len(known[0]):
                    yield _known(known)
                own, at = own[rows], at[rows]
                yield from pieces.add(key[rows], part.place[own], at - part.first[own] + part.at[own])
        yield from pieces.rest()

    return texts.select("place", "text").mapInArrow(scan, _PIECE)


class _Hits:
    """The pointers that rows (place, hits) name."""

    def __init__(self, batch: pa.RecordBatch):
        hits = batch.column("hits")
        flat = hits.flatten()
        place = np.repeat(_places(batch), hits.value_lengths().to_numpy())
        pos, key = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "key"))
        order = np.lexsort((pos, place))
        self.place, self.pos, self.key = place[order], pos[order], key[order].view(np.uint64)

    def within(self, part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(part, place in the slice's data, key)."""
        begin = np.searchsorted(self.place, part.place, "left")
        end = np.searchsorted(self.place, part.place, "right")
        runs = [b + np.searchsorted(self.pos[b:e], c) for b, e, c in zip(begin, end, part.core, strict=True)]
        rows = np.concatenate([np.arange(b, e) for b, e in runs])
        own = np.repeat(np.arange(len(runs)), [e - b for b, e in runs])
        return own, self.pos[rows] - part.at[own] + part.first[own], self.key[rows]


def _with_hits(texts: DataFrame, found: DataFrame) -> DataFrame:
    """Texts with the pointers found in them."""
    hits = found.groupBy("place").agg(F.collect_list(F.struct("pos", "key")).alias("hits"))
    return texts.select("place", "text").join(hits, "place")


def _fetch(texts: DataFrame, found: DataFrame, buckets: int, before: int, params: SuffixDedupParams) -> DataFrame:
    """Surroundings of the pointers found, by bucket."""

    def fetch(batches):
        for batch in batches:
            hits = _Hits(batch)
            for part in _texts(batch, params):
                own, at, key = hits.within(part)
                if not len(at):
                    continue
                rows, known = _first_of_equal(part, own, at, key, before, params)
                if len(known[0]):
                    yield _known(known)
                c = _contexts(part, own[rows], at[rows], key[rows], before, params.span).ordered()
                for number, some in _by_bucket(_bucket(c.key, buckets)):
                    yield _piece(number, len(some), c.taken(some).packed())

    return _with_hits(texts, found).mapInArrow(fetch, _PIECE)


def _windows(texts: DataFrame, found: DataFrame, buckets: int, params: SuffixDedupParams) -> DataFrame:
    """Every string around the crowded pointers, as a pointer of its own."""

    def scan(batches):
        pieces = _Pieces(buckets)
        for batch in batches:
            hits = _Hits(batch)
            for part in _texts(batch, params):
                own, at, _ = hits.within(part)
                low = np.minimum(at - part.first[own], params.before)
                begin = np.concatenate([at[low >= o] - o for o in range(params.before + 1)])
                own = np.concatenate([own[low >= o] for o in range(params.before + 1)])
                real = begin + params.span <= part.first[own] + part.size[own]
                begin, own = begin[real], own[real]
                # Parts of one text overlap, and near pointers share strings: each place counts once.
                place, pos = part.place[own], begin - part.first[own] + part.at[own]
                by = np.lexsort((pos, place))
                new = np.append(True, (place[by][1:] != place[by][:-1]) | (pos[by][1:] != pos[by][:-1]))[: len(by)]
                begin, own = begin[by[new]], own[by[new]]
                if not len(begin):
                    continue
                key = PrefixHash(part.data).of(begin, begin + params.span)
                rows, known = _first_of_equal(part, own, begin, key, 0, params)
                if len(known[0]):
                    yield _known(known)
                begin, own = begin[rows], own[rows]
                yield from pieces.add(key[rows], part.place[own], begin - part.first[own] + part.at[own])
        yield from pieces.rest()

    return _with_hits(texts, found).mapInArrow(scan, _PIECE)


_SPANS = "place long, begin long, end long"


def _sorted_spans(pieces: DataFrame, before: int, params: SuffixDedupParams) -> DataFrame:
    """The ranges that surroundings of one bucket repeat, and those known already."""

    def sort(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            found = [_joined_columns(r.n, r.data, 3) for r in part.itertuples()]
            spans = _span_rows(*(np.concatenate(c) for c in zip(*found, strict=True)))
        else:
            spans = repeats(unpacked(part["data"].tolist(), part["n"].tolist(), before, params.span), params)
        return pd.DataFrame(dict(zip(("place", "begin", "end"), spans, strict=True)))

    return _salted(pieces).applyInPandas(sort, _SPANS)


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Different (doc_id, text) with a number in their order; and where ids repeat, the rows with it.

    Ids that are unique and not null are that number themselves, and no row moves.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    odd = rows.groupBy("doc_id").count().filter("count > 1 or doc_id is null")
    if odd.isEmpty():
        return rows.withColumn("place", F.col("doc_id").cast("long")), None
    keyed = rows.withColumn("text_key", F.xxhash64("text"))
    keys = keyed.select("doc_id", "text_key").distinct().orderBy(F.col("doc_id").asc_nulls_first(), "text_key")
    numbers = materialise(keys.withColumn("place", F.monotonically_increasing_id()), "places")
    numbers = numbers.withColumnsRenamed({"doc_id": "__id", "text_key": "__key"})
    same = keyed["doc_id"].eqNullSafe(numbers["__id"]) & (keyed["text_key"] == numbers["__key"])
    every = materialise(keyed.join(numbers, same).select("doc_id", "text", "place"), "placed")
    return every.dropDuplicates(["place"]), every


def find_repeats(texts: DataFrame, params: SuffixDedupParams) -> DataFrame:
    """(place, spans) of texts (place, text) that hold bytes to remove; spans in order and apart."""
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-n_bytes // params.bucket_bytes))
    found = materialise(_repeated(_scan_pointers(texts, buckets, params), params.crowd), "repeated-pointers")
    parts = [found]
    plain, crowded = (found.filter((F.col("end") == 0) & (F.col("crowded") == c)) for c in (False, True))
    n_plain, n_crowded = plain.count(), crowded.count()
    if n_plain:
        n = -(-n_plain // params.bucket_contexts)
        pieces = _fetch(texts, plain, n, params.before, params)
        parts.append(materialise(_sorted_spans(pieces, params.before, params), "spans"))
    if n_crowded:
        n = max(1, -(-n_crowded * params.before // params.bucket_contexts))
        again = materialise(_repeated(_windows(texts, crowded, n, params), params.crowd), "repeated-strings")
        parts.append(again)
        strings = again.filter("end = 0").dropDuplicates(["place", "pos"])
        n = max(1, -(-strings.count() // params.bucket_contexts))
        parts.append(materialise(_sorted_spans(_fetch(texts, strings, n, 0, params), 0, params), "spans"))
    ranges = [
        (p.filter("end > 0").withColumnRenamed("pos", "begin") if "pos" in p.columns else p).select("place", "begin", "end")
        for p in parts
    ]
    spans = reduce(DataFrame.unionByName, ranges)

    def unite(batches):
        for batch in batches:
            ranges = batch.column("ranges")
            flat = ranges.flatten()
            place = np.repeat(_places(batch), ranges.value_lengths().to_numpy())
            begin, end = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("begin", "end"))
            place, begin, end = _span_rows(place, begin, end)
            first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))[: len(place)]
            at = pa.array(np.append(first, len(place)), pa.int32())
            both = pa.StructArray.from_arrays([pa.array(begin), pa.array(end)], names=["begin", "end"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(place[first]), pa.ListArray.from_arrays(at, both)], names=["place", "spans"]
            )

    by_place = spans.groupBy("place").agg(F.collect_list(F.struct("begin", "end")).alias("ranges"))
    united = by_place.mapInArrow(unite, "place long, spans array<struct<begin:long,end:long>>")
    return materialise(united, "united-spans")


def remove_repeats(docs: DataFrame, params: SuffixDedupParams | None = None) -> DataFrame:
    """doc_id, the removed ``spans`` (in bytes, end exclusive), ``kept`` bytes and ``n_bytes`` of each row."""
    params = params or SuffixDedupParams()
    texts, every = _placed(docs)
    spans = find_repeats(texts, params)
    few = spans.count() <= params.broadcast_rows
    spans = F.broadcast(spans) if few else spans
    if every is None:
        rows = texts.withColumn("copy", F.lit(1))
    else:
        # Copies of a row are alike: all but one of them lose everything.
        counts = every.groupBy("place").agg(
            F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("copies")
        )
        copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
        rows = counts.select("doc_id", "text", "place", copy)
    rows = rows.join(spans, "place", "left").select("doc_id", "text", "copy", "spans")
    span = params.span

    def cut(batches):
        for batch in batches:
            at, data = text_buffers(batch.column("text"))
            lists, copies = batch.column("spans").to_pylist(), batch.column("copy").to_pylist()
            kept, removed = [], []
            for k in range(batch.num_rows):
                text = data[at[k] : at[k + 1]].tobytes()
                cuts = lists[k] or []
                if copies[k] > 1 and len(text) >= span:
                    cuts = [{"begin": 0, "end": len(text)}]
                parts, done = [], 0
                for s in cuts:
                    parts.append(text[done : s["begin"]])
                    done = s["end"]
                kept.append(b"".join([*parts, text[done:]]))
                removed.append(cuts)
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(removed, kind),
                 pa.array(kept, pa.binary()), pa.array(np.diff(at), pa.int64())],
                names=["doc_id", "spans", "kept", "n_bytes"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, spans array<struct<begin:long,end:long>>, kept binary, n_bytes long"
    return rows.mapInArrow(cut, schema)

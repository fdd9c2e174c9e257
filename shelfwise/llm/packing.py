"""Packing documents into sequences: length patterns fitted by non-negative least squares.

1. Every text is tokenised once, closed with an end id and cut only if longer than a sequence; the
   last pieces are full. Pieces are written without their ids.
2. The histogram of lengths, at most one count per length, comes to the driver. All patterns of up
   to ``max_docs`` length classes that fill a sequence are enumerated, and non-negative least
   squares fits their repeat counts to the histogram. Counts are rounded down and each class draws
   its real lengths, longest first; a pattern's shortest document is the longest that fits.
3. What is left over is packed best fit, longest first, over counts of lengths, into the room the
   patterns leave and into new sequences.
4. A piece finds its place by its rank among the pieces of its length: ranks run over hash buckets
   whose number follows the count of that length, so a length that half of all pieces share is
   ranked by many tasks.

Null or empty texts are one end id. Repeated rows are packed as often as they occur; equal pieces
are interchangeable. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfwise.llm.textops import SLICE_BYTES, slices
from shelfwise.sources.scratch import materialise

# Words that the tokenizer library is given at once: it returns the text and place of every token beside its id.
_LEARNED_WORDS = 4000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, region int"


@dataclass(frozen=True)
class TokenizerSpec:
    """A ``tokenizers`` file. ``word_pattern``, its own split into words, lets words be cached.

    ``latin_pattern`` says the same in the terms of ``re``, which is faster, for texts of printable
    ASCII, tabs, line ends and Latin letters only. A worker takes ``slice_bytes`` of text at a time and
    keeps up to about ``cached_words`` words: less of these takes less memory and more time.
    """

    path: str
    end_id: int = 0
    word_pattern: str | None = None
    latin_pattern: str | None = None
    cached_words: int = 600_000
    slice_bytes: int = SLICE_BYTES


_BEYOND_LATIN = re.compile(r"[^\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\u024f]")


@dataclass(frozen=True)
class PackParams:
    capacity: int = 2048
    class_width: int = 16
    max_docs: int = 4
    max_iterations: int = 400


class _Places(dict):
    """Word to row number; words that are asked for first get the next one and are listed."""

    def __init__(self):
        super().__init__()
        self.unseen: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = place = len(self)
        self.unseen.append(word)
        return place


class _Encoder:
    """Token ids of texts, from a bounded cache of words that a worker keeps between its tasks."""

    def __init__(self, spec: TokenizerSpec):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(spec.path)
        added = self._tokenizer.get_added_tokens_decoder().values()
        # Added tokens that take white space or word bounds in are left to the library.
        plain = not any(
            t.lstrip or t.rstrip or t.single_word or (t.normalized and self._tokenizer.normalizer)
            for t in added
        )
        self._words = regex.compile(spec.word_pattern) if spec.word_pattern and plain else None
        contents = sorted((t.content for t in added), key=len, reverse=True)
        self._added = re.compile(f"({'|'.join(map(re.escape, contents))})") if contents else None
        self._latin = re.compile(spec.latin_pattern) if spec.latin_pattern else None
        self._most = spec.cached_words
        self._clear()

    def _clear(self):
        self._places = _Places()
        self._pool = np.zeros(0, np.uint32)
        self._ends = np.zeros(0, np.int64)

    def _learn(self) -> None:
        words, self._places.unseen = self._places.unseen, []
        pools, sizes = [self._pool], []
        for begin in range(0, len(words), _LEARNED_WORDS):
            some = words[begin : begin + _LEARNED_WORDS]
            parts = [some[k : k + 1000] for k in range(0, len(some), 1000)]
            for part, found in zip(
                parts,
                self._tokenizer.encode_batch(parts, is_pretokenized=True, add_special_tokens=False),
                strict=True,
            ):
                pools.append(np.array(found.ids, np.uint32))
                sizes.append(np.bincount(np.array(found.word_ids, np.int64), minlength=len(part)))
        before = len(self._pool)
        self._pool = np.concatenate(pools)
        self._ends = np.append(self._ends, before + np.cumsum(np.concatenate(sizes)))

    def _split(self, text: str) -> list[str]:
        """Words of a text; an added token is one word and ends the ones beside it."""
        if self._added is None or not self._added.search(text):
            return self._split_part(text)
        words = []
        for k, part in enumerate(self._added.split(text)):
            words += [part] if k % 2 else self._split_part(part)
        return words

    def _split_part(self, text: str) -> list[str]:
        if self._latin is None or _BEYOND_LATIN.search(text):
            return self._words.findall(text)
        return self._latin.findall(text)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self._words is None:
            found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(e.ids, np.uint32) for e in found]
        if len(self._places) > self._most:
            self._clear()
        split = [self._split(t) for t in texts]
        n_words = [len(own) for own in split]
        find = self._places.__getitem__
        at = np.fromiter(map(find, chain.from_iterable(split)), np.int64, sum(n_words))
        if self._places.unseen:
            self._learn()
        end = self._ends[at]
        size = end - np.where(at > 0, self._ends[at - 1], 0)
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self._pool[np.repeat(end - ends, size) + np.arange(total)]
        cuts = np.append(0, ends)[np.append(0, np.cumsum(n_words, dtype=np.int64))]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_encoders: dict[TokenizerSpec, _Encoder] = {}


def _encoder(spec: TokenizerSpec) -> _Encoder:
    if spec not in _encoders:
        _encoders[spec] = _Encoder(spec)
    return _encoders[spec]


def _cut(n: int, capacity: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = (n - 1) % capacity + 1
    yield 0, first
    for start in range(first, n, capacity):
        yield start, capacity


def tokenized_pieces(docs: DataFrame, tokenizer: TokenizerSpec, capacity: int) -> DataFrame:
    """doc_id, piece, start, length and the crc32 of the piece's little-endian 32-bit ids; then
    ``region``, which is 0 where ``docs`` has none."""

    def encode(batches):
        encoder = _encoder(tokenizer)
        end = np.array([tokenizer.end_id], np.uint32)
        for batch in batches:
            for part in slices(batch, size=tokenizer.slice_bytes):
                texts = part.column("text").fill_null("").to_pylist()
                rows = []
                for doc_id, region, ids in zip(
                    part.column("doc_id").to_pylist(),
                    part.column("region").to_pylist(),
                    encoder.encode(texts),
                    strict=True,
                ):
                    n = len(ids) + 1
                    for k, (start, length) in enumerate(_cut(n, capacity)):
                        crc = zlib.crc32(np.ascontiguousarray(ids[start : start + length]))
                        if start + length == n:
                            crc = zlib.crc32(end, crc)
                        rows.append((doc_id, k, start, length, crc, region))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(c), t)
                        for c, t in zip(
                            zip(*rows, strict=True),
                            (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32()),
                            strict=True,
                        )
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "region"],
                )

    region = F.col("region").cast("int") if "region" in docs.columns else F.lit(0)
    return docs.select("doc_id", "text", region.alias("region")).mapInArrow(encode, _PIECES)


def _patterns(n_classes: int, max_docs: int) -> list[tuple[int, ...]]:
    """All falling tuples of 2 to ``max_docs`` classes 1..n that sum to ``n_classes``."""
    found: list[tuple[int, ...]] = []

    def extend(prefix, left, most, slots):
        if slots == 1:
            if left <= most:
                found.append((*prefix, left))
            return
        for part in range(min(most, left - slots + 1), -(-left // slots) - 1, -1):
            extend((*prefix, part), left - part, part, slots - 1)

    for slots in range(2, max_docs + 1):
        extend((), n_classes, n_classes - 1, slots)
    return found


def nnls(a: np.ndarray, b: np.ndarray, max_iterations: int) -> np.ndarray:
    """Active-set solution of min |ax - b| over x >= 0; the best found if iterations run out."""
    x = np.zeros(a.shape[1])
    passive = np.zeros(a.shape[1], bool)
    gradient = a.T @ b
    tolerance = 1e-9 * max(1.0, np.abs(gradient).max(initial=0))
    for _ in range(max_iterations):
        allowed = np.where(passive, -np.inf, gradient)
        entering = int(np.argmax(allowed))
        if allowed[entering] <= tolerance:
            break
        passive[entering] = True
        while True:
            columns = np.flatnonzero(passive)
            solved = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if solved.min() > 0:
                x[:] = 0
                x[columns] = solved
                break
            old = x[columns]
            falling = solved <= 0
            step = (old[falling] / np.maximum(old[falling] - solved[falling], 1e-300)).min()
            x[columns] = old + step * (solved - old)
            leaving = columns[falling & (x[columns] <= 1e-12 * max(1.0, x.max()))]
            passive[leaving] = False
            x[leaving] = 0
            if not passive.any():
                break
        gradient = a.T @ (b - a @ x)
    return x


def _fitted(left: dict[int, int], params: PackParams) -> list[tuple[tuple[int, ...], int]]:
    """Packs (lengths, repeats) drawn from ``left`` by the fitted patterns."""
    n_classes = params.capacity // params.class_width
    width = params.class_width
    stock: dict[int, list[int]] = defaultdict(list)
    for length in sorted(left):
        stock[-(-length // width)].append(length)
    counts = np.zeros(n_classes + 1)
    for c, own in stock.items():
        counts[c] = sum(left[length] for length in own)
    patterns = [
        p for p in _patterns(n_classes, params.max_docs) if all(counts[c] > 0 for c in p)
    ]
    if not patterns:
        return []
    a = np.zeros((n_classes + 1, len(patterns)))
    for k, pattern in enumerate(patterns):
        np.add.at(a[:, k], list(pattern), 1.0)
    # A missed long document costs more room than a missed short one.
    scale = np.sqrt(np.arange(n_classes + 1) / n_classes)[:, None]
    repeats = nnls(a * scale, counts * scale[:, 0], params.max_iterations)

    def longest(c: int, taken: Counter, most: int) -> int | None:
        """The longest length of a class that is still there and fits."""
        own = stock[c]
        while own and not left[own[-1]]:
            own.pop()
        fits = (x for x in reversed(own) if x <= most and left[x] > taken[x])
        return next(fits, None)

    def draw(pattern: tuple[int, ...]) -> Counter | None:
        """Real lengths for a pattern; the last is the longest that fits the room left."""
        taken: Counter = Counter()
        room = params.capacity
        for c in pattern[:-1]:
            length = longest(c, taken, room)
            if length is None:
                return None
            taken[length] += 1
            room -= length
        for c in range(-(-room // width), pattern[-1] - 1, -1):
            length = longest(c, taken, room)
            if length is not None:
                taken[length] += 1
                return taken
        return None

    packs = []
    for k in np.argsort(-repeats, kind="stable"):
        n = int(repeats[k] + 1e-6)
        while n > 0 and (taken := draw(patterns[k])):
            run = min(n, *(left[length] // need for length, need in taken.items()))
            for length, need in taken.items():
                left[length] -= need * run
            packs.append((tuple(sorted(taken.elements(), reverse=True)), run))
            n -= run
    return packs


def pack_histogram(
    histogram: dict[int, int], params: PackParams
) -> list[tuple[tuple[int, ...], int]]:
    """Packs (lengths, repeats) that hold every counted piece once."""
    left = {length: n for length, n in histogram.items() if n and length < params.capacity}
    full = histogram.get(params.capacity, 0)
    packs = [((params.capacity,), full)] if full else []
    open_packs: dict[int, list[list]] = defaultdict(list)
    for lengths, n in _fitted(left, params):
        open_packs[params.capacity - sum(lengths)].append([lengths, n])
    rooms = np.zeros(params.capacity + 1, bool)
    rooms[[room for room, own in open_packs.items() if own]] = True

    def put(room, lengths, n):
        open_packs[room].append([lengths, n])
        rooms[room] = True

    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            fitting = np.flatnonzero(rooms[length:])
            if not len(fitting):
                break
            room = length + int(fitting[0])
            own = open_packs[room]
            lengths, there = own[-1]
            take = min(n, there)
            own[-1][1] -= take
            if not own[-1][1]:
                own.pop()
                rooms[room] = bool(own)
            put(room - length, (*lengths, length), take)
            n -= take
        fit = params.capacity // length
        for each, repeats in ((fit, n // fit), (n % fit, 1)):
            if each and repeats:
                put(params.capacity - each * length, (length,) * each, repeats)
    return packs + [(tuple(p), n) for own in open_packs.values() for p, n in own]


def _plan_rows(packs) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) per slot of a pack."""
    rows, used, sequence = [], defaultdict(int), 0
    for lengths, n in packs:
        offset = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + n, sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    return rows


def _ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank`` from 0 among those of the same length."""
    spark = pieces.sparkSession
    bucket_rows = max(256, isqrt(sum(histogram.values())))
    sizes = spark.createDataFrame(
        [(length, -(-n // bucket_rows)) for length, n in histogram.items()],
        "length long, buckets long",
    )  # at most one row per length
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("buckets"))
    dealt = pieces.join(F.broadcast(sizes), "length").withColumn("bucket", bucket)
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    firsts = (
        dealt.groupBy("length", "bucket")
        .count()
        .select(
            "length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first")
        )
    )
    numbered = dealt.withColumn("n", F.row_number().over(own))
    return numbered.join(firsts, ["length", "bucket"]).withColumn(
        "rank", F.col("first") + F.col("n") - 1
    )


def pack(
    docs: DataFrame, tokenizer: TokenizerSpec, params: PackParams | None = None
) -> DataFrame:
    """One row per piece with its ``sequence_id`` and ``offset``."""
    params = params or PackParams()
    pieces = materialise(tokenized_pieces(docs.select("doc_id", "text"), tokenizer, params.capacity), "pieces")
    counted = pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    histogram = {r["length"]: r["count"] for r in counted}
    plan = docs.sparkSession.createDataFrame(
        _plan_rows(pack_histogram(histogram, params)),
        "length long, lo long, hi long, sequence long, offset long",
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # The plan's size follows from the capacity, not from the number of pieces.
    placed = _ranked(pieces, histogram).join(
        F.broadcast(plan.withColumnRenamed("length", "plan_length")),
        (F.col("length") == F.col("plan_length"))
        & (F.col("rank") >= F.col("lo"))
        & (F.col("rank") < F.col("hi")),
    )
    sequence = (F.col("sequence") + F.col("rank") - F.col("lo")).alias("sequence_id")
    return placed.select(*columns, sequence, "offset")


def pack_regions(
    docs: DataFrame, tokenizer: TokenizerSpec, params: PackParams | None = None
) -> DataFrame:
    """As ``pack``, but each ``region`` of ``docs`` is packed by itself and its sequences come
    after those of smaller regions.

    Plans are made in a task per region, so regions should be small beside the input and hold many
    sequences: the last ones of a region are not filled from the next.
    """
    params = params or PackParams()
    pieces = materialise(tokenized_pieces(docs, tokenizer, params.capacity), "pieces")

    def planned(part: pd.DataFrame) -> pd.DataFrame:
        histogram = dict(zip(part["length"].tolist(), part["count"].tolist(), strict=True))
        rows = _plan_rows(pack_histogram(histogram, params))
        plan = pd.DataFrame(rows, columns=["length", "lo", "hi", "sequence", "offset"])
        return plan.assign(region=part["region"].iloc[0])

    counted = pieces.groupBy("region", "length").count()
    schema = "length long, lo long, hi long, sequence long, offset long, region int"
    plan = materialise(counted.groupBy("region").applyInPandas(planned, schema), "pack-plans")
    used = plan.groupBy("region").agg(F.max(F.col("sequence") + F.col("hi") - F.col("lo")).alias("n"))
    before = W.orderBy("region").rowsBetween(W.unboundedPreceding, -1)  # one row a region
    firsts = used.select("region", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = W.partitionBy("region", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(own) - 1)
    placed = ranked.join(plan.join(firsts, "region"), ["region", "length"]).filter(
        (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi"))
    )
    sequence = F.col("first") + F.col("sequence") + F.col("rank") - F.col("lo")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return placed.select(*columns, sequence.alias("sequence_id"), "offset")

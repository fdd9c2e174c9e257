"""Phrases of a language that stand together more often than their parts would, from suffix pointers.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words
``[^\\x20\\x09]+``. Every word begins a suffix, the words from there to the end of its piece.

1. Words are counted; those under ``least`` occurrences can be in no phrase. The rest is a sorted array in
   the shared folder, and a word's rank there is its number.
2. Neighbouring pairs of such words are counted, too: they are the leading words that suffixes are
   routed by, and a suffix whose leading words are infrequent is abandoned here, as is the rest of
   one behind an infrequent pair.
3. What is left of a suffix (three words at least, ``longest`` at most) goes to the task that its
   leading words name. Three words name it, unless their pairs are so frequent (``crowd``) that too much may
   begin with them; then the three words themselves are sent as a phrase, summed before they
   are sent, and the suffix is routed by four words or five. Equal suffixes of a task are sent once
   with their number.
4. A task sorts its suffix pointers by multikey three-way quicksort up to ``longest`` words deep. The
   size of an equal partition is the count of the words so far; a partition under ``least`` is abandoned.
5. Each cut of a phrase compares it with its two parts, by exact decimal arithmetic.

A phrase of frequency a over n words, cut into parts of frequency l and r, has the score
floor(1000 a n / (l r)); the lowest-scoring cut counts, the smallest at ties. A candidate that stands inside a longer
one which occurs in at least ``drop_percent`` percent of its places goes. Since a shorter phrase
is at least as frequent, it is enough to compare phrases with those one word longer.

Words are told apart by a 64-bit hash of their bytes and language. Null text has no words, null languages
count as ``und``, null ids do not matter, repeated rows count as often as they occur, an empty table gives
no rows. A long text is read in slices that end at a separator; a stretch without any separator is
held whole, at some 50 bytes of memory a byte. Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.llm.prefix_hash import PrefixHash
from shelfwise.llm.sorted_keys import SortedKeys, store
from shelfwise.llm.textops import _LOWER, chain, text_buffers
from shelfwise.sources.scratch import materialise

WORD, WHITE, SEPARATOR = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = WHITE
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = SEPARATOR
SLICE = 1 << 21
#: In place of a word behind the end of a suffix.
END = -1
#: Rows that are packed at once.
PIECE_ROWS = 1 << 17


@dataclass(frozen=True)
class CollocationParams:
    """``crowd``: a suffix is routed by so many words that at most this many places begin with them."""

    least: int = 100
    longest: int = 5
    top: int = 2000
    drop_percent: int = 100
    crowd: int = 1 << 16
    bucket_words: int = 1 << 22


@dataclass
class Words:
    """All words of a slice of texts, in order."""

    key: np.ndarray  # hash of language and bytes
    lang: np.ndarray  # row of the language in ``langs``
    joined: np.ndarray  # whether the next word follows in the same piece
    begin: np.ndarray
    end: np.ndarray
    data: np.ndarray
    langs: list[str]

    def text(self, i: int) -> str:
        return bytes(self.data[self.begin[i] : self.end[i]]).decode("utf-8", "replace")


def _cut(data: np.ndarray, begin: int, end: int, size: int) -> list[tuple[int, int]]:
    """Parts of about ``size`` bytes that end behind a separator."""
    out = []
    while end - begin > size:
        at = begin + size
        while at < end:
            found = np.flatnonzero(_KIND[data[at : at + size]] == SEPARATOR)
            if len(found):
                at += int(found[0]) + 1
                break
            at += size
        at = min(at, end)
        out.append((begin, at))
        begin = at
    return [*out, (begin, end)]


def words_of(batches: Iterator[pa.RecordBatch], size: int = SLICE) -> Iterator[Words]:
    """The words of all rows (text, lang), slice by slice."""
    for batch in batches:
        at, data = text_buffers(batch.column("text"))
        lang = batch.column("lang").cast(pa.string()).fill_null("und").dictionary_encode()
        code = lang.indices.to_numpy(zero_copy_only=False)
        langs = lang.dictionary.to_pylist()
        lang_key = np.array(
            [PrefixHash(np.frombuffer(x.encode(), np.uint8)).of(np.array([0]), np.array([len(x.encode())]))[0] for x in langs],
            np.uint64,
        )
        held, total = [], 0
        for row in range(batch.num_rows):
            for begin, end in _cut(data, int(at[row]), int(at[row + 1]), size):
                if total + end - begin > size and held:
                    yield _words(data, held, code, langs, lang_key)
                    held, total = [], 0
                held.append((row, begin, end))
                total += end - begin
        if held:
            yield _words(data, held, code, langs, lang_key)


def _words(data, parts, code, langs, lang_key) -> Words:
    """Words of parts that lie one behind the other."""
    base = parts[0][1]
    data = _LOWER[data[base : parts[-1][2]]]
    n = len(data)
    kind = _KIND[data]
    edge = np.zeros(n + 1, bool)
    edge[[b - base for _, b, _ in parts]] = True
    inside = kind == WORD
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    row = np.array([r for r, _, _ in parts])[np.searchsorted([b - base for _, b, _ in parts], first, "right") - 1]
    # Two words are in one piece if neither a separator nor an edge of a part lies between them.
    stops = np.cumsum((kind == SEPARATOR) | edge[:n])
    joined = np.zeros(len(first), bool)
    joined[:-1] = stops[first[1:]] == stops[first[:-1]]
    lang = code[row]
    key = chain(PrefixHash(data).of(first, last), lang_key[lang]).view(np.int64) if len(first) else np.zeros(0, np.int64)
    return Words(key, lang, joined, first, last, data, langs)


class Tally:
    """Sums of whole rows of numbers, merged whenever there are many.

    Merging holds a row some three times over, so ``limit`` bounds what rows take: by default a row of
    six numbers is merged at 262,144 rows and handed on at four times as many.
    """

    def __init__(self, width: int, limit: int | None = None):
        self.width, self.limit = width, limit or (3 << 19) // width
        self.rows: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0
        self.room = self.limit

    def add(self, rows: np.ndarray, counts: np.ndarray | None = None) -> None:
        rows, counts = _summed(rows, np.ones(len(rows), np.int64) if counts is None else counts)
        self.rows.append(rows)
        self.counts.append(counts)
        self.size += len(rows)
        if self.size > self.room:
            rows, counts = self.result()
            self.rows, self.counts, self.size = [rows], [counts], len(rows)
            self.room = max(self.limit, 2 * len(rows))

    def full(self) -> bool:
        """Whether to hand on what there is, so that a task holds a bounded number of rows."""
        return self.size > 4 * self.limit

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.rows:
            return np.zeros((0, self.width), np.int64), np.zeros(0, np.int64)
        return _summed(np.concatenate(self.rows), np.concatenate(self.counts))

    def clear(self) -> None:
        self.rows, self.counts, self.size, self.room = [], [], 0, self.limit


def _summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, with summed counts."""
    if not len(rows):
        return rows, counts
    order = np.lexsort(rows.T[::-1]) if rows.shape[1] > 1 else np.argsort(rows[:, 0], kind="stable")
    rows, counts = rows[order], counts[order]
    new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    begins = np.flatnonzero(new)
    return rows[begins], np.add.reduceat(counts, begins)


def _count_words(docs: DataFrame, params: CollocationParams) -> tuple[DataFrame, DataFrame]:
    """Frequent words (key, n, lang, word), and all words of each language (lang, n)."""

    def count(batches):
        totals: dict[str, int] = {}
        tally, texts = Tally(1), {}
        langs: dict[int, str] = {}

        def flush():
            key, n = tally.result()
            tally.clear()
            for k in range(0, len(key), 1 << 16):
                some, counts = key[k : k + (1 << 16), 0], n[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some), pa.array(counts), pa.array([langs[x] for x in some.tolist()]),
                     pa.array([texts[x] for x in some.tolist()])],
                    names=["key", "n", "lang", "word"],
                )
            texts.clear()
            langs.clear()

        for words in words_of(batches):
            for code, n in enumerate(np.bincount(words.lang, minlength=len(words.langs)).tolist()):
                totals[words.langs[code]] = totals.get(words.langs[code], 0) + n
            key, where, n = np.unique(words.key, return_index=True, return_counts=True)
            tally.add(key[:, None], n)
            for k, i in zip(key.tolist(), where.tolist(), strict=True):
                if k not in texts:
                    texts[k], langs[k] = words.text(i), words.langs[words.lang[i]]
            if len(texts) > 1 << 18:
                yield from flush()
        yield from flush()
        totals = {k: n for k, n in totals.items() if n}
        none = pa.nulls(len(totals))
        yield pa.RecordBatch.from_arrays(
            [none.cast(pa.int64()), pa.array(list(totals.values()), pa.int64()),
             pa.array(list(totals), pa.string()), none.cast(pa.string())],
            names=["key", "n", "lang", "word"],
        )

    counted = materialise(
        docs.mapInArrow(count, "key long, n long, lang string, word string")
        .groupBy("key", "lang")
        .agg(F.sum("n").alias("n"), F.first("word").alias("word")),
        "colloc-words",
    )
    words = counted.filter(F.col("key").isNotNull() & (F.col("n") >= params.least))
    return words, counted.filter("key is null").select("lang", "n")


def _packed(rows: np.ndarray, counts: np.ndarray, bucket: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of a bucket as compressed columns; within a bucket in their order."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.append(np.flatnonzero(np.diff(bucket[order], prepend=-1)), len(order))
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64()), ("width", pa.int32()), ("rows", pa.binary())])
    pieces = [
        (b, min(b + PIECE_ROWS, end)) for begin, end in zip(cuts[:-1], cuts[1:], strict=True) for b in range(begin, end, PIECE_ROWS)
    ]
    for begin, end in pieces:
        own = order[begin:end]
        columns = np.ascontiguousarray(np.column_stack([rows[own], counts[own], kind[own]]).T)
        # Steps between neighbours are small, since rows are sorted; byte planes then compress well.
        steps = np.diff(columns, axis=1, prepend=0).view(np.uint8).reshape(len(columns), -1, 8)
        planes = np.ascontiguousarray(steps.transpose(0, 2, 1)).tobytes()
        yield pa.RecordBatch.from_pydict(
            {"bucket": [int(bucket[own[0]])], "n": [len(own)], "width": [len(columns)],
             "rows": [pa.compress(planes, "zstd", asbytes=True)]},
            schema=schema,
        )


def _unpacked(n: int, width: int, rows: bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(rows, 8 * n * width, "zstd", asbytes=True), np.uint8)
    steps = np.ascontiguousarray(planes.reshape(width, 8, n).transpose(0, 2, 1)).view(np.int64)
    return np.cumsum(steps.reshape(width, n), axis=1).T


PACKED = "bucket int, n long, width int, rows binary"


def _merged_pairs(part: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows (key and two ranks) of a bucket's pieces, with summed counts."""
    tally = Tally(3)
    for n, width, rows in zip(part["n"], part["width"], part["rows"], strict=True):
        found = _unpacked(n, width, rows)
        tally.add(np.ascontiguousarray(found[:, :3]), found[:, 3])
    return tally.result()


def _together(part: pd.DataFrame, width: int, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, counts and numbers of leading words of all rows of a bucket's pieces.

    Each piece goes to its place in the whole, and a rank takes no more room than it needs.
    """
    total = int(part["n"].sum())
    words = np.empty((total, width), np.int32 if n_words < 1 << 31 else np.int64)
    counts, lead = np.empty(total, np.int64), np.empty(total, np.int8)
    at = 0
    for n, columns, rows in zip(part["n"], part["width"], part["rows"], strict=True):
        found = _unpacked(n, columns, rows)
        here = slice(at, at + n)
        words[here], counts[here], lead[here] = found[:, :width], found[:, width], found[:, width + 1]
        at += n
    return words, counts, lead


def _pair_keys(a: np.ndarray, b: np.ndarray, n_words: int) -> np.ndarray:
    """One number of two ranks."""
    if n_words < 3_000_000_000:
        return a * np.int64(n_words) + b
    return chain(a.view(np.uint64), b.view(np.uint64)).view(np.int64)


def _pairs(words: Words, lexicon: SortedKeys) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each word, whether it and the next are a pair of frequent words, and the pair's key."""
    rank, _ = lexicon.find(words.key)
    after = np.append(rank[1:], END)
    pair = words.joined & (rank >= 0) & (after >= 0)
    return rank, pair, np.where(pair, _pair_keys(rank, after, lexicon.size), -1)


def _count_pairs(docs: DataFrame, lexicon: SortedKeys, buckets: int, params: CollocationParams) -> DataFrame:
    """Frequent pairs: key, n and the two ranks."""

    def count(batches):
        tally = Tally(3)

        def flush():
            rows, n = tally.result()
            tally.clear()
            if len(rows):
                bucket = (chain(rows[:, 0].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
                yield from _packed(rows, n, bucket, np.zeros(len(rows), np.int64))

        for words in words_of(batches):
            rank, pair, key = _pairs(words, lexicon)
            at = np.flatnonzero(pair)
            own, where, n = np.unique(key[at], return_index=True, return_counts=True)
            tally.add(np.column_stack([own, rank[at[where]], rank[at[where] + 1]]), n)
            if tally.full():
                yield from flush()
        yield from flush()

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        rows, n = _merged_pairs(part)
        keep = n >= params.least
        return pd.DataFrame(
            {"key": rows[keep, 0], "a": rows[keep, 1], "b": rows[keep, 2], "n": n[keep]}
        )

    pieces = docs.mapInArrow(count, PACKED)
    merged = pieces.groupBy("bucket").applyInPandas(merge, "key long, a long, b long, n long")
    return materialise(merged, "colloc-pairs")


def frequent_prefixes(
    words: np.ndarray, weight: np.ndarray, first: int, least: int
) -> Iterator[tuple[np.ndarray, int]]:
    """Prefixes of at least ``first`` words that ``least`` of the weighted rows begin with, and how many.

    Multikey three-way quicksort: a partition is split by its words at one depth into those
    before, equal to and behind a pivot. The equal ones share one more word and go one word deeper;
    their weight is the count of that prefix. Partitions lighter than ``least`` are abandoned.
    """
    n, longest = words.shape
    order = np.arange(n)
    open_parts = [(0, n, 0)] if weight.sum() >= least else []
    while open_parts:
        begin, end, depth = open_parts.pop()
        part = order[begin:end]
        key = words[part, depth]
        ends = sorted((key[0], key[len(key) // 2], key[-1]))
        pivot = ends[1]
        before, same = key < pivot, key == pivot
        groups = [part[before], part[same], part[~(before | same)]]
        order[begin:end] = np.concatenate(groups)
        for which, group in enumerate(groups):
            size = len(group)
            total = int(weight[group].sum())
            if total >= least:
                if which != 1:
                    open_parts.append((begin, begin + size, depth))
                elif pivot != END:
                    if depth + 1 >= first:
                        yield words[group[0], : depth + 1], total
                    if depth + 1 < longest:
                        open_parts.append((begin, begin + size, depth + 1))
            begin += size


def _routed(words: Words, lexicon: SortedKeys, pairs: SortedKeys, params: CollocationParams):
    """(suffix rows, number of leading words that route each) of all suffixes of three words and more."""
    rank, pair, key = _pairs(words, lexicon)
    at = np.flatnonzero(pair)
    often = np.zeros(len(rank), np.int64)
    if len(at):
        often[at] = pairs.find(key[at])[1]
    # Places a phrase of three words and more can have, by its rarest pair, and the words that follow.
    start = np.flatnonzero((often > 0) & (np.append(often[1:], 0) > 0))
    row = np.full((len(start), params.longest), END, np.int64)
    most = np.full((len(start), params.longest + 1), 0, np.int64)
    row[:, 0], alive, rarest = rank[start], np.ones(len(start), bool), np.full(len(start), 1 << 62)
    for depth in range(1, params.longest):
        here = start + depth - 1
        n = np.where(here < len(often), often[np.minimum(here, len(often) - 1)], 0)
        alive = alive & (n > 0)
        rarest = np.minimum(rarest, n)
        row[alive, depth] = rank[np.minimum(here + 1, len(rank) - 1)][alive]
        most[alive, depth + 1] = rarest[alive]
    out = []
    left = np.ones(len(start), bool)
    for lead in range(3, params.longest + 1):
        has = left & (most[:, lead] > 0)
        crowded = has & (most[:, lead] > params.crowd) & (lead < params.longest)
        out.append((row[has & ~crowded], lead))
        alone = row[crowded].copy()
        alone[:, lead:] = END
        out.append((alone, lead))
        left = crowded
    return [(r, lead) for r, lead in out if len(r)]


def _count_phrases(
    docs: DataFrame, lexicon: SortedKeys, pairs: SortedKeys, buckets: int, params: CollocationParams
) -> DataFrame:
    """Frequent phrases of three words and more: their word keys, and n."""
    width = params.longest

    def count(batches):
        tally = Tally(width + 1)

        def flush():
            rows, n = tally.result()
            tally.clear()
            if not len(rows):
                return
            lead = rows[:, 0]
            leading = np.where(np.arange(width) < lead[:, None], rows[:, 1:], END)
            spread = chain(*[np.ascontiguousarray(c).view(np.uint64) for c in leading.T])
            bucket = (spread % np.uint64(buckets)).astype(np.int32)
            yield from _packed(rows[:, 1:], n, bucket, lead)

        for words in words_of(batches):
            for rows, lead in _routed(words, lexicon, pairs, params):
                tally.add(np.column_stack([np.full(len(rows), lead), rows]))
            if tally.full():
                yield from flush()
        yield from flush()

    def sort(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        words, weight, leading = _together(part, width, lexicon.size)
        phrases, counts = [], []
        for lead in np.unique(leading).tolist():
            own = np.flatnonzero(leading == lead)
            rows, n_rows = (words, weight) if len(own) == len(words) else (words[own], weight[own])
            for prefix, n in frequent_prefixes(rows, n_rows, lead, params.least):
                phrases.append(prefix)
                counts.append(n)
        if not phrases:
            return pd.DataFrame({"words": pd.Series([], dtype=object), "n": pd.Series([], dtype="int64")})
        sizes = np.array([len(p) for p in phrases])
        keys = np.split(lexicon.keys_at(np.concatenate(phrases)), np.cumsum(sizes)[:-1])
        return pd.DataFrame({"words": keys, "n": counts})

    pieces = docs.mapInArrow(count, PACKED)
    return pieces.groupBy("bucket").applyInPandas(sort, "words array<long>, n long")


def frequent_phrases(docs: DataFrame, params: CollocationParams) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of one word and more (words, n), frequent words, and the words of each language."""
    docs = docs.select("text", "lang")
    words, totals = _count_words(docs, params)
    words = materialise(words, "colloc-frequent")
    lexicon = store(words, "colloc-word-keys")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-n_words // params.bucket_words))
    pairs = _count_pairs(docs, lexicon, buckets, params)
    pair_keys = store(pairs, "colloc-pair-keys")
    longer = _count_phrases(docs, lexicon, pair_keys, buckets, params)
    single = words.select(F.array("key").alias("words"), "n")

    def named(batches):
        for batch in batches:
            a, b = (lexicon.keys_at(batch.column(c).to_numpy()) for c in ("a", "b"))
            both = np.column_stack([a, b]).ravel()
            at = pa.array(np.arange(0, len(both) + 1, 2), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(at, pa.array(both)), batch.column("n")], names=["words", "n"]
            )

    two = pairs.select("a", "b", "n").mapInArrow(named, "words array<long>, n long")
    phrases = materialise(single.unionByName(two).unionByName(longer), "colloc-phrases")
    return phrases, words, totals


def collocations(docs: DataFrame, params: CollocationParams | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language."""
    params = params or CollocationParams()
    phrases, words, totals = frequent_phrases(docs, params)
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    size = F.size("words")
    candidates = phrases.filter(size >= 2).withColumnRenamed("n", "a")
    shorter = F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1)))
    inside = candidates.filter(size >= 3).select(shorter.alias("words"), "a")
    inside = inside.groupBy("words").agg(F.max("a").alias("longer"))
    kept = candidates.join(inside, "words", "left").filter(
        F.col("longer").isNull()
        | (whole("longer") * F.lit(100).cast("decimal(5,0)") < whole("a") * F.lit(params.drop_percent).cast("decimal(5,0)"))
    )
    kept = kept.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    left = phrases.select(F.col("words").alias("left"), F.col("n").alias("l"))
    right = phrases.select(F.col("words").alias("right"), F.col("n").alias("r"))
    cuts = kept.withColumns(
        {
            "left": F.slice("words", F.lit(1), F.col("k")),
            "right": F.slice("words", F.col("k") + 1, size - F.col("k")),
        }
    )
    cuts = cuts.join(left, "left").join(right, "right").drop("left", "right")
    head = words.select(F.col("key").alias("head"), "lang")
    totals = totals.select("lang", F.col("n"))
    cuts = cuts.withColumn("head", F.element_at("words", 1)).join(head, "head").join(totals, "lang")
    cuts = cuts.withColumns({"product": whole("a") * whole("n"), "parts": whole("l") * whole("r")})
    thousand = F.col("product") * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.withColumn("top", thousand).withColumn("score", F.expr("top div parts"))
    lowest = cuts.groupBy("words").agg(
        F.min(F.struct("score", "k", "l", "r", "lang", "a", "n")).alias("cut")
    )
    scored = lowest.select("words", "cut.*")
    # Ties at the last place stay until the phrases can be read.
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near_top = scored.withColumn("place", F.rank().over(order)).filter(F.col("place") <= params.top)
    near_top = materialise(near_top.drop("place"), "colloc-top")
    spelled = near_top.select("words", F.posexplode("words").alias("at", "key"))
    spelled = spelled.join(words.select("key", "word"), "key")
    phrase = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    spelled = spelled.groupBy("words").agg(phrase.alias("phrase"))
    final = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    out = near_top.join(spelled, "words").withColumn("rank", F.row_number().over(final).cast("long"))
    return out.filter(F.col("rank") <= params.top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

"""Text scores by an interpolated modified Kneser-Ney model of order two or three.

Spark counts, sorted arrays of hashes and keys hold the model, and workers map them into memory.

1. Words of the training texts are counted by hash and sorted; a word's rank is its number.
2. A bigram is the key (rank << 32) + rank, after the document's begin mark or a word. Tasks count their
   own bigrams and hand them to shards that follow the order of keys. Shard limits come from
   the word counts, so every shard gets the same mass and a frequent word's bigrams span several.
   A shard is a sorted array of keys, in two levels, and an array of counts.
3. Per word, bigram shards give the numbers of its followers seen once, twice and more, and the
   number of its different predecessors. Summed over shards they make, next to the word shards,
   the weight left to the lower order and the lower-order probability.
4. Scoring looks up sorted keys of a slice of texts shard by shard.

With order three a document has two begin marks. Trigrams are counted first, by the key of their first two words
and the rank of the third (a rank is the place of the word's hash in its sorted array). A shard holds whole
contexts as sorted arrays in three levels: first words, the second words of each, the third words of
each pair with their counts; what follows a context of several third words is summed beside them. Each different trigram then counts once for its last two words
(after a begin mark as often as it occurs), and bigrams go on as above with these counts.

Two ranks share a 64-bit key, so more than 2**31 - 2 different words are an error.

Discounts are the usual closed forms from counts of counts, with fixed values where a count is
zero. The lower order is interpolated with the uniform distribution over the words and one unknown.
Null or empty text is the end mark alone. Without training rows every probability is one and the
scores are 0. Repeated rows are scored alike and count as often as they occur. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.arrays import open_array, write_array
from shelfwise.llm.textops import crc_fold, slices, word_hashes
from shelfwise.sources.scratch import materialise, scratch_path

END = np.uint64(0x656E64206D61726B).view(np.int64)


@dataclass(frozen=True)
class LmParams:
    """``shard_tokens`` is the mass of a shard of bigrams or trigrams, ``word_rows`` the size of a word
    shard."""

    shard_tokens: int = 2_000_000
    word_rows: int = 500_000
    order: int = 2


@dataclass
class LmModel:
    root: str
    word_first: np.ndarray  # first hash of each word shard
    word_offset: np.ndarray  # rank of the first word of each shard, then V
    key_first: np.ndarray  # first key of each bigram shard
    n_tokens: int
    discounts: np.ndarray
    unknown: float = 1.0
    shards: list[int] | None = None
    key_shards: list[int] | None = None
    begin_weight: float = 1.0
    n_docs: int = 0
    order: int = 2
    trigram_first: np.ndarray | None = None  # first context of each trigram shard
    trigram_shards: list[int] | None = None
    trigram_discounts: np.ndarray | None = None

    @property
    def n_words(self) -> int:
        return int(self.word_offset[-1])


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all rows, each row closed by the end mark, and where each row ends."""
    words, first = word_hashes(part.column("text"))
    rows = part.num_rows
    ends = first[1:] + np.arange(1, rows + 1)
    tokens = np.full(len(words) + rows, END)
    inside = np.ones(len(tokens), bool)
    inside[ends - 1] = False
    tokens[inside] = words.view(np.int64)
    return tokens, ends


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    begins = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
    return key[begins], np.add.reduceat(count, begins) if len(key) else count


class _Counter:
    """Counts of keys, merged whenever the pieces outgrow what is merged already."""

    def __init__(self):
        self.keys, self.counts, self.size, self.limit = [], [], 0, 1 << 21

    def add(self, keys: np.ndarray) -> None:
        own, count = np.unique(keys, return_counts=True)
        self.keys.append(own)
        self.counts.append(count)
        self.size += len(own)
        if self.size > self.limit:
            key, count = self.result()
            self.keys, self.counts, self.size = [key], [count], len(key)
            self.limit = max(1 << 21, 2 * len(key))

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        return _merged(self.keys, self.counts)


def _count_words(train: DataFrame, root: str, params: LmParams) -> pd.DataFrame:
    """Writes the word shards; (shard, first hash, rows, tokens) of each."""

    def count(batches):
        counter = _Counter()
        for batch in batches:
            for part in slices(batch):
                counter.add(_tokens(part)[0])
        key, n = counter.result()
        for k in range(0, len(key), 1 << 18):
            s = slice(k, k + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(key[s]), pa.array(n[s])], names=["h", "n"])

    words = train.select("text").mapInArrow(count, "h long, n long")
    words = materialise(words.groupBy("h").agg(F.sum("n").alias("n")), "lm-words")
    n_shards = max(1, -(-words.count() // params.word_rows))
    ordered = words.repartitionByRange(n_shards, "h").sortWithinPartitions("h")

    def write(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        found = [(b.column("h").to_numpy(), b.column("n").to_numpy()) for b in batches if b.num_rows]
        if found:
            h, n = (np.concatenate(c) for c in zip(*found, strict=True))
            write_array(root, f"word-{shard}", h)
            write_array(root, f"count-{shard}", _narrow(n))
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "first": [int(h[0])], "size": [len(h)], "tokens": [int(n.sum())]}
            )

    schema = "shard long, first long, size long, tokens long"
    return ordered.mapInArrow(write, schema).toPandas().sort_values("first", ignore_index=True)


class _Lexicon:
    """Ranks of word hashes over the mapped word shards."""

    def __init__(self, root: str, shards: list[int], first: np.ndarray, offset: np.ndarray):
        self._root, self._shards, self._first, self._offset = root, shards, first, offset

    def ranks(self, tokens: np.ndarray) -> np.ndarray:
        """Rank per token, -1 for unknown ones."""
        own, at = np.unique(tokens, return_inverse=True)
        rank = np.full(len(own), -1, np.int64)
        for k, begin, end in _runs(self._first, own):
            words = open_array(self._root, f"word-{self._shards[k]}")
            place = np.minimum(np.searchsorted(words, own[begin:end]), len(words) - 1)
            known = words[place] == own[begin:end]
            rank[begin:end] = np.where(known, place + self._offset[k], -1)
        return rank[at]

    def values(self, name: str, ranks: np.ndarray) -> np.ndarray:
        """A value per rank, from the arrays next to the word shards."""
        order = np.argsort(ranks, kind="stable")
        asked, out = ranks[order], np.zeros(len(ranks))
        for k, begin, end in _runs(self._offset[:-1], asked):
            array = open_array(self._root, f"{name}-{self._shards[k]}")
            out[order[begin:end]] = array[asked[begin:end] - self._offset[k]]
        return out


def _runs(first: np.ndarray, ordered: np.ndarray):
    """(shard, begin, end) of the sorted values that fall to each shard."""
    cuts = np.searchsorted(ordered, first)
    cuts[:1] = 0
    ends = np.append(cuts[1:], len(ordered))
    for k in np.flatnonzero(ends > cuts):
        yield int(k), int(cuts[k]), int(ends[k])


def _shard_of(keys: np.ndarray, mass_before, mass, n_words: int, params: LmParams) -> np.ndarray:
    """Shard of a bigram: monotone in the key, and even in mass but for the word that follows."""
    inside = (keys & np.int64(0xFFFFFFFF)) / max(1, n_words)
    return ((mass_before + mass * inside) // params.shard_tokens).astype(np.int64)


def _bigram_keys(rank: np.ndarray, ends: np.ndarray, n_words: int) -> np.ndarray:
    """Key per token; the begin mark has the rank after the last word's. -1 if a word is unknown."""
    before = np.empty_like(rank)
    before[1:] = rank[:-1]
    before[0] = n_words
    before[ends[:-1]] = n_words
    return np.where((rank >= 0) & (before >= 0), (before << np.int64(32)) + rank, -1)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and more."""
    usual = np.array([0.0, 0.5, 1.0, 1.5])
    if min(n1, n2, n3, n4) <= 0:
        return usual
    y = n1 / (n1 + 2 * n2)
    d = np.array([0.0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
    return np.where((d >= 0) & (d <= np.arange(4)), d, usual)


def _planes(values: np.ndarray) -> bytes:
    """Compressed byte planes of 64-bit values."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _from_planes(n: int, packed: bytes) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 8 * n, "zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.int64).ravel()


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0))))


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Sorted keys as compressed steps, and compressed counts behind the size of one in bytes."""
    narrow = _narrow(counts)
    packed = pa.compress(narrow.tobytes(), "zstd", asbytes=True)
    return _planes(np.diff(keys, prepend=0)), bytes([narrow.itemsize]) + packed


def _unpack(n: int, keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    count = pa.decompress(counts[1:], counts[0] * n, "zstd", asbytes=True)
    count = np.frombuffer(count, f"u{counts[0]}").astype(np.int64)
    return np.cumsum(_from_planes(n, keys)), count


def _merged_trigrams(
    context: np.ndarray, word: np.ndarray, count: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (context, word) and their summed counts."""
    if not len(context):
        return context, word, count
    order = np.lexsort((word, context))
    context, word, count = context[order], word[order], count[order]
    new = np.append(True, (context[1:] != context[:-1]) | (word[1:] != word[:-1]))
    begins = np.flatnonzero(new)
    return context[begins], word[begins], np.add.reduceat(count, begins)


class _TrigramCounter:
    """Counts of (context, word), merged whenever the pieces outgrow what is merged already."""

    def __init__(self):
        self.parts, self.size, self.limit = [], 0, 1 << 21

    def add(self, context: np.ndarray, word: np.ndarray) -> None:
        self.parts.append((context, word, np.ones(len(word), np.int64)))
        self.size += len(word)
        if self.size > self.limit:
            part = self.result()
            self.parts, self.size = [part], len(part[0])
            self.limit = max(1 << 21, 2 * self.size)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        return _merged_trigrams(*(np.concatenate(c) for c in zip(*self.parts, strict=True)))


def _trigram_keys(rank: np.ndarray, ends: np.ndarray, n_words: int) -> np.ndarray:
    """Key of the two marks or words before each token, -1 if one of them is unknown."""
    one, two = np.full(len(rank), n_words), np.full(len(rank), n_words)
    one[1:], two[2:] = rank[:-1], rank[:-2]
    begins = np.append(0, ends[:-1])
    one[begins] = two[begins] = n_words
    second = begins + 1
    two[second[second < len(two)]] = n_words
    # A text of one token is followed by the next text's begin, already set.
    two[begins] = n_words
    return np.where((one >= 0) & (two >= 0), (two << np.int64(32)) + one, -1)


def _write_pairs(root: str, name: str, shard: int, keys: np.ndarray) -> None:
    """Sorted keys of two ranks in two levels: first ranks, and the second ranks of each."""
    one = keys >> np.int64(32)
    heads = np.flatnonzero(np.append(True, one[1:] != one[:-1]))
    write_array(root, f"{name}-one-{shard}", one[heads].astype(np.uint32))
    write_array(root, f"{name}-at-{shard}", np.append(heads, len(keys)).astype(np.uint32))
    write_array(root, f"{name}-two-{shard}", (keys & np.int64(0xFFFFFFFF)).astype(np.uint32))


def _pair_places(root: str, name: str, shard: int, keys: np.ndarray) -> np.ndarray:
    """Place of each key among those of ``_write_pairs``, -1 if it is not there."""
    one, at, two = (open_array(root, f"{name}-{level}-{shard}") for level in ("one", "at", "two"))
    head = keys >> np.int64(32)
    place = np.minimum(np.searchsorted(one, head.astype(np.uint32)), len(one) - 1)
    end = np.where(one[place] == head, at[place + 1], at[place])
    return _find(two, at[place], end, keys & np.int64(0xFFFFFFFF))


def _write_counts(root: str, name: str, shard: int, counts: np.ndarray) -> None:
    """Counts in a byte each; those from 255 on stand apart, with their places."""
    great = np.flatnonzero(counts >= 255)
    write_array(root, f"{name}-{shard}", np.minimum(counts, 255).astype(np.uint8))
    write_array(root, f"{name}-great-at-{shard}", great.astype(np.uint32))
    write_array(root, f"{name}-great-{shard}", counts[great].astype(np.int64))


def _counts_at(root: str, name: str, shard: int, place: np.ndarray) -> np.ndarray:
    n = open_array(root, f"{name}-{shard}")[place].astype(np.int64)
    great = np.flatnonzero(n == 255)
    if len(great):
        at = open_array(root, f"{name}-great-at-{shard}")
        row = np.searchsorted(at, place[great].astype(np.uint32))
        n[great] = open_array(root, f"{name}-great-{shard}")[row]
    return n


def _write_trigrams(root: str, shard: int, context: np.ndarray, word: np.ndarray, n: np.ndarray) -> None:
    """Sorted trigrams of a shard: contexts in two levels, then words and counts. Most contexts have one
    word; for the others stand how many words more they and those before them have, and sums."""
    begins = np.flatnonzero(np.append(True, context[1:] != context[:-1]))
    size = np.diff(np.append(begins, len(word)))
    many = np.flatnonzero(size > 1)
    _write_pairs(root, "context", shard, context[begins])
    write_array(root, f"many-{shard}", many.astype(np.uint32))
    write_array(root, f"more-{shard}", np.append(0, np.cumsum(size[many] - 1)).astype(np.uint32))
    _write_counts(root, "follow", shard, np.add.reduceat(n, begins)[many])
    for c in (1, 2, 3):
        own = np.add.reduceat((np.minimum(n, 3) == c).astype(np.int64), begins)
        _write_counts(root, f"follow{c}", shard, own[many])
    write_array(root, f"three-{shard}", word.astype(np.uint32))
    _write_counts(root, "trigram", shard, n)


def _find(values: np.ndarray, low: np.ndarray, high: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Place of each value asked for within its own sorted range of ``values``, -1 if not there."""
    begin, end = low.astype(np.int64), high.astype(np.int64)
    for _ in range(int((end - begin).max(initial=0)).bit_length()):
        middle = (begin + end) >> 1
        less = (begin < end) & (values[np.minimum(middle, len(values) - 1)] < asked)
        begin, end = np.where(less, middle + 1, begin), np.where(less, end, middle)
    place = np.minimum(begin, len(values) - 1)
    return np.where((begin < high) & (values[place] == asked), place, -1)


_FACTS = ("first", "n1", "n2", "n3", "n4")


def _facts(first: int, counts: np.ndarray) -> dict[str, int]:
    return {"first": int(first)} | {f"n{c}": int((counts == c).sum()) for c in (1, 2, 3, 4)}


def train(docs: DataFrame, params: LmParams | None = None) -> LmModel:
    """Counts all of ``docs`` and writes the model's arrays to the shared folder."""
    params = params or LmParams()
    if params.order not in (2, 3):
        raise ValueError(f"order is {params.order}, not 2 or 3")
    spark = docs.sparkSession
    root = scratch_path(spark, "lm")
    none = np.zeros(0, np.int64)
    n_docs = docs.count()
    if not n_docs:
        return LmModel(root, none, np.zeros(1, np.int64), none, 0, np.zeros(4))
    words = _count_words(docs, root, params)
    shards = words["shard"].tolist()
    first = words["first"].to_numpy()
    offset = np.append(0, words["size"].cumsum()).astype(np.int64)
    mass = np.append(0, words["tokens"].cumsum()).astype(np.int64)
    n_words, n_tokens = int(offset[-1]), int(mass[-1])
    if n_words >= (1 << 31) - 1:
        raise ValueError(f"{n_words} different words do not fit into a key of two")
    lexicon = _Lexicon(root, shards, first, offset)

    def mass_before(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Training tokens of smaller ranks, and of the rank itself; ranks are sorted."""
        before, own = np.full(len(ranks), n_tokens), np.full(len(ranks), n_docs)
        real = int(np.searchsorted(ranks, n_words))
        for k, begin, end in _runs(offset[:-1], ranks[:real]):
            n = np.asarray(open_array(root, f"count-{shards[k]}")).astype(np.int64)
            total = np.append(0, np.cumsum(n)) + mass[k]
            place = ranks[begin:end] - offset[k]
            before[begin:end], own[begin:end] = total[place], n[place]
        return before, own

    piece_type = "shard long, n long, keys binary, words binary, counts binary"
    piece_schema = pa.schema(
        [("shard", pa.int64()), ("n", pa.int64()), *[(c, pa.binary()) for c in ("keys", "words", "counts")]]
    )

    def shards_of(keys: np.ndarray):
        """(shard, slice) of sorted keys."""
        before, own = mass_before(keys >> np.int64(32))
        shard = _shard_of(keys, before, own, n_words, params)
        cuts = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(keys))
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
            yield int(shard[begin]), slice(int(begin), int(end))

    def bigram_pieces(keys: np.ndarray, counts: np.ndarray):
        for shard, s in shards_of(keys):
            packed = _pack(keys[s], counts[s])
            yield {"shard": shard, "n": s.stop - s.start, "keys": packed[0], "words": None, "counts": packed[1]}

    def count(batches):
        counter = _Counter()
        for batch in batches:
            for part in slices(batch):
                tokens, ends = _tokens(part)
                if len(tokens):
                    counter.add(_bigram_keys(lexicon.ranks(tokens), ends, n_words))
        for piece in bigram_pieces(*counter.result()):
            yield pa.RecordBatch.from_pylist([piece], schema=piece_schema)

    def count_trigrams(batches):
        counter = _TrigramCounter()
        for batch in batches:
            for part in slices(batch):
                tokens, ends = _tokens(part)
                if len(tokens):
                    rank = lexicon.ranks(tokens)
                    counter.add(_trigram_keys(rank, ends, n_words), rank)
        context, word, n = counter.result()
        for shard, s in shards_of(context):
            packed = _pack(context[s], n[s])
            piece = {"shard": shard, "n": s.stop - s.start, "keys": packed[0]}
            piece |= {"words": _planes(np.ascontiguousarray(word[s])), "counts": packed[1]}
            yield pa.RecordBatch.from_pylist([piece], schema=piece_schema)

    def merge_trigrams(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        found = _TrigramCounter()
        for r in part.itertuples():
            keys, counts = _unpack(r.n, r.keys, r.counts)
            found.parts.append((keys, _from_planes(r.n, r.words), counts))
        context, word, n = found.result()
        shard = key[0]
        _write_trigrams(root, shard, context, word, n)
        facts = np.array(list(_facts(context[0], n).values()), np.int64).tobytes()
        middle = context & np.int64(0xFFFFFFFF)
        left = np.where(middle == n_words, n, 1)
        suffix, counts = _merged([(middle << np.int64(32)) + word], [left])
        fact = {"shard": -1 - shard, "n": 0, "keys": facts, "words": None, "counts": None}
        return pd.DataFrame([fact, *bigram_pieces(suffix, counts)])

    texts = docs.select("text")
    if params.order == 2:
        pieces = texts.mapInArrow(count, piece_type)
    else:
        pieces = texts.mapInArrow(count_trigrams, piece_type)
        pieces = pieces.groupBy("shard").applyInPandas(merge_trigrams, piece_type)

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        shard = key[0]
        none = dict.fromkeys(columns, 0)
        if shard < 0:  # facts of a trigram shard, passed on
            facts = np.frombuffer(part["keys"].iloc[0], np.int64).tolist()
            fact = none | {"rank": shard, "level": 3} | dict(zip(_FACTS, facts, strict=True))
            return pd.DataFrame([fact])[columns]
        found = [_unpack(r.n, r.keys, r.counts) for r in part.itertuples()]
        keys, counts = _merged(*map(list, zip(*found, strict=True)))
        _write_pairs(root, "pair", shard, keys)
        _write_counts(root, "bigram", shard, counts)
        before, after = keys >> np.int64(32), keys & np.int64(0xFFFFFFFF)
        begins = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        classes = np.minimum(counts, 3)
        follow = [np.add.reduceat((classes == c).astype(np.int64), begins) for c in (1, 2, 3)]
        word, seen = np.unique(after, return_counts=True)
        n, m = len(begins), len(word)
        zero = np.zeros(m, np.int64)
        out = pd.DataFrame(
            none
            | {
                "rank": np.concatenate([before[begins], word]),
                **{f"f{c}": np.concatenate([follow[c - 1], zero]) for c in (1, 2, 3)},
                "mass": np.concatenate([np.add.reduceat(counts, begins), zero]),
                "preceding": np.concatenate([np.zeros(n, np.int64), seen]),
            }
        )
        fact = none | {"rank": -1 - shard, "level": 2} | _facts(keys[0], counts)
        return pd.concat([out, pd.DataFrame([fact])])[columns]

    summed = ("f1", "f2", "f3", "mass", "preceding")
    columns = ["rank", *summed, "level", *_FACTS]
    merged = materialise(
        pieces.groupBy("shard").applyInPandas(merge, ", ".join(f"{c} long" for c in columns)),
        "lm-bigrams",
    )
    every = merged.filter("rank < 0").toPandas().sort_values("first")  # one row per shard
    facts, trigram_facts = every[every["level"] == 2], every[every["level"] == 3]
    discounts = _discounts(*[int(facts[f"n{c}"].sum()) for c in (1, 2, 3, 4)])
    sums = [F.sum(c).alias(c) for c in summed]
    per_word = merged.filter("rank >= 0").groupBy("rank").agg(*sums)
    per_word = materialise(per_word, "lm-per-word")
    seen = per_word.filter("preceding > 0").agg(
        F.sum("preceding"), *[F.count_if(F.col("preceding") == c) for c in (1, 2, 3, 4)], F.count("*")
    )
    bigrams, *low_counts, n_seen = seen.first()
    low = _discounts(*low_counts)
    more = n_seen - low_counts[0] - low_counts[1]
    left = low[1] * low_counts[0] + low[2] * low_counts[1] + low[3] * more
    unknown = left / bigrams / (n_words + 1)
    model = LmModel(
        root,
        first,
        offset,
        facts["first"].to_numpy(),
        n_tokens,
        discounts,
        float(unknown),
        shards,
        (-1 - facts["rank"]).tolist(),
        order=params.order,
        trigram_first=trigram_facts["first"].to_numpy(),
        trigram_shards=(-1 - trigram_facts["rank"]).tolist(),
        trigram_discounts=_discounts(*[int(trigram_facts[f"n{c}"].sum()) for c in (1, 2, 3, 4)]),
    )

    shard_rows = spark.createDataFrame(
        [(k, int(offset[k]), int(offset[k + 1])) for k in range(len(shards))],
        "k int, low long, high long",
    )
    begin_rank = F.col("rank") == n_words
    cuts = F.array(*[F.lit(int(o)) for o in offset[1:-1]]).cast("array<long>")
    k = F.size(F.filter(cuts, lambda o: o <= F.col("rank"))).cast("int")
    rows = per_word.filter(~begin_rank).withColumn("k", k).unionByName(
        shard_rows.select(
            F.lit(-1).cast("long").alias("rank"),
            *[F.lit(0).cast("long").alias(c) for c in summed],
            "k",
        )
    )

    def finish(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        k = key[0]
        part = part[part["rank"] >= 0]
        place = part["rank"].to_numpy() - offset[k]
        if params.order == 2:
            total = np.asarray(open_array(root, f"count-{shards[k]}"))
        else:
            total = np.zeros(int(offset[k + 1] - offset[k]), np.int64)
            total[place] = part["mass"].to_numpy()
            write_array(root, f"total-{shards[k]}", _narrow(total))
        weight = np.ones(len(total))
        lost = sum(discounts[c] * part[f"f{c}"].to_numpy() for c in (1, 2, 3))
        followed = lost > 0
        weight[place[followed]] = lost[followed] / total[place[followed]]
        n = np.zeros(len(total), np.int64)
        n[place] = part["preceding"].to_numpy()
        lower = np.maximum(n - low[np.minimum(n, 3)], 0) / bigrams + unknown
        write_array(root, f"weight-{shards[k]}", weight)
        write_array(root, f"lower-{shards[k]}", lower)
        return pd.DataFrame({"k": [k]}).astype("int32")

    rows.groupBy("k").applyInPandas(finish, "k int").count()
    begin = per_word.filter(begin_rank).first()
    lost = sum(discounts[c] * (begin[f"f{c}"] if begin else 0) for c in (1, 2, 3))
    model.begin_weight, model.n_docs = (lost / n_docs if lost else 1.0), n_docs
    return model


def _score(model: LmModel, tokens: np.ndarray, ends: np.ndarray):
    """Per row: known tokens, base score and model score."""
    begins = np.append(0, ends[:-1])
    if not model.n_words:
        zero = np.zeros(len(ends))
        return zero.astype(np.int64), zero, zero
    lexicon = _Lexicon(model.root, model.shards, model.word_first, model.word_offset)
    rank = lexicon.ranks(tokens)
    known = rank >= 0
    count, lower = np.zeros(len(rank)), np.full(len(rank), model.unknown)
    count[known] = lexicon.values("count", rank[known])
    lower[known] = lexicon.values("lower", rank[known])
    weight, total = np.ones(len(rank)), np.ones(len(rank))
    own = np.ones(len(rank))
    own[known] = lexicon.values("weight", rank[known])
    follows = count
    if model.order == 3:
        follows = np.zeros(len(rank))
        follows[known] = lexicon.values("total", rank[known])
    weight[1:], total[1:] = own[:-1], follows[:-1]
    weight[begins], total[begins] = model.begin_weight, model.n_docs
    keys = _bigram_keys(rank, ends, model.n_words)
    asked, at = np.unique(keys, return_inverse=True)
    held = np.zeros(len(asked))
    skip = int(asked[0] < 0)
    for k, begin, end in _runs(model.key_first, asked[skip:]):
        shard, wanted = model.key_shards[k], asked[skip + begin : skip + end]
        place = _pair_places(model.root, "pair", shard, wanted)
        n = _counts_at(model.root, "bigram", shard, np.maximum(place, 0))
        held[skip + begin : skip + end] = np.where(
            place >= 0, n - model.discounts[np.minimum(n, 3)], 0.0
        )
    p = held[at] / np.maximum(total, 1) + weight * lower
    if model.order == 3:
        p = _after_two(model, rank, ends, p)
    base = np.log10((count + 1) / (model.n_tokens + model.n_words + 1))
    sums = lambda x: np.add.reduceat(x, begins)
    return sums(known.astype(np.int64)), sums(base), sums(np.log10(p))


def _in_shard(
    model: LmModel, shard: int, context: np.ndarray, word: np.ndarray, lower: np.ndarray
) -> np.ndarray:
    """Probabilities of words after contexts that fall to ``shard``."""

    out, root, d = lower.copy(), model.root, model.trigram_discounts
    pair = _pair_places(root, "context", shard, context)
    at = np.flatnonzero(pair >= 0)
    if not len(at):
        return out
    pair = pair[at]
    many, more = open_array(root, f"many-{shard}"), open_array(root, f"more-{shard}")
    row = np.searchsorted(many, pair.astype(np.uint32))
    after = np.searchsorted(many, (pair + 1).astype(np.uint32))
    begin, end = pair + more[row], pair + 1 + more[after]
    alone = _counts_at(root, "trigram", shard, begin)
    total, lost = alone.astype(float), d[np.minimum(alone, 3)]
    several = after > row
    if several.any():
        row = row[several]
        total[several] = _counts_at(root, "follow", shard, row)
        lost[several] = sum(d[c] * _counts_at(root, f"follow{c}", shard, row) for c in (1, 2, 3))
    third = _find(open_array(root, f"three-{shard}"), begin, end, word[at])
    count = _counts_at(root, "trigram", shard, np.maximum(third, 0))
    held = np.where(third >= 0, count - d[np.minimum(count, 3)], 0.0)
    out[at] = (held + lost * lower[at]) / total
    return out


def _after_two(model: LmModel, rank: np.ndarray, ends: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Probabilities after two words, from those after one."""
    context = _trigram_keys(rank, ends, model.n_words)
    order = np.argsort(context, kind="stable")
    context, word, p = context[order], rank[order], lower[order]
    skip = int(np.searchsorted(context, 0))
    for k, begin, end in _runs(model.trigram_first, context[skip:]):
        shard = model.trigram_shards[k]
        s = slice(skip + begin, skip + end)
        p[s] = _in_shard(model, shard, context[s], word[s], p[s])
    out = np.empty_like(p)
    out[order] = p
    return out


def score(docs: DataFrame, model: LmModel) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score and score (log10) of every row."""

    def rows(batches):
        for batch in batches:
            for part in slices(batch):
                tokens, ends = _tokens(part)
                n_known, base, own = _score(model, tokens, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(ends, prepend=0)),
                        pa.array(n_known),
                        pa.array(base),
                        pa.array(own),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    schema = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(rows, schema)


def held_out(doc_id: Column) -> Column:
    """Rows that the model must not learn from."""
    return crc_fold(doc_id, 7) == 2

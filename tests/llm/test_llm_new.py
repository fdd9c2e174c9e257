"""Collocations, suffix dedup and hard negatives against plain versions."""

import hashlib
import math
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from brute import LOWER
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare as comparing
from shelfwise.llm import collocations, hard_negatives, suffix_dedup
from shelfwise.llm.deep_shallow import as_words, deep_shallow_sort
from shelfwise.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def phrases_of(rows, least, longest):
    """Counts of all phrases of one word to ``longest``, by language, and the words of each."""
    count, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    count[lang][tuple(words[i : i + k])] += 1
    return count, total


def plain_collocations(rows, least=100, longest=5, top=2000, drop=100):
    count, total = phrases_of(rows, least, longest)
    out = []
    for lang, f in count.items():
        n = total[lang]
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {}
        for p, a in good.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        inside[p[i:j]] = max(inside.get(p[i:j], 0), a)
        ranked = []
        for p, a in good.items():
            if 100 * inside.get(p, 0) >= drop * a:
                continue
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def found_collocations(docs, **params):
    rows = collocations.collocations(docs, collocations.CollocationParams(**params)).collect()
    return sorted(tuple(r) for r in rows)


@pytest.mark.parametrize("params", [
    {"least": 3, "top": 300},
    {"least": 2, "top": 50, "longest": 4, "crowd": 1, "bucket_words": 500, "drop_percent": 80},
    {"least": 4, "longest": 6, "crowd": 5},
])
def test_collocations_equal_brute_force(docs, params):
    rows = [(r.text, r.lang) for r in docs.select("text", "lang").collect()]
    kept = {k: v for k, v in params.items() if k not in ("crowd", "bucket_words", "drop_percent")}
    wanted = plain_collocations(rows, drop=params.get("drop_percent", 100), **kept)
    assert wanted and found_collocations(docs, **params) == wanted


def test_collocations_odd_rows(spark, odd, empty, monkeypatch):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert found_collocations(odd, least=2) == plain_collocations(rows, least=2)
    assert found_collocations(empty, least=2) == []
    # Slices end at separators; nothing is cut, joined or counted twice there.
    monkeypatch.setattr(collocations, "SLICE", 64)
    text = "New York, new york; of the of the of the of the\tend. " * 40 + "ÄÖ x\x0bÄÖ x É" * 9
    data = [(text, None), (text.upper(), "und"), ("", "xx"), (None, "xx")]
    table = spark.createDataFrame(data, "text string, lang string").withColumn("words", F.lit(1)).withColumn("n", F.lit("x"))
    assert found_collocations(table, least=3) == plain_collocations(data, least=3)


def test_three_way_quicksort_counts_prefixes():
    random = np.random.default_rng(4)
    words = random.integers(0, 5, size=(4000, 5))
    words[np.arange(5)[None, :] >= random.integers(1, 6, size=4000)[:, None]] = collocations.END
    weight = random.integers(1, 4, size=4000)
    wanted = Counter()
    for row, w in zip(words.tolist(), weight.tolist(), strict=True):
        for k in range(2, 6):
            if collocations.END not in row[:k]:
                wanted[tuple(row[:k])] += w
    found = {tuple(p.tolist()): n for p, n in collocations.frequent_prefixes(words, weight, 2, 30)}
    assert found == {p: n for p, n in wanted.items() if n >= 30}


def test_collocation_tasks_hold_few_copies_of_their_rows():
    """A task's rows are handed on by and by, and sorted from one array with little room a row."""
    random, width, n = np.random.default_rng(5), 5, 1_500_000
    wanted, tally, pieces = np.zeros(width), collocations.Tally(width + 1), []

    def hand_on():
        rows, counts = tally.result()
        tally.clear()
        pieces.extend(collocations._packed(rows[:, 1:], counts, np.zeros(len(rows), np.int32), rows[:, 0]))

    tracemalloc.start()
    for _ in range(10):
        words = random.integers(0, 30_000, (n // 10, width))
        wanted += words.sum(axis=0)
        tally.add(np.column_stack([np.full(len(words), 3), words]))
        if tally.full():
            hand_on()
    hand_on()
    counting = tracemalloc.get_traced_memory()[1]
    part = pd.concat([p.to_pandas() for p in pieces])
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    words, counts, lead = collocations._together(part, width, 30_000)
    sorting = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert counts.sum() == n and set(lead.tolist()) == {3}
    assert ((words * counts[:, None]).sum(axis=0) == wanted).all()
    assert counting < 300e6 and sorting < 60 * n


def test_collocation_scores_beyond_64_bits(spark, monkeypatch):
    a, n, l, r = 3 * 10**12, 7 * 10**13, 5 * 10**12, 6 * 10**12
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    phrases = frame([([1], l), ([2], r), ([1, 2], a)], "words array<long>, n long")
    words = frame([(1, l, "en", "big"), (2, r, "en", "data")], "key long, n long, lang string, word string")
    totals = frame([("en", n)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, params: (phrases, words, totals))
    row = collocations.collocations(None).collect()[0]
    assert row.score == 1000 * a * n // (l * r) and row.phrase == "big data" and 1000 * a * n > 2**64


def plain_dedup(texts, span=100):
    """Kept bytes and removed runs of texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - span + 1):
            s = data[i : i + span]
            if s in seen:
                gone[i : i + span] = True
            seen.add(s)
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        spans = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((len(data), spans, bytes(b for b, g in zip(data, gone, strict=False) if not g)))
    return out


def found_dedup(docs, params=None):
    return [
        (r.doc_id, r.n_bytes, [(s.begin, s.end) for s in r.spans or []], bytes(r.kept))
        for r in suffix_dedup.remove_repeats(docs, params).collect()
    ]


def check_dedup(docs, params=None, span=100):
    rows = sorted(docs.select("doc_id", "text").collect())
    wanted = [(r.doc_id, *w) for r, w in zip(rows, plain_dedup([r.text for r in rows], span), strict=True)]
    assert sorted(found_dedup(docs, params)) == wanted
    return wanted


@pytest.fixture(scope="module")
def repeating(spark):
    """Passages cut at all lengths, near copies, texts that repeat themselves, and long repeats."""
    random = np.random.default_rng(11)
    word = lambda: "".join(random.choice(list("abcdeé "), random.integers(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = prose(60)
    rows = []
    for k in range(60):
        start = int(random.integers(0, 120))
        cut = passage[start : start + int(random.integers(80, 200))]
        rows.append(prose(20) + cut + prose(int(random.integers(0, 20))))
    base = prose(300)
    for k in range(30):
        at = int(random.integers(0, len(base)))
        rows.append(base[:at] + word() + base[at:])
    rows += ["a" * 1500, "ab" * 400, "a" * 99, "a" * 100, base, base, passage, passage * 4, "", "\0" * 300]
    rows += [prose(3) + "\0" * 150, "é" * 160]
    order = random.permutation(len(rows))
    data = [(int(k) * 3 + 1, rows[i], "x") for k, i in enumerate(order)] + [(9_000, None, "x")]
    return spark.createDataFrame(data, "doc_id long, text string, place string")


@pytest.mark.parametrize("params", [
    suffix_dedup.SuffixDedupParams(),
    suffix_dedup.SuffixDedupParams(crowd=3, bucket_bytes=2000, bucket_contexts=50, broadcast_rows=0),
    suffix_dedup.SuffixDedupParams(span=60, gram=20, crowd=1),
])
@pytest.mark.parametrize("size", [1 << 21, 700])
def test_suffix_dedup_equals_brute_force(repeating, params, size, monkeypatch):
    monkeypatch.setattr(suffix_dedup.slices_of, "__defaults__", (size,))
    wanted = check_dedup(repeating.repartition(5), params, params.span)
    assert sum(len(w[2]) for w in wanted) > 50


def test_suffix_dedup_of_documents(docs):
    check_dedup(docs)


def test_suffix_dedup_odd_rows(spark, odd, empty):
    assert found_dedup(empty) == []
    text = "one and the same passage of more than one hundred bytes, " * 3
    rows = [(r.doc_id, r.text) for r in odd.collect()] + [(None, text), (3, text), (3, text), (20, text + "!")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = found_dedup(table)
    assert len(found) == len(rows)
    size = len(text.encode())
    by_id = defaultdict(list)
    for doc_id, n, spans, kept in found:
        assert n - sum(e - b for b, e in spans) == len(kept)
        by_id[doc_id].append((n, spans))
    assert (size, [(0, size)]) not in by_id[None] and by_id[3].count((size, [(0, size)])) == 2
    assert by_id[20] == [(size + 1, [(0, size)])]


def test_deep_shallow_sort_orders_and_measures():
    random = np.random.default_rng(3)
    group = np.sort(random.integers(0, 40, 3000))
    strings = random.integers(0, 2, size=(3000, 32)).astype(np.uint8) * np.uint8(200)
    strings[:, :20] = strings[group % 7, :20]
    strings[random.random(3000) < 0.3] = strings[5]
    for shallow in (0, 2, 4):
        order, common = deep_shallow_sort(as_words(strings), group, shallow)
        keys = [(int(group[i]), strings[i].tobytes()) for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(3000))
        for k in range(1, 3000):
            (g, a), (h, b) = keys[k - 1], keys[k]
            same = next((i for i in range(32) if a[i] != b[i]), 32)
            assert common[k] == (same if g == h else -1)


def plain_negatives(rows, p):
    """Rows (id, label, whole vector, is anchor), one of each id."""
    out = []
    for a, la, x, anchor in rows:
        if not anchor:
            continue
        others = [(-sum(map(int.__mul__, x, y)), b, lb) for b, lb, y, _ in rows if b != a and len(x) == len(y)]
        others.sort()
        positives = [(b, -s) for s, b, lb in others if lb == la][: p.positives]
        for b, positive in positives:
            fits = [
                (c, -s) for s, c, lc in others
                if lc != la and p.low_percent * positive <= -100 * s <= p.high_percent * positive
            ]
            out += [(a, b, k, c, positive, s) for k, (c, s) in enumerate(fits[: p.negatives], 1)]
    return sorted(out)


def usable_rows(table):
    best = {}
    for r in table.collect():
        v = r.embedding
        if r.vec_id is None or r.label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (r.label, [math.floor(256 * x) for x in v])
        if sum(x * x for x in row[1]) < 2**62:
            best[r.vec_id] = min(best.get(r.vec_id, row), row)
    return [(k, label, v, k % 10 == 0) for k, (label, v) in best.items()]


@pytest.mark.parametrize("params", [
    hard_negatives.HardNegativeParams(),
    hard_negatives.HardNegativeParams(block=3, slab_numbers=700, tile=17, segments=(8, 3), positives=3, negatives=4),
])
def test_hard_negatives_equal_brute_force(spark, params):
    random = np.random.default_rng(8)
    centres = random.normal(size=(5, 12))
    rows = [(k, (centres[k % 5] + 0.7 * random.normal(size=12)).tolist(), k % 4, "x") for k in range(400)]
    smooth = [(1000 + k, np.repeat(centres[k % 5, :3], 4).tolist(), k % 3, "x") for k in range(60)]
    same = [(2000 + k, rows[7][1], k % 2, "x") for k in range(50)]
    odd = [None, [], [0.0] * 12, [1.0, None], [float("nan")] * 12, [float("inf")] * 12, [1e30] * 12, [3e6] * 12, [1.0] * 7]
    odd = [(3000 + 10 * k, v, 1, "x") for k, v in enumerate(odd)] + [(4000, rows[3][1], None, "x"), (None, rows[3][1], 1, "x")]
    odd += [rows[10], (20, rows[9][1], 2, "y"), (3001, [], 0, "x"), (3071, [3e6] * 12, 0, "x"), (3072, [2.5e6] * 12, 2, "x")]
    table = spark.createDataFrame(rows + smooth + same + odd, "vec_id long, embedding array<double>, label int, dim string")
    found = sorted(tuple(r) for r in hard_negatives.mine(table.repartition(4), F.col("vec_id") % 10 == 0, params).collect())
    wanted = plain_negatives(usable_rows(table), params)
    assert len(wanted) > 400 and found == wanted


def test_hard_negatives_without_rows(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(table, F.lit(True)).collect() == []
    table = spark.createDataFrame([(1, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(table, F.col("vec_id") == 2).collect() == []


def test_segment_bounds_rule_out_no_pair_they_should_not():
    random = np.random.default_rng(2)
    x = np.cumsum(random.integers(-40, 41, size=(200, 30)), axis=1)
    rows = hard_negatives.Summaries(np.arange(200), np.zeros(200, np.int64), x, (16, 4, 2))
    exact = x @ x.T
    low, high = np.full(200, np.quantile(exact, 0.97).astype(int)), np.full(200, np.quantile(exact, 0.99).astype(int))
    refine = hard_negatives.Refinement()
    i, j, score = refine.pairs(rows, rows, np.ones((200, 200), bool), low, high)
    wanted = np.argwhere((exact >= low[0]) & (exact <= high[0]))
    assert sorted(zip(i, j, strict=True)) == sorted(map(tuple, wanted)) and (score == exact[i, j]).all()
    assert refine.exact < refine.seen / 3


@pytest.mark.parametrize("name", ["op11_collocations", "op13_hard_negatives"])
def test_query_equals_sql(spark, name, monkeypatch):
    monkeypatch.setattr(comparing, "TABLES", ("documents", "embeddings"))
    assert contract.queries()[name] is QUERIES[name]
    compare(spark, SF_DIR, QUERIES[name], ORACLE[name])


def test_suffix_dedup_query(spark):
    rows = sorted(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    wanted = [
        (r.doc_id, n, sum(e - b for b, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for r, (n, spans, kept) in zip(rows, plain_dedup([r.text for r in rows]), strict=True)
    ]
    assert sorted(tuple(r) for r in QUERIES["op12_suffix_dedup"](spark, SF_DIR).collect()) == wanted


def test_pointers_of_a_slice_take_little_memory(monkeypatch):
    random = np.random.default_rng(3)
    sizes = random.integers(0, 6000, 700)
    data = random.integers(97, 100, int(sizes.sum())).astype(np.uint8)[: suffix_dedup.SLICE]
    at = np.minimum(np.append(0, np.cumsum(sizes)), len(data))
    params = suffix_dedup.SuffixDedupParams()
    (part,) = suffix_dedup.slices_of(np.arange(len(sizes)), at, data, params, len(data))
    tracemalloc.start()
    found = suffix_dedup.pointers(part, params)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6
    for block in (len(data), 100_003):
        monkeypatch.setattr(suffix_dedup, "BLOCK", block)
        for a, b in zip(found, suffix_dedup.pointers(part, params), strict=True):
            assert a.dtype == b.dtype and np.array_equal(a, b)


def test_suffix_dedup_reads_a_slice_of_text_at_a_time(spark, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]}, schema=pa.schema([("n", pa.int64())]))

    spark.range(0, 4000, numPartitions=1).selectExpr("id doc_id", "repeat(uuid(), 40) text").write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    try:
        QUERIES["op12_suffix_dedup"](spark, str(tmp_path))
        texts = spark.read.parquet(f"{tmp_path}/documents.parquet")
        assert max(r.n for r in texts.mapInArrow(sizes, "n long").collect()) <= suffix_dedup.SLICE
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", before)

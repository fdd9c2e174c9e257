import math
import random
import re
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import jaccard_join, langid, license_rules, licenses, lm_score, mixing, packing, pii
from shelfwise.llm.bit_filter import maybe_in
from shelfwise.llm.queries import QUERIES, byte_bpe
from shelfwise.llm.textops import word_hashes
from shelfwise.sources.scratch import freed_shuffles, materialise

SF_DIR = "/root/testdata/sf0.001"


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_word_hashes_follow_the_word_rule():
    column = pa.array(["A b\x0bA", None, "", "x", "ab", "a b"])
    hashes, first = word_hashes(column)
    assert first.tolist() == [0, 3, 3, 3, 4, 5, 7]
    assert hashes[0] == hashes[2] == hashes[5] and hashes[1] == hashes[6]
    assert len(set(hashes.tolist())) == 4


def test_packing_equals_tokenizer(spark, docs, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_bpe().path)
    for table in (docs, odd.filter("doc_id is not null and doc_id != 3")):
        rows = packing.pack(table, byte_bpe()).collect()
        found = defaultdict(list)
        sequences = defaultdict(list)
        for r in rows:
            found[r.doc_id].append((r.piece, r.start, r.length))
            sequences[r.sequence_id].append((r.offset, r.length))
        for doc_id, text in texts(table).items():
            n = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
            pieces = sorted(found[doc_id])
            assert [p for p, _, _ in pieces] == list(range(-(-n // 2048)))
            assert sum(length for _, _, length in pieces) == n
            assert all(length == 2048 for _, _, length in pieces[1:])
        for own in sequences.values():
            ends = 0
            for offset, length in sorted(own):
                assert offset == ends
                ends += length
            assert ends <= 2048


def test_packing_knows_the_added_token():
    from tokenizers import Tokenizer

    end = "<|endoftext|>"
    texts = [f"a {end} b", end, f"{end}{end} x", f"it's{end}'s  {end}\n\n {end}", f"Grüße 東京 {end} 東京", "<|end of|>"]
    tokenizer = Tokenizer.from_file(byte_bpe().path)
    for spec in (byte_bpe(), packing.TokenizerSpec(byte_bpe().path)):
        found = packing._encoder(spec).encode([*texts, *texts[::-1]])
        expected = [tokenizer.encode(t, add_special_tokens=False).ids for t in [*texts, *texts[::-1]]]
        assert [ids.tolist() for ids in found] == expected
    assert expected[0] == [64, 220, 50256, 275]


def test_packing_learns_few_words_at_once():
    from dataclasses import replace

    from tokenizers import Tokenizer

    asked = []

    class Asked:
        def encode_batch(self, parts, **options):
            asked.append(sum(map(len, parts)))
            return tokenizer.encode_batch(parts, **options)

    texts = [" ".join(f"wo{k + n}rd" for k in range(10_000)) for n in (0, 20_000, 5_000, 0)]
    tokenizer = Tokenizer.from_file(byte_bpe().path)
    encoder = packing._Encoder(replace(byte_bpe(), cached_words=15_000, slice_bytes=1 << 16))
    encoder._tokenizer = Asked()
    found = [encoder.encode(part)[0].tolist() for part in ([t] for t in texts)]
    assert found == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(asked) <= 4000
    assert len(encoder._places) <= 15_000 + 25_000


def test_packing_is_close_to_full():
    histogram = {n: 3 + (n * 7919) % 50 for n in range(1, 2049)}
    packs = packing.pack_histogram(dict(histogram), packing.PackParams())
    used = Counter()
    for lengths, n in packs:
        assert sum(lengths) <= 2048
        for length in lengths:
            used[length] += n
    assert used == histogram
    least = -(-sum(k * n for k, n in histogram.items()) // 2048)
    assert sum(n for _, n in packs) <= 1.01 * least


def test_packing_counts_repeated_rows_and_empty(odd, empty):
    rows = packing.pack(odd, byte_bpe()).collect()
    assert sum(r.doc_id == 3 for r in rows) == 2
    assert [r.length for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert packing.pack(empty, byte_bpe()).count() == 0


@pytest.mark.parametrize("crowd,block", [(24, 150_000), (2, 300)])
def test_jaccard_join_equals_brute_force(spark, docs, odd, crowd, block):
    params = jaccard_join.JaccardParams(crowd=crowd, block_shingles=block)
    base = [f"w{i}" for i in range(60)]
    copies = [
        (10_000 + k, " ".join(w if i not in (k % 60, (k * 7) % 60) or k % 3 else f"n{k}" for i, w in enumerate(base)))
        for k in range(40)
    ]
    extra = spark.createDataFrame(copies, "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(extra)
    sizes, groups = brute.near_copies(texts(table))
    for r in jaccard_join.near_duplicates(table, params).collect():
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], groups[r.doc_id])


@pytest.mark.parametrize("crowd,block", [(24, 150_000), (2, 60)])
def test_jaccard_join_of_varied_sizes_equals_brute_force(spark, crowd, block):
    """Also where no table of wanted texts is small enough for a broadcast."""
    draw = random.Random(7)
    rows = []
    for group in range(12):
        base = [f"g{group % 9}w{i}" for i in range(draw.choice((12, 40, 90)))]
        for _ in range(30):
            gone = {draw.randrange(len(base)) for _ in range(draw.randrange(3))}
            own = [w for i, w in enumerate(base) if i not in gone]
            rows.append((len(rows), " ".join(own[draw.randrange(4) : len(own) - draw.randrange(len(own) // 7)])))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sizes, groups = brute.near_copies(dict(rows))
    params = jaccard_join.JaccardParams(crowd=crowd, block_shingles=block, broadcast_rows=1)
    found = jaccard_join.near_duplicates(table, params).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_shingles, r.component_id) == (sizes[r.doc_id], groups[r.doc_id])


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_crowded_regions_hold_only_sets_that_may_link_there(spark, monkeypatch, words, percent):
    line = "here is one line that very many texts have alike"
    rows = [(k, f"{line} a{k}") for k in range(30)]
    rows += [(100 + k, line + "".join(f" w{k}x{i}" for i in range(300))) for k in range(100)]
    waiting = []

    def written(df, label):
        table = materialise(df, label)
        if label == "crowded-members":
            waiting.extend(r.n for r in table.collect())
        return table

    monkeypatch.setattr(jaccard_join, "materialise", written)
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.near_duplicates(table, jaccard_join.JaccardParams(words, percent)).collect()
    assert all(r.component_id == r.doc_id for r in found)
    assert waiting and max(waiting) < 20


def test_jaccard_join_frees_shuffles_and_leaves_the_session_as_it_was(spark, docs):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    jaccard_join.near_duplicates(docs)
    assert spark.conf.get(key) == before
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true"


def test_bit_filter_lets_all_wanted_rows_through(spark):
    rows = spark.createDataFrame([(k if k % 50 else None, k % 3) for k in range(3000)], "slot long, bits int")
    keys = rows.filter("slot % 10 = 3 or slot is null").select(F.col("slot").alias("a"), F.col("bits").alias("b"))
    maybe, others = maybe_in(rows, [F.col("slot"), F.col("bits")], keys, [F.col("a"), F.col("b")], 100)
    assert maybe.columns == others.columns == rows.columns
    assert maybe.count() + others.count() == 3000
    assert others.filter("slot % 10 = 3 or slot is null").count() == 0
    assert others.count() > 2000


def test_jaccard_join_odd_rows(odd, empty):
    rows = jaccard_join.near_duplicates(odd).collect()
    assert len(rows) == 10
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[6] == (0, 6)
    assert found[3] == found[4] == (1, 3)
    assert found[None][1] is None
    assert jaccard_join.near_duplicates(empty).count() == 0


def test_lm_equals_brute_force(docs, odd):
    table = docs.select("doc_id", "text").unionByName(
        odd.filter("doc_id is not null").select((F.col("doc_id") + 50_000).alias("doc_id"), "text")
    )
    rows = [(r.doc_id, brute.words(r.text) + ["</s>"]) for r in table.collect()]
    learn = [(k, w) for k, w in rows if brute.fold(k, 7) != 2]
    word, pair = Counter(), Counter()
    for _, w in learn:
        word.update(w)
        pair.update(zip(["<s>", *w[:-1]], w, strict=True))
    n, v, b = sum(word.values()), len(word), len(pair)
    seen = Counter(w for _, w in pair)

    def discounts(counts):
        n1, n2, n3, n4 = (counts.get(i, 0) for i in (1, 2, 3, 4))
        usual = [0, 0.5, 1, 1.5]
        if min(n1, n2, n3, n4) <= 0:
            return usual
        y = n1 / (n1 + 2 * n2)
        d = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        return [x if 0 <= x <= i else usual[i] for i, x in enumerate(d)]

    high, low = discounts(Counter(pair.values())), discounts(Counter(seen.values()))
    unknown = sum(low[min(x, 3)] for x in seen.values()) / b / (v + 1)
    lost = defaultdict(float)
    for (before, _), c in pair.items():
        lost[before] += high[min(c, 3)]

    def p(before, w):
        lower = (max(seen[w] - low[min(seen[w], 3)], 0) / b if seen[w] else 0) + unknown
        total = len(learn) if before == "<s>" else word[before]
        if not total:
            return lower
        c = pair.get((before, w), 0)
        kept = (c - high[min(c, 3)]) / total if c else 0
        return kept + (lost[before] / total if before in lost else 1) * lower

    # Probabilities sum to one, with the unknown word.
    for before in list(word)[:3]:
        if before != "</s>":
            assert math.isclose(sum(p(before, w) for w in word) + p(before, "?"), 1, rel_tol=1e-9)
    model = lm_score.train(
        table.filter(~lm_score.held_out(F.col("doc_id"))), lm_score.LmParams(5000, 700)
    )
    found = defaultdict(list)
    for r in lm_score.score(table, model).collect():
        found[r.doc_id].append(r)
    for doc_id, w in rows:
        r = found[doc_id][0]
        assert (r.n_tokens, r.n_known) == (len(w), sum(x in word for x in w))
        base = sum(math.log10((word[x] + 1) / (n + v + 1)) for x in w)
        own = sum(math.log10(p(x, y)) for x, y in zip(["<s>", *w[:-1]], w, strict=True))
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, own, rel_tol=1e-9)


def test_lm_without_training_rows(odd, empty):
    rows = lm_score.score(odd, lm_score.train(empty)).collect()
    assert len(rows) == 10 and all(r.score == 0 and r.n_known == 0 for r in rows)


def test_licenses_equal_brute_force(docs, odd):
    phrases = licenses.PHRASES
    for table in (docs, odd.dropDuplicates()):
        found = by_id(licenses.scan(table))
        for doc_id, text in texts(table).items():
            w = brute.words(text, brute.LETTER_WORD)
            places = [
                (i, label)
                for phrase, label in phrases.items()
                for i in range(len(w))
                if w[i : i + len(phrase.split())] == phrase.split()
            ]
            r = found[doc_id]
            starts = [i for i, _ in places] or [None]
            expected = (len(w), len(places), min(starts), max(starts))
            assert (r.n_words, r.n_base, r.first_word, r.last_word) == expected
            assert r.base_labels == ",".join(sorted({label for _, label in places}))
            assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_license_words_are_counted_without_matching_each(spark):
    """The same number as that of matches, and each keyword is looked for once."""
    odd = ["", None, " ", "a", " a", "a ", "A-b_c\t d\x00e\x7ff", "für \u00a0x 𝒳y,é", "1.2.3\n\n4", "mit license" * 3]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    found = licenses.scan(rows)
    pattern = re.compile(licenses.WORD + "+")
    assert [r.n_words for r in found.orderBy("doc_id").collect()] == [
        len(pattern.findall((t or "").lower())) for t in odd
    ]
    plan = found.select("n_words")._jdf.queryExecution().optimizedPlan().toString()
    assert "translate" in plan and "regexp" not in plan
    plan = found.select("detections")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("latex project public,") <= 1


def test_license_phrases_stand_between_words_only(spark):
    odd = ["mit license", "xmit license", "émit license", "𝒳mit license", "a mit-license, 1mit license", "-mit\n license! mit licenses"]
    rows = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    assert [r.n_base for r in licenses.scan(rows).orderBy("doc_id").collect()] == [1, 0, 0, 0, 1, 1]


def test_license_rules_suppress_contained_detections(spark, empty):
    assert len(license_rules.all_rules()) > 200
    text = "Licensed under the Apache License, Version 2.0. See MIT License. GPL is not named here."
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (row,) = licenses.scan(table).collect()
    assert row.labels == "apache,apache-2.0,mit"
    assert [text[d.start : d.end] for d in row.detections][0].endswith("Version 2.0")
    assert licenses.scan(empty).count() == 0


def _sample(parsed, draw, gap):
    """A text that a parsed pattern matches; white space is ``gap``."""
    out = []
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            out.append(chr(arg))
        elif name == "IN":
            out.append(_member(arg, gap))
        elif name == "BRANCH":
            out.append(_sample(draw.choice(arg[1]), draw, gap))
        elif name == "SUBPATTERN":
            out.append(_sample(arg[3], draw, gap))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            out.append("".join(_sample(inner, draw, gap) for _ in range(draw.randint(least, min(most, least + 1)))))
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
    return "".join(out)


def _member(choices, gap):
    kinds = [str(value) for op, value in choices if str(op) == "CATEGORY"]
    if "CATEGORY_SPACE" in kinds:
        return gap
    return "x" if "CATEGORY_WORD" in kinds else chr(choices[0][1])


@pytest.mark.parametrize("gap", ["\n", " \t"])
def test_license_gates_let_every_match_through(spark, gap):
    from re import _parser

    draw = random.Random(4)
    rules = license_rules.all_rules()
    rows = []
    for k, rule in enumerate(rules):
        for text in {_sample(_parser.parse(rule.pattern), draw, gap) for _ in range(8)}:
            if re.search(rule.pattern, text):
                rows.append((k, text))
    assert {k for k, _ in rows} == set(range(len(rules)))
    low = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    low = low.withColumn("flat", licenses._flat(F.col("text")))
    found = low.select(
        "doc_id", "text", licenses._detections(F.col("text"), F.col("flat"))["rule"].alias("rules")
    )
    assert [(r.text, rules[r.doc_id]) for r in found.collect() if r.doc_id not in r.rules] == []


def test_wrapped_and_spdx_only_license_texts(spark):
    wrapped = {
        "Released under\nthe MIT": "mit",
        "available under\nApache 2.0": "apache-2.0",
        "All rights\nreserved": "proprietary",
        "GNU Lesser\n  General Public License": "lgpl",
        "Creative\nCommons Attribution": "cc-by",
        "SPDX-License-Identifier: MPL-2.0": "mpl-2.0",
        "released under the Expat": "mit",
    }
    table = spark.createDataFrame(list(enumerate(wrapped)), "doc_id long, text string")
    found = {r.text: set(r.labels.split(",")) for r in licenses.scan(table).collect()}
    for text, labels in wrapped.items():
        assert set(labels.split(",")) <= found[text], text


def test_personal_data_equals_brute_force(spark, docs, odd):
    tricky = [
        "a@b.c_d@e.f 1.2.3.4.5.6.7.8 1.2.3.999 4111 1111 1111 1111-1111 +1 555 (555) 7713-- a@b",
        "x4111111111111111y 4111-1111-1111-1111, 41111111111111112 ++12345678 é@a.b 0255.1.1.1",
        "@@a@b.co.. 1..2.3.4 12 34 56 78 90 12 34 52 a.b@c-d.e-f" * 30,
    ]
    more = spark.createDataFrame(list(enumerate(tricky, 90_000)), "doc_id long, text string")
    table = docs.select("doc_id", "text").unionByName(odd.dropDuplicates().select("doc_id", "text"))
    table = table.unionByName(more)
    rows = pii.find_spans(table)
    rows = rows.select("doc_id", pii.span_text(pii.all_spans(rows)).alias("s")).collect()
    expected = Counter((k, ",".join(brute.personal(t))) for k, t in ((r.doc_id, r.text) for r in table.collect()))
    own = Counter(
        (r.doc_id, ",".join(x for x in r.s.split(",") if not x.startswith("ctx_"))) for r in rows
    )
    assert own == expected


def test_contexts_find_unseen_identifiers(spark):
    # Thirty cards with a valid check sum teach the pattern; one has a wrong digit.
    def card(k):
        body = f"4{k:014d}"
        return next(body + str(d) for d in range(10) if brute.luhn(body + str(d)))

    rows = [(k, f"pay with card {card(k)} today") for k in range(30)]
    wrong = card(77)[:-1] + str((int(card(77)[-1]) + 1) % 10)
    rows += [(100, f"pay with card {wrong} today"), (101, f"part number {wrong}9 shipped")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = by_id(pii.find_spans(table))
    assert [(s.kind, s.start, s.end) for s in found[100].found] == [("ctx_card", 14, 30)]
    assert found[101].found == []
    clean = by_id(pii.redact(table))
    assert clean[100].text == clean[3].text == "pay with card [CARD] today"
    assert clean[101].text == rows[-1][1]


def test_personal_data_odd_rows(odd, empty):
    clean = pii.redact(odd)
    assert clean.columns == odd.columns and clean.count() == 10
    rows = {r.doc_id: r.text for r in clean.collect()}
    assert rows[1] is None and rows[None] == "no id here [PHONE], [CARD]"
    assert pii.find_spans(empty).count() == 0 and pii.redact(empty).count() == 0


def test_pii_contexts_are_whole_words_however_long(spark):
    long, longer = "W" * 100 + "é", "v" * 20_000
    texts = [
        f"start {long} a@b.co {longer} end",
        f"start {longer}\n{' ' * 200}a@b.co{' ' * 3000}{long}",
        "a@b.co",
        f"{longer} a@b.co x",
        f"q {'w' * 63} a@b.co {'w' * 64}",
    ]
    table = spark.createDataFrame(enumerate(texts), "doc_id long, text string")
    rows = pii.tag_base(table, pii.PiiParams()).select("doc_id", F.explode("email").alias("s")).collect()
    found = {r.doc_id: (r.s.before, r.s.after) for r in rows}
    long = long.lower()
    assert found == {
        0: (long, longer), 1: (longer, long), 2: ("", ""), 3: (longer, "x"), 4: ("w" * 63, "w" * 64)
    }


def test_languages_of_held_out_documents(spark):
    rows = QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (brute.fold(r.doc_id, 4) == 2) for r in rows)
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) > 0.97 * len(held)


def test_language_odd_rows(docs, odd, empty):
    model = langid.train(docs)
    rows = langid.predict(odd, model)
    assert rows.columns == [*[c for c in odd.columns if c != "score"], "lang_pred", "score"]
    found = {r.doc_id: r for r in rows.collect()}
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (1, 2, 6, 8))
    assert found[3].lang_pred in {"en", "de", "fr", "es"} and rows.count() == 10
    assert langid.train(empty) is None
    assert langid.predict(odd, None).filter("lang_pred = 'und'").count() == 10
    assert langid.predict(empty, model).count() == 0


def test_language_sample_stays_out_of_the_driver(docs, monkeypatch):
    wanted = langid.train(docs)
    fitted = langid._ftrl

    def only_in_a_task(*args):
        from pyspark import TaskContext

        assert TaskContext.get() is not None, "the sample came to the driver"
        return fitted(*args)

    monkeypatch.setattr(langid, "_ftrl", only_in_a_task)
    model = langid.train(docs)
    assert model.langs == wanted.langs == sorted(wanted.langs) and model.temperature == wanted.temperature
    assert np.array_equal(model.weights, wanted.weights) and np.array_equal(model.bias, wanted.bias)


def test_mix_stays_within_a_block(docs, odd, empty):
    weights = {f"src{k}": 1.0 + k for k in range(20)}
    rows = mixing.mix(docs, mixing.MixParams(weights=weights, parts=500, block_docs=2)).collect()
    assert len({r.doc_id for r in rows}) == docs.count() == len({r.position for r in rows})
    blocks = {(r.slot, r.source) for r in rows if r.in_mix}
    order = [s for _, s in sorted(blocks)]
    assert [s for s, _ in sorted(blocks)] == list(range(len(blocks)))
    shares = mixing.whole_parts(weights, 500)
    for source in weights:
        done = 0
        for n, s in enumerate(order, 1):
            done += s == source
            assert abs(done - shares[source] / 500 * n) < 1
    mixed = mixing.mix(odd)
    assert mixed.count() == 10 and mixed.columns[-5:] == list(mixing.PLACES)
    assert mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(docs, mixing.MixParams(weights={"src1": 1.0}))


def test_mix_goes_on_when_a_source_runs_out(spark):
    """In every phase each source keeps within a block of its share among those still running."""
    sizes = {"a": 400, "b": 300, "c": 301, "tiny": 5}
    rows = [(i, f"{s} {i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    params = mixing.MixParams(parts=50, block_docs=4)
    found = mixing.mix(docs, params).collect()
    assert len(found) == len({r.position for r in found}) == len(rows)
    slots = sorted({(r.slot, r.phase, r.source) for r in found})
    assert [s for s, _, _ in slots] == list(range(len(slots)))
    assert {r.phase for r in found if r.in_mix} == {0}
    assert sum(r.in_mix for r in found if r.source == "tiny") == 5
    running = dict(sizes)
    for phase in range(1 + max(p for _, p, _ in slots)):
        order = [s for _, p, s in slots if p == phase]
        shares = mixing.whole_parts({s: sizes[s] ** 0.7 for s in running}, 50)
        for source, share in shares.items():
            for n in range(1, len(order) + 1):
                assert abs(order[:n].count(source) - share / 50 * n) < 1
        rest = {s for _, p, s in slots if p > phase}
        assert rest < running.keys()
        running = {s: n for s, n in running.items() if s in rest}
    assert not running


def test_rows_in_mix_order(docs, odd, empty):
    """Partition after partition the rows of ``mix`` by slot and rank, whatever the weights."""
    for weights in (None, {f"src{k}": 900.0 if k == 3 else 1.0 + k for k in range(20)}):
        params = mixing.MixParams(weights=weights, parts=500, block_docs=2, region_bytes=300)
        wanted = mixing.mix(docs, params).orderBy("slot", "rank").select("doc_id").collect()
        found = mixing.in_mix_order(docs, params)
        assert found.rdd.getNumPartitions() > 3
        assert found.select("doc_id").collect() == wanted and found.columns == docs.columns
    assert sorted(map(str, mixing.in_mix_order(odd).collect())) == sorted(map(str, odd.collect()))
    repeated = docs.unionAll(docs).unionAll(docs)
    once_more = mixing.in_mix_order(repeated, mixing.MixParams(region_bytes=300))
    assert sorted(once_more.collect(), key=str) == sorted(repeated.collect(), key=str)
    clashing = docs.selectExpr("*", "1 AS rank", "2 AS _s", "3 AS _draw", "4 AS first")
    assert sorted(map(str, mixing.in_mix_order(clashing).collect())) == sorted(map(str, clashing.collect()))
    assert mixing.in_mix_order(empty).count() == 0


def test_many_matches_in_one_text_are_found_in_time(spark):
    import time

    from shelfwise.llm.spans import match_spans

    n = 100_000
    text = " ".join(f"é mail{i}@example.com" for i in range(n))
    table = spark.createDataFrame([(text,), ("none",), (None,), ("",)], "text string")
    begin = time.perf_counter()
    spans = table.select(match_spans(F.col("text"), pii.EMAIL).alias("s")).collect()
    assert time.perf_counter() - begin < 15
    assert [len(r.s) for r in spans] == [n, 0, 0, 0]
    assert all(text[s.start : s.end] == s.value == f"mail{k}@example.com" for k, s in enumerate(spans[0].s))


CLASHING = ["_low", "_flat", "_found", "_kept", "_places", "_in", "_s", "_bucket", "_draw", "_k", "_spans", "row_key", "found"]


def test_given_columns_of_any_name_come_back(spark, docs):
    from shelfwise.llm import mixing

    table = docs.limit(60).withColumns({c: F.lit(f"own {c}") for c in CLASHING})
    model = langid.train(docs)
    for result in (
        licenses.scan(table), mixing.mix(table), mixing.in_mix_order(table), pii.redact(table), langid.predict(table, model)
    ):
        rows = result.collect()
        assert len(rows) == 60 and all(r[c] == f"own {c}" for r in rows for c in CLASHING)


LICENSE_TEXTS = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy": "mit",
    " * Permission is hereby granted, free\n * of charge, to any person or organization\n * obtaining a copy of the software": "bsl-1.0",
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted": "bsd",
    "Neither the name of the Example Corp. nor the names of its contributors may be used to\n"
    "endorse or promote products derived from this software": "bsd-3-clause",
    "License: MIT": "mit",
    "MIT-licensed": "mit",
    "GPLv3+": "gpl-3.0",
    "SPDX-License-Identifier: 0BSD": "0bsd",
    "MIT OR Apache-2.0": "apache-2.0,mit",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0": "apache-2.0,gpl-2.0,mit",
    'license = "BSD-3-Clause OR ISC"': "bsd-3-clause,isc",
    "license: the usual and others": "",
    "This is not licensed under the Eclipse Public License.": "",
    "This is not licensed under the MIT license.": "mit",  # a base phrase: it stays, but no rule is met
    "not under the Zlib license, but licensed under the ISC license": "isc",
    "everyone may copy": "",
}


def test_license_texts_expressions_and_denials(spark):
    table = spark.createDataFrame(list(enumerate(LICENSE_TEXTS)), "doc_id long, text string")
    found = {r.text: r for r in licenses.scan(table).collect()}
    assert {t: r.labels for t, r in found.items()} == LICENSE_TEXTS
    denied = found["This is not licensed under the MIT license."]
    assert (denied.detections, denied.score, denied.base_labels) == ([], 0.5, "mit")


def test_license_rules_and_suppression_equal_brute_force(spark, docs):
    base = [t for t in LICENSE_TEXTS] + [
        "Licensed under the Apache License, Version 2.0 or the MIT license; GPLv2 code is distributed under the GPL v2.",
        "cc-by-sa 4.0, CC BY 3.0 and http://creativecommons.org/licenses/by/4.0 all rights reserved",
    ]
    rows = list(enumerate(base + [" ".join(base), "\n".join(base * 5)]))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table = table.unionByName(docs.select(F.col("doc_id") + 1000, "text").toDF("doc_id", "text").filter("text is not null"))
    known = license_rules.identifiers()
    n_found = 0
    for row in licenses.scan(table).collect():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row.text)
        every = [
            (m.start(), m.end(), r.priority, k, r.label, r.score)
            for k, r in enumerate(license_rules.all_rules())
            for m in re.finditer(r.pattern, low, re.ASCII)
        ]
        for e in re.finditer(license_rules.EXPRESSION, low, re.ASCII):
            first = e.start() + re.match(license_rules.TAG, e[0], re.ASCII).end()
            for m in re.finditer(license_rules.IDENTIFIER, low[first : e.end()], re.ASCII):
                label = known.get(re.sub(license_rules.IDENTIFIER_TAIL, "", m[0], flags=re.ASCII))
                tagged = e[0].startswith("spdx")
                place = (first + m.start(), first + m.end())
                if label:
                    every.append((*place, 1 if tagged else 2, -1, label, 1.0 if tagged else 0.9))
        kept = [
            d
            for d in every
            if d[4]
            and not any(
                o[0] <= d[0] and o[1] >= d[1] and o[2] <= d[2] and (o[:3] != d[:3] or o[3] < d[3])
                for o in every
            )
        ]
        expected = sorted((s, e, label, score) for s, e, _, _, label, score in kept)
        assert sorted(tuple(d) for d in row.detections) == expected, row.text[:80]
        n_found += len(expected)
    assert n_found > 40


def test_schedule_equals_earliest_deadline_first_place_by_place():
    for shares in ({"a": 7, "b": 5, "c": 1}, {"a": 1, "b": 1}, {"x": 30, "y": 2, "z": 9, "w": 9}):
        parts = sum(shares.values())
        windows = {
            (s, k): (k * parts // n, -(-(k + 1) * parts // n)) for s, n in shares.items() for k in range(n)
        }
        placed = []
        for place in range(parts):
            ready = [(due, s, k) for (s, k), (free, due) in windows.items() if free <= place]
            _, s, k = min(ready)
            del windows[s, k]
            placed.append((s, k, place))
        assert mixing.one_period(shares) == placed


def test_mix_of_twenty_thousand_sources(spark):
    """The few great ones keep to their shares, all others to the order of deadlines by weight."""
    docs = spark.range(0, 60_000, 1, 8).selectExpr(
        "id as doc_id",
        "string(id) as text",
        "if(id % 3 = 0, 'rare', if(id % 3 = 1, concat('h', id), concat('m', pmod(hash(id), 300)))) as source",
    )
    params = mixing.MixParams(block_docs=2, most_sources=20, region_bytes=20_000)
    found = mixing.mix(docs, params).collect()
    assert len(found) == len({r.doc_id for r in found}) == len({r.position for r in found}) == 60_000
    sizes = Counter(r.source for r in found)
    assert len(sizes) > 20_000
    slots = {r.slot: (r.source, r.block, r.phase) for r in found}
    assert sorted(slots) == list(range(len(slots))) and len({v[:2] for v in slots.values()}) == len(slots)
    weights = {s: n**0.7 for s, n in sizes.items()}
    great = sorted(sizes, key=lambda s: (-weights[s], s))[:19]
    in_order = [slots[k] for k in sorted(slots)]
    rare = [(s, b) for s, b, _ in in_order if s not in great]
    clock = sorted(((b + 1) / weights[s], s, b) for s, b in rare)
    assert rare == [(s, b) for _, s, b in clock]
    rest = sum(w for s, w in weights.items() if s not in great)
    shares = mixing.whole_parts({**{s: weights[s] for s in great}, "*": rest}, params.parts)
    placed = Counter()
    for place, (s, _, phase) in enumerate(in_order, 1):
        if phase:
            break
        placed[s if s in great else "*"] += 1
        for name in shares:
            assert abs(placed[name] - place * shares[name] / params.parts) < 1
    assert place > 1000
    wanted = [r.doc_id for r in sorted(found, key=lambda r: (r.slot, r.rank))]
    assert [r.doc_id for r in mixing.in_mix_order(docs, params).collect()] == wanted
    regions = {r.doc_id: r.region for r in mixing.in_regions(docs, params).collect()}
    assert [regions[d] for d in wanted] == sorted(regions.values()) and max(regions.values()) > 3
    with pytest.raises(ValueError, match="no target weight"):
        mixing.mix(docs, mixing.MixParams(weights={f"h{k}": 1.0 for k in range(30)}, most_sources=20))


def test_lm_of_order_three_equals_brute_force(docs, odd):
    table = docs.select("doc_id", "text").unionByName(
        odd.filter("doc_id is not null").select((F.col("doc_id") + 50_000).alias("doc_id"), "text")
    )
    rows = [(r.doc_id, brute.words(r.text) + ["</s>"]) for r in table.collect()]
    learn = [w for k, w in rows if brute.fold(k, 7) != 2]
    three = Counter(g for w in learn for g in zip(["<s>", "<s>", *w], ["<s>", *w], w, strict=False))
    two = Counter()
    for (_, b, c), n in three.items():
        two[b, c] += n if b == "<s>" else 1
    one = Counter(c for _, c in two)

    def discounts(counts):
        n1, n2, n3, n4 = (Counter(counts)[i] for i in (1, 2, 3, 4))
        assert min(n1, n2, n3, n4) > 0
        y = n1 / (n1 + 2 * n2)
        return [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]

    levels = []
    for counts in (three, two):
        d, total, lost = discounts(counts.values()), Counter(), Counter()
        for gram, n in counts.items():
            total[gram[:-1]] += n
            lost[gram[:-1]] += d[min(n, 3)]
        levels.append((counts, d, total, lost))
    n1, n2, n3, n4 = (Counter(one.values())[i] for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    low = [0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3] if min(n1, n2, n3, n4) else [0, 0.5, 1, 1.5]
    low = [x if 0 <= x <= i else [0, 0.5, 1, 1.5][i] for i, x in enumerate(low)]
    unknown = sum(low[min(n, 3)] for n in one.values()) / len(two) / (len(one) + 1)

    def p(gram, level=0):
        if level == 2:
            n = one[gram[0]]
            return max(n - low[min(n, 3)], 0) / len(two) + unknown
        counts, d, total, lost = levels[level]
        lower, context, n = p(gram[1:], level + 1), gram[:-1], counts[gram]
        if not total[context]:
            return lower
        return (max(n - d[min(n, 3)], 0) + lost[context] * lower) / total[context]

    vocabulary = [*one, "?"]
    contexts = [("<s>", "<s>"), *[g[:2] for g in list(three)[5:200:60]], ("?", learn[0][0]), ("?", "?")]
    for context in contexts:
        assert math.isclose(sum(p((*context, w)) for w in vocabulary), 1, rel_tol=1e-9)
    model = lm_score.train(
        table.filter(~lm_score.held_out(F.col("doc_id"))), lm_score.LmParams(5000, 700, order=3)
    )
    assert len(model.trigram_shards) > 3
    found = {r.doc_id: r.score for r in lm_score.score(table, model).collect()}
    for doc_id, w in rows:
        own = sum(math.log10(p(g)) for g in zip(["<s>", "<s>", *w], ["<s>", *w], w, strict=False))
        assert math.isclose(found[doc_id], own, rel_tol=1e-9)


def test_lm_counts_beyond_32_bits_and_other_orders(empty):
    keys, counts = np.array([3, 9, 1 << 61]), np.array([1, 1 << 40, 255])
    for got, own in zip(lm_score._unpack(3, *lm_score._pack(keys, counts)), (keys, counts), strict=True):
        assert got.tolist() == own.tolist()
    assert lm_score._narrow(np.array([255])).itemsize == 1 and lm_score._narrow(counts).itemsize == 8
    with pytest.raises(ValueError, match="order"):
        lm_score.train(empty, lm_score.LmParams(order=4))

import html
import time
from collections import Counter
from html.entities import html5

import duckdb
import numpy as np
import pytest
from brute import components
from compare import compare
from pyspark.sql import functions as F

import __spark_entry__ as contract
import compare as comparing
from shelfwise.llm import embedding_dedup, graph_ann, mixing, warc
from shelfwise.llm.components import connected_components
from shelfwise.llm.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of near copies, equal ones, and rows that take no part."""
    random = np.random.default_rng(5)
    centres = random.normal(size=(40, 16))
    rows = []
    for k in range(600):
        v = centres[k % 40] + 0.09 * random.normal(size=16) * (k % 3)
        rows.append((k, [float(np.float32(x)) for x in v], k % 2 if k % 7 else 0, "x"))
    odd = [None, [], [0.0] * 16, [1.0, None], [float("nan")] * 16, [float("inf")] + [1.0] * 15]
    rows += [(1000 + k, v, 0, "x") for k, v in enumerate(odd)]
    rows += [(2000, rows[5][1], None, None), (5, rows[5][1], rows[5][2], "x")]
    return spark.createDataFrame(
        rows, "vec_id long, embedding array<float>, label int, score string"
    )


def usable(v):
    return v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile", [1024, 37])
def test_embedding_dedup_equals_brute_force(vectors, tile):
    rows = vectors.collect()
    keep = [r for r in rows if r.label is not None and usable(r.embedding)]
    x = np.array([r.embedding for r in keep], np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r.label for r in keep])
    links = (x @ x.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(links, False)
    ids = [r.vec_id for r in keep]
    groups = components([r.vec_id for r in rows], [(ids[a], ids[b]) for a, b in np.argwhere(links)])
    n_links = dict(zip(ids, links.sum(axis=1).tolist(), strict=True))
    found = embedding_dedup.near_duplicates(vectors, embedding_dedup.EmbeddingDedupParams(tile=tile))
    found = found.collect()
    assert len(found) == len(rows)
    for r in found:
        if r.vec_id != 2000:
            assert r.n_links == n_links.get(r.vec_id, 0)
        assert r.component_id == groups[r.vec_id] and r.kept == (r.vec_id == r.component_id)


def test_quantisation_bounds_hold():
    random = np.random.default_rng(1)
    x = embedding_dedup.unit_rows(random.normal(size=(300, 48)) ** 3)
    y = embedding_dedup.unit_rows(x + 0.05 * random.normal(size=x.shape) * random.random((300, 1)))
    a, b = embedding_dedup.possible_pairs(x, y, 0.98)
    assert {tuple(p) for p in np.argwhere(x @ y.T >= 0.98)} <= set(zip(a, b, strict=True))
    assert len(a) < 2000


def test_ann_recall_against_brute_force(spark, vectors):
    for table, shard in ((vectors, 64), (spark.read.parquet(f"{SF_DIR}/embeddings.parquet"), 2048)):
        params = graph_ann.AnnParams(shard=shard)
        index = graph_ann.build_index(table, params)
        found = graph_ann.search(index, table.filter(graph_ann.query_rows(table)), params).collect()
        rows = [r for r in table.dropDuplicates(["vec_id"]).collect() if r.embedding and (
            len(r.embedding) != 16 or usable(r.embedding))]
        rows = [r for r in rows if all(x is not None for x in r.embedding)]
        x = np.array([r.embedding for r in rows], np.float64)
        x /= np.linalg.norm(x, axis=1)[:, None]
        ids = np.array([r.vec_id for r in rows])
        hits = total = 0
        for k in np.flatnonzero(ids % 50 == 0):
            cosine = np.round(x @ x[k], 12)
            best = [ids[j] for j in np.lexsort((ids, -cosine)) if j != k][:5]
            own = sorted((r["rank"], r.vec_id) for r in found if r.query_id == ids[k])
            assert [n for n, _ in own] == [1, 2, 3, 4, 5]
            hits, total = hits + len({i for _, i in own} & set(best)), total + 5
        assert hits >= 0.9 * total


def test_ann_searches_visit_a_small_part_of_a_large_shard(spark):
    random = np.random.default_rng(4)
    x = random.normal(size=(6000, 16)).astype(np.float32)
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = graph_ann.build_index(table)
    assert index.count() == 1
    queries = table.filter(graph_ann.query_rows(table))
    params = graph_ann.AnnParams(search_beam=64)
    assert 0 < graph_ann.visited_share(index, queries, params) < 0.2
    unit = graph_ann.unit_rows(x.astype(np.float64))
    found = graph_ann.search(index, queries, params).collect()
    assert len(found) == 5 * 120
    hits = 0
    for query in range(0, 6000, 50):
        best = [int(j) for j in np.argsort(-(unit @ unit[query])) if j != query][:5]
        hits += len({r.vec_id for r in found if r.query_id == query} & set(best))
    assert hits >= 0.9 * len(found)


def test_ann_long_vectors_make_smaller_shards(spark):
    random = np.random.default_rng(6)
    rows = [(k, random.normal(size=8 if k % 4 else 12).tolist()) for k in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    params = graph_ann.AnnParams(shard_values=800, task_blocks=1, query_block=2)
    index = graph_ann.build_index(table, params)
    # 300 rows in shards of 100, and 100 rows in shards of 66, as hashes deal them.
    shards = {(r.dim, r.shard) for r in index.collect()}
    assert len(shards) == 5 and len({shard for _, shard in shards}) == 5
    found = graph_ann.search(index, table.filter(graph_ann.query_rows(table)), params).collect()
    assert sorted(r["rank"] for r in found) == sorted(list(range(1, 6)) * 8)


def test_ann_repeated_rows_leave_room_for_their_equals(spark):
    random = np.random.default_rng(8)
    rows = [(100 + k, random.normal(size=16).tolist()) for k in range(80)]
    same = random.normal(size=16).tolist()
    rows += [(5, same)] * 10 + [(i, same) for i in (7, 9, 11)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    index = graph_ann.build_index(table)
    for query in (5, 9):
        found = graph_ann.search(index, table.filter(F.col("vec_id") == query)).collect()
        own = [r.vec_id for r in sorted(found, key=lambda r: r["rank"])]
        assert own[:3] == [i for i in (5, 7, 9, 11) if i != query] and len(own) == 5


def test_vector_operators_on_an_empty_table(vectors):
    none = vectors.filter("false")
    assert embedding_dedup.near_duplicates(none).count() == 0
    assert graph_ann.search(graph_ann.build_index(none), none).count() == 0


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 90), (90, 95), (7, 7)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {
        **dict.fromkeys(range(41), 0),
        **dict.fromkeys((90, 95, 100), 90),
    }


def test_warc_equals_sql(spark, monkeypatch):
    monkeypatch.setattr(comparing, "TABLES", ("pages",))
    assert compare(spark, SF_DIR, QUERIES["op9_warc"], ORACLE["op9_warc"]) > 0


def test_warc_round_trip(spark, tmp_path):
    html = '<html><head><title> A &amp;\n B </title></head><body><p>x &lt; y<br>z</p><script>q<p></script></body>'
    rows = [(1, "http://a/\r\nX: y", html), (2, None, None), (None, "http://b", ""), (2, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = warc.derivatives(warc.responses(pages, "2024-01-01T00:00:00Z"))
    assert records.count() == 8
    warc.write_records(records, str(tmp_path / "w"))
    read = warc.read_records(spark, str(tmp_path / "w"))
    assert read.count() == 8
    digest = F.concat(F.lit("sha256:"), F.sha2("block", 256))
    assert read.filter(digest != read["headers"]["WARC-Block-Digest"]).count() == 0
    texts = {r.block for r in records.filter("warc_type = 'conversion'").collect()}
    assert "x < y\nz" in texts and "" in texts
    known = records.filter("warc_type = 'metadata' and page_id = 1").first().block
    assert "title: A & B\r\n" in known and "source-digest: sha256:" in known
    assert warc.derivatives(warc.responses(pages.filter("false"), "d")).count() == 0


def test_pipeline_keeps_one_of_each_group(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_DIR)
        assert kept.columns == docs.columns, name
        kept = kept.collect()
        assert 0 < len(kept) <= docs.count()
        docs = spark.createDataFrame(kept, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert pieces.select("doc_id").distinct().count() == docs.count()


def test_pipeline_joins_near_copies_of_five_words_and_four_fifths(spark):
    import corpus_pipeline

    random = np.random.default_rng(3)
    texts = []
    for _ in range(12):
        own = [f"w{k}" for k in random.integers(0, 10**6, 400)]
        added = [f"w{k}" for k in random.integers(0, 10**6, 200)]
        texts += [own, own[:200] + added[:90] + own[200:], own[:-65], own + added[90:]]
    sets = [set(zip(*[t[k:] for k in range(5)], strict=False)) for t in texts]
    linked = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    groups = components(range(len(texts)), linked)
    assert len(set(groups.values())) == 24
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.one_of_each_group(spark, docs, SF_DIR).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(groups.values()))


@pytest.mark.parametrize("most", [1000, 7])
def test_pipeline_parts_rows_by_few_and_by_many_ids(spark, most):
    import corpus_pipeline

    rows = [(k if k % 40 else None, f"t{k}") for k in range(400)] + [(33, "again"), (34, "again")]
    docs = spark.createDataFrame(rows, "doc_id int, its_id string")
    for wanted in ({k for k in range(400) if k % 3 == 0 and k % 40}, {None, 34}):
        ids = spark.createDataFrame([(k,) for k in wanted], "doc_id long")
        inside, outside = corpus_pipeline._parted(docs, ids, most)
        assert inside.columns == outside.columns == docs.columns
        assert Counter(map(tuple, inside.collect())) == Counter(r for r in rows if r[0] in wanted)
        assert Counter(map(tuple, outside.collect())) == Counter(r for r in rows if r[0] not in wanted)


def test_pipeline_packs_follow_the_weights_of_the_mix(spark, monkeypatch):
    import corpus_pipeline

    rows = [(k, f"text {k} " * (5 + k % 60), "ab"[k % 2], "en") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    early = []
    for a in (0.9, 0.1):
        mix = mixing.MixParams(weights={"a": a, "b": 1 - a}, region_bytes=1 << 16)
        monkeypatch.setattr(corpus_pipeline, "MIX", mix)
        mixed = corpus_pipeline.mixed(spark, docs, SF_DIR)
        found = corpus_pipeline.packed(spark, mixed, SF_DIR).collect()
        assert sorted(r.doc_id for r in found) == list(range(3000))
        sequences = {}
        for r in found:
            sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert sorted(sequences) == list(range(len(sequences)))
        for own in sequences.values():
            own.sort()
            assert [at for at, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
            assert sum(n for _, n in own) <= 2048
        first = [r.doc_id % 2 == 0 for r in found if r.sequence_id < len(sequences) // 4]
        early.append(sum(first) / len(first))
    assert early[0] > 0.8 and early[1] < 0.2


def plain_texts(spark, pages):
    table = spark.createDataFrame([(k, "u", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    found = warc.derivatives(warc.responses(table, "2024-01-01T00:00:00Z"))
    texts = {(r.page_id, r.warc_type): r.block for r in found.collect()}
    return [texts[k, "conversion"] for k in range(len(pages))], [texts[k, "metadata"] for k in range(len(pages))]


def test_warc_keeps_text_and_decodes_all_references(spark, monkeypatch):
    references = [f"&{n}" for n in html5 if n.endswith(";") and "\xa0" not in html5[n]][::9]
    numbers = ["&#8217;", "&#x27;", "&#X1F600;", "&#0;", "&#xD800;", "&#x110000;", "&#128;", "&#x0041;", "&#99999999999999999999;"]
    pages = [
        "<header>Site</header><p>Kept body text.</p><script>x()</script><p>tail</p>",
        "<head><title>T &amp; U</title><script>a</script><style>b</style></head><body>one<noscript>no</noscript>two</body>",
        "&copy; 2024 &middot; a&nbsp;b &amp;lt; &unknown; &eacute;&mdash;&hellip; AT&T &;",
        " ".join(references),
        " ".join(numbers),
        "a<!-- x -->b<!-- <p>y --> c <!-- open",
        """<a href="/1">x</a><A class=k HREF='/2'>y</A><a href=/3>z</a><a data-href="/no">w</a><abbr href="/no">""",
    ]
    texts, known = plain_texts(spark, pages)
    assert texts[0] == "Site\nKept body text.\ntail" and texts[1] == "one two"
    assert "title: T & U\r\n" in known[1]
    assert texts[2] == "© 2024 · a b &lt; &unknown; é—… AT&T &;"
    assert texts[3] == " ".join(" ".join(html.unescape(r) for r in references).split())
    assert texts[4] == " ".join(html.unescape(n) for n in numbers)
    assert texts[5] == "a b c <!-- open"
    assert [line[9:] for line in known[6].split("\r\n") if line.startswith("outlink: ")] == ["/1", "/2", "/3"]
    monkeypatch.setattr(comparing, "duck", lambda sf_dir: _pages(pages))
    table = spark.createDataFrame([(k, "u", p) for k, p in enumerate(pages)], "page_id long, url string, html string")
    query = lambda spark, sf_dir: warc.derivatives(warc.responses(table, "2024-01-01T00:00:00Z"))
    assert compare(spark, SF_DIR, query, ORACLE["op9_warc"]) == 2 * len(pages)


def _pages(pages):
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    con.executemany("insert into pages values (?, 'u', ?)", list(enumerate(pages)))
    return con


def test_warc_unclosed_comments_take_no_time(spark):
    page = "<p>text</p>" + "<!-- open " * 40_000
    plain_texts(spark, ["warm"])
    begin = time.perf_counter()
    (text,), _ = plain_texts(spark, [page])
    assert time.perf_counter() - begin < 10 and text.startswith("text")


def test_numbered_queries_are_registered():
    numbers = {name.split("_")[0] for name in contract.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in contract.queries()

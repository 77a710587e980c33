"""Operators on vectors, pages and mixes, and the pipeline, against plain versions."""

import itertools
import json
import re

import numpy as np
from llm_cases import awkward, empty, texts, words
from pyspark.sql import functions as F

from chartmart.llm import forest, graph, mixing, wrappers
from chartmart.llm.sqlmath import log_choose


def find(up, x):
    while up[x] != x:
        x = up[x]
    return x


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    up = {x: x for e in edges for x in e}
    for a, b in edges:
        x, y = find(up, a), find(up, b)
        up[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(up, x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_block_pairs_meet_every_pair_once(spark):
    rows = spark.createDataFrame([(1, k) for k in range(50)] + [(2, 7)], "g long, m long")
    dealt = graph.block_pairs(rows, "g", "m", 8).collect()
    met = set()
    for _, own in itertools.groupby(sorted(dealt, key=lambda r: (r["g"], r["_x"], r["_y"])), key=lambda r: (r["g"], r["_x"], r["_y"])):
        own = list(own)
        for a, b in itertools.combinations(own, 2):
            if a["_x"] == a["_y"] or a["_block"] != b["_block"]:
                pair = (a["g"], *sorted((a["m"], b["m"])))
                assert pair not in met
                met.add(pair)
    assert len(met) == 50 * 49 // 2


def test_forest(spark):
    rng = np.random.default_rng(4)
    centre = rng.standard_normal((6, 16))
    x = rng.standard_normal((900, 16))
    x[:300] = centre[rng.integers(0, 6, 300)] + rng.standard_normal((300, 16)) * 0.18
    x[400] = x[401]
    rows = [(int(k), [float(c) for c in v], "extra") for k, v in enumerate(x.astype(np.float32))]
    odd = [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [float("nan")] * 16), (2004, [1.0, None] + [0.0] * 14), (2005, [1.0] * 3), (None, rows[0][1]), (2006, [1e30] * 16)]
    frame = spark.createDataFrame(rows + [(i, v, "n_links") for i, v in odd], "vec_id long, embedding array<float>, id string")
    got = forest.links(frame, leaf=100, block=64).collect()  # leaves and blocks smaller than the groups
    assert len(got) == 908
    unit = x.astype(np.float32).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    by = {r.vec_id: r for r in got if r.vec_id is not None and r.vec_id < 900}
    n = np.array([by[k].n_links for k in range(900)])
    assert (n <= linked.sum(1)).all() and n.sum() >= 0.9 * linked.sum() > 0
    assert by[400].component_id == by[401].component_id and by[401].n_links > 0
    up = {k: k for k in range(900)}
    for a, b in zip(*np.nonzero(linked)):
        p, q = find(up, a), find(up, b)
        up[max(p, q)] = min(p, q)
    assert all(by[k].component_id >= find(up, k) and by[k].kept == (by[k].component_id == k) for k in range(900))
    assert all(r.n_links == 0 and r.kept for r in got if r.vec_id is None or r.vec_id >= 2000)
    assert forest.links(frame.limit(0)).collect() == []


def test_forest_counts_a_pair_once_over_spilled_leaves(spark):
    v = [[1.0, 0.001 * k, 0.0] for k in range(40)]
    frame = spark.createDataFrame([(k, x) for k, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = forest.links(frame, leaf=10, trees=5, overlap=0.5, block=7).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(39, 0)}


def test_mixing_against_a_plain_fill(spark):
    rows = texts() + [(200 + k, "m " * (1 + 37 * k % 90)) for k in range(300)]
    docs = awkward(spark, rows)
    got = mixing.taken(docs, block_words=256, shards=5).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in docs.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(words(r["text"]))
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), list(names)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    used = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and abs(r.target - target[r.source]) < 1e-6 and r.source_size == sizes[r.source]
        used[r.source] = used.get(r.source, 0) + r.taken
    assert all(abs(used[s] - target[s]) <= 1 for s in names)
    assert sorted(map(str, mixing.taken(docs, block_words=256, shards=5).collect())) == sorted(map(str, got))  # reruns agree
    mixed = mixing.mixed_rows(docs, block_words=256, shards=5)
    assert mixed.columns == docs.columns
    assert sum(len(words(r["text"])) for r in mixed.collect()) == sum(used.values())
    assert mixing.taken(empty(spark)).collect() == []


def test_mixed_rows_lie_by_shard_in_order(spark):
    rows = texts() + [(200 + k, "m " * (1 + 37 * k % 90)) for k in range(300)]
    docs = awkward(spark, rows)
    options = {"block_words": 256, "shards": 5}
    mixed = mixing.mix(docs, **options)[1].collect()
    for slice_words in (1 << 24, 700):  # whole shards, and shards in slices
        got = mixing.placed_rows(docs, slice_words=slice_words, **options).select("*", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at")).collect()
        assert sorted((str(r.row["doc_id"]), r.shard, r.place, len(words(r.row["text"]))) for r in got) == sorted((str(r.doc_id), r.shard, r.place, r.words) for r in mixed)
        got.sort(key=lambda r: r["at"])
        runs = {}
        for r in got:
            runs.setdefault((r.p, r.shard), []).append(r.place)
        assert {r.shard for r in got} == set(range(5)) and all(places == sorted(places) for places in runs.values())
        spans = sorted((s, min(x), max(x)) for (_, s), x in runs.items())
        if slice_words > 700:
            assert len(spans) == 5  # a shard in one task
    # texts that stay apart in shard order are not in the order of the table
    assert [r.row["doc_id"] for r in got] != [r.doc_id for r in mixed]


def test_splitting_tree_is_exact(spark):
    quota = {0: 700, 1: 0, 2: 55, 3: 1}
    leaves = mixing.splitting_tree(spark.createDataFrame(list(quota.items()), "rank int, quota long"), shards=7).collect()
    total = {}
    for rank, n in quota.items():
        own = sorted((r for r in leaves if r["rank"] == rank), key=lambda r: r["shard"])
        at = 0
        for r in own:  # runs that follow one another: disjoint and complete
            assert r["first"] == at
            at += r["number"]
            total[r["shard"]] = total.get(r["shard"], 0) + r["number"]
        assert at == n
    assert max(total.values()) - min(total.values()) <= 3 and len(total) == 7


def test_hypergeometric_law(spark):
    import math

    marked, others, drawn = 7, 9, 6
    u = F.col("id") / 20000.0 + 0.5 / 20000
    got = spark.range(20000).select(mixing._hypergeometric(u, F.lit(marked).cast("long"), F.lit(others).cast("long"), F.lit(drawn).cast("long")).alias("k")).groupBy("k").count().collect()
    for r in got:
        p = math.comb(marked, r["k"]) * math.comb(others, drawn - r["k"]) / math.comb(marked + others, drawn)
        assert abs(r["count"] / 20000 - p) < 2e-4
    assert abs(spark.range(1).select(log_choose(F.lit(1000), F.lit(400)).alias("x")).first()["x"] - math.log(math.comb(1000, 400))) < 1e-9


PAGE = ('<!DOCTYPE html><html lang="en"><head><title>T {n}</title><script>var a="</p>";</script></head><body><header class="site-header"><h2>Site</h2></header>'
        '<nav><ul><li><a href="/a">A</a><li><a href="/b">B</a></ul></nav><div class="ad">Buy {n}</div><article><h1>Head &amp; tail {n}</h1><p>One <b>bo</b>ld<br>line'
        '&nbsp;x {n}.</p>{more}<aside>Side</aside><div class="comments"><p>Reader {n}</p></div></article><form><p>Mail</p></form><footer>&copy; us</footer></body></html>')


def test_wrappers(spark):
    pages = []
    for n in range(40):
        pages.append((n, f"https://Host.example/{n}", PAGE.format(n=n, more="".join(f"<p>Extra {n} {k}" for k in range(n % 4)))))
    plain = "<html><body><div><a href=/>Home</a></div><div><p>Story number {n} goes on and on.</p><p>More of {n}</p></div><div>All rights reserved</div></body></html>"
    pages += [(100 + n, f"http://plain.example/{n}", plain.format(n=n)) for n in range(10)]
    pages += [(200, None, None), (201, "nourl", ""), (202, "http://cut.example/", "<html><body><article><p>Cut of"), (203, "http://c.example", "<article><p>a<!-- open"), (0, pages[0][1], pages[0][2])]
    frame = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r.text for r in wrappers.extract(frame, salt=3).collect()}
    for n in range(40):
        extra = "".join(f" Extra {n} {k}" for k in range(n % 4))
        assert got[n] == f"Head & tail {n} One bold line x {n}.{extra}", got[n]
    for n in range(10):
        assert got[100 + n] == f"Story number {n} goes on and on. More of {n}"
    assert (got[200], got[201], got[202], got[203]) == ("", "", "Cut of", "a")
    assert wrappers.extract(frame).count() == len(pages)
    assert wrappers.extract(frame.limit(0)).collect() == []


def test_wrapper_expression_has_options_and_repeats():
    whole = None
    for k in range(4):
        own = wrappers.tree(f"<body><h1>t{k}</h1>{'<p>x%d</p>' % k * (k + 1)}{'<table><tr><td>1</table>' if k % 2 else ''}<div>same</div></body>")
        whole = own if whole is None else wrappers.align(whole, own)
    text = wrappers.expression(json.loads(json.dumps(whole)))
    assert re.search(r"h1\(#\)", text) and re.search(r"p\([#=]\)\+", text) and re.search(r"table\(.*\)\?", text) and "div(=)" in text


def test_wrappers_of_a_host_with_mixed_templates(spark):
    kinds = ("<article>{}</article>", "<main>{}</main>", '<div class="post">{}</div>', '<div class="content">{}</div>', "<section>{}</section>",
             '<div class="cards"><article><p>Teaser</p></article></div><main>{}</main>')
    pages = []
    for k, url in enumerate(("http://mixed.example/", None, "no-scheme/")):
        for n in range(24):
            text = f"<p>Title of {n} in {k}</p><p>Story {n} of {k} goes on and on</p>"
            pages.append((100 * k + n, url and f"{url}{n}", f"<body><nav>Menu</nav>{kinds[n % 6].format(text)}<footer>Us</footer></body>"))
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), salt=3).collect()}
    assert got == {100 * k + n: f"Title of {n} in {k} Story {n} of {k} goes on and on" for k in range(3) for n in range(24)}


def test_blocks_after_skipped_elements():
    def text(page):
        return " ".join(x[1] for x in wrappers.blocks(page))

    for tag in ("svg", "math", "canvas", "object", "iframe", "video", "audio", "noscript", "template"):
        assert text(f'<p>a <{tag} class="x"/> b</p><p>c</p><{tag}>no</{tag}><p>d</p>') == "a b c d", tag
        assert text(f"<p>a</p><{tag}><p>b</p><p>c</p>") == "a b c", tag
        assert text(f"<p>a</p><{tag}>no<{tag}>no</{tag}>no<{tag}/>no</{tag}><p>b</p>") == "a b", tag
    assert text("<p>a</p><svg><title>no</svg><p>b</p><svg><title>no</title></svg><p>c</p>") == "a b c"
    assert text("<p>a</p><object>no<script>'</object>'</script>no</object><p>b</p>") == "a b"
    assert text("<script src=x.js /><p>a</p><script>no</script><p>b</p><style>no") == "a b"
    assert text("<p>a</p><textarea>no <p>no</p>") == "a"


def test_wrappers_keep_near_copies(spark):
    article = "".join(f"<p>Paragraph {k} of a long article that several pages have.</p>" for k in range(6))
    whole = " ".join(f"Paragraph {k} of a long article that several pages have." for k in range(6))
    pages = [(n, f"http://near.example/{n}", f"<body><h1>Seen on day {n}</h1>{article}<p><a href=/>A paragraph that is a link</a></p></body>") for n in range(6)]
    want = {n: f"Seen on day {n} {whole} A paragraph that is a link" for n in range(6)}
    # near copies with a slot of their own, among different articles with a shared line
    for n in range(12):
        quote = f"<blockquote>A quotation of the copied article</blockquote>{article}<p>Day {n}</p>"
        story = quote if n % 2 else f"<p>Quite another story, number {n}, as long as it may be</p>"
        pages.append((100 + n, f"http://both.example/{n}", f"<body><div>Our motto</div><section>{story}</section></body>"))
        want[100 + n] = f"A quotation of the copied article {whole} Day {n}" if n % 2 else f"Quite another story, number {n}, as long as it may be"
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    for n in (1, 7):
        got = {r.page_id: r.text for r in wrappers.extract(frame.repartition(n), salt=3).collect()}
        assert got == want


def test_wrappers_look_at_all_pages_for_different_articles(spark):
    article = "".join(f"<p>Paragraph {k} of a long article that most pages have.</p>" for k in range(6))
    # two other articles among many near copies: hardly any 64 pages show both
    stories = {40: "The first of two other stories, told once", 90: "The second of two other stories, also told once"}
    page = "<body><div>Our motto</div><section>{}</section></body>"
    pages = [(n, f"http://many.example/{n}", page.format(f"<p>{stories[n]}</p>" if n in stories else f"<h1>Day {n}</h1>{article}")) for n in range(200)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(frame.repartition(5), salt=3).collect()}
    assert {n: got[n] for n in stories} == stories
    assert all(text.startswith(f"Day {n} Paragraph 0") for n, text in got.items() if n not in stories)


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "MinHash near-dedup", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    from llm_cases import line_dedup, near_classes

    from chartmart.session import stage

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, first = docs.columns, docs
    kept = stage(corpus_pipeline.STAGES[0][1](spark, docs, sf), "q")
    assert kept.columns == columns and {len(words(r.text)) >= 50 for r in kept.collect()} == {True}
    cut = stage(corpus_pipeline.STAGES[1][1](spark, kept, sf), "l")
    plain = {i: t for i, n, gone, t in line_dedup([(r.doc_id, r.text) for r in kept.collect()], 2, 20) if gone < n or not gone}
    assert cut.columns == columns and {r.doc_id: r.text for r in cut.collect()} == plain
    near = stage(corpus_pipeline.STAGES[2][1](spark, cut, sf), "n")
    classes = near_classes(list(plain.items()))
    assert near.columns == columns and {r.doc_id for r in near.collect()} == {i for i in plain if classes.get(i, i) == i}
    mixed = stage(corpus_pipeline.STAGES[3][1](spark, near, sf), "m")
    n = sum(len(words(r.text)) for r in near.collect())
    assert mixed.columns == columns and abs(sum(len(words(r.text)) for r in mixed.collect()) - 1.5 * n) <= 25
    out = corpus_pipeline.STAGES[4][1](spark, mixed, sf).collect()
    assert len(out) == mixed.count()
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(map(str, whole)) == sorted(map(str, out)) and first.count() >= len(near.collect())


def test_every_operator_is_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 11)) and "pipeline" in names
    assert set(E.oracle_sql()) <= names


def test_wrappers_of_deep_pages(spark):
    deep = "<div>" * 10_000
    pages = [(1, "http://d.example/1", f"<body>{deep}<p>deep down</p>"), (2, "http://d.example/2", f"<body>{deep}<article><p>told</p><div class=comments>no</div></article>"),
             (3, "http://e.example/", "<body>" + "".join(f'<div class="post n{k}">' for k in range(3000)) + "<p>text</p>"),
             (4, "http://f.example/", "<body>" + "<ul><li>" * 4000 + "item"), (5, "http://g.example/", f"<body><nav>{deep}menu</nav><main>{deep}text</main>")]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "deep down", 2: "told", 3: "text", 4: "item", 5: "text"}


LAYOUTS = ['<div class="layout has-sidebar"><article>{}</article></div>', '<div id="page" class="comments-open"><main>{}</main></div>',
           '<div class="elementor-widget-container"><article>{}</article></div>', '<div class="search-enabled"><main>{}</main></div>',
           "<form><div class=x><article>{}</article></div></form>", '<div class="widget"><article>{}</article></div>', '<div class="sidebar-left"><div class="post">{}</div></div>',
           '<article>{}<div class="related-posts"><p>other</p></div></article>', '<form><main>{}</main><div class="related"><article>card</article></div></form>',
           '<div id="post-81" class="css-1a2b3c">{}</div><div class="cookie-bar">We use them</div><div class="site-footer">Us</div>']


def test_wrappers_of_layouts_that_name_other_things(spark):
    text = '<p>Told at length, as an article is.</p><div class="share-price">12.50</div><p>More of it {}</p>'
    pages = [(100 * k + n, f"http://l{k}.example/{n}", f"<body><nav>Menu</nav>{x.format(text.format(n))}<footer>Us</footer></body>") for k, x in enumerate(LAYOUTS) for n in range(4)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string"), salt=2).collect()}
    assert got == {100 * k + n: f"Told at length, as an article is. 12.50 More of it {n}" for k in range(len(LAYOUTS)) for n in range(4)}


def test_wrapper_does_not_grow_with_ids():
    whole = None
    for k in range(300):
        name = "".join(chr(97 + (k * 7 + j * k) % 26) for j in range(6))
        own = wrappers.tree(f'<body><div id="{name}-{k}" class="c{k} n-{k}x"><p id={name}>a {k}</p></div></body>')
        whole = own if whole is None else wrappers.align(whole, own)
    assert len(json.dumps(whole)) < 500


def test_pipeline_stages_take_awkward_and_empty_tables(spark):
    """Nulls in every column, repeated rows and ids, empty and long texts, clashing names; and no rows at all."""
    import corpus_pipeline

    from chartmart.session import stage

    given = awkward(spark)
    for docs in (stage(given, "awkward"), empty(spark)):
        columns = docs.columns
        for k, (name, apply) in enumerate(corpus_pipeline.STAGES):
            docs = stage(apply(spark, docs, "/root/testdata/sf0.001"), f"awkward{k}")
            assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns, name
        assert {"doc_id", "n_tokens"} <= set(docs.columns)
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, given, "").collect()}
    assert {(2, None), (3, ""), (None, None), (8, "one"), (9, "one two three")} <= kept and (7, texts()[10][1]) not in kept

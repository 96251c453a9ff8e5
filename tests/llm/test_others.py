"""Search, pages, packing, preference pairs and the pipeline."""

import html as html_module
import itertools
import random
import re

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from mediacat.llm import exact_dedup, html_wrapper, packing, preference, quality_crf, simhash, topk_search
from mediacat.llm.common import table
from tests.llm import util
from tools.check_oracle import rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op1_topk_search", "op4_exact_dedup", "op10_preference"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = queries()[name](spark, SF_DIR)
    result = con.execute(oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_all_operators_are_registered():
    names = set(queries())
    assert {int(m[1]) for n in names if (m := re.match(r"op(\d+)_", n))} == set(range(1, 11)) and "pipeline" in names


# search


def slow_top(rows, k):
    whole = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in whole if i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != q and len(v) == len(qv))[:k]
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)}
    return out


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    smooth = np.cumsum(rng.normal(size=(250, 24)), axis=1) / 5  # segments with different means: bounds that prune
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(smooth)]
    rows += [(300, None), (301, [None] * 24), (302, [float("nan")] * 24), (303, [float("inf")] * 24), (None, [1.0] * 24), (400, [1.0, 2.0]), (401, [2.0, 1.0]), (500, [])]
    rows += [(17, smooth[17].astype(np.float32).tolist()), (600, [0.0] * 24), (700, smooth[3].astype(np.float32).tolist()), (800, [0.5] * 24)]
    df = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int, cell int")
    got = [tuple(r) for r in topk_search.top_k(df, k=7, cell_rows=40, block_rows=2).collect()]
    assert set(got) == slow_top(rows, 7) and len(got) == len(set(got))
    assert topk_search.top_k(df.limit(0)).collect() == []


def test_top_k_of_huge_components(spark):
    rows = [(0, [1e15, 1.0]), (1, [1e15, 1.0]), (2, [-1e15, 3.0]), (3, [1e300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk_search.top_k(df).orderBy("rank").collect()]
    most = 2**63 - 1
    assert got == [(0, 1, 1, most), (0, 2, 3, most), (0, 3, 2, -most - 1)]


def test_bounds_hold():
    rng = np.random.default_rng(4)
    rows = rng.integers(-1000, 1000, (50, 30)).astype(float)
    for segments in (1, 4, 7, 30, 64):
        w, m, s = topk_search.statistics(rows, segments)
        bound = (m * w) @ m.T + (s * w) @ s.T
        assert (rows @ rows.T <= bound + 1e-6).all()


# pages


def page(i, body):
    return (i, f"https://h{i % 3}.example.com/{i}", body)


def test_articles_of_the_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r for r in html_wrapper.extract_articles(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        want = " ".join(html_module.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_pages_without_an_article_element(spark):
    body = (
        "<html><body class='has-sidebar'><div id=top><a href=/>Home</a> <a href=/x>About</a></div><div><p>We use small files on this site.</p></div>"
        "<div class=c><h1>Title {i}</h1><p>Long running text {i} that says <b>many</b>&nbsp;things &amp; more {j}.</p><ul><li>one {i}<li>two</ul><form><p>Name</form></div>"
        "<div class='user-comments'><p>I like number {i} a lot and say so at great length, again and again</p></div><p hidden>secret {i}</p><div>All rights reserved</div></body></html>"
    )
    rows = [page(i, body.format(i=i, j="x" * i)) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html_wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(12):
        assert got[i] == f"Title {i} Long running text {i} that says many things & more {'x' * i}. one {i} two"


@pytest.mark.parametrize("blocks", [5, 400])
def test_lists_of_any_length_are_aligned_alike(spark, blocks):
    """A block that stands first on some pages and last on others costs the rest of the list nothing, however long it is."""
    names = ["".join(p) for p in itertools.product("bdghklmnprtv", "aeiou", "bdghklmnprtv")][:blocks]
    moving = "<section><p>Moves</p></section>"
    rows = []
    for i in range(12):
        notes = "".join(f"<div class={name}><p>Note {name} {i}</p></div>" for name in names)
        story = f"<div class=story><p>Running text number {i} that is longer than all notes of the page together {'and on ' * 3 * blocks}</p></div>"
        rows.append(page(3 * i, f"<body>{moving if i % 2 else ''}{notes}{story}{'' if i % 2 else moving}</body>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = html_wrapper.extract_articles(pages).collect()
    assert len(got) == 12 and all(r["text"].startswith(f"Running text number {r['page_id'] // 3} ") and "Note" not in r["text"] for r in got)


def test_pairs_are_a_longest_common_subsequence():
    rnd = random.Random(9)
    for most, letters in [(0, 1), (6, 2), (6, 9), (60, 3), (220, 4), (220, 300)]:
        for _ in range(20 if most < 100 else 3):
            a, b = ([str(rnd.randrange(letters)) for _ in range(rnd.randint(most // 2, most))] for _ in range(2))
            table = np.zeros((len(a) + 1, len(b) + 1), int)
            for i, j in itertools.product(reversed(range(len(a))), reversed(range(len(b)))):
                table[i, j] = table[i + 1, j + 1] + 1 if a[i] == b[j] else max(table[i + 1, j], table[i, j + 1])
            want, i, j = [], 0, 0
            while i < len(a) and j < len(b):
                if a[i] == b[j]:
                    want.append((i, j))
                    i, j = i + 1, j + 1
                elif table[i + 1, j] >= table[i, j + 1]:
                    i += 1
                else:
                    j += 1
            assert html_wrapper.pairs(a, b) == want


@pytest.mark.parametrize("element", ["article", "main", "div"])
@pytest.mark.parametrize("wrapper", ["div class='content-sidebar-wrap'", "div class='main has-sidebar'", "form id=aspnetForm", "div class='main has-comments'"])
def test_wrappers_with_dropped_words(spark, element, wrapper):
    tag = wrapper.split()[0]
    inner = "<h1>Title {i}</h1><p>Long running text number {i} that goes on for a while {j}.</p><div class='share'>Share {i}</div>"
    body = (
        f"<body><nav>Menu {{i}}</nav><{wrapper}><{element} class=c>{inner}</{element}><div class=sidebar><p>Side {{i}}</p></div>"
        f"<form><p>Search {{i}}</p></form><div class=comments><p>I say {{i}}</p></div></{tag}></body>"
    )
    nested = f"<body><form><{wrapper}><{element} class=c>{inner}</{element}></{tag}</form></body>"
    inside = f"<body><{element} class=c><{wrapper}>{inner}</{tag}></{element}><div class=comments><p>{'I say so at length ' * 20}{{i}}</p></div></body>"
    for shape in (body, nested, inside):
        rows = [page(i, shape.format(i=i, j="x" * i)) for i in range(12)]
        got = {r["page_id"]: r["text"] for r in html_wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
        for i in range(12):
            assert got[i] == f"Title {i} Long running text number {i} that goes on for a while {'x' * i}."


def test_one_page_of_another_layout():
    """The wrapper of the host has its article elsewhere."""
    pages = [f"<body><article><h1>T{i}</h1><p>Long running text {i}</p></article></body>" for i in range(9)]
    pages.append("<body><form id=aspnetForm><p>A page of its own with some running text</p><div class=sidebar>Side</div></form></body>")
    trees = [html_wrapper.parse(p) for p in pages]
    whole = html_wrapper.wrap(trees[0])
    for tree in trees[1:]:
        whole = html_wrapper.merge(whole, html_wrapper.wrap(tree))
    assert html_wrapper.article_text(trees[-1], whole) == "A page of its own with some running text"
    assert html_wrapper.article_text(trees[0], whole) == "T0 Long running text 0"


@pytest.mark.parametrize("copies", [3, 1000])
def test_hosts_of_copies_keep_their_text(spark, copies):
    shapes = {"a": "<p>only", "b": "<div><h1>Title</h1><p>One paragraph of text</p></div>", "c": "<form><p>One paragraph"}
    rows = [(i, f"https://{h}.example/{i}", f"<script>{i}</script>{body}") for i in range(copies) for h, body in shapes.items()]
    rows += [(7, "https://d.example/", "<p>only")] * copies
    got = html_wrapper.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
    assert len(got) == 4 * copies
    want = {"a": "only", "b": "Title One paragraph of text", "c": "One paragraph", "d": "only"}
    assert all(r["text"] == want[r["url"][8]] for r in got)


def test_pages_repeated_do_not_hide_the_host_own_text():
    pages = [f"<body><div>All rights reserved</div><div class=c><p>Long running text {i}</p></div></body>" for i in (0, 0, 0, 1, 2)]
    for some, own in ((pages, False), (pages[:4], True)):
        whole = html_wrapper.wrap(html_wrapper.parse(some[0]))
        for text in some[1:]:
            whole = html_wrapper.merge(whole, html_wrapper.wrap(html_wrapper.parse(text)))
        assert html_wrapper.expression(whole) == "<><body><div>#TEXT</> <div.c><p>#SLOT</></></></>"
        text = whole[html_wrapper.PARTS][0][html_wrapper.PARTS][0][html_wrapper.PARTS][0]
        assert (len(text[html_wrapper.PAGES]) < html_wrapper.TEMPLATE_PAGES) == own


def test_teasers_and_comments_beside_the_article_stay_out():
    teaser = "<article><p>Teaser {i}</p></article>"
    shape = (
        "<body><div class=c><h1>T{i}</h1><p>Long running text {i} of the article, which has no element of its own</p></div>"
        f"<div class=sidebar>{teaser}{teaser}</div><div class=comments><article><p>{'I say so at length ' * 20}{{i}}</p></article></div></body>"
    )
    trees = [html_wrapper.parse(shape.format(i=i)) for i in range(5)]
    whole = html_wrapper.wrap(trees[0])
    for tree in trees[1:]:
        whole = html_wrapper.merge(whole, html_wrapper.wrap(tree))
    assert html_wrapper.article_text(trees[3], whole) == "T3 Long running text 3 of the article, which has no element of its own"


def test_odd_pages(spark):
    deep = "<div>" * 400 + "<p>deep &lt;text" + "</div>" * 300
    rows = [
        (1, None, None), (2, "no url", ""), (3, "https://a.example/", "<p>only"), (3, "https://a.example/", "<p>only"), (None, "https://b.example/", "<article>x<script>var a='</p>'</script> y<!-- z"),
        (5, "https://c.example/", "<article>" + "word " * 200_000 + "</article>"), (6, "https://d.example/", deep), (7, "https://e.example/", "a < b & c <"), (8, "https://f.example/", "<article title='x>y\">t"),
    ]
    df = spark.createDataFrame([(*r, "z", "z") for r in rows], "page_id long, url string, html string, host_ string, text string")
    got = html_wrapper.extract_articles(df).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(rows) and text[1] == "" and text[2] == "" and text[3] == "only" and text[None] == "x y"
    assert text[5] == "word " * 199_999 + "word" and text[6] == "deep <text" and text[7] == "a < b & c <"
    assert html_wrapper.extract_articles(df.limit(0)).collect() == []


@pytest.mark.parametrize("levels", [100, 255, 256, 257, 500, 5_000, 100_000])
def test_deep_pages_keep_their_text(levels):
    """Closed or not, below the last level of the tree or above: every text, in page order, and what is dropped stays dropped."""
    page = "<article>" + "<div>" * levels + "<p>one<div class=x>two <b>bold</b></div>three<script>no</script>" + "</div>" * (levels // 2) + "four<nav>no<div>no</div>no</nav><p>five"
    tree = html_wrapper.parse(page)
    wrapper = html_wrapper.wrap(tree)
    assert html_wrapper.article_text(tree, wrapper) == "one two bold three four five"
    mixed = "<article>" + "".join(f"<{t}>{i} " for i, t in zip(range(levels), itertools.cycle(("div", "p", "ul", "li", "table", "span", "a"))))
    text = html_wrapper.article_text(html_wrapper.parse(mixed), html_wrapper.wrap(html_wrapper.parse(mixed)))
    assert text.split() == [str(i) for i in range(levels)]


def test_wrapper_is_a_union_free_expression():
    pages = ["<body><nav>a</nav><h1>T</h1><p>1</p><p>2</p><footer>f</footer></body>", "<body><nav>a</nav><h1>U</h1><div>ad</div><p>3</p><footer>f</footer></body>"]
    one, two = (html_wrapper.wrap(html_wrapper.parse(p)) for p in pages)
    text = html_wrapper.expression(html_wrapper.merge(one, two))
    assert text == "<><body><nav>#TEXT</> <h1>#SLOT</> (<div>#TEXT</>)? (<p>#SLOT</>)+ <footer>#TEXT</></></>"
    group = html_wrapper.wrap(html_wrapper.parse("<dl><dt>a<dd>1<dt>b<dd>2<dt>c<dd>3</dl>"))
    assert html_wrapper.expression(group) == "<><dl>((<dt>#SLOT</> <dd>#SLOT</>))+</></>"


# packing


def test_best_fit_takes_the_fullest_bin():
    bins, contents = packing.best_fit([6, 5, 4, 3, 2], (8,), {8: 8.0})
    assert bins == [0, 1, 2, 1, 0] and contents == [8, 8, 4]


def test_pack_chooses_and_closes_sizes():
    costs = {4: 4.0, 8: 9.0}
    bins, closed, total = packing.pack([4, 4, 2, 2], costs)
    assert total == sum(costs[c] for c in closed) == 12.0 and closed == [4, 4, 4]
    assert packing.pack([], costs) == ([], [], 0)


def check_packing(rows, given, capacities):
    by_bin, by_doc = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        if r["bin"] is not None:
            by_bin.setdefault((r["bin"], r["capacity"]), []).append((r["position"], r["length"]))
        else:
            assert (r["length"], r["capacity"]) == (0, 0)
    assert len({b for b, _ in by_bin}) == len(by_bin)
    for (_, capacity), held in by_bin.items():
        held.sort()
        assert [p for p, _ in held] == [sum(n for _, n in held[:i]) for i in range(len(held))]
        used = sum(n for _, n in held)
        assert capacity == min(c for c in capacities if c >= used)
    for doc_id, size in given:
        parts = sorted(by_doc[doc_id])
        assert sum(n for _, n in parts) == size * (len([g for g in given if g[0] == doc_id]))


def test_packing_keeps_every_byte(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for df in (docs, util.clashing(util.odd_documents(spark))):
        rows = packing.pack_documents(df, shard_pieces=30).collect()
        check_packing(rows, [(r["doc_id"], len((r["text"] or "").encode())) for r in df.where("doc_id is not null").collect()], packing.CAPACITIES)
    assert packing.pack_documents(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(docs, capacities=())


def test_sequences_hold_the_texts(spark):
    rows = [(1, "abc" * 50), (2, "äö" * 30), (3, ""), (4, "x" * 999)]
    got = packing.sequences(util.documents(spark, rows), capacities=(64, 128)).collect()
    assert all(len(r["data"]) == r["n_bytes"] <= r["capacity"] for r in got)
    assert sorted(b"".join(bytes(r["data"]) for r in got)) == sorted("".join(t for _, t in rows).encode())


# preference pairs


def test_preference_pairs(spark):
    shared = [("system", "S"), ("user", "hi"), ("assistant", "yes")]
    chosen = {1: [*shared, ("user", "a"), ("assistant", "b")], 2: shared, 3: shared, 4: [("user", None)], 5: shared}
    rejected = {1: [*shared, ("user", "x")], 2: shared, 3: shared[:2], 4: [("user", "")], 6: shared}

    def frame(side):
        rows = [(i, t, role, text) for i, ts in side.items() for t, (role, text) in enumerate(ts)]
        return preference.turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).withColumnRenamed("conv_id", "pair_id")

    got = {}
    for r in preference.preference_turns(frame(chosen), frame(rejected)).collect():
        got.setdefault((r["pair_id"], r["part"]), []).append((r["turn"], r["text"], r["trained"]))

    def turn(at, role, text, trained):
        return at, f"<|{role}|>\n{text}<|end|>\n", trained

    prompt = [turn(0, "system", "S", False), turn(1, "user", "hi", False), turn(2, "assistant", "yes", False)]
    assert {k: sorted(v) for k, v in got.items()} == {
        (1, "prompt"): prompt, (1, "chosen"): [turn(3, "user", "a", False), turn(4, "assistant", "b", True)], (1, "rejected"): [turn(3, "user", "x", False)],
        (2, "prompt"): prompt, (3, "prompt"): prompt[:2], (3, "chosen"): [turn(2, "assistant", "yes", True)],
        (4, "chosen"): [turn(0, "user", "", False)], (4, "rejected"): [turn(0, "user", "", False)],
        (5, "chosen"): [*prompt[:2], turn(2, "assistant", "yes", True)], (6, "rejected"): [*prompt[:2], turn(2, "assistant", "yes", True)],
    }
    whole = {r["pair_id"]: r for r in preference.examples(preference.preference_turns(frame(chosen), frame(rejected))).collect()}
    one = whole[1]
    assert one["prompt_text"] == "".join(t[1] for t in prompt) and [one["chosen_text"][s["start"] : s["stop"]] for s in one["chosen_spans"]] == ["<|assistant|>\nb<|end|>\n"]


def test_odd_conversations(spark):
    schema = "conv_id long, turn long, role string, text string, part string, split string, at string"
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, None, "user", "c"), (None, 0, "user", "d"), (2, 5, None, None), (2, 7, "assistant", None), (3, 0, "user", "e")]
    df = spark.createDataFrame([(*r, "z", "z", "z") for r in rows], schema)
    got = [tuple(r)[:5] for r in preference.preference_turns(*preference.swapped_endings(df)).collect()]
    want = [(1, "chosen", 1, 0, "assistant"), (1, "prompt", 0, 0, "user"), (1, "prompt", 0, 1, "user"), (1, "rejected", 1, 0, "assistant")]
    want += [(2, "chosen", 7, 0, "assistant"), (2, "prompt", 5, 0, None), (2, "rejected", 7, 0, "assistant")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert preference.preference_turns(*preference.swapped_endings(df.limit(0))).collect() == []


def test_next_conversation_across_gaps(spark):
    """3,000 even ids over many ranges, conversations without an answer and ids at both ends of the type."""
    least, most = -(2**63), 2**63 - 1
    ids = [least, *range(0, 6000, 2), 10**12, most - 5, most]
    silent = {40, 10**12, most}
    rows = [(i, 0, "user", f"ask {i}") for i in ids] + [(i, 1, "assistant", f"answer {i}") for i in ids if i not in silent]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
    assert sorted(tuple(r) for r in preference.next_ids(df).collect()) == list(zip(ids, [*ids[1:], ids[0]]))
    speakers = [i for i in ids if i not in silent]
    got = {r["pair_id"]: r["text"] for r in preference.preference_turns(*preference.swapped_endings(df)).where("part = 'rejected'").collect()}
    want = {a: f"<|assistant|>\nanswer {b}<|end|>\n" for a, b in zip(speakers, [*speakers[1:], speakers[0]])}
    alone = df.where("conv_id in (40, 42)")
    assert preference.preference_turns(*preference.swapped_endings(alone)).collect() == []
    assert got == want


# pipeline


def test_pipeline_equals_brute_force(spark):
    """The classifier's decisions are taken from its own query; everything after it is computed again without Spark."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    good = {r["doc_id"] for r in quality_crf.classify(docs, labels).where("predicted = 1").collect()}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good)
    best = {}
    for i, t in rows:
        key = t.encode().translate(None, util.WHITE)
        if key not in best or (-len(t), i) < (-len(best[key][1]), best[key][0]):
            best[key] = (i, t)
    rows = sorted(best.values())
    roots = util.components([simhash.fingerprint(t.encode()) for _, t in rows], [i for i, _ in rows], 4)
    rows = [(i, t) for (i, t), root in zip(rows, roots) if i == root]
    sizes = {}
    for (i, t), mask in zip(rows, util.removed([t.encode() for _, t in rows], [i for i, _ in rows], 50)):
        kept = 0
        at = 0
        for c in t:
            n = len(c.encode())
            kept += 0 if all(mask[at : at + n]) else n
            at += n
        sizes[i] = kept
    got = {}
    result = corpus_pipeline.run(spark, SF_DIR).collect()
    for r in result:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == sizes and 0 < len(got) < 200
    check_packing(result, list(sizes.items()), packing.CAPACITIES)


def test_stages_keep_the_columns(spark):
    docs = util.odd_documents(spark)
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, docs.limit(0)):
            assert stage(spark, df, SF_DIR).columns == docs.columns
    assert exact_dedup.keep_one_of_each(docs.limit(0)).count() == 0

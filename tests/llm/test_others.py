"""Pages, archives, vectors and the pipeline."""

import hashlib
import base64

import numpy as np

from qualstar.llm import ann, html, warc
from qualstar.llm.common import table
from qualstar.llm.components import components

import __spark_entry__
import corpus_pipeline


def page(article, head="", tail=""):
    return (f"<html><head><title>T</title><script>if (a<b) '</p>'</script></head><body><nav><ul><li><a href=x>Home</a><li>About</ul></nav>{head}"
            f"{article}{tail}<footer>&copy; us</footer></body></html>")


def test_extract(spark):
    rows = [(1, "http://a.example/1", page("<article><h1>Head&amp;line</h1><p>One  <b>bold</b><br>line<p>Two</article>")),
            (2, "http://a.example/2", page("<article><h1>Other</h1><p>Three</p></article>", tail="<section id=comments><p>Nice!</p></section>")),
            *[(10 + i, f"http://b.example/{i}", page(f"<div class='post-body'><p>Text {i} of some length here</p><p>More {i * 7} words follow</p></div>",
                                                     head="<div class='cookie-notice'>We use cookies</div><div class=box>Always the same</div>")) for i in range(5)],
            (3, None, None), (4, "x", ""), (5, "http://c.example/", "plain &eacute; text"), (6, "http://c.example/x", "<p>" + "long " * 100000), (6, "http://c.example/x", "<p <<< <b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in html.extract(pages).collect() if r.page_id != 6}
    assert got[1].text == "Head&line\nOne bold line\nTwo" and got[2].text == "Other\nThree"
    assert got[10].text == "Text 0 of some length here\nMore 0 words follow"
    assert got[3].text == "" and got[4].n_chars == 0 and got[5].text == "plain é text"
    assert html.extract(pages).count() == len(rows) and html.extract(pages.limit(0)).count() == 0


def test_wrapper_has_optional_and_repeated_groups():
    a, b = (html.squash(html.stream(p)) for p in ("<div><h2>x</h2><ul><li>1<li>2</ul></div>", "<div><ul><li>1</ul><hr></div>"))
    assert html.expression(html.align(a, b)) == "<div> (<h2>)? (#literal)? (</h2>)? <ul> (<li> #slot)+ </ul> (<hr>)? </div>"


def extracted(spark, bodies, host="a.example"):
    rows = [(i, f"http://{host}/{i}", page(b)) for i, b in enumerate(bodies)]
    return {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_a_repeated_paragraph_stays_where_texts_stand(spark):
    bodies = [f"<div class=box><p>Always the same</p></div><div class=post-body><p>By staff</p><h2>Head {i}</h2><p>own text number {i}</p></div>" for i in range(5)]
    got = extracted(spark, bodies)
    assert [got[i] for i in range(5)] == [f"By staff\nHead {i}\nown text number {i}" for i in range(5)]


def test_copies_of_a_page_make_no_literals(spark):
    usual = [f"<div class=post-body><h2>Head {i}</h2><p>own text number {i}</p></div>" for i in range(6)]
    odd = "<div class=post-body><p>an unusual page</p><ul><li>with a list</ul><p>and an end</p></div>"
    got = extracted(spark, usual + [odd] * 4)
    assert [got[i] for i in range(6)] == [f"Head {i}\nown text number {i}" for i in range(6)]
    assert all(got[i] == "an unusual page\nwith a list\nand an end" for i in range(6, 10))


def test_one_article_does_not_switch_its_host(spark):
    box = "<div class=box>Always the same</div>"
    bodies = [f"{box}<div class=post-body><h2>Head {i}</h2><p>own text number {i}</p></div><div class=more>see {i}</div>" for i in range(5)]
    alone = extracted(spark, bodies)
    articles = [f"{box}<article><p>Read more here</p><h1>Title {i}</h1><p>told at length {i} {'word ' * 200}</p></article><div class=teaser>{'next ' * 300}{i}</div>" for i in range(4)]
    got = extracted(spark, bodies + articles)
    assert [got[i] for i in range(5)] == [alone[i] for i in range(5)] == [f"Head {i}\nown text number {i}" for i in range(5)]
    assert [got[5 + i] for i in range(4)] == [f"Read more here\nTitle {i}\ntold at length {i} {'word ' * 200}".strip() for i in range(4)]


def test_what_articles_share_stays(spark):
    got = extracted(spark, [f"<article><h1>Title {i}</h1><p>the same words</p></article>" for i in range(4)] + ["<article><p>the same words</p></article>"])
    assert got[0] == "Title 0\nthe same words" and got[4] == "the same words"
    recipes = [f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><ul><li>{i} eggs<li>salt</ul><h2>Method</h2><p>Boil for {i} minutes.</p></article>" for i in range(5)]
    for kind in ("article", "div class=post"):
        got = extracted(spark, [r.replace("<article>", f"<{kind}>").replace("</article>", f"</{kind.split()[0]}>") for r in recipes])
        assert [got[i] for i in range(5)] == [f"Dish {i}\nIngredients\n{i} eggs\nsalt\nMethod\nBoil for {i} minutes." for i in range(5)]


def test_no_class_word_empties_a_page(spark):
    text = "<h1>Head</h1><p>Some text of the page.</p>"
    bodies = [f"<main class='has-sidebar'>{text}</main>", f"<div class='no-sidebar'><article>{text}</article></div>", f"<div class='site nav-open'><article>{text}</article></div>",
              f"<article class='post comments-open'>{text}</article>", f"<article class='social-history'>{text}</article>", f"<form><article>{text}</article></form>",
              f"<div class=newsletter><div class=content>{text}</div></div>", f"<form id=aspnetForm><div>{text}</div></form>",
              f"<div class='search-results'><main>{text}<div class=share>Share it</div></main><section class=comments><article>Nice</article></section></div>",
              f"<div class=promo><p>Buy</p></div><div class=widget>{text}</div>",
              f"<div class=layout-sidebar>{text}<div class=sidebar>Links</div></div><section id=comments><article class=comment><p>I agree</p></article></section>"]
    for i, body in enumerate(bodies):
        got = extracted(spark, [body], host=f"h{i}.example")
        assert got[0] == "Head\nSome text of the page.", body
    only_comments = extracted(spark, ["<div class=comments><article>Nice</article></div>"])
    assert only_comments[0] == ""


def test_hosts_of_any_block_order_extract(spark):
    """Random articles: every page's text comes back whole, and wrappers stay small."""
    rng = np.random.default_rng(8)
    make = {"p": "<p>t{0}</p>", "h2": "<h2>h{0}</h2>", "ul": "<ul><li>a{0}<li>b{0}<ul><li>c{0}</ul></ul>", "blockquote": "<blockquote><p>q{0}</p></blockquote>",
            "div": "<div><div><p>d{0}</p></div><div><p>e{0}</p></div></div>", "table": "<table><tr><td>x{0}<td>y{0}</table>"}
    want = {"p": ["t{0}"], "h2": ["h{0}"], "ul": ["a{0}", "b{0}", "c{0}"], "blockquote": ["q{0}"], "div": ["d{0}", "e{0}"], "table": ["x{0}", "y{0}"]}
    given = ["p h2 p p ul p", "p h2 p p h2", "ul p p", "p h2 blockquote p p blockquote"]
    hosts = [[g.split() for g in given]] + [[[str(k) for k in rng.choice(list(make), int(rng.integers(1, 30)))] for _ in range(int(rng.integers(2, 12)))] for _ in range(1000)]
    params = html.HtmlParams()
    for pages in hosts:
        bodies = [page(f"<article>{''.join(make[k].format(f'{n}-{j}') for j, k in enumerate(kinds))}</article>") for n, kinds in enumerate(pages)]
        wrapper = None
        for b in bodies:
            w = html.squash(html.stream(b))
            wrapper = w if wrapper is None else html.align(wrapper, w)
            assert html._size(wrapper) <= params.most_items + 1
        rule = html.verdict(wrapper, params)
        for n, (b, kinds) in enumerate(zip(bodies, pages, strict=True)):
            assert html.main_text(b, rule).split("\n") == [t.format(f"{n}-{j}") for j, k in enumerate(kinds) for t in want[k]]


def test_deep_and_long_pages_of_one_host(spark):
    rng = np.random.default_rng(9)
    deep = "<ul><li>" * 200 + "bottom" + "</ul>" * 200
    rows = [page(f"<article>{deep}</article>"), page("<div>" * 300 + "<p>inside</p>"), page("<article>" + "".join(f"<p>t{j}</p><h2>h{j}</h2>" for j in range(3000)) + "</article>")]
    rows += [page("<article>" + "".join(f"<{k}>w{n}-{j}</{k}>" for j, k in enumerate(rng.choice(["p", "h2", "pre", "blockquote"], 60))) + "</article>") for n in range(200)]
    table_ = spark.createDataFrame([(i, "http://one.example/", r) for i, r in enumerate(rows)], "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in html.extract(table_).collect()}
    assert got[0] == "bottom" and got[1] == "inside" and got[2].count("\n") == 5999
    assert all(got[3 + n].split("\n") == [f"w{n}-{j}" for j in range(60)] for n in range(200))


def test_whole_pages_table_against_element_text(spark, sf):
    """Every given page has one article or main element: its text without the parts that are never main text, by a parser of its own."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.open, self.blocks, self.run = [], [], []

        def flush(self):
            if t := " ".join("".join(self.run).split()):
                self.blocks.append(t)
            self.run = []

        def handle_starttag(self, tag, attrs):
            if tag in html._INLINE:
                self.run += [" "] * (tag == "br")
                return
            self.flush()
            if tag in html._LOOSE:
                while self.open and self.open[-1][0] in html._LOOSE and self.open[-1][0] == tag:
                    self.open.pop()
            if tag not in html._VOID:
                names = " ".join(v or "" for k, v in attrs if k in ("id", "class"))
                out = tag in html._ASIDE | {"form"} | html._RAW or tag not in ("html", "body", "article", "main") and any(w in html._ASIDE_WORDS | html._COMMENT_WORDS for w in html._words(names))
                self.open.append((tag, out))

        def handle_endtag(self, tag):
            if tag in html._INLINE:
                return
            self.flush()
            if any(t == tag for t, _ in self.open):
                while self.open.pop()[0] != tag:
                    pass

        def handle_data(self, data):
            tags = [t for t, _ in self.open]
            if {"article", "main"} & set(tags) and not any(out for _, out in self.open):
                self.run.append(data)

    def want(text):
        reader = Reader()
        reader.feed(text)
        reader.flush()
        return "\n".join(reader.blocks)

    rows = table(spark, sf, "pages").collect()
    got = {r.page_id: r.text for r in html.extract(table(spark, sf, "pages").select("page_id", "url", "html")).collect()}
    assert len(got) == len(rows) and {r.page_id: want(r.html or "") for r in rows} == got


def test_odd_pages(spark):
    rows = [(1, "http://a/", "<article>x</article>", "h", 3, "w"), (1, "http://a/", "<article>x</article>", "h", 3, "w"), (None, None, "<main>y</main>", None, None, None), (2, "http://b/", None, None, None, None)]
    got = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, host string, salt int, wrapper string")).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0), ("x", 1), ("x", 1), ("y", 1)]

def test_archive_round_trip(spark):
    body = ["<p>same</p>", "<p>same</p>", None, "", "é" * 100000, "<p>other</p>"]
    rows = [(9 - i, f"http://h/{i}", b) for i, b in enumerate(body)] + [(None, None, "<p>same</p>"), (1 << 60, "http://h/\n", "<p>\r\n\r\n</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write_archive(pages)
    index = warc.read_index(spark, archive)
    got = {r.page_id: r for r in warc.read_records(spark, archive, index, with_payload=True).collect()}
    assert len(got) == len(rows) == index.count()
    for i, _, b in rows:
        data = (b or "").encode()
        assert got[i].payload_bytes == len(data) and got[i].payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[i].payload is None or bytes(got[i].payload) == data
    assert (got[8].record_type, got[9].record_type, got[9].refers_to, got[None].refers_to) == ("response", "revisit", 8, 8)
    assert (got[6].record_type, got[7].refers_to) == ("response", 6)
    few = warc.read_records(spark, archive, index.filter("page_id = 5"), with_payload=True).collect()
    assert [bytes(r.payload) for r in few] == [("é" * 100000).encode()]
    empty = warc.write_archive(pages.limit(0))
    assert warc.read_records(spark, empty, warc.read_index(spark, empty)).count() == 0


def test_coalesced_reads():
    assert warc.coalesced([(0, 5), (5, 5), (30, 5)], 10, 100) == [(0, 10, [0, 1]), (30, 35, [2])]
    assert warc.coalesced([(0, 5), (5, 5)], 10, 7) == [(0, 5, [0]), (5, 10, [1])]


def brute(ids, x, k=20):
    out = {}
    for q in [i for i in ids if i % 20 == 0]:
        s = (x * x[ids.index(q)]).sum(1)
        out[q] = [ids[j] for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
    return out


def test_search_small_table_is_exact(spark, sf):
    got = ann.search(table(spark, sf, "embeddings")).toPandas()
    rows = table(spark, sf, "embeddings").orderBy("vec_id").collect()
    want = brute([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))
    assert {q: g.sort_values("rank").vec_id.tolist() for q, g in got.groupby("query_id")} == want


def test_search_recall_with_lists(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 24))
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = ann.search(data, ann.AnnParams(least_scan=100, list_rows=100, sample=500)).toPandas()
    want = brute(list(range(3000)), x)
    hits = sum(len(set(g.vec_id) & set(want[q])) for q, g in got.groupby("query_id"))
    assert hits / (20 * len(want)) >= 0.9


def test_a_list_is_scanned_like_one_by_one():
    rng = np.random.default_rng(3)
    x, q = rng.normal(size=(700, 40)), rng.normal(size=(33, 40))
    ids, qids = np.arange(700) * 3, np.arange(33) * 30
    far = ((x[None] - q[:, None]) ** 2).sum(2)
    bound = np.sort(far, 1)[:, 30]
    for few in (0.0, 0.05, 1.0):
        p = ann.AnnParams(few=few, eps=50.0)       # nobody is abandoned too soon
        i, j, score = ann.scan_list(ids, x, ann.column_blocks(x.astype(np.float32), 16), qids, q, q.astype(np.float32), bound, p)
        for n in range(33):
            fine = [m for m in range(700) if far[n, m] <= bound[n] and ids[m] != qids[n]]
            want = sorted(fine, key=lambda m: (-float(x[m] @ q[n]), ids[m]))[:p.k]
            assert j[i == n].tolist() == want
            assert np.allclose(score[i == n], x[want] @ q[n], rtol=1e-12)
    loose = ann.scan_list(ids, x, ann.column_blocks(x.astype(np.float32), 16), qids, q, q.astype(np.float32), np.full(33, np.inf), ann.AnnParams())
    assert len(loose[0]) == 33 * 20
    assert [len(z) for z in ann.scan_list(ids, x, ann.column_blocks(x.astype(np.float32), 16), qids, q, q.astype(np.float32), np.zeros(33), ann.AnnParams())] == [0, 0, 0]


def test_search_above_the_least_scan(spark):
    """Production parameters, more rows than are searched whole; lists out of reach are skipped without a loss."""
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(40, 24)) * 8
    for x in (rng.normal(size=(9000, 24)), middle[rng.integers(0, 40, 9000)] + rng.normal(size=(9000, 24)) * 0.3):
        data = spark.createDataFrame([(i, v.tolist(), 1, 2.0, 3) for i, v in enumerate(x)], "vec_id long, embedding array<double>, list int, far double, rank int")
        got = ann.search(data).toPandas()
        want = brute(list(range(9000)), x)
        assert sorted(got.query_id.unique()) == sorted(want) and (got.groupby("query_id").size() == 20).all()
        assert sum(len(set(g.vec_id) & set(want[q])) for q, g in got.groupby("query_id")) / (20 * len(want)) >= 0.9


def test_rows_of_one_id_are_one_query(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 5.0]), *[(i, [float(i), 1.0]) for i in range(1, 30)]]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).filter("query_id = 0").orderBy("rank").collect()
    best = sorted(range(1, 30), key=lambda i: (-max(float(i), 5.0), i))[:20]
    assert [r.vec_id for r in got] == best


def test_search_odd_rows(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [nan, 1.0]), (80, [None, 1.0]), (100, [1.0]), (None, [1.0, 1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]),
            *[(1000 + i, [1.0, 0.0]) for i in range(1, 60)]]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(data).orderBy("query_id", "rank").collect()
    of0 = [r.vec_id for r in got if r.query_id == 0]
    assert of0 == [7, *range(1001, 1020)] and {r.query_id for r in got} == {0, 1020, 1040}
    assert ann.search(data.limit(0)).count() == 0 and ann.search(data.filter("vec_id = 20")).count() == 0


def test_components_of_a_path_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[1000 + i] == 1000 for i in range(50))


def test_queries_match_their_sql(spark, sf):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    for name in ("op3_warc", "op5_minhash", "op6_decontamination"):
        got = __spark_entry__.queries()[name](spark, sf)
        want = con.execute(__spark_entry__.oracle_sql()[name])
        names = [d[0] for d in want.description]
        assert sorted(names) == sorted(got.columns)
        assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_pipeline(spark, sf):
    docs = table(spark, sf, "documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near duplicates", "decontamination", "mixing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
    out = corpus_pipeline.run(spark, sf)
    assert out.filter("copies < 1").count() == 0 and out.select("doc_id").distinct().count() == out.count() > 0
    # A document that the stages before left without a word is not in the mix.
    assert out.filter("size < 1 or not rlike(text, '[^ \\\\t-\\\\r]')").count() == 0


def test_pipeline_on_odd_documents(spark, sf, folder):
    """Nulls, empties, repeated rows, copies, clashing and further columns through all five stages."""
    import os
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    shared = words("s", 60)
    rows = [(1, words("a", 90), "x"), (1, words("a", 90), "x"), (2, words("a", 90), "y"), (3, words("a", 89) + " end", None), (None, None, None), (None, words("n", 40), "x"), (4, "", "x"),
            (5, " \n ", None), (6, None, "y"), (7, f"{shared}\n{words('b', 30)}", "y"), (8, f"{shared}\n{words('c', 30)}", "y"), (9, words("long", 50000), "x")]
    docs = spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 1, 2.0, "b", 5, 0.1) for i, t, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, copies int, taken double, block string, size int, score double")
    docs.write.parquet(os.path.join(folder, "documents.parquet"))
    for t in ("labels", "benchmark"):
        table(spark, sf, t).write.parquet(os.path.join(folder, f"{t}.parquet"))
    given = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (given, given.limit(0)):
            got = stage(spark, df, folder)
            assert got.columns == df.columns and got.dtypes == df.dtypes and got.count() <= df.count()
    out = corpus_pipeline.run(spark, folder).collect()
    ids = {r.doc_id for r in out}
    assert ids <= {r[0] for r in rows} and not ids & {4, 5, 6} and all(r.text.split() and r.copies >= 1 for r in out)
    assert 2 not in ids and 3 not in ids and 9 in ids


def test_decontamination_sql_reports_items_without_an_id(spark, folder):
    import duckdb
    import os
    docs = [(1, "see Leaked words of nobody here"), (2, "an other lost item too"), (3, "clean"), (4, None)]
    items = [(None, "leaked words of nobody"), (7, "leaked words of nobody"), (None, "other lost item"), (8, None)]
    con = duckdb.connect()
    for name, rows, schema in (("documents", docs, "doc_id long, text string"), ("benchmark", items, "item_id long, text string")):
        spark.createDataFrame(rows, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    got = __spark_entry__.queries()["op6_decontamination"](spark, folder)
    want = con.execute(__spark_entry__.oracle_sql()["op6_decontamination"])
    names = [d[0] for d in want.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))


def test_phrases_match_their_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.01/documents.parquet'")
    got = __spark_entry__.queries()["op11_collocations"](spark, "/root/testdata/sf0.01")
    want = con.execute(__spark_entry__.oracle_sql()["op11_collocations"])
    names = [d[0] for d in want.description]
    assert sorted(map(str, (tuple(r[c] for c in names) for r in got.collect()))) == sorted(map(str, want.fetchall()))

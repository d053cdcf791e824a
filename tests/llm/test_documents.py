"""Operators on documents: brute force on a small table, odd rows, empty tables."""

import collections
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from qualstar.llm import decontaminate, language, linededup, mixing, neardup, quality, toxicity
from qualstar.llm.common import stratified_ids, table, window_hashes, word_hashes, NON_SPACE

LONG = " ".join(f"w{i}" for i in range(200000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, "same words in a row here"), (5, "same words in a row here"), (None, "a text without an id"),
       (6, "!!! ???"), (7, "Ünïcode ñ é   line"), (8, "x"), (None, None)]


def test_word_hashes_equal_words_equal_hashes():
    text = b"ab cd ab\n" * 20000
    h, start, end = word_hashes(text, NON_SPACE)
    assert len(h) == 60000 and len(np.unique(h)) == 2 and (h[0::3] == h[2::3]).all()
    w = window_hashes(h, 2)
    assert len(w) == 59999 and len(np.unique(w)) == 3
    assert len(window_hashes(h[:1], 2)) == 0


def brute_components(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    holders = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    both = collections.Counter(p for v in holders.values() for p in itertools.combinations(sorted(v), 2))
    for (a, b), k in both.items():
        if 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def test_near_duplicates_match_brute_force(spark, sf, frame):
    rng = np.random.default_rng(3)
    base = [f"t{k}" for k in rng.integers(0, 900, 90)]
    family = []
    for i in range(60):
        w = list(base)
        for at in rng.integers(0, 90, rng.integers(0, 6)):
            w[at] = f"n{i}x{at}"
        family.append((100000 + i, " ".join(w)))
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()] + family + [(200001, None), (200002, "")]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(frame(rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_odd_rows(frame):
    docs = frame(ODD)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == len(ODD)
    assert {(r.doc_id, r.kept) for r in got if r.doc_id == 5} == {(5, True)}
    kept = neardup.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(ODD) - 1
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_line_dedup(frame):
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(30)) for i in range(2))
    rows = [(1, "intro one\n" + passage + "\nend one"), (2, "intro two\n" + passage + "\nend two"), (3, "short shared\nlines only"),
            (4, "short shared\nlines only"), (5, "moved\n" + "\n".join(reversed(passage.split("\n")))), *[(100 + i, t) for i, t in ODD if i]]
    out = {r.doc_id: r for r in linededup.dedup_lines(frame(rows)).collect()}
    assert out[1].deduped == rows[0][1] and out[2].deduped == "intro two\nend two" and out[2].n_removed == 2
    assert out[4].deduped == rows[3][1] and out[5].n_removed == 0      # a line of 30 words alone is no passage
    assert out[101].deduped is None and out[104].deduped == LONG
    same = linededup.replace_text(frame(rows))
    assert same.columns == frame(rows).columns and same.filter("doc_id = 2").first().n_chars == len("intro two\nend two")
    assert linededup.dedup_lines(frame(rows).limit(0)).count() == 0


def brute_lines(rows, min_words):
    """Lines of words of each later row that stand in a block of at least ``min_words`` words of an earlier one."""
    split = [[" ".join(x.split()) for x in (t or "").split("\n") if x.split()] for _, t in rows]
    out, blocks = [], set()
    for lines in split:
        found = set()
        spans = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines) + 1) if sum(len(x.split()) for x in lines[i:j]) >= min_words]
        for i, j in spans:
            if tuple(lines[i:j]) in blocks:
                found |= set(range(i, j))
        blocks |= {tuple(lines[i:j]) for i, j in spans}
        out.append(len(found))
    return out


def test_line_dedup_deletes_the_tail_that_the_first_holder_lacks(frame):
    def line(name, n):
        return " ".join(f"{name}{k}" for k in range(n))
    head, tail = line("h", 50), line("t", 45)
    rows = [(1, f"{head}\n{line('a', 60)}"), (2, f"{head}\n{tail}\n{line('b', 60)}"), (3, f"{head}\n{tail}\n{line('c', 60)}")]
    got = {r.doc_id: r.deduped for r in linededup.dedup_lines(frame(rows)).collect()}
    assert got == {1: rows[0][1], 2: f"{tail}\n{line('b', 60)}", 3: line("c", 60)}


def test_line_dedup_of_a_table_matches_brute_force(frame):
    rng = np.random.default_rng(11)
    pool = [" ".join(f"p{k}w{j}" for j in range(rng.integers(1, 40))) for k in range(12)]
    rows = [(i, "\n".join(pool[k] for k in rng.integers(0, 12, rng.integers(1, 14)))) for i in range(150)]
    rows += [(150 + i, "\n".join([*(pool + pool)[k:k + 5], f"end {i}"])) for i, k in enumerate(rng.integers(0, 19, 60).tolist())]
    got = {r.doc_id: r.n_removed for r in linededup.dedup_lines(frame(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == brute_lines(rows, 50)


def brute_short_blocks(rows, min_words=50, block_words=5, rare_rows=50):
    """Lines deleted from each row, for rows whose lines are all different and in one order."""
    split = [t.split("\n") for _, t in rows]
    held = collections.defaultdict(list)
    for i, lines in enumerate(split):
        for x in lines:
            held[x].append(i)
    size = {x: len(x.split()) for x in held}
    out = []
    for i, lines in enumerate(split):
        gone = set()
        for a in range(i):
            at = {x: k for k, x in enumerate(split[a])}
            rare = {x for x in lines if held[x][0] == a and len(held[x]) <= rare_rows}
            overlap = sum(size[x] for x in rare) >= min_words
            for _, block in itertools.groupby(enumerate(lines), lambda e: e[0] - at[e[1]] if e[1] in at else None):
                block = [x for _, x in block]
                n = sum(size[x] for x in block)
                if block[0] in at and (n >= min_words or overlap and n >= block_words and rare & set(block)):
                    gone |= set(block)
        out.append([x for x in lines if x not in gone])
    return out


def test_line_dedup_deletes_short_blocks_of_copies(frame):
    rng = np.random.default_rng(5)
    hot = [" ".join(f"hot{k}w{j}" for j in range(8)) for k in range(3)]
    rows = []
    for family in range(20):
        base = [" ".join(f"f{family}l{k}w{j}" for j in range(rng.integers(2, 14))) for k in range(24)]
        for k, x in enumerate(hot):           # in every row: not rare
            base.insert(k * 4, x)
        for _ in range(6):
            lines = [x if x in hot or rng.random() > 0.3 else f"own {len(rows)} line {k}" for k, x in enumerate(base) if x in hot or rng.random() > 0.1]
            rows.append((len(rows), "\n".join(lines)))
    # Rows that share a line of each of two families with them, and little else.
    for k in range(10):
        rows.append((len(rows), "\n".join([rows[0][1].split("\n")[k + 1], rows[7][1].split("\n")[k + 1], f"a text of its own {k}"])))
    want = brute_short_blocks(rows)
    got = {r.doc_id: r.deduped for r in linededup.dedup_lines(frame(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == ["\n".join(x) for x in want]
    passages = brute_short_blocks(rows, block_words=50)
    assert sum(map(len, passages)) > sum(map(len, want)) + 300 and all(len(x) == 3 for x in want[-10:])
    assert all(set(hot[1:]) & set(x) for x in want[:6])
    assert all(got[i] == rows[i][1] for i in range(120, 130))


def test_line_dedup_with_only_frequent_lines_goes_by_runs(frame):
    """A line in more rows than are rare still goes with a passage it stands in."""
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(30)) for i in range(3))
    rows = [(i, f"begin {i}\n{passage}\nend {i}") for i in range(80)]
    out = {r.doc_id: r.deduped for r in linededup.dedup_lines(frame(rows)).collect()}
    assert out == {i: rows[0][1] if i == 0 else f"begin {i}\nend {i}" for i in range(80)}


def test_line_dedup_compares_rows_without_an_id(spark, frame):
    passage, other = ("\n".join(" ".join(f"{c}{i}w{j}" for j in range(30)) for i in range(2)) for c in "pq")
    rows = [(None, f"start {i}\n{passage}\nend {i}") for i in range(5)] + [(None, other)] * 4 + [(None, None)] * 3 + [(None, "few words")] * 3
    out = linededup.dedup_lines(frame(rows)).collect()
    texts = [r.deduped for r in out]
    assert len(out) == len(rows) and texts.count(None) == 3 and texts.count("few words") == 3
    assert sum(passage in (t or "") for t in texts) == 1 and sorted(r.n_removed for r in out) == [0] * 8 + [2] * 7
    assert texts.count(other) == 1 and texts.count("") == 3
    # An id comes first, whatever the rows' hashes.
    out = linededup.dedup_lines(frame([*rows, (9, passage), ((1 << 63) - 1, other)])).collect()
    assert {r.doc_id: r.n_removed for r in out if r.doc_id} == {9: 0, (1 << 63) - 1: 0}
    assert sorted(r.n_removed for r in out if not r.doc_id) == [0] * 6 + [2] * 9


@pytest.mark.parametrize("seed", range(20))
def test_shared_blocks_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 6, 25).astype(np.uint64), rng.integers(0, 6, 25).astype(np.uint64)
    words = np.full(25, 10)
    got = set(linededup.shared_blocks(a, b, words, 30).tolist())
    least = {k for i in range(23) for k in range(i, i + 3) if any((a[j:j + 3] == b[i:i + 3]).all() for j in range(23))}
    assert got == least


def test_patience_keeps_order():
    to = linededup.patience_match(np.array([1, 2, 3, 4], np.uint64), np.array([1, 9, 3, 4], np.uint64))
    assert to.tolist() == [0, -1, 2, 3]


def test_decontamination(spark, frame):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "tiny item"), (3, None), (10, "tiny item"), (None, "x")],
                                  "item_id long, text string")
    rows = [(1, "pre One, two; three four five six seven eight nine ten post"), (2, "a TINY item here"), (3, "clean words"), *[(100 + i, t) for i, t in ODD if i]]
    got = {r.doc_id: r for r in decontaminate.report(frame(rows), items).collect()}
    assert (got[1].n_words, got[1].n_hit, got[1].n_items, got[1].contaminated) == (12, 10, 1, True)
    assert (got[2].n_hit, got[2].items_sha256) == (2, decontaminate.sha256_of([2, 10]))
    assert (got[3].n_hit, got[3].items_sha256, got[101].n_words) == (0, decontaminate.sha256_of([]), 0)
    blocks = decontaminate.DecontaminationParams(max_bytes=20)
    assert {r.doc_id: r for r in decontaminate.report(frame(rows), items, blocks).collect()} == got
    clean = decontaminate.clean(frame(rows), items)
    assert clean.columns == frame(rows).columns and {r.doc_id: r.text for r in clean.collect()}[2] == "a  here"
    assert decontaminate.report(frame(rows), items.limit(0)).filter("contaminated").count() == 0
    assert decontaminate.clean(frame(rows).limit(0), items).count() == 0


def test_decontamination_finds_passages_of_items_without_an_id(spark, frame):
    items = spark.createDataFrame([(None, "leaked words of nobody"), (7, "leaked words of nobody"), (None, "other lost item")], "item_id long, text string")
    rows = [(1, "see Leaked words of nobody here"), (2, "an other lost item too"), (3, "clean")]
    for params in (decontaminate.DecontaminationParams(), decontaminate.DecontaminationParams(max_bytes=20)):
        got = {r.doc_id: (r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.report(frame(rows), items, params).collect()}
        none = decontaminate.sha256_of([])
        assert got == {1: (4, 1, decontaminate.sha256_of([7]), True), 2: (3, 0, none, True), 3: (0, 0, none, False)}
        assert {r.doc_id: r.text for r in decontaminate.clean(frame(rows), items, params).collect()} == {1: "see  here", 2: "an  too", 3: "clean"}


def test_mixing(spark, sf, frame):
    docs = table(spark, sf, "documents")
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    total = got["size"].sum()
    per = got.groupby("source_x" if "source_x" in got else "source", dropna=False) if False else got.iloc[:, ~got.columns.duplicated()].groupby("source", dropna=False)
    targets, taken, sizes = per.target.first(), per.taken.sum(), per["size"].sum()
    # Water filling, one source at a time.
    names = sorted(targets.index)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    want, open_, left = {}, set(names), float(total)
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 3 * sizes[s]]
        if not over:
            want |= {s: weight[s] * level for s in open_}
            break
        for s in over:
            want[s] = 3.0 * sizes[s]
            left -= want[s]
            open_.discard(s)
    assert all(abs(targets[s] - want[s]) < 1e-6 for s in names)
    assert (got.taken <= 3 * got["size"]).all()
    assert all(abs(taken[s] - targets[s]) <= got[got.iloc[:, ~got.columns.duplicated()].source == s]["size"].max() for s in names)
    again = mixing.mix(docs.repartition(3)).toPandas().sort_values("doc_id")
    assert again.taken.tolist() == got.sort_values("doc_id").taken.tolist()


def test_mixing_odd_rows(spark, frame):
    docs = frame(ODD).withColumn("source", F.when(F.col("doc_id") > 4, F.lit("b")))
    assert mixing.mix(docs).count() == len(ODD)
    assert set(mixing.mixture(docs).columns) == {*docs.columns, "size", "source_size", "target", "copies", "taken"}
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixture(docs.limit(0)).count() == 0


def test_mixing_spreads_repeated_rows_over_blocks(spark, frame, monkeypatch):
    rows = [(None, None)] * 3000 + [(None, "the same three words")] * 3000 + [(i, f"own words {'x ' * (i % 7)}") for i in range(1000)]
    params, sizes, own = mixing.MixParams(weights=(1.0,), block_rows=500), [], mixing._round_groups
    docs = frame(rows).withColumn("source", F.when(F.col("doc_id") < 500, "a").otherwise("b"))

    def counted(rows, by, seed):
        n = F.sum("n") if "n" in rows.columns else F.count("*")
        sizes.extend(r.n for r in rows.groupBy(*by).agg(n.alias("n")).collect())
        return own(rows, by, seed)
    monkeypatch.setattr(mixing, "_round_groups", counted)
    got = mixing.mix(docs, params).toPandas()
    assert max(sizes) <= 2 * params.block_rows
    assert len(got) == len(rows) and (got[got["size"] == 0].taken == 0).all() and (got["size"] == 0).sum() == 3000
    for _, part in got.groupby("source"):
        assert abs(part.taken.sum() - part.target.iloc[0]) <= part["size"].max()
    assert mixing.mixture(docs, params).agg(F.sum("taken")).first()[0] == got.taken.sum()


def test_pivot_keeps_words():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 50, 200).astype(float)
    sums = []
    for s in range(200):
        p, hold = mixing.pivot(np.full(200, 0.3), size, np.random.default_rng(s).random(200))
        assert abs((p * size).sum() - 0.3 * size.sum()) < 1e-6 and sum((x > 0) & (x < 1) for x in p) == (hold >= 0)
        sums.append(p[:5])
    assert abs(np.mean(sums) - 0.3) < 0.05


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_classifiers_on_labelled_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    tox = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert ((tox.predicted == tox.toxic).mean() > 0.9) and tox.score.between(0, 1).all()
    good = quality.classify(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (good.predicted == good.quality).mean() > 0.9
    lang = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (lang.lang_pred == lang.lang).mean() > 0.95 and lang.score.between(0, 1).all()


def test_classifiers_odd_rows(spark, frame):
    docs = frame(ODD)
    labels = labels_of(spark, [(i, i % 2, i % 2) for i in range(1, 9)] + [(None, 1, 1), (4, None, None), (4, 0, 0)])
    for out in (toxicity.classify(docs, labels), quality.classify(docs, labels), toxicity.classify(docs, labels.limit(0)), quality.classify(docs, labels.limit(0))):
        rows = out.collect()
        assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    und = {r.doc_id: r.lang_pred for r in language.identify(docs).collect() if r.doc_id}
    assert und[1] == und[2] == und[6] == "und" and und[5] == "en"
    assert language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0
    empty = docs.limit(0)
    assert toxicity.classify(empty, labels).count() == quality.classify(empty, labels).count() == language.identify(empty).count() == 0
    assert toxicity.reject(docs, labels).columns == docs.columns


def test_rows_that_share_an_id_are_learnt_from_once(spark, frame):
    rows = [(i, f"plain words number {i} about the garden" if i % 2 else f"hateful awful filth number {i}") for i in range(1, 60)]
    labels = labels_of(spark, [(i, 1, 1 - i % 2) for i in range(1, 60)])
    docs, repeated = frame(rows), frame(rows + rows[:2] * 500)
    q = labels_of(spark, [(i, i % 2, 0) for i in range(1, 60)])
    a, b = ({r.doc_id: r.score for r in quality.classify(d, q).collect()} for d in (docs, repeated))
    assert a == pytest.approx(b)
    for train in (lambda d: toxicity.train(d, labels).weights, lambda d: language.train(d).table):
        np.testing.assert_allclose(train(docs), train(repeated))
    assert language.train(repeated).langs == ["en"]


def test_character_grams_are_whole_characters():
    from qualstar.llm.common import char_grams
    text = "ab\u043f\u0440\u0438\u4f60\u597d\U0001f600ab\u043f"
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    seen = {}
    for n, grams in zip((1, 2, 3, 5), char_grams(codes, (1, 2, 3, 5)), strict=True):
        assert len(grams) == len(text) - n + 1
        for i, g in enumerate(grams.tolist()):
            assert seen.setdefault(g, text[i:i + n]) == text[i:i + n]
    assert len(seen) == len({text[i:i + n] for n in (1, 2, 3, 5) for i in range(len(text) - n + 1)})
    assert [len(g) for g in char_grams(codes[:2], (1, 3, 5))] == [2, 0, 0]


@pytest.mark.parametrize("bad, good", [("\u0443\u0436\u0430\u0441\u043d\u044b\u0439 \u0433\u0430\u0434", "\u0434\u043e\u0431\u0440\u043e\u0435 \u0443\u0442\u0440\u043e"), ("\u53ef\u6076\u7684\u574f\u86cb", "\u6e29\u6696\u7684\u65e9\u6668")])
def test_toxicity_of_other_scripts(spark, frame, bad, good):
    rng = np.random.default_rng(5)
    fill = [chr(int(c)) for c in rng.integers(ord(good[0]) - 20, ord(good[0]) + 20, 40)]
    rows = [(i, "".join(rng.choice(fill, 30)) + " " + (bad if i % 2 else good) + " " + "".join(rng.choice(fill, 30))) for i in range(1, 200)]
    got = toxicity.classify(frame(rows), labels_of(spark, [(i, 0, i % 2) for i in range(1, 200)])).collect()
    assert all(r.predicted == r.doc_id % 2 for r in got if r.held_out) and sum(r.held_out for r in got) > 20


def test_scores_match_the_models_in_plain_python(spark, sf):
    """The fitted models over the whole small table, one text at a time."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.train(docs, labels)
    place = {int(g): k for k, g in enumerate(model.grams)}
    from qualstar.llm.common import char_grams
    for r in toxicity.classify(docs, labels).collect():
        t = texts[r.doc_id] or ""
        norm = f" {' '.join(t.lower().split())} " if t else ""
        grams = {int(next(char_grams(np.array([ord(c) for c in norm[i:i + n]], np.uint32), (n,)))[0]) for n in model.params.orders for i in range(len(norm) - n + 1)} if len(norm) < 1500 else None
        if grams is not None:
            z = sum(model.weights[place[g]] for g in grams if g in place) + model.bias
            assert r.score == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    stats = quality.document_statistics(docs)
    marked = labels.filter("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0").groupBy("doc_id").agg(F.max("quality").alias("label"))
    fit = quality.fit(stats.join(marked, "doc_id").select("stats", "label"))
    for r in quality.classify(docs, labels).collect():
        x = quality.statistics(texts[r.doc_id])
        d = [-0.5 * (float(sum(((x - m) @ f.T) ** 2)) + ld) for m, f, ld in zip(fit.means, fit.factors, fit.log_dets, strict=True)]
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip((d[1] - d[0] + fit.log_prior) / fit.temperature, -500, 500))), rel=1e-6, abs=1e-9)


def test_a_large_benchmark_fits_in_memory():
    """Windows of a full block take some 20 bytes each besides the text, and are found."""
    rng = np.random.default_rng(12)
    items = [(str(i), " ".join(f"w{k}" for k in rng.integers(0, 10 ** 6, 500))) for i in range(400)] + [("a", "some words"), ("b", "Some, words"), (None, "nobody's item")]
    index = decontaminate.WindowIndex(items, 10)
    held = sum(x.nbytes for x in (index.hashes, index.begins, index.ends, index.owners, index.near)) + len(index.text)
    assert held < 40 * len(index.hashes) + (1 << 22) and len(index.hashes) > 190000
    for i in (0, 57, 399):
        w = items[i][1].split()
        n, spans, found = index.scan("x " + " ".join(w[100:120]).upper() + " y some words nobody s item")
        assert (n, spans, found) == (27, [(1, 21), (22, 27)], {str(i), "a", "b"})
    assert index.scan(" ".join(items[3][1].split()[:9]))[1] == []


def test_line_dedup_keeps_columns_of_its_own_names(frame):
    docs = frame([(1, "a b"), (2, None)]).withColumn("deduped", F.lit("mine")).withColumn("n_removed", F.lit(9))
    out = linededup.replace_text(docs)
    assert out.columns == docs.columns and sorted(map(str, out.collect())) == sorted(map(str, docs.collect()))
    assert linededup.dedup_lines(docs).filter("doc_id = 1").first().deduped == "a b"


def test_stratified_ids_are_the_smallest_hashes(spark):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 29000, "a").when(F.col("id") < 29990, "b").alias("label"))
    got = {(r.doc_id, r.label) for r in stratified_ids(rows, 100).collect()}
    hashed = rows.filter("label is not null").withColumn("h", F.xxhash64("doc_id")).toPandas()
    want = {(int(r.doc_id), k) for k, part in hashed.groupby("label") for r in part.nsmallest(100, "h").itertuples()}
    assert got == want and stratified_ids(rows.limit(0), 100).count() == 0

"""Collocations: hashes, chunks, tiles, and whole results against a plain count."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from qualstar.llm import collocation
from qualstar.llm.collocation import PhraseParams, Units, chunks, count_pairs, pair_hash, segments

OUT = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, p):
    """The contract in plain Python: counts of all phrases, cuts, drops, ranks."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, p.longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = defaultdict(list)
    candidates = {x: a for x, a in f.items() if a >= p.least and len(x[1]) > 1}
    covered = defaultdict(int)
    for (lang, w), a in candidates.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                covered[lang, w[i:i + m]] = max(covered[lang, w[i:i + m]], a)
    for (lang, w), a in candidates.items():
        score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
        if covered[lang, w] < a:
            out[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for lang, xs in out.items() for i, x in enumerate(sorted(xs)[:p.top]))


def found(df):
    assert df.columns == OUT
    return sorted(map(tuple, df.collect()))


def test_pair_hash_is_sparks(spark):
    rng = np.random.default_rng(3)
    a, b = (rng.integers(-(1 << 63), (1 << 63) - 1, 200) for _ in range(2))
    want = [r.h for r in spark.createDataFrame(list(zip(a.tolist(), b.tolist(), strict=True)), "a long, b long").selectExpr("xxhash64(a, b) h").collect()]
    assert pair_hash(a.view(np.uint64), b.view(np.uint64)).view(np.int64).tolist() == want


@pytest.mark.parametrize("side, dense", [(4, 16), (4, 10 ** 9), (4, 1), (64, 1)])
def test_tiles_count_like_a_dictionary(side, dense):
    rng = np.random.default_rng(4)
    pool = rng.integers(1, 1 << 62, 30, dtype=np.uint64)
    units = Units(np.full(1 << 12, 255, np.uint8), pool[:10])
    a, b = pool[(rng.pareto(1, 4000) * 2).astype(int) % 30], pool[(rng.pareto(1, 4000) * 2).astype(int) % 30]
    x, y, n = count_pairs(a, b, units, PhraseParams(side=side, dense=dense))
    assert Counter(zip(a.tolist(), b.tolist(), strict=True)) == {(i, j): c for i, j, c in zip(x.tolist(), y.tolist(), n.tolist(), strict=True)}
    assert [len(z) for z in count_pairs(a[:0], b[:0], units, PhraseParams())] == [0, 0, 0]


@pytest.mark.parametrize("size", [1, 7, 40, 10 ** 6])
def test_segments_own_every_word_once(size):
    data = "One two,three  four\tfive. six\nseven -- eight nine; ten éleven twelve".encode()
    words = [m.start() for m in re.finditer(rb"[^ \t.,;:!?\n\x0b\x0c\r]+", data)]
    got, at = [], 0
    for part, own in segments(data, size, 3):
        starts = [m.start() for m in re.finditer(rb"[^ \t.,;:!?\n\x0b\x0c\r]+", part)]
        assert part == data[at:at + len(part)]
        mine = [s for s in starts if s < own]
        got += [at + s for s in mine]
        assert at + own == len(data) or len(starts) - len(mine) == min(3, len(words) - len(got))
        at += own
    assert got == words and at == len(data)


def test_chunks_hold_bounded_text_of_many_languages():
    rows = [(f"l{i % 50}", "some words " * 9) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])
    got = list(chunks(iter([batch]), 1000, 2))
    assert sum(own for _, _, own in got) >= sum(len(t) for _, t in rows) and max(len(d) for _, d, _ in got) < 1200


def corpus(rng, rows):
    pool = [f"w{i}" for i in range(60)] + ["É", "ÀB", "x-y", "日本", "a1"]
    out = []
    for i in range(rows):
        words = [pool[int(k) % 65] for k in rng.pareto(0.8, int(rng.integers(0, 60))) * 3]
        text = "".join(w.upper() * 1 + str(rng.choice([" ", "  ", "\t", " ", " ", ". ", ",", "\n", " \r"])) for w in words)
        out.append((["en", "fr", None, "und"][i % 4], text + " alpha BETA gamma delta epsilon zeta" * (i % 5 == 0)))
    return out


@pytest.mark.parametrize("p", [PhraseParams(least=12), PhraseParams(least=5, hot=8, side=4, chunk_bytes=300, top=37), PhraseParams(least=9, hot=0, most_bits=15)])
def test_whole_result_against_brute_force(spark, p):
    rows = corpus(np.random.default_rng(6), 900)
    docs = spark.createDataFrame([(i, t, lang, "s", 1, "k") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, word string, c int, u string").repartition(5)
    want = brute(rows, p)
    assert len(want) > 50 and max(len(w[2].split()) for w in want) == 5
    assert found(collocation.collocations(docs, p)) == want


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string"
    assert found(collocation.collocations(spark.createDataFrame([], schema))) == []
    rows = [(None, None), ("", "a a a a"), ("en", ""), ("en", "..,"), (None, "b c"), ("fr", "one " * 70000 + "x" * 100000), ("fr", "one two three " * 40)]
    docs = spark.createDataFrame([(1, t, lang) for lang, t in rows] * 3, schema)
    p = PhraseParams(least=3, chunk_bytes=5000)
    assert found(collocation.collocations(docs, p)) == brute(rows * 3, p)


def test_products_beyond_64_bits(spark):
    row = [(10 ** 13, 4 * 10 ** 15, [3 * 10 ** 13, 2 * 10 ** 13, 10 ** 13], [10 ** 14, 5 * 10 ** 13, 10 ** 13])]
    cut = spark.createDataFrame(row, "c long, n long, firsts array<long>, lasts array<long>").select(collocation._weakest_cut(3).alias("x")).first().x
    scores = [1000 * 10 ** 13 * 4 * 10 ** 15 // (l * r) for l, r in ((3 * 10 ** 13, 5 * 10 ** 13), (2 * 10 ** 13, 10 ** 14))]
    assert (cut.score, cut.j) == min((s, j + 1) for j, s in enumerate(scores))

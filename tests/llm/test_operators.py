import collections
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import (common, decontaminate, hnsw, license_scan, ngram_join, packing, repeats, site_quality,
                        token_counts, toxicity, url_templates)
from strata.llm.queries import tokenizer_path
from strata.llm.shingles import U

RNG = random.Random(3)
WORDS = [f"w{i}" for i in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(WORDS) for _ in range(n))


ODD = [(None, "a b c d e"), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (6, "é\u00a0x  y ▁z <s>"),
       (7, "x" * 30_000), (8, prose(6000)), (9, prose(120)), (9, "another text")]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def edited(text, n, rng=RNG):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = rng.choice(WORDS)
    return " ".join(w)


def brute_components(rows, k, num, den):
    sets = collections.defaultdict(set)
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
        if i is not None:
            sets[i] |= {frozenset(s)}
    ids, up = sorted(sets), {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for x in ids:
        for y in ids:
            if x < y and any(a and b and den * len(a & b) >= num * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = root(x), root(y)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


@pytest.mark.parametrize("shard", [1_000_000, 600])
def test_ngram_join_equals_brute_force(docs, shard):
    base = [prose(n) for n in (5, 9, 30, 80, 80)]
    rows = [(i, t) for i, t in ODD if i not in (7, 8)]
    at = 100
    for b in base:
        for e in (0, 0, 1, 1, 2, 3, 4):
            rows.append((at, edited(b, e)))
            at += 1
    got = rows_of(ngram_join.components(docs(rows), 4, 85, 100, shard=shard).select("doc_id", "component_id"))
    assert len(got) == len(rows)
    want = brute_components(rows, 4, 85, 100)
    assert {(i, c) for i, c in got if i is not None} == set(want.items())
    assert [c for i, c in got if i is None] == [None]


def test_search_divides_and_skips_like_brute_force():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 60, 60).astype(U)
    sets = []
    for _ in range(40):
        keep = base[rng.random(60) < 0.97]
        sets.append(np.unique(np.concatenate([keep, rng.integers(0, 1 << 60, 3).astype(U)])))
    links = ngram_join.search(sets, 80, 100)
    forest, truth = ngram_join.Forest(len(sets)), ngram_join.Forest(len(sets))
    for a, b in links:
        assert forest.join(a, b)
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                truth.join(a, b)
    assert [forest.root(i) for i in range(40)] == [truth.root(i) for i in range(40)]


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 7, 12, 30, 200):
        for _ in range(40):
            a = np.unique(rng.integers(0, 1 << 60, n).astype(U))
            b = a[rng.random(len(a)) < 0.95]
            b = np.unique(np.concatenate([b, rng.integers(0, 1 << 60, rng.integers(0, 1 + n // 12)).astype(U)]))
            both = len(np.intersect1d(a, b))
            if len(b) and 100 * both >= 85 * (len(a) + len(b) - both):
                sig, at = ngram_join.signatures([a, b], 85, 100)
                assert set(sig[at == 0].tolist()) & set(sig[at == 1].tolist())


def test_sets_of_a_signature_share_a_shard_over_batches(spark):
    # signature s: 60 and 50 in one batch, 40 in another; signature t: 40 and 10
    edges = spark.createDataFrame([(60, 50, True), (50, 40, False), (40, 10, True)], "a long, b long, inner boolean")
    cells = collections.defaultdict(set)
    for fp, cell in rows_of(ngram_join.shards_of(edges)):
        cells[fp].add(cell)
    assert cells[60] & cells[50] & cells[40] and cells[40] & cells[10]


def test_ngram_join_of_many_small_batches(docs, monkeypatch):
    monkeypatch.setattr(ngram_join, "SLICE", 60)
    rng = random.Random(9)
    rows = [(10 * b + e, edited(text, e % 4, rng)) for b, text in enumerate(prose(50, rng) for _ in range(12)) for e in range(9)]
    rng.shuffle(rows)
    got = dict(rows_of(ngram_join.components(docs(rows), 3, 70, 100).select("doc_id", "component_id")))
    assert got == brute_components(rows, 3, 70, 100)


def test_rows_of_one_id_tie_their_texts(docs):
    t1, t2, t3 = (prose(40, random.Random(i)) for i in (21, 22, 23))
    rows = [(3, t1), (7, t1), (7, t2), (5, t2), (8, t3), (9, t3), (9, ""), (9, None)]
    got = set(rows_of(ngram_join.components(docs(rows)).select("doc_id", "component_id")))
    assert got == {(3, 3), (7, 3), (5, 3), (8, 8), (9, 8)}


def test_keep_one(docs):
    rows = [(3, prose(40)), (4, prose(40)), (None, "x"), (7, None), (8, None)]
    rows += [(9, rows[0][1]), (3, rows[0][1])]
    kept = ngram_join.keep_one(docs(rows))
    assert kept.columns == docs(rows).columns
    assert sorted((i if i is not None else -1) for i, *_ in rows_of(kept)) == [-1, 3, 4, 7, 8]


def test_compact_windows_equal_definition():
    rng = np.random.default_rng(4)
    h = rng.integers(0, 1 << 40, 300).astype(U) << U(20)
    first = np.array([0, 5, 120, 300])
    c, left, right = repeats.compact_windows(h, first, 20)
    want = set()
    for a, b in zip(first, first[1:]):
        for i in range(a, b):
            x, y = i, i
            while x > a and h[x - 1] > h[i]:
                x -= 1
            while y + 1 < b and h[y + 1] > h[i]:
                y += 1
            if y - x + 1 >= 20:
                want.add((i, x, y))
    assert set(zip(c.tolist(), left.tolist(), right.tolist())) == want


def test_repeats_find_passages_and_leave_the_rest(docs):
    passage, near = prose(60), prose(100)
    rows = [(20, f"{prose(30)} {passage} {prose(40)}"), (21, f"{prose(80)} {passage}"), (22, prose(150)),
            (23, f"{passage} {prose(200)}"), (24, near), (25, edited(near, 1)), (30, prose(70)), (31, None), (32, "")]
    rows += [(33, rows[6][1]), (None, passage)] + [r for r in ODD if r[0] in (4, 5, 6, 7)]
    got = collections.defaultdict(list)
    for i, a, b, src in rows_of(repeats.find_repeats(docs(rows)).select("doc_id", "begin", "end", "source_doc_id")):
        got[i].append((a, b, src))
    assert set(got) == {21, 23, 25, 33}
    assert got[21] == [(80, 140, 20)] and got[23] == [(0, 60, 20)] and got[33] == [(0, 70, 30)]
    cut = {r["doc_id"]: r for r in repeats.remove_repeats(docs(rows)).collect()}
    assert 33 not in cut and cut[20]["text"] == rows[0][1] and cut[21]["text"] == " ".join(rows[1][1].split()[:80]) + " "
    assert cut[22]["text"] == rows[2][1] and cut[31]["text"] is None


def test_repeats_behind_a_leader_that_shares_only_a_line(docs):
    rng = random.Random(12)
    rows = []
    for g in range(60):
        line = prose(45, rng)
        passage = f"{prose(3, rng)} {line} {prose(2, rng)}"
        rows += [(g, f"{prose(20, rng)} {line} {prose(20, rng)}"), (100 + g, f"{prose(20, rng)} {passage} {prose(20, rng)}"),
                 (200 + g, f"{prose(30, rng)} {passage} {prose(10, rng)}")]
    got = {(i, a, b, src) for i, a, b, src in rows_of(repeats.find_repeats(docs(rows)).select(
        "doc_id", "begin", "end", "source_doc_id"))}
    assert got == {(200 + g, 30, 80, 100 + g) for g in range(60)}


def test_pairs_of_a_batch_are_spread_over_the_groups(docs):
    rng = random.Random(6)
    texts = [prose(150, rng) for _ in range(40)]
    copies = docs([(i, edited(texts[i % 40], i % 3, rng)) for i in range(400)])
    for packed, column in ((repeats.packed_windows(copies, 46, 16), "p_b"),
                           (ngram_join.packed_signatures(copies, 4, 85, 100, 16), "a")):
        size = collections.Counter()
        for part, body in rows_of(packed.select("part", column)):
            size[part] += len(body)
        assert max(size.values()) < 0.3 * sum(size.values())


def test_license_scan_equals_brute_force(docs):
    rows = ODD + [(40, "Under the MIT license! under-the_mit license; Apache License, Version 2.0 cc by-nc"),
                  (41, "licensd under the apache licence version 2 0"), (42, "creative work")]
    got = {}
    for r in license_scan.scan_licenses(docs(rows)).collect():
        got.setdefault(r["doc_id"], r)
    for i, t in rows:
        if i in (None, 9):
            continue
        words = "".join(chr(b) for b in (t or "").encode().translate(license_scan.alnum_words.__globals__["ALNUM_WORDS"])).split(" ")
        words = [w for w in words if w]
        places = [(j, label) for p, label in license_scan.BASE.items() for j in range(len(words))
                  if words[j:j + len(p.split())] == p.split()]
        assert (got[i]["n_words"], got[i]["n_base"]) == (len(words), len(places))
        assert got[i]["first_word"] == min((j for j, _ in places), default=None)
        assert got[i]["last_word"] == max((j for j, _ in places), default=None)
        assert got[i]["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert set(got[i]["base_labels"].split(",")) - {""} <= set(got[i]["labels"].split(","))
    assert got[41]["labels"] == "apache-2" and 0 < got[41]["score"] < 1 and got[42]["labels"] == ""


def test_an_edited_notice_before_an_exact_one_is_found(docs):
    text = "x gnu generel public license gnu general public license gnu general publik license y"
    row, = license_scan.scan_licenses(docs([(1, text)])).collect()
    assert [(s["begin"], s["end"], s["edits"]) for s in row["spans"] if s["label"] == "gpl"] == [(1, 5, 1), (5, 9, 0), (9, 13, 1)]


def test_decontamination(spark, docs):
    item = prose(40)
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "q"), (4, prose(30))],
                                  "item_id long, text string")
    rows = ODD + [(50, f"{prose(100)} {item} {prose(30)}"), (51, edited(item, 4)), (52, prose(300))]
    found = {(r[0], r[1]) for r in rows_of(decontaminate.find_leaks(docs(rows), bench))}
    assert found == {(50, 1), (51, 1)}
    kept = decontaminate.drop_contaminated(docs(rows), bench)
    assert sorted(map(str, (r[0] for r in rows_of(kept)))) == sorted(str(i) for i, _ in rows if i not in (50, 51))
    assert decontaminate.find_leaks(docs(rows), bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs([]), bench).count() == 0


def test_a_leak_copied_often_is_found(spark, docs):
    rng = random.Random(11)
    item = prose(40, rng)
    bench = spark.createDataFrame([(1, item), (2, "w1")], "item_id long, text string")
    rows = [(i, f"{prose(i % 50, rng)} {item}") for i in range(150)] + [(200 + i, edited(item, 8, rng)) for i in range(50)]
    rows += [(300 + i, " ".join(f"v{rng.randrange(400)}" for _ in range(90))) for i in range(100)] + [(500, "w1")]
    found = {(r[0], r[1]) for r in rows_of(decontaminate.find_leaks(docs(rows), bench))}
    assert {i for i, item_ in found if item_ == 1} == {i for i, _ in rows if i < 300}
    assert {i for i, item_ in found if item_ == 2} == {i for i, t in rows if "w1" in t.split()}


def test_lcs():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            prev = 0
            for j, y in enumerate(b):
                prev, row[j + 1] = row[j + 1], max(prev + 1 if x == y else row[j + 1], row[j])
        return row[-1]
    for _ in range(50):
        a = [RNG.randrange(6) for _ in range(RNG.randrange(1, 20))]
        b = [RNG.randrange(6) for _ in range(RNG.randrange(0, 30))]
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert decontaminate.lcs(masks, len(a), b) == slow(a, b)


def test_toxicity_on_held_out_rows(spark, docs):
    rows, labels = [], []
    for i in range(1500):
        bad = i % 3 == 0
        rows.append((i, prose(40) + (" idiot scum" if bad else "")))
        labels.append((i, 1, int(bad)))
    rows += [(i, t) for i, t in ODD if i is None] + [(5000, None), (5001, "")]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.classify(docs(rows), marks).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in out)
    held = [r for r in out if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in held)
    assert np.mean([r["predicted"] == (r["doc_id"] % 3 == 0) for r in held if r["doc_id"] < 1500]) > 0.97
    clean = toxicity.reject_toxic(docs(rows), marks)
    assert clean.columns == docs(rows).columns and 950 < clean.count() < 1060
    none = toxicity.classify(docs(ODD), marks.limit(0)).collect()
    assert len(none) == len(ODD) and not any(r["predicted"] for r in none)


def test_site_quality(spark, docs):
    from pyspark.sql import functions as F

    rows = [(i, prose(60) if i % 4 else "bad " * 60) for i in range(400)] + ODD
    marks = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    out = site_quality.score_quality(docs(rows), marks, F.lit("h"), F.lit(None)).collect()
    assert len(out) == len(rows)
    held = [r for r in out if r["held_out"] and r["doc_id"] >= 10]
    assert np.mean([r["predicted"] == (r["doc_id"] % 4 > 0) for r in held]) > 0.95
    assert site_quality.score_quality(docs(ODD), marks.limit(0), F.lit("h"), F.lit("p")).count() == len(ODD)


def test_language_thresholds_are_pooled_at_every_size():
    k = len(toxicity.LANGUAGES)

    def cuts(n, pooling=20.0):
        # language 0 is toxic from 0.8 on, language 1 from 0.3 on
        s = np.tile(np.linspace(0.01, 0.99, 50), n)
        s, lang = np.concatenate([s, s]), np.repeat([0, 1], 50 * n)
        y = (s >= np.where(lang == 0, 0.8, 0.3)).astype(float)
        return toxicity.language_thresholds(s, y, np.ones(len(s)), lang, pooling)

    few, many, own = cuts(1), cuts(40), cuts(1, pooling=1e-9)
    assert few[2] <= few[0] <= 0.82 and abs(many[0] - 0.8) < 0.02 and abs(many[1] - 0.3) < 0.02
    assert abs(own[0] - 0.8) < 0.02 and abs(own[1] - 0.3) < 0.02
    assert len(few) == k and len(set(few[2:])) == 1         # without own rows: the common one
    assert toxicity.language_thresholds(np.ones(3), np.ones(3), np.ones(3), np.zeros(3), 20.0) == (0.5,) * k


def test_url_templates(spark):
    pages = spark.createDataFrame([
        (1, "http://a.net/x"), (2, "https://www.Example.net/en/5?q"), (3, "http://b.example.com/de/7#t"),
        (4, "http://example.org/fr/"), (5, None), (6, "no scheme"), (7, "http://knet/y"), (8, "x://h"), (8, "x://h"),
        (9, "http://a.net"), (10, "p\nq://Host.É/ü/1?://z")], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in
           url_templates.judge_urls(pages, labels).orderBy("page_id").collect()]
    assert got == [(1, "a.net", "/x", "net/", "block"), (2, "www.example.net", "/en/5", "example.net/en/", "allow"),
                   (3, "b.example.com", "/de/7", "example.com/de/", "block"), (4, "example.org", "/fr/", "org/fr/", "allow"),
                   (5, "", "", None, "allow"), (6, "", "", None, "allow"), (7, "knet", "/y", None, "allow"),
                   (8, "h", "", None, "allow"), (8, "h", "", None, "allow"), (9, "a.net", "", None, "allow"),
                   (10, "host.É", "/ü/1", None, "allow")]
    assert url_templates.judge_urls(pages.limit(0), labels).count() == 0


def _url_rows(spark, pages, marks):
    p = spark.createDataFrame(pages, "page_id long, url string, host string, template string, n int")
    m = spark.createDataFrame(marks, "doc_id long, quality int, host string")
    return p, m, url_templates.judge_urls(p, m)


def test_url_templates_see_every_level(spark):
    pages = [(i, f"http://h/a/b/c/d/{'good' if i % 2 else 'bad'}/{i}", "x", "y", 1) for i in range(400)]
    pages += [(900, "http://j/" + "s/" * 3000, None, None, None), (901, "http://k/p//q/", None, None, None)]
    *_, out = _url_rows(spark, pages, [(i, i % 2, "z") for i in range(400)])
    got = {r["page_id"]: r for r in out.collect()}
    assert {i for i, r in got.items() if r["verdict"] == "block"} == set(range(0, 400, 2))
    assert got[1]["template"] == "/a/b/c/d/good/#" and got[900]["template"].endswith("/s/s/") and got[901]["template"] == "/p//q/"


def test_url_templates_equal_their_sql(spark):
    import duckdb

    rng = random.Random(5)
    parts = ["news", "shop", "u", "v", "", "x#y"]
    pages = [(i, "http://" + rng.choice(["a.b", "c.d"]) + "".join("/" + rng.choice(parts + [f"id{i}", "w" + "abcdefghij"[i % 10] * (i % 3)])
                                                                  for _ in range(rng.randrange(8))) + f"?{i}", "x", "y", 1)
             for i in range(1500)]
    pages = [(i, u.replace("/u", f"/u{i % 300}"), *r) for i, u, *r in pages] + [(7, None, None, None, None)] * 2
    marks = [(i, rng.randrange(2) if i % 3 else None, "z") for i in range(300)] + [(5, 0, "z"), (None, 1, "z")]
    p, m, out = _url_rows(spark, pages, marks)
    names = ["page_id", "host", "path", "rule", "verdict", "template", "purity"]
    got = sorted((tuple(r) for r in out.select(*names).collect()), key=repr)
    db = duckdb.connect()
    db.register("pages", p.toPandas())
    db.register("labels", m.toPandas().astype({"doc_id": "Int64", "quality": "Int64"}))
    want = sorted(db.sql("select " + ", ".join(names) + " from (" + url_templates.oracle_sql() + ")").fetchall(), key=repr)
    assert {r[5] for r in got} != {r[2] for r in got} and any("*" in r[5] for r in got)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert np.allclose([r[6] for r in got], [r[6] for r in want])


def test_license_places_of_a_long_text_are_quick(docs):
    import time

    n = 200_000
    begin = time.monotonic()
    row, = license_scan.scan_licenses(docs([(1, "cc by nc x " * n)])).collect()
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (4 * n, n, 0, 4 * (n - 1))
    assert time.monotonic() - begin < 60


def test_token_counts_equal_the_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    rows = ODD + [(60, " a  b   c "), (61, "  "), (62, "\r\n\t x"), (63, "日本語 テキスト ok")]
    for hot in (1 << 19, 0):
        got = collections.Counter(rows_of(token_counts.count_tokens(docs(rows), tokenizer_path("piece_bpe_32k.model"),
                                                                    limit=20, hot_units=hot)))
        want = collections.Counter((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 20) for i, t in rows)
        assert got == want


def test_rows_of_one_id_are_counted_apart(docs):
    """Null ids and texts whose CRC-32 is equal."""
    a, b = crc_twins()
    assert a != b and zlib.crc32(a.encode()) == zlib.crc32(b.encode())
    rows = [(None, a), (None, b), (None, a), (4, a), (4, b)]
    got = sorted(r[1] for r in rows_of(token_counts.count_tokens(docs(rows), tokenizer_path("piece_bpe_32k.model"))))
    assert got == sorted(len(t.encode()) for _, t in rows)


def crc_twins():
    """Two texts of different length and equal CRC-32, found by birthday."""
    seen = {}
    for i in range(1, 1 << 19):
        text = f"text {i * 2654435761 % (1 << 32):x}" + " more" * (i % 3)
        other = seen.setdefault(zlib.crc32(text.encode()), text)
        if other != text and len(other) != len(text):
            return other, text
    raise AssertionError


def test_one_class_of_labels_gives_one_verdict(spark, docs):
    rows = [(i, prose(20)) for i in range(30)]
    for y in (0, 1):
        marks = spark.createDataFrame([(i, y) for i in range(30)], "doc_id long, quality int")
        for r in site_quality.score_quality(docs(rows), marks, F.lit("h"), F.lit("p")).collect():
            assert (r["score"] >= 0.5, r["predicted"], r["keep"]) == (bool(y), y, bool(y))


def test_equal_rows_are_one_member(docs, monkeypatch):
    text = prose(60, random.Random(31))
    near = edited(text, 1, random.Random(32))
    real, most = ngram_join._links_of_shards, []

    def counted(num, den):
        run = real(num, den)

        def rows(batches):
            batches = list(batches)
            assert sum(b.num_rows for b in batches) < 20
            return run(iter(batches))
        return rows

    monkeypatch.setattr(ngram_join, "_links_of_shards", counted)
    got = rows_of(ngram_join.components(docs([(5, text)] * 400 + [(9, near)] + [(None, text)] * 5), 4, 80, 100))
    assert collections.Counter((i, c) for i, _, c in got) == {(5, 5): 400, (9, 5): 1, (None, None): 5}


def test_open_windows_are_placed_by_the_rule_and_lose_nothing():
    rng = random.Random(6)
    for _ in range(40):
        levels, fed, out = packing._Levels(64), {}, []
        for doc in range(rng.randrange(0, 120)):
            r = rng.randrange(1, 64)
            fed[doc] = np.arange(r, dtype="<u4").tobytes()
            done = levels.place((doc, 0, fed[doc], r), r)
            out += [done] if done else []
        out += levels.close()
        sizes = [sum(len(p[2]) // 4 for p in w) for w in out]
        short = [n for n in sizes if n != 64]
        assert all(n & (n - 1) == 0 for n in sizes) and len(short) == len(set(short)) and not levels.open
        back = collections.defaultdict(list)
        for w in out:
            for doc, start, ids, total in w:
                back[doc].append((start, ids))
                assert total == len(fed[doc]) // 4
        assert {d: b"".join(i for _, i in sorted(p)) for d, p in back.items()} == fed
        for p in back.values():
            at = 0
            for start, ids in sorted(p):
                assert start == at
                at += len(ids) // 4


def test_whole_texts_get_the_librarys_ids():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    pieces = packing._Pieces(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken"))
    rng = random.Random(8)
    signs = ["  ", " ", "\n", "\n\n", "\r\n", "\t", "\x0b", "\xa0", "\xad", "it's", "WE'LL", "123456", "½²", "ſ", "Ǆ", "é", "ß", "...",
             "!?", "<|endoftext|", "a", "Word", "_x", "ª", "×", "=+", "\x00", "\x1c", "\x85", "—", "日本", "e\u0301"]
    plain = 0
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1, 14)))
        plain += pieces.ranked(text) is not None
        assert pieces.encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)
    assert plain > 500


def test_packing_round_trip(docs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    rows = [r for r in ODD if r[0] not in (None, 5, 9)] + [(70, "a  b \n c<|endoftext|> d"), (71, "日本 it's 12345  ")]
    rows += [(100 + i, prose(RNG.randrange(1, 900))) for i in range(60)]
    out = packing.pack(docs(rows), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")).collect()
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append((r["start"], bytes(r["ids"])))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"]
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        assert b"".join(b for _, b in sorted(pieces[i])) == np.array(ids, "<u4").tobytes()
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024 and (at == 1024 or at & (at - 1) == 0)


def test_neighbours_recall_and_odd_rows(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 16)).astype(np.float32)
    x[:60] = x[0]                                    # a hot vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] * 16), (None, [1.0] * 16), (1, rows[1][1])]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = collections.defaultdict(list)
    for q, rank, v, s in sorted(rows_of(hnsw.nearest(df, df.where("vec_id % 20 = 0"), k=10, shard_size=500))):
        assert rank == len(got[q]) + 1
        got[q].append((v, s))
    d, hit = x.astype(np.float64), 0
    for q in range(0, 1200, 20):
        s = d @ d[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(1200), -s))[:10]
        hit += len(set(best.tolist()) & {v for v, _ in got[q]})
        assert all(abs(s[v] - score) < 1e-9 for v, score in got[q])
    assert len(got) == 60 and hit / 600 >= 0.9
    assert hnsw.nearest(df.limit(0)).count() == 0
    assert hnsw.nearest(df.where("vec_id in (70, 71)"), k=10).count() == 2


def test_toxicity_learns_from_every_labelled_text(spark, docs):
    # all texts are long: a model of short texts sees none of them
    rows = [(i, prose(40) + (" idiot scum " if i % 3 == 0 else " ") + "calm words here " * 4200) for i in range(700)]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(700)], "doc_id long, quality int, toxic int")
    probe = [(10_000 + i, prose(40) + (" idiot scum" if i % 2 else "")) for i in range(60)]
    out = toxicity.classify(docs(rows + probe), marks).where("doc_id >= 10000").collect()
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in out]) > 0.9
    known = marks.selectExpr("doc_id", "toxic __toxic")
    got = toxicity.labelled(docs(rows), known, 3)
    assert got.count() == sum(zlib.crc32(str(i).encode()) % 5 > 0 for i, _ in rows)


def test_toxicity_moves_of_the_parts_are_averaged(spark, docs):
    rows = [(i, prose(30) + (" idiot scum" if i % 3 == 0 else "")) for i in range(1200)]
    marks = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(1200)], "doc_id long, quality int, toxic int")
    one, again = (toxicity.fit(docs(rows), marks, rows_per_part=300) for _ in range(2))
    assert (one.embed == again.embed).all() and one.thresholds == again.thresholds
    held = [r for r in toxicity.score(docs(rows), one).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 3 == 0) for r in held]) > 0.95


def test_chains_over_split_shards_equal_brute_force_and_no_sets_are_kept(docs, monkeypatch):
    rng, rows = random.Random(41), []
    for b in range(3):                      # each text is the one before it, edited: the ends are far from any pivot
        text = prose(60, rng)
        for e in range(40):
            rows.append((1000 * b + e * 7 % 40, text))
            text = edited(text, 1, rng)
    rows += [(5, rows[3][1])] * 2 + [(1005, rows[20][1]), (5000, None), (None, rows[3][1])]
    real, kept = ngram_join.checkpointed, []
    monkeypatch.setattr(ngram_join, "checkpointed", lambda df: (kept.extend(df.columns), real(df))[1])
    got = rows_of(ngram_join.components(docs(rows), 4, 80, 100, shard=400).select("doc_id", "component_id"))
    assert len(got) == len(rows)
    assert {(i, c) for i, c in got if i is not None} == set(brute_components(rows, 4, 80, 100).items())
    assert not {"shingles", "text"} & set(kept)


def test_shuffle_files_go_with_their_checkpoint(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def moved():
        return {x for x in blocks.getAllBlocks().mkString(",").split(",") if x.startswith("shuffle_")}
    before, setting = moved(), spark.conf.get(common.RELEASE, None)
    df = spark.range(1000).repartition(3, "id")
    out = common.checkpointed_alone(df)
    for _ in range(50):
        if not moved() - before:
            break
        time.sleep(0.1)
    assert not moved() - before and spark.conf.get(common.RELEASE, None) == setting
    assert out.count() == df.count() == 1000


def test_rounds_of_components_do_not_grow_the_plan(spark):
    rng = random.Random(43)
    nodes = rng.sample(range(10_000), 300)
    found = common.connected_components(spark.createDataFrame(list(zip(nodes, nodes[1:])), "a long, b long"))
    assert len(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 200
    rows = dict(rows_of(found))
    assert set(rows) == set(nodes) and len(set(rows.values())) == 1

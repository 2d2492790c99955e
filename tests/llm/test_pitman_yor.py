import collections
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import pitman_yor as py

SCHEMA = "doc_id long, text string, words string, shard int, n long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], SCHEMA)


def held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1


def corpus(n, rng):
    """Two tongues with words of their own: the word before tells which."""
    out = []
    for i in range(n):
        end = rng.choice(["xa", "zo"])
        words = [f"{'bcdfgh'[min(int(rng.expovariate(.7)), 5)]}{rng.randrange(1, 9)}{end}" for _ in range(rng.randint(1, 60))]
        if rng.random() < .3:
            words.append(f"new{i}")
        out.append((i, " ".join(words)))
    return out


ODD = [(None, "a b c"), (None, "a b d"), (900, None), (901, ""), (902, " \t\n"), (903, "One"), (904, "x" * 50_000),
       (905, "a " * 5000), (906, "é x <s> \x00 B"), (903, "One"), (903, "two")]


def scored(spark, rows, **more):
    df = frame(spark, rows)
    out = py.remainder(F.col("doc_id"), 5) == 1
    model = py.train(df, ~out, shard_bytes=2000)
    return model, py.score(df, out, model, **more)


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.encode() for w in "".join(" " if c in " \t\n\r\x0b\x0c" else c for c in low).split(" ") if w] + [None]


def context(words, i):
    if i == 0:
        return 0
    w = words[i - 1]
    return w[-2] << 8 | w[-1] if len(w) > 1 else w[-1]


@pytest.fixture(scope="module")
def run(spark):
    rows = corpus(120, random.Random(3)) + ODD
    model, got = scored(spark, rows, hot_bytes=3000)
    return rows, model, got.collect()


def test_counts_and_base_scores_equal_brute_force(run):
    rows, model, got = run
    c = collections.Counter(w for i, t in rows if not held(i) for w in words_of(t))
    n, v = sum(c.values()), len(c)
    want = [(i, held(i), len(words_of(t)), sum(c[w] > 0 for w in words_of(t)), n,
             sum(math.log10((c[w] + .5) / (n + .5 * (v + 1))) for w in words_of(t))) for i, t in rows]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 6))
    assert len(got) == len(rows)
    for a, b in zip(sorted((tuple(r)[:6] for r in got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-9)


def seats_of(model):
    """Per sample: customers and tables of (level, restaurant, word), read from the packed rows."""
    out = [collections.defaultdict(lambda: [0, 0]) for _ in range(py.SAMPLES)]
    for row in model.words.collect():
        part = py.Words([row.asDict()])
        w2, w1 = np.repeat(np.arange(len(part.n)), part.pairs), np.repeat(np.arange(len(part.n)), part.pairs1)
        for s in range(py.SAMPLES):
            for level, w, u, c, t in ((2, w2, part.u, part.c, part.t2[s]), (1, w1, part.u1, part.c1[s], part.t1[s]),
                                      (0, np.arange(len(part.n)), np.zeros(len(part.n), int), part.c0[s], part.t0[s])):
                for a, b, x, y in zip(w, u, c, t):
                    if x:
                        out[s][level, int(b), part.words[a] or None] = [int(x), int(y)]
    return out


def test_tables_are_the_parents_customers(run):
    _, model, _ = run
    for seats, total in zip(seats_of(model), model.samples):
        for up, reduce in ((1, lambda u: u & 255), (0, lambda u: 0)):
            sums = collections.Counter()
            for (level, u, w), (c, t) in seats.items():
                assert 1 <= t <= c
                if level == up + 1:
                    sums[up, reduce(u), w] += t
            assert sums == {k: c for k, (c, _) in seats.items() if k[0] == up}
        for level in range(3):
            for what in (0, 1):
                sums = collections.Counter()
                for (at, u, _), v in seats.items():
                    if at == level:
                        sums[u] += v[what]
                array = (total.customers, total.tables)[what][level]
                assert dict(sums) == {int(u): int(array[u]) for u in np.flatnonzero(array)}


def predictive(seats, total, word, u, level=2):
    if level < 0:
        return total.base
    at = (0, u & 255, u)[level]
    c, t = seats.get((level, at, word), (0, 0))
    d, n, m = total.discount[level], int(total.customers[level][at]), int(total.tables[level][at])
    return (c - d * t + (py.THETA + d * m) * predictive(seats, total, word, u, level - 1)) / (py.THETA + n)


def test_scores_follow_from_the_seats(run):
    rows, model, got = run
    seats = seats_of(model)
    want = collections.defaultdict(list)
    for i, t in rows:
        words = words_of(t)
        want[i].append(sum(math.log10(sum(predictive(s, total, w, context(words, k)) for s, total in zip(seats, model.samples))
                                      / py.SAMPLES) for k, w in enumerate(words)))
    for r in got:
        assert min(abs(r["score"] - x) for x in want[r["doc_id"]]) < 1e-6
        assert r["perplexity"] == pytest.approx(10 ** (-r["score"] / r["n_tokens"]))


def test_probabilities_sum_to_one(run):
    _, model, _ = run
    words = py.Words([r.asDict() for r in model.words.collect()]).ready()
    known = np.flatnonzero(words.n > 0)
    for u in (0, ord("x") << 8 | ord("a"), ord("q"), 65535):
        p = words.probability(np.r_[known, -1], np.full(len(known) + 1, u), model.samples)
        assert p.sum() == pytest.approx(1.0, abs=1e-9) and (p > 0).all()


def test_hot_words_do_not_change_scores(spark):
    rows = corpus(60, random.Random(5))
    df = frame(spark, rows)
    model = py.train(df, F.lit(True), shard_bytes=1500)
    few, all_hot = (sorted(tuple(r) for r in py.score(df, F.lit(False), model, hot_bytes=b).collect()) for b in (0, 1 << 30))
    assert [r[:5] for r in few] == [r[:5] for r in all_hot]
    for a, b in zip(few, all_hot):
        assert a[5:] == pytest.approx(b[5:], abs=1e-7)


def test_held_out_text_is_likelier_than_under_the_base(spark):
    _, got = scored(spark, corpus(400, random.Random(6)))
    sums = got.where("held_out").agg(F.sum("base_score"), F.sum("score")).first()
    assert sums[1] > sums[0] * 0.9


def test_packs_merge_in_a_tree(spark, monkeypatch):
    rows = corpus(50, random.Random(7))
    df = frame(spark, rows).repartition(9)
    monkeypatch.setattr(py, "FAN", 2)
    monkeypatch.setattr(py, "COUNT_BYTES", 300)
    seen = collections.Counter()
    for row in py.counts(df, F.lit(True), 3, 9).collect():
        words = py._text(row["words"]).split(b" ")
        assert len({zlib.crc32(w) % 3 for w in words}) == 1
        pairs, u, c = py._unpacked(row.asDict())
        for w, i, n in zip(np.repeat(np.arange(len(pairs)), pairs), u, c):
            seen[words[w] or None, int(i)] += int(n)
    want = collections.Counter()
    for _, t in rows:
        words = words_of(t)
        want.update((w, context(words, k)) for k, w in enumerate(words))
    assert seen == want


def test_packs_hold_few_words(monkeypatch):
    monkeypatch.setattr(py, "PACK_WORDS", 10)
    words = [b"w%d" % i for i in range(95)]
    keys = np.sort(np.r_[np.arange(0, 95, 2) << 16 | 7, np.arange(95) << 16 | 9])
    rows = py._count_rows(words, np.arange(95), keys, keys % 11 + 1, 3, 0).to_pylist()
    seen = {}
    for row in rows:
        own = py._text(row["words"]).split(b" ")
        assert len(own) <= 10 and {zlib.crc32(w) % 3 for w in own} == {row["shard"]}
        pairs, u, c = py._unpacked(row)
        assert [words[i] for i in py._numbers(row["docs"], "<u8")] == own
        seen.update({words.index(own[w]) << 16 | int(i): int(n) for w, i, n in zip(np.repeat(np.arange(len(own)), pairs), u, c)})
    assert seen == {int(k): int(k) % 11 + 1 for k in keys}


def test_no_rows_and_no_training_rows(spark):
    assert scored(spark, [])[1].collect() == []
    only = next(i for i in range(50) if held(i))
    got = scored(spark, [(only, "a b")])[1].collect()
    assert [tuple(r) for r in got] == [(only, True, 3, 0, 0, 0.0, 0.0, 1.0)]


def test_gibbs_sweeps_follow_the_exact_law_of_tables():
    """One word of c customers in its own restaurant: P(t) over the strength, the base and Stirling numbers."""
    d, p, c, many = 0.6, 0.4, 7, 20_000
    s = {(0, 0): 1.0}
    for n in range(c):
        for t in range(n + 2):
            s[n + 1, t] = s.get((n, t - 1), 0) + (n - t * d) * s.get((n, t), 0)
    weight = [s[c, t] * p ** t * math.prod(py.THETA + d * k for k in range(1, t)) for t in range(1, c + 1)]
    want = sum(t * w for t, w in enumerate(weight, 1)) / sum(weight)
    pairs = np.arange(many)
    for start in (1, c):
        level = py.Level(np.full(many, c), pairs, pairs, np.full(many, start), d, np.random.default_rng(start))
        for _ in range(250):
            level.remove(pairs)
            level.add(pairs, (py.THETA + d * level.t) * p)
        assert np.bincount(np.repeat(pairs, level.room), level.size).tolist() == [c] * many
        assert level.t.mean() == pytest.approx(want, abs=0.05)


def log_stirling(c, d):
    """log S(c, t) for t = 0 .. c."""
    row = np.array([-np.inf, 0.0])
    with np.errstate(divide="ignore"):
        for n in range(1, c):
            stay = np.log(np.maximum(n - d * np.arange(n + 1), 0))
            row = np.logaddexp(np.r_[row + stay, -np.inf], np.r_[-np.inf, row])
    return row


def law_of_tables(c, d, weights):
    """P(t), t = 0 .. c, where the t-th table has ``weights[t]``."""
    log_p = log_stirling(c, d) + np.r_[0.0, 0.0, np.cumsum(np.log(weights[2:c + 1]))]
    p = np.exp(log_p - log_p.max())
    return p / p.sum()


@pytest.mark.parametrize("c, others, base", [(2, 0, .5), (7, 30, .02), (60, 400, .05), (300, 5, .9), (500, 3000, .01), (900, 2000, .1)])
def test_first_tables_follow_the_exact_law(c, others, base):
    d, many = 0.6, 20_000
    p = law_of_tables(c, d, (py.THETA + d * (others + np.arange(c + 1) - 1)) * base)
    t = py._first_tables(np.full(many, c), np.full(many, others), np.full(many, base), d, np.random.default_rng(c))
    got = np.bincount(t, minlength=c + 1) / many
    assert np.abs(np.cumsum(got) - np.cumsum(p)).max() < 1.95 / many ** .5        # Kolmogorov, one in a thousand


def test_law_of_many_customers_equals_the_recurrence():
    for d, most in ((.1, 5e-3), (.3, 2e-3), (.5, 1e-3), (.7, 1e-3), (.9, 1e-3)):
        law = py.law(d)
        for c, row in py._tables_below(d, 1, np.zeros(2), 3000):
            if c in (5, 512, 513, 777, 1500, 3000):
                got, few = law.below(np.full(c, c), np.arange(1, c + 1)), c * 19 // 20
                assert got[1:few] == pytest.approx(row[2:few + 1], rel=most)
                assert got[few:] == pytest.approx(row[few + 1:], rel=5e-3)
        s = log_stirling(9, d)
        assert law.below(np.full(8, 9), np.arange(2, 10)) == pytest.approx(np.exp(s[1:-1] - s[2:]))


def one_word(c, others):
    """A word in two contexts of one parent; ``others``: tables and customers of the other words, at each level."""
    u = np.array([1 << 8 | 7, 2 << 8 | 7])
    totals = py.Totals(50, 3, (.5, .6, .7), [np.zeros(n, np.int64) for n in (1, py.C1, py.C2)],
                       [np.ones(n, np.int64) for n in (1, py.C1, py.C2)])
    seating = py.Seating(np.array([2]), u, np.array(c), totals, 3)
    for level, (t, n) in enumerate(others):
        own = seating.levels[level]
        totals.tables[level][:] = t
        totals.customers[level][:] = n
        totals.tables[level][own.u] += own.t
        np.add.at(totals.customers[level], own.u, own.c)
    return seating, totals


def test_sweeps_follow_the_exact_law_of_a_hierarchy():
    c, others = (4, 3), ((2, 4), (3, 5), (6, 9))
    seating, totals = one_word(c, others)
    d = totals.discount

    def rising(start, step, n):
        return math.prod(start + step * k for k in range(n))

    def s(n, t, level):
        row = {(0, 0): 1.0}
        for i in range(n):
            for k in range(i + 2):
                row[i + 1, k] = row.get((i, k - 1), 0) + (i - k * d[level]) * row.get((i, k), 0)
        return row.get((n, t), 0)

    want, mass = np.zeros(4), 0.0
    for a in range(1, c[0] + 1):
        for b in range(1, c[1] + 1):
            for t1 in range(1, a + b + 1):
                for t0 in range(1, t1 + 1):
                    p = (s(c[0], a, 2) * s(c[1], b, 2) * s(a + b, t1, 1) * s(t1, t0, 0) * seating.base ** t0
                         * rising(py.THETA + d[2] * 6, d[2], a) * rising(py.THETA + d[2] * 6, d[2], b)
                         * rising(py.THETA + d[1] * 3, d[1], t1) * rising(py.THETA + d[0] * 2, d[0], t0)
                         / rising(py.THETA + 5, 1, a + b) / rising(py.THETA + 4, 1, t1))
                    want += p * np.array([a, b, t1, t0])
                    mass += p
    got, many = np.zeros(4), 6000
    for _ in range(many):
        seating.sweep(totals)
        low, mid, top = seating.levels[2].t, seating.levels[1], seating.levels[0]
        assert mid.c.tolist() == [low.sum()] and top.c.tolist() == mid.t.tolist() == [totals.customers[0][0] - 4]
        assert totals.tables[1][7] == 3 + mid.t[0] and totals.customers[1][7] == 5 + mid.c[0]
        got += [*low, mid.t[0], top.t[0]]
    assert got / many == pytest.approx(want / mass, abs=0.07)


def test_a_sweep_seats_every_customer_anew():
    """After one sweep nothing is left of where a pair's customers sat."""
    means = []
    for start in (1, 200):
        tables = []
        for _ in range(150):
            seating, totals = one_word((200, 3), ((200, 400), (300, 500), (400, 900)))
            seating.levels[2].rng = np.random.default_rng(len(tables))
            seating._set(1, np.array([0]), np.array([1]), totals)
            seating._set(2, np.array([0]), np.array([start]), totals)
            seating.sweep(totals)
            tables.append(seating.levels[2].t[0])
        means.append(np.mean(tables))
    assert means[0] == pytest.approx(means[1], abs=3) and 5 < means[0] < 150

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from strata.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, pos long, g int"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc, text, lang, source, n = row

    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(*map(one, (doc, source, lang, n, text)))


def fold_tree(nodes, fanout):
    """The root and per node its list of (left, right) siblings, level by level."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(paths)):
            a = where[i] // fanout * fanout
            paths[i].append(("".join(nodes[a:where[i]]), "".join(nodes[where[i] + 1:a + fanout])))
            where[i] //= fanout
        nodes = [H(*nodes[a:a + fanout]) for a in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    subs = []
    for g in names:
        own = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subs.append((own, *fold_tree([leaf_of(r) for r in own], fanout)))
    root, over = fold_tree([s[1] for s in subs], fanout)
    out = []
    for (own, sub, paths), up in zip(subs, over):
        for r, path in zip(own, paths):
            out.append((r[0], leaf_of(r), sub, root, tuple(path + up)))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 7, 7) for r in rows], SCHEMA)


def proved(spark, rows, **more):
    got = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", **more).collect()
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s["l"], s["r"]) for s in r["path"]))
                   for r in got), key=repr)


def sample(n, rng, langs=("en", "de", None, "ñ", "")):
    return [(i, rng.choice(["", "a b", "é ", None, "long " * 500]), rng.choice(langs), rng.choice([None, "s:1"]),
             rng.choice([None, 5, -3])) for i in range(n)]


@pytest.mark.parametrize("fanout,digits", [(2, 2), (2, 10), (3, 2)])
def test_manifest_equals_brute_force(spark, fanout, digits):
    rng = random.Random(5)
    rows = sample(61, rng) + [(700, "x", "one", "s", 1)]
    rows += [rows[3], rows[3], (4, "other text", rows[4][2], "s", 2), (None, "n", "en", "s", 1), (None, "n", "en", "s", 1)]
    rng.shuffle(rows)
    assert proved(spark, rows, fanout=fanout, digits=digits) == brute(rows, fanout)


def test_one_row_is_its_own_root_and_no_row_gives_none(spark):
    row = (5, "text", None, "s", 4)
    assert proved(spark, [row]) == [(5, leaf_of(row), leaf_of(row), leaf_of(row), ())]
    assert proved(spark, []) == []


def test_a_group_of_most_rows_is_ranked_over_parts(spark):
    rows = [(i, f"t{i}", "en" if i % 9 else "de", "s", 1) for i in range(400)]
    df = frame(spark, rows).repartition(7)
    at = merkle.ranked(df.select(F.struct("lang").alias("g"), "doc_id"), ["doc_id"]).collect()
    for lang in ("en", "de"):
        own = sorted((r["doc_id"], r["pos"], r["n"]) for r in at if r["g"]["lang"] == lang)
        assert [p for _, p, _ in own] == list(range(len(own))) and {n for *_, n in own} == {len(own)}


def test_proofs_verify_and_tampered_rows_do_not(spark):
    rows = [(i, f"text {i}", "en" if i % 3 else "fr", "s", i if i % 5 else None) for i in range(90)]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = merkle.leaf_hash([F.col("doc_id"), F.col("source"), F.col("lang"), (F.col("n_chars") + 1).cast("string"),
                                F.col("text")])
    same = merkle.leaf_hash([F.col(c) for c in FIELDS])
    got = merkle.manifest(frame(spark, rows), FIELDS, "lang", "doc_id", F.when(hit, changed).otherwise(same))
    got = got.select("doc_id", "root", merkle.folded(F.col("presented"), F.col("path")).alias("folded"),
                     merkle.proof_digest(F.col("path")).alias("digest")).collect()
    want = {r[0]: H(*(a + b for a, b in r[4])) for r in brute(rows)}
    for r in got:
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] % 5 != 0
        assert (r["folded"] == r["root"]) == (not tampered)
        assert r["digest"] == want[r["doc_id"]]


def test_no_join_in_the_proofs(spark):
    df = frame(spark, sample(40, random.Random(1)))
    plan = merkle.manifest(df, FIELDS, "lang", "doc_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Generate explode" in plan

"""Spelling variants, centroid clusters and frequent lines against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowhaul.llm import centroids
from rowhaul.llm.centroids import cluster_vectors
from rowhaul.llm.lines import LineRuns, drop_frequent_lines
from rowhaul.llm.rolling import BASES, PRIME, Spans
from rowhaul.llm.variants import SHARE, spelling_variants

A_TO_Z = {c: c + 32 for c in range(65, 91)}


@pytest.fixture(scope="module")
def table(spark):
    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        return df.withColumns({"n": F.lit("clash"), "word": F.lit(1), "row": F.lit(2), "line": F.lit("x"), "n_lines": F.lit("clash"), "source": F.lit("s")})

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_spans_are_polynomials_modulo_the_prime():
    rng = random.Random(3)
    codes = np.array([rng.randrange(1, 256) for _ in range(700)])
    for lane, base in enumerate(BASES):
        spans = Spans(codes, lane)
        for _ in range(100):
            a = rng.randrange(700)
            b = rng.randrange(a, 701)
            assert spans(np.array([a]), np.array([b]))[0] == sum(int(c) * pow(base, k, PRIME) for k, c in enumerate(codes[a:b])) % PRIME


# --- spelling variants -------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def variants_by_hand(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(A_TO_Z)
            h = 1 if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    out, forms = [], {}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    others = {w: [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if near(w, x)] for w in words}
    for w, n in words.items():
        best = min(others[w], key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 10 * n else None
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n, len(others[w]), forms[w] and words[forms[w]]))
    return sorted(out, key=repr)


def spelled(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abé", "aÿ×zÀ", "abcdefgh"])
    base = ["".join(rng.choice(letters) for _ in range(rng.choice([6, 7, 8, 9, 14, 33]))) for _ in range(12)] + ["a" * 9, "ab" * 6, letters[0] * 20]
    rows = [(None, None), (1, None), (2, ""), (3, "short words only"), (None, " ".join(base)), (4, "x" * 100_000), (5, f"{'x' * 100_000} {'x' * 99_999} {'x' * 99_999}y")]
    rows += [(6, "Z" + "x" * 99_999)] * 2 + [(8, "rootword " * 300 + "rootworf " * 25 + "rootwoff " * 2)]
    for doc in range(10, 70):
        words = []
        for _ in range(rng.randrange(60)):
            w = rng.choice(base[: 1 + doc % len(base)])
            for _ in range(rng.choice([0, 0, 0, 0, 1, 2])):
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 and w.isascii() else w)
        rows.append((doc, rng.choice([" ", "-", "9", "\n"]).join(words)))
    return rows + [rows[-1], rows[-1]]


@pytest.mark.parametrize(("seed", "share", "bucket"), [(1, SHARE, 400_000), (2, 30, 200_000), (3, 1, 400_000), (4, 100, 100_000)])
def test_spelling_variants(table, seed, share, bucket):
    rows = spelled(seed)
    want = variants_by_hand(rows)
    assert any(form for _, form, *_ in want) and any(form and form != root for _, form, root, *_ in want)
    assert rows_of(spelling_variants(table(rows), share=share, bucket=bucket), "word", "form", "root", "n", "n_near", "form_n") == want


@pytest.mark.parametrize("rows", [[], [(None, None), (1, "only few here")]], ids=["empty", "no words"])
def test_spelling_variants_of_nothing(table, rows):
    assert rows_of(spelling_variants(table(rows)), "word", "form", "root", "n", "n_near", "form_n") == []


# --- centroid clusters -------------------------------------------------------


def clusters_by_hand(rows, k=16, rounds=3):
    kept = []
    for i, x in rows:
        if x is not None and len(x) == 64 and all(c is not None and np.isfinite(c) for c in x):
            kept.append((i, [min(max(int(np.floor(c * 64)), -(2**27)), 2**27 - 1) for c in x]))
    digest = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    means = [v for _, v in sorted(kept, key=lambda r: digest(r[0]))[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(means)):
            members = [v for (_, v), (_, cluster) in zip(kept, own) if cluster == c]
            if members:
                means[c] = [sum(x) // len(members) for x in zip(*members)]
    own = assign()
    each = Counter()
    for far, c in own:
        each[c] += far
    name = lambda c: hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()
    fit = lambda n: n if n < 2**63 else None
    return sorted(((i, c, far, fit(each[c]), fit(sum(each.values())), name(c)) for (i, _), (far, c) in zip(kept, own)), key=repr)


def embedded(seed, spread=1.0, n=300):
    rng = np.random.default_rng(seed)
    rows = [(i, (rng.normal(size=64) * spread).astype(np.float32).astype(float).tolist()) for i in range(n)]
    rows += [(5, rows[5][1]), (6, rows[5][1]), (None, rows[7][1]), (None, None), (1000, None), (1001, []), (1002, [0.5] * 63), (1003, [None] + [1.0] * 63)]
    rows += [(1004, [float("nan")] + [1.0] * 63), (1005, [float("inf")] * 64), (1006, [0.0] * 64), (1007, [-0.0] * 64), (1008, [-1 / 64] * 64)]
    return rows


CLUSTERED = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


@pytest.mark.parametrize("rows", [embedded(1), embedded(2, 300.0), embedded(3, 0.004), embedded(4)[:9], [], [(1, None)]], ids=["usual", "wide", "narrow", "few", "empty", "none kept"])
def test_clusters(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("clash")).repartition(5)
    assert rows_of(cluster_vectors(df), *CLUSTERED) == clusters_by_hand(rows)


def test_clusters_at_the_bounds(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [float(x) for x in rng.choice([3e38, -3e38, 2.0**21, -(2.0**21), 1.0, 0.0, 2.0**21 - 1 / 64], 64)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert rows_of(cluster_vectors(df), *CLUSTERED) == clusters_by_hand(rows)


def test_planes_give_exact_dot_products():
    rng = np.random.default_rng(5)
    for low, high in ((0, 1), (-1, 1), (-64, 64), (-(2**27), 2**27)):
        a, b = rng.integers(low, high, (50, 64)), rng.integers(-(2**20), 2**20, (7, 64))
        assert (centroids.dots(centroids.planes_of(a)[0], centroids.planes_of(b)[0]) == a @ b.T).all()


# --- frequent lines ----------------------------------------------------------


def lines_by_hand(rows, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(A_TO_Z)
    documents = Counter(k for _, text in rows for k in {key(x) for x in (text or "").split("\n")} if k)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if documents[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def lined(seed):
    rng = random.Random(seed)
    shared = ["Home | About", "  home | about\t", "É", "é", "\x0bx\x0c", "X", " ", " x", "日本", "", " ", "\r", "Kelvin K", "kelvin k"]
    rows = [(None, None), (1, None), (2, ""), (3, "\n"), (4, "a" * 300_000), (5, "\n".join(["same"] * 5000))]
    for doc in range(10, 90):
        rows.append((doc, "\n".join(rng.choice(shared) if rng.random() < 0.4 else f"line {rng.randrange(60)}" for _ in range(rng.randrange(12)))))
    return rows + [rows[-1]] * 3 + [(None, "X\nonly here"), (7, rows[-1][1])]


@pytest.mark.parametrize(("rows", "least", "batches", "fanout"), [(lined(1), 10, 6, 3), (lined(2), 3, 9, 2), (lined(3), 1, 2, 2), (lined(4), 10, 1, 3), ([], 10, 6, 3)])
def test_frequent_lines(table, rows, least, batches, fanout):
    found = drop_frequent_lines(table(rows), least=least, batches=batches, fanout=fanout)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept_text") == lines_by_hand(rows, least)


def test_runs_are_levelled_and_settled_lines_are_stored_once(spark):
    runs, counts = LineRuns(least=4, fanout=2), Counter()
    for batch in range(8):
        lines = [b"everywhere", b"twice %d" % (batch // 2), b"own %d" % batch]
        counts.update(lines)
        runs.add(spark.createDataFrame([(x,) for x in lines], "line binary"))
        assert [len(level) for level in runs.levels] == [int(b) for b in reversed(f"{batch + 1:b}")]
        held = Counter(bytes(r.line) for level in runs.levels for run in level for r in run.collect())
        assert max(held.values(), default=0) <= len(runs.levels)
        if batch >= 4:
            assert b"everywhere" not in held
    assert [bytes(r.line) for r in runs.frequent().collect()] == [x for x, n in counts.items() if n >= 4]

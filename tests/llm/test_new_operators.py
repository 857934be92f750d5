"""Whitening, the filter audit and b-bit MinHash against brute force on small frames."""

import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from pitfeat.llm import filter_audit, minhash, whitening

WORDS = "the of and to stone river light house seven green walked under old bridge with many small fish".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


# ---- whitening

VECTORS = "vec_id long, embedding array<float>, label int, x string, n long"


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 5) for i, v in rows], VECTORS)


@pytest.fixture(scope="module")
def vectors():
    r = np.random.default_rng(3)
    mixed = r.normal(size=(300, 6)) @ np.diag([3, 2, 1, 0.5, 0.2, 0.1]) @ np.linalg.qr(r.normal(size=(6, 6)))[0]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(mixed)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a very common vector
    rows += [(7, rows[7][1]), (None, rows[8][1]), (2000, [-0.0] * 6)]
    bad = [None, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] + [0.0] * 5, [], [1.0, 2.0]]
    return rows, [(3000 + i, v) for i, v in enumerate(bad)]


def expected(rows):
    x = np.floor(256 * np.array([np.array(v, np.float32) for _, v in rows], np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    v = np.cov(fit.T, bias=True)
    e, u = np.linalg.eigh(v)
    return x, n, s, e[::-1], u[:, ::-1], np.trace(v)


def test_whitening(spark, vectors):
    rows, bad = vectors
    df = vectors_frame(spark, rows + bad)
    model = whitening.fit(df)
    got = whitening.apply(df, model).collect()
    x, n, s, e, u, trace = expected(rows)
    assert len(got) == 4 * len(rows)
    assert Counter(r.vec_id for r in got) == Counter({i: 4 * k for i, k in Counter(i for i, _ in rows).items()})
    assert {r.n for r in got} == {n} and 0 <= got[0].identity_error < 1e-9
    by_id = {i: xi for (i, _), xi in zip(rows, x)}
    signs = {}
    for r in got:
        c = r.component - 1
        want = (by_id[r.vec_id] - s / n) @ u[:, c] / np.sqrt(e[c])
        sign = signs.setdefault(c, np.sign(want * r.whitened))
        assert r.whitened == pytest.approx(sign * want, abs=1e-9)
        assert r.explained == pytest.approx(e[c] / trace, rel=1e-9)
        assert int(r.deviation) == sum((n * int(a) - int(b)) ** 2 for a, b in zip(by_id[r.vec_id], s))


def test_whitening_defined_cases(spark):
    empty = vectors_frame(spark, [])
    assert whitening.apply(empty, whitening.fit(empty)).count() == 0
    only_bad = vectors_frame(spark, [(1, None), (2, [])])
    assert whitening.apply(only_bad, whitening.fit(only_bad)).count() == 0
    one = vectors_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])
    got = whitening.apply(one, whitening.fit(one)).collect()
    assert [(r.n, r.whitened, r.explained, int(r.deviation)) for r in got] == [(1, 0.0, 0.0, 0)] * 4
    # a line in space: one component has variance; entries large enough for exact wide products
    line = vectors_frame(spark, [(i, [float(i * 2**22), float(-i * 2**22), 0.0]) for i in range(50)])
    got = whitening.apply(line, whitening.fit(line)).where("vec_id = 3").orderBy("component").collect()
    assert got[0].explained == pytest.approx(1.0) and [r.whitened for r in got[1:]] == [0.0, 0.0]
    ys = [256 * i * 2**22 for i in range(50)]
    assert int(got[0].deviation) == 2 * (50 * ys[3] - sum(ys)) ** 2
    assert abs(got[0].whitened) == pytest.approx(abs(ys[3] - np.mean(ys)) / np.std(ys))
    assert got[0].identity_error < 1e-9


@pytest.mark.parametrize("case", ["plain", "clustered", "repeated", "single"])
def test_refined_eigenvectors(case):
    r = np.random.default_rng(1)
    d = 40
    q = np.linalg.qr(r.normal(size=(d, d)))[0].astype(np.longdouble)
    values = np.sort(r.random(d) * 100)[::-1].astype(np.longdouble)
    if case == "clustered":
        values[5:15] = 50 + np.arange(10) * np.longdouble(1e-9)
    if case == "repeated":
        values[5:15], values[30:] = 30, 0
    if case == "single":
        values[1:] = 0
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined_eigenvectors(a)
    wide = x.astype(np.longdouble)
    assert np.all(np.diff(e) <= 0)
    assert abs(wide.T @ wide - np.eye(d)).max() < 1e-15
    assert abs(a @ wide - wide * e).max() < 1e-15 * abs(a).max() * 4
    # float32 alone is far from that
    x32 = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    assert abs(x32.T @ x32 - np.eye(d)).max() > 1e-9


def test_wide_product():
    r = np.random.default_rng(2)
    a, b = (r.normal(size=(30, 30)) * 10.0 ** r.integers(-8, 8, (30, 30)) for _ in range(2))
    a, b = a.astype(np.longdouble), b.astype(np.longdouble)
    # errors are small against the largest entries of a row and a column
    room = abs(a).max(1)[:, None] * abs(b).max(0)[None]
    assert (abs(whitening.wide_product(a, b) - a @ b) / room).max() < 1e-16


# ---- filter audit

def audit_brute(docs, labels):
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1 and i is not None} for k in range(2))
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    rows = []
    for i, t, s in docs:
        t = t or ""
        w = t.encode().split()
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t):
            fails.add("C")
        if any(c in "#$%&*|" for c in t):
            fails.add("D")
        if i is not None and i > first[t]:
            fails.add("E")
        rows.append((s or "", fails, i in good, i in toxic))
    out, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for o in permutations("ABCDE"):
            left = own
            for k, f in enumerate(o):
                gone = [r for r in left if f in r[1]]
                shapley[part, f] += len(gone)
                failing = sum(f in r[1] for r in own)
                left = [r for r in left if f not in r[1]]
                out[part, "".join(o), k + 1] = (
                    len(left), len(gone), failing - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone))
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filter_audit(spark):
    r = random.Random(5)
    pool = [prose(k, 250) for k in range(4)] + [
        "w " * 300, prose(9, 20), "A$B " + prose(3, 210), "UPPER CASE", None, "", "a | b", prose(1, 250).upper(),
        "é漢 " * 250, "x" * 40_000, prose(2, 30_000)]
    docs = [(i, r.choice(pool), r.choice(["a", "b", None, ""])) for i in range(80)]
    docs += [(None, pool[0], "a"), (None, pool[0], "a"), (3, pool[0], "b"), docs[5], docs[5]]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 60)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, 1, 2, "m") for d in docs],
                                  "doc_id long, text string, source string, n long, good long, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(x.part, x.filter_order, x.step): tuple(x)[3:] for x in filter_audit.audit(frame, marks).collect()}
    assert got == audit_brute(docs, labels)
    assert filter_audit.audit(frame.limit(0), marks).count() == 0
    bare = filter_audit.audit(frame, marks.limit(0)).agg({"good_lost": "max", "toxic_lost": "max"}).first()
    assert tuple(bare) == (0, 0)


def test_paths_and_edges():
    forward, backward = filter_audit.paths(4)
    assert forward[15] == backward[0] == 24
    assert all(sum(f * b for s, (f, b) in enumerate(zip(forward, backward)) if bin(s).count("1") == k) == 24
               for k in range(5))
    counts = np.random.default_rng(1).integers(0, 9, (2, 16))
    passed, removed = filter_audit.edge_sums(counts, 4)
    assert (passed[:, 0] == counts.sum(1)).all() and (passed[:, 15] == counts[:, 0]).all()
    assert (removed[:, 0b0101, 1] == counts[:, [m for m in range(16) if m & 0b0101 == 0 and m & 2]].sum(1)).all()


# ---- b-bit MinHash

def jaccard_sets(docs):
    out = []
    for i, t in docs:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k:k + 4]) for k in range(len(w) - 3)} if len(w) > 3 else {tuple(w)} if w else set())
    return out


def minhash_brute(docs):
    sets = jaccard_sets(docs)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, len(s), least.get(find(i), d) if s else d) for i, ((d, _), s) in enumerate(zip(docs, sets)))


def changed(text, r, share):
    words = text.split()
    for k in range(len(words)):
        if r.random() < share:
            words[k] = r.choice(WORDS) + "x"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    r = random.Random(8)
    base = [prose(100 + k, 40 + 20 * k) for k in range(10)]
    out = [*base]
    for k in range(60):  # around the threshold and above it
        out.append(changed(base[k % 10], r, (0.005, 0.03, 0.055, 0.08)[k % 4]))
    chain = base[9]
    for _ in range(8):  # each near the one before, not near the first
        chain = changed(chain, r, 0.02)
        out.append(chain)
    out += [base[2], base[2].upper(), "  " + base[3].replace(" ", "\t") + "\n", None, "", " \n", "one two", "ONE two", "one",
            "a b c d", "a b c d e", "a b c d e f g h", "a b c d e f g h i", "x" * 9000, " ".join(base) * 4, base[4] * 0 + "É à b c"]
    docs = list(enumerate(out)) + [(None, base[1]), (None, "unlike any other text at all here"), (7, base[7]), (7, base[7])]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize("block", [minhash.BLOCK, 1200])
def test_minhash(spark, copies, block):
    df = spark.createDataFrame([(i, t, 3, b"k", 1) for i, t in copies],
                               "doc_id long, text string, n long, key binary, v long").repartition(4)
    got = minhash.near_duplicates(df, block=block).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == minhash_brute(copies)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_minhash_on_text_ids_and_no_rows(spark):
    df = spark.createDataFrame([("b", "one two three four five"), ("a", "One two three four five")], "doc_id string, text string")
    got = sorted(tuple(r) for r in minhash.near_duplicates(df).collect())
    assert got == [("a", 2, "a", True), ("b", 2, "a", False)]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_templated_texts_give_no_pairs(spark):
    """Similar to each other below the threshold: rows compared grow with the texts, not their pairs."""
    frame = prose(77, 180)

    def links_and_rows(n):
        docs = [(i, frame + " " + prose(1000 + i, 32)) for i in range(n)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        rows = df.selectExpr("doc_id", "text AS _text", "unhex(md5(text)) AS key")
        sets = minhash._sets(rows, "bigint").cache()
        return minhash.near_duplicates(df).where("not kept").count(), minhash._members(sets, minhash.BLOCK).count()

    (none, few), (nothing, many) = links_and_rows(40), links_and_rows(80)
    assert none == nothing == 0 and many <= 80 * (minhash.BANDS + 1) and many < 3 * max(few, 40)


def test_estimate():
    r = np.random.default_rng(4)
    shared, one, two = (r.integers(0, 1 << 63, n, np.uint64) for n in (900, 50, 50))
    a, b = (minhash.minima(np.concatenate((shared, x))) for x in (one, two))
    found = minhash.estimates(minhash.signature(a), minhash.signature(b)[None])[0]
    bits = (1 << minhash.BITS) - 1
    same = np.mean((a & np.uint64(bits)) == (b & np.uint64(bits)))
    assert found == pytest.approx((same - 0.25) / 0.75)
    assert abs(found - 0.9) < 0.12
    assert set(minhash.band_keys(a)) & set(minhash.band_keys(b)) and len(set(minhash.band_keys(a))) == minhash.BANDS

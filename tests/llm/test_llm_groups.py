"""MinHash near-dedup, the conversation trie and phrase collocations against brute force, on inputs
that reach the split, deep and hot paths, and on edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from rivulet.llm.minhash import _coefficients, minhash_groups, shingle_hashes, signature
from rivulet.llm.phrases import collocations, phrase_counts
from rivulet.llm.trie import decompose, prefix_trie, rebuilt

WORDS = [f"w{i}" for i in range(300)]


def shingles(text, k):
    w = brute.WORD.findall(brute.ascii_lower(text or ""))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_brute(texts, k, percent=80):
    sets = [shingles(t, k) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def dense_group(rng, members, edits):
    base = rng.choices(WORDS, k=80)
    out = []
    for _ in range(members):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = rng.choice(WORDS[:40])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [4, 5])
def test_minhash_equals_brute_force(spark, k):
    rng = random.Random(7)
    texts = dense_group(rng, 90, 12) + dense_group(rng, 40, 4) + [" ".join(rng.choices(WORDS, k=rng.randint(1, 60))) for _ in range(80)]
    passage = " ".join(rng.choices(WORDS, k=40))
    texts += [f"{passage} {' '.join(rng.choices(WORDS, k=rng.randint(1, 40)))}" for _ in range(60)]
    texts += ["One two", "one TWO", "one", "", None, " \t\n", "ONE two\x0bthree\x0cfour", "one two three four", "one two three four five"]
    texts += texts[:5]
    rng.shuffle(texts)
    roots, sizes = near_brute(texts, k)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in minhash_groups(df, shingle=k).collect()}
    assert {i: (r["component_id"], r["n_shingles"], r["kept"]) for i, r in got.items()} == {
        i: (roots[i], sizes[i], roots[i] == i) for i in range(len(texts))}


def test_minhash_edges(spark):
    rows = [(None, "a b c d e f", "x"), (4, "a b c d e f", "x"), (None, "q r s t u v w", "x"), (3, None, "x"), (3, None, "x"),
            (5, "long text " * 60_000, "x"), (6, "long text " * 60_000, "x"), (2, "", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string").withColumns({c: F.lit(1) for c in ("key", "hub", "n", "sig", "set", "root")})
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in minhash_groups(df).collect())
    assert got == sorted([("None", 2, "4", False), ("4", 2, "4", True), ("None", 3, "None", True), ("3", 0, "3", True), ("3", 0, "3", True),
                          ("5", 2, "5", True), ("6", 2, "5", False), ("2", 0, "2", True)])
    assert minhash_groups(df.where("doc_id = -1")).count() == 0


@pytest.mark.parametrize("rows, values, texts", [(2048, 1 << 20, 200_000), (16, 1 << 20, 0), (2048, 500, 0)])
def test_minhash_blocks_of_a_group(spark, monkeypatch, rows, values, texts):
    """A large group is compared in blocks, with the same components for any size of them; what is handed
    on is a forest of links, found without a comparison of two arrays for each pair."""
    from rivulet.llm import minhash
    rng = random.Random(11)
    docs = dense_group(rng, 160, 14) + dense_group(rng, 30, 9) + [None, ""]
    docs += docs[:3]
    roots, sizes = near_brute(docs, 4)
    assert len(set(roots)) > 40
    for name, value in (("_CELL_ROWS", rows), ("_CELL_VALUES", values), ("BROADCAST_TEXTS", texts)):
        monkeypatch.setattr(minhash, name, value)
    links, found = [], minhash.connected_components
    monkeypatch.setattr(minhash, "connected_components", lambda frame, *ends: links.append(frame) or found(frame, *ends))
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: r for r in minhash_groups(df, shingle=4).collect()}
    assert {i: (r["component_id"], r["n_shingles"]) for i, r in got.items()} == {i: (roots[i], sizes[i]) for i in range(len(docs))}
    assert "array_intersect" not in links[-1]._jdf.queryExecution().optimizedPlan().toString()


def test_minhash_common_sizes_of_sets(monkeypatch):
    from rivulet.llm import minhash
    rng = np.random.default_rng(2)
    base = rng.integers(-1 << 62, 1 << 62, 900)
    sets = [np.unique(np.concatenate([base[rng.random(900) < 0.8], rng.integers(0, 3000, rng.integers(0, 300))])) for _ in range(40)]
    rows, values = np.repeat(np.arange(40), [len(s) for s in sets]), np.concatenate(sets)
    in_a, in_b = np.full(40, -1), np.full(40, -1)
    a, b = np.arange(0, 40, 3), np.arange(40)
    in_a[a], in_b[b] = np.arange(len(a)), np.arange(len(b))
    brute_force = np.array([[len(np.intersect1d(sets[i], sets[j])) for j in b] for i in a])
    for share, pairs in ((64, 1 << 22), (0, 100), (1 << 40, 1 << 22), (2, 1000)):
        monkeypatch.setattr(minhash, "_DENSE_SHARE", share)
        monkeypatch.setattr(minhash, "_PAIRS", pairs)
        got = minhash._shared_sizes(rows, values, in_a, in_b)
        assert ((got == brute_force) | (a[:, None] == b[None, :])).all()
    met = rng.random((50, 40)) < 0.03
    links = [tuple(x) for x in minhash._forest(met)]
    assert all(met[x] for x in links) and len(links) < 90
    root = list(range(90))

    def joined(pairs):
        root[:] = range(90)
        for x, y in pairs:
            old, new = root[x], root[50 + y]
            root[:] = [new if r == old else r for r in root]
        return len(set(root))

    assert joined(links) == joined(zip(*np.nonzero(met)))
    assert len(links) == 90 - joined(links)


def test_signatures_estimate_similarity():
    co = _coefficients(64)
    rng = np.random.default_rng(3)
    for share in (0.2, 0.5, 0.8):
        met = []
        for _ in range(60):
            x = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
            own = int(400 * (1 - share) / (1 + share))  # symmetric difference
            y = np.concatenate([x[own:], rng.integers(0, 1 << 63, own, dtype=np.uint64)])
            met.append((signature(x, co) == signature(y, co)).mean())
        assert abs(np.mean(met) - share) < 0.04
    assert list(shingle_hashes("É é a\x85b".encode(), 5)) != []


def trie_brute(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in convs.items()}
    made = {}
    for c, v in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        made[c] = (own.get(c - c % 20, [])[:h] if h else []) + v[h:]
    order = lambda c: (c is not None, c or 0)
    members, ends = defaultdict(list), defaultdict(list)
    for c, v in made.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
        ends[tuple(v)].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        own_saved = (len(m) - 1) * len(brute.WORD.findall(k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += kids[k] == 0
            saved[k[:d]] += own_saved
    first = {k: min(m, key=order) for k, m in members.items()}
    listed = lambda k: ",".join("null" if c is None else str(c) for c in sorted(ends.get(k, []), key=order))
    return Counter((first[k], len(k), first[k[:-1]] if k else None, len(m), kids[k], leaves[k], saved[k],
                    hashlib.sha256(listed(k).encode()).hexdigest()) for k, m in members.items())


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_rows(spark, rows, local):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({c: F.lit("x") for c in ("c", "pos", "ka", "words", "size", "chunk")})
    return Counter(tuple(r[c] for c in COLUMNS) for r in prefix_trie(*rebuilt(df), local=local).collect())


@pytest.mark.parametrize("local", [1, 3, 4096])
def test_trie_equals_brute_force(spark, local):
    rng = random.Random(11)
    rows = []
    for c in range(60):
        deep = c % 9 == 0
        for t in range(30 if deep else rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "user", "bot"]) if not deep else "user", rng.choice(["hi", "hello there", "a b c"]) if not deep or t > 12 + c % 5 else "same turn"))
    rows += [(100, None, None, None), (100, 0, "user", ""), (101, 5, "a", "x"), (101, 5, "a", "x"), (None, 1, "user", "hi"), (None, 2, None, "b c"), (7, 0, "user", "hi")]
    assert trie_rows(spark, rows, local) == trie_brute(rows)


def test_trie_over_several_chunks_and_empty(spark):
    rows = [(c, t, "r", f"t{t}" if c == 20 or t < 9_000 else "other") for c in (20, 40) for t in range(9_100)]
    got = trie_rows(spark, rows, 700)
    assert got == trie_rows(spark, rows, 1 << 30)
    assert sum(got.values()) == 9_101 + 100 and max(r[5] for r in got) == 2
    assert trie_rows(spark, rows[:0], 5) == Counter()


def test_decompose_equals_plain_rollup():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(1, 40)
        parents = [0] + [rng.randrange(max(0, i - rng.choice([1, 3, 40])), i) for i in range(1, n)]
        values = [(rng.randint(0, 9), rng.randint(-5, 5)) for _ in range(n)]
        want = [list(v) for v in values]
        for v in range(n - 1, 0, -1):
            for i in range(2):
                want[parents[v]][i] += want[v][i]
        assert decompose(parents, values) == want


def phrases_brute(rows, least, top=2000):
    import re
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.ascii_lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    found = defaultdict(list)
    for p, a in f.items():
        if len(p) < 3 or a < least:
            continue
        lang, w = p[0], p[1:]
        longer = [b for q, b in f.items() if len(q) == 4 and len(p) == 3 and b >= least and q[0] == lang and w in (q[1:3], q[2:4])]
        if longer and 100 * max(longer) >= 50 * a:
            continue
        cuts = [(1_000_000 * a * a // (f[p[:k + 1]] * f[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), f[p[:k + 1]], f[(lang, *w[k:])]))
    return {(lang, i, s.decode(), -a, x, y, n[lang], -score) for lang, v in found.items() for i, (score, a, s, x, y) in enumerate(sorted(v)[:top], 1)}


@pytest.mark.parametrize("budget", [2_000_000, 40, 1])
def test_phrases_equal_brute_force(spark, budget):
    rng = random.Random(2)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", " x", "a\x00b", "日本"] + [f"v{i}" for i in range(60)]
    rows = [(rng.choice(["en", "de", None, "und"]), " ".join(rng.choices(vocabulary, weights=[30, 9, 20, 20, 20, 10, 9, 9, 9, 9] + [1] * 60, k=rng.randint(0, 60)))
             .replace(" v1 ", ". ").replace(" v2 ", "\n\t")) for _ in range(150)]
    rows += [("en", "new york city " * 40), ("en", None), (None, ""), ("zz", "one two"), ("en", "the new york city, of.new;york:the!of?the\rof\x0bthe\x0cof")] * 2
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit(1) for c in ("n", "h", "w1", "part", "a")}).repartition(4)
    got = {tuple(r) for r in collocations(df, min_count=5, budget=budget).collect()}
    assert got == phrases_brute(rows, 5)
    assert {tuple(r) for r in collocations(df, min_count=5, top=3).collect()} == phrases_brute(rows, 5, top=3)


def test_phrases_when_bit_sets_are_full(spark):
    rows = [("x", " ".join(random.Random(i).choices(WORDS[:30], k=200))) for i in range(40)]
    df = spark.createDataFrame(rows, "lang string, text string")
    same = [{tuple(r) for r in phrase_counts(df, min_count=8, bits=bits)[1].collect()} for bits in (1 << 15, 1 << 26)]
    assert same[0] == same[1] != set()
    assert collocations(df.where("lang is null")).count() == 0

"""Pure parts: codes, packing plans, minimum cuts, guess costs, fingerprints, components, units."""

import itertools
import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rivulet.llm import huffman, units
from rivulet.llm.components import connected_components
from rivulet.llm.html import minimum_cut
from rivulet.llm.packing import fullest, plan_bins, slots
from rivulet.llm.queries import tokenizer_path
from rivulet.llm.secrets import find_spans, guess_cost
from rivulet.llm.simhash import fingerprint, fingerprint_links


@given(st.lists(st.integers(1, 10 ** 9), min_size=1, max_size=60), st.integers(6, 18))
@settings(max_examples=60, deadline=None)
def test_code_lengths(weights, limit):
    lengths = huffman.code_lengths(weights, limit)
    assert lengths.min() >= 1 and lengths.max() <= limit
    assert sum(2.0 ** -int(x) for x in lengths) <= 1.0
    for (w, a), (v, b) in itertools.combinations(zip(weights, lengths.tolist()), 2):
        assert not (w > v and a > b) and not (v > w and b > a)


def test_code_lengths_are_optimal():
    def best(weights, limit):
        n, least = len(weights), None
        for lengths in itertools.product(range(1, limit + 1), repeat=n):
            if sum(2.0 ** -x for x in lengths) <= 1:
                cost = sum(w * x for w, x in zip(weights, lengths))
                least = cost if least is None else min(least, cost)
        return least
    rng = random.Random(3)
    for _ in range(25):
        weights = [rng.randint(1, 60) for _ in range(rng.randint(2, 5))]
        limit = rng.randint(3, 5)
        assert sum(w * int(x) for w, x in zip(weights, huffman.code_lengths(weights, limit))) == best(weights, limit)


@given(st.lists(st.lists(st.integers(0, 700), min_size=1, max_size=300), min_size=1, max_size=5), st.integers(1, 40))
@settings(max_examples=40, deadline=None)
def test_block_round_trip(blocks, stride):
    total = np.bincount(np.concatenate([np.array(b) for b in blocks]))
    used = np.nonzero(total)[0]
    tokens, lengths, codes = huffman.canonical(used, huffman.code_lengths(total[used], 12))
    code_of, bits_of = np.zeros(701, dtype=np.uint32), np.zeros(701, dtype=np.uint8)
    code_of[tokens], bits_of[tokens] = codes, lengths
    encoded = [huffman.encode_block(np.array(b, dtype="<u4"), code_of, bits_of, stride) for b in blocks]
    assert all(len(p) == (bits + 7) // 8 for p, bits, _ in encoded)
    out = huffman.decode_batch([p for p, _, _ in encoded], [len(b) for b in blocks], [m for _, _, m in encoded],
                               huffman.decode_table(tokens, lengths, codes, 12), 12, stride)
    assert out.tolist() == [x for b in blocks for x in b]


@given(st.dictionaries(st.integers(1, 30), st.integers(1, 4), max_size=6), st.integers(0, 60))
@settings(max_examples=80, deadline=None)
def test_fullest(counts, room):
    chosen = fullest(counts, room)
    reachable = {sum(x * k for x, k in zip(counts, ks)) for ks in itertools.product(*(range(n + 1) for n in counts.values()))}
    assert sum(x * k for x, k in chosen) == max(s for s in reachable if s <= room)
    assert all(k <= counts[x] for x, k in chosen)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 5000), min_size=1, max_size=40))
@settings(max_examples=40, deadline=None)
def test_plan_places_everything(counts):
    plan = plan_bins(counts, 64)
    used = {}
    for times, chosen in plan:
        assert times > 0 and sum(x * n for x, n in chosen) <= 64
        for x, n in chosen:
            used[x] = used.get(x, 0) + times * n
    assert used == counts and len(plan) <= 600
    last = {}
    for length, first, past, *_ in slots(plan):
        assert first == last.get(length, 0) < past
        last[length] = past
    assert last == counts


@given(st.integers(1, 6).flatmap(lambda n: st.tuples(
    st.lists(st.integers(0, 9), min_size=n, max_size=n), st.lists(st.integers(0, 9), min_size=n, max_size=n),
    st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 6)), max_size=8))))
@settings(max_examples=120, deadline=None)
def test_minimum_cut(case):
    source, sink, edges = case
    edges = [e for e in edges if e[0] != e[1]]
    cost = lambda side: (sum(t if s else c for s, c, t in zip(side, source, sink))
                         + sum(c for a, b, c in edges if side[a] != side[b]))
    got = minimum_cut([float(x) for x in source], [float(x) for x in sink], [(a, b, float(c)) for a, b, c in edges])
    assert cost(got) == min(map(cost, itertools.product([False, True], repeat=len(source))))


def test_guess_cost():
    cheap = ["changeme", "password123", "xxxxxxxx", "your_api_key_here", "qwertyuiop", "2019-01-02", "abcabcabc", "P@ssw0rd"]
    dear = ["04dbebab91ab85687d33eeaaf9ac699e1188f962", "k9$Lm2!vQx7", "Xq7RtB29pLzW"]
    assert all(guess_cost(v)[0] < 10 for v in cheap) and all(guess_cost(v)[0] >= 10 for v in dear)
    for v in cheap + dear:
        parts = guess_cost(v)[1]
        assert "".join(v[s:e] for s, e, _ in parts) == v
    assert guess_cost("") == (0.0, [])


def test_guess_spans():
    text = 'pwd: "k9$Lm2!vQx7", auth=changeme token := Xq7RtB29pLzW.'
    assert [(k, text[s:e]) for k, s, e in find_spans(text.encode())] == [("guess", "k9$Lm2!vQx7"), ("guess", "Xq7RtB29pLzW")]
    assert find_spans("the author of this token and secret garden: nothing".encode()) == []


@given(st.text(alphabet="abAB \té\n", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute.fingerprint(text)


@pytest.mark.parametrize("bits", [1, 2, 3])
@pytest.mark.parametrize("max_bucket", [1, 24])
def test_links_connect_what_brute_force_connects(spark, bits, max_bucket):
    rng = random.Random(bits)
    prints = {rng.getrandbits(64) for _ in range(40)} | {0, (1 << 64) - 1}
    for base in list(prints)[:12]:
        for _ in range(25):
            x = base
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = {x: x - (1 << 64) if x >> 63 else x for x in prints}
    links = fingerprint_links(spark.createDataFrame([(v,) for v in signed.values()], "fp bigint"), bits, max_bucket)
    pairs = links.collect()
    assert all(((r["a"] ^ r["b"]) & (1 << 64) - 1).bit_count() <= bits for r in pairs)
    root = {r["node"]: r["root"] for r in connected_components(links, "a", "b").collect()}
    want = brute.components(list(prints), bits)
    got = {x: root.get(v, v) for x, v in signed.items()}
    assert len(set(want.values())) < len(prints)
    groups = lambda m: {frozenset(k for k in m if m[k] == v) for v in set(m.values())}
    assert groups(got) == groups(want)


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7), (3, None)]
    links += [(b, a) for a, b in links[:20]] + [(1000 + rng.randrange(50), 1000 + rng.randrange(50)) for _ in range(40)]
    rows = connected_components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()
    got = {r["node"]: r["root"] for r in rows}
    assert len(got) == len(rows)
    near = {}
    for a, b in links:
        if b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        assert got[node] == min(seen)
    assert set(got) == set(near)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


PARTS = ["a", "The", "word", " ", "  ", "\n", " \n", "\n ", "\t", "'s", ",", ".", "...", "é", "É", "İ", "\xa0", " ", "\x1c", "3", "_",
         "<|endoftext|>", "日本", "é", "Σ", "ſ", "ﬁ", "😀", "-", '"', "\r\n", "\x0b", "don't.", "x\ny", "word,\nWord"]


@pytest.mark.parametrize("name,rule", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_units_equal_whole_texts(name, rule):
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    own = units.UnitEncoder(units.tokenizer_settings(tokenizer_path(name)))
    assert own.rule == rule
    end = (2).to_bytes(4, "little")
    assert [own.encode(t.encode()) + end for t in texts] == brute.token_ids(name, texts)

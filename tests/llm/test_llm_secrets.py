"""The guess-cost program against an independent exhaustive segmentation, on very long values, on planted
random values and in its credential contexts."""

import math
import random
import re
import string
import time

import pytest

from rivulet.llm.secrets import ALPHABETS, COMMON, LEET, MIN_GUESSES, PLACE, SEPARATOR_COST, SEPARATORS, SPAN_COST, brute_cost, find_spans, guess_cost


def piece_cost(piece: str) -> float:
    """Least cost of a piece as one span, kind by kind, straight from the definitions."""
    classes = {4 if not c.isascii() else 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in piece}
    costs = [len(piece) * math.log10(sum(ALPHABETS[c] for c in classes))]
    if len(piece) <= 2 and all(c in SEPARATORS for c in piece):
        costs.append(SEPARATOR_COST)
    low = "".join(c.lower() if c.isascii() else c for c in piece)
    plain = low.translate(LEET)
    for word, extra in ((low, 0), (plain, low != plain)):
        if word in COMMON and len(piece) > 1:
            costs.append(math.log10(COMMON.index(word) + 2) + 0.5 * ((piece != low) + (low != plain)))
    if re.fullmatch(r"[A-Za-z][a-z]{3,15}", piece, re.A) and not re.search(r"[aeiou]{4}|[^aeiouy]{4}|[jqvz][^aeiouyz]|q[^u]", piece.lower()):
        costs.append(3.2 + 0.45 * len(piece))
    if re.fullmatch(r"(19|20)\d\d", piece, re.A):
        costs.append(math.log10(120))
    steps = [(PLACE[b][0] - PLACE[a][0], PLACE[b][1] - PLACE[a][1]) for a, b in zip(low, low[1:])] if all(c in PLACE for c in low) else []
    if len(piece) >= 3 and steps and all(s != (0, 0) and max(map(abs, s)) <= 1 for s in steps):
        turns = sum(a != b for a, b in zip(steps, steps[1:]))
        if len(piece) >= 4 or not turns:
            costs.append(math.log10(len(PLACE) * len(piece)) + 0.6 * turns)
    return min(costs)


def exhaustive(value: str) -> float:
    """Over all segmentations.  A repeat is followed as far as it goes."""
    n = len(value)
    best = [0.0] + [math.inf] * n
    for cut in range(1 << max(0, n - 1)):
        ends = [i + 1 for i in range(n - 1) if cut >> i & 1] + [n]
        total, start = SPAN_COST * (len(ends) - 1), 0
        for end in ends:
            cost = piece_cost(value[start:end])
            for unit in range(1, (end - start) // 2 + 1):
                times, rest = divmod(end - start, unit)
                goes_on = value[end:end + unit] == value[start:start + unit]
                if not rest and times >= 2 and end - start >= 3 and not goes_on and value[start:end] == value[start:start + unit] * times:
                    cost = min(cost, brute_cost(value[start:start + unit]) + math.log10(times))
            total, start = total + cost, end
        best[n] = min(best[n], total)
    return best[n]


def test_guess_cost_equals_the_exhaustive_segmentation():
    rng = random.Random(9)
    alphabets = ["ab1", "aeiqz", "qwe123", "Aa1$_", "pasword", "19820", "admin@d_", "é-x"]
    for i in range(400):
        value = "".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 9)))
        whole = exhaustive(value)
        found, parts = guess_cost(value)
        assert found == pytest.approx(whole), value
        assert "".join(value[s:e] for s, e, _ in parts) == value
        limited = guess_cost(value, 6.0)[0]
        assert limited == (pytest.approx(found) if found < 6.0 else math.inf)


@pytest.mark.parametrize("unit", ["a", "as", "banana", "=", "password", "_-", "qwertyuiop", "é", "random"])
def test_values_of_a_million_characters(unit):
    value = (unit * (1_000_000 // len(unit))) if unit != "random" else "".join(random.Random(1).choices(string.ascii_letters + "0123456789+/", k=1_000_000))
    began = time.monotonic()
    find_spans(f"auth={value} end".encode())
    guess_cost(value, MIN_GUESSES)
    assert time.monotonic() - began < 2


def test_recall_on_planted_random_values():
    rng = random.Random(4)
    texts = []
    for i in range(600):
        value = "".join(rng.choices(string.ascii_letters + string.digits, k=8))
        context = rng.choice(["pwd: {}", "auth={}", "client_secret := '{}'", "Authorization: Bearer {}", "pwd:\t{}", "api key => \"{}\""])
        texts.append((f"some words before, {context.format(value)} and more", value))
    hit = sum(any(k == "guess" and text[s:e] == value for k, s, e in find_spans(text.encode())) for text, value in texts)
    assert hit >= 0.9 * len(texts)
    plain = ["password: changeme", "pwd=${DB_PASSWORD}", "auth: required", "token: summer2024", "the bearer of good news", "secret=xxxxxxxxxxxx",
             "pin: 1234", "passphrase: correcthorse", "auth = my_secret_value"]
    assert not [t for t in plain if any(k == "guess" for k, _, _ in find_spans(t.encode()))]


def test_long_pronounceable_values_cost_more_than_short_ones():
    assert guess_cost("kilomare")[0] < MIN_GUESSES < guess_cost("kilomaretusabodinekaloperimutasagoru")[0]
    assert guess_cost("k3m9x2q7")[0] >= MIN_GUESSES

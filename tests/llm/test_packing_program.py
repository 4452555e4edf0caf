"""The covering program behind packing: pricing, bound, rounding and the plan's places, against brute force."""

import random
from collections import Counter
from functools import cache

import numpy as np
import pytest

from txnscope.llm import packing


def covered(plan):
    got = Counter()
    for config, times in plan.uses:
        assert times > 0 and sum(x * k for x, k in config) <= plan.capacity
        for x, k in config:
            got[x] += k * times
    return got


def fewest(histogram, capacity):
    """The smallest number of sequences by trying every filling of one sequence after another."""
    lengths = sorted(histogram, reverse=True)

    @cache
    def solve(left):
        if not any(left):
            return 0
        first = next(i for i, n in enumerate(left) if n)
        best = sum(left)

        def fill(i, room, now):
            nonlocal best
            if i == len(lengths):
                best = min(best, 1 + solve(now))
                return
            for k in range(min(now[i], room // lengths[i]) + 1):
                fill(i + 1, room - k * lengths[i], (*now[:i], now[i] - k, *now[i + 1 :]))

        fill(first, capacity - lengths[first], (*left[:first], left[first] - 1, *left[first + 1 :]))
        return best

    return solve(tuple(histogram[x] for x in lengths))


@pytest.mark.parametrize("seed", range(12))
def test_small_plans_against_brute_force(seed):
    rng = random.Random(seed)
    histogram = {x: rng.randint(1, 4) for x in rng.sample(range(3, 21), 4)}
    plan, want = packing.make_plan(histogram, 20), fewest(histogram, 20)
    assert covered(plan) == histogram
    assert plan.bound <= want + 1e-6 and want <= plan.sequences <= want + 1
    assert plan.fractional <= plan.bound * (1 + packing.GAP) + 1


@pytest.mark.parametrize("seed", range(5))
def test_price_is_the_best_configuration(seed):
    rng = np.random.default_rng(seed)
    lengths, values = np.array(sorted(rng.choice(np.arange(2, 15), 4, replace=False))), rng.random(4)

    @cache
    def best(room):
        return max((values[i] + best(room - x) for i, x in enumerate(lengths.tolist()) if x <= room), default=0.0)

    worth, choice = packing.price(lengths, values, 20)
    assert np.allclose(worth, [best(c) for c in range(21)])
    for first, (pieces, copies) in enumerate(packing.configurations(lengths, choice, np.arange(4))):
        assert first in pieces and lengths[list(pieces)] @ copies <= 20
        assert np.isclose(values[list(pieces)] @ copies, values[first] + best(20 - int(lengths[first])))


def test_program_beats_best_fit_where_it_wastes():
    histogram = dict.fromkeys(range(600, 760), 997)
    plan, alone = packing.make_plan(histogram), packing.Plan(packing.CAPACITY)
    packing.best_fit(alone, histogram)
    assert covered(plan) == histogram == covered(alone)
    least = -(-sum(histogram.values()) // 3)  # three pieces fit at most
    assert plan.bound <= least <= plan.sequences <= 1.005 * least < alone.sequences


@pytest.mark.parametrize("histogram", [{}, {5: 0}, {2048: 3}, {5: 1}, {1025: 7}, {1: 10_000}, {2048: 2, 1500: 10, 1000: 3, 548: 4}])
def test_edges_and_places(histogram):
    plan = packing.make_plan(histogram)
    assert covered(plan) == {x: n for x, n in histogram.items() if n}
    keys, rows = plan.places()
    held = Counter()
    for x, n in histogram.items():
        for rank in range(n):
            first, copies, base, offset = rows[np.searchsorted(keys, x << packing.LENGTH_SHIFT | rank, side="right") - 1]
            at = (int(base + (rank - first) // copies), int(offset + (rank - first) % copies * x))
            assert at not in held
            held[at] = x
    ends = {}
    for (sequence, offset), x in sorted(held.items()):
        assert ends.get(sequence, 0) == offset
        ends[sequence] = offset + x
    assert len(ends) == plan.sequences and max(ends.values(), default=0) <= packing.CAPACITY


def test_ids_of_words_with_separators_specials_and_rare_characters():
    import public_tokenizers

    rng = random.Random(1)
    words = ["a", "\r", "b\rc", "漢", "é", "İ", "<|endoftext|>", "x1'll", "", "\t", "w\n"]
    texts = ["", " ", "a\rb c", "tail ", " lead", "a  b", "end\r"]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    encoder = packing.SpacedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert list(encoder.encode(texts)) == [encoder.ids(t) for t in texts]
    assert list(encoder.encode(["plain words", "plain again"])) == [encoder.ids(t) for t in ("plain words", "plain again")]


def test_plain_texts_are_encoded_in_one_call_each():
    import public_tokenizers

    rng = random.Random(2)
    encoder = packing.SpacedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    signs = [*"abc   \n\t\r'sdt12.,-", "é", "\xa0", "\u2003", "\x85", "\x1c", "'ll", " the", "hello"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(1000)]
    assert list(encoder.encode(texts)) == [encoder.ids(t) for t in texts]
    assert not encoder.cache  # of rare words only
    calls, ids = [], encoder.ids
    encoder.ids = lambda text: calls.append(text) or ids(text)
    list(encoder.encode(["plain text, all of it", *texts[:50]]))
    assert not calls
    encoder.ids = ids
    odd = ["漢 " * 3 + "some plain words 漢字", "я\u2003 x y\x85 я"]
    assert list(encoder.encode(odd)) == [encoder.ids(t) for t in odd] and " some" not in encoder.cache


def test_long_runs_of_white_space():
    import public_tokenizers

    encoder = packing.SpacedEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["b" + s * 1_000_000 + "a" for s in (" ", "\n")] + ["a b" + "\n" * 1_000_000 + "c"]
    assert list(encoder.encode(texts)) == [encoder.ids(t) for t in texts]

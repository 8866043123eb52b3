"""The flow of the mix beside the cheapest of all ways to meet the quotas."""

import itertools
import random

import pytest

from claimbrook.llm import mixing


def cost(used, sizes):
    """The k-th use of a word costs 2k - 1, first uses first."""
    return sum(sum(2 * (i // n) + 1 for i in range(u)) for u, n in zip(used, sizes) if n)


def routed(used, members, quotas):
    """Most words that fit the quotas, by trying every subset of sources as a bottleneck."""
    sources = range(len(quotas))
    return min(
        sum(quotas[s] for s in cut) + sum(u for u, m in zip(used, members) if not m <= set(cut))
        for r in range(len(quotas) + 1)
        for cut in itertools.combinations(sources, r)
    )


@pytest.mark.parametrize("seed", range(25))
def test_flow_is_cheapest(seed):
    rng = random.Random(seed)
    members = [frozenset(rng.sample(range(3), rng.randint(1, 3))) for _ in range(3)]
    sizes = [rng.randint(0, 4) for _ in members]
    quotas = [rng.randint(0, 6) for _ in range(3)]
    ways = [u for u in itertools.product(*[range(2 * n + 1) for n in sizes]) if routed(u, members, quotas) == sum(u)]
    most = max(map(sum, ways))
    best = min(cost(u, sizes) for u in ways if sum(u) == most)
    got = mixing.flow(list(zip(members, sizes)), quotas)
    assert sum(got) == most and tuple(got) in ways and cost(got, sizes) == best

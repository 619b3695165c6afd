import random

from lodeworks.llm.common import Memo


def test_memo_is_bounded_and_keeps_what_is_asked_for_often():
    calls = []

    def triple(x):
        calls.append(x)
        return None if x == 0 else 3 * x

    memo, rng = Memo(triple, 20), random.Random(1)
    for _ in range(5000):
        x = rng.randrange(5) if rng.random() < 0.8 else rng.randrange(5, 10_000)
        assert memo[x] == (None if x == 0 else 3 * x)
        assert len(memo) <= 20 and len(memo.older) <= 20
    assert max(calls.count(x) for x in range(5)) <= 3

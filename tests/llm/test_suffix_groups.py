import random

import numpy as np

from civitas.llm.suffix_groups import shared_windows, suffix_array


def test_suffix_array_against_sorting():
    chance = random.Random(1)
    for case in range(3000):
        letters = chance.choice([1, 2, 2, 3, 26])
        text = [1 + chance.randrange(letters) for _ in range(chance.randint(0, 40))]
        if case % 3 == 0:
            text = text[: chance.randint(1, 6)] * chance.randint(1, 7)
        text.append(0)
        assert suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:]), text
    assert suffix_array([]) == []


def test_long_periodic_text_is_linear():
    text = [1, 2] * 50_000 + [0]
    order = suffix_array(text)
    assert order[0] == 100_000 and order[1] == 99_998 and order[-1] == 1


def test_shared_windows_against_dictionary():
    chance = random.Random(2)
    for _ in range(200):
        texts = [bytes(chance.choices(b"ab\x00\xff", k=chance.randint(5, 30))) for _ in range(chance.randint(1, 8))]
        owners = [chance.randrange(5) for _ in texts]
        least: dict[bytes, int] = {}
        for t, o in zip(texts, owners):
            for i in range(len(t) - 4):
                least[t[i : i + 5]] = min(o, least.get(t[i : i + 5], o))
        expected = [least[t[i : i + 5]] for t in texts for i in range(len(t) - 4)]
        assert np.array_equal(shared_windows(texts, owners, 5), expected)

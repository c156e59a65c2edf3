"""op1: labels reach every copy of an observed unit, and messages settle."""

import random

import numpy as np

from braid.llm import pii


def prose(rng, n):
    return " ".join("".join(rng.choice("abcde") for _ in range(5)) for _ in range(n))


def weights(rng):
    tel = lambda: f"{rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
    return pii.train([f"{prose(rng, 30)} +1 ({tel()} {prose(rng, 30)} mail a{i}@b.org version {rng.randrange(9)}.{rng.randrange(9)} of {rng.randrange(10**6)}" for i in range(200)])


def test_dozens_of_copies():
    """All copies get the label, though each by itself speaks against it."""
    rng = random.Random(22)
    for against in (0.5, 3.0, 5.0):
        w = {"node": np.zeros((pii.N_SHAPE, 6)), "chain": np.zeros((6, 6)), "skip": np.full(1, pii.PRIOR)}
        w["node"][0, 0] = against
        for before, after in ((0, 30), (5, 30), (40, 0), (100, 200)):
            text = " ".join([*(f"{prose(rng, 20)} 372-555-7739" for _ in range(before)), "+1 (372) 555-7739", *(f"{prose(rng, 20)} 372-555-7739" for _ in range(after))])
            ((base, added),) = pii.spans([text], w)
            assert len(base) == 1 and len(added) == before + after and all(k == 3 and text[s:e] == "372-555-7739" for s, k, e in added)


def test_messages_settle():
    rng = random.Random(23)
    w = weights(rng)
    texts = [" ".join(rng.choice(["+1 (372) 555-7739", "372-555-7739", "555-7739", "a@b.org", "A@B", "20240101", "7"]) for _ in range(60)) for _ in range(8)]
    g = pii._graph(texts)
    assert np.abs(pii.marginals(g, w) - pii.marginals(g, w, 5000)).max() < 1e-3


def test_secrets_and_their_copies():
    """What a word introduces is a secret, and so are its copies and, if nearly all of its form are introduced, others of that form."""
    rng = random.Random(24)
    made = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    w = pii.train([f'{prose(rng, 30)} token = "{made(40)}" {prose(rng, 10)} page-2024-of-{prose(rng, 1)} {rng.randrange(10**6)}' for _ in range(200)])
    key, other = made(40), made(40)
    text = f'{prose(rng, 9)} password: {key} {prose(rng, 9)} {key} {prose(rng, 9)} {other} section-12-of-report 1234'
    ((base, added),) = pii.spans([text], w)
    assert not base and [(text[s:e], pii.LABELS[k]) for s, k, e in added] == [(key, "secret"), (key, "secret"), (other, "secret")]


def test_numbers_side_by_side():
    """The base pattern reads two card numbers as one that is too long; the field sees each."""
    rng = random.Random(25)
    card = "4465758382889437"
    w = pii.train([f"{prose(rng, 20)} {card} {prose(rng, 9)} {rng.randrange(10**15, 10**16)} {prose(rng, 9)} {rng.randrange(10**6)}" for _ in range(200)])
    text = f"{prose(rng, 9)} {card} {prose(rng, 9)} {card} {card}"
    ((base, added),) = pii.spans([text], w)
    assert len(base) == 1 and [text[s:e] for s, _, e in added] == [card, card] and {k for _, k, _ in added} == {2}

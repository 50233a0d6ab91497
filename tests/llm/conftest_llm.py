"""Texts for the tests of this folder."""

import random

def make_texts(seed, n=150):
    """Documents with exact, near and far copies and a shared passage."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choices(vocabulary, k=60))
    texts = []
    for _ in range(n):
        kind = rnd.random()
        if texts and kind < 0.15:
            texts.append(rnd.choice(texts).replace(" ", "  "))
        elif texts and kind < 0.55:
            words = rnd.choice(texts).split()
            for _ in range(max(1, len(words) // rnd.choice([8, 20, 40, 100]))):
                if words:
                    words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
            texts.append(" ".join(words))
        elif kind < 0.75:
            texts.append(" ".join(rnd.choices(vocabulary, k=rnd.randint(5, 60))) + " " + passage)
        else:
            texts.append(" ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 3, 5, 30, 120, 400]))))
    return texts

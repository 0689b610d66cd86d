"""Rows that operators must bear: nulls, ties, copies, very long and empty values."""

from __future__ import annotations

import random


def prose(seed: int, words: int) -> str:
    pick = random.Random(seed)
    parts = ["the", "of", "and", "river", "stone", "walks", "quiet", "house", "über", "déjà"]
    parts += [f"w{pick.randrange(5000)}" for _ in range(80)]
    text = " ".join(pick.choice(parts) for _ in range(words))
    return text + "."


def edge_texts() -> list[tuple[int | None, str | None]]:
    shared = prose(99, 60)
    edges = [
        (7, "tie of equal ids"),
        (7, "tie of equal ids"),
        (3, None),
        (4, ""),
        (5, " \t\n \x0b\x0c\r "),
        (None, "no id but a text, and " + shared),
        (6, "don't, it's. \x00 é é K ǰ J̌ İ Σς  ab 漢字 😀 \x85\x1c <|endoftext|>"),
        (8, "a" * 3000),
        (9, ("abc " * 700) + "x" * 1500),
        (10, prose(1, 9000)),
        (11, prose(2, 120) + "\n" + shared),
        (12, shared + "\n" + prose(3, 80) + "\n" + shared),
        (13, prose(4, 200)),
        (14, prose(4, 200)),
        (15, prose(4, 199)),
        (16, "Home | About | Contact\n" + prose(5, 70) + "\nAll rights reserved.\nok"),
        (17, "### $$$ %%% &&&\n" * 30),
        (18, prose(6, 70).upper() + "!!"),
        (19, "one"),
        (-5, "negative id. " + prose(7, 60)),
    ]
    return edges


def edge_items() -> list[tuple[int | None, str | None]]:
    return [
        (1, "river stone"),
        (1, "river stone"),
        (2, None),
        (3, ""),
        (4, "zzz nowhere"),
        (5, "THE Über über déjà 漢字 😀 w12 w13 don't"),
        (None, "the of, and: the"),
        (6, "tie OF equal ids"),
        (7, " ".join(f"w{i}" for i in range(5000)) + " abc a"),
    ]


def edge_vectors() -> list[tuple[int | None, list | None]]:
    pick = random.Random(8)
    good = [[pick.gauss(0, 3), pick.gauss(1, 1), pick.gauss(0, 0.1) + 2] for _ in range(40)]
    inf, nan = float("inf"), float("nan")
    bad = [None, [], [None, 1.0, 2.0, 0.5], [nan, 1.0, 2.0, 0.5], [inf, 1.0, 2.0, 0.5]]
    bad += [[1.0, 2.0, -inf, 0.5], [1e30, 1.0, 1.0, 0.5], [1.0, 2.0], [1.0, 2.0, 3.0, 4.0, 5.0]]
    rows = [*enumerate(good), *enumerate(good[:5]), (None, good[7])]
    rows += [(100 + k, v) for k, v in enumerate(bad)]
    # A constant dimension: a component that can't be whitened.
    return [(i, v + [0.5] if v in good else v) for i, v in rows]

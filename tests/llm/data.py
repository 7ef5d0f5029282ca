"""Small tables with every awkward case, and brute-force versions."""

import random
import re

LOWER = {c: c + 32 for c in range(65, 91)}


def random_texts(count: int, seed: int) -> list:
    """Texts with copies, near copies, shared lines, empty and null ones."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    line = " ".join(rng.choice(words) for _ in range(14)) + "."
    out: list = [None, "", " \n\t ", "one", "One", "two words", "a b c d", "A b  c D"]
    while len(out) < count:
        kind = rng.random()
        known = [t for t in out if t and len(t) > 60]
        if kind < 0.15 and known:
            out.append(rng.choice(known))
        elif kind < 0.45 and known:
            copy = rng.choice(known).split(" ")
            for _ in range(rng.randint(1, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
        else:
            text = [" ".join(rng.choice(words) for _ in range(rng.randint(3, 25))) + rng.choice(".!?,")
                    for _ in range(rng.randint(1, 12))]
            if rng.random() < 0.4:
                text.insert(rng.randrange(len(text)), line)
            out.append(rng.choice(" \n").join(text).capitalize())
    return out


def shingles(text, size: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def components(texts: dict, percent: int = 75) -> dict:
    """doc_id -> (set size, smallest doc_id reachable), by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in sets:
        for j in sets:
            if j < i and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= percent * len(sets[i] | sets[j]):
                    one, two = sorted((root(i), root(j)))
                    label[two] = one
    return {i: (len(sets[i]), root(i)) for i in sets}

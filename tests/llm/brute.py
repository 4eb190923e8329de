"""Plain Python versions of what the operators compute."""

import collections
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, width):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def char_shingles(line, width=5):
    return {line[i:i + width] for i in range(len(line) - width + 1)} or {line}


def components(sets, percent=80):
    """Smallest index of each index's component under Jaccard >= percent, by an inverted index."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    seen = collections.defaultdict(list)
    for i, s in enumerate(sets):
        shared = collections.Counter()
        for x in s:
            shared.update(seen[x])
            seen[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def auc(score, label):
    ranked = sorted(zip(score, label))
    wins = ties = below = 0
    i = 0
    while i < len(ranked):
        j = i
        while j < len(ranked) and ranked[j][0] == ranked[i][0]:
            j += 1
        good = sum(y for _, y in ranked[i:j])
        bad = j - i - good
        wins += good * below
        ties += good * bad
        below += bad
        i = j
    n = sum(label)
    return (wins + ties / 2) / (n * (len(label) - n))

"""Plain versions that several tests compare with."""

import itertools

import xxhash


def plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(marks):
    """{node: smallest node reachable} over all pairs."""
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for a, b in itertools.combinations(marks, 2):
        if (a ^ b).bit_count() <= 3:
            root[find(b)] = find(a)
    return {m: find(m) for m in marks}


def near_kept(texts):
    """The smallest id of each component."""
    marks = {i: plain_fingerprint(t) for i, t in texts.items()}
    roots = plain_components(sorted(set(marks.values())))
    smallest = {}
    for i, m in marks.items():
        smallest[roots[m]] = min(i, smallest.get(roots[m], i))
    return set(smallest.values())

"""Plain versions and rows that several tests use."""

#: Nulls, empty and blank texts, ties, repeated rows, a long text and columns whose names operators use themselves.
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", "", ""),
    (None, "one two three four five six seven", "en", None),
    (5, "one two three four five six seven", "en", "b"),
    (6, "One TWO three four five six seven", None, "b"),
    (7, "word " * 30_000, "en", "b"),
    (8, "x" * 100_000, "de", "c"),
    (9, "ünï çødé ñ 漢字 🙂 end", "fr", "c"),
]


def brute_components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in parent}

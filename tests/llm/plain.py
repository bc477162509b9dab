"""Plain Python versions of what the operators compute, for small inputs."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")

EDGE_TEXTS = [
    None, "", " \t\n", "a", "One two", "one TWO three", "x " * 50, "été \U0001f44d  '' don't 語\n\n", "1234 #*$ %&|<>",
    "line one is here\nline one is here\n\nother\nline one is here",
]


def words(text):
    return WORD.findall(text or "")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def repeated_words(own, size):
    """Numbers of the words in windows of ``size`` that occur twice."""
    windows = [tuple(own[i : i + size]) for i in range(len(own) - size + 1)]
    count = Counter(windows)
    return {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(size)}


def repeated_lines(text):
    seen, n = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            n += line in seen
            seen.add(line)
    return n


def shingles(text, size=3):
    own = words(lower_ascii(text))
    if 0 < len(own) < size:
        return frozenset([tuple(own)])
    return frozenset(tuple(own[i : i + size]) for i in range(len(own) - size + 1))


def near_components(rows, percent=85, size=3):
    """``{doc_id: smallest id reachable}`` by comparing all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows]
    top = {i: i for i, _ in rows}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in top}


def without_repeats(rows, length, keep):
    """For ``(place, bytes)`` rows: which bytes go."""
    seen = defaultdict(list)
    for n, (place, data) in enumerate(rows):
        for p in range(len(data) - length + 1):
            seen[data[p : p + length]].append((place, p, n))
    gone = [bytearray(len(data)) for _, data in rows]
    for copies in seen.values():
        if len(copies) > 1:
            for _, p, n in copies if keep == "none" else sorted(copies)[1:]:
                gone[n][p : p + length] = b"\1" * length
    return gone


def without_passages(rows):
    """``{place: text}`` for ``(place, text)`` rows: what neither the 400 bytes nor the 50 words of the pipeline remove."""
    by_byte = without_repeats([(p, t.encode()) for p, t in rows], 400, "first")
    by_word = without_repeats([(p, tuple(words(t))) for p, t in rows], 50, "first")
    left = {}
    for (place, text), gone, some in zip(rows, by_byte, by_word):
        starts = [len(text[: m.start()].encode()) for m in WORD.finditer(text)] + [len(gone)]
        for i, flag in enumerate(some):
            if flag:
                gone[starts[i] : starts[i + 1]] = b"\1" * (starts[i + 1] - starts[i])
        left[place] = bytes(b for b, x in zip(text.encode(), gone) if not x).decode(errors="ignore")
    return left

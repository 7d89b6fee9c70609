"""Plain versions of the corpus operators for small inputs."""

import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text, pattern=WORD):
    return pattern.findall((text or "").translate(LOWER))


def contaminated(docs, benchmark, k=10):
    """doc -> (words, hit words, items)."""
    grams = {}
    for item, text in benchmark:
        w = words(text)
        n = min(k, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = {}
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                found = grams.get(tuple(w[i:i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        out[doc] = len(w), len(hit), sorted(items, key=lambda i: (i is not None, i or 0) if not isinstance(i, str) else (True, i))
    return out


def clusters(sets, percent):
    """Index -> smallest index reachable by Jaccard links."""
    where, root = {}, list(range(len(sets)))
    for i, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(i)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    pairs = {(a, b) for group in where.values() for n, a in enumerate(group) for b in group[n + 1:]}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(sets))]


def shingles(text, k=5):
    w = words(text, SPACE)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near_documents(docs, percent):
    """doc -> smallest doc of its component."""
    docs = sorted(docs)
    roots = clusters([shingles(t) for _, t in docs], percent)
    return {d: docs[r][0] for (d, _), r in zip(docs, roots, strict=True)}


def kept_lines(docs, percent=80):
    """(doc, line number) of the lines that stay, of those that are not blank."""
    places = {}
    for doc, text in sorted(docs):
        for no, line in enumerate((text or "").split("\n") if text is not None else ()):
            line = line.strip(" \t\r\f\x0b").lower()
            if line:
                places.setdefault(line, []).append((doc, no))
    lines = list(places)
    roots = clusters([{x[i:i + 5] for i in range(max(1, len(x) - 4))} for x in lines], percent)
    first = {}
    for line, r in zip(lines, roots, strict=True):
        first[r] = min(first.get(r, places[line][0]), places[line][0])
    return set(first.values()), {p for ps in places.values() for p in ps}


def without_lines(docs):
    """The documents as line deduplication leaves them."""
    keep, every = kept_lines(docs)
    out = []
    for doc, text in docs:
        left = [x for no, x in enumerate(text.split("\n")) if (doc, no) in keep or (doc, no) not in every]
        if "\n".join(left).strip(" \t\r\f\x0b\n") or len(left) == len(text.split("\n")):
            out.append((doc, "\n".join(left)))
    return out


def without_repeats(docs, window=100):
    """doc -> (bytes, removed, spans, kept bytes)."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            s = data[i:i + window]
            if s in seen:
                gone[i:i + window] = b"\1" * window
            seen.add(s)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[doc] = len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)
    return out

"""Brute-force versions of the operators, on Python values."""

import re
import zlib

DOCS = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)}


def near_components(rows, percent):
    """{id: least id that links reach} of (id, text) rows with distinct ids."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: find(d) for d, _ in rows}


def covered(texts, width):
    """Per text (bytes) a mask of the bytes covered by repeated strings."""
    count = {}
    for b in texts:
        for i in range(len(b) - width + 1):
            count[b[i:i + width]] = count.get(b[i:i + width], 0) + 1
    out = []
    for b in texts:
        mask = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if count[b[i:i + width]] > 1:
                mask[i:i + width] = b"\1" * width
        out.append(bytes(mask))
    return out


def letters_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def contaminated(docs, items, window=10):
    """{doc id: (n_words, n_hit, item ids)} of (id, text) rows."""
    windows = []
    for i, text in items:
        w = letters_words(text)
        if w:
            windows += [(str(i) if i is not None else None, tuple(w[s:s + window]))
                        for s in range(max(1, len(w) - window + 1))]
    out = {}
    for d, text in docs:
        words = letters_words(text)
        hit, ids = set(), set()
        for item, win in windows:
            for s in range(len(words) - len(win) + 1):
                if tuple(words[s:s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    ids.add(item)
        out[d] = (len(words), len(hit), sorted(i for i in ids if i is not None))
    return out


def remainder(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


#: Rows that every operator must stand: null id, null, empty and blank texts,
#: repeated rows, ties, a very long text, symbols, non-ASCII.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it."),
    (1, "The quick brown fox jumps over the lazy dog and runs away from it."),
    (2, "The quick brown fox jumps over the lazy dog and runs away from it."),
    (None, "The quick brown fox jumps over the lazy dog and runs away from it."),
    (3, None), (4, ""), (5, "  \n\t "), (6, "... 123 !!"), (7, "a"), (8, "a b"),
    (9, "größe façade ñandú ▁ 日本語 \U0001F600 é İ ſ Σ"),
    (10, "lorem ipsum dolor sit amet consectetur " * 4000),
    (11, "x" * 1000), (12, "x" * 1000), (13, None), (None, None),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, k string, id string, n int"


def odd_frame(spark):
    """``ODD`` with columns named like the operators' own."""
    rows = [(d, t, "en" if d != 5 else None, None, len(t) if t is not None else None, 0.5, "k", "i", 1) for d, t in ODD]
    return spark.createDataFrame(rows, ODD_SCHEMA)


def empty_frame(spark):
    return spark.createDataFrame([], ODD_SCHEMA)

"""Plain versions of the operators for small inputs."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORDS.findall(lower(text))


def least(links, nodes):
    """Smallest reachable node of every node."""
    up = {n: n for n in nodes}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    return {n: top(n) for n in nodes}


def shingle_set(text, size=4):
    w = words(text)
    if not w:
        return set()
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))}


def jaccard_rows(docs, size=4, percent=85):
    sets = {i: shingle_set(t, size) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    low = least(links, ids)
    return sorted((i, len(sets[i]), low[i]) for i in ids)


def repeated_rows(docs, length):
    """(id, bytes, removed, spans, sha256) by a table of all strings of ``length`` bytes."""
    import hashlib
    from collections import Counter

    raw = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(x[k:k + length] for _, x in raw for k in range(len(x) - length + 1))
    out = []
    for i, x in raw:
        gone = [False] * len(x)
        for k in range(len(x) - length + 1):
            if seen[x[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), len(x) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def crc_remainder(doc_id, mod):
    import zlib

    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def unigram_rows(docs, mod, held):
    """(id, held_out, tokens, known, training tokens, add-one score); None is the end."""
    import math
    from collections import Counter

    n = Counter()
    for i, t in docs:
        if crc_remainder(i, mod) != held:
            n.update([*words(t), None])
    total, kinds = sum(n.values()), len(n)
    out = []
    for i, t in docs:
        tokens = [*words(t), None]
        out.append((i, crc_remainder(i, mod) == held, len(tokens), sum(n[w] > 0 for w in tokens), total,
                    sum(math.log10((n[w] + 1) / (total + kinds + 1)) for w in tokens)))
    return out


def plain_line(text):
    return re.sub(r"[\W_]+", " ", text.lower()).strip()


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def measured_rows(docs):
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    from collections import Counter

    out = []
    for i, t in docs:
        t = t or ""
        w = WORDS.findall(t)
        grams = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        n = Counter(grams)
        covered = {k + j for k, g in enumerate(grams) if n[g] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORDS.search(x)]
        out.append((i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
                    len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    return out


def plain_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c for c in (text or "").lower() if c.isalnum() or c in " \t\n\x0b\x0c\r")) if w]


def weighted(w, size=5):
    from collections import Counter

    runs = [" ".join(w[k:k + size]) for k in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    return {s: n * len(s) for s, n in Counter(runs).items()}


def window_matches(docs, items, least=0.8):
    """(doc, item) where any window as long as the item is similar enough."""
    out = set()
    for i, t in docs:
        w = plain_words(t)
        for k, x in items:
            want = plain_words(x)
            target = weighted(want)
            if len(want) < 5 and w != want:  # a short item is only found as the whole text
                continue
            for start in range(max(1, len(w) - len(want) + 1)):
                got = weighted(w[start:start + len(want)])
                common = sum(min(v, target.get(s, 0)) for s, v in got.items())
                if got and target and common >= least * (sum(got.values()) + sum(target.values()) - common):
                    out.add((i, k))
                    break
    return out

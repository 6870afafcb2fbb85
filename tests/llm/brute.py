"""Plain versions of the operators, one text after another."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(w) < 5:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))


def near_groups(rows):
    """(doc_id, n_shingles, component_id, kept) from all pairs that share a shingle."""
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    shared = Counter()
    for ids in where.values():
        for k, a in enumerate(ids):
            for b in ids[k + 1:]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for i, s in sets.items())


def repeated_bytes(rows, length=200):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row."""
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[s:s + length] for _, b in data for s in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone, last = bytearray(len(b)), 0
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                for x in range(max(s, last), s + length):
                    gone[x] = 1
                last = s + length
        spans = sum(1 for x, g in enumerate(gone) if g and not (x and gone[x - 1]))
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def words2(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items):
    """(doc_id, n_words, n_hit, sorted item ids) of every row."""
    wins = defaultdict(set)
    for item, t in items:
        w = words2(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            wins[tuple(w[s:s + n])].add(str(item))
    sizes = {len(w) for w in wins}
    out = []
    for i, t in rows:
        w, hit, found = words2(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (got := wins.get(tuple(w[s:s + n]))):
                    hit.update(range(s, s + n))
                    found |= got
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=repr)


def sentence_spans(rows, least=20):
    """(doc_id, n_sentences, n_words, n_removed, n_removed_words, kept_sha256) of every row.

    Every two consecutive sentences count, and the fewest from a start with ``least`` words.
    """
    docs = []
    for i, t in rows:
        t = t or ""
        parts, before = [], None
        for m in re.finditer(r"[^\x20\x09-\x0D]+", t):
            stops = len(re.findall(r"[.!?\n]", t[:m.start()]))
            if stops != before:
                parts.append([])
            parts[-1].append(m)
            before = stops
        docs.append((i, t, parts))
    where = defaultdict(list)
    for i, t, parts in {(i, t): (i, t, p) for i, t, p in docs}.values():
        for a in range(len(parts)):
            words = [m[0].translate(LOWER) for m in parts[a]]
            for b in range(a + 1, len(parts)):
                short = len(words) < least
                words = words + [m[0].translate(LOWER) for m in parts[b]]
                # Two sentences, and as many more as it takes to hold ``least`` words.
                if b == a + 1 or short and len(words) >= least:
                    where[tuple(words)].append((i is not None, i or 0, t, a, b))
                if len(words) >= least:
                    break
    gone = defaultdict(set)
    for places in where.values():
        # Rows of one doc_id hold no span in common here, so the text breaks no tie.
        for some, i, t, a, b in sorted(places)[1:]:
            gone[some, i, t].update(range(a, b + 1))
    out = []
    for i, t, parts in docs:
        cut = gone[i is not None, i or 0, t]
        begin = [0] + [p[0].start() for p in parts[1:]] + [len(t)]
        kept = "".join(t[begin[k]:begin[k + 1]] for k in range(len(parts)) if k not in cut) \
            if parts else t
        out.append((i, len(parts), sum(map(len, parts)), len(cut), sum(len(parts[k]) for k in cut),
                    hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def one_edit(x, y):
    """Whether two texts differ by exactly one inserted, deleted or replaced character."""
    if len(x) > len(y):
        x, y = y, x
    k = next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    if len(x) == len(y):
        return x != y and x[k + 1:] == y[k + 1:]
    return len(y) == len(x) + 1 and x[k:] == y[k + 1:]


def word_counts(rows):
    """Runs of letters of at least 5 characters and 3 occurrences, one in 97 runs a letter short."""
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w if h % 97 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    return {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}


def spellings(n):
    """(word, form, root, n, n_near, form_n) of words with their counts; all words a pair of each."""
    near = defaultdict(list)
    by_gap = defaultdict(set)
    for w in n:  # words one edit apart share a word with one character left out
        for g in {w} | {w[:k] + w[k + 1:] for k in range(len(w))}:
            by_gap[g].add(w)
    for same in by_gap.values():
        for x in same:
            near[x] += [y for y in same if one_edit(x, y)]
    form = {}
    for w, found in near.items():
        if found and (top := min(found, key=lambda y: (-n[y], y))) and n[top] >= 2 * n[w]:
            form[w] = top
    out = []
    for w, k in n.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, k, len(set(near[w])), n.get(form.get(w))))
    return sorted(out, key=repr)

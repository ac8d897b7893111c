"""Plain Python versions of the text operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        n < 10 or 100 * len(covered) > 20 * n,
    )


def simhash(text, k=4):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """Label per node by union of all linked pairs."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
    return {n: find(n) for n in nodes}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, m.end(), kind))
    return [(k, s, e) for s, _, e, k in sorted(out)]


def spans_digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def cut_lines(docs, min_words=50):
    """Texts (in document order) without later copies, by a suffix array over the line ids.

    All suffixes are sorted; the longest common prefixes of neighbours give, for every position, the
    longest run that also starts at an earlier position. Runs of ``min_words`` words or more go.
    """
    ids, lines = {}, []  # (document, line, id, words) of lines with a word; a None ends a document
    for d, text in enumerate(docs):
        for i, line in enumerate((text or "").split("\n")):
            n = len(WORD.findall(line))
            if n:
                lines.append((d, i, ids.setdefault(line, len(ids)), n))
        lines.append(None)
    unique = len(ids)
    sequence = [x[2] if x else unique + j for j, x in enumerate(lines)]
    order = sorted((j for j in range(len(lines)) if lines[j]), key=lambda j: sequence[j:j + 400])

    def common(a, b):
        n = 0
        while b + n < len(sequence) and a + n < len(sequence) and lines[a + n] and sequence[a + n] == sequence[b + n]:
            n += 1
        return n

    lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
    best = {}
    for r, j in enumerate(order):
        for step in (-1, 1):  # the nearest earlier position on either side of the suffix array
            at, depth = r, 10**9
            while True:
                depth = min(depth, lcp[at] if step < 0 else (lcp[at + 1] if at + 1 < len(order) else 0))
                at += step
                if depth == 0 or not 0 <= at < len(order):
                    break
                if order[at] < j:
                    best[j] = max(best.get(j, 0), depth)
                    break
    gone = set()
    for j, depth in best.items():
        if sum(lines[j + k][3] for k in range(depth)) >= min_words:
            d = lines[j][0]
            gone.update((d, i) for i in range(lines[j][1], lines[j + depth - 1][1] + 1))
    return [None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in enumerate(docs)]


def plant_run(doc_id, text):
    """Words of a text, in every tenth document with a run."""
    words = WORD.findall(text or "")
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def periodic_runs(words):
    """(start, length, period) by comparing all words at all distances."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q) and not any(
                all(words[x] == words[x + p] for x in range(i, i + length - p)) for p in range(1, q)
            ):
                found.append((i, length, q))
            i = j + 1
    return sorted(found)


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def spelled_words(docs):
    """Counts of the words of (doc_id, text) rows, slips put in."""
    seen = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            seen[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def spelling(seen):
    """(word, form, root, n, n_near, form_n) by deleted letters."""
    holes, cut = defaultdict(set), defaultdict(set)
    for w in seen:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
            cut[w[:i] + w[i + 1:]].add(w)
    near = {w: set() for w in seen}
    for w in seen:
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1:]]
            if (short := w[:i] + w[i + 1:]) in seen:
                near[w].add(short)
                near[short].add(w)
        near[w].discard(w)
    form = {}
    for w, others in near.items():
        if others and seen[best := min(others, key=lambda o: (-seen[o], o))] >= 10 * seen[w]:
            form[w] = best
    rows = []
    for w, n in seen.items():
        root = w
        while root in form:
            root = form[root]
        rows.append((w, form.get(w), root, n, len(near[w]), seen.get(form.get(w))))
    return sorted(rows, key=lambda r: r[0])

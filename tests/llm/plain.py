"""Plain versions of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def secrets(text):
    text, found = text or "", []
    found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    listed = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
    return (*(sum(k == i for _, k, _ in found) for i in range(3)), sha(listed))


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    hit = {j for i, w in enumerate(windows) if counts[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(words)
    return (
        n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
        n < 50 or 100 * len(hit) > 50 * n,
    )


def tokens(text):
    return TOKEN.findall((text or "").translate(LOWERED))


def contamination(documents, items, passage=10):
    """Of ``(id, text)`` pairs: id, words, hit words, item ids."""
    where, sizes = defaultdict(set), set()
    for item, text in items:
        words = tokens(text)
        if not words:
            continue
        m = min(passage, len(words))
        sizes.add(m)
        for i in range(len(words) - m + 1):
            where[tuple(words[i : i + m])].add(item)
    out = []
    for document, text in documents:
        words, hit, found = tokens(text), set(), set()
        for m in sizes:
            for i in range(len(words) - m + 1):
                if items_here := where.get(tuple(words[i : i + m])):
                    hit.update(range(i, i + m))
                    found |= items_here
        listed = sorted(str(x) for x in found if x is not None)
        out.append((document, len(words), len(hit), listed))
    return out


def url(text):
    if text is None or "://" not in text:
        return "", ""
    host, path = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", text).groups()
    return host.translate(LOWERED), path


def classes(rows, size=5, similarity=0.8):
    """Least id and size of the class of each ``(id, text)``, by all pairs."""
    up, sets, first, holders = {}, {}, {}, defaultdict(list)

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, text in rows:
        words = re.findall(r"\w+", (text or "").lower())
        up[i] = i
        if not words:
            continue
        if (key := tuple(words)) in first:
            up[root(i)] = root(first[key])
            continue
        first[key] = i
        sets[i] = Counter(tuple(words[j : j + size]) for j in range(max(1, len(words) - size + 1)))
        for run in sets[i]:
            holders[run].append(i)
    shared = Counter()
    for run, ids in holders.items():
        for n, a in enumerate(ids):
            for b in ids[:n]:
                shared[a, b] += min(sets[a][run], sets[b][run])
    for (a, b), n in shared.items():
        if n >= similarity * (sets[a].total() + sets[b].total() - n) - 1e-9:
            up[root(a)] = root(b)
    members = defaultdict(list)
    for i in up:
        members[root(i)].append(i)
    return {i: (min(ids), len(ids)) for ids in members.values() for i in ids}

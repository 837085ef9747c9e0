"""Plain Python versions of what the operators compute."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").encode().lower().decode()


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def quality(text):
    own, lines = words(text), [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    covered = {j for i in range(len(own) - 7) if seen[tuple(own[i:i + 8])] > 1 for j in range(i, i + 8)}
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def repeats(docs):
    """(n_words, n_removed, digest) by (doc_id, text) row."""
    first = {}
    for doc, text in docs:
        own = words(text)
        if doc is not None:
            for k in range(len(own) - 49):
                w = tuple(own[k:k + 50])
                first[w] = min(first.get(w, doc), doc)
    out = []
    for doc, text in docs:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - 49):
            if doc is not None and first[tuple(own[k:k + 50])] < doc:
                gone[k:k + 50] = [True] * 50
        out.append((len(own), sum(gone), sha(" ".join(w for w, g in zip(own, gone) if not g))))
    return out


def shingles(text):
    own = words(lower(text))
    if len(own) >= 5:
        return frozenset(tuple(own[k:k + 5]) for k in range(len(own) - 4))
    return frozenset([tuple(own)] if own else [])


def near(docs):
    """Component by doc_id, links on exact sets; docs: {doc_id: text}."""
    sets = {d: shingles(t) for d, t in docs.items()}
    index, root = defaultdict(list), {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for d, s in sets.items():
        for g in s:
            index[g].append(d)
    for a, b in {(a, b) for v in index.values() for a in v for b in v if a < b}:
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {d: (len(sets[d]), find(d)) for d in docs}


def luhn(digits):
    worth = (int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits)))
    return sum(v - 9 if v > 9 else v for v in worth) % 10 == 0


def personal(text):
    text, out = text or "", []
    bare = lambda m: re.sub("[^0-9]", "", m)
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(bare(m)) <= 19 and luhn(bare(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(bare(m)) <= 15),
    ]
    for k, (name, pattern, valid) in enumerate(kinds):
        out += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if valid(m[0])]
    return [f"{name}:{a}:{b}" for a, _, b, name in sorted(out)]


def context_tree(counts, wanted, depth=7):
    """Log10 probability of every wanted word (b"" is the end) by recursion over all contexts."""
    kt = lambda a, b: math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)
    seen, children = defaultdict(lambda: [0, 0]), defaultdict(set)

    def steps(word):
        spelt = b"\0" * (depth - 1) + b" " + (word + b" " if word else b"\n")
        for i in range(depth, len(spelt)):
            node = 1
            for j in range(7, -1, -1):
                bit = spelt[i] >> j & 1
                yield [(spelt[i - d:i], node) for d in range(depth + 1)], bit
                node = node * 2 + bit

    for word in {*counts, *wanted}:
        for path, bit in steps(word):
            for key, below in zip(path, [*path[1:], None]):
                seen[key][bit] += counts.get(word, 0)
                if below:
                    children[key].add(below)
    weighted, stop = {}, {}
    for key in sorted(seen, key=lambda k: -len(k[0])):
        own = kt(*seen[key])
        if len(key[0]) == depth:
            weighted[key], stop[key] = own, 1.0
        else:
            below = sum(weighted[k] for k in children[key])
            top = max(own, below)
            weighted[key] = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
            stop[key] = math.exp(own - math.log(2) - weighted[key])
    out = {}
    for word in wanted:
        total = 0.0
        for path, bit in steps(word):
            p = 0.0
            for key in reversed(path):
                a = seen[key]
                p = stop[key] * (a[bit] + .5) / (sum(a) + 1) + (1 - stop[key]) * p
            total += math.log10(p)
        out[word] = total
    return out

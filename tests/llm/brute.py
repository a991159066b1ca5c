"""Plain restatements of the operators, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict
from math import floor, log, log10


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def substrings(docs, width=50):
    """(doc_id, text) rows to doc_id: (words, removed, digest)."""
    least = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            least[key] = min(least.get(key, doc), doc)
    out = {}
    for doc, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if least[tuple(w[i:i + width])] < doc:
                gone[i:i + width] = [True] * width
        out[doc] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def leaks(docs, items, width=10):
    """doc_id: (words, hit words, items, digest)."""
    phrases = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        for i in range(max(1, len(w) - width + 1) if w else 0):
            phrases[tuple(w[i:i + width])].add(item)
    lengths = {len(p) for p in phrases}
    out = {}
    for doc, text in docs:
        w, hit, found = item_words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                key = tuple(w[i:i + n])
                if key in phrases:
                    found |= phrases[key]
                    hit.update(range(i, i + n))
        out[doc] = (len(w), len(hit), len(found), sha(",".join(sorted(map(str, found)))))
    return out


def classes(docs, width, percent):
    """doc_id: (set size, smallest reachable id), by all pairs that share a gram."""
    sets = {}
    for doc, text in docs:
        w = words(lower(text))
        sets[doc] = frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else (
            frozenset([tuple(w)]) if w else frozenset())
    first = {}
    root = {}
    for doc in sorted(sets):
        root[doc] = first.setdefault(sets[doc], doc) if sets[doc] else doc

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    holders = defaultdict(list)
    for s, doc in first.items():
        n = len(s)
        for gram in sorted(s, key=lambda g: hashlib.md5(repr(g).encode()).digest())[:n - -(-percent * n // 100) + 1]:
            holders[gram].append(doc)
    seen = set()
    for docs_ in holders.values():
        for i, a in enumerate(docs_):
            for b in docs_[i + 1:]:
                n, m = len(sets[a]), len(sets[b])
                if 100 * min(n, m) < percent * max(n, m) or (a, b) in seen:
                    continue
                seen.add((a, b))
                shared = len(sets[a] & sets[b])
                if 100 * shared >= percent * (n + m - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(sets[d]), find(d)) for d in sets}


def suffix_tree(learnt, texts, depth, least, gain):
    """The number of states, and the log10 probability of each text."""
    def split(text):
        w = words(lower(text))
        return ["<s>", *("<again>" if i and w[i - 1] == x else x for i, x in enumerate(w)), "<s>"]
    uses, ends = Counter(w for t in learnt for w in words(lower(t))), len(learnt)
    whole = sum(uses.values()) + ends + 0.1 * (len(uses) + (ends > 0) + 2)
    counts = defaultdict(Counter)
    for s in map(split, learnt):
        for i in range(1, len(s)):
            for d in range(1, min(depth, i) + 1):
                counts[tuple(s[i - d:i])][s[i]] += 1
    states = {}

    def chance(context, symbol):
        while context and context not in states:
            context = context[1:]
        if not context:
            return ((ends if symbol == "<s>" else 0 if symbol == "<again>" else uses[symbol]) + 0.1) / whole
        own = states[context]
        return (own[symbol] + len(own) * chance(context[1:], symbol)) / (sum(own.values()) + len(own))
    for context in sorted(counts, key=len):
        own, n = counts[context], sum(counts[context].values())
        if n >= least and sum(c * log(c / n / chance(context[1:], x)) for x, c in own.items()) >= gain:
            states[context] = own
    scores = [sum(log10(chance(tuple(s[max(0, i - depth):i]), s[i])) for i in range(1, len(s))) for s in map(split, texts)]
    return {"states": len(states), "scores": scores}


def cut_repeats(docs, width=50):
    """doc_id to text without the words of windows that a smaller id has; None where no word is left."""
    least = {}
    for doc, text in docs:
        w = words(text)
        for i in range(len(w) - width + 1):
            key = tuple(w[i:i + width])
            least[key] = min(least.get(key, doc), doc)
    out = {}
    for doc, text in docs:
        w, gone = words(text), set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i:i + width])] < doc:
                gone.update(range(i, i + width))
        left = [x for i, x in enumerate(w) if i not in gone]
        out[doc] = text if not gone else " ".join(left) if left else None
    return out


def cut_leaks(docs, items, width=10):
    """doc_id to text without the benchmark's passages; None where they are all its words."""
    phrases = set()
    for _, text in items:
        w = item_words(text)
        phrases.update(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1) if w else 0))
    lengths, out = {len(p) for p in phrases}, {}
    for doc, text in docs:
        found = list(re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text)))
        w, hit = [m.group() for m in found], set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in phrases:
                    hit.update(range(i, i + n))
        if hit and len(hit) == len(w):
            out[doc] = None
            continue
        parts, last = [], 0
        for i in sorted(hit):
            if i - 1 not in hit:
                parts.append(text[last:found[i].start()])
            last = found[i].end()
        out[doc] = "".join([*parts, text[last:]]) if hit else text
    return out


def mix(docs, weights=(5.0, 2.0, 1.0), epochs=3, seed=17):
    """doc_id to (size, source_size, target, repeats, taken) from (doc_id, text, source); shares over a limit are cut and
    shared again until none is over."""
    by_source = defaultdict(list)
    for doc, text, source in docs:
        by_source[(source is None, source or "")].append((hashlib.md5(f"{seed}:{doc}".encode()).hexdigest(), len(words(text)), doc))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sorted(by_source))}
    size = {s: sum(n for _, n, _ in rows) for s, rows in by_source.items()}
    full = {s for s in size if not size[s]}
    while True:
        rest = sum(size.values()) - sum(epochs * size[s] for s in full)
        level = rest / sum(w for s, w in weight.items() if s not in full) if len(full) < len(size) else 0
        over = {s for s in size if s not in full and level * weight[s] > epochs * size[s]}
        if not over:
            break
        full |= over
    out = {}
    for s, rows in by_source.items():
        target = epochs * size[s] if s in full else level * weight[s]
        repeats = floor(target / size[s]) if size[s] else 0
        extra = floor(target + 0.5) - repeats * size[s]
        for _, n, doc in sorted(rows):
            more = max(0, min(n, extra))
            extra -= n
            out[doc] = (n, size[s], target, repeats, repeats * n + more)
    return out


def pipeline(docs, items):
    """The rows of the pipeline from those (doc_id, text, lang, source, n_chars) its first stage keeps; ids are unique."""
    first = {d: c for d, (_, c) in classes([r[:2] for r in docs], 5, 80).items()}
    docs = [r for r in docs if first[r[0]] == r[0]]
    for cut in (cut_repeats, lambda x: cut_leaks(x, items)):
        left = cut([r[:2] for r in docs])
        docs = [(d, left[d], lang, source, None if n is None or left[d] is None else len(left[d]))
                for d, text, lang, source, n in docs if text is None or left[d] is not None]
    taken = mix([(d, text, source) for d, text, _, source, _ in docs])
    return [(*r, *taken[r[0]]) for r in docs]

"""Brute-force versions of the operators, for small inputs."""

import collections
import hashlib
import math
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def base_quality(text):
    w = words(text)
    n = len(w)
    seen = collections.Counter(tuple(w[i:i + 8]) for i in range(n - 7))
    inside = set()
    for i in range(n - 7):
        if seen[tuple(w[i:i + 8])] > 1:
            inside |= set(range(i, i + 8))
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in lines
            lines.add(line)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def exact_groups(rows):
    """(doc_id, text) -> per row (doc_id, keep_id, size, sha)."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    least = {g: min((i for i in v if i is not None), default=None) for g, v in groups.items()}
    return [(i, least[normal(t)], len(groups[normal(t)]), sha(normal(t))) for i, t in rows]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    w = words(lower(text))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def jaccard_components(rows):
    """doc_id -> (set size, least doc_id reachable), by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets}


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if (kind == "ip" and any(int(p.lstrip("0")[:5] or 0) > 255 for p in m.group().split("."))
                    or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                    or kind == "phone" and not 10 <= len(digits) <= 15):
                continue
            out.append((m.start(), k, m.end(), kind))
    return ",".join(f"{kind}:{a}:{e}" for a, _, e, kind in sorted(out))


def targets(sizes, weights=(5, 2, 1), budget=1.5, most=2.0):
    """source -> target, by filling in rounds."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), budget * sum(sizes.values())
    while open_:
        level = left / sum(w[s] for s in open_)
        full = {s for s in open_ if level * w[s] > most * sizes[s]}
        if not full:
            return out | {s: level * w[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


CANDIDATE = re.compile(r"[A-Za-z0-9][A-Za-z0-9@._%+()/:-]{4,}(?<=[A-Za-z0-9])")


def _shape(hit):
    flat = "".join("9" if c in "0123456789" else "A" if c.isupper() else "a" if c.isalpha() else c for c in hit)
    return re.sub(r"(a)\1{3,}", "a+", flat)


def found_identifiers(rows, least=5, pattern_trust=0.5, trust=0.8):
    """(doc_id, text) of short words -> per row the spans that bootstrapping adds, by comparing everything with everything."""
    seen, edges, seeds = [], collections.defaultdict(set), set()

    def learn(text, m, before):
        w = [x.lower() for x in words(text[before:m.start()])][-2:]
        for p in (*([f"2:{w[0]} {w[1]}"] if len(w) == 2 else []), *([f"1:{w[-1]}"] if w else []), "s:" + _shape(m.group())):
            edges[p].add(m.group())
    for _, text in rows:
        text = text or ""
        base = [(k, int(a), int(e)) for k, a, e in (x.split(":") for x in base_spans(text).split(",") if x)]
        for kind, pattern in (("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE)):
            for m, before in _with_context(pattern, text):
                if (kind, m.start(), m.end()) in base:
                    seeds.add(m.group())
                    learn(text, m, before)
        mine = []
        for m, before in _with_context(CANDIDATE, text):
            if sum(c in "0123456789" for c in m.group()) >= 4 and not any(a < m.end() and m.start() < e for _, a, e in base):
                mine.append((m.start(), m.end(), m.group()))
                learn(text, m, before)
        seen.append(mine)
    weight = dict.fromkeys(seeds, 1.0)
    while True:
        conf = {}
        for p, insts in edges.items():
            known = sum(weight.get(i, 0) for i in insts)
            if known >= least:
                c = known / len(insts) * (1 - 1 / math.log2(known + 1) / 4)
                if c >= pattern_trust:
                    conf[p] = c
        new = dict(weight)
        for i in {i for p in conf for i in edges[p]}:
            s = 1 - math.prod(1 - min(conf[p], 0.99) for p in conf if i in edges[p])
            if s >= trust:
                new[i] = max(new.get(i, 0), s)
        if sum(new.values()) - sum(weight.values()) <= 1e-6:
            return [[(a, e) for a, e, i in mine if weight.get(i, 0) >= trust and i not in seeds] for mine in seen]
        weight = new


def _with_context(pattern, text):
    """Matches, each with the start of the second match before it."""
    starts = []
    for m in pattern.finditer(text):
        yield m, starts[-2] if len(starts) > 1 else 0
        starts.append(m.start())


def toxic_terms(sample, edge, least_seen=8, most_clean=0.02):
    """Term -> neighbourhoods, by counting every start of every word as text. ``sample``: (toxic, text); ``edge``: a word without signs."""
    seen, clean = collections.defaultdict(set), collections.Counter()
    for toxic, text in sample:
        w = [x for x in (edge(x) for x in (text or "").split()) if x]
        mine = set()
        for i, x in enumerate(w):
            if len(x) >= 3:
                near = (w[i - 1] if i else "", w[i + 1] if i + 1 < len(w) else "")
                mine |= {(x[:k], near) for k in range(3, len(x) + 1)} | {(x + " ", near)}
        if toxic:
            for t, near in mine:
                seen[t].add(near)
        else:
            clean.update({t for t, _ in mine})
    kept = {t: len(v) for t, v in seen.items() if len(v) >= least_seen and clean[t] <= len(v) * most_clean}
    out = {}
    for t in sorted(kept, key=lambda t: (len(t), t)):
        if any(t.startswith(o.rstrip()) for o in out):
            continue
        best = t
        while not best.endswith(" "):
            longer = sorted((u for u in kept if len(u) == len(best) + 1 and u.startswith(best)), key=lambda u: (-kept[u], u))
            if not longer or kept[longer[0]] < 0.9 * kept[t]:
                break
            best = longer[0]
        out[best] = kept[best]
    return out


def one_edit(a, b):
    """Whether a becomes b by one edit; a letter more before b is none."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) == len(b) + 1:
        return any(a[:i] + a[i + 1:] == b for i in range(1, len(a))) or a[1:] == b and a[0] == b[0]
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def term_hit(word, terms):
    """2: a term as it is, 1: a term of five letters or more with one edit, 0: none."""
    if any(word == t[:-1] if t.endswith(" ") else word.startswith(t) for t in terms):
        return 2
    return int(any(len(t.rstrip()) >= 5 and one_edit(word, t.rstrip()) for t in terms))

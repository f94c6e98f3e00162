"""Plain Python versions of the operators' contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NORM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def base_spans(text):
    t, out = text or "", []
    assign = re.compile(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                        r"([A-Za-z0-9+/_.=-]+)", re.ASCII)
    out += [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def secrets_row(text):
    s, kinds = base_spans(text), ["assign", "access", "hex"]
    n = Counter(k for _, k, _ in s)
    return n[0], n[1], n[2], sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in s))


def quality_row(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    wins = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, hit = Counter(wins), set()
    for i, x in enumerate(wins):
        if n[x] > 1:
            hit.update(range(i, i + 5))
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len(hit), failed)


def decontam_rows(docs, items):
    wins = defaultdict(set)
    for i, t in items:
        w = NORM.findall((t or "").translate(AZ))
        m = min(len(w), 10)
        for k in range(len(w) - m + 1 if m else 0):
            wins[tuple(w[k:k + m])].add(str(i))
    lens = {len(x) for x in wins}
    out = []
    for d, t in docs:
        w, hit, found = NORM.findall((t or "").translate(AZ)), set(), set()
        for m in lens:
            for k in range(len(w) - m + 1):
                if (x := tuple(w[k:k + m])) in wins:
                    hit.update(range(k, k + m))
                    found |= wins[x]
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow",
         "com/de/": "block"}


def url_row(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host):])[0]
    host = host.translate(AZ)
    fit = [r for r in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
           and path.startswith(r[r.index("/"):])]
    return host, path, max(fit, key=len, default=None)


def targets(sizes, share=1.5, cap=2):
    """{source: target} by resharing the excess until none is above."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = float(cap * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def shingles(text, n=5):
    w = WORD.findall((text or "").translate(AZ))
    if not w:
        return set()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or {tuple(w)}


def near_components(docs):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in docs]
    by, parent = defaultdict(set), {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, s) in enumerate(sets):
        for x in s:
            by[x].add(i)
    for i, (d, s) in enumerate(sets):
        common = Counter(j for x in s for j in by[x] if j > i)
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j][1]) - c):
                a, b = root(d), root(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return [(d, len(s), root(d)) for d, s in sets]


def repeats(docs, n=50):
    """[(doc_id, n_bytes, n_removed, n_spans, kept_sha256)]: bytes in n-byte strings of smaller docs."""
    first, out = {}, []
    data = sorted((d, (t or "").encode()) for d, t in docs)
    for d, b in data:
        for i in range(len(b) - n + 1):
            first.setdefault(b[i:i + n], d)
    for d, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def repeated_windows(docs, n=35):
    """[(doc_id, n_words, n_removed, kept_sha256)]: words in n-word windows that start anywhere else."""
    words = [WORD.findall(t or "") for _, t in docs]
    many = Counter(tuple(w[i:i + n]) for w in words for i in range(len(w) - n + 1))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = {j for i in range(len(w) - n + 1) if many[tuple(w[i:i + n])] > 1 for j in range(i, i + n)}
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def divergence(docs, min_docs=30, top=50):
    """[(lang, source, part, item, value, rank)] of rows (text, lang, source)."""
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    groups, held = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        words = term.findall((text or "").translate(AZ))
        groups[lang or "", source or ""].update(words)
        held[lang or ""].update(set(words))
    kept = {lang: [w for w, k in c.items() if k >= min_docs] for lang, c in held.items()}

    def share(c, lang):
        total = sum(c[w] for w in kept[lang]) + 5 * len(kept[lang])
        return {w: 1 + 1000000000 * (c[w] + 5) // total for w in kept[lang]}

    whole = {lang: share(sum((c for (x, _), c in groups.items() if x == lang), Counter()), lang) for lang in held}
    p, out = {g: share(c, g[0]) for g, c in groups.items()}, []
    for g, own in p.items():
        pairs = [(sum(abs(own[w] - q[w]) for w in own), h[1]) for h, q in p.items() if h[0] == g[0] and h != g]
        terms = [(v - whole[g[0]][w], w) for w, v in own.items() if groups[g][w] and v > whole[g[0]][w]]
        for part, rows in (("pair", pairs), ("term", terms)):
            rows = sorted(rows, key=lambda r: (-r[0], r[1].encode()))[:None if part == "pair" else top]
            out += [(*g, part, item, v, k + 1) for k, (v, item) in enumerate(rows)]
    return out


def prefix_trie(rows):
    """[(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)] of (conv, turn, role, text)."""
    conv = defaultdict(list)
    for c, k, r, t in rows:
        if c is not None:
            r, t = r or "", t or ""
            name = hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
            conv[c].append((k is not None, k or 0, name, r, t))
    conv, new = {c: [x[3:] for x in sorted(v)] for c, v in conv.items()}, {}
    for c, v in conv.items():
        h, first = zlib.crc32(str(c).encode()) % 4, c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        new[c] = conv.get(first, [])[:h] + v[h:]
    members, kids, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, v in sorted(new.items()):
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids.update(x[:-1] for x in members if x)
    for x, m in members.items():
        for d in range(len(x) + 1):
            saved[x[:d]] += (len(m) - 1) * len(WORD.findall(x[-1][1])) if x else 0
            leaves[x[:d]] += not kids[x]
    return [(m[0], len(x), members[x[:-1]][0] if x else None, len(m), kids[x], leaves[x], saved[x],
             sha(",".join(str(c) for c in m if len(new[c]) == len(x)))) for x, m in members.items()]

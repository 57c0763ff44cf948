"""Plain Python versions of the operators' contracts, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held_out(doc_id):
    return True if doc_id is None else zlib.crc32(str(doc_id).encode()) % 5 == 0


def roots(nodes, edges):
    """Least node reachable."""
    up = {x: x for x in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def jaccard_components(docs):
    """[(doc_id, text)] -> {doc_id: (n, component)}"""
    sets = {d: shingles(t) for d, t in docs}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    common = Counter()
    for ids in by.values():
        ids = sorted(ids)
        for i, a in enumerate(ids):
            for b in ids[i + 1:]:
                common[a, b] += 1
    edges = [(a, b) for (a, b), k in common.items() if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k)]
    root = roots(sets, edges)
    return {d: (len(s), root[d]) for d, s in sets.items()}


def substring_dedup(docs, window=35):
    """[(doc_id, text)] -> [(doc_id, n_words, n_removed, sha)]"""
    words = [WORD.findall(t or "") for _, t in docs]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(docs, items, window=13):
    phrases = defaultdict(set)
    for i, t in items:
        w = TERM.findall((t or "").translate(LOWER))
        if w:
            for a in range(max(1, len(w) - window + 1)):
                phrases[tuple(w[a:a + window])].add(i)
    sizes = {len(p) for p in phrases}
    out = []
    for d, t in docs:
        w = TERM.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                p = tuple(w[a:a + n])
                if p in phrases:
                    hit.update(range(a, a + n))
                    found |= phrases[p]
        names = ",".join(sorted(str(x) for x in found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def targets(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2):
    """{source: size} -> {source: target}"""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, list(names), share * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > most * sizes[s]]
        if not over:
            target.update({s: weight[s] * level for s in free})
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= most * sizes[s]
            free.remove(s)
    return target


SECRET = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in SECRET.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def cosine_links(rows, least=0.98):
    """[(vec_id, vector, label)] with distinct ids -> {vec_id: (n_links, component)}"""
    def ok(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    good = [(i, v, x) for i, v, x in rows if ok(v, x)]
    edges = []
    for a, (i, v, x) in enumerate(good):
        for j, u, y in good[a + 1:]:
            if x == y and len(u) == len(v):
                c = math.fsum(p * q for p, q in zip(u, v, strict=True)) / math.sqrt(math.fsum(p * p for p in u)) / math.sqrt(math.fsum(p * p for p in v))
                if c >= least:
                    edges.append((i, j))
    links = Counter(x for e in edges for x in e)
    root = roots([i for i, _, _ in rows], edges)
    return {i: (links[i], root[i]) for i in root}


RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def url_parts(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (m[1].translate(LOWER), m[2]) if m else ("", "")


def url_rule(host, path):
    fit = [r for r, _ in RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
    return max(fit, key=len) if fit else None


def url_filter(ids, urls, html):
    """(id, host, path, rule, verdict, words, score) of each page: the plain model over all rows."""
    million = 1_000_000
    pieces = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")
    words = Counter(w for h in html for w in re.findall(r"[a-z]{2,}", re.sub(r"<[^>]*>", " ", h or "").translate(LOWER)))
    total = sum(words.values()) + 1

    def cost(w):
        return round(million * math.log(words[w] / total)) if w in words else round(million * math.log(1 / total)) - round(million * 2.5) * len(w)

    def split(run):
        best, back = [0], [0]
        for e in range(1, len(run) + 1):
            value, start = max((best[a] + cost(run[a:e]), -a) for a in range(e))
            best.append(value)
            back.append(-start)
        out, e = [], len(run)
        while e:
            out.append(run[back[e]:e])
            e = back[e]
        return out[::-1]

    def host_words(host):
        return [w for p in pieces.findall(host) for w in (split(p) if "a" <= p[0] <= "z" else ["#"] if p[0].isascii() else [p])]

    def path_words(path):
        return ["#" if p[0] in "0123456789" else p for p in pieces.findall(path.translate(LOWER))]

    cut = {}
    rows = []
    for i, u in zip(ids, urls, strict=True):
        host, path = url_parts(u)
        cut.setdefault(host, host_words(host))
        rows.append((i, host, path, url_rule(host, path)))
    rules = dict(RULES)
    tokens = [["h:" + w for w in cut[host]] + ["p:" + w for w in path_words(path)] for _, host, path, _ in rows]
    seen = {v: Counter(t for r, ts in zip(rows, tokens, strict=True) if rules.get(r[3]) == v for t in ts) for v in ("allow", "block")}
    pages = Counter(rules[r[3]] for r in rows if r[3])
    every = set(seen["allow"]) | set(seen["block"])
    size = {v: sum(seen[v].values()) + max(len(every), 1) for v in seen}
    weight = {t: round(million * (math.log((seen["block"][t] + 1) / size["block"]) - math.log((seen["allow"][t] + 1) / size["allow"]))) for t in every}
    prior = round(million * (math.log(pages["block"] + 1) - math.log(pages["allow"] + 1)))
    out = []
    for r, ts in zip(rows, tokens, strict=True):
        score = prior + sum(weight.get(t, 0) for t in ts)
        out.append((*r, rules.get(r[3]) or ("block" if score > 0 else "allow"), " ".join(cut[r[1]]), score / million))
    return out

"""Plain-Python versions of the contracts, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(wins)
    rep = {i + k for i, x in enumerate(wins) if c[x] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w))


def shingles(text):
    w = WORD.findall(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows, percent=85):
    """{doc_id: smallest reachable}"""
    parent = {d: d for d, _ in rows}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t)) for d, t in rows]
    by = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(k)
    pairs = Counter()
    for ks in by.values():
        for i in ks:
            for j in ks:
                if i < j:
                    pairs[i, j] += 1
    for (i, j), n in pairs.items():
        if 100 * n >= percent * (len(sets[i][1]) + len(sets[j][1]) - n):
            a, b = top(sets[i][0]), top(sets[j][0])
            parent[max(a, b)] = min(a, b)
    return {d: top(d) for d, _ in rows}, {d: len(s) for d, s in sets}


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    out.sort()
    s = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in out)
    n = Counter(k for _, k, _ in out)
    return n[0], n[1], n[2], hashlib.sha256(s.encode()).hexdigest()


#: The method's fixed values: inferred encodings, their alphabets, chi-squared's noncentrality per symbol.
CODES = [("[0-9a-f]+", "0123456789abcdef", 0.6), ("[0-9A-F]+", "0123456789ABCDEF", 0.6), ("[A-Z2-7]+=*", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1), ("[a-z]+", "abcdefghijklmnopqrstuvwxyz", 0.73), ("[a-z0-9]+", "abcdefghijklmnopqrstuvwxyz0123456789", 1.4), (".*", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 3.2)]


def random_p(m):
    """The p value of one candidate, test by test."""
    import math

    def tail(x):
        upper = math.exp(-x * x / 2) / (1.64 * abs(x) + math.sqrt(0.76 * x * x + 4))
        return upper if x >= 0 else 1 - upper

    alphabet, delta = next((a, d) for p, a, d in CODES if re.fullmatch(p, m))
    v = [alphabet.index(c) for c in m.rstrip("=").replace("-", "+").replace("_", "/") if c in alphabet]
    n, k = len(v), len(alphabet)
    mean = sum(v) / n
    var = sum((x - mean) ** 2 for x in v)
    if var <= 0:
        return 1.0
    chi = sum((c - n / k) ** 2 / (n / k) for c in (v.count(x) for x in range(k)))
    side = [x >= k / 2 for x in v]
    runs, high = 1 + sum(a != b for a, b in zip(side, side[1:])), sum(side)
    two = 2 * high * (n - high)
    z_runs = (runs - two / n - 1) / math.sqrt(max(two * (two - n) / (n * n * (n - 1)), 1e-9))
    z_serial = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:])) / var * math.sqrt(n)
    if min(2 * tail(abs(z_runs)), 2 * tail(abs(z_serial)), tail((chi - k + 1) / math.sqrt(2 * (k - 1)))) < 0.001 / 3:
        return 1.0
    return min(1.0, tail(-(chi - (k - 1) - n * delta) / math.sqrt(2 * (k - 1) + 4 * n * delta)))


def all_secrets(texts, rate=0.01):
    """Spans of each text as the query returns them: base rules, and candidates that Benjamini-Hochberg accepts in their length band."""
    import math

    names, base, more = ("assign", "access", "hex", "random"), [], []
    for t in texts:
        t = t or ""
        own = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        own += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        own += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        found = [m for m in re.finditer("[A-Za-z0-9+/_=-]+", t) if len(m[0]) >= 20]
        base.append(own)
        more.append([(m.start(), 3, m.end(), min(400, math.floor(-10 * math.log10(max(random_p(m[0]), 1e-300))))) for m in found if not any(a < m.end() and m.start() < b for a, _, b in own)])
    bands = defaultdict(list)
    for found in more:
        for a, _, b, k in found:
            bands[int(math.log2(b - a))].append(k)
    limit = {}
    for band, ks in bands.items():
        good = [k for k in set(ks) if len(ks) * 10.0 ** (-k / 10) <= rate * sum(x >= k for x in ks)]
        limit[band] = min(good, default=1000)
    out = []
    for own, found in zip(base, more):
        every = sorted(own + [(a, 3, b) for a, _, b, k in found if k >= limit[int(math.log2(b - a))]])
        out.append(",".join(f"{names[k]}:{a}:{b}" for a, k, b in every))
    return out


def targets(sizes, weights=(5, 2, 1), percent=150, most=2):
    """{source: target}; sizes: {source or None: words}"""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()) * percent / 100, set()
    while True:
        rest, weight = total - sum(most * sizes[s] for s in held), sum(w[s] for s in order if s not in held)
        over = {s for s in order if s not in held and w[s] * rest / weight >= most * sizes[s]} if weight else set()
        if not over:
            return {s: float(most * sizes[s]) if s in held else w[s] * rest / weight for s in order}
        held |= over


def removed(rows, k=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} for distinct ids"""
    first = {}
    for d, t in sorted(rows):
        b = (t or "").encode()
        for i in range(len(b) - k + 1):
            first.setdefault(b[i : i + k], d)
    out = {}
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b) + 1)
        for i in range(len(b) - k + 1):
            if first[b[i : i + k]] < d:
                gone[i : i + k] = b"\1" * k
        out[d] = (len(b), sum(gone), sum(gone[i] and not gone[i + 1] for i in range(len(b))), hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest())
    return out


BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits(text, items, size=10):
    """(n_words, n_hit, n_items, sha, contaminated); items: [(id, text)]"""
    w = BENCH.findall(lower(text))
    hit, ids = set(), set()
    for item, t in items:
        q = BENCH.findall(lower(t))
        for i in range(max(1, len(q) - size + 1) if q else 0):
            p = q[i : i + size]
            for a in range(len(w) - len(p) + 1):
                if w[a : a + len(p)] == p:
                    hit.update(range(a, a + len(p)))
                    ids |= {str(item)} - {"None"}
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def language_model(rows):
    """[(held_out, n_tokens, n_known, N, base_score, score)] of each row; EM sees every held-out token by itself."""
    import math
    import zlib

    crc = lambda s: zlib.crc32(s.encode())
    docs = []
    for d, t in rows:
        role = 0 if d is None or crc(str(d)) % 5 == 1 else 2 if crc(f"em{d}") % 10 == 0 else 1
        docs.append((d is not None and crc(str(d)) % 5 == 1, role, WORD.findall(lower(t)) + ["\n"]))

    def counts(roles):
        one, two = Counter(), Counter()
        for _, role, ws in docs:
            if role in roles:
                one.update(ws)
                two.update(zip(["\r", *ws], ws))
        return one, two

    def estimates(one, two, n, v, ws):
        for a, w in zip(["\r", *ws], ws):
            context = one["\n"] if a == "\r" else one[a]
            yield min(39, int(math.log2(context + 1))), (two[a, w] / max(context, 1), one[w] / max(n, 1), 1 / (v + 1))

    every, pairs = counts((1, 2))
    n, v = sum(every.values()), len(every)
    one, two = counts((1,))
    seen = defaultdict(list)
    for _, role, ws in docs:
        if role == 2:
            for k, p in estimates(one, two, sum(one.values()), v, ws):
                seen[k].append(p)

    def em(tokens, start, prior):
        lam = start
        for _ in range(60):
            add = [prior * x for x in start]
            for p in tokens:
                share = [x * y for x, y in zip(p, lam)]
                for i in range(3):
                    add[i] += share[i] / sum(share)
            lam = [x / sum(add) for x in add]
        return lam

    weights = {k: [0.3, 0.65, 0.05] for k in range(40)}
    if seen:
        pooled = [max(x, 1e-6) for x in em([p for k in sorted(seen) for p in seen[k]], [0.3, 0.65, 0.05], 0.0)]
        pooled = [x / sum(pooled) for x in pooled]
        weights = {k: [max(x, 1e-9) for x in em(seen[k], pooled, 20.0)] for k in range(40)}
    weights[0][0] = 0.0
    weights = {k: [x / sum(w) for x in w] for k, w in weights.items()}
    out = []
    for held, _, ws in docs:
        score = sum(math.log10(sum(x * y for x, y in zip(weights[k], p))) for k, p in estimates(every, pairs, n, v, ws))
        out.append((held, len(ws), sum(every[w] > 0 for w in ws), n, sum(math.log10((every[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), score))
    return out


def solve(a, b):
    """x of a x = b (several right sides), by elimination with pivots."""
    n = len(a)
    m = [list(r) + list(s) for r, s in zip(a, b)]
    for i in range(n):
        p = max(range(i, n), key=lambda k: abs(m[k][i]))
        m[i], m[p] = m[p], m[i]
        for k in range(i + 1, n):
            if f := m[k][i] / m[i][i]:
                for j in range(i, len(m[i])):
                    m[k][j] -= f * m[i][j]
    for i in reversed(range(n)):
        for j in range(n, len(m[i])):
            m[i][j] = (m[i][j] - sum(m[i][k] * m[k][j] for k in range(i + 1, n))) / m[i][i]
    return [r[n:] for r in m]


def toxicity_scores(rows, labels):
    """{doc_id: score} for distinct ids, at most PER_CLASS labels of each class; labels: {doc_id: 0 or 1}."""
    import math
    import zlib

    crc = lambda s: zlib.crc32(s.encode())
    top = 1 << 64

    def slots(t):
        c, found = [ord(x) for x in lower(t)], set()
        for n in (4, 5, 6):
            for i in range(len(c) - n + 1):
                code = 0
                for x in c[i : i + n]:
                    code = (code * 0xC2B2AE3D27D4EB4F + x) % top
                found.add((code + n) * 0x9E3779B97F4A7C15 % top >> 44)
        return found

    known = {d: y for d, y in labels.items() if crc(str(d)) % 5 != 0}
    share = sum(known.values()) / len(known)
    sets = {d: slots(t) for d, t in rows}
    aside = {d for d in known if crc(f"aside{d}") % 4 == 3}
    assert min(sum(known[d] == c for d in aside) for c in (0, 1)) >= 5
    train = [d for d in known if d not in aside]
    n = [sum(known[d] == c for d in train) for c in (0, 1)]
    count = [Counter(s for d in train if known[d] == c for s in sets[d]) for c in (0, 1)]
    ratio = {}
    for s in count[0] | count[1]:
        if count[0][s] + count[1][s] >= 4:
            v = math.log((count[1][s] + 1) / (n[1] + 2)) - math.log((count[0][s] + 1) / (n[0] + 2))
            if v:
                ratio[s] = v
    texts = [sorted(sets[d] & ratio.keys()) for d in train]
    size = sum(math.sqrt(max(1, sum(ratio[s] ** 2 for s in t))) for t in texts) / len(texts)
    w, b = dict.fromkeys(ratio, 0.0), 0.0
    mw, vw, mb, vb = dict.fromkeys(ratio, 0.0), dict.fromkeys(ratio, 0.0), 0.0, 0.0
    logistic = lambda z: 1 / (1 + math.exp(-max(-500, min(500, z))))
    for step in range(1, 151):
        g = [(logistic(sum(w[s] * ratio[s] / size for s in t) + b) - known[d]) / len(train) for d, t in zip(train, texts)]
        gw = {s: 1 / len(train) * x / 100 for s, x in w.items()}
        for x, t in zip(g, texts):
            for s in t:
                gw[s] += x * ratio[s] / size
        k = 0.05 * math.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        for s, x in gw.items():
            mw[s] = 0.9 * mw[s] + 0.1 * x
            vw[s] = 0.99 * vw[s] + 0.01 * x * x
            w[s] -= k * mw[s] / (math.sqrt(vw[s]) + 1e-8)
        mb, vb = 0.9 * mb + 0.1 * sum(g), 0.99 * vb + 0.01 * sum(g) ** 2
        b -= k * mb / (math.sqrt(vb) + 1e-8)
    z = {d: sum(w[s] * ratio[s] / size for s in sets[d] & ratio.keys()) + b for d, _ in rows}
    held = sorted(aside)
    ones = sum(known[d] for d in held)
    zeros = len(held) - ones
    mean = sum(z[d] for d in held) / len(held)
    spread = max(1e-9, math.sqrt(sum((z[d] - mean) ** 2 for d in held) / len(held)))
    t = [1.0, 0.0]
    for _ in range(100):
        h, g = [[1e-3, 0.0], [0.0, 1e-3]], [1e-3 * t[0], 1e-3 * t[1]]
        for d in held:
            x = (z[d] / spread, 1.0)
            q = logistic(x[0] * t[0] + t[1])
            weight = (3.0 * share / ones if known[d] else (1 - share) / zeros) * len(held)
            target = (ones + 1) / (ones + 2) if known[d] else 1 / (zeros + 2)
            for i in (0, 1):
                g[i] += x[i] * weight * (q - target)
                for j in (0, 1):
                    h[i][j] += x[i] * x[j] * weight * q * (1 - q)
        move = [r[0] for r in solve(h, [[g[0]], [g[1]]])]
        most = max(map(abs, move))
        t = [a - m / max(1.0, most) for a, m in zip(t, move)]
        if most < 1e-9:
            break
    return {d: logistic(z[d] * t[0] / spread + t[1]) for d in z}


def languages(rows, landmarks):
    """{doc_id: (language, score)} for distinct ids; rows: (doc_id, text, lang), all of them in the sample if their fold is."""
    import math
    import zlib

    factor = {2: 0x9E3779B97F4A7C15, 3: 0xC2B2AE3D27D4EB4F, 4: 0x165667B19E3779F9}

    def slots(t):
        c = lower(t).encode()
        return {int.from_bytes(c[i : i + n]) * f % (1 << 64) >> 48 for n, f in factor.items() for i in range(len(c) - n + 1)}

    sets = {d: slots(t) for d, t, _ in rows}
    lang = {d: k for d, t, k in rows if k is not None and t is not None and zlib.crc32(str(d).encode()) % 3 != 1}
    order = sorted(lang, key=lambda d: d * 0x9E3779B97F4A7C15 % (1 << 64))
    names = sorted(set(lang.values()))
    norm = {d: math.sqrt(max(1, len(s))) for d, s in sets.items()}
    kernel = lambda a, b: len(sets[a] & sets[b]) / (norm[a] * norm[b])
    marks = [d for k in names for d in [x for x in order if lang[x] == k][: max(1, landmarks // len(names))]]
    balance = {d: len(order) / (len(names) * sum(x == lang[d] for x in lang.values())) for d in order}
    k = {d: [kernel(d, m) for m in marks] for d in order}
    left = [[sum(balance[d] * k[d][i] * k[d][j] for d in order) + kernel(marks[i], marks[j]) + (1e-6 if i == j else 0) for j in range(len(marks))] for i in range(len(marks))]
    right = [[sum(balance[d] * k[d][i] for d in order if lang[d] == x) for x in names] for i in range(len(marks))]
    dual = solve(left, right)
    out = {}
    for d, t, _ in rows:
        s = [sum(kernel(d, m) * a[j] for m, a in zip(marks, dual)) for j in range(len(names))]
        best = max(range(len(names)), key=lambda j: (s[j], -j))
        out[d] = (names[best], min(1.0, max(0.0, s[best]))) if any(map(str.isalpha, t or "")) else ("und", 0.0)
    return out

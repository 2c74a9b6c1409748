"""Plain versions of what the operators return, for small tables."""

from __future__ import annotations

import collections
import hashlib
import itertools
import re
import zlib

URL_RULES = ["allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/"]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def alnum_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.match(r"[^?#]*", url.split("://", 1)[1], re.S)[0]
    host = rest.split("/", 1)[0]
    return lower(host), rest[len(host):]


def url_rule(host, path):
    found = []
    for rule in URL_RULES:
        verdict, _, pattern = rule.partition(" ")
        h, _, p = pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            found.append((len(pattern), pattern, verdict))
    return max(found, default=(0, None, None))[1:]


def text_counts(text):
    w = words(text)
    text = text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, inside = collections.Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            inside.update(range(i, i + 5))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(w), sum(map(len, w)), symbols, dup, len(inside)


def hit_items(docs, items):
    """docs, items: pairs of id and text; per document words, hit words and the ids of its items."""
    windows = collections.defaultdict(set)
    for i, text in items:
        w = alnum_words(text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1) if n else ():
            windows[tuple(w[k : k + n])].add(i)
    sizes = {len(x) for x in windows}
    out = []
    for d, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (got := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= got
        ids = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def mix_targets(sizes):
    """sizes: size per source; the target of each."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.discard(s)
    return target


def removed_bytes(docs):
    """docs: pairs of id and text. Flags per document of the bytes inside a 50-byte string of a smaller id."""
    first = {}
    for d, text in docs:
        b = (text or "").encode()
        for i in range(len(b) - 49):
            if d is not None:
                s = b[i : i + 50]
                first[s] = min(d, first.get(s, d))
    out = []
    for d, text in docs:
        b = (text or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if d is not None and first[b[i : i + 50]] < d:
                gone[i : i + 50] = [True] * 50
        runs = sum(1 for flag, _ in itertools.groupby(gone) if flag)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text):
    w = words(lower(text))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(docs):
    """docs: pairs of id and text; per document the size of its set and the smallest linked id."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, (_, a)), (j, (_, b)) in itertools.combinations(enumerate(sets), 2):
        if a and b and 100 * (shared := len(a & b)) >= 75 * (len(a) + len(b) - shared):
            parent[root(i)] = root(j)
    least = collections.defaultdict(list)
    for i, (d, _) in enumerate(sets):
        least[root(i)].append(d)
    return [(d, len(s), min(least[root(i)], key=lambda x: (x is None, x))) for i, (d, s) in enumerate(sets)]


def planted_words(doc_id, text):
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def runs(w, exponent=4, least=6):
    """(start, length, period) of the runs, by trying every distance at every place."""
    found = {}
    for p in range(1, len(w) // exponent + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(exponent * p, least):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted((start, length, p) for (start, length), p in found.items())


def collapsed(w, found):
    gone = {i for start, length, p in found for i in range(start + p, start + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def line_key(line):
    return lower(line.strip("\x20\x09\x0a\x0b\x0c\x0d"))


def dedup_lines(docs, least=20, documents=3):
    """docs: pairs of id and text; per row the lines, how many go, and the text that stays."""
    holders = collections.defaultdict(set)
    for d, text in docs:
        for line in (text or "").split("\n"):
            if d is not None and len(line_key(line)) >= least:
                holders[line_key(line)].add(d)
    out = []
    for d, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or len(h := holders.get(line_key(x), ())) < documents or d == max(h)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def divergences(docs, min_docs=3, top=200):
    """docs: lang, source, text."""
    groups, df = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for lang, source, text in docs:
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text))
        groups[lang or "", source or ""].update(terms)
        df[lang or ""].update(set(terms))
    out = []
    for lang, seen in df.items():
        kept = [t for t, n in seen.items() if n >= min_docs]
        own = {s: c for (x, s), c in groups.items() if x == lang}
        total = collections.Counter()
        for c in own.values():
            total.update(c)
        share = lambda c, t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept))
        p = {s: {t: share(c, t) for t in kept} for s, c in own.items()}
        whole = {t: share(total, t) for t in kept}
        f = lambda x, q: (x - q) ** 2 // q
        for s in own:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in own if o != s]
            terms = [(-f(p[s][t], whole[t]), t.encode()) for t in kept if own[s][t] and p[s][t] > whole[t]]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(rows)]
    return out


def posterior(votes, shares, tables):
    """Chance of the class "good" by Bayes' rule; votes by rule, 1, 0, -1 or None."""
    chance = {}
    for c, share in shares.items():
        chance[c] = share
        for rule, vote in votes.items():
            if vote is not None:
                chance[c] *= tables[c][rule][1 - vote]
    return chance["good"] / sum(chance.values())

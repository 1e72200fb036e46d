"""Plain restatements of the operators' contracts, for small inputs."""

import hashlib
import itertools
import re


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def ascii_lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes(docs):
    """{row number: (doc_id, n_shingles, component_id)} by looking at every pair."""
    sets = [shingle_set(t) for _, t in docs]
    up = list(range(len(docs)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and docs[i][0] is not None and docs[j][0] is not None:
            if 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 100 * len(a & b) >= 80 * len(a | b):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [(d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(docs)]


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(docs, items, window=13):
    wins = {}
    for item, text in items:
        w = bench_words(text)
        if w:
            for i in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[i : i + window]), set()).add(str(item))
    sizes = {len(w) for w in wins}
    out = []
    for d, text in docs:
        w = bench_words(text)
        hit, found = set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in wins:
                    found |= wins[tuple(w[i : i + k])]
                    hit |= set(range(i, i + k))
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(docs):
    out = []
    for d, text in docs:
        text = text or ""
        a = [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        k = [m.span() for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        h = [m.span() for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        spans = sorted([(s, 0, e) for s, e in a] + [(s, 1, e) for s, e in k] + [(s, 2, e) for s, e in h])
        out.append((d, len(a), len(k), len(h), sha(",".join(f"{('assign', 'access', 'hex')[i]}:{s}:{e}" for s, i, e in spans))))
    return out


def greedy_pieces(word, vocabulary):
    n = i = 0
    longest = max(map(len, vocabulary))
    while i < len(word):
        k = next(k for k in range(min(longest, len(word) - i), 0, -1) if word[i : i + k] in vocabulary)
        i, n = i + k, n + 1
    return n


def repeats(docs, k=100):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) in doc_id order."""
    seen, out = set(), []
    for d, text in sorted(docs, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - k + 1):
            s = raw[i : i + k]
            if s in seen:
                gone[i : i + k] = b"\1" * k
            else:
                seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def personal(docs):
    out = []
    for d, text in docs:
        text = text or ""
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        e = [m.span() for m in EMAIL.finditer(text)]
        i = [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
        c = [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
        p = [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
        named = [f"{k}:{s}:{t}" for k, v in zip(("email", "ip", "card", "phone"), (e, i, c, p), strict=True) for s, t in v]
        out.append((d, len(e), len(i), len(c), len(p), sha(",".join(named))))
    return out

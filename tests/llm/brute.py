"""Plain restatements of the operators' results for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows):
    """(doc_id, text) rows -> sorted (doc_id, keep_id, size, sha) with ids."""
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for norm, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))[0]
        out += [(i, best, len(members), sha(norm)) for i, _ in members]
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += v if i % 2 == 0 else (v * 2 - 9 if v > 4 else v * 2)
    return total % 10 == 0


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    """Counts by kind and the digest of the base spans."""
    out = {k: [] for k in PII}
    for kind, pattern in PII.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) < 256 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out[kind].append(f"{kind}:{m.start()}:{m.end()}")
    return [len(v) for v in out.values()], sha(",".join(x for v in out.values() for x in v))


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = collections.Counter(windows)
    repeat = len({j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)})
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, repeat, n < 10 or 100 * repeat > 20 * n


SECRETS = (
    ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
)


def secrets(text):
    found = sorted((m.start(), n, f"{kind}:{m.start()}:{m.end()}") for n, (kind, pattern, good) in enumerate(SECRETS)
                   for m in re.finditer(pattern, text or "") if good(m))
    counts = collections.Counter(n for _, n, _ in found)
    return [counts[0], counts[1], counts[2]], sha(",".join(s for _, _, s in found))


def unigram(rows):
    """{row number: (n_tokens, n_known, N, base_score)}."""
    tokens = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b""] for _, t in rows]
    counts = collections.Counter()
    for (i, _), words in zip(rows, tokens):
        if zlib.crc32(str(i).encode()) % 10 != 0:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [(len(w), sum(counts[x] > 0 for x in w), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
            for w in tokens]


class Tree:
    """Context-tree weighting by its recursive definition."""

    def __init__(self, depth: int, texts: list[bytes]):
        self.depth, self.counts = depth, collections.defaultdict(lambda: [0, 0])
        for context, byte in (p for t in texts for p in self.places(t)):
            for d in range(depth + 1):
                for v, bit in self.nodes(byte):
                    self.counts[context[depth - d:], v][bit] += 1
        self.children = collections.defaultdict(set)
        for context, v in self.counts:
            if context:
                self.children[context[1:], v].add(context)
        self.memo = {}

    def places(self, text: bytes):
        data = b"\0" * self.depth + text + b"\xff"
        return [(data[i:i + self.depth], data[i + self.depth]) for i in range(len(text) + 1)]

    @staticmethod
    def nodes(byte: int):
        return [((256 | byte) >> (8 - i), byte >> (7 - i) & 1) for i in range(8)]

    def kt(self, context, v):
        a, b = self.counts.get((context, v), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def whole(self, context, v):
        if (context, v) not in self.memo:
            own = self.kt(context, v)
            if len(context) < self.depth:
                below = sum(self.whole(c, v) for c in self.children.get((context, v), ()))
                own = math.log(0.5) + max(own, below) + math.log1p(math.exp(-abs(own - below)))
            self.memo[context, v] = own
        return self.memo[context, v]

    def one(self, context, v, d=0):
        own = context[self.depth - d:]
        a, b = self.counts.get((own, v), (0, 0))
        said = (b + 0.5) / (a + b + 1)
        if d == self.depth:
            return said
        weight = math.exp(math.log(0.5) + self.kt(own, v) - self.whole(own, v))
        return weight * said + (1 - weight) * self.one(context, v, d + 1)

    def score(self, text: bytes) -> float:
        return sum(math.log10(self.one(c, v) if bit else 1 - self.one(c, v))
                   for c, byte in self.places(text) for v, bit in self.nodes(byte))


def near(rows, size, percent):
    """[(n_shingles, component)] per row, by comparing all pairs of sets."""
    sets, parent = [], {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + size]) for k in range(len(w) - size + 1)) if len(w) >= size
                    else frozenset([tuple(w)] if w else []))
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y in range(x):
            both = len(sets[x] & sets[y])
            if sets[x] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                a, b = sorted((find(i), find(rows[y][0])))
                parent[b] = a
    return [(len(s), find(i)) for s, (i, _) in zip(sets, rows)]


def divergence(rows, min_docs=30, top=50):
    """(text, lang, source) rows -> sorted (lang, source, part, item, value, rank)."""
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
            for t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = collections.Counter(w for d in own for w in set(d[2]))
        kept = [w for w, n in held.items() if n >= min_docs]

        def shares(words):
            counts = collections.Counter(w for w in words if held[w] >= min_docs)
            n = sum(counts.values())
            return {w: 1 + 10 ** 9 * (counts[w] + 5) // (n + 5 * len(kept)) for w in kept}, counts

        q, _ = shares([w for d in own for w in d[2]])
        p = {s: shares([w for d in own if d[1] == s for w in d[2]]) for s in {d[1] for d in own}}
        for s in p:
            pair = [("pair", o, sum(abs(p[s][0][w] - p[o][0][w]) for w in kept)) for o in p if o != s]
            term = [("term", w, p[s][0][w] - q[w]) for w in kept if p[s][1][w] > 0 and p[s][0][w] > q[w]]
            for part, limit in ((pair, None), (term, top)):
                part.sort(key=lambda x: (-x[2], x[1].encode()))
                out += [(lang, s, *x, i + 1) for i, x in enumerate(part[:limit])]
    return sorted(out)


def middle(doc_id, text):
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def leaks(rows, items, size=10):
    """(doc_id, text) rows, (item_id, text) items -> (doc_id, n_words, n_hit, items) in order."""
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    windows = collections.defaultdict(set)
    for item, t in items:
        w = words(t)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    out = []
    for i, t in rows:
        w, hit, named = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for at in range(len(w) - n + 1):
                if own := windows.get(tuple(w[at:at + n])):
                    hit |= set(range(at, at + n))
                    named |= own
        out.append((i, len(w), len(hit), sorted(named)))
    return out

"""The operators' contracts in plain Python, for small inputs. Rows are (doc_id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

from tidemark.llm.secrets import WEAK

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def substring(rows, window=13):
    rank = lambda i: float("inf") if i is None else i
    words = [(i, SPACED.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in words:
        for k in range(len(w) - window + 1):
            run = tuple(w[k : k + window])
            first[run] = min(rank(i), first.get(run, float("inf")))
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < rank(i):
                gone.update(range(k, k + window))
        out.append((i, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone))))
    return out


def suffixes(rows, length=200):
    texts = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        reach = 0
        for k in range(len(t) - length + 1):
            if times[t[k : k + length]] > 1:
                gone[max(k, reach) : k + length] = b"\1" * (k + length - max(k, reach))
                reach = k + length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def secrets(text):
    spans = []
    for m in re.finditer(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m[1]) >= 12:
            spans.append((m.start(), 0, "assign", m.end()))
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 16]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans))


def credential_links(text, scope=200):
    """Spans as (start, rank, kind, end): the weak ones with a part that completes them, and all (span, part)."""
    strong = [(int(s), ("assign", "access", "hex").index(k), k, int(e)) for k, s, e in (x.split(":") for x in secrets(text).split(",") if x)]
    weak = []
    for rank, (kind, regex, _, least, _) in enumerate(WEAK, 3):
        for m in re.finditer(regex, text or "", re.A):
            if len(m[0]) >= least and not any(s <= m.start() < e for s, _, _, e in strong):
                weak.append((m.start(), rank, kind, m.end()))
    role = lambda span: ("secret", "id", "secret", "id", "secret", "endpoint")[span[1]]
    links = []
    for span in strong + weak:
        for wanted in ("id", "endpoint") if role(span) == "secret" else ("secret",):
            near = min(((abs(p[0] - span[0]), p) for p in strong + weak if role(p) == wanted), default=None)
            if near and near[0] <= scope:
                links.append((*span, near[1]))
    return sorted({x[:4] for x in links} & set(weak)), sorted(links)


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    words = PLAIN.findall(lower(text or ""))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        p = phrase.split()
        for k in range(len(words) - len(p) + 1):
            if words[k : k + len(p)] == p:
                starts.append(k)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def contaminated(rows, items, window=10):
    runs = defaultdict(set)
    for item, text in items:
        w = PLAIN.findall(lower(text or ""))
        n = min(len(w), window)
        if item is not None and n:
            for k in range(len(w) - n + 1):
                runs[tuple(w[k : k + n])].add(str(item))
    sizes = {len(r) for r in runs}
    out = []
    for i, text in rows:
        w = PLAIN.findall(lower(text or ""))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (run := tuple(w[k : k + n])) in runs:
                    hit.update(range(k, k + n))
                    found |= runs[run]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def rules(text):
    w = SPACED.findall(text or "")
    times = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    twice = {k + j for k in range(len(w) - 4) if times[tuple(w[k : k + 5])] > 1 for j in range(5)}
    lines = [line for line in (text or "").split("\n") if SPACED.search(line)]
    failed = len(w) < 10 or 100 * len(twice) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(twice), failed


def weighed(text):
    w = SPACED.findall(text or "")
    return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def probability_jaccard(x, y):
    every = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in every) for i in set(x) & set(y))


def classes(rows, threshold=0.8):
    """Least id of each row's class, by comparing all pairs that share a shingle."""
    texts = [weighed(t) for _, t in rows]
    holders = defaultdict(list)
    for k, shingles in enumerate(texts):
        for s in shingles:
            holders[s].append(k)
    shared = Counter((a, b) for ks in holders.values() for n, a in enumerate(ks) for b in ks[n + 1 :])
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for (a, b), n in shared.items():
        if root(a) != root(b) and n >= 0.3 * min(len(texts[a]), len(texts[b])) and probability_jaccard(texts[a], texts[b]) >= threshold:
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least.setdefault(root(k), []).append(i)
    return [min((i for i in least[root(k)] if i is not None), default=None) for k in range(len(rows))]

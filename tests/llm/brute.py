"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def shingles(text, size):
    words = WORD.findall((text or "").translate(_SMALL))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def near_components(rows, size, percent=80):
    """doc_id -> (set size, component)"""
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


def repeated_units(units, length, ordered_rows):
    """Per row the flags of units covered by a string of `length` units seen before."""
    seen, out = set(), []
    for row in ordered_rows:
        parts = units(row)
        gone = [False] * len(parts)
        for p in range(len(parts) - length + 1):
            piece = tuple(parts[p : p + length]) if isinstance(parts, list) else parts[p : p + length]
            if piece in seen:
                gone[p : p + length] = [True] * length
            else:
                seen.add(piece)
        out.append(gone)
    return out


def runs(flags):
    found = []
    for i, gone in enumerate(flags):
        if gone and i and flags[i - 1]:
            found[-1] += 1
        elif gone:
            found.append(1)
    return found


def sha(data):
    return hashlib.sha256(data).hexdigest()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def personal(text):
    def fits(kind, value):
        digits = re.sub("[^0-9]", "", value)
        if kind == "ip":
            return all(int(p) <= 255 for p in value.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and luhn(digits)
        return kind == "email" or 9 <= len(digits) <= 15

    spans = []
    for order, (kind, pattern) in enumerate(PATTERNS.items()):
        # These patterns take quadratic time on long runs; without the sign they cannot match.
        if {"email": "@", "ip": ".", "phone": "+"}.get(kind, "") not in (text or ""):
            continue
        spans += [
            (m.start(), order, m.end(), kind) for m in re.finditer(pattern, text or "") if fits(kind, m.group())
        ]
    spans.sort()
    return Counter(s[3] for s in spans), ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """source -> target, by resharing until nobody is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    fixed, left = {}, float(sum(sizes.values()))
    while True:
        free = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not over:
            return {**fixed, **{s: left * weight[s] / total for s in free}}
        for s in over:
            fixed[s] = float(most * sizes[s])
        left = sum(sizes.values()) - sum(fixed.values())
        if len(fixed) == len(names):
            return fixed


def edit_to_part(item, words):
    """Least edit distance of `item` to any run of `words`."""
    now = [0] * (len(words) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(words):
            new.append(min(now[j] + (x != y), now[j + 1] + 1, new[j] + 1))
        now = new
    return min(now)


def plain(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").translate(_SMALL))


def leaks(rows, items, percent=80, min_words=5):
    found = defaultdict(dict)
    for i, text in rows:
        words = plain(text)
        for item, passage in items:
            wanted = plain(passage)
            if len(wanted) >= min_words and len(set(wanted) & set(words)) * 2 >= len(set(wanted)):
                distance = edit_to_part(wanted, words)
                if distance <= len(wanted) * (100 - percent) // 100:
                    found[i][item] = distance
    return found


def binomial_at_most(k, n, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def dialogues(rows):
    """conv_id -> its turns (role, text) in order; equal turn numbers go by digest, as stated."""
    found = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
            found[conv_id].append(((turn is not None, turn or 0, digest), role, text))
    return {i: [t[1:] for t in sorted(own, key=lambda t: t[0])] for i, own in found.items()}


def rebuilt(own):
    def taken(i):
        return zlib.crc32(str(i).encode()) % 6

    return {i: own.get(i - int(math.fmod(i, 100)), [])[: taken(i)] + turns[taken(i) :] for i, turns in own.items()}


def trie(own):
    """Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)."""
    members = defaultdict(list)
    for i, turns in own.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(i)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for path, ids in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(ids) - 1) * len(path[-1][1]) if path else 0
    out = []
    for path, ids in members.items():
        ends = ",".join(str(i) for i in sorted(ids) if len(own[i]) == len(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), children[path], leaves[path], saved[path], sha(ends.encode())))
    return out


def archived(rows, least=1000):
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of (page_id, html)."""
    rows = [(i, (t or "").encode()) for i, t in rows]
    latest = {}
    for i, payload in rows:
        latest[payload] = max((x for x in (i, latest.get(payload)) if x is not None), default=None)
    out = []
    for i, payload in rows:
        again = len(payload) >= least and i != latest[payload]
        kind = "revisit" if again else "response"
        out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), kind, latest[payload] if again else None))
    return out


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def ranked(docs, items, k):
    """(item_id, rank, doc_id, score) by scoring every document for every item."""
    counts = [(i, Counter(TERM.findall((t or "").translate(_SMALL)))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(TERM.findall((t or "").translate(_SMALL)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in terms
                if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        best = sorted(scored)[:k]
        out += [(item, rank + 1, None if null else i, -score) for rank, (score, null, i) in enumerate(best)]
    return out

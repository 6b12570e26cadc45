"""Plain versions of the operators for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def near_duplicates(texts):
    """id -> (n_shingles, component, kept) by comparing all pairs that share a shingle."""
    sets, held, parent = {i: shingles(t) for i, t in texts.items()}, defaultdict(list), {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sorted(sets):
        common = Counter()
        for s in sets[i]:
            common.update(held[s])
            held[s].append(i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def dedup_lines(texts, min_docs=10):
    """Kept texts, by the keys of all lines."""

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    docs = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} - {""})
    return ["\n".join(x for x in (t or "").split("\n") if not key(x) or docs[key(x)] < min_docs) for t in texts]


def licence_texts(text, known, idf, drift=8):
    """Labels of the whole texts of which half of the rare words start within a few words of each other, with a key phrase."""
    words = re.findall(r"[0-9a-z]+", (text or "").lower())
    found = set()
    for label, (template, keys) in known.items():
        own = re.findall(r"[0-9a-z]+", template.lower())
        ordered = sorted(set(own), key=lambda w: (-idf[w], hashlib.md5(w.encode()).hexdigest()))
        rare = {w: own.index(w) for w in ordered[: (len(ordered) + 1) // 2]}
        starts = {(i - rare[w], rare[w]) for i, w in enumerate(words) if w in rare}
        at = {k: " ".join(own).split(k)[0].count(" ") for k in keys}
        phrases = {i - at[k] for k in keys for i in range(len(words)) if words[i : i + len(k.split())] == k.split()}
        for s in {x for x, _ in starts}:
            near = {p for x, p in starts if s <= x <= s + drift}
            if 2 * len(near) >= len(rare) and any(s <= x <= s + drift for x in phrases):
                found.add(label)
    return found


def base_phrases(text):
    phrases = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def simhash(text):
    words = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_groups(texts):
    """id -> (fingerprint, component) by comparing all pairs."""
    prints, parent = {i: simhash(t) for i, t in texts.items()}, {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for at, i in enumerate(ids):
        for j in ids[at + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (f"{prints[i]:016x}", find(i)) for i in ids}


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def spelling_variants(rows, min_length=5, min_count=3):
    """(word, form, root, n, n_near, form_n) by comparing all pairs of words."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            word = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            counts[word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda y: (-words[y], y)) for w, x in near.items() if x}
    form = {w: x for w, x in best.items() if words[x] >= 2 * words[w]}

    def root(word):
        return root(form[word]) if word in form else word

    return [(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()]


def prefix_trie(rows):
    """The nodes of the rebuilt conversations of (conv_id, turn, role, text)."""

    def tie(role, text):
        return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()

    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, tie(role or "", text or ""), role or "", text or ""))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in turns.items():
        h, over = zlib.crc32(str(c).encode()) % 4, abs(c) % 20
        built[c] = turns.get(c - over if c >= 0 else c + over, [])[:h] + v[h:]
    members, children = defaultdict(list), defaultdict(list)
    for c, v in built.items():
        for depth in range(len(v) + 1):
            members[tuple(v[:depth])].append(c)
    out = {}
    for node in sorted(members, key=len, reverse=True):
        if node:
            children[node[:-1]].append(node)
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(out[x][5] for x in children[node]) or 1
        saved = sum(out[x][6] for x in children[node]) + (len(members[node]) - 1) * words
        ends = ",".join(str(c) for c in sorted(members[node]) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out[node] = (min(members[node]), len(node), parent, len(members[node]), len(children[node]), leaves, saved, digest)
    return list(out.values())


def fold(events):
    """The final (role, text) messages of one conversation's events in order."""
    messages, hand = [], None
    for kind, role, text, target in events:
        if kind == "open":
            hand = len(messages)
            messages.append([role or "", text or ""])
        elif kind == "delta" and hand is not None:
            messages[hand][1] += text or ""
        elif kind == "edit":
            at = hand if target is None else target
            if at is not None and 0 <= at < len(messages):
                messages[at][1] = text or ""
        elif kind == "regenerate":
            found = [i for i, (r, _) in enumerate(messages) if role is None or r == role]
            if found:
                hand = found[-1]
                messages[hand][1] = ""
    return [tuple(x) for x in messages]


def leader(rows, classes, alpha, beta, l1, l2):
    """(feature, class) -> weight after follow-the-regularised-leader on ({feature: value}, label) rows, one number at a time."""
    total, squares = defaultdict(float), defaultdict(float)

    def weight(x):
        if abs(total[x]) <= l1:
            return 0.0
        return -(total[x] - math.copysign(l1, total[x])) / ((beta + math.sqrt(squares[x])) / alpha + l2)

    for values, label in rows:
        own = {(i, c): weight((i, c)) for i in values for c in range(classes)}
        powers = [math.exp(sum(v * own[i, c] for i, v in values.items())) for c in range(classes)]
        for i, v in values.items():
            for c in range(classes):
                gradient = (powers[c] / sum(powers) - (c == label)) * v
                grown = squares[i, c] + gradient * gradient
                total[i, c] += gradient - (math.sqrt(grown) - math.sqrt(squares[i, c])) / alpha * own[i, c]
                squares[i, c] = grown
    return {x: weight(x) for x in list(total)}

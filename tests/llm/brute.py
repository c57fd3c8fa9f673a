"""Plain Python versions of the operators' results, for tests on small tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import xxhash

SF = "/root/testdata/sf0.001"
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))


def pieces(docs, tokenizer, capacity=1024):
    out = []
    for doc_id, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        head, at, k = len(ids) % capacity, 0, 0
        while at < len(ids):
            n = head if not at and head else capacity
            out.append((doc_id, k, at, n, zlib.crc32(np.array(ids[at:at + n], "<u4").tobytes())))
            at, k = at + n, k + 1
    return out


def contamination(docs, bench, size=10):
    windows = {}
    for item, text in bench:
        w = alnum_words(text)
        n = min(size, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + n]), set()).add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, items = alnum_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for j in range(len(w) - n + 1):
                if found := windows.get(tuple(w[j:j + n])):
                    hit.update(range(j, j + n))
                    items |= found
        out.append((doc_id, len(w), len(hit), len(items), sha256(",".join(sorted(items))), bool(hit)))
    return out


def repeats(docs, size=35):
    words = [space_words(t) for _, t in docs]
    count = collections.Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = {k for i in range(len(w) - size + 1) if count[tuple(w[i:i + size])] > 1 for k in range(i, i + size)}
        out.append((doc_id, len(w), len(gone), sha256(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def _signed(x):
    return x - (1 << 64) if x >> 63 else x


def line_chunks(text):
    """Lines of a text, and (first line, line behind the last) of its chunks."""
    lines, out, since = text.split("\n"), [], 0
    for i, line in enumerate(lines):
        if i == len(lines) - 1 or hashlib.md5(line.encode()).hexdigest() < "e":
            out.append((max(0, min(since, i - 1)), i + 1))
            since = i + 1
    return lines, out


def _alike(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def repeated_lines(docs):
    """Chunks and the lines around them, against the first occurrence; rows equal in id and text count as one."""
    def place(doc_id, text):
        named = "" if doc_id is None else f"{len(str(doc_id))}:{doc_id}"
        return (doc_id is not None, doc_id or 0, hashlib.md5(f"{named}|{text}".encode()).digest())
    first, gone = {}, collections.defaultdict(set)
    for who, text in sorted({(place(d, t), t) for d, t in docs if t is not None}):
        lines, chunks = line_chunks(text)
        for k, (a, b) in enumerate(chunks):
            if b - a < 2 or not any(x.strip(" ") for x in lines[a:b]):
                continue
            if (own := tuple(lines[a:b])) in first:
                before, after = first[own]
                gone[who, text].update(range(a - _alike(lines[:a][::-1], before), b + _alike(lines[b:], after)))
            else:
                first[own] = (lines[chunks[k - 1][0]:a][::-1] if k else [], lines[b:chunks[k + 1][1]] if k + 1 < len(chunks) else [])
    out = []
    for doc_id, text in docs:
        lines, lost = ([], ()) if text is None else (text.split("\n"), gone[place(doc_id, text), text])
        out.append((doc_id, len(lines), len(lost), sha256("\n".join(x for i, x in enumerate(lines) if i not in lost))))
    return out


def quality(text):
    text = text or ""
    words, places = space_words(text), collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i:i + 5])].append(i)
    repeated = {k for v in places.values() if len(v) > 1 for i in v for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if space_words(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), len(words) < 10 or 100 * len(repeated) > 20 * len(words))


def archives(rows):
    groups = collections.defaultdict(list)
    for page_id, _, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for page_id, _, html in rows:
        payload, ids = (html or "").encode(), [x for x in groups[html or ""] if x is not None]
        target = max(ids) if len(payload) >= 1000 and ids else page_id
        revisit = target != page_id
        out.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response",
                    target if revisit else None))
    return out


def licence_base(text, phrases):
    words, starts, labels = alnum_words(text), [], set()
    for phrase, label in phrases:
        p = phrase.split()
        own = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += own
        labels |= {label} if own else set()
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def fingerprint(text, size=3):
    words = space_words((text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or \
        ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def near_groups(docs, distance=3):
    prints = [fingerprint(t) for _, t in docs]
    own, parent = np.array(prints, np.uint64), list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(docs)):
        for j in np.flatnonzero(np.bitwise_count(own[i + 1:] ^ own[i]) <= distance):
            parent[root(i)] = root(i + 1 + int(j))
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return [(doc_id, f"{prints[i]:016x}", least.get(root(i))) for i, (doc_id, _) in enumerate(docs)]


def section_counts(doc_id, names, values, tokenizer, separator=" ", rule="largest"):
    text, owner, sections = separator.join(v or "" for v in values), [], []
    for f, value in enumerate(v or "" for v in values):
        lines = value.split("\n")
        for k, line in enumerate(lines):
            last = k == len(lines) - 1
            sections.append((names[f], k))
            extra = (len(separator) if f < len(values) - 1 else 0) if last else 1
            owner += [len(sections) - 1] * (len(line) + extra)
    tokens, crossing = [0] * len(sections), [0] * len(sections)
    for a, b in tokenizer.encode(text, add_special_tokens=False).offsets:
        own = collections.Counter(owner[a:b])
        best = {"largest": max(own, key=lambda x: (own[x], -x)), "first": min(own), "last": max(own)}[rule]
        tokens[best] += 1
        crossing[best] += len(own) > 1
    return [(doc_id, f, k, n, x) for (f, k), n, x in zip(sections, tokens, crossing, strict=True)]


def language_probabilities(weights, text, window=128):
    """Mean position probabilities of a text's bytes, one byte and one unit at a time."""
    import math
    raw, out = text.encode(), [0.0] * len(weights["c"])

    def states(d, part):
        n, h, found = len(weights["uf"]), [0.0] * len(weights["uf"]), []
        for byte in part:
            a = [float(v) for v in weights[f"x{d}"][byte]]
            b = [sum(h[i] * float(weights[f"u{d}"][i][j]) for i in range(n)) for j in range(3 * n)]
            z = [1 / (1 + math.exp(-2 * (a[j] + b[j]))) for j in range(n)]
            r = [1 / (1 + math.exp(-2 * (a[n + j] + b[n + j]))) for j in range(n)]
            c = [math.tanh(a[2 * n + j] + r[j] * b[2 * n + j]) for j in range(n)]
            h = [(1 - z[j]) * h[j] + z[j] * c[j] for j in range(n)]
            found.append(h)
        return found

    for at in range(0, len(raw), window):
        part = raw[at:at + window]
        for f, b in zip(states("f", part), states("b", part[::-1])[::-1], strict=True):
            logits = [float(weights["c"][k]) + sum(x * float(v[k]) for x, v in zip(f, weights["vf"], strict=True))
                      + sum(x * float(v[k]) for x, v in zip(b, weights["vb"], strict=True)) for k in range(len(out))]
            e = [math.exp(x - max(logits)) for x in logits]
            out = [o + x / sum(e) / len(raw) for o, x in zip(out, e, strict=True)]
    return out

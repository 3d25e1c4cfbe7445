"""Brute-force versions of the operators, row by row on the driver."""

import base64
import hashlib
import math
import re
import zlib

import numpy as np
import public_tokenizers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def least_reachable(ids, links):
    """Smallest id of each row's component; ``links`` are pairs of positions."""
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    groups = {}
    for k, i in enumerate(ids):
        groups.setdefault(find(k), []).append(i)
    return [min(groups[find(k)]) for k in range(len(ids))]


def simhash(text):
    import xxhash

    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else (
        [" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(docs):
    """(doc_id, fingerprint, component_id) of (doc_id, text) rows."""
    prints = [simhash(t) for _, t in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a)
             if (prints[a] ^ prints[b]).bit_count() <= 3]
    roots = least_reachable([i for i, _ in docs], links)
    return [(i, f"{p:016x}", r) for (i, _), p, r in zip(docs, prints, roots, strict=True)]


def exact(docs):
    """(doc_id, keep_id, group_size, kept, sha256); of repeated rows one is kept."""
    groups = {}
    for i, t in docs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in groups.items():
        ids.sort()
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, sha) for k, i in enumerate(ids)]
    return out


def repeats(docs, window=13):
    """(doc_id, n_words, n_removed, kept_sha256)."""
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, math.inf), math.inf if i is None else i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < (math.inf if i is None else i):
                gone |= set(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def byte_bpe(text):
    """(n_tokens, ids_sha256, decoded_sha256) by the tiktoken library."""
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                            special_tokens={})

    def one(t):
        ids = enc.encode_ordinary(t or "")
        assert enc.decode_bytes(ids) == (t or "").encode()
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256((t or "").encode()).hexdigest())

    return one(text) if isinstance(text, str | None) else [one(t) for t in text]


def token_starts(docs):
    """(doc_id, start, n_tokens, ids_crc32) in ascending order of doc_id."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = sorted(docs, key=lambda d: -1 if d[0] is None else d[0])
    start, out = 0, []
    for (i, _), e in zip(docs, tokenizer.encode_batch([t or "" for _, t in docs],
                                                      add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def embedding_links(rows, least=0.95):
    """(vec_id, n_links, component_id)."""
    usable, unit = [], {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float64)
            unit[k] = x / np.linalg.norm(x)
            usable.append(k)
    links = [(a, b) for n, a in enumerate(usable) for b in usable[:n]
             if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least]
    roots = least_reachable([i for i, _ in rows], links)
    counts = [0] * len(rows)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return [(i, c, r) for (i, _), c, r in zip(rows, counts, roots, strict=True)]


def water_levels(sizes, weights=(1, 2, 3), most=3):
    """Target per source (in order) by bisection on the level."""
    total = sum(sizes)
    w = [weights[k % len(weights)] for k in range(len(sizes))]
    low, high = 0.0, most * total + 1.0
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * s, x * mid) for s, x in zip(sizes, w, strict=True)) < total:
            low = mid
        else:
            high = mid
    return [min(most * s, x * high) for s, x in zip(sizes, w, strict=True)]


def runs(w, least=6, copies=4):
    """(start, length, period) of every run, straight from its definition."""
    found = []
    for q in range(1, len(w) // copies + 1):
        start = 0
        while start + q < len(w):
            end = start + q
            while end < len(w) and w[end] == w[end - q]:
                end += 1
            length = end - start
            if length >= max(least, copies * q) and not any(
                    all(w[k] == w[k - p] for k in range(start + p, end)) for p in range(1, q)):
                found.append((start, length, q))
            start = max(start + 1, end - q + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, text):
    """The words of op11's contract."""
    w = words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def periodic(docs):
    """The rows of op11."""
    out = []
    for i, text in docs:
        w = planted(i, text)
        found = runs(w)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(found), *told, hashlib.sha256(listed.encode()).hexdigest(),
                    hashlib.sha256(kept.encode()).hexdigest()))
    return out


def lines_kept(docs, least=10, chars=1):
    """(doc_id, n_lines, n_dropped, kept text) of (doc_id, text) rows."""
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c
                       for c in line.strip(" \t\n\x0b\x0c\r"))

    split = [(text or "").split("\n") for _, text in docs]
    held = {}
    for lines in split:
        for k in {key(line) for line in lines}:
            held[k] = held.get(k, 0) + 1
    out = []
    for (i, _), lines in zip(docs, split, strict=True):
        kept = [x for x in lines if len(key(x)) < chars or held[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def hash_up(level, fan=2):
    """(root, per leaf the list of (before, after) from the leaf up)."""
    ways, at = [[] for _ in level], list(range(len(level)))
    while len(level) > 1:
        for leaf, k in enumerate(at):
            first = k - k % fan
            ways[leaf].append(("".join(level[first:k]), "".join(level[k + 1:first + fan])))
        level = [sha(*level[k:k + fan]) for k in range(0, len(level), fan)]
        at = [k // fan for k in at]
    return level[0], ways


def manifest(rows, fan=2):
    """op13's rows from (doc_id, source, lang, n_chars, text) rows."""
    def leaf(values):
        return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])

    order = sorted(rows, key=lambda r: (r[2] is not None, (r[2] or "").encode(),
                                        r[0] is not None, r[0] or 0, leaf(r)))
    langs = list(dict.fromkeys(r[2] for r in order))
    trees = {lang: hash_up([leaf(r) for r in order if r[2] == lang], fan) for lang in langs}
    if not rows:
        return []
    root, top_ways = hash_up([trees[lang][0] for lang in langs], fan)
    out = []
    for lang, top in zip(langs, top_ways, strict=True):
        subroot, ways = trees[lang]
        for r, way in zip([r for r in order if r[2] == lang], ways, strict=True):
            odd = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            at = leaf((*r[:3], r[3] + 1 if odd and r[3] is not None else r[3], r[4]))
            for before, after in way + top:
                at = sha(before, at, after)
            out.append((r[0], leaf(r), subroot, root, sha(*[b + a for b, a in way + top]),
                        at, at == root))
    return out


def toxic_features(text, bits):
    """Distinct indices of words, pairs and skip-grams, and the bias, by plain integers."""
    cut = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else " " if ord(c) < 128 and not c.isalnum() else c
                  for c in text or "")
    h = [zlib.crc32(w.encode()) for w in cut.split(" ") if w]
    values = [x + 1 for x in h]
    values += [a * 0x100000001B3 + b + 2 for a, b in zip(h, h[1:])]
    values += [a * 0x1000193A5 + b + 3 for a, b in zip(h, h[2:])]
    out = {0}
    for v in values:
        v &= 2**64 - 1
        v ^= v >> 31
        out.add((v * 0x9E3779B97F4A7C15 & (2**64 - 1)) >> (64 - bits))
    return out


def ftrl_weights(rows, epochs, alpha, beta, l1, l2):
    """FTRL-proximal as published, one coordinate at a time: rows of (indices, label)."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return -(z[i] - sign * l1) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for indices, label in rows:
            w = {i: weight(i) for i in indices}
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.values()))))) - label
            for i in indices:
                before = n.get(i, 0.0)
                sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = before + g * g
    return {i: weight(i) for i in z if weight(i) or not i}

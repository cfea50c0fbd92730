"""Plain versions of the corpus operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def suffix_dedup(rows, length=50):
    """(id, text) rows -> {id: (n_bytes, n_removed, n_spans, sha256)}."""
    first = {}
    docs = sorted((d, (t or "").encode()) for d, t in rows)
    for d, b in docs:
        for i in range(len(b) - length + 1):
            first.setdefault(b[i:i + length], d)
    out = {}
    for d, b in docs:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < d:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, size):
    ws = (text or "").encode().translate(LOWER).split()
    if not ws:
        return frozenset()
    if len(ws) < size:
        return frozenset([tuple(ws)])
    return frozenset(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1))


def near_duplicates(rows, size=4, percent=80):
    """(id, text) rows -> {id: (n_shingles, component)}."""
    sets = {d: shingles(t, size) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    both = Counter()
    for ds in holders.values():
        for i, a in enumerate(ds):
            for b in ds[i + 1:]:
                both[min(a, b), max(a, b)] += 1
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def token_rows(rows, path, end_id=1):
    """(id, text) rows -> {id: (start, n_tokens, crc32)}."""
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    out, start = {}, 0
    for d, t in sorted(rows):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, end_id]
        out[d] = (start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)))
        start += len(ids)
    return out


def digest(*parts):
    return hashlib.sha256(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def framed(value):
    if value is None:
        return b"-"
    b = str(value).encode()
    return str(len(b)).encode() + b":" + b


def merkle_tree(digests, fanout=16):
    """(root, [(left, right) per level] of every leaf)."""
    nodes = [(d, [i]) for i, d in enumerate(digests)]
    paths = [[] for _ in digests]
    while len(nodes) > 1:
        up = []
        for a in range(0, len(nodes), fanout):
            run = nodes[a:a + fanout]
            for j, (_, leaves) in enumerate(run):
                for i in leaves:
                    paths[i].append(("".join(d for d, _ in run[:j]), "".join(d for d, _ in run[j + 1:])))
            up.append((digest(*(d for d, _ in run)), [i for _, leaves in run for i in leaves]))
        nodes = up
    return nodes[0][0], paths


def merkle_manifest(rows):
    """(doc_id, source, lang, n_chars, text) rows to rows (doc_id, leaf,
    subroot, root, proof, folded root, verified)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((digest(*map(framed, r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for g in names:
        groups[g].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
        trees.append(merkle_tree([leaf for leaf, _ in groups[g]]))
    if not trees:
        return []
    root, upper = merkle_tree([t[0] for t in trees])
    out = []
    for g, (subroot, paths), above in zip(names, trees, upper, strict=True):
        for (leaf, r), path in zip(groups[g], paths, strict=True):
            seen = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                seen = digest(*map(framed, (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))))
            for left, right in path + above:
                seen = digest(left, seen, right)
            out.append((r[0], leaf, subroot, root, digest(*(x + y for x, y in path + above)), seen, seen == root))
    return out


def prefix_trie(rows):
    """(conv_id, turn, role, text) rows to rows (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved, ends sha256)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = [] if c is None else own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])
        built[c] = base[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    name = {n: min(m, key=lambda c: 1 << 63 if c is None else c) for n, m in members.items()}
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in children[n]) or 1
        saved[n] = sum(saved[k] for k in children[n]) + ((len(members[n]) - 1) * len(n[-1][1]) if n else 0)
    out = []
    for n, m in members.items():
        ends = sorted(c for c in m if c is not None and len(built[c]) == len(n))
        out.append((name[n], len(n), name[n[:-1]] if n else None, len(m), len(children[n]), leaves[n], saved[n],
                    digest(",".join(map(str, ends)))))
    return out
